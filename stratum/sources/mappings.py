"""Names of the input columns (FIXTURES §1) for each library table.

These are fixed values of the published input files.  A run may override any of
them, and the file names, with a JSON file of the same shape (see ``ingest``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from stratum.sources import schemas as SC


@dataclass(frozen=True)
class TableSpec:
    """One input table: its schema, the input names of its columns, the keys
    that every row needs, and the key that no two rows may share (none: rows of
    a key are summed or kept as they are)."""
    schema: T.StructType
    columns: dict
    keys: tuple
    unique: tuple = ()
    optional: tuple = ()
    file: str = ""


HIER_TABLES = {
    "ref": TableSpec(SC.REF, {"scenario": "scenario", "year": "Year", "pop": "Pop", "hhpop": "HHPop", "hh": "HH", "emp": "Emp"},
                     ("year",), ("scenario", "year"), ("scenario",), "ref"),
    "rgs_county": TableSpec(SC.RGS_COUNTY, {"scenario": "scenario", "county": "County", "rgs_pop": "RGSPop", "rgs_emp": "RGSEmp", "gq_pct_target": "GQpct2050",
                                            "pph_target": "PPH2050"},
                            ("county",), ("scenario", "county"), ("scenario", "gq_pct_target", "pph_target"), "rgs_county"),
    "rgs_rg": TableSpec(SC.RGS_RG, {"scenario": "scenario", "county": "County", "rg_id": "RG", "rgs_pop": "RGSPop", "rgs_emp": "RGSEmp", "gq_pct_target": "GQpct2050",
                                    "pph_target": "PPH2050"},
                        ("county", "rg_id"), ("scenario", "county", "rg_id"), ("scenario", "gq_pct_target", "pph_target"), "rgs_rg"),
    "city_emp": TableSpec(SC.CITY_EMP, {"city_id": "CityID", "county": "County", "emp_ref": "2000est", "emp_base": "2016est", "target": "Target", "cr_add": "CR_add",
                                        "annex": "Annex"},
                          ("city_id", "county"), (), ("annex",), "city_emp"),
    "city_pop": TableSpec(SC.CITY_POP, {"city_id": "CityID", "county": "County", "pop_ref": "2000est", "pop_base": "2016est", "target": "Target", "hhpop_ref": "HHPop00",
                                        "hhpop_base": "HHPop16", "hh_ref": "HH2000", "hh_base": "HH2016", "gq_pct": "GQpct", "gq_pct_target": "GQpct2050",
                                        "pph_target": "PPH2050", "annex": "Annex", "pph": "PPH"},
                          ("city_id", "county"), (), ("annex", "pph", "gq_pct_target", "pph_target"), "city_pop"),
}
TARGETS_TABLES = {
    "targets": TableSpec(SC.TARGETS, {"city_id": "control_id", "county": "county_id", "rg_id": "RGID", "juris": "name",
                                      "emp_by": "Emp18", "emp_base": "TotEmp20_wCRnoMil", "emp_gro": "TotEmpTrg_wCRnoMil", "emp_target": "TotEmp50_wCRnoMil",
                                      "pop_by": "Pop18", "pop_base": "TotPop20", "pop_gro": "TotPopTrg", "pop_target": "TotPop50",
                                      "hhpop_by": "HHpop18", "hhpop_base": "HHpop20", "hh_by": "HH18", "hh_base": "HH20",
                                      "gq_pct_target": "GQpct50", "pph_target": "PPH50"},
                         ("city_id", "county"), ("city_id",), (), "targets"),
}
# wide tables: the crosswalk has a column for each scheme, the totals one for each indicator
CROSSWALK_CITY, CROSSWALK_NAME, CROSSWALK_SCHEME = "CityID", "Juris", r"RGID_(\w+)"
TOTALS_INDICATORS = {"hhpop": "HHPop", "hh": "HH", "emp": "Emp", "pop": "Pop"}
