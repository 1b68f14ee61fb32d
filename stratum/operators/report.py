"""Published tables: group summaries, names, city reports, output names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.expr import strict_sum

RG = ["scenario", "scheme", "county", "rg_id"]


def group_summary(pop: DataFrame, hh: DataFrame, emp: DataFrame, keys=RG, by_city: bool = False) -> DataFrame:
    """G12 (HIER, FACTOR): per (county, RG) long growth, growth and end value
    of people, households and jobs; RG rows present in all three tables.
    ``by_city`` (the growth variant) sums only cities present in all three,
    grouped by the county and RG of the people table."""
    keys = list(keys)

    def measures(m):
        t, r, b = F.col(f"{m}_target"), F.col(f"{m}_ref"), F.col(f"{m}_base")
        return {f"{m}_long": t - r, f"{m}_gro": t - b, f"{m}_end": t}

    def part(df, *names):
        return df.groupBy(*keys).agg(*[strict_sum(e).alias(k) for m in names for k, e in measures(m).items()])

    if by_city:
        city = [k for k in keys if k not in ("county", "rg_id")] + ["city_id"]
        value = lambda m: [f"{m}_{r}" for r in ("target", "ref", "base")]
        joined = pop.select("city_id", *keys, *value("pop"))
        for df, m in ((emp, "emp"), (hh, "hh")):
            joined = joined.join(df.select(*city, *value(m)), city, "inner")
        return part(joined, "pop", "hh", "emp")
    return part(pop, "pop").join(part(hh, "hh"), keys, "inner").join(part(emp, "emp"), keys, "inner")


def targets_summary(pop: DataFrame, emp: DataFrame, keys=RG) -> DataFrame:
    """G12 (TARGETS): per (county, RG) delta base->target and target sums."""
    keys = list(keys)
    p = pop.groupBy(*keys).agg(
        strict_sum(F.col("pop_target") - F.col("pop_base")).alias("pop_delta"),
        strict_sum("pop_target").alias("pop_end"),
        strict_sum(F.col("hh_target") - F.col("hh_base")).alias("hh_delta"),
        strict_sum("hh_target").alias("hh_end"))
    e = emp.groupBy(*keys).agg(
        strict_sum(F.col("emp_target") - F.col("emp_base")).alias("emp_delta"),
        strict_sum("emp_target").alias("emp_end"))
    return p.join(e, keys, "inner")


def attach_names(df: DataFrame, names: DataFrame, how: str = "left") -> DataFrame:
    """Jurisdiction name by city id (left lookup, or inner as in the SQL variant)."""
    return df.join(names.select("city_id", "juris"), "city_id", how)


PEOPLE = ["pop_ref", "pop_base", "pop_gro", "pop_target", "hhpop_base", "hhpop_gro", "hhpop_target"]
HOUSEHOLDS = ["hh_ref", "hh_base", "hh_gro", "hh_target"]
JOBS = ["emp_ref", "emp_base", "emp_gro", "emp_target"]


def city_reports(pop: DataFrame, hh: DataFrame, emp: DataFrame, with_hhpop_ref: bool = False) -> dict:
    """The three city tables in fixed column order."""
    lead = ["scenario", "scheme", "rg_id", "county", "city_id", "juris"]
    people = PEOPLE[:4] + (["hhpop_ref"] if with_hhpop_ref else []) + PEOPLE[4:]
    return {"people": pop.select(*lead, *people),
            "households": hh.select(*lead, *HOUSEHOLDS),
            "jobs": emp.select(*lead, *JOBS)}


def targets_reports(pop: DataFrame, emp: DataFrame) -> dict:
    """G14 (TARGETS): the three city tables in fixed column order."""
    lead = ["scenario", "scheme", "rg_id", "county", "city_id", "juris"]
    of = lambda m: [f"{m}_by", f"{m}_base", f"{m}_gro", f"{m}_target"]
    return {"people": pop.select(*lead, *of("pop"), *of("hhpop")),
            "households": pop.select(*lead, *of("hh")),
            "jobs": emp.select(*lead, *of("emp"))}


def year_names(ref_year: int, base_year: int, target_year: int) -> dict:
    """Role column -> year-suffixed name (``pop_gro`` -> ``pop_gro1650``)."""
    yy = lambda y: str(y)[2:4]
    out = {}
    for m in ("pop", "hhpop", "hh", "emp"):
        out.update({f"{m}_ref": f"{m}{ref_year}", f"{m}_by": f"{m}{ref_year}", f"{m}_base": f"{m}{base_year}",
                    f"{m}_target": f"{m}{target_year}",
                    f"{m}_gro": f"{m}_gro{yy(base_year)}{yy(target_year)}",
                    f"{m}_delta": f"{m}{yy(base_year)}{yy(target_year)}",
                    f"{m}_long": f"{m}{yy(ref_year)}{yy(target_year)}",
                    f"{m}_end": f"{m}{yy(target_year)}"})
    return out


def publish_names(df: DataFrame, names: dict, rg_name: str | None = None) -> DataFrame:
    """B5 + B6: year-suffixed names and the caller's name of the RG column."""
    m = {k: v for k, v in names.items() if k in df.columns}
    if rg_name and "rg_id" in df.columns:
        m["rg_id"] = rg_name
    return df.withColumnsRenamed(m)


def diagnostics(df: DataFrame, table: str, keys, checks: dict) -> DataFrame:
    """Rows where a rule produced NULL on purpose: one row per
    (table, check, key).  ``checks``: ``{name: condition}``."""
    keys = list(keys)
    parts = [df.where(cond).select(F.lit(table).alias("table"), F.lit(name).alias("check"),
                                   F.to_json(F.struct(*[F.col(k) for k in keys])).alias("key"))
             for name, cond in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
