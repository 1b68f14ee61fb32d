"""Run a method end to end and publish its tables (the reference's settings
scripts: one run per scenario and scheme, one workbook per table bag).

    python -m stratum.plans.run --method hier --out /shared/out --run-date 2026-12-03 \
        --inputs /shared/in [--mapping names.json] [--scenarios base]

Inputs are the files of a folder (``sources.ingest``: rejected rows and input
measurements are published as tables too), or, with ``--sf``, the driver-table
stand-ins.  Outputs are one directory per table, partitioned by ``scenario``,
``scheme`` and ``run_date``, that become visible together (``sources.publish``).
"""

from __future__ import annotations

import argparse

from stratum.config import HierConfig, TargetsConfig
from stratum.plans import methods as M
from stratum.plans import queries as Q
from stratum.sources import ingest, tpch
from stratum.sources.publish import indicator_tables, publish

_HIER = ("rg_summary", "people", "households", "jobs", "series_hhpop", "series_hh", "series_emp", "unrolled", "diagnostics", "accounts")
TABLES = {
    "hier": _HIER,
    "factor_stock": _HIER,
    "factor_growth": _HIER,
    "targets": ("rg_summary", "people", "households", "jobs", "series_hhpop", "series_hh", "series_emp", "series_pop", "unrolled", "annual_unrolled",
                "unrolled_regional", "diagnostics", "accounts"),
}


def run(spark, method: str, sf: str | None, out: str, run_date: str, scenarios=("base",),
        schemes=("existing",), fmt: str = "parquet", inputs: str | None = None, mapping=None, rg_name: str | None = None, cfg=None) -> list:
    """Paths of the published tables.  With ``inputs`` the files of that folder
    are run, by the settings ``cfg``; the schemes are those of its crosswalk."""
    more = {}
    if inputs is not None:
        if len(scenarios) != 1:
            raise ValueError("a folder of inputs is one scenario, unless its tables have a column for it")
        cfg = cfg or (TargetsConfig() if method == "targets" else HierConfig())
        given = ingest.load(spark, inputs, method, scenarios[0], mapping, cfg.base_year)
        t = given.tables
        if method == "targets":
            res = M.run_targets(t["targets"], t.get("totals"), cfg, scenarios, schemes, crosswalk=t.get("crosswalk"))
        else:
            names = t.get("names", t["city_emp"].selectExpr("city_id", "cast(null as string) juris").limit(0))
            res = M.run_scenarios(M.HierInputs(t["ref"], t["rgs_county"], t["rgs_rg"], t["crosswalk"], names, t["city_emp"], t["city_pop"], t.get("totals")), cfg, method)
        more = {"rejects": given.rejects(spark), "input_metrics": given.metrics(spark)}
    elif method == "targets":
        cfg = cfg or tpch.TARGETS
        base = tpch.customer_base(spark, sf)
        totals = tpch.totals(tpch.ref(spark, sf, tuple(scenarios)), after_year=cfg.base_year)
        res = M.run_targets(tpch.targets(base), totals, cfg, scenarios, crosswalk=tpch.crosswalk(base, tuple(schemes)))
    else:
        cfg = cfg or tpch.HIER
        inp = Q.inputs(spark, sf, tuple(scenarios), tuple(schemes), annex=method.startswith("factor"))
        res = M.run_scenarios(inp, cfg, method)
    res |= indicator_tables(res["series"], cfg.indicators)
    # without totals there are no accounts
    return publish(spark, {k: res[k] for k in TABLES[method] if k in res} | more, out, method, run_date, fmt, rg_name)


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--method", choices=sorted(TABLES), default="hier")
    source = ap.add_mutually_exclusive_group()
    source.add_argument("--inputs", help="folder of input files")
    source.add_argument("--sf", default="/root/testdata/sf0.01", help="folder of driver tables, for the stand-ins")
    ap.add_argument("--mapping", help="JSON file with other column and file names")
    ap.add_argument("--out", required=True)
    ap.add_argument("--run-date", required=True)
    ap.add_argument("--scenarios", nargs="+", default=["base"])
    ap.add_argument("--schemes", nargs="+", default=["existing"])
    ap.add_argument("--rg-name", help="published name of the grouping column")
    ap.add_argument("--format", default="parquet")
    a = ap.parse_args(argv)
    from stratum.session import get_spark
    spark = get_spark(app=f"stratum-{a.method}")
    for path in run(spark, a.method, a.sf, a.out, a.run_date, a.scenarios, a.schemes, a.format, a.inputs, a.mapping, a.rg_name):
        print(path)


if __name__ == "__main__":
    main()
