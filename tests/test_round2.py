"""Worked examples: levels with a side missing, the growth variant's city join,
runs that keep each other's partitions, scenarios of the targets method."""

from stratum.operators import control as C
from stratum.operators import report as R
from stratum.operators import series as S
from stratum.plans import methods as M
from stratum.sources import tpch
from stratum.sources.io import write_tables

SF = "/root/testdata/sf0.001"


def test_county_keeps_people_of_rgs_without_jobs(spark):
    lead = "scenario string, scheme string, county int, rg_id string, city_id int, "
    emp = spark.createDataFrame([("s", "x", 1, "a", 1, 5.0, 6.0)], lead + "emp_base double, emp_target double")
    pop = spark.createDataFrame([("s", "x", 1, "a", 1, 100.0, 200.0), ("s", "x", 1, "b", 2, 3.0, 7.0)], lead + "pop_base double, pop_target double")
    rg, county = C.aggregate_levels(emp, pop)
    assert [(r.rg_id, r.pop_target) for r in rg.collect()] == [("a", 200.0)]
    assert [(r.emp_target, r.pop_target) for r in county.collect()] == [(6.0, 207.0)]


def test_growth_summary_joins_cities_first(spark):
    lead = "scenario string, scheme string, county int, rg_id string, city_id int, "

    def table(m, rows):
        return spark.createDataFrame([("s", "x", 1, "a", c, t, 0.0, 0.0) for c, t in rows], lead + f"{m}_target double, {m}_ref double, {m}_base double")

    pop, hh, emp = table("pop", [(1, 10.0), (2, 90.0)]), table("hh", [(1, 4.0), (2, 5.0)]), table("emp", [(1, 1.0)])
    assert R.group_summary(pop, hh, emp, by_city=True).first().pop_end == 10.0
    assert R.group_summary(pop, hh, emp).first().pop_end == 100.0


def test_runs_keep_each_other(spark, tmp_path):
    df = spark.createDataFrame([("base", "e", 1), ("flat", "e", 2)], "scenario string, scheme string, v int")
    for date in ("2026-01-01", "2026-02-01", "2026-02-01"):
        write_tables({"t": df}, str(tmp_path), run_date=date)
    got = spark.read.parquet(f"{tmp_path}/t")
    assert sorted((r.scenario, str(r.run_date), r.v) for r in got.collect()) == [
        ("base", "2026-01-01", 1), ("base", "2026-02-01", 1), ("flat", "2026-01-01", 2), ("flat", "2026-02-01", 2)]


def test_targets_scenarios_match_single_runs(spark):
    t = tpch.targets(tpch.customer_base(spark, SF))
    both = tpch.totals(tpch.ref(spark, SF, ("base", "flat")), after_year=tpch.TARGETS.base_year)
    many = M.run_targets(t, both, tpch.TARGETS, ("base", "flat"), ("existing", "proposed"), annual=False)["unrolled"]
    rows = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)
    for scenario in ("base", "flat"):
        for scheme in ("existing", "proposed"):
            one = M.run_targets(t, both, tpch.TARGETS, scenario, scheme, annual=False)["unrolled"]
            assert rows(one) == rows(many.where(f"scenario = '{scenario}' and scheme = '{scheme}'"))


def test_null_value_leaves_its_year_as_rounded(spark):
    long = spark.createDataFrame([("s", "x", "a", 1, 2020, 1.4), ("s", "x", "a", 2, 2020, None), ("s", "x", "a", 1, 2030, 1.4), ("s", "x", "a", 2, 2030, 2.0)],
                                 "scenario string, scheme string, indicator string, geo_id long, year int, value double")
    tot = spark.createDataFrame([("s", "a", 2020, 9.0), ("s", "a", 2030, 9.0)], "scenario string, indicator string, year int, total double")
    got = {(r.year, r.geo_id): r.value for r in S.round_to_total(long, ["scenario", "scheme", "indicator"], tot).collect()}
    assert got[2020, 1] == 1.0 and got[2020, 2] is None and got[2030, 1] + got[2030, 2] == 9.0
