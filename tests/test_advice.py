
from pyspark.sql import functions as F

from stratum.operators import report as R
from stratum.plans import methods as M
from stratum.plans.run import TABLES


def test_targets_city_reports_and_zero_weight(spark):
    t = spark.createDataFrame([(1, 33, "1", "A", 20.0, 5.0, 2.0), (2, 33, "1", "B", 40.0, 10.0, 3.0)],
                              "city_id long, county long, rg_id string, juris string, pop_target double, gq_pct_target double, pph_target double")
    for c in ("pop_by", "pop_base", "hhpop_by", "hhpop_base", "hh_by", "hh_base"):
        t = t.withColumn(c, F.lit(10.0))
    for c in ("emp_by", "emp_base", "emp_target"):
        t = t.withColumn(c, F.lit(0.0))
    totals = spark.createDataFrame([("emp", 2018, 7.0)], "indicator string, year int, total double")
    out = M.run_targets(t.withColumn("pop_gro", F.col("pop_target") - 9), totals, annual=False)
    names = R.year_names(2018, 2020, 2050)
    assert {"people", "households", "jobs"} <= set(TABLES["targets"])
    people = R.publish_names(out["people"], names)
    assert people.columns[4:] == ["city_id", "juris", "pop2018", "pop2020", "pop_gro2050", "pop2050", "hhpop2018", "hhpop2020", "hhpop_gro2050", "hhpop2050"]
    assert sorted(tuple(r)[4:] for r in people.collect()) == [(1, "A", 10, 10, 11, 20, 10, 10, 9, 19), (2, "B", 10, 10, 31, 40, 10, 10, 26, 36)]
    assert sorted(tuple(r)[4:] for r in out["households"].collect()) == [(1, "A", 10, 10, -0.5, 9.5), (2, "B", 10, 10, 2, 12)]
    assert R.publish_names(out["jobs"], names).columns[6:] == ["emp2018", "emp2020", "emp_gro2050", "emp2050"]
    assert {"pop2050", "pop50", "hh2050", "emp50"} <= set(R.publish_names(out["rg_summary"], names).columns)
    found = [r for r in out["diagnostics"].collect() if r.check.startswith("zero weight")]
    assert [(r.table, '"emp"' in r.key and "2018" in r.key) for r in found] == [("unrolled", True)]
