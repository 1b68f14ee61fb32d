"""Readers, writers and reshapes round-trip through a temporary directory."""

import os
import tempfile

from pyspark.sql import functions as F

from stratum.operators import report as R
from stratum.operators import series as S
from stratum.sources import io, schemas as SC


def _tmp():
    return tempfile.mkdtemp(prefix="stratum-io-", dir="/tmp")


def test_read_table_by_suffix_and_schema(spark):
    d = _tmp()
    path = os.path.join(d, "xwalk.csv")
    with open(path, "w") as f:
        f.write("scheme,city_id,rg_id\nexisting,1,A\nexisting,2,B\n")
    df = io.read_table(spark, path, schema=SC.CROSSWALK)
    assert df.schema == SC.CROSSWALK
    assert sorted(r.city_id for r in df.collect()) == [1, 2]
    pq = os.path.join(d, "t.parquet")
    df.write.parquet(pq)
    assert io.read_table(spark, pq).count() == 2
    js = os.path.join(d, "t.json")
    df.write.json(js)
    assert io.read_table(spark, js).count() == 2


def test_totals_long_and_after_year(spark):
    wide = spark.createDataFrame([(2000, 10.0, 4.0, 5.0), (2017, 11.0, 4.5, 6.0), (2020, 12.0, 5.0, 7.0)],
                                 "Year int, HHPop double, HH double, Emp double")
    long = io.totals_long(wide)
    assert long.columns == ["scenario", "indicator", "year", "total"]
    assert long.count() == 9
    got = {(r.indicator, r.year): r.total for r in io.totals_long(wide, after_year=2016).collect()}
    assert got == {("hhpop", 2017): 11.0, ("hh", 2017): 4.5, ("emp", 2017): 6.0,
                   ("hhpop", 2020): 12.0, ("hh", 2020): 5.0, ("emp", 2020): 7.0}


def test_read_forecast_transposes_label_rows(spark):
    wide = spark.createDataFrame([
        ("Population", "", 100.0, 110.0, 120.0),
        ("", "Household Population", 95.0, 104.0, 113.0),
        ("Households", "", 40.0, 43.0, 46.0),
        ("Estimated Total Employment", "", 50.0, 55.0, 60.0),
        ("Other", "", 1.0, 1.0, 1.0)], "X1 string, X2 string, `2020Q2` double, `2025Q2` double, `2030Q2` double")
    out = {r.year: r for r in io.read_forecast(wide, [2025, 2030]).collect()}
    assert sorted(out) == [2025, 2030]
    assert (out[2030].pop, out[2030].hhpop, out[2030].hh, out[2030].emp) == (120.0, 113.0, 46.0, 60.0)


def test_write_tables_partitioned(spark):
    d = _tmp()
    df = spark.createDataFrame([("a", "x", 1, 2.0), ("b", "y", 2, 3.0)], "scenario string, scheme string, city_id long, v double")
    paths = io.write_tables({"people": df, "none": None}, d, run_date="2026-01-01")
    assert len(paths) == 1
    assert os.path.isdir(os.path.join(d, "people", "scenario=a", "scheme=x", "run_date=2026-01-01"))
    back = spark.read.parquet(os.path.join(d, "people"))
    assert back.count() == 2
    io.write_tables({"people": df}, d, fmt="csv")
    assert spark.read.option("header", True).csv(os.path.join(d, "people")).count() == 2


def test_year_names_and_rg_rename(spark):
    df = spark.createDataFrame([(1, "A", 1.0, 2.0, 3.0)], "city_id long, rg_id string, pop_ref double, pop_gro double, pop_target double")
    names = R.year_names(2000, 2016, 2050)
    out = R.publish_names(df, names, rg_name="RGID_Proposed")
    assert out.columns == ["city_id", "RGID_Proposed", "pop2000", "pop_gro1650", "pop2050"]
    assert names["hh_long"] == "hh0050" and names["emp_end"] == "emp50"


def test_series_wide_publishes_one_column_per_year(spark):
    long = spark.createDataFrame([("s", "x", "pop", 1, 2020, 1.0), ("s", "x", "pop", 1, 2025, 2.0)],
                                 "scenario string, scheme string, indicator string, geo_id long, year int, value double")
    w = S.series_wide(long, ["scenario", "scheme", "indicator"], [2020, 2025])
    assert w.columns[-2:] == ["2020", "2025"]
    assert w.first()["2025"] == 2.0


def test_null_keys_and_duplicates(spark):
    df = spark.createDataFrame([(1, "A"), (None, "B"), (2, "A")], "city_id long, rg_id string")
    good, diag = SC.split_null_keys(df, ["city_id"], "crosswalk")
    assert good.count() == 2 and diag.count() == 1
    dup = spark.createDataFrame([(1, "A"), (1, "B")], "city_id long, rg_id string")
    import pytest
    with pytest.raises(Exception, match="duplicate key"):
        SC.require_unique(dup, ["city_id"], "crosswalk").collect()
    assert SC.require_unique(good, ["city_id"], "crosswalk").count() == 2


def test_conform_fills_optional_columns(spark):
    df = spark.createDataFrame([(1, 3)], "city_id int, county int")
    out = SC.conform(df, SC.CITY_EMP, required=["city_id"])
    assert out.schema == SC.CITY_EMP
    assert out.first().annex is None
    assert out.where(F.col("city_id") == 1).count() == 1
