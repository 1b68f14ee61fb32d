"""FIXTURES §3 / §3b: interpolation, adjustment and whole-number rounding."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators import series as S
from tests.fixtures_data import series_anchors, totals

KEYS = ["scenario", "scheme", "indicator"]
YEARS = [2018, 2020, 2025, 2030, 2035, 2040, 2044, 2050]
TOT = [(2025, 180), (2030, 190), (2035, 200), (2040, 340), (2044, 215), (2050, 230)]


def _wide(df, years):
    return {r.geo_id: [r[f"v_{y}"] for y in years] for r in df.collect()}


def _long(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.geo_id, {})[r.year] = r.value
    return out


def test_interpolate_raw(spark):
    w = _wide(S.interpolate(series_anchors(spark), KEYS, [2018, 2020, 2050], YEARS), YEARS)
    assert w[1] == pytest.approx([100, 110, 115, 120, 125, 130, 134, 140])
    assert w[2] == pytest.approx([50, 50, 55, 60, 65, 70, 74, 80])
    assert w[3] == pytest.approx([10, 8, 7, 6, 5, 4, 3.2, 2])


def test_adjust_after_first(spark):
    tot = totals(spark, TOT)
    w = S.fit_series(series_anchors(spark), KEYS, [2018, 2020, 2050], YEARS, tot, "after_first")
    got = _wide(w, YEARS)
    assert got[1] == pytest.approx([100, 110, 116.666667, 122.222222, 127.777778, 205.555556,
                                    136.111111, 144.444444], abs=1e-6)
    assert got[2] == pytest.approx([50, 50, 56.666667, 62.222222, 67.777778, 145.555556,
                                    76.111111, 84.444444], abs=1e-6)
    assert got[3] == pytest.approx([10, 8, 6.666667, 5.555556, 4.444444, 0, 2.777778, 1.111111], abs=1e-6)


def test_round_to_total_largest_remainder(spark):
    tot = totals(spark, TOT)
    w = S.fit_series(series_anchors(spark), KEYS, [2018, 2020, 2050], YEARS, tot, "after_first")
    got = _long(S.unroll(w, KEYS, YEARS, tot))
    assert [got[1][y] for y in YEARS] == [100, 110, 116, 122, 128, 199, 136, 145]
    assert [got[2][y] for y in YEARS] == [50, 50, 57, 62, 68, 141, 76, 84]
    assert [got[3][y] for y in YEARS] == [10, 8, 7, 6, 4, 0, 3, 1]
    for y, t in TOT:
        assert sum(got[g][y] for g in got) == t


def test_round_to_total_draw(spark):
    tot = totals(spark, TOT)
    w = S.fit_series(series_anchors(spark), KEYS, [2018, 2020, 2050], YEARS, tot, "after_first")
    a = S.unroll(w, KEYS, YEARS, tot, method="draw", seed=7)
    got = _long(a)
    for y, t in TOT:
        assert sum(got[g][y] for g in got) == t
    for g in got:
        assert all(float(v).is_integer() for v in got[g].values())
    again = _long(S.unroll(w.repartition(3), KEYS, YEARS, tot, method="draw", seed=7))
    assert again == got


def test_interior_relabel_end_year(spark):
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("scenario", T.StringType()), ("scheme", T.StringType()), ("indicator", T.StringType()),
        ("geo_id", T.LongType()), ("a_2016", T.DoubleType()), ("a_2050", T.DoubleType())]])
    anchors = spark.createDataFrame([("s", "x", "pop", 1, 100.0, 440.0),
                                     ("s", "x", "pop", 2, 50.0, 50.0)], schema)
    years = [2016, 2020, 2025, 2030, 2035, 2040, 2045, 2050]
    tot = totals(spark, [(2017, 153), (2020, 200), (2025, 240), (2030, 290), (2035, 340),
                         (2040, 390), (2045, 440), (2050, 500)])
    w = S.fit_series(anchors, KEYS, [2016, 2050], years, tot, "interior")
    raw = _wide(w, years)
    assert raw[1] == pytest.approx([100, 150, 190, 240, 290, 340, 390, 440])
    assert raw[2] == pytest.approx([50] * 8)
    got = _long(S.unroll(w, KEYS, years, tot, relabel={2016: 2017}))
    ys = [2017] + years[1:]
    assert [got[1][y] for y in ys] == [102, 150, 190, 240, 290, 340, 390, 449]
    assert [got[2][y] for y in ys] == [51, 50, 50, 50, 50, 50, 50, 51]


def test_interior_missing_total_is_error(spark):
    tot = totals(spark, [(2025, 180)])
    w = S.fit_series(series_anchors(spark), KEYS, [2018, 2020, 2050], YEARS, tot, "interior")
    with pytest.raises(Exception, match="no regional total"):
        w.collect()


def test_missing_anchor_dropped(spark):
    df = series_anchors(spark).withColumn("a_2020", F.when(F.col("geo_id") == 1, None).otherwise(F.col("a_2020")))
    w = _wide(S.interpolate(df, KEYS, [2018, 2020, 2050], [2018, 2020, 2050, 2060]), [2018, 2020, 2050, 2060])
    assert w[1][:3] == pytest.approx([100, 100 + 40 * 2 / 32, 140])
    assert w[1][3] is None
    one = series_anchors(spark).withColumn("a_2020", F.lit(None).cast("double")) \
                               .withColumn("a_2050", F.lit(None).cast("double"))
    assert all(v is None for v in _wide(S.interpolate(one, KEYS, [2018, 2020, 2050], [2018]), [2018])[1])


def test_anchors_from_long_sums_duplicates(spark):
    """Duplicate rows of a geography are summed per anchor year; a missing
    value makes that anchor missing (strict), which interpolation then skips."""
    long = spark.createDataFrame(
        [("s", "x", "pop", 1, 2018, 60.0), ("s", "x", "pop", 1, 2018, 40.0), ("s", "x", "pop", 1, 2020, 110.0),
         ("s", "x", "pop", 1, 2050, 140.0), ("s", "x", "pop", 2, 2018, 50.0), ("s", "x", "pop", 2, 2020, None),
         ("s", "x", "pop", 2, 2050, 80.0), ("s", "x", "pop", 2, 2030, 999.0)],
        "scenario string, scheme string, indicator string, city_id long, year int, value double")
    a = S.anchors_from_long(long, KEYS, "city_id", "year", "value", [2018, 2020, 2050])
    got = {r.geo_id: (r.a_2018, r.a_2020, r.a_2050) for r in a.collect()}
    assert got == {1: (100.0, 110.0, 140.0), 2: (50.0, None, 80.0)}
    w = _wide(S.interpolate(a, KEYS, [2018, 2020, 2050], [2020, 2034]), [2020, 2034])
    assert w[2] == pytest.approx([50 + 30 * 2 / 32, 50 + 30 * 16 / 32])


def test_lookup_join(spark):
    from stratum.operators.joins import lookup
    df = spark.createDataFrame([(1, "a"), (2, "b")], "city_id long, x string")
    names = spark.createDataFrame([(1, "One")], "city_id long, juris string")
    got = {r.city_id: r.name for r in lookup(df, names, "city_id", {"name": "juris"}).collect()}
    assert got == {1: "One", 2: None}


def test_interpolation_matches_numpy_on_random_anchors(spark):
    """H2 against numpy.interp: random anchors (some missing), years inside
    and outside the anchor range; fewer than two anchors -> NULL series."""
    import numpy as np
    from pyspark.sql import types as T
    rng = np.random.default_rng(9)
    anchor_years = [2018, 2020, 2030, 2050]
    years = [2015, 2018, 2019, 2020, 2025, 2030, 2044, 2050, 2055]
    rows = []
    for g in range(300):
        vals = [None if rng.random() < 0.25 else float(rng.uniform(-50, 500)) for _ in anchor_years]
        rows.append(("s", "x", "pop", g, *vals))
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("scenario", T.StringType()), ("scheme", T.StringType()), ("indicator", T.StringType()),
        ("geo_id", T.LongType())] + [(f"a_{y}", T.DoubleType()) for y in anchor_years]])
    got = _wide(S.interpolate(spark.createDataFrame(rows, schema), KEYS, anchor_years, years), years)
    for r in rows:
        pts = [(y, v) for y, v in zip(anchor_years, r[4:]) if v is not None]
        for y, v in zip(years, got[r[3]]):
            if len(pts) < 2 or y < pts[0][0] or y > pts[-1][0]:
                assert v is None
            else:
                assert v == pytest.approx(float(np.interp(y, [p[0] for p in pts], [p[1] for p in pts])))


def test_assemble_inner_vs_outer(spark):
    """C8 keeps (geo, year) present for every indicator; C9 keeps all, with NULLs."""
    long = spark.createDataFrame(
        [("s", "x", "hh", 1, 2020, 5.0), ("s", "x", "emp", 1, 2020, 7.0), ("s", "x", "hh", 2, 2020, 3.0)],
        "scenario string, scheme string, indicator string, geo_id long, year int, value double")
    inner = S.assemble(long, KEYS, ("hh", "emp"), "inner", "city_id").collect()
    outer = {r.city_id: (r.total_hh, r.total_emp) for r in S.assemble(long, KEYS, ("hh", "emp"), "outer").withColumnRenamed("geo_id", "city_id").collect()}
    assert [(r.city_id, r.total_hh, r.total_emp) for r in inner] == [(1, 5.0, 7.0)]
    assert outer == {1: (5.0, 7.0), 2: (3.0, None)}
