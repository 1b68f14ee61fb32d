"""Seeded draws against a plain re-computation, anchors as rows against the
wide form, and TARGETS in one pass."""

import bisect
import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratum.config import TargetsConfig
from stratum.operators import series as S
from stratum.plans import methods as M
from tests.fixtures_data import series_anchors, totals

KEYS = ["scenario", "scheme", "indicator"]
LONG = "scenario string, scheme string, indicator string, geo_id long, year int, value double"
YEARS = (2018, 2020, 2025, 2030, 2035, 2040, 2044, 2050)


def drawn(weights, d, seed, group):
    """``|d|`` draws: hits by geography, from the digest of (seed, group, draw)."""
    ids = [g for g in sorted(weights) if weights[g] > 0]
    los, total = [], 0
    for g in ids:
        los.append(total)
        total += weights[g]
    hits = Counter()
    for n in range(1, abs(int(d)) + 1):
        u = int(hashlib.md5("|".join(map(str, (seed, *group, n))).encode()).hexdigest()[:13], 16) / 2 ** 52
        hits[ids[bisect.bisect_right(los, math.floor(u * total)) - 1]] += 1
    return hits


@pytest.mark.parametrize("partitions", [1, 7])
def test_draw_with_a_dominant_geography(spark, partitions):
    """One geography with nearly all weight among thousands, many draws, a
    negative residual, a group without weight: equal to the plain draw."""
    rng = random.Random(4)
    groups = {("s", "x", "pop", 2020): ({g: (900_000 if g == 77 else rng.randint(0, 3)) for g in range(3000)}, 2500),
              ("s", "x", "pop", 2021): ({g: rng.randint(0, 50) for g in range(400)}, -900), ("s", "x", "hh", 2020): ({g: 0 for g in range(5)}, 7),
              ("s", "y", "hh", 2020): ({3: 1}, 40)}
    rows = [(*k[:3], g, k[3], float(v)) for k, (ws, _) in groups.items() for g, v in ws.items()]
    tot = [(*k, float(sum(ws.values()) + d)) for k, (ws, d) in groups.items()]
    long = spark.createDataFrame(rows, LONG).repartition(partitions)
    t = spark.createDataFrame(tot, "scenario string, scheme string, indicator string, year int, total double")
    out = S.round_to_total(long, KEYS, t, method="draw", seed=9)
    got = {(r.scenario, r.scheme, r.indicator, r.year, r.geo_id): r.value for r in out.collect()}
    assert len(got) == len(rows)
    for k, (ws, d) in groups.items():
        hits = drawn(ws, d, 9, k) if sum(ws.values()) else Counter()
        for g, w in ws.items():
            assert got[(*k, g)] == w + (1 if d > 0 else -1) * hits[g]


def test_draw_plan_makes_no_list_by_geography(spark):
    long = spark.createDataFrame([("s", "x", "pop", g, 2020, float(g)) for g in range(50)], LONG)
    t = spark.createDataFrame([("s", "x", "pop", 2020, 1300.0)], "scenario string, scheme string, indicator string, year int, total double")
    plan = S.round_to_total(long, KEYS, t, method="draw", seed=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" not in plan and "Generate" not in plan          # the draws were made before the merge was staged


def as_rows(wide):
    return wide.select(*KEYS, "geo_id", F.inline(F.array(*[F.struct(F.lit(y).alias("year"), F.col(f"a_{y}").alias("value")) for y in (2018, 2020, 2050)])))


@pytest.mark.parametrize("mode", [None, "after_first", "interior"])
def test_anchor_rows_equal_the_wide_form(spark, mode):
    wide = series_anchors(spark)
    more = spark.createDataFrame([("s", "x", "pop", 3, None, 4.0, 1.0), ("s", "x", "hh", 4, 5.0, None, 9.0), ("s", "x", "hh", 5, None, None, 9.0), ("s", "x", "hh", 6, None, None, None)],
                                 wide.schema)
    wide = wide.unionByName(more) if mode is None else wide           # a duplicate geography, missing anchors
    t = totals(spark, [(2020, 170), (2025, 180), (2030, 190), (2035, 200), (2040, 340), (2044, 215), (2050, 230)])
    a = S.to_long(S.adjust_to_totals(S.interpolate(wide, KEYS, (2018, 2020, 2050), YEARS), KEYS, YEARS, t if mode else None, mode or ""), KEYS, YEARS)
    b = S.adjust_rows(S.interpolate_rows(as_rows(wide), KEYS, YEARS), KEYS, t if mode else None, mode or "")
    key = lambda df: {(r.indicator, r.geo_id, r.year): r.value for r in df.collect()}
    a, b = key(a), key(b)
    assert set(a) == set(b) and len(a) == len(YEARS) * (6 if mode is None else 3)
    for k, v in a.items():
        assert b[k] == (pytest.approx(v, abs=1e-9) if v is not None else None), k


def test_anchor_years_and_fitted_years_by_scenario(spark):
    rows = [("a", "x", "pop", 1, 2000, 10.0), ("a", "x", "pop", 1, 2010, 20.0), ("b", "x", "pop", 1, 2002, 5.0), ("b", "x", "pop", 1, 2004, 9.0), ("b", "x", "pop", 1, 2005, 9.0),
            ("b", "x", "pop", 2, 2002, 1.0)]
    fit = spark.createDataFrame([("a", 2000), ("a", 2005), ("a", 2011), ("b", 2001), ("b", 2003), ("b", 2005)], "scenario string, year int")
    got = {(r.scenario, r.geo_id, r.year): r.value for r in S.interpolate_rows(spark.createDataFrame(rows, LONG), KEYS, fit).collect()}
    assert got == {("a", 1, 2000): 10.0, ("a", 1, 2005): 15.0, ("a", 1, 2011): None, ("b", 1, 2001): None, ("b", 1, 2003): 7.0, ("b", 1, 2005): 9.0,
                   ("b", 2, 2001): None, ("b", 2, 2003): None, ("b", 2, 2005): None}


def test_interior_rows_need_every_total(spark):
    long = S.interpolate_rows(as_rows(series_anchors(spark)), KEYS, YEARS)
    with pytest.raises(Exception, match="no regional total for year 2020"):
        S.adjust_rows(long, KEYS, totals(spark, [(2025, 180)]), "interior").collect()


def targets_table(spark, n=40):
    rng = random.Random(6)
    rows = [(i, i % 4, f"r{i % 3}", f"c{i}", *[float(rng.randint(1, 900)) for _ in range(14)]) for i in range(n)]
    names = "emp_by emp_base emp_gro emp_target pop_by pop_base pop_gro pop_target hhpop_by hhpop_base hh_by hh_base gq_pct_target pph_target".split()
    df = spark.createDataFrame(rows, "city_id long, county long, rg_id string, juris string, " + ", ".join(f"{c} double" for c in names))
    return df.withColumns({"gq_pct_target": F.lit(5.0), "pph_target": F.lit(2.5)})


def test_targets_in_one_pass_equals_two(spark):
    """The published years of the yearly series are the published series."""
    df, cfg = targets_table(spark), TargetsConfig(annual_years=tuple(range(2018, 2051)))
    t = spark.createDataFrame([("default", i, y, 20000.0 + 10 * y) for i in cfg.indicators for y in range(2021, 2051, 3)],
                              "scenario string, indicator string, year int, total double")
    both, one = M.run_targets(df, t, cfg), M.run_targets(df, t, cfg, annual=False)
    key = lambda x: sorted(map(tuple, x.select("subreg_id", "year", *[f"total_{i}" for i in cfg.indicators]).collect()))
    assert key(both["unrolled"]) == key(one["unrolled"])
    assert both["annual_unrolled"].count() == 40 * 33 and both["unrolled_regional"].count() == 33
    assert {f"v_{y}" for y in YEARS} < set(both["series"].columns) and "v_2021" not in both["series"].columns
    years = both["annual_unrolled"].where(F.col("year").isin(*YEARS))
    assert key(years) == key(both["unrolled"])


def test_targets_whose_anchors_are_not_fitted_take_two_passes(spark):
    df, cfg = targets_table(spark), TargetsConfig(years_to_fit=(2018, 2025, 2050), annual_years=tuple(range(2018, 2051)))
    out = M.run_targets(df, None, cfg)
    assert out["unrolled"].count() == 120 and out["annual_unrolled"].count() == 40 * 33


def test_scheme_of_the_crosswalk_gives_the_groups(spark):
    df = targets_table(spark)
    crosswalk = spark.createDataFrame([(s, i, f"{s}{i % k}") for s, k in (("p", 2), ("q", 5)) for i in range(30)], "scheme string, city_id long, rg_id string")
    out = M.run_targets(df, None, TargetsConfig(), series=False, crosswalk=crosswalk)
    groups = {(r.scheme, r.rg_id) for r in out["rg_summary"].collect()}
    assert groups == {("p", "p0"), ("p", "p1")} | {("q", f"q{i}") for i in range(5)}
    assert out["people"].count() == 60            # areas outside the crosswalk drop out
