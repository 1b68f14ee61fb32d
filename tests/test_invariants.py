"""Invariants on seeded random trees.

200 random hierarchies run as 200 scenarios of one job; every check is per
scenario.  Also: the null/zero rules of SURVEY §1 and FIXTURES §3c.
"""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratum.config import HierConfig
from stratum.functions import expr as X
from stratum.operators import control as C
from stratum.operators import series as S
from stratum.plans import methods as M
from stratum.sources import schemas as SC

N_CASES = 200
CFG = HierConfig()


def random_inputs(spark, n_cases=N_CASES, seed=7):
    rng = np.random.default_rng(seed)
    ref, rc, rr, xw, names, emp, pop, tot = [], [], [], [], [], [], [], []
    for s in range(n_cases):
        sc = f"s{s}"
        p16, e16 = rng.uniform(1000, 2000), rng.uniform(500, 1000)
        p50, e50 = p16 * rng.uniform(0.9, 1.6), e16 * rng.uniform(0.9, 1.6)
        ref += [(sc, 2000, p16 * 0.9, p16 * 0.85, p16 * 0.35, e16 * 0.9),
                (sc, 2016, p16, p16 * 0.95, p16 * 0.4, e16),
                (sc, 2050, p50, p50 * 0.94, p50 * 0.41, e50)]
        n_c = int(rng.integers(1, 4))
        cs = rng.dirichlet(np.ones(n_c))
        ce = rng.dirichlet(np.ones(n_c))
        city = s * 1000
        for c in range(n_c):
            rc.append((sc, c, float(cs[c]), float(ce[c]), float(rng.uniform(0, .1)), float(rng.uniform(2, 3))))
            n_r = int(rng.integers(1, 4))
            rs, re_ = rng.dirichlet(np.ones(n_r)), rng.dirichlet(np.ones(n_r))
            for r in range(n_r):
                rr.append((sc, c, f"r{r}", float(rs[r]), float(re_[r]), float(rng.uniform(0, .1)),
                           float(rng.uniform(2, 3))))
                for _ in range(int(rng.integers(1, 5))):
                    city += 1
                    xw.append((sc, "x", city, f"r{r}"))
                    names.append((city, f"c{city}"))
                    pb = float(rng.uniform(10, 200))
                    eb = float(rng.uniform(5, 100))
                    gq = float(rng.uniform(0, .08))
                    pph = float(rng.uniform(1.8, 3.2))
                    emp.append((sc, city, c, eb * .9, eb, float(rng.uniform(1, 50)),
                                float(rng.choice([0.0, 5.0])), 0.0))
                    pop.append((sc, city, c, pb * .9, pb, float(rng.uniform(1, 50)), pb * .9 * (1 - gq),
                                pb * (1 - gq), pb * .9 * (1 - gq) / pph, pb * (1 - gq) / pph, gq,
                                float(rng.uniform(0, .1)), pph, 0.0, pph))
        for y in CFG.years_to_fit[1:-1] + (2017, 2050):
            frac = (y - 2016) / 34
            tot += [(sc, "hhpop", y, (p16 * .95) * (1 - frac) + (p50 * .94) * frac + rng.uniform(-20, 20)),
                    (sc, "hh", y, (p16 * .4) * (1 - frac) + (p50 * .41) * frac + rng.uniform(-10, 10)),
                    (sc, "emp", y, e16 * (1 - frac) + e50 * frac + rng.uniform(-10, 10))]
    sch = lambda base: "scenario string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in base.fields if f.name != "scenario")
    return M.HierInputs(
        ref=spark.createDataFrame(ref, SC.REF), rgs_county=spark.createDataFrame(rc, SC.RGS_COUNTY),
        rgs_rg=spark.createDataFrame(rr, SC.RGS_RG),
        crosswalk=spark.createDataFrame(xw, "scenario string, scheme string, city_id long, rg_id string"),
        names=spark.createDataFrame(names, SC.NAMES),
        city_emp=spark.createDataFrame(emp, sch(SC.CITY_EMP)), city_pop=spark.createDataFrame(pop, sch(SC.CITY_POP)),
        totals=spark.createDataFrame(tot, SC.TOTALS))


@pytest.fixture(scope="module")
def hier(spark):
    inp = random_inputs(spark)
    out = M.run_hier(inp, CFG)
    return inp, {k: out[k].toPandas() for k in ("people", "households", "jobs", "rg_levels", "county_levels",
                                                 "unrolled")}


def test_growth_adds_up(hier):
    inp, o = hier
    ref = inp.ref.toPandas().pivot(index="scenario", columns="year")
    d_pop = ref[("pop", 2050)] - ref[("pop", 2016)]
    d_emp = ref[("emp", 2050)] - ref[("emp", 2016)]
    assert o["people"].groupby("scenario").pop_gro.sum().reindex(d_pop.index).values == pytest.approx(d_pop.values)
    assert o["jobs"].groupby("scenario").emp_gro.sum().reindex(d_emp.index).values == pytest.approx(d_emp.values)


def test_raked_children_add_to_parents(hier):
    inp, o = hier
    ref = inp.ref.toPandas()
    r50 = ref[ref.year == 2050].set_index("scenario")
    city, rg, co = o["people"], o["rg_levels"], o["county_levels"]
    k_rg = ["scenario", "county", "rg_id"]
    for m in ("hhpop_target", "hh_target"):
        src = city if m == "hhpop_target" else city.merge(o["households"][["scenario", "city_id", "hh_target"]])
        by_rg = src.groupby(k_rg)[m].sum()
        assert by_rg.values == pytest.approx(rg.set_index(k_rg)[m].reindex(by_rg.index).values)
        by_co = rg.groupby(["scenario", "county"])[m].sum()
        assert by_co.values == pytest.approx(co.set_index(["scenario", "county"])[m].reindex(by_co.index).values)
        reg = co.groupby("scenario")[m].sum()
        col = "hhpop" if m == "hhpop_target" else "hh"
        assert reg.values == pytest.approx(r50[col].reindex(reg.index).values)


def test_rounded_series_whole_and_add_to_totals(hier):
    inp, o = hier
    u = o["unrolled"]
    for c in ("total_hhpop", "total_hh", "total_emp"):
        assert (u[c] == u[c].round()).all()
    tot = inp.totals.toPandas()
    for ind in ("hhpop", "hh", "emp"):
        got = u.groupby(["scenario", "year"])[f"total_{ind}"].sum()
        t = tot[tot.indicator == ind].set_index(["scenario", "year"]).total.round()
        common = got.index.intersection(t.index)
        assert len(common) == N_CASES * len(CFG.years_to_fit)
        assert (got[common] == np.rint(t[common])).all()


def test_interpolation_hits_anchors_and_totals(spark, hier):
    inp, o = hier
    people = spark.createDataFrame(o["people"][["scenario", "scheme", "city_id", "hhpop_base", "hhpop_target"]])
    anchors = S.stack_anchors({"hhpop": (people, {2016: "hhpop_base", 2050: "hhpop_target"})},
                              ["scenario", "scheme"], "city_id")
    keys = ["scenario", "scheme", "indicator"]
    raw = S.interpolate(anchors, keys, (2016, 2050), CFG.years_to_fit).toPandas()
    m = raw.merge(o["people"], left_on=["scenario", "geo_id"], right_on=["scenario", "city_id"])
    assert m.v_2016.values == pytest.approx(m.hhpop_base.values)
    assert m.v_2050.values == pytest.approx(m.hhpop_target.values)
    adj = S.fit_series(anchors, keys, (2016, 2050), CFG.years_to_fit, inp.totals, "interior").toPandas()
    tot = inp.totals.toPandas().query("indicator == 'hhpop'").set_index(["scenario", "year"]).total
    for y in CFG.years_to_fit[1:-1]:
        g = adj.groupby("scenario")
        clipped = g[f"v_{y}"].min() <= 0
        sums = g[f"v_{y}"].sum()
        ok = sums[~clipped]
        assert ok.values == pytest.approx(tot.xs(y, level="year").reindex(ok.index).values)


def test_scenario_independence(spark):
    inp = random_inputs(spark, n_cases=3, seed=11)
    both = M.run_hier(inp, CFG)["unrolled"].where(F.col("scenario") == "s1").toPandas()
    one = M.HierInputs(*[None if t is None else (t.where(F.col("scenario") == "s1") if "scenario" in t.columns else t)
                         for t in (inp.ref, inp.rgs_county, inp.rgs_rg, inp.crosswalk, inp.names, inp.city_emp,
                                   inp.city_pop, inp.totals)])
    alone = M.run_hier(one, CFG)["unrolled"].toPandas()
    key = ["city_id", "year"]
    pd.testing.assert_frame_equal(both.sort_values(key).reset_index(drop=True),
                                  alone.sort_values(key).reset_index(drop=True)[both.columns])


def test_null_zero_rules(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 2.0), (3.0, None), (6.0, 3.0)], "n double, d double")
    got = df.select(X.ratio0("n", "d").alias("r0"), X.ratio("n", "d").alias("r")).collect()
    assert [r.r0 for r in got] == [None, 0.0, 0.0, 0.0, 2.0]
    assert [r.r for r in got] == [None, None, None, None, 2.0]
    g = spark.createDataFrame([(1, 1.0), (1, None), (2, 2.0), (2, 3.0)], "k int, x double")
    sums = {r.k: r.s for r in g.groupBy("k").agg(X.strict_sum("x").alias("s")).collect()}
    assert sums == {1: None, 2: 5.0}
    v = spark.createDataFrame([(2.5,), (3.5,), (-2.5,), (-1.0,), (None,)], "x double")
    out = v.select(X.half_even("x").alias("h"), X.clip0("x").alias("c")).collect()
    assert [r.h for r in out] == [2.0, 4.0, -2.0, -1.0, None]
    assert [r.c for r in out] == [2.5, 3.5, 0.0, 0.0, None]


def test_targets_end_points_fixture(spark):
    """FIXTURES §3c."""
    df = spark.createDataFrame([(1000.0, 5.0, 2.5), (0.0, 5.0, 0.0), (1000.0, None, 2.5), (1000.0, 5.0, 0.0)],
                               "pop_target double, gq_pct_target double, pph_target double") \
        .withColumn("hh_base", F.lit(0.0)).withColumn("hhpop_base", F.lit(0.0))
    got = [(r.hhpop_target, r.hh_target) for r in C.households_from_targets(df).collect()]
    assert got == [(950.0, 380.0), (0.0, 0.0), (None, 0.0), (950.0, None)]


def test_diagnostics_and_total_rows(spark):
    from stratum.sources import io
    from tests.fixtures_data import hier_inputs

    def checks_for(change):
        inp = hier_inputs(spark)
        inp.city_pop = change(inp.city_pop)
        out = M.run_hier(inp, CFG)
        return {(r.table, r.check) for r in out["diagnostics"].collect()}, out

    # city 3 alone in RG (33, 2) gets zero weight
    zero, out = checks_for(lambda d: d.withColumn(
        "target", F.when(F.col("city_id") == 3, 0.0).otherwise(F.col("target"))))
    assert ("people", "zero group weight (share 0/0)") in zero
    assert {r.city_id: r.pop_gro for r in out["people"].collect()}[3] is None
    # city 5 gets PPH = 0 with household population > 0
    pph0, _ = checks_for(lambda d: d.withColumn(
        "pph_target", F.when(F.col("city_id") == 5, 0.0).otherwise(F.col("pph_target"))))
    assert ("people", "households x/0 (pph = 0, hhpop != 0)") in pph0
    assert ("people", "zero group weight (share 0/0)") not in pph0
    clean, _ = checks_for(lambda d: d)
    assert clean == set()
    sheet = spark.createDataFrame([(2016, 1.0), (2050, 2.0), (None, 3.0)], "Year int, Pop double")
    assert io.without_total_rows(sheet, ["Year"]).count() == 2


def test_single_geography_series(spark):
    """The reference fails with one geography and totals; here it hits the totals."""
    anchors = spark.createDataFrame([("s", "x", "pop", 1, 100.0, 200.0)],
                                    "scenario string, scheme string, indicator string, geo_id long, "
                                    "a_2016 double, a_2050 double")
    years = [2016, 2020, 2030, 2050]
    tot = spark.createDataFrame([("s", "pop", 2020, 130.0), ("s", "pop", 2030, 150.0), ("s", "pop", 2050, 201.0)],
                                SC.TOTALS)
    w = S.fit_series(anchors, ["scenario", "scheme", "indicator"], (2016, 2050), years, tot, "after_first").first()
    assert (w.v_2020, w.v_2030, w.v_2050) == pytest.approx((130.0, 150.0, 201.0))


def test_positive_growth_control_with_shrinking_cities(spark):
    city = spark.createDataFrame(
        [("s", "x", 1, 10.0, 100.0, 90.0), ("s", "x", 2, 30.0, 50.0, 45.0), ("s", "x", 3, -20.0, 80.0, 85.0)],
        "scenario string, scheme string, city_id long, hh_gro double, hh_base double, hh_ref double")
    delta = spark.createDataFrame([("s", 60.0)], "scenario string, hh double")
    out = {r.city_id: r for r in C.positive_growth_control(city, delta).collect()}
    assert out[1].hh_factor == pytest.approx(1.5)
    assert out[3].hh_gro == -20.0                      # shrinking city untouched
    assert sum(r.hh_gro for r in out.values()) == pytest.approx(60.0 - 20.0)
    assert out[1].hh_target == pytest.approx(115.0) and out[1].hh_long == pytest.approx(25.0)
