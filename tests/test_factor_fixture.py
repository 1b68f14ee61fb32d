"""FIXTURES §4: FACTOR worked example (same cities as §2, PPH = PPH2050, Annex = 0)."""

import pytest

from stratum.config import HierConfig
from stratum.plans import methods as M
from tests.fixtures_data import hier_inputs

HHPOP = [567.347418, 344.331768, 285.489828, 370.143453, 312.687533]


def _people(out):
    return {r.city_id: r for r in out["people"].collect()}


def test_tolerance_control(spark):
    out = M.run_factor(hier_inputs(spark), HierConfig(), "stock")
    p = _people(out)
    assert [p[c].hhpop_target for c in range(1, 6)] == pytest.approx(HHPOP, abs=1e-6)


def test_households_stock(spark):
    out = M.run_factor(hier_inputs(spark), HierConfig(), "stock")
    hh = {r.city_id: r.hh_target for r in out["households"].collect()}
    assert [hh[c] for c in range(1, 6)] == pytest.approx(
        [240.923138, 139.972542, 107.610126, 172.086266, 139.407928], abs=1e-6)


def test_households_growth(spark):
    out = M.run_factor(hier_inputs(spark), HierConfig(), "growth")
    hh = {r.city_id: r.hh_target for r in out["households"].collect()}
    assert [hh[c] for c in range(1, 6)] == pytest.approx(
        [245.830455, 141.477771, 113.478633, 163.242900, 135.970241], abs=1e-6)
    assert "hhpop_ref" in out["people"].columns


def test_factor_and_targets_diagnostics(spark):
    from pyspark.sql import functions as F
    inp = hier_inputs(spark)
    inp.city_pop = inp.city_pop.withColumn("pph", F.when(F.col("city_id") == 2, 0.0).otherwise(F.col("pph")))
    out = M.run_factor(inp, HierConfig(), "stock")
    checks = {(r.table, r.check, r.key) for r in out["diagnostics"].collect()}
    assert any(t == "households" and c == "households x/0 (pph = 0)" and '"city_id":2' in k for t, c, k in checks)
    clean = M.run_factor(hier_inputs(spark), HierConfig(), "stock")["diagnostics"]
    assert clean.count() == 0
    t = spark.createDataFrame([(1, 33, "1", "A", 1000.0, 5.0, 0.0, 0.0, 0.0),
                               (2, 33, "1", "B", 1000.0, 5.0, 2.5, 0.0, 0.0)],
                              "city_id long, county long, rg_id string, juris string, pop_target double, "
                              "gq_pct_target double, pph_target double, hh_base double, hhpop_base double")
    for c in ("emp_by", "emp_base", "emp_target", "pop_by", "pop_base", "hhpop_by", "hh_by"):
        t = t.withColumn(c, F.lit(1.0))
    d = M.run_targets(t, None, series=False)["diagnostics"].collect()
    assert [r.key for r in d] == ['{"scenario":"default","scheme":"default","county":33,"rg_id":"1","city_id":1}']


def test_tolerance_control_threshold_asymmetry(spark):
    """The denominator takes rows with no_gq != 0, scaling only rows with
    no_gq > 0.02; a city with 0 < no_gq <= 0.02 is in the first set only."""
    from stratum.operators.control import tolerance_control
    city = spark.createDataFrame(
        [("s", "x", 1, 100.0, 90.0, 10.0, 5.0), ("s", "x", 2, 50.0, 49.99, 10.0, 5.0),
         ("s", "x", 3, 20.0, 20.0, 10.0, 5.0)],
        "scenario string, scheme string, city_id long, pop_gro double, hhpop_gro double, "
        "hhpop_base double, hhpop_ref double")
    delta = spark.createDataFrame([("s", 200.0)], "scenario string, hhpop double")
    out = {r.city_id: r for r in tolerance_control(city, delta).collect()}
    f = (200 - 20) / (90 + 49.99)
    assert out[1].hhpop_factor == pytest.approx(f)
    assert out[1].hhpop_gro == pytest.approx(90 * f)
    assert out[2].hhpop_gro == pytest.approx(49.99)     # in the denominator, not scaled
    assert out[3].hhpop_gro == pytest.approx(20.0)      # no group quarters: not controlled
    assert out[1].hhpop_target == pytest.approx(90 * f + 10) and out[1].hhpop_long == pytest.approx(90 * f + 5)
