"""FIXTURES §2: HIER worked example, exact values."""

import pytest

from stratum.config import HierConfig
from stratum.plans import methods as M
from tests.fixtures_data import hier_inputs

CFG = HierConfig()


def _by(df, key):
    return {r[key]: r for r in df.collect()}


def test_rg_growth(spark):
    g = _by(M.rg_growth(hier_inputs(spark), CFG), "rg_id")
    rows = {(r.county, r.rg_id): (r.pop_gro_rg, r.emp_gro_rg) for r in M.rg_growth(hier_inputs(spark), CFG).collect()}
    assert rows[(33, "1")] == pytest.approx((360, 224))
    assert rows[(33, "2")] == pytest.approx((120, 56))
    assert rows[(53, "1")] == pytest.approx((320, 120))
    assert g


def test_hier_chain(spark):
    out = M.run_hier(hier_inputs(spark), CFG)
    county = {r.county: r for r in out["county_levels"].collect()}
    assert county[33].hhpop_target == pytest.approx(1189.030963, abs=1e-6)
    assert county[53].hhpop_target == pytest.approx(690.969037, abs=1e-6)
    assert county[33].hh_target == pytest.approx(498.012454, abs=1e-6)
    assert county[53].hh_target == pytest.approx(301.987546, abs=1e-6)
    rg = {(r.county, r.rg_id): r for r in out["rg_levels"].collect()}
    assert [rg[k].hhpop_target for k in [(33, "1"), (33, "2"), (53, "1")]] == pytest.approx(
        [903.663532, 285.367431, 690.969037], abs=1e-6)
    assert [rg[k].hh_target for k in [(33, "1"), (33, "2"), (53, "1")]] == pytest.approx(
        [385.608389, 112.404065, 301.987546], abs=1e-6)
    people = {r.city_id: r for r in out["people"].collect()}
    jobs = {r.city_id: r for r in out["jobs"].collect()}
    hh = {r.city_id: r for r in out["households"].collect()}
    exp = {1: (134.4, 384.4, 240, 600, 230.4, 562.569040, 243.737671),
           2: (89.6, 209.6, 120, 360, 116.4, 341.094492, 141.870718),
           3: (56.0, 116.0, 120, 300, 117.6, 285.367431, 112.404065),
           4: (96.0, 206.0, 160, 400, 150.4, 371.660616, 165.764566),
           5: (24.0, 84.0, 160, 340, 152.0, 319.308422, 136.222980)}
    for c, e in exp.items():
        got = (jobs[c].emp_gro, jobs[c].emp_target, people[c].pop_gro, people[c].pop_target,
               people[c].hhpop_gro, people[c].hhpop_target, hh[c].hh_target)
        assert got == pytest.approx(e, abs=1e-6), c
    assert sum(r.hhpop_target for r in people.values()) == pytest.approx(1880)
    assert sum(r.hh_target for r in hh.values()) == pytest.approx(800)
    assert people[1].juris == "City 1"


def test_rg_without_job_cities_drops_out(spark):
    """Level tables merge the jobs and people aggregates: an RG without job
    cities is not raked and its cities get NULL household population."""
    from pyspark.sql import functions as F
    inp = hier_inputs(spark)
    inp.city_emp = inp.city_emp.where(F.col("city_id") != 3)   # RG (33, 2) has no job city left
    out = M.run_hier(inp, CFG)
    rg = {(r.county, r.rg_id) for r in out["rg_levels"].collect()}
    assert rg == {(33, "1"), (53, "1")}
    people = {r.city_id: r for r in out["people"].collect()}
    assert people[3].hhpop_target is None
    assert people[1].hhpop_target is not None


def test_growth_floor_worked_example(spark):
    """RG A planned 100 but already grew 150 -> raised to 150; the county's
    deficit of 50 is taken from B and C by their share of planned growth
    (200:100); the county total plan stays 400.  County 2 has no short RG."""
    from stratum.operators.allocate import growth_floor
    plan = spark.createDataFrame(
        [("s", 1, "A", 100.0), ("s", 1, "B", 200.0), ("s", 1, "C", 100.0), ("s", 2, "A", 50.0)],
        "scenario string, county long, rg_id string, plan double")
    observed = spark.createDataFrame(
        [("x", 1, "A", 150.0), ("x", 1, "B", 20.0), ("x", 1, "C", 10.0), ("x", 2, "A", 5.0)],
        "scheme string, county long, rg_id string, observed double")
    got = {(r.county, r.rg_id): r.pop_gro_rg for r in growth_floor(plan, observed, "pop").collect()}
    assert got[(1, "A")] == pytest.approx(0.0)
    assert got[(1, "B")] == pytest.approx(200 - 50 * 2 / 3 - 20)
    assert got[(1, "C")] == pytest.approx(100 - 50 / 3 - 10)
    assert got[(2, "A")] == pytest.approx(45.0)
    assert sum(got[(1, k)] for k in "ABC") + 180 == pytest.approx(400)
