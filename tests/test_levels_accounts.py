"""Raking over an ordered list of levels, and the balance sheet of a series."""

import pytest

from stratum.config import HierConfig
from stratum.operators import control as C
from stratum.operators import series as S
from stratum.plans import methods as M
from tests.fixtures_data import hier_inputs, series_anchors, totals

KEYS = ["scenario", "scheme", "indicator"]
YEARS = (2018, 2020, 2025, 2030, 2035, 2040, 2044, 2050)


def four_levels(spark):
    city = spark.createDataFrame(
        [("s", "x", "a1", "c1", "r1", 1, 100.0, 0.0, 2.5), ("s", "x", "a1", "c1", "r1", 2, 100.0, 0.0, 5.0), ("s", "x", "a1", "c1", "r2", 3, 200.0, 0.0, 2.0),
         ("s", "x", "a1", "c2", "r3", 4, 100.0, 0.0, 3.0), ("s", "x", "a2", "c3", "r4", 5, 300.0, 0.0, 2.0)],
        "scenario string, scheme string, area string, county string, rg_id string, city_id long, pop_target double, gq_pct_target double, pph_target double")
    rates = lambda rows, *keys: spark.createDataFrame(rows, ", ".join([*(f"{k} string" for k in keys), "gq_pct_target double, pph_target double"]))
    levels = [C.Level("area", ("area",), rates([("a1", 0.0, 2.0), ("a2", 0.25, 2.25)], "area")),
              C.Level("county", ("area", "county"), rates([("c1", 0.0, 2.0), ("c2", 0.0, 1.0), ("c3", 0.0, 2.0)], "county")),
              C.Level("rg", ("area", "county", "rg_id"), rates([("r1", 0.0, 2.5), ("r2", 0.0, 5.0), ("r3", 0.0, 2.0), ("r4", 0.0, 2.0)], "rg_id"))]
    control = spark.createDataFrame([("s", 725.0, 700.0)], "scenario string, hhpop double, hh double")
    return city, levels, control


def test_four_levels_by_hand(spark):
    """Region, areas, counties, RGs, cities.  Areas: household population 500 and
    225 (the control is their sum), households 250 and 100 -> 500 and 200.
    County c1: 200 of 300 -> 333.333; RG r1: 80 of 120 -> 222.222; its cities 40
    and 20 -> 148.148 and 74.074."""
    out = C.rake_levels(*four_levels(spark))
    area = {r.area: (r.hhpop_target, r.hh_target) for r in out["area"].collect()}
    assert area["a1"] == pytest.approx((500, 500)) and area["a2"] == pytest.approx((225, 200))
    county = {r.county: (r.hhpop_target, r.hh_target) for r in out["county"].collect()}
    assert county["c1"] == pytest.approx((400, 1000 / 3)) and county["c2"] == pytest.approx((100, 500 / 3)) and county["c3"] == pytest.approx((225, 200))
    rg = {r.rg_id: (r.hhpop_target, r.hh_target) for r in out["rg"].collect()}
    assert rg["r1"] == pytest.approx((200, 2000 / 9)) and rg["r2"] == pytest.approx((200, 1000 / 9))
    leaf = {r.city_id: (r.hhpop_target, r.hh_target) for r in out["leaf"].collect()}
    assert leaf[1] == pytest.approx((100, 4000 / 27)) and leaf[2] == pytest.approx((100, 2000 / 27)) and leaf[3] == pytest.approx((200, 1000 / 9))
    assert leaf[4] == pytest.approx((100, 500 / 3)) and leaf[5] == pytest.approx((225, 200))
    assert sorted(out["rg"].columns) == sorted(["scenario", "scheme", "area", "county", "rg_id", "pop_target", "hhpop_p", "hhpop_target", "hh_p", "hh_target"])


def test_one_level_and_wrong_order(spark):
    city, levels, control = four_levels(spark)
    out = C.rake_levels(city, levels[:1], control)
    assert {r.city_id: r.hh_target for r in out["leaf"].collect()}[5] == pytest.approx(200)
    assert sum(r.hhpop_target for r in out["leaf"].collect()) == pytest.approx(725)
    with pytest.raises(ValueError, match="level area has not all keys of county"):
        C.rake_levels(city, [levels[1], levels[0]], control)


def test_levels_without_rows_elsewhere_drop_out(spark):
    city, levels, control = four_levels(spark)
    out = C.rake_levels(city, levels, control, present=city.where("rg_id <> 'r2'"))
    assert {r.rg_id for r in out["rg"].collect()} == {"r1", "r3", "r4"}
    assert {r.city_id: r.hh_target for r in out["leaf"].collect()}[3] is None


def sheet(spark, anchors, tot, mode="after_first", relabel=None, years=YEARS, anchor_years=(2018, 2020, 2050)):
    raw = S.interpolate(anchors, KEYS, anchor_years, years)
    adjusted = S.adjust_to_totals(raw, KEYS, years, tot, mode)
    out = S.accounts(raw, adjusted, S.unroll(adjusted, KEYS, years, tot, relabel), KEYS, years, tot, mode, relabel)
    return {(r.indicator, r.year): r for r in out.collect()}


def test_accounts_of_the_worked_example(spark):
    tot = totals(spark, [(2025, 180), (2030, 190), (2035, 200.5), (2040, 340), (2044, 215), (2050, 230)])
    got = sheet(spark, series_anchors(spark), tot)
    assert got["pop", 2018].reason == "no total" and got["pop", 2020].reason == "no total" and got["pop", 2018].sum_before == 160
    assert got["pop", 2025].reason == "balanced" and got["pop", 2025].residual == 0 and got["pop", 2025].sum_before == pytest.approx(177)
    clipped = got["pop", 2040]
    assert clipped.reason == "clipped" and clipped.clipped == pytest.approx(11.111111, abs=1e-6) and clipped.sum_adjusted == pytest.approx(351.111111, abs=1e-6)
    assert clipped.sum_published == 340 and clipped.residual == 0
    assert got["pop", 2035].reason == "total not whole" and got["pop", 2035].residual == pytest.approx(0.5)
    assert len(got) == len(YEARS)


def test_accounts_of_the_cases_that_do_not_balance(spark):
    flat = spark.createDataFrame([("s", "x", "hh", 1, 10.0, 10.0, 10.0), ("s", "x", "hh", 2, 5.0, 5.0, 5.0), ("s", "x", "emp", 3, 0.0, 0.0, 0.0), ("s", "x", "pop", 4, 1.0, 1.0, 3.0),
                                  ("s", "x", "pop", 5, None, None, 3.0)], series_anchors(spark).schema)
    tot = totals(spark, [(2030, 20)], "hh").unionByName(totals(spark, [(2030, 7)], "emp")).unionByName(totals(spark, [(2030, 7)], "pop"))
    got = sheet(spark, flat, tot)
    assert got["hh", 2030].reason == "no growth to share" and got["emp", 2030].reason == "no growth to share"
    assert got["pop", 2030].reason == "missing value" and got["pop", 2030].sum_before is None
    zero = spark.createDataFrame([("s", "x", "emp", 3, 0.0, 1.0, 2.0)], series_anchors(spark).schema)
    assert sheet(spark, zero, totals(spark, [(2018, 5)], "emp"))["emp", 2018].reason == "no weight"


def test_accounts_follow_the_relabelled_year(spark):
    a = spark.createDataFrame([("s", "x", "pop", 1, 100.0, 440.0), ("s", "x", "pop", 2, 50.0, 50.0)],
                              "scenario string, scheme string, indicator string, geo_id long, a_2016 double, a_2050 double")
    tot = totals(spark, [(2017, 153), (2020, 200), (2030, 290), (2050, 500)])
    got = sheet(spark, a, tot, "interior", {2016: 2017}, (2016, 2020, 2030, 2050), (2016, 2050))
    assert (got["pop", 2017].total, got["pop", 2017].sum_before, got["pop", 2017].sum_published, got["pop", 2017].reason) == (153, 150, 153, "balanced")
    assert got["pop", 2020].sum_adjusted == pytest.approx(200) and got["pop", 2050].sum_adjusted == 490 and got["pop", 2050].residual == 0


@pytest.mark.parametrize("bad", [(2.0, None), (None, None)])
def test_interior_stops_at_a_geography_without_a_value(spark, bad):
    a = series_anchors(spark).unionByName(spark.createDataFrame([("s", "x", "pop", 9, None, *bad)], series_anchors(spark).schema))
    tot = totals(spark, [(y, 100) for y in YEARS])
    with pytest.raises(Exception, match="a geography has no value for year 2020"):
        S.fit_series(a, KEYS, (2018, 2020, 2050), YEARS, tot, "interior", stop=True).collect()
    assert S.fit_series(a, KEYS, (2018, 2020, 2050), YEARS, tot, "interior").count() == 4
    assert S.fit_series(a, KEYS, (2018, 2020, 2050), YEARS, tot, "after_first").count() == 4


def test_hier_run_gives_its_accounts(spark):
    inp = hier_inputs(spark)
    inp.totals = spark.createDataFrame([("s", i, y, 1000.0 + y) for i in ("hhpop", "hh", "emp") for y in (2017, 2020, 2025, 2030, 2035, 2040, 2045, 2050)],
                                       "scenario string, indicator string, year int, total double")
    rows = M.run_hier(inp, HierConfig())["accounts"].collect()
    assert len(rows) == 3 * 8 and all(r.residual == 0 for r in rows) and {r.reason for r in rows} <= {"balanced", "clipped"}


def test_repeated_totals_and_forecast_rows_are_errors(spark):
    from stratum.sources.io import read_forecast
    with pytest.raises(Exception, match="several regional totals for year 2030"):
        S.fit_series(series_anchors(spark), KEYS, (2018, 2020, 2050), YEARS, totals(spark, [(2030, 1), (2030, 2)]), "after_first").collect()
    sheet_ = spark.createDataFrame([("Population", "", 1.0), ("Population", "", 2.0)], "X1 string, X2 string, `2020Q2` double")
    with pytest.raises(Exception, match="several forecast rows for pop"):
        read_forecast(sheet_, [2020]).collect()
