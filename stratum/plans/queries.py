"""Registered queries over the driver tables.

Each ``qNN(spark, sf_dir)`` builds the stand-in inputs from the driver tables
(``stratum.sources.tpch``) and runs the library's operators on all rows.
Doubles are published at 6 decimals so that two engines agree despite
different summation orders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.expr import strict_sum
from stratum.operators import allocate as A
from stratum.operators import control as C
from stratum.operators import report as R
from stratum.operators import series as S
from stratum.plans import methods as M
from stratum.session import materialize
from stratum.sources import tpch

KEYS = ["scenario", "scheme", "indicator"]
HIER, TGT = tpch.HIER, tpch.TARGETS


def publish(df: DataFrame) -> DataFrame:
    """Round doubles to 6 decimals for publication and comparison."""
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def inputs(spark: SparkSession, sf: str, scenarios=("base",), schemes=("existing",),
           totals: bool = True, annex: bool = False) -> M.HierInputs:
    # each stand-in table feeds several inputs: written once instead of re-reading orders per use
    base = materialize(tpch.customer_base(spark, sf))
    ref = materialize(tpch.ref(spark, sf, scenarios))
    return M.HierInputs(
        ref=ref, rgs_county=tpch.rgs_county(spark, sf, scenarios), rgs_rg=tpch.rgs_rg(spark, sf, scenarios),
        crosswalk=tpch.crosswalk(base, schemes), names=tpch.names(base),
        city_emp=tpch.city_emp(base, annex), city_pop=tpch.city_pop(base, annex),
        totals=tpch.totals(ref) if totals else None)


def factor_inputs(spark, sf) -> M.HierInputs:
    return inputs(spark, sf, annex=True)


# ---- allocation --------------------------------------------------------------------------

def q01_share_within(spark, sf):
    inp = inputs(spark, sf, schemes=("existing", "proposed"))
    emp = A.share_within(A.attach_group(inp.city_emp, inp.crosswalk),
                         F.col("target") + F.col("cr_add"), out="emp_share")
    pop = A.share_within(A.attach_group(inp.city_pop, inp.crosswalk), F.col("target"), out="pop_share")
    out = emp.select("scheme", "city_id", "county", "rg_id", "emp_share").join(
        pop.select("scheme", "city_id", "pop_share"), ["scheme", "city_id"], "inner")
    return publish(out)


def q02_period_delta(spark, sf):
    ref = tpch.ref(spark, sf)
    parts = [A.period_delta(ref, y1, y2).select(F.lit(y1).alias("from_year"), F.lit(y2).alias("to_year"), "*")
             for y1, y2 in ((tpch.BASE_YEAR, tpch.TARGET_YEAR), (tpch.REF_YEAR, tpch.TARGET_YEAR))]
    return publish(reduce(DataFrame.unionByName, parts))


def q03_apportion(spark, sf):
    return publish(M.rg_growth(inputs(spark, sf, scenarios=tpch.SCENARIOS), HIER))


def q04_attach_group(spark, sf):
    inp = inputs(spark, sf, schemes=("existing", "proposed"))
    return publish(A.attach_group(inp.city_pop, inp.crosswalk)
                   .select("scheme", "city_id", "county", "rg_id", "pop_base", "target"))


def q05_allocate_project(spark, sf):
    emp, pop = M.allocated_cities(inputs(spark, sf), HIER, with_annex=False)
    pop = A.long_growth(pop, "pop")
    keys = ["scenario", "scheme", "county", "rg_id", "city_id"]
    out = emp.select(*keys, "emp_gro", "emp_target", "emp_long").join(
        pop.select(*keys, "pop_gro", "pop_target", "pop_long", "hhpop_gro", "no_gq"), keys, "inner")
    return publish(out)


def q31_growth_floor(spark, sf):
    """RG population growth with the growth floor, plan ref->target,
    observed ref->base summed from the cities."""
    inp = inputs(spark, sf)
    plan = A.disaggregate(A.apportion(inp.rgs_county, A.period_delta(inp.ref, tpch.REF_YEAR, tpch.TARGET_YEAR)),
                          inp.rgs_rg).select("scenario", "county", "rg_id", F.col("pop_gro_rg").alias("plan"))
    city = A.attach_group(inp.city_pop, inp.crosswalk)
    observed = city.groupBy("scheme", "county", "rg_id").agg(
        strict_sum(F.col("pop_base") - F.col("pop_ref")).alias("observed"))
    return publish(A.growth_floor(plan, observed, "pop"))


# ---- control -----------------------------------------------------------------------------

def _levels(spark, sf):
    inp = inputs(spark, sf)
    emp, pop = M.allocated_cities(inp, HIER, with_annex=False)
    return inp, emp, pop


def q06_aggregate_levels(spark, sf):
    _, emp, pop = _levels(spark, sf)
    rg, county = C.aggregate_levels(emp, pop)
    cols = ["emp_base", "emp_target", "pop_base", "pop_target"]
    out = rg.select("scenario", "scheme", F.lit("rg").alias("level"), "county", "rg_id", *cols).unionByName(
        county.select("scenario", "scheme", F.lit("county").alias("level"), "county",
                      F.lit(None).cast("string").alias("rg_id"), *cols))
    return publish(out)


def q07_group_quarters(spark, sf):
    inp, emp, pop = _levels(spark, sf)
    rg, county = C.aggregate_levels(emp, pop)
    rg = C.household_population(rg.join(inp.rgs_rg.select("scenario", "county", "rg_id", "gq_pct_target"),
                                        ["scenario", "county", "rg_id"], "left"), "pop_target", "gq_pct_target")
    county = C.household_population(county.join(inp.rgs_county.select("scenario", "county", "gq_pct_target"),
                                                ["scenario", "county"], "left"), "pop_target", "gq_pct_target")
    city = C.household_population(pop, "pop_target", "gq_pct_target")
    sel = ["scenario", "scheme", "level", "county", "rg_id", "city_id", "pop_target", "hhpop_p"]
    nulls = {"rg_id": F.lit(None).cast("string"), "city_id": F.lit(None).cast("string")}
    out = reduce(DataFrame.unionByName, [
        city.withColumn("level", F.lit("city")).withColumn("city_id", F.col("city_id").cast("string")).select(*sel),
        rg.withColumn("level", F.lit("rg")).withColumn("city_id", nulls["city_id"]).select(*sel),
        county.withColumn("level", F.lit("county")).withColumns(nulls).select(*sel)])
    return publish(out)


def _raked(spark, sf, scenarios=("base",), schemes=("existing",)):
    inp = inputs(spark, sf, scenarios, schemes)
    emp, pop = M.allocated_cities(inp, HIER, with_annex=False)
    control = inp.ref.where(F.col("year") == HIER.target_year).select("scenario", "hhpop", "hh")
    return C.hierarchical_rake(pop, inp.rgs_county, inp.rgs_rg, control, emp)


def q08_rake_top(spark, sf):
    c = _raked(spark, sf)["county"]
    return publish(c.select("scenario", "scheme", "county", "hhpop_p", "hhpop_target"))


def q09_rake_children(spark, sf):
    r = _raked(spark, sf)["rg"]
    return publish(r.select("scenario", "scheme", "county", "rg_id", "hhpop_p", "hhpop_target"))


def q10_households(spark, sf):
    out = _raked(spark, sf)
    sel = ["scenario", "scheme", "level", "county", "rg_id", "city_id", "hh_p", "hh_target"]
    nulls = {"rg_id": F.lit(None).cast("string"), "city_id": F.lit(None).cast("string")}
    return publish(reduce(DataFrame.unionByName, [
        out["city"].withColumn("level", F.lit("city")).withColumn("city_id", F.col("city_id").cast("string"))
        .select(*sel),
        out["rg"].withColumn("level", F.lit("rg")).withColumn("city_id", nulls["city_id"]).select(*sel),
        out["county"].withColumn("level", F.lit("county")).withColumns(nulls).select(*sel)]))


def q11_targets_end_points(spark, sf):
    t = tpch.targets(tpch.customer_base(spark, sf))
    out = C.households_from_targets(t)
    return publish(out.select("city_id", "county", "rg_id", "pop_target", "hhpop_target", "hh_target",
                              "hhpop_gro", "hh_gro"))


def q12_hierarchical_rake(spark, sf):
    c = _raked(spark, sf)["city"]
    return publish(c.select("scenario", "scheme", "county", "rg_id", "city_id", "pop_target", "hhpop_gro",
                            "hhpop_target", "hh_target", "hh_gro"))


def _factor_pop(spark, sf):
    inp = factor_inputs(spark, sf)
    emp, pop = M.allocated_cities(inp, HIER, with_annex=True)
    pop = A.long_growth(pop, "pop")
    delta = A.period_delta(inp.ref, HIER.base_year, HIER.target_year)
    return C.tolerance_control(pop, delta), delta


def q13_tolerance_control(spark, sf):
    pop, _ = _factor_pop(spark, sf)
    return publish(pop.select("scenario", "scheme", "city_id", "hhpop_factor", "hhpop_gro", "hhpop_target",
                              "hhpop_long"))


def q14_households_stock(spark, sf):
    pop, _ = _factor_pop(spark, sf)
    return publish(C.households_stock(pop).select("scenario", "scheme", "city_id", "hh_gro", "hh_target"))


def q15_households_growth(spark, sf):
    pop, _ = _factor_pop(spark, sf)
    return publish(C.households_growth(pop).select("scenario", "scheme", "city_id", "hh_gro", "hh_target"))


def q16_positive_growth_control(spark, sf):
    pop, delta = _factor_pop(spark, sf)
    parts = []
    for variant, f in (("stock", C.households_stock), ("growth", C.households_growth)):
        hh = C.positive_growth_control(f(pop), delta)
        parts.append(hh.select(F.lit(variant).alias("variant"), "scenario", "scheme", "city_id", "hh_factor",
                               "hh_gro", "hh_target", "hh_long"))
    return publish(reduce(DataFrame.unionByName, parts))


def q17_group_summary(spark, sf):
    return publish(M.run_hier(inputs(spark, sf, totals=False), HIER)["rg_summary"])


def q17a_city_people(spark, sf):
    return publish(M.run_hier(inputs(spark, sf, totals=False), HIER)["people"])


def q17b_city_households(spark, sf):
    return publish(M.run_hier(inputs(spark, sf, totals=False), HIER)["households"])


def q17c_city_jobs(spark, sf):
    return publish(M.run_hier(inputs(spark, sf, totals=False), HIER)["jobs"])


# ---- series ------------------------------------------------------------------------------

def _hier_anchors(spark, sf):
    inp = inputs(spark, sf)
    emp, pop = M.allocated_cities(inp, HIER, with_annex=False)
    control = inp.ref.where(F.col("year") == HIER.target_year).select("scenario", "hhpop", "hh")
    pop = C.hierarchical_rake(pop, inp.rgs_county, inp.rgs_rg, control, emp)["city"]
    y0, y1 = HIER.base_year, HIER.target_year
    anchors = S.stack_anchors({"hhpop": (pop, {y0: "hhpop_base", y1: "hhpop_target"}),
                               "hh": (pop, {y0: "hh_base", y1: "hh_target"}),
                               "emp": (emp, {y0: "emp_base", y1: "emp_target"})},
                              ["scenario", "scheme"], "city_id")
    return S.deal_geos(materialize(anchors)), inp.totals


def _targets_anchors(spark, sf):
    t = C.households_from_targets(tpch.targets(tpch.customer_base(spark, sf)))
    t = t.withColumn("scenario", F.lit("base")).withColumn("scheme", F.lit("existing"))
    a0, a1, a2 = TGT.anchors
    anchors = S.stack_anchors({
        "hhpop": (t, {a0: "hhpop_by", a1: "hhpop_base", a2: "hhpop_target"}),
        "hh": (t, {a0: "hh_by", a1: "hh_base", a2: "hh_target"}),
        "emp": (t, {a0: "emp_by", a1: "emp_base", a2: "emp_target"}),
        "pop": (t, {a0: "pop_by", a1: "pop_base", a2: "pop_target"})}, ["scenario", "scheme"], "city_id")
    totals = tpch.totals(tpch.ref(spark, sf), after_year=TGT.base_year)
    return S.deal_geos(materialize(anchors)), totals


def _long_out(long: DataFrame, geo="city_id") -> DataFrame:
    return publish(long.withColumnRenamed("geo_id", geo))


def q18_interpolate_two_point(spark, sf):
    anchors, _ = _hier_anchors(spark, sf)
    wide = S.interpolate(anchors, KEYS, (HIER.base_year, HIER.target_year), HIER.years_to_fit)
    return _long_out(S.to_long(wide, KEYS, HIER.years_to_fit))


def q19_interpolate_anchors(spark, sf):
    anchors, _ = _targets_anchors(spark, sf)
    wide = S.interpolate(anchors, KEYS, TGT.anchors, TGT.years_to_fit)
    return _long_out(S.to_long(wide, KEYS, TGT.years_to_fit))


def q20_adjust_interior(spark, sf):
    anchors, totals = _hier_anchors(spark, sf)
    wide = S.fit_series(anchors, KEYS, (HIER.base_year, HIER.target_year), HIER.years_to_fit, totals, "interior")
    return _long_out(S.to_long(wide, KEYS, HIER.years_to_fit))


def q21_adjust_after_first(spark, sf):
    anchors, totals = _targets_anchors(spark, sf)
    wide = S.fit_series(anchors, KEYS, TGT.anchors, TGT.years_to_fit, totals, "after_first")
    return _long_out(S.to_long(wide, KEYS, TGT.years_to_fit))


def q22_round_to_total(spark, sf):
    anchors, totals = _hier_anchors(spark, sf)
    wide = S.fit_series(anchors, KEYS, (HIER.base_year, HIER.target_year), HIER.years_to_fit, totals, "interior")
    return _long_out(S.round_to_total(S.to_long(wide, KEYS, HIER.years_to_fit), KEYS, totals))


def q23_seeded_draw(spark, sf):
    anchors, totals = _hier_anchors(spark, sf)
    wide = S.fit_series(anchors, KEYS, (HIER.base_year, HIER.target_year), HIER.years_to_fit, totals, "interior")
    long = S.unroll(wide, KEYS, HIER.years_to_fit, totals, dict(HIER.relabel), method="draw", seed=42)
    return _long_out(long)


def q24_unroll(spark, sf):
    anchors, totals = _hier_anchors(spark, sf)
    wide = S.fit_series(anchors, KEYS, (HIER.base_year, HIER.target_year), HIER.years_to_fit, totals, "interior")
    return _long_out(S.unroll(wide, KEYS, HIER.years_to_fit, totals, dict(HIER.relabel)))


def q25_assemble_inner(spark, sf):
    return publish(M.run_hier(inputs(spark, sf), HIER)["unrolled"])


def q26_assemble_outer(spark, sf):
    t = tpch.targets(tpch.customer_base(spark, sf))
    totals = tpch.totals(tpch.ref(spark, sf), after_year=TGT.base_year)
    return publish(M.run_targets(t, totals, TGT, "base", "existing", annual=False)["unrolled"])


def _part_unrolled(spark, sf):
    anchors, totals = tpch.part_series(spark, sf)
    years = TGT.annual_years
    wide = S.fit_series(S.deal_geos(materialize(anchors)), KEYS, TGT.anchors, years, totals, "after_first")
    long = materialize(S.unroll(wide, KEYS, years, totals))
    return S.assemble(S.deal_geos(long), KEYS, TGT.indicators, "outer", "subreg_id")


def q27_annual_series(spark, sf):
    return publish(_part_unrolled(spark, sf))


def q28_regional_rollup(spark, sf):
    return publish(S.regional_rollup(_part_unrolled(spark, sf), ["scenario", "scheme"], TGT.indicators))


def q29_forecast_normalise(spark, sf):
    from stratum.sources.io import read_forecast
    years = [y for y in TGT.years_to_fit if y > TGT.base_year]
    return publish(read_forecast(tpch.forecast_wide(spark, sf), years))


def q17d_targets_summary(spark, sf):
    t = tpch.targets(tpch.customer_base(spark, sf))
    return publish(M.run_targets(t, None, TGT, "base", "existing", series=False)["rg_summary"])


def q33_targets_scenarios(spark, sf):
    """TARGETS for two scenarios and two schemes in one job."""
    t = tpch.targets(tpch.customer_base(spark, sf))
    totals = tpch.totals(tpch.ref(spark, sf, ("base", "flat")), after_year=TGT.base_year)
    return publish(M.run_targets(t, totals, TGT, ("base", "flat"), ("existing", "proposed"), annual=False)["unrolled"])


def q34_factor_growth_summary(spark, sf):
    """FACTOR, growth variant: summary over cities present in all three tables."""
    return publish(M.run_factor(factor_inputs(spark, sf), HIER, "growth")["rg_summary"])


def _targets_tables(spark, sf):
    return M.run_targets(tpch.targets(tpch.customer_base(spark, sf)), None, TGT, "base", "existing", series=False)


def q35_targets_people(spark, sf):
    """TARGETS city table of people, by the targets' own names."""
    return publish(_targets_tables(spark, sf)["people"])


def q36_targets_households(spark, sf):
    return publish(_targets_tables(spark, sf)["households"])


def q37_targets_jobs(spark, sf):
    return publish(_targets_tables(spark, sf)["jobs"])


def q38_targets_schemes(spark, sf):
    """TARGETS summary under two schemes: the crosswalk gives each area its group."""
    base = materialize(tpch.customer_base(spark, sf))
    return publish(M.run_targets(tpch.targets(base), None, TGT, "base", series=False,
                                 crosswalk=tpch.crosswalk(base, ("existing", "proposed")))["rg_summary"])


def q39_anchor_rows(spark, sf):
    """Interpolation with anchors as data: two scenarios with anchor years of
    their own, and customers without orders in some of them."""
    rows, years = tpch.order_anchors(spark, sf)
    return _long_out(S.interpolate_rows(rows, KEYS, years))


def q40_series_without_totals(spark, sf):
    """HIER series without regional totals: rounded, not adjusted."""
    return publish(M.run_hier(inputs(spark, sf, totals=False), HIER)["unrolled"])


def q41_factor_people(spark, sf):
    """FACTOR, growth variant: city table of people (names by inner join)."""
    return publish(M.run_factor(factor_inputs(spark, sf), HIER, "growth")["people"])


def q42_factor_stock_summary(spark, sf):
    """FACTOR, stock variant: group summary."""
    return publish(M.run_factor(factor_inputs(spark, sf), HIER, "stock")["rg_summary"])


def q43_factor_growth_unrolled(spark, sf):
    """FACTOR, growth variant, end to end."""
    return publish(M.run_factor(factor_inputs(spark, sf), HIER, "growth")["unrolled"])


def q32_factor_unrolled(spark, sf):
    """FACTOR end to end: allocation with annexations, tolerance and
    positive-growth controls, stock households, two-point series, interior
    adjustment, whole numbers, inner assembly."""
    return publish(M.run_factor(factor_inputs(spark, sf), HIER, "stock")["unrolled"])


def q30_scenarios(spark, sf):
    inp = inputs(spark, sf, scenarios=tpch.SCENARIOS, schemes=("existing", "proposed"))
    return publish(M.run_scenarios(inp, HIER, "hier")["unrolled"])


def queries() -> dict:
    return {name: fn for name, fn in sorted(globals().items())
            if name[:1] == "q" and name[1:3].isdigit() and callable(fn)}
