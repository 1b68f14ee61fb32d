"""The three methods as lazy plans over the operators.

Each function takes the input tables (any number of scenarios and schemes)
and returns a dict of DataFrames.  Jobs that run before a sink: the checkpoints
of the allocated cities, of the raked RGs, of the anchors, and of the series in
whole-number rounding (with its ranking) and after it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.config import HierConfig, TargetsConfig
from stratum.operators import allocate as A
from stratum.operators import control as C
from stratum.operators import report as R
from stratum.operators import series as S
from stratum.session import materialize
from stratum.sources.publish import report_roles

RUN = ["scenario", "scheme"]
SERIES_KEYS = RUN + ["indicator"]


@dataclass
class HierInputs:
    ref: DataFrame          # (scenario, year, pop, hhpop, hh, emp)
    rgs_county: DataFrame   # (scenario, county, rgs_pop, rgs_emp, gq_pct_target, pph_target)
    rgs_rg: DataFrame       # (scenario, county, rg_id, rgs_pop, rgs_emp, gq_pct_target, pph_target)
    crosswalk: DataFrame    # (scheme, city_id, rg_id)
    names: DataFrame        # (city_id, juris)
    city_emp: DataFrame     # (city_id, county, emp_ref, emp_base, target, cr_add, annex)
    city_pop: DataFrame     # (city_id, county, pop_ref, pop_base, target, hhpop_*, hh_*, gq_pct, …)
    totals: DataFrame | None = None   # (scenario, indicator, year, total)


def rg_growth(inp: HierInputs, cfg: HierConfig) -> DataFrame:
    """Steps 1-2: regional growth base->target to counties, then to RGs."""
    delta = A.period_delta(inp.ref, cfg.base_year, cfg.target_year)
    return A.disaggregate(A.apportion(inp.rgs_county, delta), inp.rgs_rg)


def allocated_cities(inp: HierInputs, cfg: HierConfig, with_annex: bool) -> tuple[DataFrame, DataFrame]:
    """Steps 3-5 (F1, F5-F8): shares, allocation, projection for jobs and people."""
    growth = rg_growth(inp, cfg)   # one row per (scenario, county, RG)
    emp = A.attach_group(inp.city_emp, inp.crosswalk)
    pop = A.attach_group(inp.city_pop, inp.crosswalk)
    annex = F.col("annex") if with_annex else F.lit(0.0)
    emp = A.share_within(emp, F.col("target") + annex + F.col("cr_add"))
    pop = A.share_within(pop, F.col("target") + annex)
    emp = A.long_growth(A.project(A.allocate(emp, growth, "emp"), "emp"), "emp")
    pop = A.project(A.allocate(pop, growth, "pop"), "pop", with_hhpop=with_annex)
    # the allocated cities feed the levels, the reports and the series
    return materialize(emp), materialize(pop)


def _series(pop: DataFrame, hh: DataFrame, emp: DataFrame, cfg: HierConfig, totals) -> dict:
    """HIER/FACTOR time series: two-point fit, interior adjustment, unroll, inner assembly."""
    y0, y1 = cfg.base_year, cfg.target_year
    anchors = S.stack_anchors({
        "hhpop": (pop, {y0: "hhpop_base", y1: "hhpop_target"}),
        "hh": (hh, {y0: "hh_base", y1: "hh_target"}),
        "emp": (emp, {y0: "emp_base", y1: "emp_target"}),
    }, RUN, "city_id")
    staged = totals is not None            # without totals no job runs before a sink
    if staged:
        anchors = S.deal_geos(materialize(anchors))
    wide = S.fit_series(anchors, SERIES_KEYS, (y0, y1), cfg.years_to_fit, totals, "interior",
                        cfg.round_interpolated, cfg.stop_at_missing)
    long = S.unroll(wide, SERIES_KEYS, cfg.years_to_fit, totals, dict(cfg.relabel), cfg.rounding, cfg.seed)
    if staged:
        long = materialize(long)
    dealt = S.deal_geos(long) if staged else long
    out = {"series": wide, "unrolled": S.assemble(dealt, SERIES_KEYS, cfg.indicators, "inner", "city_id"),
           "unplaced": _unplaced(long, totals, "unrolled")}
    if totals is not None:
        raw = S.interpolate(anchors, SERIES_KEYS, (y0, y1), cfg.years_to_fit)
        out["accounts"] = S.accounts(raw, wide, long, SERIES_KEYS, cfg.years_to_fit, totals, "interior", dict(cfg.relabel))
    return out


def _unplaced(long: DataFrame, totals, table: str) -> DataFrame:
    """Diagnostics of years whose total cannot be handed out."""
    keys = SERIES_KEYS + ["year"]
    groups = long.select(*keys).limit(0) if totals is None else S.unplaced(long, SERIES_KEYS, totals)
    return R.diagnostics(groups, table, keys, {"zero weight (total not placed)": F.lit(True)})


def run_hier(inp: HierInputs, cfg: HierConfig = HierConfig()) -> dict:
    """HIER: allocation, hierarchical raking of HHPop and HH, reports, series."""
    emp, pop = allocated_cities(inp, cfg, with_annex=False)
    control = inp.ref.where(F.col("year") == cfg.target_year).select("scenario", "hhpop", "hh")
    raked = C.hierarchical_rake(pop, inp.rgs_county, inp.rgs_rg, control, emp)
    pop = R.attach_names(raked["city"], inp.names)
    emp = R.attach_names(emp, inp.names)
    out = {"rg_summary": R.group_summary(pop, pop, emp), **R.city_reports(pop, pop, emp),
           "rg_levels": raked["rg"], "county_levels": raked["county"]}
    out.update(_series(pop, pop, emp, cfg, inp.totals))
    out["diagnostics"] = hier_diagnostics(pop, emp, out["series"]).unionByName(out.pop("unplaced"))
    return report_roles(out, cfg.reference_year, cfg.base_year, cfg.target_year)


def hier_diagnostics(pop: DataFrame, emp: DataFrame, series: DataFrame) -> DataFrame:
    """Cities whose values are NULL by the division and anchor rules."""
    keys = RUN + ["county", "rg_id", "city_id"]
    c = F.col
    cities = R.diagnostics(pop, "people", keys, {
        "zero group weight (share 0/0)": c("pop_gro").isNull(),
        "households x/0 (pph = 0, hhpop != 0)": c("hh_p").isNull(),
        "missing after raking": c("hh_target").isNull() & c("hh_p").isNotNull()})
    jobs = R.diagnostics(emp, "jobs", keys, {"zero group weight (share 0/0)": c("emp_gro").isNull()})
    return cities.unionByName(jobs).unionByName(_series_diagnostics(series))


def run_factor(inp: HierInputs, cfg: HierConfig = HierConfig(), variant: str = "stock") -> dict:
    """FACTOR: allocation with annexations, tolerance control of HHPop growth,
    households by stock (data.table) or by growth (SQL), positive-growth control."""
    emp, pop = allocated_cities(inp, cfg, with_annex=True)
    pop = A.long_growth(pop, "pop")
    delta = A.period_delta(inp.ref, cfg.base_year, cfg.target_year)
    pop = C.tolerance_control(pop, delta)
    hh = C.households_stock(pop) if variant == "stock" else C.households_growth(pop)
    hh = C.positive_growth_control(hh, delta)
    how = "left" if variant == "stock" else "inner"
    pop, hh, emp = (R.attach_names(d, inp.names, how) for d in (pop, hh, emp))
    out = {"rg_summary": R.group_summary(pop, hh, emp, by_city=(variant == "growth")),
           **R.city_reports(pop, hh, emp, with_hhpop_ref=(variant == "growth"))}
    out.update(_series(pop, hh, emp, cfg, inp.totals))
    keys = RUN + ["county", "rg_id", "city_id"]
    c = F.col
    out["diagnostics"] = R.diagnostics(pop, "people", keys, {
        "zero group weight (share 0/0)": c("pop_gro").isNull(),
        "household-population control: zero denominator": c("hhpop_factor").isNull()}).unionByName(
        R.diagnostics(hh, "households", keys, {
            "households x/0 (pph = 0)": c("hh_target").isNull() & c("pph").isNotNull() & (c("pph") == 0),
            "household control: no positive growth": c("hh_factor").isNull()})).unionByName(
        _series_diagnostics(out["series"])).unionByName(out.pop("unplaced"))
    return report_roles(out, cfg.reference_year, cfg.base_year, cfg.target_year)


def _series_diagnostics(series: DataFrame) -> DataFrame:
    value_cols = [x for x in series.columns if x.startswith("v_")]
    return R.diagnostics(series, "series", SERIES_KEYS + ["geo_id"], {
        "fewer than two anchors or x/0 in adjustment": F.greatest(*[F.col(x).isNull() for x in value_cols])})


def run_targets(targets: DataFrame, totals: DataFrame | None, cfg: TargetsConfig = TargetsConfig(),
                scenarios=("default",), schemes=("default",), series: bool = True, annual: bool = True,
                crosswalk: DataFrame | None = None) -> dict:
    """TARGETS: end points from given targets, RG summary, city reports with
    the targets' own names (growth they don't give is target less base), anchored series
    (fitted years and every year), full-outer assembly, regional roll-up.

    ``scenario`` and ``scheme`` are keys: targets that lack them hold for each
    of ``scenarios`` and ``schemes``, all in one job.  With ``crosswalk``
    (``scheme, city_id, rg_id``) its schemes give each area its group, one after the
    other, in place of the targets' own.  ``series=False`` stops
    after the end points and the summary, ``annual=False`` leaves out the
    yearly series and the roll-up."""
    df = targets if crosswalk is None else A.attach_group(targets, crosswalk)
    for key, names in (("scenario", scenarios), ("scheme", schemes)):
        if key not in df.columns:
            names = [names] if isinstance(names, str) else list(names)
            df = df.withColumn(key, F.explode(F.array(*[F.lit(n) for n in names])))
    for m in ("pop", "emp"):
        if f"{m}_gro" not in df.columns:
            df = df.withColumn(f"{m}_gro", F.col(f"{m}_target") - F.col(f"{m}_base"))
    if "juris" not in df.columns:
        df = df.withColumn("juris", F.lit(None).cast("string"))
    pop = C.households_from_targets(df)
    summary = R.targets_summary(pop, df)
    a0, a1, a2 = cfg.anchors
    anchors = S.stack_anchors({
        "hhpop": (pop, {a0: "hhpop_by", a1: "hhpop_base", a2: "hhpop_target"}),
        "hh": (pop, {a0: "hh_by", a1: "hh_base", a2: "hh_target"}),
        "emp": (df, {a0: "emp_by", a1: "emp_base", a2: "emp_target"}),
        "pop": (df, {a0: "pop_by", a1: "pop_base", a2: "pop_target"}),
    }, RUN, "city_id")
    out = {"rg_summary": summary, "end_points": pop, **R.targets_reports(pop, df),
           "diagnostics": R.diagnostics(pop, "end_points", RUN + ["county", "rg_id", "city_id"], {
               "households x/0 (pph = 0, hhpop != 0)": F.col("hh_target").isNull()})}
    out = report_roles(out, cfg.ref_base_year, cfg.base_year, cfg.target_year)
    if not series:
        return out
    fit = tuple(cfg.years_to_fit)
    # every anchor is a fitted year: a fitted year's share of the growth since the
    # fitted year before it is its share of the growth since the year before it,
    # so the fitted series is the yearly one at its years
    anchors = S.deal_geos(materialize(anchors))
    years = cfg.annual_years if annual and set(cfg.anchors) <= set(fit) <= set(cfg.annual_years) and fit[0] == cfg.annual_years[0] else fit
    wide = S.fit_series(anchors, SERIES_KEYS, cfg.anchors, years, totals, "after_first", cfg.round_interpolated)
    # one long series, ranked once: both tables, the roll-up and the diagnostics are filters of it
    long = S.unroll(wide, SERIES_KEYS, years, totals, None, cfg.rounding, cfg.seed)
    long = materialize(long.withColumn("published", F.col("year").isin(*fit)))
    out["series"] = wide.select(*SERIES_KEYS, S.GEO, *[f"v_{y}" for y in fit])
    published = long.where("published").drop("published")
    if totals is not None:
        raw = S.interpolate(anchors, SERIES_KEYS, cfg.anchors, fit)
        out["accounts"] = S.accounts(raw, out["series"], published, SERIES_KEYS, fit, totals)
    out["unrolled"] = S.assemble(S.deal_geos(published), SERIES_KEYS, cfg.indicators, "outer", "subreg_id")
    out["diagnostics"] = out["diagnostics"].unionByName(_unplaced(published, totals, "unrolled"))
    if annual:
        yearly = long.drop("published")
        if years == fit and fit != tuple(cfg.annual_years):
            more = S.fit_series(anchors, SERIES_KEYS, cfg.anchors, cfg.annual_years, totals, "after_first", cfg.round_interpolated)
            yearly = materialize(S.unroll(more, SERIES_KEYS, cfg.annual_years, totals, None, cfg.rounding, cfg.seed))
            out["annual_series"] = more
        else:
            out["annual_series"] = wide
        out["diagnostics"] = out["diagnostics"].unionByName(_unplaced(yearly, totals, "annual_unrolled"))
        out["annual_unrolled"] = S.assemble(S.deal_geos(yearly), SERIES_KEYS, cfg.indicators, "outer", "subreg_id")
        out["unrolled_regional"] = S.regional_rollup(out["annual_unrolled"], RUN, cfg.indicators)
    out["diagnostics"] = out["diagnostics"].unionByName(_series_diagnostics(out["series"]))
    return out


def run_scenarios(inp: HierInputs, cfg: HierConfig = HierConfig(), method: str = "hier") -> dict:
    """H9: every scenario and grouping scheme in the inputs in one job —
    ``scenario`` and ``scheme`` are keys of every join and aggregation."""
    if method == "hier":
        return run_hier(inp, cfg)
    return run_factor(inp, cfg, variant=method.split("_", 1)[1] if "_" in method else "stock")
