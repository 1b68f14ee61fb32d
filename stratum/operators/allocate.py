"""Allocation of regional growth down the hierarchy (region -> county -> RG -> city)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.expr import ratio, strict_sum
from stratum.operators.joins import bounded, with_group_sums

MEASURES = ("pop", "hhpop", "hh", "emp")


def attach_group(city: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """replace a city table's own RG column by the crosswalk's, per scheme.

    ``crosswalk`` is long: ``(scheme, city_id, rg_id)``; cities missing from it
    drop out (inner join), cities in several schemes appear once per scheme.
    """
    own = [c for c in city.columns if c == "rg_id" or c.lower().startswith("rgid")]
    on = ["city_id"] + [k for k in ("scenario",) if k in city.columns and k in crosswalk.columns]
    return city.drop(*own).join(crosswalk.select(*on, "scheme", "rg_id"), on, "inner")


def period_delta(ref: DataFrame, y1: int, y2: int, measures=MEASURES) -> DataFrame:
    """growth of each measure between two years, one row per scenario.

    Conditional sums by year: independent of row order, NULL when a year is absent.
    """
    yr = F.col("year")
    aggs = [(F.sum(F.when(yr == y2, F.col(m))) - F.sum(F.when(yr == y1, F.col(m)))).alias(m)
            for m in measures]
    return ref.where(yr.isin(y1, y2)).groupBy("scenario").agg(*aggs)


def apportion(rgs_county: DataFrame, delta: DataFrame) -> DataFrame:
    """regional growth to counties by their shares.  ``delta`` has one row
    per scenario, so it is broadcast."""
    d = delta.select("scenario", F.col("pop").alias("_dpop"), F.col("emp").alias("_demp"))
    return (rgs_county.join(bounded(d), "scenario", "inner")
            .select("scenario", "county",
                    (F.col("_dpop") * F.col("rgs_pop")).alias("pop"),
                    (F.col("_demp") * F.col("rgs_emp")).alias("emp")))


def disaggregate(county_growth: DataFrame, rgs_rg: DataFrame) -> DataFrame:
    """county growth to RGs.  Keeps every county row (outer on the probe
    side): a county without RG rows stays with a NULL ``rg_id``."""
    rg = rgs_rg.select("scenario", "county", "rg_id", "rgs_pop", "rgs_emp")
    return (county_growth.join(rg, ["scenario", "county"], "left")
            .select("scenario", "county", "rg_id",
                    (F.col("pop") * F.col("rgs_pop")).alias("pop_gro_rg"),
                    (F.col("emp") * F.col("rgs_emp")).alias("emp_gro_rg")))


def share_within(city: DataFrame, weight, keys=("scenario", "scheme", "county", "rg_id"),
                 out: str = "share") -> DataFrame:
    """a city's share of its group's weight, ``w / sum(w)`` by group.

    The sum is strict (one missing weight makes the group missing) and the
    division unguarded except that 0/0 and x/0 give NULL.
    """
    keys = [k for k in keys if k in city.columns]
    df = city.withColumn("_w", weight)
    df = with_group_sums(df, keys, {"_wsum": F.col("_w")})
    return df.withColumn(out, ratio(F.col("_w"), F.col("_wsum"))).drop("_w", "_wsum")


def allocate(city: DataFrame, rg_growth: DataFrame, kind: str) -> DataFrame:
    """RG growth to cities by share (inner join on ``(county, rg_id)``).

    ``kind='emp'`` gives ``emp_gro``; ``kind='pop'`` gives ``pop_gro`` and
    ``hhpop_gro = pop_gro * (1 - gq_pct)``.  Cities without an RG row and RG
    rows without cities drop out.
    """
    src = "emp_gro_rg" if kind == "emp" else "pop_gro_rg"
    g = rg_growth.select("scenario", "county", "rg_id", F.col(src).alias("_rg_gro"))
    on = ["county", "rg_id"] + (["scenario"] if "scenario" in city.columns else [])
    df = city.join(g, on, "inner")
    if kind == "emp":
        df = df.withColumn("emp_gro", F.col("share") * F.col("_rg_gro"))
    else:
        df = (df.withColumn("pop_gro", F.col("share") * F.col("_rg_gro"))
                .withColumn("hhpop_gro", (F.col("share") * F.col("_rg_gro")) * (1 - F.col("gq_pct"))))
    return df.drop("_rg_gro")


def project(df: DataFrame, kind: str, with_hhpop: bool = False) -> DataFrame:
    """end-year value = growth + base-year value."""
    if kind == "emp":
        return df.withColumn("emp_target", F.col("emp_gro") + F.col("emp_base"))
    df = df.withColumn("pop_target", F.col("pop_gro") + F.col("pop_base"))
    if with_hhpop:
        df = df.withColumn("hhpop_target", F.col("hhpop_gro") + F.col("hhpop_base"))
    return df


def long_growth(df: DataFrame, kind: str) -> DataFrame:
    """F8: growth since the reference year and the group-quarters growth."""
    if kind == "emp":
        return df.withColumn("emp_long", F.col("emp_target") - F.col("emp_ref"))
    df = df.withColumn("pop_long", F.col("pop_target") - F.col("pop_ref"))
    if "hhpop_target" in df.columns:
        df = df.withColumn("hhpop_long", F.col("hhpop_target") - F.col("hhpop_ref"))
    return df.withColumn("no_gq", F.col("pop_gro") - F.col("hhpop_gro"))


def growth_floor(rg_plan: DataFrame, rg_observed: DataFrame, measure: str) -> DataFrame:
    """F9 (disabled in the reference, optional here): RG growth floor.

    ``rg_plan``: ``(scenario, scheme, county, rg_id, plan)`` planned growth
    reference->target year.  ``rg_observed``: ``(scheme, county, rg_id, observed)``
    growth already seen reference->base year.  Where ``plan < observed`` the RG
    plan is raised to the observed value and the county's deficit is taken from
    its other RGs by their share of planned growth (county total unchanged).
    Returns ``(…, <measure>_gro_rg)`` = adjusted plan - observed.
    City tables (and so the crosswalk) may carry their own ``scenario``.
    """
    keys = ["scenario", "scheme", "county", "rg_id"]
    on = [k for k in keys if k in rg_plan.columns and k in rg_observed.columns]
    df = rg_plan.join(rg_observed, on, "inner")
    df = df.withColumn("_rem", F.col("plan") - F.col("observed"))
    short = F.col("_rem") < 0
    ck = ["scenario", "scheme", "county"]
    county = df.groupBy(*ck).agg(
        strict_sum("plan").alias("_plan_sum"),
        F.sum(F.when(short, F.col("_rem"))).alias("_deficit"),
        F.max(F.when(short, F.lit(1))).alias("_any"))
    df = df.join(county, ck, "left")
    share = F.when(short, F.lit(0.0)).otherwise(ratio(F.col("plan"), F.col("_plan_sum")))
    df = df.withColumn("_share", share)
    df = with_group_sums(df, ck, {"_share_sum": F.col("_share")})
    adj = (F.when(F.col("_any").isNull(), F.lit(0.0))
           .when(short, F.col("_rem"))
           .otherwise(-F.col("_deficit") * ratio(F.col("_share"), F.col("_share_sum"))))
    return (df.withColumn(f"{measure}_gro_rg", (F.col("plan") - adj) - F.col("observed"))
              .select(*keys, "plan", "observed", f"{measure}_gro_rg"))
