"""Stand-in inputs built from the driver's TPC-H-style tables.

Only reshapes driver rows into the library's input schemas (SURVEY §7.3);
none of the allocation, raking or interpolation happens here.

Hierarchy: region = all rows; county = ``c_nationkey``; RG = ``c_mktsegment``
(scheme ``existing``) or a second assignment (scheme ``proposed``); city =
``c_custkey``.  Measures per customer are order sums by order year; the
reference, base and target years are 1995, 1996 and 2000.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.config import HierConfig, TargetsConfig

# Fixed values of the stand-in inputs.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
RG_POP_SHARE = [0.10, 0.15, 0.20, 0.25, 0.30]   # RG share of county population growth, by segment
RG_EMP_SHARE = [0.30, 0.25, 0.20, 0.15, 0.10]   # RG share of county job growth, by segment
REF_YEAR, BASE_YEAR, TARGET_YEAR = 1995, 1996, 2000
SCENARIOS = ("base", "flat")

HIER = HierConfig(reference_year=REF_YEAR, base_year=BASE_YEAR, target_year=TARGET_YEAR,
                  years_to_fit=(1996, 1998, 1999, 2000), relabel=((1996, 1997),),
                  stop_at_missing=False)       # some stand-in groups have no weight
TARGETS = TargetsConfig(ref_base_year=REF_YEAR, base_year=BASE_YEAR, target_year=TARGET_YEAR,
                        years_to_fit=(1995, 1996, 1998, 1999, 2000),
                        annual_years=tuple(range(1995, 2001)))


def _scenarios(scenarios):
    """One copy of a row per scenario (a generated column, so single-scenario
    plans keep ``scenario`` as a real join key)."""
    return F.explode(F.array(*[F.lit(s) for s in scenarios])).alias("scenario")


def _years(col: str, years) -> "F.Column":
    """``year(col) IN years`` plus a date range the Parquet scan can use to skip row groups."""
    c = F.col(col)
    lo = F.lit(f"{min(years)}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{max(years) + 1}-01-01 00:00:00").cast("timestamp_ntz")
    return (c >= lo) & (c < hi) & F.year(c).isin(*years)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def customer_base(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer with yearly order sums (absent year -> 0)."""
    o = _t(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    yr = F.year("o_orderdate")
    per = (o.where(_years("o_orderdate", (REF_YEAR, BASE_YEAR, TARGET_YEAR)))
            .groupBy(F.col("o_custkey").alias("city_id"))
            .agg(*[F.sum(F.when(yr == y, F.col("o_totalprice") / 100.0)).alias(f"p{y}") for y in
                   (REF_YEAR, BASE_YEAR, TARGET_YEAR)],
                 *[F.sum(F.when(yr == y, F.lit(10.0))).alias(f"n{y}") for y in
                   (REF_YEAR, BASE_YEAR, TARGET_YEAR)]))
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", "c_name")
    df = c.join(per, c.c_custkey == per.city_id, "left")
    k = F.col("c_custkey")
    gq = (k % 5 + 1) / 100.0
    pph = 2.0 + (k % 9) / 10.0
    pop_ref = F.coalesce(F.col(f"p{REF_YEAR}"), F.lit(0.0))
    pop_base = F.coalesce(F.col(f"p{BASE_YEAR}"), F.lit(0.0))
    return df.select(
        k.alias("city_id"), F.col("c_nationkey").cast("long").alias("county"),
        F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("juris"),
        pop_ref.alias("pop_ref"), pop_base.alias("pop_base"),
        F.coalesce(F.col(f"p{TARGET_YEAR}"), F.lit(0.0)).alias("pop_end"),
        F.coalesce(F.col(f"n{REF_YEAR}"), F.lit(0.0)).alias("emp_ref"),
        F.coalesce(F.col(f"n{BASE_YEAR}"), F.lit(0.0)).alias("emp_base"),
        F.coalesce(F.col(f"n{TARGET_YEAR}"), F.lit(0.0)).alias("emp_end"),
        F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("target_pop"),
        (F.greatest(F.col("c_acctbal"), F.lit(0.0)) / 2.0).alias("target_emp"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 100.0).otherwise(0.0).alias("cr_add"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", 250.0).otherwise(0.0).alias("annex"),
        gq.alias("gq_pct"), ((k % 7 + 1) / 100.0).alias("gq_pct_target"),
        pph.alias("pph_target"),
        (pop_ref * (1 - gq)).alias("hhpop_ref"), (pop_base * (1 - gq)).alias("hhpop_base"),
        (pop_ref * (1 - gq) / pph).alias("hh_ref"), (pop_base * (1 - gq) / pph).alias("hh_base"))


def city_emp(base: DataFrame, annex: bool = False) -> DataFrame:
    return base.select("city_id", "county", F.col("segment").alias("rg_id"), "emp_ref", "emp_base",
                       F.col("target_emp").alias("target"), "cr_add",
                       (F.col("annex") if annex else F.lit(0.0)).alias("annex"))


def city_pop(base: DataFrame, annex: bool = False) -> DataFrame:
    return base.select("city_id", "county", F.col("segment").alias("rg_id"), "pop_ref", "pop_base",
                       F.col("target_pop").alias("target"), "hhpop_ref", "hhpop_base", "hh_ref",
                       "hh_base", "gq_pct", "gq_pct_target", "pph_target",
                       (F.col("annex") if annex else F.lit(0.0)).alias("annex"),
                       F.col("pph_target").alias("pph"))


def crosswalk(base: DataFrame, schemes=("existing",)) -> DataFrame:
    """Long crosswalk ``(scheme, city_id, rg_id)``; ``proposed`` reassigns
    each customer to a segment by key."""
    segs = F.array(*[F.lit(s) for s in SEGMENTS])
    rg = {"existing": F.col("segment"),
          "proposed": F.element_at(segs, (F.col("city_id") % 5 + 1).cast("int"))}
    return reduce(lambda a, b: a.unionByName(b),
                  [base.select(F.lit(s).alias("scheme"), "city_id", rg[s].alias("rg_id")) for s in schemes])


def names(base: DataFrame) -> DataFrame:
    return base.select("city_id", "juris")


def ref(spark: SparkSession, sf: str, scenarios=("base",)) -> DataFrame:
    """Regional forecast by year: sums over all orders of the same per-customer
    measures the city tables use (one copy per scenario)."""
    o = _t(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    k = F.col("o_custkey")
    pop = F.col("o_totalprice") / 100.0
    gq = (k % 5 + 1) / 100.0
    pph = 2.0 + (k % 9) / 10.0
    by_year = o.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.sum(pop).alias("pop"), F.sum(pop * (1 - gq)).alias("hhpop"),
        F.sum(pop * (1 - gq) / pph).alias("hh"), F.sum(F.lit(10.0)).alias("emp"))
    return by_year.select(_scenarios(scenarios), "*")


def rgs_county(spark: SparkSession, sf: str, scenarios=("base",)) -> DataFrame:
    """County shares and rates from the nation table; ``flat`` gives every county 1/25."""
    n = _t(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("county"))
    k = F.col("county")
    flat = F.lit(1 / 25.0)
    scen = n.select(_scenarios(scenarios), "county")
    s = F.col("scenario")
    return scen.select("scenario", "county",
                       F.when(s == "flat", flat).otherwise((k + 1) / 325.0).alias("rgs_pop"),
                       F.when(s == "flat", flat).otherwise((25 - k) / 325.0).alias("rgs_emp"),
                       ((k % 5 + 1) / 100.0).alias("gq_pct_target"),
                       (2.0 + (k % 7) / 10.0).alias("pph_target"))


def rgs_rg(spark: SparkSession, sf: str, scenarios=("base",)) -> DataFrame:
    """RG shares and rates: every nation x every segment."""
    n = _t(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("county"))
    rows = F.array(*[F.struct(F.lit(s).alias("rg_id"), F.lit(i).alias("i"),
                              F.lit(RG_POP_SHARE[i]).alias("rgs_pop"),
                              F.lit(RG_EMP_SHARE[i]).alias("rgs_emp"))
                     for i, s in enumerate(SEGMENTS)])
    g = n.select("county", F.inline(rows))
    g = g.select("county", "rg_id", "rgs_pop", "rgs_emp",
                 ((F.col("i") + 2) / 100.0).alias("gq_pct_target"),
                 ((F.col("i") + 22) / 10.0).alias("pph_target"))
    return g.select(_scenarios(scenarios), "*")


def totals(ref_df: DataFrame, after_year: int | None = None) -> DataFrame:
    from stratum.sources.io import totals_long
    return totals_long(ref_df, after_year=after_year)


def targets(base: DataFrame) -> DataFrame:
    """TARGETS input: one row per control area with base and target values."""
    return base.select(
        "city_id", "county", F.col("segment").alias("rg_id"), "juris",
        F.col("emp_ref").alias("emp_by"), "emp_base",
        (F.col("emp_end") - F.col("emp_base")).alias("emp_gro"), F.col("emp_end").alias("emp_target"),
        F.col("pop_ref").alias("pop_by"), "pop_base",
        (F.col("pop_end") - F.col("pop_base")).alias("pop_gro"), F.col("pop_end").alias("pop_target"),
        F.col("hhpop_ref").alias("hhpop_by"), "hhpop_base", F.col("hh_ref").alias("hh_by"), "hh_base",
        (F.col("gq_pct") * 100.0).alias("gq_pct_target"), "pph_target")


ANCHORS = {"base": (1995, 1996, 2000), "late": (1994, 1997, 1998)}


def order_anchors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Anchors as rows, and the years to fit of each scenario: order sums by
    customer and year, at the anchor years of two scenarios."""
    o = _t(spark, sf, "orders").select("o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    sums = o.groupBy(F.col("o_custkey").alias("geo_id"), "year").agg((F.sum("o_totalprice") / 100.0).alias("value"))
    scenario = F.array(*[F.when(F.col("year").isin(*ys), F.lit(s)) for s, ys in ANCHORS.items()])
    rows = (sums.withColumn("scenario", F.explode(F.array_compact(scenario)))
                .select("scenario", F.lit("existing").alias("scheme"), F.lit("pop").alias("indicator"), "geo_id", "year", "value"))
    fit = [(s, y) for s, ys in ANCHORS.items() for y in range(min(ys) - 1, max(ys) + 1)]
    return rows, spark.createDataFrame(fit, "scenario string, year int")


def part_series(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Second series: every part x ship year, four measures.

    Returns ``(anchors, totals)``: anchors ``(scenario, scheme, indicator,
    geo_id, a_<year>…)`` for the TARGETS anchor years, totals long by year.
    """
    li = _t(spark, sf, "lineitem").select("l_partkey", "l_extendedprice", "l_discount", "l_quantity",
                                          "l_shipdate")
    yr = F.year("l_shipdate")
    measures = {"pop": F.col("l_extendedprice") / 100.0,
                "hhpop": F.col("l_extendedprice") * (1 - F.col("l_discount")) / 100.0,
                "hh": F.col("l_quantity"), "emp": F.lit(10.0)}
    anchors_years = TARGETS.anchors
    per = (li.where(_years("l_shipdate", anchors_years)).groupBy("l_partkey")
             .agg(*[F.sum(F.when(yr == y, e)).alias(f"{m}_{y}") for m, e in measures.items()
                    for y in anchors_years]))
    p = _t(spark, sf, "part").select("p_partkey")
    parts = p.join(per, p.p_partkey == per.l_partkey, "left")
    # all four measures from one aggregation, stacked in one projection
    rows = F.array(*[F.struct(F.lit(m).alias("indicator"),
                              *[F.coalesce(F.col(f"{m}_{y}"), F.lit(0.0)).alias(f"a_{y}") for y in anchors_years])
                     for m in measures])
    anchors = parts.select(F.lit("base").alias("scenario"), F.lit("part").alias("scheme"),
                           F.col("p_partkey").alias("geo_id"), F.inline(rows)) \
                   .select("scenario", "scheme", "indicator", "geo_id", *[f"a_{y}" for y in anchors_years])
    tot = (li.groupBy(yr.alias("year")).agg(*[F.sum(e).alias(m) for m, e in measures.items()])
             .withColumn("scenario", F.lit("base")))
    from stratum.sources.io import totals_long
    return anchors, totals_long(tot, after_year=BASE_YEAR)


def forecast_wide(spark: SparkSession, sf: str) -> DataFrame:
    """A wide forecast table in the reference's layout (label rows,
    ``<year>Q2`` columns), built from the regional order sums."""
    r = ref(spark, sf)
    years = list(range(1995, 2002))
    rows = []
    for ind, (col, text) in {"pop": ("X1", "Population"), "hhpop": ("X2", "Household Population"),
                             "hh": ("X1", "Households"), "emp": ("X1", "Estimated Total Employment")}.items():
        other = "X2" if col == "X1" else "X1"
        rows.append(r.groupBy().agg(*[F.max(F.when(F.col("year") == y, F.col(ind))).alias(f"{y}Q2")
                                      for y in years])
                     .select(F.lit(text).alias(col), F.lit("").alias(other), *[f"{y}Q2" for y in years]))
    return reduce(lambda a, b: a.unionByName(b), rows)
