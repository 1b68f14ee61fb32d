"""Household population, households and control to totals (raking).

Level tables are keyed by ``(scenario, scheme, <level keys>)``; the region
is the empty level.  Group totals are always ``groupBy`` + join (never a
window over a whole county or RG), regional totals are aggregates with one
row per ``(scenario, scheme)`` and are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.expr import cond_sum, ratio, ratio0, strict_sum
from stratum.operators.joins import bounded, common_keys
from stratum.session import materialize

RUN = ["scenario", "scheme"]
COUNTY = RUN + ["county"]
RG = COUNTY + ["rg_id"]


def aggregate_levels(emp: DataFrame, pop: DataFrame) -> tuple[DataFrame, DataFrame]:
    """G1: city results summed to (county, RG) and to county.

    Returns ``(rg_totals, county_totals)`` with ``emp_base, emp_target,
    pop_base, pop_target``; rows present in both city tables only.  Each side
    is summed by county over all its own RGs before the counties are joined,
    so a county keeps the people of RGs without job cities.
    """
    def by(df, m, keys):
        return df.groupBy(*keys).agg(*[strict_sum(f"{m}_{r}").alias(f"{m}_{r}") for r in ("base", "target")])

    e, p = by(emp, "emp", RG), by(pop, "pop", RG)
    county = by(e, "emp", COUNTY).join(by(p, "pop", COUNTY), COUNTY, "inner")
    return e.join(p, RG, "inner"), county


def household_population(df: DataFrame, pop_col: str, gq_col: str, out: str = "hhpop_p") -> DataFrame:
    """Preliminary household population with the level's own GQ share."""
    return df.withColumn(out, F.col(pop_col) - F.col(pop_col) * F.col(gq_col))


def households(df: DataFrame, hhpop_col: str, pph_col: str, out: str = "hh_p",
               missing_to_zero: bool = False) -> DataFrame:
    """Preliminary households ``hhpop / pph``; at city level missing -> 0."""
    f = ratio0 if missing_to_zero else ratio
    return df.withColumn(out, f(F.col(hhpop_col), F.col(pph_col)))


def rake_to_control(df: DataFrame, value_p: str, control: DataFrame, control_col: str,
                    out: str) -> DataFrame:
    """Top level to a regional control, ``control * p / sum(p)``.

    ``control`` holds one row per scenario (the regional forecast value), so
    both it and the per-run sum are broadcast.
    """
    tot = df.groupBy(*RUN).agg(strict_sum(value_p).alias("_psum"))
    keys = common_keys(tot, control, RUN)
    tot = tot.join(bounded(control.select(*keys, F.col(control_col).alias("_ctl"))), keys, "left")
    return (df.join(bounded(tot), RUN, "left")
              .withColumn(out, F.col("_ctl") * ratio(F.col(value_p), F.col("_psum")))
              .drop("_psum", "_ctl"))


def rake_to_parent(child: DataFrame, value_p: str, parent: DataFrame, parent_col: str,
                   parent_keys, out: str, child_sum: DataFrame | None = None) -> DataFrame:
    """Children to their parent's controlled value, ``p / sum_parent(p) * parent``.

    ``child_sum`` may supply the per-parent sum when it was already computed
    in an earlier aggregation over the children.
    """
    parent_keys = list(parent_keys)
    if child_sum is None:
        child_sum = child.groupBy(*parent_keys).agg(strict_sum(value_p).alias("_psum"))
    ctl = parent.select(*parent_keys, F.col(parent_col).alias("_ctl"))
    factors = child_sum.join(ctl, parent_keys, "left")
    return (child.join(factors, parent_keys, "left")
                 .withColumn(out, ratio(F.col(value_p), F.col("_psum")) * F.col("_ctl"))
                 .drop("_psum", "_ctl"))


@dataclass(frozen=True)
class Level:
    """A level between region and leaves: its name, its keys within a run (those
    of the level above, and more), and a table of its rates ``gq_pct_target,
    pph_target`` by any of the keys and ``scenario``."""
    name: str
    keys: tuple
    rates: DataFrame


def rake_levels(leaf: DataFrame, levels: list[Level], region_control: DataFrame, present: DataFrame | None = None) -> dict:
    """G6 over any ordered list of levels, the top one first.

    ``leaf``: rows with ``pop_target, gq_pct_target, pph_target`` and the keys of
    the lowest level.  Upwards, each level's people are the sums of the level
    below; its preliminary household population follows from its own rates.
    Downwards, the top level is raked to ``region_control`` (``scenario, hhpop,
    hh``), each other level to its parent: household population first, then
    households, which start from the level's raked household population.
    With ``present`` (leaves of another table) a level keeps only groups that
    have rows there; leaves of a dropped group get NULL.

    Every level is one aggregation of the level below (map-side combined); the
    leaves are aggregated once and joined once, whatever the depth.  Returns a
    table for each level's name, and ``leaf``.
    """
    names = [x.name for x in levels]
    for above, below in zip(levels, levels[1:]):
        if not set(above.keys) < set(below.keys):
            raise ValueError(f"level {below.name} has not all keys of {above.name}")
    keys = {x.name: RUN + list(x.keys) for x in levels}
    leaf = household_population(leaf, "pop_target", "gq_pct_target", "hhpop_p")
    sums, table = leaf, {}
    for i, x in reversed(list(enumerate(levels))):
        own = [strict_sum("pop_target").alias("pop_target")]
        if i == len(levels) - 1:      # the leaves' preliminary sum comes from the same aggregation
            own.append(strict_sum("hhpop_p").alias("_leaf_p"))
        sums = sums.groupBy(*keys[x.name]).agg(*own)
        held = sums if present is None else sums.join(present.select(*keys[x.name]).distinct(), keys[x.name], "inner")
        by = [k for k in ("scenario", *x.keys) if k in x.rates.columns]
        rates = x.rates.select(*by, F.col("gq_pct_target").alias("_gq"), F.col("pph_target").alias("_pph"))
        table[x.name] = household_population(held.join(rates, by, "left"), "pop_target", "_gq", "hhpop_p")
    for i, x in enumerate(levels):
        df = table[x.name]
        if i == 0:
            df = rake_to_control(df, "hhpop_p", region_control, "hhpop", "hhpop_target")
            df = rake_to_control(households(df, "hhpop_target", "_pph", "hh_p"), "hh_p", region_control, "hh", "hh_target")
        else:
            up, parent = table[names[i - 1]], keys[names[i - 1]]
            df = rake_to_parent(df, "hhpop_p", up, "hhpop_target", parent, "hhpop_target")
            df = rake_to_parent(households(df, "hhpop_target", "_pph", "hh_p"), "hh_p", up, "hh_target", parent, "hh_target")
        table[x.name] = materialize(df) if i == len(levels) - 1 else df
    low, by = table[names[-1]], keys[names[-1]]
    control = low.select(*by, F.col("_leaf_p").alias("_psum"), F.col("hhpop_target").alias("_ctl"))
    leaf = (leaf.join(control, by, "left")
                .withColumn("hhpop_target", ratio(F.col("hhpop_p"), F.col("_psum")) * F.col("_ctl"))
                .drop("_psum", "_ctl"))
    leaf = households(leaf, "hhpop_target", "pph_target", "hh_p", missing_to_zero=True)
    leaf = rake_to_parent(leaf, "hh_p", low, "hh_target", by, "hh_target")
    return {n: df.drop("_leaf_p", "_gq", "_pph") for n, df in table.items()} | {"leaf": leaf}


def hierarchical_rake(city_pop: DataFrame, rgs_county: DataFrame, rgs_rg: DataFrame,
                      region_control: DataFrame, city_emp: DataFrame | None = None) -> dict:
    """G6 for HIER, steps 6-17: ``rake_levels`` over counties and RGs.

    With ``city_emp`` the county and RG tables keep only counties and RGs that
    also have job cities (the level tables are merges of both aggregates).
    Returns ``{"city", "rg", "county"}``.  ``hhpop_gro`` of the cities is left
    as allocated (the reference does not recompute it).
    """
    levels = [Level("county", ("county",), rgs_county), Level("rg", ("county", "rg_id"), rgs_rg)]
    out = rake_levels(city_pop, levels, region_control, city_emp)
    city = out.pop("leaf").withColumn("hh_gro", F.col("hh_target") - F.col("hh_base"))
    return {"city": city, **out}


def households_from_targets(df: DataFrame) -> DataFrame:
    """TARGETS end points; ``gq_pct_target`` is a percent here.

    ``hhpop_target = pop - pop * gq / 100``; ``hh_target = hhpop / pph`` with
    missing -> 0; growth = target - base.
    """
    return (df.withColumn("hhpop_target", F.col("pop_target") -
                          F.col("pop_target") * F.col("gq_pct_target") / 100)
              .withColumn("hh_target", ratio0(F.col("hhpop_target"), F.col("pph_target")))
              .withColumn("hh_gro", F.col("hh_target") - F.col("hh_base"))
              .withColumn("hhpop_gro", F.col("hhpop_target") - F.col("hhpop_base")))


def tolerance_control(city: DataFrame, delta: DataFrame, threshold: float = 0.02) -> DataFrame:
    """FACTOR control of household-population growth to the regional delta.

    ``f = (dHHPop - sum_{no_gq == 0} hhpop_gro) / sum_{no_gq != 0} hhpop_gro``;
    rows with ``pop_gro - hhpop_gro > threshold`` are scaled by ``f``.  The
    denominator test (``!= 0``) and the scaling test (``> 0.02``) differ on
    purpose.  ``delta``: one row per scenario with ``hhpop``.
    """
    no_gq = F.col("pop_gro") - F.col("hhpop_gro")
    sums = city.groupBy(*RUN).agg(cond_sum(no_gq != 0, "hhpop_gro").alias("_unctrl"),
                                  cond_sum(no_gq == 0, "hhpop_gro").alias("_noctrl"))
    sums = sums.join(bounded(delta.select("scenario", F.col("hhpop").alias("_d"))), "scenario", "left")
    sums = sums.select(*RUN, ratio(F.col("_d") - F.col("_noctrl"), F.col("_unctrl")).alias("hhpop_factor"))
    df = city.join(bounded(sums), RUN, "left")
    ctrl = F.when(no_gq > threshold, F.col("hhpop_factor")).otherwise(F.lit(1.0))
    return (df.withColumn("hhpop_gro", F.col("hhpop_gro") * ctrl)
              .withColumn("hhpop_target", F.col("hhpop_gro") + F.col("hhpop_base"))
              .withColumn("hhpop_long", F.col("hhpop_target") - F.col("hhpop_ref")))


def households_stock(city: DataFrame) -> DataFrame:
    """G9 (data.table FACTOR): ``hh_target = hhpop_target / pph``, growth from it."""
    return (city.withColumn("hh_target", ratio(F.col("hhpop_target"), F.col("pph")))
                .withColumn("hh_gro", F.col("hh_target") - F.col("hh_base")))


def households_growth(city: DataFrame) -> DataFrame:
    """G10 (SQL FACTOR): ``hh_gro = hhpop_gro / pph``, end value from it."""
    return (city.withColumn("hh_gro", ratio(F.col("hhpop_gro"), F.col("pph")))
                .withColumn("hh_target", F.col("hh_gro") + F.col("hh_base")))


def positive_growth_control(city: DataFrame, delta: DataFrame) -> DataFrame:
    """Scale only positive household growth so that it adds to ``dHH``.

    ``f = dHH / sum_{hh_gro > 0} hh_gro``; with shrinking cities the total
    growth is ``dHH + sum(negatives)``, as in the reference.
    """
    pos = F.col("hh_gro") > 0
    sums = city.groupBy(*RUN).agg(cond_sum(pos, "hh_gro").alias("_pos"))
    sums = sums.join(bounded(delta.select("scenario", F.col("hh").alias("_d"))), "scenario", "left")
    sums = sums.select(*RUN, ratio(F.col("_d"), F.col("_pos")).alias("hh_factor"))
    df = city.join(bounded(sums), RUN, "left")
    ctrl = F.when(pos, F.col("hh_factor")).otherwise(F.lit(1.0))
    return (df.withColumn("hh_gro", F.col("hh_gro") * ctrl)
              .withColumn("hh_target", F.col("hh_gro") + F.col("hh_base"))
              .withColumn("hh_long", F.col("hh_target") - F.col("hh_ref")))
