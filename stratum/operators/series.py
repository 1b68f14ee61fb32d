"""Time series of every geography: interpolation, adjustment to regional
totals, rounding to whole numbers that still add up, unrolling and assembly.

Internal shape: one row per ``(keys, indicator, geo_id)`` with one column per
year (``a_<year>`` anchors, ``v_<year>`` fitted values).  The year lists are
run settings, so interpolation and adjustment are column expressions: one
aggregation per geography (duplicates summed), one per ``(keys, indicator)``
for the yearly sums; interpolation and adjustment use no join on years and
no window over geographies.  Whole-number rounding ranks only the rows of
one remainder bin per group (see ``round_to_total``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.expr import clip0, half_even, ratio, strict_sum
from stratum.operators.joins import bounded, common_keys
from stratum.operators.ranking import rank_in_groups
from stratum.session import materialize

GEO = "geo_id"
DRAW_CHUNK = 100_000
REM_BINS = 4096
ROWS_A_TASK = 1 << 19


def _a(y):
    return f"a_{y}"


def _v(y):
    return f"v_{y}"


def deal(staged: DataFrame, keys, rows: int = ROWS_A_TASK) -> DataFrame:
    """Rows of a staged table, dealt by ``keys`` to tasks of about ``rows`` rows.

    An aggregation by these and other keys then holds a bounded number of groups
    in a task at any size of the table.  Without this it is as large as the
    task's input: a few MB of a scan or a join that become millions of rows, one
    for each scenario, scheme, indicator and year.  ``staged`` is counted, so it
    must be written already (``materialize``)."""
    return staged.repartition(max(1, -(-staged.count() // rows)), *keys)


def deal_geos(staged: DataFrame) -> DataFrame:
    """``deal`` for ``fit_series`` and ``assemble``: by geography, of which a
    table has many; the rows of one are bounded by the run settings, and
    together they take less room in files than apart."""
    return deal(staged, [GEO])


def stack_anchors(parts: dict, keys, geo: str) -> DataFrame:
    """Union per-indicator tables into ``(keys, indicator, geo_id, a_<year>…)``.

    ``parts``: ``{indicator: (df, {year: column})}``.  Indicators read from
    the same DataFrame are stacked in one projection (``inline`` of an array
    of structs), so that input is scanned and computed once.
    """
    years = sorted({y for _, m in parts.values() for y in m})
    by_df: dict = {}
    for ind, (df, m) in parts.items():
        by_df.setdefault(id(df), (df, []))[1].append((ind, m))
    frames = []
    for df, items in by_df.values():
        rows = F.array(*[F.struct(F.lit(ind).alias("indicator"),
                                  *[(F.col(m[y]).cast("double") if y in m else F.lit(None).cast("double"))
                                    .alias(_a(y)) for y in years]) for ind, m in items])
        frames.append(df.select(*[F.col(k) for k in keys], F.col(geo).alias(GEO), F.inline(rows))
                        .select(*keys, "indicator", GEO, *[_a(y) for y in years]))
    return reduce(lambda a, b: a.unionByName(b), frames)


def anchors_from_long(df: DataFrame, keys, geo: str, year: str, value: str, anchor_years) -> DataFrame:
    """Long ``(keys, geo, year, value)`` rows -> wide anchors (missing years are NULL)."""
    y = F.col(year)
    aggs = []
    for a in anchor_years:
        hit = y == a
        bad = F.sum(F.when(hit & F.col(value).isNull(), 1))
        aggs.append(F.when(bad > 0, F.lit(None).cast("double"))
                    .otherwise(F.sum(F.when(hit, F.col(value).cast("double")))).alias(_a(a)))
    return (df.where(y.isin(*anchor_years)).groupBy(*keys, F.col(geo).alias(GEO)).agg(*aggs))


def _interp_at(anchor_years, y: int) -> Column:
    """Piecewise-linear value at ``y`` through the non-missing anchors
    (R ``approx``: NA anchors dropped, outside the range -> NULL)."""
    left = [a for a in anchor_years if a <= y][::-1]
    right = [a for a in anchor_years if a >= y]
    if not left or not right:
        return F.lit(None).cast("double")
    lv = F.coalesce(*[F.col(_a(a)) for a in left])
    ly = F.coalesce(*[F.when(F.col(_a(a)).isNotNull(), F.lit(float(a))) for a in left])
    rv = F.coalesce(*[F.col(_a(a)) for a in right])
    ry = F.coalesce(*[F.when(F.col(_a(a)).isNotNull(), F.lit(float(a))) for a in right])
    return (F.when(ly.isNull() | ry.isNull(), F.lit(None).cast("double"))
             .when(ly == ry, lv)
             .otherwise(lv + (rv - lv) * ((F.lit(float(y)) - ly) / (ry - ly))))


def interpolate(anchors: DataFrame, keys, anchor_years, years_to_fit) -> DataFrame:
    """H1/H2: per geography, sum duplicate rows (D6), then fit every year.

    Fewer than two non-missing anchors -> the whole series is NULL (the
    reference stops with an error there).
    """
    anchor_years = sorted(anchor_years)
    keys = list(keys)
    g = anchors.groupBy(*keys, GEO).agg(*[strict_sum(_a(a)).alias(_a(a)) for a in anchor_years])
    n_valid = reduce(lambda x, z: x + z,
                     [F.when(F.col(_a(a)).isNotNull(), 1).otherwise(0) for a in anchor_years])
    fitted = [F.when(n_valid >= 2, _interp_at(anchor_years, y)).alias(_v(y)) for y in years_to_fit]
    return g.select(*keys, GEO, *fitted)


def anchor_rows(parts: dict, keys, geo: str) -> DataFrame:
    """As ``stack_anchors``, in rows: ``(keys, indicator, geo_id, year, value)``."""
    wide = stack_anchors(parts, keys, geo)
    years = [int(c[2:]) for c in wide.columns if c.startswith("a_")]
    rows = F.array(*[F.struct(F.lit(y).alias("year"), F.col(_a(y)).alias("value")) for y in years])
    return wide.select(*keys, "indicator", GEO, F.inline(rows))


def interpolate_rows(anchors: DataFrame, keys, years) -> DataFrame:
    """H1/H2 with anchors as data: ``(keys, geo_id, year, value)`` rows give the
    fitted rows, so anchor years may differ by scenario, indicator or geography.

    Rows of one anchor are summed (one missing value makes it missing).  Each
    non-missing anchor and its ``lead`` are a segment that gives the years to fit
    from it to before the next: the first one those before it as well, the last
    one those after it, which are NULL.  The window holds one geography's
    anchors.  ``years`` are the years to fit, or a table of them by any of the
    ``keys`` (one row for each year: bounded by the run's settings).  Fewer than
    two anchors give a NULL series; a geography without any, too.
    """
    keys = list(keys)
    own = anchors.groupBy(*keys, GEO, "year").agg(strict_sum("value").alias("value"))
    at = Window.partitionBy(*keys, GEO).orderBy(F.col("value").isNull(), "year")
    all_of = Window.partitionBy(*keys, GEO)
    valid = F.col("value").isNotNull()
    seg = (own.withColumn("_n", F.count("value").over(all_of)).withColumn("_place", F.row_number().over(at))
              .withColumn("_next", F.lead(F.when(valid, F.col("year"))).over(at)).withColumn("_to", F.lead("value").over(at))
              .where(valid | (F.col("_place") == 1)))
    if isinstance(years, DataFrame):
        by = common_keys(seg, years, keys)
        fit = years.groupBy(*by).agg(F.sort_array(F.collect_set(F.col("year").cast("int"))).alias("_years"))
        seg = seg.join(bounded(fit), by) if by else seg.withColumn("_years", F.lit(sorted({r["year"] for r in years.select("year").distinct().collect()})))
    else:
        seg = seg.withColumn("_years", F.array(*[F.lit(int(y)) for y in years]))
    start, after = F.col("year"), F.col("_next")
    first = (F.col("_place") == 1) | (F.col("_n") == 0)
    mine = F.filter("_years", lambda y: (first | (y >= start)) & (after.isNull() | (y < after)))
    y = F.col("_year")
    fitted = (F.when((F.col("_n") < 2) | (y < start), F.lit(None).cast("double")).when(y == start, F.col("value"))
               .otherwise(F.col("value") + (F.col("_to") - F.col("value")) * ((y.cast("double") - start) / (after - start))))
    return seg.withColumn("_year", F.explode(mine)).select(*keys, GEO, y.alias("year"), fitted.alias("value"))


def adjust_rows(long: DataFrame, keys, totals: DataFrame | None, mode: str = "after_first", stop: bool = False) -> DataFrame:
    """H3 on rows: as ``adjust_to_totals``, where the fitted years of each group
    are those it has rows of.  The difference to the year before is taken in the
    partitioning that ``interpolate_rows`` leaves."""
    if totals is None:
        return long
    keys = list(keys)
    before = Window.partitionBy(*keys, GEO).orderBy("year")
    df = long.withColumn("_dif", F.col("value") - F.lag("value").over(before))
    span = df.groupBy(*keys).agg(F.min("year").alias("_first"), F.max("year").alias("_last"))
    sums = df.groupBy(*keys, "year").agg(strict_sum("value").alias("_s"), strict_sum("_dif").alias("_d"))
    tk = common_keys(sums, totals, [*keys, "year"])
    # a row for each group and year: bounded by the run settings
    sums = sums.join(bounded(span), keys).join(totals.select(*tk, "total"), tk, "left")
    moved_year = F.col("year") > F.col("_first")
    gap = F.col("total") - F.col("_s")
    if mode == "interior":
        moved_year = moved_year & (F.col("year") < F.col("_last"))
        fail = lambda text: F.raise_error(F.concat(F.lit(text), F.col("year").cast("string")))
        if stop:
            gap = F.when(moved_year & F.col("_s").isNull(), fail("a geography has no value for year ")).otherwise(gap)
        gap = F.when(moved_year & F.col("total").isNull(), fail("no regional total for year ")).otherwise(gap)
    sums = sums.select(*keys, "year", F.when(moved_year, gap).alias("_g"), "_d")
    g = F.col("_g")
    moved = clip0(F.col("value") + ratio(F.col("_dif"), F.col("_d")) * g)
    return (df.join(bounded(sums), [*keys, "year"], "left")
              .select(*keys, GEO, "year", F.when(g.isNull() | (g == 0), F.col("value")).otherwise(moved).alias("value")))


def totals_wide(totals: DataFrame, years) -> DataFrame:
    """Long totals ``(scenario, indicator, year, total)`` -> one row per
    ``(scenario, indicator)`` with ``t_<year>`` columns; two totals of one year
    are an error."""
    tk = [c for c in totals.columns if c not in ("year", "total")]
    y = F.col("year")

    def only(yr):
        value = F.max(F.when(y == yr, F.col("total")))
        return F.when(F.count_if(y == yr) > 1, F.raise_error(F.lit(f"several regional totals for year {yr}"))).otherwise(value).alias(f"t_{yr}")

    return totals.where(y.isin(*years)).groupBy(*tk).agg(*[only(yr) for yr in years])


def adjust_to_totals(wide: DataFrame, keys, years_to_fit, totals: DataFrame | None,
                     mode: str = "after_first", stop: bool = False) -> DataFrame:
    """H3: move each fitted year onto the regional total.

    ``d = total_y - sum(v_y)``; ``v' = max(0, v + dif_y / sum(dif_y) * d)``,
    ``dif_y = v_y - v_prev`` from the unadjusted series.  ``mode="interior"``
    (H3a): every year but the first and last; a missing total is an error, with
    ``stop`` a geography without a value, too (else the year is left alone).
    ``mode="after_first"`` (H3b): every year but the first, years without a
    total are left alone.
    """
    if totals is None:
        return wide
    keys = list(keys)
    ys = list(years_to_fit)
    adj = ys[1:-1] if mode == "interior" else ys[1:]
    if not adj:
        return wide
    prev = {y: ys[i] for i, y in enumerate(ys[1:])}
    dif = {y: F.col(_v(y)) - F.col(_v(prev[y])) for y in adj}
    sums = wide.groupBy(*keys).agg(
        *[strict_sum(_v(y)).alias(f"_s_{y}") for y in adj],
        *[strict_sum(dif[y]).alias(f"_d_{y}") for y in adj])
    tw = totals_wide(totals, adj)
    sums = sums.join(tw, common_keys(sums, tw, keys), "left")
    gaps = []
    for y in adj:
        gap = F.col(f"t_{y}") - F.col(f"_s_{y}")
        if mode == "interior":
            if stop:
                gap = F.when(F.col(f"_s_{y}").isNull(), F.raise_error(F.lit(f"a geography has no value for year {y}"))).otherwise(gap)
            gap = F.when(F.col(f"t_{y}").isNull(),
                         F.raise_error(F.lit(f"no regional total for year {y}"))).otherwise(gap)
        gaps.append(gap.alias(f"_g_{y}"))
    # one row per (scenario, scheme, indicator): bounded by the run settings
    factors = sums.select(*keys, *gaps, *[F.col(f"_d_{y}") for y in adj])
    out = wide.join(bounded(factors), keys, "left")
    new = {}
    for y in adj:  # all years from the unadjusted columns, in one projection
        g = F.col(f"_g_{y}")
        moved = clip0(F.col(_v(y)) + ratio(dif[y], F.col(f"_d_{y}")) * g)
        new[_v(y)] = F.when(g.isNull() | (g == 0), F.col(_v(y))).otherwise(moved)
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in wide.columns])


def round_wide(wide: DataFrame, years) -> DataFrame:
    """Half-even rounding of every fitted year."""
    return wide.select(*[half_even(F.col(c)).alias(c) if c in {_v(y) for y in years} else F.col(c)
                         for c in wide.columns])


def to_long(wide: DataFrame, keys, years, relabel: dict | None = None) -> DataFrame:
    """E1 (melt): one row per (keys, geo, year); optional year relabel."""
    relabel = dict(relabel or {})
    rows = F.array(*[F.struct(F.lit(relabel.get(y, y)).alias("year"), F.col(_v(y)).alias("value"))
                     for y in years])
    return wide.select(*keys, GEO, F.inline(rows))


def fit_series(anchors: DataFrame, keys, anchor_years, years_to_fit, totals=None,
               mode: str = "after_first", round_values: bool = False, stop: bool = False) -> DataFrame:
    """H1-H3 in one plan; returns the wide fitted table."""
    wide = interpolate(anchors, keys, anchor_years, years_to_fit)
    wide = adjust_to_totals(wide, keys, years_to_fit, totals, mode, stop)
    return round_wide(wide, years_to_fit) if round_values else wide


def draw_position(seed: int, G, draw: Column, total: Column) -> Column:
    """The position in ``[0, total)`` of a draw: 52 bits of a digest of (seed,
    group, draw number), which any engine that has MD5 can repeat."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c) for c in G], draw).cast("binary"))
    u = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2 ** 52))
    return F.floor(u * total).cast("double")


def _draw_counts(need: DataFrame, G, seed: int) -> DataFrame:
    """H4b helper: ``|d|`` draws with replacement, probability ~ weight.

    Geographies are laid out on ``[0, W)`` by running sums of their weights (in
    id order); a draw at ``x`` hits the geography with ``lo <= x < hi``.  Starts
    of intervals and draws are range-partitioned together on (group, position)
    and merged in order: a draw's geography is the last start before it in its
    partition, or else the last of the nearest partition before that has one of
    the group.  So a group, whatever its number of draws or geographies, is cut
    across partitions, a dominant geography is one row among its draws, and
    neither side is repeated or looked up by range.
    """
    ranked = rank_in_groups(need, G, [F.col(GEO)], running={"_lo": F.col("_w")})
    starts = ranked.where(F.col("_w") > 0).select(*G, F.col("_lo").alias("_at"), F.col(GEO).alias("_geo"), F.lit(0).alias("_draws"))
    groups = need.groupBy(*G).agg(F.max("_d").alias("_d"), F.max("_wtot").alias("_wtot"))
    # draws are made in chunks spread over tasks, so a large residual is not
    # generated (or broadcast) by one task
    n = F.abs(F.col("_d")).cast("long")
    chunks = (groups.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                               F.floor((n - 1) / DRAW_CHUNK).cast("long"))))
                    .repartition(*G, "_chunk"))
    draws = chunks.withColumn("_draw", F.explode(F.sequence(
        F.col("_chunk") * DRAW_CHUNK + 1, F.least(n, (F.col("_chunk") + 1) * DRAW_CHUNK))))
    draws = (draws.select(*G, draw_position(seed, G, F.col("_draw"), F.col("_wtot")).alias("_at"))
                  .groupBy(*G, "_at").agg(F.count(F.lit(1)).cast("int").alias("_draws"))
                  .select(*G, "_at", F.lit(None).cast(need.schema[GEO].dataType).alias("_geo"), "_draws"))
    order = [*G, "_at", "_draws"]                        # a start comes before the draws at its place
    merged = starts.unionByName(draws).repartitionByRange(*order).sortWithinPartitions(*order)
    merged = materialize(merged.withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part", *G).orderBy("_at", "_draws").rowsBetween(Window.unboundedPreceding, 0)
    found = (merged.withColumn("_geo", F.last("_geo", ignorenulls=True).over(inside))
                   .where(F.col("_draws") > 0).groupBy("_part", *G, "_geo").agg(F.sum("_draws").alias("_hits")))
    # a row for each group and partition: the last start there, carried on to later partitions
    before = Window.partitionBy(*G).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (merged.groupBy("_part", *G).agg(F.max_by("_geo", F.when(F.col("_geo").isNotNull(), F.col("_at"))).alias("_own"))
                     .withColumn("_carry", F.last("_own", ignorenulls=True).over(before)).select("_part", *G, "_carry"))
    return (found.join(carried, ["_part", *G]).withColumn(GEO, F.coalesce("_geo", "_carry"))
                 .groupBy(*G, GEO).agg(F.sum("_hits").alias("_hits")))


def _quotas(long: DataFrame, G, control: DataFrame) -> DataFrame:
    """Rounded values and weights, and where the group's residual is to be handed
    out (``_need``) the quota's floor ``_b``, remainder ``_frac`` and its bin."""
    df = _weighted(long).join(bounded(control), G, "left")
    need = F.col("_d").isNotNull() & (F.col("_d") != 0) & (F.col("_wtot") > 0)
    quota = F.abs(F.col("_d")) * F.col("_w") / F.col("_wtot")
    df = (df.withColumn("_need", need)
            .withColumn("_b", F.when(need, F.floor(quota).cast("double")))
            .withColumn("_frac", F.when(need, (quota - F.floor(quota)).cast("decimal(38,10)"))))
    return df.withColumn("_bin", F.when(F.col("_need"), F.floor(F.col("_frac") * REM_BINS).cast("long")))


def _weighted(long: DataFrame) -> DataFrame:
    """``_r``: the value rounded half-even, ``_w``: its weight."""
    r = F.col("_r")
    return long.withColumn("_r", half_even(F.col("value"))).withColumn("_w", F.when(r.isNull(), r).when(r > 0, r).otherwise(F.lit(0.0)))


def _cut_bins(long: DataFrame, G, grp: DataFrame) -> DataFrame:
    """A row for each group: ``_d, _wtot``, the bin of remainders ``_cut`` where
    the top ``m = |d| - sum(floor(quota))`` of them end, and how many rows of it,
    ``_take``, still get one more (NULL where there is nothing to hand out)."""
    df = _quotas(long, G, grp)
    hist = (df.where(F.col("_need")).groupBy(*G, "_bin")
              .agg(F.count(F.lit(1)).alias("_cnt"), F.sum("_b").alias("_bs")))
    above = Window.partitionBy(*G).orderBy(F.col("_bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    hist = (hist.withColumn("_above", F.coalesce(F.sum("_cnt").over(above), F.lit(0)))
                .withColumn("_m", F.sum("_bs").over(Window.partitionBy(*G))))
    cut = hist.join(bounded(grp.select(*G, "_d")), G, "inner")
    cut = (cut.withColumn("_m", F.abs(F.col("_d")) - F.col("_m"))
              .where((F.col("_above") < F.col("_m")) & (F.col("_above") + F.col("_cnt") >= F.col("_m")))
              .select(*G, F.col("_bin").alias("_cut"), (F.col("_m") - F.col("_above")).alias("_take")))
    return grp.join(cut, G, "left")


def _largest_remainder_extra(df: DataFrame, G) -> DataFrame:
    """H4a helper: ``_extra`` = 1 for the ``m`` rows of each group with the
    largest remainders (ties by id), else 0.

    Rows in bins above the cut get one more unit, rows below none, and only the
    rows inside the cut bin are ranked exactly (``rank_in_groups``), so no group
    is ever sorted whole in one task.
    """
    in_cut = F.col("_need") & (F.col("_bin") == F.col("_cut"))
    rest = df.where(~in_cut | F.col("_cut").isNull()).withColumn(
        "_extra", F.when(F.col("_need") & F.col("_cut").isNotNull() & (F.col("_bin") > F.col("_cut")), 1.0)
                   .otherwise(0.0))
    cand = rank_in_groups(df.where(in_cut), G, [F.col("_frac").desc(), F.col(GEO)])
    cand = cand.withColumn("_extra", F.when(F.col("_rank") <= F.col("_take"), 1.0).otherwise(0.0)).drop("_rank")
    return rest.unionByName(cand)


def round_to_total(long: DataFrame, keys, totals: DataFrame, method: str = "largest_remainder",
                   seed: int = 0) -> DataFrame:
    """H4: after half-even rounding, hand the residual ``d = total - sum(round(v))``
    out in whole units so each year adds up to its total.

    ``largest_remainder`` (H4a, default): quota ``|d| * w / W`` with
    ``w = round(v)``; every geography gets the floor of its quota, the
    largest remainders (ties by id) one more.  ``draw`` (H4b): ``|d|``
    seeded draws with probability ``w / W``.  Groups without a total, with
    ``d = 0``, with zero weight or with a NULL value are left as rounded.
    """
    keys = list(keys)
    G = keys + ["year"]
    # read several times below (sums, bins, the cut bin): computed once
    long = materialize(long)
    grp = _weighted(long).groupBy(*G).agg(strict_sum("_r").alias("_rsum"), strict_sum("_w").alias("_wtot"))
    tk = common_keys(grp, totals, G)
    grp = (grp.join(totals.select(*tk, "total"), tk, "inner")
              .select(*G, (half_even(F.col("total")) - F.col("_rsum")).alias("_d"), "_wtot"))
    # one row per (scenario, scheme, indicator, year): bounded by the run settings;
    # written once so later branches neither re-aggregate the series nor re-read the totals
    if method == "draw":
        grp = materialize(grp)
        df = _weighted(long).join(bounded(grp), G, "left")
        need = F.col("_d").isNotNull() & (F.col("_d") != 0) & (F.col("_wtot") > 0)
        hits = _draw_counts(df.where(need), G, seed)
        out = df.join(hits, G + [GEO], "left")
        value = F.col("_r") + F.signum(F.col("_d")) * F.coalesce(F.col("_hits"), F.lit(0))
        return (out.withColumn("value", F.when(need, value).otherwise(F.col("_r")))
                   .select(*keys, GEO, "year", "value"))
    df = _largest_remainder_extra(_quotas(long, G, materialize(_cut_bins(long, G, grp))), G)
    value = F.col("_r") + F.signum(F.col("_d")) * (F.col("_b") + F.col("_extra"))
    return (df.withColumn("value", F.when(F.col("_need"), value).otherwise(F.col("_r")))
              .select(*keys, GEO, "year", "value"))


def unroll(wide: DataFrame, keys, years, totals: DataFrame | None = None,
           relabel: dict | None = None, method: str = "largest_remainder", seed: int = 0) -> DataFrame:
    """H5: relabel years, melt, round half-even and match the totals.

    Returns long ``(keys, geo_id, year, value)``.
    """
    long = to_long(wide, keys, years, relabel)
    if totals is None:
        return long.withColumn("value", half_even(F.col("value")))
    return round_to_total(long, keys, totals, method, seed)


def accounts(raw: DataFrame, adjusted: DataFrame, published: DataFrame, keys, years, totals: DataFrame,
             mode: str = "after_first", relabel: dict | None = None) -> DataFrame:
    """The balance sheet of H3 and H4: ``keys, year, total, sum_before, sum_adjusted,
    clipped, sum_published, residual, reason``, one row for each group and year.

    ``raw`` and ``adjusted`` are the fitted series before and after H3,
    ``published`` the rows of ``unroll``.  ``clipped`` is what the floor at zero
    added beyond the total, ``residual`` what is still missing from the total.
    Reasons: ``no total``; ``missing value`` (a geography has none, so there is no
    sum); ``no growth to share`` (all growths add to zero); ``no weight`` (the
    residual had no geography to go to); ``total not whole``; ``clipped`` (and
    then met by rounding); ``balanced``; ``open`` (missed for none of these).
    Aggregated map-side, one row for each group and year afterwards.
    """
    keys, ys, relabel = list(keys), list(years), dict(relabel or {})
    prev = dict(zip(ys[1:], ys))
    before = raw.groupBy(*keys).agg(*[strict_sum(_v(y)).alias(f"s_{y}") for y in ys],
                                    *[strict_sum(F.col(_v(y)) - F.col(_v(prev[y]))).alias(f"d_{y}") for y in ys[1:]])
    after = adjusted.groupBy(*keys).agg(*[strict_sum(_v(y)).alias(f"a_{y}") for y in ys])
    moved = set(ys[1:-1] if mode == "interior" else ys[1:])
    rows = F.array(*[F.struct(F.lit(y).alias("fitted"), F.lit(relabel.get(y, y)).alias("year"), F.col(f"s_{y}").alias("sum_before"),
                              (F.col(f"d_{y}") if y in prev else F.lit(None).cast("double")).alias("growth"), F.col(f"a_{y}").alias("sum_adjusted"),
                              F.lit(y in moved).alias("moved")) for y in ys])
    sheet = before.join(after, keys).select(*keys, F.inline(rows))
    sums = published.groupBy(*keys, "year").agg(strict_sum("value").alias("sum_published"), F.max("value").alias("_most"))
    c = F.col
    sheet = sheet.join(sums, [*keys, "year"], "left")
    by_fitted = totals.withColumnRenamed("year", "fitted").withColumnRenamed("total", "aim")
    tk = common_keys(sheet, totals, [*keys, "year"])
    sheet = sheet.join(totals.select(*tk, "total"), tk, "left")
    fk = common_keys(sheet, by_fitted, [*keys, "fitted"])
    sheet = sheet.join(by_fitted.select(*fk, "aim"), fk, "left")
    whole = half_even(c("total"))
    gap = c("moved") & (c("aim") != c("sum_before"))
    clipped = F.when(gap & (c("sum_adjusted") - c("aim") > 1e-9 * F.abs(c("aim"))), c("sum_adjusted") - c("aim")).otherwise(F.lit(0.0))
    reason = (F.when(c("total").isNull() & (c("aim").isNull() | ~c("moved")), "no total").when(c("sum_before").isNull(), "missing value")
               .when(gap & (c("growth") == 0), "no growth to share")
               .when((c("sum_published") != whole) & (c("_most") <= 0), "no weight").when(c("sum_published") != whole, "open")
               .when(whole != c("total"), "total not whole").when(c("clipped") > 0, "clipped").otherwise("balanced"))
    return (sheet.withColumn("clipped", clipped).withColumn("residual", c("total") - c("sum_published")).withColumn("reason", reason)
                 .select(*keys, "year", "total", "sum_before", "sum_adjusted", "clipped", "sum_published", "residual", "reason"))


def unplaced(long: DataFrame, keys, totals: DataFrame) -> DataFrame:
    """``keys, year`` of the groups of ``unroll``'s rows that miss their total
    as no geography has a weight."""
    G = list(keys) + ["year"]
    value = F.col("value")
    grp = long.groupBy(*G).agg(strict_sum("value").alias("_sum"), F.max(value).alias("_most"))
    tk = common_keys(grp, totals, G)
    return (grp.join(totals.select(*tk, "total"), tk, "inner")
               .where((half_even(F.col("total")) != F.col("_sum")) & (F.col("_most") <= 0)).select(*G))


def assemble(long: DataFrame, keys, indicators, how: str = "inner", geo_name: str = GEO) -> DataFrame:
    """H6/E5: indicators side by side as ``total_<indicator>`` columns.

    ``how="inner"`` keeps (geo, year) pairs present for every indicator (C8),
    ``"outer"`` keeps all (C9).
    """
    pk = [k for k in keys if k != "indicator"] + [GEO, "year"]
    ind = F.col("indicator")
    aggs = [F.max(F.when(ind == i, F.col("value"))).alias(f"total_{i}") for i in indicators]
    aggs += [F.max(F.when(ind == i, F.lit(1))).alias(f"_has_{i}") for i in indicators]
    out = long.where(ind.isin(*indicators)).groupBy(*pk).agg(*aggs)
    if how == "inner":
        out = out.where(reduce(lambda a, b: a & b, [F.col(f"_has_{i}") == 1 for i in indicators]))
    out = out.drop(*[f"_has_{i}" for i in indicators])
    return out.withColumnRenamed(GEO, geo_name) if geo_name != GEO else out


def regional_rollup(assembled: DataFrame, keys, indicators) -> DataFrame:
    """Regional sums of every indicator by year (strict sums)."""
    keys = [k for k in keys if k != "indicator"]
    return assembled.groupBy(*keys, "year").agg(
        *[strict_sum(f"total_{i}").alias(f"total_{i}") for i in indicators])


def series_wide(long: DataFrame, keys, years) -> DataFrame:
    """One published table per indicator, one column per year."""
    return long.groupBy(*keys, GEO).pivot("year", list(years)).agg(F.max("value"))
