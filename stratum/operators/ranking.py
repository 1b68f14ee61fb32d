"""Exact ranks and running sums inside groups, without one task per group.

A window ``partitionBy(group).orderBy(...)`` sorts a whole group in one
task; a group that holds a third of the rows would then hold a third of the
job.  Here rows are range-partitioned on ``(group, order)`` (Spark samples
the keys, so a hot group is cut across many partitions), sorted inside each
partition and numbered with ``monotonically_increasing_id`` (partition index
in the high bits, row index in the low bits).  The numbered rows are
written once so every later read sees the same numbers, then a small table of
per-(group, partition) counts gives each block its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.session import materialize


def rank_in_groups(df: DataFrame, group_cols, order_cols, running: dict | None = None,
                   totals: dict | None = None) -> DataFrame:
    """Add ``_rank`` (1-based, exact, ties impossible: ``order_cols`` must make
    a total order inside a group).

    ``running``: ``{out: col}`` adds ``out`` = sum of ``col`` over the rows
    ranked before this one in its group.  ``totals``: ``{out: col}`` adds the
    group-wide sum of ``col``.
    """
    group_cols = list(group_cols)
    running = running or {}
    totals = totals or {}
    ordered = (df.repartitionByRange(*group_cols, *order_cols)
                 .sortWithinPartitions(*group_cols, *order_cols)
                 .withColumn("_pos", F.monotonically_increasing_id()))
    ordered = materialize(ordered).withColumn("_part", F.shiftright("_pos", 33))
    block_keys = group_cols + ["_part"]
    aggs = [F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n")]
    aggs += [F.coalesce(F.sum(c), F.lit(0.0)).alias(f"_blk_{o}") for o, c in running.items()]
    aggs += [F.sum(c).alias(f"_tot_{o}") for o, c in totals.items()]
    blocks = ordered.groupBy(*block_keys).agg(*aggs)
    before = Window.partitionBy(*group_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    for o in running:
        blocks = blocks.withColumn(f"_off_{o}", F.coalesce(F.sum(f"_blk_{o}").over(before), F.lit(0.0)))
    for o in totals:
        blocks = blocks.withColumn(o, F.sum(f"_tot_{o}").over(whole))
    keep = block_keys + ["_first", "_before"] + [f"_off_{o}" for o in running] + list(totals)
    # one row per (group, partition): bounded by groups x shuffle partitions
    out = ordered.join(F.broadcast(blocks.select(*keep)), block_keys, "inner")
    out = out.withColumn("_rank", F.col("_before") + F.col("_pos") - F.col("_first") + 1)
    for o, c in running.items():
        local = Window.partitionBy(*block_keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn(o, F.col(f"_off_{o}") + F.coalesce(F.sum(c).over(local), F.lit(0.0)))
    return out.drop("_pos", "_part", "_first", "_before", *[f"_off_{o}" for o in running])
