"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in a hashed order, form blocks of about ``block_chars``
characters (a document belongs to the block in which it starts).  Let ``w`` be
the source's share of all weights, as an exact fraction.  Its block ``j`` is
released at slot ``floor(j / w)`` and due by ``ceil((j + 1) / w)``; earliest
deadline first over the released blocks meets every window, as the shares add
up to one, so after any number of slots a source with blocks left has had less
than one block more or less than its share, however long the input.  Once a
source has no block left its slots stay empty or are taken by others inside
their windows.  No document is dropped or repeated.

One task schedules all blocks, from a row per source: it holds one block a
source and writes a row per block (characters / ``block_chars``).  Blocks find
their slots by a join with these rows.  Ranks in a source come from range
partitions, so a source with most rows is spread over tasks.

Defined cases: a null source is a source of its own; null text has no
characters; equal rows share a slot; null or repeated ``doc_id`` are rows like
others; sources without a weight get the smallest given one; sources of weight
0 come after all others, in equal shares; a weight below 0 or not finite is an
error, as are slots over 2**63 and more than ``MAX_SOURCES`` sources, which is
what the scheduling task's memory holds; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import storage
from stratum.llm import text as T
from stratum.operators.ranking import rank_in_groups

BLOCK_CHARS = 50_000
PERIOD = 10_000
MAX_SOURCES = 1_000_000
POWER = 0.5        # default weights: characters of the source to this power
WRITE_ROWS = 50_000
BELOW_ONE = math.nextafter(1.0, 0.0)
PLAN = "mix_key string, block long, slot long, release long, deadline long, deviation double"


def quotas(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole blocks of each source in a period, one at least; they add up to
    ``period`` and follow the weights by largest remainder."""
    names = sorted(weights)
    total = sum(Fraction(weights[n]) for n in names)
    free = period - len(names)
    exact = {n: Fraction(weights[n]) * free / total if total else Fraction(free, len(names)) for n in names}
    out = {n: 1 + int(exact[n]) for n in names}
    short = period - sum(out.values())
    for n in sorted(names, key=lambda n: (int(exact[n]) - exact[n], n))[:short]:
        out[n] += 1
    return out


def whole(weights: list[float]) -> list[int]:
    """Whole numbers in the exact proportion of ``weights``."""
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*{e.denominator for e in exact})
    return [e.numerator * (scale // e.denominator) for e in exact]


def edf(weights: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """``(source, block, slot, release, deadline)`` of all blocks by slot.  A
    source's next block waits for the one before, which is due no later."""
    total = sum(weights)
    waiting = [(0, i) for i, n in enumerate(blocks) if n]
    ready: list = []
    at, slot = [0] * len(blocks), 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(at[i] + 1) * total // weights[i]), i))
        due, i = heapq.heappop(ready)
        j = at[i]
        yield i, j, slot, j * total // weights[i], due
        slot += 1
        at[i] = j + 1
        if j + 1 < blocks[i]:
            heapq.heappush(waiting, ((j + 1) * total // weights[i], i))


def schedule(quota: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """One period as (source, block in the period, slot, release, deadline)."""
    names = list(quota)
    return [(names[i], *rest) for i, *rest in edf(list(quota.values()), list(quota.values()))]


def plan(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int, float]]:
    """Slots of all blocks, as ``edf`` gives them, and the deviation: blocks up
    to the slot less the share of the slots.  Sources of weight 0 follow."""
    if not all(0 <= w < math.inf for w in weights):
        raise ValueError("weights must be finite and not below 0")
    first = 0
    for some in ([i for i, w in enumerate(weights) if w > 0], [i for i, w in enumerate(weights) if w == 0]):
        own = whole([weights[i] or 1 for i in some])
        total, last = sum(own), -1
        for k, j, slot, release, due in edf(own, [blocks[i] for i in some]):
            last = slot
            deviation = ((j + 1) * total - (slot + 1) * own[k]) / total      # exact below 1, but may round to it
            yield some[k], j, first + slot, first + release, first + due, min(deviation, BELOW_ONE)
        first += last + 1


def _key(source):
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source.cast("string")))


def planned(totals: DataFrame) -> DataFrame:
    """``PLAN`` from ``mix_key, weight, blocks``, a row per source: one task."""
    T.prepare(totals.sparkSession)

    def run(batches):
        rows = sorted(r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("mix_key", "weight", "blocks"))))
        keys, weights, blocks = ([r[i] for r in rows] for i in range(3))
        names, out = [f.split()[0] for f in PLAN.split(", ")], []
        for i, *rest in plan(weights, blocks):
            out.append((keys[i], *rest))
            if len(out) == WRITE_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)

    return storage.stage(totals.select("mix_key", "weight", "blocks").repartition(1).mapInArrow(run, PLAN), "mix-plan")


def slots(docs: DataFrame, weights: dict | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, source, text_hash, copies, before, block, slot, release,
    deadline, deviation`` for each distinct row of ``docs``.

    ``deviation`` is the source's blocks up to this slot less its share of the
    slots by the target weights, between -1 and 1.  ``weights`` maps source
    names to weights."""
    spark = docs.sparkSession
    size = F.coalesce(F.char_length("text"), F.lit(0))
    rows = docs.select("doc_id", "source", _key(F.col("source")).alias("mix_key"), F.xxhash64("text").alias("text_hash"), size.alias("size"))
    rows = rows.groupBy("mix_key", "source", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"), F.sum("size").alias("size"))
    ranked = rank_in_groups(rows.withColumn("mix_order", F.xxhash64("doc_id", "text_hash", F.lit(1))).withColumn("size", F.col("size").cast("double")),
                            ["mix_key"], ["mix_order", "doc_id", "text_hash"], running={"before": "size"})
    ranked = ranked.withColumn("block", F.floor(F.col("before") / block_chars).cast("long"))
    totals = ranked.groupBy("mix_key").agg(F.sum("size").alias("size"), (F.max("block") + 1).alias("blocks"))
    if totals.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: mix groups of them")
    if weights:
        given = spark.createDataFrame([("null" if k is None else f"={k}", float(w)) for k, w in weights.items()], "mix_key string, weight double")
        totals = totals.join(given, "mix_key", "left").withColumn("weight", F.coalesce("weight", F.lit(float(min(weights.values())))))
    else:
        totals = totals.withColumn("weight", F.pow(F.greatest("size", F.lit(1.0)), F.lit(POWER)))
    return ranked.join(planned(totals), ["mix_key", "block"]).select(
        "doc_id", "source", "text_hash", "copies", "before", "block", "slot", "release", "deadline", "deviation")


def mix(docs: DataFrame, weights: dict | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for every row of ``docs``: ``doc_id, source, block, slot, release,
    deadline, deviation``."""
    s = slots(docs, weights, block_chars)
    return s.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", "source", "block", "slot", "release", "deadline", "deviation")


def placed_documents(docs: DataFrame, weights: dict | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All rows and columns of ``docs`` with ``mix_slot`` and ``mix_before``
    (characters of the source before the row), in files by both.  Columns of
    these two names are replaced; no other name can clash."""
    s = slots(docs.select("doc_id", "source", "text"), weights, block_chars).select(
        F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), F.col("text_hash").alias("mix_hash"),
        F.col("slot").alias("mix_slot"), F.col("before").alias("mix_before"))
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_doc"))
    doc = F.col("mix_doc")
    same = (doc["doc_id"].eqNullSafe(F.col("mix_id")) & doc["source"].eqNullSafe(F.col("mix_source"))
            & (F.xxhash64(doc["text"]) == F.col("mix_hash")))
    own = [doc[c].alias(c) for c in docs.columns if c not in ("mix_slot", "mix_before")]
    placed = nested.join(s, same).select(*own, "mix_slot", "mix_before")
    return placed.repartitionByRange("mix_slot", "mix_before").sortWithinPartitions("mix_slot", "mix_before", "doc_id")


def mixed_documents(docs: DataFrame, weights: dict | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All rows and columns of ``docs``, in files that follow the mixture."""
    return placed_documents(docs, weights, block_chars).select(*docs.columns)
