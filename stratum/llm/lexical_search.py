r"""Ranked lexical search by Block-Max MaxScore over an inverted index.

Terms are the maximal runs of ASCII letters, digits and characters beyond
ASCII, with A-Z lower-cased.  ``build_index`` reads all texts twice: for the
number of documents with a term and of all terms (two sums), then to write the
index, a staged table in the shared folder:

* A shard holds consecutive rows of a task, up to ``SHARD_DOCS`` documents or
  ``SHARD_BYTES`` of text.  One of its rows has the documents' keys and norms.
* Every term of a shard has a row: its posting list in blocks of ``BLOCK``
  postings, each packed by itself in the narrowest width (gaps of document
  numbers, then occurrences), a header for each block (last document, highest
  impact, place and widths), and the list's highest impact.

``search`` takes its queries in blocks of about ``QUERY_ENTRIES`` terms.  Only the
posting lists of their terms are read; those of a shard meet in one task, which
answers each query by ranges of ``RANGE`` documents, those with the highest sum
of block maxima first, until that sum is below the query's k-th best score so
far in the task:

* Lists are ordered by their global bound, weight times highest impact.  The
  longest run of the lowest whose bounds sum to less than the k-th best score is
  non-essential: no document of theirs alone can be a result.
* The essential lists' postings in the range give the candidates.
* Non-essential lists follow from the highest bound.  A candidate is dropped,
  before the block is unpacked, if its score so far, the maximum of the block
  that could hold it, and the bounds of the lists still lower cannot reach the
  k-th best score.  The rest have their impacts added.

Every task keeps k documents a query; these heaps are merged by a rank within
each query, cut to k on each side of the shuffle.

Scores are exact integers: ``N`` documents with a term, ``L`` terms of all,
``n`` of a document, ``df`` documents with the term, ``tf`` its occurrences::

    w = floor(1000 ln((2 N + 2) / (2 df + 1)))    m = 25 + (75 n N) div L
    score = sum over the query's terms of w * ((10^9 tf) div (1000 tf + 8 m))

Defined cases: null, empty or termless texts are no documents of the index and
find nothing as queries; each row is a document and each query row a query of
its own, whatever its key; equal scores rank by ascending key, null last;
repeated terms of a query count as often; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm import storage
from stratum.llm import text as T
from stratum.llm.token_shards import whole_runs

K = 10
BLOCK = 128
SHARD_DOCS, SHARD_BYTES = 16_384, 16 << 20
RANGE = 1024
QUERY_ENTRIES = 1 << 19
_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_FOLD = np.where(_TERM, T.LOWER, np.uint8(32))
HEAD = np.dtype([("last", "<u4"), ("top", "<u4"), ("at", "<u4"), ("rows", "<u2"), ("gap", "u1"), ("tf", "u1")])
_POSTINGS = "shard long, term binary, df long, top long, heads binary, data binary, keys array<long>, norms array<long>"


class Index(NamedTuple):
    table: DataFrame         # a row for each shard and term, one with the documents for each shard
    documents: int           # documents with a term
    terms: int               # of all documents


def terms(column):
    """(distinct terms, term index in order, row offsets into it)."""
    data, offs = T.buffers(column)
    return T.words(T.pieces(_FOLD[data], offs[:-1]))


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms of all documents)."""
    def count(batches):
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                data, offs = T.buffers(part.column("text"))
                own = _TERM[data]
                first = own.copy()
                first[1:] &= ~own[:-1]
                cuts = offs[:-1][offs[:-1] < len(data)]
                first[cuts] = own[cuts]
                n = T.row_sums(first, offs)
                yield pa.RecordBatch.from_pydict({"n": [int((n > 0).sum())], "l": [int(n.sum())]})

    r = docs.select("text").mapInArrow(count, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return r[0] or 0, r[1] or 0


def narrowest(most: np.ndarray) -> np.ndarray:
    """Bytes (1, 2 or 4) that hold each value."""
    return np.where(most < 256, 1, np.where(most < 65536, 2, 4))


def scatter(out: np.ndarray, at: np.ndarray, width: np.ndarray, values: np.ndarray) -> None:
    """Write ``values``, little-endian, of ``width`` bytes at ``at``."""
    for k in range(4):
        some = width > k
        out[at[some] + k] = (values[some] >> (8 * k)) & 255


def impact(tf, m):
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def shard_rows(shard: int, column, keys, documents: int, total: int) -> pa.RecordBatch:
    """The index rows of one shard's texts."""
    known, index, offs = terms(column)
    n = np.diff(offs)
    m = 25 + 75 * n * documents // max(1, total)
    doc = np.repeat(np.arange(len(n)), n)
    post, tf = np.unique(index * len(n) + doc, return_counts=True)
    of, doc = post // max(1, len(n)), post % max(1, len(n))
    size = np.bincount(of, minlength=len(known))
    start = np.cumsum(size) - size
    place = np.arange(len(post)) - start[of]                    # in its list
    head = np.flatnonzero(place % BLOCK == 0)                   # first posting of each block
    block = np.cumsum(place % BLOCK == 0) - 1
    rows = np.diff(np.r_[head, len(post)])
    gap = doc - np.where(place > 0, np.r_[0, doc[:-1]], -1)
    score = impact(tf, m[doc])
    reduce = lambda ufunc, x: ufunc.reduceat(x, head) if len(head) else np.zeros(0, np.int64)
    wide, wtf, top = narrowest(reduce(np.maximum, gap)), narrowest(reduce(np.maximum, tf)), reduce(np.maximum, score)
    span = rows * (wide + wtf)
    at = np.cumsum(span) - span
    data = np.zeros(int(span.sum()), np.uint8)
    inside = place % BLOCK
    scatter(data, at[block] + inside * wide[block], wide[block], gap)
    scatter(data, (at + rows * wide)[block] + inside * wtf[block], wtf[block], tf)
    first = np.searchsorted(head, np.r_[start, len(post)])      # first block of each list
    edges = np.r_[at, len(data)][first]
    heads = np.zeros(len(head), HEAD)
    heads["last"], heads["top"], heads["rows"], heads["gap"], heads["tf"] = doc[head + rows - 1], top, rows, wide, wtf
    heads["at"] = at - np.repeat(edges[:-1], np.diff(first))
    best = np.maximum.reduceat(top, first[:-1]) if len(known) else np.zeros(0, np.int64)
    binary = lambda raw, cuts: pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(raw)])
    none = pa.nulls(len(known), pa.list_(pa.int64()))
    lists = [pa.array(np.full(len(known), shard)), pa.array(known, pa.binary()), pa.array(size), pa.array(best),
             binary(heads.tobytes(), first * HEAD.itemsize), binary(data.tobytes(), edges), none, none]
    one = [pa.array([shard]), pa.nulls(1, pa.binary()), pa.array([int((n > 0).sum())]), pa.array([0]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
           pa.array([keys.to_pylist()], pa.list_(pa.int64())), pa.array([m.tolist()], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]) for a, b in zip(one, lists)],
                                      ["shard", "term", "df", "top", "heads", "data", "keys", "norms"])


def build_index(docs: DataFrame, key: str = "doc_id") -> Index:
    """Index every row of ``docs`` (``text``, and ``key``, a long)."""
    T.prepare(docs.sparkSession)
    docs = docs.select(F.col(key).alias("key"), "text")
    documents, total = corpus_size(docs)

    def write(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId() << 32
        held, rows, size = [], 0, 0
        for batch in batches:
            for part in T.split_batch(batch, "text", SHARD_BYTES // 4):
                held.append(part)
                rows += part.num_rows
                size += part.column("text").nbytes
                if rows >= SHARD_DOCS or size >= SHARD_BYTES:
                    yield flush(shard, held)
                    held, rows, size, shard = [], 0, 0, shard + 1
        if rows:
            yield flush(shard, held)

    def flush(shard, held):
        table = pa.Table.from_batches(held).combine_chunks()
        return shard_rows(shard, table.column("text"), table.column("key").combine_chunks(), documents, total)

    return Index(storage.stage(docs.mapInArrow(write, _POSTINGS), "lexical-index"), documents, total)


class PostingList:
    """A term's list in one shard; blocks are unpacked when first used."""

    def __init__(self, df: int, top: int, heads: bytes, data: bytes, norms: np.ndarray):
        self.df, self.top, self.data, self.norms = df, top, data, norms
        self.heads = np.frombuffer(heads, HEAD)
        self.last = self.heads["last"].astype(np.int64)
        self.tops = self.heads["top"].astype(np.int64)
        self.blocks: dict[int, tuple] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(document numbers, impacts) of a block."""
        if b not in self.blocks:
            h = self.heads[b]
            rows, gap, at = int(h["rows"]), int(h["gap"]), int(h["at"])
            docs = np.frombuffer(self.data, f"<u{gap}", rows, at).astype(np.int64).cumsum() + (self.last[b - 1] if b else -1)
            tf = np.frombuffer(self.data, f"<u{int(h['tf'])}", rows, at + rows * gap).astype(np.int64)
            self.blocks[b] = docs, impact(tf, self.norms[docs])
        return self.blocks[b]

    def within(self, lo: int, hi: int) -> range:
        """Blocks that may hold documents from ``lo`` to before ``hi``."""
        a, b = np.searchsorted(self.last, [lo, hi - 1])
        return range(int(a), min(int(b) + 1, len(self.last)))

    def range_tops(self, ranges: int) -> np.ndarray:
        """The highest impact that each range of documents may have."""
        out = np.zeros(ranges, np.int64)
        a = np.r_[0, self.last[:-1] + 1] // RANGE
        for step in range(int((self.last // RANGE - a).max()) + 1):
            at = np.minimum(a + step, self.last // RANGE)
            np.maximum.at(out, at, self.tops)
        return out


class Best:
    """The k best (score, key) of a query so far; null keys rank last."""

    def __init__(self, k: int):
        self.k, self.scores, self.keys, self.absent = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """The score that a further document needs."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores, keys, absent) -> None:
        s, x, y = np.r_[self.scores, scores], np.r_[self.keys, keys], np.r_[self.absent, absent]
        order = np.lexsort((x, y, -s))[:self.k]
        self.scores, self.keys, self.absent = s[order], x[order], y[order]


def max_score(lists: list[tuple[int, PostingList, np.ndarray]], documents: int, keys: np.ndarray, absent: np.ndarray, best: Best) -> None:
    """Add a shard's best documents for one query: ``lists`` has the weight, list
    and range maxima of each of its terms there."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].top)
    bounds = np.cumsum([w * p.top for w, p, _ in lists])          # of a list and all lower ones
    possible = sum(w * tops for w, _, tops in lists)
    for r in np.argsort(-possible, kind="stable").tolist():
        need = best.least
        if possible[r] < need:
            break
        essential = int(np.searchsorted(bounds, need))            # lists before it cannot reach the need together
        lo, hi = r * RANGE, min(documents, (r + 1) * RANGE)
        score = np.zeros(hi - lo, np.int64)
        for w, p, _ in lists[essential:]:
            for b in p.within(lo, hi):
                docs, own = p.block(b)
                x, y = np.searchsorted(docs, [lo, hi]) if docs[0] < lo or docs[-1] >= hi else (0, len(docs))
                score[docs[x:y] - lo] += w * own[x:y]
        found = np.flatnonzero(score)
        for t in range(essential - 1, -1, -1):
            w, p, _ = lists[t]
            found = found[score[found] + bounds[t] >= need]
            if not len(found):
                break
            at = np.searchsorted(p.last, found + lo)
            top = np.r_[p.tops, 0][at]
            found = found[score[found] + w * top + (bounds[t - 1] if t else 0) >= need]
            at = np.searchsorted(p.last, found + lo)
            for b in np.unique(at[at < len(p.last)]).tolist():
                docs, own = p.block(b)
                mine = found[at == b]
                x = np.minimum(np.searchsorted(docs, mine + lo), len(docs) - 1)
                score[mine] += np.where(docs[x] == mine + lo, w * own[x], 0)
        found = found[score[found] >= need]
        if len(found):
            best.add(score[found], keys[found + lo], absent[found + lo])


def query_entries(queries: DataFrame, key: str) -> DataFrame:
    """``query`` (its number), ``item`` (its key), ``term, q`` (occurrences)."""
    def split(batches):
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                known, index, offs = terms(part.column("text"))
                row = np.repeat(np.arange(part.num_rows), np.diff(offs))
                own, q = np.unique(row * max(1, len(known)) + index, return_counts=True)
                row, term = own // max(1, len(known)), own % max(1, len(known))
                yield pa.RecordBatch.from_arrays([part.column("query").take(pa.array(row)), part.column("item").take(pa.array(row)),
                                                  pa.array(known, pa.binary()).take(pa.array(term)), pa.array(q)], ["query", "item", "term", "q"])

    rows = queries.select(F.monotonically_increasing_id().alias("query"), F.col(key).alias("item"), "text")
    return rows.mapInArrow(split, "query long, item long, term binary, q long")


def search(index: Index, queries: DataFrame, key: str = "item_id", k: int = K) -> DataFrame:
    """``item, rank, key, score``: the ``k`` best documents of each query row."""
    spark = queries.sparkSession
    T.prepare(spark)
    empty = spark.createDataFrame([], "item long, rank int, key long, score long")
    entries = storage.stage(query_entries(queries, key), "lexical-queries")
    blocks = -(-entries.count() // QUERY_ENTRIES)
    if not blocks or not index.documents:
        return empty
    df = index.table.join(entries.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * index.documents + 2) / (2 * F.col("df") + 1)))
    weights = df.select("term", weight.alias("w")).where("w > 0")
    weighted = storage.stage(entries.join(weights, "term").withColumn("w", F.col("w") * F.col("q"))
                             .withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks))), "lexical-weights")
    found = [_search_block(index, weighted.where(F.col("block") == b).drop("block", "q"), k) for b in range(blocks)]
    merged = found[0]
    for other in found[1:]:
        merged = merged.union(other)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item", "rank", "key", "score")


def _search_block(index: Index, entries: DataFrame, k: int) -> DataFrame:
    """``query, item, key, score``: each task's best documents for the queries
    of one block."""
    t = entries.toArrow()                                         # about QUERY_ENTRIES rows
    plan: dict[int, tuple] = {}
    for query, item, term, w in zip(*(t.column(c).to_pylist() for c in ("query", "item", "term", "w"))):
        plan.setdefault(query, (item, []))[1].append((term, w))
    sent = index.table.sparkSession.sparkContext.broadcast(plan)

    def run(batches):
        queries = sent.value
        best = {query: Best(k) for query in queries}
        for _, shard in whole_runs(batches, "shard"):
            get = {c: shard.column(c).to_pylist() for c in ("term", "df", "top", "heads", "data")}
            docs = get["term"].index(None)
            keys, norms = (shard.column(c)[docs].values for c in ("keys", "norms"))
            absent, keys, norms = np.asarray(keys.is_null()), np.asarray(keys.fill_null(0)), np.asarray(norms)
            lists = {}
            for term, df, top, heads, data in zip(*get.values()):
                if term is not None:
                    p = PostingList(df, top, heads, data, norms)
                    lists[term] = p, p.range_tops(-(-len(norms) // RANGE))
            for query, (_, weights) in queries.items():
                own = [(w, *lists[term]) for term, w in weights if term in lists]
                if own:
                    max_score(own, len(norms), keys, absent, best[query])
        for query, b in best.items():
            if len(b.scores):
                n = len(b.scores)
                yield pa.RecordBatch.from_arrays([pa.array([query] * n, pa.int64()), pa.array([queries[query][0]] * n, pa.int64()),
                                                  pa.array(b.keys, mask=b.absent), pa.array(b.scores)], ["query", "item", "key", "score"])

    # the terms of one block
    wanted = index.table.join(F.broadcast(entries.select("term").distinct()), "term", "left_semi")
    rows = wanted.union(index.table.where("term is null").select(*wanted.columns))
    rows = rows.repartition("shard").sortWithinPartitions("shard")
    return rows.select("shard", "term", "df", "top", "heads", "data", "keys", "norms").mapInArrow(run, "query long, item long, key long, score long")


def ranked_documents(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of each row
    of ``queries``."""
    return search(build_index(docs), queries, k=k).toDF("item_id", "rank", "doc_id", "score")
