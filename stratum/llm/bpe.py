"""Byte-level BPE encoding and decoding.

Distinct words (matches of the split pattern) are encoded by Spark's
higher-order functions: a fold over a word's byte pieces merges, step by step,
the leftmost adjacent pair of the lowest rank, looked up in a rank map (an array
of small maps, picked by hash, since a lookup in one map is linear).  The ranks
are a file of the shared folder, one row that each task is sent: as a literal
they were copied with every step of planning, and filled the driver's heap.
Each task then replaces words by their ids.  Decoding concatenates the binary
pieces of the ids.

The folded words are those that occur ``MIN_SEEN`` times in an Arrow batch
anywhere, the most frequent ``TABLE_ROWS`` of them at most, so what is sent to
the tasks is bounded.  The fold takes over 100 microseconds a word, too long
for the millions of words that occur once or twice; these are merged where they
occur, with a heap (``token_counts.count_merges``).  Both do the same merges,
and the choice has no influence on results.

Defined cases: null or empty text has no ids; repeated rows and null or
repeated ``doc_id`` give a row each; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.llm import storage
from stratum.llm import text as T
from stratum.llm.token_counts import byte_symbols, count_merges
from stratum.llm.toxicity import most_frequent

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BUCKETS = 4096
MIN_SEEN = 8
LONG_BYTES = 48              # longer words are not folded: the fold is quadratic
TABLE_ROWS = 1 << 15
CACHE_ENTRIES = 200_000      # rare words remembered by a worker; only speed depends on it
DECODE_BYTES = 1 << 18       # decoded at once: the index arrays take 24 times as much
FOLD_ROWS = 256              # words folded in a row, which share one copy of the maps


@lru_cache(2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(1)
def byte_text() -> str:
    """A printable character for each byte, so that pieces are strings."""
    return "".join(byte_symbols())


def as_symbols(piece: bytes) -> str:
    return piece.decode("latin-1").translate(byte_text())


def rank_text(ranks: dict[bytes, int], buckets: int = BUCKETS) -> str:
    """Pieces and ranks as lines, the buckets of the rank map apart."""
    held = [[] for _ in range(buckets)]
    for piece, rank in ranks.items():
        held[zlib.crc32(as_symbols(piece).encode()) % buckets].append(f"{as_symbols(piece)}\t{rank}")
    return "\x01".join("\n".join(b) for b in held)


def rank_maps(text: Column) -> Column:
    """The rank map of a ``rank_text``, as an array of small maps of pieces to ranks."""
    return F.transform(F.split(text, "\x01"), lambda b: F.str_to_map(b, F.lit("\n"), F.lit("\t")).cast("map<string,int>"))


def rank_table(spark, ranks: dict[bytes, int]) -> DataFrame:
    """``ranks``: one row, the ``rank_text``, read from a file of the shared folder."""
    path = storage.folder(spark, "bpe-ranks")
    storage.write_atomic(f"{path}/ranks.txt", [rank_text(ranks).encode()])
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "ranks")


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_word(word: Column, maps: Column, buckets: int = BUCKETS) -> Column:
    """Ids of a word in byte symbols: a fold of ranked merges over its pieces.

    The state holds the pieces and the rank of each joined with its next.  A
    step merges the leftmost pair of the lowest rank and looks up its two new
    neighbours; it does nothing once no pair has a rank."""
    none = F.array().cast("array<int>")

    def rank(piece):
        return F.try_element_at(F.get(maps, (F.crc32(piece.cast("binary")) % buckets).cast("int")), piece)

    def merge(state, at):
        p, r = state["p"], state["r"]
        whole = F.concat(F.get(p, at), F.get(p, at + 1))

        def place(x):
            return F.struct(
                F.concat(F.slice(p, 1, at), F.array(x), F.slice(p, at + 3, F.size(p))).alias("p"),
                F.concat(F.when(at > 0, F.concat(F.slice(r, 1, at - 1), F.array(rank(F.concat(F.get(p, at - 1), x))))).otherwise(none),
                         F.when(at + 2 < F.size(p), F.array(rank(F.concat(x, F.get(p, at + 2))))).otherwise(none),
                         F.slice(r, at + 3, F.size(p))).alias("r"))

        return bind(whole, place)

    def step(state, _):
        return bind(F.array_min(state["r"]), lambda best: F.when(best.isNull(), state).otherwise(
            bind(F.array_position(state["r"], best).cast("int") - 1, lambda at: merge(state, at))))

    n = F.char_length(word)
    symbols = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(word, i, F.lit(1)))
    pairs = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: rank(F.substring(word, i, F.lit(2))))).otherwise(none)
    steps = F.when(n > 1, F.sequence(F.lit(2), n)).otherwise(none)
    return F.aggregate(steps, F.struct(symbols.alias("p"), pairs.alias("r")), step, lambda s: F.transform(s["p"], rank))


def frequent_words(docs: DataFrame, min_seen: int = MIN_SEEN) -> DataFrame:
    """``word, n``: byte symbols of words that occur ``min_seen`` times in a
    batch, counted over such batches."""
    def count(batches):
        pattern = regex.compile(public_tokenizers.PATTERN)
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                known, index, _ = T.chunks(part.column("text"))
                n = np.bincount(index, minlength=len(known)).tolist()
                total: dict[str, int] = {}
                for chunk, k in zip(known, n):
                    for w in pattern.findall(chunk.decode()):
                        total[w] = total.get(w, 0) + k
                found = [(as_symbols(w.encode()), k) for w, k in total.items() if k >= min_seen and len(w.encode()) <= LONG_BYTES]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.string()), pa.array([k for _, k in found], pa.int64())], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fold_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``word, ids`` for each ``word`` in byte symbols."""
    n = max(1, -(-words.count() // FOLD_ROWS))
    rows = words.groupBy(F.pmod(F.xxhash64("word"), F.lit(n)).alias("part")).agg(F.collect_list("word").alias("words"))   # FOLD_ROWS each, by hash
    folded = bind(rank_maps(F.col("ranks")), lambda maps: F.transform("words", lambda w: F.struct(w.alias("word"), fold_word(w, maps).alias("ids"))))
    sent = F.broadcast(rank_table(words.sparkSession, ranks))
    return rows.repartition("part").crossJoin(sent).select(F.inline(folded))


def as_bytes(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Ids of chunks: folded words from a table, others by merging.  Ids are kept
    as bytes (little-endian, 32 bits): each Python worker of an executor has a
    table of its own."""

    def __init__(self, path: str, folded: dict[str, bytes]):
        ranks = ranks_of(path)
        self.folded = folded
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.merges = {}
        for piece, rank in ranks.items():
            found = rank, rank
            for i in range(1, len(piece)):
                left, right = ranks.get(piece[:i]), ranks.get(piece[i:])
                if left is not None and right is not None:
                    self.merges[left, right] = found
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.words: dict[str, bytes] = {}
        by_id = sorted(ranks, key=ranks.get)
        self.piece_len = np.array([len(p) for p in by_id])
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self.piece_bytes = np.frombuffer(b"".join(by_id), np.uint8)

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            raw = word.encode()
            ids = self.folded.get(as_symbols(raw)) if len(raw) <= LONG_BYTES else None
            if ids is None:
                ids = [self.single[b] for b in raw]
                count_merges(ids, self.merges)
                ids = as_bytes([i for i in ids if i >= 0])
            if len(self.words) < CACHE_ENTRIES and len(raw) < 64:
                self.words[word] = ids
        return ids

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, row offsets)."""
        known, index, offs = T.chunks(column)
        each = [b"".join([self.word(w) for w in self.pattern.findall(c.decode())]) for c in known]
        lens = np.fromiter(map(len, each), np.int64, len(each)) // 4
        flat = np.frombuffer(b"".join(each), "<u4")
        starts = np.cumsum(lens) - lens
        sizes = T.row_sums(lens[index], offs) if len(index) else np.zeros(len(column), np.int64)
        return T.ragged_take(flat, starts[index], lens[index]), np.r_[0, np.cumsum(sizes)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the pieces of ``ids``, in order."""
        return T.ragged_take(self.piece_bytes, self.piece_at[ids], self.piece_len[ids])

    def decoded(self, ids: np.ndarray, offs: np.ndarray, limit: int = DECODE_BYTES):
        """Bytes of each row in turn, decoded for about ``limit`` bytes at a time."""
        size = T.row_sums(self.piece_len[ids], offs)
        part = (np.cumsum(size) - size) // limit
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(size) else part
        for a, b in zip(cuts, [*cuts[1:], len(size)]):
            out, ends = self.decode(ids[offs[a]:offs[b]]), np.r_[0, np.cumsum(size[a:b])]
            for x, y in zip(ends[:-1], ends[1:]):
                yield out[x:y]


_CODERS: dict = {}


def coder(path: str, sent) -> WordIds:
    """This worker's coder for a broadcast table of folded words."""
    key = (path, sent.id if hasattr(sent, "id") else id(sent))
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = WordIds(path, sent.value)
    return _CODERS[key]


def encode_documents(docs: DataFrame, path: str = RANKS, table_rows: int = TABLE_ROWS) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` for every row: ids as little-endian
    unsigned 32-bit integers, and the bytes decoded from them."""
    return _coded(docs, path, table_rows, "doc_id long, n_tokens long, ids binary, decoded binary", lambda x: x.tobytes())


def bpe_digests(docs: DataFrame, path: str = RANKS, table_rows: int = TABLE_ROWS, keep: tuple = ()) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and the columns ``keep``
    for every row."""
    return _coded(docs, path, table_rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                  lambda x: hashlib.sha256(x.tobytes()).hexdigest(), keep)


def _coded(docs, path, table_rows, schema, form, keep=()) -> DataFrame:
    spark = docs.sparkSession
    T.prepare(spark)
    ranks = ranks_of(path)
    words = most_frequent(storage.stage(frequent_words(docs), "bpe-words"), F.col("n"), table_rows)
    folded = {r["word"]: as_bytes(r["ids"]) for r in fold_words(words.select("word"), ranks).collect()}    # table_rows at most
    sent = spark.sparkContext.broadcast(folded)
    schema = StructType.fromDDL(schema)
    for c in keep:
        schema.add(docs.schema[c])
    names = schema.names

    def code(batches):
        c = coder(path, sent)
        for batch in batches:
            for part in T.split_batch(batch, "text", 4 << 20):
                ids, offs = c.encode(part.column("text"))
                little = ids.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offs)), pa.array([form(little[a:b]) for a, b in zip(offs[:-1], offs[1:])]),
                     pa.array([form(x) for x in c.decoded(ids, offs)]), *(part.column(k) for k in keep)], names)

    return docs.select("doc_id", "text", *keep).mapInArrow(code, schema)
