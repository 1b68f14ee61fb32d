"""Token-id shards with a minimal perfect hash index over document keys.

Files, in the shared folder:

* ``shard-N.ids``: the ids of the shard's documents back to back (unsigned 16-
  or 32-bit little-endian, by vocabulary size), then the documents' first
  positions and the end as unsigned 64-bit, then their number.  Shards follow
  ascending ``doc_id``, as do documents in a shard.
* ``index-N.mph``: index segments.  A key's segment is a hash; in a segment,
  levels of bit arrays give the key its slot (the rank of the first level's bit
  that is the key's alone), and the slot stores a 32-bit fingerprint, shard, position and
  number of ids, ordinal and number of rows.  A lookup reads a bounded number of
  bits, one slot, the shard's last 16 bytes and the payload, whatever the number
  of documents of index and shard; unknown keys fail the fingerprint but for one
  in 2**32.

Defined cases: null or empty text is the end id alone; a null ``doc_id`` sorts
first and has a key of its own; rows that share a ``doc_id`` are adjacent in
one shard, ordered by text, and the index holds the first with their number;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm import storage
from stratum.llm import text as T

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
SEGMENT_KEYS = 16_384
CACHE_ENTRIES = 400_000     # chunks remembered by a worker; only speed depends on it
GAMMA = 2.0                 # bits of a level for each key that reaches it
SLOT = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("ordinal", "<u4"), ("rows", "<u4"), ("first", "<u8"), ("size", "<u8")])
GAP = 1 << 16               # ids between documents that are read along rather than skipped


class ChunkIds:
    """Ids of chunks by the tokenizers library, distinct chunks once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark has a task for each core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[bytes, int] = {}
        self.flat, self.lens = np.zeros(0, self.dtype), np.zeros(0, np.int64)

    def take(self, chunks: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the indexed chunks in order, their number for each)."""
        new = [c for c in chunks if c not in self.known]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([c.decode() for c in new], add_special_tokens=False)]
        number = self.known | dict(zip(new, range(len(self.known), len(self.known) + len(new))))
        flat = np.r_[self.flat, np.fromiter(chain.from_iterable(ids), self.dtype)]
        lens = np.r_[self.lens, np.fromiter(map(len, ids), np.int64, len(ids))]
        if len(number) <= CACHE_ENTRIES:
            self.known, self.flat, self.lens = number, flat, lens
        row = np.fromiter((number[c] for c in chunks), np.int64, len(chunks))[index]
        starts = np.cumsum(lens) - lens
        return T.ragged_take(flat, starts[row], lens[row]), lens[row]


@lru_cache(2)
def chunk_ids(path: str) -> ChunkIds:
    return ChunkIds(path)


def write_shards(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Encode and write all rows; ``doc_id, shard, ordinal, first, size`` (place
    among the shard's documents; position and number of its ids) as a staged table."""
    T.prepare(docs.sparkSession)

    def write(batches):
        from pyspark import TaskContext
        shard, ids, sizes = TaskContext.get().partitionId(), [], [np.zeros(1, np.int64)]
        coder = chunk_ids(tokenizer)

        def parts():
            for batch in batches:
                for part in T.split_batch(batch, "text"):
                    known, index, offs = T.chunks(part.column("text"))
                    flat, lens = coder.take(known, index)
                    n = T.row_sums(lens, offs)
                    ids.append(part.column("doc_id"))
                    sizes.append(n + 1)
                    yield np.insert(flat, np.cumsum(n), end_id).astype(coder.dtype).tobytes()
            yield np.cumsum(np.concatenate(sizes)).astype("<u8").tobytes()
            yield np.array([sum(map(len, ids))], "<u8").tobytes()

        storage.write_atomic(f"{path}/shard-{shard}.ids", parts())
        at = first = 0
        for column, size in zip(ids, sizes[1:]):
            n = len(column)
            ends = first + np.cumsum(size)
            yield pa.RecordBatch.from_arrays([column, pa.array(np.full(n, shard, np.int64)), pa.array(np.arange(at, at + n)), pa.array(ends - size), pa.array(size)],
                                             ["doc_id", "shard", "ordinal", "first", "size"])
            at += n
            first += int(size.sum())

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return storage.stage(ordered.mapInArrow(write, "doc_id long, shard long, ordinal long, first long, size long"), "token-rows")


def key_hash(keys: pa.Array, level: int) -> np.ndarray:
    """64-bit hash of keys (null: a key of its own), a function for each level."""
    x = np.asarray(keys.fill_null(0)).astype(np.int64).view(np.uint64).copy()
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15) * np.uint64(2 * level + 1)
        x[np.asarray(keys.is_null())] = np.uint64(0xD6E8FEB86659FD93) * np.uint64(2 * level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mark_of(keys: pa.Array) -> np.ndarray:
    return (key_hash(keys, 1 << 20) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


class Segment:
    """Minimal perfect hash of a segment's keys, and their slots."""

    def __init__(self, levels: list[np.ndarray], slots: np.ndarray):
        self.levels, self.slots = levels, slots
        counts = np.cumsum([0, *(int(b.sum()) for b in levels)])
        self.ranks = [np.cumsum(b) - b + c for b, c in zip(levels, counts)]

    def slot_of(self, keys: pa.Array) -> np.ndarray:
        """Slot for each key, -1 where no level has its bit."""
        out, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            at = (key_hash(keys.take(pa.array(left)), level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out

    def get(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(found, slot records) for each key."""
        slot = self.slot_of(keys)
        record = self.slots[np.maximum(slot, 0)] if len(self.slots) else np.zeros(len(keys), SLOT)
        return (slot >= 0) & (record["mark"] == mark_of(keys)), record

    @classmethod
    def build(cls, keys: pa.Array, shard, ordinal, rows, first=0, size=0) -> Segment:
        """``keys`` are distinct.  A level keeps the keys that are alone at
        their bit; the others go on to the next."""
        levels, left = [], np.arange(len(keys))
        while len(left):
            width = max(8, int(GAMMA * len(left)))
            at = (key_hash(keys.take(pa.array(left)), len(levels)) % np.uint64(width)).astype(np.int64)
            bits = np.bincount(at, minlength=width) == 1
            levels.append(bits)
            left = left[~bits[at]]
        self = cls(levels, np.zeros(len(keys), SLOT))
        slot = self.slot_of(keys)
        for name, values in (("mark", mark_of(keys)), ("shard", shard), ("ordinal", ordinal), ("rows", rows), ("first", first), ("size", size)):
            self.slots[name][slot] = values
        return self

    def dump(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels), len(self.slots)], "<u4")
        return b"".join([head.tobytes(), *(np.packbits(b).tobytes() for b in self.levels), self.slots.tobytes()])

    @classmethod
    def load(cls, data: bytes) -> Segment:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        head = np.frombuffer(data, "<u4", n + 2)
        at, levels = head.nbytes, []
        for size in map(int, head[1:-1]):
            packed = np.frombuffer(data, np.uint8, (size + 7) // 8, at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += packed.nbytes
        return cls(levels, np.frombuffer(data, SLOT, int(head[-1]), at))


def runs(batches, key: str):
    """(key, batch) for each run of equal ``key`` in sorted Arrow batches, run
    by run; a run may be given in several batches."""
    for batch in batches:
        k = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else []
        for a, b in zip(cuts, [*cuts[1:], len(k)]):
            yield k[a], batch.slice(a, b - a)


def whole_runs(batches, key: str):
    """As ``runs``, each run as one table."""
    held, parts = None, []
    for k, part in runs(batches, key):
        if parts and k != held:
            yield held, pa.Table.from_batches(parts)
            parts = []
        held = k
        parts.append(part)
    if parts:
        yield held, pa.Table.from_batches(parts)


def segment_of(doc_id, segments: int):
    return F.pmod(F.xxhash64(doc_id, doc_id.isNull()), F.lit(segments)).alias("segment")


def write_index(rows: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Index every row of ``write_shards``: (directory of segments, their
    number).  A segment has about ``SEGMENT_KEYS`` keys at any input size."""
    segments = max(1, -(-rows.count() // SEGMENT_KEYS))
    first = rows.groupBy("doc_id").agg(F.min("shard").alias("shard"), F.min("ordinal").alias("ordinal"),
                                       F.count(F.lit(1)).alias("rows"), F.min("first").alias("first"), F.sum("size").alias("size"))
    keyed = first.withColumn("segment", segment_of(F.col("doc_id"), segments))

    def write(batches):
        from pyspark import TaskContext
        name = f"index-{TaskContext.get().partitionId()}.mph"
        found, at = [], 0

        def parts():
            nonlocal at
            for segment, t in whole_runs(batches, "segment"):
                col = {c: t.column(c).combine_chunks() for c in t.column_names}
                data = Segment.build(col["doc_id"], *(np.asarray(col[c]) for c in SLOT.names[1:])).dump()
                found.append((int(segment), name, at, len(data)))
                at += len(data)
                yield data

        storage.write_atomic(f"{path}/{name}", parts())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["segment", "file", "at", "size"])

    built = keyed.repartition("segment").sortWithinPartitions("segment").mapInArrow(
        write, "segment long, file string, at long, size long")
    return storage.stage(built, "token-index"), segments


def lookup(keys: DataFrame, path: str, directory: DataFrame, segments: int) -> DataFrame:
    """``doc_id, shard, ordinal, rows, first, size`` of each ``doc_id`` of ``keys``
    that the index holds."""
    asked = keys.select("doc_id").withColumn("segment", segment_of(F.col("doc_id"), segments))

    def find(batches):
        held, index = None, None
        for segment, part in runs(batches, "segment"):
            if segment != held:
                fs, top = storage.filesystem(path)
                name, at, size = (part.column(c)[0].as_py() for c in ("file", "at", "size"))
                with fs.open_input_file(f"{top}/{name}") as f:
                    f.seek(at)
                    held, index = segment, Segment.load(f.read(size))
            keys = part.column("doc_id")
            found, record = index.get(keys)
            out = [keys, *(pa.array(record[c].astype(np.int64)) for c in SLOT.names[1:])]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", *SLOT.names[1:]]).filter(pa.array(found))

    located = asked.join(directory, "segment").repartition("segment").sortWithinPartitions("segment")
    return located.select("doc_id", "segment", "file", "at", "size").mapInArrow(
        find, ", ".join(["doc_id long", *(f"{c} long" for c in SLOT.names[1:])]))


class Shard:
    """A shard's file: only its last 16 bytes are read to open it."""

    def __init__(self, f):
        self.f = f
        size = f.size()
        f.seek(size - 16)
        self.ids, self.documents = map(int, np.frombuffer(f.read(16), "<u8"))
        self.table = size - 8 * (self.documents + 2)        # where the documents' first positions are
        self.dtype = np.dtype("<u2" if self.table <= 2 * self.ids else "<u4")

    @classmethod
    def open(cls, path: str, shard: int) -> Shard:
        fs, top = storage.filesystem(path)
        return cls(fs.open_input_file(f"{top}/shard-{shard}.ids"))

    def read(self, first: int, size: int) -> np.ndarray:
        """``size`` ids from the position ``first``."""
        self.f.seek(first * self.dtype.itemsize)
        return np.frombuffer(self.f.read(size * self.dtype.itemsize), self.dtype).astype("<u4")

    def bounds(self, ordinal: int, rows: int) -> np.ndarray:
        """First positions of ``rows`` documents, and the end."""
        self.f.seek(self.table + 8 * ordinal)
        return np.frombuffer(self.f.read(8 * (rows + 1)), "<u8").astype(np.int64)


def near_runs(first: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
    """Slices of ascending documents that are read at once: those with more than
    ``GAP`` ids between them are not."""
    cuts = np.flatnonzero(first[1:] > first[:-1] + size[:-1] + GAP) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(first)]))


def shard_starts(rows: DataFrame, path: str) -> DataFrame:
    """``shard, base``: ids in all shards before, from the files' own ends; a
    row for each shard."""
    def ends(batches):
        for batch in batches:
            n = []
            for shard in batch.column("shard").to_pylist():
                n.append(Shard.open(path, shard).ids)
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(n, pa.int64())], ["shard", "n"])

    each = rows.select("shard").distinct().mapInArrow(ends, "shard long, n long")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return each.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_documents(located: DataFrame, path: str, bases: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read from the shards for every
    row that ``lookup`` located."""
    def read(batches):
        held, shard = None, None
        for number, part in runs(batches, "shard"):
            if number != held:
                held, shard = number, Shard.open(path, int(number))
            first, size, ordinal, rows = (part.column(c).to_numpy() for c in ("first", "size", "ordinal", "rows"))
            keys, at, n, crc = [], [], [], []
            for i, j in near_runs(first, size):
                base = int(first[i])
                ids = shard.read(base, int(first[j - 1] + size[j - 1]) - base)
                for k in range(i, j):
                    ends = [int(first[k]), int(first[k] + size[k])] if rows[k] == 1 else shard.bounds(int(ordinal[k]), int(rows[k])).tolist()
                    for a, b in zip(ends, ends[1:]):
                        keys.append(k)
                        at.append(a)
                        n.append(b - a)
                        crc.append(zlib.crc32(ids[a - base:b - base].tobytes()))
            keys = pa.array(keys, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(keys), part.column("shard").take(keys), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "shard", "at", "n_tokens", "ids_crc32"])

    got = located.repartition("shard").sortWithinPartitions("shard", "ordinal").mapInArrow(
        read, "doc_id long, shard long, at long, n_tokens long, ids_crc32 long")
    return got.join(bases, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_shards(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Write shards and index for ``docs``, then look every document up and
    read its ids back."""
    path = storage.folder(docs.sparkSession, "token-shards")
    rows = write_shards(docs, path, tokenizer, end_id)
    directory, segments = write_index(rows, path)
    located = lookup(docs.select("doc_id").distinct(), path, directory, segments)
    return read_documents(located, path, shard_starts(rows, path))
