r"""N-gram Jaccard join with signature trees.

A document's set holds its distinct shingles of five words
(``[^\x20\x09-\x0D]+``, A-Z lower-cased; a shorter text's whole sequence is
its one shingle) as 64-bit hashes.  Two documents link when their sets' Jaccard
similarity is at least ``PERCENT`` percent.  No link between different sets is
lost, and none is made without comparing whole sets:

1. Documents of equal sets form a class.  Classes go on, not copies.
2. Of a set of n shingles, the n - ceil(0.75 n) + 1 that come first in a common
   order are its prefix; linked sets share a prefix shingle.  The order puts
   frequent shingles last, by a count-min sketch of all documents' shingles of
   fixed size; any order is right, this one keeps groups small.
3. Classes that share one of ``BINS`` smallest hashes are compared with the
   first class of their group (by a hash), and verified links join them into cores.  So
   large groups of near copies are one core before pairs are looked for.
4. Classes that share a prefix shingle but not a core meet by shingle and size
   band (sizes of linked sets are in the same band or neighbouring ones).
   Groups of the same classes are one.  There a signature tree holds them: nodes
   have the OR of the token bitmaps, the range of sizes, and the one core, if it
   is one.  A dual traversal, level by level, leaves out pairs of nodes of one
   core, of sizes too far apart, of the band below only (their own group has
   those), or whose largest possible overlap is too small.  A pair of leaves left
   goes on from one of the groups where it meets, and is compared as sets.
   Groups over ``GROUP_ROWS`` are cut into blocks, each pair of which is a task's
   work; so no task holds more than two blocks.
5. Connected components of cores and links by rounds of joins.

Defined cases: null, empty or blank text has the empty set, links with nothing
and is its own component; a null ``doc_id`` takes part, but a component's id is
its smallest id that is not null (null if there is none); repeated rows and
repeated ids give a row each; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import storage
from stratum.llm import text as T
from stratum.llm.token_shards import whole_runs

WORDS = 5
PERCENT = 75
SKETCH = 1 << 23        # counters
FILTER_BITS = 1 << 24   # of the filter of texts whose sets are wanted
SLICES = 16
BINS = 16
BITS = 1024, 32_768     # of a set's bitmap: least and most, by its size
GROUP_ROWS = 2048
FANOUT = 8
CHUNK_PAIRS, CHUNK_BYTES = 4096, 4 << 20   # node pairs descended, bytes of bitmaps gathered at once
MEETINGS = 32           # groups of a class, the first by hash, that travel with it
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0x85EBCA77C2B2AE63)]


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(column) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes row by row, row offsets)."""
    known, index, offs = T.words(column, lower=True)
    n = len(index)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))[index]
    row = np.repeat(np.arange(len(column)), np.diff(offs))
    at = np.flatnonzero(row[:n - WORDS + 1] == row[WORDS - 1:]) if n >= WORDS else np.zeros(0, np.int64)
    h = np.zeros(len(at), np.uint64)
    for i in range(WORDS):
        h = mix64(h + w[at + i] * _C[i])
    rows = row[at]
    for r in np.flatnonzero((np.diff(offs) > 0) & (np.diff(offs) < WORDS)):
        words = w[offs[r]:offs[r + 1]]
        h = np.r_[h, np.uint64(xxhash.xxh64_intdigest(words.tobytes(), seed=len(words)))]
        rows = np.r_[rows, r]
    if np.any(rows[1:] < rows[:-1]):
        order = np.argsort(rows, kind="stable")
        h, rows = h[order], rows[order]
    cuts = np.searchsorted(rows, np.arange(len(column) + 1)).tolist()
    for a, b in zip(cuts, cuts[1:]):
        h[a:b].sort()
    first = np.r_[True, (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])] if len(h) else np.zeros(0, bool)
    h, rows = h[first], rows[first]
    return h, np.searchsorted(rows, np.arange(len(column) + 1))


def class_id(hashes: np.ndarray) -> int:
    """64-bit name of a set, unsigned."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=len(hashes))


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Token bitmap of two bits a shingle or more, within ``BITS``."""
    size = BITS[0]
    while size < min(2 * len(hashes), BITS[1]):
        size *= 2
    out = np.zeros(size, bool)
    out[(hashes >> np.uint64(20)).astype(np.int64) % size] = True
    return np.packbits(out)


def folded(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of the shortest one's length: the halves of longer ones
    are OR-combined."""
    size = min(map(len, bitmaps))
    out = np.zeros((len(bitmaps), size), np.uint8)
    for row, b in zip(out, bitmaps):
        np.bitwise_or.reduce(np.frombuffer(b, np.uint8).reshape(-1, size), axis=0, out=row)
    return out.view(np.uint64)


def describe(docs: DataFrame) -> DataFrame:
    """``kind`` 0: ``doc_id, n, c`` (class), hash ``t`` of the text, bitmap
    ``bits``, smallest hash of each bin ``mins``.  ``kind`` 1: a task's sketch
    slice ``c``, compressed, in ``bits``."""
    ddl = "kind int, doc_id long, n long, c long, t long, bits binary, mins array<long>"
    schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("c", pa.int64()), ("t", pa.int64()), ("bits", pa.binary()), ("mins", pa.list_(pa.int64()))])

    def run(batches):
        sketch = np.zeros(SKETCH, np.uint8)          # saturates: only the order of shingles depends on it
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                h, offs = shingle_sets(part.column("text"))
                at, k = np.unique((h >> np.uint64(8)) % np.uint64(SKETCH), return_counts=True)
                sketch[at] = np.minimum(sketch[at] + k, 255)
                n, c, bits, mins = np.diff(offs), [], [], []
                for a, b in zip(offs[:-1], offs[1:]):
                    own = h[a:b]
                    c.append(class_id(own))
                    bits.append(bitmap(own).tobytes() if b > a else None)
                    cuts = np.searchsorted(own, [np.uint64(i * (2**64 // BINS)) for i in range(1, BINS)])
                    cuts = [0, *cuts.tolist(), len(own)]
                    mins.append([int(own[x].view(np.int64)) for x, y in zip(cuts, cuts[1:]) if y > x])
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int32)), part.column("doc_id"), pa.array(n), pa.array(np.array(c, np.uint64).view(np.int64)),
                                                  part.column("t"), pa.array(bits, pa.binary()), pa.array(mins, pa.list_(pa.int64()))], schema=schema)
        if sketch.any():
            none = pa.nulls(SLICES, pa.int64())
            slices = [pa.compress(s.tobytes(), "zstd", asbytes=True) for s in np.split(sketch, SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(SLICES, np.int32)), none, none, pa.array(np.arange(SLICES)), none,
                                              pa.array(slices, pa.binary()), pa.nulls(SLICES, schema.field(6).type)], schema=schema)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("t")).mapInArrow(run, ddl)


def write_slices(rows: DataFrame, run, name: str) -> str:
    """The folder to which ``run`` brought slices: it makes ``(slice, bytes)`` of a
    partition's batches, and tasks write them to the shared folder, so that they
    pass neither through the driver nor through a broadcast."""
    path = storage.folder(rows.sparkSession, name)

    def write(batches):
        for c, data in run(batches):
            storage.write_atomic(f"{path}/slice-{c}", [data])
            yield pa.RecordBatch.from_pydict({"c": [c]})

    rows.repartition(SLICES, "c").mapInArrow(write, "c long").collect()       # SLICES small numbers
    return path


@lru_cache(2)
def read_slices(path: str, each: int, dtype: str) -> np.ndarray:
    """All slices one after the other, zeros for those never written; a worker
    reads them once."""
    from pyarrow import fs as pafs
    fs, folder = storage.filesystem(path)
    out = np.zeros((SLICES, each), dtype)
    for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
        if c := re.fullmatch(r"slice-(\d+)", f.base_name):
            with fs.open_input_stream(f.path) as source:
                out[int(c[1])] = np.frombuffer(source.read(), dtype)
    return out.ravel()


def total_sketch(described: DataFrame) -> str:
    """Folder of the sum of the tasks' sketches: ``SKETCH`` counters of 16 bits at
    any input size (they saturate); a slice is summed in one task, batch by batch."""
    each = SKETCH // SLICES

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, bits in zip(batch.column("c").to_pylist(), batch.column("bits")):
                own = np.frombuffer(pa.decompress(bits.as_buffer(), each, "zstd"), np.uint8)
                total = sums.setdefault(c, np.zeros(each, np.uint32))
                total += own
        for c, s in sums.items():
            yield c, np.minimum(s, 65535).astype("<u2").tobytes()

    return write_slices(described.where("kind = 1").select("c", "bits"), add, "ngram-sketch")


def prefix_entries(docs: DataFrame, sketch: str) -> DataFrame:
    """``token, c, n`` for each class and prefix shingle (a class may come from
    several tasks)."""
    def run(batches):
        freq, seen = read_slices(sketch, SKETCH // SLICES, "<u2"), set()
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                h, offs = shingle_sets(part.column("text"))
                n = np.diff(offs)
                names = [class_id(h[a:b]) for a, b in zip(offs[:-1], offs[1:])]
                fresh = np.zeros(len(n), bool)
                for i, c in enumerate(names):
                    fresh[i] = n[i] > 0 and c not in seen
                    if len(seen) < 1 << 16:
                        seen.add(c)
                count = freq[((h >> np.uint64(8)) % np.uint64(SKETCH)).astype(np.int64)]
                size = np.where(fresh, n - (n * PERCENT + 99) // 100 + 1, 0)
                chosen = [a + np.argsort(count[a:b], kind="stable")[:k] for a, b, k in zip(offs[:-1], offs[1:], size) if k]
                token = h[np.concatenate(chosen) if chosen else np.zeros(0, np.int64)].view(np.int64)
                rows = np.repeat(np.arange(len(n)), size)
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(np.array(names, np.uint64).view(np.int64)[rows]), pa.array(n[rows])], ["token", "c", "n"])

    return docs.select("text").mapInArrow(run, "token long, c long, n long")


def shared_entries(entries: DataFrame) -> DataFrame:
    """Distinct ``token, c, n`` of tokens that two classes or more have; groups
    are streamed, not gathered."""
    def run(batches):
        held = None                                  # last row; whether its token is already known as shared
        for batch in batches:
            t, c, n = (batch.column(k).to_numpy() for k in ("token", "c", "n"))
            if held is not None:
                t, c, n = (np.r_[np.int64(x), y] for x, y in zip(held[:3], (t, c, n)))
            if not len(t):
                continue
            same_token = t[1:] == t[:-1]
            new = np.r_[True, ~same_token | (c[1:] != c[:-1]) | (n[1:] != n[:-1])]
            carried = held is not None and held[3]
            t, c, n = t[new], c[new], n[new]
            more = t[1:] == t[:-1]
            shared = np.r_[False, more] | np.r_[more, False]
            out = shared[:-1].copy()
            if held is not None and carried and len(out):
                out[0] = False                       # given out with an earlier batch
            last = bool(shared[-1]) or (carried and len(t) == 1)
            if len(t) > 1:
                yield pa.RecordBatch.from_arrays([pa.array(x[:-1][out]) for x in (t, c, n)], ["token", "c", "n"])
            if shared[-1] and not (len(t) == 1 and carried):
                yield pa.RecordBatch.from_arrays([pa.array(x[-1:]) for x in (t, c, n)], ["token", "c", "n"])
            held = (t[-1], c[-1], n[-1], last)

    ordered = entries.repartition("token").sortWithinPartitions("token", "c", "n")
    return ordered.mapInArrow(run, "token long, c long, n long")


def filter_of(ids: DataFrame) -> str:
    """Folder of ``FILTER_BITS`` bits, on at the places of ``id``: no id of ``ids``
    is ruled out by it, and most others are while ids are fewer than bits."""
    each = FILTER_BITS // SLICES

    def run(batches):
        on: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, part in ((c, batch.filter(pc.equal(batch.column("c"), c))) for c in pc.unique(batch.column("c")).to_pylist()):
                on.setdefault(c, np.zeros(each, bool))[part.column("at").to_numpy()] = True
        for c, bits in on.items():
            yield c, np.packbits(bits).tobytes()

    # FILTER_BITS distinct places at most, whatever the number of ids
    place = ids.select(F.pmod("id", F.lit(FILTER_BITS)).alias("p")).distinct()
    return write_slices(place.select(F.floor(F.col("p") / each).alias("c"), (F.col("p") % each).alias("at")), run, "ngram-filter")


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, shingles`` of the classes ``ids`` (``id, t``: class, hash of one of
    its texts), made from the texts again: sets are not shuffled but for these
    classes, and few other texts are split into words."""
    path = filter_of(ids.select(F.col("t").alias("id")))

    def run(batches):
        on, seen = np.unpackbits(read_slices(path, FILTER_BITS // SLICES // 8, "u1")).astype(bool), set()
        for batch in batches:
            keep = on[batch.column("t").to_numpy() % FILTER_BITS]
            for i in np.flatnonzero(keep):
                t = batch.column("t")[int(i)].as_py()
                keep[i] = t not in seen
                if len(seen) < 1 << 16:
                    seen.add(t)
            for part in T.split_batch(batch.filter(pa.array(keep)), "text"):
                h, offs = shingle_sets(part.column("text"))
                names = np.array([class_id(h[a:b]) for a, b in zip(offs[:-1], offs[1:])], np.uint64)
                lists = pa.ListArray.from_arrays(offs.astype(np.int32), h.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), lists], ["id", "shingles"])

    found = docs.select("text", F.xxhash64("text").alias("t")).mapInArrow(run, "id long, shingles array<long>")
    return found.join(ids.select("id"), "id", "left_semi").dropDuplicates(["id"])


def may_link(na, nb, bits_a: list, bits_b: list) -> np.ndarray:
    """Whether the bitmaps of two classes leave a link possible, pair by pair:
    each bit that only one side has is a shingle outside the overlap."""
    off = [[int(np.bitwise_count(x & ~y).sum()) for x, y in (both, both[::-1])] for both in (folded(p) for p in zip(bits_a, bits_b))]
    most = np.minimum(na - np.array([x for x, _ in off]), nb - np.array([y for _, y in off]))
    return (100 + PERCENT) * most >= PERCENT * (na + nb)


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that neither sizes nor bitmaps rule out."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
                yield batch.select(["a", "b"]).filter(pa.array(may_link(na, nb, batch.column("xa").to_pylist(), batch.column("xb").to_pylist())))

    side = lambda k: classes.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"x{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where("100 * least(na, nb) >= 75 * greatest(na, nb)".replace("75", str(PERCENT)))
    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b`` of the pairs whose whole sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b")
            .where(100 * both >= PERCENT * (F.size("sa") + F.size("sb") - both)).select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """``id, core``: the smallest id that links reach, for every id in ``links``
    (``a, b``), by large-star and small-star rounds until nothing changes: until
    number, sum and xor of the links' hashes, measured as they are written, stay."""
    mark = F.xxhash64("a", "b")
    marks = {"n": F.count(F.lit(1)), "x": F.bit_xor(mark), "s": F.sum(mark.cast("decimal(38,0)"))}
    edges, state = storage.stage_measured(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links", marks)
    before = None
    while state != before:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.where("a < b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x < y").distinct()
        before = state
        edges, state = storage.stage_measured(small.toDF("a", "b"), "links", marks)
    return edges.select(F.col("b").alias("id"), F.col("a").alias("core")).union(edges.select("a", "a").distinct())


def signature_tree(sizes, cores, bits, own, height: int) -> list[tuple]:
    """Levels, leaves first, of a tree over rows sorted by core and size.  A node
    has its least size, largest size, core, whether that is the only one, the
    most shingles beyond its bits (``n`` less bits on), the OR-combined bitmap,
    and whether a row of it is of the group's own band."""
    level = sizes, sizes, cores, np.ones(len(sizes), bool), sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64), bits, own
    levels = [level]
    for _ in range(height):
        lo, hi, core, one, slack, bits, own = level
        at = np.arange(0, len(lo), FANOUT)
        low, high = np.minimum.reduceat(core, at), np.maximum.reduceat(core, at)
        level = (np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), low, np.logical_and.reduceat(one, at) & (low == high),
                 np.maximum.reduceat(slack, at), np.bitwise_or.reduceat(bits, at, axis=0), np.logical_or.reduceat(own, at))
        levels.append(level)
    return levels


def possible(x, y, i, j) -> np.ndarray:
    """Whether nodes ``i`` of level ``x`` and ``j`` of ``y`` may hold a link."""
    small, large = np.minimum(x[1][i], y[1][j]), np.maximum(x[0][i], y[0][j])
    fine = (100 * small >= PERCENT * large) & ~(x[3][i] & y[3][j] & (x[2][i] == y[2][j])) & (x[6][i] | y[6][j])
    at = np.flatnonzero(fine)
    need = PERCENT * (x[0][i[at]] + y[0][j[at]])
    slack = np.minimum(x[4][i[at]], y[4][j[at]])
    step = max(1, CHUNK_BYTES // x[5][0].nbytes)
    for k in range(0, len(at), step):
        part = at[k:k + step]
        common = np.bitwise_count(x[5][i[part]] & y[5][j[part]]).sum(axis=1, dtype=np.int64)
        # a shingle in the overlap has a bit in common, or is one beyond its set's bits
        most = np.minimum(slack[k:k + step] + common, small[part])
        fine[part] = (100 + PERCENT) * most >= need[k:k + step]
    return fine


def signature_pairs(rows, other=None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs that may be similar, of ``rows`` (``sizes, cores,
    bits, own``) with each other or with ``other``: both trees are descended
    level by level, and pairs of nodes without a possible link are left out."""
    def ordered(rows):
        order = np.lexsort((rows[2][:, 0], rows[0], rows[1]))
        return order, [r[order] for r in rows]

    left, x = ordered(rows)
    right, y = (left, x) if other is None else ordered(other)
    height = 0
    while FANOUT ** height < max(len(left), len(right)):
        height += 1
    x = signature_tree(*x, height)
    y = x if other is None else signature_tree(*y, height)
    kids, found = np.arange(FANOUT), [(np.zeros(0, np.int64),) * 2]
    stack = [(height, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        k, i, j = stack.pop()
        fine = possible(x[k], y[k], i, j)
        if k == 0:
            fine &= (i != j) | (other is not None)
            found.append((left[i[fine]], right[j[fine]]))
            continue
        i, j = i[fine], j[fine]
        for a in range(0, len(i), CHUNK_PAIRS):
            u = i[a:a + CHUNK_PAIRS, None, None] * FANOUT + kids[None, :, None]
            v = j[a:a + CHUNK_PAIRS, None, None] * FANOUT + kids[None, None, :]
            u, v = (w.ravel() for w in np.broadcast_arrays(u, v))
            real = (u < len(x[k - 1][0])) & (v < len(y[k - 1][0]))
            if other is None:
                real &= u <= v
            stack.append((k - 1, u[real], v[real]))
    return tuple(np.concatenate(f) for f in zip(*found))


def band(n):
    """Size band: sizes of linked sets differ by one band at most."""
    return F.floor(F.log(n.cast("double")) / F.lit(float(np.log(100 / PERCENT)) + 1e-9)).cast("int")


def candidate_pairs(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b`` from ``members`` (``token, id, n, core``): pairs that share a
    token, of different cores, that no bound rules out.

    Of groups with the same classes (the shingles of a shared passage make many)
    only one is searched: their counts and two 64-bit sums over ids agree, and
    the one of the lowest band stands for all.  A pair may meet in many groups.
    Each class brings the names of its first ``MEETINGS`` groups, and a pair is
    given out only in the first group that both lists name (in each of its
    groups, if the lists share none)."""
    rows = members.withColumn("own", band(F.col("n")))
    rows = rows.withColumn("band", F.explode(F.array(F.col("own"), F.col("own") + 1)))
    # a band's group holds its own sizes and those of the band below
    groups = rows.groupBy("token", "band").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col("own") == F.col("band")).alias("used"), F.min("core").alias("lo"), F.max("core").alias("hi"),
        F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")).where("used and lo < hi")
    groups = groups.groupBy("rows", "x", "y", "lo", "hi").agg(F.min(F.struct("band", "token")).alias("of")).select(
        "of.token", "of.band", F.ceil(F.col("rows") / GROUP_ROWS).cast("int").alias("blocks"))
    rows = rows.join(groups, ["token", "band"]).select("id", "n", "core", "blocks", F.xxhash64("token", "band").alias("place"), (F.col("own") == F.col("band")).alias("own"))
    rows = storage.stage(rows, "ngram-rows")
    # of one band, in which two classes always meet; as many as prefix shingles, so a text's worth
    lists = rows.groupBy("id", "own").agg(F.slice(F.sort_array(F.collect_set("place")), 1, MEETINGS).alias("places"))
    rows = rows.join(lists.join(classes.select("id", "bits"), "id"), ["id", "own"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("meet", F.xxhash64("place", F.least("block", "with"), F.greatest("block", "with")))

    def run(batches):
        for _, t in whole_runs(batches, "meet"):
            t = t.combine_chunks()
            get = lambda c: np.asarray(t.column(c).combine_chunks())
            block, ids, n, core, own, place = get("block"), get("id"), get("n"), get("core"), get("own"), int(get("place")[0])
            whole = t.column("bits").to_pylist()
            bits = folded(whole)
            low = block == block.min()
            if low.all():
                i, j = signature_pairs((n, core, bits, own))
            else:
                x, y = np.flatnonzero(low), np.flatnonzero(~low)
                i, j = signature_pairs((n[x], core[x], bits[x], own[x]), (n[y], core[y], bits[y], own[y]))
                i, j = x[i], y[j]
            if len(i):
                lists = list(map(set, t.column("places").to_pylist()))
                here = np.array([min(lists[a] & lists[b], default=place) == place for a, b in zip(i.tolist(), j.tolist())], bool)
                i, j = i[here], j[here]
            if len(i):
                fine = may_link(n[i], n[j], [whole[k] for k in i], [whole[k] for k in j])
                a, b = ids[i[fine]], ids[j[fine]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    met = rows.select("meet", "place", "block", "id", "n", "core", "own", "bits", "places").repartition("meet").sortWithinPartitions("meet")
    return met.mapInArrow(run, "a long, b long").distinct()


def ngram_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    return ngram_groups(docs).select("doc_id", "n_shingles", "component_id")


def ngram_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component, component_id`` for every row
    of ``docs``; ``component`` names the component whether its rows have ids or
    not, and is null for a document without a word."""
    T.prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    described = storage.stage(describe(docs), "ngram-docs")
    of_doc = described.where("kind = 0")
    # one row a class
    classes = storage.stage(of_doc.where("n > 0").groupBy(F.col("c").alias("id")).agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.min("t").alias("t"), F.first("bits").alias("bits"), F.first("mins").alias("mins")), "ngram-classes")
    shared = storage.stage(shared_entries(prefix_entries(docs, total_sketch(described))), "ngram-shared")
    bins = classes.select("id", F.explode("mins").alias("m"))
    # a group's first class is another in each bin, so a class meets up to BINS of its family
    first = F.min(F.struct(F.xxhash64("id", "m").alias("h"), "id"))["id"]
    groups = bins.groupBy("m").agg(first.alias("a"), F.count(F.lit(1)).alias("k")).where("k > 1")
    stars = bins.join(groups, "m").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    links = links_of(docs, plausible(stars, classes), classes, "stars")
    core = storage.stage(components(links), "ngram-cores")
    members = shared.withColumnRenamed("c", "id").join(core, "id", "left").withColumn("core", F.coalesce("core", "id"))
    apart = members.groupBy("token").agg(F.min("core").alias("lo"), F.max("core").alias("hi")).where("lo < hi").select("token")
    more = links_of(docs, candidate_pairs(members.join(apart, "token"), classes), classes, "pairs")
    final = components(links.union(more))
    joined = classes.select("id", "doc_id").join(final, "id", "left").withColumn("core", F.coalesce("core", "id"))
    least = joined.groupBy("core").agg(F.min("doc_id").alias("component_id"))
    named = joined.join(least, "core").select(F.col("id").alias("c"), "core", "component_id")
    full = of_doc.select("doc_id", "t", "n", "c").join(named, "c", "left")
    return full.select("doc_id", F.col("t").alias("text_hash"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("core")).alias("component"),
                       F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def links_of(docs: DataFrame, pairs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """The pairs whose whole sets link, staged."""
    pairs = storage.stage(pairs, f"ngram-{name}")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    ids = storage.stage(ids.join(classes.select("id", "t"), "id"), f"ngram-{name}-ids")
    return storage.stage(verified(pairs, sets_of(docs, ids)), f"ngram-{name}-links")
