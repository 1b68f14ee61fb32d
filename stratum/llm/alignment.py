"""Alignment of the tokens of two tokenizers, by diagonal run skipping.

Tokenizer A is a ``tokenizers`` file (byte-level BPE) over a space and the text,
B a ``sentencepiece`` model over the text, to which it adds the space itself.
Both cut the same bytes, so a document has two ascending arrays of token ends.
Where both have an end, a group of tokens ends.

``align`` walks both arrays with an index shift, the diagonal.  At the current
shift it compares slices whose length doubles as long as they agree, then halves
it to find where the run stops: a run is a stretch of one-to-one groups, passed
in a logarithmic number of comparisons.  Between runs lies an irregular group,
resolved locally by advancing the side whose end is behind until both agree,
which gives the next shift.

``aligned_tokens`` links every A and B token occurrence of a group and counts,
over all documents, how many hold an id pair linked:

* Tokens, groups and a document's distinct id pairs with their links are found
  in one pass and staged.  A group gives its distinct id pairs, with the product
  of their occurrences as links, so a long irregular group isn't expanded.
* Counts are aggregated with map-side combining; an A id's highest is a maximum
  over its pairs.
* The ``TABLE_PAIRS`` most frequent pairs, whatever the input's size, are sent to
  the tasks, which look most links up in place.  So a pair that most documents
  hold never makes a hot key; links of rarer pairs are joined by pair.

Texts are cut where neither tokenizer lets a token cross (``text.chunks`` for A;
before a space that follows another character for B, as no piece holds a space
after one), so distinct pieces are tokenised once.

Defined cases: null or empty texts, and texts whose tokens' joined bytes differ
from a space and the text (a literal U+2581, which B reads as a space), have no
tokens: zeros and an empty string.  Special tokens' strings are plain text.
Repeated rows and null or repeated ``doc_id`` are documents of their own; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import storage
from stratum.llm import text as T
from stratum.llm.token_counts import byte_symbols
from stratum.llm.toxicity import most_frequent

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
TABLE_PAIRS = 1 << 18
PART_BYTES = 1 << 20        # of text aligned at once; its arrays and strings take many times as much
CACHE_ENTRIES = 150_000     # pieces of text remembered by a worker, for each tokenizer; only speed depends on it
ENCODE_PIECES = 2048        # tokenised at once: what the libraries return takes far more than the ids
_COUNTS = "n_a long, n_b long, n_groups long, n_links long"


class Coder:
    """Ids of pieces of text; ``bytes_of`` has each id's bytes."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.flat, self.lens, self.whole = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)
        self.size = np.array([len(b) for b in self.bytes_of], np.int64)
        self.names = np.array([str(i) for i in range(len(self.bytes_of))], object)
        self.place = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        raise NotImplementedError

    def encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in order, number of ids of each), tokenised
        ``ENCODE_PIECES`` at a time."""
        flat, lens = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for i in range(0, len(pieces), ENCODE_PIECES):
            ids = self.encode(pieces[i:i + ENCODE_PIECES])
            lens.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(lens[-1].sum())))
        return np.concatenate(flat), np.concatenate(lens)

    def same_bytes(self, pieces: list[bytes], ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Whether the joined bytes of each piece's ids are the piece."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        whole = T.row_sums(self.size[ids], np.r_[0, np.cumsum(lens)]) == size
        some = np.flatnonzero(whole & (size > 0))
        kept = np.repeat(whole, lens)
        made = T.ragged_take(self.data, self.place[ids[kept]], self.size[ids[kept]])
        given = np.frombuffer(b"".join([pieces[i] for i in some]), np.uint8)
        if len(some):
            whole[some] = ~np.logical_or.reduceat(made != given, np.cumsum(size[some]) - size[some])
        return whole

    def take(self, pieces: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the indexed pieces in order: (ids, number of ids for each, whether
        the ids' bytes are the piece's for each)."""
        known, base = self.known, len(self.lens)
        row = np.fromiter((known.get(c, -1) for c in pieces), np.int64, len(pieces))
        fresh = np.flatnonzero(row < 0)
        new = [pieces[i] for i in fresh]
        own, more = self.encoded(new)
        row[fresh] = base + np.arange(len(new))
        flat, lens = np.r_[self.flat, own], np.r_[self.lens, more]
        whole = np.r_[self.whole, self.same_bytes(new, own, more)]
        if base + len(new) <= CACHE_ENTRIES:
            known.update(zip(new, range(base, base + len(new))))
            self.flat, self.lens, self.whole = flat, lens, whole
        row = row[index]
        starts = np.cumsum(lens) - lens
        return T.ragged_take(flat, starts[row], lens[row]), lens[row], whole[row]


class ByteLevel(Coder):
    """A ``tokenizers`` file; entries are byte symbols."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark has a task for each core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte = {c: i for i, c in enumerate(byte_symbols())}
        entry = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.bytes_of = [bytes(byte[c] for c in entry.get(i, "") if c in byte) for i in range(max(entry) + 1)]
        super().__init__()

    def encode(self, pieces):
        return [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]


class Pieces(Coder):
    """A ``sentencepiece`` model, which puts a space before each piece."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)

        def raw(i):
            p = self.model.id_to_piece(i)
            return bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()

        self.bytes_of = [raw(i) for i in range(self.model.get_piece_size())]
        super().__init__()

    def encode(self, pieces):
        ids = self.model.encode([p[1:].decode() for p in pieces], num_threads=1) if pieces else []
        # an empty text gets no space: a lone one is what is left of a word and a space
        return [x or self.model.encode("a ")[len(self.model.encode("a")):] for x in ids]


@lru_cache(4)
def coder(path: str) -> Coder:
    return (Pieces if path.endswith(".model") else ByteLevel)(path)


def space_chunks(column):
    """As ``text.chunks``, cut before each space that follows another byte."""
    data, offs = T.buffers(column)
    cut = np.zeros(len(data), bool)
    cut[1:] = (data[1:] == 32) & (data[:-1] != 32)
    cut[offs[:-1][offs[:-1] < len(data)]] = True
    where = np.flatnonzero(cut)
    known, index = T.distinct(T.pieces(data, where)) if len(where) else ([], where)
    return known, index, np.searchsorted(where, offs)


def with_space(column) -> pa.Array:
    """A space before each text; null and empty ones are a space alone."""
    data, offs = T.buffers(column)
    out = np.insert(data, offs[:-1], np.uint8(32))
    return T.pieces(out, offs[:-1] + np.arange(len(offs) - 1))


def align(a: list[int], b: list[int]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """Of two ascending arrays of ends whose last is the same: runs of
    one-to-one groups (first of each side, length) and irregular groups (first
    and end of each side), each in order."""
    runs, groups = [], []
    i = j = 0
    n, m = len(a), len(b)
    while i < n:
        p, q = a[i], b[j]
        if p == q:
            most = min(n - i, m - j)
            run = 1
            if most > 1 and a[i + 1] == b[j + 1]:           # probe ahead on this diagonal
                run = step = 2
                while run + step <= most and a[i + run:i + run + step] == b[j + run:j + run + step]:
                    run += step
                    step *= 2
                while step > 1:                             # the run ends within the last probe
                    step //= 2
                    if run + step <= most and a[i + run:i + run + step] == b[j + run:j + run + step]:
                        run += step
            runs.append((i, j, run))
            i += run
            j += run
        else:
            x, y = i, j
            while p != q:
                if p < q:
                    x += 1
                    p = a[x]
                else:
                    y += 1
                    q = b[y]
            groups.append((i, x + 1, j, y + 1))
            i, j = x + 1, y + 1
    return runs, groups


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, index of each value among them), unsorted."""
    d = pa.array(values).dictionary_encode()
    return d.dictionary.to_numpy(), d.indices.to_numpy().astype(np.int64)


def group_strings(names: list[list[str]], at: np.ndarray, pairs: np.ndarray, groups: list, cuts: np.ndarray, width: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each document: the one-to-one ``pairs`` at the A
    tokens ``at``, the irregular ``groups``, and the documents' first A tokens
    ``cuts``; ``names`` has the ids of both sides as text.  A pair's string is
    made once."""
    a, b = names
    known, index = numbered(pairs)
    shown = np.array([f"{x}|{y}" for x, y in zip((known // width).tolist(), (known % width).tolist())], object)
    strings = np.empty(len(a), object)                       # at each group's first A token
    strings[at] = shown[index] if len(index) else shown
    first = np.array([g[1] for g in groups], np.int64)
    strings[first] = np.array([f"{','.join(a[i:x])}|{','.join(b[j:y])}" for _, i, x, j, y in groups], object)
    used = np.zeros(len(a), bool)
    used[at] = used[first] = True
    ends = np.r_[0, np.cumsum(used)][cuts].tolist()
    strings = strings[used].tolist()
    return [";".join(strings[p:q]) for p, q in zip(ends, ends[1:])]


def links_of(rows: np.ndarray, pairs: np.ndarray, a: np.ndarray, b: np.ndarray, groups: list, width: int):
    """Distinct (row, pair) with their number of links, sorted by row: the
    one-to-one ``pairs`` of ``rows`` and those of ``groups`` (row, ids of each
    side).  A pair is ``a * width + b``."""
    rows, pairs, large = [rows], [pairs], []
    sizes: dict = {}
    for g in groups:                                         # of equal shape: together
        p, q = g[2] - g[1], g[4] - g[3]
        if p * q <= 64:
            sizes.setdefault((p, q), []).append(g)
        else:                                                # distinct ids with their products
            (u, nu), (v, nv) = (np.unique(s, return_counts=True) for s in (a[g[1]:g[2]], b[g[3]:g[4]]))
            large.append((np.full(len(u) * len(v), g[0]), (u[:, None].astype(np.int64) * width + v).ravel(), (nu[:, None] * nv).ravel()))
    for (p, q), same in sizes.items():
        r, i, _, j, _ = np.array(same).T
        both = a[i[:, None] + np.arange(p)].astype(np.int64)[:, :, None] * width + b[j[:, None] + np.arange(q)][:, None, :]
        pairs.append(both.ravel())
        rows.append(np.repeat(r, p * q))
    single = sum(map(len, rows))
    rows, pairs = (np.concatenate([*x, *(g[k] for g in large)]) for k, x in enumerate((rows, pairs)))
    known, index = numbered(pairs)
    key = rows * max(1, len(known)) + index                  # rows of one part: far below 2^63
    found, n = np.unique(key[:single], return_counts=True)
    if large:
        found, n = np.r_[found, key[single:]], np.r_[n, np.concatenate([g[2] for g in large])]
        order = np.argsort(found)
        found, n = found[order], n[order]
        first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
        found, n = found[first], np.add.reduceat(n, first)
    return found // max(1, len(known)), known[found % max(1, len(known))], n


def aligned_documents(docs: DataFrame, path_a: str = A, path_b: str = B) -> DataFrame:
    """``row`` (a number of its own), ``doc_id, n_a, n_b, n_groups, n_links,
    groups`` and ``pairs, links`` (distinct id pairs, links of each) for every row."""
    return _aligned(docs, path_a, path_b, "groups", lambda s: s)


def _aligned(docs, path_a, path_b, name, form) -> DataFrame:
    spark = docs.sparkSession
    T.prepare(spark)
    width = len(coder(path_b).bytes_of)
    small = len(coder(path_a).bytes_of) * width < 1 << 31
    kind, code = ("int", pa.int32()) if small else ("long", pa.int64())

    def run(batches):
        ca, cb = coder(path_a), coder(path_b)
        for batch in batches:
            for part in T.split_batch(batch, "text", PART_BYTES):
                spaced = with_space(part.column("text"))
                rows, sides = part.num_rows, []
                fine = np.asarray(pc.greater(pc.binary_length(part.column("text")), 0).fill_null(False))
                for c, (known, index, offs) in ((ca, T.chunks(spaced)), (cb, space_chunks(spaced))):
                    ids, lens, whole = c.take(known, index)
                    fine = fine & (T.row_sums(~whole, offs) == 0)
                    at = np.r_[0, np.cumsum(T.row_sums(lens, offs))]
                    sides.append((ids, at, np.cumsum(c.size[ids])))
                (a, at_a, end_a), (b, at_b, end_b) = sides
                runs, groups, counts = [], [], np.zeros((rows, 4), np.int64)
                ends = [e - np.r_[0, e][np.repeat(at[:-1], np.diff(at))] for e, at in ((end_a, at_a), (end_b, at_b))]     # in each document
                for r in np.flatnonzero(fine).tolist():
                    i, x, j, y = int(at_a[r]), int(at_a[r + 1]), int(at_b[r]), int(at_b[r + 1])
                    one, many = align(ends[0][i:x].tolist(), ends[1][j:y].tolist())
                    single = sum([k for _, _, k in one])
                    counts[r] = x - i, y - j, single + len(many), single + sum([(q - p) * (v - u) for p, q, u, v in many])
                    runs += [(i + p, j + u, k) for p, u, k in one]
                    groups += [(r, i + p, i + q, j + u, j + v) for p, q, u, v in many]
                from_a, from_b, k = np.array(runs, np.int64).reshape(-1, 3).T
                within = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
                from_a, from_b = np.repeat(from_a, k) + within, np.repeat(from_b, k) + within
                ones = a[from_a].astype(np.int64) * width + b[from_b]
                names = [c.names[s].tolist() for c, s in ((ca, a), (cb, b))]
                strings = group_strings(names, from_a, ones, groups, at_a, width)
                row = np.repeat(np.arange(rows), np.diff(at_a))
                of, pairs, links = links_of(row[from_a], ones, a, b, groups, width)
                cuts = np.searchsorted(of, np.arange(rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), *(pa.array(c) for c in counts.T), pa.array([form(s) if k else "" for s, k in zip(strings, fine.tolist())], pa.string()),
                     pa.ListArray.from_arrays(cuts, pa.array(pairs, pa.int64()).cast(code)), pa.ListArray.from_arrays(cuts, pa.array(links, pa.int64()))],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", name, "pairs", "links"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(run, f"row long, doc_id long, {_COUNTS}, {name} string, pairs array<{kind}>, links array<long>")


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair, n`` (documents that hold it linked), ``best`` (1 if no pair of its A
    id has more), staged."""
    counts = storage.stage(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "align-counts")
    of = F.floor(F.col("pair") / width)
    most = counts.groupBy(of.alias("a")).agg(F.max("n").alias("most"))         # a row for each A id at most
    return storage.stage(counts.withColumn("a", of).join(most, "a").select("pair", "n", F.when(F.col("n") == F.col("most"), 1).otherwise(0).alias("best")), "align-pairs")


def aligned_tokens(docs: DataFrame, path_a: str = A, path_b: str = B, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    for every row of ``docs``."""
    spark = docs.sparkSession
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    aligned = storage.stage(_aligned(docs, path_a, path_b, "groups_sha256", digest), "align-docs")
    counts = pair_counts(aligned, len(coder(path_b).bytes_of))
    frequent = most_frequent(counts, F.col("n"), table_pairs)
    table = frequent.sort("pair").toArrow()                                     # table_pairs rows at most
    sent = spark.sparkContext.broadcast([table.column(c).to_numpy().astype(np.int64) for c in ("pair", "n", "best")])
    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    pair = aligned.schema["pairs"].dataType.elementType.simpleString()

    def look_up(batches):
        known, n, best = sent.value
        for batch in batches:
            lists, links = batch.column("pairs"), batch.column("links").flatten().to_numpy()
            row = np.asarray(pc.list_parent_indices(lists))
            pairs = lists.flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            there = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            count, top = (np.where(there, x[at], 0) if len(known) else np.zeros(len(pairs), np.int64) for x in (n, best))
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            sums = [T.row_sums(links * x, ends) for x in (top, count)]
            rest = ~there
            cuts = np.searchsorted(row[rest], np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *map(pa.array, sums),
                 pa.ListArray.from_arrays(cuts, lists.flatten().filter(pa.array(rest))), pa.ListArray.from_arrays(cuts, pa.array(links[rest]))],
                [*kept, "n_best", "count_sum", "pairs", "links"])

    partly = storage.stage(aligned.mapInArrow(look_up, f"row long, doc_id long, {_COUNTS}, groups_sha256 string, n_best long, count_sum long, "
                                                       f"pairs array<{pair}>, links array<long>"), "align-partly")
    rare = partly.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links"))
    more = (rare.join(counts, "pair").groupBy("row").agg(F.sum(F.col("links") * F.col("best")).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum")))
    add = lambda c, more: (F.col(c) + F.coalesce(F.col(more), F.lit(0))).alias(c)
    return partly.join(more, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", add("n_best", "more_best"), add("count_sum", "more_sum"), "groups_sha256")
