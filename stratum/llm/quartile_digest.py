"""Quartile bucket digests of texts.

The digest counts the byte triplets of every 5-byte window (those that hold
its newest byte) in 256 hashed buckets, and keeps for each bucket in which
quartile of the 256 counts its count lies (2 bits), after one byte for the length (4 steps
for each doubling).  Two digests differ by the sum over buckets of the
quartile distance (3 counts 6) and twice the distance of the lengths up to 64;
likeness is 1 less that difference over ``FAR``, at least 0.

Defined cases: null or empty text has the digest of no bytes; so do texts too
short for a triplet, but for their length byte.  The next document is the next
row by ``doc_id`` (nulls first; rows that share one by text); the last row's is
the first, and a single row is its own next.  Other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import text as T

BUCKETS = 256
LENGTH_FAR = 64
FAR = 256                    # difference at which likeness reaches 0
PAIRS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))    # distances of a triplet's other bytes
_COST = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]], np.int32)
_KEYS = tuple(np.uint32(k) for k in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1))


def buckets(data: np.ndarray, since: int = 0) -> np.ndarray:
    """Counts of the hashed triplets of UTF-8 bytes whose newest byte is at
    ``since`` or later."""
    count = np.zeros(BUCKETS, np.int64)
    wide = data.astype(np.uint32)
    new, mid, old = (wide * k for k in _KEYS[:3])
    for salt, (a, b) in enumerate(PAIRS):
        lo = max(b, since)
        if len(data) > lo:
            x = new[lo:] + mid[lo - a:len(data) - a]
            x += old[lo - b:len(data) - b]
            x += np.uint32(salt + 1) * _KEYS[3]
            x ^= x >> np.uint32(15)
            x *= _KEYS[4]
            count += np.bincount(x >> np.uint32(24), minlength=BUCKETS)
    return count


def digest_of(count: np.ndarray, size: int) -> np.ndarray:
    """Digest, 1 + 64 bytes, of a text's triplet counts and length in bytes."""
    q1, q2, q3 = np.sort(count)[[63, 127, 191]]
    code = ((count > q1).astype(np.uint8) + (count > q2) + (count > q3)).reshape(-1, 4)
    packed = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    length = min(255, int(np.floor(4 * np.log2(size + 1))))
    return np.r_[np.uint8(length), packed.astype(np.uint8)]


def digest(text: bytes) -> np.ndarray:
    return digest_of(buckets(np.frombuffer(text, np.uint8)), len(text))


def digest_pair(text: bytes, edited: bytes, same: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of two texts that begin with the same ``same`` bytes, whose
    triplets are counted once."""
    x, y = np.frombuffer(text, np.uint8), np.frombuffer(edited, np.uint8)
    shared = buckets(x[:same])
    return tuple(digest_of(shared + buckets(z[max(0, same - 4):], min(same, 4)), len(z)) for z in (x, y))


def codes(digests: np.ndarray) -> np.ndarray:
    packed = digests[:, 1:]
    return np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], axis=2).reshape(len(digests), -1)


def difference(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bounded difference of digests, row by row."""
    body = _COST[codes(left), codes(right)].sum(1)
    size = np.abs(left[:, 0].astype(int) - right[:, 0].astype(int))
    return body + np.minimum(2 * size, LENGTH_FAR)


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, 1.0 - difference(left, right) / FAR)


def with_next_text(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows of ``part, doc_id, text, guest`` such that, sorted by ``part,
    guest, doc_id, text``, each row that is no guest is followed by the next
    document's row.

    Keys are cut at documents' own ids, so a range's successor is the document
    at the next cut, sent to both ranges; texts are shuffled once.  The cuts
    are as many as shuffle partitions and come from an aggregate of ids."""
    spark = docs.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.agg(F.percentile_approx("doc_id", [(i + 1) / (n + 1) for i in range(n)], 20_000).alias("cuts"),
                   F.min("doc_id").alias("low"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    low = None if ids["nulls"] else ids["low"]
    cuts = sorted({*(ids["cuts"] or [])} - {low})
    if ids["nulls"] and ids["low"] is not None:
        cuts = sorted({*cuts, ids["low"]})
    doc_id = F.col("doc_id")

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(np.array(cuts, np.int64), ids.fillna(0).astype("int64").to_numpy(), "right")
        return pd.Series(np.where(ids.isna(), 0, at))

    rows = docs.select(doc_id, "text", part(doc_id).alias("own"))
    lead = doc_id.isin(cuts)
    first = doc_id.isNull() if low is None else doc_id == F.lit(low)
    extra = F.when(first, F.lit(len(cuts))).when(lead, F.col("own") - 1)
    places = F.array(F.struct(F.col("own").alias("part"), F.lit(0).alias("guest")),
                     F.when(extra.isNotNull(), F.struct(extra.alias("part"), F.lit(1).alias("guest"))))
    out = rows.select("doc_id", "text", F.explode(F.array_compact(places)).alias("x"))
    return out.select("x.part", "x.guest", "doc_id", "text").repartition("part").sortWithinPartitions("part", "guest", "doc_id", "text")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` for every row of ``docs``."""
    T.prepare(docs.sparkSession)

    def pairs(batches):
        """((part, guest, doc_id, text), next row) over sorted rows."""
        held = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text"))):
                if held is not None and not held[1]:
                    yield held, row
                if held is None or held[0] != row[0] or not held[1]:
                    held = row           # of a range's guests only the first counts

    def score(batches):
        rows, guest = [], None           # a row waits for its next one's digest
        for (_, _, doc_id, text), nxt in pairs(batches):
            text, follow = text or "", nxt[3] or ""
            kept = text[:len(text) - len(text) // 4]
            edited = kept + follow[:len(text) // 4]
            mine, changed = digest_pair(text.encode(), edited.encode(), len(kept.encode()))
            if rows and len(rows[-1]) == 5:
                rows[-1] += (mine if guest is None else digest(guest),)
                if len(rows) >= 1024:
                    yield batch_of(rows)
                    rows = []
            rows.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), mine, changed))
            guest = follow.encode() if nxt[1] else None
        if rows:
            rows[-1] += (digest(guest),)
            yield batch_of(rows)

    def batch_of(rows):
        ids, n, sha, mine, edited, follow = zip(*rows)
        mine, edited, follow = map(np.stack, (mine, edited, follow))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(sha), pa.array([x.tobytes().hex() for x in mine]),
             pa.array([x.tobytes().hex() for x in edited]), pa.array(likeness(mine, edited)), pa.array(likeness(mine, follow))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_next_text(docs).mapInArrow(score, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                                 "edited_fingerprint string, near_edited double, near_next double")
