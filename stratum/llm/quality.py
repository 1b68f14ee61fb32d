r"""Quality rules by gradient-boosted trees over document statistics.

Trees are boosted on logistic loss over binned statistics of a bounded sample
of labelled rows (``SAMPLE_ROWS``, the first by a hash of ``doc_id``), with
monotonic constraints: more repeated words, duplicate lines or symbols a word
never raise a score.  The trees are flattened into numpy node arrays, and all
documents are scored against them, batch by batch.

Words are ``[^\x20\x09-\x0D]+``, as they are.  Defined cases: null or empty
text has no words and fails the base rule; repeated rows and null or repeated
``doc_id`` give a row each; other columns are ignored; an empty table gives an
empty result; with labels of fewer than two classes no tree is grown and the
base rule decides alone.  Labels that are null or not 0 or 1 are not used; of
several labels for a ``doc_id`` the smallest counts.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import text as T

SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
TREES, DEPTH, RATE, BINS, LEAF, RIDGE = 40, 3, 0.2, 32, 20, 1.0
WINDOW = 8
COUNTS = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words")
EXTRA = ("n_distinct_words", "n_chars", "n_lines", "n_punctuation")
#: Statistic and its monotonic constraint (-1: a higher value never raises the score).
FEATURES = (("log_words", 0), ("mean_word", 0), ("symbols_a_word", -1), ("dup_line_share", -1),
            ("repeat_share", -1), ("distinct_share", 0), ("space_share", 0), ("words_a_line", 0), ("punctuation_share", 0))
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b".,;:!?|-")] = True


def lines_of(text: str) -> tuple[int, int]:
    """(lines with a word, those equal to an earlier one)."""
    seen, n, dup = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            n += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return n, dup


def repeat_words(ids: np.ndarray) -> int:
    """Words inside 8-word windows that occur twice or more in the text."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    # windows as ranks of pairs, doubled: equal ranks mean equal windows
    rank = np.unique(ids, return_inverse=True)[1]
    for step in (1, 2, 4):
        pair = rank[:-step] * (len(ids) + 1) + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1]
    again = np.bincount(rank)[rank] > 1
    if not again.any():
        return 0
    change = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(again)
    change[at] += 1
    change[at + WINDOW] -= 1
    return int((np.cumsum(change)[:-1] > 0).sum())


def suspects(index: np.ndarray, row: np.ndarray) -> set[int]:
    """Rows in which some 8-word window's hash occurs twice: every row with a
    repeated window, and hardly any other."""
    n = len(index) - WINDOW + 1
    if n < 2:
        return set()
    h = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        h = (h ^ index[i:n + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    own = row[:n] == row[WINDOW - 1:]
    h = (h[own] ^ row[:n][own].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(h)
    again = order[1:][h[order[1:]] == h[order[:-1]]]
    return set(np.unique(row[:n][own][again]).tolist())


def statistics(column) -> dict[str, np.ndarray]:
    """Counts for each text of an Arrow column."""
    data, offs = T.buffers(column)
    known, index, at = T.words(column)
    lead = (data & 0xC0) != 0x80                      # a byte that begins a code point
    lines = np.array([lines_of(t or "") for t in column.to_pylist()], np.int64).reshape(-1, 2)
    row = np.repeat(np.arange(len(column)), np.diff(at))
    repeated = np.zeros(len(column), np.int64)
    for r in suspects(index, row):
        repeated[r] = repeat_words(index[at[r]:at[r + 1]])
    own_words = np.unique(row * max(1, len(known)) + index) // max(1, len(known))
    return {
        "word_chars": T.row_sums(lead & ~T.WHITE[data], offs),
        "n_symbols": T.row_sums(_SYMBOL[data], offs),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": repeated,
        "n_words": np.diff(at),
        "n_distinct_words": np.bincount(own_words, minlength=len(column)),
        "n_chars": T.row_sums(lead, offs),
        "n_lines": lines[:, 0],
        "n_punctuation": T.row_sums(_PUNCT[data], offs),
    }


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    words, chars, lines = (np.maximum(s[k], 1).astype(float) for k in ("n_words", "n_chars", "n_lines"))
    return np.stack([np.log(words), s["word_chars"] / words, s["n_symbols"] / words, s["n_dup_lines"] / lines,
                     s["n_repeat_words"] / words, s["n_distinct_words"] / words, 1 - s["word_chars"] / chars,
                     s["n_words"] / lines, s["n_punctuation"] / words], axis=1)


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


class Trees(NamedTuple):
    """Flattened trees: node ``i`` sends a row with ``x[feature] <= cut`` to
    ``left[i]``, else to ``left[i] + 1``; leaves have feature -1."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                f = self.feature[node]
                inner = f >= 0
                right = x[np.arange(len(x)), np.maximum(f, 0)] > self.cut[node]
                node = np.where(inner, self.left[node] + right, node)
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Histogram boosting with monotonic constraints: a split on a constrained
    feature must order its sides' values, and their middle bounds each side's
    descendants, so the order holds in the whole tree."""
    feature, cut, left, value, roots = [], [], [], [], []

    def node(v=0.0):
        feature.append(-1), cut.append(0.0), left.append(0), value.append(v)
        return len(value) - 1

    prior = 0.0
    if len(y) and 0 < y.sum() < len(y):
        prior = float(np.log(y.mean() / (1 - y.mean())))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
        margin = np.full(len(y), prior)

        def best_split(rows, g, h, lo, hi):
            best = (1e-6,)
            G, H = g[rows].sum(), h[rows].sum()
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, j]
                gs, hs, ns = (np.cumsum(np.bincount(b, w, len(e) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
                vl, vr = (np.clip(-a / (c + RIDGE), lo, hi) for a, c in ((gs, hs), (G - gs, H - hs)))
                gain = -(gs * vl + (hs + RIDGE) * vl**2 / 2) - ((G - gs) * vr + (H - hs + RIDGE) * vr**2 / 2)
                v0 = np.clip(-G / (H + RIDGE), lo, hi)
                gain += G * v0 + (H + RIDGE) * v0**2 / 2
                sign = FEATURES[j][1]
                bad = (ns < LEAF) | (len(rows) - ns < LEAF) | ((sign != 0) & (sign * (vr - vl) < 0))
                gain[bad] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], j, k, vl[k], vr[k])
            return best if len(best) > 1 else None

        def grow(at, rows, g, h, depth, lo, hi):
            value[at] = float(np.clip(-g[rows].sum() / (h[rows].sum() + RIDGE), lo, hi)) * RATE
            split = best_split(rows, g, h, lo, hi) if depth < DEPTH else None
            if split is None:
                margin[rows] += value[at]
                return
            _, j, k, vl, vr = split
            feature[at], cut[at], left[at] = j, float(edges[j][k]), node()
            node()
            go_left = binned[rows, j] <= k
            sign, mid = FEATURES[j][1], (vl + vr) / 2
            bounds = {0: ((lo, hi), (lo, hi)), 1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid))}[sign]
            grow(left[at], rows[go_left], g, h, depth + 1, *bounds[0])
            grow(left[at] + 1, rows[~go_left], g, h, depth + 1, *bounds[1])

        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            roots.append(node())
            grow(roots[-1], np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf)
    return Trees(*(np.array(v) for v in (feature or [-1], cut or [0.0], left or [0], value or [0.0])), np.array(roots, np.int64), prior)


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, ``keep`` and the counts for every row."""
    T.prepare(docs.sparkSession)
    names = (*COUNTS, *EXTRA)

    def count(batches):
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                s = statistics(part.column("text"))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", *keep)), *(pa.array(s[c].astype(np.int64)) for c in names)],
                                                 ["doc_id", *keep, *names])

    schema = docs.select("doc_id", *keep).schema
    for c in names:
        schema.add(c, "long")
    return docs.select("doc_id", *keep, "text").mapInArrow(count, schema)


def label_of(labels: DataFrame, column: str) -> DataFrame:
    """One 0/1 label for each ``doc_id``."""
    ok = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
    return ok.groupBy("doc_id").agg(F.min(column).cast("int").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on at most ``sample_rows`` labelled rows, chosen by hash of id."""
    chosen = label_of(labels, "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "label").limit(2 * sample_rows).toPandas()
    return fit_trees(features({c: rows[c].to_numpy() for c in (*COUNTS, *EXTRA)}), rows["label"].to_numpy(float))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words,
    base_failed, kept, score`` for every row of ``docs``."""
    trees = fit(docs, labels)

    def judge(batches):
        for batch in batches:
            s = {c: batch.column(c).to_numpy() for c in (*COUNTS, *EXTRA)}
            failed, score = base_failed(s), trees.score(features(s)) if len(trees.roots) else np.ones(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(batch.column(c) for c in COUNTS), pa.array(failed),
                                              pa.array(~failed & (score >= threshold)), pa.array(score)],
                                             ["doc_id", *COUNTS, "base_failed", "kept", "score"])

    return with_statistics(docs).mapInArrow(
        judge, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, score double")
