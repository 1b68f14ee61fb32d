r"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary labelled documents, with absolute
discounting: a bigram backs off to its class's continuation counts, the number
of distinct words (or the text's start) that a word follows there, and these to
counts that both classes share, the number of documents of the whole corpus
that hold a word.  Backoff weights are shared too, so what is rare in both says nothing.
A document's two log-likelihoods are compared by word: the mean log-ratio over
the document and over its ``TOP`` words of the highest ratio.  A logistic
function of both, fitted on labelled rows that the counts don't hold, gives the
score; the same rows choose the discount.

Words are ``[^\x20\x09-\x0D]+`` with A-Z lower-cased, without ASCII
punctuation at either end.  At most ``TRAIN_ROWS`` labelled rows are used, the
first by a hash of ``doc_id``; of these, rows with remainder 3 fit the logistic
function and the others the counts.  Rows with remainder 2 (``crc32`` of
``doc_id`` as text, modulo 4) and null ids are never learned from.  The shared
counts cover all documents.  Of the sample's words and bigrams only those that
neither class holds twice are left out of what is sent to the tasks: every
discount makes their counts nothing, and the shared counts below them are the
same factor in both classes, so their scores are those of unseen ones.

Defined cases: null or empty text has both features 0 and its score is the
logistic function's at 0; repeated rows and null or repeated ``doc_id`` give a
row each; other columns are ignored; of several labels for an id the largest
counts, labels other than 0 and 1 not at all; without labels of both classes
every score is the share of label 1 (about 0 without labels); an empty table gives
an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from stratum.llm import storage
from stratum.llm import text as T

TRAIN_ROWS = 24_000
DISCOUNTS = (1.5, 2.0, 3.0, 5.0, 8.0)   # the one that scores held rows best is used
TOP = 2
THRESHOLD = 0.3
_EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def word_ids(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct word hashes, word index in order, row offsets)."""
    known, index, offs = T.words(column, lower=True)
    h = np.fromiter((xxhash.xxh64_intdigest(w.strip(_EDGES)) for w in known), np.uint64, len(known)).view(np.int64)
    return h, index, offs


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = left.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.view(np.uint64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


class Model(NamedTuple):
    """Sorted keys with counts (toxic, ordinary), and the logistic weights."""
    words: np.ndarray        # word hashes
    follows: np.ndarray      # distinct left contexts, by class
    kept: np.ndarray         # discounted bigrams after the word, by class
    leave: np.ndarray        # backoff weight after the word, shared by the classes
    spread: np.ndarray       # documents of the corpus that hold the word
    pairs: np.ndarray        # bigram hashes
    pair_n: np.ndarray       # occurrences, by class
    total: np.ndarray        # discounted left contexts, by class
    discount: float
    back: float              # backoff weight of words, shared by the classes
    documents: float         # sum of the spread over all words
    weights: np.ndarray

    def ratios(self, h, index, offs) -> np.ndarray:
        """Log-ratio toxic to ordinary of each word given the one before."""
        at, seen = find(self.words, h)
        some = seen[:, None]
        n = np.where(some, np.maximum(self.follows[at] - self.discount, 0), 0.0)
        kept = np.where(some, self.kept[at], 0.0)
        leave = np.where(seen, self.leave[at], 1.0)
        shared = (np.where(seen, self.spread[at], 0.0) + 1.0) / (self.documents + 1.0)
        unigram = (1 - self.back) * n / self.total + self.back * shared[:, None]
        prior = np.r_[-1, index[:-1]]
        prior[offs[:-1][offs[:-1] < len(index)]] = -1
        left = np.where(prior >= 0, h[prior], np.int64(0))
        at, seen = find(self.pairs, pair_hash(left, h[index]))
        joint = np.where(seen[:, None], np.maximum(self.pair_n[at] - self.discount, 0), 0.0)
        mass = np.where((prior >= 0)[:, None], kept[prior], 0.0)
        bigram = np.where(mass > 0, joint / np.maximum(mass, 1e-9), unigram[index])
        share = np.where(prior >= 0, leave[prior], 1.0)[:, None]
        p = (1 - share) * bigram + share * unigram[index]
        return np.log(p[:, 0]) - np.log(p[:, 1])

    def features(self, h, index, offs) -> np.ndarray:
        """Mean of all and of the ``TOP`` highest log-ratios of each text."""
        out = np.zeros((len(offs) - 1, 2))
        if not len(index):
            return out
        r = self.ratios(h, index, offs)
        size = np.diff(offs)
        some = size > 0
        # each text summed by itself: no other row of the batch has an influence on the last digit
        out[some, 0] = np.add.reduceat(r, offs[:-1][some]) / size[some]
        high = r[np.lexsort((r, np.repeat(np.arange(len(size)), size)))]       # ascending in each row
        width = np.minimum(TOP, size)
        for k in range(TOP):
            out[width > k, 1] += high[offs[1:][width > k] - 1 - k]
        out[some, 1] /= width[some]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[0] + x @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether there) of ``wanted`` in sorted ``keys``."""
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, keys[at] == wanted


def remainder(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def train_labels(labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    ok = labels.where(F.col("toxic").isin(0, 1) & (remainder(F.col("doc_id")) != 2))
    one = ok.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).withColumn("fits", remainder(F.col("doc_id")) != 3)


def spread_counts(docs: DataFrame) -> DataFrame:
    """``word, spread``: documents that hold each word, over all of ``docs``."""
    def count(batches):
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                h, index, offs = word_ids(part.column("text"))
                row = np.repeat(np.arange(part.num_rows), np.diff(offs))
                own = np.unique(row * max(1, len(h)) + index) % max(1, len(h))
                n = np.bincount(own, minlength=len(h)) if len(h) else own
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("spread"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """``left, word, toxic, ordinary``: bigrams of labelled rows (left is 0 at
    a text's start), counted in each batch before the shuffle."""
    def count(batches):
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                h, index, offs = word_ids(part.column("text"))
                label = np.repeat(part.column("label").to_numpy(), np.diff(offs))
                left = np.r_[np.int64(-1), index[:-1]] + 1
                left[offs[:-1][offs[:-1] < len(index)]] = 0
                if not len(index):
                    continue
                key, n = np.unique((left * (len(h) + 1) + index) * 2 + label, return_counts=True)
                lab, pair = key % 2, key // 2
                lefts = np.r_[np.int64(0), h][pair // (len(h) + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(lefts), pa.array(h[pair % (len(h) + 1)]), pa.array(n * (lab == 1)), pa.array(n * (lab == 0))],
                                                 ["left", "word", "toxic", "ordinary"])

    return (rows.mapInArrow(count, "left long, word long, toxic long, ordinary long").groupBy("left", "word")
            .agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))


def most_frequent(df: DataFrame, by, rows: int) -> DataFrame:
    """All rows of ``df`` whose count ``by`` is at least the least bound that
    leaves ``rows`` rows at most.  The bound comes from the number of rows of
    each count up to a thousand; ``df`` is staged."""
    steps = df.select(F.least(by, F.lit(1000)).alias("c")).groupBy("c").count().collect()
    left, bound = 0, 1001
    for r in sorted(steps, key=lambda r: -r["c"]):
        left += r["count"]
        if left > rows:
            break
        bound = r["c"]
    if bound > 1000 and steps and max(r["c"] for r in steps) >= 1000:   # the bound lies above the counted steps
        return df.orderBy(by.desc(), F.hash(*df.columns)).limit(rows)
    return df.where(by >= bound)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    T.prepare(docs.sparkSession)
    chosen = train_labels(labels, train_rows)
    # at most train_rows narrow rows
    rows = storage.stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label", "fits"), "toxic-rows")
    spread = storage.stage(spread_counts(docs), "toxic-spread")
    pairs = storage.stage(pair_counts(rows.where("fits").select("text", "label")), "toxic-pairs")
    n, classes = F.col("toxic") + F.col("ordinary"), ("toxic", "ordinary")
    over = lambda c, d: F.sum(F.greatest(F.col(c) - d, F.lit(0.0)))
    right = pairs.groupBy("word").agg(*(F.sum(c).alias(c) for c in classes), *(F.count_if(F.col(c) > 0).alias(f"follows_{c}") for c in classes))
    left = pairs.where("left <> 0").groupBy(F.col("left").alias("word")).agg(
        F.sum(n).alias("context"), F.count(F.lit(1)).alias("kinds"), *(over(c, d).alias(f"kept_{c}_{i}") for i, d in enumerate(DISCOUNTS) for c in classes))
    words = storage.stage(right.join(left, "word", "left").na.fill(0), "toxic-words")
    sums = words.agg(F.sum(F.col("follows_toxic") + F.col("follows_ordinary")).alias("n"), F.count(F.lit(1)).alias("kinds"),
                     *(over(f"follows_{c}", d).alias(f"{c}_{i}") for i, d in enumerate(DISCOUNTS) for c in classes)).first()
    documents = spread.agg(F.sum("spread")).first()[0] or 0
    # of at most train_rows documents
    twice = F.greatest(*classes) >= 2
    table = words.where(twice).join(spread, "word", "left").na.fill(0).toArrow().to_pandas().sort_values("word")
    frequent = pairs.where(twice).select("left", "word", *classes).toArrow().to_pandas()
    key = pair_hash(frequent["left"].to_numpy(np.int64), frequent["word"].to_numpy(np.int64))
    order = np.argsort(key)
    pad = lambda a, v: np.asarray(a) if len(a) else np.array(v)
    both = lambda t, *c: pad(t[list(c)].to_numpy(np.float32), [[0.0, 0.0]])
    # arrays that all discounts share, in memory and in the broadcast
    words, follows = pad(table["word"].to_numpy(np.int64), [0]), both(table, *(f"follows_{c}" for c in classes))
    spread, pairs, pair_n = pad(table["spread"].to_numpy(np.float32), [0.0]), pad(key[order], [0]), both(frequent.iloc[order], *classes)
    models = [Model(
        words=words, follows=follows, kept=both(table, *(f"kept_{c}_{i}" for c in classes)),
        leave=pad(np.where(table["context"] > 0, np.minimum(1, d * table["kinds"] / np.maximum(table["context"], 1)), 1.0).astype(np.float32), [1.0]),
        spread=spread, pairs=pairs, pair_n=pair_n,
        total=np.maximum([sums[f"{c}_{i}"] or 0 for c in classes], 1.0), discount=d, back=min(1.0, d * sums["kinds"] / sums["n"]) if sums["n"] else 1.0,
        documents=float(documents), weights=np.zeros(3)) for i, d in enumerate(DISCOUNTS)]
    # in an order of the rows' own, so that neither the choice nor the sums depend on the tables' layout
    held = features_of(rows.where("not fits").select("label", "text", F.xxhash64("text").alias("mark")), models, "mark", "label").toArrow().sort_by([("mark", "ascending"), ("label", "ascending")])
    x, y = np.asarray(held["x"].combine_chunks().flatten()).reshape(-1, len(models), 2), held["label"].to_numpy().astype(float)
    half = held["mark"].to_numpy() % 2 == 0
    loss = [sum(log_loss(x[a, i], y[a], logistic(x[~a, i], y[~a])) for a in (half, ~half)) for i in range(len(models))]
    best = int(np.argmin(loss))
    return models[best]._replace(weights=logistic(x[:, best], y))


def log_loss(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    z = np.clip(w[0] + x @ w[1:], -50, 50) * np.where(y > 0, -1, 1)
    return float(np.logaddexp(0, z).mean()) if len(y) else 0.0


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (bias first) by Newton's method with a light ridge."""
    w = np.zeros(3)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        w[0] = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return w
    a = np.c_[np.ones(len(y)), x]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag([1e-6, 0.01, 0.01]), a.T @ (y - p) - np.array([0, 0.01, 0.01]) * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def features_of(docs: DataFrame, models: list[Model], *keep: str) -> DataFrame:
    """``keep`` columns and ``x``, both features by each model, for every row."""
    sent = docs.sparkSession.sparkContext.broadcast([tuple(m) for m in models])   # of the sample only
    schema = docs.select(*keep).schema.add("x", ArrayType(DoubleType()))

    def measure(batches):
        ms = [Model(*m) for m in sent.value]
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                ids = word_ids(part.column("text"))
                x = np.concatenate([m.features(*ids) for m in ms], axis=1)
                x = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), x], [*keep, "x"])

    return docs.select(*keep, "text").mapInArrow(measure, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = fit(docs, labels)
    bias, mean, peak = (float(w) for w in model.weights)
    z = F.lit(bias) + F.col("x")[0] * mean + F.col("x")[1] * peak
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(50.0)), F.lit(-50.0))))
    return features_of(docs, [model], "doc_id").select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), score.alias("score"),
        F.when(score >= threshold, 1).otherwise(0).alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows and columns of ``docs`` that the model does not reject."""
    model = fit(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def keep(batches):
        m = Model(*sent.value)
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                yield part.filter(pa.array(m.score(m.features(*word_ids(part.column("text")))) < threshold))

    return docs.mapInArrow(keep, docs.schema)
