
import zlib
from collections import Counter
from fractions import Fraction

import corpus_pipeline
import numpy as np
import xxhash

from stratum.llm import mixing, storage, toxicity
from tests.llm.test_operators import ODD, SF

A, B, B2 = "one two three four five six seven", "red green blue black white grey pink", "RED green  blue black white grey pink"


def test_near_copies_keep_one_row_a_component(spark):
    extra = [(None, A), (None, A.upper()), (7, A[::-1]), (7, B[::-1]), (5, A + " x y"), (5, B), (3, B2), (None, ""), (None, "")]
    rows = [r[:2] for r in ODD] + extra
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, None).collect()]
    none_a = [r for r in got if r in ((None, A), (None, A.upper()))]
    assert len(none_a) == 1          # a component without an id
    exp = {*(r[:2] for r in ODD if r[0] != 9), (7, A[::-1]), (7, B[::-1]), (5, A + " x y"), (3, B2), *none_a, (None, "")}
    assert set(got) == exp and len(got) == len(exp) + 1


def test_plan_stays_within_a_block_of_the_weights():
    many = 60_000
    weights = [0.5] + [0.5 / 19 + i * 1e-4 for i in range(19)]
    shares = [Fraction(w) / sum(map(Fraction, weights)) for w in weights]
    had = Counter()
    for t, (i, j, slot, release, due, deviation) in enumerate(mixing.plan(weights, [many] * 20)):
        if t == many:
            break
        assert slot == t and j == had[i] and release == j // shares[i] and due == -(-(j + 1) // shares[i]) and release <= slot < due
        had[i] += 1
        assert abs(had[i] - (t + 1) * shares[i]) < 1 and abs(deviation - (had[i] - (t + 1) * shares[i])) < 1e-9
    assert all(abs(had[i] - many * s) < 1 for i, s in enumerate(shares))


def test_plan_of_sources_that_end_and_of_weight_zero():
    rows = list(mixing.plan([3.0, 0.0, 1e-3, 0.0], [4, 2, 3, 1]))
    assert sorted(r[:2] for r in rows) == [(i, j) for i, n in enumerate([4, 2, 3, 1]) for j in range(n)]
    slots = [r[2] for r in rows]
    assert slots == sorted(set(slots)) and all(r[3] <= r[2] < r[4] and abs(r[5]) < 1 for r in rows)
    assert {r[0] for r in rows[-3:]} == {1, 3}


def test_mix_of_many_sources(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('s', id) as source", "repeat('x', 1 + id % 7) as text")
    got = mixing.mix(docs).collect()
    assert len({r.slot for r in got}) == 3000 and all(r.release <= r.slot < r.deadline and abs(r.deviation) < 1 for r in got)


def test_pipeline_rows_follow_the_mixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    placed = storage.stage(corpus_pipeline.mix_sources(spark, docs, SF), "test-placed").repartition(7)
    got = corpus_pipeline.encode(spark, placed, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    exp = sorted((r.slot, r.before, r.doc_id) for r in mixing.slots(docs).collect())
    assert [r.doc_id for r in got.collect()] == [k for _, _, k in exp]
    assert len({s for s, _, _ in exp}) >= 20


def learned(n):
    """Ids that the counts are fitted on."""
    return [i for i in range(4 * n) if zlib.crc32(str(i).encode()) % 4 < 2][:n]


def test_toxicity_keeps_all_bigrams_of_the_sample(spark):
    ids = learned(540)
    rows = [(i, " ".join(f"w{k // 2 * 1000 + j}" for j in range(1000)), 1 - k // 2 % 2) for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert len(model.pairs) == len(model.words) == 270_000 > 1 << 18


def test_toxicity_backs_off_to_distinct_left_contexts(spark):
    ids = learned(60)
    rows = [(i, f"x{k} old francisco y{k} vile", k % 2) for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    at = lambda w: model.follows[toxicity.find(model.words, np.array([xxhash.xxh64_intdigest(w)], np.uint64).view(np.int64))[0][0]].tolist()
    assert at(b"francisco") == [1, 1] and at(b"old") == at(b"vile") == [30, 30]
