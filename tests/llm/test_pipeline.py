"""The pipeline's stages against brute-force versions on a small table."""

import hashlib
import tempfile

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from stratum.llm import bpe, pii

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [s for s, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "pii", "mixing", "bpe"]
    clean = corpus_pipeline.drop_toxic(spark, docs, SF).cache()
    assert clean.columns == docs.columns
    single = corpus_pipeline.drop_near_copies(spark, clean, SF)

    def shingles(t):
        w = t.encode().lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}

    rows = sorted((r.doc_id, r.text) for r in clean.collect())
    sets, comp = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                old, new = max(comp[i], comp[j]), min(comp[i], comp[j])
                comp = [new if c == old else c for c in comp]
    kept = {rows[c] for c in comp}
    assert {(r.doc_id, r.text) for r in single.collect()} == kept
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(bpe.RANKS), special_tokens={})
    exp = set()
    for k, t in kept:
        t = pii.redact(t, pii.spans(t))
        ids = enc.encode_ordinary(t)
        exp.add((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == exp


CLASHES = ("kept_id", "kept_hash", "kept_all", "kept_row", "kept_doc", "mix_slot", "mix_before", "mix_id", "mix_source", "mix_hash", "mix_doc", "mix_key", "size", "block", "slot",
           "x", "n", "c", "t", "bits", "component", "text_hash", "label", "row", "word")


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_odd_rows(spark, empty):
    """Nulls in every column, repeated ids and rows, ties, long texts, columns
    with the stages' own names, and an empty table."""
    copy = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, copy, "en", "s", 1), (1, None, None, None, None), (1, None, None, None, None), (1, "", "en", "s", 0), (2, copy, "en", None, 1), (2, copy, "en", None, 1),
            (3, "the onerous thing " * 4000, "en", "t", 5), (4, " \n\t", "de", "t", 2), (None, "other words of nobody here", None, "u", 3), (5, "mail a@b.org", "en", "s", 9)]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(7) for c in CLASHES})
    sf = tempfile.mkdtemp(prefix="stratum-odd-", dir="/tmp")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    stage = spark.read.parquet(f"{sf}/documents.parquet")
    for name, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, sf)
        assert set(docs.columns) <= set(stage.columns), name
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in corpus_pipeline.run(spark, sf).collect())
    # copy: of the smallest id; without a word: one row for each id and text
    want = [] if empty else [(False, 1, 0), (False, 1, 0), (False, 2, None), (False, 3, None), (False, 4, None), (False, 5, None), (True, 0, None)]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got if g[1] == 1] == ([] if empty else [0, 0])
