"""Lexical search, token alignment and language identification against brute
force, with nulls, empty and long texts, repeated rows, ties, clashing extra
columns and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from stratum.llm import alignment, language_id, lexical_search
from stratum.llm import queries as Q

SF = "/root/testdata/sf0.001"
LONG = "the onerous thing " * 500
BITS = ["a", "the", "  ", " ", "\n", "'s", "é", "　", "<|endoftext|>", "</s>", "<s>", "<unk>", "<0x41>", "12", "...", "\x85", " A", "😀", "don't", "_", "日本", "====", "\x00", "ﬁ", "é", "\t"]
ODD = [(None, "a b c d e f g " * 9, "en", 1), (1, None, None, 2), (1, "", "fr", None), (2, LONG, "en", 4), (2, LONG, "en", 4), (3, "the a", "de", 5), (9, "THE  A", "de", 5),
       (None, "zz@y.org, 10.1.2.3 the", None, 7), (5, " \n\t", "x", 7), (6, "é  　x<|endoftext|>'s 12  ", "fr", 8), (7, "a▁b the", "en", 1), (8, "=" * 700 + "\n" * 90 + " " * 333, "en", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with clashing extra columns, and random texts."""
    rng = random.Random(7)
    more = [(100 + i, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))), rng.choice(["en", "fr", None]), i) for i in range(300)]
    names = ("row", "key", "query", "item", "term", "shard", "rank", "score", "pair", "pairs", "links", "n", "a", "best", "h", "of", "t", "share", "passage", "held_out")
    return spark.createDataFrame(ODD + more, "doc_id long, text string, lang string, n_chars long").withColumns({c: F.lit(7) for c in names})


def same(found, expected):
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, expected), key=str)


# search

def brute_search(docs, items, k=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
    bags = [(key, Counter(split(t))) for key, t in docs]
    bags = [(key, b, sum(b.values())) for key, b in bags if b]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        q = Counter(split(text))
        scored = []
        for key, b, n in bags:
            m = 100 - 75 + 75 * n * n_docs // total
            s = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t, c in q.items() if t in b)
            if s > 0:
                scored.append((-s, key is None, key or 0, key))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:k])]
    return out


@pytest.fixture
def items(spark):
    rows = [(1, "the a b c"), (2, None), (2, "THE the THE"), (3, "nowhere-to-be-found"), (None, "é 12 endoftext s"), (4, ""), (5, LONG + " x日本 ")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumns({c: F.lit(1) for c in ("doc_id", "query", "w", "q")})


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("name", ["docs", "odd"])
def test_search(name, small, items, spark, request, monkeypatch):
    if small:                                     # several shards, ranges, blocks and query blocks
        for c, v in {"BLOCK": 4, "SHARD_DOCS": 50, "RANGE": 8, "QUERY_ENTRIES": 5}.items():
            monkeypatch.setattr(lexical_search, c, v)
    df = request.getfixturevalue(name)
    bench = items.select("item_id", "text").union(spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").limit(20))
    rows = lambda d, k: [tuple(r) for r in d.select(k, "text").collect()]
    found = lexical_search.ranked_documents(df, bench if name == "docs" else items)
    same(found.collect(), brute_search(rows(df, "doc_id"), rows(bench if name == "docs" else items, "item_id")))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]


def test_search_drops_candidates_before_unpacking():
    """Only blocks whose maximum may matter are unpacked, and ranges without hope not at all."""
    rng, texts = random.Random(3), []
    for i in range(6000):
        texts.append(" ".join(["common"] * rng.randint(1, 3) + ["filler"] * rng.randint(5, 60) + (["rare"] * 3 if i % 1024 < 12 else [])))
    keys = pa.array(range(6000))
    batch = lexical_search.shard_rows(0, pa.array(texts), keys, 6000, 6000 * 35).to_pylist()
    norms = np.array(batch[0]["norms"])
    lists = {r["term"].decode(): lexical_search.PostingList(r["df"], r["top"], r["heads"], r["data"], norms) for r in batch[1:]}
    best = lexical_search.Best(10)
    weight = {"common": 1, "filler": 1, "rare": 6000}
    lexical_search.max_score([(w, lists[t], lists[t].range_tops(6)) for t, w in weight.items()], 6000, np.arange(6000), np.zeros(6000, bool), best)
    score = lambda i: sum(w * lexical_search.impact(c, int(norms[i])) for t, w in weight.items() if (c := texts[i].split().count(t)))
    assert list(zip(best.scores.tolist(), best.keys.tolist())) == sorted(((score(i), i) for i in range(6000)), key=lambda x: (-x[0], x[1]))[:10]
    assert len(lists["common"].blocks) < len(lists["common"].last) * 0.8


def test_search_blocks_round_trip():
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["x", "y", "z", "é"], k=rng.choice([0, 1, 3, 70_000 if i == 3 else 5]))) for i in range(700)]
    batch = lexical_search.shard_rows(9, pa.array(texts), pa.array(range(700)), 700, 5000).to_pylist()
    assert batch[0]["keys"] == list(range(700)) and all(r["shard"] == 9 for r in batch)
    for r in batch[1:]:
        p = lexical_search.PostingList(r["df"], r["top"], r["heads"], r["data"], np.array(batch[0]["norms"]))
        found = [(int(d), int(i)) for b in range(len(p.last)) for d, i in zip(*p.block(b))]
        want = [(d, lexical_search.impact(c, batch[0]["norms"][d])) for d, t in enumerate(texts) if (c := t.split().count(r["term"].decode()))]
        assert found == want and p.df == len(want) and p.top == max(i for _, i in want)
        assert [max(i for _, i in want[k:k + lexical_search.BLOCK]) for k in range(0, len(want), lexical_search.BLOCK)] == p.tops.tolist()


# alignment

def brute_align(docs):
    tk, sp = Tokenizer.from_file(alignment.A), SentencePieceProcessor(model_file=alignment.B)
    tk.encode_special_tokens = True
    byte = {c: i for i, c in enumerate(alignment.byte_symbols())}
    out, counts, held = [], Counter(), []
    for key, text in docs:
        a = tk.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        xa = [bytes(byte[c] for c in tk.id_to_token(i)) for i in a]
        xb = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [sp.id_to_piece(i)]]
        if not text or b"".join(xa) != (" " + text).encode() or b"".join(xb) != (" " + text).encode():
            held.append((key, [], 0, 0))
            continue
        ends = lambda x: np.cumsum([len(t) for t in x]).tolist()
        ea, eb = ends(xa), ends(xb)
        cuts = sorted(set(ea) & set(eb))
        group = lambda ids, e: [[i for i, z in zip(ids, e) if lo < z <= hi] for lo, hi in zip([0, *cuts], cuts)]
        groups = list(zip(group(a, ea), group(b, eb)))
        held.append((key, groups, len(a), len(b)))
        counts.update({(x, y) for u, v in groups for x in u for y in v})
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    for key, groups, na, nb in held:
        links = [(x, y) for u, v in groups for x in u for y in v]
        text = ";".join(f"{','.join(map(str, u))}|{','.join(map(str, v))}" for u, v in groups)
        out.append((key, na, nb, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if na else ""))
    return out


@pytest.mark.parametrize(("name", "table_pairs"), [("docs", alignment.TABLE_PAIRS), ("odd", 0), ("odd", 50)])
def test_alignment(name, table_pairs, request, monkeypatch):
    if table_pairs == 0:                          # many slices of a batch
        monkeypatch.setattr(alignment, "PART_BYTES", 300)
    df = request.getfixturevalue(name)
    if name == "docs":
        df = df.where("n_chars < 6000")
    found = alignment.aligned_tokens(df, table_pairs=table_pairs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    same(found.collect(), brute_align([tuple(r) for r in df.select("doc_id", "text").collect()]))


def test_align_runs():
    rng = random.Random(2)
    for _ in range(2000):
        last = rng.randint(1, 80)
        a, b = (sorted({*rng.sample(range(1, last + 1), rng.randint(0, last)), last}) for _ in range(2))
        runs, groups = alignment.align(a, b)
        cuts = sorted(set(a) & set(b))
        ends = sorted([a[i + t] for i, _, k in runs for t in range(k)] + [a[x - 1] for _, x, _, _ in groups])
        assert ends == cuts
        assert all(a[i:i + k] == b[j:j + k] for i, j, k in runs)
        assert all(a[x - 1] == b[y - 1] and not set(a[i:x - 1]) & set(b[j:y - 1]) for i, x, j, y in groups)
        covered = sorted([i + t for i, _, k in runs for t in range(k)] + [t for i, x, _, _ in groups for t in range(i, x)])
        assert covered == list(range(len(a)))
    assert alignment.align(list(range(1, 5001)), list(range(1, 5001))) == ([(0, 0, 5000)], [])


def test_space_chunks_never_split_a_piece():
    rng, sp = random.Random(1), SentencePieceProcessor(model_file=alignment.B)
    texts = [" " + "".join(rng.choice(BITS) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    known, index, offs = alignment.space_chunks(pa.array(texts))
    for i, t in enumerate(texts):
        own = alignment.coder(alignment.B).encode([known[k] for k in index[offs[i]:offs[i + 1]]])
        assert [x for ids in own for x in ids] == sp.encode(t[1:])


# languages

def brute_language(text, samples):
    own = language_id.letters(text or "")
    if not own:
        return "und", 0.0
    costs = []
    for lang in sorted(samples):
        joined, at, n = "\n".join(samples[lang]), 0, 0
        while at < len(own):
            size = 1
            while at + size < len(own) and own[at:at + size + 1] in joined:
                size += 1
            at, n = at + size, n + 1
        costs.append((n * math.log2(len(joined) + 2), lang))
    costs.sort()
    return costs[0][1], 1.0 if len(costs) == 1 else min(1.0, costs[1][0] / costs[0][0] - 1)


@pytest.mark.parametrize("name", ["docs", "odd"])
def test_language(name, request):
    df = request.getfixturevalue(name)
    if name == "docs":
        df = df.where("n_chars < 3000")
    samples = language_id.learn(df, 6)
    got = language_id.identify_languages(df, 6)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    want = [(k, k is not None and zlib.crc32(str(k).encode()) % 5 == 0, *brute_language(t, samples)) for k, t in df.select("doc_id", "text").toLocalIterator()]
    key = lambda r: (str(r[0]), r[1], r[2], round(r[3], 6))
    assert sorted(map(key, got.collect())) == sorted(map(key, want))


def test_language_learns_only_from_its_fold(docs):
    """Texts, labels and ids of held-out rows change nothing, nor does the layout."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    own = language_id.learn(docs)
    assert sorted(own) == ["de", "en", "es", "fr"]
    changed = docs.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang"))).withColumn("text", F.when(held, "zq").otherwise(F.col("text")))
    assert language_id.learn(changed) == own
    assert language_id.learn(docs.union(docs).repartition(7)) == own
    assert all(len(s) <= language_id.PASSAGES for s in own.values())


def test_language_on_held_out_rows(spark):
    """At sf0.01 nearly all held-out rows get their language."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = language_id.identify_languages(d).where("held_out").join(d, "doc_id").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"), "score").collect()
    assert len(r) > 150 and sum(x["ok"] for x in r) >= 0.98 * len(r) and all(0 <= x["score"] <= 1 for x in r)


def test_suffix_automaton_is_of_all_substrings():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(6)]
    own = language_id.SuffixAutomaton(texts)
    for _ in range(3000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 8)))
        state = own.root
        for c in word:
            state = state and state.get(c)
        assert (state is not None) == any(word in t for t in texts)


# all

def test_empty_tables(spark, odd, items):
    none, no_items = odd.limit(0), items.limit(0)
    assert lexical_search.ranked_documents(none, items).count() == lexical_search.ranked_documents(odd, no_items).count() == 0
    assert alignment.aligned_tokens(none).count() == language_id.identify_languages(none).count() == 0
    unlabelled = language_id.identify_languages(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {tuple(r) for r in unlabelled.select("lang_pred", "score").distinct().collect()} == {("und", 0.0)}


def test_queries_are_registered():
    assert {"op11_lexical_search", "op12_alignment", "op13_language_id"} <= set(Q.queries())
    assert set(Q.oracle_sql()) == {"op11_lexical_search"}
