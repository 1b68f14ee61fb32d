"""Operators against brute force, with nulls, empty and long texts, repeated
rows, ties, clashing extra columns and empty tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratum.llm import archive, bpe, mixing, ngram_join, pii, quality, quartile_digest, storage, token_counts, token_shards, toxicity
from stratum.llm import queries as Q
from stratum.llm import text as T

SF = "/root/testdata/sf0.001"
LONG = "the onerous thing " * 4000
ODD = [(None, "a b c d e f g " * 9, "x", 1), (1, None, None, 2), (1, "", "x", None), (2, LONG, "y", 4), (2, LONG, "y", 4), (3, "the a", "z", 5),
       (9, "THE  A", "z", 5), (None, "zz@y.org, 10.1.2.3", "x", 7), (5, " \n\t", "x", 7), (6, "é  　x<|endoftext|>'s 12  ", "y", 8)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source", "n_chars")


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with clashing extra columns."""
    names = ("part", "guest", "core", "segment", "shard", "label", "n", "slot", "block", "size", "word", "bits")
    return spark.createDataFrame(ODD, "doc_id long, text string, source string, n_chars long").withColumns({c: F.lit(7) for c in names})


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))


def test_chunks_never_split_a_token():
    rng, tk = random.Random(1), library()
    bits = ["a", "the", "  ", " ", "\n", "'s", " ", "　", "é", "<|endoftext|>", "|>", "12", ",", "...", "\x85", " A", "😀", "don't", "_"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    known, index, offs = T.chunks(pa.array(texts))
    table = token_counts.merge_table(token_counts.TOKENIZER)
    for i, t in enumerate(texts):
        own = [known[k] for k in index[offs[i]:offs[i + 1]]]
        ids = tk.encode(t, add_special_tokens=False).ids
        assert [x for c in own for x in tk.encode(c.decode(), add_special_tokens=False).ids] == ids
        assert sum(map(table.chunk, own)) == len(ids)


@pytest.mark.parametrize("name", ["docs", "odd"])
def test_token_shards_and_counts(name, request):
    df, tk, at, exp = request.getfixturevalue(name), library(), 0, []
    counts = []
    for k, t in rows_of(df):
        ids = tk.encode(t or "", add_special_tokens=False).ids + [0]
        exp.append((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        counts.append((k, len((t or "").encode()), len(ids) - 1, len(ids) - 1 > 512))
        at += len(ids)
    key = lambda r: str(r)
    assert sorted(map(tuple, token_shards.token_shards(df).collect()), key=key) == sorted(exp, key=key)
    assert sorted(map(tuple, token_counts.token_counts(df).collect()), key=key) == sorted(counts, key=key)


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = pa.array([None, *range(-50, 5000)])
    n = len(keys)
    seg = token_shards.Segment.load(token_shards.Segment.build(keys, np.arange(n), np.arange(n), np.ones(n)).dump())
    assert sorted(seg.slot_of(keys)) == list(range(n))
    found, record = seg.get(keys)
    assert found.all() and (record["ordinal"] == np.arange(n)).all()
    assert not seg.get(pa.array(range(10**6, 10**6 + 5000)))[0].any()


def brute_components(rows):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    sets, comp = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                old, new = max(comp[i], comp[j]), min(comp[i], comp[j])
                comp = [new if c == old else c for c in comp]
    ids = {}
    for c, (k, _) in zip(comp, rows):
        ids.setdefault(c, []).append(k)
    return sorted(((k, len(s), min((x for x in ids[c] if x is not None), default=None)) for c, s, (k, _) in zip(comp, sets, rows)), key=str)


def near_copies(n, seed):
    """Chains and groups of near copies round the threshold."""
    rng, rows = random.Random(seed), []
    for g in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 6)):
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_components(spark, seed, monkeypatch):
    rows = near_copies(60, seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(ngram_join, "GROUP_ROWS", 4 if seed == 2 else 2048)     # blocks of a hot group
    assert sorted(map(tuple, ngram_join.ngram_components(df).collect()), key=str) == brute_components(rows)


def test_ngram_components_on_odd_rows(odd):
    assert sorted(map(tuple, ngram_join.ngram_components(odd).collect()), key=str) == brute_components(rows_of(odd))


@pytest.mark.parametrize("rows", [1, 3, 1000])
def test_shared_entries_over_any_batches(spark, rows):
    rng = random.Random(rows)
    entries = [(rng.randrange(40), rng.randrange(9), 1) for _ in range(300)] + [(99, 1, 1)] * 5
    T.prepare(spark, rows)
    got = ngram_join.shared_entries(spark.createDataFrame(entries, "token long, c long, n long")).collect()
    T.prepare(spark)
    own = {t: {c for x, c, _ in entries if x == t} for t, _, _ in entries}
    assert sorted(map(tuple, got)) == sorted((t, c, 1) for t, cs in own.items() if len(cs) > 1 for c in cs)


def test_signature_tree_loses_no_pair():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 900, 60).astype(np.uint64) << np.uint64(20)) for _ in range(120)]
    sets += [np.unique(np.r_[s[4:], s[:1] + np.uint64(7 << 20)]) for s in sets[:60]]
    n, cores = np.array(list(map(len, sets))), np.arange(len(sets))
    bits = ngram_join.folded([ngram_join.bitmap(s).tobytes() for s in sets])
    rows = n, cores, bits, np.ones(len(n), bool)
    half = np.arange(len(n)) % 3 == 0
    a, b = np.flatnonzero(half), np.flatnonzero(~half)
    i, j = ngram_join.signature_pairs([r[a] for r in rows], [r[b] for r in rows])
    between = set(zip(a[i].tolist(), b[j].tolist()))
    pairs = [tuple(sorted(p)) for p in zip(*(x.tolist() for x in ngram_join.signature_pairs(rows)))]
    found = set(pairs)
    assert len(found) == len(pairs) and all(x != y for x, y in found)
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (n[i] + n[j] - both):
                assert (j, i) in found
                assert half[i] == half[j] or (i, j) in between or (j, i) in between
    assert len(found) < len(sets) * 10


@pytest.mark.parametrize("group_rows,meetings", [(2048, 32), (4, 32), (2048, 1), (4, 1)])
def test_candidates_hold_every_link(spark, monkeypatch, group_rows, meetings):
    monkeypatch.setattr(ngram_join, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(ngram_join, "MEETINGS", meetings)
    T.prepare(spark)
    docs = spark.createDataFrame(near_copies(50, 9), "doc_id long, text string").repartition(4)
    described = ngram_join.describe(docs).cache()
    classes = described.where("kind = 0 and n > 0").groupBy(F.col("c").alias("id")).agg(F.first("n").alias("n"), F.first("t").alias("t"), F.first("bits").alias("bits"))
    members = ngram_join.shared_entries(ngram_join.prefix_entries(docs, ngram_join.total_sketch(described))).withColumnRenamed("c", "id")
    got = {tuple(r) for r in ngram_join.candidate_pairs(members.withColumn("core", F.col("id")), classes).collect()}
    sets = {r["id"]: set(r["shingles"]) for r in ngram_join.sets_of(docs, classes.select("id", "t")).collect()}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert links and links <= got
    described.unpersist()


@pytest.mark.parametrize("name", ["docs", "odd"])
def test_digests(name, request):
    df = request.getfixturevalue(name)
    rows = rows_of(df)
    exp = []
    for i, (k, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        edited = t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]
        exp.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), quartile_digest.digest(t.encode()).tobytes().hex(),
                    quartile_digest.digest(edited.encode()).tobytes().hex()))
    got = quartile_digest.digests(df).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(exp, key=str)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    if name == "docs":
        a, b = (np.array([r[i] for r in got]) for i in (5, 6))
        assert (a[:, None] > b).mean() > 0.9


def brute_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_pii_base_spans():
    rng = random.Random(3)
    bits = ["a", "b", "@", ".", "1", "25", "+", "-", " ", "(", "256", "1.2.3.4", "4111 1111 1111 1111", "x@y.z", "+1 (", "555-", "é", "IBAN: ", "\n", "%"]
    for _ in range(8000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 16)))
        assert [s for s in pii.spans(t) if s[0] in pii.BASE] == brute_pii(t), t
    assert pii.redact("at x@y.z or http://a.b/c.", pii.spans("at x@y.z or http://a.b/c.")) == "at [EMAIL] or [URL]."


def test_pii_query(docs, odd):
    for df in (docs, odd):
        got = {(r.doc_id, r.spans): r for r in pii.find_pii(df).collect()}
        for k, t in rows_of(df):
            r = got[k, pii.joined(pii.spans(t or ""))]
            base = brute_pii(t or "")
            assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in pii.BASE)
    assert pii.redact_documents(odd).columns == odd.columns


def test_quality(spark, docs, odd):
    labels = spark.read.parquet(f"{SF}/labels.parquet")

    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", t or "")

    def counts(t):
        w = words(t)
        n = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        inside = {j for i in range(len(w) - 7) if n[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines, dup = set(), 0
        for line in (t or "").split("\n"):
            if words(line):
                dup += line in lines
                lines.add(line)
        return sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(inside), len(w)

    for df in (docs, odd):
        got = quality.quality(df, labels).collect()
        exp = [(k, *(c := counts(t)), c[4] < 20 or 100 * c[3] > 30 * c[4]) for k, t in rows_of(df)]
        assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(exp, key=str)
        assert not any(r.kept and r.base_failed for r in got)


def test_trees_follow_their_constraints():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality.FEATURES)))
    y = (x[:, 4] + 0.3 * rng.standard_normal(3000) < 0.6).astype(float)
    trees = quality.fit_trees(x, y)
    for j, (_, sign) in enumerate(quality.FEATURES):
        if sign:
            grid = np.repeat(x[:20], 50, axis=0)
            grid[:, j] = np.tile(np.linspace(0, 1, 50), 20)
            assert (sign * np.diff(trees.margin(grid).reshape(20, 50), axis=1) >= -1e-9).all()
    assert ((trees.score(x) > 0.5) == y).mean() > 0.75
    assert len(quality.fit_trees(x, np.ones(3000)).roots) == 0


@pytest.mark.parametrize("name", ["docs", "odd"])
def test_bpe(name, request):
    df = request.getfixturevalue(name)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(bpe.RANKS), special_tokens={})
    exp = []
    for k, t in rows_of(df):
        ids = enc.encode_ordinary(t or "")
        exp.append((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.bpe_digests(df).collect()), key=str) == sorted(exp, key=str)


def test_fold_equals_library(spark):
    words = ["", "a", " the", " thonheth", "aaaaaaaaaa", " ñçcheau", "12345", "\n\n", "ab" * 15][1:]
    enc = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=bpe.ranks_of(bpe.RANKS), special_tokens={})
    df = spark.createDataFrame([(bpe.as_symbols(w.encode()),) for w in words], "word string")
    got = {r.word: list(r.ids) for r in bpe.fold_words(df, bpe.ranks_of(bpe.RANKS)).collect()}
    assert got == {bpe.as_symbols(w.encode()): enc.encode_ordinary(w) for w in words}


def test_schedule_deviates_by_less_than_a_block():
    for weights in ({"a": 5.0, "b": 3.0, "c": 0.1}, {"x": 1.0}, {f"s{i}": 1.0 + i for i in range(17)}):
        quota = mixing.quotas(weights, 400)
        plan = mixing.schedule(quota)
        had = Counter()
        for t, (name, j, slot, release, due) in enumerate(plan, 1):
            assert slot == t - 1 and release <= slot < due and j == had[name]
            had[name] += 1
            assert all(abs(had[n] - c * t / 400) < 1 for n, c in quota.items())
        assert had == quota


def test_mix_keeps_every_row(docs, odd):
    for df in (docs, odd):
        got = mixing.mix(df, block_chars=2000).collect()
        assert sorted(((r.doc_id, r.source) for r in got), key=str) == sorted(map(tuple, df.select("doc_id", "source").collect()), key=str)
        assert all(r.release <= r.slot < r.deadline and abs(r.deviation) < 1 for r in got)
        mixed = mixing.mixed_documents(df, block_chars=2000)
        assert mixed.columns == df.columns and sorted(map(str, mixed.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(ValueError):
        mixing.MAX_SOURCES, kept = 1, mixing.MAX_SOURCES
        try:
            mixing.mix(docs)
        finally:
            mixing.MAX_SOURCES = kept


@pytest.mark.parametrize("plain", [False, True])
def test_archive_round_trip(spark, tmp_path, plain):
    pages = [(1, "http://a/", "x"), (2, "http://b/ c", "x"), (3, None, None), (4, "http://d/", ""), (None, "http://e/", "x"), (5, "http://f/", "é" * 50_000), (7, "http://g/", "y\n\nfiledesc")]
    files = Q.arc_files(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3))
    if plain:
        for r in files.collect():
            (tmp_path / archive.short_name(r.path).removesuffix(".gz")).write_bytes(archive.inflated(r.content))
        files = spark.read.format("binaryFile").load(f"{tmp_path}/*.arc").select("path", "content")
    warcs = archive.convert(files, storage.folder(spark, "warc-test"))
    got = {r.key: r for r in archive.resolve(archive.read_warcs(warcs)).collect()}
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    for k, _, html in pages:
        assert (got[k].payload_bytes, got[k].payload_digest) == (len((html or "").encode()), sha(html))
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        1: ("response", None), 2: ("revisit", 1), None: ("revisit", 1), 3: ("response", None), 4: ("revisit", 3), 5: ("response", None), 7: ("response", None)}
    assert got[5].record_id.startswith("<urn:uuid:")


def test_inflated_members():
    parts = [b"one\n", b"", b"x" * 300_000]
    whole = b"".join(map(archive.gzip_member, parts))
    assert archive.inflated(whole) == b"".join(parts) == archive.inflated(whole, 7)
    assert archive.inflated(b"plain") == b"plain" and archive.inflated(b"") == b""
    assert (b"one\n" + b"x" * 300_000).startswith(archive.inflated(whole[:-40]))


def test_arc_versions_and_bad_headers():
    v2 = b"2 0 t\nfields\n"
    data = b"filedesc://x 0.0.0.0 20240101000000 text/plain %d\n" % len(v2) + v2 + b"\nhttp://a/b c 1.2.3.4 20240229120000 text/html 200 - - 0 x 3\nabc\n"
    (_, _, fields, _, size), = archive.arc_records(data)
    assert fields[0] == "http://a/b c" and size == 3 and archive.iso_date(fields[2]) == "2024-02-29T12:00:00Z"
    assert archive.iso_date("nonsense") == "1970-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        list(archive.arc_records(b"nonsense\n"))


def test_toxicity(spark, odd):
    rng, rows, labels = random.Random(2), [], []
    for i in range(600):
        words = [f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            for j in rng.sample(range(60), 4):
                words[j] = rng.choice(["vile", "Foul,", "nasty"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(df, lab).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert sum((r.doc_id % 4 == 0) == (r.predicted == 1) for r in held) > 0.95 * len(held)
    kept = toxicity.clean_documents(df, lab)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}
    assert toxicity.toxicity(odd, lab.limit(0)).where("predicted = 0").count() == len(ODD)


@pytest.mark.parametrize("f", [token_shards.token_shards, ngram_join.ngram_components, quartile_digest.digests, pii.find_pii, token_counts.token_counts,
                               bpe.bpe_digests, mixing.mix, mixing.mixed_documents, pii.redact_documents])
def test_empty_table(odd, f):
    assert f(odd.limit(0)).count() == 0
