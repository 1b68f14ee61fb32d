"""Registered queries of the operators in this package.

Only ``op11_lexical_search`` has plain SQL for its rows; ``tests/llm`` holds each
of the others against a brute-force version instead.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (alignment, archive, bpe, language_id, lexical_search, mixing, ngram_join, pii, quality, quartile_digest, storage,
                         token_counts, token_shards, toxicity)
from stratum.llm import text as T

ARC_BYTES = 8 << 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id shards and their perfect hash index, written and read back."""
    return token_shards.token_shards(_table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word sets are similar."""
    return ngram_join.ngram_components(_table(spark, sf_dir, "documents"))


def op3_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of documents, of their edited texts, and their likeness."""
    return quartile_digest.digests(_table(spark, sf_dir, "documents"))


def arc_files(pages: DataFrame) -> DataFrame:
    """ARC files that hold ``pages`` as HTTP responses (``path, content``): only
    the converter's input.  Batches of about ``ARC_BYTES``, by turns in version
    1 and 2, a gzip member for each record."""
    spark = pages.sparkSession
    T.prepare(spark)
    path = storage.folder(spark, "arc")

    def write(batches):
        from pyspark import TaskContext
        k = 0
        for batch in batches:
            for part in T.split_batch(batch, "html", ARC_BYTES):
                name = f"pages-{TaskContext.get().partitionId()}-{k}.arc.gz"
                version = (TaskContext.get().partitionId() + k) % 2 + 1
                k += 1
                fields = "URL IP-address Archive-date Content-type " + ("Result-code Checksum Location Offset Filename " if version == 2 else "") + "Archive-length"
                block = f"{version} 0 stand-in\n{fields}\n".encode()
                out = [f"filedesc://{name} 0.0.0.0 20240101000000 text/plain {len(block)}\n".encode() + block]
                for page_id, url, html in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                    key = f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
                    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{key}\r\n".encode() + (html or "").encode()
                    more = f"200 - - 0 {name} " if version == 2 else ""
                    out.append(f"\n{' '.join((url or '-').split()) or '-'} 0.0.0.0 20240101000000 text/html {more}{len(body)}\n".encode() + body)
                storage.write_atomic(f"{path}/{name}", map(archive.gzip_member, out))
                yield pa.RecordBatch.from_pydict({"file": [name]})

    written = storage.stage(pages.select("page_id", "url", "html").mapInArrow(write, "file string"), "arc-names")
    if written.isEmpty():
        return spark.createDataFrame([], "path string, content binary")
    return spark.read.format("binaryFile").load(f"{path}/*.arc.gz").select("path", "content")


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages' ARC files converted to WARC, and the records read back."""
    files = archive.convert(arc_files(_table(spark, sf_dir, "pages")), storage.folder(spark, "warc"))
    return archive.resolve(archive.read_warcs(files)).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores by class-conditional Kneser-Ney models."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data by anchor expansion."""
    return pii.find_pii(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts by heap and linked list."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdicts by monotonic boosted trees."""
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select(
        "doc_id", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words", "base_failed", "kept")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids, and the bytes decoded from them."""
    return bpe.bpe_digests(_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of documents in the mixture of sources."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item by Block-Max MaxScore."""
    return lexical_search.ranked_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' tokens by two tokenizers, aligned by diagonal run skipping."""
    return alignment.aligned_tokens(_table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages by cross-parsing entropy."""
    return language_id.identify_languages(_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
b AS (
  SELECT row_number() OVER () AS q, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT q, item_id, term, count(*) AS k FROM (SELECT q, item_id, unnest(t) AS term FROM b) GROUP BY q, item_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 25 + (75 * len(t) * n_docs) // n_terms AS m FROM d, s WHERE len(t) > 0),
f AS (
  SELECT q, item_id, doc_id, r, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY q, item_id, doc_id, r),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM f WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""


QUERIES = (op1_token_shards, op2_ngram_join, op3_quartile_digest, op4_arc_to_warc, op5_toxicity, op6_pii, op7_token_counts,
           op8_quality, op9_bpe, op10_mixing, op11_lexical_search, op12_alignment, op13_language_id)


def queries() -> dict:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op11_lexical_search": OP11_SQL}
