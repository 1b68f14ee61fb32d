"""A corpus from ``documents`` to token ids, in stages written as Parquet.

Each stage takes (spark, docs, sf_dir) and works on all rows the one before
kept.  ORACLE_SQL is None: scores, components and token ids have no plain SQL;
tests hold the pipeline against a brute-force version of the later stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import bpe, mixing, ngram_join, pii, storage, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; repeated rows stay, as
    do null and empty texts unless most labelled documents are toxic."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: of the smallest id (null last), then of the
    smallest text hash.  Documents without a word are no copies of each other
    and stay; of these, rows with the same id and the same text are one.  Columns
    of any other name are carried along unseen."""
    groups = storage.stage(ngram_join.ngram_groups(docs), "groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    least = groups.where("component is not null").groupBy("component").agg(F.min(order).alias("o"))
    kept = least.select(F.col("o.doc_id").alias("kept_id"), F.col("o.text_hash").alias("kept_hash"), F.lit(False).alias("kept_all"))
    wordless = groups.where("component is null").select("doc_id", "text_hash", F.col("doc_id").isNull()).distinct()
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept_doc"))        # no name of docs can clash
    doc = F.col("kept_doc")
    same = doc["doc_id"].eqNullSafe(F.col("kept_id")) & (F.xxhash64(doc["text"]) == F.col("kept_hash"))
    rows = nested.join(kept.union(wordless), same).withColumn("kept_row", F.when(F.col("kept_all"), F.monotonically_increasing_id()))
    return rows.dropDuplicates(["kept_id", "kept_hash", "kept_row"]).select("kept_doc.*")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; null texts stay null."""
    return pii.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixture of sources (``mix_slot``,
    ``mix_before``, in place of columns of these names), in files that follow
    it; a null source is a source of its own."""
    return mixing.placed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the bytes decoded from them, in the order of
    the mixture: a row for every row, null texts as empty ones."""
    order = ("mix_slot", "mix_before")
    coded = storage.stage(bpe.bpe_digests(docs, keep=order), "pipeline-coded")     # the sort samples its input
    return coded.orderBy(*order, "doc_id", "ids_sha256").drop(*order)


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_copies), ("pii", redact), ("mixing", mix_sources), ("bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the final documents, in
    the order of the mixture."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = storage.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
