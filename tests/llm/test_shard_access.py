"""Keyed access reads a bounded number of bytes besides the payload."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import storage, token_shards


class Counted:
    """A file that counts what is read of it."""

    def __init__(self, f):
        self.f, self.n = f, 0

    def read(self, n):
        self.n += n
        return self.f.read(n)

    def seek(self, at):
        self.f.seek(at)

    def size(self):
        return self.f.size()


@pytest.mark.parametrize("documents", [50, 3000])
def test_bytes_of_a_lookup(spark, documents):
    docs = spark.range(documents).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words of document "), F.col("id").cast("string")).alias("text")).coalesce(1)
    path = storage.folder(spark, "access-test")
    rows = token_shards.write_shards(docs, path)
    directory, segments = token_shards.write_index(rows, path)
    key = documents // 2
    slot = token_shards.lookup(docs.where(F.col("doc_id") == key), path, directory, segments).first()
    assert slot.rows == 1 and slot.doc_id == key
    fs, top = storage.filesystem(path)
    f = Counted(fs.open_input_file(f"{top}/shard-{slot.shard}.ids"))
    shard = token_shards.Shard(f)
    ids = shard.read(slot.first, slot.size)
    assert ids[-1] == 0 and f.n == 16 + slot.size * shard.dtype.itemsize
    coder = token_shards.chunk_ids(token_shards.TOKENIZER).tokenizer
    assert ids[:-1].tolist() == coder.encode(f"some words of document {key}", add_special_tokens=False).ids
    assert shard.bounds(slot.ordinal, 1).tolist() == [slot.first, slot.first + slot.size]


def test_far_documents_are_read_apart():
    first, size = np.array([0, 10, 10**6, 10**6 + 5]), np.array([10, 3, 5, 5])
    assert token_shards.near_runs(first, size) == [(0, 2), (2, 4)]


def test_wide_ids(spark):
    """Ids of four bytes are told by the file's size."""
    import io

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    for kind in ("<u2", "<u4"):
        ids = np.arange(7).astype(kind)
        shard = token_shards.Shard(File(ids.tobytes() + np.array([0, 3, 7, 2], "<u8").tobytes()))
        assert shard.dtype == np.dtype(kind) and shard.read(3, 4).tolist() == [3, 4, 5, 6] and shard.bounds(0, 2).tolist() == [0, 3, 7]
