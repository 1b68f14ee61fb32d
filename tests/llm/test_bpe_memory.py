"""What a worker of the BPE holds: each Python worker of an executor has its own."""

import tracemalloc

import numpy as np
import pyarrow as pa

from stratum.llm import bpe, language_id

CODER = bpe.WordIds(bpe.RANKS, {})


def test_decoding_a_batch_takes_little_memory():
    texts = [f"word{i % 90} and another number {i} ".ljust(40, "x") * 25 for i in range(2000)] + [None, "", "é" * 7]
    column = pa.array(texts, pa.string())
    ids, offs = CODER.encode(column)
    tracemalloc.start()
    made = sum(len(x) for x in CODER.decoded(ids, offs))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made == sum(len((t or "").encode()) for t in texts) == 2_000_014
    assert peak < 36 * len(ids) + 40 * bpe.DECODE_BYTES < 16 * made + 24 * len(ids)      # the whole batch at once took more
    assert [bytes(x).decode() for x in CODER.decoded(ids, offs, 100)] == [t or "" for t in texts]
    assert [bytes(x).decode() for x in CODER.decoded(*CODER.encode(pa.array([None, ""], pa.string())))] == ["", ""]
    assert list(CODER.decoded(np.zeros(0, np.uint32), np.zeros(1, np.int64))) == []


def test_remembered_words_are_bytes():
    ids = CODER.word(" unrememberable")
    assert isinstance(ids, bytes) and CODER.decode(np.frombuffer(ids, "<u4")).tobytes() == b" unrememberable"
    table = bpe.WordIds(bpe.RANKS, {bpe.as_symbols(b" ab"): bpe.as_bytes([1, 300, 49_000])})
    assert table.encode(pa.array([" ab"], pa.string()))[0].tolist() == [1, 300, 49_000]
    assert all(isinstance(x, bytes) for x in (*CODER.words.values(), *table.words.values()))


def test_another_broadcast_is_never_taken_for_the_last(monkeypatch):
    class Sent:
        def __init__(self, value):
            self.value = value

    monkeypatch.setattr(language_id, "Identifier", lambda value: value)
    monkeypatch.setattr(language_id, "_KNOWN", {})
    assert [language_id.identifier(Sent(i)) for i in range(50)] == list(range(50))      # addresses used to come again
