"""What a worker of the alignment holds: each Python worker of an executor has its own."""

import numpy as np
import pytest

from stratum.llm import alignment

PIECES = [f" w{i * i:x}" for i in range(9000)] + [" ", " a b", " é\n", " 中文", " <|endoftext|>"]
PIECES = [p.encode() for p in PIECES]


@pytest.mark.parametrize("kind, path", [(alignment.ByteLevel, alignment.A), (alignment.Pieces, alignment.B)])
def test_few_pieces_are_tokenised_at_once(kind, path, monkeypatch):
    coder, seen = kind(path), []
    whole = coder.encode(PIECES)
    encode = coder.encode
    coder.encode = lambda pieces: (seen.append(len(pieces)), encode(pieces))[1]
    index = np.r_[np.arange(len(PIECES)), [3, 3, 9004]]
    ids, lens, _ = coder.take(PIECES, index)
    assert lens.tolist() == [len(whole[i]) for i in index] and ids.tolist() == [x for i in index for x in whole[i]]
    assert sum(seen) == len(PIECES) and max(seen) <= 2048           # all in one call before
    monkeypatch.setattr(alignment, "CACHE_ENTRIES", 9100)
    again = [p + b"x" for p in PIECES]
    for pieces, n in ((PIECES, 0), (again, len(again)), (again, len(again))):      # those that don't fit are not remembered
        seen.clear()
        ids, lens, _ = coder.take(pieces, index[::-1])
        assert lens.sum() == len(ids) and sum(seen) == n and len(coder.known) == len(PIECES)
    assert [x.tolist() for x in coder.encoded([])] == [[], []]
