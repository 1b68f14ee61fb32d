r"""Token counts by byte-pair merging with a heap and a linked list.

The count of a piece is its number of bytes minus the number of merges; no
token id is ever made.  Counts equal those of the tokenizers library for a
byte-level BPE file.

Defined cases: null or empty text counts 0; repeated rows and repeated or null
``doc_id`` give a row each; other columns are ignored; an empty table gives an
empty result.  Text of any length is one row's work and is processed whole.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

from stratum.llm import text as T

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 512
CACHE_ENTRIES = 400_000     # pieces remembered by a worker; only speed depends on it


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class MergeTable:
    """Ranked merges and special strings of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbol = byte_symbols()
        number = {}
        for s in symbol:
            number[s] = len(number)
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            whole = number.setdefault(left + right, len(number))
            self.merges[number[left], number[right]] = (rank, whole)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.pieces: dict[str, int] = {}
        self.chunks: dict[bytes, int] = {}

    def piece(self, piece: bytes) -> int:
        return len(piece) - count_merges(list(piece), self.merges)

    def plain(self, text: str) -> int:
        total, known = 0, self.pieces
        for p in self.pattern.findall(text):
            n = known.get(p)
            if n is None:
                n = self.piece(p.encode())
                if len(known) < CACHE_ENTRIES and len(p) < 64:
                    known[p] = n
            total += n
        return total

    def text(self, text: str) -> int:
        """Tokens of ``text``; a special string is one token."""
        if self.special is None:
            return self.plain(text)
        total, at = 0, 0
        for m in self.special.finditer(text):
            total += self.plain(text[at:m.start()]) + 1
            at = m.end()
        return total + self.plain(text[at:])

    def chunk(self, chunk: bytes) -> int:
        n = self.chunks.get(chunk)
        if n is None:
            n = self.text(chunk.decode())
            if len(self.chunks) < CACHE_ENTRIES and len(chunk) < 64:
                self.chunks[chunk] = n
        return n


def count_merges(symbols: list[int], merges: dict) -> int:
    """Merges done on ``symbols`` when the lowest-rank adjacent pair (leftmost
    on ties) is merged again and again.  ``symbols`` and two link arrays form
    the linked list; a heap entry is stale once either symbol has changed."""
    n = len(symbols)
    if n < 2:
        return 0
    after, prior = [*range(1, n), -1], [*range(-1, n - 1)]
    heap = []
    for i in range(n - 1):
        found = merges.get((symbols[i], symbols[i + 1]))
        if found:
            heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    heapq.heapify(heap)
    done = 0
    while heap:
        _, i, left, right, whole = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j < 0 or symbols[j] != right:
            continue
        symbols[i], symbols[j] = whole, -1
        k = after[i] = after[j]
        done += 1
        if k >= 0:
            prior[k] = i
            found = merges.get((whole, symbols[k]))
            if found:
                heapq.heappush(heap, (found[0], i, whole, symbols[k], found[1]))
        h = prior[i]
        if h >= 0:
            found = merges.get((symbols[h], whole))
            if found:
                heapq.heappush(heap, (found[0], h, symbols[h], whole, found[1]))
    return done


@lru_cache(2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def token_counts(docs, path: str = TOKENIZER, limit: int = LIMIT):
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""
    T.prepare(docs.sparkSession)

    def count(batches):
        table = merge_table(path)
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                column = part.column("text")
                known, index, offs = T.chunks(column)
                each = np.fromiter(map(table.chunk, known), np.int64, len(known))
                n = T.row_sums(each[index], offs)
                size = pc.binary_length(column).cast(pa.int64()).fill_null(0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), size, pa.array(n), pa.array(n > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
