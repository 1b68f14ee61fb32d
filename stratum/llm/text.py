"""Word and chunk splitting of whole Arrow text columns, vectorised on bytes.

All helpers take one Arrow string column (null counts as empty) and work on
its UTF-8 buffer, so a task's memory is a small multiple of one Arrow batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stratum.llm import storage

WHITE = np.zeros(256, bool)          # \x20 and \x09-\x0D
WHITE[[32, 9, 10, 11, 12, 13]] = True
LETTER = np.zeros(256, bool)         # A-Z a-z
LETTER[65:91] = LETTER[97:123] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BATCH_ROWS = 1024
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch (texts are long), and let workers
    import this package."""
    if int(spark.conf.get(_ROWS)) != rows:
        spark.conf.set(_ROWS, str(rows))
    storage.ship_package(spark)


def split_batch(batch: pa.RecordBatch, column: str, limit: int = 8 << 20):
    """Slices of a batch with about ``limit`` bytes of text each (one row at
    least), so temporary arrays stay small whatever the texts' lengths."""
    lens = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    if not len(lens):
        return
    part = (np.cumsum(lens) - lens) // limit
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for a, b in zip(cuts, [*cuts[1:], len(lens)]):
        yield batch.slice(a, b - a)


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null rows are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8).copy() if n else np.zeros(1, np.int64)
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def pieces(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The binary array of ``data`` cut at ``starts`` (the first is 0)."""
    offs = np.r_[starts, len(data)].astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offs), pa.py_buffer(data)])


def distinct(array: pa.Array) -> tuple[list, np.ndarray]:
    """(distinct values as bytes, index of each row's value)."""
    if not len(array):
        return [], np.zeros(0, np.int64)
    d = array.dictionary_encode()
    return d.dictionary.to_pylist(), d.indices.to_numpy().astype(np.int64)


def words(column, lower: bool = False):
    r"""Words ``[^\x20\x09-\x0D]+``: (distinct words, word index in order, row
    offsets into it)."""
    data, offs = buffers(column)
    if lower:
        data = LOWER[data]
    solid = ~WHITE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cuts = offs[:-1][offs[:-1] < len(data)]
    first[cuts] = solid[cuts]
    where = np.flatnonzero(first)
    compact = data[solid]
    at = (np.cumsum(solid) - solid)[where] if len(where) else where
    known, index = distinct(pieces(compact, at))
    return known, index, np.searchsorted(where, offs)


def chunks(column):
    r"""Cut texts where every match of the GPT-2 pattern also ends.

    A space whose neighbours are not white space starts a match, as does an
    ASCII non-letter after an ASCII letter (but ``|``, which special strings
    hold); no match spans such a cut and none looks behind itself.  So the
    tokens of a text are those of its chunks in order.  Returns (distinct
    chunks, chunk index in order, row offsets into it)."""
    data, offs = buffers(column)
    if not len(data):
        return [], np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    cut = np.zeros(len(data), bool)
    before, here = data[:-1], data[1:]
    cut[1:] = LETTER[before] & (here < 128) & ~LETTER[here] & (here != 124)
    space = np.flatnonzero(here[:-1] == 32) + 1      # a space with both neighbours
    left, right = data[space - 1], data[space + 1]
    fine = (left > 32) & ~WHITE[right]
    wide = left >= 128                               # may end a wide white space
    two, three = data[np.maximum(space - 2, 0)], data[np.maximum(space - 3, 0)]
    fine &= ~(wide & (((two == 0xC2) & ((left == 0x85) | (left == 0xA0))) | ((three >= 0xE1) & (three <= 0xE3))))
    cut[space] |= fine
    spaces = (here == 32) & LETTER[before]
    cut[1:][spaces & WHITE[data[np.minimum(np.arange(2, len(data) + 1), len(data) - 1)]]] = True
    cut[offs[:-1][offs[:-1] < len(data)]] = True
    where = np.flatnonzero(cut)
    known, index = distinct(pieces(data, where))
    return known, index, np.searchsorted(where, offs)


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``offsets``."""
    total = np.r_[0, np.cumsum(values)]
    return total[offsets[1:]] - total[offsets[:-1]]


def ragged_take(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[s:s + n]`` for each (s, n)."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return flat[:0]
    return flat[np.arange(total) + np.repeat(starts - (ends - lens), lens)]
