"""Text columns of Arrow batches as byte arrays, and their words as 64-bit hashes.

All work here is on whole arrays: a word costs a few vector operations, not a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Arrays made for a run of rows take about a hundred times its text; longer texts run alone.
RUN_BYTES = 1 << 19

# Word characters of the contract: ASCII letters and digits, and everything beyond ASCII,
# which in UTF-8 is exactly the bytes from 0x80 on. Capitals A-Z count as a-z.
_CODES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
IS_WORD = (
    ((_CODES >= 48) & (_CODES <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_CODES >= 128)
)

_STEP = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: well spread values for any distinct inputs."""
    x = np.asarray(x, dtype=np.uint64) + _STEP
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(_CODES.astype(np.uint64))
_LOWER_VALUE = _BYTE_VALUE[LOWER]
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, RUN_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"]


class Text(NamedTuple):
    """A run of rows: their bytes one after the other, and where each row begins and ends."""

    data: np.ndarray
    edges: np.ndarray  # n + 1 offsets into data
    first: int  # number of the first row within the batch

    @property
    def rows(self) -> int:
        return len(self.edges) - 1


def text_runs(column: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[Text]:
    """The rows of a string column in runs of at most ``run_bytes``, or of one longer row.
    A null is a row without bytes."""
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = int(np.searchsorted(edges, edges[begin] + run_bytes, side="right")) - 1
        end = min(max(end, begin + 1), n)
        low, high = edges[begin], edges[end]
        yield Text(data[low:high], edges[begin : end + 1] - low, begin)
        begin = end


class Words(NamedTuple):
    """Words of a run in order: row number in the run, byte range, hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray

    def per_row(self, rows: int) -> np.ndarray:
        """Where each row's words begin: rows + 1 positions."""
        return np.searchsorted(self.row, np.arange(rows + 1))


def word_spans(
    text: Text, is_word: np.ndarray = IS_WORD
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and end of every word; a word never crosses from row to row."""
    inside = is_word[text.data]
    if not inside.any():
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    at_edge = np.zeros(len(inside) + 1, dtype=bool)
    at_edge[text.edges] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | at_edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | at_edge[1:-1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    row = np.searchsorted(text.edges, start, side="right") - 1
    return row, start, end


def range_hashes(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True
) -> np.ndarray:
    """A 64-bit hash of each byte range, equal for equal bytes wherever they stand."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER_VALUE if lower else _BYTE_VALUE)[data] * up[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def words_of(text: Text) -> Words:
    row, start, end = word_spans(text)
    return Words(row, start, end, range_hashes(text.data, start, end))


def window_hashes(key: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive words, rows not regarded; len - width + 1 values."""
    n = len(key) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = key[:n].astype(np.uint64)
    for i in range(1, width):
        total = total * np.uint64(_BASE) + key[i : i + n]
    return mix(total)
