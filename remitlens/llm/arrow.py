"""Texts of Arrow batches as byte arrays, for the operators that work on them with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a step of the byte operators takes at a time; a longer text is a step of its own.
STEP_BYTES = 1 << 20

_CODES = np.arange(256)
#: Lower case for A-Z, and bytes that belong to words (ASCII letters and digits, and all of every other character).
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
ALNUM = ((_CODES >= 48) & (_CODES <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_CODES >= 128)
#: Bytes of words that white space separates.
SPACED = ~((_CODES == 32) | ((_CODES >= 9) & (_CODES <= 13)))

_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and where each row begins (one more entry than rows). Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def steps(at: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes, or a single row."""
    row, rows = 0, len(at) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield row, end
        row = end


def words(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end, and first word of each row (one more entry than rows). ``at`` begins at 0."""
    inside = kind[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = at[(at > 0) & (at < len(data))]
    before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def powers(n: int, base: int) -> np.ndarray:
    """``base`` to 0, 1, ..., n - 1 and up to twice as many, modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        grown = np.full(1 << max(n - 1, 0).bit_length(), base, np.uint64)
        grown[0] = 1
        have = np.multiply.accumulate(grown)
        if n <= 4 * STEP_BYTES:
            _POWERS[base] = have
    return have


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = values ^ (values >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of ``values``: differences of one running polynomial sum, shifted to the same power."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(n, _BASE)[:n], out=total[1:])
    return mixed((total[ends] - total[starts]) * powers(n + 1, _INVERSE)[starts])


def lists(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def appended(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *new.values()], names=[*batch.schema.names, *new])
