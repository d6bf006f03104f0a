"""Arrow helpers that run inside tasks: cut batches into bounded blocks of text
and split whole texts into words without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 8 << 20


def _table(keep_alnum_only: bool, lower: bool) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    for code in range(128):
        char = chr(code)
        if keep_alnum_only and not char.isalnum():
            table[code] = 0x20
        if lower and char.isupper():
            table[code] = code + 32
    return table


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: digits, letters, everything beyond ASCII.
ALNUM = _table(True, True)
#: ``[^\x20\x09-\x0D]+`` after lower-casing A-Z / as it stands.
SPACED_LOWER = _table(False, True)
SPACED = _table(False, False)


def strings(column: pa.Array) -> pa.StringArray:
    """A string array with 32-bit offsets starting at 0; null becomes the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def raw(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of a string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None:
        return np.zeros(len(texts) + 1, np.int32), np.zeros(0, np.uint8)
    return offsets - offsets[0], np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]


def from_raw(offsets: np.ndarray, data: np.ndarray) -> pa.StringArray:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)),
                                       pa.py_buffer(np.ascontiguousarray(data)))


def recode(texts: pa.StringArray, table: np.ndarray) -> pa.StringArray:
    """Every byte through ``table`` (only ASCII bytes change, so UTF-8 stays valid)."""
    offsets, data = raw(texts)
    return from_raw(offsets, table[data])


def words(texts: pa.StringArray, table: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """All words of all texts, and the offsets of each text's words."""
    split = pc.ascii_split_whitespace(recode(texts, table))
    flat, offsets = split.values, split.offsets.to_numpy()
    filled = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    return flat.filter(filled), before[offsets]


def blocks(batch: pa.RecordBatch, text_column: int, max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch holding about ``max_bytes`` of text (one row at least)."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_numpy(zero_copy_only=False),
                     dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
        yield batch.slice(first, last - first)
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), element-wise."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, np.ndarray] = {}
_CHUNK = 1 << 16


def _powers(n: int) -> np.ndarray:
    size = max(_CHUNK, 1 << max(n - 1, 1).bit_length())
    if size not in _POWERS:
        _POWERS[size] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _BASE, np.uint64)]), dtype=np.uint64)
    return _POWERS[size]


def hashes(strs: pa.StringArray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each string: a polynomial over random byte values, mixed
    with the length.  Computed from prefix sums, block by block."""
    offsets, data = raw(strs)
    n = len(strs)
    out = np.empty(n, np.uint64)
    values = _byte_values(seed)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _CHUNK, side="right")) - 1)
        part = data[offsets[first]:offsets[last]]
        power = _powers(len(part))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values[part] * power[:len(part)], dtype=np.uint64)])
        at = (offsets[first:last + 1] - offsets[first]).astype(np.int64)
        length = (at[1:] - at[:-1]).astype(np.uint64)
        # shift every string to the same power: the sum times base ** (len(part) - start)
        out[first:last] = mix((sums[at[1:]] - sums[at[:-1]]) * power[len(part) - at[:-1]]
                              * _power_inverse(len(part)) + length)
        first = last
    return out


_INVERSES: dict[int, np.uint64] = {}


def _power_inverse(n: int) -> np.uint64:
    if n not in _INVERSES:
        if len(_INVERSES) > 100_000:
            _INVERSES.clear()
        _INVERSES[n] = np.uint64(pow(pow(_BASE, n, 1 << 64), -1, 1 << 64))
    return _INVERSES[n]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + l)`` over all pairs."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 1 << 31 and (not len(starts) or int(starts.max()) < 1 << 31) else np.int64
    out = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out
