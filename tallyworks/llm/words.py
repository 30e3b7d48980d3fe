"""Word hashes of Arrow string columns, computed over their bytes with numpy.

A word is a maximal run of word bytes; both word classes in use hold all bytes from 0x80 on, so runs of
bytes are runs of code points. Texts are read in blocks that end between words: memory stays bounded
for texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once.
BLOCK = 1 << 20
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)

LOWER_CASE = np.arange(256, dtype=np.uint8)
LOWER_CASE[ord("A") : ord("Z") + 1] += 32
#: Digits, letters and everything outside ASCII, after lower-casing.
ALNUM = np.zeros(256, bool)
ALNUM[ord("0") : ord("9") + 1] = ALNUM[ord("a") : ord("z") + 1] = ALNUM[0x80:] = True
#: Everything but white space.
NO_SPACE = np.ones(256, bool)
NO_SPACE[[0x20, *range(0x09, 0x0E)]] = False


class Words(NamedTuple):
    hash: np.ndarray  # uint64
    row: np.ndarray  # int64, ascending
    start: np.ndarray  # byte offsets in the data
    end: np.ndarray
    data: np.ndarray  # lower-cased bytes
    prefix: np.ndarray  # uint64, a column for each prefix length asked for


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers of the step; those for a block are kept, those for a longer word are not."""
    usual = BLOCK + (1 << 12)
    if n > usual or kind not in _powers:
        have = np.full(max(n, usual), _STEP if kind == "step" else _BACK, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n > usual:
            return have
        _powers[kind] = have
    return _powers[kind][:n]


def words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, prefixes: tuple[int, ...] = ()) -> Words:
    """All words in order; ``prefixes`` asks for hashes of so many first bytes of each as well."""
    data = LOWER_CASE[data]
    size = len(data)
    hashes, starts, ends, firsts = [], [], [], []
    low = 0
    while low < size:
        high = min(size, low + BLOCK)
        if high < size:
            high = _between_words(data, offsets, word_bytes, low, high)
        block = data[low:high]
        inside = word_bytes[block]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edges = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high)] - low
        first[edges] = inside[edges]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edges = edges[edges > 0] - 1
        last[edges] = inside[edges]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((block + np.uint64(1)) * _power("step", len(block)), out=total[1:])
        before, back = total[start], _power("back", len(block) + 1)[start]
        hashes.append(mix((total[end] - before) * back))
        if prefixes:
            firsts.append(np.stack([mix((total[np.minimum(end, start + n)] - before) * back + np.uint64(n)) for n in prefixes], 1))
        starts.append(start + low)
        ends.append(end + low)
        low = high
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    start = join(starts, np.int64)
    row = np.searchsorted(offsets, start, "right") - 1
    first = np.concatenate(firsts) if firsts else np.empty((len(start), len(prefixes)), np.uint64)
    return Words(join(hashes, np.uint64), row, start, join(ends, np.int64), data, first)


def _between_words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, low: int, high: int) -> int:
    """The last place up to ``high`` where no word goes on; after it, if one word fills the block."""
    k = offsets[np.searchsorted(offsets, high, "right") - 1]
    gaps = np.flatnonzero(~word_bytes[data[low:high]])
    back = max(int(k), low + int(gaps[-1]) + 1 if len(gaps) else 0)
    if back > low:
        return back
    after = int(np.searchsorted(offsets, high))
    end = int(offsets[after]) if after < len(offsets) else len(data)
    while high < end:
        step = min(end, high + BLOCK)
        gaps = np.flatnonzero(~word_bytes[data[high:step]])
        if len(gaps):
            return high + int(gaps[0])
        high = step
    return high


def code_points(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Byte places in ``data`` as code points from the start of their ``row``, in one pass over the bytes."""
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return before[places] - before[offsets[row]]


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n words in a row, wherever they lie; empty if there are fewer."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out *= np.uint64(_STEP)
        out += hashes[k : len(hashes) - n + 1 + k]
    return mix(out + np.uint64(n))


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every n-word shingle; a row of fewer words has its whole sequence as one."""
    out = runs(w.hash, n)
    same = w.row[: len(out)] == w.row[n - 1 :] if len(out) else np.empty(0, bool)
    found, rows = [out[same]], [w.row[: len(out)][same]]
    where, first, count = np.unique(w.row, return_index=True, return_counts=True)
    for m in range(1, n):
        short = count == m
        if short.any():
            found.append(runs(w.hash, m)[first[short]])
            rows.append(where[short])
    hashes, rows = np.concatenate(found), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return hashes[order], rows[order]
