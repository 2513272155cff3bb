"""Vectorised words, word hashes and word shingles of Arrow text columns.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, after lower-casing A-Z (other letters stay).  Texts are
handled as the UTF-8 buffer of the Arrow column, a few MB at a time, so no Python object is made per word.  A null text
counts as an empty one and has no words.

Hashes are 64-bit: a polynomial over the word's bytes (odd base, modulo 2^64), finished by a bit mixer together with
the word's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once.
CHUNK = 1 << 21
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 9, 10, 11, 12, 13]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift-multiply rounds); overwrites a copy."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK, n) + 1
    if size not in _POWERS:
        out = []
        for base in (_BASE, _INV):
            p = np.full(size, base, dtype=U)
            p[0] = 1
            out.append(np.cumprod(p, dtype=U))
        if size > CHUNK + 1:  # a rare oversized piece: not worth keeping
            return out[0], out[1]
        _POWERS[size] = (out[0], out[1])
    return _POWERS[size]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty texts."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8).copy()
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[off[0]:off[-1]]
    return raw, off - off[0]


def word_spans(raw: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of ``raw``; ``doc_starts`` are the starts of its non-empty texts."""
    inside = (raw != 0x20) & (raw - np.uint8(9) > 4)  # wraps below 9; faster than a table
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[doc_starts] = True
    edge[-1] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside
    last[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, A-Z lower-cased."""
    if not len(starts):
        return np.zeros(0, U)
    power, inverse = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, U)
    lower = raw + ((raw - np.uint8(65) < 26).view(np.uint8) << 5)  # wraps below 65; faster than a table
    values = lower.astype(U)
    values += U(1)
    values *= power[:len(raw)]
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def _pieces(raw: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Cuts one long text at separators into pieces of about ``limit`` bytes (longer only inside one giant word)."""
    at = 0
    while at < len(raw):
        end = min(at + limit, len(raw))
        while end < len(raw):
            seps = np.flatnonzero(_SEP[raw[end:end + limit]])
            if len(seps):
                end += int(seps[0])
                break
            end = min(end + limit, len(raw))
        yield raw[at:end]
        at = end


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields ``(first row, row after the last, bytes, bounds of the rows in them)`` of about ``limit`` bytes each.

    A row longer than ``limit`` comes alone, in several consecutive chunks cut at separators.
    """
    raw, off = text_buffer(column)
    row, n = 0, len(off) - 1
    while row < n:
        to = int(np.searchsorted(off, off[row] + limit, side="right")) - 1
        to = min(max(to, row + 1), n)
        part = raw[off[row]:off[to]]
        if len(part) > limit:
            for p in _pieces(part, limit):
                yield row, to, p, np.array([0, len(p)])
        else:
            yield row, to, part, off[row:to + 1] - off[row]
        row = to


def chunk_words(part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts and ends of a chunk and the number of words of each of its rows."""
    starts, ends = word_spans(part, bounds[:-1][np.diff(bounds) > 0])
    return starts, ends, np.diff(np.searchsorted(starts, bounds))


def batches(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields ``(first row, row after the last, word hashes, words per row)``, whole rows together."""
    held: list = []
    for row, to, part, bounds in chunks(column, limit):
        if held and held[0] != row:
            yield held[0], held[1], np.concatenate(held[2]), held[3]
            held = []
        starts, ends, counts = chunk_words(part, bounds)
        if not held:
            held = [row, to, [], np.zeros(to - row, np.int64)]
        held[2].append(hash_spans(part, starts, ends))
        held[3] = held[3] + counts
    if held:
        yield held[0], held[1], np.concatenate(held[2]), held[3]


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within each row, and how many each row has (repeats included).

    A row of 1 to ``width - 1`` words has its whole sequence as one shingle; a row without words has none.
    """
    n = len(counts)
    per = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    first = np.cumsum(counts) - counts
    base = U(0xC2B2AE3D27D4EB4F)
    if len(hashes) >= width:
        m = len(hashes) - width + 1
        roll = hashes[:m].copy()
        for j in range(1, width):
            roll *= base
            roll += hashes[j:m + j]
    else:
        roll = np.zeros(len(hashes), U)
    out_first = np.cumsum(per) - per
    total = int(per.sum())
    row = np.repeat(np.arange(n), per)
    pos = first[row] + (np.arange(total) - out_first[row])
    out = np.zeros(total, U)
    long = counts[row] >= width
    out[long] = roll[pos[long]]
    for r in np.flatnonzero((counts > 0) & (counts < width)):
        h = U(counts[r])
        with np.errstate(over="ignore"):
            for x in hashes[first[r]:first[r] + counts[r]]:
                h = h * U(0xA0761D6478BD642F) + x
        out[out_first[r]] = h
    return mix(out), per


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a signed long, as Spark stores them."""
    return x.view(np.int64)
