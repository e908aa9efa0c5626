"""Vectorised text primitives shared by the operators of this subpackage.

Everything works on the UTF-8 bytes of an Arrow string column at once, so no
Python object is made per word.  A word is a maximal run of bytes other than
space and ``\\t \\n \\v \\f \\r`` (pattern ``[^\\x20\\x09-\\x0D]+``); letters
A-Z may be folded to a-z.  Nulls count as empty texts.

Hashes are 64-bit.  A span's hash sums avalanche mixes of its 8-byte words, each
mixed with its place, and mixes the sum with the length, so that no structure of
a text (unlike in a polynomial modulo 2**64) makes hashes equal; an n-word
shingle's hash is a mixed linear combination of its words' hashes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_SHINGLE_WEIGHTS = np.array(
    [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
     0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3],
    dtype=_U,
)

def trim() -> None:
    """Give freed memory back to the system; called when a task's input ends, since workers live on."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche of each 64-bit value (a bijection)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the n + 1 offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(
            b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
        )
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        column.offset : column.offset + len(column) + 1
    ].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array, most: int = 1_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into (first row, end row, bytes, offsets) of about ``most`` bytes; a longer text stands alone."""
    data, offsets = column_bytes(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


#: Bytes of a long text that are worked through at once.
SLICE = 1 << 22


def blank_cuts(data: np.ndarray, most: int | None = None) -> list[int]:
    """Cuts of one text behind blanks, 0 and its size included, about ``most`` bytes apart where there are blanks."""
    most, cuts = most or SLICE, [0]
    while len(data) - cuts[-1] > most:
        at = cuts[-1] + most
        for reach in (4096, len(data)):
            blank = np.flatnonzero(data[at : at + reach] == 32)
            if len(blank):
                break
        else:
            break
        cuts.append(at + 1 + int(blank[0]))
    return cuts if cuts[-1] == len(data) else [*cuts, len(data)]


def fold_ascii(data: np.ndarray) -> np.ndarray:
    """A copy in which A-Z are a-z."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (n + 1 values)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    before, after = inside[:-1], inside[1:]
    start = after & ~before
    end = before & ~after
    cuts = offsets[1:-1]
    joined = cuts[inside[cuts] & inside[cuts + 1]] if len(cuts) else cuts  # a text ends and the next begins inside a run
    start[joined] = True
    end[joined] = True
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    return starts, ends, np.searchsorted(starts, offsets, side="left")


_KEPT = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], _U)  # the first k bytes of a word


def span_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each span as 8-byte little-endian words, the last one filled with zeros, and the index of each span's first (n + 1 values)."""
    size = ends - starts
    number = (size + 7) >> 3
    begin = np.concatenate((np.zeros(1, np.int64), np.cumsum(number)))
    padded = np.empty(len(data) + 8, np.uint8)
    padded[:-8], padded[-8:] = data, 0
    anywhere = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    if begin[-1] == len(size) and len(size) and number.min() == 1:  # one word each
        return anywhere[starts] & _KEPT[size], begin
    words = anywhere[np.repeat(starts - 8 * begin[:-1], number) + 8 * np.arange(begin[-1])]
    last = number > 0
    words[begin[1:][last] - 1] &= _KEPT[(size[last] - 1 & 7) + 1]
    return words, begin


def hash_words(words: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of spans from their words (``span_words``) and sizes in bytes."""
    place = np.arange(len(words)) - np.repeat(begin[:-1], np.diff(begin))
    mixed = mix64(mix64(words) + place.astype(_U) * _U(0x9E3779B97F4A7C15))
    sums = np.concatenate((np.zeros(1, _U), np.cumsum(mixed)))
    return mix64((sums[begin[1:]] - sums[begin[:-1]]) ^ (size.astype(_U) * _U(0xA0761D6478BD642F)))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    return hash_words(*span_words(data, starts, ends), ends - starts)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of lower-cased texts, and for each text the index of its first word (n + 1 values).  A long text is worked through in slices."""
    if len(offsets) == 2 and len(data) > SLICE:
        cuts, parts = blank_cuts(data), []
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = fold_ascii(data[a:b])
            parts.append(span_hashes(part, *word_bounds(part, np.array([0, b - a]))[:2]))
        words = np.concatenate(parts)
        return words, np.array([0, len(words)])
    data = fold_ascii(data)
    starts, ends, first = word_bounds(data, offsets)
    return span_hashes(data, starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word shingles, text by text, and for each text the index of its first (n + 1 values).

    A text with fewer words has one shingle, its whole sequence; one without words has none.
    """
    counts = np.diff(first)
    total = np.zeros(len(words), _U)
    for k in range(min(n, len(words))):
        total[: len(words) - k] += words[k:] * _SHINGLE_WEIGHTS[k]
    if len(counts) == 1 and counts[0] >= n:  # one text: no index needed
        return mix64(total[: counts[0] - n + 1]), np.array([0, counts[0] - n + 1])
    full = np.maximum(counts - n + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < n))
    number = full.copy()
    number[short] = 1
    begin = np.concatenate(([0], np.cumsum(number)))
    out = np.empty(begin[-1], _U)
    where = np.repeat(first[:-1] - begin[:-1], number) + np.arange(begin[-1])
    out[:] = total[where] if len(words) else 0
    for t in short:
        own = words[first[t] : first[t + 1]]
        out[begin[t]] = int(
            (own * _SHINGLE_WEIGHTS[: len(own)]).sum(dtype=_U)
        ) + len(own) * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF
    return mix64(out), begin


def distinct_by_text(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, and for each text the index of its first."""
    values = values.copy()
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[begin[:-1][np.diff(begin) > 0]] = True
    return values[keep], np.concatenate(([0], np.cumsum(keep)))[begin]


def word_shingles(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the n-word shingles of lower-cased texts, ascending in each text."""
    return distinct_by_text(*shingle_hashes(*word_hashes(data, offsets), n))
