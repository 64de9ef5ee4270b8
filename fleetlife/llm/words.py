"""Words of whole Arrow text columns as 64-bit numbers, a few passes of numpy over the bytes.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return. All of them are single bytes in UTF-8, so no decoding is needed.
Two different words or shingles get the same 64-bit number with a chance near 2^-64 a pair.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer document is worked on alone.
CHUNK = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_random = np.random.Generator(np.random.PCG64(20240607))
BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE[SPACE] = 0
LOWER = BYTE.copy()
LOWER[65:91] = LOWER[97:123]
#: Bytes between words where only letters and digits matter; all of UTF-8 beyond ASCII counts as letters.
MARKS = np.ones(256, bool)
MARKS[48:58] = MARKS[65:91] = MARKS[97:123] = MARKS[128:] = False
PLAIN = np.where(MARKS, np.uint64(0), LOWER)
STEP = np.uint64(0x9E3779B97F4A7C15)
PLACES = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 4096), STEP, np.uint64)]))
    return _powers


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets into them) of rows of about CHUNK bytes. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        # A null may have bytes of its own below it: such columns are copied without them.
        column = pa.array(["" if v is None else v for v in column.to_pylist()], column.type)
        yield from chunks(column)
        return
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK, "right")) - 1)
        last = min(last, n)
        yield first, last, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each word, its end, index of each row's first word and one past the last row's)."""
    inside = ~between[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = False, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, starts, ends, rows' first words). fold: A-Z count as a-z. plain: that, and
    words are runs of letters and digits."""
    starts, ends, first = word_bounds(data, offsets, MARKS if plain else SPACE)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends, first
    lead = int(starts[0])
    gaps = np.diff(np.append(starts, len(data)))
    place = np.arange(lead, len(data)) - np.repeat(starts, gaps)
    with np.errstate(over="ignore"):
        value = (PLAIN if plain else LOWER if fold else BYTE)[data[lead:]] * powers(int(gaps.max()) + 1)[place]
        sums = np.add.reduceat(value, starts - lead)
    return mix(sums + (ends - starts).astype(np.uint64)), starts, ends, first


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the last k - 1 entries are missing. Rows are not minded."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = hashes[:n] * PLACES[0]
        for j in range(1, k):
            total += hashes[j : j + n] * PLACES[j]
    return mix(total)


def whole(hashes: np.ndarray) -> np.uint64:
    """Hash of a sequence shorter than a shingle; its length is part of it."""
    with np.errstate(over="ignore"):
        return mix((hashes * PLACES[1 : len(hashes) + 1]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(hashes)) * PLACES[63])[0]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Each row's distinct k-word shingles, sorted; A-Z count as a-z."""
    hashes, _, _, first = word_hashes(data, offsets, fold=True)
    all_grams = grams(hashes, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            own = np.sort(all_grams[a : b - k + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            yield own[keep]
        elif b > a:
            yield np.array([whole(hashes[a:b])], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


_inverse = np.ones(1, np.uint64)


def stretch_hashes(hashes: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each stretch of ``size`` words from word ``at`` on, equal wherever the words are equal."""
    global _inverse
    n = len(hashes)
    if len(_inverse) < n:
        back = pow(int(STEP), -1, 1 << 64)
        _inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 4096), back, np.uint64)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers(n)[:n])])
    return mix((sums[at + size] - sums[at]) * _inverse[at] + size.astype(np.uint64))


def text_words(text: str) -> list[int]:
    """Hashes of one text's plain words."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]), plain=True)[0].tolist()
