"""Whole texts of an Arrow batch as one byte array, with words and hashes found by numpy.

A batch is handled in slices of whole rows of about `SLICE` bytes, so memory follows the slice and the longest
text, not the batch. All hashes are 64-bit sums over a fixed random table, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 17
U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
UNBASE = U(pow(int(BASE), -1, 1 << 64))


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**64, 256, dtype=np.uint64) | U(1)


BYTES = _table(11)
FOLDED = BYTES.copy()
FOLDED[65:91] = BYTES[97:123]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: All ASCII but letters and digits.
MARKS = np.zeros(256, bool)
MARKS[:128] = [not chr(c).isalnum() for c in range(128)]
PLACES = _table(12)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i below n, kept between slices."""
    if len(_powers.get("up", ())) < n:
        n = max(n, SLICE + 4096)
        for name, base in (("up", BASE), ("down", UNBASE)):
            with np.errstate(over="ignore"):
                _powers[name] = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, base)]).astype(U), dtype=U)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins and the last ends; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    at = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    all_bytes = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return all_bytes[at[0] : at[-1]], at - at[0]


def slices(at: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `most` bytes each, a longer row alone."""
    first, rows = 0, len(at) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


def prefix_hash(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums that give the hash of any range by `range_hash`."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum(table[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of bytes [first, last) for each pair; equal bytes give equal hashes wherever they stand."""
    return mix((sums[last] - sums[first]) * powers(len(sums))[1][first])


def words(data: np.ndarray, at: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and row of every word, a word being bytes that are not `between` words, ASCII white space at first."""
    solid = ~between[data]
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    starts[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return first, last, np.searchsorted(at, first, "right") - 1


def word_hashes(data: np.ndarray, at: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with A-Z lower-cased, and its row."""
    first, last, row = words(data, at, between)
    return range_hash(prefix_hash(data, FOLDED), first, last), row


def shingles(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of `width` words of each row, ascending within the row, and where each row's begin.

    A row with fewer words has all of them as one shingle; one without words has none.
    """
    word, row = word_hashes(data, at)
    rows, n = len(at) - 1, len(word)
    count = np.bincount(row, minlength=rows)
    total = np.zeros(n, U)
    for k in range(width):
        total[: max(0, n - k)] += word[k:] * PLACES[k]
    whole = np.zeros(n, bool)
    if n >= width:
        whole[: n - width + 1] = row[: n - width + 1] == row[width - 1 :]
    key, owner = total[whole], row[whole]
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        begin = np.cumsum(count) - count
        extra = np.zeros(len(short), U)
        for k in range(width):
            has = count[short] > k
            extra[has] += word[begin[short][has] + k] * PLACES[k]
        key = np.concatenate([key, extra + PLACES[32 + count[short]]])
        owner = np.concatenate([owner, short])
    key = mix(key)
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[fresh], owner[fresh]
    return key, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])
