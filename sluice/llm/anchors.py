"""Where equal long strings meet: every window of a text names one short gram inside it by its content alone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from sluice.llm import flat

GRAM = 32
PIECE = 1 << 22
ASIDE = flat._table(13)
PLACE_BITS = np.uint64(24)
PLACE = np.uint64((1 << 24) - 1)


def pieces(at: np.ndarray, window: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """First row, first byte and row borders of each slice; a longer text comes in overlapping parts."""
    for a, b in flat.slices(at):
        if b - a == 1 and at[b] - at[a] > PIECE:
            for first in range(int(at[a]), int(at[b]) - window + 1, PIECE - window + 1):
                yield a, first, np.array([first, min(first + PIECE, int(at[b]))])
        else:
            yield a, int(at[a]), at[a : b + 1]


def runs(data: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of window starts that name the same gram: row, first start, number, hash of the gram, of all bytes they cover.

    A window names its least gram by hash, the first of equal ones, so equal windows name the same gram at the same
    place in them.
    """
    span = window - GRAM + 1
    n = len(data) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = flat.prefix_hash(data, flat.BYTES)
    gram = flat.mix((sums[GRAM:] - sums[:-GRAM]) * flat.powers(len(sums))[1][: len(sums) - GRAM])
    rows = -(-len(gram) // span)
    padded = np.full(rows * span, np.uint64(2**64 - 1))
    key = padded[: len(gram)]
    np.bitwise_and(gram, ~PLACE, out=key)
    key |= np.arange(len(gram), dtype=np.uint64)
    padded = padded.reshape(rows, span)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    named = (np.minimum(after[:n], before[span - 1 : span - 1 + n]) & PLACE).astype(np.int64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))[:n]
    inside = np.arange(n) + window <= at[row + 1]
    new = np.ones(n, bool)
    new[1:] = (named[1:] != named[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    good = inside[first]
    first, size = first[good], size[good]
    at_named = named[first]
    covered = flat.range_hash(flat.prefix_hash(data, ASIDE), first, first + size + window - 1)
    covered = flat.mix(covered + (at_named - first).astype(np.uint64) * flat.PLACES[60] + size.astype(np.uint64) * flat.PLACES[61])
    return row[first], first, size, gram[at_named], covered
