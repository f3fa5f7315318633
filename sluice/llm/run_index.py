"""A run-compressed Burrows-Wheeler index of short passages, and the matching statistics it gives for them."""

from __future__ import annotations

import numpy as np

from sluice.llm import flat


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` symbols or more, by prefix doubling; symbols are below 512."""
    n, step = len(text), 7
    padded = np.concatenate([text.astype(np.uint64), np.zeros(step, np.uint64)])
    key = np.zeros(n, np.uint64)
    for k in range(step):
        key = (key << np.uint64(9)) | padded[k : k + n]
    order = np.argsort(key)
    while True:
        sorted_key = key[order]
        new = np.ones(n, bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        names = np.cumsum(new)
        if names[-1] == n or step >= depth:
            return order
        rank = np.zeros(n + step, np.uint64)
        rank[order] = names
        key = (rank[:n] << np.uint64(32)) | rank[step : step + n]
        order = np.argsort(key)
        step *= 2


def common_prefix(sums: np.ndarray, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of what stands at both places, `most` at most, by binary search over hashes of ranges."""
    low, high = np.zeros(len(left), np.int64), most.astype(np.int64)
    while (open_ := low < high).any():
        middle = (low + high + 1) >> 1
        same = flat.range_hash(sums, left, left + middle) == flat.range_hash(sums, right, right + middle)
        low = np.where(open_ & same, middle, low)
        high = np.where(open_ & ~same, middle - 1, high)
    return low


def matching_statistics(passages: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the passages in a row: the longest string from there that also starts elsewhere in them.

    Suffixes are sorted, the transform is cut into runs of one symbol, and only suffixes at run ends keep a sample: their
    place and how far they agree with the suffix beyond the end. Between two samples, in text order, that length falls
    by one a byte, so one pass over the text reads all statistics off the samples. Strings do not cross passages.
    Also returns where each passage begins.
    """
    sizes = np.array([len(p) for p in passages])
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    n = int(begin[-1])
    text = np.zeros(n, np.uint16)
    inside = np.ones(n, bool)
    inside[begin[1:] - 1] = False
    raw = np.frombuffer(b"".join(passages), np.uint8)
    text[inside] = raw.astype(np.uint16) + 1
    order = suffix_order(text, int(sizes.max()) + 1)
    before = np.empty(n, np.int64)
    before[1:] = text[:-1]
    before[begin[:-1]] = -1 - np.arange(len(passages))
    transform = before[order]
    change = np.flatnonzero(transform[1:] != transform[:-1])
    heads, tails = change + 1, change
    left = np.repeat(begin[1:] - 1, sizes + 1) - np.arange(n)
    as_bytes = np.zeros(n, np.uint8)
    as_bytes[inside] = raw
    sums = flat.prefix_hash(as_bytes, flat.BYTES)
    best = np.zeros(n, np.int64)
    for own, other in ((heads, heads - 1), (tails, tails + 1)):
        place, beyond = order[own], order[other]
        length = common_prefix(sums, place, beyond, np.minimum(left[place], left[beyond]))
        sample = np.full(n, -n, np.int64)
        sample[place] = length + place
        known = np.zeros(n, np.int64)
        known[place] = place
        nearest = np.maximum.accumulate(known)
        np.maximum(best, sample[nearest] - np.arange(n), out=best)
    return best, begin
