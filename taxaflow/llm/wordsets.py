"""Word shingles of many texts at once, as arrays of 64-bit hashes.

Texts are joined to one byte buffer; words, shingles and sets are then found with
array operations.  Memory follows the bytes of the texts given in one call.
"""

from __future__ import annotations

import numpy as np

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd, so that every power is invertible

# The bytes that part words, x20 and x09 to x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """A well spread 64-bit value for each 64-bit value (a bijection)."""
    values = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    values ^= values >> np.uint64(31)
    return values


INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))


def powers(base: np.uint64, count: int) -> np.ndarray:
    """base ** 0 .. count - 1, modulo 2 ** 64."""
    out = np.full(max(count, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span, by polynomial prefix sums."""
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mix(np.arange(256, dtype=np.uint64))[data] * powers(MULTIPLIER, len(data)), out=prefix[1:])
    # Powers rise along the buffer: scale each span as if it began at its start.
    raw = (prefix[ends] - prefix[starts]) * powers(INVERSE, len(data) + 1)[starts]
    return mix(raw ^ mix((ends - starts).astype(np.uint64)))


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text.

    A-Z are lower-cased; words are parted by x20 and x09 to x0D. None has no words.
    """
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    lengths = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    data = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
    gap = _SPACE[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(data) and not gap[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    bounds = np.cumsum(lengths)
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], bounds])))
    return span_hashes(data, starts, ends), counts


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the ``width``-word shingles of each text, one after another, and
    the size of each set.  A text of fewer words has its whole sequence as one shingle; a text
    without words has an empty set."""
    words, counts = words_of(texts)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    place = np.arange(len(words)) - first[owner]
    length = np.minimum(counts, width)[owner]
    keep = place + length <= counts[owner]
    at, length, owner = np.flatnonzero(keep), length[keep], owner[keep]
    hashes = mix(length.astype(np.uint64))
    for step in range(width):
        more = length > step
        hashes[more] = mix(hashes[more] * MULTIPLIER + words[at[more] + step])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(counts))
