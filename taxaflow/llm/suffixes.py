"""Array code for repeated byte strings: rolling hashes, anchors, and hash-compared suffix sorting.

Every string of WINDOW bytes has one anchor: the GRAM-byte string in it with the least hash, the leftmost of equal
ones.  Equal windows have equal anchors at equal places, so only windows around equal anchors need comparing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from taxaflow.llm.wordsets import MULTIPLIER, mix

WINDOW = 50
GRAM = 25
SPAN = WINDOW - GRAM + 1  # grams in a window
_PLACE = np.uint64((1 << 24) - 1)  # low bits of a sort key hold the place in the buffer
BUFFER = 1 << 21  # bytes looked at in one pass

_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the ``length``-byte strings at every place, by doubling."""
    out, done, step, own = None, 0, 1, _BYTES[data]
    rest = length
    while True:
        factor = np.uint64(pow(int(MULTIPLIER), step, 1 << 64))
        if rest & 1:
            if out is None:
                out, done = own, step
            else:
                size = max(len(data) - done - step + 1, 0)
                out = out[:size] * factor + own[done:done + size]
                done += step
        rest >>= 1
        if not rest:
            return mix(out)
        size = max(len(data) - 2 * step + 1, 0)
        own = own[:size] * factor + own[step:step + size]
        step *= 2


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    step, out = 1, values
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    more = width - step
    return np.minimum(out[: len(out) - more], out[more:]) if more else out


@dataclass
class Runs:
    """Runs of windows with one anchor: document (row), first window, number of windows, anchor place and hash.

    Places are in the document.
    """

    row: np.ndarray
    start: np.ndarray
    count: np.ndarray
    place: np.ndarray
    anchor: np.ndarray


def anchor_runs(texts: list[bytes]) -> Runs:
    """All runs of all documents; documents are cut into overlapping buffers, so memory does not follow their length."""
    parts: list[tuple[np.ndarray, ...]] = []
    batch: list[tuple[int, int, bytes]] = []
    size = 0
    step = BUFFER - WINDOW + 1
    for row, text in enumerate(texts):
        for begin in range(0, max(len(text) - WINDOW + 1, 0), step):
            piece = text[begin:begin + BUFFER]
            if size + len(piece) > BUFFER:
                parts.append(_runs_of(batch))
                batch, size = [], 0
            batch.append((row, begin, piece))
            size += len(piece)
    if batch:
        parts.append(_runs_of(batch))
    if not parts:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, np.zeros(0, np.uint64))
    return Runs(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _runs_of(batch: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(piece for _, _, piece in batch), np.uint8)
    lengths = np.array([len(piece) for _, _, piece in batch])
    ends = np.cumsum(lengths)
    grams = gram_hashes(data, GRAM)
    keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    least = window_minima(keys, SPAN)
    # Windows that cross the end of a piece are none; they part the runs.
    crossing = (ends[:-1, None] - np.arange(1, WINDOW)[None, :]).ravel() if len(ends) > 1 else np.zeros(0, np.int64)
    least[crossing] = ~np.uint64(0)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    count = np.diff(np.concatenate([first, [len(least)]]))
    whole = least[first] != ~np.uint64(0)
    first, count = first[whole], count[whole]
    place = (least[first] & _PLACE).astype(np.int64)
    piece = np.searchsorted(ends, first, side="right")
    shift = np.array([begin for _, begin, _ in batch])[piece] - (ends - lengths)[piece]
    row = np.array([row for row, _, _ in batch])[piece]
    return row, first + shift, count, place + shift, grams[place]


def contexts(texts: list[bytes], runs: Runs) -> np.ndarray:
    """The bytes that a run's windows can cover, as a row of SPAN - 1 + WINDOW bytes with the anchor at SPAN - 1.

    Bytes outside the run's windows are zero: they take no part.
    """
    width = SPAN - 1 + WINDOW
    out = np.zeros((len(runs.row), width), np.uint8)
    data = np.frombuffer(b"".join(texts) + bytes(width), np.uint8)
    begin = np.cumsum([0] + [len(t) for t in texts])[:-1]
    left = runs.start - runs.place + SPAN - 1  # where the first window starts in the row
    size = runs.count + WINDOW - 1
    at = begin[runs.row] + runs.start if len(runs.row) else np.zeros(0, np.int64)
    for low in range(0, len(out), 1 << 16):  # bounded helper arrays
        part = slice(low, low + (1 << 16))
        column = np.arange(width)[None, :] - left[part, None]
        inside = (column >= 0) & (column < size[part, None])
        out[part] = np.where(inside, data[np.where(inside, at[part, None] + column, 0)], 0)
    return out


class HashedSuffixes:
    """Strings in the rows of a byte matrix, with polynomial prefix hashes: any two are compared in a few steps."""

    def __init__(self, strings: np.ndarray) -> None:
        self.strings = strings
        self.width = strings.shape[1]
        self.prefix = np.zeros((len(strings), self.width + 1), np.uint64)
        for k in range(self.width):
            self.prefix[:, k + 1] = self.prefix[:, k] * MULTIPLIER + _BYTES[strings[:, k]]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of rows a and b: binary search over prefix hashes, then the bytes verify it."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.width)
        while True:
            open_ = low < high
            if not open_.any():
                break
            middle = (low + high + 1) // 2
            equal = self.prefix[a, middle] == self.prefix[b, middle]
            low = np.where(open_ & equal, middle, low)
            high = np.where(open_ & ~equal, middle - 1, high)
        return low

    def verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``common`` where the bytes bear the hashes out, else the true length (a collision)."""
        length = self.common(a, b)
        for begin in range(0, len(a), 1 << 16):
            part = slice(begin, begin + (1 << 16))
            differ = self.strings[a[part]] != self.strings[b[part]]
            true = np.where(differ.any(axis=1), differ.argmax(axis=1), self.width)
            length[part] = np.minimum(length[part], true)
        return length

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether row a sorts before row b."""
        length = self.common(a, b)
        inside = np.minimum(length, self.width - 1)
        return (length < self.width) & (self.strings[a, inside] < self.strings[b, inside])

    def sort_groups(self, group: np.ndarray) -> np.ndarray:
        """Order of the rows by (group, string): a bottom-up mergesort inside each group of equal ``group`` numbers.

        ``group`` is sorted.  Each level merges neighbouring runs by finding every row's rank in the other run with a
        binary search of hashed comparisons; levels end when the largest group is one run.
        """
        order = np.arange(len(group))
        if not len(group):
            return order
        begin = np.searchsorted(group, group)
        size = np.searchsorted(group, group, side="right") - begin
        most, run = int(size.max()), 1
        while run < most:
            at = np.flatnonzero(size > run)  # places in groups that still have two runs
            inner = at - begin[at]
            own = inner // run
            other = own ^ 1
            low = np.minimum(other * run, size[at])
            first = low.copy()
            high = np.minimum((other + 1) * run, size[at])
            left = own < other  # equal rows of the left run go first
            mine = order[at]
            while (open_ := low < high).any():
                middle = (low + high) // 2
                k = np.flatnonzero(open_)
                there = order[begin[at[k]] + middle[k]]
                ahead = np.where(left[k], self.less(there, mine[k]), ~self.less(mine[k], there))
                low[k] = np.where(ahead, middle[k] + 1, low[k])
                high[k] = np.where(ahead, high[k], middle[k])
            rank = np.minimum(own, other) * run + (inner - own * run) + (low - first)
            merged = order.copy()
            merged[begin[at] + rank] = mine
            order = merged
            run *= 2
        return order
