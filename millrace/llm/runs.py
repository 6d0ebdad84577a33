"""All maximal runs of word sequences, by string synchronising sets.

Many texts are worked on at once, one after the other in one array with a separator of its own between
each two, longest first, so that every scale reads a prefix of it.

Periods under ``DIRECT`` are read off by comparing the array with itself, shifted. For each dyadic scale t, periods
from 3t to 6t - 1 come from the t-synchronising set: positions whose hash of t words, or that of the place t words on,
is least among the t + 1 places from there on, leaving out places whose t words have a period of t/3 or less.
Which positions are selected depends on the 2t words from there on only, and any 3t - 1 words that are not that highly
periodic hold one among their first t. A run with such a period q that is not highly periodic over its first q words thus has a
selected position whose 2t words are the same q words on, and pairs of equal contexts propose q. If it is, its
first two periods lie in two neighbouring runs of one smaller period that touch; these runs are known from smaller
scales, and the shifts by which they match propose q. Every proposal is extended as far as it holds, over hashes of
dyadic lengths.
"""

from __future__ import annotations

import numpy as np

DIRECT = 12
MIN_LENGTH = 12
_FIRST_SCALE = 4  # scale 4 has the periods from 12 on
_MOST = np.uint64(2**64 - 1)
_HELD = 2**26  # hashes kept for extensions
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class _Hashes:
    """Hashes of every window of 1, 2, 4, ... words of the texts that are long enough."""

    def __init__(self, ids: np.ndarray, ends: list[int], lengths: np.ndarray):
        self.levels = [_mixed(ids.astype(np.uint64) * _A + _B)]
        k = 0
        while lengths[0] >= 2 ** (k + 1) and len(self.levels) * len(ids) < max(_HELD, 5 * len(ids)):
            half, end = 2**k, _prefix(ends, lengths, 2 ** (k + 1))
            below = self.levels[k][: end - half + 1]
            self.levels.append(_mixed(below[:-half] * _A + below[half:]))
            k += 1

    def window(self, k: int) -> np.ndarray:
        """Hashes of 2**k words; beyond the levels kept, of the two ends and every kept length between."""
        if k < len(self.levels):
            return self.levels[k]
        below = self.window(k - 1)
        return _mixed(below[: -(2 ** (k - 1))] * _A + below[2 ** (k - 1) :])

    def same(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """How far the words from i on (before i, if step is -1) equal those from j on; j > i."""
        extent = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, width = self.levels[k], 2**k
            while True:
                at = extent if step > 0 else -extent - width
                left, right = i + at, j + at
                fits = (left >= 0) & (right < len(level))
                equal = fits & (level[np.where(fits, left, 0)] == level[np.where(fits, right, 0)]) if len(level) else fits & False
                extent += equal * width
                if k < len(self.levels) - 1 or not equal.any():
                    break
        return extent


def _prefix(ends: list[int], lengths: np.ndarray, least: int) -> int:
    """Where the texts of at least so many words end; texts come longest first."""
    n = int(np.searchsorted(-lengths, -least, "right"))
    return ends[n - 1] if n else 0


def _distinct(starts: np.ndarray, ends: np.ndarray, periods: np.ndarray) -> Runs:
    """One run per stretch, with its least period."""
    order = np.lexsort((periods, ends, starts))
    starts, ends, periods = starts[order], ends[order], periods[order]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (starts[1:] != starts[:-1]) | (ends[1:] != ends[:-1])
    return starts[new], ends[new], periods[new]


def _short_periods(ids: np.ndarray) -> Runs:
    found = []
    for q in range(1, DIRECT):
        at = np.flatnonzero(ids[q:] == ids[:-q])
        if not len(at):
            continue
        cut = np.flatnonzero(np.diff(at) != 1)
        first, last = at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]]
        long_ones = last - first + 1 + q >= max(2 * q, _FIRST_SCALE)
        found.append((first[long_ones], last[long_ones] + 1 + q, np.full(int(long_ones.sum()), q)))
    return _joined(found)


def _joined(found: list[Runs]) -> Runs:
    if not found:
        return (np.empty(0, dtype=np.int64),) * 3
    return _distinct(*[np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True)])


def _synchronising(window: np.ndarray, scale: int, known: Runs) -> np.ndarray:
    """The selected positions of a scale."""
    starts, ends, periods = known
    periodic = (3 * periods <= scale) & (ends - starts >= scale) & (starts < len(window))
    change = np.zeros(len(window) + 1, dtype=np.int32)
    np.add.at(change, starts[periodic], 1)
    np.add.at(change, np.minimum(ends[periodic] - scale + 1, len(window)), -1)
    hashes = np.where(np.cumsum(change[:-1]) > 0, _MOST, window)
    least, width = hashes, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    here, there = hashes[: len(hashes) - scale], hashes[scale:]
    least = np.minimum(least[: len(here)], there)
    return np.flatnonzero((least != _MOST) & ((here == least) | (there == least)))


def _equal_contexts(positions: np.ndarray, contexts: np.ndarray, scale: int) -> tuple[np.ndarray, ...]:
    """(first, last, period): selected positions whose context comes again 3 to 6 scales on, neighbours joined."""
    order = np.argsort(contexts, kind="stable")
    positions, contexts = positions[order], contexts[order]
    found, periods, apart = [], [], 1
    while apart < len(positions):
        distance = positions[apart:] - positions[:-apart]
        near = (contexts[apart:] == contexts[:-apart]) & (distance < 6 * scale)
        if not near.any():
            break
        fit = near & (distance >= 3 * scale)
        found.append(positions[:-apart][fit])
        periods.append(distance[fit])
        apart += 1
    if not found:
        return (np.empty(0, dtype=np.int64),) * 3
    at, period = np.concatenate(found), np.concatenate(periods)
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    new = np.ones(len(at), dtype=bool)
    # contexts of 2 scales that overlap or touch hold the shift between them as well
    new[1:] = (period[1:] != period[:-1]) | (at[1:] - at[:-1] > 2 * scale)
    first = np.flatnonzero(new)
    return at[first], at[np.r_[first[1:], len(at)] - 1] if len(at) else at, period[first]


def _touching_runs(known: Runs, hashes: _Hashes, scale: int) -> tuple[np.ndarray, ...]:
    """(position, position, period): shifts by which a highly periodic run matches the next one of its period."""
    starts, ends, periods = known
    wanted = (3 * periods <= scale) & (ends - starts >= 3 * scale)
    starts, ends, periods = starts[wanted], ends[wanted], periods[wanted]
    order = np.lexsort((starts, periods))
    starts, ends, periods = starts[order], ends[order], periods[order]
    pairs = np.flatnonzero((periods[1:] == periods[:-1]) & (starts[1:] <= ends[:-1])) if len(starts) else []
    at, shifts = [], []
    for n in pairs:
        p, end, start = int(periods[n]), int(ends[n]), int(starts[n + 1])
        phases = np.arange(start, start + p)
        phase = phases[hashes.same(np.full(p, end - p), phases, 1) >= p]
        if not len(phase):
            continue
        most = min(int(ends[n] - starts[n]), int(ends[n + 1]) - start) + p
        shift = np.arange(int(phase[0]) - (end - p), min(most, 6 * scale - 1) + 1, p)
        shift = shift[shift >= 3 * scale]
        at.append(np.full(len(shift), end - p))
        shifts.append(shift)
    if not at:
        return (np.empty(0, dtype=np.int64),) * 3
    return np.concatenate(at), np.concatenate(at), np.concatenate(shifts)


def maximal_runs(texts: list[np.ndarray], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """For every text of word numbers (from 0 on) its maximal runs as rows (start, length, period), in that order.

    A run is a stretch of at least ``max(min_length, 2 * period)`` words with that least period that cannot
    be extended; ``min_length`` is 4 at least.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] >= min_length]
    empty = np.empty((0, 3), dtype=np.int64)
    out = [empty] * len(texts)
    if not len(order):
        return out
    sizes = lengths[order]
    ids = np.concatenate([part for n, i in enumerate(order) for part in (texts[i], [-1 - n])]).astype(np.int64)
    ends = (np.cumsum(sizes + 1) - 1).tolist()
    with np.errstate(over="ignore"):
        starts, stops, periods = _all_runs(ids, ends, sizes)
    long_ones = stops - starts >= np.maximum(min_length, 2 * periods)
    starts, stops, periods = starts[long_ones], stops[long_ones], periods[long_ones]
    text = np.searchsorted(ends, starts, "right")
    offsets = np.array(ends, dtype=np.int64) - sizes
    rows = np.stack([starts - offsets[text], stops - starts, periods], axis=1)
    by_place = np.lexsort((periods, starts))
    rows, text = rows[by_place], text[by_place]
    cuts = np.searchsorted(text, np.arange(len(order) + 1))
    for n, i in enumerate(order):
        out[i] = rows[cuts[n] : cuts[n + 1]]
    return out


def _all_runs(ids: np.ndarray, ends: list[int], lengths: np.ndarray) -> Runs:
    known = _short_periods(ids)
    if lengths[0] < 6 * _FIRST_SCALE:
        return known
    hashes = _Hashes(ids, ends, lengths)
    scale, k = _FIRST_SCALE, _FIRST_SCALE.bit_length() - 1
    while 6 * scale <= lengths[0]:
        end = _prefix(ends, lengths, 6 * scale)
        positions = _synchronising(hashes.window(k)[: end - scale + 1], scale, known)
        proposed = [_equal_contexts(positions, hashes.window(k + 1)[positions], scale), _touching_runs(known, hashes, scale)]
        first, last, period = [np.concatenate(c) for c in zip(*proposed, strict=True)]
        if len(first):
            start = first - hashes.same(first, first + period, -1)
            stop = last + hashes.same(last, last + period, 1) + period
            whole = stop - start >= 2 * period
            if whole.any():
                known = _joined([known, (start[whole], stop[whole], period[whole])])
        scale, k = 2 * scale, k + 1
    return known
