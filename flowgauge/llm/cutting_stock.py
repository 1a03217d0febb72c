"""Cutting stock over a histogram of lengths: linear program, columns priced by a knapsack, rounded patterns.

Everything here is sized by the number of different lengths (at most the sequence size), never by the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack of greatest price, and how often it holds each of the ascending ``sizes``."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        value[room], choice[room] = value[room - 1], -1
        k = fitting[room]
        if k:
            gains = value[room - sizes[:k]] + prices[:k]
            best = int(gains.argmax())
            if gains[best] > value[room]:
                value[room], choice[room] = gains[best], best
    counts = np.zeros(len(sizes), dtype=np.int64)
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(value[capacity]), counts


def fractional_patterns(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, tolerance: float = 1e-3, most: int = 4000
) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used: the least number of bins that covers ``demand``, as a linear program.

    Revised simplex over generated columns. It ends when no pattern is worth more than ``1 + tolerance`` at the current
    prices, which bounds the distance from the optimum, or after ``most`` columns.
    """
    m = len(sizes)
    basis = [np.where(np.arange(m) == i, capacity // sizes[i], 0) for i in range(m)]
    cost = np.ones(m)
    inverse = np.diag(1.0 / (capacity // sizes))
    level = inverse @ demand
    for _ in range(most):
        prices = cost @ inverse
        if prices.min() < -1e-9:  # more of this length than needed may be cut
            enter, price = -(np.arange(m) == int(prices.argmin())).astype(np.int64), 0.0
        else:
            worth, enter = best_pattern(np.maximum(prices, 0), sizes, capacity)
            price = 1.0
            if worth <= 1 + tolerance:
                break
        step = inverse @ enter
        ratios = np.where(step > 1e-9, level / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(ratios.argmin())
        if not np.isfinite(ratios[leave]):
            break
        pivot = inverse[leave] / step[leave]
        inverse -= np.outer(step, pivot)
        inverse[leave] = pivot
        amount = ratios[leave]
        level = np.maximum(level - step * amount, 0)
        level[leave] = amount
        basis[leave], cost[leave] = enter, price
    return [(p, float(x)) for p, x, c in zip(basis, level, cost) if c > 0 and x > 1e-9]


@dataclass(frozen=True)
class Runs:
    """Where the items of one length go, by their rank; run k holds ranks from ``first[k]`` on.

    In a run of a pattern every item opens the next sequence at the same offset (``stride`` 0). In a stream the items
    stand end to end from position ``offset`` of sequence ``sequence`` on and are cut where a sequence is full.
    """

    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    stream: np.ndarray

    def pieces(self, rank: int, length: int, size: int) -> list[tuple[int, int, int]]:
        """(length, sequence, offset) of each piece of the item."""
        k = int(np.searchsorted(self.first, rank, side="right")) - 1
        ahead, sequence, offset = rank - int(self.first[k]), int(self.sequence[k]), int(self.offset[k])
        if not self.stream[k]:
            return [(length, sequence + ahead, offset)]
        at = offset + ahead * length
        sequence, at = sequence + at // size, at % size
        here = min(length, size - at)
        return [(here, sequence, at)] + ([(length - here, sequence + 1, 0)] if here < length else [])


def assign(counts: dict[int, int], size: int, width: int = 8, least_fill: float = 0.97) -> tuple[dict[int, Runs], int]:
    """Runs for every length of ``counts`` (length below ``size`` -> number of items), and the number of sequences.

    The program works on lengths rounded up to ``width``. Its patterns are rounded up, as far as items are left, and
    filled with exact lengths. Patterns filled below ``least_fill`` are not used: their items, and those left over by the
    rounding, stand end to end in a stream and are cut at sequence ends, so only the last sequence has padding.
    """
    lengths = sorted(k for k, v in counts.items() if v)
    queues: dict[int, list[list[int]]] = {}
    for length in lengths:
        queues.setdefault(-(-length // width), []).append([length, 0, counts[length]])
    sizes = np.array(sorted(queues), dtype=np.int64)
    left = np.array([sum(q[2] for q in queues[c]) for c in sizes.tolist()], dtype=np.int64)
    runs: dict[int, list[tuple[int, int, int, bool]]] = {length: [] for length in lengths}
    sequences = 0
    patterns = fractional_patterns(sizes, left.astype(float), size // width) if len(sizes) else []
    patterns.sort(key=lambda p: (-p[1], p[0].tolist()))
    for pattern, level in patterns:
        used = np.flatnonzero(pattern)
        if (pattern * sizes).sum() < least_fill * (size // width):
            continue
        times = min(int(np.ceil(level - 1e-6)), int((left[used] // pattern[used]).min()))
        if times < 1:
            continue
        left[used] -= pattern[used] * times
        slots = [_take(queues[int(sizes[c])], times) for c in used for _ in range(pattern[c])]
        while times:
            run, offset = min(slot[-1][2] for slot in slots), 0
            for slot in slots:
                head = slot[-1]
                runs[head[0]].append((head[1], sequences, offset, False))
                offset += head[0]
                head[1], head[2] = head[1] + run, head[2] - run
                if not head[2]:
                    slot.pop()
            sequences, times = sequences + run, times - run
    at = 0
    for length, first, rest in (entry for c in sizes.tolist() for entry in queues[c]):
        if rest:
            runs[length].append((first, sequences, at, True))
            at += length * rest
    done = {
        length: Runs(*(np.array(x) for x in zip(*sorted(entries)))) for length, entries in runs.items() if entries
    }
    return done, sequences + -(-at // size)


def _take(queue: list[list[int]], times: int) -> list[list[int]]:
    """The next ``times`` items of a class as (length, first rank, number), the first of them last."""
    taken = []
    for entry in queue:
        n = min(entry[2], times)
        if n:
            taken.append([entry[0], entry[1], n])
            entry[1], entry[2], times = entry[1] + n, entry[2] - n, times - n
    return taken[::-1]
