"""Exact splitters of a distributed table: weights below candidate boundaries are counted and the candidates refined."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Splitter = tuple[float, ...]


def at_least(keys: list[str], splitter: Splitter) -> Column:
    """Whether a row's keys, compared in turn, reach the splitter. A splitter may name the first keys only."""
    reached = F.col(keys[len(splitter) - 1]) >= F.lit(splitter[-1])
    for key, value in reversed(list(zip(keys, splitter[:-1]))):
        reached = (F.col(key) > F.lit(value)) | ((F.col(key) == F.lit(value)) & reached)
    return reached


def part_of(keys: list[str], splitters: list[Splitter]) -> Column:
    """The number of splitters that a row reaches, found by bisection."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(at_least(keys, splitters[middle]), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(splitters))


@dataclass(frozen=True)
class _Interval:
    """Rows with these values of the first keys and the next key between ``low`` and ``high``."""

    prefix: Splitter
    low: float
    high: float

    def holds(self, keys: list[str]) -> Column:
        key = F.col(keys[len(self.prefix)])
        equal = [F.col(k) == F.lit(v) for k, v in zip(keys, self.prefix)]
        return reduce(lambda a, b: a & b, equal, key.between(F.lit(self.low), F.lit(self.high)))

    def cell(self, keys: list[str], probes: int) -> Column:
        if self.low == self.high:
            return F.lit(0)
        share = (F.col(keys[len(self.prefix)]) - F.lit(self.low)) / F.lit(self.high - self.low)
        return F.least(F.floor(share * probes), F.lit(probes - 1)).cast("int")


def splitters(
    rows: DataFrame, keys: list[str], weight: str, targets: list[float], tolerance: float, probes: int = 256,
    torn: set[Splitter] | None = None,
) -> list[Splitter]:
    """For each target, the key from which on the weight of all smaller rows is nearest to it.

    ``keys`` are double columns without nulls, compared in turn. A round deals the rows of every open interval to
    ``probes`` cells and sums their weights: one scan with partial sums, and at most ``len(targets) * probes`` rows for
    the driver. The cell that holds a target is the next round's interval, from the smallest to the largest key in it. A
    cell with a single key goes on with the next one of ``keys``, so a key of very many rows is split as well. A target
    is met when the weight is off by ``tolerance`` at most, or no finer boundary exists. Rows equal in all keys stay together;
    the keys of such rows in whose midst a target lies are added to ``torn``, one at most for each target.
    """
    ends = rows.agg(*(f(k) for k in keys[:1] for f in (F.min, F.max))).first()
    if ends[0] is None:
        return [(0.0,)] * len(targets)
    open_ = {t: (_Interval((), ends[0], ends[1]), 0.0) for t in targets}
    found: dict[float, Splitter] = {}
    while open_:
        intervals = list(dict.fromkeys(i for i, _ in open_.values()))
        number, cell = F.lit(None).cast("int"), F.lit(None).cast("int")
        for k, interval in reversed(list(enumerate(intervals))):
            number = F.when(interval.holds(keys), F.lit(k)).otherwise(number)
            cell = F.when(interval.holds(keys), interval.cell(keys, probes)).otherwise(cell)
        ranges = [f(k).alias(f"{name}_{k}") for k in keys for name, f in (("min", F.min), ("max", F.max))]
        summed = (
            rows.select(*keys, weight, number.alias("_interval"), cell.alias("_cell")).filter("_interval IS NOT NULL")
            .groupBy("_interval", "_cell").agg(F.sum(weight).alias("_weight"), *ranges).collect()
        )
        cells: dict[int, list] = {}
        for row in sorted(summed, key=lambda r: (r["_interval"], r["_cell"])):
            cells.setdefault(row["_interval"], []).append(row)
        for target, (interval, below) in list(open_.items()):
            step = _refined(target, interval, below, cells[intervals.index(interval)], keys, tolerance)
            if isinstance(step[0], _Interval):
                open_[target] = step
            else:
                found[target], group = step
                del open_[target]
                if torn is not None and group:
                    torn.add(group)
    return [found[t] for t in targets]


def _refined(target, interval: _Interval, below: float, cells: list, keys: list[str], tolerance: float):
    """The next interval and the weight below it; or the splitter, if the target is met at an edge of a cell or can't be
    met better, and in the latter case the keys of the equal rows that it lies in."""
    level = len(interval.prefix)
    low, high = f"min_{keys[level]}", f"max_{keys[level]}"
    for k, cell in enumerate(cells):
        after = below + float(cell["_weight"])
        last = k == len(cells) - 1
        if after < target and not last:
            below = after
            continue
        start: Splitter = (*interval.prefix, cell[low])
        # The row after this cell may lie outside of the interval; any key just above the cell's largest will do.
        stop: Splitter = (*interval.prefix, cells[k + 1][low]) if not last else _beyond((*interval.prefix, cell[high]))
        if abs(target - below) <= tolerance:
            return start, None
        if abs(after - target) <= tolerance:
            return stop, None
        if cell[low] < cell[high]:
            return _Interval(interval.prefix, cell[low], cell[high]), below
        if level + 1 < len(keys):
            deeper = keys[level + 1]
            return _Interval(start, cell[f"min_{deeper}"], cell[f"max_{deeper}"]), below
        return start if target - below <= after - target else stop, start
    raise AssertionError("an interval has at least one cell")


def _beyond(splitter: Splitter) -> Splitter:
    from math import inf, nextafter

    return (*splitter[:-1], nextafter(splitter[-1], inf))
