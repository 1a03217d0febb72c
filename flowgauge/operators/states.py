"""Mergeable states: what a set of rows contributes to an aggregate, and how two contributions become one.

A state is a few plain columns. A single row has one, and states merge by ordinary aggregates, in any grouping: rows of a
slot, slots of an instance, the loads of a log. So one description serves a sweep over moments, stored partial results
and streams; see ``flowgauge.streaming.sweep`` and ``flowgauge.plans.partial``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Lookup = Callable[[str], Column]


@dataclass(frozen=True)
class Part:
    """One column of a state: its value for a single row, the aggregate that merges many, and the merger of two."""

    row: Column
    merge: Callable[[Lookup], Column]
    fold: Callable[[Lookup, Lookup], Column]


@dataclass(frozen=True)
class State:
    """``value`` turns the merged columns into the value of the aggregate.

    ``first_of``: rows beyond the first of each value of this column are counted. In a sweep over time that is one
    count more per row and one less per first row, so no set has to be carried along.
    """

    parts: Mapping[str, Part]
    value: Callable[[Lookup], Column]
    first_of: str | None = None


def _plain(row: Column, merge: Callable[[Column], Column], fold: Callable[[Column, Column], Column]) -> State:
    def folded(a: Lookup, b: Lookup) -> Column:
        return F.coalesce(fold(a("v"), b("v")), a("v"), b("v"))

    return State({"v": Part(row, lambda of: merge(of("v")), folded)}, lambda of: of("v"))


def total(value: Column) -> State:
    return _plain(value, F.sum, lambda a, b: a + b)


def counted(condition: Column | None = None) -> State:
    """Number of rows, or of those that meet a condition; null where there is no row at all."""
    one = F.lit(1).cast("bigint")
    return total(one if condition is None else F.when(condition, one).otherwise(F.lit(0).cast("bigint")))


def any_true(condition: Column) -> State:
    return _plain(condition, F.bool_or, lambda a, b: a | b)


def all_true(condition: Column) -> State:
    return _plain(condition, F.bool_and, lambda a, b: a & b)


def least(value: Column) -> State:
    return _plain(value, F.min, F.least)


def first_by(value: Column, order: Column) -> State:
    """``value`` of the row with the smallest ``order``; rows whose order is null do not count."""
    return _picked(value, order, F.min, F.min_by, F.least, lambda a, b: a <= b)


def last_by(value: Column, order: Column) -> State:
    """``value`` of the row with the largest ``order``; rows whose order is null do not count."""
    return _picked(value, order, F.max, F.max_by, F.greatest, lambda a, b: a >= b)


def _picked(value: Column, order: Column, bound, bound_by, edge, wins) -> State:
    def fold(a: Lookup, b: Lookup) -> Column:
        return F.when(b("o").isNull() | wins(a("o"), b("o")), a("v")).otherwise(b("v"))

    return State({
        "o": Part(order, lambda of: bound(of("o")), lambda a, b: edge(a("o"), b("o"))),
        "v": Part(F.when(order.isNotNull(), value), lambda of: bound_by(of("v"), of("o")), fold),
    }, lambda of: of("v"))


def repeats(column: str) -> State:
    """Rows beyond the first of each value of a column; the values of one instance have to be few."""
    known = F.col(column).isNotNull()
    none = F.array().cast("array<string>")
    return State({
        "n": Part(
            F.when(known, F.lit(1)).otherwise(F.lit(0)).cast("bigint"), lambda of: F.sum(of("n")),
            lambda a, b: F.coalesce(a("n") + b("n"), a("n"), b("n")),
        ),
        "ids": Part(
            F.when(known, F.array(F.col(column))), lambda of: F.array_distinct(F.flatten(F.collect_list(of("ids")))),
            lambda a, b: F.array_union(F.coalesce(a("ids"), none), F.coalesce(b("ids"), none)),
        ),
    }, lambda of: of("n") - F.coalesce(F.array_size(of("ids")), F.lit(0)), first_of=column)
