"""What a KPI is made of.

A KPI declares the aggregates it needs, per log table, and how to finish them into
a value. The record plan fuses the aggregates of all KPIs that read the same table
into one ``groupBy``, so N KPIs cost one pass and one shuffle per table, not N.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.operators.states import State
from flowgauge.sources.logs import ProcessLogs


# Any value but null.
PRESENT: Sequence[str] = ()


@dataclass(frozen=True)
class Measure:
    """One aggregate over the rows of one log table, per instance.

    ``keep`` says which rows the aggregate can use at all: column -> wanted values, or
    :data:`PRESENT`. What all measures of a table restrict is pushed into the scan.
    ``distinct`` marks aggregates that need a second exchange, ``text`` those that pick
    a text, whose buffers have no fixed width. Either are planned apart, on their few
    columns and rows, so that the wide fused aggregate keeps a single exchange and sorts
    nothing.

    ``state`` is the same aggregate in mergeable form. Only a state whose rows do not count before they have ended
    (``ended``) may look at ``end_date``: as of a moment before it, that is not known. ``rows`` replaces the table by
    rows made from the logs, with the time from which each counts in ``_at``.
    """

    table: str
    aggregate: Column
    keep: Mapping[str, Sequence[str]] = field(default_factory=dict)
    distinct: bool = False
    text: bool = False
    state: State | None = None
    ended: bool = False
    rows: Callable[[ProcessLogs], DataFrame] | None = None


@dataclass(frozen=True)
class Ordered:
    """A value that depends on the order of an instance's elements, in a form that follows a stream.

    ``row`` names what is needed of each element. ``slot`` turns the elements of a short span of time, an array of
    ``row`` in order of start and key, into one value; ``fold`` makes one of two such values, the first being the
    earlier one; ``value`` finishes. All values are columns, mostly structs.
    """

    row: Mapping[str, Column]
    slot: Callable[[Column], Column]
    fold: Callable[[Column, Column], Column]
    value: Callable[[Column], Column]


@dataclass(frozen=True)
class Problem:
    """A value that cannot be used: reported, or raised in FAILFAST mode.

    ``is_null``: the KPI is null for such a value by itself. Then nothing guards it, and
    Spark parses a variable once for the value and for the problem.
    """

    when: Column
    code: str
    message: Column
    is_null: bool = False


class Inputs:
    """Columns a KPI may finish from."""

    def __init__(
        self, spine: Callable[[str], Column], measures: Mapping[str, Column],
        variables: Callable[[str], Column], frame: Column | None,
    ):
        self.spine = spine
        self.measures = measures
        self.variable = variables
        self.frame = frame

    def __getitem__(self, name: str) -> Column:
        return self.measures[name]

    def count(self, name: str = "n") -> Column:
        """A count measure; an instance without rows counts zero."""
        return F.coalesce(self.measures[name], F.lit(0).cast("bigint"))


@dataclass(frozen=True)
class Kpi:
    finish: Callable[[Inputs], Column]
    measures: Mapping[str, Measure] = field(default_factory=dict)
    # Names of process variables, given to `finish` as JSON text.
    variables: Sequence[str] = ()
    # Types of `variables` and a SQL expression over them, given to `finish` as the frame.
    expression: tuple[str, Mapping[str, str]] | None = None
    # A KPI that needs more than one aggregate: builds (key, value) itself.
    frame: Callable[[ProcessLogs, str], DataFrame] | None = None
    problems: Callable[[Inputs], list[Problem]] | None = None
    # Replaces `frame` where its value at many moments is wanted.
    swept: Measure | None = None
    # Replaces `frame` on a stream of elements.
    ordered: Ordered | None = None
    # Replaces `measures` on a stream, where distinct aggregates are refused.
    stream_measures: Mapping[str, Measure] | None = None
    # True when the KPI follows call activities into other instances.
    nested: bool = False
    # Milliseconds after a trigger until the logs are taken as complete; a pilot waits for its longest.
    wait_ms: int = 0


def measured(finish: Callable[[Inputs], Column] | None = None, **measures: Measure) -> Kpi:
    """A KPI finished from aggregates; by default the single measure ``n`` as a count."""
    return Kpi(finish or (lambda inputs: inputs.count()), measures)


def shared_filter(measures: Sequence[Measure]) -> Column | None:
    """What every measure restricts: per column the union of the wanted values.

    Plain ``IN`` and ``IS NOT NULL`` on stored columns, so scans of any source take it.
    """
    first, *others = measures
    conditions = []
    for column in first.keep:
        if all(column in measure.keep for measure in others):
            wanted = [tuple(measure.keep[column]) for measure in measures]
            values = sorted({value for part in wanted for value in part})
            conditions.append(
                F.col(column).isNotNull() if PRESENT in wanted else F.col(column).isin(values)
            )
    return all_of(*conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    combined = conditions[0]
    for condition in conditions[1:]:
        combined = combined | condition
    return combined


def all_of(*conditions: Column | None) -> Column | None:
    present = [condition for condition in conditions if condition is not None]
    if not present:
        return None
    combined = present[0]
    for condition in present[1:]:
        combined = combined & condition
    return combined
