"""Order of history entries that start at the same instant.

Among entries of equal start a flow comes after its source and before its target;
otherwise elements come first by key, then flows by (instance, id). That is a
topological sort which always takes the first free entry, and appends the entries of
cycles in their original order.

The whole tie group of a call tree is never gathered. Flows only join elements of
their own instance, so the group falls apart into independent pieces, one per
instance, and sorting the group is merging the sorted pieces by whichever next entry
comes first in the original order. An entry therefore surfaces together with the
greatest entry that precedes it in its piece: its place in the merged order is
(greatest original position up to here, place in the piece). This place is known from
the piece alone, and any window or top-k over it is plain Spark. A piece holds the
flows of one instance, at most as many as its process model has.

In most pieces no flow leaves an element of the same instant. Then every flow is free
from the start and a target follows the last flow into it, which is a plain array
expression; only pieces with chains inside one instant are sorted in Python.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from flowgauge.schemas import KEY

# The UDF travels with its code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Stands for "no such element in the group"; nulls would turn Arrow longs into floats.
NONE = -(2**63)

# Places of the flows in the order they were given, then of the elements among them.
PLACES = StructType([
    StructField("flow_stuck", ArrayType(BooleanType())),
    StructField("flow_lead_element", ArrayType(LongType())),
    StructField("flow_lead_flow", ArrayType(StringType())),
    StructField("flow_step", ArrayType(IntegerType())),
    StructField("element", ArrayType(LongType())),
    StructField("stuck", ArrayType(BooleanType())),
    StructField("lead_element", ArrayType(LongType())),
    StructField("lead_flow", ArrayType(StringType())),
    StructField("step", ArrayType(IntegerType())),
])


def sorted_piece(
    flow_ids: Iterable[str], sources: Iterable[int], targets: Iterable[int],
) -> dict[tuple[int, int, str], tuple[bool, int, str, int]]:
    """Sort one instance's part of a tie group.

    Entries are (0, element key, "") or (1, NONE, flow id). Each is given
    (stuck, lead element, lead flow, step): whether it is on or behind a cycle, the
    greatest entry up to it, and its place in the piece.
    """
    after: dict[tuple, set[tuple]] = {}
    waiting: dict[tuple, int] = {}
    for flow_id, source, target in zip(flow_ids, sources, targets):
        flow = (1, NONE, flow_id)
        waiting.setdefault(flow, 0)
        edges = [((0, source, ""), flow)] if source != NONE else []
        edges += [(flow, (0, target, ""))] if target != NONE else []
        for before, then in edges:
            waiting.setdefault(before, 0)
            waiting.setdefault(then, 0)
            if then not in after.setdefault(before, set()):
                after[before].add(then)
                waiting[then] += 1

    free = [entry for entry, count in waiting.items() if not count]
    heapq.heapify(free)
    places: dict[tuple, tuple] = {}
    lead = (0, NONE, "")
    while free:
        entry = heapq.heappop(free)
        lead = max(lead, entry)
        places[entry] = (False, lead[1], lead[2], len(places))
        for then in after.get(entry, ()):
            waiting[then] -= 1
            if not waiting[then]:
                heapq.heappush(free, then)
    for entry in waiting.keys() - places.keys():
        places[entry] = (True, entry[1], entry[2], 0)
    return places


@F.pandas_udf(PLACES)
def _places(flow_ids: pd.Series, sources: pd.Series, targets: pd.Series) -> pd.DataFrame:
    rows = []
    for ids, source, target in zip(flow_ids, sources, targets):
        if not len(ids):
            rows.append([[]] * len(PLACES))
            continue
        places = sorted_piece(ids, source.tolist(), target.tolist())
        flows = [places[1, NONE, flow_id] for flow_id in ids]
        elements = [(entry[1], *place) for entry, place in places.items() if entry[0] == 0]
        rows.append([*map(list, zip(*flows)), *(map(list, zip(*elements)) if elements else [[]] * 5)])
    return pd.DataFrame(rows, columns=PLACES.fieldNames())


# What a flow brings along into the history.
CARRIED = ("source_ref", "target_ref", "process_definition_id", "tenant_id")


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _entry(
    copies: Column, stuck: Column, lead_element: Column, lead_flow: Column, step: Column,
    flow: Column | None = None, element: Column | None = None,
) -> Column:
    """A flow or an element with its place, as one struct type."""
    key = F.lit(None).cast("bigint") if element is None else element
    carried = {
        name: F.lit(None).cast("string") if flow is None else flow[name] for name in ("flow_id", *CARRIED)
    }
    return F.struct(
        key.alias("element_instance_key"), *(value.alias(name) for name, value in carried.items()),
        copies.alias("copies"), stuck.alias("stuck"), lead_element.alias("lead_element"),
        lead_flow.alias("lead_flow"), step.alias("step"),
    )


def placed_entries(occurrences: DataFrame, types: list[str], instance: Sequence[str] = (KEY,)) -> DataFrame:
    """The flows with their place within equal starts, and the places of elements tied to them.

    ``occurrences`` comes from :func:`flowgauge.operators.flows.flow_occurrences`;
    ``types`` are the element types that take part in the history. One row per entry:
    flows have ``flow_id`` and their columns, elements only their
    ``element_instance_key``. Elements not listed stand for themselves.
    """
    starts = F.col("target.start_date")

    def key_if(condition: Column, end: str) -> Column:
        shown = F.col(f"{end}.type").isin(types)
        return F.when(shown & condition, F.col(f"{end}.element_instance_key")).otherwise(F.lit(NONE))

    flow = F.struct(
        "flow_id", key_if(F.col("source.start_date") == starts, "source").alias("source_key"),
        key_if(F.lit(True), "target").alias("target_key"),
        F.col("source.element_id").alias("source_ref"), F.col("target.element_id").alias("target_ref"),
        "process_definition_id", "tenant_id",
    )
    # A flow listed twice stands next to itself in any order, so one copy is ranked.
    pieces = (
        occurrences.groupBy(*instance, "flow_id").agg(
            F.min(F.struct(starts.alias("start_date"), flow.alias("flow"))).alias("taken"),
            F.count(F.lit(1)).alias("copies"),
        )
        .groupBy(*instance, F.col("taken.start_date").alias("start_date"))
        .agg(F.array_sort(F.collect_list(F.struct("taken.flow.*", "copies"))).alias("piece"))
    )
    chained = F.exists("piece", lambda flow: flow["source_key"] != NONE)

    def if_chained(name: str, kind: str):
        return F.when(chained, F.col(f"piece.{name}")).otherwise(F.array().cast(kind))

    placed = pieces.withColumns({
        "p": _places(
            if_chained("flow_id", "array<string>"), if_chained("source_key", "array<bigint>"),
            if_chained("target_key", "array<bigint>"),
        ),
        "targets": F.col("piece.target_key"),
    })
    flows = F.transform(
        F.arrays_zip("piece", "p.flow_stuck", "p.flow_lead_element", "p.flow_lead_flow", "p.flow_step"),
        lambda e: _entry(
            e["piece"]["copies"], F.coalesce(e["flow_stuck"], F.lit(False)),
            F.coalesce(e["flow_lead_element"], F.lit(NONE)),
            F.coalesce(e["flow_lead_flow"], e["piece"]["flow_id"]), F.coalesce(e["flow_step"], F.lit(0)),
            flow=e["piece"],
        ),
    )
    sorted_elements = F.transform(
        F.arrays_zip("p.element", "p.stuck", "p.lead_element", "p.lead_flow", "p.step"),
        lambda e: _entry(_one(), e["stuck"], e["lead_element"], e["lead_flow"], e["step"], element=e["element"]),
    )
    last_into_target = F.filter(
        "piece",
        lambda flow, i: (flow["target_key"] != NONE)
        & ~F.array_contains(F.slice("targets", i + 2, F.size("targets")), flow["target_key"]),
    )
    following_elements = F.transform(
        last_into_target,
        lambda flow: _entry(
            _one(), F.lit(False), F.lit(NONE), flow["flow_id"], F.lit(1), element=flow["target_key"]
        ),
    )
    elements = F.when(chained, sorted_elements).otherwise(following_elements)
    entries = placed.select(*instance, "start_date", F.inline(F.concat(flows, elements)))
    led_by_flow = F.col("lead_flow") != ""
    return entries.withColumn("copy", F.explode(F.sequence(_one(), F.col("copies")))).select(
        *instance, "element_instance_key", "flow_id", "start_date", *CARRIED, "stuck",
        led_by_flow.alias("lead_is_flow"),
        F.when(~led_by_flow, F.col("lead_element")).alias("lead_element"),
        F.when(led_by_flow, F.col(KEY)).alias("lead_instance"), "lead_flow", "step",
    )
