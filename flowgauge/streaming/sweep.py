"""Aggregates as of many moments at once: a sweep over log rows and triggers in order of time.

Joining each log row with each trigger of its instance costs rows times triggers. Here both are united, and the states of
rows (``flowgauge.operators.states``) are merged along time:

1. within a minute of an instance, rows and triggers are put in order and merged up to each: a window over one minute;
2. what the minutes come to is merged along the minutes of the instance: a window over its minutes;
3. a trigger takes what the minutes before its own come to, and what its own comes to so far.

So the cost is rows plus triggers, and no task orders more than the minutes of an instance, or the rows of one minute.

A united row has a column per state, nearly all of them null: such rows are compressed to a tenth and less on their way to a
task, and gaps take half a dozen sorts and aggregates there, one upon the other. Partitions that are put together by their
compressed size are therefore too large once they are unpacked, so rows and triggers are counted first and dealt to a number
of partitions that follows from the count.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from flowgauge.functions.clock import minute_slot
from flowgauge.operators.filters import keep_rows
from flowgauge.operators.flows import resolved_flows
from flowgauge.operators.kpi import Measure, shared_filter
from flowgauge.operators.skew import partitions_for
from flowgauge.schemas import CLOCKS, KEY
from flowgauge.sources.logs import ProcessLogs

TRIGGER = "trigger_key"
MOMENT = "trigger_time"

# Rows without a time are there from the beginning.
_ALWAYS = "timestamp_ntz'0001-01-01 00:00:00'"

#: So many rows and triggers are swept by one task.
ROWS_A_TASK = 200_000


def with_arrival(flows: DataFrame, logs: ProcessLogs) -> DataFrame:
    """Flows with ``_arrived``, the first start of their target in the instance; null where that is not known."""
    ends = resolved_flows(flows, logs.flow_topology).select(
        KEY, F.col("flow_id").alias("element_id"), F.col("target_ref").alias("_target")
    )
    first = logs.element_instances.groupBy(KEY, F.col("element_id").alias("_target")).agg(
        F.min("start_date").alias("_arrived")
    )
    # A flow may be there more than once; its arrival is one.
    known = ends.join(first, [KEY, "_target"]).groupBy(KEY, "element_id").agg(F.min("_arrived").alias("_arrived"))
    return flows.join(known, [KEY, "element_id"], "left")


def swept_measures(logs: ProcessLogs, measures: Mapping[str, Measure], triggers: DataFrame) -> list[DataFrame]:
    """``trigger_key`` and one column per measure: its value over the rows seen at the trigger's time.

    A row is seen from the time its table goes by (``CLOCKS``), a row that has to have ended from its end; a sequence
    flow from the first start of its target. Rows at the very time of a trigger are seen. Rows without a time always
    are.
    """
    own = triggers.select(KEY).distinct()
    near = logs.mapped(lambda name, table: table.join(own, KEY, "left_semi") if KEY in table.columns else table)
    dealt = partitions_for(_counted(logs, measures, triggers, own), ROWS_A_TASK)
    parts = [
        (f"_{k}_{key}", name, key, part) for k, (name, measure) in enumerate(measures.items())
        for key, part in measure.state.parts.items()
        # A first row of its value takes one from the count, so the set of values is not needed.
        if not (measure.state.first_of and key != "n")
    ]
    columns = {(name, key): column for column, name, key, _ in parts}

    def merged(over: WindowSpec) -> list[Column]:
        return [part.merge(lambda key, name=name: F.col(columns[name, key])).over(over).alias(column) for column, name, _, part in parts]

    rows = _rows(near, measures, columns, dealt)
    moments = triggers.select(TRIGGER, KEY, F.col(MOMENT).alias("_at"))
    both = rows.unionByName(moments, allowMissingColumns=True).withColumn("_slot", minute_slot(F.col("_at")))
    both = both.repartition(dealt, KEY, "_slot")
    # At one moment rows come before triggers.
    order = Window.partitionBy(KEY, "_slot").orderBy("_at", F.col(TRIGGER).isNotNull())
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = both.select(
        TRIGGER, KEY, "_slot", F.lead(F.lit(True)).over(order).isNull().alias("_is_last"), *merged(until)
    )
    # What a slot comes to is what its last row comes to.
    earlier = Window.partitionBy(KEY).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    ends = inside.filter("_is_last").repartition(dealt, KEY)
    carried = ends.select(KEY, "_slot", *merged(earlier)).repartition(dealt, KEY, "_slot")
    carried = carried.withColumnsRenamed({column: f"_before{column}" for column, *_ in parts})
    found = inside.filter(F.col(TRIGGER).isNotNull()).join(carried, [KEY, "_slot"])

    def value(name: str, measure: Measure) -> Column:
        def at(key: str) -> Column:
            def here(k: str) -> Column:
                return F.col(columns[name, k])

            def before(k: str) -> Column:
                return F.col(f"_before{columns[name, k]}")

            return measure.state.parts[key].fold(before, here)

        return at("n") if measure.state.first_of else measure.state.value(at)

    return [found.select(TRIGGER, *(value(name, measure).alias(name) for name, measure in measures.items()))]


def _counted(logs: ProcessLogs, measures: Mapping[str, Measure], triggers: DataFrame, own: DataFrame) -> int:
    """The triggers and the rows of their instances in the logs of the measures.

    Sequence flows are left out: an instance has few, and those derived from an event log are not made for their number.
    """
    tables = dict.fromkeys(measure.table for measure in measures.values() if measure.table != "sequence_flows")
    keys = reduce(DataFrame.union, (logs.table(name).select(KEY) for name in tables), triggers.select(KEY))
    by_instance = keys.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    return by_instance.join(own, KEY, "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _rows(
    logs: ProcessLogs, measures: Mapping[str, Measure], columns: Mapping[tuple[str, str], str], dealt: int,
) -> DataFrame:
    """``process_instance_key``, ``_at`` and the states of single rows of all measures, those of other rows null.

    What is aggregated by instance on the way comes from logs in ``dealt`` partitions of the instance key.
    """
    by_instance = logs.mapped(lambda name, table: table.repartition(dealt, KEY) if KEY in table.columns else table)
    sources: dict[tuple, dict[str, Measure]] = {}
    for name, measure in measures.items():
        sources.setdefault((measure.table, measure.ended, name if measure.rows else None), {})[name] = measure
    found = []
    for (table, ended, _), group in sources.items():
        made = next(iter(group.values())).rows
        dated = made(by_instance) if made else _dated(by_instance if table == "sequence_flows" else logs, table, ended)
        rows = dated if made else keep_rows(dated, shared_filter(list(group.values())))
        rows = rows.withColumn("_at", F.coalesce("_at", F.expr(_ALWAYS)))
        found.append(rows.select(KEY, "_at", *(
            part.row.alias(columns[name, key]) for name, measure in group.items()
            for key, part in measure.state.parts.items() if (name, key) in columns
        )))
        for name, measure in group.items():
            column = measure.state.first_of
            if column:
                first = rows.filter(F.col(column).isNotNull()).groupBy(KEY, column).agg(F.min("_at").alias("_at"))
                found.append(first.select(KEY, "_at", F.lit(-1).cast("bigint").alias(columns[name, "n"])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def _dated(logs: ProcessLogs, table: str, ended: bool) -> DataFrame:
    if table == "sequence_flows":
        return with_arrival(logs.sequence_flows, logs).withColumnRenamed("_arrived", "_at")
    rows, clock = logs.table(table), CLOCKS.get(table)
    if ended:
        return rows.filter(F.col("end_date").isNotNull()).withColumn("_at", F.greatest("start_date", "end_date"))
    return rows.withColumn("_at", F.col(clock) if clock else F.lit(None).cast("timestamp_ntz"))
