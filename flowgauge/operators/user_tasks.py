"""User-task KPIs: service-level agreement, its description, assignees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.errors import incomplete, is_blank, one_of
from flowgauge.functions.clock import hour_slot, in_unit, micros_between, packed_order, parse_iso_duration
from flowgauge.operators import states
from flowgauge.operators.filters import element_is
from flowgauge.operators.kpi import PRESENT, Kpi, Measure, Ordered, all_of, measured
from flowgauge.sources.logs import ProcessLogs

# Units of the SLA description and the suffix each is shown with.
SLA_UNITS = {"MINUTE": "mn", "HOUR": "h", "DAY": "d"}
ASSIGNEE_MODES = ("FIRST", "LAST", "ALL")


def completed_user_task(element_id: str | None) -> Column:
    return all_of(
        F.col("type") == "USER_TASK", F.col("start_date").isNotNull(), F.col("end_date").isNotNull(),
        element_is(element_id),
    )


def named(element_id: str | None) -> dict[str, tuple[str, ...]]:
    return {} if is_blank(element_id) else {"element_id": (element_id,)}


def within(limit: str) -> Column:
    if limit is None:
        raise incomplete("give the limit of the user tasks as an ISO-8601 duration")
    return F.col("end_date") - F.col("start_date") <= F.lit(parse_iso_duration(limit))


def user_task_sla(element_id: str | None, limit: str) -> Kpi:
    """True when every completed user task took at most ``limit``; open tasks are ignored."""
    keep = {"type": ("USER_TASK",)} | named(element_id)
    in_time = F.when(completed_user_task(element_id), within(limit))
    met = Measure("element_instances", F.bool_and(in_time), keep, state=states.all_true(in_time), ended=True)
    return measured(lambda inputs: F.coalesce(inputs["met"], F.lit(True)), met=met)


def joined_text(rows: DataFrame, key: str, separator: str) -> DataFrame:
    """Concatenate ``text`` per key in the order of (moment, order_key), undated rows last.

    Two levels: texts are first joined within one hour of one instance, then the few
    hour texts of the instance are joined. The rows of a very long instance are thus
    sorted by many tasks, and only finished text meets in the end.
    """
    slots = rows.groupBy(key, hour_slot(F.col("moment")).alias("slot")).agg(
        F.expr(f"listagg(text, '{separator}') WITHIN GROUP (ORDER BY moment, order_key)").alias("text")
    )
    return slots.groupBy(key).agg(
        F.expr(f"listagg(text, '{separator}') WITHIN GROUP (ORDER BY slot NULLS LAST)").alias("value")
    )


def user_task_sla_description(element_id: str | None, limit: str, unit: str = "hour") -> Kpi:
    """``"task"-14h-OK, "task"-19h-OVER`` over the completed user tasks, by start."""
    shown = one_of(unit, tuple(SLA_UNITS), "unit of the description")
    in_time = within(limit)

    took = micros_between(F.col("start_date"), F.col("end_date"))
    text = F.concat(
        F.lit('"'), F.col("element_id"), F.lit('"-'), in_unit(took, shown).cast("string"),
        F.lit(SLA_UNITS[shown]), F.when(in_time, F.lit("-OK")).otherwise(F.lit("-OVER")),
    )

    def build(logs: ProcessLogs, key: str) -> DataFrame:
        rows = logs.element_instances.filter(completed_user_task(element_id)).select(
            key, F.col("start_date").alias("moment"), F.col("element_instance_key").alias("order_key"),
            text.alias("text"),
        )
        return joined_text(rows, key, ", ")

    return Kpi(
        lambda inputs: F.coalesce(inputs.frame, F.lit("")), frame=build,
        ordered=_text_in_order(F.when(completed_user_task(element_id), text), ", "),
    )


def _text_in_order(text: Column, separator: str) -> Ordered:
    def joined(texts: Column) -> Column:
        held = F.array_compact(texts)
        return F.when(F.size(held) > 0, F.array_join(held, separator))

    return Ordered(
        {"text": text}, lambda rows: joined(F.transform(rows, lambda r: r["text"])), lambda a, b: joined(F.array(a, b)),
        lambda all_: all_,
    )


def user_task_assignee(element_id: str | None = None, mode: str = "FIRST") -> Kpi:
    """First, last or all (comma-joined) assignees by creation date, undated tasks last."""
    how = one_of(mode, ASSIGNEE_MODES, "mode of the assignee")
    assigned = all_of(F.col("assignee").isNotNull(), element_is(element_id))
    if how == "ALL":
        def build(logs: ProcessLogs, key: str) -> DataFrame:
            rows = logs.user_tasks.filter(assigned).select(
                key, F.col("creation_date").alias("moment"), F.col("user_task_key").alias("order_key"),
                F.col("assignee").alias("text"),
            )
            return joined_text(rows, key, ",")

        return Kpi(lambda inputs: F.coalesce(inputs.frame, F.lit("")), frame=build)

    order = F.when(assigned, packed_order(F.col("creation_date"), F.col("user_task_key")))
    pick = F.min_by if how == "FIRST" else F.max_by
    chosen = Measure(
        "user_tasks", pick(F.col("assignee"), order), {"assignee": PRESENT} | named(element_id), text=True,
        state=(states.first_by if how == "FIRST" else states.last_by)(F.col("assignee"), order),
    )
    return measured(lambda inputs: F.coalesce(inputs["chosen"], F.lit("")), chosen=chosen)
