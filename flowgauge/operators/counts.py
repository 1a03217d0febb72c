"""Counting KPIs: one aggregate each, all with map-side partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowgauge.errors import incomplete, is_blank, one_of, required
from flowgauge.operators import states
from flowgauge.operators.filters import element_is, has_text, job_is, job_keep
from flowgauge.operators.kpi import Kpi, Measure, all_of, any_of, measured


PATH_MODES = ("ALL", "ANY", "NOTHING")


def count_of(table: str, condition: Column | None, **keep: Sequence[str]) -> Measure:
    counted = F.count(F.lit(1)) if condition is None else F.count_if(condition)
    return Measure(table, counted, keep, state=states.counted(condition))


def ever(table: str, *ids: str) -> Measure:
    """Does any row name one of the elements?"""
    named = F.col("element_id").isin(list(ids))
    return Measure(table, F.bool_or(named), {"element_id": ids}, state=states.any_true(named))


def execution_count(element_id: str, match: str = "id") -> Kpi:
    """How often an element ran."""
    wanted = required(element_id, "the element id")
    keep = {"element_id": (wanted,)} if match == "id" else {}
    return measured(n=count_of("element_instances", element_is(wanted, match=match), **keep))


def retry_count(element_id: str | None = None) -> Kpi:
    """Executions beyond the first, of one element or summed over all elements."""
    if not is_blank(element_id):
        runs = count_of("element_instances", element_is(element_id), element_id=(element_id,))
        return measured(lambda inputs: F.greatest(inputs.count() - 1, F.lit(0).cast("bigint")), n=runs)
    runs = F.count("element_id")
    batch = Measure("element_instances", runs - F.count_distinct("element_id"), distinct=True, state=states.repeats("element_id"))
    # Streams refuse count(distinct); the ids of one instance are bounded by its process model.
    stream = Measure("element_instances", runs - F.size(F.collect_set("element_id")))
    return Kpi(lambda inputs: inputs.count(), {"n": batch}, stream_measures={"n": stream})


def incident_count(element_id: str | None = None) -> Kpi:
    """Incidents, or those of one element provided the element was executed.

    The condition "element executed" is a semi join on (instance, element). With the
    element fixed it is one flag per instance, so it rides on the element aggregate
    and costs no join of its own.
    """
    if is_blank(element_id):
        return measured(n=count_of("incidents", None))
    return measured(
        lambda inputs: F.when(inputs["executed"], inputs.count()).otherwise(F.lit(0).cast("bigint")),
        n=count_of("incidents", element_is(element_id), element_id=(element_id,)),
        executed=ever("element_instances", element_id),
    )


def message_count(name: str | None = None) -> Kpi:
    """Correlated messages, optionally of one name."""
    if is_blank(name):
        return measured(n=count_of("message_subscriptions", None))
    return measured(n=count_of("message_subscriptions", F.col("message_name") == name, message_name=(name,)))


def variable_changed_count(name: str) -> Kpi:
    """In how many scopes the variable is held."""
    wanted = required(name, "the variable name")
    return measured(n=count_of("variables", F.col("name") == wanted, name=(wanted,)))


def bpmn_error_count(error_code: str | None = None) -> Kpi:
    """Jobs that ended with a BPMN error code."""
    return bpm_error_count(error_code)


def bpm_error_count(error_code: str | None = None, element_id: str | None = None) -> Kpi:
    """Jobs that ended with a BPMN error, filtered by code and element."""
    condition = all_of(has_text(F.col("error_code")), job_is(error_code, element_id))
    return measured(n=count_of("jobs", condition, **job_keep(error_code, element_id)))


def boundary_error_count(error_code: str | None = None, element_id: str | None = None) -> Kpi:
    """Boundary events reached, filtered by the error code and element that name or id them."""
    named = [
        element_is(value, match="name_or_id") for value in (error_code, element_id) if not is_blank(value)
    ]
    condition = all_of(F.col("type") == "BOUNDARY_EVENT", *named)
    return measured(n=count_of("element_instances", condition, type=("BOUNDARY_EVENT",)))


def path(mode: str, *ids: str, include_flows: bool = False) -> Kpi:
    """Were ALL, ANY or none (NOTHING) of the elements executed?

    ``include_flows`` also looks the ids up among the sequence flows taken.
    """
    if is_blank(mode) or not ids:
        raise incomplete("a path needs a mode and one element id or more")
    wanted = list(dict.fromkeys(ids))
    how = one_of(mode, PATH_MODES, "mode of a path")
    tables = ("element_instances", "sequence_flows") if include_flows else ("element_instances",)

    if how == "ALL":
        measures = {
            f"{table}_{position}": ever(table, value)
            for table in tables for position, value in enumerate(wanted)
        }
    else:
        measures = {f"{table}_0": ever(table, *wanted) for table in tables}

    def finish(inputs):
        def seen(position: int) -> Column:
            return any_of([
                F.coalesce(inputs[f"{table}_{position}"], F.lit(False)) for table in tables
            ])

        if how == "ALL":
            return all_of(*(seen(position) for position in range(len(wanted))))
        return seen(0) if how == "ANY" else ~seen(0)

    return Kpi(finish, measures)
