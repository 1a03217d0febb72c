"""The KPI record: one wide row per instance for a whole pilot.

Plan: per log table one fused ``groupBy(key).agg(...)``, then left joins onto the
instance spine. All sides are hashed on the same key, so each log is shuffled once,
after map-side partial aggregation, and the joins reuse that partitioning.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from flowgauge.errors import BAD_INPUTPARAMETER, DATE_PARSING_ERROR, bad_input, incomplete, one_of
from flowgauge.operators.filters import keep_rows
from flowgauge.operators.kpi import Inputs, Kpi, Measure, Problem, any_of, shared_filter
from flowgauge.operators.projections import constant
from flowgauge.operators.variables import current_variables
from flowgauge.schemas import KEY
from flowgauge.sources.logs import ProcessLogs

ERRORS = "_kpi_errors"
# Codes a value can be reported with.
ERROR_CODES = (BAD_INPUTPARAMETER, DATE_PARSING_ERROR)
MODES = ("PERMISSIVE", "FAILFAST")
Pilot = Mapping[str, Any]


def checked_pilot(pilot: Pilot, key: str = KEY) -> dict[str, Kpi]:
    """The pilot as KPIs; anything that is not a KPI is a constant."""
    if not pilot:
        raise incomplete("the pilot names no KPI")
    seen = {key.lower(), ERRORS}
    for name in pilot:
        if name.lower() in seen:
            raise bad_input(f"a record cannot hold the column {name!r} twice, ignoring case")
        seen.add(name.lower())
    return {name: value if isinstance(value, Kpi) else constant(value) for name, value in pilot.items()}


def _spine_column(name: str) -> str:
    return f"_spine_{name}"


def fused_aggregates(logs: ProcessLogs, measures: Mapping[str, Measure], key: str) -> list[DataFrame]:
    """One aggregate per table (and one more for its distinct measures, and for its texts)."""
    groups: dict[tuple[str, bool, bool], dict[str, Measure]] = defaultdict(dict)
    for name, measure in measures.items():
        groups[measure.table, measure.distinct, measure.text][name] = measure
    frames = []
    for (table, *_), fused in groups.items():
        rows = keep_rows(logs.table(table), shared_filter(list(fused.values())))
        frames.append(rows.groupBy(key).agg(
            *(measure.aggregate.alias(name) for name, measure in fused.items())
        ))
    return frames


def measure_name(position: int, part: str) -> str:
    return f"_measure_{position}_{part}"


def measures_of(kpis: Mapping[str, Kpi]) -> dict[str, Measure]:
    """All measures of a pilot under the names they have while a record is made."""
    return {
        measure_name(position, part): measure
        for position, kpi in enumerate(kpis.values()) for part, measure in kpi.measures.items()
    }


Aggregates = Callable[[Mapping[str, Measure]], list[DataFrame]]


def kpi_record(
    logs: ProcessLogs, pilot: Pilot, mode: str = "PERMISSIVE", key: str = KEY, merged: Aggregates | None = None,
) -> DataFrame:
    """Evaluate the pilot for every instance: ``key``, then one column per KPI in order.

    A value that cannot be used (a threshold on text, say) becomes null and is listed
    in ``_kpi_errors``; with ``mode="FAILFAST"`` it fails the query instead. The error
    column is present when the pilot holds a KPI that can meet such a value.

    ``merged`` computes the measures that have a mergeable state in another way than from
    ``logs``: a frame by ``key`` with one column per name, or several.
    """
    how = one_of(mode, MODES, "mode of a record")
    kpis = checked_pilot(pilot, key)

    # Variables come first: only here can an expression see them as plain columns.
    spine = logs.process_instances
    df = spine.select(key, *(F.col(name).alias(_spine_column(name)) for name in spine.columns if name != key))
    names = list(dict.fromkeys(name for kpi in kpis.values() for name in kpi.variables))
    columns = {name: f"_variable_{position}" for position, name in enumerate(names)}
    frames = {}
    if names:
        df = df.join(current_variables(logs.variables, names, key, columns.get), key, "left")
        for position, (name, kpi) in enumerate(kpis.items()):
            if kpi.expression:
                frames[name] = f"_frame_{position}"
                df = _with_expression(df, frames[name], columns, *kpi.expression)

    measures, mergeable, places = {}, {}, {}
    for position, (name, kpi) in enumerate(kpis.items()):
        for part, measure in kpi.measures.items():
            column = measure_name(position, part)
            (mergeable if merged and measure.state else measures)[column] = measure
            places[name, part] = F.col(column)
        if merged and kpi.swept:
            frames[name] = f"_frame_{position}"
            mergeable[frames[name]] = kpi.swept
    for frame in fused_aggregates(logs, measures, key) + (merged(mergeable) if mergeable else []):
        df = df.join(frame, key, "left")

    for position, (name, kpi) in enumerate(kpis.items()):
        if kpi.frame and name not in frames:
            frames[name] = f"_frame_{position}"
            df = df.join(kpi.frame(logs, key).select(key, F.col("value").alias(frames[name])), key, "left")

    def spine_value(name: str) -> Column:
        return F.col(name if name == key else _spine_column(name))

    values, problems = [], []
    for name, kpi in kpis.items():
        inputs = Inputs(
            spine=spine_value,
            measures={part: places[name, part] for part in kpi.measures},
            variables=lambda variable: F.col(columns[variable]),
            frame=F.col(frames[name]) if name in frames else None,
        )
        found = kpi.problems(inputs) if kpi.problems else []
        values.append(_checked(kpi.finish(inputs), found, how).alias(name))
        problems += [_reported(name, problem) for problem in found]
    reported = [F.array_compact(F.array(*problems)).alias(ERRORS)] if problems and how == "PERMISSIVE" else []
    return df.select(key, *values, *reported)


def _with_expression(
    df: DataFrame, target: str, columns: Mapping[str, str], sql: str, types: Mapping[str, str],
) -> DataFrame:
    """Beside the expression's variables stands nothing but the row as one struct, so no name of theirs is ambiguous."""
    typed = [
        F.try_variant_get(F.try_parse_json(F.col(columns[name])), "$", kind).alias(name)
        for name, kind in types.items()
    ]
    has_any = any_of([F.col(columns[name]).isNotNull() for name in types])
    only = df.select(F.struct(*df.columns).alias("_row"), has_any.alias("_any"), *typed)
    return only.select("_row", F.when(F.col("_any"), F.expr(sql)).alias(target)).select("_row.*", target)


def _checked(value: Column, problems: list[Problem], mode: str) -> Column:
    if not problems:
        return value
    if mode == "PERMISSIVE":
        guarded = [problem.when for problem in problems if not problem.is_null]
        return F.when(any_of(guarded), None).otherwise(value) if guarded else value
    checked = value
    for problem in problems:
        failure = F.raise_error(F.concat(F.lit(f"{problem.code}: "), problem.message))
        checked = F.when(problem.when, failure).otherwise(checked)
    return checked


def _reported(name: str, problem: Problem) -> Column:
    entry = F.struct(
        F.lit(name).alias("kpi"), F.lit(problem.code).alias("code"), problem.message.alias("message")
    )
    return F.when(problem.when, entry)


def observed_errors(record: DataFrame, pilot: Pilot) -> tuple[DataFrame, Observation]:
    """``record`` as it is, and how often each KPI met each error, counted by the job that writes the record.

    ``observation.get`` has ``records`` and, for each KPI that can meet a bad value, ``<kpi>:<code>``. It waits until the
    frame returned has been written; nothing is read or computed a second time.
    """
    def met(name: str, code: str) -> Column:
        return F.size(F.filter(ERRORS, lambda error: (error["kpi"] == name) & (error["code"] == code)))

    observation = Observation()
    metrics = [F.count(F.lit(1)).alias("records")]
    if ERRORS in record.columns:
        metrics += [
            F.coalesce(F.sum(met(name, code)), F.lit(0)).alias(f"{name}:{code}")
            for name, kpi in checked_pilot(pilot).items() if kpi.problems for code in ERROR_CODES
        ]
    return record.observe(observation, *metrics), observation


def single_kpi(logs: ProcessLogs, value: Any, name: str = "value") -> DataFrame:
    """One KPI for every instance."""
    return kpi_record(logs, {name: value})
