"""A KPI record kept up to date: states of each load of the logs are stored, merged and finished.

A log grows; a record over all of it need not read it again. ``add_load`` reads the rows of one load alone and stores,
per instance and log table, the states of the pilot's measures (``flowgauge.operators.states``), beside the instance's
own rows: its spine and the variables the pilot names. ``record_of_loads`` reads what is stored, one merge per instance.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.errors import bad_input
from flowgauge.operators.filters import keep_rows
from flowgauge.operators.kpi import Measure, shared_filter
from flowgauge.plans.record import Pilot, checked_pilot, kpi_record, measures_of
from flowgauge.schemas import KEY, SCHEMAS
from flowgauge.sources.logs import ProcessLogs

def _stored_measures(pilot: Pilot) -> dict[str, Measure]:
    kpis = checked_pilot(pilot)
    for name, kpi in kpis.items():
        if kpi.frame or any(measure.state is None for measure in kpi.measures.values()):
            raise bad_input(f"the KPI [{name}] has no mergeable state and cannot be kept up to date")
    return measures_of(kpis)


def _columns(measures: Mapping[str, Measure]) -> dict[tuple[str, str], str]:
    return {(name, key): f"{name}_{key}" for name, measure in measures.items() for key in measure.state.parts}


def _merged(frame: DataFrame, measures: Mapping[str, Measure]) -> DataFrame:
    """One state per instance; texts apart from numbers, which then stay a hash aggregate."""
    columns = _columns(measures)

    def aggregates(text: bool) -> list[Column]:
        return [
            part.merge(lambda key, name=name: F.col(columns[name, key])).alias(columns[name, key])
            for name, measure in measures.items() if (measure.text or measure.distinct) == text
            for key, part in measure.state.parts.items()
        ]

    made = [frame.groupBy(KEY).agg(*parts) for parts in (aggregates(False), aggregates(True)) if parts]
    return reduce(lambda a, b: a.join(b, KEY), made)


def partial_states(logs: ProcessLogs, pilot: Pilot) -> DataFrame:
    """``process_instance_key`` and the columns of all states: a row per instance and log table that has rows of it."""
    measures = _stored_measures(pilot)
    columns = _columns(measures)
    tables: dict[str, dict[str, Measure]] = {}
    for name, measure in measures.items():
        tables.setdefault(measure.table, {})[name] = measure
    made = []
    for table, group in tables.items():
        rows = keep_rows(logs.table(table), shared_filter(list(group.values())))
        made.append(_merged(rows.select(KEY, *(
            part.row.alias(columns[name, key]) for name, measure in group.items() for key, part in measure.state.parts.items()
        )), group))
    if not made:
        return logs.process_instances.select(KEY)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), made)


def add_load(logs: ProcessLogs, pilot: Pilot, path: str, load: int) -> None:
    """Store what the rows of one load contribute, as load number ``load`` under ``path``.

    Every row of a log belongs to one load; an element comes with the load in which it has its final form. Instances may
    come again, the row of the highest load counts. Storing a load again replaces it, so a repeated job leaves no
    duplicates. Only ``logs`` is read.
    """
    names = sorted({name for kpi in checked_pilot(pilot).values() for name in kpi.variables})
    parts = {"states": partial_states(logs, pilot), "process_instances": logs.process_instances}
    if names:
        parts["variables"] = logs.variables.filter((F.col("scope_key") == F.col(KEY)) & F.col("name").isin(names))
    for part, rows in parts.items():
        rows.write.mode("overwrite").parquet(f"{path}/{part}/load={load}")


def record_of_loads(spark: SparkSession, pilot: Pilot, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """The record of all loads under ``path``, equal to ``kpi_record`` over all their rows at once.

    The pilot has to be the one the loads were stored with. Cost: instances times loads, whatever the logs hold;
    ``merge_loads`` brings the loads down to one.
    """
    measures = _stored_measures(pilot)
    columns = _columns(measures)
    states = spark.read.parquet(f"{path}/states")

    def merged(wanted: Mapping[str, Measure]) -> list[DataFrame]:
        found = _merged(states, wanted)
        return [found.select(KEY, *(
            measure.state.value(lambda key, name=name: F.col(columns[name, key])).alias(name) for name, measure in wanted.items()
        ))]

    tables = {"process_instances": _newest_spine(spark, path)}
    if any(kpi.variables for kpi in checked_pilot(pilot).values()):
        tables["variables"] = spark.read.schema(SCHEMAS["variables"]).parquet(f"{path}/variables")
    return kpi_record(ProcessLogs.of(**tables), pilot, mode, merged=merged)


def _newest_spine(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(f"{path}/process_instances")
    names = SCHEMAS["process_instances"].fieldNames()
    newest = rows.groupBy(KEY).agg(F.max_by(F.struct(*(n for n in names if n != KEY)), "load").alias("row"))
    return newest.select(KEY, "row.*").select(*names)


def merge_loads(spark: SparkSession, pilot: Pilot, path: str, target: str) -> None:
    """All loads under ``path`` as load 0 under ``target``, which is another folder: what is read is never overwritten."""
    if path.rstrip("/") == target.rstrip("/"):
        raise bad_input("loads are merged into another folder")
    measures = _stored_measures(pilot)
    states = spark.read.parquet(f"{path}/states")
    merged = _merged(states, measures) if measures else states.select(KEY).distinct()
    parts = {"states": merged, "process_instances": _newest_spine(spark, path)}
    if any(kpi.variables for kpi in checked_pilot(pilot).values()):
        parts["variables"] = spark.read.schema(SCHEMAS["variables"]).parquet(f"{path}/variables")
    for part, rows in parts.items():
        rows.write.mode("overwrite").parquet(f"{target}/{part}/load=0")
