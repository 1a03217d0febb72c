"""One KPI record per trigger, continuously: what the pilot yields at the moment a task activates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from flowgauge.errors import incomplete
from flowgauge.operators.closure import calls_below
from flowgauge.operators.key_sketch import KeySketch, key_sketch
from flowgauge.operators.kpi import all_of
from flowgauge.plans.record import Pilot, checked_pilot, kpi_record
from flowgauge.schemas import CLOCKS, KEY
from flowgauge.sources.logs import ProcessLogs
from flowgauge.streaming.closing import delay_interval
from flowgauge.streaming.sweep import MOMENT, TRIGGER, swept_measures, with_arrival

_CLOCK = "_seen"
_WAITING = f"{TRIGGER} bigint, {KEY} bigint, {MOMENT} timestamp_ntz"

#: From so many triggers of one instance on, measures are swept along time instead of joined with each trigger.
SWEEP_FROM = 16
#: So many instances of a batch are named one by one to the scans of the logs.
LISTED = 1000


def as_seen(logs: ProcessLogs, triggers: DataFrame) -> ProcessLogs:
    """The logs of each trigger's instances, cut at the trigger's time.

    Rows that came later are left out and an element that ended later counts as open;
    rows without a time stay. A sequence flow has the time at which its target first
    started. Variables have no time: they are the current values. Every row carries its
    trigger, and every trigger has a row among the instances, exported yet or not.
    """
    own = triggers.select(KEY).distinct()
    # What is aggregated before it meets a trigger is first cut to the instances of the triggers.
    near = logs.mapped(lambda name, table: table.join(own, KEY, "left_semi") if KEY in table.columns else table)

    def seen(name: str, table: DataFrame) -> DataFrame:
        if KEY not in table.columns:
            return table
        if name == "process_instances":
            return triggers.drop(MOMENT).join(table, KEY, "left")
        if name == "sequence_flows":
            arrived = F.col("_arrived")
            rows = with_arrival(near.sequence_flows, near).join(triggers, KEY)
            return rows.filter(arrived.isNull() | (arrived <= F.col(MOMENT))).drop("_arrived", MOMENT)
        rows = table.join(triggers, KEY)
        clock = CLOCKS.get(name)
        if clock:
            rows = rows.filter(F.col(clock).isNull() | (F.col(clock) <= F.col(MOMENT)))
        if name == "element_instances":
            rows = rows.withColumn("end_date", F.when(F.col("end_date") <= F.col(MOMENT), F.col("end_date")))
        return rows.drop(MOMENT)

    return logs.mapped(seen)


def record_at_triggers(
    triggers: DataFrame, logs: ProcessLogs, pilot: Pilot, mode: str = "PERMISSIVE",
    key_range: tuple[int, int] | None = None, sweep: bool | None = None,
    keys: list[int] | KeySketch | None = None,
) -> DataFrame:
    """``triggers(trigger_key, process_instance_key, trigger_time)`` -> one record per trigger.

    Each log is joined with the triggers of its instance and cut at their times; from
    there on the trigger takes the place of the instance, so the record is the ordinary
    fused plan keyed by trigger. That costs rows times triggers of an instance. With
    ``sweep``, what has a mergeable state is not joined: its rows and the triggers are put
    in order of time together (``flowgauge.streaming.sweep``), at a cost of rows plus
    triggers. Joined texts and ``history`` still are; their results are as long as the log
    anyway. Both ways give the same record. If ``sweep`` is not given, the triggers are
    counted: it is used where an instance has ``SWEEP_FROM`` of them or more.

    ``key_range`` bounds the instance keys of the triggers, for the scans to skip files;
    ``keys`` lists them, for the scans to read no others where an old and a new instance
    stand far apart; or it is a sketch of them, if they are many, which lets few other rows
    reach an exchange. Only ``history`` looks beyond, at the instances called below.
    """
    if sweep is None:
        sweep = trigger_counts(triggers)["most"] >= SWEEP_FROM
    wanted = triggers.select(TRIGGER, KEY, MOMENT)
    near, conditions = logs, [F.col(KEY).between(*key_range)] if key_range else []
    if keys is not None:
        conditions.append(keys.may_hold(F.col(KEY)) if isinstance(keys, KeySketch) else F.col(KEY).isin(keys))
    if conditions:
        near = logs.mapped(lambda name, table: table.filter(all_of(*conditions)) if KEY in table.columns else table)
    direct = as_seen(near, wanted)
    if any(kpi.nested for kpi in checked_pilot(pilot, TRIGGER).values()):
        direct.nested = as_seen(logs, calls_below(logs, wanted, MOMENT))
    swept = (lambda measures: swept_measures(near, measures, wanted)) if sweep else None
    return wanted.join(kpi_record(direct, pilot, mode, key=TRIGGER, merged=swept), TRIGGER)


def trigger_counts(triggers: DataFrame) -> Row:
    """``low`` and ``high``, the range of the triggers' instance keys, null without any; the number of ``instances``;
    ``most`` triggers of one instance."""
    by_instance = triggers.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    return by_instance.agg(
        F.min(KEY).alias("low"), F.max(KEY).alias("high"), F.count(KEY).alias("instances"),
        F.coalesce(F.max("n"), F.lit(0)).alias("most"),
    ).first()


def _instances(batch: DataFrame, sketch: bool = False) -> tuple[list[int] | KeySketch | None, Row]:
    """The instances of a batch, listed if they are few, or a sketch of them if wanted, and ``trigger_counts``."""
    counted = trigger_counts(batch)
    if counted["instances"] > LISTED:
        return (key_sketch(batch, KEY, counted["instances"]) if sketch else None), counted
    return sorted(row[KEY] for row in batch.filter(F.col(KEY).isNotNull()).select(KEY).distinct().collect()), counted


def kpi_on_trigger(
    triggers: DataFrame, open_logs: Callable[[], ProcessLogs], pilot: Pilot, path: str, mode: str = "PERMISSIVE",
    progress: DataFrame | None = None, wait: int | str = 0, sketch: bool = False,
) -> DataStreamWriter:
    """Writer of a stream of triggers; start it with a checkpoint location of your choice.

    ``open_logs`` opens the logs, ``lambda: read_logs(spark, folder)`` for instance. It is
    called for each micro-batch, so a record sees all that was exported before its batch
    began; a table that is opened once keeps the files it had then.

    Every trigger adds a row, none is updated. A micro-batch replaces the folder
    ``batch_id=<n>`` under ``path``, so a batch that is replayed after a failure leaves
    no duplicates.

    ``sketch`` gives the log scans a sketch of the instances of a batch that has too many to
    list. It pays where they are a small part of a long log; where a batch touches most
    instances it only costs.

    **Waiting.** Logs are exported with a delay, and a record is not to miss what came before
    its trigger. With ``wait`` (milliseconds or an interval; or the longest ``wait_ms`` of the
    pilot's KPIs, if that is longer), a trigger waits until the log has been seen beyond its
    time by as much. ``progress`` tells how far the log is: a stream of one time column, the
    starts of exported elements for instance. The newest time seen is the log's clock; it only
    moves on. A trigger that comes later than that is not dropped, it need not wait. Waiting
    triggers are kept in ``_waiting`` under ``path``, one folder per micro-batch, which the
    next one reads: what is kept is the triggers, never rows of the log. Those still waiting
    when the stream ends are there when it goes on.
    """
    longest = max((kpi.wait_ms for kpi in checked_pilot(pilot, TRIGGER).values()), default=0)
    delays = [delay_interval(wait), delay_interval(longest)]
    waits = any(int(delay.split()[0]) for delay in delays)
    if waits and progress is None:
        raise incomplete("to wait for the log, give the stream of its progress")

    def due(batch: DataFrame, batch_id: int) -> DataFrame:
        """The triggers whose wait is over; the others are written down, with the log's clock in a row of its own."""
        spark = batch.sparkSession
        new = batch.filter(F.col(TRIGGER).isNotNull()).select(TRIGGER, KEY, MOMENT)
        clock = batch.agg(F.max(_CLOCK).alias(MOMENT))
        try:
            before = spark.read.schema(_WAITING).parquet(f"{path}/_waiting/batch_id={batch_id - 1}")
        except AnalysisException:
            before = spark.createDataFrame([], _WAITING)
        now = before.filter(F.col(TRIGGER).isNull()).select(MOMENT).union(clock).agg(F.max(MOMENT)).first()[0]
        all_ = before.filter(F.col(TRIGGER).isNotNull()).unionByName(new).persist()
        ends = F.greatest(*(F.col(MOMENT) + F.expr(f"INTERVAL {delay}") for delay in delays))
        # As text: a Python moment would be taken as one of the session's zone.
        over = F.coalesce(ends <= F.lit(now and now.isoformat(" ")).cast("timestamp_ntz"), F.lit(False))
        clock_row = spark.createDataFrame([(None, None, now)], _WAITING)
        all_.filter(~over).unionByName(clock_row).write.mode("overwrite").parquet(f"{path}/_waiting/batch_id={batch_id}")
        return all_.filter(over)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = due(batch, batch_id) if waits else batch.persist()
        try:
            keys, counted = _instances(batch, sketch)
            if counted["most"]:
                # Keys grow with time, so old files need not be opened.
                key_range = None if counted["low"] is None else (counted["low"], counted["high"])
                record = record_at_triggers(
                    batch, open_logs(), pilot, mode, key_range, counted["most"] >= SWEEP_FROM, keys
                )
                record.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    if not waits:
        return triggers.writeStream.foreachBatch(write)
    seen = progress.select(F.col(progress.columns[0]).cast("timestamp_ntz").alias(_CLOCK))
    both = triggers.select(TRIGGER, KEY, MOMENT).unionByName(seen, allowMissingColumns=True)
    return both.writeStream.foreachBatch(write)
