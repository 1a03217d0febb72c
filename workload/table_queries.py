"""Log tables, filters, current variables, whole records, sinks and streams."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions.clock import iso_text, rounded_date
from flowgauge.operators import counts, filters, latest, projections, timing, user_tasks, variables
from flowgauge.operators.checkpoints import shared_folder
from flowgauge.operators.key_sketch import key_sketch
from flowgauge.operators.variables import current_variables
from flowgauge.plans.history import history
from flowgauge.plans.partial import add_load, merge_loads, record_of_loads
from flowgauge.plans.record import ERRORS, kpi_record, observed_errors
from flowgauge.schemas import KEY, SCHEMAS
from flowgauge.sinks.matched import append_matched
from flowgauge.sources import event_log
from flowgauge.sources.clustered import buckets_for, read_clustered, write_clustered
from flowgauge.sources.event_log import logs_from_events
from flowgauge.sources.logs import ProcessLogs, read_logs
from flowgauge.streaming.closing import kpi_on_close
from flowgauge.streaming.triggers import kpi_on_trigger, record_at_triggers, trigger_counts
from workload.history_queries import ALL_TYPES, TOPIC_COLUMNS, rendered_sql
from workload.kpi_queries import KPIS, as_of
from workload.tables import with_tables

LogQuery = Callable[[ProcessLogs], DataFrame]

_TABLES = {
    "src_element_instances": "element_instances", "src_process_instances": "process_instances",
    "src_user_tasks": "user_tasks", "src_jobs": "jobs", "src_incidents": "incidents",
    "src_variables": "variables", "src_decisions": "decision_instances",
    "src_messages": "message_subscriptions", "src_sequence_flows": "sequence_flows",
    "src_flow_topology": "flow_topology",
}


def _table(name: str) -> tuple[LogQuery, str]:
    """The table as the reader finds it, once it is stored."""
    columns = SCHEMAS[name].fieldNames()

    def read(logs: ProcessLogs) -> DataFrame:
        table = logs.table(name).select(*columns)
        place = scratch(table.sparkSession)
        table.write.parquet(f"{place}/{name}")
        return read_logs(table.sparkSession, place).table(name).select(*columns)

    return (
        read,
        with_tables(f"SELECT {', '.join(columns)} FROM {name}", name),
    )


def _filtered(table: str, key: str, apply: Callable[[DataFrame], DataFrame], condition: str) -> tuple[LogQuery, str]:
    return (
        lambda logs: apply(logs.table(table)).select(key, "element_id"),
        with_tables(f"SELECT {key}, element_id FROM {table} WHERE {condition}", table),
    )


def _iso(logs: ProcessLogs) -> DataFrame:
    return logs.element_instances.select(
        "element_instance_key", iso_text(F.col("start_date")).alias("started"),
        iso_text(F.col("end_date")).alias("ended"),
    )


def _current(logs: ProcessLogs) -> DataFrame:
    return current_variables(logs.variables, ["amount", "dueDate"])


def _date_types(logs: ProcessLogs) -> DataFrame:
    def shown(kind: str, rounding: str = "HOUR", zone: str = "America/New_York"):
        return projections.date(rounding, kind, zone, as_of())

    record = kpi_record(logs, {
        "local_date": shown("LocalDate"), "local_time": shown("LocalTime"), "local_date_time": shown("LocalDateTime"),
        "instant": shown("Instant"), "offset": shown("OffsetDateTime"), "month_start": shown("STRING", "MONTH"), "full_text": shown("STRING", "FULL", "UTC"),
    })
    # Instants are compared as seconds, which no session time zone can shift.
    return record.withColumns({
        "instant": F.unix_seconds("instant"), "offset_instant": F.unix_seconds("offset.instant"),
        "offset": F.col("offset.offset"), "local_date": F.col("local_date").cast("string"),
    })


_DATE_TYPES_SQL = with_tables("""
SELECT process_instance_key, '2024-03-10' AS local_date, '03:00:00' AS local_time,
       TIMESTAMP '2024-03-10 03:00:00' AS local_date_time,
       CAST(epoch(TIMESTAMP '2024-03-10 07:00:00') AS BIGINT) AS instant,
       CAST(epoch(TIMESTAMP '2024-03-10 07:00:00') AS BIGINT) AS offset_instant, '-04:00' AS "offset",
       '2024-03-01T00:00:00' AS month_start, '2024-03-10T07:45:30.25' AS full_text
FROM process_instances""", "process_instances")


_ZONES = {"new_york": "America/New_York", "kolkata": "Asia/Kolkata", "utc": "UTC"}


def _roundings(logs: ProcessLogs) -> DataFrame:
    """Start of the day and of the month of every element's start, in several zones."""
    start = F.col("start_date")
    return logs.element_instances.select("element_instance_key", *(
        rounded_date(start, cut, "LocalDateTime", zone).alias(f"{cut.lower()}_{name}")
        for name, zone in _ZONES.items() for cut in ("HOUR", "DAY", "MONTH")
    ), *(rounded_date(start, "DAY", "Instant", zone).cast("bigint").alias(f"start_{name}") for name, zone in _ZONES.items()))


def _roundings_sql() -> str:
    def wall(zone: str) -> str:
        return f"((start_date AT TIME ZONE 'UTC') AT TIME ZONE '{zone}')"

    def day(zone: str) -> str:
        return f"date_trunc('day', {wall(zone)})"

    columns = ", ".join(
        [f"CAST(date_trunc('{cut}', {wall(zone)}) AS TIMESTAMP) AS {cut}_{name}"
         for name, zone in _ZONES.items() for cut in ("hour", "day", "month")]
        + [f"CAST(epoch({day(zone)} AT TIME ZONE '{zone}') AS BIGINT) AS start_{name}" for name, zone in _ZONES.items()]
    )
    return with_tables(f"SELECT element_instance_key, {columns} FROM element_instances", "element_instances")


# The record fuses these; names are the output columns.
RECORD = (
    "kpi_instance_key", "kpi_business_key", "kpi_process_property", "kpi_tag", "kpi_execution_count",
    "kpi_retry_count_total", "kpi_duration", "kpi_user_task_sla", "kpi_path_all", "kpi_bpmn_error_count",
    "kpi_bpmn_error", "kpi_incident_count_element", "kpi_message_count", "kpi_decision_result",
    "kpi_variable", "kpi_threshold", "kpi_bucket", "kpi_assignee_first", "kpi_user_task_sla_desc",
    "kpi_latency_total", "kpi_latency_element", "kpi_path_flows",
)


def full_pilot() -> dict:
    return {name: KPIS[name][0]() for name in RECORD}


def _record(logs: ProcessLogs) -> DataFrame:
    return kpi_record(logs, full_pilot()).drop(ERRORS)


def record_sql(names) -> str:
    return joined_sql({name: KPIS[name][1] for name in names})


def joined_sql(parts: dict[str, str]) -> str:
    """One row per instance from queries of (process_instance_key, value), each under its name."""
    values = ", ".join(f"{name}.value AS {name}" for name in parts)
    first, *others = (f"({sql}) {name}" for name, sql in parts.items())
    joins = "".join(f"\nJOIN {other} USING (process_instance_key)" for other in others)
    return f"SELECT process_instance_key, {values} FROM {first}{joins}"


def _fused(logs: ProcessLogs) -> DataFrame:
    """Ten KPIs of one table: one scan, one fused aggregate."""
    return kpi_record(logs, fused_pilot())


def fused_pilot() -> dict:
    return {
        "purchases": counts.execution_count("purchase"), "views": counts.execution_count("view"),
        "view_retries": counts.retry_count("view"), "boundary": counts.boundary_error_count("ERROR"),
        "hours": timing.duration("view", "purchase", "Hour"), "sla": user_tasks.user_task_sla("", "PT1H"),
        "every": counts.path("ALL", "view", "purchase"), "some": counts.path("ANY", "signup", "error"),
        "none": counts.path("NOTHING", "error"), "start_to_end": timing.duration("view:START", "signup:END", "minute"),
    }


_EDGE = """SELECT process_instance_key, t FROM (SELECT process_instance_key, {column} AS t, row_number() OVER (
    PARTITION BY process_instance_key ORDER BY start_date, element_instance_key) AS rn FROM element_instances
    WHERE element_id = '{element}' AND {column} IS NOT NULL) r WHERE rn = 1"""


def _fused_sql() -> str:
    def edge(column: str, element: str) -> str:
        return _EDGE.format(column=column, element=element)

    return with_tables(f"""
SELECT process_instance_key, purchases, views, greatest(views - 1, 0) AS view_retries, boundary,
  CAST(trunc(floor((epoch_us(pe.t) - epoch_us(ve.t)) / 1000000) / 3600) AS BIGINT) AS hours,
  late = 0 AS sla, purchases > 0 AND views > 0 AS every, others > 0 AS some, boundary = 0 AS none,
  CAST(trunc(floor((epoch_us(se.t) - epoch_us(vs.t)) / 1000000) / 60) AS BIGINT) AS start_to_end
FROM (SELECT p.process_instance_key,
        count(e.element_id) FILTER (WHERE element_id = 'purchase') AS purchases,
        count(e.element_id) FILTER (WHERE element_id = 'view') AS views,
        count(e.element_id) FILTER (WHERE element_id = 'error') AS boundary,
        count(e.element_id) FILTER (WHERE element_id IN ('signup', 'error')) AS others,
        count(e.element_id) FILTER (WHERE type = 'USER_TASK' AND end_date - start_date > INTERVAL 1 HOUR) AS late
      FROM process_instances p LEFT JOIN element_instances e USING (process_instance_key) GROUP BY 1) c
LEFT JOIN ({edge('end_date', 'view')}) ve USING (process_instance_key)
LEFT JOIN ({edge('end_date', 'purchase')}) pe USING (process_instance_key)
LEFT JOIN ({edge('start_date', 'view')}) vs USING (process_instance_key)
LEFT JOIN ({edge('end_date', 'signup')}) se USING (process_instance_key)""",
        "process_instances", "element_instances")


def bad_pilot() -> dict:
    return {
        "number": variables.threshold("dueDate", ">", 5), "label": variables.bucket("dueDate", [(0, "A")]),
        "moment": variables.threshold("amount", "after", "2024-01-01"), "fine": variables.threshold("amount", ">", 1),
    }


def _errors(logs: ProcessLogs) -> DataFrame:
    """What the record reports when a date is compared as a number and an amount as a date."""
    pilot = {name: kpi for name, kpi in bad_pilot().items() if name != "fine"}
    record = kpi_record(logs, pilot)
    return record.select(KEY, F.inline(ERRORS)).unionByName(
        record.filter(F.col("number").isNotNull() | F.col("label").isNotNull() | F.col("moment").isNotNull())
        .select(KEY, F.lit("not null").alias("kpi"), F.lit("").alias("code"), F.lit("").alias("message"))
    )


_ERRORS_SQL = with_tables("""
SELECT v.process_instance_key, k.kpi, k.code,
       'variable ' || v.name || ' should hold ' || k.e || ', not ''' || json_extract_string(v.value, '$') || '''' AS message
FROM variables v JOIN (VALUES
  ('number', 'dueDate', 'BAD_INPUTPARAMETER', 'a number'),
  ('label', 'dueDate', 'BAD_INPUTPARAMETER', 'a number'),
  ('moment', 'amount', 'DATE_PARSING_ERROR', 'an ISO-8601 date')
) k(kpi, name, code, e) ON k.name = v.name
WHERE v.scope_key = v.process_instance_key""", "variables")


def errors_observed(logs: ProcessLogs) -> DataFrame:
    """Errors per KPI and code, counted while the record is written."""
    spark = logs.process_instances.sparkSession
    record, observation = observed_errors(kpi_record(logs, bad_pilot()), bad_pilot())
    record.write.parquet(f"{scratch(spark)}/record")
    found = [(*name.split(":"), n) for name, n in observation.get.items() if ":" in name]
    return spark.createDataFrame(found, "kpi string, code string, errors bigint")


_OBSERVED_SQL = f"""
SELECT k.kpi, k.code, count(e.kpi) AS errors
FROM (SELECT kpi, code FROM (VALUES ('number'), ('label'), ('moment'), ('fine')) a(kpi),
      (VALUES ('BAD_INPUTPARAMETER'), ('DATE_PARSING_ERROR')) b(code)) k
LEFT JOIN ({_ERRORS_SQL}) e ON e.kpi = k.kpi AND e.code = k.code GROUP BY 1, 2"""


def record_clustered(logs: ProcessLogs) -> DataFrame:
    """The record over logs clustered by instance."""
    spark = logs.process_instances.sparkSession
    prefix = f"clustered_{uuid.uuid4().hex}_"
    # Every other log derived from events has a row for an element at most.
    write_clustered(logs, CLUSTERED, prefix, scratch(spark), buckets_for(logs, ["element_instances"]))
    return kpi_record(read_clustered(spark, prefix), full_pilot()).drop(ERRORS)


#: The tables a record reads.
CLUSTERED = [
    "element_instances", "process_instances", "user_tasks", "jobs", "incidents", "variables", "decision_instances",
    "message_subscriptions", "sequence_flows",
]


def scratch(spark: SparkSession) -> str:
    """A new folder under the cluster's shared one."""
    return f"{shared_folder(spark)}/flowgauge-{uuid.uuid4().hex}"


def _sink(logs: ProcessLogs) -> DataFrame:
    """Append a record to a table that knows some of its columns, in other spellings."""
    spark = logs.process_instances.sparkSession
    table = f"kpi_sink_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} (PROCESS_INSTANCE_KEY BIGINT, BusinessKey STRING, purchases INT, parts STRING, "
        f"createdBy STRING DEFAULT 'kpi') USING parquet LOCATION '{scratch(spark)}'"
    )
    record = kpi_record(logs, {
        "businesskey": projections.business_key(), "PURCHASES": counts.execution_count("purchase"),
        "unmatched": counts.retry_count(),
    }).withColumn("parts", F.struct(F.col("PURCHASES").alias("n")))
    append_matched(record, table)
    return spark.table(table)


_SINK_SQL = with_tables("""
SELECT p.process_instance_key AS PROCESS_INSTANCE_KEY, p.business_id AS BusinessKey,
       CAST(coalesce(n, 0) AS INTEGER) AS purchases, '{"n":' || coalesce(n, 0) || '}' AS parts, 'kpi' AS createdBy
FROM process_instances p LEFT JOIN (SELECT process_instance_key, count(*) AS n FROM element_instances
  WHERE element_id = 'purchase' GROUP BY 1) x USING (process_instance_key)""", "process_instances", "element_instances")


# A whole pilot: values of the instance, aggregates, a date, an expression and a history.
_DEMO = (*RECORD, "kpi_expr_variable", "kpi_date_text", "kpi_variable_changed", "kpi_boundary_error_count")


def demo_pilot(logs: ProcessLogs) -> DataFrame:
    """The pilot evaluated and appended to a table that spells its columns in another way and has one of its own."""
    spark = logs.process_instances.sparkSession
    record = kpi_record(logs, {name: KPIS[name][0]() for name in _DEMO} | {"demo_history": history("JSON", size=500)})
    table = f"kpi_demo_{uuid.uuid4().hex}"
    columns = ", ".join(f"{f.name.upper()} {f.dataType.simpleString()}" for f in record.schema if f.name != ERRORS)
    spark.sql(f"CREATE TABLE {table} ({columns}, created_by STRING DEFAULT 'kpi') USING parquet LOCATION '{scratch(spark)}'")
    append_matched(record, table)
    return spark.table(table)


def _demo_sql() -> str:
    parts = {name: KPIS[name][1] for name in _DEMO} | {"demo_history": rendered_sql(True, tuple(TOPIC_COLUMNS), ALL_TYPES, 500, "[]")}
    names = ", ".join(f"{name} AS {name.upper()}" for name in ("process_instance_key", *parts))
    return f"SELECT {names}, 'kpi' AS created_by FROM ({joined_sql(parts)}) r"


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    # The pattern fits a single file as well as a folder of files.
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]")
    return event_log.prepared_events(stream)


def purchases_in(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("trigger_key"), F.col("pik").alias(KEY), F.col("sd").alias("trigger_time")
    )


def purchases_of(spark: SparkSession, folder: str) -> DataFrame:
    return purchases_in(event_log.prepared_events(spark.read.parquet(f"{folder}/events.parquet")))


def trigger_pilot() -> dict:
    return {
        "purchases": counts.execution_count("purchase"), "retries": counts.retry_count(),
        "sla": user_tasks.user_task_sla("", "PT1H"), "errors": counts.bpmn_error_count(),
        "last_error": latest.bpmn_error(), "wait_ms": timing.latency(), "business_key": projections.business_key(),
    }


def stream_trigger(spark: SparkSession, folder: str) -> DataFrame:
    """Every purchase triggers a record of its instance as of that hour."""
    purchases = purchases_in(_event_stream(spark, folder))
    place = scratch(spark)
    writer = kpi_on_trigger(purchases, lambda: logs_from_events(spark, folder), trigger_pilot(), f"{place}/records")
    writer.option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start().awaitTermination()
    return records_in(spark, folder, f"{place}/records", trigger_pilot())


def stream_trigger_wait(spark: SparkSession, folder: str) -> DataFrame:
    """The same for a log that is exported in two loads, the second long after the triggers of its time.

    A trigger waits until the log is a day beyond it; those of the last day go on waiting.
    """
    logs, place = logs_from_events(spark, folder), scratch(spark)
    starts = logs.element_instances.select(F.unix_date(F.col("start_date").cast("date")).alias("day"))
    middle = starts.agg(F.floor((F.min("day") + F.max("day")) / 2).alias("day")).first()["day"]
    early = F.unix_date(F.col("start_date").cast("date")) <= F.lit(middle)
    for name in ("process_instances", "jobs"):
        logs.table(name).write.parquet(f"{place}/log/{name}")
    purchases = purchases_in(_event_stream(spark, folder))
    elements = f"{place}/log/element_instances"
    for load in (early, ~early):
        logs.element_instances.filter(load).write.mode("append").parquet(elements)
        progress = spark.readStream.schema(SCHEMAS["element_instances"]).parquet(elements).select("start_date")
        writer = kpi_on_trigger(
            purchases, lambda: read_logs(spark, f"{place}/log"), trigger_pilot(), f"{place}/records", progress=progress,
            wait="1 day",
        )
        writer.option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start().awaitTermination()
    return records_in(spark, folder, f"{place}/records", trigger_pilot())


def records_in(spark: SparkSession, folder: str, place: str, pilot: dict) -> DataFrame:
    try:
        return spark.read.parquet(place).drop("batch_id")
    except AnalysisException:
        # Without any trigger nothing was written; the plan gives the schema.
        none = record_at_triggers(purchases_of(spark, folder), logs_from_events(spark, folder), pilot, sweep=False)
        return spark.createDataFrame([], none.schema)


def _trigger_sql(triggers: str, *tables: str) -> str:
    return with_tables(_AT_TRIGGERS, *tables, "process_instances", "element_instances", "jobs", triggers=triggers, seen="""
SELECT t.trigger_key, e.*, CASE WHEN e.end_date <= t.trigger_time THEN e.end_date END AS ended
FROM triggers t JOIN element_instances e USING (process_instance_key) WHERE e.start_date <= t.trigger_time""")


_AT_TRIGGERS = """
SELECT t.trigger_key, t.process_instance_key, t.trigger_time, p.business_id AS business_key,
       e.purchases, e.retries, e.late = 0 AS sla, CAST(coalesce(j.errors, 0) AS BIGINT) AS errors,
       j.last_error, CAST(coalesce(g.wait_ms, 0) AS BIGINT) AS wait_ms
FROM triggers t JOIN process_instances p USING (process_instance_key)
JOIN (SELECT trigger_key, count(*) FILTER (WHERE element_id = 'purchase') AS purchases,
             CAST(count(*) - count(DISTINCT element_id) AS BIGINT) AS retries,
             count(*) FILTER (WHERE type = 'USER_TASK' AND ended - start_date > INTERVAL 1 HOUR) AS late
      FROM seen GROUP BY 1) e USING (trigger_key)
LEFT JOIN (SELECT trigger_key, count(*) AS errors,
             list(error_code ORDER BY last_update_time IS NOT NULL, last_update_time DESC, job_key)[1] AS last_error
      FROM triggers t JOIN jobs j USING (process_instance_key)
      WHERE trim(error_code) <> '' AND coalesce(last_update_time <= trigger_time, TRUE) GROUP BY 1) j USING (trigger_key)
LEFT JOIN (SELECT trigger_key, sum(greatest((epoch_us(nxt) - epoch_us(ended)) // 1000, 0)) AS wait_ms
      FROM (SELECT *, lead(start_date) OVER (PARTITION BY trigger_key ORDER BY start_date, element_instance_key) AS nxt
            FROM seen) s GROUP BY 1) g USING (trigger_key)"""

_TRIGGER_SQL = _trigger_sql("""
SELECT event_id AS trigger_key, pik AS process_instance_key, sd AS trigger_time FROM ev WHERE event_type = 'purchase'""")

_INCIDENT_SQL = _trigger_sql("""
SELECT incident_key AS trigger_key, process_instance_key, creation_time AS trigger_time FROM incidents""", "incidents")


_WAIT_SQL = _TRIGGER_SQL + """
WHERE t.trigger_time + INTERVAL 1 DAY <= (SELECT max(start_date) FROM element_instances)"""


#: KPIs of the record that need nothing but mergeable states, the spine and variables.
MERGED = tuple(name for name in RECORD if name not in ("kpi_user_task_sla_desc", "kpi_latency_total", "kpi_latency_element"))


def record_merged(logs: ProcessLogs) -> DataFrame:
    """The logs in three loads; two are merged into one before the third comes."""
    spark = logs.process_instances.sparkSession
    pilot, place = {name: KPIS[name][0]() for name in MERGED}, scratch(spark)
    for load in range(2):
        add_load(logs.mapped(lambda _, table: _third(table, load)), pilot, f"{place}/two", load)
    merge_loads(spark, pilot, f"{place}/two", f"{place}/all")
    add_load(logs.mapped(lambda _, table: _third(table, 2)), pilot, f"{place}/all", 1)
    return record_of_loads(spark, pilot, f"{place}/all").drop(ERRORS)


def _third(table: DataFrame, number: int) -> DataFrame:
    return table.filter(F.pmod(F.xxhash64(table.columns[0], table.columns[3]), F.lit(3)) == number)


def sweep_pilot() -> dict:
    return trigger_pilot() | {
        "view_retries": counts.retry_count("view"), "after_view": timing.latency("view"),
        "minutes": timing.duration("view", "purchase", "minute"), "to_click": timing.duration("view:START", "click:START", "hour"),
        "took": counts.path("ANY", "Flow_view_purchase", include_flows=True), "both": counts.path("ALL", "view", "click"),
        "assignee": user_tasks.user_task_assignee(), "last_assignee": user_tasks.user_task_assignee(mode="LAST"),
        "incidents": counts.incident_count("click"), "messages": counts.message_count(),
        "decision": latest.decision_result("GetScore"),
    }


def trigger_incidents(logs: ProcessLogs) -> DataFrame:
    """Every incident triggers a record of its instance as of then; the logs are read through a sketch of the instances."""
    raised = logs.incidents.select(
        F.col("incident_key").alias("trigger_key"), KEY, F.col("creation_time").alias("trigger_time")
    )
    keys = key_sketch(raised, KEY, trigger_counts(raised)["instances"])
    return record_at_triggers(raised, logs, trigger_pilot(), sweep=False, keys=keys)


def trigger_sweep(logs: ProcessLogs) -> DataFrame:
    """Every element that starts triggers a record of its instance as of that moment."""
    starts = logs.element_instances.select(
        F.col("element_instance_key").alias("trigger_key"), KEY, F.col("start_date").alias("trigger_time")
    )
    return record_at_triggers(starts, logs, sweep_pilot(), sweep=True)


_SWEEP_SQL = with_tables("""
SELECT t.trigger_key, t.process_instance_key, t.trigger_time, p.business_id AS business_key,
       e.purchases, e.retries, e.late = 0 AS sla, CAST(coalesce(j.errors, 0) AS BIGINT) AS errors,
       j.last_error, CAST(coalesce(g.wait_ms, 0) AS BIGINT) AS wait_ms,
       greatest(e.views - 1, 0) AS view_retries,
       CASE WHEN v.ended IS NOT NULL THEN coalesce((epoch_us(f.following) - epoch_us(v.ended)) // 1000, 0) END AS after_view,
       CAST(trunc(floor((epoch_us(e.purchase_end) - epoch_us(e.view_end)) / 1000000) / 60) AS BIGINT) AS minutes,
       CAST(trunc(floor((epoch_us(e.click_start) - epoch_us(e.view_start)) / 1000000) / 3600) AS BIGINT) AS to_click,
       coalesce(s.taken, FALSE) AND e.purchases > 0 AS took, e.views > 0 AND e.clicks > 0 AS both,
       coalesce(u.first_one, '') AS assignee, coalesce(u.last_one, '') AS last_assignee,
       CAST(CASE WHEN e.clicks > 0 THEN coalesce(i.n, 0) ELSE 0 END AS BIGINT) AS incidents,
       CAST(coalesce(m.n, 0) AS BIGINT) AS messages, d.decision
FROM triggers t JOIN process_instances p USING (process_instance_key)
JOIN (SELECT trigger_key, count(*) FILTER (WHERE element_id = 'purchase') AS purchases,
             count(*) FILTER (WHERE element_id = 'view') AS views, count(*) FILTER (WHERE element_id = 'click') AS clicks,
             CAST(count(*) - count(DISTINCT element_id) AS BIGINT) AS retries,
             count(*) FILTER (WHERE type = 'USER_TASK' AND ended - start_date > INTERVAL 1 HOUR) AS late,
             min(start_date) FILTER (WHERE element_id = 'view') AS view_start,
             min(start_date) FILTER (WHERE element_id = 'click') AS click_start,
             arg_min(ended, (start_date, element_instance_key)) FILTER (WHERE element_id = 'view' AND ended IS NOT NULL) AS view_end,
             arg_min(ended, (start_date, element_instance_key)) FILTER (WHERE element_id = 'purchase' AND ended IS NOT NULL) AS purchase_end
      FROM seen GROUP BY 1) e USING (trigger_key)
LEFT JOIN (SELECT trigger_key, count(*) AS errors,
             list(error_code ORDER BY last_update_time IS NOT NULL, last_update_time DESC, job_key)[1] AS last_error
      FROM triggers t JOIN jobs j USING (process_instance_key)
      WHERE trim(error_code) <> '' AND coalesce(last_update_time <= trigger_time, TRUE) GROUP BY 1) j USING (trigger_key)
LEFT JOIN (SELECT trigger_key, sum(greatest((epoch_us(nxt) - epoch_us(ended)) // 1000, 0)) AS wait_ms
      FROM (SELECT *, lead(start_date) OVER (PARTITION BY trigger_key ORDER BY start_date, element_instance_key) AS nxt
            FROM seen) s GROUP BY 1) g USING (trigger_key)
LEFT JOIN first_views v USING (trigger_key)
LEFT JOIN (SELECT v.trigger_key, min(s.start_date) AS following FROM first_views v JOIN seen s USING (trigger_key)
      WHERE s.start_date >= v.ended AND s.element_instance_key <> v.first_key GROUP BY 1) f USING (trigger_key)
LEFT JOIN (SELECT process_instance_key, TRUE AS taken FROM sequence_flows WHERE element_id = 'Flow_view_purchase'
      GROUP BY 1) s USING (process_instance_key)
LEFT JOIN (SELECT trigger_key, list(assignee ORDER BY creation_date NULLS LAST, user_task_key)[1] AS first_one,
             list(assignee ORDER BY creation_date NULLS LAST, user_task_key)[-1] AS last_one
      FROM triggers t JOIN user_tasks u USING (process_instance_key)
      WHERE assignee IS NOT NULL AND coalesce(creation_date <= trigger_time, TRUE) GROUP BY 1) u USING (trigger_key)
LEFT JOIN (SELECT trigger_key, count(*) AS n FROM triggers t JOIN incidents i USING (process_instance_key)
      WHERE element_id = 'click' AND coalesce(creation_time <= trigger_time, TRUE) GROUP BY 1) i USING (trigger_key)
LEFT JOIN (SELECT trigger_key, count(*) AS n FROM triggers t JOIN message_subscriptions m USING (process_instance_key)
      WHERE coalesce(correlation_time <= trigger_time, TRUE) GROUP BY 1) m USING (trigger_key)
LEFT JOIN (SELECT trigger_key,
             list(result ORDER BY evaluation_date IS NOT NULL, evaluation_date DESC, decision_instance_key)[1] AS decision
      FROM triggers t JOIN decision_instances d USING (process_instance_key)
      WHERE decision_definition_id = 'GetScore' AND coalesce(evaluation_date <= trigger_time, TRUE) GROUP BY 1) d USING (trigger_key)""",
    "process_instances", "element_instances", "jobs", "user_tasks", "incidents", "message_subscriptions",
    "decision_instances", "sequence_flows",
    triggers="""
SELECT element_instance_key AS trigger_key, process_instance_key, start_date AS trigger_time FROM element_instances""",
    seen="""
SELECT t.trigger_key, e.*, CASE WHEN e.end_date <= t.trigger_time THEN e.end_date END AS ended
FROM triggers t JOIN element_instances e USING (process_instance_key) WHERE e.start_date <= t.trigger_time""",
    first_views="""
SELECT trigger_key, first.ended AS ended, first.element_instance_key AS first_key
FROM (SELECT trigger_key, arg_min({'ended': ended, 'element_instance_key': element_instance_key},
             (start_date, element_instance_key)) AS first FROM seen WHERE element_id = 'view' GROUP BY 1) x""")


def close_pilot() -> dict:
    return {
        "purchases": counts.execution_count("purchase"), "retries": counts.retry_count(),
        "sla": user_tasks.user_task_sla("", "PT1H"), "minutes": timing.duration("view", "purchase", "minute"),
        "path": counts.path("ALL", "view", "click"),
    }


def stream_close(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of instances, closed by 18 hours of silence, rows up to a day late accepted."""
    elements = event_log.element_instances(_event_stream(spark, folder))
    place = scratch(spark)
    closed = kpi_on_close(elements, close_pilot(), "18 hours", "1 day")
    (
        closed.writeStream.format("parquet").outputMode("append").option("path", f"{place}/sessions")
        .option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema(closed.schema).parquet(f"{place}/sessions")


_CLOSE_SQL = with_tables("""
SELECT s.process_instance_key, s.session_start, s.session_end, s.purchases, s.retries, s.late = 0 AS sla,
       s.views > 0 AND s.clicks > 0 AS path,
       CAST(trunc(floor((epoch_us(p.t) - epoch_us(v.t)) / 1000000) / 60) AS BIGINT) AS minutes
FROM (SELECT process_instance_key, session, min(start_date) AS session_start,
             max(start_date) + INTERVAL 18 HOUR AS session_end,
             count(*) FILTER (WHERE element_id = 'purchase') AS purchases,
             CAST(count(*) - count(DISTINCT element_id) AS BIGINT) AS retries,
             count(*) FILTER (WHERE element_id = 'view') AS views, count(*) FILTER (WHERE element_id = 'click') AS clicks,
             count(*) FILTER (WHERE type = 'USER_TASK' AND end_date - start_date > INTERVAL 1 HOUR) AS late
      FROM sessions GROUP BY 1, 2) s
LEFT JOIN (SELECT process_instance_key, session, arg_min(end_date, (start_date, element_instance_key)) AS t
           FROM sessions WHERE element_id = 'view' AND end_date IS NOT NULL GROUP BY 1, 2) v
     USING (process_instance_key, session)
LEFT JOIN (SELECT process_instance_key, session, arg_min(end_date, (start_date, element_instance_key)) AS t
           FROM sessions WHERE element_id = 'purchase' AND end_date IS NOT NULL GROUP BY 1, 2) p
     USING (process_instance_key, session)
WHERE s.session_end <= (SELECT max(start_date) - INTERVAL 1 DAY FROM element_instances)""",
    "element_instances",
    sessions="""
SELECT *, sum(opens) OVER (PARTITION BY process_instance_key ORDER BY start_date, element_instance_key) AS session
FROM (SELECT *, CASE WHEN start_date <= lag(start_date) OVER (PARTITION BY process_instance_key
      ORDER BY start_date, element_instance_key) + INTERVAL 18 HOUR THEN 0 ELSE 1 END AS opens
      FROM element_instances) x""")



def order_pilot() -> dict:
    return close_pilot() | {
        "wait_ms": timing.latency(), "after_view": timing.latency("view"),
        "tasks": user_tasks.user_task_sla_description("", "PT1H", "minute"),
    }


def stream_close_latency(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions with KPIs that go by the order of their elements."""
    elements = event_log.element_instances(_event_stream(spark, folder))
    place = scratch(spark)
    closed = kpi_on_close(elements, order_pilot(), "18 hours", "1 day")
    (
        closed.writeStream.format("parquet").outputMode("append").option("path", f"{place}/sessions")
        .option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema(closed.schema).parquet(f"{place}/sessions")


def close_sessions_latency(logs: ProcessLogs) -> DataFrame:
    """The same over the whole table."""
    return kpi_on_close(logs.element_instances, order_pilot(), "18 hours", 0)


def close_sessions(logs: ProcessLogs) -> DataFrame:
    """The same over the whole table: every session, the last ones included."""
    return kpi_on_close(logs.element_instances, close_pilot(), "18 hours", 0)


_LAST_WHERE = "WHERE s.session_end <="
_ALL_SESSIONS_SQL = _CLOSE_SQL[: _CLOSE_SQL.index(_LAST_WHERE)]

_ORDER_COLUMNS = """, coalesce(g.wait_ms, 0) AS wait_ms,
       CASE WHEN w.ended IS NOT NULL THEN coalesce((epoch_us(w.following) - epoch_us(w.ended)) // 1000, 0) END AS after_view,
       coalesce(d.tasks, '') AS tasks
FROM (SELECT process_instance_key, session, min(start_date)"""
_ORDER_JOINS = """
LEFT JOIN (SELECT process_instance_key, session,
             CAST(sum(greatest(coalesce((epoch_us(nxt) - epoch_us(end_date)) // 1000, 0), 0)) AS BIGINT) AS wait_ms
      FROM (SELECT *, lead(start_date) OVER (PARTITION BY process_instance_key, session
            ORDER BY start_date, element_instance_key) AS nxt FROM sessions) x GROUP BY 1, 2) g USING (process_instance_key, session)
LEFT JOIN (SELECT f.process_instance_key, f.session, any_value(f.one.end_date) AS ended, min(s.start_date) AS following
      FROM (SELECT process_instance_key, session, arg_min({'end_date': end_date, 'k': element_instance_key},
              (start_date, element_instance_key)) AS one FROM sessions WHERE element_id = 'view' GROUP BY 1, 2) f
      LEFT JOIN sessions s ON s.process_instance_key = f.process_instance_key AND s.session = f.session
           AND s.start_date >= f.one.end_date AND s.element_instance_key <> f.one.k GROUP BY 1, 2) w
     USING (process_instance_key, session)
LEFT JOIN (SELECT process_instance_key, session, string_agg('"' || element_id || '"-'
             || CAST(trunc(floor((epoch_us(end_date) - epoch_us(start_date)) / 1000000) / 60) AS BIGINT) || 'mn'
             || CASE WHEN end_date - start_date <= INTERVAL 1 HOUR THEN '-OK' ELSE '-OVER' END, ', '
             ORDER BY start_date, element_instance_key) AS tasks
      FROM sessions WHERE type = 'USER_TASK' AND end_date IS NOT NULL GROUP BY 1, 2) d USING (process_instance_key, session)
"""
_ALL_IN_ORDER_SQL = _ALL_SESSIONS_SQL.replace(
    "\nFROM (SELECT process_instance_key, session, min(start_date)", _ORDER_COLUMNS, 1
) + _ORDER_JOINS
# A minute later than without an order.
_CLOSE_IN_ORDER_SQL = _ALL_IN_ORDER_SQL + """
WHERE s.session_end + INTERVAL 1 MINUTE <= (SELECT max(start_date) - INTERVAL 1 DAY FROM element_instances)"""

_TASKS = ", ".join(f"'{name}'" for name in filters.TASK_TYPES + filters.GATEWAY_TYPES)

# Name -> (query over the logs, DuckDB SQL)
QUERIES: dict[str, tuple[LogQuery, str]] = {
    **{name: _table(table) for name, table in _TABLES.items()},
    "current_variables": (
        _current,
        with_tables("""
SELECT process_instance_key, max(value) FILTER (WHERE name = 'amount') AS amount,
       max(value) FILTER (WHERE name = 'dueDate') AS dueDate
FROM variables WHERE scope_key = process_instance_key GROUP BY 1""", "variables"),
    ),
    "filter_by_element": _filtered(
        "element_instances", "element_instance_key", lambda df: filters.by_element(df, ["view", "VIEW", "error"]),
        "element_id IN ('view', 'VIEW', 'error')",
    ),
    "filter_by_type": _filtered(
        "element_instances", "element_instance_key", lambda df: filters.by_type(df, "USER_TASK"), "type = 'USER_TASK'"
    ),
    "filter_families": _filtered(
        "element_instances", "element_instance_key", lambda df: filters.by_families(df, "task", "Gateway"),
        f"type IN ({_TASKS})",
    ),
    "filter_jobs": _filtered(
        "jobs", "job_key", lambda df: filters.by_job(df, "BAD_AMOUNT", " "), "error_code = 'BAD_AMOUNT'"
    ),
    "iso_render": (
        _iso,
        with_tables("""
SELECT element_instance_key, replace(CAST(start_date AS VARCHAR), ' ', 'T') || 'Z' AS started,
       replace(CAST(end_date AS VARCHAR), ' ', 'T') || 'Z' AS ended FROM element_instances""", "element_instances"),
    ),
    "kpi_date_types": (_date_types, _DATE_TYPES_SQL),
    "date_roundings": (_roundings, _roundings_sql()),
    "kpi_record": (_record, record_sql(RECORD)),
    "kpi_record_clustered": (record_clustered, record_sql(RECORD)),
    "kpi_errors_observed": (errors_observed, _OBSERVED_SQL),
    "kpi_record_merged": (record_merged, record_sql(MERGED)),
    "kpi_record_fused": (_fused, _fused_sql()),
    "kpi_record_errors": (_errors, _ERRORS_SQL),
    "append_matched": (_sink, _SINK_SQL),
    "demo_pilot": (demo_pilot, _demo_sql()),
    "close_sessions": (close_sessions, _ALL_SESSIONS_SQL),
    "close_sessions_latency": (close_sessions_latency, _ALL_IN_ORDER_SQL),
    "trigger_sweep": (trigger_sweep, _SWEEP_SQL),
    "trigger_incidents": (trigger_incidents, _INCIDENT_SQL),
}

STREAMS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "stream_trigger": (stream_trigger, _TRIGGER_SQL),
    "stream_trigger_wait": (stream_trigger_wait, _WAIT_SQL),
    "stream_close": (stream_close, _CLOSE_SQL),
    "stream_close_latency": (stream_close_latency, _CLOSE_IN_ORDER_SQL),
}
