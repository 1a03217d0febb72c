"""Process logs derived from an event stream table.

``events(event_id, ts, user_id, event_type, value, props)`` is read as a process log:
an instance is one user in one week of the month, an element is one event, and start
dates are cut to the hour so that ties occur. A week's last signup calls the next
week's instance in weeks 1, 2 and 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgauge.sources.logs import ProcessLogs

# Width of the id ranges the "previous event" is looked up in, so that a user-week
# of any length is ordered by many tasks.
EVENT_RANGE = 1_000_000


def prepared_events(events: DataFrame) -> DataFrame:
    """Events with instance key, week and hour."""
    week = F.floor((F.day("ts") - 1) / 7).cast("bigint")
    hour = F.col("ts").cast("date").cast("timestamp_ntz") + F.expr("INTERVAL '1' HOUR") * F.hour("ts")
    return events.select(
        "event_id", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        week.alias("w"),
        (F.col("user_id") * 100 + week).alias("pik"),
        hour.alias("sd"),
    )


def _end() -> F.Column:
    """Start plus ``value`` minutes, to the millisecond."""
    return F.col("sd") + F.expr("INTERVAL '0.001' SECOND") * F.round(F.col("value") * 60000).cast("bigint")


def _null_when(condition, otherwise):
    return F.when(~condition, otherwise)


def element_instances(ev: DataFrame) -> DataFrame:
    kind, k = F.col("event_type"), F.col("k")
    incident = (kind == "error") & (k % 3 == 0)
    return ev.select(
        F.col("event_id").alias("element_instance_key"), F.col("pik").alias("process_instance_key"),
        kind.alias("element_id"), F.upper(kind).alias("element_name"),
        F.lit("user-week").alias("process_definition_id"),
        F.when(kind == "view", F.when(k % 5 == 0, "EXCLUSIVE_GATEWAY").otherwise("SERVICE_TASK"))
        .when(kind == "click", "USER_TASK").when(kind == "purchase", "BUSINESS_RULE_TASK")
        .when(kind == "signup", "CALL_ACTIVITY").otherwise("BOUNDARY_EVENT").alias("type"),
        F.when(k % 10 == 0, "ACTIVE").when(k % 7 == 0, "TERMINATED").otherwise("COMPLETED").alias("state"),
        F.col("sd").alias("start_date"), _null_when(k % 10 == 0, _end()).alias("end_date"),
        incident.alias("incident"), F.when(incident, F.col("event_id") + 1_000_000_000).alias("incident_key"),
        F.lit("<default>").alias("tenant_id"),
    )


def process_instances(ev: DataFrame) -> DataFrame:
    weeks = ev.groupBy("pik", "user_id", "w").agg(
        F.max(F.when(F.col("event_type") == "signup", F.col("event_id"))).alias("last_signup")
    )
    called_by = weeks.select((F.col("pik") + 1).alias("pik"), F.col("last_signup").alias("caller"))
    w = F.col("w")
    return weeks.drop("last_signup").join(called_by, "pik", "left").select(
        F.col("pik").alias("process_instance_key"), (1 + w % 3).alias("process_definition_key"),
        F.lit("user-week").alias("process_definition_id"), F.lit("User week").alias("process_definition_name"),
        (1 + w % 3).cast("int").alias("process_definition_version"),
        F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("-W"), w.cast("string")).alias("business_id"),
        F.when(w.isin(1, 2, 4), F.col("caller")).alias("parent_element_instance_key"),
        F.lit("<default>").alias("tenant_id"),
    )


def user_tasks(ev: DataFrame) -> DataFrame:
    k = F.col("k")
    name = F.concat(F.lit("user"), (F.col("event_id") % 7).cast("string"))
    return ev.filter(F.col("event_type") == "click").select(
        (F.col("event_id") + 2_000_000_000).alias("user_task_key"),
        F.col("event_id").alias("element_instance_key"), F.col("pik").alias("process_instance_key"),
        F.col("event_type").alias("element_id"), _null_when(k % 4 == 0, name).alias("assignee"),
        _null_when(k % 11 == 0, F.col("sd")).alias("creation_date"),
    )


def jobs(ev: DataFrame) -> DataFrame:
    kind, k = F.col("event_type"), F.col("k")
    code = F.when(kind == "error", F.when(k % 3 == 0, "BAD_AMOUNT").when(k % 3 == 1, "BAD_ACCOUNT").otherwise(""))
    return ev.filter(kind.isin("view", "error", "purchase")).select(
        (F.col("event_id") + 3_000_000_000).alias("job_key"), F.col("pik").alias("process_instance_key"),
        kind.alias("element_id"), code.when(k % 13 == 0, "BAD_AMOUNT").alias("error_code"),
        _null_when(k % 10 == 0, _end()).alias("last_update_time"),
    )


def incidents(ev: DataFrame) -> DataFrame:
    return ev.filter((F.col("event_type") == "error") & (F.col("k") % 3 == 0)).select(
        (F.col("event_id") + 1_000_000_000).alias("incident_key"), F.col("pik").alias("process_instance_key"),
        F.when(F.col("k") % 2 == 0, "error").otherwise("click").alias("element_id"),
        F.col("sd").alias("creation_time"),
    )


def variables(ev: DataFrame) -> DataFrame:
    """Root scope for an instance's last purchase or signup, own scopes for earlier ones."""
    kept = ev.filter(F.col("event_type").isin("purchase", "signup"))
    # The newest row per (instance, type) by aggregate and join: no window over a whole instance.
    newest = kept.groupBy("pik", "event_type").agg(F.max("event_id").alias("event_id")).select(
        "event_id", F.lit(True).alias("is_newest")
    )
    bought = F.col("event_type") == "purchase"
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    day = F.concat(F.lit('"'), F.substring(F.col("sd").cast("string"), 1, 10), F.lit('"'))
    return kept.join(newest, "event_id", "left").select(
        (F.col("event_id") + 4_000_000_000).alias("variable_key"), F.col("pik").alias("process_instance_key"),
        F.when(F.col("is_newest"), F.col("pik")).otherwise(F.col("event_id") + 9_000_000_000).alias("scope_key"),
        F.when(bought, "amount").otherwise("dueDate").alias("name"),
        F.when(bought, cents).otherwise(day).alias("value"),
    )


def decision_instances(ev: DataFrame) -> DataFrame:
    k, value = F.col("k"), F.col("value")
    level = F.when(value < 10, "GREEN").when(value < 50, "ORANGE").otherwise("RED")
    return ev.filter(F.col("event_type") == "purchase").select(
        (F.col("event_id") + 5_000_000_000).alias("decision_instance_key"),
        F.col("pik").alias("process_instance_key"),
        F.when(k % 2 == 0, "GetRiskLevel").otherwise("GetScore").alias("decision_definition_id"),
        _null_when(k % 17 == 0, F.col("sd")).alias("evaluation_date"),
        F.concat(F.lit('{"riskLevel":"'), level, F.lit('"}')).alias("result"),
    )


def message_subscriptions(ev: DataFrame) -> DataFrame:
    return ev.filter((F.col("event_type") == "view") & (F.col("k") % 3 == 0)).select(
        (F.col("event_id") + 6_000_000_000).alias("subscription_key"),
        F.col("pik").alias("process_instance_key"),
        F.when(F.col("k") % 2 == 0, "KpiStatus").otherwise("Other").alias("message_name"),
        F.col("sd").alias("correlation_time"),
    )


def sequence_flows(ev: DataFrame) -> DataFrame:
    """Distinct steps from one event of an instance to the next, in id order.

    Steps inside an id range come from ``lag``; steps between ranges come from the
    last event of one range and the first of the next.
    """
    part = F.floor(F.col("event_id") / EVENT_RANGE)
    rows = ev.select("pik", "w", "event_id", "event_type", part.alias("part"))
    inside = rows.withColumn(
        "prev", F.lag("event_type").over(Window.partitionBy("pik", "w", "part").orderBy("event_id"))
    )
    parts = rows.groupBy("pik", "w", "part").agg(
        F.min_by("event_type", "event_id").alias("event_type"), F.max_by("event_type", "event_id").alias("last")
    )
    between = parts.withColumn("prev", F.lag("last").over(Window.partitionBy("pik", "w").orderBy("part")))
    steps = inside.select("pik", "w", "prev", "event_type").unionByName(
        between.select("pik", "w", "prev", "event_type")
    )
    return steps.filter(F.col("prev").isNotNull()).distinct().select(
        F.col("pik").alias("process_instance_key"), (1 + F.col("w") % 3).alias("process_definition_key"),
        F.lit("user-week").alias("process_definition_id"),
        F.concat(F.lit("Flow_"), F.col("prev"), F.lit("_"), F.col("event_type")).alias("element_id"),
        F.lit("<default>").alias("tenant_id"),
    )


def flow_topology(ev: DataFrame) -> DataFrame:
    """Every step between two event types, per definition; the self-loop of error has no target."""
    # Bounded: event types and definition keys are two small code lists.
    lists = ev.agg(
        F.collect_set("event_type").alias("types"), F.collect_set(1 + F.col("w") % 3).alias("keys")
    )
    source, target = F.col("source_ref"), F.col("target")
    return (
        lists.select("types", "keys", F.explode("types").alias("source_ref"))
        .select("keys", "source_ref", F.explode("types").alias("target"))
        .select(
            F.explode("keys").alias("process_definition_key"),
            F.concat(F.lit("Flow_"), source, F.lit("_"), target).alias("flow_id"),
            "source_ref",
            F.when(~((source == "error") & (target == "error")), target).alias("target_ref"),
        )
    )


def definitions(flows: DataFrame) -> DataFrame:
    """One process-definition XML document per instance, listing the flows it took.

    The documents hold what a parser has to cope with: a namespace prefix, nesting,
    line breaks inside tags, a flow in a comment, a flow without id, a flow without
    target; one instance in ten has a document that is not well-formed.
    """
    ends = F.split(F.col("element_id"), "_")
    tag = F.concat(
        F.lit('<bpmn:sequenceFlow id="'), F.col("element_id"), F.lit('"\n  sourceRef="'), ends[1], F.lit('"'),
        F.when(F.col("element_id") == "Flow_error_error", F.lit(""))
        .otherwise(F.concat(F.lit(" targetRef='"), ends[2], F.lit("'"))),
        F.lit("/>"),
    )
    # At most one tag per pair of event types, so the text of a document is bounded.
    documents = flows.groupBy("process_instance_key").agg(F.array_sort(F.collect_set(tag)).alias("tags"))
    key = F.col("process_instance_key")
    head = F.lit(
        '<?xml version="1.0" encoding="UTF-8"?>\n'
        '<bpmn:definitions xmlns:bpmn="http://www.omg.org/spec/BPMN/20100524/MODEL"><bpmn:process id="p">'
        '<bpmn:subProcess id="s">'
    )
    inner = F.lit(
        '</bpmn:subProcess><!-- <bpmn:sequenceFlow id="old" sourceRef="a" targetRef="b"/> -->'
        '<bpmn:sequenceFlow sourceRef="a" targetRef="b"/></bpmn:process>'
    )
    tail = F.when(key % 10 == 0, F.lit("</bpmn:wrong>")).otherwise(F.lit("</bpmn:definitions>"))
    return documents.select(
        key.alias("process_definition_key"),
        F.concat(head, F.array_join("tags", ""), inner, tail).alias("xml"),
    )


def logs_from_events(spark: SparkSession, folder: str) -> ProcessLogs:
    """The log tables over ``<folder>/events.parquet``."""
    ev = prepared_events(spark.read.parquet(f"{folder}/events.parquet"))
    build = {
        maker.__name__: maker
        for maker in (
            element_instances, process_instances, user_tasks, jobs, incidents, variables,
            decision_instances, message_subscriptions, sequence_flows, flow_topology,
        )
    }
    build["definitions"] = lambda frame: definitions(sequence_flows(frame))
    return ProcessLogs(lambda name: build[name](ev))
