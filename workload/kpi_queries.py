"""Per-instance KPIs: each as a Spark query over the derived logs and as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from flowgauge.operators import counts, latest, projections, timing, user_tasks, variables
from flowgauge.operators.kpi import Kpi
from workload.tables import with_tables

AS_OF = "2024-03-10 07:45:30.25"


def as_of():
    from datetime import datetime

    return datetime.fromisoformat(AS_OF)


def per_instance(value: str, source: str, *tables: str) -> str:
    """SQL: ``value`` per instance over ``source``, attached to the spine."""
    query = f"""
SELECT p.process_instance_key, {value} AS value
FROM process_instances p LEFT JOIN ({source}) x ON x.process_instance_key = p.process_instance_key"""
    return with_tables(query, "process_instances", *tables)


def counted(table: str, condition: str = "TRUE") -> str:
    return per_instance(
        "CAST(coalesce(x.n, 0) AS BIGINT)",
        f"SELECT process_instance_key, count(*) AS n FROM {table} WHERE {condition} GROUP BY 1", table,
    )


def first_by(table: str, value: str, order: str, condition: str = "TRUE", default: str = "NULL") -> str:
    source = f"""SELECT process_instance_key, v FROM (SELECT process_instance_key, {value} AS v,
        row_number() OVER (PARTITION BY process_instance_key ORDER BY {order}) AS rn
        FROM {table} WHERE {condition}) r WHERE rn = 1"""
    return per_instance(f"coalesce(x.v, {default})", source, table)


def spine_value(expression: str) -> str:
    return with_tables(
        f"SELECT process_instance_key, {expression} AS value FROM process_instances p", "process_instances"
    )


def root_variable(value: str, name: str) -> str:
    """SQL over the root-scope value ``v`` of one variable, as text without JSON quotes."""
    source = f"""SELECT process_instance_key, json_extract_string(value, '$') AS v FROM variables
        WHERE scope_key = process_instance_key AND name = '{name}'"""
    return per_instance(value, source, "variables")


_NON_BLANK = "error_code IS NOT NULL AND trim(error_code) <> ''"
_NEWEST_JOB = "last_update_time IS NOT NULL, last_update_time DESC, job_key"
_MICROS = "(epoch_us({b}) - epoch_us({a}))"


def _path(test: str) -> str:
    return per_instance(
        test,
        """SELECT process_instance_key, list_distinct(list(element_id)) AS ids
           FROM element_instances GROUP BY 1""",
        "element_instances",
    )


def _edge(column: str, element: str) -> str:
    return f"""SELECT process_instance_key, {column} AS t FROM (SELECT *, row_number() OVER (
        PARTITION BY process_instance_key ORDER BY start_date, element_instance_key) AS rn
        FROM element_instances WHERE element_id = '{element}' AND {column} IS NOT NULL) r WHERE rn = 1"""


_DURATION = f"""SELECT a.process_instance_key, epoch_us(b.t) - epoch_us(a.t) AS us
    FROM ({_edge('end_date', 'view')}) a JOIN ({_edge('end_date', 'purchase')}) b USING (process_instance_key)"""

_SLA_TEXT = """SELECT process_instance_key, string_agg(
    '"' || element_id || '"-' || CAST((epoch_us(end_date) - epoch_us(start_date)) // 60000000 AS VARCHAR) || 'mn-'
    || CASE WHEN end_date - start_date > INTERVAL 1 HOUR THEN 'OVER' ELSE 'OK' END,
    ', ' ORDER BY start_date, element_instance_key) AS v
  FROM element_instances WHERE type = 'USER_TASK' AND end_date IS NOT NULL GROUP BY 1"""

_LATENCY = """SELECT a.process_instance_key, sum(greatest((epoch_us(b.start_date) - epoch_us(a.end_date)) // 1000, 0)) AS ms
  FROM numbered a JOIN numbered b ON b.process_instance_key = a.process_instance_key AND b.rn = a.rn + 1
  WHERE a.end_date IS NOT NULL GROUP BY 1"""

_NUMBERED = """
SELECT *, row_number() OVER (PARTITION BY process_instance_key ORDER BY start_date, element_instance_key) AS rn
FROM element_instances WHERE start_date IS NOT NULL"""

_LATENCY_ONE = """
SELECT p.process_instance_key,
       CASE WHEN f.end_date IS NOT NULL THEN coalesce(CAST((
            SELECT min(epoch_us(e.start_date)) FROM element_instances e
            WHERE e.process_instance_key = f.process_instance_key
              AND e.element_instance_key <> f.element_instance_key AND e.start_date >= f.end_date)
            - epoch_us(f.end_date) AS BIGINT) // 1000, 0) END AS value
FROM process_instances p LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY process_instance_key ORDER BY start_date, element_instance_key) AS rn
        FROM element_instances WHERE element_id = 'purchase' AND start_date IS NOT NULL) r WHERE rn = 1) f
  ON f.process_instance_key = p.process_instance_key"""

_PATH_FLOWS = """
SELECT p.process_instance_key, EXISTS (
    SELECT 1 FROM (SELECT process_instance_key, element_id FROM element_instances
                   UNION ALL SELECT process_instance_key, element_id FROM sequence_flows) u
    WHERE u.process_instance_key = p.process_instance_key
      AND u.element_id IN ('Flow_view_purchase', 'Flow_signup_click')) AS value
FROM process_instances p"""

_INCIDENT_ELEMENT = """
SELECT p.process_instance_key, CAST(coalesce(x.n, 0) AS BIGINT) AS value
FROM process_instances p LEFT JOIN (
    SELECT i.process_instance_key, count(*) AS n FROM incidents i
    WHERE i.element_id = 'click' AND (i.process_instance_key, i.element_id) IN (
        SELECT process_instance_key, element_id FROM element_instances)
    GROUP BY 1) x ON x.process_instance_key = p.process_instance_key"""

# Name -> (KPI builder, DuckDB SQL)
KPIS: dict[str, tuple[Callable[[], Kpi], str]] = {
    "kpi_constant": (lambda: projections.constant(42), spine_value("CAST(42 AS INTEGER)")),
    "kpi_tag": (lambda: projections.tag("demo"), spine_value("'demo'")),
    "kpi_variable": (
        lambda: variables.variable("amount", "bigint"), root_variable("CAST(x.v AS BIGINT)", "amount"),
    ),
    "kpi_instance_key": (projections.process_instance_key, spine_value("p.process_instance_key")),
    "kpi_business_key": (projections.business_key, spine_value("p.business_id")),
    "kpi_process_property": (
        lambda: projections.process_property("processDefinitionVersion"),
        spine_value("p.process_definition_version"),
    ),
    "kpi_expr_variable": (
        lambda: variables.expr(
            "concat_ws(' / ', dueDate, CAST(amount DIV 100 AS STRING))", {"amount": "bigint", "dueDate": "string"}
        ),
        with_tables("""
SELECT p.process_instance_key, CASE WHEN a.v IS NOT NULL OR d.v IS NOT NULL THEN
       concat_ws(' / ', d.v, CAST(CAST(a.v AS BIGINT) // 100 AS VARCHAR)) END AS value
FROM process_instances p
LEFT JOIN (SELECT process_instance_key, json_extract_string(value, '$') AS v FROM variables
           WHERE scope_key = process_instance_key AND name = 'amount') a USING (process_instance_key)
LEFT JOIN (SELECT process_instance_key, json_extract_string(value, '$') AS v FROM variables
           WHERE scope_key = process_instance_key AND name = 'dueDate') d USING (process_instance_key)""",
            "process_instances", "variables"),
    ),
    "kpi_execution_count": (
        lambda: counts.execution_count("purchase"), counted("element_instances", "element_id = 'purchase'"),
    ),
    "kpi_retry_count": (
        lambda: counts.retry_count("view"),
        per_instance(
            "CAST(greatest(coalesce(x.n, 0) - 1, 0) AS BIGINT)",
            "SELECT process_instance_key, count(*) AS n FROM element_instances WHERE element_id = 'view' GROUP BY 1",
            "element_instances",
        ),
    ),
    "kpi_retry_count_total": (
        counts.retry_count,
        per_instance(
            "CAST(coalesce(x.n, 0) AS BIGINT)",
            """SELECT process_instance_key, sum(n - 1) AS n FROM (
               SELECT process_instance_key, element_id, count(*) AS n FROM element_instances GROUP BY 1, 2) c
               GROUP BY 1""",
            "element_instances",
        ),
    ),
    "kpi_incident_count": (counts.incident_count, counted("incidents")),
    "kpi_incident_count_element": (
        lambda: counts.incident_count("click"),
        with_tables(_INCIDENT_ELEMENT, "process_instances", "incidents", "element_instances"),
    ),
    "kpi_message_count": (
        lambda: counts.message_count("KpiStatus"), counted("message_subscriptions", "message_name = 'KpiStatus'"),
    ),
    "kpi_message_count_all": (counts.message_count, counted("message_subscriptions")),
    "kpi_variable_changed": (
        lambda: counts.variable_changed_count("amount"),
        per_instance(
            "CAST(coalesce(x.n, 0) AS BIGINT)",
            """SELECT process_instance_key, count(DISTINCT scope_key) AS n FROM variables
               WHERE name = 'amount' GROUP BY 1""",
            "variables",
        ),
    ),
    "kpi_bpm_error_count": (
        lambda: counts.bpm_error_count("BAD_AMOUNT", "error"),
        counted("jobs", "error_code = 'BAD_AMOUNT' AND element_id = 'error'"),
    ),
    "kpi_bpm_error_count_all": (counts.bpm_error_count, counted("jobs", _NON_BLANK)),
    "kpi_boundary_error_count": (
        lambda: counts.boundary_error_count("ERROR"),
        counted("element_instances", "type = 'BOUNDARY_EVENT' AND (element_id = 'ERROR' OR element_name = 'ERROR')"),
    ),
    "kpi_bpmn_error_count": (counts.bpmn_error_count, counted("jobs", _NON_BLANK)),
    "kpi_bpmn_error": (latest.bpmn_error, first_by("jobs", "error_code", _NEWEST_JOB, _NON_BLANK)),
    "kpi_bpmn_error_element": (
        lambda: latest.bpmn_error("view"),
        first_by("jobs", "error_code", _NEWEST_JOB, f"{_NON_BLANK} AND element_id = 'view'"),
    ),
    "kpi_decision_result": (
        lambda: latest.decision_result("GetRiskLevel"),
        first_by(
            "decision_instances", "result",
            "evaluation_date IS NOT NULL, evaluation_date DESC, decision_instance_key",
            "decision_definition_id = 'GetRiskLevel'",
        ),
    ),
    "kpi_path_all": (
        lambda: counts.path("ALL", "view", "purchase", "error", "view"),
        _path("coalesce(list_has_all(x.ids, ['view', 'purchase', 'error']), FALSE)"),
    ),
    "kpi_path_any": (
        lambda: counts.path("any", "signup", "missing"),
        _path("coalesce(list_has_any(x.ids, ['signup', 'missing']), FALSE)"),
    ),
    "kpi_path_nothing": (
        lambda: counts.path("NOTHING", "error", "signup"),
        _path("NOT coalesce(list_has_any(x.ids, ['error', 'signup']), FALSE)"),
    ),
    "kpi_path_flows": (
        lambda: counts.path("ANY", "Flow_view_purchase", "Flow_signup_click", include_flows=True),
        with_tables(_PATH_FLOWS, "process_instances", "element_instances", "sequence_flows"),
    ),
    "kpi_user_task_sla": (
        lambda: user_tasks.user_task_sla("click", "PT1H30M"),
        per_instance(
            "coalesce(x.late, 0) = 0",
            """SELECT process_instance_key, count(*) FILTER (WHERE end_date - start_date > INTERVAL 90 MINUTE) AS late
               FROM element_instances WHERE type = 'USER_TASK' AND element_id = 'click' AND end_date IS NOT NULL
               GROUP BY 1""",
            "element_instances",
        ),
    ),
    "kpi_user_task_sla_desc": (
        lambda: user_tasks.user_task_sla_description("", "PT1H", "minute"),
        per_instance("coalesce(x.v, '')", _SLA_TEXT, "element_instances"),
    ),
    "kpi_assignee_first": (
        user_tasks.user_task_assignee,
        first_by("user_tasks", "assignee", "creation_date NULLS LAST, user_task_key", "assignee IS NOT NULL", "''"),
    ),
    "kpi_assignee_last": (
        lambda: user_tasks.user_task_assignee("click", "LAST"),
        first_by(
            "user_tasks", "assignee", "creation_date IS NOT NULL, creation_date DESC, user_task_key DESC",
            "assignee IS NOT NULL", "''",
        ),
    ),
    "kpi_assignee_all": (
        lambda: user_tasks.user_task_assignee(mode="all"),
        per_instance(
            "coalesce(x.v, '')",
            """SELECT process_instance_key, string_agg(assignee, ',' ORDER BY creation_date NULLS LAST, user_task_key) AS v
               FROM user_tasks WHERE assignee IS NOT NULL GROUP BY 1""",
            "user_tasks",
        ),
    ),
    "kpi_latency_total": (
        timing.latency,
        with_tables(
            f"""SELECT p.process_instance_key, CAST(coalesce(x.ms, 0) AS BIGINT) AS value
FROM process_instances p LEFT JOIN ({_LATENCY}) x ON x.process_instance_key = p.process_instance_key""",
            "process_instances", "element_instances", numbered=_NUMBERED,
        ),
    ),
    "kpi_latency_element": (
        lambda: timing.latency("purchase"), with_tables(_LATENCY_ONE, "process_instances", "element_instances"),
    ),
    "kpi_duration": (
        lambda: timing.duration("view", "purchase:END", "Hour"),
        per_instance(
            "CAST(trunc(floor(x.us / 1000000) / 3600) AS BIGINT)", _DURATION, "element_instances",
        ),
    ),
    "kpi_duration_ms": (
        lambda: timing.duration("view", "purchase"),
        per_instance("CAST(trunc(x.us / 1000) AS BIGINT)", _DURATION, "element_instances"),
    ),
    "kpi_duration_second": (
        lambda: timing.duration("view", "purchase", "second"),
        per_instance("CAST(floor(x.us / 1000000) AS BIGINT)", _DURATION, "element_instances"),
    ),
    "kpi_threshold": (
        lambda: variables.threshold("amount", ">=", 2500),
        root_variable("CAST(x.v AS DOUBLE) >= 2500", "amount"),
    ),
    "kpi_threshold_date": (
        lambda: variables.threshold("dueDate", "before", "2024-01-15T12:00:00+02:00"),
        root_variable("CAST(x.v AS TIMESTAMP) < TIMESTAMP '2024-01-15 10:00:00'", "dueDate"),
    ),
    "kpi_bucket": (
        lambda: variables.bucket("amount", [(5000, "HIGH"), (0, "LOW"), (1000, "old"), (1000, "MEDIUM")]),
        root_variable(
            """CASE WHEN CAST(x.v AS DOUBLE) >= 5000 THEN 'HIGH' WHEN CAST(x.v AS DOUBLE) >= 1000 THEN 'MEDIUM'
               WHEN CAST(x.v AS DOUBLE) >= 0 THEN 'LOW' END""",
            "amount",
        ),
    ),
    "kpi_date": (
        lambda: projections.date("DAY", "LocalDateTime", "America/New_York", as_of()),
        spine_value("TIMESTAMP '2024-03-10 00:00:00'"),
    ),
    "kpi_date_text": (
        lambda: projections.date("SECOND", "STRING", "+07:00", as_of()), spine_value("'2024-03-10T14:45:30'"),
    ),
}
