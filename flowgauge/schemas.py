"""Published schemas of the process-log tables.

All timestamps are zone-less UTC. Every table but ``definitions`` carries
``process_instance_key``, the key all KPIs are grouped by.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

KEY = "process_instance_key"

_LONG, _INT, _TEXT, _FLAG, _TIME = LongType(), IntegerType(), StringType(), BooleanType(), TimestampNTZType()


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


SCHEMAS: dict[str, StructType] = {
    "element_instances": _schema(
        element_instance_key=_LONG, process_instance_key=_LONG, element_id=_TEXT, element_name=_TEXT,
        process_definition_id=_TEXT, type=_TEXT, state=_TEXT, start_date=_TIME, end_date=_TIME,
        incident=_FLAG, incident_key=_LONG, tenant_id=_TEXT,
    ),
    # One row per instance: the spine every KPI is attached to.
    "process_instances": _schema(
        process_instance_key=_LONG, process_definition_key=_LONG, process_definition_id=_TEXT,
        process_definition_name=_TEXT, process_definition_version=_INT, business_id=_TEXT,
        parent_element_instance_key=_LONG, tenant_id=_TEXT,
    ),
    "user_tasks": _schema(
        user_task_key=_LONG, element_instance_key=_LONG, process_instance_key=_LONG, element_id=_TEXT,
        assignee=_TEXT, creation_date=_TIME,
    ),
    "jobs": _schema(
        job_key=_LONG, process_instance_key=_LONG, element_id=_TEXT, error_code=_TEXT, last_update_time=_TIME,
    ),
    "incidents": _schema(incident_key=_LONG, process_instance_key=_LONG, element_id=_TEXT, creation_time=_TIME),
    # One row per (scope, name), holding the current value as JSON text.
    "variables": _schema(
        variable_key=_LONG, process_instance_key=_LONG, scope_key=_LONG, name=_TEXT, value=_TEXT,
    ),
    "decision_instances": _schema(
        decision_instance_key=_LONG, process_instance_key=_LONG, decision_definition_id=_TEXT,
        evaluation_date=_TIME, result=_TEXT,
    ),
    # Correlated messages only, never subscriptions that are still open.
    "message_subscriptions": _schema(
        subscription_key=_LONG, process_instance_key=_LONG, message_name=_TEXT, correlation_time=_TIME,
    ),
    # Flows taken; no time and no ends, those come from flow_topology.
    "sequence_flows": _schema(
        process_instance_key=_LONG, process_definition_key=_LONG, process_definition_id=_TEXT,
        element_id=_TEXT, tenant_id=_TEXT,
    ),
    "flow_topology": _schema(process_definition_key=_LONG, flow_id=_TEXT, source_ref=_TEXT, target_ref=_TEXT),
    "definitions": _schema(process_definition_key=_LONG, xml=_TEXT),
}

# The column that says when a row became visible; None means the table has no clock.
CLOCKS: dict[str, str | None] = {
    "element_instances": "start_date",
    "process_instances": None,
    "user_tasks": "creation_date",
    "jobs": "last_update_time",
    "incidents": "creation_time",
    "variables": None,
    "decision_instances": "evaluation_date",
    "message_subscriptions": "correlation_time",
    "sequence_flows": None,
}
