import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowgauge.schemas import SCHEMAS  # noqa: E402
from flowgauge.sources.logs import ProcessLogs  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        # A zone with daylight saving: results must not depend on it.
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def moment(text):
    return None if text is None else datetime.fromisoformat(text)


def rows(spark, name, *records):
    """A log table from dictionaries; missing columns are null."""
    schema = SCHEMAS[name]
    return spark.createDataFrame([[record.get(c) for c in schema.fieldNames()] for record in records], schema)


def element(key, instance, element_id, start=None, end=None, kind="SERVICE_TASK", **more):
    return {
        "element_instance_key": key, "process_instance_key": instance, "element_id": element_id,
        "element_name": element_id.upper(), "process_definition_id": "demo", "type": kind, "state": "COMPLETED",
        "start_date": moment(start), "end_date": moment(end), "incident": False, "tenant_id": "<default>", **more,
    }


def variable(instance, name, value, scope=None):
    return {
        "variable_key": hash((instance, name, scope)) % 10**9, "process_instance_key": instance,
        "scope_key": instance if scope is None else scope, "name": name, "value": value,
    }


@pytest.fixture(scope="session")
def demo(spark):
    """Hand-built instances: 1-4 after the smoke scenarios, 5 empty, 6 bad amount, 7 loop, 8 negative duration."""
    day = "2024-05-02T"
    elements = [
        element(10, 1, "start", day + "08:00:00", day + "08:00:00", "START_EVENT"),
        element(11, 1, "light", day + "08:00:00", day + "08:00:10.500", "USER_TASK"),
        element(12, 1, "timer", day + "08:00:10.500", day + "08:00:10.500", "BOUNDARY_EVENT"),
        element(20, 2, "start", day + "09:00:00", day + "09:00:00", "START_EVENT"),
        element(21, 2, "review", day + "09:00:01", day + "11:30:00", "USER_TASK"),
        element(22, 2, "review", day + "12:00:00", None, "USER_TASK", state="ACTIVE"),
        element(30, 3, "start", day + "09:00:00", day + "09:00:00", "START_EVENT"),
        element(31, 3, "check", day + "09:00:00", day + "09:00:01"),
        element(32, 3, "BAD_AMOUNT", day + "09:00:01", day + "09:00:01", "BOUNDARY_EVENT"),
        element(40, 4, "start", day + "10:00:00", day + "10:00:00", "START_EVENT"),
        element(41, 4, "call", day + "10:00:00", day + "10:05:00", "CALL_ACTIVITY"),
        element(60, 6, "start", day + "10:01:00", day + "10:01:00", "START_EVENT"),
        element(61, 6, "call", day + "10:02:00", None, "CALL_ACTIVITY"),
        element(70, 7, "a", day + "10:00:00", day + "10:00:01"),
        element(71, 7, "b", day + "10:00:01", day + "10:00:02"),
        element(72, 7, "a", day + "10:00:03", day + "10:00:04"),
        element(73, 7, "b", day + "10:00:05", day + "10:00:06"),
        element(74, 7, "late", None, None),
        element(80, 8, "from", day + "10:00:10", day + "10:00:20"),
        element(81, 8, "to", day + "10:00:00", day + "10:00:05.500"),
    ]
    instances = [
        {"process_instance_key": key, "process_definition_key": 1, "process_definition_id": "demo",
         "process_definition_name": "Demo", "process_definition_version": 3,
         "business_id": f"KPI-2026-000{key}" if key < 5 else None, "tenant_id": "<default>",
         "parent_element_instance_key": {6: 41, 7: 61}.get(key)}
        for key in range(1, 9)
    ]
    amounts = {1: "6000", 2: "6000", 3: "30000", 4: '"30000"', 6: '"many"', 7: "25000.5"}
    variables = [variable(key, "amount", value) for key, value in amounts.items()]
    variables += [
        variable(1, "city", '"Rome"'), variable(2, "amount", "1", scope=999),
        variable(1, "due", '"2024-05-01"'), variable(2, "due", '"2024-05-02T02:00:00+02:00"'),
        variable(3, "due", '"2024-05-02T00:00:00.000001"'), variable(4, "due", '"yesterday"'),
    ]
    tasks = [
        {"user_task_key": 1, "element_instance_key": 21, "process_instance_key": 2, "element_id": "review",
         "assignee": "ann", "creation_date": moment(day + "09:00:01")},
        {"user_task_key": 2, "element_instance_key": 22, "process_instance_key": 2, "element_id": "review",
         "assignee": "bob", "creation_date": None},
        {"user_task_key": 3, "element_instance_key": 22, "process_instance_key": 2, "element_id": "review",
         "assignee": None, "creation_date": moment(day + "08:00:00")},
        {"user_task_key": 4, "element_instance_key": 11, "process_instance_key": 1, "element_id": "light",
         "assignee": None, "creation_date": moment(day + "08:00:00")},
    ]
    jobs = [
        {"job_key": 1, "process_instance_key": 3, "element_id": "check", "error_code": "OLD",
         "last_update_time": moment(day + "09:00:00")},
        {"job_key": 2, "process_instance_key": 3, "element_id": "check", "error_code": "BAD_AMOUNT",
         "last_update_time": None},
        {"job_key": 3, "process_instance_key": 3, "element_id": "check", "error_code": "TIED",
         "last_update_time": None},
        {"job_key": 4, "process_instance_key": 3, "element_id": "other", "error_code": " ",
         "last_update_time": moment(day + "12:00:00")},
    ]
    incidents = [
        {"incident_key": 1, "process_instance_key": 3, "element_id": "check"},
        {"incident_key": 2, "process_instance_key": 3, "element_id": "never"},
    ]
    flows = [
        {"process_instance_key": key, "process_definition_key": 1, "process_definition_id": "demo",
         "element_id": flow, "tenant_id": "<default>"}
        for key, flow in [(1, "F_start_light"), (3, "F_start_check"), (7, "F_a_b"), (7, "F_b_a"), (7, "F_gone"), (5, "F_a_b")]
    ]
    topology = [
        {"process_definition_key": 1, "flow_id": flow, "source_ref": source, "target_ref": target}
        for flow, source, target in [
            ("F_start_light", "start", "light"), ("F_start_check", "start", "check"), ("F_a_b", "a", "b"),
            ("F_b_a", "b", "a"), ("F_gone", "a", "gone"),
        ]
    ]
    made = {
        "element_instances": elements, "process_instances": instances, "variables": variables, "user_tasks": tasks,
        "jobs": jobs, "incidents": incidents, "sequence_flows": flows, "flow_topology": topology,
        "decision_instances": [], "message_subscriptions": [],
    }
    return ProcessLogs.of(**{name: rows(spark, name, *records) for name, records in made.items()})


def by_instance(df, column="value"):
    return {row["process_instance_key"]: row[column] for row in df.collect()}
