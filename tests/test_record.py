"""Edge rules of single KPIs on hand-built instances."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowgauge.errors import KpiError
from flowgauge.functions.clock import packed_order
from flowgauge.operators import counts, filters, latest, projections, timing, user_tasks, variables
from flowgauge.plans.history import history
from flowgauge.plans.record import ERRORS, kpi_record, single_kpi
from flowgauge.schemas import KEY
from flowgauge.sources.logs import read_logs
from tests.conftest import by_instance, moment, rows


def values(logs, kpi):
    return by_instance(single_kpi(logs, kpi))


def test_defaults_of_an_instance_without_rows(demo):
    record = kpi_record(demo, {
        "runs": counts.execution_count("start"), "retries": counts.retry_count(), "one": counts.retry_count("a"),
        "incidents": counts.incident_count(), "on_element": counts.incident_count("check"),
        "messages": counts.message_count(), "changed": counts.variable_changed_count("amount"),
        "errors": counts.bpmn_error_count(), "last": latest.bpmn_error(), "decision": latest.decision_result("d"),
        "every": counts.path("ALL", "a"), "some": counts.path("ANY", "a"), "none": counts.path("NOTHING", "a"),
        "sla": user_tasks.user_task_sla("", "PT1H"), "text": user_tasks.user_task_sla_description("", "PT1H"),
        "assignee": user_tasks.user_task_assignee(), "everyone": user_tasks.user_task_assignee(mode="ALL"),
        "wait": timing.latency(), "after": timing.latency("a"), "took": timing.duration("a", "b"),
        "amount": variables.variable("amount"), "high": variables.threshold("amount", ">", 1),
        "band": variables.bucket("amount", [(0, "low")]), "label": projections.tag("x"),
        "list": history(), "text_list": history("STRING"),
    })
    row = record.filter("process_instance_key = 5").first().asDict()
    del row["process_instance_key"]
    assert row.pop(ERRORS) == []
    zeros = {"runs", "retries", "one", "incidents", "on_element", "messages", "changed", "errors", "wait"}
    nulls = {"last", "decision", "after", "took", "amount", "high", "band"}
    assert row == dict.fromkeys(zeros, 0) | dict.fromkeys(nulls) | {
        "every": False, "some": False, "none": True, "sla": True, "text": "", "assignee": "", "everyone": "",
        "label": "x", "list": "[]", "text_list": "",
    }


def test_columns_keep_pilot_order_and_constants_any_type(demo):
    record = kpi_record(demo, {
        "z": 1, "a": "text", "flag": True, "nothing": None, "list": [1, {"k": "v"}],
        "computed": F.lit(2) + 1, "m": projections.process_property("tenantId"),
    })
    assert record.columns == ["process_instance_key", "z", "a", "flag", "nothing", "list", "computed", "m"]
    assert record.first().asDict() | {"process_instance_key": 0} == {
        "process_instance_key": 0, "z": 1, "a": "text", "flag": True, "nothing": None, "list": '[1, {"k": "v"}]',
        "computed": 3, "m": "<default>",
    }


def test_most_recent_error_prefers_undated_then_smallest_key(demo):
    assert values(demo, latest.bpmn_error())[3] == "BAD_AMOUNT"
    assert values(demo, latest.bpmn_error("other"))[3] is None
    assert values(demo, counts.bpm_error_count())[3] == 3
    assert values(demo, counts.bpm_error_count("TIED"))[3] == 1
    assert values(demo, counts.boundary_error_count("BAD_AMOUNT"))[3] == 1


def test_incident_counts_only_on_executed_elements(demo):
    assert values(demo, counts.incident_count())[3] == 2
    assert values(demo, counts.incident_count("check"))[3] == 1
    assert values(demo, counts.incident_count("never"))[3] == 0


def test_retries_and_paths(demo):
    assert values(demo, counts.retry_count())[7] == 2
    assert values(demo, counts.path("all", "a", "b", "a"))[7] is True
    flows = counts.path("ANY", "F_a_b", include_flows=True)
    assert {key for key, taken in values(demo, flows).items() if taken} == {5, 7}
    assert not any(values(demo, counts.path("ANY", "F_a_b")).values())


def test_user_tasks(demo):
    exact = user_tasks.user_task_sla("light", "PT10.5S")
    assert values(demo, exact)[1] is True
    assert values(demo, user_tasks.user_task_sla("light", "PT10.4S"))[1] is False
    assert values(demo, user_tasks.user_task_sla_description("", "PT1H", "Minute"))[2] == '"review"-149mn-OVER'
    assert values(demo, user_tasks.user_task_assignee("review", "ALL"))[2] == "ann,bob"
    assert values(demo, user_tasks.user_task_assignee("", "LAST"))[2] == "bob"
    assert values(demo, user_tasks.user_task_assignee())[1] == ""


def test_durations_round_like_elapsed_time(demo):
    def took(unit):
        return values(demo, timing.duration("from", "to", unit))[8]

    # From 10:00:20 back to 10:00:05.5.
    assert (took("MS"), took("unknown"), took("Second"), took("minute"), took("WEEK")) == (-14500, -14500, -15, 0, 0)
    assert values(demo, timing.duration("from:START", "to: start"))[8] == -10000
    assert values(demo, timing.duration("FROM", "TO", match="name_or_id"))[8] == -14500


def test_latency(demo):
    total = values(demo, timing.latency())
    assert total[7] == 2000 and total[2] == 1000 + 30 * 60 * 1000
    after = values(demo, timing.latency("a"))
    assert after[7] == 0 and after[1] is None
    assert values(demo, timing.latency("b"))[7] == 1000
    assert values(demo, timing.latency("review"))[2] == 1800000
    assert values(demo, timing.latency("call"))[6] is None
    assert values(demo, timing.latency("timer"))[1] == 0


def test_variables(demo):
    assert values(demo, variables.variable("amount"))[4] == "30000"
    assert values(demo, variables.variable("amount", "double")) == {
        1: 6000.0, 2: 6000.0, 3: 30000.0, 4: 30000.0, 5: None, 6: None, 7: 25000.5, 8: None,
    }
    assert values(demo, counts.variable_changed_count("amount"))[2] == 2
    text = variables.expr("concat(city, ' ', amount)", {"city": "string", "amount": "string"})
    assert values(demo, text) == {1: "Rome 6000"} | dict.fromkeys(range(2, 9))
    date = values(demo, variables.threshold("due", "after", "2024-05-02"))
    assert (date[1], date[2], date[3], date[4], date[5]) == (False, False, True, None, None)


def test_bad_values_are_reported_or_raised(demo):
    pilot = {"high": variables.threshold("amount", ">=", "25000.5"), "band": variables.bucket("amount", [(0, "any")])}
    found = {row["process_instance_key"]: row for row in kpi_record(demo, pilot).collect()}
    assert found[7]["high"] is True and found[7][ERRORS] == []
    assert found[6]["high"] is None and found[6]["band"] is None
    assert [(e["kpi"], e["code"]) for e in found[6][ERRORS]] == [
        ("high", "BAD_INPUTPARAMETER"), ("band", "BAD_INPUTPARAMETER"),
    ]
    assert "'many'" in found[6][ERRORS][0]["message"]
    with pytest.raises(PySparkException, match="BAD_INPUTPARAMETER"):
        kpi_record(demo, pilot, mode="FAILFAST").collect()
    with pytest.raises(PySparkException, match="DATE_PARSING_ERROR"):
        kpi_record(demo, {"d": variables.threshold("due", "before", "2024-01-01")}, mode="failfast").collect()


@pytest.mark.parametrize("build, code", [
    (lambda: projections.tag(" "), "INCOMPLETE_PARAMETERS"),
    (lambda: projections.process_property("tenantid"), "BAD_INPUTPARAMETER"),
    (lambda: projections.date("WEEK"), "BAD_INPUTPARAMETER"),
    (lambda: projections.date(kind="Epoch"), "BAD_INPUTPARAMETER"),
    (lambda: projections.date(zone="Mars/Base"), "BAD_INPUTPARAMETER"),
    (lambda: counts.execution_count(""), "INCOMPLETE_PARAMETERS"),
    (lambda: counts.path("ALL"), "INCOMPLETE_PARAMETERS"),
    (lambda: counts.path("SOME", "a"), "BAD_INPUTPARAMETER"),
    (lambda: user_tasks.user_task_sla("x", None), "INCOMPLETE_PARAMETERS"),
    (lambda: user_tasks.user_task_sla("x", "2 hours"), "DATE_PARSING_ERROR"),
    (lambda: user_tasks.user_task_sla_description("x", "PT1H", "week"), "BAD_INPUTPARAMETER"),
    (lambda: user_tasks.user_task_assignee(mode="BEST"), "BAD_INPUTPARAMETER"),
    (lambda: latest.decision_result(""), "INCOMPLETE_PARAMETERS"),
    (lambda: variables.variable(""), "INCOMPLETE_PARAMETERS"),
    (lambda: variables.threshold("a", ">", None), "INCOMPLETE_PARAMETERS"),
    (lambda: variables.threshold("a", "!=", 1), "BAD_INPUTPARAMETER"),
    (lambda: variables.threshold("a", ">", "much"), "BAD_INPUTPARAMETER"),
    (lambda: variables.threshold("a", "after", "soon"), "DATE_PARSING_ERROR"),
    (lambda: variables.bucket("a", []), "INCOMPLETE_PARAMETERS"),
    (lambda: variables.bucket("a", [("x", "y")]), "BAD_INPUTPARAMETER"),
    (lambda: timing.duration("a", ""), "INCOMPLETE_PARAMETERS"),
    (lambda: history("XML"), "BAD_INPUTPARAMETER"),
    (lambda: history(topics="elementId|colour"), "BAD_INPUTPARAMETER"),
    (lambda: history(topics=" | "), "INCOMPLETE_PARAMETERS"),
    (lambda: history(activity_filter="PLANET"), "BAD_INPUTPARAMETER"),
    (lambda: history(activity_filter="|"), "INCOMPLETE_PARAMETERS"),
    (lambda: history(size=0), "BAD_INPUTPARAMETER"),
    (lambda: history(size="few"), "BAD_INPUTPARAMETER"),
])
def test_bad_arguments(spark, build, code):
    with pytest.raises(KpiError) as caught:
        build()
    assert caught.value.code == code


@pytest.mark.parametrize("pilot, code", [
    ({}, "INCOMPLETE_PARAMETERS"), ({"a": 1, "A": 2}, "BAD_INPUTPARAMETER"),
    ({"Process_Instance_Key": 1}, "BAD_INPUTPARAMETER"), ({"_KPI_errors": 1}, "BAD_INPUTPARAMETER"),
])
def test_bad_pilots(demo, pilot, code):
    with pytest.raises(KpiError) as caught:
        kpi_record(demo, pilot)
    assert caught.value.code == code


def test_families():
    types, flows = filters.families("all|gateway")
    assert flows and "INCLUSIVE_GATEWAY" in types and "CALL_ACTIVITY" not in types
    assert filters.families("SEQUENCE") == ([], True)
    assert filters.families("sequence_flow") == (["SEQUENCE_FLOW"], False)


def test_history_nests_called_instances_and_orders_ties(demo):
    text = by_instance(single_kpi(demo, history("STRING", "ELEMENTID|processInstanceKey", "ALL|CALL_ACTIVITY")))
    assert text[1] == (
        "ELEMENTID:start|processInstanceKey:1,ELEMENTID:F_start_light|processInstanceKey:1,"
        "ELEMENTID:light|processInstanceKey:1,ELEMENTID:timer|processInstanceKey:1"
    )
    # Instance 4 calls 6, which calls 7; a flow back to "a" takes the date of its first run.
    assert [entry.split("|")[0][10:] for entry in text[4].split(",")] == [
        "start", "call", "F_b_a", "a", "F_a_b", "b", "a", "b", "start", "call",
    ]
    # Beyond the size Spark cuts groups at by itself.
    whole = by_instance(single_kpi(demo, history("STRING", "ELEMENTID|processInstanceKey", "ALL|CALL_ACTIVITY", 5000)))
    assert whole == text
    limited = by_instance(single_kpi(demo, history(topics="elementId|sourceRef|assignee", size=3)))
    assert json.loads(limited[7]) == [
        {"elementId": "F_b_a"}, {"elementId": "a"}, {"elementId": "F_a_b", "sourceRef": "a"},
    ]
    tasks = json.loads(by_instance(single_kpi(demo, history(
        topics="assignee|processDefinitionVersion|startDate|endDate", activity_filter="USER_TASK"
    )))[2])
    assert tasks == [
        {"assignee": "ann", "processDefinitionVersion": 3, "startDate": "2024-05-02T09:00:01Z",
         "endDate": "2024-05-02T11:30:00Z"},
        {"assignee": "bob", "processDefinitionVersion": 3, "startDate": "2024-05-02T12:00:00Z"},
    ]


def test_order_packed_in_one_number(spark):
    far = 2**63 - 1
    moments = [None, "1899-12-31T23:59:59.999999", "1970-01-01T00:00:00", "1969-12-31T23:59:59.999999", "2024-05-02T08:00:00", "9999-12-31T00:00:00"]
    made = [(moment(m), key) for m in moments for key in (0, 1, -5, far, -far)]
    packed = spark.createDataFrame(made, "t timestamp_ntz, k bigint").select(
        "t", "k", packed_order(F.col("t"), F.col("k")).alias("up"), packed_order(F.col("t"), F.col("k"), descending=True).alias("down")
    ).collect()
    by_time = lambda row: (row["t"] is None, row["t"] or moment("1970-01-01T00:00:00"))
    assert sorted(packed, key=lambda r: r["up"]) == sorted(packed, key=lambda r: (*by_time(r), r["k"]))
    assert sorted(packed, key=lambda r: r["down"]) == sorted(packed, key=lambda r: (*by_time(r), -r["k"]))


def test_element_aggregates_sort_nothing(spark, demo, tmp_path):
    rows(spark, "element_instances").write.parquet(str(tmp_path / "element_instances"))
    rows(spark, "process_instances").write.parquet(str(tmp_path / "process_instances"))
    plan = kpi_record(read_logs(spark, str(tmp_path)), {
        "n": counts.execution_count("a"), "took": timing.duration("a", "b"), "began": timing.duration("a:START", "b:START"),
        "path": counts.path("ANY", "a"),
    })._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and plan.count("FileScan parquet") == 2


def test_variables_of_an_expression_may_be_called_anything(demo):
    record = kpi_record(demo, {"k": variables.expr("amount * 2", {"amount": "double"}), "city": variables.expr("concat(city, '!')", {"city": "string"})})
    assert by_instance(record, "k")[1] == 12000 and by_instance(record, "city")[1] == "Rome!"
    own = demo.variables.withColumn("name", F.when(F.col("name") == "amount", F.lit(KEY)).otherwise(F.col("name")))
    changed = demo.mapped(lambda name, table: own if name == "variables" else table)
    assert by_instance(kpi_record(changed, {"k": variables.expr(f"{KEY} + 1", {KEY: "double"})}), "k")[1] == 6001
