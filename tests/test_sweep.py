import random
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import counts, latest, states, timing, user_tasks, variables
from flowgauge.operators.kpi import Measure, measured
from flowgauge.plans.history import history
from flowgauge.sources.logs import ProcessLogs
from flowgauge.streaming import sweep
from flowgauge.streaming.triggers import SWEEP_FROM, record_at_triggers, trigger_counts
from tests.conftest import element, moment, rows

TRIGGERS = "trigger_key bigint, process_instance_key bigint, trigger_time timestamp_ntz"
DAY = moment("2024-05-02T00:00:00")


def pilot():
    return {
        "a": counts.execution_count("a"), "named": counts.execution_count("A", match="name_or_id"), "retries": counts.retry_count(),
        "a_again": counts.retry_count("a"), "all": counts.path("ALL", "a", "b"), "none": counts.path("NOTHING", "c"),
        "flow": counts.path("ANY", "F_a_b", "nowhere", include_flows=True), "sla": user_tasks.user_task_sla("", "PT5M"),
        "took": timing.duration("a", "b", "second"), "starts": timing.duration("a:START", "b:START"),
        "wait": timing.latency(), "after_a": timing.latency("a"), "errors": counts.bpmn_error_count(),
        "last": latest.bpmn_error(), "first_one": user_tasks.user_task_assignee(), "last_one": user_tasks.user_task_assignee(mode="LAST"),
        "boundary": counts.boundary_error_count(), "incidents": counts.incident_count("a"),
        "changed": counts.variable_changed_count("amount"), "over": variables.threshold("amount", ">", 10),
        "text": user_tasks.user_task_sla_description("", "PT5M"), "who": user_tasks.user_task_assignee(mode="ALL"),
        "h": history("STRING", "elementId|startDate", "ALL", size=1000),
    }


def random_logs(spark, seed, instances=6, size=60):
    """Elements at few moments, so that ties are common; some without a time, some that end before they start."""
    rng = random.Random(seed)

    def when(missing=0.05):
        return None if rng.random() < missing else DAY + timedelta(seconds=rng.choice([0, 30, 59, 60, 61, 300, 3600, 86399]) + rng.randrange(5))

    def maybe(x, share=0.1):
        return None if rng.random() < share else x

    elements, tasks, jobs, incidents, variables_, flows = [], [], [], [], [], []
    for k in range(size):
        start = when()
        end = None if start is None or rng.random() < 0.2 else start + timedelta(seconds=rng.choice([-40, 0, 1, 60, 400]))
        instance = rng.randrange(instances) if rng.random() < 0.6 else 0
        record = element(1000 + k, instance, rng.choice("abc"), None, None, rng.choice(["USER_TASK", "SERVICE_TASK", "BOUNDARY_EVENT"]))
        elements.append(record | {"start_date": start, "end_date": end})
        tasks.append({"user_task_key": k, "process_instance_key": instance, "element_id": "a", "assignee": maybe(rng.choice(["x", "y"])), "creation_date": when()})
        jobs.append({"job_key": k, "process_instance_key": instance, "element_id": "a", "error_code": maybe(rng.choice(["E1", "E2", " "]), 0.4), "last_update_time": when(0.1)})
        incidents.append({"incident_key": k, "process_instance_key": instance, "element_id": rng.choice("ab"), "creation_time": when()})
    for i in range(instances):
        variables_.append({"variable_key": i, "process_instance_key": i, "scope_key": i, "name": "amount", "value": str(i * 5)})
        for flow in ("F_a_b", "F_b_a", "F_gone"):
            flows.append({"process_instance_key": i, "process_definition_key": 1, "element_id": flow})
    topology = [{"process_definition_key": 1, "flow_id": f, "source_ref": s, "target_ref": t}
                for f, s, t in [("F_a_b", "a", "b"), ("F_b_a", "b", "a"), ("F_gone", "a", None)]]
    made = {
        "element_instances": elements, "user_tasks": tasks, "jobs": jobs, "incidents": incidents, "variables": variables_,
        "sequence_flows": flows, "flow_topology": topology,
        "process_instances": [{"process_instance_key": i, "process_definition_id": "demo"} for i in range(instances)],
    }
    logs = ProcessLogs.of(**{name: rows(spark, name, *records) for name, records in made.items()})
    triggers = [(k, rng.randrange(instances + 1), when(0) + timedelta(seconds=rng.choice([0, 0, 1, 90]))) for k in range(60)]
    triggers.append((99, 0, moment("1999-01-01T00:00:00")))
    return logs, spark.createDataFrame(triggers, TRIGGERS)


def plain(df):
    return sorted(tuple(str(v) for v in row) for row in df.collect())


@pytest.mark.parametrize("seed", range(2))
def test_a_sweep_gives_what_the_join_gives(spark, seed):
    logs, triggers = random_logs(spark, seed)
    swept = record_at_triggers(triggers, logs, pilot(), sweep=True)
    joined = record_at_triggers(triggers, logs, pilot(), sweep=False)
    assert swept.columns == joined.columns
    assert plain(swept) == plain(joined)


def test_rows_and_triggers_are_not_joined(spark, demo):
    """Rows meet the triggers' instances, one row each, in semi joins alone."""
    triggers = spark.createDataFrame([(1, 7, DAY)], TRIGGERS)
    mergeable = {name: kpi for name, kpi in pilot().items() if name not in ("text", "who", "h", "over")}
    measures = {
        f"{name}_{part}": measure for name, kpi in mergeable.items()
        for part, measure in ([("f", kpi.swept)] if kpi.swept else kpi.measures.items())
    }
    assert all(measure.state for measure in measures.values())
    plan = sweep.swept_measures(demo, measures, triggers)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "trigger_time" in plan and "Join Cross" not in plan
    # Time is compared by order, never by a condition between rows and triggers.
    assert "<= trigger_time" not in plan and ">= _at" not in plan


def test_ten_thousand_triggers_of_one_instance(spark, demo):
    """Rows out of every operator stay near rows plus triggers."""
    n = 10_000
    triggers = spark.range(n).selectExpr(
        "id AS trigger_key", "7L AS process_instance_key", "timestamp_ntz'2024-05-02 09:59:00' + make_dt_interval(0, 0, 0, id / 100) AS trigger_time"
    )
    assert trigger_counts(triggers).asDict() == {"low": 7, "high": 7, "instances": 1, "most": n} and n >= SWEEP_FROM
    wanted = {"a": counts.execution_count("a"), "wait": timing.latency()}
    found = record_at_triggers(triggers, demo, wanted)
    at = {row["trigger_key"]: (row["a"], row["wait"]) for row in found.collect()}
    # a runs at 10:00:00 and 10:00:03, b at 10:00:01 and 10:00:05: gaps of 1 s before either second run.
    assert (at[5999], at[6000], at[6299], at[6300], at[6500]) == ((0, 0), (1, 0), (1, 0), (2, 1000), (2, 2000))
    sizes = [
        m.apply("numOutputRows").value() for m in _metrics(found) if m.contains("numOutputRows")
    ]
    assert sizes and max(sizes) < 2 * (n + 100)


def _metrics(df):
    """Metrics of all nodes of the executed plan, once it has run."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        out.append(node.metrics())
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return out


def test_own_measures(spark, demo):
    """A measure without a state is joined, beside others that are swept."""
    triggers = spark.createDataFrame([(1, 7, moment("2024-05-02T10:00:01")), (2, 7, moment("2024-05-02T10:00:09"))], TRIGGERS)
    open_ones = Measure("element_instances", F.count_if(F.col("end_date").isNull() & F.col("start_date").isNotNull()))
    longest = F.max(F.col("element_id"))
    wanted = {
        "open": measured(n=open_ones), "a": counts.execution_count("a"),
        "name": measured(lambda inputs: inputs["m"], m=Measure("element_instances", longest, state=states.last_by(F.col("element_id"), F.col("element_id")))),
    }
    found = {row["trigger_key"]: row[3:] for row in record_at_triggers(triggers, demo, wanted, sweep=True).collect()}
    assert found == {1: (1, 1, "late"), 2: (0, 2, "late")}


def test_no_triggers(spark, demo):
    none = spark.createDataFrame([], TRIGGERS)
    assert record_at_triggers(none, demo, pilot()).count() == 0
    assert record_at_triggers(none, demo, pilot(), sweep=True).count() == 0
    assert trigger_counts(none).asDict() == {"low": None, "high": None, "instances": 0, "most": 0}


def test_partitions_follow_the_rows(spark, monkeypatch):
    """Twice the rows are dealt to twice the partitions, with the same record as before."""
    logs, triggers = random_logs(spark, 3)
    once = plain(record_at_triggers(triggers, logs, pilot(), sweep=True))
    monkeypatch.setattr(sweep, "ROWS_A_TASK", 10)
    measures = {f"n_{name}": measure for name, measure in counts.execution_count("a").measures.items()}
    measures["wait"] = timing.latency().swept
    own = triggers.select("process_instance_key").distinct()
    seen = logs.element_instances.join(own, "process_instance_key", "left_semi").count() + triggers.count()
    for more, n in ((triggers, seen), (triggers.union(triggers), seen + triggers.count())):
        # As many tasks order the united rows, the minutes of instances, and the elements the gaps are made of.
        plan = sweep.swept_measures(logs, measures, more)[0]._jdf.queryExecution().executedPlan().toString()
        parts = f"{-(-n // 10)}), REPARTITION_BY_NUM"
        for keys in (r"process_instance_key#\d+L", r"process_instance_key#\d+L, _slot#\d+L"):
            assert re.search(rf"hashpartitioning\({keys}, {re.escape(parts)}", plan)
    assert plain(record_at_triggers(triggers, logs, pilot(), sweep=True)) == once
