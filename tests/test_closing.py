import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from flowgauge.errors import KpiError
from flowgauge.operators import counts, timing, user_tasks
from flowgauge.operators.kpi import Measure, measured
from flowgauge.plans.record import kpi_record
from flowgauge.schemas import KEY
from flowgauge.sources.logs import ProcessLogs
from flowgauge.streaming.closing import kpi_on_close
from tests.conftest import element, moment, rows

START = moment("2024-05-02T08:00:00")
GAP = timedelta(minutes=10)


def pilot():
    return {
        "wait": timing.latency(), "after_a": timing.latency("a"), "after_c": timing.latency("c"),
        "tasks": user_tasks.user_task_sla_description("", "PT1M", "minute"), "n": counts.execution_count("a"),
        "retries": counts.retry_count(), "sla": user_tasks.user_task_sla("", "PT1M"), "took": timing.duration("a", "b", "second"),
        "any": counts.path("ANY", "c"),
    }


def random_elements(seed, instances=5, size=120):
    """Ties, elements that end before they start or never, starts at and around minutes and the gap."""
    rng = random.Random(seed)
    out = []
    for k in range(size):
        instance = rng.randrange(instances) if rng.random() < 0.5 else 0
        at = START + timedelta(seconds=rng.choice([0, 59, 60, 61, 600, 659, 660, 1260, 7200, 7800, 8400, 8460]) + rng.randrange(4))
        end = None if rng.random() < 0.15 else at + timedelta(seconds=rng.choice([-90, -1, 0, 1, 5, 61, 600, 4000]))
        kind = rng.choice(["USER_TASK", "SERVICE_TASK"])
        out.append(element(500 + k, instance, rng.choice("abc"), None, None, kind) | {"start_date": at, "end_date": end})
    out.append(element(9, 0, "a"))
    return out


def sessions_of(elements):
    """(instance, elements of a session), apart by more than the gap."""
    out = []
    for instance in sorted({e[KEY] for e in elements}):
        own = sorted((e for e in elements if e[KEY] == instance and e["start_date"]), key=lambda e: e["start_date"])
        for k, e in enumerate(own):
            if k == 0 or e["start_date"] - own[k - 1]["start_date"] > GAP:
                out.append((instance, []))
            out[-1][1].append(e)
    return out


def plain(rows_):
    return sorted(tuple(str(v) for v in row) for row in rows_)


@pytest.mark.parametrize("seed", range(2))
def test_sessions_have_the_values_of_a_record(spark, seed):
    """Each session as an instance of its own, evaluated by the ordinary record."""
    elements = random_elements(seed)
    found = kpi_on_close(rows(spark, "element_instances", *elements), pilot(), "10 minutes", 0)
    sessions = sessions_of(elements)
    alone = [e | {KEY: number} for number, (_, held) in enumerate(sessions) for e in held]
    logs = ProcessLogs.of(
        element_instances=rows(spark, "element_instances", *alone),
        process_instances=rows(spark, "process_instances", *({KEY: number} for number in range(len(sessions)))),
    )
    want = [
        (sessions[row[0]][0], sessions[row[0]][1][0]["start_date"], sessions[row[0]][1][-1]["start_date"] + GAP, *row[1:])
        for row in kpi_record(logs, pilot()).collect()
    ]
    assert len(sessions) > 8 and plain(found.collect()) == plain(want)


def test_a_late_and_shuffled_stream_equals_the_table(spark, tmp_path):
    elements = random_elements(11, size=160)
    dated = sorted((e for e in elements if e["start_date"]), key=lambda e: e["start_date"])
    rng = random.Random(2)
    # Each row comes up to half an hour late; a last one far ahead closes everything.
    order = sorted(dated, key=lambda e: e["start_date"] + timedelta(seconds=rng.randrange(1800)))
    order.append(element(9999, 77, "z") | {"start_date": START + timedelta(days=2)})
    for k in range(0, len(order), 20):
        rows(spark, "element_instances", *order[k : k + 20]).coalesce(1).write.parquet(str(tmp_path / "in" / f"n={k:04}"))
    table = spark.read.parquet(str(tmp_path / "in")).drop("n")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    closed = kpi_on_close(stream, pilot(), "10 minutes", "2 hours")
    writer = closed.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out"))
    query = writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    streamed = spark.read.schema(closed.schema).parquet(str(tmp_path / "out")).collect()
    batch = [row for row in kpi_on_close(table, pilot(), "10 minutes", 0).collect() if row[0] != 77]
    assert plain(streamed) == plain(batch) and len(batch) > 8
    # What had been kept of closed sessions is gone: only the minute of the last row is left.
    assert sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"]) <= 2


def test_a_session_keeps_minutes_not_elements(spark):
    """The session step is fed with one row per minute."""
    many = [element(k, 1, "a") | {"start_date": START + timedelta(milliseconds=10 * k)} for k in range(3000)]
    found = kpi_on_close(rows(spark, "element_instances", *many), {"w": timing.latency()}, "10 minutes", 0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and found.count() == 1


def test_what_cannot_be_put_in_order(spark, demo):
    elements = demo.element_instances
    with pytest.raises(KpiError):
        kpi_on_close(elements, {"w": timing.latency()}, "59 seconds", 0)
    own = measured(n=Measure("element_instances", F.count("*")))
    assert kpi_on_close(elements, {"own": own}, "10 minutes", 0).count() > 0
    with pytest.raises(KpiError):
        kpi_on_close(elements, {"own": own, "w": timing.latency()}, "10 minutes", 0)


def test_empty_log(spark):
    assert kpi_on_close(rows(spark, "element_instances"), pilot(), "10 minutes", 0).count() == 0
