import pytest
from pyspark.sql import functions as F

from flowgauge.errors import KpiError
from flowgauge.operators import counts, latest, timing, user_tasks
from flowgauge.operators.key_sketch import MOST_BITS, MOST_KEYS, KeySketch, key_sketch
from flowgauge.plans.history import history
from flowgauge.schemas import KEY
from flowgauge.sources.logs import read_logs
from flowgauge.streaming import triggers
from flowgauge.streaming.closing import delay_interval, kpi_on_close
from flowgauge.streaming.triggers import kpi_on_trigger, record_at_triggers
from tests.conftest import element, moment, rows

TRIGGERS = "trigger_key bigint, process_instance_key bigint, trigger_time timestamp_ntz"


def test_record_as_of_a_moment(spark, demo):
    triggers = spark.createDataFrame([
        (1, 7, moment("2024-05-02T10:00:01")), (2, 7, moment("2024-05-02T10:00:05")),
        (3, 2, moment("2024-05-02T10:00:00")), (4, 2, moment("2024-05-02T11:30:00")),
    ], TRIGGERS)
    pilot = {
        "a": counts.execution_count("a"), "retries": counts.retry_count(),
        "text": user_tasks.user_task_sla_description("", "PT1H"), "wait": timing.latency(),
        "took": timing.duration("a", "b"), "error": latest.bpmn_error(),
    }
    found = {row["trigger_key"]: row for row in record_at_triggers(triggers, demo, pilot).collect()}
    assert found[1].asDict() == {
        "trigger_key": 1, "process_instance_key": 7, "trigger_time": moment("2024-05-02T10:00:01"), "a": 1,
        "retries": 0, "text": "", "wait": 0, "took": None, "error": None,
    }
    assert (found[2]["a"], found[2]["retries"], found[2]["wait"], found[2]["took"]) == (2, 2, 2000, 1000)
    # The task was still open at the first moment and had just ended at the second.
    assert (found[3]["text"], found[4]["text"]) == ("", '"review"-2h-OVER')


def test_history_as_of_a_moment(spark, demo):
    triggers = spark.createDataFrame([
        (1, 4, moment("2024-05-02T10:00:00")), (2, 4, moment("2024-05-02T10:01:00")), (3, 4, moment("2024-05-02T10:04:00")),
        (4, 7, moment("2024-05-02T10:00:04")), (5, 5, moment("2024-05-02T10:00:04")),
    ], TRIGGERS)
    pilot = {"h": history("STRING", "elementId|processInstanceKey|endDate", "ALL|CALL_ACTIVITY")}
    found = {row["trigger_key"]: row["h"] for row in record_at_triggers(triggers, demo, pilot).collect()}
    start = "elementId:start|processInstanceKey:4|endDate:2024-05-02T10:00:00Z"
    assert found[1] == f"{start},elementId:call|processInstanceKey:4"
    assert [entry.split("|")[0][10:] for entry in found[2].split(",")] == ["start", "call", "start"]
    # Instance 7 is called at 10:02 but ran before that in this log.
    assert [entry.split("|")[0][10:] for entry in found[3].split(",")] == [
        "start", "call", "F_b_a", "a", "F_a_b", "b", "a", "b", "start", "call",
    ]
    assert found[3].endswith("elementId:call|processInstanceKey:6")
    assert found[4].endswith("elementId:a|processInstanceKey:7|endDate:2024-05-02T10:00:04Z")
    assert "10:00:06" not in found[4]
    assert found[5] == ""


def test_history_at_the_end_of_time_is_the_whole_history(spark):
    from flowgauge.plans.record import kpi_record
    from flowgauge.sources.event_log import logs_from_events
    from tests.conftest import DATA

    logs = logs_from_events(spark, DATA)
    pilot = {"h": history(size=20), "n": counts.execution_count("view")}
    triggers = logs.process_instances.selectExpr(
        "process_instance_key + 7 AS trigger_key", "process_instance_key", "timestamp_ntz'2999-01-01' AS trigger_time"
    )
    seen = {(row["process_instance_key"], row["h"], row["n"]) for row in record_at_triggers(triggers, logs, pilot).collect()}
    whole = {(row["process_instance_key"], row["h"], row["n"]) for row in kpi_record(logs, pilot).collect()}
    assert seen == whole


def run(writer, state):
    writer.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def test_replayed_batches_leave_no_duplicates(spark, demo, tmp_path):
    triggers = spark.createDataFrame([(1, 7, moment("2024-05-02T11:00:00"))], TRIGGERS)
    triggers.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(TRIGGERS).parquet(str(tmp_path / "in"))
    pilot = {"a": counts.execution_count("a")}
    out = str(tmp_path / "out")
    # A second run from an empty state replays batch 0.
    for state in ("s1", "s2"):
        run(kpi_on_trigger(stream, lambda: demo, pilot, out), str(tmp_path / state))
    assert [tuple(row) for row in spark.read.parquet(out).select("trigger_key", "a", "batch_id").collect()] == [(1, 2, 0)]
    # A later activation of the same instance adds a row.
    triggers.selectExpr("2L AS trigger_key", "process_instance_key", "trigger_time").write.mode("append").parquet(str(tmp_path / "in"))
    run(kpi_on_trigger(stream, lambda: demo, pilot, out), str(tmp_path / "s2"))
    assert spark.read.parquet(out).count() == 2


def test_sessions_on_a_stream_equal_the_batch(spark, tmp_path):
    day = "2024-05-02T"
    files = [
        [element(1, 1, "a", day + "08:00:00", day + "08:10:00", "USER_TASK"), element(2, 1, "b", day + "08:20:00", None),
         element(3, 2, "a", day + "08:00:00", None)],
        [element(4, 1, "a", day + "12:00:00", day + "12:00:01"), element(5, 2, "a", day + "08:25:00", None)],
        [element(6, 3, "z", "2024-05-04T00:00:00", None)],
    ]
    for number, records in enumerate(files):
        rows(spark, "element_instances", *records).coalesce(1).write.parquet(str(tmp_path / "in" / f"n={number}"))
    pilot = {
        "a": counts.execution_count("a"), "retries": counts.retry_count(),
        "sla": user_tasks.user_task_sla("", "PT5M"), "path": counts.path("ALL", "a", "b"),
        "took": timing.duration("a:START", "b:START", "minute"),
    }
    schema = spark.read.parquet(str(tmp_path / "in")).drop("n").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    closed = kpi_on_close(stream, pilot, "30 minutes", 60_000)
    run(closed.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out")), str(tmp_path / "state"))
    streamed = {tuple(row) for row in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {tuple(row) for row in kpi_on_close(spark.read.parquet(str(tmp_path / "in")).drop("n"), pilot, "30 minutes", 0).collect()}
    assert len(batch) == 4 and {row for row in batch if row[0] != 3} == streamed
    assert {row[:4] for row in streamed} == {
        (1, moment(day + "08:00:00"), moment(day + "08:50:00"), 1), (1, moment(day + "12:00:00"), moment(day + "12:30:00"), 1),
        (2, moment(day + "08:00:00"), moment(day + "08:55:00"), 2),
    }


@pytest.mark.parametrize("delay, interval", [
    (0, "0 milliseconds"), ("1500", "1500 milliseconds"), ("10 minutes", "10 minutes"), ("5 ms", "5 milliseconds"),
])
def test_delays(delay, interval):
    assert delay_interval(delay) == interval


@pytest.mark.parametrize("delay", [-1, "-5 minutes", "soon", ""])
def test_bad_delays(delay):
    with pytest.raises(KpiError):
        delay_interval(delay)


def test_closing_refuses_other_logs(demo):
    for kpi in (counts.incident_count(), user_tasks.user_task_assignee(mode="ALL"), history()):
        with pytest.raises(KpiError):
            kpi_on_close(demo.element_instances, {"k": kpi}, "1 hour", 0)


def test_each_batch_sees_the_logs_exported_before_it(spark, demo, tmp_path):
    """Two micro-batches of one running stream, with a log file arriving between them."""
    day = "2024-05-02T"

    def export(*elements):
        rows(spark, "element_instances", *elements).write.mode("append").parquet(str(tmp_path / "logs/element_instances"))

    def trigger(key, at):
        made = spark.createDataFrame([(key, 1, moment(at)), (key + 100, 99, moment(at))], TRIGGERS)
        made.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    export(element(1, 1, "a", day + "08:00:00", day + "08:10:00"))
    rows(spark, "process_instances").write.parquet(str(tmp_path / "logs/process_instances"))
    trigger(1, day + "08:30:00")
    stream = spark.readStream.schema(TRIGGERS).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    writer = kpi_on_trigger(stream, lambda: read_logs(spark, str(tmp_path / "logs")), {"a": counts.execution_count("a")}, out)
    running = writer.option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        running.processAllAvailable()
        export(element(2, 1, "a", day + "09:00:00", None), element(3, 1, "a", day + "10:00:00", None))
        trigger(2, day + "09:30:00")
        running.processAllAvailable()
    finally:
        running.stop()
    found = {row["trigger_key"]: (row["process_instance_key"], row["a"]) for row in spark.read.parquet(out).collect()}
    # Neither instance has been exported yet: each trigger has its record all the same.
    assert found == {1: (1, 1), 2: (1, 2), 101: (99, 0), 102: (99, 0)}


def test_a_flow_taken_after_its_trigger_is_not_seen(spark, demo):
    triggers = spark.createDataFrame([
        (1, 7, moment("2000-01-01T00:00:00")), (2, 7, moment("2024-05-02T10:00:01")), (3, 7, moment("2024-05-02T10:00:00")),
    ], TRIGGERS)
    pilot = {"ab": counts.path("ANY", "F_a_b", include_flows=True), "ba": counts.path("ANY", "F_b_a", include_flows=True)}
    found = {row["trigger_key"]: (row["ab"], row["ba"]) for row in record_at_triggers(triggers, demo, pilot).collect()}
    # b first starts at 10:00:01, a at 10:00:00.
    assert found == {1: (False, False), 2: (True, True), 3: (False, True)}


def test_a_trigger_waits_until_the_log_is_beyond_it(spark, tmp_path):
    """Rows that are exported after their trigger are in its record; a late trigger does not wait."""
    day = "2024-05-02T"

    def export(*elements):
        rows(spark, "element_instances", *elements).coalesce(1).write.mode("append").parquet(str(tmp_path / "logs/element_instances"))

    def trigger(key, at):
        made = spark.createDataFrame([(key, 1, moment(at))], TRIGGERS)
        made.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    out = str(tmp_path / "out")

    def records():
        found = spark.read.parquet(out).collect()
        return {row["trigger_key"]: (row["a"], row["batch_id"]) for row in found}

    export(element(1, 1, "a", day + "08:00:00", day + "08:10:00"))
    rows(spark, "process_instances").write.parquet(str(tmp_path / "logs/process_instances"))
    trigger(1, day + "08:30:00")
    trigger(2, day + "07:50:00")
    schema = spark.read.parquet(str(tmp_path / "logs/element_instances")).schema
    stream = spark.readStream.schema(TRIGGERS).parquet(str(tmp_path / "in"))
    progress = spark.readStream.schema(schema).parquet(str(tmp_path / "logs/element_instances")).select("start_date")

    def go_on():
        writer = kpi_on_trigger(
            stream, lambda: read_logs(spark, str(tmp_path / "logs")), {"a": counts.execution_count("a")}, out,
            progress=progress, wait="10 minutes",
        )
        run(writer, str(tmp_path / "state"))

    go_on()
    # The log is at 08:00: only the trigger of 07:50 may go.
    assert records() == {2: (0, 0)}
    export(element(2, 1, "a", day + "08:20:00", None), element(3, 2, "a", day + "08:39:59", None))
    go_on()
    assert records() == {2: (0, 0)}
    export(element(4, 1, "a", day + "08:30:00", None), element(5, 2, "a", day + "08:40:00", None))
    trigger(3, day + "09:00:00")
    trigger(4, day + "08:15:00")
    go_on()
    assert records() == {2: (0, 0), 1: (3, 2), 4: (1, 2)}
    export(element(6, 1, "a", day + "08:59:00", None), element(7, 9, "a", day + "23:00:00", None))
    go_on()
    assert records() == {2: (0, 0), 1: (3, 2), 4: (1, 2), 3: (4, 3)}


def test_a_replayed_batch_waits_as_before(spark, demo, tmp_path):
    """From an empty state the first batch is made again, whatever a later one has written down since."""
    spark.createDataFrame([(1, 7, moment("2024-05-02T10:00:01")), (2, 7, moment("2024-05-02T12:00:00"))], TRIGGERS).coalesce(1).write.parquet(str(tmp_path / "in"))
    demo.element_instances.coalesce(1).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(TRIGGERS).parquet(str(tmp_path / "in"))
    progress = spark.readStream.schema(demo.element_instances.schema).parquet(str(tmp_path / "log")).select("start_date")
    pilot = {"a": counts.execution_count("a"), "h": history(size=3, wait_ms=60_000)}
    out = str(tmp_path / "out")
    for state in ("s1", "s2"):
        run(kpi_on_trigger(stream, lambda: demo, pilot, out, progress=progress), str(tmp_path / state))
        assert [row["trigger_key"] for row in spark.read.parquet(out).collect()] == [1]


def test_waiting_needs_the_progress_of_the_log(spark, demo):
    with pytest.raises(KpiError):
        kpi_on_trigger(None, lambda: demo, {"h": history(wait_ms=1)}, "nowhere")
    with pytest.raises(KpiError):
        kpi_on_trigger(None, lambda: demo, {"a": 1}, "nowhere", wait="-1 second")
    with pytest.raises(KpiError):
        history(wait_ms=-1)


def test_two_far_instances_read_no_others(spark, tmp_path):
    """An old and a new instance: the scans are given both keys, and what is read is their rows."""
    elements = rows(spark, "element_instances", *(element(k, k, "a", "2024-05-02T08:00:00", None) for k in range(500)))
    elements.coalesce(1).sortWithinPartitions("process_instance_key").write.parquet(str(tmp_path / "logs/element_instances"))
    rows(spark, "process_instances", *({"process_instance_key": k} for k in range(500))).write.parquet(str(tmp_path / "logs/process_instances"))
    far = spark.createDataFrame([(1, 3, moment("2024-05-02T09:00:00")), (2, 490, moment("2024-05-02T09:00:00"))], TRIGGERS)
    keys, counted = triggers._instances(far)
    assert keys == [3, 490] and counted.asDict() == {"low": 3, "high": 490, "instances": 2, "most": 1}
    logs = read_logs(spark, str(tmp_path / "logs"))
    record = record_at_triggers(far, logs, {"a": counts.execution_count("a")}, key_range=(3, 490), sweep=False, keys=keys)
    assert {row["trigger_key"]: row["a"] for row in record.collect()} == {1: 1, 2: 1}
    plan = record._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "element_id" in line]
    assert filters and all("IN (3,490)" in line for line in filters)
    behind = logs.element_instances.filter(F.col("process_instance_key").isin(keys)).count()
    assert behind == 2


def test_instances_of_a_batch(spark, monkeypatch):
    made = spark.createDataFrame([(1, 3, None), (2, 3, None), (3, 9, None), (4, None, None)], TRIGGERS)
    assert triggers._instances(made)[0] == [3, 9] and triggers._instances(made)[1]["most"] == 2
    monkeypatch.setattr(triggers, "LISTED", 1)
    assert triggers._instances(made)[0] is None
    sketch, counted = triggers._instances(made, sketch=True)
    assert isinstance(sketch, KeySketch) and counted.asDict() == {"low": 3, "high": 9, "instances": 2, "most": 2}
    none = made.filter("false")
    assert triggers._instances(none) == ([], triggers._instances(none)[1]) and triggers._instances(none)[1]["most"] == 0


@pytest.mark.parametrize("wanted", [1, 40, 3000])
def test_a_sketch_passes_its_keys_and_few_others(spark, wanted):
    every = spark.range(200_000).select((F.col("id") * 1_000_003 - 50_000_000).alias(KEY))
    own = {k * 1_000_003 - 50_000_000 for k in range(0, 200_000, 200_000 // wanted)}
    twice = spark.createDataFrame([(k,) for k in [*own, *own, None]], f"{KEY} bigint")
    sketch = key_sketch(twice, KEY, len(own))
    passed = {row[KEY] for row in every.filter(sketch.may_hold(F.col(KEY))).collect()}
    assert own <= passed and len(passed - own) <= 0.02 * 200_000
    assert twice.filter(sketch.may_hold(F.col(KEY))).count() == 2 * len(own)


def test_the_fullest_sketch_still_holds_back_others(spark):
    sketch = key_sketch(spark.range(MOST_KEYS).toDF(KEY), KEY, MOST_KEYS)
    assert spark.range(MOST_KEYS).filter(sketch.may_hold(F.col("id"))).count() == MOST_KEYS
    assert spark.range(10**9, 10**9 + 100_000).filter(sketch.may_hold(F.col("id"))).count() <= 2_000


def test_a_sketch_is_bounded(spark):
    none = spark.createDataFrame([], f"{KEY} bigint")
    assert key_sketch(none, KEY, 0).words == (0,)
    assert key_sketch(none, KEY, MOST_KEYS + 1) is None
    assert len(key_sketch(spark.range(10).toDF(KEY), KEY, MOST_KEYS).words) == MOST_BITS // 64


@pytest.mark.parametrize("sweep", [True, False])
def test_a_sketched_batch_has_the_same_records(spark, demo, sweep):
    instances = demo.process_instances.select(KEY)
    made = instances.select(F.col(KEY).alias("trigger_key"), KEY, F.lit("2100-01-01").cast("timestamp_ntz").alias("trigger_time"))
    pilot = {"retries": counts.retry_count(), "took": timing.latency(), "errors": counts.bpm_error_count()}
    plain = record_at_triggers(made, demo, pilot, sweep=sweep)
    sketched = record_at_triggers(made, demo, pilot, sweep=sweep, keys=key_sketch(made, KEY, instances.count()))
    assert sorted(map(str, sketched.collect())) == sorted(map(str, plain.collect())) and plain.count() > 0
