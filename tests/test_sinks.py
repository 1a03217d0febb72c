import pytest
from pyspark.errors import AnalysisException

from flowgauge.errors import KpiError
from flowgauge.operators import counts, projections
from flowgauge.plans.record import kpi_record
from flowgauge.sinks.matched import append_matched, matched_columns, name_candidates
from flowgauge.sources.logs import ProcessLogs, jdbc_options, read_logs


def test_columns_match_ignoring_case():
    assert matched_columns(["b", "A", "gone"], ["a", "B", "extra"]) == {"B": "b", "a": "A"}
    with pytest.raises(KpiError) as caught:
        matched_columns(["x"], ["y"])
    assert caught.value.code == "DATABASE_NOT_MATCH"


def test_table_names_are_tried_as_given_then_upper_then_lower():
    assert name_candidates("Kpi") == ["Kpi", "KPI", "kpi"]
    with pytest.raises(KpiError):
        name_candidates(" ")


def test_append_to_a_table(spark, demo):
    spark.sql("""CREATE TABLE Sink (INSTANCEKEY BIGINT, `my label` STRING, runs INT, list STRING,
                 note STRING DEFAULT 'none') USING parquet""")
    record = kpi_record(demo, {
        "instanceKey": projections.process_instance_key(), "My Label": projections.tag("t"),
        "Runs": counts.execution_count("start"), "list": projections.constant([1, 2]), "dropped": 1,
    })
    append_matched(record, "SINK")
    append_matched(record.limit(1), "sink")
    stored = spark.table("sink")
    assert stored.count() == 9
    row = stored.filter("INSTANCEKEY = 4").first().asDict()
    assert row == {"INSTANCEKEY": 4, "my label": "t", "runs": 1, "list": "[1, 2]", "note": "none"}
    with pytest.raises(KpiError):
        append_matched(record.select("dropped"), "sink")
    with pytest.raises(AnalysisException):
        append_matched(record, "no_such_table")


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_logs_from_files(spark, demo, tmp_path, fmt):
    for name in ("element_instances", "process_instances"):
        demo.table(name).write.format(fmt).save(str(tmp_path / name))
    stored = read_logs(spark, str(tmp_path), fmt)
    pilot = {"runs": counts.execution_count("start"), "retries": counts.retry_count()}
    assert sorted(kpi_record(stored, pilot).collect()) == sorted(kpi_record(demo, pilot).collect())


def test_scans_get_filters_and_only_the_needed_columns(spark, demo, tmp_path):
    for name in ("element_instances", "process_instances"):
        demo.table(name).write.parquet(str(tmp_path / name))
    stored = read_logs(spark, str(tmp_path))
    plan = kpi_record(stored, {"runs": counts.execution_count("start")})._jdf.queryExecution().toString()
    assert "EqualTo(element_id,start)" in plan
    assert "ReadSchema: struct<process_instance_key:bigint,element_id:string>" in plan
    several = {"runs": counts.execution_count("start"), "path": counts.path("ALL", "a", "b"), "n": counts.incident_count("c")}
    plan = kpi_record(logs_with(stored, demo), several)._jdf.queryExecution().toString()
    assert "In(element_id, [a,b,c,start])" in plan
    assert "ReadSchema: struct<process_instance_key:bigint>" in plan


def logs_with(stored, demo):
    return ProcessLogs.of(
        element_instances=stored.element_instances, process_instances=stored.process_instances, incidents=demo.incidents
    )


def test_jdbc_scans_are_split_by_instance_key():
    options = jdbc_options("jdbc:x", "jobs", (1, 100), 8, user="u")
    assert options["partitionColumn"] == "process_instance_key"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("1", "100", "8")
    with pytest.raises(KpiError):
        jdbc_options("jdbc:x", "jobs", None, 8)
