import pytest

from flowgauge.errors import KpiError
from flowgauge.plans.record import kpi_record, observed_errors
from flowgauge.sources import clustered as clustered_logs
from flowgauge.sources.clustered import buckets_for, read_clustered, write_clustered
from flowgauge.sources.event_log import logs_from_events
from flowgauge.sources.logs import ProcessLogs
from tests.conftest import DATA, element, rows
from workload import table_queries
from workload.table_queries import CLUSTERED, bad_pilot, fused_pilot, full_pilot


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    write_clustered(logs_from_events(spark, DATA), [*CLUSTERED, "flow_topology"], "by_instance_", str(tmp_path_factory.mktemp("clustered")), 4)
    return read_clustered(spark, "by_instance_")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_log_is_exchanged(spark, clustered, monkeypatch):
    """Neither the aggregates of all tables nor the joins of their results."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pilot = {name: kpi for name, kpi in full_pilot().items() if "latency" not in name and "sla_desc" not in name}
        for wanted in (fused_pilot(), pilot):
            plan = final_plan(kpi_record(clustered, wanted))
            assert "Exchange" not in plan and "Bucketed: true" in plan
        assert "Exchange" in final_plan(kpi_record(logs_from_events(spark, DATA), fused_pilot()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_are_the_same(spark, clustered):
    logs = logs_from_events(spark, DATA)
    for name in (*CLUSTERED, "flow_topology"):
        columns = clustered.table(name).columns
        assert sorted(map(str, clustered.table(name).collect())) == sorted(map(str, logs.table(name).select(columns).collect()))


def test_a_bucket_is_a_file(spark, clustered):
    assert len(clustered.element_instances.inputFiles()) <= 4
    with pytest.raises(KpiError):
        write_clustered(clustered, [], "x", "y", 0)


def test_buckets_follow_the_log(spark, monkeypatch):
    """Twice the elements lie in twice the buckets, in the query as well."""
    monkeypatch.setattr(clustered_logs, "ROWS_A_BUCKET", 10)
    for n, want in ((0, 2), (20, 2), (21, 3), (200, 20)):
        elements = rows(spark, "element_instances", *(element(k, k % 50, "a") for k in range(n)))
        assert buckets_for(ProcessLogs.of(element_instances=elements), ["element_instances"], least=2) == want
    logs, written = logs_from_events(spark, DATA), []
    monkeypatch.setattr(table_queries, "write_clustered", lambda *given: written.append(given[-1]) or write_clustered(*given))
    table_queries.record_clustered(logs)
    assert written == [-(-logs.element_instances.count() // 10)]


def test_errors_are_counted_as_the_record_is_written(spark, tmp_path):
    logs = logs_from_events(spark, DATA)
    record, observation = observed_errors(kpi_record(logs, bad_pilot()), bad_pilot())
    record.write.parquet(str(tmp_path / "record"))
    written = spark.read.parquet(str(tmp_path / "record"))
    want = {f"{r['kpi']}:{r['code']}": r["count"] for r in written.selectExpr("inline(_kpi_errors)").groupBy("kpi", "code").count().collect()}
    found = observation.get
    assert found["records"] == written.count() and want
    assert {name: n for name, n in found.items() if n and name != "records"} == want
    assert found["fine:DATE_PARSING_ERROR"] == 0


def test_a_pilot_without_errors(spark, demo, tmp_path):
    record, observation = observed_errors(kpi_record(demo, fused_pilot()), fused_pilot())
    record.write.parquet(str(tmp_path / "record"))
    assert observation.get == {"records": 8}
