"""Every registered query against its SQL twin, on plain and on skewed data."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import assert_same, connect
from tests.conftest import DATA
from workload import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = connect(DATA)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert_same(QUERIES[name](spark, DATA).toPandas(), duck.execute(ORACLES[name]).df())


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The events with a third of all rows moved to one user and one week."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    hot = F.col("event_id") % 3 == 0
    day = F.expr("make_timestamp_ntz(2024, 1, 15, hour(ts), minute(ts), 0)")
    events = spark.read.parquet(f"{DATA}/events.parquet")
    events.withColumns({
        "user_id": F.when(hot, F.lit(1).cast("bigint")).otherwise(F.col("user_id")),
        "ts": F.when(hot, day).otherwise(F.col("ts")),
    }).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", [
    "kpi_record", "kpi_record_fused", "kpi_latency_total", "kpi_latency_element", "kpi_assignee_all",
    "call_closure", "flow_source_asof", "topology_rank", "history", "history_topk", "history_json", "history_string",
])
def test_one_instance_holding_a_third_of_the_log(spark, skewed, name):
    connection = connect(skewed)
    assert_same(QUERIES[name](spark, skewed).toPandas(), connection.execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", ["kpi_latency_total", "kpi_user_task_sla_desc", "kpi_assignee_all", "history_topk", "stream_trigger"])
def test_a_third_of_the_log_in_one_hour(spark, skewed, tmp_path, name):
    folder = str(tmp_path)
    one_hour = F.when(F.col("user_id") == 1, F.expr("timestamp_ntz'2024-01-15 09:20:00'")).otherwise(F.col("ts"))
    spark.read.parquet(f"{skewed}/events.parquet").withColumn("ts", one_hour).coalesce(1).write.parquet(f"{folder}/events.parquet")
    connection = connect(folder)
    assert_same(QUERIES[name](spark, folder).toPandas(), connection.execute(ORACLES[name]).df())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["process_instance_key", "purchases", "retries", "view_to_purchase_hours"]
