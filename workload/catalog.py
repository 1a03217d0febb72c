"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowgauge.operators.counts import execution_count, retry_count
from flowgauge.operators.timing import duration
from flowgauge.plans.record import kpi_record, single_kpi
from flowgauge.sources.event_log import logs_from_events
from flowgauge.sources.logs import ProcessLogs
from workload import history_queries, table_queries
from workload.kpi_queries import KPIS

Query = Callable[[SparkSession, str], DataFrame]


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return kpi_record(logs_from_events(spark, folder), {
        "purchases": execution_count("purchase"),
        "retries": retry_count(),
        "view_to_purchase_hours": duration("view", "purchase", "hour"),
    })


def _kpi_query(name: str) -> Query:
    build, _ = KPIS[name]
    return lambda spark, folder: single_kpi(logs_from_events(spark, folder), build()).select(
        "process_instance_key", "value"
    )


def _log_query(query: Callable[[ProcessLogs], DataFrame]) -> Query:
    return lambda spark, folder: query(logs_from_events(spark, folder))


def queries() -> dict[str, Query]:
    on_logs = table_queries.QUERIES | history_queries.QUERIES
    return (
        {name: _log_query(query) for name, (query, _) in on_logs.items()}
        | {name: _kpi_query(name) for name in KPIS}
        | {name: query for name, (query, _) in table_queries.STREAMS.items()}
    )


def oracle_sql() -> dict[str, str]:
    pairs = table_queries.QUERIES | history_queries.QUERIES | KPIS | table_queries.STREAMS
    return {name: sql for name, (_, sql) in pairs.items()}
