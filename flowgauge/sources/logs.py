"""Readers for the process-log tables and the container passed to every operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from flowgauge.errors import bad_input
from flowgauge.schemas import SCHEMAS


class ProcessLogs:
    """The log tables of one process engine, each opened on first use."""

    def __init__(self, open_table: Callable[[str], DataFrame], nested: ProcessLogs | None = None):
        self._open_table = open_table
        # Where logs are keyed by trigger: the same with the instances called below it.
        self.nested = nested

    @classmethod
    def of(cls, **tables: DataFrame) -> ProcessLogs:
        """Wrap ready DataFrames."""
        unknown = set(tables) - set(SCHEMAS)
        if unknown:
            raise bad_input(f"unknown log tables {sorted(unknown)}")

        def open_table(name: str) -> DataFrame:
            if name not in tables:
                raise bad_input(f"this operation needs the log table {name}")
            return tables[name]

        return cls(open_table)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def mapped(self, change: Callable[[str, DataFrame], DataFrame]) -> ProcessLogs:
        """The same logs with every table passed through ``change``."""
        return ProcessLogs(lambda name: change(name, self.table(name)))

    @cached_property
    def element_instances(self) -> DataFrame:
        return self._open_table("element_instances")

    @cached_property
    def process_instances(self) -> DataFrame:
        return self._open_table("process_instances")

    @cached_property
    def user_tasks(self) -> DataFrame:
        return self._open_table("user_tasks")

    @cached_property
    def jobs(self) -> DataFrame:
        return self._open_table("jobs")

    @cached_property
    def incidents(self) -> DataFrame:
        return self._open_table("incidents")

    @cached_property
    def variables(self) -> DataFrame:
        return self._open_table("variables")

    @cached_property
    def decision_instances(self) -> DataFrame:
        return self._open_table("decision_instances")

    @cached_property
    def message_subscriptions(self) -> DataFrame:
        return self._open_table("message_subscriptions")

    @cached_property
    def sequence_flows(self) -> DataFrame:
        return self._open_table("sequence_flows")

    @cached_property
    def flow_topology(self) -> DataFrame:
        return self._open_table("flow_topology")

    @cached_property
    def definitions(self) -> DataFrame:
        return self._open_table("definitions")


def read_logs(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> ProcessLogs:
    """Logs stored as one folder per table under ``path`` (parquet, orc, json or csv).

    Schemas are given, never inferred, so opening a table costs no scan.
    """

    def open_table(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).options(**options).format(fmt).load(f"{path}/{name}")

    return ProcessLogs(open_table)


def jdbc_options(
    url: str, table: str, bounds: tuple[int, int] | None = None, partitions: int = 1,
    partition_column: str = "process_instance_key", **options: str,
) -> dict[str, str]:
    """Options of a partitioned JDBC scan: each task reads one range of instance keys.

    ``bounds`` only sets the stride; rows outside it are still read by the edge ranges.
    """
    read = {"url": url, "dbtable": table, "preferTimestampNTZ": "true", **options}
    if bounds is not None:
        read |= {
            "partitionColumn": partition_column, "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]), "numPartitions": str(partitions),
        }
    elif partitions > 1:
        raise bad_input("a JDBC scan in several partitions needs key bounds")
    return read


def read_logs_jdbc(
    spark: SparkSession, url: str, bounds: tuple[int, int] | None = None, partitions: int = 1, **options: str,
) -> ProcessLogs:
    """Logs stored as database tables of the same names, scanned in ``partitions`` key ranges."""

    def open_table(name: str) -> DataFrame:
        wanted = SCHEMAS[name].fieldNames()
        by_definition = "process_instance_key" not in wanted
        read = jdbc_options(
            url, name, None if by_definition else bounds, 1 if by_definition else partitions, **options
        )
        return spark.read.format("jdbc").options(**read).load().select(*wanted).to(SCHEMAS[name])

    return ProcessLogs(open_table)
