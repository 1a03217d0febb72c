"""Logs clustered by instance: every log table in the same number of buckets of the instance key.

A record groups and joins all logs by instance. Over tables that are stored that way already, neither needs an exchange:
task n reads bucket n of each table. Writing shuffles each log once, every record after that none of them.

An instance lies in one bucket, so an instance that holds a large share of a log is read by one task. Its rows are
aggregated as they are read, which bounds memory but not time; leave logs with such instances as they are.

A record over buckets does all its aggregates and joins in one task per bucket, some 25 of them for a whole pilot, so what a
bucket holds counts as often. The number of buckets therefore has to follow the log: see ``buckets_for``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowgauge.errors import bad_input
from flowgauge.operators.skew import partitions_for
from flowgauge.schemas import KEY, SCHEMAS
from flowgauge.sources.logs import ProcessLogs

#: So many rows of the largest log lie in one bucket, at which a whole pilot takes little more than its first pages.
ROWS_A_BUCKET = 100_000


def buckets_for(logs: ProcessLogs, tables: list[str], least: int = 8) -> int:
    """Buckets for logs whose largest table is one of ``tables``: one per ``ROWS_A_BUCKET`` rows, ``least`` or more."""
    return max([least, *(partitions_for(logs.table(name).count(), ROWS_A_BUCKET) for name in tables)])


def write_clustered(logs: ProcessLogs, tables: list[str], prefix: str, path: str, buckets: int) -> None:
    """Store ``tables`` as catalog tables ``<prefix><name>`` under ``path``, one sorted file per bucket.

    Tables without an instance key are stored as they are. All tables have the same number of buckets:
    ``buckets_for`` counts the largest one.
    """
    if buckets < 1:
        raise bad_input(f"a table cannot have {buckets} buckets")
    for name in tables:
        rows = logs.table(name).select(*SCHEMAS[name].fieldNames())
        target = f"{path}/{name}"
        if KEY in rows.columns:
            # Dealt by the same hash as buckets are, so that a bucket is one file.
            writer = rows.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY)
        else:
            writer = rows.write
        writer.format("parquet").option("path", target).saveAsTable(f"{prefix}{name}")


def read_clustered(spark: SparkSession, prefix: str) -> ProcessLogs:
    """The logs stored with ``prefix``."""
    def open_table(name: str) -> DataFrame:
        return spark.table(f"{prefix}{name}")

    return ProcessLogs(open_table)
