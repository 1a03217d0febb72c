"""Append-only sinks: record columns go to the table columns of the same name, ignoring case.

Record columns without a match are dropped, table columns without one keep their default.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from flowgauge.errors import DATABASE_NOT_MATCH, KpiError, bad_input, is_blank


def matched_columns(record: Iterable[str], table: Iterable[str]) -> dict[str, str]:
    """Table column -> record column, both spelled as they are, in record order."""
    by_name: dict[str, str] = {}
    for column in table:
        by_name.setdefault(column.lower(), column)
    matched = {by_name[name.lower()]: name for name in record if name.lower() in by_name}
    if not matched:
        raise KpiError(DATABASE_NOT_MATCH, "no column of the table matches a column of the record")
    return matched


def flat(name: str, kind: DataType) -> Column:
    """The column as a table can hold it: nested values as JSON text."""
    nested = isinstance(kind, (ArrayType, MapType, StructType, VariantType))
    return F.to_json(F.col(name)) if nested else F.col(name)


def name_candidates(table: str) -> list[str]:
    """The name as given, then in upper and in lower case."""
    if is_blank(table):
        raise bad_input("a table name is required")
    return list(dict.fromkeys([table, table.upper(), table.lower()]))


def resolve_table(spark: SparkSession, table: str) -> str:
    """First candidate the catalog knows; Spark reports the name as given when none is."""
    found = (name for name in name_candidates(table) if spark.catalog.tableExists(name))
    return next(found, table)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted_table(name: str) -> str:
    """A table name for SQL text, its parts quoted where they are not quoted already."""
    return name if "`" in name else ".".join(quoted(part.strip()) for part in name.split("."))


def append_matched(record: DataFrame, table: str) -> None:
    """Insert the record into a Spark table."""
    spark = record.sparkSession
    name = resolve_table(spark, table)
    target = spark.table(name).schema
    matched = matched_columns(record.columns, target.fieldNames())
    rows = record.select(*(
        flat(source, record.schema[source].dataType).cast(target[column].dataType).alias(column)
        for column, source in matched.items()
    ))
    columns = ", ".join(quoted(column) for column in matched)
    spark.sql(f"INSERT INTO {quoted_table(name)} ({columns}) SELECT {columns} FROM {{rows}}", rows=rows)


def append_matched_jdbc(record: DataFrame, url: str, table: str, **options: str) -> None:
    """Insert the record into a database table; each task writes over a connection of its own.

    Column names are taken from the database as they are spelled there, and Spark's
    dialect for the database quotes them. A task that is retried inserts its rows again:
    a plain JDBC append is at-least-once.
    """
    if is_blank(url):
        raise bad_input("a JDBC url is required")
    spark = record.sparkSession

    def columns_of(name: str) -> list[str] | PySparkException:
        try:
            return spark.read.format("jdbc").options(**options).option("url", url).option("dbtable", name).load().columns
        except PySparkException as error:
            return error

    failed = None
    for name in name_candidates(table):
        columns = columns_of(name)
        if isinstance(columns, list) and columns:
            break
        failed = failed or columns
    else:
        raise failed or bad_input(f"the table {table!r} has no columns")
    matched = matched_columns(record.columns, columns)
    rows = record.select(*(
        flat(source, record.schema[source].dataType).alias(column) for column, source in matched.items()
    ))
    rows.write.format("jdbc").options(**options).option("url", url).option("dbtable", name).mode("append").save()
