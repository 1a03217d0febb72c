"""What several operators share: words, tables kept between jobs, deterministic order, row keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.operators.checkpoints import shared_folder

# What separates words, as a character class of Java and Python expressions.
SPACE = r"[\x20\x09-\x0D]"


# Shuffle files of a query are deleted at its end, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at files that every executor sees.

    The shuffle files behind ``df`` are not needed after that and are deleted.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/flowgauge-llm-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text, none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once per row, also where ``body`` uses it inside of lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_key(*columns: Column) -> list[Column]:
    """96 bits of a row's content. Equal rows have equal keys, whatever order the rows are read in."""
    texts = [F.coalesce(c.cast("string"), F.lit("\0null")) for c in columns]
    return [F.xxhash64(*texts), F.hash(*reversed(texts))]


def unit_hash(*columns: Column, seed: int = 0) -> Column:
    """A number in (0, 1) that depends on the values and the seed alone."""
    return ((F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit((1 << 52) - 1))).cast("double") + 0.5) / float(1 << 52)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
