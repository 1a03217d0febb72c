"""Spreading one hot key over many tasks.

One instance may hold a large share of a log. Plain aggregates are safe, because
they combine on the map side; joins of raw rows on the instance are not. Such a
join is made on (key, salt): the many rows take one salt each and the few rows on
the other side are repeated once per salt. The aggregate that follows is on
the key alone, so it needs a shuffle of its own, which leaves adaptive execution
free to split a partition that is still too large.

Partitions that adaptive execution puts together follow the compressed size. Where rows
are much larger than that, or a task holds them several times over, their number is
given instead, and follows the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 8
SALT = "_salt"


def salted(rows: DataFrame, unique: str, salts: int = SALTS) -> DataFrame:
    """Give each row of the large side one salt, taken from its own unique key."""
    return rows.withColumn(SALT, F.pmod(F.xxhash64(unique), F.lit(salts)))


def repeated(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """Repeat each row of the small side once per salt."""
    return rows.withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))


def partitions_for(rows: int, rows_each: int) -> int:
    """In how many partitions ``rows`` lie if each has about ``rows_each``."""
    return max(1, -(-rows // rows_each))
