"""Shards of equal size by histogram sort."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import stored
from flowgauge.llm.histogram import part_of, splitters

KEYS = ["_text", "_high", "_low"]


def histogram_sort(
    docs: DataFrame, shards: int = 8, parts_per_shard: int = 8, tolerance: float = 1e-3, cell_bytes: int = 64 << 20,
    id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``: shards of nearly equal bytes, sorted by text hash and id.

    The size of a row is the number of UTF-8 bytes of its text, plus 1. Rows are ordered by a hash of their text, then by
    id, so equal texts stand together and only a group that reaches over a shard's end is divided. The boundaries come
    from exact byte counts below candidate keys, refined over narrow rows until they are within ``tolerance`` of a
    shard's mean, for ``parts_per_shard`` equal parts of each shard. Then whole rows are exchanged once and numbered:
    ``slot`` counts from 0 in each shard, part by part in their order. A part larger than ``cell_bytes`` is dealt to cells
    by a hash of its keys, and its rows are in order within each cell: no task gets more than a cell, however large the
    table or a group of equal texts is.

    Rows equal in id and text stay together unless a boundary falls into their midst. Such groups, one for each boundary
    at most, are written once with a number for each row, which then is their last key, so that they can be divided.

    A null text has size 1 and stands with the other null texts. Ids are whole numbers; a null id comes first. All columns
    are passed on; columns named like the results are replaced. An empty table gives an empty result.
    """
    keyed = docs.select("*", *(c.alias(k) for k, c in zip(KEYS, _keys(docs, id, text))),
                        (F.coalesce(F.octet_length(docs[text]), F.lit(0)) + 1).cast("bigint").alias("_size"))
    narrow = stored(keyed.select(*KEYS, "_size"))
    total = narrow.agg(F.sum("_size")).first()[0] or 0
    parts = shards * parts_per_shard
    targets, close = [total * k / parts for k in range(1, parts)], tolerance * total / shards
    keys, torn = KEYS, set()
    found = splitters(narrow, keys, "_size", targets, close, torn=torn)
    if torn:
        keyed, keys = _numbered(keyed, torn), [*KEYS, "_nth"]
        narrow = stored(keyed.select(*keys, "_size"))
        found = splitters(narrow, keys, "_size", targets, close)
    found = sorted(found)
    part = part_of(keys, found)
    cell = F.pmod(F.xxhash64(*keys), F.lit(max(1, ceil(total / parts / cell_bytes)))).cast("int")
    counted = stored(narrow.groupBy(part.alias("_p"), cell.alias("_c")).agg(F.count("*").alias("n")))
    of_part = {r["_p"]: r["n"] for r in counted.groupBy("_p").agg(F.sum("n").alias("n")).collect()}
    ahead = [sum(of_part.get(q, 0) for q in range(p - p % parts_per_shard, p)) for p in range(parts)]
    earlier = Window.partitionBy("_p").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counted.select("_p", "_c", (
        F.coalesce(F.sum("n").over(earlier), F.lit(0)) + F.get(F.array(*map(F.lit, ahead)), F.col("_p"))
    ).alias("_before")))
    order = Window.partitionBy("_part", "_cell").orderBy(*keys)
    numbered = keyed.withColumns({"_part": part, "_cell": cell}).withColumn("_row", F.row_number().over(order) - 1)
    return numbered.join(starts, (F.col("_part") == F.col("_p")) & (F.col("_cell") == F.col("_c")), "left").withColumns({
        "size": F.col("_size"), "shard": F.floor(F.col("_part") / parts_per_shard).cast("int"),
        "slot": (F.col("_before") + F.col("_row")).cast("bigint"),
    }).drop(*keys, "_size", "_part", "_cell", "_row", "_p", "_c", "_before")


def _numbered(keyed: DataFrame, torn: set) -> DataFrame:
    """``keyed`` with ``_nth``, a number that tells the rows of each group in ``torn`` apart, 0 for all other rows.

    The groups are written, so that a task that is run again reads the same numbers.
    """
    among = reduce(Column.__or__, (
        reduce(Column.__and__, (F.col(k) == F.lit(v) for k, v in zip(KEYS, group))) for group in sorted(torn)
    ))
    # A task's number and a row's place in it: below 2 ** 53 with up to a million tasks, so a double holds it.
    apart = stored(keyed.filter(among).withColumn("_nth", F.monotonically_increasing_id().cast("double")))
    return keyed.filter(~among).withColumn("_nth", F.lit(0.0)).unionByName(apart)


def _keys(docs: DataFrame, id: str, text: str) -> list:
    """Keys that a double holds exactly: 52 bits of the text's hash, the id in two halves."""
    hashed = F.shiftrightunsigned(F.xxhash64(F.coalesce(docs[text], F.lit("\0null"))), 12)
    number = docs[id].cast("bigint")
    high = F.coalesce(F.shiftright(number, 32), F.lit(-(1 << 33)))
    low = F.coalesce(number.bitwiseAND(F.lit((1 << 32) - 1)), F.lit(0))
    return [hashed.cast("double"), high.cast("double"), low.cast("double")]
