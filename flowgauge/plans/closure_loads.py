"""The call closure kept up to date: each load of the logs adds the pairs that its calls make, and no other.

Stored under one folder, one part per load: calls (call activities and their instances), called (instances and the call
that started them) and pairs (root, instance, depth). A link from a caller to a called instance is made by the load that
brings the later of its two rows. Let L be the new links and C the stored closure, every instance related to itself
included. Every new path begins with a stretch of C and goes on with links of L, each followed by a stretch of C; so the
new pairs are C (L C)+. Only L C is closed, by doubling; pairs that are stored are read where they meet a new link, and
never made again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.operators.closure import closed
from flowgauge.operators.checkpoints import checkpointed
from flowgauge.schemas import KEY
from flowgauge.sources.logs import ProcessLogs

_CALL = "parent_element_instance_key"
_SCHEMAS = {
    "calls": f"{_CALL} bigint, caller bigint", "called": f"{_CALL} bigint, called bigint",
    "pairs": f"root_key bigint, {KEY} bigint, depth int",
}


def _earlier(spark: SparkSession, path: str, part: str, load: int) -> DataFrame:
    """What the loads before ``load`` have stored."""
    schema = _SCHEMAS[part] + ", load int"
    try:
        rows = spark.read.schema(schema).option("basePath", f"{path}/{part}").parquet(f"{path}/{part}")
    except AnalysisException:
        rows = spark.createDataFrame([], schema)
    return rows.filter(F.col("load") < load).drop("load")


def add_closure_load(logs: ProcessLogs, path: str, load: int) -> None:
    """Store the pairs that load number ``load`` adds to the closure under ``path``.

    Loads are numbered upwards; each row of a log comes in one of them, in any order: an instance may come before the
    call that started it. Storing the last load again replaces it, so a repeated job leaves no duplicates. A cycle of
    calls is refused.
    """
    spark = logs.process_instances.sparkSession
    calls = logs.element_instances.filter(F.col("type") == "CALL_ACTIVITY").select(
        F.col("element_instance_key").alias(_CALL), F.col(KEY).alias("caller")
    )
    called = logs.process_instances.filter(F.col(_CALL).isNotNull()).select(_CALL, F.col(KEY).alias("called"))
    for part, rows in (("calls", calls), ("called", called)):
        rows.write.mode("overwrite").parquet(f"{path}/{part}/load={load}")
    calls, called = (
        spark.read.schema(_SCHEMAS[part]).parquet(f"{path}/{part}/load={load}") for part in ("calls", "called")
    )
    old_calls, old_called = (_earlier(spark, path, part, load) for part in ("calls", "called"))
    links = called.join(calls.unionByName(old_calls), _CALL).unionByName(old_called.join(calls, _CALL))
    links = checkpointed(links.select("caller", "called"))

    old = _earlier(spark, path, "pairs", load).filter("depth > 0")
    # L C: from a new link's caller to what hangs below its called instance, itself included.
    below = old.join(links.withColumnRenamed("called", "root_key"), "root_key").select(
        F.col("caller").alias("root_key"), KEY, (F.col("depth") + 1).alias("depth")
    )
    direct = links.select(F.col("caller").alias("root_key"), F.col("called").alias(KEY), F.lit(1).alias("depth"))
    steps = closed(checkpointed(direct.unionByName(below)), links.select(F.col("caller").alias("root_key")).distinct())
    # What hangs above a new link's caller reaches as far as the caller does.
    above = old.select(F.col("root_key").alias("top"), F.col(KEY).alias("root_key"), F.col("depth").alias("up"))
    far = steps.join(above, "root_key").select(F.col("top").alias("root_key"), KEY, (F.col("depth") + F.col("up")).alias("depth"))
    itself = logs.process_instances.select(F.col(KEY).alias("root_key"), F.col(KEY), F.lit(0).alias("depth"))
    new = steps.unionByName(far).unionByName(itself)
    new.write.mode("overwrite").parquet(f"{path}/pairs/load={load}")


def stored_closure(spark: SparkSession, path: str) -> DataFrame:
    """(root_key, process_instance_key, depth) of all loads, as ``call_closure`` gives over all their rows at once."""
    return spark.read.schema(_SCHEMAS["pairs"]).parquet(f"{path}/pairs").select("root_key", KEY, "depth")
