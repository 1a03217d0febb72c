"""Call-activity closure: every instance with all instances it called, at any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.errors import bad_input
from flowgauge.operators.checkpoints import checkpointed
from flowgauge.schemas import KEY
from flowgauge.sources.logs import ProcessLogs


def call_links(logs: ProcessLogs) -> DataFrame:
    """(caller, called): the instance owning a call activity and the instance it started."""
    calls = logs.element_instances.filter(F.col("type") == "CALL_ACTIVITY").select(
        F.col("element_instance_key").alias("parent_element_instance_key"), F.col(KEY).alias("caller")
    )
    called = logs.process_instances.filter(F.col("parent_element_instance_key").isNotNull()).select(
        "parent_element_instance_key", F.col(KEY).alias("called")
    )
    return called.join(calls, "parent_element_instance_key").select("caller", "called")


def call_closure(logs: ProcessLogs) -> DataFrame:
    """(root_key, process_instance_key, depth), depth 0 being the instance itself.

    Every instance is a root. Ancestors are found by doubling: after round n all pairs
    up to 2^n calls apart are known, so a chain of a thousand nested calls takes ten
    joins. Each round is written to the shared folder, which keeps the plan flat.

    An instance has one caller, so in each join one side is unique on the join key and
    the other may be hot (a caller with very many called instances); no aggregate
    follows on that key, so adaptive execution may split such a partition.
    """
    links = checkpointed(call_links(logs).select(
        F.col("caller").alias("root_key"), F.col("called").alias(KEY), F.lit(1).alias("depth")
    ))
    found, latest, reach = links, links, 1
    while _has_rows(latest):
        # Pairs exactly `reach` calls apart: unique on the called side.
        step = latest.filter(F.col("depth") == reach).select(
            F.col(KEY).alias("root_key"), F.col("root_key").alias("far_root")
        )
        latest = checkpointed(
            found.join(step, "root_key")
            .select(F.col("far_root").alias("root_key"), KEY, (F.col("depth") + reach).alias("depth"))
        )
        found = found.unionByName(latest)
        reach *= 2
    itself = logs.process_instances.select(
        F.col(KEY).alias("root_key"), F.col(KEY), F.lit(0).alias("depth")
    )
    return itself.unionByName(found)


def closed(steps: DataFrame, starts: DataFrame) -> DataFrame:
    """All chains of ``steps`` (root_key, process_instance_key, depth), each step beginning at one of ``starts``.

    A step's end may begin others, which go on from there; depths add up. Rounds double the number of steps in a chain.
    Steps have different ends unless their roots differ, as those of a forest of calls do, so no pair is found twice.
    """
    found, latest = steps, steps
    # Chains of exactly `reach` steps that end where another step begins.
    begins = starts.select(F.col("root_key").alias(KEY))
    power = checkpointed(steps.join(begins, KEY, "left_semi"))
    while _has_rows(latest):
        longer = power.select(F.col(KEY).alias("root_key"), F.col("root_key").alias("far_root"), F.col("depth").alias("ahead"))
        latest = checkpointed(found.join(longer, "root_key").select(
            F.col("far_root").alias("root_key"), KEY, (F.col("depth") + F.col("ahead")).alias("depth")
        ))
        ahead = power.select(F.col(KEY).alias("root_key"), F.col("root_key").alias("far_root"), F.col("depth").alias("ahead"))
        power = checkpointed(power.join(ahead, "root_key").select(
            F.col("far_root").alias("root_key"), KEY, (F.col("depth") + F.col("ahead")).alias("depth")
        ))
        found = found.unionByName(latest)
    return found


def calls_below(logs: ProcessLogs, roots: DataFrame, until: str) -> DataFrame:
    """``roots``, which hold an instance key and other columns, and a row for every
    instance called below them with the same other columns.

    Calls started after the root's ``until`` column are left out. Goes down call by call,
    so that only what hangs below the given roots is touched.
    """
    carried = [name for name in roots.columns if name != KEY]
    calls = logs.element_instances.filter(F.col("type") == "CALL_ACTIVITY").select(
        KEY, F.col("element_instance_key").alias("parent_element_instance_key"),
        F.col("start_date").alias("called_at"),
    )
    called = logs.process_instances.select("parent_element_instance_key", F.col(KEY).alias("called"))
    def down(level: DataFrame) -> DataFrame:
        return checkpointed(
            level.join(calls, KEY).filter(F.col("called_at").isNull() | (F.col("called_at") <= F.col(until)))
            .join(called, "parent_element_instance_key")
            .select(*carried, F.col("called").alias(KEY), "root_key")
        )

    found = roots.withColumn("root_key", F.col(KEY))
    level = down(found)
    while _has_rows(level):
        found = found.unionByName(level)
        level = down(level)
    return found.select(*carried, KEY)


def _has_rows(pairs: DataFrame) -> bool:
    """Whether a round found anything; an instance that calls itself would never end."""
    row = pairs.agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.col("root_key") == F.col(KEY)).alias("circular")
    ).first()
    if row["circular"]:
        raise bad_input("the call links between instances form a cycle")
    return row["n"] > 0
