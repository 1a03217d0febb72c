"""Sequence flows taken: their ends in the process model and the occurrences they join.

``instance`` names the columns that tell instances apart: the instance key, or a
trigger and the instance key where logs are seen as of several moments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.schemas import KEY


def resolved_flows(flows: DataFrame, topology: DataFrame) -> DataFrame:
    """Flows with their source and target element; flows without a known target are dropped.

    The topology is joined without a hint: whether it is small enough to broadcast is
    decided by its measured size.
    """
    known = topology.filter(F.col("target_ref").isNotNull())
    typed = flows.withColumn("process_definition_key", F.col("process_definition_key").try_cast("bigint"))
    return typed.withColumnRenamed("element_id", "flow_id").join(
        known, ["process_definition_key", "flow_id"]
    )


def occurrence() -> Column:
    return F.struct("element_instance_key", "element_id", "type", "start_date")


def with_target(resolved: DataFrame, elements: DataFrame, instance: Sequence[str] = (KEY,)) -> DataFrame:
    """Flows with the earliest occurrence of their target; flows not arrived yet are dropped."""
    order = F.struct("start_date", "element_instance_key")
    first = elements.filter(F.col("start_date").isNotNull()).groupBy(
        *instance, F.col("element_id").alias("target_ref")
    ).agg(F.min_by(occurrence(), order).alias("target"))
    return resolved.join(first, [*instance, "target_ref"])


def with_source(dated: DataFrame, elements: DataFrame, instance: Sequence[str] = (KEY,)) -> DataFrame:
    """Flows with the latest occurrence of their source no later than the target's start.

    An as-of join, backward and inclusive. Flows whose source never ran keep a null
    source. The inner join is on (instance, element), where a hot pair can be split at
    run time because the aggregate after it groups by other keys; its maximum is
    combined on the map side.
    """
    probe = dated.filter(F.col("source_ref").isNotNull()).select(
        *instance, "flow_id", F.col("source_ref").alias("element_id"), F.col("target.start_date").alias("arrived")
    ).distinct()
    order = F.struct(F.col("start_date"), (-F.col("element_instance_key")).alias("key"))
    sources = (
        elements.select(*instance, "element_instance_key", "element_id", "type", "start_date")
        .join(probe, [*instance, "element_id"])
        .filter(F.col("start_date") <= F.col("arrived"))
        .groupBy(*instance, "flow_id").agg(F.max_by(occurrence(), order).alias("source"))
    )
    return dated.join(sources, [*instance, "flow_id"], "left")


def flow_occurrences(
    flows: DataFrame, topology: DataFrame, elements: DataFrame, instance: Sequence[str] = (KEY,),
) -> DataFrame:
    """Flows taken with ``source`` and ``target`` occurrences, both structs."""
    dated = with_target(resolved_flows(flows, topology), elements, instance)
    return with_source(dated, elements, instance)
