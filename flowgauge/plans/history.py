"""The ordered history of an instance and of every instance it called."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.errors import bad_input, incomplete, no_choice, one_of
from flowgauge.functions.clock import hour_slot, iso_text
from flowgauge.operators.closure import call_closure
from flowgauge.operators.filters import families, split_names
from flowgauge.operators.flows import flow_occurrences
from flowgauge.operators.kpi import Kpi
from flowgauge.operators.ranking import CARRIED, placed_entries
from flowgauge.schemas import KEY
from flowgauge.sources.logs import ProcessLogs

# Topics in the order ALL reports them, result types, default size.
TOPICS = (
    "elementId", "elementName", "elementInstanceKey", "sourceRef", "targetRef", "processInstanceKey",
    "processDefinitionId", "processDefinitionName", "processDefinitionVersion", "type", "state",
    "startDate", "endDate", "assignee", "hasIncident", "incidentKey", "tenantId",
)
RESULT_TYPES = ("JSON", "STRING")
DEFAULT_SIZE = 100

_BY_NAME = {topic.lower(): topic for topic in TOPICS}
# Place of an entry among entries of equal start, see flowgauge.operators.ranking.
_PLACE = ("stuck", "lead_is_flow", "lead_element", "lead_instance", "lead_flow", "step")
ORDER = ("start_date", *_PLACE)


def chosen_topics(topics: str | Iterable[str]) -> dict[str, str]:
    """Caller's spelling -> topic, first spelling kept; ``ALL`` stands for every topic."""
    names = split_names(topics)
    if not names:
        raise incomplete("name at least one history topic")
    chosen: dict[str, str] = {}
    for name in names:
        for spelling in TOPICS if name.upper() == "ALL" else (name,):
            topic = _BY_NAME.get(spelling.lower())
            if topic is None:
                raise no_choice("history topics", name, ("ALL", *TOPICS))
            if topic not in chosen.values():
                chosen[spelling] = topic
    return chosen


def positive_size(size: int | str) -> int:
    try:
        value = int(str(size).strip())
    except ValueError:
        value = 0
    if value <= 0:
        raise bad_input(f"the history size has to be a whole number above zero, got {size!r}")
    return value


def element_entries(logs: ProcessLogs, types: list[str]) -> DataFrame:
    """Started elements of the given types, standing for themselves among equal starts."""
    own_place = {
        "stuck": F.lit(False), "lead_is_flow": F.lit(False), "lead_element": F.col("element_instance_key"),
        "lead_instance": F.lit(None).cast("bigint"), "lead_flow": F.lit(""), "step": F.lit(0),
    }
    return logs.element_instances.filter(
        F.col("type").isin(types) & F.col("start_date").isNotNull()
    ).withColumns(own_place)


def earliest_starts(elements: DataFrame, instance: Sequence[str], size: int) -> DataFrame:
    """The elements that start no later than the ``size``-th of their instance, all ties included.

    Needs no places, so nothing is joined yet. First each hour of an instance is cut, then
    what is left of the instance: no task sorts a long instance whole, and for small sizes
    Spark drops the rest before it is exchanged.
    """
    for group in ([*instance, "_hour"], instance):
        by_start = Window.partitionBy(*group).orderBy("start_date")
        elements = elements.withColumn("_hour", hour_slot(F.col("start_date")))
        elements = elements.withColumn("_rank", F.rank().over(by_start)).filter(F.col("_rank") <= size)
    return elements.drop("_hour", "_rank")


def history_entries(
    logs: ProcessLogs, activity_filter: str | Iterable[str] = "ALL", instance: Sequence[str] = (KEY,),
    size: int | None = None,
) -> DataFrame:
    """Elements and flows of each single instance, with the columns of :data:`ORDER`.

    With ``size``, elements that cannot be among the first ``size`` entries of their
    instance are left out at once.
    """
    types, with_flows = families(activity_filter)
    elements = element_entries(logs, types)
    if size is not None:
        elements = earliest_starts(elements, instance, size)
    if not with_flows:
        return elements
    occurrences = flow_occurrences(logs.sequence_flows, logs.flow_topology, logs.element_instances, instance)
    return with_flows_placed(elements, placed_entries(occurrences, types, instance), instance)


def with_flows_placed(elements: DataFrame, placed: DataFrame, instance: Sequence[str] = (KEY,)) -> DataFrame:
    """Give tied elements their places and add the flows, in one full outer join.

    The join key is the element's own key, or a hash of the flow, so rows spread
    evenly whatever the instances hold; ``is_flow`` keeps the two apart.
    """
    is_flow = F.col("flow_id").isNotNull()
    scope = [name for name in instance if name != KEY]
    places = placed.select(
        *scope, is_flow.alias("is_flow"),
        F.when(is_flow, F.xxhash64(KEY, "flow_id")).otherwise(F.col("element_instance_key")).alias("entry"),
        F.struct(
            F.col(KEY), F.col("flow_id").alias("element_id"), *CARRIED,
            F.lit("SEQUENCE_FLOW").alias("type"), "start_date",
        ).alias("flow"),
        F.struct(*_PLACE).alias("place"),
    )
    own = elements.withColumns({"is_flow": F.lit(False), "entry": F.col("element_instance_key"), "own": F.lit(True)})
    of_flow = {name: F.col(f"flow.{name}") for name in (KEY, "element_id", "process_definition_id", "tenant_id",
                                                        "type", "start_date")}
    placed_at = {name: F.col(f"place.{name}") for name in _PLACE}
    # A place without its element belongs to one that was cut.
    both = own.join(places, [*scope, "is_flow", "entry"], "full").filter(F.col("is_flow") | F.col("own"))
    return both.withColumns(
        {name: F.when(F.col("is_flow"), value).otherwise(F.col(name)) for name, value in of_flow.items()}
        | {name: F.when(F.col("place").isNotNull(), value).otherwise(F.col(name)) for name, value in placed_at.items()}
        | {name: F.when(F.col("is_flow"), F.col(f"flow.{name}")) for name in ("source_ref", "target_ref")}
    ).drop("is_flow", "entry", "own", "flow", "place")


def earliest(rows: DataFrame, group: Sequence[str], size: int, position: str) -> DataFrame:
    """The first ``size`` rows of each group."""
    in_order = Window.partitionBy(*group).orderBy(*ORDER)
    return rows.withColumn(position, F.row_number().over(in_order)).filter(F.col(position) <= size)


def with_assignee(entries: DataFrame, user_tasks: DataFrame, instance: Sequence[str] = (KEY,)) -> DataFrame:
    """Add the assignee of user tasks; of several tasks of one element the last one's.

    The instance is part of the join key: sequence flows have no element key, and would
    otherwise all meet in one partition.
    """
    element = [*instance, "element_instance_key"]
    created = F.col("creation_date")
    last = F.struct(created.isNull().alias("undated"), created, F.col("user_task_key"))
    assignees = (
        user_tasks.filter(F.col("assignee").isNotNull() & F.col("element_instance_key").isNotNull())
        .groupBy(*element).agg(F.max_by("assignee", last).alias("assignee"))
    )
    return entries.join(assignees, element, "left")


def with_definition(
    entries: DataFrame, process_instances: DataFrame, instance: Sequence[str] = (KEY,),
) -> DataFrame:
    """Add name and version of the process definition."""
    named = process_instances.select(*instance, "process_definition_name", "process_definition_version")
    return entries.join(named, [*instance], "left")


def _topic_columns(columns: set[str]) -> dict[str, Column]:
    def present(name: str) -> Column:
        return F.col(name) if name in columns else F.lit(None).cast("string")

    return {
        "elementId": F.col("element_id"), "elementName": present("element_name"),
        "elementInstanceKey": present("element_instance_key"),
        "sourceRef": present("source_ref"), "targetRef": present("target_ref"),
        "processInstanceKey": F.col(KEY), "processDefinitionId": F.col("process_definition_id"),
        "processDefinitionName": present("process_definition_name"),
        "processDefinitionVersion": present("process_definition_version"),
        "type": F.col("type"), "state": present("state"),
        "startDate": iso_text(F.col("start_date")),
        "endDate": iso_text(F.col("end_date")) if "end_date" in columns else F.lit(None).cast("string"),
        "assignee": present("assignee"), "hasIncident": present("incident"),
        "incidentKey": present("incident_key"), "tenantId": F.col("tenant_id"),
    }


def history_rows(
    logs: ProcessLogs, topics: str | Iterable[str] = "ALL", activity_filter: str | Iterable[str] = "ALL",
    size: int = DEFAULT_SIZE, root: str | None = None,
) -> DataFrame:
    """One row per history entry: (root_key, position, one column per topic).

    Every instance is a root; its entries are found through the call closure. With
    ``root`` the logs already hold the rows of each root, named by that column.

    Of each root the ``size`` earliest entries are kept. The same limit is applied per
    instance first: what an instance cannot place among its own first ``size`` entries
    it cannot place among its root's. So no instance brings more than ``size`` rows to
    the joins that follow, however long its log is.
    """
    chosen = chosen_topics(topics)
    limit = positive_size(size)
    instance = (KEY,) if root is None else (root, KEY)
    entries = earliest(history_entries(logs, activity_filter, instance, limit), instance, limit, "own_position")
    if {"processDefinitionName", "processDefinitionVersion"} & set(chosen.values()):
        entries = with_definition(entries, logs.process_instances, instance)
    if root is None:
        nested = entries.join(call_closure(logs).select("root_key", KEY), KEY)
    else:
        nested = entries.withColumn("root_key", F.col(root))
    if "assignee" in chosen.values():
        nested = with_assignee(nested, logs.user_tasks, instance)
    shown = _topic_columns(set(nested.columns))
    return earliest(nested, ["root_key"], limit, "position").select(
        "root_key", "position", *(shown[topic].alias(spelling) for spelling, topic in chosen.items())
    )


def as_json(spellings: Iterable[str]) -> Column:
    """One entry as a JSON object; topics without a value are left out."""
    return F.to_json(F.struct(*spellings))


def as_text(spellings: Iterable[str]) -> Column:
    """One entry as ``topic:value`` pairs joined by ``|``; topics without a value are left out."""
    return F.concat_ws("|", *(F.concat(F.lit(f"{name}:"), F.col(name).cast("string")) for name in spellings))


def history_values(
    logs: ProcessLogs, result_type: str = "JSON", topics: str | Iterable[str] = "ALL",
    activity_filter: str | Iterable[str] = "ALL", size: int = DEFAULT_SIZE, root: str | None = None,
) -> DataFrame:
    """(root_key, value): the history of each root rendered as JSON or text.

    At most ``size`` entries meet per root. Roots without any entry have no row.
    """
    shown = one_of(result_type, RESULT_TYPES, "result type of a history")
    spellings = chosen_topics(topics)
    entry = as_json(spellings) if shown == "JSON" else as_text(spellings)
    rows = history_rows(logs, topics, activity_filter, size, root).select("root_key", "position", entry.alias("entry"))
    joined = F.expr("listagg(entry, ',') WITHIN GROUP (ORDER BY position)")
    value = F.concat(F.lit("["), joined, F.lit("]")) if shown == "JSON" else joined
    return rows.groupBy("root_key").agg(value.alias("value"))


def history(
    result_type: str = "JSON", topics: str | Iterable[str] = "ALL",
    activity_filter: str | Iterable[str] = "ALL", size: int = DEFAULT_SIZE, wait_ms: int = 0,
) -> Kpi:
    """The history as a KPI; ``[]`` or ``""`` for an instance without entries.

    ``wait_ms``: on a stream of triggers, how long rows of the log may come after their time.
    """
    if wait_ms < 0:
        raise bad_input(f"a history cannot wait {wait_ms} milliseconds")
    shown = one_of(result_type, RESULT_TYPES, "result type of a history")
    chosen_topics(topics)
    families(activity_filter)
    positive_size(size)

    def build(logs: ProcessLogs, key: str) -> DataFrame:
        if key == KEY:
            values = history_values(logs, shown, topics, activity_filter, size)
        else:
            values = history_values(logs.nested, shown, topics, activity_filter, size, root=key)
        return values.withColumnRenamed("root_key", key)

    empty = F.lit("[]" if shown == "JSON" else "")
    return Kpi(lambda inputs: F.coalesce(inputs.frame, empty), frame=build, nested=True, wait_ms=wait_ms)
