"""Call closure, sequence flows and history, as Spark queries and as DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.operators.checkpoints import shared_folder
from flowgauge.operators.closure import call_closure
from flowgauge.operators.filters import FAMILIES
from flowgauge.operators.flows import flow_occurrences, resolved_flows, with_target
from flowgauge.plans import history as plan
from flowgauge.plans.closure_loads import add_closure_load, stored_closure
from flowgauge.schemas import KEY
from flowgauge.sources.logs import ProcessLogs
from flowgauge.sources.topology import flow_topology
from workload.tables import TABLES, with_tables

LogQuery = Callable[[ProcessLogs], DataFrame]

ALL_TYPES = FAMILIES["ALL"]


def _types(names) -> str:
    return ", ".join(f"'{name}'" for name in names)


def _iso(column: str) -> str:
    """DuckDB prints no trailing zeros of the fraction either."""
    return f"replace(CAST({column} AS VARCHAR), ' ', 'T') || 'Z'"


def entries_sql(types) -> str:
    """Elements and flows of each instance with the keys the ranking needs."""
    return f"""
SELECT process_instance_key, FALSE AS is_flow, element_instance_key AS ekey, '' AS fid, start_date,
       CAST(NULL AS BIGINT) AS source_key, CAST(NULL AS BIGINT) AS target_key,
       element_id, element_name, CAST(NULL AS VARCHAR) AS source_ref, CAST(NULL AS VARCHAR) AS target_ref,
       process_definition_id, type, state, end_date, incident, incident_key, tenant_id
FROM element_instances WHERE type IN ({_types(types)}) AND start_date IS NOT NULL
UNION ALL
SELECT process_instance_key, TRUE, NULL, flow_id, start_date, source_key, target_key,
       flow_id, NULL, source_id, target_id, process_definition_id, 'SEQUENCE_FLOW', NULL, NULL, NULL, NULL, tenant_id
FROM flow_ends"""


# The ranking spelled out over whole tie groups of a root: number the entries, list the
# edges, and take the first entry without a predecessor until none is left.
_NUMBERED = """
SELECT c.root_key, e.*, row_number() OVER (PARTITION BY c.root_key, e.start_date
       ORDER BY e.is_flow, e.ekey, e.process_instance_key, e.fid) AS idx
FROM closure c JOIN entries e ON e.process_instance_key = c.process_instance_key"""

_EDGES = """
SELECT DISTINCT root_key, start_date, a, b FROM (
  SELECT f.root_key, f.start_date, s.idx AS a, f.idx AS b FROM numbered f
  JOIN numbered s ON s.root_key = f.root_key AND s.start_date = f.start_date AND s.ekey = f.source_key
  WHERE f.is_flow
  UNION ALL
  SELECT f.root_key, f.start_date, f.idx, t.idx FROM numbered f
  JOIN numbered t ON t.root_key = f.root_key AND t.start_date = f.start_date AND t.ekey = f.target_key
  WHERE f.is_flow) x"""

_GROUPS = """
SELECT n.root_key, n.start_date, n.left_over, e.edges FROM
  (SELECT root_key, start_date, list(CAST(idx AS BIGINT) ORDER BY idx) AS left_over FROM numbered GROUP BY 1, 2) n
  JOIN (SELECT root_key, start_date, list({'a': CAST(a AS BIGINT), 'b': CAST(b AS BIGINT)}) AS edges
        FROM edges GROUP BY 1, 2) e USING (root_key, start_date)"""

_SORTING = """
SELECT root_key, start_date, left_over, edges, CAST([] AS BIGINT[]) AS placed FROM groups
UNION ALL
SELECT root_key, start_date,
       CASE WHEN nxt IS NULL THEN CAST([] AS BIGINT[]) ELSE list_filter(left_over, lambda x: x <> nxt) END,
       list_filter(edges, lambda e: e.a <> coalesce(nxt, 0)),
       CASE WHEN nxt IS NULL THEN list_concat(placed, left_over) ELSE list_append(placed, nxt) END
FROM (SELECT *, list_min(list_filter(left_over,
             lambda x: NOT list_contains(list_transform(edges, lambda e: e.b), x))) AS nxt
      FROM sorting WHERE len(left_over) > 0) s"""

_RANKED = """
SELECT n.*, row_number() OVER (PARTITION BY n.root_key ORDER BY n.start_date, coalesce(r.rank, n.idx)) AS position
FROM numbered n LEFT JOIN (
  SELECT root_key, start_date, unnest(placed) AS idx, generate_subscripts(placed, 1) AS rank
  FROM sorting WHERE len(left_over) = 0) r USING (root_key, start_date, idx)"""


def ranked_sql(query: str, types=ALL_TYPES, nested: bool = True, **extra: str) -> str:
    """SQL over the ``ranked`` entries of each root, or of each instance by itself."""
    roots = {} if nested else {"closure": (
        "SELECT process_instance_key AS root_key, process_instance_key, 0 AS depth FROM process_instances"
    )}
    return with_tables(
        query, "process_instances", *(["closure"] if nested else []), "flow_ends", **roots,
        entries=entries_sql(types), numbered=_NUMBERED, edges=_EDGES, groups=_GROUPS, sorting=_SORTING,
        ranked=_RANKED, **extra,
    )


_ENRICHED = """
SELECT r.*, p.process_definition_name, p.process_definition_version, u.assignee
FROM ranked r JOIN process_instances p ON p.process_instance_key = r.process_instance_key
LEFT JOIN (SELECT element_instance_key, assignee FROM (SELECT *, row_number() OVER (
    PARTITION BY element_instance_key ORDER BY creation_date IS NOT NULL, creation_date DESC, user_task_key DESC) AS rn
    FROM user_tasks WHERE assignee IS NOT NULL) x WHERE rn = 1) u ON u.element_instance_key = r.ekey"""

TOPIC_COLUMNS = {
    "elementId": ("element_id", True), "elementName": ("element_name", True),
    "elementInstanceKey": ("ekey", False), "sourceRef": ("source_ref", True), "targetRef": ("target_ref", True),
    "processInstanceKey": ("process_instance_key", False),
    "processDefinitionId": ("process_definition_id", True),
    "processDefinitionName": ("process_definition_name", True),
    "processDefinitionVersion": ("process_definition_version", False),
    "type": ("type", True), "state": ("state", True), "startDate": (_iso("start_date"), True),
    "endDate": (_iso("end_date"), True), "assignee": ("assignee", True), "hasIncident": ("incident", False),
    "incidentKey": ("incident_key", False), "tenantId": ("tenant_id", True),
}


def rendered_sql(json: bool, topics, types, size: int, empty: str) -> str:
    if json:
        pairs = [
            f"""'"{name}":' || """ + (f"""'"' || {sql} || '"'""" if quoted else f"CAST({sql} AS VARCHAR)")
            for name, (sql, quoted) in TOPIC_COLUMNS.items() if name in topics
        ]
        entry = f"'{{' || concat_ws(',', {', '.join(pairs)}) || '}}'"
        value = "'[' || x.v || ']'"
    else:
        pairs = [f"'{name}:' || CAST({sql} AS VARCHAR)" for name, (sql, _) in TOPIC_COLUMNS.items() if name in topics]
        entry, value = f"concat_ws('|', {', '.join(pairs)})", "x.v"
    query = f"""
SELECT p.process_instance_key, coalesce({value}, '{empty}') AS value FROM process_instances p LEFT JOIN (
  SELECT root_key, string_agg({entry}, ',' ORDER BY position) AS v
  FROM enriched WHERE position <= {size} GROUP BY 1) x ON x.root_key = p.process_instance_key"""
    return ranked_sql(query, types, user_tasks=TABLES["user_tasks"][1], enriched=_ENRICHED)


STRING_TOPICS = "elementId|type|startDate|endDate|hasIncident"


def _resolved(logs: ProcessLogs) -> DataFrame:
    return resolved_flows(logs.sequence_flows, logs.flow_topology).select(
        KEY, "flow_id", "source_ref", "target_ref"
    )


def _target(logs: ProcessLogs) -> DataFrame:
    dated = with_target(resolved_flows(logs.sequence_flows, logs.flow_topology), logs.element_instances)
    return dated.select(
        KEY, "flow_id", F.col("target.element_instance_key").alias("target_key"),
        F.col("target.start_date").alias("start_date"),
    )


def _occurrences(logs: ProcessLogs) -> DataFrame:
    return flow_occurrences(logs.sequence_flows, logs.flow_topology, logs.element_instances)


def _source(logs: ProcessLogs) -> DataFrame:
    return _occurrences(logs).select(
        KEY, "flow_id", F.col("source.element_instance_key").alias("source_key"),
        F.col("source.start_date").alias("source_start"),
    )


def _ranks(logs: ProcessLogs) -> DataFrame:
    """Place of each entry among those of its instance that start at the same instant."""
    ties = Window.partitionBy(KEY, "start_date").orderBy(*plan.ORDER[1:])
    return plan.history_entries(logs, "ALL").select(
        KEY, "start_date", "element_id", "element_instance_key", F.row_number().over(ties).alias("place")
    )


def _flows(logs: ProcessLogs) -> DataFrame:
    return plan.history_entries(logs, "SEQUENCE").select(
        KEY, "process_definition_id", "tenant_id", "element_id", "source_ref", "target_ref", "type", "start_date"
    )


def _elements(logs: ProcessLogs) -> DataFrame:
    nested = call_closure(logs).select("root_key", KEY)
    entries = plan.element_entries(logs, list(FAMILIES["TASK"]))
    return entries.join(nested, KEY).select("root_key", KEY, "element_instance_key", "element_id", "start_date")


def _assignee(logs: ProcessLogs) -> DataFrame:
    entries = plan.element_entries(logs, ["USER_TASK"])
    return plan.with_assignee(entries, logs.user_tasks).select("element_instance_key", "assignee")


def _definition(logs: ProcessLogs) -> DataFrame:
    entries = plan.element_entries(logs, list(ALL_TYPES))
    return plan.with_definition(entries, logs.process_instances).select(
        "element_instance_key", "process_definition_name", "process_definition_version"
    )


def _entries(logs: ProcessLogs) -> DataFrame:
    return plan.history_entries(logs, "ALL").select(KEY, "element_id", "element_instance_key", "type", "start_date")


def _rows(size: int) -> LogQuery:
    def query(logs: ProcessLogs) -> DataFrame:
        return plan.history_rows(logs, "elementId|elementInstanceKey|type|processInstanceKey|startDate", "ALL", size)

    return query


_ROWS_SQL = """
SELECT root_key, CAST(position AS INTEGER) AS position, element_id AS elementId, ekey AS elementInstanceKey, type,
       process_instance_key AS processInstanceKey, {iso} AS startDate
FROM ranked WHERE position <= {size}"""


def _history(*arguments) -> LogQuery:
    def query(logs: ProcessLogs) -> DataFrame:
        from flowgauge.plans.record import single_kpi

        return single_kpi(logs, plan.history(*arguments))

    return query


def _closure_loads(logs: ProcessLogs) -> DataFrame:
    """The closure of logs that come in three loads, instances and calls in any order."""
    spark = logs.process_instances.sparkSession
    place = f"{shared_folder(spark)}/flowgauge-{uuid.uuid4().hex}"
    for load in range(3):
        part = F.pmod(F.xxhash64(F.coalesce("element_instance_key", KEY)), F.lit(3)) == load
        own = F.pmod(F.xxhash64(KEY), F.lit(3)) == load
        add_closure_load(ProcessLogs.of(
            element_instances=logs.element_instances.filter(part), process_instances=logs.process_instances.filter(own),
        ), place, load)
    return stored_closure(spark, place)


_TOPOLOGY_SQL = with_tables("""
SELECT process_instance_key AS process_definition_key, element_id AS flow_id, split_part(element_id, '_', 2) AS source_ref,
       CASE WHEN element_id <> 'Flow_error_error' THEN split_part(element_id, '_', 3) END AS target_ref
FROM sequence_flows WHERE process_instance_key % 10 <> 0""", "sequence_flows")

# Name -> (query over the logs, DuckDB SQL)
QUERIES: dict[str, tuple[LogQuery, str]] = {
    "call_closure_loads": (
        _closure_loads, with_tables("SELECT root_key, process_instance_key, depth FROM closure", "closure"),
    ),
    "call_closure": (
        call_closure, with_tables("SELECT root_key, process_instance_key, depth FROM closure", "closure"),
    ),
    "flow_topology": (lambda logs: flow_topology(logs.definitions), _TOPOLOGY_SQL),
    "flow_resolved": (
        _resolved,
        with_tables("""
SELECT f.process_instance_key, f.element_id AS flow_id, g.source_ref, g.target_ref FROM sequence_flows f
JOIN flow_topology g ON g.process_definition_key = f.process_definition_key AND g.flow_id = f.element_id
WHERE g.target_ref IS NOT NULL""", "sequence_flows", "flow_topology"),
    ),
    "flow_target": (
        _target, with_tables("SELECT process_instance_key, flow_id, target_key, start_date FROM flow_starts", "flow_starts"),
    ),
    "flow_source_asof": (
        _source, with_tables("SELECT process_instance_key, flow_id, source_key, source_start FROM flow_ends", "flow_ends"),
    ),
    "topology_rank": (
        _ranks,
        ranked_sql("""
SELECT process_instance_key, start_date, element_id, ekey AS element_instance_key,
       CAST(row_number() OVER (PARTITION BY process_instance_key, start_date ORDER BY position) AS INTEGER) AS place
FROM ranked""", nested=False),
    ),
    "history_entries": (
        _entries,
        with_tables("""SELECT process_instance_key, element_id, ekey AS element_instance_key, type, start_date
FROM entries""", "flow_ends", entries=entries_sql(ALL_TYPES)),
    ),
    "history_elements": (
        _elements,
        with_tables(f"""
SELECT c.root_key, e.process_instance_key, e.element_instance_key, e.element_id, e.start_date
FROM closure c JOIN element_instances e USING (process_instance_key)
WHERE e.type IN ({_types(FAMILIES["TASK"])})""", "closure"),
    ),
    "history_assignee": (
        _assignee,
        with_tables("""
SELECT e.element_instance_key, u.assignee FROM element_instances e
LEFT JOIN (SELECT * FROM user_tasks WHERE assignee IS NOT NULL) u USING (element_instance_key)
WHERE e.type = 'USER_TASK'""", "element_instances", "user_tasks"),
    ),
    "history_definition": (
        _definition,
        with_tables(f"""
SELECT e.element_instance_key, p.process_definition_name, p.process_definition_version
FROM element_instances e LEFT JOIN process_instances p USING (process_instance_key)
WHERE e.type IN ({_types(ALL_TYPES)})""", "element_instances", "process_instances"),
    ),
    "history_flows": (
        _flows,
        with_tables("""
SELECT process_instance_key, process_definition_id, tenant_id, flow_id AS element_id, source_id AS source_ref,
       target_id AS target_ref, 'SEQUENCE_FLOW' AS type, start_date FROM flow_ends""", "flow_ends"),
    ),
    "history": (_rows(100), ranked_sql(_ROWS_SQL.format(iso=_iso("start_date"), size=100))),
    "history_large": (_rows(2000), ranked_sql(_ROWS_SQL.format(iso=_iso("start_date"), size=2000))),
    "history_topk": (_rows(7), ranked_sql(_ROWS_SQL.format(iso=_iso("start_date"), size=7))),
    "history_json": (_history(), rendered_sql(True, tuple(TOPIC_COLUMNS), ALL_TYPES, 100, "[]")),
    "history_string": (
        _history("string", STRING_TOPICS, "TASK|SEQUENCE", 10),
        rendered_sql(False, STRING_TOPICS.split("|"), FAMILIES["TASK"], 10, ""),
    ),
}
