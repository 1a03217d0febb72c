"""The derived log tables in DuckDB SQL, as the common part of every oracle query."""

from __future__ import annotations

_MS = "to_milliseconds(CAST(round(value*60000) AS BIGINT))"

TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), """
SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props,'$.k') AS INT) AS k,
       CAST(floor((day(ts) - 1) / 7) AS BIGINT) AS w,
       user_id * 100 + CAST(floor((day(ts) - 1) / 7) AS BIGINT) AS pik,
       CAST(date_trunc('hour', ts) AS TIMESTAMP) AS sd
FROM events"""),
    "element_instances": (("ev",), f"""
SELECT event_id AS element_instance_key, pik AS process_instance_key, event_type AS element_id,
       upper(event_type) AS element_name, 'user-week' AS process_definition_id,
       CASE event_type WHEN 'view' THEN CASE WHEN k % 5 = 0 THEN 'EXCLUSIVE_GATEWAY' ELSE 'SERVICE_TASK' END
            WHEN 'click' THEN 'USER_TASK' WHEN 'purchase' THEN 'BUSINESS_RULE_TASK'
            WHEN 'signup' THEN 'CALL_ACTIVITY' ELSE 'BOUNDARY_EVENT' END AS type,
       CASE WHEN k % 10 = 0 THEN 'ACTIVE' WHEN k % 7 = 0 THEN 'TERMINATED' ELSE 'COMPLETED' END AS state,
       sd AS start_date,
       CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(sd + {_MS} AS TIMESTAMP) END AS end_date,
       event_type = 'error' AND k % 3 = 0 AS incident,
       CASE WHEN event_type = 'error' AND k % 3 = 0 THEN event_id + 1000000000 END AS incident_key,
       '<default>' AS tenant_id
FROM ev"""),
    "process_instances": (("ev",), """
SELECT p.pik AS process_instance_key, 1 + p.w % 3 AS process_definition_key, 'user-week' AS process_definition_id,
       'User week' AS process_definition_name, CAST(1 + p.w % 3 AS INT) AS process_definition_version,
       concat('U', CAST(p.user_id AS VARCHAR), '-W', CAST(p.w AS VARCHAR)) AS business_id,
       CASE WHEN p.w IN (1, 2, 4) THEN q.last_signup END AS parent_element_instance_key,
       '<default>' AS tenant_id
FROM (SELECT pik, user_id, w FROM ev GROUP BY pik, user_id, w) p
LEFT JOIN (SELECT pik, max(event_id) AS last_signup FROM ev WHERE event_type = 'signup' GROUP BY pik) q
       ON q.pik = p.pik - 1"""),
    "user_tasks": (("ev",), """
SELECT event_id + 2000000000 AS user_task_key, event_id AS element_instance_key, pik AS process_instance_key,
       event_type AS element_id,
       CASE WHEN k % 4 = 0 THEN NULL ELSE concat('user', CAST(event_id % 7 AS VARCHAR)) END AS assignee,
       CASE WHEN k % 11 = 0 THEN NULL ELSE sd END AS creation_date
FROM ev WHERE event_type = 'click'"""),
    "jobs": (("ev",), f"""
SELECT event_id + 3000000000 AS job_key, pik AS process_instance_key, event_type AS element_id,
       CASE WHEN event_type = 'error' THEN CASE k % 3 WHEN 0 THEN 'BAD_AMOUNT' WHEN 1 THEN 'BAD_ACCOUNT' ELSE '' END
            WHEN k % 13 = 0 THEN 'BAD_AMOUNT' END AS error_code,
       CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(sd + {_MS} AS TIMESTAMP) END AS last_update_time
FROM ev WHERE event_type IN ('view', 'error', 'purchase')"""),
    "incidents": (("ev",), """
SELECT event_id + 1000000000 AS incident_key, pik AS process_instance_key,
       CASE WHEN k % 2 = 0 THEN 'error' ELSE 'click' END AS element_id, sd AS creation_time
FROM ev WHERE event_type = 'error' AND k % 3 = 0"""),
    "variables": (("ev",), """
SELECT event_id + 4000000000 AS variable_key, pik AS process_instance_key,
       CASE WHEN rn = 1 THEN pik ELSE event_id + 9000000000 END AS scope_key,
       CASE event_type WHEN 'purchase' THEN 'amount' ELSE 'dueDate' END AS name,
       CASE event_type WHEN 'purchase' THEN CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)
            ELSE concat('"', substr(CAST(sd AS VARCHAR), 1, 10), '"') END AS value
FROM (SELECT *, row_number() OVER (PARTITION BY pik, event_type ORDER BY event_id DESC) AS rn
      FROM ev WHERE event_type IN ('purchase', 'signup')) v"""),
    "decision_instances": (("ev",), """
SELECT event_id + 5000000000 AS decision_instance_key, pik AS process_instance_key,
       CASE WHEN k % 2 = 0 THEN 'GetRiskLevel' ELSE 'GetScore' END AS decision_definition_id,
       CASE WHEN k % 17 = 0 THEN NULL ELSE sd END AS evaluation_date,
       CASE WHEN value < 10 THEN '{"riskLevel":"GREEN"}' WHEN value < 50 THEN '{"riskLevel":"ORANGE"}'
            ELSE '{"riskLevel":"RED"}' END AS result
FROM ev WHERE event_type = 'purchase'"""),
    "message_subscriptions": (("ev",), """
SELECT event_id + 6000000000 AS subscription_key, pik AS process_instance_key,
       CASE WHEN k % 2 = 0 THEN 'KpiStatus' ELSE 'Other' END AS message_name, sd AS correlation_time
FROM ev WHERE event_type = 'view' AND k % 3 = 0"""),
    "sequence_flows": (("ev",), """
SELECT DISTINCT pik AS process_instance_key, 1 + w % 3 AS process_definition_key,
       'user-week' AS process_definition_id, concat('Flow_', prev, '_', event_type) AS element_id,
       '<default>' AS tenant_id
FROM (SELECT *, lag(event_type) OVER (PARTITION BY pik ORDER BY event_id) AS prev FROM ev) x
WHERE prev IS NOT NULL"""),
    "flow_topology": (("ev",), """
SELECT d.k AS process_definition_key, concat('Flow_', a.t, '_', b.t) AS flow_id, a.t AS source_ref,
       CASE WHEN a.t = 'error' AND b.t = 'error' THEN NULL ELSE b.t END AS target_ref
FROM (SELECT DISTINCT 1 + w % 3 AS k FROM ev) d
CROSS JOIN (SELECT DISTINCT event_type AS t FROM ev) a CROSS JOIN (SELECT DISTINCT event_type AS t FROM ev) b"""),
    "closure": (("element_instances", "process_instances"), """
SELECT process_instance_key AS root_key, process_instance_key, CAST(0 AS INT) AS depth FROM process_instances
UNION ALL
SELECT c.root_key, p.process_instance_key, c.depth + 1
FROM closure c
JOIN element_instances e ON e.process_instance_key = c.process_instance_key AND e.type = 'CALL_ACTIVITY'
JOIN process_instances p ON p.parent_element_instance_key = e.element_instance_key"""),
    # Start occurrences of the flows taken, resolved by correlated ranking.
    "flow_starts": (("element_instances", "sequence_flows", "flow_topology"), """
SELECT * EXCLUDE (pick) FROM (
  SELECT f.process_instance_key, f.element_id AS flow_id, f.process_definition_id, f.tenant_id,
         g.source_ref, t.element_instance_key AS target_key, t.element_id AS target_id,
         t.start_date, t.type AS target_type,
         row_number() OVER (PARTITION BY f.process_instance_key, f.element_id
                            ORDER BY t.start_date, t.element_instance_key) AS pick
  FROM sequence_flows f
  JOIN flow_topology g ON g.process_definition_key = f.process_definition_key AND g.flow_id = f.element_id
  JOIN element_instances t ON t.process_instance_key = f.process_instance_key AND t.element_id = g.target_ref
                          AND t.start_date IS NOT NULL) x
WHERE pick = 1"""),
    "flow_ends": (("flow_starts", "element_instances"), """
SELECT * EXCLUDE (pick) FROM (
  SELECT f.*, s.element_instance_key AS source_key, s.element_id AS source_id, s.type AS source_type,
         s.start_date AS source_start,
         row_number() OVER (PARTITION BY f.process_instance_key, f.flow_id
                            ORDER BY s.start_date DESC NULLS LAST, s.element_instance_key) AS pick
  FROM flow_starts f
  LEFT JOIN element_instances s ON s.process_instance_key = f.process_instance_key
       AND s.element_id = f.source_ref AND s.start_date <= f.start_date) x
WHERE pick = 1"""),
}


def with_tables(query: str, *names: str, **extra: str) -> str:
    """``query`` preceded by the CTEs it needs; ``extra`` adds CTEs of its own, in order."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        needs, body = TABLES[name]
        for need in needs:
            add(need)
        ordered.setdefault(name, body)

    for name in names:
        add(name)
    ordered |= extra
    ctes = ",\n".join(f"{name} AS ({body}\n)" for name, body in ordered.items())
    return f"WITH RECURSIVE {ctes}\n{query}"
