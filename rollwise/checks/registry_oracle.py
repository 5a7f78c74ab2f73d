"""Oracle SQL for the registry checks."""

from __future__ import annotations

from .sqlparts import NOW_SQL, PATTERN_NAMES, SOURCES_GEN, TARGETS_GEN, registry_targets_sql

EFF = "(t.groupby_pattern | s.pattern_default)"
JOINED = f"FROM {TARGETS_GEN} t JOIN {SOURCES_GEN} s USING (target_table)"

BOUNDS = f"""(
  SELECT *,
    batch_processed + to_minutes(CAST(CASE batch_schedule_type WHEN 'MINUTES' THEN batch_control_size
        WHEN 'HOURLY' THEN 60 ELSE 1440 END AS BIGINT)) AS batch_loop_begin,
    CASE batch_schedule_type
      WHEN 'HOURLY' THEN date_trunc('hour', {NOW_SQL})
      WHEN 'DAILY' THEN date_trunc('day', {NOW_SQL})
      ELSE TIMESTAMP '1970-01-01 00:00:00' + to_minutes(CAST(floor(date_diff('minute',
        TIMESTAMP '1970-01-01 00:00:00', {NOW_SQL}) / batch_control_size) * batch_control_size AS BIGINT))
    END AS batch_loop_end
  FROM {TARGETS_GEN}
)"""
DUE = (f"(SELECT * FROM {BOUNDS} WHERE batch_processing IS NULL "
       "OR date_diff('minute', batch_schedule_last, batch_loop_end) > batch_control_size)")
WATERMARK = (f"(SELECT target_table, min(coalesce(s.data_availabletime, t.batch_processed)) AS np "
             f"{JOINED} WHERE s.source_enabled = true GROUP BY target_table)")

SUPPLIER_TARGETS = registry_targets_sql("(SELECT s_suppkey * 20 AS k, s_name FROM supplier)",
                                        "k", "s_name", prefix="supplier ")

COLUMN_MAP = f"""
WITH m0 AS (
  SELECT target_table, batch_schedule_type AS typ,
    list_transform(groupby_columns, lambda x: split_part(x, ':', 1)) AS k0,
    list_transform(groupby_columns, lambda x: split_part(x, ':', 2)) AS v0
  FROM {TARGETS_GEN}),
m AS (
  SELECT target_table,
    CASE WHEN typ = 'DAILY' THEN list_concat(k0, ['data_pt']) ELSE k0 END AS keys,
    CASE WHEN typ = 'HOURLY' THEN (CASE WHEN len(v0) = 0 THEN v0 ELSE list_slice(v0, 1, len(v0) - 1) END)
         WHEN typ = 'DAILY' THEN list_concat(v0, ['dup']) ELSE v0 END AS vals
  FROM m0),
e AS (SELECT target_table, keys, vals, unnest(range(1, len(keys) + 1)) AS i
      FROM m WHERE len(keys) = len(vals))
SELECT target_table, keys[i] AS map_key, vals[i] AS map_value FROM e
WHERE NOT list_contains(list_slice(keys, i + 1, len(keys)), keys[i])
"""

SQL = {
    "enabled_sources": (f"SELECT target_table, s.source_table, t.batch_control_size, "
                        f"{EFF} AS effective_pattern, (coalesce(t.groupby_flexible, false) OR "
                        f"t.groupby_pattern = {EFF}) AS compatible {JOINED} "
                        "WHERE s.source_enabled = true"),
    "sources_under_test": (f"SELECT target_table, s.source_table, t.batch_control_size, "
                           f"{EFF} AS effective_pattern, (coalesce(t.groupby_flexible, false) OR "
                           f"t.groupby_pattern = {EFF}) AS compatible {JOINED} "
                           "WHERE s.source_enabled <> true"),
    "effective_mask": (f"SELECT target_table, s.source_table, t.groupby_pattern, s.pattern_default, "
                       f"{EFF} AS effective_pattern, CAST(bit_count({EFF}) - "
                       f"bit_count(t.groupby_pattern) AS BIGINT) AS added_bits {JOINED}"),
    "granularity_gate": (f"SELECT target_table, s.source_table, (coalesce(t.groupby_flexible, false) "
                         f"OR t.groupby_pattern = {EFF}) AS accepted, CASE WHEN t.groupby_pattern "
                         f"= {EFF} THEN 'same' WHEN t.groupby_flexible THEN 'flexible' "
                         f"ELSE 'coarser source' END AS reason {JOINED}"),
    "due_targets": (f"SELECT target_table, batch_schedule_type, batch_loop_begin, batch_loop_end "
                    f"FROM {DUE}"),
    "chunk_list": (f"SELECT target_table, unnest(generate_series(batch_loop_begin, batch_loop_end, "
                   f"to_minutes(batch_control_size))) AS chunk_start FROM {DUE} "
                   "WHERE batch_loop_begin <= batch_loop_end"),
    "complete_chunks": (
        "WITH s AS (SELECT target_table, source_enabled, CASE WHEN id % 11 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' + "
        f"to_minutes(CAST(id * 37 % 20000 AS BIGINT)) END AS avail FROM {SOURCES_GEN} WHERE source_enabled), "
        "cap AS (SELECT d.target_table, min(coalesce(s.avail, d.batch_processed)) AS c "
        f"FROM {DUE} d JOIN s USING (target_table) GROUP BY 1), "
        f"held AS (SELECT d.*, least(batch_loop_end, {NOW_SQL} - to_minutes(batch_control_size), "
        f"coalesce(c, batch_processed)) AS e FROM {DUE} d LEFT JOIN cap USING (target_table)) "
        "SELECT target_table, unnest(generate_series(batch_loop_begin, e, to_minutes(batch_control_size))) AS chunk_start "
        "FROM held WHERE batch_loop_begin <= e"),
    "advance_watermark": (f"SELECT t.target_table, coalesce(w.np, t.batch_processed) AS "
                          "batch_processed, CAST(NULL AS TIMESTAMP) AS batch_processing, "
                          "CAST(NULL AS TIMESTAMP) AS batch_microchunk_current "
                          f"FROM {TARGETS_GEN} t LEFT JOIN {WATERMARK} w USING (target_table)"),
    "state_after_run": (
        "SELECT t.target_table, CASE WHEN d.target_table IS NOT NULL AND w.np IS NOT NULL "
        "THEN w.np ELSE t.batch_processed END AS batch_processed, "
        "CASE WHEN d.target_table IS NOT NULL THEN NULL ELSE t.batch_processing END "
        "AS batch_processing, CAST(NULL AS TIMESTAMP) AS batch_microchunk_current, "
        f"CASE WHEN d.target_table IS NOT NULL THEN {NOW_SQL} ELSE t.batch_schedule_last END "
        f"AS batch_schedule_last FROM {TARGETS_GEN} t "
        f"LEFT JOIN (SELECT target_table FROM {DUE}) d ON d.target_table = t.target_table "
        f"LEFT JOIN {WATERMARK} w ON w.target_table = t.target_table"),
    "source_availability": (
        "WITH latest AS (SELECT CAST(l_orderkey AS VARCHAR) AS source_table, max(l_shipdate) "
        "AS latest_ts FROM lineitem GROUP BY 1), "
        "upd AS (SELECT s.target_table, s.source_table, TIMESTAMP '1970-01-01 00:00:00' + "
        "to_minutes(CAST(floor(date_diff('minute', TIMESTAMP '1970-01-01 00:00:00', l.latest_ts) "
        "/ t.batch_control_size) * t.batch_control_size AS BIGINT)) AS avail "
        f"FROM latest l JOIN {SOURCES_GEN} s USING (source_table) "
        f"JOIN {TARGETS_GEN} t ON t.target_table = s.target_table) "
        "SELECT s.target_table, s.source_table, CASE WHEN u.source_table IS NOT NULL THEN "
        "u.avail ELSE s.data_availabletime END AS data_availabletime "
        f"FROM {SOURCES_GEN} s LEFT JOIN upd u ON u.target_table = s.target_table "
        "AND u.source_table = s.source_table"),
    "set_enabled": (
        "SELECT s.target_table, s.source_table, CASE WHEN c.c_mktsegment = 'AUTOMOBILE' AND "
        "s.source_enabled IS NULL THEN true ELSE s.source_enabled END AS source_enabled "
        f"FROM {SOURCES_GEN} s LEFT JOIN customer c ON s.target_table = CAST(c.c_custkey AS VARCHAR)"),
    "registry_upsert": (
        f"WITH cur AS (SELECT * FROM {TARGETS_GEN}), inc AS (SELECT * FROM {SUPPLIER_TARGETS}) "
        "SELECT c.id, c.target_table, CASE WHEN i.target_table IS NOT NULL THEN i.target_label "
        "ELSE c.target_label END AS target_label, CASE WHEN i.target_table IS NOT NULL THEN "
        "i.batch_control_size ELSE c.batch_control_size END AS batch_control_size, "
        "CASE WHEN i.target_table IS NOT NULL THEN i.batch_schedule_type ELSE "
        "c.batch_schedule_type END AS batch_schedule_type, CASE WHEN i.target_table IS NOT NULL "
        "THEN i.groupby_pattern ELSE c.groupby_pattern END AS groupby_pattern, "
        "CASE WHEN i.target_table IS NOT NULL THEN i.groupby_flexible ELSE c.groupby_flexible END "
        "AS groupby_flexible FROM cur c LEFT JOIN inc i ON i.target_table = c.target_table "
        "UNION ALL "
        "SELECT CAST((SELECT max(id) FROM cur) + row_number() OVER (ORDER BY i.target_table) "
        "AS BIGINT), i.target_table, i.target_label, i.batch_control_size, i.batch_schedule_type, "
        "i.groupby_pattern, i.groupby_flexible FROM inc i "
        "WHERE i.target_table NOT IN (SELECT target_table FROM cur)"),
    "registry_sources_upsert": (
        f"WITH cur AS (SELECT * FROM {SOURCES_GEN}), inc AS ("
        "SELECT CAST(o_custkey AS VARCHAR) AS target_table, CAST(o_orderkey AS VARCHAR) AS "
        "source_table, false AS source_enabled, CAST(0 AS BIGINT) AS pattern_default FROM orders "
        "WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT CAST(c_custkey AS VARCHAR), "
        "'nation_' || CAST(c_nationkey AS VARCHAR), CAST(NULL AS BOOLEAN), CAST(16 AS BIGINT) "
        "FROM customer) "
        "SELECT c.id, c.target_table, c.source_table, CASE WHEN i.target_table IS NOT NULL THEN "
        "i.source_enabled ELSE c.source_enabled END AS source_enabled, CASE WHEN i.target_table "
        "IS NOT NULL THEN i.pattern_default ELSE c.pattern_default END AS pattern_default "
        "FROM cur c LEFT JOIN inc i ON i.target_table = c.target_table AND i.source_table = "
        "c.source_table UNION ALL "
        "SELECT CAST((SELECT max(id) FROM cur) + row_number() OVER (ORDER BY i.target_table, "
        "i.source_table) AS BIGINT), i.target_table, i.source_table, i.source_enabled, "
        "i.pattern_default FROM inc i WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE "
        "c.target_table = i.target_table AND c.source_table = i.source_table)"),
    "registry_from_json": ("SELECT CAST(c_custkey AS VARCHAR) AS target_table, "
                           "CAST(c_custkey % 2048 AS BIGINT) AS groupby_pattern, "
                           "CAST(11 - bit_count(CAST(c_custkey % 2048 AS BIGINT)) AS BIGINT) "
                           "AS n_groupby FROM customer"),
    "mapping_split": (
        "SELECT target_table, array_to_string(list_transform(groupby_columns, lambda x: "
        "split_part(x, ':', 1)), ',') AS target_dims, array_to_string(list_transform("
        "groupby_columns, lambda x: split_part(x, ':', 2)), ',') AS source_dims "
        f"FROM {TARGETS_GEN}"),
    "pattern_from_flags": ("SELECT CAST(c_custkey AS VARCHAR) AS target_table, "
                           "CAST(c_custkey % 2048 AS BIGINT) AS pattern FROM customer"),
    "pattern_from_names": ("SELECT CAST(c_custkey AS VARCHAR) AS target_table, "
                           "CAST(c_custkey % 2048 AS BIGINT) AS pattern FROM customer"),
    "mask_columns": (
        "SELECT CAST(c_custkey AS VARCHAR) AS target_table, array_to_string(list_filter("
        f"{PATTERN_NAMES}, lambda x, i: (((c_custkey % 2048) >> (11 - i)) & 1) = 0), ',') "
        "AS kept_columns FROM customer"),
    "column_map": COLUMN_MAP,
}
