"""Oracle SQL for ranges, rollups, the upsert family and patterns."""

from __future__ import annotations

from .oracle import KEYS_1, KEYS_2
from .sqlparts import avg_cents, measures_1, sum_cents, u_events_sql, u_lineitem_sql

U = u_events_sql()
KEYS_4 = ("data_pattern | 4 AS data_pt, data_name AS data_dn, data_date AS data_dt, "
          "data_hour AS data_hr, data_time AS data_ts, data_i1, data_i2, data_i3, "
          "nullif(data_a2, '') AS data_a2, nullif(data_a3, '') AS data_a3")
NUL_S, NUL_I, NUL_T = "CAST(NULL AS VARCHAR)", "CAST(NULL AS BIGINT)", "CAST(NULL AS TIMESTAMP)"

ROLLUP = f"""
SELECT 'rollup_7' AS target_table, {KEYS_1}, {NUL_S} AS data_a1, {NUL_S} AS data_a2,
  {NUL_S} AS data_a3, {measures_1()} FROM {U} GROUP BY ALL
UNION ALL
SELECT 'rollup_1728', {NUL_I}, {NUL_S}, data_date, {NUL_I}, {NUL_T}, data_i1, data_i2, data_i3,
  nullif(data_a1, ''), nullif(data_a2, ''), nullif(data_a3, ''), {measures_1(True)}
FROM {U} GROUP BY ALL
UNION ALL
SELECT 'rollup_4', data_pattern | 4, data_name, data_date, data_hour, data_time, data_i1, data_i2,
  data_i3, {NUL_S}, nullif(data_a2, ''), nullif(data_a3, ''), {measures_1()} FROM {U} GROUP BY ALL
"""

UPSERT_BASE = f"""
WITH agg AS (
  SELECT data_date AS data_dt, nullif(data_a1, '') AS data_a1, CAST(sum(value_i1) AS BIGINT) AS s1,
    count(*) AS c2, {sum_cents('value_d1')} AS s3, {avg_cents('value_d2')} AS a4
  FROM {U} GROUP BY 1, 2),
tgt AS (SELECT data_dt, data_a1, s1 + 1 AS s1, c2 + 1 AS c2, s3 + 100 AS s3, a4 + 100 AS a4
        FROM agg WHERE data_dt >= DATE '2024-01-01' AND data_dt < DATE '2024-01-11'),
bat AS (SELECT * FROM agg WHERE data_dt >= DATE '2024-01-08' AND data_dt < DATE '2024-01-13'),
kept AS (SELECT * FROM tgt WHERE NOT (data_dt >= DATE '2024-01-08' AND data_dt < DATE '2024-01-13'))
"""


def _merge(left: str) -> str:
    return (f"SELECT CASE WHEN t.data_dt IS NOT NULL THEN t.data_dt ELSE b.data_dt END AS data_dt, "
            "CASE WHEN t.data_dt IS NOT NULL THEN t.data_a1 ELSE b.data_a1 END AS data_a1, "
            "CASE WHEN b.data_dt IS NOT NULL THEN b.s1 ELSE t.s1 END AS vsum_i1, "
            "CASE WHEN b.data_dt IS NOT NULL THEN b.c2 ELSE t.c2 END AS vcnt_i2, "
            "CAST(CASE WHEN b.data_dt IS NOT NULL THEN b.s3 ELSE t.s3 END AS DOUBLE) / 100 AS vsum_d1, "
            "CAST(CASE WHEN b.data_dt IS NOT NULL THEN b.a4 ELSE t.a4 END AS DOUBLE) / 100 AS vavg_d2 "
            f"FROM {left} t FULL OUTER JOIN bat b ON t.data_dt = b.data_dt "
            "AND coalesce(t.data_a1, '') = coalesce(b.data_a1, '')")


SQL = {
    "batch_all_chunks": (f"SELECT {KEYS_1}, {measures_1()} FROM {U} WHERE data_time >= "
                         "TIMESTAMP '2024-01-05 00:00:00' AND data_time < "
                         "TIMESTAMP '2024-01-16 00:00:00' GROUP BY ALL"),
    "sliding_reaggregate": (f"SELECT {KEYS_2}, {measures_1(True)} FROM {U} WHERE data_date >= "
                            "DATE '2024-01-20' AND data_date < DATE '2024-01-31' GROUP BY ALL"),
    "incremental_run": (f"SELECT {KEYS_2}, {measures_1(True)} FROM {U} WHERE data_date >= "
                        "DATE '2024-01-05' AND data_date < DATE '2024-02-01' GROUP BY ALL"),
    "preview_range": (
        "SELECT 'preview_daily' AS target_table, d.c AS chunk_start, s.source_table, CAST(s.mask AS BIGINT) AS effective_mask, "
        "s.accepted, CASE WHEN s.source_table = 'events' THEN (SELECT count(*) FROM events WHERE CAST(ts AS DATE) = CAST(d.c AS DATE)) "
        "WHEN s.source_table = 'lineitem' THEN (SELECT count(*) FROM lineitem WHERE CAST(l_shipdate AS DATE) = CAST(d.c AS DATE)) "
        "ELSE 0 END AS n_rows FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-30', to_days(1))) AS c) d, "
        "(VALUES ('events', 1728, true), ('orders', 1732, false), ('lineitem', 1728, true)) AS s(source_table, mask, accepted)"),
    "late_row_range": (f"SELECT {KEYS_2}, {measures_1(True)} FROM {U} WHERE data_date >= "
                       "DATE '2024-01-05' AND data_date < DATE '2024-02-01' GROUP BY ALL"),
    "rerun_after_source_delete": (f"SELECT {KEYS_2}, {measures_1(True)} FROM {U} WHERE data_date >= "
                                  "DATE '2024-01-05' AND data_date < DATE '2024-02-01' "
                                  "AND data_date <> DATE '2024-01-06' GROUP BY ALL"),
    "demo_workflow": (f"SELECT {KEYS_2}, {measures_1(True)} FROM {U} WHERE data_ts >= "
                      "TIMESTAMP '2024-01-03 00:00:00' AND data_ts < TIMESTAMP '2024-01-04 00:00:00' "
                      "GROUP BY ALL UNION ALL "
                      f"SELECT {KEYS_2}, {measures_1(True)} FROM {U} WHERE data_date >= "
                      "DATE '2024-01-05' AND data_date < DATE '2024-01-11' GROUP BY ALL"),
    "mixed_granularity": f"SELECT {KEYS_4}, {measures_1()} FROM {U} GROUP BY ALL",
    "multi_target_rollup": ROLLUP,
    "mask_projection": (f"SELECT {KEYS_2}, value_i1, value_i2, CAST(value_d1 AS DOUBLE) AS value_d1, "
                        f"CAST(value_d2 AS DOUBLE) AS value_d2 FROM {U}"),
    "target_profile": (f"SELECT data_ts, count(*) AS cnt FROM (SELECT {KEYS_1}, {measures_1()} "
                       f"FROM {U} GROUP BY ALL) GROUP BY 1"),
    "target_not_null_check": f"SELECT {KEYS_1}, {measures_1()} FROM {U} GROUP BY ALL",
    "copy_columns": (f"SELECT data_date AS data_dt, data_i1, {NUL_I} AS data_i2, {NUL_I} AS data_i3, "
                     f"nullif(data_a1, '') AS data_a1, {NUL_S} AS data_a2, {NUL_S} AS data_a3, "
                     "CAST(sum(value_i1) AS BIGINT) AS vsum_i1, count(*) AS vcnt_i2, "
                     "CAST(NULL AS DOUBLE) AS vsum_d1, CAST(NULL AS DOUBLE) AS vavg_d2 "
                     f"FROM {U} GROUP BY data_date, data_i1, nullif(data_a1, '')"),
    "inline_values": ("SELECT e.event_id, e.event_type, v.code, CAST(v.weight AS DOUBLE) AS weight "
                      "FROM events e LEFT JOIN (VALUES ('click', 'C', 1.5), ('view', 'V', 0.5), "
                      "('purchase', 'P', 3.0), ('signup', 'S', 2.0)) AS v(event_type, code, weight) "
                      "ON v.event_type = e.event_type"),
    "merge_upsert": UPSERT_BASE + _merge("tgt"),
    "coarse_upsert": (
        "WITH b AS (SELECT CASE l_returnflag WHEN 'A' THEN 'Z' WHEN 'R' THEN '' ELSE l_returnflag END AS flag, "
        "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, count(*) AS n FROM lineitem GROUP BY 1) "
        "SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'R') AS flag, l_linestatus, "
        "CASE WHEN b.n IS NULL THEN CAST(l_quantity AS BIGINT) ELSE b.qty END AS qty, coalesce(b.n, 1) AS n "
        "FROM lineitem LEFT JOIN b ON b.flag = coalesce(nullif(l_returnflag, 'R'), '') "
        "UNION ALL SELECT NULL, NULL, flag, NULL, qty, n FROM b WHERE flag = 'Z'"),
    "purge_range": (UPSERT_BASE + "SELECT data_dt, data_a1, s1 AS vsum_i1, c2 AS vcnt_i2, "
                    "CAST(s3 AS DOUBLE) / 100 AS vsum_d1, CAST(a4 AS DOUBLE) / 100 AS vavg_d2 "
                    "FROM kept"),
    "replace_chunk": UPSERT_BASE + _merge("kept"),
    "pattern_rows": ("SELECT l_orderkey, l_linenumber, data_pattern FROM "
                     f"{u_lineitem_sql('l_orderkey, l_linenumber')}"),
    "pattern_profile": ("SELECT CAST((CASE WHEN event_type IS NULL OR event_type = '' THEN 4 ELSE 0 END) "
                        "+ (CASE WHEN hour(ts) IS NULL OR hour(ts) = 0 THEN 2 ELSE 0 END) "
                        "+ (CASE WHEN user_id IS NULL OR user_id = 0 THEN 1 ELSE 0 END) AS BIGINT) "
                        "AS data_pattern, count(*) AS n_rows FROM events GROUP BY 1"),
}
