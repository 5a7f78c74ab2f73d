"""Oracle SQL (DuckDB dialect) for each check key, over the driver's views."""

from __future__ import annotations

from .sqlparts import measures_1, u_events_sql, u_lineitem_sql, u_orders_sql

KEYS_1 = ("data_pattern | 7 AS data_pt, data_name AS data_dn, data_date AS data_dt, "
          "data_hour AS data_hr, data_time AS data_ts, data_i1, data_i2, data_i3")
KEYS_2 = ("data_date AS data_dt, data_i1, data_i2, data_i3, nullif(data_a1, '') AS data_a1, "
          "nullif(data_a2, '') AS data_a2, nullif(data_a3, '') AS data_a3")
EVENTS_DAY = "data_ts >= TIMESTAMP '2024-01-03 00:00:00' AND data_ts < TIMESTAMP '2024-01-04 00:00:00'"
TPCH_ALL = "data_date >= DATE '1992-01-01' AND data_date < DATE '2002-01-01'"
TPCH_DAY = "data_ts >= TIMESTAMP '1998-06-01 00:00:00' AND data_ts < TIMESTAMP '1998-06-02 00:00:00'"


def _values_out(prefix: str = "") -> str:
    return (f"{prefix}value_i1, {prefix}value_i2, CAST({prefix}value_d1 AS DOUBLE) AS value_d1, "
            f"CAST({prefix}value_d2 AS DOUBLE) AS value_d2")


def _unified_out(keep: str) -> str:
    return (f"{keep}, data_pattern, data_name, data_date, data_hour, data_time, data_ts, "
            f"data_i1, data_i2, data_i3, data_a1, data_a2, data_a3, " + _values_out())


SQL = {
    "unify_events": f"SELECT {_unified_out('event_id')} FROM {u_events_sql('event_id')}",
    "unify_orders": f"SELECT {_unified_out('o_orderkey')} FROM {u_orders_sql('o_orderkey')}",
    "source_scan": "SELECT * FROM events",
    "chunk_filter": f"SELECT {KEYS_1}, {_values_out()} FROM {u_events_sql()} WHERE {EVENTS_DAY}",
    "chunk_agg_5min": (f"SELECT {KEYS_1}, {measures_1()} FROM {u_events_sql()} "
                       f"WHERE {EVENTS_DAY} GROUP BY ALL"),
    "chunk_agg_daily": (f"SELECT {KEYS_2}, {measures_1(True)} FROM {u_lineitem_sql()} "
                        f"WHERE {TPCH_DAY} GROUP BY ALL"),
    "two_source_daily": (f"SELECT {KEYS_2}, {measures_1(True)} FROM {u_orders_sql()} "
                         f"WHERE {TPCH_ALL} GROUP BY ALL UNION ALL "
                         f"SELECT {KEYS_2}, {measures_1(True)} FROM {u_lineitem_sql()} "
                         f"WHERE {TPCH_ALL} GROUP BY ALL"),
    "test_chunk_agg": (f"SELECT {KEYS_2}, {measures_1(True)} FROM {u_events_sql()} "
                       f"WHERE {EVENTS_DAY} GROUP BY ALL"),
    "preview_chunk": (
        "SELECT 'events' AS source_table, CAST(7 AS BIGINT) AS effective_mask, true AS accepted, "
        "'data_pt,data_dn,data_dt,data_hr,data_ts,data_i1,data_i2,data_i3' AS kept_dims, "
        f"(SELECT count(*) FROM (SELECT {KEYS_1} FROM {u_events_sql()} WHERE {EVENTS_DAY} "
        "GROUP BY ALL)) AS n_groups "
        "UNION ALL SELECT 'events_hourly', CAST(71 AS BIGINT), false, "
        "'data_pt,data_dn,data_dt,data_hr,data_i1,data_i2,data_i3', CAST(0 AS BIGINT)"),
}
