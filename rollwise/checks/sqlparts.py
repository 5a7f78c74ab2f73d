"""DuckDB SQL fragments for the oracle side of the checks.

The oracle restates each check in plain SQL over the driver's parquet views.
Two spellings differ on purpose: DuckDB's ``avg`` of a decimal is a DOUBLE,
so ``ROUND(AVG(x), 2)`` is restated in integer cents to match Spark's exact
decimal HALF_UP; and money sums are summed in cents and divided once.
"""

from __future__ import annotations


def unified_sql(name: str, table: str, ts: str, i1: int, i2: str, i3: str, a1: str,
                a2: str, a3: str, value_i1: str, value_d1: str, keep: str = "") -> str:
    keep_sel = (keep + ", ") if keep else ""
    return f"""(
  SELECT {keep_sel}CAST((CASE WHEN data_hour IS NULL OR data_hour = 0 THEN 128 ELSE 0 END)
       + (CASE WHEN data_i2 IS NULL OR data_i2 = 0 THEN 16 ELSE 0 END)
       + (CASE WHEN data_i3 IS NULL OR data_i3 = 0 THEN 8 ELSE 0 END)
       + (CASE WHEN data_a1 IS NULL OR data_a1 = '' THEN 4 ELSE 0 END)
       + (CASE WHEN data_a2 IS NULL OR data_a2 = '' THEN 2 ELSE 0 END)
       + (CASE WHEN data_a3 IS NULL OR data_a3 = '' THEN 1 ELSE 0 END) AS BIGINT) AS data_pattern,
    data_name, data_date, data_hour, data_time, data_ts, data_i1, data_i2, data_i3,
    data_a1, data_a2, data_a3, value_i1, value_i1 AS value_i2, value_d1, value_d1 AS value_d2
  FROM (
    SELECT {keep_sel}'{name}' AS data_name, CAST({ts} AS DATE) AS data_date,
      CAST(hour({ts}) AS BIGINT) AS data_hour,
      TIMESTAMP '2000-01-01 00:00:00' + to_minutes(CAST(round(date_diff('minute',
          TIMESTAMP '2000-01-01 00:00:00', {ts}) / 5) * 5 AS BIGINT)) AS data_time,
      {ts} AS data_ts, CAST({i1} AS BIGINT) AS data_i1, CAST({i2} AS BIGINT) AS data_i2,
      CAST({i3} AS BIGINT) AS data_i3, CAST({a1} AS VARCHAR) AS data_a1,
      CAST({a2} AS VARCHAR) AS data_a2, CAST({a3} AS VARCHAR) AS data_a3,
      CAST({value_i1} AS BIGINT) AS value_i1, CAST({value_d1} AS DECIMAL(18,2)) AS value_d1
    FROM {table}
  )
)"""


def u_events_sql(keep: str = "") -> str:
    a2 = "CASE WHEN user_id % 7 = 0 THEN '' ELSE event_type END"
    return unified_sql("events", "events", "ts", 1, "user_id % 16", "nullif(user_id % 16, 0)",
                       "event_type", a2, f"nullif({a2}, '')", "event_id % 51", "value", keep)


def u_orders_sql(keep: str = "") -> str:
    return unified_sql("orders", "orders", "o_orderdate", 2, "o_custkey % 16",
                       "nullif(o_orderkey % 16, 0)", "o_orderpriority", "o_orderstatus",
                       "nullif(o_orderstatus, '')", "o_orderkey % 51", "o_totalprice", keep)


def u_lineitem_sql(keep: str = "") -> str:
    return unified_sql("lineitem", "lineitem", "l_shipdate", 3, "l_partkey % 16",
                       "nullif(l_suppkey % 16, 0)", "l_returnflag", "l_linestatus",
                       "nullif(l_linestatus, '')", "l_quantity", "l_extendedprice", keep)


def cents(col: str) -> str:
    return f"CAST(round({col} * 100) AS BIGINT)"


def money_sum(col: str) -> str:
    """SUM of a decimal(18,2) column as DOUBLE, exact like Spark's decimal sum."""
    return f"CAST(sum({cents(col)}) AS DOUBLE) / 100"


def rounded_avg(col: str) -> str:
    """Spark's ``round(avg(decimal(18,2)), 2)``: the average is kept to 6
    digits HALF_UP, then rounded HALF_UP to 2 (values are non-negative)."""
    s = f"CAST(sum({cents(col)}) AS HUGEINT)"
    c = f"count({col})"
    avg6 = f"(({s} * 20000 + {c}) // (2 * {c}))"
    return (f"CASE WHEN {c} = 0 THEN NULL ELSE "
            f"CAST((2 * {avg6} + 10000) // 20000 AS DOUBLE) / 100 END")


def measures_1(distinct: bool = False) -> str:
    cnt = "count(DISTINCT value_i2)" if distinct else "count(*)"
    return (f"CAST(sum(value_i1) AS BIGINT) AS vsum_i1, CAST({cnt} AS BIGINT) AS vcnt_i2, "
            f"{money_sum('value_d1')} AS vsum_d1, {rounded_avg('value_d2')} AS vavg_d2")


PATTERN_NAMES = ("['data_pattern', 'data_name', 'data_date', 'data_hour', 'data_time', "
                 "'data_i1', 'data_i2', 'data_i3', 'data_a1', 'data_a2', 'data_a3']")
TARGET_OF = ("CASE x WHEN 'data_pattern' THEN 'data_pt' WHEN 'data_name' THEN 'data_dn' "
             "WHEN 'data_date' THEN 'data_dt' WHEN 'data_hour' THEN 'data_hr' "
             "WHEN 'data_time' THEN 'data_ts' ELSE x END")
NOW_SQL = "TIMESTAMP '2024-01-02 12:34:56'"


def registry_targets_sql(table: str, key: str, label: str, prefix: str = "customer ") -> str:
    return f"""(
  SELECT CAST({key} AS BIGINT) AS id, '{prefix}' || {label} AS target_label,
    CAST({key} AS VARCHAR) AS target_table, 'data_ts' AS batch_control_column,
    CAST(CASE {key} % 3 WHEN 0 THEN 5 WHEN 1 THEN 60 ELSE 1440 END AS BIGINT) AS batch_control_size,
    'DATEADD(MINUTE, :2, :1)' AS batch_control_next,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST({key} AS BIGINT)) AS batch_processed,
    CASE WHEN {key} % 5 = 0 THEN TIMESTAMP '2024-01-02 12:00:00' END AS batch_processing,
    CAST(NULL AS TIMESTAMP) AS batch_microchunk_current,
    CASE {key} % 3 WHEN 0 THEN 'MINUTES' WHEN 1 THEN 'HOURLY' ELSE 'DAILY' END AS batch_schedule_type,
    CASE WHEN {key} % 10 <> 0 THEN {NOW_SQL} - to_minutes(CAST({key} % 200 AS BIGINT)) END
      AS batch_schedule_last,
    {PATTERN_NAMES} AS pattern_columns,
    list_transform(list_filter({PATTERN_NAMES}, lambda x, i: ((({key} % 2048) >> (11 - i)) & 1) = 0),
                   lambda x: ({TARGET_OF}) || ':' || x) AS groupby_columns,
    CAST({key} % 2048 AS BIGINT) AS groupby_pattern,
    {key} % 2 = 0 AS groupby_flexible
  FROM {table}
)"""


TARGETS_GEN = registry_targets_sql("customer", "c_custkey", "c_name")

SOURCES_GEN = """(
  SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey AS VARCHAR) AS target_table,
    CAST(o_orderkey AS VARCHAR) AS source_table,
    CASE o_orderstatus WHEN 'P' THEN true WHEN 'F' THEN false END AS source_enabled,
    CAST(o_orderkey % 16 AS BIGINT) AS pattern_default, o_orderdate AS data_availabletime
  FROM orders
)"""


def sum_cents(col: str) -> str:
    return f"CAST(sum({cents(col)}) AS BIGINT)"


def avg_cents(col: str) -> str:
    """``round(avg(x), 2)`` in integer cents (see ``rounded_avg``)."""
    s = f"CAST(sum({cents(col)}) AS HUGEINT)"
    c = f"count({col})"
    avg6 = f"(({s} * 20000 + {c}) // (2 * {c}))"
    return f"CASE WHEN {c} = 0 THEN NULL ELSE CAST((2 * {avg6} + 10000) // 20000 AS BIGINT) END"
