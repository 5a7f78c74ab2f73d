"""Transformations of the test tables into the unified source columns.

Every unified view has the same columns: pattern, source name, date, hour,
5-minute time, the raw control time, three integer dims, three text dims and
the values (``value_i2``/``value_d2`` duplicate ``value_i1``/``value_d1`` so one
input can feed two aggregates).  Money is cast to ``decimal(18,2)`` so sums
are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.pattern import row_pattern
from ..functions.timegrid import round_minutes

# The unified columns in pattern (bit) order, then the values.
PATTERN_COLUMNS = ["data_pattern", "data_name", "data_date", "data_hour", "data_time",
                   "data_i1", "data_i2", "data_i3", "data_a1", "data_a2", "data_a3"]
VALUE_COLUMNS = ["value_i1", "value_i2", "value_d1", "value_d2"]
UNIFIED_COLUMNS = PATTERN_COLUMNS[:5] + ["data_ts"] + PATTERN_COLUMNS[5:] + VALUE_COLUMNS

MONEY = T.DecimalType(18, 2)


def unify(df: DataFrame, name: str, ts: Column, i1: int, i2: Column, i3: Column,
          a1: Column, a2: Column, a3: Column, value_i1: Column, value_d1: Column,
          keep: list[str] | None = None) -> DataFrame:
    """Reshape one table into the unified columns."""
    keep = list(keep or [])
    base = df.select(
        *[F.col(k) for k in keep],
        F.lit(name).cast("string").alias("data_name"),
        F.to_date(ts).alias("data_date"),
        F.hour(ts).cast("bigint").alias("data_hour"),
        round_minutes(ts, 5).alias("data_time"),
        ts.alias("data_ts"),
        F.lit(i1).cast("bigint").alias("data_i1"),
        i2.cast("bigint").alias("data_i2"),
        i3.cast("bigint").alias("data_i3"),
        a1.cast("string").alias("data_a1"),
        a2.cast("string").alias("data_a2"),
        a3.cast("string").alias("data_a3"),
        value_i1.cast("bigint").alias("value_i1"),
        value_d1.cast(MONEY).alias("value_d1"),
    )
    # Row pattern over the demo's 11 values: constant 1, name, date, hour,
    # raw time, then the six dims.
    pattern = row_pattern(base, [(F.lit(1), T.IntegerType()), "data_name", "data_date",
                                 "data_hour", "data_ts", "data_i1", "data_i2", "data_i3",
                                 "data_a1", "data_a2", "data_a3"])
    return base.select(
        *[F.col(k) for k in keep],
        pattern.alias("data_pattern"),
        "data_name", "data_date", "data_hour", "data_time", "data_ts",
        "data_i1", "data_i2", "data_i3", "data_a1", "data_a2", "data_a3",
        "value_i1", F.col("value_i1").alias("value_i2"),
        "value_d1", F.col("value_d1").alias("value_d2"),
    )


def u_events(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    uid = F.col("user_id")
    a2 = F.when(uid % 7 == 0, F.lit("")).otherwise(F.col("event_type"))
    return unify(df, "events", F.col("ts"), 1, uid % 16, F.nullif(uid % 16, F.lit(0)),
                 F.col("event_type"), a2, F.nullif(a2, F.lit("")),
                 F.col("event_id") % 51, F.col("value"), keep)


def u_orders(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    a2 = F.col("o_orderstatus")
    return unify(df, "orders", F.col("o_orderdate"), 2, F.col("o_custkey") % 16,
                 F.nullif(F.col("o_orderkey") % 16, F.lit(0)), F.col("o_orderpriority"),
                 a2, F.nullif(a2, F.lit("")), F.col("o_orderkey") % 51,
                 F.col("o_totalprice"), keep)


def u_lineitem(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    a2 = F.col("l_linestatus")
    return unify(df, "lineitem", F.col("l_shipdate"), 3, F.col("l_partkey") % 16,
                 F.nullif(F.col("l_suppkey") % 16, F.lit(0)), F.col("l_returnflag"),
                 a2, F.nullif(a2, F.lit("")), F.col("l_quantity"),
                 F.col("l_extendedprice"), keep)


# The same unified view for ``events`` as SQL text (a transformation source
# in text form, as a registry row would store it).
U_EVENTS_SQL = """
SELECT data_pattern, data_name, data_date, data_hour, data_time, data_ts,
       data_i1, data_i2, data_i3, data_a1, data_a2, data_a3,
       value_i1, value_i1 AS value_i2, value_d1, value_d1 AS value_d2
FROM (
  SELECT *,
    CAST((CASE WHEN data_hour IS NULL OR data_hour = 0 THEN 128 ELSE 0 END)
       + (CASE WHEN data_i2 IS NULL OR data_i2 = 0 THEN 16 ELSE 0 END)
       + (CASE WHEN data_i3 IS NULL OR data_i3 = 0 THEN 8 ELSE 0 END)
       + (CASE WHEN data_a1 IS NULL OR data_a1 = '' THEN 4 ELSE 0 END)
       + (CASE WHEN data_a2 IS NULL OR data_a2 = '' THEN 2 ELSE 0 END)
       + (CASE WHEN data_a3 IS NULL OR data_a3 = '' THEN 1 ELSE 0 END) AS BIGINT) AS data_pattern
  FROM (
    SELECT 'events' AS data_name, to_date(ts) AS data_date,
           CAST(hour(ts) AS BIGINT) AS data_hour,
           timestampadd(MINUTE, CAST(round(timestampdiff(MINUTE, TIMESTAMP_NTZ'2000-01-01 00:00:00',
                 CAST(date_trunc('MINUTE', ts) AS TIMESTAMP_NTZ)) / 5) * 5 AS INT),
                 TIMESTAMP_NTZ'2000-01-01 00:00:00') AS data_time,
           ts AS data_ts, CAST(1 AS BIGINT) AS data_i1,
           user_id % 16 AS data_i2, nullif(user_id % 16, 0) AS data_i3,
           event_type AS data_a1,
           CASE WHEN user_id % 7 = 0 THEN '' ELSE event_type END AS data_a2,
           nullif(CASE WHEN user_id % 7 = 0 THEN '' ELSE event_type END, '') AS data_a3,
           event_id % 51 AS value_i1, CAST(value AS DECIMAL(18,2)) AS value_d1
    FROM events
  )
)
"""
