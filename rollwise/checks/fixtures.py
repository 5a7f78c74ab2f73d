"""Specs and parameters shared by the check queries (FIXTURES.md §5)."""

from __future__ import annotations

import datetime as dt

from ..functions.pattern import flags_to_mask
from ..sources.unified import PATTERN_COLUMNS, u_events, u_lineitem, u_orders
from ..specs import SourceSpec, TargetSpec

# Fixed values of the demo targets: column lists, flags and aggregate
# templates as the demo registry declares them (lower-cased names).
TARGET_DIMS = ["data_pt:data_pattern", "data_dn:data_name", "data_dt:data_date",
               "data_hr:data_hour", "data_ts:data_time", "data_i1:data_i1",
               "data_i2:data_i2", "data_i3:data_i3", "data_a1:data_a1",
               "data_a2:data_a2", "data_a3:data_a3"]
TARGET_MEASURES = ["vsum_i1:value_i1", "vcnt_i2:value_i2", "vsum_d1:value_d1",
                   "vavg_d2:value_d2"]
FLAGS_1 = [1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0]
FLAGS_2 = [0, 0, 1, 0, 0, 1, 1, 1, 1, 1, 1]
FUNCS_1 = ["SUM(?)", "COUNT(*)", "SUM(?)", "ROUND(AVG(?),2)"]
FUNCS_2 = ["SUM(?)", "COUNT(DISTINCT ?)", "SUM(?)", "ROUND(AVG(?),2)"]

MASK_1 = flags_to_mask(FLAGS_1)      # 7
MASK_2 = flags_to_mask(FLAGS_2)      # 1728
MASK_4 = 4

NOW = dt.datetime(2024, 1, 2, 12, 34, 56)
DAY_EVENTS = dt.datetime(2024, 1, 3)
DAY_TPCH = dt.datetime(1998, 6, 1)
TPCH_FIRST = dt.datetime(1992, 1, 1)      # before any order or ship date
TPCH_LAST = dt.datetime(2001, 12, 31)     # after all of them


def target_1(mask: int = MASK_1, flexible: bool = True, name: str = "target_1") -> TargetSpec:
    """5-minute target: all 11 dims listed, mask keeps 8."""
    return TargetSpec(target_table=name, control_column="data_ts", chunk_minutes=5,
                      schedule_type="MINUTES", pattern_columns=list(PATTERN_COLUMNS),
                      groupby_columns=list(TARGET_DIMS), groupby_pattern=mask,
                      groupby_flexible=flexible, aggregate_columns=list(TARGET_MEASURES),
                      aggregate_functions=list(FUNCS_1), not_null=("data_pt", "data_dt",
                                                                   "data_i1"))


def target_2(name: str = "target_2") -> TargetSpec:
    """Daily target: 7 dims, COUNT(DISTINCT).  Its purge column is the date it
    keeps (the demo's masked ``data_ts`` could never purge, Q4)."""
    dims = [d for d in TARGET_DIMS if d.split(":")[1] in
            ("data_date", "data_i1", "data_i2", "data_i3", "data_a1", "data_a2", "data_a3")]
    return TargetSpec(target_table=name, control_column="data_dt", chunk_minutes=1440,
                      schedule_type="DAILY", pattern_columns=list(PATTERN_COLUMNS),
                      groupby_columns=dims, groupby_pattern=MASK_2, groupby_flexible=True,
                      aggregate_columns=list(TARGET_MEASURES),
                      aggregate_functions=list(FUNCS_2), not_null=("data_dt", "data_i1"),
                      source_dim="data_i1")   # 1 events, 2 orders, 3 lineitem


def src_events(target: str, enabled=True, pattern_default: int = 0, priority: int = 0,
               name: str = "events") -> SourceSpec:
    return SourceSpec(target_table=target, source_table=name, enabled=enabled,
                      pattern_default=pattern_default, transformation=u_events,
                      control_column="data_ts", priority=priority)


def src_orders(target: str, enabled=True, priority: int = 0) -> SourceSpec:
    return SourceSpec(target_table=target, source_table="orders", enabled=enabled,
                      transformation=u_orders, control_column="data_ts",
                      priority=priority)


def src_lineitem(target: str, enabled=True, priority: int = 1) -> SourceSpec:
    return SourceSpec(target_table=target, source_table="lineitem", enabled=enabled,
                      transformation=u_lineitem, control_column="data_ts",
                      priority=priority)


# ---- registry fixtures: one target per customer, one source per order ---------

from pyspark.sql import DataFrame, functions as F  # noqa: E402

from ..functions.pattern import kept_names  # noqa: E402
from ..functions.timegrid import add_minutes, ts_lit  # noqa: E402

TARGET_NAME = {s: t for t, s in (d.split(":") for d in TARGET_DIMS)}
PROCESSING_AT = dt.datetime(2024, 1, 2, 12, 0, 0)
GEN_BASE = dt.datetime(2024, 1, 1)


def _target_of(name):
    expr = F.lit(None).cast("string")
    chain = None
    for s, t in TARGET_NAME.items():
        chain = (F.when(name == s, F.lit(t)) if chain is None
                 else chain.when(name == s, F.lit(t)))
    return chain.otherwise(name) if chain is not None else expr


def registry_targets(df: DataFrame, key: str, label: str, now: dt.datetime = NOW,
                     prefix: str = "customer ") -> DataFrame:
    """Registry rows generated from a table with an integer key column."""
    c = F.col(key)
    names = F.array(*[F.lit(n) for n in PATTERN_COLUMNS])
    mask = (c % 2048).cast("bigint")
    kind = c % 3
    return df.select(
        c.cast("bigint").alias("id"),
        F.concat(F.lit(prefix), F.col(label)).alias("target_label"),
        c.cast("string").alias("target_table"),
        F.lit("data_ts").alias("batch_control_column"),
        F.when(kind == 0, 5).when(kind == 1, 60).otherwise(1440).cast("bigint")
        .alias("batch_control_size"),
        F.lit("DATEADD(MINUTE, :2, :1)").alias("batch_control_next"),
        add_minutes(ts_lit(GEN_BASE), c.cast("int")).alias("batch_processed"),
        F.when(c % 5 == 0, ts_lit(PROCESSING_AT)).alias("batch_processing"),
        F.lit(None).cast("timestamp_ntz").alias("batch_microchunk_current"),
        F.when(kind == 0, "MINUTES").when(kind == 1, "HOURLY").otherwise("DAILY")
        .alias("batch_schedule_type"),
        F.when(c % 10 != 0, add_minutes(ts_lit(now), (-(c % 200)).cast("int")))
        .alias("batch_schedule_last"),
        names.alias("pattern_columns"),
        F.transform(kept_names(names, mask),
                    lambda n: F.concat(_target_of(n), F.lit(":"), n)).alias("groupby_columns"),
        mask.alias("groupby_pattern"),
        (c % 2 == 0).alias("groupby_flexible"),
        F.array(*[F.lit(x) for x in TARGET_MEASURES]).alias("aggregate_columns"),
        F.array(*[F.lit(x) for x in FUNCS_1]).alias("aggregate_functions"),
        F.lit(None).cast("string").alias("default_procedure"),
    )


def targets_gen(customer: DataFrame) -> DataFrame:
    return registry_targets(customer, "c_custkey", "c_name")


def sources_gen(orders: DataFrame) -> DataFrame:
    st = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderkey").cast("bigint").alias("id"),
        F.lit(None).cast("string").alias("source_label"),
        F.col("o_custkey").cast("string").alias("target_table"),
        F.col("o_orderkey").cast("string").alias("source_table"),
        F.when(st == "P", F.lit(True)).when(st == "F", F.lit(False))
        .cast("boolean").alias("source_enabled"),
        (F.col("o_orderkey") % 16).cast("bigint").alias("pattern_default"),
        F.lit(None).cast("boolean").alias("pattern_flexible"),
        F.col("o_orderdate").alias("data_availabletime"),
        F.lit(None).cast("timestamp_ntz").alias("data_checkschedule"),
        F.lit(None).cast("string").alias("transformation"),
    )


# Rate-card terms of the per-row checks, as JSON text.
TIER_JSON = ('[{"RANGE_LOWER":0,"RANGE_UPPER":10000,"REVENUE_SHARE":0.1},'
             '{"RANGE_LOWER":10000,"RANGE_UPPER":50000,"REVENUE_SHARE":0.15},'
             '{"RANGE_LOWER":50000,"RANGE_UPPER":0,"REVENUE_SHARE":0.2}]')
CATEGORY_JSON = '{"F":0.3,"O":0.35,"(OTHERS)":0.05}'
NESTED_A = ('{"a":{"mobile":[0.4],"view":[0]},"b":{"view":[0.3],"click":[0.25],'
            '"signup":["x"]},"c":{"other":[0.1],"signup":[0.6]}}')
NESTED_B = '{"z":{"click":[0.05]},"a":{"click":[0.5],"other":[0.02]}}'
