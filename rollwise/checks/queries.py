"""Check queries: one DataFrame per SURVEY §2 key, over the driver's tables.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names match the oracle SQL of the same key.  Decimal outputs are cast
to double at the very end so both engines print the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.aggregate import in_chunk, key_exprs, plan_source
from ..plans.incremental import chunk_batch, preview, range_batch
from ..session import apply_defaults
from ..sources.catalog import Catalog, resolve_source
from ..sources.unified import u_events, u_orders
from ..specs import SourceSpec
from . import fixtures as fx


def finish(df: DataFrame) -> DataFrame:
    """Cast decimals to double for engine-neutral output."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    apply_defaults(spark)
    return Catalog(spark, sf_dir)


# ---- sources -------------------------------------------------------------------

def q_unify_events(spark, sf_dir):
    return finish(u_events(catalog(spark, sf_dir).table("events"), keep=["event_id"]))


def q_unify_orders(spark, sf_dir):
    return finish(u_orders(catalog(spark, sf_dir).table("orders"), keep=["o_orderkey"]))


def q_source_scan(spark, sf_dir):
    """Plain-table source (S1): no transformation, the whole table is scanned
    by name (the chunk predicate is ``chunk_filter``'s check)."""
    cat = catalog(spark, sf_dir)
    src = SourceSpec(target_table="raw_events", source_table="events", control_column="ts")
    return resolve_source(cat, src)


def q_chunk_filter(spark, sf_dir):
    """Chunk predicate from a step expression, then the pruned select list
    (kept dims + aggregated columns) the grouping reads."""
    cat = catalog(spark, sf_dir)
    target = fx.target_1()
    target.step = "dateadd(HOUR, :2 div 60, :1)"
    src = fx.src_events(target.target_table)
    plan = plan_source(target, src)
    df = resolve_source(cat, src)
    df = df.where(in_chunk(F.col("data_ts"), fx.DAY_EVENTS, 1440, target.step, spark))
    keys = key_exprs(df, target, plan)
    return finish(df.select(*keys, *target.measures[1]))


# ---- chunk aggregation -----------------------------------------------------------

def q_chunk_agg_5min(spark, sf_dir):
    t = fx.target_1()
    b = chunk_batch(catalog(spark, sf_dir), t, [fx.src_events(t.target_table)],
                    fx.DAY_EVENTS, minutes=1440)
    return finish(b.frame)


def q_chunk_agg_daily(spark, sf_dir):
    t = fx.target_2()
    b = chunk_batch(catalog(spark, sf_dir), t, [fx.src_lineitem(t.target_table)], fx.DAY_TPCH)
    return finish(b.frame)


def q_two_source_daily(spark, sf_dir):
    """Two sources into one daily target over their whole date range."""
    t = fx.target_2()
    b = range_batch(catalog(spark, sf_dir), t,
                    [fx.src_orders(t.target_table), fx.src_lineitem(t.target_table)],
                    fx.TPCH_FIRST, fx.TPCH_LAST)
    return finish(b.frame)


def q_test_chunk_agg(spark, sf_dir):
    """Run one chunk for the sources under test only (I2): events is under
    test (False), lineitem live (True), orders parked (NULL)."""
    t = fx.target_2()
    srcs = [fx.src_events(t.target_table, enabled=False), fx.src_lineitem(t.target_table),
            fx.src_orders(t.target_table, enabled=None)]
    return finish(chunk_batch(catalog(spark, sf_dir), t, srcs, fx.DAY_EVENTS, mode="test").frame)


def q_preview_chunk(spark, sf_dir):
    """Dry run: nothing is written; one report row per source."""
    t = fx.target_1(flexible=False)
    hourly = fx.src_events(t.target_table, pattern_default=64, name="events_hourly")
    hourly.transformation = lambda df: u_events(df)
    cat = catalog(spark, sf_dir)
    cat = cat.with_table("events_hourly", cat.table("events"))
    b = chunk_batch(cat, t, [fx.src_events(t.target_table), hourly], fx.DAY_EVENTS,
                    minutes=1440)
    return preview(b, spark)


QUERIES = {
    "unify_events": q_unify_events,
    "unify_orders": q_unify_orders,
    "source_scan": q_source_scan,
    "chunk_filter": q_chunk_filter,
    "chunk_agg_5min": q_chunk_agg_5min,
    "chunk_agg_daily": q_chunk_agg_daily,
    "two_source_daily": q_two_source_daily,
    "test_chunk_agg": q_test_chunk_agg,
    "preview_chunk": q_preview_chunk,
}
