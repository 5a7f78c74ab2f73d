"""Check queries: ranges of chunks, rollups, upsert/purge/replace, patterns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.pattern import row_pattern
from ..operators.aggregate import aggregate_frame, key_exprs, plan_source
from ..operators.rollup import rollup_targets
from ..operators.tables import copy_into, enforce_not_null, target_schema
from ..operators.upsert import purge, upsert
from ..plans.incremental import plan_bounds, range_batch, replace_batch
from ..sources.catalog import inline_values
from ..sources.unified import u_events, u_lineitem
from ..specs import TargetSpec
from . import fixtures as fx
from .queries import catalog, finish


def _events(spark, sf_dir):
    return u_events(catalog(spark, sf_dir).table("events"))


def q_batch_all_chunks(spark, sf_dir):
    """Backfill (I11) then run every due 5-minute chunk of 2024-01-05 ... 15 in
    one job (I3): 3,168 chunks, one scan, one shuffle."""
    t = fx.target_1()
    t.batch_processed = dt.datetime(2024, 1, 4, 23, 55)   # backfill reset
    begin, end = plan_bounds(t, dt.datetime(2024, 1, 15, 23, 59, 59))
    b = range_batch(catalog(spark, sf_dir), t, [fx.src_events(t.target_table)], begin, end)
    return finish(b.frame)


def q_sliding_reaggregate(spark, sf_dir):
    """Sliding range (I10): each run redoes the last 10 days before today
    (2024-01-30) of the daily target; dry run, so the new content is returned."""
    from ..plans.incremental import run_target
    from ..session import fresh_path
    t = fx.target_2(name="sliding_daily")
    r = run_target(catalog(spark, sf_dir), t, [fx.src_events(t.target_table)],
                   dt.datetime(2024, 1, 30, 12, 0), fresh_path(spark, "sliding_daily"),
                   script_only=True, lookback_days=10)
    return finish(r.written)


def q_mixed_granularity(spark, sf_dir):
    """Mask 4 over all events: the row pattern OR mask is a key, so rows whose
    dims are missing form their own groups (G10)."""
    t = fx.target_1(mask=fx.MASK_4)
    df = _events(spark, sf_dir)
    return finish(aggregate_frame(df, t, plan_source(t, fx.src_events(t.target_table))))


def q_multi_target_rollup(spark, sf_dir):
    """Targets with masks 7, 1728 and 4 over one scan of events."""
    targets = [fx.target_1(name="rollup_7"), fx.target_2(name="rollup_1728"),
               fx.target_1(mask=fx.MASK_4, name="rollup_4")]
    df = _events(spark, sf_dir)
    return finish(rollup_targets(df, targets, fx.src_events("rollup")))


def q_mask_projection(spark, sf_dir):
    """The columns mask 1728 keeps, under target names, plus the values."""
    t = fx.target_2()
    df = _events(spark, sf_dir)
    plan = plan_source(t, fx.src_events(t.target_table))
    return finish(df.select(*key_exprs(df, t, plan), *t.measures[1]))


def _target_1_all(spark, sf_dir):
    t = fx.target_1()
    df = _events(spark, sf_dir)
    return t, aggregate_frame(df, t, plan_source(t, fx.src_events(t.target_table)))


def q_target_profile(spark, sf_dir):
    """Rows per time key of the 5-minute target, newest first."""
    _, agg = _target_1_all(spark, sf_dir)
    return agg.groupBy("data_ts").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("data_ts"))


def q_target_not_null_check(spark, sf_dir):
    t, agg = _target_1_all(spark, sf_dir)
    return finish(enforce_not_null(agg, list(t.not_null)))


def q_copy_columns(spark, sf_dir):
    """An older, narrower version of the daily target copied into the current
    schema by column list; columns it lacks become NULL (S7)."""
    df = _events(spark, sf_dir)
    t2 = fx.target_2()
    old_spec = TargetSpec(
        target_table="old_daily", control_column="data_dt", chunk_minutes=1440,
        pattern_columns=t2.pattern_columns,
        groupby_columns=["data_dt:data_date", "data_i1:data_i1", "data_a1:data_a1"],
        groupby_pattern=2047 - 256 - 32 - 4, aggregate_columns=t2.aggregate_columns[:2],
        aggregate_functions=["SUM(?)", "COUNT(*)"])
    old = aggregate_frame(df, old_spec, plan_source(old_spec, fx.src_events("old_daily")))
    return finish(copy_into(old, target_schema(t2, df),
                            ["data_dt", "data_i1", "data_a1", "vsum_i1", "vcnt_i2"]))


def q_inline_values(spark, sf_dir):
    """A VALUES list (positional columns, S3) joined to every event."""
    codes = inline_values(spark, [("click", "C", 1.5), ("view", "V", 0.5),
                                  ("purchase", "P", 3.0), ("signup", "S", 2.0)],
                          ["event_type", "code", "weight"])
    ev = catalog(spark, sf_dir).table("events").select("event_id", "event_type")
    return finish(ev.join(F.broadcast(codes), "event_type", "left"))


def q_incremental_run(spark, sf_dir):
    """Two scheduled runs of the daily target, each writing its due chunks
    into the table (dynamic partition overwrite); returns the table."""
    from ..plans.incremental import run_target
    from ..session import fresh_path
    cat = catalog(spark, sf_dir)
    t = fx.target_2(name="incremental_daily")
    t.batch_processed = dt.datetime(2024, 1, 4)
    src = [fx.src_events(t.target_table)]
    path = fresh_path(spark, "incremental_daily")
    src[0].data_availabletime = dt.datetime(2024, 1, 20)   # source complete up to here
    run_target(cat, t, src, dt.datetime(2024, 1, 20, 9, 0), path)
    assert t.batch_processed == dt.datetime(2024, 1, 20) and t.batch_processing is None
    run_target(cat, t, src, dt.datetime(2024, 1, 31, 9, 0), path)
    return finish(spark.read.parquet(path).drop("control_day"))


def u_events_late(df):
    """Events of which some arrived 19 days before the time they count for:
    the raw time is far off the control time."""
    early = F.col("data_ts") - F.expr("INTERVAL 19 DAYS")
    return u_events(df, keep=["event_id"]).withColumn(
        "data_ts", F.when(F.col("event_id") % 101 == 0, early).otherwise(F.col("data_ts"))).drop("event_id")


def q_preview_range(spark, sf_dir):
    """Dry run of a due range: each daily chunk of January with each source's
    decision and rows; orders are coarser than the target takes (S9)."""
    from ..plans.incremental import preview_range
    t = fx.target_2(name="preview_daily")
    t.groupby_flexible, t.batch_processed = False, dt.datetime(2024, 1, 2)
    sources = [fx.src_events(t.target_table), fx.src_orders(t.target_table), fx.src_lineitem(t.target_table)]
    sources[1].pattern_default = 4
    return preview_range(catalog(spark, sf_dir), t, sources, dt.datetime(2024, 1, 31, 9), complete_only=True)


def q_late_row_range(spark, sf_dir):
    """Daily target over events in 8 files by time, some rows 19 days off
    their raw time: two runs by the zone map, the files of the second half
    arriving between them; returns the table, which must hold every row (P5)."""
    from ..plans.incremental import run_target
    from ..session import fresh_path
    events = catalog(spark, sf_dir).table("events")
    folder, path = fresh_path(spark, "events_files"), fresh_path(spark, "late_daily")
    half = F.col("ts") < F.lit(dt.datetime(2024, 1, 16)).cast("timestamp_ntz")
    t = fx.target_2(name="late_daily")
    src = fx.src_events(t.target_table)
    src.transformation = u_events_late
    for part, now in ((half, dt.datetime(2024, 1, 16, 9)), (~F.coalesce(half, F.lit(False)), dt.datetime(2024, 1, 31, 9))):
        events.where(part).repartitionByRange(4, "ts").write.mode("append").parquet(folder)
        cat = catalog(spark, sf_dir).with_table("events", spark.read.parquet(folder))
        t.batch_processed, t.batch_processing = dt.datetime(2024, 1, 4), None
        run_target(cat, t, [src], now, path)
    return finish(spark.read.parquet(path).drop("control_day"))


def q_rerun_after_source_delete(spark, sf_dir):
    """The daily target built twice over the same chunks; before the second run
    every row of one day left the source.  Returns the table, which must not
    hold that day any more (M5)."""
    from ..plans.incremental import run_target
    from ..session import fresh_path
    from ..sources.unified import u_events
    cat, path = catalog(spark, sf_dir), fresh_path(spark, "rerun_daily")
    for deleted in (False, True):
        t = fx.target_2(name="rerun_daily")
        t.batch_processed = dt.datetime(2024, 1, 4)
        src = fx.src_events(t.target_table)
        if deleted:
            src.transformation = lambda df: u_events(df).where(
                F.col("data_date") != F.lit(dt.date(2024, 1, 6)))
        run_target(cat, t, [src], dt.datetime(2024, 1, 31, 9, 0), path)
    return finish(spark.read.parquet(path).drop("control_day"))


def q_demo_workflow(spark, sf_dir):
    """The demo flow on a persisted registry: register a daily target from JSON
    text, test a new source on 2024-01-03, park it, enable it, run every due
    chunk up to 2024-01-10; returns the target table."""
    import json
    from ..plans.workflow import Registry
    from ..session import fresh_path
    from ..sources.unified import PATTERN_COLUMNS, U_EVENTS_SQL
    t2 = fx.target_2()
    reg = Registry(spark, fresh_path(spark, "registry"))
    spec = spark.createDataFrame([(
        "demo: daily target", "daily", "data_dt", 1440, "DATEADD(MINUTE, :2, :1)", "DAILY",
        json.dumps(PATTERN_COLUMNS), json.dumps(t2.groupby_columns), json.dumps(fx.FLAGS_2),
        True, json.dumps(t2.aggregate_columns), json.dumps(t2.aggregate_functions))],
        "target_label string, target_table string, batch_control_column string, "
        "batch_control_size bigint, batch_control_next string, batch_schedule_type string, "
        "pattern_columns string, groupby_columns string, groupby_flags string, "
        "groupby_flexible boolean, aggregate_columns string, aggregate_functions string")
    reg.register_targets(spec.withColumn("batch_processed", F.lit(dt.datetime(2024, 1, 4))
                                         .cast("timestamp_ntz")))
    src = spark.createDataFrame([("daily", "events", False, 0, U_EVENTS_SQL, "data_ts")],
                                "target_table string, source_table string, "
                                "source_enabled boolean, pattern_default bigint, "
                                "transformation string, control_column string")
    reg.register_sources(src.withColumn("data_availabletime", F.lit(None)
                                        .cast("timestamp_ntz")))
    cat = catalog(spark, sf_dir)
    reg.refresh_availability(cat, "daily")   # newest data, floored to the day grid
    path = fresh_path(spark, "demo_daily")
    reg.aggregate_chunk(cat, "daily", dt.datetime(2024, 1, 3), path, mode="test")
    reg.set_enabled("daily", ["events"], None)
    reg.set_enabled("daily", ["events"], True)
    reg.aggregate_due(cat, "daily", dt.datetime(2024, 1, 10, 8, 0), path)
    return finish(spark.read.parquet(path).drop("control_day"))


# ---- upsert family: target = days 1-10 (+1 on every measure), batch = days 8-12

DAY_TYPE_MASK = 2047 - 256 - 4   # keeps data_date and data_a1


def _day_type():
    t = fx.target_1(mask=DAY_TYPE_MASK, name="day_type")
    t.control_column, t.chunk_minutes, t.schedule_type = "data_dt", 1440, "DAILY"
    return t


def _target_and_batch(spark, sf_dir):
    t = _day_type()
    cat = catalog(spark, sf_dir)
    src = [fx.src_events(t.target_table)]
    old = range_batch(cat, t, src, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 10)).frame
    old = old.select("data_dt", "data_a1", *[(F.col(m) + 1).alias(m) for m in t.measures[0]])
    batch = range_batch(cat, t, src, dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 12))
    return t, old, batch


def q_merge_upsert(spark, sf_dir):
    t, old, batch = _target_and_batch(spark, sf_dir)
    return finish(upsert(old, batch.frame, batch.keys, t.measures[0]))


def q_purge_range(spark, sf_dir):
    _, old, _ = _target_and_batch(spark, sf_dir)
    return finish(purge(old, "data_dt", dt.datetime(2024, 1, 8), 5 * 1440))


def q_replace_chunk(spark, sf_dir):
    t, old, batch = _target_and_batch(spark, sf_dir)
    return finish(replace_batch(old, t, batch, dt.datetime(2024, 1, 8),
                                dt.datetime(2024, 1, 13)))


def q_coarse_upsert(spark, sf_dir):
    """A batch coarser than the target: every lineitem row is a target row,
    the batch has one row per return flag (each a third of the table or
    more) and overwrites the measures of all rows of its flag; flag A is
    not in the batch, flag Z not in the target (M1, J2 as 1:N)."""
    li = catalog(spark, sf_dir).table("lineitem")
    target = li.select("l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("R")).alias("flag"),
                       "l_linestatus", F.col("l_quantity").cast("bigint").alias("qty"),
                       F.lit(1).cast("bigint").alias("n"))
    flag = F.col("l_returnflag")
    batch = (li.groupBy(F.when(flag == "A", "Z").when(flag == "R", "").otherwise(flag).alias("flag"))
             .agg(F.nullif(F.sum(F.col("l_quantity").cast("bigint")), F.lit(0)).alias("qty"), F.count("*").alias("n")))
    return upsert(target, batch, ["flag"], ["qty", "n"])


# ---- row patterns ----------------------------------------------------------------

def q_pattern_rows(spark, sf_dir):
    """Row pattern of every lineitem row over the 11 unified values."""
    li = catalog(spark, sf_dir).table("lineitem")
    return u_lineitem(li, keep=["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "data_pattern")


def q_pattern_profile(spark, sf_dir):
    """Rows per pattern over (event_type, hour, user_id): hour 0 and user 0
    count as absent under the falsy rule (Q8)."""
    ev = catalog(spark, sf_dir).table("events").select(
        "event_type", F.hour("ts").alias("hour"), "user_id")
    p = row_pattern(ev, ["event_type", "hour", "user_id"])
    return ev.groupBy(p.alias("data_pattern")).agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES = {
    "batch_all_chunks": q_batch_all_chunks,
    "sliding_reaggregate": q_sliding_reaggregate,
    "incremental_run": q_incremental_run,
    "late_row_range": q_late_row_range,
    "preview_range": q_preview_range,
    "rerun_after_source_delete": q_rerun_after_source_delete,
    "demo_workflow": q_demo_workflow,
    "mixed_granularity": q_mixed_granularity,
    "multi_target_rollup": q_multi_target_rollup,
    "mask_projection": q_mask_projection,
    "target_profile": q_target_profile,
    "target_not_null_check": q_target_not_null_check,
    "copy_columns": q_copy_columns,
    "inline_values": q_inline_values,
    "merge_upsert": q_merge_upsert,
    "coarse_upsert": q_coarse_upsert,
    "purge_range": q_purge_range,
    "replace_chunk": q_replace_chunk,
    "pattern_rows": q_pattern_rows,
    "pattern_profile": q_pattern_profile,
}
