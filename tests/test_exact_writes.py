"""Writes that must lose nothing: emptied days, empty first runs, masked control
columns, long steps, chunks over midnight, arriving files, racing writers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollwise.checks import fixtures as fx
from rollwise.operators.aggregate import aggregate_frame, plan_source
from rollwise.operators.upsert import upsert
from rollwise.plans.incremental import run_target
from rollwise.plans.workflow import Registry
from rollwise.session import fresh_path
from rollwise.sources.catalog import Catalog
from rollwise.sources.unified import U_EVENTS_SQL, u_events
from rollwise.specs import SourceSpec, TargetSpec
from rollwise.streaming.continuous import run_stream

SF = "/root/testdata/sf0.001"


def ts(*a):
    return F.lit(dt.datetime(*a)).cast("timestamp_ntz")


def daily(name, hour=0):
    t = fx.target_2(name=name)
    t.batch_processed, t.batch_processing = dt.datetime(2024, 1, 4, hour), None
    return t


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_day_that_lost_its_rows_is_removed(spark):
    cat, path = Catalog(spark, SF), fresh_path(spark, "emptied")
    src, now = fx.src_events("e"), dt.datetime(2024, 1, 8, 12)
    run_target(cat, daily("e"), [src], now, path)
    left = cat.table("events").where(F.to_date("ts") != F.lit(dt.date(2024, 1, 6)))
    run_target(cat.with_table("events", left), daily("e"), [src], now, path)
    got = spark.read.parquet(path)
    days = {r[0] for r in got.select("control_day").distinct().collect()}
    assert dt.date(2024, 1, 6) not in days and {dt.date(2024, 1, d) for d in (5, 7, 8)} <= days


def test_run_starting_at_nine_keeps_late_rows(spark):
    cat, path = Catalog(spark, SF), fresh_path(spark, "nine")
    fx_src = fx.src_events("n")
    run_target(cat, daily("n", 9), [fx_src], dt.datetime(2024, 1, 10, 12), path)
    t = daily("n")
    want = aggregate_frame(u_events(cat.table("events")), t, plan_source(t, fx_src))
    got = spark.read.parquet(path).drop("control_day")
    ctl = t.control_column
    days = {r[0] for r in got.select(ctl).distinct().collect()}
    assert days
    same(got.select(*want.columns), want.where(F.col(ctl).isin(list(days))))


def test_empty_first_run(spark):
    cat, path = Catalog(spark, SF), fresh_path(spark, "first")
    none = cat.with_table("events", cat.table("events").where("false"))
    now = dt.datetime(2024, 1, 6)
    run_target(none, daily("f"), [fx.src_events("f")], now, path)
    run_target(cat, daily("f", 9), [fx.src_events("f")], now, path)
    assert spark.read.parquet(path).count() > 0


def test_source_that_masks_the_control_column_is_refused(spark):
    t = fx.target_1()
    t.groupby_flexible, t.batch_processed, t.batch_processing = True, dt.datetime(2024, 1, 5), None
    src = fx.src_events(t.target_table)
    src.pattern_default = 64
    with pytest.raises(ValueError, match="masks out the control column"):
        run_target(Catalog(spark, SF), t, [src], dt.datetime(2024, 1, 6), fresh_path(spark, "masked"))


def registered(spark, name, **changes):
    reg = Registry(spark, fresh_path(spark, f"registry-{name}"))
    t = daily(name)
    for k, v in changes.items():
        setattr(t, k, v)
    reg.register_specs([t], [SourceSpec(name, "events", True, transformation=U_EVENTS_SQL)])
    return reg, t


def test_chunk_with_a_seven_day_step_keeps_other_rows(spark):
    cat, path = Catalog(spark, SF), fresh_path(spark, "seven")
    reg, t = registered(spark, "w", step="timestampadd(MINUTE, 7 * :2, :1)")
    reg.aggregate_chunk(cat, "w", dt.datetime(2024, 1, 8), path)
    before = spark.read.parquet(path).drop("control_day").checkpoint()
    half = cat.with_table("events", cat.table("events").where("event_id % 2 = 0"))
    reg.aggregate_chunk(half, "w", dt.datetime(2024, 1, 8), path)
    keys = [k for k in t.dims[0] if k in before.columns]
    after = spark.read.parquet(path)
    assert before.select(*keys).exceptAll(after.select(*keys)).count() == 0


def test_chunk_over_midnight_and_files_that_arrive(spark):
    events = Catalog(spark, SF).table("events")
    inbox = fresh_path(spark, "arriving")
    t = fx.target_2(name="m")
    t.chunk_minutes = 1000
    src = fx.src_events("m")
    path, ckpt = fresh_path(spark, "m_target"), fresh_path(spark, "m_ckpt")
    cuts = [(ts(2024, 1, 1), ts(2024, 1, 9)), (ts(2024, 1, 9), ts(2024, 2, 9))]
    for i, (lo, hi) in enumerate(cuts):
        part = events.where((F.col("ts") >= lo) & (F.col("ts") < hi))
        late = events.where(F.to_date("ts") == F.lit(dt.date(2024, 1, 3)))
        keep = part.subtract(late) if i == 0 else part.union(late)
        keep.coalesce(1).write.parquet(f"{inbox}/p{i}")
        run_stream(spark, inbox + "/*/*.parquet", events.schema, t, src, None, path, ckpt).awaitTermination()
    want = aggregate_frame(u_events(events.where(F.col("ts") < ts(2024, 2, 9))), t, plan_source(t, src))
    same(spark.read.parquet(path).drop("control_day").select(*want.columns), want)


def test_two_writers_lose_no_change(spark):
    reg, _ = registered(spark, "g1")
    reg.register_specs([daily("g2")])
    other, first = Registry(spark, reg.root), []

    def change(rows):
        if not first:  # another writer commits between this read and this commit
            first.append(other.backfill("g2", dt.datetime(2024, 1, 1)))
        return rows.withColumn("target_label", F.when(F.col("target_table") == "g1", "a")
                               .otherwise(F.col("target_label")))

    from rollwise.specs import TARGETS_SCHEMA
    assert reg._change("targets", TARGETS_SCHEMA, change)
    assert reg.target_spec("g1").label == "a"
    assert reg.target_spec("g2").batch_processed == dt.datetime(2024, 1, 1)


def test_spec_fields_survive_registration_and_a_bad_spec_takes_no_lock(spark):
    reg, t = registered(spark, "r", not_null=("data_date",), source_dim="zone", blank_as_null=False,
                        row_pattern_column=None, batch_processed=None)
    got: TargetSpec = reg.target_spec("r")
    assert (got.not_null, got.source_dim, got.blank_as_null, got.row_pattern_column) == \
        (("data_date",), "zone", False, None)
    with pytest.raises(ValueError, match="Python function"):
        reg.register_specs(sources=[SourceSpec("r", "orders", transformation=u_events)])
    versions = reg._latest("targets")
    try:
        reg.aggregate_due(Catalog(spark, SF), "r", dt.datetime(2024, 1, 6), fresh_path(spark, "r"))
    except ValueError:
        pass
    assert reg._latest("targets") == versions and reg.target_spec("r").batch_processing is None


def test_upsert_without_keys_updates_every_target_row(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "d string, m int")
    got = upsert(target, spark.createDataFrame([(9,)], "m int"), [], ["m"])
    assert sorted(map(tuple, got.collect())) == [("a", 9), ("b", 9)]
