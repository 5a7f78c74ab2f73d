"""Decisions on the reference's quirks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollwise.checks import fixtures as fx
from rollwise.operators.aggregate import aggregate_frame, plan_source
from rollwise.sources.catalog import Catalog
from rollwise.sources.unified import u_events

SF = "/root/testdata/sf0.001"


def events(spark):
    return u_events(Catalog(spark, SF).table("events"))


def test_dims_matched_by_name_not_position(spark):
    """Q2/Q3: the group-by list in another order than the pattern list, with
    the pattern column not first: every target dim still gets its own source."""
    t = fx.target_1()
    t.groupby_columns = list(reversed(t.groupby_columns))
    df = events(spark)
    got = aggregate_frame(df, t, plan_source(t, fx.src_events(t.target_table)))
    ref = aggregate_frame(df, fx.target_1(), plan_source(fx.target_1(),
                                                         fx.src_events("target_1")))
    cols = sorted(ref.columns)
    assert sorted(got.columns) == cols
    assert got.select(*cols).exceptAll(ref.select(*cols)).count() == 0
    assert got.where(F.col("data_pt").bitwiseAND(7) != 7).count() == 0   # OR-ed with mask


def test_masked_control_column_is_refused():
    """Q4: a purge on a column the mask drops would never match."""
    t = fx.target_2()
    t.control_column = "data_ts"
    t.groupby_columns = t.groupby_columns + ["data_ts:data_time"]
    with pytest.raises(ValueError, match="masked out"):
        t.validate()


def test_unknown_schedule_type_is_refused():
    t = fx.target_2()
    t.schedule_type = "WEEKLY"
    with pytest.raises(ValueError, match="schedule type"):
        t.validate()


def test_all_masked_gives_one_global_row(spark):
    """Q18: no dim kept -> one row over the whole chunk (the warehouse SQL
    would not even parse)."""
    t = fx.target_1(mask=2047)
    df = events(spark)
    out = aggregate_frame(df, t, plan_source(t, fx.src_events(t.target_table))).collect()
    assert len(out) == 1 and out[0].vcnt_i2 == df.count()


def test_flexible_target_takes_coarser_source(spark):
    """A coarser source (hour missing) is refused by a strict target and
    taken by a flexible one, at the coarser granularity."""
    src = fx.src_events("t", pattern_default=128)          # data_hour missing
    strict, flexible = fx.target_1(flexible=False), fx.target_1(flexible=True)
    assert not plan_source(strict, src).accepted
    plan = plan_source(flexible, src)
    assert plan.accepted and plan.effective_mask == 7 | 128 and "data_hr" not in plan.keys


def test_chunk_size_decides_a_day_call(spark):
    """Q22: a 'one day' call on a 5-minute target covers one 5-minute chunk."""
    from rollwise.plans.incremental import chunk_batch
    t = fx.target_1()
    b = chunk_batch(Catalog(spark, SF), t, [fx.src_events(t.target_table)],
                    dt.datetime(2024, 1, 3))
    ts = [r.data_ts for r in b.frame.select("data_ts").distinct().collect()]
    assert all(dt.datetime(2024, 1, 3) <= x <= dt.datetime(2024, 1, 3, 0, 5) for x in ts)


def test_upsert_without_keys_replaces_the_global_row(spark):
    from rollwise.operators.upsert import upsert
    t = spark.createDataFrame([(5,)], "m bigint")
    b = spark.createDataFrame([(7,)], "m bigint")
    assert [r.m for r in upsert(t, b, [], ["m"]).collect()] == [7]
    assert [r.m for r in upsert(t, b.limit(0), [], ["m"]).collect()] == [5]


def test_range_job_refuses_non_additive_step(spark):
    from rollwise.plans.incremental import range_batch
    t = fx.target_2()
    t.step = "dateadd(MONTH, 1, :1)"
    with pytest.raises(ValueError, match="additive"):
        range_batch(Catalog(spark, SF), t, [fx.src_events(t.target_table)],
                    dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6))
    t.step = "dateadd(HOUR, :2 div 60, :1)"      # same as +1440 minutes: accepted
    range_batch(Catalog(spark, SF), t, [fx.src_events(t.target_table)],
                dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6))


def test_registry_upsert_refuses_repeated_keys(spark):
    from rollwise.operators.upsert import upsert_registry
    cur = spark.createDataFrame([(1, "a", 5)], "id bigint, k string, v int")
    inc = spark.createDataFrame([("a", 6), ("a", 7)], "k string, v int")
    with pytest.raises(ValueError, match="repeat a key"):
        upsert_registry(cur, inc, ["k"])


def test_effective_mask_edge_row():
    """FIXTURES §4: target mask 7 with a source lacking bit 8 -> 15; refused
    by a strict target, taken by a flexible one."""
    src = fx.src_events("t", pattern_default=8)
    strict = plan_source(fx.target_1(flexible=False), src)
    flexible = plan_source(fx.target_1(flexible=True), src)
    assert strict.effective_mask == flexible.effective_mask == 15
    assert not strict.accepted and flexible.accepted


def test_due_target_without_live_sources(spark):
    """Q13: nothing is written, processed stays, the lock is released."""
    from rollwise.plans.incremental import run_target
    from rollwise.session import fresh_path
    t = fx.target_2()
    t.batch_processed = dt.datetime(2024, 1, 4)
    t.batch_processing = None
    path = fresh_path(spark, "no_live")
    r = run_target(Catalog(spark, SF), t, [fx.src_events(t.target_table, enabled=None)],
                   dt.datetime(2024, 1, 8), path)
    import os
    assert r.ran and r.written is None and not os.path.exists(path)
    assert t.batch_processed == dt.datetime(2024, 1, 4) and t.batch_processing is None
