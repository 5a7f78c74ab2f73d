"""Time buckets (F3-F7) and the chunk range rules."""

import datetime as dt

from rollwise.functions.timegrid import floor_minutes, minute_diff, round_minutes, ts_lit
from rollwise.plans.incremental import chunk_starts, is_due, plan_bounds
from rollwise.checks import fixtures as fx


def test_minute_diff_counts_boundaries(spark):
    r = spark.range(1).select(minute_diff(ts_lit("2023-12-31 23:58:30"),
                                          ts_lit("2024-01-01 00:00:00")).alias("d")).first()
    assert r.d == 2


def test_round_and_floor(spark):
    r = spark.range(1).select(
        round_minutes(ts_lit("2024-01-01 00:02:30"), 5).alias("r1"),
        round_minutes(ts_lit("2024-01-01 00:03:00"), 5).alias("r2"),
        floor_minutes(ts_lit("2024-01-01 00:09:59"), 5).alias("f")).first()
    assert r.r1 == dt.datetime(2024, 1, 1, 0, 0)   # minute 2 -> 0 (2/5 rounds down)
    assert r.r2 == dt.datetime(2024, 1, 1, 0, 5)   # minute 3 -> 5
    assert r.f == dt.datetime(2024, 1, 1, 0, 5)


def test_chunk_grid_inclusive_end():
    # processed 00:00, size 5, now 00:12 -> chunks 00:05, 00:10
    t = fx.target_1()
    t.batch_processed = dt.datetime(2024, 1, 1)
    begin, end = plan_bounds(t, dt.datetime(2024, 1, 1, 0, 12))
    n, end_excl = chunk_starts(begin, end, 5)
    assert (begin, n, end_excl) == (dt.datetime(2024, 1, 1, 0, 5), 2,
                                    dt.datetime(2024, 1, 1, 0, 15))


def test_begin_after_end_gives_no_chunks():
    assert chunk_starts(dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1), 5)[0] == 0


def test_due_rules():
    t = fx.target_1()
    t.batch_processed = dt.datetime(2024, 1, 1)
    assert is_due(t, fx.NOW)
    t.batch_processing = dt.datetime(2024, 1, 2)
    assert not is_due(t, fx.NOW)                    # processing, no last schedule
    t.batch_schedule_last = fx.NOW - dt.timedelta(hours=1)
    assert is_due(t, fx.NOW)                        # stale lock


def test_registry_and_single_spec_bounds_agree(spark):
    from rollwise.plans.registry import loop_bounds
    from rollwise.specs import target_from_row
    from rollwise.sources.catalog import Catalog
    cust = Catalog(spark, "/root/testdata/sf0.001").table("customer")
    rows = loop_bounds(fx.targets_gen(cust), fx.NOW).limit(30).collect()
    for r in rows:
        t = target_from_row(r)
        assert plan_bounds(t, fx.NOW) == (r.batch_loop_begin, r.batch_loop_end)
