"""Figures worked out independently in SURVEY/FIXTURES, at sf0.01."""

from pyspark.sql import functions as F

from rollwise.checks import fixtures as fx
from rollwise.plans import registry as R
from rollwise.sources.catalog import Catalog

SF = "/root/testdata/sf0.01"


def test_pattern_profile_counts(spark):
    import __spark_entry__ as E
    got = {r.data_pattern: r.n_rows for r in E.queries()["pattern_profile"](spark, SF).collect()}
    assert got == {0: 9542, 1: 53, 2: 401, 3: 4}


def test_due_targets_and_chunks(spark):
    t = fx.targets_gen(Catalog(spark, SF).table("customer"))
    due = R.due_targets(t, fx.NOW)
    assert due.count() == 1274
    assert due.where(F.col("batch_loop_begin") > F.col("batch_loop_end")).count() == 400
    hourly = R.chunk_list(due).where(F.col("batch_schedule_type") == "HOURLY")
    assert hourly.count() == 9793


def test_chunk_agg_first_slice(spark):
    """The minimum slice of SURVEY §7.2: 299 groups (5-minute time x event
    type) for 2024-01-03."""
    import datetime as dt
    from rollwise.operators.aggregate import aggregate_frame, plan_source
    from rollwise.sources.unified import u_events
    ev = u_events(Catalog(spark, SF).table("events"))
    day = ev.where((F.col("data_ts") >= F.lit(dt.datetime(2024, 1, 3)).cast("timestamp_ntz"))
                   & (F.col("data_ts") < F.lit(dt.datetime(2024, 1, 4)).cast("timestamp_ntz")))
    t = fx.target_1(mask=2047 - 64 - 4)      # keep the 5-minute time and the event type
    assert aggregate_frame(day, t, plan_source(t, fx.src_events("t"))).count() == 299
