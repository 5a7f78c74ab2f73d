"""Chunk aggregation, one-job ranges, upsert/purge rules, end-to-end runs."""

import datetime as dt

from pyspark.sql import functions as F

from rollwise.checks import fixtures as fx
from rollwise.operators.aggregate import in_chunk
from rollwise.operators.upsert import purge, upsert
from rollwise.plans.incremental import chunk_batch, range_batch, run_target
from rollwise.session import fresh_path
from rollwise.sources.catalog import Catalog, resolve_source
from rollwise.sources.unified import U_EVENTS_SQL, u_events
from rollwise.specs import SourceSpec

SF = "/root/testdata/sf0.01"


def rows(df):
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_sql_text_source_equals_dataframe_source(spark):
    cat = Catalog(spark, SF)
    a = resolve_source(cat, SourceSpec("t", "events", transformation=U_EVENTS_SQL))
    b = resolve_source(cat, SourceSpec("t", "events", transformation=u_events))
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_custom_step_expression(spark):
    df = spark.range(1).select(F.lit(dt.datetime(2024, 1, 3, 23, 59)).cast("timestamp_ntz")
                               .alias("t"))
    day = dt.datetime(2024, 1, 3)
    for step in ("dateadd(HOUR, :2 div 60, :1)", "timestampadd(MINUTE, :2, :1)",
                 "CASE WHEN '10:20' = '10:20' THEN timestampadd(MINUTE, :2, :1) END"):
        assert df.where(in_chunk(F.col("t"), day, 1440, step, spark)).count() == 1


def test_range_in_one_job_equals_chunk_loop(spark):
    cat = Catalog(spark, SF)
    t = fx.target_1()
    src = [fx.src_events(t.target_table)]
    one = range_batch(cat, t, src, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 5, 23, 55))
    # the same chunks one by one, aligned on the target time (per-chunk loop)
    t.chunk_minutes = 60
    loop = None
    for h in range(24):
        b = range_batch(cat, t, src, dt.datetime(2024, 1, 5, h), dt.datetime(2024, 1, 5, h))
        loop = b.frame if loop is None else loop.unionByName(b.frame)
    assert rows(one.frame) == rows(loop)


def test_no_rows_lost_at_chunk_borders(spark):
    """Sum of counts over the range equals the source rows whose target time
    falls in the range (the warehouse lost rows here, Q1)."""
    cat = Catalog(spark, SF)
    t = fx.target_1()
    b = range_batch(cat, t, [fx.src_events(t.target_table)], dt.datetime(2024, 1, 5),
                    dt.datetime(2024, 1, 9, 23, 55))
    got = b.frame.agg(F.sum("vcnt_i2")).first()[0]
    ev = u_events(cat.table("events"))
    want = ev.where((F.col("data_time") >= F.lit(dt.datetime(2024, 1, 5)).cast("timestamp_ntz"))
                    & (F.col("data_time") < F.lit(dt.datetime(2024, 1, 10))
                       .cast("timestamp_ntz"))).count()
    assert got == want


def test_gate_and_test_mode(spark):
    cat = Catalog(spark, SF)
    t = fx.target_1(flexible=False)
    coarse = fx.src_events(t.target_table, pattern_default=64, name="events")
    b = chunk_batch(cat, t, [coarse], fx.DAY_EVENTS, minutes=1440)
    assert b.frame is None and not b.plans[0].accepted
    live = fx.src_events(t.target_table, enabled=True)
    tested = fx.src_events(t.target_table, enabled=False)
    parked = fx.src_events(t.target_table, enabled=None)
    assert chunk_batch(cat, t, [live, tested, parked], fx.DAY_EVENTS, mode="test") \
        .plans[0].source is tested


def test_source_collision_priority(spark):
    cat = Catalog(spark, SF)
    t = fx.target_2()
    t.source_dim = None          # both sources are events: keys do collide
    low = fx.src_events(t.target_table, priority=0)
    high = fx.src_events(t.target_table, priority=5)
    high.transformation = lambda df: u_events(df).withColumn("value_i1", F.lit(1000).cast("bigint"))
    b = chunk_batch(cat, t, [low, high], fx.DAY_EVENTS)
    assert b.frame.where(F.col("vsum_i1") % 1000 != 0).count() == 0


def test_upsert_rules(spark):
    target = spark.createDataFrame(
        [(None, 1, 5.0), ("b", 2, 6.0), ("c", 3, 7.0)], "k string, m bigint, x double")
    batch = spark.createDataFrame([("", None, 1.0), ("d", 4, 2.0)], "k string, m bigint, x double")
    out = {r.k: (r.m, r.x) for r in upsert(target, batch, ["k"], ["m", "x"]).collect()}
    assert out[None] == (None, 1.0)     # NULL key matches '', NULL measure overwrites
    assert out["b"] == (2, 6.0) and out["d"] == (4, 2.0) and len(out) == 4


def test_purge_keeps_null_control(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 5),), (None,)], "t timestamp_ntz")
    assert purge(df, "t", dt.datetime(2024, 1, 1), 60).count() == 1


def test_run_target_writes_and_rerun_is_idempotent(spark):
    cat = Catalog(spark, SF)
    t = fx.target_2()
    t.batch_processed = dt.datetime(2024, 1, 4)
    src = [fx.src_events(t.target_table)]
    path = fresh_path(spark, "it_target")
    now = dt.datetime(2024, 1, 8, 10, 0)
    r1 = run_target(cat, t, src, now, path)
    assert r1.ran and r1.chunks == 4
    first = rows(spark.read.parquet(path))
    t.batch_processed = dt.datetime(2024, 1, 4)
    run_target(cat, t, src, now, path)
    assert rows(spark.read.parquet(path)) == first
    want = range_batch(cat, t, src, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 8)).frame
    got = spark.read.parquet(path).drop("control_day")
    assert rows(got.select(*want.columns)) == rows(want)


def test_script_only_writes_nothing(spark, tmp_path):
    cat = Catalog(spark, SF)
    t = fx.target_2()
    t.batch_processed = dt.datetime(2024, 1, 4)
    path = str(tmp_path / "never")
    r = run_target(cat, t, [fx.src_events(t.target_table)], dt.datetime(2024, 1, 6), path,
                   script_only=True)
    assert r.ran and r.written.count() > 0
    import os
    assert not os.path.exists(path)


def test_sliced_run_equals_one_job(spark):
    """max_chunks: the same table whether the range runs as one job or as
    slices of 3 chunks, with progress reported after each slice."""
    cat = Catalog(spark, SF)
    now = dt.datetime(2024, 1, 12, 10, 0)
    tables, seen = [], []
    for cap in (None, 3):
        t = fx.target_2()
        t.batch_processed = dt.datetime(2024, 1, 4)
        path = fresh_path(spark, f"sliced_{cap}")
        r = run_target(cat, t, [fx.src_events(t.target_table)], now, path, max_chunks=cap,
                       on_progress=lambda s: seen.append(s.batch_microchunk_current))
        assert r.chunks == 8
        tables.append(rows(spark.read.parquet(path)))
    assert tables[0] == tables[1]
    assert seen[-3:] == [dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 10),
                         dt.datetime(2024, 1, 12)]


def test_sql_source_joining_a_dimension(spark):
    """A SQL-text transformation may join another table of the catalog."""
    cat = Catalog(spark, SF)
    text = ("SELECT o.o_orderkey, n.n_name FROM orders o JOIN customer c "
            "ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey")
    df = resolve_source(cat, SourceSpec("t", "orders", transformation=text))
    assert df.count() == cat.table("orders").count()


def test_replace_union_equals_upsert(spark):
    """For a batch aligned inside the purged range, purge + union (no join)
    gives the same table as purge + upsert."""
    from rollwise.plans.incremental import replace_batch
    cat = Catalog(spark, SF)
    t = fx.target_1(mask=2047 - 256 - 4, name="dt")
    t.control_column, t.chunk_minutes, t.schedule_type = "data_dt", 1440, "DAILY"
    src = [fx.src_events(t.target_table)]
    old = range_batch(cat, t, src, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 10)).frame
    old = old.select("data_dt", "data_a1", *[(F.col(m) + 1).alias(m) for m in t.measures[0]])
    batch = range_batch(cat, t, src, dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 12))
    begin, end = dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 13)
    fast = replace_batch(old, t, batch, begin, end)
    assert "Join" not in fast._jdf.queryExecution().optimizedPlan().toString()
    batch.aligned = None
    slow = replace_batch(old, t, batch, begin, end)
    assert rows(fast) == rows(slow)
