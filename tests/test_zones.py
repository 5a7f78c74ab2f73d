"""Range runs by zone map: no late row lost, only the files in question read."""

import datetime as dt

import pytest
from pyspark.sql import Window, functions as F

from rollwise.checks import fixtures as fx
from rollwise.operators.aggregate import aggregate_frame, plan_source
from rollwise.plans.incremental import range_batch, run_target
from rollwise.session import fresh_path
from rollwise.sources.catalog import Catalog
from rollwise.sources.unified import U_EVENTS_SQL, u_events
from rollwise.sources.zones import ZoneMap
from tests.conftest import SF, SF_SMALL

DAYS = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12))


def daily(processed=9):
    t = fx.target_2(name="z")
    t.batch_processed = dt.datetime(2024, 1, processed)
    return t


@pytest.fixture(scope="module")
def files(spark):
    """Events by day, one file each, under a path with a blank."""
    base = fresh_path(spark, "zone files")
    spark.read.parquet(f"{SF}/events.parquet").repartitionByRange(30, "ts").write.parquet(f"{base}/events.parquet")
    return base


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_range_reads_only_files_that_meet_it(spark, files):
    cat, t, src, zones = Catalog(spark, files), daily(), fx.src_events("z"), ZoneMap(spark, fresh_path(spark, "zones"))
    assert zones.refresh(cat, t, src)
    found = zones.narrowed(cat, t, src, *DAYS)
    assert 2 <= found.files <= 5 and found.offsets is not None
    scanned = found.catalog.table("events").select("event_id", F.input_file_name().alias("f")).select("f").distinct()
    assert scanned.count() == found.files
    plan = range_batch(cat, t, [src], *DAYS, zones=zones).frame
    assert "GreaterThanOrEqual(ts" in plan._jdf.queryExecution().executedPlan().toString()
    assert rows(plan) == rows(range_batch(Catalog(spark, SF), t, [src], *DAYS).frame)
    src.transformation = U_EVENTS_SQL  # the same as text: a map of its own
    assert zones.refresh(cat, t, src) and zones.narrowed(cat, t, src, *DAYS).files == found.files


def test_row_far_off_its_raw_time_is_kept(spark):
    """One row 19 days before its control date: every row of the run is there."""
    def late(df):
        first = F.col("event_id") == 40
        return u_events(df, keep=["event_id"]).withColumn("data_date", F.when(first, F.date_add("data_date", 19)).otherwise(
            F.col("data_date"))).drop("event_id")
    cat, t, src, path = Catalog(spark, SF_SMALL), daily(1), fx.src_events("z"), fresh_path(spark, "late")
    src.transformation = late
    run_target(cat, t, [src], dt.datetime(2024, 1, 31, 12), path)
    whole = late(cat.table("events")).where((F.col("data_date") >= dt.date(2024, 1, 2)) & (F.col("data_date") <= dt.date(2024, 1, 31)))
    want = aggregate_frame(whole, t, plan_source(t, src))
    assert rows(spark.read.parquet(path).select(*want.columns)) == rows(want)


def test_files_added_rewritten_and_removed(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    base = fresh_path(spark, "changing")
    at = f"{base}/events.parquet"
    day = F.to_date("ts")
    ev.where(day < dt.date(2024, 1, 10)).coalesce(1).write.parquet(at)
    t, src, zones = daily(), fx.src_events("z"), ZoneMap(spark, fresh_path(spark, "zones"))

    def check():
        cat = Catalog(spark, base)
        assert rows(range_batch(cat, t, [src], *DAYS, zones=zones).frame) == rows(range_batch(cat, t, [src], *DAYS).frame)
        return zones.narrowed(cat, t, src, *DAYS).files

    assert zones.refresh(Catalog(spark, base), t, src) and check() in (0, 1)  # rounding reaches the 10th
    ev.where(day >= dt.date(2024, 1, 10)).coalesce(1).write.mode("append").parquet(at)
    assert check() >= 1  # not in the map yet: read all the same
    assert zones.refresh(Catalog(spark, base), t, src) and check() >= 1
    ev.where(day >= dt.date(2024, 1, 20)).coalesce(1).write.mode("overwrite").parquet(at)
    assert zones.refresh(Catalog(spark, base), t, src) and check() == 0


def test_transformations_that_prove_nothing_read_the_table(spark, files):
    def shuffled(df):
        first = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
        return u_events(df.withColumn("n", first).where("n > 1").drop("n"))

    def twice(df):
        return u_events(df.join(F.broadcast(df.groupBy("user_id").agg(F.min("ts").alias("f"))), "user_id").where("ts > f").drop("f"))
    for transformation in (shuffled, twice):
        cat, t, src, zones = Catalog(spark, files), daily(), fx.src_events("z"), ZoneMap(spark, fresh_path(spark, "zones"))
        src.transformation = transformation
        assert not zones.refresh(cat, t, src)
        assert zones.narrowed(cat, t, src, *DAYS).files is None
        got = range_batch(cat, t, [src], *DAYS, zones=zones).frame
        assert rows(got) == rows(range_batch(Catalog(spark, SF), t, [src], *DAYS).frame)
    memory = Catalog(spark, files, {"events": spark.createDataFrame(cat.table("events").limit(50).collect(), cat.table("events").schema)})
    assert not ZoneMap(spark, fresh_path(spark, "zones")).refresh(memory, daily(), fx.src_events("z"))


def test_latest_control_time_from_the_map(spark, files):
    cat, t, src, zones = Catalog(spark, files), daily(), fx.src_events("z"), ZoneMap(spark, fresh_path(spark, "zones"))
    assert zones.refresh(cat, t, src)
    want = u_events(cat.table("events")).agg(F.max("data_date").cast("timestamp_ntz")).first()[0]
    assert zones.latest(cat, t, src).first()[0] == want
