"""The demo workflow on a persisted registry: register from JSON text, test a
new source, park it, enable it, run every due chunk."""

import datetime as dt
import json

from pyspark.sql import functions as F

from rollwise.checks import fixtures as fx
from rollwise.plans.incremental import range_batch
from rollwise.plans.workflow import Registry
from rollwise.session import fresh_path
from rollwise.sources.catalog import Catalog
from rollwise.sources.unified import PATTERN_COLUMNS, U_EVENTS_SQL
from rollwise.specs import SourceSpec

SF = "/root/testdata/sf0.01"


def test_registry_workflow(spark):
    reg = Registry(spark, fresh_path(spark, "registry"))
    t2 = fx.target_2()
    row = dict(
        target_label="test: daily target", target_table="daily",
        batch_control_column="data_dt", batch_control_size=1440,
        batch_control_next="DATEADD(MINUTE, :2, :1)",
        batch_processed=dt.datetime(2024, 1, 4), batch_schedule_type="DAILY",
        pattern_columns=json.dumps(PATTERN_COLUMNS), groupby_columns=json.dumps(t2.groupby_columns),
        groupby_flags=json.dumps(fx.FLAGS_2), groupby_flexible=True,
        aggregate_columns=json.dumps(t2.aggregate_columns),
        aggregate_functions=json.dumps(t2.aggregate_functions))
    reg.register_targets(spark.createDataFrame([row]).withColumn(
        "batch_processed", F.col("batch_processed").cast("timestamp_ntz")))
    spec = reg.target_spec("daily")
    assert spec.groupby_pattern == 1728 and spec.id == 1

    src = spark.createDataFrame([("daily", "events", False, 0, U_EVENTS_SQL)],
                                "target_table string, source_table string, source_enabled boolean, "
                                "pattern_default bigint, transformation string") \
        .withColumn("data_availabletime", F.lit(dt.datetime(2024, 1, 10)).cast("timestamp_ntz"))
    reg.register_sources(src)

    cat = Catalog(spark, SF)
    path = fresh_path(spark, "daily_table")
    # Test the new source on one chunk; live sources are not touched.
    tested = reg.aggregate_chunk(cat, "daily", dt.datetime(2024, 1, 3), path, mode="test")
    assert tested.count() > 0
    assert reg.aggregate_chunk(cat, "daily", dt.datetime(2024, 1, 3), path) is None
    reg.set_enabled("daily", ["events"], None)            # park
    assert reg.source_specs("daily")[0].enabled is None
    reg.set_enabled("daily", ["events"], True)            # go live

    now = dt.datetime(2024, 1, 10, 8, 0)
    res = reg.aggregate_due(cat, "daily", now, path)
    assert res.chunks == 6                                 # 01-05 ... 01-10
    after = reg.target_spec("daily")
    assert after.batch_processed == dt.datetime(2024, 1, 10)
    assert after.batch_processing is None and after.batch_schedule_last == now

    table = spark.read.parquet(path).drop("control_day")
    spec = reg.target_spec("daily")
    want = range_batch(cat, spec, [SourceSpec("daily", "events", True,
                                              transformation=U_EVENTS_SQL)],
                       dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 10)).frame
    got = table.where(F.col("data_dt") >= F.lit(dt.date(2024, 1, 5))).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert table.where(F.col("data_dt") == F.lit(dt.date(2024, 1, 3))).count() == tested.count()


def test_uncommitted_snapshot_is_skipped(spark):
    reg = Registry(spark, fresh_path(spark, "registry2"))
    src = spark.createDataFrame([("t", "a", True, 0, None)],
                                "target_table string, source_table string, source_enabled boolean, "
                                "pattern_default bigint, transformation string")
    reg.register_sources(src)
    # A lost job leaves a snapshot folder without its _SUCCESS marker.
    spark.createDataFrame([(99,)], "x int").write.parquet(reg.root + "/sources/v000002")
    import os
    os.remove(reg.root.replace("file:", "") + "/sources/v000002/_SUCCESS")
    assert reg.sources().count() == 1
    reg.set_enabled("t", ["a"], False)
    assert reg._latest("sources") == 3 and reg.source_specs("t")[0].enabled is False


def test_refresh_and_cli_run(spark, capsys):
    from rollwise.__main__ import main
    reg = Registry(spark, fresh_path(spark, "registry3"))
    t2 = fx.target_2()
    row = dict(target_table="d2", batch_control_column="data_dt", batch_control_size=1440,
               batch_schedule_type="DAILY", pattern_columns=json.dumps(PATTERN_COLUMNS),
               groupby_columns=json.dumps(t2.groupby_columns), groupby_flexible=True,
               aggregate_columns=json.dumps(t2.aggregate_columns),
               aggregate_functions=json.dumps(t2.aggregate_functions))
    reg.register_targets(spark.createDataFrame([row]).withColumn(
        "batch_processed", F.lit(dt.datetime(2024, 1, 27)).cast("timestamp_ntz")))
    reg.register_sources(spark.createDataFrame(
        [("d2", "events", True, 0, U_EVENTS_SQL)], "target_table string, source_table string, "
        "source_enabled boolean, pattern_default bigint, transformation string"))
    assert main(["refresh", "--registry", reg.root, "--tables", SF, "--target", "d2"]) == 0
    assert reg.source_specs("d2")[0].data_availabletime == dt.datetime(2024, 1, 30)
    path = fresh_path(spark, "d2_table")
    assert main(["run-due", "--registry", reg.root, "--tables", SF, "--target", "d2",
                 "--path", path, "--now", "2024-01-31T06:00:00"]) == 0
    assert "chunks 4" in capsys.readouterr().out          # 01-28 ... 01-31
    assert reg.target_spec("d2").batch_processed == dt.datetime(2024, 1, 30)
    assert spark.read.parquet(path).select("data_dt").distinct().count() == 3


def test_sliding_and_backfill_flows(spark, capsys):
    """The reference's manual and sliding schedules: backfill reset then run;
    availability at today - 3 days then run, twice."""
    from rollwise.__main__ import main
    reg = Registry(spark, fresh_path(spark, "registry4"))
    t2 = fx.target_2()
    row = dict(target_table="s2", batch_control_column="data_dt", batch_control_size=1440,
               batch_schedule_type="DAILY", pattern_columns=json.dumps(PATTERN_COLUMNS),
               groupby_columns=json.dumps(t2.groupby_columns), groupby_flexible=True,
               aggregate_columns=json.dumps(t2.aggregate_columns),
               aggregate_functions=json.dumps(t2.aggregate_functions))
    reg.register_targets(spark.createDataFrame([row]).withColumn(
        "batch_processed", F.lit(dt.datetime(2024, 1, 29)).cast("timestamp_ntz")))
    reg.register_sources(spark.createDataFrame(
        [("s2", "events", True, 0, U_EVENTS_SQL)], "target_table string, source_table string, "
        "source_enabled boolean, pattern_default bigint, transformation string"))
    path = fresh_path(spark, "s2_table")
    base = ["--registry", reg.root, "--tables", SF, "--target", "s2"]
    main(["backfill", *base, "--since", "2024-01-20"])
    assert reg.target_spec("s2").batch_processed == dt.datetime(2024, 1, 20)
    for now in ("2024-01-28T09:00:00", "2024-01-29T09:00:00"):
        main(["slide", *base, "--days", "3", "--now", now])
        main(["run-due", *base, "--path", path, "--now", now])
    out = capsys.readouterr().out
    assert "chunks 8: 2024-01-21" in out          # backfilled period, first run
    assert "chunks 4: 2024-01-26" in out          # then only the last 3 days + today
    assert reg.target_spec("s2").batch_processed == dt.datetime(2024, 1, 26)
    days = {r.data_dt for r in spark.read.parquet(path).select("data_dt").distinct().collect()}
    assert days == {dt.date(2024, 1, d) for d in range(21, 30)}


def test_stream_from_registry_resumes(spark):
    """``rollwise stream`` twice: the second run only sees the new file."""
    from rollwise.__main__ import main
    from rollwise.operators.aggregate import aggregate_frame, plan_source
    from rollwise.sources.unified import u_events
    reg = Registry(spark, fresh_path(spark, "registry5"))
    t2 = fx.target_2()
    row = dict(target_table="st", batch_control_column="data_dt", batch_control_size=1440,
               batch_schedule_type="DAILY", pattern_columns=json.dumps(PATTERN_COLUMNS),
               groupby_columns=json.dumps(t2.groupby_columns), groupby_flexible=True,
               aggregate_columns=json.dumps(t2.aggregate_columns),
               aggregate_functions=json.dumps(t2.aggregate_functions))
    reg.register_targets(spark.createDataFrame([row]).withColumn(
        "batch_processed", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")))
    reg.register_sources(spark.createDataFrame(
        [("st", "events", True, 0, U_EVENTS_SQL)], "target_table string, source_table string, "
        "source_enabled boolean, pattern_default bigint, transformation string"))
    small = "/root/testdata/sf0.001"
    events = Catalog(spark, small).table("events")
    inbox, path = fresh_path(spark, "st_inbox"), fresh_path(spark, "st_table")
    cut = F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz")
    events.where(F.col("ts") < cut).coalesce(1).write.parquet(inbox + "/a")
    args = ["stream", "--registry", reg.root, "--tables", small, "--target", "st",
            "--inbox", inbox + "/*/*.parquet", "--path", path]
    assert main(args) == 0
    events.where(F.col("ts") >= cut).coalesce(1).write.parquet(inbox + "/b")
    assert main(args) == 0
    want = aggregate_frame(u_events(events), reg.target_spec("st"),
                           plan_source(reg.target_spec("st"), reg.source_specs("st")[0]))
    got = spark.read.parquet(path).drop("control_day").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_register_specs_round_trip(spark):
    reg = Registry(spark, fresh_path(spark, "registry6"))
    t = fx.target_2(name="py")
    t.batch_processed = dt.datetime(2024, 1, 4)
    s = SourceSpec("py", "events", True, transformation=U_EVENTS_SQL,
                   data_availabletime=dt.datetime(2024, 1, 9))
    reg.register_specs([t], [s])
    back = reg.target_spec("py")
    assert (back.groupby_pattern, back.control_column, back.chunk_minutes, back.id) == \
        (t.groupby_pattern, "data_dt", 1440, 1)
    assert back.dims == t.dims and back.aggregate_functions == t.aggregate_functions
    src = reg.source_specs("py")[0]
    assert src.enabled is True and src.transformation == U_EVENTS_SQL and src.id == 1


def test_registry_source_prunes_with_raw_control(spark):
    """A registry source that names its raw time column gets the bound its zone
    map proves: the range job's scan carries a pushed filter on ``ts``."""
    from rollwise.plans.incremental import range_batch
    reg = Registry(spark, fresh_path(spark, "registry7"))
    t = fx.target_1(name="p1")
    t.batch_processed = dt.datetime(2024, 1, 4)
    reg.register_specs([t], [SourceSpec("p1", "events", True, transformation=U_EVENTS_SQL,
                                        control_column="data_ts")])
    src = reg.source_specs("p1")[0]
    assert src.control_column == "data_ts"
    cat, zones = Catalog(spark, SF), reg.zones("p1")
    assert zones.refresh(cat, reg.target_spec("p1"), src)
    b = range_batch(cat, reg.target_spec("p1"), [src],
                    dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 5, 23, 55), zones=zones)
    plan = b.frame._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_cli_status(spark, capsys):
    from rollwise.__main__ import main
    reg = Registry(spark, fresh_path(spark, "registry8"))
    t = fx.target_2(name="st2")
    t.batch_processed = dt.datetime(2024, 1, 4)
    reg.register_specs([t], [])
    assert main(["status", "--registry", reg.root, "--tables", SF,
                 "--now", "2024-01-08T10:00:00"]) == 0
    import re
    out = capsys.readouterr().out
    assert re.search(r"\|st2\s*\|DAILY\s*\|2024-01-05 00:00:00\|2024-01-08 00:00:00\|4\s*\|", out)


def test_cli_dry_run_writes_and_locks_nothing(spark, capsys):
    import os
    from rollwise.__main__ import main
    reg = Registry(spark, fresh_path(spark, "registry9"))
    t = fx.target_2(name="dry")
    t.batch_processed = dt.datetime(2024, 1, 4)
    reg.register_specs([t], [SourceSpec("dry", "events", True, transformation=U_EVENTS_SQL)])
    versions = reg._latest("targets")
    path = fresh_path(spark, "dry_table")
    assert main(["run-due", "--registry", reg.root, "--tables", SF, "--target", "dry",
                 "--path", path, "--now", "2024-01-08T10:00:00", "--dry-run"]) == 0
    assert "chunks 4" in capsys.readouterr().out
    assert not os.path.exists(path) and reg._latest("targets") == versions
    assert reg.target_spec("dry").batch_processing is None
