"""Complete chunks, the availability cap, range preview, source collisions, the change index."""

import datetime as dt
import json

from pyspark.sql import functions as F

from rollwise.__main__ import main
from rollwise.checks import fixtures as fx
from rollwise.operators.aggregate import aggregate_frame, plan_source
from rollwise.plans.incremental import plan_bounds, preview_range, range_batch, run_target
from rollwise.plans.workflow import Registry
from rollwise.session import fresh_path
from rollwise.sources.catalog import Catalog
from rollwise.sources.unified import U_EVENTS_SQL, u_events
from rollwise.streaming.continuous import ChunkIndex, run_stream
from tests.conftest import SF


def daily(processed=9, name="c"):
    t = fx.target_2(name=name)
    t.batch_processed = dt.datetime(2024, 1, processed)
    return t


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_only_complete_and_covered_chunks_run(spark):
    cat, path, now = Catalog(spark, SF), fresh_path(spark, "complete"), dt.datetime(2024, 1, 14, 12)
    t, src = daily(), fx.src_events("c")
    src.data_availabletime = dt.datetime(2024, 1, 14)
    r = run_target(cat, t, [src], now, path, complete_only=True)
    assert (r.end, r.chunks, t.batch_processed) == (dt.datetime(2024, 1, 13, 12), 4, dt.datetime(2024, 1, 13))
    r = run_target(cat, t, [src], now, path, complete_only=True)
    assert r.chunks == 0 and t.batch_processed == dt.datetime(2024, 1, 13)  # the 14th is not over
    other = fx.src_orders("c")
    other.data_availabletime = dt.datetime(2024, 1, 11)
    t = daily()
    assert run_target(cat, t, [src, other], now, fresh_path(spark, "capped"), capped=True).chunks == 2
    assert t.batch_processed == dt.datetime(2024, 1, 11)
    assert run_target(cat, daily(), [src], now, fresh_path(spark, "plain")).chunks == 5


def test_preview_lists_chunks_and_decisions(spark):
    cat, t, src, coarse = Catalog(spark, SF), daily(), fx.src_events("c"), fx.src_orders("c")
    t.groupby_flexible, coarse.pattern_default = False, 4
    now = dt.datetime(2024, 1, 12, 9)
    got = {(r.chunk_start.day, r.source_table): (r.accepted, r.n_rows) for r in preview_range(cat, t, [src, coarse], now).collect()}
    per_day = {r[0].day: r[1] for r in u_events(cat.table("events")).groupBy("data_date").count().collect()}
    assert got == {(d, s): (s == "events", per_day[d] if s == "events" else 0) for d in (10, 11, 12) for s in ("events", "orders")}
    assert preview_range(cat, t, [], now).collect() == []


def test_sources_that_share_a_value_keep_the_higher_priority(spark):
    """Both sources say data_i1 = 1 for the same days: rows never add up."""
    cat, t = Catalog(spark, SF), daily()
    low, high = fx.src_events("c"), fx.src_events("c", name="again", priority=5)
    high.transformation = lambda df: u_events(df).where("data_i2 < 8").withColumn("value_i1", F.col("value_i1") + 1000)
    cat = cat.with_table("again", cat.table("events"))
    begin, end = plan_bounds(t, dt.datetime(2024, 1, 12, 9))
    got = range_batch(cat, t, [high, low], begin, end).frame
    one = lambda s: range_batch(cat, t, [s], begin, end).frame
    keys = ["data_dt", "data_i1", "data_i2", "data_i3", "data_a1", "data_a2", "data_a3"]
    first = one(high)
    cond = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    want = first.unionByName(one(low).alias("l").join(first.alias("r"), cond, "left_anti"))
    assert rows(got) == rows(want)


def test_micro_batch_reads_the_files_of_its_chunks(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    inbox, path, ckpt = fresh_path(spark, "in box"), fresh_path(spark, "t"), fresh_path(spark, "ckpt")
    t, src = daily(), fx.src_events("c")
    day = F.to_date("ts")
    late = day.isin(dt.date(2024, 1, 3), dt.date(2024, 1, 28)) & (F.col("event_id") % 10 == 0)

    def arrive(df, files):
        df.repartitionByRange(files, "ts").write.mode("append").parquet(inbox)
        run_stream(spark, inbox, ev.schema, t, src, None, path, ckpt).awaitTermination()

    arrive(ev.where(~late), 30)
    arrive(ev.where(late), 1)
    touched = u_events(ev.where(late)).select(F.col("data_date").cast("timestamp_ntz").alias("_rw_chunk")).distinct()
    files = ChunkIndex(spark, f"{ckpt}.chunks").files(touched)
    assert 3 <= len(files) <= 9  # of 31; the span from the 3rd to the 28th holds them all
    want = aggregate_frame(u_events(ev), t, plan_source(t, src))
    assert rows(spark.read.parquet(path).drop("control_day")) == rows(want.where("data_dt is not null"))


def test_command_line_registers_tries_and_enables(spark, tmp_path, capsys):
    root, path = fresh_path(spark, "cli"), fresh_path(spark, "cli_table")
    t = fx.target_2(name="d")
    target = {"target_table": "d", "batch_control_column": "data_dt", "batch_control_size": 1440, "batch_schedule_type": "DAILY",
              "batch_processed": "2024-01-04T00:00:00", "pattern_columns": json.dumps(t.pattern_columns),
              "groupby_columns": json.dumps(t.groupby_columns), "groupby_flags": json.dumps(fx.FLAGS_2), "groupby_flexible": True,
              "aggregate_columns": json.dumps(t.aggregate_columns), "aggregate_functions": json.dumps(t.aggregate_functions)}
    source = {"target_table": "d", "source_table": "events", "source_enabled": False, "transformation": U_EVENTS_SQL}
    for kind, row in (("targets", target), ("sources", source)):
        (tmp_path / f"{kind}.json").write_text(json.dumps(row) + "\n")
        assert main(["register", "--registry", root, "--kind", kind, "--rows", str(tmp_path / f"{kind}.json")]) == 0
    base = ["--registry", root, "--tables", SF, "--target", "d"]
    assert main(["chunk", *base, "--path", path, "--at", "2024-01-03", "--mode", "test"]) == 0
    assert spark.read.parquet(path).count() > 0
    assert main(["enable", *base, "--value", "true"]) == 0
    assert Registry(spark, root).source_specs("d")[0].enabled is True
    assert main(["preview", *base, "--now", "2024-01-06T09:00", "--complete-only"]) == 0
    assert "|d|2024-01-05 00:00:00|events|1728|True|" in capsys.readouterr().out
    assert main(["run-due", *base, "--path", path, "--now", "2024-01-06T09:00", "--complete-only"]) == 0
    assert "chunks 1:" in capsys.readouterr().out
