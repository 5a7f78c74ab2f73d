"""Command line for an outside scheduler (cron, a workflow tool).

    python -m rollwise run-due  --registry ROOT --tables DIR --target NAME --path TABLE
                                [--now ISO] [--dry-run] [--max-chunks N] [--complete-only] [--capped]
    python -m rollwise preview  --registry ROOT --tables DIR --target NAME [--now ISO]
                                [--complete-only] [--capped]
    python -m rollwise chunk    --registry ROOT --tables DIR --target NAME --path TABLE --at ISO
                                [--mode enabled|test] [--dry-run]
    python -m rollwise enable   --registry ROOT --target NAME --value true|false|null [--sources A,B]
    python -m rollwise register --registry ROOT --kind targets|sources --rows FILE.json
    python -m rollwise refresh  --registry ROOT --tables DIR --target NAME
    python -m rollwise backfill --registry ROOT --tables DIR --target NAME --since ISO
    python -m rollwise slide    --registry ROOT --tables DIR --target NAME --days N [--now ISO]
    python -m rollwise status   --registry ROOT --tables DIR [--now ISO]
    python -m rollwise stream   --registry ROOT --tables DIR --target NAME --inbox GLOB --path TABLE
                                [--max-files N]

``refresh`` then ``run-due`` is the hourly pair of the reference's task DAG:
availability first, then every due chunk of the target in one job.
``slide`` then ``run-due`` is the sliding-range pair (redo the last N days);
``backfill`` resets processed so the next ``run-due`` redoes a period.
``preview`` lists every due chunk with each source's decision and row count.
``register`` reads registry rows (JSON lines; lists of names as JSON text),
``chunk --mode test`` tries the sources under test, ``enable`` sets the flag of
sources (null parks them).  Without ``--tables``, sources are session-catalog
tables.
"""

from __future__ import annotations

import argparse
import datetime as dt

from .plans.workflow import Registry
from .session import get_spark
from .sources.catalog import Catalog


def registration_schema(kind: str):
    """Registry rows as registered: no id, lists of names as JSON text."""
    from pyspark.sql import types as T
    from .specs import SOURCES_SCHEMA, TARGETS_SCHEMA
    lists = ("pattern_columns", "groupby_columns", "aggregate_columns", "aggregate_functions")
    fields = [T.StructField(f.name, T.StringType() if f.name in lists else f.dataType)
              for f in (TARGETS_SCHEMA if kind == "targets" else SOURCES_SCHEMA)
              if f.name not in ("id", "groupby_pattern")]
    return T.StructType(fields + ([T.StructField("groupby_flags", T.StringType())] if kind == "targets" else []))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="rollwise")
    ap.add_argument("command", choices=["run-due", "refresh", "backfill", "slide", "stream",
                                        "status", "preview", "chunk", "enable", "register"])
    ap.add_argument("--inbox", help="files arriving for the target's source (stream)")
    ap.add_argument("--max-files", type=int, help="files per micro-batch (stream)")
    ap.add_argument("--since", help="ISO time processed is reset to (backfill)")
    ap.add_argument("--days", type=int, help="days to redo on every run (slide)")
    ap.add_argument("--registry", required=True)
    ap.add_argument("--tables", help="folder of <name>.parquet sources (default: the session catalog)")
    ap.add_argument("--at", help="ISO start of the chunk (chunk)")
    ap.add_argument("--mode", choices=["enabled", "test"], default="enabled", help="sources to run (chunk)")
    ap.add_argument("--value", choices=["true", "false", "null"], help="live, under test or parked (enable)")
    ap.add_argument("--sources", help="source tables, by comma (enable; default: all of the target)")
    ap.add_argument("--kind", choices=["targets", "sources"], help="what to register")
    ap.add_argument("--rows", help="JSON lines of registry rows (register)")
    ap.add_argument("--target", help="target table (all commands but status)")
    ap.add_argument("--path", help="target table folder (run-due)")
    ap.add_argument("--now", help="ISO time (default: current UTC time)")
    ap.add_argument("--dry-run", action="store_true")
    ap.add_argument("--complete-only", action="store_true", help="only chunks that have ended (run-due)")
    ap.add_argument("--capped", action="store_true", help="only chunks all live sources cover (run-due)")
    ap.add_argument("--max-chunks", type=int, help="chunks per job (slices a long backfill)")
    a = ap.parse_args(argv)
    spark = get_spark()
    reg, cat = Registry(spark, a.registry), Catalog(spark, a.tables)
    now = (dt.datetime.fromisoformat(a.now) if a.now
           else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    if a.command == "status":
        # Registry-wide dry run: every due target with its chunk range.
        from pyspark.sql import functions as F
        from .plans import registry as R
        due = R.due_targets(reg.targets(), now)
        n = F.when(F.col("batch_loop_begin") <= F.col("batch_loop_end"),
                   F.floor(F.timestamp_diff("MINUTE", F.col("batch_loop_begin"),
                                            F.col("batch_loop_end"))
                           / F.col("batch_control_size")) + 1).otherwise(0)
        rows = due.select("target_table", "batch_schedule_type", "batch_loop_begin", "batch_loop_end",
                          n.cast("bigint").alias("chunks")).orderBy("target_table")
        print("|" + "|".join(rows.columns) + "|")
        for row in rows.toLocalIterator():  # every due target
            print("|" + "|".join(map(str, row)) + "|")
        return 0
    if a.command == "register":
        schema = registration_schema(a.kind)
        rows = spark.read.schema(schema).json(a.rows)
        (reg.register_targets if a.kind == "targets" else reg.register_sources)(rows)
        return 0
    if not a.target:
        ap.error("--target is required")
    if a.command == "enable":
        value = {"true": True, "false": False, "null": None}[a.value]
        reg.set_enabled(a.target, a.sources.split(",") if a.sources else None, value)
        return 0
    if a.command == "preview":
        from .plans.incremental import preview_range
        rows = preview_range(cat, reg.target_spec(a.target), reg.source_specs(a.target), now,
                             complete_only=a.complete_only, capped=a.capped).orderBy("chunk_start", "source_table")
        print("|" + "|".join(rows.columns) + "|")
        for row in rows.toLocalIterator():
            print("|" + "|".join(map(str, row)) + "|")
        return 0
    if a.command == "chunk":
        frame = reg.aggregate_chunk(cat, a.target, dt.datetime.fromisoformat(a.at), a.path,
                                    script_only=a.dry_run, mode=a.mode)
        print(f"rows {0 if frame is None else frame.count()}")
        return 0
    if a.command == "refresh":
        reg.refresh_availability(cat, a.target)
        return 0
    if a.command == "backfill":
        reg.backfill(a.target, dt.datetime.fromisoformat(a.since))
        return 0
    if a.command == "stream":
        reg.stream(cat, a.target, a.inbox, a.path, max_files=a.max_files)
        return 0
    if a.command == "slide":
        today = now.replace(hour=0, minute=0, second=0, microsecond=0)
        reg.set_availability(a.target, today - dt.timedelta(days=a.days))
        return 0
    res = reg.aggregate_due(cat, a.target, now, a.path, script_only=a.dry_run,
                            max_chunks=a.max_chunks, complete_only=a.complete_only, capped=a.capped)
    if res is None:
        print("not due: the previous run still holds the lock")
    else:
        print(f"chunks {res.chunks}: {res.begin} .. {res.end}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
