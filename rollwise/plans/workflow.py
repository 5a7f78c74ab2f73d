"""A persisted registry and the run procedures on top of it.

The registry is two parquet tables (targets, sources) under a root folder in
shared storage.  Every change writes a new snapshot folder (``v000001``,
``v000002``, ...) and readers take the newest one, so a change never
overwrites files that a running job may still read.  A snapshot is written
aside and renamed to the version after the one it was made from; the rename
does not overwrite, so of two writers one wins and the other makes its change
again on the winner's rows (optimistic concurrency).  Registry
tables hold metadata (one row per target or source; a target has a handful
of sources, each a branch of its job), so reading one target's rows onto the
driver is bounded.

Procedures:

* ``register_targets`` / ``register_sources``: upsert by natural key,
  new rows get the next ids (M2, M3, S8).
* ``set_enabled``: live (True), under test (False), parked (NULL) (M6).
* ``aggregate_chunk``: one chunk of the live or under-test sources, upserted
  into the target table (I1, I2); ``script_only`` returns it unwritten.
* ``aggregate_due``: all due chunks in one job; the lock is committed before
  the job and the watermark only after the write (I3, I6, I7, I8).
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.aggregate import require_control
from ..operators.tables import conform, enforce_not_null, read_days, replace_days, target_schema
from ..operators.upsert import update_where, upsert, upsert_registry
from ..sources.catalog import Catalog
from ..sources.zones import ZoneMap
from ..specs import SOURCES_SCHEMA, TARGETS_SCHEMA, SourceSpec, target_from_row
from . import registry as R
from .incremental import chunk_batch, finish_run, run_target

_VERSION = re.compile(r"v(\d{6})$")


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---- snapshots ---------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, kind: str) -> list[int]:
        """Every snapshot folder's version number, committed or not."""
        p, fs = self._fs(f"{self.root}/{kind}")
        if not fs.exists(p):
            return []
        return [int(m.group(1)) for st in fs.listStatus(p)
                if (m := _VERSION.search(st.getPath().getName()))]

    def _latest(self, kind: str) -> int:
        """The newest committed snapshot (its ``_SUCCESS`` marker exists).
        Versions are tried from the newest down, so a read costs one check
        unless a writer was lost."""
        _, fs = self._fs(self.root)
        for v in sorted(self._versions(kind), reverse=True):
            if fs.exists(self._fs(f"{self.root}/{kind}/v{v:06d}/_SUCCESS")[0]):
                return v
        return 0

    def _at(self, kind: str, v: int, schema) -> DataFrame:
        if v == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{kind}/v{v:06d}")

    def _read(self, kind: str, schema) -> DataFrame:
        return self._at(kind, self._latest(kind), schema)

    def _change(self, kind: str, schema, change: Callable[[DataFrame], DataFrame | None]) -> bool:
        """Commit ``change(rows)`` as the next snapshot after the one it read.
        When another writer was first, the change is made again on that
        writer's rows, so neither is lost.  None from ``change``: no commit."""
        while True:
            read = self._latest(kind)
            df = change(self._at(kind, read, schema))
            if df is None:
                return False
            staged = f"{self.root}/{kind}/_new-{uuid.uuid4().hex}"
            conform(df, schema).write.parquet(staged)
            if self._publish(kind, staged, read):
                return True

    def _publish(self, kind: str, staged: str, read: int) -> bool:
        """Rename a complete snapshot to the version after ``read``; False if
        that one exists.  The rename does not overwrite, so one of two writers
        that read the same version wins.  A folder without its marker (a lost
        writer's) is stepped over."""
        jvm = self.spark.sparkContext._jvm
        src, fs = self._fs(staged)
        taken, v = set(self._versions(kind)), read + 1
        while v in taken and not fs.exists(self._fs(f"{self.root}/{kind}/v{v:06d}/_SUCCESS")[0]):
            v += 1
        dst = self._fs(f"{self.root}/{kind}/v{v:06d}")[0]
        keep = self.spark.sparkContext._gateway.new_array(
            getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            if v not in taken:
                files.rename(fs.makeQualified(src), fs.makeQualified(dst), keep)
                return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
        fs.delete(src, True)
        return False

    def targets(self) -> DataFrame:
        return self._read("targets", TARGETS_SCHEMA)

    def sources(self) -> DataFrame:
        return self._read("sources", SOURCES_SCHEMA)

    # ---- registration ------------------------------------------------------------

    def register_targets(self, incoming: DataFrame) -> None:
        """Upsert target rows by ``target_table``.  Text columns holding JSON
        arrays (and an optional ``groupby_flags``) are parsed first."""
        if dict(incoming.dtypes).get("pattern_columns") == "string":
            incoming = R.parse_registry_text(incoming)
        self._change("targets", TARGETS_SCHEMA,
                     lambda rows: upsert_registry(rows, incoming, ["target_table"]))

    def register_sources(self, incoming: DataFrame) -> None:
        self._change("sources", SOURCES_SCHEMA, lambda rows: upsert_registry(
            rows, incoming, ["target_table", "source_table"]))

    def register_specs(self, targets=(), sources=()) -> None:
        """Register ``TargetSpec`` / ``SourceSpec`` objects (Python form of the
        registry rows).  A source's transformation is stored only as SQL text."""
        from pyspark.sql import types as T
        from ..specs import source_row, target_row

        def nullable(schema):  # ids are assigned on registration
            return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
        if targets:
            df = self.spark.createDataFrame([target_row(t) for t in targets],
                                            nullable(TARGETS_SCHEMA))
            self.register_targets(df.drop("id"))
        if sources:
            df = self.spark.createDataFrame([source_row(s) for s in sources],
                                            nullable(SOURCES_SCHEMA))
            self.register_sources(df.drop("id"))

    def set_enabled(self, target_table: str, source_tables: list[str] | None,
                    value: bool | None) -> None:
        pred = F.col("target_table") == F.lit(target_table)
        if source_tables is not None:
            pred = pred & F.col("source_table").isin(*source_tables)
        self._change("sources", SOURCES_SCHEMA, lambda rows: R.set_enabled(rows, value, pred))

    def refresh_availability(self, catalog: Catalog, name: str) -> None:
        """Availability refresh (I9): each source of ``name`` gets the newest
        control time of its data, floored to the target's chunk grid.  It comes
        from the source's zone map, so only files that are new are scanned; a
        source without a map is scanned for its maximum."""
        from ..operators.aggregate import time_col
        from ..sources.catalog import resolve_source
        target, zones = self.target_spec(name), self.zones(name)
        ctl = target.source_of(target.control_column)
        latest = None
        for s in self.source_specs(name):
            m = zones.latest(catalog, target, s) if zones.refresh(catalog, target, s) else None
            if m is None:
                df = resolve_source(catalog, s)
                t = time_col(df, ctl)
                if s.data_availabletime is not None:  # only later data can move it
                    df = df.where(t >= F.lit(s.data_availabletime).cast("timestamp_ntz"))
                m = df.agg(F.max(t).alias("latest_ts"))
            m = m.select(F.lit(s.source_table).alias("source_table"), "latest_ts")
            latest = m if latest is None else latest.unionByName(m)
        if latest is None:
            return
        latest = latest.where(F.col("latest_ts").isNotNull())
        self._change("sources", SOURCES_SCHEMA,
                     lambda rows: R.source_availability(rows, latest, self.targets()))

    def backfill(self, name: str, processed: dt.datetime) -> None:
        """Backfill reset (I11): processed set back, lock cleared; the next
        ``aggregate_due`` redoes everything after ``processed``."""
        self._change("targets", TARGETS_SCHEMA, lambda rows: R.backfill(rows, name, processed))

    def set_availability(self, name: str, value: dt.datetime,
                         source_tables: list[str] | None = None) -> None:
        """Set the sources' availability by hand.  Setting it to ``today - N
        days`` before every run gives the sliding range (I10): each run ends
        with processed there, so the next run redoes the last N days."""
        pred = F.col("target_table") == F.lit(name)
        if source_tables is not None:
            pred = pred & F.col("source_table").isin(*source_tables)
        self._change("sources", SOURCES_SCHEMA, lambda rows: update_where(rows, pred, {
            "data_availabletime": F.lit(value).cast("timestamp_ntz")}))

    def stream(self, catalog: Catalog, name: str, inbox: str, path: str,
               max_files: int | None = None, available_now: bool = True):
        """Continuous load of ``name`` from files arriving in ``inbox`` (I12),
        for its live source.  The stream's checkpoint lives under the registry
        root, so each scheduled run resumes after the last processed file."""
        from ..sources.catalog import resolve_source
        from ..streaming.continuous import run_stream
        target = self.target_spec(name)
        live = [s for s in self.source_specs(name) if s.enabled is True]
        if len(live) != 1:
            raise ValueError(f"streaming needs exactly one live source, {name!r} has {len(live)}")
        src = live[0]
        schema = catalog.table(src.source_table).schema
        q = run_stream(self.spark, inbox, schema, target, src,
                       lambda: resolve_source(catalog, src), path, f"{self.root}/streams/{name}", available_now=available_now,
                       max_files=max_files)
        if available_now:
            q.awaitTermination()
        return q

    def zones(self, name: str) -> ZoneMap:
        """Zone maps of the sources of ``name``, kept with the registry."""
        return ZoneMap(self.spark, f"{self.root}/zones/{name}")

    # ---- one target's specs (bounded metadata) -------------------------------------

    def target_spec(self, name: str):
        rows = self.targets().where(F.col("target_table") == name).collect()
        if not rows:
            raise KeyError(f"unknown target {name!r}")
        return target_from_row(rows[0])

    def source_specs(self, name: str) -> list[SourceSpec]:
        rows = self.sources().where(F.col("target_table") == name).orderBy("id").collect()
        return [SourceSpec(target_table=r.target_table, source_table=r.source_table,
                           enabled=r.source_enabled, pattern_default=r.pattern_default or 0,
                           transformation=r.transformation, label=r.source_label, id=r.id,
                           priority=int(r.id or 0) if r.priority is None else int(r.priority),
                           data_availabletime=r.data_availabletime,
                           control_column=r.control_column)
                for r in rows]

    # ---- procedures ----------------------------------------------------------------

    def aggregate_chunk(self, catalog: Catalog, name: str, timetag: dt.datetime, path: str,
                        script_only: bool = False, mode: str = "enabled") -> DataFrame | None:
        """One chunk of the live (``enabled``) or under-test (``test``) sources,
        upserted into the target table.  Returns the batch."""
        target = self.target_spec(name)
        batch = chunk_batch(catalog, target, self.source_specs(name), timetag, mode=mode)
        if batch.frame is None or script_only:
            return batch.frame
        for plan, _ in batch.parts:
            require_control(target, plan)
        schema = target_schema(target, _unified(catalog, self.source_specs(name)))
        # The days come from the batch's own control values: a step expression
        # or an alignment may put them outside the day of ``timetag``.
        frame = batch.frame.checkpoint(eager=True)
        days = [d for (d,) in frame.select(F.to_date(target.control_column)).distinct().collect()]
        old = read_days(self.spark, path, schema, days).checkpoint(eager=True)
        new = upsert(old, frame, batch.keys, target.measures[0])
        if target.not_null:
            new = enforce_not_null(new, [c for c in target.not_null if c in new.columns])
        replace_days(new, path, target.control_column, [])  # an upsert empties no day
        return frame

    def aggregate_due(self, catalog: Catalog, name: str, now: dt.datetime, path: str,
                      script_only: bool = False, max_chunks: int | None = None,
                      complete_only: bool = False, capped: bool = False):
        """Every due chunk of one target in one job.  Lock (processing = end,
        last schedule = now) is committed first; processed advances after the
        write (a failed job leaves the lock, and the target is retried once
        the lock is stale)."""
        def locked(rows: DataFrame) -> DataFrame | None:
            due = R.due_targets(rows.where(F.col("target_table") == name), now)
            return None if due.limit(1).count() == 0 else R.start_run(rows, due, now)

        if locked(self.targets()) is None:
            return None
        spec = self.target_spec(name)  # a spec that cannot run takes no lock
        spec.validate()
        if spec.batch_processed is None:
            raise ValueError(f"target {name!r} has no batch_processed to start from")
        if not script_only and not self._change("targets", TARGETS_SCHEMA, locked):
            return None  # another scheduler took it meanwhile
        spec = self.target_spec(name)
        spec.batch_processing = None  # the lock is ours
        sources = self.source_specs(name)
        def progress(t):  # I7 progress: the last chunk written, committed per slice
            self._change("targets", TARGETS_SCHEMA, lambda rows: update_where(
                rows, F.col("target_table") == F.lit(name),
                {"batch_microchunk_current": F.lit(t.batch_microchunk_current)
                 .cast("timestamp_ntz")}))

        result = run_target(catalog, spec, sources, now, path, script_only=script_only,
                            max_chunks=max_chunks, on_progress=progress, zones=self.zones(name),
                            complete_only=complete_only, capped=capped)
        if not script_only:
            if result.chunks == 0 and not (complete_only or capped):
                finish_run(spec, [s for s in sources if s.enabled is True], now)
            self._change("targets", TARGETS_SCHEMA, lambda rows: update_where(rows, F.col("target_table") == F.lit(name), {
                "batch_processed": F.lit(spec.batch_processed).cast("timestamp_ntz"),
                "batch_processing": F.lit(None).cast("timestamp_ntz"),
                "batch_microchunk_current": F.lit(None).cast("timestamp_ntz")}))
        return result


def _unified(catalog: Catalog, sources: list[SourceSpec]) -> DataFrame:
    """One source relation, for the target schema (analysis only, no job)."""
    from ..sources.catalog import resolve_source
    live = [s for s in sources if s.transformation is not None] or sources
    return resolve_source(catalog, live[0])
