"""Continuous load (I12): new source files are summarised as they arrive.

The warehouse polled on a schedule.  Here a Structured Streaming file source
feeds ``foreachBatch``; each micro-batch only tells *which chunks* changed.
Those chunks are then recomputed from the whole source (so late rows and
non-additive aggregates such as COUNT DISTINCT and AVG stay exact) and
replace their rows in the target: the touched days are rewritten with
dynamic partition overwrite.  The checkpoint makes a restart resume at the
first unprocessed file; a re-run micro-batch recomputes the same chunks, so
the sink is idempotent.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.timegrid import EPOCH, floor_minutes
from ..operators.aggregate import aggregate_frame, in_range, plan_source, require_control, time_col
from ..operators.tables import conform, enforce_not_null, read_days, replace_days, target_schema
from ..sources.zones import ZoneMap
from ..specs import SourceSpec, TargetSpec


def _chunk(df: DataFrame, target: TargetSpec) -> DataFrame:
    """Add ``_rw_chunk``: the chunk of each row, on the source column that
    becomes the target's control column (Q1 fix)."""
    ctl = time_col(df, target.source_of(target.control_column))
    return df.withColumn("_rw_chunk", floor_minutes(ctl, target.chunk_minutes, EPOCH))


def refresh_chunks(spark: SparkSession, micro: DataFrame,
                   full: DataFrame | Callable[[DataFrame], DataFrame],
                   target: TargetSpec, source: SourceSpec, path: str) -> None:
    """Recompute the chunks a micro-batch touched and replace them in ``path``.
    ``full`` is the transformed source, or a function of the touched chunks
    (``_rw_chunk``) that gives the part of it that holds them."""
    plan = plan_source(target, source)
    if not plan.accepted:
        return  # granularity gate, as in the scheduled run
    require_control(target, plan)
    touched = _chunk(_transform(micro, source), target).select("_rw_chunk").distinct()
    touched = touched.where("_rw_chunk is not null").checkpoint(eager=True)
    span = touched.agg(F.min("_rw_chunk").alias("lo"), F.max("_rw_chunk").alias("hi")).first()
    if span["lo"] is None:
        return  # an empty micro-batch touches nothing
    if callable(full):
        full = full(touched)
    size = target.chunk_minutes
    rows = _chunk(in_range(full, target, source, span["lo"], span["hi"] + dt.timedelta(minutes=size)),
                  target).join(touched, "_rw_chunk", "left_semi")
    schema = target_schema(target, full)
    batch = conform(aggregate_frame(rows, target, plan), schema)
    # Every day of every touched chunk, its last one included: one value per
    # partition to be rewritten.
    last = F.col("_rw_chunk") + F.make_dt_interval(mins=F.lit(size)) - F.make_dt_interval(secs=F.lit(1e-6))
    days = [d for (d,) in touched.select(F.explode(F.sequence(
        F.to_date("_rw_chunk"), F.to_date(last)))).distinct().collect()]
    old = _chunk(read_days(spark, path, schema, days), _as_target_side(target))
    keep = old.join(touched, "_rw_chunk", "left_anti").select(*schema.names)
    new = keep.unionByName(batch)
    if target.not_null:
        new = enforce_not_null(new, [c for c in target.not_null if c in new.columns])
    # Cut the lineage to the files about to be replaced before overwriting.
    replace_days(new.checkpoint(eager=True), path, target.control_column, days)


class ChunkIndex:
    """Which chunks each file of the inbox holds: rows (file, _rw_chunk), added
    by the micro-batch that brings the file, so no file is read for it twice.
    A micro-batch then reads the files of its chunks, however far apart."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def add(self, micro: DataFrame, target: TargetSpec, source: SourceSpec, epoch: int) -> None:
        """A replayed micro-batch overwrites its own rows."""
        name = F.regexp_replace(F.input_file_name(), "^file:/+", "file:/")  # as in the metadata column
        (_chunk(_transform(micro, source), target).select(name.alias("file"), "_rw_chunk").distinct()
         .write.mode("overwrite").parquet(f"{self.root}/batch-{int(epoch)}"))

    def files(self, touched: DataFrame) -> list[str] | None:
        """The files that hold a touched chunk; None: rows of unknown files
        (made by a shuffle in the transformation), so all must be read."""
        index = self.spark.read.schema("file string, _rw_chunk timestamp_ntz").option(
            "recursiveFileLookup", "true").parquet(self.root)
        found = [r.file for r in index.join(touched, "_rw_chunk", "left_semi").select("file").union(
            index.where("file = ''").select("file").limit(1)).distinct().collect()]
        return None if "" in found else found


def _transform(micro: DataFrame, source: SourceSpec) -> DataFrame:
    """The source's transformation applied to one micro-batch.  SQL text runs
    against the micro-batch registered under the source table's name, in the
    stream's own session (its temp views do not leak into the caller's)."""
    t = source.transformation
    if t is None:
        return micro
    if callable(t):
        return t(micro)
    micro.createOrReplaceTempView(source.source_table)
    return micro.sparkSession.sql(t)


def _as_target_side(target: TargetSpec) -> TargetSpec:
    """The same spec, but reading the control column under its target name
    (rows already in the summary table)."""
    t = TargetSpec(**target.__dict__)
    t.groupby_columns = [f"{c}:{c}" for c in target.dims[0]]
    return t


def file_glob(path: str) -> str:
    """A glob matching exactly one file.  The file stream source needs a
    directory or a glob (a plain file path is refused as ``basePath``)."""
    return path if any(ch in path for ch in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def run_stream(spark: SparkSession, source_glob: str, schema, target: TargetSpec,
               source: SourceSpec, full: DataFrame | Callable[[], DataFrame] | None, path: str,
               checkpoint: str, available_now: bool = True, max_files: int | None = None):
    """Start the continuous load; with ``available_now`` it processes every
    file present and stops (what a scheduler runs each hour).

    ``full`` is the whole source.  None reads the inbox again in each
    micro-batch (with the source's transformation), by an index kept beside the
    checkpoint only the files that hold a touched chunk; a function is called
    in each micro-batch, so files that arrive later are seen.  A DataFrame keeps the
    file list it was made with: give one only for a source that is complete.
    The transformation is applied to each micro-batch (SQL text sees it under
    the source table's name)."""
    files = file_glob(source_glob) if source_glob.endswith(".parquet") else source_glob
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def inbox(session: SparkSession, touched: DataFrame) -> DataFrame:
        base = session.read.schema(schema).parquet(files)
        whole = _transform(base, source)
        held = ChunkIndex(session, f"{checkpoint.rstrip('/')}.chunks").files(touched)
        if held is None or not ZoneMap._read_once(base, whole):
            return whole
        return _transform(base.where(F.col("_metadata.file_path").isin(held) if held else F.lit(False)), source)

    def refresh(micro: DataFrame, epoch: int) -> None:
        session = micro.sparkSession
        if full is not None:
            refresh_chunks(spark, micro, full() if callable(full) else full, target, source, path)
            return
        if plan_source(target, source).accepted:
            ChunkIndex(session, f"{checkpoint.rstrip('/')}.chunks").add(micro, target, source, epoch)
        refresh_chunks(session, micro, lambda touched: inbox(session, touched), target, source, path)

    w = reader.parquet(files).writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
