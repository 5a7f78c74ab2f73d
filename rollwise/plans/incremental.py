"""Incremental processing: one chunk, a range of chunks in one job, previews.

The warehouse procedure looped over chunks on the driver, issuing a purge
and one MERGE per source for each.  Here a whole range is one Spark job: the
range predicate selects the rows, the target's own time column (which every
valid spec keeps, Q4) separates the chunks inside the grouping, and the
touched partitions are replaced in one write.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from ..functions.timegrid import ts_lit
from ..operators.aggregate import (SourcePlan, aggregate_frame, aggregate_union,
                                   combine_sources, in_chunk, in_range, plan_source,
                                   projected_frame, require_control, time_col)
from ..operators.upsert import purge, upsert
from ..sources.catalog import Catalog, resolve_source
from ..sources.zones import ZoneMap
from ..specs import SourceSpec, TargetSpec


def select_sources(sources: list[SourceSpec], target: TargetSpec,
                   mode: str = "enabled") -> list[SourceSpec]:
    """Sources of ``target`` by enabled flag.

    ``enabled``: live sources (``= True``, P7).  ``test``: ``!= True`` under
    three-valued logic, i.e. exactly the ``False`` ones; parked (NULL) never
    run (P8, Q6)."""
    out = []
    for s in sources:
        if s.target_table != target.target_table:
            continue
        if mode == "enabled" and s.enabled is True:
            out.append(s)
        elif mode == "test" and s.enabled is False:
            out.append(s)
    return out


@dataclass
class Batch:
    frame: DataFrame | None              # aggregated rows in target column names
    plans: list[SourcePlan]              # every source, accepted or not
    parts: list[tuple[SourcePlan, DataFrame]]
    # Set by ``range_batch``: every row's target control value lies in
    # [begin, end_excl).  None for one-chunk batches filtered on raw time.
    aligned: tuple[dt.datetime, dt.datetime] | None = None

    @property
    def keys(self) -> list[str]:
        seen = []
        for p, _ in self.parts:
            for k in p.keys:
                if k not in seen:
                    seen.append(k)
        return seen


def _combine(target: TargetSpec, parts: list[tuple[SourcePlan, DataFrame]],
             plans: list[SourcePlan], projected: dict | None = None) -> Batch:
    if not parts:
        return Batch(None, plans, parts)
    b = Batch(None, plans, parts)
    measures = target.measures[0]
    # Priority first, then position: ranks keep that order for any number of sources.
    order = sorted(range(len(parts)), key=lambda i: (parts[i][0].source.priority, i))
    ranks = {i: r for r, i in enumerate(order)}
    if len(parts) > 1 and target.source_dim and all(target.source_dim in p.keys
                                                    for p, _ in parts):
        # Each source should have its own values of the source dim: the union
        # of their rows is aggregated once, one shuffle for all sources.
        b.frame = aggregate_union([(ranks[i], projected[id(p)]) for i, (p, _) in enumerate(parts)], target, b.keys)
        return b
    b.frame = combine_sources([(ranks[i], df) for i, (_, df) in enumerate(parts)],
                              b.keys, measures)
    return b


def chunk_batch(catalog: Catalog, target: TargetSpec, sources: list[SourceSpec],
                start: dt.datetime, mode: str = "enabled", minutes: int | None = None) -> Batch:
    """Aggregate one chunk ``[start, step(start, size))`` of every selected
    source (I1, I2).  Like the warehouse procedure, each source is filtered
    on its own control column (raw time)."""
    minutes = minutes or target.chunk_minutes
    plans, parts, projected = [], [], {}
    for s in select_sources(sources, target, mode):
        plan = plan_source(target, s)
        plans.append(plan)
        if not plan.accepted:
            continue  # granularity gate: a finer target cannot take a coarser source
        df = resolve_source(catalog, s)
        ctl = s.control_column or target.control_column
        if ctl not in df.columns:  # the source names it only through the mapping
            ctl = target.source_of(target.control_column)
        df = df.where(in_chunk(time_col(df, ctl), start, minutes, target.step, catalog.spark))
        parts.append((plan, aggregate_frame(df, target, plan)))
        projected[id(plan)] = projected_frame(df, target, plan)
    return _combine(target, parts, plans, projected)


def chunk_starts(begin: dt.datetime, end: dt.datetime, minutes: int) -> tuple[int, dt.datetime]:
    """Number of chunks ``begin, begin + size, ... <= end`` and the exclusive end."""
    if begin > end:
        return 0, begin
    n = int((end - begin) // dt.timedelta(minutes=minutes)) + 1
    return n, begin + dt.timedelta(minutes=minutes * n)


def range_batch(catalog: Catalog, target: TargetSpec, sources: list[SourceSpec],
                begin: dt.datetime, end: dt.datetime, mode: str = "enabled",
                zones: ZoneMap | None = None) -> Batch:
    """Aggregate every chunk ``begin, begin + size, ... <= end`` in one job.

    Rows are assigned to chunks by the source column that becomes the target's
    control column, so filter, key and later purge agree (fixes Q1).  A source
    whose mask covers that column is refused.  With ``zones`` only the files
    whose control times meet the range are read."""
    target.validate()  # chunks are assigned by the control column, which must be kept
    n, end_excl = chunk_starts(begin, end, target.chunk_minutes)
    _check_additive_step(catalog.spark, target, begin)
    plans, parts, projected = [], [], {}
    for s in select_sources(sources, target, mode):
        plan = plan_source(target, s)
        plans.append(plan)
        if not plan.accepted or n == 0:
            continue
        require_control(target, plan)
        view, offsets = catalog, None
        if zones is not None:
            found = zones.narrowed(catalog, target, s, begin, end_excl)
            view, offsets = found.catalog, found.offsets
        df = in_range(resolve_source(view, s), target, s, begin, end_excl, offsets)
        parts.append((plan, aggregate_frame(df, target, plan)))
        projected[id(plan)] = projected_frame(df, target, plan)
    batch = _combine(target, parts, plans, projected)
    batch.aligned = (begin, end_excl)
    return batch


def _check_additive_step(spark, target: TargetSpec, begin: dt.datetime) -> None:
    """A range job steps chunks by ``+size`` minutes (as the warehouse loop
    did); a custom step expression must agree, or chunk edges would move."""
    from ..operators.aggregate import _DEFAULT_STEPS, step_end
    import re as _re
    if callable(target.step) or _re.sub(r"\s+", "", target.step).lower() in _DEFAULT_STEPS:
        return
    got = spark.range(1).select(step_end(target.step, begin, target.chunk_minutes, spark)
                                .alias("e")).first()["e"]
    if got != begin + dt.timedelta(minutes=target.chunk_minutes):
        raise ValueError(f"step {target.step!r} is not +{target.chunk_minutes} minutes; "
                         "a range job needs an additive step")


def replace_batch(existing: DataFrame, target: TargetSpec, batch: Batch,
                  begin: dt.datetime, end_excl: dt.datetime) -> DataFrame:
    """New content of the touched range: purge ``[begin, end_excl)`` on the
    target control column, then upsert the batch (M5 over a range)."""
    minutes = int((end_excl - begin) // dt.timedelta(minutes=1))
    kept = purge(existing, target.control_column, begin, minutes)
    if batch.frame is None:
        return kept
    if batch.aligned is not None and begin <= batch.aligned[0] and batch.aligned[1] <= end_excl:
        # Every batch row's control value lies inside the purged range and the
        # control column is part of the key, so no kept row can match a batch
        # row: the upsert is a plain union (no join, no shuffle).
        from ..operators.tables import conform
        from pyspark.sql import types as T
        schema = T.StructType([existing.schema[c] for c in existing.columns])
        return kept.unionByName(conform(batch.frame, schema))
    return upsert(kept, batch.frame, batch.keys, target.measures[0])


def preview(batch: Batch, spark) -> DataFrame:
    """Dry run (S9): what each source would load, without writing.

    One row per selected source: effective mask, gate result, kept dims and
    the number of target rows it would upsert (a lazy count over its part).
    Rejected sources report 0 rows, as the warehouse loaded nothing for them."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("source_table", T.StringType()),
                           T.StructField("effective_mask", T.LongType()),
                           T.StructField("accepted", T.BooleanType()),
                           T.StructField("kept_dims", T.StringType()),
                           T.StructField("n_groups", T.LongType())])
    parts = {id(p): df for p, df in batch.parts}
    rows = None
    for p in batch.plans:
        meta = [F.lit(p.source.source_table).alias("source_table"),
                F.lit(int(p.effective_mask)).cast("bigint").alias("effective_mask"),
                F.lit(bool(p.accepted)).alias("accepted"),
                F.lit(",".join(p.keys)).alias("kept_dims")]
        if id(p) in parts:
            r = parts[id(p)].agg(F.count(F.lit(1)).alias("n_groups")).select(*meta, "n_groups")
        else:
            r = spark.createDataFrame([(p.source.source_table, int(p.effective_mask),
                                        bool(p.accepted), ",".join(p.keys), 0)], schema)
        rows = r if rows is None else rows.unionByName(r)
    return rows if rows is not None else spark.createDataFrame([], schema)


def preview_range(catalog: Catalog, target: TargetSpec, sources: list[SourceSpec],
                  now: dt.datetime, mode: str = "enabled", complete_only: bool = False,
                  capped: bool = False) -> DataFrame:
    """Dry run of a due range (S9): every chunk with every source's decision and
    the source rows it would read; nothing is written.

    One row per chunk and selected source: effective mask, whether the gate
    accepts the source, rows of the chunk (0 for a rejected one).  The counts
    of all sources and chunks come from one aggregate."""
    spark, size = catalog.spark, int(target.chunk_minutes)
    begin, end = plan_bounds(target, now)
    chosen = select_sources(sources, target, mode)
    n, end_excl = chunk_starts(begin, hold_back(target, chosen, now, end, complete_only, capped), size)
    plans = [plan_source(target, s) for s in chosen]
    decisions = F.array(*[F.struct(F.lit(p.source.source_table).alias("source_table"),
                                   F.lit(int(p.effective_mask)).cast("bigint").alias("effective_mask"),
                                   F.lit(p.accepted).alias("accepted")) for p in plans]).cast(
        "array<struct<source_table:string,effective_mask:bigint,accepted:boolean>>")
    chunks = spark.range(n).select(F.lit(target.target_table).alias("target_table"), F.col("id").alias("_k"), F.timestamp_add(
        "MINUTE", (F.col("id") * size).cast("int"), ts_lit(begin)).alias("chunk_start"))
    rows = chunks.select("target_table", "_k", "chunk_start", F.inline(decisions))
    seen = spark.createDataFrame([], "source_table string, _k bigint")
    for p in plans:
        if p.accepted and n:
            require_control(target, p)
            df = in_range(resolve_source(catalog, p.source), target, p.source, begin, end_excl)
            at = F.timestamp_diff("MICROSECOND", ts_lit(begin), time_col(df, target.source_of(target.control_column)))
            width = F.lit(size * 60_000_000)
            seen = seen.unionByName(df.select(F.lit(p.source.source_table).alias("source_table"),
                                              ((at - F.pmod(at, width)) / width).cast("bigint").alias("_k")))
    counts = seen.groupBy("source_table", "_k").agg(F.count("*").alias("n_rows"))
    return rows.join(counts, ["source_table", "_k"], "left").select(
        "target_table", "chunk_start", "source_table", "effective_mask", "accepted",
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"))


def plan_bounds(target: TargetSpec, now: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """Chunk range of one target (the single-spec form of ``registry.loop_bounds``)."""
    size = int(target.chunk_minutes)
    step = {"MINUTES": size, "HOURLY": 60}.get(target.schedule_type, 1440)
    begin = target.batch_processed + dt.timedelta(minutes=step)
    if target.schedule_type == "HOURLY":
        end = now.replace(minute=0, second=0, microsecond=0)
    elif target.schedule_type == "DAILY":
        end = now.replace(hour=0, minute=0, second=0, microsecond=0)
    else:
        minutes = int((now.replace(second=0, microsecond=0) - dt.datetime(1970, 1, 1))
                      // dt.timedelta(minutes=1))
        end = dt.datetime(1970, 1, 1) + dt.timedelta(minutes=(minutes // size) * size)
    return begin, end


def is_due(target: TargetSpec, now: dt.datetime) -> bool:
    """I6 for one target."""
    if target.batch_processing is None:
        return True
    if target.batch_schedule_last is None:
        return False
    _, end = plan_bounds(target, now)
    last = target.batch_schedule_last.replace(second=0, microsecond=0)
    return (end.replace(second=0, microsecond=0) - last) // dt.timedelta(minutes=1) \
        > target.chunk_minutes


@dataclass
class RunResult:
    ran: bool
    begin: dt.datetime | None = None
    end: dt.datetime | None = None
    chunks: int = 0
    written: DataFrame | None = None


def run_target(catalog: Catalog, target: TargetSpec, sources: list[SourceSpec],
               now: dt.datetime, path: str, script_only: bool = False,
               lookback_days: int | None = None, max_chunks: int | None = None,
               on_progress=None, zones: ZoneMap | None = None,
               complete_only: bool = False, capped: bool = False) -> RunResult:
    """Run every due chunk of one target.

    The touched days of the target are replaced by the recomputed batch and
    the stored rows outside the chunk range (which only its first and last day
    can hold); days without rows any more are removed, so a rerun gives the
    same table.  ``lookback_days``
    redoes the last N days each run (sliding range).  ``max_chunks`` caps
    the chunks per job: a long backfill runs as consecutive slices, each
    written before the next, and ``on_progress(target)`` is called after each
    slice with ``batch_microchunk_current`` set to the slice's last chunk (the
    warehouse's progress update), so a failure redoes one slice only.  With
    ``script_only`` nothing is written and the new content is returned lazily
    (dry run; one slice) and ``target`` stays as it is.

    ``zones`` (default: beside ``path``) tells which files of a source hold
    which control times; a run first adds the files that are new.

    ``complete_only`` leaves out chunks that have not ended by ``now``, ``capped``
    those beyond the earliest availability of the live sources; processed then
    moves to the last chunk run, so what was left out comes later."""
    target.validate()
    if script_only:
        target = replace(target)
    if lookback_days is not None:
        today = now.replace(hour=0, minute=0, second=0, microsecond=0)
        target.batch_processed = today - dt.timedelta(days=lookback_days) \
            - dt.timedelta(minutes={"MINUTES": target.chunk_minutes, "HOURLY": 60}
                           .get(target.schedule_type, 1440))
        target.batch_processing = None
    if not is_due(target, now):
        return RunResult(False)
    begin, end = plan_bounds(target, now)
    live = select_sources(sources, target)
    held = complete_only or capped
    end = hold_back(target, live, now, end, complete_only, capped)
    n, _ = chunk_starts(begin, end, target.chunk_minutes)
    if n == 0:
        return RunResult(True, begin, end, 0)
    if not live:  # nothing to load (Q13): write nothing, but release the lock
        if not script_only:
            finish_run(target, live, now)
        return RunResult(True, begin, end, n, None)
    zones = zones or ZoneMap(catalog.spark, f"{path.rstrip('/')}.zones")
    if not script_only:
        for s in live:
            zones.refresh(catalog, target, s)
    step = dt.timedelta(minutes=target.chunk_minutes)
    per_job = n if (script_only or not max_chunks) else max(1, int(max_chunks))
    new = None
    for k in range(0, n, per_job):
        s_begin = begin + step * k
        s_end = begin + step * (min(n, k + per_job) - 1)
        new = _replace_range(catalog, target, sources, live, s_begin, s_end, path, script_only, zones)
        if not script_only:
            target.batch_microchunk_current = s_end
            if on_progress is not None:
                on_progress(target)
    if not script_only:
        # Only after every write succeeded (Q9).
        finish_run(target, live, now, begin + step * (n - 1) if held else None)
    return RunResult(True, begin, end, n, new)


def _replace_range(catalog: Catalog, target: TargetSpec, sources: list[SourceSpec],
                   live: list[SourceSpec], begin: dt.datetime, end: dt.datetime, path: str,
                   script_only: bool, zones: ZoneMap) -> DataFrame:
    """One job: recompute chunks ``begin .. end`` and replace them in ``path``."""
    from ..operators.tables import (days_between, enforce_not_null, read_days,
                                    replace_days, target_schema)
    _, end_excl = chunk_starts(begin, end, target.chunk_minutes)
    batch = range_batch(catalog, target, sources, begin, end, zones=zones)
    schema = target_schema(target, resolve_source(catalog, live[0]))
    days = days_between(begin.date(), (end_excl - dt.timedelta(microseconds=1)).date())
    midnight = dt.time()
    edges = {begin.date()} if begin.time() != midnight else set()
    if end_excl.time() != midnight:
        edges.add(end_excl.date())
    minutes = int((end_excl - begin) // dt.timedelta(minutes=1))
    kept = purge(read_days(catalog.spark, path, schema, sorted(edges)), target.control_column,
                 begin, minutes)
    if edges and not script_only:
        # These rows come from files about to be replaced: cut the lineage
        # first, so a retried task never reads a half-replaced day.
        kept = kept.checkpoint(eager=True)
    new = kept if batch.frame is None else replace_batch(kept, target, batch, begin, end_excl)
    if target.not_null:  # the target's NOT NULL columns, checked in the write stage
        new = enforce_not_null(new, [c for c in target.not_null if c in new.columns])
    if not script_only:
        replace_days(new, path, target.control_column, days)
    return new


def hold_back(target: TargetSpec, live: list[SourceSpec], now: dt.datetime, end: dt.datetime,
              complete_only: bool, capped: bool) -> dt.datetime:
    """The single-spec form of ``registry.covered_bounds``."""
    if complete_only:
        end = min(end, now - dt.timedelta(minutes=target.chunk_minutes))
    if capped:
        end = min([end, *[s.data_availabletime or target.batch_processed for s in live]])
    return end


def finish_run(target: TargetSpec, live: list[SourceSpec], now: dt.datetime,
               last: dt.datetime | None = None) -> None:
    """State after a successful run of one target (I7, I8): processed moves to
    the earliest availability of its live sources (a source without one holds
    it at the old value), but not beyond ``last`` (the last chunk of a run
    that left some out); the lock and the current chunk are cleared."""
    if live:
        target.batch_processed = min(s.data_availabletime or target.batch_processed
                                     for s in live)
        if last is not None:
            target.batch_processed = min(target.batch_processed, last)
    target.batch_processing = None
    target.batch_microchunk_current = None
    target.batch_schedule_last = now
