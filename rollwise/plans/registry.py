"""Registry-wide operators: every target or source row at once.

The warehouse procedures looked at one target per call.  Here the registry
is a DataFrame, so due targets, chunk lists, gates and watermarks are joins
and aggregates over all targets together.  Sources are pre-aggregated per
target before they meet the targets, so a target with a third of all
sources costs one partial-aggregate row per task, not a skewed join task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.pattern import mapping_sources
from ..functions.timegrid import EPOCH, add_minutes, floor_minutes, minute_diff, trunc, ts_lit
from ..operators.upsert import update_from, update_where

CHUNK_BLOCK = 4096  # chunks per generated array; bounds the per-row array size


def _now(now) -> Column:
    return now if isinstance(now, Column) else ts_lit(now)


def effective_sources(targets: DataFrame, sources: DataFrame, mode: str | None = "enabled"
                      ) -> DataFrame:
    """Targets joined with their sources (J1), with the effective mask
    and the granularity gate (G9).

    ``mode``: ``enabled`` keeps ``source_enabled = True`` (P7); ``test`` keeps
    ``source_enabled != True``, which under three-valued logic is exactly the
    ``False`` rows (P8); ``None`` keeps all."""
    s = sources
    if mode == "enabled":
        s = s.where(F.col("source_enabled") == F.lit(True))
    elif mode == "test":
        s = s.where(F.col("source_enabled") != F.lit(True))
    t = targets.select("target_table", "batch_control_column", "batch_control_size",
                       "batch_control_next", "batch_schedule_type", "groupby_pattern",
                       "groupby_flexible")
    # One row per target; a target with many sources is a skewed key that AQE splits.
    j = s.select("target_table", "source_table", "source_enabled", "pattern_default",
                 "transformation").join(t, "target_table")
    eff = F.col("groupby_pattern").bitwiseOR(F.coalesce(F.col("pattern_default"), F.lit(0)))
    return (j.withColumn("effective_pattern", eff)
            .withColumn("compatible",
                        F.coalesce(F.col("groupby_flexible"), F.lit(False))
                        | (F.col("groupby_pattern") == eff)))


def loop_bounds(targets: DataFrame, now) -> DataFrame:
    """Chunk range of each target (I4).

    begin = processed + (size if MINUTES, 60 if HOURLY, else 1440) minutes;
    end   = now truncated to the hour (HOURLY) or day (DAILY), else floored to
    the size grid since 1970.  An unknown type begins at +1440 but ends on the
    size grid, as the warehouse did (Q12)."""
    typ, size = F.col("batch_schedule_type"), F.col("batch_control_size")
    step = (F.when(typ == "MINUTES", size).when(typ == "HOURLY", F.lit(60))
            .otherwise(F.lit(1440)))
    n = _now(now)
    possible = (F.when(typ == "HOURLY", trunc("hour", n))
                .when(typ == "DAILY", trunc("day", n))
                .otherwise(floor_minutes(n, size.cast("int"), EPOCH)))
    return (targets.withColumn("batch_loop_begin", add_minutes(F.col("batch_processed"),
                                                               step.cast("int")))
            .withColumn("batch_loop_end", possible))


def due_targets(targets: DataFrame, now) -> DataFrame:
    """Targets due to run (I6): nothing processing, or the last schedule is
    more than one chunk before the possible end.  A target that is processing
    with no last schedule is not due (NULL comparison)."""
    b = loop_bounds(targets, now)
    stale = minute_diff(F.col("batch_schedule_last"), F.col("batch_loop_end")) \
        > F.col("batch_control_size")
    return b.where(F.col("batch_processing").isNull() | F.coalesce(stale, F.lit(False)))


def covered_bounds(bounds: DataFrame, sources: DataFrame, now, complete_only: bool = True,
                   capped: bool = True) -> DataFrame:
    """``loop_bounds`` held back to chunks that are finished (``complete_only``:
    start + size <= now, Q10) and that every live source has data for
    (``capped``: start <= the earliest availability of its live sources, Q11).
    A source without availability, or a target without live sources, holds
    the range at the processed time.  The default runs do neither."""
    end = [F.col("batch_loop_end")]
    if complete_only:
        end.append(add_minutes(_now(now), (-F.col("batch_control_size")).cast("int")))
    if capped:
        cap = watermark_candidates(bounds, sources).withColumnRenamed("new_processed", "_rw_cap")
        bounds = bounds.join(cap, "target_table", "left")
        end.append(F.coalesce("_rw_cap", "batch_processed"))
    held = F.least(*end) if len(end) > 1 else end[0]
    return bounds.withColumn("batch_loop_end", held).drop("_rw_cap")


def chunk_list(bounds: DataFrame) -> DataFrame:
    """One row per chunk start: begin, begin + size, ... <= end.

    Empty when begin > end (``sequence`` would raise).  Generated in blocks so
    no single row holds an array longer than ``CHUNK_BLOCK``."""
    size = F.col("batch_control_size")
    steps = F.floor(F.timestamp_diff("MINUTE", F.col("batch_loop_begin"),
                                     F.col("batch_loop_end")) / size).cast("bigint")
    ok = bounds.where(F.col("batch_loop_begin") <= F.col("batch_loop_end")) \
        .withColumn("_rw_steps", steps)
    blocks = ok.withColumn("_rw_blk", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("_rw_steps") / CHUNK_BLOCK)
                   .cast("bigint"))))
    lo = F.col("_rw_blk") * CHUNK_BLOCK
    hi = F.least(F.col("_rw_steps"), lo + CHUNK_BLOCK - 1)
    chunks = blocks.withColumn("_rw_k", F.explode(F.sequence(lo, hi)))
    return (chunks.withColumn("chunk_start", add_minutes(
        F.col("batch_loop_begin"), (F.col("_rw_k") * size).cast("int")))
        .drop("_rw_steps", "_rw_blk", "_rw_k"))


def watermark_candidates(targets: DataFrame, sources: DataFrame) -> DataFrame:
    """New processed time per target with an enabled source (I8, G7):
    ``MIN(COALESCE(source availability, target processed))``.

    Sources are reduced to (min availability, any missing) per target first;
    the join with targets is then one-to-one."""
    agg = (sources.where(F.col("source_enabled") == F.lit(True))
           .groupBy("target_table")
           .agg(F.min("data_availabletime").alias("_rw_min_avail"),
                F.max(F.col("data_availabletime").isNull().cast("int")).alias("_rw_missing")))
    t = targets.select("target_table", "batch_processed")
    j = t.join(agg, "target_table")
    new = F.when(F.col("_rw_missing") == 1,
                 F.least(F.col("_rw_min_avail"), F.col("batch_processed"))) \
        .otherwise(F.col("_rw_min_avail"))
    return j.select("target_table", new.alias("new_processed"))


def advance_watermark(targets: DataFrame, sources: DataFrame,
                      which: DataFrame | None = None) -> DataFrame:
    """Finish of a run (I7 finish, I8): processed moves to the watermark where
    a target has enabled sources; processing and the current chunk are always
    cleared (a target without live sources no longer stays locked, Q13).
    ``which`` limits the update to the given target keys (default: all)."""
    cand = watermark_candidates(targets, sources)
    if which is not None:
        cand = cand.join(which.select("target_table"), "target_table", "left_semi")
    upd = update_from(targets, cand, ["target_table"], {"batch_processed": "new_processed"})
    clear = {"batch_processing": F.lit(None).cast("timestamp_ntz"),
             "batch_microchunk_current": F.lit(None).cast("timestamp_ntz")}
    if which is None:
        return update_where(upd, F.lit(True), clear)
    flag = which.select("target_table").distinct().withColumn("_rw_sel", F.lit(True))
    j = upd.join(flag, "target_table", "left")
    return update_where(j, F.col("_rw_sel"), clear).drop("_rw_sel").select(*targets.columns)


def start_run(targets: DataFrame, due: DataFrame, now) -> DataFrame:
    """Start of a run (I7 start): processing = loop end (doubles as a lock),
    last schedule = now, for the due targets only."""
    d = due.select("target_table", F.col("batch_loop_end").alias("_rw_end"),
                   F.lit(True).alias("_rw_due"))
    j = targets.join(d, "target_table", "left")
    out = update_where(j, F.col("_rw_due"), {
        "batch_processing": F.col("_rw_end"),
        "batch_schedule_last": _now(now)})
    return out.select(*targets.columns)


def state_after_run(targets: DataFrame, sources: DataFrame, now) -> DataFrame:
    """Registry state after running every due target: start, then finish."""
    due = due_targets(targets, now)
    started = start_run(targets, due, now)
    return advance_watermark(started, sources, which=due)


def source_availability(sources: DataFrame, latest: DataFrame, targets: DataFrame,
                        source_key: str = "source_table") -> DataFrame:
    """Availability refresh (I9): each source's availability becomes the
    newest control time in its data, floored to its target's chunk grid.

    ``latest`` has one row per source key with ``latest_ts`` (build it with a
    ``groupBy(...).agg(max(...))``; map-side partial aggregation keeps a hot
    source cheap).  Sources without data keep their value."""
    sizes = targets.select("target_table", "batch_control_size")
    upd = (sources.select("target_table", source_key).join(latest, source_key).join(sizes, "target_table")
           .select("target_table", source_key,
                   floor_minutes(F.col("latest_ts"), F.col("batch_control_size").cast("int"),
                                 EPOCH).alias("_rw_avail")))
    return update_from(sources, upd, ["target_table", source_key],
                       {"data_availabletime": "_rw_avail"})


def set_enabled(sources: DataFrame, value: bool | None, predicate: Column) -> DataFrame:
    """``UPDATE sources SET source_enabled = value WHERE predicate`` (M6)."""
    return update_where(sources, predicate,
                        {"source_enabled": F.lit(value).cast("boolean")})


def mapping_columns(targets: DataFrame) -> DataFrame:
    """Group-by mapping split into target and source name lists."""
    from ..functions.pattern import mapping_targets
    return targets.select("target_table",
                          mapping_targets(F.col("groupby_columns")).alias("target_dims"),
                          mapping_sources(F.col("groupby_columns")).alias("source_dims"))


def parse_registry_text(df: DataFrame) -> DataFrame:
    """Registry rows as registered from text (F17, U2): JSON arrays become
    ``array<string>``; the group-by pattern comes from a JSON flag list
    (``groupby_flags``) when given, else from the names."""
    from ..functions.pattern import flags_pattern, names_pattern
    arr = "array<string>"
    out = (df.withColumn("pattern_columns", F.from_json("pattern_columns", arr))
           .withColumn("groupby_columns", F.from_json("groupby_columns", arr))
           .withColumn("aggregate_columns", F.from_json("aggregate_columns", arr))
           .withColumn("aggregate_functions", F.from_json("aggregate_functions", arr)))
    by_names = names_pattern(F.col("pattern_columns"), mapping_sources(F.col("groupby_columns")))
    if "groupby_flags" in df.columns:
        flags = F.from_json("groupby_flags", "array<int>")
        out = out.withColumn("groupby_pattern", F.coalesce(flags_pattern(flags), by_names)) \
            .drop("groupby_flags")
    else:
        out = out.withColumn("groupby_pattern", by_names)
    return out


def backfill(targets: DataFrame, target_table: str, processed: dt.datetime) -> DataFrame:
    """Backfill reset (I11): processed set back, processing cleared."""
    return update_where(targets, F.col("target_table") == F.lit(target_table), {
        "batch_processed": ts_lit(processed),
        "batch_processing": F.lit(None).cast("timestamp_ntz")})
