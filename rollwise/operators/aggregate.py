"""Chunk aggregation: mask-driven projection, grouping and aggregate templates.

For one (target, source) pair the plan is

    source relation -> chunk predicate -> keep the columns the mask keeps
    -> group by them -> aggregate templates -> target column names

and for several sources the per-source aggregates are unioned (one job,
branches run in parallel).  Everything is a DataFrame expression: the
partial/final hash aggregate does map-side combining, so a hot group costs
one row per map task before the shuffle.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.pattern import kept_positions
from ..functions.timegrid import add_minutes, ts_lit
from ..specs import SourceSpec, TargetSpec


@dataclass
class SourcePlan:
    """How one source feeds one target (decided on the driver, from specs)."""
    source: SourceSpec
    effective_mask: int          # target mask OR source mask (G8)
    accepted: bool               # granularity gate (G9)
    kept: list[tuple[str, str]]  # (target dim, source column) the mask keeps (P4)

    @property
    def keys(self) -> list[str]:
        return [t for t, _ in self.kept]


def plan_source(target: TargetSpec, source: SourceSpec) -> SourcePlan:
    eff = int(target.groupby_pattern) | int(source.pattern_default or 0)
    accepted = bool(target.groupby_flexible) or eff == int(target.groupby_pattern)
    tgt, src = target.dims
    kept = []
    for i in kept_positions(eff, len(target.pattern_columns)):
        col = target.pattern_columns[i]
        if col not in src:
            raise ValueError(f"pattern column {col!r} kept by mask {eff} has no target dim")
        # Match by name, not by position in the list (Q2).
        kept.append((tgt[src.index(col)], col))
    return SourcePlan(source, eff, accepted, kept)


def require_control(target: TargetSpec, plan: SourcePlan) -> None:
    """Refuse a source whose mask covers the control column: its rows would
    lose their chunk time, and no purge could find them again (Q4)."""
    if target.control_column not in plan.keys:
        raise ValueError(f"source {plan.source.source_table!r} masks out the control column "
                         f"{target.control_column!r} of {target.target_table!r}")


# ---- chunk predicates --------------------------------------------------------

_BIND = re.compile(r"(?<![\w:]):([12])(?!\w)")
_DEFAULT_STEPS = {"timestampadd(minute,:2,:1)", "dateadd(minute,:2,:1)"}


def _bind_names(step: str) -> str:
    """``:1``/``:2`` -> named parameters, outside quoted text only (so a literal
    such as ``'10:20'`` is left alone, unlike the warehouse rendering, Q15)."""
    parts = re.split(r"('(?:[^'\\]|\\.)*')", step)
    return "".join(p if p.startswith("'") else
                   _BIND.sub(lambda m: "CAST(:rw_start AS TIMESTAMP_NTZ)" if m.group(1) == "1"
                             else "CAST(:rw_size AS INT)", p) for p in parts)


def step_end(step, start: dt.datetime, minutes: int, spark=None) -> Column:
    """Chunk end = step(start, size).

    ``step`` is a callable ``(start, size) -> Column`` or warehouse-style SQL
    text with ``:1`` = start and ``:2`` = size.  The additive-minutes form is
    built directly; other text is evaluated once with bound parameters."""
    if callable(step):
        return step(ts_lit(start), F.lit(int(minutes)))
    if re.sub(r"\s+", "", step).lower() in _DEFAULT_STEPS:
        return add_minutes(ts_lit(start), int(minutes))
    if spark is None:
        raise ValueError("a SQL step expression needs the session")
    row = spark.sql(f"SELECT CAST({_bind_names(step)} AS TIMESTAMP_NTZ) AS e",
                    args={"rw_start": start, "rw_size": int(minutes)}).first()
    return ts_lit(row["e"])


def in_range(df: DataFrame, target: TargetSpec, source: SourceSpec, lo: dt.datetime,
             hi: dt.datetime, offsets: tuple[int, int] | None = None) -> DataFrame:
    """Rows whose target control time lies in ``[lo, hi)``.

    ``offsets`` are proven bounds of control minus raw time in microseconds (a
    zone map has them): the raw time then gets the bound that follows, which
    reaches the scan."""
    t = time_col(df, target.source_of(target.control_column))
    df = df.where((t >= ts_lit(lo)) & (t < ts_lit(hi)))
    if offsets is None:
        return df
    raw = time_col(df, source.control_column)
    least, most = (dt.timedelta(microseconds=x) for x in offsets)
    return df.where((raw >= ts_lit(lo - most)) & (raw < ts_lit(hi - least)))


def in_chunk(col: Column, start: dt.datetime, minutes: int, step=None, spark=None) -> Column:
    """Half-open chunk predicate ``col >= start AND col < step(start, size)`` (P5).

    The bounds are literals, so the predicate reaches the parquet scan as
    ``PushedFilters`` when ``col`` is (an alias of) a stored column."""
    from ..specs import DEFAULT_STEP
    return (col >= ts_lit(start)) & (col < step_end(step or DEFAULT_STEP, start, minutes, spark))


def time_col(df: DataFrame, name: str) -> Column:
    """A time column as ``timestamp_ntz`` (dates compare at midnight)."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    return c


# ---- aggregation -------------------------------------------------------------

def aggregate_exprs(target: TargetSpec) -> list[Column]:
    """Aggregate templates: the first ``?`` becomes the source column."""
    tgt, src = target.measures
    out = []
    for t, s, tpl in zip(tgt, src, target.aggregate_functions):
        e = tpl(F.col(s)) if callable(tpl) else F.expr(tpl.replace("?", f"`{s}`", 1))
        out.append(e.alias(t))
    return out


def key_exprs(df: DataFrame, target: TargetSpec, plan: SourcePlan) -> list[Column]:
    """Group keys named after the target dims.  The row-pattern column is
    OR-ed with the effective mask (G10); text dims fold '' into NULL (Q7)."""
    out = []
    for t, s in plan.kept:
        c = F.col(s)
        if s == target.row_pattern_column:
            c = c.cast("bigint").bitwiseOR(F.lit(plan.effective_mask))
        elif target.blank_as_null and isinstance(df.schema[s].dataType, T.StringType):
            c = F.nullif(c, F.lit(""))
        out.append(c.alias(t))
    return out


def aggregate_frame(df: DataFrame, target: TargetSpec, plan: SourcePlan) -> DataFrame:
    """GROUP BY the kept columns (G1; no keys at all gives one global row, Q18)."""
    keys = key_exprs(df, target, plan)
    return df.groupBy(*keys).agg(*aggregate_exprs(target))


def projected_frame(df: DataFrame, target: TargetSpec, plan: SourcePlan) -> DataFrame:
    """The rows a source feeds into the grouping: keys (target names) and the
    aggregated input columns, before any shuffle."""
    return df.select(*key_exprs(df, target, plan),
                     *[F.col(c) for c in dict.fromkeys(target.measures[1])])


def aggregate_union(projected: list[tuple[int, DataFrame]], target: TargetSpec,
                    keys: list[str]) -> DataFrame:
    """One aggregation over the union of several sources' projected rows, given
    with their priority ranks.

    A declared source dim should tell the sources apart, but is not believed:
    the rank is a key of the aggregation, so rows of two sources never add
    up.  Where they share a key, the higher rank's row stays; that choice
    runs over aggregated rows only."""
    u = None
    for rank, df in projected:
        tagged = df.withColumn("_rw_prio", F.lit(rank))
        u = tagged if u is None else u.unionByName(tagged, allowMissingColumns=True)
    return _highest(u.groupBy(*keys, "_rw_prio").agg(*aggregate_exprs(target)), keys, target.measures[0])


def _highest(tagged: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Of rows with equal keys the one of the highest ``_rw_prio``."""
    best = F.max_by(F.struct(*[F.col(m) for m in measures]), F.col("_rw_prio")).alias("_rw_m")
    out = tagged.groupBy(*keys).agg(best) if keys else tagged.agg(best)
    return out.select(*keys, *[F.col("_rw_m")[m].alias(m) for m in measures])


def combine_sources(parts: list[tuple[int, DataFrame]], keys: list[str],
                    measures: list[str]) -> DataFrame:
    """Union per-source aggregates into one batch.

    When two sources produce the same key, the higher priority wins (Q5; the
    warehouse let the last MERGE win in cursor order).  The tie-break runs
    on aggregated rows only, so its shuffle is small."""
    if len(parts) == 1:
        return parts[0][1]
    tagged = [df.withColumn("_rw_prio", F.lit(p)) for p, df in parts]
    u = tagged[0]
    for df in tagged[1:]:
        u = u.unionByName(df, allowMissingColumns=True)
    return _highest(u, keys, measures)
