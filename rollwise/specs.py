"""Target and source specifications (the registry rows) and their schemas.

A *target* says which columns a summary table groups by, which aggregates it
keeps and how its time axis is cut into chunks.  A *source* says which table
feeds the target and how to reshape it into the target's common columns.
Both exist as Python objects (for one job) and as DataFrame rows (for
registry-wide work: due targets, watermarks, gates).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Callable, Union

from pyspark.sql import DataFrame, types as T

from .functions.pattern import kept_positions

# The step expression of a chunk: ``:1`` is the chunk start, ``:2`` its size
# in minutes.  Spark accepts the warehouse spelling ``dateadd``.
DEFAULT_STEP = "timestampadd(MINUTE, :2, :1)"

SCHEDULE_TYPES = ("MINUTES", "HOURLY", "DAILY")

Transformation = Union[str, Callable[[DataFrame], DataFrame], None]


def split_mapping(items: list[str]) -> tuple[list[str], list[str]]:
    """``["tgt:src", ...]`` -> (target names, source names)."""
    tgt, src = [], []
    for it in items:
        a, _, b = it.partition(":")
        tgt.append(a.strip())
        src.append((b or a).strip())
    return tgt, src


@dataclass
class TargetSpec:
    target_table: str
    control_column: str                 # target column that holds chunk time
    chunk_minutes: int
    pattern_columns: list[str]          # source-side names, bit order MSB first
    groupby_columns: list[str]          # "target:source"
    groupby_pattern: int                # bitmask, 1 = column absent
    aggregate_columns: list[str]        # "target:source"
    aggregate_functions: list[str]      # templates with one "?"
    schedule_type: str = "MINUTES"
    groupby_flexible: bool = False
    step: str = DEFAULT_STEP
    row_pattern_column: str | None = "data_pattern"  # source col OR-ed with mask
    not_null: tuple[str, ...] = ()
    blank_as_null: bool = True          # group '' and NULL as one key (Q7)
    source_dim: str | None = None       # target dim that tells sources apart (Q5)
    label: str | None = None
    id: int | None = None
    batch_processed: dt.datetime | None = None
    batch_processing: dt.datetime | None = None
    batch_microchunk_current: dt.datetime | None = None
    batch_schedule_last: dt.datetime | None = None

    @property
    def dims(self) -> tuple[list[str], list[str]]:
        return split_mapping(self.groupby_columns)

    @property
    def measures(self) -> tuple[list[str], list[str]]:
        return split_mapping(self.aggregate_columns)

    def source_of(self, target_col: str) -> str:
        tgt, src = self.dims
        return src[tgt.index(target_col)]

    def target_of(self, source_col: str) -> str:
        tgt, src = self.dims
        return tgt[src.index(source_col)]

    def validate(self) -> None:
        if self.schedule_type not in SCHEDULE_TYPES:
            raise ValueError(f"unknown schedule type {self.schedule_type!r}")
        if len(self.aggregate_columns) != len(self.aggregate_functions):
            raise ValueError("aggregate columns and functions differ in length")
        if self.chunk_minutes <= 0:
            raise ValueError("chunk size must be positive")
        tgt, src = self.dims
        if self.control_column not in tgt:
            raise ValueError(f"control column {self.control_column!r} is not a dimension")
        # The control column must survive the mask, or purge could never match (Q4).
        ctl_src = self.source_of(self.control_column)
        keep = {self.pattern_columns[i] for i in kept_positions(self.groupby_pattern,
                                                                 len(self.pattern_columns))}
        if ctl_src not in keep:
            raise ValueError(f"control column {self.control_column!r} is masked out")
        for c in keep:
            if c not in src:
                raise ValueError(f"kept pattern column {c!r} has no target mapping")


@dataclass
class SourceSpec:
    target_table: str
    source_table: str
    enabled: bool | None = True         # True live, False under test, None parked
    pattern_default: int = 0            # bits of columns the source lacks
    transformation: Transformation = None
    control_column: str | None = None   # raw time column in the source relation
    priority: int = 0                   # collision rule between sources (Q5)
    label: str | None = None
    id: int | None = None
    data_availabletime: dt.datetime | None = None


# Registry schemas (one row per target / per source).
TARGETS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("target_label", T.StringType()),
    T.StructField("target_table", T.StringType(), False),
    T.StructField("batch_control_column", T.StringType()),
    T.StructField("batch_control_size", T.LongType()),
    T.StructField("batch_control_next", T.StringType()),
    T.StructField("batch_processed", T.TimestampNTZType()),
    T.StructField("batch_processing", T.TimestampNTZType()),
    T.StructField("batch_microchunk_current", T.TimestampNTZType()),
    T.StructField("batch_schedule_type", T.StringType()),
    T.StructField("batch_schedule_last", T.TimestampNTZType()),
    T.StructField("pattern_columns", T.ArrayType(T.StringType())),
    T.StructField("groupby_columns", T.ArrayType(T.StringType())),
    T.StructField("groupby_pattern", T.LongType()),
    T.StructField("groupby_flexible", T.BooleanType()),
    T.StructField("aggregate_columns", T.ArrayType(T.StringType())),
    T.StructField("aggregate_functions", T.ArrayType(T.StringType())),
    T.StructField("default_procedure", T.StringType()),
    # Optional, ours: the spec fields the engine adds.  NULL means the default;
    # '' in row_pattern_column means no such column.
    T.StructField("not_null", T.ArrayType(T.StringType())),
    T.StructField("source_dim", T.StringType()),
    T.StructField("blank_as_null", T.BooleanType()),
    T.StructField("row_pattern_column", T.StringType()),
])

SOURCES_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("source_label", T.StringType()),
    T.StructField("target_table", T.StringType(), False),
    T.StructField("source_table", T.StringType(), False),
    T.StructField("source_enabled", T.BooleanType()),
    T.StructField("pattern_default", T.LongType()),
    T.StructField("pattern_flexible", T.BooleanType()),
    T.StructField("data_availabletime", T.TimestampNTZType()),
    T.StructField("data_checkschedule", T.TimestampNTZType()),
    T.StructField("transformation", T.StringType()),
    # Optional, ours: the raw time column of the transformed source, which range
    # runs bound by what the zone map proves.
    T.StructField("control_column", T.StringType()),
    # Collision rule between sources (Q5); NULL means registration order.
    T.StructField("priority", T.LongType()),
])


def target_row(t: TargetSpec) -> tuple:
    return (t.id, t.label, t.target_table, t.control_column, t.chunk_minutes, t.step,
            t.batch_processed, t.batch_processing, t.batch_microchunk_current,
            t.schedule_type, t.batch_schedule_last, list(t.pattern_columns),
            list(t.groupby_columns), t.groupby_pattern, t.groupby_flexible,
            list(t.aggregate_columns), list(t.aggregate_functions), None,
            list(t.not_null), t.source_dim, t.blank_as_null, t.row_pattern_column or "")


def source_row(s: SourceSpec) -> tuple:
    if callable(s.transformation):
        raise ValueError(f"source {s.source_table!r}: a registry stores a transformation as SQL "
                         "text; a Python function would be lost")
    return (s.id, s.label, s.target_table, s.source_table, s.enabled, s.pattern_default,
            None, s.data_availabletime, None, s.transformation, s.control_column,
            s.priority)


def target_from_row(r) -> TargetSpec:
    """Registry row (``Row`` or dict) -> TargetSpec."""
    d = r.asDict() if hasattr(r, "asDict") else dict(r)
    return TargetSpec(
        target_table=d["target_table"], control_column=d["batch_control_column"],
        chunk_minutes=int(d["batch_control_size"]),
        pattern_columns=list(d["pattern_columns"]), groupby_columns=list(d["groupby_columns"]),
        groupby_pattern=int(d["groupby_pattern"] or 0),
        aggregate_columns=list(d["aggregate_columns"]),
        aggregate_functions=list(d["aggregate_functions"]),
        schedule_type=d["batch_schedule_type"] or "MINUTES",
        groupby_flexible=bool(d["groupby_flexible"]),
        step=d.get("batch_control_next") or DEFAULT_STEP, label=d.get("target_label"),
        id=d.get("id"), batch_processed=d.get("batch_processed"),
        batch_processing=d.get("batch_processing"),
        batch_microchunk_current=d.get("batch_microchunk_current"),
        batch_schedule_last=d.get("batch_schedule_last"),
        not_null=tuple(d.get("not_null") or ()), source_dim=d.get("source_dim"),
        blank_as_null=d.get("blank_as_null") is not False,
        row_pattern_column=("data_pattern" if d.get("row_pattern_column") is None
                            else d["row_pattern_column"] or None))


__all__ = ["TargetSpec", "SourceSpec", "TARGETS_SCHEMA", "SOURCES_SCHEMA", "split_mapping",
           "target_row", "source_row", "target_from_row", "DEFAULT_STEP"]
