"""Target tables: schema, NOT NULL enforcement, column-list copy, writes.

Targets are parquet tables partitioned by the day of their control column.
A write replaces only the partitions present in the written DataFrame
(dynamic partition overwrite), which is how a purge + upsert of a chunk range
lands without touching the rest of the table; ``replace_days`` also removes
the touched days that end up empty.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F, types as T

from ..specs import SourceSpec, TargetSpec
from .aggregate import aggregate_frame, plan_source

PARTITION_COLUMN = "control_day"


def target_schema(target: TargetSpec, unified: DataFrame) -> T.StructType:
    """Full target schema: every dim (as if no mask) and every measure.
    Derived by analysis only; no job runs."""
    from ..functions.pattern import names_to_mask
    mask = names_to_mask(target.pattern_columns, target.dims[1])
    full = TargetSpec(**{**target.__dict__, "groupby_pattern": mask})
    plan = plan_source(full, SourceSpec(target.target_table, "_schema"))
    return aggregate_frame(unified, full, plan).schema


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order; missing ones NULL of the right type."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in schema.fields])


def copy_into(old: DataFrame, schema: T.StructType, columns: list[str] | None = None
              ) -> DataFrame:
    """``INSERT INTO new (cols) SELECT cols FROM old`` (S7): the listed columns
    are copied by name, the rest of the new schema is NULL."""
    cols = columns or [c for c in old.columns if c in schema.fieldNames()]
    return conform(old.select(*cols), schema)


def enforce_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail the job on a NULL in a NOT NULL column (S6).  Parquet stores NULLs
    despite the DDL, so the check is a per-row expression in the same stage
    as the write: no extra pass over the data."""
    out = []
    for c in df.columns:
        if c in columns:
            out.append(F.when(F.col(c).isNull(), F.raise_error(
                F.lit(f"NULL in NOT NULL column {c}"))).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def with_partition(df: DataFrame, control_column: str) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, F.to_date(F.col(control_column)))


def write_target(df: DataFrame, path: str, control_column: str) -> None:
    """Replace the partitions (days) present in ``df``; keep all others.

    Rows are clustered by day before the write so each day is written by few
    tasks (few files).  The ``rebalance`` hint lets AQE split a day that holds
    a large share of the rows over several tasks instead of one."""
    out = with_partition(df, control_column)
    (out.hint("rebalance", PARTITION_COLUMN)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COLUMN).parquet(path))


def days_between(first: dt.date, last: dt.date) -> list[dt.date]:
    """Calendar days ``first .. last``: one per partition, so bounded by the
    length of the range and not by its rows."""
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def read_days(spark, path: str, schema: T.StructType, days: list) -> DataFrame:
    """The stored rows of some days (None: rows without a day) in ``schema``.
    Only those partitions are read.  A table that is not there yet, or that an
    empty run left without files, has no rows."""
    empty = spark.createDataFrame([], schema)
    if not days:
        return empty
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return empty
        raise
    day = F.col(PARTITION_COLUMN).cast("date")
    hit = day.isin([d for d in days if d is not None])
    return conform(df.where(hit | day.isNull() if None in days else hit), schema)


def _day_files(spark, path: str, days: list) -> dict[str, set[str]]:
    """Data files of each stored partition among ``days``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    wanted = {f"{PARTITION_COLUMN}={d.isoformat()}" for d in days if d is not None}
    return {st.getPath().toString(): {f.getPath().getName() for f in fs.listStatus(st.getPath())
                                      if f.getPath().getName().startswith("part-")}
            for st in fs.listStatus(root) if st.getPath().getName() in wanted}


def replace_days(new: DataFrame, path: str, control_column: str, days: list) -> None:
    """Make ``new`` the whole content of ``days`` (M5).  Dynamic overwrite
    replaces the days that have rows; a day that still holds a file from before
    has none any more, and its partition is removed once the write succeeded.
    A rerun after a crash in between removes it then."""
    spark = new.sparkSession
    before = _day_files(spark, path, days)
    write_target(new, path, control_column)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for folder, names in _day_files(spark, path, days).items():
        if names & before.get(folder, set()):
            p = hadoop.Path(folder)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
