"""One canonical output form for the Spark side and the oracle side.

The two engines' client libraries disagree on a few types even when the
values agree: DuckDB hands a DATE to pandas as ``datetime64`` while Spark
hands ``datetime.date`` objects, and decimal precisions differ.  Check
outputs therefore render dates as midnight timestamps and decimals as
doubles, on both sides.  Timestamps compare alike through ``collect`` /
``fetchall``, pandas and Arrow.  The library's own tables keep their types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Date-typed output columns per check key (kept in sync with the Spark
# schemas by tests/test_stream_and_entry.py).
DATE_COLUMNS = {
    "unify_events": ["data_date"], "unify_orders": ["data_date"],
    **{k: ["data_dt"] for k in (
        "chunk_filter", "chunk_agg_5min", "chunk_agg_daily", "two_source_daily",
        "test_chunk_agg", "batch_all_chunks", "sliding_reaggregate", "mixed_granularity",
        "multi_target_rollup", "mask_projection", "target_not_null_check", "copy_columns",
        "merge_upsert", "purge_range", "replace_chunk", "incremental_run", "demo_workflow",
        "rerun_after_source_delete", "late_row_range",
        "stream_summary")},
}


def canonical(df: DataFrame) -> DataFrame:
    """Dates as ``timestamp_ntz`` (midnight), decimals as double."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def canonical_sql(key: str, sql: str) -> str:
    """The oracle statement with the same date rendering."""
    cols = DATE_COLUMNS.get(key)
    if not cols:
        return sql
    repl = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS rw_q"
