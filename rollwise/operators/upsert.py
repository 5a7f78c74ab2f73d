"""Table maintenance without a transactional format: upsert, purge, replace,
keyed update, surrogate ids.

Parquet refuses MERGE/UPDATE/DELETE, so each operator returns the *new
content* of the touched part of a table as a DataFrame; ``sinks.write_target``
writes it back with dynamic partition overwrite.  Keys are compared in text
form with NULL and '' equal, as the warehouse MERGE did (J2).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.timegrid import ts_lit


def norm_key(c: Column) -> Column:
    """Text form of a key; NULL and '' compare equal (``COALESCE(TO_CHAR(x),'')``)."""
    return F.coalesce(c.cast("string"), F.lit(""))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], measures: list[str],
           key_map: dict[str, str] | None = None) -> DataFrame:
    """MERGE: a matched key overwrites the measures (even with NULL); an
    unmatched batch row is inserted with the dims it has, other dims NULL (M1).

    Keys compare as the warehouse did, on their text form with NULL equal to
    '' (J2).  Only text keys need that folding; for other types the text form
    is equal exactly when the values are, so they join on a typed null-safe
    equality (a hash-join key, no per-row string conversion).

    ``keys`` are target column names; ``key_map`` maps them to batch names
    when they differ.  Returns the full new content with the target's schema.

    The batch has one row per key; the target may have many (a batch coarser
    than the target's rows updates them all).  So the update is a left join
    on the target, whose partitions AQE can split when a key holds much of
    the table, and the insert a left anti join against the target's distinct
    keys, which partial aggregation brings down to one row a key and task."""
    key_map = key_map or {}
    tcols = target.columns
    types = dict((f.name, f.dataType) for f in target.schema.fields)

    def key_expr(c, name: str):
        col = F.col(c)
        if isinstance(types[name], T.StringType):
            return norm_key(col)
        return col.cast(types[name])

    t_keys = [key_expr(k, k).alias(f"tk{i}") for i, k in enumerate(keys)]
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in tcols], *t_keys)
    bcols = [key_map.get(k, k) for k in keys] + [m for m in measures]
    b = batch.select(*[F.col(c).alias(f"b_{c}") for c in dict.fromkeys(bcols)],
                     *[key_expr(key_map.get(k, k), k).alias(f"bk{i}")
                       for i, k in enumerate(keys)],
                     F.lit(True).alias("_in_b"))
    if not keys:
        # All dims masked (Q18): the batch is one global row, and an empty ON
        # clause matches every target row: all of them take its measures.
        t_keys = [F.lit(1).alias("tk0")]
        t, b = t.withColumn("tk0", F.lit(1)), b.withColumn("bk0", F.lit(1))
    cond = [F.col(f"tk{i}").eqNullSafe(F.col(f"bk{i}")) for i in range(max(1, len(keys)))]
    hit = F.col("_in_b").isNotNull()
    updated = t.join(b, on=cond, how="left").select(*[
        (F.when(hit, F.col(f"b_{c}").cast(types[c])).otherwise(F.col(f"t_{c}")) if c in measures
         else F.col(f"t_{c}")).alias(c) for c in tcols])
    present = target.select(*t_keys).distinct()
    inserted = b.join(present, on=cond, how="left_anti").select(*[
        (F.col(f"b_{c}").cast(types[c]) if c in measures
         else F.col(f"b_{key_map.get(c, c)}").cast(types[c]) if c in keys
         else F.lit(None).cast(types[c])).alias(c) for c in tcols])
    return updated.unionByName(inserted)


def range_predicate(col: Column, start: dt.datetime, minutes: int) -> Column:
    end = start + dt.timedelta(minutes=int(minutes))
    return (col >= ts_lit(start)) & (col < ts_lit(end))


def purge(target: DataFrame, control_column: str, start: dt.datetime,
          minutes: int) -> DataFrame:
    """DELETE rows with control in ``[start, start + minutes)``; a NULL control
    never matches and is kept (M4).  Narrow: no shuffle."""
    c = F.col(control_column)
    if dict(target.dtypes)[control_column] == "date":
        c = c.cast("timestamp_ntz")
    return target.where(~F.coalesce(range_predicate(c, start, minutes), F.lit(False)))


def replace_range(target: DataFrame, batch: DataFrame, control_column: str,
                  start: dt.datetime, minutes: int, keys: list[str],
                  measures: list[str], key_map: dict[str, str] | None = None) -> DataFrame:
    """Purge the range, then upsert the recomputed batch (M5).  A rerun over
    the same source data gives the same table (idempotent)."""
    return upsert(purge(target, control_column, start, minutes), batch, keys, measures,
                  key_map)


def update_where(df: DataFrame, predicate: Column, assignments: dict[str, Column]) -> DataFrame:
    """``UPDATE df SET c = v WHERE predicate`` (M6); NULL predicate = no match."""
    hit = F.coalesce(predicate, F.lit(False))
    cols = []
    for c in df.columns:
        if c in assignments:
            cols.append(F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def update_from(df: DataFrame, changes: DataFrame, on: list[str],
                assignments: dict[str, str]) -> DataFrame:
    """``UPDATE df SET c = changes.v FROM changes WHERE df.k = changes.k``.

    ``changes`` must have at most one row per key (aggregate it first); the
    left join keeps every base row, and AQE picks its form from the sizes
    that the shuffled sides turn out to have.  No side runs before it."""
    ch = changes.select(*on, *[F.col(v).alias(f"_new_{c}") for c, v in assignments.items()],
                        F.lit(True).alias("_hit"))
    j = df.join(ch, on, "left")
    cols = []
    for c in df.columns:
        if c in assignments:
            cols.append(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def dense_index(df: DataFrame, order_cols: list[str], base: int = 0,
                name: str = "id", checkpoint: bool = True) -> DataFrame:
    """Consecutive numbers ``base + 1, base + 2, ...`` in ``order_cols`` order,
    without pulling all rows into one task.

    Rows are range-partitioned on the key; each partition's offset is the
    running total of the partition sizes (a table of one row per partition),
    and rows are numbered inside their partition.  The range-partitioned
    rows are checkpointed so a lost executor recomputes the same assignment."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))
    ranged = df.repartitionByRange(n, *[F.col(c) for c in order_cols]).withColumn(
        "_rw_pid", F.spark_partition_id())
    if checkpoint:
        from ..session import shared_dir
        shared_dir(df.sparkSession)
        ranged = ranged.checkpoint(eager=True)
    sizes = ranged.groupBy("_rw_pid").agg(F.count(F.lit(1)).alias("_rw_n"))
    # One row per partition: bounded by the partition count, never by the data.
    offs = sizes.select("_rw_pid", (F.sum("_rw_n").over(
        Window.orderBy("_rw_pid").rowsBetween(Window.unboundedPreceding, 0))
        - F.col("_rw_n")).alias("_rw_off"))
    w = Window.partitionBy("_rw_pid").orderBy(*[F.col(c) for c in order_cols])
    return (ranged.join(F.broadcast(offs), "_rw_pid")
            .withColumn(name, (F.lit(int(base)) + F.col("_rw_off")
                               + F.row_number().over(w)).cast("bigint"))
            .drop("_rw_pid", "_rw_off"))


def upsert_registry(current: DataFrame, incoming: DataFrame, keys: list[str],
                    id_col: str = "id", keep_on_match: tuple[str, ...] = ()) -> DataFrame:
    """MERGE registry rows by natural key (M2, M3, S8): matched rows take the
    incoming values but keep their id (and ``keep_on_match`` columns); new rows
    get the next ids after the current maximum, in key order.  Incoming rows
    must be unique by key (as the warehouse MERGE demanded); duplicates raise."""
    dup = incoming.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"incoming registry rows repeat a key: {dup[0].asDict()}")
    cur = current.select(*[F.col(c).alias(f"c_{c}") for c in current.columns])
    inc = incoming.select(*incoming.columns, F.lit(True).alias("_in"))
    cond = [F.col(f"c_{k}") == F.col(k) for k in keys]
    j = cur.join(inc, on=cond, how="full_outer")
    cols = []
    for c in current.columns:
        if c == id_col:
            cols.append(F.col(f"c_{c}").alias(c))
        elif c in keys:
            cols.append(F.coalesce(F.col(f"c_{c}"), F.col(c)).alias(c))
        elif c in keep_on_match or c not in incoming.columns:
            cols.append(F.col(f"c_{c}").alias(c))
        else:
            cols.append(F.when(F.col("_in").isNotNull(), F.col(c))
                        .otherwise(F.col(f"c_{c}")).alias(c))
    from .joins import measured
    # Written: the old rows and the new ones are both read from one join.
    merged = measured(j.select(*cols, F.col(f"c_{id_col}").isNull().alias("_new")), "registry")
    old = merged.where(~F.col("_new")).drop("_new")
    new = merged.where(F.col("_new")).drop("_new", id_col)
    # The current maximum id is one scalar; new ids continue after it.
    base = current.agg(F.max(id_col)).first()[0] or 0
    numbered = dense_index(new, keys, base=base, name=id_col)
    return old.unionByName(numbered.select(*current.columns))
