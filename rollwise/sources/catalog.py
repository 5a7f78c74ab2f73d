"""Table sources: scan by name, transformation sources, inline rows.

A source relation is either the plain table (S1), a SQL query over
registered views (S2, text form) or a Python function of the table
(S2, DataFrame form).  Reading is lazy; Catalyst prunes columns and pushes
the chunk predicate into the parquet scan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..specs import SourceSpec

# The driver's test tables, one parquet file each.
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class Catalog:
    """Name -> DataFrame.  With ``base_dir`` a name is ``{base_dir}/{name}.parquet``;
    without it, names resolve through the session catalog."""

    def __init__(self, spark: SparkSession, base_dir: str | None = None,
                 overrides: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.base_dir = base_dir.rstrip("/") if base_dir else None
        self.overrides = dict(overrides or {})

    def table(self, name: str) -> DataFrame:
        if name in self.overrides:
            return self.overrides[name]
        if self.base_dir:
            return self.spark.read.parquet(f"{self.base_dir}/{name}.parquet")
        return self.spark.table(name)

    def with_table(self, name: str, df: DataFrame) -> "Catalog":
        c = Catalog(self.spark, self.base_dir, self.overrides)
        c.overrides[name] = df
        return c

    def register_views(self, names=None) -> "Catalog":
        """Expose tables as temp views so SQL-text transformations can use them."""
        for n in (names if names is not None else (list(TABLES) + list(self.overrides))):
            self.table(n).createOrReplaceTempView(n)
        return self


def resolve_source(catalog: Catalog, source: SourceSpec) -> DataFrame:
    """The relation a source contributes."""
    t = source.transformation
    if t is None:
        return catalog.table(source.source_table)
    if callable(t):
        return t(catalog.table(source.source_table))
    # Views for the source table and every known table the text names (a
    # transformation may join a dimension table).
    # With a session catalog the names resolve already; only folder tables and
    # overrides need views.
    known = list(dict.fromkeys([*([source.source_table, *TABLES] if catalog.base_dir else []),
                                *catalog.overrides]))
    catalog.register_views([n for n in known
                            if n == source.source_table or re.search(rf"\b{re.escape(n)}\b", t)])
    return catalog.spark.sql(t)


def inline_values(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """``FROM VALUES (...) AS t(c1, ...)`` (S3).  For small, fixed lists only."""
    cols = ", ".join(f"`{c}`" for c in columns)
    body = ", ".join("(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({cols})")


def _sql_lit(v) -> str:
    import datetime as dt
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP_NTZ'{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE'{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
