"""A derived side of a join, written once so that the planner knows its size.

Catalyst chooses between broadcast and shuffled joins by size.  Of a derived
side (an aggregate, a join) it has a guess only, and counting the side first
would run it twice.  ``measured`` writes it to the shared folder and reads it
back: it runs once, the planner sees the bytes it really has, a lost executor
recomputes nothing, and a plain join then takes the form that fits, with AQE
splitting skewed partitions where it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import fresh_path


def measured(df: DataFrame, name: str = "side") -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
