"""Generated rows (S4, F18): N rows by number, every value a hash of its row.

``spark.range`` deals the row numbers; a value is a multiply-and-add mix of
row number and seed in whole numbers below 2^31, so any partition, run or
engine makes the same row, and products stay within 64 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Constants of the mix: a prime modulus and three multipliers below it.
PRIME = 2147483647
MULTIPLIERS = (48271, 69621, 16807)


def mixed(row: Column, seed: int) -> Column:
    """A number in ``[0, PRIME)`` of row number and seed."""
    x = F.pmod(row * MULTIPLIERS[0] + seed * 7919 + 12345, F.lit(PRIME))
    for m in MULTIPLIERS[1:]:
        # The low and high halves change places in between: neighbours part.
        x = F.pmod((F.pmod(x, F.lit(65536)) * 32768 + F.floor(x / 65536)) * m + seed, F.lit(PRIME))
    return x


def uniform(row: Column, seed: int, low: int, high: int) -> Column:
    """A whole number from ``low`` to ``high``, both included."""
    return F.lit(low) + F.pmod(mixed(row, seed), F.lit(high - low + 1))


def text(row: Column, seed: int, length: Column) -> Column:
    """Letters a-z, ``length`` of them (26 at most), from the row's own numbers."""
    letters = F.transform(F.sequence(F.lit(1), F.lit(26)), lambda k: F.char(F.lit(97) + F.pmod(
        mixed(row * 32 + k, seed), F.lit(26))))
    return F.left(F.array_join(letters, ""), length.cast("int"))


def rows(spark: SparkSession, n: int | Column | DataFrame) -> DataFrame:
    """Rows numbered 0 .. n - 1; of a DataFrame as many as it has."""
    if isinstance(n, DataFrame):
        n = n.count()
    return spark.range(int(n)).withColumnRenamed("id", "row_no")
