"""Data patterns: granularity as a bitmask over an ordered column list.

Bit order is most significant first: with ``n`` columns, column ``i`` owns
bit ``n - 1 - i``.  A bit of 1 means the column is *absent* (masked out, or
falsy in the row).  All column forms are built-in expressions, so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


# ---- driver-side helpers (spec building) ----------------------------------

def flags_to_mask(flags) -> int:
    """0/1 (or truthy/falsy) flags -> mask; a falsy flag sets the bit."""
    m = 0
    for f in flags:
        m = 2 * m + (0 if f else 1)
    return m


def names_to_mask(pattern_columns, groupby_columns) -> int:
    """Bit set for each pattern column missing from the group-by list."""
    gb = set(groupby_columns)
    return flags_to_mask([c in gb for c in pattern_columns])


def kept_positions(mask: int, n: int) -> list[int]:
    """Positions whose bit is 0 (column kept)."""
    return [i for i in range(n) if not (mask >> (n - 1 - i)) & 1]


def bit_of(position: int, n: int) -> int:
    return 1 << (n - 1 - position)


# ---- column forms ----------------------------------------------------------

def falsy(c: Column, dtype: T.DataType) -> Column:
    """True when a value counts as absent: NULL, 0, NaN, false or ''."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        test = c.isNull() | (c == 0) | F.isnan(c)
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                            T.DecimalType)):
        test = c.isNull() | (c == 0)
    elif isinstance(dtype, T.StringType):
        test = c.isNull() | (c == "")
    elif isinstance(dtype, T.BooleanType):
        test = c.isNull() | ~c
    else:  # dates, timestamps, arrays: only NULL is absent
        test = c.isNull()
    return F.coalesce(test, F.lit(True))


def row_pattern(df: DataFrame, columns: list) -> Column:
    """Row pattern over ``columns`` (names or ``(Column, DataType)`` pairs).

    Each falsy value contributes its bit; the result is a bigint.
    """
    n = len(columns)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    terms = []
    for i, c in enumerate(columns):
        if isinstance(c, str):
            col, dtype = F.col(c), types[c]
        else:
            col, dtype = c
        terms.append(F.when(falsy(col, dtype), F.lit(bit_of(i, n))).otherwise(F.lit(0)))
    if not terms:
        return F.lit(0).cast("bigint")
    return reduce(lambda a, b: a + b, terms).cast("bigint")


def flags_pattern(flags: Column) -> Column:
    """Mask from an array of 0/1 flags (falsy flag -> bit 1)."""
    return F.aggregate(flags, F.lit(0).cast("bigint"),
                       lambda acc, x: acc * 2 + F.when(F.coalesce(x, F.lit(0)) == 0, 1)
                       .otherwise(0))


def names_pattern(pattern_columns: Column, groupby_sources: Column) -> Column:
    """Mask: bit 1 for each pattern column missing from ``groupby_sources``."""
    return F.aggregate(pattern_columns, F.lit(0).cast("bigint"),
                       lambda acc, c: acc * 2 + F.when(F.array_contains(groupby_sources, c), 0)
                       .otherwise(1))


def kept_names(names: Column, mask: Column) -> Column:
    """The names whose bit in ``mask`` is 0 (MSB first), as an array."""
    n = F.size(names)
    return F.filter(names, lambda c, i: mask.cast("bigint").bitwiseAND(
        F.pow(F.lit(2), n - 1 - i).cast("bigint")) == 0)


def mapping_targets(mapping: Column) -> Column:
    """``["tgt:src", ...]`` -> target names."""
    return F.transform(mapping, lambda x: F.split_part(x, F.lit(":"), F.lit(1)))


def mapping_sources(mapping: Column) -> Column:
    """``["tgt:src", ...]`` -> source names."""
    return F.transform(mapping, lambda x: F.split_part(x, F.lit(":"), F.lit(2)))


def column_map(keys: Column, values: Column) -> Column:
    """Map keys -> values; unequal lengths give an empty map; a repeated key
    keeps its last value (without touching the session's dedup policy)."""
    entries = F.arrays_zip(keys.alias("k"), values.alias("v"))
    last_only = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(keys, i + 2, F.greatest(F.size(keys), F.lit(1))),
                               lambda x: x == e["k"]))
    built = F.map_from_entries(last_only)
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.when(F.size(keys) == F.size(values), built).otherwise(empty)
