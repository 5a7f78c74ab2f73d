"""Mask algebra and row patterns."""

import datetime as dt

from pyspark.sql import functions as F, types as T

from rollwise.functions.pattern import (column_map, flags_pattern, flags_to_mask, kept_names,
                                        kept_positions, names_pattern, names_to_mask,
                                        row_pattern)
from rollwise.checks import fixtures as fx

# The demo's 21-column check (flags, pattern columns, group-by
# columns); flags and names must give the same mask.
FLAGS_21 = [1, 1, 0, 0, 1, 1, 0, 0, 0, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0]
PATTERN_21 = ["DATA_PATTERN", "DATA_DATE", "DATA_HOUR", "DATA_TIME", "BUSINESS_UNIT",
              "BUSINESS_UNIT_DETAIL", "PROPERTY_TYPE", "PROPERTY_DETAIL", "PLACEMENT", "PROVIDER",
              "NETWORK", "ACCOUNT", "PARTNER_TAG", "TYPE_TAG", "CHANNEL", "PRODUCT", "MARKET",
              "COUNTRY", "DEVICE", "BIDDER", "CONTRACT"]
GROUPBY_8 = ["DATA_PATTERN", "DATA_DATE", "BUSINESS_UNIT", "BUSINESS_UNIT_DETAIL", "PROVIDER",
             "NETWORK", "ACCOUNT", "PARTNER_TAG"]


def test_golden_flags_and_names():
    assert flags_to_mask(FLAGS_21) == 422143
    assert names_to_mask(PATTERN_21, GROUPBY_8) == 422143


def test_demo_masks():
    assert fx.MASK_1 == 7
    assert fx.MASK_2 == 1728
    assert kept_positions(7, 11) == list(range(8))


def test_column_forms_match_driver_forms(spark):
    df = spark.createDataFrame([(FLAGS_21, PATTERN_21, GROUPBY_8)],
                               "f array<int>, p array<string>, g array<string>")
    r = df.select(flags_pattern(F.col("f")).alias("a"),
                  names_pattern(F.col("p"), F.col("g")).alias("b"),
                  F.array_join(kept_names(F.col("p"), F.lit(422143)), ",").alias("k")).first()
    assert r.a == 422143 and r.b == 422143
    assert r.k.split(",") == GROUPBY_8


def test_row_pattern_falsy_rule(spark):
    # (1,'x',date,0,ts,1,0,NULL,'a','',NULL): hour 0, int 0, NULL, '' absent -> 155
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("one", T.IntegerType()), ("name", T.StringType()), ("d", T.DateType()),
        ("h", T.IntegerType()), ("ts", T.TimestampNTZType()), ("i1", T.LongType()),
        ("i2", T.LongType()), ("i3", T.LongType()), ("a1", T.StringType()),
        ("a2", T.StringType()), ("a3", T.StringType())]])
    row = (1, "x", dt.date(2024, 1, 1), 0, dt.datetime(2024, 1, 1), 1, 0, None, "a", "", None)
    df = spark.createDataFrame([row], schema)
    assert df.select(row_pattern(df, df.columns).alias("p")).first().p == 155


def test_row_pattern_nan_and_false(spark):
    df = spark.createDataFrame([(float("nan"), False, 2.5, True)], "a double, b boolean, "
                               "c double, d boolean")
    assert df.select(row_pattern(df, df.columns).alias("p")).first().p == 0b1100


def test_column_map_rules(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["1", "2", "3"]), (["a", "b"], ["1"])],
                               "k array<string>, v array<string>")
    rows = df.select(column_map(F.col("k"), F.col("v")).alias("m")).collect()
    assert rows[0].m == {"a": "3", "b": "2"}       # repeated key: last wins
    assert rows[1].m == {}                          # unequal lengths: empty
