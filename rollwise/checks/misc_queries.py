"""Check queries: rate cards, scalar functions, a generated source, the stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F, types as T

from ..functions.pattern import row_pattern
from ..functions.rates import device_share, revenue_share
from ..functions.timegrid import (BASE_2000, EPOCH, add_minutes, floor_minutes, minute_diff,
                                  round_minutes, trunc, ts_lit)
from ..operators.rates import category_rate_join, device_rate_join, tier_rate_join
from ..session import fresh_path
from ..sources import generator
from ..sources.catalog import inline_values
from ..sources.unified import u_events
from ..streaming.continuous import run_stream
from . import fixtures as fx
from .fixtures import CATEGORY_JSON, NESTED_A, NESTED_B, TIER_JSON
from .queries import catalog, finish

# Fixed rate cards of the checks (tier order matters: the first match wins).
TIERS = [(1, 0.0, 10000.0, 0.10), (2, 10000.0, 50000.0, 0.15), (3, 40000.0, 60000.0, 0.50),
         (4, 50000.0, 0.0, 0.20)]
DEVICES = [(1, "mobile", 0.4), (1, "view", 0.0), (2, "view", 0.3), (2, "click", 0.25),
           (2, "signup", None), (3, "other", 0.1), (3, "signup", 0.6)]


def q_tier_rate_join(spark, sf_dir):
    tiers = inline_values(spark, TIERS, ["tier_no", "range_lower", "range_upper",
                                         "revenue_share"])
    li = catalog(spark, sf_dir).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice")
    return tier_rate_join(li, "l_extendedprice", tiers)


def q_tier_rate_rows(spark, sf_dir):
    """Per-row terms (U5): tiers for flag A, a category object for N, a plain
    number for R; dim = line status (lower case, upper-cased by the rule)."""
    li = catalog(spark, sf_dir).table("lineitem")
    flag = F.col("l_returnflag")
    terms = (F.when(flag == "A", F.lit(TIER_JSON)).when(flag == "N", F.lit(CATEGORY_JSON))
             .otherwise(F.lit("0.25")))
    return li.select("l_orderkey", "l_linenumber",
                     revenue_share(terms, F.lower("l_linestatus"), F.col("l_extendedprice"))
                     .alias("rate"))


def q_category_rate_join(spark, sf_dir):
    """Customers' nation as category; the card lists the nations of regions
    0-2 and an (OTHERS) rate for the rest (J5)."""
    cat = catalog(spark, sf_dir)
    nation = cat.table("nation")
    card = (nation.where(F.col("n_regionkey") < 3)
            .select(F.col("n_name").alias("category"),
                    ((F.col("n_nationkey") + 1) / 100).alias("rate"))
            .unionByName(inline_values(spark, [("(OTHERS)", 0.05)], ["category", "rate"])
                         .select("category", F.col("rate").cast("double"))))
    cust = (cat.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", F.lower("n_name").alias("nation")))
    return category_rate_join(cust, F.col("nation"), card)


def q_device_rate_join(spark, sf_dir):
    """Events' type as device; purchase arrives as 'Smart Phones' (folds to
    mobile), error as 'TABLET' (no entry: other) (J6)."""
    card = inline_values(spark, DEVICES, ["pos", "device", "rate"])
    et = F.col("event_type")
    ev = catalog(spark, sf_dir).table("events").select(
        "event_id", F.when(et == "purchase", "Smart Phones").when(et == "error", "TABLET")
        .otherwise(et).alias("device"))
    return device_rate_join(ev, F.col("device"), card)




def q_device_rate_rows(spark, sf_dir):
    """Per-row nested device terms (U6): items are read in text order; a
    non-numeric rate is skipped; a 0 falls back to ``other``."""
    et = F.col("event_type")
    terms = (F.when(et == "click", F.lit(NESTED_B)).when(et == "purchase", F.lit("0.33"))
             .otherwise(F.lit(NESTED_A)))
    device = (F.when(et == "purchase", "Smart Phones").when(et == "error", "TABLET")
              .otherwise(et))
    ev = catalog(spark, sf_dir).table("events")
    return ev.select("event_id", device_share(terms, device).alias("rate"))


def q_sql_revenue_share(spark, sf_dir):
    """The per-row tier terms of ``tier_rate_rows`` written as SQL text with
    the registered ``revenue_share`` function."""
    from ..functions.sql import register_sql_functions
    register_sql_functions(spark)
    catalog(spark, sf_dir).table("lineitem").createOrReplaceTempView("rw_check_lineitem")
    return spark.sql(
        "SELECT l_orderkey, l_linenumber, revenue_share(CASE l_returnflag "
        f"WHEN 'A' THEN '{TIER_JSON}' WHEN 'N' THEN '{CATEGORY_JSON}' ELSE '0.25' END, "
        "lower(l_linestatus), l_extendedprice) AS rate FROM rw_check_lineitem")


def q_sql_patterns(spark, sf_dir):
    """Masks of the generated registry recomputed in SQL, from names and from
    a JSON flag list (the two registration forms)."""
    from ..functions.sql import register_sql_functions
    register_sql_functions(spark)
    fx.targets_gen(catalog(spark, sf_dir).table("customer")) \
        .createOrReplaceTempView("rw_check_targets")
    return spark.sql(
        "SELECT target_table, data_pattern_names(pattern_columns, "
        "transform(groupby_columns, x -> split_part(x, ':', 2))) AS by_names, "
        "data_pattern_json(to_json(transform(pattern_columns, c -> IF(array_contains("
        "transform(groupby_columns, x -> split_part(x, ':', 2)), c), 1, 0)))) AS by_json "
        "FROM rw_check_targets")


# ---- scalar functions ---------------------------------------------------------

def q_time_floor(spark, sf_dir):
    ev = catalog(spark, sf_dir).table("events")
    ts = F.col("ts")
    return ev.select("event_id", floor_minutes(ts, 5, EPOCH).alias("floor_5"),
                     trunc("hour", ts).alias("hour_start"), trunc("day", ts).alias("day_start"),
                     add_minutes(ts, 90).alias("plus_90"),
                     F.date_format(ts, "yyyy-MM-dd").alias("day_text"))


def q_time_round(spark, sf_dir):
    ev = catalog(spark, sf_dir).table("events")
    ts = F.col("ts")
    return ev.select("event_id", round_minutes(ts, 5, BASE_2000).alias("round_5"),
                     round_minutes(ts, 15, BASE_2000).alias("round_15"),
                     round_minutes(ts, 60, BASE_2000).alias("round_60"))


def q_minute_diff(spark, sf_dir):
    ev = catalog(spark, sf_dir).table("events")
    ts = F.col("ts")
    return ev.select("event_id", minute_diff(ts_lit(BASE_2000), ts).alias("from_base"),
                     minute_diff(ts, ts_lit(dt.datetime(2024, 2, 1))).alias("to_feb"),
                     minute_diff(ts, F.timestamp_add("SECOND", F.lit(90), ts)).alias("next_90s"))


def q_math_scalars(spark, sf_dir):
    li = catalog(spark, sf_dir).table("lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(F.col("l_quantity") * 1.5).alias("q_round"),
                     F.floor("l_extendedprice").cast("bigint").alias("price_floor"),
                     F.abs(F.col("l_discount") - F.lit(0.05)).alias("disc_abs"),
                     (F.col("l_orderkey") % 7).alias("key_mod"),
                     F.pow(F.lit(2.0), F.col("l_linenumber")).alias("pow_2"))


def q_null_scalars(spark, sf_dir):
    ev = catalog(spark, sf_dir).table("events")
    uid = F.col("user_id")
    a2 = F.when(uid % 7 == 0, F.lit("")).otherwise(F.col("event_type"))
    return ev.select("event_id", F.nullif(uid % 16, F.lit(0)).alias("i3"),
                     F.coalesce(F.nullif(a2, F.lit("")), F.lit("none")).alias("a2_or_none"),
                     F.coalesce(F.nullif(uid % 3, F.lit(0)), F.nullif(uid % 5, F.lit(0)),
                                F.lit(-1)).cast("bigint").alias("first_non_zero"))


# ---- generated source and continuous load -------------------------------------------

def q_synth_source(spark, sf_dir):
    """The demo source (S4, F18): as many generated rows as ``events`` has,
    each value a hash of the row's number; pattern set before the write
    (P13); written as a replaced table (S5) in order of pattern and time
    within its files (O2).  The table is written twice: the second replaces."""
    row = F.col("row_no")
    base = generator.rows(spark, catalog(spark, sf_dir).table("events")).select(
        "row_no", add_minutes(ts_lit(dt.datetime(2024, 1, 31)), (-generator.uniform(row, 1, 1, 50000)).cast("int")).alias("data_ts"),
        F.lit(1).cast("bigint").alias("data_i1"), generator.uniform(row, 11, 0, 15).alias("data_i2"),
        F.nullif(generator.uniform(row, 111, 0, 15), F.lit(0)).alias("data_i3"),
        generator.text(row, 2, generator.uniform(row, 22, 1, 10)).alias("data_a1"),
        generator.text(row, 3, generator.uniform(row, 33, 0, 9)).alias("data_a2"),
        F.nullif(generator.text(row, 4, generator.uniform(row, 44, 0, 10)), F.lit("")).alias("data_a3"),
        generator.uniform(row, 10, 0, 50).alias("value_i1"), (generator.uniform(row, 15, 0, 1500) / 10).alias("value_d1"))
    named = base.select(F.lit("synth_source").alias("data_name"), "*")
    pattern = row_pattern(named, [(F.lit(1), T.IntegerType()), "data_name",
                                  (F.to_date("data_ts"), T.DateType()),
                                  (F.hour("data_ts"), T.IntegerType()), "data_ts", "data_i1",
                                  "data_i2", "data_i3", "data_a1", "data_a2", "data_a3"])
    out = named.select(pattern.alias("data_pt"), *base.columns)
    path = fresh_path(spark, "synth_source")
    for part in (out.where("row_no < 10"), out):
        part.repartitionByRange("data_pt", "data_ts").sortWithinPartitions("data_pt", "data_ts").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def q_stream_summary(spark, sf_dir):
    """Continuous load of the daily target from an inbox of files, run with an
    available-now trigger as they arrive: the first half of the events, then
    the rest with late rows of two days far apart, whose chunks are found
    by the index; returns the target table it maintains."""
    t = fx.target_2(name="stream_daily")
    src = fx.src_events(t.target_table)
    events = catalog(spark, sf_dir).table("events")
    inbox = fresh_path(spark, "stream_inbox")
    path, ckpt = fresh_path(spark, "stream_daily"), fresh_path(spark, "stream_ckpt")
    late = F.to_date("ts").isin(dt.date(2024, 1, 3), dt.date(2024, 1, 12)) & (F.col("event_id") % 20 == 0)
    first = (F.col("ts") < F.lit(dt.datetime(2024, 1, 16)).cast("timestamp_ntz")) & ~late
    for part in (first, ~F.coalesce(first, F.lit(False))):
        events.where(part).repartitionByRange(4, "ts").write.mode("append").parquet(inbox)
        run_stream(spark, inbox, events.schema, t, src, None, path, ckpt).awaitTermination()
    return finish(spark.read.parquet(path).drop("control_day"))


QUERIES = {
    "tier_rate_join": q_tier_rate_join,
    "tier_rate_rows": q_tier_rate_rows,
    "category_rate_join": q_category_rate_join,
    "device_rate_join": q_device_rate_join,
    "device_rate_rows": q_device_rate_rows,
    "sql_revenue_share": q_sql_revenue_share,
    "sql_patterns": q_sql_patterns,
    "time_floor": q_time_floor,
    "time_round": q_time_round,
    "minute_diff": q_minute_diff,
    "math_scalars": q_math_scalars,
    "null_scalars": q_null_scalars,
    "synth_source": q_synth_source,
    "stream_summary": q_stream_summary,
}
