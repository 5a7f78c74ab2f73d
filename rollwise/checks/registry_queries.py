"""Check queries over the generated registry (targets from ``customer``,
sources from ``orders``), so registry operators are table-sized."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.pattern import (column_map, flags_pattern, kept_names, mapping_sources,
                                 mapping_targets, names_pattern)
from ..functions.timegrid import add_minutes, ts_lit
from ..operators.upsert import upsert_registry
from ..plans import registry as R
from . import fixtures as fx
from .queries import catalog


def _reg(spark, sf_dir):
    cat = catalog(spark, sf_dir)
    return cat, fx.targets_gen(cat.table("customer")), fx.sources_gen(cat.table("orders"))


def q_enabled_sources(spark, sf_dir):
    _, t, s = _reg(spark, sf_dir)
    return R.effective_sources(t, s, "enabled").select(
        "target_table", "source_table", "batch_control_size", "effective_pattern", "compatible")


def q_sources_under_test(spark, sf_dir):
    _, t, s = _reg(spark, sf_dir)
    return R.effective_sources(t, s, "test").select(
        "target_table", "source_table", "batch_control_size", "effective_pattern", "compatible")


def q_effective_mask(spark, sf_dir):
    _, t, s = _reg(spark, sf_dir)
    e = R.effective_sources(t, s, None)
    return e.select("target_table", "source_table", "groupby_pattern", "pattern_default",
                    "effective_pattern",
                    (F.bit_count("effective_pattern") - F.bit_count("groupby_pattern"))
                    .cast("bigint").alias("added_bits"))


def q_granularity_gate(spark, sf_dir):
    _, t, s = _reg(spark, sf_dir)
    e = R.effective_sources(t, s, None)
    reason = (F.when(F.col("groupby_pattern") == F.col("effective_pattern"), "same")
              .when(F.col("groupby_flexible"), "flexible").otherwise("coarser source"))
    return e.select("target_table", "source_table", F.col("compatible").alias("accepted"),
                    reason.alias("reason"))


def q_due_targets(spark, sf_dir):
    _, t, _ = _reg(spark, sf_dir)
    return R.due_targets(t, fx.NOW).select("target_table", "batch_schedule_type",
                                           "batch_loop_begin", "batch_loop_end")


def q_chunk_list(spark, sf_dir):
    _, t, _ = _reg(spark, sf_dir)
    return R.chunk_list(R.due_targets(t, fx.NOW)).select("target_table", "chunk_start")


def q_complete_chunks(spark, sf_dir):
    """The due chunks that have ended and that all live sources cover."""
    _, t, s = _reg(spark, sf_dir)
    s = s.withColumn("data_availabletime", F.when(F.col("id") % 11 != 0, add_minutes(
        ts_lit(fx.GEN_BASE), (F.col("id") * 37 % 20000).cast("int"))))
    held = R.covered_bounds(R.due_targets(t, fx.NOW), s, fx.NOW)
    return R.chunk_list(held).select("target_table", "chunk_start")


def q_advance_watermark(spark, sf_dir):
    _, t, s = _reg(spark, sf_dir)
    return R.advance_watermark(t, s).select("target_table", "batch_processed",
                                            "batch_processing", "batch_microchunk_current")


def q_state_after_run(spark, sf_dir):
    _, t, s = _reg(spark, sf_dir)
    return R.state_after_run(t, s, fx.NOW).select(
        "target_table", "batch_processed", "batch_processing", "batch_microchunk_current",
        "batch_schedule_last")


def q_source_availability(spark, sf_dir):
    cat, t, s = _reg(spark, sf_dir)
    latest = (cat.table("lineitem")
              .groupBy(F.col("l_orderkey").cast("string").alias("source_table"))
              .agg(F.max("l_shipdate").alias("latest_ts")))
    return R.source_availability(s, latest, t).select("target_table", "source_table",
                                                      "data_availabletime")


def q_set_enabled(spark, sf_dir):
    """Enable the parked sources of every target whose customer is in the
    AUTOMOBILE segment (an update driven by a join, M6/P9)."""
    cat, _, s = _reg(spark, sf_dir)
    seg = cat.table("customer").select(F.col("c_custkey").cast("string").alias("target_table"),
                                       "c_mktsegment")
    j = s.join(seg, "target_table", "left")
    out = R.set_enabled(j, True, (F.col("c_mktsegment") == "AUTOMOBILE")
                        & F.col("source_enabled").isNull())
    return out.select("target_table", "source_table", "source_enabled")


def q_registry_upsert(spark, sf_dir):
    """Upsert one target spec per supplier into the customer registry: matched
    targets keep their id, new ones continue after the maximum id."""
    cat, t, _ = _reg(spark, sf_dir)
    sup = cat.table("supplier").select((F.col("s_suppkey") * 20).alias("k"), "s_name")
    incoming = fx.registry_targets(sup, "k", "s_name", prefix="supplier ")
    out = upsert_registry(t, incoming, ["target_table"])
    return out.select("id", "target_table", "target_label", "batch_control_size",
                      "batch_schedule_type", "groupby_pattern", "groupby_flexible")


def q_registry_sources_upsert(spark, sf_dir):
    """Upsert sources by (target, source) (M3): urgent orders' sources are
    reconfigured; one new source per customer (its nation feed) is added with
    the next ids in key order."""
    cat, _, s = _reg(spark, sf_dir)
    urgent = cat.table("orders").where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").cast("string").alias("target_table"),
        F.col("o_orderkey").cast("string").alias("source_table"),
        F.lit(False).alias("source_enabled"), F.lit(0).cast("bigint").alias("pattern_default"))
    feeds = cat.table("customer").select(
        F.col("c_custkey").cast("string").alias("target_table"),
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("source_table"),
        F.lit(None).cast("boolean").alias("source_enabled"),
        F.lit(16).cast("bigint").alias("pattern_default"))
    out = upsert_registry(s, urgent.unionByName(feeds), ["target_table", "source_table"])
    return out.select("id", "target_table", "source_table", "source_enabled", "pattern_default")


def q_registry_from_json(spark, sf_dir):
    """Targets registered from JSON text, with the mask given as a flag list
    (1 = grouped): parsed back, the mask must equal the generating one."""
    _, t, _ = _reg(spark, sf_dir)
    src = mapping_sources(F.col("groupby_columns"))
    flags = F.transform(F.col("pattern_columns"),
                        lambda c: F.when(F.array_contains(src, c), 1).otherwise(0))
    with_flags = t.withColumn("groupby_flags", F.to_json(flags))
    text = with_flags.select("target_table", "groupby_flags", *[
        F.to_json(with_flags[c]).alias(c) for c in (
            "pattern_columns", "groupby_columns", "aggregate_columns", "aggregate_functions")])
    parsed = R.parse_registry_text(text)
    return parsed.select("target_table", "groupby_pattern",
                         F.size("groupby_columns").cast("bigint").alias("n_groupby"))


def q_mapping_split(spark, sf_dir):
    _, t, _ = _reg(spark, sf_dir)
    return R.mapping_columns(t).select(
        "target_table", F.array_join("target_dims", ",").alias("target_dims"),
        F.array_join("source_dims", ",").alias("source_dims"))


def q_pattern_from_flags(spark, sf_dir):
    """Flags (1 = column grouped) rebuilt from each target's lists, then folded
    back into a mask: must equal the registered mask."""
    _, t, _ = _reg(spark, sf_dir)
    src = mapping_sources(F.col("groupby_columns"))
    flags = F.transform(F.col("pattern_columns"),
                        lambda c: F.when(F.array_contains(src, c), 1).otherwise(0))
    return t.select("target_table", flags_pattern(flags).alias("pattern"))


def q_pattern_from_names(spark, sf_dir):
    _, t, _ = _reg(spark, sf_dir)
    return t.select("target_table",
                    names_pattern(F.col("pattern_columns"),
                                  mapping_sources(F.col("groupby_columns"))).alias("pattern"))


def q_mask_columns(spark, sf_dir):
    _, t, _ = _reg(spark, sf_dir)
    return t.select("target_table", F.array_join(
        kept_names(F.col("pattern_columns"), F.col("groupby_pattern")), ",").alias("kept_columns"))


def q_column_map(spark, sf_dir):
    """Target dim -> source dim maps.  HOURLY targets get a source list one
    short (unequal -> empty map); DAILY ones get a repeated key appended
    (last value wins)."""
    _, t, _ = _reg(spark, sf_dir)
    keys = mapping_targets(F.col("groupby_columns"))
    vals = mapping_sources(F.col("groupby_columns"))
    typ = F.col("batch_schedule_type")
    vals = (F.when(typ == "HOURLY", F.slice(vals, 1, F.greatest(F.size(vals) - 1, F.lit(0))))
            .when(typ == "DAILY", F.concat(vals, F.array(F.lit("dup")))).otherwise(vals))
    keys = F.when(typ == "DAILY", F.concat(keys, F.array(F.lit("data_pt")))).otherwise(keys)
    m = t.select("target_table", column_map(keys, vals).alias("m"))
    return m.select("target_table", F.explode("m").alias("map_key", "map_value"))


QUERIES = {
    "enabled_sources": q_enabled_sources,
    "sources_under_test": q_sources_under_test,
    "effective_mask": q_effective_mask,
    "granularity_gate": q_granularity_gate,
    "due_targets": q_due_targets,
    "chunk_list": q_chunk_list,
    "complete_chunks": q_complete_chunks,
    "advance_watermark": q_advance_watermark,
    "state_after_run": q_state_after_run,
    "source_availability": q_source_availability,
    "set_enabled": q_set_enabled,
    "registry_upsert": q_registry_upsert,
    "registry_sources_upsert": q_registry_sources_upsert,
    "registry_from_json": q_registry_from_json,
    "mapping_split": q_mapping_split,
    "pattern_from_flags": q_pattern_from_flags,
    "pattern_from_names": q_pattern_from_names,
    "mask_columns": q_mask_columns,
    "column_map": q_column_map,
}
