"""Rate cards as joins: tiers (range join), categories and devices (lookups
with fallback rows).

The warehouse evaluated a rate card per row inside a scalar function.  At
scale the lookup is a join.  A card is reduced on its own first, so each value
matches at most one card row, and written, so that the planner knows its
size: a small card is broadcast and the big side stays where it is, a large
one is shuffled on an equi-join key.  Tiers have such a key, too: a bucket of
the value.  Cards of any size take the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .joins import measured
from .upsert import dense_index

# Fixed values of the rate rules: the spellings that fold to "mobile", the
# fallback category key, the key that blocks it, and the fallback device.
MOBILE_ALIASES = ["phone", "smart phones"]
OTHERS_KEY = "(OTHERS)"
OTHERS_BLOCKER = "(Others)"
OTHER_DEVICE = "other"


def _cover(first: Column, stop: Column, levels: int) -> Column:
    """The nodes (level, at) of a binary tree over fewer than ``2 ** levels``
    cells that make up the cells ``first .. stop - 1``: two per level at most."""
    start = F.struct(first.alias("i"), stop.alias("j"), F.array().cast("array<struct<level:int,at:bigint>>").alias("nodes"))

    def up(acc: Column, level: Column) -> Column:
        i, j = acc["i"], acc["j"]
        node = lambda at: F.array(F.struct(level.cast("int").alias("level"), at.cast("bigint").alias("at")))
        none = F.array().cast("array<struct<level:int,at:bigint>>")
        left = F.when((i < j) & (i % 2 == 1), node(i)).otherwise(none)
        right = F.when((i < j) & (j % 2 == 1), node(j - 1)).otherwise(none)
        return F.struct(F.shiftright(i + 1, 1).alias("i"), F.shiftright(j, 1).alias("j"),
                        F.concat(acc["nodes"], left, right).alias("nodes"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, up)["nodes"]


def tier_intervals(tiers: DataFrame, by: list[str] | None = None, lower: str = "range_lower",
                   upper: str = "range_upper", rate: str = "revenue_share",
                   order: str = "tier_no") -> DataFrame:
    """Disjoint intervals ``[lo, hi)`` with the rate of the *first* tier (by
    ``order``) that covers each one; ``hi`` NULL is open.

    A tier covers ``lower <= v < upper``; a missing or zero upper bound is
    open-ended; a missing lower bound counts as 0.  All cards' endpoints are
    numbered in one order (by ranges, in no single task), which makes the
    space between neighbours the cells, consecutive within a card.  A tier
    that spans many cells is held by the few nodes of a binary tree that
    make it up; each node keeps its first tier, and a cell takes the first
    of the nodes above it.  So the work is n log n for any overlap, and no
    group grows with the card."""
    by = list(by or [])
    end = F.lit(float("inf"))
    t = tiers.select(*by, F.coalesce(F.col(lower), F.lit(0.0)).cast("double").alias("_lo"),
                     F.when(F.col(upper).isNull() | (F.col(upper) == 0), end)
                     .otherwise(F.col(upper)).cast("double").alias("_hi"),
                     F.col(rate).cast("double").alias("_rate"), F.col(order).alias("_ord"))
    t = measured(t.where(F.col("_lo") < F.col("_hi")), "tiers")
    bounds = t.select(*by, F.col("_lo").alias("b")).union(t.select(*by, F.col("_hi").alias("b"))).distinct()
    cells = measured(dense_index(bounds, [*by, "b"], base=-1, name="i"), "cells")
    levels = cells.count().bit_length()
    starts = cells.select(*by, F.col("b").alias("_lo"), F.col("i").alias("_first"))
    ends = cells.select(*by, F.col("b").alias("_hi"), F.col("i").alias("_stop"))
    nodes = (t.join(starts, [*by, "_lo"]).join(ends, [*by, "_hi"])
             .select("_rate", "_ord", F.explode(_cover(F.col("_first"), F.col("_stop"), levels)).alias("n"))
             .groupBy("n.level", "n.at").agg(F.min(F.struct("_ord", "_rate")).alias("best")))
    above = cells.select("i", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")) \
        .withColumn("at", F.expr("shiftright(i, level)"))
    # Exploded sides are larger than the planner believes: never broadcast.
    first = above.join(nodes.hint("merge"), ["level", "at"]).groupBy("i").agg(F.min("best").alias("best"))
    follows = cells.select((F.col("i") - 1).alias("i"), F.col("b").alias("hi"))  # a covered cell has a right end
    return (cells.join(first.hint("merge"), "i").join(follows, "i")
            .select(*by, F.col("b").alias("lo"), F.nullif("hi", end).alias("hi"), F.col("best._rate").alias("rate")))


def _scaled(v: Column) -> Column:
    """Rising in ``v``, by the order of magnitude."""
    return F.signum(v) * F.log1p(F.abs(v))


def tier_rate_join(df: DataFrame, value: str, tiers: DataFrame, by: list[str] | None = None,
                   out: str = "rate", **names) -> DataFrame:
    """Rate of the first tier containing ``value`` (J4); NULL when no tier does
    or the value is NULL.

    A card's scale is cut into as many buckets as it has intervals; an
    interval is listed in each bucket it reaches, which adds at most one
    entry a bucket as intervals are disjoint, and a value looks in its own.
    The bucket is rising in the value on both sides, so the bounds decide
    exactly within it.  Both joins are equi-joins."""
    by = list(by or [])
    iv = measured(tier_intervals(tiers, by, **names), "intervals")
    top = F.coalesce("hi", "lo")  # the last, open interval ends in the last bucket
    scale = (iv.groupBy(*[F.col(k).alias(f"_c_{k}") for k in by])
             .agg(F.min(_scaled(F.col("lo"))).alias("_from"), F.max(_scaled(top)).alias("_to"), F.count("*").alias("_n")))

    def bucket(v: Column) -> Column:
        share = F.when(F.isnan(v), F.lit(1.0)).otherwise(  # NaN is above all numbers, as Spark orders them
            (_scaled(v) - F.col("_from")) / F.greatest(F.col("_to") - F.col("_from"), F.lit(1e-300)))
        return F.least(F.greatest(F.floor(share * F.col("_n")), F.lit(0)), F.col("_n") - 1).cast("bigint")

    if by:
        scale = measured(scale, "scales")
        on = lambda d: [d[k] == F.col(f"_c_{k}") for k in by]
        scaled, held = df.join(scale, on(df), "left"), iv.join(scale, on(iv))
    else:
        row = scale.first()  # one row: an aggregate without keys
        add = {c: F.lit(row[c]).cast("bigint" if c == "_n" else "double") for c in ("_from", "_to", "_n")}
        scaled, held = df.withColumns(add), iv.withColumns(add)
    v = F.col(value).cast("double")
    scaled = scaled.withColumn("_bucket", bucket(v)).drop("_from", "_to", "_n", *[f"_c_{k}" for k in by])
    last = F.when(F.col("hi").isNull(), F.col("_n") - 1).otherwise(bucket(F.col("hi")))
    held = held.select(*[F.col(k).alias(f"_c_{k}") for k in by], F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                       F.col("rate").alias("_rate"), F.explode(F.sequence(bucket(F.col("lo")), last)).alias("_at"))
    held = measured(held, "buckets")
    cond = [F.col(k) == F.col(f"_c_{k}") for k in by] + [
        F.col("_bucket") == F.col("_at"), v >= F.col("_lo"), F.col("_hi").isNull() | (v < F.col("_hi"))]
    found = scaled.join(held, on=cond, how="left")
    return found.withColumn(out, F.col("_rate")).drop(*[f"_c_{k}" for k in by], "_bucket", "_lo", "_hi", "_rate", "_at")


def category_rate_join(df: DataFrame, dim: Column, card: DataFrame, by: list[str] | None = None,
                       category: str = "category", rate: str = "rate",
                       out: str = "rate") -> DataFrame:
    """Rate at the upper-cased ``dim`` (J5).  When the card has no entry for it,
    the ``(OTHERS)`` rate applies, unless the card also has an ``(Others)``
    entry, which blocks the fallback.  A present entry with a NULL (not
    numeric) rate gives NULL.

    Without card keys the fallback is one value of the (bounded) card; with
    card keys it is one row per card, joined on the card key."""
    by = list(by or [])
    hit = card.select(*[F.col(k).alias(f"_h_{k}") for k in by], F.col(category).alias("_cat"),
                      F.col(rate).cast("double").alias("_hit_rate"), F.lit(True).alias("_hit"))
    fallback = [F.max(F.when(F.col(category) == OTHERS_KEY, F.col(rate).cast("double")))
                .alias("_oth"),
                F.max((F.col(category) == OTHERS_BLOCKER).cast("int")).alias("_blocked")]
    base = df.withColumn("_rw_dim", F.upper(dim))
    j = base.join(measured(hit, "card"), on=[F.col(k) == F.col(f"_h_{k}") for k in by]
                  + [F.col("_rw_dim") == F.col("_cat")], how="left")
    if by:
        fb = card.groupBy(*by).agg(*fallback).select(
            *[F.col(k).alias(f"_f_{k}") for k in by], "_oth", "_blocked")
        j = j.join(measured(fb, "card"), on=[F.col(k) == F.col(f"_f_{k}") for k in by], how="left")
        oth, blocked = F.col("_oth"), F.coalesce(F.col("_blocked"), F.lit(0))
    else:
        row = card.agg(*fallback).first()
        oth = F.lit(row["_oth"]).cast("double")
        blocked = F.lit(int(row["_blocked"] or 0))
    val = F.when(F.col("_hit").isNotNull(), F.col("_hit_rate")).when(blocked == 0, oth)
    drop = ([f"_h_{k}" for k in by] + [f"_f_{k}" for k in by]
            + ["_cat", "_hit_rate", "_hit", "_oth", "_blocked", "_rw_dim"])
    return j.withColumn(out, val).drop(*[c for c in drop if c in j.columns])


def fold_device(dim: Column) -> Column:
    """Lower-case; the mobile aliases become ``mobile``."""
    d = F.lower(dim)
    return F.when(d.isin(*MOBILE_ALIASES), F.lit("mobile")).otherwise(d)


def device_rate_join(df: DataFrame, dim: Column, card: DataFrame, by: list[str] | None = None,
                     pos: str = "pos", device: str = "device", rate: str = "rate",
                     out: str = "rate") -> DataFrame:
    """Device rate (J6): the first item (by ``pos``) with a numeric rate for
    the folded device; if none, or that rate is 0, the first numeric
    ``other`` rate (a 0 with no ``other`` stays 0)."""
    by = list(by or [])
    first = (card.where(F.col(rate).isNotNull())
             .groupBy(*by, F.col(device).alias("_dev"))
             .agg(F.min_by(F.col(rate).cast("double"), F.col(pos)).alias("_dev_rate")))
    first = measured(first, "card")
    dev = first.select(*[F.col(k).alias(f"_d_{k}") for k in by], "_dev", "_dev_rate")
    base = df.withColumn("_rw_dim", fold_device(dim))
    j = base.join(dev, on=[F.col(k) == F.col(f"_d_{k}") for k in by]
                  + [F.col("_rw_dim") == F.col("_dev")], how="left")
    others = first.where(F.col("_dev") == OTHER_DEVICE)
    if by:
        oth_df = others.select(*[F.col(k).alias(f"_o_{k}") for k in by],
                               F.col("_dev_rate").alias("_oth"))
        j = j.join(oth_df, on=[F.col(k) == F.col(f"_o_{k}") for k in by],
                   how="left")
        oth = F.col("_oth")
    else:
        row = others.select("_dev_rate").first()   # at most one row: the card's other
        oth = F.lit(row["_dev_rate"] if row else None).cast("double")
    r = F.col("_dev_rate")
    val = F.when(r.isNotNull() & (r != 0), r).when(oth.isNotNull(), oth).otherwise(r)
    drop = ([f"_d_{k}" for k in by] + [f"_o_{k}" for k in by]
            + ["_dev", "_dev_rate", "_oth", "_rw_dim"])
    return j.withColumn(out, val).drop(*[c for c in drop if c in j.columns])
