"""Property tests (hypothesis): mask algebra, the falsy rule, upsert."""

import math

from hypothesis import example, given, settings, strategies as st
from pyspark.sql import functions as F

from rollwise.functions.pattern import (flags_pattern, flags_to_mask, kept_names, kept_positions,
                                        names_pattern, names_to_mask, row_pattern)
from rollwise.operators.upsert import upsert

NAMES = [f"c{i}" for i in range(14)]


@given(st.lists(st.booleans(), min_size=1, max_size=40))
def test_flags_equal_names(flags):
    cols = [f"c{i}" for i in range(len(flags))]
    kept = [c for c, f in zip(cols, flags) if f]
    m = flags_to_mask(flags)
    assert m == names_to_mask(cols, kept)
    assert [cols[i] for i in kept_positions(m, len(cols))] == kept


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.booleans(), min_size=14, max_size=14), min_size=1, max_size=60))
def test_column_forms_match(spark, rows):
    data = [([int(f) for f in r], [c for c, f in zip(NAMES, r) if f]) for r in rows]
    df = spark.createDataFrame(data, "f array<int>, g array<string>")
    names = F.array(*[F.lit(n) for n in NAMES])
    out = df.select(flags_pattern(F.col("f")).alias("a"), names_pattern(names, F.col("g")).alias("b"),
                    F.col("g"), kept_names(names, flags_pattern(F.col("f"))).alias("k")).collect()
    for (f, g), r in zip(data, out):
        assert r.a == r.b == flags_to_mask(f)
        assert list(r.k) == g


def _falsy(v):
    return v is None or v == 0 or v == "" or v is False or (isinstance(v, float) and math.isnan(v))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)),
                          st.one_of(st.none(), st.sampled_from(["", "a", "0"])),
                          st.one_of(st.none(), st.floats(allow_infinity=False), st.just(0.0)),
                          st.one_of(st.none(), st.booleans())), min_size=1, max_size=60))
def test_row_pattern_matches_falsy_rule(spark, rows):
    df = spark.createDataFrame(rows, "i bigint, s string, d double, b boolean")
    got = df.select(row_pattern(df, df.columns).alias("p")).collect()
    for r, g in zip(rows, got):
        want = sum(8 >> j for j, v in enumerate(r) if _falsy(v))
        assert g.p == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "", None]), st.integers(0, 5)),
                max_size=8, unique_by=lambda t: t[0] or ""),
       st.lists(st.tuples(st.sampled_from(["a", "c", "", None]), st.integers(0, 5)),
                max_size=8, unique_by=lambda t: t[0] or ""))
def test_upsert_is_idempotent_and_overwrites(spark, old, new):
    t = spark.createDataFrame(old, "k string, m bigint")
    b = spark.createDataFrame(new, "k string, m bigint")
    once = upsert(t, b, ["k"], ["m"])
    twice = upsert(once, b, ["k"], ["m"])
    norm = lambda df: sorted(((r.k or ""), r.m) for r in df.collect())
    assert norm(once) == norm(twice)
    got = dict(norm(once))
    for k, m in new:
        assert got[k or ""] == m
    for k, m in old:
        if (k or "") not in {(x or "") for x, _ in new}:
            assert got[k or ""] == m


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 20)),
                          st.one_of(st.none(), st.integers(0, 25)),
                          st.integers(1, 99)), min_size=1, max_size=7))
def test_tier_intervals_first_match(spark, tiers):
    """Range join with overlapping, empty and open tiers equals the first
    matching tier found by brute force."""
    from rollwise.operators.rates import tier_rate_join
    rows = [(i + 1, None if lo is None else float(lo), None if hi is None else float(hi),
             r / 100) for i, (lo, hi, r) in enumerate(tiers)]
    card = spark.createDataFrame(rows, "tier_no int, range_lower double, range_upper double, "
                                 "revenue_share double")
    values = [x / 2 for x in range(-2, 60)]
    vals = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.v: r.rate for r in tier_rate_join(vals, "v", card).collect()}

    def first(v):
        for _, lo, hi, r in rows:
            lo = 0.0 if lo is None else lo
            if lo <= v and (hi is None or hi == 0 or hi > v):
                return r
        return None
    assert got == {v: first(v) for v in values}


@settings(max_examples=5, deadline=None)
@example([(0, 10000, 1), (5, -3, 5)])   # more than one block; begin after end
@given(st.lists(st.tuples(st.integers(0, 20000), st.integers(-100, 30000),
                          st.sampled_from([1, 5, 7, 60, 1440])), min_size=1, max_size=6))
def test_chunk_list_equals_loop(spark, specs):
    """Blocked generation equals ``while tag <= end: tag += size`` for every
    target, including ranges longer than one block and begin after end."""
    import datetime as dt
    from rollwise.plans.registry import chunk_list
    base = dt.datetime(2024, 1, 1)
    rows = [(str(i), base + dt.timedelta(minutes=b), base + dt.timedelta(minutes=b + span), size)
            for i, (b, span, size) in enumerate(specs)]
    df = spark.createDataFrame(rows, "target_table string, batch_loop_begin timestamp_ntz, "
                               "batch_loop_end timestamp_ntz, batch_control_size bigint")
    got = sorted((r.target_table, r.chunk_start) for r in chunk_list(df).collect())
    want = []
    for name, begin, end, size in rows:
        tag = begin
        while tag <= end:
            want.append((name, tag))
            tag += dt.timedelta(minutes=size)
    assert got == sorted(want)
