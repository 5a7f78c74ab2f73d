"""Targets in a lattice: each equals its own aggregate, coarser ones come from finer ones' states."""

from pyspark.sql import functions as F

from rollwise.checks import fixtures as fx
from rollwise.operators.aggregate import aggregate_frame, plan_source
from rollwise.operators.rollup import lattice, rollup_targets
from rollwise.sources.catalog import Catalog
from rollwise.sources.unified import u_events
from tests.conftest import SF


def rows(df):
    return sorted(map(str, df.collect()))


def test_each_target_equals_its_own_aggregate(spark):
    df, src = u_events(Catalog(spark, SF).table("events")), fx.src_events("r")
    targets = [fx.target_1(name="t7"), fx.target_2(name="t1728"), fx.target_1(mask=fx.MASK_4, name="t4"),
               fx.target_1(mask=2047, name="all"), fx.target_1(mask=2047 - 256, name="days")]
    targets[3].aggregate_functions = ["MIN(?)", "COUNT(?)", "MAX(?)", "COALESCE(ROUND(AVG(?), 3), 0) + 1"]
    targets[4].aggregate_functions = ["ROUND(AVG(?), 2)", "COUNT(*)", "STDDEV(?)", "AVG(?)"]  # STDDEV stays apart
    parents = {n.name: n.parent and n.parent.name for n in lattice(df, targets, src)}
    assert parents == {"t4": None, "t7": "t4", "all": "t7", "t1728": None, "days": None}
    got = rollup_targets(df, targets, src)
    for t in targets:
        want = aggregate_frame(df, t, plan_source(t, src))
        mine = got.where(F.col("target_table") == t.target_table).select(
            *[F.col(c).cast(want.schema[c].dataType) for c in want.columns])
        assert rows(mine) == rows(want), t.target_table


def test_rows_are_shuffled_once_per_finest_set(spark):
    df, src = u_events(Catalog(spark, SF).table("events")), fx.src_events("r")
    targets = [fx.target_1(name="t7"), fx.target_2(name="t1728"), fx.target_1(mask=fx.MASK_4, name="t4")]
    plan = rollup_targets(df, targets, src)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
