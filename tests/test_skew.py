"""A hot key holding a third of the rows: results stay whole and exact."""

import datetime as dt

from pyspark.sql import functions as F

from rollwise.checks import fixtures as fx
from rollwise.plans.incremental import range_batch
from rollwise.sources.catalog import Catalog
from rollwise.sources.unified import u_events


def test_hot_key_aggregation_is_exact(spark):
    cat = Catalog(spark, "/root/testdata/sf0.01")
    ev = cat.table("events")
    # A third of the rows collapse onto one user and one type.
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1))
                        .otherwise(F.col("user_id"))) \
            .withColumn("event_type", F.when(F.col("event_id") % 3 == 0, F.lit("hot"))
                        .otherwise(F.col("event_type")))
    cat = cat.with_table("events", hot)
    t = fx.target_2()
    b = range_batch(cat, t, [fx.src_events(t.target_table)], dt.datetime(2024, 1, 1),
                    dt.datetime(2024, 1, 30))
    got = b.frame.agg(F.sum("vsum_i1"), F.sum(F.when(F.col("data_a1") == "hot", 1))).first()
    u = u_events(hot)
    assert got[0] == u.agg(F.sum("value_i1")).first()[0]
    days = u.where(F.col("data_a1") == "hot").select(
        "data_date", "data_i2", "data_i3", "data_a2").distinct().count()
    assert got[1] == days
