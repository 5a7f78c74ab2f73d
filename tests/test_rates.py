"""Rate cards: per-row JSON forms and join forms, edge rows of FIXTURES §4."""

from pyspark.sql import Row, functions as F

from rollwise.functions.rates import device_share, revenue_share
from rollwise.operators.rates import category_rate_join, device_rate_join, tier_rate_join

TIERS = '[{"RANGE_LOWER":0,"RANGE_UPPER":10,"REVENUE_SHARE":0.2},' \
        '{"RANGE_LOWER":10,"REVENUE_SHARE":0.3}]'


def share(spark, terms, dim, value):
    df = spark.createDataFrame([(terms, dim, value)], "t string, d string, v double")
    return df.select(revenue_share(F.col("t"), F.col("d"), F.col("v")).alias("r")).first().r


def test_revenue_share_rows(spark):
    assert share(spark, TIERS, None, 10.0) == 0.3            # half-open tiers
    assert share(spark, TIERS, None, 5.0) == 0.2
    assert share(spark, TIERS, None, -1.0) is None           # no tier -> NULL
    assert share(spark, TIERS, None, None) is None           # tiers with NULL value
    assert share(spark, '[{"RANGE_LOWER":0,"RANGE_UPPER":0,"REVENUE_SHARE":0.4}]', None,
                 1e9) == 0.4                                  # upper 0 is open
    assert share(spark, '{"US":0.3}', "us", None) == 0.3      # upper-cased dim
    assert share(spark, '{"(OTHERS)":0.1}', "fr", None) == 0.1
    assert share(spark, '{"(Others)":0.1,"(OTHERS)":0.2}', "fr", None) is None
    assert share(spark, '{"US":"x","(OTHERS)":0.2}', "us", None) is None
    assert share(spark, "0.25", "any", 3.0) == 0.25


def dev(spark, terms, d):
    df = spark.createDataFrame([(terms, d)], "t string, d string")
    return df.select(device_share(F.col("t"), F.col("d")).alias("r")).first().r


def test_device_share_rows(spark):
    assert dev(spark, '{"a":{"mobile":[0.4]}}', "Smart Phones") == 0.4
    assert dev(spark, '{"a":{"tv":[0]},"b":{"other":[0.1]}}', "TV") == 0.1
    assert dev(spark, '{"b":{"tv":[0.7]},"a":{"tv":[0.5]}}', "tv") == 0.7   # text order
    assert dev(spark, '{"a":{"tv":[0]}}', "tv") == 0.0
    assert dev(spark, "0.25", "tv") == 0.25


def test_tier_join_first_match_with_overlaps(spark):
    tiers = spark.createDataFrame([(1, 0.0, 10.0, 0.2), (2, 5.0, 20.0, 0.9), (3, 10.0, None, 0.3)],
                                  "tier_no int, range_lower double, range_upper double, "
                                  "revenue_share double")
    vals = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 7.0, 10.0, 15.0, 25.0, None)],
                                 "v double")
    got = {r.v: r.rate for r in tier_rate_join(vals, "v", tiers).collect()}
    assert got == {-1.0: None, 0.0: 0.2, 7.0: 0.2, 10.0: 0.9, 15.0: 0.9, 25.0: 0.3, None: None}


def test_category_join_fallback_and_blocker(spark):
    card = spark.createDataFrame([("US", 0.3), ("(OTHERS)", 0.1)], "category string, rate double")
    dims = spark.createDataFrame([("us",), ("fr",), (None,)], "d string")
    got = {r.d: r.rate for r in category_rate_join(dims, F.col("d"), card).collect()}
    assert got == {"us": 0.3, "fr": 0.1, None: 0.1}
    blocked = card.unionByName(spark.createDataFrame([("(Others)", 0.5)], "category string, "
                                                     "rate double"))
    got = {r.d: r.rate for r in category_rate_join(dims, F.col("d"), blocked).collect()}
    assert got["fr"] is None


def test_device_join_zero_falls_to_other(spark):
    card = spark.createDataFrame([(1, "mobile", 0.4), (1, "tv", 0.0), (2, "other", 0.1)],
                                 "pos int, device string, rate double")
    dims = spark.createDataFrame([("Phone",), ("TV",), ("radio",)], "d string")
    got = {r.d: r.rate for r in device_rate_join(dims, F.col("d"), card).collect()}
    assert got == {"Phone": 0.4, "TV": 0.1, "radio": 0.1}


def test_keyed_cards(spark):
    """Each row carries its card key; lookups join on it (no nested loop)."""
    tiers = spark.createDataFrame([("a", 1, 0.0, 10.0, 0.2), ("a", 2, 10.0, None, 0.3),
                                   ("b", 1, 0.0, None, 0.9)],
                                  "card string, tier_no int, range_lower double, "
                                  "range_upper double, revenue_share double")
    vals = spark.createDataFrame([("a", 5.0), ("a", 50.0), ("b", 5.0), ("c", 5.0)],
                                 "card string, v double")
    out = tier_rate_join(vals, "v", tiers, by=["card"])
    assert {(r.card, r.v): r.rate for r in out.collect()} == {
        ("a", 5.0): 0.2, ("a", 50.0): 0.3, ("b", 5.0): 0.9, ("c", 5.0): None}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan

    cats = spark.createDataFrame([("a", "US", 0.3), ("a", "(OTHERS)", 0.1), ("b", "US", 0.5),
                                  ("b", "(Others)", 0.0), ("b", "(OTHERS)", 0.2)],
                                 "card string, category string, rate double")
    dims = spark.createDataFrame([("a", "us"), ("a", "fr"), ("b", "fr")], "card string, d string")
    got = {(r.card, r.d): r.rate
           for r in category_rate_join(dims, F.col("d"), cats, by=["card"]).collect()}
    assert got == {("a", "us"): 0.3, ("a", "fr"): 0.1, ("b", "fr"): None}

    devs = spark.createDataFrame([("a", 1, "tv", 0.0), ("a", 2, "other", 0.1),
                                  ("b", 1, "tv", 0.7)],
                                 "card string, pos int, device string, rate double")
    rows = spark.createDataFrame([("a", "TV"), ("b", "TV"), ("b", "radio")],
                                 "card string, d string")
    got = {(r.card, r.d): r.rate
           for r in device_rate_join(rows, F.col("d"), devs, by=["card"]).collect()}
    assert got == {("a", "TV"): 0.1, ("b", "TV"): 0.7, ("b", "radio"): None}


def brute_rate(tiers, v):
    for lower, upper, rate in tiers:
        if v is not None and (lower or 0.0) <= v and (not upper or upper > v):
            return rate
    return None


def test_random_tiers_match_brute_force(spark):
    import random
    rnd = random.Random(4)
    cards = {c: [(rnd.choice([None, 0.0, -5.0, rnd.uniform(-50, 50), 10 ** rnd.uniform(-3, 6)]),
                  rnd.choice([None, 0.0, rnd.uniform(-60, 60), 10 ** rnd.uniform(-3, 7)]), rnd.random())
                 for _ in range(n)] for c, n in (("a", 1), ("b", 2), ("c", 60), ("d", 400))}
    schema = "card string, tier_no int, range_lower double, range_upper double, revenue_share double"
    tiers = spark.createDataFrame([(c, i, *t) for c, ts in cards.items() for i, t in enumerate(ts)], schema)
    ends = [x for ts in cards.values() for t in ts for x in t[:2] if x is not None]
    values = ends + [rnd.uniform(-70, 70) for _ in range(300)] + [10 ** rnd.uniform(-4, 8) for _ in range(300)] + [None, 0.0, -1e300, 1e300]
    rows = [(c, v) for c in (*cards, "none") for v in values]
    got = tier_rate_join(spark.createDataFrame(rows, "card string, v double"), "v", tiers, by=["card"])
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, got.select("card", "v", "rate").collect())) == sorted(
        str(Row(card=c, v=v, rate=brute_rate(cards.get(c, []), v))) for c, v in rows)
    one = tier_rate_join(spark.createDataFrame([(v,) for v in values], "v double"), "v", tiers.where("card = 'd'").drop("card"))
    assert "NestedLoop" not in one._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, one.collect())) == sorted(str(Row(v=v, rate=brute_rate(cards["d"], v))) for v in values)
    assert {r.rate for r in tier_rate_join(one.drop("rate"), "v", tiers.where("false").drop("card")).collect()} == {None}


def test_a_hundred_thousand_nested_tiers(spark):
    """Tier i covers [i, 200,000 - i): all overlap; the first that holds a value is found."""
    n = 100_000
    i = F.col("id").cast("double")
    tiers = spark.range(n).select((n - F.col("id")).alias("tier_no"), i.alias("range_lower"), (2.0 * n - i).alias("range_upper"),
                                  i.alias("revenue_share"))
    vals = spark.range(0, 2 * n, 7).select((F.col("id") + 0.5).cast("double").alias("v"))
    out = tier_rate_join(vals, "v", tiers)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    # The tier of least number is the innermost one around v.
    inner = F.least(F.floor("v"), F.floor(F.lit(2.0 * n) - F.col("v")), F.lit(n - 1)).cast("double")
    assert out.where(~F.col("rate").eqNullSafe(inner)).count() == 0 and out.count() == vals.count()


KEYS = ['A"B', "]", "A\\B", "", "A'B", "$", "A.B", "É", "(OTHERS)", "(Others)", "x\ty"]


def test_any_key_in_terms(spark):
    """Column and SQL forms give what Python gives, whatever the keys hold."""
    import json
    import random
    from rollwise.functions.sql import register_sql_functions
    register_sql_functions(spark)
    rnd = random.Random(7)
    rate = lambda: rnd.choice([0.5, 0, 2, "0.1", None, True, {"a": 1}])
    flat = [{k.upper() if k != "(Others)" else k: rate() for k in rnd.sample(KEYS, rnd.randint(0, 5))} for _ in range(150)]
    deep = [{k: {d.lower(): rnd.choice([[rate()], [], 3]) for d in rnd.sample(KEYS + ["mobile", "other"], rnd.randint(0, 4))}
             for k in rnd.sample(KEYS, rnd.randint(0, 4))} for _ in range(150)]
    dims = KEYS + [None, "phone", "a\"b"]
    rows = [(json.dumps(f), json.dumps(g), rnd.choice(dims)) for f, g in zip(flat, deep) for _ in range(3)]
    number = lambda x: float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else None

    def flat_rate(terms, dim):
        o = json.loads(terms)
        if dim is not None and dim.upper() in o:
            return number(o[dim.upper()])
        x = None if "(Others)" in o else o.get("(OTHERS)")
        return float(x) if isinstance(x, str) else 1.0 if x is True else number(x)

    def deep_rate(terms, dim):
        d = None if dim is None else "mobile" if dim.lower() in ("phone", "smart phones") else dim.lower()
        first = lambda key: next((number(i[key][0]) for i in json.loads(terms).values()
                                  if isinstance(i.get(key), list) and i[key] and number(i[key][0]) is not None), None)
        dev, oth = first(d), first("other")
        return dev if dev else oth if oth is not None else dev

    df = spark.createDataFrame(rows, "f string, g string, d string")
    got = df.select("f", "g", "d", revenue_share(F.col("f"), F.col("d"), F.lit(1.0)).alias("a"), F.expr("revenue_share(f, d, 1D)").alias("b"),
                    device_share(F.col("g"), F.col("d")).alias("x"), F.expr("revenue_share_device(g, d)").alias("y")).collect()
    for r in got:
        assert r.a == r.b == flat_rate(r.f, r.d), r
        assert r.x == r.y == deep_rate(r.g, r.d), r


def test_tier_without_a_lower_bound(spark):
    assert share(spark, '[{"RANGE_UPPER":9,"REVENUE_SHARE":1},{"RANGE_LOWER":null,"REVENUE_SHARE":2}]', None, 5.0) == 2.0
