"""SQL-bodied functions equal the Column forms."""

import json

from pyspark.sql import functions as F

from rollwise.functions.rates import device_share, revenue_share
from rollwise.functions.sql import register_sql_functions
from tests.test_pattern import FLAGS_21, GROUPBY_8, PATTERN_21


def test_patterns_in_sql(spark):
    register_sql_functions(spark)
    flags = json.dumps(FLAGS_21)
    obj = json.dumps({"pattern_columns": PATTERN_21, "groupby_columns": GROUPBY_8})
    r = spark.sql(f"SELECT data_pattern_json('{flags}') a, data_pattern_json('{obj}') b, "
                  f"data_pattern_flags(array({','.join(map(str, FLAGS_21))})) c, "
                  "column_map(array('a','b','a'), array('1','2','3')) m, "
                  "column_map(array('a'), array('1','2')) e").first()
    assert r.a == r.b == r.c == 422143
    assert r.m == {"a": "3", "b": "2"} and r.e == {}


def test_rates_in_sql_match_column_forms(spark):
    register_sql_functions(spark)
    terms = ['[{"RANGE_LOWER":0,"RANGE_UPPER":10,"REVENUE_SHARE":0.2},{"RANGE_LOWER":10,'
             '"REVENUE_SHARE":0.3}]', '{"US":0.3,"(OTHERS)":0.1}', '{"(Others)":1,"(OTHERS)":0.1}',
             '{"US":"x"}', "0.25", "nonsense"]
    rows = [(t, d, v) for t in terms for d in ("us", "fr", None) for v in (5.0, 10.0, None)]
    df = spark.createDataFrame(rows, "t string, d string, v double")
    got = df.select(revenue_share(F.col("t"), F.col("d"), F.col("v")).alias("a"),
                    F.expr("revenue_share(t, d, v)").alias("b")).collect()
    assert all(r.a == r.b for r in got)
    dev_terms = ['{"a":{"mobile":[0.4],"tv":[0]},"b":{"other":[0.1],"tv":[0.9]}}',
                 '{"z":{"tv":["x"]},"a":{"tv":[0.5]}}', "0.33"]
    rows = [(t, d) for t in dev_terms for d in ("Phone", "TV", "radio", None)]
    df = spark.createDataFrame(rows, "t string, d string")
    got = df.select(device_share(F.col("t"), F.col("d")).alias("a"),
                    F.expr("revenue_share_device(t, d)").alias("b")).collect()
    assert all(r.a == r.b for r in got), got


def test_json_pattern_judges_each_element_by_its_type(spark):
    register_sql_functions(spark)
    for text, want in (('["a",0,null,true]', 6), ('["",false,"0",[0]]', 12), ("[1,0.0,2]", 2)):
        assert spark.sql(f"SELECT data_pattern_json('{text}')").first()[0] == want
