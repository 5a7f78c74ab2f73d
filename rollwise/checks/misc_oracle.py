"""Oracle SQL for rate cards, scalar functions and the stream."""

from __future__ import annotations

from ..sources import generator
from .fixtures import CATEGORY_JSON, NESTED_A, NESTED_B, TIER_JSON
from .oracle import KEYS_2
from .sqlparts import measures_1, u_events_sql

TIERS = "(VALUES (1, 0.0, 10000.0, 0.10), (2, 10000.0, 50000.0, 0.15), " \
        "(3, 40000.0, 60000.0, 0.50), (4, 50000.0, 0.0, 0.20)) AS t(tier_no, lo, hi, rate)"
DEVICES = "(VALUES (1, 'mobile', 0.4), (1, 'view', 0.0), (2, 'view', 0.3), (2, 'click', 0.25), " \
          "(2, 'signup', NULL), (3, 'other', 0.1), (3, 'signup', 0.6)) AS c(pos, device, rate)"


def _round_grid(n: int) -> str:
    return (f"TIMESTAMP '2000-01-01 00:00:00' + to_minutes(CAST(round(date_diff('minute', "
            f"TIMESTAMP '2000-01-01 00:00:00', ts) / {n}) * {n} AS BIGINT))")



def _mixed(row: str, seed: int) -> str:
    """The generator's mix, step by step."""
    prime, (a, *rest) = generator.PRIME, generator.MULTIPLIERS
    x = f"((({row}) * {a} + {seed * 7919 + 12345}) % {prime})"
    for m in rest:
        x = f"((({x} % 65536) * 32768 + {x} // 65536) * {m} + {seed}) % {prime}"
        x = f"({x})"
    return x


def _uniform(seed: int, low: int, high: int, row: str = "r") -> str:
    return f"({low} + {_mixed(row, seed)} % {high - low + 1})"


def _letters(seed: int, length: str) -> str:
    return (f"substr(array_to_string(list_transform(range(1, 27), lambda k: chr(CAST(97 + {_mixed('r * 32 + k', seed)} % 26 AS INTEGER))), ''), "
            f"1, CAST({length} AS INTEGER))")


SYNTH = f"""
WITH g AS (SELECT r AS row_no, TIMESTAMP '2024-01-31 00:00:00' - to_minutes({_uniform(1, 1, 50000)}) AS data_ts,
  CAST(1 AS BIGINT) AS data_i1, {_uniform(11, 0, 15)} AS data_i2, nullif({_uniform(111, 0, 15)}, 0) AS data_i3,
  {_letters(2, _uniform(22, 1, 10))} AS data_a1, {_letters(3, _uniform(33, 0, 9))} AS data_a2,
  nullif({_letters(4, _uniform(44, 0, 10))}, '') AS data_a3, {_uniform(10, 0, 50)} AS value_i1,
  CAST({_uniform(15, 0, 1500)} AS DOUBLE) / 10 AS value_d1
  FROM range((SELECT count(*) FROM events)) AS t(r))
SELECT CAST((CASE WHEN hour(data_ts) = 0 THEN 128 ELSE 0 END)
  + (CASE WHEN data_i2 = 0 THEN 16 ELSE 0 END) + (CASE WHEN data_i3 IS NULL THEN 8 ELSE 0 END)
  + (CASE WHEN data_a1 = '' THEN 4 ELSE 0 END) + (CASE WHEN data_a2 = '' THEN 2 ELSE 0 END)
  + (CASE WHEN data_a3 IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS data_pt, * FROM g
"""

SQL = {
    "synth_source": SYNTH,
    "tier_rate_join": (
        "SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, "
        f"(SELECT CAST(arg_min(rate, tier_no) AS DOUBLE) FROM {TIERS} WHERE t.lo <= "
        "l.l_extendedprice AND (t.hi IS NULL OR t.hi = 0 OR t.hi > l.l_extendedprice)) AS rate "
        "FROM lineitem l"),
    "category_rate_join": (
        "WITH card AS (SELECT n_name AS category, (n_nationkey + 1) / 100 AS rate FROM nation "
        "WHERE n_regionkey < 3 UNION ALL SELECT '(OTHERS)', 0.05) "
        "SELECT c.c_custkey, lower(n.n_name) AS nation, CAST(coalesce(k.rate, (SELECT rate FROM "
        "card WHERE category = '(OTHERS)')) AS DOUBLE) AS rate FROM customer c JOIN nation n ON "
        "c.c_nationkey = n.n_nationkey LEFT JOIN card k ON k.category = upper(lower(n.n_name))"),
    "device_rate_join": (
        f"WITH card AS (SELECT * FROM {DEVICES}), "
        "first AS (SELECT device, arg_min(rate, pos) AS r FROM card WHERE rate IS NOT NULL "
        "GROUP BY device), "
        "ev AS (SELECT event_id, CASE event_type WHEN 'purchase' THEN 'Smart Phones' WHEN 'error' "
        "THEN 'TABLET' ELSE event_type END AS device FROM events), "
        "f AS (SELECT event_id, device, CASE WHEN lower(device) IN ('phone', 'smart phones') "
        "THEN 'mobile' ELSE lower(device) END AS d FROM ev) "
        "SELECT f.event_id, f.device, CAST(CASE WHEN x.r IS NOT NULL AND x.r <> 0 THEN x.r "
        "WHEN o.r IS NOT NULL THEN o.r ELSE x.r END AS DOUBLE) AS rate FROM f "
        "LEFT JOIN first x ON x.device = f.d "
        "LEFT JOIN (SELECT r FROM first WHERE device = 'other') o ON true"),
    "sql_patterns": ("SELECT CAST(c_custkey AS VARCHAR) AS target_table, "
                     "CAST(c_custkey % 2048 AS BIGINT) AS by_names, "
                     "CAST(c_custkey % 2048 AS BIGINT) AS by_json FROM customer"),
    "time_floor": (
        "SELECT event_id, TIMESTAMP '1970-01-01 00:00:00' + to_minutes(CAST(floor(date_diff("
        "'minute', TIMESTAMP '1970-01-01 00:00:00', ts) / 5) * 5 AS BIGINT)) AS floor_5, "
        "CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start, "
        "CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start, ts + INTERVAL 90 MINUTE AS plus_90, "
        "strftime(ts, '%Y-%m-%d') AS day_text FROM events"),
    "time_round": (f"SELECT event_id, {_round_grid(5)} AS round_5, {_round_grid(15)} AS round_15, "
                   f"{_round_grid(60)} AS round_60 FROM events"),
    "minute_diff": (
        "SELECT event_id, date_diff('minute', TIMESTAMP '2000-01-01 00:00:00', ts) AS from_base, "
        "date_diff('minute', ts, TIMESTAMP '2024-02-01 00:00:00') AS to_feb, "
        "date_diff('minute', ts, ts + INTERVAL 90 SECOND) AS next_90s FROM events"),
    "math_scalars": (
        "SELECT l_orderkey, l_linenumber, round(l_quantity * 1.5) AS q_round, "
        "CAST(floor(l_extendedprice) AS BIGINT) AS price_floor, abs(l_discount - 0.05) AS disc_abs, "
        "l_orderkey % 7 AS key_mod, pow(2.0, l_linenumber) AS pow_2 FROM lineitem"),
    "null_scalars": (
        "SELECT event_id, nullif(user_id % 16, 0) AS i3, coalesce(nullif(CASE WHEN user_id % 7 = 0 "
        "THEN '' ELSE event_type END, ''), 'none') AS a2_or_none, CAST(coalesce(nullif(user_id % 3, "
        "0), nullif(user_id % 5, 0), -1) AS BIGINT) AS first_non_zero FROM events"),
    "stream_summary": f"SELECT {KEYS_2}, {measures_1(True)} FROM {u_events_sql()} GROUP BY ALL",
}



# The per-row terms are evaluated from their JSON text with DuckDB's JSON
# functions (key order kept), independently of the Spark variant code.
_NUMERIC = "('DOUBLE', 'UBIGINT', 'BIGINT')"


def _terms_case(col: str, cases: list[tuple[str, str]], default: str) -> str:
    body = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in cases)
    return f"CASE {col} {body} ELSE '{default}' END"


def tier_rows_sql(tier_json: str, category_json: str) -> str:
    terms = _terms_case("l_returnflag", [("A", tier_json), ("N", category_json)], "0.25")
    key = "'$.\"' || upper(d) || '\"'"
    return f"""
WITH li AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS v, lower(l_linestatus) AS d,
                   {terms} AS terms FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE
  WHEN json_type(terms) IN {_NUMERIC} THEN CAST(json_extract(terms, '$') AS DOUBLE)
  WHEN json_type(terms) = 'ARRAY' AND v IS NOT NULL THEN CAST(json_extract(list_filter(
      json_extract(terms, '$[*]'), lambda t: coalesce(CAST(json_extract(t, '$.RANGE_LOWER') AS DOUBLE), 0) <= v
      AND (json_extract(t, '$.RANGE_UPPER') IS NULL
           OR CAST(json_extract(t, '$.RANGE_UPPER') AS DOUBLE) = 0
           OR CAST(json_extract(t, '$.RANGE_UPPER') AS DOUBLE) > v))[1], '$.REVENUE_SHARE') AS DOUBLE)
  WHEN json_type(terms) = 'OBJECT' THEN CASE
      WHEN json_extract(terms, {key}) IS NOT NULL THEN CASE
          WHEN json_type(json_extract(terms, {key})) IN {_NUMERIC}
          THEN CAST(json_extract(terms, {key}) AS DOUBLE) END
      WHEN json_extract(terms, '$."(Others)"') IS NULL
      THEN CAST(json_extract(terms, '$."(OTHERS)"') AS DOUBLE) END
  END AS rate
FROM li"""


def device_rows_sql(nested_a: str, nested_b: str) -> str:
    terms = _terms_case("event_type", [("click", nested_b), ("purchase", "0.33")], nested_a)
    first = ("list_filter(list_transform(json_keys(terms), lambda k: json_extract(terms, "
             "'$.\"' || k || '\".\"' || {dev} || '\"[0]')), lambda x: json_type(x) IN "
             + _NUMERIC + ")[1]")
    return f"""
WITH ev AS (SELECT event_id, {terms} AS terms,
              CASE event_type WHEN 'purchase' THEN 'Smart Phones' WHEN 'error' THEN 'TABLET'
                   ELSE event_type END AS device FROM events),
f AS (SELECT event_id, terms, CASE WHEN lower(device) IN ('phone', 'smart phones') THEN 'mobile'
                                   ELSE lower(device) END AS d FROM ev),
x AS (SELECT event_id, terms, json_type(terms) AS kind,
        CASE WHEN json_type(terms) = 'OBJECT' THEN CAST({first.format(dev="d")} AS DOUBLE) END AS dev,
        CASE WHEN json_type(terms) = 'OBJECT' THEN CAST({first.format(dev="'other'")} AS DOUBLE) END
          AS oth
      FROM f)
SELECT event_id, CASE WHEN kind IN {_NUMERIC} THEN CAST(json_extract(terms, '$') AS DOUBLE)
  WHEN kind = 'OBJECT' THEN CASE WHEN dev IS NOT NULL AND dev <> 0 THEN dev
                                 WHEN oth IS NOT NULL THEN oth ELSE dev END END AS rate
FROM x"""


SQL["tier_rate_rows"] = tier_rows_sql(TIER_JSON, CATEGORY_JSON)
SQL["sql_revenue_share"] = SQL["tier_rate_rows"]
SQL["device_rate_rows"] = device_rows_sql(NESTED_A, NESTED_B)
