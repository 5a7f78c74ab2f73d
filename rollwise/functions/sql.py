"""The engine's scalar functions as Spark SQL functions.

``register_sql_functions(spark)`` creates temporary SQL-bodied functions, so
queries written in SQL can call them.  Their bodies are built-in expressions
(higher-order array functions, variants), so Catalyst inlines them into the
plan and they run in whole-stage codegen.  Spark SQL functions do not
overload, so the two rate forms have two names.

| function | meaning |
|---|---|
| ``data_pattern_flags(array<int>)`` | mask from 0/1 flags (a falsy flag sets the bit) |
| ``data_pattern_names(array<string>, array<string>)`` | bit set for each pattern column missing from the group-by list |
| ``data_pattern_json(string)`` | either form from JSON text: an array of flags, or an object with ``pattern_columns`` and ``groupby_columns`` |
| ``column_map(array<string>, array<string>)`` | map keys -> values; unequal lengths give an empty map; a repeated key keeps its last value |
| ``revenue_share(string, string, double)`` | rate from JSON terms: number, tier array, or category object |
| ``revenue_share_device(string, string)`` | rate from nested device terms, with the ``other`` fallback |
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.rates import MOBILE_ALIASES, OTHER_DEVICE, OTHERS_BLOCKER, OTHERS_KEY


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(values: str, name: str, body: str) -> str:
    """``body`` with the struct of ``values`` under a name, computed once."""
    return f"get(transform(array(named_struct({values})), {name} -> {body}), 0)"


def _is_number(kind: str) -> str:
    """Whether the type name of a variant is that of a JSON number."""
    return f"({kind} IN ('BIGINT', 'DOUBLE', 'INT', 'SMALLINT', 'TINYINT', 'FLOAT') OR {kind} LIKE 'DECIMAL%')"


def _number(v: str) -> str:
    """The variant's value if it is a JSON number, else NULL."""
    value = _let(f"'n', {v}, 'k', schema_of_variant({v})", "z",
                 f"IF({_is_number('z.k')}, try_variant_get(z.n, '$', 'double'), CAST(NULL AS DOUBLE))")
    return value


# Rates from terms, over a struct ``p`` of the arguments: the parsed terms
# ``j``, their text ``t``, the dim ``d`` and the value ``v``.  Both the SQL
# functions and the Column functions are made of these.  Objects are read as
# maps, so any key is looked up as it stands.
# The field names of a tier entry in the terms JSON.
_TIERS = "try_variant_get(p.j, '$', 'array<map<string,variant>>')"
_IN_TIER = ("map_contains_key(x, 'RANGE_LOWER') "
            "AND coalesce(try_variant_get(try_element_at(x, 'RANGE_LOWER'), '$', 'double'), 0D) <= p.v "
            "AND (coalesce(try_variant_get(try_element_at(x, 'RANGE_UPPER'), '$', 'double'), 0D) = 0D "
            "OR try_variant_get(try_element_at(x, 'RANGE_UPPER'), '$', 'double') > p.v)")
_CATEGORY = ("CASE WHEN coalesce(map_contains_key(o.m, upper(p.d)), false) THEN "
             + _number("try_element_at(o.m, upper(p.d))")
             + f" WHEN NOT map_contains_key(o.m, {_text(OTHERS_BLOCKER)}) THEN "
             f"try_variant_get(try_element_at(o.m, {_text(OTHERS_KEY)}), '$', 'double') END")
REVENUE_SHARE = _let("'k', schema_of_variant(p.j)", "k",
    f"CASE WHEN {_is_number('k.k')} THEN try_variant_get(p.j, '$', 'double') "
    "WHEN k.k LIKE 'ARRAY%' THEN IF(p.v IS NULL, CAST(NULL AS DOUBLE), "
    f"try_variant_get(try_element_at(try_element_at(filter({_TIERS}, x -> {_IN_TIER}), 1), 'REVENUE_SHARE'), "
    "'$', 'double')) WHEN k.k LIKE 'OBJECT%' THEN "
    + _let("'m', try_variant_get(p.j, '$', 'map<string,variant>')", "o", _CATEGORY) + " END")

_DEVICE = f"IF(lower(p.d) IN ({', '.join(map(_text, MOBILE_ALIASES))}), 'mobile', lower(p.d))"


def _first_rate(key: str) -> str:
    """The first numeric rate of a device, items in the order of the text."""
    rate = (f"try_variant_get(try_element_at(try_variant_get(try_parse_json(e.value), '$', 'map<string,variant>'), "
            f"{key}), '$[0]', 'variant')")
    return (f"try_element_at(filter(transform(map_entries(from_json(p.t, 'map<string,string>')), e -> {_number(rate)}), "
            "x -> x IS NOT NULL), 1)")


DEVICE_SHARE = _let("'k', schema_of_variant(p.j)", "k",
    f"CASE WHEN {_is_number('k.k')} THEN try_variant_get(p.j, '$', 'double') "
    "WHEN k.k LIKE 'OBJECT%' THEN "
    + _let(f"'dev', {_first_rate(_DEVICE)}, 'oth', {_first_rate(_text(OTHER_DEVICE))}", "s",
           "CASE WHEN s.dev IS NOT NULL AND s.dev <> 0 THEN s.dev WHEN s.oth IS NOT NULL THEN s.oth ELSE s.dev END")
    + " END")

FUNCTIONS = {
    "data_pattern_flags": (
        "flags ARRAY<INT>", "BIGINT",
        "aggregate(flags, 0L, (acc, x) -> acc * 2 + IF(coalesce(x, 0) = 0, 1, 0))"),
    "data_pattern_names": (
        "pattern_columns ARRAY<STRING>, groupby_columns ARRAY<STRING>", "BIGINT",
        "aggregate(pattern_columns, 0L, "
        "(acc, c) -> acc * 2 + IF(array_contains(groupby_columns, c), 0, 1))"),
    "data_pattern_json": (
        "p STRING", "BIGINT",
        "CASE WHEN schema_of_variant(try_parse_json(p)) LIKE 'ARRAY%' THEN "
        # Falsy by the element's own type: null, false, 0 and ''.
        "aggregate(try_variant_get(try_parse_json(p), '$', 'array<variant>'), 0L, "
        "(acc, x) -> acc * 2 + IF(CASE schema_of_variant(x) "
        "WHEN 'STRING' THEN try_variant_get(x, '$', 'string') = '' "
        "WHEN 'BOOLEAN' THEN NOT try_variant_get(x, '$', 'boolean') WHEN 'VOID' THEN true "
        "ELSE coalesce(try_variant_get(x, '$', 'double') = 0, x IS NULL) END, 1, 0)) "
        "WHEN schema_of_variant(try_parse_json(p)) LIKE 'OBJECT%' THEN "
        "aggregate(try_variant_get(try_parse_json(p), '$.pattern_columns', 'array<string>'), 0L, "
        "(acc, c) -> acc * 2 + IF(array_contains(try_variant_get(try_parse_json(p), "
        "'$.groupby_columns', 'array<string>'), c), 0, 1)) END"),
    "column_map": (
        "keys ARRAY<STRING>, vals ARRAY<STRING>", "MAP<STRING, STRING>",
        "IF(size(keys) = size(vals), map_from_entries(filter(arrays_zip(keys, vals), "
        "(e, i) -> NOT exists(slice(keys, i + 2, greatest(size(keys), 1)), x -> x = e.keys))), "
        "map_from_arrays(CAST(array() AS ARRAY<STRING>), CAST(array() AS ARRAY<STRING>)))"),
    "revenue_share": (
        "terms STRING, d STRING, v DOUBLE", "DOUBLE",
        _let("'j', try_parse_json(terms), 't', terms, 'd', d, 'v', v", "p", REVENUE_SHARE)),
    "revenue_share_device": (
        "terms STRING, d STRING", "DOUBLE",
        _let("'j', try_parse_json(terms), 't', terms, 'd', d", "p", DEVICE_SHARE)),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    for name, (args, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} "
                  f"RETURN {body}")
    return list(FUNCTIONS)
