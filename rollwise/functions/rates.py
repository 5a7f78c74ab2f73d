"""Per-row rate-card functions over JSON terms.

Built from ``parse_json``/``variant_get``/``from_json`` and higher-order array
functions, so they run in the JVM.  Use them when every row carries its own
terms; when rows share a card, the join forms in ``operators.rates`` are
cheaper (the card is parsed once, not per row).  The rules themselves are
stated once, in ``functions.sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .sql import DEVICE_SHARE, REVENUE_SHARE


def _over(terms: Column, rule: str, **arguments: Column) -> Column:
    p = F.struct(F.try_parse_json(terms).alias("j"), terms.alias("t"),
                 *[c.alias(k) for k, c in arguments.items()])
    return F.get(F.call_function("transform", F.array(p), F.expr(f"p -> {rule}")), F.lit(0))


def revenue_share(terms: Column, dim: Column, value: Column) -> Column:
    """``REVENUE_SHARE(terms, dim, value)``.

    * a number: that number;
    * a tier array and a value: the first tier with
      ``lower <= value < upper`` (upper missing or 0 = open; a tier without a
      lower bound contains nothing), NULL if none;
    * an object: the number at ``upper(dim)``; when that key is absent and no
      ``(Others)`` key exists, the ``(OTHERS)`` number;
    * anything else (or a NULL value with tiers): NULL."""
    return _over(terms, REVENUE_SHARE, d=dim.cast("string"), v=value.cast("double"))


def device_share(terms: Column, dim: Column) -> Column:
    """``REVENUE_SHARE(terms, device)`` on a nested object
    ``{"item": {"device": [rate, ...]}, ...}``: items in text order, the first
    with a numeric first rate for the folded device; if none (or 0), the first
    numeric ``other`` rate."""
    return _over(terms, DEVICE_SHARE, d=dim.cast("string"))
