"""Time buckets on ``timestamp_ntz``: floors, rounding grids, minute counts.

Warehouse ``DATEDIFF(MINUTE, a, b)`` counts minute *boundaries* crossed;
Spark's ``timestampdiff`` counts whole minutes elapsed.  Truncating both
sides to the minute first makes the two agree.  ``date_trunc`` returns a
session-zone timestamp for NTZ input, so results are cast back (the engine
pins the session to UTC).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

EPOCH = dt.datetime(1970, 1, 1)
BASE_2000 = dt.datetime(2000, 1, 1)


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, (dt.datetime, dt.date)):
        return ts_lit(x)
    return F.col(x)


def ts_lit(value) -> Column:
    """A ``timestamp_ntz`` literal."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.lit(value).cast("timestamp_ntz")


def trunc(unit: str, ts) -> Column:
    """``DATE_TRUNC(unit, ts)`` keeping ``timestamp_ntz``."""
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def add_minutes(ts, minutes) -> Column:
    """``DATEADD(MINUTE, n, ts)``; ``n`` may be a column."""
    n = minutes if isinstance(minutes, Column) else F.lit(int(minutes))
    return F.timestamp_add("MINUTE", n, _c(ts))


def minute_diff(a, b) -> Column:
    """Minute boundaries crossed from ``a`` to ``b`` (warehouse DATEDIFF)."""
    return F.timestamp_diff("MINUTE", trunc("minute", a), trunc("minute", b))


def floor_minutes(ts, n: int | Column, base=EPOCH) -> Column:
    """Start of the ``n``-minute bucket holding ``ts``, grid anchored at ``base``."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    k = F.floor(minute_diff(_c(base), ts) / n)
    return add_minutes(_c(base), (k * n).cast("int"))


def round_minutes(ts, n: int | Column, base=BASE_2000) -> Column:
    """Nearest ``n``-minute grid point (ties away from zero), anchored at ``base``."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    k = F.round(minute_diff(_c(base), ts) / n)
    return add_minutes(_c(base), (k * n).cast("int"))
