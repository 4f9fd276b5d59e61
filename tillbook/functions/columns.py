"""Scalar building blocks. Each function takes Columns and returns a Column."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Validity sentinels and reserved surrogate keys.
OPEN_START = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 00:00:00"
UNKNOWN_KEY = -2
NO_PROMOTION_KEY = -1

LOCAL_TZ = "Asia/Ho_Chi_Minh"

# Money arrives with two decimals; a percentage discount adds four more and stays exact.
MONEY = DecimalType(12, 2)
GROSS = DecimalType(18, 2)
AMOUNT = DecimalType(20, 6)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ keys and null logic
def surrogate_key(*cols: Column | str) -> Column:
    """Non-negative 63-bit key of the column values, so it never meets -1 or -2."""
    digest = F.md5(F.concat_ws("|", *[_col(c).cast("string") for c in cols]))
    high, low = (F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") for at in (1, 9))
    return F.shiftleft(high.bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint")), 32).bitwiseOR(low)


def is_distinct(a: Column | str, b: Column | str) -> Column:
    """NULL-safe inequality."""
    return ~_col(a).eqNullSafe(_col(b))


def greatest_strict(*cols: Column | str) -> Column:
    """greatest() that is NULL when any argument is NULL; Spark's own skips NULLs."""
    return _strict(F.greatest(*[_col(c) for c in cols]), cols)


def least_strict(*cols: Column | str) -> Column:
    return _strict(F.least(*[_col(c) for c in cols]), cols)


def _strict(value: Column, cols) -> Column:
    known = F.lit(True)
    for c in cols:
        known = known & _col(c).isNotNull()
    return F.when(known, value)


def open_start() -> Column:
    return F.lit(OPEN_START).cast("timestamp_ntz")


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


# ------------------------------------------------------------------ time
def at(value: datetime) -> Column:
    """A naive UTC datetime as a literal. Goes through text: a plain literal would pass the session zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """Whole seconds from a to b on the UTC wall clock, whatever the session zone is."""

    def of_day(t: Column) -> Column:
        return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)

    x, y = _col(a), _col(b)
    return F.datediff(F.to_date(y), F.to_date(x)).cast("bigint") * 86400 + of_day(y) - of_day(x)


def to_local(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Wall clock in `tz` of a UTC instant held as TIMESTAMP_NTZ."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _col(ts))


def to_utc(local: Column | str, tz: str = LOCAL_TZ) -> Column:
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _col(local))


def local_date(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    return F.to_date(to_local(ts, tz))


def local_day_end(day: Column | str, tz: str = LOCAL_TZ) -> Column:
    """UTC instant of the local midnight that ends `day`."""
    return to_utc(F.date_add(_col(day), 1).cast("timestamp_ntz"), tz)


def yyyymmdd(day: Column | str) -> Column:
    d = _col(day)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def hhmm(ts: Column | str) -> Column:
    t = _col(ts)
    return F.hour(t) * 100 + F.minute(t)


def period(day: Column | str, grain: str) -> Column:
    """First day of the day, week, month, quarter or year that holds `day`, as a DATE."""
    if grain == "day":
        return _col(day).cast("date")
    return F.trunc(_col(day).cast("date"), grain)


def month_starts_between(a: Column | str, b: Column | str) -> Column:
    """Number of month boundaries between two dates."""
    x, y = _col(a), _col(b)
    return (F.year(y) - F.year(x)) * 12 + F.month(y) - F.month(x)


def employed_on(start: Column | str, end: Column | str, day: Column, inclusive_end: bool = False) -> Column:
    """Active on a day. The last working day counts only with `inclusive_end`.

    Headcount uses the exclusive form (someone leaving on day d is gone at its end), staffing a
    sale uses the inclusive form (that person still sells on day d).
    """
    s, e = _col(start), _col(end)
    after = e >= day if inclusive_end else e > day
    return F.coalesce((s <= day) & (e.isNull() | after), F.lit(False))


# ------------------------------------------------------------------ money
def ratio(num: Column, den: Column) -> Column:
    """Ratio of two aggregates as DOUBLE; NULL when the denominator is zero."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def discount(quantity: Column, price: Column, kind: Column, amount: Column) -> Column:
    """Promotion discount of one line; a fixed amount is per unit and never above the price."""
    gross = (quantity * price).cast(GROSS)
    percent = gross * amount * F.lit(Decimal("0.01"))
    fixed = quantity * F.least(amount, price)
    return F.coalesce(
        F.when(kind == "percentage", percent.cast(AMOUNT)).when(kind == "fixed_amount", fixed.cast(AMOUNT)),
        F.lit(0).cast(AMOUNT),
    )


def promotion_label(kind: Column, amount: Column) -> Column:
    whole = amount.cast("bigint")
    percent = F.when(amount == whole, whole.cast("string")).otherwise(amount.cast("string"))
    units = F.format_number(F.round(amount, 0), 0)
    return F.when(kind == "percentage", F.concat(percent, F.lit("% off"))).when(
        kind == "fixed_amount", F.concat(units, F.lit(" VND off"))
    )


def round_to_step(value: Column, step: int) -> Column:
    """Nearest multiple of step, ties to the even multiple."""
    return (F.bround(value / F.lit(step), 0) * step).cast(MONEY)


def ceil_to_step(value: Column, step: int) -> Column:
    return (F.ceil(value / F.lit(step)) * step).cast(MONEY)


def shift_by_pct(value: Column, pct: Column, step: int) -> Column:
    """value * (1 + pct) on the step grid, moved by at least one step and never below zero.

    A NULL percent leaves the value as it is, a NULL value stays NULL.
    """
    moved = round_to_step(value * (F.lit(1) + pct), step)
    stuck = moved == round_to_step(value, step)
    nudge = F.when(pct > 0, F.lit(step)).otherwise(F.lit(-step))
    shifted = F.greatest(F.when(stuck, moved + nudge).otherwise(moved).cast(MONEY), F.lit(0).cast(MONEY))
    return F.when(value.isNull() | pct.isNull(), value.cast(MONEY)).otherwise(shifted)
