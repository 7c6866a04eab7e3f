"""Row-level expressions (all JVM-side Column builders)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment types one-hot encoded by the feature stage, in their order.
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
# Fixed value: months flagged as holiday season (November, December).
HOLIDAY_MONTHS = [11, 12]



def _micros_of_day(ts: Column) -> Column:
    frac = F.date_format(ts, "SSSSSS").cast("long")
    return ((F.hour(ts).cast("long") * 60 + F.minute(ts)) * 60 + F.second(ts)) * 1_000_000 + frac


def wall_clock_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a wall-clock (zone-less) timestamp."""
    return F.unix_date(F.to_date(ts)).cast("long") * 86_400_000_000 + _micros_of_day(ts)


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole elapsed days (23:00 → 01:00 next day is 0), floor for negative spans.

    Calendar-day difference minus one when the end's time of day is earlier: no time-zone
    conversion is involved, so a DST change in the session zone cannot shift the count.
    """
    d = F.datediff(F.to_date(end), F.to_date(start))
    return (d - F.when(_micros_of_day(end) < _micros_of_day(start), 1).otherwise(0)).cast("int")


def weekday_mon0(ts: Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(ts)


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def clip_upper(c: Column, upper) -> Column:
    return F.least(c, F.lit(upper))


def bucketize(c: Column, edges, labels) -> Column:
    """Right-closed bins (a, b] with labels; values outside every bin are null."""
    expr = None
    for (a, b), lab in zip(zip(edges, edges[1:]), labels):
        cond = c > F.lit(a)
        if b != float("inf"):
            cond = cond & (c <= F.lit(b))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def cast_fill(c: Column, value=0.0, dtype: str = "double") -> Column:
    return F.coalesce(c.cast(dtype), F.lit(value).cast(dtype))


def safe_ratio(num: Column, den: Column, default=0.0) -> Column:
    """num / den, ``default`` where the denominator is 0 or null."""
    return F.coalesce(F.try_divide(num.cast("double"), F.when(den != 0, den.cast("double"))), F.lit(default))


def log1p(c: Column) -> Column:
    return F.log1p(c)


def one_hot(c: Column, values, prefix: str) -> list[Column]:
    return [(c == F.lit(v)).cast("int").alias(f"{prefix}{v}") for v in values]
