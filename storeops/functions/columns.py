"""Safe typing, dates, flags and rounding as plain Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DAY = "yyyy-MM-dd"
TEXT_MONTH_DAY = "dd-MMM-yyyy"


def try_decimal(col: Column, precision: int, scale: int) -> Column:
    """Text to decimal; bad or too wide values become NULL, extra digits round half up."""
    return col.try_cast(f"decimal({precision},{scale})")


def try_whole(col: Column) -> Column:
    """Text to bigint, rounding '3.7' to 4. A direct integer cast would turn it into NULL."""
    return col.try_cast("decimal(38,0)").try_cast("bigint")


def try_day(col: Column, *formats: str) -> Column:
    """Text to date with the first format that fits, NULL when none does."""
    return F.coalesce(*[F.try_to_date(col, fmt) for fmt in formats or (ISO_DAY,)])


def try_minute(col: Column) -> Column:
    """`yyyy-MM-dd HH:mm` text to a zone-free timestamp; any other length is NULL."""
    return F.when(F.length(col) == 16, col.try_cast("timestamp_ntz"))


def match_key(col: Column) -> Column:
    """The form under which names are compared: no outer spaces, upper case."""
    return F.upper(F.trim(col))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL for a zero or NULL denominator, also under ANSI mode."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def half_up(col: Column, digits: int) -> Column:
    """Round half away from zero on a decimal.

    Going through decimal(28,8) gives the same digits whatever binary noise the double carries, so
    a table rebuilt from the same rows always holds the same cents. NaN and values of more than 20
    integer digits become NULL.
    """
    return F.round(col.try_cast("decimal(28,8)"), digits)


def monday_of(col: Column) -> Column:
    return F.trunc(col, "week")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end, computed without any time zone."""

    def minute_of_day(ts: Column) -> Column:
        return F.hour(ts) * 60 + F.minute(ts)

    days = F.date_diff(end.cast("date"), start.cast("date"))
    return (days * 1440 + minute_of_day(end) - minute_of_day(start)).cast("bigint")


def in_days(col: Column, start: str | None, end: str | None) -> Column:
    """Closed date range. Written as comparisons, not year(col), so Parquet statistics can prune."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (col >= F.lit(start).cast("date"))
    if end is not None:
        condition = condition & (col <= F.lit(end).cast("date"))
    return condition


def weekday_name(col: Column) -> Column:
    return F.dayname(col)


def weekday_number(col: Column) -> Column:
    """Monday is 1."""
    return F.weekday(col) + 1
