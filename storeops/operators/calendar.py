"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.functions.columns import flag, monday_of, weekday_name, weekday_number
from storeops.fixed_values import HOLIDAYS
from storeops.sources.tables import literal_rows


def day_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row with the first and last day."""
    return spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
    )


def holiday_table(spark: SparkSession, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    df = literal_rows(spark, rows if rows is not None else HOLIDAYS, "day", "holiday_name")
    return df.select(F.col("day").cast("date").alias("holiday_date"), "holiday_name")


def build_calendar(bounds: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per day between the two dates of `bounds` (a one-row frame: first_day, last_day)."""
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("calendar_date")
    )
    d = F.col("calendar_date")
    month = F.month(d)
    return days.join(holidays, d == F.col("holiday_date"), "left").select(
        d,
        F.year(d).alias("year"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        month.alias("month_num"),
        F.monthname(d).alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        weekday_name(d).alias("day_of_week"),
        weekday_number(d).alias("dow_num"),
        flag(weekday_number(d) >= 6).alias("is_weekend"),
        monday_of(d).alias("week_start"),
        F.weekofyear(d).alias("iso_week"),
        F.coalesce("holiday_name", F.lit("")).alias("holiday_name"),
        flag(F.col("holiday_date").isNotNull()).alias("is_stat_holiday"),
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
        .alias("season"),
    )
