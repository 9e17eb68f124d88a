"""Sales, covers, labour, purchase, count and waste facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import flag, half_up, match_key, minutes_between, zero_if_null
from storeops.operators.clean import convert_unit, first_per_grain, impute, resolve_alias, type_columns
from storeops.schemas import kinds

SALES_GRAIN = ["business_date", "location_id", "daypart", "menu_item_id"]
HOUR_GRAIN = ["business_date", "location_id", "hour_of_day"]
SALES_MEASURES = ["qty_sold", "unit_price", "gross_sales", "discounts", "comps", "net_sales"]

# First and last clock hour of the labour table.
FIRST_HOUR, LAST_HOUR = 6, 23

# Scheduled start hour -> shift block; any other hour is PM.
SHIFT_BLOCKS = {7: "AM", 11: "MID"}


def sales_fact(raw: DataFrame, store_alias: DataFrame, keep_unmapped: bool = False) -> DataFrame:
    """Item sales per day, store, daypart and item.

    Rows of stores without an alias share the NULL store and so one grain. `keep_unmapped` tells
    them apart by the name as typed.
    """
    mapped = resolve_alias(raw, "store", store_alias, "location_id")
    rows = type_columns(mapped, kinds("pos_sales"))
    grain: list[str | Column] = list(SALES_GRAIN)
    if keep_unmapped:
        grain.append(F.when(F.col("location_id").isNull(), match_key(F.col("store"))))
    # Dealt by store and item, so that the weekly sums per store and item follow without a shuffle.
    first = first_per_grain(rows, grain, ["_loaded_at", *SALES_MEASURES], spread=["location_id", "menu_item_id"])
    rebuilt = F.col("gross_sales") - F.col("discounts") - F.col("comps")
    return impute(first, "net_sales", rebuilt, "is_net_sales_imputed").select(
        *SALES_GRAIN, *SALES_MEASURES, "is_net_sales_imputed"
    )


def hour_daypart(hour: Column) -> Column:
    """Hours outside the four bands, 6 and 23 included, are Late Night."""
    return (
        F.when(hour.between(7, 10), "Breakfast")
        .when(hour.between(11, 14), "Lunch")
        .when(hour.between(15, 16), "Afternoon")
        .when(hour.between(17, 20), "Dinner")
        .otherwise("Late Night")
    )


def covers_fact(raw: DataFrame, store_alias: DataFrame) -> DataFrame:
    mapped = resolve_alias(raw, "store", store_alias, "location_id")
    rows = type_columns(mapped, kinds("pos_covers_hourly"))
    first = first_per_grain(rows, HOUR_GRAIN, ["_loaded_at", "covers", "net_sales"])
    return first.select(*HOUR_GRAIN, hour_daypart(F.col("hour_of_day")).alias("daypart"), "covers", "net_sales")


def hours_of(minutes: Column, digits: int) -> Column:
    return half_up(minutes.cast("double") / 60, digits).cast(f"decimal(22,{digits})")


def shift_block(start: Column, blocks: Mapping[int, str] = SHIFT_BLOCKS, other: str = "PM") -> Column:
    block = F.lit(other)
    for hour, name in blocks.items():
        block = F.when(F.hour(start) == hour, name).otherwise(block)
    return block


def shifts_fact(
    raw: DataFrame,
    store_alias: DataFrame,
    role_alias: DataFrame,
    employee: DataFrame,
    raise_date: str = "2026-01-01",
    raise_factor: str = "1.025",
) -> DataFrame:
    """One costed row per shift; a missed clock-out ends at the scheduled end and is flagged."""
    mapped = resolve_alias(raw, "store", store_alias, "location_id")
    mapped = resolve_alias(mapped, "role", role_alias, "role")
    rows = type_columns(mapped, kinds("timeclock"))
    times = ["scheduled_start", "scheduled_end", "actual_start", "actual_end"]
    first = first_per_grain(
        rows,
        ["shift_id"],
        ["_loaded_at", "business_date", "location_id", "employee_id", "role", *times],
        spread=["shift_id"],
    )
    ended = impute(first, "actual_end", F.col("scheduled_end"), "is_clock_out_imputed")
    wages = employee.select("employee_id", "hourly_wage_2025")
    factor = F.when(
        F.col("business_date") >= F.lit(raise_date).cast("date"), F.lit(raise_factor).cast("decimal(6,4)")
    ).otherwise(F.lit("1").cast("decimal(6,4)"))
    costed = ended.join(wages, "employee_id", "left").withColumns(
        {
            "scheduled_hours": hours_of(minutes_between(F.col("scheduled_start"), F.col("scheduled_end")), 6),
            "actual_hours": hours_of(minutes_between(F.col("actual_start"), F.col("actual_end")), 2),
            "hourly_wage": F.round(F.col("hourly_wage_2025") * factor, 2).cast("decimal(10,2)"),
        }
    )
    return costed.select(
        "shift_id",
        "business_date",
        "location_id",
        "employee_id",
        "role",
        shift_block(F.col("scheduled_start")).alias("shift_block"),
        *times,
        "is_clock_out_imputed",
        "scheduled_hours",
        "actual_hours",
        "hourly_wage",
        F.round(F.col("actual_hours") * F.col("hourly_wage"), 2).alias("labour_cost"),
    )


def split_hours(shifts: DataFrame, first_hour: int = FIRST_HOUR, last_hour: int = LAST_HOUR) -> DataFrame:
    """One row per clock hour a shift touches, with the covered part of the hour.

    The hours are generated from the shift itself, so the work grows with the rows produced; a join
    on the overlap condition would compare every shift with every hour.
    """
    midnight = F.col("business_date").cast("timestamp_ntz")
    start, end, hour = F.col("start_min"), F.col("end_min"), F.col("hour_of_day")
    spans = (
        shifts.select(
            "business_date",
            "location_id",
            "hourly_wage",
            minutes_between(midnight, F.col("actual_start")).alias("start_min"),
            minutes_between(midnight, F.col("actual_end")).alias("end_min"),
        )
        .withColumns(
            {
                "low": F.greatest(F.lit(first_hour).cast("bigint"), F.floor(start / 60)),
                "high": F.least(F.lit(last_hour).cast("bigint"), F.ceil(end / 60) - 1),
            }
        )
        .filter(start.isNotNull() & end.isNotNull() & (F.col("low") <= F.col("high")))
    )
    hours = spans.withColumn("hour_of_day", F.explode(F.sequence("low", "high")))
    covered = F.least(end, (hour + 1) * 60) - F.greatest(start, hour * 60)
    return hours.select("business_date", "location_id", "hour_of_day", "hourly_wage", hours_of(covered, 6).alias("hrs"))


def labour_hourly_fact(shifts: DataFrame, covers: DataFrame) -> DataFrame:
    """Labour and covers side by side per hour; an hour present on one side only gets zeros."""
    labour = (
        split_hours(shifts)
        .groupBy(*HOUR_GRAIN)
        .agg(
            F.sum("hrs").alias("labour_hours"),
            F.sum(F.col("hrs") * F.col("hourly_wage")).alias("labour_cost"),
        )
    )
    return labour.join(covers.drop("daypart"), HOUR_GRAIN, "full").select(
        *HOUR_GRAIN,
        F.round(zero_if_null(F.col("labour_hours")), 2).alias("labour_hours"),
        F.round(zero_if_null(F.col("labour_cost")), 2).alias("labour_cost"),
        zero_if_null(F.col("covers")).alias("covers"),
        zero_if_null(F.col("net_sales")).alias("net_sales"),
    )


def purchases_fact(raw: DataFrame, store_alias: DataFrame, suppliers: DataFrame) -> DataFrame:
    """One row per purchase line, supplier in master spelling, pounds converted.

    `suppliers` holds the master names in a column `supplier`; repeats are fine.
    """
    mapped = resolve_alias(raw, "store", store_alias, "location_id")
    rows = type_columns(mapped, kinds("purchasing"))
    values = [
        "delivery_date",
        "location_id",
        "supplier",
        "ingredient_id",
        "qty_received",
        "unit",
        "unit_cost",
        "line_total",
    ]
    first = first_per_grain(
        rows, ["po_line_id"], ["_loaded_at", *values], keep=["po_line_id", *values], spread=["po_line_id"]
    )
    master = suppliers.select(F.col("supplier").alias("supplier_master")).distinct()
    named = first.join(master, match_key(F.col("supplier")) == F.upper("supplier_master"), "left")
    return convert_unit(named, "qty_received", "unit_cost").select(
        "po_line_id",
        "delivery_date",
        "location_id",
        F.col("supplier_master").alias("supplier"),
        "ingredient_id",
        "qty_received",
        "unit",
        "unit_cost",
        "line_total",
        "is_unit_converted",
    )


def counts_fact(raw: DataFrame, store_alias: DataFrame) -> DataFrame:
    """Stock counts. Repeated counts are kept; `checks.unique_key` reports them."""
    mapped = resolve_alias(raw, "store", store_alias, "location_id")
    return type_columns(mapped, kinds("inventory_counts")).select(
        "count_date", "location_id", "ingredient_id", "qty_on_hand", "unit"
    )


def waste_fact(raw: DataFrame, store_alias: DataFrame) -> DataFrame:
    mapped = resolve_alias(raw, "store", store_alias, "location_id")
    return type_columns(mapped, kinds("waste_log")).select(
        "waste_date", "location_id", "ingredient_id", "qty_wasted", "unit", "reason"
    )


def net_rebuilt_difference() -> Column:
    """Absolute gap between net sales and gross less discounts and comps."""
    return F.abs(F.col("net_sales") - (F.col("gross_sales") - F.col("discounts") - F.col("comps")))


def is_inverted_shift() -> Column:
    return flag(F.col("actual_end") <= F.col("actual_start"))
