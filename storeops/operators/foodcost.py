"""Weekly food cost: theoretical against actual usage, and the dollar bridge between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import half_up, monday_of, ratio, zero_if_null

WEEK_GRAIN = ["week_start", "location_id", "ingredient_id"]
BRIDGE_PARTS = ["theoretical_cost_at_standard", "price_variance", "recorded_waste_cost", "unexplained_variance"]


def exact(col: Column) -> Column:
    """Measured quantities as decimals, so that sums do not depend on the order of the rows.

    Up to 22 digits before the point; NaN and what is wider still become NULL.
    """
    return col.try_cast("decimal(28,6)")


def weekly_sold(sales: DataFrame, *sums: str) -> DataFrame:
    """Quantity sold, and the sums of any other measures, by week, store and item."""
    return (
        sales.withColumn("week_start", monday_of(F.col("business_date")))
        .groupBy("week_start", "location_id", "menu_item_id")
        .agg(*[F.sum(name).alias(name) for name in ("qty_sold", *sums)])
    )


def theoretical_usage(sales: DataFrame, recipe: DataFrame) -> DataFrame:
    """Items sold x recipe quantity by week, store and ingredient.

    Sales are summed per item before the recipe multiplies the rows: the join then carries one row
    per week, store and item, and a best-seller no longer weighs on one partition.
    """
    return recipe_usage(weekly_sold(sales), recipe)


def recipe_usage(sold: DataFrame, recipe: DataFrame) -> DataFrame:
    """`weekly_sold` x recipe quantity by week, store and ingredient."""
    return (
        sold.join(recipe.select("menu_item_id", "ingredient_id", "qty_per_item"), "menu_item_id")
        .groupBy(*WEEK_GRAIN)
        .agg(F.sum(F.col("qty_sold") * F.col("qty_per_item")).alias("theoretical_qty"))
    )


def weekly_purchases(purchases: DataFrame) -> DataFrame:
    return (
        purchases.withColumn("week_start", monday_of(F.col("delivery_date")))
        .groupBy(*WEEK_GRAIN)
        .agg(F.sum("qty_received").alias("purchased_qty"), F.sum("line_total").alias("purchased_cost"))
    )


def chain_price(weekly: DataFrame) -> DataFrame:
    """Average price over all stores, from the weekly store sums."""
    return weekly.groupBy("week_start", "ingredient_id").agg(
        ratio(F.sum("purchased_cost"), F.sum("purchased_qty")).alias("chain_unit_cost")
    )


def weekly_waste(waste: DataFrame) -> DataFrame:
    return (
        waste.withColumn("week_start", monday_of(F.col("waste_date")))
        .groupBy(*WEEK_GRAIN)
        .agg(F.sum(exact(F.col("qty_wasted"))).alias("recorded_waste_qty"))
    )


def count_as(counts: DataFrame, name: str, week_start: Column) -> DataFrame:
    """Counts keyed by the week they open or close."""
    return counts.select(
        week_start.alias("week_start"), "location_id", "ingredient_id", exact(F.col("qty_on_hand")).alias(name)
    )


def usage_base(
    sales: DataFrame,
    recipe: DataFrame,
    ingredient: DataFrame,
    bought: DataFrame,
    counts: DataFrame,
    waste: DataFrame,
    new_cost_year: int = 2026,
) -> DataFrame:
    """Unrounded quantities and unit costs per week, store and ingredient that had sales."""
    return usage_rows(theoretical_usage(sales, recipe), ingredient, bought, counts, waste, new_cost_year)


def usage_rows(
    theoretical: DataFrame,
    ingredient: DataFrame,
    bought: DataFrame,
    counts: DataFrame,
    waste: DataFrame,
    new_cost_year: int = 2026,
) -> DataFrame:
    """The same from the `theoretical_usage`.

    `bought` are the `weekly_purchases`, read twice: for the store's own price and the chain's.

    The joins on the full grain come first and share one partitioning, which the aggregates already
    have; their sides grow with the data, so the merge hint rules a broadcast out. The chain price
    and the ingredient, keyed by less, follow.
    """
    opening = count_as(counts, "opening_qty", F.date_add("count_date", 1))
    closing = count_as(counts, "closing_qty", F.date_sub("count_date", 6))
    standard = F.when(F.year("week_start") >= new_cost_year, F.col("std_cost_2026")).otherwise(F.col("std_cost_2025"))
    purchased = zero_if_null(F.col("purchased_qty"))
    return (
        theoretical.join(bought.hint("merge"), WEEK_GRAIN, "left")
        .join(weekly_waste(waste).hint("merge"), WEEK_GRAIN, "left")
        .join(opening.hint("merge"), WEEK_GRAIN, "left")
        .join(closing.hint("merge"), WEEK_GRAIN, "left")
        .join(chain_price(bought), ["week_start", "ingredient_id"], "left")
        .join(ingredient.select("ingredient_id", "std_cost_2025", "std_cost_2026"), "ingredient_id")
        .select(
            *WEEK_GRAIN,
            "theoretical_qty",
            "opening_qty",
            purchased.alias("purchased_qty"),
            "closing_qty",
            (F.col("opening_qty") + purchased - F.col("closing_qty")).alias("actual_qty"),
            zero_if_null(F.col("recorded_waste_qty")).alias("recorded_waste_qty"),
            F.coalesce(
                ratio(F.col("purchased_cost"), F.col("purchased_qty")),
                F.col("chain_unit_cost"),
                standard.cast("double"),
            ).alias("unit_cost"),
            standard.alias("std_unit_cost"),
        )
    )


def usage_weekly_fact(base: DataFrame) -> DataFrame:
    """The bridge: theoretical at standard + price variance + recorded waste + unexplained = actual."""
    theo, actual, waste = (F.col(c).cast("double") for c in ("theoretical_qty", "actual_qty", "recorded_waste_qty"))
    cost, standard = F.col("unit_cost"), F.col("std_unit_cost").cast("double")
    return base.select(
        *WEEK_GRAIN,
        half_up(F.col("theoretical_qty"), 3).alias("theoretical_qty"),
        half_up(F.col("opening_qty"), 3).alias("opening_qty"),
        half_up(F.col("purchased_qty"), 3).alias("purchased_qty"),
        half_up(F.col("closing_qty"), 3).alias("closing_qty"),
        half_up(F.col("actual_qty"), 3).alias("actual_qty"),
        half_up(F.col("recorded_waste_qty"), 3).alias("recorded_waste_qty"),
        half_up(ratio(actual, theo) - 1, 4).alias("usage_variance_pct"),
        half_up(cost, 4).alias("unit_cost"),
        half_up(F.col("std_unit_cost"), 4).alias("std_unit_cost"),
        half_up(theo * standard, 2).alias("theoretical_cost_at_standard"),
        half_up(theo * (cost - standard), 2).alias("price_variance"),
        half_up(waste * cost, 2).alias("recorded_waste_cost"),
        half_up((actual - theo - waste) * cost, 2).alias("unexplained_variance"),
        half_up(actual * cost, 2).alias("actual_cost"),
    )


def bridge_gap() -> Column:
    """What the four parts miss of the actual cost."""
    parts = F.lit(0).cast("decimal(28,2)")
    for name in BRIDGE_PARTS:
        parts = parts + F.col(name)
    return F.abs(parts - F.col("actual_cost"))
