"""Dimensions and the recipe bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import half_up, ratio
from storeops.operators.clean import type_columns
from storeops.schemas import kinds


def location_dim(raw: DataFrame) -> DataFrame:
    return type_columns(raw, kinds("ref_locations")).select(
        "location_id",
        "location_name",
        "city",
        "region",
        "area_manager",
        "latitude",
        "longitude",
        "seats",
        "has_patio",
        "open_date",
    )


def ingredient_dim(raw: DataFrame) -> DataFrame:
    return type_columns(raw, kinds("ref_ingredients")).select(
        "ingredient_id",
        "ingredient_name",
        "ingredient_category",
        "unit",
        "supplier",
        "std_cost_2025",
        "std_cost_2026",
        "expected_waste_rate",
        "is_produce",
    )


def recipe_bridge(raw: DataFrame) -> DataFrame:
    return type_columns(raw, kinds("ref_recipes")).select(
        "menu_item_id", "ingredient_id", "qty_per_item", "unit"
    )


def employee_dim(raw: DataFrame) -> DataFrame:
    return (
        type_columns(raw, kinds("ref_employees"))
        .withColumnRenamed("hourly_wage", "hourly_wage_2025")
        .select("employee_id", "employee_name", "home_location_id", "role", "hourly_wage_2025", "hire_date")
    )


def plate_cost(recipe: DataFrame, ingredient: DataFrame) -> DataFrame:
    """Standard cost of one portion per item, for both cost years."""
    costs = ingredient.select("ingredient_id", "std_cost_2025", "std_cost_2026")
    return (
        recipe.join(costs, "ingredient_id")
        .groupBy("menu_item_id")
        .agg(
            F.sum(F.col("qty_per_item") * F.col("std_cost_2025")).alias("food_cost_2025"),
            F.sum(F.col("qty_per_item") * F.col("std_cost_2026")).alias("food_cost_2026"),
        )
    )


def menu_item_dim(raw: DataFrame, recipe: DataFrame, ingredient: DataFrame) -> DataFrame:
    """Menu items with plate cost, margin and food-cost share; an item without a recipe keeps NULLs."""
    items = type_columns(raw, kinds("ref_menu"))
    per_year = [
        column
        for year in ("2025", "2026")
        for column in (
            half_up(F.col(f"food_cost_{year}"), 3).alias(f"std_food_cost_{year}"),
            half_up(F.col(f"price_{year}") - F.col(f"food_cost_{year}"), 2).alias(f"contribution_margin_{year}"),
            half_up(ratio(F.col(f"food_cost_{year}"), F.col(f"price_{year}")), 4).alias(f"food_cost_pct_{year}"),
        )
    ]
    return items.join(plate_cost(recipe, ingredient), "menu_item_id", "left").select(
        "menu_item_id",
        "menu_item_name",
        "category",
        "is_main",
        "price_2025",
        "price_2026",
        "price_change_date",
        *per_year,
    )
