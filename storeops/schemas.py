"""Column order of the eleven extracts and the type each column gets when cleaned."""

from __future__ import annotations

from pyspark.sql import types as T

# Column name -> kind understood by operators.clean.typed, in file order.
EXTRACTS: dict[str, dict[str, str]] = {
    "pos_sales": {
        "business_date": "mixed_day",
        "store": "text",
        "daypart": "text",
        "menu_item_id": "text",
        "menu_item_name": "text",
        "qty_sold": "whole",
        "unit_price": "decimal(10,2)",
        "gross_sales": "decimal(12,2)",
        "discounts": "decimal(12,2)",
        "comps": "decimal(12,2)",
        "net_sales": "decimal(12,2)",
    },
    "pos_covers_hourly": {
        "business_date": "mixed_day",
        "store": "text",
        "hour_of_day": "whole",
        "covers": "whole",
        "net_sales": "decimal(12,2)",
    },
    "timeclock": {
        "shift_id": "text",
        "business_date": "day",
        "store": "text",
        "employee_id": "text",
        "role": "text",
        "scheduled_start": "minute",
        "scheduled_end": "minute",
        "actual_start": "minute",
        "actual_end": "minute",
    },
    "purchasing": {
        "po_line_id": "text",
        "delivery_date": "day",
        "store": "text",
        "supplier": "text",
        "ingredient_id": "text",
        "ingredient_name": "text",
        "qty_received": "double",
        "unit": "text",
        "unit_cost": "double",
        "line_total": "decimal(12,2)",
    },
    "inventory_counts": {
        "count_date": "day",
        "store": "text",
        "ingredient_id": "text",
        "qty_on_hand": "double",
        "unit": "text",
    },
    "waste_log": {
        "waste_date": "day",
        "store": "text",
        "ingredient_id": "text",
        "qty_wasted": "double",
        "unit": "text",
        "reason": "text",
    },
    "ref_locations": {
        "location_id": "text",
        "location_name": "text",
        "city": "text",
        "latitude": "double",
        "longitude": "double",
        "seats": "whole",
        "has_patio": "whole",
        "open_date": "day",
        "region": "text",
        "area_manager": "text",
    },
    "ref_menu": {
        "menu_item_id": "text",
        "menu_item_name": "text",
        "category": "text",
        "price_2025": "decimal(10,2)",
        "is_main": "whole",
        "price_2026": "decimal(10,2)",
        "price_change_date": "day",
    },
    "ref_ingredients": {
        "ingredient_id": "text",
        "ingredient_name": "text",
        "ingredient_category": "text",
        "unit": "text",
        "std_cost_2025": "decimal(12,4)",
        "expected_waste_rate": "decimal(6,4)",
        "is_produce": "whole",
        "std_cost_2026": "decimal(12,4)",
        "supplier": "text",
    },
    "ref_recipes": {
        "menu_item_id": "text",
        "ingredient_id": "text",
        "qty_per_item": "decimal(12,4)",
        "unit": "text",
    },
    "ref_employees": {
        "employee_id": "text",
        "employee_name": "text",
        "home_location_id": "text",
        "role": "text",
        "hourly_wage": "decimal(8,2)",
        "hire_date": "day",
    },
}

FILE_PATTERNS = {
    name: f"*{name}*" if name.startswith("ref_") else f"*{name}_extract*" for name in EXTRACTS
}


def text_schema(extract: str) -> T.StructType:
    """Every column as text, bound by position."""
    return T.StructType([T.StructField(name, T.StringType()) for name in EXTRACTS[extract]])


def kinds(extract: str, *names: str) -> dict[str, str]:
    """Kinds of the non-text columns, or of the named ones only."""
    wanted = names or EXTRACTS[extract]
    return {n: EXTRACTS[extract][n] for n in wanted if EXTRACTS[extract][n] != "text"}
