"""The star schema built from landed extracts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from storeops import fixed_values
from storeops.operators import calendar, dims, facts, foodcost, menu
from storeops.sources.tables import literal_rows, write_table

# Date column by which each large table is laid out.
MONTH_COLUMNS = {
    "fact_sales_item_daypart": "business_date",
    "fact_covers_hourly": "business_date",
    "fact_labour_shifts": "business_date",
    "fact_labour_hourly": "business_date",
    "fact_purchases": "delivery_date",
    "fact_inventory_counts": "count_date",
    "fact_waste_log": "waste_date",
    "fact_ingredient_usage_weekly": "week_start",
}

# Sums that one table alone is made from: written where a query reads them more often, else left lazy.
PASSED_ON = ("weekly_sold",)


@dataclass(frozen=True)
class Rules:
    """Dates and rates of the business, with the published values as defaults."""

    calendar_start: str = fixed_values.CALENDAR_START
    calendar_end: str = fixed_values.CALENDAR_END
    raise_date: str = "2026-01-01"
    raise_factor: str = "1.025"
    new_cost_year: int = 2026
    menu_from: str = "2025-01-01"
    menu_to: str = "2025-12-31"
    keep_unmapped: bool = False


def keep_lazy(name: str, df: DataFrame) -> DataFrame:
    return df


def keep_in(folder: str) -> Callable[[str, DataFrame], DataFrame]:
    """Write every table below `folder`; tables built later read the written ones."""

    def keep(name: str, df: DataFrame) -> DataFrame:
        if name in PASSED_ON:
            return df
        return write_table(df, f"{folder.rstrip('/')}/{name}", MONTH_COLUMNS.get(name))

    return keep


def alias_table(spark: SparkSession, rows: list[tuple[str, str]], master_col: str) -> DataFrame:
    return literal_rows(spark, rows, "alias_key", master_col)


class Warehouse:
    """Tables of the star schema, each built once on first use.

    `raw` maps extract names to landed frames. `keep` decides what happens to a built table: left
    lazy, written below a folder, or staged.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        store_alias: DataFrame,
        role_alias: DataFrame,
        rules: Rules = Rules(),
        keep: Callable[[str, DataFrame], DataFrame] = keep_lazy,
        suppliers: DataFrame | None = None,
    ):
        self.raw = raw
        self.store_alias = store_alias
        self.role_alias = role_alias
        self.rules = rules
        self.keep = keep
        self._suppliers = suppliers

    @property
    def suppliers(self) -> DataFrame:
        """Master supplier names: those given, else the ones the ingredients name."""
        return self._suppliers if self._suppliers is not None else self.raw["ref_ingredients"].select("supplier")

    def calendar_bounds(self) -> DataFrame:
        return calendar.day_range(self.store_alias.sparkSession, self.rules.calendar_start, self.rules.calendar_end)

    def holidays(self) -> DataFrame:
        return calendar.holiday_table(self.store_alias.sparkSession)

    @cached_property
    def dim_location(self) -> DataFrame:
        return self.keep("dim_location", dims.location_dim(self.raw["ref_locations"]))

    @cached_property
    def dim_ingredient(self) -> DataFrame:
        return self.keep("dim_ingredient", dims.ingredient_dim(self.raw["ref_ingredients"]))

    @cached_property
    def bridge_recipe(self) -> DataFrame:
        return self.keep("bridge_recipe", dims.recipe_bridge(self.raw["ref_recipes"]))

    @cached_property
    def dim_menu_item(self) -> DataFrame:
        items = dims.menu_item_dim(self.raw["ref_menu"], self.bridge_recipe, self.dim_ingredient)
        return self.keep("dim_menu_item", items)

    @cached_property
    def dim_employee(self) -> DataFrame:
        return self.keep("dim_employee", dims.employee_dim(self.raw["ref_employees"]))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.keep("dim_date", calendar.build_calendar(self.calendar_bounds(), self.holidays()))

    @cached_property
    def fact_sales_item_daypart(self) -> DataFrame:
        fact = facts.sales_fact(self.raw["pos_sales"], self.store_alias, self.rules.keep_unmapped)
        return self.keep("fact_sales_item_daypart", fact)

    @cached_property
    def fact_covers_hourly(self) -> DataFrame:
        return self.keep("fact_covers_hourly", facts.covers_fact(self.raw["pos_covers_hourly"], self.store_alias))

    @cached_property
    def fact_labour_shifts(self) -> DataFrame:
        fact = facts.shifts_fact(
            self.raw["timeclock"],
            self.store_alias,
            self.role_alias,
            self.dim_employee,
            self.rules.raise_date,
            self.rules.raise_factor,
        )
        return self.keep("fact_labour_shifts", fact)

    @cached_property
    def fact_labour_hourly(self) -> DataFrame:
        fact = facts.labour_hourly_fact(self.fact_labour_shifts, self.fact_covers_hourly)
        return self.keep("fact_labour_hourly", fact)

    @cached_property
    def fact_purchases(self) -> DataFrame:
        fact = facts.purchases_fact(self.raw["purchasing"], self.store_alias, self.suppliers)
        return self.keep("fact_purchases", fact)

    @cached_property
    def fact_inventory_counts(self) -> DataFrame:
        return self.keep("fact_inventory_counts", facts.counts_fact(self.raw["inventory_counts"], self.store_alias))

    @cached_property
    def fact_waste_log(self) -> DataFrame:
        return self.keep("fact_waste_log", facts.waste_fact(self.raw["waste_log"], self.store_alias))

    @cached_property
    def weekly_sold(self) -> DataFrame:
        """Quantity and net sales by week, store and item."""
        return self.keep("weekly_sold", foodcost.weekly_sold(self.fact_sales_item_daypart, "net_sales"))

    @cached_property
    def weekly_purchases(self) -> DataFrame:
        return self.keep("weekly_purchases", foodcost.weekly_purchases(self.fact_purchases))

    @cached_property
    def fact_ingredient_usage_weekly(self) -> DataFrame:
        base = foodcost.usage_rows(
            foodcost.recipe_usage(self.weekly_sold, self.bridge_recipe),
            self.dim_ingredient,
            self.weekly_purchases,
            self.fact_inventory_counts,
            self.fact_waste_log,
            self.rules.new_cost_year,
        )
        return self.keep("fact_ingredient_usage_weekly", foodcost.usage_weekly_fact(base))

    @cached_property
    def menu_engineering(self) -> DataFrame:
        return self.keep("menu_engineering", menu.menu_quadrants(self.dim_menu_item, self.sold_by_item))

    @cached_property
    def sold_by_item(self) -> DataFrame:
        sold = menu.sold_by_item(self.fact_sales_item_daypart, self.rules.menu_from, self.rules.menu_to)
        return self.keep("sold_by_item", sold)

    TABLES = (
        "dim_date",
        "dim_location",
        "dim_menu_item",
        "dim_ingredient",
        "dim_employee",
        "bridge_recipe",
        "fact_sales_item_daypart",
        "fact_covers_hourly",
        "fact_labour_shifts",
        "fact_labour_hourly",
        "fact_purchases",
        "fact_inventory_counts",
        "fact_waste_log",
        "fact_ingredient_usage_weekly",
        "menu_engineering",
    )

    def prepare(self, *names: str) -> None:
        """Build tables that do not depend on each other at the same time.

        Worth it where `keep` writes them: the tail of one write then overlaps with the next.
        """
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            list(pool.map(lambda name: getattr(self, name), names))

    def build_all(self) -> dict[str, DataFrame]:
        """Every table, in three waves: dimensions, facts from extracts, facts from facts."""
        self.prepare("dim_date", "dim_location", "dim_ingredient", "dim_employee", "bridge_recipe")
        self.prepare(
            "dim_menu_item",
            "fact_sales_item_daypart",
            "fact_covers_hourly",
            "fact_labour_shifts",
            "fact_purchases",
            "fact_inventory_counts",
            "fact_waste_log",
        )
        self.prepare("fact_labour_hourly", "fact_ingredient_usage_weekly", "menu_engineering")
        return self.tables()

    def tables(self) -> dict[str, DataFrame]:
        """Every table by name, in the order of the row-count summary."""
        return {name: getattr(self, name) for name in self.TABLES}


def published_warehouse(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    rules: Rules = Rules(),
    keep: Callable[[str, DataFrame], DataFrame] = keep_lazy,
) -> Warehouse:
    """A warehouse with the published alias lists, calendar and holidays."""
    return Warehouse(
        raw,
        alias_table(spark, fixed_values.STORE_ALIASES, "location_id"),
        alias_table(spark, fixed_values.ROLE_ALIASES, "role"),
        rules,
        keep,
    )
