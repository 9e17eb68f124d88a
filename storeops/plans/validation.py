"""The full validation suite: 67 checks on the clean tables and 7 on the raw ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import ratio, weekday_number
from storeops.operators import checks as c
from storeops.operators.facts import net_rebuilt_difference
from storeops.schemas import EXTRACTS


@dataclass(frozen=True)
class Expectations:
    """What the published data are known to contain."""

    price_change: str = "2026-01-05"
    closed_day: str = "12-25"
    wage_floor: str = "17.85"
    weekly_hours_cap: float = 48.0
    shift_hours: tuple[int, int] = (3, 10)
    manager_role: str = "Manager"
    story_from: str = "2026-03-02"
    labour_story: tuple[str, int] = ("L06", 1)
    usage_story: tuple[str, str] = ("L05", "I13")
    usage_before: float = 1.055
    price_months: tuple[str, str] = ("2025-02", "2026-02")
    food_band: tuple[float, float] = (0.26, 0.32)
    labour_band: tuple[float, float] = (0.27, 0.34)


Hold = Callable[[str, DataFrame], DataFrame]

# Tables with a row per line or event, whose keys are compared by digest first.
LONG_TABLES = ("sales", "shifts", "purchases")


def as_is(name: str, df: DataFrame) -> DataFrame:
    return df


def key_checks(core: Mapping[str, DataFrame], prices: DataFrame, targets: DataFrame, hold: Hold = as_is) -> list[DataFrame]:
    keys = [
        ("dim_location", core["dim_location"], ["location_id"]),
        ("dim_date", core["dim_date"], ["calendar_date"]),
        ("dim_menu_item", core["dim_menu_item"], ["menu_item_id"]),
        ("dim_ingredient", core["dim_ingredient"], ["ingredient_id"]),
        ("dim_employee", core["dim_employee"], ["employee_id"]),
        ("bridge_recipe", core["bridge_recipe"], ["menu_item_id", "ingredient_id"]),
        ("sales", core["fact_sales_item_daypart"], ["business_date", "location_id", "daypart", "menu_item_id"]),
        ("covers", core["fact_covers_hourly"], ["business_date", "location_id", "hour_of_day"]),
        ("shifts", core["fact_labour_shifts"], ["shift_id"]),
        ("labour hours", core["fact_labour_hourly"], ["business_date", "location_id", "hour_of_day"]),
        ("weekly prices", prices, ["week_start", "ingredient_id"]),
        ("usage", core["fact_ingredient_usage_weekly"], ["week_start", "location_id", "ingredient_id"]),
        ("counts", core["fact_inventory_counts"], ["count_date", "location_id", "ingredient_id"]),
        ("targets", targets, ["year_month", "location_id"]),
        ("purchases", core["fact_purchases"], ["po_line_id"]),
    ]
    return [
        c.unique_key(f"unique key: {name}", df, cols, partial(hold, f"{name}_key_digests") if name in LONG_TABLES else None)
        for name, df, cols in keys
    ]


def reference_checks(core: Mapping[str, DataFrame], prices: DataFrame, weather: DataFrame) -> list[DataFrame]:
    ids = [
        ("sales store", "fact_sales_item_daypart", "location_id", "dim_location"),
        ("sales item", "fact_sales_item_daypart", "menu_item_id", "dim_menu_item"),
        ("recipe item", "bridge_recipe", "menu_item_id", "dim_menu_item"),
        ("recipe ingredient", "bridge_recipe", "ingredient_id", "dim_ingredient"),
        ("shift employee", "fact_labour_shifts", "employee_id", "dim_employee"),
        ("purchase ingredient", "fact_purchases", "ingredient_id", "dim_ingredient"),
    ]
    dates = [
        ("sales date", core["fact_sales_item_daypart"], "business_date"),
        ("covers date", core["fact_covers_hourly"], "business_date"),
        ("shift date", core["fact_labour_shifts"], "business_date"),
        ("labour hour date", core["fact_labour_hourly"], "business_date"),
        ("purchase date", core["fact_purchases"], "delivery_date"),
        ("count date", core["fact_inventory_counts"], "count_date"),
        ("waste date", core["fact_waste_log"], "waste_date"),
        ("price week", prices, "week_start"),
        ("usage week", core["fact_ingredient_usage_weekly"], "week_start"),
        ("weather date", weather, "date"),
    ]
    return [
        c.no_orphans(f"known: {name}", core[fact], col, core[dim], col) for name, fact, col, dim in ids
    ] + [c.no_orphans(f"known: {name}", df, col, core["dim_date"], "calendar_date") for name, df, col in dates]


def sales_checks(core: Mapping[str, DataFrame], known: Expectations) -> list[DataFrame]:
    sales, covers = core["fact_sales_item_daypart"], core["fact_covers_hourly"]
    measures = ["qty_sold", "gross_sales", "discounts", "comps", "net_sales"]
    negative = F.lit(False)
    for m in measures:
        negative = negative | ~F.coalesce(F.col(m) >= 0, F.lit(False))
    rebuilt = F.col("gross_sales") - F.col("discounts") - F.col("comps")
    return [
        c.same_keys("every menu item has a recipe", core["dim_menu_item"], core["bridge_recipe"], "menu_item_id"),
        c.joined_agree(
            "recipe unit is the ingredient's", core["bridge_recipe"], "unit", core["dim_ingredient"], "unit", "ingredient_id"
        ),
        c.row_rules(
            sales,
            {
                "no negative sales": negative,
                "net is gross less discounts and comps": ~c.close(rebuilt, F.col("net_sales"), 0.011),
                "gross is quantity x price": ~c.close(
                    F.col("qty_sold") * F.col("unit_price"), F.col("gross_sales"), 0.011
                ),
                "no sales on the closed day": F.date_format("business_date", "MM-dd") == known.closed_day,
            },
        ),
        c.price_by_date("unit price is the list price of the date", sales, core["dim_menu_item"], known.price_change),
        c.reconciled(
            "hourly sales add up to item sales", sales, covers, ["business_date", "location_id", "daypart"], "net_sales", "0.2"
        ),
        c.row_rules(covers, {"covers wherever there are sales": (F.col("net_sales") > 0) & ~F.coalesce(F.col("covers") > 0, F.lit(False))}),
    ]


def labour_checks(core: Mapping[str, DataFrame], known: Expectations) -> list[DataFrame]:
    shifts, hourly, employee = core["fact_labour_shifts"], core["fact_labour_hourly"], core["dim_employee"]
    in_order = (F.col("actual_end") > F.col("actual_start")) & (F.col("scheduled_end") > F.col("scheduled_start"))
    cost = F.col("actual_hours") * F.col("hourly_wage")
    return [
        c.row_rules(
            shifts,
            {
                "shifts end after they start": ~F.coalesce(in_order, F.lit(False)),
                "shifts last 3 to 10 hours": ~F.coalesce(F.col("actual_hours").between(*known.shift_hours), F.lit(False)),
                "labour cost is hours x wage": ~c.close(cost, F.col("labour_cost"), 0.011),
            },
        ),
        c.totals_close(
            "hourly labour adds up to shifts", hourly, F.sum("labour_cost"), shifts, F.sum("labour_cost"), 1e-4
        ),
        c.totals_close(
            "hourly covers are the covers", hourly, F.sum("covers"), core["fact_covers_hourly"], F.sum("covers"), 0
        ),
        c.joined_agree("shift role is the employee's", shifts, "role", employee, "role", "employee_id"),
        c.joined_agree(
            "shift store is the employee's", shifts, "location_id", employee, "home_location_id", "employee_id"
        ),
        c.hired_before("employees are hired before they work", shifts, employee),
        c.largest_group("one shift per employee and day", shifts, ["employee_id", "business_date"], 1),
        c.weekly_cap("weekly hours under the cap", shifts, known.weekly_hours_cap),
        c.at_least("wages above the legal minimum", employee, "hourly_wage_2025", known.wage_floor),
        c.smallest_group(
            "two managers per store and day", shifts.filter(F.col("role") == known.manager_role), ["business_date", "location_id"], 2
        ),
    ]


def inventory_checks(core: Mapping[str, DataFrame], prices: DataFrame) -> list[DataFrame]:
    usage, counts, purchases = (
        core["fact_ingredient_usage_weekly"],
        core["fact_inventory_counts"],
        core["fact_purchases"],
    )
    return [
        c.stock_identity("actual usage is opening + purchases - closing", usage, counts, purchases),
        c.row_rules(counts, {"no negative counts": ~F.coalesce(F.col("qty_on_hand") >= 0, F.lit(False))}),
        c.row_rules(purchases, {"no negative purchases": ~F.coalesce(F.col("qty_received") > 0, F.lit(False))}),
        c.theoretical_again(
            "theoretical usage is sales x recipe", usage, core["fact_sales_item_daypart"], core["bridge_recipe"]
        ),
        c.complete_grid("a price for every week and ingredient", prices, "week_start", core["dim_ingredient"]),
    ]


def story_checks(
    core: Mapping[str, DataFrame], prices: DataFrame, weather: DataFrame, known: Expectations
) -> list[DataFrame]:
    hourly, usage, covers = core["fact_labour_hourly"], core["fact_ingredient_usage_weekly"], core["fact_covers_hourly"]
    sales, shifts = core["fact_sales_item_daypart"], core["fact_labour_shifts"]
    store, weekday = known.labour_story
    leak_store, leak_item = known.usage_story
    labour = (
        hourly.groupBy("location_id", weekday_number(F.col("business_date")).alias("dow"))
        .agg(ratio(F.sum("labour_cost"), F.sum("net_sales")).alias("share"))
        .filter(F.col("location_id").isNotNull())
    )
    item_usage = usage.filter(F.col("ingredient_id") == leak_item)
    since = F.col("week_start") >= F.lit(known.story_from).cast("date")
    over = (
        item_usage.filter(since)
        .groupBy("location_id")
        .agg((ratio(F.sum("actual_qty"), F.sum("theoretical_qty")) - 1).alias("over"))
        .filter(F.col("location_id").isNotNull())
    )
    item_prices = prices.filter(F.col("ingredient_id") == leak_item)
    price = prices.select("week_start", "ingredient_id", "market_unit_cost")
    used = usage.groupBy("week_start", "ingredient_id").agg(F.sum("actual_qty").alias("qty"))
    food = used.join(price, ["week_start", "ingredient_id"])
    return [
        c.stands_out(
            "one store-weekday has the highest labour share",
            labour,
            "share",
            (F.col("location_id") == store) & (F.col("dow") == weekday),
            0.05,
        ),
        c.stands_out("one store over-uses the ingredient", over, "over", F.col("location_id") == leak_store, 0.15),
        c.ratio_near(
            "that store used it normally before",
            item_usage.filter((F.col("location_id") == leak_store) & ~since),
            "actual_qty",
            "theoretical_qty",
            known.usage_before,
            0.03,
        ),
        c.mean_rose(
            "its price rose year on year",
            item_prices,
            "market_unit_cost",
            F.date_format("week_start", "yyyy-MM"),
            *known.price_months,
            1.4,
        ),
        c.distinct_report(
            "menu items using the ingredient",
            core["bridge_recipe"].filter(F.col("ingredient_id") == leak_item),
            "menu_item_id",
        ),
        c.ratio_in_band(
            "food cost share is plausible",
            food,
            F.sum(F.col("qty") * F.col("market_unit_cost")),
            sales,
            F.sum("net_sales"),
            *known.food_band,
        ),
        c.ratio_in_band(
            "labour share is plausible", shifts, F.sum("labour_cost"), sales, F.sum("net_sales"), *known.labour_band
        ),
        c.busier_month("July is busier than January", covers, 7, 1, 1.15),
        c.busiest_weekday("Saturday is busiest, Monday slowest", covers, 6, 1),
        c.rainy_days_slower("rainy days are slower", covers, weather),
    ]


def raw_checks(raw: Mapping[str, DataFrame], core: Mapping[str, DataFrame], hold: Hold) -> list[DataFrame]:
    digests = partial(hold, "raw_sales_digests")
    profile = hold("sales_profile", c.profile_of_sales(raw["pos_sales"], list(EXTRACTS["pos_sales"]), digests))
    clean = core["fact_sales_item_daypart"]
    kept = c.side_by_side(profile, F.max("kinds"), clean, F.count("*"))
    return [
        c.found_in(profile, "raw sales hold copies", "copies"),
        c.share_of_rows(profile, "raw sales hold text dates", "text_dates", 0.03),
        c.found_in(profile, "raw sales miss net values", "missing_net"),
        c.found_in(profile, "raw sales spell stores in many ways", "spellings", 10, " distinct"),
        c.defects_present(raw["purchasing"], {"raw purchases hold pounds": F.col("unit") == "lb"}),
        c.defects_present(raw["timeclock"], {"raw timeclock misses ends": F.col("actual_end").isNull()}),
        c.same_count(kept, "raw sales without copies are the clean rows"),
    ]


def validation_suite(
    raw: Mapping[str, DataFrame],
    core: Mapping[str, DataFrame],
    prices: DataFrame,
    weather: DataFrame,
    targets: DataFrame,
    known: Expectations = Expectations(),
    hold: Hold = as_is,
) -> DataFrame:
    """All 74 checks, failures first.

    `prices` has week_start, ingredient_id, market_unit_cost; `weather` date, is_rainy_day; `targets`
    year_month, location_id. Every table and the raw sales are read by several checks: pass written tables.
    `hold` writes the profile of the raw sales, from which five checks are read, repeated digests, and the rows of
    each kind of check, so that the shuffles of one kind are gone before the next begins.
    """
    kinds = {
        "key": key_checks(core, prices, targets, hold),
        "reference": reference_checks(core, prices, weather),
        "sales": sales_checks(core, known),
        "labour": labour_checks(core, known),
        "inventory": inventory_checks(core, prices),
        "story": story_checks(core, prices, weather, known),
        "raw": raw_checks(raw, core, hold),
    }
    return c.report([hold(f"{kind}_checks", c.stacked(checks)) for kind, checks in kinds.items()])
