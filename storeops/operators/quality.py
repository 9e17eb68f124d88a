"""The logged quality run, the source-to-clean reconciliation and the latest-run view."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.fixed_values import QUALITY_RULES
from storeops.functions.columns import ISO_DAY, TEXT_MONTH_DAY, flag, match_key, try_day, try_decimal
from storeops.operators.facts import is_inverted_shift, net_rebuilt_difference
from storeops.operators.foodcost import bridge_gap
from storeops.sources.tables import literal_rows

STORE_EXTRACTS = ("pos_sales", "pos_covers_hourly", "timeclock", "purchasing", "inventory_counts", "waste_log")
STORE_FACTS = (
    "fact_sales_item_daypart",
    "fact_covers_hourly",
    "fact_labour_shifts",
    "fact_purchases",
    "fact_inventory_counts",
    "fact_waste_log",
)


def _counts(df: DataFrame, checks: Mapping[int, Column]) -> DataFrame:
    """One pass over a table: each check adds one row (check_id, issue_count)."""
    totals = df.agg(*[F.sum(value.cast("bigint")).alias(str(check)) for check, value in checks.items()])
    ids = [str(check) for check in checks]
    long = totals.unpivot([], ids, "check_id", "issue_count")
    return long.select(F.col("check_id").cast("int"), "issue_count")


def _named(check: int) -> str:
    """The column of a profile that holds a row check."""
    return f"check_{check}"


def _sums(checks: Mapping[int, Column]) -> list[Column]:
    return [F.count("*").alias("rows"), *[F.sum(v.cast("bigint")).alias(_named(c)) for c, v in checks.items()]]


def profiles(raw: Mapping[str, DataFrame], core: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What the checks need of each extract and fact: row counts and row checks per spelling, item, unit or day.

    Each table is read by one grouped pass, and all its checks work on the small result. Sales, raw and clean, and
    shifts have two groupings each, which one pass serves as grouping sets or as a sum of sums.
    """
    unmapped = flag(F.col("location_id").isNull())
    text_date = flag(
        try_day(F.col("business_date"), ISO_DAY).isNull() & try_day(F.col("business_date"), TEXT_MONTH_DAY).isNotNull()
    )
    raw_sales = raw["pos_sales"].select("store", "menu_item_id", "menu_item_name", text_date.cast("bigint").alias(_named(2)))
    sales_checks = {
        3: F.col("is_net_sales_imputed"),
        4: flag(F.col("business_date").isNull()),
        7: flag(net_rebuilt_difference() > F.lit("0.01").cast("decimal(3,2)")),
        10: unmapped,
    }
    # The dates and stores are grouping keys as well, so their tests are made before the grouping blanks them.
    sales = core["fact_sales_item_daypart"].select(
        "business_date", "location_id", "menu_item_id", "net_sales", *[v.cast("bigint").alias(_named(c)) for c, v in sales_checks.items()]
    )
    shift_checks = {
        10: unmapped,
        13: F.col("is_clock_out_imputed"),
        14: flag(F.col("role").isNull()),
        15: is_inverted_shift(),
        16: flag(F.col("hourly_wage").isNull()),
    }
    shift_days = core["fact_labour_shifts"].groupBy("employee_id", "business_date").agg(*_sums(shift_checks))
    usage_checks = {
        23: flag(F.col("opening_qty").isNull() | F.col("closing_qty").isNull()),
        24: flag(bridge_gap() > F.lit("0.05").cast("decimal(3,2)")),
    }
    purchase_checks = {10: unmapped, 19: F.col("is_unit_converted"), 21: flag(F.col("supplier").isNull())}
    return {
        "pos_sales": raw_sales.groupingSets(
            [("store",), ("menu_item_id", "menu_item_name")], "store", "menu_item_id", "menu_item_name"
        ).agg(F.grouping("store").alias("by_name"), *_sums({2: F.col(_named(2))})),
        "pos_covers_hourly": raw["pos_covers_hourly"].groupBy("store").agg(*_sums({})),
        "timeclock": raw["timeclock"].groupBy("store", "role").agg(*_sums({})),
        "purchasing": raw["purchasing"].groupBy("store").agg(*_sums({})),
        "inventory_counts": raw["inventory_counts"].groupBy("store").agg(*_sums({})),
        "waste_log": raw["waste_log"].groupBy("store").agg(*_sums({})),
        "fact_sales_item_daypart": sales.groupingSets(
            [("business_date", "location_id"), ("menu_item_id",)], "business_date", "location_id", "menu_item_id"
        ).agg(
            F.grouping("menu_item_id").alias("by_day"),
            F.count("*").alias("rows"),
            F.sum("net_sales").alias("net_sales"),
            *[F.sum(_named(c)).alias(_named(c)) for c in sales_checks],
        ),
        "fact_covers_hourly": core["fact_covers_hourly"]
        .groupBy("business_date", "location_id")
        .agg(F.sum("net_sales").alias("net_sales"), *_sums({10: unmapped})),
        "fact_labour_shifts": shift_days.agg(
            F.sum("rows").alias("rows"),
            F.sum(flag(F.col("rows") > 1)).alias(_named(17)),
            *[F.sum(_named(c)).alias(_named(c)) for c in shift_checks],
        ),
        "fact_purchases": core["fact_purchases"].groupBy("ingredient_id", "unit").agg(*_sums(purchase_checks)),
        "fact_inventory_counts": core["fact_inventory_counts"].agg(*_sums({10: unmapped, 22: flag(F.col("qty_on_hand") < 0)})),
        "fact_waste_log": core["fact_waste_log"].agg(*_sums({10: unmapped})),
        "fact_ingredient_usage_weekly": core["fact_ingredient_usage_weekly"].agg(*_sums(usage_checks)),
    }


def quality_counts(
    raw: Mapping[str, DataFrame],
    core: Mapping[str, DataFrame],
    store_alias: DataFrame,
    role_alias: DataFrame,
    hold: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> DataFrame:
    """Signed contributions per check, added up to one count per check.

    A check over two tables, such as rows in less rows out, gets +1 per row of the first and -1 per row of the
    second, so no totals need to be joined. `hold` writes the profiles, which several checks read: then every
    extract and fact is read once.
    """
    found = profiles(raw, core)
    with ThreadPoolExecutor(max_workers=4) as pool:
        found = dict(zip(found, pool.map(lambda item: hold(*item), found.items())))
    rows = F.col("rows")
    sales = found["fact_sales_item_daypart"]
    by_day, by_item = sales.filter("by_day = 1"), sales.filter("by_day = 0")
    by_store, by_name = found["pos_sales"].filter("by_name = 0"), found["pos_sales"].filter("by_name = 1")

    def own(*checks: int) -> dict[int, Column]:
        return {c: F.col(_named(c)) for c in checks}

    parts = [
        _counts(by_store, {1: rows, **own(2)}),
        _counts(by_day, {1: -rows, **own(3, 4, 7, 10)}),
        _counts(found["fact_covers_hourly"], own(10)),
        _counts(found["timeclock"], {11: rows}),
        _counts(found["fact_labour_shifts"], {11: -rows, **own(10, 13, 14, 15, 16, 17)}),
        _counts(found["purchasing"], {18: rows}),
        _counts(found["fact_purchases"], {18: -rows, **own(10, 19, 21)}),
        _counts(found["fact_inventory_counts"], own(10, 22)),
        _counts(found["fact_waste_log"], own(10)),
        _counts(found["fact_ingredient_usage_weekly"], own(23, 24)),
    ]

    names = by_name.select("menu_item_id", "menu_item_name", "rows")
    master = raw["ref_menu"].select("menu_item_id", F.col("menu_item_name").alias("master_name"))
    differs = match_key(F.col("menu_item_name")) != match_key(F.col("master_name"))
    parts.append(_counts(names.join(master, "menu_item_id").filter(differs), {5: rows}))

    parts.append(_counts(by_item.join(core["dim_menu_item"], "menu_item_id", "left_anti"), {6: rows}))

    store_day = ["business_date", "location_id"]
    items = by_day.select(*store_day, F.col("net_sales").alias("item_amount"))
    hours = found["fact_covers_hourly"].select(*store_day, F.col("net_sales").alias("hour_amount"))
    gap = F.abs(F.coalesce("item_amount", F.lit(0)) - F.coalesce("hour_amount", F.lit(0)))
    parts.append(_counts(items.join(hours, store_day, "full"), {8: flag(gap > 1)}))

    spellings = found | {"pos_sales": by_store}
    spelled = reduce(DataFrame.unionByName, [spellings[name].select("store", "rows") for name in STORE_EXTRACTS])
    spelled = spelled.groupBy("store").agg(F.sum("rows").alias("rows"))
    known = spelled.join(store_alias, match_key(F.col("store")) == F.col("alias_key")).join(
        core["dim_location"].select("location_id", "location_name"), "location_id"
    )
    parts.append(_counts(known.filter(F.col("store") != F.col("location_name")), {9: rows}))

    roles = found["timeclock"].groupBy(F.col("role").alias("typed_role")).agg(F.sum("rows").alias("rows"))
    renamed = roles.join(role_alias, match_key(F.col("typed_role")) == F.col("alias_key"))
    parts.append(_counts(renamed.filter(F.col("typed_role") != F.col("role")), {12: rows}))

    units = found["fact_purchases"].select("ingredient_id", "unit", "rows")
    master_units = core["dim_ingredient"].select("ingredient_id", F.col("unit").alias("master_unit"))
    wrong = units.join(master_units, "ingredient_id").filter(F.col("unit") != F.col("master_unit"))
    parts.append(_counts(wrong, {20: rows}))

    return reduce(DataFrame.unionByName, parts).groupBy("check_id").agg(F.sum("issue_count").alias("issue_count"))


def quality_run(counts: DataFrame, run_at: datetime | None = None) -> DataFrame:
    """The 24 log rows of one run, with status FIXED, PASS or FAIL."""
    rules = literal_rows(
        counts.sparkSession, QUALITY_RULES, "check_id", "check_area", "check_name", "rule_type"
    )
    issues = F.coalesce("issue_count", F.lit(0)).cast("bigint")
    return rules.join(counts, "check_id", "left").select(
        F.lit(run_at or datetime.now()).cast("timestamp").alias("run_at"),
        "check_id",
        "check_area",
        "check_name",
        issues.alias("issue_count"),
        "rule_type",
        F.when(F.col("rule_type") == "FIXED", "FIXED").when(issues == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def latest_run(log: DataFrame) -> DataFrame:
    """The rows of the most recent run in the history log."""
    newest = log.agg(F.max("run_at")).scalar()
    return (
        log.filter(F.col("run_at") == newest)
        .select("check_id", "check_area", "check_name", "issue_count", "status")
        .orderBy("check_id")
    )


def reconcile_monthly(raw_sales: DataFrame, sales: DataFrame) -> DataFrame:
    """Net sales per month as received and as cleaned; months on both sides only."""
    day = try_day(F.col("business_date"), ISO_DAY, TEXT_MONTH_DAY)
    received = raw_sales.groupBy(F.date_format(day, "yyyy-MM").alias("year_month")).agg(
        F.sum(try_decimal(F.col("net_sales"), 12, 2)).alias("raw_net_sales")
    )
    clean = sales.groupBy(F.date_format("business_date", "yyyy-MM").alias("year_month")).agg(
        F.sum("net_sales").alias("core_net_sales")
    )
    return (
        received.join(clean, "year_month")
        .select(
            "year_month",
            "raw_net_sales",
            "core_net_sales",
            (F.col("core_net_sales") - F.col("raw_net_sales")).alias("difference"),
        )
        .orderBy("year_month")
    )
