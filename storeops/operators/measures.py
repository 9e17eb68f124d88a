"""Dashboard measures. Facts are summed to the wanted grain first and only then joined."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.fixed_values import AVG_CHECK_TARGET, FOOD_COST_TARGET, LABOUR_TARGET
from storeops.functions.columns import monday_of, ratio, weekday_name, weekday_number, zero_if_null
from storeops.functions.text import percent_text, sentence, whole_text
from storeops.operators.foodcost import BRIDGE_PARTS

WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# First and last hour shown in the heatmap.
HEATMAP_HOURS = (7, 22)

# Step name -> bridge column, in display order.
WATERFALL_STEPS = {
    "Supplier price": "price_variance",
    "Recorded waste": "recorded_waste_cost",
    "Unexplained": "unexplained_variance",
}


# --- sales, covers and last year -------------------------------------------------------------


def period_column(period: str, d: Column) -> Column:
    if period == "year":
        return F.year(d)
    if period == "year_month":
        return F.date_format(d, "yyyy-MM")
    raise ValueError(f"unknown period: {period}")


def side_by_side(parts: Sequence[DataFrame], keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Sums from several facts, each already summed per group, in one row per group.

    The sums are stacked and added up instead of joined: groups without a key (unmapped stores, undated
    rows) stay a group of their own, and without any keys there is one row, the total.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def sales_summary(
    sales: DataFrame, covers: DataFrame, by: Sequence[str] = (), period: str | None = None
) -> DataFrame:
    """Net sales, covers and average check per group, from two facts. No keys: one row for the chain."""
    keys = [*by, period] if period else list(by)

    def total(df: DataFrame, name: str) -> DataFrame:
        if period:
            df = df.withColumn(period, period_column(period, F.col("business_date")))
        return df.groupBy(*keys).agg(F.sum(name).alias(name))

    both = side_by_side([total(sales, "net_sales"), total(covers, "covers")], keys, ["net_sales", "covers"])
    return both.withColumn("avg_check", ratio(F.col("net_sales"), F.col("covers")))


def daily_totals(df: DataFrame, value: Column, by: Sequence[str] = (), name: str = "amount") -> DataFrame:
    """One row per day (and group): the grain at which years are compared."""
    return df.filter(F.col("business_date").isNotNull()).groupBy("business_date", *by).agg(value.alias(name))


def against_last_year(daily: DataFrame, calendar: DataFrame, by: Sequence[str] = (), name: str = "amount") -> DataFrame:
    """Each calendar day with its amount and that of the same date a year before, per group.

    Days present in one year only stay, with NULL on the other side. `calendar` has one row per day
    and joins by date, so groups and days are never multiplied. A 29 February is compared with the
    28th; that day is summed once, with the 28th.
    """
    days = calendar.select(
        F.col("calendar_date").alias("business_date"), F.add_months("calendar_date", -12).alias("ly_date")
    )
    current = daily.join(days.select("business_date"), "business_date")
    last = (
        daily.withColumnsRenamed({"business_date": "ly_date", name: f"{name}_ly"})
        .join(days, "ly_date")
        .drop("ly_date")
    )
    leap_day = F.date_format("business_date", "MM-dd") == "02-29"
    # Group values may be missing (unmapped stores); the join matches them like any other value.
    keys = ["business_date", *by]
    last = last.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    joined = current.join(last, match, "full").select(
        *[F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in keys], name, f"{name}_ly"
    )
    return joined.withColumns(
        {
            f"{name}_comparable": F.when(F.col(f"{name}_ly").isNotNull(), F.col(name)),
            f"{name}_ly_once": F.when(~leap_day, F.col(f"{name}_ly")),
        }
    )


def year_on_year(daily: DataFrame, calendar: DataFrame, by: Sequence[str] = (), period: str | None = "year") -> DataFrame:
    """Amount, last year's amount, the comparable part, and growth like for like."""
    days = against_last_year(daily, calendar, by)
    keys = list(by)
    if period:
        days = days.withColumn(period, period_column(period, F.col("business_date")))
        keys = [*keys, period]
    sums = days.groupBy(*keys).agg(
        F.sum("amount").alias("net_sales"),
        F.sum("amount_ly_once").alias("net_sales_ly"),
        F.sum("amount_comparable").alias("net_sales_comparable"),
    )
    ly = F.col("net_sales_ly")
    growth = ratio(zero_if_null(F.col("net_sales_comparable")) - ly, ly)
    return sums.withColumn("yoy_pct", growth)


def net_sales_yoy(sales: DataFrame, calendar: DataFrame, by: Sequence[str] = (), period: str | None = "year") -> DataFrame:
    return year_on_year(daily_totals(sales, F.sum("net_sales"), by), calendar, by, period)


def sales_by_daypart(sales: DataFrame) -> DataFrame:
    """Net sales per daypart and its share of the total."""
    parts = sales.groupBy("daypart").agg(F.sum("net_sales").alias("net_sales"))
    total = parts.agg(F.sum("net_sales")).scalar()
    return parts.withColumn("share", ratio(F.col("net_sales"), total))


def traffic_days(sales: DataFrame, covers: DataFrame) -> DataFrame:
    """Net sales and covers per day from the two facts, for `traffic_and_check`."""
    parts = [daily_totals(sales, F.sum("net_sales"), name="net_sales"), daily_totals(covers, F.sum("covers"), name="covers")]
    return side_by_side(parts, ["business_date"], ["net_sales", "covers"])


def traffic_and_check(sales_daily: DataFrame, calendar: DataFrame, period: str = "year") -> DataFrame:
    """Like-for-like growth split into guests and average check.

    `sales_daily` has business_date, net_sales and covers. Only days with sales in both years count. 28 and
    29 February meet the same day of the year before, which is counted once.
    """
    days = calendar.select(
        F.col("calendar_date").alias("business_date"), F.add_months("calendar_date", -12).alias("ly_date")
    )
    last = sales_daily.select(
        F.col("business_date").alias("ly_date"), F.col("net_sales").alias("net_sales_ly"), F.col("covers").alias("covers_ly")
    )
    paired = sales_daily.join(days, "business_date").join(last, "ly_date")
    once = paired.groupBy(period_column(period, F.col("business_date")).alias(period), "ly_date").agg(
        F.sum("net_sales").alias("net_sales"),
        F.sum("covers").alias("covers"),
        F.max("net_sales_ly").alias("net_sales_ly"),
        F.max("covers_ly").alias("covers_ly"),
    )
    names = ["net_sales", "net_sales_ly", "covers", "covers_ly"]
    sums = once.groupBy(period).agg(*[F.sum(n).alias(n) for n in names])
    check, check_ly = ratio(F.col("net_sales"), F.col("covers")), ratio(F.col("net_sales_ly"), F.col("covers_ly"))
    return sums.withColumns(
        {
            "sales_growth": ratio(F.col("net_sales"), F.col("net_sales_ly")) - 1,
            "traffic_growth": ratio(F.col("covers"), F.col("covers_ly")) - 1,
            "check_growth": ratio(check, check_ly) - 1,
        }
    )


# --- labour --------------------------------------------------------------------------------


def labour_pct(labour_hourly: DataFrame, by: Sequence[str]) -> DataFrame:
    return (
        labour_hourly.groupBy(*by)
        .agg(F.sum("labour_cost").alias("labour_cost"), F.sum("net_sales").alias("net_sales"))
        .withColumn("labour_pct", ratio(F.col("labour_cost"), F.col("net_sales")))
    )


def labour_status(labour_hourly: DataFrame, by: str, target: float = LABOUR_TARGET) -> DataFrame:
    """Labour share per group, its status against the target, and a sentence about it."""
    rows = labour_pct(labour_hourly, [by])
    share = F.col("labour_pct")
    insight = sentence(
        "{group}: labour {share}% of sales, {points} points against the {target}% target",
        group=F.col(by),
        share=percent_text(share),
        points=percent_text(share - F.lit(target)),
        target=percent_text(F.lit(target)),
    )
    return rows.withColumns({"status": target_status(share, target), "insight": insight})


def labour_heatmap(labour_hourly: DataFrame) -> DataFrame:
    """Labour share per store (rows) and weekday (columns), opening hours only."""
    shown = labour_hourly.filter(F.col("hour_of_day").between(*HEATMAP_HOURS))
    cells = labour_pct(shown.withColumn("dow", weekday_name(F.col("business_date"))), ["location_id", "dow"])
    return cells.groupBy("location_id").pivot("dow", WEEKDAYS).agg(F.first("labour_pct"))


def labour_by_weekday(labour_hourly: DataFrame, location_id: str) -> DataFrame:
    """Labour hours against covers per weekday for one store."""
    d = F.col("business_date")
    return (
        labour_hourly.filter(F.col("location_id") == location_id)
        .groupBy(weekday_number(d).alias("dow_num"), weekday_name(d).alias("day_of_week"))
        .agg(F.sum("labour_hours").alias("labour_hours"), F.sum("covers").alias("covers"))
    )


def weekly_covers_forecast(weekly: DataFrame, history: int = 8, ahead: int = 4) -> DataFrame:
    """Weekly covers followed by a straight-line forecast of the next weeks.

    The dashboard's own forecasting method is not published; the least-squares line through the last
    `history` weeks is this library's choice. `weekly` has week_start and covers, one row per week.
    """
    newest = weekly.agg(F.max("week_start")).scalar()
    x = F.floor(F.date_diff("week_start", newest) / 7).cast("bigint")
    y = F.col("covers").cast("bigint")
    recent = weekly.withColumns({"x": x, "y": y}).filter(F.col("x") > -history)
    sums = recent.agg(
        F.count("*").alias("n"),
        F.sum("x").alias("sx"),
        F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"),
        F.sum(F.col("x") * F.col("y")).alias("sxy"),
        F.max("week_start").alias("newest"),
    )
    n, sx, sy, sxx, sxy = (F.col(c) for c in ("n", "sx", "sy", "sxx", "sxy"))
    slope = ratio(n * sxy - sx * sy, n * sxx - sx * sx)
    line = sums.withColumn("slope", slope).withColumn("start", ratio(sy - F.col("slope") * sx, n))
    future = line.select(
        F.explode(F.sequence(F.lit(1), F.lit(ahead))).alias("step"), "slope", "start", "newest"
    ).select(
        F.expr("date_add(newest, step * 7)").alias("week_start"),
        (F.col("start") + F.col("slope") * F.col("step")).alias("covers"),
        F.lit(1).alias("is_forecast"),
    )
    past = weekly.select("week_start", F.col("covers").cast("double").alias("covers"), F.lit(0).alias("is_forecast"))
    return past.unionByName(future)


def weekly_covers(covers: DataFrame) -> DataFrame:
    return (
        covers.filter(F.col("business_date").isNotNull())
        .groupBy(monday_of(F.col("business_date")).alias("week_start"))
        .agg(F.sum("covers").alias("covers"))
    )


def action_savings(labour_hourly: DataFrame, weeks: float | None = None) -> DataFrame:
    """Yearly saving per store and weekday from staffing to the chain's hours per guest.

    The published idea is excess hours x average wage; the definition of excess is this library's:
    labour hours above covers x the chain's labour hours per cover, all rows counted. `weeks` is the length
    of the period in weeks, to scale to 52; by default it runs from the first day to the last.
    """
    d = F.col("business_date")
    cells = labour_hourly.groupBy("location_id", weekday_name(d).alias("day_of_week")).agg(
        F.sum("labour_hours").alias("hours"), F.sum("labour_cost").alias("cost"), F.sum("covers").alias("covers")
    )
    chain = cells.agg(ratio(F.sum("hours"), F.sum("covers"))).scalar()
    if weeks is None:
        days = labour_hourly.agg(F.date_diff(F.max(d), F.min(d)) + 1).scalar()
        scale = ratio(F.lit(364), days)
    else:
        scale = F.lit(52.0 / weeks)
    excess = F.greatest(F.lit(0.0), F.col("hours").cast("double") - F.col("covers").cast("double") * chain)
    return cells.select(
        "location_id",
        "day_of_week",
        excess.alias("excess_hours"),
        ratio(F.col("cost"), F.col("hours")).alias("avg_wage"),
    ).withColumn("annual_saving", F.col("excess_hours") * F.col("avg_wage") * scale)


# --- food ----------------------------------------------------------------------------------


def bridge_sums(usage: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    columns = [*BRIDGE_PARTS, "actual_cost"]
    return usage.groupBy(*by).agg(*[F.sum(c).alias(c) for c in columns])


def over_use_pct(usage: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Waste and unexplained usage as a share of recipe cost at actual prices."""
    extra = F.col("recorded_waste_cost") + F.col("unexplained_variance")
    recipe = F.col("theoretical_cost_at_standard") + F.col("price_variance")
    return bridge_sums(usage, by).withColumn("over_use_pct", ratio(extra, recipe))


def food_cost_pct(
    usage: DataFrame, sales: DataFrame, by: Sequence[str] = (), target: float = FOOD_COST_TARGET
) -> DataFrame:
    """Actual food cost over net sales per group, with its status against the target. No keys: the chain."""
    cost = usage.groupBy(*by).agg(F.sum("actual_cost").alias("actual_cost"))
    sold = sales.groupBy(*by).agg(F.sum("net_sales").alias("net_sales"))
    both = side_by_side([cost, sold], list(by), ["actual_cost", "net_sales"])
    pct = ratio(F.col("actual_cost"), F.col("net_sales"))
    return both.withColumn("food_cost_pct", pct).withColumn("status", target_status(F.col("food_cost_pct"), target))


def bridge_waterfall(usage: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per step of the gap between recipe and actual cost."""
    sums = bridge_sums(usage, by).withColumnsRenamed({v: k for k, v in WATERFALL_STEPS.items()})
    return sums.unpivot(list(by), list(WATERFALL_STEPS), "step", "value")


def usage_drill(usage: DataFrame) -> DataFrame:
    """Unexplained cost by store, then ingredient, then month, with a subtotal at every level.

    `level` is 0 for the detail rows and 1, 3, 7 for the subtotals above them. The detail is summed
    before the rollup multiplies its rows.
    """
    detail = usage.groupBy(
        "location_id", "ingredient_id", F.date_format("week_start", "yyyy-MM").alias("year_month")
    ).agg(F.sum("unexplained_variance").alias("unexplained"), F.sum("actual_cost").alias("actual_cost"))
    return detail.rollup("location_id", "ingredient_id", "year_month").agg(
        F.grouping_id().alias("level"),
        F.sum("unexplained").alias("unexplained_variance"),
        F.sum("actual_cost").alias("actual_cost"),
    )


def menu_scatter(quadrants: DataFrame) -> DataFrame:
    """Popularity (x) against margin (y)."""
    return quadrants.select(
        "menu_item_name",
        "quadrant",
        F.col("menu_mix_pct").alias("x"),
        F.col("contribution_margin_2025").alias("y"),
        "qty_sold",
    )


# --- targets, status, notes ------------------------------------------------------------------


def target_status(value: Column, target: float) -> Column:
    """Lower is better; a missing value has no status."""
    return F.when(value <= target, "On target").when(value > target, "Above target")


def monthly_targets(sales: DataFrame, growth: str = "1.02") -> DataFrame:
    """Month x store with sales, a budget in whole hundreds, and the fixed targets.

    The published budgets are drawn at random around 102 % of sales; this is their mean.
    """
    budget = F.round(F.col("net_sales") * F.lit(growth).cast("decimal(4,2)"), -2)
    return (
        sales.filter(F.col("business_date").isNotNull())
        .groupBy(F.date_format("business_date", "yyyy-MM").alias("year_month"), "location_id")
        .agg(F.sum("net_sales").alias("net_sales"))
        .withColumns(
            {
                "net_sales_budget": budget,
                "labour_pct_target": F.lit(LABOUR_TARGET),
                "food_cost_pct_target": F.lit(FOOD_COST_TARGET),
                "avg_check_target": F.lit(AVG_CHECK_TARGET),
            }
        )
    )


def targets_status(targets: DataFrame, actual: DataFrame) -> DataFrame:
    """Actual sales against budget per month and store, as status and as a sentence.

    `actual` has year_month, location_id and net_sales; a month without sales counts as zero.
    """
    keys = ["year_month", "location_id"]
    both = targets.select(*keys, "net_sales_budget").join(actual.select(*keys, "net_sales"), keys, "left")
    sold = zero_if_null(F.col("net_sales"))
    share = ratio(sold, F.col("net_sales_budget"))
    return both.select(
        *keys,
        "net_sales_budget",
        sold.alias("net_sales"),
        share.alias("of_budget"),
        F.when(sold >= F.col("net_sales_budget"), "On target").otherwise("Below target").alias("status"),
        sentence(
            "{store} sold ${sold} in {month}, {pct}% of budget",
            store=F.col("location_id"),
            sold=whole_text(sold),
            month=F.col("year_month"),
            pct=percent_text(share),
        ).alias("insight"),
    )


def note_lookup(selection: DataFrame, recommendations: DataFrame) -> DataFrame:
    """The note of each selected store, blank if it has none; the chain's where no store is selected."""
    notes = recommendations.select("location_id", "recommendation_text")
    chain = notes.filter("location_id = 'ALL'").agg(F.max("recommendation_text")).scalar()
    note = F.when(F.col("location_id").isNull(), chain).otherwise(F.col("recommendation_text"))
    return selection.join(notes, "location_id", "left").select(*selection.columns, note.alias("note"))
