"""Registered queries for the dashboard measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import monday_of
from storeops.operators import measures
from storeops.plans import oracle as o
from storeops.plans.catalog import lazy, register, staged, usage
from storeops.plans.extracts import Extracts, money
from storeops.plans.oracle import cte, div, hu, out
from storeops.sources.tables import stage

# --- sales -----------------------------------------------------------------------------------


@register(
    "weekly_store_sales",
    f"""SELECT {o.monday('business_date')} AS week_start, location_id, CAST(sum(net_sales) AS DOUBLE) AS net_sales,
       CAST(sum(qty_sold) AS BIGINT) AS qty_sold FROM fact_sales GROUP BY 1, 2""",
)
def _(x: Extracts) -> DataFrame:
    sales = lazy(x).fact_sales_item_daypart
    return sales.groupBy(monday_of(F.col("business_date")).alias("week_start"), "location_id").agg(
        F.sum("net_sales").alias("net_sales"), F.sum("qty_sold").alias("qty_sold")
    )


cte("daily_sales", "SELECT business_date, location_id, sum(net_sales) AS amount FROM fact_sales WHERE business_date IS NOT NULL GROUP BY 1, 2")
cte(
    "versus_last_year",
    """
SELECT d.calendar_date AS business_date, g.location_id, c.amount, l.amount AS ly,
       CASE WHEN l.amount IS NOT NULL THEN c.amount END AS comparable,
       CASE WHEN strftime(d.calendar_date, '%m-%d') <> '02-29' THEN l.amount END AS ly_once
FROM dim_date d CROSS JOIN (SELECT DISTINCT location_id FROM daily_sales) g
LEFT JOIN daily_sales c ON c.business_date = d.calendar_date AND c.location_id IS NOT DISTINCT FROM g.location_id
LEFT JOIN daily_sales l ON l.business_date = CAST(d.calendar_date - INTERVAL 1 YEAR AS DATE)
      AND l.location_id IS NOT DISTINCT FROM g.location_id
WHERE c.amount IS NOT NULL OR l.amount IS NOT NULL
""",
)
cte("chain_daily", "SELECT business_date, sum(amount) AS amount FROM daily_sales GROUP BY 1")
cte(
    "chain_versus",
    """
SELECT d.calendar_date AS business_date, c.amount, l.amount AS ly, CASE WHEN l.amount IS NOT NULL THEN c.amount END AS comparable,
       CASE WHEN strftime(d.calendar_date, '%m-%d') <> '02-29' THEN l.amount END AS ly_once
FROM dim_date d LEFT JOIN chain_daily c ON c.business_date = d.calendar_date
LEFT JOIN chain_daily l ON l.business_date = CAST(d.calendar_date - INTERVAL 1 YEAR AS DATE)
WHERE c.amount IS NOT NULL OR l.amount IS NOT NULL
""",
)


def yoy_sql(keys: str, source: str) -> str:
    return f"""SELECT {keys}, CAST(sum(amount) AS DOUBLE) AS net_sales, CAST(sum(ly_once) AS DOUBLE) AS net_sales_ly,
       CAST(sum(comparable) AS DOUBLE) AS net_sales_comparable,
       CAST({hu(div('coalesce(sum(comparable), 0) - sum(ly_once)', 'sum(ly_once)'), 6)} AS DOUBLE) AS yoy_pct
FROM {source} GROUP BY ALL"""


@register("net_sales_yoy", yoy_sql("CAST(year(business_date) AS BIGINT) AS year", "chain_versus"))
def _(x: Extracts) -> DataFrame:
    w = lazy(x)
    return measures.net_sales_yoy(w.fact_sales_item_daypart, w.dim_date)


@register("monthly_vs_ly", yoy_sql(f"{o.month('business_date')} AS year_month", "chain_versus"))
def _(x: Extracts) -> DataFrame:
    w = lazy(x)
    return measures.net_sales_yoy(w.fact_sales_item_daypart, w.dim_date, period="year_month")


@register(
    "growth_by_location", yoy_sql("location_id, CAST(year(business_date) AS BIGINT) AS year", "versus_last_year")
)
def _(x: Extracts) -> DataFrame:
    w = lazy(x)
    return measures.net_sales_yoy(w.fact_sales_item_daypart, w.dim_date, by=["location_id"])


@register(
    "sales_by_daypart",
    f"""SELECT daypart, CAST(net_sales AS DOUBLE) AS net_sales,
       CAST({hu(div('net_sales', 'sum(net_sales) OVER ()'), 6)} AS DOUBLE) AS share
FROM (SELECT daypart, sum(net_sales) AS net_sales FROM fact_sales GROUP BY 1) s""",
)
def _(x: Extracts) -> DataFrame:
    return measures.sales_by_daypart(lazy(x).fact_sales_item_daypart)


cte(
    "both_facts",
    """
SELECT location_id, CAST(year(business_date) AS BIGINT) AS year, net_sales, NULL AS covers FROM fact_sales
UNION ALL SELECT location_id, year(business_date), NULL, covers FROM fact_covers
""",
)


def summary_sql(keys: str) -> str:
    return f"""SELECT {keys} CAST(sum(net_sales) AS DOUBLE) AS net_sales, CAST(sum(covers) AS BIGINT) AS covers,
       CAST({hu(div('sum(net_sales)', 'sum(covers)'), 6)} AS DOUBLE) AS avg_check FROM both_facts GROUP BY ALL"""


@register("sales_summary", summary_sql("location_id, year,"))
def _(x: Extracts) -> DataFrame:
    w = lazy(x)
    return measures.sales_summary(w.fact_sales_item_daypart, w.fact_covers_hourly, ["location_id"], "year")


@register("sales_total", summary_sql(""))
def _(x: Extracts) -> DataFrame:
    """The chain's card: one row, unmapped stores and undated rows included."""
    w = lazy(x)
    return measures.sales_summary(w.fact_sales_item_daypart, w.fact_covers_hourly)


cte(
    "order_days",
    """
SELECT CAST(o_orderdate AS DATE) AS business_date, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS net_sales, count(*) AS covers
FROM orders GROUP BY 1
""",
)


def order_days(x: Extracts) -> DataFrame:
    """Orders as guests."""
    return (
        x.table("orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("business_date"))
        .agg(F.sum(money(F.col("o_totalprice"))).alias("net_sales"), F.count("*").alias("covers"))
    )


@register(
    "traffic_check_yoy",
    f"""SELECT year, CAST(s AS DOUBLE) AS net_sales, CAST(sl AS DOUBLE) AS net_sales_ly, CAST(c AS BIGINT) AS covers,
       CAST(cl AS BIGINT) AS covers_ly, CAST({hu(div('s', 'sl') + ' - 1', 6)} AS DOUBLE) AS sales_growth,
       CAST({hu(div('c', 'cl') + ' - 1', 6)} AS DOUBLE) AS traffic_growth,
       CAST({hu(div(div('s', 'c'), div('sl', 'cl')) + ' - 1', 6)} AS DOUBLE) AS check_growth
FROM (SELECT CAST(year(business_date) AS BIGINT) AS year, sum(net_sales) AS s, sum(covers) AS c FROM order_days
      WHERE CAST(business_date - INTERVAL 1 YEAR AS DATE) IN (SELECT business_date FROM order_days) GROUP BY 1) now
JOIN (SELECT CAST(year(business_date) + 1 AS BIGINT) AS year, sum(net_sales) AS sl, sum(covers) AS cl FROM order_days
      WHERE business_date IN (SELECT CAST(business_date - INTERVAL 1 YEAR AS DATE) FROM order_days) GROUP BY 1) before USING (year)""",
)
def _(x: Extracts) -> DataFrame:
    return measures.traffic_and_check(order_days(x), lazy(x).dim_date)


# --- labour ------------------------------------------------------------------------------------


def labour_sql(keys: str, where: str = "") -> str:
    return f"""SELECT {keys}, CAST(sum(labour_cost) AS DOUBLE) AS labour_cost, CAST(sum(net_sales) AS DOUBLE) AS net_sales,
       CAST({hu(div('sum(labour_cost)', 'sum(net_sales)'), 6)} AS DOUBLE) AS labour_pct FROM fact_hourly {where} GROUP BY ALL"""


@register("labour_pct_by_location", labour_sql("location_id"))
def _(x: Extracts) -> DataFrame:
    return measures.labour_pct(lazy(x).fact_labour_hourly, ["location_id"])


@register(
    "labour_status",
    f"""SELECT location_id, CAST(c AS DOUBLE) AS labour_cost, CAST(n AS DOUBLE) AS net_sales, CAST({hu('p', 6)} AS DOUBLE) AS labour_pct,
       CASE WHEN p <= 0.3e0 THEN 'On target' WHEN p > 0.3e0 THEN 'Above target' END AS status,
       location_id || ': labour ' || {o.pct('p')} || '% of sales, ' || {o.pct('p - 0.3e0')} || ' points against the 30.0% target' AS insight
FROM (SELECT location_id, sum(labour_cost) AS c, sum(net_sales) AS n, {div('sum(labour_cost)', 'sum(net_sales)')} AS p
      FROM fact_hourly GROUP BY 1) l""",
)
def _(x: Extracts) -> DataFrame:
    return measures.labour_status(lazy(x).fact_labour_hourly, "location_id")


@register(
    "labour_heatmap",
    "SELECT location_id, "
    + ", ".join(
        f"""CAST({hu(div(f"sum(labour_cost) FILTER (dow = '{d}')", f"sum(net_sales) FILTER (dow = '{d}')"), 6)} AS DOUBLE) AS "{d}" """
        for d in measures.WEEKDAYS
    )
    + f"FROM (SELECT *, {o.dow('business_date')} AS dow FROM fact_hourly WHERE hour_of_day BETWEEN 7 AND 22) h GROUP BY 1",
)
def _(x: Extracts) -> DataFrame:
    return measures.labour_heatmap(lazy(x).fact_labour_hourly)


@register(
    "labour_by_weekday",
    f"""SELECT CAST(isodow(business_date) AS BIGINT) AS dow_num, {o.dow('business_date')} AS day_of_week,
       CAST(sum(labour_hours) AS DOUBLE) AS labour_hours, CAST(sum(covers) AS BIGINT) AS covers
FROM fact_hourly WHERE location_id = 'L6' GROUP BY 1, 2""",
)
def _(x: Extracts) -> DataFrame:
    return measures.labour_by_weekday(lazy(x).fact_labour_hourly, "L6")


@register(
    "weekly_covers",
    f"""SELECT {o.monday('business_date')} AS week_start, CAST(sum(covers) AS BIGINT) AS covers
FROM fact_covers WHERE business_date IS NOT NULL GROUP BY 1""",
)
def _(x: Extracts) -> DataFrame:
    return measures.weekly_covers(lazy(x).fact_covers_hourly)


@register(
    "weekly_covers_forecast",
    f"""WITH w AS (SELECT {o.monday('o_orderdate')} AS week_start, count(*) AS covers FROM orders GROUP BY 1),
r AS (SELECT date_diff('day', (SELECT max(week_start) FROM w), week_start) // 7 AS x, covers AS y FROM w),
s AS (SELECT count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy FROM r WHERE x > -8),
l AS (SELECT {div('n * sxy - sx * sy', 'n * sxx - sx * sx')} AS slope, n, sx, sy FROM s),
m AS (SELECT slope, {div('sy - slope * sx', 'n')} AS start FROM l)
SELECT week_start, CAST(covers AS DOUBLE) AS covers, CAST(0 AS BIGINT) AS is_forecast FROM w
UNION ALL SELECT (SELECT max(week_start) FROM w) + CAST(step * 7 AS INTEGER),
       CAST({hu('start + slope * step', 6)} AS DOUBLE), CAST(1 AS BIGINT)
FROM m, (SELECT unnest(range(1, 5)) AS step) f""",
)
def _(x: Extracts) -> DataFrame:
    """Orders per week stand for covers: the events span only five weeks, the fit needs eight.

    The weeks are read three times, so they are summed once and written.
    """
    return measures.weekly_covers_forecast(stage(measures.weekly_covers(order_days(x)), x.key("weekly_orders")))


@register(
    "action_savings",
    f"""WITH c AS (SELECT location_id, {o.dow('business_date')} AS day_of_week, sum(labour_hours) AS hours, sum(labour_cost) AS cost,
                    sum(covers) AS covers FROM fact_hourly GROUP BY 1, 2),
e AS (SELECT location_id, day_of_week, greatest(0e0, CAST(hours AS DOUBLE) - CAST(covers AS DOUBLE)
             * (SELECT {div('sum(hours)', 'sum(covers)')} FROM c)) AS excess_hours, {div('cost', 'hours')} AS avg_wage FROM c)
SELECT location_id, day_of_week, CAST({hu('excess_hours', 6)} AS DOUBLE) AS excess_hours, CAST({hu('avg_wage', 6)} AS DOUBLE) AS avg_wage,
       CAST({hu('excess_hours * avg_wage * (364e0 / days)', 6)} AS DOUBLE) AS annual_saving
FROM e, (SELECT date_diff('day', min(business_date), max(business_date)) + 1 AS days FROM fact_hourly) span""",
)
def _(x: Extracts) -> DataFrame:
    return measures.action_savings(lazy(x).fact_labour_hourly)


# --- food --------------------------------------------------------------------------------------

BRIDGE = ["theoretical_cost_at_standard", "price_variance", "recorded_waste_cost", "unexplained_variance", "actual_cost"]
BRIDGE_SUMS = ", ".join(f"CAST(sum({c}) AS DOUBLE) AS {c}" for c in BRIDGE)
OVER_USE = hu(
    div(
        "sum(recorded_waste_cost) + sum(unexplained_variance)", "sum(theoretical_cost_at_standard) + sum(price_variance)"
    ),
    6,
)


@register("bridge_sums", f"SELECT location_id, {BRIDGE_SUMS} FROM fact_usage GROUP BY 1")
def _(x: Extracts) -> DataFrame:
    return measures.bridge_sums(usage(x), ["location_id"])


@register(
    "over_use_pct",
    f"SELECT location_id, {BRIDGE_SUMS}, CAST({OVER_USE} AS DOUBLE) AS over_use_pct FROM fact_usage GROUP BY 1",
)
def _(x: Extracts) -> DataFrame:
    return measures.over_use_pct(usage(x), ["location_id"])


def food_cost_sql(keys: str) -> str:
    comma = f"{keys}, " if keys else ""
    return f"""SELECT {comma}CAST(a AS DOUBLE) AS actual_cost, CAST(n AS DOUBLE) AS net_sales, CAST({hu('p', 6)} AS DOUBLE) AS food_cost_pct,
       CASE WHEN p <= 0.285e0 THEN 'On target' WHEN p > 0.285e0 THEN 'Above target' END AS status
FROM (SELECT {comma}sum(cost) AS a, sum(sold) AS n, {div('sum(cost)', 'sum(sold)')} AS p FROM
  (SELECT location_id, actual_cost AS cost, NULL AS sold FROM fact_usage
   UNION ALL SELECT location_id, NULL, net_sales FROM fact_sales) m GROUP BY ALL) f"""


@register("food_cost_pct", food_cost_sql("location_id"))
def _(x: Extracts) -> DataFrame:
    """Usage and net sales both come from the weekly sums of the sales, which are written once."""
    w = x.warehouse(staged(x, "weekly_sold", "weekly_purchases"))
    return measures.food_cost_pct(w.fact_ingredient_usage_weekly, w.weekly_sold, ["location_id"])


@register("food_cost_total", food_cost_sql(""))
def _(x: Extracts) -> DataFrame:
    """The chain's card: one row, all rows included."""
    w = x.warehouse(staged(x, "weekly_sold", "weekly_purchases"))
    return measures.food_cost_pct(w.fact_ingredient_usage_weekly, w.weekly_sold)


@register(
    "bridge_waterfall",
    """SELECT 'Supplier price' AS step, CAST(sum(price_variance) AS DOUBLE) AS value FROM fact_usage
UNION ALL SELECT 'Recorded waste', CAST(sum(recorded_waste_cost) AS DOUBLE) FROM fact_usage
UNION ALL SELECT 'Unexplained', CAST(sum(unexplained_variance) AS DOUBLE) FROM fact_usage""",
)
def _(x: Extracts) -> DataFrame:
    return measures.bridge_waterfall(usage(x))


@register(
    "usage_drill",
    f"""SELECT location_id, ingredient_id, year_month, CAST(grouping_id(location_id, ingredient_id, year_month) AS BIGINT) AS level,
       CAST(sum(unexplained_variance) AS DOUBLE) AS unexplained_variance, CAST(sum(actual_cost) AS DOUBLE) AS actual_cost
FROM (SELECT *, {o.month('week_start')} AS year_month FROM fact_usage) u GROUP BY ROLLUP (location_id, ingredient_id, year_month)""",
)
def _(x: Extracts) -> DataFrame:
    return measures.usage_drill(usage(x))


# --- targets -----------------------------------------------------------------------------------

cte(
    "targets",
    f"""
SELECT {o.month('business_date')} AS year_month, location_id, sum(net_sales) AS net_sales,
       round(sum(net_sales) * 1.02, -2) AS net_sales_budget
FROM fact_sales WHERE business_date IS NOT NULL GROUP BY 1, 2
""",
)


@register(
    "monthly_targets",
    f"""SELECT {out('s:year_month,location_id d:net_sales,net_sales_budget')}, 0.3e0 AS labour_pct_target,
       0.285e0 AS food_cost_pct_target, 24e0 AS avg_check_target FROM targets""",
)
def _(x: Extracts) -> DataFrame:
    return measures.monthly_targets(lazy(x).fact_sales_item_daypart)


@register(
    "targets_status",
    f"""SELECT year_month, location_id, CAST(net_sales_budget AS DOUBLE) AS net_sales_budget, CAST(sold AS DOUBLE) AS net_sales,
       CAST({hu(div('sold', 'net_sales_budget'), 6)} AS DOUBLE) AS of_budget,
       CASE WHEN sold >= net_sales_budget THEN 'On target' ELSE 'Below target' END AS status,
       location_id || ' sold $' || {o.thousands('sold')} || ' in ' || year_month || ', '
       || {o.pct(div('sold', 'net_sales_budget'))} || '% of budget' AS insight
FROM (SELECT t.year_month, t.location_id, t.net_sales_budget, coalesce(o.amount, 0) AS sold
      FROM (SELECT * FROM targets WHERE location_id IS NOT NULL) t
      LEFT JOIN (SELECT 'L' || c_nationkey AS location_id, {o.month('o_orderdate')} AS year_month,
                        sum(CAST(o_totalprice AS DECIMAL(12,2))) AS amount
                 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) o USING (year_month, location_id)) b""",
)
def _(x: Extracts) -> DataFrame:
    """Budgets from the cleaned lines against the order totals of the same month and store."""
    targets = measures.monthly_targets(lazy(x).fact_sales_item_daypart).filter(F.col("location_id").isNotNull())
    actual = (
        x.table("orders")
        .join(x.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(
            F.concat(F.lit("L"), F.col("c_nationkey").cast("string")).alias("location_id"),
            F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
        )
        .agg(F.sum(money(F.col("o_totalprice"))).alias("net_sales"))
    )
    return measures.targets_status(targets, actual)
