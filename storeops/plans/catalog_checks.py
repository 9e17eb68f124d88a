"""Registered queries for the table checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import monday_of, ratio, weekday_number
from storeops.operators import checks, measures
from storeops.plans import oracle as o
from storeops.plans.catalog import landed, register, staged, staged_all
from storeops.plans.extracts import Extracts
from storeops.plans.oracle import cte, div, hu
from storeops.sources.tables import stage
from storeops.plans.validation import Expectations, validation_suite
from storeops.schemas import EXTRACTS

BENCH_EXPECTATIONS = Expectations(
    price_change="1998-01-05",
    wage_floor="17.85",
    story_from="2000-03-06",
    labour_story=("L6", 1),
    usage_story=("L5", "Brand#13"),
    price_months=("1999-02", "2000-02"),
    manager_role="Purchase",
)


def digits(expr: str, n: int) -> str:
    return f"CAST(CAST({hu(expr, n)} AS DECIMAL(30,{n})) AS VARCHAR)"


def row(name: str, passed: str, detail: str, source: str) -> str:
    """One check row from a one-row source."""
    return (
        f"SELECT '{name}' AS check_name, CAST(CASE WHEN {passed} THEN 1 ELSE 0 END AS BIGINT) AS passed, "
        f"coalesce({detail}, '') AS detail FROM ({source}) src"
    )


def rows(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


def counted(name: str, source: str, label: str = "rows") -> str:
    """A check that passes when the source, a count named n, is zero."""
    return row(name, "n = 0", f"'(' || n || ' {label})'", source)


def union(*parts: DataFrame) -> DataFrame:
    frame = parts[0]
    for part in parts[1:]:
        frame = frame.unionByName(part)
    return frame


# --- keys --------------------------------------------------------------------------------------


def repeated(table: str, keys: str) -> str:
    return f"SELECT count(*) AS n FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING count(*) > 1) g"


@register(
    "check_unique",
    rows(
        counted("lines", repeated("lineitem", "l_orderkey, l_linenumber"), "repeated keys"),
        counted("orders", repeated("orders", "o_orderkey"), "repeated keys"),
        counted("events", repeated("events", "event_id"), "repeated keys"),
        counted("counts", repeated("fact_counts", "count_date, location_id, ingredient_id"), "repeated keys"),
        counted("sales", repeated("fact_sales", "business_date, location_id, daypart, menu_item_id"), "repeated keys"),
    ),
)
def _(x: Extracts) -> DataFrame:
    w = x.lazy_warehouse
    return union(
        checks.unique_key("lines", x.table("lineitem"), ["l_orderkey", "l_linenumber"]),
        checks.unique_key("orders", x.table("orders"), ["o_orderkey"]),
        checks.unique_key("events", x.table("events"), ["event_id"]),
        checks.unique_key("counts", w.fact_inventory_counts, ["count_date", "location_id", "ingredient_id"]),
        checks.unique_key(
            "sales", w.fact_sales_item_daypart, ["business_date", "location_id", "daypart", "menu_item_id"]
        ),
    )


def missing(table: str, col: str, ref: str, ref_col: str) -> str:
    return f"SELECT count(*) AS n FROM {table} t WHERE NOT EXISTS (SELECT 1 FROM {ref} r WHERE r.{ref_col} = t.{col})"


@register(
    "check_fk",
    rows(
        counted("order without lines", missing("orders", "o_orderkey", "lineitem", "l_orderkey"), "orphans"),
        counted("line without order", missing("lineitem", "l_orderkey", "orders", "o_orderkey"), "orphans"),
        counted("shift without employee", missing("fact_shifts", "employee_id", "dim_employee", "employee_id"), "orphans"),
        counted("sale without date", missing("fact_sales", "business_date", "dim_date", "calendar_date"), "orphans"),
        counted("purchase after the calendar", missing("fact_purchases", "delivery_date", "dim_date", "calendar_date"), "orphans"),
    ),
)
def _(x: Extracts) -> DataFrame:
    w = x.lazy_warehouse
    return union(
        checks.no_orphans("order without lines", x.table("orders"), "o_orderkey", x.table("lineitem"), "l_orderkey"),
        checks.no_orphans("line without order", x.table("lineitem"), "l_orderkey", x.table("orders"), "o_orderkey"),
        checks.no_orphans(
            "shift without employee", w.fact_labour_shifts, "employee_id", w.dim_employee, "employee_id"
        ),
        checks.no_orphans(
            "sale without date", w.fact_sales_item_daypart, "business_date", w.dim_date, "calendar_date"
        ),
        checks.no_orphans(
            "purchase after the calendar", w.fact_purchases, "delivery_date", w.dim_date, "calendar_date"
        ),
    )


def one_sided(a: str, b: str, col: str) -> str:
    return (
        f"SELECT count(*) AS n FROM (SELECT DISTINCT {col} AS k FROM {a}) l "
        f"FULL JOIN (SELECT DISTINCT {col} AS k FROM {b}) r ON l.k = r.k WHERE l.k IS NULL OR r.k IS NULL"
    )


@register(
    "check_set_equal",
    rows(
        counted("items and recipes", one_sided("dim_menu_item", "bridge_recipe", "menu_item_id"), "on one side only"),
        counted("users and employees", one_sided("fact_shifts", "dim_employee", "employee_id"), "on one side only"),
    ),
)
def _(x: Extracts) -> DataFrame:
    w = x.lazy_warehouse
    return union(
        checks.same_keys("items and recipes", w.dim_menu_item, w.bridge_recipe, "menu_item_id"),
        checks.same_keys("users and employees", w.fact_labour_shifts, w.dim_employee, "employee_id"),
    )


# --- rows and totals ---------------------------------------------------------------------------


def near(a: str, b: str, atol: str, rtol: str = "1e-5") -> str:
    return f"coalesce(abs(CAST({a} AS DOUBLE) - CAST({b} AS DOUBLE)) <= {atol} + {rtol} * abs(CAST({b} AS DOUBLE)), false)"


@register(
    "check_rows",
    rows(
        counted("no negative sales", "SELECT count(*) AS n FROM fact_sales WHERE NOT coalesce(qty_sold >= 0, false) OR net_sales < 0"),
        counted(
            "net is rebuilt",
            f"SELECT count(*) AS n FROM fact_sales WHERE NOT {near('gross_sales - discounts - comps', 'net_sales', '0.011e0')}",
        ),
        counted(
            "gross is quantity x price",
            f"SELECT count(*) AS n FROM fact_sales WHERE NOT {near('qty_sold * unit_price', 'gross_sales', '0.011e0')}",
        ),
        counted("closed on 25 December", "SELECT count(*) AS n FROM fact_sales WHERE strftime(business_date, '%m-%d') = '12-25'"),
        counted("shifts in order", "SELECT count(*) AS n FROM fact_shifts WHERE NOT coalesce(actual_end > actual_start, false)"),
        counted("shifts of 3 to 10 hours", "SELECT count(*) AS n FROM fact_shifts WHERE NOT coalesce(actual_hours BETWEEN 3 AND 10, false)"),
        counted(
            "cost is hours x wage",
            f"SELECT count(*) AS n FROM fact_shifts WHERE NOT {near('actual_hours * CAST(hourly_wage AS DECIMAL(10,2))', 'labour_cost', '0.011e0')}",
        ),
        counted("covers with sales", "SELECT count(*) AS n FROM fact_covers WHERE net_sales > 0 AND (covers IS NULL OR covers <= 0)"),
    ),
)
def _(x: Extracts) -> DataFrame:
    w = x.lazy_warehouse
    false = F.lit(False)
    rebuilt = F.col("gross_sales") - F.col("discounts") - F.col("comps")
    return union(
        checks.row_rules(
            w.fact_sales_item_daypart,
            {
                "no negative sales": ~F.coalesce(F.col("qty_sold") >= 0, false) | (F.col("net_sales") < 0),
                "net is rebuilt": ~checks.close(rebuilt, F.col("net_sales"), 0.011),
                "gross is quantity x price": ~checks.close(
                    F.col("qty_sold") * F.col("unit_price"), F.col("gross_sales"), 0.011
                ),
                "closed on 25 December": F.date_format("business_date", "MM-dd") == "12-25",
            },
        ),
        checks.row_rules(
            w.fact_labour_shifts,
            {
                "shifts in order": ~F.coalesce(F.col("actual_end") > F.col("actual_start"), false),
                "shifts of 3 to 10 hours": ~F.coalesce(F.col("actual_hours").between(3, 10), false),
                "cost is hours x wage": ~checks.close(
                    F.col("actual_hours") * F.col("hourly_wage"), F.col("labour_cost"), 0.011
                ),
            },
        ),
        checks.row_rules(w.fact_covers_hourly, {"covers with sales": (F.col("net_sales") > 0) & ~F.coalesce(F.col("covers") > 0, false)}),
    )


@register(
    "check_agree",
    rows(
        counted(
            "shift role",
            "SELECT count(*) AS n FROM fact_shifts s JOIN dim_employee e USING (employee_id) WHERE NOT coalesce(s.role = e.role, false)",
            "violations",
        ),
        counted(
            "shift store",
            "SELECT count(*) AS n FROM fact_shifts s JOIN dim_employee e USING (employee_id) "
            "WHERE NOT coalesce(s.location_id = e.home_location_id, false)",
            "violations",
        ),
        counted(
            "hired before",
            "SELECT count(*) AS n FROM fact_shifts s JOIN dim_employee e USING (employee_id) "
            "WHERE NOT coalesce(e.hire_date <= s.business_date, false)",
            "violations",
        ),
        counted(
            "list price",
            "SELECT count(*) AS n FROM fact_sales s JOIN dim_menu_item m USING (menu_item_id) WHERE NOT "
            + near("unit_price", "CASE WHEN business_date >= DATE '1998-01-05' THEN price_2026 ELSE price_2025 END", "1e-8"),
        ),
    ),
)
def _(x: Extracts) -> DataFrame:
    w = x.warehouse(staged(x, "fact_labour_shifts"))
    shifts, employee = w.fact_labour_shifts, w.dim_employee
    return union(
        checks.joined_agree("shift role", shifts, "role", employee, "role", "employee_id"),
        checks.joined_agree("shift store", shifts, "location_id", employee, "home_location_id", "employee_id"),
        checks.hired_before("hired before", shifts, employee),
        checks.price_by_date("list price", w.fact_sales_item_daypart, w.dim_menu_item, "1998-01-05"),
    )


@register(
    "check_tolerance",
    rows(
        row(
            "raw and clean sales by day",
            "gap < 0.2",
            f"'max diff ' || {digits('gap', 2)}",
            "SELECT coalesce(max(abs(coalesce(a, 0) - coalesce(b, 0))), 0) AS gap FROM "
            "(SELECT daypart, business_date, sum(net_sales) AS a FROM fact_sales WHERE business_date IS NOT NULL GROUP BY 1, 2) l FULL JOIN "
            "(SELECT daypart, business_date, sum(net_raw) AS b FROM sales_typed WHERE business_date IS NOT NULL GROUP BY 1, 2) r "
            "USING (daypart, business_date)",
        ),
        row(
            "labour by hour and by shift",
            f"{div('abs(a - b)', 'b')} < 1e-4",
            f"{digits('a', 0)} || ' vs ' || {digits('b', 0)}",
            "SELECT (SELECT sum(labour_cost) FROM fact_hourly) AS a, (SELECT sum(labour_cost) FROM fact_shifts) AS b",
        ),
        row(
            "covers in both tables",
            "a = b",
            f"{digits('a', 0)} || ' vs ' || {digits('b', 0)}",
            "SELECT (SELECT sum(covers) FROM fact_hourly) AS a, (SELECT sum(covers) FROM fact_covers) AS b",
        ),
    ),
)
def _(x: Extracts) -> DataFrame:
    from storeops.operators.clean import type_columns
    from storeops.schemas import kinds

    w = x.warehouse(staged(x, "fact_covers_hourly", "fact_labour_shifts"))
    typed = type_columns(x.pos_sales, kinds("pos_sales"))
    return union(
        checks.reconciled(
            "raw and clean sales by day", w.fact_sales_item_daypart, typed, ["daypart", "business_date"], "net_sales", "0.2"
        ),
        checks.totals_close(
            "labour by hour and by shift",
            w.fact_labour_hourly,
            F.sum("labour_cost"),
            w.fact_labour_shifts,
            F.sum("labour_cost"),
            1e-4,
        ),
        checks.totals_close(
            "covers in both tables", w.fact_labour_hourly, F.sum("covers"), w.fact_covers_hourly, F.sum("covers"), 0
        ),
    )


# --- groups ------------------------------------------------------------------------------------


@register(
    "check_cap",
    rows(
        row(
            "weekly hours",
            "top <= 48",
            f"'(mean ' || {digits('mean', 1)} || ', p95 ' || {digits('p95', 1)} || ', max ' || {digits('top', 1)} || ')'",
            f"SELECT {div('sum(h)', 'count(h)')} AS mean, quantile_cont(CAST(h AS DOUBLE), 0.95) AS p95, max(h) AS top FROM "
            f"(SELECT employee_id, {o.monday('business_date')} AS w, sum(actual_hours) AS h FROM fact_shifts GROUP BY 1, 2) x",
        ),
        counted(
            "one shift a day",
            "SELECT count(*) AS n FROM (SELECT 1 FROM fact_shifts GROUP BY employee_id, business_date HAVING count(*) > 1) g",
            "groups",
        ),
        row(
            "two purchasers a day",
            "n >= 2",
            "'(min ' || n || ')'",
            "SELECT min(c) AS n FROM (SELECT count(*) AS c FROM fact_shifts WHERE role = 'Purchase' GROUP BY business_date, location_id) g",
        ),
        row("wage floor", "low >= 17.85", "'(min ' || CAST(low AS VARCHAR) || ')'", "SELECT min(hourly_wage_2025) AS low FROM dim_employee"),
    ),
)
def _(x: Extracts) -> DataFrame:
    w = x.warehouse(staged(x, "fact_labour_shifts"))
    shifts = w.fact_labour_shifts
    return union(
        checks.weekly_cap("weekly hours", shifts, 48.0),
        checks.largest_group("one shift a day", shifts, ["employee_id", "business_date"], 1),
        checks.smallest_group("two purchasers a day", shifts.filter("role = 'Purchase'"), ["business_date", "location_id"], 2),
        checks.at_least("wage floor", w.dim_employee, "hourly_wage_2025", "17.85"),
    )


@register(
    "check_identity",
    rows(
        row(
            "stock identity",
            "gap < 0.02",
            f"'(max err ' || {digits('gap', 4)} || ', missing ' || missing || ')'",
            "SELECT max(abs(d)) AS gap, count(*) - count(d) AS missing FROM ("
            "SELECT CAST(o.qty_on_hand AS DECIMAL(18,6)) + coalesce(p.purchased_qty, 0) - CAST(c.qty_on_hand AS DECIMAL(18,6)) - u.actual_qty AS d "
            "FROM fact_usage u LEFT JOIN purch p USING (week_start, location_id, ingredient_id) "
            "LEFT JOIN fact_counts o ON o.location_id = u.location_id AND o.ingredient_id = u.ingredient_id AND o.count_date = u.week_start - 1 "
            "LEFT JOIN fact_counts c ON c.location_id = u.location_id AND c.ingredient_id = u.ingredient_id AND c.count_date = u.week_start + 6) i",
        ),
        counted(
            "theoretical again",
            "SELECT count(*) AS n FROM fact_usage u LEFT JOIN theo t USING (week_start, location_id, ingredient_id) WHERE NOT "
            + near("t.theoretical_qty", "u.theoretical_qty", "0.01e0"),
        ),
    ),
)
def _(x: Extracts) -> DataFrame:
    """Sales and purchases are summed by week once and serve both the usage and, as those of each Monday, its checks.

    The check deals the weekly sales by item, which serves its sums and its join with the recipe alike. Summed
    by week and store, a best-seller has few rows.
    """
    w = x.warehouse(staged(x, "fact_ingredient_usage_weekly", "weekly_sold", "weekly_purchases"))
    usage = w.fact_ingredient_usage_weekly
    renamed = {"week_start": "delivery_date", "purchased_qty": "qty_received", "purchased_cost": "line_total"}
    bought = w.weekly_purchases.withColumnsRenamed(renamed)
    sales = w.weekly_sold.withColumnRenamed("week_start", "business_date").repartition("menu_item_id")
    return union(
        checks.stock_identity("stock identity", usage, w.fact_inventory_counts, bought),
        checks.theoretical_again("theoretical again", usage, sales, w.bridge_recipe),
    )


cte(
    "price_week",
    f"""
SELECT {o.monday('delivery_date')} AS week_start, ingredient_id,
       CAST({hu(div('sum(line_total)', 'sum(qty_received)'), 4)} AS DECIMAL(18,4)) AS market_unit_cost
FROM fact_purchases WHERE delivery_date IS NOT NULL GROUP BY 1, 2
""",
)


def weekly_prices(w) -> DataFrame:
    """Average price paid per week and ingredient."""
    weeks = w.fact_purchases.filter(F.col("delivery_date").isNotNull()).groupBy(
        monday_of(F.col("delivery_date")).alias("week_start"), "ingredient_id"
    )
    price = ratio(F.sum("line_total"), F.sum("qty_received"))
    return weeks.agg(F.round(price.cast("decimal(28,8)"), 4).cast("decimal(18,4)").alias("market_unit_cost"))


@register(
    "check_grid",
    row(
        "price grid",
        "r = w * m",
        "'(' || r || ' rows, ' || w || ' x ' || m || ')'",
        "SELECT count(*) AS r, count(DISTINCT week_start) AS w, (SELECT count(*) FROM dim_ingredient) AS m FROM price_week",
    ),
)
def _(x: Extracts) -> DataFrame:
    w = x.lazy_warehouse
    return checks.complete_grid("price grid", weekly_prices(w), "week_start", w.dim_ingredient)


# --- stories -----------------------------------------------------------------------------------


def outlier(table: str, value: str, target: str) -> str:
    return (
        f"SELECT max(v) FILTER (WHERE {target}) AS t, max(v) FILTER (WHERE NOT ({target})) AS x "
        f"FROM (SELECT *, {value} AS v FROM {table}) g"
    )


STANDS = f"'(' || {digits('t', 3)} || ', next highest ' || {digits('x', 3)} || ')'"


@register(
    "check_outlier",
    rows(
        row(
            "labour on L6 Mondays",
            "t > x + 0.05e0",
            STANDS,
            outlier(
                "(SELECT location_id, isodow(business_date) AS d, sum(labour_cost) AS c, sum(net_sales) AS s FROM fact_hourly "
                "WHERE location_id IS NOT NULL GROUP BY 1, 2)",
                div("c", "s"),
                "location_id = 'L6' AND d = 1",
            ),
        ),
        row(
            "use of Brand#13 in L5",
            "t > x + 0.15e0",
            STANDS,
            outlier(
                "(SELECT location_id, sum(actual_qty) AS a, sum(theoretical_qty) AS q FROM fact_usage "
                "WHERE ingredient_id = 'Brand#13' AND week_start >= DATE '2000-03-06' AND location_id IS NOT NULL GROUP BY 1)",
                div("a", "q") + " - 1",
                "location_id = 'L5'",
            ),
        ),
    ),
)
def _(x: Extracts) -> DataFrame:
    w = x.lazy_warehouse
    labour = (
        w.fact_labour_hourly.filter(F.col("location_id").isNotNull())
        .groupBy("location_id", weekday_number(F.col("business_date")).alias("d"))
        .agg(ratio(F.sum("labour_cost"), F.sum("net_sales")).alias("v"))
    )
    over = (
        w.fact_ingredient_usage_weekly.filter(
            (F.col("ingredient_id") == "Brand#13")
            & (F.col("week_start") >= F.lit("2000-03-06").cast("date"))
            & F.col("location_id").isNotNull()
        )
        .groupBy("location_id")
        .agg((ratio(F.sum("actual_qty"), F.sum("theoretical_qty")) - 1).alias("v"))
    )
    return union(
        checks.stands_out(
            "labour on L6 Mondays", labour, "v", (F.col("location_id") == "L6") & (F.col("d") == 1), 0.05
        ),
        checks.stands_out("use of Brand#13 in L5", over, "v", F.col("location_id") == "L5", 0.15),
    )


@register(
    "check_ratio",
    rows(
        row(
            "use of Brand#13",
            "abs(r - 1.055e0) < 0.03e0",
            f"'(' || {digits('r', 3)} || ')'",
            f"SELECT {div('sum(actual_qty)', 'sum(theoretical_qty)')} AS r FROM fact_usage WHERE ingredient_id = 'Brand#13'",
        ),
        row(
            "price of Brand#13 in February",
            f"{div('a', 'b')} > 1.4e0",
            f"'(' || {digits('b', 2)} || ' -> ' || {digits('a', 2)} || ')'",
            "SELECT "
            + ", ".join(
                f"{hu(div(f'sum(market_unit_cost) FILTER (m = {chr(39)}{m}{chr(39)})', f'count(*) FILTER (m = {chr(39)}{m}{chr(39)})'), 8)} AS {n}"
                for n, m in (("b", "1999-02"), ("a", "2000-02"))
            )
            + f" FROM (SELECT *, {o.month('week_start')} AS m FROM price_week WHERE ingredient_id = 'Brand#13') p",
        ),
        row(
            "labour share",
            f"{div('a', 'b')} > 0.27e0 AND {div('a', 'b')} < 0.34e0",
            f"'(' || {digits(div('a', 'b'), 3)} || ')'",
            "SELECT (SELECT sum(labour_cost) FROM fact_shifts) AS a, (SELECT sum(net_sales) FROM fact_sales) AS b",
        ),
        row(
            "items with Brand#13",
            "true",
            "'(N=' || n || ')'",
            "SELECT count(DISTINCT menu_item_id) AS n FROM bridge_recipe WHERE ingredient_id = 'Brand#13'",
        ),
    ),
)
def _(x: Extracts) -> DataFrame:
    w = x.lazy_warehouse
    brand = F.col("ingredient_id") == "Brand#13"
    return union(
        checks.ratio_near(
            "use of Brand#13",
            w.fact_ingredient_usage_weekly.filter(brand),
            "actual_qty",
            "theoretical_qty",
            1.055,
            0.03,
        ),
        checks.mean_rose(
            "price of Brand#13 in February",
            weekly_prices(w).filter(brand),
            "market_unit_cost",
            F.date_format("week_start", "yyyy-MM"),
            "1999-02",
            "2000-02",
            1.4,
        ),
        checks.ratio_in_band(
            "labour share",
            w.fact_labour_shifts,
            F.sum("labour_cost"),
            w.fact_sales_item_daypart,
            F.sum("net_sales"),
            0.27,
            0.34,
        ),
        checks.distinct_report("items with Brand#13", w.bridge_recipe.filter(brand), "menu_item_id"),
    )


cte("order_covers", "SELECT CAST(o_orderdate AS DATE) AS business_date, count(*) AS covers FROM orders GROUP BY 1")


def versus(a: str, b: str) -> str:
    return f"'(' || {digits(a, 1)} || ' vs ' || {digits(b, 1)} || ')'"


@register(
    "check_season",
    rows(
        row(
            "July over January",
            "a > b * 1.15e0",
            versus("a", "b"),
            "SELECT "
            + ", ".join(
                div(f"sum(covers) FILTER (month(business_date) = {m})", f"count(*) FILTER (month(business_date) = {m})") + f" AS {n}"
                for n, m in (("a", 7), ("b", 1))
            )
            + " FROM order_covers",
        ),
        row(
            "Saturday and Monday",
            "t = 6 AND l = 1",
            "'(busiest ' || t || ', slowest ' || l || ')'",
            "SELECT (SELECT d FROM (SELECT isodow(business_date) AS d, sum(covers) AS c FROM order_covers GROUP BY 1) "
            "ORDER BY c DESC, d LIMIT 1) AS t, "
            "(SELECT d FROM (SELECT isodow(business_date) AS d, sum(covers) AS c FROM order_covers GROUP BY 1) ORDER BY c, d LIMIT 1) AS l",
        ),
        row(
            "rainy days",
            "a < b",
            versus("a", "b"),
            "SELECT "
            + ", ".join(
                div(f"sum(covers) FILTER (rain = {v})", f"count(*) FILTER (rain = {v})") + f" AS {n}"
                for n, v in (("a", 1), ("b", 0))
            )
            + " FROM (SELECT *, CASE WHEN date_diff('day', DATE '1970-01-01', business_date) % 3 = 0 THEN 1 ELSE 0 END AS rain FROM order_covers) w",
        ),
    ),
)
def _(x: Extracts) -> DataFrame:
    covers = x.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("business_date")).agg(
        F.count("*").alias("covers")
    )
    return union(
        checks.busier_month("July over January", covers, 7, 1, 1.15),
        checks.busiest_weekday("Saturday and Monday", covers, 6, 1),
        checks.rainy_days_slower("rainy days", covers, weather(x)),
    )


def weather(x: Extracts) -> DataFrame:
    """Every third day is rainy."""
    days = x.lazy_warehouse.dim_date.select(F.col("calendar_date").alias("date"))
    return days.withColumn("is_rainy_day", F.when(F.unix_date("date") % 3 == 0, 1).otherwise(0))


SALES_COLUMNS = ", ".join(EXTRACTS["pos_sales"])


@register(
    "check_defects",
    rows(
        row("copies", "n > 0", "'(' || n || ')'", f"SELECT (SELECT count(*) FROM raw_sales) - (SELECT count(*) FROM (SELECT DISTINCT {SALES_COLUMNS} FROM raw_sales)) AS n"),
        row(
            "text dates",
            "r > 0.03e0",
            f"'(' || {digits('r', 3)} || ')'",
            f"SELECT {div('count(*) FILTER (regexp_matches(business_date, ' + chr(39) + '[A-Za-z]' + chr(39) + '))', 'count(*)')} AS r FROM raw_sales",
        ),
        row("missing net", "n > 0", "'(' || n || ')'", "SELECT count(*) AS n FROM raw_sales WHERE net_sales IS NULL"),
        row("store spellings", "n > 10", "'(' || n || ' distinct)'", "SELECT count(DISTINCT store) AS n FROM raw_sales"),
        row("pounds", "n > 0", "'(' || n || ')'", "SELECT count(*) AS n FROM raw_purchases WHERE unit = 'lb'"),
        row("missing ends", "n > 0", "'(' || n || ')'", "SELECT count(*) AS n FROM raw_shifts WHERE actual_end IS NULL"),
        row(
            "copies removed",
            "a = b",
            "'(' || a || ' vs ' || b || ')'",
            f"SELECT (SELECT count(*) FROM (SELECT DISTINCT {SALES_COLUMNS} FROM raw_sales)) AS a, (SELECT count(*) FROM fact_sales) AS b",
        ),
    ),
)
def _(x: Extracts) -> DataFrame:
    profile = stage(checks.profile_of_sales(x.pos_sales, list(EXTRACTS["pos_sales"])), x.key("sales_profile"))
    kept = checks.side_by_side(profile, F.max("kinds"), x.lazy_warehouse.fact_sales_item_daypart, F.count("*"))
    return union(
        checks.found_in(profile, "copies", "copies"),
        checks.share_of_rows(profile, "text dates", "text_dates", 0.03),
        checks.found_in(profile, "missing net", "missing_net"),
        checks.found_in(profile, "store spellings", "spellings", 10, " distinct"),
        checks.defects_present(x.purchasing, {"pounds": F.col("unit") == "lb"}),
        checks.defects_present(x.timeclock, {"missing ends": F.col("actual_end").isNull()}),
        checks.same_count(kept, "copies removed"),
    )


def disagree(mine: str, master: str, on: str, agree: str) -> str:
    """Rows whose key is in the master and whose values do not agree."""
    return f"SELECT count(*) AS n FROM {mine} mine JOIN {master} master USING ({on}) WHERE ({agree}) IS DISTINCT FROM true"


def breaking(table: str, rule: str) -> str:
    return f"SELECT count(*) AS n FROM {table} WHERE ({rule}) IS DISTINCT FROM true"


def share(a: str, b: str, low: float, high: float, name: str) -> str:
    r = div("a", "b")
    return row(name, f"{r} > {low}e0 AND {r} < {high}e0", f"'(' || {digits(r, 3)} || ')'", f"SELECT ({a}) AS a, ({b}) AS b")


SUITE_KEYS = {
    "dim_location": ("dim_location", "location_id"),
    "dim_date": ("dim_date", "calendar_date"),
    "dim_menu_item": ("dim_menu_item", "menu_item_id"),
    "dim_ingredient": ("dim_ingredient", "ingredient_id"),
    "dim_employee": ("dim_employee", "employee_id"),
    "bridge_recipe": ("bridge_recipe", "menu_item_id, ingredient_id"),
    "sales": ("fact_sales", "business_date, location_id, daypart, menu_item_id"),
    "covers": ("fact_covers", "business_date, location_id, hour_of_day"),
    "shifts": ("fact_shifts", "shift_id"),
    "labour hours": ("fact_hourly", "business_date, location_id, hour_of_day"),
    "weekly prices": ("price_week", "week_start, ingredient_id"),
    "usage": ("fact_usage", "week_start, location_id, ingredient_id"),
    "counts": ("fact_counts", "count_date, location_id, ingredient_id"),
    "targets": (
        f"(SELECT DISTINCT {o.month('business_date')} AS year_month, location_id FROM fact_sales WHERE business_date IS NOT NULL)",
        "year_month, location_id",
    ),
    "purchases": ("fact_purchases", "po_line_id"),
}
SUITE_REFERENCES = {
    "sales store": ("fact_sales", "location_id", "dim_location", "location_id"),
    "sales item": ("fact_sales", "menu_item_id", "dim_menu_item", "menu_item_id"),
    "recipe item": ("bridge_recipe", "menu_item_id", "dim_menu_item", "menu_item_id"),
    "recipe ingredient": ("bridge_recipe", "ingredient_id", "dim_ingredient", "ingredient_id"),
    "shift employee": ("fact_shifts", "employee_id", "dim_employee", "employee_id"),
    "purchase ingredient": ("fact_purchases", "ingredient_id", "dim_ingredient", "ingredient_id"),
    "sales date": ("fact_sales", "business_date", "dim_date", "calendar_date"),
    "covers date": ("fact_covers", "business_date", "dim_date", "calendar_date"),
    "shift date": ("fact_shifts", "business_date", "dim_date", "calendar_date"),
    "labour hour date": ("fact_hourly", "business_date", "dim_date", "calendar_date"),
    "purchase date": ("fact_purchases", "delivery_date", "dim_date", "calendar_date"),
    "count date": ("fact_counts", "count_date", "dim_date", "calendar_date"),
    "waste date": ("fact_waste", "waste_date", "dim_date", "calendar_date"),
    "price week": ("price_week", "week_start", "dim_date", "calendar_date"),
    "usage week": ("fact_usage", "week_start", "dim_date", "calendar_date"),
    "weather date": ("dim_date", "calendar_date", "dim_date", "calendar_date"),
}
cte("cover_days", "SELECT business_date, sum(covers) AS covers, count(covers) AS n FROM fact_covers GROUP BY 1")
cte("raw_kinds", f"SELECT count(*) AS kinds, sum(n) AS held FROM (SELECT count(*) AS n FROM raw_sales GROUP BY {SALES_COLUMNS}) k")
SUITE_SALES = rows(
    counted("every menu item has a recipe", one_sided("dim_menu_item", "bridge_recipe", "menu_item_id"), "on one side only"),
    counted(
        "recipe unit is the ingredient''s",
        disagree("bridge_recipe", "dim_ingredient", "ingredient_id", "mine.unit = master.unit"),
        "violations",
    ),
    counted(
        "no negative sales",
        breaking("fact_sales", " AND ".join(f"coalesce({m} >= 0, false)" for m in ("qty_sold", "gross_sales", "discounts", "comps", "net_sales"))),
    ),
    counted("net is gross less discounts and comps", breaking("fact_sales", near("gross_sales - discounts - comps", "net_sales", "0.011e0"))),
    counted("gross is quantity x price", breaking("fact_sales", near("qty_sold * unit_price", "gross_sales", "0.011e0"))),
    counted(
        "no sales on the closed day",
        "SELECT count(*) AS n FROM fact_sales WHERE month(business_date) = 12 AND day(business_date) = 25",
    ),
    counted(
        "unit price is the list price of the date",
        disagree(
            "fact_sales",
            "dim_menu_item",
            "menu_item_id",
            near("unit_price", "CASE WHEN business_date >= DATE '1998-01-05' THEN price_2026 ELSE price_2025 END", "1e-8"),
        ),
    ),
    row(
        "hourly sales add up to item sales",
        "gap < 0.2",
        f"'max diff ' || {digits('gap', 2)}",
        "SELECT coalesce(max(abs(d)), 0) AS gap FROM (SELECT coalesce(sum(net_sales) FILTER (side = 1), 0) "
        "- coalesce(sum(net_sales) FILTER (side = 2), 0) AS d FROM ("
        "SELECT 1 AS side, business_date, location_id, daypart, net_sales FROM fact_sales UNION ALL "
        "SELECT 2, business_date, location_id, daypart, net_sales FROM fact_covers) s "
        "WHERE business_date IS NOT NULL AND location_id IS NOT NULL AND daypart IS NOT NULL "
        "GROUP BY business_date, location_id, daypart) g",
    ),
    counted("covers wherever there are sales", "SELECT count(*) AS n FROM fact_covers WHERE net_sales > 0 AND (covers IS NULL OR covers <= 0)"),
)
SUITE_LABOUR = rows(
    counted(
        "shifts end after they start",
        breaking("fact_shifts", "actual_end > actual_start AND scheduled_end > scheduled_start"),
    ),
    counted("shifts last 3 to 10 hours", breaking("fact_shifts", "actual_hours >= 3 AND actual_hours <= 10")),
    counted(
        "labour cost is hours x wage",
        breaking("fact_shifts", near("actual_hours * CAST(hourly_wage AS DECIMAL(10,2))", "labour_cost", "0.011e0")),
    ),
    row(
        "hourly labour adds up to shifts",
        f"{div('abs(a - b)', 'b')} < 1e-4",
        f"{digits('a', 0)} || ' vs ' || {digits('b', 0)}",
        "SELECT (SELECT sum(labour_cost) FROM fact_hourly) AS a, (SELECT sum(labour_cost) FROM fact_shifts) AS b",
    ),
    row(
        "hourly covers are the covers",
        "a = b",
        f"{digits('a', 0)} || ' vs ' || {digits('b', 0)}",
        "SELECT (SELECT sum(covers) FROM fact_hourly) AS a, (SELECT sum(covers) FROM fact_covers) AS b",
    ),
    counted("shift role is the employee''s", disagree("fact_shifts", "dim_employee", "employee_id", "mine.role = master.role"), "violations"),
    counted(
        "shift store is the employee''s",
        disagree("fact_shifts", "dim_employee", "employee_id", "mine.location_id = master.home_location_id"),
        "violations",
    ),
    counted(
        "employees are hired before they work",
        disagree("fact_shifts", "dim_employee", "employee_id", "master.hire_date <= mine.business_date"),
        "violations",
    ),
    counted("one shift per employee and day", repeated("fact_shifts", "employee_id, business_date"), "groups"),
    row(
        "weekly hours under the cap",
        "top <= 48",
        f"'(mean ' || {digits('mean', 1)} || ', p95 ' || {digits('p95', 1)} || ', max ' || {digits('top', 1)} || ')'",
        f"SELECT {div('sum(h)', 'count(h)')} AS mean, quantile_cont(CAST(h AS DOUBLE), 0.95) AS p95, max(h) AS top FROM "
        f"(SELECT sum(actual_hours) AS h FROM fact_shifts GROUP BY employee_id, {o.monday('business_date')}) x",
    ),
    row("wages above the legal minimum", "low >= 17.85", "'(min ' || CAST(low AS VARCHAR) || ')'", "SELECT min(hourly_wage_2025) AS low FROM dim_employee"),
    row(
        "two managers per store and day",
        "n >= 2",
        "'(min ' || n || ')'",
        "SELECT min(c) AS n FROM (SELECT count(*) AS c FROM fact_shifts WHERE role = 'Purchase' GROUP BY business_date, location_id) g",
    ),
)
SUITE_INVENTORY = rows(
    row(
        "actual usage is opening + purchases - closing",
        "gap < 0.02",
        f"'(max err ' || {digits('gap', 4)} || ', missing ' || missing || ')'",
        "SELECT max(abs(d)) AS gap, count(*) - count(d) AS missing FROM (SELECT u.actual_qty - (s.opened_qty + coalesce(s.bought_qty, 0) "
        "- s.closed_qty) AS d FROM fact_usage u LEFT JOIN stock_week s USING (week_start, location_id, ingredient_id)) i",
    ),
    counted("no negative counts", breaking("fact_counts", "qty_on_hand >= 0")),
    counted("no negative purchases", breaking("fact_purchases", "qty_received > 0")),
    counted(
        "theoretical usage is sales x recipe",
        "SELECT count(*) AS n FROM fact_usage u LEFT JOIN theo t USING (week_start, location_id, ingredient_id) WHERE NOT "
        + near("t.theoretical_qty", "u.theoretical_qty", "0.01e0"),
    ),
    row(
        "a price for every week and ingredient",
        "r = w * m",
        "'(' || r || ' rows, ' || w || ' x ' || m || ')'",
        "SELECT count(*) AS r, count(DISTINCT week_start) AS w, (SELECT count(*) FROM dim_ingredient) AS m FROM price_week",
    ),
)
SUITE_STORIES = rows(
    row(
        "one store-weekday has the highest labour share",
        "t > x + 0.05e0",
        STANDS,
        outlier(
            "(SELECT location_id, isodow(business_date) AS d, sum(labour_cost) AS c, sum(net_sales) AS s FROM fact_hourly "
            "WHERE location_id IS NOT NULL GROUP BY 1, 2)",
            div("c", "s"),
            "location_id = 'L6' AND d = 1",
        ),
    ),
    row(
        "one store over-uses the ingredient",
        "t > x + 0.15e0",
        STANDS,
        outlier(
            "(SELECT location_id, sum(actual_qty) AS a, sum(theoretical_qty) AS q FROM fact_usage "
            "WHERE ingredient_id = 'Brand#13' AND week_start >= DATE '2000-03-06' AND location_id IS NOT NULL GROUP BY 1)",
            div("a", "q") + " - 1",
            "location_id = 'L5'",
        ),
    ),
    row(
        "that store used it normally before",
        "abs(r - 1.055e0) < 0.03e0",
        f"'(' || {digits('r', 3)} || ')'",
        f"SELECT {div('sum(actual_qty)', 'sum(theoretical_qty)')} AS r FROM fact_usage "
        "WHERE ingredient_id = 'Brand#13' AND location_id = 'L5' AND week_start < DATE '2000-03-06'",
    ),
    row(
        "its price rose year on year",
        f"{div('a', 'b')} > 1.4e0",
        f"'(' || {digits('b', 2)} || ' -> ' || {digits('a', 2)} || ')'",
        "SELECT "
        + ", ".join(
            f"(SELECT {hu(div('sum(market_unit_cost)', 'count(*)'), 8)} FROM price_week WHERE ingredient_id = 'Brand#13' "
            f"AND {o.month('week_start')} = '{m}') AS {n}"
            for n, m in (("b", "1999-02"), ("a", "2000-02"))
        ),
    ),
    row(
        "menu items using the ingredient",
        "true",
        "'(N=' || n || ')'",
        "SELECT count(DISTINCT menu_item_id) AS n FROM bridge_recipe WHERE ingredient_id = 'Brand#13'",
    ),
    share(
        "SELECT sum(actual_qty * market_unit_cost) FROM fact_usage JOIN price_week USING (week_start, ingredient_id)",
        "SELECT sum(net_sales) FROM fact_sales",
        0.26,
        0.32,
        "food cost share is plausible",
    ),
    share("SELECT sum(labour_cost) FROM fact_shifts", "SELECT sum(net_sales) FROM fact_sales", 0.27, 0.34, "labour share is plausible"),
    row(
        "July is busier than January",
        "a > b * 1.15e0",
        versus("a", "b"),
        "SELECT "
        + ", ".join(
            f"(SELECT {div('sum(covers)', 'count(*)')} FROM cover_days WHERE month(business_date) = {m}) AS {n}" for n, m in (("a", 7), ("b", 1))
        ),
    ),
    row(
        "Saturday is busiest, Monday slowest",
        "t = 6 AND l = 1",
        "'(busiest ' || t || ', slowest ' || l || ')'",
        "SELECT arg_max(d, ROW(c, -d)) AS t, arg_min(d, ROW(c, d)) AS l FROM "
        "(SELECT isodow(business_date) AS d, sum(covers) AS c FROM cover_days GROUP BY 1) w",
    ),
    row(
        "rainy days are slower",
        "a < b",
        versus("a", "b"),
        "SELECT "
        + ", ".join(
            f"(SELECT {div('sum(covers)', 'sum(n)')} FROM cover_days WHERE business_date IN (SELECT calendar_date FROM dim_date) "
            f"AND (date_diff('day', DATE '1970-01-01', business_date) % 3 = 0) = {wet}) AS {n}"
            for n, wet in (("a", "true"), ("b", "false"))
        ),
    ),
)
SUITE_RAW = rows(
    row("raw sales hold copies", "held > kinds", "'(' || (held - kinds) || ')'", "SELECT * FROM raw_kinds"),
    row(
        "raw sales hold text dates",
        "r > 0.03e0",
        f"'(' || {digits('r', 3)} || ')'",
        "SELECT avg(CASE WHEN regexp_matches(business_date, '[A-Za-z]') THEN 1e0 ELSE 0e0 END) AS r FROM raw_sales",
    ),
    row("raw sales miss net values", "n > 0", "'(' || n || ')'", "SELECT count(*) - count(net_sales) AS n FROM raw_sales"),
    row("raw sales spell stores in many ways", "n > 10", "'(' || n || ' distinct)'", "SELECT count(DISTINCT store) AS n FROM raw_sales"),
    row("raw purchases hold pounds", "n > 0", "'(' || n || ')'", "SELECT count(*) AS n FROM raw_purchases WHERE unit = 'lb'"),
    row("raw timeclock misses ends", "n > 0", "'(' || n || ')'", "SELECT count(*) - count(actual_end) AS n FROM raw_shifts"),
    row(
        "raw sales without copies are the clean rows",
        "kinds = n",
        "'(' || kinds || ' vs ' || n || ')'",
        "SELECT kinds, (SELECT count(*) FROM fact_sales) AS n FROM raw_kinds",
    ),
)


@register(
    "validation_suite",
    rows(
        *[counted(f"unique key: {name}", repeated(*found), "repeated keys") for name, found in SUITE_KEYS.items()],
        *[counted(f"known: {name}", missing(*found), "orphans") for name, found in SUITE_REFERENCES.items()],
        SUITE_SALES,
        SUITE_LABOUR,
        SUITE_INVENTORY,
        SUITE_STORIES,
        SUITE_RAW,
    ),
)
def _(x: Extracts) -> DataFrame:
    """All 74 checks over written tables; of the extracts only the sales are written, which several passes read whole.

    The facts made from the lines are built one after another, as each fills the disks with its shuffles meanwhile.
    """
    raw = landed(x, "pos_sales")
    w = raw.warehouse(staged_all(x))
    for name in ("fact_sales_item_daypart", "fact_purchases", "fact_waste_log"):
        w.prepare(name)
    tables = w.build_all()
    prices = stage(weekly_prices(w), x.key("prices"))
    targets = measures.monthly_targets(w.fact_sales_item_daypart)
    hold = lambda name, df: stage(df, x.key(name))
    return validation_suite(raw, tables, prices, weather(x), targets, BENCH_EXPECTATIONS, hold)
