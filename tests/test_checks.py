"""Each generic check on rows that pass and rows that fail."""

from datetime import date, timedelta
from decimal import Decimal as D

from pyspark.sql import functions as F

from storeops.operators import checks

MONDAY = date(2026, 3, 2)


def result(df):
    (r,) = df.collect()
    return r.passed, r.detail


def test_keys_and_references(frame):
    rows = frame("k string, v int", ("a", 1), ("a", 2), ("b", 1), (None, 1))
    ref = frame("k string", ("a",), ("a",), ("c",))
    assert result(checks.unique_key("x", rows, ["k"])) == (0, "(1 repeated keys)")
    assert result(checks.unique_key("x", rows, ["k", "v"])) == (1, "(0 repeated keys)")
    assert result(checks.no_orphans("x", rows, "k", ref, "k")) == (0, "(2 orphans)")
    assert result(checks.no_orphans("x", rows.filter("k = 'a'"), "k", ref, "k")) == (1, "(0 orphans)")
    assert result(checks.same_keys("x", rows.dropna(), ref, "k")) == (0, "(2 on one side only)")


def test_orphans_with_one_hot_key(frame):
    rows = frame("k string", *[("hot",)] * 500, *[(f"k{i}",) for i in range(1000)])
    ref = frame("k string", *[(f"k{i}",) for i in range(0, 1000, 2)])
    assert result(checks.no_orphans("x", rows, "k", ref, "k")) == (0, "(1000 orphans)")


def test_agreement(frame):
    rows = frame("k string, role string", ("a", "x"), ("a", "y"), ("b", None), ("z", "x"))
    ref = frame("k string, role string", ("a", "x"), ("b", "x"))
    assert result(checks.joined_agree("x", rows, "role", ref, "role", "k")) == (0, "(2 violations)")
    shifts = frame("employee_id string, business_date date", ("a", MONDAY), ("a", MONDAY - timedelta(days=9)))
    hired = frame("employee_id string, hire_date date", ("a", MONDAY - timedelta(days=1)))
    assert result(checks.hired_before("x", shifts, hired)) == (0, "(1 violations)")


def test_prices_change_on_a_date(frame):
    menu = frame("menu_item_id string, price_2025 decimal(10,2), price_2026 decimal(10,2)", ("m", D("10.00"), D("10.40")))
    sales = frame(
        "business_date date, menu_item_id string, unit_price decimal(10,2)",
        (date(2026, 1, 4), "m", D("10.00")),
        (date(2026, 1, 5), "m", D("10.40")),
        (date(2026, 1, 6), "m", D("10.00")),
    )
    assert result(checks.price_by_date("x", sales, menu, "2026-01-05")) == (0, "(1 rows)")


def test_several_row_rules_in_one_pass(frame):
    rows = frame("v int", (1,), (-1,), (None,))
    out = {r.check_name: (r.passed, r.detail) for r in checks.row_rules(rows, {"neg": F.col("v") < 0, "big": F.col("v") > 9}).collect()}
    assert out == {"neg": (0, "(1 rows)"), "big": (1, "(0 rows)")}
    empty = {r.check_name: r.passed for r in checks.row_rules(rows.filter("false"), {"neg": F.col("v") < 0}).collect()}
    assert empty == {"neg": 1}


def test_totals(frame):
    a = frame("k string, v decimal(12,2)", ("x", D("10.00")), ("y", D("5.00")))
    b = frame("k string, v decimal(12,2)", ("x", D("10.10")), ("z", D("0.05")))
    assert result(checks.reconciled("x", a, b, ["k"], "v", "0.2")) == (0, "max diff 5.00")
    assert result(checks.reconciled("x", a.filter("k = 'x'"), b, ["k"], "v", "0.2")) == (1, "max diff 0.10")
    assert result(checks.totals_close("x", a, F.sum("v"), b, F.sum("v"), 0)) == (0, "15 vs 10")
    assert result(checks.totals_close("x", a, F.sum("v"), a, F.sum("v"), 0)) == (1, "15 vs 15")
    assert result(checks.totals_close("x", a, F.sum("v"), b, F.sum("v"), 0.5))[0] == 1
    assert result(checks.ratio_in_band("x", a, F.sum("v"), b, F.sum("v"), 1.4, 1.5)) == (1, "(1.478)")
    assert result(checks.total_equals_count("x", a, b)) == (1, "2 vs 2")


def test_weekly_cap_percentile_is_exact(frame):
    import numpy as np

    hours = [D(h) / 4 for h in range(40, 140)] + [D(30)] * 60
    rows = frame(
        "employee_id string, business_date date, actual_hours decimal(12,2)",
        *[(f"E{i}", MONDAY, h) for i, h in enumerate(hours)],
    )
    values = np.array([float(h) for h in hours])
    expected = f"(mean {values.mean():.1f}, p95 {np.quantile(values, 0.95):.1f}, max {values.max():.1f})"
    assert result(checks.weekly_cap("x", rows, 48)) == (1, expected)
    assert result(checks.weekly_cap("x", rows, 30))[0] == 0


def test_groups(frame):
    rows = frame("k string, v decimal(8,2)", ("a", D(1)), ("a", D(2)), ("b", D(3)))
    assert result(checks.largest_group("x", rows, ["k"], 1)) == (0, "(1 groups)")
    assert result(checks.smallest_group("x", rows, ["k"], 2)) == (0, "(min 1)")
    assert result(checks.at_least("x", rows, "v", "1.00")) == (1, "(min 1.00)")
    members = frame("m string", ("p",), ("q",))
    assert result(checks.complete_grid("x", rows.filter("k = 'a'"), "k", members)) == (1, "(2 rows, 1 x 2)")
    assert result(checks.complete_grid("x", rows, "k", members)) == (0, "(3 rows, 2 x 2)")


def test_stock_identity_counts_missing(frame):
    usage = frame(
        "week_start date, location_id string, ingredient_id string, actual_qty decimal(12,3)",
        (MONDAY, "L1", "a", D("7.000")),
        (MONDAY, "L1", "b", None),
    )
    counts = frame(
        "count_date date, location_id string, ingredient_id string, qty_on_hand double",
        (MONDAY - timedelta(days=1), "L1", "a", 5.0),
        (MONDAY + timedelta(days=6), "L1", "a", 2.0),
    )
    bought = frame(
        "delivery_date date, location_id string, ingredient_id string, qty_received decimal(12,3), line_total decimal(12,2)",
        (MONDAY, "L1", "a", D("4.010"), D(1)),
    )
    assert result(checks.stock_identity("x", usage, counts, bought)) == (1, "(max err 0.0100, missing 1)")


def test_stories(frame):
    groups = frame("g string, v double", ("a", 0.43), ("b", 0.35), ("c", None))
    assert result(checks.stands_out("x", groups, "v", F.col("g") == "a", 0.05)) == (1, "(0.430, next highest 0.350)")
    assert result(checks.stands_out("x", groups, "v", F.col("g") == "b", 0.05))[0] == 0
    usage = frame("a int, b int", (105, 100), (106, 100))
    assert result(checks.ratio_near("x", usage, "a", "b", 1.055, 0.03)) == (1, "(1.055)")
    prices = frame("m string, p decimal(8,2)", ("old", D(6)), ("old", D(7)), ("new", D(10)))
    assert result(checks.mean_rose("x", prices, "p", F.col("m"), "old", "new", 1.4)) == (1, "(6.50 -> 10.00)")
    assert result(checks.distinct_report("x", groups, "g")) == (1, "(N=3)")


def test_seasons(frame):
    covers = frame(
        "business_date date, covers bigint",
        (date(2025, 1, 6), 10),
        (date(2025, 7, 5), 30),
        (date(2025, 7, 12), 20),
        (date(2025, 7, 13), 15),
    )
    assert result(checks.busier_month("x", covers, 7, 1, 1.15)) == (1, "(21.7 vs 10.0)")
    assert result(checks.busiest_weekday("x", covers, 6, 1)) == (1, "(busiest 6, slowest 1)")
    weather = frame("date date, is_rainy_day int", (date(2025, 1, 6), 1), (date(2025, 7, 5), 0))
    assert result(checks.rainy_days_slower("x", covers, weather)) == (1, "(10.0 vs 30.0)")


def test_defects(frame):
    raw = frame("a string, b string", ("x", None), ("x", None), ("y", "1"))
    assert result(checks.has_copies("x", raw, ["a", "b"])) == (1, "(1)")
    assert result(checks.share_above("x", raw, F.col("a").rlike("x"), 0.5)) == (1, "(0.667)")
    assert result(checks.defects_present(raw, {"n": F.col("b").isNull()})) == (1, "(2)")
    assert result(checks.distinct_above("x", raw, "a", 10)) == (0, "(2 distinct)")
    assert result(checks.dedup_recovers("x", raw, ["a", "b"], frame("v int", (1,), (2,)))) == (1, "(2 vs 2)")


def test_report_shows_failures_first(frame):
    rows = frame("v int", (1,), (-1,))
    out = checks.report([checks.row_rules(rows, {"b": F.col("v") > 5, "a": F.col("v") < 0})]).collect()
    assert [r.check_name for r in out] == ["a", "b"]


def test_rain_means_leave_out_rows_without_covers(frame):
    covers = frame(
        "business_date date, covers bigint",
        (MONDAY, 10), (MONDAY, None), (MONDAY + timedelta(days=1), 8), (MONDAY + timedelta(days=1), 8),
    )
    weather = frame("date date, is_rainy_day int", (MONDAY, 1), (MONDAY + timedelta(days=1), 0))
    assert result(checks.rainy_days_slower("x", covers, weather)) == (0, "(10.0 vs 8.0)")
