"""Ranking, ties, missing ratios and last-year comparisons on hand-written rows."""

from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from storeops.operators import calendar, kpi, measures

MONDAY = date(2026, 3, 2)
HOURLY = "business_date date, location_id string, hour_of_day bigint, labour_hours decimal(12,2), labour_cost decimal(12,2), covers bigint, net_sales decimal(12,2)"


def hour(day, cost, sales, store="L1", covers=10, hours="5", at=12):
    return (day, store, at, D(hours), D(cost), covers, D(sales))


def test_worst_day_tie_and_day_without_sales(frame):
    rows = frame(
        HOURLY,
        hour(MONDAY + timedelta(days=2), "10", "100"),
        hour(MONDAY + timedelta(days=1), "20", "200"),
        hour(MONDAY, "99", "0"),
        hour(MONDAY, "50", "0", store="L2"),
        hour(date(2025, 3, 3), "999", "1"),
    )
    out = {r.location_id: r for r in kpi.labour_kpi(rows, ("2026-01-01", "2026-12-31")).collect()}
    assert (out["L1"].worst_day, out["L1"].worst_day_labour_pct) == ("Tue", pytest.approx(0.1))
    assert out["L2"].worst_day_labour_pct is None


def test_top_leak_tie_goes_by_name_and_unknown_cost_is_last(frame):
    leaks = frame(
        "location_id string, ingredient_name string, actual_qty decimal(12,3), theoretical_qty decimal(12,3), unexplained_variance decimal(12,2)",
        ("L1", "b", D(2), D(1), D(5)),
        ("L1", "a", D(3), D(1), D(5)),
        ("L1", "z", D(9), D(0), None),
        ("L2", "z", None, D(1), None),
    )
    out = {r.location_id: r for r in kpi.top_leak(leaks).collect()}
    assert (out["L1"].leak_ingredient, out["L1"].leak_over_pct) == ("a", 2.0)
    assert (out["L2"].leak_ingredient, out["L2"].leak_over_pct, out["L2"].leak_cost) == ("z", None, None)


def test_headline_takes_the_first_rule(frame):
    df = frame(
        "id int, worst_day_labour_pct double, worst_day string, leak_over_pct double, leak_ingredient string, over_use_pct double, labour_pct double",
        (1, 0.38, "Mon", 0.9, "x", 0.9, 0.9),
        (2, 0.3799, "Mon", 0.15, "x", 0.9, 0.9),
        (3, 0.1, "Mon", 0.1, "x", 0.03, 0.9),
        (4, 0.1, "Mon", 0.1, "x", 0.0, 0.305),
        (5, None, "Mon", None, "x", None, None),
    )
    got = [r.h for r in df.orderBy("id").select(kpi.headline().alias("h")).collect()]
    assert got == ["Labour: Mon schedule", "Food: x usage", "Food: general over-use", "Labour: above target", "On track"]


@pytest.fixture(scope="module")
def leap_calendar(spark):
    return calendar.build_calendar(calendar.day_range(spark, "2023-01-01", "2025-12-31"), calendar.holiday_table(spark))


def test_like_for_like(frame, leap_calendar):
    sales = frame(
        "business_date date, location_id string, net_sales decimal(12,2)",
        (date(2023, 3, 1), "L1", D(100)),
        (date(2024, 3, 1), "L1", D(110)),
        (date(2024, 3, 2), "L1", D(50)),  # opened only this year
        (date(2023, 3, 3), "L1", D(40)),  # closed this year
        (date(2023, 2, 28), "L1", D(7)),
        (date(2024, 2, 28), "L1", D(8)),
        (date(2024, 2, 29), "L1", D(9)),
        (None, "L1", D(1000)),
    )
    out = {r.year: r for r in measures.net_sales_yoy(sales, leap_calendar).collect()}
    y = out[2024]
    # The 29th is compared with 28 February 2023, which is summed once.
    assert (y.net_sales, y.net_sales_ly, y.net_sales_comparable) == (D(177), D(147), D(127))
    assert y.yoy_pct == pytest.approx((127 - 147) / 147)
    assert out[2023].net_sales_ly is None and out[2023].yoy_pct is None
    by_store = measures.net_sales_yoy(sales, leap_calendar, by=["location_id"], period=None).collect()
    assert [(r.location_id, r.net_sales) for r in by_store] == [("L1", D(324))]


def test_traffic_and_check(frame, leap_calendar):
    days = frame(
        "business_date date, net_sales decimal(12,2), covers bigint",
        (date(2024, 5, 1), D(1000), 100),
        (date(2025, 5, 1), D(1320), 110),
        (date(2025, 5, 2), D(9999), 1),
    )
    (r,) = measures.traffic_and_check(days, leap_calendar).collect()
    assert (r.sales_growth, r.traffic_growth, r.check_growth) == (pytest.approx(0.32), pytest.approx(0.1), pytest.approx(0.2))


def test_a_leap_day_does_not_double_the_year_before(frame, leap_calendar):
    """28 and 29 February 2024 meet 28 February 2023, which counts once."""
    days = frame(
        "business_date date, net_sales decimal(12,2), covers bigint",
        *[(d, D(100), 10) for d in (date(2023, 2, 28), date(2024, 2, 28), date(2024, 2, 29))],
    )
    (r,) = measures.traffic_and_check(days, leap_calendar).collect()
    assert (r.net_sales, r.net_sales_ly, r.covers, r.covers_ly) == (200, 100, 20, 10)
    assert (r.sales_growth, r.traffic_growth, r.check_growth) == (1.0, 1.0, 0.0)
    whole = measures.traffic_days(days.select("business_date", "net_sales"), days.select("business_date", "covers"))
    assert sorted(whole.select(days.columns).collect()) == sorted(days.collect())


def test_cards_keep_every_row_and_work_without_keys(frame):
    sales = frame(
        "business_date date, location_id string, net_sales decimal(12,2)",
        (MONDAY, "L1", D(100)), (MONDAY, None, D(50)), (None, "L1", D(7)),
    )
    covers = frame("business_date date, location_id string, covers bigint", (MONDAY, "L1", 10), (MONDAY, None, 5))
    (r,) = measures.sales_summary(sales, covers).collect()
    assert (r.net_sales, r.covers, r.avg_check) == (D(157), 15, pytest.approx(157 / 15))
    by_store = {r.location_id: (r.net_sales, r.covers) for r in measures.sales_summary(sales, covers, ["location_id"]).collect()}
    assert by_store == {"L1": (D(107), 10), None: (D(50), 5)}
    usage = frame("location_id string, actual_cost decimal(12,2)", ("L1", D(20)), (None, D(15)))
    (r,) = measures.food_cost_pct(usage, sales).collect()
    assert (r.actual_cost, r.net_sales) == (D(35), D(157))
    shares = {r.location_id: r.food_cost_pct for r in measures.food_cost_pct(usage, sales, ["location_id"]).collect()}
    assert shares == {"L1": pytest.approx(20 / 107), None: pytest.approx(0.3)}


def test_heatmap_leaves_out_closed_hours(frame):
    rows = frame(HOURLY, hour(MONDAY, "10", "100"), hour(MONDAY, "50", "1", at=6), hour(MONDAY + timedelta(days=5), "20", "50"))
    (r,) = measures.labour_heatmap(rows).collect()
    assert (r.Mon, r.Sat, r.Sun) == (pytest.approx(0.1), pytest.approx(0.4), None)


def test_forecast_follows_a_straight_line(frame):
    weeks = [(MONDAY + timedelta(weeks=i), 1000 if i < 4 else 100 + 10 * i) for i in range(12)]
    out = measures.weekly_covers_forecast(frame("week_start date, covers bigint", *weeks)).orderBy("week_start").collect()
    assert [r.is_forecast for r in out] == [0] * 12 + [1] * 4
    assert [round(r.covers, 6) for r in out[12:]] == [220.0, 230.0, 240.0, 250.0]
    assert out[12].week_start == MONDAY + timedelta(weeks=12)


def test_savings_count_only_excess_hours(frame):
    rows = frame(HOURLY, hour(MONDAY, "200", "100", covers=10, hours="20"), hour(MONDAY, "100", "100", store="L2", covers=10, hours="10"))
    out = {r.location_id: r for r in measures.action_savings(rows, weeks=4).collect()}
    assert (out["L1"].excess_hours, out["L1"].annual_saving) == (pytest.approx(5.0), pytest.approx(5 * 10 * 13))
    assert out["L2"].excess_hours == 0
    # Without weeks the period runs from the first day to the last, here one day.
    whole = {r.location_id: r.annual_saving for r in measures.action_savings(rows).collect()}
    assert whole["L1"] == pytest.approx(5 * 10 * 364)


def test_note_lookup_shows_the_chain_only_without_a_store(frame):
    notes = frame("location_id string, recommendation_text string", ("ALL", "chain"), ("L1", "one"))
    chosen = frame("id int, location_id string", (1, "L1"), (2, "L7"), (3, None))
    assert [r.note for r in measures.note_lookup(chosen, notes).orderBy("id").collect()] == ["one", None, "chain"]


BRIDGE = "week_start date, location_id string, ingredient_id string, theoretical_cost_at_standard decimal(12,2), price_variance decimal(12,2), recorded_waste_cost decimal(12,2), unexplained_variance decimal(12,2), actual_cost decimal(12,2)"


def test_bridge_measures(frame):
    usage = frame(
        BRIDGE,
        (MONDAY, "L1", "a", D(80), D(20), D(3), D(7), D(110)),
        (MONDAY + timedelta(weeks=5), "L1", "b", D(10), D(0), D(0), D(1), D(11)),
    )
    steps = {r.step: r.value for r in measures.bridge_waterfall(usage).collect()}
    assert steps == {"Supplier price": D(20), "Recorded waste": D(3), "Unexplained": D(8)}
    assert measures.over_use_pct(usage).first().over_use_pct == pytest.approx(0.1)
    sales = frame("location_id string, net_sales decimal(12,2)", ("L1", D(400)), ("L2", D(10)))
    status = {r.location_id: (r.food_cost_pct, r.status) for r in measures.food_cost_pct(usage, sales, ["location_id"]).collect()}
    assert status == {"L1": (pytest.approx(121 / 400), "Above target"), "L2": (None, None)}
    drill = measures.usage_drill(usage)
    assert {r.level: r.n for r in drill.groupBy("level").agg(F.count("*").alias("n")).collect()} == {0: 2, 1: 2, 3: 1, 7: 1}
    assert drill.filter("level = 7").first().unexplained_variance == D(8)


def test_targets(frame):
    sales = frame("business_date date, location_id string, net_sales decimal(12,2)", (MONDAY, "L1", D(1000)), (MONDAY, "L2", D(500)))
    targets = measures.monthly_targets(sales)
    row = targets.filter("location_id = 'L1'").first()
    assert (row.net_sales_budget, row.labour_pct_target, row.avg_check_target) == (D(1000), 0.3, 24.0)
    actual = frame("year_month string, location_id string, net_sales decimal(12,2)", ("2026-03", "L1", D("1100")))
    out = {r.location_id: (r.status, r.insight) for r in measures.targets_status(targets, actual).collect()}
    assert out["L1"] == ("On target", "L1 sold $1,100 in 2026-03, 110.0% of budget")
    assert out["L2"] == ("Below target", "L2 sold $0 in 2026-03, 0.0% of budget")
