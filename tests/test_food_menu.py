"""The food-cost bridge and the menu quadrants on hand-written rows."""

from datetime import date, timedelta
from decimal import Decimal as D

from storeops.operators import foodcost, menu

MONDAY = date(2025, 3, 3)


def usage(frame, purchases=(), counts=(), waste=(), sales=((MONDAY, "L1", "M1", 100),), recipe=(("M1", "tomato", D("0.2000")),), year=2026):
    return foodcost.usage_weekly_fact(
        foodcost.usage_base(
            frame("business_date date, location_id string, menu_item_id string, qty_sold bigint", *sales),
            frame("menu_item_id string, ingredient_id string, qty_per_item decimal(12,4)", *recipe),
            frame(
                "ingredient_id string, std_cost_2025 decimal(12,4), std_cost_2026 decimal(12,4)",
                ("tomato", D("4.0000"), D("5.0000")),
                ("beef", D("9.0000"), D("9.0000")),
            ),
            foodcost.weekly_purchases(
                frame(
                    "delivery_date date, location_id string, ingredient_id string, qty_received decimal(18,3), line_total decimal(12,2)",
                    *purchases,
                )
            ),
            frame("count_date date, location_id string, ingredient_id string, qty_on_hand double", *counts),
            frame("waste_date date, location_id string, ingredient_id string, qty_wasted double", *waste),
            year,
        )
    )


def counted(store="L1", opening=10.0, closing=8.0):
    return [
        (MONDAY - timedelta(days=1), store, "tomato", opening),
        (MONDAY + timedelta(days=6), store, "tomato", closing),
    ]


def test_bridge_with_own_price(frame):
    out = usage(
        frame,
        purchases=[(MONDAY, "L1", "tomato", D("10"), D("50.00")), (MONDAY + timedelta(days=3), "L1", "tomato", D("10"), D("40.00"))],
        counts=counted(),
        waste=[(MONDAY + timedelta(days=2), "L1", "tomato", 0.5)],
    ).collect()
    (r,) = out
    assert (r.theoretical_qty, r.actual_qty, r.unit_cost, r.std_unit_cost) == (D("20.000"), D("22.000"), D("4.5000"), D("4.0000"))
    assert (r.theoretical_cost_at_standard, r.price_variance, r.recorded_waste_cost, r.unexplained_variance, r.actual_cost) == (
        D("80.00"), D("10.00"), D("2.25"), D("6.75"), D("99.00"),
    )
    assert r.usage_variance_pct == D("0.1000")
    parts = r.theoretical_cost_at_standard + r.price_variance + r.recorded_waste_cost + r.unexplained_variance
    assert abs(parts - r.actual_cost) <= D("0.05")


def test_price_falls_back_to_chain_then_standard(frame):
    other = [(MONDAY, "L2", "tomato", D("4"), D("24.00"))]
    assert usage(frame, purchases=other, counts=counted()).collect()[0].unit_cost == D("6.0000")
    assert usage(frame, counts=counted()).collect()[0].unit_cost == D("4.0000")
    assert usage(frame, counts=counted(), year=2025).collect()[0].unit_cost == D("5.0000")


def test_missing_count_leaves_actual_unknown(frame):
    (r,) = usage(frame, counts=counted()[:1]).collect()
    assert (r.opening_qty, r.closing_qty, r.actual_qty, r.actual_cost, r.unexplained_variance) == (D("10.000"), None, None, None, None)
    assert r.theoretical_cost_at_standard == D("80.00")


def test_repeated_count_repeats_the_row(frame):
    assert usage(frame, counts=counted() + counted()[:1]).count() == 2


def test_sunday_belongs_to_the_week_before(frame):
    sunday = MONDAY - timedelta(days=1)
    (r,) = usage(frame, sales=[(sunday, "L1", "M1", 10)]).collect()
    assert r.week_start == MONDAY - timedelta(days=7)


def test_theoretical_usage_against_brute_force(frame):
    import random

    rng = random.Random(3)
    sales = [(MONDAY + timedelta(days=rng.randrange(30)), f"L{rng.randrange(3)}", f"M{rng.randrange(4)}", rng.randrange(9)) for _ in range(300)]
    # One item holds a third of all rows.
    sales += [(MONDAY, "L0", "M0", 2)] * 150
    recipe = [(f"M{m}", i, D(f"0.{m + 1}000")) for m in range(4) for i in ("tomato", "beef")]
    expected = {}
    for day, store, item, qty in sales:
        week = day - timedelta(days=day.weekday())
        for m, i, per in recipe:
            if m == item:
                expected[week, store, i] = expected.get((week, store, i), D(0)) + qty * per
    got = foodcost.theoretical_usage(
        frame("business_date date, location_id string, menu_item_id string, qty_sold bigint", *sales),
        frame("menu_item_id string, ingredient_id string, qty_per_item decimal(12,4)", *recipe),
    ).collect()
    assert {(r.week_start, r.location_id, r.ingredient_id): r.theoretical_qty for r in got} == expected


MENU = (
    "menu_item_id string, menu_item_name string, category string, is_main bigint, price_2025 decimal(10,2), "
    "std_food_cost_2025 decimal(12,3), food_cost_pct_2025 decimal(8,4), contribution_margin_2025 decimal(12,2)"
)


def test_quadrants(frame):
    def item(key, margin, main=1):
        return (key, key, "x", main, D("20.00"), D("5.000"), D("0.2500"), D(margin))

    items = frame(MENU, item("star", "12"), item("plow", "8"), item("puzzle", "12"), item("dog", "8"), item("side", "50", 0), item("unsold", "9"))
    sold = frame("menu_item_id string, qty_sold bigint", ("star", 45), ("plow", 45), ("puzzle", 5), ("dog", 5), ("side", 900))
    out = {r.menu_item_id: r for r in menu.menu_quadrants(items, sold).collect()}
    assert {k: r.quadrant for k, r in out.items()} == {"star": "Star", "plow": "Plowhorse", "puzzle": "Puzzle", "dog": "Dog"}
    assert out["star"].popularity_threshold == D("0.1750") and out["star"].avg_contribution_margin == D("10.00")


def test_quadrant_thresholds_count_as_reached(frame):
    def item(key, margin):
        return (key, key, "x", 1, D("20.00"), D("5.000"), D("0.2500"), D(margin))

    # Two items: the threshold is 0.35; equal margins equal the average.
    items = frame(MENU, item("a", "10"), item("b", "10"))
    sold = frame("menu_item_id string, qty_sold bigint", ("a", 65), ("b", 35))
    assert {r.quadrant for r in menu.menu_quadrants(items, sold).collect()} == {"Star"}


def test_equal_margins_always_reach_their_mean(frame):
    """As quotients of doubles, many equal margins would fall below their own mean."""
    for margin in ("0.10", "0.70", "1.10", "3.30", "7.70", "12.35"):
        items = frame(MENU, *[(k, k, "x", 1, D("20.00"), D("5.000"), D("0.2500"), D(margin)) for k in "abc"])
        sold = frame("menu_item_id string, qty_sold bigint", ("a", 3), ("b", 7), ("c", 11))
        assert {r.quadrant for r in menu.menu_quadrants(items, sold).collect()} <= {"Star", "Puzzle"}


def test_quadrants_use_no_single_partition_window(frame):
    items = frame(MENU, ("a", "a", "x", 1, D("20.00"), D("5.000"), D("0.2500"), D("10")))
    sold = frame("menu_item_id string, qty_sold bigint", ("a", 65))
    plan = menu.menu_quadrants(items, sold)._jdf.queryExecution().toString()
    assert "Window" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
