"""Shifts and their split across clock hours."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from storeops.operators import facts

CLOCK = (
    "shift_id string, business_date string, store string, employee_id string, role string, scheduled_start string, "
    "scheduled_end string, actual_start string, actual_end string, _loaded_at int"
)


def shifts(frame, *rows, **kwargs):
    store = frame("alias_key string, location_id string", ("A", "L1"))
    role = frame("alias_key string, role string", ("COOK", "Cook"))
    employee = frame("employee_id string, hourly_wage_2025 decimal(8,2)", ("E1", Decimal("20.01")))
    return facts.shifts_fact(frame(CLOCK, *rows), store, role, employee, **kwargs)


def shift(i, day="2025-12-31", sched=("07:00", "15:00"), actual=("07:00", "15:00"), employee="E1", loaded=1):
    stamp = [f"{day} {t}" if t else None for t in (*sched, *actual)]
    return (str(i), day, "a ", employee, " cook", *stamp, loaded)


def test_clock_out_wage_and_block(frame):
    out = shifts(
        frame,
        shift(1),
        shift(1, loaded=0, actual=("07:00", "14:00")),
        shift(2, day="2026-01-01", sched=("11:00", "19:00"), actual=("11:00", None)),
        shift(3, sched=("15:00", None), actual=("15:00", None), employee="E9"),
    ).orderBy("shift_id").collect()
    assert [r.shift_block for r in out] == ["AM", "MID", "PM"]
    assert [r.is_clock_out_imputed for r in out] == [0, 1, 1]
    assert [r.actual_hours for r in out] == [Decimal("7.00"), Decimal("8.00"), None]
    assert [r.hourly_wage for r in out] == [Decimal("20.01"), Decimal("20.51"), None]
    assert [r.labour_cost for r in out] == [Decimal("140.07"), Decimal("164.08"), None]
    assert [r.location_id for r in out] == ["L1"] * 3 and [r.role for r in out] == ["Cook"] * 3


SPAN = "business_date date, location_id string, hourly_wage decimal(10,2), actual_start timestamp_ntz, actual_end timestamp_ntz"


def spans(frame, *minutes):
    day = datetime(2025, 5, 5)
    rows = [(day.date(), f"L{i}", Decimal("20.00"), day + timedelta(minutes=a), day + timedelta(minutes=b)) for i, (a, b) in enumerate(minutes)]
    return frame(SPAN, *rows)


def test_hours_of_three_shifts(frame):
    out = facts.split_hours(spans(frame, (6 * 60 + 58, 15 * 60 + 10), (22 * 60 + 30, 24 * 60 + 10), (5 * 60 + 30, 6 * 60 + 30)))
    totals = {r.location_id: (r.n, r.h) for r in out.groupBy("location_id").agg(F.count("*").alias("n"), F.sum("hrs").alias("h")).collect()}
    assert totals["L0"] == (10, Decimal("8.200000"))
    assert totals["L1"] == (2, Decimal("1.500000"))
    assert totals["L2"] == (1, Decimal("0.500000"))


def test_split_equals_the_overlap_condition(frame):
    rng = random.Random(7)
    pairs = [(a, a + rng.choice([0, -20, 15, 60, 300, 900])) for a in (rng.randrange(0, 1500) for _ in range(300))]
    pairs += [(600, 600), (615, 615), (659, 601)]
    got = sorted((r.location_id, r.hour_of_day, r.hrs) for r in facts.split_hours(spans(frame, *pairs)).collect())
    expected = []
    for i, (a, b) in enumerate(pairs):
        for h in range(6, 24):
            if h * 60 < b and (h + 1) * 60 > a:
                part = min(b, (h + 1) * 60) - max(a, h * 60)
                expected.append((f"L{i}", h, (Decimal(part) / 60).quantize(Decimal("0.000001"))))
    assert got == sorted(expected)


def test_split_needs_no_nested_loop_join(frame):
    plan = facts.split_hours(spans(frame, (600, 700)))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hourly_table_keeps_both_sides(frame):
    covers = frame(
        "business_date date, location_id string, hour_of_day bigint, daypart string, covers bigint, net_sales decimal(12,2)",
        (date(2025, 5, 5), "L0", 10, "Breakfast", 7, Decimal("70.00")),
        (date(2025, 5, 5), "L0", 20, "Dinner", 9, Decimal("90.00")),
        (date(2025, 5, 5), None, 10, "Breakfast", 1, Decimal("1.00")),
    )
    work = spans(frame, (600, 660))
    out = facts.labour_hourly_fact(work, covers).orderBy(F.col("location_id").asc_nulls_first(), "hour_of_day").collect()
    assert [(r.location_id, r.hour_of_day, r.covers, float(r.labour_hours)) for r in out] == [
        (None, 10, 1, 0.0),
        ("L0", 10, 7, 1.0),
        ("L0", 20, 9, 0.0),
    ]
    assert [float(r.labour_cost) for r in out] == [0.0, 20.0, 0.0]


def test_hour_bands(frame):
    df = frame("h int", *[(h,) for h in (6, 7, 10, 11, 14, 15, 16, 17, 20, 21, 23)])
    bands = [r.v for r in df.orderBy("h").select(facts.hour_daypart(F.col("h")).alias("v")).collect()]
    assert bands == ["Late Night", "Breakfast", "Breakfast", "Lunch", "Lunch", "Afternoon", "Afternoon", "Dinner", "Dinner", "Late Night", "Late Night"]
