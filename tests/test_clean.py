"""Cleaning steps on hand-written rows, one frame per kind of defect."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from storeops.functions.columns import minutes_between, ratio, try_day, try_minute, try_whole
from storeops.functions.text import percent_text, sentence, whole_text
from storeops.operators import clean, facts


def column(df, name="v"):
    return [r[name] for r in df.select(name).collect()]


def test_two_date_formats(frame):
    df = frame("id int, v string", (1, "2025-03-04"), (2, "04-Mar-2025"), (3, "04-MAR-2025"), (4, "xx"), (5, None))
    out = clean.type_columns(df, {"v": "mixed_day"}).orderBy("id")
    assert column(out) == [date(2025, 3, 4)] * 3 + [None] * 2
    assert column(df.select(try_day(F.col("v")).alias("v"), "id").orderBy("id")) == [date(2025, 3, 4)] + [None] * 4


def test_numbers_never_fail(frame):
    df = frame("id int, v string", (1, "3.7"), (2, "abc"), (3, " 3 "), (4, "12345678901"), (5, None), (6, "-2.5"))
    assert column(df.orderBy("id").select(try_whole(F.col("v")).alias("v"))) == [4, None, 3, 12345678901, None, -3]
    money = clean.type_columns(df, {"v": "decimal(12,2)"}).orderBy("id")
    assert column(money) == [Decimal("3.70"), None, Decimal("3.00"), None, None, Decimal("-2.50")]
    double = clean.type_columns(df, {"v": "double"}).orderBy("id")
    assert column(double) == [3.7, None, 3.0, 12345678901.0, None, -2.5]


def test_alias_keeps_unmapped_rows(frame):
    alias = frame("alias_key string, location_id string", ("KITS", "L02"), ("KITSILANO", "L02"))
    df = frame("id int, store string", (1, "KITS"), (2, "kits "), (3, "Kitsilano"), (4, "Mars"), (5, None))
    out = clean.resolve_alias(df, "store", alias, "location_id").orderBy("id")
    assert column(out, "location_id") == ["L02"] * 3 + [None] * 2
    assert column(out, "store")[1] == "kits "


def test_alias_may_replace_its_own_column(frame):
    alias = frame("alias_key string, role string", ("DISH", "Dishwasher"))
    out = clean.resolve_alias(frame("role string", ("dish",)), "role", alias, "role")
    assert out.columns == ["role"] and column(out, "role") == ["Dishwasher"]


def test_dedup_takes_the_earliest_and_breaks_ties(frame):
    df = frame("k string, t int, v int", ("a", 1, 5), ("a", 1, 5), ("b", 2, 1), ("b", 1, 9), ("c", 1, 4), ("c", 1, 3))
    out = clean.first_per_grain(df, ["k"], ["t", "v"])
    assert sorted((r.k, r.v) for r in out.collect()) == [("a", 5), ("b", 9), ("c", 3)]


def test_dedup_is_cut_before_the_shuffle(frame):
    df = frame("k string, t int, v int", ("a", 1, 5))
    plan = clean.first_per_grain(df, ["k"], ["t", "v"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


SALES = (
    "business_date string, store string, daypart string, menu_item_id string, menu_item_name string, qty_sold string, "
    "unit_price string, gross_sales string, discounts string, comps string, net_sales string, _loaded_at int"
)


def sale(store="A", qty="1", net="9.00", loaded=1, comps="0.50", day="2025-03-04"):
    return (day, store, "Lunch", "M1", "Soup", qty, "10.00", "10.00", "0.50", comps, net, loaded)


def test_unmapped_stores_share_a_grain_unless_kept(frame):
    alias = frame("alias_key string, location_id string", ("A", "L1"))
    raw = frame(SALES, sale("A"), sale("Mars", "2"), sale("Venus", "3"), sale("Venus", "3"))
    assert facts.sales_fact(raw, alias).count() == 2
    kept = facts.sales_fact(raw, alias, keep_unmapped=True)
    assert sorted(column(kept, "qty_sold")) == [1, 2, 3]


def test_net_sales_are_rebuilt_and_flagged(frame):
    alias = frame("alias_key string, location_id string", ("A", "L1"))
    raw = frame(
        SALES,
        sale(day="2025-01-01"),
        sale(day="02-Jan-2025", net=None),
        sale(day="2025-01-03", net=None, comps=None),
    )
    out = facts.sales_fact(raw, alias).orderBy("business_date")
    assert column(out, "net_sales") == [Decimal("9.00"), Decimal("9.00"), None]
    assert column(out, "is_net_sales_imputed") == [0, 1, 1]


def test_pounds_become_kilograms(frame):
    df = frame("id int, q double, c double, unit string", (1, 2.0, 3.0, "kg"), (2, 2.20462, 1.0, "lb"), (3, 5.0, 1.0, "each"), (4, 1.0, 1.0, None))
    out = clean.convert_unit(df, "q", "c").orderBy("id").collect()
    assert [(float(r.q), float(r.c), r.unit, r.is_unit_converted) for r in out] == [
        (2.0, 3.0, "kg", 0),
        (1.0, 2.205, "kg", 1),
        (5.0, 1.0, "each", 0),
        (1.0, 1.0, None, 0),
    ]


def test_minutes_count_boundaries_and_know_no_time_zone(spark, frame):
    spark.conf.set("spark.sql.session.timeZone", "America/Vancouver")
    try:
        df = frame("a string, b string", ("2025-03-09 01:30", "2025-03-09 03:30"))
        stamps = df.select(try_minute(F.col("a")).alias("a"), try_minute(F.col("b")).alias("b"))
        assert column(stamps.select(minutes_between(F.col("a"), F.col("b")).alias("v"))) == [120]
        gap = frame("a string", ("2025-03-09 02:30",)).select(try_minute(F.col("a")).alias("v"))
        assert column(gap) == [datetime(2025, 3, 9, 2, 30)]
        seconds = spark.sql("SELECT timestamp_ntz'2025-01-01 10:00:59' AS a, timestamp_ntz'2025-01-01 10:01:00' AS b")
        assert column(seconds.select(minutes_between(F.col("a"), F.col("b")).alias("v"))) == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_timestamps_need_the_full_format(frame):
    df = frame("id int, a string", (1, "2025-01-01 10:00"), (2, "2025-01-01"), (3, "2025-01-01 10:00:30"), (4, "noon of the day!"))
    assert column(df.orderBy("id").select(try_minute(F.col("a")).alias("v"))) == [datetime(2025, 1, 1, 10), None, None, None]


def test_text_of_numbers(frame):
    df = frame("id int, p double, m double", (1, 0.4225, 6140.5), (2, -0.0835, -6140.5), (3, None, None), (4, 0.005, 0.4))
    out = df.orderBy("id").select(percent_text(F.col("p")).alias("p"), whole_text(F.col("m")).alias("m")).collect()
    assert [(r.p, r.m) for r in out] == [("42.3", "6,141"), ("-8.4", "-6,141"), (None, None), ("0.5", "0")]


def test_a_null_slot_voids_the_sentence(frame):
    df = frame("id int, a string", (1, "x"), (2, None))
    text = df.orderBy("id").select(sentence("{a} of {b}!", a=F.col("a"), b=F.lit("y")).alias("v"))
    assert column(text) == ["x of y!", None]


def test_ratio_guards_zero(frame):
    df = frame("a int, b int", (1, 2), (1, 0), (None, 1))
    assert column(df.select(ratio(F.col("a"), F.col("b")).alias("v"))) == [0.5, None, None]


def test_nan_does_not_fail_the_rounding(frame):
    df = frame("q string, c string, unit string", ("NaN", "Infinity", "kg"))
    out = clean.convert_unit(clean.type_columns(df, {"q": "double", "c": "double"}), "q", "c").collect()
    assert (out[0].q, out[0].c) == (None, None)
