"""What the shared steps move: rows are sorted once, after the shuffle, and staged tables are not dealt again by month."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from storeops.operators import checks, clean, facts, foodcost, quality
from storeops.plans import catalog, catalog_checks, catalog_measures  # noqa: F401
from storeops.plans.extracts import Extracts
from storeops.schemas import EXTRACTS
from storeops.sources import tables
from storeops.sources.tables import CLEANUP, stage, staged_path

SALES = (
    "business_date string, store string, daypart string, menu_item_id string, menu_item_name string, qty_sold string, "
    "unit_price string, gross_sales string, discounts string, comps string, net_sales string, _loaded_at int"
)
SALE = ("2025-03-04", "A", "Lunch", "M1", "Soup", "1", "10.00", "10.00", "0.50", "0.50", "9.00", 1)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_rows_are_sorted_after_the_shuffle_only(frame):
    rows = frame("k string, g string, t int", ("a", "x", 2), ("a", "x", 1), ("b", "x", 1))
    first = clean.first_per_grain(rows, ["k", "g"], ["t"], spread=["k"])
    plan = physical(first)
    assert plan.count("Exchange") == 1 and "Sort" not in plan[plan.index("Exchange") :]
    assert sorted((r.k, r.t) for r in first.collect()) == [("a", 1), ("b", 1)]


def test_weekly_sums_follow_the_sales_fact_without_a_shuffle(frame):
    sales = facts.sales_fact(frame(SALES, SALE), frame("alias_key string, location_id string", ("A", "L1")))
    recipe = frame("menu_item_id string, ingredient_id string, qty_per_item decimal(12,4)", ("M1", "I1", Decimal("0.5")))
    plan = physical(foodcost.theoretical_usage(sales, recipe))
    assert "hashpartitioning(location_id" in plan
    assert not any("hashpartitioning(week_start" in line and "menu_item_id" in line for line in plan.splitlines())


def test_staged_facts_are_not_laid_out_by_month(spark):
    x = Extracts(spark, "/root/testdata/sf0.001")
    x.key = lambda name: f"test-layout:{name}"
    w = x.warehouse(catalog.staged(x, "fact_sales_item_daypart"))
    assert w.fact_sales_item_daypart.count() > 0
    folder = staged_path(spark, "test-layout:fact_sales_item_daypart").removeprefix("file:")
    assert not [name for name in os.listdir(folder) if name.startswith("year_month=")]


def test_kpi_facts_hold_only_the_days_that_count(spark):
    x = Extracts(spark, "/root/testdata/sf0.001")
    x.key = lambda name: f"test-days:{name}"
    w = catalog.kpi_warehouse(x, catalog.BENCH_PERIOD)
    assert 0 < w.fact_sales_item_daypart.count() == w.fact_sales_item_daypart.filter("business_date >= '2000-01-01'").count()
    whole = x.lazy_warehouse.fact_ingredient_usage_weekly.filter("week_start >= '2000-01-01'")
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, w.fact_ingredient_usage_weekly.collect()))


def test_raw_sales_are_profiled_by_store_and_by_name(frame):
    """Three stores selling one item under one name: four rows instead of one per store and name."""
    raw = {"pos_sales": frame(SALES, *[(*SALE[:1], s, *SALE[2:]) for s in ("A", "B", None)], ("04-Mar-2025", "A", *SALE[2:]))}

    class Any(dict):
        def __missing__(self, name):
            return EMPTY[name]

    x = Extracts(frame("a int", (1,)).sparkSession, "/root/testdata/sf0.001")
    EMPTY = {n: x[n] for n in x} | {n: getattr(x.lazy_warehouse, n) for n in x.lazy_warehouse.TABLES}
    out = quality.profiles(Any(raw), Any())["pos_sales"].collect()
    assert sorted((r.by_name, str(r.store), r.rows, r.check_2) for r in out) == [(0, "A", 2, 1), (0, "B", 1, 0), (0, "None", 1, 0), (1, "None", 4, 1)]


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("|")
    return {f for f in files.split("|") if "shuffle_" in f}


def test_staging_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    rows = stage(sums.repartition("s"), "test-freed")
    assert not shuffle_files(spark) - before
    assert rows.count() == 7
    assert spark.conf.get(CLEANUP, None) == setting


def test_lines_meet_the_parts_before_they_carry_names(spark):
    plan_before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(Extracts(spark, "/root/testdata/sf0.001").purchasing)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", plan_before)
    dealt = plan[plan.index("hashpartitioning(l_partkey") :]
    assert "Join" not in dealt[: dealt.index("FileScan")]


def staged_keys(spark, sf: str, name: str) -> set[str]:
    catalog.QUERIES[name](spark, sf).collect()
    return {key.removeprefix(f"{sf}:") for _, key in tables._STAGED if key.startswith(f"{sf}:")}


@pytest.mark.parametrize("name", ["food_cost_pct", "food_cost_total", "check_identity"])
def test_weekly_sums_are_staged_and_not_the_sales(spark, tmp_path, name):
    sf = str(tmp_path / "sf")
    os.symlink("/root/testdata/sf0.001", sf)
    keys = staged_keys(spark, sf, name)
    assert "weekly_sold" in keys and "fact_sales_item_daypart" not in keys


def test_the_identity_check_deals_weekly_sales_once(spark):
    plan = physical(catalog.QUERIES["check_identity"](spark, "/root/testdata/sf0.001"))
    assert not any("hashpartitioning(week_start" in line and "menu_item_id" in line for line in plan.splitlines())


def test_rows_are_compared_in_full_where_digests_repeat(frame):
    """Nulls do not count in a digest, so the second and third row share one without being equal."""
    rows = [("a", "b"), ("c", None), (None, "c"), ("d", "e"), ("d", "e"), (None, None)]
    df, kept = frame("x string, y string", *rows), []

    def hold(digests):
        kept.append(digests.count())
        return digests

    assert checks.perhaps_equal(df, ["x", "y"], hold).count() == 4 and kept == [2]
    by_digest = checks.unique_key("k", df, ["x", "y"], hold).collect()
    assert by_digest == checks.unique_key("k", df, ["x", "y"]).collect() and by_digest[0].detail == "(1 repeated keys)"


def test_profile_by_digest_is_the_profile_of_all_rows(frame):
    none = [None] * 11
    rows = [SALE, SALE, (*SALE[:1], None, *SALE[2:]), ("04-Mar-2025", *SALE[1:]), (*SALE[:10], None, 1), (*none, 1), (*none, 2)]
    df, cols = frame(SALES, *rows), list(EXTRACTS["pos_sales"])
    plain = checks.profile_of_sales(df, cols)
    assert checks.profile_of_sales(df, cols, lambda digests: digests).select(plain.columns).collect() == plain.collect()
    none_at_all = df.filter("false")
    assert checks.profile_of_sales(none_at_all, cols, lambda d: d).select(plain.columns).collect() == (
        checks.profile_of_sales(none_at_all, cols).collect()
    )


def test_the_suite_writes_each_kind_of_check(spark):
    keys = staged_keys(spark, "/root/testdata/sf0.001", "validation_suite")
    kinds = {f"{kind}_checks" for kind in ("key", "reference", "sales", "labour", "inventory", "story", "raw")}
    assert kinds | {"pos_sales", "purchases_key_digests", "raw_sales_digests"} <= keys
