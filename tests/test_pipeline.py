"""CSV extracts through landing, warehouse, quality log, KPI rows and notes, with the published aliases."""

import gzip
import os
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from storeops.operators import kpi, quality
from storeops.plans.warehouse import Rules, keep_in, published_warehouse
from storeops.schemas import EXTRACTS
from storeops.sources import landing
from storeops.plans.refresh import refresh
from storeops.sources.tables import append_log, export_csv, literal_rows, live_path, read_days, read_export, read_latest, read_table, shared_folder, stage, staged_path, write_table

CSV = {
    "pos_sales": [
        "2026-03-02,KITS,Lunch,M1,Tomato Soup,10,10.00,100.00,5.00,0.00,95.00",
        "2026-03-02,KITS,Lunch,M1,Tomato Soup,10,10.00,100.00,5.00,0.00,95.00",
        '02-Mar-2026,"Metrotown ",Lunch,M1,TOMATO SOUP ,20,10.00,200.00,0.00,0.00,',
        "2026-03-03,Kitsilano,Dinner,M1,Tomato Soup,5,10.00,50.00,0.00,0.00,50.00",
    ],
    "pos_covers_hourly": ["2026-03-02,Kits,12,9,95.00", "2026-03-02,METROTOWN,12,15,200.00", "2026-03-03,KITS,18,4,50.00"],
    "timeclock": [
        "S1,2026-03-02,KITS,E1,LINE COOK,2026-03-02 07:00,2026-03-02 15:00,2026-03-02 07:00,2026-03-02 09:00",
        "S1,2026-03-02,KITS,E1,LINE COOK,2026-03-02 07:00,2026-03-02 15:00,2026-03-02 07:00,2026-03-02 09:00",
        "S2,2026-03-02,Metrotown,E2,Cook - Line,2026-03-02 11:00,2026-03-02 13:00,2026-03-02 11:00,",
    ],
    "purchasing": [
        'P1,2026-03-02,KITS,"FRESH ""N"" CO",I1,Tomato,10,kg,4.000,40.00',
        "P2,2026-03-03,Metrotown,Fresh \"N\" Co,I1,Tomato,22.0462,lb,2.000,44.09",
    ],
    "inventory_counts": ["2026-03-01,KITS,I1,10,kg", "2026-03-08,KITS,I1,16,kg", "2026-03-01,Metrotown,I1,5,kg", "2026-03-08,Metrotown,I1,9,kg"],
    "waste_log": ["2026-03-04,KITS,I1,0.5,kg,Spoilage"],
    "ref_locations": ["L02,Kitsilano,Vancouver,49.2,-123.1,80,1,2010-05-01,North,A", "L03,Metrotown,Burnaby,49.2,-123.0,many,0,2012-05-01,Mid,B"],
    "ref_menu": ["M1,Tomato Soup,Soup,10.00,1,10.40,2026-01-05"],
    "ref_ingredients": ['I1,Tomato,Produce,kg,3.0000,0.05,1,3.5000,"Fresh ""N"" Co"'],
    "ref_recipes": ["M1,I1,0.2,kg"],
    "ref_employees": ["E1,Ann,L02,Line Cook,20.00,2024-01-01", "E2,Bob,L03,Line Cook,18.00,2024-01-01"],
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("landing")
    for name, lines in CSV.items():
        file = name if name.startswith("ref_") else f"{name}_extract"
        body = ",".join(EXTRACTS[name]) + "\n" + "\n".join(lines) + "\n"
        if name == "waste_log":
            (path / f"{file}.csv.gz").write_bytes(gzip.compress(body.encode()))
        else:
            (path / f"{file}.csv").write_text(body)
    return str(path)


@pytest.fixture(scope="module")
def warehouse(spark, folder, tmp_path_factory):
    raw = landing.land_all(spark, folder, datetime(2026, 3, 9))
    out = tmp_path_factory.mktemp("core")
    w = published_warehouse(spark, raw, Rules(menu_from="2026-01-01", menu_to="2026-12-31"), keep_in(str(out)))
    w.build_all()
    return w


def test_landing_keeps_text_as_it_is(spark, folder):
    rows = landing.land_extract(spark, folder, "pos_sales").collect()
    assert len(rows) == 4
    messy = next(r for r in rows if r.business_date == "02-Mar-2026")
    assert (messy.store, messy.menu_item_name, messy.net_sales) == ("Metrotown ", "TOMATO SOUP ", None)
    assert messy._source_file == "pos_sales_extract.csv" and len({r._loaded_at for r in rows}) == 1
    supplier = {r.supplier for r in landing.land_extract(spark, folder, "purchasing").collect()}
    assert 'FRESH "N" CO' in supplier
    assert landing.land_extract(spark, folder, "waste_log").count() == 1


def test_landing_files_and_manifest(spark, folder):
    files = landing.list_landing_files(spark, folder)
    assert files.count() == 11 and files.filter("size_bytes <= 0").count() == 0
    tables = {n: landing.land_extract(spark, folder, n) for n in ("pos_sales", "ref_menu", "timeclock")}
    check = landing.manifest_check(tables, [("POS_SALES", 4), ("REF_MENU", 2), ("WASTE_LOG", 3)]).collect()
    assert [(r.table_name, r.loaded_rows, r.expected_rows, r.status) for r in check] == [
        ("pos_sales", 4, 4, "OK"),
        ("ref_menu", 1, 2, "CHECK UPLOAD"),
        ("timeclock", 3, None, "CHECK UPLOAD"),
        ("waste_log", None, 3, "CHECK UPLOAD"),
    ]
    published = landing.manifest_check(tables).collect()
    assert len(published) == 11 and {r.status for r in published} == {"CHECK UPLOAD"}
    assert {r.table_name: r.expected_rows for r in published}["pos_sales"] == 554747


def test_landing_reads_subfolders_and_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "2026" / "march").mkdir(parents=True)
    lines = "h," * 10 + 'h\n2026-03-02,KITS,Lunch,M1,"Tomato\nSoup",1,1.00,1.00,0.00,0.00,1.00\n'
    (tmp_path / "2026" / "march" / "pos_sales_extract_1.csv").write_text(lines)
    (row,) = landing.land_extract(spark, str(tmp_path), "pos_sales").collect()
    assert row.menu_item_name == "Tomato\nSoup" and row._source_file == "pos_sales_extract_1.csv"


def test_warehouse_rows(warehouse):
    counts = {r.table_name: r.row_count for r in landing.row_counts(warehouse.tables()).collect()}
    assert counts == {
        "dim_date": 603,
        "dim_location": 2,
        "dim_menu_item": 1,
        "dim_ingredient": 1,
        "dim_employee": 2,
        "bridge_recipe": 1,
        "fact_sales_item_daypart": 3,
        "fact_covers_hourly": 3,
        "fact_labour_shifts": 2,
        "fact_labour_hourly": 6,
        "fact_purchases": 2,
        "fact_inventory_counts": 4,
        "fact_waste_log": 1,
        "fact_ingredient_usage_weekly": 2,
        "menu_engineering": 1,
    }


def test_calendar(warehouse):
    days = warehouse.dim_date
    assert days.agg(F.sum("is_stat_holiday")).first()[0] == 16
    first = days.filter("calendar_date = date'2025-01-05'").first()
    assert (first.week_start, first.dow_num, first.day_of_week, first.is_weekend, first.quarter, first.season) == (
        date(2024, 12, 30), 7, "Sun", 1, "Q1", "Winter",
    )
    assert days.filter("holiday_name = 'B.C. Day'").count() == 2


def test_purchases_and_dimensions(warehouse):
    lines = {r.po_line_id: r for r in warehouse.fact_purchases.collect()}
    assert lines["P1"].supplier == lines["P2"].supplier == 'Fresh "N" Co'
    assert (lines["P2"].qty_received, lines["P2"].unit, lines["P2"].unit_cost, lines["P2"].is_unit_converted) == (D("10.000"), "kg", D("4.409"), 1)
    item = warehouse.dim_menu_item.first()
    assert (item.std_food_cost_2025, item.contribution_margin_2026, item.food_cost_pct_2025) == (D("0.600"), D("9.70"), D("0.0600"))
    assert {r.seats for r in warehouse.dim_location.collect()} == {80, None}


def test_quality_log(warehouse, tmp_path):
    counts = quality.quality_counts(warehouse.raw, warehouse.tables(), warehouse.store_alias, warehouse.role_alias)
    log = str(tmp_path / "log")
    append_log(quality.quality_run(counts.withColumn("issue_count", F.lit(7)), datetime(2026, 1, 1)), log)
    rows = quality.latest_run(append_log(quality.quality_run(counts, datetime(2026, 2, 1)), log)).collect()
    assert [r.check_id for r in rows] == list(range(1, 25))
    got = {r.check_id: r.issue_count for r in rows if r.issue_count}
    # 9, by extract: sales KITS x2 and "Metrotown ", covers 3, clock 2, purchases 1, counts 2, waste 1.
    assert got == {1: 1, 2: 1, 3: 1, 9: 3 + 3 + 2 + 1 + 2 + 1, 11: 1, 12: 3, 13: 1, 19: 1}
    assert {r.status for r in rows if r.check_id in (1, 2, 3, 9, 11, 12, 13, 18, 19)} == {"FIXED"}
    assert {r.status for r in rows if r.check_id not in (1, 2, 3, 9, 11, 12, 13, 18, 19)} == {"PASS"}


def test_reconciliation(warehouse):
    (r,) = quality.reconcile_monthly(warehouse.raw["pos_sales"], warehouse.fact_sales_item_daypart).collect()
    assert (r.year_month, r.raw_net_sales, r.core_net_sales, r.difference) == ("2026-03", D("240.00"), D("345.00"), D("105.00"))


def test_kpi_rows_prompts_and_notes(spark, warehouse):
    stores = kpi.store_kpi(
        warehouse.dim_location,
        warehouse.fact_labour_hourly,
        warehouse.fact_sales_item_daypart,
        warehouse.fact_ingredient_usage_weekly,
        warehouse.dim_ingredient,
    )
    by_id = {r.location_id: r for r in stores.collect()}
    # L02 on Monday: two hours at 20.50 over 95.00; Tuesday has sales but no labour.
    assert by_id["L02"].worst_day == "Mon" and by_id["L02"].worst_day_labour_pct == pytest.approx(41 / 95)
    assert by_id["L02"].labour_pct == pytest.approx(41 / 145)
    assert by_id["L03"].leak_over_pct == pytest.approx((5 + 10 - 9) / 4 - 1)
    rows = {r.location_id: r for r in kpi.kpi_input(stores).collect()}
    assert rows["L02"].headline == "Labour: Mon schedule" and rows["L03"].headline == "Food: Tomato usage"
    assert rows["L02"].kpi_summary.startswith("Labour 28.3% (target 30.0%, chain 22.6%). Worst day: Mon at 43.2%. Food cost ")
    assert rows["ALL"].kpi_summary.startswith("Chain labour 22.6% (target 30.0%).")
    assert "Worst store-day for labour: Kitsilano on Mon at 43.2%." in rows["ALL"].kpi_summary
    texts = kpi.prompts(kpi.kpi_input(stores), "Test Grill", "2026 year to date")
    prompt = {r.location_id: r.prompt for r in texts.collect()}
    assert "the general manager of Kitsilano of Test Grill" in prompt["L02"] and "the VP of Operations" in prompt["ALL"]
    assert prompt["L02"].split("\n")[0].endswith("on 2026 year to date, using only these figures:")
    assert prompt["L02"].split("\n")[1].startswith("Labour 28.3%")
    notes = spark.createDataFrame([("L02", "Note A"), ("ALL", "Note B")], "location_id string, recommendation_text string")
    done = kpi.recommendations(texts, notes, "by hand", datetime(2026, 3, 9))
    assert [(r.location_name, r.recommendation_text) for r in kpi.recommendation_list(done).collect()] == [
        ("All locations", "Note B"),
        ("Kitsilano", "Note A"),
    ]
    assert done.first().model == "by hand"


def test_export_round_trip(spark, warehouse, tmp_path):
    path = str(tmp_path / "export")
    export_csv(warehouse.dim_employee, path)
    back = read_export(spark, path, "employee_id string, employee_name string, home_location_id string, role string, wage decimal(8,2), hire_date date")
    assert sorted(back.collect()) == sorted(warehouse.dim_employee.collect())


def test_month_layout_reads_back_the_same_columns(spark, tmp_path):
    df = spark.createDataFrame([(date(2025, 1, 1), 1), (date(2025, 2, 1), 2), (None, 3)], "d date, v int")
    back = write_table(df, str(tmp_path / "t"), month_of="d")
    assert back.columns == ["d", "v"] and sorted(r.v for r in back.collect()) == [1, 2, 3]
    assert os.path.exists(os.path.join(live_path(spark, str(tmp_path / "t")), "year_month=2025-01"))


def test_only_the_months_asked_for_are_opened(spark, tmp_path):
    df = spark.createDataFrame([(date(2025, m, d), m) for m in range(1, 7) for d in (1, 20)], "d date, v int")
    write_table(df, str(tmp_path / "t"), month_of="d")
    out = read_days(spark, str(tmp_path / "t"), "d", "2025-02-10", "2025-03-10")
    assert sorted((r.d, r.v) for r in out.collect()) == [(date(2025, 2, 20), 2), (date(2025, 3, 1), 3)]
    assert out.columns == ["d", "v"] and len(out.inputFiles()) > 0
    assert "PartitionFilters: [isnotnull(year_month" in out._jdf.queryExecution().executedPlan().toString()


def test_refresh_writes_everything_and_keeps_the_log(spark, folder, tmp_path):
    notes = literal_rows(spark, [("L02", "It's fine"), ("ALL", "B")], "location_id", "recommendation_text")
    for day in (9, 10):
        tables = refresh(spark, folder, str(tmp_path / "core"), notes=notes, model="by hand", run_at=datetime(2026, 3, day))
    log = quality.latest_run(tables["dq_results"])
    assert tables["dq_results"].count() == 48 and log.count() == 24
    assert tables["fact_sales_item_daypart"].count() == 3
    assert {r.location_id: r.recommendation_text for r in tables["ai_recommendations"].collect()} == {"L02": "It's fine", "ALL": "B"}
    assert tables["ai_kpi_input"].count() == 3
    assert tables["dq_latest"].count() == 24 and tables["load_manifest"].count() == 11
    assert {r.table_name: r.row_count for r in tables["row_counts"].collect()}["fact_sales_item_daypart"] == 3
    assert [r.year_month for r in tables["reconciliation"].collect()] == ["2026-03"]
    raw = {name: read_table(spark, f"{tmp_path}/core/raw_{name}") for name in quality.STORE_EXTRACTS}
    for name, profile in quality.profiles(raw, tables).items():
        assert profile._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1, name


def test_literal_rows_have_a_known_small_size(spark):
    df = literal_rows(spark, [(1, "a'b"), (2, "c\\d")], "n", "t")
    assert [(r.n, r.t) for r in df.orderBy("n").collect()] == [(1, "a'b"), (2, "c\\d")]
    big = spark.range(10_000_000).withColumnRenamed("id", "n")
    assert "BroadcastHashJoin" in big.join(df, "n")._jdf.queryExecution().executedPlan().toString()


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


def test_a_missing_shared_folder_is_an_error():
    session = type("S", (), {"conf": Conf()})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_a_table_is_staged_once_per_session(spark):
    frame = spark.range(5).withColumn("x", F.rand())
    first, second = stage(frame, "test:once"), stage(frame, "test:once")
    assert sorted(first.collect()) == sorted(second.collect())
    assert staged_path(spark, "test:once").startswith(shared_folder(spark))
    assert spark.sparkContext.applicationId in shared_folder(spark)


def test_reading_days_opens_only_their_months(spark, tmp_path):
    days = spark.sql("SELECT explode(sequence(date'2025-01-01', date'2025-12-31')) AS d")
    write_table(days, str(tmp_path / "t"), "d")
    some = read_days(spark, str(tmp_path / "t"), "d", "2025-03-05", "2025-04-02")
    assert some.count() == 29
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    assert len(some.inputFiles()) == 2 or "2025-03" in plan
    assert read_days(spark, str(tmp_path / "t"), "d", "2025-12-30", None).count() == 2


def test_a_write_that_fails_midway_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    first = write_table(spark.range(5), path)
    broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        write_table(broken.repartition(4), path)
    assert sorted(r.id for r in read_table(spark, path).collect()) == [0, 1, 2, 3, 4]
    second = write_table(first.select((F.col("id") + 10).alias("id")), path)  # a table may be made from itself
    assert [sorted(r.id for r in x.collect()) for x in (first, second, read_table(spark, path))] == [[0, 1, 2, 3, 4], *[[10, 11, 12, 13, 14]] * 2]
    write_table(spark.range(2), path)
    assert read_table(spark, path).count() == 2 and second.count() == 5
    assert sum(name.startswith("data-") for name in os.listdir(path)) <= 3  # two versions, and what the failed write left


def test_a_run_that_is_repeated_is_in_the_log_once(spark, tmp_path):
    path, day = str(tmp_path / "log"), datetime(2026, 1, 1)
    for run_at, n in ((day, 24), (datetime(2026, 2, 1), 24), (day, 24)):
        log = append_log(spark.range(n).select(F.lit(run_at).alias("run_at"), "id"), path)
    assert log.count() == 48 and log.columns == ["run_at", "id"]
    latest = read_latest(spark, path)
    assert {r.run_at for r in latest.select("run_at").collect()} == {datetime(2026, 2, 1)} and latest.count() == 24
    assert all("run=20260201" in f for f in latest.inputFiles())
