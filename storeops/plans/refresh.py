"""One full refresh: land the extracts, rebuild the star schema, log the checks, write KPI rows and notes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from storeops.operators import kpi, quality
from storeops.plans.warehouse import Rules, keep_in, published_warehouse
from storeops.fixed_values import EXPECTED_LOADS
from storeops.sources.landing import land_all, manifest_check, row_counts
from storeops.sources.tables import append_log, read_days, read_latest, write_table


def refresh(
    spark: SparkSession,
    landing_folder: str,
    core_folder: str,
    rules: Rules = Rules(),
    period: kpi.KpiPeriod = kpi.KpiPeriod(),
    chain: str = "the chain",
    period_label: str = "2026 year to date",
    notes: DataFrame | None = None,
    model: str = "",
    run_at: datetime | None = None,
    expected_loads: Sequence[tuple[str, int]] = tuple(EXPECTED_LOADS),
    multiline: bool | Mapping[str, bool] = True,
) -> dict[str, DataFrame]:
    """Rebuild every table below `core_folder`; safe to run again, the check log keeps its history.

    Each step writes its tables and the next reads them back: columns and files are pruned per
    reader, and joins know the real sizes. `notes` (location_id, recommendation_text) are attached
    to the prompts they answer. Beside the tables come the load manifest against `expected_loads`, the row
    counts, the monthly reconciliation and the latest check run. A table is replaced in one step, and a run that is
    repeated with the same `run_at` replaces its own rows of the check log. `multiline` is that of `land_all`.
    """
    core_folder = core_folder.rstrip("/")
    stamp = run_at or datetime.now()

    def keep_raw(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        name, df = item
        return name, write_table(df, f"{core_folder}/raw_{name}")

    with ThreadPoolExecutor(max_workers=4) as pool:
        raw = dict(pool.map(keep_raw, land_all(spark, landing_folder, stamp, multiline).items()))

    warehouse = published_warehouse(spark, raw, rules, keep_in(core_folder))
    core = warehouse.build_all()

    def keep_profile(name: str, df: DataFrame) -> DataFrame:
        return write_table(df, f"{core_folder}/profiles/{name}")

    counts = quality.quality_counts(raw, core, warehouse.store_alias, warehouse.role_alias, keep_profile)
    log = append_log(quality.quality_run(counts, stamp), f"{core_folder}/dq_results")

    def days(name: str, day: str, start: str, end: str | None) -> DataFrame:
        return read_days(spark, f"{core_folder}/{name}", day, start, end)

    stores = kpi.store_kpi(
        core["dim_location"],
        days("fact_labour_hourly", "business_date", *period.labour),
        days("fact_sales_item_daypart", "business_date", *period.sales),
        days("fact_ingredient_usage_weekly", "week_start", *kpi.usage_days(period)),
        core["dim_ingredient"],
        period,
    )
    stores = write_table(stores, f"{core_folder}/store_kpi")
    kpis = write_table(kpi.kpi_input(stores, period), f"{core_folder}/ai_kpi_input")
    prompts = kpi.prompts(kpis, chain, period_label)
    tables = {**core, "dq_results": log, "store_kpi": stores, "ai_kpi_input": kpis, "prompts": prompts}
    tables["load_manifest"] = write_table(manifest_check(raw, expected_loads), f"{core_folder}/load_manifest")
    tables["row_counts"] = write_table(row_counts(core), f"{core_folder}/row_counts")
    months = quality.reconcile_monthly(raw["pos_sales"], core["fact_sales_item_daypart"])
    tables["reconciliation"] = write_table(months, f"{core_folder}/reconciliation")
    tables["dq_latest"] = quality.latest_run(read_latest(spark, f"{core_folder}/dq_results"))
    if notes is not None:
        written = kpi.recommendations(prompts, notes, model, stamp)
        tables["ai_recommendations"] = write_table(written, f"{core_folder}/ai_recommendations")
    return tables
