"""The eleven extracts derived from the benchmark tables, defects included.

The benchmark tables are clean, so the defects come from fixed arithmetic on their keys: the same
rows are messy on every run and at every scale. All columns are text, as on landing.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeops.functions.columns import half_up
from storeops.operators.calendar import holiday_table
from storeops.plans.warehouse import Rules, Warehouse, keep_lazy
from storeops.sources.tables import literal_rows

# The benchmark orders run from 1995 to 2001 and the events through January 2024.
BENCH_RULES = Rules(
    raise_date="2024-01-16",
    new_cost_year=1998,
    menu_from="1999-01-01",
    menu_to="1999-12-31",
)

BENCH_HOLIDAYS = [
    (f"{year}-{day}", name)
    for year in range(1990, 2031)
    for day, name in (("01-01", "New Year's Day"), ("07-01", "Canada Day"), ("12-25", "Christmas Day"))
]


# The event types, as roles.
ROLES = ["View", "Click", "Error", "Signup", "Purchase"]


def text(col: Column) -> Column:
    return col.cast("string")


def money(col: Column) -> Column:
    return col.cast("decimal(12,2)")


def day_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def minute_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm")


def messy_store(name: Column, key: Column, k: Column) -> Column:
    """The store name as different tills write it; about one row in 2,000 names no known store."""
    return (
        F.when(k % 1999 == 0, "UNKNOWN")
        .when(k % 12 == 0, F.concat(F.lit("  "), F.lower(name)))
        .when(k % 12 == 1, F.concat(F.lit("N-"), text(key)))
        .when(k % 12 == 2, F.concat(F.lit("Store "), text(key), F.lit(" ")))
        .when(k % 12 == 3, F.concat(name, F.lit(" ")))
        .otherwise(name)
    )


def brand_number(brand: Column) -> Column:
    return F.substring_index(brand, "#", -1).cast("int")


def next_brand(brand: Column) -> Column:
    return F.concat(F.lit("Brand#"), text(brand_number(brand) % 25 + 1))


def repeat_row(condition: Column) -> Column:
    """Copy number 1, and a second copy where the condition holds."""
    return F.explode(F.sequence(F.lit(1), F.when(condition, 2).otherwise(1)))


# Declared, so that opening a table starts no job to look the columns up.
BENCH_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Extracts(Mapping):
    """Extract name -> frame; each is built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        return getattr(self, name)

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read.schema(BENCH_SCHEMAS[name])
            self._tables[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def store_alias(self) -> DataFrame:
        """Three spellings per store, but only the full name for store 24."""
        key = text(F.col("n_nationkey"))
        spellings = F.when(F.col("n_nationkey") == 24, F.array(F.upper("n_name"))).otherwise(
            F.array(F.upper("n_name"), F.concat(F.lit("N-"), key), F.concat(F.lit("STORE "), key))
        )
        return self.table("nation").select(
            F.explode(spellings).alias("alias_key"), F.concat(F.lit("L"), key).alias("location_id")
        )

    @cached_property
    def role_alias(self) -> DataFrame:
        """Each event type is a role, written plainly or with a prefix."""
        rows = [(prefix + role.upper(), role) for role in ROLES for prefix in ("", "T-")]
        return literal_rows(self.spark, rows, "alias_key", "role")

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_name").alias("supplier"))

    @cached_property
    def _sold(self) -> DataFrame:
        """Order lines with day and store.

        Lines and orders both grow with the data, so neither is ever broadcast: the merge hint has
        them shuffled by order, with adaptive splitting of skewed orders. Days go through the shuffles as
        dates, and the stores' names are added behind them.
        """
        orders = (
            self.table("orders")
            .select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
            .join(self.table("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "o_orderpriority", "day", "c_nationkey")
        )
        return (
            self._lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .withColumn("k", F.col("l_orderkey") * 7 + F.col("l_linenumber"))
        )

    @cached_property
    def _lines(self) -> DataFrame:
        return self.table("lineitem").withColumn("ship_day", F.col("l_shipdate").cast("date"))

    @cached_property
    def _delivered(self) -> DataFrame:
        """Order lines with supplier, store and ingredient.

        The lookups are joined one by one: each is then weighed by the size of its own files, while
        a join of lookups would be estimated as larger than the lines. The parts, the largest of them, come
        first: where they are too many to broadcast, the lines are shuffled before they carry any names.
        """
        return (
            self._lines.join(self.table("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .withColumn("k", F.col("l_orderkey") * 7 + F.col("l_linenumber"))
            .withColumnRenamed("ship_day", "day")
        )

    @cached_property
    def pos_sales(self) -> DataFrame:
        k = F.col("k")
        gross = money(F.col("l_extendedprice"))
        discounts = F.round(gross * F.col("l_discount").cast("decimal(4,2)"), 2)
        comps = F.round(gross * F.col("l_tax").cast("decimal(4,2)"), 2)
        net = gross - discounts - comps + F.when(k % 1777 == 0, 1).otherwise(0)
        item = F.concat(F.lit("Item "), text(F.col("l_partkey")))
        rows = self._sold.select(
            F.when(k % 997 == 0, "bad")
            .when(k % 20 == 0, F.date_format("day", "dd-MMM-yyyy"))
            .otherwise(day_text(F.col("day")))
            .alias("business_date"),
            messy_store(F.col("n_name"), F.col("n_nationkey"), k).alias("store"),
            F.col("o_orderpriority").alias("daypart"),
            text(F.col("l_partkey")).alias("menu_item_id"),
            F.when(k % 2003 == 0, "Special")
            .when(k % 33 == 0, F.concat(F.upper(item), F.lit(" ")))
            .otherwise(item)
            .alias("menu_item_name"),
            F.when(k % 1501 == 0, "n/a").otherwise(text(F.col("l_quantity").cast("decimal(12,1)"))).alias("qty_sold"),
            text(half_up(F.col("l_extendedprice") / F.col("l_quantity"), 2)).alias("unit_price"),
            text(gross).alias("gross_sales"),
            text(discounts).alias("discounts"),
            text(comps).alias("comps"),
            F.when(k % 500 != 0, text(net.cast("decimal(12,2)"))).alias("net_sales"),
            F.lit("pos_sales_extract.csv").alias("_source_file"),
            F.date_add("ship_day", 1).cast("timestamp_ntz").alias("_loaded_at"),
            repeat_row(F.col("l_orderkey") % 250 == 0).alias("_copy"),
        )
        return rows.drop("_copy")

    @cached_property
    def pos_covers_hourly(self) -> DataFrame:
        """Events as guests; some hours are sent again a day later with one guest more."""
        hours = (
            self.table("events")
            .groupBy(
                F.col("ts").cast("date").alias("day"),
                (F.col("user_id") % 25).alias("store_key"),
                F.hour("ts").alias("hour"),
            )
            .agg(F.count("*").alias("guests"), F.sum(money(F.col("value"))).alias("net"))
            .join(self.table("nation"), F.col("store_key") == F.col("n_nationkey"))
            .withColumn("k", F.col("hour") + F.col("store_key") + F.unix_date("day"))
            .withColumn("copy", repeat_row((F.col("hour") * 25 + F.col("store_key")) % 97 == 0))
        )
        return hours.select(
            F.when(F.col("k") % 30 == 7, F.date_format("day", "dd-MMM-yyyy"))
            .otherwise(day_text(F.col("day")))
            .alias("business_date"),
            messy_store(F.col("n_name"), F.col("store_key"), F.col("k")).alias("store"),
            text(F.col("hour")).alias("hour_of_day"),
            text(F.col("guests") + F.col("copy") - 1).alias("covers"),
            text(F.col("net").cast("decimal(12,2)")).alias("net_sales"),
            F.lit("pos_covers_hourly_extract.csv").alias("_source_file"),
            F.date_add("day", F.col("copy")).cast("timestamp_ntz").alias("_loaded_at"),
        )

    @cached_property
    def timeclock(self) -> DataFrame:
        """Events as shifts of eight hours that start in the hour of the event."""
        k, ts = F.col("event_id"), F.col("ts")
        start = F.date_trunc("hour", ts).cast("timestamp_ntz")
        end = start + F.expr("interval 8 hours")
        overrun = F.make_dt_interval(mins=(k % 41 - 20).cast("int"))
        nation = self.table("nation").select("n_nationkey", "n_name")
        shifts = self.table("events").join(nation, F.col("user_id") % 25 == F.col("n_nationkey"))
        role = F.col("event_type")
        return shifts.select(
            text(k).alias("shift_id"),
            day_text(ts).alias("business_date"),
            messy_store(F.col("n_name"), F.col("n_nationkey"), k).alias("store"),
            F.concat(F.lit("E"), text(F.col("user_id"))).alias("employee_id"),
            F.when(k % 701 == 0, "temp")
            .when(k % 10 == 0, F.upper(role))
            .when(k % 10 == 1, F.concat(F.lit("T-"), role))
            .when(k % 10 == 2, F.concat(F.lit(" "), role, F.lit(" ")))
            .otherwise(F.initcap(role))
            .alias("role"),
            minute_text(start).alias("scheduled_start"),
            minute_text(end).alias("scheduled_end"),
            minute_text(ts).alias("actual_start"),
            F.when(k % 777 == 0, minute_text(ts))
            .when(k % 200 != 0, minute_text(end + overrun))
            .alias("actual_end"),
            F.lit("timeclock_extract.csv").alias("_source_file"),
            F.date_add(ts.cast("date"), 1).cast("timestamp_ntz").alias("_loaded_at"),
            repeat_row(k % 300 == 0).alias("_copy"),
        ).drop("_copy")

    @cached_property
    def purchasing(self) -> DataFrame:
        k = F.col("k")
        line = F.concat_ws(
            "-",
            *[text(F.col(c)) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
            day_text(F.col("day")),
        )
        return self._delivered.select(
            line.alias("po_line_id"),
            day_text(F.col("day")).alias("delivery_date"),
            messy_store(F.col("n_name"), F.col("n_nationkey"), k).alias("store"),
            F.when(k % 1993 == 0, "Nobody")
            .when(k % 17 == 0, F.upper("s_name"))
            .otherwise(F.col("s_name"))
            .alias("supplier"),
            F.col("p_brand").alias("ingredient_id"),
            F.concat(F.lit("Ingredient "), text(brand_number(F.col("p_brand")))).alias("ingredient_name"),
            text(F.col("l_quantity").cast("decimal(12,3)")).alias("qty_received"),
            F.when(k % 25 == 0, "lb").otherwise("kg").alias("unit"),
            text(half_up(F.col("l_extendedprice") / F.col("l_quantity"), 3)).alias("unit_cost"),
            text(money(F.col("l_extendedprice"))).alias("line_total"),
            F.lit("purchasing_extract.csv").alias("_source_file"),
            F.date_add("day", 1).cast("timestamp_ntz").alias("_loaded_at"),
            repeat_row(F.col("l_orderkey") % 250 == 0).alias("_copy"),
        ).drop("_copy")

    @cached_property
    def inventory_counts(self) -> DataFrame:
        """Sunday counts of all 25 ingredients, before and after every week in which a store sold."""
        week = F.trunc(F.col("o_orderdate").cast("date"), "week")
        sundays = (
            self.table("orders")
            .join(self.table("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .select(week.alias("week"), "c_nationkey")
            .distinct()
            .withColumn("count_date", F.explode(F.array(F.date_sub("week", 1), F.date_add("week", 6))))
            .select("count_date", "c_nationkey")
            .distinct()
        )
        brands = F.transform(F.sequence(F.lit(1), F.lit(25)), lambda n: F.concat(F.lit("Brand#"), n.cast("string")))
        cells = (
            sundays.join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .withColumn("ingredient", F.explode(brands))
        )
        day, store, brand = F.unix_date("count_date"), F.col("n_nationkey"), brand_number(F.col("ingredient"))
        return cells.filter((day * 17 + store * 11 + brand * 3) % 1000 != 0).select(
            day_text(F.col("count_date")).alias("count_date"),
            messy_store(F.col("n_name"), store, day + store + brand).alias("store"),
            F.col("ingredient").alias("ingredient_id"),
            F.when((day * 13 + store * 5 + brand) % 2500 == 0, "-1.0")
            .otherwise(F.concat(text((day * 31 + store * 7 + brand * 13) % 5000), F.lit(".5")))
            .alias("qty_on_hand"),
            F.lit("kg").alias("unit"),
            F.lit("inventory_counts_extract.csv").alias("_source_file"),
            F.date_add("count_date", 1).cast("timestamp_ntz").alias("_loaded_at"),
        )

    @cached_property
    def waste_log(self) -> DataFrame:
        k = F.col("k")
        return self._delivered.filter("l_returnflag = 'R'").select(
            day_text(F.col("day")).alias("waste_date"),
            messy_store(F.col("n_name"), F.col("n_nationkey"), k).alias("store"),
            F.col("p_brand").alias("ingredient_id"),
            text((F.col("l_quantity").cast("decimal(8,2)") * F.lit("0.05").cast("decimal(4,2)")).cast("decimal(12,3)")).alias(
                "qty_wasted"
            ),
            F.lit("kg").alias("unit"),
            F.when(F.col("l_linestatus") == "F", "Spoilage").otherwise("Prep trim").alias("reason"),
            F.lit("waste_log_extract.csv").alias("_source_file"),
            F.date_add("day", 1).cast("timestamp_ntz").alias("_loaded_at"),
        )

    @cached_property
    def ref_locations(self) -> DataFrame:
        key = F.col("n_nationkey")
        nation = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        two_digits = F.lpad(text(key), 2, "0")
        return nation.select(
            F.concat(F.lit("L"), text(key)).alias("location_id"),
            F.col("n_name").alias("location_name"),
            F.concat(F.lit("City "), text(key)).alias("city"),
            F.concat(F.lit("49."), two_digits).alias("latitude"),
            F.concat(F.lit("-123."), two_digits).alias("longitude"),
            F.when(key == 13, "many").otherwise(text(key + 100)).alias("seats"),
            text(key % 2).alias("has_patio"),
            F.concat(F.lit("19"), text(key + 60), F.lit("-03-01")).alias("open_date"),
            F.col("r_name").alias("region"),
            F.concat(F.lit("Manager "), text(F.col("r_regionkey"))).alias("area_manager"),
        )

    @cached_property
    def ref_menu(self) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(10,2)")
        return self.table("part").select(
            text(F.col("p_partkey")).alias("menu_item_id"),
            F.concat(F.lit("Item "), text(F.col("p_partkey"))).alias("menu_item_name"),
            F.col("p_type").alias("category"),
            text(price).alias("price_2025"),
            text((F.col("p_size") <= 25).cast("int")).alias("is_main"),
            text(F.round(price * F.lit("1.04").cast("decimal(4,2)"), 2).cast("decimal(10,2)")).alias("price_2026"),
            F.lit("1998-01-05").alias("price_change_date"),
        )

    @cached_property
    def ref_ingredients(self) -> DataFrame:
        n = F.col("n")
        brands = self.table("part").select("p_brand").distinct().withColumn("n", brand_number(F.col("p_brand")))
        cost = n * F.lit("0.35").cast("decimal(4,2)") + 1
        return brands.select(
            F.col("p_brand").alias("ingredient_id"),
            F.concat(F.lit("Ingredient "), text(n)).alias("ingredient_name"),
            F.when(n % 5 == 0, "Produce").otherwise("Dry").alias("ingredient_category"),
            F.when(n == 25, "each").otherwise("kg").alias("unit"),
            text(cost.cast("decimal(12,4)")).alias("std_cost_2025"),
            F.concat(F.lit("0.0"), F.lpad(text(n), 2, "0")).alias("expected_waste_rate"),
            text((n % 5 == 0).cast("int")).alias("is_produce"),
            text((cost * F.lit("1.05").cast("decimal(4,2)")).cast("decimal(12,4)")).alias("std_cost_2026"),
            F.concat(F.lit("Supplier#"), F.lpad(text(n), 9, "0")).alias("supplier"),
        )

    @cached_property
    def ref_recipes(self) -> DataFrame:
        own = F.struct(
            F.col("p_brand").alias("id"), text((F.col("p_size") / F.lit(100)).cast("decimal(12,4)")).alias("qty")
        )
        other = F.struct(next_brand(F.col("p_brand")).alias("id"), F.lit("0.0500").alias("qty"))
        rows = self.table("part").select("p_partkey", F.explode(F.array(own, other)).alias("r"))
        return rows.select(
            text(F.col("p_partkey")).alias("menu_item_id"),
            F.col("r.id").alias("ingredient_id"),
            F.col("r.qty").alias("qty_per_item"),
            F.lit("kg").alias("unit"),
        )

    @cached_property
    def ref_employees(self) -> DataFrame:
        """Every user but one in fifty, who works without being in the master."""
        user = F.col("user_id")
        users = self.table("events").select("user_id").distinct().filter(user % 50 != 49)
        wage = (user % 13) * F.lit("0.25").cast("decimal(4,2)") + 18
        return users.select(
            F.concat(F.lit("E"), text(user)).alias("employee_id"),
            F.concat(F.lit("User "), text(user)).alias("employee_name"),
            F.concat(F.lit("L"), text(user % 25)).alias("home_location_id"),
            F.element_at(F.array(*[F.lit(r) for r in ROLES]), (user % 5 + 1).cast("int")).alias("role"),
            text(wage.cast("decimal(8,2)")).alias("hourly_wage"),
            day_text(F.date_add(F.lit("2023-12-01").cast("date"), (user % 60).cast("int"))).alias("hire_date"),
        )

    @cached_property
    def notes(self) -> DataFrame:
        """One written note per store and one for the chain."""
        stores = self.table("nation").select(
            F.concat(F.lit("L"), text(F.col("n_nationkey"))).alias("location_id"),
            F.concat(F.lit("Note for "), "n_name").alias("recommendation_text"),
        )
        chain = self.table("nation").agg(
            F.lit("ALL").alias("location_id"),
            F.concat(F.lit("Note for all "), text(F.count("*")), F.lit(" stores")).alias("recommendation_text"),
        )
        return stores.unionByName(chain)

    @cached_property
    def calendar_bounds(self) -> DataFrame:
        """First and last order day."""
        day = F.col("o_orderdate").cast("date")
        return self.table("orders").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))

    NAMES = (
        "pos_sales",
        "pos_covers_hourly",
        "timeclock",
        "purchasing",
        "inventory_counts",
        "waste_log",
        "ref_locations",
        "ref_menu",
        "ref_ingredients",
        "ref_recipes",
        "ref_employees",
    )

    def key(self, name: str) -> str:
        """The name of a table of these extracts among staged ones."""
        return f"{self.sf_dir}:{name}"

    def with_frames(self, frames: Mapping[str, DataFrame]) -> Extracts:
        """A copy in which some extracts are replaced."""
        other = Extracts(self.spark, self.sf_dir)
        other.__dict__.update({**self.__dict__, **frames})
        other.__dict__.pop("lazy_warehouse", None)
        return other

    @cached_property
    def lazy_warehouse(self) -> Warehouse:
        return self.warehouse()

    def warehouse(self, keep=keep_lazy) -> Warehouse:
        return BenchWarehouse(self, self.store_alias, self.role_alias, BENCH_RULES, keep, suppliers=self.suppliers)


class BenchWarehouse(Warehouse):
    """The calendar spans the orders and has the same three holidays every year."""

    raw: Extracts

    def calendar_bounds(self) -> DataFrame:
        return self.raw.calendar_bounds

    def holidays(self) -> DataFrame:
        return holiday_table(self.raw.spark, BENCH_HOLIDAYS)
