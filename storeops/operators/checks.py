"""Generic table checks. Each returns rows (check_name, passed, detail); passed is 1 or 0.

Checks that group or look up count their rows per key before anything is shuffled or joined, so one
very frequent key costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeops.functions.columns import flag, half_up, monday_of, ratio, zero_if_null
from storeops.functions.text import sentence
from storeops.operators.foodcost import WEEK_GRAIN, count_as, exact, theoretical_usage, weekly_purchases


def verdict(df: DataFrame, name: str, passed: Column, detail: Column | str = "") -> DataFrame:
    """One check row from a one-row frame; an unknown outcome does not pass."""
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return df.select(
        F.lit(name).alias("check_name"),
        F.coalesce(passed.cast("int"), F.lit(0)).alias("passed"),
        F.coalesce(detail.cast("string"), F.lit("")).alias("detail"),
    )


def number_text(col: Column, digits: int) -> Column:
    return half_up(col, digits).cast(f"decimal(30,{digits})").cast("string")


def stacked(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def report(checks: Sequence[DataFrame]) -> DataFrame:
    """All check rows, failures first."""
    return stacked(checks).orderBy("passed", "check_name")


def close(a: Column, b: Column, atol: float, rtol: float = 1e-5) -> Column:
    """Equal within atol + rtol x |b|; a missing value is not close."""
    a, b = a.cast("double"), b.cast("double")
    return F.coalesce(F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b), F.lit(False))


def row_rules(df: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """Any number of row conditions in one pass; a check passes when no row violates it."""
    names = list(violations)
    totals = df.agg(*[F.sum(flag(violations[n])).alias(f"v{i}") for i, n in enumerate(names)])
    pairs = [
        F.struct(F.lit(n).alias("check_name"), zero_if_null(F.col(f"v{i}")).alias("n")) for i, n in enumerate(names)
    ]
    return totals.select(F.explode(F.array(*pairs)).alias("c")).select(
        "c.check_name",
        flag(F.col("c.n") == 0).alias("passed"),
        sentence("({n} rows)", n=F.col("c.n")).alias("detail"),
    )


def perhaps_equal(df: DataFrame, cols: Sequence[str], hold: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that may equal another one in the columns: those whose digest occurs more than once.

    Equal rows have equal digests, so none is lost; the few others that come along have to be told apart by the
    columns themselves. Only digests are shuffled, however wide the rows. `hold` writes the repeated ones: few of
    them are broadcast, and where most rows have copies both sides are shuffled once more.
    """
    digest = F.xxhash64(*cols).alias("_digest")
    often = hold(df.groupBy(digest).agg(F.count("*").alias("n")).filter("n > 1").select("_digest"))
    return df.select(*cols, digest).join(often, "_digest", "left_semi").drop("_digest")


def unique_key(
    name: str, df: DataFrame, keys: Sequence[str], hold: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """No key occurs twice. With `hold`, keys are grouped only where their digests repeat."""
    if hold is not None:
        df = perhaps_equal(df, keys, hold)
    repeated = df.groupBy(*keys).count().filter("count > 1").agg(F.count("*").alias("n"))
    return verdict(repeated, name, F.col("n") == 0, sentence("({n} repeated keys)", n=F.col("n")))


def no_orphans(name: str, df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> DataFrame:
    """Every value exists in the reference table; a NULL counts as missing."""
    used = df.groupBy(F.col(col).alias("_key")).agg(F.count("*").alias("rows"))
    known = ref.select(F.col(ref_col).alias("_key")).distinct()
    missing = used.join(known, "_key", "left_anti").agg(zero_if_null(F.sum("rows")).alias("n"))
    return verdict(missing, name, F.col("n") == 0, sentence("({n} orphans)", n=F.col("n")))


def same_keys(name: str, left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    """Both tables hold the same set of keys."""
    a = left.select(F.col(col).alias("_key")).distinct().withColumn("in_left", F.lit(1))
    b = right.select(F.col(col).alias("_key")).distinct().withColumn("in_right", F.lit(1))
    one_sided = (
        a.join(b, "_key", "full")
        .filter(F.col("in_left").isNull() | F.col("in_right").isNull())
        .agg(F.count("*").alias("n"))
    )
    return verdict(one_sided, name, F.col("n") == 0, sentence("({n} on one side only)", n=F.col("n")))


def joined_agree(
    name: str, df: DataFrame, col: str, ref: DataFrame, ref_col: str, on: str, agree: Column | None = None
) -> DataFrame:
    """A column agrees with the master's for every row whose key is in the master.

    `agree` may compare `_mine` and `_master` in another way than equality.
    """
    mine = df.groupBy(F.col(on).alias("_key"), F.col(col).alias("_mine")).agg(F.count("*").alias("rows"))
    master = ref.select(F.col(on).alias("_key"), F.col(ref_col).alias("_master"))
    same = agree if agree is not None else F.col("_mine") == F.col("_master")
    wrong = (
        mine.join(master, "_key")
        .filter(~F.coalesce(same, F.lit(False)))
        .agg(zero_if_null(F.sum("rows")).alias("n"))
    )
    return verdict(wrong, name, F.col("n") == 0, sentence("({n} violations)", n=F.col("n")))


def price_by_date(name: str, sales: DataFrame, menu_item: DataFrame, change_date: str) -> DataFrame:
    """The unit price is the old or the new list price, by date of sale."""
    new = F.col("business_date") >= F.lit(change_date).cast("date")
    charged = sales.groupBy("menu_item_id", "unit_price", flag(new).alias("is_new")).agg(F.count("*").alias("rows"))
    listed = menu_item.select("menu_item_id", "price_2025", "price_2026")
    price = F.when(F.col("is_new") == 1, F.col("price_2026")).otherwise(F.col("price_2025"))
    wrong = (
        charged.join(listed, "menu_item_id")
        .filter(~close(F.col("unit_price"), price, 1e-8))
        .agg(zero_if_null(F.sum("rows")).alias("n"))
    )
    return verdict(wrong, name, F.col("n") == 0, sentence("({n} rows)", n=F.col("n")))


def reconciled(
    name: str, left: DataFrame, right: DataFrame, keys: Sequence[str], col: str, tolerance: str
) -> DataFrame:
    """Sums per key on both sides differ by less than the tolerance; a missing side counts as zero."""
    a = left.dropna(subset=list(keys)).groupBy(*keys).agg(F.sum(col).alias("a"))
    b = right.dropna(subset=list(keys)).groupBy(*keys).agg(F.sum(col).alias("b"))
    gap = F.abs(zero_if_null(F.col("a")) - zero_if_null(F.col("b")))
    widest = a.join(b, list(keys), "full").agg(zero_if_null(F.max(gap)).alias("gap"))
    limit = F.lit(tolerance).cast("decimal(12,4)")
    return verdict(widest, name, F.col("gap") < limit, sentence("max diff {gap}", gap=number_text(F.col("gap"), 2)))


def side_by_side(left: DataFrame, a: Column, right: DataFrame, b: Column) -> DataFrame:
    """Two global aggregates in one row (a, b), without joining the frames."""
    rows = left.agg(a.alias("a")).unionByName(right.agg(b.alias("b")), allowMissingColumns=True)
    return rows.agg(F.max("a").alias("a"), F.max("b").alias("b"))


def totals_close(name: str, left: DataFrame, a: Column, right: DataFrame, b: Column, rtol: float) -> DataFrame:
    """Two totals agree within a share of the second; 0 asks for equality."""
    both = side_by_side(left, a, right, b)
    gap = F.abs(F.col("a") - F.col("b"))
    passed = gap == 0 if rtol == 0 else ratio(gap, F.col("b")) < rtol
    return verdict(both, name, passed, sentence("{a} vs {b}", a=number_text(F.col("a"), 0), b=number_text(F.col("b"), 0)))


def ratio_in_band(
    name: str, left: DataFrame, a: Column, right: DataFrame, b: Column, low: float, high: float
) -> DataFrame:
    """The ratio of two totals lies between two bounds."""
    both = side_by_side(left, a, right, b).withColumn("r", ratio(F.col("a"), F.col("b")))
    return verdict(both, name, (F.col("r") > low) & (F.col("r") < high), sentence("({r})", r=number_text(F.col("r"), 3)))


def total_equals_count(name: str, df: DataFrame, other: DataFrame) -> DataFrame:
    return totals_close(name, df, F.count("*"), other, F.count("*"), 0)


def hired_before(name: str, shifts: DataFrame, employee: DataFrame) -> DataFrame:
    return joined_agree(
        name, shifts, "business_date", employee, "hire_date", "employee_id", F.col("_master") <= F.col("_mine")
    )


def largest_group(name: str, df: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """No group has more rows than allowed."""
    groups = df.groupBy(*keys).count().agg(F.sum(flag(F.col("count") > most)).alias("n"))
    return verdict(groups, name, F.col("n") == 0, sentence("({n} groups)", n=F.col("n")))


def smallest_group(name: str, df: DataFrame, keys: Sequence[str], least: int) -> DataFrame:
    """Every group has at least so many rows."""
    groups = df.groupBy(*keys).count().agg(F.min("count").alias("n"))
    return verdict(groups, name, F.col("n") >= least, sentence("(min {n})", n=F.col("n")))


def weekly_cap(name: str, shifts: DataFrame, cap: float) -> DataFrame:
    """Hours per employee and week stay under the cap; mean, 95th percentile and maximum are shown.

    The percentile is exact. It runs on how often each total occurs: totals have two decimals, so
    there are at most some 17,000 of them however many employees there are, and one more a week if shifts
    lack their employee.
    """
    weeks = shifts.groupBy("employee_id", monday_of(F.col("business_date")).alias("week")).agg(
        F.sum("actual_hours").alias("hours")
    )
    totals = weeks.groupBy("hours").agg(F.count("*").alias("n"))
    stats = totals.agg(
        ratio(F.sum(F.col("hours") * F.col("n")), F.sum("n")).alias("mean"),
        F.expr("percentile(cast(hours as double), 0.95, n)").alias("p95"),
        F.max("hours").alias("top"),
    )
    detail = sentence(
        "(mean {mean}, p95 {p95}, max {top})",
        **{k: number_text(F.col(k), 1) for k in ("mean", "p95", "top")},
    )
    return verdict(stats, name, F.col("top") <= cap, detail)


def at_least(name: str, df: DataFrame, col: str, floor: str) -> DataFrame:
    low = df.agg(F.min(col).alias("low"))
    return verdict(low, name, F.col("low") >= F.lit(floor).cast("decimal(12,4)"), sentence("(min {low})", low=F.col("low")))


def stock_identity(
    name: str, usage: DataFrame, counts: DataFrame, purchases: DataFrame, tolerance: float = 0.02
) -> DataFrame:
    """Stored actual usage is opening count + purchases - closing count; missing counts are reported."""
    opening = count_as(counts, "open", F.date_add("count_date", 1))
    closing = count_as(counts, "close", F.date_sub("count_date", 6))
    bought = weekly_purchases(purchases).select(*WEEK_GRAIN, F.col("purchased_qty").alias("bought"))
    derived = (
        usage.select(*WEEK_GRAIN, "actual_qty")
        .join(bought, WEEK_GRAIN, "left")
        .join(opening, WEEK_GRAIN, "left")
        .join(closing, WEEK_GRAIN, "left")
        .withColumn("gap", F.abs(F.col("open") + zero_if_null(F.col("bought")) - F.col("close") - F.col("actual_qty")))
    )
    worst = derived.agg(F.max("gap").alias("gap"), F.sum(flag(F.col("gap").isNull())).alias("missing"))
    detail = sentence("(max err {gap}, missing {missing})", gap=number_text(F.col("gap"), 4), missing=F.col("missing"))
    return verdict(worst, name, F.col("gap") < tolerance, detail)


def theoretical_again(name: str, usage: DataFrame, sales: DataFrame, recipe: DataFrame) -> DataFrame:
    """Stored theoretical usage equals sales x recipe, derived anew."""
    again = theoretical_usage(sales, recipe).withColumnRenamed("theoretical_qty", "again")
    stored = usage.select(*WEEK_GRAIN, "theoretical_qty").join(again, WEEK_GRAIN, "left")
    wrong = stored.agg(F.sum(flag(~close(F.col("again"), F.col("theoretical_qty"), 0.01))).alias("n"))
    return verdict(wrong, name, F.col("n") == 0, sentence("({n} rows)", n=F.col("n")))


def complete_grid(name: str, df: DataFrame, axis: str, members: DataFrame) -> DataFrame:
    """As many rows as distinct axis values times members."""
    per_value = df.groupBy(axis).agg(F.count("*").alias("rows"))
    both = side_by_side(
        per_value,
        F.struct(F.sum("rows").alias("rows"), F.count(axis).alias("values")),
        members,
        F.count("*"),
    )
    return verdict(
        both,
        name,
        F.col("a.rows") == F.col("a.values") * F.col("b"),
        sentence("({rows} rows, {values} x {members})", rows=F.col("a.rows"), values=F.col("a.values"), members=F.col("b")),
    )


def stands_out(name: str, groups: DataFrame, value: str, is_target: Column, margin: float) -> DataFrame:
    """The target group exceeds every other by the margin. `groups` has one row per group."""
    split = groups.agg(
        F.max(F.when(is_target, F.col(value))).alias("target"),
        F.max(F.when(~is_target, F.col(value))).alias("next"),
    )
    detail = sentence("({t}, next highest {n})", t=number_text(F.col("target"), 3), n=number_text(F.col("next"), 3))
    return verdict(split, name, F.col("target") > F.col("next") + margin, detail)


def ratio_near(name: str, df: DataFrame, a: str, b: str, expected: float, margin: float) -> DataFrame:
    """The ratio of two sums lies within a margin of the expected value."""
    one = df.agg(ratio(F.sum(a), F.sum(b)).alias("r"))
    return verdict(one, name, F.abs(F.col("r") - expected) < margin, sentence("({r})", r=number_text(F.col("r"), 3)))


def mean_rose(name: str, df: DataFrame, value: str, period: Column, before: str, after: str, factor: float) -> DataFrame:
    """The mean in one period exceeds the mean in another by a factor."""
    means = df.agg(
        F.avg(F.when(period == before, exact(F.col(value)))).alias("before"),
        F.avg(F.when(period == after, exact(F.col(value)))).alias("after"),
    )
    detail = sentence("({b} -> {a})", b=number_text(F.col("before"), 2), a=number_text(F.col("after"), 2))
    return verdict(means, name, ratio(F.col("after"), F.col("before")) > factor, detail)


def distinct_report(name: str, df: DataFrame, col: str) -> DataFrame:
    """A number to read; it always passes."""
    n = df.select(col).distinct().agg(F.count(col).alias("n"))
    return verdict(n, name, F.lit(True), sentence("(N={n})", n=F.col("n")))


def busier_month(name: str, covers: DataFrame, busy: int, quiet: int, factor: float) -> DataFrame:
    """Covers per open day in one month exceed those of another by a factor."""
    days = covers.groupBy("business_date").agg(F.sum("covers").alias("covers"))
    month = F.month("business_date")
    sums = days.agg(
        *[
            ratio(F.sum(F.when(month == m, F.col("covers"))), F.count(F.when(month == m, 1))).alias(n)
            for n, m in (("busy", busy), ("quiet", quiet))
        ]
    )
    detail = sentence("({a} vs {b})", a=number_text(F.col("busy"), 1), b=number_text(F.col("quiet"), 1))
    return verdict(sums, name, F.col("busy") > F.col("quiet") * factor, detail)


def busiest_weekday(name: str, covers: DataFrame, busiest: int, slowest: int) -> DataFrame:
    """Weekday numbers (Monday 1) with most and fewest covers."""
    days = covers.groupBy((F.weekday("business_date") + 1).alias("dow")).agg(F.sum("covers").alias("covers"))
    ends = days.agg(
        F.max_by("dow", F.struct("covers", -F.col("dow"))).alias("top"),
        F.min_by("dow", F.struct("covers", "dow")).alias("low"),
    )
    return verdict(
        ends,
        name,
        (F.col("top") == busiest) & (F.col("low") == slowest),
        sentence("(busiest {top}, slowest {low})", top=F.col("top"), low=F.col("low")),
    )


def rainy_days_slower(name: str, covers: DataFrame, weather: DataFrame) -> DataFrame:
    """Mean covers per hour row are lower on rainy days; rows without covers do not count."""
    days = covers.groupBy("business_date").agg(F.sum("covers").alias("covers"), F.count("covers").alias("rows"))
    wet = weather.select(F.col("date").alias("business_date"), "is_rainy_day")
    joined = days.join(wet, "business_date")
    means = joined.agg(
        *[
            ratio(
                F.sum(F.when(F.col("is_rainy_day") == v, F.col("covers"))),
                F.sum(F.when(F.col("is_rainy_day") == v, F.col("rows"))),
            ).alias(n)
            for n, v in (("wet", 1), ("dry", 0))
        ]
    )
    detail = sentence("({a} vs {b})", a=number_text(F.col("wet"), 1), b=number_text(F.col("dry"), 1))
    return verdict(means, name, F.col("wet") < F.col("dry"), detail)


def copies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows and distinct rows over the columns, as one row (rows, kinds)."""
    kinds = df.groupBy(*cols).agg(F.count("*").alias("n"))
    return kinds.agg(zero_if_null(F.sum("n")).alias("rows"), F.count("*").alias("kinds"))


def defect_profile(
    df: DataFrame,
    cols: Sequence[str],
    defects: Mapping[str, Column],
    spelled: str,
    hold: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows, distinct rows, rows with each defect and spellings of a column, as one row.

    Equal rows are counted first, in one pass, so copies cost nothing beyond. With `hold` only rows whose digests
    repeat are compared in all columns; that takes three passes, so pass a written table.
    """
    if hold is not None:
        spellings = df.groupBy(spelled).agg(
            F.count("*").alias("rows"), *[F.sum(flag(found)).alias(name) for name, found in defects.items()]
        )
        totals = spellings.agg(
            *[zero_if_null(F.sum(name)).alias(name) for name in ("rows", *defects)], F.count(spelled).alias("spellings")
        )
        copied = copies(perhaps_equal(df, cols, hold), cols).select((F.col("rows") - F.col("kinds")).alias("beyond"))
        both = totals.unionByName(copied, allowMissingColumns=True)
        return both.agg(
            F.max("rows").alias("rows"),
            (F.max("rows") - F.max("beyond")).alias("kinds"),
            *[F.max(name).alias(name) for name in defects],
            F.max("spellings").alias("spellings"),
        )
    kinds = df.groupBy(*cols).agg(F.count("*").alias("n"))
    return kinds.agg(
        zero_if_null(F.sum("n")).alias("rows"),
        F.count("*").alias("kinds"),
        *[zero_if_null(F.sum(F.col("n") * flag(found))).alias(name) for name, found in defects.items()],
        F.count_distinct(spelled).alias("spellings"),
    )


def found_in(profile: DataFrame, name: str, count: str, least: int = 0, unit: str = "") -> DataFrame:
    """A defect of a profile occurs more often than `least`."""
    return verdict(profile, name, F.col(count) > least, sentence("({n}{unit})", n=F.col(count), unit=F.lit(unit)))


def share_of_rows(profile: DataFrame, name: str, count: str, limit: float) -> DataFrame:
    share = ratio(F.col(count), F.col("rows"))
    return verdict(profile, name, share > limit, sentence("({r})", r=number_text(share, 3)))


def profile_of_sales(
    pos: DataFrame, cols: Sequence[str], hold: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The defects that raw sales are known to hold."""
    defects = {"text_dates": F.col("business_date").rlike("[A-Za-z]"), "missing_net": F.col("net_sales").isNull()}
    profile = defect_profile(pos, cols, defects, "store", hold)
    return profile.withColumn("copies", F.col("rows") - F.col("kinds"))


def has_copies(name: str, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    found = copies(df, cols)
    n = F.col("rows") - F.col("kinds")
    return verdict(found, name, n > 0, sentence("({n})", n=n))


def defects_present(df: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """Planted row defects are there: each condition holds for some row. One pass for all."""
    names = list(counts)
    totals = df.agg(*[F.sum(flag(counts[n])).alias(f"d{i}") for i, n in enumerate(names)])
    pairs = [
        F.struct(F.lit(n).alias("check_name"), zero_if_null(F.col(f"d{i}")).alias("n")) for i, n in enumerate(names)
    ]
    return totals.select(F.explode(F.array(*pairs)).alias("c")).select(
        "c.check_name",
        flag(F.col("c.n") > 0).alias("passed"),
        sentence("({n})", n=F.col("c.n")).alias("detail"),
    )


def share_above(name: str, df: DataFrame, condition: Column, limit: float) -> DataFrame:
    share = df.agg(ratio(F.sum(flag(condition)), F.count("*")).alias("r"))
    return verdict(share, name, F.col("r") > limit, sentence("({r})", r=number_text(F.col("r"), 3)))


def distinct_above(name: str, df: DataFrame, col: str, limit: int) -> DataFrame:
    n = df.select(col).distinct().agg(F.count(col).alias("n"))
    return verdict(n, name, F.col("n") > limit, sentence("({n} distinct)", n=F.col("n")))


def same_count(both: DataFrame, name: str) -> DataFrame:
    """Two counts a and b are the same."""
    return verdict(both, name, F.col("a") == F.col("b"), sentence("({a} vs {b})", a=F.col("a"), b=F.col("b")))


def dedup_recovers(name: str, raw: DataFrame, cols: Sequence[str], clean: DataFrame) -> DataFrame:
    """Distinct raw rows are as many as clean rows."""
    return same_count(side_by_side(copies(raw, cols), F.max("kinds"), clean, F.count("*")), name)
