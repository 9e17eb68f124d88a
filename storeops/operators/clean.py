"""The five cleaning steps every extract goes through: map names, type, deduplicate, impute, convert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeops.functions.columns import (
    ISO_DAY,
    TEXT_MONTH_DAY,
    flag,
    half_up,
    match_key,
    try_day,
    try_decimal,
    try_minute,
    try_whole,
)

# Fixed value: kilograms to pounds.
LB_PER_KG = 2.20462


def resolve_alias(df: DataFrame, raw_col: str, alias: DataFrame, master_col: str, out: str | None = None) -> DataFrame:
    """Add the master value for a messy name; names without an entry keep their row with NULL.

    `alias` has `alias_key` and `master_col`. There is no broadcast hint: Spark broadcasts the table
    when its size statistics are under the threshold and otherwise joins with skew splitting, so a
    store that holds a third of the rows is handled either way.
    """
    lookup = alias.select(
        F.col("alias_key").alias("_alias_key"), F.col(master_col).alias("_master_value")
    )
    return (
        df.join(lookup, match_key(F.col(raw_col)) == F.col("_alias_key"), "left")
        .withColumn(out or master_col, F.col("_master_value"))
        .drop("_alias_key", "_master_value")
    )


def typed(col: Column, kind: str) -> Column:
    """One text column to its type. Kinds: text, whole, double, day, mixed_day, minute, decimal(p,s)."""
    if kind == "text":
        return col
    if kind == "whole":
        return try_whole(col)
    if kind == "double":
        return col.try_cast("double")
    if kind == "day":
        return try_day(col, ISO_DAY)
    if kind == "mixed_day":
        return try_day(col, ISO_DAY, TEXT_MONTH_DAY)
    if kind == "minute":
        return try_minute(col)
    if kind.startswith("decimal("):
        precision, scale = kind[8:-1].split(",")
        return try_decimal(col, int(precision), int(scale))
    raise ValueError(f"unknown column kind: {kind}")


def type_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Type the named columns; a value that does not fit becomes NULL and never fails the job."""
    return df.withColumns({name: typed(F.col(name), kind) for name, kind in kinds.items()})


def first_per_grain(
    df: DataFrame,
    grain: Sequence[str | Column],
    order: Sequence[str],
    keep: Sequence[str] | None = None,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """One row per grain, the earliest by `order`.

    Put the load time first and then the remaining columns, so that equal load times still give one
    defined row. Spark cuts every group to one row before the shuffle (WindowGroupLimit), so a key
    with very many copies ships at most one row per task.

    That cut sorts the rows of each task as they are read, however many these are. `spread` names grain columns
    by which rows are dealt out first, for tables in which copies are few: rows are then sorted once, in the
    partitions of the shuffle, and a later grouping by these and more columns needs no shuffle of its own.
    """
    if spread:
        df = df.repartition(*spread)
    window = Window.partitionBy(*grain).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1)
    return ranked.select(*keep) if keep else ranked.drop("_rank")


def impute(df: DataFrame, col: str, fallback: Column, flag_col: str, out: str | None = None) -> DataFrame:
    """Fill NULLs from `fallback` and say so in a 0/1 column."""
    return df.withColumns(
        {flag_col: flag(F.col(col).isNull()), out or col: F.coalesce(F.col(col), fallback)}
    )


def convert_unit(
    df: DataFrame, qty: str, unit_cost: str, unit: str = "unit", flag_col: str = "is_unit_converted"
) -> DataFrame:
    """Pounds to kilograms: quantity divided, unit cost multiplied, unit renamed, row flagged."""
    is_lb = F.col(unit) == "lb"
    return df.withColumns(
        {
            qty: half_up(F.when(is_lb, F.col(qty) / LB_PER_KG).otherwise(F.col(qty)), 3),
            unit_cost: half_up(F.when(is_lb, F.col(unit_cost) * LB_PER_KG).otherwise(F.col(unit_cost)), 3),
            unit: F.when(is_lb, F.lit("kg")).otherwise(F.col(unit)),
            flag_col: flag(is_lb),
        }
    )
