"""Generic relational operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fleetlens import params
from fleetlens.functions import fiscal_work_week, utc_literal


def dedup_keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The last row per key in the given order, which must be total within a key.

    Spark turns the ``rank = 1`` filter into a group limit that runs before the shuffle, so copies of
    a hot key collapse in the map tasks.
    """
    latest_first = [F.col(c).desc() if isinstance(c, str) else c.desc() for c in order_by]
    window = Window.partitionBy(*keys).orderBy(*latest_first)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def day_rows(
    df: DataFrame, entity: str, date: str, value: str, order_by: Sequence[str | Column]
) -> DataFrame:
    """Last row per (entity, date), with ``same_day_previous``: the value of the row before it that day.

    At most two rows per entity and day leave the map tasks.
    """
    latest_first = [F.col(c).desc() if isinstance(c, str) else c.desc() for c in order_by]
    window = Window.partitionBy(entity, date).orderBy(*latest_first)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") <= 2)
        .withColumn("same_day_previous", F.lead(value).over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def previous_row(days: DataFrame, entity: str, date: str, value: str, alias: str) -> DataFrame:
    """Add the value of the row before, which may be of the same day; null on an entity's first row.

    ``days`` comes from ``day_rows``: one row per entity and day, so an entity's window is bounded by
    the calendar however many raw rows it had.
    """
    window = Window.partitionBy(entity).orderBy(date)
    before = F.coalesce(F.col("same_day_previous"), F.lag(value).over(window))
    return days.withColumn(alias, before).drop("same_day_previous")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null key belong to no group."""
    return df.dropna(subset=list(keys))


def week_labels(asof: dt.date, weeks: int) -> list[Column]:
    """Labels of the last ``weeks`` fiscal weeks, newest first, as constant expressions."""
    return [fiscal_work_week(F.lit(asof - dt.timedelta(weeks=i))) for i in range(weeks)]


def recent_work_weeks(spark: SparkSession, asof: dt.date, weeks: int = params.WEEKS_TO_LOAD) -> DataFrame:
    """(ww, rank) of the last ``weeks`` fiscal weeks; rank 1 is the current week."""
    back = spark.range(weeks)
    day = F.date_sub(F.lit(asof), (F.col("id") * 7).cast("int"))
    return (
        back.select(fiscal_work_week(day).alias("ww"), (F.col("id") + 1).alias("rank"))
        .groupBy("ww")
        .agg(F.min("rank").alias("rank"))
    )


def by_mode(
    df: DataFrame,
    mode: str,
    asof: dt.date,
    weeks: int = params.WEEKS_TO_LOAD,
    week_column: str = "load_ww",
) -> DataFrame:
    """Rows of the last ``weeks`` weeks (full) or of the current week (incremental).

    The labels fold to literals, so a table partitioned by week is pruned.
    """
    if mode not in ("full", "incremental"):
        raise ValueError(f"mode must be 'full' or 'incremental', not {mode!r}")
    labels = week_labels(asof, weeks if mode == "full" else 1)
    return df.where(F.col(week_column).isin(*labels))


def lookback(df: DataFrame, date_column: str, asof: dt.date, days: int = params.LOOKBACK_DAYS) -> DataFrame:
    """Rows of the last ``days`` days, to be processed again because data may arrive late."""
    return df.where(F.col(date_column) >= F.lit(asof - dt.timedelta(days=days)))


def retain(df: DataFrame, date_column: str, asof: dt.date, days: int) -> DataFrame:
    """Rows that are not older than ``days`` days."""
    return df.where(F.col(date_column) >= F.lit(asof - dt.timedelta(days=days)))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of frames with the same columns, matched by name."""
    return reduce(lambda left, right: left.unionByName(right), frames)


def union_dynamic(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of frames with differing columns: all columns in order of first appearance, gaps null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def value_counts(df: DataFrame, column: str, top: int = 20) -> DataFrame:
    """The ``top`` most frequent values; nulls are not counted, ties go to the smaller value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), F.asc(column))
        .limit(top)
    )


def distinct_sample(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The first ``n`` distinct values in sorted order."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(n)


def distinct_count(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Number of distinct non-null values of the whole table."""
    return df.agg(F.countDistinct(column).alias(alias))


def stamp(df: DataFrame, column: str, ts: dt.datetime) -> DataFrame:
    """Add the time of the calculation as a constant column."""
    return df.withColumn(column, utc_literal(ts))


def fill_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing counts become zero."""
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(0)).cast("bigint") for name in columns})
