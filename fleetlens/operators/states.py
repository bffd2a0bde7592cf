"""Tool states: hours per tool, day and category, and their facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens import params
from fleetlens.functions import classify_state, iso_yearww, parse_day_shift, safe_rate
from fleetlens.operators.relational import dedup_keep_last, drop_null_keys

_TOOL = ["ENTITY", "FAB", "FAB_ENTITY"]
_HOURS = ["running_hours", "idle_hours", "down_hours", "bagged_hours", "total_hours"]


def classified_states(
    states: DataFrame,
    asof: dt.date | Column,
    running: Sequence[str] = params.RUNNING_STATES,
    idle: Sequence[str] = params.IDLE_STATES,
    bagged: str = params.BAGGED_STATE,
    ahead: str = "kept",
) -> DataFrame:
    """Add ``state_date`` and ``state_category``; rows whose date cannot be read are dropped.

    A day without a year is one of the year of ``asof``, which for stored rows is the day they were loaded (a column).

    Dropping them by an explode of one date or none keeps the parsing in one place.  A filter would be
    moved below earlier steps, and parse every text there once more.
    """
    dated = states.withColumns(
        {
            "_date": parse_day_shift(F.col("DAY_SHIFT"), asof, ahead),
            "state_category": classify_state(F.col("ENTITY_STATE"), running, idle, bagged),
        }
    )
    known = F.when(F.col("_date").isNotNull(), F.array("_date"))
    return dated.select("*", F.explode(known).alias("state_date")).drop("_date")


def hours_by_category(classified: DataFrame) -> DataFrame:
    """Hours per tool, day and category; no known hours add up to zero."""
    keys = [*_TOOL, "state_date", "state_category"]
    return (
        drop_null_keys(classified, _TOOL)
        .groupBy(*keys)
        .agg(F.coalesce(F.sum("HOURS_IN_STATE"), F.lit(0)).alias("hours"))
    )


def _hours(category: str) -> Column:
    matching = F.sum(F.when(F.col("state_category") == category, F.col("HOURS_IN_STATE")))
    return F.coalesce(matching, F.lit(0))


def tool_day_hours(classified: DataFrame) -> DataFrame:
    """Hours in each category per tool, site and day, in one conditional aggregate."""
    keys = [*_TOOL, "state_date"]
    return (
        drop_null_keys(classified, _TOOL)
        .groupBy(*keys)
        .agg(
            _hours("Running").alias("running_hours"),
            _hours("Idle").alias("idle_hours"),
            _hours("Down").alias("down_hours"),
            _hours("Bagged").alias("bagged_hours"),
        )
        .withColumn(
            "total_hours",
            F.col("running_hours") + F.col("idle_hours") + F.col("down_hours") + F.col("bagged_hours"),
        )
        .withColumn("is_bagged", F.col("bagged_hours") > 0)
    )


def state_hours(states: DataFrame, asof: dt.date, **rules) -> DataFrame:
    """Hours per tool and day.  Where a tool reports from two sites, the greatest site is kept."""
    return hours_of_classified(classified_states(states, asof, **rules))


def hours_of_classified(classified: DataFrame) -> DataFrame:
    """``state_hours`` of rows that already have their date and category."""
    return dedup_keep_last(tool_day_hours(classified), ["ENTITY", "state_date"], ["FAB", "FAB_ENTITY"])


def _percentages(total: str, **hours: str) -> dict[str, Column]:
    return {name: _percent(column, total) for name, column in hours.items()}


def _percent(hours: str, total: str) -> Column:
    return F.coalesce(safe_rate(F.col(hours), F.col(total)) * 100, F.lit(0.0))


def daily_state_fact(hours: DataFrame) -> DataFrame:
    """State hours per tool and day with the share of each category."""
    fact = hours.withColumns(
        _percentages("total_hours", running_pct="running_hours", idle_pct="idle_hours", down_pct="down_hours")
    )
    return dedup_keep_last(fact, ["ENTITY", "state_date"], ["FAB", "FAB_ENTITY"])


def weekly_state_fact(daily: DataFrame, year_basis: str = "calendar") -> DataFrame:
    """State hours per tool and week, with shares of the weekly totals."""
    keys = [*_TOOL, "YEARWW"]
    weekly = (
        drop_null_keys(daily.withColumn("YEARWW", iso_yearww(F.col("state_date"), year_basis)), keys)
        .groupBy(*keys)
        .agg(
            *[F.coalesce(F.sum(name), F.lit(0)).alias(weekly_total(name)) for name in _HOURS],
            F.bool_or("is_bagged").alias("was_bagged_any_day"),
            F.min("state_date").alias("week_start_date"),
            F.max("state_date").alias("week_end_date"),
            F.count("state_date").alias("days_with_data"),
        )
        .withColumns(
            _percentages(
                "total_hours",
                running_pct="total_running_hours",
                idle_pct="total_idle_hours",
                down_pct="total_down_hours",
            )
        )
    )
    return dedup_keep_last(weekly, ["ENTITY", "YEARWW"], ["FAB", "FAB_ENTITY"])


def weekly_total(name: str) -> str:
    """Name of the weekly sum of a daily hours column."""
    return name if name.startswith("total_") else f"total_{name}"
