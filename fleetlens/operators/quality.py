"""Data-quality checks and audit trails, as ordinary tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens import params
from fleetlens.functions import normalize_entity, state_name, warranty_start
from fleetlens.operators.installed_base import tools_with_age
from fleetlens.operators.states import classified_states, tool_day_hours


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def _as_rows(counts: DataFrame, name: str, value: str, columns: Sequence[str]) -> DataFrame:
    return counts.unpivot([], list(columns), name, value)


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of nulls in each column that must have none."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return _as_rows(counts, "column_name", "n_nulls", columns)


def dedup_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after keeping one per key, and how many that removes."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def filter_report(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before and after a filter, and how many it removes."""
    return df.agg(F.count("*").alias("rows_before"), F.count_if(keep).alias("rows_after")).withColumn(
        "rows_removed", F.col("rows_before") - F.col("rows_after")
    )


def normalization_report(
    df: DataFrame,
    pattern: str = params.ENTITY_PATTERN,
    replacement: str = params.ENTITY_REPLACEMENT,
    column: str = "ENTITY",
) -> DataFrame:
    """How many names the entity normalisation changes."""
    changed = F.col(column) != normalize_entity(F.col(column), pattern, replacement)
    return df.agg(F.count("*").alias("n_rows"), F.count_if(changed).alias("n_changed"))


def key_overlap(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, distinct values on each side and in common; ``no_overlap`` warns of an empty join."""

    def values(df: DataFrame, side: str) -> DataFrame:
        entries = F.array(
            *[F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value")) for name in columns]
        )
        return df.select(F.inline(entries)).where(F.col("value").isNotNull()).withColumn("side", F.lit(side))

    per_value = (
        values(left, "left")
        .unionByName(values(right, "right"))
        .groupBy("column_name", "value")
        .agg(
            F.bool_or(F.col("side") == "left").alias("in_left"),
            F.bool_or(F.col("side") == "right").alias("in_right"),
        )
    )
    return (
        per_value.groupBy("column_name")
        .agg(
            F.count_if("in_left").alias("n_left"),
            F.count_if("in_right").alias("n_right"),
            F.count_if(F.col("in_left") & F.col("in_right")).alias("n_common"),
        )
        .withColumn("no_overlap", F.col("n_common") == 0)
    )


def acceptance_checks(
    tools: DataFrame, mart: DataFrame, leadership: DataFrame, gbom: DataFrame, bound_by: str = "tool_id"
) -> DataFrame:
    """One row per check: name, value, bound, passed.

    A: no ENTITY has an underscore.  B: no configuration has more tools than there are.  C: no part
    that is in several configurations does.  Tools are counted by ENTITY and Location, or by ENTITY
    alone with ``bound_by='entity'``.
    """
    if bound_by not in ("tool_id", "entity"):
        raise ValueError(f"bound_by must be 'tool_id' or 'entity', not {bound_by!r}")
    key = F.col("ENTITY")
    if bound_by == "tool_id":
        key = F.struct(F.coalesce("ENTITY", F.lit("None")), F.coalesce("Location", F.lit("None")))
    per_key = tools.groupBy(key.alias("tool")).agg(F.count_if(F.contains("ENTITY", F.lit("_"))).alias("n"))
    parts = gbom.groupBy("Part_Number").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    several = leadership.join(parts, "Part_Number", "left_semi")

    def measure(name: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("value")).withColumn("name", F.lit(name))

    measures = (
        measure("tools", per_key, F.count("tool"))
        .unionByName(measure("A", per_key, F.sum("n")))
        .unionByName(measure("B", mart, F.max("Active_Tool_Count_Config")))
        .unionByName(measure("C", several, F.max("Number_of_active_tools")))
    )
    # Four rows, brought into one so that each check sees the number of tools.
    names = ("tools", "A", "B", "C")
    one = measures.agg(*[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in names])

    def check(name: str, bound: Column) -> Column:
        return F.struct(F.lit(name).alias("check_name"), F.col(name).alias("value"), bound.alias("bound"))

    checks = F.array(check("A", F.lit(0).cast("bigint")), check("B", F.col("tools")), check("C", F.col("tools")))
    return one.select(F.inline(checks)).withColumn("passed", F.col("value") <= F.col("bound"))


def tool_profile(
    tools: DataFrame, asof: dt.date, inactive: Sequence[str] = params.INACTIVE_STATUSES
) -> DataFrame:
    """One row: sizes, unreadable warranty dates, range of dates and ages, active and inactive tools."""
    aged = tools_with_age(tools, asof, inactive).withColumn(
        "start", warranty_start(F.col("Warranty_Start")).cast("date")
    )
    return aged.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("start").isNull()).alias("n_null_warranty"),
        F.min("start").alias("min_warranty"),
        F.max("start").alias("max_warranty"),
        F.min("Tool_Age_Years").alias("min_age_years"),
        F.max("Tool_Age_Years").alias("max_age_years"),
        F.count_if("is_active").alias("n_active"),
        F.count_if(~F.col("is_active")).alias("n_inactive"),
    )


def age_distribution(
    tools: DataFrame, asof: dt.date, inactive: Sequence[str] = params.INACTIVE_STATUSES
) -> DataFrame:
    """Tool rows per age class, all and active."""
    return (
        tools_with_age(tools, asof, inactive)
        .groupBy("Age_Bucket")
        .agg(F.count("*").alias("n_all"), F.count_if("is_active").alias("n_active"))
    )


def production_audit(details: DataFrame) -> DataFrame:
    """The decisions behind each production row, one event per row, from ``production_details``."""
    found = F.col("picked_counter").isNotNull()

    def event(name: str, when: Column, counter: Column, keyword: Column) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(name).alias("event"),
                counter.alias("counter"),
                keyword.alias("keyword"),
                F.col("picked_previous_value").alias("previous_value"),
                F.col("picked_value").alias("current_value"),
            ),
        )

    picked = (F.col("picked_counter"), F.col("picked_keyword"))
    events = F.array_compact(
        F.array(
            event("no_counter_found", ~found, *picked),
            event("counter_found", found, *picked),
            event("negative_change", F.col("picked_change") < 0, *picked),
            event("part_replacement", F.col("part_replacement_detected"), *picked),
            event("fallback_used", F.col("fallback_tried"), F.col("picked_counter"), F.col("fallback_keyword")),
            event(
                "wafers_calculated",
                F.col("wafers_per_hour").isNotNull(),
                F.col("counter_column_used"),
                F.col("counter_keyword_used"),
            ),
        )
    )
    return details.select("ENTITY", "counter_date", F.inline(events))


def state_audit(states: DataFrame, asof: dt.date, **rules) -> DataFrame:
    """Unknown states and bagged tools per tool and day, with the number of rows."""
    classified = classified_states(states, asof, **rules)
    event = F.when(F.col("state_category") == "Bagged", "bagged_tool").when(
        (F.col("state_category") == "Down") & F.col("ENTITY_STATE").isNotNull(), "unknown_state"
    )
    return (
        classified.select("ENTITY", "state_date", state_name(F.col("ENTITY_STATE")).alias("state"), event.alias("event"))
        .where(F.col("event").isNotNull())
        .groupBy("event", "ENTITY", "state_date", "state")
        .agg(F.count("*").alias("n_rows"))
    )


def state_classification(states: DataFrame, asof: dt.date, **rules) -> DataFrame:
    """Running, idle and down hours per tool, site and day, before one site is chosen."""
    return tool_day_hours(classified_states(states, asof, **rules)).select(
        "ENTITY", "FAB", "FAB_ENTITY", "state_date", "running_hours", "idle_hours", "down_hours"
    )
