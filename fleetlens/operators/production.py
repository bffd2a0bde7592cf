"""Wafer production from cumulative counters, replacements, and the production facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens import params
from fleetlens.functions import (
    Candidates,
    calculation_notes,
    counter_change,
    is_replacement,
    iso_yearww,
    number_text,
    pick_counter,
    reading_at,
    safe_rate,
)
from fleetlens.operators.relational import (
    day_rows,
    dedup_keep_last,
    drop_null_keys,
    previous_row,
    union_dynamic,
)
from fleetlens.operators.states import weekly_total

PRODUCTION_COLUMNS = [
    "ENTITY", "counter_date", "counter_column_used", "counter_keyword_used", "counter_current_value",
    "counter_previous_value", "counter_change", "part_replacement_detected", "wafers_produced",
    "running_hours", "wafers_per_hour", "calculation_notes",
]
_HOURS = ["running_hours", "idle_hours", "down_hours", "bagged_hours", "total_hours"]


def production_details(
    counters: DataFrame,
    state_hours: DataFrame,
    primary: Sequence[str] = params.PRIMARY_KEYWORDS,
    fallback: Sequence[str] = params.FALLBACK_KEYWORDS,
    threshold: float = params.REPLACEMENT_THRESHOLD,
    order_by: Sequence[str] = ("FAB_ENTITY",),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Production per tool and day, together with what was considered on the way.

    The running hours are joined while both sides are partitioned by tool and day; only then are the
    rows gathered by tool to look at the day before.  ``state_hours`` has one row per tool and day.
    Its columns to ``carry`` come along in the struct ``state``, null where no state is known.
    """
    candidates = Candidates.of(counters, primary, fallback)
    readings = counters.where(F.col("ENTITY").isNotNull()).select(
        "ENTITY", "counter_date", *order_by, candidates.readings(counters).alias("readings")
    )
    last = day_rows(readings, "ENTITY", "counter_date", "readings", [*order_by, "readings"])
    state = [F.struct(*carry).alias("state")] if carry else []
    running = state_hours.select("ENTITY", F.col("state_date").alias("counter_date"), "running_hours", *state)
    days = last.join(running, ["ENTITY", "counter_date"], "left")
    return _decide(previous_row(days, "ENTITY", "counter_date", "readings", "before"), candidates, threshold)


def _decide(days: DataFrame, candidates: Candidates, threshold: float) -> DataFrame:
    """Apply the production rule to days that know their readings and those of the row before."""
    readings, before = F.col("readings"), F.col("before")
    steps = (
        days.withColumns(
            {
                "running_hours": F.coalesce("running_hours", F.lit(0)),
                "first": pick_counter(readings, candidates),
                "spare": pick_counter(readings, candidates, fallback_only=True),
            }
        )
        .withColumns(
            {
                "first_name": candidates.name(F.col("first.position")),
                "first_keyword": candidates.keyword(F.col("first.position")),
                "first_is_primary": F.col("first.position") < candidates.fallback_from,
                "first_previous": reading_at(before, F.col("first.position")),
                "spare_name": candidates.name(F.col("spare.position")),
                "spare_keyword": candidates.keyword(F.col("spare.position")),
                "spare_previous": reading_at(before, F.col("spare.position")),
            }
        )
        .withColumns(
            {
                "first_change": counter_change(F.col("first.value"), F.col("first_previous")),
                "spare_change": counter_change(F.col("spare.value"), F.col("spare_previous")),
            }
        )
    )
    fell = F.col("first_change") < 0
    replaced = F.coalesce(fell & is_replacement(F.col("first_change"), threshold), F.lit(False))
    steps = steps.withColumn("replaced", replaced)
    # A reset primary counter may be stood in for by a fallback counter that did not fall.
    tried = F.col("replaced") & F.col("first_is_primary") & F.col("spare").isNotNull()
    steps = steps.withColumn("fallback_tried", F.coalesce(tried, F.lit(False)))
    adopted = F.col("fallback_tried") & (F.col("spare_change") >= 0)
    steps = steps.withColumn("adopted", F.coalesce(adopted, F.lit(False)))

    def used(spare: str, first: str) -> Column:
        return F.when(F.col("adopted"), F.col(spare)).otherwise(F.col(first))

    change = F.when(F.col("replaced") & ~F.col("adopted"), F.lit(0)).otherwise(used("spare_change", "first_change"))
    steps = steps.withColumn("counter_change", change)
    steps = steps.withColumn("wafers_produced", F.when(F.col("counter_change") >= 0, F.col("counter_change")))

    found, known = F.col("first").isNotNull(), F.col("before").isNotNull()
    notes = calculation_notes(
        F.when(~found, "No counter found with any keyword"),
        F.when(found & ~known, "First day - no previous value"),
        F.when(found & known & F.col("first_previous").isNull(), "Previous value is null"),
        F.when(
            F.col("replaced"),
            F.concat(
                F.lit("Part replacement: "), F.col("first_name"),
                F.lit(" reset from "), number_text(F.col("first_previous")),
                F.lit(" to "), number_text(F.col("first.value")),
            ),
        ),
        F.when(F.col("adopted"), F.concat(F.lit("Used fallback counter: "), F.col("spare_name"))),
        F.when(F.col("replaced") & ~F.col("adopted"), "Counter change set to 0 (part replacement)"),
        F.when(
            F.col("wafers_produced").isNotNull() & (F.col("running_hours") <= 0),
            "No running hours - cannot calculate wafers/hour",
        ),
    )
    return steps.select(
        "ENTITY",
        "counter_date",
        used("spare_name", "first_name").alias("counter_column_used"),
        used("spare_keyword", "first_keyword").alias("counter_keyword_used"),
        used("spare.value", "first.value").alias("counter_current_value"),
        used("spare_previous", "first_previous").alias("counter_previous_value"),
        "counter_change",
        F.col("replaced").alias("part_replacement_detected"),
        "wafers_produced",
        "running_hours",
        safe_rate(F.col("wafers_produced"), F.col("running_hours")).alias("wafers_per_hour"),
        notes.alias("calculation_notes"),
        F.col("first_name").alias("picked_counter"),
        F.col("first_keyword").alias("picked_keyword"),
        F.col("first.value").alias("picked_value"),
        F.col("first_previous").alias("picked_previous_value"),
        F.col("first_change").alias("picked_change"),
        "fallback_tried",
        F.col("spare_keyword").alias("fallback_keyword"),
        *(["state"] if "state" in days.columns else []),
    )


def wafer_production(counters: DataFrame, state_hours: DataFrame, **rules) -> DataFrame:
    """Wafers per tool and day.

    The change is taken against the previous row, however long ago that was; it is set against the
    running hours of the day itself.
    """
    return production_details(counters, state_hours, **rules).select(*PRODUCTION_COLUMNS)


def incremental_production(
    recent: DataFrame,
    history: DataFrame,
    state_hours: DataFrame,
    since: dt.date,
    order_by: Sequence[str] = ("FAB_ENTITY",),
    ties: Sequence[str | Column] = (),
    **rules,
) -> DataFrame:
    """Production details of ``recent`` counters from day ``since`` on.

    Of the ``history`` before that day only each tool's last row is used, so that its first recent
    day has a previous value.  A map-side aggregate leaves one such row per tool and task.  Where
    several loads of the history tell one day, the greatest of ``ties`` decides.
    """
    start = F.lit(since)
    counters = [name for name in history.columns if name.endswith(params.COUNTER_SUFFIX)]
    columns = ["ENTITY", "counter_date", *order_by, *counters]
    row = F.struct(*[F.col(f"`{name}`") for name in columns])
    last_known = (
        history.where((F.col("counter_date") < start) & F.col("ENTITY").isNotNull())
        .groupBy("ENTITY")
        .agg(F.max_by(row, F.struct("counter_date", *order_by, *ties)).alias("row"))
        .select("row.*")
    )
    rows = union_dynamic([recent.where(F.col("counter_date") >= start), last_known])
    details = production_details(rows, state_hours, order_by=order_by, **rules)
    return details.where(F.col("counter_date") >= start)


def part_replacements(production: DataFrame, report: str = "counter_used") -> DataFrame:
    """Replacement events.

    ``report='counter_used'`` describes the counter that production was computed from, which is the
    fallback where one was adopted.  ``report='replaced_part'`` describes the counter that was reset
    and needs the columns of ``production_details``.
    """
    if report == "counter_used":
        name, before, after = "counter_column_used", "counter_previous_value", "counter_current_value"
    elif report == "replaced_part":
        name, before, after = "picked_counter", "picked_previous_value", "picked_value"
    else:
        raise ValueError(f"report must be 'counter_used' or 'replaced_part', not {report!r}")
    events = production.where(F.col("part_replacement_detected")).select(
        "ENTITY",
        F.col("counter_date").alias("replacement_date"),
        F.col(name).alias("part_counter_name"),
        F.col(before).alias("last_value_before_replacement"),
        F.col(after).alias("first_value_after_replacement"),
        (F.col(before) - F.col(after)).alias("value_drop"),
        F.col(before).alias("part_wafers_at_replacement"),
        F.col("calculation_notes").alias("notes"),
    )
    keys = ["ENTITY", "replacement_date", "part_counter_name"]
    return dedup_keep_last(events, keys, ["last_value_before_replacement", "first_value_after_replacement"])


def daily_production(production: DataFrame, state_hours: DataFrame) -> DataFrame:
    """Production per tool and day with the state hours of that day, null where no state is known."""
    hours = state_hours.select(
        "ENTITY", F.col("state_date").alias("production_date"), "FAB", "FAB_ENTITY", *_HOURS, "is_bagged"
    )
    fact = (
        production.withColumnRenamed("counter_date", "production_date")
        .drop("running_hours")
        .join(hours, ["ENTITY", "production_date"], "left")
        .select(
            "ENTITY", "FAB", "FAB_ENTITY", "production_date", "wafers_produced", "wafers_per_hour", *_HOURS,
            "is_bagged", "part_replacement_detected", "counter_column_used", "counter_keyword_used",
        )
    )
    return dedup_keep_last(fact, ["ENTITY", "production_date"], ["FAB", "FAB_ENTITY"])


def daily_from_counters(counters: DataFrame, state_hours: DataFrame, **rules) -> DataFrame:
    """``daily_production`` straight from counters: one join with the state hours carries all of their columns."""
    columns = ["FAB", "FAB_ENTITY", *_HOURS, "is_bagged"]
    details = production_details(counters, state_hours, carry=columns, **rules)
    return details.select(
        "ENTITY", "state.FAB", "state.FAB_ENTITY", F.col("counter_date").alias("production_date"), "wafers_produced",
        "wafers_per_hour", *[f"state.{name}" for name in _HOURS], "state.is_bagged", "part_replacement_detected",
        "counter_column_used", "counter_keyword_used",
    )


def weekly_production(daily: DataFrame, year_basis: str = "calendar") -> DataFrame:
    """Production per tool and week.  Days without a known site are left out."""
    keys = ["ENTITY", "FAB", "FAB_ENTITY", "YEARWW"]
    weekly = (
        drop_null_keys(daily.withColumn("YEARWW", iso_yearww(F.col("production_date"), year_basis)), keys)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("wafers_produced"), F.lit(0)).alias("total_wafers_produced"),
            *[F.coalesce(F.sum(name), F.lit(0)).alias(weekly_total(name)) for name in _HOURS],
            F.count_if("part_replacement_detected").alias("part_replacements_count"),
            F.min("production_date").alias("week_start_date"),
            F.max("production_date").alias("week_end_date"),
            F.count("production_date").alias("days_with_data"),
        )
        .withColumn("avg_wafers_per_hour", safe_rate(F.col("total_wafers_produced"), F.col("total_running_hours")))
    )
    return dedup_keep_last(weekly, ["ENTITY", "YEARWW"], ["FAB", "FAB_ENTITY"])
