from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from files import rows
from pyspark.sql import functions as F

from fleetlens.operators import production, quality, relational as rel, states
from fleetlens.plans import catalog
from fleetlens.plans.fixtures import Fixtures

D1, D2, D3 = (dt.date(2025, 12, n) for n in (1, 2, 3))
SCHEMA = (
    "FAB_ENTITY string, ENTITY string, counter_date date, FocusRingCounter decimal(18,2), "
    "APCCounter decimal(18,2), ESCCounter decimal(18,2)"
)
HOURS = "ENTITY string, state_date date, running_hours decimal(20,2)"


def made(spark, readings, hours=20, **rules):
    """Production of one tool with the given (focus, apc, esc) per day from D1 on."""
    data = [
        ("F_E", "E", D1 + dt.timedelta(days=i), *[None if v is None else D(str(v)) for v in triple])
        for i, triple in enumerate(readings)
    ]
    running = [] if hours is None else [("E", D1 + dt.timedelta(days=i), D(hours)) for i in range(len(readings))]
    details = production.production_details(
        spark.createDataFrame(data, SCHEMA), spark.createDataFrame(running, HOURS), **rules
    )
    return details.orderBy("counter_date").collect()


CASES = {
    "normal day": ([(15000, None, None), (17500, None, None)], ("FocusRingCounter", 2500, 2500, 125.0, False, None)),
    "small drop": ([(15000, None, None), (14500, None, None)], ("FocusRingCounter", -500, None, None, False, None)),
    "exact threshold": ([(2000, None, None), (1000, None, None)], ("FocusRingCounter", -1000, None, None, False, None)),
    "fallback": (
        [(17500, 43200, None), (250, 45000, None)],
        ("APCCounter", 1800, 1800, 90.0, True,
         "Part replacement: FocusRingCounter reset from 17500.0 to 250.0; Used fallback counter: APCCounter"),
    ),
    "no fallback": (
        [(17500, None, None), (250, None, None)],
        ("FocusRingCounter", 0, 0, 0.0, True,
         "Part replacement: FocusRingCounter reset from 17500.0 to 250.0; Counter change set to 0 (part replacement)"),
    ),
    "fallback falls too": (
        [(17500, 500, None), (250, 400, 5)],
        ("FocusRingCounter", 0, 0, 0.0, True,
         "Part replacement: FocusRingCounter reset from 17500.0 to 250.0; Counter change set to 0 (part replacement)"),
    ),
    "fallback is new": (
        [(17500, None, 7), (250, 400, 9)],
        ("FocusRingCounter", 0, 0, 0.0, True,
         "Part replacement: FocusRingCounter reset from 17500.0 to 250.0; Counter change set to 0 (part replacement)"),
    ),
    "fallback counter is reset": (
        [(None, 9000, 10), (None, 5, 20)],
        ("APCCounter", 0, 0, 0.0, True,
         "Part replacement: APCCounter reset from 9000.0 to 5.0; Counter change set to 0 (part replacement)"),
    ),
    "previous is null": ([(None, 5, None), (7, 6, None)], ("FocusRingCounter", None, None, None, False, "Previous value is null")),
    "nothing found": ([(1, 1, 1), (0, None, 0)], (None, None, None, None, False, "No counter found with any keyword")),
    "zero is skipped": ([(5, 1, None), (0, 4, None)], ("APCCounter", 3, 3, 0.15, False, None)),
}


@pytest.mark.parametrize("name", CASES)
def test_decision_rule(spark, name):
    readings, expected = CASES[name]
    first, second = made(spark, readings)
    assert first.calculation_notes in ("First day - no previous value", "No counter found with any keyword")
    got = (
        second.counter_column_used, second.counter_change, second.wafers_produced, second.wafers_per_hour,
        second.part_replacement_detected, second.calculation_notes,
    )
    assert got == expected


def test_missing_running_hours(spark):
    second = made(spark, [(1, None, None), (3, None, None)], hours=None)[1]
    assert (second.wafers_produced, second.running_hours, second.wafers_per_hour) == (2, 0, None)
    assert second.calculation_notes == "No running hours - cannot calculate wafers/hour"


def test_keywords_and_threshold_are_arguments(spark):
    second = made(spark, [(100, 10, 1), (90, 20, 3)], primary=["ESC"], fallback=["Focus"], threshold=-5)[1]
    assert (second.counter_column_used, second.counter_keyword_used, second.counter_change) == ("ESCCounter", "ESC", 2)
    second = made(spark, [(100, 10, 1), (90, 20, 3)], threshold=-5)[1]
    assert (second.part_replacement_detected, second.counter_column_used, second.counter_change) == (True, "APCCounter", 10)


def test_table_without_counters(spark):
    counters = spark.createDataFrame([("F_E", "E", D1, 5)], "FAB_ENTITY string, ENTITY string, counter_date date, Wafers int")
    row = production.wafer_production(counters, spark.createDataFrame([], HOURS)).first()
    assert row.calculation_notes == "No counter found with any keyword"


def test_replacement_reports(spark):
    data = [("F_E", "E", D1, D(17500), D(43200), None), ("F_E", "E", D2, D(250), D(45000), None)]
    details = production.production_details(spark.createDataFrame(data, SCHEMA), spark.createDataFrame([], HOURS))
    columns = ["part_counter_name", "last_value_before_replacement", "first_value_after_replacement", "value_drop"]
    assert rows(production.part_replacements(details), *columns) == [("APCCounter", 43200, 45000, -1800)]
    assert rows(production.part_replacements(details, "replaced_part"), *columns) == [("FocusRingCounter", 17500, 250, 17250)]
    with pytest.raises(ValueError):
        production.part_replacements(details, "both")
    events = [row[0] for row in rows(quality.production_audit(details).where(F.col("counter_date") == D2), "event")]
    assert events == ["counter_found", "fallback_used", "negative_change", "part_replacement"]


def test_previous_row_may_be_the_other_site_on_the_same_day(spark):
    data = [
        ("A_E", "E", D1, D(100), None, None), ("B_E", "E", D1, D(130), None, None),
        ("A_E", "E", D2, D(200), None, None), ("B_E", "E", D2, D(260), None, None), ("A_E", "E", D3, D(300), None, None),
    ]
    got = production.wafer_production(spark.createDataFrame(data, SCHEMA), spark.createDataFrame([], HOURS))
    assert rows(got, "counter_date", "counter_current_value", "counter_change") == [
        (D1, 130, 30), (D2, 260, 60), (D3, 300, 40),
    ]


def test_hot_tool_with_many_copies_against_brute_force(spark):
    """A third of all rows belong to one tool; rows come in several sites and in any order."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        tool = "HOT" if i % 3 == 0 else f"T{rng.randrange(40)}"
        day = D1 + dt.timedelta(days=rng.randrange(60))
        data.append((f"F{rng.randrange(30)}_{tool}", tool, day, D(rng.randrange(1, 9000)), None, None))
    unique = {}
    for row in data:
        unique[row[0], row[2]] = row
    data = list(unique.values())
    expected, before = {}, {}
    for _, tool, day, value, *_ in sorted(data, key=lambda r: (r[1], r[2], r[0])):
        expected[tool, day] = (value, before.get(tool))
        before[tool] = value
    rng.shuffle(data)
    df = spark.createDataFrame(data, SCHEMA)
    results = []
    for parts in (1, 7):
        details = production.production_details(df.repartition(parts), spark.createDataFrame([], HOURS))
        results.append(rows(details, "ENTITY", "counter_date", "picked_value", "picked_previous_value"))
    assert results[0] == results[1]
    assert {(r[0], r[1]): (r[2], r[3]) for r in results[0]} == expected


def test_incremental_equals_full(spark):
    rng = random.Random(3)
    data = [
        (f"F_T{t}", f"T{t}", D1 + dt.timedelta(days=n), D(rng.randrange(5000)), D(rng.randrange(5000)), None)
        for t in range(9) for n in range(20) if rng.random() < 0.6
    ]
    counters, hours = spark.createDataFrame(data, SCHEMA), spark.createDataFrame([], HOURS)
    since = D1 + dt.timedelta(days=11)
    full = production.wafer_production(counters, hours).where(F.col("counter_date") >= F.lit(since))
    part = production.incremental_production(counters, counters, hours, since)
    assert rows(part, *production.PRODUCTION_COLUMNS) == rows(full, *production.PRODUCTION_COLUMNS)


def test_dedup_is_total_idempotent_and_collapses_before_the_shuffle(spark):
    df = spark.createDataFrame([("hot" if i % 3 else f"k{i % 11}", i) for i in range(2000)], "k string, i int")
    once = rel.dedup_keep_last(df.repartition(7), ["k"], ["i"])
    assert rows(once, "k", "i") == rows(rel.dedup_keep_last(df.repartition(1), ["k"], ["i"]), "k", "i")
    assert rows(rel.dedup_keep_last(once, ["k"], ["i"]), "k", "i") == rows(once, "k", "i")
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning(k")[1]


STATES = "FAB string, ENTITY string, FAB_ENTITY string, ENTITY_STATE string, DAY_SHIFT string, HOURS_IN_STATE decimal(10,2)"


def test_state_hours(spark):
    data = [
        ("F1", "E", "F1_E", "Running1", "12/01-Day", D("5.5")),
        ("F1", "E", "F1_E", "Running2", "12/01/25-Day", D("1.5")),
        ("F1", "E", "F1_E", "Repair", "12/01/2025-Day", None),
        ("F2", "E", "F2_E", "Bagged", "12/01-Day", D(3)),
        (None, "E", "nan_E", "Running1", "12/02-Day", D(3)),
        ("F1", None, "F1_nan", "Running1", "12/02-Day", D(3)),
        ("F1", "G", "F1_G", "UpToProduction", "12/02-Day", D(4)),
        ("F1", "G", "F1_G", "UpToProduction", "soon-Day", D(4)),
        ("F1", "H", "F1_H", None, "12/02-Day", None),
    ]
    df = spark.createDataFrame(data, STATES)
    got = states.state_hours(df, dt.date(2025, 12, 31))
    columns = ["running_hours", "idle_hours", "down_hours", "bagged_hours", "total_hours", "is_bagged"]
    assert rows(got, "ENTITY", "FAB", *columns) == [
        ("E", "F2", 0, 0, 0, 3, 3, True), ("G", "F1", 0, 4, 0, 0, 4, False), ("H", "F1", 0, 0, 0, 0, 0, False),
    ]
    by_site = states.tool_day_hours(states.classified_states(df, dt.date(2025, 12, 31)))
    assert rows(by_site.where("FAB_ENTITY = 'F1_E'"), *columns) == [(7, 0, 0, 0, 7, False)]
    assert rows(states.daily_state_fact(got).where("ENTITY = 'H'"), "running_pct", "idle_pct", "down_pct") == [(0, 0, 0)]
    audit = quality.state_audit(df, dt.date(2025, 12, 31))
    assert rows(audit, "event", "ENTITY", "state", "n_rows") == [
        ("bagged_tool", "E", "Bagged", 1), ("unknown_state", "E", "Repair", 1),
    ]


def test_facts_of_unmatched_days_and_year_edges(spark):
    days = [dt.date(2024, 1, 2), dt.date(2024, 12, 30), dt.date(2024, 12, 28)]
    data = [("F_E", "E", day, None, None, None) for day in days] + [("F_X", "X", days[0], D(1), None, None)]
    hours = spark.createDataFrame(
        [("E", "F", "F_E", day, D(4), D(1), D(1), D(0), D(6), False) for day in days],
        "ENTITY string, FAB string, FAB_ENTITY string, state_date date, running_hours decimal(20,2), idle_hours decimal(20,2), "
        "down_hours decimal(20,2), bagged_hours decimal(20,2), total_hours decimal(20,2), is_bagged boolean",
    )
    made_ = production.wafer_production(spark.createDataFrame(data, SCHEMA), hours)
    daily = production.daily_production(made_, hours)
    assert rows(daily.where("ENTITY = 'X'"), "FAB", "running_hours", "is_bagged") == [(None, None, None)]
    weekly = production.weekly_production(daily)
    columns = ["YEARWW", "total_wafers_produced", "total_running_hours", "week_start_date", "week_end_date", "days_with_data", "avg_wafers_per_hour"]
    assert rows(weekly, *columns) == [
        ("2024WW01", 0, 8, days[0], days[1], 2, 0.0), ("2024WW52", 0, 4, days[2], days[2], 1, 0.0),
    ]
    assert [r[0] for r in rows(production.weekly_production(daily, "iso"), "YEARWW")] == ["2024WW01", "2024WW52", "2025WW01"]
    assert set(daily.columns) == {
        "ENTITY", "FAB", "FAB_ENTITY", "production_date", "wafers_produced", "wafers_per_hour", "running_hours", "idle_hours",
        "down_hours", "bagged_hours", "total_hours", "is_bagged", "part_replacement_detected", "counter_column_used",
        "counter_keyword_used",
    }


def test_daily_fact_from_one_join_equals_that_of_two(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    counters, hours = catalog.raw_counters(fx), catalog.daily_hours(fx).checkpoint()
    one = production.daily_from_counters(counters, hours)
    two = production.daily_production(production.wafer_production(counters, hours), hours)
    assert one.columns == two.columns and rows(one, "*") == rows(two, "*")
