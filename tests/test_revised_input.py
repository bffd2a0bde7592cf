"""Files that are corrected or slide out of the window, quoted line breaks, folders that are no weeks, dates other than ISO."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from files import STATE_HEADER, rows, write_csv
from pyspark.sql import functions as F

from fleetlens import params
from fleetlens.functions.dates import tool_age_days
from fleetlens.operators.production import incremental_production
from fleetlens.plans import layers
from fleetlens.sources import csv_files, tables
from fleetlens.streaming import arrivals

LOADED = dt.datetime(2025, 12, 17, 12)


def test_quoted_line_breaks_reach_the_state_reader(spark, tmp_path):
    row = 'F1,2025WW50,2025-12-10 - Shift 1,"Re\npair",T1,1.5,24,6'
    write_csv(tmp_path, "2025WW50", "EntityStates.csv", [STATE_HEADER, row], LOADED)
    weeks = spark.createDataFrame([("2025WW50", 1)], "ww string, rank long")
    files = csv_files.discover_state_files(spark, str(tmp_path), weeks)
    got = csv_files.read_states(spark, files, LOADED, multiline=True).rows.collect()
    assert [(r.ENTITY_STATE, float(r.HOURS_IN_STATE)) for r in got] == [("Re\npair", 1.5)]


def test_folders_that_are_no_weeks_do_not_count(spark):
    paths = [("file:/in/2025WW50/EntityStates.csv",), ("file:/in/archive/EntityStates.csv",), ("file:/in/2025WW5/EntityStates.csv",)]
    got = arrivals._arrived_weeks(spark.createDataFrame(paths, "path string")).collect()
    assert [(r.ww, r.rank) for r in got] == [("2025WW50", -202550)]


def test_dates_other_than_iso(spark):
    texts = ["2024-01-15", "1/15/2024", "01/15/2024 00:00:00", "15-Jan-2024", "20240115", "13/45/2024", "soon", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.age for r in df.select("i", tool_age_days(df.t, dt.date(2024, 1, 25)).alias("age")).orderBy("i").collect()]
    assert got == [10, 10, 10, 10, 10, None, None, None, None]


def job(spark, tmp_path, day, mode="full", store="store"):
    day = dt.date(2025, 12, day)
    return layers.Job(spark, str(tmp_path / "in"), str(tmp_path / store), day, dt.datetime.combine(day, dt.time(12)), mode)


def states(tmp_path, week, *told):
    lines = [f"F28,x,12/{day:02d}/2025-Day,{state},T1_PC,{hours},24,0.5" for day, state, hours in told]
    write_csv(tmp_path / "in", week, "EntityStates.csv", [STATE_HEADER, *lines], LOADED)


def counters(tmp_path, week, day, focus, apc):
    modified = dt.datetime(2025, 12, day + 1, 3)
    write_csv(tmp_path / "in", week, f"Counters_{day}.csv", ["ENTITY,FocusRingCounter,APCCounter", f"T1_PC,{focus},{apc}"], modified)


def same_tables(left, right):
    for table in params.NATURAL_KEYS:
        columns = [f"`{c}`" for c in right[table].columns if not c.endswith(("_ts", "timestamp", "load_date"))]
        assert rows(left[table], *columns) == rows(right[table], *columns), table


def test_corrected_files_replace_what_they_said(spark, tmp_path):
    counters(tmp_path, "2025WW51", 9, 15000, 41000)
    states(tmp_path, "2025WW51", (8, "Reapir", 3), (9, "Reapir", 7), (9, "Running1", 10))
    layers.run(job(spark, tmp_path, 10))
    counters(tmp_path, "2025WW52", 16, 250, 42000)
    states(tmp_path, "2025WW52", (16, "Running1", 20), (7, "Running1", 1))
    first = layers.run(job(spark, tmp_path, 17, "incremental"))
    assert first["part_replacements"].count() == 1
    # The counter was misread, a state misspelt, and one day, the first of its week, belonged to another tool.
    counters(tmp_path, "2025WW52", 16, 16000, 42000)
    states(tmp_path, "2025WW52", (16, "Running1", 20))
    states(tmp_path, "2025WW51", (9, "Repair", 7), (9, "Running1", 10))
    last = layers.run(job(spark, tmp_path, 17))
    assert last["part_replacements"].count() == 0
    assert rows(last["state_hours"], F.dayofmonth("state_date"), "down_hours") == [(16, 0), (9, 7)]
    assert rows(last["fact_weekly_production"], F.sum("part_replacements_count")) == [(0,)]
    same_tables(last, layers.run(job(spark, tmp_path, 17, store="anew")))


def test_a_day_at_the_edge_of_the_window_keeps_its_hours(spark, tmp_path, monkeypatch):
    # Also without a checkpoint folder: rows are staged beside the tables.
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    counters(tmp_path, "2025WW50", 2, 100, 100)
    states(tmp_path, "2025WW50", (2, "UpToProduction", 5))
    states(tmp_path, "2025WW51", (2, "Running1", 10), (9, "Running1", 8))
    layers.run(job(spark, tmp_path, 10))
    late = layers.Job(**{**vars(job(spark, tmp_path, 17)), "weeks": 2})
    for mode in ("full", "incremental"):
        got = layers.run(layers.Job(**{**vars(late), "mode": mode}))
        assert rows(got["state_hours"], F.dayofmonth("state_date"), "running_hours", "idle_hours") == [(2, 10, 5), (9, 8, 0)]


@pytest.mark.parametrize("first", [1, -1])
def test_history_told_twice_is_decided_by_the_week(spark, first):
    told = [("T", "F|T", dt.date(2025, 12, 2), Decimal(100), 1), ("T", "F|T", dt.date(2025, 12, 2), Decimal(200), 2)]
    columns = "ENTITY string, FAB_ENTITY string, counter_date date, FocusCounter decimal(18,2), week int"
    history = spark.createDataFrame(told[::first], columns).coalesce(1)
    recent = spark.createDataFrame([("T", "F|T", dt.date(2025, 12, 9), Decimal(500), 3)], columns)
    hours = spark.createDataFrame([], "ENTITY string, state_date date, running_hours decimal(10,2)")
    for ties, before in (([-F.col("week")], 100), ([F.col("week")], 200)):
        made = incremental_production(recent, history, hours, dt.date(2025, 12, 9), ties=ties)
        assert rows(made, "counter_previous_value") == [(before,)]


def test_partitions_without_rows_are_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, p string"), path, "p", F.lit(True))
    tables.replace_partitions(spark.createDataFrame([(9, "c")], "v int, p string"), path, "p", F.col("p") >= "b")
    assert rows(tables.read_table(spark, path), "v", "p") == [(1, "a"), (9, "c")]
    tables.replace_partitions(tables.read_table(spark, path).where("v > 1"), path, "p", F.lit(True))
    assert rows(tables.read_table(spark, path), "v", "p") == [(9, "c")]
