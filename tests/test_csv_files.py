from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from files import STATE_HEADER, rows, write_csv
from pyspark.sql import functions as F

from fleetlens.operators.relational import by_mode, recent_work_weeks
from fleetlens.sources import csv_files as csv, tables

ASOF = dt.date(2025, 12, 17)  # 2025WW52
LOAD_TS = dt.datetime(2025, 12, 17, 12, 0)


def test_latest_counter_file_by_modification_time(spark, tmp_path):
    week = "2025WW52"
    write_csv(tmp_path, week, "Counters_2025-11-29.csv", ["ENTITY,APCCounter", "F28_GTA101_PM,1"], dt.datetime(2025, 12, 18, 3, 15, 23))
    write_csv(tmp_path, week, "Counters_2025-11-28.csv", ["ENTITY,APCCounter", "F28_GTA101_PM,2"], dt.datetime(2025, 12, 17, 3, 10, 11))
    write_csv(tmp_path, week, "Counters_2025-12-16.csv", ["ENTITY,APCCounter", "F28_GTA101_PM,3"], dt.datetime(2025, 12, 16, 3, 8, 45))
    write_csv(tmp_path, week, "Other_2025-12-19.csv", ["ENTITY,APCCounter", "x,4"], dt.datetime(2025, 12, 19))
    loaded = csv.bronze_counters(spark, str(tmp_path), ASOF, LOAD_TS)
    assert rows(loaded.rows, "FAB", "source_file", "counter_date", "APCCounter", "load_ww", "file_modified_ts") == [
        ("F28", "Counters_2025-11-29.csv", dt.date(2025, 12, 17), D("1.00"), week, dt.datetime(2025, 12, 18, 3, 15, 23))
    ]


def test_files_modified_at_the_same_time(spark, tmp_path):
    for name in ("Counters_a.csv", "Counters_b.csv"):
        write_csv(tmp_path, "2025WW52", name, ["ENTITY,APCCounter", "E,1"], dt.datetime(2025, 12, 18))
    weeks = recent_work_weeks(spark, ASOF)
    assert csv.discover_counter_files(spark, str(tmp_path), weeks).first().path.endswith("Counters_b.csv")


def test_counter_columns_differ_between_files(spark, tmp_path):
    write_csv(tmp_path, "2025WW52", "Counters_1.csv", ["ENTITY,FocusRingCounter,APCCounter", "F1_A_PC,10,", "F1_B_PM,NaN,7.5"], dt.datetime(2025, 12, 17))
    write_csv(tmp_path, "2025WW51", "Counters_1.csv", ["PMACounter,FAB,APCCounter,ENTITY", "5,F9,x,F1_A_PM", "6,,1,F1_C_PM"], dt.datetime(2025, 12, 10))
    loaded = csv.bronze_counters(spark, str(tmp_path), ASOF, LOAD_TS)
    counters = [name for name in loaded.rows.columns if name.endswith("Counter")]
    assert counters == ["FocusRingCounter", "APCCounter", "PMACounter"]
    assert rows(loaded.rows, "FAB_ENTITY", "counter_date", *counters) == [
        ("F1_F1_A_PM", dt.date(2025, 12, 16), D("10.00"), None, None),
        ("F1_F1_B_PM", dt.date(2025, 12, 16), None, D("7.50"), None),
        ("F9_F1_A_PM", dt.date(2025, 12, 9), None, None, D("5.00")),
        ("nan_F1_C_PM", dt.date(2025, 12, 9), None, D("1.00"), D("6.00")),
    ]


def test_bad_files_are_rejected_and_others_go_on(spark, tmp_path):
    write_csv(tmp_path, "2025WW52", "Counters_1.csv", ["TOOL,APCCounter", "E,1"], dt.datetime(2025, 12, 17))
    write_csv(tmp_path, "2025WW51", "Counters_1.csv", [""], dt.datetime(2025, 12, 10))
    write_csv(tmp_path, "2025WW50", "Counters_1.csv", ["ENTITY,APCCounter", "E,1"], dt.datetime(2025, 12, 3))
    loaded = csv.bronze_counters(spark, str(tmp_path), ASOF, LOAD_TS)
    assert rows(loaded.rows, "ENTITY", "load_ww") == [("E", "2025WW50")]
    assert rows(loaded.report, "ww", "loaded", "reason") == [
        ("2025WW50", True, None),
        ("2025WW51", False, "no columns could be read"),
        ("2025WW52", False, "missing required columns: ENTITY"),
    ]


def test_no_files_give_typed_empty_tables(spark, tmp_path):
    states = csv.bronze_states(spark, str(tmp_path), ASOF, LOAD_TS).rows
    counters = csv.bronze_counters(spark, str(tmp_path), ASOF, LOAD_TS).rows
    assert states.count() == 0 and dict(states.dtypes)["HOURS_IN_STATE"] == "decimal(10,2)"
    assert counters.count() == 0 and {"FAB_ENTITY", "counter_date"} <= set(counters.columns)


def test_states_latin1_and_utf8_files(spark, tmp_path):
    line = "F1,WW,12/01-Day,{},E_PC,1.5,24,0.0625"
    write_csv(tmp_path, "2025WW52", "EntityStates.csv", [STATE_HEADER, line.format("Störung")], dt.datetime(2025, 12, 17), "latin-1")
    write_csv(tmp_path, "2025WW51", "EntityStates.csv", [STATE_HEADER, line.format("Prüfung")], dt.datetime(2025, 12, 10))
    loaded = csv.bronze_states(spark, str(tmp_path), ASOF, LOAD_TS)
    assert rows(loaded.rows, "ENTITY_STATE", "ENTITY", "HOURS_IN_STATE", "`% in State`", "load_date") == [
        ("Prüfung", "E_PM", D("1.50"), D("0.0625"), LOAD_TS.date()),
        ("Störung", "E_PM", D("1.50"), D("0.0625"), LOAD_TS.date()),
    ]
    assert rows(loaded.report, "ww", "encoding") == [("2025WW51", "UTF-8"), ("2025WW52", "ISO-8859-1")]


def test_missing_and_extra_columns_are_reported(spark, tmp_path):
    header = "FAB,ENTITY,ENTITY_STATE,HOURS_IN_STATE,DAY_SHIFT,Comment"
    write_csv(tmp_path, "2025WW52", "EntityStates.csv", [header, 'F1,E,"A, ""b""",2,12/01-Day,NA'], dt.datetime(2025, 12, 17))
    loaded = csv.bronze_states(spark, str(tmp_path), ASOF, LOAD_TS)
    row = loaded.report.first()
    assert (row.missing, row.extra, row.loaded) == (["% in State", "Total_Hours", "WW"], ["Comment"], True)
    assert rows(loaded.rows, "ENTITY_STATE", "Comment", "WW") == [('A, "b"', None, None)]


@pytest.mark.parametrize("prefer, expected", [("oldest", "2025WW51"), ("newest", "2025WW52")])
def test_duplicates_between_and_within_files(spark, tmp_path, prefer, expected):
    for week, base in (("2025WW52", 20), ("2025WW51", 10)):
        lines = [f"F1,WW,12/01-Day,Running1,E,{base + i},24,0" for i in range(5)]
        write_csv(tmp_path, week, "EntityStates.csv", [STATE_HEADER, *lines], dt.datetime(2025, 12, 17))
    loaded = csv.bronze_states(spark, str(tmp_path), ASOF, LOAD_TS, prefer=prefer)
    hours = {"2025WW51": D("14.00"), "2025WW52": D("24.00")}[expected]
    assert rows(loaded.rows, "load_ww", "HOURS_IN_STATE") == [(expected, hours)]


def test_last_row_wins_in_a_file_of_many_splits(spark, tmp_path):
    lines = [f"F1,WW,12/01-Day,Running1,E{i % 7},{i},24,0" for i in range(5000)]
    write_csv(tmp_path, "2025WW52", "EntityStates.csv", [STATE_HEADER, *lines], dt.datetime(2025, 12, 17))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        loaded = csv.bronze_states(spark, str(tmp_path), ASOF, LOAD_TS)
        got = rows(loaded.rows, "ENTITY", "HOURS_IN_STATE")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted((f"E{i % 7}", D(f"{i}.00")) for i in range(4993, 5000))


def test_incremental_takes_the_current_week_only(spark, tmp_path):
    for week in ("2025WW52", "2025WW51"):
        write_csv(tmp_path, week, "EntityStates.csv", [STATE_HEADER, "F1,WW,12/01-Day,Running1,E,1,24,0"], dt.datetime(2025, 12, 17))
    loaded = csv.bronze_states(spark, str(tmp_path), ASOF, LOAD_TS, mode="incremental")
    assert rows(loaded.rows, "load_ww") == [("2025WW52",)]
    with pytest.raises(ValueError):
        csv.bronze_states(spark, str(tmp_path), ASOF, LOAD_TS, mode="daily")


def test_write_modes_and_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert tables.read_table(spark, path) is None and tables.row_count(spark, path) == 0
    assert tables.write_table(df, path, "fail") == 2
    assert tables.write_table(df, path) == 2
    assert tables.write_table(df.where("false"), path) == 0
    assert tables.row_count(spark, path) == 4
    assert tables.write_table(df.limit(1), path, "replace") == 1
    assert tables.row_count(spark, path) == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_table(df, path, "fail")
    tables.truncate(spark, path)
    assert tables.row_count(spark, path) == 0 and tables.read_table(spark, path).columns == ["k", "v"]
    with pytest.raises(ValueError):
        tables.write_table(df, path, "merge")


def test_upsert_replaces_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "ENTITY string, day date, v int"
    d1, d2, d3 = (dt.date(2025, 1, n) for n in (1, 2, 3))
    first = spark.createDataFrame([("a", d1, 1), ("b", d1, 2), ("a", d2, 3)], schema)
    second = spark.createDataFrame([("a", d2, 30), ("c", d2, 4), ("a", d3, 5), ("a", d3, 6)], schema)
    tables.upsert(first, path, ["ENTITY", "day"], "day", ["v"], ["ENTITY"])
    untouched = (tmp_path / "t" / "day=2025-01-01").stat().st_mtime_ns
    for _ in range(2):
        tables.upsert(second, path, ["ENTITY", "day"], "day", ["v"], ["ENTITY"])
        assert rows(tables.read_table(spark, path), "ENTITY", "day", "v") == [
            ("a", d1, 1), ("a", d2, 30), ("a", d3, 6), ("b", d1, 2), ("c", d2, 4),
        ]
    assert (tmp_path / "t" / "day=2025-01-01").stat().st_mtime_ns == untouched
    undated = spark.createDataFrame([("a", None, 7)], schema)
    for _ in range(2):
        tables.upsert(undated, path, ["ENTITY", "day"], "day", ["v"])
    assert rows(tables.read_table(spark, path).where("day is null"), "ENTITY", "v") == [("a", 7)]
    wider = spark.createDataFrame([("z", d3, "new")], "ENTITY string, day date, note string")
    tables.upsert(wider, path, ["ENTITY", "day"], "day")
    merged = tables.read_table(spark, path, merge_schema=True)
    assert rows(merged.where(merged.day == d3), "ENTITY", "v", "note") == [("a", 6, None), ("z", None, "new")]
    with pytest.raises(ValueError):
        tables.upsert(second, path, ["ENTITY"], "day")


def test_week_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("2025WW52", 1), ("2025WW51", 2), ("2025WW40", 3)], "load_ww string, v int")
    tables.write_table(df, path, partition_by="load_ww")
    recent = by_mode(tables.read_table(spark, path), "full", ASOF)
    assert rows(recent, "v") == [(1,), (2,)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2025WW52" in partition_filters and "load_ww" in partition_filters


def test_curated_tables_lose_blanks_in_column_names(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "` Qty ` int, Part int").write.parquet(str(tmp_path / "inv"))
    assert tables.read_curated(spark, {"inv": str(tmp_path / "inv")})["inv"].columns == ["Qty", "Part"]


def test_lines_with_surplus_cells_are_reported_and_their_file_is_rejected(spark, tmp_path):
    lines = [f"E{i},{i}" for i in range(400)]
    lines[250] = "E250,1,2"
    lines[300] = '"E,300",1,"2, 3",4'
    write_csv(tmp_path, "2025WW52", "Counters_1.csv", ["ENTITY,APCCounter", "", *lines], dt.datetime(2025, 12, 17))
    write_csv(tmp_path, "2025WW51", "Counters_1.csv", ["ENTITY,APCCounter,ESCCounter", '"A, ""b""",1', "C"], dt.datetime(2025, 12, 10))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        files = csv.discover_counter_files(spark, str(tmp_path), recent_work_weeks(spark, ASOF))
        loads = {ragged: csv.read_counters(spark, files, LOAD_TS, ragged=ragged, normalize=False) for ragged in ("reject", "report", "cut")}
        bad = [("2025WW52", 253, "3 cells, the header has 2", "E250,1,2"), ("2025WW52", 303, "4 cells, the header has 2", '"E,300",1,"2, 3",4')]
        for ragged, n in (("reject", 2), ("report", 400), ("cut", 402)):
            loaded = loads[ragged]
            assert rows(loaded.rejected, "ww", "line", "reason", "text") == bad
            assert loaded.rows.count() == n
            assert rows(loaded.report, "ww", "reason") == [("2025WW51", None), ("2025WW52", "lines of more than 2 cells" if ragged == "reject" else None)]
        assert rows(loads["report"].rows.where("load_ww = '2025WW51'"), "ENTITY", "APCCounter", "ESCCounter") == [('A, "b"', D("1.00"), None), ("C", None, None)]
        assert rows(loads["cut"].rows.where("ENTITY = 'E250'"), "APCCounter") == [(D("1.00"),)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(ValueError):
        csv.read_counters(spark, files, LOAD_TS, ragged="skip")


def test_one_scan_of_the_text_and_files_with_quoted_breaks(spark, tmp_path):
    line = "F1,WW,12/01-Day,{},E_PC,1.5,24,0.0625"
    write_csv(tmp_path, "2025WW52", "EntityStates.csv", [STATE_HEADER, line.format("Störung")], dt.datetime(2025, 12, 17), "latin-1")
    write_csv(tmp_path, "2025WW51", "EntityStates.csv", [STATE_HEADER, line.format("Prüfung"), line.format('5" pipe')], dt.datetime(2025, 12, 10))
    write_csv(tmp_path, "2025WW50", "EntityStates.csv", [STATE_HEADER, line.format('"Two\nlines, ""q"""'), line.format("x")], dt.datetime(2025, 12, 3))
    loaded = csv.bronze_states(spark, str(tmp_path), ASOF, LOAD_TS)
    told = {"Störung", "Prüfung", '5" pipe', 'Two\nlines, "q"', "x"}
    assert {row.ENTITY_STATE for row in loaded.rows.collect()} == told
    assert loaded.rejected.count() == 0
    # Lines are stored once, as bytes; only the file with a break in a cell is read by itself, unsplit.
    plan = loaded.rows._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[0]
    assert plan.count("FileScan text") == 0 and plan.count("FileScan csv") == 1
    broken = csv.read_states(spark, csv.discover_state_files(spark, str(tmp_path), recent_work_weeks(spark, ASOF)), LOAD_TS, multiline=False, ragged="report")
    assert broken.rows.where("load_ww = '2025WW50'").count() > 2
