"""The stored job: touched days, days without a year, rewritten files in the stream, column order, retention, publication."""

from __future__ import annotations

import datetime as dt

import pytest
from files import STATE_HEADER, rows, write_csv
from pyspark.sql import functions as F

from fleetlens import params
from fleetlens.functions import fiscal_work_week
from fleetlens.operators import touched
from fleetlens.operators.production import production_details
from fleetlens.plans import layers, marts, retention
from fleetlens.plans.fixtures import STOCK_ORDER, TOOLS_ASOF, Fixtures
from fleetlens.sources import tables
from fleetlens.streaming import arrivals

KEYS = "ENTITY string, day date"


def job(spark, folder, day, mode="incremental", store="store", **more):
    return layers.Job(spark, str(folder / "in"), str(folder / store), day, dt.datetime.combine(day, dt.time(12)), mode, **more)


def states(folder, week, *told, year="/2025", modified=dt.datetime(2025, 12, 17)):
    lines = [f"F28,x,{month:02d}/{day:02d}{year}-Day,{state},{tool}_PC,{hours},24,0.5" for tool, month, day, state, hours in told]
    write_csv(folder / "in", week, "EntityStates.csv", [STATE_HEADER, *lines], modified)


def counters(folder, week, day, *told, columns="FocusRingCounter"):
    lines = [f"{tool}_PC,{','.join(map(str, readings))}" for tool, *readings in told]
    write_csv(folder / "in", week, f"Counters_{day}.csv", [f"ENTITY,{columns}", *lines], dt.datetime.combine(day + dt.timedelta(days=1), dt.time(3)))


def days(n):
    return dt.date(2025, 12, n)


def same_tables(spark, left, right):
    for table in params.NATURAL_KEYS:
        one, other = (tables.read_table(spark, side.path(table), merge_schema=True) for side in (left, right))
        assert (one is None) == (other is None), table
        if one is not None:
            columns = sorted(f"`{c}`" for c in other.columns if not c.endswith(("_ts", "timestamp", "load_date")))
            assert rows(one, *columns) == rows(other, *columns), table


def test_changed_keys_and_their_neighbours(spark):
    schema = "ENTITY string, day date, v int, load_ts string"
    old = spark.createDataFrame([("a", days(1), 1, "x"), ("a", days(2), 2, "x"), ("b", days(1), 3, "x"), ("c", days(1), 4, "x"), (None, days(1), 4, "x")], schema)
    new = spark.createDataFrame([("a", days(1), 1, "y"), ("a", days(2), 9, "y"), ("b", days(1), 3, "y"), ("b", days(1), 3, "y"), ("d", days(3), None, "y")], schema)
    got = touched.changed_keys(new, old, ["ENTITY", "day", "v"], "day")
    assert rows(got, "ENTITY", "day") == [("a", days(2)), ("b", days(1)), ("c", days(1)), ("d", days(3))]
    told = spark.createDataFrame([("a", days(n)) for n in (1, 4, 9)] + [("b", days(2))], KEYS)
    keys = spark.createDataFrame([("a", days(4)), ("a", days(2)), ("a", days(9)), ("b", days(1)), ("z", days(1))], KEYS)
    assert rows(touched.following(keys, told), "ENTITY", "day") == [("a", days(4)), ("a", days(9)), ("b", days(2))]
    asked = spark.createDataFrame([("a", days(9)), ("b", days(2))], KEYS)
    assert rows(touched.with_previous(asked, told), "ENTITY", "day") == [("a", days(4)), ("a", days(9)), ("b", days(2))]


def test_production_of_keys_equals_that_of_all(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    raw = fx.counters.withColumn("FAB_ENTITY", F.concat_ws("_", "FAB", "ENTITY"))
    hours = raw.select("ENTITY", F.col("counter_date").alias("state_date"), F.lit(7.5).cast(params.HOURS).alias("running_hours"))
    known = raw.select("ENTITY", F.col("counter_date").alias("day")).distinct()
    keys = known.where(F.crc32(F.concat("ENTITY", F.col("day").cast("string")).cast("binary")) % 5 == 0).checkpoint()
    needed = touched.only(raw, touched.with_previous(keys, known), "counter_date")
    got, whole = touched.production_of(keys, needed, hours), touched.only(production_details(raw, hours), keys, "counter_date")
    assert keys.count() > 20 and rows(got, "*") == rows(whole, "*")


def test_only_touched_tool_days_are_computed_in_any_order_of_loads(spark, tmp_path):
    tools = [f"T{i}" for i in range(6)]
    weeks = {"2025WW50": 2, "2025WW51": 9, "2025WW52": 16}

    def write(week, late=0):
        n = weeks[week]
        counters(tmp_path, week, days(n), *[(tool, 1000 * n + i + late * (i == 2)) for i, tool in enumerate(tools)])
        states(tmp_path, week, *[(tool, 12, n + d, "Running1", 10 + d + late * (i == 1 and d == 0)) for i, tool in enumerate(tools) for d in (0, 1)])

    def loaded(run, *order):
        for week in order:
            wanted = spark.createDataFrame([(week, 1)], "ww string, rank long")
            layers.load_states(run, wanted)
            layers.load_counters(run, wanted)
        layers.run_silver(run)
        layers.run_gold(run)

    for week in weeks:
        write(week)
    # The newest week first, then the two before it.
    loaded(job(spark, tmp_path, days(17), store="mixed"), "2025WW52")
    loaded(job(spark, tmp_path, days(17), store="mixed"), "2025WW50", "2025WW51")
    write("2025WW51", late=5)
    again = job(spark, tmp_path, days(18), store="mixed")
    loaded(again, "2025WW51")

    def computed(table):
        stamp = F.col("calculation_timestamp") == F.lit(again.load_ts).cast("timestamp_ntz")
        return spark.read.parquet(again.path(table)).where(stamp).count()

    # One tool's hours of a day; another one's reading of that day, and the change from there to its next reading.
    assert computed("state_hours") == 1 and computed("wafer_production") == 3
    assert computed("fact_state_hours_daily") == 1 and computed("fact_daily_production") == 3
    full = job(spark, tmp_path, days(18), "full", store="full")
    layers.run(full)
    same_tables(spark, again, full)
    # Read again, nothing differs and nothing is noted.
    layers.load_states(again, spark.createDataFrame([("2025WW51", 1)], "ww string, rank long"))
    assert layers._noted(again, "silver", "entity_states_raw").count() == 0
    # Neither side of the search for weeks shuffles the index.
    index = spark.table(again.days_index("counters_raw"))
    keys = spark.createDataFrame([("T1_PM", days(2))], KEYS).repartition(3).hint("shuffle_merge")
    plan = keys.join(index.hint("shuffle_merge"), touched.KEY[:1], "inner")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_days_without_a_year_stay_in_the_year_of_their_load(spark, tmp_path):
    first = job(spark, tmp_path, dt.date(2025, 12, 30))
    week = layers.recent_work_weeks(spark, dt.date(2025, 12, 30), 1).first().ww
    counters(tmp_path, week, dt.date(2025, 12, 29), ("T1", 100))
    states(tmp_path, week, ("T1", 12, 29, "Running1", 10), year="")
    layers.run(first, "bronze")
    before = rows(layers.run(first, "silver")["state_hours"], "state_date", "running_hours")
    assert [row[0] for row in before] == [dt.date(2025, 12, 29)]
    # Read again in January, from the store and from the file.
    for mode in ("incremental", "full"):
        january = job(spark, tmp_path, dt.date(2026, 1, 7), mode)
        layers.run(january, "bronze")
        assert rows(layers.run(january, "silver")["state_hours"], "state_date", "running_hours") == before


def test_counter_columns_keep_their_order(spark, tmp_path):
    this = job(spark, tmp_path, days(17), "full")
    counters(tmp_path, "2025WW50", days(2), ("T1", 10, 20), columns="FocusBCounter,FocusACounter")
    layers.load_counters(this, spark.createDataFrame([("2025WW50", 3)], "ww string, rank long"))
    counters(tmp_path, "2025WW51", days(9), ("T1", 31, 12), columns="FocusACounter,FocusBCounter")
    layers.load_counters(this, spark.createDataFrame([("2025WW51", 2)], "ww string, rank long"))
    stored = layers._in_order(this, "counters_raw", this.stored("counters_raw", merge_schema=True))
    assert [c for c in stored.columns if c.endswith("Counter")] == ["FocusBCounter", "FocusACounter"]
    made = production_details(stored, spark.createDataFrame([], "ENTITY string, state_date date, running_hours decimal(10,2)"))
    assert rows(made, "counter_column_used", "counter_change") == [("FocusBCounter", 2), ("FocusBCounter", None)]


def test_a_file_rewritten_under_its_name_is_loaded_again(spark, tmp_path):
    this, seen = job(spark, tmp_path, days(17)), []

    def load(of, weeks):
        seen.append([row.ww for row in weeks.collect()])

    def arrived():
        seen.clear()
        arrivals.start(this, "EntityStates.csv", load, str(tmp_path / "checkpoint")).awaitTermination(120)
        return seen

    states(tmp_path, "2025WW51", ("T1", 12, 9, "Running1", 1))
    states(tmp_path, "2025WW52", ("T1", 12, 16, "Running1", 1))
    (tmp_path / "in" / "archive").mkdir()
    (tmp_path / "in" / "archive" / "EntityStates.csv").write_text("x")
    assert [sorted(weeks) for weeks in arrived()] == [["2025WW51", "2025WW52"]]
    assert arrived() == []
    states(tmp_path, "2025WW52", ("T1", 12, 16, "Running1", 22), modified=dt.datetime(2025, 12, 18))
    assert arrived() == [["2025WW52"]] and arrived() == []


def test_expired_partitions_go_unless_a_last_reading_is_in_there(spark, tmp_path):
    this = job(spark, tmp_path, days(31))
    old, new = dt.date(2025, 7, 1), days(30)
    weeks = {day: spark.range(1).select(fiscal_work_week(F.lit(day))).first()[0] for day in (old, old + dt.timedelta(days=7), new)}
    told = [("T1", old), ("T2", old), ("T1", old + dt.timedelta(days=7)), ("T1", new)]
    raw = spark.createDataFrame([(tool, day, weeks[day]) for tool, day in told], "ENTITY string, counter_date date, load_ww string")
    tables.write_table(raw, this.path("counters_raw"), partition_by="load_ww")
    index = raw.select("ENTITY", F.col("counter_date").alias("day"), "load_ww")
    tables.replace_bucketed(index, this.days_index("counters_raw"), "load_ww", "ENTITY", sorted(weeks.values()))
    hours = spark.createDataFrame([("T1", dt.date(2024, 1, 1), 1), ("T1", new, 2)], "ENTITY string, state_date date, v int")
    tables.write_table(hours, this.path("state_hours"), partition_by="state_date")
    facts = spark.createDataFrame([("T1", "2024WW40", 1), ("T1", "2025WW01", 2)], "ENTITY string, YEARWW string, v int")
    tables.write_table(facts, this.path("fact_weekly_production"), partition_by="YEARWW")
    listed = [(part.table, part.partition, part.kept_for) for part in retention.retain_tables(this)]
    assert listed == [
        ("counters_raw", weeks[old], 1), ("counters_raw", weeks[old + dt.timedelta(days=7)], 0),
        ("state_hours", "2024-01-01", 0), ("fact_weekly_production", "2024WW40", 0),
    ]
    assert tables.row_count(spark, this.path("counters_raw")) == 4  # a dry run
    retention.retain_tables(this, dry_run=False)
    assert rows(spark.read.parquet(this.path("counters_raw")), "ENTITY", "counter_date") == [("T1", old), ("T1", new), ("T2", old)]
    assert spark.table(this.days_index("counters_raw")).count() == 3
    assert rows(spark.read.parquet(this.path("state_hours")), "v") == [(2,)] and rows(spark.read.parquet(this.path("fact_weekly_production")), "v") == [(2,)]
    assert [part.goes for part in retention.retain_tables(this)] == [False]


def test_marts_change_places_together(spark, tmp_path, monkeypatch):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    tools = fx.tools.withColumn("ENTITY", F.replace("ENTITY", F.lit("_"), F.lit("-")))
    sources = {"cur_inventory": fx.inventory, "cur_auto_tool_list_mom": tools, "cur_gbom_applicability": fx.gbom}
    store = str(tmp_path / "out")
    first = {name: rows(df, *df.columns) for name, df in marts.run_installed_base(spark, sources, store, TOOLS_ASOF, STOCK_ORDER).items()}
    # A crash after the first of three moves: the next run completes the publication before anything else.
    moved, move = [], tables._moved

    def crash(files, source, target):
        if len(moved) == 2:
            raise OSError("lost")
        moved.append(target)
        move(files, source, target)

    fewer = {**sources, "cur_inventory": fx.inventory.where("l_linenumber = 1")}
    monkeypatch.setattr(tables, "_moved", crash)
    with pytest.raises(OSError):
        marts.run_installed_base(spark, fewer, store, TOOLS_ASOF, STOCK_ORDER)
    monkeypatch.setattr(tables, "_moved", move)
    tables.recover(spark, store)
    second = {name: spark.read.parquet(f"{store}/{name}") for name in marts.MARTS}
    assert second["mart_inventory_installed_base_leadership"].count() == fewer["cur_inventory"].select("Part_Number").distinct().count()
    assert rows(second["mart_installed_base_by_config"], *second["mart_installed_base_by_config"].columns) == first["mart_installed_base_by_config"]
    assert tables.read_table(spark, f"{store}/_publishing") is None
    # A failed check replaces nothing.
    bad = {**sources, "cur_auto_tool_list_mom": tools.withColumn("ENTITY", F.concat("ENTITY", F.lit("_")))}
    with pytest.raises(ValueError):
        marts.run_installed_base(spark, bad, store, TOOLS_ASOF)
    assert spark.read.parquet(f"{store}/{marts.MARTS[2]}").count() == second["mart_inventory_installed_base_leadership"].count()


def test_partitions_with_odd_names_are_emptied(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "v int, p string"
    tables.replace_partitions(spark.createDataFrame([(1, None), (2, "a:b/c=d%"), (3, "e")], schema), path, "p", F.lit(True))
    assert tables.partition_folders(spark, path) == ["__HIVE_DEFAULT_PARTITION__", "a:b/c=d%", "e"]
    tables.replace_partitions(spark.createDataFrame([(4, "e")], schema), path, "p", F.lit(True))
    assert rows(tables.read_table(spark, path), "v", "p") == [(4, "e")]
    tables.drop_partitions(spark, path, "p", ["a:b/c=d%"])
    assert "a:b/c=d%" not in tables.partition_folders(spark, path)
