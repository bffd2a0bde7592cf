from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from files import STATE_HEADER, rows, write_csv
from pyspark.sql import functions as F

from fleetlens import params
from fleetlens.operators.quality import null_violations, unique_violations
from fleetlens.plans import layers, marts
from fleetlens.plans.fixtures import STOCK_ORDER, TOOLS_ASOF, Fixtures
from fleetlens.sources.tables import read_table
from fleetlens.streaming import arrivals

TOOL = "F28_GTA101_PC"
DAYS = [dt.date(2025, 12, n) for n in (2, 9, 16)]
WEEKS = ["2025WW50", "2025WW51", "2025WW52"]
READINGS = [(15000, 41000), (17500, 43200), (250, 45000)]
RUNNING = [20, 22, 18]


def write_week(root, i):
    day, (focus, apc) = DAYS[i], READINGS[i]
    modified = dt.datetime.combine(day + dt.timedelta(days=1), dt.time(3))
    write_csv(root, WEEKS[i], f"Counters_{day}.csv", ["ENTITY,FocusRingCounter,APCCounter", f"{TOOL},{focus},{apc}"], modified)
    shift = day.strftime("%m/%d/%Y-Day")
    lines = [
        f"F28,x,{shift},Running1,{TOOL},{RUNNING[i]},24,0.9",
        f"F28,x,{shift},UpToProduction,{TOOL},{23.5 - RUNNING[i]},24,0.05",
        f"F28,x,{shift},Repair,{TOOL},0.5,24,0.02",
    ]
    write_csv(root, WEEKS[i], "EntityStates.csv", [STATE_HEADER, *lines], modified)


def job(spark, tmp_path, day, mode="full", store="store"):
    return layers.Job(
        spark, str(tmp_path / "in"), str(tmp_path / store), day, dt.datetime.combine(day, dt.time(12)), mode
    )


PRODUCTION = ["counter_date", "counter_column_used", "counter_change", "wafers_produced", "calculation_notes"]
EXPECTED = [
    (DAYS[0], "FocusRingCounter", None, None, "First day - no previous value"),
    (DAYS[1], "FocusRingCounter", D("2500.00"), D("2500.00"), None),
    (
        DAYS[2], "APCCounter", D("1800.00"), D("1800.00"),
        "Part replacement: FocusRingCounter reset from 17500.0 to 250.0; Used fallback counter: APCCounter",
    ),
]


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    """Folder of a full run over three weeks, and its tables."""
    folder = tmp_path_factory.mktemp("full")
    for i in range(3):
        write_week(folder / "in", i)
    return folder, layers.run(job(spark, folder, dt.date(2025, 12, 17)))


def comparable(df):
    return [f"`{c}`" for c in df.columns if not c.endswith(("_ts", "timestamp", "load_date"))]


def test_full_run_gives_all_tables(full):
    _, tables = full
    assert set(params.NATURAL_KEYS) <= set(tables)
    assert rows(tables["wafer_production"], *PRODUCTION) == EXPECTED
    rates = rows(tables["wafer_production"], F.round("wafers_per_hour", 1))
    assert sorted(r[0] or 0 for r in rates) == [0, 100.0, 113.6]
    assert rows(tables["part_replacements"], "replacement_date", "part_counter_name", "value_drop") == [
        (DAYS[2], "APCCounter", D("-1800.00"))
    ]
    assert rows(tables["fact_weekly_production"], "YEARWW", "total_wafers_produced", "part_replacements_count") == [
        ("2025WW49", D("0.00"), 0), ("2025WW50", D("2500.00"), 0), ("2025WW51", D("1800.00"), 1),
    ]
    assert rows(tables["fact_state_hours_weekly"], "YEARWW", "total_hours", "days_with_data") == [
        ("2025WW49", D("24.00"), 1), ("2025WW50", D("24.00"), 1), ("2025WW51", D("24.00"), 1),
    ]


def test_tables_keep_their_keys(full):
    _, tables = full
    for table, keys in params.NATURAL_KEYS.items():
        assert unique_violations(tables[table], keys).count() == 0, table
        assert null_violations(tables[table], params.REQUIRED_COLUMNS[table]).where("n_nulls > 0").count() == 0, table


def test_weekly_incremental_runs_equal_one_full_run(spark, tmp_path, full):
    for i in (0, 1, 2, 2):
        write_week(tmp_path / "in", i)
        last = layers.run(job(spark, tmp_path, DAYS[i] + dt.timedelta(days=1), "incremental"))
    for table in params.NATURAL_KEYS:
        columns = comparable(full[1][table])
        assert rows(last[table], *columns) == rows(full[1][table], *columns), table


def test_layers_run_alone_and_in_order(spark, tmp_path):
    write_week(tmp_path / "in", 2)
    this = job(spark, tmp_path, dt.date(2025, 12, 17))
    with pytest.raises(ValueError, match="run the layer before"):
        layers.run(this, "silver")
    with pytest.raises(ValueError):
        layers.run(this, "platinum")
    assert set(layers.run(this, "bronze")) == {
        "entity_states_raw", "entity_states_raw_files", "counters_raw", "counters_raw_files",
    }
    assert layers.run(this, "silver")["part_replacements"].count() == 0
    assert "fact_daily_production" in layers.run(this, "gold")


def test_stream_of_arrivals_equals_batch_load(spark, tmp_path, full):
    this = job(spark, tmp_path, dt.date(2025, 12, 17))
    kinds = {"states": ("EntityStates.csv", arrivals.load_states), "counters": ("Counters_*.csv", arrivals.load_counters)}
    for weeks in ((0, 1), (2,)):
        for i in weeks:
            write_week(tmp_path / "in", i)
        for kind, (pattern, load) in kinds.items():
            arrivals.start(this, pattern, load, str(tmp_path / kind)).awaitTermination(120)
    for table in ("entity_states_raw", "counters_raw"):
        columns = comparable(full[1][table])
        assert rows(read_table(spark, this.path(table)), *columns) == rows(full[1][table], *columns)


def test_installed_base_job(spark, tmp_path):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    tools = fx.tools.withColumn("ENTITY", F.replace("ENTITY", F.lit("_"), F.lit("-")))
    sources = {"cur_inventory": fx.inventory, "cur_auto_tool_list_mom": tools, "cur_gbom_applicability": fx.gbom}
    paths = {name: str(tmp_path / name) for name in sources}
    for name, df in sources.items():
        df.write.parquet(paths[name])
    stored = marts.run_installed_base(spark, paths, str(tmp_path / "out"), TOOLS_ASOF, STOCK_ORDER)
    assert stored["mart_inventory_installed_base_leadership"].count() == fx.inventory.select("Part_Number").distinct().count()
    assert stored["mart_inventory_installed_base_drilldown"].count() == fx.gbom.count()
    tools.withColumn("ENTITY", F.concat("ENTITY", F.lit("_1"))).write.mode("overwrite").parquet(paths["cur_auto_tool_list_mom"])
    with pytest.raises(ValueError, match="checks failed: A"):
        marts.run_installed_base(spark, paths, str(tmp_path / "out"), TOOLS_ASOF)
