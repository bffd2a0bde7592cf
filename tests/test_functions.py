from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlens import functions as fn

ASOF = dt.date(2024, 6, 30)


def column(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.select("i", build(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_parse_day_shift(spark):
    cases = {
        "01/05-Day": dt.date(2024, 1, 5),
        "1/5-Night": dt.date(2024, 1, 5),
        "1/ 5-x": dt.date(2024, 1, 5),
        "12/31/2023-Day": dt.date(2023, 12, 31),
        "1/2/69-x": dt.date(1969, 1, 2),
        "1/2/68-x": dt.date(2068, 1, 2),
        "02/29/24-x": dt.date(2024, 2, 29),
        "02/29-x": None,
        "02/30/2024-x": None,
        "01/05 -x": None,
        "13/01-x": None,
        "1/2/0000-x": None,
        "1/2/024-x": None,
        "2024-01-05": None,
        "": None,
        None: None,
    }
    assert column(spark, list(cases), "string", lambda c: fn.parse_day_shift(c, ASOF)) == list(cases.values())


@pytest.mark.parametrize(
    "anchor, day, label",
    [
        ("on_or_before", dt.date(2025, 12, 17), "2025WW52"),
        ("nearest", dt.date(2025, 12, 17), "2025WW51"),
        ("on_or_before", dt.date(2024, 12, 29), "2024WW54"),
        ("on_or_before", dt.date(2024, 12, 30), "2025WW02"),
        ("nearest", dt.date(2021, 1, 2), "2020WW53"),
    ],
)
def test_fiscal_work_week(spark, anchor, day, label):
    assert column(spark, [day, None], "date", lambda c: fn.fiscal_work_week(c, anchor)) == [label, None]


def test_fiscal_weeks_advance_by_one_every_sunday(spark):
    days = [dt.date(2019, 12, 1) + dt.timedelta(days=i) for i in range(2500)]
    for anchor in ("on_or_before", "nearest"):
        labels = column(spark, days, "date", lambda c: fn.fiscal_work_week(c, anchor))
        for before, after, day in zip(labels, labels[1:], days[1:]):
            if before[:4] == after[:4]:
                assert int(after[6:]) - int(before[6:]) == (1 if day.weekday() == 6 else 0), day


def test_iso_yearww(spark):
    days = [dt.date(2024, 12, 30), dt.date(2021, 1, 1), dt.date(2025, 12, 17)]
    assert column(spark, days, "date", fn.iso_yearww) == ["2024WW01", "2021WW53", "2025WW51"]
    assert column(spark, days, "date", lambda c: fn.iso_yearww(c, "iso")) == ["2025WW01", "2020WW53", "2025WW51"]


def test_unknown_options_are_refused(spark):
    with pytest.raises(ValueError):
        fn.fiscal_work_week(F.lit(ASOF), "first")
    with pytest.raises(ValueError):
        fn.iso_yearww(F.lit(ASOF), "fiscal")


def test_counter_date(spark):
    stamps = [dt.datetime(2025, 12, 18, 3, 15, 23), dt.datetime(2025, 3, 1), None]
    assert column(spark, stamps, "timestamp", fn.counter_date) == [dt.date(2025, 12, 17), dt.date(2025, 2, 28), None]


def test_age_bucket_edges(spark):
    days = [0, 365, 366, 1095, 1096, 1826, 1827, -10]
    starts = [str(ASOF - dt.timedelta(days=n)) for n in days] + [None, "bad", f"{ASOF - dt.timedelta(days=1)} 10:00:00"]
    got = column(spark, starts, "string", lambda c: fn.tool_age_days(c, ASOF))
    assert got == [*days, None, None, 0]
    buckets = column(spark, got, "long", fn.age_bucket)
    assert buckets == [
        "0_1Y", "0_1Y", "1_3Y", "1_3Y", "3_5Y", "3_5Y", "5P_Y", "0_1Y", "UnknownAge", "UnknownAge", "0_1Y",
    ]


def test_to_int(spark):
    cases = {"5": 5, " 6 ": 6, "7.0": 7, "1e3": 1000, "7.5": None, "n/a": None, "1d": None, "NaN": None, "": None, None: None, "-3": -3}
    assert column(spark, list(cases), "string", fn.to_int) == list(cases.values())
    assert column(spark, [1.0, 1.5, float("nan"), float("inf")], "double", fn.to_int) == [1, None, None, None]


def test_names_and_keys(spark):
    assert column(spark, ["A_PC_PC1", "A_PM", None], "string", fn.normalize_entity) == ["A_PM_PM1", "A_PM", None]
    assert column(spark, ["A_PC"], "string", lambda c: fn.normalize_entity(c, enabled=False)) == ["A_PC"]
    assert column(spark, ["F28_GTA101_PM", "X", None], "string", fn.derive_fab) == ["F28", "X", None]
    assert column(spark, ["E", None], "string", lambda c: fn.fab_entity_key(F.lit("F1"), c)) == ["F1_E", "F1_nan"]
    assert column(spark, ["E", None], "string", lambda c: fn.tool_id(c, F.lit(None).cast("string"))) == ["E|None", "None|None"]


def test_rules(spark):
    names = [" Running8\t", "Running9", "UpToProduction", "bagged", "Bagged ", None]
    assert column(spark, names, "string", fn.classify_state) == ["Running", "Down", "Idle", "Down", "Bagged", "Down"]
    assert column(spark, ["Bagged", "Not Installed", "Installed", None], "string", fn.is_active) == [False, False, True, True]
    assert column(spark, [0.0, 4.0, None], "double", lambda c: fn.safe_rate(F.lit(2), c)) == [None, 0.5, None]
    assert column(spark, [0.0, 4.0, None], "double", lambda c: fn.safe_rate(F.lit(2), c, 0)) == [0.0, 0.5, 0.0]
    assert column(spark, [0.0, 4.0, None], "double", lambda c: fn.cost_per_part(F.lit(2), c)) == [None, 0.5, None]
    assert column(spark, [-1000.0, -1000.01, None], "double", fn.is_replacement) == [False, True, None]
    got = column(spark, [0, 3], "int", lambda c: fn.disposition(F.lit(True), c))
    assert [tuple(row) for row in got] == [("Investigate", "Medium"), ("Sell", "High")]
    assert tuple(column(spark, [3], "int", lambda c: fn.disposition(F.lit(False), c))[0]) == ("Divest/Scrap", "Low")
    assert column(spark, [0, 2], "int", fn.installed_flag) == ["N", "Y"]


def test_number_text(spark):
    assert column(spark, [17500.0, 250.25, 0.5, 17500000.0], "double", fn.number_text) == [
        "17500.0", "250.25", "0.5", "17500000.0",
    ]


def test_pick_counter_order_and_matching(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, 3.0, 9.0, 7.0), (1.0, 0.0, None, 9.0, 7.0), (1.0, float("nan"), -1.0, 0.0, 7.0), (1.0, None, None, None, None)],
        "FocusRing double, XFocusCounter double, FocusRingCounter double, focusCounter double, APCCounter double",
    )
    candidates = fn.Candidates.of(df)
    assert [name for _, name in candidates.entries] == ["XFocusCounter", "FocusRingCounter", "APCCounter"]
    picked = df.select(fn.pick_counter(candidates.readings(df), candidates).alias("p")).select(
        candidates.name(F.col("p.position")).alias("name"), candidates.keyword(F.col("p.position")).alias("keyword"), "p.value"
    )
    assert [(row.name, row.keyword, row.value) for row in picked.collect()] == [
        ("XFocusCounter", "Focus", 5.0), ("APCCounter", "APCCounter", 7.0), ("APCCounter", "APCCounter", 7.0), (None, None, None),
    ]


def test_results_do_not_depend_on_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            ages = column(spark, ["2024-01-15", "2024-01-15 08:00:00"], "string", lambda c: fn.tool_age_days(c, ASOF))
            assert ages == [167, 166]
            instants = spark.sql("select timestamp'2025-12-18 03:15:23 UTC' as t")
            assert instants.select(fn.counter_date(fn.utc_time(F.col("t")))).first()[0] == dt.date(2025, 12, 17)
            late = dt.datetime(2025, 12, 18, 1, 0, tzinfo=dt.timezone(dt.timedelta(hours=9)))
            assert instants.select(fn.utc_literal(late)).first()[0] == dt.datetime(2025, 12, 17, 16, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
