"""Every operator as a query over whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens import functions as fn, params
from fleetlens.operators import installed_base as base, keys, production, quality, relational as rel, states
from fleetlens.plans.fixtures import STATES_ASOF, STOCK_ORDER, TOOLS_ASOF, Fixtures

Query = Callable[[SparkSession, str], DataFrame]

LOG_ASOF = dt.date(2024, 1, 31)
LOOKBACK_ASOF = dt.date(2024, 1, 30)
RETENTION_ASOF = dt.date(2024, 4, 10)
SPLIT_DATE = dt.date(2024, 1, 16)

_RAW_KEYS = params.NATURAL_KEYS["entity_states_raw"]
_QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {}


def _query(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def portable(df: DataFrame) -> DataFrame:
    """Types that every engine prints alike: decimals as doubles, dates and booleans as text."""
    casts = {"decimal": "double", "date": "string", "timestamp": "string", "boolean": "string", "int": "bigint"}
    columns = []
    for name, kind in df.dtypes:
        target = casts.get(kind.split("(")[0].removesuffix("_ntz"))
        columns.append(F.col(f"`{name}`").cast(target).alias(name) if target else F.col(f"`{name}`"))
    return df.select(*columns)


def queries() -> dict[str, Query]:
    def runner(build: Callable[[Fixtures], DataFrame]) -> Query:
        return lambda spark, directory: portable(build(Fixtures(spark, directory)))

    return {name: runner(build) for name, build in _QUERIES.items()}


# --- shared inputs ---------------------------------------------------------------------------------


def raw_states(fx: Fixtures) -> DataFrame:
    return rel.dedup_keep_last(keys.with_tool_keys(fx.states), _RAW_KEYS, ["_ord"])


def raw_counters(fx: Fixtures) -> DataFrame:
    return keys.with_tool_keys(fx.counters)


def daily_hours(fx: Fixtures) -> DataFrame:
    return states.state_hours(raw_states(fx), STATES_ASOF)


def details(fx: Fixtures) -> DataFrame:
    return production.production_details(raw_counters(fx), daily_hours(fx))


def daily_fact(fx: Fixtures) -> DataFrame:
    return production.daily_from_counters(raw_counters(fx), daily_hours(fx))


def with_readings(fx: Fixtures) -> tuple[DataFrame, fn.Candidates]:
    counters = raw_counters(fx)
    candidates = fn.Candidates.of(counters)
    return counters.select("ENTITY", "counter_date", "FAB_ENTITY", candidates.readings(counters).alias("readings")), candidates


# --- tool states -------------------------------------------------------------------------------------


@_query
def state_hours(fx):
    return daily_hours(fx)


@_query
def hours_by_category(fx):
    return states.hours_by_category(states.classified_states(raw_states(fx), STATES_ASOF))


@_query
def tool_day_hours(fx):
    return states.tool_day_hours(states.classified_states(raw_states(fx), STATES_ASOF))


@_query
def classify_state(fx):
    return fx.states.select("_ord", "ENTITY_STATE", fn.classify_state(F.col("ENTITY_STATE")).alias("state_category"))


@_query
def parse_day_shift(fx):
    return fx.states.select("_ord", "DAY_SHIFT", fn.parse_day_shift(F.col("DAY_SHIFT"), STATES_ASOF).alias("state_date"))


@_query
def daily_state_fact(fx):
    return states.daily_state_fact(daily_hours(fx))


@_query
def weekly_state_fact(fx):
    return states.weekly_state_fact(states.daily_state_fact(daily_hours(fx)))


@_query
def state_audit(fx):
    return quality.state_audit(raw_states(fx), STATES_ASOF)


@_query
def state_classification(fx):
    return quality.state_classification(raw_states(fx), STATES_ASOF)


# --- names, keys and calendars -------------------------------------------------------------------------


@_query
def normalize_entity(fx):
    return fx.states.select("_ord", "ENTITY", fn.normalize_entity(F.col("ENTITY")).alias("normalized"))


@_query
def normalization_report(fx):
    return quality.normalization_report(fx.states)


@_query
def fab_entity_key(fx):
    return fx.states.select("_ord", fn.fab_entity_key(F.col("FAB"), F.col("ENTITY")).alias("FAB_ENTITY"))


@_query
def derive_fab(fx):
    return fx.counters.select("ENTITY", "counter_date", fn.derive_fab(F.col("ENTITY")).alias("derived_fab"))


def _order_days(fx, label):
    days = fx.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return days.select("o_orderkey", label(F.col("day")).alias("label"))


@_query
def fiscal_work_week(fx):
    return _order_days(fx, fn.fiscal_work_week)


@_query
def fiscal_work_week_nearest(fx):
    return _order_days(fx, lambda day: fn.fiscal_work_week(day, "nearest"))


@_query
def iso_yearww(fx):
    return _order_days(fx, fn.iso_yearww)


@_query
def iso_yearww_iso(fx):
    return _order_days(fx, lambda day: fn.iso_yearww(day, "iso"))


@_query
def counter_date(fx):
    return fx.files.select("path", fn.counter_date(F.col("modified")).alias("counter_date"))


@_query
def recent_work_weeks(fx):
    weeks = rel.recent_work_weeks(fx.spark, LOG_ASOF)
    log = fx.files.groupBy(fn.fiscal_work_week(F.col("day")).alias("ww")).agg(F.count("*").alias("n_files"))
    return weeks.join(log, "ww").select("ww", "rank", "n_files")


@_query
def latest_file_per_week(fx):
    log = fx.files.withColumn("ww", fn.fiscal_work_week(F.col("day")))
    newest = keys.latest_file_per_week(log, "ww", "path", "modified")
    return newest.select("ww", "path", F.date_format("modified", "yyyy-MM-dd HH:mm:ss").alias("modified"))


# --- keys, loads and filters -----------------------------------------------------------------------------


@_query
def dedup_keep_last(fx):
    return raw_states(fx).select(*_RAW_KEYS, "_ord", "HOURS_IN_STATE")


@_query
def dedup_report(fx):
    return quality.dedup_report(keys.with_tool_keys(fx.states), _RAW_KEYS)


@_query
def filter_report(fx):
    return quality.filter_report(fx.states, fn.parse_day_shift(F.col("DAY_SHIFT"), STATES_ASOF).isNotNull())


@_query
def upsert(fx):
    rows = keys.with_tool_keys(fx.states)
    stored, new = rows.where(F.col("load_date") < SPLIT_DATE), rows.where(F.col("load_date") >= SPLIT_DATE)
    return keys.merge_rows(stored, new, ["FAB_ENTITY", "ENTITY_STATE"], ["_ord"]).select(
        "FAB_ENTITY", "ENTITY_STATE", "DAY_SHIFT", "_ord", "HOURS_IN_STATE"
    )


@_query
def union_dynamic_columns(fx):
    even = F.substring("ENTITY", -4, 1).cast("int") % 2 == 0
    left = fx.counters.where(even).select("ENTITY", "counter_date", "APCCounter", "FocusRingCounter")
    right = fx.counters.where(~even).select("PMACounter", "ENTITY", "FocusRingCounter", "counter_date")
    return rel.union_dynamic([left, right])


@_query
def union_all(fx):
    early = fx.states.where(F.col("load_date") < SPLIT_DATE).select("_ord", "ENTITY", "load_date")
    late = fx.states.where(F.col("load_date") >= SPLIT_DATE).select("load_date", "_ord", "ENTITY")
    return rel.union_all([early, late])


def _weekly_load(fx):
    return fx.states.select("_ord", "load_date", fn.fiscal_work_week(F.col("load_date")).alias("load_ww"))


@_query
def mode_filter(fx):
    return rel.by_mode(_weekly_load(fx), "full", LOG_ASOF, weeks=3)


@_query
def mode_filter_incremental(fx):
    return rel.by_mode(_weekly_load(fx), "incremental", LOOKBACK_ASOF)


@_query
def lookback(fx):
    return rel.lookback(fx.states.select("_ord", "load_date"), "load_date", LOOKBACK_ASOF)


@_query
def retention(fx):
    rows = fx.states.select("_ord", "load_date")
    return rel.retain(rows, "load_date", RETENTION_ASOF, params.RETENTION_DAYS["entity_states_raw"])


@_query
def unique_violations(fx):
    return quality.unique_violations(keys.with_tool_keys(fx.states), _RAW_KEYS)


@_query
def null_violations(fx):
    return quality.null_violations(fx.tools, ["ENTITY", "Three_CEID", "Process_Node", "install_sts"])


# --- production --------------------------------------------------------------------------------------------


@_query
def pick_counter(fx):
    readings, candidates = with_readings(fx)
    picked = readings.withColumn("picked", fn.pick_counter(F.col("readings"), candidates))
    position = F.col("picked.position")
    return picked.select(
        "ENTITY", "counter_date", candidates.name(position).alias("name"), candidates.keyword(position).alias("keyword"),
        "picked.value",
    )


@_query
def previous_row(fx):
    readings, candidates = with_readings(fx)
    last = rel.day_rows(readings, "ENTITY", "counter_date", "readings", ["FAB_ENTITY"])
    before = rel.previous_row(last, "ENTITY", "counter_date", "readings", "before")
    columns = {name: fn.reading_at(F.col("before"), F.lit(i)) for i, (_, name) in enumerate(candidates.entries)}
    return before.select(
        "ENTITY", "counter_date", *[column.alias(f"previous_{name}") for name, column in columns.items()],
        F.col("before").isNull().alias("is_first"),
    )


@_query
def counter_change(fx):
    return details(fx).select(
        "ENTITY", "counter_date", "picked_counter", "picked_change",
        fn.is_replacement(F.col("picked_change")).alias("is_replacement"),
    )


@_query
def wafer_production(fx):
    return production.wafer_production(raw_counters(fx), daily_hours(fx))


@_query
def incremental_production(fx):
    counters = raw_counters(fx)
    rows = production.incremental_production(counters, counters, daily_hours(fx), SPLIT_DATE)
    return rows.select(*production.PRODUCTION_COLUMNS)


@_query
def part_replacements(fx):
    return production.part_replacements(production.wafer_production(raw_counters(fx), daily_hours(fx)))


@_query
def part_replacements_replaced(fx):
    return production.part_replacements(details(fx), "replaced_part")


@_query
def daily_production(fx):
    return daily_fact(fx)


@_query
def weekly_production(fx):
    return production.weekly_production(daily_fact(fx))


@_query
def weekly_production_iso(fx):
    return production.weekly_production(daily_fact(fx), "iso")


@_query
def production_audit(fx):
    return quality.production_audit(details(fx))


# --- installed base ------------------------------------------------------------------------------------------


def _aged(fx):
    return base.tools_with_age(fx.tools, TOOLS_ASOF)


@_query
def age_bucket(fx):
    return _aged(fx).select("k", "Three_CEID", F.col("Tool_Age_Days").cast("double").alias("Tool_Age_Days"), "Age_Bucket")


@_query
def is_active(fx):
    return _aged(fx).select("k", "Three_CEID", "install_sts", "is_active")


@_query
def tool_id(fx):
    return _aged(fx).select("k", "Three_CEID", "Tool_ID")


@_query
def to_int(fx):
    return fx.tools.select(
        "k", "Three_CEID", "Process_Node", fn.to_int(F.col("Process_Node")).cast("double").alias("node")
    )


@_query
def config_mart(fx):
    return base.config_mart(fx.tools, TOOLS_ASOF)


@_query
def drilldown(fx):
    rows = base.drilldown(fx.gbom, base.config_mart(fx.tools, TOOLS_ASOF), fx.inventory)
    nullable = ["Process_Node", *params.AGE_COLUMNS.values()]
    return rows.withColumns({name: F.col(name).cast("double") for name in nullable})


@_query
def leadership(fx):
    rows = base.leadership(fx.gbom, fx.tools, fx.inventory, TOOLS_ASOF, STOCK_ORDER)
    return rows.withColumn("Amount_needed_per_tool", F.col("Amount_needed_per_tool").cast("double"))


@_query
def inventory_by_part(fx):
    return base.inventory_by_part(fx.inventory, supplier_order=STOCK_ORDER)


@_query
def gbom_max_qty(fx):
    return base.gbom_by_part(fx.gbom).select("Part_Number", "Amount_needed_per_tool")


@_query
def gbom_lists(fx):
    return base.gbom_by_part(fx.gbom).select("Part_Number", "Applicable_CEIDs", "Applicable_Tool_Types")


@_query
def part_tool_counts(fx):
    counts = base.part_tool_counts(fx.gbom, fx.tools, TOOLS_ASOF)
    return counts.select("Part_Number", "Number_of_active_tools")


@_query
def part_age_counts(fx):
    return base.part_tool_counts(fx.gbom, fx.tools, TOOLS_ASOF).drop("Number_of_active_tools")


@_query
def part_tool_counts_shared(fx):
    return base.part_tool_counts(fx.view("fx_gbom_shared"), fx.view("fx_tools_moved"), TOOLS_ASOF)


@_query
def disposition(fx):
    rows = base.leadership(fx.gbom, fx.tools, fx.inventory, TOOLS_ASOF)
    return rows.select("Part_Number", "Active_Installed_Flag", "Disposition_Category", "Confidence_Level")


@_query
def key_overlap(fx):
    def typed(df):
        return df.select("Three_CEID", fn.to_int(F.col("Process_Node")).alias("Process_Node"))

    return quality.key_overlap(typed(fx.gbom), typed(fx.tools), ["Three_CEID", "Process_Node"])


@_query
def bucket_consistency(fx):
    return base.bucket_consistency(fx.view("fx_gbom_shared"), fx.view("fx_tools_moved"), TOOLS_ASOF)


@_query
def offending_tools(fx):
    rows = base.offending_tools(fx.view("fx_gbom_shared"), fx.view("fx_tools_moved"), TOOLS_ASOF)
    return rows.withColumn("Process_Node", F.col("Process_Node").cast("double"))


def _checks(fx, bound_by):
    mart = base.config_mart(fx.tools, TOOLS_ASOF)
    board = base.leadership(fx.gbom, fx.tools, fx.inventory, TOOLS_ASOF)
    return quality.acceptance_checks(fx.tools, mart, board, fx.gbom, bound_by)


@_query
def acceptance_checks(fx):
    return _checks(fx, "tool_id")


@_query
def acceptance_checks_entity(fx):
    return _checks(fx, "entity")


@_query
def tool_profile(fx):
    return quality.tool_profile(fx.tools, TOOLS_ASOF)


@_query
def age_distribution(fx):
    return quality.age_distribution(fx.tools, TOOLS_ASOF)


@_query
def value_counts(fx):
    return rel.value_counts(fx.tools, "install_sts")


@_query
def distinct_sample(fx):
    return rel.distinct_sample(fx.gbom, "Three_CEID")


@_query
def distinct_count(fx):
    return rel.distinct_count(fx.tools, "ENTITY", "n_tools")
