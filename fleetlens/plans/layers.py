"""The tool-state and counter job: raw tables, enriched tables, fact tables.

Each layer reads the stored tables of the layer before it and replaces rows of its own, so layers can run alone and a
repeated run changes nothing.  A file that is loaded again replaces what it said before.  A load is compared with what it
replaces, and the tool-days that differ are noted in the table ``pending``.  The later layers compute these anew, with the
day that follows a changed reading, and nothing else, and pass on which ones they changed.  An index of the days that each
week's file tells, dealt into buckets by tool, leads from there to the raw weeks that have to be read.

A day without a year is one of the year in which its row was loaded, or of the year before if it would lie ahead.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlens import params
from fleetlens.functions import counter_date, iso_yearww, parse_day_shift, utc_time
from fleetlens.operators import production, states
from fleetlens.operators.relational import dedup_keep_last, recent_work_weeks, stamp, union_all, union_dynamic
from fleetlens.operators.touched import KEY, changed_keys, following, only, production_of, with_previous
from fleetlens.sources import csv_files
from fleetlens.sources.tables import bucketed_table, read_table, replace_bucketed, replace_partitions, staged, write_table

LAYERS = ("bronze", "silver", "gold")

# Tables are stored by week of load or by the date or week they describe.
PARTITIONS = {
    "entity_states_raw": "load_ww",
    "counters_raw": "load_ww",
    "state_hours": "state_date",
    "wafer_production": "counter_date",
    "part_replacements": "replacement_date",
    "fact_daily_production": "production_date",
    "fact_weekly_production": "YEARWW",
    "fact_state_hours_daily": "state_date",
    "fact_state_hours_weekly": "YEARWW",
}


@dataclass(frozen=True)
class Job:
    """One run of the job: where from, where to, as of when."""

    spark: SparkSession
    source: str
    store: str
    asof: dt.date
    load_ts: dt.datetime
    mode: str = "full"
    weeks: int = params.WEEKS_TO_LOAD
    lookback_days: int = 0  # days before asof that are computed anew whatever changed
    prefer: str = "oldest"
    buckets: int = 16

    def path(self, table: str) -> str:
        return f"{self.store}/{table}"

    def replace(self, df: DataFrame, table: str, replaced: Column) -> None:
        """Store the rows in place of those partitions that meet the condition."""
        replace_partitions(df, self.path(table), PARTITIONS[table], replaced, sort_by=["ENTITY"])

    def replace_keys(self, df: DataFrame, table: str, keys: DataFrame) -> None:
        """Store the rows as all that the table has of these keys (ENTITY and the partition's column)."""
        column = PARTITIONS[table]
        touched = [row[0] for row in keys.select(column).distinct().collect()]
        if not touched:
            return
        inside = F.col(column).isin(*touched)
        stored = read_table(self.spark, self.path(table), merge_schema=True)
        if stored is not None:
            others = stored.where(inside).join(keys, ["ENTITY", column], "left_anti")
            df = union_dynamic([others.select(*stored.columns), df])
        self.replace(df, table, inside)

    def days_index(self, table: str) -> str:
        """The table (ENTITY, day, load_ww) of the days that the raw table's weeks tell, dealt into buckets by tool."""
        path = self.path(f"{table}_days")
        return bucketed_table(self.spark, path, "ENTITY string, day date, load_ww string", "load_ww", "ENTITY", self.buckets)

    def stored(self, table: str, merge_schema: bool = False) -> DataFrame:
        df = read_table(self.spark, self.path(table), merge_schema=merge_schema)
        if df is None:
            raise ValueError(f"table {table} is empty: run the layer before it first")
        return df

    @property
    def week_order(self) -> Column:
        """Of weeks that tell the same, the one with the greatest value counts."""
        week = F.replace("load_ww", F.lit("WW"), F.lit("")).cast("int")
        return -week if self.prefer == "oldest" else week

    def raw(self, table: str, df: DataFrame, *more: str) -> DataFrame:
        """One row per natural key of a raw table whose weeks overlap."""
        return dedup_keep_last(df, [*params.NATURAL_KEYS[table], *more], [self.week_order])


def _per_week(job: Job, rows: DataFrame, table: str) -> DataFrame:
    """One row per natural key and week: raw tables keep what each week's file says."""
    return csv_files.keep_last_loaded(rows, [*params.NATURAL_KEYS[table], "load_ww"], job.prefer)


def _loaded_weeks(report: DataFrame) -> list[str]:
    """Weeks whose file could be read; a file that was rejected leaves the stored rows as they are."""
    return [row.ww for row in report.where("loaded").select("ww").distinct().collect()]


#: Columns of raw rows that tell of the load, not of the tool.
_METADATA = ("load_ts", "load_date", "source_file", "file_modified_ts")


def _dated(rows: DataFrame) -> DataFrame:
    """State rows with category and day."""
    return states.classified_states(rows, F.col("load_date"), ahead="last_year")


def _note(job: Job, layer: str, keys: dict[str, DataFrame]) -> None:
    """Note for a later layer the tool-days that change, by table."""
    noted = [df.select(F.lit(layer).alias("layer"), F.lit(table).alias("table"), *KEY) for table, df in keys.items()]
    write_table(union_all(noted), job.path("pending"), partition_by="layer")


def _noted(job: Job, layer: str, table: str) -> DataFrame:
    pending = read_table(job.spark, job.path("pending"))
    if pending is None:
        return job.spark.createDataFrame([], "ENTITY string, day date")
    return pending.where((F.col("layer") == layer) & (F.col("table") == table)).select(*KEY).distinct()


def _store_raw(job: Job, table: str, rows: DataFrame, old: DataFrame | None, weeks: list[str], day: str) -> None:
    """Note what differs, store the rows as the weeks' whole content, and index their days.

    ``rows`` and ``old`` have the column ``day``; the raw table doesn't store it if it is read from a text.
    """
    told = [name for name in rows.columns if name not in _METADATA]
    told += [name for name in (old.columns if old is not None else []) if name not in (*told, *_METADATA)]
    before = rows.limit(0) if old is None else old
    _note(job, "silver", {table: changed_keys(rows, before, told, day)})
    raw = rows.drop("state_date", "state_category")
    job.replace(raw, table, F.col("load_ww").isin(*weeks))
    _keep_columns(job, table, [name for name in raw.columns if name.endswith(params.COUNTER_SUFFIX)])
    days = rows.select("ENTITY", F.col(day).alias("day"), "load_ww").dropna().distinct()
    replace_bucketed(days, job.days_index(table), "load_ww", "ENTITY", weeks)


def _keep_columns(job: Job, table: str, counters: list[str]) -> None:
    """Give counter columns that the table hasn't had yet the next places, for good."""
    path = job.path(f"{table}_columns")
    known = {row.name: row.place for row in stored.collect()} if (stored := read_table(job.spark, path)) is not None else {}
    new = [(name, len(known) + i) for i, name in enumerate(name for name in counters if name not in known)]
    if new:
        write_table(job.spark.createDataFrame(new, "name string, place int"), path)


def _in_order(job: Job, table: str, df: DataFrame) -> DataFrame:
    """The table's counter columns in the order in which they first came; a file that comes or goes doesn't change it."""
    stored = read_table(job.spark, job.path(f"{table}_columns"))
    places = {} if stored is None else {row.name: row.place for row in stored.collect()}
    return df.select(*[f"`{name}`" for name in sorted(df.columns, key=lambda name: places.get(name, -1))])


def load_states(job: Job, weeks: DataFrame) -> csv_files.Loaded:
    """Load the state files of some weeks (ww, rank) in place of what was stored for these weeks."""
    table = "entity_states_raw"
    loaded = csv_files.read_states(job.spark, csv_files.discover_state_files(job.spark, job.source, weeks), job.load_ts)
    rows = staged(_per_week(job, loaded.rows, table), f"{job.path(table)}_loaded")
    read = _loaded_weeks(loaded.report)
    stored = read_table(job.spark, job.path(table))
    # Rows whose day can't be read are stored, and belong to no day.
    day = _day_of_states()
    old = None if stored is None else stored.where(F.col("load_ww").isin(*read)).withColumn("state_date", day)
    _store_raw(job, table, rows.withColumn("state_date", day), old, read, "state_date")
    _store_rejected(job, table, loaded, weeks)
    return csv_files.Loaded(rows, loaded.report, loaded.rejected)


def _store_rejected(job: Job, table: str, loaded: csv_files.Loaded, weeks: DataFrame) -> None:
    """Keep the lines that the weeks' files have beyond their rows."""
    path = job.path(f"{table}_rejected")
    if read_table(job.spark, path) is not None or not loaded.rejected.isEmpty():
        replace_partitions(loaded.rejected, path, "ww", F.col("ww").isin(*[row.ww for row in weeks.collect()]))


def _day_of_states() -> Column:
    return parse_day_shift(F.col("DAY_SHIFT"), F.col("load_date"), ahead="last_year")


def load_counters(job: Job, weeks: DataFrame) -> csv_files.Loaded:
    """Load the counter files of some weeks (ww, rank) in place of what was stored for their weeks and days.

    A week's newest file tells one day; the days that earlier files of the week told stay.
    """
    table = "counters_raw"
    files = csv_files.discover_counter_files(job.spark, job.source, weeks)
    loaded = csv_files.read_counters(job.spark, files, job.load_ts)
    rows = staged(_per_week(job, loaded.rows, table), f"{job.path(table)}_loaded")
    read = _loaded_weeks(loaded.report)
    told = files.select(F.col("ww").alias("load_ww"), counter_date(utc_time(F.col("modified"))).alias("counter_date"))
    stored = read_table(job.spark, job.path(table), merge_schema=True)
    whole, old = rows, None
    if stored is not None:
        old = stored.where(F.col("load_ww").isin(*read))
        others = old.join(told, ["load_ww", "counter_date"], "left_anti")
        whole = staged(union_dynamic([others.select(*stored.columns), rows]), f"{job.path(table)}_whole")
    _store_raw(job, table, whole, old, read, "counter_date")
    _store_rejected(job, table, loaded, weeks)
    return csv_files.Loaded(rows, loaded.report, loaded.rejected)


def run_bronze(job: Job) -> dict[str, DataFrame]:
    """Load the files of the weeks that the mode asks for; returns the raw tables and the file reports."""
    weeks = recent_work_weeks(job.spark, job.asof, csv_files.weeks_for_mode(job.mode, job.weeks))
    loads = {"entity_states_raw": load_states(job, weeks), "counters_raw": load_counters(job, weeks)}
    tables = {}
    for table, loaded in loads.items():
        stored = read_table(job.spark, job.path(table), merge_schema=True)
        tables[table] = loaded.rows if stored is None else stored
        tables[f"{table}_files"] = loaded.report
    return tables


def _touched(job: Job, table: str) -> DataFrame:
    """Keys of a raw table to compute: noted ones, in full mode all that the weeks tell, and those of the last days."""
    index = job.spark.table(job.days_index(table))
    asked = F.col("day") > F.lit(job.asof - dt.timedelta(days=job.lookback_days))
    if job.mode == "full":
        asked |= F.col("load_ww").isin(*[row.ww for row in recent_work_weeks(job.spark, job.asof, job.weeks).collect()])
    always = index.where(asked) if job.lookback_days or job.mode == "full" else index.where("false")
    return _noted(job, "silver", table).unionByName(always.select(*KEY)).distinct()


def _raw_of(job: Job, table: str, keys: DataFrame) -> DataFrame:
    """Raw rows of the weeks that tell the keys; the index is read in the buckets in which it lies."""
    index = job.spark.table(job.days_index(table))
    weeks = [row[0] for row in index.join(keys, KEY, "left_semi").select("load_ww").distinct().collect()]
    return _in_order(job, table, job.stored(table, merge_schema=True)).where(F.col("load_ww").isin(*weeks))


def _done(job: Job, layer: str) -> None:
    """A layer has seen to all that was noted for it."""
    pending = read_table(job.spark, job.path("pending"))
    if pending is not None:
        replace_partitions(pending.where("false"), job.path("pending"), "layer", F.col("layer") == layer)


def run_silver(job: Job) -> dict[str, DataFrame]:
    """State hours, production and replacements of the tool-days that loads changed."""
    for table in ("entity_states_raw", "counters_raw"):
        job.stored(table)
    state_keys = staged(_touched(job, "entity_states_raw"), job.path("state_keys"))
    counter_keys = staged(_touched(job, "counters_raw"), job.path("counter_keys"))

    # A day may be told by the files of several weeks, so its rows are taken from all of them.
    dated = only(_dated(_raw_of(job, "entity_states_raw", state_keys)), state_keys, "state_date")
    hours = states.hours_of_classified(job.raw("entity_states_raw", dated, "state_date"))
    by_day = state_keys.withColumnRenamed("day", "state_date")
    job.replace_keys(stamp(hours, "calculation_timestamp", job.load_ts), "state_hours", by_day)

    # Days of the touched tools: what is to be computed, and what it is compared with.
    both = state_keys.unionByName(counter_keys).distinct()
    index = job.spark.table(job.days_index("counters_raw"))
    days = staged(index.join(both.select("ENTITY").distinct(), "ENTITY", "left_semi").select(*KEY).distinct(), job.path("tool_days"))
    made_keys = staged(both.unionByName(following(counter_keys, days)).distinct(), job.path("made_keys"))
    needed = staged(with_previous(made_keys.join(days, KEY, "left_semi"), days), job.path("needed_keys"))
    counters = job.raw("counters_raw", only(_raw_of(job, "counters_raw", needed), needed, "counter_date"))
    stored_hours = read_table(job.spark, job.path("state_hours"))
    stored_hours = hours if stored_hours is None else stored_hours.where(F.col("state_date").isin(*_days_of(made_keys)))
    details = staged(production_of(made_keys, counters, stored_hours), job.path("production_details"))
    by_day = made_keys.withColumnRenamed("day", "counter_date")
    made = details.select(*production.PRODUCTION_COLUMNS)
    job.replace_keys(stamp(made, "calculation_timestamp", job.load_ts), "wafer_production", by_day)
    events = stamp(production.part_replacements(details), "replacement_detected_ts", job.load_ts)
    job.replace_keys(events, "part_replacements", made_keys.withColumnRenamed("day", "replacement_date"))

    _note(job, "gold", {"state_hours": state_keys, "wafer_production": made_keys})
    _done(job, "silver")
    events_stored = read_table(job.spark, job.path("part_replacements"))
    return {
        "state_hours": job.stored("state_hours"),
        "wafer_production": job.stored("wafer_production"),
        "part_replacements": events if events_stored is None else events_stored,
    }


def _days_of(keys: DataFrame) -> list[dt.date]:
    return [row[0] for row in keys.select("day").distinct().collect()]


def _whole_weeks(job: Job, table: str, column: str, labels: list[str]) -> DataFrame:
    """Stored days of the weeks with these labels.

    The label joins the first and the last days of a calendar year, so the years are read whole.
    """
    label: Column = iso_yearww(F.col(column))
    years = sorted({int(name[:4]) for name in labels})
    return job.stored(table).where(F.year(column).isin(*years) & label.isin(*labels))


def run_gold(job: Job) -> dict[str, DataFrame]:
    """Daily facts of the tool-days that the layer before changed, and the facts of their weeks."""
    state_keys = staged(_noted(job, "gold", "state_hours"), job.path("gold_state_keys"))
    keys = staged(_noted(job, "gold", "wafer_production").unionByName(state_keys).distinct(), job.path("gold_keys"))
    days = _days_of(keys)

    def stamped(df: DataFrame) -> DataFrame:
        return stamp(df, "calculation_timestamp", job.load_ts)

    def stored(table: str, keys: DataFrame) -> DataFrame:
        column = PARTITIONS[table]
        return only(job.stored(table).where(F.col(column).isin(*days)), keys, column).drop("calculation_timestamp")

    made, hours = stored("wafer_production", keys), stored("state_hours", keys)
    by_day = keys.withColumnRenamed("day", "production_date")
    job.replace_keys(stamped(production.daily_production(made, hours)), "fact_daily_production", by_day)
    by_day = state_keys.withColumnRenamed("day", "state_date")
    job.replace_keys(stamped(states.daily_state_fact(stored("state_hours", state_keys))), "fact_state_hours_daily", by_day)
    for weekly, daily, column, fact, touched in (
        ("fact_weekly_production", "fact_daily_production", "production_date", production.weekly_production, keys),
        ("fact_state_hours_weekly", "fact_state_hours_daily", "state_date", states.weekly_state_fact, state_keys),
    ):
        weeks = staged(touched.select("ENTITY", iso_yearww(F.col("day")).alias("YEARWW")).distinct(), job.path(f"{weekly}_keys"))
        labels = [row[0] for row in weeks.select("YEARWW").distinct().collect()]
        if labels:
            named = _whole_weeks(job, daily, column, labels).withColumn("YEARWW", iso_yearww(F.col(column)))
            rows = fact(named.join(weeks, ["ENTITY", "YEARWW"], "left_semi").drop("YEARWW"))
            job.replace_keys(stamped(rows), weekly, weeks)
    _done(job, "gold")
    facts = [table for table in PARTITIONS if table.startswith("fact_")]
    return {table: df for table in facts if (df := read_table(job.spark, job.path(table))) is not None}


def run(job: Job, layer: str = "all") -> dict[str, DataFrame]:
    """Run one layer or all of them; returns the stored tables by name."""
    if layer not in (*LAYERS, "all"):
        raise ValueError(f"layer must be one of {[*LAYERS, 'all']}, not {layer!r}")
    steps = {"bronze": run_bronze, "silver": run_silver, "gold": run_gold}
    tables: dict[str, DataFrame] = {}
    for name, step in steps.items():
        if layer in (name, "all"):
            tables |= step(job)
    return tables
