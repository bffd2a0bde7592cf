"""Retention of the job's stored tables: whole partitions go, by the names of their folders; no row is read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from fleetlens import params
from fleetlens.functions import fiscal_work_week, iso_yearww
from fleetlens.plans.layers import PARTITIONS, Job
from fleetlens.sources.tables import drop_partitions, partition_folders, read_table

_DATED = ("state_date", "counter_date", "replacement_date", "production_date")


@dataclass(frozen=True)
class Expired:
    """A partition beyond its table's days of retention; it stays if a tool's last reading is in there."""

    table: str
    partition: str
    kept_for: int = 0  # tools whose last reading the partition holds

    @property
    def goes(self) -> bool:
        return self.kept_for == 0


def _labels(job: Job, label: Column, first: dt.date) -> set[str]:
    """Week labels of all days from the first one on."""
    days = job.spark.range((job.asof - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"))
    return {row[0] for row in days.select(label).distinct().collect()}


def _weeks_of_last_readings(job: Job, table: str) -> dict[str, int]:
    """By week of load, how many tools have their last reading there.  The index of days tells, not the rows."""
    if read_table(job.spark, job.path(f"{table}_days")) is None:
        return {}
    index = job.spark.table(job.days_index(table))
    last = index.join(index.groupBy("ENTITY").agg(F.max("day").alias("day")), ["ENTITY", "day"])
    return {row.load_ww: row.n for row in last.groupBy("load_ww").agg(F.count_distinct("ENTITY").alias("n")).collect()}


def expired(job: Job, days: Mapping[str, int] = params.RETENTION_DAYS) -> list[Expired]:
    """The partitions that are older than their table's days of retention, as of the job's day.

    A week counts by its last day.  A week of counters stays while it holds the last reading of a tool, as the tool's next
    reading is a difference to it.
    """
    found = []
    for table, kept_days in days.items():
        column, first = PARTITIONS[table], job.asof - dt.timedelta(days=kept_days)
        values = [value for value in partition_folders(job.spark, job.path(table)) if not value.startswith("__")]
        if column in _DATED:
            old = [value for value in values if dt.date.fromisoformat(value) < first]
        else:
            label = fiscal_work_week(F.col("day")) if column == "load_ww" else iso_yearww(F.col("day"))
            kept = _labels(job, label, first)
            old = [value for value in values if value not in kept and value < max(kept)]
        needed = _weeks_of_last_readings(job, table) if table == "counters_raw" and old else {}
        found += [Expired(table, value, needed.get(value, 0)) for value in old]
    return found


def retain_tables(job: Job, days: Mapping[str, int] = params.RETENTION_DAYS, dry_run: bool = True) -> list[Expired]:
    """What is expired; without ``dry_run`` the partitions that go are removed, with their entries in the index of days."""
    found = expired(job, days)
    if not dry_run:
        for table in days:
            gone = [part.partition for part in found if part.table == table and part.goes]
            for path in (job.path(table), *([job.path(f"{table}_days")] if PARTITIONS[table] == "load_ww" else [])):
                drop_partitions(job.spark, path, PARTITIONS[table], gone)
            if gone and PARTITIONS[table] == "load_ww":
                name = job.days_index(table)
                for value in gone:
                    job.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (load_ww = '{value}')")
    return found
