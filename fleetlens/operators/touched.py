"""Which tool-days a load changes, and which production rows depend on them.

Keys are pairs of a tool and a day (ENTITY, day).  Everything here works on keys, not on ranges of days: one late row leads
to its own day and the day that follows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.operators.production import production_details

KEY = ["ENTITY", "day"]


def changed_keys(new: DataFrame, old: DataFrame, told: Sequence[str], day: str) -> DataFrame:
    """Keys whose rows, as far as the columns ``told`` go, aren't the same in both frames, however often each occurs.

    A row is compared by a hash of 128 bits; a column that one of the frames lacks is null there.
    """

    def rows(df: DataFrame, sign: int) -> DataFrame:
        cells = [F.col(f"`{name}`").cast("string") if name in df.columns else F.lit(None).cast("string") for name in told]
        text = F.to_json(F.struct(*[cell.alias(f"c{i}") for i, cell in enumerate(cells)]))
        return df.select("ENTITY", F.col(day).alias("day"), F.md5(text.cast("binary")).alias("row"), F.lit(sign).alias("sign"))

    both = rows(new, 1).unionByName(rows(old, -1)).dropna(subset=KEY)
    balance = both.groupBy(*KEY, "row").agg(F.sum("sign").alias("n"))
    return balance.where("n <> 0").select(*KEY).distinct()


def _nearest(keys: DataFrame, days: DataFrame, alias: str, after: bool) -> DataFrame:
    """The keys with the nearest day of the same tool in ``days`` after or before it, null if there is none."""
    marked = keys.select(*KEY, F.lit(True).alias("asked")).unionByName(days.select(*KEY, F.lit(False).alias("asked")))
    number = F.unix_date("day")
    frame = (1, Window.unboundedFollowing) if after else (Window.unboundedPreceding, -1)
    window = Window.partitionBy("ENTITY").orderBy(number).rangeBetween(*frame)
    real = F.when(~F.col("asked"), F.col("day"))
    found = (F.min(real) if after else F.max(real)).over(window)
    return marked.withColumn(alias, found).where("asked").drop("asked")


def following(keys: DataFrame, days: DataFrame) -> DataFrame:
    """The next day of each key's tool in ``days``: its production is a difference to the key's."""
    return _nearest(keys, days, "next_day", after=True).where("next_day is not null").select("ENTITY", F.col("next_day").alias("day")).distinct()


def with_previous(keys: DataFrame, days: DataFrame) -> DataFrame:
    """The keys, and the day before each in ``days``."""
    before = _nearest(keys, days, "last_day", after=False).where("last_day is not null")
    return keys.select(*KEY).unionByName(before.select("ENTITY", F.col("last_day").alias("day"))).distinct()


def only(df: DataFrame, keys: DataFrame, day: str) -> DataFrame:
    """Rows of these tools and days."""
    return df.join(keys.select("ENTITY", F.col("day").alias(day)), ["ENTITY", day], "left_semi")


def without(df: DataFrame, keys: DataFrame, day: str) -> DataFrame:
    """Rows of other tools and days."""
    return df.join(keys.select("ENTITY", F.col("day").alias(day)), ["ENTITY", day], "left_anti")


def production_of(keys: DataFrame, counters: DataFrame, state_hours: DataFrame, **rules: Column) -> DataFrame:
    """Production details of the keys alone; ``counters`` must hold their rows and those of the day before each."""
    hours = only(state_hours, keys, "state_date")
    return only(production_details(counters, hours, **rules), keys, "counter_date")
