"""Preparation of raw rows and merging of loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens import params
from fleetlens.functions import derive_fab, fab_entity_key, normalize_entity
from fleetlens.operators.relational import dedup_keep_last, union_dynamic


def with_tool_keys(
    df: DataFrame,
    pattern: str = params.ENTITY_PATTERN,
    replacement: str = params.ENTITY_REPLACEMENT,
    normalize: bool = True,
) -> DataFrame:
    """Normalise ENTITY, derive FAB where the table has none, add FAB_ENTITY."""
    entity = normalize_entity(F.col("ENTITY"), pattern, replacement, normalize)
    named = df.withColumn("ENTITY", entity)
    if "FAB" not in df.columns:
        named = named.withColumn("FAB", derive_fab(F.col("ENTITY")))
    return named.withColumn("FAB_ENTITY", fab_entity_key(F.col("FAB"), F.col("ENTITY")))


def latest_file_per_week(files: DataFrame, week: str, path: str, modified: str) -> DataFrame:
    """Per week the file modified last; of two with the same time the greater path."""
    newest = F.max_by(F.struct(path, modified), F.struct(modified, path))
    return files.groupBy(week).agg(newest.alias("newest")).select(week, "newest.*")


def merge_rows(
    stored: DataFrame, new: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """Stored and new rows, one per key: a new row replaces a stored one, later ones replace earlier."""
    both = union_dynamic([stored.withColumn("_load", F.lit(0)), new.withColumn("_load", F.lit(1))])
    return dedup_keep_last(both, keys, ["_load", *order_by]).drop("_load")
