"""Installed base: active tools per configuration and per part, by age, and what to do with stock.

A configuration is (Three_CEID, Process_Node).  A tool counts once per part, however many of the
part's configurations it is in, so per-part counts are distinct counts over parts x tools.  Those
pairs are never produced: parts that apply to the same set of configurations share their count, and
so do tools listed under the same configurations and ages.  Both sides are first reduced to such
classes, with a weight for the tools.  Tools listed under one configuration only, most of them, are
counted per configuration, and the counts add up over a part's set; only classes of tools listed
under several are joined with sets.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens import params
from fleetlens.functions import (
    age_bucket,
    cost_per_part,
    disposition,
    estimated_parts,
    installed_flag,
    is_active,
    to_int,
    tool_age_days,
    tool_id,
)
from fleetlens.operators.relational import drop_null_keys, fill_counts

_CONFIG = ["Three_CEID", "Process_Node"]
_AGE_COLUMNS = list(params.AGE_COLUMNS.values())


def tools_with_age(tools: DataFrame, asof: dt.date, inactive: Sequence[str] = params.INACTIVE_STATUSES) -> DataFrame:
    """Tool list with typed Process_Node, Tool_ID, age in days and years, Age_Bucket and is_active."""
    return (
        tools.withColumns(
            {
                "Process_Node": to_int(F.col("Process_Node")),
                "Tool_ID": tool_id(F.col("ENTITY"), F.col("Location")),
                "Tool_Age_Days": tool_age_days(F.col("Warranty_Start"), asof),
                "is_active": is_active(F.col("install_sts"), inactive),
            }
        )
        .withColumn("Tool_Age_Years", F.col("Tool_Age_Days") / F.lit(params.DAYS_PER_YEAR))
        .withColumn("Age_Bucket", age_bucket(F.col("Tool_Age_Days")))
    )


def _active(tools: DataFrame, asof: dt.date, inactive: Sequence[str]) -> DataFrame:
    return tools_with_age(tools, asof, inactive).where(F.col("is_active"))


def config_mart(
    tools: DataFrame, asof: dt.date, inactive: Sequence[str] = params.INACTIVE_STATUSES
) -> DataFrame:
    """Distinct active tools per configuration, in total and by age.

    Tools are made distinct first, with one flag per age, so that the counts need no further distinct.
    """
    per_tool = (
        drop_null_keys(_active(tools, asof, inactive), _CONFIG)
        .groupBy(*_CONFIG, "Tool_ID")
        .agg(*[F.bool_or(F.col("Age_Bucket") == age).alias(name) for age, name in params.AGE_COLUMNS.items()])
    )
    return per_tool.groupBy(*_CONFIG).agg(
        F.count("*").alias("Active_Tool_Count_Config"), *[F.count_if(name).alias(name) for name in _AGE_COLUMNS]
    )


def inventory_by_part(
    inventory: DataFrame, quantity: str = "Qty_Total", supplier_order: Sequence[str] | None = None
) -> DataFrame:
    """Stock and cost per part.

    With ``supplier_order`` (columns that put the stock lines in order) the first known
    Supplier_Code is reported too, if the table has that column.
    """
    measures = [
        F.coalesce(F.sum("Qty"), F.lit(0)).alias(quantity),
        F.coalesce(F.sum("Total_Amount_USD"), F.lit(0)).alias("Total_Amount_USD"),
    ]
    if supplier_order and "Supplier_Code" in inventory.columns:
        place = F.when(F.col("Supplier_Code").isNotNull(), F.struct(*supplier_order))
        measures.append(F.min_by("Supplier_Code", place).alias("Supplier_Code"))
    return (
        drop_null_keys(inventory, ["Part_Number"])
        .groupBy("Part_Number")
        .agg(*measures)
        .withColumn("Cost_per_part", cost_per_part(F.col("Total_Amount_USD"), F.col(quantity)))
    )


def drilldown(gbom: DataFrame, mart: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per part and configuration with its tool counts, the part's stock and the parts needed.

    Age counts stay null for a configuration without active tools; the total becomes zero.
    """
    rows = gbom.withColumn("Process_Node", to_int(F.col("Process_Node"))).join(mart, _CONFIG, "left")
    counts = [name for name in rows.columns if name.startswith("Active_Tool_Count")]
    return (
        fill_counts(rows, counts)
        .join(inventory_by_part(inventory), "Part_Number", "left")
        .withColumn(
            "Estimated_Parts_Needed_Config",
            estimated_parts(F.col("Active_Tool_Count_Config"), F.col("Qty_Per_Tool")),
        )
    )


def _config() -> Column:
    """The configuration as one value.  Inside a struct a null equals a null, as the join requires."""
    return F.struct("Three_CEID", "Process_Node")


def _value_list(column: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(F.col(column).cast("string"))), ", ")


def gbom_by_part(gbom: DataFrame) -> DataFrame:
    """Per part: largest Qty_Per_Tool, lists of CEIDs and tool types, and its set of configurations."""
    typed = gbom.withColumn("Process_Node", to_int(F.col("Process_Node")))
    return (
        drop_null_keys(typed, ["Part_Number"])
        .groupBy("Part_Number")
        .agg(
            F.max("Qty_Per_Tool").alias("Amount_needed_per_tool"),
            _value_list("Three_CEID").alias("Applicable_CEIDs"),
            _value_list("Tool_Type").alias("Applicable_Tool_Types"),
            F.array_sort(F.collect_set(_config())).alias("configs"),
        )
    )


def tool_classes(
    tools: DataFrame, asof: dt.date, inactive: Sequence[str] = params.INACTIVE_STATUSES
) -> DataFrame:
    """(listing, n_tools): active tools grouped by the set of (config, age) they are listed under."""
    return (
        tool_listings(tools, asof, inactive).groupBy("listing").agg(F.count("*").alias("n_tools"))
    )


def tool_listings(tools: DataFrame, asof: dt.date, inactive: Sequence[str]) -> DataFrame:
    """(Tool_ID, listing) with the sorted set of (config, age) of each active tool."""
    entry = F.struct(_config().alias("config"), F.col("Age_Bucket").alias("age"))
    return (
        _active(tools, asof, inactive)
        .groupBy("Tool_ID")
        .agg(F.array_sort(F.collect_set(entry)).alias("listing"))
    )


def _digest(column: str) -> Column:
    return F.md5(F.to_json(column).cast("binary"))


def _set() -> Column:
    """A set of configurations by a digest, so that its rows need not carry all of it."""
    return _digest("configs")


def _matches(part_sets: DataFrame, listings: DataFrame) -> DataFrame:
    """Pairs of a configuration set and a listing that share a configuration, each pair once.

    ``shared`` holds the listing's entries within the set.  A pair that meets in several
    configurations is kept at the first of them only.
    """
    left = part_sets.select("*", F.explode("configs").alias("config"))
    right = listings.select("*", F.explode(_listed_configs()).alias("config"))
    shared = F.filter("listing", lambda entry: F.array_contains(F.col("configs"), entry["config"]))
    return (
        left.join(right, "config")
        .withColumn("shared", shared)
        .where(F.col("config") == F.get(F.col("shared"), F.lit(0))["config"])
        .drop("config")
    )


def _listed_configs() -> Column:
    return F.array_distinct(F.transform("listing", lambda entry: entry["config"]))


def _weights(entries: str) -> list[Column]:
    """Tools in total and by age, of classes with a weight and the entries that count."""

    def counted(age: str) -> Column:
        return F.exists(entries, lambda entry: entry["age"] == age)

    return [
        F.sum("n_tools").alias("Number_of_active_tools"),
        *[
            F.coalesce(F.sum(F.when(counted(age), F.col("n_tools"))), F.lit(0)).alias(name)
            for age, name in params.AGE_COLUMNS.items()
        ],
    ]


def _tools_per_config_set(part_sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct active tools, in total and by age, for each ``set`` of configurations that has any.

    A tool under one configuration is in a set as often as this configuration, once; so such tools are counted per
    configuration and added up.  What remains are the classes of tools under several configurations.
    """
    part_sets = part_sets.select("configs").distinct().withColumn("set", _set())
    alone = classes.where(F.size(_listed_configs()) == 1)
    per_config = alone.groupBy(F.get("listing", F.lit(0))["config"].alias("config")).agg(*_weights("listing"))
    added = part_sets.select("set", F.explode("configs").alias("config")).join(per_config, "config")
    several = _matches(part_sets, classes.where(F.size(_listed_configs()) > 1)).groupBy("set").agg(*_weights("shared"))
    counts = ["Number_of_active_tools", *_AGE_COLUMNS]
    both = added.select("set", *counts).unionByName(several.select("set", *counts))
    return both.groupBy("set").agg(*[F.sum(name).alias(name) for name in counts])


def part_tool_counts(
    gbom: DataFrame, tools: DataFrame, asof: dt.date, inactive: Sequence[str] = params.INACTIVE_STATUSES
) -> DataFrame:
    """Distinct active tools per part, in total and by age, for parts with any active tool."""
    parts = gbom_by_part(gbom).select("Part_Number", "configs")
    counts = _tools_per_config_set(parts, tool_classes(tools, asof, inactive))
    return parts.select("Part_Number", _set().alias("set")).join(counts, "set").drop("set")


def leadership(
    gbom: DataFrame,
    tools: DataFrame,
    inventory: DataFrame,
    asof: dt.date,
    supplier_order: Sequence[str] | None = None,
    inactive: Sequence[str] = params.INACTIVE_STATUSES,
) -> DataFrame:
    """One row per stocked part: stock, demand, applicability, active tools by age, advice."""
    parts = gbom_by_part(gbom)
    counts = _tools_per_config_set(parts, tool_classes(tools, asof, inactive))
    known = parts.withColumn("set", _set()).drop("configs").join(counts, "set", "left").drop("set").withColumn("in_gbom", F.lit(True))
    stock = inventory_by_part(inventory, "Amount_of_stock", supplier_order)
    rows = fill_counts(stock.join(known, "Part_Number", "left"), ["Number_of_active_tools", *_AGE_COLUMNS])
    active, listed = F.col("Number_of_active_tools"), F.coalesce("in_gbom", F.lit(False))
    return (
        rows.withColumn("Active_Installed_Flag", installed_flag(active))
        .withColumn("advice", disposition(listed, active))
        .select("*", "advice.*")
        .drop("advice", "in_gbom")
    )


def _offences(parts: DataFrame, suspects: DataFrame) -> DataFrame:
    """(configs, listing, Distinct_Buckets): sets of configurations and listings that meet at several ages."""
    shared_ages = F.array_distinct(F.transform("shared", lambda entry: entry["age"]))
    return (
        _matches(parts.select("configs").distinct(), suspects.select("listing").distinct())
        .select("configs", "listing", F.size(shared_ages).cast("bigint").alias("Distinct_Buckets"))
        .where(F.col("Distinct_Buckets") > 1)
    )


def _suspects(tools: DataFrame, asof: dt.date, inactive: Sequence[str]) -> DataFrame:
    """Tools listed with several ages; only they can offend, so all others are left out before anything is joined."""
    ages = F.array_distinct(F.transform("listing", lambda entry: entry["age"]))
    return tool_listings(tools, asof, inactive).where(F.size(ages) > 1)


def bucket_consistency(
    gbom: DataFrame, tools: DataFrame, asof: dt.date, inactive: Sequence[str] = params.INACTIVE_STATUSES
) -> DataFrame:
    """(Part_Number, Tool_ID, Distinct_Buckets) where a tool has several ages within one part.

    The pairs are the result, however many there are.  Parts and tools are dealt in blocks first; a block is shuffled once
    for each block of the other side, so about a thousandth as many rows as there are pairs, and the pairs of two blocks are
    joined in one task, of which there are as many as the session has shuffle partitions.
    """
    suspects = _suspects(tools, asof, inactive).select("Tool_ID", "listing", _digest("listing").alias("key"))
    parts = gbom_by_part(gbom).select("Part_Number", "configs", _set().alias("set"))
    offences = _offences(parts, suspects).select(_set().alias("set"), _digest("listing").alias("key"), "Distinct_Buckets")
    offenders = offences.join(suspects.select("key", "Tool_ID"), "key").select("set", "Distinct_Buckets", "Tool_ID")
    part_blocks = _blocks(parts.select("set", "Part_Number"), ["set"], "Part_Number", "part_block")
    tool_blocks = _blocks(offenders, ["set", "Distinct_Buckets"], "Tool_ID", "tool_block")
    both = ["set", "part_block", "Distinct_Buckets", "tool_block"]
    # A number that is given is kept: by the few bytes of the blocks all pairs would be one task's.
    n = int(gbom.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = part_blocks.join(tool_blocks.drop("members"), "set").repartition(n, *both)
    right = tool_blocks.join(part_blocks.drop("members"), "set").repartition(n, *both)
    pairs = left.select(*both, F.explode("members").alias("Part_Number")).join(
        right.select(*both, F.explode("members").alias("Tool_ID")), both
    )
    return pairs.select("Part_Number", "Tool_ID", "Distinct_Buckets")


#: Members of a block, about.
_BLOCK = 1000


def _blocks(rows: DataFrame, keys: list[str], member: str, block: str) -> DataFrame:
    """(keys, block, members): the members of each key, of which none is null, dealt by their hash in blocks of about ``_BLOCK``."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / _BLOCK).alias("blocks"))
    dealt = rows.join(sizes, keys).select(*keys, member, F.pmod(F.xxhash64(member), "blocks").alias(block))
    return dealt.groupBy(*keys, block).agg(F.collect_list(member).alias("members"))


def offending_tools(
    gbom: DataFrame,
    tools: DataFrame,
    asof: dt.date,
    n: int = 5,
    inactive: Sequence[str] = params.INACTIVE_STATUSES,
) -> DataFrame:
    """The list entries of the first ``n`` tools of ``bucket_consistency``, by part, then by tool.

    Pairs of a part and a tool are not made: the least part of each set of configurations goes to the listings that offend
    with the set, the least of these to the tools.
    """
    suspects = _suspects(tools, asof, inactive)
    parts = gbom_by_part(gbom).groupBy("configs").agg(F.min("Part_Number").alias("first_part"))
    per_listing = _offences(parts, suspects).join(parts, "configs").groupBy("listing").agg(F.min("first_part").alias("first_part"))
    first = suspects.join(per_listing, "listing").orderBy("first_part", "Tool_ID").limit(n).select("Tool_ID")
    used = gbom.select("Three_CEID", to_int(F.col("Process_Node")).alias("Process_Node")).distinct()
    rows = _active(tools, asof, inactive).select("Tool_ID", *_CONFIG, "Warranty_Start", "Age_Bucket").distinct()
    same_config = rows["Three_CEID"].eqNullSafe(used["Three_CEID"]) & rows["Process_Node"].eqNullSafe(
        used["Process_Node"]
    )
    return rows.join(first, "Tool_ID", "left_semi").join(used, same_config, "left_semi")
