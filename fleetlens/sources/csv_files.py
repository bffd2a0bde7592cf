"""Weekly folders of CSV files.

Below a root there is one folder per fiscal week.  It holds one state file and any number of counter
files, of which the one modified last counts.  So there is at most one file per week and kind, and
the list of files to read is as short as the list of weeks; their rows are only touched by tasks.
Spark does not list files of zero bytes: they count as absent.
"""

from __future__ import annotations

import csv
import datetime as dt
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F, types as T

from fleetlens import params
from fleetlens.functions import counter_date, utc_literal, utc_time
from fleetlens.operators.keys import latest_file_per_week, with_tool_keys
from fleetlens.operators.relational import dedup_keep_last, recent_work_weeks, union_dynamic
from fleetlens.sources.tables import once

_FILES = "ww string, rank bigint, path string, modified timestamp"
_REPORT = (
    "ww string, path string, loaded boolean, reason string, encoding string, "
    "missing array<string>, extra array<string>"
)
_REJECTED = "ww string, path string, line bigint, reason string, text string"
_WEEK_IN_PATH = r"/([^/]+)/[^/]+$"
# A cell in quotes, and one whose quotes the line doesn't close.
_QUOTED_CELL = r'(^|,)"(?:[^"]++|"")*+"'
_OPEN_CELL = r'(^|,)"'
_ORDER = ["_rank", "_path", "_block", "_row"]


@dataclass(frozen=True)
class Loaded:
    """Rows of the files that could be read, one report row per file, and the lines that are no rows."""

    rows: DataFrame
    report: DataFrame
    rejected: DataFrame


def weeks_for_mode(mode: str, weeks: int = params.WEEKS_TO_LOAD) -> int:
    """Full loads take the last ``weeks`` weeks, incremental ones the current week."""
    if mode not in ("full", "incremental"):
        raise ValueError(f"mode must be 'full' or 'incremental', not {mode!r}")
    return weeks if mode == "full" else 1


def _files(spark: SparkSession, root: str, weeks: DataFrame, pattern: str) -> DataFrame:
    """(ww, rank, path, modified) of matching files in the folders of ``weeks``; others are not listed."""
    labels = [row.ww for row in weeks.select("ww").collect()]
    try:
        found = spark.read.format("binaryFile").load(f"{root}/{{{','.join(labels)}}}/{pattern}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _FILES)
    return (
        found.select(
            F.regexp_extract("path", _WEEK_IN_PATH, 1).alias("ww"), "path", F.col("modificationTime").alias("modified")
        )
        .join(weeks, "ww")
        .select("ww", "rank", "path", "modified")
    )


def discover_state_files(
    spark: SparkSession, root: str, weeks: DataFrame, name: str = params.STATE_FILE_NAME
) -> DataFrame:
    """The state file of each week that has one."""
    return _files(spark, root, weeks, name)


def discover_counter_files(
    spark: SparkSession, root: str, weeks: DataFrame, prefix: str = params.COUNTER_FILE_PREFIX
) -> DataFrame:
    """The counter file of each week that was modified last, whatever date its name tells."""
    newest = latest_file_per_week(_files(spark, root, weeks, f"{prefix}*.csv"), "ww", "path", "modified")
    return newest.join(weeks, "ww").select("ww", "rank", "path", "modified")


def _reader(spark: SparkSession, encoding: str, multiline: bool):
    return spark.read.options(header=True, encoding=encoding, escape='"', multiLine=multiline)


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The files' lines as they are, read once: place, bytes, whether they are UTF-8, number of cells, quotes left open."""
    value = F.col("value")
    unquoted = F.regexp_replace("value", _QUOTED_CELL, "$1")
    lines = spark.read.text(list(paths)).select(
        F.regexp_extract("_metadata.file_path", _WEEK_IN_PATH, 1).alias("load_ww"),
        F.col("_metadata.file_name").alias("source_file"),
        utc_time(F.col("_metadata.file_modification_time")).alias("file_modified_ts"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        value.cast("binary").alias("bytes"),
        (F.trim("value") == "").alias("blank"),
        F.is_valid_utf8("value").alias("valid"),
        (F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1).alias("cells"),
        unquoted.rlike(_OPEN_CELL).alias("open"),
    )
    return once(lines)


def _decoded(charset: str) -> Column:
    return F.decode(F.col("bytes"), charset)


def _names(line: str) -> list[str]:
    """Column names of a header line; nameless columns and repeated names get a number."""
    names = next(csv.reader([line.removeprefix("\ufeff")]), [])
    lower = Counter(name.lower() for name in names)
    return [f"_c{i}" if not name else f"{name}{i}" if lower[name.lower()] > 1 else name for i, name in enumerate(names)]


def read_csv_files(
    spark: SparkSession,
    files: DataFrame,
    required: Sequence[str],
    expected: Sequence[str] = (),
    encoding: str = "auto",
    multiline: bool | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    ragged: str = "reject",
) -> Loaded:
    """All files as strings, with the union of their columns in order of first appearance.

    ``prepare`` is applied to files of the same header together, before the union.

    The files' lines are read once, as bytes.  With ``encoding='auto'`` a file is UTF-8 if all its lines are, else Latin-1.
    A file that lacks a required column, or has none at all, is rejected; the others go on.  So is a file with a line of
    more cells than the header (``ragged='reject'``); ``'report'`` loads its other lines, ``'cut'`` drops the surplus cells.
    Either way these lines are among the rejected ones, with their numbers.  Missing cells at a line's end are null, and
    so are cells that spell a missing value.  A file with line breaks in quoted cells is not split between tasks;
    ``multiline=False`` reads such cells as broken lines instead.

    Columns ``_rank``, ``_path``, ``_block`` and ``_row`` put the rows in order: weeks newest first,
    and within a file as written.
    """
    if ragged not in ("reject", "report", "cut"):
        raise ValueError(f"ragged must be 'reject', 'report' or 'cut', not {ragged!r}")
    chosen = files.orderBy("rank", "path").collect()
    lines = _lines(spark, [f.path for f in chosen]) if chosen else None
    of_file = _file_summaries(lines) if chosen else {}
    groups: dict[tuple[tuple[str, ...], str, bool], list[Row]] = {}
    report, surplus = [], []
    for file in chosen:
        seen = of_file.get((file.ww, file.path.rsplit("/", 1)[-1]))
        charset = ("UTF-8" if seen is None or seen.valid else "ISO-8859-1") if encoding == "auto" else encoding
        header = _names(bytes(seen.header).decode(charset, "replace")) if seen and seen.header is not None else None
        missing = sorted(set(expected or required) - set(header or []))
        extra = [name for name in header or [] if expected and name not in expected]
        lacking = [name for name in required if name not in (header or [])]
        reason = f"missing required columns: {', '.join(lacking)}" if header and lacking else None
        reason = reason if header else "no columns could be read"
        # Lines that begin or end within a quoted cell have any number of cells.
        whole = bool(seen and seen.open and multiline is not False)
        if reason is None and seen.most_cells > len(header) and not whole:
            surplus.append((file.ww, seen["_path"], len(header), charset))
            if ragged == "reject":
                reason = f"lines of more than {len(header)} cells"
        report.append((file.ww, file.path, reason is None, reason, charset, missing, extra))
        if reason is None:
            groups.setdefault((tuple(header), charset, whole or bool(multiline)), []).append(file)
    frames = [
        prepare(_read_group(spark, lines, header, charset, whole, members, ragged))
        for (header, charset, whole), members in groups.items()
    ]
    rows = union_dynamic(frames) if frames else prepare(_no_rows(spark, required))
    return Loaded(rows, spark.createDataFrame(report, _REPORT), _rejected(spark, lines, surplus))


def _file_summaries(lines: DataFrame) -> dict[tuple[str, str], Row]:
    """One row per file with any line: its header, whether it is UTF-8, its longest line, whether quotes span lines."""
    place = F.struct("_block", "_row")
    told = F.when(~F.col("blank"), place)
    found = lines.groupBy("load_ww", "source_file", "_path").agg(
        F.bool_and("valid").alias("valid"),
        F.min_by("bytes", told).alias("header"),
        F.max(F.when(~F.col("blank"), F.col("cells"))).alias("most_cells"),
        F.bool_or("open").alias("open"),
        F.bool_and("blank").alias("blank"),
    )
    return {(row.load_ww, row.source_file): row for row in found.where(~F.col("blank")).collect()}


def _rejected(spark: SparkSession, lines: DataFrame | None, surplus: list[tuple]) -> DataFrame:
    """Lines with more cells than their file's header, numbered from 1 as in the file."""
    if not surplus:
        return spark.createDataFrame([], _REJECTED)
    named = spark.createDataFrame(surplus, "ww string, _path string, width int, charset string")
    # A split's lines have consecutive numbers; those before it are the lines of the file's splits before.
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.join(F.broadcast(named.select("_path")), "_path", "left_semi").groupBy("_path", "_block")
    splits = splits.agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("n"))
    splits = splits.select("_path", "_block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    found = lines.join(F.broadcast(named), "_path").where((F.col("cells") > F.col("width")) & ~F.col("blank"))
    text = F.when(F.col("charset") == "UTF-8", _decoded("UTF-8")).otherwise(_decoded("ISO-8859-1"))
    reason = F.format_string("%d cells, the header has %d", F.col("cells"), F.col("width"))
    return found.join(splits, ["_path", "_block"]).select(
        "ww", F.col("_path").alias("path"), (F.col("_row") + F.col("shift")).alias("line"), reason.alias("reason"), text.alias("text")
    )


def _read_group(
    spark: SparkSession, lines: DataFrame, header: Sequence[str], charset: str, whole: bool, members: Sequence[Row], ragged: str
) -> DataFrame:
    """Files with the same header, read together: from their lines, or ``whole`` if quoted cells have line breaks."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    rank = F.create_map(*[F.lit(value) for file in members for value in (file.ww, file.rank)])
    place = ["source_file", "load_ww", "file_modified_ts"]
    if whole:
        cells = _reader(spark, charset, True).schema(schema).csv([file.path for file in members])
        cells = cells.select(
            *[_present(name).alias(name) for name in header],
            F.col("_metadata.file_name").alias("source_file"),
            F.regexp_extract("_metadata.file_path", _WEEK_IN_PATH, 1).alias("load_ww"),
            utc_time(F.col("_metadata.file_modification_time")).alias("file_modified_ts"),
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
    else:
        names = [(file.ww, file.path.rsplit("/", 1)[-1]) for file in members]
        mine = F.struct("load_ww", "source_file").isin(*[F.struct(F.lit(ww), F.lit(name)) for ww, name in names])
        own = lines.where(mine & ~F.col("blank"))
        if ragged != "cut":
            own = own.where(F.col("cells") <= len(header))
        first = own.groupBy("_path").agg(F.min(F.struct("_block", "_row")).alias("first"))
        own = own.join(F.broadcast(first), "_path").where(F.struct("_block", "_row") > F.col("first"))
        ddl = ", ".join(f"`{name.replace('`', '``')}` string" for name in header)
        parsed = own.withColumn("row", F.from_csv(_decoded(charset), ddl, {"escape": '"'}))
        quoted = ["`" + name.replace("`", "``") + "`" for name in header]
        cells = parsed.select(
            *[F.when(~F.col(f"row.{q}").isin(*params.MISSING_TEXTS), F.col(f"row.{q}")).alias(name) for q, name in zip(quoted, header)],
            *place, "_path", "_block", "_row",
        )
    return cells.select(
        *[F.col("`" + name.replace("`", "``") + "`") for name in header], *place,
        F.element_at(rank, F.col("load_ww")).alias("_rank"), "_path", "_block", "_row",
    )


def _present(name: str) -> Column:
    cell = F.col(f"`{name}`")
    return F.when(~cell.isin(*params.MISSING_TEXTS), cell)


def _no_rows(spark: SparkSession, required: Sequence[str]) -> DataFrame:
    names = [*required, "source_file", "load_ww", "_path"]
    fields = [T.StructField(name, T.StringType()) for name in names]
    fields += [T.StructField(name, T.LongType()) for name in ("_rank", "_block", "_row")]
    fields.append(T.StructField("file_modified_ts", T.TimestampNTZType()))
    return spark.createDataFrame([], T.StructType(fields))


def _typed(rows: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cells that are no number of the type become null."""
    return rows.withColumns({name: F.col(f"`{name}`").try_cast(kind) for name, kind in types.items()})


def read_states(
    spark: SparkSession,
    files: DataFrame,
    load_ts: dt.datetime,
    encoding: str = "auto",
    multiline: bool | None = None,
    ragged: str = "reject",
    **normalization,
) -> Loaded:
    """State rows with typed hours, tool keys and load metadata."""
    loaded = read_csv_files(
        spark, files, params.STATE_REQUIRED, params.STATE_COLUMNS, encoding, multiline,
        prepare=lambda df: with_tool_keys(df, **normalization), ragged=ragged,
    )
    absent = [name for name in params.STATE_COLUMNS if name not in loaded.rows.columns]
    rows = loaded.rows.select("*", *[F.lit(None).cast("string").alias(name) for name in absent])
    rows = _typed(rows, {"HOURS_IN_STATE": params.HOURS, "Total_Hours": params.HOURS, "% in State": params.PERCENT})
    stamped = rows.withColumn("load_ts", utc_literal(load_ts)).withColumn("load_date", F.lit(load_ts.date()))
    return Loaded(stamped.drop("file_modified_ts"), loaded.report, loaded.rejected)


def read_counters(
    spark: SparkSession,
    files: DataFrame,
    load_ts: dt.datetime,
    date_shift: int = params.COUNTER_DATE_SHIFT_DAYS,
    encoding: str = "auto",
    multiline: bool | None = None,
    ragged: str = "reject",
    **normalization,
) -> Loaded:
    """Counter rows with typed counters, tool keys, the day they describe and load metadata.

    FAB is derived from ENTITY for files without that column.
    """
    loaded = read_csv_files(
        spark, files, params.COUNTER_REQUIRED, encoding=encoding, multiline=multiline,
        prepare=lambda df: with_tool_keys(df, **normalization), ragged=ragged,
    )
    counters = [name for name in loaded.rows.columns if name.endswith(params.COUNTER_SUFFIX)]
    rows = _typed(loaded.rows, {name: params.COUNTER for name in counters}) if counters else loaded.rows
    dated = rows.withColumn("counter_date", counter_date(F.col("file_modified_ts"), date_shift))
    return Loaded(dated.withColumn("load_ts", utc_literal(load_ts)), loaded.report, loaded.rejected)


def keep_last_loaded(rows: DataFrame, keys: Sequence[str], prefer: str = "oldest") -> DataFrame:
    """One row per key: of several weeks the oldest or the newest, within a file the last row."""
    if prefer not in ("oldest", "newest"):
        raise ValueError(f"prefer must be 'oldest' or 'newest', not {prefer!r}")
    rank = F.col("_rank") if prefer == "oldest" else -F.col("_rank")
    return dedup_keep_last(rows, keys, [rank, *_ORDER[1:]]).drop(*_ORDER)


def bronze_states(
    spark: SparkSession,
    root: str,
    asof: dt.date,
    load_ts: dt.datetime,
    mode: str = "full",
    weeks: int = params.WEEKS_TO_LOAD,
    prefer: str = "oldest",
    **options,
) -> Loaded:
    """State rows of the last weeks, one per tool, shift and state."""
    recent = recent_work_weeks(spark, asof, weeks_for_mode(mode, weeks))
    loaded = read_states(spark, discover_state_files(spark, root, recent), load_ts, **options)
    return Loaded(keep_last_loaded(loaded.rows, params.NATURAL_KEYS["entity_states_raw"], prefer), loaded.report, loaded.rejected)


def bronze_counters(
    spark: SparkSession,
    root: str,
    asof: dt.date,
    load_ts: dt.datetime,
    mode: str = "full",
    weeks: int = params.WEEKS_TO_LOAD,
    prefer: str = "oldest",
    **options,
) -> Loaded:
    """Counter rows of the last weeks, one per tool and day."""
    recent = recent_work_weeks(spark, asof, weeks_for_mode(mode, weeks))
    loaded = read_counters(spark, discover_counter_files(spark, root, recent), load_ts, **options)
    return Loaded(keep_last_loaded(loaded.rows, params.NATURAL_KEYS["counters_raw"], prefer), loaded.report, loaded.rejected)
