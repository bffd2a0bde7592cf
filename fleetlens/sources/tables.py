"""Parquet tables: read, append, replace as a whole or by partition, upsert, truncate, count.

Tables are partitioned by a week or date column and sorted by tool inside each file, so that both a
time range and a tool are found through partition pruning and column statistics.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from fleetlens.operators.keys import merge_rows
from fleetlens.operators.relational import dedup_keep_last

_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def read_table(
    spark: SparkSession, path: str, base_path: str | None = None, merge_schema: bool = False
) -> DataFrame | None:
    """The stored table, or None if nothing has been stored there yet.

    ``merge_schema`` gives all columns of a table whose columns grew over time.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    try:
        return reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _read_partitions(spark: SparkSession, path: str, column: str, values: Sequence) -> DataFrame | None:
    """The stored rows of some partitions, without listing the others."""
    names = ",".join("__HIVE_DEFAULT_PARTITION__" if value is None else str(value) for value in values)
    return read_table(spark, f"{path}/{column}={{{names}}}", base_path=path, merge_schema=True)


def read_curated(spark: SparkSession, sources: Mapping[str, str | DataFrame]) -> dict[str, DataFrame]:
    """Whole input tables by name, without blanks around their column names.

    A source is the path of a Parquet table, or any DataFrame, as from a catalog or over JDBC.
    """
    frames = {name: spark.read.parquet(src) if isinstance(src, str) else src for name, src in sources.items()}
    return {name: df.toDF(*[column.strip() for column in df.columns]) for name, df in frames.items()}


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: str | None = None,
    sort_by: Sequence[str] = (),
) -> int:
    """Write rows and return how many; ``mode`` is append, replace or fail.

    With ``partition_by`` rows of a partition are brought together first.  The rebalance splits a
    partition that is too large for one task into several files.
    """
    if mode not in _MODES:
        raise ValueError(f"mode must be one of {sorted(_MODES)}, not {mode!r}")
    return _write(df, path, _MODES[mode], "static", partition_by, sort_by)


def _write(
    df: DataFrame, path: str, mode: str, overwrite: str, partition_by: str | None, sort_by: Sequence[str]
) -> int:
    rows = df.hint("rebalance", F.col(partition_by)) if partition_by else df
    # Counted in the tasks that write, so that a map task run again does not count twice.
    written = Observation()
    rows = rows.observe(written, F.count(F.lit(1)).alias("n"))
    if sort_by:
        rows = rows.sortWithinPartitions(*([partition_by] if partition_by else []), *sort_by)
    writer = rows.write.mode(mode).option("partitionOverwriteMode", overwrite)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return written.get.get("n", 0)


def upsert(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: str,
    order_by: Sequence[str | Column] = (),
    sort_by: Sequence[str] = (),
) -> int:
    """Store rows so that the table has one row per key and new rows replace stored ones.

    The partition column, a date or a week label, is one of the keys, so only partitions that receive
    rows are read and rewritten.  New columns are added, and are null in older rows.  Returns the
    number of rows written.  Running it again changes nothing.
    """
    if partition_by not in keys:
        raise ValueError(f"partition column {partition_by!r} must be one of the keys {list(keys)}")
    order = list(order_by) or [F.lit(0)]
    new = staged(df, path)
    # The list of partitions a write touches is held by the driver in any case: it commits them.
    touched = [row[0] for row in new.select(partition_by).distinct().collect()]
    if not touched:
        return 0
    stored = _read_partitions(df.sparkSession, path, partition_by, touched)
    if stored is None:
        merged = dedup_keep_last(new, keys, order)
    else:
        same_type = F.col(partition_by).cast(new.schema[partition_by].dataType)
        merged = merge_rows(stored.withColumn(partition_by, same_type), new, keys, order)
    return _write(merged, path, "overwrite", "dynamic", partition_by, sort_by)


def replace_partitions(
    df: DataFrame, path: str, partition_by: str, replaced: Column, sort_by: Sequence[str] = ()
) -> int:
    """Store rows as the whole content of their partitions.

    ``replaced`` is a condition on the partition column: stored partitions that meet it and get no row are emptied, so
    that rows which a new computation no longer has do not stay.  All other partitions are left alone, and not read.
    New rows are written before old partitions are emptied; running it again after a failure completes it.
    """
    spark = df.sparkSession
    new = staged(df, path)
    got = {_folder_value(row[0]) for row in new.select(partition_by).distinct().collect()}
    stored = read_table(spark, path, merge_schema=True)
    # Like the partitions of a write, these are held by the driver: one value per emptied day or week.
    held = [] if stored is None else [row[0] for row in stored.where(replaced).select(partition_by).distinct().collect()]
    written = _write(new, path, "overwrite", "dynamic", partition_by, sort_by) if got else 0
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in map(_folder_value, held):
        if value not in got:
            nothing = spark.createDataFrame([], stored.drop(partition_by).schema)
            nothing.write.mode("overwrite").parquet(f"{path}/{partition_by}={escape(value)}")
    return written


def _folder_value(value) -> str:
    """A partition's value as its folder names it, before characters are escaped."""
    return "__HIVE_DEFAULT_PARTITION__" if value is None or value == "" else str(value)


def bucketed_table(
    spark: SparkSession, path: str, columns: str, partition_by: str, bucket_by: str, buckets: int
) -> str:
    """Name of the table at ``path``, dealt into buckets by a column, so that joins on it need not shuffle it.

    The definition lives in the session's catalog only and is made anew where it is missing; ``columns`` is DDL.
    """
    name = f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({partition_by}) "
        f"CLUSTERED BY ({bucket_by}) SORTED BY ({bucket_by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    if read_table(spark, path) is not None:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def replace_bucketed(df: DataFrame, name: str, partition_by: str, bucket_by: str, partitions: Sequence[str]) -> None:
    """Store rows as the whole content of these partitions of a bucketed table."""
    spark = df.sparkSession
    columns = [column for column in spark.table(name).columns if column != partition_by]
    view = f"{name}_new"
    # Each bucket is one task's, so a partition gets one file per bucket.
    buckets = int(spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()["data_type"])
    df.select(*columns, partition_by).repartition(buckets, bucket_by).createOrReplaceTempView(view)
    try:
        for value in partitions:
            rows = f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {view} WHERE {partition_by} = '{value}'"
            spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({partition_by} = '{value}') {rows}")
    finally:
        spark.catalog.dropTempView(view)


def staged(df: DataFrame, path: str) -> DataFrame:
    """The rows computed once, before a write to ``path`` that looks at them several times or overwrites what they read.

    They are kept in the cluster's checkpoint folder (``spark.checkpoint.dir``), or without one in a folder beside the
    table, which the next write to the table replaces.
    """
    if df.sparkSession.sparkContext.getCheckpointDir():
        return df.checkpoint()
    df.write.mode("overwrite").parquet(f"{path}_staged")
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}_staged")


def once(df: DataFrame) -> DataFrame:
    """The rows computed once and stored in the cluster's checkpoint folder (``spark.checkpoint.dir``).

    Only a local session without that setting gets a folder of its own.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()


def _files(spark: SparkSession, path: str):
    """The file system that holds a path, and the path for it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def partition_folders(spark: SparkSession, path: str) -> list[str]:
    """Values of a stored table's partitions, as its folders name them; no file is opened."""
    files, place = _files(spark, path)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place) if status.isDirectory()]
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return sorted(unescape(name.split("=", 1)[1]) for name in names if "=" in name)


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    """Remove the folders of these partitions."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in values:
        files, place = _files(spark, f"{path}/{column}={escape(value)}")
        files.delete(place, True)


def publish(spark: SparkSession, store: str, names: Sequence[str]) -> None:
    """Put the staged tables (``store/_staged/name``) in the place of the stored ones, by moving folders.

    A note of the names comes first and goes last.  What a crash leaves in between is completed by ``recover``: then all
    tables are the new ones.  Without a note all are the old ones, and what is staged counts for nothing.
    """
    note = spark.createDataFrame([(name,) for name in names], "name string").coalesce(1)
    note.write.mode("overwrite").parquet(f"{store}/_publishing")
    recover(spark, store)


def recover(spark: SparkSession, store: str) -> None:
    """Complete a publication that was begun; safe to run at any time and again."""
    note = read_table(spark, f"{store}/_publishing")
    if note is None:
        return
    for name in sorted(row.name for row in note.collect()):
        files, target = _files(spark, f"{store}/{name}")
        _, staged_ = _files(spark, f"{store}/_staged/{name}")
        _, old = _files(spark, f"{store}/_replaced/{name}")
        if not files.exists(staged_):
            continue  # moved already
        if files.exists(target):
            files.delete(old, True)
            files.mkdirs(old.getParent())
            _moved(files, target, old)
        _moved(files, staged_, target)
        files.delete(old, True)
    files, place = _files(spark, f"{store}/_publishing")
    files.delete(place, True)


def _moved(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"could not move {source} to {target}")


def truncate(spark: SparkSession, path: str) -> None:
    """Remove all rows, keep the columns."""
    stored = read_table(spark, path)
    if stored is not None:
        spark.createDataFrame([], stored.schema).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(path)


def row_count(spark: SparkSession, path: str) -> int:
    stored = read_table(spark, path)
    return 0 if stored is None else stored.count()
