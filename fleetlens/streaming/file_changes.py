"""A streaming source of file arrivals: files that are new, and files that were rewritten under their name.

The offset is what the folders hold: modification time and length of each file by path.  A batch is the files whose entry
differs between two offsets, so a restart from a checkpoint sees nothing twice, and a file that changes is seen again.  Only
the driver lists folders; tasks get the names.  An offset has an entry per file below the root, one week's folder after the
other, so it grows with the weeks that are kept, not with rows.

This module needs nothing of the package, as its classes are sent to Spark's workers by value.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import posixpath
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Changed(InputPartition):
    """Some of the files that a batch consists of."""

    def __init__(self, files: list[tuple[str, int, int]]):
        self.files = files


class FileChangesReader(DataSourceStreamReader):
    #: Files of one partition.
    SIZE = 1000

    def __init__(self, root: str, pattern: str):
        self.root, self.pattern = root, pattern

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Modification time (ns) and length of the files that match, in folders right below the root."""
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("/") else fs.FileSystem.from_uri("file://" + posixpath.abspath(self.root))
        found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        files = {}
        for info in found:
            inner = posixpath.relpath(info.path, root)
            if info.type == fs.FileType.File and inner.count("/") == 1 and fnmatch.fnmatch(info.base_name, self.pattern) and info.size:
                files[info.path] = [info.mtime_ns or 0, info.size]
        return files

    def partitions(self, start: dict, end: dict) -> list[Changed]:
        changed = [(path, *entry) for path, entry in sorted(end.items()) if start.get(path) != entry]
        return [Changed(changed[i : i + self.SIZE]) for i in range(0, len(changed), self.SIZE)]

    def read(self, partition: Changed) -> Iterator[tuple]:
        for path, modified, length in partition.files:
            yield path, dt.datetime.fromtimestamp(modified / 1e9, dt.timezone.utc), length

    def commit(self, end: dict) -> None:
        pass


class FileChanges(DataSource):
    """Options: path, the root folder, and pattern, of file names in the folders below it."""

    @classmethod
    def name(cls) -> str:
        return "file_changes"

    def schema(self) -> str:
        return "path string, modificationTime timestamp, length long"

    def streamReader(self, schema) -> FileChangesReader:
        return FileChangesReader(self.options["path"], self.options.get("pattern", "*"))


def file_changes(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, modificationTime, length) of the files `root/*/pattern`, each time that one is new or differs, as a stream."""
    spark.dataSource.register(FileChanges)
    return spark.readStream.format("file_changes").option("pattern", pattern).load(root)
