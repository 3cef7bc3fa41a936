"""A listing of files as a Spark source: names and sizes, files of no bytes included.

Spark's own file sources leave out files of no bytes. This one lists a folder through Arrow's file
systems, so it reads what Arrow can: local folders and the common remote ones. Tasks get this module with
their code, so workers need not be able to import it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from fnmatch import fnmatch

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

SOURCE = "songloom_listing"


class FileListing(DataSource):
    """Options: ``folder``; ``pattern`` for names; ``largest``, the most bytes that a listed file has."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "name string, length bigint"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.pattern = options["folder"], options.get("pattern", "*")
        self.largest = int(options["largest"]) if "largest" in options else None

    def read(self, partition) -> Iterator[tuple[str, int]]:
        from pyarrow import fs

        folder = self.folder
        if folder.startswith("file:/") and not folder.startswith("file://"):
            folder = f"file://{folder.removeprefix('file:')}"
        system, path = fs.FileSystem.from_uri(folder)
        for entry in system.get_file_info(fs.FileSelector(path)):
            if entry.type == fs.FileType.File and fnmatch(entry.base_name, self.pattern):
                if self.largest is None or entry.size <= self.largest:
                    yield entry.base_name, entry.size


def list_files(spark: SparkSession, folder: str, pattern: str = "*", largest: int | None = None) -> DataFrame:
    """``(name, length)`` of the files directly in a folder."""
    spark.dataSource.register(FileListing)
    listing = spark.read.format(SOURCE).option("folder", folder).option("pattern", pattern)
    return (listing if largest is None else listing.option("largest", str(largest))).load()


cloudpickle.register_pickle_by_value(sys.modules[__name__])
