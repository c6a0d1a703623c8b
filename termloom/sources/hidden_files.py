"""Files whose names Spark's own sources pass over.

Spark does not list names that begin with ``_`` or ``.``, and its binary reader leaves out
files without a byte. Where such files are records all the same, this data source reads
them: the paths are listed with Hadoop's file system when the plan is made, dealt to splits
by size, and each split opens its files where it runs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes and files of a split.
SPLIT_BYTES = 32 << 20
SPLIT_FILES = 1000

NAME = "termloom_files"
SCHEMA = "path string, content binary"


class FilesSplit(InputPartition):
    def __init__(self, paths: tuple[str, ...]):
        super().__init__(paths)
        self.paths = paths


class FilesSource(DataSource):
    """``(path, content)`` of the files listed in the option ``files``, pairs of a path and
    a size as JSON. The content of a file that cannot be opened is null."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FilesReader:
        return FilesReader(json.loads(self.options["files"]))


class FilesReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files

    def partitions(self) -> Sequence[InputPartition]:
        splits, paths, n_bytes = [], [], 0
        for path, size in self.files:
            if paths and (n_bytes + size > SPLIT_BYTES or len(paths) == SPLIT_FILES):
                splits.append(FilesSplit(tuple(paths)))
                paths, n_bytes = [], 0
            paths.append(path)
            n_bytes += size
        return [*splits, FilesSplit(tuple(paths))]

    def read(self, partition: FilesSplit) -> Iterator[tuple]:
        for path in partition.paths:
            yield path, _content(path)


def _content(path: str) -> bytes | None:
    try:
        if path.startswith("file:") or ":" not in path:
            with open(path.removeprefix("file:"), "rb") as file:
                return file.read()
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(quote(path, safe=":/"))
        with system.open_input_stream(inner) as stream:
            return stream.read()
    except (OSError, ValueError, ImportError):
        return None


def list_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Paths and sizes of the regular files that match a Hadoop pattern."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted((s.getPath().toString(), s.getLen()) for s in found or [] if s.isFile())


def read_files(spark: SparkSession, files: list[tuple[str, int]]) -> DataFrame:
    """``(path, content)`` of listed files."""
    spark.dataSource.register(FilesSource)
    return spark.read.format(NAME).option("files", json.dumps(files)).load()
