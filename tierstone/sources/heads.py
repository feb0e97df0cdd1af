"""First lines of many files, as a data source that opens each file and reads its first block only."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from typing import BinaryIO
from urllib.parse import quote, unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tierstone.functions.cleaning import BOM

FORMAT = "file_heads"
#: Bytes that are read at once; one block is enough unless a header is longer.
BLOCK = 1 << 16
FILES_PER_TASK = 64
#: Of these the part behind the scheme is a path that the store's client takes as it is.
_RENAMED = {"s3a": "s3", "s3n": "s3"}


def first_line(file: BinaryIO, block: int = BLOCK) -> tuple[str | None, int]:
    """The first line that is not blank, without byte-order mark, and how many bytes were read for it."""
    data, read = b"", 0
    while True:
        more = file.read(block)
        read += len(more)
        data += more
        lines = re.split(b"\r\n|\n|\r", data)
        # the last one may go on in the next block
        for line in lines if not more else lines[:-1]:
            text = line.decode("utf-8", "replace").removeprefix(BOM)
            if re.search(r"[^\x00-\x20]", text):
                return text, read
        if not more:
            return None, read
        data = lines[-1]


def open_anywhere(path: str) -> BinaryIO:
    """A stream of a file's bytes, unpacked if its name says that it is packed; names are not URL-encoded."""
    from pyarrow import fs

    parts = urlparse(quote(path, safe=":/"))
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_stream(unquote(parts.path))
    scheme = _RENAMED.get(parts.scheme, parts.scheme)
    store, inner = fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{parts.path}")
    return store.open_input_stream(inner)


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(len(paths))
        self.paths = paths


class _HeadReader(DataSourceReader):
    def __init__(self, paths: list[str], files_per_task: int):
        self.paths, self.files_per_task = paths, files_per_task

    def partitions(self) -> Sequence[InputPartition]:
        n = self.files_per_task
        return [_Files(self.paths[i : i + n]) for i in range(0, len(self.paths), n)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for path in partition.paths:
            try:
                with open_anywhere(path) as file:
                    header, read = first_line(file)
                yield path, header, read, None
            except Exception as e:  # noqa: BLE001  a store that only Spark's own readers know
                yield path, None, 0, f"{type(e).__name__}: {e}"[:500]


class FileHeads(DataSource):
    """``spark.read.format("file_heads").option("paths", <JSON list>)``: (path, header, bytes_read, error)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, header string, bytes_read long, error string"

    def reader(self, schema) -> DataSourceReader:
        return _HeadReader(json.loads(self.options["paths"]), int(self.options.get("files_per_task", FILES_PER_TASK)))


def file_heads(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header, bytes_read, error) of each file; ``error`` says why a file could not be opened directly."""
    spark.dataSource.register(FileHeads)
    return spark.read.format(FORMAT).option("paths", json.dumps(list(paths))).load()
