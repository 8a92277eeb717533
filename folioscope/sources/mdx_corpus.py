"""The ``mdx_corpus`` and ``corpus_files`` data sources.

``mdx_corpus`` finds every regular file named ``index.mdx`` below a root, hidden
folders and empty files included, orders them by the bytes of their relative path
and reads them on the executors. ``corpus_files`` lists all files and folders
below a root without reading them. Both list on the driver, as a directory
listing is a service of one file system; only paths are held there.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ARTICLE = "index.mdx"
CORPUS_SCHEMA = "row_idx long, rel_path string, dir_name string, content binary"
FILES_SCHEMA = "path string, abs_path string, kind string, size long"


def discover(root: str) -> list[str]:
    """Relative paths of all articles, in the order of their bytes."""
    found = []
    for folder, _, names in os.walk(root):
        if ARTICLE in names and os.path.isfile(os.path.join(folder, ARTICLE)):
            found.append(os.path.relpath(os.path.join(folder, ARTICLE), root).replace(os.sep, "/"))
    return sorted(found, key=lambda p: p.encode("utf-8", "surrogateescape"))


class _Slice(InputPartition):
    def __init__(self, first: int, paths: list[str]):
        self.first, self.paths = first, paths


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options.get("path") or options.get("root") or ""
        if not os.path.isdir(self.root):
            raise ValueError(f"not a folder: {self.root!r}")
        self.per_slice = max(1, int(options.get("filesPerPartition", "256")))
        self.limit = int(options.get("limit", "0"))

    def _slices(self, paths: list[str]) -> list[InputPartition]:
        return [_Slice(k, paths[k : k + self.per_slice]) for k in range(0, len(paths), self.per_slice)] or [_Slice(0, [])]


class _ArticleReader(_Reader):
    def partitions(self):
        paths = discover(self.root)
        return self._slices(paths[: self.limit] if self.limit > 0 else paths)

    def read(self, partition) -> Iterator[tuple]:
        for k, path in enumerate(partition.paths):
            full = os.path.join(self.root, path)
            try:
                with open(full, "rb") as file:
                    content = file.read()
            except OSError:
                content = None
            yield partition.first + k, path, os.path.basename(os.path.dirname(os.path.abspath(full))), content


class _FileReader(_Reader):
    def partitions(self):
        root = os.path.realpath(self.root)
        paths = [os.path.join(folder, x) for folder, folders, files in os.walk(root) for x in (*folders, *files)]
        return self._slices(sorted(os.path.relpath(p, root) for p in paths))

    def read(self, partition) -> Iterator[tuple]:
        root = os.path.realpath(self.root)
        for path in partition.paths:
            full = os.path.realpath(os.path.join(root, path))
            file = os.path.isfile(full)
            yield path.replace(os.sep, "/"), full, "file" if file else "other", os.path.getsize(full) if file else None


class MdxCorpus(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mdx_corpus"

    def schema(self) -> str:
        return CORPUS_SCHEMA

    def reader(self, schema):
        return _ArticleReader(dict(self.options))


class CorpusFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "corpus_files"

    def schema(self) -> str:
        return FILES_SCHEMA

    def reader(self, schema):
        return _FileReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MdxCorpus)
    spark.dataSource.register(CorpusFiles)


def read_corpus(spark: SparkSession, root: str, limit: int = 0) -> DataFrame:
    """(row_idx, rel_path, dir_name, content); ``limit`` takes the first articles in order."""
    register(spark)
    return spark.read.format("mdx_corpus").option("limit", str(limit)).load(root)


def read_files(spark: SparkSession, root: str) -> DataFrame:
    register(spark)
    return spark.read.format("corpus_files").load(root)
