"""Python data sources: directory listings (links and depth included) and SQLite files."""

from __future__ import annotations

import os
import re
import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition


class ListingReader(DataSourceReader):
    def __init__(self, root: str, depth: int, dirs: bool) -> None:
        self.root, self.depth, self.dirs = root, depth, dirs

    def partitions(self) -> list[InputPartition]:
        """A task for each entry right under the root."""
        return [InputPartition(e.path) for e in sorted(os.scandir(self.root), key=lambda e: e.name) if e.is_dir(follow_symlinks=False)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import datetime as dt

        job, stack = partition.value, [(partition.value, 1)]
        while stack:
            folder, level = stack.pop()
            if self.dirs:
                yield job, os.path.relpath(folder, job), 0, dt.datetime.fromtimestamp(os.stat(folder).st_mtime, dt.timezone.utc), False, level
            try:
                entries = sorted(os.scandir(folder), key=lambda e: e.name)
            except OSError:
                continue
            for e in entries:
                if e.is_dir(follow_symlinks=False):
                    if level < self.depth:
                        stack.append((e.path, level + 1))
                elif not self.dirs:
                    s = e.stat(follow_symlinks=False)
                    yield job, os.path.relpath(e.path, job), s.st_size, dt.datetime.fromtimestamp(s.st_mtime, dt.timezone.utc), e.is_symlink(), level


class Listing(DataSource):
    """``format("listing")`` with options path, depth (default: no limit) and dirs ("true": directories instead of files).

    Links are not followed. It reads a mounted file system; object stores are listed by Spark's binaryFile reader.
    """

    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return "job_dir string, rel_path string, size long, mtime timestamp, is_symlink boolean, depth int"

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self.options["path"], int(self.options.get("depth", 1 << 30)), self.options.get("dirs", "false") == "true")


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, columns: list[str], parts: int) -> None:
        self.path, self.table, self.columns, self.parts, self.where = path, table, columns, parts, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality filters go into the file's own WHERE."""
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and isinstance(f.value, (int, str)):
                self.where.append((f.attribute[0], f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.parts)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        quote = lambda c: '"' + c.replace('"', '""') + '"'
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            have = {r[1] for r in con.execute(f"PRAGMA table_info({quote(self.table)})")}
            names = [quote(c) if c in have else "NULL" for c in self.columns]
            tests = [f"rowid % {self.parts} = {partition.value}", *(f"{quote(c)} = ?" for c, _ in self.where)]
            rows = con.execute(f"SELECT {', '.join(names)} FROM {quote(self.table)} WHERE {' AND '.join(tests)} ORDER BY rowid", [v for _, v in self.where])
            yield from rows


class Sqlite(DataSource):
    """``format("sqlite")`` with options path, table, parts; only the requested schema's columns are read, absent ones are NULL."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        kinds = {"INTEGER": "bigint", "REAL": "double", "TEXT": "string", "BLOB": "binary"}
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as con:
            info = con.execute(f'PRAGMA table_info("{self.options.get("table", "structures")}")').fetchall()
        return ", ".join(f"`{r[1]}` {kinds.get(r[2].upper().split()[0] if r[2] else 'TEXT', 'string')}" for r in info)

    def reader(self, schema) -> DataSourceReader:
        return SqliteReader(self.options["path"], self.options.get("table", "structures"), schema.names, int(self.options.get("parts", 1)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Listing)
    spark.dataSource.register(Sqlite)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_listing(spark: SparkSession, root: str, depth: int | None = None, dirs: bool = False) -> DataFrame:
    register(spark)
    reader = spark.read.format("listing").option("path", root).option("dirs", str(dirs).lower())
    return (reader if depth is None else reader.option("depth", depth)).load()


def read_sqlite(spark: SparkSession, path: str, table: str = "structures", parts: int = 1, schema: str | None = None) -> DataFrame:
    register(spark)
    reader = spark.read.format("sqlite").option("path", path).option("table", table).option("parts", parts)
    return (reader.schema(schema) if schema else reader).load()


def read_chunks(spark: SparkSession, folder: str, table: str = "structures") -> DataFrame:
    """Every ``*.db`` of a folder, in order of name; ``chunk`` is the file's place."""
    from campanile.sources.tables import stacked

    names = sorted(n for n in os.listdir(folder) if n.endswith(".db"))
    return stacked([read_sqlite(spark, os.path.join(folder, n), table) for n in names])


def read_spark_listing(spark: SparkSession, path: str) -> DataFrame:
    """A listing by Spark's own reader, for any store it knows; links are followed, empty folders unseen."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    return df.select(F.regexp_replace("path", r"/[^/]*$", "").alias("job_dir"), F.substring_index("path", "/", -1).alias("rel_path"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), F.lit(False).alias("is_symlink"))


def matching_jobs(df: DataFrame, glob: str = "job_*", column: str = "job_dir") -> DataFrame:
    """Rows whose directory's own name matches a pattern of ``*`` and ``?``."""
    pattern = "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob)
    return df.where(F.regexp_extract(column, r"([^/]*)/*$", 1).rlike(f"^{pattern}$"))


def read_npy(spark: SparkSession, path: str, glob: str = "*.npy") -> DataFrame:
    """(path, shape, values, error) of ``.npy`` files of numbers, values in row order as doubles. Pickled objects are refused, never loaded."""
    import io

    import numpy as np

    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "content")

    def one(raw: bytes) -> tuple[list[int] | None, list[float] | None, str | None]:
        try:
            a = np.load(io.BytesIO(raw), allow_pickle=False)
            return list(a.shape), a.astype(float).ravel().tolist(), None
        except (ValueError, TypeError, EOFError, OSError) as e:
            return None, None, f"{type(e).__name__}: {e}"[:200]

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            rows = [one(raw) for raw in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"], "shape": [r[0] for r in rows], "values": [r[1] for r in rows], "error": [r[2] for r in rows]})

    return df.mapInPandas(run, "path string, shape array<long>, values array<double>, error string")
