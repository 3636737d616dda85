"""What the text operators share: folders all executors see, splits by checksum, small helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The six characters of ``[\x20\x09-\x0D]``.
ASCII_SPACE = " \t\n\x0b\x0c\r"

_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where none is set and all runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="campanile-")
    return _own_folder[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again, which cuts its lineage.

    The files outlive lost executors. They stay until they are discarded or the folder is cleaned.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(table: DataFrame) -> None:
    """Deletes a written table's files; only for a table that no plan reads any more."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._written_to)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def if_small(table: DataFrame, rows: int = 100_000) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if it has at most so many rows (checked here)."""
    return F.broadcast(table) if table.count() <= rows else table


def checksum_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType | str) -> DataFrame:
    """``mapInArrow`` for a function of one batch; a task that reads no rows runs nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from split_large(batch, fn)

    return df.mapInArrow(run, schema)


#: Batches of texts are worked on in slices of about so many bytes, so memory doesn't depend on text lengths.
SLICE_BYTES = 8 << 20


def split_large(batch: pa.RecordBatch, fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply fn to slices of at most about SLICE_BYTES (a single longer row makes a slice of its own)."""
    rows = batch.num_rows
    step = max(1, min(rows, int(rows * SLICE_BYTES / max(1, batch.nbytes))))
    for at in range(0, rows, step):
        yield fn(batch.slice(at, step))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
