"""Writers: snapshots, shards, geometry files, reports and logs."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from campanile.functions import xyz
from campanile.operators.sampling import chunked
from campanile.schemas import JOBS, validate_extra_columns, with_missing_columns


def write_snapshot(jobs: DataFrame, path: str) -> DataFrame:
    """The job table as Parquet by status, and read again: a status filter prunes files."""
    jobs.write.mode("errorifexists").partitionBy("status").parquet(path)
    return jobs.sparkSession.read.schema(jobs.schema).parquet(path).select(jobs.columns)


def with_defaults(rows: DataFrame, now: Column | None = None, extra: Mapping[str, str] | None = None) -> DataFrame:
    """Rows as they are inserted: the job table's columns, to_run and no failures unless they say otherwise, dated; extra columns are checked."""
    names = validate_extra_columns(dict(extra or {}))
    if missing := [c for c in names if c not in rows.columns]:
        raise ValueError(f"missing columns: {missing}")
    at = now if now is not None else F.current_timestamp()
    full = with_missing_columns(rows, JOBS)
    given = {"status": F.coalesce("status", F.lit("to_run")), "fail_count": F.coalesce("fail_count", F.lit(0)), "created_at": F.coalesce("created_at", at), "updated_at": F.coalesce("updated_at", at)}
    return full.withColumns(given).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in JOBS], *names)


def append_rows(path: str, rows: DataFrame, now: Column | None = None, extra: Mapping[str, str] | None = None) -> None:
    """New rows of the job table, with defaults."""
    with_defaults(rows, now, extra).write.mode("append").partitionBy("status").parquet(path)


def write_files(files: DataFrame) -> DataFrame:
    """Writes each row's text to its path (path, text) on a mounted file system, whole or not at all, and tells (path, error).

    Executors write beside the target and rename, so readers never see half a file and a task that is run again only replaces it. Nothing is
    written until the result is used.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            errors: list[str | None] = []
            for path, text in zip(pdf["path"], pdf["text"], strict=True):
                beside = f"{path}.{uuid.uuid4().hex}.tmp"
                try:
                    with open(beside, "w", encoding="utf-8", newline="") as f:
                        f.write(text or "")
                    os.replace(beside, path)
                    errors.append(None)
                except OSError as e:
                    errors.append(f"{type(e).__name__}: {e.strerror}")
            yield pd.DataFrame({"path": pdf["path"], "error": pd.Series(errors, dtype=object)})

    return files.select("path", "text").mapInPandas(run, "path string, error string")


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    df.write.mode("errorifexists").partitionBy(shard).parquet(path)


def read_shard(spark: SparkSession, path: str, name: str, shard: str = "shard") -> DataFrame:
    return spark.read.parquet(path).where(F.col(shard) == name)


def manifest(df: DataFrame, geometry: str, size: int = 10_000, index: str = "orig_index") -> DataFrame:
    """(orig_index, chunk_file, index_in_chunk, elements) of the rows that have a geometry."""
    rows = chunked(df, index, geometry, size)
    return rows.select(F.col(index).alias("orig_index"), F.format_string("chunk_%d.xyz", "chunk").alias("chunk_file"), "index_in_chunk", xyz.elements_text(F.col(geometry)).alias("elements"))


def write_chunks(df: DataFrame, path: str, geometry: str, size: int = 10_000, index: str = "orig_index") -> None:
    """Geometries as text files by chunk, in order, with headers; and the manifest as CSV."""
    rows = chunked(df, index, geometry, size)
    text = rows.select("chunk", index, xyz.to_text(xyz.atoms(F.col(geometry)), F.col(index).cast("string")).alias("value"))
    text.repartition("chunk").sortWithinPartitions("chunk", index).select("chunk", "value").write.partitionBy("chunk").text(f"{path}/chunks")
    manifest(df, geometry, size, index).write.option("header", True).csv(f"{path}/manifest")


def extended_xyz(rows: DataFrame) -> DataFrame:
    """(job_dir, value): a frame with properties from symbols, positions, forces, energy_ev, charge, mult."""
    vectors = F.transform(F.sequence(F.lit(0), F.size("symbols") - 1), lambda i: F.slice("forces", i * 3 + 1, 3))
    z = F.arrays_zip(F.col("symbols").alias("s"), F.col("positions").alias("p"), vectors.alias("f"))
    line = F.transform(z, lambda a: F.format_string("%s" + " %.10f" * 6, a["s"], *[a[k][i] for k in "pf" for i in range(3)]))
    head = F.format_string("Properties=species:S:1:pos:R:3:forces:R:3 energy=%.10f charge=%d spin=%d pbc=\"F F F\"", "energy_ev", "charge", "mult")
    return rows.where("failure is null").select("job_dir", F.concat_ws("\n", F.size("symbols").cast("string"), head, F.array_join(line, "\n")).alias("value"))


def extraction_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("failure", F.lit("ok")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def marker_json(generated_by: str, now: Column, fields: Mapping[str, Column]) -> Column:
    """A marker file's text."""
    date = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.to_json(F.struct(F.lit(generated_by).alias("generated_by"), date.alias("date"), *[c.alias(k) for k, c in fields.items()]))


def cache_json(metrics: Sequence[str], source_mtime: Column) -> Column:
    return F.to_json(F.struct(source_mtime.cast("double").alias("_source_mtime"), *metrics))


def write_report(df: DataFrame, path: str, separator: str = ",") -> None:
    """A small report as one file with a header."""
    df.coalesce(1).write.option("header", True).option("sep", separator).csv(path)


def task_map(jobs: DataFrame, order: str = "id") -> DataFrame:
    """(task_id, job_id, job_dir) of a batch that one driver submits."""
    return jobs.select((F.row_number().over(Window.orderBy(order)) - 1).alias("task_id"), F.col("id").alias("job_id"), "job_dir")


def logged(row: DataFrame, at: Column) -> DataFrame:
    """One row of numbers as (ts, key, value) rows for an append-only log."""
    numbers = [c for c, t in row.dtypes if t in ("int", "bigint", "double", "float")]
    return row.select(at.alias("ts"), F.explode(F.create_map(*[x for c in numbers for x in (F.lit(c), F.col(c).cast("double"))])).alias("key", "value"))


def destinations(paths: DataFrame, root: str, target: str, column: str = "job_dir") -> DataFrame:
    """Where each path under the root goes; a path outside it is an error."""
    inside = F.col(column).startswith(root.rstrip("/") + "/")
    rest = F.substr(F.col(column), F.lit(len(root.rstrip("/")) + 1))
    return paths.withColumn("destination", F.when(inside, F.concat(F.lit(target.rstrip("/")), rest)).otherwise(F.raise_error(F.concat(F.lit("outside root: "), F.col(column)))))


def transfer_list(jobs: DataFrame) -> DataFrame:
    return jobs.where((F.trim("job_dir") != "") & F.col("job_dir").isNotNull()).select("job_dir").distinct().orderBy("job_dir")


def transfer_summary(paths: DataFrame, existing: DataFrame) -> DataFrame:
    """One row on a transfer list (job_dir): how many directories, how many of them exist (existing: job_dir), and the folder they have in common."""
    there = existing.select(F.col("job_dir").alias("_dir")).distinct()
    seen = paths.join(there, F.col("job_dir") == F.col("_dir"), "left")
    out = seen.agg(F.count(F.lit(1)).alias("n"), F.count("_dir").alias("existing"), F.min("job_dir").alias("_a"), F.max("job_dir").alias("_z"))
    # what the first and the last in order have in common, all have
    same = F.filter(F.sequence(F.lit(0), F.least(F.length("_a"), F.length("_z"))), lambda i: F.substring(F.col("_a"), F.lit(1), i) == F.substring(F.col("_z"), F.lit(1), i))
    common = F.regexp_replace(F.left("_a", F.array_max(same)), r"[^/]*$", "")
    return out.select("n", "existing", (F.col("n") - F.col("existing")).alias("missing"), common.alias("prefix"))
