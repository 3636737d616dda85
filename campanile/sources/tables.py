"""Job tables from CSV or DataFrames, caches, mappings and generated tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from campanile.operators.ranges import ranked
from campanile.functions.chemistry import spin_ladder
from campanile.functions.xyz import charge_and_multiplicity, elements, input_atoms, to_text
from campanile.schemas import JOBS, validate_extra_columns, with_missing_columns


def read_structures(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with multi-line quoted fields, all as text, with ``orig_index``, the row number in the file."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return with_row_number(df)


def with_row_number(df: DataFrame, name: str = "orig_index") -> DataFrame:
    """Rows numbered from 0 in the order they are read: counts of the partitions before, and the place in the partition.

    Spark's own ids are partition number and place, so numbering needs one small aggregate, no global sort.
    """
    marked = df.withColumn("_id", F.monotonically_increasing_id())
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = marked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return marked.withColumn("_part", part).join(starts, "_part").withColumn(name, F.col("_start") + place).drop("_id", "_part", "_start")


def structures(
    df: DataFrame, geometry: str = "aligned_csd_core", charge: str = "charge", spin: str = "uhf", extra: Mapping[str, str] | None = None, debug: bool = False, chunk: int = 10_000, now: Column | None = None
) -> DataFrame:
    """The job table of a structure table: rows without geometry are skipped, and rows whose spin is below 1; missing columns are errors.

    df has ``orig_index``; ids follow it. debug: the first chunk of raw rows only.
    """
    extra = validate_extra_columns(dict(extra or {}))
    if missing := [c for c in (geometry, *extra) if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    whole = lambda c: F.col(c).try_cast("double").cast("int") if c in df.columns else F.lit(None).cast("int")
    rows = df.where(F.col("orig_index") < chunk) if debug else df
    rows = rows.where(F.col(geometry).isNotNull())
    symbols = elements(F.col(geometry))
    types = {"TEXT": "string", "INTEGER": "bigint", "REAL": "double", "BLOB": "binary", "NUMERIC": "decimal(38,10)"}
    out = rows.select(
        F.col("orig_index").cast("long").alias("orig_index"), F.array_join(symbols, ";").alias("elements"), F.size(symbols).alias("natoms"), F.lit("to_run").alias("status"),
        whole(charge).alias("charge"), whole(spin).alias("spin"), F.col(geometry).alias("geometry"), F.lit(0).alias("fail_count"),
        (now if now is not None else F.current_timestamp()).alias("created_at"), (now if now is not None else F.current_timestamp()).alias("updated_at"),
        *[F.col(c).try_cast(types[t.split()[0]]).alias(c) for c, t in extra.items()],
    )
    out = out.where(F.col("spin").isNull() | (F.col("spin") >= 1))
    return ranked(out, "orig_index", "id")[0].transform(lambda d: with_missing_columns(d, JOBS)).select(*JOBS.names, *extra)


def read_cache(texts: DataFrame, schema: str) -> DataFrame:
    """Cached metrics from JSON texts (job_dir, text): corrupt or empty ones are left out."""
    parsed = texts.select("job_dir", F.from_json("text", f"_source_mtime double, {schema}", {"mode": "PERMISSIVE"}).alias("c"))
    return parsed.where("c._source_mtime is not null").select("job_dir", F.col("c._source_mtime").alias("source_mtime"), "c.*").drop("_source_mtime")


def marker_reasons(texts: DataFrame) -> DataFrame:
    """(job_dir, reason) from marker files' JSON; a blank or missing reason is NULL."""
    return texts.select("job_dir", F.nullif(F.trim(F.get_json_object("text", "$.failure_reason")), F.lit("")).alias("reason"))


def mapping(texts: DataFrame) -> DataFrame:
    """A row for each molecule of a mapping JSON (text)."""
    value = "struct<row_ids:array<bigint>,n_rows:bigint,n_geometries:bigint,ligand_types:array<string>,spin_states:array<int>,charge:int,natoms:int>"
    return texts.select(F.explode(F.from_json("text", f"map<string,{value}>")).alias("molecule", "m")).select("molecule", "m.*")


def atom_spins(ground: DataFrame) -> DataFrame:
    """A row for each atom (element, gs) and multiplicity from its ground state down."""
    return ground.select("*", F.explode(spin_ladder(F.col("gs"))).alias("spin"))


def chunk_number(file_name: Column) -> Column:
    return F.regexp_extract(file_name, r"(\d+)\.[^.]*$", 1).try_cast("int")


def stacked(frames: Sequence[DataFrame], name: str = "chunk") -> DataFrame:
    """All rows with the place of their frame in the sequence."""
    from functools import reduce

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn(name, F.lit(i)) for i, f in enumerate(frames)])


def jobs_from_inputs(texts: DataFrame, now: Column | None = None) -> DataFrame:
    """The job table of input decks (job_dir, text), numbered by directory: charge, multiplicity and geometry from the deck, and ``molecule_name``, the directory's."""
    from campanile.sinks import with_defaults

    a = input_atoms(F.col("text"))
    cm = charge_and_multiplicity(F.col("text"))
    name = F.regexp_extract("job_dir", r"([^/]*)/*$", 1)
    rows = texts.select("job_dir", name.alias("molecule_name"), a.alias("a"), cm.alias("cm")).where(F.size("a") > 0)
    rows = ranked(rows, "job_dir", "id")[0]
    made = rows.select(
        "id", (F.col("id") - 1).alias("orig_index"), F.array_join(F.transform("a", lambda x: x["element"]), ";").alias("elements"), F.size("a").alias("natoms"),
        F.col("cm.charge").alias("charge"), F.col("cm.mult").alias("spin"), to_text(F.col("a"), F.col("molecule_name")).alias("geometry"), "molecule_name",
    )
    return with_defaults(made, now, {"molecule_name": "TEXT"})


def create_jobs(spark: SparkSession, csv: str, path: str, extra: Mapping[str, str] | None = None, now: Column | None = None, **columns: str) -> DataFrame:
    """From a CSV to a written job table in one call; the table as it is read back."""
    from campanile.sinks import write_snapshot

    return write_snapshot(structures(read_structures(spark, csv), extra=extra, now=now, **columns), path)
