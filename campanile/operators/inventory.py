"""File inventories and what may be deleted: plans only, nothing here touches a file.

A listing has a row for each file: job_dir, rel_path, size, mtime, is_symlink. Symbolic links count no bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.constants import ATOM_OUTPUT
from campanile.functions.paths import base_name, extension, file_class, in_scratch_dir, real_output, scratch
from campanile.operators.sampling import top_per_group

CLASSES = ("essential", "scratch_tmp", "scratch_bas", "other")


def classified(listing: DataFrame) -> DataFrame:
    """The listing with name, bytes, ext, class and whether the file is in a scratch directory."""
    name = base_name(F.col("rel_path"))
    bytes_ = F.when(F.coalesce("is_symlink", F.lit(False)), F.lit(0)).otherwise(F.col("size")).cast("long")
    out = listing.withColumns({"name": name, "bytes": bytes_, "nested": in_scratch_dir(F.col("rel_path"))})
    return out.withColumns({"ext": extension(F.col("name")), "class": file_class(F.col("name"), F.col("nested"))})


def per_job(listing: DataFrame) -> DataFrame:
    """A row for each job: files, bytes, bytes and files of each class, bytes in scratch directories; largest first."""
    rows = classified(listing)
    of = lambda c, v: F.sum(F.when(F.col("class") == c, v).otherwise(0))
    out = rows.groupBy("job_dir").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("bytes").alias("bytes"),
        *[of(c, F.col("bytes")).alias(f"{c}_bytes") for c in CLASSES],
        *[of(c, F.lit(1)).alias(f"{c}_files") for c in CLASSES],
        F.sum(F.when(F.col("nested"), F.col("bytes")).otherwise(0)).alias("nested_bytes"),
        F.max("bytes").alias("largest"),
    )
    return out.orderBy(F.desc("bytes"), "job_dir")


def per_key(listing: DataFrame, key: str = "ext") -> DataFrame:
    """Files and bytes by extension or class over the corpus."""
    return classified(listing).groupBy(key).agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"))


def rolled_up(listing: DataFrame) -> DataFrame:
    """By job and extension, by extension, and over all: one pass with grouping sets (level tells which)."""
    rows = classified(listing)
    out = rows.rollup("ext", "job_dir").agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"), F.grouping_id().alias("level"))
    return out


def largest_files(listing: DataFrame, k: int, per_job_only: int | None = None) -> DataFrame:
    """The k largest files; with per_job_only from each job's so many largest."""
    rows = classified(listing)
    if per_job_only is not None:
        rows = top_per_group(rows, ["job_dir"], "bytes", per_job_only, "rel_path").drop("rank")
    return rows.orderBy(F.desc("bytes"), "job_dir", "rel_path").limit(k)


def started(listing: DataFrame) -> DataFrame:
    """(job_dir, started): whether a job has written real output."""
    return listing.groupBy("job_dir").agg(F.bool_or(real_output(base_name(F.col("rel_path")))).alias("started"))


def disk_status(code: Column, has_output: Column) -> Column:
    """A status from the disk alone."""
    return F.when(code == 1, "completed").when(code == -1, "failed").when(~F.coalesce(has_output, F.lit(False)), "to_run").when(code == -2, "timeout").otherwise("running")


def scratch_plan(listing: DataFrame, categories: frozenset[str] = frozenset({"tmp", "bas"})) -> DataFrame:
    """(job_dir, path, is_dir, bytes): scratch files, and whole scratch directories that are direct children."""
    rows = classified(listing)
    top = F.substring_index("rel_path", "/", 1)
    in_dir = F.col("rel_path").contains("/") & scratch(top, F.lit(True), categories)
    keyed = rows.withColumn("is_dir", in_dir).withColumn("path", F.when(in_dir, top).when(~F.col("rel_path").contains("/") & scratch(F.col("name"), F.lit(False), categories), F.col("rel_path")))
    return keyed.where("path is not null").groupBy("job_dir", "path", "is_dir").agg(F.sum("bytes").alias("bytes"))


def purge_plan(jobs: DataFrame, disk: DataFrame, sizes: DataFrame) -> DataFrame:
    """(id, job_dir, action, bytes) of jobs that aren't completed; the disk is asked twice (disk: job_dir, code, still_code).

    purged: failed in both, or incomplete and not running; protected: the disk says done; looks_failed: the table says incomplete, the
    disk failed; skipped: the second look differs, or the job is running.
    """
    seen = jobs.where("status <> 'completed'").join(disk, "job_dir").join(sizes, "job_dir", "left")
    action = (
        F.when((F.col("code") == 1) | (F.col("still_code") == 1), "protected")
        .when(~F.col("code").eqNullSafe(F.col("still_code")), "skipped")
        .when((F.col("status") == "failed") & (F.col("code") == -1), "purged")
        .when((F.col("status") != "failed") & (F.col("code") == -1), "looks_failed")
        .when(F.col("code") == 0, "skipped")
        .otherwise("purged")
    )
    return seen.select("id", "job_dir", action.alias("action"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


def plan_totals(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))


def skip_reasons(jobs: DataFrame, root: str, existing: DataFrame) -> DataFrame:
    """(reason, n): why a job's directory can't be worked on."""
    from campanile.functions.paths import contained

    dirs = existing.select(F.col("job_dir").alias("_dir")).distinct()
    reason = F.when(F.col("job_dir").isNull() | (F.trim("job_dir") == ""), "null_job_dir").when(~contained(F.col("job_dir"), root), "escapes_root").when(F.col("_dir").isNull(), "dir_missing")
    return jobs.join(dirs, F.col("job_dir") == F.col("_dir"), "left").select(reason.alias("reason")).where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def move_plan(moves: DataFrame, existing: DataFrame) -> DataFrame:
    """moves (source, target) with ``conflict`` and ``go``: all or nothing, so one conflict stops every move."""
    there = existing.select(F.col("job_dir").alias("_dir"), F.lit(True).alias("_there")).distinct()
    out = moves.join(there, F.col("target") == F.col("_dir"), "left").withColumn("conflict", F.coalesce("_there", F.lit(False))).drop("_dir", "_there")
    return out.withColumn("go", ~F.bool_or("conflict").over(Window.partitionBy()))  # a row for each folder to move


def delete_plan(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """wanted (job_dir) with whether it is there."""
    there = existing.select("job_dir", F.lit(True).alias("found")).distinct()
    return wanted.distinct().join(there, "job_dir", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def probes(listing: DataFrame) -> DataFrame:
    """What a directory's own files say of it (listing: job_dir, rel_path): is_sella, has_marker, and the number of atomic outputs."""
    name = F.col("rel_path")
    any_ = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    return listing.groupBy("job_dir").agg(
        any_(name.isin("sella.log", "opt.traj")).alias("is_sella"), any_(name == ".do_not_rerun.json").alias("has_marker"), F.count(F.when(name.rlike(ATOM_OUTPUT), 1)).alias("atom_outputs")
    )
