"""Selections from the job table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campanile.constants import STATUSES
from campanile.schemas import HEAVY_COLUMNS, JOBS, with_missing_columns


def shuffled(key: str, seed: int) -> Column:
    """What a seeded random order sorts by: the md5 of ``seed:key``, the same in any engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))


def fails() -> Column:
    return F.coalesce("fail_count", F.lit(0))


def light(jobs: DataFrame) -> DataFrame:
    """All columns but the heavy ones."""
    return jobs.drop(*HEAVY_COLUMNS)


def by_status(jobs: DataFrame, status: str | Sequence[str] | None = None, limit: int | None = None, heavy: bool = False) -> DataFrame:
    """Jobs of one status, several, or (None) all; the first ``limit`` by id. An empty list selects nothing."""
    out = jobs if heavy else light(jobs)
    if status is not None:
        out = out.where(F.col("status").isin([status] if isinstance(status, str) else list(status)))
    return out if limit is None else out.orderBy("id").limit(limit)


def by_fail_count(jobs: DataFrame, least: int = 1) -> DataFrame:
    return jobs.where(fails() >= least)


def under_cap(jobs: DataFrame, cap: int | None) -> DataFrame:
    return jobs if cap is None else jobs.where(fails() < cap)


def backfill_candidates(jobs: DataFrame, generator: bool = False, recompute: bool = False, most: int | None = None) -> DataFrame:
    """Completed jobs that lack metrics (or all of them, to recompute)."""
    out = jobs.where(F.col("status") == "completed")
    if not recompute:
        missing = F.col("max_forces").isNull()
        out = out.where(missing | F.col("generator_data").isNull() if generator else missing)
    return out if most is None else out.orderBy("id").limit(most)


def unlinked(jobs: DataFrame, most: int | None = None) -> DataFrame:
    out = jobs.where(F.col("status").isin("to_run", "completed", "failed", "timeout") & F.col("job_dir").isNull())
    return out if most is None else out.orderBy("id").limit(most)


def tracked_running(jobs: DataFrame) -> DataFrame:
    return jobs.where((F.col("status") == "running") & F.col("worker_id").isNotNull()).select("id", "orig_index", "worker_id", "job_dir", "elements", "charge", "spin")


def ready(jobs: DataFrame, n: int, cap: int | None = None, seed: int | None = None) -> DataFrame:
    """At most n jobs to run, under the cap: the first by id, or a seeded sample."""
    out = under_cap(jobs.where(F.col("status") == "to_run"), cap)
    order = ["id"] if seed is None else [shuffled("id", seed), "id"]
    return out.orderBy(*order).limit(n)


def records(jobs: DataFrame) -> DataFrame:
    """The job table's columns by name; absent ones NULL, fail_count 0 for NULL, an unknown status an error."""
    full = with_missing_columns(jobs, JOBS)
    known = F.when(F.col("status").isin(*STATUSES), F.col("status")).otherwise(F.raise_error(F.concat(F.lit("unknown status: "), F.coalesce("status", F.lit("NULL")))))
    return full.withColumn("status", known).withColumn("fail_count", fails()).select(JOBS.names)


def energy_mismatch(df: DataFrame, a: str, b: str, tolerance: float = 1e-6) -> DataFrame:
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.abs(F.col(a) - F.col(b)) > tolerance))


def clean_sheet(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows that aren't all NULL and have the required columns; unnamed columns go."""
    named = df.select(*[c for c in df.columns if not c.startswith("Unnamed")])
    return named.na.drop(how="all").na.drop(subset=list(required))


def ordered_elements(df: DataFrame, value: str, order: Sequence[str], element: str = "element") -> DataFrame:
    """Rows with a listed element and a value, with the element's place in the order."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(element))
    return df.where((F.col(element) != "") & F.col(value).isNotNull()).withColumn("ordinal", (place - 1).cast("int")).where("ordinal >= 0")


def split_finished(jobs: DataFrame, codes: DataFrame, reasons: bool = True) -> DataFrame:
    """jobs with what the disk says of them (id, code, reason): 1 completes, -1 fails with its reason, the rest stay to be submitted."""
    seen = jobs.join(codes, "id", "left")
    action = F.when(F.col("code") == 1, "complete").when(F.col("code") == -1, "fail").otherwise("submit")
    return seen.withColumn("action", action).withColumn("reason", F.when(F.col("action") == "fail", F.coalesce("reason", F.lit("failed on disk"))) if reasons else F.lit(None).cast("string"))


def marked(jobs: DataFrame, markers: DataFrame) -> DataFrame:
    """Jobs whose directory carries a do-not-rerun marker (markers: job_dir, reason): the stored directory first, then the rendered one."""
    m = markers.select(F.col("job_dir").alias("marker_dir"), "reason").dropDuplicates(["marker_dir"])
    stored = jobs.join(m, F.col("job_dir") == F.col("marker_dir"), "left").withColumnsRenamed({"marker_dir": "stored_dir", "reason": "stored_reason"})
    both = stored.join(m, F.col("rendered_dir") == F.col("marker_dir"), "left")
    return both.withColumn("blocked", F.col("stored_dir").isNotNull() | F.col("marker_dir").isNotNull()).withColumn("reason", F.coalesce("stored_reason", "reason")).drop("stored_dir", "stored_reason", "marker_dir")


def spin_runs(rows: DataFrame, spin: str = "spin_1", statuses: Sequence[int] = (1,)) -> DataFrame:
    """Runs of one spin (``spin_<n>``) whose status is among some codes."""
    return rows.where((F.col("spin") == spin) & F.col("status").isin(*statuses))


def verified(jobs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Completed jobs whose metrics (job_dir, success) say so too: only these are backed up."""
    good = metrics.where("success").select("job_dir").distinct()
    return jobs.where("status = 'completed'").join(good, "job_dir", "left_semi").select(jobs.columns)


def completed_energies(jobs: DataFrame) -> DataFrame:
    """Completed jobs with an energy, in the seven columns that analyses take."""
    return jobs.where("status = 'completed' and final_energy is not null").select("id", "orig_index", "elements", "charge", "spin", "geometry", "final_energy")


def seeded_jobs(jobs: DataFrame, files: DataFrame, part: float | None = None, seed: int = 42, status: str = "to_run") -> DataFrame:
    """New jobs from completed ones whose directory holds a valid seed (files: a listing): fresh ids, nothing measured yet.

    ``seed_dir`` is the directory that seeds a job. part: only a seeded fraction of them, one at least.
    """
    from campanile.operators.ranges import ranked
    from campanile.operators.sampling import fraction

    good = seed_check(files).where("valid").select("job_dir")
    rows = jobs.where("status = 'completed'").join(good, "job_dir", "left_semi")
    rows = rows if part is None else fraction(rows, part, "id", seed)
    kept = [c for c in ("orig_index", "elements", "natoms", "charge", "spin", "geometry") if c in jobs.columns]
    numbered, _ = ranked(rows.select("id", *kept, F.col("job_dir").alias("seed_dir")).withColumnRenamed("id", "_old"), "_old", "id")
    return numbered.select("id", *kept, F.lit(status).alias("status"), F.lit(0).alias("fail_count"), "seed_dir")


def seed_check(files: DataFrame) -> DataFrame:
    """(job_dir, valid, reason) from a listing (job_dir, rel_path, size): a seed needs its gradient, orbitals and output files."""
    has = lambda end: F.coalesce(F.bool_or(F.col("rel_path").endswith(end) & (F.col("size") > 0)), F.lit(False))
    got = files.groupBy("job_dir").agg(has(".engrad").alias("engrad"), has(".gbw").alias("gbw"), has(".out").alias("out"))
    reason = F.when(~F.col("engrad"), "missing engrad").when(~F.col("gbw"), "missing gbw").when(~F.col("out"), "missing out")
    return got.select("job_dir", reason.isNull().alias("valid"), reason.alias("reason"))
