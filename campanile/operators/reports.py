"""Counts and statistics over the job table and over what was extracted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.constants import STATUSES
from campanile.functions.values import percent


def count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def status_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def status_summary(jobs: DataFrame) -> DataFrame:
    """A row for each known status, zeros included, and the total, with shares; in report order."""
    spark = jobs.sparkSession
    dim = spark.createDataFrame(list(enumerate(STATUSES)), "ord int, status string")
    counts = F.broadcast(dim).join(status_counts(jobs), "status", "left").select("ord", "status", F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    with_total = counts.withColumn("pct", percent(F.col("n"), total))
    whole = counts.agg(F.sum("n").alias("n")).select(F.lit(len(STATUSES)).alias("ord"), F.lit("total").alias("status"), "n", F.when(F.col("n") > 0, 100.0).otherwise(0.0).alias("pct"))
    return with_total.unionByName(whole)


def availability(jobs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Of each column how many jobs, and how many completed ones, have a value; one scan, one row."""
    done = F.col("status") == "completed"
    there = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return jobs.agg(
        F.count(F.lit(1)).alias("n_all"), count_if(done).alias("n_completed"),
        *[x for c in columns for x in (count_if(there(c)).alias(f"{c}_all"), count_if(there(c) & done).alias(f"{c}_completed"))],
    )


def chronic(jobs: DataFrame, thresholds: Sequence[int] = (5, 25)) -> DataFrame:
    """How many jobs to run have failed so often."""
    return jobs.where("status = 'to_run'").agg(*[count_if(F.coalesce("fail_count", F.lit(0)) >= k).alias(f"at_least_{k}") for k in thresholds])


def _stat_columns(columns: Sequence[str], exact: bool = True) -> list[Column]:
    median = F.median if exact else (lambda c: F.percentile_approx(c, 0.5, 10_000))
    kinds = {"n": F.count, "mean": F.avg, "median": median, "min": F.min, "max": F.max, "sum": F.sum}
    return [f(c).alias(f"{c}_{k}") for c in columns for k, f in kinds.items()]


def statistics(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """n, mean, median, min, max and sum of each column, NULLs skipped.

    An exact median keeps a group's distinct values in memory; for groups of billions take ``exact=False`` (a sketch).
    """
    return df.groupBy(*by).agg(*_stat_columns(columns, exact))


def metrics_summary(jobs: DataFrame, columns: Sequence[str] = ("final_energy", "max_forces", "scf_steps", "wall_time"), exact: bool = True) -> DataFrame:
    """Statistics of completed jobs with forces, and the core hours of those with both cores and wall time (NULL without any).

    It is one group: for billions of jobs take ``exact=False``, and medians come from a sketch of bounded size.
    """
    base = jobs.where("status = 'completed' and max_forces is not null")
    hours = F.sum(F.col("wall_time") * F.col("n_cores")) / 3600
    stats = _stat_columns([c for c in columns if c in jobs.columns], exact)
    return base.agg(*stats, *([hours.alias("core_hours")] if "n_cores" in jobs.columns else []))


def snapshot(jobs: DataFrame) -> DataFrame:
    """One row: jobs of each status and how far the campaign is."""
    total = F.count(F.lit(1))
    return jobs.agg(*[count_if(F.col("status") == s).alias(s) for s in STATUSES], percent(count_if(F.col("status") == "completed"), total).alias("progress_pct"))


def pivot_statuses(rows: DataFrame, by: Sequence[str] = ("name", "category", "spin")) -> DataFrame:
    """running (2), remaining (0), done (1) and failed (-1) of each group."""
    is_ = lambda c: F.col("status") == c
    return rows.groupBy(*by).agg(count_if(is_(2)).alias("running"), count_if(is_(0)).alias("remaining"), count_if(is_(1)).alias("done"), count_if(is_(-1)).alias("failed"))


def note_breakdown(df: DataFrame, note: str) -> DataFrame:
    return df.groupBy(note).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), note)


def gate(checked: DataFrame, least: int = 20) -> DataFrame:
    """passed: no mismatch, something verifiable, and at least min(least, sampled) of it. checked: verdict."""
    n = lambda v: count_if(F.col("verdict") == v)
    out = checked.agg(F.count(F.lit(1)).alias("sampled"), n("match").alias("matched"), n("mismatch").alias("mismatched"))
    verifiable = F.col("matched") + F.col("mismatched")
    return out.withColumn("passed", (F.col("mismatched") == 0) & (verifiable >= F.least(F.lit(least), F.col("sampled"))) & (verifiable > 0))


def tallies(codes: DataFrame) -> DataFrame:
    """total, success, running, failed of termination codes; failed is the rest."""
    return codes.agg(F.count(F.lit(1)).alias("total"), count_if(F.col("code") == 1).alias("success"), count_if(F.col("code") == 0).alias("running")).withColumn(
        "failed", F.col("total") - F.col("success") - F.col("running")
    )


def any_value_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(count_if(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()).alias("n"))


def profile(timings: DataFrame, slowest: int = 10) -> tuple[DataFrame, DataFrame]:
    """(totals, the slowest jobs) of extraction timings (job_dir, seconds)."""
    totals = timings.agg(F.count(F.lit(1)).alias("jobs"), F.sum("seconds").alias("seconds"), (F.count(F.lit(1)) / F.sum("seconds")).alias("jobs_per_s"))
    return totals, timings.orderBy(F.desc("seconds"), "job_dir").limit(slowest)


def any_valid(rows: DataFrame, by: str, status: str = "status") -> DataFrame:
    """Of each group whether any of its rows succeeded (status 1)."""
    return rows.groupBy(by).agg(F.coalesce(F.bool_or(F.col(status) == 1), F.lit(False)).alias("valid"))
