"""The job table's state changes, each a plan from one snapshot to the next.

Nothing is changed in place: the caller writes the new snapshot. Every change takes ``now``; with it, the rows that are changed, and
no others, get it as ``updated_at``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campanile.constants import MARKER_MESSAGE, ORPHAN_MESSAGE
from campanile.functions.values import marker_message
from campanile.operators.jobs import fails

#: Marks an argument that was not given, where NULL is a value.
UNSET = object()


def change(jobs: DataFrame, where: Column, now: Column | None = None, **values) -> DataFrame:
    """jobs with the given columns, and with ``now`` also updated_at, set on the rows that ``where`` selects (a NULL condition selects nothing)."""
    hit = F.coalesce(where, F.lit(False))
    if now is not None:
        values["updated_at"] = now
    to = {c: F.when(hit, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)).cast(jobs.schema[c].dataType) for c, v in values.items() if c in jobs.columns}
    return jobs.withColumns(to)


def _ids(jobs: DataFrame, ids: DataFrame | Sequence[int]) -> tuple[DataFrame, Column]:
    """jobs with a flag of the rows whose id is listed; a DataFrame of ids is joined, a short list compared."""
    if isinstance(ids, DataFrame):
        flagged = jobs.join(ids.select(F.col("id"), F.lit(True).alias("_listed")).distinct(), "id", "left")
        return flagged, F.coalesce("_listed", F.lit(False))
    return jobs, F.col("id").isin(list(ids))


def set_status(
    jobs: DataFrame, ids: DataFrame | Sequence[int], status: str, *, message: str | None = None, bump: bool = False, worker: object = UNSET, only_if: str | None = None, now: Column | None = None
) -> DataFrame:
    """Jobs of listed ids to a status; with ``only_if`` compare-and-set. The message only if given, the worker unless unset."""
    columns = jobs.columns
    flagged, listed = _ids(jobs, ids)
    hit = listed if only_if is None else listed & (F.col("status") == only_if)
    values: dict[str, object] = {"status": status}
    if message is not None:
        values["error_message"] = message
    if bump:
        values["fail_count"] = fails() + 1
    if worker is not UNSET:
        values["worker_id"] = worker
    # the condition is fixed before status changes under it
    fixed = flagged.withColumn("_hit", hit)
    return change(fixed, F.col("_hit"), now, **values).select(columns)


def set_many(jobs: DataFrame, changes: Sequence[dict]) -> DataFrame:
    """Several set_status calls in order; a later one sees what earlier ones did. One snapshot is written."""
    return reduce(lambda df, c: set_status(df, **c), changes, jobs)


def sparse_merge(jobs: DataFrame, updates: DataFrame, key: str = "id", now: Column | None = None) -> DataFrame:
    """Columns of updates where they aren't NULL; the last of repeated keys is the caller's to choose."""
    changed = [c for c in updates.columns if c != key and c in jobs.columns]
    if not changed:
        return jobs
    u = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in changed])
    out = jobs.join(u, key, "left")
    given = reduce(lambda a, b: a | b, [F.col(f"_new_{c}").isNotNull() for c in changed])
    return change(out, given, now, **{c: F.coalesce(f"_new_{c}", c) for c in changed}).select(jobs.columns)


def upsert(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows replace the table's rows of their key whole, NULLs included; others stay."""
    return table.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows, allowMissingColumns=True).select(table.columns)


def claim(jobs: DataFrame, n: int, worker: str | None = None, cap: int | None = None, seed: int | None = None, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(next snapshot, claimed rows as they are afterwards): at most n jobs to run under the cap go to running.

    By id, or in seeded random order. One driver writes snapshots, so two claims can't take the same job.
    """
    from campanile.operators.jobs import ready

    picked = ready(jobs, n, cap, seed).select("id")
    after = set_status(jobs, picked, "running", worker=worker, only_if="to_run", now=now)
    return after, after.join(picked, "id", "left_semi")


def reset(jobs: DataFrame, statuses: Sequence[str] = ("failed",), cap: int | None = None, now: Column | None = None) -> DataFrame:
    """Jobs of the statuses under the cap back to to_run: message and worker cleared, one failure more."""
    hit = F.col("status").isin(*statuses)
    if cap is not None:
        hit = hit & (fails() < cap)
    fixed = jobs.withColumn("_hit", hit)
    return change(fixed, F.col("_hit"), now, status="to_run", error_message=None, worker_id=None, fail_count=fails() + 1).select(jobs.columns)


def fail_over_cap(jobs: DataFrame, cap: int, now: Column | None = None) -> DataFrame:
    """Every job with so many failures fails, completed ones too."""
    return change(jobs, fails() >= cap, now, status="failed")


def reset_missing(jobs: DataFrame, existing: DataFrame, statuses: Sequence[str] = ("running", "failed", "timeout"), key: str = "rendered_dir", now: Column | None = None) -> DataFrame:
    """Jobs of the statuses whose directory isn't listed (existing: job_dir) back to to_run, one failure more."""
    dirs = existing.select(F.col("job_dir").alias("_dir"), F.lit(True).alias("_there")).distinct()
    seen = jobs.join(dirs, F.col(key) == F.col("_dir"), "left").withColumn("_hit", F.col("status").isin(*statuses) & F.col("_there").isNull())
    return change(seen, F.col("_hit"), now, status="to_run", fail_count=fails() + 1, worker_id=None).select(jobs.columns)


def fix_unlinked(jobs: DataFrame, probes: DataFrame, max_retries: int | None = None, now: Column | None = None) -> DataFrame:
    """Jobs without a directory (probes: id, found_dir, code): linked with the disk's status, else reset; at the retry cap left alone."""
    seen = jobs.join(probes, "id", "left")
    target = F.col("status").isin("to_run", "completed", "failed", "timeout") & F.col("job_dir").isNull()
    found = target & F.col("found_dir").isNotNull()
    lost = target & F.col("found_dir").isNull()
    if max_retries is not None:
        lost = lost & (fails() < max_retries)
    seen = seen.withColumns({"_found": found, "_lost": lost})
    from_code = F.when(F.col("code") == 1, "completed").when(F.col("code") == -1, "failed").when(F.col("code") == -2, "timeout").otherwise("to_run")
    linked = change(seen, F.col("_found"), now, job_dir=F.col("found_dir"), status=from_code)
    return change(linked, F.col("_lost"), now, status="to_run", fail_count=fails() + 1).select(jobs.columns)


def recover_orphans(jobs: DataFrame, active: DataFrame | None, codes: DataFrame, now: Column | None = None) -> DataFrame:
    """Running jobs whose worker isn't active: done, failed or reset by the disk's code (codes: id, code, reason).

    active (worker_id) is None when the scheduler could not be asked: then nothing changes, unlike an empty set.
    """
    if active is None:
        return jobs
    alive = active.select("worker_id", F.lit(True).alias("_alive")).distinct()
    # only ids, codes and reasons of the dead are joined on to the jobs
    tracked = jobs.where("status = 'running' and worker_id is not null").select("id", "worker_id")
    dead = tracked.join(alive, "worker_id", "left_anti").join(codes.select("id", "code", "reason"), "id", "left")
    dead = dead.select("id", F.coalesce(F.when(F.col("code").isin(1, -1), F.col("code")), F.lit(0)).alias("_code"), F.col("reason").alias("_reason"))
    seen = jobs.join(dead, "id", "left")
    code = F.col("_code")
    to = F.when(code == 1, "completed").when(code == -1, "failed").otherwise("to_run")
    message = F.when(code == -1, F.coalesce("_reason", F.lit(ORPHAN_MESSAGE))).otherwise(F.col("error_message"))
    count = F.when(code == 1, F.col("fail_count")).otherwise(fails() + 1)
    return change(seen, code.isNotNull(), now, status=to, error_message=message, fail_count=count, worker_id=None).select(jobs.columns)


def reconcile(jobs: DataFrame, codes: DataFrame, markers: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    """The snapshot after a look at the disk (codes: id, code): 1 completed, -1 failed, -2 timeout, 0 running.

    A marker (id, reason) overrides: failed, and one failure more if that is a change. Doing it twice changes nothing more.
    """
    disk = codes.select("id", F.col("code").alias("_code"))
    m = markers.select("id", F.col("reason").alias("_reason"), F.lit(True).alias("_marked")) if markers is not None else None
    # both are about as many rows as directories; the jobs are joined once
    disk = disk.join(m, "id", "full") if m is not None else disk.withColumns({"_reason": F.lit(None).cast("string"), "_marked": F.lit(None).cast("boolean")})
    seen = jobs.join(disk, "id", "left")
    marked = F.coalesce("_marked", F.lit(False))
    by_code = F.when(F.col("_code") == 1, "completed").when(F.col("_code") == -1, "failed").when(F.col("_code") == -2, "timeout").when(F.col("_code") == 0, "running").otherwise(F.col("status"))
    to = F.when(marked, "failed").otherwise(by_code)
    message = F.when(marked, marker_message(MARKER_MESSAGE, F.col("_reason"))).otherwise(F.col("error_message"))
    worker = F.when(~marked, F.col("worker_id"))
    count = F.when(marked & (F.col("status") != "failed"), fails() + 1).otherwise(F.col("fail_count"))
    seen = seen.withColumns({"_to": to, "_message": message, "_worker": worker, "_count": count})
    differs = reduce(lambda a, b: a | b, [~F.col(a).eqNullSafe(F.col(b)) for a, b in (("status", "_to"), ("error_message", "_message"), ("worker_id", "_worker"))])
    return change(seen.withColumn("_hit", differs), F.col("_hit"), now, status=F.col("_to"), error_message=F.col("_message"), worker_id=F.col("_worker"), fail_count=F.col("_count")).select(jobs.columns)


def changed(before: DataFrame, after: DataFrame, column: str = "status") -> DataFrame:
    """(id, old, new) of the rows whose column differs between two snapshots."""
    a, b = before.select("id", F.col(column).alias("old")), after.select("id", F.col(column).alias("new"))
    return a.join(b, "id").where(~F.col("old").eqNullSafe(F.col("new")))


def write_metrics(jobs: DataFrame, extracted: DataFrame, now: Column | None = None) -> DataFrame:
    """Extracted rows (id, error, metric columns): good ones merge sparsely, an error fails its job with one failure more."""
    good = sparse_merge(jobs, extracted.where("error is null").drop("error"), now=now)
    bad = extracted.where("error is not null").select("id", F.col("error").alias("_error"))
    seen = good.join(bad, "id", "left")
    return change(seen, F.col("_error").isNotNull(), now, status="failed", error_message=F.concat(F.lit("Metrics parse error: "), F.col("_error")), fail_count=fails() + 1).select(jobs.columns)


def apply_outcomes(jobs: DataFrame, outcomes: DataFrame, now: Column | None = None) -> DataFrame:
    """Job outcomes in one step (id, status, bump, message, metric columns): the worker is released, metrics merge sparsely.

    Applying the same outcomes to a snapshot that has them already is the caller's to avoid: fail counts would rise again.
    """
    metrics = [c for c in outcomes.columns if c not in ("id", "status", "bump", "message")]
    o = outcomes.select("id", F.col("status").alias("_status"), F.col("bump").alias("_bump"), F.col("message").alias("_message"), *[F.col(c).alias(f"_m_{c}") for c in metrics])
    seen = jobs.join(o, "id", "left")
    there = F.col("_status").isNotNull()
    values = {"status": F.col("_status"), "worker_id": None, "fail_count": fails() + F.when(F.col("_bump"), 1).otherwise(0), "error_message": F.coalesce("_message", "error_message")}
    return change(seen, there, now, **values, **{c: F.coalesce(f"_m_{c}", c) for c in metrics}).select(jobs.columns)


def classify_claimed(claimed: DataFrame) -> DataFrame:
    """claimed (id, blocked, code) with what to do about each job."""
    action = F.when(F.col("blocked"), "marker_blocked").when(F.col("code") == 1, "completed_on_disk").when(F.col("code") == -1, "failed_on_disk").otherwise("submit_ready")
    return claimed.withColumn("action", action)


def migrate(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """State carried from an old job table to a new one by orig_index: rows that are past to_run, non-NULL columns only.

    Running jobs arrive as to_run without their worker; of repeated keys the last id counts.
    """
    state = old.where("status <> 'to_run'").groupBy("orig_index").agg(F.max_by(F.struct(*[c for c in columns], "status"), "id").alias("s")).select("orig_index", "s.*")
    running = F.col("status") == "running"
    state = state.withColumn("status", F.when(running, "to_run").otherwise(F.col("status")))
    if "worker_id" in columns:
        state = state.withColumn("worker_id", F.when(running, None).otherwise(F.col("worker_id")))
    return sparse_merge(new, state, "orig_index")
