"""State changes: each query is the snapshot after one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campanile.operators import inventory, joins, state
from campanile.operators import jobs as sel
from campanile.plans.registry import jobs, query, table

S = SparkSession
COLUMNS = ["id", "status", "fail_count", "worker_id", "error_message"]
#: When the changes happen.
AT = "2024-01-02 00:00:00"
NOW = f"timestamp'{AT}'"
#: Directories that are there: those of orders with line items.
DIRS = "dirs AS (SELECT DISTINCT concat('/data/run/job_', l_orderkey) AS job_dir FROM lineitem)"
#: What the disk says of a job.
CODES = "codes AS (SELECT DISTINCT l_orderkey AS id, CASE l_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN -1 WHEN 2 THEN -2 ELSE 0 END AS code, CASE WHEN l_orderkey % 3 > 0 THEN 'bad' END AS reason FROM lineitem)"


def dirs(spark: S, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.concat(F.lit("/data/run/job_"), F.col("l_orderkey").cast("string")).alias("job_dir")).distinct()


def codes(spark: S, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr("l_orderkey AS id", "CASE l_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN -1 WHEN 2 THEN -2 ELSE 0 END AS code", "CASE WHEN l_orderkey % 3 > 0 THEN 'bad' END AS reason").distinct()


def dated(spark: S, d: str) -> DataFrame:
    """The jobs before any change is dated."""
    return jobs(spark, d).withColumn("updated_at", F.lit(None).cast("timestamp"))


def shown(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


def at_sql(hit: str) -> str:
    return f"CASE WHEN {hit} THEN '{AT}' END AS updated_at"


def rendered(df: DataFrame) -> DataFrame:
    return df.withColumn("rendered_dir", F.concat(F.lit("/data/run/job_"), F.col("orig_index").cast("string")))


@query("set_status", "SELECT id, CASE WHEN id % 10 = 1 THEN 'failed' ELSE status END AS status, CASE WHEN id % 10 = 1 THEN coalesce(fail_count, 0) + 1 ELSE fail_count END AS fail_count, worker_id, CASE WHEN id % 10 = 1 THEN 'why' ELSE error_message END AS error_message, " + at_sql("id % 10 = 1") + " FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    df = dated(spark, d)
    return shown(state.set_status(df, df.where("id % 10 = 1").select("id"), "failed", message="why", bump=True, now=F.expr(NOW)), *COLUMNS)


@query("cas_update", "SELECT id, CASE WHEN id % 2 = 0 AND status = 'to_run' THEN 'running' ELSE status END AS status, fail_count, CASE WHEN id % 2 = 0 AND status = 'to_run' THEN 'me' ELSE worker_id END AS worker_id, error_message, " + at_sql("id % 2 = 0 AND status = 'to_run'") + " FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    df = dated(spark, d)
    return shown(state.set_status(df, df.where("id % 2 = 0").select("id"), "running", worker="me", only_if="to_run", now=F.expr(NOW)), *COLUMNS)


@query("bulk_multi", "SELECT id, CASE WHEN status = 'running' AND id % 3 = 0 THEN 'timeout' WHEN status = 'failed' THEN 'to_run' ELSE status END AS status FROM (SELECT id, CASE WHEN id % 6 = 0 THEN 'running' ELSE status END AS status FROM jobs)")
def _(spark: S, d: str) -> DataFrame:
    df = jobs(spark, d)
    of = lambda k: df.where(f"id % {k} = 0").select("id")
    steps = [{"ids": of(6), "status": "running"}, {"ids": of(3), "status": "timeout", "only_if": "running"}, {"ids": of(1), "status": "to_run", "only_if": "failed"}]
    return state.set_many(df, steps).select("id", "status")


@query("claim_by_id", ", p AS (SELECT id FROM jobs WHERE status = 'to_run' AND coalesce(fail_count, 0) < 20 ORDER BY id LIMIT 300) SELECT id, 'running' AS status, fail_count, 'me' AS worker_id, error_message, " + at_sql("true") + " FROM jobs WHERE id IN (SELECT id FROM p)")
def _(spark: S, d: str) -> DataFrame:
    return shown(state.claim(dated(spark, d), 300, "me", 20, now=F.expr(NOW))[1], *COLUMNS)


@query("claim_hash_sample", ", p AS (SELECT id FROM jobs WHERE status = 'to_run' ORDER BY md5('7:' || CAST(id AS VARCHAR)), id LIMIT 300) SELECT id, 'running' AS status, fail_count, 'me' AS worker_id, error_message FROM jobs WHERE id IN (SELECT id FROM p)")
def _(spark: S, d: str) -> DataFrame:
    return state.claim(jobs(spark, d), 300, "me", seed=7)[1].select(COLUMNS)


def _reset_sql(statuses: str, cap: int) -> str:
    hit = f"status IN ({statuses}) AND coalesce(fail_count, 0) < {cap}"
    return f"SELECT id, CASE WHEN {hit} THEN 'to_run' ELSE status END AS status, CASE WHEN {hit} THEN coalesce(fail_count, 0) + 1 ELSE fail_count END AS fail_count, CASE WHEN {hit} THEN NULL ELSE worker_id END AS worker_id, CASE WHEN {hit} THEN NULL ELSE error_message END AS error_message, {at_sql(hit)} FROM jobs"


@query("reset_failed", _reset_sql("'failed'", 10))
def _(spark: S, d: str) -> DataFrame:
    return shown(state.reset(dated(spark, d), ["failed"], 10, F.expr(NOW)), *COLUMNS)


@query("reset_timeout", _reset_sql("'timeout'", 1000))
def _(spark: S, d: str) -> DataFrame:
    return shown(state.reset(dated(spark, d), ["timeout"], now=F.expr(NOW)), *COLUMNS)


@query("fail_over_cap", "SELECT id, CASE WHEN coalesce(fail_count, 0) >= 25 THEN 'failed' ELSE status END AS status, " + at_sql("coalesce(fail_count, 0) >= 25") + " FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    return shown(state.fail_over_cap(dated(spark, d), 25, F.expr(NOW)), "id", "status")


@query("sparse_merge", ", u AS (SELECT l_orderkey AS id, max(CASE WHEN l_linenumber > 2 THEN l_linenumber END) AS scf FROM lineitem GROUP BY l_orderkey) SELECT id, coalesce(scf, scf_steps) AS scf_steps, " + at_sql("scf IS NOT NULL") + " FROM jobs LEFT JOIN u USING (id)")
def _(spark: S, d: str) -> DataFrame:
    u = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.max(F.when(F.col("l_linenumber") > 2, F.col("l_linenumber"))).cast("long").alias("scf_steps"))
    return shown(state.sparse_merge(dated(spark, d), u, now=F.expr(NOW)), "id", "scf_steps")


@query("upsert_overwrite", ", u AS (SELECT l_orderkey AS id, CAST(NULL AS VARCHAR) AS worker_id, 'completed' AS status FROM lineitem WHERE l_linenumber = 3) SELECT id, worker_id, status FROM jobs WHERE id NOT IN (SELECT id FROM u) UNION ALL SELECT id, worker_id, status FROM u")
def _(spark: S, d: str) -> DataFrame:
    u = table(spark, d, "lineitem").where("l_linenumber = 3").select(F.col("l_orderkey").alias("id"), F.lit(None).cast("string").alias("worker_id"), F.lit("completed").alias("status"))
    return state.upsert(jobs(spark, d).select("id", "worker_id", "status"), u, "id")


@query("reset_missing", f", {DIRS} SELECT j.id, CASE WHEN h THEN 'to_run' ELSE status END AS status, CASE WHEN h THEN coalesce(fail_count, 0) + 1 ELSE fail_count END AS fail_count, {at_sql('h')} FROM (SELECT *, status IN ('running', 'failed', 'timeout') AND concat('/data/run/job_', orig_index) NOT IN (SELECT job_dir FROM dirs) AS h FROM jobs) j")
def _(spark: S, d: str) -> DataFrame:
    return shown(state.reset_missing(rendered(dated(spark, d)), dirs(spark, d), now=F.expr(NOW)), "id", "status", "fail_count")


@query(
    "recover_orphans",
    f""", {CODES}, a AS (SELECT DISTINCT concat('w', n_nationkey) AS worker_id FROM nation),
s AS (SELECT j.*, status = 'running' AND worker_id IS NOT NULL AND worker_id NOT IN (SELECT worker_id FROM a) AS dead, code, reason FROM jobs j LEFT JOIN codes USING (id))
SELECT id, CASE WHEN dead AND code = 1 THEN 'completed' WHEN dead AND code = -1 THEN 'failed' WHEN dead THEN 'to_run' ELSE status END AS status,
       CASE WHEN dead AND coalesce(code, 0) <> 1 THEN coalesce(fail_count, 0) + 1 ELSE fail_count END AS fail_count, CASE WHEN dead THEN NULL ELSE worker_id END AS worker_id,
       CASE WHEN dead AND code = -1 THEN coalesce(reason, 'Orphaned job failed on disk') ELSE error_message END AS error_message, {at_sql('dead')} FROM s""",
)
def _(spark: S, d: str) -> DataFrame:
    active = table(spark, d, "nation").select(F.concat(F.lit("w"), F.col("n_nationkey").cast("string")).alias("worker_id"))
    return shown(state.recover_orphans(dated(spark, d), active, codes(spark, d), F.expr(NOW)), *COLUMNS)


@query("dead_workers", ", a AS (SELECT DISTINCT concat('w', n_nationkey) AS worker_id FROM nation) SELECT id, worker_id FROM jobs WHERE status = 'running' AND worker_id IS NOT NULL AND worker_id NOT IN (SELECT worker_id FROM a)")
def _(spark: S, d: str) -> DataFrame:
    active = table(spark, d, "nation").select(F.concat(F.lit("w"), F.col("n_nationkey").cast("string")).alias("worker_id"))
    tracked = jobs(spark, d).where("status = 'running' and worker_id is not null").select("id", "worker_id")
    return joins.dead_workers(tracked, active)


@query(
    "fix_unlinked",
    f""", {CODES}, s AS (SELECT j.*, code, status <> 'running' AND job_dir IS NULL AS t FROM jobs j LEFT JOIN codes USING (id))
SELECT id, CASE WHEN t AND code IS NOT NULL THEN concat('/found/', id) ELSE job_dir END AS job_dir,
       CASE WHEN t AND code IS NOT NULL THEN CASE code WHEN 1 THEN 'completed' WHEN -1 THEN 'failed' WHEN -2 THEN 'timeout' ELSE 'to_run' END WHEN t AND coalesce(fail_count, 0) < 9 THEN 'to_run' ELSE status END AS status,
       CASE WHEN t AND code IS NULL AND coalesce(fail_count, 0) < 9 THEN coalesce(fail_count, 0) + 1 ELSE fail_count END AS fail_count,
       {at_sql('t AND (code IS NOT NULL OR coalesce(fail_count, 0) < 9)')} FROM s""",
)
def _(spark: S, d: str) -> DataFrame:
    probes = codes(spark, d).select("id", "code", F.concat(F.lit("/found/"), F.col("id").cast("string")).alias("found_dir"))
    return shown(state.fix_unlinked(dated(spark, d), probes, 9, F.expr(NOW)), "id", "job_dir", "status", "fail_count")


_RECONCILED = f"""{CODES}, m AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_orderkey % 13 = 0),
s AS (SELECT j.*, code, m.id IS NOT NULL AS marked FROM jobs j LEFT JOIN codes USING (id) LEFT JOIN m ON m.id = j.id),
r AS (SELECT id, status AS old, CASE WHEN marked THEN 'failed' ELSE CASE code WHEN 1 THEN 'completed' WHEN -1 THEN 'failed' WHEN -2 THEN 'timeout' WHEN 0 THEN 'running' ELSE status END END AS status,
             CASE WHEN marked AND status <> 'failed' THEN coalesce(fail_count, 0) + 1 ELSE fail_count END AS fail_count, CASE WHEN marked THEN NULL ELSE worker_id END AS worker_id,
             CASE WHEN marked THEN 'Blocked by .do_not_rerun.json marker: no' ELSE error_message END AS error_message,
             {at_sql("marked OR CASE code WHEN 1 THEN 'completed' WHEN -1 THEN 'failed' WHEN -2 THEN 'timeout' WHEN 0 THEN 'running' ELSE status END <> status")} FROM s)"""


def _reconciled(spark: S, d: str) -> DataFrame:
    markers = table(spark, d, "lineitem").where("l_orderkey % 13 = 0").select(F.col("l_orderkey").alias("id"), F.lit(" no ").alias("reason")).distinct()
    return state.reconcile(dated(spark, d), codes(spark, d), markers, F.expr(NOW))


@query("reconcile", f", {_RECONCILED} SELECT id, status, fail_count, worker_id, error_message, updated_at FROM r")
def _(spark: S, d: str) -> DataFrame:
    return shown(_reconciled(spark, d), *COLUMNS)


@query("reconcile_changes", f", {_RECONCILED} SELECT id, old, status AS new FROM r WHERE old <> status")
def _(spark: S, d: str) -> DataFrame:
    return state.changed(jobs(spark, d), _reconciled(spark, d))


@query(
    "write_metrics",
    """, x AS (SELECT DISTINCT l_orderkey AS id, CASE WHEN l_orderkey % 17 = 0 THEN 'boom' END AS error, CASE WHEN l_orderkey % 17 <> 0 THEN CAST(l_orderkey % 77 AS DOUBLE) END AS wall FROM lineitem)
SELECT id, coalesce(wall, wall_time) AS wall_time, CASE WHEN error IS NOT NULL THEN 'failed' ELSE status END AS status, CASE WHEN error IS NOT NULL THEN concat('Metrics parse error: ', error) ELSE error_message END AS error_message,
       CASE WHEN error IS NOT NULL THEN coalesce(fail_count, 0) + 1 ELSE fail_count END AS fail_count, """
    + at_sql("error IS NOT NULL OR wall IS NOT NULL")
    + " FROM jobs LEFT JOIN x USING (id)",
)
def _(spark: S, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").selectExpr("l_orderkey AS id", "CASE WHEN l_orderkey % 17 = 0 THEN 'boom' END AS error", "CASE WHEN l_orderkey % 17 <> 0 THEN CAST(l_orderkey % 77 AS DOUBLE) END AS wall_time").distinct()
    return shown(state.write_metrics(dated(spark, d), x, F.expr(NOW)), "id", "wall_time", "status", "error_message", "fail_count")


@query(
    "apply_outcomes",
    """, o AS (SELECT l_orderkey AS id, CASE WHEN l_orderkey % 2 = 0 THEN 'completed' ELSE 'failed' END AS s, l_orderkey % 2 = 1 AS bump, CASE WHEN l_orderkey % 2 = 1 THEN 'x' END AS message, CAST(l_linenumber AS DOUBLE) AS w FROM lineitem WHERE l_linenumber = 2)
SELECT id, coalesce(s, status) AS status, CASE WHEN s IS NULL THEN fail_count ELSE coalesce(fail_count, 0) + CASE WHEN bump THEN 1 ELSE 0 END END AS fail_count, CASE WHEN s IS NULL THEN worker_id END AS worker_id, coalesce(message, error_message) AS error_message, coalesce(w, wall_time) AS wall_time, """
    + at_sql("s IS NOT NULL")
    + " FROM jobs LEFT JOIN o USING (id)",
)
def _(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "lineitem").where("l_linenumber = 2").selectExpr("l_orderkey AS id", "CASE WHEN l_orderkey % 2 = 0 THEN 'completed' ELSE 'failed' END AS status", "l_orderkey % 2 = 1 AS bump", "CASE WHEN l_orderkey % 2 = 1 THEN 'x' END AS message", "CAST(l_linenumber AS DOUBLE) AS wall_time")
    return shown(state.apply_outcomes(dated(spark, d), o, F.expr(NOW)), *COLUMNS, "wall_time")


@query("classify_claimed", f", {CODES} SELECT id, CASE WHEN id % 5 = 0 THEN 'marker_blocked' WHEN code = 1 THEN 'completed_on_disk' WHEN code = -1 THEN 'failed_on_disk' ELSE 'submit_ready' END AS action FROM jobs LEFT JOIN codes USING (id) WHERE status = 'running'")
def _(spark: S, d: str) -> DataFrame:
    claimed = jobs(spark, d).where("status = 'running'").join(codes(spark, d), "id", "left").withColumn("blocked", F.col("id") % 5 == 0)
    return state.classify_claimed(claimed).select("id", "action")


@query("split_finished", f", {CODES} SELECT id, CASE WHEN code = 1 THEN 'complete' WHEN code = -1 THEN 'fail' ELSE 'submit' END AS action, CASE WHEN code = -1 THEN coalesce(reason, 'failed on disk') END AS reason FROM jobs LEFT JOIN codes USING (id) WHERE status = 'to_run'")
def _(spark: S, d: str) -> DataFrame:
    return sel.split_finished(jobs(spark, d).where("status = 'to_run'"), codes(spark, d)).select("id", "action", "reason")


@query(
    "marked_jobs",
    """, m AS (SELECT concat('/data/run/job_', c_custkey) AS job_dir, c_mktsegment AS reason FROM customer)
SELECT id, a.job_dir IS NOT NULL OR b.job_dir IS NOT NULL AS blocked, coalesce(a.reason, b.reason) AS reason FROM jobs LEFT JOIN m a ON a.job_dir = jobs.job_dir LEFT JOIN m b ON b.job_dir = concat('/data/run/job_', orig_index)""",
)
def _(spark: S, d: str) -> DataFrame:
    m = table(spark, d, "customer").select(F.concat(F.lit("/data/run/job_"), F.col("c_custkey").cast("string")).alias("job_dir"), F.col("c_mktsegment").alias("reason"))
    return sel.marked(rendered(jobs(spark, d)), m).select("id", "blocked", "reason")


@query(
    "migrate_state",
    """, s AS (SELECT grp AS c, max_by(CASE WHEN status = 'running' THEN 'to_run' ELSE status END, id) AS st, max_by(scf_steps, id) FILTER (scf_steps IS NOT NULL OR true) AS scf, max(id) AS mid FROM jobs WHERE status <> 'to_run' GROUP BY grp),
k AS (SELECT s.c, s.st, j.scf_steps AS scf FROM s JOIN jobs j ON j.id = s.mid)
SELECT c_custkey AS orig_index, coalesce(st, 'to_run') AS status, coalesce(scf, -1) AS scf_steps FROM customer LEFT JOIN k ON k.c = c_custkey""",
)
def _(spark: S, d: str) -> DataFrame:
    old = jobs(spark, d).withColumn("orig_index", F.col("grp"))
    new = table(spark, d, "customer").select(F.col("c_custkey").alias("orig_index"), F.lit("to_run").alias("status"), F.lit(-1).cast("long").alias("scf_steps"))
    return state.migrate(old, new, ["scf_steps"])


@query("skip_reasons", f", {DIRS} SELECT reason, count(*) AS n FROM (SELECT CASE WHEN j.job_dir IS NULL THEN 'null_job_dir' WHEN id % 50 = 1 THEN 'escapes_root' WHEN d.job_dir IS NULL THEN 'dir_missing' END AS reason FROM jobs j LEFT JOIN dirs d USING (job_dir)) WHERE reason IS NOT NULL GROUP BY reason")
def _(spark: S, d: str) -> DataFrame:
    odd = F.when((F.col("id") % 50 == 1) & F.col("job_dir").isNotNull(), F.lit("/data/run/../x")).otherwise(F.col("job_dir"))
    return inventory.skip_reasons(jobs(spark, d).withColumn("job_dir", odd), "/data/run", dirs(spark, d))


@query(
    "purge_plan",
    f""", {CODES}, k AS (SELECT concat('/data/run/job_', id) AS job_dir, code, CASE WHEN id % 7 = 0 THEN 0 ELSE code END AS still FROM codes)
SELECT action, count(*) AS n FROM (SELECT CASE WHEN code = 1 OR still = 1 THEN 'protected' WHEN code <> still THEN 'skipped' WHEN status = 'failed' AND code = -1 THEN 'purged' WHEN status <> 'failed' AND code = -1 THEN 'looks_failed' WHEN code = 0 THEN 'skipped' ELSE 'purged' END AS action
FROM jobs JOIN k USING (job_dir) WHERE status <> 'completed') GROUP BY action""",
)
def _(spark: S, d: str) -> DataFrame:
    disk = codes(spark, d).select(F.concat(F.lit("/data/run/job_"), F.col("id").cast("string")).alias("job_dir"), "code", F.when(F.col("id") % 7 == 0, 0).otherwise(F.col("code")).alias("still_code"))
    sizes = disk.select("job_dir", F.lit(1).alias("bytes"))
    return inventory.plan_totals(inventory.purge_plan(jobs(spark, d), disk, sizes)).select("action", "n")
