"""Selections, counts, statistics, windows, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from campanile.operators import curves, reports, sampling
from campanile.operators import jobs as sel
from campanile.plans.registry import jobs, query, table

S = SparkSession
FLAT = "id, grp, status, fail_count"


@query("jobs_by_status", f"SELECT {FLAT} FROM jobs WHERE status = 'failed' ORDER BY id LIMIT 500")
def _(spark: S, d: str) -> DataFrame:
    return sel.by_status(jobs(spark, d), "failed", 500).select(*FLAT.split(", "))


@query("jobs_status_in", f"SELECT {FLAT} FROM jobs WHERE status IN ('failed', 'timeout')")
def _(spark: S, d: str) -> DataFrame:
    return sel.by_status(jobs(spark, d), ["failed", "timeout"]).select(*FLAT.split(", "))


@query("light_projection", "SELECT * EXCLUDE (generator_data) FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    return sel.light(jobs(spark, d))


@query("status_counts", "SELECT status, count(*) AS n FROM jobs GROUP BY status")
def _(spark: S, d: str) -> DataFrame:
    return reports.status_counts(jobs(spark, d))


@query(
    "status_summary_zero_filled",
    """, dim AS (SELECT * FROM (VALUES (0, 'to_run'), (1, 'running'), (2, 'completed'), (3, 'failed'), (4, 'timeout')) t(ord, status)),
c AS (SELECT ord, d.status, count(id) AS n FROM dim d LEFT JOIN jobs j ON j.status = d.status GROUP BY ord, d.status)
SELECT ord, status, n, round(100.0 * n / (SELECT sum(n) FROM c), 6) AS pct FROM c UNION ALL SELECT 5, 'total', CAST(sum(n) AS BIGINT), CASE WHEN sum(n) > 0 THEN 100.0 ELSE 0.0 END FROM c""",
)
def _(spark: S, d: str) -> DataFrame:
    return reports.status_summary(jobs(spark, d)).withColumn("pct", F.round("pct", 6))


@query(
    "metric_availability",
    "SELECT count(*) AS n_all, count(*) FILTER (status = 'completed') AS n_completed, "
    + ", ".join(f"count(*) FILTER (CAST({c} AS VARCHAR) <> '') AS {c}_all, count(*) FILTER (CAST({c} AS VARCHAR) <> '' AND status = 'completed') AS {c}_completed" for c in ("job_dir", "max_forces", "scf_steps", "final_energy", "wall_time", "n_cores"))
    + " FROM jobs",
)
def _(spark: S, d: str) -> DataFrame:
    return reports.availability(jobs(spark, d), ["job_dir", "max_forces", "scf_steps", "final_energy", "wall_time", "n_cores"])


@query("chronic_resets", "SELECT count(*) FILTER (coalesce(fail_count, 0) >= 5) AS at_least_5, count(*) FILTER (coalesce(fail_count, 0) >= 25) AS at_least_25 FROM jobs WHERE status = 'to_run'")
def _(spark: S, d: str) -> DataFrame:
    return reports.chronic(jobs(spark, d))


_STATS = ("final_energy", "max_forces", "scf_steps", "wall_time")


@query(
    "metrics_summary",
    "SELECT "
    + ", ".join(f"count({c}) AS {c}_n, round(avg({c}), 3) AS {c}_mean, round(median({c}), 3) AS {c}_median, round(min({c}), 3) AS {c}_min, round(max({c}), 3) AS {c}_max, round(CAST(sum({c}) AS DOUBLE), 1) AS {c}_sum" for c in _STATS)
    + ", round(sum(wall_time * n_cores) / 3600, 3) AS core_hours FROM jobs WHERE status = 'completed' AND max_forces IS NOT NULL",
)
def _(spark: S, d: str) -> DataFrame:
    out = reports.metrics_summary(jobs(spark, d), _STATS)
    digits = lambda c: 1 if c.endswith("_sum") else 3
    return out.select(*[F.col(c) if c.endswith("_n") else F.round(F.col(c).cast("double"), digits(c)).alias(c) for c in out.columns])


@query("core_hours", "SELECT status, round(sum(wall_time * n_cores) / 3600, 3) AS core_hours FROM jobs GROUP BY status")
def _(spark: S, d: str) -> DataFrame:
    return jobs(spark, d).groupBy("status").agg(F.round(F.sum(F.col("wall_time") * F.col("n_cores")) / 3600, 3).alias("core_hours"))


@query("campaign_snapshot", "SELECT " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ("to_run", "running", "completed", "failed", "timeout")) + ", round(100.0 * count(*) FILTER (status = 'completed') / count(*), 6) AS progress_pct FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    return reports.snapshot(jobs(spark, d)).withColumn("progress_pct", F.round("progress_pct", 6))


@query("jobs_by_fail_count", f"SELECT {FLAT} FROM jobs WHERE coalesce(fail_count, 0) >= 20")
def _(spark: S, d: str) -> DataFrame:
    return sel.by_fail_count(jobs(spark, d), 20).select(*FLAT.split(", "))


@query("retry_eligible", f"SELECT {FLAT} FROM jobs WHERE status IN ('failed', 'timeout') AND coalesce(fail_count, 0) < 5")
def _(spark: S, d: str) -> DataFrame:
    return sel.under_cap(sel.by_status(jobs(spark, d), ["failed", "timeout"]), 5).select(*FLAT.split(", "))


@query("backfill_candidates", "SELECT id FROM jobs WHERE status = 'completed' AND max_forces IS NULL")
def _(spark: S, d: str) -> DataFrame:
    return sel.backfill_candidates(jobs(spark, d)).select("id")


@query("unlinked_jobs", "SELECT id, status FROM jobs WHERE status IN ('to_run', 'completed', 'failed', 'timeout') AND job_dir IS NULL")
def _(spark: S, d: str) -> DataFrame:
    return sel.unlinked(jobs(spark, d)).select("id", "status")


@query("tracked_running", "SELECT id, orig_index, worker_id, job_dir FROM jobs WHERE status = 'running' AND worker_id IS NOT NULL")
def _(spark: S, d: str) -> DataFrame:
    full = jobs(spark, d).withColumns({"elements": F.lit(""), "charge": F.lit(0), "spin": F.lit(1)})
    return sel.tracked_running(full).select("id", "orig_index", "worker_id", "job_dir")


@query("energy_mismatch", "SELECT id FROM (SELECT *, CASE WHEN id % 11 = 0 THEN final_energy + 1 ELSE final_energy END AS other FROM jobs) WHERE abs(final_energy - other) > 1e-6")
def _(spark: S, d: str) -> DataFrame:
    df = jobs(spark, d).withColumn("other", F.col("final_energy") + F.when(F.col("id") % 11 == 0, 1).otherwise(0))
    return sel.energy_mismatch(df, "final_energy", "other").select("id")


@query("pivot_counts", "SELECT user_id, count(*) FILTER (event_type = 'click') AS running, count(*) FILTER (event_type = 'view') AS remaining, count(*) FILTER (event_type = 'purchase') AS done, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY user_id")
def _(spark: S, d: str) -> DataFrame:
    code = F.when(F.col("event_type") == "click", 2).when(F.col("event_type") == "view", 0).when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", -1)
    return reports.pivot_statuses(table(spark, d, "events").withColumn("status", code), ["user_id"])


@query("force_battery", "SELECT l_returnflag, count(*) AS n, round(min(l_extendedprice), 3) AS lo, round(max(l_extendedprice), 3) AS hi, round(avg(l_extendedprice), 3) AS mean, round(avg(l_discount) FILTER (l_tax > 0.02), 4) AS mean_taxed FROM lineitem GROUP BY l_returnflag")
def _(spark: S, d: str) -> DataFrame:
    p = F.col("l_extendedprice")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.min(p), 3).alias("lo"), F.round(F.max(p), 3).alias("hi"), F.round(F.avg(p), 3).alias("mean"), F.round(F.avg(F.when(F.col("l_tax") > 0.02, F.col("l_discount"))), 4).alias("mean_taxed")
    )


@query("note_breakdown", "SELECT l_linestatus, count(*) AS n FROM lineitem GROUP BY l_linestatus")
def _(spark: S, d: str) -> DataFrame:
    return reports.note_breakdown(table(spark, d, "lineitem"), "l_linestatus")


@query("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_mktsegment").distinct()


@query("count_distinct_per_group", "SELECT lang, count(DISTINCT source) AS sources FROM documents GROUP BY lang")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("lang").agg(F.countDistinct("source").alias("sources"))


@query("count_by_two", "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))


@query("two_level_rollup", "SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(grouping(lang, source) AS BIGINT) AS level FROM documents GROUP BY ROLLUP (lang, source)")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "documents").rollup("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"), F.grouping_id().alias("level"))


@query("relative_energy", "SELECT id, grp, round(final_energy - min(final_energy) OVER (PARTITION BY grp), 3) AS relative FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    return curves.relative_energy(jobs(spark, d), "final_energy", ["grp"], 1.0).select("id", "grp", F.round("relative", 3).alias("relative"))


@query("median_outlier_filter", ", m AS (SELECT grp, median(final_energy) AS med FROM jobs WHERE final_energy < 0 GROUP BY grp) SELECT id FROM jobs JOIN m USING (grp) WHERE final_energy < 0 AND abs(final_energy - med) <= 50000")
def _(spark: S, d: str) -> DataFrame:
    return curves.near_median(jobs(spark, d), "final_energy", ["grp"], 50_000).select("id")


@query("equilibrium_distance", "SELECT round(min(l_extendedprice) + 0.2, 3) AS equilibrium FROM lineitem")
def _(spark: S, d: str) -> DataFrame:
    return curves.equilibrium_distance(table(spark, d, "lineitem"), "l_extendedprice").select(F.round("equilibrium", 3).alias("equilibrium"))


@query("share_of_total", "SELECT lang, CAST(sum(n_chars) AS BIGINT) AS chars, round(100.0 * sum(n_chars) / sum(sum(n_chars)) OVER (), 6) AS pct FROM documents GROUP BY lang")
def _(spark: S, d: str) -> DataFrame:
    sums = table(spark, d, "documents").groupBy("lang").agg(F.sum("n_chars").alias("chars"))
    return sums.withColumn("pct", F.round(F.col("chars") * 100.0 / F.sum("chars").over(Window.partitionBy()), 6))


@query("latest_per_group", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1")
def _(spark: S, d: str) -> DataFrame:
    got = table(spark, d, "events").groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type"), F.struct("ts", (-F.col("event_id")).alias("o"))).alias("e"))
    return got.select("user_id", "e.*")


@query("first_and_last_values", "SELECT user_id, min_by(value, event_id) AS first_value, max_by(value, event_id) AS last_value, round(max_by(value, event_id) - min_by(value, event_id), 3) AS delta FROM events GROUP BY user_id")
def _(spark: S, d: str) -> DataFrame:
    a, b = F.min_by("value", "event_id"), F.max_by("value", "event_id")
    return table(spark, d, "events").groupBy("user_id").agg(a.alias("first_value"), b.alias("last_value"), F.round(b - a, 3).alias("delta"))


@query("delta_first_last", "SELECT conv_id, CAST(max_by(length(text), turn) - min_by(length(text), turn) AS BIGINT) AS delta FROM conversations GROUP BY conv_id")
def _(spark: S, d: str) -> DataFrame:
    n = F.length("text")
    return table(spark, d, "conversations").groupBy("conv_id").agg((F.max_by(n, "turn") - F.min_by(n, "turn")).cast("long").alias("delta"))


@query("index_in_chunk", "SELECT doc_id, doc_id // 100 AS chunk, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1 AS index_in_chunk FROM documents WHERE lang <> 'fr'")
def _(spark: S, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("lang") != "fr", F.col("lang")).alias("v"))
    return sampling.chunked(docs, "doc_id", "v", 100).select("doc_id", "chunk", "index_in_chunk")


@query("topk_per_group", "SELECT source, doc_id, n_chars, rank FROM (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 5")
def _(spark: S, d: str) -> DataFrame:
    return sampling.top_per_group(table(spark, d, "documents"), ["source"], "n_chars", 5, "doc_id").select("source", "doc_id", "n_chars", "rank")


@query("topk_two_stage", "SELECT doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r <= 5 ORDER BY n_chars DESC, doc_id LIMIT 20")
def _(spark: S, d: str) -> DataFrame:
    return sampling.top_two_stage(table(spark, d, "documents"), ["source"], "n_chars", 20, "doc_id").select("doc_id", "n_chars")


@query("topk_global", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(20)


@query("most_common", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10")
def _(spark: S, d: str) -> DataFrame:
    return sampling.most_common(table(spark, d, "part"), "p_brand", 10)


@query("shard_by_size", "SELECT doc_id, CASE WHEN n_chars < 1000 THEN 'small' WHEN n_chars < 5000 THEN 'medium' ELSE 'large' END AS shard FROM documents")
def _(spark: S, d: str) -> DataFrame:
    from campanile.functions.values import by_boundaries

    return table(spark, d, "documents").select("doc_id", by_boundaries(F.col("n_chars"), [1000, 5000], ["small", "medium", "large"]).alias("shard"))


@query("shard_by_column", "SELECT doc_id, CASE WHEN lang IN ('de', 'fr') THEN 'b' WHEN lang = 'en' THEN 'a' ELSE 'c' END AS shard FROM documents")
def _(spark: S, d: str) -> DataFrame:
    from campanile.functions.values import by_values

    return table(spark, d, "documents").select("doc_id", by_values(F.col("lang"), [["en", "de"], ["de", "fr"], []], ["a", "b", "c"]).alias("shard"))


@query("shard_by_fractions_counts", "SELECT * FROM (SELECT 'a' AS shard, CAST(round_even(0.5 * count(*), 0) AS BIGINT) AS n FROM documents UNION ALL SELECT 'b', CAST(round_even(0.3 * count(*), 0) AS BIGINT) FROM documents UNION ALL SELECT 'c', count(*) - CAST(round_even(0.5 * count(*), 0) AS BIGINT) - CAST(round_even(0.3 * count(*), 0) AS BIGINT) FROM documents)")
def _(spark: S, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id")
    return sampling.shard_by_fractions(docs, [0.5, 0.3, 0.2], ["a", "b", "c"], "doc_id").groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


@query("fraction_sample", ", c AS (SELECT id FROM jobs WHERE status = 'completed') SELECT id FROM c ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT (SELECT greatest(1, CAST(round_even(0.05 * count(*), 0) AS BIGINT)) FROM c)")
def _(spark: S, d: str) -> DataFrame:
    return sampling.fraction(jobs(spark, d).where("status = 'completed'").select("id"), 0.05, "id")


@query("stratified_sample", ", f AS (SELECT id, status, status NOT IN ('completed', 'failed') AS first, md5('42:' || CAST(id AS VARCHAR)) AS o FROM jobs), r AS (SELECT *, row_number() OVER (PARTITION BY first ORDER BY o, id) AS n FROM f) SELECT id, status FROM r WHERE n <= CASE WHEN first THEN 50 ELSE 100 END ORDER BY first DESC, o, id LIMIT 100")
def _(spark: S, d: str) -> DataFrame:
    return sampling.stratified(jobs(spark, d).select("id", "status"), "status not in ('completed', 'failed')")


@query("spread_over_sessions", ", t AS (SELECT DISTINCT job_dir FROM jobs WHERE status = 'completed' AND trim(job_dir) <> '') SELECT job_dir, CAST(ntile(7) OVER (ORDER BY job_dir) AS INTEGER) AS session FROM t")
def _(spark: S, d: str) -> DataFrame:
    from campanile.sinks import transfer_list

    return sampling.sessions(transfer_list(jobs(spark, d).where("status = 'completed'")), 7, "job_dir")


@query("event_windows", "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY 1, 2")
def _(spark: S, d: str) -> DataFrame:
    from campanile.streaming.events import tumbling

    out = tumbling(table(spark, d, "events"), "1 hour")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 3).alias("total"))


@query(
    "event_sessions",
    """SELECT user_id, min(ts) AS session_start, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM
(SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL '6 hours' THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s""",
)
def _(spark: S, d: str) -> DataFrame:
    from campanile.streaming.events import sessions

    return sessions(table(spark, d, "events"), "6 hours").select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), "n")
