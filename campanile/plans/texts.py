"""Texts, JSON, paths and formatting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campanile.functions import chemistry, logs, paths, values
from campanile.plans.registry import jobs, query, table

S = SparkSession
#: Documents as outputs: a few get the lines that end a calculation.
_TEXT = """t AS (SELECT doc_id, concat(coalesce(text, ''), chr(10), CASE doc_id % 5 WHEN 0 THEN concat('ORCA TERMINATED NORMALLY', chr(10), 'Error after all') WHEN 1 THEN concat('  an Error here  ', chr(10), 'more') WHEN 2 THEN 'aborting the run'
 WHEN 3 THEN concat('FINAL SINGLE POINT ENERGY  -', doc_id, '.5', chr(10), 'SCF CONVERGED AFTER  ', doc_id % 9, ' CYCLES', chr(10), 'SCF CONVERGED AFTER 4 CYCLES', chr(10), 'FINAL SINGLE POINT ENERGY  -7.25') ELSE 'plain' END) AS text FROM documents)"""
#: The lines that count: a last empty one does not.
_LINES = "l AS (SELECT doc_id, text, CASE WHEN list_last(string_split(text, chr(10))) = '' THEN string_split(text, chr(10))[:-2] ELSE string_split(text, chr(10)) END AS lines FROM t), k AS (SELECT *, lines[greatest(len(lines) - 9, 1):] AS last FROM l)"


def outputs(spark: S, d: str) -> DataFrame:
    nl, k = F.lit("\n"), F.col("doc_id")
    end = (
        F.when(k % 5 == 0, "ORCA TERMINATED NORMALLY\nError after all").when(k % 5 == 1, "  an Error here  \nmore").when(k % 5 == 2, "aborting the run")
        .when(k % 5 == 3, F.concat(F.lit("FINAL SINGLE POINT ENERGY  -"), k.cast("string"), F.lit(".5\nSCF CONVERGED AFTER  "), (k % 9).cast("string"), F.lit(" CYCLES\nSCF CONVERGED AFTER 4 CYCLES\nFINAL SINGLE POINT ENERGY  -7.25")))
        .otherwise("plain")
    )
    mtime = F.when(k % 2 == 0, F.expr("timestamp'2024-01-01 00:00:00'")).otherwise(F.expr("timestamp'2024-01-01 23:00:00'"))
    return table(spark, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), nl, end).alias("text"), mtime.alias("mtime"))


@query(
    "tail_status",
    f"WITH {_TEXT}, {_LINES} SELECT doc_id, CAST(CASE WHEN len(list_filter(last, lambda x: contains(x, 'ORCA TERMINATED NORMALLY'))) > 0 THEN 1 WHEN len(list_filter(last, lambda x: contains(x, 'aborting the run') OR contains(x, 'Error'))) > 0 THEN -1 WHEN doc_id % 2 = 0 THEN -2 ELSE 0 END AS INTEGER) AS code FROM k",
)
def _(spark: S, d: str) -> DataFrame:
    now = F.expr("timestamp'2024-01-02 00:00:00'")
    return outputs(spark, d).select("doc_id", logs.termination(F.col("text"), F.col("mtime"), now, 6).alias("code"))


@query("failure_reason", f"WITH {_TEXT}, {_LINES} SELECT doc_id, CASE WHEN len(list_filter(last, lambda x: contains(x, 'ORCA TERMINATED NORMALLY'))) = 0 THEN trim(list_filter(last, lambda x: contains(x, 'aborting the run') OR contains(x, 'Error'))[1]) END AS reason FROM k")
def _(spark: S, d: str) -> DataFrame:
    return outputs(spark, d).select("doc_id", logs.failure_reason(F.col("text")).alias("reason"))


@query("regex_last_value", f"WITH {_TEXT} SELECT doc_id, list_last(list_transform(list_filter(string_split(text, chr(10)), lambda x: contains(x, 'FINAL SINGLE POINT ENERGY')), lambda x: CAST(regexp_extract(x, '(\\S+)\\s*$', 1) AS DOUBLE))) AS energy, CAST(list_sum(list_transform(regexp_extract_all(text, 'SCF CONVERGED AFTER\\s+(\\d+)\\s+CYCLES', 1), lambda x: CAST(x AS INTEGER))) AS INTEGER) AS scf_steps FROM t")
def _(spark: S, d: str) -> DataFrame:
    return outputs(spark, d).select("doc_id", logs.final_energy(F.col("text")).alias("energy"), logs.scf_steps(F.col("text")).alias("scf_steps"))


@query("regex_sum", "SELECT page_id, coalesce(CAST(list_sum(list_transform(regexp_extract_all(url, '[0-9]+'), lambda x: CAST(x AS BIGINT))) AS BIGINT), 0) AS total FROM pages")
def _(spark: S, d: str) -> DataFrame:
    found = F.transform(F.regexp_extract_all("url", F.lit("([0-9]+)")), lambda x: x.cast("long"))
    return table(spark, d, "pages").select("page_id", F.aggregate(found, F.lit(0).cast("long"), lambda s, x: s + x).alias("total"))


@query("line_block_count", "SELECT doc_id, CAST(len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0b\\f\\r]'))) AS INTEGER) AS n FROM documents")
def _(spark: S, d: str) -> DataFrame:
    from campanile.functions.xyz import lines

    return table(spark, d, "documents").select("doc_id", F.size(lines(F.coalesce("text", F.lit("")))).alias("n"))


@query(
    "section_forward_fill",
    r"""WITH c AS (SELECT conv_id, turn, replace(coalesce(text, ''), chr(10), ' ') AS line, role = 'user' AND trim(replace(coalesce(text, ''), chr(10), ' ')) <> '' AS head FROM conversations)
SELECT conv_id, line_no, line, section FROM (SELECT conv_id, turn AS line_no, line, head, last_value(CASE WHEN head THEN line END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS section FROM c) WHERE NOT head""",
)
def _(spark: S, d: str) -> DataFrame:
    from campanile.sources.texts import forward_filled

    line = F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" "))
    head = (F.col("role") == "user") & (F.trim(line) != "")
    lines = table(spark, d, "conversations").select("conv_id", F.col("turn").alias("line_no"), F.when(head, F.concat(F.lit("# "), line)).otherwise(line).alias("line"))
    return forward_filled(lines, r"^# (.*)$", "section", "conv_id").select("conv_id", "line_no", "line", "section")


@query("json_field_stats", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total FROM events GROUP BY event_type")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("props", "$.k").cast("int")).alias("total"))


@query("json_array_roundtrip", "SELECT id, CASE id % 4 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE 2 END AS n, CASE id % 4 WHEN 1 THEN 'not a list of numbers' WHEN 3 THEN 'unexpected length' END AS note FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("id") % 4
    text = F.when(k == 0, "").when(k == 1, '["a", 1]').otherwise(F.to_json(F.array(F.col("max_forces") * 0 + 1.5, F.lit(2.0))))
    text = F.when((k > 1) & F.col("max_forces").isNull(), "[1.5,2.0]").otherwise(text)
    out = jobs(spark, d).select("id", text.alias("t"))
    return out.select("id", F.when(values.number_list(F.col("t")).isNotNull(), F.size(values.number_list(F.col("t")))).alias("n"), values.number_list_note(F.col("t"), F.when(k == 3, 3).otherwise(2)).alias("note"))


@query("path_parts", "WITH p AS (SELECT page_id, list_filter(string_split(regexp_replace(url, '^https?://', ''), '/'), lambda x: x <> '') AS p FROM pages) SELECT page_id, coalesce(p[-1], '') AS name, coalesce(p[-2], '') AS spin, coalesce(p[-3], '') AS cat, coalesce(p[-4], '') AS lot FROM p WHERE len(list_filter(p, lambda x: starts_with(x, 'spin'))) = 0")
def _(spark: S, d: str) -> DataFrame:
    p = table(spark, d, "pages").select("page_id", F.regexp_replace("url", "^https?://", "").alias("p"))
    return p.where(~F.exists(F.split("p", "/"), lambda x: x.startswith("spin"))).select("page_id", paths.path_info(F.col("p")).alias("i")).select("page_id", "i.name", "i.spin", "i.cat", "i.lot")


@query("path_around_spin", "SELECT doc_id, source AS lot, lang AS cat, concat('M', doc_id) AS name, concat('spin_', doc_id % 7) AS spin FROM documents")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id")
    path = F.concat_ws("/", F.lit("/root/spin_0"), "source", "lang", F.concat(F.lit("M"), k.cast("string"), F.when(k % 2 == 0, "_PBE").otherwise("")), F.concat(F.lit("spin_"), (k % 7).cast("string")), F.lit("orca.out"))
    return table(spark, d, "documents").select("doc_id", paths.path_info(path).alias("i")).select("doc_id", "i.lot", "i.cat", "i.name", "i.spin")


@query("format_size", "SELECT doc_id, CASE WHEN b < 1024 THEN concat(b, ' B') WHEN b < 1048576 THEN format('{:.1f} KB', b / 1024.0) WHEN b < 1073741824 THEN format('{:.1f} MB', b / 1048576.0) ELSE format('{:.1f} GB', b / 1073741824.0) END AS size FROM (SELECT doc_id, n_chars * n_chars * 128 AS b FROM documents)")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", values.size_text(F.col("n_chars") * F.col("n_chars") * 128).alias("size"))


@query("truncate_text", "SELECT doc_id, CASE WHEN length(text) > 30 THEN concat(left(text, 27), '...') ELSE coalesce(text, 'N/A') END AS t FROM documents")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", values.truncated(F.col("text")).alias("t"))


@query("render_pattern", "SELECT id, concat('a_', orig_index, '_', id, '_', CASE WHEN n_cores % 2 = 0 THEN 'H2O' ELSE 'UO2' END, '_c', coalesce(fail_count, 0), '_s', coalesce(scf_steps, 1), '@host') AS dir FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    elements = F.when(F.col("n_cores") % 2 == 0, "H;O; H").otherwise("U;O;O;")
    got = paths.render(paths.with_prefix("{orig_index}_{id}_{formula}_c{charge}_s{spin}@{hostname}", "a"), orig_index=F.col("orig_index"), job_id=F.col("id"), hostname="host", elements=elements, charge=F.col("fail_count"), spin=F.col("scf_steps"))
    return jobs(spark, d).select("id", got.alias("dir"))


@query("swap_root", "SELECT id, CASE WHEN job_dir IS NOT NULL THEN concat('/new/chunk/', regexp_replace(job_dir, '^/data/run/', '')) END AS dir FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    return jobs(spark, d).select("id", paths.swap_root(F.col("job_dir"), "/data/run", "/new/chunk").alias("dir"))


@query("bag_compare", "SELECT doc_id, list_sort(w) = list_sort(list_reverse(w)) AS same, len(w) > 0 AS any_ FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)")
def _(spark: S, d: str) -> DataFrame:
    w = F.split("text", " ")
    return table(spark, d, "documents").select("doc_id", chemistry.bags_match(w, F.reverse(w)).alias("same"), (F.size(w) > 0).alias("any_"))


@query("formula", "WITH w AS (SELECT p_partkey, [left(p_name, 1), left(p_type, 1), left(p_name, 1)] AS e FROM part) SELECT p_partkey, CASE WHEN e[1] = e[2] THEN concat(e[1], '3') ELSE concat(e[1], '2', e[2]) END AS formula FROM w")
def _(spark: S, d: str) -> DataFrame:
    a, b = F.left("p_name", F.lit(1)), F.left("p_type", F.lit(1))
    return table(spark, d, "part").select("p_partkey", paths.formula(F.concat_ws(";", a, b, a)).alias("formula"))


@query("memory_estimate", "SELECT p_partkey, CAST(floor(greatest(CASE WHEN p_size % 3 = 0 THEN 0.0076739752343756434 * (p_size * 100) ** 1.5 + 361.4745947062764 ELSE 0.016460518374501867 * (p_size * 100) ** 1.5 - 320.38502508802776 END, 4000)) AS INTEGER) AS mb FROM part")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", chemistry.memory_mb(F.col("p_size") * 100, F.when(F.col("p_size") % 3 == 0, 1).otherwise(2), F.lit(False)).alias("mb"))


@query("element_symbols", "SELECT p_partkey, CASE p_size WHEN 1 THEN 'H' WHEN 2 THEN 'He' WHEN 8 THEN 'O' WHEN 26 THEN 'Fe' ELSE 'x' END AS e FROM part")
def _(spark: S, d: str) -> DataFrame:
    s = chemistry.symbol(F.col("p_size"))
    return table(spark, d, "part").select("p_partkey", F.when(F.col("p_size").isin(1, 2, 8, 26), s).otherwise("x").alias("e"))


@query("walltime_text", "SELECT id, format('{:02d}:{:02d}:{:02d}', s // 3600, s % 3600 // 60, s % 60) AS t FROM (SELECT id, CAST(wall_time AS BIGINT) AS s FROM jobs WHERE wall_time IS NOT NULL)")
def _(spark: S, d: str) -> DataFrame:
    return jobs(spark, d).where("wall_time is not null").select("id", values.walltime(F.col("wall_time") / 3600).alias("t"))


@query("marker_messages", "SELECT id, CASE WHEN error_message IS NULL THEN 'blocked' ELSE concat('blocked: ', error_message) END AS m FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    return jobs(spark, d).select("id", values.marker_message("blocked", F.concat(F.lit(" "), F.col("error_message"))).alias("m"))
