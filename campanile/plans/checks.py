"""Files of jobs, checks of structures, small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campanile.constants import ELEMENTS
from campanile.functions import chemistry, logs
from campanile.operators import extraction, inventory, joins, reports, sampling, validation
from campanile.operators import jobs as sel
from campanile.plans.registry import jobs, query, table
from campanile.sources import tables

S = SparkSession
_DIRS = "dirs AS (SELECT DISTINCT concat('/data/run/job_', l_orderkey) AS job_dir FROM lineitem WHERE l_linenumber = 4)"
#: The files that line items stand for.
_NAMES = ["a.logs", "orca.out", "b.out", "orca_atom7.out", "c.out.gz", "flux-1.out", "x.engrad"]
_FILES = "files AS (SELECT l_orderkey AS job_dir, CASE l_linenumber " + " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(_NAMES)) + " END AS name, l_shipdate AS mtime, CAST(l_quantity AS BIGINT) % 10 AS size FROM lineitem)"


def files(spark: S, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    name = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), F.col("l_linenumber"))
    return li.select(F.col("l_orderkey").alias("job_dir"), name.alias("name"), F.col("l_shipdate").alias("mtime"), (F.col("l_quantity").cast("long") % 10).alias("size"))


@query("primary_logs", f"WITH {_FILES} SELECT job_dir, name FROM (SELECT *, row_number() OVER (PARTITION BY job_dir ORDER BY CASE name WHEN 'a.logs' THEN 0 WHEN 'orca.out' THEN 1 WHEN 'b.out' THEN 2 WHEN 'flux-1.out' THEN 2 WHEN 'c.out.gz' THEN 3 END, mtime DESC, name) AS r FROM files WHERE name NOT IN ('orca_atom7.out', 'x.engrad')) WHERE r = 1")
def _(spark: S, d: str) -> DataFrame:
    return extraction.primary_logs(files(spark, d)).select("job_dir", "name")


@query("termination_logs", f"WITH {_FILES} SELECT job_dir, name FROM (SELECT *, row_number() OVER (PARTITION BY job_dir ORDER BY CASE name WHEN 'a.logs' THEN 2 WHEN 'c.out.gz' THEN 1 ELSE 0 END, mtime DESC, name) AS r FROM files WHERE name NOT IN ('orca_atom7.out', 'x.engrad')) WHERE r = 1")
def _(spark: S, d: str) -> DataFrame:
    return extraction.termination_logs(files(spark, d)).select("job_dir", "name")


#: Seeds: every line item is a file of its order's directory, of one of three kinds, a few of them empty.
_SEEDS = "seeds AS (SELECT l_orderkey AS job_dir, concat('x', CASE WHEN l_linenumber % 4 < 2 THEN '.engrad' WHEN l_linenumber % 4 = 2 THEN '.gbw' ELSE '.out' END) AS rel_path, CASE WHEN l_partkey % 9 = 0 THEN 0 ELSE l_partkey % 100 + 1 END AS size FROM lineitem)"
_CHECKED = f"{_SEEDS}, g AS (SELECT job_dir, bool_or(rel_path = 'x.engrad' AND size > 0) AS e, bool_or(rel_path = 'x.gbw' AND size > 0) AS w, bool_or(rel_path = 'x.out' AND size > 0) AS o FROM seeds GROUP BY job_dir), c AS (SELECT job_dir, e AND w AND o AS valid, CASE WHEN NOT e THEN 'missing engrad' WHEN NOT w THEN 'missing gbw' WHEN NOT o THEN 'missing out' END AS reason FROM g)"


def seeds(spark: S, d: str) -> DataFrame:
    kind = F.when(F.col("l_linenumber") % 4 < 2, ".engrad").when(F.col("l_linenumber") % 4 == 2, ".gbw").otherwise(".out")
    size = F.when(F.col("l_partkey") % 9 == 0, 0).otherwise(F.col("l_partkey") % 100 + 1)
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("job_dir"), F.concat(F.lit("x"), kind).alias("rel_path"), size.alias("size"))


@query("seed_check", f"WITH {_CHECKED} SELECT job_dir, valid, reason FROM c")
def _(spark: S, d: str) -> DataFrame:
    return sel.seed_check(seeds(spark, d))


@query("seeded_jobs", f", {_CHECKED} SELECT row_number() OVER (ORDER BY id) AS id, orig_index, 'to_run' AS status, CAST(0 AS INTEGER) AS fail_count, id AS seed_dir FROM jobs JOIN c ON c.job_dir = id WHERE valid AND status = 'completed'")
def _(spark: S, d: str) -> DataFrame:
    done = jobs(spark, d).withColumn("job_dir", F.col("id"))
    return sel.seeded_jobs(done, seeds(spark, d)).select("id", "orig_index", "status", "fail_count", "seed_dir")


@query("spin_runs", "SELECT doc_id, spin FROM (SELECT doc_id, concat('spin_', doc_id % 4) AS spin, doc_id % 3 - 1 AS status FROM documents) WHERE spin = 'spin_1' AND status IN (1, -1)")
def _(spark: S, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.concat(F.lit("spin_"), (F.col("doc_id") % 4).cast("string")).alias("spin"), (F.col("doc_id") % 3 - 1).alias("status"))
    return sel.spin_runs(rows, "spin_1", (1, -1)).select("doc_id", "spin")


@query("verified_backups", ", m AS (SELECT DISTINCT concat('/data/run/job_', l_orderkey) AS job_dir FROM lineitem WHERE l_returnflag = 'R') SELECT id FROM jobs WHERE status = 'completed' AND job_dir IN (SELECT job_dir FROM m)")
def _(spark: S, d: str) -> DataFrame:
    m = table(spark, d, "lineitem").select(F.concat(F.lit("/data/run/job_"), F.col("l_orderkey").cast("string")).alias("job_dir"), (F.col("l_returnflag") == "R").alias("success"))
    return sel.verified(jobs(spark, d), m).select("id")


@query("folded_statuses", "SELECT l_orderkey, CAST(CASE WHEN bool_and(c = 1) THEN 1 WHEN bool_or(c = -2) THEN -2 WHEN bool_or(c = -1) THEN -1 ELSE 0 END AS INTEGER) AS code FROM (SELECT l_orderkey, CASE WHEN l_partkey % 5 < 3 THEN 1 WHEN l_partkey % 5 = 3 THEN -1 WHEN l_partkey % 10 = 4 THEN -2 ELSE 0 END AS c FROM lineitem) GROUP BY l_orderkey")
def _(spark: S, d: str) -> DataFrame:
    p = F.col("l_partkey")
    code = F.when(p % 5 < 3, 1).when(p % 5 == 3, -1).when(p % 10 == 4, -2).otherwise(0)
    got = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(code).alias("c"))
    return got.select("l_orderkey", logs.fold_statuses(F.col("c")).alias("code"))


@query("success_tallies", "SELECT count(*) AS total, count(*) FILTER (l_linenumber = 1) AS success, count(*) FILTER (l_linenumber = 2) AS running, count(*) FILTER (l_linenumber > 2) AS failed FROM lineitem")
def _(spark: S, d: str) -> DataFrame:
    code = F.when(F.col("l_linenumber") == 1, 1).when(F.col("l_linenumber") == 2, 0).otherwise(-1)
    return reports.tallies(table(spark, d, "lineitem").select(code.alias("code")))


@query("disk_status", ", c AS (SELECT id, id % 4 - 2 AS code, id % 3 <> 0 AS started FROM jobs) SELECT status, count(*) AS n FROM (SELECT CASE WHEN code = 1 THEN 'completed' WHEN code = -1 THEN 'failed' WHEN NOT started THEN 'to_run' WHEN code = -2 THEN 'timeout' ELSE 'running' END AS status FROM c) GROUP BY status")
def _(spark: S, d: str) -> DataFrame:
    status = inventory.disk_status(F.col("id") % 4 - 2, F.col("id") % 3 != 0)
    return jobs(spark, d).select(status.alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("ordered_elements", "SELECT p_partkey, p_size, CASE e WHEN 'U' THEN 0 WHEN 'Np' THEN 1 ELSE 2 END AS ordinal FROM (SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN p_size END AS p_size, CASE p_size % 5 WHEN 0 THEN 'U' WHEN 1 THEN 'Np' WHEN 2 THEN 'Pu' WHEN 3 THEN '' ELSE 'X' END AS e FROM part) WHERE e IN ('U', 'Np', 'Pu') AND p_size IS NOT NULL")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("p_size") % 5
    e = F.when(k == 0, "U").when(k == 1, "Np").when(k == 2, "Pu").when(k == 3, "").otherwise("X")
    df = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("p_size"), e.alias("element"))
    return sel.ordered_elements(df, "p_size", ["U", "Np", "Pu"]).select("p_partkey", "p_size", "ordinal")


@query("clean_sheet", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal >= 0")
def _(spark: S, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    sheet = c.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment"), F.lit(1).alias("Unnamed: 2"))
    return sel.clean_sheet(sheet, ["c_mktsegment"])


@query("rows_with_any_value", "SELECT count(*) FILTER (max_forces IS NOT NULL OR scf_steps IS NOT NULL) AS n FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    return reports.any_value_count(jobs(spark, d), ["max_forces", "scf_steps"])


@query("chunk_status_tallies", ", c AS (SELECT id % 3 AS chunk, status FROM jobs) SELECT CAST(chunk AS INTEGER) AS chunk, status, count(*) AS n FROM c GROUP BY ALL")
def _(spark: S, d: str) -> DataFrame:
    df = jobs(spark, d).select("id", "status")
    return tables.stacked([df.where(F.col("id") % 3 == k) for k in range(3)]).groupBy("chunk", "status").agg(F.count(F.lit(1)).alias("n"))


@query("leaving_ligand", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'O' WHEN 2 THEN 'Xe' ELSE NULL END AS ligand FROM part")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("p_size") % 4
    made = lambda *e: F.array(*[F.lit(x) for x in e])
    elements = F.when(k == 0, made("U", "O", "F", "H")).when(k == 1, made("O", "Np", "H")).when(k == 2, made("Am", "Xe", "Ne")).otherwise(made("U"))
    return table(spark, d, "part").select("p_partkey", chemistry.leaving_ligand(elements).alias("ligand"))


@query("spin_check", "SELECT p_partkey, coalesce(s >= 1 AND s % 2 <> e % 2, false) AS valid, CASE WHEN s < 1 THEN 'spin < 1' WHEN s % 2 = e % 2 THEN 'parity' WHEN s > 11 THEN 'unusual' END AS note FROM (SELECT p_partkey, p_size % 15 AS s, p_size // 15 AS e FROM part)")
def _(spark: S, d: str) -> DataFrame:
    got = chemistry.spin_check(F.col("p_size") % 15, F.floor(F.col("p_size") / 15))
    return table(spark, d, "part").select("p_partkey", got.alias("c")).select("p_partkey", "c.valid", "c.note")


@query("lumo_index", "SELECT p_partkey, CAST((z - c - CASE WHEN z BETWEEN 37 AND 54 THEN 28 ELSE 0 END) // 2 AS BIGINT) AS lumo FROM (SELECT p_partkey, p_size AS z, p_size % 2 AS c FROM part)")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", chemistry.lumo_index(F.array("p_size"), F.col("p_size") % 2).alias("lumo"))


@query(
    "input_alignment",
    """, v AS (SELECT CASE WHEN job_dir IS NULL THEN 'no_job_dir' WHEN id % 7 = 0 THEN 'no_input' WHEN id % 11 = 0 THEN 'unreadable_input' WHEN id % 3 = 2 THEN 'mismatch' ELSE 'match' END AS verdict FROM jobs)
SELECT verdict, count(*) AS n FROM v GROUP BY verdict""",
)
def _(spark: S, d: str) -> DataFrame:
    k = F.col("id")
    df = jobs(spark, d).withColumn("elements", F.lit("O;H; H"))
    deck = F.when(k % 11 == 0, "nothing").when(k % 3 == 0, "* xyz 0 1\nH 0 0 0\nO 0 0 1\nH 1 0 0\n*").when(k % 3 == 1, "*xyz 0 1\nH 0 0 0\nU 1 1 1\nO 0 0 1\nH 1 0 0\n*").otherwise("* xyz 0 1\nO 0 0 0\nH 1 0 0\nH 1 1 1\nF 0 0 0\n*")
    inputs = df.where((k % 7 != 0) & F.col("job_dir").isNotNull()).select("job_dir", deck.alias("text"))
    return reports.note_breakdown(validation.alignment(df, inputs), "verdict")


@query("first_and_rest", ", f AS (SELECT id, row_number() OVER (ORDER BY id) AS r, count(*) OVER () AS n FROM jobs WHERE status = 'failed') SELECT id, n - 20 AS more FROM f WHERE r <= 20")
def _(spark: S, d: str) -> DataFrame:
    failed = sel.by_status(jobs(spark, d), "failed").select("id")
    more = failed.agg((F.count(F.lit(1)) - 20).alias("more"))
    return failed.orderBy("id").limit(20).join(F.broadcast(more))


@query("slowest_jobs", "SELECT id, wall_time FROM jobs WHERE wall_time IS NOT NULL ORDER BY wall_time DESC, id LIMIT 10")
def _(spark: S, d: str) -> DataFrame:
    timings = jobs(spark, d).where("wall_time is not null").select(F.col("id").alias("job_dir"), F.col("wall_time").alias("seconds"))
    return reports.profile(timings)[1].select(F.col("job_dir").alias("id"), F.col("seconds").alias("wall_time"))


@query("threshold_groups", "SELECT grp, count(*) AS n FROM jobs GROUP BY grp HAVING count(*) >= 15")
def _(spark: S, d: str) -> DataFrame:
    return jobs(spark, d).groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n >= 15")


@query("last_rows", "SELECT grp, id, status FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY id DESC) AS r FROM jobs) WHERE r = 1")
def _(spark: S, d: str) -> DataFrame:
    return joins.last_by(jobs(spark, d).select("grp", "id", "status"), "grp", "id")


@query("transfer_list", "SELECT DISTINCT job_dir FROM jobs WHERE status = 'completed' AND trim(job_dir) <> ''")
def _(spark: S, d: str) -> DataFrame:
    from campanile.sinks import transfer_list

    return transfer_list(jobs(spark, d).where("status = 'completed'"))


@query("chunk_manifest", "SELECT doc_id AS orig_index, concat('chunk_', doc_id // 100, '.xyz') AS chunk_file, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1 AS index_in_chunk, 'U;O' AS elements FROM documents WHERE doc_id % 4 <> 0")
def _(spark: S, d: str) -> DataFrame:
    from campanile.sinks import manifest

    g = F.when(F.col("doc_id") % 4 != 0, "2\nc\nU 0 0 0\nO 0 0 1.8")
    return manifest(table(spark, d, "documents").select("doc_id", g.alias("g")), "g", 100, "doc_id")


@query("structure_table", "SELECT row_number() OVER (ORDER BY doc_id) AS id, doc_id AS orig_index, 'O;H;H' AS elements, 3 AS natoms, CAST(doc_id % 3 AS INTEGER) AS spin FROM documents WHERE doc_id % 4 <> 0 AND doc_id % 3 > 0")
def _(spark: S, d: str) -> DataFrame:
    k = F.col("doc_id")
    raw = table(spark, d, "documents").select(k.alias("orig_index"), F.when(k % 4 != 0, "3\nc\nO 0 0 0\nH 1 0 0\nH 0 1 0").alias("aligned_csd_core"), F.lit("0").alias("charge"), (k % 3).cast("string").alias("uhf"))
    return tables.structures(raw).select("id", "orig_index", "elements", "natoms", "spin")


@query("element_table", "SELECT CAST(n AS INTEGER) AS z, e FROM (SELECT unnest(range(1, 104)) AS n, unnest(string_split('" + " ".join(ELEMENTS) + "', ' ')) AS e)")
def _(spark: S, d: str) -> DataFrame:
    return spark.range(1, 104).select(F.col("id").cast("int").alias("z")).select("z", chemistry.symbol(F.col("z")).alias("e"))


@query("sampled_jobs", "SELECT id FROM jobs ORDER BY md5('3:' || CAST(id AS VARCHAR)), id LIMIT 100")
def _(spark: S, d: str) -> DataFrame:
    return sampling.sample(jobs(spark, d).select("id"), 100, "id", 3)


@query("transfer_summary", f", {_DIRS}, t AS (SELECT DISTINCT job_dir FROM jobs WHERE status = 'completed' AND trim(job_dir) <> ''), s AS (SELECT count(*) AS n, count(d.job_dir) AS existing, min(t.job_dir) AS a, max(t.job_dir) AS z FROM t LEFT JOIN dirs d USING (job_dir)) SELECT n, existing, n - existing AS missing, regexp_replace(a[1:list_max(list_filter(range(0, least(length(a), length(z)) + 1), lambda i: a[1:i] = z[1:i]))], '[^/]*$', '') AS prefix FROM s")
def _(spark: S, d: str) -> DataFrame:
    from campanile.sinks import transfer_list, transfer_summary

    there = table(spark, d, "lineitem").where("l_linenumber = 4").select(F.concat(F.lit("/data/run/job_"), F.col("l_orderkey").cast("string")).alias("job_dir"))
    return transfer_summary(transfer_list(jobs(spark, d).where("status = 'completed'")), there)


@query("directory_probes", "SELECT l_orderkey AS job_dir, bool_or(l_linenumber IN (2, 5)) AS is_sella, bool_or(l_linenumber = 6) AS has_marker, count(*) FILTER (l_linenumber = 3) AS atom_outputs FROM lineitem GROUP BY l_orderkey")
def _(spark: S, d: str) -> DataFrame:
    names = ["orca.out", "sella.log", "orca_atom12.out", "orca_atomx.out", "opt.traj", ".do_not_rerun.json", "sub/sella.log"]
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("job_dir"), F.element_at(F.array(*map(F.lit, names)), F.col("l_linenumber").cast("int")).alias("rel_path"))
    return inventory.probes(li)


@query("valid_groups", "SELECT l_orderkey, bool_or(l_partkey % 5 = 0) AS valid FROM lineitem GROUP BY l_orderkey")
def _(spark: S, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_partkey") % 5 == 0, 1).when(F.col("l_partkey") % 5 == 1, None).otherwise(-1).alias("status"))
    return reports.any_valid(li, "l_orderkey")


@query("jobs_in_folders", "SELECT page_id, contains(lower(regexp_extract(url, '([^/]*)/*$', 1)), 'sella') AS optimiser FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN concat(url, '/run_Sella/') WHEN 1 THEN concat('/sella/', page_id) ELSE url END AS url FROM pages)")
def _(spark: S, d: str) -> DataFrame:
    from campanile.functions.paths import of_optimiser

    k = F.col("page_id")
    url = F.when(k % 3 == 0, F.concat("url", F.lit("/run_Sella/"))).when(k % 3 == 1, F.concat(F.lit("/sella/"), k.cast("string"))).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", of_optimiser(url).alias("optimiser"))
