"""Joins, set operations and inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campanile.functions.chemistry import spin_ladder, spin_states
from campanile.operators import inventory, joins
from campanile.operators import reports as rep
from campanile.plans.registry import jobs, query, table
from campanile.streaming.events import outdated, silent

S = SparkSession


@query(
    "category_summary",
    """WITH s AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_nationkey % 3 <> 0 GROUP BY 1), c AS (SELECT c_nationkey AS k, count(*) AS n, round(sum(c_acctbal), 2) AS bal FROM customer WHERE c_nationkey % 4 <> 0 GROUP BY 1),
n AS (SELECT n_nationkey AS k, n_name FROM nation WHERE n_nationkey % 5 <> 0), k AS (SELECT k FROM s UNION SELECT k FROM c UNION SELECT k FROM n)
SELECT k.k AS k, s.n AS sup_n, c.n AS cus_n, c.bal AS cus_bal, n.n_name AS nat_n_name FROM k LEFT JOIN s ON s.k = k.k LEFT JOIN c ON c.k = k.k LEFT JOIN n ON n.k = k.k""",
)
def _(spark: S, d: str) -> DataFrame:
    sup = table(spark, d, "supplier").where("s_nationkey % 3 <> 0").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    cus = table(spark, d, "customer").where("c_nationkey % 4 <> 0").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("bal"))
    nat = table(spark, d, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("k"), "n_name")
    return joins.on_spine({"sup": sup, "cus": cus, "nat": nat}, "k")


@query("union_by_name", "SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark: S, d: str) -> DataFrame:
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return joins.union_by_name([a, b])


@query(
    "best_of_main_alt",
    """WITH m AS (SELECT l_partkey AS k, min(l_extendedprice) AS v FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), a AS (SELECT l_partkey AS k, min(l_extendedprice) AS v FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
j AS (SELECT coalesce(m.k, a.k) AS k, m.k AS mk, a.k AS ak, m.v AS mv, a.v AS av, coalesce(m.v < 20000, false) AS vm, coalesce(a.v < 20000, false) AS va FROM m FULL JOIN a ON m.k = a.k),
u AS (SELECT *, mk IS NULL OR (va AND NOT vm) OR (vm = va AND ak IS NOT NULL AND coalesce(av < mv, false)) AS alt FROM j)
SELECT k, CASE WHEN alt THEN 'alt' ELSE 'main' END AS source, vm OR va AS has_valid, CASE WHEN alt THEN av ELSE mv END AS v FROM u""",
)
def _(spark: S, d: str) -> DataFrame:
    side = lambda f: table(spark, d, "lineitem").where(F.col("l_returnflag") == f).groupBy(F.col("l_partkey").alias("k")).agg(F.min("l_extendedprice").alias("v"))
    return joins.best_of(side("A"), side("N"), "k", F.col("v") < 20000, "v")


@query(
    "fallback_key_join",
    """WITH p AS (SELECT p_partkey, p_brand, CASE p_partkey % 3 WHEN 0 THEN concat(p_brand, '_PBE0') WHEN 1 THEN concat('ECP-', p_brand) ELSE 'none' END AS name FROM part),
r AS (SELECT replace(replace(p_brand, '-', ''), 'ECP', '') AS k, min(p_size) AS v FROM part GROUP BY 1),
x AS (SELECT *, replace(replace(replace(name, '-', ''), 'ECP', ''), 'ZORA', '') AS k1, replace(replace(replace(CASE WHEN name LIKE '%\\_PBE0' ESCAPE '\\' THEN left(name, length(name) - 5) ELSE name END, '-', ''), 'ECP', ''), 'ZORA', '') AS k2 FROM p)
SELECT p_partkey, coalesce(a.v, b.v) AS v FROM x LEFT JOIN r a ON a.k = k1 LEFT JOIN r b ON b.k = k2""",
)
def _(spark: S, d: str) -> DataFrame:
    part = table(spark, d, "part")
    third = F.col("p_partkey") % 3
    named = part.select("p_partkey", F.when(third == 0, F.concat("p_brand", F.lit("_PBE0"))).when(third == 1, F.concat(F.lit("ECP-"), "p_brand")).otherwise("none").alias("name"))
    right = part.select(F.replace(F.replace("p_brand", F.lit("-"), F.lit("")), F.lit("ECP"), F.lit("")).alias("k"), F.col("p_size").alias("v"))
    return joins.by_fallback_key(named, right, "name", "k", "v").select("p_partkey", "v")


@query(
    "directory_join",
    ", e AS (SELECT DISTINCT concat('/data/run/job_', l_orderkey) AS dir FROM lineitem) SELECT id, coalesce(a.dir, b.dir) AS found_dir FROM jobs LEFT JOIN e a ON a.dir = job_dir LEFT JOIN e b ON b.dir = concat('/data/run/job_', id - id % 2)",
)
def _(spark: S, d: str) -> DataFrame:
    from campanile.plans.states import dirs

    df = jobs(spark, d).withColumn("rendered_dir", F.concat(F.lit("/data/run/job_"), (F.col("id") - F.col("id") % 2).cast("string")))
    return joins.with_directory(df, dirs(spark, d)).select("id", "found_dir")


@query(
    "index_suffix_join",
    """, e AS (SELECT concat(CASE o_orderkey % 3 WHEN 0 THEN 'job_' WHEN 1 THEN 'run-a_' ELSE 'x' END, o_orderkey) AS dir, o_orderkey AS i FROM orders UNION ALL SELECT concat('other-', o_orderkey), o_orderkey FROM orders WHERE o_orderkey % 6 = 1),
f AS (SELECT i, min(CASE WHEN dir LIKE 'job%' THEN dir END) AS exact, min(dir) AS any_, count(*) AS n FROM e WHERE dir NOT LIKE 'x%' GROUP BY i)
SELECT id, coalesce(exact, CASE WHEN n = 1 THEN any_ END) AS found_dir, exact IS NULL AND coalesce(n, 0) > 1 AS ambiguous FROM jobs LEFT JOIN f ON f.i = id""",
)
def _(spark: S, d: str) -> DataFrame:
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    a = o.select(F.concat(F.when(k % 3 == 0, "job_").when(k % 3 == 1, "run-a_").otherwise("x"), k.cast("string")).alias("job_dir"))
    b = o.where("o_orderkey % 6 = 1").select(F.concat(F.lit("other-"), k.cast("string")).alias("job_dir"))
    return joins.by_index_suffix(jobs(spark, d).select("id", "orig_index"), a.unionByName(b)).select("id", "found_dir", "ambiguous")


@query("geometry_x_spin", "SELECT r_regionkey, r_name, CAST(s AS INTEGER) AS spin FROM region, LATERAL (SELECT unnest(range(r_regionkey + 5, CASE WHEN (r_regionkey + 5) % 2 = 1 THEN 0 ELSE 1 END, -2)) AS s)")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "region").select("r_regionkey", "r_name", F.explode(spin_ladder((F.col("r_regionkey") + 5).cast("int"))).alias("spin"))


@query("spin_states", "SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([g, greatest(g, u + 1), g + 2], lambda x: x <= greatest(g, u + 1)))), ',') AS spins FROM (SELECT p_partkey, p_size % 7 + 1 AS g, p_size % 9 AS u FROM part)")
def _(spark: S, d: str) -> DataFrame:
    p = table(spark, d, "part")
    got = spin_states((F.col("p_size") % 7 + 1).cast("int"), (F.col("p_size") % 9).cast("int"))
    return p.select("p_partkey", F.array_join(F.transform(got, lambda x: x.cast("string")), ",").alias("spins"))


@query("multiplicity_join", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey > 1")
def _(spark: S, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.col("n_regionkey").alias("molecule"), "n_name")
    r = table(spark, d, "region").where("r_regionkey > 1").select(F.col("r_regionkey").alias("molecule"), "r_name")
    return joins.geometry_by_multiplicity(n, r).select("n_name", "r_name")


@query("listed_rows", "SELECT id, status FROM jobs WHERE id IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def _(spark: S, d: str) -> DataFrame:
    mapping = table(spark, d, "lineitem").where("l_quantity > 45").groupBy("l_suppkey").agg(F.collect_set("l_orderkey").alias("row_ids"))
    return joins.listed(jobs(spark, d), mapping, "id", "row_ids").select("id", "status")


@query("bag_difference", "(SELECT l_partkey FROM lineitem WHERE l_linenumber = 1 EXCEPT ALL SELECT l_partkey FROM lineitem WHERE l_linenumber = 2)")
def _(spark: S, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return joins.bag_difference(li.where("l_linenumber = 1").select("l_partkey"), li.where("l_linenumber = 2").select("l_partkey"))[0]


@query("set_intersection", "SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal > 0")
def _(spark: S, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).intersect(table(spark, d, "customer").where("c_acctbal > 0").select("c_nationkey"))


@query("cache_join", "SELECT id, coalesce(id % 3 <> 0 AND id % 4 >= id % 5, false) AS hit, CASE WHEN id % 3 <> 0 AND id % 4 >= id % 5 THEN scf_steps END AS cached FROM jobs")
def _(spark: S, d: str) -> DataFrame:
    rows = jobs(spark, d).select("id", (F.col("id") % 5).alias("mtime"))
    cache = jobs(spark, d).where("id % 3 <> 0").select("id", (F.col("id") % 4).alias("source_mtime"), F.col("scf_steps").alias("cached"))
    return joins.with_cache(rows, cache, "id").select("id", "hit", "cached")


@query("incremental_by_mtime", "SELECT user_id, count(*) AS n FROM events WHERE ts > TIMESTAMP '2024-01-15' GROUP BY user_id")
def _(spark: S, d: str) -> DataFrame:
    events = table(spark, d, "events").select("event_id", "user_id", F.col("ts").alias("mtime"))
    cache = events.select("event_id", F.expr("timestamp_ntz'2024-01-15'").alias("source_mtime"))
    return outdated(events, cache, "event_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("silent_jobs", "SELECT user_id, CASE WHEN epoch(max(ts)) < epoch(TIMESTAMP '2024-02-01') - 7200 * 12 THEN -2 ELSE 0 END AS code FROM events GROUP BY user_id")
def _(spark: S, d: str) -> DataFrame:
    return silent(table(spark, d, "events"), F.expr("timestamp_ntz'2024-02-01'"), 24, "user_id").select("user_id", "code")


@query(
    "as_of_join",
    "SELECT e.event_id, (SELECT max_by(p.value, (p.ts, p.event_id)) FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts <= e.ts) AS last_value FROM events e WHERE e.event_type = 'error'",
)
def _(spark: S, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value")
    left = e.where("event_type = 'error'").drop("value")
    return joins.as_of(left, e.where("event_type = 'purchase'"), ["user_id"], "ts", "value").select("event_id", "last_value")


@query("range_join", "SELECT a.s_suppkey, b.c_custkey FROM supplier a JOIN customer b ON a.s_nationkey = b.c_nationkey AND abs(a.s_acctbal - b.c_acctbal) <= 25")
def _(spark: S, d: str) -> DataFrame:
    a, b = table(spark, d, "supplier").withColumn("k", F.col("s_nationkey")), table(spark, d, "customer").withColumn("k", F.col("c_nationkey"))
    return joins.range_pairs(a, b, "s_acctbal", "c_acctbal", 25.0, ["k"]).select("s_suppkey", "c_custkey")


# A listing that pages stand for: eight kinds of names, sizes from the html.
_NAMES = ["orca.out", "orca.inp", "orca.tmp.3", "core.4711", "data.weird", "orca.bas12", "orca_tmp_ab1/scratch.0", "run.x.GZ"]
_LISTING = "listing AS (SELECT concat('job_', page_id % 40) AS job_dir, CASE page_id % 8 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_NAMES)) + " END AS rel_path, length(html) AS size, page_id % 11 = 0 AS is_symlink FROM pages)"
_CLASSED = (
    _LISTING
    + """, c AS (SELECT job_dir, rel_path, CASE WHEN is_symlink THEN 0 ELSE size END AS bytes,
CASE WHEN starts_with(rel_path, 'orca_tmp_') THEN 'scratch_tmp' WHEN rel_path IN ('orca.out', 'orca.inp') THEN 'essential' WHEN rel_path IN ('orca.tmp.3', 'core.4711') THEN 'scratch_tmp' WHEN rel_path = 'orca.bas12' THEN 'scratch_bas' ELSE 'other' END AS class,
CASE rel_path WHEN 'orca.out' THEN '.out' WHEN 'orca.inp' THEN '.inp' WHEN 'orca.tmp.3' THEN '.tmp' WHEN 'core.4711' THEN 'core' WHEN 'data.weird' THEN '.weird' WHEN 'orca.bas12' THEN '.bas' WHEN 'run.x.GZ' THEN '.x.gz' ELSE '.0' END AS ext FROM listing)"""
)


def listing(spark: S, d: str) -> DataFrame:
    p = table(spark, d, "pages")
    return p.select(
        F.concat(F.lit("job_"), (F.col("page_id") % 40).cast("string")).alias("job_dir"), F.element_at(F.array(*[F.lit(n) for n in _NAMES]), (F.col("page_id") % 8 + 1).cast("int")).alias("rel_path"),
        F.length("html").alias("size"), F.lit(None).cast("timestamp").alias("mtime"), (F.col("page_id") % 11 == 0).alias("is_symlink"),
    )


@query(
    "file_class_inventory",
    f"WITH {_CLASSED} SELECT job_dir, count(*) AS n_files, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(coalesce(sum(bytes) FILTER (class = 'essential'), 0) AS BIGINT) AS essential_bytes, CAST(coalesce(sum(bytes) FILTER (class = 'scratch_tmp'), 0) AS BIGINT) AS scratch_tmp_bytes, CAST(coalesce(sum(bytes) FILTER (starts_with(rel_path, 'orca_tmp_')), 0) AS BIGINT) AS nested_bytes FROM c GROUP BY job_dir",
)
def _(spark: S, d: str) -> DataFrame:
    return inventory.per_job(listing(spark, d)).select("job_dir", "n_files", "bytes", "essential_bytes", "scratch_tmp_bytes", "nested_bytes")


@query("files_by_extension", f"WITH {_CLASSED} SELECT ext, count(*) AS n_files, CAST(sum(bytes) AS BIGINT) AS bytes FROM c GROUP BY ext")
def _(spark: S, d: str) -> DataFrame:
    return inventory.per_key(listing(spark, d))


@query("files_by_class", f"WITH {_CLASSED} SELECT class, count(*) AS n_files, CAST(sum(bytes) AS BIGINT) AS bytes FROM c GROUP BY class")
def _(spark: S, d: str) -> DataFrame:
    return inventory.per_key(listing(spark, d), "class")


@query("inventory_rollup", f"WITH {_CLASSED} SELECT ext, job_dir, count(*) AS n_files, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(grouping(ext, job_dir) AS BIGINT) AS level FROM c GROUP BY ROLLUP (ext, job_dir)")
def _(spark: S, d: str) -> DataFrame:
    return inventory.rolled_up(listing(spark, d))


@query("largest_files", f"WITH {_CLASSED} SELECT job_dir, rel_path, bytes FROM (SELECT *, row_number() OVER (PARTITION BY job_dir ORDER BY bytes DESC, rel_path) AS r FROM c) WHERE r <= 5 ORDER BY bytes DESC, job_dir, rel_path LIMIT 25")
def _(spark: S, d: str) -> DataFrame:
    return inventory.largest_files(listing(spark, d), 25, 5).select("job_dir", "rel_path", "bytes")


@query("scratch_plan", f"WITH {_CLASSED} SELECT job_dir, CASE WHEN starts_with(rel_path, 'orca_tmp_') THEN 'orca_tmp_ab1' ELSE rel_path END AS path, starts_with(rel_path, 'orca_tmp_') AS is_dir, CAST(sum(bytes) AS BIGINT) AS bytes FROM c WHERE class IN ('scratch_tmp', 'scratch_bas') GROUP BY 1, 2, 3")
def _(spark: S, d: str) -> DataFrame:
    return inventory.scratch_plan(listing(spark, d))


@query("jobs_started", f"WITH {_LISTING} SELECT job_dir, bool_or(rel_path = 'orca.out') AS started FROM listing GROUP BY job_dir")
def _(spark: S, d: str) -> DataFrame:
    return inventory.started(listing(spark, d))


@query("move_plan", "WITH m AS (SELECT n_nationkey AS source, concat('t', n_regionkey) AS target, n_regionkey = 2 AS conflict FROM nation) SELECT *, NOT (SELECT bool_or(conflict) FROM m) AS go FROM m")
def _(spark: S, d: str) -> DataFrame:
    moves = table(spark, d, "nation").select(F.col("n_nationkey").alias("source"), F.concat(F.lit("t"), F.col("n_regionkey").cast("string")).alias("target"))
    return inventory.move_plan(moves, table(spark, d, "region").where("r_regionkey = 2").select(F.concat(F.lit("t"), F.col("r_regionkey").cast("string")).alias("job_dir")))


@query("delete_plan", "SELECT DISTINCT concat('n', n_nationkey) AS job_dir, n_nationkey IN (SELECT s_nationkey FROM supplier) AS found FROM nation")
def _(spark: S, d: str) -> DataFrame:
    name = lambda c: F.concat(F.lit("n"), F.col(c).cast("string")).alias("job_dir")
    return inventory.delete_plan(table(spark, d, "nation").select(name("n_nationkey")), table(spark, d, "supplier").select(name("s_nationkey")))


@query("validation_gate", "SELECT count(*) AS sampled, count(*) FILTER (n_regionkey > 1) AS matched, count(*) FILTER (n_regionkey = 1) AS mismatched, count(*) FILTER (n_regionkey = 1) = 0 AS passed FROM nation")
def _(spark: S, d: str) -> DataFrame:
    v = F.when(F.col("n_regionkey") > 1, "match").when(F.col("n_regionkey") == 1, "mismatch").otherwise("unverifiable")
    return rep.gate(table(spark, d, "nation").select(v.alias("verdict")))


@query(
    "spins_by_formula",
    """WITH s AS (SELECT concat('M', p_partkey) AS formula, p_size % 3 - 1 AS charge, p_size % 4 + 1 AS mult, CASE p_size % 3 WHEN 0 THEN '1, 3,5' WHEN 1 THEN 'x,3' ELSE '2' END AS l FROM part WHERE p_partkey % 2 = 0)
SELECT p_partkey, charge, mult, CASE l WHEN '1, 3,5' THEN '1;3;5' WHEN '2' THEN '2' ELSE CAST(mult AS VARCHAR) END AS mults FROM part JOIN s ON formula = concat('M', p_partkey)""",
)
def _(spark: S, d: str) -> DataFrame:
    part, size = table(spark, d, "part"), F.col("p_size")
    name = F.concat(F.lit("M"), F.col("p_partkey").cast("string"))
    text = F.when(size % 3 == 0, "1, 3,5").when(size % 3 == 1, "x,3").otherwise("2")
    spins = part.where("p_partkey % 2 = 0").select(name.alias("formula"), (size % 3 - 1).alias("charge"), (size % 4 + 1).alias("mult"), text.alias("mult_list"))
    got = joins.by_formula(part.select("p_partkey", name.alias("name")), spins)
    return got.select("p_partkey", "charge", "mult", F.array_join(F.col("mults").cast("array<string>"), ";").alias("mults"))
