"""Arrays of numbers: norms, neighbours, variances, greedy selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campanile.functions import geometry
from campanile.operators import selection
from campanile.plans.registry import query, table

S = SparkSession
_V = "CAST(embedding AS DOUBLE[])"
#: All whole triples of a vector's components as points, and symbols for them: even labels begin with the one centre, odd ones end with it.
_POINTS = f"p AS (SELECT vec_id, label, list_transform(range(len(embedding) // 3), lambda i: {_V}[3 * i + 1 : 3 * i + 3]) AS c, len(embedding) // 3 AS n, CASE WHEN label % 2 = 0 THEN 1 ELSE len(embedding) // 3 END AS hub FROM embeddings)"


def points(spark: S, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    c = geometry.triples(F.transform("embedding", lambda x: x.cast("double")))
    rest = F.array_repeat(F.lit("O"), F.size("c") - 1)
    symbols = F.when(F.col("label") % 2 == 0, F.concat(F.array(F.lit("U")), rest)).otherwise(F.concat(rest, F.array(F.lit("Am"))))
    return e.select("vec_id", "label", c.alias("c")).select("*", symbols.alias("symbols"))


@query("vector_norm_stats", f"WITH {_POINTS}, n AS (SELECT vec_id, list_transform(c, lambda v: sqrt(v[1]*v[1] + v[2]*v[2] + v[3]*v[3])) AS n FROM p) SELECT vec_id, round(list_max(n), 6) AS max_norm, round(list_avg(n), 6) AS mean_norm, round(sqrt(list_avg(list_transform(n, lambda x: x * x))), 6) AS rms_norms, round(sqrt(list_avg(list_transform(n, lambda x: x * x)) / 3), 6) AS rms_components FROM n")
def _(spark: S, d: str) -> DataFrame:
    n = geometry.norms(F.col("c"))
    s = geometry.force_summary(n)
    return points(spark, d).select("vec_id", *[F.round(x, 6).alias(k) for k, x in (("max_norm", s["max"]), ("mean_norm", s["mean"]), ("rms_norms", geometry.rms_norms(F.col("c"))), ("rms_components", geometry.rms_components(F.col("c"))))])


@query("rmsd_pairs", f"WITH {_POINTS} SELECT a.vec_id, round(list_distance(flatten(a.c), flatten(b.c)) / sqrt(a.n), 6) AS rmsd FROM p a JOIN p b ON b.vec_id = a.vec_id + 1")
def _(spark: S, d: str) -> DataFrame:
    p = points(spark, d)
    b = p.select((F.col("vec_id") - 1).alias("vec_id"), F.col("c").alias("d"))
    return p.join(b, "vec_id").select("vec_id", F.round(geometry.rmsd(F.col("c"), F.col("d")), 6).alias("rmsd"))


@query(
    "nearest_neighbor",
    f"""WITH {_POINTS}, l AS (SELECT vec_id, unnest(list_filter(range(1, n + 1), lambda i: i <> hub)) AS i, hub, c FROM p), n AS (SELECT vec_id, i, list_distance(c[hub], c[i]) AS dist FROM l)
SELECT vec_id, round(min(dist) FILTER (dist <= 0.3), 6) AS nearest, CAST(count(*) FILTER (dist <= 0.3) AS INTEGER) AS n FROM n GROUP BY vec_id""",
)
def _(spark: S, d: str) -> DataFrame:
    got = geometry.neighbours(F.col("symbols"), F.col("c"), ["U", "Am"], 0.3)
    return points(spark, d).select("vec_id", got[0].alias("g")).select("vec_id", F.round("g.nearest", 6).alias("nearest"), F.col("g.count").alias("n"))


@query(
    "neighbors_within_cutoff",
    f"""WITH {_POINTS}
SELECT vec_id, CAST(len(list_filter(range(1, n + 1), lambda i: i <> hub AND list_distance(c[hub], c[i]) <= 0.25)) AS INTEGER) AS n FROM p""",
)
def _(spark: S, d: str) -> DataFrame:
    near = geometry.near_any(F.col("symbols"), F.col("c"), ["U", "Am"], 0.25)
    return points(spark, d).select("vec_id", F.size(F.filter(near, lambda x: x)).alias("n"))


@query("force_subsets", f"WITH {_POINTS}, n AS (SELECT vec_id, hub, list_transform(c, lambda v: sqrt(v[1]*v[1] + v[2]*v[2] + v[3]*v[3])) AS n FROM p) SELECT vec_id, round(n[hub], 6) AS actinide_max, round((list_sum(n) - n[hub]) / (len(n) - 1), 6) AS other_mean FROM n")
def _(spark: S, d: str) -> DataFrame:
    n = geometry.norms(F.col("c"))
    a, o = geometry.pick(n, F.col("symbols"), ["U", "Am"]), geometry.pick(n, F.col("symbols"), ["U", "Am"], False)
    return points(spark, d).select("vec_id", F.round(geometry.force_summary(a)["max"], 6).alias("actinide_max"), F.round(geometry.force_summary(o)["mean"], 6).alias("other_mean"))


@query("variance_argmax", f"WITH x AS (SELECT label, unnest({_V}) AS v, unnest(range(64)) AS i FROM embeddings), s AS (SELECT label, i, var_pop(v) AS var FROM x GROUP BY label, i) SELECT label, CAST(arg_max(i, round(var, 9)) AS INTEGER) AS i FROM (SELECT * FROM s ORDER BY i) GROUP BY label")
def _(spark: S, d: str) -> DataFrame:
    x = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    spread = x.groupBy("label", "i").agg(F.round(F.var_pop(F.col("v").cast("double")), 9).alias("var"))
    return spread.groupBy("label").agg(F.max_by("i", F.struct("var", (-F.col("i")).alias("first"))).alias("i"))


@query(
    "dedup_rmsd_greedy",
    f"""WITH {_POINTS}, f AS (SELECT label, vec_id, flatten(c) AS v FROM p), g AS (SELECT label, list([[{{'i': vec_id, 'v': v}}]][1] ORDER BY vec_id) AS frames FROM f GROUP BY label),
k AS (SELECT label, list_reduce(frames, lambda kept, x: CASE WHEN len(list_filter(kept, lambda y: list_distance(y.v, x[1].v) / sqrt(len(y.v) / 3) < 0.22)) > 0 THEN kept ELSE list_concat(kept, x) END) AS kept FROM g)
SELECT label, unnest(list_transform(kept, lambda y: y.i)) AS vec_id FROM k""",
)
def _(spark: S, d: str) -> DataFrame:
    return selection.first_distinct(points(spark, d), "label", "vec_id", "c", 0.22).select("label", "vec_id")


@query("vector_sums_check", f"SELECT vec_id, abs(list_sum({_V}) - 0.1) <= 0.5 AS charge_ok FROM embeddings")
def _(spark: S, d: str) -> DataFrame:
    from campanile.functions.chemistry import conservation

    v = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, d, "embeddings").select("vec_id", conservation(v, v, F.lit(0.1), F.lit(1), (0.5, 0.5))["charge_ok"].alias("charge_ok"))
