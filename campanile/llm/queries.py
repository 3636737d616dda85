"""The queries over the driver's tables that apply the text operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from campanile.llm import chat, exact_dedup, language, mixing, packing, quality, secrets, simhash, topk, toxicity
from campanile.llm.common import checksum_mod, read_table

#: The mixture of op5 and of the pipeline: integer weights at each level of the tree.
WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 1}, "source": {"src0": 8}}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


@query(
    "op8_exact_dedup",
    r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size, max(n) AS most FROM d GROUP BY text_sha256),
k AS (SELECT d.text_sha256, min(doc_id) AS keep_id FROM d JOIN g ON d.text_sha256 = g.text_sha256 AND d.n = g.most GROUP BY d.text_sha256)
SELECT d.doc_id, k.keep_id, CAST(g.group_size AS BIGINT) AS group_size, d.doc_id = k.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256) JOIN k USING (text_sha256)
""",
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.annotate(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), shown.alias("fingerprint"), F.col("component").alias("component_id"))


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), weights=target_shares())


def domain() -> Column:
    """The tree's top level: by the last character of a document's source."""
    last = F.right(F.coalesce("source", F.lit("")), F.lit(1))
    return F.when(last < "4", "web").when(last < "7", "books").otherwise("code")


def mixture_levels() -> dict[str, Column]:
    return {"domain": domain(), "lang": F.col("lang"), "source": F.col("source")}


def target_shares() -> Column:
    """The tokens that a window should hold of each source: its part of its domain's, by weight (over a row for each source)."""

    def weight(level: str, name: Column) -> Column:
        named = F.create_map(*[F.lit(x) for k, w in WEIGHTS[level].items() for x in (k, float(w))])
        return F.coalesce(F.try_element_at(named, name), F.lit(1.0))

    own = weight("source", F.coalesce("source", F.lit("")))
    return weight("domain", domain()) * own / F.sum(own).over(Window.partitionBy(domain()))


def mixture_sql(table: str = "documents") -> str:
    """CTEs up to ``chosen`` (id, domain, lang, source, n, times): the same budgets and prefixes in DuckDB."""
    names = ["domain", "lang", "source"]
    case = lambda k: "CASE " + " ".join(f"WHEN l.{k} = '{n}' THEN {w}" for n, w in WEIGHTS[k].items()) + " ELSE 1 END"
    out = rf"""
d AS (SELECT doc_id AS id, CASE WHEN right(coalesce(source, ''), 1) < '4' THEN 'web' WHEN right(coalesce(source, ''), 1) < '7' THEN 'books' ELSE 'code' END AS domain,
             coalesce(lang, '') AS lang, coalesce(source, '') AS source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS n FROM {table}),
leaves AS (SELECT domain, lang, source, CAST(sum(n) AS BIGINT) AS tokens FROM d GROUP BY ALL),
b0 AS (SELECT CAST(coalesce(sum(tokens), 0) * 3 // 4 AS BIGINT) AS budget FROM leaves)"""
    for i, k in enumerate(names):
        parent, path = names[:i], names[: i + 1]
        part = "PARTITION BY " + (", ".join(parent) or "0")
        run = f"{part} ORDER BY room / weight, {k} ROWS BETWEEN UNBOUNDED PRECEDING AND"
        out += f""",
c{i} AS (SELECT {", ".join("l." + p for p in path)}, sum(tokens) * 2 AS room, any_value(budget) AS budget, any_value({case(k)}) AS weight
         FROM leaves l JOIN b{i} b ON {" AND ".join(f"l.{p} = b.{p}" for p in parent) or "true"} GROUP BY {", ".join("l." + p for p in path)}),
p{i} AS (SELECT *, sum(weight) OVER ({part}) - coalesce(sum(weight) OVER ({run} 1 PRECEDING), 0) AS weight_left, budget - coalesce(sum(room) OVER ({run} 1 PRECEDING), 0) AS budget_left FROM c{i}),
f{i} AS (SELECT *, min(CASE WHEN room * weight_left <= weight * budget_left THEN 1 ELSE 0 END) OVER ({run} CURRENT ROW) AS is_full FROM p{i}),
r{i} AS (SELECT *, greatest(budget - coalesce(sum(CASE WHEN is_full = 1 THEN room END) OVER ({part}), 0), 0) AS rest, coalesce(sum(CASE WHEN is_full = 0 THEN weight END) OVER ({part}), 1) AS open_weight,
                coalesce(sum(CASE WHEN is_full = 0 THEN weight END) OVER ({run} CURRENT ROW), 0) AS up_to FROM f{i}),
b{i + 1} AS (SELECT {", ".join(path)}, CASE WHEN is_full = 1 THEN room ELSE rest * up_to // open_weight - rest * (up_to - weight) // open_weight END AS budget FROM r{i})"""
    return out + """,
m AS (SELECT l.*, b.budget, CASE WHEN tokens > 0 THEN b.budget // tokens ELSE 0 END AS epochs FROM leaves l JOIN b3 b USING (domain, lang, source)),
k AS (SELECT d.*, m.epochs, m.budget - m.epochs * m.tokens AS rest, md5('11:' || CAST(CAST(m.epochs AS BIGINT) AS VARCHAR) || ':' || coalesce(CAST(d.id AS VARCHAR), '')) AS okey FROM d JOIN m USING (domain, lang, source)),
s AS (SELECT domain, lang, source, okey, sum(n) AS n FROM k GROUP BY ALL),
o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, lang, source ORDER BY okey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s),
chosen AS (SELECT k.id, k.domain, k.lang, k.source, k.n, CAST(k.epochs + CASE WHEN o.before < k.rest THEN 1 ELSE 0 END AS BIGINT) AS times FROM k JOIN o USING (domain, lang, source, okey))"""


@query(
    "op5_mixing",
    "WITH" + mixture_sql() + "\nSELECT id AS doc_id, domain, lang, source, CAST(e AS INTEGER) AS epoch, n AS tokens FROM chosen, LATERAL (SELECT unnest(range(times)) AS e) WHERE times > 0",
)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.select(read_table(spark, sf_dir, "documents"), mixture_levels(), WEIGHTS).withColumnRenamed("id", "doc_id")


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = checksum_mod(F.col("doc_id"), 3) == 1
    model = language.fit(docs.where(~held_out))
    return language.identify(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out})


def secrets_sql() -> str:
    """Spans from the texts between matches: a match starts after all texts and matches before it.

    RE2 has no look-behind: there, a token's expression takes the character before it along, and its own length is that of a group.
    """
    either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    names = "|".join(map(either, ("password", "passwd", "secret", "token", "api_?key")))
    part = "[A-Za-z0-9_-]{8,}"
    rules = [  # kind, expression, group of the span, group whose length counts, least length
        ("assign", rf"""({names})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 0, 2, 6),
        ("access", "AKIA[A-Z0-9]+", 0, 0, 20),
        ("hex", "[0-9a-f]+", 0, 0, 24),
        ("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0, 0),
        ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0, 0),
        ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0, 0),
        ("jwt", rf"(^|[^A-Za-z0-9_-])(eyJ{part}\.{part}\.{part})", 2, 0, 0),
    ]
    out = "WITH d AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS t FROM documents)"
    for k, (_, expression, span, value, _) in enumerate(rules):
        every = f"regexp_extract_all(t, '{expression}', %d)"
        out += f""",
a{k} AS (SELECT row, string_split_regex(t, '{expression}') AS gaps, {every % 0} AS whole, {every % span} AS own, {every % value} AS val FROM d),
m{k} AS (SELECT row, {k} AS k, generate_subscripts(whole, 1) AS i, gaps, whole, own, val FROM a{k})"""
    found = " UNION ALL ".join(
        f"""SELECT row, k, '{kind}' AS kind, list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(whole[1:i], lambda g: length(g))), 0) AS stop,
       length(own[i]) AS size FROM m{k} WHERE length(val[i]) >= {least}"""
        for k, (kind, _, _, _, least) in enumerate(rules)
    )
    return out + f""",
f AS ({found}),
s AS (SELECT row, k, kind, CAST(stop - size AS BIGINT) AS start, kind || ':' || CAST(stop - size AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM f)
SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, k) FILTER (WHERE k < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY start, k), '') AS spans
FROM d LEFT JOIN s USING (row) GROUP BY row, doc_id
"""


@query("op9_secrets", secrets_sql())
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secrets.BASE]))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("id").alias("doc_id"), *[count(r.kind) for r in secrets.BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def with_prediction(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return with_prediction(toxicity.score(docs, model, {"doc_id": F.col("doc_id"), "held_out": checksum_mod(F.col("doc_id"), 5) == 0}))


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    field = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return with_prediction(quality.score(docs, field, {"doc_id": F.col("doc_id"), "held_out": checksum_mod(F.col("doc_id"), 3) == 1}))


@query(
    "op3_topk",
    """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
""",
)
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0).withColumnRenamed("id", "vec_id")


@query(
    "op4_chat",
    r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, role, text,
             concat('<|turn|>', regexp_replace(role, '([<\[])(\\*)(\||/?s>|</?SYS>>|/?INST\])', '\1\2\\\3', 'g'), '<|text|>',
                    regexp_replace(text, '([<\[])(\\*)(\||/?s>|</?SYS>>|/?INST\])', '\1\2\\\3', 'g'), '<|end|>') AS piece FROM c),
n AS (SELECT *, length(piece) AS len, len(regexp_extract_all(piece, '\p{L}{1,8}|\p{N}{1,3}|[^\p{L}\p{N}\x20\x09-\x0D]')) AS n, pos = 1 AND role = 'system' AS is_system FROM e),
s AS (SELECT *, coalesce(max(CASE WHEN is_system THEN n END) OVER (PARTITION BY conv_id), 0) AS system, sum(n) OVER (PARTITION BY conv_id ORDER BY pos) - n AS begin FROM n),
h AS (SELECT *, greatest(512 - system - 128, 16) / 2 AS half FROM s),
w AS (SELECT *, CASE WHEN NOT is_system THEN floor((begin - system) / half) * 2 + CASE WHEN n > half THEN 1 ELSE 0 END END AS win FROM h),
a AS (SELECT *, lead(win, 1) OVER o AS w1, lead(begin, 1) OVER o AS b1, lead(win, 2) OVER o AS w2, lead(begin, 2) OVER o AS b2 FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY pos)),
t AS (SELECT *, CASE WHEN is_system THEN 0 ELSE CASE WHEN w1 > win AND b1 - begin <= 128 THEN 1 ELSE 0 END +
                CASE WHEN w2 > win AND b2 - begin <= 128 AND NOT coalesce(w2 = w1 AND w1 > win AND b1 - begin <= 128, false) THEN 1 ELSE 0 END END AS later FROM a)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '')) AS loss_sha256,
       CAST(coalesce(sum(CASE WHEN NOT is_system THEN len * (1 + later) END), 0) + coalesce(max(CASE WHEN is_system THEN len END), 0) * greatest(count(DISTINCT win), 1) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
""",
)
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    back = chat.read_back(chat.format_windows(rows))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("target").cast("long").alias("loss_chars"),
        F.sha2(F.col("target"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
