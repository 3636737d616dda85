"""Mixing sources to target weights by hierarchical budgeting over a tree of domains, languages and sources.

Top-down, a node's token budget is shared out over its children by weight. A child can take at most what its
leaves hold, ``max_epochs`` times over; what it can't take goes to its siblings by their weights, and only what
all of them together can't take has been kept from the node beforehand, so it went to the node's own siblings.
(A parent's share is limited by its whole subtree, which is the same as handing shortages up after the siblings.)

A leaf with budget B and C tokens gets B div C whole epochs and, of one more, the shortest prefix that reaches
the rest. An epoch's order is the md5 of ``seed:epoch:id``; a document is in the prefix if the tokens of documents
with smaller md5 don't reach the rest. So a leaf's choice is one number of epochs and one greatest md5, and
documents are chosen where they are read: texts never shuffle.

A leaf's prefix is found in two steps, by sums over 4096 md5 ranges and then in the one range where it ends.

Defined cases: null levels and texts count as ''; rows that repeat an id are chosen or left together; weights are
non-negative integers, names without one have ``default_weight``; a document without tokens is chosen with its
epoch's prefix like any other, and of texts of any length all words are counted. Other columns, whatever their names, are passed on by
``mix`` and not looked at by ``select``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.llm.common import ASCII_SPACE, if_small, written

SEED = 11
LEVELS = ("domain", "lang", "source")


def words(text: Column) -> Column:
    """The number of ``[^\\x20\\x09-\\x0D]+`` in a text; null counts as empty."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(ASCII_SPACE))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, r"[\x20\x09-\x0D]+"))).cast("long")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _weight(level: str, weights: dict[str, int], default: int) -> Column:
    if not weights:
        return F.lit(default).cast("long")
    named = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, int(w))])
    return F.coalesce(F.try_element_at(named, F.col(level)), F.lit(default)).cast("long")


def share_out(children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """children (parent's columns, name, weight, room, budget of the parent) with ``share``: whole tokens, none lost.

    Children are taken by room for each unit of weight; while one's room is within its part of what is left, it
    is filled. The others split the rest by weight, in whole tokens.
    """
    ranked = Window.partitionBy(*parent).orderBy(F.col("room") / F.col("weight"), "name")
    all_ = Window.partitionBy(*parent)
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    live = children.where("weight > 0")
    live = live.withColumn("weight_left", F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    live = live.withColumn("budget_left", F.col("budget") - F.coalesce(F.sum("room").over(before), F.lit(0)))
    fits = F.expr("cast(room as decimal(38,0)) * weight_left <= cast(weight as decimal(38,0)) * budget_left")
    live = live.withColumn("full", F.min(F.when(fits, 1).otherwise(0)).over(ranked.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(all_), F.lit(0))
    live = live.withColumn("rest", F.greatest(rest, F.lit(0))).withColumn("open_weight", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(all_), F.lit(1)))
    up_to = F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(ranked.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    live = live.withColumn("up_to", up_to)
    part = F.expr(
        "cast((cast(rest as decimal(38,0)) * up_to) div open_weight - (cast(rest as decimal(38,0)) * (up_to - weight)) div open_weight as bigint)"
    )
    return live.withColumn("share", F.when(F.col("full"), F.col("room")).otherwise(part))


def leaf_budgets(
    leaves: DataFrame, budget: int, levels: Sequence[str], weights: dict[str, dict[str, int]], max_epochs: int, default_weight: int = 1
) -> DataFrame:
    """leaves (levels, tokens) with ``budget``, their parts of the whole mixture's tokens."""
    rooms = leaves.withColumn("room", F.col("tokens") * max_epochs)
    path: list[str] = []
    given = None
    for level in levels:
        children = rooms.groupBy(*path, level).agg(F.sum("room").alias("room"))
        children = children.join(given, path) if given is not None else children.withColumn("budget", F.lit(budget).cast("long"))
        children = children.withColumn("name", F.col(level)).withColumn("weight", _weight(level, weights.get(level, {}), default_weight))
        path = [*path, level]
        given = share_out(children, path[:-1]).select(*path, F.col("share").alias("budget"))
    return leaves.join(given, list(levels))


def choose(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, dict[str, int]],
    budget_share: tuple[int, int] = (3, 4),
    max_epochs: int = 2,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """What to take of each leaf, and the documents' own figures.

    levels: the tree's levels from the top, as expressions over docs. budget_share: the mixture's tokens, as a part of all
    tokens. The first result has a row for each leaf: levels, tokens, budget, epochs (whole ones), last (the greatest md5
    taken of the next epoch, or null). The second has (id, levels, n).
    """
    names = list(levels)
    rows = docs.select(
        F.col(id_col).alias("id"), *[F.coalesce(c.cast("string"), F.lit("")).alias(k) for k, c in levels.items()], words(F.col(text_col)).alias("n")
    )
    rows = written(rows, "counts")
    leaves = rows.groupBy(*names).agg(F.sum("n").alias("tokens"))
    top, bottom = budget_share
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    held = leaf_budgets(leaves, total * top // bottom, names, weights, max_epochs)
    held = held.withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)))
    held = written(held.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")), "leaves")
    key = order_key(seed, F.col("epochs"), F.col("id"))
    keyed = rows.join(if_small(held).where("rest > 0").select(*names, "epochs", "rest"), names).select(*names, "rest", "n", key.alias("key"))
    keyed = keyed.withColumn("range", F.substring("key", 1, 3))
    sums = keyed.groupBy(*names, "rest", "range").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy(*names).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ends = sums.where("start < rest").groupBy(*names).agg(F.max_by(F.struct("range", "start"), "range").alias("at")).select(*names, "at.range", "at.start")
    inside = keyed.join(ends, [*names, "range"]).groupBy(*names, "rest", "start", "key").agg(F.sum("n").alias("n"))
    before = Window.partitionBy(*names).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("before", F.col("start") + F.coalesce(F.sum("n").over(before), F.lit(0)))
    last = inside.where("before < rest").groupBy(*names).agg(F.max("key").alias("last"))
    return written(held.join(last, names, "left").select(*names, "tokens", "budget", "epochs", "last"), "mixture"), rows


def taken(seed: int, doc_id: Column) -> Column:
    """How many times a document is taken, beside its leaf's ``epochs`` and ``last``."""
    return (F.col("epochs") + F.when(order_key(seed, F.col("epochs"), doc_id) <= F.col("last"), 1).otherwise(0)).cast("int")


def select(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], seed: int = SEED, id_col: str = "doc_id", **options) -> DataFrame:
    """A row for each document and epoch of the mixture: id, the levels, epoch, tokens."""
    mixture, rows = choose(docs, levels, weights, seed=seed, id_col=id_col, **options)
    got = rows.join(if_small(mixture).drop("tokens", "budget"), list(levels)).withColumn("times", taken(seed, F.col("id"))).where("times > 0")
    epoch = F.explode(F.sequence(F.lit(0), F.col("times") - 1))
    return got.select("id", *levels, epoch.alias("epoch"), F.col("n").alias("tokens"))


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], seed: int = SEED, id_col: str = "doc_id", **options) -> DataFrame:
    """docs as the mixture has them, with docs' columns: a document is repeated for each epoch that takes it."""
    mixture, _ = choose(docs, levels, weights, seed=seed, id_col=id_col, **options)
    columns = docs.columns
    whole = docs.select(F.struct(*[F.col(c) for c in columns]).alias("row"), *[F.coalesce(c.cast("string"), F.lit("")).alias(f"of_{k}") for k, c in levels.items()])
    mixture = mixture.select(*[F.col(k).alias(f"of_{k}") for k in levels], "epochs", "last")
    got = whole.join(if_small(mixture), [f"of_{k}" for k in levels]).withColumn("times", taken(seed, F.col(f"row.{id_col}"))).where("times > 0")
    return got.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
