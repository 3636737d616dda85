"""Connected components of a graph of links, as DataFrame steps (alternating large-star and small-star).

Every step is a partial-aggregated minimum and a join; links go to a written table between rounds, so a lost
executor costs one round's tasks at most; a round's table goes once the next is there. Only whether a round changed anything reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanile.llm.common import discard, written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over (a, b) with b < a: each neighbour is hung on the smallest one."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).hint("rebalance")
    hung = both.join(least, "a")
    if large:
        return hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    moved = hung.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    x = F.xxhash64("a", "b")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.shiftright(x, 20)), F.bit_xor(x)).first())


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(vertex, component) for every vertex of ``links`` (a, b: long); component is the smallest vertex reachable.

    Self-links and repeated links don't matter. Empty links give an empty result.
    """
    now = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    mark = _mark(now)
    for _ in range(rounds):
        if not mark[0]:
            break
        last, now = now, written(_star(_star(now, True), False), "links")
        before, mark = mark, _mark(now)
        discard(last)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("vertex")).distinct()
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(roots.select("vertex", F.col("vertex").alias("component")))
