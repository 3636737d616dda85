"""Seeded samples, shards and top-k; every draw is an order by hash, so it is the same on any cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campanile.operators.jobs import shuffled
from campanile.operators.ranges import ranked


def sample(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    return df.orderBy(shuffled(key, seed), key).limit(n)


def fraction(df: DataFrame, part: float, key: str, seed: int = 42) -> DataFrame:
    """max(1, round(n * part)) rows (half to even); the count is one small aggregate."""
    n = df.count()
    return sample(df, max(1, round(n * part)), key, seed)


def stratified(df: DataFrame, first: str, n: int = 100, most_first: int = 50, key: str = "id", seed: int = 42) -> DataFrame:
    """At most ``most_first`` rows for which the condition ``first`` holds, the rest of n from the others."""
    flagged = df.withColumns({"_first": F.coalesce(F.expr(first), F.lit(False)), "_order": shuffled(key, seed)})
    take = lambda hit, most: flagged.where(hit).orderBy("_order", key).limit(most)  # noqa: E731  a top-k: each task keeps that many
    both = take(F.col("_first"), most_first).unionByName(take(~F.col("_first"), n))
    return both.orderBy(F.desc("_first"), "_order", key).limit(n).drop("_first", "_order")


def shard_by_fractions(df: DataFrame, fractions: Sequence[float], names: Sequence[str], key: str = "orig_index", seed: int = 42) -> DataFrame:
    """df with ``shard``: exact counts round(f * n) in seeded order, the remainder in the last.

    A row's rank is its hash bucket's start plus its place in the bucket, so no task sorts the table.
    """
    if abs(sum(fractions) - 1) > 1e-6:
        raise ValueError("fractions must add up to 1")
    n = df.count()
    ends, at = [], 0
    for f in fractions[:-1]:
        at += round(f * n)
        ends.append(at)
    h = df.withColumn("_h", F.xxhash64(key, F.lit(seed))).withColumn("_b", F.shiftrightunsigned("_h", 52))
    counts = h.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))  # 4096 rows at most
    starts = counts.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    placed = h.join(F.broadcast(starts), "_b").withColumn("_rank", F.col("_start") + F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)))
    shard = F.lit(names[-1])
    for end, name in reversed(list(zip(ends, names, strict=False))):
        shard = F.when(F.col("_rank") <= end, name).otherwise(shard)
    return placed.withColumn("shard", shard).drop("_h", "_b", "_start", "_rank")


def top_per_group(df: DataFrame, by: Sequence[str], value: str, k: int, tie: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc(value), tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_two_stage(df: DataFrame, by: Sequence[str], value: str, k: int, tie: str, kept: int = 5) -> DataFrame:
    """The global top k of each group's top ``kept``: exact only while no group has more than that many of them."""
    return top_per_group(df, by, value, kept, tie).orderBy(F.desc(value), tie).limit(k)


def most_common(df: DataFrame, key: str, k: int) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(k)


def chunked(df: DataFrame, index: str, value: str, size: int) -> DataFrame:
    """Rows with a value, their chunk (by raw row number) and their place among the chunk's written rows, from 0."""
    cut = df.withColumn("chunk", F.floor(F.col(index) / size).cast("long")).where(F.col(value).isNotNull())
    return cut.withColumn("index_in_chunk", F.row_number().over(Window.partitionBy("chunk").orderBy(index)) - 1)


def sessions(df: DataFrame, n: int, order: str, done: DataFrame | None = None) -> DataFrame:
    """What is not done yet, dealt out in n runs of consecutive rows, the first ones a row longer where it doesn't come out even.

    A row's run follows from its rank, which comes from counts of ranges of the order.
    """
    rest = df if done is None else df.join(done, order, "left_anti")
    numbered, rows = ranked(rest, order, "_rank")
    size, more = divmod(rows, n)
    at = F.col("_rank") - 1
    run = F.floor(at / (size + 1))
    if size:
        run = F.when(at < more * (size + 1), run).otherwise(F.lit(more) + F.floor((at - more * (size + 1)) / size))
    return numbered.withColumn("session", (run + 1).cast("int")).drop("_rank")
