"""Exact top-k search by inner product as a Voronoi kNN join.

Components become ``floor(1024 * x)``. Data vectors get one more component that gives all the same norm, queries a zero
and that norm, so the greatest inner product is the nearest neighbour. Pivots (data vectors with the smallest hashes, more of
them for more data) split the space: a data vector belongs to its nearest pivot's cell, a query to a group, that of the nearest of the first
few pivots.

Summaries bound the search. Of each cell, the k + 1 smallest distances to its pivot; of each query, a radius within which k other rows lie for
certain, from those summaries and from its scores against a bounded sample. By the triangle inequality, whatever a group can need lies,
for every pivot, in the range of its queries' distances to that pivot, each widened by the radius: those ranges are the group's summary. A data vector is
sent to the groups whose ranges hold all of its distances, and to no other. A group's data is dealt out in blocks of a counted number, to which only that
group's queries go; blocks are searched exactly, in integers, and the blocks' best are merged.

How many groups there are is what moves the fewest bytes on a bounded sample of queries and data. Where distances are all alike, as for random
directions in many dimensions, the bounds keep everything; then there is one group and no data vector moves twice, but the work is that of comparing all
queries to all rows in blocks. The result is the same.

Equal vectors are searched once: of each, the k + 1 smallest ids are kept, which is all that can show up.

Defined cases: vectors that are null or hold null or non-finite components take no part. A shorter vector is filled up
with zeros. Rows with a null id take no part. Rows that repeat an id and its vector are one; the query's own rows are
those with its id. Ties go to the smaller id. A query without any other row, as in a table of one row, has no result rows; an empty table gives
an empty result. Columns besides the two named are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.llm.common import split_large, written

BLOCK = 20_000
SCALE = 1024
#: Most pivots, rows of the samples that thresholds and the number of groups come from, and numbers of groups that are tried.
PIVOTS, SAMPLED, ASKED, GROUPS = 256, 2048, 512, (1, 2, 4, 8, 16, 32, 64)
#: Room for rounding in distances, relative to the common norm.
SLACK = 1e-6


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v array<long>) of the rows that take part, without repeats."""
    x = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: c.cast("double")).alias("x")).where("id is not null and x is not null")
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(~F.coalesce(odd, F.lit(True))).select("id", F.transform("x", lambda c: F.floor(c * scale)).alias("v")).distinct()


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of integers as rows of a matrix, filled up with zeros."""
    flat, n = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(n), dim), dtype=np.int64)
    out[np.arange(dim) < n[:, None]] = flat
    return out


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squared = (points**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squared, 0))


def _lifted(v: np.ndarray, norm: float) -> np.ndarray:
    x = v.astype(float)
    return np.c_[x, np.sqrt(np.maximum(norm**2 - (x**2).sum(1), 0))]


def _scaled(v: np.ndarray, norm: float) -> np.ndarray:
    x = v.astype(float)
    length = np.sqrt((x**2).sum(1))
    return np.c_[x * np.where(length > 0, norm / np.maximum(length, 1e-300), 0)[:, None], np.zeros(len(x))]


def _over(fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from split_large(batch, fn)

    return run


def as_bytes(rows: DataFrame, dim: int) -> DataFrame:
    """rows (ids, v) with v as the bytes of dim integers."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in _matrix(batch.column(1), dim)], pa.binary())], ["ids", "v"])

    return rows.mapInArrow(_over(one), f"ids {rows.schema['ids'].dataType.simpleString()}, v binary")


def _table(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64).reshape(len(column), dim)


class Space:
    """Pivots (lifted), the common norm, a sample of rows, and of each cell the smallest distances (once for each id)."""

    def __init__(self, pivots: np.ndarray, norm: float, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> None:
        self.pivots, self.norm, self.sample_ids, self.sample, self.k = pivots, norm, sample_ids, sample, k
        self.near: list[list[float]] = []
        self.dim, self.slack = pivots.shape[1] - 1, SLACK * (1 + norm)

    def distances(self, v: np.ndarray, queries: bool) -> np.ndarray:
        return _distances((_scaled if queries else _lifted)(v, self.norm), self.pivots)

    def radii(self, v: np.ndarray, ids: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Of each query a distance within which k other rows lie."""
        out = np.full(len(v), np.inf)
        if sum(map(len, self.near)) > self.k:  # its own row may be one of them
            cell, of = np.concatenate([np.full(len(n), j) for j, n in enumerate(self.near)]).astype(int), np.concatenate([np.asarray(n) for n in self.near])
            for at in range(0, len(v), 256):
                out[at : at + 256] = np.partition(d[at : at + 256, cell] + of, self.k, axis=1)[:, self.k]
        length = np.sqrt((v.astype(float) ** 2).sum(axis=1))
        if len(self.sample) > self.k:
            wide = self.sample.T.astype(float)
            for at in range(0, len(v), 256):
                part = slice(at, at + 256)
                scores = v[part].astype(float) @ wide
                scores[ids[part, None] == self.sample_ids] = -np.inf
                least = np.partition(scores, len(self.sample) - self.k, axis=1)[:, len(self.sample) - self.k]
                with np.errstate(divide="ignore", invalid="ignore"):
                    squared = 2 * self.norm**2 - 2 * self.norm / length[part] * least
                found = np.where((length[part] > 0) & np.isfinite(least), np.sqrt(np.maximum(squared, 0)), np.inf)
                out[part] = np.minimum(out[part], found)
        return out + self.slack


def ranges(d: np.ndarray, radius: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) [group, pivot]: where the distances of what a group can need lie; empty without queries."""
    low, high = np.full((groups, d.shape[1]), np.inf), np.full((groups, d.shape[1]), -np.inf)
    np.minimum.at(low, group, d - radius[:, None])
    np.maximum.at(high, group, d + radius[:, None])
    return low, high


def needed(d: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """[row, group]: whether a group can need a row with such distances to the pivots."""
    return np.stack([((a <= d) & (d <= b)).all(axis=1) for a, b in zip(low, high, strict=True)], axis=1)


def best_groups(space: Space, queries: np.ndarray, ids: np.ndarray, asked: int, rows: int, block: int) -> int:
    """The number of groups that moves the fewest rows, by samples of queries and data."""
    d = space.distances(queries, True)
    radius, there = space.radii(queries, ids, d), space.distances(space.sample, False)

    def moved(groups: int) -> float:
        group = d[:, :groups].argmin(axis=1)
        share = needed(there, *ranges(d, radius, group, groups)).mean(axis=0)
        mine = np.bincount(group, minlength=groups) / len(group)
        return float(share.sum() * rows + (mine * asked * np.ceil(share * rows / block)).sum())

    # a group's ranges can't be told from a few of its queries
    return min((g for g in GROUPS if g == 1 or g <= min(len(space.pivots), len(queries) // 32)), key=lambda g: (moved(g), g))


def smallest_distances(data: DataFrame, space: Space) -> list[list[float]]:
    """Of each cell the k + 1 smallest distances, once for each id: each task passes on that many of a cell."""
    k, cells = space.k, len(space.pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[float]] = [[] for _ in range(cells)]
        for batch in batches:
            if not batch.num_rows:
                continue
            d = space.distances(_table(batch.column(1), space.dim), False)
            cell, own, times = d.argmin(axis=1), d.min(axis=1), batch.column(0).value_lengths().to_numpy()
            for j in np.unique(cell).tolist():
                at = np.flatnonzero(cell == j)
                held[j] = sorted(held[j] + np.repeat(own[at], times[at]).tolist())[: k + 1]
        pairs = [(j, x) for j, xs in enumerate(held) for x in xs]
        yield pa.RecordBatch.from_arrays([pa.array([j for j, _ in pairs], pa.int32()), pa.array([x for _, x in pairs], pa.float64())], ["cell", "d"])

    out: list[list[float]] = [[] for _ in range(cells)]
    merged = data.mapInArrow(run, "cell int, d double").groupBy("cell").agg(F.slice(F.array_sort(F.collect_list("d")), 1, k + 1).alias("d"))
    for r in merged.collect():  # a row for each pivot
        out[r.cell] = list(r.d)
    return out


def group_ranges(queries: DataFrame, space: Space, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups' summaries, from every query (grp, id, v): a row for each group and pivot reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full((groups, len(space.pivots)), np.inf), np.full((groups, len(space.pivots)), -np.inf)
        for batch in batches:
            if batch.num_rows:
                v = _table(batch.column(2), space.dim)
                d = space.distances(v, True)
                a, b = ranges(d, space.radii(v, batch.column(1).to_numpy(), d), batch.column(0).to_numpy(), groups)
                low, high = np.minimum(low, a), np.maximum(high, b)
        g, j = np.nonzero(low <= high)
        yield pa.RecordBatch.from_arrays([pa.array(g.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(low[g, j]), pa.array(high[g, j])], ["grp", "pivot", "low", "high"])

    low, high = np.full((groups, len(space.pivots)), np.inf), np.full((groups, len(space.pivots)), -np.inf)
    every = queries.select("grp", "id", "v").mapInArrow(run, "grp int, pivot int, low double, high double").groupBy("grp", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    for r in every.collect():
        low[r.grp, r.pivot], high[r.grp, r.pivot] = r.low, r.high
    return low, high


def with_groups(queries: DataFrame, space: Space, groups: int) -> DataFrame:
    """(grp, id, v): the nearest of the first pivots."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        d = _distances(_scaled(_table(batch.column(1), space.dim), space.norm), space.pivots[:groups])
        return pa.RecordBatch.from_arrays([pa.array(d.argmin(axis=1).astype(np.int32)), batch.column(0), batch.column(1)], ["grp", "id", "v"])

    return queries.mapInArrow(_over(one), "grp int, id long, v binary")


def summaries(queries: DataFrame, data: DataFrame, space: Space, groups: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(low, high) of so many groups, and how many data vectors each needs."""
    low, high = group_ranges(with_groups(queries, space, groups), space, groups)
    return low, high, needed_rows(data, space, low, high)


def needed_rows(data: DataFrame, space: Space, low: np.ndarray, high: np.ndarray) -> list[int]:
    """How many data vectors each group needs."""
    groups = len(low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(groups, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                n += needed(space.distances(_table(batch.column(1), space.dim), False), low, high).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(groups, dtype=np.int32)), pa.array(n)], ["grp", "n"])

    out = [0] * groups
    for r in data.mapInArrow(run, "grp int, n long").groupBy("grp").agg(F.sum("n").alias("n")).collect():
        out[r.grp] = r.n
    return out


def sent_to_groups(data: DataFrame, space: Space, low: np.ndarray, high: np.ndarray, blocks: list[int]) -> DataFrame:
    """(grp, block, ids, v): each data vector once for each group that needs it."""
    of = np.maximum(np.array(blocks, dtype=np.int64), 1)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, group = np.nonzero(needed(space.distances(_table(batch.column(1), space.dim), False), low, high))
        at, block = pa.array(row), batch.column(2).to_numpy()[row] % of[group]
        return pa.RecordBatch.from_arrays([pa.array(group.astype(np.int32)), pa.array(block.astype(np.int32)), batch.column(0).take(at), batch.column(1).take(at)], ["grp", "block", "ids", "v"])

    dealt = data.withColumn("h", F.shiftrightunsigned(F.xxhash64("v"), 1))
    return dealt.mapInArrow(_over(one), "grp int, block int, ids array<long>, v binary")


def best_of_block(queries: np.ndarray, own: np.ndarray, data: np.ndarray, ids: list[np.ndarray], k: int) -> tuple[list, list, list]:
    """(query id, id, score) of each query's k best rows in a block of distinct vectors."""
    out: tuple[list, list, list] = ([], [], [])
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(1, queries.shape[1])
    exact = largest < 2**53
    wide = data.T.astype(float) if exact else data.T
    for at in range(0, len(queries), 256):
        part = queries[at : at + 256]
        scores = (part.astype(float) if exact else part) @ wide
        for q, row in zip(own[at : at + 256], scores, strict=True):
            least = np.partition(row, len(row) - k - 1)[len(row) - k - 1] if len(row) > k + 1 else row.min()
            hit = np.flatnonzero(row >= least)
            found = np.concatenate([ids[h] for h in hit])
            score = np.repeat(row[hit], [len(ids[h]) for h in hit]).astype(np.int64)
            other = found != q
            found, score = found[other], score[other]
            order = np.lexsort((found, -score))[:k]
            out[0].append(np.full(len(order), q))
            out[1].append(found[order])
            out[2].append(score[order])
    return out


def search(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, pivots: int | None = None, scale: int = SCALE
) -> DataFrame:
    """(query_id, rank, id, score): the k best other rows of each row for which is_query (over the column ``id``) holds."""
    spark = vectors.sparkSession
    rows = written(quantised(vectors, id_col, vector_col, scale), "vectors")
    queries = rows.where(is_query)
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    size = rows.agg(F.max(F.size("v")).alias("dim"), F.max(square).alias("square"), F.count(F.lit(1)).alias("n")).first()
    result = "query_id long, id long, score long"
    if not size["n"] or not (asked := queries.count()):
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    dim, norm = max(1, size["dim"]), float(np.sqrt(size["square"]))
    same = rows.withColumn("h", F.xxhash64("v"))  # sorted by the hash first, by the vector only where hashes are equal
    of_same = Window.partitionBy("h", "v").orderBy("id")
    data = same.withColumn("rank", F.row_number().over(of_same)).where(F.col("rank") <= k + 1).groupBy("h", "v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    data = written(as_bytes(data.select("ids", "v"), dim), "cells")
    queries = written(as_bytes(queries.select(F.col("id").alias("ids"), "v"), dim).withColumnRenamed("ids", "id"), "queries")
    some = lambda df, n: df.orderBy(F.xxhash64("v", "id"), "v", "id").limit(n).collect()  # noqa: E731  bounded samples
    count = pivots or min(PIVOTS, max(4, math.isqrt(size["n"]) // 4))
    chosen = [r.v for r in data.select("v").orderBy(F.xxhash64("v"), "v").limit(count).collect()]
    table = lambda vs: np.frombuffer(b"".join(vs), dtype=np.int64).reshape(len(vs), dim)
    sample, asking = some(data.select("v", F.col("ids")[0].alias("id")), SAMPLED), some(queries, ASKED)
    space = Space(_lifted(table(chosen), norm), norm, np.array([r.id for r in sample], dtype=np.int64), table([r.v for r in sample]), k)
    space.near = smallest_distances(data, space)
    groups = best_groups(space, table([r.v for r in asking]), np.array([r.id for r in asking], dtype=np.int64), asked, size["n"], block)

    queries = queries.select("id", "v")
    low, high, need = summaries(queries, data, space, groups)
    if groups > 1 and sum(need) + asked * max(-(-n // block) for n in need) > size["n"] + asked * -(-size["n"] // block):
        groups = 1  # all queries' ranges are wider than the sample's were
        low, high, need = summaries(queries, data, space, groups)
    queries = with_groups(queries, space, groups)
    blocks = [-(-n // block) for n in need]
    sent = sent_to_groups(data, space, low, high, blocks)
    # a query goes to the blocks of its own group and to no other
    of_group = F.element_at(F.array(*[F.lit(n) for n in blocks]), F.col("grp") + 1)
    asking = queries.withColumn("blocks", of_group).where("blocks > 0").select("grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "v")

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": [], "id": [], "score": []}, dtype=np.int64)
        got = best_of_block(table(q["v"]), q["id"].to_numpy(), table(x["v"]), [np.asarray(i) for i in x["ids"]], k)
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(("query_id", "id", "score"), got, strict=True)})

    found = asking.groupBy("grp", "block").cogroup(sent.groupBy("grp", "block")).applyInPandas(solve, result)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
