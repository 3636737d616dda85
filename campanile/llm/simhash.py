"""SimHash near-duplicates: segment-popcount embedding and a grid range-join under Manhattan distance.

A 64-bit fingerprint is embedded as the bit counts of its 32 two-bit segments. Flipping one bit changes one
count by one, so the Manhattan distance of two embeddings is a lower bound of the Hamming distance. The counts
(0, 1, 2) are held in thermometer code, in which Manhattan distance is the popcount of an exclusive or.

The range join lays a grid over groups of segments: of g groups, two embeddings within distance d agree exactly
in g - d or more. So every choice of g - d groups makes a grid whose cells are the equal counts there, and any
two fingerprints in range share a cell of some grid. g is the number that makes the expected work least for the
number of fingerprints; every g finds the same links. In a cell, the lower bound prunes and the fingerprints
decide.

A cell yields a spanning forest of its links, never all pairs: a pivot takes all within range at once, and two
pivots' groups are compared only if the triangle inequality allows a link and none is known yet. A cell of more
than ``cell_rows`` is dealt out as pairs of blocks, so one hot cell never lands in one task.

``near_duplicates`` links fingerprints of word shingles within so many bits, and misses none. ``near_copies`` links every two
texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, and misses none either. That is further than
a grid can reach, so fingerprints come first and the sets themselves follow: two-word fingerprints within ``DISTANCE`` bits are
links if 256 bits of a fingerprint over the set differ in ``WIDE`` at most, and classes of these need no comparing inside; then a
join over the sets finds all links between classes (see ``_similar``). Shingles and sets stand for their 64-bit hashes.

Defined cases: a null text counts as empty; a text without words has fingerprint zero and is linked like any
other; fewer words than a shingle make one shingle; texts of any length are read whole. Rows with a null id are linked
like others, but name no component: the component of such rows alone is null, and none of them is dropped. A row's vertex is its
fingerprint, so rows that repeat an id with another text are rows of their own, and rows that repeat both are treated
alike: all stay or all go. Other columns, whatever their names, are passed on untouched. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.llm.common import if_small, map_arrow, split_large, written
from campanile.llm.components import components

SHINGLE = 4
DISTANCE = 4
CELL_ROWS = 50_000
SEGMENTS = 32
#: Collision entropy of the bit count of two random bits: 1/16 + 1/4 + 1/16.
SEGMENT_BITS = -math.log2(0.375)
EVEN = 0x5555555555555555
_CHUNK = 1 << 16
#: Of near copies: bits of the 256 over the five-word shingles that a link by fingerprints may differ in. Tests hold links of the small texts to FAR bits.
WIDE, FAR = 44, 10
#: Of searches in several partitions of the segments: what may be missed of pairs that lie further apart than a grid's distance.
MISS = 0.11
_WORDS = ("w0", "w1", "w2", "w3")
_BITS_OF = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(float)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text: lower-cased A-Z, words between ASCII white space, XXH64 with seed 42."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = [0, *ends[: len(words) - shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    n, counts = len(starts), np.zeros(64)
    for at in range(0, n, _CHUNK):
        h = np.fromiter((xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK], strict=True)), dtype="<u8")
        counts += bit_counts(h)
    return int(_majority(counts, n)[0])


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the bits set; h: one 64-bit word or more in a row."""
    octets = h.astype("<u8", copy=False).view(np.uint8).reshape(len(h), -1)
    wide = octets.shape[1]
    if len(h) < 64:
        return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    held = np.bincount((octets + np.arange(0, 256 * wide, 256)).ravel(), minlength=256 * wide).reshape(wide, 256)
    return (held.astype(float) @ _BITS_OF).ravel()


def _majority(counts: np.ndarray, n: int) -> np.ndarray:
    return np.packbits(2 * counts > n, bitorder="little").view("<u8")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (fixed values: the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """XXH64 of words, kept for the last ``keep`` new words."""

    def __init__(self, keep: int = 1 << 17) -> None:
        self.kept: dict[bytes, int] = {}
        self.keep = keep

    def of(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh64_intdigest

        kept = self.kept
        if len(kept) > self.keep:
            kept.clear()
        for w in set(words).difference(kept):
            kept[w] = xxh64_intdigest(w, 42)
        return np.fromiter(map(kept.__getitem__, words), dtype=np.uint64, count=len(words))


#: Odd multipliers of a shingle's words, by place, and what tells the four wide words apart (fixed values of a seeded generator).
_PLACES = np.random.default_rng(5).integers(1 << 63, size=8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = np.random.default_rng(6).integers(1 << 63, size=len(_WORDS), dtype=np.uint64)


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words; fewer words make one run."""
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        out += words[k : len(words) - size + 1 + k] * _PLACES[k]
    return _mixed(out)


def shingle_set(text: bytes, hashes: WordHashes) -> np.ndarray:
    """The set of five-word shingles: their hashes, sorted; fewer words make one shingle, none an empty set."""
    words = text.lower().split()
    return np.unique(_shingles(hashes.of(words), 5)) if words else np.zeros(0, dtype=np.uint64)


def set_hash(five: np.ndarray) -> int:
    """The hash of a sorted set, as a signed long."""
    from xxhash import xxh64_intdigest

    got = xxh64_intdigest(five.tobytes(), 42)
    return got - (1 << 64) if got >= 1 << 63 else got


def sketch(text: bytes, hashes: WordHashes) -> np.ndarray:
    """The fingerprint of two-word shingles, repeats included, and four of the set of five-word shingles."""
    return _sketch_and_set(text, hashes)[0]


def _sketch_and_set(text: bytes, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    words = text.lower().split()
    if not words:
        return np.zeros(1 + len(_WORDS), dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    known = hashes.of(words)
    two, five = _shingles(known, 2), np.unique(_shingles(known, 5))
    counts = sum((bit_counts(_mixed(five[at : at + _CHUNK, None] ^ _SALTS)) for at in range(0, len(five), _CHUNK)), np.zeros(64 * len(_WORDS)))
    return np.r_[_majority(bit_counts(two), len(two)), _majority(counts, len(five))], five


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, of_text, fp, w0 ... w3, whole) for each row; of_text is a hash of the text, whole one of its set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps, wholes = [], []
            for t in batch.column(2).cast(pa.large_binary()).to_pylist():
                fp, five = _sketch_and_set(t, hashes)
                fps.append(fp)
                wholes.append(set_hash(five))
            got = np.stack(fps).view(np.int64)
            columns = [*(pa.array(np.ascontiguousarray(got[:, k])) for k in range(5)), pa.array(wholes, pa.int64())]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "of_text", "fp", *_WORDS, "whole"])

        for batch in batches:
            if batch.num_rows:
                yield from split_large(batch, one)

    return _keyed(docs, id_col, text_col).mapInArrow(run, "id long, of_text long, fp long, " + ", ".join(f"{w} long" for w in _WORDS) + ", whole long")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("of_text"), text.alias("text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, of_text, fp) for each row; fp is the fingerprint as a signed long, of_text a hash of the text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(2).cast(pa.large_binary()).to_pylist()
        fp = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts)).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], ["id", "of_text", "fp"])

    return map_arrow(_keyed(docs, id_col, text_col), run, "id long, of_text long, fp long")


def thermometer(fp: Column) -> Column:
    """The embedding: of each two-bit segment, whether it holds a bit at all (low) and two (high)."""
    high = F.shiftrightunsigned(fp, 1)
    low, full = fp.bitwiseOR(high).bitwiseAND(F.lit(EVEN)), fp.bitwiseAND(high).bitwiseAND(F.lit(EVEN))
    return low.bitwiseOR(F.shiftleft(full, 1))


def grids(groups: int, distance: int = DISTANCE, partitions: int = 1) -> list[int]:
    """Masks of the choices of ``groups - distance`` of the groups, as signed longs; each partition groups the segments anew."""
    edges = [round(i * SEGMENTS / groups) for i in range(groups + 1)]
    out = []
    for r in range(partitions):
        order = list(range(SEGMENTS))
        if r:
            random.Random(r).shuffle(order)
        masks = [sum(3 << 2 * s for s in order[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        out += [sum(m) for m in combinations(masks, groups - distance)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in out]


def chance(groups: int, distance: int, bits: int) -> float:
    """That a pair ``bits`` apart shares a cell of some grid: its bits fall into at most ``distance`` of the groups."""
    touched = np.zeros(groups + 1)
    touched[0] = 1
    for _ in range(bits):
        j = np.arange(groups + 1)
        touched = touched * j / groups + np.r_[0, touched[:-1] * (groups - j[:-1]) / groups]
    return float(touched[: distance + 1].sum())


def partitions_for(groups: int, distance: int, typical: int, miss: float) -> int:
    """Partitions of the segments, so that a pair ``typical`` bits apart is missed with a chance of ``miss`` at most."""
    found = chance(groups, distance, typical)
    return 1 if found >= 1 - miss else math.ceil(math.log(miss) / math.log1p(-found))


def best_groups(rows: int, distance: int = DISTANCE, row_cost: float = 400.0, typical: int = 0, miss: float = MISS) -> int:
    """The number of groups with the least expected work; row_cost: of a row in a cell, in comparisons."""

    def work(g: int) -> float:
        tables = math.comb(g, distance) * partitions_for(g, distance, typical, miss)
        return tables * rows * (row_cost + rows / 2 / 2 ** (SEGMENT_BITS * SEGMENTS * (g - distance) / g))

    return min(range(distance + 1, 2 * distance + 5), key=work)


def _count(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _codes(fp: np.ndarray) -> np.ndarray:
    even = np.uint64(EVEN)
    high = fp >> np.uint64(1)
    return ((fp | high) & even) | ((fp & high & even) << np.uint64(1))


_AT_ONCE = 1 << 21
_TRIED = 64


class _Rows:
    """Rows of a cell: fingerprints, their embedding, and wide fingerprints if those decide too."""

    def __init__(self, fp: np.ndarray, distance: int, wide: np.ndarray | None = None, wide_distance: int = 0) -> None:
        self.fp, self.code, self.distance, self.wide, self.wide_distance = fp, _codes(fp), distance, wide, wide_distance

    def linked(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of pairs within the lower bound, whether they are linked."""
        out = _count(self.fp[i] ^ self.fp[j]) <= self.distance
        if self.wide is not None:
            at = np.flatnonzero(out)
            i, j = np.broadcast_to(i, out.shape)[at], np.broadcast_to(j, out.shape)[at]
            out[at] = _count(self.wide[i] ^ self.wide[j]).sum(axis=1, dtype=np.int64) <= self.wide_distance
        return out

    def near(self, i: int, j: np.ndarray) -> np.ndarray:
        """Those of the rows j that are linked to i."""
        j = j[_count(self.code[j] ^ self.code[i]) <= self.distance]
        return j[self.linked(np.full(len(j), i), j)]

    def pairs(self, one: np.ndarray, two: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Linked pairs of a row of one and a row of two, a block at a time."""
        step = max(1, _AT_ONCE // max(1, len(two)))
        for at in range(0, len(one), step):
            i, j = np.nonzero(_count(self.code[one[at : at + step]][:, None] ^ self.code[two]) <= self.distance)
            i, j = one[at + i], two[j]
            hit = self.linked(i, j)
            yield i[hit], j[hit]


def _neighbours(rows: _Rows, some: np.ndarray) -> np.ndarray:
    """Of each of some rows whether another one is linked to it; a block of rows against all at a time."""
    out = np.zeros(len(rows.fp), dtype=bool)
    for i, j in rows.pairs(some, np.arange(len(rows.fp))):
        out[i[i != j]] = True
    return out[some]


def link_cell(rows: _Rows) -> list[tuple[int, int]]:
    """Positions of links that connect whatever is linked in one cell: at most one less than there are rows.

    Where a few rows tried show that most have no neighbour at all, those without one are found in blocks first.
    """
    rest, alive, pivots, groups, links = np.arange(len(rows.fp)), np.ones(len(rows.fp), dtype=bool), [], [], []
    tried = rest[:: max(1, len(rest) // _TRIED)]
    if _neighbours(rows, tried).mean() < 0.5:
        rest = rest[_neighbours(rows, rest)]
    while len(rest):
        p = rest[0]
        group = rows.near(p, rest)
        links += [(int(p), int(q)) for q in group[group != p]]
        pivots.append(p)
        groups.append(group)
        alive[group] = False
        rest = rest[alive[rest]]
    centres, sizes = rows.fp[np.array(pivots, dtype=np.int64)], np.array([len(g) for g in groups])
    part = np.arange(len(pivots))  # which groups are known to be linked
    of_row = np.zeros(len(rows.fp), dtype=np.int64)
    for i, group in enumerate(groups):
        of_row[group] = i
    for i, group in enumerate(groups):
        reach = (part != part[i]) & ((sizes > 1) | (sizes[i] > 1))
        reach[: i + 1] = False
        at = np.flatnonzero(reach)
        at = at[_count(centres[at] ^ centres[i]) <= 3 * rows.distance]
        together = len(group) * sizes[at].sum() <= _AT_ONCE
        blocks = [groups[j] for j in at]
        for others in [np.concatenate(blocks)] if together and blocks else blocks:
            if not together and part[of_row[others[0]]] == part[i]:
                continue
            for a, b in rows.pairs(group, others):
                of, first = np.unique(of_row[b], return_index=True)
                for j, k in zip(of.tolist(), first.tolist(), strict=True):
                    if part[j] != part[i]:
                        links.append((int(a[k]), int(b[k])))
                        part[part == part[j]] = part[i]
                if len(of) and not together:
                    break
    return links


_SMALL = 48


def _links_of(cells: np.ndarray, ids: np.ndarray, every: _Rows) -> tuple[list, list]:
    """Links in sorted cells; small cells are compared all at once, row against the k-th next."""
    a, b = [], []
    starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    sizes = np.diff(np.r_[starts, len(cells)])
    size_of = np.repeat(sizes, sizes)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(cells))  # rows up to the cell's end
    for k in range(1, min(_SMALL, int(sizes.max(initial=1)) - 1) + 1):
        at = np.flatnonzero((left > k) & (size_of <= _SMALL))
        at = at[_count(every.code[at] ^ every.code[at + k]) <= every.distance]
        at = at[every.linked(at, at + k)]
        a.append(ids[at])
        b.append(ids[at + k])
    for s, n in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL], strict=True):
        cell = _Rows(every.fp[s : s + n], every.distance, None if every.wide is None else every.wide[s : s + n], every.wide_distance)
        if found := link_cell(cell):
            one, two = np.array(found, dtype=np.int64).T
            a.append(ids[s + one])
            b.append(ids[s + two])
    return a, b


def _stream(distance: int, wide_distance: int | None):
    """Over batches sorted by cell (grid, key, part): links of every cell; a cell may span batches."""

    def emit(cell: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        grid, key, part, ids, fp = cell[:5]
        both = np.zeros(len(key), dtype=[("g", np.int64), ("k", np.int64), ("p", np.int64)])
        both["g"], both["k"], both["p"] = grid, key, part
        number = np.cumsum(np.r_[False, both[1:] != both[:-1]])
        wide = None if wide_distance is None else np.stack(cell[5:], axis=1).view(np.uint64)
        a, b = _links_of(number, ids, _Rows(fp.view(np.uint64), distance, wide, wide_distance or 0))
        if a := [x for x in a if len(x)]:
            b = [x for x in b if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = [np.concatenate(x) for x in zip(held, new, strict=True)] if held else new
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1]) & (held[2] == held[2][-1])
            cut = len(last) - int(last[::-1].argmin()) if not last.all() else 0
            if cut:
                yield from emit([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held:
            yield from emit(held)

    return run


def _in_parts(cells: DataFrame, key: list[str], row: str, cell_rows: int) -> DataFrame:
    """cells with a column part: those of more than cell_rows rows are dealt out as pairs of blocks, so that any two rows meet in a part."""
    hot = written(cells.groupBy(*key).count().where(F.col("count") > cell_rows), "hot-cells")
    many = hot.count()
    if many:
        blocks = hot.select(*key, F.ceil(F.col("count") / F.lit(cell_rows)).cast("int").alias("blocks"))
        # at most 1 row for each cell_rows rows in cells: broadcast only while that is small
        cells = cells.join(F.broadcast(blocks) if many <= 10_000 else blocks, key, "left")
        own = F.pmod(F.xxhash64(row), F.coalesce("blocks", F.lit(1))).cast("int")
        pair = lambda j: (F.least(own, j) * F.lit(1 << 20) + F.greatest(own, j)).cast("long")
        parts = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
            F.transform(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1), pair)
        )
        return cells.withColumn("part", F.explode(parts))
    return cells.withColumn("part", F.lit(0).cast("long"))


def links(
    points: DataFrame, distance: int = DISTANCE, masks: Sequence[int] = (), cell_rows: int = CELL_ROWS, wide: Sequence[str] = (), wide_distance: int | None = None
) -> DataFrame:
    """(a, b): links between the vertices of points (vertex long, fp long, distinct fps) that connect all within distance.

    masks: the grids; default: those that miss nothing. wide: columns of a wide fingerprint that must be within wide_distance too.
    """
    rows = points.count()
    masks = masks or grids(best_groups(rows, distance), distance)
    held = points.withColumn("code", thermometer(F.col("fp")))
    cells = held.select(F.posexplode(F.array(*[F.col("code").bitwiseAND(F.lit(m)) for m in masks])).alias("grid", "key"), "vertex", "fp", *wide)
    cells = _in_parts(cells, ["grid", "key"], "vertex", cell_rows)
    cells = cells.select(F.col("grid").cast("long").alias("grid"), "key", "part", "vertex", "fp", *wide)
    # few bytes, much work: dealt out by rows, not by size
    tasks = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows * len(masks) // 100_000)
    dealt = cells.repartition(tasks, "grid", "key", "part").sortWithinPartitions("grid", "key", "part")
    return dealt.mapInArrow(_stream(distance, wide_distance), "a long, b long")


def _classes(points: DataFrame, linked: DataFrame) -> DataFrame:
    """points (vertex, first: the struct (id, of_text) that comes first) with first of the whole component, nulls last."""
    grouped = components(linked)
    of = points.select("vertex", "first").join(grouped, "vertex")
    least = of.where("first is not null").groupBy("component").agg(F.min("first").alias("kept")).hint("rebalance")
    kept = written(of.select("vertex", "component").join(least, "component", "left").select("vertex", "kept"), "components")
    return points.join(kept, "vertex", "left").withColumn("kept", F.coalesce("kept", "first"))


def _first() -> Column:
    """Of rows with a fingerprint, the id and text that come first; null where none has an id."""
    return F.min(F.when(F.col("id").isNotNull(), F.struct("id", "of_text"))).alias("first")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """A row for each row of docs: id, of_text, fp, component (smallest id reachable over links of at most distance bits), kept.

    kept is the struct (id, of_text) of the row that stands for the component.
    """
    marked = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    points = written(marked.groupBy("fp").agg(_first()).withColumn("vertex", F.col("fp")), "points")
    of_fp = written(_classes(points, links(points, distance, cell_rows=cell_rows)).select("fp", "kept"), "classes")
    return marked.join(of_fp, "fp", "left").select("id", "of_text", "fp", F.col("kept.id").alias("component"), "kept")


def _hash_rows(docs: DataFrame, id_col: str, text_col: str, whole_sets: bool) -> DataFrame:
    """Sets of shingles: (whole, size, held), the hashes in an array, or (h, whole, size) for each of the first hashes only.

    First are the smallest floor(size / 5) + max(1, floor(size / 10)). Sets a task has seen lately are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            if len(seen) > _CHUNK:
                seen.clear()
            wholes, kept, sizes = [], [], []
            for t in batch.column(0).cast(pa.large_binary()).to_pylist():
                five = shingle_set(t, hashes)
                if (whole := set_hash(five)) in seen:
                    continue
                seen.add(whole)
                wholes.append(whole)
                sizes.append(len(five))
                kept.append((five if whole_sets else five[: len(five) // 5 + max(1, len(five) // 10)]).view(np.int64))
            flat = np.concatenate([np.zeros(0, dtype=np.int64), *kept])
            many = np.array([len(x) for x in kept], dtype=np.int64)
            whole, size = np.array(wholes, dtype=np.int64), np.array(sizes, dtype=np.int64)
            if whole_sets:
                held = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)].astype(np.int32)), pa.array(flat))
                return pa.RecordBatch.from_arrays([pa.array(whole), pa.array(size), held], ["whole", "size", "held"])
            return pa.RecordBatch.from_arrays([pa.array(flat), pa.array(np.repeat(whole, many)), pa.array(np.repeat(size, many))], ["h", "whole", "size"])

        for batch in batches:
            if batch.num_rows:
                yield from split_large(batch, one)

    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "whole long, size long, held array<long>" if whole_sets else "h long, whole long, size long")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (h, whole, size) sorted by h and whole: a row (whole, size) for each hash that another set has too."""
    last, met = None, False  # the last row, not yet passed on, and whether it is known to go with one before
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if last:
            rows = [np.r_[x, y] for x, y in zip(last, rows, strict=True)]
        fresh = np.r_[True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])]
        h, whole, size = (x[fresh] for x in rows)
        same = h[1:] == h[:-1]
        out = np.r_[met, same] | np.r_[same, False]
        last, met = [h[-1:], whole[-1:], size[-1:]], bool(out[-1])
        at = np.flatnonzero(out[:-1])
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(whole[at]), pa.array(size[at])], ["whole", "size"])
    if met:
        yield pa.RecordBatch.from_arrays([pa.array(last[1]), pa.array(last[2])], ["whole", "size"])


def _sets_alike(docs: DataFrame, marked: DataFrame, reps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(whole, size, held): the sets of which so many first hashes occur in other sets that one of them can be similar."""
    first = _hash_rows(docs, id_col, text_col, False)
    met = first.repartition("h").sortWithinPartitions("h", "whole").mapInArrow(_met, "whole long, size long")
    enough = F.expr("greatest(1, ((4 * size + 4) div 5) div 10)")
    some = met.groupBy("whole").agg(F.count(F.lit(1)).alias("shared"), F.max("size").alias("size")).where(F.col("shared") >= enough).select("whole")
    texts = written(marked.select("whole", "of_text").join(some, "whole", "left_semi").groupBy("whole").agg(F.min("of_text").alias("of_text")), "alike")
    few = if_small(texts.select("of_text").distinct())
    found = _keyed(docs, id_col, text_col).join(few, "of_text", "left_semi")
    sets = written(_hash_rows(found, "id", "text", True), "sets")
    if sets.count() == texts.count():
        return sets
    return written(sets.groupBy("whole").agg(F.first("size").alias("size"), F.first("held").alias("held")), "sets")


_BEFORE = ("before0", "before1", "before2", "before3")


def _cells(sets: DataFrame) -> DataFrame:
    """(h, whole, size, rest, before0 ...): cells of sets with a hash in common, such that similar sets share a cell.

    rest: how many of a set's hashes that others have come from h on; before: the hashes of its cells just before h (the set's own where there is none).
    """
    each = sets.select("whole", "size", F.explode("held").alias("h"))
    each = each.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("h"))).where("df > 1")
    of = Window.partitionBy("whole")
    each = each.withColumn("shared", F.count(F.lit(1)).over(of)).where("5 * shared >= 4 * size")
    each = each.withColumn("place", F.row_number().over(of.orderBy("df", "h"))).where("place <= shared - (4 * size + 4) div 5 + 1")
    before = [F.coalesce(F.lag("h", n + 1).over(of.orderBy("df", "h")), "whole").alias(c) for n, c in enumerate(_BEFORE)]
    return written(each.select("h", "whole", "size", (F.col("shared") - F.col("place") + 1).alias("rest"), *before), "cells")


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (h, part, whole, size, rest, class, before ...) sorted by h and part: pairs (a, b) of a cell that are of two classes and can be similar.

    Sets that have one of the hashes before in common meet in its cell too, and are left to that.
    """

    def pairs(cell: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        _, _, whole, size, rest, of, *before = cell
        if (of == of[0]).all():
            return
        classes, inverse, counts = np.unique(of, return_inverse=True, return_counts=True)
        order = np.argsort(inverse == counts.argmax(), kind="stable")  # the largest class comes last
        whole, size, rest, of, before = whole[order], size[order], rest[order], inverse[order], [x[order] for x in before]
        others = len(of) - int(counts.max())
        step = max(1, _AT_ONCE // len(of))
        for at in range(0, others, step):
            i = np.arange(at, min(others, at + step))
            hit = (of[i][:, None] != of) & (9 * np.minimum(rest[i][:, None], rest) >= 4 * (size[i][:, None] + size))
            one, two = np.nonzero(hit)
            one += at
            one, two = one[one < two], two[one < two]
            for x in before:
                for y in before:
                    new = x[one] != y[two]
                    one, two = one[new], two[new]
            if len(one):
                a, b = np.minimum(whole[one], whole[two]), np.maximum(whole[one], whole[two])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        edges = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1
        for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(rows[0])], strict=True):
            new = [x[s:e] for x in rows]
            if held and (held[0][0][0] != new[0][0] or held[0][1][0] != new[1][0]):
                yield from pairs([np.concatenate(x) for x in zip(*held, strict=True)])
                held = []
            held.append(new)
    if held:
        yield from pairs([np.concatenate(x) for x in zip(*held, strict=True)])


def _verified(pairs: DataFrame, sets: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b): of pairs of sets those with a similarity of 0.8 or more, as the vertices that stand for the sets."""
    pairs = written(pairs, "pairs")
    ends = if_small(written(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "whole"), "ends"))
    some = sets.join(ends, "whole", "left_semi")
    one = some.select(F.col("whole").alias("a"), F.col("size").alias("size_a"), F.col("held").alias("held_a"))
    two = some.select(F.col("whole").alias("b"), F.col("size").alias("size_b"), F.col("held").alias("held_b"))
    both = pairs.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("held_a", "held_b")))
    good = written(both.where("9 * common >= 4 * (size_a + size_b)").select(F.col("a").alias("whole_a"), F.col("b").alias("whole_b")), "similar")
    a, b = reps.select(F.col("whole").alias("whole_a"), F.col("vertex").alias("a")), reps.select(F.col("whole").alias("whole_b"), F.col("vertex").alias("b"))
    return good.join(a, "whole_a").join(b, "whole_b").select("a", "b")


def _similar(docs: DataFrame, marked: DataFrame, points: DataFrame, linked: DataFrame, id_col: str, text_col: str, cell_rows: int) -> DataFrame:
    """Links (a, b) between vertices of points that, with those in linked, connect all sets with a Jaccard similarity of 0.8 or more.

    Sets of a and b hashes are that similar if 9 times the common ones are 4 (a + b) or more. So 0.8 of the larger set are common, and in any
    one order of all hashes the first common one is among the first a - 0.8 a + 1 of either set; the first n common ones are among n - 1 more. By
    this, a few tenths of the hashes, in order of their value, tell which sets can't be similar to any other (most). The rest are ordered by
    the number of sets that have a hash, rarest first, and meet in cells by hash; at their first common one, what follows must suffice. A pair is compared only if its sets are of two classes
    of what is linked so far: first every set with the first and the last of its cell, then all that are still of two classes.
    """
    reps = written(points.groupBy("whole").agg(F.min("vertex").alias("vertex")), "reps")
    same = points.select("vertex", "whole").join(reps.withColumnRenamed("vertex", "b"), "whole").where("vertex <> b").select(F.col("vertex").alias("a"), "b")
    linked = written(linked.union(same), "linked")
    sets = _sets_alike(docs, marked, reps, id_col, text_col)
    cells = _cells(sets)
    of_cell = Window.partitionBy("h")
    for stars in (True, False):
        of = reps.join(components(linked), "vertex", "left").select("whole", F.coalesce("component", "vertex").alias("class"))
        mixed = cells.join(of.join(cells.select("whole").distinct(), "whole", "left_semi"), "whole")
        mixed = mixed.withColumn("least", F.min("class").over(of_cell)).withColumn("most", F.max("class").over(of_cell)).where("least <> most")
        if stars:
            row = F.struct("whole", "size", "rest", "class")
            ends = mixed.withColumn("ends", F.array(F.min(row).over(of_cell), F.max(row).over(of_cell)))
            ends = ends.withColumn("end", F.explode("ends")).where("class <> end.class and 9 * least(rest, end.rest) >= 4 * (size + end.size)")
            pairs = ends.select(F.least("whole", "end.whole").alias("a"), F.greatest("whole", "end.whole").alias("b"))
        else:
            dealt = _in_parts(written(mixed.select("h", "whole", "size", "rest", "class", *_BEFORE), "mixed"), ["h"], "whole", cell_rows)
            dealt = dealt.select("h", "part", "whole", "size", "rest", "class", *_BEFORE).repartition("h", "part").sortWithinPartitions("h", "part")
            pairs = dealt.mapInArrow(_crossing, "a long, b long")
        linked = written(linked.union(_verified(pairs.distinct(), sets, reps)), "linked")
    return linked


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, wide: int = WIDE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """A row for each row of docs: id, of_text, component, kept, as ``near_duplicates`` has them.

    Links are those of similar sets, all of them, and those of both fingerprints (at most distance and wide bits), all of them.
    """
    key = ["fp", *_WORDS, "whole"]
    marked = written(sketches(docs, id_col, text_col), "sketches")
    # numbers of rows of a table that is written once
    points = written(marked.groupBy(*key).agg(_first()).withColumn("vertex", F.monotonically_increasing_id()), "points")
    linked = written(links(points, distance, (), cell_rows, _WORDS, wide), "linked")
    linked = _similar(docs, marked, points, linked, id_col, text_col, cell_rows)
    of_key = written(_classes(points, linked).select(*key, "kept"), "classes")
    return marked.join(of_key, key, "left").select("id", "of_text", F.col("kept.id").alias("component"), "kept")


def _without(docs: DataFrame, marked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs without the rows that another one stands for. Where those that go are many, the table is shuffled by id."""
    gone = marked.where((F.col("id") != F.col("kept.id")) | (F.col("of_text") != F.col("kept.of_text"))).select("id", "of_text").distinct()
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col(f"row.{text_col}").cast("string"), F.lit(""))
    whole = whole.select("row", F.col(f"row.{id_col}").cast("long").alias("id"), F.xxhash64(text).alias("of_text"))
    return whole.join(gone, ["id", "of_text"], "left_anti").select("row.*")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """docs with one row of each component of ``near_duplicates``: that of the smallest id. Rows with a null id all stay."""
    return _without(docs, near_duplicates(docs, id_col, text_col, shingle, distance), id_col, text_col)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, wide: int = WIDE) -> DataFrame:
    """docs with one row of each component of ``near_copies``: that of the smallest id. Rows with a null id all stay."""
    return _without(docs, near_copies(docs, id_col, text_col, distance, wide), id_col, text_col)
