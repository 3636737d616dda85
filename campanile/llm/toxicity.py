"""Toxicity by class-conditional Kneser-Ney models of the characters in words.

Two models, toxic and ordinary, give each letter of a word (and its end) a probability after up to four characters
of the same word. Counts of the longest context are the class's own, with absolute discounting; what they lack is
taken from lower orders that both classes share: continuation counts (how many different characters stand before),
taken over every document, labelled or not. So an expression that one class has never shown, or a new ending of a
known one, is judged by what the corpus knows of its parts.

A document is scored by length-normalised log-likelihoods, toxic less ordinary: over the whole text, over its best
passage of ``PASSAGE`` words and its best single words. A logistic curve, fitted on labelled documents that gave no counts,
turns them into 0 to 1.

Labels are learned from at most ``per_class`` rows of either class, those with the smallest hashes of doc_id; the shared
counts cover all documents. The counts are tables that grow with the documents, and so is what is made of them: each
5-gram's log-likelihood ratio comes from joins of the orders, and a text meets the ratios of its 5-grams in a block of
rows, so no process holds more than the 5-grams of one block of about ``BLOCK`` characters.

Defined cases: words are runs of letters, lower-cased; a null text, or one without words, has all-zero features.
Texts of any length are read whole. Repeated rows count each time and are each scored; of several labels of one id the greatest counts. Without
labels of both classes, as in an empty table, every score is 0. Columns besides those named are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.llm.common import checksum_mod, split_large, written
from campanile.llm.language import _letters

PER_CLASS = 20_000
BLOCK = 1 << 26
PASSAGE = 8
ORDER = 5
FEATURES = 7
#: A letter below 4096 is a character; any other is two, a lead and a trail, which no letter below 4096 is. So all differ.
_BITS = 12
_MASK = (1 << _BITS) - 1
_BLANK = 32
_AT_ONCE = 1 << 20
#: Characters of the rows that are compressed together.
_CHUNK = 1 << 20
#: Distinct 5-grams a task sums up before it passes them on.
_HELD = 1 << 21
#: Of these checksums (modulo 5) come the counts, of the last the curve; 0 is held out.
COUNTED, FITTED = (1, 2, 3), 4


@cache
def _pairs() -> tuple[np.ndarray, np.ndarray]:
    """Leads and trails: codes below 4096 that are no letters, a pair for every letter there is."""
    letters = np.flatnonzero(_letters())
    free = np.setdiff1d(np.arange(1, _MASK + 1), np.r_[letters, _BLANK])
    trails, leads = free[-1024:], free[:-1024][: letters[-1] // 1024 + 1]
    if len(leads) <= letters[-1] // 1024:
        raise ValueError("too few codes for all letters")
    return leads, trails


def codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The 5-gram of every letter and word end, and where each word starts among them.

    A 5-gram is four characters of context (zeros before the blank that starts a word) and the character itself.
    """
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    c = np.where(_letters()[c], c, _BLANK).astype(np.int64)
    if c.max() > _MASK:
        leads, trails = _pairs()
        high = c > _MASK
        at = np.repeat(np.arange(len(c)), 1 + high)
        second = np.r_[False, at[1:] == at[:-1]]
        wide, c = high[at], c[at]
        c = np.where(wide, np.where(second, trails[c % len(trails)], leads[c // len(trails)]), c)
    c = c[np.r_[True, (c[1:] != _BLANK) | (c[:-1] != _BLANK)]]
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    out, alive = c[1:].copy(), np.ones(len(c) - 1, dtype=bool)
    for k in range(1, ORDER):
        before = np.r_[np.zeros(k - 1, np.int64), c][: len(c) - 1]
        before = np.where(alive, before, 0)
        alive &= (before != _BLANK) & (before != 0)
        out |= before << (_BITS * k)
    return out, np.r_[0, np.flatnonzero(c[1:-1] == _BLANK) + 1]


def words_of(text: str) -> list[str]:
    """The words of a text, in order: those that ``codes`` takes apart."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(_letters()[c], c, _BLANK).astype("<u4").tobytes().decode("utf-32-le").split()


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of values of each."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    k, v = keys[order], values[order]
    starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    return k[starts], np.add.reduceat(v, starts, axis=0)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in an ascending table, and whether the key is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


class _Level:
    """Discounted counts of (context, character) and what their contexts leave to the next lower order."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray) -> None:
        self.grams = grams
        contexts, sums = _sum_by(grams >> _BITS, np.stack([counts, np.ones(len(counts))], axis=1))
        n1, n2 = (counts == 1).sum(), (counts == 2).sum()
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        at, _ = _find(contexts, grams >> _BITS)
        self.own = np.maximum(counts - d, 0) / sums[at, 0] if len(grams) else counts
        self.contexts, self.left = contexts, d * sums[:, 1] / sums[:, 0] if len(contexts) else np.zeros(0)

    def probability(self, grams: np.ndarray, lower: np.ndarray) -> np.ndarray:
        at, there = _find(self.contexts, grams >> _BITS)
        left = np.where(there, self.left[at] if len(self.left) else 0.0, 1.0)
        at, there = _find(self.grams, grams)
        return np.where(there, self.own[at] if len(self.own) else 0.0, 0.0) + left * lower


class Model:
    """The model of a few grams in memory, to hold ``ratios`` against. toxic, ordinary: counts of the grams in either class."""

    def __init__(self, grams: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> None:
        order = np.argsort(grams)
        grams, toxic, ordinary = grams[order], toxic[order].astype(float), ordinary[order].astype(float)
        self.tops = [_Level(grams[n > 0], n[n > 0]) for n in (toxic, ordinary)]
        self.lower = []
        for k in range(ORDER - 1):  # contexts of k characters: one for each different character before
            mask = (1 << _BITS * (k + 1)) - 1
            longer = np.unique(grams & ((1 << _BITS * (k + 2)) - 1))
            longer = longer[(longer >> _BITS * (k + 1)) > 0]
            self.lower.append(_Level(*_sum_by(longer & mask, np.ones(len(longer)))))
        self.letters = max(2, len(np.unique(grams & _MASK)))

    def compare(self, grams: np.ndarray) -> np.ndarray:
        """Log-likelihood under the toxic model less that under the ordinary one."""
        if not all(len(t.grams) for t in self.tops) or not len(grams):
            return np.zeros(len(grams))
        shared = np.full(len(grams), 1 / self.letters)
        reach = sum(((grams >> _BITS * k) & _MASK) > 0 for k in range(1, ORDER))  # characters of context
        for k, level in enumerate(self.lower):
            # only orders below the gram's own are shared
            shared = np.where(k < np.maximum(reach, 1), level.probability(grams & ((1 << _BITS * (k + 1)) - 1), shared), shared)
        toxic, ordinary = (t.probability(grams, shared) for t in self.tops)
        return np.log(toxic) - np.log(ordinary)


def _discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


def _smoothed(count: str, context: list[Column], d: float | Column) -> tuple[Column, Column]:
    """Of a count: its discounted share of its context, and what the context leaves to the next lower order.

    The rows of a context differ in one character, so a window holds at most as many as there are characters.
    """
    w = Window.partitionBy(*context)
    total, kinds = F.sum(count).over(w), F.sum(F.when(F.col(count) > 0, 1).otherwise(0)).over(w)
    return F.when(total > 0, F.greatest(F.col(count) - d, F.lit(0.0)) / total).otherwise(0.0), F.when(total > 0, d * kinds / total).otherwise(1.0)


def ratios(grams: DataFrame) -> DataFrame:
    """(gram, llr): log-likelihood under the toxic model less that under the ordinary one, of every row of grams.

    grams is a written table (gram, toxic, ordinary, known) of distinct grams; those not known are asked for only.
    """
    low = lambda c, n: c.bitwiseAND(F.lit((1 << _BITS * n) - 1))  # noqa: E731  its last n characters
    gram = F.col("gram")
    # every lower order of every gram: its last k + 1 characters after one more, which makes one continuation
    steps = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), low(gram, k + 2).alias("longer")) for k in range(ORDER - 1)])).alias("s")
    longer = grams.select("known", steps).select("s.*", "known").where(F.expr(f"shiftright(longer, {_BITS} * (k + 1)) > 0"))
    longer = longer.groupBy("k", "longer").agg(F.max("known").alias("known"))
    last = F.expr(f"longer & (shiftleft(1L, {_BITS} * (k + 1)) - 1)").alias("gram")
    orders = written(longer.groupBy("k", last).agg(F.sum("known").alias("n")), "toxicity-orders")
    number = lambda c: F.count(F.when(c, 1))
    seen = {r.k: r for r in orders.groupBy("k").agg(number(F.col("n") == 1).alias("a"), number(F.col("n") == 2).alias("b"), number(F.col("n") > 0).alias("c")).collect()}  # a row an order
    own = grams.agg(*[number(F.col(c) == n).alias(f"{c}{n}") for c in ("toxic", "ordinary") for n in (1, 2)], *[F.sum(c).alias(c) for c in ("toxic", "ordinary")]).first()
    if not own.toxic or not own.ordinary:
        return grams.select("gram", F.lit(0.0).alias("llr"))

    # a gram's probability by its order k, from that of its end in the order below; a gram's end is shared by at most as many
    # grams as there are characters
    below, every = None, []
    for k in range(ORDER - 1):
        if k not in seen:
            break
        share, left = _smoothed("n", [F.shiftright("gram", _BITS)], _discount(seen[k].a, seen[k].b))
        level = orders.where(F.col("k") == k).select("gram", share.alias("share"), left.alias("left"))
        if below is None:
            level = level.select("gram", (F.col("share") + F.col("left") / max(2, seen[0].c)).alias("p"))
        else:
            ends = below.select(F.col("gram").alias("end"), F.col("p").alias("q"))
            if k == 1:  # at most as many rows as characters
                ends = F.broadcast(ends)
            level = level.join(ends, low(gram, k) == F.col("end")).select("gram", (F.col("share") + F.col("left") * F.col("q")).alias("p"))
        below = level
        every.append(level.select(F.lit(k).alias("k"), F.col("gram").alias("end"), "p"))
    shared = every[0]
    for level in every[1:]:
        shared = shared.union(level)
    parts = {c: _smoothed(c, [F.shiftright("gram", _BITS)], _discount(own[c + "1"], own[c + "2"])) for c in ("toxic", "ordinary")}
    top = grams.select("gram", *[x.alias(f"{c}_{name}") for c, two in parts.items() for name, x in zip(("share", "left"), two, strict=True)])
    reach = sum((F.when(F.shiftright("gram", _BITS * k) > 0, 1).otherwise(0) for k in range(2, ORDER)), F.lit(0))
    top = top.withColumn("k", reach).withColumn("end", F.expr(f"gram & (shiftleft(1L, {_BITS} * (k + 1)) - 1)"))
    p = lambda c: F.log(F.col(f"{c}_share") + F.col(f"{c}_left") * F.col("p"))
    return top.join(shared, ["k", "end"]).select("gram", (p("toxic") - p("ordinary")).alias("llr"))


def features(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of the differences, summed over each word of a text: length-normalised over the text, the best passage and the best
    word; the mean of the best 1, 3 and 6 words; and the logarithm of the number of words, against which chance finds are held."""
    if not len(sums):
        return np.zeros(FEATURES)
    run = np.r_[0, np.cumsum(sums)], np.r_[0, np.cumsum(lengths)]
    n = min(PASSAGE, len(sums))
    passages = (run[0][n:] - run[0][:-n]) / (run[1][n:] - run[1][:-n])
    best = np.sort(np.r_[sums, np.zeros(6)])[: -7 : -1]
    return np.array([sums.sum() / lengths.sum(), passages.max(), (sums / lengths).max(), best[0], best[:3].mean(), best.mean(), np.log1p(len(sums))])


class Curve:
    """A logistic curve over the features."""

    def __init__(self) -> None:
        self.weights = np.zeros(0)

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> None:
        """By Newton's method."""
        if len(set(y.tolist())) < 2:
            return
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-9
        a = np.c_[(x - self.mean) / self.spread, np.ones(len(x))]
        w = np.zeros(a.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            h = (a * (p * (1 - p))[:, None]).T @ a + ridge * len(a) * np.eye(len(w))
            w -= np.linalg.solve(h, a.T @ (p - y) + ridge * len(a) * w)
        self.weights = w

    def score(self, x: np.ndarray) -> float:
        x = (x - self.mean) / self.spread
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30))))


class Fitted:
    """grams: the written counts of every 5-gram; known: their written ratios; and the curve."""

    def __init__(self, grams: DataFrame) -> None:
        self.grams, self.known, self.curve = grams, written(ratios(grams), "toxicity-ratios"), Curve()

    def ratios_of(self, pairs: DataFrame) -> DataFrame:
        """(block, gram, llr) of pairs (block, gram); a gram that was never counted is judged by the lower orders."""
        found = written(pairs.join(self.known, "gram", "left").select("block", "gram", "llr"), "toxicity-found")
        new = found.where("llr is null")
        if new.isEmpty():
            return found
        zero = F.lit(0).cast("long")
        asked = new.select("gram").distinct().select("gram", zero.alias("toxic"), zero.alias("ordinary"), F.lit(0).alias("known"))
        more = ratios(written(self.grams.unionByName(asked), "toxicity-asked"))
        return found.where("llr is not null").unionByName(new.drop("llr").join(more, "gram").select("block", "gram", "llr"))


_BLOCKS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("gram", pa.int64()), ("chunk", pa.binary())])
#: What a row of a block holds: a gram, the words (one row), or a chunk of rows whose texts are numbers of words.
_GRAM, _WORDS, _ROWS = range(3)


def _packed(block: int, kind: int, table: pa.RecordBatch) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(table)
    return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([kind], pa.int32()), pa.nulls(1, pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=_BLOCKS)


def _unpacked(chunk: pa.Scalar) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(chunk.as_buffer())))


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose last column is a text, as blocks: their distinct grams and words, and the rows in compressed chunks.

    In a chunk, the text is four columns: the first, second, third and fourth bytes of the numbers of its words.
    """

    def slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str], int]]:
        texts, at, size = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()], 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= _CHUNK or i + 1 == len(texts):
                yield batch.slice(at, i + 1 - at), texts[at : i + 1], size
                at, size = i + 1, 0

    def rest() -> Iterator[pa.RecordBatch]:
        if vocabulary:
            yield _packed(block, _WORDS, pa.RecordBatch.from_arrays([pa.array(list(vocabulary), pa.large_string())], ["word"]))
            keys = np.unique(codes(" ".join(vocabulary))[0])
            n = len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block, np.int64)), pa.array(np.full(n, _GRAM, np.int32)), pa.array(keys), pa.nulls(n, pa.binary())], schema=_BLOCKS)

    block, vocabulary, whole = TaskContext.get().partitionId() << 32, {}, 0
    for batch in batches:
        for part, texts, size in slices(batch):
            numbers = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], dtype="<u4").view(np.uint8).reshape(-1, 4) for t in texts]
            planes = [pa.array([x[:, k].tobytes() for x in numbers], pa.large_binary()) for k in range(4)]
            yield _packed(block, _ROWS, pa.RecordBatch.from_arrays([*part.columns[:-1], *planes], [*part.schema.names[:-1], *(f"__{k}" for k in range(4))]))
            whole += size
            if whole >= BLOCK:
                yield from rest()
                block, vocabulary, whole = block + 1, {}, 0
    yield from rest()


def _per_text(rows: DataFrame, model: Fitted, value: Callable[[np.ndarray], np.ndarray], names: list[str]) -> DataFrame:
    """rows (any columns, then __text) with ``value`` of a text's features, as columns of doubles, in the text's place.

    Rows are written as blocks of those that lie together. A block's distinct grams find their ratios by a join, then
    ratios, words and rows of a block meet in a task of their own, in this order, the rows chunk by chunk.
    """
    kept = written(rows.mapInArrow(_in_blocks, "block long, kind int, gram long, chunk binary"), "toxicity-rows")
    packed = kept.where(F.col("kind") > _GRAM).select("block", "kind", "chunk")
    numbers = sorted(r.block for r in packed.select("block").distinct().collect())  # one for each BLOCK characters, and one for each task
    place = F.broadcast(rows.sparkSession.createDataFrame(list(zip(numbers, range(len(numbers)), strict=True)), "block long, place int"))
    found = model.ratios_of(kept.where(F.col("kind") == _GRAM).select("block", "gram")).withColumn("kind", F.lit(_GRAM))
    both = found.unionByName(packed, allowMissingColumns=True).join(place, "block").select("place", "gram", "llr", "kind", "chunk")
    dealt = both.repartitionById(max(1, len(numbers)), F.col("place")).sortWithinPartitions("kind", "gram").select("gram", "llr", "kind", "chunk")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), *(f"{n} double" for n in names)])
    kept_names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, llr, sums, lengths = [], [], np.zeros(0), np.zeros(0)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            x, first = np.zeros((batch.num_rows, len(names))), batch.num_columns - 4
            for i, planes in enumerate(zip(*(batch.column(first + k).to_pylist() for k in range(4)), strict=True)):
                at = np.stack([np.frombuffer(b, np.uint8) for b in planes], axis=1).view("<u4").ravel()
                x[i] = value(features(sums[at], lengths[at]))
            return pa.RecordBatch.from_arrays([*batch.columns[:first], *(pa.array(np.ascontiguousarray(x[:, k])) for k in range(len(names)))], [*kept_names, *names])

        for batch in batches:
            grams = batch.filter(batch.column(0).is_valid())
            keys.append(grams.column(0).to_numpy())
            llr.append(grams.column(1).to_numpy())
            for kind, chunk in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
                if kind == _WORDS:
                    asked, words = codes(" ".join(_unpacked(chunk).column(0).to_pylist()))
                    at, there = _find(np.concatenate(keys), asked)
                    if not there.all():
                        raise ValueError("a block has words without ratios")
                    sums, lengths = np.add.reduceat(np.concatenate(llr)[at], words), np.diff(np.r_[words, len(asked)])
                elif kind == _ROWS:
                    yield one(_unpacked(chunk))

    return dealt.mapInArrow(run, schema)


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, held_out: Column, per_class: int) -> DataFrame:
    """(sample_id, y): at most per_class rows of either label, those whose ids hash smallest. It is small: broadcast it."""
    known = labels.where(~held_out).where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("sample_id")).agg(F.max(label_col).cast("int").alias("y"))
    take = lambda y: known.where(F.col("y") == y).orderBy(F.xxhash64("sample_id"), "sample_id").limit(per_class)
    return F.broadcast(take(0).union(take(1)))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary, n) summed over texts (text, y: 1, 0 or null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, held, size = np.zeros(0, np.int64), np.zeros((0, 3), np.int64), {1: [], 0: [], None: []}, 0

        def flush() -> tuple[np.ndarray, np.ndarray]:
            all_keys, all_sums = [keys], [sums]
            for y, texts_ in held.items():
                k, n = np.unique(codes(" ".join(texts_))[0], return_counts=True)
                all_keys.append(k)
                all_sums.append(np.stack([n * (y == 1), n * (y == 0), n], axis=1))
                texts_.clear()
            return _sum_by(np.concatenate(all_keys), np.concatenate(all_sums))

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[y].append(text or "")
                size += len(text or "")
                if size > _AT_ONCE:
                    (keys, sums), size = flush(), 0
            if len(keys) > _HELD:
                yield _as_batch(keys, sums)
                keys, sums = keys[:0], sums[:0]
        yield _as_batch(*flush())

    return texts.mapInArrow(run, "gram long, toxic long, ordinary long, n long").groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("toxic", "ordinary", "n")])


def _as_batch(keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(np.ascontiguousarray(sums[:, k])) for k in range(3))], ["gram", "toxic", "ordinary", "n"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> Fitted:
    """The two models and the curve. Labels of rows whose checksum modulo 5 is 0 are never looked at."""
    part = checksum_mod(F.col(id_col), 5)
    sample = labelled_sample(labels, id_col, label_col, part == 0, per_class)
    rows = docs.select(F.col(id_col).alias("sample_id"), F.col(text_col).cast("string").alias("text"), part.alias("part"))
    marked = rows.join(sample, "sample_id", "left")
    counted = marked.select("text", F.when(F.col("part").isin(*COUNTED), F.col("y")).alias("y"))
    model = Fitted(written(gram_counts(counted).select("gram", "toxic", "ordinary", F.lit(1).alias("known")), "toxicity-grams"))
    fitted = rows.where(F.col("part") == FITTED).join(sample, "sample_id").select("y", F.col("text").alias("__text"))
    points = _per_text(fitted, model, lambda x: x, [f"x{k}" for k in range(FEATURES)]).toArrow()  # at most 2 * per_class rows
    model.curve.fit(np.stack([points.column(k).to_numpy() for k in range(1, FEATURES + 1)], axis=1), points.column(0).to_numpy())
    return model


def score(docs: DataFrame, model: Fitted, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and score of each row."""
    rows, curve = docs.select(*[c.alias(k) for k, c in keep.items()], F.col(text_col).cast("string").alias("__text")), model.curve
    if not len(curve.weights):
        return rows.select(*keep, F.lit(0.0).alias("score"))
    return _per_text(rows, model, curve.score, ["score"])
