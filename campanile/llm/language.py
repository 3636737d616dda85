"""Language identification by rank-order n-gram profiles and out-of-place distance.

A profile is the most frequent character n-grams (lengths 1 to 3, words padded by a blank) of a language's
documents, most frequent first. A document's own most frequent n-grams are compared to each profile: an n-gram
costs the difference of its two ranks, or the profile's length where it is missing. The nearest profile wins.

Profiles are counted over all documents that may be learned from: each task counts words, then n-grams of its
distinct words; only n-gram sums are shuffled, and ``size`` rows a language reach the driver.

Defined cases: letters are Unicode letters, lower-cased; a text that is null or has no letter is ``und`` with score
0. Ties of counts go to the smaller code points, ties of distance to the language that sorts first. Rows with a null
language or text teach nothing; repeated rows count each time and are each predicted. Texts of any length are read whole. Without
any profile, as from an empty table, every text is ``und``. Other columns, whatever their names, are passed on by ``keep_identified`` and
not looked at by ``identify``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campanile.llm.common import split_large

SIZE = 400
DOCUMENT_SIZE = 400
UNKNOWN = "und"
_BLANK = 32
#: Characters that are counted at once while learning.
_AT_ONCE = 1 << 21


@cache
def _letters() -> np.ndarray:
    """Of every code point, whether it is a letter."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    mask = np.zeros(0x110000, dtype=bool)
    mask[[ord(c) for c in regex.findall(r"\p{L}", "".join(points))]] = True
    return mask


def grams(text: str) -> np.ndarray:
    """Every n-gram of the text's words as an integer: 21 bits for each character, the first in the highest bits.

    One- to three-grams of letters, with a blank at either end of a word; none for a text without letters.
    """
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    c = np.where(_letters()[c], c, _BLANK).astype(np.int64)
    c = c[np.r_[True, (c[1:] != _BLANK) | (c[:-1] != _BLANK)]]
    if len(c) < 3:
        return np.zeros(0, dtype=np.int64)
    two = c[:-1] << 42 | c[1:] << 21
    return np.concatenate([c[c != _BLANK] << 42, two, (two[:-1] | c[2:])[c[1:-1] != _BLANK]])


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) summed over docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = defaultdict(list)
        length: dict[str, int] = defaultdict(int)

        def flush(lang: str) -> pa.RecordBatch:
            codes, n = np.unique(grams(" ".join(held.pop(lang))), return_counts=True)
            length.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[lang].append(text)
                length[lang] += len(text)
                if sum(length.values()) > _AT_ONCE:
                    yield flush(max(length, key=length.get))
        for lang in list(held):
            yield flush(lang)

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Profiles:
    """Ranks of every profile's n-grams: a row for each n-gram, a column for each language."""

    def __init__(self, of: dict[str, list[int]], size: int = SIZE, document_size: int = DOCUMENT_SIZE) -> None:
        self.langs, self.size, self.document_size = sorted(of), size, document_size
        self.codes = np.array(sorted({g for p in of.values() for g in p}), dtype=np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), size, dtype=np.int64)  # the last row: n-grams of none
        for j, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, np.array(of[lang], dtype=np.int64)), j] = np.arange(len(of[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and, as its score, how far below the greatest possible distance it is."""
        every = grams(text) if text and self.langs else ()
        if not len(every):
            return UNKNOWN, 0.0
        codes, counts = np.unique(every, return_counts=True)
        own = codes[np.argsort(-counts, kind="stable")[: self.document_size]]
        at = np.searchsorted(self.codes, own)
        at[self.codes[np.minimum(at, len(self.codes) - 1)] != own] = len(self.codes)
        there = self.ranks[at]
        out_of_place = np.where(there < self.size, np.abs(there - np.arange(len(own))[:, None]), self.size)
        distance = np.minimum(out_of_place, self.size).sum(axis=0)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.size * len(own)))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = SIZE, document_size: int = DOCUMENT_SIZE) -> Profiles:
    """Profiles of the languages that docs name."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = gram_counts(docs, text_col, lang_col).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    of: dict[str, list] = defaultdict(list)
    for r in top.select("lang", "rank", "gram").collect():  # size rows for each language
        of[r.lang].append((r.rank, r.gram))
    return Profiles({lang: [g for _, g in sorted(ranks)] for lang, ranks in of.items()}, size, document_size)


def _predictions(model: Broadcast, texts: pa.Array) -> tuple[list[str], list[float]]:
    got = [model.value.predict(t) for t in texts.to_pylist()]
    return [x[0] for x in got], [x[1] for x in got]


def identify(docs: DataFrame, model: Profiles, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, lang_pred and score of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [*keep, "lang_pred", "score"]
    rows = docs.select(*[c.alias(k) for k, c in keep.items()], F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), "lang_pred string", "score double"])

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = _predictions(sent, batch.column(batch.num_columns - 1))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from split_large(batch, one)

    return rows.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Profiles, text_col: str = "text", min_score: float = 0.0, lang_col: str | None = None) -> DataFrame:
    """docs, same columns, without the rows whose language is ``und`` or whose score is below min_score.

    lang_col: a column of strings that gets the predicted language. Without any profile nothing is known of languages: only the
    rows without a letter go, and lang_col stays as it is.
    """
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)
    to = None if lang_col is None else docs.columns.index(lang_col)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not sent.value.langs:
            return batch.filter(pa.array([len(grams(t or "")) > 0 for t in batch.column(at).to_pylist()], pa.bool_()))
        lang, score = _predictions(sent, batch.column(at))
        if to is not None:
            batch = pa.RecordBatch.from_arrays([*batch.columns[:to], pa.array(lang, batch.schema.field(to).type), *batch.columns[to + 1 :]], batch.schema.names)
        return batch.filter(pa.array([x != UNKNOWN and s >= min_score for x, s in zip(lang, score, strict=True)], pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from split_large(batch, one)

    return docs.mapInArrow(run, docs.schema)
