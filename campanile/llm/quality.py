"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its evidence are its own features and those of its neighbours; the chain adds how lines
follow one another. Forward-backward gives each line's marginal probability of being good, and their mean, weighted by
the lines' lengths, is the document's quality; a logistic curve makes a score of it.

Only documents are labelled, lines are not: a line's state is latent, and the document's label is a witness to each line that
is right with probability ``AGREES``. The field is trained on the likelihood of the labels: its gradient is what forward-backward
expects of features and moves once the witnesses are heard, less what it expects without them. So a good line in a bad document can be
taken for what it is, and the moves between good and bad lines are learned from documents that hold both.

The field is trained on one part of the labelled rows, with all their lines; the curve is fitted on another. Both come from at most
``per_class`` rows of either label, those with the smallest hashes of doc_id. Scoring always reads every line of the whole text.

Defined cases: lines are what ``\\n`` separates, without blank ones; a null or blank text has one empty line; texts of any number of
lines are read whole. Repeated rows each have a score, and count each time if they are labelled; of several labels of one id the
greatest counts, rows with a null id or label teach nothing. Without labels of both kinds, as in an empty table, every score is 0.
Columns besides those named are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campanile.llm.common import checksum_mod, split_large
from campanile.llm.toxicity import labelled_sample

PER_CLASS = 2_500
#: How often a document's label holds for a line of it.
AGREES = 0.8
#: Lines, with those that fill up shorter documents, that are worked on together in training.
_TOGETHER = 100_000
HELD_OUT, TRAINED, FITTED = 1, 0, 2

#: Kinds of bytes that are counted for each line.
_KINDS = {
    "upper": set(range(65, 91)),
    "digit": set(range(48, 58)),
    "stop": set(b".!?"),
    "shout": set(b"!"),
    "comma": set(b",;:"),
    "symbol": set(range(33, 127)) - set(range(48, 58)) - set(range(65, 91)) - set(range(97, 123)) - set(b".!?,;:'\"-()"),
    "bar": set(b"|"),
    "high": set(range(128, 256)),
}
_MASKS = np.array([[b in s for b in range(256)] for s in _KINDS.values()])
OWN = len(_KINDS) + 8
SIZE = 3 * OWN


def lines_of(text: str | None) -> list[str]:
    return [x for x in (text or "").split("\n") if x.strip()] or [""]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x SIZE features: a line's own, the one's before, the one's after; lengths)."""
    lines = lines_of(text)
    raw = [x.encode("utf-8", "surrogatepass") for x in lines]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    data = np.frombuffer(b"".join(raw) or b" ", dtype=np.uint8)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    kinds = np.add.reduceat(_MASKS[:, data], starts, axis=1, dtype=np.int64).T / np.maximum(sizes, 1)[:, None]
    seen = Counter(lines)
    own = np.empty((len(lines), 8))
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words) or 1
        most = max(Counter(words).values()) if words else 0
        own[i] = (
            math.log1p(sizes[i]),
            math.log1p(len(words)),
            len(set(words)) / n,
            sum(map(eq, words, words[1:])) / n,
            most / (n + 4),
            sizes[i] / n / 10,
            seen[line] > 1,
            line.rstrip()[-1:] in ".!?",
        )
    own = np.c_[kinds, own]
    edge = np.zeros((1, OWN))
    return np.c_[own, np.r_[edge, own[:-1]], np.r_[own[1:], edge]], np.maximum(sizes, 1)


class Field:
    """weights: of the features, for good against bad; moves: log-potentials of [before, after]."""

    def __init__(self) -> None:
        self.mean, self.spread = np.zeros(SIZE), np.ones(SIZE)
        self.weights, self.bias, self.moves = np.zeros(SIZE), 0.0, np.zeros((2, 2))
        self.curve: tuple[float, float] | None = None

    def train(self, docs: list[np.ndarray], labels: np.ndarray, steps: int = 80, rate: float = 0.1, ridge: float = 1e-3, agrees: float = AGREES) -> None:
        """Maximises the likelihood of the documents' labels, lines being latent, by Adam over all documents at once."""
        lines = sum(map(len, docs))
        self.mean = sum((d.sum(0, dtype=float) for d in docs), np.zeros(SIZE)) / lines
        self.spread = np.sqrt(sum((((d - self.mean) ** 2).sum(0) for d in docs), np.zeros(SIZE)) / lines) + 1e-6
        groups = []  # documents of like length, padded
        for part in _of_like_length(sorted(zip(docs, labels.tolist(), strict=True), key=lambda d: len(d[0]))):
            x, mask = np.zeros((len(part), len(part[-1][0]), SIZE), dtype=np.float32), np.zeros((len(part), len(part[-1][0])), dtype=bool)
            for i, (d, _) in enumerate(part):
                x[i, : len(d)] = (d - self.mean) / self.spread
                mask[i, : len(d)] = True
            groups.append((x, mask, np.array([y for _, y in part])))
        theta = np.zeros(SIZE + 5)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            grad = ridge * theta
            grad[SIZE + 1 :] *= 10
            for x, mask, y in groups:
                grad -= self._gradient(theta, x, mask, y, agrees) / lines
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.weights, self.bias, self.moves = theta[:SIZE], float(theta[SIZE]), theta[SIZE + 1 :].reshape(2, 2)

    @staticmethod
    def _expected(emit: np.ndarray, moves: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By forward-backward: each line's probability of being good, and how often each move is made."""
        n, longest, _ = emit.shape
        potential = np.exp(emit - emit.max(2, keepdims=True))
        ahead, back = np.zeros((n, longest, 2)), np.ones((n, longest, 2))
        ahead[:, 0] = potential[:, 0] / potential[:, 0].sum(1, keepdims=True)
        for t in range(1, longest):
            f = (ahead[:, t - 1] @ moves) * potential[:, t]
            ahead[:, t] = np.where(mask[:, t, None], f / f.sum(1, keepdims=True), ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            b = (potential[:, t + 1] * back[:, t + 1]) @ moves.T
            back[:, t] = np.where(mask[:, t + 1, None], b / b.sum(1, keepdims=True), 1.0)
        post = ahead * back
        good = post[:, :, 1] / post.sum(2) * mask
        pair = ahead[:, :-1, :, None] * moves * (potential * back)[:, 1:, None, :]
        pair /= pair.sum((2, 3), keepdims=True)
        return good, (pair * mask[:, 1:, None, None]).sum((0, 1))

    @classmethod
    def _gradient(cls, theta: np.ndarray, x: np.ndarray, mask: np.ndarray, y: np.ndarray, agrees: float = AGREES) -> np.ndarray:
        """Of the labels' log-likelihood: what is expected with the labels as witnesses less what is expected without."""
        n, longest, _ = x.shape
        emit = np.zeros((n, longest, 2))
        emit[:, :, 1] = x @ theta[:SIZE].astype(np.float32) + theta[SIZE]
        moves = np.exp(theta[SIZE + 1 :].reshape(2, 2))
        heard = emit.copy()
        heard[:, :, 1] += np.where(y == 1, 1, -1)[:, None] * math.log(agrees / (1 - agrees))
        (good, made), (free, usual) = cls._expected(heard, moves, mask), cls._expected(emit, moves, mask)
        differ = good - free
        out = np.empty(SIZE + 5)
        out[:SIZE] = np.tensordot(differ.astype(np.float32), x, axes=([0, 1], [0, 1]))
        out[SIZE] = differ.sum()
        out[SIZE + 1 :] = (made - usual).ravel()
        return out

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """Each line's probability of being good."""
        lift = np.exp(np.clip(((x - self.mean) / self.spread) @ self.weights + self.bias, -50, 50)).tolist()
        (a00, a01), (a10, a11) = np.exp(self.moves).tolist()
        ahead, p = [], None
        for e in lift:
            good, bad = (e, 1.0) if p is None else (e * (p * a11 + (1 - p) * a01), p * a10 + (1 - p) * a00)
            p = good / (good + bad)
            ahead.append(p)
        out, b = [0.0] * len(lift), 0.5
        for t in range(len(lift) - 1, -1, -1):
            good, bad = ahead[t] * b, (1 - ahead[t]) * (1 - b)
            out[t] = good / (good + bad) if good + bad else 0.5
            good, bad = a11 * lift[t] * b + a10 * (1 - b), a01 * lift[t] * b + a00 * (1 - b)
            b = good / (good + bad)
        return np.array(out)

    def quality(self, text: str | None) -> float:
        x, lengths = features(text)
        return float(self.marginals(x) @ lengths / lengths.sum())

    def fit_curve(self, quality: np.ndarray, y: np.ndarray) -> None:
        """score = sigmoid(a * logit(quality) + b), by Newton's method."""
        if len(set(y.tolist())) < 2:
            return
        a, w = np.c_[_logit(quality), np.ones(len(quality))], np.zeros(2)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            h = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * len(a) * np.eye(2)
            w -= np.linalg.solve(h, a.T @ (p - y) + 1e-3 * len(a) * w)
        self.curve = (float(w[0]), float(w[1]))

    def score(self, text: str | None) -> float:
        if self.curve is None:
            return 0.0
        z = self.curve[0] * _logit(np.array(self.quality(text))) + self.curve[1]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _of_like_length(docs: list[tuple[np.ndarray, int]]) -> Iterator[list[tuple[np.ndarray, int]]]:
    """Documents, shortest first, in parts that stay within ``_TOGETHER`` lines once they are filled up to the longest."""
    part: list[tuple[np.ndarray, int]] = []
    for d in docs:
        if part and (len(part) + 1) * len(d[0]) > _TOGETHER:
            yield part
            part = []
        part.append(d)
    if part:
        yield part


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = PER_CLASS) -> Field:
    """The field and its curve. Labels of rows whose checksum modulo 3 is 1 are never looked at."""
    part = checksum_mod(F.col(id_col), 3)
    sample = labelled_sample(labels, id_col, label_col, part == HELD_OUT, per_class)
    rows = docs.select(F.col(id_col).alias("sample_id"), F.col(text_col).cast("string").alias("text"), part.alias("part")).where(F.col("part") != HELD_OUT)
    marked = rows.join(sample, "sample_id").select("part", "y", "text")
    field = Field()

    def lines(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [features(t)[0].astype("<f4").tobytes() for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(x, pa.binary())], ["y", "x"])

    def over(one):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield from split_large(batch, one)

        return run

    # at most 2 * per_class documents
    got = marked.where(F.col("part") == TRAINED).mapInArrow(over(lines), "y int, x binary").toArrow()
    y = got.column(0).to_numpy()
    if len(set(y.tolist())) < 2:
        return field
    field.train([np.frombuffer(x, "<f4").reshape(-1, SIZE) for x in got.column(1).to_pylist()], y)
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def values(batch: pa.RecordBatch) -> pa.RecordBatch:
        q = [sent.value.quality(t) for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(q, pa.float64())], ["y", "q"])

    points = marked.where(F.col("part") == FITTED).mapInArrow(over(values), "y int, q double").toArrow()
    field.fit_curve(points.column(1).to_numpy(), points.column(0).to_numpy())
    return field


def score(docs: DataFrame, field: Field, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and score of each row."""
    sent, names = docs.sparkSession.sparkContext.broadcast(field), [*keep, "score"]
    rows = docs.select(*[c.alias(k) for k, c in keep.items()], F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), "score double"])

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [sent.value.score(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got, pa.float64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from split_large(batch, one)

    return rows.mapInArrow(run, schema)
