"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: what every match must contain.
Texts are indexed in segments (a slice of a batch): each wanted trigram's posting list names the segment's texts
that hold it, lists are united and intersected as the query says, and the expression runs on the candidates only.
A rule without mandatory trigrams, such as a run of hex digits, has the query "everything" and scans every text.

The index folds A-Z to lower case, so it serves both kinds of rule; it holds the trigrams of the rules' queries
only, and a segment is bounded in bytes, so its size doesn't depend on the table. Nothing is shuffled.

Defined cases: a null text counts as empty and has no spans. Matches are leftmost and non-overlapping within a rule;
one whose value is shorter than the rule's ``least`` is dropped, but has used up its text. Spans count code points,
end exclusive, and are ordered by start, then by the order of the rules. Every row gets an answer of its own, repeated
ones too; a text of any length is scanned whole, in linear time. Other columns, whatever their names, are not looked at. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campanile.llm.common import split_large

try:  # the library's own parser; where it is not to be had, every rule scans all texts
    from re import _constants as op
    from re import _parser as parser
except ImportError:
    op = parser = None

#: A query: True (anything), a trigram, or ("and" | "or", queries).
Query = bool | bytes | tuple
#: Strings are multiplied out up to so many.
_MOST = 64


def both(kind: str, parts: list[Query]) -> Query:
    """The conjunction or disjunction, simplified."""
    if kind == "and":
        parts = [p for p in parts if p is not True]
    elif any(p is True for p in parts):
        return True
    parts = list(dict.fromkeys(parts))
    if kind == "or":  # what asks for more than another alternative adds nothing
        needs = [frozenset(p[1]) if isinstance(p, tuple) and p[0] == "and" else frozenset([p]) for p in parts]
        parts = [p for p, n in zip(parts, needs, strict=True) if not any(m < n for m in needs)]
    return True if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def of_strings(strings: frozenset[str]) -> Query:
    """What holds of a text that contains one of the strings."""
    raw = [s.encode() for s in sorted(strings)]
    return both("or", [both("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in raw])


def _class_chars(items: list, fold: bool) -> frozenset[str] | None:
    """The few characters of a class, or None."""
    out: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(chr(value))
        elif kind is op.RANGE and value[1] - value[0] < 8:
            out.update(map(chr, range(value[0], value[1] + 1)))
        else:
            return None
    return _folded(out, fold) if len(out) <= 8 else None


def _folded(chars: set[str], fold: bool) -> frozenset[str] | None:
    """Lower-cased A-Z as in the index; letters whose case ASCII doesn't settle can't be told."""
    if fold and not all(c.isascii() for c in chars):
        return None
    return frozenset(c.lower() if c.isascii() else c for c in chars)


def _walk(nodes: Sequence, fold: bool) -> tuple[frozenset[str] | None, Query]:
    """(exact strings if they are few, query) of a sequence of parsed nodes."""
    exact: frozenset[str] = frozenset([""])
    found: list[Query] = []
    whole = True
    for node in nodes:
        strings, query = _node(node, fold)
        found.append(query)
        if strings is not None and len(exact) * len(strings) <= _MOST:
            exact = frozenset(a + b for a, b in product(exact, strings))
            continue
        found.append(of_strings(exact))
        whole = False
        exact = strings if strings is not None else frozenset([""])
    if whole:
        return exact, both("and", found)
    return None, both("and", [*found, of_strings(exact)])


def _node(node: tuple, fold: bool) -> tuple[frozenset[str] | None, Query]:
    kind, value = node
    if kind is op.LITERAL:
        return _folded({chr(value)}, fold), True
    if kind is op.IN:
        return _class_chars(value, fold), True
    if kind is op.SUBPATTERN:
        _, on, off, inner = value
        return _walk(inner, (fold or bool(on & re.IGNORECASE)) and not off & re.IGNORECASE)
    if kind is op.BRANCH:
        parts = [_walk(x, fold) for x in value[1]]
        if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= _MOST:
            return frozenset().union(*(s for s, _ in parts)), True
        return None, both("or", [both("and", [q, True if s is None else of_strings(s)]) for s, q in parts])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, inner = value
        strings, query = _walk(inner, fold)
        if least == 0:
            return (strings | {""}, True) if strings is not None and most == 1 else (None, True)
        if strings is not None and least == most and len(strings) ** least <= _MOST:
            return frozenset("".join(x) for x in product(strings, repeat=least)), query
        return None, both("and", [query, True if strings is None else of_strings(strings)])
    if kind is op.AT:
        return frozenset([""]), True
    return None, True  # look-arounds, back-references, any character: nothing is known


def trigram_query(pattern: str) -> Query:
    """What the lower-cased text of any match contains."""
    if parser is None:
        return True
    parsed = parser.parse(pattern)
    strings, query = _walk(parsed, bool(parsed.state.flags & re.IGNORECASE))
    return both("and", [query, True if strings is None else of_strings(strings)])


def trigrams_in(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set().union(*map(trigrams_in, query[1])) if isinstance(query, tuple) else set()


@dataclass(frozen=True)
class Rule:
    """A kind of secret; the value (a group, 0: the match) has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    @cached_property
    def query(self) -> Query:
        return trigram_query(self.pattern)

    @cached_property
    def spans(self):
        found, group, least = re.compile(self.pattern).finditer, self.group, self.least
        return lambda text: [m.span() for m in found(text) if m.end(group) - m.start(group) >= least]


#: The base kinds, in the order they are listed. A run of hex digits that is long enough is a whole run, so its least
#: length can stand in the expression.
BASE = (
    Rule("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    # every rule reads a text in linear time: a run of its characters is entered once, or its length is bounded
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class Segment:
    """An inverted index of the wanted trigrams over some texts."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, wanted: Sequence[bytes]) -> None:
        """data: the texts' bytes end to end; ends: where each ends."""
        self.texts = len(ends)
        codes = np.array(sorted(int.from_bytes(t, "big") for t in wanted), dtype=np.int64)
        self.lists: dict[bytes, np.ndarray] = {}
        low = _FOLD[data]
        pairs = np.zeros(1 << 16, dtype=bool)
        pairs[codes >> 8] = True
        at = np.flatnonzero(pairs[low[:-2].astype(np.uint16) << 8 | low[1:-1]]) if len(low) > 2 else np.zeros(0, dtype=np.int64)
        code = low[at].astype(np.int64) << 16 | low[at + 1].astype(np.int64) << 8 | low[at + 2]
        text = np.searchsorted(ends, at, side="right")
        inside = at + 2 < ends[text] if len(at) else np.zeros(0, dtype=bool)
        code, text = code[inside], text[inside]
        for c in codes.tolist():
            self.lists[c.to_bytes(3, "big")] = np.unique(text[code == c])

    def candidates(self, query: Query) -> np.ndarray:
        """The texts that satisfy a query, in order."""
        if query is True:
            return np.arange(self.texts)
        if isinstance(query, bytes):
            return self.lists[query]
        kind, parts = query
        join = np.union1d if kind == "or" else lambda a, b: np.intersect1d(a, b, assume_unique=True)
        return reduce(join, sorted(map(self.candidates, parts), key=len))


def scan_texts(column: pa.Array, rules: Sequence[Rule]) -> list[list[tuple[int, int, int]]]:
    """Of each text the spans (start, end, number of the rule), ordered."""
    raw = column.cast(pa.large_binary()).fill_null(b"")
    raw = pa.concat_arrays([raw])  # without an offset
    _, bounds, data = raw.buffers()
    ends = np.frombuffer(bounds, dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    size = int(ends[-1] - ends[0])
    flat = np.frombuffer(data, dtype=np.uint8, count=size, offset=int(ends[0])) if size else np.zeros(0, dtype=np.uint8)
    segment = Segment(flat, ends[1:] - ends[0], sorted(set().union(*(trigrams_in(r.query) for r in rules))))
    texts = column.cast(pa.large_string()).fill_null("")
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(raw))]
    decoded: dict[int, str] = {}
    for k, rule in enumerate(rules):
        for i in segment.candidates(rule.query).tolist():
            if (text := decoded.get(i)) is None:
                text = decoded[i] = texts[i].as_py()
            found[i] += [(a, b, k) for a, b in rule.spans(text)]
    return [sorted(f, key=lambda x: (x[0], x[2])) for f in found]


def scan(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) for each row."""
    kinds = [r.kind for r in rules]
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[{"kind": kinds[k], "start": a, "end": b} for a, b, k in f] for f in scan_texts(batch.column(1), rules)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, shape)], ["id", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from split_large(batch, one)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, spans array<struct<kind string, start long, end long>>")


def redact(text: str, spans: Sequence[tuple[int, int, str]], mark: str = "[{kind}]") -> str:
    """The text with every span replaced; overlapping spans are replaced as one."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], mark.format(kind=kind)]
        at = max(at, end)
    return "".join([*out, text[at:]])


def base_digest(spans: Sequence[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()
