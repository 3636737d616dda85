import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from campanile.llm import mixing

DOCS = "doc_id long, text string, dom string, lang string, source string, n long, epochs string, last string, row string"
WEIGHTS = {"domain": {"a": 3, "b": 1, "z": 0}, "lang": {"en": 2}, "source": {}}


def levels():
    return {"domain": F.col("dom"), "lang": F.col("lang"), "source": F.col("source")}


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))


def fill(budget, children):
    """children: name -> (weight, room). Exact water-filling, rounded like the operator: filled ones whole, the rest by running quotas."""
    live = {k: v for k, v in children.items() if v[0] > 0}
    out, left, open_ = dict.fromkeys(children, 0), budget, dict(live)
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [k for k, (w, room) in open_.items() if room <= Fraction(left * w, total)]
        if not full:
            break
        k = min(full, key=lambda k: (Fraction(open_[k][1], open_[k][0]), k))
        out[k] = open_[k][1]
        left -= open_[k][1]
        del open_[k]
    total, up = sum(w for w, _ in open_.values()), 0
    for k in sorted(open_, key=lambda k: (open_[k][1] / open_[k][0], k)):
        w = open_[k][0]
        out[k] = max(left, 0) * (up + w) // total - max(left, 0) * up // total
        up += w
    return out


def brute(rows, share=(3, 4), epochs=2, seed=11):
    docs = [(i, (d or "", lang or "", s or ""), words(t)) for i, t, d, lang, s in rows]
    tokens = defaultdict(int)
    for _, leaf, n in docs:
        tokens[leaf] += n
    budgets = {(): sum(tokens.values()) * share[0] // share[1]}
    for depth, level in enumerate(("domain", "lang", "source")):
        nxt = {}
        for node, budget in budgets.items():
            children = defaultdict(int)
            for leaf, n in tokens.items():
                if leaf[:depth] == node:
                    children[leaf[depth]] += n * epochs
            got = fill(budget, {k: (WEIGHTS[level].get(k, 1), room) for k, room in children.items()})
            nxt |= {(*node, k): b for k, b in got.items()}
        budgets = nxt
    out = Counter()
    for leaf, budget in budgets.items():
        whole, rest = divmod(budget, tokens[leaf]) if tokens[leaf] else (0, 0)
        key = lambda i: hashlib.md5(f"{seed}:{whole}:{'' if i is None else i}".encode()).hexdigest()  # noqa: B023, E731
        mine, before = defaultdict(list), 0
        for i, at, n in docs:
            if at == leaf:
                mine[key(i)].append((i, n))
        for k in sorted(mine):
            times = whole + (before < rest)
            out.update({(i, leaf, e): 0 for i, _ in mine[k] for e in range(times)})
            for i, _ in mine[k]:
                for e in range(times):
                    out[(i, leaf, e)] += 1
            before += sum(n for _, n in mine[k])
    return +out


def rows(n=300):
    out = [(i, "w " * (i * 7 % 50 + 1), "abz"[i % 3 if i % 5 else 0], ("en", "de", "fr")[i % 7 % 3], f"s{i % 2}") for i in range(n)]
    out += [(1000, None, "a", "en", "s0"), (1001, "", None, None, None), (1002, " \t\n", "b", "xx", "empty"), (None, "null id", "b", "de", "s1"), (7, out[7][1], *out[7][2:]), (1003, "x " * 5000, "b", "it", "long")]
    return out


def make(spark, data):
    return spark.createDataFrame([(i, t, d, lang, s, 1, "e", "l", "r") for i, t, d, lang, s in data], DOCS)


@pytest.mark.parametrize("data", [rows(), rows(10), rows(300)[100:140]])
def test_equals_brute_force(spark, data):
    got = Counter((r.id, (r.domain, r.lang, r.source), r.epoch) for r in mixing.select(make(spark, data), levels(), WEIGHTS).collect())
    assert got == brute(data)


def test_mix_repeats_documents_and_keeps_columns(spark):
    docs = make(spark, rows())
    mixed = mixing.mix(docs, levels(), WEIGHTS)
    assert mixed.columns == docs.columns
    expected = Counter()
    for (i, _, _), n in brute(rows()).items():
        expected[i] += n
    assert Counter(r.doc_id for r in mixed.collect()) == expected and max(expected.values()) > 1


def test_shares_follow_weights(spark):
    data = [(i, "w " * 10, "ab"[i % 2], "en", "s") for i in range(2000)]
    got = Counter(r.domain for r in mixing.select(make(spark, data), levels(), WEIGHTS, budget_share=(1, 2)).collect())
    assert abs(got["a"] / got["b"] - 3) < 0.05


@pytest.mark.parametrize("text", [None, "", " ", "a", " a  b\n", "\x0bx\x0cy\r", "ü v w", "a\x1cb"])
def test_words(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(mixing.words(F.col("t")).alias("n")).first().n == words(text)


def test_empty(spark):
    assert mixing.select(make(spark, []), levels(), WEIGHTS).count() == 0 and mixing.mix(make(spark, []), levels(), WEIGHTS).count() == 0
