import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from campanile.llm import quality, toxicity

DOCS = "doc_id long, text string, y int, score double, part long"
LABELS = "doc_id long, quality int, toxic int, text string"


@pytest.mark.parametrize(("name", "label", "mod", "held"), [("op1_toxicity", "toxic", 5, 0), ("op7_quality", "quality", 3, 1)])
def test_held_out_accuracy(spark, name, label, mod, held):
    from campanile.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = QUERIES[name](spark, sf).collect()
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == held)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    tested = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(tested) > 500
    # some labels of the smaller tables mark junk that holds none of the marked words
    assert sum(r.predicted == truth[r.doc_id] for r in tested) / len(tested) > 0.95


def tables(spark):
    rng = np.random.default_rng(1)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    rows, labels = [], []
    for i in range(400):
        bad = i % 2
        text = "\n".join(" ".join(rng.choice(words, 6)) + (" zzgrub" + str(rng.choice(["a", "ing", "s"])) + " !!!" if bad else ".") for _ in range(3))
        rows.append((i, text, 1, 0.1, 7))
        labels.append((i, 1 - bad, bad, "t"))
    rows += [(None, None, 1, 0.1, 7), (1000, "", 1, 0.1, 7), (1001, "\n \n42", 1, 0.1, 7), (1002, "alpha beta. " * 40_000, 1, 0.1, 7), (3, rows[3][1], 1, 0.1, 7)]
    labels += [(0, 0, 0, "t"), (5, None, None, "t"), (None, 1, 1, "t"), (99999, 1, 0, "t")]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows(spark, module):
    docs, labels = tables(spark)
    model = module.fit(docs, labels)
    found = module.score(docs, model, {"doc_id": F.col("doc_id")}).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    got = {r.doc_id: r.score for r in found}
    assert np.mean([(got[i] >= 0.5) == (i % 2 == (1 if module is toxicity else 0)) for i in range(400)]) > 0.95
    empty = module.fit(docs, labels.limit(0))
    assert {r.score for r in module.score(docs, empty, {"doc_id": F.col("doc_id")}).collect()} == {0.0}
    nothing = module.fit(docs.limit(0), labels)
    assert module.score(docs.limit(0), nothing, {"doc_id": F.col("doc_id")}).count() == 0


def test_kneser_ney_sums_to_one():
    grams, n = np.unique(toxicity.codes("the cat that sat on the mat than cot")[0], return_counts=True)
    model = toxicity.Model(grams, n, n[::-1].copy())
    letters = np.unique(grams & toxicity._MASK)
    for context in np.unique(grams >> toxicity._BITS)[:20]:
        asked = context << toxicity._BITS | letters
        shared = np.full(len(asked), 1 / model.letters)
        for k, level in enumerate(model.lower):
            shared = level.probability(asked & ((1 << toxicity._BITS * (k + 1)) - 1), shared)
            assert abs(shared.sum() - 1) < 1e-9
        assert abs(model.tops[0].probability(asked, shared).sum() - 1) < 1e-9


def test_marginals_equal_enumeration():
    from itertools import product

    rng = np.random.default_rng(2)
    field = quality.Field()
    field.weights, field.bias, field.moves = rng.normal(size=quality.SIZE), 0.3, rng.normal(size=(2, 2))
    x = rng.normal(size=(5, quality.SIZE)) / 4
    lift = x @ field.weights + field.bias
    total, good = 0.0, np.zeros(5)
    for ys in product((0, 1), repeat=5):
        p = np.exp(sum(lift[t] * y for t, y in enumerate(ys)) + sum(field.moves[a, b] for a, b in zip(ys, ys[1:])))
        total += p
        good += p * np.array(ys)
    assert np.allclose(field.marginals(x), good / total)


def test_gradient_equals_differences():
    rng = np.random.default_rng(3)
    theta, x = rng.normal(size=quality.SIZE + 5) / 3, rng.normal(size=(3, 4, quality.SIZE))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], dtype=bool)
    y = np.array([1, 0, 1])

    def likelihood(theta):
        from itertools import product

        out = 0.0
        for i in range(3):
            n = mask[i].sum()
            value = lambda ys: sum((x[i, t] @ theta[: quality.SIZE] + theta[quality.SIZE]) * v for t, v in enumerate(ys)) + sum(theta[quality.SIZE + 1 + 2 * a + b] for a, b in zip(ys, ys[1:]))  # noqa: E731, B023
            witness = lambda ys: np.prod([quality.AGREES if v == y[i] else 1 - quality.AGREES for v in ys])  # noqa: E731, B023
            every = list(product((0, 1), repeat=n))
            out += np.log(sum(np.exp(value(ys)) * witness(ys) for ys in every)) - np.log(sum(np.exp(value(ys)) for ys in every))
        return out

    got = quality.Field._gradient(theta, x, mask, y)
    for k in rng.choice(len(theta), 12, replace=False).tolist() + [quality.SIZE, quality.SIZE + 2, quality.SIZE + 3]:
        step = np.zeros_like(theta)
        step[k] = 1e-5
        assert abs((likelihood(theta + step) - likelihood(theta - step)) / 2e-5 - got[k]) < 1e-3


def plain_line(line, lines):
    """A line's own features, counted one by one."""
    import math
    from collections import Counter

    raw, words = line.encode(), line.split()
    letters = "abcdefghijklmnopqrstuvwxyz"
    kinds = [
        sum(chr(b) in letters.upper() for b in raw),
        sum(chr(b) in "0123456789" for b in raw),
        sum(chr(b) in ".!?" for b in raw),
        sum(chr(b) == "!" for b in raw),
        sum(chr(b) in ",;:" for b in raw),
        sum(32 < b < 127 and not (chr(b) in letters + letters.upper() + "0123456789.!?,;:'\"-()") for b in raw),
        sum(chr(b) == "|" for b in raw),
        sum(b > 127 for b in raw),
    ]
    n = len(words) or 1
    return [k / max(1, len(raw)) for k in kinds] + [
        math.log1p(len(raw)),
        math.log1p(len(words)),
        len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        max(Counter(words).values(), default=0) / (n + 4),
        len(raw) / n / 10,
        float(lines.count(line) > 1),
        float(line.rstrip()[-1:] in (".", "!", "?", "")),
    ]


@pytest.mark.parametrize("text", [None, "", " \n\t", "One line.", "A b, c!\n\n\tB | 42 42 ü?\nA b, c!\n(x) -- y's", "word " * 3000 + "\n" + "Z\n" * 500])
def test_features_and_quality_equal_plain_counting(text):
    lines = [x for x in (text or "").split("\n") if x.strip()] or [""]
    own = [plain_line(x, lines) for x in lines]
    edge = [0.0] * quality.OWN
    x, lengths = quality.features(text)
    for t in range(len(lines)):
        expected = own[t] + (own[t - 1] if t else edge) + (own[t + 1] if t + 1 < len(lines) else edge)
        assert np.allclose(x[t], expected)
    assert lengths.tolist() == [max(1, len(line.encode())) for line in lines]
    field = quality.Field()
    field.weights, field.moves = np.random.default_rng(5).normal(size=quality.SIZE), np.array([[0.3, -0.2], [-0.4, 0.5]])
    p = field.marginals(x)
    assert field.quality(text) == pytest.approx(sum(a * b for a, b in zip(p, lengths)) / sum(lengths))


def test_good_and_bad_lines_in_one_document(spark):
    """Labels are of documents that hold both kinds of lines; the field tells the lines apart, and neighbours count."""
    rng = np.random.default_rng(6)
    good = lambda: " ".join(rng.choice(["river", "stone", "light", "water"], 8)) + "."
    bad = lambda: " ".join(["buy"] * 4 + ["NOW", "!!!", "$$$", str(rng.integers(99))])
    odd = lambda: "maybe " + str(rng.choice(["this", "that"]))  # noqa: E731  a line that says nothing of itself
    docs, y = [], []
    for i in range(300):
        label = i % 2
        kinds = [label] * 8 + [1 - label] * 2  # a stretch of the other kind in every document
        docs.append("\n".join(odd() if rng.random() < 0.2 else (good if k else bad)() for k in kinds))
        y.append(label)
    field = quality.Field()
    field.train([quality.features(t)[0] for t in docs], np.array(y))
    assert field.moves[0, 0] + field.moves[1, 1] > field.moves[0, 1] + field.moves[1, 0]
    p = field.marginals(quality.features("\n".join([good() for _ in range(4)] + [bad() for _ in range(4)] + [good() for _ in range(4)]))[0])
    assert p[:3].min() > 0.5 and p[5:7].max() < 0.5 and p[9:].min() > 0.5
    between = lambda kind: field.marginals(quality.features("\n".join([kind() for _ in range(3)] + ["maybe this"] + [kind() for _ in range(3)]))[0])[3]
    assert between(good) > between(bad) + 0.2


def test_every_line_of_a_training_document_counts(spark):
    """Bad lines far beyond the first hundred decide."""
    rows = [(i, "\n".join(["plain words of a line."] * 400 + (["BUY $$$ NOW!!!"] * 400 if i % 2 else ["more words of a line."] * 400)), 1, 0.1, 7) for i in range(60)]
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, 1 - i % 2, 0, "t") for i in range(60)], LABELS)
    field = quality.fit(docs, labels)
    found = quality.score(docs, field, {"doc_id": F.col("doc_id")}).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in found)


def test_kneser_ney_equals_plain_formulas():
    """Absolute discounting of the class's counts over shared continuation counts, recomputed with strings."""
    from collections import Counter, defaultdict

    toxic, ordinary, other = "bad badder worst bad", "good gold god day", "bead goad bold"
    grams = lambda text: [("^" + w + "$")[max(0, i - 4) : i + 1] for w in text.split() for i in range(1, len(w) + 2)]
    every = Counter(grams(" ".join([toxic, ordinary, other])))
    letters = {g[-1] for g in every}

    def levels():
        out = []
        for k in range(1, 5):  # of k characters, each different character before makes one
            longer = {g[-(k + 1) :] for g in every if len(g) > k}
            out.append(Counter(x[1:] for x in longer))
        return out

    lower = levels()

    def discounted(counts, gram):
        once, twice = sum(v == 1 for v in counts.values()), sum(v == 2 for v in counts.values())
        d = once / (once + 2 * twice) if once and twice else 0.5
        same = {g: v for g, v in counts.items() if g[:-1] == gram[:-1]}
        total = sum(same.values())
        return (max(counts.get(gram, 0) - d, 0) / total, d * len(same) / total) if total else (0.0, 1.0)

    def shared(gram):
        p = 1 / max(2, len(letters))
        for k in range(1, max(len(gram) - 1, 1) + 1):
            own, left = discounted(lower[k - 1], gram[-k:])
            p = own + left * p
        return p

    def ratio(gram):
        out = []
        for text in (toxic, ordinary):
            own, left = discounted(Counter(grams(text)), gram)
            out.append(np.log(own + left * shared(gram)))
        return out[0] - out[1]

    code = defaultdict(int)
    for g in every:
        for c in g:
            code[g] = code[g] << toxicity._BITS | (32 if c in "^$" else ord(c))
    keys = np.array([code[g] for g in every])
    assert set(keys.tolist()) == set(toxicity.codes(" ".join([toxic, ordinary, other]))[0].tolist())
    count = lambda text: np.array([Counter(grams(text))[g] for g in every])
    model = toxicity.Model(keys, count(toxic), count(ordinary))
    assert np.allclose(model.compare(keys), [ratio(g) for g in every])


def test_ratios_of_every_gram(spark):
    """Tables and the model in memory agree, on grams that were counted and on others; none is left out."""
    rng = np.random.default_rng(4)
    text = [" ".join("".join(rng.choice(list("abcdefgh"), rng.integers(1, 8))) for _ in range(150)) for _ in range(4)]
    docs = spark.createDataFrame([(text[0], 1), (text[1], 0), (text[2], None)], "text string, y int")
    grams = toxicity.gram_counts(docs).select("gram", "toxic", "ordinary", F.lit(1).alias("known"))
    got = grams.toPandas()
    every = np.unique(toxicity.codes(" ".join(text[:3]))[0])
    assert set(got.gram) == set(every.tolist())
    model = toxicity.Model(*(got[c].to_numpy() for c in ("gram", "toxic", "ordinary")))
    asked = np.unique(toxicity.codes(text[3])[0])
    assert len(np.setdiff1d(asked, every)) > 100
    pairs = spark.createDataFrame([(7, int(g)) for g in np.r_[asked, every]], "block long, gram long")
    found = toxicity.Fitted(toxicity.written(grams, "grams")).ratios_of(pairs).toPandas()
    assert len(found) == len(asked) + len(every) and set(found.block) == {7}
    assert np.allclose(found.llr, model.compare(found.gram.to_numpy()), rtol=1e-9, atol=1e-9)


def test_no_gram_is_dropped_past_a_million(spark):
    """A table of more than 1,000,000 grams keeps all of them, with exact continuation counts."""
    n = 1_100_000
    letters = lambda k: (F.lit(97) + F.pmod(F.floor(F.col("id") / F.lit(26**k)), F.lit(26))).cast("long")
    gram = sum((letters(k) * F.lit(1 << toxicity._BITS * k) for k in range(5)), F.lit(0)).cast("long")
    zero = lambda x: F.when(F.col("id") % 2 == x, 1).otherwise(0).cast("long")
    grams = spark.range(n).select(gram.alias("gram"), zero(0).alias("toxic"), zero(1).alias("ordinary"), F.lit(1).alias("known"))
    model = toxicity.Fitted(toxicity.written(grams, "grams"))
    assert model.known.count() == n and model.known.select("gram").distinct().count() == n
    got = grams.select("gram", "toxic", "ordinary").toPandas()
    held = toxicity.Model(*(got[c].to_numpy() for c in ("gram", "toxic", "ordinary")))
    some = model.known.where("gram % 997 = 0").toPandas()
    assert len(some) > 500 and np.allclose(some.llr, held.compare(some.gram.to_numpy()), rtol=1e-9, atol=1e-9)


def test_letters_stay_different():
    """Each letter has codes of its own, so far ones are not taken for those with the same lowest bits, nor for a blank."""
    from campanile.llm.language import _letters

    every = [chr(c) for c in np.flatnonzero(_letters())]
    every = [c for c in every if c.lower() == c]
    assert len({toxicity.codes(c)[0].tobytes() for c in every}) == len(every) > 100_000
    grams, words = toxicity.codes("a\u5061b \u5020\u5020 \u5061")
    assert len(words) == 3 and len(toxicity.words_of("a\u5061b \u5020\u5020 \u5061")) == 3
    assert np.diff(np.r_[words, len(grams)]).tolist() == [5, 5, 3]
    assert ((grams & toxicity._MASK) > 0).all()
