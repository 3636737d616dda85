import zlib
from collections import Counter

from pyspark.sql import functions as F

from campanile.llm import language

DOCS = "doc_id long, text string, lang string, score double, lang_pred string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, 0.5, "x") for i, t, lang in rows], DOCS)


def test_grams_equal_counting_words():
    import regex

    text = "Don't STOP, él-Niño 42 Ünder_score ab\x00cd"
    expected = []
    for w in regex.findall(r"\p{L}+", text.lower()):
        p = f" {w} "
        expected += list(w) + [p[i : i + 2] for i in range(len(p) - 1)] + [p[i : i + 3] for i in range(len(p) - 2)]
    code = lambda g: sum(ord(c) << 21 * (2 - k) for k, c in enumerate(g))
    assert sorted(language.grams(text).tolist()) == sorted(map(code, expected))
    assert len(language.grams(" 12 _ ²")) == 0


def plain_grams(text):
    import regex

    out = Counter()
    for w in regex.findall(r"\p{L}+", text.lower()):
        p = f" {w} "
        out.update([*w, *(p[i : i + 2] for i in range(len(p) - 1)), *(p[i : i + 3] for i in range(len(p) - 2))])
    return out


def plain_profile(counts, size):
    key = lambda g: [*map(ord, g), 0, 0][:3]
    return sorted(counts, key=lambda g: (-counts[g], key(g)))[:size]


def plain_predictions(learned, texts, size=language.SIZE, document_size=language.DOCUMENT_SIZE):
    counts = {}
    for text, lang in learned:
        counts.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {lang: {g: r for r, g in enumerate(plain_profile(c, size))} for lang, c in counts.items()}
    out = []
    for text in texts:
        own = plain_profile(plain_grams(text or ""), document_size)
        distance = {lang: sum(min(size, abs(p[g] - r)) if g in p else size for r, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(distance), key=distance.get, default="und") if own else "und"
        out.append((best, 1 - distance[best] / (size * len(own)) if best in distance and own else 0.0))
    return out


def test_ranks_distances_and_ties_equal_plain_counting(spark):
    """Profiles of every n-gram's count, ranks with ties by code point, distances and scores, on the smallest documents."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    learned = [(r.text, r.lang) for r in rows if r.doc_id % 2 and r.text is not None and r.lang is not None]
    odd = [(10**6, "", "en"), (10**6 + 1, None, "en"), (10**6 + 2, "42", "en"), (10**6 + 3, "z", "en"), (10**6 + 4, "中文字", "en"), (10**6 + 5, "ab ab", "en")]
    table = docs(spark, [(r.doc_id, r.text, r.lang) for r in rows] + odd)
    for size in (language.SIZE, 30):
        model = language.fit(table.where("doc_id % 2 = 1 and doc_id < 1000000"), size=size, document_size=size)
        found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(table, model, {"doc_id": F.col("doc_id")}).collect()}
        ids, texts = [r.doc_id for r in rows] + [o[0] for o in odd], [r.text for r in rows] + [o[1] for o in odd]
        for i, (lang, score) in zip(ids, plain_predictions(learned, texts, size, size)):
            assert found[i][0] == lang and abs(found[i][1] - score) < 1e-12


def test_equal_distances_go_to_the_first_language():
    of = {lang: language.grams("abc").tolist() for lang in ("xx", "aa", "mm")}
    assert language.Profiles(of).predict("abc")[0] == "aa"


def test_held_out_accuracy(spark):
    from campanile.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    found = QUERIES["op6_language"](spark, sf).collect()
    assert {r.doc_id for r in found} == set(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_odd_rows(spark):
    table = docs(spark, [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "de"), (4, "...42", None), (None, "the dog", None), (1, "the cat and the dog", "en"), (6, "und " * 50_000, None), (7, "", "en")])
    model = language.fit(table)
    found = language.identify(table, model, {"doc_id": F.col("doc_id")}).collect()
    got = sorted((str(r.doc_id), r.lang_pred) for r in found)
    assert got == [("1", "en"), ("1", "en"), ("2", "de"), ("3", "und"), ("4", "und"), ("6", "de"), ("7", "und"), ("None", "en")]
    stay = language.keep_identified(table, model)
    assert stay.columns == table.columns and stay.count() == 5
    nothing = language.fit(table.limit(0))
    assert language.identify(table.limit(0), nothing, {"doc_id": F.col("doc_id")}).count() == 0
    assert {r.lang_pred for r in language.identify(table, nothing, {"doc_id": F.col("doc_id")}).collect()} == {"und"}


def test_rows_stay_when_no_language_is_named(spark):
    rows = docs(spark, [(1, "plain words", None), (2, "42 !", None), (3, None, None), (4, "", None), (5, "élan", None)])
    model = language.fit(rows)
    assert not model.langs
    assert sorted(r.doc_id for r in language.keep_identified(rows, model).collect()) == [1, 5]
