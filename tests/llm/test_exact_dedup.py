import hashlib
import re

from campanile.llm import exact_dedup

DOCS = "doc_id long, text string, sha string, size long, word string, row string"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, "w", "r") for i, t in rows], DOCS)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), -1 if i is None else i))
    out = []
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0d]", "", t or "")
        best = min(groups[key])
        mine = (-len(t or ""), -1 if i is None else i)
        out.append((i, None if best[1] == -1 else best[1], len(groups[key]), mine == best, hashlib.sha256(key.encode()).hexdigest()))
    return out


ROWS = [(4, "a b"), (2, "ab"), (7, "a  b"), (9, "a\n\nb"), (1, None), (3, ""), (5, " \t\x0b"), (None, "ab c"), (6, "abc"), (8, "ü x"), (10, "üx"), (4, "a b"), (11, "z" * 300_000)]


def test_annotate(spark):
    found = exact_dedup.annotate(make(spark, ROWS))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, brute(ROWS)))


def test_tiny_filter_stays_exact(spark):
    rows = [(i, f"text {i % 700}") for i in range(1000)]
    found = exact_dedup.annotate(make(spark, rows), max_bits=64)
    assert sorted(map(tuple, found.collect())) == sorted(brute(rows))


def test_drop_repeats(spark):
    docs = make(spark, ROWS + [(20, "q"), (20, "q")])
    stay = exact_dedup.drop_repeats(docs)
    assert stay.columns == docs.columns
    expected = {i for i, _, _, kept, _ in brute(ROWS) if kept} | {20}
    got = [r.doc_id for r in stay.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_empty(spark):
    assert exact_dedup.annotate(make(spark, [])).count() == 0
    assert exact_dedup.drop_repeats(make(spark, [])).count() == 0


def test_plan_is_native_and_unique_rows_do_not_shuffle(spark):
    plan = exact_dedup.drop_repeats(make(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
