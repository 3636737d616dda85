import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from campanile.llm import simhash
from campanile.llm.queries import mixture_sql
from test_language import plain_predictions
from test_packing import verify
from test_simhash import _parts

SF = "/root/testdata/sf0.001"


def keep_language(rows):
    learned = [(r["text"], r["lang"]) for r in rows if r["text"] is not None and r["lang"] is not None]
    out = []
    for r, (lang, score) in zip(rows, plain_predictions(learned, [r["text"] for r in rows])):
        if lang != "und" and score >= corpus_pipeline.LEAST_LANGUAGE_SCORE:
            out.append(r | {"lang": lang})
    return out


def keep_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0d]", "", r["text"])].append(r)
    return [min(g, key=lambda r: (-len(r["text"]), r["doc_id"])) for g in groups.values()]


def keep_near(rows):
    """Every pair compared by both fingerprints, over all distances that the stage may link."""
    sk = [simhash.sketch(r["text"].encode(), simhash.WordHashes()) for r in rows]
    bits = lambda a, b, part: int(np.bitwise_count(sk[a][part] ^ sk[b][part]).sum())
    links = [(a, b) for a in range(len(rows)) for b in range(a) if bits(a, b, slice(0, 1)) <= simhash.FAR and bits(a, b, slice(1, 5)) <= simhash.WIDE]
    parts, least = _parts(len(rows), links), {}
    for r, p in zip(rows, parts):
        least[p] = min(least.get(p, r["doc_id"]), r["doc_id"])
    return [r for r, p in zip(rows, parts) if least[p] == r["doc_id"]]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    some = docs.where("length(text) > 400").first().text
    odd = [(10**6, None, "en", "src1", 0), (10**6 + 1, "12 34", None, None, 5), (10**6 + 2, "", "en", "src2", 0), (10**6 + 3, "Совсем другой язык", "en", "src2", 0)]
    odd += [(10**6 + 4, some + " and a word", None, "src3", 0), (10**6 + 4, some + " and a word", None, "src3", 0), (10**6 + 5, "the same words again " * 30_000, None, None, 0)]
    extra = spark.createDataFrame(odd, docs.schema)
    docs = docs.unionByName(extra)
    rows = [r.asDict() for r in docs.collect()]
    ids = lambda rs: Counter(r["doc_id"] for r in rs)
    columns = docs.columns
    for k, brute in enumerate((keep_language, keep_exact, keep_near)):
        docs = corpus_pipeline.STAGES[k][1](spark, docs, SF)
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = brute(rows)
        assert docs.columns == columns and ids(r.asDict() for r in docs.collect()) == ids(rows)
        assert {(r.doc_id, r.lang) for r in docs.collect()} == {(r["doc_id"], r["lang"]) for r in rows}
    kept = f"{tmp_path}/2/*.parquet"
    chosen = duckdb.sql(f"WITH {mixture_sql(f'{chr(39)}{kept}{chr(39)}')} SELECT id, times FROM chosen WHERE times > 0").fetchall()
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, SF)
    assert mixed.columns == columns and ids(r.asDict() for r in mixed.collect()) == Counter(dict(chosen))
    pieces = [r.asDict() for r in corpus_pipeline.STAGES[4][1](spark, mixed.dropDuplicates(["doc_id"]), SF).collect()]
    texts = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] in dict(chosen)}
    verify(pieces, texts, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 4096)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 100


def test_clashing_columns_and_null_ids(spark):
    """Columns with names that operators use inside are passed on by every stage; rows with null ids are carried through."""
    names = "id row fp of_text kept component gone_id sha maybe word bits chars times epochs last domain of_lang queue n before at".split()
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    docs = docs.unionByName(spark.createDataFrame([(None, "The words of a document without an id, and some more of them.", None, None, None)], docs.schema))
    for k in names:
        docs = docs.selectExpr("*", f"'{k}' AS `{k}`")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), "clash")
        assert docs.columns == columns and docs.where(" AND ".join(f"`{k}` = '{k}'" for k in names)).count() == docs.count() > 0
        if name != "mixing":
            assert docs.where("doc_id IS NULL").count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
