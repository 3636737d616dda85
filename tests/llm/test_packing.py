import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from campanile.llm import packing, tokens

FILE = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, source string, n long, ids string, row string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def verify(pieces, texts, library, window):
    """pieces: dicts; texts: doc_id -> text. Every id once, windows without gaps, little padding."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    assert set(by_doc) == set(texts)
    for doc, ps in by_doc.items():
        ids = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for p in sorted(ps, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for k, (seq, ps) in enumerate(sorted(by_seq.items())):
        assert seq == k
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == window or seq == max(by_seq)


def test_query_is_an_exact_round_trip(spark, library):
    from campanile.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    verify([r.asDict() for r in QUERIES["op10_packing"](spark, sf).collect()], texts, library, 4096)


def test_mixture_holds_at_every_point(spark):
    rows = [(i, "word " * (i % 90 + 1), f"s{0 if i % 3 else i % 7}", 0, "", "") for i in range(3000)]
    out = packing.pack(spark.createDataFrame(rows, DOCS), FILE, window=512, packet=32).collect()
    source = {r[0]: r[2] for r in rows}
    total = defaultdict(int)
    for p in out:
        total[source[p.doc_id]] += p.length
    everything, got, seen = sum(total.values()), defaultdict(int), 0
    for p in sorted(out, key=lambda p: (p.sequence_id, p.offset)):
        got[source[p.doc_id]] += p.length
        seen += p.length
        for s in total:
            assert abs(got[s] - seen * total[s] / everything) <= 512 + 2 * 32


def test_odd_rows(spark, library):
    rows = [(1, None, "a"), (2, "", None), (3, "x " * 9000, None), (5, "Ü<|endoftext|> don't ́a", "a")]
    docs = spark.createDataFrame([(i, t, s, 1, "", "") for i, t, s in rows], DOCS)
    out = [r.asDict() for r in packing.pack(docs, FILE, window=64).collect()]
    verify(out, {i: t for i, t, _ in rows}, library, 64)
    twice = packing.pack(docs.union(docs), FILE).collect()
    assert sum(r.length for r in twice) == 2 * sum(r["length"] for r in out)
    assert packing.pack(docs.limit(0), FILE).count() == 0
    null_id = packing.pack(spark.createDataFrame([(None, "a", "b", 1, "", "")], DOCS), FILE).collect()
    assert [(r.doc_id, r.length) for r in null_id] == [(None, 2)]


def test_weights_and_sequences(spark):
    rows = [(i, "word " * 50, "a" if i % 2 else "b", 0, "", "") for i in range(400)]
    pieces = packing.pack(spark.createDataFrame(rows, DOCS), FILE, window=1024, packet=64, weights={"a": 3, "b": 1}, with_ids=True)
    source = {r[0]: r[2] for r in rows}
    first = [p for p in pieces.collect() if p.sequence_id < 8]
    a = sum(p.length for p in first if source[p.doc_id] == "a")
    assert abs(a / sum(p.length for p in first) - 0.75) < 0.03
    whole = packing.sequences(pieces, 1024).collect()
    assert all(len(r.ids) == 1024 or (len(r.ids) & (len(r.ids) - 1)) == 0 for r in whole)
    assert sum(r.used for r in whole) == 400 * 51


def test_windows_hold_the_targets_until_a_source_ends(spark):
    """By the tree's target shares, on the documents: every window and every prefix is near them while all sources last."""
    from campanile.llm.queries import target_shares

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    source = {r.doc_id: r.source for r in docs.collect()}
    out = sorted(packing.pack(docs, FILE, weights=target_shares()).collect(), key=lambda p: (p.sequence_id, p.offset))
    names = sorted(set(source.values()))
    weight = {s: (8.0 if s == "src0" else 1.0) for s in names}
    group = {s: "web" if s[-1] < "4" else "books" if s[-1] < "7" else "code" for s in names}
    target = {s: {"web": 5, "books": 3, "code": 2}[group[s]] * weight[s] / sum(weight[x] for x in names if group[x] == group[s]) for s in names}
    whole = sum(target.values())
    left, got, seen, windows = defaultdict(int), defaultdict(int), 0, defaultdict(lambda: defaultdict(int))
    for p in out:
        left[source[p.doc_id]] += p.length
    rounds = min(left[s] / target[s] for s in names) * whole / packing.WINDOW - 2  # full rounds of all sources
    assert rounds > 20
    for p in out:
        if p.sequence_id >= rounds:
            break
        windows[p.sequence_id][source[p.doc_id]] += p.length
        got[source[p.doc_id]] += p.length
        seen += p.length
        assert all(abs(got[s] - seen * target[s] / whole) <= packing.WINDOW * target[s] / whole + 2 * packing.PACKET + 1 for s in names)
    off = [sum(abs(w[s] / packing.WINDOW - target[s] / whole) for s in names) / 2 for w in windows.values()]
    assert sum(off) / len(off) < 0.35 and len(off) > 20


def test_odd_weights(spark):
    rows = spark.createDataFrame([("=a", 5), ("=b", 7), ("null", 1), ("=", 2)], "queue string, n long")
    shares = lambda w: {r.queue: r.quantum for r in packing.quanta(rows, 100, w).collect()}
    assert shares({"a": 6, "b": 2}) == {"=a": 50.0, "=b": pytest.approx(100 / 6), "null": pytest.approx(100 / 6), "=": pytest.approx(100 / 6)}
    assert shares({"a": 0, "b": -1}) == dict.fromkeys(("=a", "=b", "null", "="), 25.0)
    assert sum(shares(None).values()) == pytest.approx(100)


def test_pieces_equal_the_library(library):
    model = tokens.PieceTokenizer(open(FILE).read(), keep=50)
    rng = np.random.default_rng(3)
    letters = list("abcdefghil ,.!'sztre123éèñß½×\xa0\x85İıŉΣς\x1c")
    for _ in range(3000):
        text = "".join(rng.choice(letters, 40))
        assert np.frombuffer(model.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
