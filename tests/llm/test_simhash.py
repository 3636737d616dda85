import random

import numpy as np
import pytest
import xxhash

from campanile.llm import simhash
from campanile.llm.components import components

DOCS = "doc_id long, text string, lang string, fp string, component string"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, distance=4):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, fx in zip(ids, fps):
        for y, fy in zip(ids, fps):
            if bin(fx ^ fy).count("1") <= distance and (a := root(x)) != (b := root(y)):
                up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_points(n, seed):
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        x = rng.choice(out)
        for b in rng.sample(range(64), rng.randint(1, 7)):
            x ^= 1 << b
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("text", [None, "", " \n", "a", "A b", "a B c d", "a b c d e", "x " * 500, "Ä ö ü \x1c b c d e f g"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("cell_rows", [50_000, 3])
@pytest.mark.parametrize("groups", [5, 6, 8, None])
def test_links_connect_what_brute_force_connects(spark, cell_rows, groups):
    fps = near_points(120, seed=groups or 1)
    points = spark.createDataFrame([(i, int(np.uint64(f).astype(np.int64))) for i, f in enumerate(fps)], "vertex long, fp long")
    found = dict(components(simhash.links(points, masks=simhash.grids(groups) if groups else (), cell_rows=cell_rows)).collect())
    assert {i: found.get(i, i) for i in range(len(fps))} == brute_components(range(len(fps)), fps)


def test_link_cell_finds_links_between_groups():
    rng = random.Random(7)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 300:
        x = rng.choice(sorted(fps))
        for b in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << b
        fps.add(x)
    fp = np.array(sorted(fps), dtype=np.uint64)
    links = simhash.link_cell(simhash._Rows(fp, 4))
    assert len(links) < len(fp)
    assert all(bin(int(fp[a]) ^ int(fp[b])).count("1") <= 4 for a, b in links)
    up = {i: i for i in range(len(fp))}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(root(a), root(b))] = min(root(a), root(b))
    assert {i: root(i) for i in range(len(fp))} == brute_components(range(len(fp)), fp.tolist())


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base + " x"), (9, "other words entirely here now"), (None, base), (7, None), (8, ""), (2, " \t"), (9, "other words entirely here now")]
    docs = spark.createDataFrame([(i, t, "en", "f", "c") for i, t in rows], DOCS)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    ids = [i for i, _ in rows if i is not None]
    expected = brute_components(ids, [brute_fingerprint(t) for i, t in rows if i is not None])
    for r in found:
        if r.id is not None:
            assert r.component == expected[r.id]
    stay = simhash.drop_near_duplicates(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.where("doc_id is not null").collect()) == sorted(i for i in ids if expected[i] == i)


def test_link_cell_with_far_and_wide_fingerprints():
    """Groups of rows that only the wide fingerprint tells apart, near and far ones, in cells of many sizes."""
    rng = np.random.default_rng(11)
    for n in (60, 400):
        base = rng.integers(1 << 63, size=(n // 20, 5), dtype=np.uint64)
        rows = base[rng.integers(len(base), size=n)]
        for k in range(n):
            for b in rng.choice(320, rng.integers(0, 40), replace=False):
                rows[k, b // 64] ^= np.uint64(1) << np.uint64(b % 64)
        cell = simhash._Rows(rows[:, 0].copy(), 10, rows[:, 1:].copy(), 44)
        bits = lambda a, b: int(np.bitwise_count(a ^ b).sum())
        linked = {(i, j) for i in range(n) for j in range(i) if bits(rows[i, :1], rows[j, :1]) <= 10 and bits(rows[i, 1:], rows[j, 1:]) <= 44}
        found = simhash.link_cell(cell)
        assert len(found) < n and all((max(p), min(p)) in linked for p in found)
        assert _parts(n, found) == _parts(n, linked)


def _parts(n, links):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("drop", [simhash.drop_near_duplicates, simhash.drop_near_copies])
def test_repeated_ids_lose_no_text(spark, drop):
    t, u = " ".join(f"w{i}" for i in range(300)), " ".join(f"other{i}" for i in range(300))
    rows = [(3, t), (5, t), (5, u), (8, u + " end"), (9, u), (None, t), (11, None), (11, ""), (12, " ")]
    shape = "doc_id long, text string, gone_id long, id string, kept long, `row` string, of_text long, fp long"
    docs = spark.createDataFrame([(*r, 3, "i", 1, "r", 5, 7) for r in rows], shape)
    stay = drop(docs)
    assert stay.columns == docs.columns
    assert sorted(((r.doc_id is None, r.doc_id, r.text) for r in stay.collect()), key=repr) == sorted([(False, 3, t), (False, 5, u), (True, None, t), (False, 11, None), (False, 11, "")], key=repr)
    twice = drop(docs.where("doc_id < 4").union(docs.where("doc_id < 4"))).collect()
    assert [r.text for r in twice] == [t, t]


def test_sketch_equals_counting_bits():
    from xxhash import xxh64_intdigest

    full = (1 << 64) - 1

    def mixed(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & full
        x = (x ^ x >> 27) * 0x94D049BB133111EB & full
        return x ^ x >> 31

    def runs(words, size):
        size = min(size, len(words))
        return [mixed(sum(w * int(p) for w, p in zip(words[i : i + size], simhash._PLACES)) & full) for i in range(len(words) - size + 1)]

    most = lambda hs: sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    for text in ("", "a", "A b c", "x y z u v", "one two three four five six " * 30, " ".join(f"w{i % 70}" for i in range(200))):
        words = [xxh64_intdigest(w, 42) for w in text.lower().encode().split()]
        five = set(runs(words, 5)) if words else set()
        expected = [most(runs(words, 2)), *(most([mixed(h ^ int(s)) for h in five]) for s in simhash._SALTS)] if words else [0] * 5
        assert simhash.sketch(text.encode(), simhash.WordHashes()).tolist() == expected


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_copies_of_similarity_point_eight_are_found(spark):
    """Copies with words exchanged up to a Jaccard similarity of 0.8 are found, others stay; texts share words and passages."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(600)]
    write = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, rows, pairs = write(60), [], []
    for i in range(700):
        words = write(rng.randint(150, 600))
        if i % 3 == 0:
            words[40:100] = passage
        rows.append((2 * i, " ".join(words)))
        if i % 2:
            copy = list(words)
            for at in rng.sample(range(len(copy)), rng.randint(1, max(1, len(copy) // 50))):
                copy[at] = rng.choice(vocabulary)
            rows.append((2 * i + 1, " ".join(copy)))
            a, b = shingles(rows[-2][1]), shingles(rows[-1][1])
            pairs.append((2 * i, 2 * i + 1, len(a & b) / len(a | b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.id: r.component for r in simhash.near_copies(docs).collect()}
    similar = [(a, b) for a, b, j in pairs if j >= 0.8]
    assert len(similar) > 150
    assert sum(found[a] == found[b] for a, b in similar) / len(similar) >= 0.9
    copies = {b for _, b, _ in pairs}
    assert all(found[i] == i for i, _ in rows if i not in copies)
    stay = {r.doc_id for r in simhash.drop_near_copies(docs).collect()}
    assert stay == {i for i, c in found.items() if i == c}


def test_near_copies_equal_links_of_brute_force(spark):
    """Whatever lies within four bits is linked without a miss, and no link is made that the definition doesn't have."""
    rng = random.Random(13)
    rows = []
    for i in range(60):
        words = [f"v{rng.randrange(5000)}" for _ in range(400)]
        for k in range(rng.choice([1, 1, 2, 5])):
            copy = list(words)
            for at in rng.sample(range(400), k * rng.randint(0, 3)):
                copy[at] = "x"
            rows.append((len(rows), " ".join(copy)))
    sk = {i: simhash.sketch(t.encode(), simhash.WordHashes()) for i, t in rows}
    bits = lambda a, b, k: int(np.bitwise_count(sk[a][k] ^ sk[b][k]).sum())
    linked = lambda d: [(a, b) for a in sk for b in range(a) if bits(a, b, slice(0, 1)) <= d and bits(a, b, slice(1, 5)) <= simhash.WIDE]
    got = {r.id: r.component for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sure, most = _parts(len(rows), linked(4)), _parts(len(rows), linked(simhash.FAR))
    assert all(got[i] == got[sure[i]] and most[i] == most[got[i]] for i in got)


def test_chance_of_sharing_a_cell():
    rng = np.random.default_rng(1)
    for g, d, h in ((5, 4, 8), (6, 4, 8), (7, 4, 5)):
        touched = [len(set(rng.integers(g, size=h))) <= d for _ in range(20_000)]
        assert abs(simhash.chance(g, d, h) - np.mean(touched)) < 0.02
        assert (1 - simhash.chance(g, d, h)) ** simhash.partitions_for(g, d, h, 0.11) <= 0.11
    assert simhash.chance(8, 4, 4) == pytest.approx(1)


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    assert simhash.near_copies(docs).count() == 0
    assert simhash.drop_near_copies(docs).count() == 0
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == 0


def test_query_on_fixture(spark):
    from campanile.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    groups = brute_components([r.doc_id for r in rows], fps)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, sf).collect()}
    assert found == {r.doc_id: (f"{f:016x}", groups[r.doc_id]) for r, f in zip(rows, fps)}


def test_every_pair_of_similarity_point_eight_is_linked(spark):
    """Groups of short and long texts around a similarity of 0.8, with a passage that most share: no such pair is missed, no other link made."""
    rng = random.Random(14)
    vocabulary, rows = [f"w{i}" for i in range(3000)], [(0, "a b"), (1, "A  b"), (2, "b a"), (3, ""), (4, " "), (5, "x " * 40), (6, "x " * 90)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    for i in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([8, 20, 60, 150, 400]))]
        words = words + passage if i % 2 else words
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.choice([1, 2, 4])):
            copy, n = list(words), len(words)
            if rng.random() < 0.5:
                copy = copy[: n - max(1, rng.randrange(n // 10, n // 5 + 1))]  # cut off at the end
            else:
                for at in rng.sample(range(n), max(1, n // rng.choice([40, 50, 60]))):
                    copy[at] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    sk, sets = {i: simhash.sketch(t.encode(), simhash.WordHashes()) for i, t in rows}, {i: shingles(t) if t.split() else set() for i, t in rows}
    bits = lambda a, b, k: int(np.bitwise_count(sk[a][k] ^ sk[b][k]).sum())
    pairs = [(a, b) for a in sk for b in sk if a > b]
    similar = [(a, b) for a, b in pairs if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    by_bits = [(a, b) for a, b in pairs if bits(a, b, slice(0, 1)) <= 4 and bits(a, b, slice(1, 5)) <= simhash.WIDE]
    beyond = [(a, b) for a, b in similar if bits(a, b, slice(0, 1)) > simhash.FAR or bits(a, b, slice(1, 5)) > simhash.WIDE]
    assert len(similar) > 100 and len(beyond) > 10
    expected = _parts(len(rows), similar + by_bits)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for cell_rows in (simhash.CELL_ROWS, 5):
        assert {r.id: r.component for r in simhash.near_copies(docs, cell_rows=cell_rows).collect()} == dict(enumerate(expected))
