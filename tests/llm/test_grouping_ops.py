"""Packing, fingerprints and vectors against brute force."""

import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm import components, lattice, packing, queries, shingles, simhash

PATH = public_tokenizers.path("byte_bpe_50k.json")


def groups_of(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


# --- components ---


def test_components_of_chains_stars_and_rings(spark):
    rng = np.random.default_rng(3)
    chain = [(i, i + 1) for i in range(200, 260)]
    star = [(500, i) for i in range(501, 540)]
    ring = [(i, 600 + (i + 1 - 600) % 9) for i in range(600, 609)]
    loose = [tuple(x) for x in rng.integers(1000, 1200, (150, 2)).tolist()]
    pairs = chain + star + ring + loose + [(5, 5), (3, 4), (4, 3), (3, 4)]
    want = groups_of(1300, pairs)
    df = spark.createDataFrame([(a, b) if k % 2 else (b, a) for k, (a, b) in enumerate(pairs)], "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {n: want[n] for p in pairs if p[0] != p[1] for n in p}
    assert components.components(df.filter("false")).count() == 0


# --- packing ---


def check_packing(rows, lengths_of, capacity):
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
    assert {d: sum(r.length for r in p) for d, p in by_doc.items()} == lengths_of
    return len(by_seq)


def test_packing_documents(spark, folder):
    library = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = {d: [*library.encode(t, add_special_tokens=False).ids, 2] for d, t in texts.items()}
    rows = queries.op3_packing(spark, folder).collect()
    n = check_packing(rows, {d: len(x) for d, x in ids.items()}, 1024)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(array("I", part).tobytes())
        assert len(ids[r.doc_id]) > 1024 or r.piece == 0
        assert r.piece == 0 or r.length == 1024
    total = sum(map(len, ids.values()))
    assert -(-total // 1024) <= n <= 1.02 * total / 1024 + 2


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "word " * 3000), (3, "word " * 3000), (None, "x")], "doc_id long, text string")
    pieces = packing.split_pieces(docs, PATH, 64, 2, with_ids=True)
    packed = packing.pack(pieces, 64)
    whole = {r.sequence_id: array("I", r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length].tobytes() == r.ids
    assert packing.pack(pieces.filter("false"), 64).count() == 0


def test_evolution_beats_its_start_and_stays_valid():
    rng = np.random.default_rng(5)
    gains = []
    for seed in range(4):
        sizes = np.sort(rng.integers(150, 420, 900))[::-1].copy()
        begin = packing.rebuild(np.zeros(900, bool), np.zeros(900, np.int32), sizes, np.arange(900), 1000)
        best = packing.evolve(sizes, 1000, seed, [], generations=25)
        assert packing.fills(best, sizes).max() <= 1000 and packing.fills(best, sizes).min() > 0
        assert packing.fitness(best, sizes, 1000) >= packing.fitness(begin, sizes, 1000)
        gains.append(packing.fitness(best, sizes, 1000) > packing.fitness(begin, sizes, 1000))
        assert (best == packing.evolve(sizes, 1000, seed, [], generations=25)).all()
    assert any(gains)


def test_many_cohorts(spark, monkeypatch):
    monkeypatch.setattr(packing, "COHORT", 100)
    df = spark.range(1500).select(F.col("id").alias("doc_id"), (1 + F.pmod(F.xxhash64("id"), F.lit(1100))).alias("length"), F.lit("x").alias("sequence_id"))
    sizes = {r.doc_id: r.length for r in df.collect()}
    rows = packing.pack(df, 1100).collect()
    n = check_packing(rows, sizes, 1100)
    assert n <= 1.1 * sum(sizes.values()) / 1100


# --- fingerprints ---


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows):
    ids = sorted(rows)
    marks = np.array([rows[i] for i in ids], np.uint64)
    near = np.bitwise_count(marks[:, None] ^ marks[None, :]) <= 2
    want = groups_of(len(ids), zip(*np.nonzero(np.triu(near, 1))))
    return {i: ids[want[k]] for k, i in enumerate(ids)}


def test_fingerprints_and_components(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    marks = {i: slow_fingerprint(t) for i, t in texts.items()}
    got = {r.doc_id: r for r in queries.op4_simhash(spark, folder).collect()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{m:016x}" for i, m in marks.items()}
    assert {i: r.component_id for i, r in got.items()} == slow_components(marks)
    # Spark's own hash is the named one.
    assert spark.sql("select xxhash64('a b c')").first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("pairwise", [2000, 3])
def test_links_lose_nothing(spark, pairwise):
    rng = np.random.default_rng(9)
    marks = {0, 2**64 - 1, 1, 3}
    for seed in rng.integers(0, 2**63, 30).tolist():
        m = seed
        for _ in range(12):
            m ^= sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 4), replace=False))
            marks.add(m)
    centre = int(rng.integers(0, 2**62))
    marks |= {centre ^ 1 << k for k in range(40)}
    own = sorted(marks)
    signed = np.array(own, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(m,) for m in signed], "mark long")
    arr = np.array(own, np.uint64)
    near = np.bitwise_count(arr[:, None] ^ arr[None, :]) <= 2
    want = groups_of(len(own), zip(*np.nonzero(np.triu(near, 1))))
    at = {m: i for i, m in enumerate(signed)}
    found = [(at[r.a], at[r.b]) for r in simhash.links(df, 2, pairwise).collect()]
    assert all(near[a, b] for a, b in found)
    assert groups_of(len(own), found) == want


def test_every_point_has_one_anchor():
    rng = np.random.default_rng(1)
    marks = rng.integers(0, 2**63, 500).astype(np.uint64)
    own = simhash.anchors_near(marks, 0)[:, 0]
    assert np.bitwise_count(own ^ marks).max() <= sum(r for _, r, _ in simhash.PARTS)
    assert (simhash.anchors_near(own, 0)[:, 0] == own).all()


def test_odd_documents(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "É x y z " * 9000), (6, "É x y z " * 9000), (None, "one two"), (None, "alone here now")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, mark int")
    got = [(r.doc_id, r.mark & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert Counter(got) == Counter((i, slow_fingerprint(t), c) for (i, t), c in zip(rows, [1, 1, 1, 4, 4, 6, 6, 4, None]))
    assert simhash.near_duplicates(df.filter("false")).count() == 0


def slow_shingles(text):
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


@pytest.mark.parametrize("few, sizes", [(20, {}), (2, {}), (2, {"RUN": 3, "BLOCK": 4, "SET_TOKENS": 200, "SCREEN": 64})])
def test_similar_texts_are_linked_however_far_their_marks(spark, few, sizes, monkeypatch):
    monkeypatch.setattr(shingles.links, "__defaults__", (few,))
    for name, value in sizes.items():
        monkeypatch.setattr(shingles, name, value)
    rng = np.random.default_rng(4)
    passage = [f"p{k}" for k in range(40)]
    texts = ["", "one two", "ONE two", "one two three four five", "one two three four six"]
    for seed in range(12):
        source = [f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(40, 400)))]
        texts += [" ".join(source), " ".join(source + passage)]
        for _ in range(6):
            copy = list(source)
            for k in rng.integers(0, len(copy), int(rng.integers(1, 1 + len(copy) // 40 + 1))).tolist():
                copy[k] = f"x{rng.integers(0, 10**9)}"
            texts.append(" ".join(copy))
        texts.append(" ".join(source[: int(len(source) * 0.85)]))
    sets = [slow_shingles(t) for t in texts]
    marks = np.array([slow_fingerprint(t) for t in texts], np.uint64)
    similar = [(a, b) for a in range(len(texts)) for b in range(a) if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    near = list(zip(*np.nonzero(np.bitwise_count(marks[:, None] ^ marks[None, :]) <= 2)))
    want = groups_of(len(texts), [*near, *similar])
    assert want != groups_of(len(texts), near)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(df, similar=True).collect()} == dict(enumerate(want))
    assert {r.doc_id for r in simhash.keep_one(df, similar=True).collect()} == set(want)
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()} == dict(enumerate(groups_of(len(texts), near)))


def test_keep_one_with_clashing_names_and_repeated_rows(spark):
    rows = [(1, "a b c d e f", "x", 1), (1, "a b c d e f", "y", 2), (2, "A b c d e f", "z", 3), (3, None, None, None), (4, "", "q", 0), (None, "other words", "n", 1), (5, "m n o p", "n", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, content string, n long")
    for old, new in (("content", "__id"), ("content", "row"), ("content", "mark"), ("content", "a.b")):
        named = df.withColumnRenamed(old, new)
        for similar in (False, True):
            got = simhash.keep_one(named, similar=similar)
            assert got.columns == named.columns
            assert sorted(map(tuple, got.collect()), key=repr) == sorted([rows[0], rows[3], rows[5], rows[6]], key=repr)
    assert simhash.keep_one(df.filter("false"), similar=True).columns == df.columns


# --- vectors ---


def slow_links(rows, threshold):
    ids = [i for i, _, _ in rows]
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) and lab is not None for _, v, lab in rows]
    n, pairs = len(rows), []
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if g else None for (_, v, _), g in zip(rows, good)]
    for a in range(n):
        for b in range(a + 1, n):
            if good[a] and good[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                pairs.append((a, b))
    links = Counter(x for p in pairs for x in p)
    root = groups_of(n, pairs)
    low = defaultdict(list)
    for k, r in enumerate(root):
        if ids[k] is not None:
            low[r].append(ids[k])
    return Counter((ids[k], links[k], min(low[root[k]], default=None)) for k in range(n))


def test_vectors_of_the_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = queries.op9_lattice(spark, folder).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == slow_links(rows, 0.93)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors_odd_and_crowded(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = [(i, v, 1) for i, v in enumerate([None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] + [0.0] * 15])]
    centre = rng.normal(size=16)
    rows += [(100 + i, (centre + rng.normal(size=16) * 0.04).tolist(), 1) for i in range(60)]
    rows += [(300 + i, [1.0] + [0.0] * 15, 2) for i in range(30)] + [(350, [2.0] + [0.0] * 15, 2), (351, [1.0] + [-0.0] * 15, None), (352, [5.0] * 7, 2), (353, [5.0] * 7, 2)]
    rows += [(300, [1.0] + [0.0] * 15, 2), (None, [1.0] + [0.0] * 15, 2)]
    df = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], "vec_id long, embedding array<double>, label int, key string")
    got = Counter(tuple(r) for r in lattice.near_duplicates(df).collect())
    assert got == slow_links(rows, 0.93)
    assert lattice.near_duplicates(df.filter("false")).count() == 0


def test_recall_near_the_threshold(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=(400, 64))
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    c = rng.uniform(0.931, 0.99, (400, 1))
    y = c * x + np.sqrt(1 - c * c) * y
    rows = [(2 * i + k, v[i].tolist(), 0) for i in range(400) for k, v in enumerate((x, y))]
    got = lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).filter("n_links > 0").count()
    assert got >= 0.97 * 800


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8)) * 2
    got = lattice.decode_e8(x, 3) / 2
    assert ((got * 2) % 1 == 0).all() and (got.sum(axis=2) % 2 == 0).all()
    d = np.linalg.norm(got - x[:, None], axis=2)
    assert d[:, 0].max() <= 1.0 + 1e-9 and (np.diff(d, axis=1) >= -1e-9).all()
    assert all(len({tuple(p) for p in ps}) == 4 for ps in got)


def test_packing_keeps_columns_of_any_name(spark):
    rows = [(i, 10 + i % 50, "x", i, "p", "a") for i in range(60)] + [(99, 100, None, 0, None, None)]
    df = spark.createDataFrame(rows, "row long, length long, cohort string, at long, piece string, sequence_id string")
    got = packing.pack(df, 100).collect()
    assert sorted((r.row, r["length"], r.cohort, r["at"], r.piece) for r in got if r.row < 99) == [r[:5] for r in rows[:-1]]
    assert packing.pack(df, 100).columns == ["row", "length", "cohort", "at", "piece", "sequence_id", "offset"]
    assert packing.pack(df.filter("false"), 100).count() == 0
