"""Token files, clustering and ranked search against brute force."""

import hashlib
import heapq
import math
import re
import struct
import uuid
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm import centroids, huffman, lexical, queries
from marginalia.llm.common import scratch
from tests.checker import compare

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "a", "<|endoftext|>", "Grüße, 世界!", "x" * 70_000, "word " * 50_000, "same", "same", "\x00\n\t", "é" * 3]


def odd_docs(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(ODD)] + [(3, "a", "x", 3), (3, "b", None, None), (None, "no id", "x", 1), (None, None, None, None), (-5, "first", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, part string, start long")


# --- token files ---


def slow_files(rows):
    """doc_id, ids by brute force, in the order of the files."""
    library = Tokenizer.from_file(PATH)
    ids = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows]
    at, out = 0, []
    for i, own in sorted(ids, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((i, at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))))
        at += len(own)
    return out


def test_token_files_against_the_library(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, queries.op11_token_files(spark, folder).collect()))
    assert got == slow_files(map(tuple, docs.collect()))


@pytest.mark.parametrize("width", ["<u2", "<u4"])
def test_token_files_of_odd_rows(spark, width):
    docs = odd_docs(spark)
    path = scratch(spark, f"test-{uuid.uuid4().hex}")
    huffman.write_ids(docs.repartition(5).withColumn("ids", huffman.ids_column(F.col("text"), PATH, 0, width)), path, width)
    got = huffman.read_ids(spark, path).collect()
    want = slow_files([(r.doc_id, r.text) for r in docs.collect()])
    # Rows of one id may stand in any order among themselves; all of them are there, without a gap.
    assert sorted((r.doc_id is not None, r.doc_id or 0, zlib.crc32(r.ids)) for r in got) == sorted((i is not None, i or 0, c) for i, _, _, c in want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == [i for i, _, _, _ in want]
    flat = b"".join(r.ids for r in sorted(got, key=lambda r: r.start))
    for first, last in ((0, at), (0, 1), (5, 5), (100, 333), (at - 700, at), (40_000, 41_000), (at, at + 10)):
        parts = sorted(map(tuple, huffman.read_range(spark, path, first, last).collect()))
        assert b"".join(p for _, p in parts) == flat[4 * first : 4 * last]
        assert not parts or parts[0][0] == first


def test_token_files_of_nothing(spark):
    path = scratch(spark, f"test-{uuid.uuid4().hex}")
    none = spark.createDataFrame([], "doc_id string, ids binary")
    huffman.write_ids(none, path)
    assert huffman.read_ids(spark, path).count() == 0 and huffman.read_range(spark, path, 0, 10).count() == 0
    path = scratch(spark, f"test-{uuid.uuid4().hex}")
    huffman.write_ids(spark.createDataFrame([("a", None), ("b", b""), ("c", array("I", [7] * 1000).tobytes())], "doc_id string, ids binary"), path)
    got = sorted(huffman.read_ids(spark, path).collect())
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [("a", 0, 0), ("b", 0, 0), ("c", 0, 1000)]
    assert got[2].ids == array("I", [7] * 1000).tobytes()


def slow_huffman_bits(counts):
    heap = [(c, i, 0) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    total, k = 0, len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], k, 0))
        k += 1
    return total


def test_code_lengths_are_best_within_the_limit():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 300):
        counts = np.maximum(1, (1e6 / np.arange(1, n + 1) ** 2 * rng.uniform(0.5, 2, n)).astype(np.int64))
        free = huffman.code_lengths(counts, 40)
        assert n == 1 or int((free * counts).sum()) == slow_huffman_bits(counts.tolist())
        limit = max(1, (n - 1).bit_length() + 2)
        short = huffman.code_lengths(counts, limit)
        assert short.max() <= limit and (n == 1 or sum(2.0 ** -int(x) for x in short) == 1)
        assert (short * counts).sum() <= (huffman.code_lengths(counts, max(1, (n - 1).bit_length())) * counts).sum()
    # A limit that binds: the best code of four symbols in at most two bits is the even one.
    assert huffman.code_lengths(np.array([1, 2, 4, 100]), 2).tolist() == [2, 2, 2, 2]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5, np.int64), 2)


# --- clustering ---


def slow_clusters(rows, k, rounds, salt):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda r: (r[0] is None, hashlib.sha256(f"{salt}{r[0]}".encode()).hexdigest(), r[1])
    centers = [v for _, v in sorted(kept, key=digest)[:k]]

    def near(v):
        return min((sum((x - c) ** 2 for x, c in zip(v, center)), n) for n, center in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, vs in groups.items():
            centers[n] = [sum(c) // len(vs) for c in zip(*vs)]
    placed = [(i, *near(v)[::-1]) for i, v in kept]
    own = Counter()
    for _, n, d in placed:
        own[n] += d
    return sorted(((i is not None, i or 0, n, d, own[n], sum(own.values()), hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest()) for i, n, d in placed))


def collected(df):
    return sorted((r.vec_id is not None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_clusters_against_sql(spark, con, folder):
    result = compare(queries.op12_centroids(spark, folder), con, queries.CHECKS["op12_centroids"])
    assert result["ok"] and result["rows"] > 0, result


def test_clusters_of_odd_rows_against_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(i % 3, 0.4, 64)]) for i in range(60)]
    rows += [(60, None), (61, [1.0] * 63), (62, [1.0] * 63 + [None]), (63, [1.0] * 63 + [float("nan")]), (64, [1.0] * 63 + [float("-inf")]), (65, [])]
    rows += [rows[3], rows[3], (None, rows[4][1]), (None, rows[5][1]), (3, rows[6][1]), (70, [0.0] * 64), (71, [-2000.5] * 64)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cluster int, near int")
    for k in (8, 3):
        got = centroids.describe(*centroids.cluster(df, 64, k, 4, "3:"))
        assert collected(got) == slow_clusters(rows, k, 4, "3:")
    few = df.filter("vec_id < 2")
    assert collected(centroids.describe(*centroids.cluster(few, 64, 8, 4, "3:"))) == slow_clusters(rows[:2], 8, 4, "3:")
    for none in (df.filter("false"), df.filter("vec_id = 60")):
        got = centroids.describe(*centroids.cluster(none, 64, 8, 4, "3:"))
        assert got.count() == 0 and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    wide = spark.createDataFrame([(1, [3e30] * 64), (2, [0.0] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(ValueError):
        centroids.cluster(wide, 64, 8, 1, "3:")


def test_rounds_run_in_the_jvm(spark, folder):
    vectors = centroids.integer_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"), 64)
    placed = vectors.select("vec_id", centroids.nearest("v", [[0] * 64, [1] * 64]).alias("near"))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# --- ranked search ---


def slow_terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_search(docs, items, k):
    found = [(i, Counter(slow_terms(t))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    big_n, big_l = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        wanted, scores = Counter(slow_terms(text)), []
        for i, c, n in found:
            m = 100 - 25 + 25 * n * big_n // big_l
            s = sum(q * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, q in wanted.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def small(spark, docs, items, k, monkeypatch, **sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(lexical, name, value)
    index = lexical.build_index(docs, scratch(spark, f"test-{uuid.uuid4().hex}"))
    return sorted((tuple(r) for r in lexical.search(index, items, k).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_search_against_sql(spark, con, folder):
    result = compare(queries.op13_lexical(spark, folder), con, queries.CHECKS["op13_lexical"])
    assert result["ok"] and result["rows"] > 0, result


@pytest.mark.parametrize("sizes", [{}, {"ITEMS": 3, "FIRST_STEP": 1}, {"ITEM_TERMS": 4}])
def test_search_of_odd_rows_against_brute_force(spark, monkeypatch, sizes):
    rng = np.random.default_rng(2)
    docs = odd_docs(spark).select("doc_id", "text").unionByName(
        spark.createDataFrame([(100 + i, " ".join(f"w{j}" for j in rng.zipf(1.4, 40 + i % 7) if j < 500)) for i in range(300)], "doc_id long, text string")
    ).withColumn("rank", F.lit(1)).withColumn("item", F.lit("x"))
    items = spark.createDataFrame([(0, "Same WORD a"), (1, None), (2, ""), (3, "w1 w2 w3 w400 w1"), (3, "grüße 世界 É é"), (None, "w5 w6 w7"), (9, "nothing-here"), (10, "same same b"), (11, " ".join(f"w{i}" for i in range(60)))], "item_id long, text string").withColumn("rank", F.lit(2))
    want = slow_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 5)
    assert small(spark, docs.repartition(3), items, 5, monkeypatch, **sizes) == want
    assert small(spark, docs.filter("false"), items, 5, monkeypatch) == [] == small(spark, docs, items.filter("false"), 5, monkeypatch)


def test_segments_of_any_size_give_the_same(spark, folder, monkeypatch):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    want = small(spark, docs, items, 20, monkeypatch)
    assert want == small(spark, docs.repartition(4), items, 20, monkeypatch, SEGMENT_DOCS=7)


def test_ties_survive_the_stop():
    # Equal scores everywhere: all documents tie with the k-th, so none may be left out.
    lists, impacts = [np.arange(500), np.arange(500)[::-1].copy()], [np.full(500, 7), np.full(500, 5)]
    docs, scores = lexical.best_positions(lists, impacts, 500, 3)
    assert len(docs) == 500 and set(scores.tolist()) == {12}
    # A clear winner on top stops the reading early.
    impacts = [np.r_[np.full(3, 1000), np.ones(497, np.int64)], np.r_[np.full(3, 900), np.ones(497, np.int64)]]
    docs, _ = lexical.best_positions([np.arange(500), np.arange(500)], impacts, 500, 3)
    assert len(docs) < 100
