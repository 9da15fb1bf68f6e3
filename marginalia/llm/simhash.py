"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of a covering code of 64 bits, the product of perfect codes: two Golay
codes of 23 bits, a Hamming code of 15 and a repetition code of 3. Each fingerprint lies within
the covering radius of exactly one anchor, found by a syndrome table for each part.

Two fingerprints that differ in at most t bits have a point half way, at most ceil(t/2) from
each. The anchor that covers this point lies within the covering radius plus ceil(t/2) of both.
So it is enough to replicate every fingerprint to the anchors that cover the points within
ceil(t/2) of it (instead of radius plus t, which is needed if one of the two stays at its own
anchor), and no link is lost: for two bits at most 65 anchors, 17 in the mean. Fingerprints are
then compared within each anchor.

Equal fingerprints are one row before anything is replicated, so copies cost nothing. An anchor
with few fingerprints compares all of them in one task and returns a spanning forest of the
links. One with many is split: its fingerprints meet at the points half way, where any two that
share a point are linked, so hanging all on the smallest one keeps every component.

Texts are taken whole; null or empty ones have fingerprint zero and are linked like any other.
Repeated ids and rows are kept. Null ids take no part in the smallest id of a component; a
component of null ids only has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shingles
from .bpe import blocks
from .common import drop_path, scratch, text_of, written
from .components import components

SEED = 42
SHINGLE = 3
THRESHOLD = 2
PAIRWISE = 2000  # fingerprints of an anchor that are compared with each other in one task
FEW = 8  # up to so many, an anchor's fingerprints are compared by array shifts
ROWS = 200_000  # mean rows of a comparing task
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

# The parts of the code as (bits, radius, generator polynomial).
PARTS = ((23, 3, 0b101011100011), (23, 3, 0b101011100011), (15, 1, 0b10011), (3, 1, 0b111))


# --- fingerprints -----------------------------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 hashes of all shingles of words, repeats included."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[: 1 - shingle].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint as a signed long with the same bits."""

    @F.arrow_udf("long")
    def mark(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            marks = [fingerprint(t, shingle) for b in blocks(values, 64) for t in b]
            yield pa.array(np.array(marks, np.uint64).view(np.int64))

    return mark(text_of(text))


# --- anchors ----------------------------------------------------------------------------------


def _remainders(bits: int, generator: int) -> np.ndarray:
    """Syndrome of each single bit: its power of x modulo the generator."""
    degree = generator.bit_length() - 1
    out, r = [], 1
    for _ in range(bits):
        out.append(r)
        r <<= 1
        if r >> degree:
            r ^= generator
    return np.array(out, np.int64)


@lru_cache(maxsize=1)
def code_tables() -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each part: its first bit, its width, the syndrome of each bit, the error of each syndrome."""
    out, first = [], 0
    for bits, radius, generator in PARTS:
        columns = _remainders(bits, generator)
        errors = np.full(1 << (generator.bit_length() - 1), -1, np.int64)
        level = {0: 0}
        for weight in range(radius + 1):
            for syndrome, error in level.items():
                if errors[syndrome] < 0:
                    errors[syndrome] = error
            if weight < radius:
                level = {s ^ int(c): e | 1 << k for s, e in level.items() for k, c in enumerate(columns) if not e >> k & 1}
        out.append((first, bits, columns, errors))
        first += bits
    if first != 64 or any((t[3] < 0).any() for t in out):
        raise ValueError("the parts are no covering code of 64 bits")
    return out


def anchors_near(marks: np.ndarray, reach: int) -> np.ndarray:
    """Anchors covering the points within ``reach`` (0 or 1) bits of each mark: a row of them per mark."""
    moved = np.zeros((len(marks), 1 if reach == 0 else 65), np.uint64)
    for first, bits, columns, errors in code_tables():
        part = (marks >> np.uint64(first)).astype(np.int64) & ((1 << bits) - 1)
        syndrome = np.zeros(len(marks), np.int64)
        for k in range(bits):
            syndrome ^= np.where(part >> k & 1, columns[k], 0)
        words = np.repeat((part ^ errors[syndrome])[:, None], moved.shape[1], axis=1)
        if reach:
            flips = np.arange(bits)
            words[:, 1 + first : 1 + first + bits] = (part[:, None] ^ (1 << flips)) ^ errors[syndrome[:, None] ^ columns[flips]]
        moved |= words.astype(np.uint64) << np.uint64(first)
    return moved


def _replicate(marks: DataFrame, reach: int) -> DataFrame:
    """``anchor, mark``: each mark once per anchor."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 8192):
                own = batch.column(0).slice(i, 8192).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                near = np.sort(anchors_near(own, reach), axis=1)
                new = np.ones(near.shape, bool)
                new[:, 1:] = near[:, 1:] != near[:, :-1]
                rows = np.nonzero(new)[0]
                yield pa.RecordBatch.from_arrays([pa.array(near[new].view(np.int64)), pa.array(own[rows].view(np.int64))], ["anchor", "mark"])

    return marks.select("mark").mapInArrow(spread, "anchor long, mark long")


def _forest(marks: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links that join all marks of an anchor which are connected there."""
    root = np.arange(len(marks))
    out = []
    for i in range(len(marks) - 1):
        near = i + 1 + np.flatnonzero(np.bitwise_count(marks[i + 1 :] ^ marks[i]) <= threshold)
        for j in near[root[near] != root[i]].tolist():
            if root[j] != root[i]:
                out.append((i, j))
                root[root == root[j]] = root[i]
    return out


def links(marks: DataFrame, threshold: int = THRESHOLD, pairwise: int = PAIRWISE) -> DataFrame:
    """``a, b``: links between distinct marks that connect all within ``threshold`` bits (at most 2)."""
    if threshold not in (1, 2):
        raise ValueError("one or two differing bits")
    placed = written(_replicate(marks, 1), "anchors")
    sizes = placed.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    shared = placed.join(sizes, "anchor")

    def compare(group: pa.Table) -> pa.Table:
        anchor, own = (group.column(c).to_numpy().astype(np.int64) for c in ("anchor", "mark"))
        order = np.lexsort((own, anchor))
        anchor, own = anchor[order], own[order].view(np.uint64)
        heads = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        sizes = np.diff(np.r_[heads, len(anchor)])
        few = np.repeat(sizes <= FEW, sizes)
        pairs = []
        for lag in range(1, FEW):
            i = np.flatnonzero(few[:-lag] & (anchor[:-lag] == anchor[lag:]) & (np.bitwise_count(own[:-lag] ^ own[lag:]) <= threshold))
            pairs.append(np.stack([own[i], own[i + lag]]))
        for at, n in zip(heads[sizes > FEW].tolist(), sizes[sizes > FEW].tolist()):
            found = np.array(_forest(own[at : at + n], threshold), np.int64).reshape(-1, 2).T
            pairs.append(own[at + found])
        a, b = np.unique(np.concatenate(pairs, axis=1), axis=1)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    # Many anchors share a task; how many follows from the number of rows.
    tasks = max(1, -(-placed.count() // ROWS))
    dealt = shared.filter(F.col("n") <= pairwise).select(F.pmod(F.xxhash64("anchor"), F.lit(tasks)).alias("task"), "anchor", "mark")
    within = dealt.groupBy("task").applyInArrow(compare, "a long, b long")
    crowded = shared.filter(F.col("n") > pairwise).select("mark").distinct()
    point = F.explode(F.concat(F.array("mark"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.col("mark").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)))))
    met = crowded.select("mark", point.alias("point")) if threshold == 2 else None
    if met is None:  # one bit: a mark meets its neighbour at the neighbour itself
        met = crowded.select("mark", point.alias("point")).join(crowded.select(F.col("mark").alias("point")), "point", "left_semi")
        return within.unionByName(met.select(F.col("mark").alias("a"), F.col("point").alias("b")).filter("a <> b"))
    lowest = met.groupBy("point").agg(F.min("mark").alias("b"), F.count("*").alias("n")).filter("n > 1")
    hung = met.join(lowest.select("point", "b"), "point").select(F.col("mark").alias("a"), "b").filter("a <> b").distinct()
    return within.unionByName(hung)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, similar: bool = False) -> DataFrame:
    """``doc_id, content, mark, component_id``: one row per document with its fingerprint and smallest reachable id.

    ``content`` is a hash of the text, which tells rows of a repeated id apart. With ``similar``,
    texts are linked too whose sets of five-word shingles have a Jaccard similarity of 0.8 or more,
    however far their fingerprints are from each other.
    """
    body = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("body"))
    columns = ["doc_id", F.xxhash64("body").alias("content"), fingerprint_column(F.col("body")).alias("mark")]
    if similar:
        marked, similar_links = _similar(body, columns)
    else:
        marked = written(body.select(*columns), "marks")
    lowest = written(marked.groupBy("mark").agg(F.min("doc_id").alias("first_id")), "distinct-marks")
    found = links(lowest, threshold)
    if similar:
        found = found.unionByName(similar_links)
    parts = components(found)
    of_mark = lowest.join(parts.select(F.col("node").alias("mark"), "component"), "mark", "left").select(
        "mark", "first_id", F.coalesce("component", "mark").alias("component")
    )
    ids = of_mark.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = of_mark.join(ids, "component").select("mark", "component_id")
    return marked.join(named, "mark").select("doc_id", "content", "mark", "component_id")


def _similar(body: DataFrame, columns: list) -> tuple[DataFrame, DataFrame]:
    """The marks of all texts, and ``a, b`` links between the marks of those with equal or similar sets of shingles."""
    spark = body.sparkSession
    common = shingles.common_tokens(body.select("body"))
    both = body.select(*columns, shingles.described(F.col("body"), common).alias("set"))
    path = scratch(spark, "described")
    both.write.parquet(path)
    both = spark.read.schema(both.schema).parquet(path)
    marked = written(both.select("doc_id", "content", "mark", F.col("set.node").alias("node")), "marks")
    # Rows of one node agree in all of these but the content and the mark.
    chosen = ("content", "mark"), ("set.n", "set.bits", "set.prefix")
    nodes = both.filter("set.n > 0").groupBy("set.node").agg(*(F.min(c).alias(c) for c in chosen[0]), *(F.max(c).alias(c.removeprefix("set.")) for c in chosen[1]))
    nodes = written(nodes, "nodes")
    drop_path(spark, path)
    found = shingles.links(body.select("body", F.xxhash64("body").alias("content")), nodes, common)
    first = nodes.select("node", F.col("mark").alias("first"))
    equal = marked.join(first, "node").filter("mark <> first").select(F.col("mark").alias("a"), F.col("first").alias("b")).distinct()
    of_a, of_b = (first.select(F.col("node").alias(c), F.col("first").alias(f"of_{c}")) for c in "ab")
    near = found.join(of_a, "a").join(of_b, "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    return marked, equal.unionByName(near).filter("a <> b")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, similar: bool = False) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of the smallest id stays.

    Among rows of that id the text's hash decides, and of wholly equal rows one stays.
    """
    found = near_duplicates(docs, doc_id, text, threshold, similar)
    # Components without any id are told apart by a mark they hold.
    key = F.when(F.col("component_id").isNull(), F.col("mark"))
    rows = found.groupBy("component_id", key.alias("own"), "doc_id", "content").agg(F.count("*").alias("n"))
    first = rows.groupBy("component_id", "own").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content", "n")).alias("s"))
    stay = written(first.select("s.doc_id", "s.content", "s.n"), "survivors")
    # The row travels as one field, so that no column of the user meets one of ours.
    body = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("content"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    same = lambda own: body["doc_id"].eqNullSafe(own["doc_id"]) & (body["content"] == own["content"])
    single = stay.filter("n = 1")
    kept = body.join(single, same(single), "left_semi").select("row.*")
    several = stay.filter("n > 1")
    if not several.head(1):
        return kept
    # Of several rows of one id and text the smallest stays, compared as a whole.
    again = body.join(several, same(several), "left_semi").groupBy("doc_id", "content").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return kept.unionByName(again.select("row.*"))
