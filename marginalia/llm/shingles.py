"""Exact links between texts whose sets of word shingles have a Jaccard similarity of 0.8 or more.

Two such sets share at least SIMILAR of the tokens of either. So under any common order of the
tokens their first ``n - ceil(SIMILAR * n) + 1`` tokens have one in common, and it is enough to
meet at those. Rare tokens come first: a sample of the texts tells which ones are common. The
sample decides the order only, and any order loses nothing.

Equal sets are one node. The tokens at which nodes meet are shuffled once and read in order, run
by run. A pair goes on only if its sizes, its places in both orders and a parity bitmap of both sets,
which bounds the overlap from above, leave room for enough common tokens; few besides the true
ones pass. A run of few nodes compares all of them. One of many compares each with the middle
one; what is then still apart from that one is compared in blocks of nodes, by bitmap again before
pairs become rows. A token known to be very common is dealt to several runs, and its blocks meet
across them. Every pair that goes on is verified on the whole sets: nodes are dealt to buckets,
and each set travels once to each pair of buckets in which it is needed.

Texts are taken whole; words are those of the fingerprints. A text of fewer words than a shingle
is one token, a null text or one without words none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import blocks
from .common import drop_path, scratch, text_of
from .components import components

SHINGLE = 5
SIMILAR = (4, 5)  # 0.8, in whole numbers
SAMPLE = 10_000  # texts whose tokens are counted for the order
KNOWN = 200_000  # common tokens sent to the tasks
FEW = 8  # up to so many nodes of a run are all compared
RUN = 100_000  # nodes from which a token is dealt to several runs
BLOCK = 1_024  # nodes of a block of a large run
ROWS = 100_000  # mean rows of a task that compares blocks
BITS = 1_024  # of the parity bitmap
SET_TOKENS = 4_000_000  # tokens of the sets of a bucket
SCREEN = 1 << 24  # hash values of the screen in front of the texts whose sets are wanted
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


def tokens(text: str) -> np.ndarray:
    """Distinct hashes of all shingles of words, in order of size."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))] if words else [], np.uint64).view(np.int64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        out += own[k : k + n] * FACTORS[k]
    return np.unique(out.view(np.int64))


def node_of(own: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(own.tobytes())).astype(np.int64)) if len(own) else 0


def _room(n: np.ndarray, m: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Whether sets of n and m tokens of which ``left`` at most are common can be similar enough."""
    part, whole = SIMILAR
    return (whole * np.minimum(n, m) >= part * np.maximum(n, m)) & ((whole + part) * left >= part * (n + m))


def described(text: Column, common: tuple[np.ndarray, np.ndarray]) -> Column:
    """Struct of ``node`` (a hash of the text's set of tokens, 0 without any), its size ``n``, parity bitmap ``bits`` and ``prefix``, the tokens to meet at."""
    part, whole = SIMILAR
    known, counts = common
    kind = pa.struct([("node", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()), ("prefix", pa.binary())])

    @F.arrow_udf("node long, n long, bits binary, prefix binary")
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            node, size, bits, prefix = [], [], [], []
            for own in (tokens(t) for b in blocks(values, 64) for t in b):
                n = len(own)
                often = np.zeros(n, np.int64)
                if len(known) and n:
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    often = np.where(known[at] == own, counts[at], 0)
                node.append(node_of(own))
                size.append(n)
                bits.append(np.packbits((np.bincount(own & (BITS - 1), minlength=BITS) & 1).astype(np.uint8)).tobytes())
                prefix.append(own[np.argsort(often, kind="stable")[: n + (-part * n) // whole + 1 if n else 0]].tobytes())
            yield pa.StructArray.from_arrays([pa.array(node, pa.int64()), pa.array(size, pa.int64()), pa.array(bits, pa.binary()), pa.array(prefix, pa.binary())], fields=list(kind))

    return describe(text_of(text))


def packed(own: np.ndarray) -> bytes:
    """The first 40 bits of each token: two tokens of a pair of sets that share them by chance are one in a million pairs."""
    return (own >> 32).astype("<i4").tobytes() + ((own >> 24) & 255).astype(np.uint8).tobytes()


def unpacked(held: bytes) -> np.ndarray:
    n = len(held) // 5
    return np.frombuffer(held, "<i4", n).astype(np.int64) << 8 | np.frombuffer(held, np.uint8, n, 4 * n)


def _sets_of(texts: DataFrame, keys: list[str], screen: np.ndarray | None = None) -> DataFrame:
    """``keys`` and packed ``tokens`` of the rows of ``texts`` (its last column) whose first key passes the screen."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if screen is not None:
                batch = batch.filter(pa.array(screen[batch.column(0).to_numpy() % SCREEN]))
            for i in range(0, batch.num_rows, 64):
                some = batch.slice(i, 64)
                sets = [packed(tokens(t)) for t in some.column(len(keys)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in range(len(keys))), pa.array(sets, pa.binary())], [*keys, "tokens"])

    body = texts.columns[-1]
    kinds = "".join(f"{k} {texts.schema[k].dataType.simpleString()}, " for k in keys)
    return texts.select(*keys, text_of(F.col(body))).mapInArrow(spread, f"{kinds}tokens binary")


def common_tokens(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens found in several texts of a sample, and in about how many of all."""
    body, total = texts.columns[0], texts.count()
    some = texts
    if total > SAMPLE:
        some = texts.filter(F.pmod(F.xxhash64(body, F.lit(7)), F.lit(1_000_003)) < F.lit(int(1_000_003 * SAMPLE / total) + 1))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch.column(0), 64):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([tokens(t) for t in b]))], ["token"])

    found = some.select(text_of(F.col(body))).mapInArrow(spread, "token long").groupBy("token").agg(F.count("*").alias("n"))
    rows = found.filter("n > 2").orderBy(F.desc("n"), "token").limit(KNOWN).toArrow()
    known, counts = (rows.column(c).to_numpy().astype(np.int64) for c in ("token", "n"))
    order = np.argsort(known)
    return known[order], counts[order] * max(1, -(-total // SAMPLE))


# --- meeting at tokens ------------------------------------------------------------------------


def _rows(nodes: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``token, run, n, node, place``: each node at the tokens of its prefix. Run 0 is the only one of its token."""
    large = common[1] > RUN
    known, runs = common[0][large], -(-common[1][large] // RUN)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                some = batch.slice(i, 1024)
                node, n = (some.column(c).to_numpy() for c in (0, 1))
                parts = [np.frombuffer(p, np.int64) for p in some.column(2).to_pylist()]
                count = np.fromiter(map(len, parts), np.int64, len(parts))
                token = np.concatenate(parts)
                place = np.arange(len(token)) - np.repeat(np.cumsum(count) - count, count)
                own, run = np.repeat(node, count), np.zeros(len(token), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, token), len(known) - 1)
                    run = np.where(known[at] == token, 1 + own % runs[at], 0)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (token, run, np.repeat(n, count), own, place)], ["token", "run", "n", "node", "place"])

    return nodes.select("node", "n", "prefix").mapInArrow(spread, "token long, run long, n long, node long, place long")


def _meet(rows: DataFrame, few: int) -> DataFrame:
    """``a, b`` pairs of runs, and the rows of large runs (``token, n, node, place``) for the comparing of blocks.

    Rows come sorted by run, so a task holds one run and one batch at a time.
    """
    columns = ["a", "b", "token", "n", "node", "place"]

    def compare(token: np.ndarray, run: np.ndarray, n: np.ndarray, node: np.ndarray, place: np.ndarray, heads: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(np.r_[heads, len(token)])
        of = np.repeat(np.arange(len(heads)), sizes)
        many = (sizes > few) | (run[heads] > 0)
        some = np.repeat((sizes > 1) & ~many, sizes)
        a, b = [], []

        def keep(i: np.ndarray, j: np.ndarray) -> None:
            good = _room(n[i], n[j], np.minimum(n[i] - place[i], n[j] - place[j]))
            a.append(np.minimum(node[i[good]], node[j[good]]))
            b.append(np.maximum(node[i[good]], node[j[good]]))

        small = np.flatnonzero(some)
        for lag in range(1, int(sizes[~many].max(initial=1))):
            i, j = small[:-lag], small[lag:]
            together = of[i] == of[j]
            keep(i[together], j[together])
        large = np.flatnonzero(np.repeat(many, sizes))
        middle = np.repeat(heads + sizes // 2, sizes)[large]
        keep(large[middle != large], middle[middle != large])
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
        none = np.zeros(len(large), np.int64)
        both = [np.r_[x, y] for x, y in zip((pairs[0], pairs[1], *(np.zeros(pairs.shape[1], np.int64),) * 4), (none, none, token[large], n[large], node[large], place[large]))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in both], columns)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [c.to_numpy() for c in batch.columns]
            if held and (held[-1][0][-1], held[-1][1][-1]) == (new[0][-1], new[1][-1]):
                held.append(new)  # one run so far; it is put together once
                continue
            token, run, n, node, place = (np.concatenate(c) for c in zip(*held, new))
            heads = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (run[1:] != run[:-1])])
            last = int(heads[-1])
            if last:
                yield compare(token[:last], run[:last], n[:last], node[:last], place[:last], heads[:-1])
            held = [[c[last:] for c in (token, run, n, node, place)]]
        if held:
            token, run, n, node, place = (np.concatenate(c) for c in zip(*held))
            heads = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (run[1:] != run[:-1])])
            yield compare(token, run, n, node, place, heads)

    ordered = rows.repartition("token", "run").sortWithinPartitions("token", "run", "n", "node")
    return ordered.mapInArrow(runs, ", ".join(f"{c} long" for c in columns))


def _across(large: DataFrame, parts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b``: pairs of large runs that are not connected yet and may be similar, by blocks.

    The nodes outside of a token's largest group meet all of its nodes, block by block.
    """
    held = large.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    groups = held.groupBy("token", "part").agg(F.count("*").alias("k"))
    most = groups.groupBy("token").agg(F.max_by("part", F.struct("k", "part")).alias("most"), F.count("*").alias("parts"), F.sum("k").alias("k"), F.max("k").alias("main"))
    open_tokens = most.filter("parts > 1").select("token", "most", F.ceil((F.col("k") - F.col("main")) / BLOCK).cast("int").alias("lefts"), F.ceil(F.col("k") / BLOCK).cast("int").alias("rights"))
    still = held.join(open_tokens, "token").join(nodes.select("node", "bits"), "node")
    side = lambda own, other: (F.pmod(F.xxhash64("node"), own).cast("int"), F.explode(F.sequence(F.lit(0), other - 1)))
    carried = ["token", "n", "node", "place", "part", "bits"]
    i, j = side(F.col("lefts"), F.col("rights"))
    left = still.filter("part <> most").select(*carried, i.alias("i"), j.alias("j"), F.lit(True).alias("rest"))
    j, i = side(F.col("rights"), F.col("lefts"))
    right = still.select(*carried, j.alias("j"), i.alias("i"), F.lit(False).alias("rest"))

    def compare(group: pa.Table) -> pa.Table:
        token, i, j, n, node, place, part, rest = (group.column(c).to_numpy() for c in ("token", "i", "j", "n", "node", "place", "part", "rest"))
        bits = np.frombuffer(b"".join(group.column("bits").to_pylist()), np.uint64).reshape(-1, BITS // 64)
        order = np.lexsort((rest, j, i, token))
        key = np.stack([token, i, j])[:, order]
        heads = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
        a, b = [], []
        for begin, end in zip(heads.tolist(), [*heads[1:].tolist(), len(order)]):
            own = order[begin:end]
            split = int(np.searchsorted(rest[own], True))
            right = own[:split]
            for x in own[split:].tolist():
                common = (n[x] + n[right] - np.bitwise_count(bits[right] ^ bits[x]).sum(axis=1, dtype=np.int64)) // 2
                y = right[_room(n[x], n[right], np.minimum(common, np.minimum(n[x] - place[x], n[right] - place[right]))) & (part[right] != part[x])]
                a.append(np.minimum(node[x], node[y]))
                b.append(np.maximum(node[x], node[y]))
        pairs = np.unique(np.stack([np.concatenate(c) if c else np.zeros(0, np.int64) for c in (a, b)]), axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    # Blocks of many tokens share a task.
    tasks = max(1, -(-2 * large.count() // ROWS))
    both = left.unionByName(right).withColumn("task", F.pmod(F.xxhash64("token", "i", "j"), F.lit(tasks)))
    return both.groupBy("task").applyInArrow(compare, "a long, b long").distinct()


# --- verifying --------------------------------------------------------------------------------


def _wanted_sets(texts: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, tokens`` of the wanted nodes, from one text of each.

    A screen of hash values of fixed size keeps most other texts from being shingled again or
    shuffled; at any size it only lets more of them through.
    """
    chosen = nodes.join(wanted, "node", "left_semi").select("node", "content")
    at = F.pmod(F.col("content"), F.lit(SCREEN))
    rows = chosen.groupBy(F.bitmap_bucket_number(at + 1).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at + 1)).alias("bits")).toArrow()
    screen = np.zeros(SCREEN + 2 * 32768, bool)
    for k, bits in zip(rows.column("k").to_pylist(), rows.column("bits").to_pylist()):
        screen[(k - 1) * 32768 : k * 32768] = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)
    sets = _sets_of(texts.select("content", "body"), ["content"], screen)
    # Copies of one text have one set; what they are grouped by is what they are joined on.
    return chosen.join(sets.groupBy("content").agg(F.max("tokens").alias("tokens")), "content").select("node", "tokens")


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose bitmaps leave room for enough common tokens."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in (2, 3))
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, BITS // 64) for c in (4, 5))
            good = _room(n, m, (n + m - np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)) // 2)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return both.mapInArrow(check, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, kept) -> DataFrame:
    """The pairs whose sets are similar."""
    part, whole = SIMILAR
    sets = kept(_wanted_sets(texts, nodes, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "sets")
    buckets = max(1, -(-(sets.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0) // (5 * SET_TOKENS)))
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets))
    dealt = pairs.select("a", "b", F.least(bucket("a"), bucket("b")).alias("g"), F.greatest(bucket("a"), bucket("b")).alias("h"))
    needed = dealt.select(F.explode(F.array("a", "b")).alias("node"), F.col("g").alias("p"), F.col("h").alias("q")).distinct()
    shipped = needed.join(sets, "node")

    def check(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        held = {k: unpacked(t) for k, t in zip(sets.column("node").to_pylist(), sets.column("tokens").to_pylist())}
        out = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            x, y = held[a], held[b]
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            common = int((y[at] == x).sum())
            if whole * common >= part * (len(x) + len(y) - common):
                out.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return dealt.groupBy("g", "h").cogroup(shipped.groupBy("p", "q")).applyInArrow(check, "a long, b long")


def links(texts: DataFrame, nodes: DataFrame, common: tuple[np.ndarray, np.ndarray], few: int = FEW) -> DataFrame:
    """``a, b``: links between nodes that connect all whose similarity is SIMILAR or more.

    ``texts`` has ``body`` and ``content``, a hash that tells bodies apart; ``nodes`` one row for each set
    of tokens with the columns of ``described`` and the ``content`` of one of its texts. All that is
    written on the way but the links is dropped again.
    """
    spark, paths = texts.sparkSession, []

    def kept(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    met = kept(_meet(_rows(nodes, common), few), "meetings")
    first = kept(_possible(met.filter("a <> b").select("a", "b").distinct(), nodes), "first-pairs")
    large = met.filter("a = b").select("token", "n", "node", "place")
    path = scratch(spark, "first-links")
    _verified(first, texts, nodes, kept).write.parquet(path)
    found = spark.read.schema("a long, b long").parquet(path)
    if large.head(1):
        parts = components(found).distinct().withColumnRenamed("component", "part")
        more = kept(_across(large, parts, nodes), "second-pairs")
        path = scratch(spark, "second-links")
        _verified(more, texts, nodes, kept).write.parquet(path)
        found = found.unionByName(spark.read.schema("a long, b long").parquet(path))
    for p in paths:
        drop_path(spark, p)
    return found
