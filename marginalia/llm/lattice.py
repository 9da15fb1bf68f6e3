"""Embedding near-duplicates by lattice hashing.

Each of several tables projects the normalised vectors to eight dimensions by its own random
matrix, shifts them, and decodes them to the nearest point of the E8 lattice: the better of the
nearest points of D8 and of D8 + 1/2. A vector is looked for in its own cell and in the
neighbouring cells that come closest, which its second-best roundings give. Vectors that meet in
a cell, have equal labels and a cosine of at least the threshold are linked.

Equal vectors of a label are one row with a count, so copies cost nothing. Only a vector's key
and its cells travel per table; a cell with many vectors is dealt into blocks and every pair of
blocks is a task. Pairs are never rows: a task returns, for each of its vectors, the number of
linked vectors (weighted by copies) and spanning links for the components. A pair that meets in
several cells is counted in the first of them only, which both vectors' lists of cells tell.

Vectors that are null, empty, zero, or hold null or non-finite components, and vectors without
a label, link with nothing. Vectors of different length never link. Repeated ids are rows like
any other; the smallest id of a component ignores nulls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

TABLES = 6
PROBES = 3  # neighbouring cells each vector is also looked for in
SCALE = 0.7  # length of a unit vector's projection, per dimension, in units of the lattice
SEED = 20250
BLOCK = 1024  # vectors of a block
ROWS = 8_000  # mean rows of a comparing task
DIM = 8


def decode_d8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest points of D8 (integer points of even sum), and the next ones: one step along one axis pair."""
    r = np.rint(x)
    miss = x - r
    order = np.argsort(-np.abs(miss), axis=1)
    rows = np.arange(len(x))
    step = np.where(miss >= 0, 1.0, -1.0)
    first, second, third = order[:, 0], order[:, 1], order[:, 2]
    odd = r.sum(axis=1) % 2 != 0
    best, other = r.copy(), r.copy()
    best[rows[odd], first[odd]] += step[rows[odd], first[odd]]
    # The runner-up takes the next cheapest way to an even sum.
    other[rows[odd], second[odd]] += step[rows[odd], second[odd]]
    even = ~odd
    for k in (first, second):
        other[rows[even], k[even]] += step[rows[even], k[even]]
    return best, other


def decode_e8(x: np.ndarray, probes: int) -> np.ndarray:
    """Doubled coordinates of the nearest lattice points: (rows, 1 + probes, 8), nearest first."""
    halves = np.full(DIM, 0.5)
    candidates = np.stack([*decode_d8(x), *(c + halves for c in decode_d8(x - halves))], axis=1)
    distance = ((candidates - x[:, None, :]) ** 2).sum(axis=2)
    order = np.argsort(distance, axis=1, kind="stable")[:, : 1 + probes]
    return np.rint(2 * np.take_along_axis(candidates, order[:, :, None], axis=1)).astype(np.int64)


def _mix(points: np.ndarray, salt: int) -> np.ndarray:
    """64-bit names of lattice points. Two points of one name only cost comparisons."""
    h = np.full(points.shape[:-1], salt * 2 + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(points.shape[-1]):
            h = (h ^ points[..., k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def cells(vectors: np.ndarray, tables: int, probes: int) -> np.ndarray:
    """Names of the cells of unit vectors: (rows, tables, 1 + probes), own cell first."""
    dim = vectors.shape[1]
    out = np.empty((len(vectors), tables, 1 + probes), np.int64)
    for t in range(tables):
        rng = np.random.default_rng((SEED, dim, t))
        matrix, shift = rng.normal(size=(dim, DIM)) * SCALE, rng.uniform(0, 2, DIM)
        out[:, t] = _mix(decode_e8(vectors @ matrix + shift, probes), 1000 * dim + t)
    return out


def _unit(values: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)
    # Scaled first, so that squares neither overflow nor vanish.
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _usable(vec: str) -> Column:
    x = F.col(vec)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(x, lambda v: v != 0)


def _narrow(distinct: DataFrame, tables: int, probes: int) -> DataFrame:
    """``key, label, cell, home``: a row for each cell of each vector."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size in pc.unique(batch.column("size")).to_pylist():
                chosen = batch.filter(pc.equal(batch.column("size"), size))
                names = cells(_unit(chosen.column("vec")), tables, probes).reshape(chosen.num_rows, -1)
                starts = pa.array(np.arange(0, names.size + 1, names.shape[1], dtype=np.int32))
                lists = pa.ListArray.from_arrays(starts, pa.array(names.ravel()))
                yield pa.RecordBatch.from_arrays([chosen.column("key"), chosen.column("label"), lists], ["key", "label", "cells"])

    chosen = distinct.select("key", "label", F.size("vec").alias("size"), "vec")
    label = distinct.schema["label"].dataType.simpleString()
    return chosen.mapInArrow(place, f"key long, label {label}, cells array<long>")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Positions of pairs that join all of ``n`` items which the pairs connect."""
    root, kept = np.arange(n), []
    order = np.argsort(a, kind="stable")
    heads = np.flatnonzero(np.r_[True, np.diff(a[order]) > 0]) if len(a) else []
    for run in np.split(order, heads[1:]) if len(a) else []:
        _, first = np.unique(root[b[run]], return_index=True)
        own = root[a[run[0]]]
        for at in run[first].tolist():
            other = root[b[at]]
            if other != own:
                kept.append(at)
                root[root == other] = own
    return np.array(kept, np.int64)


def _meetings(unit: np.ndarray, home: np.ndarray, names: np.ndarray, keys: np.ndarray, block: np.ndarray, cell: int, between: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the linked pairs that meet in this cell before any other.

    ``between``: only pairs of different blocks; their own blocks are tasks of their own.
    """
    found = []
    for at in range(0, len(unit), 256):
        rows = slice(at, at + 256)
        near = unit[rows] @ unit.T >= threshold
        near &= home[rows, None] | home[None, :]
        near &= keys[rows, None] < keys[None, :]
        if between:
            near &= block[rows, None] != block[None, :]
        i, j = np.nonzero(near)
        for part in range(0, len(i), 20_000):
            x, y = at + i[part : part + 20_000], j[part : part + 20_000]
            in_y = (names[x][:, :, :1] == names[y]).any(axis=2)
            meet = in_y | (names[y][:, :, :1] == names[x]).any(axis=2)
            t = meet.argmax(axis=1)
            rows_of = np.arange(len(x))
            first = np.where(in_y[rows_of, t], names[x, t, 0], names[y, t, 0])
            found.append(np.stack([x, y])[:, first == cell])
    return tuple(np.concatenate(found, axis=1)) if found else (np.zeros(0, np.int64),) * 2


def neighbours(distinct: DataFrame, threshold: float, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``a, b, n``: with ``b``, a spanning link of two keys; without, ``n`` more rows linked to key ``a``.

    ``distinct``: ``key`` (unique), ``label``, ``vec``, ``n`` (rows that hold this vector).
    """
    placed = written(_narrow(distinct, tables, probes), "cells")
    narrow = placed.select("key", "label", F.posexplode("cells").alias("pos", "cell")).withColumn("home", F.col("pos") % (1 + probes) == 0)
    crowd = narrow.groupBy("label", "cell").agg(F.count("*").alias("rows"), F.max("home").alias("any_home"))
    crowd = crowd.filter((F.col("rows") > 1) & F.col("any_home")).select(
        F.col("label").alias("l"), F.col("cell").alias("c"), F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")
    )
    shared = narrow.join(crowd, (F.col("label") == F.col("l")) & (F.col("cell") == F.col("c"))).select(
        "key", "cell", "home", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"), "blocks", F.xxhash64("label", "cell").alias("name")
    )
    # Each vector goes to every pair of blocks that has its own.
    pairs = shared.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = written(
        pairs.select("key", "cell", "home", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "name"), "meetings"
    )
    tasks = max(1, -(-pairs.count() // ROWS))
    vectors = distinct.select("key", "vec", "n", "label").join(placed.select("key", "cells"), "key")
    loaded = pairs.join(vectors, "key").select(
        F.pmod(F.xxhash64("name", "low", "high"), F.lit(tasks)).alias("task"), "name", "low", "high", "cell", "home", "block", "key", "vec", "n", "cells", F.size("vec").alias("size"),
    )

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by([(c, "ascending") for c in ("name", "low", "high", "size", "cell", "key")])
        col = {c: group.column(c).combine_chunks() for c in group.column_names}
        num = {c: col[c].to_numpy(zero_copy_only=False) for c in ("name", "low", "high", "size", "cell", "key", "block", "n", "home")}
        change = np.zeros(group.num_rows, bool)
        change[:1] = True
        for c in ("name", "low", "high", "size", "cell"):
            change[1:] |= num[c][1:] != num[c][:-1]
        heads = np.flatnonzero(change)
        out: list[list[np.ndarray]] = [[], [], [], []]
        for at, end in zip(heads.tolist(), [*heads[1:].tolist(), group.num_rows]):
            keys = num["key"][at:end]
            if end - at < 2:
                continue
            names = col["cells"].slice(at, end - at).flatten().to_numpy().reshape(end - at, tables, 1 + probes)
            unit = _unit(col["vec"].slice(at, end - at))
            x, y = _meetings(unit, num["home"][at:end], names, keys, num["block"][at:end], int(num["cell"][at]), bool(num["low"][at] != num["high"][at]), threshold)
            if not len(x):
                continue
            n = num["n"][at:end]
            linked = np.bincount(x, n[y], end - at) + np.bincount(y, n[x], end - at)
            some = np.flatnonzero(linked)
            f = _forest(x, y, end - at)
            out[0] += [keys[some], keys[x[f]]]
            out[1] += [np.zeros(len(some), np.int64), keys[y[f]]]
            out[2] += [linked[some].astype(np.int64), np.zeros(len(f), np.int64)]
            out[3] += [np.ones(len(some), bool), np.zeros(len(f), bool)]
        a, b, n, no_link = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64(), mask=no_link.astype(bool)), "n": pa.array(n, pa.int64())})

    return loaded.groupBy("task").applyInArrow(compare, "a long, b long, n long")


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label",
    tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """``vec_id, n_links, component_id``, one row per row of ``vectors``."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vec).alias("vec"), F.col(label).alias("label"))
    good = _usable("vec") & F.col("label").isNotNull()
    usable, rest = rows.filter(good), rows.filter(~good)
    grouped = usable.groupBy("label", "vec").agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"))
    distinct = written(grouped.withColumn("key", F.monotonically_increasing_id()), "vectors")
    found = written(neighbours(distinct, threshold, tables, probes), "vector-links")
    degrees = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("linked")).select(F.col("a").alias("key"), "linked")
    parts = components(found.filter("b is not null").select("a", "b")).select(F.col("node").alias("key"), "component")
    known = distinct.select("key", "label", "vec", "n", "first_id").join(degrees, "key", "left").join(parts, "key", "left")
    known = known.withColumn("component", F.coalesce("component", "key"))
    lowest = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = known.join(lowest, "component").select(
        F.col("label").alias("l"), F.col("vec").alias("v"), (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).cast("long").alias("n_links"), "component_id"
    )
    done = usable.join(named, (F.col("label") == F.col("l")) & (F.col("vec") == F.col("v"))).select("vec_id", "n_links", "component_id")
    return done.unionByName(rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
