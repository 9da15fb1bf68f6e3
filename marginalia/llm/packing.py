"""Best-fit packing of token pieces by a grouping genetic algorithm.

A piece as long as a sequence is a sequence of its own. All others are dealt at random into
cohorts of bounded size, so a cohort has the corpus's mix of lengths and one task packs it. Each
cohort is worked on by several islands: a population of packings, begun with best-fit decreasing
and shuffled best fit. Crossover injects whole well-filled bins of one parent into the other,
drops the other's bins that hold any of the same pieces, and best-fits the displaced ones;
mutation does so with the worst bins. After an epoch the islands pass their elite on to the next
island of the cohort, and evolve again. Well-filled bins of a cohort's best packing stay; the
pieces of the others are dealt into new cohorts and packed again, all over the corpus.

Everything is seeded by cohort and island and ordered by (length, row), so a task that runs
again gives the same bins. A cohort is a function of the number of rows, never of a key, so no
document, source or length is hot. Empty input gives empty output; null lengths and lengths
below one are an error of the input. Pieces longer than a sequence are sequences of their own.
Columns of the input pass through; its columns named like an output are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import blocks
from .common import text_of, written
from .tokens import pack_ids, tokenizer

COHORT = 16384  # mean pieces of a cohort
ISLANDS = 2
POPULATION = 4
GENERATIONS = 8  # of an epoch
EPOCHS = 2
WELL_FILLED = 0.998  # share of a sequence from which a bin is settled before the last round
BINS_BITS = 20  # bins of a cohort stay below two to this power


# --- pieces -----------------------------------------------------------------------------------


def split_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and packed ``ids``) of every document.

    A document is its ids and ``end_id``. Longer ones than ``capacity`` are cut into pieces of
    ``capacity`` ids, the first piece being the shorter one. A null text is the end id alone.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), text_of(F.col(text)).alias("body"))
    kind = "array<struct<piece:int,start:long,length:long,ids_crc32:long" + (",ids:binary>>" if with_ids else ">>")
    item = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if with_ids else [])))

    @F.arrow_udf(kind)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids_of = tokenizer(path).ids
        for values in batches:
            out = []
            for body in (t for b in blocks(values, 64) for t in b):
                ids = ids_of(body)
                packed = pack_ids([*ids, end_id])
                n = len(packed) // 4
                begins = [0, *range((n - 1) % capacity + 1, n, capacity)]
                pieces = []
                for k, (a, b) in enumerate(zip(begins, [*begins[1:], n])):
                    part = packed[4 * a : 4 * b]
                    pieces.append({"piece": k, "start": a, "length": b - a, "ids_crc32": zlib.crc32(part)} | ({"ids": part} if with_ids else {}))
                out.append(pieces)
            yield pa.array(out, item)

    return chosen.select("doc_id", F.inline(cut(F.col("body"))))


# --- one cohort -------------------------------------------------------------------------------


def best_fit(sizes: list[int], order, capacity: int, free: list[int], bins: np.ndarray) -> None:
    """Put the pieces in ``order`` each into the fullest bin with room, else into a new one.

    ``free``: room of each bin, ``bins``: bin of each piece; both are changed. Bins by room are
    found through a bit set, so a piece costs the same whatever the number of bins.
    """
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for b, r in enumerate(free):
        if r > 0:
            with_room[r].append(b)
            rooms |= 1 << r
    for i in order:
        size = sizes[i]
        fits = rooms >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = with_room[r].pop()
            if not with_room[r]:
                rooms &= ~(1 << r)
        else:
            r, b = capacity, len(free)
            free.append(capacity)
        bins[i] = b
        free[b] = r = r - size
        if r:
            with_room[r].append(b)
            rooms |= 1 << r


def compact(bins: np.ndarray) -> np.ndarray:
    """Bins numbered from 0 without gaps."""
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fills(bins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.bincount(bins, weights=sizes).astype(np.int64)


def fitness(bins: np.ndarray, sizes: np.ndarray, capacity: int) -> float:
    """Fewer bins first; of equal numbers the one whose bins differ most in fill."""
    f = fills(bins, sizes) / capacity
    return -float(len(f)) + float((f * f).mean())


def rebuild(keep: np.ndarray, bins: np.ndarray, sizes: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    """The packing that keeps the bins of the pieces in ``keep`` and best-fits all others."""
    out = np.full(len(bins), -1, np.int32)
    out[keep] = compact(bins[keep]) if keep.any() else []
    free = (capacity - fills(out[keep], sizes[keep])).tolist() if keep.any() else []
    best_fit(sizes.tolist(), order[~keep[order]].tolist(), capacity, free, out)
    return out


def cross(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Inject well-filled bins of ``a`` into ``b``; pieces are ordered by falling size."""
    fill = fills(a, sizes)
    chosen = (fill >= np.quantile(fill, rng.uniform(0.1, 0.6))) & (rng.random(len(fill)) < 0.8)
    injected = chosen[a]
    doubled = np.zeros(int(b.max()) + 1, bool)
    doubled[b[injected]] = True
    kept = ~injected & ~doubled[b]
    mixed = np.where(injected, a, b + len(fill))
    return rebuild(injected | kept, mixed, sizes, np.arange(len(sizes)), capacity)


def mutate(a: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Dissolve the worst bins and a few others, and best-fit their pieces in a loosened order."""
    fill = fills(a, sizes)
    gone = (fill < capacity) & (rng.random(len(fill)) < 0.7) | (rng.random(len(fill)) < 0.05)
    order = np.argsort(-sizes * rng.uniform(0.85, 1.0, len(sizes)), kind="stable")
    return rebuild(~gone[a], a, sizes, order, capacity)


def evolve(sizes: np.ndarray, capacity: int, seed: int, elites: list[np.ndarray], generations: int = GENERATIONS) -> np.ndarray:
    """The best packing of an island. ``sizes`` fall; ``elites``: packings that came from other islands."""
    rng = np.random.default_rng(seed)
    least = -(-int(sizes.sum()) // capacity)
    everything = np.zeros(len(sizes), bool)
    blank = np.zeros(len(sizes), np.int32)
    crowd = [*elites, rebuild(everything, blank, sizes, np.arange(len(sizes)), capacity)]
    while len(crowd) < POPULATION:
        crowd.append(rebuild(everything, blank, sizes, np.argsort(-sizes * rng.uniform(0.7, 1.0, len(sizes)), kind="stable"), capacity))
    score = lambda x: fitness(x, sizes, capacity)
    crowd.sort(key=score, reverse=True)
    for _ in range(generations):
        if int(crowd[0].max()) + 1 <= least:
            break
        young = [cross(crowd[i], crowd[j], sizes, capacity, rng) for i, j in (rng.choice(len(crowd), 2, replace=False) for _ in range(POPULATION // 2))]
        young += [mutate(x, sizes, capacity, rng) for x in (crowd[0], young[0])]
        crowd = sorted([*crowd, *young], key=score, reverse=True)[:POPULATION]
    return crowd[0]


# --- all cohorts ------------------------------------------------------------------------------


def _round(items: DataFrame, cohorts: int, capacity: int, salt: int) -> DataFrame:
    """``row, length, cohort, bin, offset, fill`` of every item, by islands and migration."""
    dealt = items.withColumn("cohort", F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(cohorts)))
    on_islands = dealt.select("cohort", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"), "row", "length")
    elite_schema = "cohort long, island int, score double, bins binary"

    def in_order(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values(["length", "row"], ascending=[False, True], kind="stable")

    def elite(key: tuple, number: int, rows: pd.DataFrame, came: list[np.ndarray]) -> pd.DataFrame:
        sizes = in_order(rows)["length"].to_numpy()
        best = evolve(sizes, capacity, zlib.crc32(repr((salt, number, *map(int, key))).encode()), came)
        return pd.DataFrame({"cohort": [key[0]], "island": [key[1]], "score": [fitness(best, sizes, capacity)], "bins": [best.astype(np.int32).tobytes()]})

    def begin(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return elite(key, 0, rows, [])

    def go_on(number: int):
        def run(key: tuple, rows: pd.DataFrame, came: pd.DataFrame) -> pd.DataFrame:
            return elite(key, number, rows, [np.frombuffer(b, np.int32) for b in came.sort_values(["score", "island"])["bins"]])

        return run

    groups = on_islands.groupBy("cohort", "island")
    elites = written(groups.applyInPandas(begin, elite_schema), "elites")
    for number in range(1, EPOCHS):
        moved = elites.withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int"))
        came = elites.unionByName(moved).groupBy("cohort", "island")
        elites = written(groups.cogroup(came).applyInPandas(go_on(number), elite_schema), "elites")
    best = elites.groupBy("cohort").agg(F.max_by("bins", F.struct("score", -F.col("island"))).alias("bins"))

    def place(key: tuple, rows: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
        rows = in_order(rows)
        bins, sizes = np.frombuffer(best["bins"].iloc[0], np.int32), rows["length"].to_numpy()
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(sizes[order])
        heads = np.flatnonzero(np.r_[True, np.diff(bins[order]) > 0])
        begin = (ends - sizes[order])[heads]
        offset = np.empty(len(bins), np.int64)
        offset[order] = ends - sizes[order] - np.repeat(begin, np.diff(np.r_[heads, len(bins)]))
        return rows.assign(bin=bins.astype(np.int64), offset=offset, fill=fills(bins, sizes)[bins])[["row", "length", "cohort", "bin", "offset", "fill"]]

    return dealt.groupBy("cohort").cogroup(best.groupBy("cohort")).applyInPandas(place, "row long, length long, cohort long, bin long, offset long, fill long")


def pack(pieces: DataFrame, capacity: int, length: str = "length", rounds: int = 2) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences of at most ``capacity``, as few as can be found."""
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    # The piece travels as one field, so that no column of the user meets one of ours.
    piece = F.struct(*(F.col(f"`{c}`") for c in kept)) if kept else F.struct(F.lit(0).alias("none"))
    rows = written(pieces.select(piece.alias("piece"), F.col(f"`{length}`").cast("long").alias("length"), F.monotonically_increasing_id().alias("at")), "pieces")
    open_rows = rows.filter(F.col("length") < capacity).select(F.col("at").alias("row"), "length")
    placed, base = [], 0
    for number in range(rounds):
        n = open_rows.count()
        cohorts = max(1, -(-n // COHORT))
        done = _round(open_rows, cohorts, capacity, number)
        done = done.withColumn("sequence_id", F.shiftleft(F.lit(base).cast("long") + F.col("cohort"), BINS_BITS) + F.col("bin"))
        if number + 1 < rounds:
            done = written(done, "packed")
            settled = F.col("fill") >= int(WELL_FILLED * capacity)
            open_rows = done.filter(~settled).select("row", "length")
            done = done.filter(settled)
        placed.append(done.select("row", (2 * F.col("sequence_id") + 1).alias("sequence_id"), "offset"))
        base += cohorts
    found = placed[0]
    for more in placed[1:]:
        found = found.unionByName(more)
    joined = rows.join(found, rows["at"] == found["row"], "left")
    placed = F.coalesce("sequence_id", 2 * F.col("at")), F.coalesce("offset", F.lit(0)).cast("long")
    return joined.select(*(F.col(f"piece.`{c}`") for c in kept), placed[0].alias("sequence_id"), placed[1].alias("offset"))


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """``sequence_id, n_ids, ids``: the packed pieces put together in order of their offsets."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", F.hex(ids).alias("ids")))).alias("parts"))
    joined = F.unhex(F.array_join(F.transform("parts", lambda p: p["ids"]), ""))
    return parts.select("sequence_id", (F.octet_length(joined) / 4).cast("long").alias("n_ids"), joined.alias("ids"))
