"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > k) = sigmoid(w.x - t_k): all grades share the weights of hashed text features, ordered
thresholds part them. Features are the distinct words of a document, their stems, and levels of a few shape
measures, hashed to 2^24 places; an L1 penalty leaves few weights, which is what travels to the
scoring tasks. The expected grade is the sum of the tail probabilities; a document is selected
by the tail probability of one grade.

The fit uses at most ``SAMPLE`` rated documents (those of smallest id hash), a bound that does
not grow with the corpus: it happens in one task whose input it limits. Scoring covers every
document, whole. Without a rated document there is no model: scores are null and all is kept.

A null text counts as empty. Ratings that are null, and ids that are null, take no part in the
fit. Repeated ids are scored row by row. Extra columns do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import blocks
from .common import kept_rows, text_of

PLACES = 1 << 24
SAMPLE = 6000  # rated documents of a fit
ITERATIONS = 500
PENALTY = 2.5e-4
LEVELS = 10
LEAST = 0.25  # a document is only rejected when three to one against it
STEMS = (5, 7)  # characters of word beginnings that are features too
EDGE = re.compile(r"^\W+|\W+$")


def features(text: str) -> list[int]:
    """Hashed places of a document: its words and their stems, and levels of its shape."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    distinct = set(words)
    symbols = sum(map(text.count, "#*$%&|<>"))
    capitals = sum(1 for w in words if w.isupper() and len(w) > 1)
    shape = {
        "symbols": symbols / n, "capitals": capitals / n, "exclamations": text.count("!") / n, "bars": text.count("|") / n,
        "repeats": 1 - len(distinct) / n, "long": sum(map(len, words)) / n / 20, "lines": text.count("\n") / n,
        "digits": sum(map(text.count, "0123456789")) / size,
    }
    names = {f"\0{k}:{min(LEVELS, int(v * LEVELS))}" for k, v in shape.items()} | {f"\0size:{len(words).bit_length()}"}
    plain = {EDGE.sub("", w) if not w.isalnum() else w for w in {w.lower() for w in distinct}}
    names |= plain
    # Inflected and compound words share their stems.
    for n in STEMS:
        names |= {w[:n] + "\1" for w in plain if len(w) > n}
    return sorted({zlib.crc32(x.encode("utf-8", "surrogatepass")) % PLACES for x in names})


def grade_of(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 harmless but poor, 2 good; null unless both ratings are there."""
    return F.when(toxic.isNull() | quality.isNull(), None).when(toxic > 0, 0).when(quality > 0, 2).otherwise(1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_rows(rows: list[list[int]], grades: np.ndarray, top: int) -> tuple[dict[int, float], list[float]]:
    """Weights by place, and ``top`` thresholds, by accelerated proximal gradient steps."""
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows])
    places, column = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    often = np.bincount(column) >= 3  # a place seen once or twice says nothing
    live = often[column]
    column, owner = (np.cumsum(often) - 1)[column[live]], owner[live]
    places = places[often]
    k = np.arange(top)
    above = (grades[:, None] > k).astype(float)
    share = np.clip(above.mean(axis=0), 0.01, 0.99)
    t = -np.log(share / (1 - share))
    # Rare grades weigh as much as common ones.
    n_of = np.bincount(grades, minlength=top + 1)
    weight = (len(grades) / ((n_of > 0).sum() * np.maximum(n_of, 1)))[grades][:, None] / len(grades)
    w = np.zeros(len(places))
    look, ahead = w.copy(), 1.0
    size = 4.0 / max(1.0, float(np.bincount(column, weights=np.broadcast_to(weight, (len(grades), 1))[owner, 0], minlength=len(places)).max()) * top * 8)
    for _ in range(ITERATIONS):
        score = np.bincount(owner, weights=look[column], minlength=len(grades))
        off = weight * (_sigmoid(score[:, None] - t) - above)
        slope = np.bincount(column, weights=off.sum(axis=1)[owner], minlength=len(places))
        step = look - size * slope
        new = np.sign(step) * np.maximum(np.abs(step) - size * PENALTY, 0)
        following = (1 + np.sqrt(1 + 4 * ahead * ahead)) / 2
        look, w, ahead = new + (ahead - 1) / following * (new - w), new, following
        t = np.maximum.accumulate(t + off.sum(axis=0) * 2)
    kept = np.flatnonzero(w)
    return dict(zip(places[kept].tolist(), w[kept].tolist())), t.tolist()


def fit(docs: DataFrame, ratings: DataFrame, top: int = 2, doc_id: str = "doc_id", text: str = "text", grade: str = "grade", sample: int = SAMPLE) -> tuple[dict[int, float], list[float]]:
    """A model from ``ratings`` (id, grade 0..top) of ``docs``. Empty without rated documents."""
    rated = ratings.select(F.col(doc_id).alias("rated_id"), F.col(grade).cast("int").alias("grade")).filter("rated_id is not null and grade is not null")
    chosen = rated.orderBy(F.xxhash64("rated_id"), "rated_id", "grade").limit(sample)
    body = docs.select(F.col(doc_id).alias("doc_id"), text_of(F.col(text)).alias("body"))
    # At most ``sample`` rows, whatever the corpus.
    joined = body.join(F.broadcast(chosen), body["doc_id"] == chosen["rated_id"])

    @F.arrow_udf("array<long>")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            yield pa.array((features(t) for b in blocks(values, 64) for t in b), pa.list_(pa.int64()))

    def train(group: pa.Table) -> pa.Table:
        group = group.sort_by([("rank", "ascending"), ("rated_id", "ascending"), ("grade", "ascending")])
        weights, thresholds = fit_rows(group.column("places").to_pylist(), group.column("grade").to_numpy().astype(np.int64), top)
        return pa.table({"place": pa.array([*range(-top, 0), *weights], pa.int64()), "value": pa.array([*thresholds, *weights.values()], pa.float64())})

    # Repeated ids in the documents must not widen the bound.
    rows = joined.select("rated_id", F.xxhash64("rated_id").alias("rank"), "grade", hashed(F.col("body")).alias("places"))
    rows = rows.orderBy("rank", "rated_id", "grade").limit(sample)
    found = rows.groupBy(F.lit(0).alias("one")).applyInArrow(train, "place long, value double").collect()
    model = {r["place"]: r["value"] for r in found}
    return {p: v for p, v in model.items() if p >= 0}, [model[p] for p in sorted(p for p in model if p < 0)]


def score(docs: DataFrame, model: tuple[dict[int, float], list[float]], doc_id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id, expected_grade, tails``: ``tails[k]`` is the probability of a grade above k.

    With ``carry``, also the whole row as ``row``.
    """
    weights, thresholds = model
    own = [F.struct("*").alias("row")] if carry else []
    row = ["row"] if carry else []
    body = docs.select(F.col(doc_id).alias("doc_id"), text_of(F.col(text)).alias("body"), *own)
    if not thresholds:
        return body.select("doc_id", *row, F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("array<double>").alias("tails"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # bounded by the words of the sample

    @F.arrow_udf("double")
    def value(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = shared.value.get
        for values in batches:
            yield pa.array([sum(of(p, 0.0) for p in features(t)) for b in blocks(values, 64) for t in b], pa.float64())

    scored = body.select("doc_id", *row, value(F.col("body")).alias("score"))
    tails = F.array(*[1 / (1 + F.exp(F.lit(t) - F.col("score"))) for t in thresholds])
    return scored.select("doc_id", *row, tails.alias("tails")).select(
        "doc_id", *row, F.aggregate("tails", F.lit(0.0), lambda a, x: a + x).alias("expected_grade"), "tails"
    )


def select(scored: DataFrame, above: int = 1, least: float = LEAST) -> DataFrame:
    """``scored`` with ``tail``, the probability of a grade above ``above``, and ``kept``."""
    tail = F.get("tails", F.lit(above))
    return scored.withColumn("tail", tail).withColumn("kept", F.coalesce(tail >= least, F.lit(True)))


def keep_good(docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that a model fitted to their ratings selects, as they are."""
    model = fit(docs, ratings, doc_id=doc_id, text=text)
    return kept_rows(select(score(docs, model, doc_id, text, carry=True)), "kept", "row")
