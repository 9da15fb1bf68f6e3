"""Ranked lexical search by the Best Position Algorithm over impact lists.

An index holds whole documents in segments of bounded size. A segment has its own dictionary,
and for every term the documents that hold it with the term's frequency; the statistics that
weigh them (documents, terms, documents of a term) are counted over all segments. A search turns
frequencies into impacts, and orders every list of an item's terms by falling impact.

The lists of an item are then read from the top in growing steps. Each document met is looked up
in all other lists at once (direct access), which gives its whole score and marks its position in
each of them as seen. The best position of a list is the last one up to which all are seen, by
whichever access; a document not met yet stands below it in every list, so no more than the sum
of the impacts just below the best positions is left for it. Reading stops when this sum is
strictly below the k-th score met so far, so that equal scores are never lost. Each segment gives
its best k; the best k of those are the result.

Items come in blocks of bounded size; each block is one pass over the index and needs only its
own terms. Null and empty texts have no terms, and documents without terms are indexed but never
found. Repeated rows and ids are documents of their own. Equal scores rank by ascending id, null
ids last. An empty index or an empty table of items gives no rows. Extra columns are not carried.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of

SEGMENT_DOCS = 16_384  # of a segment, at most; below two to the 15th
SEGMENT_TERMS = 1 << 22  # from which a segment is closed
FIRST_STEP = 16  # positions of each list read first; every further step reads twice as many
ITEMS = 1_000  # items of a block, at most
ITEM_TERMS = 200_000  # different terms of an item block from which the block is closed
BLANK = ord(" ")

# Everything that ends a term becomes a blank; other bytes, also all of longer characters, belong to terms.
PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else BLANK for b in range(256))

INDEX_COLUMNS = "n_docs long, n_terms long, dictionary binary, ends binary, holders binary, frequencies binary, lengths binary"


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased."""
    return text.translate(PLAIN).split()


class _Numbers(dict):
    """Terms numbered as they are first met."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


# --- index ------------------------------------------------------------------------------------


def build_index(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the segments of all rows of ``docs`` to ``folder`` and return them."""
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType

    def segment(ids: list[pa.Array], numbers: _Numbers, found: list[np.ndarray]) -> pa.RecordBatch:
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        key = (np.concatenate(found) << 32) | np.repeat(np.arange(len(found)), lengths)
        key, tf = np.unique(key, return_counts=True)
        ends = np.searchsorted(key, (np.arange(len(numbers), dtype=np.int64) + 1) << 32)
        packed = [b" ".join(numbers), ends.astype("<i4").tobytes(), (key & 0xFFFFFFFF).astype("<i4").tobytes(), tf.astype("<i4").tobytes(), lengths.astype("<i8").tobytes()]
        own = pa.concat_arrays(ids)
        columns = [pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64()), *(pa.array([p], pa.binary()) for p in packed)]
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)], [*(c.split()[0] for c in INDEX_COLUMNS.split(", ")), "doc_ids"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, numbers, found, size = [], _Numbers(), [], 0
        for batch in batches:
            bodies, begin = batch.column(1).cast(pa.binary()), 0
            for i in range(len(bodies)):
                words = terms_of(bodies[i].as_py())
                found.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                size += len(words)
                if size >= SEGMENT_TERMS or len(found) >= SEGMENT_DOCS:
                    yield segment([*ids, batch.column(0).slice(begin, i + 1 - begin)], numbers, found)
                    ids, numbers, found, size, begin = [], _Numbers(), [], 0, i + 1
            if begin < len(bodies):
                ids.append(batch.column(0).slice(begin))
        if found:
            yield segment(ids, numbers, found)

    schema = T._parse_datatype_string(INDEX_COLUMNS).add("doc_ids", T.ArrayType(kind))
    docs.select(F.col(doc_id), text_of(F.col(text))).mapInArrow(gather, schema).write.parquet(folder)
    return spark.read.schema(schema).parquet(folder)


# --- search -----------------------------------------------------------------------------------


def best_positions(lists: list[np.ndarray], impacts: list[np.ndarray], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents met and their scores, among them all whose score is one of the k largest.

    ``lists``: documents of each list by falling impact, ``impacts``: theirs, weights included.
    """
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    first = np.cumsum(size) - size
    doc, value = np.concatenate(lists), np.concatenate(impacts)
    # Where each document stands in all lists together.
    by_doc = np.argsort(doc.astype(np.int16), kind="stable")
    begin = np.r_[0, np.cumsum(np.bincount(doc, minlength=n_docs))]
    seen, known = np.zeros(len(doc), bool), np.zeros(n_docs, bool)
    best, read, step = np.zeros(len(lists), np.int64), 0, FIRST_STEP
    docs, scores, top = [], [], np.zeros(0, np.int64)
    while True:
        met = np.concatenate([doc[f + read : f + min(read + step, n)] for f, n in zip(first.tolist(), size.tolist()) if read < n])
        new = np.unique(met[~known[met]])
        if len(new):
            known[new] = True
            count = begin[new + 1] - begin[new]
            heads = np.cumsum(count) - count
            places = by_doc[np.repeat(begin[new] - heads, count) + np.arange(int(count.sum()))]
            seen[places] = True
            own = np.add.reduceat(value[places], heads)
            docs.append(new)
            scores.append(own)
            top = np.concatenate([top, own])
            if len(top) > k:
                top = np.partition(top, len(top) - k)[-k:]
        read += step
        step *= 2
        bound = 0
        for t, (f, n) in enumerate(zip(first.tolist(), size.tolist())):
            b = int(best[t])
            if b < n:
                left = seen[f + b : f + n]
                j = int(left.argmin())
                best[t] = b = n if left[j] else b + j
                if b < n:
                    bound += int(value[f + b])
        if len(top) >= k and bound < top.min() or not bound and (best == size).all():
            return np.concatenate(docs), np.concatenate(scores)


class _Block:
    """The items of one pass: their terms, numbered, and how often each item has them."""

    def __init__(self, rows: list):
        self.numbers = _Numbers()
        self.items = [Counter(self.numbers[t] for t in terms_of((text or "").encode("utf-8", "surrogatepass"))) for _, text in rows]
        self.terms = list(self.numbers)


def _blocks_of(items: DataFrame, item_id: str, text: str) -> Iterator[list]:
    rows = items.select(item_id, text).toLocalIterator()
    while held := list(islice(rows, ITEMS)):
        start = 0
        seen: set[bytes] = set()
        for i, (_, body) in enumerate(held):
            seen.update(terms_of((body or "").encode("utf-8", "surrogatepass")))
            if len(seen) >= ITEM_TERMS:
                yield held[start : i + 1]
                start, seen = i + 1, set()
        if start < len(held):
            yield held[start:]


def _lists(dictionary: bytes, ends: bytes, wanted: dict[bytes, int]) -> Iterator[tuple[int, int, int]]:
    """Of each wanted term of a segment its number in the block and where its list begins and ends."""
    bounds = np.frombuffer(ends, "<i4").tolist()
    for i, term in enumerate(dictionary.split(b" ") if dictionary else []):
        if (n := wanted.get(term)) is not None:
            yield n, bounds[i - 1] if i else 0, bounds[i]


def _holders(index: DataFrame, block: _Block) -> np.ndarray:
    """In how many documents each term of the block occurs. As many rows come to the driver as the block has terms."""
    wanted = dict(block.numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for dictionary, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for n, a, b in _lists(dictionary, ends, wanted):
                    total[n] += b - a
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], ["term", "n"])

    rows = index.select("dictionary", "ends").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(wanted), np.int64)
    out[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return out


def _search_block(index: DataFrame, block: _Block, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``item, doc_id, score``: the best k of every segment for each item (by its number in the block)."""
    df = _holders(index, block)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    wanted = dict(block.numbers)
    items = [{t: n * int(weights[t]) for t, n in item.items() if weights[t] > 0} for item in block.items]
    kind = index.schema["doc_ids"].dataType.elementType

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dictionary, ends, holders, frequencies, lengths = (batch.column(c)[i].as_py() for c in range(5))
                doc_ids = batch.column(5)[i].values
                n = np.frombuffer(lengths, "<i8")
                spread = 100 - 25 + 25 * n * n_docs // max(1, n_terms)
                doc, tf = np.frombuffer(holders, "<i4"), np.frombuffer(frequencies, "<i4")
                lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
                for t, a, b in _lists(dictionary, ends, wanted):
                    own, times = doc[a:b], tf[a:b].astype(np.int64)
                    impact = 1_000_000_000 * times // (1000 * times + 12 * spread[own])
                    order = np.argsort(-impact, kind="stable")
                    lists[t] = own[order], impact[order]
                number, chosen, score = [], [], []
                for item, terms in enumerate(items):
                    held = [(lists[t], w) for t, w in terms.items() if t in lists]
                    if not held:
                        continue
                    docs, total = best_positions([d for (d, _), _ in held], [v * w for (_, v), w in held], len(n), k)
                    if len(total) > k:
                        use = total >= np.partition(total, len(total) - k)[-k]
                        docs, total = docs[use], total[use]
                    good = total > 0
                    docs, total = docs[good], total[good]
                    ids = doc_ids.take(pa.array(docs))
                    names = ids.to_pylist()
                    ranked = sorted(range(len(names)), key=lambda r: (-total[r], names[r] is None) if names[r] is None else (-total[r], False, names[r]))[:k]
                    number += [item] * len(ranked)
                    chosen.append(ids.take(pa.array(ranked, pa.int64())))
                    score += total[ranked].tolist()
                if number:
                    yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.concat_arrays(chosen), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])
    return index.select("dictionary", "ends", "holders", "frequencies", "lengths", "doc_ids").mapInArrow(search, schema)


def search(index: DataFrame, items: DataFrame, k: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item with a score above 0."""
    spark: SparkSession = index.sparkSession
    kind = items.schema[item_id].dataType
    stats = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)])
    results = []
    for rows in _blocks_of(items, item_id, text):
        block = _Block(rows)
        if not stats[0] or not block.terms:
            continue
        found = _search_block(index, block, int(stats[0]), int(stats[1]), k)
        in_order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = found.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], schema)
        results.append(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        whole = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", index.schema["doc_ids"].dataType.elementType), T.StructField("score", T.LongType())])
        return spark.createDataFrame([], whole)
    out = results[0]
    for more in chain(results[1:]):
        out = out.unionByName(more)
    return out
