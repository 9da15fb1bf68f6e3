"""Token ids on disk under one canonical, length-limited Huffman code.

The ids of all documents are counted once; package-merge gives the best code lengths up to a
limit, and the canonical code follows from the lengths alone, so the file of the code holds
``(id, length)`` and nothing else. Ids are written in ascending order of their documents, in
blocks that are decoded independently of each other: a block holds the documents that begin in
one stretch of BLOCK ids, their sizes, the bits, and the size in bits of every EVERY ids. The
running sums of those are bit offsets at which decoding may begin, so a block is decoded at all
of them at once, each step one look into a table of all words of ``limit`` bits.

A folder has three Parquet tables: ``blocks`` (part, first id within the part, documents, bits),
``parts`` (how many ids stand before each part, one row a partition) and ``code``. Positions are
global: ``start`` counts the ids of all documents before.

Documents without ids have an entry of length zero. Null ids of documents come first, and rows
that share a document id are ordered by a hash of their ids; equal rows are each kept. Null
packed ids count as none. An empty table gives an empty folder that reads back empty. Rows of
one document id are split over partitions by that hash and a row number, so no id is hot. What comes to the
driver is bounded by the vocabulary (counts) and the number of partitions (bases).
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import blocks
from .common import drop_path, scratch, text_of
from .tokens import tokenizer

BLOCK = 1 << 15  # ids whose documents share a block; a longer document has a block as long as itself
EVERY = 128  # ids between two checkpoints
SPARE_BITS = 2  # bits that codes may be longer than those of equal length would be
AT_ONCE = 1 << 20  # ids of blocks that a task decodes together


# --- ids of documents -------------------------------------------------------------------------


def ids_column(text: Column, path: str, end_id: int | None, width: str = "<u4") -> Column:
    """Packed ids of the whole text by the published library, ``end_id`` appended; null counts as empty."""
    kind = {"<u2": "H", "<u4": "I"}[width]
    tail = [] if end_id is None else [end_id]

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids_of = tokenizer(path).ids
        for values in batches:
            yield pa.array((array(kind, [*ids_of(t), *tail]).tobytes() for b in blocks(values, 64) for t in b), pa.binary())

    return encode(text_of(text))


def width_of(path: str) -> str:
    """Two bytes an id where the vocabulary allows it, else four."""
    if path.endswith(".model"):
        import sentencepiece

        size = sentencepiece.SentencePieceProcessor(model_file=path).vocab_size()
    else:
        from tokenizers import Tokenizer

        size = Tokenizer.from_file(path).get_vocab_size()
    return "<u2" if size <= 1 << 16 else "<u4"


# --- the code ---------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits of each symbol (all counts above zero) in the best code of at most ``limit`` bits, by package-merge."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit {limit} bits")
    order = np.argsort(counts, kind="stable")
    coins = counts[order].astype(np.float64) if counts.sum() > 1 << 56 else counts[order].astype(np.int64)
    packages, merged = coins[:0], []
    for _ in range(limit):
        both = np.concatenate([coins, packages])
        by = np.argsort(both, kind="stable")
        merged.append(by < n)
        packages = both[by][: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_coin in reversed(merged):
        own = int(is_coin[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code of ``symbols`` (ascending) with the given lengths."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.limit = int(max(lengths.max(initial=1), 1))
        size = int(symbols.max(initial=0)) + 1
        self.bits_of = np.zeros(size, np.int64)
        self.code_of = np.zeros(size, np.uint64)
        order = np.lexsort((symbols, lengths))
        spans = np.int64(1) << (self.limit - lengths[order])
        begins = np.cumsum(spans) - spans
        self.bits_of[symbols] = lengths
        self.code_of[symbols[order]] = (begins >> (self.limit - lengths[order])).astype(np.uint64)
        # Every word of ``limit`` bits: the symbol whose code it begins with, and that code's length.
        filled = int(spans.sum())
        self.symbol_at = np.zeros(1 << self.limit, np.uint32)
        self.step_at = np.ones(1 << self.limit, np.uint8)
        self.symbol_at[:filled] = np.repeat(symbols[order], spans)
        self.step_at[:filled] = np.repeat(lengths[order], spans)

    def pack(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """Bits of the ids, first bit first, and the sizes in bits of every EVERY of them."""
        n = self.bits_of[ids]
        if not len(ids):
            return b"", b""
        ends = np.cumsum(n)
        begins = ends - n
        word, room = begins >> 6, 64 - (begins & 63) - n
        value = self.code_of[ids]
        part = np.where(room >= 0, value << np.maximum(room, 0).astype(np.uint64), value >> np.maximum(-room, 0).astype(np.uint64))
        heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        words = np.zeros((int(ends[-1]) >> 6) + 2, np.uint64)
        words[word[heads]] = np.bitwise_or.reduceat(part, heads)
        over = np.flatnonzero(room < 0)  # at most one code crosses the border of a word
        words[word[over] + 1] |= value[over] << (64 + room[over]).astype(np.uint64)
        sizes = np.diff(np.r_[begins[::EVERY], ends[-1]]).astype("<u2")
        return words.astype(">u8").tobytes()[: (int(ends[-1]) + 7) // 8], sizes.tobytes()

    def unpack(self, some: list[tuple[bytes, bytes, int]], skip: int = 0) -> np.ndarray:
        """All ids of blocks (bits, sizes at checkpoints, number of ids), every checkpoint at once. ``skip``: bits before the first id."""
        counts = np.array([n for _, _, n in some], np.int64)
        rooms = [(len(bits) + 7) // 8 * 8 for bits, _, _ in some]
        held = bytearray(-(-(sum(rooms) + EVERY * self.limit // 8 + 16) // 8) * 8)
        begins, at = [], 0
        for (bits, sizes, _), room in zip(some, rooms):
            held[at : at + len(bits)] = bits
            ends = np.cumsum(np.frombuffer(sizes, "<u2").astype(np.int64))
            begins.append(8 * at + skip + np.r_[0, ends[:-1]] if len(ends) else ends)
            at += room
        half = np.frombuffer(bytes(held), ">u4", len(held) // 4).astype(np.uint64)
        window = (half[:-1] << np.uint64(32)) | half[1:]
        place = np.concatenate(begins)
        out = np.empty((EVERY, len(place)), np.uint32)
        cut = np.uint64(64 - self.limit)
        for k in range(EVERY):
            word = (window[place >> 5] << (place & 31).astype(np.uint64)) >> cut
            out[k] = self.symbol_at[word]
            place = place + self.step_at[word]
        lanes = -(-counts // EVERY)
        last = np.cumsum(lanes)
        use = np.full(int(lanes.sum()), EVERY)
        use[last[counts > 0] - 1] = (counts[counts > 0] - 1) % EVERY + 1
        return out.T[np.arange(EVERY) < use[:, None]]


def fit(packed: DataFrame, width: str = "<u4") -> DataFrame:
    """``id, length``: the code of all ids in the one binary column of ``packed``. As many rows as different ids occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            more = np.bincount(_flat(batch.column(0), width)[0])
            if len(more) > len(total):
                total, more = more, total
            total[: len(more)] += more
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])

    rows = packed.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toArrow()
    ids, counts = rows["id"].to_numpy(), rows["n"].to_numpy()
    limit = max(1, (max(len(ids), 2) - 1).bit_length() + SPARE_BITS)
    table = pa.table({"id": pa.array(ids, pa.int64()), "length": pa.array(code_lengths(counts, limit), pa.int64())})
    return packed.sparkSession.createDataFrame(table)


def _code(rows: DataFrame) -> Code:
    held = rows.orderBy("id").toArrow()
    return Code(held["id"].to_numpy().astype(np.int64), held["length"].to_numpy().astype(np.int64))


# --- files ------------------------------------------------------------------------------------


def _flat(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column one after another, and how many each row has."""
    column = column.fill_null(b"") if column.null_count else column
    size = np.dtype(width).itemsize
    ends = np.frombuffer(column.buffers()[1], "<i4", len(column) + 1, 4 * column.offset).astype(np.int64)
    data = np.frombuffer(column.buffers()[2], width, int(ends[-1] - ends[0]) // size, int(ends[0])) if ends[-1] > ends[0] else np.zeros(0, width)
    return data.astype(np.int64), np.diff(ends) // size


def write_ids(docs: DataFrame, folder: str, width: str = "<u4", doc_id: str = "doc_id", ids: str = "ids") -> None:
    """Write the packed ids (``width``) of every row of ``docs`` to ``folder``, in ascending order of the document ids."""
    spark = docs.sparkSession
    path = scratch(spark, "ids")
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"), F.xxhash64(ids).alias("tie"), F.monotonically_increasing_id().alias("row"))
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    fit(rows.select("ids"), width).coalesce(1).write.parquet(f"{folder}/code")
    code = _code(spark.read.parquet(f"{folder}/code"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = 0
        for batch in batches:
            flat, sizes = _flat(batch.column(2), width)
            ends = np.cumsum(sizes)
            begins = ends - sizes
            heads = np.flatnonzero(np.r_[True, np.diff(begins // BLOCK) > 0]) if len(sizes) else np.zeros(0, np.int64)
            tails = np.r_[heads[1:], len(sizes)]
            spans = [(int(begins[a]), int(ends[b - 1])) for a, b in zip(heads, tails)]
            bits, marks = zip(*(code.pack(flat[a:b]) for a, b in spans)) if spans else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column(1).to_numpy()[heads], pa.int32()), pa.array([base + a for a, _ in spans], pa.int64()), pa.array([b - a for a, b in spans], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.r_[heads, len(sizes)], pa.int32()), batch.column(0)),
                    pa.array([sizes[a:b].astype("<u4").tobytes() for a, b in zip(heads, tails)], pa.binary()), pa.array(marks, pa.binary()), pa.array(bits, pa.binary()),
                ],
                ["part", "first", "n_ids", "doc_ids", "sizes", "checkpoints", "bits"],
            )
            base += int(ends[-1]) if len(ends) else 0

    ordered = rows.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row")
    schema = f"part int, first long, n_ids long, doc_ids array<{kind.simpleString()}>, sizes binary, checkpoints binary, bits binary"
    # The bits have no redundancy left to press out.
    ordered.select("doc_id", F.spark_partition_id().alias("part"), "ids").mapInArrow(encode, schema).write.option("compression", "none").parquet(f"{folder}/blocks")
    drop_path(spark, path)
    totals = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").toArrow()
    ends = np.cumsum(totals["n"].to_numpy().astype(np.int64))
    parts = pa.table({"part": totals["part"], "start": pa.array(np.r_[0, ends][: len(ends)], pa.int64()), "n_ids": totals["n"]})
    spark.createDataFrame(parts).coalesce(1).write.parquet(f"{folder}/parts")


def _bases(spark: SparkSession, folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    held = spark.read.parquet(f"{folder}/parts").orderBy("part").toArrow()
    return tuple(held[c].to_numpy().astype(np.int64) for c in ("part", "start", "n_ids"))


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (packed, 32 bits) of every document in ``folder``."""
    stored = spark.read.parquet(f"{folder}/blocks")
    code = _code(spark.read.parquet(f"{folder}/code"))
    parts, starts, _ = _bases(spark, folder)
    kind = stored.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy()
            group = np.cumsum(n) // AT_ONCE
            cuts = np.r_[0, np.flatnonzero(np.diff(group)) + 1, len(n)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                some = batch.slice(a, b - a)
                bits, marks = some.column(6).to_pylist(), some.column(5).to_pylist()
                flat = code.unpack(list(zip(bits, marks, some.column(2).to_pylist())))
                sizes = [np.frombuffer(s, "<u4").astype(np.int64) for s in some.column(4).to_pylist()]
                first = starts[np.searchsorted(parts, some.column(0).to_numpy())] + some.column(1).to_numpy()
                begins = np.concatenate([f + np.cumsum(s) - s for f, s in zip(first.tolist(), sizes)])
                every = np.concatenate(sizes)
                ends = np.r_[0, np.cumsum(4 * every)].astype("<i4")
                packed = pa.Array.from_buffers(pa.binary(), len(every), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.astype("<u4").tobytes())])
                yield pa.RecordBatch.from_arrays([some.column(3).flatten(), pa.array(begins), pa.array(every), packed], ["doc_id", "start", "n_tokens", "ids"])

    columns = stored.select("part", "first", "n_ids", "doc_ids", "sizes", "checkpoints", "bits")
    return columns.mapInArrow(decode, f"doc_id {kind}, start long, n_tokens long, ids binary")


def read_range(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """``start, ids`` of the positions from ``first`` up to and without ``last``: one row per block that has any.

    Only parts that hold any are scanned, and of a block only the stretches between checkpoints that are asked for.
    """
    code = _code(spark.read.parquet(f"{folder}/code"))
    parts, starts, sizes = _bases(spark, folder)
    touched = parts[(starts < last) & (starts + sizes > first)]
    low, high = (int(touched[0]), int(touched[-1])) if len(touched) else (1, 0)
    stored = spark.read.parquet(f"{folder}/blocks").filter(F.col("part").between(low, high))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part, begin, n, marks, bits in zip(*(c.to_pylist() for c in batch.columns)):
                begin += int(starts[np.searchsorted(parts, part)])
                a, b = max(first - begin, 0), min(last - begin, n)
                if a >= b:
                    continue
                lane, end = a // EVERY, -(-b // EVERY)
                ends = np.cumsum(np.frombuffer(marks, "<u2").astype(np.int64))
                at = int(ends[lane - 1]) if lane else 0
                # Whole bytes from the checkpoint on; the bits before it in the first byte are stepped over.
                held = code.unpack([(bits[at // 8 : int(ends[end - 1]) // 8 + 1], marks[2 * lane : 2 * end], min(n, end * EVERY) - lane * EVERY)], at % 8)
                out.append((begin + a, held[a - lane * EVERY : b - lane * EVERY].astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())], ["start", "ids"])

    return stored.select("part", "first", "n_ids", "checkpoints", "bits").mapInArrow(decode, "start long, ids binary")
