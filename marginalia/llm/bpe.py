"""Byte-level BPE encoding and decoding by speculation and verification.

A word is cut greedily into the longest vocabulary entries. That guess is the true encoding
exactly when every two neighbours are compatible, i.e. no merge across their border would have
run before the merges that built them. All neighbours of all new words of a batch are tested at
once with array operations; only words that fail are merged step by step.

Words repeat, so a worker remembers their ids in two generations of bounded size. Ids travel as
``binary`` (little-endian unsigned 32-bit), four bytes an id and no boxing; ``ids_array`` unpacks
them.

Nulls count as empty texts and give no ids. Texts are encoded whole, whatever their length.
Extra columns pass through; an existing column named like an output is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

# The published splitting pattern of byte-level BPE.
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
# Alphabets in which all Unicode versions agree about letters and digits. A text with any other
# character is split by the published library, whose Unicode version decides.
SETTLED = re.compile("[^\x00-ͷΑ-ΡΣ-ԯ -⁤₠-₿　-〿ぁ-ゖァ-ヺ一-龥가-힣]")
# A blank between two characters that are no blanks always begins a new word.
UNEVEN = re.compile(r"\s | \s|^\s|\s$")
REMEMBERED = 80_000  # chunks in each of the two generations of a worker's memory
BLOCK_CHARS = 500_000  # characters split before new words are verified together
NEVER = np.int64(1) << 40
WIDTHS = (8, 16, 32, 64)  # bytes of the words that are merged together; longer ones are merged on their own
BORDER = b"\xff"  # between words; no byte of UTF-8


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    """Tables of one tokenizer file and a worker's memory of words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and pre["type"] == "ByteLevel" and not pre["add_prefix_space"]
        if not plain or spec["normalizer"] or spec["post_processor"] or model["ignore_merges"]:
            raise ValueError(f"{path}: only plain byte-level BPE files are supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: only added tokens that match literally are supported")
        self.path = path
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        letters, vocab = _byte_letters(), model["vocab"]
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in (vocab | self.special).items():
            self.bytes_of[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.left, self.right = np.full(self.size, -1, np.int64), np.full(self.size, -1, np.int64)
        self.rank = np.full(self.size, -1, np.int64)
        self.left[made], self.right[made], self.rank[made] = left, right, np.arange(len(made))
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.key_rank = keys[order], order.astype(np.int64)
        self.made, self.sides = made.tolist(), (left, right)
        self.byte_id = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        # The test below needs merges to come after those that made their parts, and one merge per token.
        ordered = bool((np.maximum(self.rank[left], self.rank[right]) < np.arange(len(made))).all()) and len(set(made.tolist())) == len(made)
        whole = np.zeros(self.size, bool)
        whole[self.byte_id] = True
        if ordered:
            whole[made] = self.compatible(left, right, np.arange(len(made)))
        # Entries that are their own encoding; only these are worth guessing.
        self.own = np.flatnonzero(whole)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.merged_words = 0
        self.starts = {" ", *map(chr, range(ord("A"), ord("Z") + 1)), *map(chr, range(ord("a"), ord("z") + 1))}

    # Needed by those who encode only.
    @cached_property
    def guess(self) -> dict[bytes, int]:
        return {self.bytes_of[i]: i for i in self.own.tolist()}

    @cached_property
    def matcher(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for token, i in self.guess.items():
            if token and BORDER not in token:
                out.add_word(token.decode("latin-1"), i)
        out.make_automaton()
        return out

    @cached_property
    def merge_of(self) -> dict[tuple[int, int], int]:
        return {pair: rank for rank, pair in enumerate(zip(*(side.tolist() for side in self.sides)))}

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[at] == k, self.key_rank[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair of neighbours: does no merge across the border come first?

        Takes the merges of both sides back, latest first. At each moment the pieces at the
        border may merge only if that merge ranks before the step in which either is used up;
        of equal ranks the leftmost place is first. ``limit``: rank at which the pair itself merges.
        """
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        until_a = np.full(len(a), NEVER) if limit is None else limit.copy()
        until_b = until_a.copy() if limit is None else limit - 1
        while live.size:
            x, y = a[live], b[live]
            rank = self._merge_rank(x, y)
            early = (rank < until_a[live]) & (rank <= until_b[live])
            good[live[early]] = False
            more = ~early & ((self.rank[x] >= 0) | (self.rank[y] >= 0))
            live, x, y = live[more], x[more], y[more]
            first = self.rank[x] > self.rank[y]
            i, j = live[first], live[~first]
            until_a[i], a[i] = self.rank[x[first]], self.right[x[first]]
            until_b[j], b[j] = self.rank[y[~first]], self.left[y[~first]]
        return good

    def _propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words, and the word that each is of."""
        joined = BORDER.join(words)
        found = np.fromiter(chain.from_iterable(self.matcher.iter_long(joined.decode("latin-1"))), np.int64).reshape(-1, 2)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        return found[:, 1], np.searchsorted(ends, found[:, 0], side="right")

    def _merge_all(self, words: list[bytes]) -> list[tuple[list[int], np.ndarray]]:
        """Exact merging of many words at once, lowest rank first, leftmost among equals.

        Gives groups of words (their places in ``words``) with a row of ids each, filled up with -1.
        A round does one merge in every word that has one left; words of like length share a group.
        """
        self.merged_words += len(words)
        out, made, byte_id = [], np.array(self.made, np.int64), np.array(self.byte_id, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for least, most in zip((0, *WIDTHS), WIDTHS):
            at = np.flatnonzero((lengths > least) & (lengths <= most))
            if not len(at):
                continue
            ids = np.full((len(at), most), -1, np.int64)
            column = np.arange(most)
            ids[column < lengths[at][:, None]] = byte_id[np.frombuffer(b"".join([words[i] for i in at.tolist()]), np.uint8)]
            done, live = ids.copy(), np.arange(len(at))
            rank = np.where(ids[:, 1:] >= 0, self._merge_rank(ids[:, :-1], ids[:, 1:]), NEVER)
            while True:
                place = rank.argmin(axis=1)
                low = rank[np.arange(len(live)), place]
                go = low < NEVER
                done[live[~go]] = ids[~go]
                if not go.any():
                    break
                live, ids, rank, place, low = live[go], ids[go], rank[go], place[go], low[go]
                row = np.arange(len(live))
                ids[row, place] = made[low]
                after = column > place[:, None]
                ids = np.take_along_axis(ids, np.minimum(column + after, most - 1), axis=1)
                ids[:, -1] = -1
                rank = np.take_along_axis(rank, np.minimum(column[:-1] + after[:, :-1], most - 2), axis=1)
                rank[:, -1] = NEVER
                for side in (place - 1, place):
                    here = np.flatnonzero((side >= 0) & (side < most - 1))
                    x, y = ids[here, side[here]], ids[here, side[here] + 1]
                    rank[here, side[here]] = np.where(y >= 0, self._merge_rank(x, y), NEVER)
            out.append((at.tolist(), done))
        for i in np.flatnonzero(lengths > WIDTHS[-1]).tolist():
            out.append(([i], np.array([self._merge_long([self.byte_id[b] for b in words[i]])], np.int64)))
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same over a heap and a linked list, so that long runs stay near linear."""
        rank_of, made, n = self.merge_of, self.made, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank_of[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank_of]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank_of.get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j], after[i] = made[rank], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := rank_of.get((ids[k], ids[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k))
        return [t for t in ids if t >= 0]

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and how many each has. All guesses are verified together, failing words are merged."""
        flat, owner = self._propose(words)
        counts = np.bincount(owner, minlength=len(words))
        at = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, where = np.unique(flat[at] * self.size + flat[at + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failed = np.unique(owner[at[~good[where]]])
        if not len(failed):
            return flat, counts
        merged = self._merge_all([words[i] for i in failed.tolist()])
        stays = np.ones(len(words), bool)
        stays[failed] = False
        for places, ids in merged:
            counts[failed[places]] = (ids >= 0).sum(axis=1)
        begins = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int64)
        out[np.repeat(stays, counts)] = flat[stays[owner]]
        for places, ids in merged:
            filled = ids >= 0
            out[(begins[failed[places]][:, None] + np.arange(ids.shape[1]))[filled]] = ids[filled]
        return out, counts

    def _learn(self, chunks: list[str]) -> None:
        """Put the ids of new chunks of text into the memory, and those of their words."""
        known, words = self.young, [self._split(c) for c in chunks]
        new = [w for w in dict.fromkeys(chain.from_iterable(words)) if w not in known]
        if new:
            ids, counts = self._words([w.encode() for w in new])
            packed, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
            for w, a, b in zip(new, [0, *ends], ends):
                known[w] = packed[a:b]
        for c, ws in zip(chunks, words):
            if len(ws) > 1:
                known[c] = b"".join(map(known.__getitem__, ws))

    def _parts(self, text: str) -> list[list[str] | int]:
        """Chunks whose ids do not depend on their neighbours, and ids of special strings."""
        out: list[list[str] | int] = []
        pieces = self.special_split.split(text) if self.special_split and any(s in text for s in self.special) else [text]
        for k, piece in enumerate(pieces):
            if k % 2:
                out.append(self.special[piece])
            elif not piece:
                continue
            elif SETTLED.search(piece):
                out.append([piece[a:b] for _, (a, b) in self._library().pre_tokenize_str(piece)])
            elif UNEVEN.search(piece):
                out.append(SPLIT.findall(piece))
            else:
                head, *rest = piece.split(" ")
                out.append([head, *[" " + c for c in rest]])
        return out

    @lru_cache(maxsize=1)  # noqa: B019  one object a worker
    def _library(self):
        from tokenizers import pre_tokenizers

        return pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def _split(self, chunk: str) -> list[str]:
        if chunk[1:].isalpha() and chunk[0] in self.starts or SETTLED.search(chunk):
            return [chunk]  # a plain word, or one of the library's splitting
        return SPLIT.findall(chunk)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            end, chars = start, 0
            while end < len(texts) and (end == start or chars + len(texts[end]) <= BLOCK_CHARS):
                chars += len(texts[end])
                end += 1
            parts = [self._parts(t) for t in texts[start:end]]
            if len(self.young) > REMEMBERED:
                self.old, self.young = self.young, {}
            new = set(chain.from_iterable(p for ps in parts for p in ps if not isinstance(p, int))) - self.young.keys()
            for c in [c for c in new if c in self.old]:
                self.young[c] = self.old[c]
                new.discard(c)
            self._learn(list(new))
            ids = self.young.__getitem__
            out += [b"".join(b"".join(map(ids, p)) if not isinstance(p, int) else p.to_bytes(4, "little") for p in ps) for ps in parts]
            start = end
        return out

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become replacement characters."""
        a = array("I", ids)
        size = self.size
        known = a if not a or max(a) < size else [i for i in a if i < size]
        return b"".join(map(self.bytes_of.__getitem__, known)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> BytePairs:
    """One per Python worker and file."""
    return BytePairs(path)


def blocks(values: pa.Array, rows: int = 512) -> Iterator[list]:
    """The values of an Arrow batch, a bounded number of rows at a time."""
    for i in range(0, len(values), rows):
        yield values.slice(i, rows).to_pylist()


def encode_column(text: Column, path: str) -> Column:
    """Packed ids of ``text``; special strings inside it become their ids, as is the library's default."""

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = load(path)
        for values in batches:
            yield pa.array(chain.from_iterable(pairs.encode(b) for b in blocks(values)), pa.binary())

    return encode(text_of(text))


def decode_column(ids: Column, path: str) -> Column:
    """The text of packed ids, special tokens included. Null ids give an empty text."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = load(path)
        for values in batches:
            yield pa.array((pairs.decode(v) for b in blocks(values) for v in b), pa.string())

    return decode(F.coalesce(ids, F.lit(b"")))


def ids_array(ids: Column) -> Column:
    """Packed ids as ``array<long>``."""

    @F.arrow_udf("array<long>")
    def unpack(values: pa.Array) -> pa.Array:
        return pa.array([array("I", v).tolist() if v is not None else None for v in values.to_pylist()], pa.list_(pa.int64()))

    return unpack(ids)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with packed ids of ``text`` in ``ids``."""
    return df.withColumn(ids, encode_column(F.col(text), path))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the decoded text of ``ids`` in ``text``."""
    return df.withColumn(text, decode_column(F.col(ids), path))


def token_count(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
