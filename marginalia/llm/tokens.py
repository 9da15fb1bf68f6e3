"""Ids of whole texts by the published tokenizer libraries, for operators that only need ids or counts."""

from __future__ import annotations

import hashlib
from array import array
from functools import cached_property, lru_cache

from .bpe import SETTLED, SPLIT, BytePairs


class JsonTokenizer:
    """A ``tokenizers`` file. Plain byte-level files whose ids follow their merges run on the rank
    library, which gives the same ids faster; any other file or alphabet runs on the library itself."""

    def __init__(self, path: str):
        self.path = path
        self.ranked, self.special = self._ranked(path)

    @cached_property
    def whole(self):
        """The library itself, loaded by the first text that needs it."""
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.no_truncation()
        out.no_padding()
        return out

    @staticmethod
    def _ranked(path: str):
        import tiktoken

        try:
            pairs = BytePairs(path)
        except (ValueError, KeyError, TypeError):
            return None, {}
        ranks = {pairs.bytes_of[i]: i for i in range(pairs.size) if i not in pairs.special.values()}
        if pairs.made != sorted(pairs.made) or max(pairs.byte_id) >= min(pairs.made) or len(pairs.guess) != len(ranks):
            return None, {}
        # The specials are not given to the rank library: texts with any go to the whole library.
        return tiktoken.Encoding("ranks", pat_str=SPLIT.pattern, mergeable_ranks=ranks, special_tokens={}), pairs.special

    def ids(self, text: str) -> list[int]:
        if self.ranked is None or SETTLED.search(text) or any(s in text for s in self.special):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)


class PieceTokenizer:
    """A ``sentencepiece`` model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> JsonTokenizer | PieceTokenizer:
    """One per Python worker and file."""
    return PieceTokenizer(path) if path.endswith(".model") else JsonTokenizer(path)


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit."""
    return array("I", ids).tobytes()


@lru_cache(maxsize=8)
def version(path: str) -> str:
    """Digest of the tokenizer's file: another file, another version."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()
