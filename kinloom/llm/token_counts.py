"""Token counts without encoding: pre-tokens that are provably one token are counted, only the rest is merged."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .bpe import Remembering, byte_letters, read_vocabulary
from .common import documents, held, map_chunks

#: Fixed value: how byte-level vocabularies split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Up to here the character classes of all Unicode versions in use agree; texts beyond are split by the library itself.
AGREED = "ɏ"


@lru_cache(maxsize=2)
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings that encode alone as one token, proved by merging each of them from its bytes."""
    model, back = library(path).model, _back()
    proved = set()
    for token, number in read_vocabulary(path)["model"]["vocab"].items():
        if all(c in back for c in token) and [t.id for t in model.tokenize(token)] == [number]:
            try:
                proved.add(bytes(map(back.__getitem__, token)).decode("utf-8"))
            except UnicodeDecodeError:
                pass  # part of a character: never a pre-token of its own
    return frozenset(proved)


class Counter(Remembering):
    """Pre-token -> number of tokens: one for the proved ones; others are merged when they come."""

    def __init__(self, path: str, whole: frozenset[str] | None = None):
        super().__init__()
        self.library, self.whole = library(path), whole_tokens(path) if whole is None else whole
        self.find = regex.compile(SPLIT).findall
        self.letters = {b: c for b, c in byte_letters().items() if chr(b) != c}
        self.marks = [t["content"] for t in read_vocabulary(path)["added_tokens"] if t["special"]]
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.marks, key=len, reverse=True)))) if self.marks else None

    def make(self, piece: str) -> int:
        if piece in self.whole:
            return 1
        return len(self.library.model.tokenize(piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)))

    def split(self, text: str) -> list[str]:
        if text.isascii() or max(text) <= AGREED:
            return self.find(text)
        back = _back()
        return [bytes(map(back.__getitem__, piece)).decode("utf-8") for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.specials is None or not any(m in text for m in self.marks):
            return sum(map(self.__getitem__, self.split(text)))
        parts = self.specials.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.split(p))) for p in parts if p)


@lru_cache(maxsize=1)
def _back() -> dict[str, int]:
    return {c: b for b, c in byte_letters().items()}


def counter(path: str, whole: Callable[[], frozenset[str]] | None = None) -> Counter:
    """One for each worker process, kept from task to task; ``whole`` gives what is proved already."""
    return held(f"counter {path}", lambda: Counter(path, whole() if whole else None))


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every whole text, as the library counts with its defaults.

    A special string inside a text is one token. A null or empty text has no bytes and no tokens.
    Repeated rows are answered once each. The proof of whole tokens is made once, by the driver, and sent to the
    workers: it has at most as many strings as the vocabulary.
    """
    proved = df.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def make():
        count = counter(path, lambda: proved.value).count

        def one(batch):
            texts = batch.column(1).to_pylist()
            n = [count(t) for t in texts]
            return [batch.column(0), [len(t.encode()) for t in texts], n, [x > limit for x in n]]

        return one

    return map_chunks(documents(df, id_col, text_col), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
