"""Packing: concatenate all documents' ids and cut the stream into windows of fixed length.

Two passes. The first tokenises each document once and writes its ids with the number of tokens
before it in its own part. The totals of the parts, one row each, give every part's place in the
stream by a prefix sum. The second pass then cuts each document alone: no order, no shuffle.
"""

from __future__ import annotations

import re
import zlib
from array import array
from itertools import accumulate

import numpy as np
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Remembering, byte_letters, read_vocabulary
from .common import documents, held, map_chunks, written

#: Fixed value: how word vocabularies with word ends split lower-cased text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
#: Words, and pre-tokens inside words, in each generation that a worker remembers; a bound on memory alone.
WORDS, PIECES = 500_000, 250_000
#: Characters on which this module leaves normalising and splitting to the library.
UNUSUAL = re.compile("[^\t\n\r -~¡-įı-ɏ]")


#: Signs that end a word and are a pre-token of their own.
SIGNS = frozenset(".,;:!?")


class Pieces(Remembering):
    """Pre-token -> packed ids, merged by the library's model."""

    def __init__(self, model, kind: str):
        super().__init__(PIECES)
        self.tokenize, self.kind = model.tokenize, kind
        self.letters = {b: c for b, c in byte_letters().items() if chr(b) != c}

    def make(self, piece: str) -> bytes:
        raw = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array(self.kind, [t.id for t in self.tokenize(raw)]).tobytes()


class WordEncoder(Remembering):
    """Lower-case word, as white space bounds it -> packed ids; filled as words come."""

    def __init__(self, path: str):
        super().__init__(WORDS)
        from tokenizers import Tokenizer

        spec = read_vocabulary(path)
        self.library = Tokenizer.from_file(path)
        self.marks = [t["content"] for t in spec["added_tokens"]]
        size = 1 + max(*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]))
        self.kind = np.dtype("u2" if size <= 1 << 16 else "u4")
        self.find, self.pieces = regex.compile(SPLIT).findall, Pieces(self.library.model, self.kind.char)

    def make(self, word: str) -> bytes:
        if word.isalpha():  # letters alone are one pre-token
            return self.pieces.make(word)
        if word[-1] in SIGNS and word[:-1].isalpha():
            return self[word[:-1]] + self.pieces[word[-1]]
        return b"".join(map(self.pieces.__getitem__, self.find(word)))

    def encode(self, text: str) -> bytes:
        if (text.isascii() and text.isprintable() or not UNUSUAL.search(text)) and not any(m in text for m in self.marks):
            return b"".join(map(self.__getitem__, text.lower().split()))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()


def word_encoder(path: str) -> WordEncoder:
    """One for each worker process, kept from task to task."""
    return held(f"word encoder {path}", lambda: WordEncoder(path))


def encode_parts(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, part, before, n, ids: each document's ids with ``end_id`` after them, packed, and the tokens before it in its part."""

    def make():
        enc, part, done = word_encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], enc.kind).tobytes()

        def one(batch):
            nonlocal done
            ids = [enc.encode(t) + end for t in batch.column(1).to_pylist()]
            n = [len(x) // enc.kind.itemsize for x in ids]
            before = list(accumulate(n, initial=done))
            done = before.pop()
            return [batch.column(0), [part] * len(n), before, n, ids]

        return one

    return map_chunks(documents(df, id_col, text_col), make, "doc_id long, part int, before long, n long, ids binary")


def cut(encoded: DataFrame, window: int) -> DataFrame:
    """One row for each piece of a document that lies in one window."""
    totals = sorted((r.part, r.n) for r in encoded.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("n")).collect())
    base = dict(zip((p for p, _ in totals), accumulate((n for _, n in totals), initial=0)))

    def make():
        def one(batch):
            rows = []
            for doc, part, before, n, packed in zip(*(c.to_pylist() for c in batch.columns)):
                kind = "u2" if len(packed) == 2 * n else "u4"  # as the first pass packed them
                ids, place, start = np.frombuffer(packed, kind).astype("<u4"), base[part] + before, 0
                while start < n:
                    sequence, offset = divmod(place + start, window)
                    length = min(n - start, window - offset)
                    rows.append((doc, start, length, zlib.crc32(ids[start : start + length].tobytes()), n, sequence, offset))
                    start += length
            return [list(c) for c in zip(*rows)] if rows else [[]] * 7

        return one

    return map_chunks(encoded, make, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack_documents(df: DataFrame, path: str, end_id: int = 1, window: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in windows of ``window`` tokens; every window but the last is full.

    A null or empty text is its end id alone. Repeated rows are packed once each. An empty table
    gives no pieces. The order of documents is that of the written parts, fixed once they are written.
    """
    return cut(written(encode_parts(df, path, end_id, id_col, text_col), "packing-ids"), window)
