"""Byte-pair encoding with a rank queue: the merges themselves, byte-level encoding and decoding.

The queue has one bucket for each merge rank. A bucket holds places of a doubly linked list of
symbols; a bitmap in levels says which buckets have any, so that the next rank is found by
find-first-set. An entry whose pair has changed since it was put there is stale and is skipped.
A pre-token of n bytes takes O(n log n) steps, however long it is.
"""

from __future__ import annotations

import base64
import json
from array import array
from collections.abc import Callable
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import documents, held, map_chunks

#: Bits of a word of the lower bitmap level.
WORD = 8
#: Pre-tokens in each of the two generations that a worker remembers; a bound on memory, not on what is encoded.
REMEMBERED = 700_000


class Remembering(dict):
    """``make(key)`` of the keys that came lately. A full generation becomes the old one, from which keys in use come back."""

    def __init__(self, most: int = REMEMBERED):
        super().__init__()
        self.old: dict = {}
        self.most = most

    def make(self, key: str):
        raise NotImplementedError

    def __missing__(self, key: str):
        out = self.old.pop(key, None)
        if out is None:
            out = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = out
        return out


class Merges:
    """Merge rules: ``pair(a, b)`` is the rank of joining two symbols or -1, ``joined[rank]`` the symbol that results."""

    def __init__(self, byte_ids: list[int], pair: Callable[[int, int], int], joined, size: int):
        self.byte_ids, self._pair, self.joined = byte_ids, pair, joined
        self.ranks: dict[int, int] = {}
        self.low = [0] * ((size >> WORD) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges, lowest rank first, the leftmost of equal ranks first."""
        n = len(symbols)
        if n < 2:
            return symbols
        known, pair, joined = self.ranks, self._pair, self.joined
        low, top, buckets = self.low, 0, self.buckets
        mask = (1 << WORD) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        a = symbols[0]
        for i, b in enumerate(symbols[1:]):
            key = a << 20 | b
            r = known.get(key)
            if r is None:
                r = known[key] = pair(a, b)
            if r >= 0:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    low[r >> WORD] |= 1 << (r & mask)
                    top |= 1 << (r >> WORD)
            a = b
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            r = word << WORD | ((bits & -bits).bit_length() - 1)
            bucket = buckets[r]
            i = heappop(bucket)
            if not bucket:
                del buckets[r]
                bits &= bits - 1
                low[word] = bits
                if not bits:
                    top &= top - 1
            a = symbols[i]
            j = after[i]
            if a < 0 or j >= n or known[a << 20 | symbols[j]] != r:
                continue  # stale
            a = symbols[i] = joined[r]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                b = symbols[k]
                q = known.get(a << 20 | b)
                if q is None:
                    q = known[a << 20 | b] = pair(a, b)
                if q >= 0:
                    if q in buckets:
                        heappush(buckets[q], i)
                    else:
                        buckets[q] = [i]
                        low[q >> WORD] |= 1 << (q & mask)
                        top |= 1 << (q >> WORD)
            h = before[i]
            if h >= 0:
                b = symbols[h]
                q = known.get(b << 20 | a)
                if q is None:
                    q = known[b << 20 | a] = pair(b, a)
                if q >= 0:
                    if q in buckets:
                        heappush(buckets[q], h)
                    else:
                        buckets[q] = [h]
                        low[q >> WORD] |= 1 << (q & mask)
                        top |= 1 << (q >> WORD)
        if len(known) > 4_000_000:
            known.clear()
        return [s for s in symbols if s >= 0]

    def encode(self, piece: bytes) -> list[int]:
        ids = self.byte_ids
        return self.merge([ids[b] for b in piece])


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where printable, else the next of 256, 257 ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in out)
    return out | {b: chr(256 + n) for n, b in enumerate(rest)}


def rank_merges(ranks: dict[bytes, int]) -> Merges:
    """Merges of a rank file: a pair joins if its bytes together have a rank, which is also the new symbol."""
    by_id = {v: k for k, v in ranks.items()}
    return Merges([ranks[bytes([b])] for b in range(256)], lambda a, b: ranks.get(by_id[a] + by_id[b], -1), range(max(by_id) + 1), max(by_id) + 1)


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=4)
def read_vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


class Encoder(Remembering):
    """Pre-token -> its ids, packed as 32-bit numbers; filled as pre-tokens come."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.ranks = read_ranks(path)
        self.merges = rank_merges(self.ranks)
        self.find = regex.compile(pattern).findall
        self.bytes_of, self.decimal = [b""] * (max(self.ranks.values()) + 1), list(map(str, range(max(self.ranks.values()) + 1)))
        for raw, number in self.ranks.items():
            self.bytes_of[number] = raw

    def make(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)
        return array("I", [whole] if whole is not None else self.merges.encode(raw)).tobytes()

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, self.find(text))), np.uint32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def encoder(path: str, pattern: str) -> Encoder:
    """One for each worker process, kept from task to task."""
    return held(f"encoder {path} {pattern}", lambda: Encoder(path, pattern))


def encode_documents(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", project: Callable | None = None, ddl: str = "n_tokens long, ids array<int>") -> DataFrame:
    """Token ids of every whole text by the rank file at ``path``; each match of ``pattern`` is merged alone.

    ``project(encoder, ids)`` may reduce a document's ids to the columns of ``ddl`` in the same pass,
    so that the ids need not be shipped. A null or empty text has no tokens. Text that ``pattern``
    does not match has no ids, as in the library. Repeated rows are answered once each.
    """
    project = project or (lambda enc, ids: (len(ids), ids))

    def make():
        enc = encoder(path, pattern)

        def one(batch):
            rows = [project(enc, enc.encode(t)) for t in batch.column(1).to_pylist()]
            return [batch.column(0), *map(list, zip(*rows))]

        return one

    return map_chunks(documents(df, id_col, text_col), make, f"doc_id long, {ddl}")


def decode_documents(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes that each array of ids stands for; a null array gives no bytes, an empty table no rows, an unknown id fails the job."""

    def make():
        bytes_of = {v: k for k, v in read_ranks(path).items()}
        return lambda batch: [batch.column(0), [b"".join(map(bytes_of.__getitem__, ids or ())) for ids in batch.column(1).to_pylist()]]

    return map_chunks(df.select(df[id_col].cast("long").alias("doc_id"), df[ids_col].cast("array<int>").alias("ids")), make, "doc_id long, bytes binary")
