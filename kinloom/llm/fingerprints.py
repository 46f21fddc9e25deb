"""Document fingerprints: the k least of the hashes of a text's word shingles (a bottom-k sketch)."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType

from .common import documents, held, map_batches, map_chunks, schema_of

#: Words that a worker remembers the hash of; a bound on memory alone.
REMEMBERED = 500_000
SPAN = float(2**64)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


def word_hashes() -> WordHashes:
    return held("word hashes", WordHashes)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str, width: int = 5) -> np.ndarray:
    """Hashes of all runs of ``width`` lower-case words; of all words if there are fewer; none of an empty text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, n)
    width = min(width, n)
    out = h[: n - width + 1].copy()
    for i in range(1, width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : n - width + 1 + i]
    return mixed(out)


def sketch(text: str, k: int = 256, width: int = 5) -> np.ndarray:
    """The ``k`` least distinct hashes, ascending; all of them if there are fewer."""
    h = shingle_hashes(text, width)
    if len(h) > 8 * k:
        distinct = np.unique(np.partition(h, 4 * k)[: 4 * k])
        if len(distinct) >= k:
            return distinct[:k]
    return np.unique(h)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = 256) -> np.ndarray:
    """The sketch of both parts together (shingles that run over the border aside)."""
    return np.union1d(a, b)[:k]


def _common(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int, int]:
    """Of the hashes up to which both sketches are complete: how many a has, b has, both have."""
    if len(a) >= k or len(b) >= k:
        top = min([x[-1] for x in (a, b) if len(x) >= k])
        a, b = a[: np.searchsorted(a, top, "right")], b[: np.searchsorted(b, top, "right")]
    if not len(a) or not len(b):
        return len(a), len(b), 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return len(a), len(b), int((b[at] == a).sum())


def resemblance(a: np.ndarray, b: np.ndarray, k: int = 256) -> float:
    """Estimate of shared shingles over all shingles; 1 for two empty sketches."""
    na, nb, both = _common(a, b, k)
    return both / (na + nb - both) if na + nb else float(len(a) == len(b))


def containment(a: np.ndarray, b: np.ndarray, k: int = 256) -> float:
    """Estimate of the share of a's shingles that b has; 1 for an empty a."""
    na, _, both = _common(a, b, k)
    return both / na if na else float(not len(a))


def distinct_shingles(a: np.ndarray, k: int = 256) -> float:
    """Exact below ``k``, else an estimate from the greatest hash kept."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / SPAN)


def fingerprint_documents(df: DataFrame, k: int = 256, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, sketch (packed little-endian 64-bit numbers), shingles (estimate of distinct ones).

    A null or empty text has an empty sketch. Equal texts have equal sketches; repeated rows are answered once each.
    """

    def make():
        def one(batch):
            all_ = [sketch(t, k, width) for t in batch.column(1).to_pylist()]
            return [batch.column(0), [s.tobytes() for s in all_], [distinct_shingles(s, k) for s in all_]]

        return one

    return map_chunks(documents(df, id_col, text_col), make, "doc_id long, sketch binary, shingles double")


def merge_sketches(df: DataFrame, key_cols: list[str], k: int = 256, sketch_col: str = "sketch") -> DataFrame:
    """One sketch for each key; none of an empty table. Hashes are told apart and ranked by Spark, so a hot key's rows shrink before they are gathered."""
    hashes = df.select(*key_cols, F.explode(_unpack(F.col(sketch_col))).alias("h")).groupBy(*key_cols, "h").agg(F.lit(1).alias("one"))
    salted = hashes.groupBy(*key_cols, F.pmod(F.xxhash64("h"), F.lit(64)).alias("salt")).agg(F.slice(F.sort_array(F.collect_list("h")), 1, k).alias("hs"))
    return salted.groupBy(*key_cols).agg(_pack(F.slice(F.sort_array(F.flatten(F.collect_list("hs"))), 1, k)).alias(sketch_col))


#: Spark's long is signed: flipping the top bit keeps the order of unsigned hashes.
_TOP = np.uint64(1 << 63)


@pandas_udf(ArrayType(LongType()))
def _unpack(s: pd.Series) -> pd.Series:
    return s.map(lambda b: (np.frombuffer(b or b"", "<u8") ^ _TOP).astype(np.int64))


@pandas_udf(BinaryType())
def _pack(s: pd.Series) -> pd.Series:
    return s.map(lambda x: (np.array(x, np.int64).astype(np.uint64) ^ _TOP).astype("<u8").tobytes())


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows, none without an id, dealt by range of id and sorted, each range followed by the next one's first row (``tail``), the last by the first of all.

    Ranges come from quantiles of the ids alone. What the driver gathers is one id for each range. Text is shuffled once.
    """
    spark = docs.sparkSession
    keyed = docs.withColumn("key", F.col("doc_id"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = keyed.select(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], F.lit(10_000)).alias("c")).first().c or []
    bounds = np.unique(np.array(cuts, np.int64))
    low = np.concatenate([np.array([-(2**63)], np.int64), bounds])

    @pandas_udf(IntegerType())
    def part_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(low, keys.to_numpy(), "right") - 1, 0).astype(np.int32))

    first = sorted((r.part, r.key) for r in keyed.select("key", part_of("key").alias("part")).groupBy("part").agg(F.min("key").alias("key")).collect())
    dense = {p: i for i, (p, _) in enumerate(first)}
    tail_of = {key: (i - 1) % len(first) for i, (_, key) in enumerate(first)}

    @pandas_udf(ArrayType(IntegerType()))
    def places(keys: pd.Series) -> pd.Series:
        home = np.maximum(np.searchsorted(low, keys.to_numpy(), "right") - 1, 0)
        return pd.Series([[2 * dense[p], 2 * tail_of[k] + 1] if k in tail_of else [2 * dense[p]] for p, k in zip(home.tolist(), keys.tolist())], dtype=object)

    dealt = keyed.withColumn("place", F.explode(places("key"))).withColumn("part", F.expr("place div 2").cast("int")).withColumn("tail", F.col("place") % 2)
    return dealt.repartitionById(max(1, len(first)), "part").sortWithinPartitions("tail", "key", "text").select("tail", "doc_id", "text")


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
    "shingles double, contained_in_edited double, contained_in_next double"
)


def edited_row(doc, old: str, was: np.ndarray, text: str, own: np.ndarray, k: int, width: int) -> tuple:
    """What is said of a text and its sketch, and the next text and its sketch."""
    show = lambda s: base64.b64encode(s.tobytes()).decode()
    cut = len(old) // 4
    edited = old[: len(old) - cut] + text[:cut]
    new = sketch(edited, k, width)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    near = resemblance(was, new, k), resemblance(was, own, k), distinct_shingles(was, k), containment(was, new, k), containment(was, own, k)
    return doc, len(old), digest, show(was), show(new), *near


def fingerprint_edited(df: DataFrame, k: int = 256, width: int = 5, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Each text's fingerprint beside that of its edited form: the last quarter gives way to the next document's beginning.

    ``contained_in_...`` is the share of the text's shingles that the edited text or the next one has. Next is by
    ascending (doc_id, text); after the last comes the first. Of repeated ids each row is answered, in the order
    of texts. A null or empty text is edited to the empty text. A row without an id has no place in the order: the
    first document counts as its next (the empty text if there is none), and it is nobody's next.
    """
    spark = df.sparkSession
    schema = schema_of(spark, EDITED)
    docs = documents(df, id_col, text_col)
    placed, lost = docs.where("doc_id is not null"), docs.where("doc_id is null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, last, ended, rows = to_arrow_schema(schema), None, False, []
        for batch in batches:
            for tail, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                if ended:
                    continue
                own = sketch(text, k, width)
                if last is not None:
                    rows.append(edited_row(*last, text, own, k, width))
                last, ended = (doc, text, own), bool(tail)
                if len(rows) >= 256:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], arrow)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], arrow)

    out = map_batches(with_next(placed, parts), run, schema)
    if lost.isEmpty():
        return out
    first = placed.orderBy("doc_id", "text").select("text").first()
    text = first.text if first else ""

    def make():
        own = sketch(text, k, width)
        rows = lambda batch: [edited_row(None, t, sketch(t, k, width), text, own, k, width) for t in batch.column(1).to_pylist()]
        return lambda batch: [list(c) for c in zip(*rows(batch))]

    return out.unionByName(map_chunks(lost, make, EDITED))
