"""Quality: interpolated modified Kneser-Ney models of trusted text, and thresholds on perplexity by language.

A symbol is a code point in 16 bits (digits are one symbol, code points beyond 16 bits share 4096), so an
n-gram of order 4 is one 64-bit number. A blank between a word and the same word again is a symbol of its own.
Three models are made side by side: of all trusted text, and of each half of it; a trusted document is held
against its language by the model of the half that it isn't in.

No model leaves its shards. Documents lie in blocks of neighbouring rows; each block sends its distinct
n-grams once, these meet the sharded counts in joins, and their probabilities go to the block that asked,
where its documents' perplexities are added up. Texts are shuffled once, to meet them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import spread
from .common import FILE_ROWS, documents, map_batches, map_chunks, pick, schema_of, written
from .toxicity import labelled_sample

ORDER, BITS = 4, 16
SYMBOLS = 1 << BITS
EDGE, REPEAT, CONTROL, DIGIT = 0, 1, 2, ord("0")
#: The model of all trusted text, that of its odd half and that of its even half.
MODELS = (0, 1, 2)
#: Neighbouring rows of a file whose n-grams are asked for together.
BLOCK_ROWS = 16384
#: Distinct n-grams that a task holds back before it sends them; only how often one is sent twice depends on it.
HELD_GRAMS = 1_000_000


_BASE = np.uint64(0x9E3779B97F4A7C15)


def powers(x: np.uint64, n: int) -> np.ndarray:
    """x to the power of 0 to n - 1, modulo 2**64."""
    out = np.full(max(1, n), x, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: Code points of a text up to which the powers are kept; longer texts have their own made.
KEPT_POWERS = 1 << 18


@lru_cache(maxsize=1)
def kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return made_powers(KEPT_POWERS)


def made_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(_BASE, n), powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), n)


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of code points, the same for the same ones wherever they stand."""
    up, down = kept_powers() if len(raw) < KEPT_POWERS else made_powers(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], dtype=np.uint64)])
    return (total[end] - total[start]) * down[start]


def symbols(text: str) -> np.ndarray:
    """A symbol for each code point; a blank between a word and the same word again is REPEAT."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(raw < SYMBOLS, raw, 0xE000 + raw % 4096).astype(np.int64)
    out[raw <= REPEAT] = CONTROL
    out[(raw >= DIGIT) & (raw < DIGIT + 10)] = DIGIT
    blanks = np.flatnonzero((raw == 32) | (raw == 10))
    if len(blanks):
        start, end = np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(raw)]])
        size, h = end - start, word_hashes(raw, start, end)
        same = (size[1:] == size[:-1]) & (size[1:] > 0) & (h[1:] == h[:-1])
        out[blanks[same]] = REPEAT
    return out


def grams(text: str) -> np.ndarray:
    """The n-gram that ends at each symbol and at the end mark."""
    s = np.concatenate([np.zeros(ORDER - 1, np.int64), symbols(text), np.zeros(1, np.int64)])
    return s[:-3] << 48 | s[1:-2] << 32 | s[2:-1] << 16 | s[3:]


def suffix(gram: Column, order: int) -> Column:
    return gram if order == ORDER else gram.bitwiseAND((1 << (BITS * order)) - 1)


def context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, BITS)


def half(doc_id: Column) -> Column:
    """0 or 1; null without an id."""
    return (F.crc32(doc_id.cast("string")) % 2).cast("int")


def count_grams(texts: DataFrame) -> DataFrame:
    """model, gram, n over the columns ``doc_id`` and ``text``: each task adds up its own first."""

    def make():
        def one(batch):
            halves, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            out = []
            for h in (0, 1):
                own = [grams(t) for t, x in zip(texts, halves) if x == h]
                found, n = np.unique(np.concatenate([*own, np.zeros(0, np.int64)]), return_counts=True)
                out.append((np.full(len(found), h), found, n))
            return [np.concatenate(c) for c in zip(*out)]

        return one

    counts = map_chunks(texts.select(half(F.col("doc_id")).alias("half"), "text"), make, "half int, gram long, n long", chunk=2_000)
    models = F.explode(F.array(F.lit(MODELS[0]), 2 - F.col("half"))).alias("model")  # documents of half 0 are left out of model 1, those of half 1 of model 2
    return counts.select(models, "gram", "n").groupBy("model", "gram").agg(F.sum("n").alias("n"))


def wide(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row a key, with a column for each model; null where the model hasn't seen it."""
    return df.groupBy(key).agg(*[F.max(F.when(F.col("model") == m, F.col(value))).alias(f"{value}{m}") for m in MODELS])


def kneser_ney(counts: DataFrame, files: int = 8) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: seen n-grams with their probability, and contexts with the share they leave to the lower order, a column for each model."""
    tables = [counts]
    for order in range(ORDER - 1, 0, -1):  # below the top an n-gram counts once for each symbol seen before it
        tables.append(tables[-1].groupBy("model", suffix(F.col("gram"), order).alias("gram")).agg(F.count(F.lit(1)).alias("n")))
    out, lower = [], None
    for order, table in enumerate(reversed(tables), 1):
        many = table.groupBy("model").agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)])
        y = F.col("n1") / F.greatest(F.lit(1), F.col("n1") + 2 * F.col("n2"))
        cut = lambda k: F.least(F.lit(float(k)), F.greatest(F.lit(0.1), k - (k + 1) * y * F.col(f"n{k + 1}") / F.greatest(F.lit(1), F.col(f"n{k}"))))
        cuts = many.select("model", *[cut(k).alias(f"cut{k}") for k in (1, 2, 3)])  # three rows
        discount = F.when(F.col("n") == 1, F.col("cut1")).when(F.col("n") == 2, F.col("cut2")).otherwise(F.col("cut3"))
        rows = table.join(F.broadcast(cuts), "model").select("model", "gram", "n", context(F.col("gram")).alias("context"), discount.alias("d"))
        contexts = rows.groupBy("model", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("left"))
        joined, share = rows.join(contexts, ["model", "context"]), F.col("left") / F.col("total")
        if lower is None:
            below = F.lit(1 / SYMBOLS)
        else:
            joined = joined.withColumn("suffix", suffix(F.col("gram"), order - 1)).join(lower.select("model", F.col("gram").alias("suffix"), F.col("p").alias("q")), ["model", "suffix"])
            below = F.col("q")
        lower = written(joined.select("model", "gram", ((F.col("n") - F.col("d")) / F.col("total") + share * below).alias("p")), f"ngram-{order}", files * FILE_ROWS)
        left = written(wide(contexts.select("model", "context", share.alias("left")), "context", "left"), f"contexts-{order}", files * FILE_ROWS)
        out.append((written(wide(lower, "gram", "p"), f"seen-{order}", files * FILE_ROWS), left))
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", size: int | None = None) -> list[tuple[DataFrame, DataFrame]] | None:
    """The models of all trusted documents (label over 0), or of at most ``size``, chosen by a hash of their id; None without any."""
    trusted = pick(labels, doc_id="doc_id", quality=label_col).where("quality > 0")
    learned = trusted.agg(F.count_distinct("doc_id")).first()[0]
    files = 8 * -(-min(learned, size or learned) // 20_000)
    counts = written(count_grams(labelled_sample(documents(docs, id_col, text_col), trusted, "quality", size, lambda i: F.lit(True))), "ngram-counts", files * FILE_ROWS)
    return None if counts.isEmpty() else kneser_ney(counts, files)


def log10_of(asked: DataFrame, orders: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """log10 probability under each model of every n-gram asked for (``gram``, distinct), by joins with the sharded tables.

    Single symbols and their contexts are at most ``SYMBOLS`` rows, so those tables are broadcast.
    """
    out = asked.select("gram", *[F.lit(1 / SYMBOLS).alias(f"q{m}") for m in MODELS])
    for order, (seen, contexts) in enumerate(orders, 1):
        own = suffix(F.col("gram"), order)
        out = out.withColumns({"own": own, "context": context(own)})
        seen, contexts = seen.withColumnRenamed("gram", "own"), F.broadcast(contexts) if order <= 2 else contexts
        out = out.join(F.broadcast(seen) if order == 1 else seen, "own", "left").join(contexts, "context", "left")
        q = [F.coalesce(f"p{m}", F.coalesce(f"left{m}", F.lit(1.0)) * F.col(f"q{m}")).alias(f"q{m}") for m in MODELS]
        out = out.select("gram", *q)
    return out.select("gram", *[F.log10(f"q{m}").cast("float").alias(f"q{m}") for m in MODELS])


def mere_scan(df: DataFrame) -> bool:
    """Whether each row is a row of a file: columns and rows may be chosen and dealt, but not joined or multiplied."""
    node = df._jdf.queryExecution().analyzed()
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter", "Repartition", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


def placed(df: DataFrame) -> tuple[DataFrame, Column, Column]:
    """A table, the block of each of its rows and the row's place in it; both follow from file and row, so they are the same in every scan. What isn't a mere scan of Parquet is written first."""

    def place(table):
        meta = table.metadataColumn("_metadata")
        block, at = F.xxhash64(meta["file_path"], F.floor(meta["row_index"] / BLOCK_ROWS)), F.pmod(meta["row_index"], F.lit(BLOCK_ROWS))
        table.select(block, at).schema  # noqa: B018 - other formats have no row numbers and fail here
        return table, block, at

    if mere_scan(df):
        try:
            return place(df)
        except PySparkException:
            pass
    return place(written(df, "quality-input"))


def asked_grams(rows: DataFrame) -> DataFrame:
    """block, gram: the distinct n-grams of each block of texts (block, text)."""
    schema = schema_of(rows.sparkSession, "block long, gram long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}

        def out():
            for block, own in found.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block, np.int64)), pa.array(own)], ["block", "gram"])
            found.clear()

        for batch in batches:
            blocks, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for block in np.unique(blocks).tolist():
                some = [grams(texts[i]) for i in np.flatnonzero(blocks == block)]
                found[block] = np.unique(np.concatenate([*some, found.get(block, np.zeros(0, np.int64))]))
            if sum(map(len, found.values())) > HELD_GRAMS:
                yield from out()
        yield from out()

    return map_batches(rows, run, schema).distinct()


def perplexity(text: str, known: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, int]:
    """log10 probability under each model and number of symbols, the end mark among them; ``known`` holds every n-gram of the text, in order."""
    g = np.sort(grams(text))
    at = np.searchsorted(known, g)
    if not len(known) or at[-1] >= len(known) or (known[at] != g).any():
        raise RuntimeError("an n-gram of a document was not asked for: the rows of its block have changed between two scans")
    return logs[at].sum(0, dtype=np.float64), len(g)


def score(df: DataFrame, orders: list[tuple[DataFrame, DataFrame]], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", place: tuple[Column, Column] | None = None) -> DataFrame:
    """doc_id, lang, block, at, symbols, log10_prob, cross, perplexity of every whole text; ``cross`` is the log10 probability under the model without the half of trusted text that the id is in.

    A null or empty text is its end mark alone; a null language counts as the empty one.
    """
    if place is None:
        df, *place = placed(df)
    block, at = place
    text, lang = F.coalesce(df[text_col].cast("string"), F.lit("")), F.coalesce(df[lang_col].cast("string"), F.lit(""))
    asked = written(asked_grams(spread(df.select(block.alias("block"), text.alias("text")))), "quality-asked")
    blocks = max(1, asked.agg(F.count_distinct("block")).first()[0])
    answers = asked.join(log10_of(asked.select("gram").distinct(), orders), "gram")
    none = lambda *names: [F.lit(None).cast(kind).alias(name) for name, kind in names]
    told = answers.select("block", F.lit(-1).cast("long").alias("at"), "gram", *[f"q{m}" for m in MODELS], *none(("doc_id", "long"), ("half", "int"), ("lang", "string"), ("text", "string")))
    doc_id = df[id_col].cast("long")
    texts = df.select(block.alias("block"), at.cast("long").alias("at"), *none(("gram", "long"), *[(f"q{m}", "float") for m in MODELS]), doc_id.alias("doc_id"), half(doc_id).alias("half"), lang.alias("lang"), text.alias("text"))
    dealt = told.unionByName(texts).repartition(blocks, "block").sortWithinPartitions("block", "at", "gram")
    schema = schema_of(df.sparkSession, "doc_id long, lang string, block long, at long, symbols long, log10_prob double, cross double, perplexity double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, known, logs = None, [], None, None
        for batch in batches:
            blocks, ats = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], (blocks[1:] != blocks[:-1]) | ((ats[1:] < 0) != (ats[:-1] < 0))]))
            for start, end in zip(edges, [*edges[1:], len(blocks)]):
                part = batch.slice(start, end - start)
                if blocks[start] != now:
                    now, parts, known, logs = blocks[start], [], None, None
                if ats[start] < 0:
                    parts.append((part.column(2).to_numpy(), np.stack([part.column(3 + m).to_numpy() for m in MODELS], 1)))
                    continue
                if known is None:
                    known, logs = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros((0, len(MODELS)), np.float32))
                    parts = []
                done = [perplexity(t, known, logs) for t in part.column(9).to_pylist()]
                p, n = np.stack([x for x, _ in done]), np.array([x for _, x in done])
                cross = [float(x[0 if h is None else 1 + h]) for (x, _), h in zip(done, part.column(7).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(6), part.column(8), part.column(0), part.column(1), pa.array(n), pa.array(p[:, 0]), pa.array(cross), pa.array(10 ** (-p[:, 0] / n))], names=schema.names)

    return map_batches(dealt, run, schema)


def written_scores(df: DataFrame, orders, place=None) -> DataFrame:
    """``score`` as a table; its narrow rows are dealt anew and go into few files, in proportion to them."""
    rows = df.count()
    return written(score(df, orders, place=place).repartition(-(-max(1, rows) // FILE_ROWS)), "quality-scores")


def thresholds(scores: DataFrame, labels: DataFrame, label_col: str = "quality", quantile: float = 0.998) -> DataFrame:
    """lang, threshold: the quantile, over all trusted documents of a language, of their perplexity under the model that hasn't learned from their half; under a null lang over those of all."""
    trusted = pick(labels, doc_id="doc_id", quality=label_col).where("quality > 0").select("doc_id").distinct()
    known = scores.select("doc_id", "lang", F.pow(F.lit(10.0), -F.col("cross") / F.col("symbols")).alias("perplexity")).join(trusted, "doc_id")
    limit = F.percentile_approx("perplexity", quantile, 10_000).alias("threshold")
    return known.groupBy("lang").agg(limit).unionByName(known.agg(limit).select(F.lit(None).cast("string").alias("lang"), "threshold"))


def judged(scores: DataFrame, labels: DataFrame, quantile: float) -> DataFrame:
    limits = written(thresholds(scores, labels, quantile=quantile), "quality-thresholds", 1)
    overall = limits.where("lang is null").select(F.col("threshold").alias("overall"))
    out = scores.join(limits.where("lang is not null"), "lang", "left").crossJoin(F.broadcast(overall))
    threshold = F.coalesce("threshold", "overall")
    keep = F.coalesce(F.col("perplexity") <= threshold, F.lit(True)) | (F.col("symbols") <= 1)
    return out.select("doc_id", "lang", "block", "at", "symbols", "log10_prob", "perplexity", threshold.alias("threshold"), keep.alias("keep"))


def classify(df: DataFrame, labels: DataFrame, size: int | None = None, quantile: float = 0.998) -> DataFrame:
    """Perplexity, threshold and ``keep`` of every document (doc_id, text, lang).

    A language without trusted documents has the threshold of all; without any trusted document, and
    for an empty text, ``keep`` is true. Repeated rows are answered once each.
    """
    orders = train(df, labels, size=size)
    if orders is None:
        return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("lang"), F.lit(0).cast("long").alias("symbols"), F.lit(0.0).alias("log10_prob"), F.lit(1.0).alias("perplexity"), F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("keep"))
    return judged(written_scores(df, orders), labels, quantile).drop("block", "at")


def keep_good(df: DataFrame, labels: DataFrame, size: int | None = None, quantile: float = 0.998) -> DataFrame:
    """``df`` (with doc_id, text, lang) without the documents that ``classify`` rejects, which are known by block and place."""
    orders = train(df, labels, size=size)
    if orders is None:
        return df
    df, *place = placed(df)
    rejected = written(judged(written_scores(df, orders, place), labels, quantile).where(~F.col("keep")).select("block", "at"), "quality-rejected")
    own = (place[0] == rejected["block"]) & (place[1] == rejected["at"])
    return df.join(rejected, own, "left_anti")
