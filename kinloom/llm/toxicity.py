"""Toxicity: a weighted lexicon, learned from labels, matched by one automaton over folded text.

Folding lower-cases and undoes homoglyphs and digit substitutions. Lexicon entries are beginnings of
words; an entry counts where a word begins with it, unless an exception phrase covers it. The weighted
hits, divided by the length in words, go through a fitted logistic curve.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from ..sources.shared import broadcast_if_small
from .common import documents, map_chunks, pick, small_batches

#: Look-alikes of Latin letters, digits and signs that stand for letters.
HOMOGLYPHS = dict(zip("аеорсухіјѕһӏԁԛԝαορνκιτυ", "aeopcyxijshldqwaopvkitu"))
SUBSTITUTES = dict(zip("013457@$", "oieastas"))
FOLD = {ord(a): b for a, b in (HOMOGLYPHS | SUBSTITUTES).items()} | dict.fromkeys(map(ord, "​‌‍⁠­﻿"), None)
#: Phrases in which a lexicon word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash collection", "idiot proof", "idiot-proof", "clown fish")
LETTERS = re.compile(r"[^\W\d_]+")
STEM = (3, 12)
#: Words added to the length, so that one hit in a few words isn't all.
STEADY = 20


def folded(text: str) -> str:
    return text.lower().translate(FOLD)


@dataclass(frozen=True)
class Lexicon:
    """Weights of entries, exception phrases, and the curve that turns weight a word into a score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 0.0
    offset: float = -3.0

    def automaton(self) -> ahocorasick.Automaton | None:
        entries = {w: (w, False) for w in self.weights} | {folded(p): (p, True) for p in self.exceptions}
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        for word, (_, harmless) in entries.items():
            found.add_word(word, (len(word), None if harmless else self.weights[word]))
        found.make_automaton()
        return found

    def curve(self, weight: float, words: int) -> float:
        return 1 / (1 + math.exp(-max(-30, min(30, self.offset + self.slope * feature(weight, words)))))


def feature(weight: float, words: int) -> float:
    return math.log1p(100 * weight / (words + STEADY))


def weigh(text: str, hits: ahocorasick.Automaton | None) -> tuple[float, int, int]:
    """Weight of the hits, their number, words in the text. Of hits that begin together the longest counts."""
    plain = folded(text)
    words = len(plain.split())
    if hits is None:
        return 0.0, 0, words
    harmless, at = [], {}
    for last, (n, weight) in hits.iter(plain):
        start = last + 1 - n
        if start and plain[start - 1].isalpha():
            continue
        if weight is None:
            harmless.append((start, last))
        elif start not in at or at[start][0] < last:
            at[start] = (last, weight)
    kept = [w for start, (last, w) in at.items() if not any(a <= start and last <= b for a, b in harmless)]
    return sum(kept), len(kept), words


def held_out(doc_id, fold: int = 3, rest: int = 1):
    return F.crc32(doc_id.cast("string")) % fold == rest


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int | None, allowed) -> DataFrame:
    """At most ``size`` labelled documents, chosen by a hash of their id, or all of them without a size; the only rows that are fitted on."""
    chosen = pick(labels, doc_id="doc_id", label=label).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).where(allowed(F.col("doc_id")))
    chosen = chosen.groupBy("doc_id").agg(F.max("label").alias("label"))
    if size is None:
        return docs.join(broadcast_if_small(chosen, 32), "doc_id")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    return docs.join(F.broadcast(chosen), "doc_id")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", size: int = 10_000, least_g: float = 20.0, least_ratio: float = 8.0, most_entries: int = 4_000) -> Lexicon:
    """A lexicon from at most ``size`` labelled rows outside the held-out fold.

    A beginning of words becomes an entry if the share of toxic documents that have it is
    ``least_ratio`` times that of others and the likelihood ratio of that difference is ``least_g``.
    Texts that repeat count once, with their greatest label. Without toxic or without other rows the lexicon
    is empty and every score the prior.
    """
    sample = labelled_sample(documents(docs, id_col, text_col), labels, label_col, size, lambda i: ~held_out(i))
    rows = sample.groupBy("text").agg(F.max("label").alias("label")).select("label", "text")

    def count():
        def one(batch):
            seen = (Counter(), Counter())
            for label, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = set()
                for w in set(LETTERS.findall(folded(text))):
                    own.update(w[:k] for k in range(STEM[0], min(len(w), STEM[1]) + 1))
                seen[label > 0].update(own)
                seen[label > 0][""] += 1
            stems = list(seen[0].keys() | seen[1].keys())
            return [stems, [seen[0][s] for s in stems], [seen[1][s] for s in stems]]

        return one

    counts = map_chunks(rows.select("label", "text"), count, "stem string, clean long, toxic long", chunk=10_000).groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic >= 3 or stem = ''")
    totals = counts.where("stem = ''").collect()
    if not totals or not totals[0].toxic or not totals[0].clean:
        return Lexicon({}, offset=-3.0 if not totals or not totals[0].toxic else 3.0)
    n0, n1 = totals[0].clean, totals[0].toxic
    share = (F.col("toxic") + F.col("clean")) / F.lit(n0 + n1)
    g = 2 * (F.col("toxic") * F.log(F.col("toxic") / (share * n1)) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (share * n0))).otherwise(0.0))
    strong = counts.where("stem <> ''").withColumn("g", g).where((F.col("g") >= least_g) & (F.col("toxic") / n1 >= least_ratio * (F.col("clean") + 0.5) / n0)).orderBy(F.desc("g"), "stem").limit(most_entries).collect()
    weights: dict[str, float] = {}
    for r in sorted(strong, key=lambda r: (-round(r.g, 6), -len(r.stem), r.stem)):
        if not any(r.stem.startswith(w) or w.startswith(r.stem) for w in weights):
            weights[r.stem] = math.log(((r.toxic + 0.5) / n1) / ((r.clean + 0.5) / n0))
    lexicon = Lexicon(weights)

    def measure():
        hits = lexicon.automaton()
        return lambda batch: [batch.column(0), [feature(w, n) for w, _, n in (weigh(t, hits) for t in batch.column(1).to_pylist())]]

    seen = sorted(map_chunks(rows.select("label", "text"), measure, "label int, x double").collect())  # sums that don't depend on the order of rows
    slope, offset = logistic([r.x for r in seen], [r.label for r in seen])
    return Lexicon(weights, slope=slope, offset=offset)


def logistic(x: list[float], y: list[int], ridge: float = 0.05) -> tuple[float, float]:
    """Slope and offset by Newton steps; both labels weigh as they occur."""
    m = np.column_stack([np.array(x, float), np.ones(len(x))])
    t, b = (np.array(y) > 0).astype(float), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ b, -30, 30)))
        step = np.linalg.solve(m.T * (p * (1 - p) + 1e-9) @ m + ridge * np.eye(2), m.T @ (t - p) - ridge * b)
        b += np.clip(step, -2, 2)
        if abs(step).max() < 1e-9:
            break
    return float(max(b[0], 0)), float(b[1])


def score(df: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, weight, hits, words for every whole text. A null or empty text has the score of no hits; repeated rows are answered once each."""

    def make():
        hits = lexicon.automaton()

        def one(batch):
            rows = [(lexicon.curve(w, n), w, k, n) for w, k, n in (weigh(t, hits) for t in batch.column(1).to_pylist())]
            return [batch.column(0), *([list(c) for c in zip(*rows)] if rows else [[]] * 4)]

        return one

    return map_chunks(documents(df, id_col, text_col), make, "doc_id long, score double, weight double, hits long, words long")


def reject(df: DataFrame, lexicon: Lexicon, text_col: str = "text", at: float = 0.7) -> DataFrame:
    """``df`` without the rows whose text scores ``at`` or more; all columns stay."""

    @pandas_udf(DoubleType())
    def scores(texts: pd.Series) -> pd.Series:
        hits = lexicon.automaton()
        return pd.Series([lexicon.curve(w, n) for w, _, n in (weigh(t or "", hits) for t in texts)], dtype=float)

    small_batches(df.sparkSession)
    return df.where(scores(F.col(text_col)) < at)
