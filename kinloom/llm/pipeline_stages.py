"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame, each through one operator.

All but the last return the columns of ``documents``. Labels come from ``sf_dir``; what a stage learns
it learns from the documents that reach it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import jaccard_join, packing, quality, secret_scan, toxicity
from .common import read_table


def keep_good(spark, docs, sf_dir):
    """Documents more perplexing than trusted ones of their language go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def keep_civil(spark, docs, sf_dir):
    """Documents with a toxicity score of 0.7 or more go."""
    return toxicity.reject(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels")))


def keep_one(spark, docs, sf_dir):
    """Of documents that links of similarity 0.8 connect, the one with the least id stays."""
    return jaccard_join.one_of_each(docs)


def hide_secrets(spark, docs, sf_dir):
    """Every secret gives way to a mark; ``n_chars`` follows."""
    hidden = secret_scan.redact(docs)
    return hidden.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def pack(spark, docs, sf_dir):
    """What is left, in windows of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
