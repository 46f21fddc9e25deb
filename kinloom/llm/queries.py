"""The queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import functions as F

from . import audio, bpe, fingerprints, jaccard_join, packing, pitman_yor, quality, secret_scan, token_counts, toxicity
from .common import read_table


def op1_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_edited(read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir, path=None):
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), path or public_tokenizers.path("byte_bpe_50k.json"))


def op3_quality(spark, sf_dir):
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_pitman_yor(spark, sf_dir):
    return pitman_yor.score_documents(read_table(spark, sf_dir, "documents"))


def op5_audio_features(spark, sf_dir):
    return audio.media_columns(read_table(spark, sf_dir, "documents"), project=audio.digest, ddl="n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op6_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon).select("doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "hits", "words")


def op7_secret_scan(spark, sf_dir):
    found = secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))
    return found.select("doc_id", *map(count, secret_scan.BASE), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op8_byte_bpe(spark, sf_dir, path=None):
    def digests(enc, ids):
        numbers = ids.tolist()
        line = ",".join(map(enc.decimal.__getitem__, numbers))
        return len(numbers), hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256(enc.decode(numbers)).hexdigest()

    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, project=digests, ddl="n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_packing(spark, sf_dir, path=None):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), path or public_tokenizers.path("word_bpe_49k.json"))


def op10_jaccard_join(spark, sf_dir):
    return jaccard_join.similarity_join(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_token_counts, op3_quality, op4_pitman_yor, op5_audio_features, op6_toxicity, op7_secret_scan, op8_byte_bpe, op9_packing, op10_jaccard_join)}
ORACLE_SQL: dict[str, str] = {}
