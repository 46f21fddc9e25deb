"""Whole runs over files: validate, normalise, pair, block, evaluate, finalise, features. Each writes its tables and a report."""

from __future__ import annotations

import time
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, candidates, features, normalize, pairs, quality, recall, truth
from ..sources import tables as io
from ..sources.shared import written

SOURCES = {k: f"train/train_source{k}.tsv" for k in (1, 2, 3)}
TRUTH = "train/train_ground_truth.tsv"


@dataclass(frozen=True)
class Run:
    """Where a run reads and writes, and its settings."""

    raw: str
    out: str
    normal: str | None = None
    version: str = "v001"
    commit: str = ""
    settings: blocking.Blocking = field(default_factory=blocking.Blocking)
    negatives: pairs.Negatives = field(default_factory=pairs.Negatives)


def _row(table: DataFrame) -> dict:
    return table.first().asDict(recursive=True)


def _sources(spark: SparkSession, run: Run) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(io.read_records(spark, run.normal or run.raw, SOURCES[k]) for k in (1, 2, 3))


def validate(spark: SparkSession, run: Run) -> dict:
    report = quality.validate_dataset(spark, run.raw)
    io.write_json(spark, io.join_path(run.out, "validation_report.json"), report)
    return report


def normalize_all(spark: SparkSession, run: Run) -> dict:
    """All source files that are there, each to a table beside a report."""
    report: dict = {"files": {}, "version": run.version}
    for relative, kind in io.EXPECTED_FILES.items():
        path = io.join_path(run.raw, relative)
        if kind == "truth" or not io.exists(spark, path):
            continue
        before = io.read_tsv(spark, path)
        target = io.join_path(run.out, relative.replace(".tsv", "_normalized.tsv"))
        io.write_tsv(normalize.normalize(before), target)
        report["files"][relative] = _row(normalize.summary(before, io.read_tsv(spark, target)))
    report["status"] = "PASS" if report["files"] and all(f["status"] == "PASS" for f in report["files"].values()) else "FAIL"
    io.write_json(spark, io.join_path(run.out, "normalization_report.json"), report)
    return report


def training_pairs(spark: SparkSession, run: Run, max_rows: int | None = None) -> dict:
    """Training pairs of the ground truth, or of its first ``max_rows`` rows by id (a sampling operator)."""
    raw = io.read_tsv(spark, io.join_path(run.raw, TRUTH))
    if max_rows:
        raw = raw.orderBy(*io.TRUTH_COLUMNS).limit(max_rows)
    s1, s2, s3 = _sources(spark, run)
    edges = truth.edges(raw)
    fields = lambda r: normalize.fields(r)
    made = pairs.positives(edges).unionByName(pairs.negatives(edges, pairs.pool(s2, s3), run.negatives, fields(s1)))
    io.write_parquet(made, io.join_path(run.out, "training_pairs"))
    made = spark.read.parquet(io.join_path(run.out, "training_pairs"))
    tests = None
    for k in (1, 2, 3):
        path = io.join_path(run.raw, f"test/test_source{k}.tsv")
        if io.exists(spark, path):
            ids = io.read_tsv(spark, path).select("entity_id")
            tests = ids if tests is None else tests.unionByName(ids)
    verdict = _row(pairs.checks(made, edges, tests, all_positives=True))
    report = {"profile": _row(truth.profile(raw)), "stats": _row(pairs.stats(made)), "checks": verdict, "status": "FAIL" if "FAIL" in verdict.values() else "PASS"}
    io.write_bundle(spark, run.out, {"training_pairs.tsv": made}, {"pair_generation_report": report}, ("source1_entity_id", "target_entity_id"))
    return report


def generate_candidates(spark: SparkSession, run: Run, strategy: str = "composite", sample_size: int | None = None) -> dict:
    """Candidates of all records of source 1, or of its first ``sample_size`` by id (a sampling operator)."""
    began = time.time()
    settings = replace(run.settings, strategies=blocking.strategies_of(strategy, run.settings))
    s1, s2, s3 = _sources(spark, run)
    if sample_size:
        s1 = s1.orderBy("entity_id").limit(sample_size)
    io.write_parquet(blocking.candidates(s1, s2, s3, settings), io.join_path(run.out, "candidates"))
    found = spark.read.parquet(io.join_path(run.out, "candidates"))
    stats = _row(blocking.posting_stats(blocking.target_keys(s2, s3, settings), settings))
    verdict = _row(candidates.blocking_checks(found, version=run.version, settings=settings.to_dict(), commit=run.commit, strategy=strategy))
    report = {"strategy": strategy, "settings": settings.to_dict(), "index": stats, "checks": verdict, "status": verdict["status"], "runtime_seconds": round(time.time() - began, 2)}
    io.write_bundle(spark, run.out, {"candidate_pairs.tsv": found}, {"blocking_metadata": report}, ("source1_entity_id", "target_entity_id"))
    return report


def evaluate_blocking(spark: SparkSession, run: Run, sample_size: int | None = None) -> dict:
    """All strategies against the truth; a sample of records (by hash of the id) if asked for."""
    s1, s2, s3 = _sources(spark, run)
    edges = truth.edges(io.read_tsv(spark, io.join_path(run.raw, TRUTH)))
    if sample_size:
        some = s1.select("entity_id").orderBy(F.xxhash64(F.lit(run.settings.seed), "entity_id")).limit(sample_size)
        s1 = io.only_ids(s1, some)
        edges = edges.join(s1.select(F.col("entity_id").alias("s1")), "s1", "left_semi")
    both = blocking.targets(s2, s3)
    io.write_parquet(blocking.pairs(s1, s2, s3, run.settings), io.join_path(run.out, "pairs"))
    found = spark.read.parquet(io.join_path(run.out, "pairs"))
    total = _row(recall.overall(edges, found, s1, both))
    rows = lambda t: [r.asDict() for r in t.collect()]
    report = {
        "overall": total, "strategies": rows(recall.by_strategy(edges, found, s1, both, run.settings)), "by_source": rows(recall.by_source(edges, found)), "by_country": rows(recall.by_country(edges, found, normalize.fields(s1))),
        "candidates": _row(recall.distribution(s1, found)), "zero_match": _row(recall.zero_match(s1, edges, found)), "multi_match": _row(recall.multi_match(s1, edges, found)), "missed": rows(recall.missed(edges, found).limit(20)),
        "status": "PASS" if total["recovered"] + total["missed"] == total["true_pairs"] else "FAIL",
    }
    io.write_json(spark, io.join_path(run.out, "blocking_strategy_results.json"), report)
    return report


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """A table of pairs, TSV or Parquet, in the order of its files."""
    return io.read_tsv(spark, path, dealt=False) if path.endswith((".tsv", ".tsv.gz")) else spark.read.parquet(path)


def evaluate_recall(spark: SparkSession, found_path: str, truth_path: str, out: str, n_s1: int = 2_206_821, n_targets: int = 10_320_219) -> dict:
    """Recall of a candidate file against any ground-truth file; without truth it is 0. The pool sizes default to the full data's."""
    read = partial(read_pairs, spark)
    rows = candidates.with_position(read(found_path))
    found = candidates.marked(rows).where("copy = 1").select(F.col("source1_entity_id").alias("s1"), F.col("target_entity_id").alias("t"))
    known = truth.positives(read(truth_path))
    per = _row(recall.s1_recovery(known, found))
    n = rows.count()
    order = _row(candidates.inversions(rows))["inversions"]
    report = {
        "recovery": per, "recall": per["recovered"] / per["true_pairs"] if per["true_pairs"] else 0.0, "by_source": [r.asDict() for r in recall.by_source(known, found, 0.0).collect()],
        "candidate_rows": n, "reduction_ratio": 1 - n / (n_s1 * n_targets) if n_s1 * n_targets else None, "sorted": order == 0, "status": "PASS" if per["consistent"] and order == 0 else "FAIL",
    }
    io.write_tsv(recall.missed(known, found), io.join_path(out, "missed_positive_pairs.tsv"), compression="gzip")
    io.write_json(spark, io.join_path(out, "blocking_recall_report.json"), report)
    return report


def finalize(spark: SparkSession, found_path: str, out: str, expected: int | None = None, test_ids: DataFrame | None = None, commit: str = "") -> dict:
    raw = candidates.with_position(read_pairs(spark, found_path))
    rows = candidates.marked(raw, test_ids)
    io.write_parquet(candidates.final(rows), io.join_path(out, "candidates"))
    made = spark.read.parquet(io.join_path(out, "candidates"))
    verdict = _row(candidates.final_checks(rows, candidates.inversions(raw), expected, commit))
    report = {"checks": verdict, "status": verdict["status"], "degrees": _row(candidates.degree_stats(made)), "strategies": {r.strategy: r.n for r in candidates.contributions(made).collect()}}
    io.write_bundle(spark, out, {"candidate_pairs.tsv": made}, {"candidate_validation_report": report}, ("source1_entity_id", "target_entity_id"))
    return report


def build_features(spark: SparkSession, run: Run, rows: DataFrame, name: str, candidate: bool, max_rows: int | None = None) -> dict:
    """Features of training pairs or candidates, as one table and as features, labels and ids apart."""
    if max_rows:
        rows = rows.orderBy("source1_entity_id", "target_entity_id").limit(max_rows)
    whole = lambda r: r if "business_name_normalized" in r.columns else normalize.normalize(r)
    known = written(features.one_of_each(*map(whole, _sources(spark, run))), "feature-records")
    made = features.pair_features(rows if candidate else rows.drop("strategies"), known, features.small(known))
    path = io.join_path(run.out, f"features_{name}")
    io.write_parquet(made, path)
    made = spark.read.parquet(path)
    ids = [c for c in ("source1_entity_id", "target_entity_id", "target_source", "pair_type", "strategies") if c in made.columns]
    io.write_features(made, io.join_path(run.out, f"matrix_{name}"), features.feature_names(), ids)
    verdict = _row(features.checks(made, candidate, commit=run.commit))
    report = {"checks": verdict, "status": verdict["status"], "schema": features.feature_schema(run.version), "summary": [r.asDict() for r in features.summary(made).collect()]}
    io.write_json(spark, io.join_path(run.out, f"feature_report_{name}.json"), report)
    return report


def smoke_test(spark: SparkSession, out: str) -> dict:
    """Every phase once over a few records made here, below ``out``: what each says, and FAIL unless all pass."""
    raw = io.join_path(out, "raw")
    names = ("Harbour Mill", "Quiet River Works", "Lantern Foods")
    for split, mark in (("train", "s"), ("test", "t")):
        for k in (1, 2, 3):
            rows = [(f"{mark}{k}_{i}", name + " Ltd" * (k > 1), f"{i} Orchard Street", "US") for i, name in enumerate(names)]
            table = spark.createDataFrame(rows, io.record_schema())
            io.write_tsv(table, io.join_path(raw, f"{split}/{split}_source{k}.tsv"))
    lists = [(f"s1_{i}", f"s2_{i},s3_{i}" if i else "") for i in range(len(names))]
    io.write_tsv(spark.createDataFrame(lists, ", ".join(f"{c} string" for c in io.TRUTH_COLUMNS)), io.join_path(raw, TRUTH))
    run = Run(raw, io.join_path(out, "smoke"), commit="smoke")
    found = io.join_path(run.out, "candidates")
    steps = {
        "validate": partial(validate, spark, run), "normalize": partial(normalize_all, spark, run),
        "training_pairs": partial(training_pairs, spark, run), "evaluate_blocking": partial(evaluate_blocking, spark, run),
        "generate_candidates": partial(generate_candidates, spark, run),
        "evaluate_recall": lambda: evaluate_recall(spark, found, io.join_path(raw, TRUTH), run.out, len(names), 2 * len(names)),
        "finalize": lambda: finalize(spark, found, io.join_path(run.out, "final"), commit="smoke"),
        "features": lambda: build_features(spark, run, spark.read.parquet(found), "candidates", True),
    }
    report: dict = {"steps": {name: step()["status"] for name, step in steps.items()}}
    report["status"] = "PASS" if set(report["steps"].values()) == {"PASS"} else "FAIL"
    io.write_json(spark, io.join_path(out, "smoke_report.json"), report)
    return report
