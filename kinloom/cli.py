"""Command line: ``python -m kinloom.cli COMMAND --input ... --output ...``; ends with 1 unless the report says PASS."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from .operators import blocking, pairs
from .plans import pipelines

COMMANDS = ("validate", "normalize", "training-pairs", "evaluate-blocking", "generate-candidates", "evaluate-recall", "finalize", "features", "smoke-test")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="kinloom")
    out.add_argument("command", choices=COMMANDS)
    out.add_argument("--input", default="", help="root of the raw files, or the candidate file; smoke-test needs none")
    out.add_argument("--output", required=True)
    out.add_argument("--normalized", help="root of the normalised files")
    out.add_argument("--ground-truth", help="ground truth for evaluate-recall")
    out.add_argument("--pairs", help="pairs for features of one mode")
    out.add_argument("--training-pairs", help="training pairs for features of mode all")
    out.add_argument("--mode", choices=("train", "candidates", "all"), default="candidates")
    out.add_argument("--strategy", default="composite")
    out.add_argument("--strategies", nargs="*")
    out.add_argument("--sample-size", type=int)
    out.add_argument("--max-rows", type=int)
    out.add_argument("--max-posting-list-size", type=int, default=500)
    out.add_argument("--country-agreement-mode", choices=("allow_missing", "strict", "none"), default="allow_missing")
    out.add_argument("--negatives-per-positive", type=int, default=1)
    out.add_argument("--hard-negative-ratio", type=float, default=0.5)
    out.add_argument("--seed", type=int, default=42)
    out.add_argument("--expected-count", type=int)
    # The sizes of the full pools
    out.add_argument("--total-s1-pool", type=int, default=2_206_821)
    out.add_argument("--total-target-pool", type=int, default=10_320_219)
    out.add_argument("--version", default="v001")
    out.add_argument("--commit", default="")
    return out


def run_of(a: argparse.Namespace) -> pipelines.Run:
    settings = blocking.Blocking(max_posting_list_size=a.max_posting_list_size, country_agreement_mode=a.country_agreement_mode, seed=a.seed)
    if a.strategies:
        settings = replace(settings, strategies=tuple(s for name in a.strategies for s in blocking.strategies_of(name, settings)))
    return pipelines.Run(a.input, a.output, a.normalized, a.version, a.commit, settings, pairs.Negatives(a.negatives_per_positive, a.hard_negative_ratio, a.seed))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if not a.input and a.command != "smoke-test":
        parser().error(f"{a.command} needs --input")
    spark = spark or SparkSession.builder.appName(f"kinloom {a.command}").getOrCreate()
    run = run_of(a)
    if a.command == "validate":
        report = pipelines.validate(spark, run)
    elif a.command == "normalize":
        report = pipelines.normalize_all(spark, run)
    elif a.command == "training-pairs":
        report = pipelines.training_pairs(spark, run, a.max_rows)
    elif a.command == "evaluate-blocking":
        report = pipelines.evaluate_blocking(spark, run, a.sample_size)
    elif a.command == "generate-candidates":
        report = pipelines.generate_candidates(spark, run, a.strategy, a.sample_size)
    elif a.command == "evaluate-recall":
        report = pipelines.evaluate_recall(spark, a.input, a.ground_truth, a.output, a.total_s1_pool, a.total_target_pool)
    elif a.command == "finalize":
        report = pipelines.finalize(spark, a.input, a.output, a.expected_count, commit=a.commit)
    elif a.command == "smoke-test":
        report = pipelines.smoke_test(spark, a.output)
    else:
        modes = ("train", "candidates") if a.mode == "all" else (a.mode,)
        paths = {m: a.training_pairs if a.mode == "all" and m == "train" else a.pairs for m in modes}
        made = [pipelines.build_features(spark, run, pipelines.read_pairs(spark, p), m, m == "candidates", a.max_rows) for m, p in paths.items()]
        report = {"status": "PASS" if all(r["status"] == "PASS" for r in made) else "FAIL"}
    print(json.dumps({"command": a.command, "status": report["status"]}))
    return 0 if report["status"] == "PASS" else 1


if __name__ == "__main__":
    sys.exit(main())
