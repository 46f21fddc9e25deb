"""A training-data pipeline over ``documents``: each stage works on all that its predecessor kept.

Junk goes, toxic documents go, one of each group of near copies stays, secrets are hidden, and what is
left is packed. Every stage is written to the shared folder and reread, so none is computed twice.
"""

from __future__ import annotations

from kinloom.llm import pipeline_stages as stages
from kinloom.llm.common import read_table, written
from kinloom.sources.shared import spread

STAGES = [
    ("quality", stages.keep_good),
    ("toxicity", stages.keep_civil),
    ("near_copies", stages.keep_one),
    ("secrets", stages.hide_secrets),
    ("packing", stages.pack),
]
#: No SQL for learned models and tokenizers; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spread(read_table(spark, sf_dir, "documents"))
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
