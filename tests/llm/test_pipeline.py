import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

from .test_jaccard import brute as joined
from .test_quality import corpus as quality_corpus


@pytest.fixture(scope="module")
def folder(spark, make_docs, tmp_path_factory):
    r = random.Random(1)
    good, bad = quality_corpus(600, seed=8)
    good = [g if len(g.split()) > 8 else g + " " + g.lower() for g in good]
    rows, labels = [], []
    for t in good:
        toxic = r.random() < 0.2
        words = t.split()
        if toxic:
            for _ in range(max(1, len(words) // 12)):
                words[r.randrange(len(words))] = r.choice(["grobian", "snargel"])
        labels.append((len(rows), 1, int(toxic)))
        rows.append((len(rows), " ".join(words)))
    for t in bad:
        labels.append((len(rows), 0, 0))
        rows.append((len(rows), t))
    clean = [i for i, q, x in labels if q and not x]
    for i in clean[:25]:
        rows.append((len(rows), rows[i][1]))
    for i in [i for i in clean[25:90] if len(rows[i][1].split()) > 60][:15]:
        rows.append((len(rows), rows[i][1] + " extra"))
    rows.append((len(rows), " ".join(rows[i][1].split()[0].lower() for i in clean) + " password = hunter2hunter2 ends"))
    d = tmp_path_factory.mktemp("sf")
    make_docs(rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d), rows, {i: (q, x) for i, q, x in labels}


def test_stages_and_whole(spark, folder):
    d, rows, labels = folder
    docs, texts = spark.read.parquet(f"{d}/documents.parquet"), dict(rows)
    columns, left = docs.columns, [len(rows)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.written(stage(spark, docs, d), "t")
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        gone = before.keys() - after.keys()
        if name == "quality":
            assert {i for i, (q, _) in labels.items() if not q} - gone == set() or len({i for i, (q, _) in labels.items() if not q} - gone) <= 5
            assert len([i for i in gone if labels.get(i, (1, 0))[0]]) <= 5
        elif name == "toxicity":
            toxic = {i for i, (q, x) in labels.items() if x and i in before}
            assert len(toxic - gone) <= 0.05 * len(toxic) and not [i for i in gone if not labels.get(i, (1, 0))[1]]
        elif name == "near_copies":
            assert after.keys() == {c for _, c, _ in joined(list(before.items()))}
            assert gone
        else:
            assert not gone and {i for i in after if after[i] != before[i]} == {rows[-1][0]}
            assert after[rows[-1][0]] == texts[rows[-1][0]].replace("password = hunter2hunter2", "[SECRET]")
            assert all(r.n_chars == len(r.text) for r in docs.collect())
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    pieces = corpus_pipeline.run(spark, d).toPandas()
    assert set(pieces.doc_id) == after.keys()
    for p in pieces.itertuples():
        ids = [*library.encode(after[p.doc_id], add_special_tokens=False).ids, 1]
        assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())


def test_empty_tables(spark, tmp_path, make_docs):
    make_docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows_and_clashing_columns(spark, tmp_path, make_docs):
    """Null texts and ids, repeated ids and rows, very long texts, and columns named like what the operators make."""
    text = lambda k: " ".join(f"word{k}x{i} and" for i in range(30))
    rows = [(1, text(1)), (2, None), (3, ""), (None, text(4)), (None, None), (5, text(5)), (5, text(5)), (6, text(6)), (6, text(7)), (8, text(8) * 300), (9, text(1))]
    docs = make_docs(rows).selectExpr("*", "1 as score", "2 as class_id", "3 as keep", "4 as part", "5 as spans", "6 as label")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1, 1, 0), (5, 1, 0), (8, 1, 0), (None, 1, 1), (6, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = corpus_pipeline.written(stage(spark, left, str(tmp_path)), "t")
        assert left.columns == docs.columns
    kept = sorted(((r.doc_id is None, r.doc_id or 0), r.text or "") for r in left.collect())
    # of texts 1 and 9 the least id, of the empty ones 2; rows that repeat an id and a text once; rows without an id all
    wanted = [((False, i), t) for i, t in ((1, text(1)), (2, ""), (5, text(5)), (6, text(6)), (6, text(7)), (8, text(8) * 300))]
    assert kept == sorted([*wanted, ((True, 0), text(4)), ((True, 0), "")])
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_tokens for p in pieces if p.doc_id == 2} == {1} and sum(p.doc_id is None for p in pieces) >= 2
    assert sum(p.length for p in pieces if p.doc_id == 8) == next(p.doc_tokens for p in pieces if p.doc_id == 8)
