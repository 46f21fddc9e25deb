import random
from collections import Counter

import numpy as np
import pytest

from kinloom.llm import jaccard_join as jj

from .conftest import odd_texts


def brute(rows, similarity=0.8):
    """links and component label of each distinct set, by comparing all pairs."""
    sets = [frozenset(jj.shingle_set(t or "").tolist()) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=sorted)
    near = {s: [u for u in distinct if u is not s and len(s & u) >= similarity * len(s | u) - 1e-9] for s in distinct}
    label = {}
    for s in distinct:
        if s not in label:
            todo, label[s] = [s], s
            while todo:
                for u in near[todo.pop()]:
                    if u not in label:
                        label[u] = s
                        todo.append(u)
    ids = {}
    for (i, _), s in zip(rows, sets):
        ids.setdefault(label.get(s, s), []).append(i)
    return [(i, min((x for x in ids[label.get(s, s)] if x is not None), default=None), len(near.get(s, ()))) for (i, _), s in zip(rows, sets)]


def corpus(seed=4, groups=40, crowd=0):
    r = random.Random(seed)
    words = ["w%d" % i for i in range(5000)]
    passage = [r.choice(words) for _ in range(40)]
    rows, n = [], 0
    for g in range(groups):
        base = [r.choice(words) for _ in range(r.randint(8, 300))]
        if g % 4 == 0:
            base[3:3] = passage
        for _ in range(r.choice([1, 1, 2, 3, 6]) if g or not crowd else crowd):
            text = list(base)
            for _ in range(r.randint(0, max(1, len(text) // 60))):
                text[r.randrange(len(text))] = r.choice(words)
            rows.append((n, " ".join(text)))
            n += 1
    rows += [(n + k, rows[k][1]) for k in range(0, 30, 3)]
    return rows


def result(spread):
    return sorted(((r.doc_id, r.class_id, r.links) for r in spread.collect()), key=str)


def test_join_equals_brute_force(spark, make_docs):
    rows = corpus()
    assert result(jj.similarity_join(make_docs(rows).repartition(3))) == sorted(brute(rows), key=str)


def test_a_crowd_of_near_copies(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 16)
    rows = corpus(seed=9, groups=8, crowd=150)
    assert result(jj.similarity_join(make_docs(rows))) == sorted(brute(rows), key=str)


def test_a_shared_passage_is_no_link(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 8)
    r = random.Random(3)
    passage = " ".join("p%d" % i for i in range(30))
    rows = [(i, " ".join("x%d" % r.randrange(10**6) for _ in range(60)) + " " + passage) for i in range(200)]
    assert {(r.links, r.class_id == r.doc_id) for r in jj.similarity_join(make_docs(rows)).collect()} == {(0, True)}


def test_recall_at_the_threshold():
    r = np.random.default_rng(1)
    met = 0
    for _ in range(400):
        shared = r.integers(0, 2**63, 160).astype(np.uint64)
        a, b = (np.unique(np.concatenate([shared, r.integers(0, 2**63, 20).astype(np.uint64)])) for _ in range(2))
        start = jj.roots(jj.runs_for(0.999))
        met += bool(set(jj.follow(a, start, jj.DEPTH)[0].tolist()) & set(jj.follow(b, start, jj.DEPTH)[0].tolist()))
    assert met >= 398


@pytest.mark.parametrize(("similarity", "block"), [(0.5, 2048), (0.8, 2048), (0.9, 2048), (0.5, 16), (0.8, 16), (0.9, 16)])
def test_recall_against_brute_force(spark, make_docs, monkeypatch, similarity, block):
    """Pairs just above the threshold, of 30 to 400 shingles; in small blocks a crowd of them fills its nodes. All links of the brute force are found but one in a hundred at most."""
    monkeypatch.setattr(jj, "BLOCK", block)
    r = random.Random(int(100 * similarity) + block)
    rows = []

    def near(base):
        """The text with words exchanged so that its shingles are hardly more similar than asked for; each costs five."""
        text, n = list(base), len(base)
        for k in range(int((1 - similarity) / (1 + similarity) * n / 5)):
            text[min(n - 1, 2 + 5 * k)] = f"y{r.randrange(10**9)}"
        return text

    for g in range(60):
        base = [f"w{g}x{k}" for k in range(r.choice([40, 60, 150, 400]))]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(near(base)))]
    crowd = [f"crowd{k}" for k in range(120)]
    rows += [(1000 + k, " ".join(near(crowd))) for k in range(60 if block == 16 else 5)]
    want, got = brute(rows, similarity), result(jj.similarity_join(make_docs(rows), similarity=similarity))
    found, links = sum(n for *_, n in got), sum(n for *_, n in want)
    assert links >= 60 and 0.99 * links <= found <= links
    assert sum(a == b for a, b in zip(got, sorted(want, key=str))) >= 0.99 * len(rows)


def test_sketches_of_similar_sets_are_let_through():
    r = np.random.default_rng(3)
    for similarity in (0.4, 0.5, 0.8, 0.9, 1.0):
        for _ in range(300):
            n = int(r.integers(8, 800))
            alone = int(n * (1 - similarity) / (1 + similarity))
            parts = [np.unique(r.integers(0, 2**64 - 1, k, np.uint64)) for k in (n - alone, alone, alone)]
            a, b = np.union1d(parts[0], parts[1]), np.union1d(parts[0], parts[2])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            elsewhere = np.zeros((2, 2), bool)
            sizes, marks = np.array([len(a), len(b)]), [jj.sketch_of(a), jj.sketch_of(b)]
            assert jj.promising(0, 0, np.zeros(2, int), sizes, marks, elsewhere, true).all()


def test_odd_rows(spark, make_docs):
    rows = [*enumerate(odd_texts()), (20, None), (21, ""), (None, "a b c d e f"), (None, "a b c d e f"), (30, "A b c  d e f"), (30, "A b c  d e f"), (31, "x y"), (31, "another text under one id")]
    assert result(jj.similarity_join(make_docs(rows).selectExpr("*", "1 as class", "2 as links"))) == sorted(brute(rows), key=str)
    assert jj.similarity_join(make_docs([])).collect() == []


def test_one_of_each(spark, make_docs):
    rows = corpus(seed=5)
    kept = jj.one_of_each(make_docs(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in brute(rows)})
    assert Counter(kept.columns) == Counter(make_docs([]).columns)


def test_one_of_each_with_repeated_rows(spark, make_docs):
    kept = jj.one_of_each(make_docs([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (3, "x y z"), (3, "other words")]))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("1", "a b c d e f g"), ("3", "other words"), ("3", "x y z"), ("None", "a b c d e f g")]
