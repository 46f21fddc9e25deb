import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinloom.llm import quality

from .conftest import odd_texts


def brute(texts, order=4):
    """The same model, one n-gram at a time."""
    tables = [Counter()]
    for t in texts:
        s = (0,) * (order - 1) + tuple(quality.symbols(t).tolist()) + (0,)
        tables[0].update(s[i : i + order] for i in range(len(s) - order + 1))
    while len(tables) < order:
        tables.append(Counter(g[1:] for g in tables[-1]))
    tables.reverse()

    def discount(n, table):
        n1, n2, n3, n4 = (sum(v == k for v in table.values()) for k in (1, 2, 3, 4))
        y = n1 / max(1, n1 + 2 * n2)
        a, b = {1: (n1, n2), 2: (n2, n3), 3: (n3, n4)}[min(n, 3)]
        k = min(n, 3)
        return min(k, max(0.1, k - (k + 1) * y * b / max(1, a)))

    cuts = [{n: discount(n, t) for n in set(t.values())} for t in tables]
    by_context = []
    for t, c in zip(tables, cuts):
        total, left = defaultdict(int), defaultdict(float)
        for g, n in t.items():
            total[g[:-1]] += n
            left[g[:-1]] += c[n]
        by_context.append((total, left))

    def p(gram):
        if not gram:
            return 1 / 65536
        t, c, (total, left) = tables[len(gram) - 1], cuts[len(gram) - 1], by_context[len(gram) - 1]
        if gram[:-1] not in total:
            return p(gram[1:])
        n = t.get(gram, 0)
        return ((n - c[n]) if n else 0) / total[gram[:-1]] + left[gram[:-1]] / total[gram[:-1]] * p(gram[1:])

    return p


def corpus(n=250, seed=2):
    r = random.Random(seed)
    words = ["".join(r.choice(["an", "re", "tion", "st", "ou", "lé"]) for _ in range(r.randint(1, 4))) for _ in range(300)]
    good = [" ".join(r.choice(words) for _ in range(r.randint(5, 80))).capitalize() + "." for _ in range(n)]
    bad = [" ".join([r.choice(words)] * 30) for _ in range(20)] + ["&&& ".join(r.choice(words) for _ in range(30)) for _ in range(20)] + [r.choice(words).upper() + "!! " * 40 for _ in range(20)]
    return good, bad


@pytest.fixture(scope="module")
def case(spark, make_docs):
    good, bad = corpus()
    rows = list(enumerate([*good, *bad, *odd_texts()]))
    labels = spark.createDataFrame([(i, 1 if i < len(good) else 0) for i in range(len(good) + len(bad))] + [(0, 1)], "doc_id long, quality int")
    return good, bad, make_docs([*rows, (5000, None), (None, good[0]), (None, good[0])]), labels


def test_models_equal_brute_force(spark, case):
    """The probability of texts under each of the three models, through the joins; repeated rows, nulls and odd texts among them."""
    good, _, docs, labels = case
    halves = {r.doc_id: r.half for r in docs.select("doc_id", quality.half(F.col("doc_id")).alias("half")).collect()}
    models = [brute(good), *(brute([t for i, t in enumerate(good) if halves[i] != h]) for h in (0, 1))]
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == docs.count()

    def want(p, text):
        s = (0,) * 3 + tuple(quality.symbols(text).tolist()) + (0,)
        return sum(math.log10(p(s[i : i + 4])) for i in range(len(s) - 3))

    for r in got:
        if r.doc_id is None or r.doc_id % 17 == 0 or r.doc_id >= len(good) + 60:
            text = texts[r.doc_id]
            assert r.symbols == len(text) + 1
            if len(text) < 5000:
                assert r.log10_prob == pytest.approx(want(models[0], text), rel=1e-5)
                assert r.cross == pytest.approx(want(models[0 if r.doc_id is None else 1 + halves[r.doc_id]], text), rel=1e-5)
                assert r.perplexity == pytest.approx(10 ** (-r.log10_prob / r.symbols), rel=1e-9)


def test_probabilities_add_up(spark, case):
    """Over all symbols after a context, under each model."""
    orders = quality.train(case[2], case[3])
    for start in ("tio", "zzz", "Ωж漢"):
        base = quality.grams(start)[2].item() << 16
        asked = spark.range(quality.SYMBOLS).select((F.col("id") + F.lit(base)).alias("gram"))
        sums = quality.log10_of(asked, orders).agg(*[F.sum(F.pow(F.lit(10.0), f"q{m}")) for m in quality.MODELS]).first()
        assert list(sums) == pytest.approx([1, 1, 1], abs=1e-4)


def test_other_scripts_are_told_apart(spark, make_docs):
    r = random.Random(3)
    text = lambda letters: " ".join("".join(r.choice(letters) for _ in range(5)) for _ in range(40))
    docs = make_docs([(i, text("абвгд" if i < 200 else "щъыьэ")) for i in range(240)])
    labels = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    kept = {x.doc_id for x in quality.classify(docs, labels).where("keep").collect()}
    assert len(kept & set(range(200))) >= 190 and not kept & set(range(200, 240))


def test_files_and_blocks_do_not_change_scores(spark, case, tmp_path, monkeypatch):
    docs, labels = case[2], case[3]
    one = sorted(map(str, quality.classify(docs, labels).collect()))
    docs.repartition(5).write.parquet(str(tmp_path / "docs"))
    monkeypatch.setattr(quality, "BLOCK_ROWS", 7)
    monkeypatch.setattr(quality, "HELD_GRAMS", 100)
    again = spark.read.parquet(str(tmp_path / "docs"))
    assert quality.mere_scan(again.where("doc_id >= 0 or doc_id is null").repartition(3)) and not quality.mere_scan(again.join(labels, "doc_id"))
    assert sorted(map(str, quality.classify(again.repartition(3), labels).collect())) == one
    joined = again.join(labels.dropDuplicates(["doc_id"]).withColumnRenamed("quality", "extra"), "doc_id", "left")
    assert sorted(map(str, quality.classify(joined, labels).collect())) == one


def test_repeated_words_have_a_symbol():
    assert (quality.symbols("er er er x er") == quality.REPEAT).sum() == 2
    assert (quality.symbols("thinking thinker") == quality.REPEAT).sum() == 0


def test_junk_goes_and_clean_stays(spark, case):
    good, bad, docs, labels = case
    rows = quality.classify(docs, labels).collect()
    keep = {r.doc_id: r.keep for r in rows if r.doc_id is not None}
    assert len(rows) == docs.count()
    assert sum(keep[i] for i in range(len(good))) >= 0.98 * len(good)
    assert sum(keep[i] for i in range(len(good), len(good) + len(bad))) <= 0.1 * len(bad)
    assert keep[5000] and all(r.keep for r in rows if r.doc_id is None)


def test_filter_agrees_with_classifier(spark, case):
    _, _, docs, labels = case
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(str(r.doc_id) for r in quality.classify(docs, labels).where("keep").collect())


def test_without_labels_or_rows(spark, case, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.keep for r in quality.classify(case[2], none).collect())
    assert quality.keep_good(make_docs([]), case[3]).collect() == []
    assert quality.classify(make_docs([]), case[3]).collect() == []


def test_a_word_is_repeated_only_if_it_is_the_same():
    r = random.Random(6)
    words = ["abcdXefgh", "abcdYefgh", "é", "e", "aa", "aaa", "", "x" * 40, "x" * 39 + "y", "漢字", "漢", "😀"]
    for _ in range(500):
        text = "".join(r.choice(words) + r.choice(" \n") for _ in range(r.randint(1, 8)))
        parts, at = text.replace("\n", " ").split(" "), []
        place = -1
        for a, b in zip(parts, parts[1:]):
            place += len(a) + 1
            if a and a == b:
                at.append(place)
        assert np.flatnonzero(quality.symbols(text) == quality.REPEAT).tolist() == at
    long = "word " * 60_000  # beyond the powers that are kept
    assert (quality.symbols(long) == quality.REPEAT).sum() == 59_999


def test_thresholds_and_decisions_by_brute_force(spark):
    """Each language's limit is a quantile of its trusted documents, each under the model without its half; a document stays up to it. Nulls, repeats and clashing columns included."""
    r = random.Random(8)
    text = lambda junk: " ".join("".join(r.choice("qxzjkv" if junk else "etaoin") for _ in range(r.randint(2, 7))) for _ in range(30))
    rows = [(i, text(i % 10 == 0), ["en", "de", None][i % 3], "s", 1) for i in range(600)] + [(7, None, "en", "s", 1), (5, "again", "xx", "s", 1), (5, "again", "xx", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 10 != 0)) for i in range(0, 600, 2)] + [(None, 1)], "doc_id long, quality int")
    got = quality.classify(docs.selectExpr("*", "1 as keep", "2 as perplexity", "3 as threshold"), labels).collect()
    assert len(got) == len(rows)
    halves = {x.doc_id: x.half for x in docs.select("doc_id", quality.half(F.col("doc_id")).alias("half")).collect()}
    learned = [i for i in range(0, 600, 2) if i % 10]
    models = [brute([rows[i][1] for i in learned if halves[i] != h]) for h in (0, 1)]
    trusted = defaultdict(list)
    for i in learned:
        s = (0,) * 3 + tuple(quality.symbols(rows[i][1]).tolist()) + (0,)
        bits = sum(math.log10(models[halves[i]](s[k : k + 4])) for k in range(len(s) - 3))
        for lang in (rows[i][2] or "", None):
            trusted[lang].append(10 ** (-bits / (len(s) - 3)))
    limit = {lang: sorted(v)[max(0, math.ceil(0.998 * len(v)) - 1)] for lang, v in trusted.items()}
    for x in got:
        assert x.threshold == pytest.approx(limit.get(x.lang, limit[None]), rel=1e-5)
        assert x.keep == (x.perplexity <= x.threshold or x.symbols <= 1)
    assert sum(not x.keep for x in got) > 40


def test_all_trusted_documents_are_learned_from(spark, monkeypatch):
    docs = spark.range(20_050).selectExpr("id as doc_id", "'a' as text")
    learned = []
    monkeypatch.setattr(quality, "count_grams", lambda texts: learned.append(texts.count()) or texts.limit(0))
    assert quality.train(docs, docs.selectExpr("doc_id", "1 as quality")) is None and learned == [20_050]
