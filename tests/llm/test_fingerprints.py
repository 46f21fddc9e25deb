import hashlib

import numpy as np
import pytest

from kinloom.llm import fingerprints as fp

from .conftest import odd_texts


def jaccard(a, b):
    a, b = set(fp.shingle_hashes(a).tolist()), set(fp.shingle_hashes(b).tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def test_estimates(real_texts):
    texts = [t for t in real_texts.text if len(t) > 50]
    for a, b in zip(texts, [t[: len(t) * 3 // 4] + u[: len(t) // 4] for t, u in zip(texts, texts[1:] + texts[:1])]):
        x, y = fp.sketch(a), fp.sketch(b)
        assert abs(fp.resemblance(x, y) - jaccard(a, b)) < (0.16 if len(x) == 256 or len(y) == 256 else 1e-9)
        true = len(set(fp.shingle_hashes(a).tolist()))
        assert abs(fp.distinct_shingles(x) - true) <= (0.35 * true if len(x) == 256 else 0)


def test_merging_parts_gives_the_whole(real_texts):
    a, b = max(real_texts.text, key=len), real_texts.text[0]
    whole = np.unique(np.concatenate([fp.shingle_hashes(a), fp.shingle_hashes(b)]))[:256]
    assert (fp.merge(fp.sketch(a), fp.sketch(b)) == whole).all()


def test_merge_operator(spark, make_docs, real_texts):
    docs = make_docs(list(zip(real_texts.doc_id.tolist(), real_texts.text)))
    one = fp.merge_sketches(fp.fingerprint_documents(docs).selectExpr("doc_id % 3 as k", "sketch"), ["k"]).collect()
    for r in one:
        whole = np.unique(np.concatenate([fp.sketch(t) for i, t in zip(real_texts.doc_id, real_texts.text) if i % 3 == r.k]))[:256]
        assert (np.frombuffer(bytes(r.sketch), "<u8") == whole).all()


def test_containment(real_texts):
    """Of a text in one that begins with it all shingles are contained; of two others as brute force says."""
    texts = [t for t in real_texts.text if len(t) > 200]
    for a, b in zip(texts, texts[1:]):
        x, both = fp.sketch(a), fp.sketch(a + " " + b)
        assert fp.containment(x, both) >= 0.97 and fp.containment(np.empty(0, np.uint64), x) == 1.0
        half = a[: len(a) // 2] + b[: len(b) // 2]
        own, other = set(fp.shingle_hashes(a).tolist()), set(fp.shingle_hashes(half).tolist())
        assert abs(fp.containment(x, fp.sketch(half)) - len(own & other) / len(own)) < 0.3


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_edited_against_brute_force(spark, make_docs, parts):
    placed = [*enumerate(odd_texts(), 7), (3, None), (90, "a b c d e f " * 30), (90, "a b c d e f " * 30)]
    lost = [(None, "first of all words here now"), (None, None), (None, "first of all words here now")]
    ordered = sorted((i, t or "") for i, t in placed)
    got = fp.fingerprint_edited(make_docs(placed + lost).repartition(5), parts=parts).toPandas()
    assert len(got) == len(placed) + len(lost)
    want = []
    following = list(zip(ordered, ordered[1:] + ordered[:1])) + [((-1, t or ""), ordered[0]) for _, t in lost]
    for (i, t), (_, u) in following:
        m = len(t) // 4
        e = t[: len(t) - m] + u[:m]
        x, y, z = map(fp.sketch, (t, e, u))
        digest = hashlib.sha256(e.encode()).hexdigest()
        want.append((i, len(t), digest, fp.resemblance(x, y), fp.resemblance(x, z), fp.containment(x, y), fp.containment(x, z)))
    have = [(-1 if r.doc_id != r.doc_id else int(r.doc_id), r.n_chars, r.edited_sha256, r.near_edited, r.near_next, r.contained_in_edited, r.contained_in_next) for r in got.itertuples()]
    assert sorted(have) == sorted(want)


def test_ids_that_are_all_null(spark, make_docs):
    rows = fp.fingerprint_edited(make_docs([(None, "abcdefgh"), (None, "x")])).collect()
    assert sorted(r.edited_sha256 for r in rows) == sorted(hashlib.sha256(t).hexdigest() for t in (b"abcdef", b"x"))


def test_one_row_and_none(spark, make_docs):
    one = fp.fingerprint_edited(make_docs([(1, "abcdefgh")])).collect()
    assert [r.edited_sha256 for r in one] == [hashlib.sha256(b"abcdefab").hexdigest()] and one[0].near_next == 1.0
    assert fp.fingerprint_edited(make_docs([])).collect() == []
