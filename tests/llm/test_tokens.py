import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from kinloom.llm import bpe, packing, queries, token_counts

from .conftest import odd_texts

WORD = P.path("word_bpe_49k.json")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def noisy(n, seed=3):
    r = random.Random(seed)
    alphabet = ["a", "b", "the", " ", "  ", "\n", "'s", "'", "9", "é", "ß", "!", "日", "<|endoftext|>", "ing", "\t", "A", "😀", "\x85"]
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(real_texts):
    return [*odd_texts(), *noisy(300), *real_texts.text.tolist()]


def test_counts_equal_the_library(texts):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    count = token_counts.counter(P.path("byte_bpe_50k.json")).count
    assert [count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_whole_tokens_are_proved():
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    proved = token_counts.whole_tokens(P.path("byte_bpe_50k.json"))
    some = random.Random(0).sample(sorted(proved), 2000)
    assert len(proved) > 40_000
    assert all(len(library.model.tokenize("".join(bpe.byte_letters()[b] for b in t.encode()))) == 1 for t in some)


def test_ids_equal_the_library(texts):
    own = bpe.encoder(RANKS, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    for t in texts:
        assert own.encode(t).tolist() == library.encode_ordinary(t)
        assert own.decode(own.encode(t).tolist()).decode() == t


def test_queue_equals_plain_merging():
    ranks = {bytes([b]): b for b in range(256)}
    r = random.Random(5)
    while len(ranks) < 600:
        ranks.setdefault(b"".join(r.choice(list(ranks)[97:100] + list(ranks)[256:]) for _ in range(2)), len(ranks))
    merges = bpe.rank_merges(ranks)

    def plain(raw):
        parts = [bytes([b]) for b in raw]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    for n in [0, 1, 2, 3, *range(4, 120)]:
        raw = bytes(r.choice(b"abc") for _ in range(n))
        assert merges.encode(raw) == plain(raw)


def test_a_very_long_pre_token_is_quick():
    text = "ab" * 200_000
    own = bpe.encoder(RANKS, P.PATTERN)
    assert own.decode(own.encode(text).tolist()).decode() == text


def test_count_query_handles_nulls_and_extra_columns(spark, make_docs):
    docs = make_docs([(1, None), (1, None), (None, "a b"), (2, "word " * 2000)]).selectExpr("*", "1 as n_tokens", "2 as ids")
    rows = sorted(token_counts.count_tokens(docs, P.path("byte_bpe_50k.json")).collect(), key=str)
    assert [(r.doc_id, r.n_tokens, r.over_limit) for r in rows if r.doc_id == 1] == [(1, 0, False)] * 2
    assert [(r.n_tokens, r.n_bytes) for r in rows if r.doc_id is None] == [(2, 3)]
    assert [r.over_limit for r in rows if r.doc_id == 2] == [True]
    assert token_counts.count_tokens(make_docs([]), P.path("byte_bpe_50k.json")).collect() == []


def test_encode_and_decode_operators(spark, make_docs):
    docs = make_docs([*enumerate(odd_texts()), (99, None)])
    ids = bpe.encode_documents(docs, RANKS, P.PATTERN)
    back = {r.doc_id: bytes(r.bytes).decode() for r in bpe.decode_documents(ids, RANKS).collect()}
    assert back == dict(enumerate(odd_texts())) | {99: ""}
    assert bpe.encode_documents(make_docs([]), RANKS, P.PATTERN).collect() == []


def test_encode_query_digests(spark, tmp_path, make_docs):
    make_docs(list(enumerate(odd_texts()))).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op8_byte_bpe(spark, str(tmp_path)).collect():
        assert r.decoded_sha256 == hashlib.sha256(odd_texts()[r.doc_id].encode()).hexdigest()


def test_word_ids_equal_the_library(texts):
    library = Tokenizer.from_file(WORD)
    own = packing.word_encoder(WORD)
    for t in texts:
        assert np.frombuffer(own.encode(t), own.kind).tolist() == library.encode(t, add_special_tokens=False).ids


def test_packing_is_whole_and_gapless(spark, make_docs):
    rows = [*enumerate(odd_texts()), (50, None), (50, None), (None, "tail")]
    library = Tokenizer.from_file(WORD)
    pieces = packing.pack_documents(make_docs(rows).repartition(3), WORD, window=64).toPandas()
    expected = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert pieces.length.sum() == expected
    place = sorted(zip(pieces.sequence_id * 64 + pieces.offset, pieces.length))
    assert place[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(place, place[1:]))
    assert (pieces.offset + pieces.length).max() <= 64
    for i, t in enumerate(odd_texts()):
        own = pieces[pieces.doc_id == i].sort_values("start")
        ids = [*library.encode(t, add_special_tokens=False).ids, 1]
        assert set(own.doc_tokens) == {len(ids)} and own.start.tolist() == [0, *own.length.cumsum().tolist()][:-1]
        import zlib

        assert [zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) for s, n in zip(own.start, own.length)] == own.ids_crc32.tolist()
    assert packing.pack_documents(make_docs([]), WORD).collect() == []
