import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs; language, source and length are filled in."""

    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, "src0", len(t or "")) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def real_texts(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").toPandas()


def odd_texts():
    """Empty, short, long and strange texts, used by many tests."""
    return ["", " ", "x", "one two", "<|endoftext|>", "a <|endoftext|>  b", "日本語 テキスト　 x", "it's 'S we'll\n\n foo\t\tbar ", "😀😀 ﬁ İstanbul ΣΑΣ", "x \x85 y\x1c z\x0b\x7f", "é" * 3000, "aaaa" * 2000 + "!!" * 99, "word " * 4000]
