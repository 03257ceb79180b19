import public_tokenizers
import pytest
import tiktoken

from reviewmill.llm import bpe, queries

TEXTS = ["a   b", "a \n b", "  x", "", None, "x\n\n\ny  z ", "don't I'll 've", "é" * 700, "ab" * 3000, "🙂🙂   x　y", "12 345,6",
         " " * 50, "\t\t a", "plain words, twice", "plain words, twice", "<|endoftext|> is ordinary text"]


@pytest.fixture(scope="module")
def reference():
    with open(queries.RANK_FILE, "rb") as file:
        ranks = bpe.load(file.read()).ids
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encode_equals_library_and_decodes_back(spark, reference):
    df = spark.createDataFrame([(i, t, "kept", -1) for i, t in enumerate(TEXTS)], "doc_id long, text string, decoded string, IDS int")
    coded = bpe.encode(df, queries.RANK_FILE, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "decoded", "ids"]
    back = bpe.decode(coded, queries.RANK_FILE)
    assert back.columns == ["doc_id", "ids", "decoded"]
    rows = {r.doc_id: r for r in back.collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        assert rows[i].ids == reference.encode_ordinary(text or "")
        assert bytes(rows[i].decoded) == (text or "").encode()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df, queries.RANK_FILE, public_tokenizers.PATTERN), queries.RANK_FILE).count() == 0


def test_merge_limits_do_not_change_results(reference):
    with open(queries.RANK_FILE, "rb") as file:
        encoder = bpe.Encoder(bpe.load(file.read()), public_tokenizers.PATTERN, limit=3)
    for _ in range(3):
        for text in TEXTS:
            got = encoder.encode([text, text])
            want = reference.encode_ordinary(text or "")
            assert [list(memoryview(x).cast("i")) for x in got] == [want, want]


def test_query_over_whole_table(spark, reference):
    import hashlib

    from conftest import SF

    rows = {r.doc_id: r for r in queries.op10_bpe(spark, SF).collect()}
    for doc in queries.table(spark, SF, "documents").collect():
        ids = reference.encode_ordinary(doc.text or "")
        got = rows[doc.doc_id]
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()
