import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from conftest import SF
from reviewmill.llm import bpe, queries, tokencount

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(queries.RANK_FILE, "rb") as file:
        ranks = bpe.load(file.read()).ids
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute(tokens, spans):
    """Counts per section and of none; ``tokens`` are byte strings, ``spans`` byte offsets."""
    counts, start = [0] * (len(spans) + 1), 0
    for token in tokens:
        shared = [min(start + len(token), b) - max(start, a) for a, b in spans]
        best = max(shared, default=0)
        counts[shared.index(best) if best > 0 else -1] += 1
        start += len(token)
    return counts


def test_allotment_equals_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        tokens = [b"x" * rng.randint(1, 5) for _ in range(rng.randint(0, 30))]
        cuts = sorted(rng.randint(0, 80) for _ in range(2 * rng.randint(0, 6)))
        spans = list(zip(cuts[::2], cuts[1::2], strict=True))
        ends = np.cumsum([len(t) for t in tokens]).astype(np.int64)
        owner, crossing = tokencount.allot(ends, *(np.array([s[k] for s in spans], np.int64) for k in (0, 1)))
        got = np.bincount(owner + 1, minlength=len(spans) + 1).tolist()
        assert got[1:] + got[:1] == brute(tokens, spans)
        for end, token, own, cross in zip(ends, tokens, owner, crossing, strict=True):
            inside = own >= 0 and spans[own][0] <= end - len(token) and end <= spans[own][1]
            assert cross == (own >= 0 and not inside)


def test_fields_and_odd_rows(spark, reference):
    rows = [("title", "some body text", 1), (None, "é" * 50, 2), ("", None, 3), ("a", "b " * 9000, 4), ("title", "some body text", 1)]
    text, sections = tokencount.fields([F.col("title"), F.col("body")], " ")
    df = spark.createDataFrame(rows, "title string, body string, N_TOKENS int").select("title", "N_TOKENS", text.alias("text"), sections.alias("sections"))
    out = tokencount.attribute(df, queries.RANK_FILE, PATTERN)
    assert out.columns == ["title", "text", "counts", "n_tokens"]
    for r in out.collect():
        tokens = [reference.decode_single_token_bytes(t) for t in reference.encode_ordinary(r.text)]
        edge = len((r.title or "").encode())
        want = brute(tokens, [(0, edge), (edge + 1, len(r.text.encode()))])
        assert [c.n_tokens for c in r.counts] == want and r.n_tokens == sum(want) == len(tokens)
        assert [c.section for c in r.counts] == [0, 1, None]
    none = spark.createDataFrame([("x y", None), (None, None), ("", [])], f"text string, sections {tokencount.SPANS}")
    assert [[c.n_tokens for c in r.counts] for r in tokencount.attribute(none, queries.RANK_FILE, PATTERN).collect()] == [[2], [0], [0]]
    assert tokencount.attribute(none.limit(0), queries.RANK_FILE, PATTERN).count() == 0


def test_query_over_all_documents(spark, reference):
    got = {}
    for r in queries.op5_token_counts(spark, SF).collect():
        got.setdefault(r.doc_id, {})[r.line] = (r.n_tokens, r.n_bytes)
    documents = queries.table(spark, SF, "documents").collect()
    assert set(got) == {d.doc_id for d in documents}
    for d in documents:
        tokens = [reference.decode_single_token_bytes(t) for t in reference.encode_ordinary(d.text or "")]
        spans, start = [], 0
        for line in (d.text or "").encode().split(b"\n") if d.text else []:
            spans.append((start, start + len(line)))
            start += len(line) + 1
        want = brute(tokens, spans)
        assert {k: v[0] for k, v in got[d.doc_id].items()} == dict(zip([*range(len(spans)), None], want, strict=True))
        assert sum(v[1] for v in got[d.doc_id].values()) == len((d.text or "").encode())
