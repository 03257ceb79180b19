import random
import re

import pytest

from conftest import SF
from reviewmill.llm import queries, urlfilter

CASES = [
    (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("www.cheap-pills.example.com/x", "", "", None, "block"),
    ("http://A.Example.NET/en/x?y#z", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/EN/x", "example.net", "/EN/x", "net/", "block"),
    ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"), ("http://net/", "net", "/", "net/", "block"),
    ("http://x.net", "x.net", "", None, "allow"), ("http://x.net?a/b", "x.net", "", None, "allow"), ("http://x.net#/", "x.net", "", None, "allow"),
    ("https://a.example.com/de/1", "a.example.com", "/de/1", "example.com/de/", "block"),
    ("https://spam-farm.example.org/fr/1", "spam-farm.example.org", "/fr/1", "org/fr/", "allow"),
    ("https://www.cheap-pills.example.com/en/1", "www.cheap-pills.example.com", "/en/1", None, "block"),
    ("https://ü.example.com/ads?x=1", "ü.example.com", "/ads", None, "block"), ("https://e.com/loads/", "e.com", "/loads/", None, "allow"),
    ("https://e.com/ads/health/", "e.com", "/ads/health/", None, "allow"), ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("x://" + "a." * 3000 + "net/" + "p" * 20000, "a." * 3000 + "net", "/" + "p" * 20000, "net/", "block"),
]


def test_host_rules_are_those_of_the_contract(spark):
    assert urlfilter.HOST_RULES == {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    urls = ["http://a.net/x", "http://a.example.net/en/x", "http://example.com/de/x", "http://a.org/fr/x"]
    out = urlfilter.judge(spark.createDataFrame([(u,) for u in urls], "url string")).select("url", "rule", "verdict").collect()
    assert {tuple(r) for r in out} == {
        (urls[0], "net/", "block"), (urls[1], "example.net/en/", "allow"), (urls[2], "example.com/de/", "block"), (urls[3], "org/fr/", "allow")}


def test_cases(spark):
    df = spark.createDataFrame([(n, c[0], "x") for n, c in enumerate(CASES + CASES[:3])], "page_id long, url string, HOST string")
    out = urlfilter.judge(df)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "n_tried"]
    got = {r.page_id: (r.url, r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert [got[n] for n in range(len(CASES) + 3)] == CASES + CASES[:3]
    assert urlfilter.judge(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_what_all_expressions_find(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("ab1") for _ in range(rng.randint(1, 3)))
    patterns = {}
    for _ in range(150):
        pattern = rng.choice(["", "^"]) + rng.choice("./-^*_").join(word() for _ in range(rng.randint(1, 3))) + rng.choice(["", "^", "*", "."])
        patterns[pattern] = rng.choice(["allow", "block", "block"])
    rules = urlfilter.file_rules(patterns, {word(): rng.randint(1, 9) for _ in range(9)})
    for _ in range(400):
        url = "http://" + rng.choice(".-").join(word() for _ in range(3)) + "".join(rng.choice("/?_.%") + word() for _ in range(4))
        hits = {v for p, v in patterns.items() if re.search(urlfilter.expression(p), url)}
        assert rules.verdict(url)[0] == ("block" if hits == {"block"} else "allow")


def test_rules_are_filed_under_the_rarest_token(spark):
    df = spark.createDataFrame([("http://a.com/x/y",), ("http://a.com/x",), (None,)], "url string")
    counts = urlfilter.token_counts(df, ["x", "y", "com", "q"])
    assert counts == {"x": 2, "y": 1, "com": 2}
    assert list(urlfilter.file_rules({"^x^y^": "block"}, counts).filed) == ["y"]
    with pytest.raises(ValueError):
        urlfilter.judge(df, hosts=dict.fromkeys((f"h{n}/" for n in range(urlfilter.MOST_RULES + 1)), "block"))


def test_few_expressions_run(spark):
    pages = queries.table(spark, SF, "pages")
    out = urlfilter.judge(pages).agg({"n_tried": "avg"}).first()[0]
    assert out < len(urlfilter.PATTERN_RULES) / 5
