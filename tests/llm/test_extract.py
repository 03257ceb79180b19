import html
import re

import pytest

from conftest import SF
from reviewmill.llm import extract, queries

BODY = "A first paragraph of the story, long enough to matter to anyone."
PAGES = {
    "http://a.com/1": (f"<nav><ul><li><a href=x>Home</a><li>News</ul></nav><article><h1>One &amp; only</h1><p>{BODY}<p>Second</article>"
                       "<aside>Side</aside><footer>&copy; a</footer>", f"One & only {BODY} Second"),
    "http://a.com/2": ("<header>Top</header><article class=post><h1>Two</h1><p>x<br>y&nbsp;&#x41; <b>bo</b>ld</p><form><input><label>Mail</label>"
                       "</form><div class='share-buttons'>Share</div><ul><li>i<li>ii</ul><section id=comments><p>Nice!</p></section></article>",
                       "Two x y A bold i ii"),
    "http://a.com/3": ("<script>if (a < b) '<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><div class=cookie-notice>Yes?</div>"
                       "<article><p>Unclosed &am <i>text", "Unclosed &am text"),
    "http://a.com/4": ("<div class=ad>Buy</div><div><p>no article here</p></div>", "no article here"),
    "http://b.com/1": (f"<div class=menu><p>Home</p></div><main><p>{BODY}</p></main><div id='sidebar'><p>{BODY}</p></div>", BODY),
    "http://c.com/1": (f"<div><a href=1>one</a> <a href=2>two</a></div><div class='entry-content'><p>{BODY}</p><blockquote>Q</blockquote></div>", f"{BODY} Q"),
    "http://d.com/1": (f"<body class='has-sidebar'><table><tr><td>{BODY}<td>more</table></body>", f"{BODY} more"),
    "http://e.com/1": ("", ""), "http://e.com/2": (None, ""), "http://e.com/3": ("<nav>x</nav>", ""), "http://e.com/4": ("just text", "just text"),
}


def test_pages(spark):
    rows = [(n, url, page, "old", "h") for n, (url, (page, _)) in enumerate([*PAGES.items(), *PAGES.items()])]
    rows += [(100, None, "<article>no url</article>", "", ""), (101, "no-host", "<article><p>a</p></article>", "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string")
    out = extract.extract(df)
    assert out.columns == ["page_id", "url", "html", "host", "text", "n_chars"]
    got = {r.page_id: r for r in out.collect()}
    want = [w for _, w in PAGES.values()]
    assert [got[n].text for n in range(2 * len(want))] == want * 2
    assert (got[100].text, got[101].text) == ("no url", "a") and all(r.n_chars == len(r.text) and r.host in "h" for r in got.values())
    assert extract.extract(df.limit(0)).count() == 0


def test_wrapper_is_a_regular_expression_without_unions():
    def fold(*pages):
        made = [extract.wrapper_of(extract.parse(p)) for p in pages]
        for other in made[1:]:
            made[0] = extract.merge(made[0], other)
        return extract.expression(made[0])

    assert fold("<ul><li>a<li>b</ul>") == "<html><ul>(<li>#</li>)+</ul></html>"
    assert fold("<h1>x</h1><p>a</p>", "<h1>x</h1><p>b</p><div>c</div>") == "<html><h1>x</h1><p>#</p>(<div>c</div>)?</html>"
    assert fold("<p>a</p><h2>t</h2><p>a</p>", "<p>a</p>") == "<html><p>a</p>(<h2>t</h2>)?(<p>a</p>)?</html>"
    many = "".join(f"<h2>{n}</h2><p>{n}</p>" for n in range(40))
    assert fold(many) == fold(many, "<p>x</p>") == "<html>((<h2>#</h2>)?(<p>#</p>)?)+</html>"


@pytest.mark.parametrize("limit", [extract.BROADCAST_BYTES, 0])
def test_query_over_all_pages(spark, monkeypatch, limit):
    monkeypatch.setattr(extract, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(extract, "FOLD", 2)
    pages = {r.page_id: r for r in queries.table(spark, SF, "pages").collect()}
    got = queries.op3_main_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
        want = " ".join(" ".join(html.unescape(block).split()) for block in blocks if block.strip())
        assert (r.text, r.n_chars, r.url) == (want, len(want), pages[r.page_id].url)


def test_long_page(spark):
    page = "<article>" + "<p>word</p>" * 30_000 + "</article>" + "<div>" * 300 + "x"
    df = spark.createDataFrame([(1, "http://a.com/", page)], "page_id long, url string, html string")
    assert extract.extract(df).first().n_chars == 30_000 * 5 - 1


def test_deep_markup_keeps_its_texts(spark):
    deep = "<div>" * 5000
    pages = [deep + "<p>one</p><p>two</p>" + "</div>" * 5000, "<section class=x>" * 3000 + "<article><p>four</p><nav>no</nav><p>five</p></article>",
             "<article>" + "".join(f"<div>{n}" for n in range(1200)), "<ul><li>" * 2000 + "<nav><ul><li>no</ul></nav>yes", "<article><p>shallow</p></article>"]
    df = spark.createDataFrame([(n, f"http://h{n}.com/", page) for n, page in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract.extract(df).collect()}
    assert got == {0: "one two", 1: "four five", 2: " ".join(map(str, range(1200))), 3: "yes", 4: "shallow"}
