"""Main text of HTML pages by wrappers that are inferred from all pages of a host.

Method: a page becomes a well-formed stream of block tags and texts. A wrapper is a regular expression without unions over such
streams: tags, constant texts, text slots, optional groups ``( )?`` and repeated groups ``( )+``. It starts as the first page of a
host and is aligned with one page after another. Equal neighbours become a repeated group; what only one side has becomes
optional; texts that differ become a slot; where a list of children keeps growing it becomes a repeated group of optional parts.
Wrappers are merged in the same way, so every task folds the pages it reads and the folds of all tasks are folded again,
first in buckets, then by host: a host with a third of all pages costs one small row per task.

The wrapper decides for a host which of its parts are the article: the outermost ``article``; without one ``main``, then a block
that calls itself content, then the block whose slots hold most text outside links, counted over all pages of the host.
Inside it menus, headers, footers, sidebars, notices, adverts, forms and reader comments are left out, known by tag,
role or class. A page is read along its wrapper, and the texts of the chosen parts are returned in page order.

Defined cases: null or empty html gives an empty text. Pages without a host share one wrapper. A page without any article part gives an empty
text; broken and unclosed markup is repaired (a paragraph ends where a block begins, missing end tags are added). Repeated rows
get equal results; further columns pass through, clashing names give way to the result.
"""

from __future__ import annotations

import html as references
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import add_columns, free_name, slices
from reviewmill.session import publish

#: Children of one element beyond which they are described as a repeated group of optional parts.
LONGEST_LIST = 24
#: Wrappers of all hosts together are broadcast up to this size, and joined by host beyond.
BROADCAST_BYTES = 8_000_000
#: Wrappers folded in one group before the last fold, and hosts a task holds at once.
FOLD, HOSTS_AT_ONCE = 64, 2000
LONGEST_CONSTANT = 200
#: Plain blocks nested deeper than this stand beside each other in the deepest one; marked ones go on so many levels more.
DEEPEST, MARKED_DEEPER = 150, 50

# Elements whose content is no text, elements that stand in a line of text, and end tags that may be missing.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas video audio head title textarea select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meta link input q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"},
}
HOLDERS = frozenset("ul ol dl table section article main div body".split())

# What marks a part as no article text, by element, role, and word in a class or id; and what marks the article.
OUTSIDE_TAGS = frozenset("nav header footer aside form button dialog menu fieldset".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notification alert popup modal overlay paywall newsletter subscribe subscription signup login nav navbar navigation menu "
    "breadcrumb breadcrumbs pagination pager toolbar topbar masthead header footer sidebar aside rail widget related recommended trending "
    "share sharing social comment comments commentlist respond reply replies disqus search copyright".split())
WHOLE_TAGS = frozenset("html body article main".split())
HARMLESS_WORDS = frozenset("has with no without".split())
CONTENT_WORDS = frozenset("content article post entry story text".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>", re.DOTALL)
MARKED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def label(tag: str, attributes: str) -> str:
    """Name of a block in a wrapper: its tag, then ``!`` if it is outside the article, else the first plain word of its class."""
    if tag in OUTSIDE_TAGS:
        return f"{tag}!"
    first = ""
    for kind, value in MARKED.findall(attributes) if attributes else ():
        value = value.strip("\"'")
        words = {word.lower() for word in WORD.findall(value)}
        if kind.lower() == "role":
            if value.lower() in OUTSIDE_ROLES:
                return f"{tag}!"
            if value.lower() in ("main", "article"):
                return value.lower()
        elif tag not in WHOLE_TAGS and words & OUTSIDE_WORDS and not words & HARMLESS_WORDS:
            return f"{tag}!"
        elif not first and words & CONTENT_WORDS:
            first = min(words & CONTENT_WORDS)
    return f"{tag}.{first}" if first and tag not in WHOLE_TAGS else tag


class Block:
    """A block element: its children, blocks and texts, in order. A text is (characters, share of them in links)."""

    __slots__ = ("label", "children")

    def __init__(self, name: str):
        self.label, self.children = name, []


def parse(page: str | None) -> Block:
    """Well-formed tree of the blocks of a page; texts are decoded, white space is single."""
    root = Block("html")
    levels = {id(root): 0}
    stack: list[tuple[str, Block]] = [("html", root)]
    text: list[str] = []
    links = linked = position = 0

    def flush() -> None:
        nonlocal linked
        words = references.unescape("".join(text)).split() if text else ()
        if words:
            stack[-1][1].children.append((" ".join(words), linked))
        text.clear()
        linked = 0

    page = page or ""
    skip_to = 0
    for token in TOKEN.finditer(page):
        if token.start() < skip_to:
            continue
        if token.start() > position:
            piece = page[position:token.start()]
            text.append(piece)
            linked += len(piece) if links else 0
        position = token.end()
        tag = token[2]
        if tag is None:
            if token[0].startswith("<![CDATA["):
                text.append(references.escape(token[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if tag in SKIPPED:
            if not token[1] and not token[0].endswith("/>"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, position)
                position = skip_to = end.end() if end else len(page)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if token[1] else 1
            continue
        flush()
        if tag in ("html", "body"):
            continue
        if token[1]:
            if any(name == tag for name, _ in stack[1:]):
                while stack.pop()[0] != tag:
                    pass
            links = 0
            continue
        while stack[-1][0] == "p":
            stack.pop()
        closed = CLOSES.get(tag)
        if closed:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in closed:
                    del stack[depth:]
                    break
                if stack[depth][0] in HOLDERS:
                    break
        name, parent, level = label(tag, token[3]), stack[-1][1], levels[id(stack[-1][1])]
        if level < DEEPEST or level < DEEPEST + MARKED_DEEPER and (name != tag or tag in ("article", "main")) and not parent.label.endswith("!"):
            block = Block(name)
            levels[id(block)] = level + 1
            parent.children.append(block)
        else:
            block = parent  # its texts are blocks of their own all the same
        if tag not in VOID:
            stack.append((tag, block))
    if len(page) > position:
        text.append(page[position:])
    flush()
    return root


# A wrapper node is a list: label, repeated, optional, text, characters outside links, pages, children. A text is a leaf labelled "#".
LABEL, REPEATED, OPTIONAL, TEXT, MASS, PAGES, CHILDREN = range(7)
GROUP = "()"


def wrapper_of(block: Block | tuple[str, int]) -> list:
    """Wrapper that fits just this block."""
    if isinstance(block, tuple):
        text, linked = block
        return ["#", 0, 0, text if len(text) <= LONGEST_CONSTANT else None, max(0, len(text) - linked), 1, []]
    return [block.label, 0, 0, None, 0, 1, squeeze([wrapper_of(child) for child in block.children])]


def squeeze(nodes: list[list]) -> list[list]:
    """Join equal neighbours into repeated parts; a list that is still too long becomes a repeated group."""
    out: list[list] = []
    for node in nodes:
        if out and out[-1][LABEL] == node[LABEL] != GROUP:
            optional = out[-1][OPTIONAL] and node[OPTIONAL]
            pages = max(out[-1][PAGES], node[PAGES])
            out[-1] = merge(out[-1], node)
            out[-1][REPEATED], out[-1][OPTIONAL], out[-1][PAGES] = 1, optional, pages
        else:
            out.append(node)
    return grouped(out, []) if len(out) > LONGEST_LIST or any(node[LABEL] == GROUP for node in out) and len(out) > 1 else out


def grouped(first: list[list], second: list[list]) -> list[list]:
    """One repeated group of optional parts, one for each label, in the order of their first appearance."""
    parts: dict[str, list] = {}
    pages = 0
    for nodes in (first, second):
        for node in nodes:
            for part in node[CHILDREN] if node[LABEL] == GROUP else [node]:
                known = parts.get(part[LABEL])
                parts[part[LABEL]] = part = merge(known, part) if known else part
                part[OPTIONAL] = 1
        pages += max((node[PAGES] for node in nodes), default=0)
    return [[GROUP, 1, 0, None, 0, pages, list(parts.values())]]


def merge(first: list, second: list) -> list:
    """Wrapper that fits whatever one of two wrappers of the same label fits."""
    return [
        first[LABEL], first[REPEATED] | second[REPEATED], first[OPTIONAL] | second[OPTIONAL],
        first[TEXT] if first[TEXT] == second[TEXT] else None, first[MASS] + second[MASS], first[PAGES] + second[PAGES],
        align(first[CHILDREN], second[CHILDREN]),
    ]


def align(first: list[list], second: list[list]) -> list[list]:
    """Children of both: a longest common subsequence of labels is merged, the others become optional."""
    if any(node[LABEL] == GROUP for node in first) or any(node[LABEL] == GROUP for node in second):
        return grouped(first, second)
    if [node[LABEL] for node in first] == [node[LABEL] for node in second]:
        return [merge(a, b) for a, b in zip(first, second, strict=True)]
    n, m = len(first), len(second)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if first[i][LABEL] == second[j][LABEL] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and first[i][LABEL] == second[j][LABEL]:
            out.append(merge(first[i], second[j]))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append([*first[i][:OPTIONAL], 1, *first[i][OPTIONAL + 1:]])
            i += 1
        else:
            out.append([*second[j][:OPTIONAL], 1, *second[j][OPTIONAL + 1:]])
            j += 1
    return squeeze(out)


def expression(node: list) -> str:
    """The wrapper as a regular expression over tags, texts and slots (#)."""
    inner = "".join(expression(child) for child in node[CHILDREN])
    if node[LABEL] == "#":
        body = references.escape(node[TEXT]) if node[TEXT] is not None else "#"
    else:
        body = inner if node[LABEL] == GROUP else f"<{node[LABEL]}>{inner}</{node[LABEL]}>"
    marks = ("+" if node[REPEATED] else "") + ("?" if node[OPTIONAL] else "")
    return f"({body}){marks}" if marks else body


class Wrapper:
    """A host's wrapper with its choices of article parts, best first."""

    def __init__(self, root: list):
        self.root, self.choices = root, []
        for wanted in (lambda n: n[LABEL] == "article", lambda n: n[LABEL] == "main", lambda n: "." in n[LABEL]):
            found: set[int] = set()
            self._outermost(root, wanted, found)
            if found:
                self.choices.append(found)
        heavy = sorted((pair for pair in self._inside(root) if pair[0]), key=lambda pair: -pair[0])
        self.choices += [{id(node)} for _, node in heavy]

    def _outermost(self, node: list, wanted, found: set[int]) -> None:
        for child in node[CHILDREN]:
            if wanted(child):
                found.add(id(child))
            elif not child[LABEL].endswith("!"):
                self._outermost(child, wanted, found)

    def _inside(self, node: list) -> Iterator[tuple[int, list]]:
        """(text in slots of the node and of its paragraphs, node) for every part outside menus and the like."""
        parts = [part for child in node[CHILDREN] for part in (child[CHILDREN] if child[LABEL] == GROUP else [child])]
        slots = [part for part in parts if part[LABEL] == "#"]
        slots += [leaf for part in parts if not part[LABEL].endswith("!") for leaf in part[CHILDREN] if leaf[LABEL] == "#"]
        yield sum(slot[MASS] for slot in slots if slot[TEXT] is None or slot[PAGES] < 3), node
        for part in parts:
            if part[LABEL] != "#" and not part[LABEL].endswith("!"):
                yield from self._inside(part)

    def read(self, page: Block) -> list[str]:
        """Texts of the best choice that yields any, in page order."""
        for choice in self.choices:
            out: list[str] = []
            self._read(page, self.root, choice, id(self.root) in choice, out)
            if out:
                return out
        return []

    def _read(self, block: Block, node: list, choice: set[int], inside: bool, out: list[str]) -> None:
        parts = [part for child in node[CHILDREN] for part in (child[CHILDREN] if child[LABEL] == GROUP else [child])]
        at = 0
        for child in block.children:
            name = "#" if isinstance(child, tuple) else child.label
            found = next((n for n in (*range(at, len(parts)), *range(at)) if parts[n][LABEL] == name), None)
            if found is None:
                continue
            at = found
            if isinstance(child, tuple):
                if inside:
                    out.append(child[0])
            elif not name.endswith("!"):
                self._read(child, parts[at], choice, inside or id(parts[at]) in choice, out)


def _fold(wrappers: Iterator[str]) -> str:
    folded = None
    for body in wrappers:
        folded = json.loads(body) if folded is None else merge(folded, json.loads(body))
    return json.dumps(folded, ensure_ascii=False, separators=(",", ":"))


def _host() -> str:
    return "lower(regexp_extract(split_part({0}, '://', 2), '^[^/?#]*', 0))"


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper): one wrapper for each host, as JSON, from all its pages."""

    def fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}

        def emit() -> pa.RecordBatch:
            bodies = [json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in known.values()]
            batch = pa.RecordBatch.from_arrays([pa.array(known, pa.string()), pa.array(bodies, pa.string())], names=["host", "wrapper"])
            known.clear()
            return batch

        for piece in slices(batches):
            for host, page in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                own = wrapper_of(parse(page))
                known[host] = merge(known[host], own) if host in known else own
            if len(known) >= HOSTS_AT_ONCE:
                yield emit()
        if known:
            yield emit()

    def fold_group(group: pa.Table) -> pa.Table:
        body = _fold(sorted(group.column("wrapper").to_pylist()))
        return pa.table({"host": pa.array([group.column("host")[0].as_py()], pa.string()), "wrapper": pa.array([body], pa.string())})

    schema = "host string, wrapper string"
    hosts = pages.select(F.coalesce(F.expr(_host().format(f"`{url}`")), F.lit("")).alias("host"), F.col(html))
    folds = publish(hosts.mapInArrow(fold_pages, schema), "folds")
    parts = -(-folds.count() // FOLD) or 1
    bucket = F.pmod(F.xxhash64("wrapper"), F.lit(parts)).cast("int")
    folds = folds.withColumn("bucket", bucket).groupBy("host", "bucket").applyInArrow(fold_group, schema)
    return folds.groupBy("host").applyInArrow(fold_group, schema)


def extract(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Append the main text of every page and its length in code points."""
    wrappers = publish(infer(pages, url, html), "wrappers")
    host, body = free_name(pages.columns, "host"), free_name(pages.columns, "wrapper")
    wrappers = wrappers.select(F.col("host").alias(host), F.col("wrapper").alias(body))
    size = wrappers.agg(F.sum(F.octet_length(body) + F.octet_length(host) + 32)).first()[0] or 0
    rows = pages.withColumn(host, F.coalesce(F.expr(_host().format(f"`{url}`")), F.lit("")))
    rows = rows.join(F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers, host)
    known: dict[str, Wrapper] = {}

    def compute(columns: list[list]) -> list:
        texts = []
        for name, page, wrapper in zip(*columns, strict=True):
            if name not in known:
                if len(known) >= HOSTS_AT_ONCE:
                    known.clear()
                known[name] = Wrapper(json.loads(wrapper))
            texts.append(" ".join(known[name].read(parse(page))))
        return [texts, [len(text) for text in texts]]

    made = add_columns(rows, [host, html, body], f"`{out}` string, `{n_chars}` bigint", compute)
    return made.drop(host, body)
