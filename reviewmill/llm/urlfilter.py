"""URL filters: pattern rules found through their rarest literal token.

Method: a rule holds a regular expression. Its literal tokens, runs of letters and digits that every match must contain as a
whole token, are looked up in the token counts of all URLs, and the rule is filed under the rarest one. A URL is cut
into tokens, the tokens fetch the rules filed under them, and only those run their expressions. Rules without a literal
token are filed under none and run on every URL.

Two kinds of rules decide. Host rules (``example.net/en/`` with allow or block) fit a host, its subdomains and paths that begin with
theirs; the longest fitting one wins. Where none fits, the pattern rules decide: an allowing match beats a blocking one, and a URL
without any match is allowed.

Rules are settings, not data: at most ``MOST_RULES`` travel with the tasks, more raise an error.

Defined cases: a null URL, or one without ``://``, has an empty host and path, no rule and the verdict allow unless a pattern matches.
Of host rules of equal length the blocking one wins. Every row is judged by itself. Further columns pass through; clashing names
give way to the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import add_columns

MOST_RULES = 500_000
TOKEN = re.compile(r"[a-z0-9]+")

# The host rules of the contract.
HOST_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

# Pattern rules, each with its verdict. "^" stands for a border: no letter, digit, "-", "_", "." or "%".
PATTERN_RULES = {
    "spam-farm.": "block", "cheap-pills.": "block", "free-bets.": "block", "adult-x.": "block", "^casino^": "block",
    "^porn^": "block", "^xxx^": "block", "^viagra^": "block", "^warez^": "block", "^torrent^": "block", "^ads^": "block", "^adserver^": "block",
    "^popunder^": "block", "^doubleclick^": "block", "^clickbait^": "block", "^phishing^": "block", "^malware^": "block",
    "^payday-loans^": "block", "^replica-watches^": "block", "^adult^": "block", "^escort^": "block", "^education^": "allow", "^health^": "allow",
}


def expression(pattern: str) -> str:
    """Regular expression of a pattern: ``^`` is a border, ``*`` is anything, all else is literal (letters without case)."""
    parts = {"^": "(?:^|$|[^a-z0-9_.%-])", "*": ".*"}
    body = "".join(parts.get(sign, re.escape(sign)) for sign in pattern.lower())
    return body if pattern[:1] in ("^", "*", "") else "(?:^|[^a-z0-9_%-])" + body


def literals(pattern: str) -> list[str]:
    """Tokens that stand whole in every match: both their neighbours are signs that belong to no token."""
    lowered = pattern.lower()
    found = []
    for match in TOKEN.finditer(lowered):
        before, after = lowered[:match.start()][-1:], lowered[match.end():][:1]
        if before != "*" and after not in ("", "*"):
            found.append(match[0])
    return found


@dataclass
class Rules:
    """Compiled pattern rules, by the literal token under which each is filed."""

    filed: dict[str, list[tuple[re.Pattern, str]]]
    unfiled: list[tuple[re.Pattern, str]]

    def verdict(self, url: str) -> tuple[str, int]:
        """Verdict and the number of expressions that ran."""
        lowered = url.lower()
        candidates = [rule for token in dict.fromkeys(TOKEN.findall(lowered)) for rule in self.filed.get(token, ())] + self.unfiled
        hits = {verdict for pattern, verdict in candidates if pattern.search(lowered)}
        return "block" if hits == {"block"} else "allow", len(candidates)


def token_counts(urls: DataFrame, tokens: Iterable[str], url: str = "url") -> dict[str, int]:
    """How many URLs hold each of the given tokens; counted over all URLs, one row per token and task is shuffled."""
    wanted = sorted(set(tokens))
    if not wanted:
        return {}
    parts = F.array_distinct(F.regexp_extract_all(F.lower(F.col(url)), F.lit("([a-z0-9]+)"), F.lit(1)))
    spread = urls.select(F.explode(F.array_intersect(parts, F.lit(wanted))).alias("token"))
    return {r.token: r.n for r in spread.groupBy("token").agg(F.count("*").alias("n")).collect()}


def file_rules(patterns: dict[str, str], counts: dict[str, int]) -> Rules:
    """File each rule under its rarest literal token; of equally rare ones the longer, then the smaller, is taken."""
    if len(patterns) > MOST_RULES:
        raise ValueError(f"{len(patterns)} rules; at most {MOST_RULES} can travel with a task")
    rules = Rules({}, [])
    for pattern, verdict in patterns.items():
        compiled, tokens = (re.compile(expression(pattern)), verdict), literals(pattern)
        if tokens:
            rarest = min(tokens, key=lambda token: (counts.get(token, 0), -len(token), token))
            rules.filed.setdefault(rarest, []).append(compiled)
        else:
            rules.unfiled.append(compiled)
    return rules


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host without capital A-Z, the path up to a query or fragment."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((at for at in map(rest.find, "/?#") if at >= 0), default=len(rest))
    path = rest[end:] if rest[end:end + 1] == "/" else ""
    return re.sub("[A-Z]+", lambda m: m[0].lower(), rest[:end]), re.split("[?#]", path)[0]


def judge(urls: DataFrame, url: str = "url", hosts: dict[str, str] | None = None, patterns: dict[str, str] | None = None) -> DataFrame:
    """Append host, path, rule (the host rule that decided, else null), verdict and the number of expressions run."""
    hosts = HOST_RULES if hosts is None else hosts
    patterns = PATTERN_RULES if patterns is None else patterns
    if len(hosts) > MOST_RULES:
        raise ValueError(f"{len(hosts)} rules; at most {MOST_RULES} can travel with a task")
    by_parts = {(name[:name.index("/")], name[name.index("/"):]): verdict for name, verdict in hosts.items()}
    lengths = sorted({len(path) for _, path in by_parts})
    filed = file_rules(patterns, token_counts(urls, [t for p in patterns for t in literals(p)], url))

    def find(host: str, path: str) -> str | None:
        labels = host.split(".")
        fitting = [
            (len(domain) + n, by_parts[domain, path[:n]] == "block", domain + path[:n])
            for domain in (".".join(labels[at:]) for at in range(len(labels)))
            for n in lengths if n <= len(path) and (domain, path[:n]) in by_parts
        ]
        return max(fitting)[2] if fitting else None

    def compute(columns: list[list]) -> list:
        out: list[list] = [[], [], [], [], []]
        for value in columns[0]:
            host, path = split_url(value)
            rule = find(host, path)
            verdict, tried = (hosts[rule], 0) if rule else filed.verdict(value or "")
            for column, item in zip(out, (host, path, rule, verdict, tried), strict=True):
                column.append(item)
        return out

    return add_columns(urls, [url], "host string, path string, rule string, verdict string, n_tried int", compute, rows=4096)
