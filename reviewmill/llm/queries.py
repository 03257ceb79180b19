"""One query for each training-data operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import annforest, bpe, conversations, decontam, extract, langid, linededup, merkle, neardup, sharding, tokencount, toxicity, urlfilter

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text; documents whose digest leaves 1 modulo 3 teach nothing."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = langid.fit(documents.filter(~held_out))
    return langid.predict(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's address."""
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under similarity >= 0.85 of three-word shingles."""
    return neardup.link(table(spark, sf_dir, "documents"), width=3, percent=85)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; the row without a line holds the tokens of line breaks."""
    documents = tokencount.lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counted = tokencount.attribute(documents, RANK_FILE, public_tokenizers.PATTERN).select("doc_id", F.inline("counts"))
    return counted.select("doc_id", F.col("section").alias("line"), *[F.col(n).cast("long").alias(n) for n in ("n_tokens", "n_crossing", "n_bytes")])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least 0.8 of the five-word shingles of a benchmark item."""
    return decontam.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one holds, and the offsets of what was cut and kept."""
    return linededup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows found for every row whose id is divisible by 50."""
    return annforest.knn(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; documents whose digest leaves 0 modulo 5 teach nothing."""
    documents, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = toxicity.fit(documents, labels.filter(~held_out).select("doc_id", "toxic"))
    return toxicity.score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(documents, RANK_FILE, public_tokenizers.PATTERN)
    return bpe.decode(coded, RANK_FILE).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, stripped of full stops, repeated or given to the user, by a checksum of the key."""
    filled = {n: F.coalesce(F.col(n).cast("string"), F.lit(" ")) for n in ("conv_id", "turn", "role", "text")}
    way = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")) % 20
    text = F.when(way == 1, "").when(way == 2, F.translate(filled["text"], ".!?", "")).otherwise(filled["text"])
    copies = F.array_repeat(F.lit(1), F.when(way == 0, 0).when(way == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", F.when(way == 4, "user").otherwise(filled["role"]).alias("role"), text.alias("text"),
                       F.explode(copies).alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and its digest for every conversation, after damage."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversations.summary(conversations.repair(damaged(rows)))
    every = rows.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, "conv", "left").select(
        "conv_id", *[F.coalesce(n, F.lit(0)).alias(n) for n in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document: 40 shards of nearly equal bytes, equal texts together."""
    placed = sharding.assign(table(spark, sf_dir, "documents"), 40, overhead=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; where 7 divides the checksum of the id, a changed row is held against its proof."""
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    documents = table(spark, sf_dir, "documents").select(*names)
    leaf = merkle.digest(*[merkle.field(F.col(n)) for n in names])
    more = merkle.digest(*[merkle.field(F.col(n) + 1 if n == "n_chars" else F.col(n)) for n in names])
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    proven = merkle.manifest(documents, "doc_id", "lang", leaf, F.when(touched, more).otherwise(leaf))
    return proven.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", "").cast("binary"), 256).alias("proof_sha256"),
                         "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_url_filter": op2_url_filter,
    "op3_main_text": op3_main_text,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_token_counts": op5_token_counts,
    "op6_decontamination": op6_decontamination,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_nearest": op8_nearest,
    "op9_toxicity": op9_toxicity,
    "op10_bpe": op10_bpe,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_sharding": op12_sharding,
    "op13_merkle_manifest": op13_merkle_manifest,
}

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _shingle_sql(source: str, key: str, width: int) -> str:
    """(key, s): the distinct shingles of each text; all words as one shingle where there are fewer."""
    return f"""
    SELECT {key}, unnest(list_distinct(CASE WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i:i + {width} - 1], ' ')) END)) AS s
    FROM (SELECT {key}, list_filter(regexp_split_to_array(translate(text, {LETTERS}), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w
          FROM {source} WHERE text IS NOT NULL) WHERE len(w) > 0"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    bit = "lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {byte}), 4294967295)"


def _edit(state: str, cost: str, letter: str, row: str = "''") -> str:
    """A state's (cost, audit, rows) after an edit."""
    return f"{{'c': {state}.c + {cost}, 'p': {state}.p || '{letter}', 'o': {state}.o || {row}}}"


def _repair_sql() -> str:
    """Conversations by a forward programme over four states, each with its least (cost, audit, rows)."""
    far, blanks = "{'c': 1000000, 'p': '', 'o': ''}", "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    start = "{'c': 0, 'p': '', 'o': ''}"
    may = "f.fault NOT IN ('blank', 'duplicate')"
    more = "(CASE WHEN f.fault = 'truncated' THEN 3 ELSE 0 END)"
    kept = "chr(10) || f.role || ':' || f.text"

    def to(old: str, comes: str, initial: str, role: str) -> str:
        keep = f"CASE WHEN {may} AND f.initial = '{initial}' THEN {_edit(comes, more, 'K', kept)} ELSE {far} END"
        if not role:
            return f"least({_edit(old, '4', 'D')}, {keep})"
        rerole = f"CASE WHEN {may} THEN {_edit(comes, f'3 + {more}', 'R', f'{role} || f.text')} ELSE {far} END"
        return f"least({_edit(old, '4', 'D')}, {keep}, {rerole})"

    before_user = "least(z, s, a)"
    return f"""
WITH RECURSIVE filled AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
way AS (SELECT *, {_crc32("k")} % 20 AS m FROM filled),
hurt AS (SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN m = 1 THEN '' WHEN m = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM way, unnest(CASE WHEN m = 0 THEN [] WHEN m = 3 THEN [1, 2] ELSE [1] END) t(copy)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, rtrim(text, {blanks}) AS bare FROM numbered),
fault AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated'
    ELSE '' END AS fault, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier FROM seen),
path AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, {start} AS z, {far} AS s, {_edit(start, '3', 'I', user)} AS u,
    {_edit(start, '6', 'II', f"{user} || {assistant}")} AS a FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL SELECT conv_id, i, z, s, u, least(a, {_edit('u', '3', 'I', assistant)}) AS a FROM (
    SELECT conv_id, i, z, s, least(u, {_edit(before_user, '3', 'I', user)}) AS u, a FROM (
      SELECT p.conv_id, f.i, {_edit('p.z', '4', 'D')} AS z, {to('p.s', 'p.z', 's', '')} AS s,
             {to('p.u', 'least(p.z, p.s, p.a)', 'u', user)} AS u, {to('p.a', 'p.u', 'a', assistant)} AS a
      FROM path p JOIN fault f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1))),
best AS (SELECT conv_id, least(z, a) AS b FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM path) WHERE back = 1),
total AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM fault GROUP BY conv_id)
SELECT b.conv_id, {", ".join(f"CAST(coalesce(t.{n}, 0) AS BIGINT) AS {n}" for n in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
       CAST(b.b.c AS BIGINT) AS cost, b.b.p AS audit, sha256(substr(b.b.o, 2)) AS repaired_sha256
FROM best b LEFT JOIN total t ON t.conv_id IS NOT DISTINCT FROM b.conv_id"""


def _leaf_sql(n_chars: str) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


def _climb_sql(name: str, start: str, nodes: str, end: str, same: str) -> str:
    """A recursive table that carries each row's digest and proof up to the last level of its tree."""
    return f"""{name} AS ({start} UNION ALL
  SELECT w.id, w.lang, w.level + 1, w.i // 2, sha256(CASE WHEN s.h IS NULL THEN w.h WHEN w.i % 2 = 1 THEN s.h || w.h ELSE w.h || s.h END),
         w.proof || coalesce(s.h, '') FROM {name} w JOIN {end} e ON {same.format(t="e")} AND w.level < e.height
  LEFT JOIN {nodes} s ON {same.format(t="s")} AND s.level = w.level AND s.i = xor(w.i, 1))"""


def _values(rows: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join("'" + cell.replace("'", "''") + "'" for cell in row) + ")" for row in rows)


ORACLES: dict[str, str] = {
    "op2_url_filter": f"""
WITH rule(name, host, path, verdict) AS (VALUES {_values(
        [(n, n[:n.index("/")], n[n.index("/"):], v) for n, v in urlfilter.HOST_RULES.items()])}),
pattern(e, verdict) AS (VALUES {_values([(urlfilter.expression(p), v) for p, v in urlfilter.PATTERN_RULES.items()])}),
part AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
page AS (SELECT page_id, url, translate(regexp_extract(r, '^[^/?#]*'), {LETTERS}) AS host, regexp_extract(r, '^[^/?#]*(/[^?#]*)?', 1) AS path
         FROM part),
fit AS (SELECT page_id, max_by(name, length(name)) AS rule, max_by(verdict, length(name)) AS verdict FROM page JOIN rule
        ON (page.host = rule.host OR ends_with(page.host, '.' || rule.host)) AND starts_with(page.path, rule.path) GROUP BY 1),
hit AS (SELECT page_id, bool_and(verdict = 'block') AS bad FROM page JOIN pattern ON regexp_matches(lower(url), e) GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(fit.verdict, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
FROM page LEFT JOIN fit USING (page_id) LEFT JOIN hit USING (page_id)""",
    "op4_near_duplicates": f"""
WITH RECURSIVE shingle AS ({_shingle_sql("documents", "doc_id", 3)}),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
           GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT d.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, r.m AS component_id, d.doc_id = r.m AS kept
FROM documents d LEFT JOIN size USING (doc_id) JOIN (SELECT a, min(b) AS m FROM reach GROUP BY 1) r ON r.a = d.doc_id""",
    "op6_decontamination": f"""
WITH held AS ({_shingle_sql("documents", "doc_id", 5)}), item AS ({_shingle_sql("benchmark", "item_id", 5)}),
size AS (SELECT item_id, count(*) AS n FROM item GROUP BY 1)
SELECT doc_id, item_id, CAST(count(*) AS BIGINT) AS found, CAST(n AS BIGINT) AS n_shingles, count(*) / CAST(n AS DOUBLE) AS containment
FROM held JOIN item USING (s) JOIN size USING (item_id) GROUP BY doc_id, item_id, n HAVING 5 * count(*) >= 4 * n""",
    "op11_conversation_repair": _repair_sql(),
    "op13_merkle_manifest": f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS changed
  FROM documents),
ranked AS (SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS place,
                  count(*) OVER (PARTITION BY lang) AS n FROM leaf),
node AS (SELECT lang, 0 AS level, place AS i, leaf AS h, n FROM ranked UNION ALL
  SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM node WHERE n > 1 GROUP BY lang, level, i // 2, n),
sub AS (SELECT lang, h AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS m
        FROM node WHERE n = 1),
top AS (SELECT 0 AS level, place AS i, subroot AS h, m AS n FROM sub UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, i // 2, n),
whole AS (SELECT h AS root, level AS height FROM top WHERE n = 1),
{_climb_sql("low", "SELECT id, lang, 0 AS level, place AS i, changed AS h, '' AS proof FROM ranked", "node", "sub",
            "{t}.lang IS NOT DISTINCT FROM w.lang")},
{_climb_sql("high", "SELECT l.id, l.lang, 0 AS level, s.place AS i, l.h, l.proof FROM low l JOIN sub s "
            "ON s.lang IS NOT DISTINCT FROM l.lang AND s.height = l.level", "top", "whole", "true")}
SELECT r.doc_id, r.leaf, s.subroot, t.root, sha256(h.proof) AS proof_sha256, h.h AS folded_root, h.h = t.root AS verified
FROM high h JOIN whole t ON h.level = t.height JOIN ranked r USING (id) JOIN sub s ON s.lang IS NOT DISTINCT FROM r.lang""",
}
