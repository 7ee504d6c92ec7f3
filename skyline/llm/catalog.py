"""The queries of the training-data operators, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyline.llm import (
    decontamination, exact_dedup, hmm, language_id, line_rules, mixing, order_minhash, prefix_trie, quality_ranker, secret_scan, spelling,
    toxicity, url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]

#: The rules of the url query.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def _domain() -> Column:
    """Sources in four domains by number."""
    number = F.regexp_extract("source", "([0-9]+)$", 1)
    place = F.when(number != "", F.try_element_at(F.array(*map(F.lit, ("web", "books", "papers", "code"))), F.pmod(number.cast("int"), F.lit(4)) + 1))
    return F.coalesce(place, F.lit("other"))


def production_mix() -> mixing.Mix:
    return mixing.Mix(
        domain=_domain(),
        domain_weights={"web": 40, "books": 30, "papers": 20, "code": 8, "other": 2},
        lang_weights={"en": 50, "de": 20, "fr": 20, "es": 10},
    )


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def op1_hidden_markov_model(spark: SparkSession, root: str) -> DataFrame:
    return hmm.score(table(spark, root, "documents"))


def op2_source_mixing(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mixed(docs, production_mix()).drop("text")


def op3_string_tiling(spark: SparkSession, root: str) -> DataFrame:
    return decontamination.contaminated(table(spark, root, "documents"), table(spark, root, "benchmark"))


def op4_quality_ranking(spark: SparkSession, root: str) -> DataFrame:
    return quality_ranker.score(table(spark, root, "documents"), table(spark, root, "labels"))


def op5_language_id(spark: SparkSession, root: str) -> DataFrame:
    return language_id.identify(table(spark, root, "documents"))


def op6_toxicity(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.score(table(spark, root, "documents"), table(spark, root, "labels"))


def op7_url_filter(spark: SparkSession, root: str) -> DataFrame:
    return url_filter.judge(table(spark, root, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    found = secret_scan.scan(table(spark, root, "documents"))
    spans = F.coalesce("spans", F.array().cast("array<struct<begin:bigint,place:bigint,kind:string,end:bigint>>"))
    base = F.filter("spans", lambda x: x["place"] <= 3)
    joined = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["begin"].cast("string"), x["end"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")
    return found.select("doc_id", spans.alias("spans")).select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def op9_line_rules(spark: SparkSession, root: str) -> DataFrame:
    return line_rules.clean(table(spark, root, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars"
    )


def op10_order_minhash(spark: SparkSession, root: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, root, "documents"))


def op11_prefix_trie(spark: SparkSession, root: str) -> DataFrame:
    return prefix_trie.trie(table(spark, root, "conversations"))


def op12_exact_dedup(spark: SparkSession, root: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, root, "documents"), digests=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op13_spelling_variants(spark: SparkSession, root: str) -> DataFrame:
    return spelling.variants(table(spark, root, "documents"))


# Budgets by the same rules, level by level; then the running sum of tokens in each leaf's order.
OP2_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens,
    coalesce(['web', 'books', 'papers', 'code'][try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS INT) % 4 + 1], 'other') AS domain
  FROM documents
), leaf AS (
  SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * 2 AS room, 1::HUGEINT AS weight
  FROM docs GROUP BY ALL
), d0 AS (
  SELECT domain, sum(room)::HUGEINT AS room,
    (CASE domain WHEN 'web' THEN 40 WHEN 'books' THEN 30 WHEN 'papers' THEN 20 WHEN 'code' THEN 8 ELSE 2 END)::HUGEINT AS weight,
    (SELECT sum(tokens)::HUGEINT * 80 // 100 FROM leaf) AS budget
  FROM leaf GROUP BY domain
), d1 AS (
  SELECT *, room * sum(weight) OVER (ORDER BY room / weight, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= greatest(budget - coalesce(sum(room) OVER (ORDER BY room / weight, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) * weight AS is_full
  FROM d0
), d2 AS (
  SELECT domain, CASE WHEN is_full THEN room ELSE (budget - coalesce(sum(room) FILTER (is_full) OVER (), 0)) * weight // sum(weight) FILTER (NOT is_full) OVER () END::HUGEINT AS budget
  FROM d1
), l0 AS (
  SELECT domain, lang, sum(room)::HUGEINT AS room, (CASE lang WHEN 'en' THEN 50 WHEN 'de' THEN 20 WHEN 'fr' THEN 20 WHEN 'es' THEN 10 ELSE 1 END)::HUGEINT AS weight, any_value(budget) AS budget
  FROM leaf JOIN d2 USING (domain) GROUP BY domain, lang
), l1 AS (
  SELECT *, room * sum(weight) OVER (PARTITION BY domain ORDER BY room / weight, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= greatest(budget - coalesce(sum(room) OVER (PARTITION BY domain ORDER BY room / weight, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) * weight AS is_full
  FROM l0
), l2 AS (
  SELECT domain, lang, CASE WHEN is_full THEN room ELSE (budget - coalesce(sum(room) FILTER (is_full) OVER (PARTITION BY domain), 0)) * weight // sum(weight) FILTER (NOT is_full) OVER (PARTITION BY domain) END::HUGEINT AS budget
  FROM l1
), s1 AS (
  SELECT domain, lang, source, tokens, room, weight, budget,
    room * sum(weight) OVER (PARTITION BY domain, lang ORDER BY room / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= greatest(budget - coalesce(sum(room) OVER (PARTITION BY domain, lang ORDER BY room / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) * weight AS is_full
  FROM leaf JOIN l2 USING (domain, lang)
), s2 AS (
  SELECT domain, lang, source, tokens,
    CASE WHEN is_full THEN room ELSE (budget - coalesce(sum(room) FILTER (is_full) OVER (PARTITION BY domain, lang), 0)) * weight // sum(weight) FILTER (NOT is_full) OVER (PARTITION BY domain, lang) END::HUGEINT AS budget
  FROM s1
), plan AS (
  SELECT *, coalesce(budget // nullif(tokens, 0), 0) AS epochs, budget - coalesce(budget // nullif(tokens, 0), 0) * tokens AS rest FROM s2
), ranked AS (
  SELECT d.*, epochs, rest, sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source ORDER BY md5('7|' || epochs || '|' || coalesce(doc_id::VARCHAR, '')) RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM docs d JOIN plan p ON d.domain = p.domain AND d.lang = p.lang AND d.source = p.source
)
SELECT doc_id, lang, source, domain, n_tokens, (epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM ranked WHERE epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END > 0
"""

# Aliases by a recursive walk over links; the spelling of a url is folded as in the operator.
OP7_SQL = r"""
WITH RECURSIVE parts AS (
  SELECT page_id, url, html, instr(coalesce(url, ''), '://') > 0 AS has,
    CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), seen AS (
  SELECT page_id, url, html, has, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&', '') AS query
  FROM parts
), ruled AS (
  SELECT *, CASE WHEN has THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS node,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM seen
), decided AS (
  SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS action FROM ruled
), targets AS (
  SELECT node AS a, regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS target FROM decided
  UNION ALL SELECT node, regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?i)\burl\s*=\s*([^"''\s>;]+)', 1) FROM decided
), aimed AS (
  SELECT a, target, substr(target, instr(target, '://') + 3) AS rest FROM targets WHERE a IS NOT NULL AND instr(target, '://') > 0
), split AS (
  SELECT a, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&', '') AS query FROM aimed
), links AS (
  SELECT a, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS b FROM split
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT DISTINCT node AS origin, node AS other FROM decided WHERE node IS NOT NULL
  UNION SELECT r.origin, e.b FROM reach r JOIN both_ways e ON r.other = e.a
), inherited AS (
  SELECT origin, min(action) AS decision FROM reach JOIN decided ON other = node WHERE action IS NOT NULL GROUP BY origin
)
SELECT page_id, host, path, rule, coalesce(action, decision, 'allow') AS verdict FROM decided LEFT JOIN inherited ON node = origin
"""


# crc32 by its table of 256 remainders, byte by byte.
CRC = r"""
crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, k: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END), i)) AS remainders)
"""
CRC_OF = "xor(list_reduce({bytes}, lambda a, x: xor(a >> 8, remainders[xor(a, x) % 256 + 1]), 4294967295), 4294967295)"

# Prefixes as lists; each node's conversation leads through all nodes above it.
OP11_SQL = rf"""
WITH {CRC}, placed AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, count(*) AS own, {CRC_OF.format(bytes="list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 4 AS h FROM placed, crc GROUP BY c, remainders
), sizes AS (
  SELECT a.c, a.h, a.c - a.c % 20 AS base, least(a.h, coalesce(b.own, 0)) AS taken, least(a.h, coalesce(b.own, 0)) + greatest(a.own - a.h, 0) AS size
  FROM convs a LEFT JOIN convs b ON b.c = a.c - a.c % 20
), turn_rows AS (
  SELECT s.c, p.place AS depth, role, text, size FROM sizes s JOIN placed p ON p.c = s.base AND p.place <= taken
  UNION ALL SELECT s.c, p.place - h + taken, role, text, size FROM sizes s JOIN placed p ON p.c = s.c AND p.place > h
), steps AS (
  SELECT c, depth, size, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    list(md5(len(role) || ':' || role || text)) OVER (PARTITION BY c ORDER BY depth) AS key FROM turn_rows
  UNION ALL SELECT c, 0, size, 0, CAST([] AS VARCHAR[]) FROM sizes
), nodes AS (
  SELECT key, min(c) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(words) AS words,
    string_agg(CASE WHEN depth = size THEN c::VARCHAR END, ',' ORDER BY c) AS ends FROM steps GROUP BY key
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.key AS parent FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.key = n.key[:n.depth - 1]
), children AS (
  SELECT parent AS key, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent
), counted AS (
  SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (key)
), subtrees AS (
  SELECT s.key, sum((n.n_convs - 1) * n.words) AS saved_tokens, count(*) FILTER (n.n_children = 0) AS n_leaves
  FROM counted n JOIN steps s ON s.c = n.conv_id AND s.depth <= n.depth GROUP BY s.key
)
SELECT conv_id::BIGINT AS conv_id, depth::BIGINT AS depth, parent_conv_id::BIGINT AS parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM counted JOIN subtrees USING (key)
"""

OP12_SQL = r"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256, row_number() OVER () AS place FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST, place) = 1 AS kept, text_sha256
FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""

# One code point taken out of every place: equal rests at one place are replacements, a rest that is a word is a deletion.
OP13_SQL = rf"""
WITH RECURSIVE {CRC}, runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
), hashed AS (
  SELECT run, times, {CRC_OF.format(bytes="list_transform(range(octet_length(encode(coalesce(doc_id::VARCHAR, '') || ':' || run))), lambda k: ('0x' || hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run))[2 * k + 1:2 * k + 2])::BIGINT)")} AS h
  FROM runs, crc
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:(h % len(run))::BIGINT] || run[(h % len(run))::BIGINT + 2:] ELSE run END AS word, sum(times)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING len(word) >= 5 AND n >= 3
), cuts AS (
  SELECT word, n, k, word[:k] || word[k + 2:] AS rest FROM (SELECT word, n, unnest(range(len(word))) AS k FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b USING (k, rest) WHERE a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM near GROUP BY word
), formed AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, form, 0 AS step FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT walk.word, f.form, step + 1 FROM walk JOIN formed f ON f.word = walk.form WHERE f.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(form, step) AS root FROM walk GROUP BY word
)
SELECT word, form, coalesce(root, word) AS root, n, n_near::BIGINT AS n_near, form_n FROM formed LEFT JOIN roots USING (word)
"""


def load() -> tuple[dict[str, Query], dict[str, str]]:
    queries = (
        op1_hidden_markov_model, op2_source_mixing, op3_string_tiling, op4_quality_ranking, op5_language_id,
        op6_toxicity, op7_url_filter, op8_secret_scan, op9_line_rules, op10_order_minhash, op11_prefix_trie, op12_exact_dedup,
        op13_spelling_variants,
    )
    sql = {
        "op2_source_mixing": OP2_SQL, "op7_url_filter": OP7_SQL, "op11_prefix_trie": OP11_SQL, "op12_exact_dedup": OP12_SQL,
        "op13_spelling_variants": OP13_SQL,
    }
    return {q.__name__: q for q in queries}, sql
