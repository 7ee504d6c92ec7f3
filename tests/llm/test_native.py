import hashlib
import random
import re

import pyspark.sql.functions as F
import pytest
from compare import differences
from samples import EDGE_ROWS, text, words

from skyline.llm import catalog, line_rules, secret_scan, url_filter


def _no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|BroadcastNestedLoop", plan)


# urls

RULES = (("block", "bad.org/"), ("allow", "bad.org/ok/"), ("block", "x.com/de/"), ("allow", "x.com/de/"))


def test_rules_and_aliases(spark):
    page = lambda i, url, target=None: (i, url, f'<html><LINK href="{target}" rel="canonical"></html>' if target else "<p>")
    rows = [
        page(1, "http://BAD.org/x"), page(2, "https://sub.bad.org/ok/1"), page(3, "http://notbad.org/"), page(4, "https://x.com/de/a"),
        page(5, "https://other.net/1", "https://bad.org/x?utm_source=a#f"), page(6, "https://third.net/2", "https://other.net/1/"),
        page(7, "https://fourth.net/", "https://bad.org/ok/1"), page(8, None), page(9, "no scheme"), page(10, ""), page(11, "https://www.other.net/1?page=2"),
        (12, "https://fifth.net/a", '<meta http-equiv="refresh" content="0; url=https://third.net/2">'), page(13, "http://bad.org"), (14, "https://lone.net", None),
        page(15, "http://bad.org/ok/1", "https://bad.org/x"), page(5, "https://other.net/1"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("verdict", F.lit("x"))
    df = url_filter.judge(pages, RULES)
    _no_python(df)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in df.collect()}
    assert df.count() == len(rows)
    assert got[1] == ("bad.org", "/x", "bad.org/", "block") and got[2] == ("sub.bad.org", "/ok/1", "bad.org/ok/", "allow")
    assert got[3] == ("notbad.org", "/", None, "allow") and got[4][2:] == ("x.com/de/", "allow")
    assert got[8] == got[9] == got[10] == ("", "", None, "allow") and got[13] == ("bad.org", "", None, "allow") and got[14][3] == "allow"
    # 15 ties the allowed page to the blocked ones: allow goes first
    assert {got[i][3] for i in (5, 6, 7, 12)} == {"allow"}
    less = url_filter.judge(pages.filter("page_id <> 15"), RULES)
    got = {r["page_id"]: r["verdict"] for r in less.collect()}
    assert {got[i] for i in (5, 6, 12)} == {"block"} and got[7] == "allow"


def test_ends_of_links_that_are_no_pages(spark):
    page = lambda i, url, target: (i, url, f'<link rel="canonical" href="{target}">')
    rows = [
        page(1, "https://one.net/", "https://bad.org/gone"), page(2, "http://bad.org/x", "https://bad.org/ok/gone"), page(3, "https://two.net/", "http://bad.org/x"),
        page(4, "https://x.com/a/b?q=1", "/fr/"), page(5, "https://x.com/fr", "//bad.org/y"), page(6, "https://three.net/login", "/go?next=http://bad.org/z"),
        page(7, "https://four.net/a", "mailto:me@bad.org"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    df = url_filter.judge(pages, RULES)
    _no_python(df)
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in df.collect()}
    assert got == {
        1: (None, "block"), 2: ("bad.org/", "block"), 3: (None, "allow"), 4: (None, "block"), 5: (None, "block"), 6: (None, "allow"), 7: (None, "allow"),
    }
    links = spark.createDataFrame([("https://one.net/", "https://bad.org/gone")], "url string, target string")
    assert url_filter.judge(pages.filter("page_id = 1").drop("html"), RULES, links).first()["verdict"] == "block"


def test_targets_are_resolved_as_on_their_page(spark):
    base = "http://a/b/c/d;p?q"
    plain = {
        "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
        "#s": "http://a/b/c/d;p?q#s", ".": "http://a/b/c/", "..": "http://a/b/", "../g": "http://a/b/g", "../../../g": "http://a/g", "http://x/y": "http://x/y", "mailto:x": None,
    }
    rows = spark.createDataFrame([(base, t) for t in plain], "url string, target string")
    got = rows.select("target", url_filter.resolve(F.col("url"), F.col("target")).alias("whole")).collect()
    assert {r["target"]: r["whole"] for r in got} == plain


def test_links_from_elsewhere_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.b/"), (2, "http://bad.org/q")], "page_id bigint, url string")
    links = spark.createDataFrame([("http://bad.org/q", "http://a.b"), (None, "http://a.b"), ("/relative", "http://a.b")], "url string, target string")
    assert {r["verdict"] for r in url_filter.judge(pages, RULES, links).collect()} == {"block"}
    assert url_filter.judge(pages.filter("false"), RULES).count() == 0


@pytest.mark.parametrize("name", sorted(catalog.load()[1]))
def test_matches_sql(name, spark, root, duck):
    queries, sql = catalog.load()
    assert differences(queries[name](spark, root), sql[name], duck) == []


# secrets

def _base(value):
    found = []
    for place, (kind, pattern) in enumerate((("assign", secret_scan.ASSIGN), ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+"))):
        for m in re.finditer(pattern, value, re.A):
            if {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}[kind](m):
                found.append((m.start(), place, kind, m.end()))
    return sorted(found)


def _samples():
    rng = random.Random(1)
    bits = ["password = hunter22", 'API_KEY: "abc.def/ghi"', "token:x", "secret=token=abcdef1", "password: token: abcdefgh", "AKIA" + "Q" * 16, "AKIAQQ", "AKIA" + "Z9" * 6,
            "deadbeef" * 3, "0123456789abcdef0", "é😀", "user=bob", "https://host.example/x", "10.1.2.3", "server: db.local", "Passwd='qwertyuiop'", "f" * 23, "\n"]
    return [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(120)] + bits


def test_base_spans_match_a_plain_scan(docs):
    rows = list(enumerate(_samples())) + [(*r[:1], r[1]) for r in EDGE_ROWS]
    df = secret_scan.scan(docs(rows, spans=F.lit(1), kind=F.lit("x"), digest=F.lit(2)))
    _no_python(df)
    got = df.collect()
    assert len(got) == len(rows)
    plain = {}
    for i, t in rows:
        plain.setdefault(i, []).append(_base(t or ""))
    for r in got:
        assert [(s["begin"], s["place"] - 1, s["kind"], s["end"]) for s in r["spans"] or [] if s["place"] <= 3] in plain[r["doc_id"]]


def test_weak_spans_need_a_complement(docs):
    far = " filler" * 60
    rows = [
        (1, "user=bob and password=hunter22"), (2, "user=bob only"), (3, "user=bob" + far + " password=hunter22"), (4, "10.1.2.3 with token=abcdef1"),
        (5, "10.1.2.3 and user=bob"), (6, "pwd=qwertyu at https://db.example"), (7, "pwd=qwertyu alone"), (8, "api_key=abcdefgh near user=bob"), (8, "api_key=abcdefgh near user=bob"),
    ]
    got = {r["doc_id"]: [s["kind"] for s in r["spans"] or []] for r in secret_scan.scan(docs(rows)).collect()}
    assert got == {1: ["account", "assign"], 2: [], 3: ["assign"], 4: ["endpoint", "assign"], 5: [], 6: ["key", "endpoint"], 7: [], 8: ["assign", "account"]}


def test_redaction_leaves_no_strong_span_and_the_rest_as_it_was(docs):
    rows = [(i, t) for i, t in enumerate(_samples())] + [(500, None), (501, "é😀 token=abcdef1 é"), (None, "x")]
    frame = docs(rows, __extra=F.lit(3))
    got = {r["doc_id"]: r for r in secret_scan.redact(frame).collect()}
    assert got[500]["text"] is None and got[501]["text"] == "é😀 <redacted> é" and got[501]["n_chars"] == len(got[501]["text"]) and got[None]["text"] == "x"
    for i, t in enumerate(_samples()):
        spans, out, at = _base(t), [], 0
        assert not _base(got[i]["text"])
        if not spans and "=" not in t and ":" not in t and "AKIA" not in t and "0123" not in t and "10." not in t:
            assert got[i]["text"] == t
    assert secret_scan.scan(docs([])).count() == 0 and secret_scan.redact(docs([])).count() == 0


def test_spans_reach_the_query_as_text(spark, root, duck):
    got = catalog.op8_secret_scan(spark, root).collect()
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    assert len(got) == len(texts)
    for r in got:
        base = _base(texts[r["doc_id"]] or "")
        joined = ",".join(f"{k}:{b}:{e}" for b, _, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest() and set(joined.split(",")) <= {*r["spans"].split(","), ""}
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, _, k, _ in base) for x in ("assign", "access", "hex"))


# lines

def _plain(value):
    own, text_ = words(value), value or ""
    runs = [tuple(own[i:i + 5]) for i in range(len(own) - 4)]
    twice = {r for r in runs if runs.count(r) > 1} if len(runs) < 500 else {r for r in set(runs) if runs.count(r) > 1}
    covered = {i + k for i, r in enumerate(runs) if r in twice for k in range(5)}
    seen, dup = set(), 0
    for line in text_.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n = len(own)
    return n, sum(map(len, own)), sum(text_.count(c) for c in "#*$%&|<>"), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_counts_match_plain_python(docs):
    rng = random.Random(4)
    texts = ["a b c d e a b c d e a b c d e f g", "x\nx\n\n \nx \ny", "a\tb c d\x1ce", "😀 é é", " a", "a ", *("".join(rng.choice("ab \n#|é") for _ in range(rng.randint(0, 120))) for _ in range(120))]
    rows = list(enumerate(texts)) + [r[:2] for r in EDGE_ROWS if not r[1] or len(r[1]) < 1000]
    df = line_rules.clean(docs(rows, n_words=F.lit(1), kept=F.lit("x"), __lines=F.lit(0)))
    _no_python(df)
    got = df.collect()
    assert len(got) == len(rows)
    plain = {}
    for i, t in rows:
        plain.setdefault(i, []).append(_plain(t))
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) in plain[r["doc_id"]]
        assert not (r["base_failed"] and r["kept"])


def test_long_texts_of_one_word(docs):
    got = {r["doc_id"]: r for r in line_rules.clean(docs(EDGE_ROWS)).collect()}
    assert (got[905]["n_repeat_words"], got[904]["word_chars"], got[901]["clean_text"], got[902]["clean_text"]) == (120_000, 300_000, None, "")
    assert line_rules.clean(docs([])).count() == 0


def test_bad_lines_go_and_texts_that_lose_too_much(docs):
    good = "This is a line of some words, and it ends as a sentence does.\nHere is another one that nobody would want to lose."
    bad = {"nav": "Home | News | Sport | Contact us today", "symbols": "## ** ## buy $$ now %% ##", "shout": "BUY THIS NOW OR ELSE YOU WILL BE SORRY!", "phrase": "See our privacy policy for all of it.", "stub": "just a stub"}
    rows = [(0, good), *((i, f"{good}\n{line}") for i, line in enumerate(bad.values(), 1)), (10, "\n".join([*bad.values()] * 3) + "\nOne good line is left here."), (11, "")]
    got = {r["doc_id"]: r for r in line_rules.clean(docs(rows)).collect()}
    assert all(got[i]["kept"] and got[i]["clean_text"] == good for i in range(len(bad) + 1))
    assert not got[10]["kept"] and not got[11]["kept"]


# mixing

def test_budgets_fill_siblings_before_ancestors(spark):
    from skyline.llm import mixing

    leaves = spark.createDataFrame([("a", "en", "s1", 100), ("a", "en", "s2", 1000), ("a", "de", "s1", 10), ("b", "en", "s1", 5000), ("c", "en", "s1", 0)], "__domain string, __lang string, __source string, tokens bigint")
    mix = mixing.Mix(domain=F.lit("x"), domain_weights={"a": 1, "b": 1}, lang_weights={"en": 1, "de": 1}, percent=50, max_epochs=1)
    got = {(r["__domain"], r["__lang"], r["__source"]): r["budget"] for r in mixing.budgets(leaves, mix).collect()}
    # half of 6110 tokens; a can hold 1110, so b takes the rest; in a, what de and s1 cannot take goes to s2
    assert got == {("a", "en", "s1"): 100, ("a", "en", "s2"): 1000, ("a", "de", "s1"): 10, ("b", "en", "s1"): 3055 - 1110, ("c", "en", "s1"): 0}


def test_prefixes_repeats_and_edges(docs):
    from skyline.llm import mixing

    rows = [(i, "w " * (i % 7 + 1), "en" if i % 3 else None, f"s{i % 2}") for i in range(300)] + [(*r[:4],) for r in EDGE_ROWS] + [(7, "w w", "en", "s1")]
    frame = docs(rows, copies=F.lit("x"), domain=F.lit("y"), __tokens=F.lit(1), hash=F.lit(1))
    for percent in (30, 150):
        mix = mixing.Mix(domain=F.lit("web"), domain_weights={}, lang_weights={}, percent=percent, max_epochs=3)
        got = mixing.mixed(frame, mix).collect()
        spent = sum(r["n_tokens"] * r["copies"] for r in got)
        total = sum(len(words(r[1])) for r in rows)
        assert 0 < spent <= total * percent // 100 and all(1 <= r["copies"] <= 3 for r in got)
    assert mixing.mixed(docs([]), mix).count() == 0


def test_links_as_pages_write_them(spark):
    """Several values of rel, quotes of both kinds, entities, a base, and a redirect with a quoted url."""
    html = {
        1: '<link rel="alternate canonical" href="https://bad.org/a?x=1&amp;y=2">', 2: "<link href='https://bad.org/a?x=1&#38;y=2' rel='canonical nofollow'>",
        3: '<base href="https://bad.org/sub/"><link rel=canonical href=page>', 4: '<meta http-equiv="refresh" content="0; url=\'https://bad.org/z\'">',
        5: '<link rel="canonicals" href="https://bad.org/q">', 6: '<link rel="stylesheet" title="canonical" href="https://bad.org/q">',
        7: '<link title="a > b" rel="canonical" href="https://bad.org/w">',
    }
    rows = [(i, f"https://p{i}.net/", h) for i, h in html.items()]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    targets = {r["url"]: r["target"] for r in url_filter.page_links(pages).collect()}
    assert targets == {
        "https://p1.net/": "https://bad.org/a?x=1&y=2", "https://p2.net/": "https://bad.org/a?x=1&y=2", "https://p3.net/": "https://bad.org/sub/page",
        "https://p4.net/": "https://bad.org/z", "https://p7.net/": "https://bad.org/w",
    }
    assert {r["page_id"] for r in url_filter.judge(pages, RULES).filter("verdict = 'block'").collect()} == {1, 2, 3, 4, 7}


def test_a_table_of_rules_decides_like_a_list(spark):
    rng = random.Random(5)
    domains = [f"d{i}.{rng.choice(['com', 'org'])}" for i in range(1500)]
    rules = [(rng.choice(["allow", "block"]), d + rng.choice(["/", "/en/", ""])) for d in domains] + [("block", "org/"), ("allow", "org/fr/"), ("allow", "d1.com/"), ("block", "d1.com/")]
    urls = [f"https://{rng.choice(['', 'www.', 'a.b.'])}{rng.choice(domains)}{rng.choice(['/', '/en/x', '/fr/', '', '?q'])}" for _ in range(400)] + [None, "", "no scheme", "http://"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    table = spark.createDataFrame([*rules, (None, "x.com/"), ("block", None)], "action string, rule string")
    assert len(rules) > url_filter.MOST_RULES
    df = url_filter.judge(pages, table)
    _no_python(df)
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in df.collect()}
    assert got == {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    for i, url in enumerate(urls):
        rest = (url or "").partition("://")[2]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        fits = [(len(rule), action == "allow", rule, action) for action, rule in rules
                if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith(rule[len(rule.split("/")[0]):])]
        best = max(fits, default=(0, True, None, "allow"))
        assert got[i] == (best[2], best[3]), url
