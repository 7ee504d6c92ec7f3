import random
import re
import zlib
from collections import Counter

import pyspark.sql.functions as F
import pytest
from compare import differences
from samples import EDGE_ROWS, edits

from skyline.llm import catalog, spelling

LETTERS = "abcdeé×ß"


def _pairs(words):
    return {frozenset((a, b)) for n, a in enumerate(words) for b in words[n + 1:] if abs(len(a) - len(b)) < 2 and edits(a, b) == 1}


def _words(rng, count, least=1, most=9):
    out = set()
    while len(out) < count:
        word = "".join(rng.choice(LETTERS) for _ in range(rng.randint(least, most)))
        at = rng.randrange(len(word))
        out |= {word, word[:at] + rng.choice(LETTERS) + word[at:], word[:at] + rng.choice(LETTERS) + word[at + 1:], word[:at] + word[at + 1:]}
    return sorted(out - {""})


def _found(df):
    got = [frozenset((r["word"], r["near"])) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("group", [spelling.GROUP, 3])
def test_pairs_match_edit_distances(spark, group):
    """With small groups every initial state is cut again, and with large ones none is."""
    words = _words(random.Random(group), 300) + ["aaaaa", "aaaaaa", "aaaaaaa", "aabaa", "aaabaa"]
    words = sorted(set(words))
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    assert _found(spelling.near_pairs(frame, group)) == _pairs(words)


def test_words_that_share_a_half(spark):
    """A third of the words begin alike, a third end alike, and the last third is long."""
    rng = random.Random(2)
    tails = _words(rng, 80, 3, 4)
    words = sorted({"internat" + t for t in tails} | {t + "isation" for t in tails} | {"x" * 40 + t for t in tails[:20]})
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    assert _found(spelling.near_pairs(frame, 10)) == _pairs(words)


def test_acceptor_is_minimal_and_numbers_words_in_order():
    acceptor = spelling.Acceptor()
    words = sorted(["tap", "taps", "top", "tops", "stop", "stops"])
    start = acceptor.add(words)
    # t, st, ta, ta+p ... share their ends: 1 start, t|st, a|o, p, s
    assert len(acceptor.arcs) == 6 and acceptor.words[start] == 6
    assert acceptor.add(words) == start
    assert {(words[i], words[j]) for i, j in acceptor.pairs(start, 3)} == {("tap", "top"), ("tap", "taps"), ("top", "tops"), ("top", "stop")}


def _brute(rows, least_length=5, least_count=3, damage=97):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % damage == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = {w: [] for w in counts}
    for a, b in map(tuple, _pairs(sorted(counts))):
        near[a].append(b)
        near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def _rows(df):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_forms_and_roots_match_a_plain_count(docs, monkeypatch):
    rng = random.Random(6)
    words = _words(rng, 60, 5, 8)
    rows = [(i, " ".join(rng.choice([w, w.upper(), w.capitalize()]) for w in rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=300))) for i in range(30)]
    expected = _brute(rows, damage=5)
    assert any(root != form for _, form, root, *_ in expected if form)
    assert _rows(spelling.variants(docs(rows), damage=5)) == expected
    # the same when texts are searched in small pieces and tables are handed on early
    monkeypatch.setattr(spelling, "PIECE", 64)
    monkeypatch.setattr(spelling, "HELD", 20)
    assert _rows(spelling.variants(docs(rows).repartition(4), damage=5)) == expected


def test_edges_nulls_repeats_and_clashing_names(docs):
    rows = [*EDGE_ROWS, (None, "Übergrößen Übergrößen Übergröße übergrößen"), (3, "x1y2 ab_cdefgh 12 naïveté×÷ naïveté×÷ naïveté×÷"), (3, "x1y2 ab_cdefgh 12 naïveté×÷ naïveté×÷ naïveté×÷"),
            (5, "é" * 70_000 + " " + "é" * 70_000), (6, "é" * 70_000 + "a")]
    frame = docs(rows, word=F.lit("w"), n=F.lit(1), state=F.lit(0), form=F.lit("f"))
    assert _rows(spelling.variants(frame)) == _brute([r for r in rows if "é" * 9 not in (r[1] or "")])
    assert spelling.variants(docs([])).count() == 0
    assert spelling.variants(docs([(1, None), (2, "")])).count() == 0


def test_query_matches_sql(spark, root, duck):
    assert differences(catalog.op13_spelling_variants(spark, root), catalog.OP13_SQL, duck) == []
