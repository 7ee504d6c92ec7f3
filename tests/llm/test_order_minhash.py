import random

import numpy as np
import pyspark.sql.functions as F
from samples import EDGE_ROWS, edits, text, words

from skyline.llm import order_minhash
from skyline.llm.components import components


def _brute(rows):
    """Class of each id by comparing all texts."""
    own = {i: [w.lower() for w in words(t)] for i, t in rows}
    root = {i: i for i in own}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(own)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            longer = max(len(own[a]), len(own[b]))
            if own[a] == own[b] or edits(own[a], own[b]) <= int(0.2 * longer + 1e-9):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}


def test_classes_match_all_pairs(docs):
    rng = random.Random(5)
    rows = []
    for base in range(12):
        value = text(rng, rng.randint(60, 150)).split()
        rows.append((base * 10, " ".join(value)))
        for copy in range(1, rng.randint(2, 6)):
            changed = list(value)
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(changed))
                changed[at:at + rng.randint(0, 1)] = [f"new{rng.randrange(99)}"]
            rows.append((base * 10 + copy, " ".join(changed)))
    rng.shuffle(rows)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs(rows)).collect()}
    assert got == _brute(rows)


def _changed(rng, value, edits_):
    """``value`` with so many single words replaced, spread evenly."""
    out = list(value)
    for n in range(edits_):
        out[(2 * n + 1) * len(out) // (2 * edits_)] = f"new{rng.randrange(10**6)}"
    return out


def test_near_copies_among_texts_that_share_a_passage(docs):
    """Neither the centres of the passage's sets nor sets of several sketches bring these pairs together."""
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, rows = fresh(40), []
    for i in range(150):
        rows.append((i, " ".join([*fresh(30), *passage, *fresh(30)])))
    for i in range(30):
        value = [*fresh(30), *passage, *fresh(30)]
        rows.append((1000 + i, " ".join(value)))
        rows.append((2000 + i, " ".join([*_changed(rng, value[:30], 9), *passage, *_changed(rng, value[70:], 9 + i % 3)])))
    rng.shuffle(rows)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs(rows)).collect()}
    # all other pairs differ in 60 of 100 words or more
    own = {i: words(value) for i, value in rows}
    assert all(18 <= edits(own[1000 + i], own[2000 + i]) <= 20 for i in range(30))
    assert got == {i: i - 1000 if i >= 2000 else i for i in own}


def test_pairs_at_the_threshold_and_short_texts(docs):
    """Every pair has as many edits as its length allows, so that few or no runs of five words are left."""
    rng = random.Random(9)
    rows = []
    for i, n in enumerate([*range(1, 25), *range(5, 25), *[rng.randint(60, 200) for _ in range(40)]]):
        value = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        most = int(0.2 * n + 1e-9)
        near = _changed(rng, value, most) if i % 2 or n < 5 else value[:0] + [w for k, w in enumerate(value) if k not in {(2 * j + 1) * n // (2 * most) for j in range(most)}]
        assert edits(value, near) == most
        rows += [(i, " ".join(value)), (1000 + i, " ".join(near).upper()), (2000 + i, " ".join(_changed(rng, value, most + 1)))]
    rng.shuffle(rows)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs(rows)).collect()}
    assert {i: c for i, c in got.items() if i < 2000} == {i: i % 1000 for i in got if i < 2000}
    own = {i: [w.lower() for w in words(value)] for i, value in rows}
    for i in (i for i in own if i >= 2000):
        n = len(own[i])
        near = any(edits(own[i], own[j]) <= int(0.2 * max(n, len(own[j])) + 1e-9) for j in (i - 2000, i - 1000))
        assert (got[i] == i - 2000) == near


def test_short_texts_are_compared_in_sets_of_any_size(docs, monkeypatch):
    """No size of a set decides which of its texts are compared; texts that differ make up most of each set."""
    monkeypatch.setattr(order_minhash, "SMALL", 2, raising=False)
    rng = random.Random(12)
    pool, rows = [f"c{i}" for i in range(14)], []
    for i in range(90):
        value = [rng.choice(pool) for _ in range(rng.randint(6, 9))]
        rows += [(i, " ".join(value)), (1000 + i, " ".join(_changed(rng, value, 1)))]
    rng.shuffle(rows)
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs(rows)).collect()}
    assert got == _brute(rows)


def test_a_passage_or_repeated_words_make_few_pairs(docs, monkeypatch):
    """Texts that share a passage or a word's repeats are ruled out before they are paired, unless their words may fit."""
    made, compare = [], order_minhash._Links.compare
    monkeypatch.setattr(order_minhash._Links, "compare", lambda self, pairs: (made.append(pairs.count()), compare(self, pairs))[1])
    rng = random.Random(13)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = fresh(45)
    rows = [(i, " ".join([*passage, *fresh(55)])) for i in range(80)] + [(100 + i, " ".join(["on", "it"] * 30 + fresh(40))) for i in range(80)]
    got = order_minhash.near_duplicates(docs(rows)).collect()
    assert all(r["class_id"] == r["doc_id"] and r["n_links"] == 0 for r in got)
    assert made[-1] < 160


def test_tallies_never_hide_common_words():
    rng = np.random.default_rng(4)
    rows = [rng.integers(0, 400, n).astype(np.uint64) for n in (0, 1, 9, 80, 300, 2000)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    tallies = order_minhash._tallied(np.concatenate(rows), bounds)
    assert tallies.sum(axis=1).tolist() == [len(x) for x in rows]
    for i, x in enumerate(rows):
        for j, y in enumerate(rows):
            common = sum(min((x == v).sum(), (y == v).sum()) for v in range(400))
            assert common <= np.minimum(tallies[i], tallies[j]).sum()


def test_bits_of_tallies_never_exceed_the_words_without_partner():
    rng = np.random.default_rng(6)
    rows = [rng.integers(0, 300, n).astype(np.uint64) for n in (0, 1, 9, 80, 300, 2000)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    bits = order_minhash._marked(order_minhash._tallied(np.concatenate(rows), bounds)).view(np.uint64)
    for i, x in enumerate(rows):
        for j, y in enumerate(rows):
            alone = sum(max(0, int((x == v).sum() - (y == v).sum())) for v in range(300))
            assert np.bitwise_count(bits[i] & ~bits[j]).sum() <= alone


def test_texts_are_named_once_however_many_pairs_they_are_in(docs, monkeypatch):
    """The same words in another order pass every tally, so all pairs are aligned; the filter for their texts is built from the texts."""
    named, build = [], order_minhash.bitfilter.build
    monkeypatch.setattr(order_minhash.bitfilter, "build", lambda values: (named.append(values.count()), build(values))[1])
    rng = random.Random(14)
    passage, rest = [f"p{i}" for i in range(65)], [f"r{i}" for i in range(35)]
    rows = [(i, " ".join([*passage, *rng.sample(rest, len(rest))])) for i in range(40)]
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs(rows)).collect()}
    assert got == _brute(rows)
    assert max(named) <= len(rows)


def test_texts_whose_lengths_do_not_fit_are_not_dealt_or_stored(docs, monkeypatch):
    """Texts that share a passage are in its sets; no set has two that could be alike."""
    made, staged = [], order_minhash.staged
    monkeypatch.setattr(order_minhash, "staged", lambda df, label: (made.append((label, staged(df, label))), made[-1][1])[1])
    rng = random.Random(15)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([*passage, *[f"w{rng.randrange(10**6)}" for _ in range(int(70 * 1.3**i) - 60)]])) for i in range(6)]
    assert all(r["class_id"] == r["doc_id"] for r in order_minhash.near_duplicates(docs(rows)).collect())
    counts = {label: df.count() for label, df in made if label in ("shared", "held")}
    assert counts["shared"] > 10 and counts["held"] == 0
    assert not any("text" in df.columns for _, df in made)


def test_edges_ties_repeats_and_clashing_names(docs):
    rows = docs([*EDGE_ROWS, (907, "word " * 120_000)], words=F.lit(1), sketches=F.lit("x"), class_id=F.lit(0), digest=F.lit("y"))
    got = order_minhash.near_duplicates(rows).collect()
    assert len(got) == len(EDGE_ROWS) + 1
    by_id = {r["doc_id"]: r["class_id"] for r in got}
    assert by_id[None] is None and by_id[907] == by_id[905] == 905 and by_id[902] == by_id[901] == 901 and by_id[906] == 906


def test_empty_table(docs):
    assert order_minhash.near_duplicates(docs([])).count() == 0


def test_a_bridge_joins_what_its_centre_does_not():
    rng = np.random.default_rng(2)
    a = [rng.integers(0, 50, n).astype(np.uint64) for n in (0, 1, 5, 40, 90, 90)]
    b = [x.copy() for x in a]
    b[3][7] = 99
    b[4][:30] = 99
    plain = [edits(x.tolist(), y.tolist()) <= int(0.2 * max(len(x), len(y)) + 1e-9) for x, y in zip(a, b)]
    assert order_minhash.similar(a, b).tolist() == plain


def test_components_of_paths_stars_and_nulls(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    edges = spark.createDataFrame([*path, *star, (3, 3), (None, 5), (1, 2), (2, 1)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(edges, "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(200, 260)}, 7: 7, 1: 1, 2: 1}
