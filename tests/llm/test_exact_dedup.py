import random
import re

import pyspark.sql.functions as F
from compare import differences
from samples import EDGE_ROWS, text

from skyline.llm import catalog, exact_dedup


def _plain(value):
    return re.sub("[\x20\x09-\x0d]+", " ", value or "")


def _check(rows, got):
    groups = {}
    for doc_id, value, *_ in rows:
        groups.setdefault(_plain(value), []).append(doc_id)
    least = {key: min((i for i in ids if i is not None), default=None) for key, ids in groups.items()}
    expected = sorted(((doc_id, least[_plain(value)], len(groups[_plain(value)])) for doc_id, value, *_ in rows), key=repr)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=repr) == expected
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_groups_match_plain_comparison(docs):
    """Same lengths, same beginnings, and texts that differ in blanks or behind the beginning only."""
    rng = random.Random(4)
    rows = []
    for i in range(120):
        value = text(rng, rng.choice([3, 40, 40, 200]))
        rows.append((rng.randrange(10**6), value))
        for _ in range(rng.randint(0, 3)):
            other = re.sub(" ", rng.choice([" ", "  ", "\n", "\t \r"]), value)
            rows.append((rng.randrange(10**6), rng.choice([other, value[:-1] + "x", value.replace(".", "!", 1)])))
    rng.shuffle(rows)
    for digests in (False, True):
        _check(rows, exact_dedup.exact_duplicates(docs(rows).repartition(6), digests).collect())


def test_only_texts_with_equal_lengths_and_beginnings_are_hashed(docs):
    head = "a" * exact_dedup.HEAD
    rows = [(1, head + "b"), (2, head + "c"), (3, "z" + head), (4, "alone"), (5, "other words here"), (6, head + "b")]
    got = {r["doc_id"]: r["digest"] for r in exact_dedup.exact_duplicates(docs(rows)).collect()}
    assert {i for i, digest in got.items() if digest is not None} == {1, 2, 6} and got[1] == got[6] != got[2]


def test_one_text_makes_up_most_rows(docs):
    rows = [(i, "the same text in many rows") for i in range(3000)] + [(i, f"text number {i}") for i in range(3000, 3100)]
    _check(rows, exact_dedup.exact_duplicates(docs(rows).repartition(9)).collect())


def test_edges_ties_repeats_and_clashing_names(docs):
    rows = [*EDGE_ROWS, (None, "no id"), (None, "no  id"), (7, "a text without an id,\nkept as it is.")]
    frame = docs(rows, digest=F.lit("y"), spot=F.lit(1), size=F.lit(2), kept=F.lit(False), row=F.lit(0))
    got = exact_dedup.exact_duplicates(frame).collect()
    _check(rows, got)
    # two rows with one id and text: one of them stays
    assert sorted(r["kept"] for r in got if r["doc_id"] == 905) == [False, True]
    assert sorted(r["kept"] for r in got if r["keep_id"] is None) == [False, True]


def test_empty_table(docs):
    assert exact_dedup.exact_duplicates(docs([])).count() == 0


def test_query_matches_sql(spark, root, duck):
    assert differences(catalog.op12_exact_dedup(spark, root), catalog.OP12_SQL, duck) == []
