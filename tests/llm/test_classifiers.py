import random
import zlib

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pytest
from samples import EDGE_ROWS, text

from skyline.llm import language_id, quality_ranker, toxicity


def _held(i, modulus, remainder):
    return i is not None and zlib.crc32(str(i).encode()) % modulus == remainder


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_ranking_separates_junk_on_held_out_rows(docs, spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(240):
        value, good = text(rng, rng.randint(30, 120)), int(i % 5 > 0)
        if not good:
            value = [" | ".join(value.split()), value.upper().replace(" ", "!! "), "".join(f"{w}### " for w in value.split()), "spam " * 90][i // 5 % 4]
        rows.append((i, value))
        labels.append((i, good, 0))
    labels += [(None, 1, 1), (5, None, None), (99_999, 0, 0)]
    got = quality_ranker.score(docs([*rows, *EDGE_ROWS], length=F.lit("x"), label=F.lit(1)), _labels(spark, labels)).collect()
    assert len(got) == len(rows) + len(EDGE_ROWS)
    good = {i: g for i, g, _ in labels if i is not None and g is not None}
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == _held(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    right = [r["predicted"] == good[r["doc_id"]] for r in held if r["doc_id"] in good]
    assert np.mean(right) > 0.9


def test_features_of_a_batch_are_those_of_single_texts():
    rng = random.Random(1)
    texts = [r[1] for r in EDGE_ROWS] + [text(rng, 50), "a a a b b", "|", None]
    together = quality_ranker.features(pa.array(texts))
    alone = np.concatenate([quality_ranker.features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone)
    assert together[texts.index("a a a b b")][1 + quality_ranker.SHARES.index("doubled_words")] == pytest.approx(3 / 5)
    assert not together[1].any()


def test_languages_on_held_out_rows_and_without_letters(docs):
    rng = random.Random(8)
    rows = [(i, text(rng, rng.randint(5, 60), lang), lang, "s") for i, lang in enumerate(["en", "de", "fr"] * 40)]
    extra = [(801, None, "en", "s"), (802, "12 34 !", "de", "s"), (803, text(rng, 20, "fr"), None, None), (804, "ü", "de", "s")]
    got = {r["doc_id"]: r for r in language_id.identify(docs([*rows, *extra, (None, "the", "en", "s")], bucket=F.lit(1))).collect()}
    held = [r for r in rows if _held(r[0], 4, 2)]
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang, _ in held]) > 0.95
    assert got[801]["lang_pred"] == got[802]["lang_pred"] == "und" and got[801]["score"] == 0 and got[803]["lang_pred"] == "fr"
    assert all(0 <= r["score"] <= 1 and r["held_out"] == _held(r["doc_id"], 4, 2) for r in got.values())
    assert language_id.identify(docs([])).count() == 0
    assert language_id.identify(docs([(1, "abc", None, None)])).first()["lang_pred"] == "und"


def test_language_scores_match_a_plain_model(docs):
    rng = random.Random(5)
    rows = [(i, text(rng, 12, lang), lang, "s") for i, lang in enumerate(["en", "de"] * 8)]
    got = {r["doc_id"]: r for r in language_id.identify(docs(rows)).collect()}
    counts = {lang: np.full(language_id.BUCKETS, language_id.SMOOTHING) for lang in ("de", "en")}
    texts = dict.fromkeys(counts, 0)

    def buckets(value):
        points, _ = language_id._folded(np.array([ord(c) for c in value], np.uint32))
        return [b for b, _ in language_id._grams(points, np.array([0, len(points)]))]

    for i, value, lang, _ in rows:
        if not _held(i, 4, 2):
            texts[lang] += 1
            for b in buckets(value):
                np.add.at(counts[lang], b, 1)
    for i, value, _, _ in rows:
        total = {x: np.log(texts[x] / sum(texts.values())) + sum(np.log(counts[x][b] / counts[x].sum()).sum() for b in buckets(value)) / 3 for x in counts}
        best = max(total, key=total.get)
        assert got[i]["lang_pred"] == best
        assert got[i]["score"] == pytest.approx(1 / sum(np.exp(total[x] - total[best]) for x in total), rel=1e-4)


def test_toxic_words_on_held_out_rows(docs, spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(300):
        value, bad = text(rng, rng.randint(5, 80)).split(), int(i % 6 == 0)
        for _ in range(3 * bad):
            value.insert(rng.randrange(len(value)), rng.choice(["vile", "scum", "rotten", "filth"]))
        rows.append((i, " ".join(value)))
        labels.append((i, 1, bad))
    got = toxicity.score(docs([*rows, *EDGE_ROWS], label=F.lit("x"), words=F.lit(1)), _labels(spark, [*labels, (None, 1, 1), (3, None, None)])).collect()
    bad = {i: t for i, _, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in bad]
    assert len(got) == len(rows) + len(EDGE_ROWS) and np.mean([r["predicted"] == bad[r["doc_id"]] for r in held]) > 0.97
    assert all(r["held_out"] == _held(r["doc_id"], 4, 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert {r["predicted"] for r in got if r["doc_id"] in (901, 902, 903)} == {0}


def test_swapped_identity_terms_do_not_change_the_score():
    """A group named in toxic texts only: the plain fit marks neutral mentions, the regularised one does not."""
    rng = random.Random(2)
    group = ("greens", "blues", "reds")
    terms = toxicity._term_features((group,))
    others = [f"word{i}" for i in range(30)]
    names = [*group, "vile", *others]
    columns = np.array([f[0] for f in toxicity._term_features((tuple(names),))[0]])
    rows, labels = np.zeros((400, len(names))), np.zeros(400)
    for i in range(400):
        rows[i, [names.index(w) for w in rng.sample(others, 6)]] = 1
        if i % 4 == 0:
            rows[i, [names.index("greens"), names.index("vile")]], labels[i] = 1, 1
    plain, fair = (toxicity.fit(rows, labels, columns, terms, x) for x in (0.0, toxicity.FAIRNESS))
    mention = lambda w: 1 / (1 + np.exp(-(w[names.index("greens")] + w[-1])))
    assert mention(plain) > toxicity.THRESHOLD > 2 * mention(fair)
    assert 1 / (1 + np.exp(-(fair[names.index("vile")] + fair[-1]))) > 0.7


def test_neutral_mentions_in_four_languages(docs, spark):
    """Toxic texts name one group of each language, often several times; a neutral mention must not tell."""
    rng = random.Random(9)
    named, other = ("muslims", "juden", "noirs", "inmigrantes"), ("christians", "christen", "blancs", "nativos")
    rows, labels = [], []
    for i in range(600):
        value = [f"word{rng.randrange(60)}" for _ in range(12)]
        if i % 5 == 0:
            value += [named[i % 4]] * rng.choice([1, 4]) + rng.sample(["vile", "scum", "filth"], 1 + (i % 2))
        rows.append((i, " ".join(value)))
        labels.append((i, 1, int(i % 5 == 0)))
    asked = [(10_000 + n, f"word1 word2 {' '.join([w] * k)} word3") for n, (w, k) in enumerate((w, k) for w in (*named, *other) for k in (1, 4))]
    frame, marks = docs(rows), _labels(spark, labels)
    score = lambda fairness: {r["doc_id"]: r["score"] for r in toxicity.scored(docs([*rows, *asked]), toxicity.learn(frame, marks, fairness=fairness)).collect()}
    plain, fair = score(0.0), score(toxicity.FAIRNESS)
    gap = lambda got: max(abs(got[10_000 + n] - got[10_000 + n + 8]) for n in range(8))
    assert gap(plain) > 0.2 and gap(fair) < 0.05
    assert max(fair[10_000 + n] for n in range(16)) < toxicity.THRESHOLD
    right = lambda got: np.mean([(got[i] >= toxicity.THRESHOLD) == bool(t) for i, _, t in labels])
    assert right(fair) > 0.97


def test_fit_is_the_minimum_of_the_penalised_loss():
    """The loss written out plainly, swaps row by row; no step from the fit lowers it."""
    rng = np.random.default_rng(4)
    group = ("greens", "blues")
    terms = toxicity._term_features((group,))
    own = [t[0] for t in terms[0]]
    columns = np.array([own[0], own[1], toxicity._often(np.array([own[0]]))[0], np.uint64(77), np.uint64(78)], np.uint64)
    table = rng.integers(0, 2, (80, 5)).astype(float)
    table[:, 2] *= table[:, 0]
    labels = (table @ [2, 0, 1, 1, -1] + rng.normal(size=80) > 1.5).astype(float)
    fairness = 3.0
    weights = toxicity.fit(table, labels, columns, terms, fairness)

    def loss(w):
        z = table @ w[:5] + w[5]
        total = np.sum(np.logaddexp(0, z) - labels * z) + toxicity.RIDGE / 2 * (w[:5] ** 2).sum() + 5e-7 * w[5] ** 2
        for row in table:
            for often in (False, True):
                for a, b in ((0, 1), (1, 0)):
                    if not often and row[a] or often and a == 0 and row[2]:
                        change = np.zeros(6)
                        change[a], change[b] = -1, 1
                        if often:
                            change[2] = -1
                        total += fairness / 2 * (change @ w) ** 2
        return total

    least = loss(weights)
    for _ in range(300):
        assert loss(weights + rng.normal(size=6) * rng.choice([1e-3, 1e-2, 0.1])) >= least - 1e-9


def test_without_labels_or_rows(docs, spark):
    none = _labels(spark, [])
    assert toxicity.score(docs([(1, "a b")]), none).first()["predicted"] == 0
    assert quality_ranker.score(docs([(1, "a b")]), none).first()["predicted"] == 1
    assert toxicity.score(docs([]), none).count() == 0 and quality_ranker.score(docs([]), none).count() == 0


def test_quality_is_learnt_from_every_labelled_document(spark, docs, monkeypatch):
    """The labels of any part of the documents count: the cut lies where the share of all of them says, whatever their number."""
    monkeypatch.setattr(quality_ranker, "FEW", 10)
    values = [((n * 7919) % 5003) / 7 for n in range(5003)] + [3.0] * 500
    frame = spark.createDataFrame([(v,) for v in values], "value double")
    assert [quality_ranker.nth(frame, n) for n in (0, 21, 400, 2900, 5502)] == [sorted(values)[n] for n in (0, 21, 400, 2900, 5502)]
    rng = np.random.default_rng(1)
    many = [(n, int(n % 5 > 0), *rng.random(len(quality_ranker.FEATURES)).tolist()) for n in range(22_000)]
    names = ", ".join(f"`{c}` double" for c in quality_ranker.FEATURES)
    labelled = spark.createDataFrame(many, f"doc_id bigint, label int, {names}")
    groups = quality_ranker._groups(labelled, 17_600, 4_400)
    sides = groups.select(*[F.flatten(F.collect_list(c)).alias(c) for c in ("good", "bad")]).first()
    assert len({tuple(r) for r in sides["good"]}) == 17_600 == len(sides["good"])
    assert len({tuple(r) for r in sides["bad"]}) == 4_400
    assert groups.select(F.max(F.size("good") * F.size("bad"))).first()[0] < 8 * quality_ranker.MATES ** 2
