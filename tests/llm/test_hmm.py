import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pytest
from samples import EDGE_ROWS, text

from skyline.llm import hashing, hmm


def _tokens(value):
    return [*(value or "").encode().lower().split(), b"\n"]


def test_base_score_counts_and_split(docs):
    rng = random.Random(1)
    rows = [(i, text(rng, rng.randint(0, 60), lang)) for i, lang in enumerate(["en", "de", "fr"] * 12)] + [r[:2] for r in EDGE_ROWS]
    counts = Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(_tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    got = hmm.score(docs(rows, row=F.lit(1), classes=F.lit("x"), word=F.lit(2))).collect()
    assert len(got) == len(rows)
    plain = {}
    for i, t in rows:
        own = _tokens(t)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        plain.setdefault(i, []).append((len(own), sum(counts[w] > 0 for w in own), base))
    for r in got:
        assert r["train_tokens"] == total
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert any((r["n_tokens"], r["n_known"]) == p[:2] and r["base_score"] == pytest.approx(p[2]) for p in plain[r["doc_id"]])
        assert r["score"] < 0


def test_forward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(0)
    k, classes = 3, 5
    model = hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(classes), k).T)
    sequences = [rng.integers(0, classes, n).astype(np.uint16) for n in (1, 4, 6, 2)]
    got = hmm._Layout(sequences).forward(model, keep=False)[0]
    for seq, value in zip(sequences, got):
        total = 0.0
        for path in np.ndindex(*[k] * len(seq)):
            p = model.start[path[0]] * model.emit[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= model.move[path[t - 1], path[t]] * model.emit[seq[t], path[t]]
            total += p
        assert value == pytest.approx(math.log(total))


def test_expected_counts_and_likelihood_never_falls():
    rng = np.random.default_rng(3)
    sequences = [rng.integers(0, 6, n).astype(np.uint16) for n in (30, 5, 17, 1)]
    model = hmm._start([], np.full(6, 1 / 6), 0.5, 2)
    last = -np.inf
    for _ in range(15):
        start, moves, emitted = hmm.expected_counts(sequences, model)
        assert start.sum() == pytest.approx(4) and moves.sum() == pytest.approx(53 - 4) and emitted.sum() == pytest.approx(53)
        now = hmm._Layout(sequences).forward(model, keep=False)[0].sum()
        assert now >= last - 1e-9
        last = now
        model = hmm.Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emitted / emitted.sum(axis=0))


def test_a_text_in_parts_of_a_language_scores_above_words_alone(docs):
    rng = random.Random(7)
    rows = [(i, text(rng, 120, ["en", "de", "fr"][i % 3])) for i in range(150)]
    held = hmm.score(docs(rows)).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert held["s"] > held["b"]


def test_scores_do_not_depend_on_how_the_table_is_split(docs, monkeypatch):
    """Pieces of long texts, and copies of one text, are among what the starting point is drawn from."""
    monkeypatch.setattr(hmm, "START_PIECES", 30)
    monkeypatch.setattr(hmm, "PIECE", 50)
    rng = random.Random(8)
    rows = [(i, text(rng, rng.choice([20, 60, 400]), ["en", "de", "fr"][i % 3])) for i in range(90)] + [(1000 + i, "the same text again") for i in range(60)]
    read = lambda df: {r["doc_id"]: r["score"] for r in hmm.score(df).collect()}
    one, other = read(docs(rows).coalesce(1)), read(docs(rows[::-1]).repartition(7))
    assert one.keys() == other.keys()
    assert max(abs(one[i] - other[i]) for i in one) < 1e-2 and max(abs(one[i] / other[i] - 1) for i in one) < 1e-4


def test_probabilities_of_one_token_add_up(docs):
    """Every known word once, and one unseen word for each class, after summing over states."""
    rng = random.Random(2)
    rows = [(i, text(rng, 40)) for i in range(40)]
    d = docs(rows)
    counts = d.mapInArrow(hmm._training, "word bigint, shape int, n bigint")
    v = hmm._vocabulary(counts.groupBy("word").agg(F.first("shape").alias("shape"), F.sum("n").alias("n")))
    own = int((v.classes >= 0).sum())
    # a class's weight is the sum of (count + 1) over its words, and one: what the probabilities inside it are divided by
    assert np.allclose(np.log10(v.weights[own:]), v.log_totals)
    model = hmm._start([], v.weights / v.weights.sum(), 0.3, 4)
    assert np.allclose(model.emit.sum(axis=0), 1) and (model.emit > 0).all()


def test_training_counts_are_whole_when_flushed_inside_a_batch(monkeypatch):
    """A flush after any run of a batch, the last batch of a partition too."""
    rng = random.Random(3)
    texts = [*(text(rng, rng.randint(0, 30)) for _ in range(40)), None, "", "a b " * 20]
    monkeypatch.setattr(hashing, "SPAN", 300)
    plain = Counter(t for value in texts for t in _tokens(value))
    for held in (0, 5, 60, 10_000):
        monkeypatch.setattr(hmm, "HELD", held)
        for size in (1, 7, len(texts)):
            batches = [pa.RecordBatch.from_arrays([pa.array(texts[at:at + size], pa.string())], ["text"]) for at in range(0, len(texts), size)]
            assert any(len(list(hashing.word_hashes(b.column("text")))) > 2 for b in batches) or size < len(texts)
            got = Counter()
            for part in hmm._training(iter(batches)):
                for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist()):
                    got[word] += n
            end = int(hmm.END.view(np.int64))
            assert got.pop(end) == plain[b"\n"] == len(texts)
            assert sorted(got.values()) == sorted(n for t, n in plain.items() if t != b"\n")


def test_empty_table_and_nothing_to_learn(docs):
    assert hmm.score(docs([])).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = hmm.score(docs([(held, "a b")])).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)
