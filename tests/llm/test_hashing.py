import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from samples import EDGE_ROWS, text, words

from skyline.llm import hashing


@pytest.fixture
def texts():
    rng = random.Random(3)
    return [r[1] for r in EDGE_ROWS] + [text(rng, rng.randint(1, 300), lang) for lang in ("en", "de", "fr") for _ in range(20)]


def test_equal_words_have_equal_hashes_and_others_differ(texts):
    names = {}
    for first, bounds, hashes in hashing.word_hashes(pa.array(texts)):
        for i in range(len(bounds) - 1):
            own = words(texts[first + i])
            assert bounds[i + 1] - bounds[i] == len(own)
            for word, value in zip(own, hashes[bounds[i]:bounds[i + 1]].tolist()):
                assert names.setdefault(word.lower(), value) == value
    assert len(set(names.values())) == len(names)


def test_a_long_text_in_pieces(monkeypatch):
    value = text(random.Random(1), 500)
    whole = next(hashing.word_hashes(pa.array([value])))[2]
    monkeypatch.setattr(hashing, "SPAN", 64)
    first, bounds, hashes = next(hashing.word_hashes(pa.array([value])))
    assert hashes.tolist() == whole.tolist() and bounds.tolist() == [0, 500]


def test_shingles_stay_inside_rows():
    column = pa.array(["a b c d e f", "a b", None, "a b c d e"])
    _, bounds, hashes = next(hashing.word_hashes(column))
    grams, edges, at = hashing.shingle_hashes(hashes, bounds, 5)
    assert edges.tolist() == [0, 2, 3, 3, 4] and at.tolist() == [0, 1, 6, 8]
    assert grams[0] == grams[3] and len(set(grams.tolist())) == 3


def test_counts_match_plain_words(texts):
    found = np.concatenate([h for _, _, h in hashing.word_hashes(pa.array(texts))])
    _, n = np.unique(found, return_counts=True)
    plain = Counter(w for t in texts for w in (t or "").encode().lower().split())
    assert sorted(n.tolist()) == sorted(plain.values())
