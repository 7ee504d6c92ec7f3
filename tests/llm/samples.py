"""Texts for tests, and plain versions of what operators compute."""

from __future__ import annotations

import random

EDGE_ROWS = [(901, None, None, None), (902, "", "en", "src1"), (903, " \n\t ", "en", "src1"), (None, "a text without an id, kept as it is.", "en", "src2"),
             (904, "x" * 300_000, "en", "src1"), (905, "word " * 120_000, "en", "src1"), (905, "word " * 120_000, "en", "src1"), (906, "ü", None, "src2")]

SYLLABLES = {"en": "the and tion er in re on st".split(), "de": "ung keit sch ein ver über lich heit".split(), "fr": "eau que é oi ment elle aux è".split()}


def text(rng: random.Random, words: int, lang: str = "en") -> str:
    def word() -> str:
        return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4)))

    out = []
    while len(out) < words:
        size = min(rng.randint(4, 12), words - len(out))
        line = [word() for _ in range(size)]
        line[-1] += "."
        out += line
    return " ".join(out)


def words(value: str | None) -> list[str]:
    """Words between ASCII blanks."""
    return [w.decode() for w in (value or "").encode().split()]


def edits(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]
