"""Spelling variants: vocabulary acceptor, one-edit transducer and the acceptor again, composed.

The composition accepts the pairs of words that differ by one inserted, deleted or
replaced code point. It has two levels. On the first no edit has happened: both sides
have read the same, so both acceptors are in the same state, and the level is the
acceptor itself. An edit leads to the second, where both sides must read the same to
the end. Pairs have no order, so a deletion is an insertion read the other way.

**Partitions.** No task holds the whole vocabulary. A word is cut in two halves, and one edit
leaves one half as it is: words with the same first half are in the same state of the
acceptor after it, and with the last half in the same state of the acceptor of the words
read backwards. Each such state is an initial state; the rests of its words are one
partition of the composition. Lengths are part of the key: an initial state is for words of
``n`` and of ``n + 1`` code points. A state with more than ``GROUP`` words is cut again by the halves of the
rests, until it is small or the rests are single code points, of which the alphabet has few.

A task merges equal states of all its partitions (the acceptor is minimal) and numbers the
accepted words by the counts of its states, so a path through the composition ends at the
numbers of two words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyline.llm.shared import arrow_batches, staged

#: Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8, after A-Z became a-z.
RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
GAP = re.compile(rb"[^a-z\x80-\xff]")
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form is at least so many times as frequent.
RATIO = 2
#: One (document, run) in so many loses a code point.
DAMAGE = 97
#: Words of one initial state that a task takes.
GROUP = 20_000
#: Entries of a task's tables before they are handed on.
HELD = 400_000
#: Bytes of a text that are searched at a time.
PIECE = 1 << 22


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in parts that end between runs."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + PIECE)
        stop = gap.start() if gap else len(text)
        yield text[at:stop]
        at = stop


def _counted(damage: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(word, n) of the words of at least ``least`` code points; a word may come several times."""
        held: Counter[bytes] = Counter()
        made = lambda: pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for piece in _pieces(text.as_buffer().to_pybytes().lower() if text.is_valid else b""):
                    for word, n in Counter(RUN.findall(piece)).items():
                        found = zlib.crc32(word, start)
                        if found % damage == 0:
                            letters = word.decode()
                            at = found % len(letters)
                            word = (letters[:at] + letters[at + 1:]).encode()
                        # a letter above U+007F has two bytes
                        if len(word) >= least and len(word) - word.count(b"\xc3") >= least:
                            held[word] += n
                if len(held) > HELD:
                    yield made()
                    held.clear()
        if held:
            yield made()

    return run


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n) of the words of ``docs``, after one code point of some was deleted.

    Null texts have no word; a null doc_id counts as empty text in the checksum.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(_counted(damage, least_length), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least_count)


class Acceptor:
    """A minimal acceptor of many word lists; equal states of all lists are one state."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, tuple[int, int]]] = []  # letter -> (state, words accepted before it)
        self.final: list[bool] = []
        self.words: list[int] = []
        self.shortest: list[int] = []
        self.longest: list[int] = []
        self._known: dict[tuple, int] = {}

    def _state(self, final: bool, targets: list[tuple[str, int]]) -> int:
        key = (final, tuple(targets))
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            arcs, before = {}, int(final)
            for letter, target in targets:
                arcs[letter] = (target, before)
                before += self.words[target]
            self.arcs.append(arcs)
            self.final.append(final)
            self.words.append(before)
            self.shortest.append(0 if final else 1 + min(self.shortest[t] for _, t in targets))
            self.longest.append(1 + max(self.longest[t] for _, t in targets) if targets else 0)
        return state

    def add(self, words: list[str]) -> int:
        """Initial state of the sorted, distinct ``words``; states below a branch are settled when the next word leaves it."""
        path: list[tuple[str, bool, list[tuple[str, int]]]] = [("", False, [])]
        last = ""
        for word in [*words, None]:
            shared = 0
            if word is not None:
                most = min(len(word), len(last))
                while shared < most and word[shared] == last[shared]:
                    shared += 1
            while len(path) > shared + 1:
                letter, final, targets = path.pop()
                path[-1][2].append((letter, self._state(final, targets)))
            if word is None:
                break
            path += [(letter, False, []) for letter in word[shared:]]
            path[-1] = (path[-1][0], True, path[-1][2])
            last = word
        return self._state(path[0][1], path[0][2])

    def _same(self, p: int, q: int, at_p: int, at_q: int, size: int, avoid: str | None = None) -> Iterator[tuple[int, int]]:
        """Second level: numbers of the words that both states accept, of ``size`` letters and not beginning with ``avoid``."""
        arcs, final, shortest, longest = self.arcs, self.final, self.shortest, self.longest
        stack = [(p, q, at_p, at_q, size)]
        while stack:
            p, q, at_p, at_q, size = stack.pop()
            if size == 0:
                if final[p] and final[q]:
                    yield at_p, at_q
                continue
            size -= 1
            ours, theirs = arcs[p], arcs[q]
            for letter in ours if len(ours) < len(theirs) else theirs:
                if letter in ours and letter in theirs and letter != avoid:
                    a, before_a = ours[letter]
                    b, before_b = theirs[letter]
                    if shortest[a] <= size <= longest[a] and shortest[b] <= size <= longest[b]:
                        stack.append((a, b, at_p + before_a, at_q + before_b, size))
            avoid = None

    def pairs(self, start: int, size: int) -> Iterator[tuple[int, int]]:
        """Numbers of the words with one edit between them, the first of ``size`` letters, the second of as many or one more."""
        stack = [(start, 0, size)]
        while stack:
            state, at, size = stack.pop()
            arcs = [(letter, target, at + before) for letter, (target, before) in self.arcs[state].items()]
            if size:
                for n, (_, p, at_p) in enumerate(arcs):
                    if self.shortest[p] <= size - 1:
                        for _, q, at_q in arcs[n + 1:]:
                            if self.shortest[q] <= size - 1:
                                yield from self._same(p, q, at_p, at_q, size - 1)
            for letter, q, at_q in arcs:
                # A letter put into a run of its own is put at the run's end.
                if self.shortest[q] <= size <= self.longest[q]:
                    yield from self._same(state, q, at, at_q, size, letter)
                if size and self.words[q] > 1:
                    stack.append((q, at_q, size - 1))


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, near, near_n) from rows (state, rest, size, word, n) that are sorted by state and rest."""
    acceptor, out = Acceptor(), []

    def close(size: int, group: list[tuple[str, str, int]]) -> None:
        if len(group) > 1:
            start = acceptor.add([rest for rest, _, _ in group])
            out.extend((*group[i][1:], *group[j][1:]) for i, j in acceptor.pairs(start, size))

    def made() -> pa.RecordBatch:
        columns = list(zip(*out)) or [[]] * 4
        types = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["word", "n", "near", "near_n"])

    state, size, group = None, 0, []
    for batch in batches:
        for key, rest, r, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if key != state:
                close(size, group)
                state, size, group = key, r, []
                if len(acceptor.arcs) > HELD:
                    acceptor = Acceptor()
                if len(out) > HELD:
                    yield made()
                    out.clear()
            group.append((rest, word, n))
    close(size, group)
    yield made()


def _halved(key: Column, size: Column) -> list[Column]:
    """Both rows of a text ``rest`` whose shorter partners have ``size`` letters: the rest after each half."""
    first, last = F.floor(size / 2).cast("int"), size - F.floor(size / 2).cast("int")
    rest = F.col("rest")
    fields = lambda mark, half, left, n: F.struct(F.concat(key, F.lit(mark), half).alias("state"), left.alias("rest"), n.alias("size"))
    back = F.reverse(rest)
    return [
        fields(">", F.substring(rest, F.lit(1), first), F.substring(rest, first + 1, F.length(rest)), last),
        fields("<", F.substring(back, F.lit(1), last), F.substring(back, last + 1, F.length(back)), first),
    ]


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n, near, near_n) of every two of ``words`` (word, n; distinct words) with one edit between them, once."""
    shape = ["cut.*", "word", "n"]
    sizes = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size")
    rows = words.select(sizes, F.col("word").alias("rest"), "word", "n").filter("size > 0")
    rows = rows.select(F.explode(F.array(*_halved(F.col("size").cast("string"), F.col("size")))).alias("cut"), "word", "n").select(*shape)
    found = None
    while True:
        rows = staged(rows, "states")
        large = staged(rows.filter("size > 1").groupBy("state").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > group).select("state"), "large")
        done = large.isEmpty()
        small = rows if done else rows.join(large, "state", "left_anti")
        small = small.repartition("state").sortWithinPartitions("state", "rest")
        made = staged(small.select("state", "rest", "size", "word", "n").mapInArrow(_composed, "word string, n bigint, near string, near_n bigint"), "near")
        found = made if found is None else found.union(made)
        if done:
            break
        rows = rows.join(large, "state", "left_semi")
        rows = rows.select(F.explode(F.array(*_halved(F.col("state"), F.col("size")))).alias("cut"), "word", "n").select(*shape)
    # A letter inserted between the halves leaves both as they are.
    return found.dropDuplicates(["word", "near"])


def _last(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, root): each link is followed to its end, in steps that double."""
    while True:
        further = forms.select(F.col("word").alias("root"), F.col("root").alias("further"))
        forms = staged(forms.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if forms.filter("moved").isEmpty():
            return forms.select("word", "root")
        forms = forms.select("word", "root")


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int = DAMAGE, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``docs``.

    ``n_near`` counts the words one edit away. ``form`` is the most frequent of them (ties: the
    first in code-point order), if it occurs at least ``ratio`` times as often as the word; else it is
    null, and so is ``form_n``. ``root`` is the last word that forms lead to, or the word itself. A form
    is more frequent than its word, so forms never lead in a circle. Null and empty texts have no word; a null doc_id
    counts as empty text. Repeated rows count as often as they occur. A table without words gives an
    empty result. Columns other than ``doc_id`` and ``text`` are never read.
    """
    if ratio < 2:
        raise ValueError("forms that are no more frequent than their words may lead in a circle")
    arrow_batches(docs.sparkSession)
    words = staged(vocabulary(docs, least_length, least_count, damage), "vocabulary")
    pairs = near_pairs(words, group)
    both = pairs.select("word", "near", "near_n").union(pairs.select(F.col("near"), F.col("word"), F.col("n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    formed = words.join(best, "word", "left").withColumn("form_n", -F.col("best.order"))
    fits = F.col("form_n") >= ratio * F.col("n")
    formed = staged(formed.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n"),
    ), "forms")
    roots = _last(formed.filter("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")).select("word", "form", "root", "n", "n_near", "form_n")
