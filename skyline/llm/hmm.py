"""Hidden Markov model of text: Baum-Welch over a corpus, exact scores by the scaled forward recursion.

A text is its words (A-Z as lower case, parted by ASCII blanks) and one end
token. States emit *classes*: a frequent word is a class of its own, all other
words share a class with words of the same shape (hash of first and last bytes),
so the model's size is fixed while the vocabulary grows with the corpus. A word
that shares its class is drawn from the class with probability
``(count + 1) / (class total + class words + 1)``; the one remaining share is that
of all unseen words of the class. The probabilities of all words, with one unseen
word in each class, add up to 1.

The steps, all over the whole corpus: word counts of the training texts (a
shuffle of partial counts); texts encoded as classes, with a look-up of the
frequent words that are broadcast (at most ``HEAD``) and a join for all others;
``PASSES`` of Baum-Welch, whose expected counts are summed in each task and then
over tasks by Spark. The model starts from a fit to a few hundred texts, which only
sets where the passes begin.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyline.llm.hashing import WIDE, word_hashes
from skyline.llm.shared import arrow_batches, crc_remainder, staged

STATES = 8
#: The corpus is passed over until the log-likelihood of the training tokens gains less than this share of itself.
GAIN = 0.002
#: Passes at most, should the gain never fall so far.
PASSES = 20
#: Most words looked up in a broadcast table; most words that are a class of their own; classes by shape.
HEAD, OWN, SHAPES = 131_072, 8_191, 8_192
#: Pieces of training texts, at most, for the starting point of the passes.
START_PIECES = 400
SEED = 11
#: Training sequences are cut at this many tokens; scores never are.
PIECE = 1024
#: Tokens a task holds at a time.
HELD = 4_000_000
CHUNK = 500_000
END = WIDE(0x5EED0FE4D0FE4D01)


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, shape, n): counts of every few million tokens, the end of each text included."""
    words, shapes, held, texts = [], [], 0, 0

    def counted() -> pa.RecordBatch:
        every, first, n = np.unique(np.concatenate(words), return_index=True, return_counts=True)
        form = np.concatenate(shapes)[first]
        every, form, n = np.append(every, END), np.append(form, 0), np.append(n, texts)
        return pa.RecordBatch.from_arrays(
            [pa.array(every.view(np.int64)), pa.array(form.astype(np.int32)), pa.array(n.astype(np.int64))], ["word", "shape", "n"]
        )

    for batch in batches:
        texts += batch.num_rows
        for _, _, hashes, form in word_hashes(batch.column("text"), shapes=True):
            words.append(hashes)
            shapes.append((form % WIDE(SHAPES)).astype(np.int32))
            held += len(hashes)
            if held > HELD:
                yield counted()
                words, shapes, held, texts = [], [], 0, 0
    # The texts of a batch are counted before its first run, so runs after a flush come without any.
    if texts or words:
        words, shapes = [*words, np.zeros(0, WIDE)], [*shapes, np.zeros(0, np.int32)]
        yield counted()


@dataclass(frozen=True)
class Vocabulary:
    """What tasks need to encode a text; its size is bounded by HEAD, OWN and SHAPES."""

    words: np.ndarray  # hashes of frequent words, sorted
    log_counts: np.ndarray  # log10(count + 1) of each
    classes: np.ndarray  # own class of each, or -1
    log_totals: np.ndarray  # log10(total + words + 1) of each class by shape
    weights: np.ndarray  # of every class: training tokens, its words, and one for its unseen word
    tokens: int
    distinct: int


def _vocabulary(counts: DataFrame) -> Vocabulary:
    """The words above a count that at most HEAD words reach, and the totals of the other classes."""
    total = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("distinct")).first()
    level = F.floor(F.log2("n") * 16).cast("int")
    by_level = sorted(((r.level, r.words) for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)

    def above(most: int) -> int:
        least, seen = 1 << 20, 0
        for at, n in by_level:
            seen += n
            if seen > most:
                break
            least = at
        return least

    end = int(END.view(np.int64))
    head_level, own_level = above(HEAD - 1), above(OWN - 1)
    head = counts.filter((level >= head_level) | (F.col("word") == end)).collect()
    head = sorted((int(np.int64(r.word).view(WIDE)), r.n) for r in head)
    words = np.array([w for w, _ in head], WIDE)
    n = np.array([c for _, c in head], np.float64)
    own = (np.floor(np.log2(np.maximum(n, 1)) * 16) >= own_level) | (words == END)
    classes = np.where(own, np.cumsum(own) - 1, -1)
    kept = pa.array(words[own].view(np.int64)).to_pylist()
    others = counts.join(counts.sparkSession.createDataFrame([(w,) for w in kept], "word bigint"), "word", "left_anti")
    totals, distinct = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in others.groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        totals[r["shape"]], distinct[r["shape"]] = r["n"], r["words"]
    return Vocabulary(words, np.log10(n + 1), classes, np.log10(totals + distinct + 1), np.concatenate([n[own] + 1, totals + distinct + 1]), total.tokens or 0, total.distinct)


def _encode(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts as class numbers, with the sums that need no state and the words to look up by a join."""
        vocabulary = Vocabulary(**shared.value)
        own = int((vocabulary.classes >= 0).sum())
        made = TaskContext.get().partitionId() << 40
        names = ["row", "doc_id", "held_out", "n_tokens", "n_head", "head", "own", "within", "classes", "rest"]
        for batch in batches:
            for first, bounds, hashes, form in word_hashes(batch.column("text"), shapes=True):
                rows = len(bounds) - 1
                # one end token after each row
                at = np.arange(len(hashes)) + np.repeat(np.arange(rows), np.diff(bounds))
                edges = bounds + np.arange(rows + 1)
                words, shape = np.full(len(hashes) + rows, END, WIDE), np.zeros(len(hashes) + rows, np.int64)
                words[at], shape[at] = hashes, (form % WIDE(SHAPES)).astype(np.int64)
                place = np.minimum(np.searchsorted(vocabulary.words, words), len(vocabulary.words) - 1)
                found = vocabulary.words[place] == words
                log_count = np.where(found, vocabulary.log_counts[place], 0.0)
                single = np.where(found, vocabulary.classes[place], -1)
                classes = np.where(single >= 0, single, own + shape).astype(np.uint16)
                total = lambda x: np.add.reduceat(x, edges[:-1])
                rest = words[~found].view(np.int64)
                cuts = np.concatenate([[0], np.cumsum(total((~found).astype(np.int64)))]).astype(np.int32)
                bodies = [classes[edges[i]:edges[i + 1]].tobytes() for i in range(rows)]
                part = batch.slice(first, rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(made + np.arange(rows)), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(edges)),
                    pa.array(total((log_count > 0).astype(np.int64))), pa.array(total(log_count)), pa.array(total(np.where(single >= 0, log_count, 0.0))),
                    pa.array(total(np.where(single >= 0, 0.0, vocabulary.log_totals[shape]))),
                    pa.array(bodies, pa.binary()), pa.ListArray.from_arrays(pa.array(cuts), pa.array(rest)),
                ], names)
                made += rows

    return run


ENCODED = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_head bigint, head double, own double, within double, "
    "classes binary, rest array<bigint>"
)


@dataclass(frozen=True)
class Model:
    start: np.ndarray  # state
    move: np.ndarray  # from, to
    emit: np.ndarray  # class, state


class _Layout:
    """Sequences side by side, longest first: step ``t`` of all that last so long is one slice."""

    def __init__(self, sequences: list[np.ndarray]):
        sizes = np.array([len(s) for s in sequences])
        self.order = np.argsort(-sizes, kind="stable")
        sizes = sizes[self.order]
        steps = int(sizes[0])
        self.active = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")
        self.edges = np.concatenate([[0], np.cumsum(self.active)])
        flat = np.concatenate([sequences[i] for i in self.order]).astype(np.int64)
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        time = np.arange(len(flat)) - np.repeat(begins, sizes)
        self.symbols = np.empty(len(flat), np.int64)
        self.symbols[self.edges[time] + np.repeat(np.arange(len(sizes)), sizes)] = flat

    def forward(self, model: Model, keep: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
        """Natural log likelihood of each sequence; the scaled forward values and scales on request."""
        emit = model.emit
        logs = np.zeros(len(self.order))
        alphas = np.empty((len(self.symbols), len(model.start)), emit.dtype) if keep else None
        scales = np.empty(len(self.symbols), emit.dtype) if keep else None
        alpha = None
        for t, m in enumerate(self.active):
            at = slice(self.edges[t], self.edges[t + 1])
            seen = emit[self.symbols[at]]
            alpha = seen * model.start if t == 0 else (alpha[:m] @ model.move) * seen
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            logs[:m] += np.log(scale)
            if keep:
                alphas[at], scales[at] = alpha, scale
        out = np.empty(len(self.order))
        out[self.order] = logs
        return out, alphas, scales


def expected_counts(sequences: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of the sequences under the model."""
    return _expected(sequences, model)[:3]


def _expected(sequences: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts and the log-likelihood."""
    layout = _Layout(sequences)
    logs, gamma, scales = layout.forward(model, keep=True)
    states = len(model.start)
    moves = np.zeros((states, states))
    beta = None
    for t in range(len(layout.active) - 1, -1, -1):
        m, at = layout.active[t], slice(layout.edges[t], layout.edges[t + 1])
        now = np.ones((m, states), gamma.dtype)
        if beta is not None:
            n, ahead = layout.active[t + 1], slice(layout.edges[t + 1], layout.edges[t + 2])
            pull = model.emit[layout.symbols[ahead]] * beta / scales[ahead][:, None]
            moves += gamma[at][:n].T @ pull
            now[:n] = pull @ model.move.T
        gamma[at] *= now
        beta = now
    emitted = np.stack([np.bincount(layout.symbols, gamma[:, k], len(model.emit)) for k in range(states)], axis=1)
    return gamma[:layout.active[0]].sum(axis=0, dtype=np.float64), moves * model.move, emitted, float(logs.sum())


def _maximised(start: np.ndarray, moves: np.ndarray, emitted: np.ndarray, prior: np.ndarray, novel: float) -> Model:
    """Most likely parameters; ``novel`` of each state's emissions follow the whole corpus, so that nothing is impossible."""
    emit = (1 - novel) * emitted / np.maximum(emitted.sum(axis=0), 1e-300) + novel * prior[:, None]
    return Model((start + 1) / (start + 1).sum(), (moves + 1) / (moves + 1).sum(axis=1, keepdims=True), emit / emit.sum(axis=0, keepdims=True))


def _pieces(bodies: Iterator[bytes]) -> Iterator[np.ndarray]:
    for body in bodies:
        classes = np.frombuffer(body, np.uint16)
        for at in range(0, len(classes), PIECE):
            yield classes[at:at + PIECE]


def _chunks(sequences: list[np.ndarray]) -> Iterator[list[int]]:
    """Numbers of sequences of about CHUNK tokens together, alike in length."""
    group, held = [], 0
    for i in sorted(range(len(sequences)), key=lambda i: -len(sequences[i])):
        if group and held + len(sequences[i]) > CHUNK:
            yield group
            group, held = [], 0
        group.append(i)
        held += len(sequences[i])
    if group:
        yield group


def _expectation(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """This task's sums: class -1 is the start, -2 - i the moves from state i; after these, the log-likelihood."""
        exact = Model(**shared.value)
        model = Model(*(x.astype(np.float32) for x in (exact.start, exact.move, exact.emit)))
        states = len(model.start)
        sums = [np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.shape), np.zeros(states)]
        held, tokens = [], 0

        def add():
            for group in _chunks(held):
                *parts, log = _expected([held[i] for i in group], model)
                for total, part in zip(sums, parts):
                    total += part
                sums[3][0] += log

        for batch in batches:
            for piece in _pieces(x.as_py() for x in batch.column("classes")):
                held.append(piece)
                tokens += len(piece)
            if tokens > HELD:
                add()
                held, tokens = [], 0
        add()
        rows = np.concatenate([sums[0][None, :], sums[1], sums[3][None, :], sums[2]])
        keys = np.concatenate([-1 - np.arange(states + 2), np.arange(len(sums[2]))])
        some = rows.any(axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[some].astype(np.int32)), *(pa.array(rows[some, k]) for k in range(states))], ["class", *(f"s{k}" for k in range(states))]
        )

    return run


def _score(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        held, rows, tokens = [], [], 0

        def scored() -> Iterator[pa.RecordBatch]:
            out = np.zeros(len(held))
            for group in _chunks(held):
                out[group] = _Layout([held[i] for i in group]).forward(model, keep=False)[0] / np.log(10)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(out)], ["row", "path"])

        for batch in batches:
            rows += batch.column("row").to_pylist()
            for body in batch.column("classes"):
                held.append(np.frombuffer(body.as_py(), np.uint16))
                tokens += len(held[-1])
            if tokens > HELD:
                yield from scored()
                held, rows, tokens = [], [], 0
        if held:
            yield from scored()

    return run


def _start(texts: list[bytes], prior: np.ndarray, novel: float, states: int) -> Model:
    """Baum-Welch on a few texts from random emissions."""
    random = np.random.default_rng(SEED)
    emit = prior[:, None] * random.lognormal(0, 1, (len(prior), states))
    model = Model(np.full(states, 1 / states), np.full((states, states), 0.1 / states) + 0.9 * np.eye(states), emit / emit.sum(axis=0))
    pieces = list(_pieces(iter(texts)))
    for _ in range(25 if pieces else 0):
        model = _maximised(*expected_counts(pieces, model), prior, novel)
    return model


def _start_pieces(learnt: DataFrame, vocabulary: Vocabulary) -> list[bytes]:
    """The pieces of training texts with the least hashes, wherever they stand in a text and however the table is split.

    Equal pieces count once, so a text with many copies does not fill the sample.
    """
    texts = vocabulary.weights[vocabulary.classes[np.searchsorted(vocabulary.words, END)]]
    share = int(min(1.0, 4 * START_PIECES / max(vocabulary.tokens / PIECE + texts, 1.0)) * 10**15)
    at = F.sequence(F.lit(0), F.floor((F.octet_length("classes") / 2 - 1) / PIECE).cast("int"))
    cut = F.transform(at, lambda i: F.substring("classes", i * (2 * PIECE) + 1, F.lit(2 * PIECE)))
    pieces = learnt.select(F.explode(cut).alias("piece")).withColumn("hash", F.xxhash64("piece", F.lit(SEED)))
    few = pieces.filter(F.pmod("hash", F.lit(10**15)) < share).distinct().orderBy("hash", "piece").limit(START_PIECES)
    return [bytes(r["piece"]) for r in few.collect()]


def score(
    docs: DataFrame, *, states: int = STATES, passes: int = PASSES, gain: float = GAIN, modulus: int = 7, held: int = 2,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    A text is learnt from unless the crc32 of its doc_id, as text, modulo
    ``modulus`` is ``held``; a null doc_id is learnt from. Null and empty texts are one
    end token. ``base_score`` is the add-one unigram model; ``score`` the log10
    probability under the hidden Markov model. Repeated rows are scored and counted
    each. An empty table gives an empty result; with nothing to learn from, every
    token is unseen. Only ``doc_id`` and ``text`` are read.
    """
    spark = arrow_batches(docs.sparkSession)
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(crc_remainder("doc_id", modulus) == held, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    counts = docs.filter("not held_out").mapInArrow(_training, "word bigint, shape int, n bigint")
    counts = staged(counts.groupBy("word").agg(F.first("shape").alias("shape"), F.sum("n").alias("n")), "word-counts")
    vocabulary = _vocabulary(counts)
    if not len(vocabulary.words):
        vocabulary = Vocabulary(np.array([END], WIDE), np.zeros(1), np.zeros(1, np.int64), np.zeros(SHAPES), np.ones(1 + SHAPES), 0, 0)
    encoded = staged(docs.mapInArrow(_encode(spark.sparkContext.broadcast(vars(vocabulary))), ENCODED), "encoded")

    learnt = encoded.filter("not held_out")
    prior = vocabulary.weights / vocabulary.weights.sum()
    # the share of new words among all tokens
    novel = (vocabulary.distinct + 1) / (vocabulary.tokens + vocabulary.distinct + 1)
    model = _start(_start_pieces(learnt, vocabulary), prior, novel, states)
    columns, last = [f"s{k}" for k in range(states)], None
    for _ in range(passes):
        parts = learnt.select("classes").mapInArrow(_expectation(spark.sparkContext.broadcast(vars(model))), f"class int, {', '.join(c + ' double' for c in columns)}")
        rows = parts.groupBy("class").agg(*(F.sum(c).alias(c) for c in columns)).collect()
        sums = np.zeros((2 + states + len(prior), states))
        for r in rows:
            sums[r["class"] + 2 + states if r["class"] >= 0 else -1 - r["class"]] = [r[c] for c in columns]
        model, log = _maximised(sums[0], sums[1:1 + states], sums[2 + states:], prior, novel), sums[1 + states][0]
        if last is not None and log - last < gain * abs(last):
            break
        last = log

    rest = encoded.select("row", F.explode("rest").alias("word")).join(counts.select("word", "n"), "word")
    rest = rest.groupBy("row").agg(F.sum(F.log10(F.col("n") + 1)).alias("rest"), F.count(F.lit(1)).alias("n_rest"))
    paths = encoded.select("row", "classes").mapInArrow(_score(spark.sparkContext.broadcast(vars(model))), "row bigint, path double")
    every = encoded.drop("rest", "classes").join(paths, "row").join(rest, "row", "left")
    rest_sum, log_all = F.coalesce("rest", F.lit(0.0)), float(np.log10(vocabulary.tokens + vocabulary.distinct + 1))
    return every.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("n_rest", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        (F.col("head") + rest_sum - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        (F.col("head") - F.col("own") + rest_sum - F.col("within") + F.col("path")).alias("score"),
    )
