"""Near-duplicates by Order MinHash, verified by banded alignment.

A text's k-mers are its words, each labelled with its occurrence
number, so that a repeated word counts as often as it occurs. Each of
``SKETCHES`` hash functions picks the ``PICKED`` least labelled k-mers of a text;
the picked k-mers in text order make one sketch. Two texts share a sketch only
if they share k-mers *in the same order*, which follows edit similarity. Single words and four picks tell
a pair at the threshold, which shares two words of three, from texts with a passage in common; the tests state it.

A set is all texts with one sketch, whatever its size. Texts are candidates if they share ``AGREE`` sketches; for
texts of fewer than ``SHORT`` words one is enough. All candidates are linked to one another or compared, in this order:

1. with the set's centre, the text whose sketches are shared most; each text with its best
   centre first, and with others only if links do not join them already;
2. the texts outside the set's largest part with one text of that part;
3. every two candidates that no links join yet.

Lengths and tallies rule pairs out before any text is fetched. A tally counts a text's words by ``BINS`` hash bins; kept of
it is one bit for each bin and each of ``LEVELS`` that its count reaches. A bit that only one of two texts has stands for a word
without a partner, which is an edit. In the last step a text leaves out sets where no other text has a fitting length, and is
dealt to all of its sets but the two largest: two texts that share three sets share one of the others.
A comparison aligns the two word sequences
inside a diagonal band wide enough for the threshold, so for a candidate a similarity of at least ``SIMILARITY`` is
found exactly. Everything is keyed by the digest of the whole text: copies are one text, and a
doc_id that occurs with several texts takes part with each of them.

Edit similarity is ``1 - edits / words of the longer text``, edits being single
words inserted, deleted or replaced; A-Z count as lower case.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyline.llm import bitfilter
from skyline.llm.components import components
from skyline.llm.hashing import BASE, BLANKS, WIDE, mix, shingle_hashes, text_bytes, word_hashes
from skyline.llm.shared import arrow_batches, staged

K = 1
SKETCHES = 48
PICKED = 4
SIMILARITY = 0.8
SEED = 17
#: Sketches that candidates share, and words below which one is enough.
AGREE, SHORT = 3, 24
#: Bins of a tally, and the counts that are told apart.
BINS, LEVELS = 1024, (1, 2, 4)
#: Bits of a set's key that stay beside its size.
KEY_BITS = 44
_LOW = WIDE(0xFFFFFFFF)
_TOP = WIDE(0xFFFFFFFFFFFFFFFF)


def _occurrences(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How often each k-mer has occurred in its row before."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((grams, rows))
    g, r = grams[order], rows[order]
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    place = np.arange(len(g))
    since = place - np.maximum.accumulate(np.where(fresh, place, 0))
    out = np.empty(len(g), np.int64)
    out[order] = since
    return out


def sketch(hashes: np.ndarray, bounds: np.ndarray, k: int = K, sketches: int = SKETCHES, picked: int = PICKED) -> np.ndarray:
    """One row of sketches for each row with at least one word."""
    grams, edges, _ = shingle_hashes(hashes, bounds, k)
    full = np.flatnonzero(np.diff(edges))
    if not len(full):
        return np.zeros((0, sketches), WIDE)
    # A run of fewer than k words must not equal the start of a longer text.
    begins, sizes = edges[full], np.diff(edges)[full]
    labelled = mix(grams ^ mix(_occurrences(grams, edges).astype(WIDE) + WIDE(1)))
    at = np.arange(len(grams), dtype=WIDE)
    factors = mix(np.arange(1, sketches + 1, dtype=WIDE) * WIDE(BASE) + WIDE(SEED)) | WIDE(1)
    out = np.empty((len(full), sketches), WIDE)
    span = WIDE(1) << WIDE(32)
    assert len(grams) < int(span)
    for j in range(sketches):
        order = ((labelled * factors[j]) & ~_LOW) | at
        found = np.empty((len(full), picked), np.int64)
        for n in range(picked):
            least = (np.minimum.reduceat(order, begins) & _LOW).astype(np.int64)
            found[:, n] = np.where(sizes > n, least, -1)
            order[np.where(sizes > n, least, begins)] = _TOP
        found.sort(axis=1)
        value = np.full(len(full), factors[j], WIDE)
        for n in range(picked):
            gram = np.where(found[:, n] < 0, WIDE(0), grams[found[:, n]])
            value = mix(value * WIDE(BASE) + gram)
        out[:, j] = value
    return out


def _tallied(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many words each row has in each bin."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    bins = (hashes & WIDE(BINS - 1)).astype(np.int64)
    return np.bincount(rows * BINS + bins, minlength=(len(bounds) - 1) * BINS).reshape(-1, BINS)


def _marked(tallies: np.ndarray) -> np.ndarray:
    """The levels that each bin reaches, as rows of 64-bit values.

    If a bit is set in one row and not in another, the first has a word in that bin more than the other;
    of the bits of one bin, each stands for another word.
    """
    return np.concatenate([np.packbits(tallies >= level, axis=1).view(np.int64) for level in LEVELS], axis=1)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest, words, sketches, bits) of every row."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        digests = [hashlib.md5(data[offsets[i]:offsets[i + 1]], usedforsecurity=False).digest() for i in range(batch.num_rows)]
        words, made, sizes = np.zeros(batch.num_rows, np.int32), [], np.zeros(batch.num_rows, np.int64)
        width = BINS * len(LEVELS) // 64
        bits = np.zeros((batch.num_rows, width), np.int64)
        for first, bounds, hashes in word_hashes(batch.column("text"), BLANKS):
            count = np.diff(bounds)
            words[first:first + len(count)] = count
            rows = sketch(hashes, bounds)
            made.append(rows)
            sizes[first:first + len(count)] = np.where(count > 0, SKETCHES, 0)
            bits[first:first + len(count)] = _marked(_tallied(hashes, bounds))
        flat = np.concatenate(made).reshape(-1) if made else np.zeros(0, WIDE)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat.view(np.int64)))
        binned = pa.ListArray.from_arrays(pa.array(np.arange(0, bits.size + 1, width, dtype=np.int32)), pa.array(bits.reshape(-1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(words), lists, binned],
            ["doc_id", "digest", "words", "sketches", "bits"],
        )


def edits_within(a: list[np.ndarray], b: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """Edit distances of pairs of sequences, exact up to ``most`` each; larger ones give ``most + 1``.

    All pairs advance together through the rows of a diagonal band of
    ``max(most)`` cells to either side.
    """
    pairs, t = len(a), int(most.max())
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    width, rows = 2 * t + 1, int(na.max(initial=0))
    left = np.zeros((rows, pairs), WIDE)
    right = np.full((pairs, rows + 2 * t + 2), _TOP)
    for p in range(pairs):
        left[:na[p], p] = a[p]
        end = min(nb[p], right.shape[1] - t)
        right[p, t:t + end] = b[p][:end]
    far = np.int32(1 << 28)
    step = np.arange(width, dtype=np.int32)
    # cell c of row i is column i + c - t of the table
    now = np.where(step >= t, step - t, far).astype(np.int32)[None, :].repeat(pairs, 0)
    result = np.where(na == 0, nb, far)
    for i in range(1, rows + 1):
        change = right[:, i - 1:i - 1 + width] != left[i - 1][:, None]
        nxt = now + change
        nxt[:, :-1] = np.minimum(nxt[:, :-1], now[:, 1:] + 1)
        if i <= t:
            nxt[:, :t - i] = far
            nxt[:, t - i] = i
        nxt = np.minimum.accumulate(nxt - step, axis=1) + step
        now = nxt
        done = np.flatnonzero(na == i)
        if len(done):
            gap = nb[done] - i + t
            inside = (gap >= 0) & (gap < width)
            result[done[inside]] = now[done[inside], gap[inside]]
    return np.minimum(result, most + 1)


def _trim(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without their common beginning and end, which never change the distance."""
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    begin = int(differ[0]) if len(differ) else short
    a, b = a[begin:], b[begin:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    end = int(differ[0]) if len(differ) else short
    return a[:len(a) - end], b[:len(b) - end]


def similar(a: list[np.ndarray], b: list[np.ndarray], least: float = SIMILARITY) -> np.ndarray:
    """Whether each pair of word sequences has an edit similarity of at least ``least``."""
    longer = np.array([max(len(x), len(y)) for x, y in zip(a, b)])
    most = np.floor((1 - least) * longer + 1e-9).astype(np.int64)
    yes = np.zeros(len(a), bool)
    open_, cut = [], {}
    for p, (x, y) in enumerate(zip(a, b)):
        if abs(len(x) - len(y)) > most[p]:
            continue
        # every word of the longer text without a partner costs one edit at least
        values, counts = np.unique(x, return_counts=True)
        others, times = np.unique(y, return_counts=True)
        _, i, j = np.intersect1d(values, others, assume_unique=True, return_indices=True)
        if longer[p] - np.minimum(counts[i], times[j]).sum() > most[p]:
            continue
        cut[p] = _trim(x, y)
        if max(len(cut[p][0]), len(cut[p][1])) <= most[p]:
            yes[p] = True
        else:
            open_.append(p)
    # narrow bands first: most near copies differ in a few words
    band = 16
    while open_:
        left = []
        open_.sort(key=lambda p: len(cut[p][0]))
        at = 0
        while at < len(open_):
            size = max(1, min(64, 4_000_000 // ((2 * band + 1) * 8), 8_000_000 // max(1, len(cut[open_[at]][0]))))
            group = open_[at:at + size]
            at += size
            limit = np.minimum(most[group], band)
            found = edits_within([cut[p][0] for p in group], [cut[p][1] for p in group], limit)
            for p, d, m in zip(group, found, limit):
                if d <= m:
                    yes[p] = True
                elif m < most[p]:
                    left.append(p)
        open_, band = left, band * 4
    return yes


def _word_rows(column: pa.Array) -> list[np.ndarray]:
    out = []
    for _, bounds, hashes in word_hashes(column, BLANKS):
        out += [hashes[bounds[i]:bounds[i + 1]] for i in range(len(bounds) - 1)]
    return out


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array(similar(_word_rows(batch.column("left")), _word_rows(batch.column("right")), least))
            yield batch.select(["a", "b"]).filter(keep)

    return run


class _Links:
    """Verified links so far, the parts they join, and the pairs that were compared."""

    def __init__(self, docs: DataFrame, least: float) -> None:
        self.least = least
        digest = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("digest")
        self.bodies = docs.select(digest, F.coalesce("text", F.lit("")).alias("text"))
        self.found: DataFrame | None = None
        self.tried: DataFrame | None = None
        self.parts: DataFrame | None = None

    def labelled(self, rows: DataFrame, column: str, name: str) -> DataFrame:
        """With the part of the text in ``column``."""
        if self.parts is None:
            return rows.withColumn(name, F.col(column))
        return rows.join(self.parts.select(F.col("node").alias(column), F.col("component").alias(name)), column, "left").withColumn(name, F.coalesce(name, column))

    def compare(self, pairs: DataFrame) -> None:
        """Verify pairs (a, b) with their lengths (wa, wb) whose texts lie in different parts, once each."""
        pairs = pairs.filter(_fits(F.col("wa"), F.col("wb"), self.least)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tried is not None:
            pairs = self.labelled(self.labelled(pairs, "a", "pa"), "b", "pb").filter("pa <> pb").select("a", "b")
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        self.tried = pairs if self.tried is None else self.tried.union(pairs)
        if pairs.isEmpty() and self.found is not None:
            return
        # only the bodies that these pairs need are moved
        needed = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
        bodies = self.bodies.filter(_named_in(needed)("digest")).dropDuplicates(["digest"])
        left = bodies.select(F.col("digest").alias("a"), F.col("text").alias("left"))
        right = bodies.select(F.col("digest").alias("b"), F.col("text").alias("right"))
        # a pair is small before the join and long to align after it
        made = staged(_dealt(pairs, "a", "b").join(left, "a").join(right, "b").mapInArrow(_verify(self.least), "a binary, b binary"), "links")
        known = self.found
        self.found = made if known is None else known.union(made)
        if known is None or not made.isEmpty():
            self.parts = components(self.found, "a", "b")


def _named_in(texts: DataFrame):
    """A function of digests: whether ``texts`` names them in ``digest``. Few others pass; only digests go to Python."""
    chosen = bitfilter.build(texts.select(low_half("digest").alias("half")))

    @F.arrow_udf("boolean")
    def named(digests: pa.Array) -> pa.Array:
        return pa.array(bitfilter.contains(chosen, np.frombuffer(b"".join(digests.to_pylist()), np.int64)[::2]))

    return named


def low_half(column: str) -> Column:
    """The first eight bytes of a digest as they lie in memory, as a number."""
    swapped = F.concat(*[F.substring(F.hex(column), 2 * i + 1, 2) for i in reversed(range(8))])
    return F.conv(swapped, 16, -10).cast("bigint")


def _fits(a: Column, b: Column, least: float) -> Column:
    """Whether texts of so many words can be alike."""
    return F.abs(a - b) <= (1 - least) * F.greatest(a, b) + 1e-9


def _dealt(rows: DataFrame, *columns: str) -> DataFrame:
    """Dealt by these columns. With a given number of partitions, later steps by the same columns need no further shuffle, and few rows are not merged."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def _shared(rows: DataFrame) -> DataFrame:
    """The rows of sets with two texts or more, and the set's ``size``."""
    size = F.count(F.lit(1)).over(Window.partitionBy("key"))
    return staged(_dealt(rows, "key").withColumn("size", size).filter("size > 1"), "shared")


def _centres(rows: DataFrame) -> DataFrame:
    """(a, b, wa, wb, n): each text with each centre of its sets, and how many of these sets there are."""
    centre = rows.groupBy("key").agg(F.max(F.struct("fame", "digest", "words")).alias("top"))
    met = rows.join(centre.select("key", F.col("top.digest").alias("a"), F.col("top.words").alias("wa")), "key").filter("a <> digest")
    counted = met.groupBy("a", F.col("digest").alias("b")).agg(F.first("wa").alias("wa"), F.first("words").alias("wb"), F.count(F.lit(1)).alias("n"))
    return staged(counted, "met")


def _open(rows: DataFrame, links: _Links) -> DataFrame:
    """The rows of sets that links have not made one, with their ``part``, the set's ``size`` and its largest part, ``main``."""
    rows = _dealt(links.labelled(rows.select("key", "digest", "words"), "digest", "part"), "key")
    parts = rows.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    sets = parts.groupBy("key").agg(F.max(F.struct("n", "part")).alias("most"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("size"))
    return rows.join(sets.filter("parts > 1").select("key", "size", F.col("most.part").alias("main")), "key")


def _in_reach(rows: DataFrame, least: float) -> DataFrame:
    """The rows whose set has another text of a fitting length. The next shorter and the next longer text tell."""
    by_length = Window.partitionBy("key").orderBy("words")
    beside = rows.withColumn("below", F.lag("words").over(by_length)).withColumn("above", F.lead("words").over(by_length))
    fits = _fits(F.col("words"), F.col("below"), least) | _fits(F.col("words"), F.col("above"), least)
    return beside.filter(fits).drop("below", "above")


def _met_again(rows: DataFrame) -> DataFrame:
    """(a, b, wa, wb, n): each text outside its set's largest part with one text of that part, and how many sets bring them together."""
    one = F.max(F.struct(F.xxhash64("digest"), "digest", "words")).alias("one")
    picked = rows.filter("part = main").groupBy("key").agg(one).select("key", F.col("one.digest").alias("a"), F.col("one.words").alias("wa"))
    others = rows.filter("part <> main").select("key", F.col("digest").alias("b"), F.col("words").alias("wb"))
    met = others.join(picked, "key").groupBy("a", "b")
    return met.agg(F.first("wa").alias("wa"), F.first("wb").alias("wb"), F.count(F.lit(1)).alias("n"))


def _agreed(met: DataFrame) -> DataFrame:
    """The pairs (a, b, wa, wb, n) that are candidates by their ``n`` common sets."""
    return met.filter((F.col("n") >= AGREE) | (F.least("wa", "wb") < SHORT))


def _is_short(words: Column, least: float) -> Column:
    """Whether a text can be a candidate of one with fewer than ``SHORT`` words."""
    return words * least < SHORT


def _candidates(rows: DataFrame, profile: DataFrame, least: float) -> DataFrame:
    """Every two candidates that no links join and whose tallies allow ``least``; each pair comes from one of its sets only."""
    # A set's number begins with its size, so that all texts have their sets in one order, small ones first.
    size = F.least(F.col("size"), F.lit(1 << (62 - KEY_BITS)))
    number = F.shiftleft(size, KEY_BITS).bitwiseOR(F.col("key").bitwiseAND(F.lit((1 << KEY_BITS) - 1)))
    sets = F.array_sort(F.collect_list(F.struct(number.alias("number"), "main"))).alias("sets")
    held = rows.groupBy("digest").agg(F.first("part").alias("part"), F.first("words").alias("words"), sets)
    held = held.filter((F.size("sets") >= AGREE) | _is_short(F.col("words"), least))
    # all sets of two texts in different parts are open, so their open sets tell how many they share
    dealt = F.when(_is_short(F.col("words"), least), F.size("sets")).otherwise(F.size("sets") - (AGREE - 1))
    bits = profile.select("digest", "bits").dropDuplicates(["digest"])
    held = held.join(bits, "digest").select(
        "digest", "part", "words", "bits", F.col("sets.number").alias("numbers"), F.explode(F.slice("sets", F.lit(1), dealt)).alias("set"))
    held = staged(held.select("set.number", "set.main", "digest", "part", "words", "bits", "numbers"), "held")
    a, b = held.alias("a"), held.filter("part <> main").alias("b")
    longer, shared = F.greatest("a.words", "b.words"), F.array_intersect("a.numbers", "b.numbers")
    most = F.floor((1 - least) * longer + 1e-9)
    met = (
        (F.col("a.number") == F.col("b.number")) & (F.col("a.part") != F.col("b.part"))
        & ((F.col("a.part") == F.col("a.main")) | (F.col("a.digest") < F.col("b.digest")))
        & (F.abs(F.col("a.words") - F.col("b.words")) <= most)
        & (F.array_min(shared) == F.col("a.number"))
        & ((F.size(shared) >= AGREE) | (F.least("a.words", "b.words") < SHORT))
        & (_alone("a.bits", "b.bits") <= most) & (_alone("b.bits", "a.bits") <= most)
    )
    return a.join(b, met).select(F.col("a.digest").alias("a"), F.col("b.digest").alias("b"), F.col("a.words").alias("wa"), F.col("b.words").alias("wb"))


def _alone(a: str, b: str) -> Column:
    """The number of bits that only ``a`` has; so many words of that text at least have no partner in the other."""
    only = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return F.aggregate(only, F.lit(0), lambda total, x: total + x)


def classes(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest) of every row, and (digest, part, n_links) of every distinct text.

    ``part`` is the least digest of the text's class, ``n_links`` the number of verified links at the text.
    """
    arrow_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, digest binary, words int, sketches array<bigint>, bits array<bigint>"
    profile = staged(docs.mapInArrow(_profile, schema), "profile")
    texts = profile.dropDuplicates(["digest"]).select("digest", "words", "sketches")
    rows = texts.select("digest", "words", F.posexplode("sketches").alias("place", "sketch"))
    rows = _shared(rows.select(F.xxhash64("place", "sketch").alias("key"), "digest", "words"))
    each = rows.groupBy("digest").agg(F.sum("size").alias("fame"), F.count(F.lit(1)).alias("n"), F.first("words").alias("words"))
    each = staged(each.filter((F.col("n") >= AGREE) | _is_short(F.col("words"), least)).select("digest", "fame"), "fame")
    rows = staged(rows.join(each, "digest"), "ranked")
    links = _Links(docs, least)

    met = _agreed(_centres(rows))
    best = met.groupBy("b").agg(F.max(F.struct("n", "a", "wa", "wb")).alias("best")).select("b", "best.a", "best.wa", "best.wb")
    links.compare(best)
    links.compare(met)
    rows = staged(_open(rows, links), "open")
    links.compare(_agreed(_met_again(rows)))
    rows = staged(_in_reach(_open(rows, links), least), "reach")
    links.compare(_candidates(rows, profile, least))

    counts = links.found.select(F.explode(F.array("a", "b")).alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("n_links"))
    named = links.labelled(texts.select("digest"), "digest", "part").join(counts, "digest", "left")
    return profile.select("doc_id", "digest"), staged(named.withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("bigint")), "classes")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, n_links) of every row; the class's least doc_id, and the verified links at the row's text.

    Texts that are equal, or linked by similar texts, form one class. A null text
    counts as empty, and all texts without a word that are equal form one class.
    A text of one word has one k-mer, that word. Rows with the same doc_id and different
    texts belong to the classes of their texts. A row without a doc_id takes part; a class without any
    doc_id has a null class_id. An empty table gives an empty result. Columns
    other than ``doc_id`` and ``text`` are never read.
    """
    member, named = classes(docs, least)
    rows = staged(member.join(named, "digest"), "members")
    heads = rows.groupBy("part").agg(F.min("doc_id").alias("class_id"))
    return rows.join(heads, "part").select("doc_id", "class_id", "n_links")


def deduplicated(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each class, with all its columns: the one with the least doc_id, null last.

    If that id occurs with several texts of the class, the least digest of these stays, and one of the rows with both equal.
    """
    member, named = classes(docs, least)
    rows = staged(member.join(named.select("digest", "part"), "digest"), "members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    heads = rows.groupBy("part").agg(first, F.count(F.lit(1)).alias("n")).select("part", "first.doc_id", "first.digest", "n")
    heads = staged(heads, "heads")
    gone = staged(rows.join(heads.select("digest"), "digest", "left_anti").select(F.col("digest").alias("__digest")).distinct(), "gone")
    copied = rows.join(heads.select("digest", F.col("doc_id").alias("keep_id")), "digest").groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.first("keep_id").alias("keep_id")).filter("n > 1")
    copied = staged(copied.select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep_id")), "copied")
    marked = docs.withColumn("__digest", F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))))
    # most rows are the only one of their text and class; they are told by their digest, and not moved
    named = _named_in(gone.union(copied.select("__digest")).withColumnRenamed("__digest", "digest"))
    alone = marked.filter(~named("__digest")).select(*docs.columns)
    left = marked.filter(named("__digest")).join(gone, "__digest", "left_anti")
    alone = alone.union(left.join(copied, "__digest", "left_anti").select(*docs.columns))
    same = left.join(copied, "__digest").filter(F.col("doc_id").cast("bigint").eqNullSafe(F.col("__keep_id")))
    return alone.union(same.dropDuplicates(["__digest"]).select(*docs.columns))
