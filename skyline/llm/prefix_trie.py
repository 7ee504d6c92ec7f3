"""The prefix trie of conversations, as balanced parentheses in shards.

A conversation is a sequence of turns; a trie node is a sequence of first turns that at
least one conversation begins with. A node's key is the exclusive-or of 128-bit hashes of
(place, turn) over its turns, so keys of long conversations are made piece by piece.

**What the table alone settles.** Members and ends of a node are counts by its key. A node with
one member has a single line of nodes below it and saves nothing. Only nodes with more
members, and the first node below them on each conversation, enter the trie.

**Shards.** Distinct sequences are range-partitioned and sorted; a task reads its range and cuts it
into shards of ``SHARD`` nodes. A shard is written as balanced parentheses: a node opens, holds its
subtree, and closes. The excess (open minus closed) has its least and greatest value noted for each
block of ``BLOCK`` parentheses, and for pairs of blocks, and so on; ``findclose`` looks for the first place after an
opening where the excess is one less, in the block, up the tree of blocks and down to the block
that has it. Between both ends lie the subtree's leaves, counted as ``()`` pairs by rank, and
its savings, by the difference of two running sums.

**Spines.** Neighbouring shards share the nodes that the last sequence of one and the first of the
next have in common, and only those. Both count them; one correction for each shared node and pair of
neighbours takes the second count away, and a sum by key merges the parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyline.llm.shared import arrow_batches, staged

#: Conversation ``c`` begins as the first of its ``FAMILY`` does, for up to ``HEADS - 1`` turns.
FAMILY, HEADS = 20, 4
#: Turn numbers, and turns, that are windowed at a time.
STRIDE = 1024
#: Nodes of a shard, parentheses of a block.
SHARD, BLOCK = 1 << 18, 64
#: Conversation ids whose digits are joined at a time.
IDS = 1 << 14
KEY = ["p", "q"]
LATE = -(1 << 63)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, a, b, words): turns in order from 1, with two hashes of (role, text).

    Places come from counts of ``STRIDE`` turn numbers each and a place among these, so a conversation of
    any length is dealt over many tasks.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    slim = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), text("role").alias("role"),
        F.xxhash64(text("role"), text("text")).alias("a"), F.xxhash64(F.lit(11), text("text"), text("role")).alias("b"),
        F.regexp_count(text("text"), F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint").alias("words"),
    )
    slim = staged(slim.withColumn("piece", F.coalesce(F.floor(F.col("turn") / STRIDE), F.lit(LATE))), "turns")
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = slim.groupBy("conv_id", "piece").agg(F.count(F.lit(1)).alias("held"))
    sizes = sizes.select("conv_id", "piece", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("conv_id", "piece").orderBy(F.asc_nulls_first("turn"), "role", "a", "b")
    placed = slim.withColumn("own", F.row_number().over(own)).join(sizes, ["conv_id", "piece"])
    return staged(placed.select("conv_id", (F.col("before") + F.col("own")).alias("place"), "a", "b", "words"), "placed")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, a, b, words) of every rebuilt conversation, and (conv_id, size) of all of them."""
    sizes = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    wanted = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))
    sizes = staged(sizes.select("conv_id", "own", base.alias("base"), wanted.alias("wanted")), "sizes")
    there = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    sizes = sizes.join(there, "base", "left").withColumn("taken", F.least("wanted", F.coalesce("there", F.lit(0))))
    sizes = sizes.withColumn("size", F.col("taken") + F.greatest(F.col("own") - F.col("wanted"), F.lit(0)))
    sizes = staged(sizes.select("conv_id", "base", "wanted", "taken", "size"), "rebuilt")
    heads = placed.filter(F.col("place") < HEADS).withColumnRenamed("conv_id", "base")
    heads = sizes.select("conv_id", "base", "taken").join(heads, "base").filter("place <= taken")
    heads = heads.select("conv_id", F.col("place").alias("depth"), "a", "b", "words")
    rest = placed.join(sizes.select("conv_id", "wanted", "taken"), "conv_id").filter("place > wanted")
    rest = rest.select("conv_id", (F.col("place") - F.col("wanted") + F.col("taken")).alias("depth"), "a", "b", "words")
    return heads.union(rest), sizes.select("conv_id", "size")


def prefixes(rows: DataFrame) -> DataFrame:
    """With the key (p, q) of the node that each turn leads to, and (up, uq) of the node it comes from."""
    own = {"x": F.xxhash64("depth", "a", "b"), "y": F.xxhash64("b", "depth", "a")}
    rows = rows.withColumns(own | {"piece": F.floor((F.col("depth") - 1) / STRIDE)})
    rows = staged(rows.drop("a", "b"), "salted")
    later = rows.filter("piece > 0").select("conv_id").distinct()
    sums = rows.join(later, "conv_id", "left_semi").groupBy("conv_id", "piece").agg(F.bit_xor("x").alias("sx"), F.bit_xor("y").alias("sy"))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "piece", F.bit_xor("sx").over(before).alias("sx"), F.bit_xor("sy").over(before).alias("sy"))
    upto = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"p": F.bit_xor("x").over(upto), "q": F.bit_xor("y").over(upto)}).join(sums, ["conv_id", "piece"], "left")
    whole = lambda own, earlier: F.col(own).bitwiseXOR(F.coalesce(earlier, F.lit(0)))
    rows = rows.withColumns({"p": whole("p", "sx"), "q": whole("q", "sy")})
    return rows.select("conv_id", "depth", "words", *KEY, F.col("p").bitwiseXOR(F.col("x")).alias("up"), F.col("q").bitwiseXOR(F.col("y")).alias("uq"))


class Shard:
    """Balanced parentheses of a trie of sorted, distinct, prefix-hashed sequences.

    Node 0 is the root. ``new[i]`` tells whether element ``i`` of the flat sequences is a node
    that the sequence before did not have; nodes are these elements in order.
    """

    def __init__(self, sizes: np.ndarray, shared: np.ndarray) -> None:
        """``sizes`` of the sequences, and how many first nodes each shares with the one before."""
        opened = sizes - shared
        ends = np.concatenate([[0], sizes[:-1]]) if len(sizes) else sizes
        steps = np.stack([ends - shared, opened], axis=1).reshape(-1) if len(sizes) else np.zeros(0, np.int64)
        signs = np.tile(np.array([-1, 1], np.int8), len(sizes))
        tail = int(sizes[-1]) if len(sizes) else 0
        self.bits = np.concatenate([[1], np.repeat(signs, steps), np.full(tail + 1, -1)]).astype(np.int8)
        self.opens = np.flatnonzero(self.bits > 0)
        self.excess = np.cumsum(self.bits, dtype=np.int64)
        blocks = -(-len(self.bits) // BLOCK)
        width = 1 << max(0, int(blocks - 1).bit_length())
        self._rows = np.full((width, BLOCK), np.iinfo(np.int64).max)
        self._rows.reshape(-1)[:len(self.bits)] = self.excess
        # least and greatest excess of a block, of two, of four, ...
        self._least = [self._rows.min(axis=1)]
        self._most = [np.where(self._rows < np.iinfo(np.int64).max, self._rows, -1).max(axis=1)]
        while len(self._least[-1]) > 1:
            self._least.append(self._least[-1].reshape(-1, 2).min(axis=1))
            self._most.append(self._most[-1].reshape(-1, 2).max(axis=1))

    def _has(self, level: int, node: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Whether the excess takes ``value`` below each node; it moves by one, so it takes all between least and greatest."""
        return (self._least[level][node] <= value) & (value <= self._most[level][node])

    def _inside(self, block: np.ndarray, after: np.ndarray, most: np.ndarray) -> np.ndarray:
        """First place of each block past ``after`` with an excess of ``most``; BLOCK if none."""
        out = np.empty(len(block), np.int64)
        for low in range(0, len(block), 1 << 14):
            part = slice(low, low + (1 << 14))
            hit = (self._rows[block[part]] == most[part, None]) & (np.arange(BLOCK) > after[part, None])
            out[part] = np.where(hit.any(axis=1), hit.argmax(axis=1), BLOCK)
        return out

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at ``at`` close."""
        most = self.excess[at] - 1
        block, inside = at // BLOCK, at % BLOCK
        found = self._inside(block, inside, most)
        open_ = np.flatnonzero(found == BLOCK)
        # up: to the first subtree on the right that goes as low
        node, level, want = block[open_].copy(), np.zeros(len(open_), np.int64), most[open_]
        target = np.full(len(open_), -1)
        for up, least in enumerate(self._least):
            todo = np.flatnonzero(target < 0)
            right = (node[todo] % 2 == 0) & (node[todo] + 1 < len(least))
            low = np.zeros(len(todo), bool)
            low[right] = self._has(up, node[todo[right]] + 1, want[todo[right]])
            target[todo[low]], level[todo[low]] = node[todo[low]] + 1, up
            node[todo] //= 2
        # down: left child if it goes as low
        for up in range(len(self._least) - 1, 0, -1):
            here = np.flatnonzero(level == up)
            left = target[here] * 2
            target[here] = np.where(self._has(up - 1, left, want[here]), left, left + 1)
            level[here] = up - 1
        out = block * BLOCK + found
        out[open_] = target * BLOCK + self._inside(target, np.full(len(target), -1), want)
        return out

    def subtrees(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(parent, children, leaves, sum of ``gains``) of every node."""
        close = self.findclose(self.opens)
        pairs = np.zeros(len(self.bits) + 1, np.int64)
        np.cumsum((self.bits[:-1] > 0) & (self.bits[1:] < 0), out=pairs[1:-1])
        pairs[-1] = pairs[-2]
        leaves = pairs[close + 1] - pairs[self.opens]
        sums = np.concatenate([[0], np.cumsum(gains)])
        first = np.arange(len(self.opens))
        # opened up to the close: the node's own number and its subtree's size
        after = (close + 1 + self.excess[close]) // 2
        # the parent is the last node before with a depth of one less
        depth, wide = self.excess[self.opens] - 1, len(first) + 1
        order = np.sort(depth * wide + first)
        parent = order[np.searchsorted(order, (depth - 1) * wide + first) - 1] % wide
        parent[0] = -1
        children = np.bincount(parent[1:], minlength=len(first))
        return parent, children, leaves, sums[after] - sums[first]


FIELDS = ["p", "q", "gain", "low"]
SHAPE = "p bigint, q bigint, parent_low bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, part int, edge string, seq array<struct<depth:bigint,p:bigint,q:bigint,gain:bigint,low:bigint>>"
SEQ = pa.list_(pa.struct([(name, pa.int64()) for name in ("depth", *FIELDS)]))


def _shared(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> int:
    """How many first nodes two sequences have in common."""
    size = min(len(a["p"]), len(b["p"]))
    same = (a["p"][:size] == b["p"][:size]) & (a["q"][:size] == b["q"][:size])
    return size if same.all() else int(same.argmin())


def _corrections(last: dict[str, np.ndarray], first: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """(p, q, children, leaves, savings) to add for the nodes that a shard's last and the next one's first sequence share, the root among them."""
    size = _shared(last, first)
    children = np.full(size + 1, -1)
    children[-1] = 0
    leaves = np.full(size + 1, -1 if size == len(last["p"]) else 0)
    gains = np.concatenate([[0], last["gain"][:size]])
    twice = np.cumsum(gains[::-1])[::-1]
    root = np.zeros(1, np.int64)
    return np.concatenate([root, last["p"][:size]]), np.concatenate([root, last["q"][:size]]), children, leaves, -twice


def _rows(p, q, low, children, leaves, saved) -> pa.RecordBatch:
    n = len(p)
    columns = [pa.array(x, pa.int64()) for x in (p, q)] + [low] + [pa.array(x, pa.int64()) for x in (children, leaves, saved)]
    columns += [pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, SEQ)]
    return pa.RecordBatch.from_arrays(columns, ["p", "q", "parent_low", "n_children", "n_leaves", "saved_tokens", "part", "edge", "seq"])


def _sharded(root_low: int, size: int = SHARD):
    """Rows of every shard of a sorted partition, corrections between its shards, and its first and last sequence."""

    def built(group: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        sizes = np.array([len(x["p"]) for x in group])
        flat = {name: np.concatenate([x[name] for x in group]) for name in FIELDS}
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        row = np.repeat(np.arange(len(group)), sizes)
        place = np.arange(len(row)) - starts[row]
        above = np.maximum(row - 1, 0)
        there = (row > 0) & (place < sizes[above])
        other = np.where(there, starts[above] + place, 0)
        same = there & (flat["p"] == flat["p"][other]) & (flat["q"] == flat["q"][other])
        shared = np.bincount(row[same], minlength=len(group))
        new = ~same
        node = {name: np.concatenate([[0], flat[name][new]]) for name in FIELDS}
        node["low"][0] = root_low
        parent, children, leaves, saved = Shard(sizes, shared).subtrees(node["gain"])
        low = pa.array(node["low"][parent], pa.int64(), mask=parent < 0)
        return _rows(node["p"], node["q"], low, children, leaves, saved)

    def edge(seq: dict[str, np.ndarray], name: str) -> pa.RecordBatch:
        value = [{"depth": 0} | {f: int(seq[f][i]) for f in FIELDS} for i in range(len(seq["p"]))]
        nothing = [pa.nulls(1, pa.int64())] * 6
        columns = [*nothing, pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name]), pa.array([value], SEQ)]
        return pa.RecordBatch.from_arrays(columns, _rows([], [], pa.nulls(0, pa.int64()), [], [], []).schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, last = [], 0, None
        for batch in batches:
            lists = batch.column(0)
            inside, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            fields = {name: inside.field(name).to_numpy(zero_copy_only=False) for name in FIELDS}
            for i in range(len(lists)):
                seq = {name: x[offsets[i]:offsets[i + 1]] for name, x in fields.items()}
                if last is None:
                    yield edge(seq, "first")
                if held and held + len(seq["p"]) > size:
                    yield built(group)
                    p, q, children, leaves, saved = _corrections(last, seq)
                    yield _rows(p, q, pa.nulls(len(p), pa.int64()), children, leaves, saved)
                    group, held = [], 0
                group.append(seq)
                held += len(seq["p"])
                last = seq
        if group:
            yield built(group)
            yield edge(last, "last")

    return run


def _corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of rows (last, first) of neighbouring partitions."""
    for batch in batches:
        for last, first in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = ({name: np.array([x[name] for x in seq], np.int64) for name in FIELDS} for seq in (last, first))
            p, q, children, leaves, saved = _corrections(a, b)
            yield _rows(p, q, pa.nulls(len(p), pa.int64()), children, leaves, saved)


def subtree_sums(sequences: DataFrame, root_low: int, size: int = SHARD) -> DataFrame:
    """(p, q, parent_low, n_children, n_leaves, saved_tokens) of every node of the trie of ``seq``."""
    spark = sequences.sparkSession
    ordered = sequences.select("seq").repartitionByRange("seq").sortWithinPartitions("seq")
    rows = staged(ordered.mapInArrow(_sharded(root_low, size), SHAPE), "shards")
    edges = rows.filter("edge is not null").select("part", "edge", "seq")
    # Partitions with rows are as many as partitions at most.
    parts = sorted(r["part"] for r in edges.filter("edge = 'last'").select("part").collect())
    found = rows.filter("edge is null").drop("part", "edge", "seq")
    if len(parts) > 1:
        follows = spark.createDataFrame(list(zip(parts, parts[1:])), "part int, then int")
        last = edges.filter("edge = 'last'").select("part", F.col("seq").alias("last"))
        first = edges.filter("edge = 'first'").select(F.col("part").alias("then"), F.col("seq").alias("first"))
        pairs = follows.join(last, "part").join(first, "then").select("last", "first")
        found = found.union(pairs.mapInArrow(_corrected, SHAPE).drop("part", "edge", "seq"))
    sums = [F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    return found.groupBy(*KEY).agg(F.max("parent_low").alias("parent_low"), *sums)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(p, q, sha) from rows (p, q, ids) sorted by key and block: SHA-256 of each key's ids, comma-joined."""
    key, sha, out = None, None, []
    made = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 3, (pa.int64(), pa.int64(), pa.string()))], [*KEY, "sha"])
    for batch in batches:
        for p, q, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (p, q) != key:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (p, q), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield made()
        out.clear()
    if key is not None:
        out.append((*key, sha.hexdigest()))
    yield made()


def end_digests(ends: DataFrame) -> DataFrame:
    """(p, q, sha) of the nodes at which more than one conversation ends, from (p, q, conv_id).

    A SHA-256 is made in one go, so the ids of a node meet in one task, but as texts of up to
    ``IDS`` ids that other tasks have joined, and the task holds one of them at a time.
    """
    block = ends.withColumn("block", F.shiftright("conv_id", IDS.bit_length() - 1)).groupBy(*KEY, "block").agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    joined = block.select(*KEY, "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    ordered = joined.repartition(*KEY).sortWithinPartitions(*KEY, "block").select(*KEY, "ids")
    return ordered.mapInArrow(_digests, "p bigint, q bigint, sha string")


def trie(conversations: DataFrame, size: int = SHARD) -> DataFrame:
    """Every node of the trie of rebuilt conversations.

    Returns (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    Turns are ordered by ``turn``, null first; turns with the same number by role, then by a hash of the
    text. Null roles and texts count as empty. Rows without a conv_id belong to no conversation and
    are left out. Repeated rows are turns of their own. A conversation that ends up without turns ends
    at the root. An empty table gives an empty result. Other columns than conv_id, turn, role and text
    are never read. What two or more conversations share from their start must fit a row.
    """
    spark = arrow_batches(conversations.sparkSession)
    rows, sizes = rebuilt(turns(conversations))
    rows = staged(prefixes(rows).join(sizes, "conv_id").withColumn("last", F.col("depth") == F.col("size")).drop("size"), "prefixes")

    member = F.when(F.col("last"), F.col("conv_id"))
    nodes = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("depth").alias("depth"), F.max("words").alias("words"),
        F.count(member).alias("n_ends"), F.min(member).alias("end"),
    )
    root = sizes.agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if(F.col("size") == 0).alias("n_ends"),
        F.min(F.when(F.col("size") == 0, F.col("conv_id"))).alias("end"),
    ).filter("n_convs > 0").select(F.lit(0).cast("bigint").alias("p"), F.lit(0).cast("bigint").alias("q"), "conv_id", "n_convs", F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("words"), "n_ends", "end")
    nodes = staged(nodes.union(root), "nodes")

    # the part of each conversation that others share, and the first node past it
    several = nodes.filter("n_convs > 1 and depth > 0").select(*KEY, ((F.col("n_convs") - 1) * F.col("words")).alias("gain"), F.col("conv_id").alias("low"))
    step = lambda gain, low: F.struct("depth", *KEY, gain.alias("gain"), low.alias("low"))
    met = rows.join(several, KEY, "left")
    alone = F.when(F.col("low").isNull(), step(F.lit(0).cast("bigint"), F.col("conv_id")))
    paths = met.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("low").isNotNull(), step(F.col("gain"), F.col("low"))))).alias("seq"), F.min(alone).alias("next")
    )
    paths = paths.select(F.when(F.col("next").isNull(), F.col("seq")).otherwise(F.array_append("seq", F.col("next"))).alias("seq"))
    end = F.element_at("seq", -1)
    paths = staged(paths.groupBy(end["p"].alias("p"), end["q"].alias("q")).agg(F.first("seq").alias("seq")), "paths")
    low = nodes.filter("depth = 0").select("conv_id").collect()
    sums = subtree_sums(paths, low[0]["conv_id"] if low else 0, size)

    ends = rows.filter("last").select(*KEY, "conv_id").union(sizes.filter("size = 0").select(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), "conv_id"))
    many = end_digests(ends.join(nodes.filter("n_ends > 1").select(*KEY), KEY, "left_semi"))

    found = nodes.join(sums, KEY, "left").join(many, KEY, "left")
    single = F.when(F.col("n_ends") > 0, F.col("end").cast("string")).otherwise(F.lit(""))
    below = F.when(F.col("n_convs") > 1, F.coalesce("n_children", F.lit(0))).otherwise(F.when(F.col("n_ends") > 0, F.lit(0)).otherwise(F.lit(1)))
    return found.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_low", "conv_id")).alias("parent_conv_id"), "n_convs",
        below.cast("bigint").alias("n_children"), F.coalesce("n_leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("bigint").alias("saved_tokens"),
        F.coalesce("sha", F.sha2(single.cast("binary"), 256)).alias("ends_sha256"),
    )
