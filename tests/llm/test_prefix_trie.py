import hashlib
import random
import zlib

import numpy as np
import pytest
import pyspark.sql.functions as F
from compare import differences
from samples import words

from skyline.llm import catalog, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _brute(rows):
    """Every node from the sequences themselves."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    made = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        # the remainder has the sign of the id
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        made[c] = tuple(own.get(base, [])[:h] + seq[h:])
    nodes = {}
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    out = set()
    for key, members in nodes.items():
        below = [k for k in nodes if k[:len(key)] == key]
        kids = [k for k in below if len(k) == len(key) + 1]
        leaves = [k for k in below if not any(m[:-1] == k for m in nodes if m)]
        saved = sum((len(nodes[k]) - 1) * len(words(k[-1][1])) for k in below if k)
        ends = ",".join(map(str, sorted(c for c in members if made[c] == key)))
        parent = min(nodes[key[:-1]]) if key else None
        out.add((min(members), len(key), parent, len(members), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _rows(df):
    got = [tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect()]
    assert len(got) == len(set(got))
    return set(got)


def _talks(rng, count, first=0):
    """Conversations that share beginnings of every length, some of them whole."""
    rows, known = [], [[]]
    for c in range(first, first + count):
        seq = list(rng.choice(known))
        seq = seq[:rng.randint(0, len(seq))] + [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b b", "c c c", "", None])) for _ in range(rng.randint(0, 4))]
        known.append(seq)
        # turns need neither begin at 0 nor be dense
        rows += [(c, 3 * i + c % 5, role, text) for i, (role, text) in enumerate(seq)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [prefix_trie.SHARD, 7])
def test_nodes_match_plain_sequences(spark, size):
    rows = _talks(random.Random(3), 260, first=-40)
    df = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(5), size=size)
    assert _rows(df) == _brute(rows)


def test_long_conversations_over_several_pieces(spark):
    """One conversation has most of the rows; another one is its copy, a third leaves it late."""
    long = [(0, i, "user", f"t {i % 7}") for i in range(2500)]
    copy = [(20, *r[1:]) for r in long]
    late = [(40, *r[1:]) for r in long[:2100]] + [(40, 2100, "user", "other end")]
    rows = long + copy + late
    got = {(r["conv_id"], r["depth"]): r for r in prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 2501 + 1
    root = got[0, 0]
    assert (root["n_convs"], root["n_leaves"], root["n_children"], root["parent_conv_id"]) == (3, 2, 1, None)
    assert root["saved_tokens"] == 2 * 2 * 2100 + 2 * 400
    assert got[0, 2100]["n_children"] == 2 and got[40, 2101]["parent_conv_id"] == 0 and got[0, 2500]["saved_tokens"] == 2
    assert got[0, 2500]["ends_sha256"] == hashlib.sha256(b"0,20").hexdigest()


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [(1, None, None, None), (1, None, None, None), (1, 2, "user", "x y"), (1, 2, "assistant", "x y"), (None, 0, "user", "lost"), (2, 0, "user", "\t \n"),
            (3, 5, "", ""), (22, 1, "user", "q " * 100_000), (23, 1, "user", "q " * 100_000), (7, 1, "user", "one")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit("x"), "p": F.lit(0), "words": F.lit(None), "size": F.lit(1)})
    assert _rows(prefix_trie.trie(df)) == _brute(rows)


def test_empty_and_turnless(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(c, 0, "user", "x") for c in range(1, 60) if zlib.crc32(str(c).encode()) % 4 and c % 20]
    got = _rows(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == _brute(rows) and len(got) == 1


def test_findclose_against_a_stack():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 300, 4000):
        sizes, shared, last = [], [], 0
        for _ in range(n):
            common = int(rng.integers(0, last + 1)) if sizes else 0
            last = common + int(rng.integers(1, 1 + (300 if rng.random() < 0.01 else 4)))
            sizes.append(last)
            shared.append(common)
        shard = prefix_trie.Shard(np.array(sizes, np.int64), np.array(shared, np.int64))
        stack, close = [], {}
        for i, bit in enumerate(shard.bits):
            if bit > 0:
                stack.append(i)
            else:
                close[stack.pop()] = i
        assert not stack
        assert shard.findclose(shard.opens).tolist() == [close[i] for i in shard.opens.tolist()]


def test_query_matches_sql(spark, root, duck):
    assert differences(catalog.op11_prefix_trie(spark, root), catalog.OP11_SQL, duck) == []
