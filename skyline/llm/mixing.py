"""Token budgets for sources by a tree of weights, and the documents that fill them.

The tree has three levels: domain, language, source. A node's budget is shared by its
children in proportion to their weights. A child can take no more than its documents
hold in ``max_epochs`` passes; what it leaves goes to its siblings, again by weight,
and only what all of them together cannot take never reaches their parent in the first
place, so that it goes to the parent's siblings. Each leaf then reads its documents in
a seeded order, a new order each epoch: whole epochs first, then the prefix of the next
one that still fits the budget.

Budgets are whole tokens; the few tokens lost to rounding down stay unspent.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyline.llm.line_rules import BLANK
from skyline.llm.shared import staged

LEVELS = ("domain", "lang", "source")
LEAF = [f"__{x}" for x in LEVELS]
#: Digits of the order's hash that split a leaf, so that no task orders a whole one.
PREFIX = 3
MISSING = "unknown"


@dataclass(frozen=True)
class Mix:
    """Weights are whole numbers; a name without one has ``other``."""

    domain: Column
    domain_weights: Mapping[str, int]
    lang_weights: Mapping[str, int]
    source_weights: Mapping[str, int] = field(default_factory=dict)
    other: int = 1
    #: Share of all tokens to hand out, in percent; over 100 asks for repeats.
    percent: int = 80
    max_epochs: int = 2
    seed: int = 7


def _weight(name: str, weights: Mapping[str, int], other: int) -> Column:
    if not weights:
        return F.lit(other).cast("bigint")
    table = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
    return F.coalesce(F.element_at(table, F.col(name)), F.lit(other)).cast("bigint")


def _shared(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children`` (parent, name, weight, room, budget of the parent) with ``own``, each child's budget."""
    wide = lambda x: F.col(x).cast("decimal(38,0)")
    order = Window.partitionBy(*parent).orderBy((F.col("room") / F.col("weight")).asc_nulls_last(), name)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(*parent)
    left = F.greatest(wide("budget") - F.coalesce(F.sum("room").over(before), F.lit(0)), F.lit(0))
    full = wide("room") * F.sum("weight").over(after) <= left * wide("weight")
    made = children.withColumn("full", (F.col("weight") > 0) & full)
    made = made.withColumn("spent", F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(every), F.lit(0)))
    made = made.withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(every))
    part = F.expr("(budget - spent) * weight div open")
    own = F.when(F.col("full"), F.col("room")).when(F.col("weight") > 0, part).otherwise(0)
    return made.withColumn("own", F.coalesce(own, F.lit(0)).cast("bigint")).drop("full", "spent", "open")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(__domain, __lang, __source, tokens, budget) from (__domain, __lang, __source, tokens).

    The windows run over the rows of the tree, of which there is one for each source.
    """
    domain, lang, source = LEAF
    rooms = leaves.withColumn("room", F.col("tokens") * mix.max_epochs)
    total = leaves.agg((F.sum("tokens") * mix.percent).alias("all")).select(F.expr("coalesce(all div 100, 0L)").alias("budget"))
    top = rooms.groupBy(domain).agg(F.sum("room").alias("room")).withColumn("root", F.lit(0))
    top = top.withColumn("weight", _weight(domain, mix.domain_weights, mix.other))
    top = _shared(top.join(total.withColumn("root", F.lit(0)), "root"), ["root"], domain)
    middle = rooms.groupBy(domain, lang).agg(F.sum("room").alias("room")).withColumn("weight", _weight(lang, mix.lang_weights, mix.other))
    middle = _shared(middle.join(top.select(domain, F.col("own").alias("budget")), domain), [domain], lang)
    low = rooms.withColumn("weight", _weight(source, mix.source_weights, mix.other))
    low = _shared(low.join(middle.select(domain, lang, F.col("own").alias("budget")), [domain, lang]), [domain, lang], source)
    return low.select(*LEAF, "tokens", F.col("own").alias("budget"))


def _leaf_columns(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` with its leaf and ``__tokens``, the words of its text."""
    named = lambda x: F.coalesce(x.cast("string"), F.lit(MISSING))
    tokens = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(BLANK.replace("[", "[^")))
    return docs.withColumns({
        "__domain": named(mix.domain), "__lang": named(F.col("lang")), "__source": named(F.col("source")),
        "__tokens": tokens.cast("bigint"), "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
    })


def _order(mix: Mix, epoch: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(mix.seed)), epoch.cast("string"), F.col("__id")).cast("binary"))


def plan(docs: DataFrame, mix: Mix) -> DataFrame:
    """For each leaf: budget, whole ``epochs``, and the last hash, ``cut``, of the next epoch's prefix."""
    small = staged(_leaf_columns(docs, mix).select(*LEAF, "__tokens", "__id"), "tokens")
    leaves = small.groupBy(*LEAF).agg(F.sum("__tokens").alias("tokens"))
    made = budgets(leaves, mix).withColumn("epochs", F.expr("coalesce(budget div nullif(tokens, 0), 0L)"))
    made = staged(made.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")), "leaves")

    placed = small.join(made.select(*LEAF, "epochs", "rest"), LEAF).withColumn("hash", _order(mix, F.col("epochs")))
    placed = placed.withColumn("bucket", F.substring("hash", 1, PREFIX))
    sums = placed.groupBy(*LEAF, "rest", "bucket").agg(F.sum("__tokens").alias("held"))
    upto = Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("sum", F.sum("held").over(upto)).filter(F.col("sum") > F.col("rest"))
    edge = sums.groupBy(*LEAF).agg(F.min(F.struct("bucket", (F.col("sum") - F.col("held")).alias("before"))).alias("edge"))
    edge = staged(edge.select(*LEAF, "edge.bucket", "edge.before"), "edges")
    inside = placed.join(edge, [*LEAF, "bucket"])
    upto = Window.partitionBy(*LEAF).orderBy("hash").rangeBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("sum", F.col("before") + F.sum("__tokens").over(upto)).filter(F.col("sum") <= F.col("rest"))
    cuts = edge.join(inside.groupBy(*LEAF).agg(F.max("hash").alias("hash")), LEAF, "left")
    cuts = cuts.select(*LEAF, F.coalesce("hash", "bucket").alias("cut"))
    return staged(made.join(cuts, LEAF, "left"), "plan")


def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The documents to read, with ``copies``, how many times, and the columns of ``docs``.

    Needs doc_id, text, lang and source. Null languages, sources and domains count as
    ``unknown``. Null texts hold no token. Rows with equal ids are taken or left together; a
    null id counts as empty text. A leaf without tokens has no budget; documents without tokens are
    taken where they lie in the prefix. An empty table gives an empty result.
    """
    leaves = plan(docs, mix)
    rows = _leaf_columns(docs, mix).join(leaves.select(*LEAF, "epochs", "cut"), LEAF)
    extra = F.when(_order(mix, F.col("epochs")) <= F.col("cut"), F.lit(1)).otherwise(0)
    copies = (F.col("epochs") + extra).cast("bigint")
    return rows.withColumn("__copies", copies).filter("__copies > 0").select(
        *(F.col(c) for c in docs.columns if c not in ("copies", "domain", "n_tokens")),
        F.col("__domain").alias("domain"), F.col("__tokens").alias("n_tokens"), F.col("__copies").alias("copies"),
    )
