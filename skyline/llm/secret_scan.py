"""Secrets in texts, with weak candidates confirmed by the parts near them.

Strong spans stand alone: assignments to a secret's name, access identifiers and
long hexadecimal strings. Weak ones are short, generic or public: account names,
generic keys and short hexadecimal strings, addresses of services. A weak span is
reported only if a complementary part lies within ``WINDOW`` code points of it in the
same text: an account or an address needs a secret, a weak secret needs an account
or an address. The nearness test is an interval join on text and position bin.

All positions are code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyline.llm.shared import staged

WINDOW = 200
MARK = "<redacted>"

# The strong kinds, in the order of reports, with the least length of what counts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# The weak kinds.
ACCOUNT = r"""(?i)(?:user|username|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@=-]{3,}|(?<![A-Z0-9])AKIA[A-Z0-9]{8,15}(?![A-Z0-9])"""
KEY = r"""(?i)(?:pass|pwd|key|auth|bearer|credentials?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|(?<![0-9A-Za-z])(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{16,23}(?![0-9A-Za-z])"""
ENDPOINT = r"""(?i)https?://[^\s"'<>]{4,}|(?:host|hostname|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9.])"""

#: kind: (pattern, role, strong)
KINDS = {
    "assign": (ASSIGN, "secret", True), "access": (ACCESS, "account", True), "hex": (HEX, "secret", True),
    "account": (ACCOUNT, "account", False), "key": (KEY, "secret", False), "endpoint": (ENDPOINT, "endpoint", False),
}
ORDER = list(KINDS)


def _parts(text: Column, kind: str) -> Column:
    """(gap before, length, counts) of every match, in order; null if there is none."""
    pattern = KINDS[kind][0]
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if kind == "assign":
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        counts = F.transform(value, lambda x: F.length(x) >= 6)
    else:
        counts = F.transform(found, lambda x: F.lit(True))
    zipped = F.arrays_zip(gaps.alias("gap"), F.transform(found, lambda x: F.length(x)).alias("size"), counts.alias("counts"))
    return F.when(F.rlike(text, F.lit(pattern)), zipped)


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables: every row as (doc_id, digest), and (doc_id, digest, kind, begin, end) of the spans to report.

    Rows with equal doc_id and text have their spans once; the digest is of the text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    rows = staged(rows.select("doc_id", F.xxhash64("text").alias("digest"), *(_parts(F.col("text"), k).alias(k) for k in ORDER)), "parts")

    own = ["doc_id", "digest", "kind"]
    some = rows.filter(F.coalesce(*ORDER).isNotNull())
    none = F.array().cast("array<struct<gap:int,size:int,counts:boolean>>")

    def numbered(kind: str) -> Column:
        return F.transform(F.coalesce(F.col(kind), none), lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("n"), x["gap"].alias("gap"), x["size"].alias("size"), x["counts"].alias("counts")
        ))

    listed = F.flatten(F.array(*map(numbered, ORDER)))
    each = some.select("doc_id", "digest", F.explode(listed).alias("x")).select("doc_id", "digest", "x.*").distinct()
    before = Window.partitionBy(*own).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*own).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    begin = F.sum("gap").over(upto) + F.coalesce(F.sum("size").over(before), F.lit(0))
    placed = each.withColumn("begin", begin.cast("bigint")).filter("size is not null and counts")
    role = F.element_at(F.create_map(*(F.lit(x) for k in ORDER for x in (k, KINDS[k][1]))), F.col("kind"))
    strong = F.col("kind").isin([k for k in ORDER if KINDS[k][2]])
    placed = staged(placed.select(*own, role.alias("role"), strong.alias("strong"), "begin", (F.col("begin") + F.col("size")).alias("end")), "placed")

    # A weak span inside or across a strong one adds nothing; neither does its nearness.
    bins = lambda low, high: F.explode(F.sequence(F.floor(low / WINDOW), F.floor(high / WINDOW)))
    near = placed.select(
        "doc_id", "digest", F.col("role").alias("other"), F.col("strong").alias("sure"), F.col("begin").alias("b"), F.col("end").alias("e"),
        bins(F.col("begin"), F.col("end") - 1).alias("bin"),
    )
    weak = placed.filter("not strong")
    close = weak.withColumn("bin", bins(F.greatest(F.col("begin") - WINDOW, F.lit(0)), F.col("end") - 1 + WINDOW))
    same = (close["doc_id"].eqNullSafe(near["doc_id"])) & (close["digest"] == near["digest"]) & (close["bin"] == near["bin"])
    within = (near["b"] < close["end"] + WINDOW) & (near["e"] > close["begin"] - WINDOW)
    apart = (near["e"] <= close["begin"]) | (near["b"] >= close["end"])
    complements = ((close["role"] == "secret") & (near["other"] != "secret")) | ((close["role"] != "secret") & (near["other"] == "secret"))
    supported = close.join(near, same & within & apart & complements, "left_semi").select(*weak.columns).distinct()
    covered = weak.withColumn("bin", bins(F.col("begin"), F.col("end") - 1))
    same = (covered["doc_id"].eqNullSafe(near["doc_id"])) & (covered["digest"] == near["digest"]) & (covered["bin"] == near["bin"])
    inside = covered.join(near, same & near["sure"] & ~((near["e"] <= covered["begin"]) | (near["b"] >= covered["end"])), "left_semi")
    inside = inside.select(*weak.columns).distinct().withColumn("hidden", F.lit(True))
    keys = ["doc_id", "digest", "kind", "begin"]
    match = [supported[k].eqNullSafe(inside[k]) for k in keys]
    reported = supported.join(inside, match, "left_anti")
    return rows.select("doc_id", "digest"), staged(placed.filter("strong").union(reported).select(*own, "begin", "end"), "spans")


def _listed(found: DataFrame) -> DataFrame:
    """The spans of each text as one sorted array of (begin, place of the kind, kind, end)."""
    place = F.array_position(F.array(*map(F.lit, ORDER)), F.col("kind"))
    return found.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_list(F.struct("begin", place.alias("place"), "kind", "end"))).alias("spans"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row: spans as an array of (begin, place, kind, end) by begin, then kind.

    A null text counts as empty and has no span. Matches of one kind do not overlap;
    spans of different strong kinds may. Repeated rows have equal spans each. A null
    doc_id stays null. An empty table gives an empty result; only doc_id and text are read.
    """
    rows, found = spans(docs)
    listed = _listed(found).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "spans")
    both = rows["doc_id"].eqNullSafe(listed["__id"]) & (rows["digest"] == listed["__digest"])
    return rows.join(listed, both, "left").select("doc_id", "spans")


def redact(docs: DataFrame, mark: str = MARK) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mark``; ``n_chars`` follows if there is one.

    Overlapping spans are replaced by one mark. Rows, other columns and texts without a
    span stay as they are.
    """
    _, found = spans(docs)
    listed = _listed(found).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("spans").alias("__spans"))
    same = docs["doc_id"].cast("bigint").eqNullSafe(listed["__id"]) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == listed["__digest"])
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("bigint").alias("at"))

    def step(done: Column, span: Column) -> Column:
        kept = F.substring(F.col("text"), done["at"].cast("int") + 1, (span["begin"] - done["at"]).cast("int"))
        return F.struct(
            F.when(span["begin"] < done["at"], done["text"]).otherwise(F.concat(done["text"], kept, F.lit(mark))).alias("text"),
            F.greatest(done["at"], span["end"]).alias("at"),
        )

    rest = lambda done: F.concat(done["text"], F.substring(F.col("text"), done["at"].cast("int") + 1, F.length("text")))
    clean = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.aggregate("__spans", start, step, rest))
    changed = docs.join(listed, same, "left").withColumn("text", clean)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(size))
    return changed.select(*docs.columns)
