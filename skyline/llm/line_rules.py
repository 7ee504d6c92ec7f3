"""Line-first cleaning: bad lines go, and texts that lose too much go as a whole.

A line fails if it is navigation (parted by bars or bullets), mostly symbols,
shouted, boilerplate by a fixed phrase, or no sentence: a short line without a stop
at its end, or a longer one without any stop. A text is rejected if failing lines
hold more than ``MOST_LOST`` of its characters in words, or if it fails the base rules:
fewer than ``LEAST_WORDS`` words, or over a fifth of its words in repeated runs of five.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_LOST = 0.5
LEAST_WORDS = 10
RUN = 5

# ASCII blanks, marks counted as symbols, and phrases of boilerplate.
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
BOILERPLATE = (
    "all rights reserved", "copyright ©", "privacy policy", "terms of use", "terms of service", "cookie policy", "uses cookies",
    "accept cookies", "enable javascript", "javascript is disabled", "sign up for our newsletter", "subscribe to our newsletter",
    "click here to", "read more", "share this", "log in to", "page not found", "lorem ipsum",
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK, -1), "")


def _repeated(words: Column) -> Column:
    """Words that lie in a run of RUN words found twice or more, the first one included.

    Runs are compared by 64-bit hashes. A text without an equal pair of them is done after
    one hash set; else the runs are sorted and neighbours compared.
    """

    def covered(runs: Column) -> Column:
        ranked = F.array_sort(F.transform(runs, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def twice(order: Column) -> Column:
            again = F.filter(order, lambda x, k: (x["g"].eqNullSafe(F.get(order, k - 1)["g"])) | (x["g"].eqNullSafe(F.get(order, k + 1)["g"])))
            at = F.sort_array(F.transform(again, lambda x: x["i"]))
            start = F.struct(F.lit(-RUN).alias("last"), F.lit(0).alias("total"))
            step = lambda s, i: F.struct(i.alias("last"), (s["total"] + F.least(F.lit(RUN), i - s["last"])).alias("total"))
            return F.aggregate(at, start, step, lambda s: s["total"])

        return F.when(F.size(F.array_distinct(runs)) == F.size(runs), F.lit(0)).otherwise(_let(ranked, twice))

    def runs(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - RUN), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(RUN))))

    counted = _let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: _let(runs(hashes), covered))
    return F.when(F.size(words) < RUN, F.lit(0)).otherwise(counted)


def _fails(line: Column) -> Column:
    """Whether a line fails; a line without a word does not.

    Counting is dear, so each count comes after a look for what it cannot do without: of
    mostly capital letters, two must follow each other with no small one between.
    """
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    has = lambda pattern: F.rlike(line, F.lit(pattern))
    stop = has(r"[.!?…:;]['\"”’)\]]*[\x20\x09-\x0D]*$")
    sentence = stop | (has(r"[.!?…]") & (count(BLANK) >= 8))
    navigation = has(r"[|»•·]") & (count(r"[|»•·]") >= 2) & (count(r"[|»•·]") * 4 >= count(BLANK))
    symbols = has(SYMBOLS) & (count(SYMBOLS) * 8 >= F.length(line))
    shout = has("[A-Z][^a-z]*[A-Z]") & (count("[A-Za-z]") >= 20) & (count("[A-Z]") * 10 >= count("[A-Za-z]") * 6)
    phrase = F.rlike(F.lower(line), F.lit("|".join(BOILERPLATE)))
    return has(r"[^\x20\x09-\x0D]") & (~sentence | navigation | symbols | shout | phrase)


def clean(docs: DataFrame, most_lost: float = MOST_LOST) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars, base_failed, kept, clean_text) of every row.

    ``clean_text`` is the text without its failing lines, null for a null text. A null or empty text has
    no words and fails the base rules. Repeated rows are judged each, null ids stay null, and an
    empty table gives an empty result. Only doc_id and text are read. Nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("__raw"))
    text = F.coalesce("__raw", F.lit(""))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"), F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            _repeated(words).cast("bigint").alias("n_repeat_words"),
        )

    def lines(every: Column) -> Column:
        full = F.filter(every, lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
        good = F.filter(every, lambda x: ~_fails(x))
        return F.struct(
            _let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"), F.array_join(good, "\n").alias("clean_text"),
        )

    made = rows.select(
        "doc_id", "__raw", _let(words_of(text), counts).alias("__words"), _let(F.split(text, "\n", -1), lines).alias("__lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
    )
    left = F.length(F.regexp_replace("__lines.clean_text", BLANK, ""))
    made = made.select(
        "doc_id", "__words.n_words", "__words.word_chars", "n_symbols", "__lines.n_dup_lines", "__words.n_repeat_words",
        (F.col("__words.word_chars") - left).alias("lost_chars"), F.when(F.col("__raw").isNotNull(), F.col("__lines.clean_text")).alias("clean_text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    made = made.withColumn("base_failed", failed)
    return made.withColumn("kept", ~failed & (F.col("lost_chars") <= most_lost * F.col("word_chars")))
