"""Toxicity by a logistic classifier that identity terms must not sway.

A text's features are the words it holds (letters and digits, A-Z as lower case) and
their beginnings, each once for being there and once for being there ``OFTEN`` times.
The fit adds to the logistic loss a penalty on the square of every score change when
an identity term of a labelled text is swapped for another of its group. Terms that
stand more often in toxic texts then gain no weight of their own, and neutral
mentions of a group are not marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyline.llm.hashing import BASE, LETTERS, WIDE, word_hashes
from skyline.llm.shared import arrow_batches, crc_remainder, staged

PREFIXES = (4, 5, 6, 7)
OFTEN = 3
#: Labelled documents, about, that the fit uses, and features that get a weight.
SAMPLE, CHOSEN = 8_000, 512
RIDGE, FAIRNESS = 0.3, 50.0
THRESHOLD = 0.3
SEED = 23
#: Slots of the table that tells most words at once that they have no weight.
SLOTS = 1 << 22

# Terms that may be swapped for each other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "lesbian", "straight", "bisexual", "queer"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "arab", "indigenous"),
    ("african", "european", "american", "mexican", "chinese", "indian", "german", "french", "spanish"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "blind", "deaf", "autistic"),
    ("old", "young", "elderly"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten", "katholiken"),
    ("schwarze", "weiße", "asiaten", "araber"),
    ("türken", "polen", "deutsche", "franzosen", "russen"),
    ("flüchtlinge", "einwanderer", "ausländer", "einheimische"),
    ("schwule", "lesben", "transsexuelle"),
    ("behinderte", "blinde", "gehörlose"),
    ("femmes", "hommes", "filles", "garçons"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées", "catholiques"),
    ("noirs", "blancs", "asiatiques", "arabes"),
    ("immigrés", "réfugiés", "étrangers", "autochtones"),
    ("gays", "lesbiennes", "transgenres"),
    ("handicapés", "aveugles", "sourds"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos", "católicos"),
    ("negros", "blancos", "asiáticos", "árabes", "gitanos"),
    ("inmigrantes", "refugiados", "extranjeros", "nativos"),
    ("gais", "lesbianas", "transexuales"),
    ("discapacitados", "ciegos", "sordos"),
)

Groups = tuple[tuple[str, ...], ...]


def _often(features: np.ndarray) -> np.ndarray:
    """The feature for being there often, and back."""
    return features ^ WIDE(BASE)


def _word_features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, number of rows, row and feature of every word and beginning of a word)."""
    for first, bounds, hashes, heads in word_hashes(column, LETTERS, prefixes=PREFIXES):
        rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        features = np.concatenate([hashes[None, :], heads]).reshape(-1)
        rows = np.tile(rows, 1 + len(PREFIXES))
        there = features != 0
        yield first, len(bounds) - 1, rows[there], features[there]


def _distinct(rows: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature of a row once, and the features of those that are there often."""
    order = np.lexsort((features, rows))
    rows, features = rows[order], features[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (features[1:] != features[:-1])
    at = np.flatnonzero(fresh)
    many = np.diff(np.append(at, len(rows))) >= OFTEN
    rows, features = rows[at], features[at]
    return np.concatenate([rows, rows[many]]), np.concatenate([features, _often(features[many])])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [np.zeros(0, np.int64)] * batch.num_rows
        for first, count, rows, features in _word_features(batch.column("text")):
            rows, features = _distinct(rows, features)
            order = np.argsort(rows, kind="stable")
            for i, part in enumerate(np.split(features[order].view(np.int64), np.searchsorted(rows[order], np.arange(1, count)))):
                lists[first + i] = part
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "label", "features"]
        )


def _term_features(groups: Groups) -> list[list[np.ndarray]]:
    """For each group, the features of each term, the word itself first."""
    return [[next(_word_features(pa.array([term])))[3] for term in group] for group in groups]


def fit(table: np.ndarray, labels: np.ndarray, columns: np.ndarray, terms: list[list[np.ndarray]], fairness: float = FAIRNESS) -> np.ndarray:
    """Weights of the columns, and last the bias, from rows of 0 and 1 for labelled texts.

    ``columns`` are the features of the columns. With one label only, the bias says which.
    """
    width = len(columns) + 1
    weights = np.zeros(width)
    if not len(labels) or labels.min() == labels.max():
        rate = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.01
        weights[-1] = np.log(rate / (1 - rate))
        return weights
    table = np.column_stack([table, np.ones(len(table))])
    place = {int(f): i for i, f in enumerate(columns)}
    swaps = np.zeros((width, width))
    for group in terms:
        # a term that is there often has the features for that, too, and hands all of them on
        for group_ in (group, [np.concatenate([x, _often(x)]) for x in group]):
            for own in group_:
                mark = int(own[0]) if group_ is group else int(own[len(own) // 2])
                having = table[:, place[mark]].sum() if mark in place else 0
                for other in group_ if having else ():
                    change = np.zeros(width)
                    for sign, features in ((-1, np.setdiff1d(own, other)), (1, np.setdiff1d(other, own))):
                        change[[place[int(f)] for f in features if int(f) in place]] = sign
                    swaps += having * np.outer(change, change)
    ridge = RIDGE * np.eye(width)
    ridge[-1, -1] = 1e-6
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(table @ weights, -30, 30)))
        slope = table.T @ (chance - labels) + (ridge + fairness * swaps) @ weights
        bend = (table * (chance * (1 - chance))[:, None]).T @ table + ridge + fairness * swaps
        step = np.linalg.solve(bend, slope)
        weights -= step
        if np.abs(step).max() < 1e-5:
            break
    return weights


def learn(
    docs: DataFrame, labels: DataFrame, *, modulus: int = 4, held: int = 2, groups: Groups = IDENTITY_TERMS, fairness: float = FAIRNESS,
) -> Broadcast:
    """Fit to a sample of labelled documents and broadcast the weights, at most CHOSEN and one for each term.

    Labels are learnt from unless the crc32 of the doc_id, as text, modulo ``modulus`` is
    ``held``. Labels other than 0 and 1, null ids and labels without a document are left out.
    """
    spark = arrow_batches(docs.sparkSession)
    marked = labels.filter(F.col("toxic").isin(0, 1)).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    marked = marked.filter("doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label")).filter(crc_remainder("doc_id", modulus) != held)
    share = min(1.0, SAMPLE / max(1, marked.count()))
    few = marked.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) < int(share * 1_000_000)).limit(SAMPLE)
    few = spark.createDataFrame([tuple(r) for r in few.collect()], "doc_id bigint, label int")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most SAMPLE ids are broadcast
    found = staged(texts.join(F.broadcast(few), "doc_id").mapInArrow(_sampled, "doc_id bigint, label int, features array<bigint>"), "sample")
    total = found.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    rate = (total["toxic"] or 0) / max(1, total["n"])
    each = found.select("label", F.explode("features").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic"))
    # how far a feature's share of toxic texts lies from the general share, in standard deviations
    strength = F.abs(F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate) + 1e-9)
    chosen = [r["feature"] for r in each.filter("n >= 3").orderBy(strength.desc(), "feature").limit(CHOSEN).collect()]
    terms = _term_features(groups)
    named = {int(f) for group in terms for term in group for f in term.view(np.int64)}
    named &= {r["feature"] for r in each.filter(F.col("feature").isin(sorted(named))).collect()}
    columns = np.array(sorted({*chosen, *named}), np.int64)
    kept = spark.createDataFrame([(int(c), i) for i, c in enumerate(columns)], "feature bigint, place int")
    # rows are numbered by id, equal ids apart by their features
    rows = found.select("doc_id", "label", F.explode_outer("features").alias("feature"), F.xxhash64("features").alias("text"))
    held = rows.join(F.broadcast(kept), "feature").groupBy("doc_id", "text").agg(F.sort_array(F.collect_list("place")).alias("places"))
    held = found.select("doc_id", "label", F.xxhash64("features").alias("text")).distinct().join(held, ["doc_id", "text"], "left")
    held = sorted(held.collect(), key=lambda r: (r["doc_id"], r["text"]))
    table = np.zeros((len(held), len(columns)))
    for i, r in enumerate(held):
        table[i, r["places"] or []] = 1
    weights = fit(table, np.array([r["label"] for r in held]), columns.view(WIDE), terms, fairness)
    order = np.argsort(columns.view(WIDE))
    return spark.sparkContext.broadcast({"features": columns.view(WIDE)[order], "weights": weights[:-1][order], "bias": float(weights[-1])})


def scored(docs: DataFrame, model: Broadcast, name: str = "score") -> DataFrame:
    """``docs`` with one more column, the chance that ``text`` is toxic. All columns go through unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, bias = (model.value[x] for x in ("features", "weights", "bias"))
        slots = np.zeros(SLOTS, bool)
        for either in (features, _often(features)):
            slots[(either & WIDE(SLOTS - 1)).astype(np.int64)] = True

        def weight(of: np.ndarray) -> np.ndarray:
            place = np.minimum(np.searchsorted(features, of), max(0, len(features) - 1))
            return np.where(features[place] == of, weights[place], 0.0) if len(features) else np.zeros(len(of))

        for batch in batches:
            total = np.full(batch.num_rows, bias)
            for first, count, rows, own in _word_features(batch.column("text")):
                some = np.flatnonzero(slots[(own & WIDE(SLOTS - 1)).astype(np.int64)])
                rows, own = _distinct(rows[some], own[some])
                total[first:first + count] += np.bincount(rows, weight(own), count)
            chance = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chance)], [*batch.schema.names, name])

    arrow_batches(docs.sparkSession)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def score(docs: DataFrame, labels: DataFrame, *, modulus: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    A null or empty text has no words and gets the score of the bias alone. Repeated rows
    are scored each. An empty table gives an empty result; without labels every score is
    low. lang, source and doc_id are never inputs of a score.
    """
    model = learn(docs, labels, modulus=modulus, held=held)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(crc_remainder("doc_id", modulus) == held, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return scored(rows, model).drop("text").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
