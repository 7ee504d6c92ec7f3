"""From raw documents to a training mix, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of documents. Between stages the rows are written to the shared folder and
read again, so a lost executor costs one stage's tasks at most. Stages decide by a row's text, never
by its doc_id alone: rows without an id and different texts with one id are judged each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyline.llm import decontamination, mixing, order_minhash, secret_scan, toxicity
from skyline.llm.catalog import production_mix, table
from skyline.llm.shared import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scored(docs, model, "__toxicity")
    return scored.filter(F.col("__toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates: the one with the least doc_id."""
    return order_minhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text holds no benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets and confirmed weak candidates replaced by a mark."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fill each source's token budget, with the number of copies to read."""
    return mixing.mixed(docs, production_mix())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: Stages fit models, compare hashes and align texts; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
