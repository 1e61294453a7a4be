"""From raw documents to a training mix: filter, deduplicate, decontaminate, scan and mix.

Every stage gets what its predecessor kept, written as Parquet and read again, so a lost executor costs a
re-read of one table. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdcatalog.llm import decontamination, mixing, near_dedup, secrets, toxicity
from mdcatalog.llm.common import fresh
from mdcatalog.session import drop_table, scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model learnt from the labels that are not held out.

    Null texts are scored as empty ones, repeated rows alike; without labels of toxic texts every score is 0 and all rows stay; an
    empty table stays empty.
    """
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), ~toxicity.held_out())
    score = fresh(docs, "toxicity_score")
    return toxicity.score_texts(docs, model, into=score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of copies and near copies."""
    return near_dedup.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none, repeated rows go or stay together, an empty table stays empty."""
    return decontamination.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a credential; bare runs of hexadecimal digits do not count as one.

    Null and empty texts stay, repeated rows go or stay together, an empty table stays empty.
    """
    return secrets.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes: one row per row, also of null and empty texts (0 words) and repeated ids; none of an empty table."""
    mixed = mixing.mix(docs, mixing.label_weights(_table(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", drop_secrets),
    ("mixing", mix_sources),
]

#: No SQL: the classifier is trained. The stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; what a stage wrote is deleted once the next has read it."""
    docs, last = _table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        with scratch(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir))
        if last is not None:
            drop_table(last)
        last = docs
    return docs
