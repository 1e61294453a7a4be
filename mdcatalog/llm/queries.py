"""Queries of the operators over the test tables, and SQL that checks them where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdcatalog.llm import decontamination, html_text, merkle, mixing, near_dedup, negatives, neighbours, packing, pii, secrets, substrings, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_toxicity(spark, sf_dir):
    """The toxicity of every text of documents, learnt from the labels that are not held out."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op2_near_duplicates(spark, sf_dir):
    """The class of copies and near copies of every document."""
    return near_dedup.classes(table(spark, sf_dir, "documents"))


@query()
def op3_personal_data(spark, sf_dir):
    """Personal data in every text of documents."""
    return pii.digest(pii.find_personal_data(table(spark, sf_dir, "documents")))


@query()
def op4_repeats(spark, sf_dir):
    """Every document without the strings of 100 bytes that start earlier too."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@query(neighbours.ORACLE_SQL)
def op5_neighbours(spark, sf_dir):
    """The 20 nearest neighbours of every twentieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


@query(mixing.oracle())
def op6_mix(spark, sf_dir):
    """All documents mixed to the weights of their sources, better labelled ones first."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), mixing.label_weights(table(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(decontamination.ORACLE_SQL.replace("{documents}", "documents"))
def op7_leaks(spark, sf_dir):
    """Documents that hold a benchmark item, with the share of its shingles that they hold."""
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_main_text(spark, sf_dir):
    """The main text of every page."""
    return html_text.extract_main_text(table(spark, sf_dir, "pages"))


@query()
def op9_secrets(spark, sf_dir):
    """Secrets in every text of documents."""
    return pii.digest(secrets.find_secrets(table(spark, sf_dir, "documents")), secrets.BASE)


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
""")
def op10_warc(spark, sf_dir):
    """Every page written to dictionary-compressed archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


@query(merkle.oracle())
def op11_manifest(spark, sf_dir):
    """Every document in a Merkle manifest, with its proof, verified after some texts were changed."""
    return merkle.audit_documents(table(spark, sf_dir, "documents"))


@query(negatives.ORACLE_SQL)
def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector, one label in seven shifted."""
    return negatives.mine(table(spark, sf_dir, "embeddings"), "id % 100 = 0", F.expr(negatives.SHIFTED_LABEL))


@query()
def op13_pack(spark, sf_dir):
    """Every document's tokens placed in sequences of 2048."""
    return packing.pack(table(spark, sf_dir, "documents"))
