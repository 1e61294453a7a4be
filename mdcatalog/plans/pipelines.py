"""The three everyday jobs: produce into a bundle, audit a bundle, build its graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import as_table
from ..operators import audit, docs, graph, merge
from ..sources import readers, writers


def load(spark: SparkSession, folder: str, bundle: str) -> tuple[DataFrame, DataFrame]:
    """(concepts, reserved files) of a bundle; concepts are written as a table, since the several
    branches of audits and graphs read them."""
    raw = readers.read_bundle(spark, folder, bundle)
    return as_table(docs.parse_concepts(raw)), docs.reserved_files(raw)


def produce(fresh: DataFrame, folder: str, bundle: str, date: str, run: int = 0, log_table: str | None = None,
            index: dict[str, str] | None = None) -> DataFrame:
    """Merge fresh concepts into a bundle folder, log and write what changed, and return the log rows.

    The log rows are stored before any concept changes; with ``log_table`` they go there (a repeated run
    replaces its own), and ``log.md`` is written from the whole table. ``index`` (title, intro, section)
    also writes the index of all concepts. Everything is written under its final name at once, so a run
    that ends half-way is repeated with the same date and run.
    """
    spark = fresh.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    if exists:
        existing = docs.parse_concepts(readers.read_bundle(spark, folder, bundle))
    else:
        existing = fresh.limit(0).selectExpr("*", "'' AS content_hash", "'' AS enriched_against")
    # The merge reads the folder that is written next, so its result is stored first.
    merged = as_table(merge.merge_concepts(existing, fresh))
    changed = merged.where("change <> ''")
    entries = merge.log_entries(changed, date, run)
    if log_table:
        writers.append_log(entries, log_table)
    writers.write_concepts(changed, folder)
    if log_table:
        writers.write_log(spark.read.parquet(log_table), folder, bundle)
    if index:
        whole = docs.readable(docs.parse_concepts(readers.read_bundle(spark, folder, bundle)))
        writers.write_index(whole, folder, **index)
    return entries


def lint(spark: SparkSession, folder: str, bundle: str = "bundle", version_key: str = "format_version", **gate) -> dict[str, DataFrame]:
    """Report, findings, lists and failed gates of a bundle."""
    concepts, reserved = load(spark, folder, bundle)
    report = audit.report(concepts, reserved, version_key)
    return {
        "report": report,
        "findings": audit.findings(concepts, reserved, version_key).orderBy("path", "rule"),
        "broken_links": audit.broken_links(concepts).orderBy("link"),
        "missing_type": audit.missing_type(concepts).orderBy("concept_id"),
        "orphans": audit.orphans(concepts).orderBy("concept_id"),
        "enrich_first": audit.enrich_first(concepts),
        "gates": audit.gates(report, **gate),
        "text": audit.text_report(report),
    }


def build_graph(spark: SparkSession, folder: str, bundle: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (with degree) and sorted edges of a bundle."""
    concepts, reserved = load(spark, folder, bundle)
    edges = graph.graph_edges(concepts)
    return graph.with_degree(graph.graph_nodes(concepts, reserved), edges), graph.sort_edges(edges)
