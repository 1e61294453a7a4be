"""Writing bundles, indexes, logs, metadata, reports and graphs.

Files are written by the tasks that hold their rows, to a folder every executor can reach.
Each file is written whole under a temporary name and then moved, so that a task that runs
again after a lost executor leaves the same bytes.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frontmatter import render_scalar
from ..operators import docs, graph, merge
from ..session import delete, new_folder, qualified

def write_files(files: DataFrame, folder: str) -> int:
    """Write (path, content) rows below ``folder``, those of paths that end in ``.gz`` compressed; returns how many were written."""
    folder = qualified(files.sparkSession, folder)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip

        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                target = f"{base}/{path}"
                system.create_dir(os.path.dirname(target), recursive=True)
                partial = f"{target}.{uuid.uuid4().hex}.tmp"
                with system.open_output_stream(partial) as out:
                    data = content.encode("utf-8")
                    out.write(gzip.compress(data, 1, mtime=0) if path.endswith(".gz") else data)
                system.move(partial, target)
            yield pd.DataFrame({"n": [len(batch)]})

    written = files.select("path", "content").mapInPandas(write, "n bigint")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_concepts(concepts: DataFrame, folder: str) -> int:
    """One Markdown file per concept; with a ``change`` column, only created and updated ones."""
    changed = concepts.where("change <> ''") if "change" in concepts.columns else concepts
    return write_files(merge.render_concepts(changed), folder)


def _write_lines(lines: DataFrame, order: list[Column], folder: str, name: str, head: str) -> str:
    """A head and then ``line`` in order as one file of any length.

    Spark sorts the lines into parts in the shared folder; one task then streams the parts, in order of
    their names, into the file under a temporary name, and moves it.
    """
    spark = lines.sparkSession
    parts, folder = qualified(spark, new_folder(spark)), qualified(spark, folder)
    lines.orderBy(*order).select("line").write.text(parts)

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        (source, below), (system, base) = fs.FileSystem.from_uri(parts), fs.FileSystem.from_uri(folder)
        for batch in batches:
            for _ in range(len(batch)):
                system.create_dir(base, recursive=True)
                partial = f"{base}/{name}.{uuid.uuid4().hex}.tmp"
                with system.open_output_stream(partial) as out:
                    out.write(head.encode("utf-8"))
                    for info in sorted(source.get_file_info(fs.FileSelector(below)), key=lambda i: i.base_name):
                        if info.base_name.startswith("part-"):
                            with source.open_input_stream(info.path) as stream:
                                while block := stream.read(1 << 20):
                                    out.write(block)
                system.move(partial, f"{base}/{name}")
            yield pd.DataFrame({"n": [len(batch)]})

    spark.range(1, numPartitions=1).mapInPandas(join, "n bigint").collect()
    delete(spark, parts)
    return f"{folder.rstrip('/')}/{name}"


def write_index(concepts: DataFrame, folder: str, title: str, intro: str, section: str, version: str = "0.1", version_key: str = "format_version") -> str:
    """Root index of one bundle: frontmatter with only the version, title, sorted bullets."""
    head = merge.index_head(title, intro, section, version, version_key)
    return _write_lines(merge.index_lines(concepts), [F.col("concept_id")], folder, "index.md", head)


def append_log(entries: DataFrame, table: str) -> None:
    """Put change-log rows into the log table (Parquet, partitioned by bundle, date and run).

    The partitions of the given runs are replaced, so a job that runs again adds nothing twice.
    """
    entries.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bundle", "date", "run").parquet(table)


def write_log(log: DataFrame, folder: str, bundle: str) -> str:
    """The log of a bundle as ``log.md``: newest date first, within a date the newest run first."""
    own = log.where(F.col("bundle") == bundle)
    lines = merge.log_lines(own).withColumn("line", F.when(F.col("part") == 0, F.concat(F.lit("\n"), "line", F.lit("\n"))).otherwise(F.col("line")))
    return _write_lines(lines, [F.desc("date"), F.col("part"), F.desc("run"), F.desc("concept_id")], folder, "log.md", "# Change Log\n")


def write_descriptions(descriptions: DataFrame, folder: str, name: str = ".catalog-metadata.yaml") -> str | None:
    """Folder metadata with sorted keys; an empty map removes the file."""
    if descriptions.isEmpty():
        spark = descriptions.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{qualified(spark, folder).rstrip('/')}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
        return None
    line = F.concat(render_scalar(F.col("path")), F.lit(": "), render_scalar(F.coalesce("description", F.lit(""))))
    return _write_lines(descriptions.select("path", line.alias("line")), [F.col("path")], folder, name, "")


def write_report(report: DataFrame, path: str) -> None:
    """An audit table as JSON lines."""
    report.write.mode("overwrite").json(path)


def graph_documents(concepts: DataFrame) -> DataFrame:
    """Per concept: frontmatter, columns with key flags and profile rows, for the graph export."""
    keys = ["bundle", "concept_id"]
    columns = graph.er_columns(concepts).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("ordinal", "name", "type", "pk", "fk", "nullable"))).alias("columns"))
    profiles = docs.parse_profiles(concepts).groupBy(*keys).agg(F.array_sort(F.collect_list(
        F.struct("ordinal", "column", "non_null", "nulls", "distinct", "min", "max", "semantic"))).alias("profile"))
    base = docs.readable(concepts).select(
        *keys, F.coalesce(F.nullif("title", F.lit("")), F.col("concept_id")).alias("title"), "type", "description", "resource", "tags", "timestamp", "body")
    return base.join(columns, keys, "left").join(profiles, keys, "left")


def write_graph(nodes: DataFrame, edges: DataFrame, folder: str, concepts: DataFrame | None = None) -> None:
    """Nodes, edges and, if given, documents as JSON lines; also used for sub-graphs."""
    nodes.write.mode("overwrite").json(f"{folder}/nodes")
    edges.write.mode("overwrite").json(f"{folder}/edges")
    if concepts is not None:
        graph_documents(concepts).write.mode("overwrite").json(f"{folder}/documents")
