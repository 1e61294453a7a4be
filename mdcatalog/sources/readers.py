"""Reading bundles, file trees, CSV files, specifications and small configuration files."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import frontmatter as fm
from ..functions.rows import evaluate_once
from ..operators import cochange
from ..operators.profile import head_per_group
from ..session import as_table, as_uri, qualified
from . import csv_corpus, listing


def _below(full: Column, folder: str) -> Column:
    """Part of a file URI below a folder."""
    base = "/" + re.sub(r"^[a-z0-9+.-]+:", "", folder).strip("/") + "/"
    plain = F.regexp_replace(full, r"^[a-z0-9+.-]+:/*", "/")
    return F.substring(plain, F.locate(base, plain) + len(base), F.lit(2147483647))


def relative_path(folder: str) -> Column:
    """Path of the file a row came from, relative to the folder that was read."""
    return _below(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), folder)


def _file_step(system_of: str):
    """A vectorised step that reads whole files by path; None for a file that does not exist."""
    def read(paths: pd.Series) -> pd.Series:
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(system_of)

        def content(uri: str) -> str | None:
            _, name = fs.FileSystem.from_uri(uri)
            if system.get_file_info(name).type != fs.FileType.File:
                return None
            with system.open_input_stream(name, compression=None) as stream:
                return stream.read().decode("utf-8", "replace")

        return paths.map(content)

    return F.pandas_udf(read, "string")


def _whole_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, content); names that Spark's own listing leaves out (one on their way starts with . or _) are listed and read by tasks."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    seen = files.select(relative_path(folder).alias("path"), F.col("value").alias("content"))
    wanted = F.substring_index("path", "/", -1).rlike("^" + fnmatch.translate(glob))
    hidden = listing.tree(spark, folder).where(~F.col("is_dir") & F.col("path").rlike("(^|/)[._]") & wanted)
    read = _file_step(as_uri(spark, folder))
    return seen.unionByName(evaluate_once(hidden, "path", read(F.col("uri")).alias("content")))


def read_bundle(spark: SparkSession, folder: str, bundle: str) -> DataFrame:
    """(bundle, path, content) of every Markdown file below a folder."""
    return _whole_files(spark, folder, "*.md").select(F.lit(bundle).alias("bundle"), "path", "content")


def read_specs(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(spec, content) of every specification file below a folder."""
    return _whole_files(spark, folder, glob).select(F.col("path").alias("spec"), "content")


def read_csv(spark: SparkSession, path: str, range_bytes: int = csv_corpus.RANGE_BYTES) -> DataFrame:
    """Untyped CSV with RFC 4180 quoting, a file or a folder of files of one layout; short rows get NULL for their missing cells.

    Large files are cut into ranges that tasks read, line breaks inside quotes or not.
    """
    return csv_corpus.wide(spark, csv_corpus.records(_files(spark, path), range_bytes))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(path, uri, size) of one file, or of the CSV files below a folder."""
    uri = qualified(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    status = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(target)
    if status.isDirectory():
        return csv_files(spark, path)
    return spark.createDataFrame([(target.getName(), as_uri(spark, path), status.getLen())], "path string, uri string, size bigint")


def read_csv_files(spark: SparkSession, folder: str, patterns: list[str] | None = None, range_bytes: int = csv_corpus.RANGE_BYTES, **ignore) -> tuple[DataFrame, DataFrame]:
    """(records, headers) of all CSV files below a folder, each with its own header, for the functions of ``csv_corpus``."""
    found = as_table(csv_corpus.records(csv_files(spark, folder, patterns, **ignore), range_bytes))
    return found, csv_corpus.headers(found)


def file_inventory(spark: SparkSession, folder: str, patterns: list[str] | None = None, **ignore) -> DataFrame:
    """(path, is_dir, size, modified) of files and directories below a folder, hidden and empty ones too; nothing is opened."""
    return listing.tree(spark, folder, patterns, **ignore).select("path", "is_dir", "size", "modified")


def csv_files(spark: SparkSession, folder: str, patterns: list[str] | None = None, **ignore) -> DataFrame:
    """(path, uri, size, modified) of CSV files below a folder (any case of the extension), in path order."""
    found = listing.tree(spark, folder, patterns, **ignore).where("NOT is_dir").select("path", "uri", "size", "modified")
    return found.where(F.lower("path").endswith(".csv")).orderBy("path")


def _config_text(spark: SparkSession, path: str) -> DataFrame:
    """(value): the text of one configuration file of any size, read by a task; no row when it does not exist."""
    uri = as_uri(spark, path)
    rows = spark.createDataFrame([(uri,)], "uri string")
    return evaluate_once(rows, _file_step(uri)(F.col("uri")).alias("value")).where("value IS NOT NULL")


def read_ignore_patterns(spark: SparkSession, *paths: str) -> list[str]:
    """Patterns of one or more ignore files, in order; missing files have none.

    Patterns become parts of a filter, so they come to the driver.
    """
    texts = [row["value"] for path in paths for row in _config_text(spark, path).collect()]
    return cochange.ignore_patterns("\n".join(texts).split("\n"))


def _yaml_json(spark: SparkSession, path: str) -> DataFrame:
    return evaluate_once(_config_text(spark, path), fm.yaml_to_json(F.col("value")).alias("json"))


def read_flat_map(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A flat YAML map as rows; a file that does not exist is an empty map."""
    return _yaml_json(spark, path).select(F.explode(F.from_json("json", "map<string,string>")).alias(key, value))


def read_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """Folder metadata: (path, description)."""
    return read_flat_map(spark, path, "path", "description")


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """Glossary: (term, definition)."""
    return read_flat_map(spark, path, "term", "definition")


def read_eval_cases(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation cases: (concept, label, candidate, dimension, band)."""
    case = "struct<concept:string,label:string,candidate:string,expected:map<string,string>>"
    cases = _yaml_json(spark, path).select(F.inline(F.from_json("json", f"struct<cases:array<{case}>>")["cases"]))
    return cases.select("concept", "label", "candidate", F.explode("expected").alias("dimension", "band"))


def sample_documents(documents: DataFrame, n: int, collection: str, order_by: list[str], names: list[str] | None = None) -> DataFrame:
    """First ``n`` documents of each (chosen) collection on an explicit order."""
    if names:
        documents = documents.where(F.col(collection).isin(names))
    return head_per_group(documents, n, [collection], order_by)


def from_information_schema(read: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """Catalog frames from ``information_schema`` views.

    ``read("table_constraints")`` returns one view, for instance
    ``lambda v: spark.read.jdbc(url, f"information_schema.{v}", properties=...)``.
    Filters put on the frames are pushed into the database.
    """
    def pick(view: str, **names: str) -> DataFrame:
        df = read(view)
        return df.toDF(*[c.lower() for c in df.columns]).select(*[F.col(old).alias(new) for new, old in names.items()])

    kind = F.when(F.col("kind") == "VIEW", "view").otherwise("table")
    return {
        "tables": pick("tables", schema="table_schema", name="table_name", kind="table_type").withColumn("kind", kind),
        "columns": pick("columns", schema="table_schema", table="table_name", name="column_name", ordinal="ordinal_position",
                        type="data_type", nullable="is_nullable", default="column_default").withColumn("nullable", F.col("nullable") == "YES"),
        "constraints": pick("table_constraints", schema="table_schema", table="table_name", constraint="constraint_name", type="constraint_type"),
        "key_columns": pick("key_column_usage", schema="table_schema", table="table_name", constraint="constraint_name", column="column_name",
                            ordinal="ordinal_position", position_in_unique="position_in_unique_constraint"),
        "referential": pick("referential_constraints", schema="constraint_schema", constraint="constraint_name",
                            unique_schema="unique_constraint_schema", unique_constraint="unique_constraint_name"),
        "checks": pick("check_constraints", schema="constraint_schema", constraint="constraint_name", clause="check_clause"),
    }


def from_spark_catalog(spark: SparkSession, database: str | None = None, pattern: str | None = None) -> dict[str, DataFrame]:
    """Tables and columns of Spark's own catalog in the shape of ``from_information_schema``, with comments.

    Temporary views count as views. ``pattern`` is that of ``SHOW TABLES``. The catalog answers the driver, table by table; nothing
    of the tables' data is read. Keys and constraints are unknown to it.
    """
    tables, columns = [], []
    for t in spark.catalog.listTables(database, pattern):
        schema = ".".join(t.namespace or [])
        kind = "view" if t.isTemporary or t.tableType in ("VIEW", "TEMPORARY") else "table"
        tables.append((schema, t.name, kind, t.description))
        name = ".".join(f"`{part}`" for part in [*(t.namespace or []), t.name])
        described = {c.name: c.description for c in spark.catalog.listColumns(name)}
        columns += [(schema, t.name, f.name, i + 1, f.dataType.simpleString(), f.nullable, described.get(f.name))
                    for i, f in enumerate(spark.table(name).schema.fields)]
    return {
        "tables": spark.createDataFrame(tables, "schema string, name string, kind string, comment string"),
        "columns": spark.createDataFrame(columns, "schema string, table string, name string, ordinal int, type string, nullable boolean, comment string"),
    }
