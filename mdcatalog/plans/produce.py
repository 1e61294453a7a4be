"""From sources to fresh concepts: one row per table, file, collection or API element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import markdown as md
from ..functions import paths as pt
from ..functions import text as tx
from ..operators import cochange, profile, render, specs
from ..sources import csv_corpus

# Concept type, first tag and default description per kind of source.
SQL_NAMES = {"sqlite": "SQLite", "mysql": "MySQL", "postgresql": "PostgreSQL", "bigquery": "BigQuery"}
SQL_TAGS = {"sqlite": "sqlite", "mysql": "mysql", "postgresql": "postgres", "bigquery": "bigquery"}


def _concepts(df: DataFrame, bundle: str, **fields: Column) -> DataFrame:
    path = F.concat(fields["concept_id"], F.lit(".md"))
    columns = {"bundle": F.lit(bundle), **fields, "path": path}
    order = ["bundle", "concept_id", "path", "type", "title", "description", "resource", "tags", "timestamp", "body"]
    return df.select(*[columns[c].alias(c) for c in order])


def _or_default(text: str, default: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(F.col(text)), F.lit("")), default)


def table_concepts(
    entities: DataFrame,
    columns: DataFrame,
    source: str,
    uri: str,
    timestamp: str,
    bundle: str = "bundle",
    relationships: DataFrame | None = None,
    sections: dict[str, DataFrame] | None = None,
    keep_blank: bool = False,
) -> DataFrame:
    """Tables and views of a relational source.

    ``entities(name, kind, comment)``, ``columns(table, ordinal, name, type, ...)``;
    ``relationships`` and ``sections`` are texts by table name, as ``operators.render`` makes
    them. Engines that store descriptions keep blank ones (``keep_blank``).
    """
    bodies = render.render_columns(columns, source, key="table").withColumnRenamed("text", "body")
    if relationships is not None:
        bodies = render.with_relationships(bodies, relationships, key="table")
    bodies = render.with_sections(bodies, sections or {}, key="table")
    joined = entities.join(bodies.withColumnRenamed("table", "name"), "name")
    default = F.concat(F.lit(SQL_NAMES[source] + " "), "kind", F.lit(" "), "name")
    return _concepts(
        joined, bundle,
        concept_id=F.concat(F.lit("tables/"), "name"),
        type=F.concat(F.lit(SQL_NAMES[source] + " "), F.initcap("kind")),
        title=F.col("name"),
        description=F.coalesce("comment", F.lit("")) if keep_blank else _or_default("comment", default),
        resource=F.concat(F.lit(uri.rstrip("/") + "/"), "name"),
        tags=F.array(F.lit(SQL_TAGS[source]), F.col("kind")),
        timestamp=F.lit(timestamp), body=F.col("body"))


def lake_sections(tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None, sample: int = 0, stats: bool = True) -> dict[str, DataFrame]:
    """Data Profile, Sample and Stats texts for the tables of a lake.

    Each table is one plan of its own (its columns differ); the results, a few rows per table,
    are put together. A sample needs the ordering columns of its table.
    """
    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    named = lambda df, name: df.withColumn("table", F.lit(name))
    out = {"Data Profile": render.render_profile(union([named(profile.profile(df), t) for t, df in tables.items()]), key="table")}
    if sample and keys:
        out["Sample"] = union([named(render.render_sample(profile.sample_rows(tables[t], sample, k), tables[t].columns, k), t).select("table", "text")
                               for t, k in keys.items()])
    if stats:
        out["Stats"] = render.render_stats(union([named(profile.table_stats(df), t) for t, df in tables.items()]), key="table")
    return out


def file_concepts(inventory: DataFrame, root: str, timestamp: str, descriptions: DataFrame, bundle: str = "bundle") -> DataFrame:
    """Files and directories of a tree: ``inventory(path, is_dir, size, modified)``."""
    name = pt.base_name(F.col("path"))
    kind = F.when(F.col("is_dir"), "Directory").otherwise("File")
    body = F.when(F.col("is_dir"), F.concat(
        F.lit("# Directory: "), name, F.lit("\n\nThis directory contains files and folders documented in the bundle.\n"))
    ).otherwise(F.concat(F.lit("# File: "), name, F.lit("\n\n## Metadata\n\n- **Size**: "), F.col("size").cast("string"),
                         F.lit(" bytes\n- **Last Modified**: "), _rfc3339("modified"), F.lit("\n")))
    joined = inventory.join(descriptions.select("path", F.col("description").alias("_text")), "path", "left")
    return _concepts(
        joined, bundle, concept_id=F.col("path"), type=kind, title=name,
        description=_or_default("_text", F.concat(kind, F.lit(" "), name)),
        resource=F.concat(F.lit("file:///" + root.strip("/") + "/"), "path"),
        tags=F.array(F.lit("fs"), F.lower(kind)), timestamp=F.lit(timestamp), body=body)


def _rfc3339(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def history_concepts(
    inventory: DataFrame, commits: DataFrame, root: str, descriptions: DataFrame, bundle: str = "bundle",
    related: DataFrame | None = None,
) -> DataFrame:
    """Files and directories of a repository with their last commit and related files."""
    changed = cochange.with_last_change(inventory, commits)
    name = pt.base_name(F.col("path"))
    kind = F.when(F.col("is_dir"), "Directory").otherwise("File")
    quoted = tx.trim_ws(F.col("message"))
    for plain, escaped in fv.QUOTED:
        quoted = F.replace(quoted, F.lit(plain), F.lit(escaped))
    quoted = F.concat(F.lit('"'), quoted, F.lit('"'))
    last = F.when(F.col("author").isNotNull(), F.concat(
        F.lit("- **Last Committer**: "), "author", F.lit("\n- **Last Commit Date**: "), _rfc3339("at"),
        F.lit("\n- **Last Commit Message**: "), quoted, F.lit("\n"))
    ).otherwise(F.concat(F.lit("- **Last Modified**: "), _rfc3339("modified"), F.lit("\n")))
    body = F.when(F.col("is_dir"), F.concat(
        F.lit("# Git Directory: "), name, F.lit("\n\nThis directory is part of the Git repository file tree.\n\n"))
    ).otherwise(F.concat(F.lit("# Git File: "), name, F.lit("\n\n## Metadata\n\n- **Size**: "), F.col("size").cast("string"), F.lit(" bytes\n"), last))
    joined = changed.withColumn("body", body).join(descriptions.select("path", F.col("description").alias("_text")), "path", "left")
    if related is not None:
        texts = render.render_relationships(cochange.related_relationships(related))
        joined = render.with_relationships(joined, texts, heading="Related Files", key="path")
    return _concepts(
        joined, bundle, concept_id=F.col("path"), type=F.concat(F.lit("Git "), kind), title=name,
        description=_or_default("_text", F.concat(F.lit("Git "), F.lower(kind), F.lit(" "), name)),
        resource=F.concat(F.lit("git:///" + root.strip("/") + "/"), "path"),
        tags=F.array(F.lit("git"), F.lower(kind)), timestamp=_rfc3339("at"), body=F.col("body"))


def csv_concepts(types: DataFrame, root: str, timestamp: str, descriptions: DataFrame, bundle: str = "bundle",
                 sections: dict[str, DataFrame] | None = None) -> DataFrame:
    """CSV files: ``types(path, column, ordinal, type)`` as inferred per file."""
    columns = types.withColumnRenamed("column", "name")
    bodies = render.render_columns(columns, "csv", key="path").withColumnRenamed("text", "body")
    bodies = render.with_sections(bodies, sections or {}, key="path")
    name = F.regexp_replace(pt.base_name(F.col("path")), r"\.[^.]*$", "")
    joined = bodies.join(descriptions.select("path", F.col("description").alias("_text")), "path", "left")
    return _concepts(
        joined, bundle, concept_id=pt.strip_md(pt.csv_concept_path(F.col("path"))), type=F.lit("CSV File"), title=name,
        description=_or_default("_text", F.concat(F.lit("CSV file "), name)),
        resource=F.concat(F.lit("file:///" + root.strip("/") + "/"), "path"),
        tags=F.array(F.lit("csv"), F.lit("table")), timestamp=F.lit(timestamp), body=F.col("body"))


def csv_sections(found: DataFrame, names: DataFrame, types: DataFrame, sample: int = 0) -> dict[str, DataFrame]:
    """Data Profile and Sample texts per file of ``sources.readers.read_csv_files``: one plan each for all files, whatever their headers."""
    out = {"Data Profile": render.render_profile(csv_corpus.profile_files(found, names, types), key="path")}
    if sample:
        out["Sample"] = render.render_listed_sample(csv_corpus.sample_texts(found, names, sample).join(names, "path"), key="path")
    return out


def collection_concepts(fields: DataFrame, uri: str, timestamp: str, bundle: str = "bundle") -> DataFrame:
    """Document collections: ``fields(collection, field, type, presence_pct)``."""
    rows = fields.select("collection", F.col("field").alias("ordinal"), F.col("field").alias("name"), "type", F.col("presence_pct").alias("presence"))
    bodies = render.render_columns(rows, "mongodb", key="collection")
    return _concepts(
        bodies, bundle, concept_id=F.concat(F.lit("collections/"), "collection"), type=F.lit("MongoDB Collection"), title=F.col("collection"),
        description=F.concat(F.lit("MongoDB collection "), "collection"),
        resource=F.concat(F.regexp_replace(F.lit(uri.rstrip("/") + "/"), "://[^/@]*@", "://"), "collection"),
        tags=F.array(F.lit("mongodb"), F.lit("collection")), timestamp=F.lit(timestamp), body=F.col("text"))


def spec_concepts(extracted: DataFrame, scheme: str, timestamp: str, descriptions: DataFrame | None = None) -> DataFrame:
    """Concepts of API specifications, one bundle per specification; scheme openapi or graphql."""
    full = specs.with_relationships(extracted)
    if descriptions is not None:
        full = full.join(descriptions.select(F.col("path").alias("rel"), F.col("description").alias("_text")), "rel", "left")
    else:
        full = full.withColumn("_text", F.lit(""))
    kind = F.when(F.col("type") == "Schema", "schema").when(F.col("type") == "API Endpoint", "endpoint").otherwise(
        F.lower(F.regexp_replace("type", "^GraphQL ", "")))
    prefix = F.when(F.col("type") == "Schema", "API schema ").when(F.col("type") == "API Endpoint", "API endpoint ").otherwise(
        F.concat(F.lit("GraphQL "), kind, F.lit(" ")))
    out = _concepts(
        full, "", concept_id=F.col("rel"), type=F.col("type"), title=F.col("title"),
        description=_or_default("_text", F.concat(prefix, "title")),
        resource=F.concat(F.lit(f"{scheme}:///"), "spec", F.lit("#/"), "rel"),
        tags=F.array(F.lit(scheme), kind), timestamp=F.lit(timestamp), body=F.col("body"))
    return out.withColumn("bundle", F.regexp_extract("resource", r"^[a-z]+:///(.*?)#/", 1))
