"""Relational catalogs as DataFrames: entities, keys, constraints, indexes, relationships.

Inputs are shaped like ``information_schema`` (read them with ``spark.read.jdbc`` or build
them from schemas), for any number of databases at once; ``schema`` is part of every key.

* ``tables(schema, name, kind, comment, view_sql)``
* ``constraints(schema, table, constraint, type)``
* ``key_columns(schema, table, constraint, column, ordinal, position_in_unique)``
* ``referential(schema, constraint, unique_schema, unique_constraint)``
* ``checks(schema, constraint, clause)``
* ``index_columns(schema, table, index, unique, column, position)``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def parse_allow_list(names: str) -> list[str]:
    """Names of a comma-separated list; an empty list means "keep all"."""
    return [n.strip() for n in names.split(",") if n.strip()]


def keep_named(df: DataFrame, names: list[str] | None, column: str = "name") -> DataFrame:
    return df.where(F.col(column).isin(names)) if names else df


def entities(tables: DataFrame, names: list[str] | None = None, internal_prefixes: tuple[str, ...] = ("sqlite_", "__")) -> DataFrame:
    """Tables and views in name order, without the engine's own objects, comments cleaned."""
    kept = tables.where(F.col("kind").isin("table", "view"))
    for prefix in internal_prefixes:
        kept = kept.where(~F.col("name").startswith(prefix))
    comment = tx.strip_engine_noise(F.coalesce("comment", F.lit("")))
    return keep_named(kept, names).select("schema", "name", "kind", comment.alias("comment"), "view_sql").orderBy("schema", "name")


def entity_comments(classes: DataFrame, namespaces: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Comments of tables and views from class, namespace and description catalogs."""
    named = classes.join(namespaces, "namespace_id").where(F.col("kind").isin("table", "view"))
    comment = F.coalesce("comment", F.lit(""))
    return named.join(descriptions, "class_id", "left").select("schema", "name", "kind", comment.alias("comment"))


def foreign_keys(constraints: DataFrame, key_columns: DataFrame, referential: DataFrame) -> DataFrame:
    """One row per referencing column, paired with the referenced column by position."""
    fk = constraints.where("type = 'FOREIGN KEY'").select("schema", "table", "constraint")
    own = key_columns.select("schema", "table", "constraint", "column", "ordinal", "position_in_unique")
    referred = key_columns.select(
        F.col("schema").alias("unique_schema"), F.col("constraint").alias("unique_constraint"),
        F.col("ordinal").alias("position_in_unique"), F.col("table").alias("ref_table"), F.col("column").alias("ref_column"))
    return (
        fk.join(own, ["schema", "table", "constraint"])
        .join(referential, ["schema", "constraint"])
        .join(referred, ["unique_schema", "unique_constraint", "position_in_unique"])
        .select("schema", "table", "constraint", "ordinal", "column", "ref_table", "ref_column")
    )


def fk_relationships(fks: DataFrame) -> DataFrame:
    """Foreign keys as relationship rows (label, target, text); blank targets are skipped."""
    return fks.where("ref_table <> ''").select(
        "schema",
        F.concat(F.lit("tables/"), "table").alias("source_id"),
        F.concat(F.lit("FK on "), "column").alias("label"),
        F.concat(F.lit("/tables/"), "ref_table", F.lit(".md")).alias("target"),
        F.col("ref_table").alias("text"))


def _ordered(column: str, order: str) -> Column:
    """Values of a group in the order of another column (groups are keys of one table)."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order, column))), lambda x: x[column])


def key_constraints(constraints: DataFrame, key_columns: DataFrame, types: tuple[str, ...] = ("UNIQUE",)) -> DataFrame:
    """Unique (and, if asked, primary-key) constraints with their columns in order."""
    keys = constraints.where(F.col("type").isin(*types)).join(
        key_columns.select("schema", "table", "constraint", "column", "ordinal"), ["schema", "table", "constraint"])
    return keys.groupBy("schema", "table", "constraint", "type").agg(
        F.array_join(_ordered("column", "ordinal"), ", ").alias("definition")
    ).select("schema", "table", F.col("constraint").alias("name"), "type", "definition")


def unique_constraints(constraints: DataFrame, key_columns: DataFrame) -> DataFrame:
    return key_constraints(constraints, key_columns)


def check_constraints(constraints: DataFrame, checks: DataFrame | None) -> DataFrame:
    """Declared checks, without the implicit NOT NULL ones; no checks view, no rows."""
    declared = constraints.where("type = 'CHECK'").select("schema", "table", "constraint", "type")
    if checks is None:
        return declared.where("false").select("schema", "table", F.col("constraint").alias("name"), "type",
                                              F.lit("").alias("definition"))
    clause = F.col("clause")
    return declared.join(checks, ["schema", "constraint"]).where(~F.upper(clause).contains("IS NOT NULL")).select(
        "schema", "table", F.col("constraint").alias("name"), "type", tx.trim_ws(clause).alias("definition"))


def indexes(index_columns: DataFrame) -> DataFrame:
    """Indexes with their columns in declared order."""
    return index_columns.groupBy("schema", "table", "index").agg(
        F.bool_or("unique").alias("unique"), _ordered("column", "position").alias("columns")
    ).select("schema", "table", F.col("index").alias("name"), "columns", "unique")


def unique_from_indexes(index_columns: DataFrame) -> DataFrame:
    """Unique constraints of engines that report them as indexes of origin ``u``."""
    owned = indexes(index_columns.where("origin = 'u'"))
    return owned.select("schema", "table", "name", F.lit("UNIQUE").alias("type"),
                        F.array_join("columns", ", ").alias("definition"))


def _check_expressions(ddl: Column) -> Column:
    """The balanced expressions that follow the word CHECK, in order; an expression that never closes ends the search.

    The text is cut behind every parenthesis; one pass over the pieces keeps the nesting depth, 0 outside of a check.
    """
    state = "struct<depth:int,open:string,done:array<string>>"
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("open"), F.array().cast("array<string>").alias("done")).cast(state)

    def step(s: Column, piece: Column) -> Column:
        inside = s["depth"] > 0
        begins = ~inside & piece.rlike(r"(?i)check[ \t\n]*\($")
        depth = F.when(begins, 1).when(~inside, 0).when(piece.endswith("("), s["depth"] + 1).otherwise(s["depth"] - 1)
        ends = inside & (depth == 0)
        whole = F.concat(s["open"], F.substring(piece, F.lit(1), F.length(piece) - 1))
        return F.struct(depth.alias("depth"), F.when(inside & ~ends, F.concat(s["open"], piece)).otherwise("").alias("open"),
                        F.when(ends, F.array_append(s["done"], tx.trim_ws(whole))).otherwise(s["done"]).alias("done")).cast(state)

    return F.aggregate(F.regexp_extract_all(ddl, F.lit(r"[^()]*+[()]"), 0), start, step, lambda s: s["done"])


def ddl_checks(ddl: DataFrame) -> DataFrame:
    """Check constraints from CREATE TABLE text: (schema, table, ddl) -> check_1 ... check_n."""
    saying = ddl.where(F.lower("ddl").contains("check"))
    return saying.select("schema", "table", F.posexplode(_check_expressions(F.col("ddl"))).alias("_no", "definition")).select(
        "schema", "table", F.concat(F.lit("check_"), F.col("_no") + 1).alias("name"), F.lit("CHECK").alias("type"), "definition")
