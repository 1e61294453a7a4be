"""Drift between a bundle and its source, and what to write back.

Everything is a table: findings, new metadata, or statement text a user may run. Nothing is
executed on a foreign system. ``schema`` may be left out of the frames when there is one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def _many(df: DataFrame) -> DataFrame:
    """A side with a row per table or column of a catalog: its size, which the optimizer takes from the files its rows are made
    from, is no reason to send all of it through the driver."""
    return df.hint("merge")


def missing_tables(bundle_tables: DataFrame, source_tables: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Tables (or files, endpoints, types) the bundle describes and the source no longer has."""
    keys = on or ["table"]
    return bundle_tables.join(_many(source_tables.select(*keys)), keys, "left_anti")


missing_assets = missing_tables


def _lowered(columns: DataFrame, ignore_case: bool) -> DataFrame:
    return columns.withColumn("_name", F.lower("name") if ignore_case else F.col("name"))


def missing_columns(bundle_columns: DataFrame, source_columns: DataFrame, ignore_case: bool = True) -> DataFrame:
    """Columns of existing tables that the source no longer has."""
    b, s = _lowered(bundle_columns, ignore_case), _lowered(source_columns, ignore_case)
    present = b.join(_many(s.select("table").distinct()), "table", "left_semi")
    return present.join(_many(s.select("table", "_name")), ["table", "_name"], "left_anti").select("table", "name")


def type_mismatches(bundle_columns: DataFrame, source_columns: DataFrame, ignore_case: bool = True) -> DataFrame:
    """Columns whose type text differs, ignoring case."""
    b = _lowered(bundle_columns, ignore_case).select("table", "name", "_name", F.col("type").alias("bundle_type"))
    s = _lowered(source_columns, ignore_case).select("table", "_name", F.col("type").alias("source_type"))
    return b.join(_many(s), ["table", "_name"]).where(F.lower("bundle_type") != F.lower("source_type")).select(
        "table", "name", "bundle_type", "source_type")


def column_lists(columns: DataFrame, key: str = "table") -> DataFrame:
    """Column names per table in order, as one array (as long as the table is wide)."""
    names = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "name"))), lambda x: x["name"])
    return columns.groupBy(key).agg(names.alias("names"))


def header_drift(bundle_columns: DataFrame, headers: DataFrame, key: str = "table") -> DataFrame:
    """Files whose header is not exactly the bundle's column list: ``headers(key, names)``."""
    described = column_lists(bundle_columns, key).withColumnRenamed("names", "bundle_names")
    return headers.join(_many(described), key).where(~F.col("names").eqNullSafe(F.col("bundle_names"))).select(
        key, F.array_join("bundle_names", ",").alias("bundle_header"), F.array_join("names", ",").alias("file_header"))


def description_mismatches(concepts: DataFrame, source: DataFrame, key: str = "table", missing_is_blank: bool = False) -> DataFrame:
    """Trimmed descriptions that differ: ``concepts(key, description)`` vs ``source(key, description)``.

    Only keys both sides know are compared, or, with ``missing_is_blank``, every concept.
    """
    ours = concepts.select(key, tx.trim_ws(F.coalesce("description", F.lit(""))).alias("bundle_description"))
    theirs = source.select(key, tx.trim_ws(F.coalesce("description", F.lit(""))).alias("source_description"))
    joined = ours.join(_many(theirs), key, "left" if missing_is_blank else "inner")
    other = F.coalesce("source_description", F.lit(""))
    return joined.where(F.col("bundle_description") != other).select(key, "bundle_description", other.alias("source_description"))


def comment_mismatches(bundle_columns: DataFrame, source_columns: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Columns known to both sides whose trimmed comments differ."""
    b = _lowered(bundle_columns, ignore_case).select(
        "table", "name", "_name", tx.trim_ws(F.coalesce("comment", F.lit(""))).alias("bundle_comment"))
    s = _lowered(source_columns, ignore_case).select(
        "table", "_name", tx.trim_ws(F.coalesce("comment", F.lit(""))).alias("source_comment"))
    return b.join(_many(s), ["table", "_name"]).where("bundle_comment <> source_comment").select(
        "table", "name", "bundle_comment", "source_comment")


def sync_metadata(existing: DataFrame, bundle: DataFrame) -> DataFrame:
    """Folder metadata (path, description) overlaid by the bundle's descriptions."""
    ours = bundle.select("path", tx.trim_ws(F.coalesce("description", F.lit(""))).alias("_new"))
    return existing.join(ours, "path", "full_outer").select("path", F.coalesce("_new", "description").alias("description"))


def _q(c: str | Column, backslashes: bool) -> Column:
    return tx.quote_literal(F.col(c) if isinstance(c, str) else c, backslashes)


def table_comment_statements(mismatches: DataFrame, dialect: str, schema: str = "") -> DataFrame:
    """Statement text that sets a table comment to the bundle's description."""
    text = _q("bundle_description", dialect == "mysql")
    if dialect == "mysql":
        sql = F.format_string("ALTER TABLE `%s` COMMENT = '%s'", "table", text)
    else:
        sql = F.format_string(f"COMMENT ON TABLE {schema}.%s IS '%s'", "table", text)
    return mismatches.select("table", sql.alias("sql"))


def column_comment_statements(mismatches: DataFrame, source_columns: DataFrame, dialect: str, schema: str = "") -> DataFrame:
    """Statement text that sets column comments; MySQL needs the whole column definition."""
    text = _q("bundle_comment", dialect == "mysql")
    if dialect != "mysql":
        sql = F.format_string(f"COMMENT ON COLUMN {schema}.%s.%s IS '%s'", "table", "name", text)
        return mismatches.select("table", "name", sql.alias("sql"))
    spec = source_columns.select("table", "name", "type", "nullable", "default", "extra")
    null = F.when(F.col("nullable"), "NULL").otherwise("NOT NULL")
    default = F.when(F.coalesce("default", F.lit("")).isin("", "NULL"), "").otherwise(F.concat(F.lit("DEFAULT "), "default"))
    sql = F.format_string("ALTER TABLE `%s` MODIFY COLUMN `%s` %s %s %s %s COMMENT '%s'",
                          "table", "name", "type", null, default, F.coalesce("extra", F.lit("")), text)
    return mismatches.join(_many(spec), ["table", "name"]).select("table", "name", sql.alias("sql"))


def _definition(primary_key: bool) -> Column:
    default = F.coalesce("default", F.lit(""))
    parts = [
        F.format_string("`%s` %s", "name", "type"),
        F.when(~F.col("nullable"), " NOT NULL").otherwise(""),
    ]
    if primary_key:
        parts.append(F.when(F.col("pk"), " PRIMARY KEY").otherwise(""))
    parts.append(F.when(default.isin("", "NULL"), "").otherwise(F.concat(F.lit(" DEFAULT "), default)))
    return F.concat(*parts)


def create_table_statements(missing: DataFrame, bundle_columns: DataFrame) -> DataFrame:
    """CREATE TABLE text for missing tables, columns in their order."""
    defs = bundle_columns.join(_many(missing.select("table")), "table", "left_semi").select(
        "table", "ordinal", _definition(primary_key=True).alias("d"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "d"))), lambda x: x["d"])
    return defs.groupBy("table").agg(F.array_join(listed, ", ").alias("_defs")).select(
        "table", F.format_string("CREATE TABLE `%s` (%s)", "table", "_defs").alias("sql"))


def add_column_statements(missing: DataFrame, bundle_columns: DataFrame) -> DataFrame:
    """ALTER TABLE ... ADD COLUMN text for missing columns."""
    cols = bundle_columns.join(_many(missing.select("table", "name")), ["table", "name"], "left_semi")
    sql = F.format_string("ALTER TABLE `%s` ADD COLUMN %s", F.col("table"), _definition(primary_key=False))
    return cols.select("table", "name", sql.alias("sql"))
