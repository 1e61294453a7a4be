"""Sections and bodies as text: one string per concept, from long tables.

Groups are the rows of one concept (columns of a table, its keys, its links), so they are as
large as the document they become; every list is sorted by an explicit key, so that a rerun
over the same input is byte-identical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import markdown as md
from ..functions import text as tx


def _sorted_text(order: list[str], line: str) -> Column:
    """Concatenation of a group's lines in a given order."""
    rows = F.array_sort(F.collect_list(F.struct(*order, line)))
    return F.array_join(F.transform(rows, lambda r: r[line]), "")


def render_columns(columns: DataFrame, layout: str, key: str = "concept_id") -> DataFrame:
    """``# Columns`` tables in the layout of a source: csv, sqlite, mysql, postgresql, ..."""
    fields = fv.COLUMN_LAYOUTS[layout]
    have = {f.name: f.dataType.simpleString() for f in columns.schema.fields}

    def cell(name: str) -> Column:
        if name not in have:
            return F.lit("")
        value = F.col(name)
        if name == "presence":
            return F.concat(value.cast("string"), F.lit("%"))
        if have[name] == "boolean":
            yes, no = ("yes", "no") if layout == "api" else ("Yes", "No")
            return F.when(value, yes).otherwise(no)
        return value.cast("string")

    head = "# Columns\n\n" + md.table_head(*[title for title, _ in fields])
    rows = columns.select(key, "ordinal", md.table_row(*[cell(name) for _, name in fields]).alias("_line"))
    return rows.groupBy(key).agg(F.concat(F.lit(head), _sorted_text(["ordinal"], "_line")).alias("text"))


def render_profile(profiles: DataFrame, key: str = "concept_id") -> DataFrame:
    """``Data Profile`` content: the table, with a Semantic column when any is known, and value sets."""
    base = ["Column", "Non-Null", "Null", "Distinct", "Min", "Max"]
    counts = [F.col(c).cast("string") for c in ("non_null", "nulls", "distinct")]
    cells = [F.col("column"), *counts, F.col("min"), F.col("max")]
    values = F.transform(F.array_sort("values"), tx.sanitize_cell)
    value_line = F.when(F.size("values") > 0, F.concat(
        F.lit("- "), tx.sanitize_cell(F.col("column")), F.lit(" ∈ {"), F.array_join(values, ", "), F.lit("}\n"))).otherwise("")
    rows = profiles.select(
        key, "ordinal", (F.col("semantic") != "").alias("_s"),
        md.table_row(*cells).alias("_plain"), md.table_row(*cells, F.col("semantic")).alias("_full"), value_line.alias("_values"))
    texts = rows.groupBy(key).agg(
        F.bool_or("_s").alias("_s"), _sorted_text(["ordinal"], "_plain").alias("_plain"),
        _sorted_text(["ordinal"], "_full").alias("_full"), _sorted_text(["ordinal"], "_values").alias("_values"))
    table = F.when(F.col("_s"), F.concat(F.lit(md.table_head(*base, "Semantic")), "_full")).otherwise(
        F.concat(F.lit(md.table_head(*base)), "_plain"))
    listed = F.when(F.col("_values") != "", F.concat(F.lit("\nValues:\n"), "_values")).otherwise("")
    return texts.select(key, F.concat(table, listed).alias("text"))


def render_constraints(constraints: DataFrame, key: str = "concept_id") -> DataFrame:
    rows = constraints.select(key, "name", "type", md.table_row(F.col("name"), F.col("type"), F.col("definition")).alias("_line"))
    head = F.lit(md.table_head("Name", "Type", "Definition"))
    return rows.groupBy(key).agg(F.concat(head, _sorted_text(["name", "type"], "_line")).alias("text"))


def render_indexes(indexes: DataFrame, key: str = "concept_id") -> DataFrame:
    line = md.table_row(F.col("name"), F.array_join("columns", ", "), F.when(F.col("unique"), "Yes").otherwise("No"))
    head = F.lit(md.table_head("Name", "Columns", "Unique"))
    return indexes.select(key, "name", line.alias("_line")).groupBy(key).agg(
        F.concat(head, _sorted_text(["name"], "_line")).alias("text"))


def render_relationships(relationships: DataFrame, key: str = "source_id") -> DataFrame:
    line = F.format_string("- %s [%s](%s)\n", "label", "text", "target")
    rows = relationships.select(key, "target", "label", "text", line.alias("_line"))
    return rows.groupBy(key).agg(_sorted_text(["target", "label", "text"], "_line").alias("text"))


def stats_text() -> Column:
    """``Stats`` content from (row_count, freshness_column, earliest, latest), in the row."""
    count = F.when(F.col("row_count").isNotNull(), F.format_string("- **Row Count**: %d\n", "row_count")).otherwise("")
    known = F.coalesce("freshness_column", F.lit("")) != ""
    ranged = (F.coalesce("earliest", F.lit("")) != "") | (F.coalesce("latest", F.lit("")) != "")
    safe = [tx.sanitize_cell(F.coalesce(c, F.lit(""))) for c in ("freshness_column", "earliest", "latest")]
    fresh = F.when(known & ranged, F.format_string("- **Freshness** (`%s`): %s … %s\n", *safe)).otherwise("")
    return F.concat(count, fresh)


def render_stats(stats: DataFrame, key: str = "concept_id") -> DataFrame:
    return stats.select(key, stats_text().alias("text"))


def render_views(entities: DataFrame, key: str = "concept_id") -> DataFrame:
    return entities.where("kind = 'view'").select(key, md.fenced_sql(F.col("view_sql")).alias("text"))


def render_sample(rows: DataFrame, columns: list[str], order_by: list[str], key: str | None = None) -> DataFrame:
    """``Sample`` table of already sampled rows (see ``profile.sample_rows``)."""
    line = md.table_row(*[F.col(f"`{c}`").cast("string") for c in columns])
    order = [F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order_by)]
    head = F.lit(md.table_head(*[c.replace("|", "\\|") for c in columns]))
    keys = [key] if key else []
    rows = rows.select(*keys, *order, line.alias("_line"))
    names = [f"_o{i}" for i in range(len(order_by))]
    return rows.groupBy(*keys).agg(F.concat(head, _sorted_text(names, "_line")).alias("text"))


def render_listed_sample(rows: DataFrame, key: str = "path") -> DataFrame:
    """``Sample`` tables of rows held as lists: (key, at, names, cells), names the same for all rows of a key."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(F.transform(cells, tx.sanitize_cell), " | "), F.lit(" |\n"))
    head = F.concat(line(F.col("names")), F.lit("| "), F.array_join(F.transform("names", lambda _: F.lit("---")), " | "), F.lit(" |\n"))
    made = rows.select(key, "at", head.alias("_head"), line(F.col("cells")).alias("_line"))
    return made.groupBy(key).agg(F.concat(F.first("_head"), _sorted_text(["at"], "_line")).alias("text"))


def with_sections(bodies: DataFrame, sections: dict[str, DataFrame], key: str = "concept_id") -> DataFrame:
    """Bodies with level-2 sections put in, in the given order: {heading: DF[key, text]}."""
    out = bodies
    for i, (heading, texts) in enumerate(sections.items()):
        named = texts.select(F.col(texts.columns[0]).alias(key), F.col("text").alias(f"_t{i}"))
        added = md.upsert_section(F.col("body"), heading, F.col(f"_t{i}"))
        blank = F.coalesce(F.col(f"_t{i}"), F.lit("")) == ""
        out = out.join(named, key, "left").withColumn("body", F.when(blank, F.col("body")).otherwise(added)).drop(f"_t{i}")
    return out


def with_relationships(bodies: DataFrame, texts: DataFrame, heading: str = "Relationships", key: str = "concept_id") -> DataFrame:
    named = texts.select(F.col(texts.columns[0]).alias(key), F.col("text").alias("_links"))
    joined = bodies.join(named, key, "left")
    return joined.withColumn("body", md.append_section(F.col("body"), heading, F.col("_links"))).drop("_links")
