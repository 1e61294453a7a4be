"""Documents as rows: bundles, concepts, sections, tables and links.

Input is ``raw(bundle, path, content)``, one row per Markdown file. Parsing stays inside
the row; rows are exploded only where they must join (links, columns, sections).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import frontmatter as fm
from ..functions import markdown as md
from ..functions import paths as pt
from ..functions import text as tx
from ..functions.rows import evaluate_once

_KNOWN = ["type", "title", "description", "resource", "timestamp", "content_hash", "enriched_against"]


def markdown_files(raw: DataFrame) -> DataFrame:
    """Files with the (case-sensitive) Markdown extension."""
    return raw.where(F.col("path").endswith(".md"))


def parse_concepts(raw: DataFrame) -> DataFrame:
    """One row per concept file; ``parse_error`` is NULL where the frontmatter was readable.

    Only frontmatter outside the flat subset is sent to Python.
    """
    files = markdown_files(raw).where(~pt.is_reserved(F.col("path")))
    content, at = F.col("content"), F.col("_at")
    cut = evaluate_once(files, "bundle", "path", "content", fm.closing(content).alias("_at"))
    split = evaluate_once(cut, "bundle", "path", fm.has_block(content, at).alias("_has"),
                          fm.block(content, at).alias("_yaml"), fm.body(content, at).alias("body"))
    # most blocks are read by a few patterns; only others are taken apart line by line
    yaml, simple, lines = F.col("_yaml"), F.col("_simple"), F.col("_lines")
    split = evaluate_once(split, "bundle", "path", "body", "_has", "_yaml", (F.col("_has") & fm.is_simple(yaml)).alias("_simple"))
    split = evaluate_once(split, "bundle", "path", "body", "_has", "_yaml", "_simple", F.when(simple, fm.simple_keys(yaml)).alias("_keys"))
    once = simple & (F.size(F.array_distinct("_keys")) == F.size("_keys"))
    split = evaluate_once(split, "bundle", "path", "body", "_has", "_yaml", "_keys", once.alias("_simple"))
    split = evaluate_once(split, "bundle", "path", "body", "_has", "_yaml", "_simple", "_keys",
                          F.when(simple, fm.simple_values(yaml)).alias("_values"), F.when(simple, fm.simple_list(yaml, "tags")).alias("_items"))
    split = evaluate_once(split, "bundle", "path", "body", "_has", "_yaml", "_simple", "_keys", "_values", "_items",
                          F.when(~simple, fm.yaml_lines(yaml)).alias("_lines"))
    split = evaluate_once(split, "bundle", "path", "body", "_has", "_yaml", "_simple", "_keys", "_values", "_items", "_lines",
                          (simple | (F.col("_has") & fm.is_flat(lines))).alias("_flat"))
    flat = F.when(simple, F.map_from_arrays("_keys", "_values")).otherwise(fm.flat_fields(lines))
    flat_tags = F.when(simple, F.col("_items")).otherwise(fm.flat_list(lines, "tags"))
    split = split.withColumn("_json", fm.yaml_to_json(F.when(F.col("_has") & ~F.col("_flat"), F.col("_yaml"))))
    loaded = F.from_json("_json", "map<string,string>")
    fields = F.when(F.col("_flat"), flat).otherwise(loaded)
    listed = F.from_json(loaded["tags"], "array<string>")
    tags = F.when(F.col("_flat"), flat_tags).otherwise(F.filter(listed, lambda t: t != ""))
    problem = F.when(F.col("_flat"), F.lit(None).cast("string")).otherwise(loaded["!"])
    error = F.when(~F.col("_has"), F.lit("missing frontmatter boundaries")).otherwise(problem)
    parsed = evaluate_once(split, "bundle", "path", "body", fields.alias("_f"), tags.alias("_t"), error.alias("parse_error"))
    ok = F.col("parse_error").isNull()
    known = [F.when(ok, F.coalesce(F.col("_f")[k], F.lit(""))).alias(k) for k in _KNOWN]
    extra = F.map_filter("_f", lambda k, _: ~k.isin(*_KNOWN, "tags"))
    return parsed.select(
        "bundle",
        pt.strip_md(F.col("path")).alias("concept_id"),
        "path",
        *known,
        F.when(ok, F.coalesce("_t", F.array().cast("array<string>"))).alias("tags"),
        F.when(ok, extra).alias("extra"),
        F.when(ok, F.col("body")).alias("body"),
        "parse_error",
    )


def readable(concepts: DataFrame) -> DataFrame:
    return concepts.where("parse_error IS NULL")


def reserved_files(raw: DataFrame) -> DataFrame:
    """Index and log files with their frontmatter keys; frontmatter that is no YAML mapping has none."""
    content = F.col("content")
    files = markdown_files(raw).where(pt.is_reserved(F.col("path")))
    files = evaluate_once(files, "bundle", "path", "content", fm.has_block(content).alias("_has"), fm.block(content).alias("_yaml"))
    files = files.withColumn("_flat", F.col("_has") & fm.is_flat(fm.yaml_lines(F.col("_yaml"))))
    files = files.withColumn("_json", fm.yaml_to_json(F.when(F.col("_has") & ~F.col("_flat"), F.col("_yaml"))))
    has = F.col("_has")
    plain = F.regexp_extract_all(F.col("_yaml"), F.lit(r"(?dm)^([A-Za-z_][^:\n]*):"), 1)
    loaded = F.array_remove(F.map_keys(F.from_json("_json", "map<string,string>")), "!")
    keys = F.array_sort(F.array_distinct(F.when(F.col("_flat"), plain).otherwise(loaded)))
    return files.select(
        "bundle",
        "path",
        F.when(pt.base_name(F.col("path")) == "index.md", "index").otherwise("log").alias("kind"),
        has.alias("has_frontmatter"),
        F.when(has, keys).otherwise(F.array().cast("array<string>")).alias("keys"),
        F.when(has, fm.body(content)).otherwise(content).alias("body"),
    )


def listing(concepts: DataFrame) -> DataFrame:
    """Frontmatter-only catalog: no bodies are read."""
    return readable(concepts).select("bundle", "concept_id", "type", "title", "description", "resource", "tags")


def with_coverage(concepts: DataFrame) -> DataFrame:
    label = F.when(tx.is_placeholder(F.col("description")), "placeholder").otherwise("enriched")
    return concepts.withColumn("coverage", label)


def keyword_search(raw: DataFrame, pattern: str) -> DataFrame:
    """Files whose text matches; anchor with ``(?m)^type:`` to search frontmatter fields."""
    return raw.where(F.col("content").rlike(pattern)).select("bundle", "path")


def sections(concepts: DataFrame) -> DataFrame:
    """(concept, seq, level, heading, text) for every level-1/2 section."""
    chunk = F.col("chunk")
    return (
        readable(concepts)
        .select("bundle", "concept_id", F.posexplode(md.section_chunks(F.col("body"))).alias("seq", "chunk"))
        .where(md.chunk_level(chunk) > 0)
        .select("bundle", "concept_id", "seq", md.chunk_level(chunk).alias("level"),
                md.chunk_heading(chunk).alias("heading"), md.chunk_text(chunk).alias("text"))
    )


# --- tables ---------------------------------------------------------------


def _table_rows(concepts: DataFrame, section: Column, closed: bool = True) -> DataFrame:
    """(bundle, concept_id, ordinal, header, cells): rows of the first table of a section."""
    lines = F.col("_lines")
    cells = md.split_cells(F.col("_line"))
    found = evaluate_once(readable(concepts), "bundle", "concept_id", section.alias("_section"))
    found = evaluate_once(found.where("_section IS NOT NULL"), "bundle", "concept_id", md.table_lines(F.col("_section"), closed).alias("_lines"))
    rows = (
        found.where(F.size(lines) > 1)
        .select("bundle", "concept_id", F.transform(md.split_cells(lines[0]), F.lower).alias("header"), "_lines")
        .select("bundle", "concept_id", "header", F.posexplode(F.slice(lines, F.lit(2), F.size(lines))).alias("ordinal", "_line"))
    )
    return evaluate_once(rows, "bundle", "concept_id", "ordinal", "header", cells.alias("cells")).where(~md.is_divider(F.col("cells")))


def parse_columns(concepts: DataFrame) -> DataFrame:
    """Columns listed under a concept's ``Columns`` heading, found by header name."""
    header, cells = F.col("header"), F.col("cells")

    def cell(*names: str) -> Column:
        return md.header_cell(cells, header, *names)

    rows = _table_rows(concepts, md.get_section(F.col("body"), "Columns", any_level=True))
    return rows.where((md.header_index(header, "name") >= 0) & (cell("name") != "")).select(
        "bundle",
        "concept_id",
        "ordinal",
        cell("name").alias("name"),
        cell("type").alias("type"),
        (F.lower(cell("primary key")) == "yes").alias("pk"),
        (F.lower(cell("nullable")) == "yes").alias("nullable"),
        cell("default").alias("default"),
        cell("comment", "description").alias("comment"),
    )


def comment_stats(concepts: DataFrame) -> DataFrame:
    """Columns and commented columns per concept whose table has a comment column."""
    header = F.col("header")
    rows = _table_rows(concepts, md.get_section(F.col("body"), "Columns", any_level=True), closed=False)
    described = rows.where(md.header_index(header, "comment", "description") >= 0)
    commented = md.header_cell(F.col("cells"), header, "comment", "description") != ""
    return described.groupBy("bundle", "concept_id").agg(
        F.count("*").alias("columns_total"), F.count_if(commented).alias("columns_commented"))


def parse_profiles(concepts: DataFrame) -> DataFrame:
    """Rows of a concept's ``Data Profile`` table; unreadable counts become 0."""
    header, cells = F.col("header"), F.col("cells")

    def cell(name: str) -> Column:
        return md.header_cell(cells, header, name)

    def number(name: str) -> Column:
        return F.coalesce(cell(name).try_cast("bigint"), F.lit(0).cast("bigint"))

    rows = _table_rows(concepts, md.get_section(F.col("body"), "Data Profile"))
    return rows.where((md.header_index(header, "column") >= 0) & (cell("column") != "")).select(
        "bundle",
        "concept_id",
        "ordinal",
        cell("column").alias("column"),
        number("non-null").alias("non_null"),
        number("null").alias("nulls"),
        number("distinct").alias("distinct"),
        cell("min").alias("min"),
        cell("max").alias("max"),
        cell("semantic").alias("semantic"),
    )


# --- links ----------------------------------------------------------------


def links(concepts: DataFrame) -> DataFrame:
    """Every link of every body, matched over the whole text: one row per occurrence."""
    match = F.col("_match")
    return (
        readable(concepts)
        .where(F.col("body").contains("]("))
        .select("bundle", F.col("concept_id").alias("source_id"),
                F.posexplode(F.regexp_extract_all("body", F.lit(fv.LINK), 0)).alias("match_no", "_match"))
        .select("bundle", "source_id", "match_no",
                F.regexp_extract(match, fv.LINK, 1).alias("text"), F.regexp_extract(match, fv.LINK, 2).alias("target"))
    )


def links_by_line(concepts: DataFrame) -> DataFrame:
    """Links with the heading they stand under and the rest of their line.

    Any line that starts with ``#`` opens a new heading; links on such lines are left out.
    Only chunks and lines that can hold a link are looked at closely.
    """
    chunk, line, match = F.col("_chunk"), F.col("_line"), F.col("_match")
    heading_line = (F.col("line_no") == 0) & chunk.rlike(r"\A[^\S\n]*#")
    return (
        readable(concepts)
        .select("bundle", F.col("concept_id").alias("source_id"),
                F.posexplode(F.split("body", r"(?dm)^(?=[^\S\n]*#)")).alias("part_no", "_chunk"))
        .where(chunk.contains("]("))
        .select("bundle", "source_id", "part_no", "_chunk",
                tx.trim_ws(F.regexp_extract(chunk, r"(?d)\A[^\S\n]*#+(.*)", 1)).alias("heading"),
                F.posexplode(F.split(chunk, "\n")).alias("line_no", "_line"))
        .where(line.contains("](") & ~heading_line)
        .select("bundle", "source_id", "part_no", "line_no", "heading", "_line",
                F.posexplode(F.regexp_extract_all(line, F.lit(fv.LINK), 0)).alias("match_no", "_match"))
        .select("bundle", "source_id", "part_no", "line_no", "match_no", "heading",
                F.col("_line").alias("line"),
                F.regexp_extract(match, fv.LINK, 1).alias("text"), F.regexp_extract(match, fv.LINK, 2).alias("target"))
    )


def resolved_links(concepts: DataFrame, by_line: bool = False) -> DataFrame:
    """Links with ``target_id``; external, non-document and self links are dropped."""
    found = links_by_line(concepts) if by_line else links(concepts)
    target = pt.resolve_link(F.col("source_id"), F.col("target"))
    resolved = evaluate_once(found, *found.columns, target.alias("target_id"))
    return resolved.where((F.col("target_id") != "") & (F.col("target_id") != F.col("source_id")))


def citations(concepts: DataFrame) -> DataFrame:
    """Links listed in a concept's ``Citations`` section, in order."""
    section = md.get_section(F.col("body"), "Citations", any_level=True)
    match = F.col("_match")
    return (
        readable(concepts)
        .select("bundle", "concept_id", F.posexplode(F.regexp_extract_all(section, F.lit(fv.LINK), 0)).alias("_no", "_match"))
        .select("bundle", "concept_id", (F.col("_no") + 1).alias("number"),
                F.regexp_extract(match, fv.LINK, 1).alias("text"), F.regexp_extract(match, fv.LINK, 2).alias("target"))
    )
