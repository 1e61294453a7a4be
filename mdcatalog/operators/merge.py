"""Incremental merge of freshly produced concepts with the ones a bundle already has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import frontmatter as fm
from ..functions import markdown as md
from ..functions import paths as pt
from ..functions import text as tx
from ..functions.rows import evaluate_once
from ..session import cut_lineage

FIELDS = ["path", "type", "title", "description", "resource", "tags", "timestamp",
          "content_hash", "enriched_against", "body"]


def union_tags(a: Column, b: Column) -> Column:
    """Sorted union of two tag arrays without blanks."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_remove(F.array_union(F.coalesce(a, none), F.coalesce(b, none)), ""))


def merge_concepts(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """One row per fresh concept with ``change``: Creation, Update or "" (kept as it is).

    An unchanged structure returns the existing concept verbatim. A changed one takes the
    fresh structure and keeps what people own: description, enrichment marker, tags, and
    sections the fresh body does not have. Each concept meets at most one counterpart, so
    the join has no hot keys.
    """
    new = evaluate_once(fresh, *[c for c in fresh.columns if c != "content_hash"], tx.structural_hash(F.col("body")).alias("content_hash"))
    keys = ["bundle", "concept_id"]
    n = new.select(*keys, F.struct(*[c for c in FIELDS if c in new.columns]).alias("n"))
    has_extra = "extra" in existing.columns
    kept = FIELDS + (["extra"] if has_extra else [])
    e = existing.where("parse_error IS NULL") if "parse_error" in existing.columns else existing
    e = e.select(*keys, F.struct(*[c for c in kept if c in e.columns]).alias("e"))
    both = n.join(e, keys, "left")
    # Sections only the existing body has: the fresh headings are listed once per row.
    both = evaluate_once(both, *keys, "n", "e", md.headings(F.col("n.body")).alias("_known"))
    both = evaluate_once(both, *keys, "n", "e", md.extra_sections(F.col("e.body"), F.col("_known")).alias("_extras"))

    new_names = [f.name for f in n.schema["n"].dataType.fields]
    old_names = [f.name for f in e.schema["e"].dataType.fields]
    missing = F.col("e").isNull()
    same = F.col("e.content_hash") == F.col("n.content_hash")

    def value(name: str) -> Column:
        ours = F.col(f"n.{name}") if name in new_names else F.lit("")
        theirs = F.col(f"e.{name}") if name in old_names else F.lit("")
        merged = {
            "description": F.when(tx.trim_ws(theirs) != "", theirs).otherwise(ours),
            "enriched_against": theirs,
            "tags": union_tags(ours, theirs) if name == "tags" else None,
            "body": F.when(F.size("_extras") > 0, md.append_sections(ours, F.col("_extras"))).otherwise(ours) if name == "body" else None,
        }.get(name, ours)
        return F.when(missing, ours).when(same, theirs).otherwise(merged)

    change = F.when(missing, "Creation").when(same, "").otherwise("Update")
    extra = [F.col("e.extra").alias("extra")] if has_extra else []
    return evaluate_once(both, *keys, *[value(c).alias(c) for c in FIELDS], *extra, change.alias("change"))


def describe(assets: DataFrame, metadata: DataFrame, key: str = "path") -> DataFrame:
    """Assets with their folder-metadata description, blank ones replaced by ``default``.

    ``metadata`` may be as large as the asset list; the optimizer broadcasts it when small.
    """
    known = metadata.select(key, F.col("description").alias("_text"))
    text = F.coalesce(F.nullif(tx.trim_ws(F.col("_text")), F.lit("")), F.col("default"))
    return assets.join(known, key, "left").withColumn("description", text).drop("_text")


def log_entries(merged: DataFrame, date: str, run: int = 0) -> DataFrame:
    """Change-log rows for concepts that were created or updated.

    Within a day, later runs and, within a run, later paths come first when the log is
    rendered; the sort keys are columns, so no numbering over the whole log is needed.
    """
    verb = F.when(F.col("change") == "Creation", "Established").otherwise("Structure changed for")
    message = F.concat(verb, F.lit(" ["), F.col("title"), F.lit("](/"), F.col("concept_id"), F.lit(".md)."))
    return merged.where("change <> ''").select(
        "bundle", F.lit(date).alias("date"), F.lit(run).alias("run"), F.col("concept_id"),
        F.col("change").alias("kind"), message.alias("message"))


def log_lines(log: DataFrame) -> DataFrame:
    """Lines of each bundle's change log: (bundle, date, run, concept_id, part, line).

    Sort by bundle, date descending, part, run descending, concept_id descending. Heading
    lines (part 0) come from the distinct dates; the title line has an empty part before. The log is
    written once, as headings, bullets and the sort read it anew.
    """
    log = cut_lineage(log)
    bullet = F.concat(F.lit("* **"), F.col("kind"), F.lit("**: "), F.col("message"))
    bullets = log.select("bundle", "date", "run", "concept_id", F.lit(1).alias("part"), bullet.alias("line"))
    heads = log.select("bundle", "date").distinct().select(
        "bundle", "date", F.lit(None).cast("int").alias("run"), F.lit(None).cast("string").alias("concept_id"),
        F.lit(0).alias("part"), F.concat(F.lit("## "), "date").alias("line"))
    return heads.unionByName(bullets)


def sort_log(lines: DataFrame) -> DataFrame:
    return lines.orderBy("bundle", F.desc("date"), "part", F.desc("run"), F.desc("concept_id"))


def index_lines(concepts: DataFrame, default: Column | None = None) -> DataFrame:
    """Bullets of each bundle's root index: (bundle, concept_id, line).

    One row per line, not one string per bundle: a bundle may list billions of concepts.
    """
    blank = F.lit("")
    text = F.coalesce(F.nullif(tx.trim_ws(F.col("description")), blank), default if default is not None else F.col("type"))
    name = F.coalesce(F.nullif("title", blank), pt.base_name(F.col("concept_id")))
    line = F.concat(F.lit("- ["), name, F.lit("]("), F.col("concept_id"), F.lit(".md) - "), text)
    return concepts.select("bundle", "concept_id", line.alias("line"))


def index_head(title: str, intro: str, section: str, version: str, version_key: str = "format_version") -> str:
    """Frontmatter, title and introduction of a root index; its bullets follow."""
    return f'---\n{version_key}: "{version}"\n---\n# {title}\n\n{intro}\n\n## {section}\n\n'


def render_concepts(concepts: DataFrame) -> DataFrame:
    """(bundle, path, content): concepts as files, empty fields left out, fixed field order."""
    fields = {name: F.col(name) for name in [*fv.FRONTMATTER_FIELDS, "extra"] if name in concepts.columns}
    path = F.concat(F.col("concept_id"), F.lit(".md"))
    return concepts.select("bundle", path.alias("path"), F.concat(fm.render(fields), F.col("body")).alias("content"))
