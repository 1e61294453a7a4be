"""Audit: conformance findings, coverage, broken links, orphans, ranking, gates.

Inputs are ``concepts`` and ``reserved`` as ``docs.parse_concepts`` and
``docs.reserved_files`` return them. All outputs carry ``bundle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import text as tx
from . import docs


def version_rule(version_key: str) -> str:
    return "root-index-" + version_key.replace("_", "-")


def findings(concepts: DataFrame, reserved: DataFrame, version_key: str = "format_version") -> DataFrame:
    """(bundle, path, rule, detail): one row per violation of the catalog format."""
    unparseable = concepts.where("parse_error IS NOT NULL").select(
        "bundle", "path", F.lit(fv.RULE_UNPARSEABLE).alias("rule"),
        F.concat(F.lit("concept has no parseable YAML frontmatter: "), F.col("parse_error")).alias("detail"))
    untyped = docs.readable(concepts).where(tx.trim_ws(F.col("type")) == "").select(
        "bundle", "path", F.lit(fv.RULE_MISSING_TYPE).alias("rule"),
        F.lit("concept frontmatter has an empty `type`").alias("detail"))

    # All index rules at once: each row yields an array of (rule, detail).
    index = reserved.where("kind = 'index'")
    has, keys, root = F.col("has_frontmatter"), F.col("keys"), F.col("path") == "index.md"

    def finding(rule: str, detail: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), detail.alias("detail"))

    def only(condition: Column, rule: str, detail: str) -> Column:
        none = F.array().cast("array<struct<rule:string,detail:string>>")
        return F.when(condition, F.array(finding(rule, F.lit(detail)))).otherwise(none)

    extra = F.transform(
        F.filter(keys, lambda k: k != version_key),
        lambda k: finding(fv.RULE_ROOT_EXTRA_KEYS, F.concat(
            F.lit(f"root index.md frontmatter must contain only {version_key} (found \""), k, F.lit('")'))))
    of_root = F.concat(
        only(~has, version_rule(version_key), f"root index.md must declare {version_key} in frontmatter"),
        extra,
        only(has & ~F.array_contains(keys, version_key), version_rule(version_key),
             f"root index.md frontmatter is missing {version_key}"),
    )
    of_subdir = only(has, fv.RULE_SUBDIR_FRONTMATTER, "subdirectory index.md must not carry frontmatter")
    of_index = index.select("bundle", "path", F.inline(F.when(root, of_root).otherwise(of_subdir)))
    return unparseable.unionByName(untyped).unionByName(of_index)


def missing_type(concepts: DataFrame) -> DataFrame:
    return docs.readable(concepts).where(tx.trim_ws(F.col("type")) == "").select("bundle", "concept_id")


def coverage(concepts: DataFrame) -> DataFrame:
    """One row per bundle: concepts, placeholders, enriched share, commented columns.

    Column comments are counted inside each row, so this is a single aggregation.
    """
    placeholder = tx.is_placeholder(F.col("description"))
    readable = F.col("parse_error").isNull()  # a bundle without readable concepts has a row of zeros
    totals = concepts.groupBy("bundle").agg(
        F.count_if(readable).alias("total_concepts"), F.count_if(readable & placeholder).alias("placeholders"))
    columns = docs.comment_stats(concepts).groupBy("bundle").agg(
        F.sum("columns_total").alias("columns_total"), F.sum("columns_commented").alias("columns_commented"))
    zero = F.lit(0).cast("bigint")
    total, commented = F.coalesce("columns_total", zero), F.coalesce("columns_commented", zero)
    enriched = F.col("total_concepts") - F.col("placeholders")
    return totals.join(columns, "bundle", "left").select(
        "bundle",
        "total_concepts",
        "placeholders",
        enriched.alias("enriched_concepts"),
        tx.percent(enriched, F.col("total_concepts")).alias("enriched_pct"),
        total.alias("columns_total"),
        commented.alias("columns_commented"),
        tx.percent(commented, total).alias("columns_commented_pct"),
    )


def _ids(concepts: DataFrame) -> DataFrame:
    return docs.readable(concepts).select("bundle", F.col("concept_id").alias("target_id"))


def broken_links(concepts: DataFrame) -> DataFrame:
    """One row per link occurrence whose target is no concept of the bundle.

    The links are the streamed side of the anti join, so a target with very many links is
    split by the adaptive skew join instead of gathering in one task.
    """
    resolved = docs.resolved_links(concepts)
    broken = resolved.join(_ids(concepts), ["bundle", "target_id"], "left_anti")
    return broken.select("bundle", "source_id", "target_id",
                         F.concat_ws(" -> ", "source_id", "target_id").alias("link"))


def link_degree(concepts: DataFrame) -> DataFrame:
    """Degree per concept: every occurrence of a working link counts at both its ends.

    Occurrences are added up per (source, target) before they meet the concepts.
    """
    pairs = docs.resolved_links(concepts).groupBy("bundle", "source_id", "target_id").agg(F.count("*").alias("n"))
    working = pairs.join(_ids(concepts), ["bundle", "target_id"], "left_semi")
    ends = F.explode(F.array("source_id", "target_id"))
    return working.select("bundle", ends.alias("concept_id"), "n").groupBy("bundle", "concept_id").agg(
        F.sum("n").alias("degree"))


def concept_degrees(concepts: DataFrame) -> DataFrame:
    """Every concept with its link degree (0 for orphans)."""
    base = docs.readable(concepts).select("bundle", "concept_id", "description")
    degree = F.coalesce("degree", F.lit(0).cast("bigint")).alias("degree")
    return base.join(link_degree(concepts), ["bundle", "concept_id"], "left").select(
        "bundle", "concept_id", "description", degree)


def orphans(concepts: DataFrame) -> DataFrame:
    """Concepts that no working link touches."""
    base = docs.readable(concepts).select("bundle", "concept_id")
    return base.join(link_degree(concepts), ["bundle", "concept_id"], "left_anti")


def enrich_first(concepts: DataFrame) -> DataFrame:
    """Placeholder concepts, most linked first."""
    degrees = concept_degrees(concepts).where(tx.is_placeholder(F.col("description")))
    return degrees.select("bundle", "concept_id", "degree").orderBy(F.desc("degree"), "bundle", "concept_id")


def report(concepts: DataFrame, reserved: DataFrame, version_key: str = "format_version") -> DataFrame:
    """One row per bundle with every number the gates and the text report need."""
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("bundle").agg(F.count("*").alias(name))

    found = findings(concepts, reserved, version_key).groupBy("bundle").agg(
        F.count_if(F.col("rule") != fv.RULE_MISSING_TYPE).alias("structural"),
        F.count_if(F.col("rule") == fv.RULE_MISSING_TYPE).alias("missing_types"))
    base = coverage(concepts)
    bundles = base.select("bundle").unionByName(found.select("bundle")).distinct()
    out = bundles.join(base, "bundle", "left").join(found, "bundle", "left")
    out = out.join(count(broken_links(concepts), "broken_links"), "bundle", "left")
    out = out.join(count(orphans(concepts), "orphans"), "bundle", "left")
    counts = [c for c in out.columns if c != "bundle"]
    return out.fillna(0, subset=counts)


def gates(
    report: DataFrame,
    min_pct: float = 0.0,
    max_broken: int = 0,
    require_types: bool = True,
    strict: bool = False,
) -> DataFrame:
    """(bundle, gate, detail): one row per failed gate, none when a bundle passes."""
    def gate(name: str, failed: Column, detail: Column) -> Column:
        return F.when(failed, F.struct(F.lit(name).alias("gate"), detail.alias("detail")))

    def counted(column: str, tail: str) -> Column:
        return F.concat(F.col(column).cast("string"), F.lit(tail))

    structural, types = F.col("structural"), F.col("missing_types")
    checks = [gate("conformance", structural > 0, counted("structural", " spec-conformance violation(s)"))]
    if require_types:
        checks.append(gate("types", types > 0, counted("missing_types", " concept(s) missing a type")))
    checks.append(gate("broken-links", F.col("broken_links") > max_broken,
                       counted("broken_links", f" broken cross-link(s) (max {max_broken})")))
    if min_pct > 0:
        checks.append(gate("enriched", F.col("enriched_pct") < min_pct,
                           F.format_string(f"%.1f%% enriched < {min_pct:.1f}%% required", "enriched_pct")))
    if strict:
        checks.append(gate("orphans", F.col("orphans") > 0, counted("orphans", " orphan concept(s) with no cross-links")))
    failed = F.filter(F.array(*checks), lambda g: g.isNotNull())
    return report.select("bundle", F.inline(failed))


def text_report(report: DataFrame) -> DataFrame:
    """Head of the text report, one string per bundle; the lists stay tables of their own."""
    columns = F.when(F.col("columns_total") > 0, F.format_string(
        "- columns commented: %d/%d (%.1f%%)\n", "columns_commented", "columns_total", "columns_commented_pct")).otherwise("")
    conformance = F.col("structural") + F.col("missing_types")
    return report.select("bundle", F.concat(
        F.format_string(
            "bundle is %.1f%% enriched (placeholders: %d, broken links: %d, orphans: %d, conformance: %d)\n",
            "enriched_pct", "placeholders", "broken_links", "orphans", conformance),
        F.format_string("- concepts: %d (%d enriched, %d placeholder)\n", "total_concepts", "enriched_concepts", "placeholders"),
        columns,
        F.format_string("- concepts missing type: %d\n", "missing_types"),
        F.format_string("- orphan nodes (no cross-links): %d\n", "orphans"),
        F.format_string("- broken cross-links: %d\n", "broken_links"),
    ).alias("text"))
