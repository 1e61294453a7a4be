"""Support for enriching descriptions: candidates, triage, tag hints, glossary, scores.

No model is called; these are the deterministic rules around one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import paths as pt
from ..functions import text as tx
from ..session import cut_lineage
from . import audit, docs


def up_to_date() -> Column:
    """A written description whose structure has not changed since."""
    marked = (F.col("enriched_against") != "") & (F.col("enriched_against") == F.col("content_hash"))
    return marked & ~tx.is_placeholder(F.col("description"))


def skip_set(concepts: DataFrame) -> DataFrame:
    return docs.readable(concepts).where(up_to_date()).select("bundle", "concept_id")


def candidates(concepts: DataFrame) -> DataFrame:
    """Concepts with a placeholder description."""
    return docs.readable(concepts).where(tx.is_placeholder(F.col("description")) & ~up_to_date()).select(
        "bundle", "concept_id", "title", "description", pt.parent_dir(F.col("concept_id")).alias("dir"))


def triage(concepts: DataFrame, row_counts: DataFrame) -> DataFrame:
    """Candidates by falling link degree, then row count: ``row_counts(bundle, concept_id, row_count)``."""
    ranked = audit.concept_degrees(concepts).where(tx.is_placeholder(F.col("description")))
    joined = ranked.join(row_counts, ["bundle", "concept_id"], "left")
    # a table, as sorting looks at its rows twice
    return cut_lineage(joined.select("bundle", "concept_id", "degree", "row_count")).orderBy(
        F.desc("degree"), F.desc_nulls_last("row_count"), "bundle", "concept_id")


def directory_batches(concepts: DataFrame) -> DataFrame:
    """Number of candidates per directory; the members are the rows of ``candidates``."""
    return candidates(concepts).groupBy("bundle", "dir").agg(F.count("*").alias("concepts"))


def is_pii_column(name: Column, semantic: Column) -> Column:
    """A column named for personal data, or holding e-mail addresses.

    Conservative: the name must carry one of the words as a whole ``_``-separated part; for
    values of a telling type the word may stand anywhere.
    """
    words = "|".join(fv.PII_NAMES)
    named = F.lower(name).rlike(rf"(^|_)({words})(_|$)")
    telling = semantic.isin(fv.PII_SEMANTICS) & F.lower(name).rlike(words)
    return named | telling | (semantic == "email")


def pii_tags(columns: DataFrame, profiles: DataFrame) -> DataFrame:
    """Concepts that deserve the tag ``pii``, with the columns that say so."""
    known = profiles.select("bundle", "concept_id", F.col("column").alias("name"), "semantic")
    joined = columns.select("bundle", "concept_id", "ordinal", "name").join(known, ["bundle", "concept_id", "name"], "left")
    hits = joined.where(is_pii_column(F.col("name"), F.coalesce("semantic", F.lit(""))))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "name"))), lambda x: x["name"])
    return hits.groupBy("bundle", "concept_id").agg(F.lit("pii").alias("tag"), F.array_join(listed, ",").alias("columns"))


def join_tables(er_columns: DataFrame) -> DataFrame:
    """Concepts whose columns are all primary or foreign keys, with at least one foreign key."""
    return er_columns.groupBy("bundle", "concept_id").agg(
        F.bool_and(F.col("pk") | F.col("fk")).alias("_all"), F.bool_or("fk").alias("_any")
    ).where("_all AND _any").select("bundle", "concept_id", F.lit("join-table").alias("tag"))


def add_tags(concepts: DataFrame, suggested: DataFrame) -> DataFrame:
    """Concepts with suggested (bundle, concept_id, tag) added to their sorted tag set."""
    extra = suggested.groupBy("bundle", "concept_id").agg(F.collect_set("tag").alias("_new"))
    none = F.array().cast("array<string>")
    union = F.array_union(F.coalesce("tags", none), F.coalesce("_new", none))
    tags = F.when(F.col("_new").isNull(), F.col("tags")).otherwise(F.array_sort(F.array_remove(union, "")))
    return concepts.join(extra, ["bundle", "concept_id"], "left").withColumn("tags", tags).drop("_new")


def fk_cardinality(fks: DataFrame, unique_columns: DataFrame) -> DataFrame:
    """one-to-one for a foreign key on a unique column, else many-to-one.

    ``unique_columns(schema, table, column)``: single-column unique or primary keys, declared
    or found by a profile (distinct = non-null).
    """
    unique = unique_columns.select("schema", "table", "column").distinct().withColumn("_unique", F.lit(True))
    kind = F.when(F.col("_unique"), "one-to-one").otherwise("many-to-one")
    return fks.join(unique, ["schema", "table", "column"], "left").select(
        "schema", "table", "column", "ref_table", "ref_column", kind.alias("cardinality"))


def unique_by_profile(profiles: DataFrame) -> DataFrame:
    """Columns that identify rows, by their profile."""
    return profiles.where("distinct = non_null AND non_null > 0")


def fill_from_glossary(columns: DataFrame, glossary: DataFrame) -> DataFrame:
    """Empty column comments filled from ``glossary(term, definition)``; others are kept.

    Only rows with an empty comment meet the glossary: the rest never move, and the join is
    left to the optimizer, which broadcasts the glossary when its size allows.
    """
    blank = tx.trim_ws(F.coalesce("comment", F.lit(""))) == ""
    terms = glossary.select(F.col("term").alias("name"), "definition")
    filled = columns.where(blank).join(terms, "name", "left").withColumn("comment", F.coalesce("definition", F.lit("")))
    kept = columns.where(~blank)
    return filled.select(*columns.columns).unionByName(kept)


# --- evaluation scores: (concept, dimension, score) ---------------------------


def score_means(scores: DataFrame) -> DataFrame:
    return scores.groupBy("dimension").agg(F.avg("score").alias("mean"), F.count("*").alias("n"))


def score_regressions(means: DataFrame, baseline: DataFrame) -> DataFrame:
    """Dimensions whose mean fell by more than the allowed variance."""
    before = baseline.select("dimension", F.col("mean").alias("baseline"))
    return means.select("dimension", "mean").join(before, "dimension").withColumn(
        "regressed", F.col("baseline") - F.col("mean") > fv.REGRESSION_DROP)


def redo_concepts(scores: DataFrame) -> DataFrame:
    """Concepts with a low score on a decisive dimension."""
    low = F.col("dimension").isin(fv.REDO_DIMENSIONS) & (F.col("score") <= fv.REDO_SCORE)
    return scores.where(low).select("concept").distinct()


def review_queue(scores: DataFrame) -> DataFrame:
    """Concepts by ascending total score."""
    return scores.groupBy("concept").agg(F.sum("score").alias("total")).orderBy("total", "concept")


def score_band(score: Column) -> Column:
    band = F.lit(None).cast("string")
    for name, (low, high) in fv.SCORE_BANDS.items():
        band = F.when(score.between(low, high), F.lit(name)).otherwise(band)
    return band


def band_check(scores: DataFrame, expected: DataFrame) -> DataFrame:
    """Scores outside the expected band: ``expected(concept, label, dimension, band)``."""
    keys = [c for c in ("concept", "label", "dimension") if c in scores.columns and c in expected.columns]
    return scores.withColumn("actual_band", score_band(F.col("score"))).join(expected, keys).where("actual_band <> band")
