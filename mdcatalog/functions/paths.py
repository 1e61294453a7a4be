"""Column -> Column helpers for slash-separated paths, concept ids and link targets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv


def parent_dir(path: Column) -> Column:
    """Directory of a path, "" at the top level."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def ancestors(path: Column) -> Column:
    """Every ancestor directory of a path, outermost first."""
    parts = F.split(path, "/")
    depth = F.size(parts) - 1
    chain = F.transform(F.sequence(F.lit(1), depth), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return F.when(depth > 0, chain).otherwise(F.array().cast("array<string>"))


def clean_path(path: Column) -> Column:
    """Resolve empty, ``.`` and ``..`` segments; ``..`` above a relative start is kept.

    Paths without such segments, the usual case, skip the fold.
    """
    rooted = path.startswith("/")

    def step(done: Column, seg: Column) -> Column:
        can_pop = (F.size(done) > 0) & (F.element_at(done, -1) != "..")
        return (
            F.when(seg.isin("", "."), done)
            .when((seg == "..") & can_pop, F.slice(done, F.lit(1), F.size(done) - 1))
            .when((seg == "..") & rooted, done)
            .otherwise(F.array_append(done, seg))
        )

    empty = F.array().cast("array<string>")
    folded = F.array_join(F.aggregate(F.split(path, "/"), empty, step), "/")
    folded = F.concat(F.when(rooted, F.lit("/")).otherwise(F.lit("")), folded)
    folded = F.when(folded == "", F.lit(".")).otherwise(folded)
    return F.when(path.rlike(r"(^|/)\.{0,2}(/|$)"), folded).otherwise(path)


def strip_md(path: Column) -> Column:
    return F.regexp_replace(path, r"\.md$", "")


def is_reserved(path: Column) -> Column:
    """Index and log files, at any depth."""
    return base_name(path).isin(fv.RESERVED_FILES)


def resolve_link(source_id: Column, target: Column) -> Column:
    """Concept id a Markdown link points to; "" for external and non-document targets."""
    cut = F.regexp_extract(target, r"^[^#?]*", 0)
    outside = (cut == "") | cut.contains("://") | cut.startswith("mailto:") | ~cut.endswith(".md")
    folder = parent_dir(source_id)
    relative = F.when(folder == "", cut).otherwise(F.concat(folder, F.lit("/"), cut))
    inside = F.when(cut.startswith("/"), F.substring(cut, 2, 2147483647)).otherwise(relative)
    return F.when(outside, F.lit("")).otherwise(strip_md(clean_path(inside)))


def csv_concept_path(asset: Column) -> Column:
    """``sub/x.csv`` -> ``tables/sub/x.md``."""
    return F.concat(F.lit("tables/"), F.regexp_replace(asset, r"\.csv$", ""), F.lit(".md"))


def csv_asset_path(concept_path: Column) -> Column:
    """``tables/sub/x.md`` -> ``sub/x.csv``."""
    return F.concat(F.regexp_replace(F.regexp_replace(concept_path, "^tables/", ""), r"\.md$", ""), F.lit(".csv"))


def concept_path(kind: str, name: Column) -> Column:
    """Bundle path of a concept: files keep their own path, others get a folder per kind."""
    folder = {"file": "", "table": "tables/", "collection": "collections/"}[kind]
    return F.concat(F.lit(folder), name, F.lit(".md"))
