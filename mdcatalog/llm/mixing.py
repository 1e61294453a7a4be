"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets an exponential key, divided by its quality weight; in increasing order of keys a
source's documents form a weighted random order. A source's target is met by complete epochs first and
then by the documents of that order until their sizes, summed, reach what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdcatalog.llm.common import as_table, sized_join

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A source is taken at most so many times.
MOST = 3
#: Weight of a document by its quality label, and of one without label.
QUALITY = {1: 2.0, 0: 0.5}
UNKNOWN = 1.0
#: Documents of one source that fall into one bin of keys, about.
BIN = 2048
SEED = "mix"


def uniform(column: str | Column, seed: str = SEED) -> Column:
    """A number between 0 and 1, both excluded, that depends on nothing but the value and the seed."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(column) if isinstance(column, str) else column)), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, docs, mass, target) from one row per source.

    The sum of all sizes is shared by weight; no target exceeds ``most`` times its source, and the excess
    is shared among the others by weight, which settles at min(level × weight, cap) for one common level:
    with sources in order of cap / weight, the level is the first that leaves the next source uncapped.
    """
    whole = Window.partitionBy(F.lit(0))
    order = whole.orderBy(F.asc_nulls_last("source"))
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    rooms = whole.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    by_room = rooms.rowsBetween(Window.unboundedPreceding, -1)
    total, heaviest = F.sum("source_size").over(whole), F.sum("weight").over(whole)
    level = (total - F.coalesce(F.sum("cap").over(by_room), F.lit(0.0))) / (heaviest - F.coalesce(F.sum("weight").over(by_room), F.lit(0.0)))
    ranked = ranked.withColumn("level", level).withColumn("place", F.row_number().over(rooms))
    settled = F.min(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct("place", "level"))).over(whole)["level"]
    return (ranked.withColumn("settled", settled)
            .select("source", "source_size", "docs", "mass", F.least(F.col("settled") * F.col("weight"), F.col("cap")).alias("target")))


def mix(docs: DataFrame, quality: DataFrame | None = None, size: Column | None = None, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per row of ``docs``.

    ``size`` defaults to the number of words between ASCII white space; ``quality`` is (doc_id, weight).
    ``taken`` counts words: complete epochs, plus the whole document where the fractional epoch selects
    it, plus the first words of the one document at which the target is reached. A null text has size 0;
    a null source is a source of its own, last in order; documents without quality weigh ``UNKNOWN``, a
    null or non-positive weight counts as unknown; repeated rows count each; a null id gets the key of the
    empty text. An empty table gives no rows; if all sizes are 0, nothing is taken. Other columns are ignored.

    No source is ever sorted whole: keys fall into bins of about ``BIN`` documents, bins are summed, and
    only the bin in which a source's target ends is ordered document by document.
    """
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint") if size is None else size
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).cast("string").alias("source"), words.alias("size"))
    if quality is None:
        rows = rows.withColumn("weight", F.lit(UNKNOWN))
    else:
        known = quality.where("weight > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("weight").alias("weight"))
        rows = rows.join(known, "doc_id", "left").withColumn("weight", F.coalesce("weight", F.lit(UNKNOWN)))
    # 1 - exp(-key) spreads the keys of documents of mean weight evenly over (0, 1)
    rows = as_table(rows.withColumn("key", -F.log(uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), seed)) / F.col("weight")))

    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"), F.sum("weight").alias("mass"))
    plan = as_table(targets(sums, weights, most)
                    .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
                    .withColumn("rest", F.floor("target").cast("bigint") - F.col("epochs") * F.col("source_size"))
                    .withColumn("slot", F.xxhash64("source")))
    placed = sized_join(rows.withColumn("slot", F.xxhash64("source")), plan.select("slot", "source_size", "docs", "mass", "target", "epochs", "rest"), ["slot"])
    bins = F.ceil(F.col("docs") / BIN)
    placed = placed.withColumn("bin", F.floor((1 - F.exp(-F.col("key") * F.col("mass") / F.col("docs"))) * bins))

    # bins are few, so one source's bins may be summed in order
    filled = placed.groupBy("slot", "bin").agg(F.sum("size").alias("held"), F.first("rest").alias("rest"))
    filled = filled.withColumn("before", F.coalesce(F.sum("held").over(
        Window.partitionBy("slot").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    last = as_table(filled.where("before < rest AND before + held >= rest").select("slot", F.col("bin").alias("last"), "before"))
    placed = sized_join(placed, last, ["slot"], "left")

    inside = placed.where("bin = last")
    upto = Window.partitionBy("slot", "bin").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("room", F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(upto), F.lit(0)))
    inside = inside.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("room"))))
    outside = placed.where("last IS NULL OR bin != last").withColumn("extra", F.when(F.col("bin") < F.col("last"), F.col("size")).otherwise(F.lit(0)))
    both = inside.drop("room").unionByName(outside)
    return both.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("extra")).cast("bigint").alias("taken"))


def label_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, weight) from quality labels."""
    return labels.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.when(F.col("quality") == 1, QUALITY[1]).when(F.col("quality") == 0, QUALITY[0]).alias("weight"))


#: The rows of ``mix`` over documents and labels.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM {documents}),
q AS (SELECT doc_id, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END)::DOUBLE AS weight FROM labels GROUP BY doc_id),
k AS (SELECT d.*, -ln((('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)
    / coalesce(q.weight, 1.0) AS key FROM d LEFT JOIN q USING (doc_id)),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, 3.0::DOUBLE * source_size AS cap,
    ([5.0, 2.0, 1.0]::DOUBLE[])[(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS level,
    row_number() OVER (ORDER BY cap / weight, source ASC NULLS LAST) AS place FROM w WINDOW b AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least((SELECT arg_min(level, place) FROM l WHERE cap >= level * weight) * weight, cap) AS target FROM l),
r AS (SELECT k.doc_id, k.source, k.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
    floor(t.target) AS whole, sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) - k.size AS before
    FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, {extra}size, source_size, target,
    (epochs * size + greatest(0, least(size, whole - epochs * source_size - before)))::BIGINT AS taken FROM r
"""


def oracle(documents: str = "documents", extra: str = "") -> str:
    return ORACLE_SQL.replace("{documents}", documents).replace("{extra}", extra)


__all__ = ["label_weights", "mix", "oracle", "targets", "uniform"]
