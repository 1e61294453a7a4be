"""Benchmark decontamination: short test items are found inside long documents by MinHash containment.

Items are partitioned by size, in powers of two. For the items of a class a document is cut into
overlapping windows twice as long as the longest item of the class, so that the window and the item are of
comparable size wherever the item stands. A window is sketched by its smallest distinct shingle hashes
(bottom-k MinHash); a window has less than four times the shingles of the smallest item of the class, so if a
share c of an item stands in it, each sketched value is one of the item's with a probability above c / 4. Items that share a sketched value with a document are
candidates, and candidates are verified by the exact containment of their shingles in the whole document.

A shingle of many items would make a candidate of each of them. Items that hold one are looked up by their
rarest shingles instead, so many that a document without any of them cannot hold enough of the item. Items of fewer words
than a shingle are one shingle of their own length.

Everything is a DataFrame operation: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdcatalog.functions.rows import evaluate_once
from mdcatalog.llm.common import BROADCAST_ROWS, as_table, cut_lineage, fresh, sized_join, text_or_empty

WORDS = 5
CONTAINMENT = 0.8
#: Values of a sketch: an item that stands whole in a window is missed with a probability below 0.75^64 < 2^-26,
#: one of which four fifths do below 0.8^64 < 10^-6.
SKETCH = 64
#: Items that may share a shingle before it is common.
COMMON = 16
#: Words of an item at least that is a reason to drop a document.
DROP_WORDS = 3


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def shingles(tokens: Column, n: int = WORDS) -> Column:
    """Hashes of the runs of ``n`` words in order; none for a shorter text."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i, n)))


def size_class(count: Column) -> Column:
    """The exponent of the power of two that reaches ``count``."""
    return F.ceil(F.log2(count.cast("double"))).cast("int")


def sketches(hashes: Column, longest: int, k: int = SKETCH) -> Column:
    """The ``k`` smallest distinct hashes of each window of ``2 * longest`` shingles; windows begin every ``longest``."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(hashes) - longest), F.lit(longest))
    return F.flatten(F.transform(starts, lambda i: F.slice(F.sort_array(F.array_distinct(F.slice(hashes, i, 2 * longest))), 1, k)))


def items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, words, shingles, n, class) of the items that have words; equal rows count once.

    ``words`` is the length of the item's shingles: that of the item itself if it is shorter than a shingle.
    """
    rows = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), words(text_or_empty(text)).alias("tokens"))
    tokens = evaluate_once(rows, "item_id", "tokens", F.least(F.size("tokens"), F.lit(WORDS)).alias("words")).where("item_id IS NOT NULL AND words > 0")
    own = F.when(F.col("words") < WORDS, F.array(F.xxhash64("tokens"))).otherwise(shingles(F.col("tokens")))
    found = tokens.select("item_id", "words", F.array_distinct(own).alias("shingles")).distinct().withColumn("n", F.size("shingles"))
    return found.withColumn("class", size_class(F.col("n")))


def hashed(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The columns to keep, and ``hashes``: the shingle hashes of the text, computed once per row."""
    tokens = evaluate_once(docs, *keep, words(F.col(text)).alias("tokens"))
    return evaluate_once(tokens, *keep, shingles(F.col("tokens")).alias("hashes"))


def rarest(known: DataFrame) -> DataFrame:
    """(value, item): of each item with a common shingle the rarest ones, one more than a document may lack.

    A document that holds ``CONTAINMENT`` of an item's n shingles lacks at most n - ceil(CONTAINMENT n) of them, so it holds one of
    any n - ceil(CONTAINMENT n) + 1. Of other items nothing is returned.
    """
    each = known.select("item", "n", F.explode("shingles").alias("value"))
    often = as_table(each.groupBy("value").agg(F.count(F.lit(1)).alias("often")))
    counted = each.join(often, "value")
    listed = counted.groupBy("item").agg(F.first("n").alias("n"), F.max("often").alias("most"), F.array_sort(F.collect_list(F.struct("often", "value"))).alias("values"))
    enough = F.col("n") - F.ceil(CONTAINMENT * F.col("n") - 1e-9).cast("int") + 1
    return listed.where(F.col("most") > COMMON).select("item", F.explode(F.slice("values", F.lit(1), enough)).alias("at")).select("at.value", "item")


def candidates(docs: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(key, item) of the documents and items that may fit; ``docs`` has a key and ``hashes``.

    Each document is sketched for every class of item sizes; a value that meets an item of another class counts too.
    """
    looked_up = cut_lineage(rarest(known))
    others = known.join(looked_up.select("item").distinct(), "item", "left_anti")
    classes = [r["class"] for r in others.select("class").distinct().orderBy("class").collect()]  # one number a power of two
    found = []
    if classes:
        values = cut_lineage(others.select(F.explode("shingles").alias("value"), "item"))
        sketched = F.array_distinct(F.concat(*[sketches(F.col("hashes"), 1 << c) for c in classes]))
        found.append(sized_join(docs.select(key, F.explode(sketched).alias("value")), values, ["value"]))
    if looked_up.limit(1).count():
        found.append(sized_join(docs.select(key, F.explode(F.array_distinct("hashes")).alias("value")), looked_up, ["value"]))
    pairs = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return pairs.select(key, "item").distinct()


def _short_leaks(rows: DataFrame, short: DataFrame, lengths: list[int], key: str) -> DataFrame:
    """(key, doc_id, item) of the documents that hold an item of fewer words than a shingle."""
    tokens = evaluate_once(rows, key, "doc_id", words(F.col("text")).alias("tokens"))
    runs = F.array_distinct(F.concat(*[shingles(F.col("tokens"), n) for n in lengths]))
    values = cut_lineage(short.select(F.get("shingles", F.lit(0)).alias("value"), "item"))
    return sized_join(tokens.select(key, "doc_id", F.explode(runs).alias("value")), values, ["value"]).select(key, "doc_id", "item")


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = 1) -> DataFrame:
    """(row key, doc_id, item_id, found, n, containment) of every document that holds at least ``CONTAINMENT`` of an item's shingles.

    An item of fewer than five words is one shingle. Null, empty and word-less texts and items match nothing, nor do items of
    fewer than ``least_words`` words; null item ids take no part. Items are told apart by id and text, so repeated items give one row, and
    repeated documents one row each. Other columns are ignored; an empty table on either side gives no rows.
    """
    key = fresh(docs, "leak_key")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return _leaks(rows.withColumn(key, F.xxhash64("doc_id", "text")), benchmark, key, least_words).drop(key)


def _leaks(rows: DataFrame, benchmark: DataFrame, key: str, least_words: int) -> DataFrame:
    """The leaks of rows that have doc_id, text and a key that only equal rows share."""
    known = as_table(items(benchmark).where(F.col("words") >= least_words).withColumn("item", F.xxhash64("item_id", "words", "shingles")))
    lengths = [r["words"] for r in known.select("words").distinct().orderBy("words").collect()]  # five numbers at most
    columns = [F.col(key), F.col("doc_id"), F.col("item_id"), F.col("found"), F.col("n"), (F.col("found") / F.col("n")).alias("containment")]
    found = rows.select(key, "doc_id", F.lit(None).cast("bigint").alias("item_id"), F.lit(0).alias("found"), F.lit(1).alias("n")).limit(0) if not lengths else None
    listed = known.select("item", "item_id", "shingles", "n")
    few = known.limit(BROADCAST_ROWS // 100 + 1).count() <= BROADCAST_ROWS // 100
    if WORDS in lengths:
        pairs = cut_lineage(candidates(hashed(rows, key), known.where(F.col("words") == WORDS), key))
        wanted = pairs.join(F.broadcast(listed) if few else listed, "item")
        # the documents that have candidates, each hashed once more; then one comparison of arrays a pair
        suspects = hashed(sized_join(rows, cut_lineage(pairs.select(key).distinct()), [key]), key, "doc_id")
        both = suspects.join(wanted, key).select(key, "doc_id", "item_id", "n", F.size(F.array_intersect("hashes", "shingles")).alias("found"))
        found = both.where(F.col("found") >= CONTAINMENT * F.col("n"))
    if lengths and lengths[0] < WORDS:
        short = known.where(F.col("words") < WORDS)
        held = _short_leaks(rows, short, [n for n in lengths if n < WORDS], key)
        whole = held.join(F.broadcast(listed) if few else listed, "item").select(key, "doc_id", "item_id", "n", F.lit(1).alias("found"))
        found = whole if found is None else found.unionByName(whole)
    return found.select(columns)


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = DROP_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item of at least ``least_words`` words, all columns as they were.

    Shorter items are everyday words and no sign of a leak; ``find_leaks`` reports them. Null and empty texts are kept, of repeated
    rows all or none; null item ids take no part; with an empty table on the other side all rows stay.
    """
    key = fresh(docs, "leak_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(doc_id).cast("bigint"), text_or_empty(text)))
    rows = keyed.select(key, F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    leaked = cut_lineage(_leaks(rows, benchmark, key, least_words).select(key).distinct())
    return sized_join(keyed, leaked, [key], "left_anti").select(*docs.columns)


#: The rows of ``find_leaks`` over documents and benchmark.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w != '') AS t FROM {documents}),
i AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w != '') AS t FROM benchmark),
bs AS (SELECT DISTINCT item_id, w, array_to_string(t[k:k + w - 1], ' ') AS s FROM (SELECT item_id, t, w, unnest(range(1, len(t) - w + 2)) AS k
    FROM (SELECT *, least(5, len(t)) AS w FROM i WHERE len(t) > 0))),
ds AS (SELECT DISTINCT doc_id, w, array_to_string(t[k:k + w - 1], ' ') AS s FROM (SELECT doc_id, t, w, unnest(range(1, len(t) - w + 2)) AS k
    FROM d, (SELECT DISTINCT w FROM bs) WHERE len(t) >= w)),
n AS (SELECT item_id, count(*)::INTEGER AS n FROM bs GROUP BY item_id),
f AS (SELECT doc_id, item_id, count(*)::INTEGER AS found FROM ds JOIN bs USING (w, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, found, n, found / n AS containment FROM f JOIN n USING (item_id) WHERE found >= 0.8 * n
"""
