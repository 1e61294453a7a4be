"""Near-duplicates by weighted MinHash signatures made of darts, banded and verified.

A text is the bag of its five-word shingles. Every element owns a fixed random rain of darts over weight
and rank; a text of element weights w catches the darts that fall below its weights. Thrown in order of
rank, each dart is hashed to one of K coordinates, and a coordinate keeps its earliest dart. Two texts
agree in a coordinate with probability equal to their weighted Jaccard similarity. Sets of coordinates
form bands; texts that share a band are compared exactly.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from mdcatalog.llm.common import WordHashes, as_table, components, cut_lineage, fresh, map_batches, mix, shingles, sized_join

WORDS = 5
SIMILARITY = 0.8
#: 32 bands of 6 coordinates: a pair of similarity 0.8 shares a band with probability 0.99994, one of 0.3 with 0.02.
BANDS, ROWS = 32, 6
K = BANDS * ROWS
SEED = 11
#: Texts of a bucket whose pairs become rows; the pairs of larger buckets are formed inside blocks.
PAIRED = 16
#: Texts and shingles of one side of a block.
BLOCK, BLOCK_MASS = 512, 2_000_000
#: Bags whose numbers of shingles lie in classes of this ratio that are not neighbours cannot be similar enough (1 / SIMILARITY, rounded up).
STEP = 1.26

_WORD = re.compile(r"\w+")
_U = np.uint64
# Cumulative probabilities of 0, 1, 2, … darts in a cell of area 1.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1, 16)])))


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def bag(text: str, hashes: WordHashes, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(elements in order, weights): the distinct shingles of a text and how often each occurs."""
    return np.unique(shingles(words(text), hashes, n), return_counts=True)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) / float(1 << 53)


def signature(elements: np.ndarray, weights: np.ndarray, k: int = K, seed: int = SEED) -> np.ndarray:
    """The names of the earliest dart of each of ``k`` coordinates, for a non-empty bag with positive weights.

    The weight axis is cut at 1, 2, 4, …; a slice of width d is cut along the rank axis into cells of
    length 1 / d, so that each cell has area 1 and holds one dart on average. Only cells below the rank up
    to which about k ln k darts fall are opened; should a coordinate stay empty, twice as many follow.
    """
    weights = weights.astype(np.float64)
    wanted = k * np.log(k) + 2 * k
    top = float(weights.max())
    slices = [(0.0, 1.0)]
    while slices[-1][1] < top:
        slices.append((slices[-1][1], 2 * slices[-1][1]))
    with np.errstate(over="ignore"):
        while True:
            limit = wanted / weights.sum()
            ranks, names, places = [], [], []
            for number, (low, high) in enumerate(slices):
                inside = weights > low
                width = high - low
                cells = int(np.ceil(limit * width))
                owner = np.repeat(np.flatnonzero(inside), cells)
                cell = np.tile(np.arange(cells, dtype=np.uint64), int(inside.sum()))
                key = mix(elements[owner] ^ mix(_U(seed) + (_U(number) << _U(32)) + cell))
                darts = np.searchsorted(_POISSON, _unit(mix(key)), side="right")
                owner, cell, key = np.repeat(owner, darts), np.repeat(cell, darts), np.repeat(key, darts)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(darts) - darts, darts)
                name = mix(key + nth.astype(np.uint64) + _U(1))
                rank = (cell + _unit(mix(name ^ _U(0xA5A5A5A5A5A5A5A5)))) / width
                hit = (low + width * _unit(mix(name ^ _U(0x5A5A5A5A5A5A5A5A))) < weights[owner]) & (rank < limit)
                ranks.append(rank[hit])
                names.append(name[hit])
            rank, name = np.concatenate(ranks), np.concatenate(names)
            places = (mix(name ^ _U(0x3C3C3C3C3C3C3C3C)) % _U(k)).astype(np.int64)
            order = np.lexsort((name, rank, places))
            filled, first = np.unique(places[order], return_index=True)
            if len(filled) == k:
                return name[order][first]
            wanted *= 2


def bands(names: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band of ``rows`` coordinates, tied to the band's place."""
    table = names.reshape(-1, rows)
    out = np.arange(len(table), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in range(rows):
            out = mix(out * _U(0x9E3779B97F4A7C15) + table[:, column])
    return out.view(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][left], b[1][right]).sum()
    return float(common / (a[1].sum() + b[1].sum() - common))


def _tag(batch: pa.RecordBatch, at: int, names: list[str], hashes: WordHashes) -> pa.RecordBatch:
    import xxhash

    nodes, signed, masses = [], [], []
    for text in batch.column(at).to_pylist():
        found = words(text or "")
        elements, weights = np.unique(shingles(found, hashes, WORDS), return_counts=True)
        nodes.append(np.uint64(xxhash.xxh3_64_intdigest(" ".join(found))).astype(np.int64).item() if found else None)
        signed.append(bands(signature(elements, weights)) if found else None)
        masses.append(int(weights.sum()))
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(nodes, pa.int64()), pa.array(signed, pa.list_(pa.int64())), pa.array(masses, pa.int64())],
        names=[*batch.schema.names, *names])


def _compare(batch: pa.RecordBatch, hashes: WordHashes) -> pa.RecordBatch:
    keep, known = [], {}
    for a, left, right in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
        if a not in known:  # one centre is compared with many texts
            if len(known) >= 64:
                known.clear()
            known[a] = bag(left, hashes)
        keep.append(weighted_jaccard(known[a], bag(right, hashes)) >= SIMILARITY)
    return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


class Tagged:
    """A written copy of a table with a row number, and each row's node, band hashes and number of shingles."""

    def __init__(self, docs: DataFrame, text: str):
        self.columns, self.text = docs.columns, text
        self.row, self.node, self.bands, self.mass = (fresh(docs, f"near_{n}") for n in ("row", "node", "bands", "mass"))
        names, at = [self.node, self.bands, self.mass], docs.columns.index(text)
        schema = StructType.fromJson(docs.schema.jsonValue()).add(self.node, LongType()).add(self.bands, ArrayType(LongType())).add(self.mass, LongType())
        tagged = map_batches(docs, lambda batch, hashes: _tag(batch, at, names, hashes), schema, WordHashes)
        self.table = as_table(tagged.withColumn(self.row, F.monotonically_increasing_id()))

    def rows(self, doc_id: str) -> DataFrame:
        return self.table.select(F.col(self.row).alias("row"), F.col(doc_id).cast("bigint").alias("doc_id"), F.col(self.node).alias("node"))

    def texts(self, pairs: DataFrame) -> DataFrame:
        """(node, mass, text) of the nodes of some pairs; one of the rows of equal words stands for them."""
        wanted = cut_lineage(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
        held = self.table.select(F.col(self.node).alias("node"), F.col(self.mass).alias("mass"), F.col(self.row).alias("row"))
        one = cut_lineage(sized_join(held, wanted, ["node"]).groupBy("node").agg(F.min("row").alias("row")))
        full = self.table.select(F.col(self.row).alias("row"), F.col(self.mass).alias("mass"), F.col(self.text).alias("text"))
        return as_table(sized_join(full, one, ["row"]).select("node", "mass", "text"))


def _verify(pairs: DataFrame, tagged: Tagged) -> DataFrame:
    """Of checkpointed pairs (a, b) those whose bags are similar enough."""
    texts = tagged.texts(pairs)
    left = texts.select(F.col("node").alias("a"), F.col("mass").alias("mass_a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("mass").alias("mass_b"), F.col("text").alias("text_b"))
    both = (pairs.join(right, "b").join(left, "a")
            .where(F.least("mass_a", "mass_b") >= SIMILARITY * F.greatest("mass_a", "mass_b"))  # a much lighter bag cannot be similar enough
            .select("a", "b", "text_a", "text_b"))
    return cut_lineage(map_batches(both, _compare, "a bigint, b bigint", WordHashes))


def _further(crowded: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of one bucket and different components that may still be compared.

    In a bucket of up to ``PAIRED`` texts each with each; in larger ones all with another text of the bucket.
    """
    placed = _mixed(crowded, roots)
    small, large = placed.where(F.col("n") <= PAIRED), placed.where(F.col("n") > PAIRED)
    each = (small.select("band", F.col("node").alias("a"), F.col("root").alias("root_a"))
            .join(small.select("band", F.col("node").alias("b"), F.col("root").alias("root_b")), "band").where("a < b AND root_a != root_b"))
    place = F.xxhash64("node", "band")
    first = large.groupBy("band").agg(F.min(place).alias("place"))
    centre = large.withColumn("place", place).join(first, ["band", "place"]).select("band", F.col("node").alias("a"), F.col("root").alias("root_a"))
    star = large.join(centre, "band").where("root != root_a").select("a", F.col("node").alias("b"))
    return each.select("a", "b").unionByName(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()


def _mixed(crowded: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of the buckets that hold several components, with their roots."""
    placed = crowded.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("band")
    return as_table(placed.join(mixed, "band"))


def _compare_block(block: pa.Table) -> pa.Table:
    """Links of the outer texts of a block with its inner ones, one for each outer text and inner component."""
    hashes = WordHashes()
    node, root, outer = (block.column(c).to_numpy() for c in ("node", "root", "outer"))
    texts, a, b = block.column("text"), [], []
    inner = np.flatnonzero(~outer)
    bags = [bag(texts[int(i)].as_py(), hashes) for i in inner]
    if bags:
        known, codes = np.unique(np.concatenate([e for e, _ in bags]), return_inverse=True)
        weights = np.concatenate([w for _, w in bags])
        begins = np.cumsum([0] + [len(e) for e, _ in bags[:-1]])
        masses, looked = np.add.reduceat(weights, begins), np.zeros(len(known), weights.dtype)
        for i in np.flatnonzero(outer):
            elements, own = bag(texts[int(i)].as_py(), hashes)
            at = np.minimum(np.searchsorted(known, elements), len(known) - 1)
            held = known[at] == elements
            looked[at[held]] = own[held]
            common = np.add.reduceat(np.minimum(looked[codes], weights), begins)
            looked[at[held]] = 0
            hit = np.flatnonzero((common / (own.sum() + masses - common) >= SIMILARITY) & (root[inner] != root[i]))
            for k in np.unique(root[inner[hit]], return_index=True)[1]:
                a.append(int(node[i]))
                b.append(int(node[inner[hit[k]]]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _remaining(crowded: DataFrame, roots: DataFrame, tagged: Tagged) -> DataFrame:
    """Links of all pairs of one large bucket and different components.

    The texts outside a bucket's largest component meet all its texts of a neighbouring number of shingles,
    both sides dealt into blocks. Pairs are formed inside blocks, rows are links only.
    """
    large = _mixed(crowded.where(F.col("n") > PAIRED), roots)
    most = as_table(large.groupBy("band", "root").agg(F.count(F.lit(1)).alias("members"))
                    .groupBy("band").agg(F.max(F.struct("members", "root"))["root"].alias("most")))
    level = F.floor(F.log("mass") / float(np.log(STEP))).cast("int")
    placed = as_table(sized_join(large, most, ["band"]).select("band", "node", "root", level.alias("level"), (F.col("root") != F.col("most")).alias("outer")))
    side = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(BLOCK_MASS / F.pow(F.lit(STEP), F.col("level") + 1)).cast("int")))
    sizes = as_table(placed.groupBy("band", "level").agg(F.ceil(F.count(F.lit(1)) / side).alias("inner_parts"), F.ceil(F.count_if("outer") / side).alias("outer_parts")))
    near = sizes.withColumn("outer_level", F.explode(F.array(*[F.col("level") + d for d in (-1, 0, 1)]))).select("band", "level", "outer_level", "inner_parts")
    parts = near.join(sizes.select("band", F.col("level").alias("outer_level"), "outer_parts"), ["band", "outer_level"]).where("outer_parts > 0")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    blocks = as_table(parts.withColumn("inner_part", each("inner_parts")).withColumn("outer_part", each("outer_parts"))
                      .withColumn("block", F.xxhash64("band", "level", "outer_level", "inner_part", "outer_part")))
    part = lambda n: F.pmod(F.xxhash64("node", "band"), F.col(n))
    dealt = sized_join(placed, sizes, ["band", "level"])
    inner = sized_join(dealt.withColumn("inner_part", part("inner_parts")).drop("inner_parts", "outer_parts", "outer"),
                       blocks.select("band", "level", "inner_part", "block"), ["band", "level", "inner_part"])
    outer = sized_join(dealt.where("outer").withColumn("outer_part", part("outer_parts")).select("band", F.col("level").alias("outer_level"), "outer_part", "node", "root"),
                       blocks.select("band", "outer_level", "outer_part", "block"), ["band", "outer_level", "outer_part"])
    rows = as_table(inner.select("block", "node", "root", F.lit(False).alias("outer")).unionByName(outer.select("block", "node", "root", F.lit(True).alias("outer"))))
    texts = tagged.texts(rows.select(F.col("node").alias("a"), F.col("node").alias("b"))).select("node", "text")
    return cut_lineage(rows.join(texts, "node").groupBy("block").applyInArrow(_compare_block, "a bigint, b bigint"))


def _labels(tagged: Tagged, doc_id: str) -> DataFrame:
    """(row, doc_id, root, class_id, class_size) per row; a row without words has no root."""
    nodes = as_table(tagged.table.where(F.col(tagged.node).isNotNull()).groupBy(F.col(tagged.node).alias("node"))
                     .agg(F.min(F.col(doc_id).cast("bigint")).alias("least"), F.count(F.lit(1)).alias("copies"), F.first(tagged.bands).alias("bands"),
                          F.first(tagged.mass).alias("mass")))
    member = nodes.select("node", "mass", F.explode("bands").alias("band"))
    crowd = member.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = as_table(member.join(crowd, "band"))
    # the text that shares buckets with most others resembles most of them, as the original of many versions does
    company = crowded.groupBy("node").agg(F.sum("n").alias("company"))
    centre = crowded.join(company, "node").groupBy("band").agg(F.max(F.struct("company", "node"))["node"].alias("centre"))
    star = crowded.join(centre, "band").where("node != centre")
    compared = cut_lineage(star.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
    links = _verify(compared, tagged)
    roots = components(links, "a", "b")
    further = cut_lineage(_further(crowded, roots).join(compared, ["a", "b"], "left_anti"))
    for more in (lambda: _verify(further, tagged), lambda: _remaining(crowded, roots, tagged)):
        found = more()
        if found.limit(1).count():
            links = links.unionByName(found)
            roots = components(links, "a", "b")
    named = as_table(nodes.select("node", "least", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    total = named.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    return (tagged.rows(doc_id).join(named.select("node", "root").join(total, "root"), "node", "left")
            .select("row", "doc_id", "root", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("class_size", F.lit(1).cast("bigint")).alias("class_size")))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, class_size) per row of ``docs``: rows of one class are copies or near copies of each other.

    Texts with equal words are one node, named by a 64-bit hash. Two nodes are linked if their shingle bags
    have a weighted Jaccard similarity of at least ``SIMILARITY``; a class is a connected component, named by
    its smallest id. A text of fewer than five words is one shingle. Null, empty and word-less texts are in no
    class: class_id is their own id and class_size 1. Null ids join a class like others but never name it.
    Repeated rows count each. Other columns are ignored; an empty table gives no rows.

    In a band bucket every text is compared with one, the one that shares buckets with most others, and
    copies are expanded nowhere. Buckets whose texts then still belong to several components are compared
    further until no pair of different components is left: up to ``PAIRED`` texts each with each; in larger
    ones all with one more text, then every text outside the largest component with all of about its size.
    """
    return _labels(Tagged(docs.select(doc_id, text), text), doc_id).select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class, that of the smallest id (of repeated rows one); all columns as they were."""
    tagged = Tagged(docs, text)
    labels = as_table(_labels(tagged, doc_id).where("class_size > 1"))
    kept = labels.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("root").agg(F.min("row").alias("kept"))
    dropped = cut_lineage(labels.join(kept, "root").where("row != kept").select(F.col("row").alias(tagged.row)))
    return sized_join(tagged.table, dropped, [tagged.row], "left_anti").select(*docs.columns)
