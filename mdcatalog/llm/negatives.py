"""Hard negatives by segment summary filtering.

A vector's segments are summarised by their mean and their deviation (the length of the segment less its
mean). For two segments of width w the inner product is w times the product of the means, plus or minus at
most the product of the deviations. The bounds of all segments add up to bounds of the score. Segments are
halved level by level; after each level, vectors whose bounds say that they cannot be among the rows
asked for are left out. What is left is scored exactly, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdcatalog.llm.common import as_table, small_batches

POSITIVES = 5
NEGATIVES = 5
#: A component is this many steps a unit.
STEPS = 256
#: Bounds of a negative's score as percent of its positive's.
LEAST_PERCENT, MOST_PERCENT = 80, 100
#: Width of the segments of the last level before exact scores.
NARROWEST = 4
#: Vectors and anchors of a unit of work.
TILE_VECTORS, TILE_ANCHORS = 8_192, 1_024
#: Integers up to here, and sums of their products, are exact in double precision.
EXACT = 1 << 53


class Summaries:
    """Means (times the square root of the width) and deviations of a block of vectors, level by level."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        width = vectors.shape[1]
        segments = 1
        while True:
            edges = np.unique(np.linspace(0, width, segments + 1).round().astype(int))
            widths = np.diff(edges)
            if not len(widths):
                break
            sums = np.add.reduceat(vectors, edges[:-1], axis=1)
            squares = np.add.reduceat(vectors * vectors, edges[:-1], axis=1)
            means = sums / np.sqrt(widths)
            self.levels.append((means, np.sqrt(np.maximum(0, squares - means * means))))
            if widths.max() <= NARROWEST:
                break
            segments *= 2

    def at(self, row: int) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(means[row], deviations[row]) for means, deviations in self.levels]


def bounds(level: tuple[np.ndarray, np.ndarray], of: tuple[np.ndarray, np.ndarray], alive: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest score that the summaries of one level allow, with room for rounding."""
    means, deviations = level if alive is None else (level[0][alive], level[1][alive])
    middle, spread = means @ of[0], deviations @ of[1]
    slack = 1 + 1e-9 * (np.abs(middle) + spread)
    return middle - spread - slack, middle + spread + slack


def largest(values: np.ndarray, k: int) -> float:
    """The ``k``-th largest value, or minus infinity if there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def windows_alive(low: np.ndarray, high: np.ndarray, windows: list[tuple[float, float]], k: int) -> np.ndarray:
    """Which rows may be among the ``k`` largest of at least one window of scores.

    Rows whose bounds lie inside a window are certainly in it: with ``k`` of them, the k-th largest of their
    least scores is what any other row must be able to reach.
    """
    keep = np.zeros(len(low), bool)
    for least, most in windows:
        inside = low[(low >= least) & (high <= most)]
        keep |= (high >= max(least, largest(inside, k))) & (low <= most)
    return keep


def search(held: Summaries, query: np.ndarray, of: list[tuple[np.ndarray, np.ndarray]], eligible: np.ndarray,
           windows: list[tuple[float, float]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of all that may be among the ``k`` best of a window, among the rows ``eligible``."""
    alive = eligible
    for number, level in enumerate(held.levels):
        if len(alive) <= k:
            break
        low, high = bounds(level, of[number], None if len(alive) == len(held.vectors) else alive)
        alive = alive[windows_alive(low, high, windows, k)]
    return alive, (held.vectors[alive] if len(alive) < len(held.vectors) else held.vectors) @ query


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= largest(scores, k))
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def quantized(vectors: DataFrame, label: Column, vec_id: str, embedding: str) -> DataFrame:
    """(id, label, vector) of the rows that take part, one per id; components as whole numbers of steps.

    Of rows that share an id the least by label and vector counts.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(embedding).cast("array<double>").alias("vector"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(finite)
    steps = F.transform("vector", lambda x: F.floor(x * STEPS).cast("bigint"))
    one = rows.withColumn("vector", steps).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("one"))
    return one.select("id", "one.label", "one.vector")


def _tiles(vectors: DataFrame, asks: DataFrame, group: str | None, spark) -> DataFrame:
    """Vectors and asking rows dealt into units of bounded size: every ask meets every vector of its group once.

    ``asks`` has the columns of ``vectors`` and ``windows``. Without a group all are one. The table of unit counts has a row per group.
    """
    count = lambda size: F.ceil(F.count(F.lit(1)) / size).cast("int")
    if group is None:
        chunks, slots = (df.agg(count(size)).first()[0] for df, size in ((vectors, TILE_VECTORS), (asks, TILE_ANCHORS)))
        sized = lambda df: df.withColumn("group", F.lit(0).cast("bigint")).withColumn("chunks", F.lit(chunks)).withColumn("slots", F.lit(slots))
        if not chunks or not slots:
            vectors = vectors.limit(0)
    else:
        vectors, asks = (df.withColumn("group", F.col(group)) for df in (vectors, asks))
        sizes = as_table(vectors.groupBy("group").agg(count(TILE_VECTORS).alias("chunks")).join(asks.groupBy("group").agg(count(TILE_ANCHORS).alias("slots")), "group"))
        few = sizes.limit(10_001).count() <= 10_000
        sized = lambda df: df.join(F.broadcast(sizes) if few else sizes, "group")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    columns = ["group", "chunk", "slot", "kind", "id", "label", "vector", "windows"]
    held = (sized(vectors).withColumn("chunk", deal("chunks")).withColumn("slot", spread("slots"))
            .withColumn("kind", F.lit(0)).withColumn("windows", F.lit(None).cast("array<bigint>")))
    asked = sized(asks).withColumn("slot", deal("slots")).withColumn("chunk", spread("chunks")).withColumn("kind", F.lit(1))
    small_batches(spark)
    both = held.select(columns).unionByName(asked.select(columns))
    return both.repartition("group", "chunk", "slot").sortWithinPartitions("group", "chunk", "slot", "kind")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _scan(tiles: DataFrame, width: int, kind: type, own_label: bool, k: int) -> DataFrame:
    """(anchor_id, window, id, score): what each unit finds, at most ``k`` rows a window.

    ``windows`` holds the bounds of each window one after the other, or is null for a single unbounded one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, ids, labels, parts, held, of_label = None, [], [], [], None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            group, chunk, slot, kinds, numbers, own = (batch.column(i).to_numpy() for i in range(6))
            rows, windows = _matrix(batch.column(6), width).astype(kind), batch.column(7).to_pylist()
            change = (group[1:] != group[:-1]) | (chunk[1:] != chunk[:-1]) | (slot[1:] != slot[:-1]) | (kinds[1:] != kinds[:-1])
            starts = np.flatnonzero(np.r_[True, change])
            out: list[tuple] = []
            for start, end in zip(starts, [*starts[1:], len(kinds)]):
                here = group[start], chunk[start], slot[start]
                if here != tile:
                    tile, ids, labels, parts, held, of_label = here, [], [], [], None, {}
                if kinds[start] == 0:
                    ids.append(numbers[start:end])
                    labels.append(own[start:end])
                    parts.append(rows[start:end])
                    continue
                if not parts:
                    continue
                if held is None:
                    ids, labels, held = [np.concatenate(ids)], [np.concatenate(labels)], Summaries(np.concatenate(parts))
                asking = Summaries(rows[start:end])
                for i in range(end - start):
                    at = start + i
                    mine = own[at]
                    if mine not in of_label:
                        of_label[mine] = np.flatnonzero((labels[0] == mine) == own_label)
                    eligible = of_label[mine]
                    if own_label:  # one row of an id at most
                        eligible = eligible[ids[0][eligible] != numbers[at]]
                    bounds_ = windows[at]
                    ranges = [(-np.inf, np.inf)] if bounds_ is None else list(zip(bounds_[::2], bounds_[1::2]))
                    found, scores = search(held, rows[at], asking.at(i), eligible, ranges, k)
                    for number, (least, most) in enumerate(ranges):
                        fit = np.flatnonzero((scores >= least) & (scores <= most))
                        top = fit[best(ids[0][found[fit]], scores[fit], k)]
                        if len(top):
                            out.append((np.full(len(top), numbers[at]), np.full(len(top), number), ids[0][found[top]], scores[top].astype(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["anchor_id", "window", "id", "score"])

    return tiles.mapInArrow(run, "anchor_id bigint, window bigint, id bigint, score bigint")


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of each group, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: str, label: Column | str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
         vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each anchor and positive.

    ``anchors`` is a condition over the column ``id``. An anchor's positives are its ``positives`` best other
    rows of its label; a positive's negatives are the best ``negatives`` rows of another label whose score is between
    ``LEAST_PERCENT`` and ``MOST_PERCENT`` percent of the positive's. Higher scores come first, ties by the smaller id; the
    result is exact. Null ids and labels, null vectors and those with null or non-finite components take no part, nor do
    vectors of another length than most (of two lengths as frequent, the longer counts). Of rows that share an id the least
    by label and vector counts. Other columns are ignored; an empty table, and a positive without negatives, give no rows.

    Vectors and anchors are dealt into units of bounded size, so a label or a vector that a third of all
    rows share is many units. Scores beyond 2^63 are an error.
    """
    spark = vectors.sparkSession
    rows = as_table(quantized(vectors, F.col(label) if isinstance(label, str) else label, vec_id, embedding))
    most = rows.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"), F.max(F.coalesce(F.array_max(F.transform("vector", F.abs)), F.lit(0))).alias("top"))
    common = most.orderBy(F.desc("n"), F.desc("width")).first()  # one row per length of a vector
    none = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if common is None or not common["width"]:
        return spark.createDataFrame([], none)
    width, top = common["width"], common["top"]
    if top * top * width >= 1 << 63:
        raise ValueError("scores do not fit 64 bits")
    kind = np.float64 if top * top * width < EXACT else np.int64
    rows = rows.where(F.size("vector") == width)
    asks = rows.where(anchors)

    own = _scan(_tiles(rows, asks.withColumn("windows", F.lit(None).cast("array<bigint>")), "label", spark), width, kind, True, positives)
    found = as_table(_first(own, ["anchor_id"], positives).select("anchor_id", "rank", "id", "score"))
    # whole scores s with LEAST * p <= 100 s <= MOST * p
    least = lambda p: F.expr(f"({LEAST_PERCENT} * {p} + pmod(-{LEAST_PERCENT} * {p}, 100)) div 100")
    highest = lambda p: F.expr(f"({MOST_PERCENT} * {p} - pmod({MOST_PERCENT} * {p}, 100)) div 100")
    ranges = (found.withColumn("least", least("score")).withColumn("most", highest("score"))
              .groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("rank", "least", "most"))).alias("best")))
    asked = asks.join(ranges, "id").withColumn("windows", F.flatten(F.transform("best", lambda w: F.array(w["least"], w["most"])))).drop("best")
    asked = as_table(asked)
    other = _scan(_tiles(rows, asked, None, spark), width, kind, False, negatives)
    ranked = _first(other, ["anchor_id", "window"], negatives).withColumn("number", (F.col("window") + 1).cast("int"))
    of = found.select("anchor_id", F.col("rank").alias("number"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(of, ["anchor_id", "number"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


#: Rows whose id 7 divides get the next label.
SHIFTED_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"

ORACLE_SQL = f"""
WITH e AS (SELECT vec_id, {SHIFTED_LABEL} AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_reduce(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]), lambda x, y: x + y)::BIGINT AS score
    FROM e a JOIN e b ON a.vec_id % 100 = 0 AND b.vec_id != a.vec_id),
q AS (SELECT anchor_id, id, score FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT q.anchor_id, q.id AS positive_id, row_number() OVER (PARTITION BY q.anchor_id, q.id ORDER BY p.score DESC, p.id)::INTEGER AS rank,
    p.id AS negative_id, q.score AS positive_score, p.score AS negative_score
FROM q JOIN p ON p.anchor_id = q.anchor_id AND NOT p.same AND 80 * q.score <= 100 * p.score AND 100 * p.score <= 100 * q.score
QUALIFY rank <= 5
"""
