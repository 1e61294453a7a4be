"""Approximate nearest neighbours by inner product: inverted lists scanned with adaptive numbers of dimensions.

Vectors get one more component so that the largest inner product is the smallest distance, and are rotated at
random. Rotated vectors of a list are held in blocks of columns. For a query, the distance to all vectors of
a probed list is summed block by block; after each block a hypothesis test abandons every vector whose partial
distance says that the whole one exceeds the query's threshold. Survivors are scored on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mdcatalog.llm.common import as_table, cut_lineage, map_batches, small_batches

NEIGHBOURS = 20
#: Bounds of the fit: vectors of the sample by a hash of their id, vectors that give a query its first threshold.
SAMPLE, MOST_SAMPLE = 16_384, 131_072
SEEDS = 4_096
#: Vectors of a list on average while there are at most ``LISTS`` lists; beyond, the lists are the square root of the
#: vectors, of ``PER_LIST`` sampled vectors each at least.
LIST = 1_024
LISTS = 256
PER_LIST = 16
#: Share of the sample's true neighbours that the number of probed lists must reach.
RECALL = 0.97
#: Columns of a block; standard errors that a partial distance may be above the threshold's share.
BLOCK = 16
EPSILON = 2.5
#: Queries whose distances are summed together while more than this part of the vectors is alive, and what rounding may
#: change, as part of the squared norms.
TOGETHER, DENSE, ROUNDING = 256, 0.2, 1e-9
#: Vectors and queries of a unit of work.
TILE_VECTORS, TILE_QUERIES = 2_048, 2_048


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in the order of the components."""
    return np.cumsum(vectors * query, axis=1)[:, -1] if vectors.shape[1] else np.zeros(len(vectors))


@dataclass
class Index:
    """What a fit leaves: lists, rotation, the largest norm, and the vectors that give first thresholds."""

    centres: np.ndarray  # rotated, one more column than the vectors
    rotation: np.ndarray
    norm: float
    probes: int
    seed_ids: np.ndarray
    seeds: np.ndarray

    def lift(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Rotated vectors with the further component: what is missing to the largest norm, or 0 for queries."""
        rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0, self.norm ** 2 - (vectors ** 2).sum(axis=1)))
        return np.column_stack([vectors, rest]) @ self.rotation

    def lists(self, lifted: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` nearest lists of each row, nearest first."""
        distance = (self.centres ** 2).sum(axis=1) - 2 * lifted @ self.centres.T
        return np.argsort(distance, axis=1, kind="stable")[:, :n]


def cluster(rows: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Centres of ``k`` clusters by Lloyd's rounds; an empty cluster takes over the row farthest from its centre."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), k, replace=False)].copy()
    for _ in range(rounds):
        distance = (centres ** 2).sum(axis=1) - 2 * rows @ centres.T
        nearest = distance.argmin(axis=1)
        far = np.argsort(-(distance.min(axis=1) + (rows ** 2).sum(axis=1)), kind="stable")
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(1, counts)[:, None], rows[far[:k]])
    return centres


def list_count(count: int) -> int:
    """How many lists ``count`` vectors get: work per query then grows as the square root of the vectors, not in proportion."""
    return int(np.clip(count // LIST, 1, max(LISTS, int(np.sqrt(count)))))


def sample_size(count: int) -> int:
    """Vectors the fit sees: more as the lists become more, up to ``MOST_SAMPLE``."""
    return int(np.clip(PER_LIST * list_count(count), SAMPLE, max(SAMPLE, MOST_SAMPLE)))


def fit(ids: np.ndarray, vectors: np.ndarray, count: int, norm: float, k: int = NEIGHBOURS, seed: int = 3) -> Index:
    """An index from a sample of ``count`` vectors; the number of probes is the least that finds ``RECALL`` of the sample's neighbours."""
    rng = np.random.default_rng(seed)
    width = vectors.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
    index = Index(np.zeros((1, width)), rotation, norm, 1, ids[:SEEDS], vectors[:SEEDS])
    lifted = index.lift(vectors)
    index.centres = cluster(lifted, min(list_count(count), max(1, len(lifted) // PER_LIST)))
    home = index.lists(lifted, 1)[:, 0]
    asking = rng.choice(len(vectors), min(200, len(vectors)), replace=False)
    near = vectors[asking] @ vectors.T
    near[np.arange(len(asking)), asking] = -np.inf
    best = np.argsort(-near, axis=1)[:, :min(k, max(1, len(vectors) - 1))]
    order = index.lists(index.lift(vectors[asking], True), len(index.centres))
    place = np.argsort(order, axis=1)  # of each list, for each query
    needed = np.sort(np.take_along_axis(place, home[best], axis=1).ravel())
    index.probes = int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))]) + 1
    return index


def allowed(limit: float | np.ndarray, seen: int, width: int) -> float | np.ndarray:
    """The partial distance over ``seen`` of ``width`` columns up to which the test does not reject a whole one of ``limit``."""
    return limit if seen == width else limit * seen / width * (1 + EPSILON / np.sqrt(seen)) ** 2


def scan(blocks: list[np.ndarray], query: np.ndarray, limit: float, width: int, start: int = 0, alive: np.ndarray | None = None,
         partial: np.ndarray | None = None) -> np.ndarray:
    """Places of the vectors whose squared distance to ``query`` stays below ``limit``, as far as the tests say.

    From block ``start`` on, for the vectors still ``alive`` with the distances they have so far.
    """
    if alive is None:
        alive, partial = np.arange(len(blocks[0])), np.zeros(len(blocks[0]))
    seen = sum(block.shape[1] for block in blocks[:start])
    for block in blocks[start:]:
        part = (block if len(alive) == len(block) else block[alive]) - query[seen:seen + block.shape[1]]
        partial = partial + np.einsum("ij,ij->i", part, part)
        seen += block.shape[1]
        keep = partial <= allowed(limit, seen, width)
        if not keep.all():
            alive, partial = alive[keep], partial[keep]
            if not len(alive):
                break
    return alive


def scan_many(blocks: list[np.ndarray], queries: np.ndarray, limits: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """``scan`` of many queries: while most vectors are alive, a block's distances to all queries are one matrix product."""
    norms = [np.einsum("ij,ij->i", block, block) for block in blocks]
    slack = ROUNDING * (sum(norms).max() + np.einsum("ij,ij->i", queries, queries))[:, None]
    for begin in range(0, len(queries), TOGETHER):
        part, bound = queries[begin:begin + TOGETHER], limits[begin:begin + TOGETHER, None]
        partial, alive, seen, number = np.zeros((len(part), len(blocks[0]))), np.ones((len(part), len(blocks[0])), bool), 0, 0
        while number < len(blocks) and alive.mean() > DENSE:
            of = part[:, seen:seen + blocks[number].shape[1]]
            partial += norms[number] - 2 * of @ blocks[number].T + np.einsum("ij,ij->i", of, of)[:, None]
            seen += blocks[number].shape[1]
            number += 1
            alive &= partial <= allowed(bound, seen, width) + slack[begin:begin + TOGETHER]
        for i in range(len(part)):
            left = np.flatnonzero(alive[i])
            yield scan(blocks, part[i], limits[begin + i], width, number, left, partial[i, left]) if len(left) and number < len(blocks) else left


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of different ids, ties to the smaller id."""
    order = np.lexsort((ids, -scores))
    if len(order) > 1:
        order = order[np.sort(np.unique(ids[order], return_index=True)[1])]
    return order[:k]


def leading(scores: np.ndarray, ids: np.ndarray, k: int, slack: float) -> np.ndarray:
    """Places of all scores that may be among the ``k`` best of different ids once they are summed in order."""
    if len(scores) <= 2 * k or len(np.unique(ids)) < len(ids):
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    return np.flatnonzero(scores >= least - slack)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, vector) of the rows that take part, equal rows once; vectors as doubles."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def nearest(vectors: DataFrame, asks, k: int = NEIGHBOURS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query found among all other rows.

    ``asks`` is a condition over the column ``id``. Null ids, and vectors that are null, zero or hold null or
    non-finite components, take no part, nor do vectors of another length than that of most of the sample.
    Rows of one id count as one candidate with its best score, and never as neighbours of each other. Ties go
    to the smaller id; with fewer candidates all are returned; an empty table gives no rows.

    The fit sees a bounded sample, every row is indexed and every result comes from the scan of its list. Lists of any size and any number of queries are cut
    into units of bounded size, so a list that holds a third of all rows is many units.
    """
    spark = vectors.sparkSession
    none = "query_id bigint, rank int, vec_id bigint, score double"
    rows = valid(vectors, vec_id, embedding)
    sample = rows.orderBy(F.xxhash64("id", F.lit(29)), "id").limit(sample_size(rows.count())).collect()
    if not sample:
        return spark.createDataFrame([], none)
    lengths = np.array([len(r["vector"]) for r in sample])
    width = int(np.bincount(lengths).argmax())
    sample = [r for r in sample if len(r["vector"]) == width]
    rows = rows.where(F.size("vector") == width)
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    count, square = rows.agg(F.count(F.lit(1)), F.max(squares)).first()
    index = fit(np.array([r["id"] for r in sample]), np.array([r["vector"] for r in sample]), count, float(np.sqrt(square)), k)
    # plain arrays: a broadcast value travels by reference to its class
    shared = spark.sparkContext.broadcast((index.centres, index.rotation, index.norm, index.probes, index.seed_ids, index.seeds))

    def home(batch: pa.RecordBatch, held: Index) -> pa.RecordBatch:
        at = held.lists(held.lift(_matrix(batch.column(1), width)), 1)[:, 0] if batch.num_rows else np.zeros(0)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], names=["id", "vector", "list"])

    def ask(batch: pa.RecordBatch, held: Index) -> pa.RecordBatch:
        """For each query its lists and a distance within which ``k`` vectors lie."""
        matrix, own = _matrix(batch.column(1), width), batch.column(0).to_numpy()
        lists = held.lists(held.lift(matrix, True), held.probes).astype(np.int32) if len(matrix) else np.zeros((0, 1), np.int32)
        limits = []
        for query, own_id in zip(matrix, own):
            found = products(held.seeds, query)
            found[held.seed_ids == own_id] = -np.inf
            top = [i for i in best(found, held.seed_ids, k) if found[i] > -np.inf]
            far = held.norm ** 2 + (query ** 2).sum() - 2 * found[top[-1]] if len(top) == k else np.inf
            limits.append(far * (1 + 1e-9) + 1e-9)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists.tolist(), pa.list_(pa.int32())), pa.array(limits, pa.float64())],
                                          names=["id", "vector", "lists", "distance"])

    take = lambda: Index(*shared.value)
    placed = as_table(map_batches(rows, home, "id bigint, vector array<double>, list int", take))
    queries = as_table(map_batches(rows.where(asks), ask, "id bigint, vector array<double>, lists array<int>, distance double", take))
    asked = queries.select("id", "vector", "distance", F.explode("lists").alias("list"))

    # a row per list
    sizes = placed.groupBy("list").agg(F.count(F.lit(1)).alias("vectors"))
    loads = asked.groupBy("list").agg(F.count(F.lit(1)).alias("queries"))
    tiles = cut_lineage(sizes.join(loads, "list").select("list", F.ceil(F.col("vectors") / TILE_VECTORS).cast("int").alias("chunks"),
                                                         F.ceil(F.col("queries") / TILE_QUERIES).cast("int").alias("slots")))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sides = [(placed.withColumn("distance", F.lit(None).cast("double")), 0, F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"), spread("slots")),
             (asked, 1, spread("chunks"), F.pmod(F.xxhash64("id"), F.col("slots")).cast("int"))]
    both = None
    for side, kind, chunk, slot in sides:
        part = side.join(F.broadcast(tiles), "list").withColumn("chunk", chunk).withColumn("slot", slot).select(
            F.xxhash64("list", "chunk", "slot").alias("tile"), F.lit(kind).alias("kind"), "id", "vector", "distance")
        both = part if both is None else both.unionByName(part)
    small_batches(spark)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tile, ids, matrix, blocks = Index(*shared.value), None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            tiles_, kinds, numbers = (batch.column(i).to_numpy() for i in (0, 1, 2))
            rows_, limits = _matrix(batch.column(3), width), batch.column(4).to_numpy(zero_copy_only=False)
            out: list[tuple] = []
            # runs of equal (tile, kind)
            starts = np.flatnonzero(np.r_[True, (tiles_[1:] != tiles_[:-1]) | (kinds[1:] != kinds[:-1])])
            for start, end in zip(starts, [*starts[1:], len(tiles_)]):
                if tiles_[start] != tile:
                    tile, ids, matrix, blocks = tiles_[start], [], [], None
                if kinds[start] == 0:
                    ids.append(numbers[start:end])
                    matrix.append(rows_[start:end])
                    continue
                if not ids:
                    continue
                if blocks is None:
                    ids, matrix = [np.concatenate(ids)], [np.concatenate(matrix)]
                    lifted = held.lift(matrix[0])
                    blocks = [np.ascontiguousarray(lifted[:, i:i + BLOCK]) for i in range(0, width + 1, BLOCK)]
                own, original = ids[0], matrix[0]
                turned = held.lift(rows_[start:end], True)
                for i, alive in enumerate(scan_many(blocks, turned, limits[start:end], width + 1)):
                    alive = alive[own[alive] != numbers[start + i]]
                    if len(alive):
                        alive = alive[leading(original[alive] @ rows_[start + i], own[alive], k, ROUNDING * held.norm * np.linalg.norm(rows_[start + i]))]
                        scores = products(original[alive], rows_[start + i])
                        top = best(scores, own[alive], k)
                        out.append((np.full(len(top), numbers[start + i]), own[alive][top], scores[top]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "vec_id", "score"])

    found = (both.repartition(F.col("tile")).sortWithinPartitions("tile", "kind")
             .mapInArrow(search, "query_id bigint, vec_id bigint, score double"))
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The exact neighbours, to measure recall with; on tables that the fit holds whole they are the result.
ORACLE_SQL = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]), lambda a, b: a + b) AS score
    FROM e q JOIN e c ON q.vec_id % 20 = 0 AND c.vec_id != q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
