"""Helpers shared by the operators: batches for Python steps, word shingles, sized joins, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mdcatalog.session import as_table, cut_lineage, new_folder

#: A side of a join is broadcast only if its counted rows stay below this.
BROADCAST_ROWS = 200_000
#: Bytes of one Arrow batch that Spark hands to a Python step.
BATCH_BYTES = 4 << 20
#: Words a worker remembers the hash of before it starts anew.
WORD_MEMORY = 50_000


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by bytes, so that long texts do not pile up in a worker; a lower bound of the session stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key, None)
    if held is None or not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def map_batches(df: DataFrame, step: Callable, schema, prepare: Callable | None = None) -> DataFrame:
    """Apply ``step`` to each Arrow batch of each partition, without a shuffle.

    With ``prepare``, its result is made once per partition and given to ``step`` as second argument.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more = (prepare(),) if prepare else ()
        for batch in batches:
            out = step(batch, *more)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def row_key(*columns: str) -> Column:
    """A 64-bit key of a row that is never null and equal for equal rows."""
    return F.xxhash64(*columns)


def sized_join(large: DataFrame, small: DataFrame, on: list[str], how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with ``small`` (a written or checkpointed frame): broadcast below a counted number of rows, else by shuffle."""
    return large.join(F.broadcast(small) if small.limit(rows + 1).count() <= rows else small, on, how)


class WordHashes(dict):
    """word → 64-bit hash, remembered while the memory stays small."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= WORD_MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(words: list[str], hashes: WordHashes, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words; a shorter text is one shingle, a text without words none."""
    if not words:
        return np.empty(0, np.uint64)
    each = np.fromiter((hashes[w] for w in words), np.uint64, len(words))
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + each[i:len(words) - n + 1 + i])
    return out


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node of an undirected edge list; root is the least node of its component.

    Each round every node takes the least label among its neighbours and itself, then labels jump to
    their label's label. Labels live in checkpoints; the driver sees one number a round.
    """
    both = as_table(edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
                    .unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct())
    labels = cut_lineage(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("other"), F.col("root").alias("far")), "other")
                .groupBy("node").agg(F.min("far").alias("far")))
        lower = labels.join(near, "node", "left").select("node", "root", F.least("root", F.coalesce("far", "root")).alias("new"))
        jump = lower.alias("l").join(labels.select(F.col("node").alias("new"), F.col("root").alias("jump")), "new", "left")
        following = cut_lineage(jump.select("node", F.col("root").alias("old"), F.least("new", F.coalesce("jump", "new")).alias("root")))
        changed = following.where(F.col("old") != F.col("root")).limit(1).count()
        labels = following.select("node", "root")
        if not changed:
            return labels


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that driver and executors share."""
    return f"{new_folder(spark)}-{purpose}"


__all__ = ["as_table", "cut_lineage"]
