"""Commits from an exported text log, read in ranges.

The log is that of ``git log --name-only --date=iso-strict`` in its default layout: a ``commit`` line, named fields, a blank line, the
message indented by four blanks, a blank line, and a path a line. Spark cuts the file at line breaks; a commit may
begin in one range and end in another. Every line first gets the last commit line above it in its range, and without one, the last of
earlier ranges: lines of one commit carry its id, and the position of its first line, wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import packed_table

_HEADER = r"^commit ([0-9a-f]{7,64})(?: \(.*\))?$"
_FIELD = r"^(?:Author|AuthorDate|Date|Merge|Commit|CommitDate): "


def _unquote_step():
    """Paths that the log puts in quotes: escapes are those of C, bytes in octal."""
    def plain(path: str) -> str:
        import codecs

        return codecs.escape_decode(path[1:-1].encode())[0].decode("utf-8", "replace")

    @F.pandas_udf(T.StringType())
    def unquote(paths: pd.Series) -> pd.Series:
        return paths.map(plain, na_action="ignore")

    return unquote


_unquote = _unquote_step()


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line): (block, at) is the order of the lines of a file; a block is read by one task, in order."""
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    return text.withColumn("at", F.monotonically_increasing_id()).select("file", "block", "at", "line")


def _fill_step():
    """Rows with the position and id of the last commit line above them, or on them, in their block; none above is null."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last_file = last_block = last_start = last_id = None
        for batch in batches:
            if not len(batch):
                continue
            file, block, at, commit_id = (batch.column(name) for name in ("file", "block", "at", "commit_id"))
            # a commit line, or the first line of a block, is followed by lines that belong to it
            begins = np.ones(len(batch), dtype=bool)
            begins[1:] = np.diff(block.to_numpy()) != 0
            begins[1:] |= pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
            begins[0] = file[0].as_py() != last_file or block[0].as_py() != last_block
            starts = commit_id.is_valid().to_numpy(zero_copy_only=False)
            # 0 stands for the last commit line of the batch before, i + 1 for line i
            line = np.maximum.accumulate(np.where(begins | starts, np.arange(1, len(batch) + 1), 0))
            ids = pa.concat_arrays([pa.array([last_id], commit_id.type), commit_id]).take(pa.array(line))
            start = pa.concat_arrays([pa.array([last_start], at.type), pc.if_else(commit_id.is_valid(), at, pa.scalar(None, at.type))]).take(pa.array(line))
            last_file, last_block, last_start, last_id = file[-1].as_py(), block[-1].as_py(), start[-1].as_py(), ids[-1].as_py()
            yield pa.RecordBatch.from_arrays([file, block, at, batch.column("line"), start, ids], names=["file", "block", "at", "line", "start", "commit_id"])

    return fill


_fill = _fill_step()


def numbered(log: DataFrame) -> DataFrame:
    """Lines with the commit they belong to: ``start``, where its first line is, and its id; what stands above the first commit is left out.

    A block is read by one task, in order, so a task keeps the last commit line it has seen; only lines that continue a commit of an
    earlier block meet the blocks, a row each.
    """
    commit_id = F.nullif(F.regexp_extract("line", _HEADER, 1), F.lit(""))
    known = log.select("file", "block", "at", "line", F.when(F.col("line").startswith("commit "), commit_id).alias("commit_id"))
    schema = T.StructType([*log.select("file", "block", "at", "line").schema, T.StructField("start", T.LongType()), T.StructField("commit_id", T.StringType())])
    spark = log.sparkSession  # blocks stay whole, but several go to one file
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    inside = packed_table(known.mapInArrow(_fill, schema).coalesce(parts))
    open_ = inside.where("start IS NULL").drop("start", "commit_id")
    if open_.isEmpty():
        return inside
    # a row per block
    last = F.max(F.when(F.col("start").isNotNull(), F.struct("start", "commit_id"))).alias("last")
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = inside.where("start IS NULL OR at = start").groupBy("file", "block").agg(last).select(
        "file", "block", F.last("last", ignorenulls=True).over(above).alias("last")).where("last IS NOT NULL")
    continued = packed_table(open_.join(before, ["file", "block"]).select("file", "block", "at", "line", "last.start", "last.commit_id"))
    return inside.where("start IS NOT NULL").unionByName(continued)


def _field(name: str) -> Column:
    return F.max(F.when(F.col("line").startswith(f"{name}: "), F.regexp_extract("line", rf"^{name}: +(.*?)\s*$", 1)))


def commits(log: DataFrame) -> DataFrame:
    """(commit_id, author, at, message, path): a row per commit and path, from ``lines``; commits without paths have none.

    The time is that of the author. A message is as long as the commit that holds it; paths, of which a commit may
    have any number, meet their commit in a join.
    """
    held = numbered(log.withColumn("line", F.regexp_replace("line", r"\r$", "")))
    said = F.col("line").startswith("    ")
    head = (F.col("line").rlike(_HEADER) | F.col("line").rlike(_FIELD)) & ~said
    blank = F.col("line") == ""  # blank lines around the message are trimmed
    message = F.array_sort(F.collect_list(F.when(said | blank, F.struct("block", "at", F.substring("line", 5, 1 << 30).alias("text")))))
    by_commit = held.where(head | said | blank).groupBy("start").agg(
        F.regexp_replace(_field("Author"), r" *<[^<>]*>$", "").alias("author"),
        F.coalesce(_field("AuthorDate"), _field("Date")).alias("date"),
        F.regexp_replace(F.array_join(F.transform(message, lambda m: m["text"]), "\n"), r"^\s+|\s+$", "").alias("message"))
    quoted = F.col("line").startswith('"')
    paths = held.where(~head & ~said & ~blank).select(
        "start", "commit_id", F.coalesce(_unquote(F.when(quoted, F.col("line"))), F.col("line")).alias("path"))
    # every commit has a row in by_commit; as an outer join, it is left out where only ids and paths are read
    return paths.join(by_commit, "start", "left").select("commit_id", "author", F.try_to_timestamp("date").alias("at"), "message", "path")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """``commits`` of a log file, or of a folder of them."""
    return commits(lines(spark, path))
