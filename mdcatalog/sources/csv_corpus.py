"""CSV files of any size and number, each with its own header, in a constant number of jobs.

Files are cut into byte ranges. Whether a range begins inside quotes depends on all quotes before it, so
a first pass emits the parity of each range's quotes and the first record start for either case; a running sum over the
few range rows picks the right one. In a second pass every range parses the records that start in it. Records stay
tall, (file, position, cells), until their columns are known, and types and profiles are inferred per file and
column from (file, column, value) rows: no file gets a plan of its own.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import text as tx
from ..operators import profile
from ..session import as_table

#: Bytes of a range, and of a block that a task looks at.
RANGE_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20
#: Records of one batch.
BATCH = 2_048

_QUOTE, _NEWLINE = 34, 10


def _first_starts(blocks: Iterator[bytes], begin: int) -> tuple[bool, int | None, int | None]:
    """(odd number of quotes, first record start if the range begins outside quotes, and if it begins inside)."""
    import numpy as np

    odd, starts, at = False, [None, None], begin
    for block in blocks:
        if None in starts:
            data = np.frombuffer(block, np.uint8)
            newlines = np.flatnonzero(data == _NEWLINE)
            if len(newlines):
                inside = (np.searchsorted(np.flatnonzero(data == _QUOTE), newlines) + odd) & 1
                for case in (0, 1):
                    # outside quotes if the quotes seen so far are even, counted from the case
                    hits = newlines[inside == case] if starts[case] is None else ()
                    if len(hits):
                        starts[case] = at + int(hits[0]) + 1
        odd ^= bool(block.count(b'"') & 1)
        at += len(block)
    return odd, starts[0], starts[1]


def _scan_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pandas as pd
    from pyarrow import fs

    for batch in batches:
        out = []
        for path, uri, size, number, begin, end in batch.itertuples(index=False):
            system, name = fs.FileSystem.from_uri(uri)
            with system.open_input_file(name) as file:
                file.seek(begin)
                out.append((path, uri, size, number, *_first_starts((file.read(min(BLOCK_BYTES, end - at)) for at in range(begin, end, BLOCK_BYTES)), begin)))
        result = pd.DataFrame(out, columns=["path", "uri", "size", "number", "odd", "outside", "inside"])
        yield result.astype({"outside": "Int64", "inside": "Int64"})


def ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, uri, number, start, stop): where the records that start in each range begin and end.

    A range in which no record starts is left out; its bytes belong to an earlier one.
    """
    last = F.greatest(F.ceil(F.col("size") / range_bytes) - 1, F.lit(0))
    cut = (files.where("size > 0").select("path", "uri", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("number"))
           .withColumn("begin", F.col("number") * range_bytes).withColumn("end", F.least("size", F.col("begin") + range_bytes)))
    # ranges are few and each is work for a task
    scanned = as_table(cut.repartition("path", "number").mapInPandas(
        _scan_ranges, "path string, uri string, size bigint, number bigint, odd boolean, outside bigint, inside bigint"))
    order = Window.partitionBy("path").orderBy("number")
    quotes = F.coalesce(F.sum(F.col("odd").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = F.when(F.col("number") == 0, F.lit(0).cast("bigint")).when(quotes % 2 == 0, F.col("outside")).otherwise(F.col("inside"))
    started = scanned.withColumn("start", start).where(F.col("start") < F.col("size"))
    return started.withColumn("stop", F.coalesce(F.lead("start").over(order), F.col("size"))).select("path", "uri", "number", "start", "stop")


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
    import pyarrow as pa
    from pyarrow import fs

    csv.field_size_limit(sys.maxsize)
    names = ["path", "number", "at", "cells"]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for row in batch.to_pylist():
            system, name = fs.FileSystem.from_uri(row["uri"])
            with system.open_input_file(name) as file:
                file.seek(row["start"])
                text = file.read(row["stop"] - row["start"]).decode("utf-8", "replace")
            if row["start"] == 0:
                text = text.removeprefix("﻿")
            rows = []
            for at, cells in enumerate(c for c in csv.reader(io.StringIO(text, newline="")) if c):  # blank lines are no records
                rows.append((row["path"], row["number"], at, cells))
                if len(rows) == BATCH:
                    yield made(rows)
                    rows = []
            if rows:
                yield made(rows)


def records(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, number, at, cells) of every record of CSV files ``files(path, uri, size)``, headers included; (number, at) is the order in a file.

    Quoting is that of RFC 4180; bytes that are no UTF-8 are replaced. A task holds one range and its records at a time, and a
    record that is longer than a range.
    """
    return ranges(files, range_bytes).repartition("path", "number").mapInArrow(_parse, "path string, number bigint, at bigint, cells array<string>")


def _is_header() -> Column:
    return (F.col("number") == 0) & (F.col("at") == 0)


def headers(found: DataFrame) -> DataFrame:
    """(path, names): the first record of each file, which starts in its first range."""
    return as_table(found.where(_is_header()).select("path", F.col("cells").alias("names")))


def cells(found: DataFrame, names: DataFrame) -> DataFrame:
    """(path, number, at, ordinal, column, value) of every cell under a header; missing cells are null, further ones are left out."""
    rows = found.where(~_is_header()).join(names, "path")
    return rows.select("path", "number", "at", F.posexplode("names").alias("ordinal", "column"), "cells").select(
        "path", "number", "at", "ordinal", "column", F.get("cells", F.col("ordinal")).alias("value"))


def infer_types(found: DataFrame, names: DataFrame, cap: int | None = 1000) -> DataFrame:
    """(path, column, ordinal, type) of every column of every file, from its first ``cap`` rows or all; a column without values is ``string``."""
    rows = found if cap is None else profile.head_per_group(found.where(~_is_header()), cap, ["path"], ["number", "at"])
    seen = cells(rows, names).select("path", "ordinal", tx.blank_to_null(F.col("value")).alias("v"))
    verdicts = profile.types_of(seen, ["path", "ordinal"])
    every = names.select("path", F.posexplode("names").alias("ordinal", "column"))
    return every.join(verdicts, ["path", "ordinal"], "left").select("path", "column", "ordinal", F.coalesce("type", F.lit("string")).alias("type"))


def profile_files(found: DataFrame, names: DataFrame, types: DataFrame, low_cardinality: int = fv.LOW_CARDINALITY) -> DataFrame:
    """(path, column, ordinal, non_null, nulls, distinct, min, max, semantic, values) of every column of every file.

    Values are trimmed and blanks count as null; ranges are numeric where the inferred type is; the semantic type is judged by
    every value. Values meet as frequencies, so a file or a value that holds a third of all rows is summed up before the shuffle.
    """
    value = tx.blank_to_null(F.col("value")).alias("value")
    freq = cells(found, names).select("path", "ordinal", value).groupBy("path", "ordinal", "value").agg(F.count(F.lit(1)).alias("n"))
    number = F.col("value").try_cast("double")
    key = ["path", "ordinal"]
    shown = F.col("value").isNotNull()
    order = Window.partitionBy(*key).orderBy(F.col("value").asc_nulls_last())
    head = (freq.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= low_cardinality + 1) & shown & (F.col("n") > 0))
            .groupBy(*key).agg(F.array_sort(F.collect_list("value")).alias("head")))
    stats = freq.groupBy(*key).agg(
        F.sum(F.when(shown, F.col("n")).otherwise(0)).alias("non_null"), F.sum(F.when(shown, 0).otherwise(F.col("n"))).alias("nulls"),
        F.count("value").alias("distinct"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.min(number).alias("least"), F.max(number).alias("most"), *profile.evidence_of(F.col("value"), F.col("n")))
    joined = types.join(stats, key, "left").join(head, key, "left")
    numeric = F.col("type").isin("integer", "number")
    zero, none = F.lit(0).cast("bigint"), F.array().cast("array<string>")
    return joined.select(
        "path", "column", "ordinal", *[F.coalesce(c, zero).alias(c) for c in ("non_null", "nulls", "distinct")],
        F.when(numeric & F.col("least").isNotNull(), F.col("least").cast("string")).otherwise(F.col("low")).alias("min"),
        F.when(numeric & F.col("most").isNotNull(), F.col("most").cast("string")).otherwise(F.col("high")).alias("max"),
        profile.verdict_of().alias("semantic"),
        F.when(F.col("distinct") <= low_cardinality, F.coalesce("head", none)).otherwise(none).alias("values"))


def sample_texts(found: DataFrame, names: DataFrame, n: int) -> DataFrame:
    """(path, at, cells): the first ``n`` rows of every file, filled up to the header, in order."""
    rows = profile.head_per_group(found.where(~_is_header()), n, ["path"], ["number", "at"]).join(names, "path")
    filled = F.transform("names", lambda _, i: F.coalesce(F.get("cells", i), F.lit("")))
    order = Window.partitionBy("path").orderBy("number", "at")
    return rows.select("path", F.row_number().over(order).alias("at"), filled.alias("cells"))


def wide(spark: SparkSession, found: DataFrame) -> DataFrame:
    """Records of files of one layout as text columns, named by the header of the first file in path order.

    Blank names become ``_c`` and their place; names that occur twice, whatever their case, get their place appended, as Spark's own reader does.
    """
    first = found.where(_is_header()).orderBy("path").select("cells").first()
    if first is None:
        return spark.createDataFrame([], "")
    plain = [name.strip() or f"_c{i}" for i, name in enumerate(first["cells"])]
    folded = [name.lower() for name in plain]
    names = [name if folded.count(name.lower()) == 1 else f"{name}{i}" for i, name in enumerate(plain)]
    return found.where(~_is_header()).select(*[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names)])
