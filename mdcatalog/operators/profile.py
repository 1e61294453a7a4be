"""Profiling: counts, distincts, ranges, value sets, semantic types, inferred types, freshness.

Every function returns a DataFrame with one row per column (or field) and scans its
input once. The shape of the main plan:

    scan -> stack to (column, typed value) -> hash aggregate to value frequencies
         -> (a) counts and ranges per column      \\  one shuffle of distinct values,
         -> (b) first values per column (top-k)   /   read twice

(a) ends in a map-side aggregate with a handful of keys, (b) in a rank filter that
Spark limits inside each task before shuffling, so a column that holds most of the
rows, or a value that holds most of a column, never gathers in one task.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from ..functions import text as tx

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _as_text(df: DataFrame, name: str) -> Column:
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, _NESTED):
        return F.to_json(column)
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    return column.cast("string")


def _kind(kind: T.DataType) -> str:
    """The type a column's values are grouped in; columns of one kind share a value column."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(kind, (*_NESTED, T.BinaryType, T.CharType, T.VarcharType, T.NullType)):
        return "string"
    return kind.simpleString()


def _frequencies(df: DataFrame, columns: list[str], blank_as_null: bool) -> tuple[DataFrame, list[str]]:
    """(ordinal, one value column per kind, n): how often each value occurs in each column.

    Values stay in their own types: grouping numbers is cheaper than grouping their text, and
    only distinct values are ever turned into text.
    """
    if blank_as_null:
        cells = [("string", tx.blank_to_null(_as_text(df, c))) for c in columns]
    else:
        cells = []
        for c in columns:
            kind = _kind(df.schema[c].dataType)
            cells.append((kind, _as_text(df, c) if kind == "string" else F.col(f"`{c}`").cast(kind)))
    kinds = sorted({kind for kind, _ in cells})
    rows = []
    for i, (kind, value) in enumerate(cells):
        rows.append(F.lit(i))
        rows += [value if k == kind else F.lit(None).cast(k) for k in kinds]
    names = [f"v{i}" for i in range(len(kinds))]
    tall = df.select(F.stack(F.lit(len(cells)), *rows).alias("ordinal", *names))
    return tall.groupBy("ordinal", *names).agg(F.count("*").alias("n")), names


def _lookup(mapping: dict, key: Column) -> Column:
    pairs = [item for k, v in mapping.items() for item in (F.lit(k), F.lit(v))]
    return F.create_map(*pairs)[key]


def _value_tests(value: Column) -> dict[str, Column]:
    """Semantic types in the order they are tried, and what a value must look like."""
    return {
        "email": value.rlike(fv.EMAIL),
        "uuid": value.rlike(fv.UUID),
        "iso-timestamp": value.rlike(fv.ISO_TIME),
        "monetary": value.rlike(fv.MONETARY),
        "boolean": F.lower(value).isin(fv.BOOLEAN_WORDS),
    }


def evidence_of(value: Column, weight: Column) -> list[Column]:
    """Aggregates that ``verdict_of`` reads: weighted matches per semantic type, and the total."""
    trimmed = tx.trim_ws(value)
    shown = value.isNotNull() & (trimmed != "")
    sums = [F.sum(F.when(shown, weight).otherwise(0)).alias("_shown")]
    for name, test in _value_tests(trimmed).items():
        sums.append(F.sum(F.when(shown & test, weight).otherwise(0)).alias(f"_{name}"))
    return sums


def verdict_of() -> Column:
    """First semantic type that a strong majority of the evidence matches, else ""."""
    verdict = F.lit("")
    for name in reversed(list(_value_tests(F.lit("")))):
        enough = (F.col("_shown") > 0) & (F.col(f"`_{name}`") >= fv.SEMANTIC_MAJORITY * F.col("_shown"))
        verdict = F.when(enough, F.lit(name)).otherwise(verdict)
    return F.coalesce(verdict, F.lit(""))


def semantic_type(counts: DataFrame, key: str, value: str = "value", weight: str | None = None) -> DataFrame:
    """Semantic type per key from (key, value) rows; each row counts once or ``weight`` times."""
    times = F.col(weight) if weight else F.lit(1)
    return counts.groupBy(key).agg(*evidence_of(F.col(value), times)).select(key, verdict_of().alias("semantic"))


def classify_columns(values: DataFrame) -> DataFrame:
    """Semantic type per column from (column, value, distinct) rows of sample values.

    By value; else ``enum`` for a small domain; else ``fk-ish`` for an identifier-like name
    whose values are all integers.
    """
    value = tx.trim_ws(F.col("value"))
    shown = F.col("value").isNotNull() & (value != "")
    scored = values.groupBy("column").agg(
        *evidence_of(F.col("value"), F.lit(1)),
        F.bool_and(F.when(shown, value.rlike(fv.INTEGER))).alias("_integers"),
        F.max("distinct").alias("distinct"),
    )
    return scored.select("column", _classified(F.col("column"), F.col("distinct")).alias("semantic"))


def _classified(name: Column, distinct: Column, low_cardinality: int = fv.LOW_CARDINALITY) -> Column:
    by_value = verdict_of()
    return (
        F.when(by_value != "", by_value)
        .when((distinct > 0) & (distinct <= low_cardinality), F.lit("enum"))
        .when(tx.is_key_name(name) & F.col("_integers"), F.lit("fk-ish"))
        .otherwise(F.lit(""))
    )


def profile(
    df: DataFrame,
    columns: list[str] | None = None,
    low_cardinality: int = fv.LOW_CARDINALITY,
    evidence: str = "head",
    blank_as_null: bool = False,
    types: DataFrame | None = None,
) -> DataFrame:
    """Profile every column of a table in one scan.

    ``evidence="head"`` judges the semantic type by the first ``low_cardinality + 1``
    distinct values (and may answer ``enum`` or ``fk-ish``), ``"all"`` by every value.
    ``blank_as_null`` trims values and counts blanks as null. ``types`` (column, type), as
    ``infer_csv_types`` returns it, makes ranges of text columns numeric where it says so.
    """
    columns = columns or df.columns
    freq, names = _frequencies(df, columns, blank_as_null)
    n = F.col("n")
    present = reduce(or_, [F.col(v).isNotNull() for v in names])
    text = F.coalesce(*[F.col(v).cast("string") for v in names])

    measures = [
        F.sum(F.when(present, n).otherwise(0)).alias("non_null"),
        F.sum(F.when(present, 0).otherwise(n)).alias("nulls"),
        F.sum(present.cast("bigint")).alias("distinct"),
    ]
    for v in names:
        measures += [F.min(v).alias(f"min_{v}"), F.max(v).alias(f"max_{v}")]
    if types is not None:
        as_number = text.try_cast("double")
        measures += [F.min(as_number).alias("min_number"), F.max(as_number).alias("max_number")]
    if evidence == "all":
        measures += evidence_of(text, n)
    stats = freq.groupBy("ordinal").agg(*measures)

    # First values per column. Nulls sort last and are dropped after the ranking, so that this
    # branch reads the same shuffled frequencies as the one above.
    order = Window.partitionBy("ordinal").orderBy(F.col("value").asc_nulls_last())
    ranked = (
        freq.select("ordinal", text.alias("value"), "n")
        .withColumn("rank", F.row_number().over(order))
        .where((F.col("rank") <= low_cardinality + 1) & F.col("value").isNotNull() & (n > 0))
    )
    trimmed = tx.trim_ws(F.col("value"))
    first = [
        F.array_sort(F.collect_list("value")).alias("head"),
        F.bool_and(F.when(trimmed != "", trimmed.rlike(fv.INTEGER))).alias("_integers"),
    ]
    if evidence == "head":
        first += evidence_of(F.col("value"), F.lit(1))
    head = ranked.groupBy("ordinal").agg(*first)

    # A null-safe join: an ordinary one would push "ordinal is not null" below one of the two
    # uses of the frequencies, which would then be computed twice.
    head = head.withColumnRenamed("ordinal", "_ordinal")
    joined = stats.join(head, F.col("ordinal").eqNullSafe(F.col("_ordinal")), "left")
    label = _lookup(dict(enumerate(columns)), F.col("ordinal"))
    distinct, no_values = F.col("distinct"), F.array().cast("array<string>")
    small = (distinct > 0) & (distinct <= low_cardinality)
    semantic = verdict_of() if evidence == "all" else _classified(label, distinct, low_cardinality)

    def bound(side: str) -> Column:
        found = F.coalesce(*[F.col(f"{side}_{v}").cast("string") for v in names])
        if types is None:
            return found
        number = F.when(F.col("_type").isin("integer", "number"), F.col(f"{side}_number").cast("string"))
        return F.coalesce(number, found)

    if types is not None:  # one row per column
        verdicts = types.select(F.col("column").alias("_name"), F.col("type").alias("_type"))
        joined = joined.join(F.broadcast(verdicts), label == F.col("_name"), "left")
    # one row per column, of an empty table too
    every = df.sparkSession.createDataFrame(list(enumerate(columns)), "ordinal int, column string")
    found = joined.select(
        F.col("ordinal").alias("_at"),
        "non_null",
        "nulls",
        "distinct",
        bound("min").alias("min"),
        bound("max").alias("max"),
        semantic.alias("semantic"),
        F.when(small, F.coalesce("head", no_values)).otherwise(no_values).alias("values"),
    )
    zero = F.lit(0).cast("bigint")
    return every.join(found, F.col("ordinal").eqNullSafe(F.col("_at")), "left").select(
        "column", "ordinal", *[F.coalesce(c, zero).alias(c) for c in ("non_null", "nulls", "distinct")],
        "min", "max", F.coalesce("semantic", F.lit("")).alias("semantic"), F.coalesce("values", no_values).alias("values"))


def distinct_values(df: DataFrame, column: str, limit: int = fv.LOW_CARDINALITY + 1) -> DataFrame:
    """First ``limit`` distinct non-null values in text order."""
    value = _as_text(df, column).alias("value")
    return df.select(value).where("value is not null").distinct().orderBy("value").limit(limit)


def null_ratio(profiles: DataFrame) -> DataFrame:
    """Rounded share of nulls per profiled column, and the complementary fill."""
    total = F.col("non_null") + F.col("nulls")
    pct = F.when(total > 0, F.floor(100.0 * F.col("nulls") / total + 0.5)).otherwise(F.lit(0)).cast("int")
    return profiles.withColumn("null_pct", pct).withColumn("fill_pct", 100 - pct)


def sample_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows on an explicit order, every value as text and NULL as ``NULL``."""
    rows = df.orderBy(*order_by).limit(n)
    return rows.select(*[F.coalesce(_as_text(df, c), F.lit("NULL")).alias(c) for c in df.columns])


def head_per_group(df: DataFrame, n: int, group: list[str], order_by: list[str]) -> DataFrame:
    """First ``n`` rows of every group on an explicit order (limited per task before the shuffle)."""
    order = Window.partitionBy(*group).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def types_of(cells: DataFrame, key: list[str]) -> DataFrame:
    """(key, type) from (key, v) rows: the type that all values of a key have; nulls count for nothing."""
    v = F.col("v")
    tests = {
        "integer": tx.is_int64(v),
        "number": tx.is_float64(v),
        "boolean": F.lower(v).isin(fv.CSV_BOOLEAN_WORDS),
        "date": tx.is_iso_date(v),
    }
    verdict = F.lit("string")
    for name in reversed(list(tests)):
        verdict = F.when(F.col(f"all_{name}"), F.lit(name)).otherwise(verdict)
    judged = cells.groupBy(*key).agg(*[F.bool_and(F.when(v.isNotNull(), test)).alias(f"all_{name}") for name, test in tests.items()])
    return judged.select(*key, verdict.alias("type"))


def infer_csv_types(
    df: DataFrame,
    order_by: list[str],
    cap: int | None = None,
    columns: list[str] | None = None,
    group: str | None = None,
) -> DataFrame:
    """Type of each text column from all rows, or from its first ``cap`` rows: (column, ordinal, type).

    A column without values, as in a file that is a header only, is ``string``. With ``group`` (for
    instance a file path) types are inferred per group.
    """
    columns = columns or [c for c in df.columns if c != group]
    first = df if cap is None else df.orderBy(*order_by).limit(cap) if group is None else head_per_group(df, cap, [group], order_by)
    keys = [] if group is None else [F.col(group)]
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("ordinal"), tx.blank_to_null(F.col(f"`{c}`")).alias("v"))
        for i, c in enumerate(columns)
    ])
    grouping = ([group] if group else []) + ["column", "ordinal"]
    seen = first.select(*keys, F.inline(cells))
    if group is None:  # every column has a row, even if the table has none
        none = df.sparkSession.createDataFrame([(c, i, None) for i, c in enumerate(columns)], "column string, ordinal int, v string")
        seen = seen.unionByName(none)
    return types_of(seen, grouping)


_VARIANT_NAMES = {
    "VOID": "null", "BOOLEAN": "boolean", "BIGINT": "number", "DECIMAL": "number", "DOUBLE": "number",
    "FLOAT": "number", "STRING": "string", "DATE": "date", "TIMESTAMP": "date", "ARRAY": "array",
    "OBJECT": "object",
}


def json_type(value: Column) -> Column:
    """JSON type name of a variant value; ``{"$oid"}`` and ``{"$date"}`` wrappers are unwrapped."""
    schema = F.schema_of_variant(value)
    head = F.regexp_extract(schema, "^[A-Z]+", 0)
    plain = F.coalesce(_lookup(_VARIANT_NAMES, head), F.lit("string"))
    return (
        F.when(schema.startswith("OBJECT<`$oid`"), F.lit("objectId"))
        .when(schema.startswith("OBJECT<$oid"), F.lit("objectId"))
        .when(schema.startswith("OBJECT<`$date`") | schema.startswith("OBJECT<$date"), F.lit("date"))
        .otherwise(plain)
    )


def infer_fields(df: DataFrame, json_col: str, group: str | None = None) -> DataFrame:
    """Top-level fields of JSON documents: presence percentage and sorted union of types.

    A field present with value null counts as present, with type ``null``. Texts that are no JSON count
    for nothing; ``unreadable_documents`` counts them.
    """
    docs = df.select(*([F.col(group).alias("collection")] if group else [F.lit("").alias("collection")]),
                     F.try_parse_json(json_col).alias("doc")).where("doc IS NOT NULL")
    fields = df.sparkSession.sql(
        "SELECT d.collection, e.pos, e.key AS field, e.value FROM {docs} d, LATERAL variant_explode_outer(d.doc) e",
        docs=docs,
    )
    # The first row of each document (its only one, without fields, when it is empty) counts it, so
    # that fields and documents come from one scan.
    starts = F.col("pos").isNull() | (F.col("pos") == 0)
    per_field = (
        fields.select("collection", "field", json_type(F.col("value")).alias("type"), starts.alias("starts"))
        .groupBy("collection", "field", "type").agg(F.count("*").alias("n"), F.count_if("starts").alias("starts"))
        .groupBy("collection", "field")
        .agg(F.sum("n").alias("present"), F.sum("starts").alias("starts"), F.array_sort(F.collect_list("type")).alias("types"))
        .withColumn("total", F.sum("starts").over(Window.partitionBy("collection")))
    )
    pct = F.floor(100.0 * F.col("present") / F.col("total") + 0.5).cast("int")
    out = per_field.where("field IS NOT NULL").select(
        *(["collection"] if group else []),
        "field",
        F.array_join("types", " / ").alias("type"),
        pct.alias("presence_pct"),
    )
    return out.withColumnRenamed("collection", group) if group else out


def unreadable_documents(df: DataFrame, json_col: str, group: str | None = None) -> DataFrame:
    """(collection, documents, unreadable): how many texts there are and how many are no JSON."""
    collection = F.col(group) if group else F.lit("")
    bad = F.col(json_col).isNotNull() & F.try_parse_json(json_col).isNull()
    return df.groupBy(collection.alias("collection")).agg(F.count(F.lit(1)).alias("documents"), F.count_if(bad).alias("unreadable"))


def column_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, ordinal, name, type, nullable) rows from the schemas of some tables."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (table, i, f.name, f.dataType.simpleString(), f.nullable,
         "Repeated" if isinstance(f.dataType, T.ArrayType) else "Nullable" if f.nullable else "Required")
        for table, df in tables.items() for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table string, ordinal int, name string, type string, nullable boolean, mode string")


def freshness_column(columns: DataFrame, key: str = "table") -> DataFrame:
    """The column per table that tells how fresh its rows are: by type first, else by name."""
    rank = F.when(F.col("type").rlike(fv.FRESHNESS_TYPE), 1).when(F.col("name").rlike(fv.FRESHNESS_NAME), 2)
    candidates = columns.withColumn("_rank", rank).where("_rank is not null")
    best = candidates.groupBy(key).agg(F.min_by("name", F.struct("_rank", "ordinal")).alias("column"))
    return columns.select(key).distinct().join(best, key, "left")


def pick_freshness_column(df: DataFrame) -> str | None:
    """``freshness_column`` for one DataFrame, from its schema alone."""
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    by_type = [name for name, kind in fields if re.search(fv.FRESHNESS_TYPE, kind)]
    by_name = [name for name, _ in fields if re.search(fv.FRESHNESS_NAME, name)]
    return (by_type or by_name or [None])[0]


def table_stats(df: DataFrame, freshness: str | None = None) -> DataFrame:
    """Row count and range of the freshness column, as one row."""
    column = freshness or pick_freshness_column(df)
    low, high = (F.min(column), F.max(column)) if column else (F.lit(None), F.lit(None))
    return df.agg(
        F.count("*").alias("row_count"),
        F.lit(column).cast("string").alias("freshness_column"),
        low.cast("string").alias("earliest"),
        high.cast("string").alias("latest"),
    )
