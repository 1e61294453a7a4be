"""Queries over files: the tables are written as CSV files and text logs to the shared folder, then listed and read back.

Every eight customers make a file, in one of six layouts with headers of their own; some cells hold quotes and line
breaks, some rows are short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mdcatalog.operators import cochange
from mdcatalog.session import freed_shuffles, new_folder, scratch
from mdcatalog.sources import csv_corpus, history, listing, readers, writers

from . import star
from .queries import _SEMANTIC, _evidence_sql, query

_KEY = "CAST(c_custkey AS STRING)"
_BREAK = "chr(10)"
# header, value, type if there are values
LAYOUTS = [
    [("id", _KEY, "integer"), ("name", "c_name", "string"), ("balance", "CAST(c_acctbal AS STRING)", "number")],
    [("key", _KEY, "integer"), ("open", "CASE WHEN c_acctbal < 0 THEN 'no' ELSE 'Yes' END", "boolean"),
     ("since", "'19' || CAST(70 + c_nationkey AS STRING) || '-0' || CAST(1 + c_custkey % 9 AS STRING) || '-1' || CAST(c_custkey % 10 AS STRING)", "date")],
    [('note, "quoted"', f"'line one' || {_BREAK} || 'of \"' || c_name || '\", ' || c_mktsegment", "string"), ("id", _KEY, "integer")],
    [("mail", f"'c' || {_KEY} || '@' || lower(c_mktsegment) || '.org'", "string"), ("code", "' A-' || CAST(c_nationkey AS STRING)", "string")],
    [("none", "CASE WHEN c_custkey % 2 = 0 THEN '  ' ELSE '' END", "string"), ("id", _KEY, "integer"), ("maybe", "CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 5 AS STRING) END", "integer")],
    [("price", "'$' || CAST(c_nationkey AS STRING) || '.50'", "string"), ("flag", "CASE WHEN c_acctbal < 0 THEN 't' ELSE 'f' END", "boolean")],
]
_FILE = "CAST(floor(c_custkey / 8) AS BIGINT)"
_PATH = f"'set' || CAST({_FILE} % 6 AS STRING) || '/f' || CAST({_FILE} AS STRING) || CASE WHEN {_FILE} % 7 = 0 THEN '.CSV' ELSE '.csv' END"


def _quoted(value: str) -> str:
    return f"""CASE WHEN {value} LIKE '%"%' THEN '"' || replace({value}, '"', '""') || '"' ELSE {value} END"""


def _line(layout: int) -> str:
    cells = [_quoted(value) for _, value, _ in LAYOUTS[layout]]
    if layout == 4:  # a short row where the last cell is missing
        return f"{cells[0]} || ',' || {cells[1]} || coalesce(',' || {LAYOUTS[4][2][1]}, '')"
    return " || ',' || ".join(cells)


def _header(layout: int) -> str:
    return ",".join('"' + name.replace('"', '""') + '"' if '"' in name else name for name, _, _ in LAYOUTS[layout])


LINES = " UNION ALL ".join(f"SELECT {_PATH} AS path, c_custkey AS row, '{_header(i)}' AS header, {_line(i)} AS line FROM {{customer}} WHERE {_FILE} % 6 = {i}" for i in range(6))
CELLS = " UNION ALL ".join(
    f"""SELECT {_PATH} AS path, {j} AS ordinal, '{name}' AS "column", '{kind}' AS kind, {value} AS raw, nullif(trim({value}), '') AS value FROM {{customer}} WHERE {_FILE} % 6 = {i}"""
    for i, columns in enumerate(LAYOUTS) for j, (name, value, kind) in enumerate(columns))


def _write(spark: SparkSession, sf: str) -> str:
    """The folder that the files were written to."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "line"))), lambda r: F.concat(r["line"], F.lit("\n"))), "")
    files = star.run_sql(spark, sf, LINES).groupBy("path").agg(F.concat(F.first("header"), F.lit("\n"), lines).alias("content"))
    folder = new_folder(spark)
    writers.write_files(files, folder)
    return folder


@query(f"""SELECT path, "column", ordinal, CASE WHEN count(value) = 0 THEN 'string' ELSE kind END AS type FROM ({CELLS}) GROUP BY path, "column", ordinal, kind""")
def csv_file_types(spark, sf) -> DataFrame:
    found, names = readers.read_csv_files(spark, _write(spark, sf))
    return csv_corpus.infer_types(found, names)


_BOUND = """CASE WHEN kind IN ('integer', 'number') THEN CAST({0}(TRY_CAST(value AS DOUBLE)) AS STRING) ELSE {0}(value) END"""


@query(f"""SELECT path, "column", ordinal, non_null, nulls, "distinct", "min", "max", {_SEMANTIC} ELSE '' END AS semantic, "values" FROM (
    SELECT path, "column", ordinal, count(value) AS non_null, count(*) - count(value) AS nulls, count(DISTINCT value) AS "distinct",
      {_BOUND.format('min')} AS "min", {_BOUND.format('max')} AS "max", {_evidence_sql('1')},
      CASE WHEN count(DISTINCT value) BETWEEN 1 AND 12 THEN string_agg(DISTINCT value, ',' ORDER BY value) ELSE '' END AS "values"
    FROM ({CELLS}) GROUP BY path, "column", ordinal, kind)""")
def csv_file_profiles(spark, sf) -> DataFrame:
    found, names = readers.read_csv_files(spark, _write(spark, sf))
    return csv_corpus.profile_files(found, names, csv_corpus.infer_types(found, names)).withColumn("values", F.array_join("values", ","))


@query(f"""SELECT path, "column", ordinal, count(*) AS "rows", CAST(coalesce(sum(length(raw)), 0) AS BIGINT) AS characters, CAST(coalesce(sum(length(raw) - length(replace(raw, chr(10), ''))), 0) AS BIGINT) AS breaks
    FROM ({CELLS}) GROUP BY path, "column", ordinal""")
def csv_range_cells(spark, sf) -> DataFrame:
    """Ranges of 50 bytes, so that most borders are inside of a record, many inside of quotes."""
    found, names = readers.read_csv_files(spark, _write(spark, sf), range_bytes=50)
    breaks = F.length("value") - F.length(F.replace("value", F.lit("\n"), F.lit("")))
    return csv_corpus.cells(found, names).groupBy("path", "column", "ordinal").agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.length("value")), F.lit(0)).alias("characters"), F.coalesce(F.sum(breaks), F.lit(0)).alias("breaks"))


@query(f"""SELECT path, false AS is_dir, CAST(length(any_value(header)) + 1 + sum(length(line) + 1) AS BIGINT) AS size FROM ({LINES}) WHERE path NOT LIKE 'set3/%' AND path NOT LIKE '%.CSV' GROUP BY path
    UNION ALL SELECT DISTINCT split_part(path, '/', 1), true, CAST(NULL AS BIGINT) FROM ({LINES}) WHERE path NOT LIKE 'set3/%'""")
def file_tree(spark, sf) -> DataFrame:
    return listing.tree(spark, _write(spark, sf), ["/set3/", "*.CSV"]).select("path", "is_dir", "size")


# --- Spark's catalog: the tables as views ------------------------------------------------------------

_LISTED = ["customer", "orders", "events", "nation"]
_TYPES = "CASE c.data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(c.data_type) END"


@query(" UNION ALL ".join(f"""SELECT '{t}' AS "table", 'view' AS kind, c.column_name AS name, CAST(c.ordinal_position AS INTEGER) AS ordinal, {_TYPES} AS type, (SELECT count(*) FROM {{{t}}}) AS "rows"
    FROM information_schema.columns c WHERE c.table_name = '{t}'""" for t in _LISTED))
def spark_catalog(spark, sf) -> DataFrame:
    """Columns of some tables as the session's catalog lists them, with the rows of each table."""
    for t in _LISTED:
        star.table(spark, sf, t).createOrReplaceTempView(f"listed_{t}")
    found = readers.from_spark_catalog(spark, pattern="listed_*")
    rows = None
    for t in _LISTED:
        one = spark.table(f"listed_{t}").agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(f"listed_{t}"))
        rows = one if rows is None else rows.unionByName(one)
    kinds = found["tables"].select(F.col("name").alias("table"), "kind")
    plain = F.regexp_replace("table", "^listed_", "")
    return found["columns"].join(kinds, "table").join(rows, "table").select(plain.alias("table"), "kind", "name", "ordinal", "type", "rows")


# --- history: an order is a commit, the suppliers of its lines are the files ------------------------

_COMMIT = "md5(CAST(o_orderkey AS STRING))"
_AUTHOR = "'Clerk ' || CAST(o_custkey AS STRING)"
_MESSAGE = f"'Order ' || CAST(o_orderkey AS STRING) || {_BREAK} || {_BREAK} || '  commit deadbeef' || {_BREAK} || 'Author: ' || o_orderstatus"
_CHANGED = """'supplier/' || CASE WHEN l_suppkey % 9 = 0 THEN 'ä "' || CAST(l_suppkey AS STRING) || '"' ELSE CAST(l_suppkey AS STRING) END"""
COMMITS = f"""SELECT DISTINCT {_COMMIT} AS commit_id, {_AUTHOR} AS author, o_orderdate AS made, {_MESSAGE} AS message,
    {_CHANGED} AS path FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey"""


def _write_log(spark: SparkSession, sf: str) -> str:
    """Folder of logs of a thousand orders each, as the version control tool prints them, compressed."""
    lines = star.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("suppliers"))
    orders = star.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus").repartition("o_orderkey").distinct()
    # keys are shuffled, and become text where the file is written
    rows = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).withColumn("file", F.floor(F.col("o_orderkey") / 1000)).repartition("file")
    named = rows.select("file", F.col("o_orderkey").alias("row"), F.expr(_COMMIT).alias("commit_id"), F.expr(_AUTHOR).alias("author"),
                        F.col("o_orderdate").alias("made"), F.expr(_MESSAGE).alias("message"), F.expr(f"transform(suppliers, l_suppkey -> {_CHANGED})").alias("paths"))

    def printed(path: Column) -> Column:
        octal = F.replace(F.replace(F.replace(path, F.lit('"'), F.lit('\\"')), F.lit("ä"), F.lit("\\303\\244")), F.lit("\t"), F.lit("\\t"))
        return F.when(path.contains('"'), F.concat(F.lit('"'), octal, F.lit('"'))).otherwise(path)

    message = F.array_join(F.transform(F.split("message", "\n"), lambda m: F.concat(F.lit("    "), m, F.lit("\n"))), "")
    text = F.concat(F.lit("commit "), "commit_id", F.lit("\nAuthor: "), "author", F.lit(" <a@b.c>\nDate:   "), F.date_format("made", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
                    F.lit("\n\n"), message, F.lit("\n"), F.array_join(F.array_sort(F.transform("paths", printed)), "\n"), F.lit("\n\n"))
    files = named.select("file", "row", text.alias("text")).groupBy("file").agg(F.array_sort(F.collect_list(F.struct("row", "text"))).alias("texts"))
    folder = new_folder(spark)
    with freed_shuffles(spark):
        writers.write_files(files.select(F.concat(F.lit("log"), F.col("file").cast("string"), F.lit(".txt.gz")).alias("path"),
                                         F.array_join(F.transform("texts", lambda t: t["text"]), "").alias("content")), folder)
    return folder


@query(f"""SELECT path, commit_id, author, CAST(made AS STRING) AS "at", message FROM (
    SELECT *, row_number() OVER (PARTITION BY path ORDER BY made DESC, commit_id DESC) AS r FROM ({COMMITS})) x WHERE r = 1""")
def history_last_change(spark, sf) -> DataFrame:
    last = cochange.latest_change(history.read_history(spark, _write_log(spark, sf)))
    return last.select("path", "commit_id", "author", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"), "message")


@query(f"""SELECT commit_id, count(*) AS paths, min(path) AS first, max(author) AS author FROM ({COMMITS}) GROUP BY commit_id""")
def history_commits(spark, sf) -> DataFrame:
    found = history.read_history(spark, _write_log(spark, sf))
    return found.groupBy("commit_id").agg(F.count(F.lit(1)).alias("paths"), F.min("path").alias("first"), F.max("author").alias("author"))


@query(f"""SELECT a.path AS a, b.path AS b, count(*) AS n FROM ({COMMITS}) a JOIN ({COMMITS}) b ON a.commit_id = b.commit_id AND a.path < b.path GROUP BY 1, 2 HAVING count(*) >= 2""")
def history_cochange(spark, sf) -> DataFrame:
    with scratch(spark) as keep:  # the log goes when it has been read
        changes = keep(history.read_history(spark, _write_log(spark, sf)).select("commit_id", "path"))
    return cochange.cochange_pairs(cochange.change_sets(changes))
