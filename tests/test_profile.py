from decimal import Decimal

from pyspark.sql import functions as F

from mdcatalog.operators import profile


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def semantic(spark, cases):
    rows = [(k, v) for k, values in cases.items() for v in values]
    return {r["key"]: r["semantic"] for r in profile.semantic_type(spark.createDataFrame(rows, "key string, value string"), "key").collect()}


def test_semantic_types(spark):
    uuid = "123e4567-e89b-12d3-a456-42661417400"
    got = semantic(spark, {
        "email": ["a@b.co", "c@d.org", "e@f.net"], "uuid": [uuid + "0", uuid + "1"], "iso": ["2024-01-02", "2024-01-02T03:04:05Z"],
        "money": ["$10.00", "$1,234.56"], "decimals": ["10.00", "1234.56"], "bool": ["true", "false", "true"], "bits": ["0", "1", "1", "0"],
        "text": ["hello", "world"], "mostly": ["a@b.co"] * 9 + ["x"], "hardly": ["a@b.co", "x", "y"], "blank": ["", " "]})
    assert got == {"email": "email", "uuid": "uuid", "iso": "iso-timestamp", "money": "monetary", "decimals": "monetary", "bool": "boolean",
                   "bits": "boolean", "text": "", "mostly": "email", "hardly": "", "blank": ""}


def test_classify_columns(spark):
    rows = [("status", v, 3) for v in ("open", "closed", "new")] + [("customer_id", str(i), 5000) for i in range(13)] + [("note", f"t{i}", 40) for i in range(13)]
    got = {r["column"]: r["semantic"] for r in profile.classify_columns(spark.createDataFrame(rows, "column string, value string, distinct bigint")).collect()}
    assert got == {"status": "enum", "customer_id": "fk-ish", "note": ""}


def test_profile_counts_ranges_and_nulls(spark):
    rows = [(1, "a@b.co", Decimal("1.50"), True, [1]), (10, "c@d.org", None, False, None), (2, None, Decimal("-3.25"), True, [2, 3]), (None, "e@f.net", Decimal("10.00"), None, [1])]
    df = spark.createDataFrame(rows, "n int, mail string, d decimal(10,2), ok boolean, l array<int>")
    got = by_column(profile.profile(df))
    n = got["n"]
    assert (n["non_null"], n["nulls"], n["distinct"], n["min"], n["max"], n["values"]) == (3, 1, 3, "1", "10", ["1", "10", "2"])
    assert got["mail"]["semantic"] == "email"
    assert (got["d"]["min"], got["d"]["max"], got["d"]["semantic"]) == ("-3.25", "10.00", "monetary")
    assert (got["ok"]["distinct"], got["ok"]["semantic"], got["ok"]["values"]) == (2, "boolean", ["false", "true"])
    assert got["l"]["values"] == ["[1]", "[2,3]"]
    assert [r["ordinal"] for r in sorted(got.values(), key=lambda r: r["ordinal"])] == [0, 1, 2, 3, 4]


def test_profile_shares_one_shuffle(spark):
    df = profile.profile(spark.range(1000).select(F.col("id"), (F.col("id") % 3).cast("string").alias("s")))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("Range (") == 1


def test_all_null_column_and_empty_table(spark):
    df = spark.createDataFrame([(None,), (None,)], "x string")
    r = profile.profile(df).first()
    assert (r["non_null"], r["nulls"], r["distinct"], r["min"], r["semantic"], r["values"]) == (0, 2, 0, None, "", [])
    none = profile.profile(df.limit(0)).first()
    assert (none["column"], none["non_null"], none["nulls"], none["distinct"], none["min"], none["semantic"], none["values"]) == ("x", 0, 0, 0, None, "", [])
    assert [r["type"] for r in profile.infer_csv_types(df.limit(0), ["x"], columns=["x"]).collect()] == ["string"]


def test_broken_documents_are_counted_and_left_out(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": ',), (None,), ('{"b": 2}',)], "doc string")
    assert {(r["field"], r["presence_pct"]) for r in profile.infer_fields(df, "doc").collect()} == {("a", 50), ("b", 50)}
    assert tuple(profile.unreadable_documents(df, "doc").first()) == ("", 4, 1)


def test_csv_profile(spark):
    df = spark.createDataFrame([(0, "10", "active"), (1, "2", "pending"), (2, "30", " ")], "row int, id string, status string")
    types = profile.infer_csv_types(df, ["row"], columns=["id", "status"])
    got = by_column(profile.profile(df, ["id", "status"], blank_as_null=True, evidence="all", types=types))
    assert (float(got["id"]["min"]), float(got["id"]["max"])) == (2.0, 30.0)
    s = got["status"]
    assert (s["nulls"], s["distinct"], s["values"], s["semantic"]) == (1, 2, ["active", "pending"], "")


def test_infer_csv_types(spark):
    columns = {"a": ["1", "2", "300"], "b": ["1.5", "2", "3.14"], "c": ["true", "no", "yes"], "d": ["2024-01-02", "2025-12-31", ""], "e": ["a", "b", "c"],
               "f": ["1", "two", "3"], "g": ["", " ", None], "h": ["1", "", "2"]}
    rows = [(i, *[v[i] for v in columns.values()]) for i in range(3)]
    df = spark.createDataFrame(rows, "row int, " + ", ".join(f"{c} string" for c in columns))
    got = {r["column"]: r["type"] for r in profile.infer_csv_types(df, ["row"], columns=list(columns)).collect()}
    assert got == {"a": "integer", "b": "number", "c": "boolean", "d": "date", "e": "string", "f": "string", "g": "string", "h": "integer"}
    assert {r["type"] for r in profile.infer_csv_types(df.select("row", "f"), ["row"], cap=1, columns=["f"]).collect()} == {"integer"}
    grouped = profile.infer_csv_types(df.select(F.lit("x.csv").alias("file"), "row", "a", "e"), ["row"], columns=["a", "e"], group="file")
    assert {(r["file"], r["column"], r["type"]) for r in grouped.collect()} == {("x.csv", "a", "integer"), ("x.csv", "e", "string")}


def test_infer_fields(spark):
    docs = ['{"_id": "x1", "total": 10.0, "active": true}', '{"_id": "x2", "total": 20.0}', '{"_id": {"$oid": "5f"}, "total": "n/a", "tags": ["a"], "gone": null, "at": {"$date": 1}}']
    got = {r["field"]: (r["type"], r["presence_pct"]) for r in profile.infer_fields(spark.createDataFrame([(d,) for d in docs], "doc string"), "doc").collect()}
    assert got == {"_id": ("objectId / string", 100), "total": ("number / string", 100), "active": ("boolean", 33), "tags": ("array", 33),
                   "gone": ("null", 33), "at": ("date", 33)}


def test_documents_without_fields_count(spark):
    docs = spark.createDataFrame([("a", '{"x": 1}'), ("a", "{}"), ("a", "{}"), ("b", '{"x": "s", "y": []}')], "c string, doc string")
    got = {(r["c"], r["field"]): (r["type"], r["presence_pct"]) for r in profile.infer_fields(docs, "doc", group="c").collect()}
    assert got == {("a", "x"): ("number", 33), ("b", "x"): ("string", 100), ("b", "y"): ("array", 100)}


def test_freshness(spark):
    rows = [("a", 1, "x_on", "int"), ("a", 2, "created", "timestamp"), ("b", 1, "id", "int"), ("b", 2, "paid_at", "text"), ("c", 1, "id", "int")]
    got = {r["table"]: r["column"] for r in profile.freshness_column(spark.createDataFrame(rows, "table string, ordinal int, name string, type string")).collect()}
    assert got == {"a": "created", "b": "paid_at", "c": None}


def test_sample_rows_orders_and_marks_nulls(spark):
    df = spark.createDataFrame([(3, None), (1, "a"), (2, "b")], "id int, v string")
    assert [tuple(r) for r in profile.sample_rows(df, 3, ["id"]).collect()] == [("1", "a"), ("2", "b"), ("3", "NULL")]
