"""Reading files by ranges and trees by levels, against plain Python."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from mdcatalog.plans import produce
from mdcatalog.sources import csv_corpus, history, listing, readers


def made_up(rng, rows):
    cell = lambda: rng.choice(["", "a", "1", 'say "x"', "two\nlines", "a,b", "\r\n", "é" * 5, '"', "\n\n", '""', " pad "])
    table = [["id", "b", "c"]] + [[str(i)] + [cell() for _ in range(rng.choice([0, 1, 2, 2, 2, 3]))] for i in range(rows)]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).writerows(table)
    text = out.getvalue()
    return text if rng.random() < .5 else text.rstrip("\r\n")


def whole(text):
    return [r for r in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")) if r]


@pytest.mark.parametrize("range_bytes", [1, 2, 7, 40, 1000])
def test_ranges_equal_the_whole_file(spark, tmp_path, range_bytes):
    rng = random.Random(range_bytes)
    texts = {f"f{i}.csv": made_up(rng, 3 if range_bytes < 3 else 60) for i in range(6)}
    texts |= {"bom.csv": "﻿id,b\n1,2\n", "empty.csv": "", "head.csv": "id,b", "blank.csv": "id\n\n\n1\n", "open.csv": 'id\n1\n"never closed\n2\n', "wide.csv": "id\n" + "x" * 300 + "\n1"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="", encoding="utf-8")
    found = csv_corpus.records(readers.csv_files(spark, str(tmp_path)), range_bytes)
    got: dict = {}
    for r in found.orderBy("path", "number", "at").collect():
        got.setdefault(r["path"], []).append(r["cells"])
    assert got == {k: whole(v) for k, v in texts.items() if whole(v)}
    if range_bytes == 40:  # one file is work for more than one task
        assert found.where("path = 'f0.csv'").select("number").distinct().count() > 5


def test_blocks_of_a_range(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_corpus, "BLOCK_BYTES", 3)
    text = made_up(random.Random(9), 200)
    (tmp_path / "a.csv").write_text(text, newline="")
    found = csv_corpus.records(readers.csv_files(spark, str(tmp_path)), 64).orderBy("number", "at")
    assert [r["cells"] for r in found.collect()] == whole(text)


def test_wide_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id, ,ID,x\n1,2,3\n", newline="")
    df = readers.read_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["id0", "_c1", "ID2", "x"] and [tuple(r) for r in df.collect()] == [("1", "2", "3", None)]
    (tmp_path / "none.csv").write_text("")
    assert readers.read_csv(spark, str(tmp_path / "none.csv")).count() == 0


def test_types_and_profiles_of_files_with_different_headers(spark, tmp_path):
    files = {"a.csv": "id,when,note\n1,2020-01-02,x\n2,2021-01-02,\n10,2020-01-02, x \n", "sub/b.CSV": "id,ok,price\nz,yes,$1.50\n7,no\n", "sub/head.csv": "only,names\n",
             "tmp/c.csv": "gone\n1\n", "d.txt": "id\n"}
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text, newline="")
    found, names = readers.read_csv_files(spark, str(tmp_path), ["tmp/"])
    types = csv_corpus.infer_types(found, names)
    assert sorted(tuple(r) for r in types.select("path", "ordinal", "column", "type").collect()) == [
        ("a.csv", 0, "id", "integer"), ("a.csv", 1, "when", "date"), ("a.csv", 2, "note", "string"), ("sub/b.CSV", 0, "id", "string"), ("sub/b.CSV", 1, "ok", "boolean"),
        ("sub/b.CSV", 2, "price", "string"), ("sub/head.csv", 0, "only", "string"), ("sub/head.csv", 1, "names", "string")]
    rows = {(r["path"], r["column"]): tuple(r)[3:] for r in csv_corpus.profile_files(found, names, types).collect()}
    assert rows["a.csv", "id"] == (3, 0, 3, "1.0", "10.0", "", ["1", "10", "2"])
    assert rows["a.csv", "note"] == (2, 1, 1, "x", "x", "", ["x"])
    assert rows["sub/b.CSV", "price"] == (1, 1, 1, "$1.50", "$1.50", "monetary", ["$1.50"])
    assert rows["sub/head.csv", "only"] == (0, 0, 0, None, None, "", [])
    assert {r["type"] for r in csv_corpus.infer_types(found, names, cap=1).where("path = 'sub/b.CSV' AND column = 'ok'").collect()} == {"boolean"}
    sample = csv_corpus.sample_texts(found, names, 1).collect()
    assert sorted((r["path"], r["at"], r["cells"]) for r in sample) == [("a.csv", 1, ["1", "2020-01-02", "x"]), ("sub/b.CSV", 1, ["z", "yes", "$1.50"])]
    sections = produce.csv_sections(found, names, types, sample=1)
    none = spark.createDataFrame([], "path string, description string")
    made = {r["concept_id"]: r["body"] for r in produce.csv_concepts(types, str(tmp_path), "t", none, sections=sections).collect()}
    assert set(made) == {"tables/a", "tables/sub/b.CSV", "tables/sub/head"}
    assert "## Data Profile" in made["tables/a"] and "| id | 3 | 0 | 3 | 1.0 | 10.0 |" in made["tables/a"]
    assert "## Sample\n\n| id | ok | price |\n| --- | --- | --- |\n| z | yes | $1.50 |\n" in made["tables/sub/b.CSV"] and "## Sample" not in made["tables/sub/head"]


def test_plan_does_not_grow_with_the_files(spark, tmp_path):
    def exchanges(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"{i}.csv").write_text(f"h{i}\n1\n")
        found, names = readers.read_csv_files(spark, str(folder))
        types = csv_corpus.infer_types(found, names)
        assert types.count() == n
        return csv_corpus.profile_files(found, names, types)._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")
    assert exchanges(2) == exchanges(25)


def test_tree_by_levels(spark, tmp_path):
    for name in ("a/b/c/deep.txt", ".hidden/x.txt", "_under/y.txt", "skip/me/z.txt", "a/keep.log", "top.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("12345")
    (tmp_path / "empty/inner").mkdir(parents=True)
    os.symlink(tmp_path / "a", tmp_path / "a" / "loop")
    rows = {r["path"]: (r["is_dir"], r["size"]) for r in listing.tree(spark, str(tmp_path), ["skip/", "*.log"]).collect()}
    size = rows.pop("a/loop")
    assert size[0] is False
    assert rows == {"a": (True, None), "a/b": (True, None), "a/b/c": (True, None), "a/b/c/deep.txt": (False, 5), ".hidden": (True, None), ".hidden/x.txt": (False, 5),
                    "_under": (True, None), "_under/y.txt": (False, 5), "top.txt": (False, 5), "empty": (True, None), "empty/inner": (True, None)}
    assert listing.tree(spark, str(tmp_path / "nowhere")).count() == 0
    found = listing.tree(spark, str(tmp_path)).where("path = 'top.txt'").select("uri", F.unix_timestamp("modified").alias("at")).first()
    assert found["uri"].endswith("/top.txt") and abs(found["at"] - os.path.getmtime(tmp_path / "top.txt")) < 2


LOG = """warning: something printed before
commit 1111111111111111111111111111111111111111 (HEAD -> main, tag: v1)
Merge: 2222222 3333333
Author: A B <a@b.c>
Date:   2024-01-02T03:04:05+02:00

    Merge branch

commit 2222222222222222222222222222222222222222
Author: Ünal <u@x>
Date:   2024-01-01T00:00:00Z

    Subject

    commit 3333333
    Author: somebody else
    \x20
a b.txt
"t\\303\\244b\\t\\"q\\".txt"
dir/c.txt

commit 4444444444444444444444444444444444444444
Author: A B <a@b.c>
Date:   someday

    Only this
"""


@pytest.mark.parametrize("size", [20, 64, 10_000])
def test_history_in_ranges(spark, tmp_path, size):
    text = LOG.replace("\\x20", " ").replace("\\\\", "\\")
    (tmp_path / "a.log").write_text(text, encoding="utf-8")
    (tmp_path / "b.log").write_text(text.replace("2222222222222222222222222222222222222222", "5" * 40) + "\nlast.txt", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        blocks = history.lines(spark, str(tmp_path)).select("file", "block").distinct().count()
        rows = [tuple(r) for r in history.read_history(spark, str(tmp_path)).selectExpr("commit_id", "author", "unix_timestamp(at)", "message", "path").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert blocks == 2 if size == 10_000 else blocks > 10
    message = "Subject\n\ncommit 3333333\nAuthor: somebody else"
    expected = [(c * 40, "Ünal", 1704067200, message, p) for c in "25" for p in ("a b.txt", 'täb\t"q".txt', "dir/c.txt")]
    expected.append(("4" * 40, "A B", None, "Only this", "last.txt"))
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))


def test_spark_catalog(spark, tmp_path):
    spark.range(3).selectExpr("id", "cast(id as string) AS `a b`").createOrReplaceTempView("seen_view")
    spark.sql(f"CREATE TABLE seen_table (k BIGINT COMMENT 'the key', v ARRAY<INT>) USING parquet COMMENT 'all of it' LOCATION '{tmp_path}/t'")
    try:
        found = readers.from_spark_catalog(spark, pattern="seen_*")
        assert sorted((r["name"], r["kind"], r["comment"]) for r in found["tables"].collect()) == [("seen_table", "table", "all of it"), ("seen_view", "view", None)]
        assert sorted((r["table"], r["ordinal"], r["name"], r["type"], r["comment"]) for r in found["columns"].collect()) == [
            ("seen_table", 1, "k", "bigint", "the key"), ("seen_table", 2, "v", "array<int>", None), ("seen_view", 1, "id", "bigint", None), ("seen_view", 2, "a b", "string", None)]
        assert readers.from_spark_catalog(spark, pattern="none_*")["columns"].count() == 0
    finally:
        spark.sql("DROP TABLE seen_table")
