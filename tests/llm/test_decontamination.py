"""Leaks against exact containment by loop."""

import random
import re

import duckdb
from pyspark.sql import functions as F

from mdcatalog.llm import decontamination
from tests.llm.helpers import documents, values

ITEMS = "item_id bigint, text string, doc_id int, n int"


def grams(text, n):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def loop(docs, items):
    out = []
    for d, t in docs:
        for i, x in items:
            n = min(5, len(re.findall(r"[^\W_]+", (x or "").lower())))
            wanted = grams(x, n) if n else set()
            found = len(wanted & grams(t, n))
            if i is not None and wanted and found >= 0.8 * len(wanted):
                out.append((d, i, found, len(wanted)))
    return sorted(out, key=repr)


def test_leaks_equal_the_loop(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(400))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 6, 9, 12, 20, 33, 57, 120, 300])]
    docs = []
    for d in range(120):
        text = [word() for _ in range(rng.choice([3, 30, 400, 3000]))]
        if d % 2:  # an item at a random place, some with a word changed in it
            item = rng.choice(items)[1].split()
            if d % 3 == 0:
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() + "," for w in item]
        docs.append((d, " ".join(text)))
    found = decontamination.find_leaks(documents(spark, docs), spark.createDataFrame([(*x, 1, 2) for x in items], ITEMS))
    assert values(found, "doc_id", "item_id", "found", "n") == loop(docs, items)


def test_items_between_repeated_short_lines(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(100_000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([21, 37, 37, 133] * 10)]
    docs = []
    for d in range(160):  # a whole item between lines that repeat
        line = " ".join(word() for _ in range((1, 4, 12)[d % 3])) + " "
        docs.append((d, line * 100 + items[d % 40][1] + " " + line * 100))
    found = decontamination.find_leaks(documents(spark, docs), spark.createDataFrame([(*x, 1, 2) for x in items], ITEMS))
    assert values(found, "doc_id", "item_id") == sorted([(d, d % 40) for d in range(160)], key=repr)


def test_items_shorter_than_a_shingle(spark):
    items = [(1, "Paris"), (2, "Paris is"), (3, "paris is nice"), (4, "Paris is nice, really"), (5, "Paris is nice, really nice"), (6, "is"), (7, "!"), (3, "paris, is nice"), (8, "zebra")]
    docs = [(1, "I say: Paris is nice."), (2, "Paris"), (3, "is Paris nice? really nice"), (4, "oh paris IS nice really nice"), (5, ""), (6, None), (7, "is is is paris"), (8, "none of it")]
    frame = spark.createDataFrame([(*x, 1, 2) for x in items], ITEMS)
    found = decontamination.find_leaks(documents(spark, docs), frame)
    assert values(found, "doc_id", "item_id", "found", "n") == sorted(set(loop(docs, items)), key=repr)
    assert sorted(r["doc_id"] for r in decontamination.without_leaks(documents(spark, docs), frame).collect()) == [2, 3, 5, 6, 7, 8]
    assert values(decontamination.find_leaks(documents(spark, docs), frame.where("item_id in (3, 6)"), least_words=3), "doc_id", "item_id") == [(1, 3), (4, 3)]


def test_many_items_that_share_a_shingle(spark):
    """Candidates are few although every item and every document holds the same line."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(100_000)}"
    line = " please choose one of the following answers "
    items = [(i, " ".join(word() for _ in range(rng.choice([6, 20]))) + line + " ".join(word() for _ in range(12))) for i in range(3000)]
    items += [(10_000 + i, "please choose one of the following answers") for i in range(2)]
    docs = [(d, " ".join(word() for _ in range(100)) + line + (items[d * 7][1] if d % 3 == 0 else "")) for d in range(60)]
    known = decontamination.items(spark.createDataFrame([(*x, 1, 2) for x in items], ITEMS)).withColumn("item", F.col("item_id"))
    pairs = decontamination.candidates(decontamination.hashed(documents(spark, docs), "doc_id"), known, "doc_id")
    assert pairs.count() < 60 * 4
    found = decontamination.find_leaks(documents(spark, docs), spark.createDataFrame([(*x, 1, 2) for x in items], ITEMS))
    expected = [(d, d * 7) for d in range(0, 60, 3)] + [(d, i) for d in range(60) for i in (10_000, 10_001)]
    assert values(found, "doc_id", "item_id") == sorted(expected, key=repr)


def test_sql_knows_short_items(spark):
    sql = duckdb.connect()
    sql.execute("CREATE TABLE documents AS SELECT * FROM (VALUES (1, 'I say: Paris is nice.'), (2, 'oh paris IS nice really nice'), (3, '')) d(doc_id, text)")
    sql.execute("CREATE TABLE benchmark AS SELECT * FROM (VALUES (1, 'paris is'), (2, 'Paris is nice really nice'), (3, '!')) b(item_id, text)")
    rows = sql.execute(decontamination.ORACLE_SQL.replace("{documents}", "documents")).fetchall()
    assert sorted(r[:2] for r in rows) == [(1, 1), (2, 1), (2, 2)]


def test_odd_rows(spark):
    item = "one two three four five six seven"
    docs = [(1, None), (2, ""), (3, "x one, two. THREE four five six seven y"), (3, "x one, two. THREE four five six seven y"), (None, item), (4, "one two"), (5, "z " * 100_000 + item)]
    items = [(1, item), (1, item), (2, None), (3, "a b c"), (None, item), (4, item)]
    frame = spark.createDataFrame([(*x, 1, 2) for x in items], ITEMS)
    found = decontamination.find_leaks(documents(spark, docs), frame)
    assert values(found, "doc_id", "item_id") == sorted([(d, i) for d in (3, 3, None, 5) for i in (1, 4)], key=repr)
    kept = decontamination.without_leaks(documents(spark, docs), frame)
    assert kept.columns == documents(spark, []).columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4]
    nothing = spark.createDataFrame([], ITEMS)
    assert decontamination.find_leaks(documents(spark, docs), nothing).count() == 0
    assert decontamination.without_leaks(documents(spark, docs), nothing).count() == len(docs)
    assert decontamination.find_leaks(documents(spark, []), frame).count() == 0


def test_no_python_on_the_executors(spark):
    plan = decontamination.find_leaks(documents(spark, [(1, "a b c d e f")]), spark.createDataFrame([(1, "a b c d e", 1, 2)], ITEMS))
    assert not re.search("Python|Arrow|Pandas", plan._jdf.queryExecution().toString())
