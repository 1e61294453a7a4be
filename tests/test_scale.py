"""What keeps queries over large tables small: dealt rows, no broadcast of generated rows, steps done once."""

import gzip
import hashlib
import itertools
import os
import random
import re
from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from mdcatalog import session
from mdcatalog.functions import frontmatter as fm
from mdcatalog.functions import markdown as md
from mdcatalog.functions import text as tx
from mdcatalog.operators import cochange, docs, drift
from mdcatalog.sources import history, writers
from workload import queries, queries_files, star


def small_tables(spark, folder):
    tables = {
        "customer": ([(i, f"Customer {i}", 1, float(i), "BUILDING") for i in range(50)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(1, "S", 1, 5.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": ([(1, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "part": ([(i, f"p{i}", "Brand#1", "SMALL", 20) for i in range(50)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_bundle_rows_are_dealt_out(spark, tmp_path):
    small_tables(spark, tmp_path)
    files = star.bundle(spark, str(tmp_path), 1)
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RebalancePartitions") >= 3
    assert files.count() == 50 + 1 + 1 + 1 + 50 + 1


def test_drift_broadcasts_nothing(spark):
    """The sides of drift are made from small files and have many rows."""
    columns = spark.createDataFrame([("t", 1, "a", "int", "x", True, "", "", False)],
                                    "table string, ordinal int, name string, type string, comment string, nullable boolean, default string, extra string, pk boolean")
    texts = columns.select("table", F.col("comment").alias("description"))
    comments = columns.select("table", "name", F.lit("y").alias("bundle_comment"))
    frames = [
        drift.missing_tables(texts, texts), drift.missing_columns(columns, columns), drift.type_mismatches(columns, columns),
        drift.comment_mismatches(columns, columns), drift.description_mismatches(texts, texts), drift.sync_metadata(texts.withColumnRenamed("table", "path"), texts.withColumnRenamed("table", "path")),
        drift.column_comment_statements(comments, columns, "mysql"), drift.add_column_statements(columns, columns), drift.create_table_statements(columns, columns),
        drift.header_drift(columns, drift.column_lists(columns)),
    ]
    for df in frames:
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_score_locates_each_character_once(spark):
    scored = spark.createDataFrame([("xaxb",), ("b",)], "t string").select(tx.fuzzy_score("ab", F.col("t")).alias("score"))
    assert scored._jdf.queryExecution().analyzed().toString().count("locate(") == 1
    assert [r["score"] for r in scored.collect()] == [2, -1]


BLOCKS = [
    'type: Table\ntitle: "A b"\nresource: star:///t/1\ntags:\n    - star\n    - a b\nowner: nobody\n', "type: a\n", "a: b: c\n", "a:b\n", "a: x #y\n", "a: x#y\n", "a: null\n",
    "a: nullable\n", "a: x:\n", "a: x\n\n", "a: x \n", "a:  x\n", "a: say \"hi\"\n", 'a: "x\\"y"\n', 'a: ""\ntags:\n- ""\n', "tags: [a, b]\n", "tags:\nx: y\n- a\n", "tags: t\n- a\n  - b\n",
    "a: 1\na: 2\n", "a: é\n", "# c\na: x\n", "a: 'x'\n", "a:\n- ~\n- null\n- x\n", "tags:\n- null\n- x y\n", "- a\n", "", "a: x\r\n", "a: x  y\n", "Tags:\n- b\n",
    "a: NULL\n", "a: x: \n", "a: http://x:1/#y\n", 'a: "x: y #z"\nb: "p" q\n', "a: " + "x" * 3000 + "\n"]


def test_simple_blocks_read_as_line_by_line(spark):
    yaml, lines = F.col("y"), F.col("l")
    rows = spark.createDataFrame([(b,) for b in BLOCKS], "y string").select("y", fm.yaml_lines(yaml).alias("l"), fm.is_simple(yaml).alias("simple"))
    entries = lambda m: F.array_sort(F.map_entries(m))
    once = F.size(F.array_distinct(fm.simple_keys(yaml))) == F.size(fm.simple_keys(yaml))
    flat = rows.where(fm.is_flat(lines)).select("y", entries(fm.flat_fields(lines)).alias("m"), fm.flat_list(lines, "tags").alias("t"))
    found = rows.where(F.col("simple") & once).select("y", entries(F.map_from_arrays(fm.simple_keys(yaml), fm.simple_values(yaml))).alias("m"), fm.simple_list(yaml, "tags").alias("t"))
    expected = {r["y"]: (r["m"], r["t"]) for r in flat.collect()}
    got = {r["y"]: (r["m"], r["t"]) for r in found.collect()}
    assert {b: expected[b] for b in got} == got
    assert {BLOCKS[0], "type: a\n", "a: x#y\n", "a: nullable\n", "tags: t\n- a\n  - b\n", "a: http://x:1/#y\n", "tags:\nx: y\n- a\n"} <= set(got)
    assert not set(got) & {"a: null\n", "a: x: \n", "a: x #y\n", "a: 1\na: 2\n", "tags: [a, b]\n", BLOCKS[-1]}


def test_blocks_of_either_kind_are_concepts(spark, raw):
    files = raw({f"{i}.md": f"---\n{b}---\nbody" for i, b in enumerate(BLOCKS)})
    read = {int(r["concept_id"]): r for r in docs.parse_concepts(files).collect()}
    assert len(read) == len(BLOCKS)
    assert (read[0]["title"], read[0]["tags"], read[0]["extra"]) == ("A b", ["star", "a b"], {"owner": "nobody"})
    assert read[BLOCKS.index("a: 1\na: 2\n")]["extra"] == {"a": "1"}
    assert read[BLOCKS.index("tags: [a, b]\n")]["tags"] == ["a", "b"]


def test_section_is_searched_once(spark):
    found = spark.createDataFrame([("# Columns\n\n x \n# Next\n# Columns\ny",), ("## Other",), (None,), ("# Columns",)], "t string").select(md.get_section(F.col("t"), "Columns", any_level=True).alias("s"))
    assert found._jdf.queryExecution().analyzed().toString().count("Columns") == 1
    assert [r["s"] for r in found.collect()] == ["x", None, None, ""]


def test_single_branches_write_no_concepts(spark, tmp_path):
    """Every version that one branch reads is parsed in its plan; tables hold only what is read."""
    small_tables(spark, tmp_path)
    for name, versions in (("graph_diff", 2), ("federate_nodes", 2), ("render_round_trip", 1)):
        plan = queries.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RebalancePartitions") >= 3 * versions, name


def test_tables_hold_what_branches_read(spark, tmp_path, monkeypatch):
    small_tables(spark, tmp_path)
    written, keep = [], queries.as_table
    monkeypatch.setattr(queries, "as_table", lambda df: written.append(df.columns) or keep(df))
    for name in ("federate", "subgraph", "er_view", "audit_report"):
        queries.QUERIES[name](spark, str(tmp_path))
    assert len(written) == 5 and not any("extra" in columns for columns in written)


def test_hash_uses_patterns_only_where_they_match(spark):
    """Plain tests come before the patterns; the hash is that of the patterns alone."""
    texts = ["", "\n", " ", "x", "x\n\n", "x \ny", "x\t\ny", "x \t \n\n", "x\r\ny\r", "x \r\ny", "x \ry\t\r", "x y\tz", "x\t", " x\n y", "x \u00a0\n", "é \n", "x" + " " * 5000 + "y"]
    hashed = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", tx.structural_hash(F.col("t")).alias("hash"))
    plan = hashed._jdf.queryExecution().analyzed().toString()
    assert plan.count("CASE WHEN") == 1 and plan.index("Contains(") < plan.index("regexp_replace(")

    def expected(text):
        kept = re.sub(r"(?<![ \t])[ \t]+(?=\n|\Z)", "", re.sub(r"\r\n?", "\n", text))
        return hashlib.sha256((kept.rstrip("\n") + "\n").encode()).hexdigest()

    assert {r["t"]: r["hash"] for r in hashed.collect()} == {**{t: expected(t) for t in texts}, None: None}


def test_bundle_hash_is_dealt_out_and_searches_no_pattern(spark, tmp_path):
    """Rows are dealt out before they become documents; what people added is cut off by a plain search, once per document."""
    small_tables(spark, tmp_path)
    hashed = queries.structural_hash_bundle(spark, str(tmp_path))
    plan = hashed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RebalancePartitions") >= 3
    assert plan.count("substring_index(body") == 1
    assert hashed.count() == hashed.where("length(hash) = 64").count() == 50 + 1 + 1 + 1 + 50 + 1


def test_bundle_hash_leaves_out_notes(spark, raw, monkeypatch):
    files = raw({f"{i}.md": f"---\ntype: a\n---\n{b}" for i, b in enumerate(["x\n", "x\n\n# Notes\n\ny\n# Notes\n", "x\n# Notes\n", "x\n# Notes", "x \n## Notes\n"])})
    monkeypatch.setattr(queries, "parsed", lambda *_: docs.parse_concepts(files))
    found = {r["concept_id"]: r["hash"] for r in queries.structural_hash_bundle(spark, "").collect()}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert found == {"0": digest("x\n"), "1": digest("x\n"), "2": digest("x\n"), "3": digest("x\n# Notes\n"), "4": digest("x\n## Notes\n")}


def history_tables(spark, folder):
    rng = random.Random(7)
    orders = [(i, i % 5, datetime(2024, 1, 1 + i % 28), "OF"[i % 2], i % 3) for i in range(60)]
    lines = [(i, rng.randrange(12)) for i, *_ in orders for _ in range(rng.randrange(1, 6))]
    spark.createDataFrame([o[:4] for o in orders], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long").write.parquet(f"{folder}/lineitem.parquet")
    return lines


def pairs_of(changes, least=2):
    commits, counts = {}, Counter()
    for commit, path in changes:
        commits.setdefault(commit, set()).add(path)
    for files in commits.values():
        counts.update(itertools.combinations(sorted(files), 2))
    return {k: n for k, n in counts.items() if n >= least}


def test_history_cochange_leaves_little_on_disk(spark, tmp_path):
    """The log and what was shuffled to write and read it are gone when pairs are counted."""
    lines = history_tables(spark, tmp_path)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    def shared():
        return {f"{d}/{f}" for d, _, fs in os.walk(session.shared_folder(spark).removeprefix("file:")) for f in fs}

    before = shuffled(), shared()
    found = queries_files.history_cochange(spark, str(tmp_path))
    assert not shuffled() - before[0]
    assert not [f for f in shared() - before[1] if ".txt" in f]
    paths = [(c, f'supplier/ä "{p}"' if p % 9 == 0 else f"supplier/{p}") for c, p in lines]
    assert {(r["a"], r["b"]): r["n"] for r in found.collect()} == pairs_of(paths)


def test_history_without_messages_joins_nothing(spark, tmp_path):
    (tmp_path / "a.log").write_text("commit 1234567\nAuthor: A <a@b>\n\n    Text\n\nx.txt\ny.txt\n")
    found = history.read_history(spark, str(tmp_path))
    plan = found.select("commit_id", "path")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert sorted(r["path"] for r in found.where("author = 'A' AND message = 'Text'").collect()) == ["x.txt", "y.txt"]


def test_history_lines_meet_their_commit_across_batches(spark, tmp_path):
    """A task keeps the last commit line from batch to batch, and forgets it where another file begins."""
    for i in range(4):
        text = f"above {i}.txt\n" + "".join(f"commit {i}{c}00000\n\n    Text\n\n" + "".join(f"{i}/{c}/{k}.txt\n" for k in range(c)) + "\n" for c in range(5))
        (tmp_path / f"{i}.log").write_text(text)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    try:
        for size in (1, 3, 10_000):
            spark.conf.set(key, size)
            rows = history.read_history(spark, str(tmp_path)).select("commit_id", "path").collect()
            assert sorted(map(tuple, rows)) == [(f"{i}{c}00000", f"{i}/{c}/{k}.txt") for i in range(4) for c in range(5) for k in range(c)]
    finally:
        spark.conf.set(key, old)


def test_compressed_files(spark, tmp_path):
    files = spark.createDataFrame([("a.log.gz", "ä\nb\n"), ("a.log", "ä\nb\n")], "path string, content string")
    assert writers.write_files(files, str(tmp_path)) == 2
    assert (tmp_path / "a.log").read_bytes() == gzip.decompress((tmp_path / "a.log.gz").read_bytes()) == "ä\nb\n".encode()
    assert [r["value"] for r in spark.read.text(str(tmp_path / "a.log.gz")).collect()] == ["ä", "b"]


def test_change_sets_are_distinct_at_any_size(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["c1", "c2", "c3", None]), rng.choice(["", None, *"abcdefgh"])) for _ in range(200)] + [("c4", "a")]
    df = spark.createDataFrame(rows, "commit_id string, path string")
    for large in (0, 5, 1000):
        got = [tuple(r) for r in cochange.change_sets(df, large=large).collect()]
        assert len(got) == len(set(got)) and set(got) == {(c, p) for c, p in rows if p}, large


def test_pairs_in_rounds(spark, monkeypatch):
    rng = random.Random(9)
    changes = [(c, p) for c in range(60) for p in rng.sample([f"f{i:03d}" for i in range(100)], rng.randrange(1, 14))]
    df = spark.createDataFrame(changes, "commit_id int, path string")
    for few, at_once, least in [(0, 50, 2), (0, 1000, 3), (1000, 1000, 2), (0, 1 << 26, 2), (0, 1000, 1)]:  # rare files are looked for, and not
        monkeypatch.setattr(cochange, "FEW_PAIRS", few)
        monkeypatch.setattr(cochange, "PAIRS_AT_ONCE", at_once)
        got = [((r["a"], r["b"]), r["n"]) for r in cochange.cochange_pairs(df, least).collect()]
        assert len(got) == len(dict(got)) and dict(got) == pairs_of(changes, least), (few, at_once, least)
