"""The manifest against a tree built level by level, against SQL, and against changed leaves."""

import hashlib
import random
import zlib

import duckdb
import pytest
from tests.llm.helpers import SF, documents, values

from mdcatalog.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def leaf_of(row, text):
    out = ""
    for name in ("doc_id", "source", "lang", "n_chars"):
        out += "-" if row[name] is None else f"{len(str(row[name]).encode())}:{row[name]}"
    return sha(out + ("-" if text is None else f"{len(text.encode())}:{text}"))


def climb(nodes):
    """(root, per node its siblings and places)."""
    below, paths = [[i] for i in range(len(nodes))], [[] for _ in nodes]
    while len(nodes) > 1:
        up, groups = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at:at + 8]
            for place in range(len(run)):
                for leaf in below[at + place]:
                    paths[leaf].append((place, run[:place] + run[place + 1:]))
            up.append(sha("".join(run)))
            groups.append([x for b in below[at:at + 8] for x in b])
        nodes, below = up, groups
    return nodes[0], paths


def plain(rows):
    trees: dict = {}
    for r in rows:
        crc = None if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode())
        low = r["text"] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
        own = leaf_of(r, r["text"])
        trees.setdefault(r["lang"], []).append((r["doc_id"], own, leaf_of(r, low) if crc is not None and crc % 3 == 0 else own))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    tops, out = [], []
    for lang in langs:
        trees[lang].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        tops.append(climb([t[1] for t in trees[lang]]))
    root, over = climb([t[0] for t in tops])
    for i, lang in enumerate(langs):
        for j, (own_id, own, claimed) in enumerate(trees[lang]):
            path = tops[i][1][j] + over[i]
            folded = claimed
            for place, siblings in path:
                folded = sha("".join(siblings[:place]) + folded + "".join(siblings[place:]))
            out.append((own_id, own, tops[i][0], root, sha("".join("".join(s) for _, s in path)), folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def check(docs):
    found = values(merkle.audit_documents(docs), *COLUMNS)
    assert found == plain([r.asDict() for r in docs.collect()])
    return found


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65])
def test_sizes_around_whole_runs(spark, n):
    check(documents(spark, [(i * 5, f"Text {i}") for i in range(n)]))


@pytest.mark.parametrize("levels", [1, 2])
def test_many_blocks_and_trees(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 8 ** levels)
    rng = random.Random(levels)
    rows = [(i, f"Text {i}", rng.choice("aabbbbbcdefghijkl") + ("ß" if rng.random() < .2 else "")) for i in range(700)]
    docs = documents(spark, [r[:2] for r in rows]).drop("lang").join(spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, lang string"), "doc_id")
    found = check(docs)
    assert {r[-1] for r in found} == {True, False}


def test_odd_rows(spark):
    docs = documents(spark, [(None, "A"), (None, None), (3, "B"), (3, "B"), (3, "C"), (-5, ""), (7, "X" * 100_000), (8, "é\x00Z")])
    found = check(docs.unionByName(docs.withColumn("lang", docs["lang"].substr(9, 1))).unionByName(docs.limit(1).selectExpr("* except (lang)", "cast(null as string) as lang")))
    assert len(found) == 17
    assert merkle.audit_documents(documents(spark, [])).collect() == []


def test_every_lone_leaf(spark):
    docs = documents(spark, [(i, "t") for i in range(20)]).selectExpr("* except (lang)", "cast(doc_id as string) as lang")
    check(docs)


def test_block_of_its_own():
    for n in (1, 5, 8, 9, 63, 64, 65, 100):
        nodes = [sha(str(i)) for i in range(n)]
        block = merkle.Block(n)
        for node in nodes:
            block.append(node)
        root, paths = climb(nodes)
        assert block.close() == root
        assert [block.witness(i) for i in range(n)] == [[(p, "".join(s)) for p, s in path] for path in paths]


def test_sql_on_the_test_table(spark):
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = values(merkle.audit_documents(spark.read.parquet(f"{SF}/documents.parquet")), *COLUMNS)
    expected = sql.execute(merkle.oracle(4, 2)).fetchall()
    assert found == sorted(expected, key=repr)
    assert found == plain(spark.read.parquet(f"{SF}/documents.parquet").toPandas().astype(object).to_dict("records"))
