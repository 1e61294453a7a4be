"""Paths of many pairs against a breadth-first search in plain Python."""

import random

from mdcatalog.operators import graph


def plain(edges, start, end):
    near: dict = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    parent, layer = {start: None}, [start]
    while layer and end not in parent:
        found: dict = {}
        for a in layer:
            for b in near.get(a, ()):
                if b not in parent:
                    found[b] = min(a, found.get(b, a))
        parent |= found
        layer = list(found)
    path, here = [], end if end in parent else None
    while here is not None:
        path.insert(0, here)
        here = parent[here]
    return path


def test_many_pairs(spark):
    rng = random.Random(7)
    names = [f"n{i:02d}" for i in range(40)]
    edges = [(rng.choice(names), rng.choice(names)) for _ in range(45)] + [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(12)] + [("n00", "c00")]
    df = spark.createDataFrame([("b", a, b) for a, b in edges], "bundle string, source string, target string")
    pairs = [(rng.choice(names), rng.choice(names)) for _ in range(25)] + [("n00", "c12"), ("c12", "c00"), ("n01", "n01"), ("none", "n01"), ("n01", "none"), ("none", "none")]
    rows = graph.shortest_paths(df, spark.createDataFrame([("b", a, b) for a, b in pairs + pairs[:3]], "bundle string, start string, end string")).collect()
    got: dict = {}
    for r in sorted(rows, key=lambda r: r["step"]):
        assert r["step"] == len(got.setdefault((r["start"], r["end"]), []))
        got[r["start"], r["end"]].append(r["id"])
    assert got == {p: plain(edges, *p) for p in pairs if plain(edges, *p)}
    assert [r["id"] for r in graph.shortest_path(df, "b", "n00", "c12").collect()] == plain(edges, "n00", "c12")
    assert graph.shortest_path(df, "b", "n00", "gone").count() == 0


def test_hub_between_pairs_is_not_spread_per_start(spark, monkeypatch):
    """Each start sees all 400 leaves behind the hub within two steps; no table may hold them for each of the 30 starts."""
    edges = [("hub", f"leaf{i:03d}") for i in range(400)] + [(f"start{i:02d}", "hub") for i in range(30)] + [(f"leaf{i:03d}", f"end{i // 50 % 2}") for i in range(0, 400, 50)]
    df = spark.createDataFrame([("b", a, b) for a, b in edges], "bundle string, source string, target string")
    pairs = [(f"start{i:02d}", f"end{i % 2}") for i in range(30)]
    cut, most = graph.cut_lineage, []

    def counted(table):
        out = cut(table)
        most.append(out.count())
        return out

    monkeypatch.setattr(graph, "cut_lineage", counted)
    rows = graph.shortest_paths(df, spark.createDataFrame([("b", a, b) for a, b in pairs], "bundle string, start string, end string")).collect()
    got: dict = {}
    for r in sorted(rows, key=lambda r: r["step"]):
        got.setdefault((r["start"], r["end"]), []).append(r["id"])
    assert got == {p: plain(edges, *p) for p in pairs}
    assert max(most) <= 2 * len(edges)
