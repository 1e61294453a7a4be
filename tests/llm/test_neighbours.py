"""Neighbours against brute force: recall, exact scores, odd vectors."""

import numpy as np
import pytest

from mdcatalog.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, score int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)


def test_adaptive_scan_keeps_what_is_near():
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((400, 65))
    query = rng.standard_normal(65)
    distance = ((rows - query) ** 2).sum(axis=1)
    limit = np.sort(distance)[40]
    alive = neighbours.scan([rows[:, i:i + 16] for i in range(0, 65, 16)], query, limit, 65)
    assert set(alive) <= set(np.flatnonzero(distance <= limit)) and len(alive) >= 36


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_scan_of_many_queries_is_the_scan_of_each(spread):
    rng = np.random.default_rng(4)
    rows = rng.standard_normal((300, 65)) * np.r_[np.ones(20), np.full(45, spread)]
    queries = rows[:300] + 0.1
    limits = np.sort(((rows[None] - queries[:, None]) ** 2).sum(axis=2), axis=1)[:, 10]
    blocks = [rows[:, i:i + 16] for i in range(0, 65, 16)]
    for query, limit, alive in zip(queries, limits, neighbours.scan_many(blocks, queries, limits + 1e-6, 65)):
        assert alive.tolist() == neighbours.scan(blocks, query, limit + 1e-6, 65).tolist()


def test_products_are_summed_in_order():
    rng = np.random.default_rng(5)
    rows, query = rng.standard_normal((50, 64)), rng.standard_normal(64)
    for row, found in zip(rows, neighbours.products(rows, query)):
        total = 0.0
        for x, y in zip(row.tolist(), query.tolist()):
            total += x * y
        assert total == found


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_and_scores(spark, monkeypatch, scaled):
    monkeypatch.setattr(neighbours, "SAMPLE", 1500)
    monkeypatch.setattr(neighbours, "SEEDS", 100)
    monkeypatch.setattr(neighbours, "LIST", 100)
    monkeypatch.setattr(neighbours, "TILE_VECTORS", 64)
    monkeypatch.setattr(neighbours, "TILE_QUERIES", 16)
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.standard_normal((2000, 24)), rng.standard_normal(24) + 0.05 * rng.standard_normal((900, 24))]).astype(np.float32)
    if scaled:
        vectors *= rng.uniform(0.2, 3, (len(vectors), 1)).astype(np.float32)
    out = neighbours.nearest(frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]), "id % 20 = 0").collect()
    exact = vectors.astype(float)
    found, hits = {}, 0
    for r in out:
        found.setdefault(r["query_id"], []).append(r)
    for q in range(0, len(vectors), 20):
        scores = exact @ exact[q]
        scores[q] = -np.inf
        rows = sorted(found[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21)) and rows == sorted(rows, key=lambda r: (-r["score"], r["vec_id"]))
        assert all(abs(r["score"] - scores[r["vec_id"]]) < 1e-9 for r in rows)
        hits += len({r["vec_id"] for r in rows} & set(np.argsort(-scores)[:20].tolist()))
    assert hits / (20 * len(found)) >= 0.9


def test_every_row_comes_from_the_scan(spark, monkeypatch):
    """Seeds give thresholds only: with a scan that finds nothing there is no result."""
    rows = frame(spark, [(i, [float(i % 7) + 1, float(i % 11), 1.0]) for i in range(100)])
    assert neighbours.nearest(rows, "id % 20 = 0").count() == 100
    monkeypatch.setattr(neighbours, "scan_many", lambda blocks, queries, limits, width: (np.empty(0, int) for _ in queries))
    assert neighbours.nearest(rows, "id % 20 = 0").count() == 0


def test_lists_grow_with_the_square_root():
    assert [neighbours.list_count(n) for n in (0, 5_000, 200_000, 10 ** 6, 10 ** 8, 10 ** 10)] == [1, 4, 195, 976, 10_000, 100_000]
    assert neighbours.sample_size(10 ** 5) == neighbours.SAMPLE and neighbours.sample_size(10 ** 10) == neighbours.MOST_SAMPLE


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0]), (None, [9.0, 9.0]),
            (20, [0.0, -1.0]), (0, [1.0, 0.0]), (9, [None, 1.0])]
    out = neighbours.nearest(frame(spark, rows), "id % 20 = 0", k=3)
    assert sorted(map(tuple, out.collect())) == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0)]
    assert neighbours.nearest(frame(spark, []), "id % 20 = 0").count() == 0
    assert neighbours.nearest(frame(spark, [(20, [1.0, 2.0])]), "id % 20 = 0").count() == 0
