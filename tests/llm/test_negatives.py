"""Hard negatives against all scores, and the bounds against exact ones."""

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.helpers import SF, values

from mdcatalog.llm import negatives

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
SCHEMA = "vec_id bigint, embedding array<double>, label int, id int, score string, windows string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", "w") for r in rows], SCHEMA)


def plain(rows, every=100):
    kept: dict = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        row = (label, [int(np.floor(256 * x)) for x in vector])
        kept[vec_id] = min(kept.get(vec_id, row), row)
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), b, m) for b, (m, w) in kept.items() if b != a)
        for s, b, m in [r for r in scored if r[2] == label][:5]:
            near = [r for r in scored if r[2] != label and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(a, b, i + 1, r[1], -s, -r[0]) for i, r in enumerate(near)]
    return sorted(out, key=repr)


def made(n, dims=24, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dims))
    vectors = centres[rng.integers(0, 6, n)] + rng.standard_normal((n, dims)) * 0.7
    vectors[:copies] = vectors[0]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return [(int(i), v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("copies", [0, 150])
def test_all_scores(spark, monkeypatch, copies):
    monkeypatch.setattr(negatives, "TILE_VECTORS", 60)
    monkeypatch.setattr(negatives, "TILE_ANCHORS", 7)
    rows = made(450, copies=copies)
    assert values(negatives.mine(frame(spark, rows), "id % 10 = 0"), *COLUMNS) == plain(rows, 10)


def test_odd_rows(spark):
    rows = made(60, dims=5)
    odd = [(None, [0.1] * 5, 1), (200, None, 1), (201, [0.1] * 5, None), (202, [0.1, None, 0.1, 0.1, 0.1], 1), (203, [float("nan")] * 5, 2),
           (204, [float("inf")] * 5, 2), (205, [0.0] * 5, 2), (206, [0.0] * 5, 3), rows[10], rows[20], (20, [0.5] * 5, 9), (30, [0.4] * 5, 0), (207, [-0.2] * 5, 1)]
    assert values(negatives.mine(frame(spark, rows + odd), "id % 10 = 0"), *COLUMNS) == plain(rows + odd, 10)
    short = [(500, [0.9, 0.9], 1), (501, [], 1)]
    assert values(negatives.mine(frame(spark, rows + short), "id % 10 = 0"), *COLUMNS) == plain(rows, 10)
    assert negatives.mine(frame(spark, []), "id % 10 = 0").collect() == []
    assert negatives.mine(frame(spark, rows[:1]), "id % 10 = 0").collect() == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-2 ** 20, 2 ** 20, 3) * 1.0 + rng.random(3)).tolist(), i % 2) for i in range(40)]
    assert values(negatives.mine(frame(spark, rows), "id % 10 = 0"), *COLUMNS) == plain(rows, 10)
    with pytest.raises(ValueError):
        negatives.mine(frame(spark, [(0, [1e12], 0), (1, [1e12], 1)]), "id = 0").collect()


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.integers(0, 1000))
def test_bounds_hold_and_tighten(width, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-300, 300, (12, width)).astype(float)
    held = negatives.Summaries(vectors)
    exact = vectors @ vectors[0]
    for level, of in zip(held.levels, held.at(0)):
        low, high = negatives.bounds(level, of, None)
        assert (low <= exact).all() and (exact <= high).all()
    assert max(np.diff(np.unique(np.linspace(0, width, 2 ** (len(held.levels) - 1) + 1).round()))) <= negatives.NARROWEST


def test_summaries_leave_vectors_out():
    """Of vectors with structure, most are never scored."""
    rng = np.random.default_rng(1)
    vectors = np.repeat(rng.integers(-60, 60, (4000, 8)), 8, axis=1) + rng.integers(-3, 4, (4000, 64)).astype(float)
    held = negatives.Summaries(vectors)
    alive, scores = negatives.search(held, vectors[0], held.at(0), np.arange(1, 4000), [(-np.inf, np.inf)], 5)
    exact = vectors[1:] @ vectors[0]
    assert len(alive) < 400
    assert sorted(scores)[-5:] == sorted(exact)[-5:]


def test_sql_on_the_test_table(spark):
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    expected = sorted(sql.execute(negatives.ORACLE_SQL).fetchall(), key=repr)
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert values(negatives.mine(vectors, "id % 100 = 0", F.expr(negatives.SHIFTED_LABEL)), *COLUMNS) == expected
    assert expected
