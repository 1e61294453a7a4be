"""Targets against a loop, sampling against an ordered walk."""

import random
from collections import defaultdict

from mdcatalog.llm import mixing
from tests.llm.helpers import documents


def loop_targets(sizes, weights=(5.0, 2.0, 1.0)):
    """Share by weight, cut at three times the size, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        level = (total - sum(out.values())) / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not above:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: 3.0 * sizes[s] for s in above}
        open_ -= above
    return out


def test_targets_equal_the_loop(spark):
    rng = random.Random(4)
    for _ in range(12):
        sizes = {s: rng.choice([0, 1, 5, 100, 3000, 20_000]) for s in rng.sample(["a", "b", "é", "Z", "zz", "", None, "m", "n"], rng.randint(1, 9))}
        frame = spark.createDataFrame([(s, n, 1, 1.0) for s, n in sizes.items()], "source string, source_size bigint, docs bigint, mass double")
        got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
        expected = loop_targets(sizes)
        assert all(abs(got[s] - expected[s]) < 1e-6 * (1 + expected[s]) for s in sizes), (sizes, got, expected)


def test_mix_takes_whole_epochs_and_meets_the_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BIN", 8)
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a"] * 8 + ["b", "c", None])) for i in range(400)]
    rows += [(None, "x y", "a"), (7, rows[7][1], rows[7][2]), (None, None, "d"), (500, "one", "e")]
    docs = documents(spark, rows)
    out = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, again), key=repr) and len(out) == len(rows)
    taken, target = defaultdict(int), {}
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(taken[s] == int(target[s]) for s in target), (taken, target)
    partial = defaultdict(int)
    for r in out:
        partial[r["source"]] += bool(r["size"]) and r["taken"] % r["size"] != 0
    assert max(partial.values()) <= 1


def test_better_documents_come_first(spark):
    rows = [(i, "w", "a") for i in range(3000)] + [(9000 + i, "w " * 3000, "b") for i in range(2)]
    quality = spark.createDataFrame([(i, 4.0 if i < 1500 else 0.5) for i in range(3000)] + [(None, 3.0), (1, None), (2, -1.0)], "doc_id bigint, weight double")
    out = mixing.mix(documents(spark, rows), quality, weights=(1.0, 5.0)).where("source = 'a'").collect()
    share = lambda some: sum(r["taken"] for r in out if some(r["doc_id"]))
    assert share(lambda i: i < 1500) > 1.3 * share(lambda i: i >= 1500) > 0


def test_nothing_to_mix(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mix(documents(spark, [(1, None), (2, " \t")])).collect()] == [0, 0]
