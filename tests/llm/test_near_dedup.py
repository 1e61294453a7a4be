"""Classes of near copies against brute force over all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np

from mdcatalog.llm import near_dedup
from mdcatalog.llm.common import WordHashes, components
from mdcatalog.llm.queries import QUERIES
from tests.llm.helpers import SF, documents, values


def bag(text):
    words = near_dedup.words(text or "")
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else None


def brute(rows):
    """doc_id → smallest id of its class, by exact similarity of all pairs that share a shingle."""
    bags = {i: bag(t) for i, t in rows}
    holders, parent = defaultdict(list), {i: i for i in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, b in bags.items():
        for s in b or ():
            holders[s].append(i)
    for i, b in bags.items():
        shared = Counter()
        for s, n in (b or {}).items():
            for j in holders[s]:
                if j > i:
                    shared[j] += min(n, bags[j][s])
        for j, n in shared.items():
            if n / (sum(b.values()) + sum(bags[j].values()) - n) >= 0.8:
                a, c = sorted((root(i), root(j)))
                parent[c] = a
    return {i: root(i) for i in bags}


def test_signature_agrees_as_often_as_the_bags_do():
    hashes, rng = WordHashes(), random.Random(2)
    for size, changes, repeat in ((120, 3, 1), (400, 40, 1), (30, 1, 9)):
        estimates, exact = [], []
        for _ in range(15):
            a = [f"w{rng.randrange(3000)}" for _ in range(size)] * repeat
            b = list(a)
            for _ in range(changes):
                b[rng.randrange(len(b))] = f"w{rng.randrange(3000)}"
            x, y = (near_dedup.bag(" ".join(t), hashes) for t in (a, b))
            exact.append(near_dedup.weighted_jaccard(x, y))
            estimates.append((near_dedup.signature(*x) == near_dedup.signature(*y)).mean())
        assert abs(np.mean(estimates) - np.mean(exact)) < 0.04


def test_real_weights_and_scale():
    elements = np.arange(1, 80, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = np.full(79, 2.5), np.full(79, 2.0)
    agree = [(near_dedup.signature(elements, a, seed=s) == near_dedup.signature(elements, b, seed=s)).mean() for s in range(12)]
    assert abs(np.mean(agree) - 0.8) < 0.04


def test_classes_equal_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op2_near_duplicates"](spark, SF).collect()}
    assert got == brute(rows)


def test_a_group_whose_members_resemble_neighbours_only(spark):
    rng = random.Random(3)
    words, rows = [f"w{i}" for i in range(150)], []
    for i in range(40):  # a drifting text: each version is like the last, the ends are unlike
        words[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"v{i}q{j}" for j in range(60))) for i in range(5)]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents(spark, rows)).collect()}
    assert got == brute(rows)


def test_a_large_family_without_its_original(spark):
    rng, words, rows = random.Random(4), [f"w{i}" for i in range(200)], []
    for i in range(1200):  # versions of four edits each; those that share two are similar enough, few do
        version = list(words)
        for _ in range(4):
            version[rng.randrange(200)] = f"e{rng.randrange(80)}"
        rows.append((i, " ".join(version)))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents(spark, rows)).collect()}
    sets = [set(bag(t)) for _, t in rows]
    place = {x: k for k, x in enumerate(set().union(*sets))}
    held = np.zeros((len(rows), len(place)), np.float32)
    for i, own in enumerate(sets):
        held[i, [place[x] for x in own]] = 1
    common, label = held @ held.T, np.arange(len(rows))
    alike = common / (held.sum(1)[:, None] + held.sum(1) - common) >= 0.8
    while (lower := np.where(alike, label, len(rows)).min(1)).tolist() != label.tolist():
        label = lower
    assert 1 < len(set(label.tolist())) < len(rows)
    assert [got[i] for i in range(len(rows))] == label.tolist()


ODD = [(5, "One two three, four five six."), (4, "one two three four five six"), (None, "ONE two three four five six"), (7, None), (8, ""), (9, "?!"), (7, None),
       (4, "one two three four five six"), (6, "short"), (3, "Short!"), (2, "z " * 60_000)]


def test_odd_rows(spark):
    out = values(near_dedup.classes(documents(spark, ODD)))
    assert out == sorted([(5, 4, 4), (4, 4, 4), (None, 4, 4), (7, 7, 1), (8, 8, 1), (9, 9, 1), (7, 7, 1), (4, 4, 4), (6, 3, 2), (3, 3, 2), (2, 2, 1)], key=repr)
    kept = near_dedup.keep_one(documents(spark, ODD))
    assert kept.columns == documents(spark, []).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([4, 7, 8, 9, 7, 3, 2], key=repr)
    assert near_dedup.classes(documents(spark, [])).count() == near_dedup.keep_one(documents(spark, [])).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 200)], "a bigint, b bigint")
    assert {r["root"] for r in components(edges, "a", "b").where("node <= 30").collect()} == {0}
