"""The risk estimator on made-up features, held-out accuracy, and odd rows."""

import zlib

import numpy as np

from mdcatalog.llm import toxicity
from mdcatalog.llm.queries import QUERIES
from tests.llm.helpers import documents, values


def test_positive_unlabelled_fit_separates_and_respects_the_prior():
    rng = np.random.default_rng(0)
    clean = lambda: np.unique(rng.integers(1000, 3000, 40)).astype(np.int32)
    toxic = lambda: np.unique(np.r_[rng.integers(0, 12, 3), clean()]).astype(np.int32)
    positives, unlabelled = [toxic() for _ in range(300)], [toxic() if i % 10 == 0 else clean() for i in range(3000)]
    model = toxicity.fit(positives, unlabelled, 0.1)
    bad, good = np.array([model.score(toxic()) for _ in range(300)]), np.array([model.score(clean()) for _ in range(300)])
    assert (bad >= toxicity.THRESHOLD).mean() > 0.93 and (good < toxicity.THRESHOLD).mean() > 0.97
    assert toxicity.fit(positives, unlabelled, 0.1).score(positives[0]) == model.score(positives[0])
    assert toxicity.fit([], unlabelled, 0.1).score(positives[0]) == 0.0


def test_held_out_is_the_crc_of_the_id(spark):
    rows = documents(spark, [(i, "t") for i in range(-5, 60)] + [(None, "t")]).select("doc_id", toxicity.held_out().alias("h")).collect()
    assert all(r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_held_out_rows_are_not_learnt_from_and_accuracy(spark):
    words = ["lorem", "ipsum", "dolor", "amet", "elit"]
    rng = np.random.default_rng(1)
    text = lambda bad: " ".join([*rng.choice(words, 30), *(["vilestuff", "nastyword"] if bad else [])])
    rows = [(i, text(i % 6 == 0)) for i in range(900)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 6 == 0), 1) for i in range(600)] + [(None, 1, 1), (3, None, 1)], "doc_id bigint, toxic int, quality int")
    out = toxicity.score_documents(docs, labels).collect()
    held = [r for r in out if r["held_out"]]
    right = [(r["predicted"] == (r["doc_id"] % 6 == 0)) for r in held]
    assert len(out) == 900 and np.mean(right) > 0.97
    # labels of held-out rows change nothing
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - labels.toxic).otherwise(labels.toxic))
    assert values(toxicity.score_documents(docs, turned)) == values(toxicity.score_documents(docs, labels))


def test_features_chosen_by_tasks_give_the_model_of_all_features(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    known: dict = {}
    for r in labels.collect():
        if not held(r["doc_id"]):
            known[r["doc_id"]] = max(known.get(r["doc_id"], 0), r["toxic"])
    hashes = toxicity.FeatureHashes()
    found = [(r["doc_id"], toxicity.features(r["text"] or "", hashes)) for r in docs.orderBy("doc_id").collect() if not held(r["doc_id"])]
    expected = toxicity.fit([f for i, f in found if known.get(i) == 1], [f for _, f in found], sum(known.values()) / len(known))
    model = toxicity.train(docs, labels, ~toxicity.held_out())
    assert np.array_equal(model.weights, expected.weights) and np.array_equal(model.bias, expected.bias) and np.abs(model.weights).max() > 0


def test_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int, quality int")
    rows = [(1, None), (1, None), (None, ""), (2, "idiot " * 50_000)]
    assert values(toxicity.score_documents(documents(spark, rows), none), "doc_id", "score", "predicted") == sorted(
        [(1, 0.0, 0), (1, 0.0, 0), (None, 0.0, 0), (2, 0.0, 0)], key=repr)
    assert toxicity.score_documents(documents(spark, []), none).count() == 0


def test_query_scores_every_document(spark):
    out = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.01").collect()
    assert len(out) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
