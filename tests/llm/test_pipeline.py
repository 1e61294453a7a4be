"""The pipeline's stages: what each must drop and keep, and its end."""

import pytest

import corpus_pipeline
from mdcatalog.llm import secrets
from tests.llm.helpers import SF, documents
from tests.llm.test_decontamination import grams
from tests.llm.test_near_dedup import brute

STAGES = dict(corpus_pipeline.STAGES)
SCAN = secrets.automaton()


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The table after every stage."""
    folder, docs, out = tmp_path_factory.mktemp("steps"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["start"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out[name] = docs.collect()
    return out


def ids(rows):
    return {r["doc_id"] for r in rows}


def test_all_stages_but_the_last_return_documents(spark, steps):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(list(rows[0].asDict()) == columns for name, rows in steps.items() if name != "mixing")
    assert list(steps) == ["start", "toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]


def test_one_document_of_each_class_stays(steps):
    classes = brute([(r["doc_id"], r["text"]) for r in steps["toxicity"]])
    assert ids(steps["near_duplicates"]) == set(classes.values())


def test_leaks_and_secrets_go_and_the_rest_stays(spark, steps):
    items = [grams(r["text"], 5) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = lambda r: any(g and len(g & grams(r["text"], 5)) >= 0.8 * len(g) for g in items)
    assert ids(steps["decontamination"]) == {r["doc_id"] for r in steps["near_duplicates"] if not leaks(r)}
    holds = lambda r: any(k in secrets.REJECT for _, _, k, _ in secrets.find(r["text"], SCAN))
    assert ids(steps["secrets"]) == {r["doc_id"] for r in steps["decontamination"] if not holds(r)}


def test_the_mix_covers_what_was_kept(spark, steps):
    assert ids(steps["mixing"]) == ids(steps["secrets"]) and all(0 <= r["taken"] <= 3 * r["size"] for r in steps["mixing"])
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, steps["mixing"]))


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_rows_pass_every_stage(spark, name):
    rows = [(1, None), (1, None), (None, ""), (None, None, None), (2, "clean words in a row here", None), (3, "y " * 50_000)]
    out = STAGES[name](spark, documents(spark, rows), SF)
    assert out.count() == len(rows) and STAGES[name](spark, documents(spark, []), SF).count() == 0
