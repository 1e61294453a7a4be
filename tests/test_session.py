"""Intermediate tables go when they are no longer needed."""

import os

import pytest

from mdcatalog import session
from workload.queries import merge_concepts, n_hop

SF = "/root/testdata/sf0.001"


def files(spark):
    base = session.shared_folder(spark).removeprefix("file:")
    return {os.path.join(d, f) for d, _, names in os.walk(base) for f in names}


@pytest.mark.parametrize("query", [merge_concepts, n_hop])
def test_nothing_stays_behind_a_query(spark, tmp_path, query):
    before = files(spark)
    with session.scratch(spark):
        query(spark, SF).write.parquet(str(tmp_path / "result"))
        assert files(spark) > before
    assert files(spark) == before
    assert spark.read.parquet(str(tmp_path / "result")).count()


def test_kept_tables_belong_to_what_is_around(spark):
    before = files(spark)
    with session.scratch(spark):
        with session.scratch(spark) as keep:
            inner = session.as_table(spark.range(5))
            kept = keep(session.cut_lineage(inner))
        assert kept.count() == 5
        session.drop_table(kept)
        kept = session.as_table(spark.range(3))
    assert files(spark) == before


def test_a_failure_cleans_too(spark):
    before = files(spark)
    with pytest.raises(ZeroDivisionError), session.scratch(spark):
        session.as_table(spark.range(5))
        raise ZeroDivisionError
    assert files(spark) == before
