"""Registered queries against their checking SQL on the smallest tables.

A fast selection by default; all of them with MDCATALOG_ALL_QUERIES=1 or
``python -m workload.check 0.001``.
"""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from workload import check, star  # noqa: E402

SF = "/root/testdata/sf0.001"
FAST = ["profile_customer", "infer_csv_types", "fk_edges", "cochange_pairs", "ignore_filter", "frontmatter_parse", "parse_columns",
        "broken_links", "graph_degree", "merge_concepts", "drift_columns", "openapi_endpoints", "graphql_types", "upsert_section",
        "csv_file_profiles", "csv_range_cells", "file_tree"]
NAMES = [n for n in entry.queries() if n in entry.oracle_sql()] if os.environ.get("MDCATALOG_ALL_QUERIES") else FAST

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for t in star.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    ok, n, _, why = check.compare(spark, connection, SF, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok is not False, why


def test_fuzzy_search_equals_loop(spark):
    from mdcatalog.operators import graph
    from tests.test_text import loop_score
    from workload.queries import fuzzy_search, v1

    nodes = graph.concept_nodes(v1(spark, SF)).collect()
    scores = {n["id"]: loop_score("s1st", f"{n['id']} {n['title']} {n['type']} {' '.join(n['tags'])}") for n in nodes}
    expected = sorted(((i, s) for i, s in scores.items() if s >= 0), key=lambda x: (-x[1], x[0]))
    assert [(r["id"], r["score"]) for r in fuzzy_search(spark, SF).collect()] == expected


def test_every_query_is_checked_or_known():
    from workload.queries import ORACLES, QUERIES

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)
