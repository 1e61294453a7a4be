"""Queries over the test tables, one or more per operator, each next to the SQL that checks it.

The SQL computes the expected rows directly from keys and values of the tables; it never
repeats the library's parsing. Queries without SQL are checked against plain Python in tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdcatalog import fixed_values as fv
from mdcatalog.functions import frontmatter as fm
from mdcatalog.functions import markdown as md
from mdcatalog.functions import paths as pt
from mdcatalog.functions import text as tx
from mdcatalog.functions.rows import evaluate_once
from mdcatalog.session import as_table
from mdcatalog.operators import audit, catalog, cochange, docs, drift, enrich, graph, merge, profile, render, specs

from . import star
from .star import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = star.duck(sql)
        return fn
    return register


def flat(column: str) -> F.Column:
    return F.array_join(column, ",").alias(column)


# Concepts of version 1 that can be parsed, straight from the tables.
V1 = f"v1 AS (SELECT * FROM ({star.concepts_sql(1)}) c WHERE enriched <> 'none')"
V2 = f"v2 AS (SELECT * FROM ({star.concepts_sql(2)}) c WHERE enriched <> 'none')"
PLACEHOLDER = "(description = '' OR description LIKE 'MySQL table %' OR description LIKE 'CSV file %')"

# Links of version 1 by (source, target, occurrences); targets may not exist.
_C, _S, _N, _P = "CAST(c_custkey AS STRING)", "CAST(s_suppkey AS STRING)", "CAST(n_nationkey AS STRING)", "CAST(p_partkey AS STRING)"
LINKS = f"""links AS (
  SELECT 'customers/' || {_C} AS source_id, 'nations/' || CAST(c_nationkey AS STRING) AS target_id,
    1 + CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 ELSE 0 END + CASE WHEN c_acctbal < 0 THEN 2 ELSE 0 END AS n FROM {{customer}}
  UNION ALL SELECT 'customers/' || {_C}, 'segments/MACHINERY', 1 FROM {{customer}} WHERE c_mktsegment = 'MACHINERY'
  UNION ALL SELECT 'suppliers/' || {_S}, 'nations/' || CAST(s_nationkey AS STRING), 1 FROM {{supplier}}
  UNION ALL SELECT 'nations/' || {_N}, 'regions/' || CAST(n_regionkey AS STRING), 1 FROM {{nation}}
    WHERE n_nationkey IN (SELECT c_nationkey FROM {{customer}})
  UNION ALL SELECT 'parts/' || {_P}, 'brands/' || replace(p_brand, '#', '-'), CASE WHEN p_size > 45 THEN 2 ELSE 1 END FROM {{part}} WHERE p_size >= 10
)"""
WORKING = "working AS (SELECT * FROM links WHERE target_id IN (SELECT concept_id FROM v1))"
DEGREE = """degree AS (SELECT concept_id, CAST(sum(n) AS BIGINT) AS degree FROM (
    SELECT source_id AS concept_id, n FROM working UNION ALL SELECT target_id, n FROM working) e GROUP BY concept_id)"""


#: What nodes of the graph are made of.
NODE = ("type", "title", "description", "resource", "tags")


def parsed(spark: SparkSession, sf: str, version: int = 1) -> DataFrame:
    """The bundle, rendered and parsed anew, for queries of one branch."""
    return docs.parse_concepts(star.bundle(spark, sf, version))


def _concept_table(spark: SparkSession, sf: str, version: int, columns: tuple[str, ...]) -> DataFrame:
    """What the branches of one query need of the bundle, written as a table; all of it unless columns are named."""
    concepts = parsed(spark, sf, version)
    return as_table(concepts.select("bundle", "concept_id", "parse_error", *columns) if columns else concepts)


def v1(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return _concept_table(spark, sf, 1, columns)


def v2(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return _concept_table(spark, sf, 2, columns)


# ============================================================== profiling

_SEMANTIC = f"""
    CASE WHEN shown > 0 AND email >= {fv.SEMANTIC_MAJORITY} * shown THEN 'email'
         WHEN shown > 0 AND uuid >= {fv.SEMANTIC_MAJORITY} * shown THEN 'uuid'
         WHEN shown > 0 AND iso >= {fv.SEMANTIC_MAJORITY} * shown THEN 'iso-timestamp'
         WHEN shown > 0 AND money >= {fv.SEMANTIC_MAJORITY} * shown THEN 'monetary'
         WHEN shown > 0 AND bool >= {fv.SEMANTIC_MAJORITY} * shown THEN 'boolean'"""


def _evidence_sql(weight: str) -> str:
    def total(test: str) -> str:
        return f"sum(CASE WHEN value IS NOT NULL AND trim(value) <> '' AND {test} THEN {weight} ELSE 0 END)"

    words = ", ".join(f"'{w}'" for w in fv.BOOLEAN_WORDS)
    return f"""{total('true')} AS shown, {total(f"regexp_matches(value, '{fv.EMAIL}')")} AS email,
        {total(f"regexp_matches(value, '{fv.UUID}')")} AS uuid, {total(f"regexp_matches(value, '{fv.ISO_TIME}')")} AS iso,
        {total(f"regexp_matches(value, '{fv.MONETARY}')")} AS money, {total(f"lower(value) IN ({words})")} AS bool,
        bool_and(CASE WHEN trim(value) <> '' THEN regexp_matches(value, '{fv.INTEGER}') END) AS ints"""


def profile_sql(name: str, columns: list[str]) -> str:
    """Profile of a table, one block per column."""
    blocks = []
    for i, c in enumerate(columns):
        blocks.append(f"""
  SELECT '{c}' AS "column", {i} AS ordinal, s.non_null, s.nulls, s."distinct", s.lo AS "min", s.hi AS "max",
    {_SEMANTIC} WHEN s."distinct" BETWEEN 1 AND 12 THEN 'enum'
         WHEN regexp_matches('{c}', '{fv.KEY_NAME}') AND ints THEN 'fk-ish' ELSE '' END AS semantic,
    CASE WHEN s."distinct" BETWEEN 1 AND 12 THEN head ELSE '' END AS "values"
  FROM (SELECT count({c}) AS non_null, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS "distinct",
          CAST(min({c}) AS STRING) AS lo, CAST(max({c}) AS STRING) AS hi FROM {name}) s,
       (SELECT coalesce(string_agg(value, ',' ORDER BY value), '') AS head, {_evidence_sql('1')} FROM (
          SELECT DISTINCT CAST({c} AS STRING) AS value FROM {name} WHERE {c} IS NOT NULL ORDER BY value LIMIT 13)) e""")
    return " UNION ALL ".join(blocks)


def _profile(spark: SparkSession, sf: str, name: str) -> DataFrame:
    out = profile.profile(table(spark, sf, name))
    return out.withColumn("values", F.array_join("values", ","))


@query(profile_sql("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                                "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]))
def profile_lineitem(spark, sf):
    return _profile(spark, sf, "lineitem")


@query(profile_sql("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]))
def profile_orders(spark, sf):
    return _profile(spark, sf, "orders")


@query(profile_sql("events", ["event_id", "ts", "user_id", "event_type", "value", "props"]))
def profile_events(spark, sf):
    return _profile(spark, sf, "events")


@query(profile_sql("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]))
def profile_customer(spark, sf):
    return _profile(spark, sf, "customer")


_SHEET = """SELECT p_partkey AS row_no, CAST(p_partkey AS STRING) AS id, CASE WHEN p_size < 10 THEN '  ' ELSE ' ' || p_name || ' ' END AS name,
    CASE WHEN p_type = 'PROMO' THEN '' ELSE CAST(p_size AS STRING) END AS size,
    '$' || CAST(p_size AS STRING) || '.00' AS price, CASE WHEN p_size > 40 THEN 'yes' ELSE 'No' END AS flag FROM {part}"""
_SHEET_NUMBERS = {"id", "size"}


def _sheet(spark: SparkSession, sf: str) -> DataFrame:
    return star.run_sql(spark, sf, _SHEET)


def _sheet_profile_sql() -> str:
    blocks = []
    for i, c in enumerate(["id", "name", "size", "price", "flag"]):
        lo, hi = ("CAST(min(CAST(value AS DOUBLE)) AS STRING)", "CAST(max(CAST(value AS DOUBLE)) AS STRING)") if c in _SHEET_NUMBERS else ("min(value)", "max(value)")
        blocks.append(f"""SELECT '{c}' AS "column", {i} AS ordinal, count(value) AS non_null, count(*) - count(value) AS nulls,
          count(DISTINCT value) AS "distinct", {lo} AS "min", {hi} AS "max", (SELECT {_SEMANTIC} ELSE '' END FROM (
            SELECT {_evidence_sql('1')} FROM (SELECT nullif(trim({c}), '') AS value FROM ({_SHEET})))) AS semantic,
          CASE WHEN count(DISTINCT value) BETWEEN 1 AND 12 THEN string_agg(DISTINCT value, ',' ORDER BY value) ELSE '' END AS "values"
        FROM (SELECT nullif(trim({c}), '') AS value FROM ({_SHEET}))""")
    return " UNION ALL ".join(blocks)


@query(_sheet_profile_sql())
def profile_blank_as_null(spark, sf):
    sheet = _sheet(spark, sf)
    columns = ["id", "name", "size", "price", "flag"]
    types = profile.infer_csv_types(sheet, ["row_no"], fv.TYPE_INFERENCE_ROWS, columns=columns)
    out = profile.profile(sheet, columns, blank_as_null=True, evidence="all", types=types)
    return out.withColumn("values", F.array_join("values", ","))


_VALUES = """SELECT 'mail' AS kind, 'c' || CAST(c_custkey AS STRING) || '@' || lower(c_mktsegment) || '.org' AS value FROM {customer}
    UNION ALL SELECT 'stray', CASE WHEN c_acctbal < 0 THEN 'n/a' ELSE 'x@y.z' END FROM {customer}
    UNION ALL SELECT 'uuid', substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12)
      FROM (SELECT md5(CAST(o_orderkey AS STRING)) AS h FROM {orders}) u
    UNION ALL SELECT 'day', substr(CAST(o_orderdate AS STRING), 1, 10) FROM {orders}
    UNION ALL SELECT 'money', CASE WHEN p_size < 3 THEN '' ELSE '$1,' || CAST(100 + p_size AS STRING) || '.50' END FROM {part}
    UNION ALL SELECT 'yesno', CASE WHEN s_acctbal < 0 THEN ' No ' ELSE 'yes' END FROM {supplier}
    UNION ALL SELECT 'text', n_name FROM {nation}"""


@query(f"""SELECT kind, {_SEMANTIC} ELSE '' END AS semantic FROM (
    SELECT kind, {_evidence_sql('1')} FROM (SELECT kind, trim(value) AS value FROM ({_VALUES})) GROUP BY kind)""")
def semantic_types(spark, sf):
    return profile.semantic_type(star.run_sql(spark, sf, _VALUES), "kind")


_TEXTS = """SELECT o_orderkey AS row_no, CAST(o_orderkey AS STRING) AS a, CASE WHEN o_orderstatus = 'F' THEN '' ELSE CAST(o_totalprice AS STRING) END AS b,
    CAST(o_orderdate AS STRING) AS c, o_orderpriority AS d, CASE WHEN o_totalprice > 200000 THEN 'Yes' ELSE 'f' END AS e, ' ' AS f FROM {orders}"""


def _types_sql(limit: str = f"LIMIT {fv.TYPE_INFERENCE_ROWS}") -> str:
    blocks = []
    for i, c in enumerate("abcdef"):
        blocks.append(f"""SELECT '{c}' AS "column", {i} AS ordinal, CASE
          WHEN count(v) > 0 AND bool_and(v IS NULL OR (try_cast(v AS BIGINT) IS NOT NULL AND regexp_matches(v, '^[+-]?[0-9]+$'))) THEN 'integer'
          WHEN count(v) > 0 AND bool_and(v IS NULL OR try_cast(v AS DOUBLE) IS NOT NULL) THEN 'number'
          WHEN count(v) > 0 AND bool_and(lower(v) IN ('true', 'false', 'yes', 'no', 't', 'f')) THEN 'boolean'
          WHEN count(v) > 0 AND bool_and(v IS NULL OR try_cast(v AS TIMESTAMP) IS NOT NULL) THEN 'date' ELSE 'string' END AS type
        FROM (SELECT nullif(trim({c}), '') AS v FROM ({_TEXTS}) ORDER BY row_no {limit})""")
    return " UNION ALL ".join(blocks)


@query(_types_sql())
def infer_csv_types(spark, sf):
    """By the first rows only, as the cap says."""
    return profile.infer_csv_types(star.run_sql(spark, sf, _TEXTS), ["row_no"], fv.TYPE_INFERENCE_ROWS, columns=list("abcdef"))


@query(_types_sql(limit=""))
def infer_csv_types_all(spark, sf):
    """By every row."""
    return profile.infer_csv_types(star.run_sql(spark, sf, _TEXTS), ["row_no"], columns=list("abcdef"))


@query("""SELECT "column", CAST(ordinal AS INTEGER) AS ordinal, 'string' AS type FROM (VALUES ('a', 0), ('b', 1)) t("column", ordinal)
  UNION ALL SELECT 'rows', CAST(count(*) AS INTEGER), 'none' FROM {orders} WHERE o_totalprice < -1e300""")
def infer_types_empty(spark, sf):
    """A filter that keeps nothing leaves a header: every column is a string."""
    rows = table(spark, sf, "orders").where("o_totalprice < -1e300").selectExpr("o_orderkey AS row_no", "CAST(o_orderkey AS STRING) AS a", "o_orderpriority AS b")
    count = rows.agg(F.count("*").cast("int").alias("ordinal")).select(F.lit("rows").alias("column"), "ordinal", F.lit("none").alias("type"))
    return profile.infer_csv_types(rows, ["row_no"], columns=["a", "b"]).unionByName(count)


@query("""SELECT 'o_orderkey' AS "column", 0 AS ordinal, count(*) AS non_null, count(*) AS nulls, count(*) AS "distinct" FROM {orders} WHERE o_totalprice < -1e300
  UNION ALL SELECT 'o_orderpriority', 1, count(*), count(*), count(*) FROM {orders} WHERE o_totalprice < -1e300""")
def profile_empty(spark, sf):
    """The profile of a filter that keeps nothing has a row per column."""
    rows = table(spark, sf, "orders").where("o_totalprice < -1e300").select("o_orderkey", "o_orderpriority")
    return profile.profile(rows).select("column", "ordinal", "non_null", "nulls", "distinct")


@query("""SELECT event_type AS collection, count(*) AS documents, count(*) FILTER (WHERE event_id % 7 = 3) AS unreadable FROM {events} GROUP BY event_type""")
def infer_json_broken(spark, sf):
    """Texts cut off by key are counted and stop nothing."""
    props = F.when(F.col("event_id") % 7 == 3, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    return profile.unreadable_documents(table(spark, sf, "events").select("event_type", props.alias("doc")), "doc", "event_type")


@query("""WITH f AS (
    SELECT 'id' AS field, 'number' AS type, count(*) AS n FROM {events}
    UNION ALL SELECT 'user', 'string', count(*) FROM {events}
    UNION ALL SELECT 'total', 'number / string', count(*) FILTER (WHERE event_type IN ('error', 'click', 'view')) FROM {events}
    UNION ALL SELECT 'code', 'null', count(*) FILTER (WHERE event_type = 'error') FROM {events}
    UNION ALL SELECT 'tags', 'array', count(*) FILTER (WHERE event_type = 'click') FROM {events}
    UNION ALL SELECT 'nested', 'object', count(*) FILTER (WHERE event_type = 'view') FROM {events}
    UNION ALL SELECT 'ok', 'boolean', count(*) FILTER (WHERE event_type NOT IN ('error', 'click', 'view')) FROM {events})
  SELECT field, type, CAST(floor(100.0 * n / (SELECT count(*) FROM {events}) + 0.5) AS INTEGER) AS presence_pct FROM f""")
def infer_json_fields(spark, sf):
    return profile.infer_fields(star.event_documents(spark, sf), "doc")


@query("""WITH g AS (SELECT event_type, count(*) AS total FROM {events} GROUP BY event_type)
  SELECT event_type, field, type, 100 AS presence_pct FROM g, (VALUES ('id', 'number', ''), ('user', 'string', ''), ('total', 'string', 'error'),
    ('code', 'null', 'error'), ('total', 'number', 'click'), ('tags', 'array', 'click'), ('total', 'number', 'view'), ('nested', 'object', 'view'),
    ('ok', 'boolean', 'purchase'), ('ok', 'boolean', 'signup')) f(field, type, only_for) WHERE only_for = '' OR only_for = event_type""")
def infer_json_fields_grouped(spark, sf):
    return profile.infer_fields(star.event_documents(spark, sf), "doc", group="event_type")


@query("""SELECT * FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM {events}) r
  WHERE n <= 100""".replace("SELECT * FROM", "SELECT event_type, event_id FROM", 1))
def document_sample(spark, sf):
    """First documents of every collection."""
    return profile.head_per_group(star.event_documents(spark, sf), fv.DOCUMENT_SAMPLE, ["event_type"], ["event_id"]).select("event_type", "event_id")


def _stats_sql(name: str, column: str | None) -> str:
    bounds = f"CAST(min({column}) AS STRING), CAST(max({column}) AS STRING)" if column else "NULL, NULL"
    label = f"'{column}'" if column else "NULL"
    return f"SELECT '{name}' AS \"table\", count(*), {label}, {bounds} FROM {name}"


_FRESH = {"region": None, "nation": None, "customer": None, "supplier": None, "part": None, "orders": "o_orderdate",
          "lineitem": "l_shipdate", "events": "ts", "documents": None, "embeddings": None, "pages": None, "benchmark": None,
          "labels": None, "conversations": None}


@query("SELECT * FROM (" + " UNION ALL ".join(_stats_sql(t, c) for t, c in _FRESH.items()) +
       ") s(\"table\", row_count, freshness_column, earliest, latest)")
def table_stats(spark, sf):
    out = None
    for name in _FRESH:
        one = profile.table_stats(table(spark, sf, name)).withColumn("table", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("""WITH c AS (SELECT schema, name, ordinal, type FROM (SELECT 'shop_' || CAST(s_suppkey AS STRING) AS schema,
      unnest([{{'name': 'id', 'ordinal': 1, 'type': 'int'}}, {{'name': 'created_at', 'ordinal': 2, 'type': 'text'}},
              {{'name': CASE WHEN s_acctbal < 0 THEN 'updated' ELSE 'note' END, 'ordinal': 3, 'type': CASE WHEN s_acctbal < 0 THEN 'timestamp' ELSE 'text' END}}], recursive := true) FROM {supplier}))
  SELECT schema AS "table", CASE WHEN max(CASE WHEN type = 'timestamp' THEN 1 ELSE 0 END) = 1 THEN 'updated' ELSE 'created_at' END AS "column" FROM c GROUP BY schema""")
def freshness_column(spark, sf):
    negative = F.col("s_acctbal") < 0
    rows = F.array(
        F.struct(F.lit("id").alias("name"), F.lit(1).alias("ordinal"), F.lit("int").alias("type")),
        F.struct(F.lit("created_at").alias("name"), F.lit(2).alias("ordinal"), F.lit("text").alias("type")),
        F.struct(F.when(negative, "updated").otherwise("note").alias("name"), F.lit(3).alias("ordinal"),
                 F.when(negative, "timestamp").otherwise("text").alias("type")))
    return profile.freshness_column(star.shops(spark, sf).select(F.col("schema").alias("table"), F.inline(rows)))


@query("""SELECT CAST(c_custkey AS STRING) AS c_custkey, c_name, CAST(c_nationkey AS STRING) AS c_nationkey, CAST(c_acctbal AS STRING) AS c_acctbal,
    coalesce(c_mktsegment, 'NULL') AS c_mktsegment FROM {customer} ORDER BY customer.c_custkey LIMIT 20""")
def sample_rows(spark, sf):
    return profile.sample_rows(table(spark, sf, "customer"), 20, ["c_custkey"])


@query("SELECT DISTINCT c_name AS value FROM {customer} ORDER BY value LIMIT 13")
def distinct_values(spark, sf):
    return profile.distinct_values(table(spark, sf, "customer"), "c_name")


@query("""WITH n AS (SELECT c_nationkey AS k, count(*) AS n, sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS weak FROM {customer} GROUP BY c_nationkey)
  SELECT 'nations/' || CAST(k AS STRING) AS concept_id, 'c_custkey' AS "column", 0 AS null_pct, 100 AS fill_pct FROM n
  UNION ALL SELECT 'nations/' || CAST(k AS STRING), 'c_mktsegment', CAST(floor(100.0 * weak / n + 0.5) AS INTEGER), 100 - CAST(floor(100.0 * weak / n + 0.5) AS INTEGER) FROM n""")
def null_ratio(spark, sf):
    return profile.null_ratio(docs.parse_profiles(parsed(spark, sf))).select("concept_id", "column", "null_pct", "fill_pct")


# ============================================================== catalogs

_SHOP = "SELECT 'shop_' || CAST(s_suppkey AS STRING) AS schema"


@query(f"""{_SHOP}, k.* FROM {{supplier}}, (VALUES ('orders', 'orders_user', 1, 'user_id', 'users', 'id'),
    ('shipments', 'shipments_variant', 1, 'product_id', 'product_variants', 'product_id'),
    ('shipments', 'shipments_variant', 2, 'sku', 'product_variants', 'sku')) k("table", "constraint", ordinal, "column", ref_table, ref_column)""")
def fk_edges(spark, sf):
    """Foreign keys of every shop; a composite key gives one edge per column."""
    return catalog.foreign_keys(star.constraints(spark, sf), star.key_columns(spark, sf), star.referential(spark, sf))


@query(f"""{_SHOP}, k.* FROM {{supplier}}, (VALUES ('tables/orders', 'FK on user_id', '/tables/users.md', 'users'),
    ('tables/shipments', 'FK on product_id', '/tables/product_variants.md', 'product_variants'),
    ('tables/shipments', 'FK on sku', '/tables/product_variants.md', 'product_variants')) k(source_id, label, target, text)""")
def fk_relationships(spark, sf):
    return catalog.fk_relationships(fk_edges(spark, sf))


@query(f"""{_SHOP}, k.* FROM {{supplier}}, (VALUES ('users', 'users_name', 'UNIQUE', 'username'),
    ('product_variants', 'variants_label', 'UNIQUE', 'sku, label')) k("table", name, type, definition)""")
def unique_constraints(spark, sf):
    return catalog.unique_constraints(star.constraints(spark, sf), star.key_columns(spark, sf))


@query(f"""{_SHOP}, k.* FROM {{supplier}}, (VALUES ('users', 'users_pk', 'PRIMARY KEY', 'id'), ('orders', 'orders_pk', 'PRIMARY KEY', 'id'),
    ('product_variants', 'variants_pk', 'PRIMARY KEY', 'product_id, sku'), ('shipments', 'shipments_pk', 'PRIMARY KEY', 'id')) k("table", name, type, definition)""")
def primary_keys(spark, sf):
    return catalog.key_constraints(star.constraints(spark, sf), star.key_columns(spark, sf), ("PRIMARY KEY",))


@query(f"""{_SHOP}, k.* FROM {{supplier}}, (VALUES ('users', 'age_check', 'CHECK', 'age >= 0'), ('orders', 'total_check', 'CHECK', '(total > 0)'))
    k("table", name, type, definition)""")
def check_constraints(spark, sf):
    return catalog.check_constraints(star.constraints(spark, sf), star.checks(spark, sf))


@query(f"""{_SHOP}, 'users' AS "table", 'check_' || CAST(k.no AS STRING) AS name, 'CHECK' AS type,
    CASE WHEN k.no = 1 THEN 'age >= 0 AND (age < 150)' ELSE 'length(name) > ' || CAST(s_suppkey AS STRING) END AS definition
    FROM {{supplier}}, (VALUES (1), (2)) k(no)""")
def ddl_checks(spark, sf):
    return catalog.ddl_checks(star.ddl(spark, sf))


@query(f"""{_SHOP}, k.* FROM {{supplier}}, (VALUES ('users', 'ix_age', 'age', false), ('users', 'ux_name', 'username', true),
    ('orders', 'ix_user_date', 'user_id,order_date', false)) k("table", name, columns, "unique")""")
def index_columns(spark, sf):
    return catalog.indexes(star.index_columns(spark, sf)).withColumn("columns", F.array_join("columns", ","))


@query(f"""{_SHOP}, 'users' AS "table", 'ux_name' AS name, 'UNIQUE' AS type, 'username' AS definition FROM {{supplier}}""")
def unique_from_indexes(spark, sf):
    return catalog.unique_from_indexes(star.index_columns(spark, sf))


@query(f"""{_SHOP}, k.name, k.kind, CASE WHEN k.name = 'orders' AND s_acctbal >= 0 THEN 'Orders of ' || s_name ELSE '' END AS comment, k.view_sql
    FROM {{supplier}}, (VALUES ('orders', 'table', NULL), ('users', 'table', NULL), ('late_orders', 'view', ' SELECT * FROM orders '), ('sqlitex', 'table', NULL)) k(name, kind, view_sql)""")
def entity_listing(spark, sf):
    return catalog.entities(star.shop_tables(spark, sf))


@query(f"""{_SHOP}, k.name, CASE WHEN k.name = 'orders' AND s_acctbal >= 0 THEN 'Orders of ' || s_name ELSE '' END AS comment FROM {{supplier}},
    (VALUES ('orders'), ('late_orders')) k(name)""")
def entity_allow_list(spark, sf):
    return catalog.entities(star.shop_tables(spark, sf), catalog.parse_allow_list("orders, late_orders")).select("schema", "name", "comment")


@query("""SELECT c_mktsegment AS schema, c_name AS name, 'table' AS kind, CASE WHEN c_acctbal < 0 THEN '' ELSE 'About ' || c_name END AS comment FROM {customer}""")
def entity_comments(spark, sf):
    """Classes joined with their namespace and description."""
    c = table(spark, sf, "customer")
    spaces = c.select(F.col("c_mktsegment").alias("namespace_id")).distinct().withColumn("schema", F.col("namespace_id"))
    classes = c.select(F.col("c_custkey").alias("class_id"), F.col("c_mktsegment").alias("namespace_id"), F.col("c_name").alias("name"), F.lit("table").alias("kind"))
    texts = c.where("c_acctbal >= 0").select(F.col("c_custkey").alias("class_id"), F.concat(F.lit("About "), "c_name").alias("comment"))
    return catalog.entity_comments(classes, spaces, texts)


@query(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", {i} AS ordinal, '{c}' AS name, '{k}' AS type, '{m}' AS mode, count({c}) AS filled FROM {t}" for t, cols in {
    "embeddings": [("vec_id", "bigint", "Nullable"), ("embedding", "array<float>", "Repeated"), ("label", "int", "Nullable")],
    "orders": [("o_orderkey", "bigint", "Nullable"), ("o_custkey", "bigint", "Nullable"), ("o_orderstatus", "string", "Nullable"),
               ("o_totalprice", "double", "Nullable"), ("o_orderdate", "timestamp_ntz", "Nullable"), ("o_orderpriority", "string", "Nullable")],
}.items() for i, (c, k, m) in enumerate(cols)))
def column_catalog(spark, sf):
    """Columns of stored tables as rows, with how many of the table's rows fill each."""
    tables, counts = {t: table(spark, sf, t) for t in ("embeddings", "orders")}, None
    for t, df in tables.items():
        one = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "name", "filled").withColumn("table", F.lit(t))
        counts = one if counts is None else counts.unionByName(one)
    return profile.column_rows(tables).join(counts, ["table", "name"]).select("table", "ordinal", "name", "type", "mode", "filled")


# ============================================================== change history

_CHANGES = "SELECT DISTINCT l_orderkey, l_suppkey FROM {lineitem}"
_PAIRS = f"""SELECT a.l_suppkey AS ka, b.l_suppkey AS kb, count(*) AS n FROM ({_CHANGES}) a JOIN ({_CHANGES}) b
    ON a.l_orderkey = b.l_orderkey AND a.l_suppkey <> b.l_suppkey GROUP BY 1, 2"""


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as commits, suppliers as files."""
    name = F.concat(F.lit("supplier/"), F.col("l_suppkey").cast("string"))
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("commit_id"), name.alias("path"))


@query(f"""SELECT a, b, n FROM (SELECT 'supplier/' || CAST(ka AS STRING) AS a, 'supplier/' || CAST(kb AS STRING) AS b, n FROM ({_PAIRS})) WHERE a < b AND n >= 2""")
def cochange_pairs(spark, sf):
    return cochange.cochange_pairs(_changes(spark, sf))


@query(f"""SELECT file, partner, n FROM (SELECT file, partner, n, row_number() OVER (PARTITION BY file ORDER BY n DESC, partner) AS r FROM (
      SELECT 'supplier/' || CAST(ka AS STRING) AS file, 'supplier/' || CAST(kb AS STRING) AS partner, n FROM ({_PAIRS})
      WHERE n >= 2 AND kb IN (SELECT s_suppkey FROM {{supplier}} WHERE s_acctbal >= 0)) p) r WHERE r <= 10""")
def cochange_top(spark, sf):
    """Ten partners per supplier, among suppliers with a non-negative balance."""
    existing = table(spark, sf, "supplier").where("s_acctbal >= 0").select(
        F.concat(F.lit("supplier/"), F.col("s_suppkey").cast("string")).alias("path"))
    return cochange.related(cochange.cochange_pairs(_changes(spark, sf)), existing=existing)


_COMMITS = "SELECT event_id AS commit_id, 'users/' || CAST(user_id AS STRING) AS path, ts AS modified_at, event_type AS author, props AS message FROM {events}"


def _commits(spark: SparkSession, sf: str) -> DataFrame:
    return star.run_sql(spark, sf, _COMMITS).withColumnRenamed("modified_at", "at")


@query(f"""SELECT path, modified_at AS "at", commit_id, author, message FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY modified_at DESC, commit_id DESC) AS r FROM ({_COMMITS})) x WHERE r = 1""")
def latest_change(spark, sf):
    return cochange.latest_change(_commits(spark, sf))


@query("""WITH last AS (SELECT user_id, max(ts) AS last_at FROM {events} GROUP BY user_id)
  SELECT 'users/' || CAST(c_custkey AS STRING) AS path, coalesce(CAST(last_at AS STRING), '2000-01-01 00:00:00') AS "at" FROM {customer} LEFT JOIN last ON c_custkey = user_id""")
def last_change_or_modified(spark, sf):
    files = table(spark, sf, "customer").select(
        F.concat(F.lit("users/"), F.col("c_custkey").cast("string")).alias("path"), F.expr("timestamp_ntz'2000-01-01 00:00:00'").alias("modified"))
    out = cochange.with_last_change(files, _commits(spark, sf))
    return out.select("path", F.col("at").cast("string").alias("at"))


_PATHS = "SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS path FROM {pages}"
_IGNORED = ["# comment", "", "*.html", "/spam-farm.example.org/", "m.*/en/*", "blog.*"]


@query(f"""SELECT page_id, path FROM ({_PATHS}) WHERE NOT (regexp_matches(path, '\\.html(/|$)') OR path LIKE 'spam-farm.example.org/%' OR path = 'spam-farm.example.org'
    OR regexp_matches(path, '^m\\.[^/]*/en/[^/]*') OR regexp_matches(path, '^blog\\.[^/]*'))""")
def ignore_filter(spark, sf):
    """Pages as a file tree: everything below an ignored directory goes too."""
    return cochange.drop_ignored(star.run_sql(spark, sf, _PATHS), cochange.ignore_patterns(_IGNORED))


@query(f"""SELECT page_id, path FROM ({_PATHS}) WHERE NOT (regexp_matches(path, '\\.html(/|$)') OR path LIKE 'spam-farm.example.org/%' OR path = 'spam-farm.example.org'
    OR regexp_matches(path, '^m\\.[^/]*/en/[^/]*$') OR regexp_matches(path, '^blog\\.[^/]*$'))""")
def ignore_filter_files(spark, sf):
    """The same rules on single paths, as change sets use them."""
    return cochange.drop_ignored(star.run_sql(spark, sf, _PATHS), cochange.ignore_patterns(_IGNORED), match_ancestors=False)


# ============================================================== documents


@query(f"WITH {V1} SELECT concept_id, type, title, description, 'star:///' || concept_id AS resource, 'star,' || tag AS tags, hash AS content_hash, "
       "CASE enriched WHEN 'current' THEN hash WHEN 'stale' THEN 'older' ELSE '' END AS enriched_against, "
       "(CASE WHEN description = '' THEN 'owner=nobody;' ELSE '' END) || (CASE WHEN enriched = '' THEN 'reviewed=no;' ELSE '' END) AS extra, "
       "md5(body || CASE WHEN noted THEN chr(10) || '# Notes' || chr(10) || chr(10) || 'Key account.' || chr(10) ELSE '' END) AS body FROM v1")
def frontmatter_parse(spark, sf):
    c = docs.readable(docs.parse_concepts(star.bundle(spark, sf, 1)))
    entries = F.transform(F.array_sort(F.map_entries("extra")), lambda e: F.concat(e["key"], F.lit("="), e["value"], F.lit(";")))
    return c.select("concept_id", "type", "title", "description", "resource", flat("tags"), "content_hash", "enriched_against",
                    F.array_join(entries, "").alias("extra"), F.md5("body").alias("body"))


@query("SELECT 'parts/' || CAST(p_partkey AS STRING) || '.md' AS path, 'missing frontmatter boundaries' AS parse_error FROM {part} WHERE p_size = 1")
def frontmatter_errors(spark, sf):
    """Files that are no concepts, with the general YAML step switched on."""
    concepts = docs.parse_concepts(star.bundle(spark, sf, 1))
    return concepts.where("parse_error IS NOT NULL").select("path", "parse_error")


@query(f"WITH {V1} SELECT concept_id, type, title, 'star,' || tag AS tags, CASE WHEN {PLACEHOLDER} THEN 'placeholder' ELSE 'enriched' END AS coverage FROM v1")
def concept_listing(spark, sf):
    return docs.with_coverage(docs.listing(parsed(spark, sf))).select("concept_id", "type", "title", flat("tags"), "coverage")


_SECTIONS = f"""WITH {V1}, s AS (
    SELECT concept_id, 1 AS level, 'Columns' AS heading FROM v1 WHERE tag <> 'brand'
    UNION ALL SELECT concept_id, 1, 'Brand' FROM v1 WHERE tag = 'brand'
    UNION ALL SELECT concept_id, 1, 'Relationships' FROM v1 WHERE tag IN ('customer', 'supplier', 'nation')
    UNION ALL SELECT concept_id, 2, 'See Also' FROM v1 WHERE tag = 'customer'
    UNION ALL SELECT concept_id, 2, 'Data Profile' FROM v1 WHERE tag = 'nation'
    UNION ALL SELECT concept_id, 1, 'Notes' FROM v1 WHERE noted
    UNION ALL SELECT 'customers/' || {_C}, 1, 'Joins' FROM {{customer}} WHERE c_acctbal < 0
    UNION ALL SELECT 'parts/' || {_P}, 1, 'Joins' FROM {{part}} WHERE p_size >= 10
    UNION ALL SELECT 'parts/' || {_P}, 1, 'Citations' FROM {{part}} WHERE p_size > 45)"""


@query(_SECTIONS + " SELECT concept_id, level, heading FROM s")
def heading_list(spark, sf):
    return docs.sections(parsed(spark, sf)).select("concept_id", "level", "heading")


@query(f"""SELECT 'customers/' || {_C} AS concept_id, CASE c_mktsegment WHEN 'MACHINERY' THEN '- [segment](/segments/MACHINERY.md)'
    WHEN 'FURNITURE' THEN '- [site](https://example.com/c.md)' WHEN 'HOUSEHOLD' THEN '- [self](/customers/' || {_C} || '.md)' ELSE '- none' END AS see_also,
    CASE WHEN c_acctbal > 9000 THEN 'Key account.' END AS notes, c_acctbal < 0 AS joins FROM {{customer}}""")
def section_extract(spark, sf):
    """One level-2 section, one found at any level, and a presence test."""
    body = F.col("body")
    return parsed(spark, sf).where("concept_id LIKE 'customers/%'").select(
        "concept_id", md.get_section(body, "See Also").alias("see_also"), md.get_section(body, "Notes", any_level=True).alias("notes"),
        md.has_section(body, "Joins", any_level=True).alias("joins"))


@query(r"""SELECT doc_id, sha256(rtrim(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t]+(\n|$)', '\1', 'g'), chr(10)) || chr(10)) AS hash FROM {documents}""")
def structural_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.structural_hash(F.col("text")).alias("hash"))


@query(f"""WITH {V1} SELECT concept_id, hash FROM v1""")
def structural_hash_bundle(spark, sf):
    """Hash of the parsed body without the sections people added."""
    own = F.concat(md.trim_newlines(F.substring_index("body", "\n# Notes\n", 1)), F.lit("\n"))
    bodies = evaluate_once(docs.readable(parsed(spark, sf)), "concept_id", own.alias("own"))
    return bodies.select("concept_id", tx.structural_hash(F.col("own")).alias("hash"))


_COLUMN_ROWS = f"""cols AS (
    SELECT 'customers/' || {_C} AS concept_id, unnest([{{{{'ordinal': 1, 'name': 'c_custkey', 'type': 'bigint', 'pk': true, 'comment': 'Customer key'}}}},
      {{{{'ordinal': 2, 'name': 'c_name', 'type': 'string', 'pk': false, 'comment': ''}}}},
      {{{{'ordinal': 3, 'name': 'c_nationkey', 'type': 'int', 'pk': false, 'comment': CASE WHEN c_acctbal >= 0 THEN 'Nation of the customer' ELSE '' END}}}},
      {{{{'ordinal': 4, 'name': 'c_acctbal', 'type': 'double', 'pk': false, 'comment': ''}}}},
      {{{{'ordinal': 5, 'name': 'c_mktsegment', 'type': 'string', 'pk': false, 'comment': 'Segment ' || chr(92) || '| ' || c_mktsegment}}}}], recursive := true) FROM {{customer}}
    UNION ALL SELECT 'suppliers/' || {_S}, unnest([{{{{'ordinal': 1, 'name': 's_suppkey', 'type': 'bigint', 'pk': true, 'comment': 'Supplier key'}}}},
      {{{{'ordinal': 2, 'name': 's_name', 'type': 'string', 'pk': false, 'comment': ''}}}}, {{{{'ordinal': 3, 'name': 's_nationkey', 'type': 'int', 'pk': false, 'comment': 'Nation'}}}},
      {{{{'ordinal': 4, 'name': 's_acctbal', 'type': 'double', 'pk': false, 'comment': ''}}}}], recursive := true) FROM {{supplier}}
    UNION ALL SELECT 'nations/' || {_N}, unnest([{{{{'ordinal': 1, 'name': 'n_nationkey', 'type': 'int', 'pk': true, 'comment': 'Nation key'}}}},
      {{{{'ordinal': 2, 'name': 'n_name', 'type': 'string', 'pk': false, 'comment': ''}}}},
      {{{{'ordinal': 3, 'name': 'n_regionkey', 'type': 'int', 'pk': false, 'comment': 'Region of the nation'}}}}], recursive := true) FROM {{nation}} WHERE n_nationkey IN (SELECT c_nationkey FROM {{customer}})
    UNION ALL SELECT 'regions/' || CAST(r_regionkey AS STRING), unnest([{{{{'ordinal': 1, 'name': 'r_regionkey', 'type': 'int', 'pk': true, 'comment': 'Region key'}}}},
      {{{{'ordinal': 2, 'name': 'r_name', 'type': 'string', 'pk': false, 'comment': ''}}}}], recursive := true) FROM {{region}}
    UNION ALL SELECT 'parts/' || {_P}, unnest([{{{{'ordinal': 1, 'name': 'p_partkey', 'type': 'bigint', 'pk': NULL, 'comment': ''}}}},
      {{{{'ordinal': 2, 'name': 'p_name', 'type': 'string', 'pk': NULL, 'comment': ''}}}}], recursive := true) FROM {{part}} WHERE p_size <> 1)"""


@query(f"WITH {_COLUMN_ROWS} SELECT concept_id, ordinal, name, type, coalesce(pk, false) AS pk, coalesce(NOT pk, false) AS nullable, comment FROM cols")
def parse_columns(spark, sf):
    return docs.parse_columns(parsed(spark, sf)).select("concept_id", "ordinal", "name", "type", "pk", "nullable", "comment")


_NATION_STATS = """SELECT c_nationkey AS k, count(*) AS n, CAST(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS weak, count(DISTINCT c_mktsegment) AS d,
    CAST(min(c_custkey) AS STRING) AS lo, CAST(max(c_custkey) AS STRING) AS hi, min(c_mktsegment) AS slo, max(c_mktsegment) AS shi FROM {customer} GROUP BY c_nationkey"""


@query(f"""SELECT 'nations/' || CAST(k AS STRING) AS concept_id, 'c_custkey' AS "column", n AS non_null, CAST(0 AS BIGINT) AS nulls, n AS "distinct", lo AS "min", hi AS "max", '' AS semantic FROM ({_NATION_STATS})
    UNION ALL SELECT 'nations/' || CAST(k AS STRING), 'c_mktsegment', n - weak, weak, d, slo, shi, 'enum' FROM ({_NATION_STATS})""")
def parse_profile(spark, sf):
    return docs.parse_profiles(parsed(spark, sf)).select("concept_id", "column", "non_null", "nulls", "distinct", "min", "max", "semantic")


@query(f"WITH {V1}, {LINKS} SELECT source_id, target_id, n FROM links WHERE source_id IN (SELECT concept_id FROM v1)")
def resolve_links(spark, sf):
    """Occurrences per pair of documents, targets resolved (existing or not)."""
    return docs.resolved_links(parsed(spark, sf)).groupBy("source_id", "target_id").agg(F.count("*").alias("n"))


@query(f"""SELECT 'parts/' || {_P} AS concept_id, k.number, CASE WHEN k.number = 1 THEN 'spec' ELSE 'brand page' END AS text,
    CASE WHEN k.number = 1 THEN 'https://example.com/parts/' || {_P} || '.html' ELSE '../brands/' || replace(p_brand, '#', '-') || '.md?v=1' END AS target
    FROM {{part}}, (VALUES (1), (2)) k(number) WHERE p_size > 45""")
def citations(spark, sf):
    return docs.citations(parsed(spark, sf)).select("concept_id", "number", "text", "target")


@query("""SELECT doc_id, len(regexp_extract_all(text, '(?m)^[ \\t]*#{{1,2}} [ \\t]*[^ \\t\\n]')) AS headings FROM {documents}""")
def document_headings(spark, sf):
    """Headings in whole raw texts."""
    return table(spark, sf, "documents").select("doc_id", F.size(md.headings(F.col("text"))).cast("bigint").alias("headings"))


@query(f"WITH {V1} SELECT concept_id || '.md' AS path FROM v1 WHERE tag = 'supplier' OR (tag = 'customer' AND body LIKE '%MACHINERY%')")
def keyword_search(spark, sf):
    found = docs.keyword_search(star.bundle(spark, sf), r"(?m)^type: Supplier$|segments/MACHINERY|Segment .* MACHINERY")
    return found.select("path")


@query(f"""SELECT page_id, 'tables/' || regexp_replace(path, '\\.csv$', '') || '.md' AS concept, path || '.md' AS file_concept,
    CASE WHEN strpos(path, '/') = 0 THEN '' ELSE regexp_replace(path, '/[^/]*$', '') END AS dir, regexp_extract(path, '[^/]*$') AS base FROM ({_PATHS})""")
def path_mapping(spark, sf):
    path = F.col("path")
    return star.run_sql(spark, sf, _PATHS).select(
        "page_id", pt.csv_concept_path(path).alias("concept"), pt.concept_path("file", path).alias("file_concept"),
        pt.parent_dir(path).alias("dir"), pt.base_name(path).alias("base"))


_TEXT_ROWS = """SELECT p_partkey, p_name || chr(13) || chr(10) || '|' || p_brand || ' it''s ' AS raw, 'mongodb://u' || CAST(p_size AS STRING) || ':p@host/' || p_type AS uri FROM {part}"""


@query(f"""SELECT p_partkey, trim(replace(replace(raw, chr(13) || chr(10), ' '), '|', chr(92) || '|')) AS cell,
    trim(regexp_replace(lower(trim(raw)), '[^a-z0-9]+', '-', 'g'), '-') AS slug, regexp_replace(uri, '://[^/@]*@', '://') AS clean,
    regexp_extract(uri, '[^/]*$') AS ref, replace(raw, '''', '''''') AS literal, floor(p_partkey / 3.0 * 10 + 0.5) / 10 AS third FROM ({_TEXT_ROWS})""")
def text_functions(spark, sf):
    raw, uri = F.col("raw"), F.col("uri")
    return star.run_sql(spark, sf, _TEXT_ROWS).select(
        "p_partkey", tx.sanitize_cell(raw).alias("cell"), tx.slugify(raw).alias("slug"), tx.strip_credentials(uri).alias("clean"),
        tx.ref_name(uri).alias("ref"), tx.quote_literal(raw).alias("literal"), tx.round1(F.col("p_partkey") / 3.0).alias("third"))


# ============================================================== audit


@query(f"WITH {V1}, {LINKS} SELECT source_id, target_id FROM links WHERE target_id NOT IN (SELECT concept_id FROM v1)")
def broken_links(spark, sf):
    return audit.broken_links(v1(spark, sf, "body")).select("source_id", "target_id")


@query(f"WITH {V1}, {LINKS}, {WORKING}, {DEGREE} SELECT concept_id, degree FROM degree")
def link_degree(spark, sf):
    return audit.link_degree(v1(spark, sf, "body")).select("concept_id", "degree")


@query(f"WITH {V1}, {LINKS}, {WORKING}, {DEGREE} SELECT concept_id FROM v1 WHERE concept_id NOT IN (SELECT concept_id FROM degree)")
def orphans(spark, sf):
    return audit.orphans(v1(spark, sf, "body")).select("concept_id")


@query(f"WITH {V1}, {LINKS}, {WORKING}, {DEGREE} SELECT concept_id, coalesce(degree, 0) AS degree FROM v1 LEFT JOIN degree USING (concept_id) WHERE {PLACEHOLDER}")
def enrich_first(spark, sf):
    return audit.enrich_first(v1(spark, sf, "description", "body")).select("concept_id", "degree")


_COVERAGE = f"""coverage AS (SELECT total_concepts, placeholders, total_concepts - placeholders AS enriched_concepts,
    floor(1000.0 * (total_concepts - placeholders) / total_concepts + 0.5) / 10 AS enriched_pct, columns_total, columns_commented,
    floor(1000.0 * columns_commented / columns_total + 0.5) / 10 AS columns_commented_pct FROM (
      SELECT (SELECT count(*) FROM v1) AS total_concepts, (SELECT count(*) FROM v1 WHERE {PLACEHOLDER}) AS placeholders,
        (SELECT count(*) FROM cols WHERE pk IS NOT NULL) AS columns_total, (SELECT count(*) FROM cols WHERE pk IS NOT NULL AND comment <> '') AS columns_commented) t)"""


@query(f"WITH {V1}, {_COLUMN_ROWS}, {_COVERAGE} SELECT * FROM coverage")
def coverage(spark, sf):
    return audit.coverage(v1(spark, sf, "description", "body")).drop("bundle")


@query(f"WITH {_COLUMN_ROWS} SELECT concept_id, count(*) AS columns_total, count(*) FILTER (WHERE comment <> '') AS columns_commented FROM cols WHERE pk IS NOT NULL GROUP BY concept_id")
def comment_coverage(spark, sf):
    return docs.comment_stats(parsed(spark, sf)).drop("bundle")


_FINDINGS = f"""findings AS (
    SELECT 'parts/' || {_P} || '.md' AS path, 'concept-unparseable' AS rule, 'concept has no parseable YAML frontmatter: missing frontmatter boundaries' AS detail FROM {{part}} WHERE p_size = 1
    UNION ALL SELECT 'customers/' || {_C} || '.md', 'concept-missing-type', 'concept frontmatter has an empty `type`' FROM {{customer}} WHERE c_nationkey = 7
    UNION ALL SELECT 'index.md', 'root-index-extra-keys', 'root index.md frontmatter must contain only format_version (found "' || k.name || '")' FROM {{region}}, (VALUES ('owner'), ('title')) k(name) WHERE r_regionkey = 0
    UNION ALL SELECT 'index.md', 'root-index-format-version', 'root index.md frontmatter is missing format_version' FROM {{region}} WHERE r_regionkey = 0
    UNION ALL SELECT 'nations/' || {_N} || '/index.md', 'subdir-index-frontmatter', 'subdirectory index.md must not carry frontmatter' FROM {{nation}} WHERE n_regionkey = 1 AND n_nationkey <> 3)"""


@query(f"WITH {_FINDINGS} SELECT * FROM findings")
def findings(spark, sf):
    reserved = docs.reserved_files(star.reserved(spark, sf))
    return audit.findings(v1(spark, sf), reserved).drop("bundle")


_REPORT = f"""WITH {V1}, {LINKS}, {WORKING}, {DEGREE}, {_COLUMN_ROWS}, {_COVERAGE}, {_FINDINGS}, report AS (SELECT coverage.*,
    (SELECT count(*) FROM findings WHERE rule <> 'concept-missing-type') AS structural, (SELECT count(*) FROM findings WHERE rule = 'concept-missing-type') AS missing_types,
    (SELECT count(*) FROM links WHERE target_id NOT IN (SELECT concept_id FROM v1)) AS broken_links,
    (SELECT count(*) FROM v1 WHERE concept_id NOT IN (SELECT concept_id FROM degree)) AS orphans FROM coverage)"""


def _report(spark: SparkSession, sf: str) -> DataFrame:
    return audit.report(v1(spark, sf, "path", "type", "description", "body"), docs.reserved_files(star.reserved(spark, sf)))


@query(_REPORT + " SELECT * FROM report")
def audit_report(spark, sf):
    return _report(spark, sf).drop("bundle")


@query(_REPORT + """ SELECT 'conformance' AS gate, structural || ' spec-conformance violation(s)' AS detail FROM report WHERE structural > 0
    UNION ALL SELECT 'types', missing_types || ' concept(s) missing a type' FROM report WHERE missing_types > 0
    UNION ALL SELECT 'broken-links', broken_links || ' broken cross-link(s) (max 5)' FROM report WHERE broken_links > 5
    UNION ALL SELECT 'enriched', printf('%.1f', enriched_pct) || '% enriched < 99.0% required' FROM report WHERE enriched_pct < 99
    UNION ALL SELECT 'orphans', orphans || ' orphan concept(s) with no cross-links' FROM report WHERE orphans > 0""")
def gates(spark, sf):
    return audit.gates(_report(spark, sf), min_pct=99.0, max_broken=5, strict=True).drop("bundle")


# ============================================================== graph

_EDGES = f"""xedges AS (
    SELECT 'customers/' || {_C} AS source, 'nations/' || CAST(c_nationkey AS STRING) AS target, 'references' AS relation, 'c_nationkey' AS label FROM {{customer}}
    UNION ALL SELECT 'customers/' || {_C}, 'nations/' || CAST(c_nationkey AS STRING), 'joins-with', '' FROM {{customer}} WHERE c_acctbal < 0
    UNION ALL SELECT 'suppliers/' || {_S}, 'nations/' || CAST(s_nationkey AS STRING), 'references', 's_nationkey' FROM {{supplier}} WHERE s_nationkey IN (SELECT c_nationkey FROM {{customer}})
    UNION ALL SELECT 'nations/' || {_N}, 'regions/' || CAST(n_regionkey AS STRING), 'references', 'n_regionkey' FROM {{nation}} WHERE n_nationkey IN (SELECT c_nationkey FROM {{customer}})
    UNION ALL SELECT 'parts/' || {_P}, 'brands/' || replace(p_brand, '#', '-'), 'joins-with', '' FROM {{part}} WHERE p_size >= 10
    UNION ALL SELECT 'parts/' || {_P}, 'brands/' || replace(p_brand, '#', '-'), '', '' FROM {{part}} WHERE p_size > 45)"""
_DIRS = "dirs AS (SELECT DISTINCT regexp_replace(concept_id, '/.*$', '') AS dir FROM v1)"
_ALL_EDGES = f"""edges AS (SELECT source, target, 'crosslink' AS kind, relation, label FROM xedges
    UNION ALL SELECT regexp_replace(concept_id, '/.*$', ''), concept_id, 'containment', '', '' FROM v1
    UNION ALL SELECT '__root__', dir, 'containment', '', '' FROM dirs)"""
_GRAPH = f"WITH {V1}, {_EDGES}, {_DIRS}, {_ALL_EDGES}"


@query(f"""WITH {V1}, {_DIRS} SELECT concept_id AS id, 'concept' AS kind, type, title, description, 'star,' || tag AS tags, regexp_replace(concept_id, '/.*$', '') AS dir FROM v1
    UNION ALL SELECT dir, 'directory', '', dir, '', '', '' FROM dirs UNION ALL SELECT '__root__', 'root', '', 'Star Catalog', '', '', ''""")
def graph_nodes(spark, sf):
    nodes = graph.graph_nodes(v1(spark, sf), docs.reserved_files(star.reserved(spark, sf)))
    return nodes.select("id", "kind", "type", "title", "description", flat("tags"), "dir")


@query(_GRAPH + " SELECT source, target, kind, relation, label FROM edges")
def graph_edges(spark, sf):
    return graph.sort_edges(graph.graph_edges(v1(spark, sf, *NODE, "body"))).drop("bundle")


@query(_GRAPH + " SELECT id, count(*) AS degree FROM (SELECT source AS id FROM edges UNION ALL SELECT target FROM edges) e GROUP BY id")
def graph_degree(spark, sf):
    return graph.graph_degree(graph.graph_edges(v1(spark, sf, *NODE, "body"))).drop("bundle")


@query(_GRAPH + " SELECT DISTINCT relation FROM xedges")
def relation_facet(spark, sf):
    return graph.relation_facet(graph.graph_edges(v1(spark, sf, *NODE, "body")))


@query(_GRAPH + " SELECT source, target, kind, relation FROM edges WHERE kind = 'containment' OR relation = 'joins-with'")
def relation_filter(spark, sf):
    return graph.filter_relations(graph.graph_edges(v1(spark, sf, *NODE, "body")), ["joins-with"]).select("source", "target", "kind", "relation")


@query(f"WITH {V1} SELECT concept_id AS id, type FROM v1 WHERE type IN ('', 'Nation', 'Brand')")
def type_facet(spark, sf):
    return graph.filter_types(graph.concept_nodes(parsed(spark, sf)), ["Nation", "Brand"]).select("id", "type")


@query(f"WITH {V1} SELECT regexp_replace(concept_id, '/.*$', '') AS dir, count(*) AS concepts FROM v1 GROUP BY 1")
def directory_clusters(spark, sf):
    return graph.directory_clusters(graph.graph_nodes(v1(spark, sf))).drop("bundle")


@query(f"""WITH {V1}, {_EDGES}, {_COLUMN_ROWS} SELECT concept_id, name, type, coalesce(pk, false) AS pk, (concept_id, name) IN (SELECT (source, label) FROM xedges WHERE relation = 'references') AS fk FROM cols""")
def er_view(spark, sf):
    return graph.er_columns(v1(spark, sf, "body")).select("concept_id", "name", "type", "pk", "fk")


@query(f"WITH {_EDGES} SELECT source, target, label FROM xedges WHERE relation = 'references'")
def er_edges(spark, sf):
    return graph.er_edges(v1(spark, sf)).drop("bundle")


_BOTH = "both_ways AS (SELECT source AS a, target AS b FROM edges UNION SELECT target, source FROM edges)"


@query(_GRAPH + f""", {_BOTH}, h0 AS (SELECT 'brands/Brand-1' AS id), h1 AS (SELECT DISTINCT b AS id FROM both_ways JOIN h0 ON a = id),
    h2 AS (SELECT DISTINCT b AS id FROM both_ways JOIN h1 ON a = id)
    SELECT id, min(hop) AS hop FROM (SELECT id, 0 AS hop FROM h0 UNION ALL SELECT id, 1 FROM h1 UNION ALL SELECT id, 2 FROM h2) x GROUP BY id""")
def n_hop(spark, sf):
    """Two hops around a brand, over links and directories."""
    seeds = spark.createDataFrame([(star.BUNDLE, "brands/Brand-1")], "bundle string, id string")
    return graph.n_hop(graph.graph_edges(v1(spark, sf, *NODE, "body")), seeds, 2).drop("bundle")


@query("""SELECT k.step, k.id FROM {customer} c JOIN {nation} ON c_nationkey = n_nationkey,
    LATERAL (VALUES (0, 'customers/1'), (1, 'nations/' || CAST(n_nationkey AS STRING)), (2, 'regions/' || CAST(n_regionkey AS STRING))) k(step, id) WHERE c_custkey = 1""")
def shortest_path(spark, sf):
    """From a customer to the region of its nation."""
    region = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).where("c_custkey = 1")
    end = f"regions/{region.first()['n_regionkey']}"
    return graph.shortest_path(graph.graph_edges(v1(spark, sf, *NODE, "body")), star.BUNDLE, "customers/1", end)


@query(_GRAPH + " SELECT source, target, kind, relation FROM edges WHERE (source LIKE 'nations%' OR source LIKE 'regions%') AND (target LIKE 'nations%' OR target LIKE 'regions%')")
def subgraph(spark, sf):
    c = v1(spark, sf, *NODE, "body")
    nodes, edges = graph.graph_nodes(c), graph.graph_edges(c)
    ids = nodes.where("id RLIKE '^(nations|regions)'")
    return graph.subgraph(nodes, edges, ids)[1].select("source", "target", "kind", "relation")


_PAIRS_OF_NODES = "SELECT 'customers/' || CAST(c_custkey AS STRING) AS start, 'nations/' || CAST((c_custkey * 7) % 25 AS STRING) AS finish FROM {customer} WHERE c_custkey <= 100"


def _paths_sql(hops: int) -> str:
    """Layers around each start, then the way back from each end, a step at a time."""
    layers = [f"l0 AS (SELECT DISTINCT start, start AS id, CAST(NULL AS STRING) AS parent, 0 AS hop FROM ({_PAIRS_OF_NODES}))", "s0 AS (SELECT * FROM l0)"]
    for k in range(1, hops + 1):
        layers += [f"l{k} AS (SELECT l.start, b AS id, min(a) AS parent, {k} AS hop FROM l{k - 1} l JOIN both_ways ON a = l.id LEFT JOIN s{k - 1} s ON s.start = l.start AND s.id = b WHERE s.id IS NULL GROUP BY l.start, b)",
                   f"s{k} AS (SELECT * FROM s{k - 1} UNION ALL SELECT * FROM l{k})"]
    back = [f"p0 AS (SELECT p.start, p.finish, s.hop AS step, s.id, s.parent FROM ({_PAIRS_OF_NODES}) p JOIN s{hops} s ON s.start = p.start AND s.id = p.finish)"]
    back += [f"p{k} AS (SELECT p.start, p.finish, s.hop AS step, s.id, s.parent FROM p{k - 1} p JOIN s{hops} s ON s.start = p.start AND s.id = p.parent)" for k in range(1, hops + 1)]
    rows = " UNION ALL ".join(f"SELECT start, finish, step, id FROM p{k}" for k in range(hops + 1))
    return _GRAPH + ", " + ", ".join([_BOTH, *layers, *back]) + " " + rows


@query(_paths_sql(5))
def shortest_paths(spark, sf):
    """From a hundred customers to a nation each, by links and directories."""
    pairs = star.run_sql(spark, sf, _PAIRS_OF_NODES).select(F.lit(star.BUNDLE).alias("bundle"), "start", F.col("finish").alias("end"))
    return graph.shortest_paths(graph.graph_edges(v1(spark, sf, *NODE, "body")), pairs).select("start", F.col("end").alias("finish"), "step", "id")


@query(f"""WITH RECURSIVE {V1},
  walk AS (
    SELECT concept_id AS id, lower(concept_id || ' ' || title || ' ' || type || ' star ' || tag) AS text, 0 AS k, 1 AS pos, 0 AS score, 0 AS streak, 0 AS first FROM v1
    UNION ALL SELECT id, text, k + 1, pos + hop, score + CASE WHEN hop = 1 THEN 6 + streak ELSE 1 END, CASE WHEN hop = 1 THEN streak + 1 ELSE 0 END,
      CASE WHEN first = 0 THEN pos + hop - 1 ELSE first END
    FROM (SELECT *, strpos(substr(text, pos), substr('s1st', k + 1, 1)) AS hop FROM walk WHERE k < 4) WHERE hop > 0)
  SELECT '{star.BUNDLE}' AS bundle, id, CAST(score + CASE WHEN first = 1 THEN 10 ELSE 0 END AS INTEGER) AS score FROM walk WHERE k = 4""")
def fuzzy_search(spark, sf):
    """Ranked subsequence search over all concepts."""
    return graph.fuzzy_search(graph.concept_nodes(parsed(spark, sf)), "s1st")


_DIFF = f"""WITH {V1}, {V2} SELECT coalesce(n.concept_id, o.concept_id) AS id, coalesce(n.title, o.title) AS title,
    CASE WHEN o.concept_id IS NULL THEN 'added' WHEN n.concept_id IS NULL THEN 'removed' WHEN n.hash <> o.hash THEN 'changed' ELSE '' END AS diff
    FROM v2 n FULL JOIN v1 o ON n.concept_id = o.concept_id"""


@query(_DIFF)
def graph_diff(spark, sf):
    return graph.diff_nodes(parsed(spark, sf, 2), parsed(spark, sf, 1)).select("id", "title", "diff")


_EDGES2 = f"""edges2 AS (SELECT source, target, 'crosslink' AS kind, relation FROM xedges WHERE source IN (SELECT concept_id FROM v2)
    UNION ALL SELECT 'customers/' || {_C}, 'segments/MACHINERY', 'crosslink', 'see-also' FROM {{customer}} WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT regexp_replace(concept_id, '/.*$', ''), concept_id, 'containment', '' FROM v2
    UNION ALL SELECT DISTINCT '__root__', regexp_replace(concept_id, '/.*$', ''), 'containment', '' FROM v2)"""


@query(_GRAPH + f", {V2}, {_EDGES2}" + """ SELECT coalesce(n.source, o.source) AS source, coalesce(n.target, o.target) AS target, coalesce(n.kind, o.kind) AS kind,
    coalesce(n.relation, o.relation) AS relation, CASE WHEN o.source IS NULL THEN 'added' WHEN n.source IS NULL THEN 'removed' ELSE '' END AS diff
    FROM edges2 n FULL JOIN edges o ON n.source = o.source AND n.target = o.target AND n.kind = o.kind AND n.relation = o.relation""")
def graph_diff_edges(spark, sf):
    edges = graph.diff_edges(graph.graph_edges(v2(spark, sf, *NODE, "body")), graph.graph_edges(v1(spark, sf, *NODE, "body")))
    return edges.select("source", "target", "kind", "relation", "diff")


@query(_GRAPH + f""", {V2}, {_EDGES2} SELECT bundle, count(*) AS edges, count(DISTINCT source) AS sources, min(source) AS first_source, max(target) AS last_target FROM (
    SELECT 'one' AS bundle, 'one:' || source AS source, 'one:' || target AS target FROM edges UNION ALL SELECT 'two', 'two:' || source, 'two:' || target FROM edges2) f GROUP BY bundle""")
def federate(spark, sf):
    a, b = v1(spark, sf, *NODE, "body"), v2(spark, sf, *NODE, "body")
    _, edges = graph.federate([("one", graph.graph_nodes(a), graph.graph_edges(a)), ("two", graph.graph_nodes(b), graph.graph_edges(b))])
    return edges.groupBy("bundle").agg(F.count("*").alias("edges"), F.countDistinct("source").alias("sources"),
                                       F.min("source").alias("first_source"), F.max("target").alias("last_target"))


@query(f"""WITH {V1}, {V2} SELECT 'one:' || concept_id AS id, 'one' AS bundle, 'one:' || regexp_replace(concept_id, '/.*$', '') AS dir FROM v1
    UNION ALL SELECT 'two:' || concept_id, 'two', 'two:' || regexp_replace(concept_id, '/.*$', '') FROM v2""")
def federate_nodes(spark, sf):
    a, b = parsed(spark, sf, 1), parsed(spark, sf, 2)
    nodes, _ = graph.federate([("one", graph.concept_nodes(a), graph.graph_edges(a)), ("two", graph.concept_nodes(b), graph.graph_edges(b))])
    return nodes.select("id", "bundle", "dir")


# ============================================================== merge

_NOTES = "chr(10) || '# Notes' || chr(10) || chr(10) || 'Key account.' || chr(10)"
_MERGED = f"""merged AS (SELECT n.concept_id, n.title, CASE WHEN o.concept_id IS NULL THEN 'Creation' WHEN o.hash = n.hash THEN '' ELSE 'Update' END AS change,
    CASE WHEN o.description <> '' THEN o.description WHEN o.hash = n.hash THEN o.description ELSE n.description END AS description, n.tag, n.hash AS content_hash,
    CASE o.enriched WHEN 'current' THEN o.hash WHEN 'stale' THEN 'older' ELSE '' END AS enriched_against,
    n.body || CASE WHEN o.noted THEN {_NOTES} ELSE '' END AS body FROM v2 n LEFT JOIN v1 o ON n.concept_id = o.concept_id)"""


def _fresh(spark: SparkSession, sf: str) -> DataFrame:
    """Version 2 as a connector would produce it: no hash, no enrichment marker, its own description."""
    produced = docs.readable(v2(spark, sf))
    return produced.select("bundle", "concept_id", "path", "type", "title", "description", "resource",
                           F.array_append("tags", "fresh").alias("tags"), F.lit("2024-02-02T00:00:00Z").alias("timestamp"), "body")


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_concepts(v1(spark, sf), _fresh(spark, sf))


@query(f"""WITH {V1}, {V2}, {_MERGED} SELECT concept_id, change, description, content_hash, enriched_against, md5(body) AS body,
    CASE change WHEN '' THEN 'star,' || tag WHEN 'Creation' THEN 'star,' || tag || ',fresh' ELSE CASE WHEN tag < 'fresh' THEN tag || ',fresh,star' ELSE 'fresh,' || tag || ',star' END END AS tags,
    CASE WHEN change = '' THEN '2024-01-01T00:00:00Z' ELSE '2024-02-02T00:00:00Z' END AS timestamp FROM merged""")
def merge_concepts(spark, sf):
    return _merged(spark, sf).select("concept_id", "change", "description", "content_hash", "enriched_against",
                                     F.md5("body").alias("body"), flat("tags"), "timestamp")


_LOG = f"""WITH {V1}, {V2}, {_MERGED} SELECT '2024-02-02' AS date, concept_id, change AS kind,
    CASE WHEN change = 'Creation' THEN 'Established' ELSE 'Structure changed for' END || ' [' || title || '](/' || concept_id || '.md).' AS message FROM merged WHERE change <> ''"""


@query(_LOG)
def change_log(spark, sf):
    return merge.log_entries(_merged(spark, sf), "2024-02-02").select("date", "concept_id", "kind", "message")


@query(f"""SELECT part, line FROM (SELECT 1 AS part, '* **' || kind || '**: ' || message AS line FROM ({_LOG}) UNION ALL SELECT DISTINCT 0, '## ' || date FROM ({_LOG}))""")
def log_order(spark, sf):
    lines = merge.log_lines(merge.log_entries(_merged(spark, sf), "2024-02-02"))
    return merge.sort_log(lines).select("part", "line")


@query("""SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([p_type, 'a', ''] || [p_brand, 'a', p_type], lambda x: x <> ''))), ',') AS tags FROM {part}""")
def tag_union(spark, sf):
    a = F.array("p_type", F.lit("a"), F.lit(""))
    b = F.array("p_brand", F.lit("a"), "p_type")
    return table(spark, sf, "part").select("p_partkey", F.array_join(merge.union_tags(a, b), ",").alias("tags"))


@query(f"""WITH {V1} SELECT '- [' || title || '](' || concept_id || '.md) - ' || CASE WHEN description = '' THEN type ELSE description END AS line FROM v1""")
def bundle_index(spark, sf):
    # a table, as sorting looks at its rows twice
    return as_table(merge.index_lines(docs.readable(parsed(spark, sf)))).orderBy("bundle", "concept_id").select("line")


@query(f"""WITH {V1} SELECT concept_id, md5(body) AS body, title, description, 'star,' || tag AS tags FROM v1""")
def render_round_trip(spark, sf):
    """Concepts written as text and read back."""
    fresh = docs.readable(parsed(spark, sf)).withColumn("body", F.regexp_replace("body", r"(?s)\n# Notes\n.*", ""))
    back = docs.parse_concepts(merge.render_concepts(fresh))
    return docs.readable(back).select("concept_id", F.md5("body").alias("body"), "title", "description", flat("tags"))
