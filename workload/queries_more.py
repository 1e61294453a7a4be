"""Queries for drift, enrichment, rendering and specifications (see ``workload.queries``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdcatalog.functions import markdown as md
from mdcatalog.functions import paths as pt
from mdcatalog.operators import audit, catalog, docs, drift, enrich, merge, profile, render, specs
from mdcatalog.plans import produce
from mdcatalog.session import as_table

from . import star
from .queries import (
    _C, _COLUMN_ROWS, _REPORT, _NATION_STATS, _P, _S, DEGREE, LINKS, PLACEHOLDER, V1, WORKING, _report, flat, parsed, query, v1,
)
from .star import table

# ============================================================== drift
# The bundle (version 1) against what the tables hold now: suppliers with a negative balance
# are gone, and so are the columns and types of some customers.


def _bundle_tables(spark: SparkSession, sf: str) -> DataFrame:
    return docs.listing(parsed(spark, sf)).where("concept_id RLIKE '^(customers|suppliers)/'").select(
        F.col("concept_id").alias("table"), "description")


def _source_tables(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.concat(F.lit("customers/"), F.col("c_custkey").cast("string")).alias("table"), "c_mktsegment", "c_acctbal")
    suppliers = table(spark, sf, "supplier").where("s_acctbal >= 0").select(
        F.concat(F.lit("suppliers/"), F.col("s_suppkey").cast("string")).alias("table"), F.lit("").alias("c_mktsegment"), F.col("s_acctbal").alias("c_acctbal"))
    return customers.unionByName(suppliers)


def _bundle_columns(spark: SparkSession, sf: str) -> DataFrame:
    return docs.parse_columns(parsed(spark, sf)).where("concept_id RLIKE '^(customers|suppliers)/'").withColumnRenamed("concept_id", "table")


def _source_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns as the source reports them: upper-case names, some missing, some other types and comments."""
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")

    def column(i, name, kind, comment):
        return F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("name"), kind.alias("type"), comment.alias("comment"),
                        F.lit(i > 1).alias("nullable"), F.lit("0" if i == 3 else "").alias("default"), F.lit("").alias("extra"))

    blank = F.lit("")
    rows = F.array(
        column(1, "C_CUSTKEY", F.lit("BIGINT"), F.lit(" Customer key ")),
        column(2, "c_name", F.when(segment == "BUILDING", "varchar(25)").otherwise("string"), blank),
        column(3, "c_nationkey", F.lit("int"), F.lit("Nation of the customer")),
        column(4, "c_acctbal", F.lit("double"), blank),
        column(5, "c_mktsegment", F.lit("string"), F.concat(F.lit("Segment \\| "), segment)))
    present = F.filter(rows, lambda r: ~((r["name"] == "c_acctbal") & (balance < 0)))
    source = _source_tables(spark, sf).where("table LIKE 'customers/%'")
    return source.select("table", F.inline(present))


@query(f"SELECT 'suppliers/' || {_S} AS \"table\" FROM {{supplier}} WHERE s_acctbal < 0")
def drift_tables(spark, sf):
    return drift.missing_tables(_bundle_tables(spark, sf).select("table"), _source_tables(spark, sf))


@query(f"SELECT 'customers/' || {_C} AS \"table\", 'c_acctbal' AS name FROM {{customer}} WHERE c_acctbal < 0")
def drift_columns(spark, sf):
    return drift.missing_columns(_bundle_columns(spark, sf), _source_columns(spark, sf))


@query(f"SELECT 'customers/' || {_C} AS \"table\", 'c_name' AS name, 'string' AS bundle_type, 'varchar(25)' AS source_type FROM {{customer}} WHERE c_mktsegment = 'BUILDING'")
def drift_types(spark, sf):
    return drift.type_mismatches(_bundle_columns(spark, sf), _source_columns(spark, sf))


@query(f"SELECT 'customers/' || {_C} AS \"table\", 'c_nationkey' AS name, '' AS bundle_comment, 'Nation of the customer' AS source_comment FROM {{customer}} WHERE c_acctbal < 0")
def drift_comments(spark, sf):
    return drift.comment_mismatches(_bundle_columns(spark, sf), _source_columns(spark, sf), ignore_case=True)


def _source_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "It's a household").otherwise(F.concat(F.lit(" Customer of segment "), "c_mktsegment"))
    return _source_tables(spark, sf).where("table LIKE 'customers/%'").select("table", text.alias("description"))


_DESCRIPTIONS = f"""SELECT 'customers/' || {_C} AS "table", CASE WHEN c_acctbal < 0 THEN 'MySQL table ' || c_name ELSE 'Customer of segment ' || c_mktsegment END AS bundle_description,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'It''s a household' ELSE 'Customer of segment ' || c_mktsegment END AS source_description FROM {{customer}}"""


@query(f"SELECT * FROM ({_DESCRIPTIONS}) WHERE bundle_description <> source_description")
def drift_descriptions(spark, sf):
    return drift.description_mismatches(_bundle_tables(spark, sf), _source_descriptions(spark, sf))


@query(f"""SELECT 'parts/' || {_P} AS "table", 'p_partkey,p_name' AS bundle_header, 'p_partkey,p_name,p_brand' AS file_header FROM {{part}} WHERE p_size > 45
    UNION ALL SELECT 'parts/' || {_P}, 'p_partkey,p_name', 'p_name,p_partkey' FROM {{part}} WHERE p_size BETWEEN 2 AND 5""")
def header_drift(spark, sf):
    """Files with an added column or another column order."""
    size = F.col("p_size")
    names = (F.when(size > 45, F.array(F.lit("p_partkey"), F.lit("p_name"), F.lit("p_brand")))
             .when(size <= 5, F.array(F.lit("p_name"), F.lit("p_partkey"))).otherwise(F.array(F.lit("p_partkey"), F.lit("p_name"))))
    headers = table(spark, sf, "part").select(F.concat(F.lit("parts/"), F.col("p_partkey").cast("string")).alias("table"), names.alias("names"))
    columns = docs.parse_columns(parsed(spark, sf)).where("concept_id LIKE 'parts/%'").withColumnRenamed("concept_id", "table")
    return drift.header_drift(columns, headers)


@query(f"""SELECT coalesce(b.path, m.path) AS path, coalesce(b.description, m.description) AS description FROM
    (SELECT 'suppliers/' || {_S} AS path, CASE WHEN s_acctbal < 0 THEN '' ELSE 'Supplier in nation ' || CAST(s_nationkey AS STRING) END AS description FROM {{supplier}}
     UNION ALL SELECT 'customers/' || {_C}, CASE WHEN c_acctbal < 0 THEN 'MySQL table ' || c_name ELSE 'Customer of segment ' || c_mktsegment END FROM {{customer}}) b
    FULL JOIN (SELECT 'customers/' || {_C} AS path, 'old' AS description FROM {{customer}} UNION ALL SELECT 'orders/' || o_orderpriority, 'kept' FROM {{orders}} GROUP BY o_orderpriority) m USING (path)""")
def sync_metadata(spark, sf):
    customers = table(spark, sf, "customer").select(F.concat(F.lit("customers/"), F.col("c_custkey").cast("string")).alias("path"), F.lit("old").alias("description"))
    others = table(spark, sf, "orders").select(F.concat(F.lit("orders/"), "o_orderpriority").alias("path"), F.lit("kept").alias("description")).distinct()
    return drift.sync_metadata(customers.unionByName(others), _bundle_tables(spark, sf).withColumnRenamed("table", "path"))


@query(f"""SELECT 'ALTER TABLE `' || "table" || '` COMMENT = ''' || replace(source_description, '''', '''''') || '''' AS sql FROM ({_DESCRIPTIONS}) WHERE bundle_description <> source_description
    UNION ALL SELECT 'COMMENT ON TABLE public.' || "table" || ' IS ''' || bundle_description || '''' FROM ({_DESCRIPTIONS}) WHERE bundle_description <> source_description
    UNION ALL SELECT 'COMMENT ON COLUMN public.customers/' || {_C} || '.c_nationkey IS ''''' FROM {{customer}} WHERE c_acctbal < 0
    UNION ALL SELECT 'ALTER TABLE `customers/' || {_C} || '` MODIFY COLUMN `c_nationkey` int NULL DEFAULT 0  COMMENT ''''' FROM {{customer}} WHERE c_acctbal < 0
    UNION ALL SELECT 'ALTER TABLE `customers/' || {_C} || '` ADD COLUMN `c_acctbal` double' FROM {{customer}} WHERE c_acctbal < 0
    UNION ALL SELECT 'CREATE TABLE `suppliers/' || {_S} || '` (`s_suppkey` bigint NOT NULL PRIMARY KEY, `s_name` string, `s_nationkey` int, `s_acctbal` double)' FROM {{supplier}} WHERE s_acctbal < 0""")
def sync_statements(spark, sf):
    """Statement text for every kind of drift; nothing is executed."""
    # several statements use each
    columns, source, tables = as_table(_bundle_columns(spark, sf)), _source_columns(spark, sf), as_table(_bundle_tables(spark, sf))
    texts = drift.description_mismatches(tables, _source_descriptions(spark, sf))
    swapped = texts.select("table", F.col("source_description").alias("bundle_description"))
    comments = drift.comment_mismatches(columns, source, ignore_case=True)
    missing = drift.missing_tables(tables.select("table"), _source_tables(spark, sf))
    parts = [
        drift.table_comment_statements(swapped, "mysql"), drift.table_comment_statements(texts, "postgresql", "public"),
        drift.column_comment_statements(comments, source, "postgresql", "public"), drift.column_comment_statements(comments, source, "mysql"),
        drift.add_column_statements(drift.missing_columns(columns, source), columns), drift.create_table_statements(missing, columns),
    ]
    out = parts[0].select("sql")
    for p in parts[1:]:
        out = out.unionByName(p.select("sql"))
    return out


@query(f"""SELECT 'customers/' || {_C} AS path, CASE WHEN c_acctbal < 0 THEN 'File Customer ' || {_C} ELSE 'Balance of ' || c_name END AS description FROM {{customer}}""")
def folder_descriptions(spark, sf):
    """Descriptions from folder metadata where there are any, else the connector's default."""
    customers = table(spark, sf, "customer")
    path = F.concat(F.lit("customers/"), F.col("c_custkey").cast("string"))
    files = customers.select(path.alias("path"), F.concat(F.lit("File Customer "), F.col("c_custkey").cast("string")).alias("default"))
    metadata = customers.select(path.alias("path"), F.when(F.col("c_acctbal") < 0, " ").otherwise(F.concat(F.lit("Balance of "), "c_name")).alias("description"))
    return merge.describe(files, metadata).select("path", "description")


# ============================================================== enrichment


@query(f"WITH {V1} SELECT concept_id FROM v1 WHERE enriched = 'current' AND NOT {PLACEHOLDER}")
def skip_set(spark, sf):
    return enrich.skip_set(parsed(spark, sf)).select("concept_id")


@query(f"WITH {V1} SELECT concept_id, regexp_replace(concept_id, '/.*$', '') AS dir FROM v1 WHERE {PLACEHOLDER}")
def enrich_candidates(spark, sf):
    return enrich.candidates(parsed(spark, sf)).select("concept_id", "dir")


@query(f"WITH {V1} SELECT regexp_replace(concept_id, '/.*$', '') AS dir, count(*) AS concepts FROM v1 WHERE {PLACEHOLDER} GROUP BY 1")
def dir_batches(spark, sf):
    return enrich.directory_batches(v1(spark, sf)).drop("bundle")


@query(f"""WITH {V1}, {LINKS}, {WORKING}, {DEGREE}, r AS (SELECT 'customers/' || CAST(o_custkey AS STRING) AS concept_id, count(*) AS row_count FROM {{orders}} GROUP BY o_custkey
    UNION ALL SELECT 'parts/' || CAST(l_partkey AS STRING), count(*) FROM {{lineitem}} GROUP BY l_partkey)
  SELECT concept_id, coalesce(degree, 0) AS degree, row_count FROM v1 LEFT JOIN degree USING (concept_id) LEFT JOIN r USING (concept_id) WHERE {PLACEHOLDER}""")
def triage(spark, sf):
    """Candidates by degree, then by the rows behind them."""
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("row_count")).select(
        F.concat(F.lit("customers/"), F.col("o_custkey").cast("string")).alias("concept_id"), "row_count")
    lines = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("row_count")).select(
        F.concat(F.lit("parts/"), F.col("l_partkey").cast("string")).alias("concept_id"), "row_count")
    counts = orders.unionByName(lines).withColumn("bundle", F.lit(star.BUNDLE))
    return enrich.triage(v1(spark, sf), counts).drop("bundle")


def _contact_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A contact sheet per customer whose column names depend on the segment."""
    named = F.when(F.col("c_mktsegment") == "BUILDING", "home_address").when(F.col("c_mktsegment") == "MACHINERY", "ship_date").otherwise("shipping")
    kind = F.when(F.col("c_acctbal") < 0, "email").otherwise("")
    rows = F.array(
        F.struct(F.lit(1).alias("ordinal"), F.lit("id").alias("name"), F.lit("uuid").alias("semantic")),
        F.struct(F.lit(2).alias("ordinal"), F.lit("contact").alias("name"), kind.alias("semantic")),
        F.struct(F.lit(3).alias("ordinal"), named.alias("name"), F.lit("").alias("semantic")))
    return table(spark, sf, "customer").select(F.lit(star.BUNDLE).alias("bundle"), F.concat(F.lit("customers/"), F.col("c_custkey").cast("string")).alias("concept_id"), F.inline(rows))


@query(f"""SELECT 'customers/' || {_C} AS concept_id, 'pii' AS tag, CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN 'contact,home_address' WHEN c_acctbal < 0 THEN 'contact' ELSE 'home_address' END AS columns
    FROM {{customer}} WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'""")
def pii_tags(spark, sf):
    sheet = _contact_columns(spark, sf)
    return enrich.pii_tags(sheet, sheet.withColumnRenamed("name", "column")).drop("bundle")


@query(f"""WITH {V1} SELECT concept_id, CASE WHEN tag = 'customer' AND description LIKE 'MySQL%' THEN 'customer,pii,star' ELSE 'star,' || tag END AS tags FROM v1""")
def add_tags(spark, sf):
    concepts = v1(spark, sf)
    suggested = docs.readable(concepts).where("description LIKE 'MySQL table%'").select("bundle", "concept_id", F.explode(F.array(F.lit("pii"), F.lit("star"))).alias("tag"))
    return enrich.add_tags(docs.readable(concepts), suggested).select("concept_id", flat("tags"))


@query(f"""SELECT 'shop_' || CAST(s_suppkey AS STRING) AS schema, k."table" FROM {{supplier}}, (VALUES ('members')) k("table") WHERE s_acctbal >= 0""")
def join_tables(spark, sf):
    """A membership table whose extra column, for some shops, is neither key."""
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(pk).alias("pk"), (F.lit(fk) & cond).alias("fk")) for n, pk, fk, cond in [
        ("user_id", True, True, F.lit(True)), ("group_id", True, True, F.lit(True)), ("since", False, True, F.col("s_acctbal") >= 0)]])
    columns = star.shops(spark, sf).select(F.col("schema").alias("bundle"), F.lit("members").alias("concept_id"), F.inline(rows))
    return enrich.join_tables(columns).select(F.col("bundle").alias("schema"), F.col("concept_id").alias("table"))


@query(f"""SELECT 'shop_' || CAST(s_suppkey AS STRING) AS schema, k.*, CASE WHEN s_acctbal < 0 AND k."column" = 'user_id' THEN 'one-to-one' ELSE 'many-to-one' END AS cardinality FROM {{supplier}},
    (VALUES ('orders', 'user_id', 'users', 'id'), ('shipments', 'product_id', 'product_variants', 'product_id'), ('shipments', 'sku', 'product_variants', 'sku')) k("table", "column", ref_table, ref_column)""")
def fk_cardinality(spark, sf):
    fks = catalog.foreign_keys(star.constraints(spark, sf), star.key_columns(spark, sf), star.referential(spark, sf))
    unique = star.shops(spark, sf).where("s_acctbal < 0").select("schema", F.lit("orders").alias("table"), F.lit("user_id").alias("column"))
    return enrich.fk_cardinality(fks, unique)


@query(f"WITH {_COLUMN_ROWS}, g AS (SELECT 'c_acctbal' AS term, 'Balance: ' || max(c_mktsegment) AS definition FROM {{customer}} UNION ALL SELECT 's_nationkey', 'unused') "
       "SELECT concept_id, name, CASE WHEN comment = '' THEN coalesce(definition, '') ELSE comment END AS comment FROM cols LEFT JOIN g ON name = term")
def glossary_fill(spark, sf):
    balance = table(spark, sf, "customer").agg(F.concat(F.lit("Balance: "), F.max("c_mktsegment")).alias("definition")).select(F.lit("c_acctbal").alias("term"), "definition")
    glossary = balance.unionByName(spark.createDataFrame([("s_nationkey", "unused")], "term string, definition string"))
    return enrich.fill_from_glossary(docs.parse_columns(parsed(spark, sf)), glossary).select("concept_id", "name", "comment")


_SCORES = """SELECT source || '-' || CAST(doc_id AS STRING) AS concept, 'grounding' AS dimension, 1 + 3 * quality + toxic AS score FROM {documents} JOIN {labels} USING (doc_id)
    UNION ALL SELECT source || '-' || CAST(doc_id AS STRING), 'specificity', 5 - 2 * toxic FROM {documents} JOIN {labels} USING (doc_id)
    UNION ALL SELECT source || '-' || CAST(doc_id AS STRING), 'conciseness', 3 FROM {documents} JOIN {labels} USING (doc_id)"""


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return star.run_sql(spark, sf, _SCORES)


@query(f"SELECT dimension, avg(score) AS mean, count(*) AS n FROM ({_SCORES}) GROUP BY dimension")
def eval_means(spark, sf):
    return enrich.score_means(_scores(spark, sf))


@query(f"SELECT dimension, avg(score) AS mean, CAST(4.0 AS DOUBLE) AS baseline, 4.0 - avg(score) > 0.5 AS regressed FROM ({_SCORES}) GROUP BY dimension")
def eval_regressions(spark, sf):
    scores = _scores(spark, sf)
    baseline = scores.select("dimension", F.lit(4.0).alias("mean")).distinct()
    return enrich.score_regressions(enrich.score_means(scores), baseline)


@query(f"SELECT DISTINCT concept FROM ({_SCORES}) WHERE dimension IN ('grounding', 'specificity') AND score <= 2")
def eval_redo(spark, sf):
    return enrich.redo_concepts(_scores(spark, sf))


@query(f"SELECT concept, CAST(sum(score) AS BIGINT) AS total FROM ({_SCORES}) GROUP BY concept")
def review_queue(spark, sf):
    return enrich.review_queue(_scores(spark, sf))


@query(f"SELECT concept, dimension, score, CASE WHEN score <= 2 THEN 'low' WHEN score = 3 THEN 'mid' ELSE 'high' END AS actual_band, 'mid' AS band FROM ({_SCORES}) WHERE score <> 3")
def band_check(spark, sf):
    scores = _scores(spark, sf)
    return enrich.band_check(scores, scores.select("concept", "dimension", F.lit("mid").alias("band")))


# ============================================================== rendering

_NL = "chr(10)"


def _table_sql(head: str, line: str, order: str, frame: str, key: str, prefix: str = "''") -> str:
    bars = "| " + " | ".join("---" for _ in head.split("|")[1:-1]) + " |"
    return (f"SELECT {key} AS concept_id, {prefix} || '{head}' || {_NL} || '{bars}' || {_NL} || string_agg({line} || {_NL}, '' ORDER BY {order}) AS text "
            f"FROM {frame} GROUP BY {key}")


@query("WITH " + _COLUMN_ROWS + " " + _table_sql(
    "| Name | Type | Nullable | Comment |", "'| ' || name || ' | ' || type || ' | ' || CASE WHEN coalesce(NOT pk, false) THEN 'Yes' ELSE 'No' END || ' | ' || replace(comment, '|', chr(92) || '|') || ' |'",
    "ordinal", "cols", "concept_id", f"'# Columns' || {_NL} || {_NL}"))
def columns_rendered(spark, sf):
    return render.render_columns(docs.parse_columns(parsed(spark, sf)), "postgresql")


@query(f"""SELECT 'nations/' || CAST(k AS STRING) AS concept_id, '| Column | Non-Null | Null | Distinct | Min | Max | Semantic |' || {_NL} || '| --- | --- | --- | --- | --- | --- | --- |' || {_NL} ||
    '| c_custkey | ' || CAST(n AS STRING) || ' | 0 | ' || CAST(n AS STRING) || ' | ' || lo || ' | ' || hi || ' |  |' || {_NL} ||
    '| c_mktsegment | ' || CAST(n - weak AS STRING) || ' | ' || CAST(weak AS STRING) || ' | ' || CAST(d AS STRING) || ' | ' || slo || ' | ' || shi || ' | enum |' || {_NL} ||
    {_NL} || 'Values:' || {_NL} || '- c_mktsegment ∈ {{{{' || slo || ', ' || shi || '}}}}' || {_NL} AS text FROM ({_NATION_STATS})""")
def profile_rendered(spark, sf):
    found = docs.parse_profiles(parsed(spark, sf))
    values = F.when(F.col("semantic") == "enum", F.array("max", "min")).otherwise(F.array().cast("array<string>"))
    return render.render_profile(found.withColumn("values", values))


def _per_shop_table(head: str, line: str, order: str, values: str) -> str:
    frame = f"{{supplier}}, (VALUES {values}) k(t, a, b, c)"
    key = "'shop_' || CAST(s_suppkey AS STRING) || '/' || t"
    return _table_sql(head, line, order, frame, key)


@query(_per_shop_table("| Name | Type | Definition |", "'| ' || a || ' | ' || b || ' | ' || c || ' |'", "a, b",
                       "('users', 'users_name', 'UNIQUE', 'username'), ('product_variants', 'variants_label', 'UNIQUE', 'sku, label'), "
                       "('users', 'age_check', 'CHECK', 'age >= 0'), ('orders', 'total_check', 'CHECK', '(total > 0)')"))
def constraints_rendered(spark, sf):
    c = star.constraints(spark, sf)
    both = catalog.unique_constraints(c, star.key_columns(spark, sf)).unionByName(catalog.check_constraints(c, star.checks(spark, sf)))
    return render.render_constraints(both.withColumn("concept_id", F.concat_ws("/", "schema", "table")))


@query(_per_shop_table("| Name | Columns | Unique |", "'| ' || a || ' | ' || b || ' | ' || c || ' |'", "a",
                       "('users', 'ix_age', 'age', 'No'), ('users', 'ux_name', 'username', 'Yes'), ('orders', 'ix_user_date', 'user_id, order_date', 'No')"))
def indexes_rendered(spark, sf):
    return render.render_indexes(catalog.indexes(star.index_columns(spark, sf)).withColumn("concept_id", F.concat_ws("/", "schema", "table")))


@query(f"""SELECT schema || '/' || source_id AS source_id, string_agg('- ' || label || ' [' || text || '](' || target || ')' || {_NL}, '' ORDER BY target, label, text) AS text FROM (
    SELECT 'shop_' || CAST(s_suppkey AS STRING) AS schema, k.* FROM {{supplier}}, (VALUES ('tables/orders', 'FK on user_id', '/tables/users.md', 'users'),
    ('tables/shipments', 'FK on product_id', '/tables/product_variants.md', 'product_variants'), ('tables/shipments', 'FK on sku', '/tables/product_variants.md', 'product_variants'))
    k(source_id, label, target, text)) r GROUP BY 1""")
def relationships_rendered(spark, sf):
    fks = catalog.foreign_keys(star.constraints(spark, sf), star.key_columns(spark, sf), star.referential(spark, sf))
    rows = catalog.fk_relationships(fks).withColumn("source_id", F.concat_ws("/", "schema", "source_id"))
    return render.render_relationships(rows)


@query(f"""SELECT c_custkey AS concept_id, '- **Row Count**: ' || CAST(n AS STRING) || {_NL} || '- **Freshness** (`o_orderdate`): ' || lo || ' … ' || hi || {_NL} AS text FROM (
    SELECT o_custkey AS c_custkey, count(*) AS n, CAST(min(o_orderdate) AS STRING) AS lo, CAST(max(o_orderdate) AS STRING) AS hi FROM {{orders}} GROUP BY o_custkey) s""")
def stats_rendered(spark, sf):
    stats = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("concept_id")).agg(
        F.count("*").alias("row_count"), F.lit("o_orderdate").alias("freshness_column"),
        F.min("o_orderdate").cast("string").alias("earliest"), F.max("o_orderdate").cast("string").alias("latest"))
    return render.render_stats(stats)


@query(f"""SELECT 'shop_' || CAST(s_suppkey AS STRING) AS concept_id, '```sql' || {_NL} || 'SELECT * FROM orders' || {_NL} || '```' || {_NL} AS text FROM {{supplier}}""")
def views_rendered(spark, sf):
    return render.render_views(catalog.entities(star.shop_tables(spark, sf)), key="schema").withColumnRenamed("schema", "concept_id")


@query(f"""SELECT '| c_custkey | c_name | c_mktsegment |' || {_NL} || '| --- | --- | --- |' || {_NL} || string_agg('| ' || CAST(c_custkey AS STRING) || ' | ' || c_name || ' | ' || c_mktsegment || ' |' || {_NL}, '' ORDER BY c_custkey) AS text
    FROM (SELECT * FROM {{customer}} ORDER BY c_custkey LIMIT 5) c""")
def sample_rendered(spark, sf):
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    return render.render_sample(profile.sample_rows(table(spark, sf, "customer").select(*columns), 5, ["c_custkey"]), columns, ["c_custkey"])


@query(f"""WITH {V1} SELECT concept_id, md5(CASE tag WHEN 'customer' THEN split_part(body, '## See Also' || {_NL}, 1) || '## See Also' || {_NL} || {_NL} || 'None.' || {_NL} ||
      CASE WHEN body LIKE '%# Joins%' THEN {_NL} || '# Joins' || {_NL} || split_part(body, '# Joins' || {_NL}, 2) || CASE WHEN noted THEN {_NL} || '# Notes' || {_NL} || {_NL} || 'Key account.' || {_NL} ELSE '' END
           WHEN noted THEN {_NL} || '# Notes' || {_NL} || {_NL} || 'Key account.' || {_NL} ELSE '' END
    ELSE body || CASE WHEN noted THEN {_NL} || '# Notes' || {_NL} || {_NL} || 'Key account.' || {_NL} ELSE '' END || {_NL} || '## See Also' || {_NL} || {_NL} || 'None.' || {_NL} END) AS body FROM v1""")
def upsert_section(spark, sf):
    """Replace a section where there is one, append it elsewhere."""
    body = md.upsert_section(F.col("body"), "See Also", F.lit("None.\n\n"))
    return docs.readable(parsed(spark, sf)).select("concept_id", F.md5(body).alias("body"))


@query(f"""WITH {V1} SELECT concept_id, md5(body || CASE WHEN noted THEN {_NL} || '# Notes' || {_NL} || {_NL} || 'Key account.' || {_NL} ELSE '' END ||
    CASE WHEN tag = 'customer' THEN {_NL} || '# Related' || {_NL} || {_NL} || '- x' || {_NL} ELSE '' END) AS body FROM v1""")
def append_section(spark, sf):
    text = F.when(F.col("concept_id").startswith("customers/"), "- x\n").otherwise("")
    return docs.readable(parsed(spark, sf)).select("concept_id", F.md5(md.append_section(F.col("body"), "Related", text)).alias("body"))


_FIELD_ROWS = """SELECT event_type, field, type FROM (SELECT DISTINCT event_type FROM {events}) g, (VALUES ('id', 'number', ''), ('user', 'string', ''), ('total', 'string', 'error'),
    ('code', 'null', 'error'), ('total', 'number', 'click'), ('tags', 'array', 'click'), ('total', 'number', 'view'), ('nested', 'object', 'view'),
    ('ok', 'boolean', 'purchase'), ('ok', 'boolean', 'signup')) f(field, type, only_for) WHERE only_for = '' OR only_for = event_type"""


@query(f"""SELECT 'collections/' || event_type AS concept_id, 'MongoDB Collection' AS type, event_type AS title, 'MongoDB collection ' || event_type AS description,
    'mongodb://host/db/' || event_type AS resource, 'mongodb,collection' AS tags, '# Columns' || {_NL} || {_NL} || '| Name | Type | Presence |' || {_NL} || '| --- | --- | --- |' || {_NL} ||
    string_agg('| ' || field || ' | ' || type || ' | 100% |' || {_NL}, '' ORDER BY field) AS body FROM ({_FIELD_ROWS}) r GROUP BY event_type""")
def collection_concepts(spark, sf):
    """Concepts assembled from the inferred fields of document collections."""
    fields = profile.infer_fields(star.event_documents(spark, sf), "doc", group="event_type").withColumnRenamed("event_type", "collection")
    made = produce.collection_concepts(fields, "mongodb://user:secret@host/db", "2024-01-01T00:00:00Z")
    return made.select("concept_id", "type", "title", "description", "resource", flat("tags"), "body")


@query(f"""SELECT 'shop_' || CAST(s_suppkey AS STRING) AS bundle, 'tables/' || k.name AS concept_id, 'MySQL ' || k.label AS type,
    CASE WHEN k.name = 'orders' AND s_acctbal >= 0 THEN 'Orders of ' || s_name ELSE 'MySQL ' || k.kind || ' ' || k.name END AS description, 'mysql,' || k.kind AS tags,
    '# Columns' || {_NL} || {_NL} || '| Name | Type | Key | Nullable | Default | Extra | Comment |' || {_NL} || '| --- | --- | --- | --- | --- | --- | --- |' || {_NL} ||
    '| id | int | PRI | No |  |  | Key of ' || k.name || ' |' || {_NL} || CASE WHEN k.name = 'orders' THEN {_NL} || '# Relationships' || {_NL} || {_NL} || '- FK on user_id [users](/tables/users.md)' || {_NL} ELSE '' END AS body
    FROM {{supplier}}, (VALUES ('orders', 'table', 'Table'), ('users', 'table', 'Table'), ('late_orders', 'view', 'View')) k(name, kind, label)""")
def table_concepts(spark, sf):
    """Concepts of every shop's tables and views, with their foreign keys."""
    entities = catalog.entities(star.shop_tables(spark, sf), ["orders", "users", "late_orders"])
    name = F.concat_ws("/", "schema", "name")
    entities = entities.withColumn("name", name)
    columns = entities.select(
        F.col("name").alias("table"), F.lit(1).alias("ordinal"), F.lit("id").alias("name"), F.lit("int").alias("type"), F.lit("PRI").alias("key"),
        F.lit(False).alias("nullable"), F.concat(F.lit("Key of "), pt.base_name(F.col("name"))).alias("comment"))
    fks = catalog.foreign_keys(star.constraints(spark, sf), star.key_columns(spark, sf), star.referential(spark, sf))
    links = catalog.fk_relationships(fks).select(
        F.concat_ws("/", "schema", F.regexp_replace("source_id", "^tables/", "")).alias("source_id"), "label", "target", "text")
    made = produce.table_concepts(entities, columns, "mysql", "mysql://host", "t", relationships=render.render_relationships(links))
    parts = F.split("title", "/")
    return made.select(parts[0].alias("bundle"), F.concat(F.lit("tables/"), parts[1]).alias("concept_id"), "type",
                       F.regexp_replace("description", "shop_[0-9]+/", "").alias("description"), flat("tags"), "body")


@query(_REPORT + """ SELECT 'bundle is ' || printf('%.1f', enriched_pct) || '% enriched (placeholders: ' || placeholders || ', broken links: ' || broken_links || ', orphans: ' || orphans ||
    ', conformance: ' || (structural + missing_types) || ')' || chr(10) || '- concepts: ' || total_concepts || ' (' || enriched_concepts || ' enriched, ' || placeholders || ' placeholder)' || chr(10) ||
    '- columns commented: ' || columns_commented || '/' || columns_total || ' (' || printf('%.1f', columns_commented_pct) || '%)' || chr(10) || '- concepts missing type: ' || missing_types || chr(10) ||
    '- orphan nodes (no cross-links): ' || orphans || chr(10) || '- broken cross-links: ' || broken_links || chr(10) AS text FROM report""")
def text_report(spark, sf):
    return audit.text_report(_report(spark, sf)).select("text")


# ============================================================== specifications

_SPEC = "'spec_' || CAST(s_suppkey AS STRING) AS spec"
_ITEM = "'Item' || CAST(s_nationkey AS STRING)"
_COLS3 = f"'# Columns' || {_NL} || {_NL} || '| Name | Type | Required |' || {_NL} || '| --- | --- | --- |' || {_NL}"


@query(f"""SELECT {_SPEC}, 'schemas/Order' AS rel, 'Schema' AS type, 'Order' AS title, {_COLS3} || '| customer | Customer | no |' || {_NL} || '| id | integer | yes |' || {_NL} ||
      '| items | array<array<' || {_ITEM} || '>> | no |' || {_NL} || '| note | string' || chr(92) || '|null | no |' || {_NL} AS body, 'schemas/Customer' AS links FROM {{supplier}}
    UNION ALL SELECT {_SPEC}, 'schemas/' || k.name, 'Schema', k.name, {_COLS3} || '| customer | Customer | no |' || {_NL} || '| id | integer | yes |' || {_NL} ||
      '| items | array<array<' || {_ITEM} || '>> | no |' || {_NL} || '| note | string' || chr(92) || '|null | no |' || {_NL}, 'schemas/Customer' FROM {{supplier}}, (VALUES ('Purchase'), ('Buying')) k(name)
    UNION ALL SELECT {_SPEC}, 'schemas/' || k.name, 'Schema', k.name, {_COLS3}, '' FROM {{supplier}}, (VALUES ('Loop'), ('Pool'), ('Lost')) k(name)
    UNION ALL SELECT {_SPEC}, 'schemas/Customer', 'Schema', 'Customer', {_COLS3} || '| any | object | no |' || {_NL} || '| name | string | no |' || {_NL}, '' FROM {{supplier}}
    UNION ALL SELECT {_SPEC}, 'schemas/' || {_ITEM}, 'Schema', {_ITEM}, {_COLS3}, '' FROM {{supplier}}""")
def openapi_schemas(spark, sf):
    return specs.openapi_schemas(specs.load_specs(star.openapi_specs(spark, sf))).withColumn("links", F.array_join("links", ","))


@query(f"""SELECT {_SPEC}, s.schema, k.name, CASE WHEN k.name = 'items' THEN 'array<array<' || {_ITEM} || '>>' ELSE k.type END AS type, k.required, k.links_to FROM {{supplier}},
    (VALUES ('Order', 'id', 'integer', 'yes', ''), ('Order', 'customer', 'Customer', 'no', 'Customer'), ('Order', 'items', '', 'no', ''), ('Order', 'note', 'string|null', 'no', ''),
     ('Customer', 'name', 'string', 'no', ''), ('Customer', 'any', 'object', 'no', '')) k(schema, name, type, required, links_to),
    (VALUES ('Order', 'Order'), ('Customer', 'Customer'), ('Purchase', 'Order'), ('Buying', 'Order')) s(schema, of) WHERE s.of = k.schema""")
def openapi_properties(spark, sf):
    return specs.openapi_properties(specs.load_specs(star.openapi_specs(spark, sf)))


@query(f"""SELECT {_SPEC}, 'endpoints/getorder-' || CAST(s_suppkey AS STRING) AS rel, 'API Endpoint' AS type, 'GET /orders/{{{{id}}}}' AS title, '# GET /orders/{{{{id}}}}' || {_NL} || {_NL} || 'Get one' || {_NL} || {_NL} ||
      '## Parameters' || {_NL} || {_NL} || '| Name | In | Type | Required |' || {_NL} || '| --- | --- | --- | --- |' || {_NL} || '| id | path | integer | yes |' || {_NL} || {_NL} ||
      '## Responses' || {_NL} || {_NL} || '| Status | Schema |' || {_NL} || '| --- | --- |' || {_NL} || '| 200 | Order |' || {_NL} || '| 404 |  |' || {_NL} || {_NL} AS body, 'schemas/Order' AS links FROM {{supplier}}
    UNION ALL SELECT {_SPEC}, 'endpoints/post-orders-id', 'API Endpoint', 'POST /orders/{{{{id}}}}', '# POST /orders/{{{{id}}}}' || {_NL} || {_NL} || '## Responses' || {_NL} || {_NL} || '| Status | Schema |' || {_NL} || '| --- | --- |' || {_NL} || {_NL}, '' FROM {{supplier}}
    UNION ALL SELECT {_SPEC}, 'endpoints/post-items', 'API Endpoint', 'POST /items', '# POST /items' || {_NL} || {_NL} ||
      '## Parameters' || {_NL} || {_NL} || '| Name | In | Type | Required |' || {_NL} || '| --- | --- | --- | --- |' || {_NL} || '| limit | query | integer | no |' || {_NL} || {_NL} ||
      '## Responses' || {_NL} || {_NL} || '| Status | Schema |' || {_NL} || '| --- | --- |' || {_NL} || '| 201 | ' || {_ITEM} || ' |' || {_NL} || '| default |  |' || {_NL} || {_NL},
      'schemas/' || {_ITEM} || ',schemas/Order' FROM {{supplier}}
    UNION ALL SELECT {_SPEC}, 'endpoints/get-' || k.name, 'API Endpoint', 'GET /' || k.name, '# GET /' || k.name || {_NL} || {_NL} || '## Responses' || {_NL} || {_NL} || '| Status | Schema |' || {_NL} ||
      '| --- | --- |' || {_NL} || '| 200 | Order |' || {_NL} || {_NL}, 'schemas/Order' FROM {{supplier}}, (VALUES ('customers'), ('clients')) k(name) WHERE k.name = 'customers' OR s_acctbal < 0""")
def openapi_endpoints(spark, sf):
    return specs.openapi_endpoints(specs.load_specs(star.openapi_specs(spark, sf))).withColumn("links", F.array_join("links", ","))


@query(f"""SELECT {_SPEC}, 'schemas/Order' AS source_id, 'references' AS label, '/schemas/Customer.md' AS target, 'Customer' AS text FROM {{supplier}}
    UNION ALL SELECT {_SPEC}, k.source, 'references', '/schemas/Customer.md', 'Customer' FROM {{supplier}}, (VALUES ('schemas/Purchase'), ('schemas/Buying')) k(source)
    UNION ALL SELECT {_SPEC}, 'endpoints/getorder-' || CAST(s_suppkey AS STRING), 'references', '/schemas/Order.md', 'Order' FROM {{supplier}}
    UNION ALL SELECT {_SPEC}, k.source, 'references', '/schemas/Order.md', 'Order' FROM {{supplier}},
      (VALUES ('endpoints/post-items'), ('endpoints/get-customers'), ('endpoints/get-clients')) k(source) WHERE k.source != 'endpoints/get-clients' OR s_acctbal < 0
    UNION ALL SELECT {_SPEC}, 'endpoints/post-items', 'references', '/schemas/' || {_ITEM} || '.md', {_ITEM} FROM {{supplier}}""")
def spec_relationships(spark, sf):
    loaded = specs.load_specs(star.openapi_specs(spark, sf))
    return specs.spec_relationships(specs.openapi_schemas(loaded).unionByName(specs.openapi_endpoints(loaded)))


_SDL = "'sdl_' || CAST(s_suppkey AS STRING) AS spec"


def _sdl_type(name: str, body: str, links: str) -> str:
    return f"SELECT {_SDL}, 'types/' || {name} AS rel, 'GraphQL Type' AS type, {name} AS title, {body} AS body, '{links}' AS links FROM {{supplier}}"


@query(" UNION ALL ".join([
    f"SELECT {_SDL}, 'types/Order' AS rel, 'GraphQL Type' AS type, 'Order' AS title, {_COLS3} || '| id | ID! | yes |' || {_NL} || '| buyer | Customer | no |' || {_NL} || '| lines | [' || {_ITEM} || '!]! | yes |' || {_NL} AS body, "
    f"'types/Customer,types/' || {_ITEM} AS links FROM {{supplier}}",
    _sdl_type("'Customer'", f"{_COLS3} || '| name | String | no |' || {_NL} || '| orders | [Order] | no |' || {_NL} || '| type | Kind! | yes |' || {_NL} || '| note | String | no |' || {_NL}", "types/Kind,types/Order"),
    _sdl_type(_ITEM, f"{_COLS3} || '| sku | String! | yes |' || {_NL}", ""),
    _sdl_type("'OrderInput'", f"{_COLS3} || '| status | Status | no |' || {_NL}", "types/Status"),
    _sdl_type("'Node'", f"{_COLS3} || '| id | ID! | yes |' || {_NL}", ""),
    _sdl_type("'Status'", f"'# Values' || {_NL} || {_NL} || '- OPEN' || {_NL} || '- CLOSED' || {_NL} || '- HELD' || {_NL}", ""),
    _sdl_type("'Kind'", f"'# Values' || {_NL} || {_NL} || '- type' || {_NL} || '- input' || {_NL} || '- extend' || {_NL}", ""),
    _sdl_type("'Range'", f"{_COLS3} || '| low | [Int!] | no |' || {_NL} || '| high | Range | no |' || {_NL} || '| day | Day | no |' || {_NL}", "types/Range"),
    _sdl_type("'Late'", f"{_COLS3} || '| a | Int | no |' || {_NL}", ""),
    _sdl_type("'Thing'", f"'# Members' || {_NL} || {_NL} || '- Order' || {_NL} || '- Customer' || {_NL} || '- ' || {_ITEM} || {_NL}", "types/Customer,types/' || " + _ITEM + " || ',types/Order"),
]))
def graphql_types(spark, sf):
    return specs.graphql_types(star.graphql_specs(spark, sf)).withColumn("links", F.array_join("links", ","))


_ARGS = f"{_NL} || '## Arguments' || {_NL} || {_NL} || '| Name | Type | Required |' || {_NL} || '| --- | --- | --- |' || {_NL}"


@query(f"""SELECT {_SDL}, 'queries/order' AS rel, 'GraphQL Query' AS type, 'order' AS title, '# order' || {_NL} || {_NL} || 'Returns `Order`.' || {_NL} || {_ARGS} || '| id | ID! | yes |' || {_NL} AS body, 'types/Order' AS links FROM {{supplier}}
    UNION ALL SELECT {_SDL}, 'queries/orders', 'GraphQL Query', 'orders', '# orders' || {_NL} || {_NL} || 'Returns `[Order!]!`.' || {_NL} || {_ARGS} || '| first | Int | no |' || {_NL}, 'types/Order' FROM {{supplier}}
    UNION ALL SELECT {_SDL}, 'queries/find', 'GraphQL Query', 'find', '# find' || {_NL} || {_NL} || 'Returns `[Thing!]`.' || {_NL} || {_ARGS} || '| in | Range | no |' || {_NL} || '| text | String | no |' || {_NL} ||
      '| all | [[Int!]!]! | yes |' || {_NL}, 'types/Range,types/Thing' FROM {{supplier}}
    UNION ALL SELECT {_SDL}, 'mutations/addorder', 'GraphQL Mutation', 'addOrder', '# addOrder' || {_NL} || {_NL} || 'Returns `Order!`.' || {_NL} || {_ARGS} || '| input | OrderInput! | yes |' || {_NL}, 'types/Order,types/OrderInput' FROM {{supplier}} WHERE s_acctbal < 0""")
def graphql_operations(spark, sf):
    return specs.graphql_operations(star.graphql_specs(spark, sf)).withColumn("links", F.array_join("links", ","))
