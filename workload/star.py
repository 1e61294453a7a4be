"""Inputs derived from the star-schema tables: a document bundle in two versions, relational
catalogs, API specifications and JSON documents. All of them grow with the tables.

The text of a document is written once, in SQL both engines understand, because it is the
*input*. What is computed from it is written twice: by the library from the text, and by the
checking SQL (``workload.oracle``) directly from keys and joins.

Cases in version 1 of the bundle, by the values of a row:

* customers: description is a placeholder when the balance is negative; no type for nation 7;
  segment BUILDING links relatively, HOUSEHOLD with an anchor and to itself, AUTOMOBILE twice,
  MACHINERY to a document that does not exist, FURNITURE to a web site; a negative balance adds
  a Joins section; a balance above 9000 adds a Notes section that is not part of the hash.
* suppliers: blank description when the balance is negative.
* nations: a Data Profile section about their customers.
* parts: no links below size 10, citations above size 45, no frontmatter at size 1, placeholder
  description for PROMO.

Version 2 drops suppliers with a negative balance, adds a document per segment, and gives
customers of segment FURNITURE one more column.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
BUNDLE = "star"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, sql: str, spread: tuple[str, ...] = ()) -> DataFrame:
    """Run SQL whose ``{name}`` placeholders are test tables.

    A file of one row group is read by one task, however much is made of its rows; those of tables named in ``spread`` are rebalanced.
    """
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **{t: df.hint("rebalance") if t in spread else df for t, df in used.items()})


def duck(sql: str) -> str:
    """The same SQL for the checking engine."""
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    sql = sql.replace("{{", "{").replace("}}", "}")
    return sql.replace("sha2(", "sha256(").replace(", 256)", ")")


def _lines(*parts: str) -> str:
    """SQL text expression: each part is an SQL expression, followed by a newline."""
    return " || ".join(f"({p}) || chr(10)" for p in parts)


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_HEAD5 = [_q("# Columns"), _q(""), _q("| Name | Type | Primary Key | Nullable | Comment |"), _q("| --- | --- | --- | --- | --- |")]


def _row5(name: str, kind: str, pk: bool, comment: str = "''") -> str:
    cell = "Yes" if pk else "No"
    null = "No" if pk else "Yes"
    return f"'| {name} | {kind} | {cell} | {null} | ' || {comment} || ' |'"


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _customer(version: int) -> str:
    columns = _HEAD5 + [
        _row5("c_custkey", "bigint", True, _q("Customer key")),
        _row5("c_name", "string", False),
        _row5("c_nationkey", "int", False, "CASE WHEN c_acctbal >= 0 THEN 'Nation of the customer' ELSE '' END"),
        _row5("c_acctbal", "double", False),
        _row5("c_mktsegment", "string", False, "'Segment \\| ' || c_mktsegment".replace("\\", "' || chr(92) || '")),
    ]
    body = _lines(*columns)
    if version == 2:
        body += " || CASE WHEN c_mktsegment = 'FURNITURE' THEN " + _lines(_row5("c_phone", "string", False)) + " ELSE '' END"
    nation = _s("c_nationkey")
    href = (f"CASE c_mktsegment WHEN 'BUILDING' THEN '../nations/' || {nation} || '.md' "
            f"WHEN 'HOUSEHOLD' THEN '/nations/' || {nation} || '.md#columns' ELSE '/nations/' || {nation} || '.md' END")
    fk = f"'- FK on c_nationkey [nation](' || {href} || ')'"
    body += " || " + _lines(_q(""), _q("# Relationships"), _q(""), fk)
    body += f" || CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN {_lines(fk)} ELSE '' END"
    body += " || " + _lines(_q(""), _q("## See Also"), _q(""))
    body += (" || CASE c_mktsegment "
             f"WHEN 'MACHINERY' THEN {_lines(_q('- [segment](/segments/MACHINERY.md)'))} "
             f"WHEN 'FURNITURE' THEN {_lines(_q('- [site](https://example.com/c.md)'))} "
             "WHEN 'HOUSEHOLD' THEN " + _lines(f"'- [self](/customers/' || {_s('c_custkey')} || '.md)'") +
             f" ELSE {_lines(_q('- none'))} END")
    joins = _lines(_q(""), _q("# Joins"), _q(""),
                   f"'- [nation](/nations/' || {nation} || '.md) and [FK](/nations/' || {nation} || '.md)'")
    body += f" || CASE WHEN c_acctbal < 0 THEN {joins} ELSE '' END"
    description = ("CASE WHEN c_acctbal < 0 THEN 'MySQL table ' || c_name ELSE 'Customer of segment ' || c_mktsegment END"
                   if version == 1 else "'MySQL table ' || c_name")
    return f"""SELECT 'customers/' || {_s('c_custkey')} AS concept_id,
        CASE WHEN c_nationkey = 7 THEN '' ELSE 'Customer' END AS type, c_name AS title, {description} AS description,
        'customer' AS tag, {body} AS body, c_acctbal > 9000 AS noted,
        CASE WHEN c_acctbal > 5000 THEN 'current' WHEN c_acctbal > 0 THEN 'stale' ELSE '' END AS enriched
      FROM {{customer}}"""


def _supplier(version: int) -> str:
    body = _lines(*_HEAD5, _row5("s_suppkey", "bigint", True, _q("Supplier key")), _row5("s_name", "string", False),
                  _row5("s_nationkey", "int", False, _q("Nation")), _row5("s_acctbal", "double", False),
                  _q(""), _q("# Relationships"), _q(""),
                  f"'- FK on s_nationkey [nation](/nations/' || {_s('s_nationkey')} || '.md)'")
    description = f"CASE WHEN s_acctbal < 0 THEN '' ELSE 'Supplier in nation ' || {_s('s_nationkey')} END"
    where = "WHERE s_acctbal >= 0" if version == 2 else ""
    return f"""SELECT 'suppliers/' || {_s('s_suppkey')}, 'Supplier', s_name, {description}, 'supplier', {body},
        s_acctbal > 9000, '' FROM {{supplier}} {where}"""


def _nation() -> str:
    number = _s("n")
    body = _lines(*_HEAD5, _row5("n_nationkey", "int", True, _q("Nation key")), _row5("n_name", "string", False),
                  _row5("n_regionkey", "int", False, _q("Region of the nation")),
                  _q(""), _q("# Relationships"), _q(""),
                  f"'- FK on n_regionkey [region](/regions/' || {_s('n_regionkey')} || '.md)'",
                  _q(""), _q("## Data Profile"), _q(""),
                  _q("| Column | Non-Null | Null | Distinct | Min | Max | Semantic |"), _q("| --- | --- | --- | --- | --- | --- | --- |"),
                  f"'| c_custkey | ' || {number} || ' | 0 | ' || {number} || ' | ' || {_s('lo')} || ' | ' || {_s('hi')} || ' |  |'",
                  f"'| c_mktsegment | ' || {_s('n - weak')} || ' | ' || {_s('weak')} || ' | ' || {_s('d')} || ' | ' || slo || ' | ' || shi || ' | enum |'")
    return f"""SELECT 'nations/' || {_s('n_nationkey')}, 'Nation', n_name, 'Nation ' || n_name, 'nation', {body}, false, ''
      FROM {{nation}} JOIN (
        SELECT c_nationkey, count(*) AS n, min(c_custkey) AS lo, max(c_custkey) AS hi, min(c_mktsegment) AS slo,
          max(c_mktsegment) AS shi, count(DISTINCT c_mktsegment) AS d, sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS weak
        FROM {{customer}} GROUP BY c_nationkey) a ON n_nationkey = c_nationkey"""


def _region() -> str:
    body = _lines(*_HEAD5, _row5("r_regionkey", "int", True, _q("Region key")), _row5("r_name", "string", False))
    return f"""SELECT 'regions/' || {_s('r_regionkey')}, 'Region', r_name, 'Region ' || r_name, 'region', {body}, false, '' FROM {{region}}"""


def _part() -> str:
    brand = "replace(p_brand, '#', '-')"
    body = _lines(_q("# Columns"), _q(""), _q("| Name | Type |"), _q("| --- | --- |"), _q("| p_partkey | bigint |"), _q("| p_name | string |"))
    body += " || CASE WHEN p_size >= 10 THEN " + _lines(_q(""), _q("# Joins"), _q(""), f"'- [brand](/brands/' || {brand} || '.md)'") + " ELSE '' END"
    body += " || CASE WHEN p_size > 45 THEN " + _lines(
        _q(""), _q("# Citations"), _q(""), f"'1. [spec](https://example.com/parts/' || {_s('p_partkey')} || '.html)'",
        f"'2. [brand page](../brands/' || {brand} || '.md?v=1)'") + " ELSE '' END"
    description = "CASE WHEN p_type = 'PROMO' THEN 'CSV file ' || p_name ELSE 'Part ' || p_name END"
    return f"""SELECT 'parts/' || {_s('p_partkey')}, 'Part', p_name, {description}, 'part', {body}, false,
        CASE WHEN p_size = 1 THEN 'none' ELSE '' END FROM {{part}}"""


def _brand() -> str:
    body = _lines(_q("# Brand"), _q(""), "'Parts of ' || p_brand || '.'")
    return f"""SELECT DISTINCT 'brands/' || replace(p_brand, '#', '-'), 'Brand', p_brand, 'Brand ' || p_brand, 'brand', {body}, false, '' FROM {{part}}"""


def _segment() -> str:
    body = _lines(_q("# Segment"), _q(""), "'Customers of ' || c_mktsegment || '.'")
    return f"""SELECT DISTINCT 'segments/' || c_mktsegment, 'Segment', c_mktsegment, 'Segment ' || c_mktsegment, 'segment', {body}, false, '' FROM {{customer}}"""


def concepts_sql(version: int) -> str:
    """(concept_id, type, title, description, tag, body, noted, enriched, hash) of a bundle version."""
    kinds = [_customer(version), _supplier(version), _nation(), _region(), _part(), _brand()]
    if version == 2:
        kinds.append(_segment())
    return ("SELECT k.*, sha2(body, 256) AS hash FROM (\n" + "\nUNION ALL\n".join(kinds) + "\n) k")


def bundle_sql(version: int) -> str:
    """(bundle, path, content): the concept files of a bundle version."""
    quote = "'\"' || replace(title, '\"', '\\\"') || '\"'".replace("\\", "' || chr(92) || '")
    front = _lines(
        "'---'", "CASE WHEN type = '' THEN 'type: \"\"' ELSE 'type: ' || type END", f"'title: ' || {quote}",
        "CASE WHEN description = '' THEN 'owner: nobody' ELSE 'description: ' || description END",
        "'resource: star:///' || concept_id", "'tags:'", "'    - star'", "'    - ' || tag",
        "'timestamp: \"2024-01-01T00:00:00Z\"'", "'content_hash: ' || hash",
        "CASE enriched WHEN 'current' THEN 'enriched_against: ' || hash WHEN 'stale' THEN 'enriched_against: older' ELSE 'reviewed: no' END",
        "'---'")
    notes = _lines(_q(""), _q("# Notes"), _q(""), _q("Key account."))
    noted = f"CASE WHEN noted THEN {notes} ELSE '' END" if version == 1 else "''"
    return f"""SELECT '{BUNDLE}' AS bundle, concept_id || '.md' AS path,
      CASE WHEN enriched = 'none' THEN 'Free text about ' || title ELSE {front} || body || {noted} END AS content
    FROM ({concepts_sql(version)}) c"""


def bundle(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    """The files of a bundle version; a few bytes of a row become a document, so rows are dealt out over all tasks first."""
    return run_sql(spark, sf_dir, bundle_sql(version), spread=("customer", "supplier", "part"))


RESERVED_SQL = f"""
    SELECT '{BUNDLE}' AS bundle, 'index.md' AS path,
      '---' || chr(10) || 'owner: ' || r_name || chr(10) || 'title: x' || chr(10) || '---' || chr(10) || '# Star Catalog' || chr(10) AS content
    FROM {{region}} WHERE r_regionkey = 0
    UNION ALL SELECT '{BUNDLE}', 'nations/' || CAST(n_nationkey AS STRING) || '/' || CASE WHEN n_nationkey = 3 THEN 'log.md' ELSE 'index.md' END,
      CASE WHEN n_regionkey = 1 THEN '---' || chr(10) || 'type: Index' || chr(10) || '---' || chr(10) || '# ' || n_name || chr(10)
           ELSE '# ' || n_name || chr(10) END
    FROM {{nation}} WHERE n_regionkey <> 0
"""


def reserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index and log files: a root index with wrong keys, indexes below nations, some with frontmatter."""
    return run_sql(spark, sf_dir, RESERVED_SQL)


# --- JSON documents ---------------------------------------------------------------

EVENT_JSON_SQL = """
    SELECT event_id, event_type,
      '{{"id": ' || CAST(event_id AS STRING) || ', "user": "u' || CAST(user_id AS STRING) || '"' ||
      CASE event_type WHEN 'error' THEN ', "total": "n/a", "code": null' WHEN 'click' THEN ', "total": 1.5, "tags": ["a"]'
        WHEN 'view' THEN ', "total": 2, "nested": {{"k": 1}}' ELSE ', "ok": true' END || '}}' AS doc
    FROM {events}
"""


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, EVENT_JSON_SQL)


# --- relational catalogs: one shop per supplier -------------------------------------


def shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("shop_"), F.col("s_suppkey").cast("string")).alias("schema"), "s_name", "s_acctbal")


def _per_shop(spark: SparkSession, sf_dir: str, fields: str, rows: list[tuple]) -> DataFrame:
    names = fields.split()
    structs = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])
    return shops(spark, sf_dir).select("schema", F.inline(structs))


KEYS = [  # table, constraint, type, columns, positions in the referenced key
    ("users", "users_pk", "PRIMARY KEY", ["id"], None),
    ("users", "users_name", "UNIQUE", ["username"], None),
    ("orders", "orders_pk", "PRIMARY KEY", ["id"], None),
    ("orders", "orders_user", "FOREIGN KEY", ["user_id"], [1]),
    ("product_variants", "variants_pk", "PRIMARY KEY", ["product_id", "sku"], None),
    ("product_variants", "variants_label", "UNIQUE", ["sku", "label"], None),
    ("shipments", "shipments_pk", "PRIMARY KEY", ["id"], None),
    ("shipments", "shipments_variant", "FOREIGN KEY", ["product_id", "sku"], [1, 2]),
]
REFERENCES = [("orders_user", "users_pk"), ("shipments_variant", "variants_pk")]
CHECKS = [("users", "age_check", "age >= 0"), ("users", "name_given", "username IS NOT NULL"), ("orders", "total_check", "(total > 0)")]
INDEXES = [("users", "ix_age", False, "c", ["age"]), ("users", "ux_name", True, "u", ["username"]),
           ("orders", "ix_user_date", False, "c", ["user_id", "order_date"])]


def constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(t, c, k) for t, c, k, _, _ in KEYS] + [(t, c, "CHECK") for t, c, _ in CHECKS]
    return _per_shop(spark, sf_dir, "table constraint type", rows)


def key_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(t, c, col, i + 1, positions[i] if positions else -1)
            for t, c, _, cols, positions in KEYS for i, col in reversed(list(enumerate(cols)))]
    return _per_shop(spark, sf_dir, "table constraint column ordinal position_in_unique", rows)


def referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_shop(spark, sf_dir, "constraint unique_constraint", REFERENCES).withColumn("unique_schema", F.col("schema"))


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_shop(spark, sf_dir, "constraint clause", [(c, e) for _, c, e in CHECKS])


def index_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(t, ix, u, o, col, i + 1) for t, ix, u, o, cols in INDEXES for i, col in reversed(list(enumerate(cols)))]
    return _per_shop(spark, sf_dir, "table index unique origin column position", rows)


def shop_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of every shop: two tables, a view, and an object of the engine itself."""
    base = shops(spark, sf_dir)
    comment = F.when(F.col("s_acctbal") < 0, "; InnoDB free: 4 kB").otherwise(F.concat(F.lit("Orders of "), "s_name", F.lit("; InnoDB free: 4 kB")))
    plain = F.lit(None).cast("string")
    rows = F.array(
        F.struct(F.lit("orders").alias("name"), F.lit("table").alias("kind"), comment.alias("comment"), plain.alias("view_sql")),
        F.struct(F.lit("users").alias("name"), F.lit("table").alias("kind"), F.lit("InnoDB free: 1 kB").alias("comment"), plain.alias("view_sql")),
        F.struct(F.lit("late_orders").alias("name"), F.lit("view").alias("kind"), plain.alias("comment"), F.lit(" SELECT * FROM orders ").alias("view_sql")),
        F.struct(F.lit("sqlite_sequence").alias("name"), F.lit("table").alias("kind"), plain.alias("comment"), plain.alias("view_sql")),
        F.struct(F.lit("sqlitex").alias("name"), F.lit("table").alias("kind"), plain.alias("comment"), plain.alias("view_sql")))
    return base.select("schema", F.inline(rows))


def ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE TABLE text of one table per supplier, with nested parentheses and a bound from the key."""
    key = F.col("s_suppkey").cast("string")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("shop_"), key).alias("schema"), F.lit("users").alias("table"),
        F.concat(F.lit("CREATE TABLE users (id INTEGER, age INTEGER CHECK (age >= 0 AND (age < 150)), checked TEXT, "
                       "name TEXT, CONSTRAINT c CHECK  (length(name) > "), key, F.lit("))")).alias("ddl"))


# --- API specifications: one document per supplier -----------------------------------

def _openapi(old: bool) -> str:
    """A document with every kind of reference: chains, a cycle, missing ones, into other paths; older documents keep parts elsewhere."""
    schema = "#/definitions/" if old else "#/components/schemas/"
    part = lambda section, name: f"#/{section}/{name}" if old else f"#/components/{section}/{name}"
    ref = lambda to: {"$ref": to}
    content = lambda of: {"schema": of} if old else {"content": {"application/json": {"schema": of}}}
    schemas = {
        "Order": {"type": "object", "required": ["id"], "properties": {
            "id": {"type": "integer"}, "customer": ref("#/components/schemas/Customer"),
            "items": {"type": "array", "items": {"type": "array", "items": ref(schema + "Item@NATION")}}, "note": {"type": ["string", "null"]}}},
        "Customer": {"properties": {"name": {"type": "string"}, "any": {}}}, "Item@NATION": {"type": "object"},
        "Purchase": ref(schema + "Buying"), "Buying": ref(schema + "Order"), "Loop": ref(schema + "Pool"), "Pool": ref(schema + "Loop"), "Lost": ref(schema + "Nowhere")}
    limit = {"name": "limit", "in": "query", **({"type": "integer"} if old else {"schema": {"type": "integer"}})}
    parameters = {"Limit": ref(part("parameters", "Page")), "Page": ref(part("parameters", "a~1b%20c")), "a/b c": limit, "Self": ref(part("parameters", "Self"))}
    responses = {"Made": ref(part("responses", "Item")), "Item": content(ref(schema + "Item@NATION"))}
    bodies = {"NewItem": content(ref(schema + "Order"))}
    if old:
        parameters["Body"] = {"name": "b", "in": "body", "schema": ref(schema + "Order")}
        parameters["Form"] = {"name": "f", "in": "formData", "type": "string"}
    used = ["Limit", "Self", "Gone"] + (["Body", "Form"] if old else [])
    post = {"parameters": [ref(part("parameters", p)) for p in used], "responses": {"default": ref(part("responses", "Gone")), "201": ref(part("responses", "Made"))}}
    if not old:
        post["requestBody"] = ref("#/components/requestBodies/NewItem")
    id_type = {"type": "integer"} if old else {"schema": {"type": "integer"}}
    paths = {
        "/orders/{id}": {"parameters": [], "get": {
            "operationId": "getOrder @KEY", "summary": "Get one", "parameters": [{"name": "id", "in": "path", "required": True, **id_type}],
            "responses": {"404": {"description": "none"}, "200": content(ref(schema + "Order"))}}, "post": {"responses": {}}},
        "/items": {"post": post}, "/customers": ref("#/paths/~1clients") if old else ref("#/components/pathItems/Customers")}
    customers = {"get": {"responses": {"200": ref("#/paths/~1orders~1%7Bid%7D/get/responses/200")}}}
    if old:
        paths["/clients"] = customers
        doc = {"swagger": "2.0", "definitions": schemas, "parameters": parameters, "responses": responses, "paths": paths}
    else:
        doc = {"openapi": "3.1.0", "components": {"schemas": schemas, "parameters": parameters, "responses": responses, "requestBodies": bodies,
                                                  "pathItems": {"Customers": customers}}, "paths": paths}
    return json.dumps(doc).replace("{", "{{").replace("}", "}}")


OPENAPI_SQL = f"""
    SELECT 'spec_' || CAST(s_suppkey AS STRING) AS spec,
      REPLACE(REPLACE(CASE WHEN s_acctbal < 0 THEN '{_openapi(True)}' ELSE '{_openapi(False)}' END, '@KEY', CAST(s_suppkey AS STRING)), '@NATION', CAST(s_nationkey AS STRING)) AS content
    FROM {{supplier}}
"""

GRAPHQL_SQL = '''
    SELECT 'sdl_' || CAST(s_suppkey AS STRING) AS spec,
      '# shop' || chr(10) || 'type Query {{ order(id: ID!): Order orders(first: Int = 10): [Order!]! }}' || chr(10) ||
      CASE WHEN s_acctbal < 0 THEN 'type Mutation {{ addOrder(input: OrderInput!): Order! }}' || chr(10) ELSE '' END ||
      '"""An order: with text"""' || chr(10) || 'type Order implements Node @key(fields: "id") {{' || chr(10) || '  id: ID!' || chr(10) || '  buyer: Customer' || chr(10) ||
      '  lines: [Item' || CAST(s_nationkey AS STRING) || '!]! @deprecated(reason: "x")' || chr(10) || '}}' || chr(10) ||
      'type Customer {{ name: String, orders(first: Int): [Order] }}' || chr(10) || 'type Item' || CAST(s_nationkey AS STRING) || ' {{ sku: String! }}' || chr(10) ||
      'input OrderInput {{ status: Status = OPEN }}' || chr(10) || 'enum Status {{ OPEN CLOSED }}' || chr(10) || 'union Thing = Order | Customer' || chr(10) ||
      'interface Node {{ id: ID! }}' || chr(10) || 'directive @limit(max: Int = 3 @deprecated(reason: "no {{"), of: Range = {{low: [1]}}) on FIELD_DEFINITION | OBJECT' || chr(10) ||
      'scalar Day' || chr(10) || 'input Range {{ low: [Int!] = [1, 2], "up to }}" high: Range = {{low: [3], high: {{low: []}}}} @limit(max: 1, of: {{low: [2]}}), day: Day }}' || chr(10) ||
      'extend type Query {{ # none {{' || chr(10) || ' find(in: Range = {{low: [{{a: "]"}}]}}, text: String = "(:" @limit(max: 2), all: [[Int!]!]! = [[1]]): [Thing!] @limit(of: {{low: [1]}})' || chr(10) || '}}' || chr(10) ||
      'extend type Customer @limit {{ type: Kind!, note(in: Range): String }}' || chr(10) || 'enum Kind {{ type input' || chr(10) || '"union X = {{" extend }}' || chr(10) ||
      'extend enum Status {{ HELD }} extend union Thing = Item' || CAST(s_nationkey AS STRING) || ' extend input Late {{ a: Int }}' AS content
    FROM {supplier}
'''


def openapi_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, OPENAPI_SQL)


def graphql_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, GRAPHQL_SQL)
