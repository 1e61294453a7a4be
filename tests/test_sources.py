import itertools
import os
import random
import re

from pyspark.sql import functions as F

from mdcatalog.operators import catalog, cochange, docs, graph, merge, specs
from mdcatalog.plans import pipelines, produce
from mdcatalog.sources import readers, writers


def write(folder, files):
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, newline="")


def tree(folder):
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(folder) for f in fs if not f.startswith(".")}


def test_csv_quotes_and_discovery(spark, tmp_path):
    write(tmp_path, {"a.csv": 'id,text\n1,"x ""q"", y\nz"\n2\n', "sub/B.CSV": "h\n1\n", "tmp/c.csv": "h\n", "d.txt": ""})
    rows = readers.read_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [(r["id"], r["text"]) for r in rows] == [("1", 'x "q", y\nz'), ("2", None)]
    found = readers.csv_files(spark, str(tmp_path), ["/tmp/"])
    assert [r["path"] for r in found.collect()] == ["a.csv", "sub/B.CSV"]


def test_file_tree(spark, tmp_path):
    write(tmp_path, {"file1.txt": "12345", "sub dir/file2.txt": "x", "ignored.txt": "", ".catalogignore": "# c\n\nignored.txt\n", "meta.yaml": "file1.txt: 'First: file'\n\"sub dir/file2.txt\": Second\n"})
    patterns = readers.read_ignore_patterns(spark, str(tmp_path / ".catalogignore"))
    assert patterns == ["ignored.txt"]
    tree_rows = readers.file_inventory(spark, str(tmp_path), patterns + ["meta.yaml", ".catalogignore"])
    got = {r["path"]: (r["is_dir"], r["size"]) for r in tree_rows.collect()}
    assert got == {"file1.txt": (False, 5), "sub dir/file2.txt": (False, 1), "sub dir": (True, None)}
    known = readers.read_descriptions(spark, str(tmp_path / "meta.yaml"))
    assert {tuple(r) for r in known.collect()} == {("file1.txt", "First: file"), ("sub dir/file2.txt", "Second")}
    assert readers.read_descriptions(spark, str(tmp_path / "none.yaml")).count() == 0
    concepts = {r["concept_id"]: r for r in produce.file_concepts(tree_rows, str(tmp_path), "t", known).collect()}
    assert concepts["file1.txt"]["description"] == "First: file" and concepts["sub dir"]["description"] == "Directory sub dir"
    assert "- **Size**: 5 bytes" in concepts["file1.txt"]["body"]


def test_ignore_rules(spark):
    paths = ["a.log", "x/b.log", "temp/x", "temp", "build/o/p", "src/build", "ok.txt", "logs.txt", ".git/config", "foobar/x", "foo1"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    kept = lambda **k: {r["path"] for r in cochange.drop_ignored(df, ["*.log", "/temp/", "build/", "foo*"], **k).collect()}
    assert kept() == {"src/build", "ok.txt", "logs.txt"}
    assert kept(match_ancestors=False) == {"src/build", "ok.txt", "logs.txt", "foobar/x"}


def brute_pairs(changes, least):
    commits = {}
    for c, p in changes:
        commits.setdefault(c, set()).add(p)
    counts = {}
    for files in commits.values():
        for a, b in itertools.combinations(sorted(files), 2):
            counts[a, b] = counts.get((a, b), 0) + 1
    return {k: n for k, n in counts.items() if n >= least}


def test_cochange_with_large_commits_is_exact(spark):
    rng = random.Random(5)
    files = [f"f{i:02d}" for i in range(30)]
    changes = [(c, p) for c in range(40) for p in rng.sample(files, rng.choice([1, 2, 3, 3, 4, 12, 20]))]
    changes += changes[:50]
    df = spark.createDataFrame(changes, "commit_id int, path string")
    for least, large in [(1, 1000), (2, 1000), (2, 5), (1, 5), (3, 2), (4, 0)]:
        got = {(r["a"], r["b"]): r["n"] for r in cochange.cochange_pairs(df, least, large=large).collect()}
        assert got == brute_pairs(changes, least), (least, large)


def test_related(spark):
    pairs = spark.createDataFrame([("a.go", "b.go", 5), ("a.go", "c.go", 2), ("a.go", "d.go", 1)], "a string, b string, n bigint")
    def of(file, **k):
        return [(r["partner"], r["n"]) for r in cochange.related(pairs, **k).where(F.col("file") == file).orderBy(F.desc("n"), "partner").collect()]
    assert of("a.go") == [("b.go", 5), ("c.go", 2)]
    assert of("a.go", top_n=1) == [("b.go", 5)]
    assert of("a.go", min_count=1, top_n=0) == [("b.go", 5), ("c.go", 2), ("d.go", 1)]
    existing = spark.createDataFrame([("a.go",), ("c.go",)], "path string")
    assert of("a.go", top_n=1, existing=existing) == [("c.go", 2)]
    text = cochange.related_relationships(cochange.related(pairs)).where("source_id = 'a.go' AND text = 'b.go'").first()
    assert (text["label"], text["target"]) == ("co-changed (5x)", "/b.go.md")


def test_ddl_checks(spark):
    ddl = "CREATE TABLE t (a INT CHECK (a > (1)), checked INT, b TEXT check\n( fn_check(b) ), c CHECK (open"
    rows = catalog.ddl_checks(spark.createDataFrame([("s", "t", ddl), ("s", "u", "CREATE TABLE u (x INT)")], "schema string, table string, ddl string")).collect()
    assert [(r["name"], r["definition"]) for r in rows] == [("check_1", "a > (1)"), ("check_2", "fn_check(b)")]


def scanned(ddl):
    """Check expressions by counting parentheses."""
    found, at = [], 0
    while match := re.compile(r"check[ \t\n]*\(", re.I).search(ddl, at):
        depth, end = 1, match.end()
        while end < len(ddl) and depth:
            depth += {"(": 1, ")": -1}.get(ddl[end], 0)
            end += 1
        if depth:
            break
        found.append(ddl[match.end():end - 1].strip())
        at = end
    return found


def test_ddl_checks_equal_a_scan(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["check", "CHECK ", "(", ")", "a", " ", "\n", "b > 1", "uncheck"]) for _ in range(rng.randrange(60))) for _ in range(300)]
    df = spark.createDataFrame([("s", str(i), t) for i, t in enumerate(texts)], "schema string, table string, ddl string")
    got: dict = {}
    found = catalog.ddl_checks(df)
    for r in found.collect():
        got.setdefault(int(r["table"]), {})[r["name"]] = r["definition"]
    assert got == {i: {f"check_{k + 1}": e for k, e in enumerate(scanned(t))} for i, t in enumerate(texts) if scanned(t)}
    assert "Python" not in found._jdf.queryExecution().toString()


OPENAPI = """
openapi: 3.0.0
info: {title: Shop, version: "1"}
paths:
  /orders/{id}:
    get:
      operationId: getOrder
      parameters:
        - {name: id, in: path, required: true, schema: {type: integer}}
      responses:
        "200": {description: ok, content: {application/json: {schema: {$ref: '#/components/schemas/Order'}}}}
components:
  schemas:
    Order: {type: object, required: [id], properties: {id: {type: integer}, customer: {$ref: '#/components/schemas/Customer'}}}
    Customer: {type: object, properties: {name: {type: string}}}
"""


def test_openapi_yaml(spark):
    loaded = specs.load_specs(spark.createDataFrame([("shop.yaml", OPENAPI), ("bad.yaml", "a: [")], "spec string, content string"))
    endpoints = specs.openapi_endpoints(loaded).collect()
    assert [(e["rel"], e["title"], e["links"]) for e in endpoints] == [("endpoints/getorder", "GET /orders/{id}", ["schemas/Order"])]
    assert "| id | path | integer | yes |" in endpoints[0]["body"] and "| 200 | Order |" in endpoints[0]["body"]
    schemas = {s["title"]: s for s in specs.openapi_schemas(loaded).collect()}
    assert schemas["Order"]["links"] == ["schemas/Customer"] and "| id | integer | yes |" in schemas["Order"]["body"]
    made = produce.spec_concepts(specs.openapi_schemas(loaded), "openapi", "t").where("title = 'Order'").first()
    assert made["bundle"] == "shop.yaml" and made["tags"] == ["openapi", "schema"] and made["description"] == "API schema Order"
    assert made["body"].endswith("# Relationships\n\n- references [Customer](/schemas/Customer.md)\n")


def test_graphql_roots_and_kinds(spark):
    sdl = 'schema { query: Root }\n"doc" type Root { order(id: ID!, list: [Int!]): Order }\ntype Order { id: ID! status: Status other: [Order!]! }\nenum Status { A B }\nunion U =\n | Order\n | Missing\nscalar Date'
    df = spark.createDataFrame([("s", sdl)], "spec string, content string")
    types = {t["title"]: t for t in specs.graphql_types(df).collect()}
    assert set(types) == {"Order", "Status", "U"}
    assert types["Order"]["links"] == ["types/Order", "types/Status"] and types["U"]["links"] == ["types/Order"]
    assert types["U"]["body"] == "# Members\n\n- Order\n- Missing\n"
    op = specs.graphql_operations(df).first()
    assert (op["rel"], op["type"]) == ("queries/order", "GraphQL Query") and "| list | [Int!] | no |" in op["body"]


def test_produce_twice_is_byte_identical(spark, tmp_path):
    out = tmp_path / "bundle"
    entities = spark.createDataFrame([("users", "table", ""), ("v", "view", "A view")], "name string, kind string, comment string")
    columns = spark.createDataFrame([("users", 1, "id", "INTEGER", True, False, ""), ("v", 1, "id", "INTEGER", False, True, "")],
                                    "table string, ordinal int, name string, type string, pk boolean, nullable boolean, default string")
    data = {"users": spark.createDataFrame([(1, "a@b.co"), (2, "c@d.org")], "id int, email string")}
    sections = produce.lake_sections(data, {"users": ["id"]}, sample=1)
    def fresh(timestamp):
        return produce.table_concepts(entities, columns, "sqlite", "sqlite:///db", timestamp, bundle="b", sections=sections)
    table = {"log_table": str(tmp_path / "log")}
    log = pipelines.produce(fresh("t1"), str(out), "b", "2024-01-01", **table)
    assert {r["kind"] for r in log.collect()} == {"Creation"} and log.count() == 2
    before = tree(out)
    assert b"SQLite table users" in before["tables/users.md"] and b"| email | 2 | 0 | 2 |" in before["tables/users.md"]
    assert b"## Sample\n\n| id | email |\n| --- | --- |\n| 1 | a@b.co |\n" in before["tables/users.md"]
    again = pipelines.produce(fresh("t2"), str(out), "b", "2024-01-02", run=1, **table)
    assert again.count() == 0 and tree(out) == before
    writers.append_log(log, table["log_table"])  # a repeated run adds nothing twice
    writers.write_log(spark.read.parquet(table["log_table"]), str(out), "b")
    text = (out / "log.md").read_text()
    assert text == ("# Change Log\n\n## 2024-01-01\n\n* **Creation**: Established [v](/tables/v.md).\n* **Creation**: Established [users](/tables/users.md).\n")
    concepts = docs.parse_concepts(readers.read_bundle(spark, str(out), "b"))
    writers.write_index(concepts, str(out), "Shop", "All tables.", "Tables")
    index = (out / "index.md").read_text()
    assert index.startswith('---\nformat_version: "0.1"\n---\n# Shop\n\nAll tables.\n\n## Tables\n\n- [users](tables/users.md) - SQLite table users\n')
    result = pipelines.lint(spark, str(out), "b")
    assert result["findings"].count() == 0 and result["report"].first()["total_concepts"] == 2
    nodes, edges = pipelines.build_graph(spark, str(out), "b")
    assert nodes.where("kind = 'root' AND title = 'Shop'").count() == 1
    writers.write_graph(nodes, edges, str(tmp_path / "graph"), concepts)
    assert spark.read.json(str(tmp_path / "graph" / "documents")).where("size(profile) = 2").count() == 1
    assert spark.read.json(str(tmp_path / "graph" / "edges")).count() == edges.count()


def test_history_concepts(spark):
    files = spark.sql("SELECT 'a.txt' AS path, false AS is_dir, 3L AS size, timestamp'2020-01-01' AS modified UNION ALL SELECT 'b.txt', false, 4L, timestamp'2020-01-02'")
    commits = spark.sql("SELECT 'c1' AS commit_id, 'ann' AS author, timestamp'2021-01-01' AS at, 'first' AS message, 'a.txt' AS path UNION ALL SELECT 'c2', 'bob', timestamp'2022-01-01', 'say \"x\"', 'a.txt'")
    related = spark.createDataFrame([("a.txt", "b.txt", 3)], "file string, partner string, n bigint")
    none = spark.createDataFrame([], "path string, description string")
    got = {r["concept_id"]: r for r in produce.history_concepts(files, commits, "/repo", none, related=related).collect()}
    assert got["a.txt"]["timestamp"] == "2022-01-01T00:00:00Z" and '"say \\"x\\""' in got["a.txt"]["body"]
    assert got["a.txt"]["body"].endswith("# Related Files\n\n- co-changed (3x) [b.txt](/b.txt.md)\n")
    assert "- **Last Modified**: 2020-01-02T00:00:00Z" in got["b.txt"]["body"] and got["b.txt"]["tags"] == ["git", "file"]


def test_collections_and_csv_concepts(spark):
    fields = spark.createDataFrame([("orders", "b", "number", 50), ("orders", "a", "string", 100)], "collection string, field string, type string, presence_pct int")
    c = produce.collection_concepts(fields, "mongodb://u:p@h/db", "t").first()
    assert c["resource"] == "mongodb://h/db/orders" and c["body"].endswith("| a | string | 100% |\n| b | number | 50% |\n")
    types = spark.createDataFrame([("sub/o.csv", "id", 0, "integer"), ("sub/o.csv", "x", 1, "string")], "path string, column string, ordinal int, type string")
    t = produce.csv_concepts(types, "/data", "t", spark.createDataFrame([("sub/o.csv", "Orders")], "path string, description string")).first()
    assert (t["path"], t["title"], t["description"]) == ("tables/sub/o.md", "o", "Orders")


def test_information_schema_frames(spark):
    def read(view):
        names = {"tables": "table_schema table_name table_type", "columns": "table_schema table_name column_name ordinal_position data_type is_nullable column_default",
                 "table_constraints": "table_schema table_name constraint_name constraint_type",
                 "key_column_usage": "table_schema table_name constraint_name column_name ordinal_position position_in_unique_constraint",
                 "referential_constraints": "constraint_schema constraint_name unique_constraint_schema unique_constraint_name",
                 "check_constraints": "constraint_schema constraint_name check_clause"}[view].upper().split()
        row = ["s", "t", "VIEW", "x", "y", "z", "w"][: len(names)]
        return spark.createDataFrame([tuple(row)], ", ".join(f"{n} string" for n in names))
    frames = readers.from_information_schema(read)
    assert frames["tables"].first()["kind"] == "view" and set(frames) == {"tables", "columns", "constraints", "key_columns", "referential", "checks"}


def test_indexes_logs_and_descriptions_have_no_bound(spark, tmp_path):
    n = 120_000
    names = spark.range(n).selectExpr("'b' AS bundle", "format_string('t/%06d', id) AS concept_id", "'T' AS type", "'' AS title", "'d' AS description", "id")
    writers.write_index(names, str(tmp_path), "Shop", "All.", "Tables")
    index = (tmp_path / "index.md").read_text().splitlines()
    assert index[:5] == ["---", 'format_version: "0.1"', "---", "# Shop", ""] and len(index) == 9 + n and index[-1] == "- [119999](t/119999.md) - d"
    log = names.selectExpr("bundle", "'2024-01-0' || (id % 2 + 1) AS date", "0 AS run", "concept_id", "'Creation' AS kind", "'m' AS message")
    writers.write_log(log, str(tmp_path), "b")
    text = (tmp_path / "log.md").read_text().splitlines()
    assert text[:5] == ["# Change Log", "", "## 2024-01-02", "", "* **Creation**: m"] and len(text) == n + 7
    known = names.selectExpr("concept_id AS path", "description")
    writers.write_descriptions(known, str(tmp_path))
    assert readers.read_descriptions(spark, str(tmp_path / ".catalog-metadata.yaml")).count() == n
    assert writers.write_descriptions(known.limit(0), str(tmp_path)) is None
    assert readers.read_descriptions(spark, str(tmp_path / ".catalog-metadata.yaml")).count() == 0


def test_hidden_names_are_read_too(spark, tmp_path):
    write(tmp_path, {"a.md": "1", ".b.md": "2", "_c.md": "3", "_d/e.md": "4", ".f/g.txt": "5"})
    assert {(r["path"], r["content"]) for r in readers.read_bundle(spark, str(tmp_path), "b").collect()} == {("a.md", "1"), (".b.md", "2"), ("_c.md", "3"), ("_d/e.md", "4")}
    assert {r["path"] for r in readers.file_inventory(spark, str(tmp_path)).where("NOT is_dir").collect()} == {"a.md", ".b.md", "_c.md", "_d/e.md", ".f/g.txt"}


def test_paths_of_any_length_are_found(spark):
    edges = spark.createDataFrame([("b", f"n{i}", f"n{i + 1}") for i in range(36)], "bundle string, source string, target string")
    path = graph.shortest_path(edges, "b", "n0", "n36")
    assert [r["id"] for r in path.orderBy("step").collect()] == [f"n{i}" for i in range(37)]
