import pytest
from pyspark.sql import functions as F

from mdcatalog.operators import audit, docs, enrich, graph, merge, render

FRONT = "---\ntype: T\ntitle: {0}\ndescription: {1}\n---\n"


def concept(title, description, body):
    return FRONT.format(title, description) + body


def test_yaml_forms(raw):
    files = {
        "flat.md": '---\ntype: "A \\"q\\""\ntags: [x, y]\nowner: \'it\'\'s\'\n# note\nempty:\n---\nbody',
        "list.md": "---\ntype: B\ntags:\n  - one\n  - two\ntitle: t\n---\n",
        "folded.md": "---\ntype: C\ndescription: >\n  two\n  lines\ntags: [\"a, b\", c]\n---\nx",
        "bad.md": "---\ntype: [open\n---\nx",
        "none.md": "no block",
        "index.md": "---\nformat_version: 1\n---\n# Root",
    }
    got = {r["path"]: r for r in docs.parse_concepts(raw(files)).collect()}
    assert set(got) == {"flat.md", "list.md", "folded.md", "bad.md", "none.md"}
    assert (got["flat.md"]["type"], got["flat.md"]["tags"], got["flat.md"]["extra"]) == ('A "q"', ["x", "y"], {"owner": "it's", "empty": ""})
    assert (got["list.md"]["tags"], got["list.md"]["title"]) == (["one", "two"], "t")
    assert (got["folded.md"]["description"], got["folded.md"]["tags"]) == ("two lines\n", ["a, b", "c"])
    assert got["bad.md"]["parse_error"] and got["bad.md"]["type"] is None
    assert got["none.md"]["parse_error"] == "missing frontmatter boundaries"


@pytest.fixture(scope="module")
def library(raw):
    """Two shelves of books: described ones, ones with generated text only, one without a type, one nobody points to."""
    columns = "# Columns\n\n| Name | Type | Comment |\n| --- | --- | --- |\n"
    return raw({
        "index.md": "---\nformat_version: 1\n---\n# Library\n",
        "shelf/loan.md": concept("loan", "Who has which copy", columns + "| copy | bigint | of a title |\n| reader | bigint | |\n| until | date | due day |\n\n# Relationships\n\n- [copy](/shelf/copy.md)\n- [reader](/desk/reader.md)\n- [fine](/desk/fine.md)\n"),
        "shelf/copy.md": concept("copy", "One item on a shelf", columns + "| id | bigint | |\n\n[title](/shelf/title.md)\n"),
        "shelf/title.md": concept("title", "MySQL table title", columns + "| id | bigint | |\n"),
        "desk/reader.md": concept("reader", "", "Text. [nowhere](/desk/none.md)\n"),
        "desk/note.md": "---\ntitle: note\ndescription: A remark\n---\nalone\n",
    })


def test_coverage(library):
    concepts, reserved = docs.parse_concepts(library), docs.reserved_files(library)
    c = audit.coverage(concepts).first()
    assert (c["total_concepts"], c["placeholders"], c["columns_total"], c["columns_commented"], c["enriched_pct"]) == (5, 2, 5, 2, 60.0)
    assert sorted(r["link"] for r in audit.broken_links(concepts).collect()) == ["desk/reader -> desk/none", "shelf/loan -> desk/fine"]
    assert [r["concept_id"] for r in audit.missing_type(concepts).collect()] == ["desk/note"]
    assert [r["concept_id"] for r in audit.orphans(concepts).collect()] == ["desk/note"]
    assert {r["concept_id"] for r in audit.enrich_first(concepts).collect()} == {"shelf/title", "desk/reader"}
    report = audit.report(concepts, reserved)
    assert {r["gate"] for r in audit.gates(report, min_pct=75, strict=True).collect()} == {"types", "broken-links", "enriched", "orphans"}
    assert {r["gate"] for r in audit.gates(report, min_pct=60).collect()} == {"types", "broken-links"}
    assert audit.gates(report, max_broken=2, require_types=False).count() == 0
    assert audit.text_report(report).first()["text"].startswith("bundle is 60.0% enriched (placeholders: 2, broken links: 2, orphans: 1,")


def test_conformance(raw):
    files = raw({"index.md": "---\nformat_version: 1\nowner: x\n---\n# R", "sub/index.md": "---\na: 1\n---\n", "plain.md": "nothing"})
    found = audit.findings(docs.parse_concepts(files), docs.reserved_files(files))
    assert sorted((r["rule"], r["path"]) for r in found.collect()) == [
        ("concept-unparseable", "plain.md"), ("root-index-extra-keys", "index.md"), ("subdir-index-frontmatter", "sub/index.md")]
    quoted = raw({"index.md": '---\n"format_version": 1\n---\n# R'})
    assert audit.findings(docs.parse_concepts(quoted), docs.reserved_files(quoted)).count() == 0
    broken = raw({"index.md": "---\nformat_version: [1\n---\n# R"})
    assert [r["detail"] for r in audit.findings(docs.parse_concepts(broken), docs.reserved_files(broken)).collect()] == ["root index.md frontmatter is missing format_version"]
    empty = audit.coverage(docs.parse_concepts(raw({"plain.md": "nothing"}))).first()
    assert (empty["total_concepts"], empty["placeholders"], empty["columns_total"]) == (0, 0, 0)
    other = raw({"index.md": "# R"})
    rules = [r["rule"] for r in audit.findings(docs.parse_concepts(other), docs.reserved_files(other), "spec_version").collect()]
    assert rules == ["root-index-spec-version"]


def test_columns_by_header_and_escaped_pipes(raw):
    body = "## Columns\n\n| Type | Name | Primary Key | Nullable | Comment | Description |\n|---|:-:|---|---|---|---|\n| TYPE_A | event_type | YES | no | a \\| b | last |\n| x | has---dashes | | Yes | | |\n| y | | | | | |\n\n# Other\n\n| Name |\n| --- |\n| not me |\n"
    rows = docs.parse_columns(docs.parse_concepts(raw({"t.md": concept("t", "d", body)}))).orderBy("ordinal").collect()
    assert [(r["name"], r["type"], r["pk"], r["nullable"], r["comment"]) for r in rows] == [
        ("event_type", "TYPE_A", True, False, "last"), ("has---dashes", "x", False, True, "")]


def test_typed_links(raw):
    body = ("intro [x](/c.md)\n# Relationships\n\n- FK on c_id [c](/c.md) and [d](d.md)\n\n# Joins\n[c](/c.md)\n# Columns\n[c](/c.md)\n## Related Files\n[c](/c.md)\n"
            "# See Also [c](/d.md)\n[FK](/c.md) FK on other\n[see](c.md#a) [me](/a.md) [web](http://x/c.md) [gone](/gone.md)\n#Odd\n[c](/c.md)\n")
    files = raw({"a.md": concept("a", "d", body), "c.md": concept("c", "d", ""), "d.md": concept("d", "d", "")})
    concepts = docs.parse_concepts(files)
    got = sorted((r["target"], r["relation"], r["label"]) for r in graph.crosslink_edges(concepts).collect())
    assert got == [("c", "", ""), ("c", "co-changes", ""), ("c", "joins-with", ""), ("c", "references", "c_id"), ("d", "references", "c_id")]
    # the audit counts links on heading lines too
    assert docs.resolved_links(concepts).where("target_id = 'd'").count() == 2


def graph_of(raw, files):
    concepts = docs.parse_concepts(raw(files))
    return graph.graph_nodes(concepts), graph.graph_edges(concepts)


def test_graph_properties(raw, spark):
    files = {"x/a.md": concept("a", "d", "[b](b.md)"), "x/b.md": concept("b", "d", "[c](/y/z/c.md)"), "y/z/c.md": concept("c", "d", ""), "e.md": concept("e", "d", "")}
    nodes, edges = graph_of(raw, files)
    assert {r["id"] for r in nodes.where("kind = 'directory'").collect()} == {"x", "y", "y/z"}
    degrees = graph.graph_degree(edges).agg(F.sum("degree")).first()[0]
    assert degrees == 2 * edges.count()
    seeds = spark.createDataFrame([("b", "x/a")], "bundle string, id string")
    crosslinks = edges.where("kind = 'crosslink'")
    assert [r["id"] for r in graph.n_hop(crosslinks, seeds, 0).collect()] == ["x/a"]
    assert {r["id"]: r["hop"] for r in graph.n_hop(crosslinks, seeds, 5).collect()} == {"x/a": 0, "x/b": 1, "y/z/c": 2}
    path = graph.shortest_path(crosslinks, "b", "y/z/c", "x/a").orderBy("step").collect()
    assert [r["id"] for r in path] == ["y/z/c", "x/b", "x/a"]
    assert graph.shortest_path(crosslinks, "b", "x/a", "e").count() == 0
    assert graph.fuzzy_search(nodes, "a d", None).count() >= 0
    kept, inside = graph.subgraph(nodes, edges, nodes.where("id IN ('x', 'x/a')"))
    assert (kept.count(), inside.count()) == (2, 1)


def test_diff_and_federation(raw):
    hashed = "---\ntype: T\ncontent_hash: {0}\n---\nbody\n"
    old = docs.parse_concepts(raw({"a.md": hashed.format("1"), "b.md": hashed.format("1"), "c.md": hashed.format("1"), "e.md": "---\ntype: T\n---\nx\n"}))
    new = docs.parse_concepts(raw({"a.md": hashed.format("1"), "b.md": hashed.format("2"), "d.md": hashed.format("1"), "e.md": "---\ntype: T\n---\n x \n"}))
    assert {r["id"]: r["diff"] for r in graph.diff_nodes(new, old).collect()} == {"a": "", "b": "changed", "c": "removed", "d": "added", "e": ""}
    assert graph.diff_nodes(old, old).where("diff <> ''").count() == 0
    n, e = graph.graph_nodes(old), graph.graph_edges(old)
    nodes, edges = graph.federate([("p", n, e), ("q", n, e)])
    assert nodes.count() == 2 * n.count() and edges.count() == 2 * e.count()
    assert nodes.where("id = 'p:a' AND dir = ''").count() == 1
    with pytest.raises(ValueError):
        graph.federate([("p", n, e), ("p", n, e)])


def fresh_from(concepts):
    return docs.readable(concepts).select("bundle", "concept_id", "path", "type", "title", "description", "resource", "tags", "timestamp", "body")


def test_merge(raw):
    produced = fresh_from(docs.parse_concepts(raw({"a.md": concept("a", "SQLite table a", "# Columns\n\nx\n"), "n.md": concept("n", "new", "# Columns\n")})))
    empty = docs.parse_concepts(raw({"zzz.md": concept("z", "z", "")}))
    first = merge.merge_concepts(empty, produced)
    assert {r["change"] for r in first.collect()} == {"Creation"}
    edited = first.where("concept_id = 'a'").withColumn("description", F.lit("Written")).withColumn("enriched_against", F.col("content_hash")) \
        .withColumn("body", F.concat("body", F.lit("\n# Notes\n\nmine\n"))).withColumn("tags", F.array(F.lit("z"), F.lit("")))
    again = merge.merge_concepts(edited.drop("change"), produced.where("concept_id = 'a'")).first()
    assert (again["change"], again["description"]) == ("", "Written") and again["body"].endswith("mine\n")
    changed = produced.where("concept_id = 'a'").withColumn("body", F.lit("# Columns\n\ny\n")).withColumn("tags", F.array(F.lit("b")))
    m = merge.merge_concepts(edited.drop("change"), changed).first()
    assert (m["change"], m["description"], m["tags"]) == ("Update", "Written", ["b", "z"])
    assert m["body"] == "# Columns\n\ny\n\n# Notes\n\nmine\n" and m["enriched_against"] != m["content_hash"]


def test_render_parse_round_trip(raw):
    tricky = docs.parse_concepts(raw({"a.md": concept("a", "d", "body\n")})).withColumn("title", F.lit('yes: "q" \\ #x')) \
        .withColumn("description", F.lit("line\none")).withColumn("tags", F.array(F.lit("true"), F.lit("a b"))).withColumn("extra", F.create_map(F.lit("k"), F.lit("1.5")))
    back = docs.parse_concepts(merge.render_concepts(tricky)).first()
    assert (back["title"], back["description"], back["tags"], back["extra"], back["body"]) == ('yes: "q" \\ #x', "line\none", ["true", "a b"], {"k": "1.5"}, "body\n")


def test_render_sections(spark):
    profiles = spark.createDataFrame([("t", 1, "b|c", 2, 1, 2, "x", "y\nz", "", ["q", "p"]), ("t", 0, "a", 3, 0, 3, None, None, "", [])],
                                     "concept_id string, ordinal int, column string, non_null bigint, nulls bigint, distinct bigint, min string, max string, semantic string, values array<string>")
    text = render.render_profile(profiles).first()["text"]
    assert text == ("| Column | Non-Null | Null | Distinct | Min | Max |\n| --- | --- | --- | --- | --- | --- |\n| a | 3 | 0 | 3 |  |  |\n"
                    "| b\\|c | 2 | 1 | 2 | x | y z |\n\nValues:\n- b\\|c ∈ {p, q}\n")
    rels = spark.createDataFrame([("s", "FK on b", "/t/b.md", "b"), ("s", "FK on a", "/t/a.md", "a")], "source_id string, label string, target string, text string")
    assert render.render_relationships(rels).first()["text"] == "- FK on a [a](/t/a.md)\n- FK on b [b](/t/b.md)\n"
    bodies = spark.createDataFrame([("t", "# Columns\n"), ("u", "x\n")], "concept_id string, body string")
    out = {r["concept_id"]: r["body"] for r in render.with_sections(bodies, {"Data Profile": render.render_profile(profiles)}).collect()}
    assert out["u"] == "x\n" and out["t"].startswith("# Columns\n\n## Data Profile\n\n| Column")


def test_enrichment_rules(spark):
    scores = spark.createDataFrame([("a", "grounding", 2), ("a", "conciseness", 5), ("b", "grounding", 4), ("b", "conciseness", 3)], "concept string, dimension string, score int")
    assert [r["concept"] for r in enrich.redo_concepts(scores).collect()] == ["a"]
    assert [r["concept"] for r in enrich.review_queue(scores).collect()] == ["a", "b"]
    base = spark.createDataFrame([("grounding", 3.6), ("conciseness", 4.5)], "dimension string, mean double")
    assert {r["dimension"]: r["regressed"] for r in enrich.score_regressions(enrich.score_means(scores), base).collect()} == {"grounding": True, "conciseness": False}
    names = spark.createDataFrame([("email", ""), ("zip", ""), ("shipping", ""), ("client_ip", ""), ("contact", "email"), ("id", "uuid")], "n string, s string")
    assert [r[0] for r in names.select(enrich.is_pii_column(F.col("n"), F.col("s"))).collect()] == [True, False, False, True, True, False]
