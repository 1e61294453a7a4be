"""References in API documents, and schemas with everything their grammar allows around fields."""

import json
import time

import pytest
from pyspark.sql import functions as F

from mdcatalog.functions import json_refs as refs
from mdcatalog.operators import specs

DOC = {"components": {"schemas": {"A": {"properties": {"x/y": {"type": "t~"}, "l": [{"n": 1}, {"$ref": "#/components/schemas/B"}]}}, "B": {"$ref": "#/components/schemas/C"},
                                  "C": {"$ref": "#/components/schemas/A/properties/x~1y"}, "L": {"$ref": "#/components/schemas/M"}, "M": {"$ref": "#/components/schemas/L"},
                                  "a b": {"type": "blank"}, "p+q": {"type": "plus"}, "t~/": {"type": "escapes"}}, "x-note": "text"},
       "paths": {"/a": {"get": {"responses": {"200": {"description": "ok"}}}}}}


@pytest.fixture(scope="module")
def follow(spark):
    listed = F.concat(refs.grandchildren(F.get_json_object("doc", "$.components"), "components"), refs.children(F.get_json_object("doc", "$.paths"), "paths"))

    def run(node):
        row = spark.createDataFrame([(json.dumps(DOC), json.dumps(node))], "doc string, node string")
        held = row.select("node", listed.alias("nodes")).withColumn("depth", refs.aliases(F.col("nodes")))
        found = held.select(refs.resolve(F.col("node"), F.col("nodes"), F.col("depth"))).first()[0]
        return None if found is None else json.loads(found)
    return run


@pytest.mark.parametrize("pointer, expected", [
    ("#/components/schemas/B", {"type": "t~"}), ("#/components/schemas/A/properties/l/0", {"n": 1}), ("#/components/schemas/A/properties/l/1", {"type": "t~"}),
    ("#/components/schemas/A/properties/l/2", None), ("#/components/schemas/A/properties/l/01", None), ("#/components/schemas/L", None), ("#/components/schemas/a%20b", {"type": "blank"}),
    ("#/components/schemas/p+q", {"type": "plus"}), ("#/components/schemas/t~0~1", {"type": "escapes"}), ("#/paths/~1a/get/responses/200", {"description": "ok"}),
    ("#/components/schemas/No", None), ("#/components/schemas/A/no/no", None), ("#/no", None), ("#", None), ("", None), ("other.yaml#/components/schemas/A", None), ("#/components/schemas/%zz", None)])
def test_pointers(follow, pointer, expected):
    assert follow({"$ref": pointer}) == expected


def test_no_reference(follow):
    assert follow({"a": 1}) == {"a": 1}


def load(spark, doc):
    return specs.load_specs(spark.createDataFrame([("s", doc if isinstance(doc, str) else json.dumps(doc))], "spec string, content string"))


def test_many_references(spark):
    names = [f"P{i}" for i in range(400)]
    doc = {"components": {"parameters": {n: {"name": n, "in": "query", "schema": {"type": "string"}} for n in names}},
           "paths": {f"/p{i}": {"get": {"parameters": [{"$ref": f"#/components/parameters/{n}"} for n in names[i:i + 5]]}} for i in range(400)}}
    start = time.time()
    rows = specs.openapi_operations(load(spark, doc)).select("path", "parameters.name").collect()
    assert {r["path"]: r["name"] for r in rows} == {f"/p{i}": names[i:i + 5] for i in range(400)}
    assert time.time() - start < 60


def test_odd_documents(spark):
    for doc in ("{}", "[]", "{", "", '{"paths": 3, "components": []}', '{"paths": {"/a": null, "/b": []}, "components": {"schemas": null}}',
                '{"paths": {"/a": {"$ref": "#/paths/~1a"}, "/b": {"get": 1, "post": {"parameters": [null, 1, {}], "responses": {"200": null}, "requestBody": 2}}}}'):
        loaded = load(spark, doc)
        assert specs.openapi_schemas(loaded).count() == specs.openapi_properties(loaded).count() == 0
        specs.openapi_endpoints(loaded).collect()


def test_two_operations_of_one_slug(spark):
    doc = {"paths": {"/a": {"get": {"operationId": "do it"}}, "/b": {"get": {"operationId": "do-it"}}, "/c": {"get": {}}}}
    assert [tuple(r) for r in specs.duplicate_concepts(specs.openapi_endpoints(load(spark, doc))).collect()] == [("s", "endpoints/do-it", 2)]


def sdl(spark, *texts):
    return spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(texts)], "spec string, content string")


def types_of(df):
    return {(r["spec"], r["title"]): (r["body"].split("| --- | --- | --- |\n")[-1], r["links"]) for r in specs.graphql_types(df).collect()}


def test_schema_with_defaults_directives_and_extensions(spark):
    text = r'''"""doc with { and \\""" quotes""" schema @a(x: "}") { query: Root mutation: M } # } comment
    type Root { a(x: In = {k: 1, l: [{m: "}"}]}, y: [Int!] = [1 2]): T! @d(of: {x: [1]}) "text: {" b: [T] }
    type M { do: T } extend type Root @x { c: T } extend type T { z: Int } type T implements I & J @y { x: String } extend type T { w: [T!]! }
    extend schema { subscription: S } type S { on: T type: T } directive @d(of: In @e(a: 1) = {a: 1}) repeatable on FIELD | OBJECT scalar Z @s(by: "(")
    input In { k: Int = -1.5e+3 l: [In] = [{k: 1}] @d m: String = "a" n: Boolean = true } union U = | T | Root union V = T extend union V = M type Empty'''
    df = sdl(spark, text)
    found = types_of(df)
    assert sorted(k[1] for k in found) == ["Empty", "In", "T", "U", "V"]
    assert found["s0", "T"] == ("| x | String | no |\n| z | Int | no |\n| w | [T!]! | yes |\n", ["types/T"])
    assert found["s0", "In"][0] == "| k | Int | no |\n| l | [In] | no |\n| m | String | no |\n| n | Boolean | no |\n"
    assert found["s0", "U"] == ("# Members\n\n- T\n- Root\n", ["types/T"])
    assert found["s0", "V"][0] == "# Members\n\n- T\n- M\n"
    operations = {r["rel"]: (r["body"].split("\n")[2], [x for x in r["body"].split("\n")[8:] if x], r["links"]) for r in specs.graphql_operations(df).collect()}
    assert operations == {
        "queries/a": ("Returns `T!`.", ["| x | In | no |", "| y | [Int!] | no |"], ["types/In", "types/T"]), "queries/b": ("Returns `[T]`.", [], ["types/T"]),
        "queries/c": ("Returns `T`.", [], ["types/T"]), "mutations/do": ("Returns `T`.", [], ["types/T"]),
        "subscriptions/on": ("Returns `T`.", [], ["types/T"]), "subscriptions/type": ("Returns `T`.", [], ["types/T"])}


def test_roots_without_a_schema_definition(spark):
    df = sdl(spark, "type Query { a: Int } type Mutation { b: Int }", "schema { query: Query } type Query { a: Int } type Mutation { b: Int }",
             "extend schema { query: Q } type Q { a: Int } type Query { b: Int } type Mutation { c: Int }")
    assert sorted((r["spec"], r["rel"]) for r in specs.graphql_operations(df).collect()) == [
        ("s0", "mutations/b"), ("s0", "queries/a"), ("s1", "queries/a"), ("s2", "mutations/c"), ("s2", "queries/a")]
    assert sorted(types_of(df)) == [("s1", "Mutation"), ("s2", "Query")]


def test_keywords_as_names(spark):
    found = types_of(sdl(spark, "type type { type: input input(type: type = {enum: 1}): union } enum enum { type enum schema } input input { on: Int } union union = type | enum scalar on type B { a: on }"))
    assert sorted(k[1] for k in found) == ["B", "enum", "input", "type", "union"]
    assert found["s0", "type"] == ("| type | input | no |\n| input | union | no |\n", ["types/input", "types/union"])
    assert found["s0", "enum"][0] == "# Values\n\n- type\n- enum\n- schema\n"


def test_broken_schemas_do_not_fail(spark):
    df = sdl(spark, None, "", "}", "type", "type A {", "type A { a: Int", '"""', '"', "type A { a(: } type B { b: Int }", "{ { [ (", "extend", "union U", "enum E", "type A { a: }", "@", "= 1")
    assert all(k[1] in "ABUE" for k in types_of(df))
    specs.graphql_operations(df).collect()


def test_large_schema(spark):
    field = ' """A field\nwith text""" f{0}(a: Int = 1, b: [T{0}!] = [{{c: "x"}}]): [T{0}!]! @deprecated(reason: "{{")\n'
    text = "\n".join(f"type T{i} {{\n{''.join(field.format(j) for j in range(i, i + 8))}}}" for i in range(1000))
    start = time.time()
    rows = specs.graphql_types(sdl(spark, text)).select("title", F.size("links").alias("n")).collect()
    assert len(rows) == 1000 and {r["n"] for r in rows} <= set(range(1, 9))
    assert time.time() - start < 120
