"""API specifications as a corpus: OpenAPI documents and GraphQL schemas -> concepts.

``specs(spec, content)`` holds one document per row. Everything is extracted with JSON and
regular-expression functions; a document never meets another one, except that concepts and
their table rows are separate outputs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from ..functions import json_refs as refs
from ..functions import markdown as md
from ..functions import text as tx
from ..functions.rows import evaluate_once

_NO_TEXT = "array<string>"


def _empty(kind: str = _NO_TEXT) -> Column:
    return F.array().cast(kind)


def _spec_step():
    """YAML document -> JSON text, by value (see ``functions.frontmatter``)."""
    def load(content: str) -> str | None:
        import json

        try:
            import yaml

            return json.dumps(yaml.safe_load(content), default=str)
        except Exception:  # an unreadable specification yields no concepts
            return None

    @F.pandas_udf(T.StringType())
    def yaml_spec(content: pd.Series) -> pd.Series:
        return content.map(load, na_action="ignore")

    return yaml_spec


_yaml_spec = _spec_step()


def load_specs(raw: DataFrame) -> DataFrame:
    """(spec, json) from JSON or YAML documents; only YAML ones are sent to Python."""
    is_json = tx.trim_ws(F.col("content")).rlike(r"^[\[{]")
    converted = raw.withColumn("_yaml", _yaml_spec(F.when(~is_json, F.col("content"))))
    return converted.select("spec", F.when(is_json, F.col("content")).otherwise(F.col("_yaml")).alias("json"))


# --- OpenAPI ------------------------------------------------------------------

_SCHEMA = "struct<`$ref`:string,type:string,required:array<string>,properties:map<string,string>>"
_PROPERTY = "struct<`$ref`:string,type:string,items:string>"
_OPERATION = "struct<operationId:string,summary:string,parameters:array<string>,requestBody:string,responses:map<string,string>>"
_BODY = "struct<content:map<string,struct<schema:string>>>"
_RESPONSE = "struct<schema:string,content:map<string,struct<schema:string>>>"
_PARAMETER = "struct<name:string,`in`:string,required:boolean,schema:string,type:string,items:string>"
_DOCUMENT = "struct<components:string,definitions:string,parameters:string,responses:string,paths:string>"
_TEXTS = "map<string,string>"


def _document(specs: DataFrame) -> DataFrame:
    """(spec, schemas, paths, nodes, depth): members as text, everything a reference can name, the longest chain of references."""
    doc = evaluate_once(specs, "spec", F.from_json("json", _DOCUMENT).alias("doc"))
    sections = [refs.grandchildren(F.col("doc.components"), "components")] + [
        refs.children(F.col(f"doc.{name}"), name) for name in ("definitions", "parameters", "responses", "paths")]
    members = F.coalesce(F.from_json(F.get_json_object("doc.components", "$.schemas"), _TEXTS), F.from_json("doc.definitions", _TEXTS))
    listed = evaluate_once(doc, "spec", F.from_json("doc.paths", _TEXTS).alias("paths"), members.alias("schemas"), F.concat(*sections).alias("nodes"))
    return evaluate_once(listed, "*", refs.aliases(F.col("nodes")).alias("depth"))


def _resolved(node: Column) -> Column:
    return refs.resolve(node, F.col("nodes"), F.col("depth"))


def _schemas(specs: DataFrame) -> DataFrame:
    """(spec, schema, def) of every component schema; one that is a reference has the definition it leads to."""
    entries = F.transform(F.map_entries("schemas"), lambda e: F.struct(e["key"].alias("schema"), F.from_json(_resolved(e["value"]), _SCHEMA).alias("def")))
    return evaluate_once(_document(specs), "spec", entries.alias("_schemas")).select("spec", F.inline("_schemas"))


def _field(node: Column, name: str) -> Column:
    return F.from_json(node, _PROPERTY)[name]


def _own_ref(node: Column) -> Column:
    """Name a schema node refers to, "" when it is no reference."""
    return F.coalesce(tx.ref_name(_field(node, "$ref")), F.lit(""))


def type_text(node: Column) -> Column:
    """Rendered type of a schema node: reference name, JSON type, ``array<...>``, or ``object``.

    Nested arrays are unwrapped as often as the node says "items".
    """
    start = F.struct(node.alias("node"), F.lit(0).alias("depth"))
    levels = F.regexp_count(node, F.lit('"items"'))

    def unwrap(state: Column, _: Column) -> Column:
        here = F.from_json(state["node"], _PROPERTY)
        inside = here["$ref"].isNull() & (here["type"] == "array") & here["items"].isNotNull()
        return F.when(inside, F.struct(here["items"].alias("node"), (state["depth"] + 1).alias("depth"))).otherwise(state)

    def render(state: Column) -> Column:
        here = F.from_json(state["node"], _PROPERTY)
        several = F.array_join(F.from_json(here["type"], _NO_TEXT), "|")
        plain = F.when(here["type"].startswith("["), several).otherwise(F.coalesce(here["type"], F.lit("object")))
        name = F.when(here["$ref"].isNotNull(), tx.ref_name(here["$ref"])).otherwise(plain)
        return F.concat(F.repeat(F.lit("array<"), state["depth"]), name, F.repeat(F.lit(">"), state["depth"]))

    steps = F.when(levels > 0, F.sequence(F.lit(1), levels)).otherwise(F.array().cast("array<int>"))
    return F.when(node.isNull(), F.lit("")).otherwise(F.aggregate(steps, start, unwrap, render))


def _linked_schema(node: Column) -> Column:
    """Schema a property refers to, directly or as array element."""
    own = _own_ref(node)
    return F.when(own != "", own).otherwise(_own_ref(_field(node, "items")))


def openapi_properties(specs: DataFrame) -> DataFrame:
    """Properties of every component schema: (spec, schema, name, type, required, links_to)."""
    properties = _schemas(specs).select("spec", "schema", F.col("def.required").alias("_required"),
                                F.explode("def.properties").alias("name", "_node"))
    return properties.select(
        "spec", "schema", "name", type_text(F.col("_node")).alias("type"),
        F.when(F.coalesce(F.array_contains("_required", F.col("name")), F.lit(False)), "yes").otherwise("no").alias("required"),
        _linked_schema(F.col("_node")).alias("links_to"))


def openapi_schemas(specs: DataFrame) -> DataFrame:
    """One concept per component schema: (spec, rel, type, title, body, links)."""
    head = "# Columns\n\n" + md.table_head("Name", "Type", "Required")
    entries = F.array_sort(F.map_entries(F.coalesce("def.properties", F.create_map().cast("map<string,string>"))))
    required = F.coalesce("def.required", _empty())

    def row(e: Column) -> Column:
        needed = F.when(F.array_contains(F.col("_required"), e["key"]), "yes").otherwise("no")
        return md.table_row(e["key"], type_text(e["value"]), needed)

    names = F.filter(F.transform("_entries", lambda e: _linked_schema(e["value"])), lambda n: n != "")
    return _schemas(specs).select("spec", "schema", entries.alias("_entries"), required.alias("_required")).select(
        "spec",
        F.concat(F.lit("schemas/"), "schema").alias("rel"),
        F.lit("Schema").alias("type"),
        F.col("schema").alias("title"),
        F.concat(F.lit(head), F.array_join(F.transform("_entries", row), "")).alias("body"),
        F.transform(F.array_sort(F.array_distinct(names)), lambda n: F.concat(F.lit("schemas/"), n)).alias("links"))


def _path_operations(specs: DataFrame) -> DataFrame:
    """(spec, known, path, method, op) per operation, with parameters, body and responses where references lead.

    References are followed in the document's row, before it becomes one row per operation.
    """
    def operations(item: Column) -> Column:
        return F.filter(F.map_entries(F.from_json(item, _TEXTS)), lambda m: m["key"].isin(fv.HTTP_METHODS))

    def of_path(e: Column) -> Column:
        # a path that is a reference has the operations it leads to, unless it has its own
        own = operations(e["value"])
        there = F.when(F.size(own) > 0, own).otherwise(operations(_resolved(e["value"])))
        return F.transform(there, lambda m: F.struct(e["key"].alias("path"), m["key"].alias("method"), F.from_json(m["value"], _OPERATION).alias("op")))

    def followed(o: Column) -> Column:
        op = o["op"]
        parameters = F.filter(F.transform(F.coalesce(op["parameters"], _empty()), _resolved), lambda p: p.isNotNull())
        responses = F.transform(F.array_sort(F.map_entries(op["responses"])), lambda r: F.struct(
            r["key"].alias("status"), F.from_json(_resolved(r["value"]), _RESPONSE).alias("of")))
        return F.struct(o["path"], o["method"], op["operationId"].alias("operationId"), op["summary"].alias("summary"), parameters.alias("parameters"),
                        F.from_json(_resolved(op["requestBody"]), _BODY).alias("body"), responses.alias("responses"))

    found = evaluate_once(_document(specs), "spec", "nodes", "depth", F.coalesce(F.map_keys("schemas"), _empty()).alias("known"),
                          F.flatten(F.transform(F.map_entries("paths"), of_path)).alias("_ops"))
    return evaluate_once(found, "spec", "known", F.transform("_ops", followed).alias("_ops")).select("spec", "known", F.explode("_ops").alias("op"))


def openapi_operations(specs: DataFrame) -> DataFrame:
    """Operations with their parts: (spec, method, path, slug, summary, parameters, body_schemas, responses, known).

    References to parameters, bodies, responses and paths are followed; a parameter whose reference is missing or a cycle
    is left out, a body or response of that kind has no schema.
    """
    parsed = F.transform("op.parameters", lambda p: F.from_json(p, _PARAMETER))
    # A parameter's type stands in its schema, or, in older documents, in the parameter itself.
    pairs = F.zip_with(parsed, F.col("op.parameters"), lambda p, raw: F.struct(
        p["name"].alias("name"), p["in"].alias("in"), F.coalesce(p["required"], F.lit(False)).alias("required"),
        F.coalesce(p["schema"], raw).alias("schema")))
    rows = evaluate_once(_path_operations(specs), "spec", "known", "op", pairs.alias("_pairs"))
    pairs = F.col("_pairs")
    in_body = F.transform(F.filter(pairs, lambda p: p["in"] == "body"), lambda p: p["schema"])
    body = F.transform(F.map_values(F.col("op.body.content")), lambda m: m["schema"])
    body_schemas = F.concat(F.coalesce(body, _empty()), in_body)

    def response(e: Column) -> Column:
        candidates = F.concat(
            F.coalesce(F.transform(F.map_values(e["of"]["content"]), lambda m: m["schema"]), _empty()),
            F.array(e["of"]["schema"]))
        names = F.filter(F.transform(candidates, _own_ref), lambda n: n != "")
        return F.struct(e["status"].alias("status"), F.coalesce(F.get(names, F.lit(0)), F.lit("")).alias("schema"))

    by_id = tx.slugify(F.coalesce("op.operationId", F.lit("")))
    slug = F.when(by_id != "", by_id).otherwise(tx.slugify(F.concat_ws("-", "op.method", "op.path")))
    return evaluate_once(
        rows, "spec", "known", F.upper("op.method").alias("method"), F.col("op.path").alias("path"), slug.alias("slug"),
        F.coalesce("op.summary", F.lit("")).alias("summary"),
        # what older documents send in the body or as a form is the request body, no parameter
        F.filter(pairs, lambda p: ~F.coalesce(p["in"], F.lit("")).isin("body", "formData")).alias("parameters"),
        body_schemas.alias("body_schemas"),
        F.coalesce(F.transform("op.responses", response), _empty("array<struct<status:string,schema:string>>")).alias("responses"),
        F.col("op.responses").isNotNull().alias("_has_responses"))


def duplicate_concepts(concepts: DataFrame) -> DataFrame:
    """(spec, rel, n) of concepts that would share one file: two operations of one slug, for example."""
    return concepts.groupBy("spec", "rel").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def openapi_endpoints(specs: DataFrame) -> DataFrame:
    """One concept per path and method: (spec, rel, type, title, body, links)."""
    title = F.concat_ws(" ", "method", "path")
    parameter_rows = F.array_join(F.transform("parameters", lambda p: md.table_row(
        p["name"], p["in"], type_text(p["schema"]), F.when(p["required"], "yes").otherwise("no"))), "")
    response_rows = F.array_join(F.transform("responses", lambda r: md.table_row(r["status"], r["schema"])), "")
    body = F.concat(
        F.lit("# "), title, F.lit("\n\n"),
        F.when(F.col("summary") != "", F.concat("summary", F.lit("\n\n"))).otherwise(""),
        F.when(F.size("parameters") > 0, F.concat(
            F.lit("## Parameters\n\n" + md.table_head("Name", "In", "Type", "Required")), parameter_rows, F.lit("\n"))).otherwise(""),
        F.when(F.col("_has_responses"), F.concat(
            F.lit("## Responses\n\n" + md.table_head("Status", "Schema")), response_rows, F.lit("\n"))).otherwise(""))
    referred = F.concat(
        F.transform("parameters", lambda p: _own_ref(p["schema"])),
        F.transform("body_schemas", _own_ref),
        F.transform("responses", lambda r: r["schema"]))
    links = F.array_sort(F.array_intersect(F.array_distinct(referred), F.col("known")))
    return openapi_operations(specs).select(
        "spec", F.concat(F.lit("endpoints/"), "slug").alias("rel"), F.lit("API Endpoint").alias("type"),
        title.alias("title"), body.alias("body"),
        F.transform(links, lambda n: F.concat(F.lit("schemas/"), n)).alias("links"))


# --- GraphQL --------------------------------------------------------------------
# A document becomes tokens, and these, in one pass, definitions without what may hold anything:
# descriptions, comments, directives with their arguments, default values.

_TOKEN = (r'(?s)""".*?(?<!\\)"""|"[^"\\\n\r]*+(?:\\.[^"\\\n\r]*+)*+"|#[^\n\r]*+|[_A-Za-z][_0-9A-Za-z]*+|-?[0-9][-+.0-9A-Za-z]*+|\.\.\.|[!$&()=@\[\]{}|:]')
_TYPE = r"((?:\[ )*\w+(?: [!\]])*)"
_FIELD = rf"(\w+) (\( [^()]*\) )?: {_TYPE}"
_ARGUMENT = rf"(\w+) : {_TYPE}"
_STATE = "struct<depth:int,skip:int,until:int,open:array<string>,done:array<string>>"
#: What the next token is, if it is to be skipped: the value of a default, the name of a directive, its arguments if it has some.
_NOTHING, _VALUE, _DIRECTIVE, _ARGUMENTS = 0, 1, 2, 3


def _tokens(sdl: Column) -> Column:
    """Tokens without comments; a string of either kind is a lone quote."""
    found = F.filter(F.regexp_extract_all(sdl, F.lit(_TOKEN), 0), lambda t: ~t.startswith("#"))
    return F.transform(found, lambda t: F.when(t.startswith('"'), F.lit('"')).otherwise(t))


def _definitions(tokens: Column) -> Column:
    """Each top-level definition as its tokens between blanks.

    ``depth`` counts brackets of all kinds. A skipped value or argument list that begins with a bracket is
    skipped ``until`` the depth is what it was before. A definition ends with its closing brace, or, having none, before the
    next keyword that cannot belong to it.
    """
    start = F.struct(F.lit(0).alias("depth"), F.lit(_NOTHING).alias("skip"), F.lit(-1).alias("until"), _empty().alias("open"), _empty().alias("done")).cast(_STATE)

    def step(s: Column, t: Column) -> Column:
        opens, closes = t.isin("(", "[", "{"), t.isin(")", "]", "}")
        depth = F.when(opens, s["depth"] + 1).when(closes, F.greatest(s["depth"] - 1, F.lit(0))).otherwise(s["depth"])
        inside = s["until"] >= 0
        skipped = inside | s["skip"].isin(_VALUE, _DIRECTIVE) | ((s["skip"] == _ARGUMENTS) & (t == "("))
        until = (F.when(inside, F.when(depth <= s["until"], -1).otherwise(s["until"]))
                 .when(skipped & (s["skip"] != _DIRECTIVE) & opens, s["depth"]).otherwise(-1))
        default = (t == "=") & (s["depth"] > 0)
        skip = (F.when(inside, _NOTHING).when(s["skip"] == _DIRECTIVE, _ARGUMENTS).when(skipped, _NOTHING)
                .when(default, _VALUE).when(t == "@", _DIRECTIVE).otherwise(_NOTHING))
        kept = ~skipped & ~default & ~t.isin("@", '"')
        last = F.coalesce(F.try_element_at(s["open"], F.lit(-1)), F.lit(""))
        first, size = F.coalesce(F.get(s["open"], F.lit(0)), F.lit("")), F.size(s["open"])
        # a name is due at the beginning, after the keyword of the definition, and after what joins names
        due = ((size == 0) | last.isin("=", "|", "&", "implements") | (last == "on") & (first == "directive") | (size == 1) & (last != "schema") & last.isin(*fv.GRAPHQL_KEYWORDS)
               | (size == 2) & (first == "extend"))
        begins = kept & (s["depth"] == 0) & t.isin(*fv.GRAPHQL_KEYWORDS) & ~due
        ends = kept & (t == "}") & (depth == 0)
        whole = F.array_join(s["open"], " ")
        done = (F.when(begins, F.array_append(s["done"], whole)).when(ends, F.array_append(s["done"], F.concat(whole, F.lit(" }"))))
                .otherwise(s["done"]))
        open_ = F.when(begins, F.array(t)).when(ends, _empty()).when(kept, F.array_append(s["open"], t)).otherwise(s["open"])
        return F.struct(depth.alias("depth"), skip.alias("skip"), until.alias("until"), open_.alias("open"), done.alias("done")).cast(_STATE)

    return F.aggregate(tokens, start, step, lambda s: F.filter(F.array_append(s["done"], F.array_join(s["open"], " ")), lambda d: d != ""))


def _groups(text: Column, pattern: str, count: int) -> Column:
    """All matches as array<struct<g1, g2, ...>>."""
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    return F.transform(matches, lambda m: F.struct(*[
        F.regexp_extract(m, pattern, i).alias(f"g{i}") for i in range(1, count + 1)]))


def _close(type_text: Column) -> Column:
    return F.replace(type_text, F.lit(" "), F.lit(""))


def _underlying(type_text: Column) -> Column:
    return F.regexp_replace(type_text, r"[\[\]!]", "")


def _sdl_blocks(sdl: DataFrame) -> DataFrame:
    """(spec, roots, kind, name, text, emitted): one row per type name of every document.

    What extends a type, or defines it again, adds to the definition, in the order of the document; an extension of a
    type that is not defined defines it.
    """
    lexed = evaluate_once(sdl, "spec", _tokens(F.col("content")).alias("_tokens"))
    defined = evaluate_once(lexed, "spec", _definitions(F.col("_tokens")).alias("_texts"))
    head = r"^(extend )?(type|input|interface|enum|union) (\w+)"
    parts = F.transform(F.filter("_texts", lambda d: d.rlike(head)), lambda d: F.struct(
        (F.regexp_extract(d, head, 1) != "").alias("extends"), F.regexp_extract(d, head, 2).alias("kind"), F.regexp_extract(d, head, 3).alias("name"),
        F.when(F.regexp_extract(d, head, 2) == "union", F.regexp_extract(d, r"= (.*)$", 1)).otherwise(F.regexp_extract(d, r"\{ (.*)\}$", 1)).alias("text")))
    schema = F.filter("_texts", lambda d: d.rlike(r"^(extend )?schema\b"))
    operations = F.array_join(F.transform(schema, lambda d: F.regexp_extract(d, r"\{ (.*)\}$", 1)), " ")
    named = evaluate_once(defined, "spec", parts.alias("_parts"), operations.alias("_operations"), F.exists("_texts", lambda d: d.startswith("schema ")).alias("_declared"))

    def root(operation: str) -> Column:
        declared = F.regexp_extract("_operations", rf"\b{operation} : (\w+)", 1)
        return F.when((declared != "") | F.col("_declared"), declared).otherwise(operation.capitalize()).alias(operation)

    roots = F.struct(root("query"), root("mutation"), root("subscription"))
    ordered = F.concat(F.filter("_parts", lambda d: ~d["extends"]), F.filter("_parts", lambda d: d["extends"]))
    found = evaluate_once(named, "spec", roots.alias("roots"), ordered.alias("_parts"))
    names = F.array_distinct(F.transform("_parts", lambda d: d["name"]))
    root_names = F.array(F.col("roots.query"), F.col("roots.mutation"), F.col("roots.subscription"))
    hidden = F.array_union(root_names, F.array(*[F.lit(s) for s in fv.GRAPHQL_SCALARS]))
    emitted = F.filter(F.array_except(names, hidden), lambda n: ~n.startswith("__"))

    def whole(name: Column) -> Column:
        own = F.filter("_parts", lambda d: d["name"] == name)
        return F.struct(F.get(own, F.lit(0))["kind"].alias("kind"), name.alias("name"),
                        F.array_join(F.transform(own, lambda d: F.rtrim(d["text"])), " ").alias("text"))

    merged = evaluate_once(found, "spec", "roots", emitted.alias("emitted"), F.transform(names, whole).alias("_defs"))
    return merged.select("spec", "roots", "emitted", F.inline("_defs"))


def _fields(text: Column, pattern: str) -> Column:
    """Fields or arguments as array<struct<name, arguments, type>>."""
    count = 3 if pattern == _FIELD else 2
    return F.transform(_groups(text, pattern, count), lambda g: F.struct(
        g["g1"].alias("name"), (g["g2"] if count == 3 else F.lit("")).alias("arguments"), _close(g[f"g{count}"]).alias("type")))


def graphql_types(sdl: DataFrame) -> DataFrame:
    """One concept per object, input, interface, enum and union: (spec, rel, type, title, body, links)."""
    words = F.regexp_extract_all("text", F.lit(r"\w+"), 0)
    fields = F.filter(_fields(F.col("text"), _FIELD), lambda f: ~f["name"].startswith("__"))

    def row(f: Column) -> Column:
        return md.table_row(f["name"], f["type"], F.when(f["type"].endswith("!"), "yes").otherwise("no"))

    listed = F.array_join(F.transform(words, lambda w: F.concat(F.lit("- "), w, F.lit("\n"))), "")
    table = F.concat(F.lit("# Columns\n\n" + md.table_head("Name", "Type", "Required")), F.array_join(F.transform(fields, row), ""))
    body = (
        F.when(F.col("kind") == "enum", F.concat(F.lit("# Values\n\n"), listed))
        .when(F.col("kind") == "union", F.concat(F.lit("# Members\n\n"), listed))
        .otherwise(table))
    referred = (
        F.when(F.col("kind") == "enum", _empty()).when(F.col("kind") == "union", words)
        .otherwise(F.transform(fields, lambda f: _underlying(f["type"]))))
    links = F.array_sort(F.array_intersect(F.array_distinct(referred), F.col("emitted")))
    return _sdl_blocks(sdl).where(F.array_contains("emitted", F.col("name"))).select(
        "spec", F.concat(F.lit("types/"), "name").alias("rel"), F.lit("GraphQL Type").alias("type"),
        F.col("name").alias("title"), body.alias("body"),
        F.transform(links, lambda n: F.concat(F.lit("types/"), n)).alias("links"))


def graphql_operations(sdl: DataFrame) -> DataFrame:
    """One concept per field of the root types: (spec, rel, type, title, body, links)."""
    name = F.col("name")
    kind = (
        F.when(name == F.col("roots.query"), "Query").when(name == F.col("roots.mutation"), "Mutation")
        .when(name == F.col("roots.subscription"), "Subscription"))
    folder = F.when(F.col("_op") == "Query", "queries").when(F.col("_op") == "Mutation", "mutations").otherwise("subscriptions")
    fields = _sdl_blocks(sdl).withColumn("_op", kind).where("_op IS NOT NULL").select(
        "spec", "emitted", "_op", folder.alias("_folder"),
        F.inline(_fields(F.col("text"), _FIELD)).alias("name", "_args", "returns"),
    ).where(~name.startswith("__"))
    arguments = _fields(F.col("_args"), _ARGUMENT)
    rows = F.array_join(F.transform(arguments, lambda a: md.table_row(
        a["name"], a["type"], F.when(a["type"].endswith("!"), "yes").otherwise("no"))), "")
    body = F.concat(
        F.lit("# "), "name", F.lit("\n\nReturns `"), "returns", F.lit("`.\n"),
        F.when(F.size(arguments) > 0, F.concat(
            F.lit("\n## Arguments\n\n" + md.table_head("Name", "Type", "Required")), rows)).otherwise(""))
    referred = F.concat(F.array(_underlying(F.col("returns"))), F.transform(arguments, lambda a: _underlying(a["type"])))
    links = F.array_sort(F.array_intersect(F.array_distinct(referred), F.col("emitted")))
    return fields.select(
        "spec", F.concat_ws("/", "_folder", tx.slugify(F.col("name"))).alias("rel"),
        F.concat(F.lit("GraphQL "), "_op").alias("type"), F.col("name").alias("title"), body.alias("body"),
        F.transform(links, lambda n: F.concat(F.lit("types/"), n)).alias("links"))


# --- both -------------------------------------------------------------------------


def spec_relationships(concepts: DataFrame) -> DataFrame:
    """References between extracted concepts as relationship rows."""
    return concepts.select("spec", F.col("rel").alias("source_id"), F.explode("links").alias("_to")).select(
        "spec", "source_id", F.lit("references").alias("label"),
        F.concat(F.lit("/"), "_to", F.lit(".md")).alias("target"), tx.ref_name(F.col("_to")).alias("text"))


def with_relationships(concepts: DataFrame) -> DataFrame:
    """Extracted concepts whose body ends in a Relationships section."""
    lines = F.array_join(F.transform("links", lambda l: F.concat(
        F.lit("- references ["), tx.ref_name(l), F.lit("](/"), l, F.lit(".md)\n"))), "")
    return concepts.withColumn("body", md.append_section(F.col("body"), "Relationships", lines))
