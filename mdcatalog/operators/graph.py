"""The catalog as a graph: nodes, typed edges, degrees, search, diff, federation, traversal.

``nodes(bundle, id, kind, type, title, description, resource, tags, dir)`` and
``edges(bundle, source, target, kind, relation, label)`` are plain DataFrames. Traversals
run as joins of a frontier with the edge list; each hop is written to the checkpoint
folder, so plans stay short and lost executors cost one hop at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import markdown as md
from ..functions import paths as pt
from ..functions import text as tx
from ..functions.rows import evaluate_once
from ..session import cut_lineage
from . import docs

NODE_COLUMNS = ["bundle", "id", "kind", "type", "title", "description", "resource", "tags", "dir"]
EDGE_KEY = ["bundle", "kind", "relation", "source", "target"]


def concept_nodes(concepts: DataFrame) -> DataFrame:
    cid = F.col("concept_id")
    return docs.readable(concepts).select(
        "bundle", cid.alias("id"), F.lit("concept").alias("kind"), "type",
        F.coalesce(F.nullif("title", F.lit("")), pt.base_name(cid)).alias("title"),
        "description", "resource", "tags", pt.parent_dir(cid).alias("dir"))


def _other_nodes(df: DataFrame, kind: str, title: Column, folder: Column) -> DataFrame:
    blank = F.lit("")
    return df.select(
        "bundle", "id", F.lit(kind).alias("kind"), blank.alias("type"), title.alias("title"),
        blank.alias("description"), blank.alias("resource"),
        F.array().cast("array<string>").alias("tags"), folder.alias("dir"))


def directory_nodes(concepts: DataFrame) -> DataFrame:
    """Every ancestor directory of any concept, once."""
    dirs = docs.readable(concepts).select("bundle", F.explode(pt.ancestors(F.col("concept_id"))).alias("id")).distinct()
    return _other_nodes(dirs, "directory", pt.base_name(F.col("id")), pt.parent_dir(F.col("id")))


def root_nodes(concepts: DataFrame, reserved: DataFrame | None = None) -> DataFrame:
    """One root per bundle, titled by the first heading of the root index, else by the bundle."""
    roots = docs.readable(concepts).select("bundle").distinct().withColumn("id", F.lit(fv.ROOT_NODE))
    if reserved is None:
        return _other_nodes(roots, "root", F.col("bundle"), F.lit(""))
    titles = reserved.where("path = 'index.md' AND has_frontmatter").select(
        "bundle", F.nullif(md.first_heading(F.col("body")), F.lit("")).alias("_title"))
    titled = roots.join(titles, "bundle", "left")
    return _other_nodes(titled, "root", F.coalesce("_title", "bundle"), F.lit(""))


def graph_nodes(concepts: DataFrame, reserved: DataFrame | None = None) -> DataFrame:
    return (
        concept_nodes(concepts)
        .unionByName(directory_nodes(concepts))
        .unionByName(root_nodes(concepts, reserved))
    )


def _relation(heading: Column, text: Column) -> Column:
    by_heading, by_text = F.lit(""), F.lit(None).cast("string")
    for name, relation in fv.HEADING_RELATION.items():
        by_heading = F.when(F.lower(heading) == name, F.lit(relation)).otherwise(by_heading)
    for name, relation in fv.TEXT_RELATION.items():
        by_text = F.when(F.lower(tx.trim_ws(text)) == name, F.lit(relation)).otherwise(by_text)
    return F.coalesce(by_text, by_heading)


def typed_links(concepts: DataFrame) -> DataFrame:
    """Resolved links with relation and foreign-key label, before deduplication."""
    found = docs.resolved_links(concepts, by_line=True)
    typed = evaluate_once(found, *found.columns, _relation(F.col("heading"), F.col("text")).alias("relation"))
    label = F.when(F.col("relation") == "references", F.regexp_extract("line", fv.FK_LABEL, 1)).otherwise("")
    return typed.withColumn("label", label)


def crosslink_edges(concepts: DataFrame) -> DataFrame:
    """One edge per (source, target, relation), labelled by its first occurrence.

    Occurrences are reduced before the join with the nodes.
    """
    first = F.min_by("label", F.struct("part_no", "line_no", "match_no")).alias("label")
    reduced = typed_links(concepts).groupBy("bundle", "source_id", "target_id", "relation").agg(first)
    ids = concept_nodes(concepts).select("bundle", "id").unionByName(directory_nodes(concepts).select("bundle", "id"))
    existing = ids.withColumnRenamed("id", "target_id")
    return reduced.join(existing, ["bundle", "target_id"], "left_semi").select(
        "bundle", F.col("source_id").alias("source"), F.col("target_id").alias("target"),
        F.lit("crosslink").alias("kind"), "relation", "label")


def containment_edges(nodes: DataFrame) -> DataFrame:
    blank = F.lit("")
    return nodes.where("kind <> 'root'").select(
        "bundle", F.coalesce(F.nullif("dir", blank), F.lit(fv.ROOT_NODE)).alias("source"), F.col("id").alias("target"),
        F.lit("containment").alias("kind"), blank.alias("relation"), blank.alias("label"))


def graph_edges(concepts: DataFrame) -> DataFrame:
    contained = containment_edges(concept_nodes(concepts).unionByName(directory_nodes(concepts)))
    return contained.unionByName(crosslink_edges(concepts))


def sort_edges(edges: DataFrame) -> DataFrame:
    return edges.orderBy(*[c for c in [*EDGE_KEY, "diff"] if c in edges.columns])


def graph_degree(edges: DataFrame) -> DataFrame:
    """Incident edges per node, containment included."""
    ends = edges.select("bundle", F.explode(F.array("source", "target")).alias("id"))
    return ends.groupBy("bundle", "id").agg(F.count("*").alias("degree"))


def with_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    joined = nodes.join(graph_degree(edges), ["bundle", "id"], "left")
    return joined.withColumn("degree", F.coalesce("degree", F.lit(0).cast("bigint")))


def relation_facet(edges: DataFrame) -> DataFrame:
    return edges.where("kind = 'crosslink'").select("relation").distinct().orderBy("relation")


def filter_relations(edges: DataFrame, relations: list[str], containment: bool = True) -> DataFrame:
    """Edges of the chosen relations, with or without the directory structure."""
    keep = (F.col("kind") == "crosslink") & F.col("relation").isin(relations)
    return edges.where(keep | (F.col("kind") == "containment") if containment else keep)


def filter_types(nodes: DataFrame, types: list[str]) -> DataFrame:
    """Nodes of the chosen types; nodes without a type always pass."""
    return nodes.where(F.col("type").isNull() | (F.col("type") == "") | F.col("type").isin(types))


def directory_clusters(nodes: DataFrame) -> DataFrame:
    """Directories as super-nodes with the number of concepts directly inside."""
    return nodes.where("kind = 'concept'").groupBy("bundle", "dir").agg(F.count("*").alias("concepts"))


def search_text(nodes: DataFrame) -> Column:
    return F.concat(F.col("id"), F.lit(" "), F.col("title"), F.lit(" "), F.coalesce("type", F.lit("")),
                    F.lit(" "), F.array_join("tags", " "))


def fuzzy_search(nodes: DataFrame, query: str, types: list[str] | None = None) -> DataFrame:
    """Concepts that match the query as a subsequence, best first."""
    found = nodes.where("kind = 'concept'")
    if types is not None:
        found = filter_types(found, types)
    texts = evaluate_once(found, "bundle", "id", search_text(nodes).alias("_text"))
    scored = evaluate_once(texts, "bundle", "id", tx.fuzzy_score(query.strip(), F.col("_text")).alias("score"))
    # sorting looks at its rows twice; a table keeps it from scoring and parsing twice
    return cut_lineage(scored.where("score >= 0")).orderBy(F.desc("score"), "bundle", "id")


# --- entity-relationship view ----------------------------------------------


def er_columns(concepts: DataFrame) -> DataFrame:
    """Columns of tabular concepts with primary-key and foreign-key flags."""
    labels = typed_links(concepts).where("relation = 'references' AND label <> ''").select(
        "bundle", F.col("source_id").alias("concept_id"), F.col("label").alias("name")).distinct().withColumn("_fk", F.lit(True))
    return docs.parse_columns(concepts).join(labels, ["bundle", "concept_id", "name"], "left").select(
        "bundle", "concept_id", "ordinal", "name", "type", "pk", F.coalesce("_fk", F.lit(False)).alias("fk"), "nullable")


def er_edges(concepts: DataFrame) -> DataFrame:
    """``references`` edges between two concepts that both list columns."""
    tabular = docs.parse_columns(concepts).select("bundle", "concept_id").distinct()
    edges = crosslink_edges(concepts).where("relation = 'references'")
    for end in ("source", "target"):
        edges = edges.join(tabular.withColumnRenamed("concept_id", end), ["bundle", end], "left_semi")
    return edges.select("bundle", "source", "target", "label")


# --- diff and federation -----------------------------------------------------


def diff_nodes(newer: DataFrame, older: DataFrame) -> DataFrame:
    """Concept nodes with diff "added", "changed", "removed" or "".

    Changed: the stored hashes differ, or, when one is missing, the trimmed bodies do.
    """
    def side(concepts: DataFrame, p: str) -> DataFrame:
        nodes = docs.readable(concepts)
        cid = F.col("concept_id")
        return nodes.select(
            "bundle", "concept_id",
            F.struct("type", F.coalesce(F.nullif("title", F.lit("")), pt.base_name(cid)).alias("title"), "description").alias(f"{p}_node"),
            F.col("content_hash").alias(f"{p}_hash"), F.md5(tx.trim_ws(F.col("body"))).alias(f"{p}_body"))

    both = side(newer, "new").join(side(older, "old"), ["bundle", "concept_id"], "full_outer")
    hashed = (F.col("new_hash") != "") & (F.col("old_hash") != "")
    changed = F.when(hashed, F.col("new_hash") != F.col("old_hash")).otherwise(F.col("new_body") != F.col("old_body"))
    diff = (
        F.when(F.col("old_node").isNull(), "added").when(F.col("new_node").isNull(), "removed")
        .when(changed, "changed").otherwise(""))
    return both.select("bundle", F.col("concept_id").alias("id"),
                       F.coalesce("new_node", "old_node").alias("_n"), diff.alias("diff")).select("bundle", "id", "_n.*", "diff")


def diff_edges(newer: DataFrame, older: DataFrame) -> DataFrame:
    """Edges of both versions with diff "added", "removed" or ""; the label is no part of the key."""
    new = newer.select(*EDGE_KEY, F.struct("label").alias("_new"))
    old = older.select(*EDGE_KEY, F.struct("label").alias("_old"))
    diff = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("")
    return new.join(old, EDGE_KEY, "full_outer").select(
        *EDGE_KEY, F.coalesce("_new", "_old")["label"].alias("label"), diff.alias("diff"))


def federate(graphs: list[tuple[str, DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Union of (key, nodes, edges) graphs with ids prefixed by their key."""
    keys = [key for key, _, _ in graphs]
    if len(set(keys)) != len(keys):
        raise ValueError(f"bundle keys must be unique: {keys}")

    def prefixed(key: str, df: DataFrame, columns: list[str]) -> DataFrame:
        for c in columns:
            df = df.withColumn(c, F.when(F.col(c) == "", F.lit("")).otherwise(F.concat(F.lit(key + ":"), F.col(c))))
        return df.withColumn("bundle", F.lit(key))

    nodes, edges = None, None
    for key, n, e in graphs:
        n, e = prefixed(key, n, ["id", "dir"]), prefixed(key, e, ["source", "target"])
        nodes = n if nodes is None else nodes.unionByName(n, allowMissingColumns=True)
        edges = e if edges is None else edges.unionByName(e, allowMissingColumns=True)
    return nodes, edges


# --- traversal -----------------------------------------------------------------


def subgraph(nodes: DataFrame, edges: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with the given (bundle, id) and the edges that have both ends among them."""
    kept = nodes.join(ids.select("bundle", "id"), ["bundle", "id"], "left_semi")
    for end in ("source", "target"):
        edges = edges.join(ids.select("bundle", F.col("id").alias(end)), ["bundle", end], "left_semi")
    return kept, edges


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("source").alias("a"), F.col("target").alias("b")),
                   F.struct(F.col("target").alias("a"), F.col("source").alias("b")))
    return edges.select("bundle", F.inline(ends)).distinct()


def _next_hop(adjacent: DataFrame, frontier: DataFrame, visited: DataFrame) -> DataFrame:
    """Unvisited neighbours of the frontier.

    Edges are the streamed side, so a hub is split by the adaptive skew join; neighbours are
    reduced to one row each before they meet the visited set.
    """
    reached = adjacent.join(frontier.select("bundle", F.col("id").alias("a")), ["bundle", "a"])
    fresh = reached.select("bundle", F.col("b").alias("id")).distinct()
    return fresh.join(visited.select("bundle", "id"), ["bundle", "id"], "left_anti")


def n_hop(edges: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """Nodes within ``hops`` undirected steps of the (bundle, id) seeds; 0 hops: the seeds."""
    adjacent = cut_lineage(_both_ways(edges))
    visited = layer = cut_lineage(seeds.select("bundle", "id").distinct().select("bundle", "id", F.lit(0).alias("hop")))
    for hop in range(1, hops + 1):
        layer = cut_lineage(_next_hop(adjacent, layer, visited).withColumn("hop", F.lit(hop)))
        if layer.isEmpty():
            break
        visited = visited.unionByName(layer)
    return visited


_PAIR = ["bundle", "start", "end"]


def _work(layer: DataFrame, degree: DataFrame) -> int:
    """Edges that a step from a layer follows."""
    return layer.join(degree, ["bundle", "id"]).agg(F.sum("degree")).first()[0] or 0


def _step(adjacent: DataFrame, layers: list[DataFrame], side: str, open_: DataFrame) -> DataFrame:
    """(bundle, side, id, near): edges of the last layer to nodes that are new to it; in an undirected graph, the others are in the last two layers."""
    frontier = layers[-1].join(open_.select("bundle", side), ["bundle", side], "left_semi").select("bundle", side, F.col("id").alias("a"))
    found = adjacent.join(frontier, ["bundle", "a"]).select("bundle", side, F.col("b").alias("id"), F.col("a").alias("near"))
    for seen in layers[-2:]:
        found = found.join(seen, ["bundle", side, "id"], "left_anti")
    return found


def _search(edges: DataFrame, pairs: DataFrame) -> tuple[list[DataFrame], list[DataFrame], list[tuple[int, int, DataFrame]]]:
    """Layers around all starts and all ends, until every pair has met or cannot.

    Of the two sides, the one whose last layer has fewer edges takes the next step, so a hub between a pair is entered from
    the side it is small for. Returned are the smallest parent of every node towards its start, layer by layer; all edges
    towards an end, layer by layer; and (steps from the start, steps from the end, pairs with the nodes where they met).
    """
    adjacent = cut_lineage(_both_ways(edges))
    degree = cut_lineage(adjacent.groupBy("bundle", F.col("a").alias("id")).agg(F.count("*").alias("degree")))
    layers = {side: [cut_lineage(pairs.select("bundle", side, F.col(side).alias("id")).distinct())] for side in ("start", "end")}
    work = {side: _work(layers[side][0], degree) for side in layers}
    steps: dict[str, list[DataFrame]] = {"start": [], "end": []}
    met, open_ = [], pairs
    while True:
        ahead, behind = layers["start"][-1], layers["end"][-1]
        now = cut_lineage(open_.join(ahead, ["bundle", "start"]).join(behind, ["bundle", "end", "id"], "left_semi").select(*_PAIR, "id"))
        if not now.isEmpty():
            met.append((len(steps["start"]), len(steps["end"]), now))
            open_ = open_.join(now, _PAIR, "left_anti")
        # a side with nothing left to visit meets no one
        open_ = cut_lineage(open_.join(ahead, ["bundle", "start"], "left_semi").join(behind, ["bundle", "end"], "left_semi"))
        if open_.isEmpty():
            return steps["start"], steps["end"], met
        side = min(work, key=work.get)
        found = _step(adjacent, layers[side], side, open_)
        if side == "start":
            found = found.groupBy("bundle", side, "id").agg(F.min("near").alias("near"))
        steps[side].append(cut_lineage(found))
        reached = steps[side][-1].select("bundle", side, "id")
        layers[side] = [layers[side][-1], reached if side == "start" else cut_lineage(reached.distinct())]
        work[side] = _work(layers[side][-1], degree)


def shortest_paths(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """(bundle, start, end, step, id) along a shortest undirected path of every pair (bundle, start, end); none where there is no path.

    Between equally short paths the one with the smallest predecessor at each node is taken. All pairs are searched together,
    from both ends. From where a pair met, the edges towards its end are followed once more, all of them, so that every node on
    the way knows its smallest predecessor; then each path is read back from its end, a row per pair and step.
    """
    pairs = cut_lineage(pairs.select(*_PAIR).distinct())
    above, towards, met = _search(edges, pairs)
    if not met:
        return pairs.select(*_PAIR, F.lit(0).alias("step"), F.col("end").alias("id")).where("false")
    before: list[DataFrame] = [pairs] * len(towards)  # by steps from the end: (pair, id, near), near a step closer to the start
    current = None
    for back in range(len(towards), 0, -1):
        for _, b, now in met:
            if b == back:
                current = now if current is None else current.unionByName(now)
        if current is not None:
            last = current.join(towards[back - 1], ["bundle", "end", "id"]).groupBy(*_PAIR, F.col("near").alias("_to")).agg(F.min("id").alias("near"))
            before[back - 1] = cut_lineage(last.withColumnRenamed("_to", "id"))
            current = before[back - 1].select(*_PAIR, "id")

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # every pair with its length, at its end
    found = cut_lineage(union([now.select(*_PAIR, F.lit(f).alias("ahead"), F.lit(b).alias("behind")).distinct() for f, b, now in met]))
    at = found.select("*", (F.col("ahead") + F.col("behind")).alias("step"), F.col("end").alias("id"))
    path, meeting = [at], []
    for back in range(max(b for _, b, _ in met) + 1):
        meeting.append(at.where(F.col("behind") == back))
        if back < len(towards):
            at = at.where(F.col("behind") > back).join(before[back], [*_PAIR, "id"])
            at = cut_lineage(at.select(*_PAIR, "ahead", "behind", (F.col("step") - 1).alias("step"), F.col("near").alias("id")))
            path.append(at)
    at = cut_lineage(union(meeting))
    for hop in range(max(f for f, _, _ in met), 0, -1):
        moved = at.where(F.col("step") == hop).join(above[hop - 1], ["bundle", "start", "id"])
        moved = moved.select(*_PAIR, "ahead", "behind", (F.col("step") - 1).alias("step"), F.col("near").alias("id"))
        at = cut_lineage(at.where(F.col("step") < hop).unionByName(moved))
        path.append(at.where((F.col("step") == hop - 1) & (F.col("ahead") >= hop)))
    return cut_lineage(union(path).select(*_PAIR, "step", "id"))


def shortest_path(edges: DataFrame, bundle: str, start: str, end: str) -> DataFrame:
    """(step, id) along a shortest undirected path of any length; empty when there is none. See ``shortest_paths``."""
    pair = edges.sparkSession.createDataFrame([(bundle, start, end)], "bundle string, start string, end string")
    return shortest_paths(edges.where(F.col("bundle") == bundle), pair).select("step", "id").orderBy("step")
