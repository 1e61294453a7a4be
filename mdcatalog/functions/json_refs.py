"""References inside a JSON document, followed within its row.

``nodes`` lists what references usually point to, as text under a decoded pointer; a pointer that goes deeper
is walked from there. Nothing is parsed twice per reference but the node itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Between the decoded steps of a pointer; JSON text cannot hold it unescaped.
STEP = "\u0001"
NODES = "array<struct<key:string,node:string>>"
_MAP, _LIST = "map<string,string>", "array<string>"


def children(text: Column, *above: str) -> Column:
    """Members of an object as ``NODES``, below the steps ``above``; nothing for anything else."""
    prefix = "".join(f"{step}{STEP}" for step in above)
    return F.coalesce(
        F.transform(F.map_entries(F.from_json(text, _MAP)), lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("key"), e["value"].alias("node"))),
        F.array().cast(NODES))


def grandchildren(text: Column, above: str) -> Column:
    """Members of an object's members, below ``above``."""
    return F.flatten(F.transform(children(text), lambda section: F.transform(
        children(section["node"]), lambda e: F.struct(F.concat(F.lit(above + STEP), section["key"], F.lit(STEP), e["key"]).alias("key"), e["node"].alias("node")))))


def target(node: Column) -> Column:
    """What a node refers to, null for a node that is no reference."""
    return F.from_json(node, "struct<`$ref`:string>")["$ref"]


def _steps(pointer: Column) -> Column:
    """Decoded steps of a pointer into the same document, null for any other."""
    def decoded(step: Column) -> Column:
        plain = F.coalesce(F.try_url_decode(F.replace(step, F.lit("+"), F.lit("%2B"))), step)
        return F.replace(F.replace(plain, F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~"))
    return F.when(pointer.startswith("#/"), F.transform(F.split(F.substring(pointer, 3, 1 << 30), "/", -1), decoded))


def look_up(pointer: Column, nodes: Column) -> Column:
    """The node a pointer names: the longest listed prefix, then step by step through objects and arrays; null if there is none."""
    def inside(state: Column, step: Column) -> Column:
        member = F.try_element_at(F.from_json(state, _MAP), step)
        element = F.when(step.rlike("^(0|[1-9][0-9]{0,8})$"), F.get(F.from_json(state, _LIST), F.try_to_number(step, F.lit("999999999")).cast("int")))
        return F.coalesce(member, element)

    def from_prefix(length: int, steps: Column) -> Column:
        key = F.array_join(F.slice(steps, 1, length), STEP)
        # of members with one name the last counts
        found = F.try_element_at(F.filter(nodes, lambda n: n["key"] == key), F.lit(-1))["node"]
        rest = F.when(F.size(steps) > length, F.slice(steps, length + 1, F.greatest(F.size(steps) - length, F.lit(1)))).otherwise(F.array().cast(_LIST))
        return F.when(F.size(steps) >= length, F.aggregate(rest, found, inside))

    # one evaluation of the steps, wherever they are used
    return F.get(F.transform(F.array(_steps(pointer)), lambda steps: F.when(steps.isNotNull(), F.coalesce(from_prefix(3, steps), from_prefix(2, steps)))), F.lit(0))


def aliases(nodes: Column) -> Column:
    """How many of the nodes are references themselves: the longest chain there can be."""
    return F.size(F.filter(nodes, lambda n: target(n["node"]).isNotNull()))


def resolve(node: Column, nodes: Column, depth: Column) -> Column:
    """A node, or what its chain of references ends in; null where that is a cycle or missing.

    ``depth``: the longest possible chain between listed nodes (``aliases``). Chains through nodes that are not listed are
    followed as far.
    """
    state = "struct<node:string,ref:string,seen:array<string>>"
    start = F.struct(node.alias("node"), target(node).alias("ref"), F.array().cast(_LIST).alias("seen")).cast(state)

    def follow(held: Column, _: Column) -> Column:
        def arrive(found: Column) -> Column:
            return F.struct(found.alias("node"), target(found).alias("ref"), F.array_append(held["seen"], held["ref"]).alias("seen")).cast(state)

        again = F.array_contains(held["seen"], held["ref"])
        gone = F.struct(F.lit(None).alias("node"), F.lit(None).alias("ref"), held["seen"].alias("seen")).cast(state)
        arrived = F.get(F.transform(F.array(look_up(held["ref"], nodes)), arrive), F.lit(0))
        return F.when(held["ref"].isNull(), held).when(again, gone).otherwise(arrived)

    return F.aggregate(F.sequence(F.lit(0), depth + 1), start, follow, lambda held: F.when(held["ref"].isNull(), held["node"]))
