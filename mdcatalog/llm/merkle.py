"""Merkle manifest of a table with a witness per row, built by streaming aligned appends.

Leaves are ranked per tree and dealt in aligned blocks of 8^4. A task appends the leaves of a block in order:
a leaf gets a partial witness in every run that is still open above it, and each sibling subtree completed
later extends the witnesses of the run. The roots of the blocks are the leaves of the next pass, and so on until
a tree has one root; the roots of all trees are then appended to the tree above them in the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdcatalog.llm.common import as_table, sized_join, small_batches

#: Nodes of a run, and levels of a block.
RUN = 8
BLOCK_LEVELS = 4
BLOCK = RUN ** BLOCK_LEVELS
#: Characters of a digest.
DIGEST = 64
#: Leaves of one batch of results.
OUT_ROWS = 512

_WITNESS = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.string())]))
_PROVEN = "key bigint, claimed string, tree string, rank bigint, leaf string, subroot string, root string, witness array<struct<place:int,siblings:string>>"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """The digest of a row: each value as its UTF-8 length, a colon and its text, or ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


class Block:
    """Open runs of a block, a list of digests per level. A witness refers to the runs themselves, so that a
    digest that is added to a run later stands in the witnesses of all leaves below it."""

    def __init__(self, size: int):
        """``size``: nodes of the whole tree, of which the block may be one of many."""
        self.height = 0
        while self.height < BLOCK_LEVELS and RUN ** self.height < size:
            self.height += 1
        self.runs: list[list[str]] = [[] for _ in range(self.height)]
        self.first = [0] * self.height  # leaf at which each open run begins
        self.witnesses: list[list[tuple[int, list[str]]]] = []
        self.root: str | None = None

    def append(self, leaf: str) -> None:
        self.witnesses.append([])
        self._add(0, leaf, len(self.witnesses) - 1)

    def _add(self, level: int, node: str, begin: int) -> None:
        """Add the root of the leaves from ``begin`` on to the open run of ``level``."""
        if level == self.height:
            self.root = node
            return
        run = self.runs[level]
        if not run:
            self.first[level] = begin
        for leaf in range(begin, len(self.witnesses)):
            self.witnesses[leaf].append((len(run), run))
        run.append(node)
        if len(run) == RUN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        self._add(level + 1, digest(*run), self.first[level])

    def close(self) -> str:
        """Complete what is open, a run of one too, and return the block's root."""
        for level in range(self.height):
            if self.runs[level]:
                self._complete(level)
        return self.root

    def witness(self, leaf: int) -> list[tuple[int, str]]:
        """(place in the run, the run's other digests) per level."""
        return [(place, "".join(run[:place] + run[place + 1:])) for place, run in self.witnesses[leaf]]


def _ranked(rows: DataFrame) -> DataFrame:
    """(tree, key, digest, claimed, rank, size): the rank of each row in its tree by key, digest and row.

    Sorted in ranges; only the number of rows of each range and tree are summed, in a table of as many rows.
    """
    place = F.monotonically_increasing_id()
    held = as_table(rows.repartitionByRange("tree", "key", "digest", "row").sortWithinPartitions("tree", "key", "digest", "row").drop("row")
                    .withColumn("part", F.shiftright(place, 33)).withColumn("at", place.bitwiseAND((1 << 33) - 1)))
    parts = held.groupBy("part", "tree").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = Window.partitionBy("tree")
    before = trees.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = as_table(parts.select("part", "tree", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base"), F.sum("n").over(trees).alias("size")))
    return sized_join(held, bases, ["part", "tree"]).select("tree", "key", "digest", "claimed", (F.col("base") + F.col("at")).alias("rank"), "size")


def _dealt(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """Nodes of one block in one task and in order, behind the block's row of ``above``."""
    block = F.floor(F.col("rank") / BLOCK)
    rows = nodes.select("tree", block.alias("block"), "rank", "digest", "key", "claimed", "size")
    if above is not None:
        rows = rows.unionByName(above.select("tree", F.col("rank").alias("block"), F.lit(-1).cast("bigint").alias("rank"), F.col("leaf").alias("digest"),
                                             "subroot", "root", "witness"), allowMissingColumns=True)
    small_batches(nodes.sparkSession)
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, dict | None, list[dict], Block]]:
    """(tree, block, size, row above, leaves, closed block) of each block of a task."""
    at, block, above, leaves = None, None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            here = row["tree"], row["block"]
            if here != at:
                if block is not None:
                    block.close()
                    yield *at, leaves[0]["size"], above, leaves, block
                at, block, above, leaves = here, None, None, []
            if row["rank"] < 0:
                above = row
                continue
            if block is None:
                block = Block(row["size"])
            block.append(row["digest"])
            leaves.append(row)
    if block is not None:
        block.close()
        yield *at, leaves[0]["size"], above, leaves, block


def _roots(nodes: DataFrame) -> DataFrame:
    """The next pass's nodes: a root per block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tree", "rank", "digest", "size"]
        rows: list[tuple] = []
        for tree, number, size, _, _, block in _blocks(batches):
            rows.append((tree, number, block.root, -(-size // BLOCK)))
            if len(rows) >= OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    nothing = {"key": F.lit(None).cast("bigint"), "claimed": F.lit(None).cast("string")}
    return as_table(_dealt(nodes, None).mapInArrow(run, "tree string, rank bigint, digest string, size bigint").withColumns(nothing))


def _witnessed(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes with subroot, root and the witness from the node to the root: that in the block and that of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, _, _, upper, leaves, block in _blocks(batches):
            beyond = [(w["place"], w["siblings"]) for w in upper["witness"]]
            for begin in range(0, len(leaves), OUT_ROWS):
                part = leaves[begin:begin + OUT_ROWS]
                steps = [block.witness(begin + i) + beyond for i in range(len(part))]
                offsets = [0]
                for s in steps:
                    offsets.append(offsets[-1] + len(s))
                flat = [x for s in steps for x in s]
                pairs = pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.int32()), pa.array([x[1] for x in flat], pa.string())], names=["place", "siblings"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["key"] for r in part], pa.int64()), pa.array([r["claimed"] for r in part], pa.string()), pa.array([tree] * len(part), pa.string()),
                     pa.array([r["rank"] for r in part], pa.int64()), pa.array([r["digest"] for r in part], pa.string()),
                     pa.array([upper["subroot"]] * len(part), pa.string()), pa.array([upper["root"]] * len(part), pa.string()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)],
                    names=["key", "claimed", "tree", "rank", "leaf", "subroot", "root", "witness"])

    return _dealt(nodes, above).mapInArrow(run, _PROVEN)


def _passes(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of each pass; those of the last are one per tree."""
    out = [nodes]
    while out[-1].where("size > 1").limit(1).count():
        out.append(_roots(out[-1]))
    return out


def _descend(passes: list[DataFrame], above: DataFrame) -> DataFrame:
    """Witnesses of the first pass's nodes, given those of the last pass's; all but the large first are written."""
    for number in range(len(passes) - 2, -1, -1):
        above = _witnessed(passes[number], above)
        if number:
            above = as_table(above)
    return above


def manifest(rows: DataFrame, fields: list[str], tree: str, key: str, claimed: Column | None = None) -> DataFrame:
    """(key, claimed, tree, rank, leaf, subroot, root, witness) per row of ``rows``.

    A leaf is the digest of ``fields``. The leaves of a tree ascend by key, null first, then digest; equal rows are
    leaves of their own. Trees ascend by their value as text, null first. ``witness`` holds, from the leaf up
    to the root of all trees, the place in each run and the digests of the run's other nodes. ``claimed`` is a digest to be verified
    instead of the leaf. Other columns are ignored, an empty table gives no rows. No tree and no key gathers in
    one task: ranges split equal keys, and a task holds one block of 4,096 leaves at a time.
    """
    own = leaf_digest(*[F.col(f) for f in fields])
    name = F.col(tree).cast("string")
    # null first: the mark before the value keeps the order and is never null
    leaves = as_table(rows.select(F.coalesce(F.concat(F.lit("1"), name), F.lit("0")).alias("tree"), F.col(key).cast("bigint").alias("key"), own.alias("digest"),
                                  (own if claimed is None else claimed).alias("claimed")).withColumn("row", F.monotonically_increasing_id()))
    forest = _passes(_ranked(leaves))
    tops = forest[-1].select(F.lit("").alias("tree"), F.lit(None).cast("bigint").alias("key"), F.col("tree").alias("claimed"), "digest")
    # the trees' names are the order of their roots
    ordered = _ranked(tops.select("tree", "key", F.col("claimed").alias("digest"), F.col("digest").alias("claimed")).withColumn("row", F.lit(0)))
    upper = _passes(ordered.select("tree", "key", F.col("claimed").alias("digest"), F.col("digest").alias("claimed"), "rank", "size"))
    root = upper[-1].select("digest").first()
    nowhere = F.array().cast("array<struct<place:int,siblings:string>>")
    least = upper[-1].select("key", "claimed", "tree", "rank", F.col("digest").alias("leaf"), F.lit(None).cast("string").alias("subroot"),
                             F.lit(root["digest"] if root else None).cast("string").alias("root"), nowhere.alias("witness"))
    proven = _descend(upper, least)
    subroots = as_table(proven.select("key", F.lit(None).cast("string").alias("claimed"), F.col("claimed").alias("tree"), F.lit(0).cast("bigint").alias("rank"), "leaf",
                                      F.col("leaf").alias("subroot"), "root", "witness"))
    if len(forest) == 1:  # every tree is one leaf
        out = forest[0].select("tree", "key", "claimed", "rank").join(subroots.drop("key", "claimed", "rank"), "tree")
    else:
        out = _descend(forest, subroots)
    return out.withColumn("tree", F.when(F.col("tree") != "0", F.substring("tree", 2, 1 << 30)))


def fold(node: Column, witness: Column) -> Column:
    """The root that a leaf's digest and a witness lead to."""
    def step(held: Column, w: Column) -> Column:
        before = w["place"] * DIGEST
        return F.sha2(F.concat(F.substr(w["siblings"], F.lit(1), before), held, F.substr(w["siblings"], before + 1)), 256)
    return F.aggregate(witness, node, step)


def proof_digest(witness: Column) -> Column:
    """The digest of all siblings, level by level up to the root, left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda w: w["siblings"]), ""), 256)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def audit_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per document, a tree per language.

    Documents whose id's decimal text has a CRC-32 divisible by 3 are verified with their text in lower case (A to Z);
    a null id, and a null text, are never changed. See ``manifest`` for repeated rows and empty tables.
    """
    changed = leaf_digest(*[F.translate("text", _UPPER, _LOWER) if f == "text" else F.col(f) for f in FIELDS])
    own = leaf_digest(*[F.col(f) for f in FIELDS])
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, changed).otherwise(own)
    proven = manifest(docs, FIELDS, "lang", "doc_id", claimed)
    return (proven.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("witness")).alias("proof_sha256"),
                          fold(F.col("claimed"), F.col("witness")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def oracle(levels: int = 9, upper: int = 5) -> str:
    """SQL of ``audit_documents`` for trees of up to 8^levels leaves and 8^upper trees."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(field(text if f == "text" else f) for f in FIELDS) + ")"
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    sql = [f"""
WITH crcs AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v FROM range(256) r(i))),
d AS (SELECT *, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::INTEGER + 1])), 4294967295::UBIGINT) AS crc FROM documents, crcs),
l AS (SELECT doc_id, coalesce('1' || lang, '0') AS tree, {leaf('text')} AS leaf, CASE WHEN crc % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS claimed FROM d),
f0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, claimed AS fold, '' AS proof FROM l),
n0 AS (SELECT tree, i, leaf AS d, count(*) OVER (PARTITION BY tree) AS c FROM f0)"""]

    def climb(k: int) -> None:
        sql.append(f"""
r{k} AS (SELECT tree, i // 8 AS g, list(d ORDER BY i) AS ds, any_value(c) AS c FROM n{k} GROUP BY tree, i // 8),
n{k + 1} AS (SELECT tree, g AS i, CASE WHEN c > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d, count(*) OVER (PARTITION BY tree) AS c FROM r{k}),
f{k + 1} AS (SELECT f.* REPLACE (i // 8 AS i,
    CASE WHEN c > 1 THEN sha256(array_to_string(ds[1:i % 8], '') || fold || array_to_string(ds[i % 8 + 2:], '')) ELSE fold END AS fold,
    CASE WHEN c > 1 THEN proof || array_to_string(ds[1:i % 8], '') || array_to_string(ds[i % 8 + 2:], '') ELSE proof END AS proof)
    FROM f{k} f JOIN r{k} r ON r.tree = f.tree AND r.g = f.i // 8)""")

    for k in range(levels):
        climb(k)
    k = levels + 1
    sql.append(f"""
s AS (SELECT tree AS name, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i FROM n{levels}),
n{k} AS (SELECT '' AS tree, i, subroot AS d, count(*) OVER () AS c FROM s),
f{k} AS (SELECT doc_id, '' AS tree, leaf, subroot, s.i, fold, proof FROM f{levels} f JOIN s ON s.name = f.tree)""")
    for k in range(levels + 1, levels + 1 + upper):
        climb(k)
    return ",".join(sql) + f"""
SELECT doc_id, leaf, subroot, n.d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = n.d AS verified FROM f{k + 1}, n{k + 1} n
"""
