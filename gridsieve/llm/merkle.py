"""Merkle manifest of a document table: leaves, subroots per source, one root, proofs per document.

Every *block* of 256 consecutive nodes keeps its levels as hex strings: 256 digests, and the 16
parents made of them.  Fixed-width substrings of a level are the runs whose hashes are the next
level; the substrings left and right of a digest in its run are the siblings of its proof.  The
node above a block is a leaf of the next, smaller table of blocks, until every group has one
block; the subroots of the sources are the leaves of one more such tree.  Proofs are read off
downwards: what lies above a block is the same for all its nodes, so it is joined once per block.

A block holds 256 rows, whatever the size of a source, and rows are numbered by range partitions
and per-partition offsets, so no source has to fit into a task.

Defined results: rows ascend by doc_id, a null doc_id first, rows of one doc_id by leaf; a null
source is a source of its own, before all others; repeated rows have a leaf each; a row without a
doc_id is never tampered with; a proof without siblings is the digest of nothing; an empty table
gives an empty result; columns that are absent count as null, further ones are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridsieve.llm.common import keep
from gridsieve.scale import lookup_join

FAN_OUT = 16
BLOCK = FAN_OUT * FAN_OUT
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """A value with its length in bytes, so that no two rows spell the same; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text as an intruder leaves it: of every fifth document (by crc32 of its id) in lower case."""
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate(text, UPPER, LOWER)).otherwise(text)


def leaves(docs: DataFrame) -> DataFrame:
    """group, doc_id, leaf, and ``changed``, the leaf after tampering where the text differs.

    ``group`` spells the source so that a null one is a key as well and comes first.
    """
    value = {c: F.col(c) if c in docs.columns else F.lit(None).cast("string") for c in FIELDS}
    value["doc_id"] = value["doc_id"].cast("long")
    other = tampered(value["doc_id"], value["text"])
    return docs.select(
        F.coalesce(F.concat(F.lit("="), value["source"].cast("string")), F.lit("")).alias("group"),
        value["doc_id"].alias("doc_id"),
        leaf([value[c] for c in FIELDS]).alias("leaf"),
        F.when(other != value["text"], leaf([*(value[c] for c in FIELDS[:-1]), other])).alias("changed"),
    )


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, their place from 0 in their group; written once.

    Partitions are ranges of (group, order).  Written rows carry their place in the partition, and
    only the first group of a partition can have begun in an earlier one, so the rest needs one
    number per partition and group.
    """
    keys = [group, *order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    written = keep(placed.withColumn("at", F.monotonically_increasing_id()))
    slot = F.shiftright("at", 33)
    parts = keep(written.groupBy(group, slot.alias("slot")).agg(F.min("at").alias("first"), F.count("*").alias("n")))
    before = Window.partitionBy(group).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select(
        group, "slot", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("base")
    )
    joined = lookup_join(written.withColumn("slot", slot), base, [group, "slot"], "inner", parts.count())
    return joined.withColumn("pos", F.col("at") - F.col("base")).drop("at", "base", "slot")


def _runs(level: Column) -> Column:
    """The runs of a level, one after another."""
    width = FAN_OUT * HEX
    many = F.ceil(F.length(level) / width).cast("int")
    return F.transform(F.sequence(F.lit(0), many - 1), lambda k: F.substring(level, k * width + 1, F.lit(width)))


def blocks(nodes: DataFrame, members: Sequence[str]) -> DataFrame:
    """group, block, rows, level0, level1, node of ``nodes`` (group, pos, node, members); written.

    A group that ends in its first block stops where one node is left; every other block, the
    last and shorter one as well, goes up all levels.
    """
    gathered = nodes.groupBy("group", F.floor(F.col("pos") / BLOCK).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "node", *members))).alias("rows")
    )
    levels = gathered.withColumn("level0", F.array_join(F.col("rows.node"), "")).withColumn(
        "level1", F.array_join(F.transform(_runs(F.col("level0")), digest), "")
    )
    alone = F.col("block") == 0
    node = (
        F.when(alone & (F.size("rows") == 1), F.col("level0"))
        .when(alone & (F.size("rows") <= FAN_OUT), F.col("level1"))
        .otherwise(digest(F.col("level1")))
    )
    return keep(levels.withColumn("node", node))


def climb(nodes: DataFrame, members: Sequence[str]) -> list[DataFrame]:
    """Tables of blocks, from the leaves up to the one in which every group has one block."""
    tables = [blocks(nodes, members)]
    while tables[-1].agg(F.max("block").alias("b")).first()["b"]:
        tables.append(blocks(tables[-1].select("group", F.col("block").alias("pos"), "node"), []))
    return tables


def _beside(level: Column, at: Column) -> Column:
    """What stands left and right of a digest in its run."""
    width = FAN_OUT * HEX
    run = F.substring(level, F.floor(at / FAN_OUT).cast("int") * width + 1, F.lit(width))
    inner = at % FAN_OUT
    return F.struct(
        F.substring(run, F.lit(1), inner * HEX).alias("left"),
        F.substring(run, (inner + 1) * HEX + 1, F.lit(width)).alias("right"),
    )


def _path(at: Column) -> Column:
    """Siblings of the block's ``at``-th node on every level that the block has below its own node."""
    size, alone = F.size("rows"), F.col("block") == 0
    first = _beside(F.col("level0"), at)
    second = _beside(F.col("level1"), F.floor(at / FAN_OUT).cast("int"))
    none = F.slice(F.array(first), 1, 0)
    return (
        F.when(alone & (size == 1), none)
        .when(alone & (size <= FAN_OUT), F.array(first))
        .otherwise(F.array(first, second))
    )


def paths(tables: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest table of blocks with ``path``, the siblings above each block.

    ``above`` (group, path, ...) tells what follows over the node of a group; its further columns
    are handed down.  Each join is one block to its at most 256 nodes, so no key is hot.
    """
    carried = [c for c in above.columns if c not in ("group", "path")]
    found = tables[-1].join(above, "group")
    for lower in reversed(tables[:-1]):
        steps = _members(found, "row.pos AS block", *carried)
        found = lower.join(keep(steps), ["group", "block"])
    return found


def _members(found: DataFrame, *columns: str) -> DataFrame:
    """Every node of the blocks: group, path (siblings from the node up to the root), columns."""
    each = found.select("*", F.posexplode("rows").alias("at", "row"))
    return each.select("group", F.concat(_path(F.col("at")), F.col("path")).alias("path"), *map(F.expr, columns))


def fold(node: Column, path: Column) -> Column:
    """The root that a node and its siblings give."""
    return F.aggregate(path, node, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def proof(path: Column) -> Column:
    """All siblings in one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


_NOTHING = "CAST(array() AS ARRAY<STRUCT<left: STRING, right: STRING>>) AS path"


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, source for every row of ``docs``."""
    nodes = numbered(keep(leaves(docs)), "group", ["doc_id", "leaf"]).withColumnRenamed("leaf", "node")
    tables = climb(nodes, ["doc_id", "changed"])
    # the node of a group's one block is its subroot; the subroots make a tree of their own
    subroots = tables[-1].select(F.lit("").alias("group"), F.col("group").alias("source"), "node")
    upper = climb(numbered(subroots, "group", ["source"]), ["source"])
    root = upper[-1].select("group", F.expr(_NOTHING), F.col("node").alias("root"))
    above = _members(paths(upper, root), "row.source", "row.node AS subroot", "root").drop("group")
    below = paths(tables, keep(above.withColumnRenamed("source", "group")))
    proven = _members(below, "row", "subroot", "root")
    folded = proven.withColumn("folded_root", fold(F.coalesce("row.changed", "row.node"), F.col("path")))
    return folded.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.node").alias("leaf"),
        "subroot",
        "root",
        digest(proof(F.col("path"))).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
        F.when(F.col("group") != "", F.substring("group", 2, 2**31 - 1)).alias("source"),
    )
