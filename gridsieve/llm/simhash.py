"""SimHash near duplicates through a hierarchical index in Gray order.

Upper levels of the index are *masked bit patterns*.  Two fingerprints that differ in at most
two bits agree in one of three blocks of bits, so every fingerprint stands below three patterns,
and only fingerprints below the same pattern are compared.  A pattern with more than
``MAX_GROUP`` distinct fingerprints is split the same way over the bits that are still free:
43, 29, 20 and at last 14 or fewer.  A group is therefore bounded by construction, and no link
is lost.  Levels are plain joins and counts on Spark.

Lower levels live inside a group, whatever its size: fingerprints sorted by Gray rank, eight to
a node; a node holds the bits on which all below agree and that its parents do not hold yet.  A
search adds up differences from the root of its group and leaves a whole node as soon as they
pass the limit, or when all below already are in the component of the query.

Copies share a fingerprint and enter once.  Every group returns a forest of links (at most one
per member); components are closed over them on Spark.

Defined results: null text counts as empty; a text of fewer words than a shingle is one
shingle, one without words has fingerprint zero and links like any other; repeated rows share
the result; a null doc_id gets a component but is never its name (a component of such rows
only is null); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsieve.llm.common import keep, keep_for_join, map_batches
from gridsieve.llm.components import connected

SHINGLE_WORDS, MAX_BITS = 3, 2
SEED = 42
MAX_GROUP = 16_384
LEVELS = 4
FAN = 8
# Rows searched at once: at least these, and as many as may meet about _PAIRS leaves.
_QUERIES, _PAIRS = 256, 1 << 19
_LINE = 1 << 16

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) < words:
        spans = [(0, len(line))]
    else:
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(sizes + 1) - 1
        spans = list(zip((ends - sizes)[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist()))
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for k in range(0, len(spans), _LINE):
        raw = b"".join([digest(line[a:b], SEED) for a, b in spans[k : k + _LINE]])
        columns = np.frombuffer(raw, np.uint8).reshape(-1, 8)
        for byte in range(8):
            ones[byte * 8 : byte * 8 + 8] += np.bincount(columns[:, byte], minlength=256) @ _BITS
    return int.from_bytes(np.packbits(2 * ones > len(spans)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, code (the fingerprint as a signed long), text_sha256; kept in the shared folder."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        codes = np.array([fingerprint(t, words) for t in texts], np.uint64)
        shas = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(codes.view(np.int64)), pa.array(shas, pa.string())],
            ["doc_id", "code", "text_sha256"],
        )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return keep(map_batches(read, work, "doc_id long, code long, text_sha256 string"))


def hex_code(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _parts(mask: int, parts: int) -> list[int]:
    """The mask joined with each of ``parts`` near-equal runs of the bits it lacks."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    return [mask | sum(1 << b for b in run.tolist()) for run in np.array_split(np.array(free, dtype=object), parts)]


def gray_rank(code: Column) -> Column:
    """Position of a code in the Gray sequence, shifted so that signed order is the order."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def groups(codes: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP, levels: int = LEVELS) -> DataFrame:
    """Rows (mask, pattern, code, node): each code below all index groups it has to meet.

    Groups of one are left out.  Groups above ``max_group`` are split until ``levels`` is reached.
    """
    children = {0: _parts(0, max_bits + 1)}
    members = codes.select("code", "node", F.lit(0).cast("long").alias("mask"))
    done: list[DataFrame] = []
    for level in range(1, levels + 1):
        table = F.create_map(
            *[x for m, subs in children.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(s)) for s in subs]))]
        )
        members = members.withColumn("mask", F.explode(table[F.col("mask")]))
        members = members.withColumn("pattern", F.col("code").bitwiseAND(F.col("mask")))
        sizes = keep_for_join(members.groupBy("mask", "pattern").agg(F.count("*").alias("size")).where("size > 1"))
        sized = members.join(sizes, ["mask", "pattern"])
        if level == levels:
            done.append(sized.drop("size"))
            break
        sized = keep(sized)
        done.append(sized.where(F.col("size") <= max_group).drop("size"))
        members = sized.where(F.col("size") > max_group).drop("size", "pattern")
        if members.isEmpty():
            break
        members = members.select("code", "node", "mask")
        children = {s: _parts(s, max_bits + 1) for subs in children.values() for s in subs}
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.select("mask", "pattern", "code", "node")


class GrayIndex:
    """Groups of codes, each in Gray order under a tree of nodes of shared bit patterns.

    ``group`` numbers the groups from 0 in the order of the rows, none for a single one; every group has one root.
    """

    def __init__(self, codes: np.ndarray, group: np.ndarray | None = None):
        group = np.zeros(len(codes), np.int64) if group is None else group
        self.codes, self.group = codes, group
        heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        shared_and, shared_or = codes, codes
        self.patterns, self.masks = [codes], [np.full(len(codes), 2**64 - 1, np.uint64)]
        # First child and number of children of the nodes one level up.
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        while len(shared_and) > len(heads):
            nodes = -(-np.diff(np.r_[heads, len(shared_and)]) // FAN)
            above = np.cumsum(nodes) - nodes
            first = np.repeat(heads - above * FAN, nodes) + np.arange(nodes.sum()) * FAN
            count = np.diff(np.r_[first, len(shared_and)])
            shared_and = np.bitwise_and.reduceat(shared_and, first)
            shared_or = np.bitwise_or.reduceat(shared_or, first)
            mask = ~(shared_and ^ shared_or)
            self.children.append((first, count))
            self.patterns.append(shared_and & mask)
            self.masks.append(mask)
            heads = above
        # What a parent holds is not held again below it.
        for k, (_, count) in enumerate(self.children):
            self.masks[k] = self.masks[k] & ~np.repeat(self.masks[k + 1], count)

    def search(self, asked: np.ndarray, max_bits: int, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links (query, member) within ``max_bits`` between different components of ``labels``."""
        low, high = [labels], [labels]
        for first, _ in self.children:
            low.append(np.minimum.reduceat(low[-1], first))
            high.append(np.maximum.reduceat(high[-1], first))
        query, node, spent = asked, self.group[asked], np.zeros(len(asked), np.int64)
        for k in range(len(self.masks) - 1, -1, -1):
            if k < len(self.children):
                first, count = self.children[k]
                several = count[node]
                begin = np.repeat(first[node] - (np.cumsum(several) - several), several)
                query, spent = np.repeat(query, several), np.repeat(spent, several)
                node = begin + np.arange(len(query))
            other = ~((low[k][node] == high[k][node]) & (low[k][node] == labels[query]))
            query, spent, node = query[other], spent[other], node[other]
            differ = (self.codes[query] ^ self.patterns[k][node]) & self.masks[k][node]
            spent = spent + np.bitwise_count(differ)
            near = spent <= max_bits
            query, spent, node = query[near], spent[near], node[near]
        return query, node


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the least index of its component) after linking a with b."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        np.minimum.at(labels, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (labels[labels] != labels).any():
            labels = labels[labels]


def link_forest(group: np.ndarray, codes: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """For rows sorted by group and Gray rank: the first row of each row's component in its group.

    Every group of two or more is searched through the index; groups of equal depth share one.
    """
    labels = np.arange(len(codes))
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(codes) else labels
    sizes = np.diff(np.r_[first, len(codes)])
    depth_of = np.zeros(len(sizes), np.int64)
    wide = sizes
    while (wide > 1).any():
        depth_of += wide > 1
        wide = -(-wide // FAN)
    by_row = np.repeat(depth_of, sizes)
    for depth in range(1, int(depth_of.max(initial=0)) + 1):
        rows = np.flatnonzero(by_row == depth)
        if not len(rows):
            continue
        index = GrayIndex(codes[rows], np.repeat(np.arange((depth_of == depth).sum()), sizes[depth_of == depth]))
        own = np.arange(len(rows))
        step = max(_QUERIES, _PAIRS // FAN**depth)
        for k in range(0, len(rows), step):
            query, member = index.search(np.arange(k, min(len(rows), k + step)), max_bits, own)
            own = _merge(own, query, member)
        labels[rows] = rows[own]
    return labels


def links(grouped: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between nodes: a spanning forest of every index group."""
    dealt = grouped.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", gray_rank(F.col("code")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 4), np.int64)
        for batch in batches:
            rows = np.column_stack([np.asarray(c, np.int64) for c in batch.columns]) if batch.num_rows else held[:0]
            rows = np.concatenate([held, rows])
            if not len(rows):
                continue
            # The last group may go on in the next batch.
            whole = int(np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1)).max(initial=-1)) + 1
            held = rows[whole:]
            yield from found(rows[:whole])
        yield from found(held)

    def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        group = np.cumsum(np.r_[0, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
        root = link_forest(group, np.ascontiguousarray(rows[:, 2]).view(np.uint64), max_bits)
        linked = np.flatnonzero(root != np.arange(len(rows)))
        if len(linked):
            a, b = rows[linked, 3], rows[root[linked], 3]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    max_group: int = MAX_GROUP,
    levels: int = LEVELS,
) -> DataFrame:
    """doc_id, code, component_id, kept, text_sha256 for every row of ``docs`` (doc_id, text).

    ``kept`` marks the copies of one row of each component: that with the least doc_id (null
    last), then the least text_sha256.
    """
    rows = fingerprints(docs, words)
    # A node stands for one fingerprint and is named by a number of its own.
    nodes = keep(
        rows.groupBy("code").agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_sha256")).alias("best"),
        ).withColumn("node", F.col("code"))
    )
    components = connected(links(groups(nodes, max_bits, max_group, levels), max_bits))
    named = nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = keep(named)
    heads = keep_for_join(
        named.groupBy(F.col("component").alias("c")).agg(
            F.min("least_id").alias("component_id"), F.min("best").alias("head")
        )
    )
    by_code = named.join(heads, named["component"] == heads["c"]).select(
        F.col("code").alias("of"), "component_id", "head"
    )
    mine = F.struct(F.col("doc_id").isNull(), "doc_id", "text_sha256")
    return rows.join(by_code, rows["code"] == by_code["of"]).select(
        "doc_id", "code", "component_id", mine.eqNullSafe(F.col("head")).alias("kept"), "text_sha256"
    )
