"""Shared helpers for joins, numbering and scratch space on large clusters.

Every join in the package has a large side (cells, pixels, series rows, request
items) and a lookup side (spans, tiles, catalog entries, manifests).  The lookup
side is broadcast only when a row bound that was worked out beforehand stays
below a limit.  Beyond it the same join runs as a shuffle join whose hot keys are counted
and spread over several tasks; the result is the same.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows of a lookup table that may be sent to every executor.  The lookup tables
# here are at most some hundred bytes wide, so this stays near 100 MB.
BROADCAST_ROW_LIMIT = 1_000_000

# Without a broadcast, rows of a hot key are dealt to this many slices for every task's fair share of
# rows that the key holds, and its lookup rows are repeated for each slice.  A key is hot with
# more than one of HOT_SHARE parts of the rows, so there are fewer than HOT_SHARE hot keys.
SLICES = 8
HOT_SHARE = 64

# Counters of the first pass over the keys; the counter of a hot key is hot as well.
_COUNTERS = 65_536

# A dealt join moves rows of the large side in blocks of about so many, and gives a group of owners about so
# many pairs to test and at most so many owners.  A task sorts the rows of a group, so more of them spill more;
# more groups repeat more blocks.  Below the least number of pairs a group is not worth a task.
BLOCK_ROWS = 2_048
GROUP_PAIRS = 1 << 27
GROUP_OWNERS = 4_096
LEAST_PAIRS = 1 << 16
GROUPS_PER_CORE = 4
# Blocks of a key that meet their lookup rows in one task, where these are not broadcast.
BLOCKS_TOGETHER = 64


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session (tests, a laptop) that names none gets a temporary folder, set as
    its checkpoint folder; executors of a cluster could not read it, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        root = context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gridsieve-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    name = spark.sql("SELECT uuid() AS u").first()["u"]
    return f"{root.rstrip('/')}/gridsieve-{name}"


def materialise(df: DataFrame) -> DataFrame:
    """Work a small derived table out once and keep it in the checkpoint folder.

    For lookup tables that are counted first and joined afterwards.  A checkpoint
    lies in shared storage, so it outlives the executors that made it.
    """
    if not df.sparkSession.sparkContext.getCheckpointDir():
        scratch_dir(df.sparkSession)
    return df.checkpoint()


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str,
    rows: int,
    residual: Column | None = None,
    limit: int = BROADCAST_ROW_LIMIT,
    slices: int = SLICES,
) -> DataFrame:
    """Join ``large`` to ``lookup`` on ``keys`` and an optional ``residual``.

    ``rows`` is an upper bound for the rows of ``lookup``.  Key columns of the
    lookup side are dropped from the result; all its other columns must have
    names that ``large`` does not use, so that ``residual`` is unambiguous.

    Without a broadcast the hot keys of ``large`` are counted first; only their rows are dealt
    to slices and only their lookup rows are repeated, as often as their size asks for.
    """
    renamed = lookup.withColumnsRenamed({k: f"__lookup_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"__lookup_{k}"))
    if residual is not None:
        condition = condition & residual
    drop = [f"__lookup_{k}" for k in keys]
    if rows <= limit:
        return large.join(F.broadcast(renamed), condition, how).drop(*drop)
    parts = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = {key: math.ceil(share * parts * slices) for key, share in hot_keys(large, keys).items()}
    if not many:
        return large.join(renamed.hint("merge"), condition, how).drop(*drop)

    def slices_of(names: Sequence[str]) -> Column:
        key = _key_hash(names)
        return F.coalesce(*[F.when(key == F.lit(k), F.lit(n)) for k, n in many.items()], F.lit(1))

    # a row's place is the same when a task is run again; the partition parts rows that are copies
    salted = large.withColumn("__slice", F.pmod(F.xxhash64(F.spark_partition_id(), *_row(large)), slices_of(keys)).cast("int"))
    copies = renamed.withColumn("__lookup_slice", F.explode(F.sequence(F.lit(0), slices_of(drop) - 1)))
    condition = condition & (F.col("__slice") == F.col("__lookup_slice"))
    return salted.join(copies.hint("merge"), condition, how).drop("__slice", "__lookup_slice", *drop)


def dealt_join(
    large: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    owner: str,
    residual: Column | None = None,
    limit: int = BROADCAST_ROW_LIMIT,
    block: int = BLOCK_ROWS,
    pairs: int = GROUP_PAIRS,
) -> DataFrame:
    """Rows of an inner :func:`lookup_join`, sorted by ``owner`` in partitions, for a write of a folder for each owner.

    ``owner`` is a column of ``lookup``.  Its rows lie in one partition, or in as many as their number asks for.
    Joined rows are not shuffled, as they may be very many for each row of ``large``.  Owners that are near each other in
    the order of ``keys`` form groups; rows of ``large`` go in blocks, with the lookup rows that they meet, once to
    each group that has a use for them, and are joined there.  A lookup row that is null in ``owner`` is an owner's as well.
    """
    cores = large.sparkSession.sparkContext.defaultParallelism
    counts = materialise(large.groupBy(*keys).agg(F.count("*").alias("__n")))
    known = materialise(lookup_join(lookup, counts, keys, "inner", counts.count(), limit=limit))
    met = materialise(
        known.select(
            *keys,
            F.ceil(F.col("__n") / block).alias("__blocks"),
            F.ceil(F.col("__n") / (block * BLOCKS_TOGETHER)).alias("__salts"),
        ).distinct()
    )
    # an owner's rows are at most those of its keys
    owners = known.groupBy(F.col(owner).alias("__owner")).agg(
        F.sum("__n").alias("__pairs"), F.min(F.struct(*[F.col(k) for k in keys])).alias("__first")
    )
    owners = materialise(owners)
    total = owners.agg(F.sum("__pairs")).first()[0] or 0
    even = math.ceil(total / (cores * GROUPS_PER_CORE))
    size = max(1, min(pairs, max(even, LEAST_PAIRS)))
    heavy = owners.withColumn("__weight", F.greatest("__pairs", F.lit(math.ceil(size / GROUP_OWNERS))))
    placed = running_total(heavy, ["__first", "__owner"], "__weight", "__before")
    groups = materialise(
        placed.select(
            "__owner",
            F.floor(F.col("__before") / size).cast("int").alias("__group"),
            F.ceil(F.col("__weight") / size).cast("int").alias("__pieces"),
        )
    )
    parts = groups.agg(F.max(F.col("__group") + F.col("__pieces"))).first()[0] or 1
    others = [c for c in lookup.columns if c not in keys]
    owned = (
        known.join(groups, F.col(owner).eqNullSafe(F.col("__owner")))
        .groupBy(*keys, "__group", "__pieces")
        .agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in others])).alias("__owned"))
    )
    few = known.count() <= limit
    place = F.xxhash64(F.spark_partition_id(), *_row(large))
    rest = [c for c in large.columns if c not in keys]
    dealt = lookup_join(large, met, keys, "inner", met.count(), limit=limit)
    dealt = dealt.withColumn("__block", F.pmod(place, F.col("__blocks")))
    salt = F.lit(0).cast("long") if few else F.pmod("__block", "__salts")
    gathered = F.collect_list(F.struct(*[F.col(f"`{c}`") for c in rest]))
    if len(_row(large)) == len(large.columns):
        # equal values lie together, and do so in the files of the owners, which this makes smaller
        gathered = F.sort_array(gathered)
    blocks = dealt.groupBy(*keys, "__block", salt.alias("__salt")).agg(gathered.alias("__rows"))
    if few:
        met_by = blocks.join(F.broadcast(owned), list(keys))
    else:
        salted = lookup_join(owned, met.drop("__blocks"), keys, "inner", met.count(), limit=limit)
        salted = salted.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__salts") - 1))).drop("__salts")
        met_by = blocks.join(salted.hint("merge"), [*keys, "__salt"])
    piece = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys], "__block"), F.col("__pieces"))
    moved = met_by.select(*keys, "__rows", "__owned", (F.col("__group") + piece).cast("int").alias("__group"))
    moved = moved.repartitionById(parts, "__group")
    pairs_of = moved.select(*keys, "__rows", F.inline("__owned")).select(*keys, *[f"`{c}`" for c in others], F.inline("__rows"))
    joined = pairs_of if residual is None else pairs_of.where(residual)
    # the sort takes the rows one by one, where another operator would gather all pairs of a block first
    return joined.select(*[f"`{c}`" for c in [*large.columns, *others]]).sortWithinPartitions(owner)


def _row(df: DataFrame) -> list[Column]:
    """Columns that a row's place is worked out from."""
    return [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]


def _key_hash(names: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{n}`") for n in names])


def hot_keys(df: DataFrame, keys: Sequence[str]) -> dict[int, float]:
    """Hashes of the keys that hold more than one of ``HOT_SHARE`` parts of the rows, and their shares.

    The first pass adds up counters, bounded in number; the keys of hot counters alone are
    counted one by one.
    """
    hashed = df.select(_key_hash(keys).alias("key"))
    counter = F.pmod(F.col("key"), F.lit(_COUNTERS))
    counts = hashed.groupBy(counter.alias("counter")).agg(F.count("*").alias("n")).collect()
    least = sum(r["n"] for r in counts) / HOT_SHARE
    hot = [r["counter"] for r in counts if r["n"] > least]
    if not hot:
        return {}
    exact = hashed.where(counter.isin(hot)).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > least)
    return {r["key"]: r["n"] / (least * HOT_SHARE) for r in exact.collect()}


def number_in_order(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """Number the rows of each group 1, 2, ... in ``order`` without one-task groups.

    A plain ``row_number`` puts a whole group into one task.  Here the rows are
    range-partitioned by group and order, numbered inside each partition, and
    shifted by the number of rows the group has in earlier partitions.  The
    partition number is fixed by a checkpoint before it is used twice.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in [*group, *order]])
    placed = materialise(ranged.withColumn("__slot", F.spark_partition_id()))
    per_slot = placed.groupBy(*group, "__slot").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*group).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    shift = per_slot.select(
        *group, "__slot", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift")
    )
    local = Window.partitionBy(*group, "__slot").orderBy(*order)
    # a null group is a group as well
    keys = [*group, "__slot"]
    renamed = shift.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    return (
        placed.withColumn("__local", F.row_number().over(local))
        .join(renamed, same)
        .withColumn(name, (F.col("__local") + F.col("__shift")).cast("long"))
        .drop("__slot", "__local", "__shift", *[f"__of_{k}" for k in keys])
    )


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """The sum of ``value`` over all rows before a row in ``order``, in partitions as :func:`number_in_order` has them."""
    ranged = df.repartitionByRange(*[F.col(c) for c in order])
    placed = materialise(ranged.withColumn("__slot", F.spark_partition_id()))
    # one row per partition
    before = Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    shift = placed.groupBy("__slot").agg(F.sum(value).alias("__sum")).select(
        F.col("__slot").alias("__of_slot"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__shift")
    )
    local = Window.partitionBy("__slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("__local", F.coalesce(F.sum(value).over(local), F.lit(0)))
        .join(shift, F.col("__slot") == F.col("__of_slot"))
        .withColumn(name, F.col("__local") + F.col("__shift"))
        .drop("__slot", "__of_slot", "__local", "__shift")
    )
