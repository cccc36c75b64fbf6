"""Helpers shared by the text operators: kept tables, row keys, byte-level tokens.

A *row key* is the pair (doc_id, sha256 of the text).  It tells rows apart also where a
doc_id is null or repeats; rows that agree in both are copies of one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsieve.scale import scratch_dir

# Python tasks work on slices of about this many bytes of text, whatever Spark's batches hold.
SLICE_BYTES = 512 << 10
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

_NULL_ID = -(2**63)
_PRIME = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64


def keep(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table."""
    path = scratch_dir(df.sparkSession)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_for_join(grouped: DataFrame) -> DataFrame:
    """An aggregate that is joined back on its own keys, written first.

    Unwritten, it would share the join's partitions, and Spark cannot split a hot partition
    that is aggregated and joined in one stage.
    """
    return keep(grouped)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_key(name: str = "doc_id") -> Column:
    """The id without nulls, fit for plain equality joins."""
    return F.coalesce(F.col(name).cast("long"), F.lit(_NULL_ID))


def rows_where(docs: DataFrame, chosen: DataFrame, present: bool, single: bool = False) -> DataFrame:
    """Rows of ``docs`` whose row key is (or is not) among ``chosen`` (doc_id, text_sha256).

    ``single`` leaves one of several copies of a row.  The join and the de-duplication use the
    same keys, so the texts are shuffled once.
    """
    keyed = docs.withColumns({"__id": id_key(), "__sha": F.sha2(text_or_empty(), 256)})
    keys = chosen.select(id_key().alias("__id"), F.col("text_sha256").alias("__sha"))
    found = keyed.join(keys, ["__id", "__sha"], "left_semi" if present else "left_anti")
    if single:
        found = found.dropDuplicates(["__id", "__sha"])
    return found.select(*docs.columns)


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """``work`` over the Arrow batches of ``df``, cut into slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = work(part)
                if out is not None:
                    yield out

    return in_arrow(df, run, schema)


def in_arrow(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with Arrow batches of bounded size."""
    bound_batches(df)
    return df.mapInArrow(run, schema)


def bound_batches(df: DataFrame) -> None:
    """Arrow batches of the session of ``df`` end at about ``SLICE_BYTES``; a longer row stands alone.

    By default a batch holds up to 64 MB, several times over in the memory of the executor and once more in
    Python.  The plan takes the setting when it runs, so it stays.  A session that sets it keeps its own.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_LIMIT, None) is None:
        conf.set(BATCH_LIMIT, SLICE_BYTES)


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text; a longer row stands alone."""
    if batch.num_rows == 0:
        return
    sizes = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            sizes += np.asarray(pa.compute.binary_length(column).fill_null(0), np.int64)
    runs = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), batch.num_rows]
    for first, after in zip(cuts, cuts[1:]):
        yield batch.slice(first, after - first)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    if column.buffers()[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], np.uint8, offsets[-1] - offsets[0], offsets[0])
    return data, offsets - offsets[0]


def byte_classes(*ranges: Sequence[tuple[int, int]]) -> np.ndarray:
    """Table of 256 classes; class k are the bytes of the k-th list of (first, last), from 1."""
    table = np.zeros(256, np.uint8)
    for k, spans in enumerate(ranges, 1):
        for first, last in spans:
            table[first : last + 1] = k
    return table


#: Bytes of UTF-8 that belong to words: digits, letters, everything outside ASCII.
WORD_BYTES = ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the prime and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_PRIME), -1, 2**64))
        size = max(n, 1 << 16)
        for k, base in enumerate((_PRIME, inverse)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (finaliser of a multiply-shift hash)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def tokens(
    data: np.ndarray, offsets: np.ndarray, classes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes of one non-zero class: where they begin and end, and their document."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    kind = classes[data]
    cut = np.empty(n + 1, bool)
    cut[0] = cut[n] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:n])
    cut[offsets] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    used = kind[starts] != 0
    starts, ends = starts[used], ends[used]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def token_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, the same wherever the run stands."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])
