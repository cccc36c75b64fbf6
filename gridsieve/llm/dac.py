"""Token files with directly addressable codes: any token is read without decoding a block.

An id is cut into chunks of eight bits.  Level 0 holds the lowest chunk of every id, level 1 the
next chunk of those ids that need one, and so on.  Each level but the last has a bitmap that tells
which of its chunks go on, and a rank directory (ones before every 2**15 bits, and within these
before every word of 64), so the place of the next chunk is found with two reads and one count.

A file table has a row per segment: whole documents up to about ``SEGMENT_IDS`` ids, in
ascending doc_id order over all shards (a shard is what one task wrote).  Spark writes and reads
the table, so files can lie in any store, and a lost task is written again.

Defined results: null text counts as empty, its only id is the end id; rows are ordered by
doc_id, nulls first, then a hash of the text; repeated rows are written each; extra columns are ignored; an
empty table gives an empty file table.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridsieve.llm.common import keep, map_batches, slices

END_ID = 2
SEGMENT_IDS = 1 << 18
_SUPER = 15

SCHEMA = (
    "shard int, segment long, first long, n_ids long, doc_ids array<long>, doc_starts array<long>, "
    "chunks array<binary>, bitmaps array<binary>, supers array<binary>, ranks array<binary>"
)


class Dac:
    """Directly addressable codes of a list of ids below 2**32."""

    def __init__(self, n: int, chunks, bitmaps, supers, ranks):
        self.n = n
        self.chunks = [np.frombuffer(c, np.uint8) for c in chunks]
        self.bitmaps = [np.frombuffer(b, "<u8") for b in bitmaps]
        self.supers = [np.frombuffer(s, "<u8") for s in supers]
        self.ranks = [np.frombuffer(r, "<u2") for r in ranks]

    @staticmethod
    def pack(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes], list[bytes]]:
        chunks, bitmaps, supers, ranks = [], [], [], []
        rest = np.asarray(ids, np.uint32)
        while True:
            chunks.append((rest & np.uint32(255)).astype(np.uint8).tobytes())
            rest = rest >> np.uint32(8)
            more = rest > 0
            if not more.any():
                return chunks, bitmaps, supers, ranks
            bits = np.zeros(-(-len(more) // 64) * 64, bool)
            bits[: len(more)] = more
            words = np.packbits(bits, bitorder="little").view("<u8")
            before = np.cumsum(np.r_[0, np.bitwise_count(words).astype(np.int64)])[:-1]
            per_super = (1 << _SUPER) // 64
            super_before = before[::per_super]
            bitmaps.append(words.tobytes())
            supers.append(super_before.astype("<u8").tobytes())
            ranks.append((before - np.repeat(super_before, per_super)[: len(before)]).astype("<u2").tobytes())
            rest = rest[more]

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at any places, in the order asked for."""
        places = np.asarray(places, np.int64)
        out = self.chunks[0][places].astype(np.uint32)
        left = np.arange(len(places))
        for k in range(len(self.bitmaps)):
            word = self.bitmaps[k][places >> 6]
            bit = (places & 63).astype(np.uint64)
            on = (word >> bit & np.uint64(1)).astype(bool)
            places, left, word, bit = places[on], left[on], word[on], bit[on]
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            places = (
                self.supers[k][places >> _SUPER].astype(np.int64) + self.ranks[k][places >> 6] + below
            )
            out[left] |= self.chunks[k + 1][places].astype(np.uint32) << np.uint32(8 * (k + 1))
        return out


class TextEncoder:
    """Byte-level BPE of the tokenizers library.

    Texts go through tiktoken, which has the same vocabulary, merges and pattern and is four
    times as fast.  Texts that name a special token, and those on which its pattern gives up
    (about a million spaces in a row), go through the tokenizers library itself.  Tests compare the two.
    """

    def __init__(self, path: str, ranks_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:
                pass
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def text_encoder(path: str, ranks_path: str) -> TextEncoder:
    return TextEncoder(path, ranks_path)


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode_files(
    docs: DataFrame, files: tuple[str, str] | None = None, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS
) -> DataFrame:
    """The segments of a file table for ``docs`` (doc_id, text); see ``SCHEMA``."""
    path, ranks_path = files or default_files()
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Spark samples the keys of a range partitioning on the driver, so no text is a key.
    tie = F.xxhash64("text")
    ordered = read.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = text_encoder(path, ranks_path)
        shard = TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        first = segment = 0
        parts: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        starts: list[int] = []
        size = 0

        def closed() -> pa.RecordBatch:
            packed = Dac.pack(np.concatenate(parts))
            binaries = pa.list_(pa.binary())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([segment], pa.int64()),
                    pa.array([first], pa.int64()),
                    pa.array([size], pa.int64()),
                    pa.array([doc_ids], pa.list_(pa.int64())),
                    pa.array([starts], pa.list_(pa.int64())),
                    *[pa.array([x], binaries) for x in packed],
                ],
                [c.split()[0] for c in SCHEMA.split(", ")],
            )

        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = coder.encode(text) if text else end[:0]
                    parts += [ids, end]
                    doc_ids.append(doc_id)
                    starts.append(size)
                    size += len(ids) + 1
                    if size >= segment_ids:
                        yield closed()
                        first, segment, size = first + size, segment + 1, 0
                        parts, doc_ids, starts = [], [], []
        if doc_ids:
            yield closed()

    return ordered.mapInArrow(run, SCHEMA)


def write_files(docs: DataFrame, folder: str, **options) -> DataFrame:
    """Write the file table into ``folder`` and return it as read back."""
    encode_files(docs, **options).write.option("compression", "zstd").parquet(folder)
    return read_files(docs.sparkSession, folder)


def read_files(spark, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder)


def kept_files(docs: DataFrame, **options) -> DataFrame:
    """The file table in a new folder of the shared folder, read back."""
    return keep(encode_files(docs, **options))


def shard_bases(table: DataFrame) -> DataFrame:
    """shard, base: ids in all earlier shards.  One row per shard, so the window is small."""
    sizes = table.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


def document_ids(table: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read from the file table."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = ([], [], [], [], [])
        for row in batch.to_pylist():
            codes = Dac(row["n_ids"], row["chunks"], row["bitmaps"], row["supers"], row["ranks"])
            bounds = [*row["doc_starts"], row["n_ids"]]
            for doc_id, a, b in zip(row["doc_ids"], bounds, bounds[1:]):
                ids = codes.at(np.arange(a, b))
                values = (row["shard"], doc_id, row["first"] + a, b - a, zlib.crc32(ids.astype("<u4").tobytes()))
                for column, value in zip(out, values):
                    column.append(value)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(out, kinds)], ["shard", "doc_id", "within", "n_tokens", "ids_crc32"]
        )

    found = map_batches(table, work, "shard int, doc_id long, within long, n_tokens long, ids_crc32 long")
    return found.join(shard_bases(table), "shard").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
