"""Alignment of two tokenizers over a corpus: groups, links, and how often ids are linked.

Both tokenizers cut the same bytes, a space and the text.  Places where tokens of both end cut a
document into groups; the two tokens that end there are a link.  Most groups are one token
beside one token of the same bytes.  For them a table from A's ids to B's, made once from both
vocabularies, stands for the pair: their links are counted in vectors as long as A's vocabulary,
one a task.  Only the links of other, irregular groups are shuffled as pairs.

A document is tokenised once; its links are written, and read again when the counts are known.
Counts of one-to-one links and the highest count of each B id are vectors, bounded by the
vocabularies.  Of the irregular pairs those with more than a ``2 ** -HEAVY_BITS`` share of all
irregular links, which are fewer than ``2 ** HEAVY_BITS``, go to the tasks as well; the
others, none of them frequent, are joined by pair.

Defined results: null, empty, and texts that a tokenizer does not give back byte by byte (such
as those with U+2581) have no tokens, zeros and an empty digest; strings of special tokens are
plain text; repeated rows count each, with one row each in the result; ties for the highest count
all count; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridsieve.llm.common import keep, map_batches

HEAVY_BITS = 18
SPACE = "▁"

LINKED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, same array<int>, other array<long>"
)


class ByteTokens:
    """Byte-level BPE: ids of a text in which nothing is special, and the bytes of every id.

    The ranks hold the same vocabulary and merges and are faster; the tokenizers library serves
    where the pattern of the other fails, as it does for very long runs of white space.
    """

    def __init__(self, path: str, ranks_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * self.slow.get_vocab_size()
        for token, i in ranks.items():
            self.bytes[i] = token

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        except ValueError:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int64)


class PieceTokens:
    """SentencePiece: ids of a text, which the model puts a space before, and the bytes of every id."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i)
            else b"" if self.model.is_control(i) or self.model.is_unknown(i)
            else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.fallback = {i for i in range(len(pieces)) if self.model.is_byte(i)}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    def __init__(self, a_path: str, a_ranks: str, b_path: str):
        self.a, self.b = ByteTokens(a_path, a_ranks), PieceTokens(b_path)
        self.sizes = [np.array([len(t) for t in side.bytes], np.int64) for side in (self.a, self.b)]
        # ids as they stand before another token of the group, and as the last of their side
        self.inner = [np.array([f"{i}," for i in range(len(s))], object) for s in self.sizes]
        self.final = [np.array([f"{i}{end}" for i in range(len(s))], object) for s, end in zip(self.sizes, "|;")]
        self.same = identity_map(self.a.bytes, self.b.bytes, self.b.fallback)

    def align(self, text: str, b_ids: list[int]) -> tuple | None:
        """n_a, n_b, n_groups, digest of the groups, A ids of one-to-one links, pairs of all others."""
        ids = self.a.encode(" " + text), np.array(b_ids, np.int64)
        whole = (" " + text).encode("utf-8", "surrogatepass")
        for side, found in zip((self.a, self.b), ids):
            if b"".join([side.bytes[i] for i in found.tolist()]) != whole:
                return None
        ends = [np.cumsum(size[found]) for size, found in zip(self.sizes, ids)]
        spot = np.searchsorted(ends[0], ends[1])
        meets = ends[0][spot] == ends[1]
        # where a group ends, as a place among A's tokens and among B's
        last = [spot[meets], np.flatnonzero(meets)]
        one = (np.diff(last[0], prepend=-1) == 1) & (np.diff(last[1], prepend=-1) == 1)
        a, b = ids[0][last[0]], ids[1][last[1]]
        one &= self.same[a] == b
        digest = hashlib.sha256(self._spelled(ids, last).encode()).hexdigest()
        return len(ids[0]), len(b_ids), len(a), digest, a[one], a[~one] << 32 | b[~one]

    def _spelled(self, ids, last) -> str:
        signs, keys = [], []
        for side in (0, 1):
            sign = self.inner[side][ids[side]]
            sign[last[side]] = self.final[side][ids[side][last[side]]]
            signs.append(sign)
            group = np.zeros(len(sign), np.int64)
            group[last[side][:-1] + 1] = 2
            keys.append(np.cumsum(group) + side)
        order = np.argsort(np.concatenate(keys), kind="stable")
        return "".join(np.concatenate(signs)[order].tolist())[:-1]


def identity_map(a_bytes: list[bytes], b_bytes: list[bytes], fallback: set[int]) -> np.ndarray:
    """For each A id the B id of the same bytes, or -1; a piece goes before a byte of the fallback."""
    known: dict[bytes, int] = {}
    for i, token in sorted(enumerate(b_bytes), key=lambda entry: entry[0] in fallback):
        if token:
            known.setdefault(token, i)
    return np.array([known.get(token, -1) for token in a_bytes], np.int64)


@lru_cache(maxsize=1)
def aligner(files: tuple[str, str, str]) -> Aligner:
    return Aligner(*files)


def default_files() -> tuple[str, str, str]:
    import public_tokenizers

    return tuple(map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")))


def linked(docs: DataFrame, files: tuple[str, str, str] | None = None) -> DataFrame:
    """The links of every row of ``docs`` (doc_id, text), see ``LINKED``; written once.

    ``same`` has the A ids of one-to-one links, ``other`` the pairs ``A << 32 | B`` of all others.
    """
    paths = files or default_files()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool = aligner(paths)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        none = (0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        found = [tool.align(t, b) or none if t else none for t, b in zip(texts, tool.b.encode(texts))]
        *plain, same, other = zip(*found)
        columns = [pa.array(list(values)) for values in plain]
        columns += [_lists(same, np.int32), _lists(other, np.int64)]
        names = [c.split()[0] for c in LINKED.split(", ")][1:]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = map_batches(read, work, LINKED.split(", ", 1)[1])
    return keep(rows.select(F.monotonically_increasing_id().alias("row"), "*"))


def same_counts(links: DataFrame, vocabulary: int) -> np.ndarray:
    """How many one-to-one links each A id has: a vector a task, summed id by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            counts += np.bincount(np.asarray(batch.column(0).flatten()), minlength=vocabulary)
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array([counts.tolist()], pa.list_(pa.int64()))], ["counts"])

    vectors = links.select("same").mapInArrow(run, "counts array<long>")
    sums = vectors.select(F.posexplode("counts").alias("id", "n")).where("n > 0").groupBy("id").agg(F.sum("n").alias("n"))
    table = sums.toArrow()  # at most one row for each id of the vocabulary
    out = np.zeros(vocabulary, np.int64)
    out[table["id"].to_numpy()] = table["n"].to_numpy()
    return out


def pair_counts(links: DataFrame) -> DataFrame:
    """pair, n of all links that are not one to one; written once."""
    return keep(links.select(F.explode("other").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))


def highest(same: np.ndarray, b_of: np.ndarray, pairs: DataFrame, vocabulary: int) -> np.ndarray:
    """The highest count that each B id has with any A id."""
    best = np.zeros(vocabulary, np.int64)
    np.maximum.at(best, b_of[b_of >= 0], same[b_of >= 0])
    b_id = F.col("pair").bitwiseAND(2**32 - 1).cast("int")
    table = pairs.groupBy(b_id.alias("b")).agg(F.max("n").alias("n")).toArrow()  # at most one row for each id
    np.maximum.at(best, table["b"].to_numpy(), table["n"].to_numpy())
    return best


def align(docs: DataFrame, files: tuple[str, str, str] | None = None, heavy_bits: int = HEAVY_BITS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``."""
    tool = aligner(files or default_files())
    links = linked(docs, files)
    same = same_counts(links, len(tool.same))
    pairs = pair_counts(links)
    best = highest(same, tool.same, pairs, len(tool.sizes[1]))
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    frequent = F.col("n") > total / 2**heavy_bits
    heavy = pairs.where(frequent).toArrow()  # fewer than 2 ** heavy_bits, as their shares add up to one
    order = np.argsort(heavy["pair"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(
        (tool.same, same, best, heavy["pair"].to_numpy()[order], heavy["n"].to_numpy()[order])
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
        b_of, same, best, heavy, heavy_n = shared.value
        is_best = same == best[b_of]
        sums, bests, rest = [], [], []
        ones, others = _pieces(columns.pop("same")), _pieces(columns.pop("other"))
        for one, other in zip(ones, others):
            at = np.searchsorted(heavy, other)
            known = np.zeros(len(other), bool)
            inside = at < len(heavy)
            known[inside] = heavy[at[inside]] == other[inside]
            n = heavy_n[at[known]]
            sums.append(int(same[one].sum() + n.sum()))
            bests.append(int(is_best[one].sum() + (n == best[other[known] & 0xFFFFFFFF]).sum()))
            rest.append(other[~known])
        columns |= {
            "count_sum": pa.array(sums, pa.int64()),
            "n_best": pa.array(bests, pa.int64()),
            "rare": _lists(rest, np.int64),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    counted = keep(
        map_batches(
            links,
            work,
            "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
            "count_sum long, n_best long, rare array<long>",
        )
    )
    rare = pairs.where(~frequent)
    tops = docs.sparkSession.createDataFrame(
        pa.table({"b": np.arange(len(best), dtype=np.int64), "top": best})
    )
    # a row for each B id of the vocabulary
    told = rare.join(F.broadcast(tops), F.col("pair").bitwiseAND(2**32 - 1) == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("top")).cast("long").alias("top")
    )
    asked = counted.select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("times"))
    added = asked.join(keep(told), "pair").groupBy("row").agg(
        F.sum(F.col("n") * F.col("times")).alias("more"), F.sum(F.col("top") * F.col("times")).alias("more_best")
    )
    return counted.join(added, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def _lists(arrays: Sequence[np.ndarray], kind: type) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(arrays).astype(kind))


def _pieces(lists: pa.Array) -> Iterator[np.ndarray]:
    values = np.asarray(lists.flatten())
    bounds = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    return (values[a:b] for a, b in zip(bounds, bounds[1:]))
