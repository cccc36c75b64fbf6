"""Benchmark decontamination with spaced seeds.

A *mask* fixes some positions of a window of words and ignores the others, so a window with
substituted words still has the hash of the original under a mask that ignores them.  The masks for
items of each length are chosen so that every passage that step 4 accepts shares at least one seed: a
run of 32 or more words within the rule holds a shorter one, and the shorter ones are enumerated in a test.

1. Seeds of all benchmark items: the hash of every window under every mask.
2. Documents are scanned with the same masks.  A Bloom filter of the seeds (its size follows the
   counted seeds and has an upper limit; a crowded one costs time, never results) lets through the
   few windows worth a join.  Only these and the words around them leave the task.
3. Hits are joined with the seeds by hash, which gives places (item, shift) in a document.
4. Every place is verified word by word: along the shift, some run with at least four fifths of its words
   equal (at most one other word for every ``PENALTY``) must hold enough equal words.

Words are runs of digits, letters and non-ASCII signs, A-Z lower-cased.  A run counts if it holds
``MIN_WORDS`` equal words, or four fifths of a shorter item.

Defined results: null text counts as empty; items of fewer than ``LEAST_WORDS`` words identify
nothing and are never found; repeated items are each reported; repeated documents share their result; empty tables
give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsieve.llm.common import (
    LOWER, WORD_BYTES, byte_classes, in_arrow, keep, map_batches, mixed, slices, token_hashes, tokens, utf8,
)

SPAN = 12
#: 1 marks a position that has to agree.  Shapes for items of SPAN words or more, and for each shorter length.
SHAPES = ("11110111", "11101001011", "100100011111", "1111010011", "111010100011", "10011011101", "1110011101")
_TEN = ("1111011", "11001111", "110110011", "11110101", "10101111")
SHORT_SHAPES = {
    5: ("1111", "11101", "11011", "10111"),
    6: ("1111", "11011"),
    7: ("11111", "111011", "110111"),
    8: ("11111", "111011"),
    9: ("1111011", "1101111"),
    10: _TEN,
    11: _TEN,
}


def _placed(shapes: tuple[str, ...], span: int) -> tuple[str, ...]:
    """The shapes at all places of a window."""
    return tuple(("0" * k + s).ljust(span, "0") for s in shapes for k in range(span - len(s) + 1))


MASKS = _placed(SHAPES, SPAN)
LEAST_WORDS, MIN_WORDS, PENALTY = 5, 13, 4
BLOOM_MOST_BITS, BLOOM_LEAST_BITS, BLOOM_BITS_PER_SEED = 27, 16, 128

_CLASSES = byte_classes(WORD_BYTES)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_FACTORS = mixed(np.arange(1, 64, dtype=np.uint64))


def words_of(text: bytes) -> list[bytes]:
    """The words of a lower-cased text."""
    return _WORD.findall(text)


def masks_for(lengths: list[int]) -> list[tuple[int, ...]]:
    """Positions that have to agree, for each mask: first ``MASKS``, then those over all words of short items.

    The latter have an entry for every word; that of an ignored word repeats another one.
    """
    masks = [tuple(i for i, c in enumerate(m) if c == "1") for m in MASKS]
    for n in sorted(set(lengths)):
        for m in _placed(SHORT_SHAPES.get(n, ()), n):
            masks.append(tuple(i if c == "1" else m.index("1") for i, c in enumerate(m)))
    return masks


def shapes_for(lengths: list[int]) -> dict[tuple[int, ...], set[int]]:
    """Masks by their positions from 0, whatever their place, and the lengths of the items they are for (SPAN: or longer)."""
    shapes: dict[tuple[int, ...], set[int]] = {}
    for n, of_length in [(SPAN, SHAPES), *((n, SHORT_SHAPES[n]) for n in sorted(set(lengths)) if n in SHORT_SHAPES)]:
        for s in of_length:
            shapes.setdefault(tuple(i for i, c in enumerate(s) if c == "1"), set()).add(n)
    return shapes


def window_hashes(h: np.ndarray, doc: np.ndarray, shape: tuple[int, ...], number: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows under one mask, and the word each begins at; no window leaves its text."""
    span = shape[-1] + 1
    n = len(h) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, _FACTORS[40 + number], np.uint64)
    for place, factor in zip(shape, _FACTORS):
        total += h[place : place + n] * factor
    at = np.flatnonzero(doc[:n] == doc[span - 1 :])
    return mixed(total[at]), at


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = utf8(texts)
    lower = LOWER[data]
    return lower, *tokens(lower, offsets, _CLASSES)


class Bloom:
    """Three bits for each hash."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.bytes = bits, words.view(np.uint8)

    @staticmethod
    def places(h: np.ndarray, bits: int) -> list[np.ndarray]:
        low = np.uint64((1 << bits) - 1)
        return [(x & low).astype(np.int64) for x in (h, h >> np.uint64(30), mixed(h + np.uint64(1)))]

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        """Where the hashes may be in the set."""
        at = np.arange(len(h))
        for k in range(3):
            place = self.places(h[at], self.bits)[k]
            at = at[(self.bytes[place >> 3] >> (place & 7).astype(np.uint8) & np.uint8(1)).astype(bool)]
        return at


def seeds_of(items: DataFrame, shapes: dict[tuple[int, ...], set[int]]) -> DataFrame:
    """h, item, pos: every window of every item (item, text) under every mask that is meant for it."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        lower, starts, ends, doc = _tokens(batch.column(1))
        if not len(starts):
            return None
        hashed = token_hashes(lower, starts, ends)
        count = np.bincount(doc, minlength=batch.num_rows)
        first = np.searchsorted(doc, np.arange(batch.num_rows))
        out = []
        for number, (shape, lengths) in enumerate(shapes.items()):
            h, at = window_hashes(hashed, doc, shape, number)
            own = doc[at]
            fit = np.isin(np.minimum(count[own], SPAN), list(lengths))
            out.append((h[fit], own[fit], (at - first[own])[fit]))
        h, own, pos = (np.concatenate(x) for x in zip(*out))
        item = batch.column(0).to_numpy(zero_copy_only=False)
        return pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(item[own]), pa.array(pos)], ["h", "item", "pos"]
        )

    return map_batches(items.select("item", "text"), work, "h long, item long, pos long")


def bloom_of(seeds: DataFrame) -> Bloom:
    """The filter, put together on Spark; at most 2**BLOOM_MOST_BITS bits reach the driver."""
    bits = min(BLOOM_MOST_BITS, max(BLOOM_LEAST_BITS, (BLOOM_BITS_PER_SEED * seeds.count() + 1).bit_length()))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(Bloom.places(h, bits))))], ["place"])

    places = map_batches(seeds.select("h"), work, "place long")
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    )
    found = words.toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    return Bloom(bits, table)


REGIONS = "region long, doc_id long, text_sha256 string, first_word long, words binary, hits array<struct<h:bigint,at:bigint>>"


def scan(docs: DataFrame, shapes: list[tuple[int, ...]], bloom: Bloom, margin: int) -> DataFrame:
    """Stretches of documents around windows that may be seeds, with the hashes of these windows."""
    shared = docs.sparkSession.sparkContext.broadcast((bloom.bits, bloom.bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, table = shared.value
        wanted = Bloom(bits, table)
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in slices(batch):
                rows = list(stretches(part, wanted))
                if rows:
                    columns = [[number + k for k in range(len(rows))], *map(list, zip(*rows))]
                    number += len(rows)
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary(),
                             pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int64())]))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, k) for v, k in zip(columns, kinds)],
                        ["region", "doc_id", "text_sha256", "first_word", "words", "hits"],
                    )

    def stretches(part: pa.RecordBatch, wanted: Bloom) -> Iterator[tuple]:
        lower, starts, ends, doc = _tokens(part.column(1))
        if not len(starts):
            return
        hashed = token_hashes(lower, starts, ends)
        at, h, reach = [], [], []
        for k, shape in enumerate(shapes):
            window, begin = window_hashes(hashed, doc, shape, k)
            some = wanted.may_hold(window)
            at.append(begin[some])
            h.append(window[some])
            reach.append(np.full(len(some), shape[-1] + 1))
        at, h, reach = np.concatenate(at), np.concatenate(h).view(np.int64), np.concatenate(reach)
        if not len(at):
            return
        order = np.argsort(at, kind="stable")
        at, h, reach = at[order], h[order], reach[order]
        cut = np.flatnonzero((doc[at[1:]] != doc[at[:-1]]) | (np.diff(at) > margin)) + 1
        shas: dict[int, str] = {}
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(at)]):
            d = int(doc[at[a]])
            begin, after = np.searchsorted(doc, [d, d + 1])
            low = max(begin, at[a] - margin)
            high = min(after, at[b - 1] + reach[a:b].max() + margin)
            if d not in shas:
                text = part.column(1)[d].as_py()
                shas[d] = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
            hits = [{"h": x, "at": y} for x, y in zip(h[a:b].tolist(), (at[a:b] - low).tolist())]
            words = lower[starts[low] : ends[high - 1]].tobytes()
            yield part.column(0)[d].as_py(), shas[d], int(low - begin), words, hits

    return in_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, REGIONS)


def best_overlap(item: list[bytes], words: list[bytes], shift: int) -> tuple[int, int, int] | None:
    """First item word, length and equal words of the best verified run along a shift, or None.

    Of all runs with four fifths equal it is the one of most equal words, then the shortest, then the first.
    """
    need = min(MIN_WORDS, -(-4 * len(item) // 5))
    first, after = max(0, -shift), min(len(item), len(words) - shift)
    same = [item[i] == words[i + shift] for i in range(first, after)]
    if sum(same) < need:
        return None
    # A run keeps to the rule if its sum of +1 for equal and -PENALTY for other words is not negative.  For each
    # end the widest such run begins at a new minimum of the sums before; these minima fall, so they can be searched.
    lows, starts = [0], [0]
    total = equal = 0
    before = [0]
    best = None
    for j, agrees in enumerate(same):
        total += 1 if agrees else -PENALTY
        equal += agrees
        before.append(equal)
        if agrees:
            k = bisect_left(lows, -total, key=lambda low: -low)
            if k < len(lows):
                i = starts[k]
                while not same[i]:
                    i += 1
                found = (equal - before[i], i - j - 1)
                if best is None or found > best[:2]:
                    best = (*found, i)
        elif total < lows[-1]:
            lows.append(total)
            starts.append(j + 1)
    if best is None or best[0] < need:
        return None
    return first + best[2], -best[1], best[0]


def claims_of(places: DataFrame, regions: DataFrame, items: DataFrame) -> DataFrame:
    """One row per place (item, shift) of a region, with the words that lie beside the item and no others.

    A region's words are cut once for all its places, so the work grows with the words and places
    of a document, also where it repeats an item many times.
    """
    sized = items.select("item", F.size(F.expr(r"regexp_extract_all(lower(text), '[0-9a-z\\x{80}-\\x{10ffff}]+', 0)")).alias("n"))
    asked = places.join(sized, "item").groupBy("region").agg(
        F.collect_list(F.struct("item", F.col("shift").cast("long").alias("shift"), F.col("n").cast("long").alias("n"))).alias("places")
    )
    whole = regions.drop("hits").join(asked, "region")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = batch.slice(row, 1).to_pylist()[0]
                words = words_of(r["words"])
                rows = []
                for p in r["places"]:
                    low, high = max(0, p["shift"]), min(len(words), p["shift"] + p["n"])
                    rows.append((p["item"], p["shift"], b" ".join(words[low:high])))
                item, shift, beside = (list(c) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["doc_id"]] * len(rows), pa.int64()), pa.array([r["text_sha256"]] * len(rows), pa.string()),
                        pa.array([r["first_word"]] * len(rows), pa.int64()), pa.array(item, pa.int64()),
                        pa.array(shift, pa.int64()), pa.array(beside, pa.binary()),
                    ],
                    ["doc_id", "text_sha256", "first_word", "item", "shift", "words"],
                )

    cut = in_arrow(
        whole.select("doc_id", "text_sha256", "first_word", "words", "places"),
        run,
        "doc_id long, text_sha256 string, first_word long, item long, shift long, words binary",
    )
    # Written first, as the places are verified in Python too: a stage of both would take two workers for each task.
    return keep(cut).join(items.withColumnRenamed("text", "item_text"), "item")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document (doc_id, text) and item (item_id, text) that share a verified passage.

    Columns: doc_id, item_id, doc_word and item_word (first words of the longest passage, from 0),
    overlap_words, equal_words, n_passages, text_sha256.
    """
    items = keep(
        benchmark.select(
            F.monotonically_increasing_id().alias("item"),
            F.col("item_id").cast("long").alias("item_id"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
    )
    counted = items.select(F.size(F.expr(r"regexp_extract_all(lower(text), '[0-9a-z\\x{80}-\\x{10ffff}]+', 0)")).alias("n"))
    longest = counted.agg(F.max("n")).first()[0] or 0
    short = [r["n"] for r in counted.where((F.col("n") < SPAN) & (F.col("n") >= LEAST_WORDS)).distinct().collect()]
    shapes = shapes_for(short)
    seeds = keep(seeds_of(items, shapes))
    regions = keep(scan(docs, list(shapes), bloom_of(seeds), max(longest, SPAN)))
    hits = regions.select("region", F.explode("hits").alias("hit")).select("region", "hit.h", "hit.at")
    places = (
        hits.join(seeds, "h")
        .select("region", "item", (F.col("at") - F.col("pos")).alias("shift"))
        .distinct()
    )
    claims = claims_of(places, regions, items)

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        known: dict[int, list[bytes]] = {}
        rows = []
        for r in batch.to_pylist():
            item = known.get(r["item"])
            if item is None:
                item = known[r["item"]] = words_of(_lower(r["item_text"]))
            found = best_overlap(item, words_of(r["words"]), min(r["shift"], 0))
            if found:
                at, length, equal = found
                rows.append((r["doc_id"], r["text_sha256"], r["item_id"], r["first_word"] + at + r["shift"], at, length, equal))
        if not rows:
            return None
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5]
        names = ["doc_id", "text_sha256", "item_id", "doc_word", "item_word", "overlap_words", "equal_words"]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(map(list, zip(*rows)), kinds)], names)

    verified = map_batches(
        claims.select("doc_id", "text_sha256", "item_id", "first_word", "shift", "item", "words", "item_text"),
        verify,
        "doc_id long, text_sha256 string, item_id long, doc_word long, item_word long, overlap_words long, equal_words long",
    ).distinct()
    best = F.max(F.struct("equal_words", (-F.col("doc_word")).alias("early"), "doc_word", "item_word", "overlap_words"))
    return (
        verified.groupBy("doc_id", "text_sha256", "item_id")
        .agg(best.alias("best"), F.count("*").alias("n_passages"))
        .select("doc_id", "item_id", "best.doc_word", "best.item_word", "best.overlap_words", "best.equal_words", "n_passages", "text_sha256")
    )


def _lower(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()
