"""URL verdicts from cascades of Bloom filters, exact over all keys of the corpus.

A rule or listed entry is a key, ``host + path``.  It fits a URL if the URL's host is its host or
a subdomain and the URL's path starts with its path, so the keys that can decide a URL are its
host's endings at dots joined with prefixes of its path; only lengths that some entry has are
looked up, which keeps a URL's keys few however long it is.

A cascade holds a set of keys among the *universe*, all keys that occur in the corpus: the first
filter encodes the set, the second those keys of the universe that the first lets pass by mistake,
the third the members that the second lets pass, and so on until a filter makes no mistake.  The
level at which a key stops tells whether it is a member, with no error for any key of the
universe.  Filters are built and refined by Spark; a lookup is a pass over the pages, no join.

Broadcast are the filters.  With r members in a universe of s keys they take about
``r * (1.44 * log2(s / r) + 4)`` bits, so they grow with the list and only by the logarithm with the
corpus.  ``FILTER_BYTES`` bounds them: a larger cascade is cut by a hash of the key into shards
within the bound, and the pages pass once for each shard.

Defined results: a null URL and one without ``://`` have an empty host and path, which no entry
with a host fits, and the verdict ``allow``; the longest rule wins, of a key that is both blocked
and allowed the block; repeated pages are judged each; an empty list lets all pass; further columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsieve.llm.common import keep, map_batches

FILTER_BYTES = 64 << 20

# The rules of the registered query.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

# Words in a label of a host, between dots, hyphens and digits, that put it on the list of blocked hosts.
BLOCKED_WORDS = ("adult", "bets", "casino", "cheap", "escort", "gambling", "pills", "poker", "porn", "spam", "viagra", "xxx")

ENTRIES = "host string, path string"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), f"{ENTRIES}, verdict string")


def named_hosts(pages: DataFrame, words: Sequence[str] = BLOCKED_WORDS) -> DataFrame:
    """Entries for all hosts of the corpus that have one of the words in a label."""
    host, _ = url_parts(F.col("url"))
    pattern = rf"(^|[.\-0-9])({'|'.join(words)})([.\-0-9]|$)"
    return pages.select(host.alias("host")).where(F.col("host").rlike(pattern)).distinct().withColumn("path", F.lit(""))


@dataclass(frozen=True)
class Lengths:
    """Lengths of the hosts in a list, and for each the lengths of paths that go with it."""

    paths: dict[int, list[int]]

    @classmethod
    def of(cls, entries: DataFrame) -> Lengths:
        """Read off a list; there are as many as different lengths, whatever the entries are."""
        pairs = entries.select(F.length("host").alias("h"), F.length("path").alias("p")).distinct().collect()
        paths: dict[int, list[int]] = {}
        for r in sorted(pairs, key=lambda r: (r["h"], r["p"])):
            paths.setdefault(r["h"], []).append(r["p"])
        return cls(paths)

    def keys(self, host: str, path: str) -> Iterator[str]:
        """The keys that may decide a URL, the longest first."""
        found = []
        for h, lengths in self.paths.items():
            if h and (h == len(host) or (h < len(host) and host[-h - 1] == ".")):
                found += [host[-h:] + path[:p] for p in lengths if p <= len(path)]
        found.sort(key=len, reverse=True)
        return iter(found)


class Bloom:
    """A filter of words of 64 bits; keys are hashed with the filter's own seed."""

    def __init__(self, words: np.ndarray, hashes: int, seed: int):
        self.words, self.hashes, self.seed = words, hashes, seed

    @staticmethod
    def places(keys: Iterable[str], bits: int, hashes: int, seed: int) -> np.ndarray:
        digests = [xxhash.xxh3_128_intdigest(k.encode("utf-8", "surrogatepass"), seed) for k in keys]
        low = np.array([d & (1 << 64) - 1 for d in digests], np.uint64)
        step = np.array([d >> 64 | 1 for d in digests], np.uint64)
        rounds = np.arange(hashes, dtype=np.uint64)
        return (low[:, None] + rounds * step[:, None]) % np.uint64(bits)

    def holds(self, keys: Sequence[str]) -> np.ndarray:
        at = self.places(keys, len(self.words) * 64, self.hashes, self.seed)
        bits = self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
        return bits.all(axis=1)


def sized(members: int, others: int) -> tuple[int, int]:
    """Bits and hashes of a filter of ``members`` keys that few of ``others`` pass.

    About as many others pass as there are members, divided by the square root of two; more bits
    would cost more than the next level saves.
    """
    rate = min(0.5, members * math.sqrt(0.5) / max(others, 1))
    hashes = max(1, round(-math.log2(rate)))
    bits = math.ceil(max(members, 1) * hashes / math.log(2))
    return max(64, -(-bits // 64) * 64), hashes


def encoded(keys: DataFrame, bits: int, hashes: int, seed: int) -> Bloom:
    """A filter of all ``keys`` (column key): tasks set bits, words are united, the words come back."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = np.unique(Bloom.places(batch.column(0).to_pylist(), bits, hashes, seed))
        word = (at >> np.uint64(6)).astype(np.int64)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        masks = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), starts) if len(at) else at
        return pa.RecordBatch.from_arrays([pa.array(word[starts]), pa.array(masks.view(np.int64))], ["word", "mask"])

    rows = map_batches(keys.select("key"), work, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    # at most one row for each word of the filter, whose size was bounded before
    table = rows.toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return Bloom(words, hashes, seed)


def passing(keys: DataFrame, bloom: Bloom) -> DataFrame:
    """The keys that the filter lets pass."""
    shared = keys.sparkSession.sparkContext.broadcast(bloom)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(shared.value.holds(batch.column(0).to_pylist())))

    return map_batches(keys.select("key"), work, "key string")


class Cascade:
    """Filters of alternate levels; ``holds`` is exact for keys of the universe it was built over."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    @property
    def bytes(self) -> int:
        return sum(b.words.nbytes for b in self.levels)

    def holds(self, keys: Sequence[str]) -> np.ndarray:
        """Which keys are members: those that stop at an even level, counted from 1."""
        member = np.zeros(len(keys), bool)
        left = np.arange(len(keys))
        for k, bloom in enumerate(self.levels):
            if not len(left):
                return member
            passed = bloom.holds([keys[i] for i in left])
            member[left[~passed]] = k % 2 == 1
            left = left[passed]
        # what passes the last filter belongs to what it encodes
        member[left] = len(self.levels) % 2 == 1
        return member


def build(members: DataFrame, universe: DataFrame, first_seed: int = 1) -> Cascade:
    """The cascade of ``members`` among ``universe`` (both: column key, distinct).

    Members that never occur in the universe are left out of it.  Only at the first level the two
    tables meet, reduced to what the first filter lets pass.
    """
    levels: list[Bloom] = []
    n, total = members.count(), universe.count()
    if not n:
        return Cascade(levels)
    inside, outside = members, universe
    others = total
    while n:
        bits, hashes = sized(n, others)
        bloom = encoded(inside, bits, hashes, first_seed + len(levels))
        levels.append(bloom)
        mistaken = passing(outside, bloom)
        if len(levels) == 1:
            mistaken = mistaken.join(members, "key", "left_anti")
        mistaken = keep(mistaken)
        # the mistakes are encoded next, and must not take in what this level holds
        inside, outside, others = mistaken, inside, n
        n = mistaken.count()
    return Cascade(levels)


@dataclass(frozen=True)
class Listing:
    """A set of entries as a cascade, or as one for each hash class of keys where it would be too large."""

    lengths: Lengths
    shards: list[Cascade]

    def longest(self, urls: Sequence[tuple[str, str]], shard: int) -> list[str | None]:
        """For each (host, path) the longest member of a shard that fits."""
        asked = [[k for k in self.lengths.keys(h, p) if self.shard_of(k) == shard] for h, p in urls]
        keys = list({k for each in asked for k in each})
        held = dict(zip(keys, self.shards[shard].holds(keys).tolist())) if keys else {}
        return [next((k for k in each if held[k]), None) for each in asked]

    def shard_of(self, key: str) -> int:
        return zlib.crc32(key.encode("utf-8", "surrogatepass")) % len(self.shards)


def universe(parts: DataFrame, lengths: Sequence[Lengths]) -> DataFrame:
    """kind, key: all keys that the corpus (host, path) asks the lists for; written once."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        urls = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        found = sorted({(kind, key) for kind, known in enumerate(lengths) for h, p in urls for key in known.keys(h, p)})
        columns = [pa.array([k for k, _ in found], pa.int32()), pa.array([k for _, k in found], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["kind", "key"])

    return keep(map_batches(parts.select("host", "path"), work, "kind int, key string").distinct())


def listing(entries: DataFrame, lengths: Lengths, known: DataFrame, limit: int = FILTER_BYTES) -> Listing:
    """The cascades of ``entries`` (host, path) over the keys ``known`` (key)."""
    members = keep(entries.where("host <> ''").select(F.concat("host", "path").alias("key")).distinct())
    n, total = members.count(), known.count()
    likely = n * (1.44 * max(math.log2(max(total, 1) / n), 0.0) + 4) / 8 if n else 0
    shards = max(1, math.ceil(likely / limit))
    part = F.crc32(F.col("key").cast("binary")) % shards
    return Listing(lengths, [build(members.where(part == k), known.where(part == k)) for k in range(shards)])


def with_longest(parts: DataFrame, listings: dict[str, Listing], limit: int = FILTER_BYTES) -> DataFrame:
    """``parts`` (page_id, host, path) with the longest fitting member of each list, or null.

    One pass, or as many as the cascades need so that no pass has more than ``limit`` bytes of them.
    """
    waiting = [(name, k) for name, known in listings.items() for k in range(len(known.shards))]
    for name in listings:
        parts = parts.withColumn(name, F.lit(None).cast("string"))
    columns = parts.columns
    while waiting:
        group, size = [waiting.pop(0)], 0
        while waiting:
            size += listings[group[-1][0]].shards[group[-1][1]].bytes
            name, k = waiting[0]
            if size + listings[name].shards[k].bytes > limit:
                break
            group.append(waiting.pop(0))
        parts = _pass(parts, listings, group).select(*columns)
    return parts


def _pass(parts: DataFrame, listings: dict[str, Listing], group: list[tuple[str, int]]) -> DataFrame:
    def bare(known: Listing, wanted: set[int]) -> Listing:
        return Listing(known.lengths, [c if k in wanted else Cascade([]) for k, c in enumerate(known.shards)])

    used = {name: bare(listings[name], {k for n, k in group if n == name}) for name, _ in group}
    shared = parts.sparkSession.sparkContext.broadcast(used)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
        urls = list(zip(columns["host"].to_pylist(), columns["path"].to_pylist()))
        for name, k in group:
            before = columns[name].to_pylist()
            found = shared.value[name].longest(urls, k)
            columns[name] = pa.array([max((x for x in both if x), key=len, default=None) for both in zip(before, found)], pa.string())
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return map_batches(parts, work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema))


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, limit: int = FILTER_BYTES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed for every row of ``pages`` (page_id, url).

    ``rules`` has host, path, verdict (``block`` or ``allow``); ``listed`` has host, path of entries
    that are blocked where no rule fits.  ``rule`` and ``listed`` are the keys that fit.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    named = listed.select("host", "path")
    lengths = [Lengths.of(rules.where("host <> ''")), Lengths.of(named.where("host <> ''"))]
    known = universe(parts, lengths)
    ruled, others = (known.where(F.col("kind") == k).select("key") for k in (0, 1))
    found = with_longest(
        parts,
        {
            "block": listing(rules.where("verdict = 'block'"), lengths[0], ruled, limit),
            "allow": listing(rules.where("verdict = 'allow'"), lengths[0], ruled, limit),
            "listed": listing(named, lengths[1], others, limit),
        },
        limit,
    )
    blocked = F.coalesce(F.length("block"), F.lit(0)) >= F.coalesce(F.length("allow"), F.lit(0))
    rule = F.when(blocked, F.col("block")).otherwise(F.col("allow"))
    return found.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.when(rule.isNotNull(), F.when(blocked, "block").otherwise("allow"))
        .otherwise(F.when(F.col("listed").isNotNull(), "block").otherwise("allow"))
        .alias("verdict"),
        "listed",
    )
