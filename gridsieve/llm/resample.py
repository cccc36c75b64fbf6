"""Quality classifier by importance resampling over hashed n-gram models.

Two generative models of hashed words, signs and pairs of them are counted: the *raw* model over
every document, the *target* model over labelled good documents.  A document's log weight is the
log of the ratio of its probabilities under the two.  Documents are drawn without replacement
with these weights: a Gumbel variate, fixed by the doc_id and a seed, is added to the log weight,
and the ``k`` largest sums stay.

``k`` is counted, not chosen: it is the number of all documents whose log weight reaches the cutoff
that best parts good from bad among labelled documents held out from the target model.

Labels are a bounded sample: the ``LABEL_LIMIT`` doc_ids with the smallest hashes; three of four
form the target, the fourth sets the cutoff.  Toxic documents of good quality serve neither; they are
weighed like all others.  All else covers all documents, and what is gathered is one count per bucket
and one weight per held-out id.

Defined results: null text counts as empty and weighs zero; null labels are left out; a doc_id with
several labels is good only if all say so, and one with several rows is held out with its smallest weight; without labels of both kinds every document stays; ties
at the last place all stay; repeated rows share their result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsieve.llm.common import (
    WORD_BYTES, bound_batches, byte_classes, in_arrow, keep, map_batches, mixed, slices, token_hashes, tokens, utf8,
)

BUCKETS = 1 << 14
LABEL_LIMIT = 20_000
SEED = 20_240_229
SMOOTHING = 10.0
_BINS = 1024
_COLLECTED = 10_000

_SIGNS = ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_CLASSES = byte_classes(WORD_BYTES, _SIGNS)


@dataclass
class Model:
    """Log ratios by bucket, and the sum of log weight and Gumbel variate that a document needs."""

    log_ratio: np.ndarray
    threshold: float = float("-inf")
    k: int = 0
    cutoff: float = float("-inf")


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, runs of signs and pairs of neighbours, and the document of each."""
    data, offsets = utf8(texts)
    starts, ends, doc = tokens(data, offsets, _CLASSES)
    if not len(starts):
        return np.zeros(0, np.int64), doc
    single = token_hashes(data, starts, ends)
    pair = mixed(single[:-1] * np.uint64(0x9FB21C651E98DF25) + single[1:])[doc[1:] == doc[:-1]]
    hashed = np.concatenate([single, pair])
    return (hashed >> np.uint64(50)).astype(np.int64) % BUCKETS, np.concatenate([doc, doc[1:][doc[1:] == doc[:-1]]])


def sample_labels(labels: DataFrame, limit: int = LABEL_LIMIT) -> dict[str, np.ndarray]:
    """Sorted doc_ids: target, and good and bad ones held out for the cutoff."""
    told = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
        .withColumn("h", F.xxhash64("doc_id"))
        .orderBy("h", "doc_id")
        .limit(limit)
        .collect()
    )
    out: dict[str, list[int]] = {"target": [], "good": [], "bad": []}
    for r in told:
        if r["quality"] <= 0:
            kind = "bad" if r["h"] % 4 == 0 else None
        elif r["toxic"] > 0:
            kind = None
        else:
            kind = "good" if r["h"] % 4 == 0 else "target"
        if kind is not None:
            out[kind].append(r["doc_id"])
    return {k: np.array(sorted(v), np.int64) for k, v in out.items()}


def _among(ids: pa.Array, chosen: np.ndarray) -> np.ndarray:
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    return known & np.isin(values, chosen)


def fit(docs: DataFrame, target: np.ndarray) -> Model:
    """Count both models over all of ``docs`` (doc_id, text)."""
    chosen = docs.sparkSession.sparkContext.broadcast(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, wanted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch):
                bucket, doc = features(part.column(1))
                raw += np.bincount(bucket, minlength=BUCKETS)
                good = _among(part.column(0), chosen.value)
                if good.any():
                    wanted += np.bincount(bucket[good[doc]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(raw[some]), pa.array(wanted[some])], ["bucket", "raw", "wanted"]
        )

    counts = np.zeros((2, BUCKETS))
    partial = in_arrow(_read(docs), run, "bucket long, raw long, wanted long")
    for r in partial.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("wanted").alias("wanted")).collect():
        counts[:, r["bucket"]] = r["raw"], r["wanted"]
    p = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return Model(np.log(p[1]) - np.log(p[0]))


def gumbel(ids: np.ndarray, seed: int = SEED) -> np.ndarray:
    """A standard Gumbel variate for each id."""
    x = mixed(ids.astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
    u = ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    return -np.log(-np.log(u))


def weigh(ids: pa.Array, texts: pa.Array, log_ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weights, and their sums with the Gumbel variates."""
    bucket, doc = features(texts)
    weight = np.bincount(doc, weights=log_ratio[bucket], minlength=len(texts)) if len(doc) else np.zeros(len(texts))
    return weight, weight + gumbel(ids.fill_null(-1).to_numpy(zero_copy_only=False))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, log_weight, gumbel_key of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model.log_ratio)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        weight, key = weigh(batch.column(0), batch.column(1), shared.value)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(weight), pa.array(key)], ["doc_id", "log_weight", "gumbel_key"]
        )

    return map_batches(_read(docs), work, "doc_id long, log_weight double, gumbel_key double")


def best_cutoff(good: np.ndarray, bad: np.ndarray) -> float:
    """The weight from which on documents count as good, with the best balanced accuracy."""
    if not len(good) or not len(bad):
        return float("-inf")
    good, bad = np.sort(good), np.sort(bad)
    tried = np.unique(np.concatenate([good, bad]))
    right = (len(good) - np.searchsorted(good, tried)) / len(good) + np.searchsorted(bad, tried) / len(bad)
    best = tried[right == right.max()][0]
    below = tried[tried < best]
    return float(best if not len(below) else (best + below[-1]) / 2)


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, exactly, from a few histograms; minus infinity for k beyond the rows."""
    part = values.select(F.col(column).alias("v"))
    low, high = part.agg(F.min("v"), F.max("v")).first()
    if low is None or k < 1:
        return float("inf") if k < 1 else float("-inf")
    while low < high:
        inside = part.where(F.col("v").between(low, high))
        place = F.floor((F.col("v") - low) / (high - low) * _BINS).alias("bin")
        bins = inside.groupBy(place).agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
        for r in sorted(bins.collect(), key=lambda r: -r["bin"]):
            if k <= r["n"]:
                low, high, n = r["a"], r["b"], r["n"]
                break
            k -= r["n"]
        else:
            return float("-inf")
        if n <= _COLLECTED and low < high:
            rows = part.where(F.col("v").between(low, high)).collect()
            return sorted((r["v"] for r in rows), reverse=True)[k - 1]
    return low


def labelled(spark: SparkSession, sample: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, kind of the ids held out; from Arrow, as rows from a list would start a second set of Python workers."""
    ids = pa.array(np.concatenate([sample["good"], sample["bad"]]), pa.int64())
    kinds = pa.array(["good"] * len(sample["good"]) + ["bad"] * len(sample["bad"]), pa.string())
    return spark.createDataFrame(pa.table({"doc_id": ids, "kind": kinds}))


def train(docs: DataFrame, labels: DataFrame, limit: int = LABEL_LIMIT) -> tuple[Model, DataFrame]:
    """The model with its threshold, and the scores of all rows (kept in the shared folder)."""
    sample = sample_labels(labels, limit)
    model = fit(docs, sample["target"])
    scored = keep(score(docs, model))
    held_out = labelled(docs.sparkSession, sample)
    # one weight for each held-out id, however many rows have it
    of_id = scored.join(F.broadcast(held_out), "doc_id").groupBy("doc_id", "kind").agg(F.min("log_weight").alias("log_weight"))
    seen = of_id.select("kind", "log_weight").distinct().collect()
    model.cutoff = best_cutoff(*[np.array([r["log_weight"] for r in seen if r["kind"] == k]) for k in ("good", "bad")])
    if not len(sample["target"]):
        model.cutoff = float("-inf")
    model.k = scored.where(F.col("log_weight") >= model.cutoff).count()
    model.threshold = kth_largest(scored, "gumbel_key", model.k)
    return model, scored


def resample(docs: DataFrame, labels: DataFrame, limit: int = LABEL_LIMIT) -> DataFrame:
    """doc_id, log_weight, gumbel_key, kept for every row of ``docs`` (doc_id, text)."""
    model, scored = train(docs, labels, limit)
    return scored.withColumn("kept", F.col("gumbel_key") >= model.threshold)


def drawn(docs: DataFrame, labels: DataFrame, limit: int = LABEL_LIMIT) -> DataFrame:
    """The rows of ``docs`` that the draw leaves, with all their columns; no text is shuffled."""
    model, _ = train(docs, labels, limit)
    return docs.where(_key(docs, model)(F.col("doc_id").cast("long"), F.col("text").cast("string")) >= model.threshold)


def _key(docs: DataFrame, model: Model):
    shared = docs.sparkSession.sparkContext.broadcast(model.log_ratio)
    bound_batches(docs)

    @F.arrow_udf("double")
    def key(ids: pa.Array, texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([ids, texts], ["doc_id", "text"])
        found = [weigh(p.column(0), p.column(1), shared.value)[1] for p in slices(batch)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return key


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
