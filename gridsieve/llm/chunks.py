"""Exact duplicates through content-defined chunk recipes, in DataFrame functions only.

1. Texts are cut where their content says so (a vowel or an ``s``, then white space, after at
   least ``MIN_CHARS``), so copies are cut alike.
2. Each chunk gets a 64-bit identifier.  One job moves every *distinct* chunk once and finds
   identifiers that stand for two texts.  Recipes spell such chunks out, so equal recipes mean
   equal texts, whatever the hash does.
3. Recipes, lists of identifiers, are grouped and compared; the texts do not move again.

Defined results: null text counts as empty; empty texts are copies of each other; of repeated
rows with the same doc_id and text exactly one is kept; a null doc_id loses against any other;
an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsieve.llm.common import keep, keep_for_join, text_or_empty

MIN_CHARS, MAX_CHARS = 512, 4096
CHUNK = rf"(?s).{{{MIN_CHARS},{MAX_CHARS}}}?(?<=[aeious]\s)|.{{1,{MAX_CHARS}}}"

# More ambiguous identifiers than this call for a wider hash instead of spelled-out chunks.
MAX_AMBIGUOUS = 10_000

Digest = Callable[[Column], Column]
DIGESTS: tuple[Digest, ...] = (F.xxhash64, lambda c: F.sha2(c, 256))


def cut(text: Column) -> Column:
    """The chunks of a text in order; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def ambiguous_ids(docs: DataFrame, digest: Digest) -> DataFrame:
    """Identifiers that more than one chunk text has; each distinct chunk is moved once."""
    chunk = docs.select(F.explode(cut(text_or_empty())).alias("chunk"))
    distinct = chunk.select(digest(F.col("chunk")).alias("id"), "chunk").distinct()
    return distinct.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")


def recipes(docs: DataFrame, digests: tuple[Digest, ...] = DIGESTS) -> DataFrame:
    """One row per document: doc_id, text_sha256, row, recipe; kept in the shared folder."""
    for digest in digests:
        doubtful = [r["id"] for r in ambiguous_ids(docs, digest).limit(MAX_AMBIGUOUS + 1).collect()]
        if len(doubtful) <= MAX_AMBIGUOUS:
            break
    else:
        raise ValueError(f"more than {MAX_AMBIGUOUS} chunk identifiers are ambiguous")

    def name(chunk: Column) -> Column:
        if not doubtful:
            return digest(chunk)
        spelled = F.concat(F.lit("="), chunk)
        return F.when(digest(chunk).isin(doubtful), spelled).otherwise(digest(chunk).cast("string"))

    text = text_or_empty()
    return keep(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.sha2(text, 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
            F.transform(cut(text), name).alias("recipe"),
        )
    )


def exact_duplicates(docs: DataFrame, digests: tuple[Digest, ...] = DIGESTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text)."""
    rows = recipes(docs, digests)
    groups = keep_for_join(
        rows.groupBy(F.col("recipe").alias("same")).agg(
            F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")
        )
    )
    return rows.join(groups, rows["recipe"] == groups["same"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )
