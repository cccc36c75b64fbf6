import collections
import hashlib
import re

import numpy as np
import pytest
import xxhash
from cases import TEXTS, documents, nothing, pairs
from pyspark.sql import functions as F

from gridsieve.llm import chunks, components, simhash

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes, bits=2):
    root = list(range(len(codes)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(codes)):
        for b in np.flatnonzero(np.bitwise_count(codes[a + 1 :] ^ codes[a]) <= bits):
            x, y = find(a), find(a + 1 + int(b))
            root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(codes))]


def expected_copies(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        out.append((doc_id, max(ids, default=None), len(groups[text or ""]), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


def test_exact_copies_of_awkward_rows(spark):
    found = chunks.exact_duplicates(documents(spark))
    assert pairs(found, "doc_id", "keep_id", "group_size", "text_sha256") == expected_copies(TEXTS)
    kept = found.where("kept").collect()
    assert len(kept) == len({t or "" for _, t in TEXTS})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_ambiguous_chunk_ids_do_not_merge_texts(spark):
    rows = [(i, f"text number {i % 40} " + "padding words " * 100) for i in range(120)]
    weak = lambda c: F.pmod(F.xxhash64(c), F.lit(5))
    found = chunks.exact_duplicates(documents(spark, rows), (weak,))
    assert pairs(found, "doc_id", "keep_id", "group_size", "text_sha256") == expected_copies(rows)


def test_too_many_ambiguous_ids_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(chunks, "MAX_AMBIGUOUS", 0)
    weak = lambda c: F.pmod(F.xxhash64(c), F.lit(2))
    with pytest.raises(ValueError):
        chunks.exact_duplicates(documents(spark), (weak,))


def test_chunks_join_to_the_text(spark):
    docs = documents(spark).select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    cut = docs.select("t", chunks.cut(F.col("t")).alias("c"))
    assert cut.where(F.array_join("c", "") != F.col("t")).count() == 0
    assert cut.select(F.max(F.size("c"))).first()[0] > 50


def test_no_rows(spark):
    assert chunks.exact_duplicates(nothing(spark)).count() == 0
    assert simhash.near_duplicates(nothing(spark)).count() == 0


def test_fingerprints_match_the_definition():
    for _, text in TEXTS:
        assert simhash.fingerprint(text or "") == plain_fingerprint(text or "")


@pytest.mark.parametrize("max_group", [simhash.MAX_GROUP, 3])
def test_components_match_all_pairs(spark, max_group):
    base = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    near = [(1000 + k, (base[k % 20][1] or "") + f" tail{k}") for k in range(120)]
    rows = [*base, *near, *TEXTS]
    found = simhash.near_duplicates(documents(spark, rows), max_group=max_group)
    codes = np.array([simhash.fingerprint(t or "") for _, t in rows], np.uint64)
    roots = plain_components(codes)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    expected = sorted(
        ((i, int(c), least.get(r)) for (i, _), c, r in zip(rows, codes.view(np.int64), roots)),
        key=lambda r: tuple((v is not None, v) for v in r),
    )
    assert pairs(found, "doc_id", "code", "component_id") == expected
    heads = found.where("kept").select("component_id", "doc_id", "text_sha256").distinct().count()
    assert heads == len(set(roots))


def test_index_finds_all_links_in_dense_and_sparse_groups():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 6).astype(np.uint64)
    dense = [int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centre for a, b in rng.integers(0, 64, (200, 2))]
    codes = np.unique(np.array([*dense, *rng.integers(0, 2**63, 500).tolist()], np.uint64))
    rank = codes.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    codes = codes[np.argsort(rank)]
    found = simhash.link_forest(np.zeros(len(codes), np.int64), codes)
    assert found.tolist() == plain_components(codes)
    index = simhash.GrayIndex(codes)
    query, member = index.search(np.arange(len(codes)), 2, np.arange(len(codes)))
    links = {(a, b) for a, b in zip(query.tolist(), member.tolist())}
    brute = {(a, int(b)) for a in range(len(codes)) for b in np.flatnonzero(np.bitwise_count(codes ^ codes[a]) <= 2) if a != b}
    assert links == brute


def test_every_group_goes_through_the_index(spark, monkeypatch):
    searched = []
    plain_search = simhash.GrayIndex.search

    def search(self, asked, *rest):
        searched.extend(self.group[asked].tolist())
        return plain_search(self, asked, *rest)

    monkeypatch.setattr(simhash.GrayIndex, "search", search)
    rng = np.random.default_rng(5)
    sizes = [1, 2, 8, 9, 1, 64, 65, 3, 700, 2, 1]
    codes, group, expected = [], [], []
    for g, size in enumerate(sizes):
        centre = int(rng.integers(0, 2**63))
        flips = rng.integers(0, 64, (size, 3)).tolist()
        own = np.array([centre ^ (1 << a) ^ (1 << b) ^ (1 << c) for a, b, c in flips], np.uint64)
        expected += [len(codes) + r for r in plain_components(own)]
        codes += own.tolist()
        group += [g] * size
    found = simhash.link_forest(np.array(group), np.array(codes, np.uint64))
    assert found.tolist() == expected
    assert len(searched) == sum(s for s in sizes if s > 1)
    assert simhash.link_forest(np.zeros(0, np.int64), np.zeros(0, np.uint64)).tolist() == []
    # Groups of the given table: more links than none, all of them out of the index.
    nodes = simhash.fingerprints(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).select("code").distinct()
    rows = simhash.groups(nodes.withColumn("node", F.col("code"))).orderBy("mask", "pattern", simhash.gray_rank(F.col("code"))).collect()
    searched.clear()
    keys = [(r["mask"], r["pattern"]) for r in rows]
    numbers = np.cumsum([0] + [a != b for a, b in zip(keys, keys[1:])])
    simhash.link_forest(numbers, np.array([r["code"] for r in rows], np.int64).view(np.uint64))
    assert len(searched) == len(rows) > 0


def test_components_of_paths_stars_and_nothing(spark):
    path = [(k, k + 1) for k in range(60)]
    star = [(100, 100 + k) for k in range(1, 50)] + [(120, 100), (7, 7), (None, 3)]
    links = spark.createDataFrame(path + star, "a long, b long")
    found = dict(pairs(components.connected(links), "node", "component"))
    assert found == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 150)}}
    assert components.connected(links.where("a < 0")).count() == 0
