"""Alignment of the tokenizers against the libraries and plain counting."""

import collections
import hashlib
import json
import random

import numpy as np
import pytest
import sentencepiece
from cases import TEXTS, documents, nothing, pairs
from tokenizers import Tokenizer

from gridsieve.llm import alignment
from gridsieve.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_letters():
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in shown):
        letters[chr(256 + k)] = b
    return letters


@pytest.fixture(scope="module")
def tools():
    a_path, _, b_path = alignment.default_files()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    letters = byte_letters()
    vocabulary = json.load(open(a_path))["model"]["vocab"]
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if all(c in letters for c in t)}
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes = {}
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        b_bytes[i] = bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
    return a, a_bytes, b, b_bytes


def ends_of(ids, known):
    return list(np.cumsum([len(known[i]) for i in ids]).tolist())


def plain_document(text, tools):
    """ids of both sides, groups and links, or None."""
    a, a_bytes, b, b_bytes = tools
    if not text:
        return None
    whole = (" " + text).encode()
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    if b"".join(a_bytes[i] for i in ids[0]) != whole or b"".join(b_bytes[i] for i in ids[1]) != whole:
        return None
    ends = ends_of(ids[0], a_bytes), ends_of(ids[1], b_bytes)
    meets = sorted(set(ends[0]) & set(ends[1]))
    groups = [([], []) for _ in meets]
    for side in (0, 1):
        g = 0
        for i, end in zip(ids[side], ends[side]):
            groups[g][side].append(i)
            g += end == meets[g]
    at = dict(zip(ends[0], ids[0])), dict(zip(ends[1], ids[1]))
    links = [(at[0][e], at[1][e]) for e in meets]
    return ids, groups, links


def plain_align(rows, tools):
    found = [plain_document(t, tools) for _, t in rows]
    counts = collections.Counter(link for f in found if f for link in f[2])
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for (doc_id, _), f in zip(rows, found):
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        ids, groups, links = f
        spelled = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        spelled = hashlib.sha256(spelled.encode()).hexdigest()
        n_best = sum(counts[link] == best[link[1]] for link in links)
        out.append((doc_id, len(ids[0]), len(ids[1]), len(links), len(links), n_best, sum(counts[k] for k in links), spelled))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


ODD = [
    (30, "<|endoftext|> </s> <s> <unk> <0x41>"), (31, "a▁b"), (32, " leading"), (33, "trailing  "), (34, "\n\n\t x"),
    (35, "日本語のテキスト"), (36, "naïve ÀÉ é"), (37, "😀😀 x"), (38, "\x00\x01"), (39, "don't  can't I'll 12345 67"), (40, "x" * 3000),
]


@pytest.mark.parametrize("heavy_bits", [1, 18])
def test_awkward_rows(spark, tools, heavy_bits):
    rows = TEXTS + ODD
    found = pairs(alignment.align(documents(spark, rows), heavy_bits=heavy_bits), *COLUMNS)
    assert found == plain_align(rows, tools)
    assert alignment.align(nothing(spark)).count() == 0


def test_query_matches_plain_counting(spark, tools):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert pairs(QUERIES["op12_alignment"](spark, SF), *COLUMNS) == plain_align(rows, tools)
    few = spark.read.parquet(f"{SF}/documents.parquet").repartition(6)
    assert pairs(alignment.align(few, heavy_bits=4), *COLUMNS) == plain_align(rows, tools)


def test_identity_map_and_bytes(tools):
    _, a_bytes, b, b_bytes = tools
    tool = alignment.aligner(alignment.default_files())
    assert all(tool.a.bytes[i] == t for i, t in a_bytes.items())
    assert all(tool.b.bytes[i] == t for i, t in b_bytes.items() if not (b.is_control(i) or b.is_unknown(i)))
    some = np.flatnonzero(tool.same >= 0)
    assert len(some) > 10_000
    assert all(a_bytes[i] == b_bytes[tool.same[i]] for i in some.tolist())
    of = {t for i, t in b_bytes.items() if not (b.is_control(i) or b.is_unknown(i))}
    assert all(a_bytes[i] not in of for i in np.flatnonzero(tool.same < 0).tolist() if i in a_bytes)


def test_long_runs_of_white_space(tools):
    """The fast encoder gives up on them; both sides of its limit give the library's ids."""
    a, _, _, _ = tools
    tool = alignment.aligner(alignment.default_files())
    for sign in " \n\t":
        for n in (99_999, 1_000_000):
            text = "a" + sign * n + "b"
            assert tool.a.encode(text).tolist() == a.encode(text, add_special_tokens=False).ids
    with pytest.raises(ValueError):
        tool.a.fast.encode_to_numpy(" " * 1_000_000, disallowed_special=())


def test_fuzzed_texts(tools):
    tool = alignment.aligner(alignment.default_files())
    rng = random.Random(8)
    signs = "   abcdeTHEinréà中文😀\n\t0123.,'▁"
    for _ in range(1500):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 40)))
        found, expected = tool.align(text, tool.b.encode([text])[0]), plain_document(text, tools)
        if expected is None:
            assert found is None
            continue
        ids, groups, links = expected
        assert found[:3] == (len(ids[0]), len(ids[1]), len(links))
        same = [x for x, g in zip(links, groups) if len(g[0]) == len(g[1]) == 1 and tool.same[x[0]] == x[1]]
        assert found[4].tolist() == [x for x, _ in same]
        others = collections.Counter(links) - collections.Counter(same)
        assert collections.Counter((p >> 32, p & 0xFFFFFFFF) for p in found[5].tolist()) == others
