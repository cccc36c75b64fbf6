import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from cases import TEXTS, documents, nothing, pairs
from tokenizers import Tokenizer

from gridsieve.llm import dac, pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_pieces_match_the_library(library):
    coder = pieces.PieceEncoder(pieces.default_model())
    rng = random.Random(5)
    signs = " abcdefthein\n\t0123.,%éà中文▁😀́ ²ß"
    made = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(4000)]
    for text in [*(t or "" for _, t in TEXTS), *made]:
        assert coder.encode(text) == library.encode(text) + [2], repr(text[:80])


def test_bounded_tables_do_not_change_results(library, monkeypatch):
    for name in ("WORDS_REMEMBERED", "PARTS_REMEMBERED", "PAIRS_REMEMBERED"):
        monkeypatch.setattr(pieces, name, 3)
    coder = pieces.PieceEncoder(pieces.default_model())
    text = "the quick brown fox, jumped over 12 lazy dogs. Der Fuchs springt schnell über den Hund."
    assert coder.encode(text) == library.encode(text) + [2]


def test_compatible_pairs_are_those_that_encode_to_themselves(library):
    coder = pieces.PieceEncoder(pieces.default_model())
    rng = random.Random(1)
    known = [i for i in coder.steps if not coder.left[i][-1].startswith("▁")]
    start = library.piece_to_id("▁")
    for _ in range(3000):
        a, b = rng.choice(known), rng.choice(known)
        text = library.id_to_piece(a) + library.id_to_piece(b)
        if any(c.isalpha() for c in text):
            ids = coder._ids(text)
            assert coder.compatible(a, b) == (list(ids) == [a, b])
    assert start in coder.steps


def test_piece_tables(spark, library):
    docs = documents(spark)
    expected = sorted(
        ((i, len(ids := library.encode(t or "") + [2]), sha(" ".join(map(str, ids))), sha(library.decode(ids))) for i, t in TEXTS),
        key=lambda r: tuple((v is not None, v) for v in r),
    )
    assert pairs(pieces.digests(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected
    back = pieces.decode_documents(pieces.encode_documents(docs))
    assert pairs(back, "doc_id", "text") == sorted(
        ((i, library.decode(library.encode(t or ""))) for i, t in TEXTS), key=lambda r: tuple((v is not None, v) for v in r)
    )
    assert pieces.digests(nothing(spark)).count() == 0


@pytest.mark.parametrize("n", [1, 63, 64, 65, 40_000, 200_000])
def test_codes_give_any_id(n):
    rng = np.random.default_rng(n)
    ids = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
    codes = dac.Dac(n, *dac.Dac.pack(ids))
    assert (codes.at(np.arange(n)) == ids).all()
    places = rng.integers(0, n, 500)
    assert (codes.at(places) == ids[places]).all()
    assert codes.at(np.zeros(0, np.int64)).tolist() == []


def expected_files(rows):
    coder = Tokenizer.from_file(dac.default_files()[0])
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_of_a_table(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    table = dac.kept_files(documents(spark, rows), segment_ids=3000)
    assert table.count() > 20
    assert pairs(dac.document_ids(table), "doc_id", "start", "n_tokens", "ids_crc32") == expected_files(rows)


def test_files_of_awkward_rows(spark, tmp_path):
    found = dac.document_ids(dac.write_files(documents(spark), str(tmp_path / "files"))).collect()
    byte_ids = {(i, n, c) for i, _, n, c in expected_files(TEXTS)}
    assert {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found} == byte_ids
    ordered = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] or -1 for r in ordered] == sorted(r["doc_id"] or -1 for r in ordered)
    assert [r["start"] for r in ordered] == np.r_[0, np.cumsum([r["n_tokens"] for r in ordered])][:-1].tolist()
    assert dac.document_ids(dac.kept_files(nothing(spark))).count() == 0


def test_fast_and_slow_encoders_agree():
    coder = dac.text_encoder(*dac.default_files())
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(0x250, 0xD7FF), 32, 10])) for _ in range(50))
        assert coder.encode(text).tolist() == coder.slow.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("sign", [" ", "\n", "a"])
@pytest.mark.parametrize("n", [99_999, 100_001, 999_990, 1_000_010])
def test_long_runs_on_both_sides_of_the_limit(sign, n):
    """The pattern of the fast encoder gives up on a million of white space; results stay those of the library."""
    coder = dac.text_encoder(*dac.default_files())
    text = "start" + sign * n + "end"
    assert coder.encode(text).tolist() == coder.slow.encode(text, add_special_tokens=False).ids
