"""SentencePiece (BPE) encoding through a table of last tokens, and decoding.

An encoding is determined by its neighbours: a row of tokens is the encoding of its text if
and only if every two adjacent tokens are *compatible*, that is, the text of the two encodes to
just these two.  So every prefix of a text has one possible last token.  The encoder walks the
matches of an automaton over all pieces, end by end, and stores for each prefix the match
whose predecessor (the last token of the shorter prefix) is compatible with it; the ids are
then read off backwards.  Work is linear in the text, however long a word is.

Compatibility is settled by replaying both tokens' merges in step: they stay apart unless the
symbols at their border can merge before the merges on either side.  Results are remembered in
bounded tables, as are the encodings of words; pieces never reach over a space, nor from letters
to other signs, which is checked when a model is loaded.

Defined results: null text counts as empty, whose only id is the end id; characters without a
piece become bytes; extra columns are ignored; repeated rows are encoded each; an empty table
gives an empty result.  The model file is read by every Python worker, so its path has to
exist on all machines (it belongs to the Python environment).
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsieve.llm.common import map_batches

SPACE = "▁"
WORDS_REMEMBERED = 200_000
PARTS_REMEMBERED = 50_000
PAIRS_REMEMBERED = 300_000
LONGEST_REMEMBERED = 64

_SEGMENT = re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Memo:
    """A bounded dictionary: when the young half is full, it replaces the old one."""

    def __init__(self, half: int):
        self.half, self.young, self.old = half, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[key] = value


class PieceEncoder:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model = model
        size = model.get_piece_size()
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        pieces = {model.id_to_piece(i): i for i in range(size) if i not in special}
        self.score = {piece: model.get_score(i) for piece, i in pieces.items()}
        self.end_id = model.eos_id()
        self.dummy_prefix = model.encode("a", out_type=str)[0].startswith(SPACE)
        self._check(pieces)
        single = [p for p in pieces if len(p) == 1]
        letters = "".join(p for p in single if p.isalpha())
        self.known = re.compile("[" + "".join(map(re.escape, single)) + "]+")
        self.word_or_rest = re.compile(rf"{SPACE}*[{letters}]+|{SPACE}*[^{letters}{SPACE}]+|{SPACE}+")
        self.automaton = ahocorasick.Automaton()
        self.right, self.left, self.steps = {}, {}, {}
        for piece, i in pieces.items():
            if self._replay(piece, i):
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.pairs = Memo(PAIRS_REMEMBERED)
        self.words = Memo(WORDS_REMEMBERED)
        self.parts = Memo(PARTS_REMEMBERED)

    @staticmethod
    def _check(pieces) -> None:
        for piece in pieces:
            body = piece.lstrip(SPACE)
            if SPACE in body or len({c.isalpha() for c in body}) > 1:
                raise ValueError(f"piece {piece!r} reaches over a border that the encoder cuts at")

    def _replay(self, piece: str, i: int) -> bool:
        """Store the merges that make a piece; false if merging does not end in the piece."""
        row = list(piece)
        right, left, steps = [row[-1]], [row[0]], []
        while len(row) > 1:
            best, at = None, -1
            for k in range(len(row) - 1):
                s = self.score.get(row[k] + row[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return False
            row[at : at + 2] = [row[at] + row[at + 1]]
            steps.append(best)
            right.append(row[-1])
            left.append(row[0])
        steps.append(float("-inf"))
        self.right[i], self.left[i], self.steps[i] = right, left, steps
        return True

    def compatible(self, a: int, b: int) -> bool:
        """Whether the text of token ``a`` and then ``b`` encodes to just these two."""
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            known = self._apart(a, b)
            self.pairs.put(key, known)
        return known

    def _apart(self, a: int, b: int) -> bool:
        right, left, first, second = self.right[a], self.left[b], self.steps[a], self.steps[b]
        score = self.score
        i = j = 0
        while True:
            across = score.get(right[i] + left[j])
            # The leftmost of equally good merges comes first.
            if across is not None and across > first[i] and across >= second[j]:
                return False
            if i + 1 == len(first) and j + 1 == len(second):
                return True
            if j + 1 == len(second) or (i + 1 < len(first) and first[i] >= second[j]):
                i += 1
            else:
                j += 1

    def _ids(self, text: str) -> tuple[int, ...]:
        """Ids of a text all of whose characters are pieces."""
        n = len(text)
        last = [-1] * (n + 1)
        begins = [0] * (n + 1)
        settled = self.pairs.young
        for end, (token, length) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            begin = end - length
            if begin:
                before = last[begin]
                if before < 0:
                    continue
                apart = settled.get(before << 20 | token)
                if apart is None:
                    apart = self.compatible(before, token)
                    settled = self.pairs.young
                if not apart:
                    continue
            last[end], begins[end] = token, begin
        ids = []
        while n:
            ids.append(last[n])
            n = begins[n]
        return tuple(ids[::-1])

    def _whole(self, text: str) -> tuple[int, ...]:
        """Ids of a text in which characters without a piece may stand."""
        run = self.known.match(text)
        if run and run.end() == len(text):
            return self._ids(text)
        ids, at = [], 0
        for run in self.known.finditer(text):
            ids += [self.bytes[b] for b in text[at : run.start()].encode("utf-8", "replace")]
            ids += self._ids(run.group())
            at = run.end()
        ids += [self.bytes[b] for b in text[at:].encode("utf-8", "replace")]
        return tuple(ids)

    def _part(self, part: str) -> tuple[int, ...]:
        found = self.parts.get(part)
        if found is None:
            found = self._whole(part)
            if len(part) <= LONGEST_REMEMBERED:
                self.parts.put(part, found)
        return found

    def _word(self, word: str) -> tuple[int, ...]:
        """Ids of a word that follows a space."""
        found = self.words.get(word)
        if found is None:
            if word.isalpha():
                found = self._whole(SPACE + word)
            else:
                first, *rest = self.word_or_rest.findall(SPACE + word)
                head = first[1:]
                ids = list(self._word(head) if head.isalpha() else self._part(first))
                for part in rest:
                    ids += self._part(part)
                found = tuple(ids)
            if len(word) <= LONGEST_REMEMBERED:
                self.words.put(word, found)
        return found

    def _segment(self, segment: str) -> tuple[int, ...]:
        return tuple(i for part in self.word_or_rest.findall(segment) for i in self._part(part))

    def encode(self, text: str) -> list[int]:
        """All ids of a text, the end id last."""
        ids: list[int] = []
        if text:
            if "  " in text or text[0] == " " or text[-1] == " " or SPACE in text or not self.dummy_prefix:
                marked = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
                for segment in _SEGMENT.findall(marked):
                    ids += self._segment(segment)
            else:
                remembered, word_ids = self.words.young.get, self._word
                for word in text.split(" "):
                    ids += remembered(word) or word_ids(word)
        ids.append(self.end_id)
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids (array of int, the end id last) of every row of ``docs`` (doc_id, text)."""
    path = model or default_model()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = encoder(path).encode
        ids = [encode(t or "") for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
        )

    return map_batches(_read(docs), work, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, text of every row of ``encoded`` (doc_id, ids)."""
    path = model or default_model()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        decode = encoder(path).decode
        texts = [decode(ids or []) for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), work, "doc_id long, text string")


def digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded and decoded in one task, document by document."""
    path = model or default_model()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(path)
        named = [str(i) for i in range(coder.model.get_piece_size())]
        counts, shas, decoded = [], [], []
        for text in batch.column(1).to_pylist():
            ids = coder.encode(text or "")
            counts.append(len(ids))
            shas.append(hashlib.sha256(" ".join([named[i] for i in ids]).encode()).hexdigest())
            decoded.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_batches(
        _read(docs), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
