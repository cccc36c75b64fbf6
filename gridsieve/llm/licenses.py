"""Licence scans: an automaton finds phrases and tags, a shunting-yard parser reads expressions.

A text is lower-cased (A-Z) and cut into words.  One Aho-Corasick automaton over the words, one
space between them, finds every phrase whose words stand consecutively, overlapping ones too.
Where it finds an identifier tag, the rest of that line, up to a next tag, is read as a licence expression: ``and``,
``or``, ``with``, parentheses and identifiers, ``with`` binding strongest, then ``and``.  Identifiers are
whole names, or a family with its version (``GPL-3.0-or-later``); the expression ends where the grammar does.

Freedom of a licence is a number from 0 (all rights reserved) to 1 (permissive).  In an
expression ``or`` takes the larger, ``and`` the smaller, and ``with`` an exception frees a copyleft
licence halfway.  Statements of a text hold together, so its score is the least of all; a text
that states nothing scores ``UNSTATED``.  Phrases that stand inside a longer phrase of the table
(``general public license`` in ``lesser general public license``) give their label but do not lower the
score.

Defined results: null text counts as empty; a text without words has zero places and null first
and last words; an expression that cannot be parsed, or names an unknown identifier, keeps the
known identifiers read up to its end, joined as by ``and``; repeated rows are scanned each; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsieve.llm.common import map_batches

# Phrases whose places are counted, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Further notice phrases, their labels and their freedom.
NOTICE_PHRASES = {
    "apache license": ("apache", 1.0),
    "mit license": ("mit", 1.0),
    "bsd license": ("bsd", 1.0),
    "isc license": ("isc", 1.0),
    "permission is hereby granted free of charge": ("mit", 1.0),
    "redistribution and use in source and binary forms": ("bsd", 1.0),
    "mozilla public license": ("mpl", 0.6),
    "eclipse public license": ("epl", 0.6),
    "lesser general public license": ("lgpl", 0.5),
    "affero general public license": ("agpl", 0.2),
    "gnu general public license": ("gpl", 0.3),
    "free documentation license": ("gfdl", 0.4),
    "creative commons": ("creative-commons", 0.8),
    "cc by sa": ("cc-by-sa", 0.5),
    "cc by nc": ("cc-by-nc", 0.2),
    "cc by nd": ("cc-by-nd", 0.2),
    "cc by nc sa": ("cc-by-nc-sa", 0.2),
    "cc by nc nd": ("cc-by-nc-nd", 0.1),
    "cc0": ("cc0", 1.0),
    "public domain": ("public-domain", 1.0),
    "no rights reserved": ("public-domain", 1.0),
}
BASE_FREEDOM = {"cc-by": 0.8, "gpl": 0.3, "reserved": 0.0}
TAG_PHRASES = ("spdx license identifier", "license expression", "licence expression")

# Freedom of expression identifiers: whole names, and families that a version follows.
WHOLE_NAMES = {
    "0bsd": 1.0, "cc0": 1.0, "isc": 1.0, "mit": 1.0, "mit-0": 1.0, "proprietary": 0.0, "unlicense": 1.0, "wtfpl": 1.0,
    "x11": 1.0, "zlib": 1.0,
}
FAMILIES = {
    "agpl": 0.2, "apache": 1.0, "artistic": 0.7, "bsl": 1.0, "cc-by": 0.8, "cc-by-nc": 0.2, "cc-by-nc-nd": 0.1,
    "cc-by-nc-sa": 0.2, "cc-by-nd": 0.2, "cc-by-sa": 0.5, "cc0": 1.0, "cddl": 0.6, "epl": 0.6, "eupl": 0.4, "gfdl": 0.4,
    "gpl": 0.3, "lgpl": 0.5, "mpl": 0.6,
}
UNSTATED = 0.5

_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
_WORD = re.compile(rb"[^ ]+")
_REST = re.compile(rb"[ \t]*[:=]?[ \t]*([^\n\r]*)")
# White space and quotes may stand between the parts of an expression; any other sign ends it.
_LEXEME = re.compile(r"[\s\"'`]*([()]|[A-Za-z0-9](?:[A-Za-z0-9.+\-]*[A-Za-z0-9+])?)")
_VERSIONED = re.compile(r"([a-z0-9\-]*?[a-z0-9])-[0-9]+(?:\.[0-9]+)*(?:-only|-or-later|\+)?")
_CLAUSES = re.compile(r"bsd-[0-9]-clause(?:-[a-z]+)*")
_BINDS = {"or": 1, "and": 2, "with": 3}


@dataclass
class Found:
    freedom: float | None
    names: tuple[str, ...]


def freedom_of(name: str) -> float | None:
    """Freedom of a whole identifier in lower case; None if it is not known."""
    if name in WHOLE_NAMES:
        return WHOLE_NAMES[name]
    if _CLAUSES.fullmatch(name):
        return 1.0
    versioned = _VERSIONED.fullmatch(name)
    return FAMILIES.get(versioned[1]) if versioned else None


def evaluate(expression: str) -> Found:
    """Freedom of the expression a string starts with, by the shunting-yard method.

    Its names are the known identifiers the parser has read as licences: neither what follows the
    end of the expression nor an exception behind ``with`` gives a name.
    """
    names: dict[str, float] = {}
    values: list[float | None] = []
    waiting: list[str] = []
    end = 0

    def apply() -> None:
        sign = waiting.pop()
        right, left = values.pop(), values.pop()
        if sign == "with":
            values.append(None if left is None else left if left >= 1 else (left + 1) / 2)
        elif left is None or right is None:
            raise ValueError("unknown identifier")
        else:
            values.append(max(left, right) if sign == "or" else min(left, right))

    try:
        operand = True
        while lexeme := _LEXEME.match(expression, end):
            x = lexeme[1].lower()
            if x == "(":
                if not operand:
                    break
                waiting.append(x)
            elif x == ")":
                if operand or "(" not in waiting:
                    break
                while waiting[-1] != "(":
                    apply()
                waiting.pop()
            elif x in _BINDS:
                if operand:
                    raise ValueError("operator without operand")
                while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[x]:
                    apply()
                waiting.append(x)
                operand = True
            elif not operand:
                break  # the expression has ended, prose follows
            else:
                exception = bool(waiting) and waiting[-1] == "with"
                free = None if exception else freedom_of(x)
                if free is not None:
                    names[x] = free
                values.append(free)
                operand = False
            end = lexeme.end()
        if "(" in waiting:
            raise ValueError("open parenthesis")
        while waiting:
            apply()
        if len(values) != 1 or values[0] is None:
            raise ValueError("no value")
        freedom = values[0]
    except (ValueError, IndexError):
        freedom = min(names.values(), default=None)
    return Found(freedom, tuple(names))


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    table = {p: (p, label, BASE_FREEDOM[label], True) for p, label in BASE_PHRASES.items()}
    table |= {p: (p, label, free, False) for p, (label, free) in NOTICE_PHRASES.items()}
    table |= {p: (p, "", None, False) for p in TAG_PHRASES}
    for phrase, entry in table.items():
        found.add_word(f" {phrase} ", entry)
    found.make_automaton()
    return found


def scan_text(text: str) -> dict:
    """What one text states; see ``scan`` for the fields."""
    data = text.encode("utf-8", "replace")
    plain = data.translate(_WORDS)
    words = plain.split()
    line = (b" " + b" ".join(words) + b" ").decode("utf-8")
    n_base, first, last = 0, None, None
    base, labels = set(), set()
    tags: list[tuple[int, int]] = []
    spans: list[tuple[int, int, float]] = []
    spaces: np.ndarray | None = None
    for end, (phrase, label, free, is_base) in automaton().iter(line):
        start = end - len(phrase) - 1
        if is_base or free is None:
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 0x20)
            place = int(np.searchsorted(spaces, start))
        if is_base:
            n_base += 1
            first = place if first is None else min(first, place)
            last = place if last is None else max(last, place)
            base.add(label)
        if free is None:
            tags.append((place, place + phrase.count(" ")))
        else:
            labels.add(label)
            spans.append((start, end, free))
    free = _outer(spans)
    expressions = []
    if tags:
        at = [m.span() for m in _WORD.finditer(plain)]
        limits = [at[first_of][0] for first_of, _ in tags[1:]] + [len(data)]
        for (_, last_of), limit in zip(tags, limits):
            rest = _REST.match(data, at[last_of][1], limit)[1].decode("utf-8", "replace")
            found = evaluate(rest)
            if found.names:
                expressions.append(" ".join(rest.split()))
                labels.update(found.names)
                free.append(found.freedom)
    return {
        "n_words": len(words),
        "n_base": n_base,
        "first_word": first,
        "last_word": last,
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "score": float(min(free, default=UNSTATED)),
        "expressions": expressions,
    }


def _outer(spans: list[tuple[int, int, float]]) -> list[float]:
    """Freedom of the spans that do not lie inside another one."""
    out, reach = [], -1
    for a, b, f in sorted(spans, key=lambda s: (s[0], -s[1])):
        if b > reach:
            out.append(f)
            reach = b
    return out


_FIELDS = (
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("expressions", pa.list_(pa.string())),
)
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, expressions array<string>"
)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, text).

    n_base counts the places of base phrases; first_word and last_word are the least and largest
    of their first words, from 0; labels has those of notices and expressions as well.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [scan_text(t or "") for t in batch.column(1).to_pylist()]
        columns = [pa.array([r[name] for r in rows], kind) for name, kind in _FIELDS]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *[n for n, _ in _FIELDS]])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), work, SCHEMA)
