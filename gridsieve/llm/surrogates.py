"""Personal data replaced by keyed surrogates of the same type and format.

Detected: e-mail and IP addresses, phone, card, account and social security numbers, secrets
(long hexadecimal strings, values assigned to tokens and passwords), and names after a form of
address.  A surrogate is drawn from an HMAC of the entity under a key:

* digits become digits, letters letters of the same case and script, signs stay where they are;
  numbers with a valid check digit get one, octets stay below 256, country codes stay;
* a name has as many words, initials and particles as stand behind the form of address and its titles;
  every word of a name is an entity of its own, so a full name and a surname alone remain one
  person; first names follow the gender of the form of address, and new names are pronounceable;
* a word of a name is replaced wherever it stands in the same document with a capital, also without
  a form of address, and is taken as the first name or surname that a full name shows it to be (the
  latest one, where they differ).  Lone initials are replaced after a form of address only.

The same entity has the same surrogate in all documents (coreference).  Two entities must not
share one (distinctness, among first names and surnames too), and a surrogate must not be an entity that occurs: the entities of all
documents are checked on Spark, and those that collide, except the first, are drawn again until
none is left.  Later draws are longer, so this ends also where a format holds fewer surrogates than
there are entities.  Entities drawn again travel by a join with the documents they occur in; if there
are none, no text is shuffled.

Defined results: null text counts as empty and stays empty; texts without entities stay as they are;
of overlapping finds the earlier, then the longer one counts; repeated rows are treated alike; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsieve.llm.common import id_key, keep, map_batches, text_or_empty

KEY = b"replace me: every corpus should have a key of its own"
#: So many draws keep the length of the entity; each one after them has a sign, sound or octet more.
SAME_LENGTH_DRAWS = 8

_EMAIL = re.compile(r"[\w.+\-]{1,64}@[\w\-]+(?:\.[\w\-]+)+")
_DIGITS = re.compile(r"\d[\d .\-()]{5,}")
_NUMBER = re.compile(
    r"(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d))"
    r"|(?P<phone>(?<![\d\w])(?:\+\d{1,3}[ \-]?)?(?:\(\d{3}\)|\d{3})[ \-.]\d{3}[ \-.]\d{4}(?!\d))"
    r"|(?P<ssn>(?<!\d)\d{3}-\d{2}-\d{4}(?!\d))"
    r"|(?P<card>(?<![\d\w])\d(?:[ \-]?\d){12,18}(?!\d))"
)
_ACCOUNT = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?")
_HEX = re.compile(r"[0-9A-Fa-f]{32,}")
_ASSIGNED = re.compile(r"[=:]\s{0,4}[\"']?([A-Za-z0-9+/_\-]{12,})")
_SECRET_NAME = re.compile(r"(?:token|secret|passw(?:or)?d|api[_\- ]?key|credential)s?[\"']?\s{0,4}$", re.I)
_ADDRESSED = re.compile(
    r"(?P<title>M(?:rs?|s|iss|me|lle)|Herrn?|Frau|S(?:ra?|eñora?)|D(?:r|oña|on)|Prof|Г-(?:н|жа))\b\.?[ \t]+(?=[^\W\d_])"
)
_BLANKS = re.compile(r"[ \t]+")
_NAME_WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
_LETTERS_ONLY = re.compile(r"[^\W\d_]+")
_POSSESSIVE = re.compile(r"['’][sS]$")
# Forms of address by gender.
FEMALE = frozenset(("Mrs", "Ms", "Miss", "Mme", "Mlle", "Frau", "Sra", "Señora", "Doña", "Г-жа"))
MALE = frozenset(("Mr", "M", "Herr", "Herrn", "Sr", "Señor", "Don", "Г-н"))

# What may stand between a form of address and a name or within a name, and what follows one.
TITLES = frozenset(("Dr", "Prof", "Dra", "Mag", "Dipl", "Ing", "Rev", "Hon"))
DEGREES = frozenset("med phil rer nat jur h c iur ing pol oec habil".split())
PARTICLES = frozenset(
    "af al av bin bint d da dal de dei del della den der des di dos du e el la las le los op 't ten ter van vom von y zu zum zur".split()
)
SUFFIXES = frozenset(("Jr", "Sr", "Jun", "Sen", "II", "III", "IV"))

# Sounds of new names by script: consonants, vowels, endings of female and of other first names.
SOUNDS = {
    "LATIN": ("b d f g k l m n p r s t v".split(), "a e i o u".split(), "a ia ina".split(), "n r s".split()),
    "CYRILLIC": ("б в г д к л м н п р с т".split(), "а е и о у".split(), "а ия ина".split(), "н р с".split()),
    "GREEK": ("β γ δ κ λ μ ν π ρ σ τ".split(), "α ε ι ο".split(), "α ια ινα".split(), "ν ς".split()),
}

_LETTERS, _DECIMALS = "abcdefghijklmnopqrstuvwxyz", "0123456789"

Entity = tuple[int, int, str, str]


def _is_name(word: str) -> bool:
    """A word with a capital, behind an elided article too, or of a script without capitals."""
    first = word[2:3] if word[:2] in ("d'", "d’", "l'", "l’") else word[0]
    return first.isupper() or unicodedata.category(word[0]) == "Lo"


def _name_parts(text: str, m: re.Match) -> Iterator[tuple[int, int, str, str, bool]]:
    """The words of a name after a form of address, and whether the kind of each is certain.

    Titles, degrees and particles are passed over; a name has as many words and initials as stand
    there.  Behind a particle all words are surnames, and so is the last one.
    """
    taken: list[tuple[int, str, bool]] = []
    at, behind = m.end(), False
    while w := _NAME_WORD.match(text, at):
        word, at = w[0], w.end()
        dotted = text.startswith(".", at)
        if not taken and (word in TITLES or (dotted and word in DEGREES)):
            at += dotted
        elif dotted and len(word) == 1 and word.isupper():
            taken.append((w.start(), word, behind))
            # initials may stand without a blank between them
            gap = _BLANKS.match(text, at + 1)
            at = gap.end() if gap else at + 1
            continue
        elif taken and word in SUFFIXES:
            break
        elif word in PARTICLES:
            behind = True
        elif _is_name(word):
            taken.append((w.start(), word, behind))
        else:
            break
        gap = _BLANKS.match(text, at)
        if not gap:
            break
        at = gap.end()
    gender = "f" if m["title"] in FEMALE else "m" if m["title"] in MALE else "n"
    for k, (start, word, after_particle) in enumerate(taken):
        kind = "surname" if after_particle or k == len(taken) - 1 else f"first_{gender}"
        word = _POSSESSIVE.sub("", word)
        yield start, start + len(word), kind, word.casefold(), len(taken) > 1 and kind != "first_n"


def _names(text: str) -> list[Entity]:
    """Names after forms of address, and all other mentions of their words in the text."""
    titled = {}
    m = _ADDRESSED.search(text)
    while m:
        parts = list(_name_parts(text, m)) if m.start() == 0 or not text[m.start() - 1].isalnum() else []
        titled.update((p[0], p) for p in parts)
        m = _ADDRESSED.search(text, parts[-1][1] if parts else m.end("title"))
    if not titled:
        return []
    # What an uncertain mention is: certain kinds come first, then first names.
    order = sorted(titled.values(), key=lambda p: (not p[4], p[2] == "surname", p[0]))
    kinds = {word: kind for _, _, kind, word, _ in reversed(order)}
    found = []
    for w in _NAME_WORD.finditer(text):
        part = titled.get(w.start())
        if part:
            start, end, kind, word, certain = part
            if certain:
                kinds[word] = kind
            found.append((start, end, kinds[word], word))
            continue
        pieces = [(w.start(), w[0] if w[0].casefold() in kinds else _POSSESSIVE.sub("", w[0]))]
        if pieces[0][1].casefold() not in kinds:
            pieces = [(w.start() + p.start(), p[0]) for p in _LETTERS_ONLY.finditer(w[0])]
        for start, word in pieces:
            if word.casefold() in kinds and _is_name(word) and (len(word) > 1 or not word.isupper()):
                found.append((start, start + len(word), kinds[word.casefold()], word.casefold()))
    return found


def find_entities(text: str) -> list[Entity]:
    """(start, end, kind, entity) in order, without overlaps."""
    found: list[Entity] = []
    at = text.find("@")
    while at >= 0:
        low = max(0, at - 64)
        for m in _EMAIL.finditer(text, low, at + 260):
            if m.start() <= at < m.end():
                found.append((m.start(), m.end(), "email", m[0].lower()))
        at = text.find("@", at + 1)
    for run in _DIGITS.finditer(text):
        low = max(0, run.start() - 6)
        for m in _NUMBER.finditer(text, low, run.end()):
            kind, value = m.lastgroup, m[0]
            if kind == "ip" and any(int(o) > 255 for o in value.split(".")):
                continue
            found.append((m.start(), m.end(), kind, value if kind == "ip" else re.sub(r"\D", "", value)))
    for m in _HEX.finditer(text):
        found.append((m.start(), m.end(), "secret", m[0]))
    for m in _ASSIGNED.finditer(text):
        if _SECRET_NAME.search(text, max(0, m.start() - 24), m.start()):
            found.append((m.start(1), m.end(1), "secret", m[1]))
    for m in _ACCOUNT.finditer(text):
        if (m.start() == 0 or not text[m.start() - 1].isalnum()) and _mod_97(m[0]) == 1:
            found.append((m.start(), m.end(), "account", m[0].replace(" ", "")))
    found += _names(text)
    found.sort(key=lambda e: (e[0], -e[1]))
    out, reach = [], 0
    for e in found:
        if e[0] >= reach:
            out.append(e)
            reach = e[1]
    return out


def _mod_97(account: str) -> int:
    plain = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _luhn(digits: str) -> int:
    return sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))) % 10


class Draw:
    """Numbers from an HMAC of kind, entity and attempt."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        # A first name has one surrogate per gender; all other kinds are apart as well.
        self.key = key
        self.more = max(0, attempt + 1 - SAME_LENGTH_DRAWS)
        self.seed = f"{kind}\0{attempt}\0{entity}".encode("utf-8", "surrogatepass")
        self.block = 0
        self.pool = b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.digest(self.key, self.block.to_bytes(4, "big") + self.seed, "sha256")
            self.block += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value % n

    def among(self, choices):
        return choices[self.below(len(choices))]


def _longer(text: str, signs: str, draw: Draw) -> str:
    return text + "".join(draw.among(signs) for _ in range(draw.more))


def _like(c: str, draw: Draw) -> str:
    """Another sign of the same sort: digit, letter of the same case and script, or the sign itself."""
    if c.isdigit() and c.isascii():
        return str(draw.below(10))
    if "a" <= c <= "z":
        return chr(97 + draw.below(26))
    if "A" <= c <= "Z":
        return chr(65 + draw.below(26))
    if not c.isalpha():
        return c
    script, kind = unicodedata.name(c, "").split(" ")[0], unicodedata.category(c)
    for _ in range(64):
        other = chr((ord(c) & ~63) + draw.below(64))
        if unicodedata.category(other) == kind and unicodedata.name(other, "").split(" ")[0] == script:
            return other
    return c


def _name(entity: str, kind: str, draw: Draw) -> str:
    script = unicodedata.name(entity[0], "").split(" ")[0]
    if script not in SOUNDS:
        return "".join(_like(c, draw) for c in entity + entity[-1] * draw.more)
    consonants, vowels, female, other = SOUNDS[script]
    parts = [draw.among(consonants) + draw.among(vowels) for _ in range(max(2, min(5, len(entity) // 2)) + draw.more)]
    if kind == "first_f":
        parts[-1] = draw.among(consonants) + draw.among(female)
    elif kind.startswith("first"):
        parts.append(draw.among(other))
    else:
        parts.append(draw.among(consonants))
    return "".join(parts)


def surrogate(kind: str, entity: str, attempt: int = 0, key: bytes = KEY) -> str:
    """The canonical surrogate of a canonical entity; ``attempt`` draws another one."""
    draw = Draw(key, kind, entity, attempt)
    if kind == "email":
        local, domain = entity.split("@", 1)
        labels = domain.split(".")
        changed = ["".join(_like(c, draw) for c in x) for x in labels[:-1]]
        return _longer("".join(_like(c, draw) for c in local), _LETTERS, draw) + "@" + ".".join([*changed, labels[-1]])
    if kind == "ip":
        octets = [256 if draw.more else min(256, 10 ** len(o)) for o in entity.split(".")]
        return ".".join(str(draw.below(n)) for n in octets + [256] * (draw.more - SAME_LENGTH_DRAWS))
    if kind == "phone":
        lead = len(entity) - 10
        return _longer(entity[:lead] + str(2 + draw.below(8)) + "".join(_like(c, draw) for c in entity[lead + 1 :]), _DECIMALS, draw)
    if kind == "card":
        body = _longer("".join(_like(c, draw) for c in entity), _DECIMALS, draw)
        if _luhn(entity) == 0:
            return next(body[:-1] + str(d) for d in range(10) if _luhn(body[:-1] + str(d)) == 0)
        return body
    if kind == "account":
        body = _longer("".join(_like(c, draw) for c in entity[4:]), _DECIMALS, draw)
        return f"{entity[:2]}{98 - _mod_97(entity[:2] + '00' + body):02d}{body}"
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", entity):
        signs = "0123456789abcdef" if entity == entity.lower() else "0123456789ABCDEF"
        return _longer("".join(draw.among(signs) for _ in entity), signs, draw)
    if kind.startswith("first") or kind == "surname":
        return _name(entity, kind, draw)
    return _longer("".join(_like(c, draw) for c in entity), _DECIMALS, draw)


def in_format(original: str, kind: str, new: str) -> str:
    """The surrogate in the spelling of this mention: its separators and its capitals."""
    if kind in ("phone", "ssn", "card"):
        digits = iter(new)
        return "".join([*(next(digits) if c.isdigit() else c for c in original), *digits])
    if kind == "account":
        signs = iter(new)
        return "".join([*(c if c == " " else next(signs) for c in original), *signs])
    if kind == "email" and original != original.lower():
        return "".join(n.upper() if o.isupper() else n for o, n in zip(original, new)) + new[len(original) :]
    if kind.startswith("first") or kind == "surname":
        if len(original) > 1 and original.isupper():
            return new.upper()
        return new[:1].upper() + new[1:] if original[:1].isupper() else new
    return new


def replace(text: str, again: dict[tuple[str, str], int], key: bytes = KEY) -> tuple[str, list[str]]:
    """The text with surrogates, and the kinds of what was replaced."""
    out, at, kinds = [], 0, []
    for start, end, kind, entity in find_entities(text):
        new = surrogate(kind, entity, again.get((kind, entity), 0), key)
        out += [text[at:start], in_format(text[start:end], kind, new)]
        kinds.append(kind)
        at = end
    return ("".join([*out, text[at:]]), kinds) if kinds else (text, kinds)


def mentions(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, kind, entity: what each text mentions, once per text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = {(kind, entity) for _, _, kind, entity in find_entities(text or "")}
            if found:
                sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
                rows += [(doc_id, sha, *f) for f in sorted(found)]
        if not rows:
            return None
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(map(list, zip(*rows)), kinds)], ["doc_id", "text_sha256", "kind", "entity"]
        )

    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(read, work, "doc_id long, text_sha256 string, kind string, entity string")


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, entity, attempt with the surrogate of that attempt."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        new = [surrogate(r["kind"], r["entity"], r["attempt"], key) for r in batch.to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], ["kind", "entity", "attempt", "surrogate"])

    return map_batches(entities.select("kind", "entity", "attempt"), work, "kind string, entity string, attempt int, surrogate string")


def attempts(found: DataFrame, key: bytes = KEY) -> DataFrame:
    """kind, entity, attempt, surrogate for all entities; no two share a surrogate.

    Names are one family: a surname, a first name and a name of unknown gender are told apart as well, and
    no surrogate of one is another name that occurs.
    """
    family = F.when(F.col("kind").startswith("first") | (F.col("kind") == "surname"), "name").otherwise(F.col("kind"))
    entities = found.select("kind", "entity").distinct().withColumn("attempt", F.lit(0))
    settled = keep(_drawn(entities, key))
    while True:
        told = settled.withColumn("family", family)
        first = told.groupBy("family", "surrogate").agg(F.min(F.struct("attempt", "entity", "kind")).alias("first"))
        shared = told.join(first, ["family", "surrogate"]).where(
            (F.col("first.entity") != F.col("entity")) | (F.col("first.kind") != F.col("kind"))
        ).select("kind", "entity")
        real = told.select("family", F.col("entity").alias("surrogate")).distinct()
        known = told.join(real, ["family", "surrogate"], "left_semi").select("kind", "entity")
        clash = keep(shared.unionByName(known).distinct())
        if clash.isEmpty():
            return settled
        fresh = settled.join(clash, ["kind", "entity"]).select("kind", "entity", (F.col("attempt") + 1).alias("attempt"))
        stay = settled.join(clash, ["kind", "entity"], "left_anti")
        settled = keep(stay.unionByName(_drawn(fresh, key)))


def anonymise(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """doc_id, text (with surrogates), n_entities, kinds (sorted, comma-joined) for every row of ``docs``."""
    found = keep(mentions(docs))
    again = attempts(found, key).where("attempt > 0")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    if again.isEmpty():
        read = read.withColumn("again", F.lit(None).cast("array<struct<kind:string,entity:string,attempt:int>>"))
    else:
        lists = (
            found.join(again, ["kind", "entity"])
            .groupBy(id_key().alias("__id"), F.col("text_sha256").alias("__sha"))
            .agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("again"))
        )
        keyed = read.withColumns({"__id": id_key(), "__sha": F.sha2("text", 256)})
        read = keyed.join(lists, ["__id", "__sha"], "left").select("doc_id", "text", "again")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts, kinds = [], [], []
        for text, redone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            table = {(r["kind"], r["entity"]): r["attempt"] for r in redone or ()}
            new, what = replace(text, table, key)
            texts.append(new)
            counts.append(len(what))
            kinds.append(",".join(sorted(set(what))))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(kinds, pa.string())],
            ["doc_id", "text", "n_entities", "kinds"],
        )

    return map_batches(read, work, "doc_id long, text string, n_entities long, kinds string")
