r"""Chat formatting with a grammar round trip, in DataFrame functions only.

Template of a turn::

    ### User: text of the turn
    </turn>

Headers are ``### System: ``, ``### User: ``, ``### Assistant: ``, ``### Tool: `` and, for any
other role, ``### @role: `` with the role URL-encoded.  A header or ``</turn>`` is a *control
string* unless a backslash stands before it.  The parser is deterministic: it cuts at control
strings, and takes one backslash off every control string that has one.

Formatting renders the texts as they are, parses the result and compares the turns found with
the source.  Texts for which that differs get one more backslash before each control string
(and before backslashes that lead up to one), and the result is parsed again: it must be equal.

Defined results: null text and null role count as empty; turns are ordered by turn, role, text,
nulls first; repeated rows are turns of their own; a null conv_id is one conversation; an empty
table gives no conversations.  One conversation becomes one row, so it has to fit into
memory; the work on it grows with its length and, by sums of short parts, with its turns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Roles with a header of their own.
LABELS = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}

# Elements to a part of a running sum, and code points to a page of a text that is read by spans.
PART, PAGE = 256, 1024
_END = "\n</turn>\n"
_LABEL = "(?:" + "|".join(LABELS.values()) + r"|@[\w.*+%-]*)"
CONTROL = rf"### {_LABEL}: |</turn>"
# A run of backslashes is read once, from its first one, however long it is.
_CONFLICT = rf"(?<!\\)(\\*+)({CONTROL})"
_ESCAPED = rf"(?<!\\)\\(\\*+(?:{CONTROL}))"
_TURN = rf"(?s)\G### ({_LABEL}): (.*?)\n</turn>\n"


def header(role: Column) -> Column:
    label = F.concat(F.lit("@"), F.url_encode(role))
    for name, known in LABELS.items():
        label = F.when(role == name, F.lit(known)).otherwise(label)
    return F.concat(F.lit("### "), label, F.lit(": "))


def role_of(label: Column) -> Column:
    role = F.url_decode(F.substring(label, 2, 1 << 30))
    for name, known in LABELS.items():
        role = F.when(label == known, F.lit(name)).otherwise(role)
    return role


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONFLICT, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def render(turns: Column) -> Column:
    return F.array_join(
        F.transform(turns, lambda t: F.concat(header(t["role"]), t["body"], F.lit("\n</turn>\n"))), ""
    )


def cut_turns(formatted: Column) -> Column:
    """The turns of a rendered conversation as they stand: role and escaped body."""
    label = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    body = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))
    return F.transform(
        F.arrays_zip(label.alias("label"), body.alias("body")),
        lambda t: F.struct(role_of(t["label"]).alias("role"), t["body"].alias("body")),
    )


def conflicts(text: Column) -> Column:
    """Whether a text, rendered as it is, would come back as another one."""
    return text.rlike(CONTROL)


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, parsed (role, text), loss_mask (start, length; from 0), identical."""
    source = F.struct(
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", source.alias("said")))).alias("rows")
    )
    told = ordered.select("conv_id", F.transform("rows", lambda r: r["said"]).alias("source"))

    def bodies(text_of) -> Column:
        return F.transform(
            "source", lambda t: F.struct(t["role"].alias("role"), text_of(t["text"]).alias("body"))
        )

    plain = told.withColumn("formatted", render(bodies(lambda text: text)))
    plain = plain.withColumn("cut", cut_turns(F.col("formatted")))
    repaired = F.when(_recovers(), F.col("formatted")).otherwise(
        render(bodies(lambda text: F.when(conflicts(text), escape(text)).otherwise(text)))
    )
    final = plain.withColumn("formatted", repaired).withColumn("cut", cut_turns(F.col("formatted")))
    final = final.withColumn("identical", _recovers())
    return final.select(
        "conv_id",
        "formatted",
        F.transform(
            "cut", lambda t: F.struct(t["role"].alias("role"), unescape(t["body"]).alias("text"))
        ).alias("parsed"),
        loss_mask(F.col("cut")).alias("loss_mask"),
        "identical",
    )


def _recovers() -> Column:
    """Parsed turns equal the source, and no control string stands inside a body."""
    back = F.transform(
        "cut", lambda t: F.struct(t["role"].alias("role"), unescape(t["body"]).alias("text"))
    )
    clean = F.forall("cut", lambda t: ~t["body"].rlike(rf"(?<!\\)(?:{CONTROL})"))
    return (back == F.col("source")) & clean


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once a row, however often inner functions read it."""
    return F.transform(F.array(value), body)[0]


def _parts(count: Column) -> Column:
    """The numbers, from 0, of the parts that hold ``count`` elements, PART to each; none of nothing."""
    last = F.floor((count - 1) / PART).cast("int")
    return F.when(count > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _starts(lengths: Column, first: Column) -> Column:
    """``first`` and the running sums of ``lengths`` behind it: as many as there are lengths, and the end."""
    return F.aggregate(lengths, F.array(first), lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)))


def running_starts(lengths: Column) -> Column:
    """Sum of all lengths before each one, in two levels: appending to one long array is quadratic."""

    def inside(held: Column) -> Column:
        parts = F.transform(_parts(F.size(held)), lambda k: F.slice(held, k * PART + 1, PART))
        return _let(parts, lambda cut: _let(
            _starts(F.transform(cut, lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda t, n: t + n)), F.lit(0).cast("long")),
            lambda begins: F.flatten(
                F.transform(cut, lambda part, k: F.slice(_starts(part, begins[k]), F.lit(1), F.size(part)))
            ),
        ))

    return _let(lengths, inside)


def loss_mask(cut: Column) -> Column:
    """Spans of assistant bodies in the formatted text, in code points."""
    sized = F.transform(
        cut,
        lambda t: F.struct(
            (t["role"] == "assistant").alias("learned"),
            F.char_length(header(t["role"])).cast("long").alias("header"),
            F.char_length(t["body"]).cast("long").alias("length"),
        ),
    )

    def spans(turns: Column) -> Column:
        lengths = F.transform(turns, lambda t: t["header"] + t["length"] + F.lit(len(_END)))
        placed = F.transform(
            F.arrays_zip(turns.alias("turn"), running_starts(lengths).alias("at")),
            lambda t: F.struct(
                t["turn"]["learned"].alias("learned"),
                (t["at"] + t["turn"]["header"]).alias("start"),
                t["turn"]["length"].alias("length"),
            ),
        )
        return F.transform(
            F.filter(placed, lambda t: t["learned"]),
            lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")),
        )

    return _let(sized, spans)


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, one piece after the other.

    The text is cut once into pages of ``PAGE`` code points, and a span reads only the pages it lies on.
    """
    pages = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))

    def span(cut: Column, s: Column) -> Column:
        first = F.floor(s["start"] / PAGE).cast("int")
        last = F.floor((s["start"] + s["length"]) / PAGE).cast("int")
        near = F.array_join(F.slice(cut, first + 1, last - first + 1), "")
        return F.substring(near, (s["start"] - first * PAGE + 1).cast("int"), s["length"].cast("int"))

    return _let(pages, lambda cut: F.array_join(F.transform(mask, lambda s: unescape(span(cut, s))), ""))
