r"""Chat formatting that survives a round trip through its own grammar.

A conversation is its turns one after the other, each ``<s>`` tag body ``</s>``
with the tag ``[SYS]``, ``[INST]`` or ``[OUT]`` for system, user and assistant
and ``[ROLE]name[/ROLE]`` for any other role. The parser is deterministic: it
cuts at ``</s>``, expects one tag at the start of each turn and no control
string in a body, and takes escapes back. Texts are first written as they are;
where what is parsed differs from the source, the texts that hold a control
string or an escape code are escaped, and if that is not enough all are. The
escape writes ``\`` as ``\b``, ``<`` as ``\l`` and ``[`` as ``\k``, so no
control string is left in it.

The loss mask covers the assistants' bodies, as spans of the formatted text in
code points, end exclusive.

A conversation is one text and is put together in one row, like a document;
conversations are spread by their id.

Defined cases: a null text is empty, a null role is the empty role; turns are
ordered by number, null first, then role and text; equal rows are turns of
their own; null is a conversation of its own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAGS = {"system": "[SYS]", "user": "[INST]", "assistant": "[OUT]"}
START, END = "<s>", "</s>"
CONTROL = r"</?s>|\[/?(?:SYS|INST|OUT|ROLE)\]"
CONFLICT = CONTROL + r"|\\[blk]"
# Tag, name of another role, body.
TURN = r"(?s)^<s>(?:\[(SYS|INST|OUT)\]|\[ROLE\]([^<\[]*)\[/ROLE\])(.*)$"
CODES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\k"))


def escaped(text: Column) -> Column:
    for plain, code in CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def opening(role: Column) -> Column:
    other = F.concat(F.lit("[ROLE]"), escaped(role), F.lit("[/ROLE]"))
    tag = F.when(role == "system", TAGS["system"]).when(role == "user", TAGS["user"])
    return F.concat(F.lit(START), tag.when(role == "assistant", TAGS["assistant"]).otherwise(other))


def pieces(turns: Column, level: Column) -> Column:
    """The turns as structs of opening, body and role; level 0 escapes nothing, 1 conflicts, 2 all."""

    def piece(t: Column) -> Column:
        hard = (level > 1) | (level > 0) & t["text"].rlike(CONFLICT)
        return F.struct(
            opening(t["role"]).alias("opening"),
            F.when(hard, escaped(t["text"])).otherwise(t["text"]).alias("body"),
            t["role"].alias("role"),
        )

    return F.transform(turns, piece)


def rendered(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.concat(p["opening"], p["body"], F.lit(END))), "")


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; null where it breaks the grammar."""
    cut = F.split(formatted, END, -1)
    turns = F.slice(cut, 1, F.size(cut) - 1)

    def turn(t: Column) -> Column:
        tag, body = F.regexp_extract(t, TURN, 1), F.regexp_extract(t, TURN, 3)
        named = unescaped(F.regexp_extract(t, TURN, 2))
        role = F.when(tag == "SYS", "system").when(tag == "INST", "user").when(tag == "OUT", "assistant")
        good = t.rlike(TURN) & ~body.rlike(CONTROL)
        return F.struct(
            F.when(good, role.otherwise(named)).alias("role"),
            F.when(good, unescaped(body)).alias("text"),
        )

    return F.when(F.element_at(cut, -1) == "", F.transform(turns, turn))


def formatted(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted``, ``loss_spans`` (array of start, end) and ``round_trip`` per conversation."""
    text, role = F.coalesce(rows["text"], F.lit("")), F.coalesce(rows["role"], F.lit(""))
    turn = F.struct(rows["turn"], role.alias("role"), text.alias("text"))
    found = rows.select(rows["conv_id"], turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    found = found.select(
        "conv_id", F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    ).withColumn("level", F.lit(0))

    def same() -> Column:
        back = parsed(rendered(pieces(F.col("turns"), F.col("level"))))
        return F.coalesce(back == F.col("turns"), F.lit(False))

    for level in (1, 2):
        found = found.withColumn("level", F.when((F.col("level") < level - 1) | same(), F.col("level")).otherwise(level))
    found = found.withColumn("parts", pieces(F.col("turns"), F.col("level")))
    # Ends of the turns in the text so far; a body ends before its closing mark.
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["opening"])
        end = begin + F.length(p["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(p["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + len(END)).alias("at"), spans.alias("spans"))

    return found.select(
        "conv_id",
        rendered(F.col("parts")).alias("formatted"),
        F.aggregate("parts", zero, add, lambda s: s["spans"]).alias("loss_spans"),
        same().alias("round_trip"),
    )


def read_back(done: DataFrame) -> DataFrame:
    """What the formatted conversations say: turns and text under the loss mask, as digests."""
    text = F.col("formatted")
    found = done.select(
        "conv_id",
        parsed(text).alias("turns"),
        F.array_join(
            F.transform("loss_spans", lambda s: unescaped(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), ""
        ).alias("loss"),
        F.length(text).cast("long").alias("formatted_chars"),
        "round_trip",
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "round_trip",
    )
