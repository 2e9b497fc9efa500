"""Chat formatting with DataFrame functions alone.

A finite-state machine over roles tells whether the turns of a conversation follow a valid order; a declarative
template turns each turn into text segments with loss flags. The segments, joined, are the formatted text; the spans
of the loss segments are its loss mask. Control strings inside texts and roles are escaped reversibly: a backslash
becomes \\b, and \\z is put after the first character of a control string. No control string survives, and since every
backslash is followed by b or z, taking out \\z and then turning \\b into a backslash restores the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: role -> (text before, text after, whether the turn's text counts for the loss)
TEMPLATE = {"system": ("<<SYS>>", "<</SYS>>", False), "user": ("[INST]", "[/INST]", False), "assistant": ("<s>", "</s>", True)}
#: Any other role: before its name, between name and text, after the text.
OTHER = ("<<ROLE>>", "<</ROLE>>", "<</TURN>>")
#: state -> role -> next state; what is missing leads to "bad". A valid conversation ends in a state of ENDS.
MACHINE = {"start": {"system": "ready", "user": "asked"}, "ready": {"user": "asked"}, "asked": {"assistant": "answered"}, "answered": {"user": "asked"}}
ENDS = ("answered",)


def controls(template=TEMPLATE) -> list[str]:
    return sorted({c for before, after, _ in template.values() for c in (before, after)} | set(OTHER), key=lambda c: (-len(c), c))


def escape(text: Column, template=TEMPLATE) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    for c in controls(template):
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\z" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\z"), F.lit("")), F.lit("\\b"), F.lit("\\"))


def _segments(role: Column, text: Column, template) -> Column:
    part = lambda t, loss: F.struct(t.alias("text"), F.lit(loss).alias("loss"))
    body = escape(text, template)
    whole = F.array(part(F.concat(F.lit(OTHER[0]), escape(role, template), F.lit(OTHER[1])), False), part(body, False), part(F.lit(OTHER[2]), False))
    for name, (before, after, loss) in template.items():
        whole = F.when(role == name, F.array(part(F.lit(before), False), part(body, loss), part(F.lit(after), False))).otherwise(whole)
    return whole


def _walk(roles: Column) -> Column:
    def step(state: Column, role: Column) -> Column:
        out = F.lit("bad")
        for at, ways in MACHINE.items():
            for name, to in ways.items():
                out = F.when((state == at) & (role == name), to).otherwise(out)
        return out

    return F.aggregate(roles, F.lit("start"), step)


def format_conversations(conversations: DataFrame, template=TEMPLATE) -> DataFrame:
    """conversations -> (conv_id, formatted, loss_spans, segments, valid), one row per conversation.

    Turns are ordered by turn, then role, then text; null turns come first; a null text or role is empty; repeated
    rows are turns each; conversations with a null conv_id are one conversation; other columns are ignored; an empty
    table gives no rows. loss_spans: (begin, end) in code points of formatted. valid: the machine accepted the roles;
    conversations that it rejects are formatted all the same. A role outside the template is written by name.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"), "role", "text"))).alias("turns"))
    made = turns.select("conv_id", F.flatten(F.transform("turns", lambda t: _segments(t["role"], t["text"], template))).alias("segments"), F.transform("turns", lambda t: t["role"]).alias("roles"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

    def span(acc: Column, s: Column) -> Column:
        end = acc["at"] + F.char_length(s["text"])
        return F.struct(end.alias("at"), F.when(s["loss"], F.array_append(acc["spans"], F.struct(acc["at"].alias("begin"), end.alias("end")))).otherwise(acc["spans"]).alias("spans"))

    return made.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), F.aggregate("segments", start, span)["spans"].alias("loss_spans"), "segments", _walk(F.col("roles")).isin(*ENDS).alias("valid"))


def read_turns(formatted: DataFrame, template=TEMPLATE) -> DataFrame:
    """Adds turns (role, text), read back from the formatted text alone by its control strings. A null formatted text gives null turns, an empty one
    none; other columns stay, but a column turns is replaced; an empty table gives no rows."""
    quote = lambda c: "\\Q" + c + "\\E"
    ways = [f"{quote(b)}(?<r{i}>)(.*?){quote(a)}" for i, (b, a, _) in enumerate(template.values())]
    ways.append(f"{quote(OTHER[0])}(.*?){quote(OTHER[1])}(.*?){quote(OTHER[2])}")
    pieces = F.regexp_extract_all("formatted", F.lit("(?s)" + "|".join(ways)), F.lit(0))

    def turn(p: Column) -> Column:
        other = F.substring_index(F.substring(p, len(OTHER[0]) + 1, 2**30), OTHER[1], 1)
        role, text = unescape(other), F.substring(F.substring_index(p, OTHER[1], -1), 1, 2**30)
        text = F.left(text, F.char_length(text) - len(OTHER[2]))
        for name, (before, after, _) in template.items():
            here = p.startswith(before)
            role = F.when(here, F.lit(name)).otherwise(role)
            text = F.when(here, F.substring(p, F.lit(len(before) + 1), F.char_length(p) - len(before) - len(after))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return formatted.withColumn("turns", F.transform(pieces, turn))


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped: the spans in order, nothing between. No spans: empty; null spans or text: null."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["begin"] + 1, s["end"] - s["begin"]))), "")
