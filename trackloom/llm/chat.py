"""Conversations as one training text each, with a loss mask, by Spark expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import let

#: Turns whose numbers differ by less share a group, so that a long conversation is put together by several tasks.
STRETCH = 256


@dataclass(frozen=True)
class Template:
    r"""A block holds adjacent turns of one role: start, role, body, text (joint, text)*, end.

    A control string is a mark without the blanks around it. Where one occurs in a text or role, a backslash
    goes behind its first character; a backslash is doubled. So no control string is left, and dropping each
    backslash before the character that it precedes gives the text back. Control strings hold no blanks or
    backslashes, begin with a character that none of them has further on, and none begins another, so none can
    arise where a text meets a mark.
    """

    start: str = "<s>"
    body: str = "[INST] "
    joint: str = " [/INST] "
    end: str = " </s>"
    loss_role: str = "assistant"

    def __post_init__(self) -> None:
        cores = self.controls()
        heads = {c[:1] for c in cores}
        for i, c in enumerate(cores):
            others = cores[:i] + cores[i + 1 :]
            if len(c) < 2 or "\\" in c or any(x.isspace() for x in c) or heads & set(c[1:]) or any(x.startswith(c) for x in others):
                raise ValueError(f"{c!r} can not be told from texts or other marks")

    def controls(self) -> list[str]:
        return [x.strip() for x in (self.start, self.body, self.joint, self.end)]

    def escaped(self, text: Column) -> Column:
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        for c in self.controls():
            text = F.replace(text, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
        return text

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def head(self, role: Column) -> Column:
        return F.concat(F.lit(self.start), role, F.lit(self.body))


def upto(n: Column) -> Column:
    """0 to n - 1; none for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def running_sums(values: Column) -> Column:
    """The sum of the values before each, of an array of longs; in n times the root of n additions."""
    add = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    def sums(v: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v))).cast("int"))
        chunks = F.transform(upto(F.ceil(F.size(v) / width).cast("int")), lambda c: add(F.slice(v, c * width + 1, width)))
        before = let(chunks, lambda own: F.transform(own, lambda _, c: add(F.slice(own, F.lit(1), c))))
        return let(before, lambda b: F.transform(v, lambda _, i: F.get(b, F.floor(i / width).cast("int")) + add(F.slice(v, F.floor(i / width).cast("int") * width + 1, i % width))))

    return let(values, sums)


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template: Template | None = None) -> DataFrame:
    """(conv_id, formatted, loss_spans) for each conversation.

    Its turns are collected as structs and sorted by (turn, role, text), nulls first; ties and repeated rows
    all stay. Adjacent turns of one role share a block (see Template). loss_spans lists the (start, end) bytes
    in formatted of each text of the role that the loss covers, escaped as it stands there, without marks. A
    null text or role is empty; rows with a null conv_id are one conversation; an empty table has none.

    Turns meet in two steps: those of one stretch of turn numbers are formatted together, then the stretches
    of a conversation are joined at their seams. So a conversation with most of the rows is shared by tasks up
    to its last step, which only concatenates; its text must fit in one row (2 GB).
    """
    t = template or Template()
    clean = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    number = F.col(f"`{turn}`")
    rows = turns.select(F.col(f"`{conv_id}`").alias("conv_id"), F.floor(number / STRETCH).alias("stretch"), F.struct(number.alias("turn"), clean(role).alias("role"), clean(text).alias("text")).alias("said"))
    said = rows.groupBy("conv_id", "stretch").agg(F.sort_array(F.collect_list("said")).alias("said"))
    said = said.withColumn("said", F.transform("said", lambda x: F.struct(t.escaped(x["role"]).alias("role"), t.escaped(x["text"]).alias("text"))))

    def mark(own: Column, last: Column) -> Column:
        """What stands between two turns."""
        return F.when(own == last, F.lit(t.joint)).otherwise(F.concat(F.lit(t.end), t.head(own)))

    pieces = F.transform("said", lambda x, i: F.struct(F.when(i == 0, F.lit("")).otherwise(mark(x["role"], F.get("said", i - 1)["role"])).alias("mark"), x["text"].alias("text"), (x["role"] == t.loss_role).alias("loss")))
    said = said.select("conv_id", "stretch", F.get("said", F.lit(0))["role"].alias("first"), F.element_at("said", -1)["role"].alias("last"), pieces.alias("pieces"))
    size = lambda x: F.octet_length(x["mark"]).cast("long") + F.octet_length(x["text"])
    at = running_sums(F.transform("pieces", size))
    span = lambda x, start: F.struct(start.alias("start"), (start + F.octet_length(x["text"])).alias("end"))
    covered = lambda sums: F.transform(F.filter(upto(F.size("pieces")), lambda i: F.get("pieces", i)["loss"]), lambda i: span(F.get("pieces", i), F.get(sums, i) + F.octet_length(F.get("pieces", i)["mark"])))
    parts = said.select(
        "conv_id",
        F.struct(
            "stretch",
            "first",
            "last",
            F.array_join(F.transform("pieces", lambda x: F.concat(x["mark"], x["text"])), "").alias("body"),
            let(at, covered).alias("spans"),
        ).alias("part"),
    )
    parts = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    seams = F.transform("parts", lambda p, i: F.when(i == 0, t.head(p["first"])).otherwise(mark(p["first"], F.get("parts", i - 1)["last"])))
    joined = parts.select("conv_id", "parts", seams.alias("seams"))
    lengths = F.transform("parts", lambda p, i: F.octet_length(F.get("seams", i)).cast("long") + F.octet_length(p["body"]))
    moved = lambda sums: F.flatten(F.transform("parts", lambda p, i: let(F.get(sums, i) + F.octet_length(F.get("seams", i)), lambda by: F.transform(p["spans"], lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"))))))
    return joined.select(
        "conv_id",
        F.concat(F.array_join(F.transform("parts", lambda p, i: F.concat(F.get("seams", i), p["body"])), ""), F.lit(t.end)).alias("formatted"),
        let(running_sums(lengths), moved).alias("loss_spans"),
    )


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """The (role, text) of all turns of a formatted text, in order, unescaped."""
    t = template or Template()
    cut = lambda x, mark, limit=-1: F.split(x, f"\\Q{mark}\\E", limit)
    blocks = F.filter(cut(formatted, t.end), lambda b: F.length(b) > 0)

    def turns(block: Column) -> Column:
        two = cut(F.substring(block, len(t.start) + 1, 2**31 - 1), t.body, 2)
        return let(two, lambda x: F.transform(cut(F.get(x, F.lit(1)), t.joint), lambda y: F.struct(t.unescaped(F.get(x, F.lit(0))).alias("role"), t.unescaped(y).alias("text"))))

    return F.flatten(F.transform(blocks, turns))


def loss_texts(formatted: Column, spans: Column, template: Template | None = None) -> Column:
    """The texts under the loss mask, in order, unescaped."""
    t = template or Template()
    take = lambda data, s: F.substring(data, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).cast("string")
    return let(formatted.cast("binary"), lambda data: F.transform(spans, lambda s: t.unescaped(take(data, s))))
