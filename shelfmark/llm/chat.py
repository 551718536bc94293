"""Chat formatting with typed content parts, by DataFrame functions only.

A message holds parts of the kinds text, image, audio and document. A visitor turns each
part, in order, into text or into a placeholder, and records attachments and the tokens
that the placeholders stand for. Messages of a conversation are joined by a template.

Control strings begin with ``<|``. Inside a text, ``&`` becomes ``&amp;`` and ``<|``
becomes ``&lt;|``, so no text can hold a control string and the way back is exact. In a
role, line ends are escaped as well.

Defined cases: a null text is an empty one; a null role is an empty role; rows order by
turn (null first), then role, then text, so ties and repeated rows have one order; a null
conversation id is a conversation; an empty table gives no conversation; a part of an
unknown kind is a document; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Tokens of one unit: of an image tile, of a second of audio, of a page.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 500}
PART = "struct<kind:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(F.coalesce(role, F.lit(""))), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """A text as a list of one part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units")))


def visit(of_text: Callable[[Column], Column], of_attachment: Callable[[Column, str], Column]) -> Callable[[Column], Column]:
    """A function of a part that picks the branch of its kind."""

    def branch(part: Column) -> Column:
        kinds = reduce(lambda chain, kind: chain.when(part["kind"] == kind, of_attachment(part, kind)), ("image", "audio"), F.when(part["kind"] == "text", of_text(part)))
        return kinds.otherwise(of_attachment(part, "document"))

    return branch


def format_chat(messages: DataFrame, parts: str | None = None, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation of ``messages`` (conv_id, turn, role, and text or parts).

    formatted is the whole training text; segments holds the same text in pieces, each
    with its loss flag; attachments lists turn, kind and ref in the order of the
    placeholders; tokens counts the words of the texts plus what the placeholders expand to.
    A conversation is one training text, so its rows meet in one place; nothing else does.
    """
    content = F.coalesce(F.col(parts).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")) if parts else text_part(F.col("text"))
    flat = visit(lambda p: escape(F.coalesce(p["text"], F.lit(""))), lambda p, kind: F.lit(PLACEHOLDER[kind]))
    words = lambda p: F.coalesce(F.regexp_count(p["text"], F.lit(r"\S+")), F.lit(0)).cast("long")
    tokens = visit(words, lambda p, kind: F.greatest(F.coalesce(p["units"], F.lit(1)), F.lit(0)) * F.lit(UNIT_TOKENS[kind]))
    kind_of = visit(lambda p: F.lit("text"), lambda p, kind: F.lit(kind))
    turns = (
        messages.withColumn("_parts", content)
        .select(
            "conv_id",
            F.struct(
                F.col("turn"),
                F.coalesce(F.col("role"), F.lit("")).alias("role"),
                F.array_join(F.transform("_parts", flat), "").alias("body"),
                F.aggregate(F.transform("_parts", tokens), F.lit(0).cast("long"), lambda a, b: a + b).alias("tokens"),
                F.transform(F.filter("_parts", lambda p: kind_of(p) != "text"), lambda p: F.struct(kind_of(p).alias("kind"), p["ref"].alias("ref"))).alias("refs"),
            ).alias("m"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("m")).alias("m"))
    )
    pieces = F.flatten(
        F.transform(
            "m",
            lambda m: F.array(
                F.struct(F.concat(F.lit(START), escape_role(m["role"]), F.lit("\n")).alias("piece"), F.lit(False).alias("loss")),
                F.struct(m["body"].alias("piece"), (m["role"] == loss_role).alias("loss")),
                F.struct(F.lit(END + "\n").alias("piece"), F.lit(False).alias("loss")),
            ),
        )
    )
    attachments = F.flatten(F.transform("m", lambda m: F.transform(m["refs"], lambda r: F.struct(m["turn"].alias("turn"), r["kind"].alias("kind"), r["ref"].alias("ref")))))
    return turns.select(
        "conv_id",
        pieces.alias("segments"),
        attachments.alias("attachments"),
        F.aggregate(F.transform("m", lambda m: m["tokens"]), F.lit(0).cast("long"), lambda a, b: a + b).alias("tokens"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["piece"]), ""))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text holds."""
    pieces = F.split(formatted, r"<\|im_start\|>", -1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        body = F.substring_index(F.substring(piece, F.length(head) + 2, F.length(piece)), END, 1)
        return F.struct(unescape_role(head).alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["piece"])), "")
