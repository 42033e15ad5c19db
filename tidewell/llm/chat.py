"""Chat formatting of typed content parts.

A visitor turns each part of a turn into text: text parts are escaped, image, audio and
document parts become placeholders in order, and each leaves an attachment with
its reference and the tokens that its placeholder will expand to. Turns are joined
by marks. Inside texts and roles a backslash is put into every control string, so no mark
can occur there and the format reads back to the same turns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Marks of the template.
ROLE, BODY, END = "<|start_header_id|>", "<|end_header_id|>\n\n", "<|eot_id|>"
# First characters of control strings of this template and of other common ones: they get a backslash after them.
CONTROL = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"

PATCH, AUDIO_TOKENS_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 512
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _at_least_one(tokens: Column) -> Column:
    return F.greatest(F.coalesce(tokens, F.lit(1)), F.lit(1)).cast("bigint")


# What each kind of attachment expands to; a kind without its measures counts one token.
EXPANDED: dict[str, Callable[[Column], Column]] = {
    "image": lambda p: _at_least_one(F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH)),
    "audio": lambda p: _at_least_one(F.ceil(p["seconds"] * AUDIO_TOKENS_PER_SECOND)),
    "document": lambda p: _at_least_one(p["pages"].cast("bigint") * TOKENS_PER_PAGE),
}


def visit(part: Column) -> Column:
    """What a part adds to its turn: ``shown`` text and, unless it is text, an ``attachment``.

    A part of another kind, or of none, is an ``other`` attachment of one token.
    """
    is_text = F.coalesce(part["type"] == "text", F.lit(False))
    kind = F.when(part["type"].isin(*EXPANDED), part["type"]).otherwise("other")
    tokens = F.lit(1).cast("bigint")
    for name, count in EXPANDED.items():
        tokens = F.when(part["type"] == name, count(part)).otherwise(tokens)
    return F.struct(
        F.when(is_text, escaped(F.coalesce(part["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), kind, F.lit("|>"))).alias("shown"),
        F.when(~is_text, F.struct(kind.alias("kind"), part["ref"].alias("ref"), tokens.alias("tokens"))).alias("attachment"),
    )


def text_parts(text: Column) -> Column:
    """The parts of a turn that is plain text."""
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *nothing))


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per ``conv_id`` from ``conv_id``, ``turn``, ``role`` and ``parts`` (of type ``PARTS``).

    ``formatted`` is the text, ``loss_spans`` the (start, length) code points of the contents of
    ``loss_roles``, ``attachments`` lists kind, ref, tokens and position in order, ``expanded_tokens``
    sums their tokens. Turns come by ``turn``, nulls first, then by role and content; repeated
    rows are turns of their own. Null roles are empty, null parts or texts give empty contents, rows
    of a null ``conv_id`` are one conversation, other columns are ignored. No rows give no rows.
    """
    seen = F.transform(F.coalesce("parts", F.array().cast(PARTS)), visit)
    one = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        seen.alias("seen"),
    ).select(
        "conv_id",
        "turn",
        "role",
        F.concat(F.lit(ROLE), escaped(F.col("role")), F.lit(BODY)).alias("head"),
        F.array_join(F.transform("seen", lambda s: s["shown"]), "").alias("content"),
        F.filter(F.transform("seen", lambda s: s["attachment"]), lambda a: a.isNotNull()).alias("attachments"),
    )
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "content", "attachments").rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("head") + F.length("content") + len(END)
    placed = one.withColumn("start", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("bigint"))
    row = F.struct("start", "role", "head", "content", "attachments")
    rows = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    spoken = F.filter("rows", lambda r: r["role"].isin(*loss_roles))
    return rows.select(
        "conv_id",
        F.size("rows").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("rows", lambda r: F.concat(r["head"], r["content"], F.lit(END))), "").alias("formatted"),
        F.transform(
            spoken, lambda r: F.struct((r["start"] + F.length(r["head"])).alias("start"), F.length(r["content"]).cast("bigint").alias("length"))
        ).alias("loss_spans"),
        F.transform(
            F.flatten(F.transform("rows", lambda r: r["attachments"])),
            lambda a, i: F.struct(a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"), i.alias("position")),
        ).alias("attachments"),
        F.aggregate(
            F.flatten(F.transform("rows", lambda r: r["attachments"])), F.lit(0).cast("bigint"), lambda s, a: s + a["tokens"]
        ).alias("expanded_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text, as (role, text); placeholders are left out of the text."""
    pieces = F.split(formatted, r"<\|eot_id\|>")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        halves = F.split(piece, r"<\|end_header_id\|>\n\n")
        text = F.regexp_replace(halves[1], r"<\|\w+\|>", "")
        return F.struct(unescaped(F.substring(halves[0], len(ROLE) + 1, 1 << 30)).alias("role"), unescaped(text).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
