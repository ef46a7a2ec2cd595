"""Conversations as training text: typed content parts, a template with reversible escapes, and a loss mask. Only DataFrame functions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENTS = "array<struct<type:string,ref:string,start:int,tokens:bigint>>"


@dataclass(frozen=True)
class Template:
    """Control strings. Each is an opening character and a rest without any opening character or backslash, so that a text is escaped by
    one backslash after the opening character wherever a control string, or an escaped one, would stand."""

    begin: str = "<s>"
    head: str = "[INST]"
    body: str = "[/INST]"
    end: str = "</s>"
    image: str = "<image>"
    audio: str = "<audio>"
    document: str = "<document>"

    def __post_init__(self) -> None:
        openings = {control[0] for control in self.controls()}
        if any(set(control[1:]) & (openings | {"\\"}) or len(control) < 2 for control in self.controls()):
            raise ValueError("a control string holds an opening character or a backslash beyond its start")
        if len(set(self.controls())) < len(self.controls()):
            raise ValueError("control strings must differ")

    def controls(self) -> tuple[str, ...]:
        return (self.begin, self.head, self.body, self.end, self.image, self.audio, self.document)

    def pattern(self, inner: str) -> str:
        """Alternatives, one for each opening character; `inner` has a place for the rests."""
        rests: dict[str, list[str]] = {}
        for control in self.controls():
            rests.setdefault(control[0], []).append(re.escape(control[1:]))
        return "|".join(re.escape(opening) + inner.format("|".join(rest)) for opening, rest in rests.items())


@dataclass(frozen=True)
class Expansion:
    """What a placeholder becomes in a model's input: tokens by size of the attachment."""

    image_patch: int = 14
    audio_tokens_per_second: int = 25
    document_tokens_per_page: int = 256


def escape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, f"(?:{template.pattern(r'(?=\\*(?:{}))')})", r"$0\\")


def unescape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, f"({template.pattern(r'(?=\\+(?:{}))')})\\\\", "$1")


def text_parts(text: Column) -> Column:
    """One text part; a null text is empty."""
    absent = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    fields = [F.lit(None).cast(kind).alias(name) for name, kind in absent.items()]
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *fields)).cast(f"array<{PART}>")


def flatten_parts(parts: Column, template: Template, expansion: Expansion) -> Column:
    """Visits parts in order: struct(body, attachments). A text is escaped, any other part leaves its placeholder and an attachment
    (type, ref, start of the placeholder in the body, tokens). A type that is unknown or null stands as a document."""

    def visit(done: Column, part: Column) -> Column:
        kind = F.coalesce(part["type"], F.lit("document"))
        mark = F.when(kind == "image", template.image).when(kind == "audio", template.audio).otherwise(template.document)
        patches = [F.ceil(F.coalesce(part[side], F.lit(0)) / expansion.image_patch) for side in ("width", "height")]
        seconds = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * expansion.audio_tokens_per_second)
        pages = F.coalesce(part["pages"], F.lit(0)).cast("long") * expansion.document_tokens_per_page
        tokens = F.when(kind == "image", patches[0] * patches[1]).when(kind == "audio", seconds).otherwise(pages).cast("long")
        start = F.length(done["body"])
        attachment = F.struct(kind.alias("type"), part["ref"].alias("ref"), start.alias("start"), tokens.alias("tokens"))
        is_text = kind == "text"
        return F.struct(
            F.concat(done["body"], F.when(is_text, escape(F.coalesce(part["text"], F.lit("")), template)).otherwise(mark)).alias("body"),
            F.when(is_text, done["attachments"])
            .otherwise(F.concat(done["attachments"], F.array(attachment)).cast(ATTACHMENTS))
            .alias("attachments"),
        )

    nothing = F.struct(F.lit("").alias("body"), F.array().cast(ATTACHMENTS).alias("attachments"))
    return F.aggregate(F.coalesce(parts, F.array().cast(f"array<{PART}>")), nothing, visit)


def format_conversations(messages: DataFrame, template: Template | None = None, expansion: Expansion | None = None) -> DataFrame:
    """One row per conversation of `messages` (conv_id, turn, role, parts): conv_id, formatted, loss, attachments, expanded_tokens.

    Turns stand in order of turn, then role, then body; equal rows stand as often as they occur, nulls first. A null role is empty; a null
    list of parts is an empty body. Rows with a null conv_id are one conversation. `loss` lists (start, length) of assistant bodies in
    code points of `formatted`. Offsets come from a running sum before rows are gathered; a conversation itself is one row, as it is one
    text.
    """
    template, expansion = template or Template(), expansion or Expansion()
    role = escape(F.coalesce("role", F.lit("")), template)
    flat = messages.select("conv_id", "turn", role.alias("role"), flatten_parts(F.col("parts"), template, expansion).alias("flat"))
    flat = flat.select("conv_id", "turn", "role", "flat.body", "flat.attachments")
    marks = len(template.head) + len(template.body) + len(template.end)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body", "attachments").rowsBetween(Window.unboundedPreceding, 0)
    length = F.length("role") + F.length("body")
    end = len(template.begin) + F.sum((length + marks).cast("long")).over(order)
    start = F.col("end") - len(template.end) - F.length("body")
    moved = F.transform(
        "attachments",
        lambda a: F.struct(a["type"].alias("type"), a["ref"].alias("ref"), (a["start"] + F.col("start")).alias("start"), a["tokens"].alias("tokens")),
    )
    turn = F.concat(F.lit(template.head), "role", F.lit(template.body), "body", F.lit(template.end))
    placed = flat.withColumn("end", end).withColumn("start", start)
    placed = placed.select("conv_id", "start", "role", F.length("body").alias("length"), turn.alias("turn"), moved.alias("attachments"))
    turns = F.sort_array(F.collect_list(F.struct("start", "length", "role", "turn", "attachments"))).alias("turns")
    gathered = placed.groupBy("conv_id").agg(turns)
    attachments = F.flatten(F.transform("turns", lambda t: t["attachments"]))
    spoken = F.filter("turns", lambda t: t["role"] == "assistant")
    return gathered.select(
        "conv_id",
        F.concat(F.lit(template.begin), F.array_join(F.transform("turns", lambda t: t["turn"]), "")).alias("formatted"),
        F.transform(spoken, lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda total, a: total + a["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column, template: Template) -> Column:
    """(role, text) of each turn, read from the formatted text and unescaped; placeholders stay as they are."""
    inner = F.substring(formatted, len(template.begin) + 1, 2**31 - 1)
    pieces = F.split(inner, re.escape(template.end))
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def parse(turn: Column) -> Column:
        halves = F.split(turn, re.escape(template.body))
        role = F.substring(halves[0], len(template.head) + 1, 2**31 - 1)
        return F.struct(unescape(role, template).alias("role"), unescape(halves[1], template).alias("text"))

    return F.transform(turns, parse)


def read_loss(formatted: Column, loss: Column, template: Template) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"]), template)), ""
    )


def digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """What can be read back of formatted conversations: counts, and digests of turns and of the text under the loss mask."""
    template = template or Template()
    read = formatted.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted"), template).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss"), template).alias("said"),
    )
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined.cast("binary"), 256).alias("turns_sha256"),
        F.length("said").cast("long").alias("loss_chars"),
        F.sha2(F.col("said").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
