"""Chats as training texts: turns of a conversation in one string of marked blocks, with the spans that are learnt.

A block is ``<|role:R|>``, a line end, the texts of adjacent turns of role R with ``<|next|>`` between them, ``<|end|>`` and a
line end. Control strings inside texts are broken up by a backslash after their first character, and backslashes are doubled,
so that each turn can be read back exactly as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEXT = "<|next|>"
END = "<|end|>\n"
LEARNT = "assistant"
# Control strings, own and of other common templates. None starts inside another one.
CONTROL = ["<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        text = F.replace(text, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """Also bars ``|``, which ends a role."""
    return F.replace(escape(role), F.lit("|"), F.lit("\\|"))


def format_chats(turns: DataFrame, learnt: str = LEARNT) -> DataFrame:
    """``conv_id, formatted, loss_spans`` for each conversation in ``turns`` (conv_id, turn, role, text).

    Turns are ordered by turn (nulls first), then role and text, so ties and repeated rows have a defined order. Null roles
    and texts are empty. Rows with a null conv_id are one conversation. Spans are (start, length) in code points from 0: one for
    each turn of role ``learnt``, around its escaped text.
    """
    ordered = turns.select(
        "conv_id",
        F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("turn"),
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    blocks = F.transform(
        "starts",
        lambda s, k: F.struct(
            F.get("turns", s)["role"].alias("role"),
            F.transform(
                F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - s), lambda t: escape(t["text"])
            ).alias("texts"),
        ),
    )
    pieces = F.flatten(F.transform(
        "blocks",
        lambda b: F.transform(b["texts"], lambda x, k: F.struct(
            F.when(k == 0, F.concat(F.lit("<|role:"), escape_role(b["role"]), F.lit("|>\n"))).otherwise(F.lit(NEXT)).alias("lead"),
            x.alias("text"),
            F.when(k == F.size(b["texts"]) - 1, F.lit(END)).otherwise(F.lit("")).alias("tail"),
            (b["role"] == learnt).alias("learnt"),
        )),
    ))
    none = F.array().cast("array<struct<start:int,length:int>>")
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["lead"]) + F.length(p["text"]) + F.length(p["tail"])).alias("at"),
            F.when(p["learnt"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(p["lead"])).alias("start"), F.length(p["text"]).alias("length")
            )))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return (
        ordered.withColumn("starts", starts).withColumn("blocks", blocks).withColumn("pieces", pieces)
        .withColumn("formatted", F.array_join(F.transform("pieces", lambda p: F.concat(p["lead"], p["text"], p["tail"])), ""))
        .select("conv_id", "formatted", spans.alias("loss_spans"))
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted chat."""
    head = r"(?s)^<\|role:((?:[^\\|]|\\.)*+)\|>\n"
    return F.flatten(F.transform(
        F.slice(F.split(formatted, r"<\|end\|>\n", -1), 1, F.size(F.split(formatted, r"<\|end\|>\n", -1)) - 1),
        lambda b: F.transform(
            F.split(F.regexp_replace(b, head, ""), r"<\|next\|>", -1),
            lambda x: F.struct(unescape(F.regexp_extract(b, head, 1)).alias("role"), unescape(x).alias("text")),
        ),
    ))


def learnt_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
