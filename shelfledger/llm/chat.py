"""Chat formatting in Spark expressions: a conversation's turns as one marked text with a loss mask.

    <turn role="user">text</turn>
    <turn role="assistant">text<next/>text of the next row by the same role</turn>

Turns are collected as structs and sorted; adjacent turns of one role share a block, divided by
``<next/>``. Inside texts and roles ``&``, ``<``, ``>`` and ``"`` are written as ``&amp;``, ``&lt;``, ``&gt;``
and ``&quot;``, so no text can hold a marker and every text can be read back. The mask is a list of
(start, length) in code points over the formatted text, one for each assistant text; places are sums over
the rows before they are collected.

A conversation is one row, so it must fit one task, as the text it becomes must.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEARNED = "assistant"
OPEN, MIDDLE, CLOSE = '<turn role="', '">', "</turn>\n"
NEXT = "<next/>"
CHUNK = 1024


def escaped(c):
    for plain, written in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def unescaped(c):
    for plain, written in (('"', "&quot;"), (">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")):
        c = F.replace(c, F.lit(written), F.lit(plain))
    return c


def formatted(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, loss) for each conversation of ``rows``.

    Null roles and texts count as empty. Turns are ordered by turn, null first; rows of one turn by role,
    then text. Rows with a null conversation are one conversation.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    said = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    head, tail = _head(F.col("role"), F.lag("role").over(order)), _tail(F.col("role"), F.lead("role").over(order))
    length = F.length(escaped(F.col("text")))
    upto = F.sum(F.col("head") + F.col("length") + F.col("tail")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = said.withColumns({"head": F.length(head), "length": length, "tail": F.length(tail)}).withColumn(
        "start", (upto - F.col("tail") - F.col("length")).cast("int")
    )
    turns = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "start", "length"))).alias("turns"))
    written = _let(F.col("turns"), lambda t: F.array_join(_pieces(t), ""))
    loss = F.transform(F.filter("turns", lambda t: t["role"] == LEARNED), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    return turns.select("conv_id", written.alias("formatted"), loss.alias("loss"))


def _let(value, use):
    """``use`` of a value that is computed once, however often ``use`` names it, inside lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _head(role, before):
    return F.when(role.eqNullSafe(before), F.lit(NEXT)).otherwise(F.concat(F.lit(OPEN), escaped(role), F.lit(MIDDLE)))


def _tail(role, after):
    return F.when(role.eqNullSafe(after), F.lit("")).otherwise(F.lit(CLOSE))


def _pieces(turns):
    """What is written for each turn of a sorted array: adjacent turns of a role merge, as each sees by its neighbours
    whether it opens or closes a block. No array grows by appending, so the time is in proportion to the turns."""
    names, none = turns["role"], F.array(F.lit(None).cast("string"))
    before = F.slice(F.concat(none, names), F.lit(1), F.size(names))
    after = F.slice(F.concat(names, none), F.lit(2), F.size(names))
    beside = F.zip_with(before, after, lambda b, a: F.struct(b.alias("before"), a.alias("after")))
    return F.zip_with(turns, beside, lambda t, n: F.concat(_head(t["role"], n["before"]), escaped(t["text"]), _tail(t["role"], n["after"])))


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text) out of formatted text and mask alone: turns as (role, text), one for
    each row that was formatted, and all masked text, unescaped."""
    blocks = F.filter(F.split("formatted", CLOSE, -1), lambda b: b != "")
    turns = F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.substring_index(b, MIDDLE, -1), NEXT, -1),
        lambda t: F.struct(
            unescaped(F.regexp_extract(b, '^<turn role="([^"]*)">', 1)).alias("role"), unescaped(t).alias("text")
        ),
    )))
    # A substring is found by walking there, so spans are cut from the chunks of CHUNK code points that hold them.
    chunks = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{CHUNK}}}"), 0)

    def cut(chunks, span):
        first = F.floor(span["start"] / CHUNK).cast("int")
        last = F.floor((span["start"] + span["length"]) / CHUNK).cast("int")
        return F.substring(F.array_join(F.slice(chunks, first + 1, last - first + 1), ""), span["start"] - first * CHUNK + 1, span["length"])

    loss = _let(chunks, lambda c: F.array_join(F.transform("loss", lambda span: cut(c, span)), ""))
    return chats.select("conv_id", "formatted", turns.alias("turns"), unescaped(loss).alias("loss_text"))


def digests(chats: DataFrame) -> DataFrame:
    """One row per conversation with the digests of what reads back."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(chats).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
