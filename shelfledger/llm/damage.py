"""Known faults put into sound tables, by the ids of their rows alone, so that repairs can be judged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAPS = r"[\x20\x09-\x0D]+"


def damaged_turns(rows: DataFrame) -> DataFrame:
    """``conversations`` rows with faults: of 20 rows one is lost, one loses its text, one its sentence
    ends, one stands twice and one is said by the user. Null roles, texts and ids in the choice are one blank."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    return rows.filter(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def split_words(text: Column) -> Column:
    """The words of a text; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAPS, -1), lambda w: w != "")


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``documents`` of which each tenth repeats a stretch of its words up to its end.

    With h the crc32 of the id and g = h div 10, a text of n words is damaged if h mod 10 = 0: words from
    a = g mod n on repeat the 1 + (n - a) div (3 + g mod 8) words that stand there. Other texts, and those of a null id, stay.
    """
    hashed = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select("doc_id", "text", hashed.alias("h"), F.when(hashed % 10 == 0, split_words(F.col("text"))).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    placed = words.withColumn("from", F.when(n > 0, g % n).cast("int")).withColumn(
        "period", (1 + F.floor((n - F.col("from")) / (3 + g % 8))).cast("int")
    )
    rest = n - F.col("from")
    block = F.slice("words", F.col("from") + 1, F.col("period"))
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil(rest / F.col("period")).cast("int"))), F.lit(1), rest)
    again = F.concat(F.slice("words", F.lit(1), F.col("from")), tail)
    return placed.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
