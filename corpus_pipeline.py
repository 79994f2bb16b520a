"""A corpus pipeline over ``documents``: each stage applies one operator to all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.llm import decontamination, langid, mixing, near_dedup, token_files
from shelfledger.llm.common import ship_code, stored
from shelfledger.llm.queries import remainder, table, tokenizer
from shelfledger.session import scratch_path

# Least share of a text's n-grams that its language holds. Prose has over 0.8; noise has next to none.
LEAST_SCORE = 0.15
# Five-word shingles, 80 % alike.
NEAR = near_dedup.Settings(words=5, percent=80, rows=4, bands=28)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents written in one of the labelled languages.

    A null text and one without letters are in none and go. A repeated row has the fate of the one. Columns may have any name.
    """
    ship_code(spark)
    model = langid.fit(docs.filter(remainder(F.col("doc_id"), 5) != 0))
    rows = docs.select(F.struct("*").alias("row"), "text")
    found = langid.predict(rows, model, carry=("row",))
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies, the one of the smallest id.

    Rows without words are in no class and stay, as do rows of a null id; rows repeating an id share its fate.
    """
    ship_code(spark)
    return near_dedup.drop_near_copies(docs, NEAR)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a benchmark item. Null texts and rows of a null id stay; rows repeating an id go together."""
    ship_code(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and thins the sources to their target weights; a document stands as often as it is taken.

    A null source is a source; rows equal in id, source and text are taken equally often; texts without words have size 0.
    """
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns each document's place in them, a row for each row. A null text is its end id alone."""
    ship_code(spark)
    path = scratch_path(spark, "pipeline-tokens")
    token_files.write(docs, path, tokenizer())
    return token_files.read(spark, path)


STAGES = [
    ("language-id", known_language), ("near-dedup", near_copies), ("decontamination", decontaminated),
    ("mixing", mixed), ("tokens", tokens),
]

# SQL has neither the learned model nor the tokenizer: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage's rows are written before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
