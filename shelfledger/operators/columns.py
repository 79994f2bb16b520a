"""Header-level operators: renames only, no data is touched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def snake(name: str) -> str:
    return name.strip().lower().translate(str.maketrans(" -", "__"))


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake(c) for c in df.columns])


def with_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """All columns renamed to ``prefix`` + name, so header and line columns cannot collide."""
    return df.toDF(*[prefix + c for c in df.columns])


def align_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the target's columns, order and types.

    Columns the target lacks are dropped and columns the frame lacks become NULL. Names match
    without regard to case, as in the catalog.
    """
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )
