"""Text and number cleaning applied while staging."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rondo.schemas import TEXT_WIDTH


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def blank_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Empty or spaces-only text becomes null; other text is left untrimmed."""
    names = list(columns) if columns is not None else text_columns(df)
    return df.withColumns({c: F.when(F.trim(F.col(c)) != "", F.col(c)) for c in names})


def truncate_text(
    df: DataFrame, width: int = TEXT_WIDTH, columns: Iterable[str] | None = None
) -> DataFrame:
    """Cut text to ``width`` characters."""
    names = list(columns) if columns is not None else text_columns(df)
    return df.withColumns({c: F.substring(F.col(c), 1, width) for c in names})


def count_cut(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """One row: per column, how many values are longer than its width."""
    return df.agg(*[F.count_if(F.length(F.col(c)) > w).alias(f"{c}_cut") for c, w in widths.items()])


def to_int(name: str) -> Column:
    """Text to int; text that is no whole number gives null instead of an error."""
    return F.expr(f"try_cast(`{name}` AS INT)")


def to_double(name: str) -> Column:
    """Text to double; text that is no number gives null instead of an error."""
    return F.expr(f"try_cast(`{name}` AS DOUBLE)")


def to_whole_decimal(name: str) -> Column:
    """Store a number as numeric(18,0), fractions cut off towards zero."""
    return F.expr(f"cast(cast(`{name}` AS BIGINT) AS DECIMAL(18,0))")


def count_rejects(df: DataFrame, casts: dict[str, Column]) -> DataFrame:
    """One row: per source column, how many non-blank values the given cast turned into null."""
    return df.agg(
        *[
            F.count_if((F.trim(F.col(c)) != "") & cast.isNull()).alias(f"{c}_rejects")
            for c, cast in casts.items()
        ]
    )
