"""Column expressions over texts that several operators share; built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WORD_BREAK

_TRIMMED = " \t\n\x0b\x0c\r"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(_TRIMMED))


def words(text: Column) -> Column:
    """Words of a text, an empty array if it has none."""
    inner = trimmed(text)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_BREAK))


def without(text: Column, characters: str) -> Column:
    """``text`` without these characters."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text
