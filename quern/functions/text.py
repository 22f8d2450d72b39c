"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def visible_length(text: Column) -> Column:
    """Number of characters without trailing blanks."""
    return F.length(F.rtrim(text))


def join_text(*parts: Column, null_wins: bool = True) -> Column:
    """Concatenate; a NULL part makes the result NULL unless ``null_wins`` is off."""
    return F.concat(*parts) if null_wins else F.concat_ws("", *parts)


def drop_last_char(text: Column) -> Column:
    """All but the last visible character."""
    return F.left(text, F.greatest(visible_length(text) - 1, F.lit(0)))


def fixed_width(text: Column, width: int) -> Column:
    """Pad with blanks on the right, as a fixed-width text column stores it."""
    return F.rpad(text.cast("string"), width, " ")


def folded(text: Column) -> Column:
    """The text under a collation that does not see letter case."""
    return F.collate(text, "UTF8_LCASE")


def normalized_statement(statement: Column) -> Column:
    """A statement with letter case, spacing and literals levelled out."""
    text = F.lower(F.trim(statement))
    text = F.regexp_replace(text, r"'[^']*'", "?")
    text = F.regexp_replace(text, r"\b[0-9]+(\.[0-9]+)?\b", "?")
    return F.regexp_replace(text, r"\s+", " ")
