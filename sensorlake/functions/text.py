"""Text normalisation as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITESPACE = " \t\n\r\f\v"


def strip(text: Column) -> Column:
    """Remove every kind of surrounding whitespace, not only spaces."""
    return F.btrim(text, F.lit(_WHITESPACE))


def normalized(text: Column, case: str, null_text: str | None = None) -> Column:
    """Strip and fold to ``case`` ("lower" or "upper").

    A missing text stays NULL; ``null_text`` turns it into that word instead,
    which then is folded like any other.
    """
    text = text.cast("string")
    if null_text is not None:
        text = F.coalesce(text, F.lit(null_text))
    return strip({"lower": F.lower, "upper": F.upper}[case](text))
