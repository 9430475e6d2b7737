"""Lower-casing of A-Z only, as a column and in Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: str) -> str:
    """Python form: the lower-casing of bytes changes A-Z alone."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the much cheaper ``lower``,
    which does the same there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())
    )
