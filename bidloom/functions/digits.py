"""Digits of other scripts as ASCII."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OTHER = "".join(chr(base + i) for base in (0x0660, 0x06F0) for i in range(10))


def ascii_digits(text: Column) -> Column:
    """Arabic-Indic and Persian digits become 0-9; all else stays."""
    return F.translate(text, _OTHER, "0123456789" * 2)
