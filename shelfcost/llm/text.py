"""Word splitting shared by the operators: words are ``[^\\x20\\x09-\\x0D]+``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words of ``text`` in order (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z, and only these, in lower case."""
    return F.translate(text, _UPPER, _UPPER.lower())
