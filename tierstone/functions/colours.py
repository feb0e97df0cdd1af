"""Map colours from two spellings: ``0.00 TO 0.29 BROWN-953736`` and ``blue``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierstone.functions.parsing import literal_lookup
from tierstone.vocab import COLOUR_HEX, UNKNOWN_COLOUR_HEX

# The suffix that carries the hex code, and the words in front of it.
HEX_SUFFIX = r"-([0-9A-Fa-f]{6})$"
WORDS_BEFORE_HEX = r"([A-Za-z][A-Za-z\s]*)-[0-9A-Fa-f]{6}$"


def color_hex(code: Column) -> Column:
    """``#`` + trailing hex digits, else the colour's fixed hex, else grey."""
    digits = F.regexp_extract(code, HEX_SUFFIX, 1)
    return F.coalesce(
        F.when(digits != "", F.concat(F.lit("#"), digits)),
        literal_lookup(code, COLOUR_HEX),
        F.lit(UNKNOWN_COLOUR_HEX),
    )


def color_name(code: Column) -> Column:
    """Upper-case words before the hex suffix (without a stray range word ``TO``), else the code."""
    words = F.upper(F.trim(F.regexp_extract(code, WORDS_BEFORE_HEX, 1)))
    return F.when(words != "", F.regexp_replace(words, r"^TO\s+", "")).otherwise(F.upper(F.trim(code)))
