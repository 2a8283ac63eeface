"""String expressions used while cleaning landing data."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cityzones.functions._col import as_col

# FIXED VALUES: the parity patch for a CSV line whose first quoted field holds
# a comma.  It removes the first comma after the first quote and the last quote
# of the line; matches the landing-zone parser the data was produced with.
QUOTED_COMMA_PATTERN = r'(".*?),(.*)(")'
QUOTED_COMMA_REPLACEMENT = "$1$2"

# FIXED VALUES: accent folding used by name normalisation (lower-case letters of
# the Catalan / Spanish / French / German names in the data), and its target.
ACCENTED = "àáâãäåèéêëìíîïòóôõöùúûüýÿçñ"
UNACCENTED = "aaaaaaeeeeiiiiooooouuuuyycn"


def remove_char(col, ch: str = '"') -> Column:
    """Remove every occurrence of ``ch``."""
    return F.replace(as_col(col), F.lit(ch), F.lit(""))


def strip_char(col, ch: str = '"') -> Column:
    """Strip leading and trailing runs of ``ch``."""
    return F.btrim(as_col(col), F.lit(ch))


def strip_char_all(arr, ch: str = '"') -> Column:
    """Strip ``ch`` from both ends of every element of a string array."""
    return F.transform(as_col(arr), lambda c: F.btrim(c, F.lit(ch)))


def split_fields(col, sep: str = ",") -> Column:
    """Split on a literal separator, keeping trailing empty fields."""
    return F.split(as_col(col), re.escape(sep), -1)


def patch_quoted_comma(col) -> Column:
    """Naive-CSV parity patch, see ``QUOTED_COMMA_PATTERN``."""
    return F.regexp_replace(as_col(col), QUOTED_COMMA_PATTERN, QUOTED_COMMA_REPLACEMENT)


def normalize_name(col) -> Column:
    """Matching key for free-text names: lower case, accents folded, every run
    of characters outside ``[a-z0-9]`` turned into one space, ends trimmed.

    "Sarrià-Sant Gervasi" -> "sarria sant gervasi"."""
    folded = F.translate(F.lower(as_col(col)), ACCENTED, UNACCENTED)
    return F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " "))
