"""The lexical rule of marker fields as Column expressions, and the same rule as text for other engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters of an unquoted marker, and the further ones of display markers.
MARKER_CHARS = "A-Za-z0-9_*†‡§#"
DISPLAY_CHARS = MARKER_CHARS + r":\-"

#: The quoting styles. A doubled straight double quote stands for one. Loops are possessive, so that the
#: engine keeps no stack on long texts; the second form takes the longest balanced start where the last quote is missing.
QUOTES = {
    "double": r'"[^"]*+(?:""[^"]*+)*+"|"[^"]*+(?:""[^"]*+(?=""))*+"',
    "single": r"'[^']*+'",
    "typographic": r"“[^”]*+”",
}


def value_pattern(chars: str, quotes: tuple[str, ...] = tuple(QUOTES)) -> str:
    """Java pattern of one value: quoted in one of the styles, or a run of chars."""
    return "|".join([QUOTES[q] for q in quotes] + [f"[{chars}]++"])


def unquoted(value: Column) -> Column:
    """The value without its outer quotes; inside straight double quotes a doubled one becomes one."""
    stripped = F.substring(value, F.lit(2), F.length(value) - 2)
    return (
        F.when(value.startswith('"'), F.replace(stripped, F.lit('""'), F.lit('"')))
        .when(value.startswith("'") | value.startswith("“"), stripped)
        .otherwise(value)
    )


def values_of(field: Column, chars: str, quotes: tuple[str, ...] = tuple(QUOTES)) -> Column:
    """Array of the values of a field in their order, repeats included; a null field gives null, an empty quoted value is none."""
    found = F.regexp_extract_all(field, F.lit(value_pattern(chars, quotes)), F.lit(0))
    return F.filter(F.transform(found, unquoted), lambda v: v != "")
