"""Text expressions: normal forms, keys, scores. All are Column expressions; nothing here runs Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that count as white space everywhere (Unicode white space and the separators 1C to 1F), as the
#: inside of a character class that Java and RE2 read alike.
WS = r"\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def squeeze(c: Column) -> Column:
    """White space runs to one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"[{WS}]+", " "))


def strip(c: Column) -> Column:
    """No white space at the ends, tabs and line breaks included."""
    return F.regexp_replace(F.regexp_replace(c, f"^[{WS}]+", ""), f"[{WS}]+$", "")


def is_blank(c: Column) -> Column:
    """Null, empty or only white space."""
    return F.coalesce(strip(c), F.lit("")) == ""


def norm_name(c: Column) -> Column:
    """Name form: lower case, '-' and '/' as blanks, no parentheses, single blanks."""
    return squeeze(F.regexp_replace(F.translate(F.lower(c), "-/", "  "), r"\([^)]*\)", ""))


def norm_note(c: Column) -> Column:
    """Note form: lower case, single blanks."""
    return squeeze(F.lower(c))


def norm_key(c: Column) -> Column:
    """Audit form: lower case letters a-z and digits only; null as empty."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def label_keys(c: Column) -> Column:
    """The audit form of a label, and that without a parenthetical at its end; empty ones dropped."""
    short = F.regexp_replace(c, rf"[{WS}]*\([^)]*\)[{WS}]*$", "")
    return F.filter(F.array_distinct(F.array(norm_key(c), norm_key(short))), lambda k: k != "")


def word_set(c: Column) -> Column:
    """Distinct words of the name form that are longer than two."""
    return F.array_distinct(F.filter(F.split(norm_name(c), " "), lambda w: F.length(w) > 2))


def overlap_of_sets(a: Column, b: Column) -> Column:
    """0.6 of the shared share of the smaller set and 0.4 of that of the union; 0 where one is empty."""
    both = F.size(F.array_intersect(a, b))
    score = F.lit(0.6) * (both / F.least(F.size(a), F.size(b))) + F.lit(0.4) * (both / F.size(F.array_union(a, b)))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), score).otherwise(F.lit(0.0))


def word_overlap(a: Column, b: Column) -> Column:
    """overlap_of_sets() of the words of two names."""
    return overlap_of_sets(word_set(a), word_set(b))


def contains_in_order(key: Column, printed: Column) -> Column:
    """Every character of key stands in printed, in order."""
    signs = F.filter(F.split(key, ""), lambda x: x != "")

    def step(at: Column, sign: Column) -> Column:
        found = F.call_function("locate", sign, printed, at + 1)
        return F.when((at < 0) | (found == 0), F.lit(-1)).otherwise(found)

    return F.aggregate(signs, F.lit(0), step) >= 0


def sentences(c: Column, least: int = 15) -> Column:
    """Pieces after '.', ';' or ':' and white space, stripped, of at least so many characters."""
    parts = F.split(c, f"(?<=[.;:])[{WS}]+")
    return F.filter(F.transform(parts, strip), lambda s: F.length(s) >= least)


def quoted_spans(c: Column, sign: str = '"', shortest: int = 30, longest: int = 400) -> Column:
    """Texts between two quote signs, of a length in the range; nothing reaches over a blank line."""
    spans = F.flatten(F.transform(F.split(c, r"\n[ \t]*\n"), lambda block: F.filter(F.split(block, sign), lambda x, i: i % 2 == 1)))
    return F.filter(spans, lambda s: F.length(s).between(shortest, longest))


def preview(c: Column, longest: int = 120) -> Column:
    """The text, or its start and '...' where it is longer."""
    return F.when(F.length(c) > longest, F.concat(F.substring(c, 1, longest - 3), F.lit("..."))).otherwise(c)


def marker_list(c: Column) -> Column:
    """The trimmed non-empty entries of a comma list; null as none."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip), lambda m: m != "")


def page_range(c: Column) -> Column:
    """'a-b' or 'a' as struct(first, last, n); null where it is neither."""
    first, last = F.regexp_extract(c, r"^\s*(\d+)", 1), F.regexp_extract(c, r"^\s*\d+\s*-\s*(\d+)\s*$", 1)
    a = F.when(first != "", first.cast("int"))
    b = F.when(last != "", last.cast("int")).when(c.rlike(r"^\s*\d+\s*$"), a)
    return F.when(b.isNotNull(), F.struct(a.alias("first"), b.alias("last"), (b - a + 1).alias("n")))


def span(c: Column) -> Column:
    """'first:last' as struct(first, last); null where it is not of that form."""
    parts = F.split(c, ":")
    return F.when(c.rlike(r"\A\d+:\d+\z"), F.struct(parts[0].cast("int").alias("first"), parts[1].cast("int").alias("last")))
