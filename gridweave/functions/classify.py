"""Classifiers as ordered CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridweave.functions.text import is_blank, strip

#: What a cell may hold as a mark or as a continuation sign, and words that say when or whether.
MARKS = ["X", "✓", "✔", "•", "◆"]
CONTINUATIONS = ["→", "...", "…"]
FREQUENCY, TIMING, CONDITION = ["DAILY", "WEEKLY", "PRN"], ["DAY", "WEEK", "HOUR"], ["IF", "OPTIONAL"]
#: A segment that defines an abbreviation; a name that stands for a redacted one; a range; a reference to a section.
LEGEND_SEGMENT = r"^\s*[A-Za-z][A-Za-z0-9()+/–\-. ]{0,30}="
REDACTED = r"CCI(\s*\(.*\))?"
RANGE = r"(\d+:\d+)?"
SECTION_REF = r"(?i)\b(section|appendix|attachment)\b"
#: The order in which types of notes and segments of the timeline are listed.
NOTE_ORDER = ["footnote", "abbreviation", "legend", "source_note", "continuation_note"]
SEGMENT_ORDER = ["main", "domain", "track", "subsidiary"]
#: Which segment a table type feeds, in the order of creation.
SEGMENTS = [("main_soa", "main"), ("continuation", "main"), ("domain", "domain"), ("track", "track"), ("subsidiary", "subsidiary")]


def _has(c: Column, words: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: c.contains(w))


def cell_kind(value: Column) -> Column:
    """empty, marker, continuation, frequency, timing_text, conditional or other, in this order."""
    v = F.upper(strip(value))
    return (
        F.when(is_blank(value), "empty").when(v.isin(MARKS), "marker").when(v.isin(CONTINUATIONS), "continuation")
        .when(_has(v, FREQUENCY), "frequency").when(_has(v, TIMING), "timing_text").when(_has(v, CONDITION), "conditional").otherwise("other")
    )


def is_legend(text: Column) -> Column:
    """Two or more segments that define something, or one of several."""
    parts = F.split(text, ";")
    n = F.size(F.filter(parts, lambda s: s.rlike(LEGEND_SEGMENT)))
    return F.coalesce((n >= 2) | ((n == 1) & (F.size(parts) >= 2)), F.lit(False))


def resolved_type(kind: Column, text: Column) -> Column:
    """legend for a text that reads as one, unless the type says legend or abbreviation already."""
    return F.when(~kind.isin("legend", "abbreviation") & is_legend(text), "legend").otherwise(kind)


def is_redacted(name: Column) -> Column:
    """The stripped name is the sign of a redaction, as a whole."""
    return F.coalesce(strip(name).rlike(rf"\A{REDACTED}\z"), F.lit(False))


def is_range(value: Column) -> Column:
    """Empty or first:last."""
    return F.coalesce(value.rlike(rf"\A{RANGE}\z"), F.lit(False))


def is_short_section_ref(norm: Column, text: Column, most: int = 10) -> Column:
    """A short reference to a section."""
    return (F.size(F.split(norm, " ")) <= most) & text.rlike(SECTION_REF)


def scope(props: Column, cols: Column, acts: Column, cells: Column) -> Column:
    """What a note refers to, from four flags: table, multiple, activity, cell or column."""
    n = sum(x.cast("int") for x in (props, cols, acts, cells))
    return F.when(n == 0, "table").when(n > 1, "multiple").when(acts, "activity").when(cells, "cell").otherwise("column")


def population_track(purpose: Column, title: Column) -> Column:
    """The population that a table's purpose and title speak of."""
    t = F.lower(F.concat_ws(" ", F.coalesce(purpose, F.lit("")), F.coalesce(title, F.lit(""))))
    return (
        F.when(t.contains("nonrespond") | t.contains("non-respond"), "Nonresponders").when(t.contains("responder"), "Responders")
        .when(t.contains("maintenance"), "Maintenance")
    )


def track_name(label: Column, purpose: Column, title: Column, table_number: Column) -> Column:
    """The label, else the population, else one made of the table's number; an empty text falls through."""
    return F.coalesce(F.nullif(label, F.lit("")), population_track(purpose, title), F.concat(F.lit("Track-T"), table_number.cast("string")))


def status(n_errors: Column, n_warnings: Column, good: str = "resolved") -> Column:
    """failed, {good}_with_warnings or {good}."""
    return F.when(n_errors > 0, "failed").when(n_warnings > 0, f"{good}_with_warnings").otherwise(good)


def match_class(match_status: Column, n_tables: Column) -> Column:
    """single, cross, fuzzy or exact: how an entity came together."""
    return (
        F.when(n_tables == 1, "single").when(match_status.contains("cross"), "cross").when(match_status.contains("fuzzy"), "fuzzy").otherwise("exact")
    )


def page_decision(declared: Column, found: Column) -> Column:
    """How many pages were found for a declared range: undeclared, none, equal, fewer or more."""
    return (
        F.when(declared.isNull(), "undeclared").when(F.coalesce(found, F.lit(0)) == 0, "none").when(declared == found, "equal")
        .when(found < declared, "fewer").otherwise("more")
    )


def conclusion(n: Column, n_tables: Column, n_types: Column, n_names: Column) -> Column:
    """How a property compares over tables: Identical, Same type, Differs, or in how many tables it stands."""
    return (
        F.when(n < n_tables, F.concat(n.cast("string"), F.lit("/"), n_tables.cast("string"), F.lit(" tables")))
        .when((n_types == 1) & (n_names == 1), "Identical").when(n_types == 1, "Same type").otherwise("Differs")
    )


def derived(rule: str, value: Column) -> Column:
    """A metadata field by a rule: first_token, or last_token_unless_nct (empty where there is one token or the last is a registry number); tokens are parted by underscores."""
    tokens = F.split(F.coalesce(value, F.lit("")), "_")
    if rule == "first_token":
        return tokens[0]
    if rule == "last_token_unless_nct":
        last = F.element_at(tokens, -1)
        return F.when((F.size(tokens) >= 2) & ~last.startswith("NCT"), last).otherwise(F.lit(""))
    raise ValueError(f"unknown rule {rule}")


def resolved_name(name: Column) -> Column:
    """File name of the resolved document of an extraction, verified or not."""
    return F.regexp_replace(name, r"_extraction(\.verified)?\.json$", "_resolved.json")
