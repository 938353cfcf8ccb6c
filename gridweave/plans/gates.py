"""Acceptance of extractions before they are resolved: findings by gate, metrics, the change against a baseline, quotes, page numbers,
and the tool calls of the transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.functions import text
from gridweave.functions.text import WS
from gridweave.operators import matching, quality, xref
from gridweave.plans.resolve import KEY
from gridweave.session import kept
from gridweave.sources import tables

#: What a document that is ready says of itself; the kinds of notes that are not bound by markers; the shortest text that
#: is compared; how a mere pointer begins and how long it may be; notes of one kind from which that is suspicious; words of a label.
NAME, VERSION, READY = "soa-table-extraction", "1.0", "ready_for_resolution"
UNBOUND_KINDS = ["legend", "abbreviation"]
LEAST_TEXT, POINTER, POINTER_CHARS, MANY_NOTES, LABEL_WORDS = 25, r"(?i)^(see|refer to)\b", 130, 20, 4
#: Lengths of a quote, of its fragments, its fewest words, and what shows that a span is no quote.
QUOTE_LEAST, QUOTE_MOST, FRAGMENT, QUOTE_WORDS, NO_QUOTE = 30, 400, 15, 4, r"\*\*|\||`|_[a-z]|\.(json|md|pdf)\b|§|→"

METRICS = ["acts", "bind", "marks", "props", "grid", "ann", "fn", "sn", "ab", "lg"]


def _marked(docs: DataFrame) -> DataFrame:
    """KEY, row_position, marker of everything that carries markers."""
    arrays = ["schedule_properties", "activities", "activity_schedule", "schedule_grid"]
    rows = [docs.select(*KEY, F.explode(f"doc.{a}").alias("e")).select(*KEY, "e.row_position", F.explode(text.marker_list(F.col("e.annotation_markers"))).alias("marker")) for a in arrays]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


def metrics(docs: DataFrame) -> DataFrame:
    """KEY, ttype, pages and METRICS: how much of each kind an extraction holds; bind counts the distinct markers on rows."""
    size = lambda a: F.coalesce(F.size(f"doc.{a}"), F.lit(0))
    of_kind = lambda k: F.coalesce(F.size(F.filter("doc.annotations", lambda a: a["annotation_type"] == k)), F.lit(0))
    meta = docs.select(
        *KEY, F.col("doc.table_metadata.table_type").alias("ttype"), F.concat_ws("-", F.col("doc.table_metadata.page_start").cast("string"), F.col("doc.table_metadata.page_end").cast("string")).alias("pages"),
        size("activities").alias("acts"), size("activity_schedule").alias("marks"), size("schedule_properties").alias("props"), size("schedule_grid").alias("grid"), size("annotations").alias("ann"),
        of_kind("footnote").alias("fn"), of_kind("source_note").alias("sn"), of_kind("abbreviation").alias("ab"), of_kind("legend").alias("lg"),
    )
    bound = _marked(docs).groupBy(*KEY).agg(F.countDistinct("marker").cast("int").alias("bind"))
    return meta.join(bound, KEY, "left").fillna(0, ["bind"])


def findings(docs: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """KEY, gate, severity (FAIL, CHECK or WARN), subject. docs: KEY and doc; baseline: metrics() of what was accepted before.

    A missing array counts as empty here; resolve() reports it. Tables of the baseline that are not there any more are found too."""
    say = lambda df, gate, severity, subject: df.select(*KEY, F.lit(gate).alias("gate"), F.lit(severity).alias("severity"), subject.cast("string").alias("subject"))
    meta, status = F.col("doc.table_metadata"), F.col("doc.extraction_metadata.extraction_status")
    notes = docs.select(*KEY, F.posexplode("doc.annotations").alias("pos", "a")).select(*KEY, "pos", "a.*").withColumnRenamed("annotation_marker", "marker")
    norm = text.norm_note(F.coalesce("annotation_text", F.lit("")))
    marked = _marked(docs)
    places = notes.select(*KEY, "pos", "marker", "annotation_type", F.explode("marker_locations").alias("l")).where("coalesce(l.location_type, '') <> 'unresolved'")
    partial = quality.partial_bindings(places.select(*KEY, "marker", F.col("l.row_position").alias("row_position")), marked, [*KEY, "marker"], "row_position")
    per = places.where(~F.coalesce(F.col("annotation_type"), F.lit("")).isin(UNBOUND_KINDS)).groupBy(*KEY, "pos", "marker").agg(
        F.bool_and(F.coalesce(F.col("l.location_type"), F.lit("")) == "schedule_property").alias("scoped"), F.bool_and(F.coalesce(F.col("l.method"), F.lit("")) == "synthesized").alias("made"), F.bool_and(F.col("l.method").isNull()).alias("silent")
    )
    unbound = per.join(marked.select(*KEY, "marker").distinct(), [*KEY, "marker"], "left_anti").where("not (scoped and made)")
    texts = notes.select(*KEY, "marker", norm.alias("t")).where(F.length("t") >= LEAST_TEXT)
    held = matching.contains_join(texts.select(*KEY, F.col("t").alias("needle")).distinct(), texts.select(*KEY, F.col("t").alias("stack")).distinct(), KEY, "needle", "stack", LEAST_TEXT).where("needle <> stack")
    inside = held.join(texts.withColumnRenamed("t", "needle"), [*KEY, "needle"])
    twice = texts.groupBy(*KEY, "t").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    body = F.regexp_replace(F.trim("annotation_text"), r"\.$", "")
    pointers = notes.where(F.trim("annotation_text").rlike(POINTER) & (F.length("annotation_text") <= POINTER_CHARS) & ~body.contains(". ") & ~body.contains("; ") & (F.coalesce("annotation_type", F.lit("")) != "source_note"))
    acts = docs.select(*KEY, F.explode("doc.activities").alias("a")).select(*KEY, "a.source_page")
    paged = acts.groupBy(*KEY).agg(F.count("source_page").alias("known"), F.count(F.lit(1)).alias("n"))
    span = docs.select(*KEY, meta["page_start"].alias("f"), meta["page_end"].alias("l")).join(paged.where("known > 0"), KEY)
    empty = quality.coverage_gaps(span.where("f <= l"), KEY, "f", "l", acts, "source_page")
    cells = docs.select(*KEY, F.explode("doc.activity_schedule").alias("c")).where("c.is_merged_cell and coalesce(c.source_range, '') = ''")
    track = meta["track_label"]
    named = F.coalesce(track, F.lit("")) != ""
    words = F.size(F.filter(F.split(track, f"[{WS}/,]+"), lambda w: (w != "") & ~F.lower(w).isin("and", "-", "&")))
    is_track = F.coalesce(meta["table_type"], F.lit("")) == "track"
    out = [
        say(docs.where(F.coalesce("doc.schema_name", F.lit("")) != NAME), "1 schema", "FAIL", F.coalesce("doc.schema_name", F.lit(""))),
        say(docs.where(F.coalesce("doc.schema_version", F.lit("")) != VERSION), "1 schema", "FAIL", F.coalesce("doc.schema_version", F.lit(""))),
        say(docs.where(F.coalesce(status, F.lit("")) != READY), "1 schema", "FAIL", F.coalesce(status, F.lit(""))),
        say(notes.where(F.coalesce(F.size("marker_locations"), F.lit(0)) <= 0), "2 orphan", "FAIL", F.col("marker")),
        say(partial, "3 binding", "FAIL", F.concat_ws(" ", F.col("marker"), F.col("row_position").cast("string"))),
        say(unbound.where("not (scoped and silent)"), "3 binding", "FAIL", F.col("marker")),
        say(unbound.where("scoped and silent"), "3 binding", "CHECK", F.col("marker")),
        say(inside, "4 containment", "CHECK", F.col("marker")),
        say(twice, "4 duplicate-text", "CHECK", F.col("n")),
        say(pointers, "5a typing", "CHECK", F.col("marker")),
        say(quality.degenerate(notes, KEY, "annotation_type", "source_note", MANY_NOTES), "5 typing", "FAIL", F.col("n")),
        say(paged.where("known < n"), "6 coverage", "WARN", F.when(F.col("known") == 0, F.lit("no page")).otherwise((F.col("n") - F.col("known")).cast("string"))),
        say(empty, "6 coverage", "WARN", F.concat(F.lit("page "), F.col("source_page").cast("string"))),
        say(cells, "9 merged", "FAIL", F.concat_ws(":", F.col("c.row_position").cast("string"), F.col("c.column_position").cast("string"))),
        say(docs.where(is_track & ~named), "10 track", "FAIL", F.lit("no label")),
        say(docs.where(~is_track & named), "10 track", "FAIL", track),
        say(docs.where(named & (words > LABEL_WORDS)), "10 track", "CHECK", track),
    ]
    if baseline is not None:
        both = metrics(docs).select(*KEY, "acts", "bind").join(baseline.select(*KEY, F.col("acts").alias("acts_0"), F.col("bind").alias("bind_0")), KEY).where("bind_0 > 0 and acts >= acts_0 and bind < bind_0")
        change = F.concat_ws(" to ", F.col("bind_0").cast("string"), F.col("bind").cast("string"))
        out += [say(both.where("bind * 2 < bind_0"), "12 bindings", "FAIL", change), say(both.where("bind * 2 >= bind_0"), "12 bindings", "CHECK", change)]
        out.append(say(xref.undefined(baseline, docs, KEY), "missing", "FAIL", F.lit("table of the baseline")))
    df = out[0]
    for o in out[1:]:
        df = df.unionByName(o)
    return df


def quote_check(reports: DataFrame, sources: DataFrame, group: list[str]) -> DataFrame:
    """group, quote, verdict of every distinct quotation of the reports: exact, loose (blanks apart), not_found or skipped.

    reports: group, report; sources: group, source. A quotation that leaves something out counts by its fragments; each must stand in
    one of the sources. Spans with few words or signs of code are skipped."""
    blocks = F.transform(F.split("report", r"\n\s*\n"), lambda b: F.trim(F.regexp_replace(b, f"[{WS}]+", " ")))
    inner = lambda b, sign: F.transform(F.filter(F.transform(F.split(b, sign), lambda p, i: F.struct(i.alias("i"), p.alias("p"))), lambda x: x["i"] % 2 == 1), lambda x: F.trim(x["p"]))
    # a piece after the last sign of an odd number is open, as it is between signs by its place; it counts as a quotation
    found = F.flatten(F.transform(blocks, lambda b: F.concat(inner(b, '"'), inner(b, "[“”]"))))
    quotes = reports.select(*group, F.explode(found).alias("quote")).where(F.length("quote").between(QUOTE_LEAST, QUOTE_MOST)).distinct()
    parts = F.filter(F.split("quote", r"\s*(?:…|\.\.\.)\s*"), lambda f: F.length(f) >= FRAGMENT)
    judged = kept(quotes, "quotes").withColumn("f", parts).withColumn("skip", F.col("quote").rlike(NO_QUOTE) | (F.size(F.split("quote", " ")) < QUOTE_WORDS) | (F.size("f") == 0))
    frags = kept(judged.where("not skip").select(*group, "quote", F.explode("f").alias("f")), "fragments")
    tight = lambda c: F.regexp_replace(c, f"[{WS}]+", "")
    hay = kept(sources.select(*group, F.trim(F.regexp_replace("source", f"[{WS}]+", " ")).alias("source")).distinct(), "sources")
    asked = kept(frags.select(*group, "f").distinct(), "asked")
    exact = kept(matching.contains_join(asked, hay, group, "f", "source", FRAGMENT).select(*group, "f", F.lit(2).alias("n")).distinct(), "exact")
    bare = kept(asked.join(exact, [*group, "f"], "left_anti").select(*group, "f", tight(F.col("f")).alias("needle")).where("needle <> ''"), "bare")
    places = kept(hay.join(bare.select(*group).distinct(), group, "left_semi").select(*group, tight(F.col("source")).alias("stack")).distinct(), "places")
    loose = matching.contains_join(bare, places, group, "needle", "stack", FRAGMENT * 4 // 5).select(*group, "f", F.lit(1).alias("n")).distinct()
    best = exact.unionByName(kept(loose, "loose"))
    worst = frags.join(best.hint("merge"), [*group, "f"], "left").groupBy(*group, "quote").agg(F.min(F.coalesce("n", F.lit(0))).alias("n"))
    verdict = F.when(F.col("skip"), "skipped").when(F.col("n") == 2, "exact").when(F.col("n") == 1, "loose").otherwise("not_found")
    return judged.join(worst, [*group, "quote"], "left").select(*group, "quote", verdict.alias("verdict"))


def page_decisions(studies: DataFrame, front: Column | None = None, back: Column | None = None, explicit: Column | None = None) -> DataFrame:
    """study, decision, pages: which document page each page of an excerpt is. studies: study, first, last, n_pages, and what the
    conditions read: front or back say where extra pages stand, explicit gives the pages themselves.

    Decisions: explicit, equal, fewer (not contiguous), front, back, undecided, and none without pages or range; pages are null where
    nothing is decided."""
    no = F.lit(False)
    first, last, n = F.col("first"), F.col("last"), F.col("n_pages")
    extra = n - (last - first + 1)
    given = F.lit(None).cast("array<int>") if explicit is None else explicit
    how = (
        F.when(n.isNull() | (n < 1) | first.isNull() | last.isNull(), "none").when(given.isNotNull(), "explicit").when(extra == 0, "equal").when(extra < 0, "fewer")
        .when(F.coalesce(front if front is not None else no, no), "front").when(F.coalesce(back if back is not None else no, no), "back").otherwise("undecided")
    )
    ahead, behind = F.sequence(first, first + n - 1), F.sequence(last - n + 1, last)
    pages = F.when(how == "explicit", given).when(how.isin("equal", "back"), ahead).when(how == "front", behind)
    return studies.select("study", how.alias("decision"), pages.cast("array<int>").alias("pages"), "last")


def page_map_text(decided: DataFrame) -> DataFrame:
    """study, name, text: a page map in Markdown for every study with decided pages."""
    rows = F.transform("pages", lambda p, i: F.concat(F.lit("| "), (i + 1).cast("string"), F.lit(" | "), p.cast("string"), F.lit(" |"), F.when(p > F.col("last"), F.lit(" beyond the declared range")).otherwise(F.lit(""))))
    head = F.concat(F.lit("# "), F.col("study"), F.lit(": pages of the excerpt and of the document\n\nPages: "), F.size("pages").cast("string"), F.lit("; "), F.col("decision"), F.lit(".\n\n| excerpt | document |\n|---:|---:|\n"))
    return decided.where("pages is not null").select("study", F.lit("PAGEMAP.md").alias("name"), F.concat(head, F.array_join(rows, "\n"), F.lit("\n")).alias("text"))


def call_findings(lines: DataFrame, forbidden: list[tuple[str, str]], own: str, other: str, file: str = "file", value: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, leaks, crosses) of transcripts given as lines (file, value): number of calls by tool; calls that name something forbidden,
    with the first pattern that fits; and the others that name another study than the file's own. own: pattern of a study in a file's
    name; other: pattern, with a group, of a study in a call's input, which also gives the study of a file without one."""
    each = tables.tool_calls(lines, value, [file])
    calls = each.groupBy("tool").agg(F.count(F.lit(1)).alias("n"))
    leaks = quality.first_pattern(each, "input", [(name, pattern) for pattern, name in forbidden], "what").select(file, "tool", "what", "input")
    named = F.nullif(F.regexp_extract(F.element_at(F.split(file, "/"), -1), own, 0), F.lit(""))
    seen = F.regexp_extract_all("input", F.lit(other), F.lit(1))
    firsts = each.where(F.size(seen) > 0).groupBy(file).agg(F.min_by(seen[0], "ordinal").alias("first"))
    rest = each.where(~F.greatest(*[F.coalesce(F.col("input").rlike(p), F.lit(False)) for p, _ in forbidden], F.lit(False)))
    mine = rest.join(firsts, file, "left").withColumn("mine", F.coalesce(named, F.col("first")))
    foreign = F.filter(seen, lambda s: s != F.col("mine"))
    crosses = mine.where(F.col("mine").isNotNull() & (F.size(foreign) > 0)).select(file, "tool", "mine", foreign[0].alias("other"))
    return calls, leaks, crosses
