"""From resolved tables to one consolidated protocol: entities, timeline, matrix, notes, statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridweave.functions import classify, text
from gridweave.operators import fold, hierarchy, ids, matrix, merge, report, xref
from gridweave.plans.resolve import KEY, Resolved
from gridweave.session import kept

STATUSES = ["exact", "fuzzy_auto", "fuzzy_cross_parent", "fuzzy_review", "new"]
#: What notes refer to, and the kind of element by which they do.
REFERENCES = {"referenced_xacts": "activity", "referenced_xcols": "column", "referenced_props": "property", "cell_references": "cell"}


@dataclass
class Consolidated:
    """The consolidated layer in long form; every table has protocol_id."""

    activities: DataFrame
    sources: DataFrame
    columns: DataFrame
    properties: DataFrame
    matrix: DataFrame
    annotations: DataFrame
    review_queue: DataFrame
    stats: DataFrame

    def all(self) -> dict[str, DataFrame]:
        return dict(vars(self))


def _number(ident: Column) -> Column:
    """The number of an id, by which ids of more than three digits sort too."""
    return F.regexp_extract(ident, r"(\d+)$", 1).cast("int")


def _listed(df: DataFrame, key: list[str], value: str, order: list[str], name: str) -> DataFrame:
    """key and the distinct values in order of first appearance."""
    lists = xref.collected(df, key, value, order, name)
    return lists.withColumn(name, F.array_distinct(name))


def entity_sources(r: Resolved) -> DataFrame:
    """Of each source row the entity it became, and its turn. Reference tables take no part."""
    kinds = r.tables.select(*KEY, "table_id", "table_type")
    acts = r.activities.join(kinds, KEY).where("table_type <> 'reference'")
    names = r.activities.select(*KEY, F.col("activity_id").alias("parent_activity_id"), F.col("activity_name").alias("parent"))
    rows = acts.join(names, [*KEY, "parent_activity_id"], "left").select(
        *KEY, F.col("table_number").alias("table_rank"), (F.col("table_type") == "main_soa").alias("is_base"), "pos", F.col("activity_name").alias("name"),
        F.coalesce("parent", F.lit("")).alias("parent"), F.col("is_section_header").alias("header"),
    )
    rows = kept(rows, "rows")
    made = fold.resolve_entities(rows, ["protocol_id"])
    own = acts.select(*KEY, "pos", "table_id", "activity_id", "row_position", "activity_name", "hierarchy_level", "is_section_header", "is_redacted", "table_type")
    parents = rows.select(*KEY, "pos", "parent")
    sources = kept(made.join(own.hint("merge"), [*KEY, "pos"]).join(parents, [*KEY, "pos"]), "sources")
    return sources.withColumn("turn", F.struct(F.when(F.col("table_type") == "main_soa", 0).otherwise(1).alias("b"), F.col("table_number").alias("t"), F.col("pos").alias("p")))


def entities(r: Resolved) -> tuple[DataFrame, DataFrame]:
    """(activities, sources): consolidated entities, and of each source row the entity it became."""
    sources = entity_sources(r)
    first = lambda c, name=None: F.min_by(c, "turn").alias(name or c)
    each = sources.groupBy("protocol_id", "xact_id").agg(
        first("entity_name", "activity_name"), first("entity_parent", "parent_name"), first("hierarchy_level"), first("is_section_header"), F.bool_or("is_redacted").alias("is_redacted"),
        F.min_by(F.concat_ws("::", "parent", "activity_name"), "turn").alias("qualified_key"), first("entity_status", "match_status"), first("entity_confidence", "match_confidence"),
        F.countDistinct("table_number").cast("int").alias("table_count"), F.min(F.struct("table_number", "row_position")).alias("first_place"),
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "table_id", "table_number", "activity_id", "row_position"))), lambda s: F.struct(s["table_id"].alias("table_id"), s["table_number"].alias("table_num"), s["activity_id"].alias("activity_id"), s["row_position"].alias("row_position"))).alias("source_refs"),
        F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("turn", F.col("activity_name").alias("n")))), lambda s: s["n"])).alias("name_variations"),
    )
    made_at = _number(F.col("xact_id"))
    by_name = each.groupBy("protocol_id", F.col("activity_name").alias("_up")).agg(F.min_by("xact_id", made_at).alias("parent_xact_id"))
    primary = F.nullif(F.element_at(F.split("parent_name", " / "), 1), F.lit(""))
    each = each.withColumn("_up", primary).join(by_name, ["protocol_id", "_up"], "left").drop("_up").withColumn("made", made_at)
    each = kept(each, "entities")
    order = hierarchy.preorder(each, ["protocol_id"], "xact_id", "parent_xact_id", ["first_place", "made"], "display_order")
    return each.join(order, ["protocol_id", "xact_id"]).drop("first_place", "made"), sources.drop("turn")


def timeline(r: Resolved) -> tuple[DataFrame, DataFrame]:
    """(columns, properties): data columns in order of segments with their ids, and the first property of each level or kind."""
    segment = F.create_map(*[F.lit(x) for k, s in classify.SEGMENTS for x in (k, s)])
    rank = F.array_position(F.array(*[F.lit(k) for k, _ in classify.SEGMENTS]), F.col("table_type"))
    track = classify.track_name(F.col("track_label"), F.col("table_purpose"), F.col("table_title"), F.col("table_number"))
    cols = r.columns.where("not is_label_column").join(r.tables.select(*KEY, "table_id", "table_type", "track_label", "table_purpose", "table_title"), KEY).where(rank > 0)
    w = Window.partitionBy("protocol_id").orderBy("_r", "table_number", "column_position")
    cols = cols.withColumn("_r", rank).withColumn("xcol", F.row_number().over(w)).select(
        *KEY, "table_id", "column_id", "column_position", ids.mint("xcol", F.col("xcol")).alias("xcol_id"), "xcol", segment[F.col("table_type")].alias("segment"),
        F.when(F.col("table_type") == "track", track).alias("population_track"), "composite_label",
    )
    props = r.properties.select(*KEY, "property_id", F.coalesce("property_type", F.lit("other")).alias("property_type"), "property_name", "hierarchical_level", F.coalesce("property_comment", F.lit("")).alias("property_comment"))
    used = r.column_values.join(cols.select(*KEY, "column_position", "xcol"), [*KEY, "column_position"]).join(props, [*KEY, "property_id"]).withColumn("prop_key", property_key())
    info = used.groupBy("protocol_id", "prop_key").agg(F.min_by(F.struct("property_id", "property_type", "property_name", "hierarchical_level", "property_comment"), F.struct("xcol", "pos")).alias("i"))
    w = Window.partitionBy("protocol_id").orderBy(F.col("i.hierarchical_level").isNull(), "i.hierarchical_level", "prop_key")
    return cols, info.select("protocol_id", "prop_key", "i.*", F.row_number().over(w).alias("rank"))


def property_key() -> Column:
    """The level, or the type and name of a property without one."""
    return F.coalesce(F.col("hierarchical_level").cast("string"), F.concat(F.lit("q_"), F.coalesce("property_type", F.lit("other")), F.lit("_"), F.coalesce("property_name", F.lit(""))))


def schedule(r: Resolved, sources: DataFrame, columns: DataFrame) -> DataFrame:
    """The sparse matrix of consolidated activities and columns; cells of unknown ones are dropped."""
    cells = r.cells.join(sources.select(*KEY, "activity_id", "xact_id"), [*KEY, "activity_id"]).join(columns.select(*KEY, "column_id", "xcol_id"), [*KEY, "column_id"])
    return matrix.consolidate_cells(cells, ["protocol_id", "xact_id", "xcol_id"], "table_number", "cell_value", "pos")


def consolidate(r: Resolved) -> Consolidated:
    """One shuffle by protocol for the fold of entities; everything else joins on ids within a protocol."""
    activities, sources = entities(r)
    activities = kept(activities, "activities")
    columns, properties = timeline(r)
    columns, properties = kept(columns, "columns"), kept(properties, "properties")
    annotations = notes_of(r, sources, columns, properties)
    return Consolidated(activities, sources, columns, properties, schedule(r, sources, columns), annotations, review_queue(sources), _stats(r, activities, sources, annotations))


def review_queue(sources: DataFrame) -> DataFrame:
    """The matches that a person has to look at."""
    return sources.where("match_status = 'fuzzy_review'").select("protocol_id", "xact_id", F.col("match_confidence").alias("confidence"), F.col("entity_name").alias("existing_name"), F.col("activity_name").alias("new_name"))


def merged_notes(r: Resolved, sources: DataFrame | None = None, columns: DataFrame | None = None, properties: DataFrame | None = None, refs: tuple[str, ...] = ()) -> DataFrame:
    """Notes once for each normal text, with those of REFERENCES that are asked for, each with the tables that it needs, in any table.

    Truth is the markers of rows; only notes for which those give no activity are bound by their recorded locations."""
    notes = r.annotations.withColumn("ord", F.row_number().over(Window.partitionBy("protocol_id").orderBy("table_number", "pos")))
    full = notes.select("protocol_id", "ord", "annotation_type", "annotation_text", F.col("table_number").alias("table_num"), F.col("annotation_marker").alias("marker"), "annotation_id")
    for df in _references(r, notes, sources, columns, properties, refs) if refs else []:
        full = full.join(kept(df, "references"), ["protocol_id", "ord"], "left")
    merged = merge.merge_equal(full, ["protocol_id"], text.norm_note(F.coalesce("annotation_text", F.lit(""))), "ord", ["annotation_type", "annotation_text"], list(refs), ["table_num", "marker", "annotation_id"])
    return kept(merged, "merged_notes")


def _references(r: Resolved, notes: DataFrame, sources: DataFrame, columns: DataFrame, properties: DataFrame | None, refs: tuple[str, ...]) -> list[DataFrame]:
    """protocol_id, ord and a list of each of refs."""
    key = ["protocol_id", "ord"]
    to_xact = sources.select(*KEY, "activity_id", "xact_id")
    to_xcol = columns.select(*KEY, "column_id", "xcol_id")
    used = r.edges.where(F.col("kind").isin([REFERENCES[x] for x in refs]))
    edges = kept(used.join(notes.select(*KEY, "annotation_id", "ord").hint("merge"), [*KEY, "annotation_id"]), "edges")
    of = lambda kind: edges.where(F.col("kind") == kind)
    lists = []
    if "referenced_xacts" in refs:
        direct = of("activity").join(to_xact.withColumnRenamed("activity_id", "element"), [*KEY, "element"]).select(*key, F.col("ordinal").alias("o"), "xact_id")
        places = notes.select(*KEY, "ord", F.posexplode("marker_locations").alias("o", "l")).where("l.location_type in ('activity_name', 'schedule_cell')")
        by_row = r.activities.groupBy(*KEY, "row_position").agg(F.max_by("activity_id", "pos").alias("activity_id"))
        located = places.select(*KEY, "ord", "o", F.col("l.row_position").alias("row_position")).join(by_row, [*KEY, "row_position"]).join(to_xact, [*KEY, "activity_id"])
        lists.append(_listed(xref.with_fallback(direct, located.select(*key, "o", "xact_id"), key), key, "xact_id", ["o"], "referenced_xacts"))
    if "referenced_xcols" in refs:
        lists.append(_listed(of("column").join(to_xcol.withColumnRenamed("column_id", "element"), [*KEY, "element"]), key, "xcol_id", ["ordinal"], "referenced_xcols"))
    if "referenced_props" in refs:
        to_prop = r.properties.withColumn("prop_key", property_key()).select(*KEY, F.col("property_id").alias("element"), "prop_key").join(properties.select("protocol_id", "prop_key", F.col("property_id").alias("target")), ["protocol_id", "prop_key"]).hint("merge")
        lists.append(_listed(of("property").join(to_prop, [*KEY, "element"]), key, "target", ["ordinal"], "referenced_props"))
    if "cell_references" in refs:
        pair = of("cell").withColumns({"activity_id": F.split_part("element", F.lit("|"), F.lit(1)), "column_id": F.split_part("element", F.lit("|"), F.lit(2))})
        pair = pair.join(to_xact, [*KEY, "activity_id"]).join(to_xcol, [*KEY, "column_id"]).withColumn("cell", F.concat_ws("|", "xact_id", "xcol_id"))
        lists.append(_listed(pair, key, "cell", ["ordinal"], "cell_references"))
    return lists


def notes_of(r: Resolved, sources: DataFrame, columns: DataFrame, properties: DataFrame | None = None, refs: tuple[str, ...] = tuple(REFERENCES)) -> DataFrame:
    """merged_notes() with their ids and markers."""
    merged = merged_notes(r, sources, columns, properties, refs)
    merged = ids.mint_in_order(merged, "xannot_id", "xannot", ["protocol_id"], [F.col("first_order")])
    occ = merged.select("protocol_id", "xannot_id", F.posexplode("occurrences").alias("at", "o")).select("protocol_id", "xannot_id", "at", "o.table_num", "o.marker")
    shown = merge.display_markers(occ, ["protocol_id", "xannot_id"], "marker", "table_num", "display_markers", order="at")
    annotations = merged.join(shown, ["protocol_id", "xannot_id"], "left").withColumnRenamed("occurrences", "source_occurrences").withColumnRenamed("n_occurrences", "occurrence_count")
    return kept(annotations, "notes")


def statistics(r: Resolved) -> DataFrame:
    """The counts of consolidate() alone, without what only its other tables take."""
    sources = entity_sources(r)
    return _stats(r, sources.select("protocol_id", "xact_id").distinct(), sources, merged_notes(r))


def _stats(r: Resolved, activities: DataFrame, sources: DataFrame, annotations: DataFrame) -> DataFrame:
    """Counts of matches, of what was folded, and of notes, by protocol."""
    matched = report.zero_filled(sources, ["protocol_id"], "match_status", STATUSES)
    n = activities.groupBy("protocol_id").agg(F.count(F.lit(1)).alias("unified_activity_count"))
    src = sources.groupBy("protocol_id").agg(F.count(F.lit(1)).alias("source_activity_count"))
    notes = r.annotations.groupBy("protocol_id").agg(F.count(F.lit(1)).alias("source_annotation_count"))
    kinds = annotations.groupBy("protocol_id", "annotation_type").agg(F.count(F.lit(1)).alias("k"))
    types = kinds.groupBy("protocol_id").agg(F.sum("k").alias("unified_annotation_count"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("annotation_type", "k")))).alias("by_type"))
    out = r.tables.select("protocol_id").distinct()
    for df in (matched, n, src, notes, types):
        out = out.join(df.hint("merge"), "protocol_id", "left")
    out = out.fillna(0)
    return out.withColumns({
        "compression_percent": report.percent_less(F.col("unified_activity_count"), F.col("source_activity_count")),
        "deduplication_percent": report.percent_less(F.col("unified_annotation_count"), F.col("source_annotation_count")),
    })


def source_tables(r: Resolved) -> DataFrame:
    """A row for each source table with its counts and its properties, those with a level first."""
    data = r.columns.groupBy(*KEY).agg(F.count_if(~F.col("is_label_column")).alias("data_columns"))
    ranked = report.level_first(r.properties.withColumn("property_type", F.coalesce("property_type", F.lit("other"))), KEY, "hierarchical_level", "property_type", "pos")
    props = ranked.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("rank", "hierarchical_level", "property_name", "property_type"))).alias("property_hierarchy"))
    return r.tables.join(data, KEY, "left").join(props, KEY, "left")
