"""From extraction documents to resolved tables: ids, filled merges, trees, columns, cross-references, findings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.functions import classify, text
from gridweave.operators import fill, hierarchy, ids, quality, xref

KEY = ["protocol_id", "table_number"]


@dataclass
class Resolved:
    """The resolved layer in long form; every table has the columns of KEY."""

    tables: DataFrame
    properties: DataFrame
    columns: DataFrame
    column_values: DataFrame
    activities: DataFrame
    cells: DataFrame
    annotations: DataFrame
    edges: DataFrame
    warnings: DataFrame

    def all(self) -> dict[str, DataFrame]:
        return dict(vars(self))


def _by_row(df: DataFrame, ident: str) -> DataFrame:
    """The id of each row position; of several the last counts."""
    return df.groupBy(*KEY, "row_position").agg(F.max_by(ident, "pos").alias(ident))


def resolve(docs: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = lambda df, _: df) -> Resolved:
    """docs: protocol_id, table_number, file, doc (see sources.documents). Everything is keyed and shuffled by KEY.

    Array positions are ranks of ids. Cells and header cells whose row has no activity or property are dropped. Documents that
    lack an array are left out of all tables but `tables`, where `errors` names it; see table_status(). keep (session.kept) writes what
    several tables are made of, for callers that use most of them: else each has all that it is made of in its plan.
    """
    docs = docs.select(*KEY, "file", F.col("doc.table_metadata").alias("meta"), *[F.col(f"doc.{a}").alias(a) for a in ("schedule_properties", "schedule_grid", "activities", "activity_schedule", "annotations")])
    parts = ["schedule_properties", "schedule_grid", "activities", "activity_schedule", "annotations"]
    lacks = F.filter(F.array(*[F.when(F.col(a).isNull(), F.lit(f"Missing required array: {a}")) for a in parts]), lambda e: e.isNotNull())
    docs = docs.withColumn("errors", lacks)
    good = docs.where(F.size("errors") == 0)

    props = ids.elements(good, "schedule_properties", KEY).withColumn("property_id", ids.mint("prop", F.col("pos")))
    props = keep(hierarchy.parent_previous(props, KEY, ["pos"], "hierarchical_level", "property_id", "parent_property_id"), "properties")
    acts = ids.elements(good, "activities", KEY).withColumn("activity_id", ids.mint("act", F.col("pos")))
    acts = acts.withColumn("hierarchy_level", F.coalesce("activity_name_source.indentation_level", F.lit(0)))
    acts = keep(hierarchy.parent_smaller(acts, KEY, ["pos"], "hierarchy_level", "activity_id", "parent_activity_id"), "activity_rows")
    grid = keep(fill.fill_merged(ids.elements(good, "schedule_grid", KEY), KEY, "merged_cell_range", "cell_value", ["pos"]), "grid")
    raw_cells = keep(ids.elements(good, "activity_schedule", KEY), "raw_cells")
    notes = keep(ids.elements(good, "annotations", KEY).withColumn("annotation_id", ids.mint("annot", F.col("pos"))), "note_rows")

    # columns
    col_id = ids.mint("col", F.col("column_position"))
    values = grid.join(_by_row(props, "property_id"), [*KEY, "row_position"]).select(
        *KEY, "pos", "column_position", col_id.alias("column_id"), "property_id", F.coalesce("cell_value", F.lit("")).alias("value"), F.coalesce("is_merged_cell", F.lit(False)).alias("is_merged"), "annotation_markers"
    )
    values = keep(values, "column_values")
    labels = values.where("value <> ''").groupBy(*KEY, "column_position").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]), " / ").alias("composite_label"))
    columns = grid.select(*KEY, "column_position").distinct().join(labels, [*KEY, "column_position"], "left").select(
        *KEY, col_id.alias("column_id"), "column_position", (F.col("column_position") == 1).alias("is_label_column"), F.coalesce("composite_label", F.lit("")).alias("composite_label")
    )
    columns = keep(columns, "columns")

    # cells and flags of activities
    cells = raw_cells.join(_by_row(acts, "activity_id"), [*KEY, "row_position"]).select(
        *KEY, "pos", "activity_id", col_id.alias("column_id"), "row_position", "column_position", F.coalesce("cell_value", F.lit("")).alias("cell_value"),
        classify.cell_kind(F.col("cell_value")).alias("cell_value_type"), F.coalesce("source_range", F.lit("")).alias("source_range"), "annotation_markers",
    )
    cells = keep(cells, "cells")
    data = raw_cells.where(~text.is_blank(F.col("cell_value"))).select(*KEY, "row_position", F.lit(True).alias("has_schedule_data")).distinct()
    parents = acts.where("parent_activity_id is not null").select(*KEY, F.col("parent_activity_id").alias("activity_id"), F.lit(True).alias("has_children")).distinct()
    acts = acts.join(data, [*KEY, "row_position"], "left").join(parents, [*KEY, "activity_id"], "left").fillna(False, ["has_schedule_data", "has_children"])
    acts = acts.withColumns({
        "is_section_header": hierarchy.section_header(F.col("hierarchy_level"), F.col("has_children"), F.col("has_schedule_data")),
        "is_redacted": classify.is_redacted(F.col("activity_name")),
    })
    acts = keep(acts, "activities")

    # cross-references: four kinds of elements by marker; only columns are made distinct
    marks = text.marker_list(F.col("annotation_markers"))
    pair = F.concat_ws("|", "activity_id", "column_id")
    refs = xref.references(props, KEY, F.col("property_id"), marks, "property", F.col("pos"))
    refs = refs.unionByName(xref.references(acts, KEY, F.col("activity_id"), marks, "activity", F.col("pos")))
    refs = refs.unionByName(xref.references(cells, KEY, pair, marks, "cell", F.col("pos")))
    refs = refs.unionByName(xref.references(grid, KEY, col_id, marks, "column", F.col("pos"), distinct=True))
    edges = xref.link(notes.select(*KEY, F.col("pos").alias("note_pos"), "annotation_id", F.col("annotation_marker").alias("marker")), refs, KEY)
    edges = keep(edges, "edges")
    flags = edges.groupBy(*KEY, "annotation_id").agg(*[F.bool_or(F.col("kind") == k).alias(f"_{k}") for k in ("property", "column", "activity", "cell")])
    notes = notes.join(flags, [*KEY, "annotation_id"], "left").fillna(False, ["_property", "_column", "_activity", "_cell"])
    notes = keep(notes, "notes")
    kind = classify.resolved_type(F.col("annotation_type"), F.col("annotation_text"))
    annotations = notes.select(
        *KEY, "pos", "annotation_id", "annotation_marker", kind.alias("annotation_type"),
        F.when(kind != F.col("annotation_type"), F.struct(F.lit("legend_pattern").alias("method"), F.col("annotation_type").alias("extracted_type"))).alias("annotation_type_source"),
        "annotation_text", classify.scope(F.col("_property"), F.col("_column"), F.col("_activity"), F.col("_cell")).alias("annotation_scope"), "marker_locations",
    )

    annotations = keep(annotations, "annotations")
    warnings = _warnings(props, acts, raw_cells, grid, notes, annotations)
    tables = docs.select(
        *KEY, "file", ids.mint("table", F.col("table_number")).alias("table_id"), F.coalesce("meta.table_type", F.lit("main_soa")).alias("table_type"), F.coalesce("meta.table_title", F.lit("")).alias("table_title"),
        F.coalesce("meta.table_purpose", F.lit("")).alias("table_purpose"), "meta.page_start", "meta.page_end", "meta.track_label", "errors",
        F.size("schedule_properties").alias("header_row_count"), F.size("activities").alias("activity_row_count"), F.size("annotations").alias("annotation_count"),
        F.greatest(F.coalesce(F.array_max(F.transform("schedule_properties", lambda p: p["row_position"])), F.lit(0)), F.coalesce(F.array_max(F.transform("activities", lambda a: a["row_position"])), F.lit(0)), F.lit(0)).alias("row_count"),
        F.size(F.array_distinct(F.transform("schedule_grid", lambda g: g["column_position"]))).alias("column_count"),
    )
    tables = keep(tables, "tables")
    return Resolved(tables, props, columns, values, acts, cells, annotations, edges, warnings)


def table_status(r: Resolved) -> DataFrame:
    """KEY, n_errors, n_warnings, status of every table."""
    n = r.warnings.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_warnings"))
    both = r.tables.select(*KEY, F.size("errors").alias("n_errors")).join(n, KEY, "left").fillna(0, ["n_warnings"])
    return both.withColumn("status", classify.status(F.col("n_errors"), F.col("n_warnings")))


def _warnings(props: DataFrame, acts: DataFrame, cells: DataFrame, grid: DataFrame, notes: DataFrame, annotations: DataFrame) -> DataFrame:
    """KEY, step, message of everything that looks wrong but stops nothing."""

    def say(df: DataFrame, step: str, message) -> DataFrame:
        return df.select(*KEY, F.lit(step).alias("step"), message.alias("message"))

    marks = text.marker_list(F.col("annotation_markers"))
    used = [df.select(*KEY, "row_position", F.explode(marks).alias("marker")) for df in (props, acts, cells, grid)]
    marked = used[0].unionByName(used[1]).unionByName(used[2]).unionByName(used[3])
    defined = notes.select(*KEY, F.col("annotation_marker").alias("marker"))
    lost = xref.undefined(marked, defined, [*KEY, "marker"]).groupBy(*KEY).agg(F.array_sort(F.collect_set("marker")).alias("m"))
    declared = notes.select(*KEY, F.col("annotation_marker").alias("marker"), F.explode("marker_locations").alias("l")).where("coalesce(l.location_type, '') <> 'unresolved'").select(*KEY, "marker", F.col("l.row_position").alias("row_position"))
    partial = quality.partial_bindings(declared, marked, [*KEY, "marker"], "row_position").groupBy(*KEY, "marker").agg(F.array_sort(F.collect_set("row_position")).alias("rows"))
    gaps = hierarchy.level_gaps(props, KEY, ["pos"], "hierarchical_level")
    no_place = notes.where(F.coalesce(F.size("marker_locations"), F.lit(0)) <= 0)
    orphans = annotations.where("annotation_scope = 'table'")
    near = notes.where("annotation_text_source.method = 'proximity_bounded'")
    loose = notes.select(*KEY, "annotation_marker", F.explode("marker_locations").alias("l")).where("l.method = 'proximity'")
    found = [
        say(props.where("coalesce(property_comment, '') = ''"), "empty_comment", F.format_string("Property row %d: empty property_comment", "row_position")),
        say(gaps, "level_gap", F.format_string("Property '%s' has no level but sits between L%d and L%d", "property_name", "prev_level", "next_level")),
        say(lost, "undefined_markers", F.concat(F.lit("Markers used but not defined: "), F.array_join("m", ", "))),
        say(no_place, "no_location", F.format_string("Annotation '%s' has no marker_locations", "annotation_marker")),
        say(partial, "partial_binding", F.concat(F.lit("Annotation '"), F.col("marker"), F.lit("' declares rows that do not carry it: "), F.array_join(F.transform("rows", lambda r: r.cast("string")), ", "))),
        say(near, "proximity_text", F.format_string("Annotation '%s' text is proximity-bounded", "annotation_marker")),
        say(loose, "proximity_scope", F.format_string("Annotation '%s' scope was bound by proximity", "annotation_marker")),
        say(orphans, "orphan", F.format_string("Annotation %s ('%s') refers to nothing", "annotation_id", "annotation_marker")),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def provenance(docs: DataFrame) -> DataFrame:
    """KEY, key, n: how often each non-default method is recorded, by kind of element."""
    kinds = [
        ("annotations", "annotation_text", "annotation_text_source.method"), ("activities", "activity_name", "activity_name_source.method"),
        ("activities", "indentation_level", "activity_name_source.indentation_method"), ("schedule_properties", "property_structure", "structure_method"),
        ("activity_schedule", "schedule_cell", "method"), ("schedule_grid", "grid_cell", "method"),
    ]
    out = None
    for array, name, field in kinds:
        part = docs.select(*KEY, F.explode(f"doc.{array}").alias("e")).where(F.coalesce(f"e.{field}", F.lit("")) != "").select(*KEY, F.concat(F.lit(f"{name}:"), F.col(f"e.{field}")).alias("key"))
        out = part if out is None else out.unionByName(part)
    places = docs.select(*KEY, F.explode("doc.annotations").alias("a")).select(*KEY, F.explode("a.marker_locations").alias("l"))
    out = out.unionByName(places.where("coalesce(l.method, '') <> ''").select(*KEY, F.concat(F.lit("marker_location:"), F.col("l.method")).alias("key")))
    out = out.unionByName(places.where("l.location_type = 'unresolved'").select(*KEY, F.lit("marker_location:unresolved").alias("key")))
    return out.groupBy(*KEY, "key").agg(F.count(F.lit(1)).alias("n"))


def linked_ids(edges: DataFrame, kind: str) -> DataFrame:
    """KEY, element, linked_annotation_ids in the order of the notes (repeats kept, as an element may carry a marker twice)."""
    return xref.collected(edges.where(F.col("kind") == kind), [*KEY, "element"], "annotation_id", ["note_pos", "ordinal"], "linked_annotation_ids")
