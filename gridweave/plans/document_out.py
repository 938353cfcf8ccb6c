"""Resolved and consolidated tables back to JSON documents, one for each table and one for each protocol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.operators import hierarchy, xref
from gridweave.plans import consolidate, resolve
from gridweave.plans.resolve import KEY
from gridweave.session import kept
from gridweave.sources.sinks import to_document

#: Names and versions of the documents, and the segments of a timeline.
RESOLVED, CONSOLIDATED, EXTRACTION = ("soa-table-resolved", "1.0"), ("soa-tables-consolidated", "1.1"), ("soa-table-extraction", "1.0")
SEGMENTS = ["main", "domain", "track", "subsidiary"]


def _list(df: DataFrame, key: list[str], order: list[str], fields: list[Column], name: str, keep_null: tuple[str, ...] = ()) -> DataFrame:
    """key and the JSON array of the rows of each key, in order. Fields that are null are left out but for keep_null."""
    rows = df.select(*key, F.struct(*order).alias("_o"), to_document(F.struct(*fields), list(keep_null)).alias("_j"))
    sorted_ = F.sort_array(F.collect_list(F.struct("_o", "_j")))
    return rows.groupBy(*key).agg(F.concat(F.lit("["), F.array_join(F.transform(sorted_, lambda x: x["_j"]), ","), F.lit("]")).alias(name))


def _object(parts: list[tuple[str, Column]]) -> Column:
    """JSON object of fields whose values are JSON already; a null value is an empty list."""
    pairs = [F.concat(F.lit(f'"{k}":'), F.coalesce(v, F.lit("[]"))) for k, v in parts]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def _text(value: Column) -> Column:
    """A string as JSON; null as null."""
    quoted = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNull(), F.lit("null")).otherwise(F.substring(quoted, F.lit(6), F.length(quoted) - 6))


def _empty(column: str, kind: str = "array<string>") -> Column:
    return F.coalesce(F.col(column), F.array().cast(kind)).alias(column)


def _blank(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")).alias(column)


def resolved_documents(docs: DataFrame, r: resolve.Resolved, made_at: Column | None = None) -> DataFrame:
    """protocol_id, table_number, name, text: the resolved document of every table that has all its arrays.

    docs: as resolve() takes them. Fields that only exceptions have (is_redacted, annotation_type_source, method_provenance) are left out
    elsewhere; levels and parents that are not there stand as null."""
    made_at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX") if made_at is None else made_at
    table = r.tables.where(F.size("errors") == 0).select(*KEY, "table_id")
    linked = {k: resolve.linked_ids(r.edges, k).withColumnRenamed("element", "_id") for k in ("property", "activity", "column", "cell")}

    def with_links(df: DataFrame, kind: str, ident: Column) -> DataFrame:
        return df.withColumn("_id", ident).join(linked[kind], [*KEY, "_id"], "left").join(table, KEY)

    def with_children(df: DataFrame, parent: str, ident: str, name: str) -> DataFrame:
        kids = hierarchy.children(df, KEY, parent, ident, ["pos"]).withColumnsRenamed({parent: ident, "child_ids": name})
        return df.join(kids, [*KEY, ident], "left")

    props = with_links(with_children(r.properties, "parent_property_id", "property_id", "child_property_ids"), "property", F.col("property_id"))
    leveled = F.col("hierarchical_level").isNotNull()
    props = _list(props, KEY, ["pos"], [
        F.col("property_id"), F.col("table_id"), F.col("row_position"), F.col("property_name"), F.col("property_name_source"), F.coalesce("property_type", F.lit("other")).alias("property_type"), _blank("property_comment"),
        F.col("hierarchical_level"), F.when(leveled, F.col("parent_property_id")).alias("parent_property_id"), F.coalesce(F.when(leveled, F.col("child_property_ids")), F.array().cast("array<string>")).alias("child_property_ids"),
        _blank("annotation_markers"), _empty("linked_annotation_ids"),
    ], "schedule_properties", ("property_name_source", "hierarchical_level", "parent_property_id"))
    values = r.column_values.groupBy(*KEY, "column_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "property_id", "value", "is_merged", F.coalesce("annotation_markers", F.lit("")).alias("annotation_markers")))), lambda v: v.dropFields("pos")).alias("column_values"))
    kind = "array<struct<property_id:string,value:string,is_merged:boolean,annotation_markers:string>>"
    columns = with_links(r.columns.join(values, [*KEY, "column_id"], "left"), "column", F.col("column_id"))
    columns = _list(columns, KEY, ["column_position"], [F.col("column_id"), F.col("table_id"), F.col("column_position"), F.col("is_label_column"), _empty("column_values", kind), F.col("composite_label"), _empty("linked_annotation_ids")], "schedule_columns")
    acts = with_links(with_children(r.activities, "parent_activity_id", "activity_id", "child_activity_ids"), "activity", F.col("activity_id"))
    acts = _list(acts, KEY, ["pos"], [
        F.col("activity_id"), F.col("table_id"), F.col("row_position"), F.col("activity_name"), F.col("activity_name_source"), F.when(F.col("is_redacted"), True).alias("is_redacted"), F.col("hierarchy_level"), F.col("is_section_header"),
        F.col("parent_activity_id"), _empty("child_activity_ids"), F.col("has_schedule_data"), _blank("annotation_markers"), _empty("linked_annotation_ids"),
    ], "activities", ("parent_activity_id",))
    cells = _list(with_links(r.cells, "cell", F.concat_ws("|", "activity_id", "column_id")), KEY, ["pos"], [
        *map(F.col, ("activity_id", "column_id", "row_position", "column_position", "cell_value", "cell_value_type", "source_range")), _blank("annotation_markers"), _empty("linked_annotation_ids"),
    ], "activity_schedule")
    of = {k: xref.collected(r.edges.where(F.col("kind") == k), [*KEY, "annotation_id"], "element", ["ordinal", "element"], k) for k in ("property", "column", "activity", "cell")}
    notes = r.annotations.join(table, KEY)
    for df in of.values():
        notes = notes.join(df.hint("merge"), [*KEY, "annotation_id"], "left")
    pair = F.transform(F.coalesce("cell", F.array().cast("array<string>")), lambda x: F.struct(F.split_part(x, F.lit("|"), F.lit(1)).alias("activity_id"), F.split_part(x, F.lit("|"), F.lit(2)).alias("column_id")))
    none = F.array().cast("array<string>")
    notes = _list(notes, KEY, ["pos"], [
        *map(F.col, ("annotation_id", "table_id", "annotation_marker", "annotation_type", "annotation_type_source", "annotation_text", "annotation_scope")),
        F.struct(F.coalesce("property", none).alias("property_ids"), F.coalesce("column", none).alias("column_ids"), F.coalesce("activity", none).alias("activity_ids"), pair.alias("cell_references")).alias("referenced_elements"),
        F.coalesce("marker_locations", F.array().cast(dict(r.annotations.dtypes)["marker_locations"])).alias("marker_locations"),
    ], "annotations")
    said = r.warnings.groupBy(*KEY).agg(F.array_sort(F.collect_list("message")).alias("validation_warnings"))
    how = resolve.provenance(docs).groupBy(*KEY).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "n")))).alias("method_provenance"))
    head = docs.select(*KEY, F.col("doc.extraction_metadata").alias("em"), F.col("doc.schema_name").alias("sn"), F.col("doc.schema_version").alias("sv"), F.coalesce("doc.table_metadata.notes", F.lit("")).alias("table_notes"))
    out = r.tables.where(F.size("errors") == 0).join(head, KEY).join(resolve.table_status(r).select(*KEY, "status").hint("merge"), KEY)
    for df in (said, how, props, columns, acts, cells, notes):
        out = out.join(kept(df, "lists"), KEY, "left")
    meta = F.struct(
        *map(F.col, ("table_id", "table_number", "table_type", "table_title", "table_purpose", "page_start", "page_end", "track_label", "column_count", "row_count", "header_row_count", "activity_row_count")), F.col("table_notes").alias("notes")
    )
    source = F.struct(F.coalesce("sn", F.lit(EXTRACTION[0])).alias("schema_name"), F.coalesce("sv", F.lit(EXTRACTION[1])).alias("schema_version"), F.element_at(F.split("file", "/"), -1).alias("extraction_file"), F.coalesce("em.extraction_status", F.lit("unknown")).alias("extraction_status"))
    checks = F.struct(F.lit(True).alias("structure_valid"), F.lit(True).alias("hierarchy_valid"), F.lit(True).alias("annotations_valid"), _empty("validation_warnings"), F.array().cast("array<string>").alias("validation_errors"), F.col("method_provenance"))
    resolution = F.struct(made_at.alias("resolved_at"), F.lit("gridweave").alias("resolver"), source.alias("source_extraction"), checks.alias("validation_results"), F.col("status").alias("resolution_status"), F.lit(True).alias("ready_for_integration"), F.lit("").alias("resolution_notes"))
    text = _object([
        ("schema_name", F.lit(f'"{RESOLVED[0]}"')), ("schema_version", F.lit(f'"{RESOLVED[1]}"')), ("resolution_metadata", to_document(resolution, [])), ("extraction_metadata", F.coalesce(F.to_json("em"), F.lit("{}"))),
        ("table_metadata", to_document(meta, ["track_label"])), *[(a, F.col(a)) for a in ("schedule_properties", "schedule_columns", "activities", "activity_schedule", "annotations")],
    ])
    name = F.concat_ws("_", "protocol_id", F.lit("Table"), F.format_string("%02d", "table_number"), F.lit("resolved.json"))
    return out.select(*KEY, name.alias("name"), text.alias("text"))


def consolidated_documents(r: resolve.Resolved, c: consolidate.Consolidated, made_at: Column | None = None) -> DataFrame:
    """protocol_id, name, text: the consolidated document of every protocol. The caller leaves out protocols whose checks failed."""
    made_at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX") if made_at is None else made_at
    key = ["protocol_id"]
    acts = _list(c.activities, key, ["display_order", "xact_id"], [
        *map(F.col, ("xact_id", "activity_name", "parent_name", "parent_xact_id", "hierarchy_level", "display_order", "qualified_key", "is_section_header")), F.when(F.col("is_redacted"), True).alias("is_redacted"),
        *map(F.col, ("source_refs", "name_variations", "match_status", "match_confidence", "table_count")),
    ], "unified_activities", ("parent_xact_id",))
    levels = r.properties.select(*KEY, "property_id", F.coalesce("property_type", F.lit("other")).alias("property_type"), "property_name", "hierarchical_level")
    shown = r.column_values.join(levels, [*KEY, "property_id"]).select(*KEY, "column_id", F.struct("pos").alias("_o"), to_document(F.struct(F.col("hierarchical_level").alias("level"), "property_type", "property_name", "value"), ["level"]).alias("_j"))
    shown = shown.groupBy(*KEY, "column_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_o", "_j"))), lambda x: x["_j"]), ",").alias("_values"))
    column = F.struct("xcol_id", "composite_label", "segment", "population_track", F.array(F.struct("table_id", F.col("table_number").alias("table_num"), "column_id", "column_position")).alias("source_columns"))
    body = to_document(column, ["population_track"])
    cols = c.columns.join(shown, [*KEY, "column_id"], "left").select("protocol_id", "segment", "xcol", F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(',"property_values":['), _blank("_values"), F.lit("]}")).alias("_j"))
    parts = cols.groupBy("protocol_id").agg(*[F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("segment") == s, F.struct("xcol", "_j")))), lambda x: x["_j"]), ",").alias(s) for s in SEGMENTS])
    segments = parts.select("protocol_id", _object([(s, F.concat(F.lit("["), F.col(s), F.lit("]"))) for s in SEGMENTS]).alias("timeline_segments"))
    matrix = _list(c.matrix, key, ["xact_id", "xcol_id"], [*map(F.col, ("xact_id", "xcol_id", "consolidated_value", "source_values"))], "schedule_matrix")
    pair = F.transform("cell_references", lambda x: F.struct(F.split_part(x, F.lit("|"), F.lit(1)).alias("xact_id"), F.split_part(x, F.lit("|"), F.lit(2)).alias("xcol_id")))
    notes = _list(c.annotations, key, ["first_order"], [
        *map(F.col, ("xannot_id", "annotation_type", "annotation_text", "display_markers", "source_occurrences", "referenced_xacts", "referenced_xcols", "referenced_props")), pair.alias("cell_references"), F.col("occurrence_count"),
    ], "unified_annotations")
    queue = _list(c.review_queue, key, ["xact_id", "new_name"], [*map(F.col, ("xact_id", "confidence", "existing_name", "new_name"))], "review_queue")
    props = _list(c.properties, key, ["rank"], [*map(F.col, ("property_id", "property_type", "property_name", "hierarchical_level", "property_comment"))], "property_hierarchy", ("hierarchical_level",))
    tables = consolidate.source_tables(r)
    hierarchy_ = F.transform("property_hierarchy", lambda p: F.struct(p["hierarchical_level"].alias("level"), p["property_name"].alias("property_name"), p["property_type"].alias("property_type")))
    tables = _list(tables, key, ["table_number"], [
        F.col("table_id"), F.col("table_number").alias("table_num"), *map(F.col, ("table_type", "table_title", "table_purpose", "track_label")), F.coalesce("activity_row_count", F.lit(0)).alias("activity_count"),
        F.coalesce("data_columns", F.lit(0)).alias("column_count"), F.coalesce("annotation_count", F.lit(0)).alias("annotation_count"), hierarchy_.alias("property_hierarchy"),
    ], "source_tables", ("track_label",))
    out = c.stats
    for df in (acts, segments, matrix, notes, queue, props, tables):
        out = out.join(kept(df, "lists"), key, "left")
    counts = F.struct(*[F.col(f"n_{s}").alias(s) for s in consolidate.STATUSES])
    annotation = F.struct("source_annotation_count", "unified_annotation_count", "deduplication_percent", "by_type")
    meta = _object([
        ("consolidated_at", _text(made_at)), ("consolidator", F.lit('"gridweave"')), ("source_tables", F.col("source_tables")), ("match_stats", F.to_json(counts)), ("source_activity_count", F.col("source_activity_count").cast("string")),
        ("unified_activity_count", F.col("unified_activity_count").cast("string")), ("compression_percent", F.col("compression_percent").cast("string")), ("annotation_stats", F.to_json(annotation)),
    ])
    empty = F.lit("{" + ",".join(f'"{s}":[]' for s in SEGMENTS) + "}")
    text = _object([
        ("schema_name", F.lit(f'"{CONSOLIDATED[0]}"')), ("schema_version", F.lit(f'"{CONSOLIDATED[1]}"')), ("protocol_id", _text(F.col("protocol_id"))), ("consolidation_metadata", meta), ("property_hierarchy", F.col("property_hierarchy")),
        ("review_queue", F.col("review_queue")), ("unified_activities", F.col("unified_activities")), ("timeline_segments", F.coalesce("timeline_segments", empty)), ("schedule_matrix", F.col("schedule_matrix")), ("unified_annotations", F.col("unified_annotations")),
    ])
    return out.select("protocol_id", F.concat_ws("_", "protocol_id", F.lit("consolidated.json")).alias("name"), text.alias("text"))


#: The fields that a consolidated document must have.
REQUIRED = ["schema_name", "schema_version", "protocol_id", "consolidation_metadata", "unified_activities", "timeline_segments", "schedule_matrix", "unified_annotations"]


def structure_findings(documents: DataFrame, ident: str, text: str) -> DataFrame:
    """ident, severity, step, subject of consolidated documents given as text: what is no JSON object, lacks a required field, has
    another schema name, or names a segment that there is none of."""
    top = documents.select(ident, F.from_json(F.col(text), "map<string,string>").alias("m"), F.json_object_keys(F.get_json_object(text, "$.timeline_segments")).alias("segments"))
    found = [
        F.when(F.col("m").isNull(), F.array(F.struct(F.lit("error").alias("severity"), F.lit("no_document").alias("step"), F.lit("").alias("subject")))),
        F.transform(F.filter(F.array(*[F.lit(f) for f in REQUIRED]), lambda f: F.col("m").isNotNull() & ~F.array_contains(F.map_keys("m"), f)), lambda f: F.struct(F.lit("error").alias("severity"), F.lit("missing_field").alias("step"), f.alias("subject"))),
        F.when(F.col("m")["schema_name"] != CONSOLIDATED[0], F.array(F.struct(F.lit("error").alias("severity"), F.lit("schema_name").alias("step"), F.col("m")["schema_name"].alias("subject")))),
        F.transform(F.filter("segments", lambda s: ~s.isin(SEGMENTS)), lambda s: F.struct(F.lit("warning").alias("severity"), F.lit("unknown_segment").alias("step"), s.alias("subject"))),
    ]
    return top.select(ident, F.explode(F.flatten(F.filter(F.array(*found), lambda x: x.isNotNull()))).alias("f")).select(ident, "f.*")
