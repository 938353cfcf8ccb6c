"""The document pipeline over the payloads of raw_records: resolve, consolidate, validate, take stock."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.plans import consolidate, inventory, resolve, validate
from gridweave.plans.catalogue import _MARKERS, _NORM_NOTE, fold_sql
from gridweave.plans.problems import table
from gridweave.session import kept, kept_only
from gridweave.sources import documents


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    """The latest extraction of each table, parsed once."""
    return kept(documents.extractions_of_records(table(spark, sf, "raw_records")), "documents")


def resolved_tables(spark: SparkSession, sf: str) -> DataFrame:
    t = resolve.resolve(_docs(spark, sf)).tables
    return t.select("protocol_id", "table_number", "table_type", "header_row_count", "activity_row_count", "annotation_count", "row_count", "column_count")


def resolved_cells(spark: SparkSession, sf: str) -> DataFrame:
    c = resolve.resolve(_docs(spark, sf)).cells
    return c.select("protocol_id", "table_number", "pos", "activity_id", "column_id", "cell_value", "cell_value_type")


def resolved_activities(spark: SparkSession, sf: str) -> DataFrame:
    a = resolve.resolve(_docs(spark, sf)).activities
    return a.select("protocol_id", "table_number", "activity_id", "activity_name", "hierarchy_level", "parent_activity_id", "has_schedule_data", "has_children", "is_section_header", "is_redacted")


def resolved_properties(spark: SparkSession, sf: str) -> DataFrame:
    p = resolve.resolve(_docs(spark, sf)).properties
    return p.select("protocol_id", "table_number", "property_id", "property_name", "hierarchical_level", "parent_property_id")


def resolved_columns(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolve(_docs(spark, sf)).columns.select("protocol_id", "table_number", "column_id", "is_label_column", "composite_label")


def resolved_column_values(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolve(_docs(spark, sf)).column_values.select("protocol_id", "table_number", "pos", "column_id", "property_id", "value")


def resolved_annotations(spark: SparkSession, sf: str) -> DataFrame:
    n = resolve.resolve(_docs(spark, sf)).annotations
    return n.select("protocol_id", "table_number", "annotation_id", "annotation_marker", "annotation_type", "annotation_scope", F.col("annotation_type_source.extracted_type").alias("extracted_type"))


def resolved_links(spark: SparkSession, sf: str) -> DataFrame:
    e = resolve.resolve(_docs(spark, sf)).edges
    return e.select("protocol_id", "table_number", "annotation_id", "kind", "element")


def resolved_linked_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = resolve.linked_ids(resolve.resolve(_docs(spark, sf)).edges, "activity")
    return ids.select("protocol_id", "table_number", "element", F.array_join("linked_annotation_ids", ",").alias("note_ids"))


def resolved_warnings(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.resolve(_docs(spark, sf)).warnings


def resolved_status(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.table_status(resolve.resolve(_docs(spark, sf)))


def method_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """Methods as recorded in documents made of the delivered rows: their extraction methods as those of their names."""
    acts = table(spark, sf, "soa_activities").select(
        "protocol_id", "table_number", F.struct("row_position", "activity_name", "source_page", "annotation_markers", F.struct(F.col("extract_method").alias("method"), "indentation_level").alias("activity_name_source")).alias("a")
    )
    docs = acts.groupBy("protocol_id", "table_number").agg(F.to_json(F.struct(F.struct(F.first("table_number").alias("table_number")).alias("table_metadata"), F.collect_list("a").alias("activities"))).alias("text"))
    parsed = documents.parse_extractions(docs, "text", ["protocol_id", "table_number"])
    return resolve.provenance(parsed)


def _both(spark: SparkSession, sf: str) -> tuple[resolve.Resolved, consolidate.Consolidated]:
    r = resolve.resolve(_docs(spark, sf), kept)
    return r, consolidate.consolidate(r)


def consolidated_statistics(spark: SparkSession, sf: str) -> DataFrame:
    r = resolve.resolve(_docs(spark, sf), kept_only("activity_rows", "raw_cells", "activities", "note_rows", "tables"))
    return consolidate.statistics(r).drop("by_type")


def consolidated_sources(spark: SparkSession, sf: str) -> DataFrame:
    s = consolidate.entities(resolve.resolve(_docs(spark, sf)))[1]
    return s.select("protocol_id", "table_number", "activity_id", "xact_id", "match_status", F.round("match_confidence", 9).alias("match_confidence"))


def consolidated_activities(spark: SparkSession, sf: str) -> DataFrame:
    a = consolidate.entities(resolve.resolve(_docs(spark, sf)))[0]
    return a.select(
        "protocol_id", "xact_id", "activity_name", "parent_name", "parent_xact_id", "hierarchy_level", "display_order", "is_section_header", "is_redacted", "match_status", "table_count",
        F.size("source_refs").alias("n_sources"), F.array_join("name_variations", "|").alias("names"),
    )


def consolidated_columns(spark: SparkSession, sf: str) -> DataFrame:
    return consolidate.timeline(resolve.resolve(_docs(spark, sf)))[0].select("protocol_id", "table_number", "column_id", "xcol_id", "segment", "composite_label")


def consolidated_properties(spark: SparkSession, sf: str) -> DataFrame:
    return consolidate.timeline(resolve.resolve(_docs(spark, sf)))[1].select("protocol_id", "prop_key", "property_id", "property_type", "property_name", "hierarchical_level", "rank")


def review_queue(spark: SparkSession, sf: str) -> DataFrame:
    q = consolidate.review_queue(consolidate.entities(resolve.resolve(_docs(spark, sf)))[1])
    return q.select("protocol_id", "xact_id", F.round("confidence", 9).alias("confidence"), "existing_name", "new_name")


def consolidated_matrix(spark: SparkSession, sf: str) -> DataFrame:
    r = resolve.resolve(_docs(spark, sf))
    m = consolidate.schedule(r, consolidate.entities(r)[1], consolidate.timeline(r)[0])
    return m.select("protocol_id", "xact_id", "xcol_id", "consolidated_value")


def consolidated_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Of the references only those to activities and cells are shown, so only they are worked out."""
    r = resolve.resolve(_docs(spark, sf), kept_only("activity_rows", "grid", "raw_cells", "cells", "activities", "note_rows", "tables"))
    columns = kept(consolidate.timeline(r)[0].select(*resolve.KEY, "column_id", "xcol_id"), "columns")
    n = consolidate.notes_of(r, consolidate.entity_sources(r), columns, refs=("referenced_xacts", "cell_references"))
    return n.select("protocol_id", "xannot_id", "annotation_type", "display_markers", F.array_join("referenced_xacts", ",").alias("xacts"), F.size("cell_references").alias("n_cells"), "occurrence_count")


def consolidated_findings(spark: SparkSession, sf: str) -> DataFrame:
    r, c = _both(spark, sf)
    c.matrix = kept(c.matrix, "matrix")
    return validate.findings(c, r).groupBy("severity", "step").agg(F.count(F.lit(1)).alias("n"))


def activity_inventory(spark: SparkSession, sf: str) -> DataFrame:
    r = resolve.resolve(_docs(spark, sf))
    activities, sources = consolidate.entities(r)
    rows = inventory.entity_rows(activities, sources, inventory.source_rows(r))
    return rows.select("protocol_id", "xact_id", "activity_name", "display_order", "table_count", "any_marks", F.size("variants").alias("n_variants"), F.size("annotations").alias("n_notes"))


QUERIES = {
    f.__name__: f
    for f in (
        resolved_tables, resolved_cells, resolved_activities, resolved_properties, resolved_columns, resolved_column_values, resolved_annotations, resolved_links, resolved_linked_ids, resolved_warnings, resolved_status,
        method_provenance, consolidated_sources, consolidated_activities, consolidated_columns, consolidated_properties, review_queue, consolidated_statistics, consolidated_matrix, consolidated_notes, consolidated_findings,
        activity_inventory,
    )
}

_DOCS = """docs AS (SELECT protocol_id, (j->>'$.table_metadata.table_number')::INTEGER t, j FROM (SELECT protocol_id, record_id, payload::JSON j FROM raw_records WHERE record_kind = 'extraction' AND json_valid(payload))
  WHERE (j->'$.table_metadata') IS NOT NULL QUALIFY row_number() OVER (PARTITION BY protocol_id, t ORDER BY record_id DESC) = 1)"""

SQL = {
    "resolved_tables": f"""WITH {_DOCS} SELECT protocol_id, t table_number, j->>'$.table_metadata.table_type' table_type,
      CASE WHEN json_type(j, '$.schedule_properties') = 'ARRAY' THEN json_array_length(j, '$.schedule_properties')::INTEGER END header_row_count, json_array_length(j, '$.activities')::INTEGER activity_row_count,
      json_array_length(j, '$.annotations')::INTEGER annotation_count,
      greatest(coalesce(list_max(CASE WHEN json_type(j, '$.schedule_properties') = 'ARRAY' THEN (j->>'$.schedule_properties[*].row_position')::INTEGER[] END), 0), coalesce(list_max((j->>'$.activities[*].row_position')::INTEGER[]), 0), 0) row_count,
      len(list_distinct(j->>'$.schedule_grid[*].column_position'))::INTEGER column_count FROM docs""",
    "method_provenance": """SELECT protocol_id, table_number, 'activity_name:' || extract_method AS key, count(*) n FROM soa_activities WHERE coalesce(extract_method, '') <> '' GROUP BY 1, 2, 3""",
}

_ARRAYS = ("schedule_properties", "schedule_grid", "activities", "activity_schedule", "annotations")


def _list(name: str) -> str:
    """A CTE of the elements of an array of every whole document: protocol_id, t, pos, e."""
    return f"(SELECT protocol_id, t, unnest(range(1, len(x) + 1))::INTEGER pos, unnest(x) e FROM (SELECT protocol_id, t, json_extract(j, '$.{name}[*]') x FROM good))"


#: The resolved layer in DuckDB: one CTE for each of its tables.
_RESOLVED = f"""{_DOCS}, good AS (SELECT * FROM docs WHERE {" AND ".join(f"json_type(j, '$.{a}') = 'ARRAY'" for a in _ARRAYS)}),
 props0 AS (SELECT protocol_id, t, pos, format('prop-{{:03d}}', pos) property_id, e->>'$.property_name' property_name, (e->>'$.hierarchical_level')::INTEGER l, (e->>'$.row_position')::INTEGER row_position, e->>'$.property_comment' comment,
   coalesce(e->>'$.property_type', 'other') property_type, e->>'$.annotation_markers' m FROM {_list('schedule_properties')}),
 props AS (SELECT p.*, (SELECT max_by(q.property_id, q.pos) FROM props0 q WHERE q.protocol_id = p.protocol_id AND q.t = p.t AND q.pos < p.pos AND q.l = p.l - 1 AND p.l > 1) parent_property_id FROM props0 p),
 acts0 AS (SELECT protocol_id, t, pos, format('act-{{:03d}}', pos) activity_id, e->>'$.activity_name' activity_name, coalesce((e->>'$.activity_name_source.indentation_level')::INTEGER, 0) l, (e->>'$.row_position')::INTEGER row_position,
   e->>'$.annotation_markers' m FROM {_list('activities')}),
 cells0 AS (SELECT protocol_id, t, pos, (e->>'$.row_position')::INTEGER row_position, (e->>'$.column_position')::INTEGER column_position, e->>'$.cell_value' v, e->>'$.annotation_markers' m FROM {_list('activity_schedule')}),
 grid AS (SELECT protocol_id, t, pos, (e->>'$.row_position')::INTEGER row_position, (e->>'$.column_position')::INTEGER column_position, e->>'$.cell_value' v, e->>'$.annotation_markers' m FROM {_list('schedule_grid')}),
 notes AS (SELECT protocol_id, t, pos, format('annot-{{:03d}}', pos) annotation_id, e->>'$.annotation_marker' marker, e->>'$.annotation_type' kind, e->>'$.annotation_text' txt, e FROM {_list('annotations')}),
 acts1 AS (SELECT a.*, (SELECT max_by(q.activity_id, q.pos) FROM acts0 q WHERE q.protocol_id = a.protocol_id AND q.t = a.t AND q.pos < a.pos AND q.l < a.l) parent_activity_id,
   EXISTS (SELECT 1 FROM cells0 c WHERE c.protocol_id = a.protocol_id AND c.t = a.t AND c.row_position = a.row_position AND trim(coalesce(c.v, '')) <> '') has_data FROM acts0 a),
 acts AS (SELECT a.*, EXISTS (SELECT 1 FROM acts1 k WHERE k.protocol_id = a.protocol_id AND k.t = a.t AND k.parent_activity_id = a.activity_id) has_children FROM acts1 a),
 act_of AS (SELECT protocol_id, t, row_position, max_by(activity_id, pos) activity_id FROM acts0 GROUP BY ALL),
 prop_of AS (SELECT protocol_id, t, row_position, max_by(property_id, pos) property_id FROM props0 GROUP BY ALL),
 cells AS (SELECT c.*, activity_id, format('col-{{:03d}}', column_position) column_id FROM cells0 c JOIN act_of USING (protocol_id, t, row_position)),
 vals AS (SELECT g.*, property_id, format('col-{{:03d}}', column_position) column_id FROM grid g JOIN prop_of USING (protocol_id, t, row_position)),
 refs AS (SELECT protocol_id, t, 'property' kind, property_id element, pos ord, unnest({_MARKERS.format('m')}) marker FROM props UNION ALL SELECT protocol_id, t, 'activity', activity_id, pos, unnest({_MARKERS.format('m')}) FROM acts
   UNION ALL SELECT protocol_id, t, 'cell', activity_id || '|' || column_id, pos, unnest({_MARKERS.format('m')}) FROM cells
   UNION ALL SELECT DISTINCT protocol_id, t, 'column', format('col-{{:03d}}', column_position), 0, unnest({_MARKERS.format('m')}) FROM grid),
 edges AS (SELECT n.protocol_id, n.t, n.pos note_pos, annotation_id, r.kind, r.element, r.ord FROM notes n JOIN refs r ON r.protocol_id = n.protocol_id AND r.t = n.t AND r.marker = n.marker),
 scoped AS (SELECT n.*, bool_or(coalesce(x.kind = 'property', false)) p, bool_or(coalesce(x.kind = 'column', false)) c, bool_or(coalesce(x.kind = 'activity', false)) a, bool_or(coalesce(x.kind = 'cell', false)) z
   FROM notes n LEFT JOIN edges x ON x.protocol_id = n.protocol_id AND x.t = n.t AND x.annotation_id = n.annotation_id GROUP BY ALL),
 used AS (SELECT DISTINCT protocol_id, t, row_position, unnest({_MARKERS.format('m')}) marker FROM (SELECT protocol_id, t, row_position, m FROM props UNION ALL SELECT protocol_id, t, row_position, m FROM acts
   UNION ALL SELECT protocol_id, t, row_position, m FROM cells0 UNION ALL SELECT protocol_id, t, row_position, m FROM grid)),
 declared AS (SELECT DISTINCT protocol_id, t, marker, (l->>'$.row_position')::INTEGER row_position FROM (SELECT protocol_id, t, marker, unnest(json_extract(e, '$.marker_locations[*]')) l FROM notes) WHERE coalesce(l->>'$.location_type', '') <> 'unresolved'),
 legend AS (SELECT *, len(list_filter(string_split(txt, ';'), lambda s: regexp_matches(s, '^\\s*[A-Za-z][A-Za-z0-9()+/–\\-. ]{{0,30}}='))) nd, len(string_split(txt, ';')) ns FROM scoped),
 annotations AS (SELECT *, CASE WHEN kind NOT IN ('legend', 'abbreviation') AND (nd >= 2 OR (nd = 1 AND ns >= 2)) THEN 'legend' ELSE kind END resolved,
   CASE WHEN p::INTEGER + c::INTEGER + a::INTEGER + z::INTEGER = 0 THEN 'table' WHEN p::INTEGER + c::INTEGER + a::INTEGER + z::INTEGER > 1 THEN 'multiple' WHEN p THEN 'property' WHEN c THEN 'column' WHEN a THEN 'activity' ELSE 'cell' END AS scope FROM legend),
 gaps AS (SELECT * FROM (SELECT *, lag(l) OVER w a, lead(l) OVER w b FROM props WINDOW w AS (PARTITION BY protocol_id, t ORDER BY pos)) WHERE l IS NULL AND a IS NOT NULL AND b IS NOT NULL),
 warnings AS (SELECT protocol_id, t table_number, 'empty_comment' step, 'Property row ' || row_position || ': empty property_comment' AS message FROM props WHERE coalesce(comment, '') = ''
  UNION ALL SELECT protocol_id, t, 'level_gap', 'Property ''' || property_name || ''' has no level but sits between L' || a || ' and L' || b FROM gaps
  UNION ALL SELECT protocol_id, t, 'undefined_markers', 'Markers used but not defined: ' || string_agg(DISTINCT marker, ', ' ORDER BY marker) FROM used u WHERE NOT EXISTS (SELECT 1 FROM notes n WHERE n.protocol_id = u.protocol_id AND n.t = u.t AND n.marker = u.marker) GROUP BY 1, 2
  UNION ALL SELECT protocol_id, t, 'no_location', 'Annotation ''' || marker || ''' has no marker_locations' FROM notes WHERE coalesce(json_array_length(e, '$.marker_locations'), 0) = 0
  UNION ALL SELECT protocol_id, t, 'partial_binding', 'Annotation ''' || marker || ''' declares rows that do not carry it: ' || string_agg(row_position::VARCHAR, ', ' ORDER BY row_position) FROM declared d
    WHERE EXISTS (SELECT 1 FROM used u WHERE u.protocol_id = d.protocol_id AND u.t = d.t AND u.marker = d.marker) AND NOT EXISTS (SELECT 1 FROM used u WHERE u.protocol_id = d.protocol_id AND u.t = d.t AND u.marker = d.marker AND u.row_position = d.row_position) GROUP BY protocol_id, t, marker
  UNION ALL SELECT protocol_id, t, 'orphan', 'Annotation ' || annotation_id || ' (''' || marker || ''') refers to nothing' FROM annotations WHERE scope = 'table')"""

_KIND = """CASE WHEN trim(coalesce(v, '')) = '' THEN 'empty' WHEN u IN ('X', '✓', '✔', '•', '◆') THEN 'marker' WHEN u IN ('→', '...', '…') THEN 'continuation' WHEN contains(u, 'DAILY') OR contains(u, 'WEEKLY') OR contains(u, 'PRN') THEN 'frequency'
  WHEN contains(u, 'DAY') OR contains(u, 'WEEK') OR contains(u, 'HOUR') THEN 'timing_text' WHEN contains(u, 'IF') OR contains(u, 'OPTIONAL') THEN 'conditional' ELSE 'other' END"""
_HEADER = "l = 0 AND has_children AND NOT has_data"

#: The consolidated layer on top: entities by the fold, columns in the order of segments, the matrix.
_CONSOLIDATED = f"""{_RESOLVED}, kinds AS (SELECT protocol_id, t, coalesce(j->>'$.table_metadata.table_type', 'main_soa') table_type FROM docs),
 given AS (SELECT a.protocol_id, a.t table_number, a.t table_rank, table_type = 'main_soa' is_base, a.pos, coalesce(a.activity_name, '') AS name, coalesce(u.activity_name, '') parent, a.l = 0 AND a.has_children AND NOT a.has_data header
   FROM acts a JOIN kinds USING (protocol_id, t) LEFT JOIN acts0 u ON u.protocol_id = a.protocol_id AND u.t = a.t AND u.activity_id = a.parent_activity_id WHERE table_type <> 'reference'),
 {fold_sql('given')},
 sources AS (SELECT f.*, a.activity_id, a.activity_name, a.row_position, a.l, a.has_children, a.has_data, g.parent, g.is_base, row_number() OVER (PARTITION BY f.protocol_id ORDER BY NOT g.is_base, f.table_number, f.pos) turn
   FROM folded f JOIN acts a ON a.protocol_id = f.protocol_id AND a.t = f.table_number AND a.pos = f.pos JOIN given g ON g.protocol_id = f.protocol_id AND g.table_number = f.table_number AND g.pos = f.pos),
 entities0 AS (SELECT protocol_id, xact_id, ent, min_by(entity_name, turn) activity_name, min_by(entity_parent, turn) parent_name, min_by(l, turn) hierarchy_level, min_by({_HEADER}, turn) is_section_header,
   bool_or(regexp_full_match(trim(coalesce(activity_name, '')), 'CCI(\\s*\\(.*\\))?')) is_redacted, min_by(entity_status, turn) match_status, count(DISTINCT table_number)::INTEGER table_count, count(*)::INTEGER n_sources,
   list(activity_name ORDER BY turn) names, min({{'t': table_number, 'r': row_position}}) place FROM sources GROUP BY ALL),
 named AS (SELECT protocol_id, activity_name, min_by(xact_id, ent) up FROM entities0 GROUP BY ALL),
 ranked AS (SELECT e.*, n.up parent_xact_id, row_number() OVER (PARTITION BY e.protocol_id, n.up ORDER BY place, ent) r FROM entities0 e LEFT JOIN named n ON n.protocol_id = e.protocol_id AND n.activity_name = nullif(split_part(parent_name, ' / ', 1), '')),
 walk AS (SELECT protocol_id, xact_id, [r] path FROM ranked WHERE parent_xact_id IS NULL UNION ALL SELECT n.protocol_id, n.xact_id, list_append(w.path, n.r) FROM walk w JOIN ranked n ON n.protocol_id = w.protocol_id AND n.parent_xact_id = w.xact_id),
 numbered AS (SELECT protocol_id, xact_id, row_number() OVER (PARTITION BY protocol_id ORDER BY path)::INTEGER display_order FROM walk),
 entities AS (SELECT r.*, coalesce(display_order, 0) display_order FROM ranked r LEFT JOIN numbered USING (protocol_id, xact_id)),
 segments AS (SELECT * FROM (VALUES ('main_soa', 'main', 1), ('continuation', 'main', 2), ('domain', 'domain', 3), ('track', 'track', 4), ('subsidiary', 'subsidiary', 5)) s(table_type, segment, rank)),
 cols AS (SELECT DISTINCT protocol_id, t, column_position FROM grid),
 labels AS (SELECT protocol_id, t, column_position, string_agg(v, ' / ' ORDER BY pos) composite_label FROM vals WHERE coalesce(v, '') <> '' GROUP BY 1, 2, 3),
 xcols AS (SELECT protocol_id, t, column_position, format('col-{{:03d}}', column_position) column_id, segment, row_number() OVER (PARTITION BY protocol_id ORDER BY rank, t, column_position) n FROM cols JOIN kinds USING (protocol_id, t) JOIN segments USING (table_type) WHERE column_position <> 1),
 columns_ AS (SELECT x.*, format('xcol-{{:03d}}', n) xcol_id, coalesce(composite_label, '') composite_label FROM xcols x LEFT JOIN labels USING (protocol_id, t, column_position)),
 keyed AS (SELECT v.protocol_id, n, v.pos, p.*, coalesce(l::VARCHAR, 'q_' || property_type || '_' || coalesce(property_name, '')) prop_key FROM vals v JOIN columns_ x USING (protocol_id, t, column_position) JOIN (SELECT protocol_id pid, t tt, property_id, property_type, property_name, l FROM props) p
   ON p.pid = v.protocol_id AND p.tt = v.t AND p.property_id = v.property_id),
 properties AS (SELECT protocol_id, prop_key, unnest(min_by({{'property_id': property_id, 'property_type': property_type, 'property_name': property_name, 'hierarchical_level': l}}, {{'n': n, 'p': pos}})) FROM keyed GROUP BY 1, 2),
 matrix0 AS (SELECT s.protocol_id, s.xact_id, x.xcol_id, c.t, max_by(c.v, c.pos) v FROM cells c JOIN sources s ON s.protocol_id = c.protocol_id AND s.table_number = c.t AND s.activity_id = c.activity_id
   JOIN columns_ x ON x.protocol_id = c.protocol_id AND x.t = c.t AND x.column_position = c.column_position WHERE coalesce(c.v, '') <> '' GROUP BY ALL),
 matrix AS (SELECT protocol_id, xact_id, xcol_id, CASE WHEN count(DISTINCT v) = 1 THEN min(v) ELSE '[' || array_to_string(list_sort(list_distinct(list(v))), ', ') || ']' END consolidated_value FROM matrix0 GROUP BY 1, 2, 3)"""

SQL |= {
    "resolved_cells": f"WITH {_RESOLVED} SELECT protocol_id, t table_number, pos, activity_id, column_id, coalesce(v, '') cell_value, {_KIND} cell_value_type FROM (SELECT *, upper(trim(v)) u FROM cells)",
    "resolved_activities": f"WITH {_RESOLVED} SELECT protocol_id, t table_number, activity_id, activity_name, l hierarchy_level, parent_activity_id, has_data has_schedule_data, has_children, {_HEADER} is_section_header, "
    "coalesce(regexp_full_match(trim(activity_name), 'CCI(\\s*\\(.*\\))?'), false) is_redacted FROM acts",
    "resolved_properties": f"WITH {_RESOLVED} SELECT protocol_id, t table_number, property_id, property_name, l hierarchical_level, parent_property_id FROM props",
    "resolved_columns": f"WITH {_RESOLVED}, labels AS (SELECT protocol_id, t, column_position, string_agg(v, ' / ' ORDER BY pos) composite_label FROM vals WHERE coalesce(v, '') <> '' GROUP BY 1, 2, 3) "
    "SELECT protocol_id, t table_number, format('col-{:03d}', column_position) column_id, column_position = 1 is_label_column, coalesce(composite_label, '') composite_label FROM (SELECT DISTINCT protocol_id, t, column_position FROM grid) LEFT JOIN labels USING (protocol_id, t, column_position)",
    "resolved_column_values": f"WITH {_RESOLVED} SELECT protocol_id, t table_number, pos, column_id, property_id, coalesce(v, '') AS value FROM vals",
    "resolved_annotations": f"WITH {_RESOLVED} SELECT protocol_id, t table_number, annotation_id, marker annotation_marker, resolved annotation_type, scope annotation_scope, CASE WHEN resolved <> kind THEN kind END extracted_type FROM annotations",
    "resolved_links": f"WITH {_RESOLVED} SELECT protocol_id, t table_number, annotation_id, kind, element FROM edges",
    "resolved_linked_ids": f"WITH {_RESOLVED} SELECT protocol_id, t table_number, element, string_agg(annotation_id, ',' ORDER BY note_pos, ord) note_ids FROM edges WHERE kind = 'activity' GROUP BY 1, 2, 3",
    "resolved_warnings": f"WITH {_RESOLVED} SELECT * FROM warnings",
    "resolved_status": f"""WITH {_RESOLVED}, n AS (SELECT protocol_id, table_number, count(*) n FROM warnings GROUP BY 1, 2),
      e AS (SELECT protocol_id, t table_number, {" + ".join(f"(coalesce(json_type(j, '$.{a}'), '') <> 'ARRAY')::INTEGER" for a in _ARRAYS)} n_errors FROM docs)
      SELECT protocol_id, table_number, n_errors, coalesce(n, 0)::BIGINT n_warnings, CASE WHEN n_errors > 0 THEN 'failed' WHEN n > 0 THEN 'resolved_with_warnings' ELSE 'resolved' END status FROM e LEFT JOIN n USING (protocol_id, table_number)""",
    "consolidated_sources": f"WITH RECURSIVE {_CONSOLIDATED} SELECT protocol_id, table_number, activity_id, xact_id, match_status, round(match_confidence, 9) match_confidence FROM sources",
    "consolidated_activities": f"WITH RECURSIVE {_CONSOLIDATED} SELECT protocol_id, xact_id, activity_name, parent_name, parent_xact_id, hierarchy_level, display_order, is_section_header, is_redacted, match_status, table_count, n_sources, "
    "array_to_string(list_transform(list_filter(list_transform(names, lambda x, i: {'x': x, 'i': i}), lambda y: list_position(names, y.x) = y.i), lambda y: y.x), '|') AS names FROM entities",
    "consolidated_columns": f"WITH RECURSIVE {_CONSOLIDATED} SELECT protocol_id, t table_number, column_id, xcol_id, segment, composite_label FROM columns_",
    "consolidated_properties": f"WITH RECURSIVE {_CONSOLIDATED} SELECT *, row_number() OVER (PARTITION BY protocol_id ORDER BY hierarchical_level NULLS LAST, prop_key)::INTEGER AS rank FROM properties",
    "review_queue": f"WITH RECURSIVE {_CONSOLIDATED} SELECT protocol_id, xact_id, round(match_confidence, 9) confidence, entity_name existing_name, activity_name new_name FROM sources WHERE match_status = 'fuzzy_review'",
    "consolidated_matrix": f"WITH RECURSIVE {_CONSOLIDATED} SELECT * FROM matrix",
    "consolidated_statistics": f"""WITH RECURSIVE {_CONSOLIDATED}, s AS (SELECT protocol_id, {", ".join(f"count(*) FILTER (match_status = '{k}') n_{k}" for k in consolidate.STATUSES)}, count(*) n FROM sources GROUP BY 1),
      e AS (SELECT protocol_id, count(*) n FROM entities GROUP BY 1), a AS (SELECT protocol_id, count(*) n, count(DISTINCT {_NORM_NOTE.format("coalesce(txt, '')")}) u FROM annotations GROUP BY 1), p AS (SELECT DISTINCT protocol_id FROM docs)
      SELECT protocol_id, {", ".join(f"coalesce(n_{k}, 0) n_{k}" for k in consolidate.STATUSES)}, coalesce(e.n, 0) unified_activity_count, coalesce(s.n, 0) source_activity_count, coalesce(a.n, 0) source_annotation_count, coalesce(u, 0) unified_annotation_count,
       CASE WHEN s.n > 0 THEN round_even((1 - e.n / s.n) * 100, 0)::INTEGER ELSE 0 END compression_percent, CASE WHEN a.n > 0 THEN round_even((1 - u / a.n) * 100, 0)::INTEGER ELSE 0 END deduplication_percent
      FROM p LEFT JOIN s USING (protocol_id) LEFT JOIN e USING (protocol_id) LEFT JOIN a USING (protocol_id)""",
    "activity_inventory": f"""WITH RECURSIVE {_CONSOLIDATED}, n AS (SELECT s.protocol_id, s.xact_id, count(DISTINCT a.txt) n FROM sources s JOIN edges e ON e.protocol_id = s.protocol_id AND e.t = s.table_number AND e.kind = 'activity' AND e.element = s.activity_id
       JOIN annotations a ON a.protocol_id = e.protocol_id AND a.t = e.t AND a.annotation_id = e.annotation_id WHERE resolved <> 'legend' GROUP BY 1, 2),
      o AS (SELECT protocol_id, xact_id, count(*)::INTEGER table_count, bool_or(has_data) any_marks, count(DISTINCT nullif(activity_name, ''))::INTEGER n_variants FROM sources GROUP BY 1, 2)
      SELECT e.protocol_id, e.xact_id, activity_name, display_order, o.table_count, any_marks, n_variants, n::INTEGER n_notes FROM entities e JOIN o USING (protocol_id, xact_id) LEFT JOIN n USING (protocol_id, xact_id)""",
    "consolidated_notes": f"""WITH RECURSIVE {_CONSOLIDATED}, o AS (SELECT *, row_number() OVER (PARTITION BY protocol_id ORDER BY t, pos) ord, {_NORM_NOTE.format("coalesce(txt, '')")} k FROM annotations),
      direct AS (SELECT o.protocol_id, o.ord, e.ord i, xact_id FROM o JOIN edges e ON e.protocol_id = o.protocol_id AND e.t = o.t AND e.annotation_id = o.annotation_id AND e.kind = 'activity' JOIN sources s ON s.protocol_id = e.protocol_id AND s.table_number = e.t AND s.activity_id = e.element),
      placed AS (SELECT protocol_id, t, ord, unnest(json_extract(e, '$.marker_locations[*]')) l, unnest(range(json_array_length(e, '$.marker_locations')::BIGINT)) i FROM o),
      located AS (SELECT p.protocol_id, ord, i, xact_id FROM placed p JOIN act_of a ON a.protocol_id = p.protocol_id AND a.t = p.t AND a.row_position = (p.l->>'$.row_position')::INTEGER JOIN sources s ON s.protocol_id = p.protocol_id AND s.table_number = p.t AND s.activity_id = a.activity_id
        WHERE p.l->>'$.location_type' IN ('activity_name', 'schedule_cell')),
      bound AS (SELECT * FROM direct UNION ALL SELECT * FROM located l WHERE NOT EXISTS (SELECT 1 FROM direct d WHERE d.protocol_id = l.protocol_id AND d.ord = l.ord)),
      pairs AS (SELECT o.protocol_id, o.k, s.xact_id || '|' || x.xcol_id c FROM o JOIN edges e ON e.protocol_id = o.protocol_id AND e.t = o.t AND e.annotation_id = o.annotation_id AND e.kind = 'cell'
        JOIN sources s ON s.protocol_id = e.protocol_id AND s.table_number = e.t AND s.activity_id = split_part(e.element, '|', 1) JOIN columns_ x ON x.protocol_id = e.protocol_id AND x.t = e.t AND x.column_id = split_part(e.element, '|', 2)),
      merged AS (SELECT protocol_id, k, min(ord) f, min_by(resolved, ord) annotation_type, count(*) occurrence_count FROM o GROUP BY 1, 2),
      each AS (SELECT o.protocol_id, o.k, b.xact_id, min({{'o': o.ord, 'i': b.i}}) first_at FROM o JOIN bound b ON b.protocol_id = o.protocol_id AND b.ord = o.ord GROUP BY 1, 2, 3),
      lists AS (SELECT protocol_id, k, string_agg(xact_id, ',' ORDER BY first_at) xacts FROM each GROUP BY 1, 2),
      ncell AS (SELECT protocol_id, k, count(DISTINCT c) n FROM pairs GROUP BY 1, 2),
      per AS (SELECT protocol_id, k, marker, min(ord) seen, min(t) lo, max(t) hi, count(*) n, count(DISTINCT t) nd, string_agg(t::VARCHAR, ',' ORDER BY t) l FROM o GROUP BY 1, 2, 3),
      shown AS (SELECT protocol_id, k, string_agg('T' || CASE WHEN n = 1 THEN lo::VARCHAR WHEN nd = n AND hi - lo + 1 = n THEN lo || '-' || hi ELSE l END || ':' || marker, ', ' ORDER BY lo, seen) display_markers FROM per GROUP BY 1, 2)
      SELECT protocol_id, format('xannot-{{:03d}}', row_number() OVER (PARTITION BY protocol_id ORDER BY f)) xannot_id, annotation_type, display_markers, coalesce(xacts, '') xacts, coalesce(n, 0)::INTEGER n_cells, occurrence_count
      FROM merged LEFT JOIN lists USING (protocol_id, k) LEFT JOIN ncell USING (protocol_id, k) LEFT JOIN shown USING (protocol_id, k)""",
}
