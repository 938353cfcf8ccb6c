"""The queries p1, p3 and p4, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions.markers import DISPLAY_CHARS, MARKER_CHARS, values_of
from gridweave.operators import nested, orphans, packed

CHILDREN = [
    nested.Child("property_name_source", "schedule_properties", "property_name_source", "row_position"),
    nested.Child("source_occurrences", "unified_annotations", "source_occurrences", "table_num"),
    nested.Child("referenced_xacts", "unified_annotations", "referenced_xacts", None),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _marked(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that carry annotation_markers, of both tables."""
    cols = ["protocol_id", "table_number", "annotation_markers", "loaded_at"]
    acts = table(spark, sf, "soa_activities").select(F.lit("soa_activities").alias("src_table"), F.col("row_id").alias("src_id"), *cols)
    cells = table(spark, sf, "schedule_cells").select(F.lit("schedule_cells").alias("src_table"), F.col("cell_id").alias("src_id"), *cols)
    return acts.unionByName(cells).where("annotation_markers is not null")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    month = F.date_format("loaded_at", "yyyy-MM")
    keys = F.explode(F.array_distinct(values_of(F.col("annotation_markers"), MARKER_CHARS)))
    notes = _marked(spark, sf).select(
        "src_table", month.alias("ref_month"), "src_id", F.lit("note").alias("rel"), "protocol_id", "table_number", keys.alias("ref_key"), "loaded_at"
    )
    acts = table(spark, sf, "unified_annotations").select(
        F.lit("unified_annotations").alias("src_table"), month.alias("ref_month"), F.col("ann_key").alias("src_id"), F.lit("act").alias("rel"),
        "protocol_id", F.lit(0).alias("table_number"), F.explode(F.array_distinct("referenced_xacts")).alias("ref_key"), "loaded_at",
    ).where("ref_key is not null")
    parents = table(spark, sf, "soa_annotations").select(
        F.lit("note").alias("rel"), "protocol_id", "table_number", F.col("annotation_marker").alias("ref_key"), "loaded_at", "deleted_at"
    ).unionByName(table(spark, sf, "unified_activities").select(
        F.lit("act").alias("rel"), "protocol_id", F.lit(0).alias("table_number"), F.col("xact_id").alias("ref_key"), "loaded_at", "deleted_at"
    ))
    keep = ["src_table", "ref_month", "src_id", "ref_key"]
    return orphans.find_orphans(notes.unionByName(acts), parents, ["rel", "protocol_id", "table_number", "ref_key"], "loaded_at", "loaded_at", "deleted_at", keep)


def p1_report(spark: SparkSession, sf: str) -> DataFrame:
    return orphans.report(p1_found(spark, sf), ["src_table", "ref_month"])


def _routed(spark: SparkSession, sf: str) -> nested.Variants:
    return nested.route_variants(table(spark, sf, "raw_records"), "record_id", "payload", CHILDREN)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf).supertype().select(*nested.KEYS, F.col("value").alias("child_value"))


def p3_variants(spark: SparkSession, sf: str) -> DataFrame:
    return nested.variants(_routed(spark, sf).supertype(), ["child_name", "subtype"])


def p3_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return nested.variants(_routed(spark, sf).supertype(), ["child_name", "variant"])


def p3_table_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """One typed subtype table: occurrences whose table number is an integer, joined to its parent by position."""
    ints = _routed(spark, sf).table("source_occurrences", "int")
    return ints.groupBy("record_id", "parent_pos").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    notes = table(spark, sf, "unified_annotations").select(
        F.lit("unified_annotations").alias("src_table"), F.col("ann_key").alias("src_id"), "display_markers"
    )
    marked = packed.split_packed(_marked(spark, sf), ["src_table", "src_id"], "annotation_markers", MARKER_CHARS)
    return marked.unionByName(packed.split_packed(notes, ["src_table", "src_id"], "display_markers", DISPLAY_CHARS))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf).select("src_table", "src_id", "item_pos", "item_value")


def p4_dialects(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf).groupBy("src_table", "dialect").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum(F.when(F.col("item_pos") == 1, 1).otherwise(0)).alias("n_fields")
    )


QUERIES = {
    "p1_found": p1_found, "p1_report": p1_report, "p3_found": p3_found, "p3_variants": p3_variants,
    "p3_shapes": p3_shapes, "p3_table_numbers": p3_table_numbers,
    "p4_found": p4_found, "p4_dialects": p4_dialects,
}


def _sql_values(column: str, chars: str) -> str:
    """DuckDB: the list of values of a marker field."""
    pattern = r'''"[^"]*(?:""[^"]*)*"|''[^'']*''|“[^”]*”|[''' + chars + "]+"
    inner = "substr(v, 2, length(v) - 2)"
    return (
        f"list_filter(list_transform(regexp_extract_all({column}, '{pattern}'), lambda v: CASE WHEN v[1] = '\"' THEN replace({inner}, '\"\"', '\"') "
        f"WHEN v[1] IN ('''', '“') THEN {inner} ELSE v END), lambda v: v <> '')"
    )


_P1 = f"""
WITH marked AS (
  SELECT 'soa_activities' src_table, row_id src_id, protocol_id, table_number, annotation_markers, loaded_at FROM soa_activities
  UNION ALL SELECT 'schedule_cells', cell_id, protocol_id, table_number, annotation_markers, loaded_at FROM schedule_cells),
refs AS (
  SELECT src_table, src_id, 'note' rel, protocol_id, table_number, loaded_at,
         unnest(list_distinct({_sql_values('annotation_markers', MARKER_CHARS)})) ref_key FROM marked WHERE annotation_markers IS NOT NULL
  UNION ALL SELECT 'unified_annotations', ann_key, 'act', protocol_id, 0, loaded_at, unnest(list_distinct(referenced_xacts)) FROM unified_annotations),
parents AS (
  SELECT 'note' rel, protocol_id, table_number, annotation_marker ref_key, loaded_at l, deleted_at d FROM soa_annotations
  UNION ALL SELECT 'act', protocol_id, 0, xact_id, loaded_at, deleted_at FROM unified_activities),
judged AS (
  SELECT src_table, strftime(r.loaded_at, '%Y-%m') ref_month, src_id, r.ref_key,
         count(p.rel) n, count(*) FILTER (p.l <= r.loaded_at) n_loaded,
         count(*) FILTER (p.l <= r.loaded_at AND (p.d IS NULL OR p.d > r.loaded_at)) n_live
  FROM (SELECT *, row_number() OVER () rn FROM refs WHERE ref_key IS NOT NULL) r
  LEFT JOIN parents p ON p.rel = r.rel AND p.protocol_id = r.protocol_id AND p.table_number = r.table_number AND p.ref_key = r.ref_key
  GROUP BY r.rn, src_table, r.loaded_at, src_id, r.ref_key),
found AS (SELECT src_table, ref_month, src_id, ref_key, CASE WHEN n = 0 THEN 'missing' WHEN n_loaded > 0 THEN 'deleted' ELSE 'late' END reason
  FROM judged WHERE n_live = 0)
"""

_P4 = f"""
WITH fields AS (
  SELECT 'soa_activities' src_table, row_id src_id, {_sql_values('annotation_markers', MARKER_CHARS)} v FROM soa_activities
  UNION ALL SELECT 'schedule_cells', cell_id, {_sql_values('annotation_markers', MARKER_CHARS)} FROM schedule_cells
  UNION ALL SELECT 'unified_annotations', ann_key, {_sql_values('display_markers', DISPLAY_CHARS)} FROM unified_annotations)
SELECT src_table, src_id, unnest(range(1, len(v) + 1))::INTEGER item_pos, unnest(v) item_value FROM fields WHERE len(v) >= 2
"""

_P3 = """
WITH docs AS (SELECT record_id, payload::JSON j FROM raw_records WHERE payload IS NOT NULL AND json_valid(payload)),
lists AS (
  SELECT record_id, k, json_extract(j, '$.' || k) c FROM docs, (VALUES ('schedule_properties'), ('unified_annotations')) t(k)),
opened AS (
  SELECT record_id, k, CASE json_type(c) WHEN 'VARCHAR' THEN (c->>'$')::JSON WHEN 'OBJECT' THEN json_array(c) ELSE c END c FROM lists WHERE c IS NOT NULL),
parents AS (
  SELECT record_id, k, generate_subscripts(from_json(c, '["JSON"]'), 1) parent_pos, unnest(from_json(c, '["JSON"]')) e
  FROM opened WHERE json_type(c) = 'ARRAY'),
children AS (
  SELECT record_id, parent_pos, f child_name, json_extract(e, '$.' || f) c
  FROM parents JOIN (VALUES ('schedule_properties', 'property_name_source'), ('unified_annotations', 'source_occurrences'),
    ('unified_annotations', 'referenced_xacts')) t(p, f) ON k = p),
opened2 AS (
  SELECT record_id, parent_pos, child_name,
    CASE WHEN json_type(c) = 'VARCHAR' AND substr(c->>'$', 1, 1) IN ('[', '{') THEN
      CASE json_type((c->>'$')::JSON) WHEN 'ARRAY' THEN (c->>'$')::JSON ELSE json_array((c->>'$')::JSON) END
    WHEN json_type(c) = 'ARRAY' THEN c WHEN json_type(c) = 'NULL' THEN NULL ELSE json_array(c) END c FROM children WHERE c IS NOT NULL),
elements AS (
  SELECT record_id, parent_pos, child_name, generate_subscripts(from_json(c, '["JSON"]'), 1) child_pos, unnest(from_json(c, '["JSON"]')) e
  FROM opened2 WHERE c IS NOT NULL),
found AS (SELECT record_id, child_name, parent_pos::INTEGER parent_pos, child_pos::INTEGER child_pos, child_value, json_type(v) kind FROM (
  SELECT *, v->>'$' child_value FROM (SELECT *, CASE child_name WHEN 'property_name_source' THEN e->'$.row_position' WHEN 'source_occurrences' THEN e->'$.table_num' ELSE e END v
  FROM elements)) WHERE child_value IS NOT NULL),
typed AS (SELECT *, CASE WHEN kind IN ('BIGINT', 'UBIGINT') OR (kind = 'VARCHAR' AND regexp_full_match(child_value, '-?[1-9][0-9]{0,17}|0')) THEN 'int'
  WHEN kind = 'BOOLEAN' THEN 'flag' WHEN kind = 'VARCHAR' THEN 'text' WHEN kind = 'DOUBLE' THEN 'number' ELSE 'json' END subtype FROM found)
"""

SQL = {
    "p1_found": _P1 + "SELECT * FROM found",
    "p1_report": _P1 + "SELECT src_table, ref_month, reason, count(*) n_refs FROM found GROUP BY ALL",
    "p3_found": _P3 + "SELECT record_id, child_name, parent_pos, child_pos, child_value FROM found",
    "p3_variants": _P3 + "SELECT child_name, subtype, count(*) n_rows, count(DISTINCT record_id) n_records FROM typed GROUP BY 1, 2",
    "p3_table_numbers": _P3 + "SELECT record_id, parent_pos, count(*) n, sum(child_value::BIGINT)::BIGINT total FROM typed WHERE child_name = 'source_occurrences' AND subtype = 'int' GROUP BY 1, 2",
    "p4_found": _P4,
}
