"""One query for each operator over the test tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions import classify, text
from gridweave.functions.text import WS
from gridweave.operators import audit, fill, fold, hierarchy, ids, islands, matching, matrix, merge, patch, quality, report, xref
from gridweave.plans.problems import table as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


class _Form(str):
    """An SQL expression with a place {} for its argument."""

    def format(self, x: str) -> str:  # type: ignore[override]
        return self.replace("{}", x)


#: DuckDB forms of the text functions.
_SQUEEZE = _Form(f"trim(regexp_replace({{}}, '[{WS}]+', ' ', 'g'))")
_STRIP = _Form(f"regexp_replace(regexp_replace({{}}, '^[{WS}]+', ''), '[{WS}]+$', '')")
_NORM_NOTE = _Form(_SQUEEZE.format("lower({})"))
_NORM_NAME = _Form(_SQUEEZE.format(r"regexp_replace(translate(lower({}), '-/', '  '), '\([^)]*\)', '', 'g')"))
_WORDS = _Form(f"list_distinct(list_filter(string_split({_NORM_NAME}, ' '), lambda w: length(w) > 2))")
_KEY = _Form("regexp_replace(lower(coalesce({}, '')), '[^a-z0-9]', '', 'g')")
_MARKERS = _Form(f"list_filter(list_transform(string_split(coalesce({{}}, ''), ','), lambda m: {_STRIP.format('m')}), lambda m: m <> '')")
_SHORT = _KEY.format(rf"regexp_replace(activity_name, '[{WS}]*\([^)]*\)[{WS}]*$', '')")
_LATEST = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY protocol_id, xact_id ORDER BY deleted_at IS NULL DESC, loaded_at DESC, act_key DESC) rn
  FROM unified_activities) WHERE rn = 1)"""


def latest_activities(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col("deleted_at").isNull().desc(), F.desc("loaded_at"), F.desc("act_key")]
    return ids.latest(T(spark, sf, "unified_activities"), ["protocol_id", "xact_id"], order)


# --- versions, ids, projections -----------------------------------------------------------------------------------------


@query(f"WITH {_LATEST} SELECT protocol_id, xact_id, act_key FROM latest")
def preferred_version(spark, sf):
    return latest_activities(spark, sf).select("protocol_id", "xact_id", "act_key")


@query("""SELECT row_id, format('act-{:03d}', row_number() OVER (PARTITION BY protocol_id, table_number ORDER BY row_position, row_id)) act_id FROM soa_activities""")
def mint_ids(spark, sf):
    df = ids.mint_in_order(T(spark, sf, "soa_activities"), "act_id", "act", ["protocol_id", "table_number"], [F.col("row_position"), F.col("row_id")])
    return df.select("row_id", "act_id")


@query()
def explode_occurrences(spark, sf):
    return ids.elements(T(spark, sf, "unified_annotations"), "source_occurrences", ["ann_key"]).select("ann_key", "pos", "table_num", "marker", "annotation_id")


SQL["explode_occurrences"] = """SELECT ann_key, i::INTEGER pos, source_occurrences[i].table_num table_num, source_occurrences[i].marker marker,
  source_occurrences[i].annotation_id annotation_id FROM (SELECT *, unnest(range(1, len(source_occurrences) + 1)) i FROM unified_annotations)"""


@query("""SELECT protocol_id, regexp_extract(soa_pages, '^\\s*(\\d+)', 1)::INTEGER first,
  CASE WHEN regexp_matches(soa_pages, '^\\s*\\d+\\s*$') THEN trim(soa_pages)::INTEGER ELSE nullif(regexp_extract(soa_pages, '^\\s*\\d+\\s*-\\s*(\\d+)\\s*$', 1), '')::INTEGER END AS last
  FROM protocols WHERE regexp_matches(soa_pages, '^\\s*\\d+\\s*(-\\s*\\d+\\s*)?$')""")
def page_ranges(spark, sf):
    p = T(spark, sf, "protocols").select("protocol_id", text.page_range(F.col("soa_pages")).alias("r")).where("r is not null")
    return p.select("protocol_id", "r.first", "r.last")


@query("""WITH found AS (SELECT protocol_id, count(DISTINCT source_page) n FROM soa_activities GROUP BY 1),
 declared AS (SELECT protocol_id, CASE WHEN regexp_matches(soa_pages, '^\\d+$') THEN 1 WHEN regexp_matches(soa_pages, '^\\d+-\\d+$')
   THEN split_part(soa_pages, '-', 2)::INTEGER - split_part(soa_pages, '-', 1)::INTEGER + 1 END d FROM protocols)
 SELECT protocol_id, CASE WHEN d IS NULL THEN 'undeclared' WHEN coalesce(n, 0) = 0 THEN 'none' WHEN d = n THEN 'equal' WHEN n < d THEN 'fewer' ELSE 'more' END decision
 FROM declared LEFT JOIN found USING (protocol_id)""")
def page_map(spark, sf):
    found = T(spark, sf, "soa_activities").groupBy("protocol_id").agg(F.countDistinct("source_page").alias("n"))
    declared = T(spark, sf, "protocols").select("protocol_id", text.page_range(F.col("soa_pages"))["n"].alias("d"))
    return declared.join(found, "protocol_id", "left").select("protocol_id", classify.page_decision(F.col("d"), F.col("n")).alias("decision"))


@query("""SELECT row_id, split_part(coalesce(extract_method, ''), '_', 1) first_token, CASE WHEN contains(extract_method, '_') AND NOT starts_with(split_part(extract_method, '_', -1), 'NCT')
  THEN split_part(extract_method, '_', -1) ELSE '' END last_token FROM soa_activities""")
def derived_metadata(spark, sf):
    m = F.col("extract_method")
    return T(spark, sf, "soa_activities").select("row_id", classify.derived("first_token", m).alias("first_token"), classify.derived("last_token_unless_nct", m).alias("last_token"))


# --- classification ------------------------------------------------------------------------------------------------------


@query(f"""WITH v AS (SELECT cell_id, upper({_STRIP.format('cell_value')}) v FROM schedule_cells)
 SELECT kind, count(*) n FROM (SELECT CASE WHEN v IS NULL OR v = '' THEN 'empty' WHEN v IN ('X', '✓', '✔', '•', '◆') THEN 'marker' WHEN v IN ('→', '...', '…') THEN 'continuation'
  WHEN contains(v, 'DAILY') OR contains(v, 'WEEKLY') OR contains(v, 'PRN') THEN 'frequency' WHEN contains(v, 'DAY') OR contains(v, 'WEEK') OR contains(v, 'HOUR') THEN 'timing_text'
  WHEN contains(v, 'IF') OR contains(v, 'OPTIONAL') THEN 'conditional' ELSE 'other' END kind FROM v) GROUP BY kind""")
def cell_kinds(spark, sf):
    return T(spark, sf, "schedule_cells").groupBy(classify.cell_kind(F.col("cell_value")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


_LEGEND = r"""(SELECT *, len(list_filter(string_split(annotation_text, ';'), lambda s: regexp_matches(s, '^\s*[A-Za-z][A-Za-z0-9()+/–\-. ]{0,30}='))) nd,
  len(string_split(annotation_text, ';')) ns FROM soa_annotations)"""


@query(f"""SELECT annot_key, CASE WHEN annotation_type NOT IN ('legend', 'abbreviation') AND (nd >= 2 OR (nd = 1 AND ns >= 2)) THEN 'legend' ELSE annotation_type END resolved_type,
  coalesce(nd >= 2 OR (nd = 1 AND ns >= 2), false) is_legend FROM {_LEGEND}""")
def legend_retype(spark, sf):
    t, k = F.col("annotation_text"), F.col("annotation_type")
    return T(spark, sf, "soa_annotations").select("annot_key", classify.resolved_type(k, t).alias("resolved_type"), classify.is_legend(t).alias("is_legend"))


@query(f"""SELECT act_key FROM unified_activities WHERE regexp_full_match({_STRIP.format('activity_name')}, 'CCI(\\s*\\(.*\\))?')""")
def redacted_names(spark, sf):
    return T(spark, sf, "unified_activities").where(classify.is_redacted(F.col("activity_name"))).select("act_key")


@query("""SELECT 'schedule_cells' src_table, cell_id::VARCHAR AS src_key, source_range value FROM schedule_cells WHERE source_range IS NOT NULL AND NOT regexp_full_match(source_range, '(\\d+:\\d+)?')
 UNION ALL SELECT 'protocols', protocol_id, translate(soa_pages, '-', ':') FROM protocols WHERE soa_pages IS NOT NULL AND NOT regexp_full_match(translate(soa_pages, '-', ':'), '(\\d+:\\d+)?')""")
def range_notation(spark, sf):
    """Ranges of cells and of pages that are not first:last."""
    cells = T(spark, sf, "schedule_cells").select(F.lit("schedule_cells").alias("src_table"), F.col("cell_id").cast("string").alias("src_key"), F.col("source_range").alias("value"))
    pages = T(spark, sf, "protocols").select(F.lit("protocols").alias("src_table"), F.col("protocol_id").alias("src_key"), F.translate("soa_pages", "-", ":").alias("value"))
    return cells.unionByName(pages).where("value is not null").where(~classify.is_range(F.col("value")))


@query("""SELECT act_key, CASE WHEN table_count = 1 THEN 'single' WHEN contains(match_status, 'cross') THEN 'cross' WHEN contains(match_status, 'fuzzy') THEN 'fuzzy' ELSE 'exact' END match_class FROM unified_activities""")
def match_classes(spark, sf):
    return T(spark, sf, "unified_activities").select("act_key", classify.match_class(F.col("match_status"), F.col("table_count")).alias("match_class"))


@query("""WITH t AS (SELECT *, lower(concat_ws(' ', coalesce(section_label, ''), coalesce(form_label, ''))) x FROM edc_items)
 SELECT item_id, coalesce(nullif(track_text, ''), CASE WHEN contains(x, 'nonrespond') OR contains(x, 'non-respond') THEN 'Nonresponders' WHEN contains(x, 'responder') THEN 'Responders'
  WHEN contains(x, 'maintenance') THEN 'Maintenance' END, 'Track-T' || coalesce(visit_count, 0)) track FROM t""")
def track_names(spark, sf):
    n = F.coalesce("visit_count", F.lit(0))
    return T(spark, sf, "edc_items").select("item_id", classify.track_name(F.col("track_text"), F.col("section_label"), F.col("form_label"), n).alias("track"))


# --- hierarchy -------------------------------------------------------------------------------------------------------------

_ROWS = "rows AS (SELECT *, row_number() OVER (PARTITION BY protocol_id, table_number ORDER BY row_position, row_id) i FROM soa_activities)"
_KEY2 = ["protocol_id", "table_number"]


@query(f"""WITH {_ROWS}, up AS (SELECT a.row_id, max(b.i) i, any_value(a.protocol_id) p, any_value(a.table_number) t FROM rows a JOIN rows b
  ON a.protocol_id = b.protocol_id AND a.table_number = b.table_number AND b.i < a.i AND b.indentation_level < a.indentation_level GROUP BY a.row_id)
 SELECT r.row_id, b.row_id parent FROM rows r LEFT JOIN up ON up.row_id = r.row_id LEFT JOIN rows b ON b.protocol_id = up.p AND b.table_number = up.t AND b.i = up.i""")
def parent_rows(spark, sf):
    df = hierarchy.parent_smaller(T(spark, sf, "soa_activities"), _KEY2, ["row_position", "row_id"], "indentation_level", "row_id")
    return df.select("row_id", "parent")


@query("""WITH rows AS (SELECT *, hierarchy_level + 1 l, row_number() OVER (PARTITION BY protocol_id ORDER BY display_order, act_key) i FROM unified_activities),
 up AS (SELECT a.act_key, max(b.i) i, any_value(a.protocol_id) p FROM rows a JOIN rows b ON a.protocol_id = b.protocol_id AND b.i < a.i AND b.l = a.l - 1 WHERE a.l > 1 GROUP BY a.act_key)
 SELECT r.act_key, b.act_key parent FROM rows r LEFT JOIN up ON up.act_key = r.act_key LEFT JOIN rows b ON b.protocol_id = up.p AND b.i = up.i""")
def parent_levels(spark, sf):
    df = T(spark, sf, "unified_activities").withColumn("l", F.col("hierarchy_level") + 1)
    return hierarchy.parent_previous(df, ["protocol_id"], ["display_order", "act_key"], "l", "act_key").select("act_key", "parent")


@query("""SELECT protocol_id, parent_xact_id, string_agg(act_key::VARCHAR, ',' ORDER BY display_order, act_key) child_ids FROM unified_activities WHERE parent_xact_id IS NOT NULL GROUP BY 1, 2""")
def children_lists(spark, sf):
    kids = hierarchy.children(T(spark, sf, "unified_activities"), ["protocol_id"], "parent_xact_id", "act_key", ["display_order", "act_key"])
    return kids.select("protocol_id", "parent_xact_id", F.array_join(F.transform("child_ids", lambda c: c.cast("string")), ",").alias("child_ids"))


@query(f"""WITH RECURSIVE {_LATEST}, ranked AS (SELECT protocol_id p, xact_id, parent_xact_id up, row_number() OVER (PARTITION BY protocol_id, parent_xact_id ORDER BY display_order, act_key) r FROM latest),
 walk AS (SELECT p, xact_id, [r] path FROM ranked WHERE up IS NULL UNION ALL SELECT n.p, n.xact_id, list_append(w.path, n.r) FROM walk w JOIN ranked n ON n.p = w.p AND n.up = w.xact_id),
 numbered AS (SELECT p, xact_id, row_number() OVER (PARTITION BY p ORDER BY path) n FROM walk)
 SELECT l.protocol_id, l.xact_id, coalesce(n, 0)::INTEGER walk_order FROM latest l LEFT JOIN numbered ON p = l.protocol_id AND numbered.xact_id = l.xact_id""")
def depth_first_order(spark, sf):
    return hierarchy.preorder(latest_activities(spark, sf), ["protocol_id"], "xact_id", "parent_xact_id", ["display_order", "act_key"], "walk_order")


@query(f"""WITH {_ROWS}, up AS (SELECT a.row_id, max_by(b.row_id, b.i) parent FROM rows a JOIN rows b
  ON a.protocol_id = b.protocol_id AND a.table_number = b.table_number AND b.i < a.i AND b.indentation_level < a.indentation_level GROUP BY a.row_id),
 data AS (SELECT DISTINCT protocol_id, table_number, row_position FROM schedule_cells WHERE coalesce({_STRIP.format('cell_value')}, '') <> '')
 SELECT r.row_id FROM rows r WHERE r.indentation_level = 0 AND r.row_id IN (SELECT parent FROM up)
  AND NOT EXISTS (SELECT 1 FROM data d WHERE d.protocol_id = r.protocol_id AND d.table_number = r.table_number AND d.row_position = r.row_position)""")
def section_headers(spark, sf):
    acts = hierarchy.parent_smaller(T(spark, sf, "soa_activities"), _KEY2, ["row_position", "row_id"], "indentation_level", "row_id")
    parents = acts.where("parent is not null").select(F.col("parent").alias("row_id"), F.lit(True).alias("has_children")).distinct()
    place = [*_KEY2, "row_position"]
    data = T(spark, sf, "schedule_cells").where(~text.is_blank(F.col("cell_value"))).select(*place, F.lit(True).alias("has_data")).distinct()
    both = acts.join(parents, "row_id", "left").join(data, place, "left").fillna(False, ["has_children", "has_data"])
    return both.where(hierarchy.section_header(F.col("indentation_level"), F.col("has_children"), F.col("has_data"))).select("row_id")


@query("""WITH n AS (SELECT *, lag(first_day) OVER w p, lead(first_day) OVER w q FROM unified_activities WINDOW w AS (PARTITION BY protocol_id ORDER BY display_order, act_key))
 SELECT act_key FROM n WHERE first_day IS NULL AND p IS NOT NULL AND q IS NOT NULL""")
def level_gaps(spark, sf):
    return hierarchy.level_gaps(T(spark, sf, "unified_activities"), ["protocol_id"], ["display_order", "act_key"], "first_day").select("act_key")


@query("""SELECT act_key, row_number() OVER (PARTITION BY protocol_id ORDER BY first_day IS NULL, coalesce(first_day, 0), CASE WHEN first_day IS NULL THEN activity_name END NULLS FIRST, act_key)::INTEGER rank FROM unified_activities""")
def level_first_order(spark, sf):
    return report.level_first(T(spark, sf, "unified_activities"), ["protocol_id"], "first_day", "activity_name", "act_key").select("act_key", "rank")


# --- cells and matrices ----------------------------------------------------------------------------------------------------


@query("""SELECT cell_id, CASE WHEN coalesce(source_range, '') <> '' THEN coalesce(nullif(cell_value, ''), first_value(nullif(cell_value, '') IGNORE NULLS) OVER (
   PARTITION BY protocol_id, table_number, source_range ORDER BY cell_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), cell_value) ELSE cell_value END filled FROM schedule_cells""")
def merged_fill(spark, sf):
    return fill.fill_merged(T(spark, sf, "schedule_cells"), _KEY2, "source_range", "cell_value", ["cell_id"]).select("cell_id", F.col("cell_value").alias("filled"))


@query("""WITH each AS (SELECT protocol_id, row_position, column_position, table_number, max_by(cell_value, cell_id) v FROM schedule_cells WHERE coalesce(cell_value, '') <> '' GROUP BY ALL)
 SELECT protocol_id, row_position, column_position, CASE WHEN count(DISTINCT v) = 1 THEN min(v) ELSE '[' || array_to_string(list_sort(list_distinct(list(v))), ', ') || ']' END consolidated_value,
  count(*) n_sources FROM each GROUP BY ALL""")
def schedule_matrix(spark, sf):
    cell = ["protocol_id", "row_position", "column_position"]
    m = matrix.consolidate_cells(T(spark, sf, "schedule_cells"), cell, "table_number", "cell_value", "cell_id")
    return m.select(*cell, "consolidated_value", F.size("source_values").cast("long").alias("n_sources"))


@query("""SELECT protocol_id, table_number, column_position, coalesce(string_agg(nullif(cell_value, ''), ' / ' ORDER BY row_position, cell_id), '') composite_label FROM schedule_cells GROUP BY ALL""")
def composite_labels(spark, sf):
    return matrix.composite_label(T(spark, sf, "schedule_cells"), [*_KEY2, "column_position"], "cell_value", ["row_position", "cell_id"])


@query("""SELECT protocol_id, table_number, row_position, column_position, max(cell_value) cell_value FROM schedule_cells WHERE column_position IS NOT NULL GROUP BY ALL""")
def schedule_grid(spark, sf):
    """The grid with a column for each position that occurs, read back cell by cell; the SQL has every cell of every column."""
    cells = T(spark, sf, "schedule_cells").withColumn("cell_value", F.coalesce("cell_value", F.lit("\u0000")))
    wide = matrix.grid(cells, [*_KEY2, "row_position"], "column_position", "cell_value")
    names = [c for c in wide.columns if c not in (*_KEY2, "row_position")]
    long = wide.unpivot([*_KEY2, "row_position"], names, "name", "v").where("v is not null")
    return long.select(*_KEY2, "row_position", F.substring("name", 2, 20).cast("int").alias("column_position"), F.nullif("v", F.lit("\u0000")).alias("cell_value"))


@query("""WITH each AS (SELECT protocol_id, table_number, row_position, column_position, max(cell_value) v FROM schedule_cells GROUP BY ALL)
 SELECT protocol_id, table_number, row_position,
  map_from_entries(coalesce(list({'k': column_position, 'v': v} ORDER BY column_position) FILTER (column_position IS NOT NULL), [])) cells FROM each GROUP BY ALL""")
def schedule_grid_map(spark, sf):
    return matrix.grid_map(T(spark, sf, "schedule_cells"), [*_KEY2, "row_position"], "column_position", "cell_value")


@query(f"""SELECT cell_id FROM schedule_cells c WHERE NOT EXISTS (SELECT 1 FROM soa_activities a WHERE a.protocol_id = c.protocol_id AND a.table_number = c.table_number AND a.row_position = c.row_position AND a.source_page IS NOT NULL)""")
def cells_without_row(spark, sf):
    """Cells whose row is not among those that stand on a known page."""
    place = [*_KEY2, "row_position"]
    return T(spark, sf, "schedule_cells").join(T(spark, sf, "soa_activities").where("source_page is not null").select(*place).distinct(), place, "left_anti").select("cell_id")


@query(f"""SELECT row_id FROM soa_activities a WHERE EXISTS (SELECT 1 FROM schedule_cells c WHERE a.protocol_id = c.protocol_id AND a.table_number = c.table_number
  AND a.row_position = c.row_position AND coalesce({_STRIP.format('c.cell_value')}, '') <> '')""")
def rows_with_data(spark, sf):
    place = [*_KEY2, "row_position"]
    data = T(spark, sf, "schedule_cells").where(~text.is_blank(F.col("cell_value"))).select(*place).distinct()
    return T(spark, sf, "soa_activities").join(data, place, "left_semi").select("row_id")


@query("""WITH r AS (SELECT protocol_id, table_number, column_position, row_position, cell_id, split_part(source_range, ':', 1)::INTEGER f, split_part(source_range, ':', 2)::INTEGER l
   FROM schedule_cells WHERE regexp_full_match(source_range, '\\d+:\\d+'))
 SELECT r.cell_id, count(c.cell_id) n FROM r JOIN schedule_cells c ON c.protocol_id = r.protocol_id AND c.table_number = r.table_number AND c.row_position = r.row_position
  AND c.column_position BETWEEN f AND l GROUP BY 1""")
def cells_in_range(spark, sf):
    c = T(spark, sf, "schedule_cells")
    place = [*_KEY2, "row_position"]
    r = c.select("cell_id", *place, text.span(F.col("source_range")).alias("s")).where("s is not null")
    hit = r.join(c.select(*place, "column_position"), place).where("column_position between s.first and s.last")
    return hit.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))


# --- references -------------------------------------------------------------------------------------------------------------

_REFS = f"""acts AS (SELECT protocol_id, table_number, 'activity' kind, row_id element, unnest({_MARKERS.format('annotation_markers')}) marker FROM soa_activities),
 cells AS (SELECT protocol_id, table_number, 'cell' kind, cell_id element, unnest({_MARKERS.format('annotation_markers')}) marker FROM schedule_cells),
 refs AS (SELECT * FROM acts UNION ALL SELECT * FROM cells)"""


def _refs(spark, sf):
    a, c = T(spark, sf, "soa_activities"), T(spark, sf, "schedule_cells")
    m = text.marker_list(F.col("annotation_markers"))
    return xref.references(a, _KEY2, F.col("row_id"), m, "activity", F.col("row_id")).unionByName(
        xref.references(c, _KEY2, F.col("cell_id"), m, "cell", F.col("cell_id"))
    )


@query(f"""WITH {_REFS} SELECT annot_key, kind, count(*) n_links, string_agg(element::VARCHAR, ',' ORDER BY element) elements
 FROM soa_annotations n JOIN refs r ON r.protocol_id = n.protocol_id AND r.table_number = n.table_number AND r.marker = n.annotation_marker GROUP BY 1, 2""")
def note_links(spark, sf):
    notes = T(spark, sf, "soa_annotations").select(*_KEY2, "annot_key", F.col("annotation_marker").alias("marker"))
    lists = xref.collected(xref.link(notes, _refs(spark, sf), _KEY2), ["annot_key", "kind"], "element", ["ordinal"], "e")
    return lists.select("annot_key", "kind", F.size("e").cast("long").alias("n_links"), F.array_join(F.transform("e", lambda x: x.cast("string")), ",").alias("elements"))


@query(f"""WITH {_REFS} SELECT kind, element, string_agg(annotation_id, ',' ORDER BY annot_key) note_ids
 FROM soa_annotations n JOIN refs r ON r.protocol_id = n.protocol_id AND r.table_number = n.table_number AND r.marker = n.annotation_marker GROUP BY 1, 2""")
def element_links(spark, sf):
    notes = T(spark, sf, "soa_annotations").select(*_KEY2, "annot_key", "annotation_id", F.col("annotation_marker").alias("marker"))
    lists = xref.collected(xref.link(notes, _refs(spark, sf), _KEY2), ["kind", "element"], "annotation_id", ["annot_key"], "n")
    return lists.select("kind", "element", F.array_join("n", ",").alias("note_ids"))


@query(f"""WITH {_REFS}, flags AS (SELECT annot_key, coalesce(bool_or(kind = 'activity'), false) a, coalesce(bool_or(kind = 'cell'), false) c
  FROM soa_annotations n LEFT JOIN refs r ON r.protocol_id = n.protocol_id AND r.table_number = n.table_number AND r.marker = n.annotation_marker GROUP BY 1)
 SELECT annot_key, CASE WHEN NOT a AND NOT c THEN 'table' WHEN a AND c THEN 'multiple' WHEN a THEN 'activity' ELSE 'cell' END AS scope FROM flags""")
def note_scopes(spark, sf):
    notes = T(spark, sf, "soa_annotations").select(*_KEY2, "annot_key", F.col("annotation_marker").alias("marker"))
    kinds = notes.join(_refs(spark, sf).select(*_KEY2, "marker", "kind").distinct(), [*_KEY2, "marker"], "left").groupBy("annot_key").agg(
        *[F.coalesce(F.bool_or(F.col("kind") == k), F.lit(False)).alias(k) for k in ("activity", "cell")]
    )
    no = F.lit(False)
    return kinds.select("annot_key", classify.scope(no, no, F.col("activity"), F.col("cell")).alias("scope"))


@query(f"""WITH {_REFS} SELECT DISTINCT r.protocol_id, r.table_number, r.marker FROM refs r WHERE NOT EXISTS (SELECT 1 FROM soa_annotations n
  WHERE n.protocol_id = r.protocol_id AND n.table_number = r.table_number AND n.annotation_marker = r.marker)""")
def undefined_markers(spark, sf):
    notes = T(spark, sf, "soa_annotations").select(*_KEY2, F.col("annotation_marker").alias("marker"))
    return xref.undefined(_refs(spark, sf), notes, [*_KEY2, "marker"])


@query("""WITH ids AS (SELECT ann_key, protocol_id, unnest(referenced_xacts) x FROM unified_annotations),
 p AS (SELECT DISTINCT i.ann_key, u.xact_id FROM ids i JOIN unified_activities u ON u.protocol_id = i.protocol_id AND u.xact_id = i.x),
 s AS (SELECT DISTINCT a.ann_key, u.xact_id FROM unified_annotations a JOIN unified_activities u ON u.protocol_id = a.protocol_id AND u.display_order = a.occurrence_count)
 SELECT *, 'primary' src FROM p UNION ALL SELECT *, 'fallback' FROM s WHERE ann_key NOT IN (SELECT ann_key FROM p)""")
def guarded_fallback(spark, sf):
    notes, acts = T(spark, sf, "unified_annotations"), T(spark, sf, "unified_activities").select("protocol_id", "xact_id", "display_order")
    p = notes.select("ann_key", "protocol_id", F.explode("referenced_xacts").alias("xact_id")).join(acts, ["protocol_id", "xact_id"])
    s = notes.select("ann_key", "protocol_id", F.col("occurrence_count").alias("display_order")).join(acts, ["protocol_id", "display_order"])
    tag = lambda df, name: df.select("ann_key", "xact_id").distinct().withColumn("src", F.lit(name))
    return xref.with_fallback(tag(p, "primary"), tag(s, "fallback"), ["ann_key"])


# --- merging of equal records ------------------------------------------------------------------------------------------------


@query(f"""WITH n AS (SELECT *, {_NORM_NOTE.format('annotation_text')} k FROM unified_annotations)
 SELECT protocol_id, min_by(annotation_type, ann_key) annotation_type, min_by(annotation_text, ann_key) annotation_text, min(ann_key) first_order, count(*) n_occurrences FROM n GROUP BY protocol_id, k""")
def merge_notes(spark, sf):
    df = T(spark, sf, "unified_annotations")
    m = merge.merge_equal(df, ["protocol_id"], text.norm_note(F.col("annotation_text")), "ann_key", ["annotation_type", "annotation_text"])
    return m.select("protocol_id", "annotation_type", "annotation_text", "first_order", "n_occurrences")


@query(f"""WITH n AS (SELECT ann_key, protocol_id, {_NORM_NOTE.format('annotation_text')} k, coalesce(referenced_xacts, []) r FROM unified_annotations),
 firsts AS (SELECT protocol_id, k, min(ann_key) f FROM n GROUP BY 1, 2),
 each AS (SELECT n.protocol_id, n.k, x.x, min(struct_pack(a := n.ann_key, i := x.i)) o FROM n, LATERAL (SELECT unnest(r) x, unnest(range(len(r))) i) x GROUP BY 1, 2, 3)
 SELECT f first_order, coalesce(string_agg(x, ',' ORDER BY o), '') refs FROM firsts LEFT JOIN each ON each.protocol_id = firsts.protocol_id AND each.k IS NOT DISTINCT FROM firsts.k GROUP BY 1""")
def merge_references(spark, sf):
    df = T(spark, sf, "unified_annotations")
    m = merge.merge_equal(df, ["protocol_id"], text.norm_note(F.col("annotation_text")), "ann_key", [], ["referenced_xacts"])
    return m.select("first_order", F.array_join("referenced_xacts", ",").alias("refs"))


@query("""WITH o AS (SELECT ann_key, unnest(source_occurrences) o FROM unified_annotations), t AS (SELECT ann_key, o.marker m, o.table_num t FROM o),
 per AS (SELECT ann_key, m, min(t) lo, max(t) hi, count(*) n, count(DISTINCT t) nd, string_agg(t::VARCHAR, ',' ORDER BY t) l FROM t GROUP BY 1, 2)
 SELECT ann_key, string_agg('T' || CASE WHEN n = 1 THEN lo::VARCHAR WHEN nd = n AND hi - lo + 1 = n THEN lo || '-' || hi ELSE l END || ':' || m, ', ' ORDER BY lo, m) display FROM per GROUP BY 1""")
def display_markers(spark, sf):
    o = T(spark, sf, "unified_annotations").select("ann_key", F.explode("source_occurrences").alias("o")).select("ann_key", "o.marker", "o.table_num")
    return merge.display_markers(o, ["ann_key"], "marker", "table_num")


@query(f"""SELECT doc_id, len(list_filter(list_transform(string_split(regexp_replace(text, '([.;:])[{WS}]+', '\\1' || chr(1), 'g'), chr(1)), lambda s: {_STRIP.format('s')}), lambda s: length(s) >= 15)) n_sentences
 FROM documents WHERE text IS NOT NULL""")
def sentence_counts(spark, sf):
    return T(spark, sf, "documents").where("text is not null").select("doc_id", F.size(text.sentences(F.col("text"))).cast("long").alias("n_sentences"))


# --- matching ------------------------------------------------------------------------------------------------------------------

_OVERLAP = f"""names AS (SELECT DISTINCT protocol_id, activity_name n, {_WORDS.format('activity_name')} w FROM {{}} WHERE activity_name IS NOT NULL)"""
_SCORED = f"""a AS (SELECT DISTINCT protocol_id, activity_name l_activity_name, {_WORDS.format('activity_name')} wl FROM soa_activities WHERE activity_name IS NOT NULL),
 b AS (SELECT protocol_id, activity_name r_activity_name, min(act_key) r_ord, {_WORDS.format('activity_name')} wr FROM unified_activities GROUP BY ALL),
 s AS (SELECT *, len(list_intersect(wl, wr)) i FROM a JOIN b USING (protocol_id) WHERE len(wl) > 0 AND len(wr) > 0),
 scored AS (SELECT *, 0.6::DOUBLE * (i / least(len(wl), len(wr))) + 0.4::DOUBLE * (i / (len(wl) + len(wr) - i)) score FROM s)"""


def _overlaps(spark, sf, least):
    a = T(spark, sf, "soa_activities").where("activity_name is not null").select("protocol_id", "activity_name").distinct()
    b = T(spark, sf, "unified_activities").groupBy("protocol_id", "activity_name").agg(F.min("act_key").alias("ord"))
    return matching.overlap_join(a, b, ["protocol_id"], "activity_name", "activity_name", least)


@query(f"WITH {_SCORED} SELECT protocol_id, l_activity_name, r_activity_name, round(score, 9) score FROM scored WHERE score >= 0.6")
def word_overlap_pairs(spark, sf):
    return _overlaps(spark, sf, 0.6).select("protocol_id", "l_activity_name", "r_activity_name", F.round("score", 9).alias("score"))


@query(f"""WITH {_SCORED} SELECT protocol_id, l_activity_name, r_activity_name FROM (SELECT *, row_number() OVER (PARTITION BY protocol_id, l_activity_name ORDER BY round(score, 9) DESC, r_ord) rn
 FROM scored WHERE score >= 0.5) WHERE rn = 1""")
def best_match(spark, sf):
    top = matching.best(_overlaps(spark, sf, 0.5), ["protocol_id", "l_activity_name"], F.round("score", 9), ["r_ord"])
    return top.select("protocol_id", "l_activity_name", "r_activity_name")


def fold_sql(rows: str) -> str:
    """CTEs `fold` (protocol_id, i, e: the entities so far, ent, st, sc) and `folded` (a row for each row with its entity), of a CTE of
    rows with protocol_id, table_number, table_rank, is_base, pos, name, parent, header. One step of the recursion is one row of every protocol."""
    return f"""ordered AS (SELECT *, {_WORDS.format('name')} w, row_number() OVER (PARTITION BY protocol_id ORDER BY is_base DESC, table_rank, pos) i FROM {rows}),
 fold AS (
  SELECT protocol_id, 0::BIGINT i, []::STRUCT(name VARCHAR, w VARCHAR[], made VARCHAR, parent VARCHAR, header BOOLEAN, tabs INTEGER[], status VARCHAR, conf DOUBLE)[] e, 0::BIGINT ent, '' st, 0::DOUBLE sc
  FROM (SELECT DISTINCT protocol_id FROM ordered)
  UNION ALL
  SELECT protocol_id, i, CASE WHEN ent = 0 THEN list_append(e, {{'name': name, 'w': w, 'made': parent, 'parent': parent, 'header': header, 'tabs': [table_number], 'status': 'new', 'conf': 1.0::DOUBLE}})
    ELSE list_transform(e, lambda x, k: CASE WHEN k = ent THEN {{'name': x.name, 'w': x.w, 'made': x.made, 'parent': CASE WHEN st = 'fuzzy_cross_parent' AND x.parent <> parent THEN x.parent || ' / ' || parent ELSE x.parent END,
      'header': x.header, 'tabs': list_append(x.tabs, table_number), 'status': st, 'conf': least(x.conf, sc)}} ELSE x END) END,
   CASE WHEN ent = 0 THEN len(e) + 1 ELSE ent END, st, sc
  FROM (SELECT *, CASE WHEN is_base THEN 0 WHEN kx > 0 THEN kx WHEN kn > 0 THEN kn WHEN one.s >= 0.6 THEN one.k WHEN two.s >= 0.9 THEN two.k ELSE 0 END ent,
    CASE WHEN is_base THEN 'new' WHEN kx > 0 OR kn > 0 THEN 'exact' WHEN one.s >= 0.85 THEN 'fuzzy_auto' WHEN one.s >= 0.6 THEN 'fuzzy_review' WHEN two.s >= 0.9 THEN 'fuzzy_cross_parent' ELSE 'new' END st,
    CASE WHEN is_base OR kx > 0 OR kn > 0 THEN 1.0 WHEN one.s >= 0.6 THEN one.s WHEN two.s >= 0.9 THEN two.s ELSE 1.0 END sc
   FROM (SELECT *, list_sort(list_transform(list_filter(scored, lambda x: x.same), lambda x: {{'n': -x.s, 'k': x.k, 's': x.s}}))[1] one, list_sort(list_transform(list_filter(scored, lambda x: NOT x.same AND NOT x.h), lambda x: {{'n': -x.s, 'k': x.k, 's': x.s}}))[1] two
    FROM (SELECT *, list_filter(list_transform(free, lambda x: {{'k': x.k, 'same': x.parent = parent, 'h': x.header, 's': CASE WHEN len(w) = 0 OR len(x.w) = 0 THEN 0 ELSE
        0.6::DOUBLE * (len(list_intersect(w, x.w)) / least(len(w), len(x.w))) + 0.4::DOUBLE * (len(list_intersect(w, x.w)) / (len(w) + len(x.w) - len(list_intersect(w, x.w)))) END}}), lambda x: x.s >= 0.5) scored,
       coalesce(list_max(list_transform(list_filter(free, lambda x: x.made = parent AND x.name = name), lambda x: x.k)), 0) kx0, coalesce(list_min(list_transform(list_filter(free, lambda x: x.name = name), lambda x: x.k)), 0) kn,
       CASE WHEN kx0 = lastx THEN kx0 ELSE 0 END kx
     FROM (SELECT f.e, r.*, list_filter(list_transform(f.e, lambda x, k: {{'k': k, 'name': x.name, 'w': x.w, 'made': x.made, 'parent': x.parent, 'header': x.header, 'taken': list_contains(x.tabs, r.table_number)}}), lambda x: NOT x.taken) free,
        coalesce(list_max(list_transform(f.e, lambda x, k: CASE WHEN x.made = r.parent AND x.name = r.name THEN k ELSE 0 END)), 0) lastx
      FROM fold f JOIN ordered r ON r.protocol_id = f.protocol_id AND r.i = f.i + 1))))),
 ends AS (SELECT protocol_id, max_by(e, i) e FROM fold GROUP BY 1),
 folded AS (SELECT o.protocol_id, o.table_number, o.pos, format('xact-{{:03d}}', ent) xact_id, ent, st match_status, sc match_confidence, ends.e[ent].parent entity_parent, ends.e[ent].name entity_name,
   ends.e[ent].status entity_status, ends.e[ent].conf entity_confidence FROM fold f JOIN ordered o ON o.protocol_id = f.protocol_id AND o.i = f.i JOIN ends ON ends.protocol_id = f.protocol_id WHERE f.i > 0)"""


@query(f"""WITH RECURSIVE {_ROWS}, upn AS (SELECT a.row_id, arg_max_null(b.activity_name, b.i) parent FROM rows a JOIN rows b
  ON a.protocol_id = b.protocol_id AND a.table_number = b.table_number AND b.i < a.i AND b.indentation_level < a.indentation_level GROUP BY a.row_id),
 given AS (SELECT protocol_id, table_number, table_number table_rank, table_number = 1 is_base, r.row_id pos, coalesce(activity_name, '') AS name, coalesce(upn.parent, '') parent, indentation_level = 0 header FROM rows r LEFT JOIN upn ON upn.row_id = r.row_id),
 {fold_sql('given')} SELECT * EXCLUDE (ent) FROM folded""")
def entity_fold(spark, sf):
    acts = hierarchy.parent_smaller(T(spark, sf, "soa_activities"), _KEY2, ["row_position", "row_id"], "indentation_level", "row_id")
    named = acts.alias("a").join(acts.select(F.col("row_id").alias("parent"), F.col("activity_name").alias("parent_name")), "parent", "left")
    rows = named.select("protocol_id", "table_number", F.col("table_number").alias("table_rank"), (F.col("table_number") == 1).alias("is_base"), F.col("row_id").alias("pos"),
                        F.col("activity_name").alias("name"), F.col("parent_name").alias("parent"), (F.col("indentation_level") == 0).alias("header"))
    return fold.resolve_entities(rows, ["protocol_id"])


_TIERS = f"""p AS (SELECT DISTINCT protocol_id, table_number, activity_name text, {_KEY.format('activity_name')} p FROM soa_activities WHERE activity_name IS NOT NULL),
 k AS (SELECT DISTINCT protocol_id, activity_name label, unnest(list_distinct([{_KEY.format('activity_name')}, {_SHORT}])) k
   FROM soa_activities WHERE table_number = 1 AND activity_name IS NOT NULL),
 s AS (SELECT *, CASE WHEN p = k THEN 3 WHEN length(k) >= 6 AND length(p) - length(k) BETWEEN 1 AND 4 AND regexp_matches(p, array_to_string(string_split(k, ''), '.*')) THEN 2
   WHEN length(p) >= 12 AND (starts_with(p, k) OR starts_with(k, p)) THEN 1 ELSE 0 END kind, CASE WHEN p = k THEN length(k) WHEN length(k) >= 6 AND length(p) - length(k) BETWEEN 1 AND 4
   AND regexp_matches(p, array_to_string(string_split(k, ''), '.*')) THEN length(k) ELSE least(length(p), length(k)) END n FROM p JOIN k USING (protocol_id) WHERE p <> '' AND k <> '')"""


@query(f"""WITH {_TIERS} SELECT DISTINCT protocol_id, text, label, kind::INTEGER kind, n::INTEGER n FROM (SELECT *, rank() OVER (PARTITION BY protocol_id, text ORDER BY kind DESC, n DESC) rk FROM s WHERE kind > 0) WHERE rk = 1""")
def label_tiers(spark, sf):
    acts = T(spark, sf, "soa_activities").where("activity_name is not null")
    printed = acts.select("protocol_id", F.col("activity_name").alias("text"))
    labels = acts.where("table_number = 1").select("protocol_id", F.col("activity_name").alias("label"))
    return matching.label_matches(printed, labels, ["protocol_id"], "text", "label")


@query("""WITH t AS (SELECT DISTINCT protocol_id, annotation_text t FROM unified_annotations WHERE length(annotation_text) >= 25)
 SELECT a.protocol_id, a.t needle, b.t stack FROM t a JOIN t b ON a.protocol_id = b.protocol_id AND a.t <> b.t AND contains(b.t, a.t)""")
def contained_texts(spark, sf):
    t = T(spark, sf, "unified_annotations").where(F.length("annotation_text") >= 25).select("protocol_id", F.col("annotation_text").alias("needle")).distinct()
    return matching.contains_join(t, t.withColumnRenamed("needle", "stack"), ["protocol_id"], "needle", "stack", least=25).where("needle <> stack")


@query(f"""WITH titles AS (SELECT protocol_id, min(annotation_text) title, {_KEY.format('annotation_text')} k FROM unified_annotations WHERE length({_KEY.format('annotation_text')}) >= 12 GROUP BY 1, 3),
 hits AS (SELECT annot_key, title, length(k) n FROM soa_annotations d JOIN titles t ON t.protocol_id = d.protocol_id AND contains({_KEY.format('d.annotation_text')}, k)),
 top AS (SELECT *, rank() OVER (PARTITION BY annot_key ORDER BY n DESC) rk, count(*) OVER (PARTITION BY annot_key, n) c FROM hits) SELECT annot_key, title FROM top WHERE rk = 1 AND c = 1""")
def caption_title(spark, sf):
    """The longest known text that a printed one holds, where one is longer than all others."""
    titles = T(spark, sf, "unified_annotations").withColumn("k", text.norm_key(F.col("annotation_text"))).where("length(k) >= 12").groupBy("protocol_id", "k").agg(F.min("annotation_text").alias("title"))
    printed = T(spark, sf, "soa_annotations").select("protocol_id", "annot_key", text.norm_key(F.col("annotation_text")).alias("body"))
    return matching.longest_contained(printed, titles, ["protocol_id"], "body", "k", ["annot_key"], 12).select("annot_key", "title")


@query(f"""WITH c AS (SELECT p.protocol_id, c.place, c.text FROM edc_items e JOIN protocols p ON p.study_code = e.study_label,
  LATERAL (VALUES (1, e.form_label), (2, e.section_label), (3, e.track_text)) c(place, text)),
 k AS (SELECT DISTINCT protocol_id, {_KEY.format('activity_name')} k FROM unified_activities WHERE activity_name IS NOT NULL)
 SELECT c.protocol_id, c.place AS "column" FROM c LEFT JOIN k ON k.protocol_id = c.protocol_id AND k.k = {_KEY.format('c.text')} AND k.k <> ''
 WHERE coalesce({_STRIP.format('c.text')}, '') <> '' GROUP BY 1, 2 HAVING count(k.k) >= 2 AND count(k.k) / count(*) >= 0.5""")
def label_columns(spark, sf):
    """Columns of hand-typed forms whose texts are names of activities of the study: equal in audit form."""
    forms = T(spark, sf, "edc_items").join(T(spark, sf, "protocols").select("protocol_id", F.col("study_code").alias("study_label")), "study_label")
    texts = forms.select("protocol_id", F.posexplode(F.array("form_label", "section_label", "track_text")).alias("at", "text")).select("protocol_id", (F.col("at") + 1).alias("column"), "text")
    keys = T(spark, sf, "unified_activities").select("protocol_id", text.norm_key(F.col("activity_name")).alias("k")).where("k <> ''").distinct()
    equal = texts.withColumn("k", text.norm_key(F.col("text"))).join(keys, ["protocol_id", "k"], "left_semi")
    return audit.label_columns(texts, equal, ["protocol_id"])


@query()
def page_assignment(spark, sf):
    rows = T(spark, sf, "soa_activities").where("source_page is not null").groupBy("protocol_id", F.col("source_page").alias("page"), F.col("table_number").alias("table")).agg(F.count(F.lit(1)).alias("score"))
    return audit.assign_pages(rows, ["protocol_id"])


@query("""WITH s AS (SELECT protocol_id, source_page page, indentation_level, count(*) score FROM soa_activities WHERE source_page IS NOT NULL GROUP BY ALL),
 n AS (SELECT protocol_id, page, sum(score) n, max(score) m FROM s GROUP BY ALL) SELECT protocol_id, page FROM n WHERE m < 0.75 * n""")
def unexplained_pages(spark, sf):
    """Pages of which rows of no single level make up three quarters."""
    s = T(spark, sf, "soa_activities").where("source_page is not null").groupBy("protocol_id", F.col("source_page").alias("page"), "indentation_level").agg(F.count(F.lit(1)).alias("score"))
    return audit.orphan_pages(s, ["protocol_id"], s.groupBy("protocol_id", "page").agg(F.sum("score").alias("n")), rate=0.75)


# --- runs and bands ------------------------------------------------------------------------------------------------------------


@query("""WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w > 3600000000 OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 i AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) island FROM g)
 SELECT user_id, island::BIGINT island, min(ts) AS first, max(ts) AS last, count(*) n FROM i GROUP BY 1, 2""")
def event_islands(spark, sf):
    e = T(spark, sf, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    numbered = islands.gap_islands(e, ["user_id"], "at", 3_600_000_000, ["event_id"])
    return numbered.groupBy("user_id", "island").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))


_CLUSTERS = """p AS (SELECT protocol_id, row_position * 4 AS pos, list_distinct(list(table_number)) c FROM soa_activities GROUP BY ALL),
 i AS (SELECT *, sum(b) OVER (PARTITION BY protocol_id ORDER BY pos) g FROM (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY protocol_id ORDER BY pos) <= 4 THEN 0 ELSE 1 END b FROM p)),
 k AS (SELECT protocol_id, g, round_even(avg(pos), 0)::BIGINT AS position, len(list_distinct(flatten(list(c)))) n_columns FROM i GROUP BY ALL),
 n AS (SELECT protocol_id, count(DISTINCT table_number) total FROM soa_activities GROUP BY 1),
 clusters AS (SELECT protocol_id, position, n_columns FROM k JOIN n USING (protocol_id) WHERE n_columns >= least(2, total))"""


def _clusters(spark, sf):
    rows = T(spark, sf, "soa_activities").select("protocol_id", (F.col("row_position") * 4).alias("pos"), "table_number")
    return islands.consensus(rows, ["protocol_id"], "pos", "table_number", gap=4)


@query(f"WITH {_CLUSTERS} SELECT protocol_id, position, n_columns::INTEGER n_columns FROM clusters")
def consensus_clusters(spark, sf):
    return _clusters(spark, sf)


@query("""WITH p AS (SELECT DISTINCT protocol_id, source_page AS pos FROM soa_activities WHERE source_page IS NOT NULL)
 SELECT protocol_id, pos a, b FROM (SELECT *, lead(pos) OVER (PARTITION BY protocol_id ORDER BY pos) b FROM p) WHERE b - pos >= 2""")
def wide_bands(spark, sf):
    pages = T(spark, sf, "soa_activities").where("source_page is not null").select("protocol_id", F.col("source_page").alias("pos")).distinct()
    return islands.bands(pages, ["protocol_id"], "pos", 2)


@query(f"""WITH p AS (SELECT DISTINCT protocol_id, table_number, row_position, column_position c FROM schedule_cells WHERE coalesce({_STRIP.format('cell_value')}, '') <> ''),
 i AS (SELECT *, c - row_number() OVER (PARTITION BY protocol_id, table_number, row_position ORDER BY c) g FROM p)
 SELECT protocol_id, table_number, row_position, max(n) longest FROM (SELECT protocol_id, table_number, row_position, g, count(*) n FROM i GROUP BY ALL) GROUP BY ALL""")
def longest_mark_runs(spark, sf):
    marks = T(spark, sf, "schedule_cells").where(~text.is_blank(F.col("cell_value")))
    return islands.longest_run(marks, [*_KEY2, "row_position"], "column_position")


@query("""WITH c AS (SELECT protocol_id, table_number, column_position, row_position, max(coalesce(source_range, '') <> '') j FROM schedule_cells GROUP BY ALL),
 i AS (SELECT *, sum(b) OVER (PARTITION BY protocol_id, table_number, column_position ORDER BY row_position) g FROM (
   SELECT *, CASE WHEN coalesce(lag(j) OVER (PARTITION BY protocol_id, table_number, column_position ORDER BY row_position), false) THEN 0 ELSE 1 END b FROM c))
 SELECT protocol_id, table_number, column_position, min(row_position) AS first, max(row_position) AS last FROM i GROUP BY protocol_id, table_number, column_position, g HAVING min(row_position) < max(row_position)""")
def merged_spans(spark, sf):
    place = [*_KEY2, "column_position"]
    cells = T(spark, sf, "schedule_cells").groupBy(*place, "row_position").agg(F.max(F.coalesce("source_range", F.lit("")) != "").alias("joins"))
    return islands.merged_spans(cells, place, "row_position", "joins")


@query("""SELECT row_id, coalesce(max(annotation_markers IS NOT NULL) OVER (PARTITION BY protocol_id, table_number ORDER BY row_position, row_id ROWS UNBOUNDED PRECEDING), false) in_body FROM soa_activities""")
def body_rows(spark, sf):
    acts = T(spark, sf, "soa_activities").withColumn("found", F.col("annotation_markers").isNotNull())
    return islands.after_first(acts, _KEY2, ["row_position", "row_id"], "found").select("row_id", "in_body")


@query("""SELECT act_key, coalesce(parent_name IS DISTINCT FROM lag(parent_name) OVER w OR lag(act_key) OVER w IS NULL, true) starts FROM unified_activities WINDOW w AS (PARTITION BY protocol_id ORDER BY display_order, act_key)""")
def segment_starts(spark, sf):
    df = T(spark, sf, "unified_activities").withColumn("k", F.coalesce("parent_name", F.lit("\u0000")))
    return islands.changes(df, ["protocol_id"], ["display_order", "act_key"], "k").select("act_key", "starts")


@query("""WITH t AS (SELECT DISTINCT protocol_id, table_number FROM soa_activities) SELECT protocol_id, table_number, lag(table_number) OVER w AS prev, lead(table_number) OVER w AS next FROM t
 WINDOW w AS (PARTITION BY protocol_id ORDER BY table_number)""")
def table_navigation(spark, sf):
    return report.neighbours(T(spark, sf, "soa_activities").select(*_KEY2).distinct(), ["protocol_id"], ["table_number"], "table_number")


# --- detectors -------------------------------------------------------------------------------------------------------------------


@query(f"""WITH b AS (SELECT protocol_id, ann_key, {_NORM_NOTE.format("coalesce(annotation_text, '')")} a, coalesce(annotation_text, '') t FROM unified_annotations),
 s AS (SELECT *, len(string_split(a, ' ')) <= 10 AND regexp_matches(t, '(?i)\\b(section|appendix|attachment)\\b') r, len(list_filter(string_split(a, ' '), lambda x: x <> '')) w FROM b),
 p AS (SELECT protocol_id, ann_key AS first, a, r, w, lead(ann_key) OVER o AS second, lead(a) OVER o a2, lead(r) OVER o r2, lead(w) OVER o w2 FROM s WINDOW o AS (PARTITION BY protocol_id ORDER BY ann_key))
 SELECT protocol_id, first, second FROM p WHERE second IS NOT NULL AND NOT r AND NOT r2 AND least(w, w2) >= 4 AND (contains(a, a2) OR contains(a2, a))""")
def adjacent_overlaps(spark, sf):
    return quality.adjacent_containment(T(spark, sf, "unified_annotations"), ["protocol_id"], ["ann_key"], "ann_key", "annotation_text")


@query(f"""WITH s0 AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.;:])[{WS}]+', '\\1' || chr(1), 'g'), chr(1)), lambda s: {_STRIP.format('s')}), lambda s: length(s) >= 15) l FROM documents),
 s AS (SELECT doc_id, unnest(l) s, unnest(range(len(l))) i FROM s0),
 q AS (SELECT a.doc_id, a.i, b.i - a.i d, length(a.s) n FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.s = b.s AND a.i < b.i),
 g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) g FROM q),
 r AS (SELECT x.doc_id, x.i, x.d, sum(y.n) c FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.d = y.d AND x.g = y.g AND y.i >= x.i AND y.i < x.i + x.d GROUP BY 1, 2, 3)
 SELECT doc_id, max(c)::INTEGER block_chars FROM r GROUP BY 1""")
def duplicated_blocks(spark, sf):
    return quality.duplicated_blocks(T(spark, sf, "documents"), "doc_id", "text")


@query("""WITH n AS (SELECT a.ann_key, len(list_distinct(list_transform(source_occurrences, lambda o: o.table_num))) n_tables, (SELECT count(DISTINCT coalesce(u.nm, x)) FROM (SELECT unnest(a.referenced_xacts) x)
   LEFT JOIN (SELECT protocol_id, xact_id, min(activity_name) nm FROM unified_activities GROUP BY 1, 2) u ON u.protocol_id = a.protocol_id AND u.xact_id = x) n_names FROM unified_annotations a)
 SELECT ann_key, n_tables::INTEGER n_tables, n_names::INTEGER n_names FROM n WHERE n_tables > 1 AND n_names > 1 AND n_names <= n_tables""")
def binding_conflicts(spark, sf):
    names = T(spark, sf, "unified_activities").groupBy("protocol_id", "xact_id").agg(F.min("activity_name").alias("nm"))
    notes = T(spark, sf, "unified_annotations")
    each = notes.select("ann_key", "protocol_id", F.explode("referenced_xacts").alias("xact_id")).join(names, ["protocol_id", "xact_id"], "left")
    named = each.groupBy("ann_key").agg(F.collect_set(F.coalesce("nm", "xact_id")).alias("names"))
    both = notes.select("ann_key", F.transform("source_occurrences", lambda o: o["table_num"]).alias("tables")).join(named, "ann_key")
    return quality.binding_conflicts(both, ["ann_key"], F.col("tables"), F.col("names"))


@query(f"""WITH m AS (SELECT protocol_id, table_number, row_position, unnest({_MARKERS.format('annotation_markers')}) marker FROM soa_activities),
 d AS (SELECT protocol_id, table_number, row_position, unnest({_MARKERS.format('annotation_markers')}) marker FROM schedule_cells)
 SELECT DISTINCT d.* FROM d WHERE EXISTS (SELECT 1 FROM m WHERE m.protocol_id = d.protocol_id AND m.table_number = d.table_number AND m.marker = d.marker)
  AND NOT EXISTS (SELECT 1 FROM m WHERE m.protocol_id = d.protocol_id AND m.table_number = d.table_number AND m.marker = d.marker AND m.row_position = d.row_position)""")
def partial_bindings(spark, sf):
    rows = lambda t: T(spark, sf, t).select(*_KEY2, "row_position", F.explode(text.marker_list(F.col("annotation_markers"))).alias("marker"))
    return quality.partial_bindings(rows("schedule_cells"), rows("soa_activities"), [*_KEY2, "marker"], "row_position")


@query("""SELECT protocol_id, table_number, count(*) n FROM soa_annotations GROUP BY 1, 2 HAVING count(*) > 2 AND bool_and(regexp_replace(lower(annotation_type), '[^a-z]', '', 'g') = 'footnote')""")
def uniform_typing(spark, sf):
    """Tables of more than two notes that are all footnotes, however that is spelt."""
    notes = T(spark, sf, "soa_annotations").withColumn("kind", F.regexp_replace(F.lower("annotation_type"), "[^a-z]", ""))
    return quality.degenerate(notes, _KEY2, "kind", "footnote", more_than=2)


@query(f"""WITH h AS (SELECT DISTINCT protocol_id, activity_name FROM unified_activities WHERE is_section_header),
 m AS (SELECT protocol_id, table_number, activity_name, row_id, unnest({_MARKERS.format('annotation_markers')}) marker FROM soa_activities)
 SELECT DISTINCT annot_key, row_id FROM m JOIN h ON h.protocol_id = m.protocol_id AND h.activity_name = m.activity_name
  JOIN soa_annotations n ON n.protocol_id = m.protocol_id AND n.table_number = m.table_number AND n.annotation_marker = m.marker""")
def header_bound(spark, sf):
    """Notes that are bound to rows with the name of a section header."""
    heads = T(spark, sf, "unified_activities").where("is_section_header").select("protocol_id", "activity_name").distinct()
    acts = T(spark, sf, "soa_activities").join(heads, ["protocol_id", "activity_name"], "left_semi")
    marks = xref.references(acts, _KEY2, F.col("row_id"), text.marker_list(F.col("annotation_markers")), "activity", F.col("row_id"))
    notes = T(spark, sf, "soa_annotations").select(*_KEY2, "annot_key", F.col("annotation_marker").alias("marker"))
    return xref.link(notes, marks, _KEY2).select("annot_key", F.col("element").alias("row_id")).distinct()


@query("""SELECT protocol_id, sha256(annotation_text) text_sha, count(DISTINCT annotation_marker) n_markers FROM soa_annotations WHERE length(annotation_text) >= 25 GROUP BY 1, annotation_text HAVING count(DISTINCT annotation_marker) > 1""")
def identical_texts(spark, sf):
    return quality.identical_texts(T(spark, sf, "soa_annotations"), ["protocol_id"], "annotation_text", "annotation_marker")


@query("""WITH r AS (SELECT protocol_id, min(source_page) f, max(source_page) l FROM soa_activities WHERE source_page IS NOT NULL GROUP BY 1),
 w AS (SELECT protocol_id, unnest(range(f, l + 1))::INTEGER source_page FROM r) SELECT * FROM w ANTI JOIN soa_activities USING (protocol_id, source_page)""")
def page_gaps(spark, sf):
    """Pages between a protocol's first and last that no row stands on."""
    acts = T(spark, sf, "soa_activities").where("source_page is not null")
    spans = acts.groupBy("protocol_id").agg(F.min("source_page").alias("f"), F.max("source_page").alias("l"))
    return quality.coverage_gaps(spans, ["protocol_id"], "f", "l", acts, "source_page")


_CUT = "TIMESTAMP '2024-07-01'"


@query(f"""WITH o AS (SELECT protocol_id, table_number, count(*) n, count(annotation_markers) m FROM soa_activities WHERE loaded_at < {_CUT} GROUP BY 1, 2),
 n AS (SELECT protocol_id, table_number, count(*) n, count(annotation_markers) m FROM soa_activities WHERE loaded_at >= {_CUT} GROUP BY 1, 2)
 SELECT coalesce(n.protocol_id, o.protocol_id) protocol_id, coalesce(n.table_number, o.table_number) table_number, CASE WHEN n.n IS NULL THEN 'missing' WHEN o.n IS NULL THEN 'added' ELSE 'both' END presence,
  coalesce(n.n, 0) - coalesce(o.n, 0) d_n, coalesce(n.m, 0) - coalesce(o.m, 0) d_m FROM o FULL JOIN n ON n.protocol_id = o.protocol_id AND n.table_number = o.table_number""")
def snapshot_delta(spark, sf):
    acts = T(spark, sf, "soa_activities")
    cut = F.lit("2024-07-01 00:00:00").cast("timestamp_ntz")
    metrics = lambda df: df.groupBy(*_KEY2).agg(F.count(F.lit(1)).alias("n"), F.count("annotation_markers").alias("m"))
    return quality.snapshot_delta(metrics(acts.where(F.col("loaded_at") < cut)), metrics(acts.where(F.col("loaded_at") >= cut)), _KEY2, ["n", "m"])


@query("""WITH k AS (SELECT 'extract_method:' || extract_method k FROM soa_activities WHERE coalesce(extract_method, '') <> '' UNION ALL SELECT 'match_status:' || match_status FROM unified_activities
  UNION ALL SELECT 'doc_kind:' || doc_kind FROM documents WHERE coalesce(doc_kind, '') <> '') SELECT k AS key, count(*) n FROM k GROUP BY 1""")
def provenance_counts(spark, sf):
    return quality.counted([("extract_method", T(spark, sf, "soa_activities"), "extract_method"), ("match_status", T(spark, sf, "unified_activities"), "match_status"), ("doc_kind", T(spark, sf, "documents"), "doc_kind")])


@query("""WITH p AS (SELECT event_id, CASE WHEN regexp_matches(props, '"k": ?[0-4]\\b') THEN 'low' WHEN regexp_matches(props, '"k"') THEN 'any' END pattern FROM events) SELECT pattern, count(*) n FROM p WHERE pattern IS NOT NULL GROUP BY 1""")
def first_patterns(spark, sf):
    return quality.first_pattern(T(spark, sf, "events"), "props", [("low", r'"k": ?[0-4]\b'), ("any", '"k"')]).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_type, count(*) n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 10""")
def top_types(spark, sf):
    return T(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "event_type").limit(10)


@query(f"""WITH f AS (SELECT ann_key, protocol_id, trim(unnest(string_split(annotation_text, ';'))) q FROM unified_annotations), n AS (SELECT ann_key, protocol_id, regexp_replace(q, '[{WS}]', '', 'g') q FROM f),
 s AS (SELECT DISTINCT protocol_id, regexp_replace(annotation_text, '[{WS}]', '', 'g') t FROM soa_annotations WHERE annotation_text IS NOT NULL)
 SELECT DISTINCT n.ann_key, n.q FROM n WHERE length(n.q) BETWEEN 30 AND 400 AND EXISTS (SELECT 1 FROM s WHERE s.protocol_id = n.protocol_id AND contains(s.t, n.q))""")
def verbatim_quotes(spark, sf):
    bare = lambda c: F.regexp_replace(c, f"[{WS}]", "")
    quotes = T(spark, sf, "unified_annotations").select("protocol_id", "ann_key", F.explode(F.split("annotation_text", ";")).alias("q")).select("protocol_id", "ann_key", bare(F.trim("q")).alias("q"))
    source = T(spark, sf, "soa_annotations").where("annotation_text is not null").select("protocol_id", bare(F.col("annotation_text")).alias("t")).distinct()
    return matching.contains_join(quotes.where("length(q) between 30 and 400"), source, ["protocol_id"], "q", "t", least=30).select("ann_key", "q").distinct()


# --- corrections ------------------------------------------------------------------------------------------------------------------

CORRECTIONS = [
    {"id": "c1", "op": "set", "match": {"p_partkey": 1}, "set": {"p_size": 99, "p_brand": None}},
    {"id": "c2", "op": "add", "set": {"p_partkey": -1, "p_name": "added", "p_size": 1}},
    {"id": "c3", "op": "remove", "match": {"p_size": 7}},
    {"id": "c4", "op": "set", "match": {"p_partkey": -1}, "set": {"p_size": 2}},
]


@query("""WITH a AS (SELECT p_partkey, p_name, CASE WHEN p_partkey = 1 THEN NULL ELSE p_brand END p_brand, CASE WHEN p_partkey = 1 THEN 99 ELSE p_size END p_size FROM part
  UNION ALL SELECT -1, 'added', NULL, 1) SELECT p_partkey, p_name, p_brand, CASE WHEN p_partkey = -1 THEN 2 ELSE p_size END p_size FROM a WHERE p_size IS DISTINCT FROM 7""")
def keyed_patch(spark, sf):
    parts = T(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", F.col("p_partkey").alias("pos"))
    return patch.apply_corrections(parts, CORRECTIONS).drop("pos")


# --- reports ------------------------------------------------------------------------------------------------------------------------


@query(f"""WITH {_LATEST} SELECT protocol_id, count(*) n, sum(table_count)::BIGINT n_sources, (sum(table_count) - count(*))::BIGINT folded, count(*) FILTER (table_count > 1) multi_table, count(*) FILTER (len(name_variations) > 1) with_variants,
  count(*) FILTER (coalesce(is_redacted, false)) redacted, CASE WHEN sum(table_count) > 0 THEN round_even((1 - count(*) / sum(table_count)) * 100, 0)::INTEGER ELSE 0 END compression FROM latest GROUP BY 1""")
def inventory_rollup(spark, sf):
    per = latest_activities(spark, sf).groupBy("protocol_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("table_count").alias("n_sources"), (F.sum("table_count") - F.count(F.lit(1))).alias("folded"), F.count_if(F.col("table_count") > 1).alias("multi_table"),
        F.count_if(F.size("name_variations") > 1).alias("with_variants"), F.count_if(F.coalesce("is_redacted", F.lit(False))).alias("redacted"),
    )
    return per.withColumn("compression", report.percent_less(F.col("n"), F.col("n_sources")))


@query("""SELECT protocol_id, """ + ", ".join(f"count(*) FILTER (match_status = '{s}') n_{s}" for s in ("exact", "fuzzy_auto", "fuzzy_cross_parent", "fuzzy_review", "new")) + " FROM unified_activities GROUP BY 1")
def match_statistics(spark, sf):
    return report.zero_filled(T(spark, sf, "unified_activities"), ["protocol_id"], "match_status", ["exact", "fuzzy_auto", "fuzzy_cross_parent", "fuzzy_review", "new"])


@query("""SELECT sponsor, count(DISTINCT protocol_id) n FROM protocols WHERE trim(coalesce(sponsor, '')) <> '' GROUP BY 1""")
def sponsor_counts(spark, sf):
    return T(spark, sf, "protocols").where(~text.is_blank(F.col("sponsor"))).groupBy("sponsor").agg(F.countDistinct("protocol_id").alias("n"))


@query("""SELECT p.protocol_id, p.study_code, count(a.row_id) n_rows FROM protocols p LEFT JOIN soa_activities a USING (protocol_id) WHERE trim(coalesce(p.excluded_reason, '')) = '' GROUP BY 1, 2""")
def collection_index(spark, sf):
    kept = T(spark, sf, "protocols").where(text.is_blank(F.col("excluded_reason"))).select("protocol_id", "study_code")
    rows = T(spark, sf, "soa_activities").groupBy("protocol_id").agg(F.count(F.lit(1)).alias("n"))
    return kept.join(rows, "protocol_id", "left").select("protocol_id", "study_code", F.coalesce("n", F.lit(0)).alias("n_rows"))


@query("""SELECT a.row_id, p.sponsor, a.activity_name FROM soa_activities a LEFT JOIN protocols p USING (protocol_id) WHERE contains(lower(concat_ws(' ', a.activity_name, p.sponsor)), 'panel') AND a.annotation_markers IS NOT NULL""")
def inventory_search(spark, sf):
    rows = T(spark, sf, "soa_activities").join(T(spark, sf, "protocols").select("protocol_id", "sponsor"), "protocol_id", "left").withColumn("marked", F.col("annotation_markers").isNotNull())
    return report.search(rows, ["activity_name", "sponsor"], needle="Panel", need=["marked"]).select("row_id", "sponsor", "activity_name")


@query(f"""WITH {_LATEST}, occ AS (SELECT a.protocol_id, a.activity_name, count(*) n_rows, count(DISTINCT a.table_number) n_tables, count(a.annotation_markers) n_marked FROM soa_activities a GROUP BY 1, 2)
 SELECT l.protocol_id, l.xact_id, coalesce(n_rows, 0) n_rows, coalesce(n_tables, 0) n_tables, coalesce(n_marked, 0) > 0 any_marks FROM latest l LEFT JOIN occ ON occ.protocol_id = l.protocol_id AND occ.activity_name = l.activity_name""")
def inventory_entities(spark, sf):
    occ = T(spark, sf, "soa_activities").groupBy("protocol_id", "activity_name").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("table_number").alias("n_tables"), F.count("annotation_markers").alias("n_marked"))
    both = latest_activities(spark, sf).join(occ, ["protocol_id", "activity_name"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return both.select("protocol_id", "xact_id", zero("n_rows").alias("n_rows"), zero("n_tables").alias("n_tables"), (zero("n_marked") > 0).alias("any_marks"))


@query("""WITH t AS (SELECT protocol_id, count(DISTINCT table_number) n_tables FROM soa_activities GROUP BY 1),
 p AS (SELECT protocol_id, row_position, count(DISTINCT table_number) n, count(DISTINCT indentation_level) n_types, count(DISTINCT activity_name) n_names FROM soa_activities GROUP BY 1, 2)
 SELECT p.*, n_tables, CASE WHEN n < n_tables THEN n || '/' || n_tables || ' tables' WHEN n_types = 1 AND n_names = 1 THEN 'Identical' WHEN n_types = 1 THEN 'Same type' ELSE 'Differs' END conclusion FROM p JOIN t USING (protocol_id)""")
def property_comparison(spark, sf):
    acts = T(spark, sf, "soa_activities")
    tables = acts.groupBy("protocol_id").agg(F.countDistinct("table_number").alias("n_tables"))
    return report.compare_properties(acts, ["protocol_id", "row_position"], "table_number", "indentation_level", "activity_name", tables)


@query(f"""WITH t AS (SELECT protocol_id, count(DISTINCT track_label) n_tracks FROM unified_activities WHERE track_label IS NOT NULL GROUP BY 1),
 c AS (SELECT protocol_id, activity_name, count(DISTINCT track_label) n_with FROM unified_activities WHERE track_label IS NOT NULL GROUP BY 1, 2)
 SELECT c.*, n_tracks, n_with >= n_tracks common FROM c JOIN t USING (protocol_id)""")
def track_commonality(spark, sf):
    return report.commonality(T(spark, sf, "unified_activities"), ["protocol_id"], ["activity_name"], "track_label", "activity_name")


@query("""WITH f AS (SELECT protocol_id, track_label, min(act_key) o FROM unified_activities WHERE track_label IS NOT NULL GROUP BY 1, 2)
 SELECT protocol_id, track_label, ((row_number() OVER (PARTITION BY protocol_id ORDER BY o, track_label) - 1) % 6)::INTEGER colour FROM f""")
def track_colours(spark, sf):
    return report.colour_index(T(spark, sf, "unified_activities"), ["protocol_id"], "track_label", "act_key")


@query("""WITH o AS (SELECT ann_key, annotation_type, CASE annotation_type WHEN 'footnote' THEN 1 WHEN 'abbreviation' THEN 2 WHEN 'legend' THEN 3 WHEN 'source_note' THEN 4 WHEN 'continuation_note' THEN 5 ELSE 0 END k FROM unified_annotations)
 SELECT ann_key, k::INTEGER type_rank FROM o""")
def note_type_order(spark, sf):
    order = F.array(*[F.lit(k) for k in classify.NOTE_ORDER])
    return T(spark, sf, "unified_annotations").select("ann_key", F.array_position(order, F.col("annotation_type")).cast("int").alias("type_rank"))


@query("""SELECT protocol_id, CASE WHEN sum(is_err) > 0 THEN 'failed' WHEN sum(is_warn) > 0 THEN 'resolved_with_warnings' ELSE 'resolved' END status FROM (
  SELECT protocol_id, (activity_name IS NULL)::INTEGER is_err, (source_page IS NULL)::INTEGER is_warn FROM soa_activities) GROUP BY 1""")
def status_ladder(spark, sf):
    n = T(spark, sf, "soa_activities").groupBy("protocol_id").agg(F.count_if(F.col("activity_name").isNull()).alias("e"), F.count_if(F.col("source_page").isNull()).alias("w"))
    return n.select("protocol_id", classify.status(F.col("e"), F.col("w")).alias("status"))
