"""Queries of acceptance and of documents written back, over the payloads of raw_records and the tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions import text
from gridweave.functions.text import WS
from gridweave.plans import consolidate, document_out, gates, page_audit, resolve
from gridweave.plans.catalogue import _MARKERS, _NORM_NOTE, _SQUEEZE
from gridweave.plans.pipeline_queries import _CONSOLIDATED, _DOCS, _RESOLVED, _docs
from gridweave.plans.problems import table
from gridweave.session import kept, materialise


def gate_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return gates.metrics(_docs(spark, sf))


def gate_findings(spark: SparkSession, sf: str) -> DataFrame:
    return gates.findings(_docs(spark, sf))


def gate_bindings(spark: SparkSession, sf: str) -> DataFrame:
    """Findings against a baseline of tables that carried three markers more, and of one table more in each protocol."""
    docs = _docs(spark, sf)
    m = gates.metrics(docs)
    more = m.groupBy("protocol_id").agg((F.max("table_number") + 1).alias("table_number")).select("protocol_id", "table_number", F.lit(0).alias("acts"), F.lit(0).alias("bind"))
    baseline = m.select(*resolve.KEY, "acts", (F.col("bind") + 3).alias("bind")).unionByName(more)
    return gates.findings(docs, baseline).where("gate in ('12 bindings', 'missing')")


def quote_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """Consolidated notes as quotations, looked for in the notes of the schedules."""
    notes = table(spark, sf, "unified_annotations").where(~F.col("annotation_text").rlike(r'["“”]|\n\s*\n'))
    reports = notes.select("protocol_id", F.concat(F.lit('It reads "'), "annotation_text", F.lit('" there.')).alias("report"))
    sources = table(spark, sf, "soa_annotations").where("annotation_text is not null").select("protocol_id", F.col("annotation_text").alias("source"))
    return gates.quote_check(reports, sources, ["protocol_id"])


def page_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Pages that rows stand on as an excerpt of the declared ones; odd studies have their extra pages in front."""
    studies = table(spark, sf, "protocols").select(F.col("protocol_id").alias("study"), text.page_range(F.col("soa_pages")).alias("r"))
    found = table(spark, sf, "soa_activities").groupBy(F.col("protocol_id").alias("study")).agg(F.countDistinct("source_page").cast("int").alias("n_pages"))
    both = studies.select("study", F.col("r.first").alias("first"), F.col("r.last").alias("last")).join(found, "study", "left")
    decided = gates.page_decisions(both, front=F.col("study").rlike("[13579]$"), back=F.col("study").rlike("[02]$"))
    return decided.select("study", "decision", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("pages"))


def _transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Events as lines of transcripts: each a tool call two levels deep."""
    e = table(spark, sf, "events")
    call = F.struct(F.lit("tool_use").alias("type"), F.col("event_type").alias("name"), F.struct(F.col("props").alias("given"), F.concat(F.lit("/work/S"), F.pmod("user_id", F.lit(7)).cast("string")).alias("path")).alias("input"))
    return e.select(F.concat(F.lit("runs/S"), F.pmod("event_id", F.lit(7)).cast("string"), F.lit(".jsonl")).alias("file"), F.to_json(F.struct(F.struct(F.array(call).alias("content")).alias("message"))).alias("value"))


_FORBIDDEN = [(r'\\"k\\": ?[0-4]\b', "low"), (r'\\"k\\": ?[5-9]\b', "high")]


def call_leaks(spark: SparkSession, sf: str) -> DataFrame:
    leaks = gates.call_findings(_transcripts(spark, sf), _FORBIDDEN, r"S\d+", r"/work/(S\d+)")[1]
    return leaks.groupBy("file", "tool", "what").agg(F.count(F.lit(1)).alias("n"))


def call_crosses(spark: SparkSession, sf: str) -> DataFrame:
    crosses = gates.call_findings(_transcripts(spark, sf), _FORBIDDEN, r"S\d+", r"/work/(S\d+)")[2]
    return crosses.groupBy("mine", "other").agg(F.count(F.lit(1)).alias("n"))


def structure_findings(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "raw_records").where("record_kind = 'consolidated' and payload is not null")
    return document_out.structure_findings(docs, "record_id", "payload")


def resolved_documents(spark: SparkSession, sf: str) -> DataFrame:
    """What the written documents say, read back from their text."""
    docs = _docs(spark, sf)
    r = resolve.resolve(docs, kept)
    r.warnings = kept(r.warnings, "warnings")
    d = document_out.resolved_documents(docs, r)
    at = lambda path: F.get_json_object("text", path)
    size = lambda a: F.json_array_length(at(f"$.{a}"))
    return d.select(
        "protocol_id", "table_number", "name", at("$.schema_name").alias("schema_name"), at("$.table_metadata.table_id").alias("table_id"), at("$.resolution_metadata.resolution_status").alias("status"),
        *[size(a).alias(f"n_{a}") for a in ("schedule_properties", "schedule_columns", "activities", "activity_schedule", "annotations")],
        at("$.activities[0].activity_name").alias("first_activity"), at("$.annotations[0].annotation_scope").alias("first_scope"),
    )


def consolidated_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf)
    r = resolve.resolve(docs, kept)
    d = document_out.consolidated_documents(r, consolidate.consolidate(r))
    at = lambda path: F.get_json_object("text", path)
    return d.select(
        "protocol_id", "name", at("$.schema_version").alias("schema_version"), F.json_array_length(at("$.unified_activities")).alias("n_activities"), F.coalesce(F.json_array_length(at("$.schedule_matrix")), F.lit(0)).alias("n_cells"),
        F.json_array_length(at("$.timeline_segments.main")).alias("n_main"), at("$.unified_activities[0].xact_id").alias("first_id"), at("$.consolidation_metadata.source_activity_count").cast("long").alias("n_sources"),
    )


def _reads(spark: SparkSession, sf: str) -> DataFrame:
    """Delivered rows as what pages print."""
    rows = table(spark, sf, "soa_activities").where("source_page is not null and activity_name is not null").select("protocol_id", F.col("source_page").alias("page"), F.struct(F.col("row_id").alias("row"), F.lit(0.0).alias("y0"), F.lit(1.0).alias("y1"), F.array("activity_name").alias("texts")).alias("r"))
    return rows.groupBy("protocol_id", "page").agg(F.sort_array(F.collect_list("r")).alias("rows")).select(
        "protocol_id", "page", F.lit(None).cast("string").alias("caption"), F.lit(True).alias("has_grid"), F.lit(True).alias("has_text"), F.lit(3).alias("mark_columns"), F.lit(False).alias("rotated"), "rows"
    )


def row_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The row audit of the delivered rows against the extractions of raw_records, table by table."""
    docs = _docs(spark, sf)
    t = page_audit.audit_collection(materialise(_reads(spark, sf), "reads"), docs).tables
    return t.withColumn("pages", F.array_join(F.transform("pages", lambda p: p.cast("string")), ","))


def row_audit_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf)
    return page_audit.audit_counts(materialise(_reads(spark, sf), "reads"), docs)


QUERIES = {
    f.__name__: f
    for f in (gate_metrics, gate_findings, gate_bindings, quote_verdicts, page_decisions, call_leaks, call_crosses, structure_findings, resolved_documents, consolidated_documents, row_audit, row_audit_counts)
}

_E = lambda name: f"(SELECT protocol_id, t, unnest(range(1, len(x) + 1))::INTEGER pos, unnest(x) e FROM (SELECT protocol_id, t, json_extract(j, '$.{name}[*]') x FROM docs))"
_GATES = f"""{_DOCS}, meta AS (SELECT *, j->>'$.table_metadata.table_type' ttype, (j->>'$.table_metadata.page_start')::INTEGER f, (j->>'$.table_metadata.page_end')::INTEGER l, j->>'$.table_metadata.track_label' track FROM docs),
 marked AS (SELECT DISTINCT protocol_id, t, row_position, unnest({_MARKERS.format('m')}) marker FROM (SELECT protocol_id, t, (e->>'$.row_position')::INTEGER row_position, e->>'$.annotation_markers' m FROM
   (SELECT * FROM {_E('schedule_properties')} UNION ALL SELECT * FROM {_E('activities')} UNION ALL SELECT * FROM {_E('activity_schedule')} UNION ALL SELECT * FROM {_E('schedule_grid')}))),
 notes AS (SELECT protocol_id, t, pos, e->>'$.annotation_marker' marker, e->>'$.annotation_type' kind, e->>'$.annotation_text' txt, json_extract(e, '$.marker_locations[*]') places FROM {_E('annotations')}),
 placed AS (SELECT * FROM (SELECT protocol_id, t, pos, marker, kind, l->>'$.location_type' lt, (l->>'$.row_position')::INTEGER row_position, l->>'$.method' how FROM (SELECT *, unnest(places) l FROM notes)) WHERE coalesce(lt, '') <> 'unresolved'),
 acts AS (SELECT protocol_id, t, (e->>'$.source_page')::INTEGER page FROM {_E('activities')}),
 texts AS (SELECT protocol_id, t, marker, {_NORM_NOTE.format("coalesce(txt, '')")} k FROM notes WHERE length({_NORM_NOTE.format("coalesce(txt, '')")}) >= 25),
 bound AS (SELECT protocol_id, t, count(DISTINCT marker)::INTEGER bind FROM marked GROUP BY 1, 2),
 metrics AS (SELECT protocol_id, t table_number, ttype, concat_ws('-', f, l) pages, json_array_length(j, '$.activities')::INTEGER acts, coalesce(bind, 0) bind, json_array_length(j, '$.activity_schedule')::INTEGER marks,
   coalesce(CASE WHEN json_type(j, '$.schedule_properties') = 'ARRAY' THEN json_array_length(j, '$.schedule_properties') END, 0)::INTEGER props, json_array_length(j, '$.schedule_grid')::INTEGER grid, json_array_length(j, '$.annotations')::INTEGER ann,
   {", ".join(f"coalesce(len(list_filter(j->>'$.annotations[*].annotation_type', lambda x: x = '{k}')), 0)::INTEGER {n}" for k, n in (("footnote", "fn"), ("source_note", "sn"), ("abbreviation", "ab"), ("legend", "lg")))}
   FROM meta LEFT JOIN bound USING (protocol_id, t)),
 unbound AS (SELECT protocol_id, t, pos, marker, bool_and(coalesce(lt, '') = 'schedule_property') scoped, bool_and(coalesce(how, '') = 'synthesized') made, bool_and(how IS NULL) silent FROM placed p
   WHERE coalesce(kind, '') NOT IN ('legend', 'abbreviation') AND NOT EXISTS (SELECT 1 FROM marked m WHERE m.protocol_id = p.protocol_id AND m.t = p.t AND m.marker = p.marker) GROUP BY 1, 2, 3, 4),
 paged AS (SELECT protocol_id, t, count(page) known, count(*) n FROM acts GROUP BY 1, 2),
 pages AS (SELECT m.protocol_id, m.t, unnest(range(f, l + 1)) p FROM meta m JOIN paged USING (protocol_id, t) WHERE known > 0 AND f <= l)"""

SQL = {
    "gate_metrics": f"WITH {_GATES} SELECT * FROM metrics",
    "gate_findings": f"""WITH {_GATES}, found AS (
      SELECT protocol_id, t, '1 schema' gate, 'FAIL' severity, coalesce(j->>'$.schema_name', '') subject FROM docs WHERE coalesce(j->>'$.schema_name', '') <> 'soa-table-extraction'
      UNION ALL SELECT protocol_id, t, '1 schema', 'FAIL', coalesce(j->>'$.schema_version', '') FROM docs WHERE coalesce(j->>'$.schema_version', '') <> '1.0'
      UNION ALL SELECT protocol_id, t, '1 schema', 'FAIL', coalesce(j->>'$.extraction_metadata.extraction_status', '') FROM docs WHERE coalesce(j->>'$.extraction_metadata.extraction_status', '') <> 'ready_for_resolution'
      UNION ALL SELECT protocol_id, t, '2 orphan', 'FAIL', marker FROM notes WHERE coalesce(len(places), 0) = 0
      UNION ALL SELECT protocol_id, t, '3 binding', 'FAIL', marker || ' ' || row_position FROM (SELECT DISTINCT protocol_id, t, marker, row_position FROM placed) p
        WHERE EXISTS (SELECT 1 FROM marked m WHERE m.protocol_id = p.protocol_id AND m.t = p.t AND m.marker = p.marker) AND NOT EXISTS (SELECT 1 FROM marked m WHERE m.protocol_id = p.protocol_id AND m.t = p.t AND m.marker = p.marker AND m.row_position = p.row_position)
      UNION ALL SELECT protocol_id, t, '3 binding', CASE WHEN scoped AND silent THEN 'CHECK' ELSE 'FAIL' END, marker FROM unbound WHERE NOT (scoped AND made)
      UNION ALL SELECT a.protocol_id, a.t, '4 containment', 'CHECK', a.marker FROM texts a JOIN (SELECT DISTINCT protocol_id, t, k FROM texts) b ON a.protocol_id = b.protocol_id AND a.t = b.t AND a.k <> b.k AND contains(b.k, a.k)
      UNION ALL SELECT protocol_id, t, '4 duplicate-text', 'CHECK', count(*)::VARCHAR FROM texts GROUP BY protocol_id, t, k HAVING count(*) > 1
      UNION ALL SELECT protocol_id, t, '5a typing', 'CHECK', marker FROM notes WHERE regexp_matches(trim(txt), '(?i)^(see|refer to)\\b') AND length(txt) <= 130 AND NOT contains(regexp_replace(trim(txt), '\\.$', ''), '. ') AND NOT contains(regexp_replace(trim(txt), '\\.$', ''), '; ')
        AND coalesce(kind, '') <> 'source_note'
      UNION ALL SELECT protocol_id, t, '5 typing', 'FAIL', count(*)::VARCHAR FROM notes GROUP BY 1, 2 HAVING count(*) > 20 AND bool_and(coalesce(kind = 'source_note', false))
      UNION ALL SELECT protocol_id, t, '6 coverage', 'WARN', CASE WHEN known = 0 THEN 'no page' ELSE (n - known)::VARCHAR END FROM paged WHERE known < n
      UNION ALL SELECT protocol_id, t, '6 coverage', 'WARN', 'page ' || p FROM pages WHERE NOT EXISTS (SELECT 1 FROM acts a WHERE a.protocol_id = pages.protocol_id AND a.t = pages.t AND a.page = p)
      UNION ALL SELECT protocol_id, t, '10 track', 'FAIL', 'no label' FROM meta WHERE ttype = 'track' AND coalesce(track, '') = ''
      UNION ALL SELECT protocol_id, t, '10 track', 'FAIL', track FROM meta WHERE coalesce(ttype, '') <> 'track' AND coalesce(track, '') <> ''
      UNION ALL SELECT protocol_id, t, '10 track', 'CHECK', track FROM meta WHERE len(list_filter(regexp_split_to_array(track, '[\\s/,]+'), lambda w: w NOT IN ('', '-', '&') AND lower(w) <> 'and')) > 4)
      SELECT protocol_id, t table_number, gate, severity, subject FROM found""",
    "gate_bindings": f"""WITH {_GATES} SELECT protocol_id, table_number, '12 bindings' gate, CASE WHEN bind * 2 < bind + 3 THEN 'FAIL' ELSE 'CHECK' END severity, (bind + 3) || ' to ' || bind subject FROM metrics
      UNION ALL SELECT protocol_id, max(table_number) + 1, 'missing', 'FAIL', 'table of the baseline' FROM metrics GROUP BY 1""",
    "quote_verdicts": f"""WITH q0 AS (SELECT DISTINCT protocol_id, {_SQUEEZE.format('annotation_text')} quote FROM unified_annotations WHERE NOT regexp_matches(annotation_text, '["“”]|\\n\\s*\\n')),
      q AS (SELECT *, list_filter(regexp_split_to_array(quote, '\\s*(?:…|\\.\\.\\.)\\s*'), lambda f: length(f) >= 15) f FROM q0 WHERE length(quote) BETWEEN 30 AND 400),
      s AS (SELECT protocol_id, list(DISTINCT {_SQUEEZE.format('annotation_text')}) s, list(DISTINCT regexp_replace(annotation_text, '[{WS}]+', '', 'g')) b FROM soa_annotations WHERE annotation_text IS NOT NULL GROUP BY 1),
      j AS (SELECT q.*, len(f) n, len(list_filter(f, lambda x: len(list_filter(s, lambda y: contains(y, x))) > 0)) e, len(list_filter(f, lambda x: len(list_filter(b, lambda y: contains(y, regexp_replace(x, '[{WS}]+', '', 'g')))) > 0)) l FROM q LEFT JOIN s USING (protocol_id))
      SELECT protocol_id, quote, CASE WHEN regexp_matches(quote, '\\*\\*|\\||`|_[a-z]|\\.(json|md|pdf)\\b|§|→') OR len(string_split(quote, ' ')) < 4 OR n = 0 THEN 'skipped' WHEN e = n THEN 'exact' WHEN l = n THEN 'loose' ELSE 'not_found' END verdict FROM j""",
    "page_decisions": """WITH n AS (SELECT protocol_id, count(DISTINCT source_page)::INTEGER n FROM soa_activities GROUP BY 1),
      p AS (SELECT protocol_id study, n, CASE WHEN regexp_full_match(soa_pages, '\\d+') THEN soa_pages::INTEGER WHEN regexp_full_match(soa_pages, '\\d+-\\d+') THEN split_part(soa_pages, '-', 1)::INTEGER END a,
        CASE WHEN regexp_full_match(soa_pages, '\\d+') THEN soa_pages::INTEGER WHEN regexp_full_match(soa_pages, '\\d+-\\d+') THEN split_part(soa_pages, '-', 2)::INTEGER END b FROM protocols LEFT JOIN n USING (protocol_id)),
      d AS (SELECT *, CASE WHEN n IS NULL OR n < 1 OR a IS NULL THEN 'none' WHEN n = b - a + 1 THEN 'equal' WHEN n < b - a + 1 THEN 'fewer' WHEN regexp_matches(study, '[13579]$') THEN 'front' WHEN regexp_matches(study, '[02]$') THEN 'back' ELSE 'undecided' END decision FROM p)
      SELECT study, decision, CASE WHEN decision IN ('equal', 'back') THEN array_to_string(range(a, a + n), ',') WHEN decision = 'front' THEN array_to_string(range(b - n + 1, b + 1), ',') END pages FROM d""",
    "call_leaks": """SELECT 'runs/S' || event_id % 7 || '.jsonl' AS file, event_type tool, CASE WHEN regexp_matches(props, '"k": ?[0-4]\\b') THEN 'low' ELSE 'high' END what, count(*) n FROM events WHERE regexp_matches(props, '"k": ?[0-9]\\b') GROUP BY 1, 2, 3""",
    "call_crosses": """SELECT 'S' || event_id % 7 mine, 'S' || user_id % 7 other, count(*) n FROM events WHERE NOT coalesce(regexp_matches(props, '"k": ?[0-9]\\b'), false) AND event_id % 7 <> user_id % 7 GROUP BY 1, 2""",
    "structure_findings": """WITH d AS (SELECT record_id, CASE WHEN json_valid(payload) THEN payload::JSON END j FROM raw_records WHERE record_kind = 'consolidated' AND payload IS NOT NULL)
      SELECT record_id, 'error' severity, 'no_document' step, '' subject FROM d WHERE j IS NULL
      UNION ALL SELECT record_id, 'error', 'missing_field', f FROM d, (SELECT unnest(['schema_name', 'schema_version', 'protocol_id', 'consolidation_metadata', 'unified_activities', 'timeline_segments', 'schedule_matrix', 'unified_annotations']) f) WHERE j IS NOT NULL AND NOT list_contains(json_keys(j), f)
      UNION ALL SELECT record_id, 'error', 'schema_name', j->>'$.schema_name' FROM d WHERE j->>'$.schema_name' <> 'soa-tables-consolidated'
      UNION ALL SELECT record_id, 'warning', 'unknown_segment', s FROM (SELECT record_id, unnest(json_keys(j, '$.timeline_segments')) s FROM d) WHERE s NOT IN ('main', 'domain', 'track', 'subsidiary')""",
    "resolved_documents": f"""WITH {_RESOLVED}, w AS (SELECT protocol_id, table_number t, count(*) n FROM warnings GROUP BY 1, 2)
      SELECT protocol_id, t table_number, format('{{}}_Table_{{:02d}}_resolved.json', protocol_id, t) AS name, 'soa-table-resolved' schema_name, format('table-{{:03d}}', t) table_id, CASE WHEN w.n > 0 THEN 'resolved_with_warnings' ELSE 'resolved' END status,
       (SELECT count(*) FROM props x WHERE x.protocol_id = g.protocol_id AND x.t = g.t)::INTEGER n_schedule_properties, (SELECT count(DISTINCT column_position) FROM grid x WHERE x.protocol_id = g.protocol_id AND x.t = g.t)::INTEGER n_schedule_columns,
       (SELECT count(*) FROM acts0 x WHERE x.protocol_id = g.protocol_id AND x.t = g.t)::INTEGER n_activities, (SELECT count(*) FROM cells x WHERE x.protocol_id = g.protocol_id AND x.t = g.t)::INTEGER n_activity_schedule,
       (SELECT count(*) FROM notes x WHERE x.protocol_id = g.protocol_id AND x.t = g.t)::INTEGER n_annotations, (SELECT activity_name FROM acts0 x WHERE x.protocol_id = g.protocol_id AND x.t = g.t AND x.pos = 1) first_activity,
       (SELECT scope FROM annotations x WHERE x.protocol_id = g.protocol_id AND x.t = g.t AND x.pos = 1) first_scope FROM good g LEFT JOIN w USING (protocol_id, t)""",
    "consolidated_documents": f"""WITH RECURSIVE {_CONSOLIDATED}, p AS (SELECT DISTINCT protocol_id FROM docs), f AS (SELECT protocol_id, xact_id, row_number() OVER (PARTITION BY protocol_id ORDER BY display_order, xact_id) n FROM entities)
      SELECT p.protocol_id, p.protocol_id || '_consolidated.json' AS name, '1.1' schema_version, (SELECT count(*) FROM entities x WHERE x.protocol_id = p.protocol_id)::INTEGER n_activities, (SELECT count(*) FROM matrix x WHERE x.protocol_id = p.protocol_id)::INTEGER n_cells,
       (SELECT count(*) FROM columns_ x WHERE x.protocol_id = p.protocol_id AND segment = 'main')::INTEGER n_main, (SELECT xact_id FROM f WHERE f.protocol_id = p.protocol_id AND n = 1) first_id, (SELECT count(*) FROM sources x WHERE x.protocol_id = p.protocol_id) n_sources FROM p""",
}
