import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridweave.operators import islands
from gridweave.operators.patch import CorrectionError
from gridweave.plans import consolidate, corrections, document_out, gates, inventory, page_audit, pipeline, resolve, validate
from gridweave.sources import documents, sinks, tables
from gridweave.streaming import incremental


def extraction(number, kind, names, marks=(), notes=(), props=None, **meta):
    """A small extraction document: names as (name, indentation, markers), marks as (row, column, value)."""
    props = props or [("Visit", "visit", 1), ("Day", "study_day", 2)]
    return {
        "schema_name": "soa-table-extraction", "schema_version": "1.0", "extraction_metadata": {"extraction_status": "ready"},
        "table_metadata": {"table_number": number, "table_type": kind, "table_title": f"Table {number}", "table_purpose": "", "page_start": 1, "page_end": 2, **meta},
        "schedule_properties": [{"table_number": number, "row_position": i + 1, "property_name": n, "property_type": t, "property_comment": "c", "hierarchical_level": level} for i, (n, t, level) in enumerate(props)],
        "schedule_grid": [{"table_number": number, "row_position": r, "column_position": c, "cell_value": v, "merged_cell_range": m} for r, c, v, m in ((1, 1, "Visit", ""), (1, 2, "V1", "2:3"), (1, 3, "", "2:3"), (2, 2, "D1", ""), (2, 3, "D8", ""), (9, 3, "lost", ""))],
        "activities": [{"table_number": number, "row_position": 3 + i, "activity_name": n, "activity_name_source": {"cell_text": n, "indentation_level": d}, "annotation_markers": m} for i, (n, d, m) in enumerate(names)],
        "activity_schedule": [{"table_number": number, "row_position": r, "column_position": c, "cell_value": v} for r, c, v in marks],
        "annotations": [{"annotation_marker": m, "annotation_type": k, "annotation_text": t, "marker_locations": p} for m, k, t, p in notes],
    }


def write(root, protocol, docs, cars=()):
    for d in docs:
        at = root / "protocols" / protocol / "extracted"
        at.mkdir(parents=True, exist_ok=True)
        (at / f"{protocol}_Table_{d['table_metadata']['table_number']:02d}_extraction.json").write_text(json.dumps(d, ensure_ascii=False))
    for n, c in cars:
        (at / f"{protocol}_Table_{n:02d}_corrections.json").write_text(json.dumps({"corrections": c}))


@pytest.fixture(scope="module")
def collection(tmp_path_factory):
    root = tmp_path_factory.mktemp("collection")
    at = lambda row: [{"table_number": 1, "location_type": "activity_name", "row_position": row}]
    main = extraction(1, "main_soa", [("Lab", 0, ""), ("Blood count", 1, "a"), ("CCI", 1, ""), ("Vital signs", 0, "a,b")], [(4, 2, "X"), (5, 3, "daily"), (6, 2, "X"), (6, 2, "Y"), (8, 2, "X")],
                      [("a", "footnote", "Fasting  only.", at(4)), ("b", "footnote", "A=one; B=two", at(6)), ("z", "footnote", "Bound by place", at(4)), ("q", "footnote", "Nowhere", [])])
    track = extraction(2, "track", [("Lab", 0, ""), ("Blood count", 1, "c"), ("Vital signs (sitting)", 0, ""), ("New thing", 0, "")], [(4, 2, "X"), (6, 3, "X")], [("c", "footnote", "fasting only.", at(4))], track_label="Track A")
    ref = extraction(3, "reference", [("Other", 0, "r")], [], [("r", "source_note", "See Section 9", at(3))])
    write(root, "P1", [main, track, ref], [(1, [{"id": "1", "target": "activities", "op": "add", "set": {"table_number": 1, "row_position": 8, "activity_name": "Added row", "activity_name_source": {"indentation_level": 0}}, "reason": "r", "by": "b", "at": "t"}])])
    write(root, "P2", [extraction(1, "main_soa", [("Alone", 0, "")])])
    (root / "protocols" / "P2" / "extracted" / "P2_Table_02_extraction.json").write_text("{broken")
    return root


@pytest.fixture(scope="module")
def done(spark, collection, tmp_path_factory):
    return pipeline.run(spark, str(collection), str(tmp_path_factory.mktemp("out")))


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_resolved(done):
    r = done.results["resolve"]
    p1 = lambda df, t=1: df.where(f"protocol_id = 'P1' and table_number = {t}")
    assert rows(p1(r.columns), "column_id", "composite_label", "is_label_column") == [("col-001", "Visit", True), ("col-002", "V1 / D1", False), ("col-003", "V1 / D8", False)]
    acts = {a["activity_name"]: a for a in p1(r.activities).collect()}
    assert acts["Lab"]["is_section_header"] and not acts["Vital signs"]["is_section_header"] and acts["CCI"]["is_redacted"]
    assert acts["Blood count"]["parent_activity_id"] == acts["Lab"]["activity_id"] == "act-001" and acts["Added row"]["activity_id"] == "act-005"
    assert rows(p1(r.cells), "activity_id", "column_id", "cell_value", "cell_value_type") == [
        ("act-002", "col-002", "X", "marker"), ("act-003", "col-003", "daily", "frequency"), ("act-004", "col-002", "X", "marker"), ("act-004", "col-002", "Y", "other"), ("act-005", "col-002", "X", "marker")]
    assert rows(p1(r.annotations), "annotation_marker", "annotation_type", "annotation_scope") == [("a", "footnote", "activity"), ("b", "legend", "activity"), ("q", "footnote", "table"), ("z", "footnote", "table")]
    steps = {x["step"] for x in p1(r.warnings).collect()}
    assert {"no_location", "orphan"} <= steps and "undefined_markers" not in steps
    assert {(x["protocol_id"], x["status"]) for x in resolve.table_status(r).collect()} == {("P1", "resolved_with_warnings"), ("P1", "resolved"), ("P2", "resolved")}


def test_consolidated(done):
    c = done.results["consolidate"]
    acts = {a["activity_name"]: a for a in c.activities.where("protocol_id = 'P1'").collect()}
    assert set(acts) == {"Lab", "Blood count", "CCI", "Vital signs", "Added row", "New thing"}
    assert acts["Blood count"]["table_count"] == 2 and acts["Blood count"]["match_status"] == "exact" and acts["Blood count"]["parent_xact_id"] == acts["Lab"]["xact_id"]
    assert acts["Vital signs"]["name_variations"] == ["Vital signs", "Vital signs (sitting)"] and acts["Vital signs"]["match_status"] == "fuzzy_auto"
    order = [a for a, _ in sorted(((n, a["display_order"]) for n, a in acts.items()), key=lambda x: x[1])]
    assert order == ["Lab", "Blood count", "CCI", "Vital signs", "Added row", "New thing"]  # siblings by their first (table, row)
    seg = rows(c.columns.where("protocol_id = 'P1'"), "xcol_id", "segment", "population_track")
    assert seg == [("xcol-001", "main", None), ("xcol-002", "main", None), ("xcol-003", "track", "Track A"), ("xcol-004", "track", "Track A")]
    cell = {(r["xact_id"], r["xcol_id"]): r["consolidated_value"] for r in c.matrix.where("protocol_id = 'P1'").collect()}
    assert cell[acts["Vital signs"]["xact_id"], "xcol-001"] == "Y" and len(cell) == 6
    notes = {n["annotation_text"]: n for n in c.annotations.where("protocol_id = 'P1'").collect()}
    assert notes["Fasting  only."]["display_markers"] == "T1:a, T2:c" and notes["Fasting  only."]["occurrence_count"] == 2
    assert notes["Fasting  only."]["referenced_xacts"] == [acts["Blood count"]["xact_id"], acts["Vital signs"]["xact_id"]]
    assert notes["Bound by place"]["referenced_xacts"] == [acts["Blood count"]["xact_id"]] and notes["See Section 9"]["referenced_xacts"] == []
    s = c.stats.where("protocol_id = 'P1'").first()
    assert (s["source_activity_count"], s["unified_activity_count"], s["n_exact"], s["n_fuzzy_auto"], s["n_new"], s["compression_percent"]) == (9, 6, 2, 1, 6, 33)
    assert (s["source_annotation_count"], s["unified_annotation_count"], s["deduplication_percent"]) == (6, 5, 17) and s["by_type"] == {"footnote": 3, "legend": 1, "source_note": 1}


def test_findings_and_inventory(done, spark):
    assert [s for s, _ in done.errors] == ["resolve"] and "P2_Table_02" in done.errors[0][1] and rows(done.error_counts(), "step", "n") == [("resolve", 1)]
    found = {(r["protocol_id"], r["severity"], r["step"]) for r in done.results["validate"].collect()}
    assert ("P1", "warning", "orphan") in found and not [f for f in found if f[1] == "error"]
    stock = done.results["inventory"]
    n = stock["counts"].first()
    assert (n["protocols"], n["source_table_rows"], n["consolidated_activities"], n["folded"], n["multi_table_activities"], n["activities_with_wording_variants"], n["redacted_activities"]) == (2, 11, 7, 4, 3, 1, 1)
    row = stock["entities"].where("activity_name = 'Vital signs'").first()
    assert row["tables"] == [1, 2] and row["any_marks"] and [a["text"] for a in row["annotations"]] == ["Fasting  only."]
    html = sinks.page("Index <1>", stock["index"])
    assert "Index &lt;1&gt;" in html and "P1" in html


def test_findings_name_dangling_ids(done):
    c = done.results["consolidate"]
    broken = consolidate.Consolidated(**{**c.all(), "activities": c.activities.where("activity_name <> 'Blood count'").withColumn("xact_id", F.regexp_replace("xact_id", "^xact-001$", "xact-1O0"))})
    steps = {(r["step"], r["subject"]) for r in validate.findings(broken).where("severity = 'error'").collect()}
    assert ("matrix_activity", "xact-002") in steps and ("note_activity", "xact-002") in steps and ("id_form", "xact-1O0") in steps


def test_corrections(spark, tmp_path):
    doc = extraction(1, "main_soa", [("a", 0, ""), ("b", 0, "")])
    op = lambda **k: {"id": "x", "target": "activities", **k}
    assert len(corrections.correct(doc, [op(op="remove", match={"activity_name": "a"})])["activities"]) == 1
    assert corrections.correct(doc, [op(op="set", match={"activity_name": "a"}, set={"activity_name": "c"})])["activities"][0]["activity_name"] == "c" and doc["activities"][0]["activity_name"] == "a"
    for bad in (op(op="set", match={}, set={}), op(op="set", match={"activity_name": "z"}, set={}), op(op="remove", match={"activity_name": "z"}), op(op="x"), {"id": "y", "target": "other", "op": "add", "set": {}}):
        with pytest.raises(CorrectionError):
            corrections.correct(doc, [bad])
    assert len(corrections.correct(doc, [op(op="remove", match={"no_such_key": None})])["activities"]) == 0
    write(tmp_path, "P", [doc], [(1, [op(op="remove", match={"activity_name": "z"})])])
    with pytest.raises(ValueError, match="hits no rows"):
        pipeline.run(spark, str(tmp_path))


def test_sources(spark, tmp_path, collection):
    got = {r["protocol_id"]: r["n_extractions"] for r in documents.protocols_below(spark, str(collection)).collect()}
    assert got == {"P1": 3, "P2": 2}
    docs = documents.read_extractions(spark, str(collection))
    assert rows(docs, "protocol_id", "table_number") == [("P1", 1), ("P1", 2), ("P1", 3), ("P2", 1)]
    (tmp_path / "m.csv").write_text("protocol_id,nct_id,sponsor\n,N1,Acme\nP2,,\n,,x\n")
    studies = tables.read_manifest(spark, str(tmp_path / "m.csv"))
    assert rows(studies, "study_key") == [("N1",), ("P2",)]
    assert tables.read_manifest(spark, str(tmp_path / "none.csv")).count() == 0 and tables.read_descriptor(spark, str(tmp_path / "none.json")) == {}
    sheet = spark.createDataFrame([("P2", "3-5")], "study_key string, soa_pages string")
    assert rows(tables.merge_sheets(studies, sheet, ["soa_pages"]), "study_key", "soa_pages") == [("N1", None), ("P2", "3-5")]
    fields = inventory.study_fields(studies, {"therapeutic_area": {"rule": "first_token", "from": "study_key"}})
    assert rows(fields, "study_key", "sponsor", "therapeutic_area") == [("N1", "Acme", "N1"), ("P2", "", "P2")]
    lines = spark.createDataFrame([('{"message": {"content": [{"type": "tool_use", "name": "Read", "input": {"p": 1}}, {"type": "text"}]}}',), ("not json",), ('{"type": "tool_use", "name": "Top", "input": {}}',)], "value string")
    assert rows(tables.tool_calls(lines), "tool") == [("Read",), ("Top",)]
    strings = spark.createDataFrame([('{"key": "va\\"lue", "l": ["x", 3, {"k2": "\\u00e9"}]}',)], "t string")
    assert rows(tables.json_strings(strings, "t"), "value") == [('va"lue',), ("x",), ("é",)]
    new = spark.createDataFrame([("a", 2), ("b", 2), ("c", 2)], "k string, modified int")
    old = spark.createDataFrame([("a", 3), ("b", 1)], "k string, modified int")
    assert rows(tables.stale(new, old, "k"), "k") == [("b",), ("c",)]
    (tmp_path / "w.xml").write_text('<doc><page><word xMin="1" yMin="2" xMax="3" yMax="4">a\x02b</word></page></doc>'.replace("\x02", ""))
    assert rows(tables.read_words(spark, str(tmp_path / "w.xml")), "x0", "y1", "text") == [(1.0, 4.0, "ab")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, None)], "a int, b string, c string")
    assert df.select(sinks.to_document(F.struct("a", "b", "c"), ["b"]).alias("j")).first()["j"] == '{"a":1,"b":null}'
    sinks.write_documents(spark.createDataFrame([("n", "{}")], "name string, text string"), str(tmp_path / "d"))
    assert spark.read.text(str(tmp_path / "d" / "document=n")).first()[0] == "{}"
    assert df.select(sinks.script_safe(F.lit("</x>")).alias("s")).first()["s"] == "<\\/x>"


def test_stream(spark, collection, tmp_path):
    def go():
        incremental.resolve_arriving(spark, str(collection), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
        return spark.read.option("basePath", str(tmp_path / "out")).parquet(str(tmp_path / "out" / "batch=*" / "activities")).count()

    assert go() == go() == 10
    events = spark.createDataFrame([("u", "2024-01-01 00:01:00", 1.0), ("u", "2024-01-01 00:02:00", 2.0), ("v", "2024-01-01 00:09:00", 4.0)], "k string, ts string, v double").selectExpr("k", "cast(ts as timestamp_ntz) ts", "v")
    assert rows(incremental.event_windows(events, "ts", "k", "v"), "k", "n", "total") == [("u", 2, 3.0), ("v", 1, 4.0)]


def test_consensus_of_rules(spark):
    """Three columns see the rules of a page; in the first a filled cell hides two of them, and the last has a stray one."""
    shared = list(range(100, 1000, 45))
    rules = [(c, y + c % 2) for c in range(3) for y in shared if not (c == 0 and y in (370, 415))] + [(2, 777)]

    def bands(some):
        df = spark.createDataFrame(some, "c int, p int").withColumn("g", F.lit(1))
        return sorted((r["a"], r["b"]) for r in islands.bands(islands.consensus(df, ["g"], "p", "c"), ["g"], "position", 6).collect())

    assert len(bands(rules)) == len(shared) - 1
    alone = bands([x for x in rules if x[0] == 0])
    assert len(alone) == len(shared) - 3 and (325, 460) in alone


def read_of(page, rows, caption="", marks=3, rotated=False):
    rows = [{"row": i, "y0": float(i), "y1": i + 1.0, "texts": t} for i, t in enumerate(rows)]
    return {"protocol_id": "P", "page": page, "caption": caption, "has_grid": True, "has_text": True, "mark_columns": marks, "rotated": rotated, "rows": rows}


def test_audit_finds_dropped_rows(spark):
    docs = [extraction(1, "main_soa", [(n, 0, "") for n in ("Vital signs", "Blood count (fasting)", "Skin inspection", "Never printed")], table_title="Schedule of all visits, one"), extraction(2, "track", [(n, 0, "") for n in ("Hearing test", "Sleep survey", "Vital signs")])]
    pages = [
        read_of(1, [["Schedule of visits", "x"], ["Vital signs1", "X"], ["Dropped row", "X"], ["Blood count", ""], ["n" * 160, ""], [" ", ""]], "scheduleofallvisitsone"),
        read_of(2, [["Skin inspection", "X"], ["Vital signs", ""], ["Other row", ""]]), read_of(3, [["Hearing test", "X"], ["Sleep survey", "X"]]),
        read_of(4, [["Unknown", ""], ["Things", ""], ["Only", ""]]), read_of(5, [["Vital signs", ""], ["Sleep survey", ""]], marks=0), read_of(6, [["Sleep survey", ""]], rotated=True),
    ]
    reads = spark.read.json(spark.sparkContext.parallelize([json.dumps(p) for p in pages]))
    parsed = documents.parse_extractions(spark.createDataFrame([("P", json.dumps(d)) for d in docs], "protocol_id string, text string"), "text", ["protocol_id"])
    got = page_audit.audit_collection(reads, parsed.select("protocol_id", F.col("doc.table_metadata.table_number").alias("table_number"), "doc"))
    assert rows(got.assignment, "page", "table") == [(1, 1), (2, 1), (3, 2)] and rows(got.orphan_pages, "page") == [(4,)]
    assert rows(got.unmatched, "page", "text", "is_note") == [(1, "Dropped row", False), (1, "n" * 160, True), (2, "Other row", False)]
    assert ("Never printed",) in rows(got.missing.where("table = 1"), "label") and ("Vital signs",) not in rows(got.missing.where("table = 1"), "label")
    assert rows(got.coverage, "page", "bands", "matched") == [(1, 6, 2), (2, 3, 2), (3, 2, 2)]
    t = got.totals.first()
    assert (t["on_page_not_extracted"], t["note_bands"]) == (2, 1)
    assert rows(got.counts, "protocols", "protocols_audited", "tables", "tables_without_pages", "pages_not_in_any_extraction", "on_page_not_extracted") == [(1, 1, 2, 0, 1, 2)]
    report = json.loads(page_audit.reports(got).first()["text"])
    assert [(x["table_number"], x["pages"]) for x in report["tables"]] == [(1, [1, 2]), (2, [3])] and report["pages_not_in_any_extraction"] == [4]
    assert [f["text"] for f in report["tables"][0]["on_page_not_extracted"] if not f["is_note"]] == ["Dropped row", "Other row"]


def test_detectors(spark):
    from gridweave.operators import quality

    s = "This sentence stands here twice."
    df = spark.createDataFrame([("twice", f"{s} Another one follows it. {s} Another one follows it."), ("once", f"{s} Nothing is repeated here.")], "x string, t string")
    assert {r["x"]: r["block_chars"] for r in quality.duplicated_blocks(df, "x", "t").collect()} == {"twice": len(s) + len("Another one follows it.")}
    notes = [("conflict", [1, 2], ["a", "b"]), ("agreed", [1, 2], ["a"]), ("one table", [1, 1], ["a", "b"]), ("legend", [1, 2], ["a", "b", "c"])]
    df = spark.createDataFrame(notes, "x string, t array<int>, n array<string>")
    assert [r["x"] for r in quality.binding_conflicts(df, ["x"], F.col("t"), F.col("n")).collect()] == ["conflict"]
    texts = ["take this with water daily", "Take this with  water daily and rest", "see section 4 of this text", "See Section 4 of this text now", "short", "short one"]
    df = spark.createDataFrame([("p", i, t) for i, t in enumerate(texts)], "g string, i int, t string")
    assert rows(quality.adjacent_containment(df, ["g"], ["i"], "i", "t"), "first", "second") == [(0, 1)]


def test_no_core_module_imports_the_llm_package():
    root = Path(__file__).parent.parent / "gridweave"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "gridweave.llm" not in p.read_text(), p
    assert os.path.exists(root / "plans" / "catalogue.py")


def test_tool_calls_at_any_depth(spark):
    deep = {"type": "tool_use", "name": "Deep", "input": {"a": ["é", {"type": "tool_use", "name": "Inner", "input": {}}]}}
    for _ in range(30):
        deep = {"message": [deep]}
    lines = spark.createDataFrame([(json.dumps(deep),), ("{broken",), (None,)], "value string")
    assert rows(tables.tool_calls(lines), "tool", "input") == [("Deep", '{"a":["é",{"type":"tool_use","name":"Inner","input":{}}]}'), ("Inner", "{}")]


def test_error_counts_count_all_findings(spark, tmp_path):
    found = spark.range(2500).selectExpr("'P' protocol_id", "'error' severity", "if(id < 1500, 'a', 'b') step", "cast(id as string) subject")
    ctx = pipeline.run(spark, str(tmp_path), steps=[("early", lambda c: c.errors.append(("early", "x"))), ("validate", lambda c: found)])
    assert rows(ctx.error_counts(), "step", "n") == [("a", 1500), ("b", 1000), ("early", 1)] and len(ctx.errors) == 1001


def test_documents_are_written_as_files(spark, collection, tmp_path):
    ctx = pipeline.run(spark, str(collection), str(tmp_path), protocols=["P1"])
    assert {r["protocol_id"] for r in ctx.results["resolve"].tables.collect()} == {"P1"}
    files = sorted(p.relative_to(tmp_path / "documents").as_posix() for p in (tmp_path / "documents").rglob("*.json"))
    assert any(f.startswith("P1/resolved/P1_Table_01") for f in files) and all(f.startswith("P1/") for f in files)
    assert not list((tmp_path / "documents").rglob(".*.json.*"))
    doc = json.loads((tmp_path / "documents" / next(f for f in files if "_Table_01_" in f and "resolved/" in f)).read_text())
    assert doc["schema_name"] == "soa-table-resolved" and doc["activities"] and "is_redacted" not in doc["activities"][0] and doc["activities"][0]["parent_activity_id"] is None
    whole = [json.loads(p.read_text()) for p in (tmp_path / "documents").rglob("*_consolidated.json")]
    for d in whole:
        assert set(d) >= set(document_out.REQUIRED) and set(d["timeline_segments"]) == set(document_out.SEGMENTS)
        ids = {a["xact_id"] for a in d["unified_activities"]}
        assert {c["xact_id"] for c in d["schedule_matrix"]} <= ids and all(a["source_refs"] for a in d["unified_activities"])
    assert (tmp_path / "documents" / "index.html").read_text().startswith("<!doctype html>")


def test_structure_of_documents(spark):
    good = {k: {} for k in document_out.REQUIRED} | {"schema_name": "soa-tables-consolidated", "timeline_segments": {"main": []}}
    texts = [json.dumps(good), json.dumps({k: v for k, v in good.items() if k != "schedule_matrix"}), json.dumps(good | {"schema_name": "x", "timeline_segments": {"main": [], "odd": []}}), "[1]", "{"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = rows(document_out.structure_findings(df, "i", "t"), "i", "severity", "step", "subject")
    assert got == [(1, "error", "missing_field", "schedule_matrix"), (2, "error", "schema_name", "x"), (2, "warning", "unknown_segment", "odd"), (3, "error", "no_document", ""), (4, "error", "no_document", "")]


def test_quotes(spark):
    source = "The visit may be held by telephone  where the site agrees.\nOther text of the schedule stands here."
    report = 'It says "The visit may be held by telephone where the site agrees." and\n"The visit may be heldby telephone where the site agrees".\n\nBut “this was never written in any of the sources”, nor "The visit may be held by … of the schedule stands here" or "some `code` that is quoted here for once".'
    got = gates.quote_check(spark.createDataFrame([("g", report)], "g string, report string"), spark.createDataFrame([("g", source)], "g string, source string"), ["g"])
    assert {r["quote"][:24]: r["verdict"] for r in got.collect()} == {
        "The visit may be held by": "exact", "The visit may be heldby ": "loose", "this was never written i": "not_found", "some `code` that is quot": "skipped",
    }


def test_page_maps(spark):
    df = spark.createDataFrame([("a", 3, 5, 3), ("b", 3, 5, 2), ("c", 3, 4, 4), ("d", 3, 4, 4), ("e", 3, 4, 4), ("f", 3, 4, None), ("g", 3, 9, 2)], "study string, first int, last int, n_pages int")
    s = F.col("study")
    d = gates.page_decisions(df, front=s == "c", back=s == "d", explicit=F.when(s == "g", F.array(F.lit(3), F.lit(9))))
    got = {r["study"]: (r["decision"], r["pages"]) for r in d.collect()}
    assert got == {"a": ("equal", [3, 4, 5]), "b": ("fewer", None), "c": ("front", [1, 2, 3, 4]), "d": ("back", [3, 4, 5, 6]), "e": ("undecided", None), "f": ("none", None), "g": ("explicit", [3, 9])}
    texts = {r["study"]: r["text"] for r in gates.page_map_text(d).collect()}
    assert set(texts) == set("acdg") and "| 3 | 5 | beyond the declared range" in texts["d"] and "beyond" not in texts["a"]


def test_excel_manifest(spark, tmp_path):
    import zipfile

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "m.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>protocol_id</t></si><si><t>sponsor</t></si><si><r><t>Ac</t></r><r><t>me</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2" t="inlineStr"><is><t>P1</t></is></c><c r="C2" t="s"><v>2</v></c></row><row><c r="C3"><v>7</v></c></row></sheetData></worksheet>')
    assert rows(tables.read_manifest(spark, str(tmp_path / "m.xlsx")), "study_key", "sponsor") == [("P1", "Acme")]
    (tmp_path / "bad.xlsx").write_bytes(b"no workbook")
    assert tables.read_manifest(spark, str(tmp_path / "bad.xlsx")).count() == 0


def test_broken_documents_are_errors(spark, tmp_path):
    at = tmp_path / "protocols" / "P9"
    at.mkdir(parents=True)
    (at / "P9_Table_01_extraction.json").write_text(json.dumps(extraction(1, "main_soa", [("Vital signs", 0, "")])))
    (at / "P9_Table_02_extraction.json").write_text("{broken")
    ctx = pipeline.run(spark, str(tmp_path))
    assert ctx.results["resolve"].tables.count() == 1 and any(step == "resolve" and "Table_02" in m for step, m in ctx.errors)
    assert {r["step"]: r["n"] for r in ctx.error_counts().collect()}["resolve"] == 1
