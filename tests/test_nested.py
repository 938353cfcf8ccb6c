import json

import pytest

from gridweave.operators import nested
from gridweave.plans.problems import CHILDREN


def rows(spark, payloads):
    df = spark.createDataFrame([(i, p, "clash") for i, p in enumerate(payloads)], "rid long, body string, child_name string")
    flat = nested.flatten(df, "rid", "body", CHILDREN)
    cols = ["record_id", "child_name", "parent_pos", "child_pos"]
    return sorted(tuple(r) for r in flat.select(*cols, nested.value_text().alias("v")).collect()), flat


def test_carriers_and_positions(spark):
    occ = [{"table_num": 1}, None, {"table_num": None}, {"marker": "x"}, {"table_num": "3"}, {"table_num": 4.0}, {"table_num": "05"}]
    doc = {
        "unified_annotations": [None, {"source_occurrences": occ, "referenced_xacts": ["x1", None, "x2"]}, {"source_occurrences": {"table_num": 9}, "referenced_xacts": "x3"},
                                {"source_occurrences": json.dumps([{"table_num": 7}]), "referenced_xacts": json.dumps(["x4"])}, {"source_occurrences": None, "referenced_xacts": []}, {}],
        "schedule_properties": json.dumps([{"property_name_source": {"row_position": 2}}, {"property_name_source": {}}, {"property_name_source": None}, {"property_name_source": {"row_position": "5"}}]),
    }
    got, flat = rows(spark, [json.dumps(doc)])
    s, x, p = "source_occurrences", "referenced_xacts", "property_name_source"
    assert got == sorted([
        (0, s, 2, 1, "1"), (0, s, 2, 5, "3"), (0, s, 2, 6, "4"), (0, s, 2, 7, "05"), (0, x, 2, 1, "x1"), (0, x, 2, 3, "x2"), (0, s, 3, 1, "9"), (0, x, 3, 1, "x3"),
        (0, s, 4, 1, "7"), (0, x, 4, 1, "x4"), (0, p, 1, 1, "2"), (0, p, 4, 1, "5"),
    ])
    assert {r["subtype"]: r["n_rows"] for r in nested.variants(flat, ["subtype"]).collect()} == {"int": 7, "text": 5}
    assert {r["variant"] for r in nested.variants(flat, ["child_name", "variant"]).collect()} >= {"source_occurrences/{table_num:int}", "source_occurrences/{table_num:int_text}", "referenced_xacts/text"}


def test_broken_payloads_give_nothing(spark):
    ok = '{"unified_annotations": {"referenced_xacts": "x"}}'
    bad = [None, "", " ", "null", "[1]", "3", ok[:-1], ok + " x", ok + ok, '{"a": NaN, "unified_annotations": {"referenced_xacts": "x"}}', "[" * 100000]
    got, _ = rows(spark, [*bad, ok, " " + ok + "\n", ok])
    assert [g[0] for g in got] == [len(bad), len(bad) + 1, len(bad) + 2]


def test_numbers_and_long_texts(spark):
    big = "1" + "0" * 30
    doc = '{"unified_annotations": [{"source_occurrences": [{"table_num": %s}, {"table_num": 1e2}, {"table_num": 1.5}, {"table_num": true}, {"table_num": [1, 2]}], "referenced_xacts": ["%s"]}]}' % (big, "y" * 200000)
    got, _ = rows(spark, [doc])
    assert [g[4] for g in got if g[1] == "source_occurrences"] == [big, "100", "1.5", "true", "[1,2]"]
    assert [len(g[4]) for g in got if g[1] == "referenced_xacts"] == [200000]


def test_automaton_names_shapes_once():
    a = nested.ShapeAutomaton()
    assert a.state({"b": 1, "a": [None, 2, "3"]}) == a.state({"a": ["7", 1, None, None], "b": 5}) == "{a:[int,int_text,null],b:int}"
    assert a.state({"b": "1"}) != a.state({"b": 1})


def test_empty_table(spark):
    got, flat = rows(spark, [])
    assert got == [] and nested.variants(flat, ["variant"]).count() == 0


def test_shapes_go_to_typed_tables(spark):
    doc = '{"unified_annotations": {"referenced_xacts": ["x", 3, "4", "04", true, 1.50, 12345678901234567890, {"a": 1}, null], "source_occurrences": [{"table_num": 2}, "{\\"table_num\\": 7}", {"table_num": 2.0}]}}'
    df = spark.createDataFrame([(1, doc), (2, "broken")], "rid long, body string")
    routed = nested.route_variants(df, "rid", "body", CHILDREN)
    values = lambda child, kind: [(r["parent_pos"], r["child_pos"], r["value"]) for r in routed.table(child, kind).orderBy("child_pos").collect()]
    assert values("referenced_xacts", "int") == [(1, 2, 3), (1, 3, 4)] and values("referenced_xacts", "text") == [(1, 1, "x"), (1, 4, "04")]
    assert values("referenced_xacts", "flag") == [(1, 5, True)] and values("referenced_xacts", "number") == [(1, 6, "1.5"), (1, 7, "12345678901234567890")]
    assert values("referenced_xacts", "json") == [(1, 8, '{"a":1}')] and values("source_occurrences", "int") == [(1, 1, 2), (1, 2, 7), (1, 3, 2)]
    assert routed.supertype().count() == 11
    plan = routed.table("referenced_xacts", "int")._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "child_name" in plan.split("PartitionFilters")[1]


def test_the_route_depends_on_the_shape_alone():
    a = nested.ShapeAutomaton()
    child = CHILDREN[1]
    one, two = a.state({"table_num": 1, "marker": "x"}), a.state({"marker": "y", "table_num": 9})
    assert one == two and a.route(child, one, None) is a.route(child, two, None) == nested.Route("int", False, "table_num")
    assert a.route(child, a.state({"marker": "x"}), None) is None and a.route(child, a.state("x"), None) is None


@pytest.mark.parametrize("text, want", [("1e30", "1" + "0" * 30), ("-0.0", "0"), ("-0", "0"), ("0e5", "0"), ("1.50e1", "15"), ("-12.5e-3", "-0.0125"), ("1e-2", "0.01"), ("100", "100"), ("9" * 6000, "9" * 6000), ("1e999999999", "1e999999999")])
def test_numbers_are_plain_decimals(text, want):
    assert nested.plain(nested.parse(text)[1]) == want


def test_deep_values_and_long_integers_lose_no_rows(spark):
    deep = "[" * 3000 + "1" + "]" * 3000
    objects = '{"a":' * 3000 + "1" + "}" * 3000
    doc = '{"unified_annotations": [{"referenced_xacts": ["x1", %s, %s, %s, "x2"]}]}' % (deep, objects, "9" * 5000)
    got, flat = rows(spark, [doc])
    assert [g[4] for g in got] == ["x1", deep, objects, "9" * 5000, "x2"]
    assert nested.variants(flat, ["variant"]).where("variant like '%deep:%'").count() == 2


def test_depth_has_no_limit(spark):
    deep = '{"a":[' * 50_000 + "null" + "]}" * 50_000
    doc = '{"skipped": %s, "unified_annotations": [{"referenced_xacts": ["x1", {"b": %s}]}]}' % (deep, deep)
    got, _ = rows(spark, [doc, doc[:-1], doc + "]"])
    assert [(g[0], g[3], len(g[4])) for g in got] == [(0, 1, 2), (0, 2, len(deep) + 6)]


@pytest.mark.parametrize("text", ['{"a" : [1, 2.5e3, "x\\n", null, true, {}, [], {"b": []}] } ', " [ ] ", '"x"', "-1.5", "nul", "[1,]", '{"a":}', '{"a" 1}', "[1 2]", "{1: 2}", "", "[", '{"a": 1', "01", "[NaN]", '"\t"'])
def test_the_deep_parser_reads_what_the_decoder_reads(text):
    ok, value = nested.parse(text)
    if ok:
        assert nested._parse_deep(text) == value
    else:
        with pytest.raises(ValueError):
            nested._parse_deep(text)
