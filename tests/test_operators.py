import functools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.functions import classify, text
from gridweave.operators import audit, fill, fold, geometry, hierarchy, ids, islands, matching, matrix, merge, patch, quality, report, skew, xref


def one(spark, expr):
    return spark.range(1).select(expr).first()[0]


def test_hot_keys_and_lookup(spark):
    df = spark.createDataFrame([("h", i) for i in range(50)] + [(c, 0) for c in "abc"] + [(None, 1)] * 60, "k string, v int")
    hot = skew.hot_keys(df, "k", least=10)
    assert hot == ["h"]
    table = spark.createDataFrame([("h", 1), ("a", 2)], "k string, w int")
    assert skew.lookup_join(df, table, "k", hot).groupBy("w").count().orderBy("w").collect() == [(1, 50), (2, 1)]
    assert skew.hot_keys(df.where("false"), "k") == []


@pytest.mark.parametrize("name, want", [("A-B/c (x) d", "a b c d"), ("  A\t b c ", "a b c"), ("(only)", ""), (None, None)])
def test_norm_name(spark, name, want):
    assert one(spark, text.norm_name(F.lit(name).cast("string"))) == want


def test_word_overlap(spark):
    assert one(spark, text.word_overlap(F.lit("Vital signs"), F.lit("vital-signs (sitting)"))) == 1.0
    assert one(spark, text.word_overlap(F.lit("ab"), F.lit("vital"))) == 0.0
    assert abs(one(spark, text.word_overlap(F.lit("blood cell count"), F.lit("blood count"))) - (0.6 + 0.4 * 2 / 3)) < 1e-12


@pytest.mark.parametrize("key, printed, want", [("abc", "xaxbxc", True), ("abc", "acb", False), ("", "x", True), ("aa", "a", False)])
def test_in_order(spark, key, printed, want):
    assert one(spark, text.contains_in_order(F.lit(key), F.lit(printed))) is want


@pytest.mark.parametrize("value, want", [(None, "empty"), (" \t", "empty"), (" x", "marker"), ("…", "continuation"), ("daily if", "frequency"), ("Day 1", "timing_text"), ("specified", "conditional"), ("5 mL", "other")])
def test_cell_kind(spark, value, want):
    assert one(spark, classify.cell_kind(F.lit(value).cast("string"))) == want


@pytest.mark.parametrize("value, want", [("A=b; C=d", True), ("A=b; clipped", True), ("A = alone", False), ("x; y", False), ("", False), (None, False), ("1a=b; c", False)])
def test_legend(spark, value, want):
    assert one(spark, classify.is_legend(F.lit(value).cast("string"))) is want


@pytest.mark.parametrize("value, want", [("CCI", True), (" CCI (redacted) ", True), ("CCI x", False), ("xCCI", False), (None, False)])
def test_redacted(spark, value, want):
    assert one(spark, classify.is_redacted(F.lit(value).cast("string"))) is want


@pytest.mark.parametrize("value, first, last", [("a_b_c", "a", "c"), ("a", "a", ""), ("a_NCT1", "a", ""), (None, "", ""), ("", "", "")])
def test_derived(spark, value, first, last):
    c = F.lit(value).cast("string")
    assert (one(spark, classify.derived("first_token", c)), one(spark, classify.derived("last_token_unless_nct", c))) == (first, last)
    with pytest.raises(ValueError):
        classify.derived("other", c)


def test_small_text_functions(spark):
    assert one(spark, text.sentences(F.lit("First sentence here. Second one; short. And the third one:\nlast long part"))) == ["First sentence here.", "And the third one:"] + ["last long part"][:0]
    assert one(spark, text.quoted_spans(F.lit('a "' + "x" * 30 + '" b "short"'))) == ["x" * 30]
    assert one(spark, text.preview(F.lit("x" * 130))) == "x" * 117 + "..."
    assert one(spark, text.page_range(F.lit(" 3 - 7 ")))["n"] == 5 and one(spark, text.page_range(F.lit("4")))["last"] == 4 and one(spark, text.page_range(F.lit("x"))) is None
    assert one(spark, classify.resolved_name(F.lit("T_extraction.verified.json"))) == one(spark, classify.resolved_name(F.lit("T_extraction.json"))) == "T_resolved.json"
    assert one(spark, classify.track_name(F.lit(""), F.lit("for Non-Responders"), F.lit(""), F.lit(3))) == "Nonresponders"
    assert one(spark, classify.track_name(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(""), F.lit(3))) == "Track-T3"


def tree_rows(n=120, seed=1):
    rng = random.Random(seed)
    return [(rng.choice("ab"), i, rng.choice([None, 0, 1, 1, 2, 3])) for i in range(n)]


def test_parents(spark):
    rows = tree_rows()
    df = spark.createDataFrame(rows, "g string, i int, l int")
    smaller = {r["i"]: r["parent"] for r in hierarchy.parent_smaller(df, ["g"], ["i"], "l", "i").collect()}
    previous = {r["i"]: r["parent"] for r in hierarchy.parent_previous(df, ["g"], ["i"], "l", "i").collect()}
    for g, i, level in rows:
        before = [(j, k) for h, j, k in rows if h == g and j < i and k is not None]
        a = [j for j, k in before if level is not None and k < level]
        b = [j for j, k in before if level is not None and level > 1 and k == level - 1]
        assert smaller[i] == (a[-1] if a else None) and previous[i] == (b[-1] if b else None)


def test_many_levels_use_a_stack(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "MOST_LEVELS", 2)
    df = spark.createDataFrame(tree_rows(), "g string, i int, l int")
    got = sorted((r["i"], r["parent"]) for r in hierarchy.parent_smaller(df, ["g"], ["i"], "l", "i").collect())
    monkeypatch.undo()
    assert got == sorted((r["i"], r["parent"]) for r in hierarchy.parent_smaller(df, ["g"], ["i"], "l", "i").collect())


def test_two_hundred_levels(spark):
    df = spark.createDataFrame([("p", i, i) for i in range(1, 201)] + [("p", 201, 3), ("q", 1, 2)], "g string, i int, l int")
    up = {(r["g"], r["i"]): r["parent"] for r in hierarchy.parent_previous(df, ["g"], ["i"], "l", "i").collect()}
    assert up == {**{("p", i): i - 1 or None for i in range(1, 201)}, ("p", 201): 2, ("q", 1): None}
    up = {(r["g"], r["i"]): r["parent"] for r in hierarchy.parent_smaller(df, ["g"], ["i"], "l", "i").collect()}
    assert up == {**{("p", i): i - 1 or None for i in range(1, 201)}, ("p", 201): 2, ("q", 1): None}


def test_preorder_of_a_chain_of_a_thousand(spark):
    rows = [("p", f"n{i}", f"n{i - 1}" if i else None, i) for i in range(1000)] + [("p", "side", "n3", 9999)]
    df = spark.createDataFrame(rows, "g string, id string, up string, o int")
    got = {r["id"]: r["display_order"] for r in hierarchy.preorder(df, ["g"], "id", "up", ["o"]).collect()}
    assert got == {**{f"n{i}": i + 1 for i in range(1000)}, "side": 1001}


def test_preorder_with_cycle_and_unknown_parent(spark):
    df = spark.createDataFrame([("p", "r", None, 1), ("p", "b", "r", 2), ("p", "a", "r", 1), ("p", "c", "a", 1), ("p", "s", "s", 1), ("p", "x", "y", 1), ("p", "y", "x", 1), ("p", "u", "nobody", 1), ("q", "r", None, 1)], "g string, id string, up string, o int")
    got = {(r["g"], r["id"]): r["display_order"] for r in hierarchy.preorder(df, ["g"], "id", "up", ["o"]).collect()}
    assert got == {("p", "r"): 1, ("p", "a"): 2, ("p", "c"): 3, ("p", "b"): 4, ("p", "s"): 0, ("p", "x"): 0, ("p", "y"): 0, ("p", "u"): 0, ("q", "r"): 1}


def test_fill_merged(spark):
    df = spark.createDataFrame([(1, 1, "1:3", ""), (2, 1, "1:3", "v"), (3, 2, "1:3", None), (4, 1, "", ""), (5, 1, None, None), (6, 1, "4:4", "")], "i int, r int, s string, v string")
    pooled = [r["v"] for r in fill.fill_merged(df, [], "s", "v", ["i"]).orderBy("i").collect()]
    assert pooled == ["v", "v", "v", "", None, ""]
    by_row = [r["v"] for r in fill.fill_merged(df, [], "s", "v", ["i"], row="r").orderBy("i").collect()]
    assert by_row == ["v", "v", None, "", None, ""]


def test_ids(spark):
    df = spark.createDataFrame([(1, [{"id": "a", "v": 1}, {"id": "b", "v": 2}]), (2, [])], "id int, xs array<struct<id:string,v:int>>")
    assert [tuple(r) for r in ids.elements(df, "xs", ["id"]).orderBy("pos").collect()] == [(1, 1, 1), (1, 2, 2)]
    assert one(spark, ids.mint("act", F.lit(1234))) == "act-1234" and one(spark, ids.mint("act", F.lit(7))) == "act-007"


def test_matrix(spark):
    df = spark.createDataFrame([("r", 1, "X", 1), ("r", 1, "Y", 2), ("r", 2, "Z", 3), ("r", 3, "", 4), ("s", 1, None, 5), ("t", 1, "Q", 6), ("t", 2, "Q", 7)], "c string, src int, v string, o int")
    got = {r["c"]: r["consolidated_value"] for r in matrix.consolidate_cells(df, ["c"], "src", "v", "o").collect()}
    assert got == {"r": "[Y, Z]", "t": "Q"}


def test_merge_and_display(spark):
    df = spark.createDataFrame([("g", 2, "A  b", "t2", ["y"]), ("g", 1, "a B", "t1", ["x", "y"]), ("g", 3, None, "t3", None), ("g", 4, "", "t4", ["z"])], "g string, o int, t string, k string, r array<string>")
    got = {r["first_order"]: (r["k"], r["r"], r["n_occurrences"]) for r in merge.merge_equal(df, ["g"], text.norm_note(F.col("t")), "o", ["k"], ["r"], ["k"]).collect()}
    assert got == {1: ("t1", ["x", "y"], 2), 3: ("t3", [], 1), 4: ("t4", ["z"], 1)}
    occ = spark.createDataFrame([(1, 2, "a"), (2, 3, "a"), (3, 4, "a"), (4, 1, "e"), (5, 5, "b"), (6, 7, "b"), (7, 9, "c"), (8, 9, "c")], "at int, t int, m string").withColumn("g", F.lit(1))
    assert merge.display_markers(occ, ["g"], "m", "t", order="at").first()["display"] == "T1:e, T2-4:a, T5,7:b, T9,9:c"


def test_links(spark):
    notes = spark.createDataFrame([("p", "n1", "a"), ("p", "n2", "a"), ("p", "n3", "z")], "g string, n string, marker string")
    els = spark.createDataFrame([("p", 1, "a,a, b"), ("p", 2, None)], "g string, e int, m string")
    refs = xref.references(els, ["g"], F.col("e"), text.marker_list(F.col("m")), "activity", F.col("e"))
    assert xref.link(notes, refs, ["g"]).count() == 4
    assert xref.link(notes, xref.references(els, ["g"], F.col("e"), text.marker_list(F.col("m")), "column", F.col("e"), distinct=True), ["g"]).count() == 2
    assert [r["marker"] for r in xref.undefined(refs, notes, ["g", "marker"]).collect()] == ["b"]
    assert one(spark, classify.scope(*[F.lit(x) for x in (True, False, False, False)])) == "column"


def test_islands(spark):
    df = spark.createDataFrame([("a", x) for x in (1, 2, 3, 7, 8, 20)] + [("b", 5)], "g string, x int")
    assert sorted((r["g"], r["first"], r["last"], r["n"]) for r in islands.runs(df, ["g"], "x", 1).collect()) == [("a", 1, 3, 3), ("a", 7, 8, 2), ("a", 20, 20, 1), ("b", 5, 5, 1)]
    assert {r["g"]: r["longest"] for r in islands.longest_run(df, ["g"], "x").collect()} == {"a": 3, "b": 1}
    body = islands.after_first(df.withColumn("f", F.col("x") == 3), ["g"], ["x"], "f").where("in_body").count()
    assert body == 4
    joins = spark.createDataFrame([(0, True), (1, True), (2, False), (3, False), (4, True), (5, False)], "i int, j boolean").withColumn("g", F.lit(0))
    assert sorted((r["first"], r["last"]) for r in islands.merged_spans(joins, ["g"], "i", "j").collect()) == [(0, 2), (4, 5)]


def naive_fold(rows):
    """The same fold written as plain scans over all entities."""
    ents, out = [], {}
    for t, _, base, pos, name, parent, header in sorted(rows, key=lambda r: (not r[2], r[1], r[3])):
        hit, status, score = None, "new", 1.0
        if not base:
            free = [e for e in ents if t not in e["t"]]
            qual = [e for e in ents if e["key"] == (parent, name)][-1:]
            exact = [e for e in qual if t not in e["t"]] or [e for e in free if e["n"] == name]
            if exact:
                hit, status = exact[0], "exact"
            else:
                words = fold._words(name)

                def top(some):
                    best, s0 = None, 0.0
                    for e in some:
                        s = fold.overlap(words, fold._words(e["n"]))
                        if s > s0 and s >= fold.LEAST:
                            best, s0 = e, s
                    return best, s0

                e, s = top([e for e in free if e["p"] == parent])
                if e and s >= fold.REVIEW:
                    hit, status, score = e, "fuzzy_auto" if s >= fold.AUTO else "fuzzy_review", s
                else:
                    e, s = top([e for e in free if e["p"] != parent and not e["h"]])
                    if e and s >= fold.CROSS:
                        hit, status, score = e, "fuzzy_cross_parent", s
        if hit is None:
            hit = {"id": len(ents) + 1, "n": name, "p": parent, "h": header, "t": set(), "key": (parent, name)}
            ents.append(hit)
        hit["t"].add(t)
        if status == "fuzzy_cross_parent" and hit["p"] != parent:
            hit["p"] = f"{hit['p']} / {parent}"
        out[t, pos] = (f"xact-{hit['id']:03d}", status)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_fold_against_plain_scans(spark, seed):
    rng = random.Random(seed)
    words = ["blood", "cell", "count", "vital", "signs", "panel", "urine", "liver", "exam", "skin"]
    rows = []
    for t in range(1, 6):
        for pos in range(12):
            name = " ".join(rng.sample(words, rng.choice([1, 2, 3])))
            rows.append((t, t, t == 1, pos, name, rng.choice(["", "Lab", "Visit"]), rng.random() < 0.2))
    df = spark.createDataFrame([("p", *r) for r in rows], "g string, table_number int, table_rank int, is_base boolean, pos int, name string, parent string, header boolean")
    got = {(r["table_number"], r["pos"]): (r["xact_id"], r["match_status"]) for r in fold.resolve_entities(df, ["g"]).collect()}
    assert got == naive_fold(rows)


def test_patch(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", None)], "pos int, k string, v int")
    ops = [{"id": 1, "op": "set", "match": {"k": "a"}, "set": {"v": None}}, {"id": 2, "op": "add", "set": {"k": "n", "v": 5}}, {"id": 3, "op": "remove", "match": {"k": "b", "v": None}}, {"id": 4, "op": "set", "match": {"k": "n"}, "set": {"v": 6}}]
    assert [tuple(r) for r in patch.apply_corrections(df, ops).orderBy("pos").collect()] == [(1, "a", None), (3, "c", None), (4, "n", 6)]
    for bad in ({"id": 9, "op": "set", "match": {"v": None}, "set": {}}, {"id": 9, "op": "remove", "match": {"k": "zz"}}, {"id": 9, "op": "move"}, {"id": 9, "op": "set", "match": {}, "set": {"v": 1}}):
        with pytest.raises(patch.CorrectionError):
            patch.apply_corrections(df, [bad])
    assert patch.apply_corrections(df, [{"id": 1, "op": "remove", "match": {"absent": None, "k": "a"}}]).count() == 2


def longest_block(parts):
    best = 0
    for i in range(len(parts)):
        for j in range(i + 1, len(parts)):
            run = 0
            while j + run < len(parts) and i + run < j and parts[i + run] == parts[j + run]:
                run += 1
            best = max(best, sum(map(len, parts[i : i + run])))
    return best


def test_duplicated_blocks(spark):
    rng = random.Random(5)
    s = [f"This is sentence {c} of them." for c in "abcd"]
    docs = [(i, [rng.choice(s) + " " * 0 for _ in range(rng.randrange(12))]) for i in range(40)]
    df = spark.createDataFrame([(i, " ".join(p)) for i, p in docs] + [(99, None), (98, "")], "i int, t string")
    got = {r["i"]: r["block_chars"] for r in quality.duplicated_blocks(df, "i", "t").collect()}
    assert got == {i: b for i, p in docs if (b := longest_block(p))}


def test_contains_join(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.choice([8, 12, 40]))) for _ in range(60)]
    df = spark.createDataFrame([("g", t) for t in texts] + [("g", None), ("g", "short")], "g string, n string").distinct()
    got = {(r["n"], r["s"]) for r in matching.contains_join(df, df.withColumnRenamed("n", "s"), ["g"], "n", "s").collect()}
    assert got == {(a, b) for a in {*texts, "short"} for b in {*texts, "short"} if a in b}


def brute_assign(scores, anchors):
    import itertools

    n, m = len(scores), len(scores[0])
    best = -1
    for combo in itertools.product([None, *range(m)], repeat=n):
        used = [c for c in combo if c is not None]
        if used != sorted(used) or any(a is not None and c not in (a, None) for c, a in zip(combo, anchors)):
            continue
        gain = [scores[p][c] + (audit.ANCHOR if anchors[p] == c else 0) for p, c in enumerate(combo) if c is not None]
        if all(g > 0 for g in gain):
            best = max(best, sum(gain))
    return best


def test_assign_is_optimal():
    rng = random.Random(1)
    for _ in range(30):
        n, m = rng.randrange(1, 5), rng.randrange(1, 4)
        scores = [[rng.randrange(4) for _ in range(m)] for _ in range(n)]
        anchors = [None] * n
        got = audit.assign(np.array(scores), np.full(n, -1)).tolist()
        assert sum(scores[p][t] for p, t in enumerate(got) if t >= 0) == brute_assign(scores, anchors)
    assert audit.assign(np.array([[5, 0], [5, 1], [0, 5]]), np.array([-1, 1, -1])).tolist() == [0, 1, 1]
    assert audit.assign(np.zeros((0, 0), int), np.zeros(0, int)).tolist() == []
    for _ in range(200):
        n, m = rng.randrange(1, 9), rng.randrange(1, 5)
        scores = [[rng.choice([0, 0, 1, 2, 3]) for _ in range(m)] for _ in range(n)]
        anchors = [rng.choice([-1, -1, -1, rng.randrange(m)]) for _ in range(n)]

        @functools.cache
        def best(p, t):  # (value, choice) of the first p pages and t tables, by the order of ties
            if not p or not t:
                return 0, None
            options = [(best(p, t - 1)[0], "rest")]
            if anchors[p - 1] in (-1, t - 1) and (scores[p - 1][t - 1] or anchors[p - 1] == t - 1):
                options.append((best(p - 1, t)[0] + scores[p - 1][t - 1] + (audit.ANCHOR if anchors[p - 1] == t - 1 else 0), "take"))
            if anchors[p - 1] == -1:
                options.append((best(p - 1, t)[0], "leave"))
            return max(options, key=lambda o: o[0])

        want, p, t = [-1] * n, n, m
        while p and t:
            how = best(p, t)[1]
            if how == "rest":
                t -= 1
                continue
            if how == "take":
                want[p - 1] = t - 1
            p -= 1
        assert audit.assign(np.array(scores), np.array(anchors)).tolist() == want


def test_geometry(spark):
    mask = np.array([[1, 1, 0], [1, 0, 0], [0, 1, 1]], bool)
    assert geometry.longest_runs(mask, 0).tolist() == [2, 1, 1] and geometry.longest_runs(mask, 1).tolist() == [2, 1, 2]
    assert geometry.grouped(np.array([1, 2, 5, 9, 11])) == [(1, 2), (5, 5), (9, 11)]
    grey = np.full((400, 300), 255, np.uint8)
    for x in (20, 120, 220):
        grey[10:390, x : x + 3] = 0
    for y in (50, 100, 150):
        grey[y : y + 2, 20:223] = 0
    grey[100:150, 125:220] = 0
    rows = spark.createDataFrame([(1, 300, 400, bytearray(grey.tobytes()))], "page int, width int, height int, grey binary")
    found = {tuple(r)[1:] for r in geometry.rules_of_pages(rows).collect()}
    assert ("column", 0, 22, 120) in found and ("rule", 0, 100, 101) in found and ("fill", 1, 100, 151) in found
    words = spark.createDataFrame([(1, "CBC", 10.0, 10.0, 30.0, 20.0), (1, "1", 30.5, 8.0, 33.0, 16.0), (1, "test", 40.0, 10.0, 60.0, 20.0), (1, "next", 10.0, 30.0, 30.0, 40.0)], "page int, text string, x0 double, y0 double, x1 double, y1 double")
    lines = geometry.lines_of_words(words, ["page"])
    assert geometry.joined(lines, ["page"]).first()["text"] == "CBC1 testnext"
    assert geometry.joined(geometry.without_superscripts(lines, ["page", "line"]), ["page"]).first()["text"] == "CBC testnext"
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 35.0, 25.0)], "page int, bx0 double, by0 double, bx1 double, by1 double")
    assert {r["text"] for r in geometry.words_in(words, boxes, ["page"]).collect()} == {"CBC", "1"}


def test_reports(spark):
    values = spark.createDataFrame([([("epoch", 1, "E"), ("week", 2, "w2")],), ([("study_day", None, "d"), ("visit", 3, "")],), ([],)], "v array<struct<property_type:string,level:int,value:string>>")
    assert [r[0] for r in values.select(report.column_identifier(F.col("v"))).collect()] == ["E", "d", ""]
    assert one(spark, report.percent_less(F.lit(7), F.lit(8))) == 12 and one(spark, report.percent_less(F.lit(1), F.lit(0))) == 0
    df = spark.createDataFrame([("a", "Panel x", True), ("b", "other", True), ("c", "PANEL", False)], "i string, n string, m boolean")
    assert [r["i"] for r in report.search(df, ["n"], needle="panel", need=["m"]).collect()] == ["a"]


def test_grid_map_keeps_every_column(spark):
    cells = [("a", 1, "x"), ("a", 10, "y"), ("a", 10, "z"), ("a", 250, None), ("b", None, "lost")]
    got = matrix.grid_map(spark.createDataFrame(cells, "row string, col int, v string"), ["row"], "col", "v")
    assert {r["row"]: r["cells"] for r in got.collect()} == {"a": {1: "x", 10: "z", 250: None}, "b": {}}


def test_scored_joins_find_what_all_pairs_find(spark):
    """Blocked joins against the product of small groups, with hot words, long and short texts, markers between letters."""
    rng = random.Random(8)
    words = ["visit", "visit", "visit", "blood", "count", "panel", "urine", "ab", "serum", "dose", "(x)"]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(0, 6)))
    left = spark.createDataFrame([(rng.choice("gh"), name(), i) for i in range(150)], "g string, a string, i int")
    right = spark.createDataFrame([(rng.choice("gh"), name(), i) for i in range(150)], "g string, b string, i int")
    for least in (0.5, 0.6, 0.9):
        every = left.alias("l").join(right.alias("r"), "g").select("g", F.col("l.i").alias("x"), F.col("r.i").alias("y"), text.word_overlap(F.col("a"), F.col("b")).alias("s"))
        want = {(r["g"], r["x"], r["y"], round(r["s"], 9)) for r in every.where(F.col("s") >= least).collect()}
        got = {(r["g"], r["l_i"], r["r_i"], round(r["score"], 9)) for r in matching.overlap_join(left, right, ["g"], "a", "b", least).collect()}
        assert got == want and want
    label = lambda: "".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 6, 7, 9, 13, 14])))
    labels = [label() for _ in range(120)]
    texts = [rng.choice(labels) for _ in range(60)]
    for _ in range(120):
        t = list(rng.choice(labels))
        for _ in range(rng.randrange(6)):
            t.insert(rng.randrange(len(t) + 1), rng.choice("abcz"))
        texts.append("".join(t))
    texts += [x[: rng.randrange(1, 14)] for x in labels] + [x + "tail" * rng.randrange(3) for x in labels]
    p = spark.createDataFrame([(rng.choice("gh"), t) for t in texts], "g string, t string")
    k = spark.createDataFrame([(rng.choice("gh"), t) for t in labels], "g string, lab string")
    every = p.distinct().withColumn("_p", text.norm_key(F.col("t"))).join(k.distinct().withColumn("_k", F.explode(text.label_keys(F.col("lab")))), "g").withColumn("s", matching.match_score(F.col("_p"), F.col("_k"))).where("s.kind > 0")
    want = {(r["g"], r["t"], r["lab"], r["s"]["kind"], r["s"]["n"]) for r in matching.all_best(every, ["g", "t"], F.col("s")).collect()}
    got = {tuple(r) for r in matching.label_matches(p, k, ["g"], "t", "lab").collect()}
    assert got == want and {w[3] for w in want} == {1, 2, 3}


@pytest.mark.parametrize("least", [1, 8, 12, 30])
def test_containment_of_any_length(spark, least):
    rng = random.Random(least)
    stacks = ["".join(rng.choice("abé🙂 ") for _ in range(rng.randrange(200))) for _ in range(40)] + ["", None]
    needles = [s[i : i + rng.choice([1, 3, 8, 11, 25, 40])] for s in stacks if s for i in [rng.randrange(len(s))]] + ["zzzzzzzzzz", "", None]
    a = spark.createDataFrame([("g", x) for x in needles], "g string, n string")
    b = spark.createDataFrame([("g", x, i) for i, x in enumerate(stacks)] + [("h", needles[0], 99)], "g string, s string, i int")
    got = sorted((r["n"], r["i"]) for r in matching.contains_join(a.distinct(), b, ["g"], "n", "s", least).collect())
    assert got == sorted((x, i) for x in {x for x in needles if x} for i, s in enumerate(stacks) if s and x in s)


def test_fold_by_components_equals_fold_of_the_group(spark):
    rng = random.Random(4)
    words = ["blood", "count", "panel", "liver", "urine", "visit", "signs", "vital", "dose", "diary", "pain", "survey"]
    rows = []
    for g in "gh":
        for t in range(1, 6):
            for p in range(25):
                name = " ".join(rng.sample(words, rng.choice([1, 2, 2, 3]))) if rng.random() < 0.95 else rng.choice(["", "ab"])
                rows.append((g, t, t, t == 1, p, name, rng.choice(["", "Labs", "Visits"]), rng.random() < 0.1))
    df = spark.createDataFrame(rows, "g string, table_number int, table_rank int, is_base boolean, pos int, name string, parent string, header boolean")
    whole = {tuple(r) for r in fold.resolve_entities(df, ["g"]).collect()}
    assert len(whole) == len(rows) and {tuple(r) for r in fold.resolve_entities(df, ["g"], split_rows=10).collect()} == whole
    names = spark.createDataFrame([("g", n) for n in ("a one", "one two", "two", "red hat", "hat", "")], "g string, name string")
    parts = {r["name"]: r["part"] for r in fold.components(names, ["g"]).collect()}
    assert parts["a one"] == parts["one two"] == parts["two"] and parts["red hat"] == parts["hat"] and len(set(parts.values())) == 3
