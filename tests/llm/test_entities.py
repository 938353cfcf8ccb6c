import random

import numpy as np
import pyarrow as pa
import pytest

from gridweave.llm import entities

NAMES = ["Vital signs", "Blood cell count", "Liver enzyme panel", "Urine drug screening", "Physical examination", "Signed consent", "Chest imaging", "Kidney function panel", "Skin swab", "Joint count",
         "Hearing test", "Eye pressure reading", "Sleep survey", "Pain diary", "Dental inspection", "Memory game", "Gait video", "Grip strength", "Stool culture", "Heart tracing"]
ALIAS = {"Signed consent": "ICF form", "Chest imaging": "CXR"}
LEFT = "id string, label string, name string, section string, track string, n1 double, n2 double, study string"
RIGHT = "id string, study string, name string, section string, track string, n1 double, n2 double, sig string"


def world(seed=1, studies=60, big=0):
    """Activities, noisy forms with their truth, and studies; the first study may hold many more activities than the rest."""
    rng = random.Random(seed)
    right, left, truth, stud = [], [], {}, []
    for s in range(studies):
        sid, code = f"S{s:03d}", f"{chr(65 + s % 26)}{chr(65 + s // 26)}Q-{rng.randrange(10000):04d}"
        stud.append((sid, [code, None]))
        copies = big if s == 0 and big else 1
        for c in range(copies):
            track = f"Track {chr(65 + c % 26)}{c // 26}" if copies > 1 else None
            for i, n in enumerate(rng.sample(NAMES, 14)):
                act = (f"x{c:03d}-{i:02d}", sid, n, rng.choice(["Labs", "Checks"]), track, float(rng.randrange(-20, 400)), float(rng.randrange(12)))
                right.append((*act, "clash"))
                if rng.random() < 0.55:
                    item = f"i{len(left):05d}"
                    name = ALIAS.get(n, n) if rng.random() < 0.5 else n
                    name = {0: name.upper(), 1: name.replace(" ", "_"), 2: "Form: " + name, 3: name[:3] + name[4:]}.get(rng.randrange(6), name)
                    label = {0: code.lower().replace("-", ""), 1: "Study " + code, 2: code + "/EU", 3: code[:4] + code[5:]}.get(rng.randrange(6), code)
                    n1 = None if rng.random() < 0.1 else act[5] + rng.choice([0, 0, 0, 1, -1])
                    left.append((item, label, name, act[3] if rng.random() < 0.7 else None, track if rng.random() < 0.9 else None, n1, act[6] + rng.choice([0, 0, 0, 1]), "clash"))
                    truth[item] = (sid, act[0])
        for n in ("Query page", "Payment sheet"):
            left.append((f"i{len(left):05d}", code, n, None, None, float(rng.randrange(400)), float(rng.randrange(12)), "clash"))
    return left, right, stud, truth


def run(spark, left, right, stud, **layout):
    args = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), spark.createDataFrame(stud, "study string, names array<string>")
    return {r["left_id"]: (r["study"], r["right_id"], r["confidence"]) for r in entities.match(*args, r"^form:\s*", layout=entities.Layout(**layout)).collect()}


def test_held_out_accuracy(spark):
    left, right, stud, truth = world()
    got = run(spark, left, right, stud)
    right_ones = sum(got.get(i, (0, 0))[:2] == t for i, t in truth.items())
    assert right_ones / len(got) > 0.95 and right_ones / len(truth) > 0.93
    assert all(0.5 <= c <= 1 for *_, c in got.values())
    sure = [i for i, g in got.items() if g[2] > 0.9]
    assert sum(truth.get(i) == got[i][:2] for i in sure) / len(sure) > 0.97


@pytest.mark.parametrize("bits", [8, 12])
def test_hyperplane_blocks_find_what_all_pairs_find(spark, bits):
    left, right, stud, truth = world(2, studies=8, big=60)
    every = run(spark, left, right, stud, block=10**6)
    blocked = run(spark, left, right, stud, block=100, bucket=840 / 2**bits)
    own = [i for i, t in truth.items() if t[0] == "S000"]
    assert len(own) > 300
    kept = sum(blocked.get(i, (0, 0))[:2] == every[i][:2] for i in own if i in every)
    assert kept / sum(i in every for i in own) >= 0.95
    assert np.mean([abs(blocked[i][2] - every[i][2]) < 1e-3 for i in own if blocked.get(i, (0, 0))[:2] == every.get(i, (1, 1))[:2]]) > 0.9


def test_large_blocks_and_many_left_rows_go_in_shares(spark):
    left, right, stud, _ = world(4, studies=5, big=30)
    want = run(spark, left, right, stud)
    assert {k: v[:2] for k, v in run(spark, left[::-1], right[::-1], stud).items()} == {k: v[:2] for k, v in want.items()}
    got = run(spark, left, right, stud, split=7, split_left=5)
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
    few = run(spark, left, right, stud, block=100, split=7)
    whole = run(spark, left, right, stud, block=100)
    assert {k: v[:2] for k, v in few.items()} == {k: v[:2] for k, v in whole.items()} != {}


def test_edges(spark):
    left, right, stud, _ = world(3, studies=4)
    assert run(spark, [], right, stud) == {} and run(spark, left, [], stud) == {} and run(spark, left, right, []) == {}
    nothing = [("a", None, "Vital signs", None, None, None, None, ""), ("b", "unknown thing", None, None, None, None, None, ""), ("c", "", "x" * 50_000, None, None, 1.0, 1.0, "")]
    assert not {"a", "b", "c"} & set(run(spark, [*left, *nothing], right, stud))
    twice = run(spark, left + left[:3], right + right[:3], stud)
    assert set(twice) == set(run(spark, left, right, stud))


def test_studies(spark):
    labels = ["ABQ-0012", "abq12", "Study ABQ-0012 v2", "ABQ-012", "ABX-0012", "ABQ-0021", "MIRALO", "mirallo", "zzz", ""]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    stud = spark.createDataFrame([("s1", ["ABQ-0012", "MIRALO"]), ("s2", ["XYZ-9999", None]), ("s3", ["KKK-1", "MIRALO"])], "study string, names array<string>")
    got = {}
    for r in entities.resolve_studies(df, stud).collect():
        got.setdefault(r["label"], set()).add((r["study"], r["exact"]))
    assert got["ABQ-0012"] == got["abq12"] == got["Study ABQ-0012 v2"] == got["ABQ-012"] == {("s1", True)}
    assert got["ABX-0012"] == got["ABQ-0021"] == {("s1", False)}
    assert got["MIRALO"] == {("s1", True), ("s3", True)} and got["mirallo"] == {("s1", False), ("s3", False)}
    assert "zzz" not in got and "" not in got


def test_walks_bring_aliases_together():
    rng = random.Random(1)
    nodes = []
    for k in range(300):
        a, b = rng.choice([("icf", "consent"), ("cxr", "chest"), ("log", "diary")])
        nodes += [[a, f"#{k}"], [b, f"#{k}"]]
    v = entities.walk_vectors(nodes)
    mean = np.mean([*v.values()], 0)
    v = {k: x - mean for k, x in v.items()}
    cos = lambda x, y: float(v[x] @ v[y] / np.linalg.norm(v[x]) / np.linalg.norm(v[y]))
    assert cos("icf", "consent") > cos("icf", "chest") and cos("cxr", "chest") > cos("cxr", "diary")


@pytest.mark.parametrize("text, want", [("Track J6", "j6"), ("Tr.J6", "j6"), ("track_j6", "j6"), ("J6", "j6"), ("Track L00-0003", "l000003"), ("Treatment", "treatment")])
def test_track_code(text, want):
    assert entities.track_code(text) == want


def test_few_large_studies_are_sampled(spark, monkeypatch):
    """Of every large study some records are taken, whatever its hash; weights count the words of all records."""
    monkeypatch.setattr(entities, "FIT_RECORDS", 60)
    monkeypatch.setattr(entities, "FIT_LEAST", 5)
    rows = [(b"%d|%d" % (s, i), True, f"S{s}", f"{i} heart", None, None, float(i), None, 1.0) for s in range(5) for i in range(400)]
    df = spark.createDataFrame(rows, "sig binary, exact boolean, study string, name string, section string, track string, n1 double, n2 double, rate double")
    left, right, share = entities._sample(df, df)
    assert {r["study"] for r in left} == {r["study"] for r in right} == set(share) == {f"S{s}" for s in range(5)}
    assert all(abs(x - 6 / 400) < 1e-9 for x in share.values()) and len(right) < 120
    assert entities._sample(df.repartition(7), df.repartition(3)) == (left, right, share)
    assert entities._token_counts(df.select("name"), ["heart", "7"]) == (2000, {"heart": 2000, "7": 5})


def test_quotas():
    counts = [("a", 10_000), ("b", 50), ("c", 7_000)]
    assert entities._quotas(counts, 2050) == {"a": 1000, "b": 50, "c": 1000}
    assert entities._quotas(counts, 10) == {"a": 300} and entities._quotas([], 10) == {}


def test_recall_of_tables_does_not_fall_with_bits():
    """Pairs with the same chance of an equal bit meet as often in a study of many bits as in one of few."""
    enc = entities.Encoding(entities.Model())
    near = "enzyme liver panel"
    others = [near[:i] + x + near[i + 2 :] for i in range(0, 16) for x in ("q", "zz", "xv")]
    row = lambda name, section, n1: {"name": name, "section": section, "track": "a1", "n1": n1, "n2": None}
    r = entities.records_of(enc, [row(near, "labs", 10.0), *(row(x, None, 14.0) for x in others)])
    met = {}
    for bits in (9, 14):
        one = enc.probes(bits, r, np.array([0]))
        assert one.shape == (1, enc.layout.tables_of(bits), 2**enc.layout.open) and len(np.unique(one[0, 0])) == 2**enc.layout.open
        many = enc.codes(bits, r, np.arange(1, 1 + len(others)))
        met[bits] = (many[:, :, None] == one).any((1, 2)).mean()
    assert enc.layout.tables_of(9) == enc.layout.tables and met[9] > 0.9 and met[14] >= met[9] - 0.05


def test_slips_in_codes_with_zeros_and_short_names(spark):
    labels = ["AoA-0007", "AA-0007", "AtA-0007", "CCM-028", "QRS", "QXS", "Study AtA-0007 QRS"]
    stud = spark.createDataFrame([("s1", ["AAA-0007", None]), ("s2", ["CCM-6028", None]), ("s3", ["LLL-5555", "QRS"])], "study string, names array<string>")
    got = {}
    for r in entities.resolve_studies(spark.createDataFrame([(x,) for x in labels], "label string"), stud).collect():
        got.setdefault(r["label"], set()).add((r["study"], r["exact"]))
    assert got["AoA-0007"] == got["AA-0007"] == got["AtA-0007"] == {("s1", False)} and got["CCM-028"] == {("s2", False)}
    assert got["QRS"] == {("s3", True)} and got["QXS"] == {("s3", False)} and got["Study AtA-0007 QRS"] == {("s1", False), ("s3", True)}


def blocks(rows):
    """Rows for score_blocks: defaults filled in, in its order."""
    base = {"block": 0, "cell": 0, "study": "s", "name": "a", "section": None, "track": None, "n1": None, "n2": None, "size": 60, "pid": None, "exact": True, "id": None, "rate": 1.0}
    kinds = {"block": "int64", "cell": "int32", "size": "int64", "pid": "int64", "n1": "float64", "n2": "float64", "rate": "float64", "exact": "bool_"}
    full = sorted(({**base, **r} for r in rows), key=lambda r: (r["block"], r["cell"], r["study"], r["pid"] is not None, r["id"] or ""))
    return pa.RecordBatch.from_pylist(full, pa.schema([(k, getattr(pa, kinds.get(k, "string"))()) for k in base]))


def flat_model():
    model = entities.Model(ratios={k: np.zeros(n) for k, n in entities.SIZES.items()})
    model.ratios["n1"][entities.FAR_1 + 1] = 20.0
    return model


def test_like_activities_share_the_posterior():
    """A study that is one block: the best with the smallest id, and the weights of all the others as a sum."""
    rows = [{"pid": 7, "n1": 1.0}, *({"id": f"r{i:02d}", "n1": 1.0 if i < 20 else 5.0} for i in range(60))]
    out = pa.Table.from_batches(entities.score_blocks(iter([blocks(rows)]), flat_model())).to_pylist()
    assert [(r["pid"], r["id"]) for r in out] == [(7, "r00")] and out[0]["llr"] == 20
    assert out[0]["rest"] == pytest.approx(19 * np.exp(20) + 40)


def test_rows_of_a_block_in_pieces():
    """However the rows arrive in batches, every pair of a block is scored once; equal ids count once, by their best row."""
    rng = random.Random(3)
    rows = []
    for b in range(40):
        size = 60 if b % 2 else 10**6
        rows += [{"block": b, "size": size, "pid": 1000 * b + i, "n1": float(rng.randrange(4))} for i in range(rng.randrange(30))]
        rows += [{"block": b, "size": size, "id": f"r{rng.randrange(12):02d}", "n1": float(rng.randrange(4))} for _ in range(rng.randrange(30))]
    batch = blocks(rows)

    def result(step):
        got = pa.Table.from_batches(entities.score_blocks((batch.slice(i, step) for i in range(0, batch.num_rows, step)), flat_model())).to_pylist()
        return sorted(((r["pid"], r["id"] or "", r["llr"] or 0.0, round(r["rest"], 6)) for r in got))

    whole = result(10**6)
    kept = {}
    for r in batch.to_pylist():
        if r["pid"] is not None:
            scores = {}
            for x in batch.to_pylist():
                if x["block"] == r["block"] and x["id"] is not None:
                    scores[x["id"]] = max(scores.get(x["id"], 0.0), 20.0 if x["n1"] == r["n1"] else 0.0)
            if scores:
                kept[r["pid"]] = (min(scores, key=lambda k: (-scores[k], k)), sum(np.exp(v) for v in scores.values()))
    assert {p for p, *_ in whole} == set(kept)
    for p, (best, total) in kept.items():
        mine = [r for r in whole if r[0] == p]
        top = min((r for r in mine if r[1]), key=lambda r: (-r[2], r[1]))
        assert top[1] == best and sum(r[3] + (np.exp(r[2]) if r[1] else 0) for r in mine) == pytest.approx(total)
    assert result(7) == whole


def test_nothing_of_the_model_is_sampled(spark, monkeypatch):
    """Bounds of a sample change nothing: vectors, ratios and prior come from all records."""
    left, right, stud, _ = world(5, studies=12)
    want = run(spark, left, right, stud)
    monkeypatch.setattr(entities, "FIT_RECORDS", 20)
    monkeypatch.setattr(entities, "FIT_STUDIES", 2)
    monkeypatch.setattr(entities, "FIT_LEAST", 5)
    got = run(spark, left, right, stud)
    assert len(want) > 50 and {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
    assert all(got[k][2] == pytest.approx(want[k][2]) for k in want)


def test_words_of_all_cells_have_vectors(spark, monkeypatch):
    """Words that two records have get a vector, in whatever cells those are."""
    monkeypatch.setattr(entities, "CELL", 50)
    rows = [(f"S{s}", f"{w} both{s // 4}", "labs", None, float(d), 1.0) for s in range(40) for d in range(5) for w in (f"a{d}", f"b{d}")]
    df = spark.createDataFrame(rows, "study string, name string, section string, track string, n1 double, n2 double")
    model = entities._vectors(df, df.select("name"))
    assert set(model.vectors) == {f"{k}{d}" for k in "ab" for d in range(5)} | {f"both{s}" for s in range(10)}
    assert model.weights["a1"] == pytest.approx(np.log(400 / 40))
    v = model.vectors
    near = np.array([[v[f"a{d}"] @ v[f"b{x}"] for x in range(5)] for d in range(5)])
    assert near.trace() / 5 > (near.sum() - near.trace()) / 20 + 0.05


def test_all_pairs_are_counted_by_distinct_values(spark):
    rng = random.Random(2)
    row = lambda s: (s, rng.choice([*NAMES[:6], None]), rng.choice(["labs", "lab", None]), rng.choice(["a", "b", None]), rng.choice([1.0, 4.0, 30.0, None]), rng.choice([2.0, 3.0, None]))
    sides = [[row(s) for s, n in (("s1", 30), ("s2", 9)) for _ in range(n * k)] for k in (2, 1)]
    size = {"s1": 30, "s2": 9}
    schema = "study string, name string, section string, track string, n1 double, n2 double, size long"
    dfs = [spark.createDataFrame([(*r, size[r[0]]) for r in side], schema) for side in sides]
    model = entities.Model(vectors={}, weights={})
    got = entities._split_sums(entities._all_pairs(*dfs, spark.sparkContext.broadcast(model)))
    want = {k: np.zeros(n) for k, n in entities.SIZES.items()}
    for s in size:
        ls, rs = ([dict(zip(("name", "section", "track", "n1", "n2", "rate"), (*r[1:], 1.0))) for r in side if r[0] == s] for side in sides)
        cats = entities.features(entities.records_of(entities.Encoding(model), [*ls, *rs]), *(np.array([x]) for x in (0, len(ls), len(ls), len(rs))))[2]
        for k in want:
            want[k] += np.bincount(cats[k], minlength=len(want[k])) / size[s]
    assert all(np.allclose(got[k], want[k]) for k in want) and want["n1"].sum() == pytest.approx(78)


def test_a_pair_that_meets_twice_is_calibrated_once():
    rows = [{"block": b, "size": 10**6, "pid": 5 + i, "n1": 1.0} for b in range(3) for i in range(4)]
    rows += [{"block": b, "size": 10**6, "id": f"r{i}", "n1": 1.0 + 4 * (i == 2)} for b in range(3) for i in range(3)]
    batch = blocks(rows)
    rid = pa.array([None if x is None else int(x[1:]) for x in batch.column("id").to_pylist()], pa.int64())
    batch = pa.RecordBatch.from_arrays([*batch.columns, rid], names=[*batch.schema.names, "rid"])
    met = pa.Table.from_batches(entities.block_pairs(iter([batch]), flat_model())).sort_by("pid").combine_chunks()
    for step in (1, 5, 100):
        out = pa.Table.from_batches(entities.merge_pairs(iter(met.to_batches(step))))
        pid, _, owner, code, n, _ = entities._flat(out)
        assert pid.tolist() == [5, 6, 7, 8] and n.tolist() == [1, 2] * 4 and len(code) == 8
