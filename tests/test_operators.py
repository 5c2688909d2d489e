"""Operators on small tables: brute force, closed forms, parameter recovery."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from linkloom.operators import assignment, blocking, evaluation, training, vocab
from linkloom.operators import comparisons as cmp
from linkloom.operators.model import LinkModel


def test_snap_rare_levels(spark):
    rows = ["NORD KIVU"] * 200 + ["ITURI"] * 50 + ["NORD KIV", "NORS KIVU", "MABALAKO", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "row int, v string")
    got = {r.row: r.v for r in vocab.snap_rare_levels(df, "v").collect()}
    assert [got[i] for i in (250, 251, 252, 253)] == ["NORD KIVU", "NORD KIVU", "MABALAKO", None]


def test_align_vocab(spark):
    x = spark.createDataFrame([(1, "BIAKATO MINES"), (2, "IDHOU"), (3, "IDHOU"), (4, "BINGO"), (5, None)], "row int, v string")
    ref = spark.createDataFrame([(1, "BIAKATO MINE"), (2, "IDOU"), (3, "FARAWAY"), (4, "BINGO")], "row int, v string")
    got = {r.row: r.v for r in vocab.align_vocab(x, ref, "v", "row")[0].collect()}
    assert got == {1: "BIAKATO MINE", 2: "IDOU", 3: "IDOU", 4: "BINGO", 5: None}
    kept = {r.row: r.v for r in vocab.align_vocab(x, ref, "v", "row", max_n=2)[0].collect()}
    assert kept[2] == "IDHOU" and kept[1] == "BIAKATO MINE"


def test_align_tokens(spark):
    x = spark.createDataFrame([(1, ["MUTONE", "MUTHONE"]), (2, [])], "row int, t array<string>")
    ref = spark.createDataFrame([(1, ["MUTONE"])], "row int, t array<string>")
    got, table = vocab.align_tokens(x, ref, "t", "row")
    assert {r.row: r.t for r in got.collect()} == {1: ["MUTONE"], 2: []}
    assert [(r["from"], r["to"], r["n"]) for r in table.collect()] == [("MUTHONE", "MUTONE", 1)]


def test_surprisal(spark):
    d1 = spark.createDataFrame([(1, ["AA", "BB", "AA"]), (2, ["AA"]), (3, ["AA", "C"])], "row int, name_tokens array<string>")
    d2 = spark.createDataFrame([(1, ["AA", "BB"]), (2, []), (3, ["BB"])], "row int, name_tokens array<string>")
    got = {r.token: (r.n, r.s) for r in vocab.token_surprisal(d1, d2).collect()}
    assert got["AA"][0] == 4 and abs(got["AA"][1] + np.log2(6 / 6)) < 1e-12 and abs(got["BB"][1] + np.log2(5 / 6)) < 1e-12 and "C" not in got


def test_one_to_one_is_greedy(spark):
    rng = random.Random(5)
    pairs = list({(rng.randrange(15), rng.randrange(15)): rng.randrange(6) / 2 for _ in range(120)}.items())
    df = spark.createDataFrame([(a, b, float(s)) for (a, b), s in pairs], "row_1 int, row_2 int, score double")
    used1, used2, want = set(), set(), set()
    for (a, b), _ in sorted(pairs, key=lambda p: (-p[1], p[0])):
        if a not in used1 and b not in used2:
            want.add((a, b))
            used1.add(a)
            used2.add(b)
    got = {(r.row_1, r.row_2) for r in assignment.one_to_one(df).where("selected").collect()}
    assert got == want
    assert assignment.one_to_one(df.limit(0)).count() == 0


def test_em_recovers_parameters():
    rng = np.random.default_rng(3)
    m = {"a": [0.9, 0.1], "b": [0.7, 0.2, 0.1], "c": [0.95, 0.05]}
    u = {"a": [0.1, 0.9], "b": [0.05, 0.15, 0.8], "c": [0.2, 0.8]}
    match = rng.random(200_000) < 0.2
    g = {k: np.where(match, rng.choice(len(m[k]), len(match), p=m[k]), rng.choice(len(u[k]), len(match), p=u[k])) for k in m}
    g["a"] = np.where(rng.random(len(match)) < 0.1, -1, g["a"])
    got = training.em(g, np.ones(len(match)), u, 0.5, tolerance=1e-7)
    assert abs(got.prior - 0.2) < 0.01
    assert all(abs(x - y) < 0.02 for k in m for x, y in zip(got.m[k], m[k], strict=True))


def test_u_counts_equal_brute_force(spark):
    rows = [(i, "d1" if i % 3 else "d2", None if i % 7 == 0 else i % 11) for i in range(60)]
    df = spark.createDataFrame(rows, "unique_id long, source_dataset string, age int")
    got = {r.gamma: r.n for r in training.level_counts(df, cmp.age()).collect()}
    want: dict[int, int] = {}
    for _, s, a in rows:
        for _, t, b in rows:
            if s == "d1" and t == "d2":
                k = -1 if a is None or b is None else 0 if a == b else 1 if abs(a - b) <= 2 else 2 if abs(a - b) <= 5 else 3
                want[k] = want.get(k, 0) + 1
    assert got == want


def test_model_round_trip(tmp_path):
    m = LinkModel.published()
    m.save(str(tmp_path / "m.json"))
    assert LinkModel.load(str(tmp_path / "m.json")).rows() == m.rows()
    assert round(next(r[4] for r in m.rows() if r[:2] == ("name", "agree_bits20")), 3) == 19.027


def test_metrics_and_sweep(spark):
    truth = evaluation.reference(spark.createDataFrame([(1, 10, 1), (2, 20, 1), (3, 99, 1), (4, None, None)], "row_d1 int, id_d2 int, order_d1 int"), spark.createDataFrame([(100, 10), (200, 20)], "row_d2 int, id_d2 int"))
    pred = spark.createDataFrame([(1, 100), (2, 100), (3, 200), (4, 200)], "row_1 int, row_2 int")
    r = evaluation.metrics(pred, truth).head()
    assert (r.predicted, r.correct, r.wrong_partner, r.unverifiable, r.false_positive) == (4, 1, 1, 1, 1)
    assert abs(r.precision_known - 1 / 3) < 1e-12 and r.recall_known == 0.5
    scores = spark.createDataFrame([(1, 100, 20.0), (2, 200, 9.0), (4, 200, 12.0)], "row_1 int, row_2 int, score double")
    got = {(r.prior, r.thr): (r.predicted, r.correct) for r in evaluation.sweep(scores, truth, {"now": 1e-3}, [0.1, 0.9]).collect()}
    for thr in (0.1, 0.9):
        kept = [x for x in scores.collect() if 1 / (1 + 2 ** -(x.score + np.log2(1e-3 / 0.999))) >= thr]
        one = evaluation.metrics(assignment.one_to_one(spark.createDataFrame(kept)).where("selected"), truth).head()
        assert got["now", thr] == (one.predicted, one.correct)


def some_records(spark, n=120):
    rng = random.Random(5)
    rows = [(i, "d1" if i % 3 else "d2", rng.choice(["A", "A", "A", "B", None]), rng.sample(["x", "y", "z", "w"], rng.randrange(4)) or None, [rng.choice("12345"), "9", "9"] if i % 4 == 0 else None, "Male") for i in range(n)]
    return rows, spark.createDataFrame(rows, "unique_id long, source_dataset string, adm2 string, block_tokens array<string>, phones array<string>, sex string")


def test_candidates_by_brute_force(spark, monkeypatch):
    """Common keys are cut into chunks, sets share several members, and passes reach the same pairs."""
    monkeypatch.setattr(blocking, "CHUNK", 7)
    rows, df = some_records(spark)
    share = lambda a, b: bool(set(a or ()) & set(b or ()))
    want = {}
    for a in rows:
        for b in rows:
            if a[1] == "d1" and b[1] == "d2":
                held = [a[2] is not None and a[2] == b[2], share(a[3], b[3]), share(a[4], b[4])]
                if any(held):
                    want[a[0], b[0]] = held.index(True)
    got = blocking.candidates(df).collect()
    assert len(got) == len(want) and {(r.id_l, r.id_r): r.match_key for r in got} == want
    both = [tuple(r) for r in blocking.block(df, "adm2", "block_tokens").collect()]
    one = {(a[0], b[0]) for a in rows for b in rows if a[1] == "d1" and b[1] == "d2" and a[2] is not None and a[2] == b[2] and share(a[3], b[3])}
    assert len(both) == len(one) and set(both) == one


def test_pairs_are_not_shuffled(spark):
    """No join, aggregate or exchange goes by the ids of pairs, so disk does not grow with their number."""
    _, df = some_records(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for made in (cmp.gammas(blocking.met(df, ("adm2",)), [cmp.SEX]), blocking.candidates(df)):
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and not re.search(r"(Join|Exchange hashpartitioning|keys=)\s*[\[(][^\]]*\bid_[lr]#", plan), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
