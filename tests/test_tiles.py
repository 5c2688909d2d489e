"""Levels of whole blocks against the same levels pair by pair."""

import random

import numpy as np
import pytest

from linkloom.functions import kernels, tiles
from linkloom.operators import blocking, scoring, tiling, training
from linkloom.operators import comparisons as cmp
from linkloom.operators.model import LinkModel

RECORD = "unique_id long, source_dataset string, name_tokens array<string>, block_tokens array<string>, tf_tokens array<string>, tf_bits array<double>, name_key string, age int, sex string, adm1 string, adm2 string, adm3 string, adm4_tokens array<string>, job_cats array<string>, phones array<string>"
WORDS = ["MARTHA", "MARHTA", "DWAYNE", "DUANE", "DIXON", "DICKSONX", "A", "D", "AB", "É1", "X" * 70, "X" * 69 + "Y", "M" * 20, "M" * 18 + "NM", "JEAN", "JEANNE"]


def people(seed=3, each=60):
    rng = random.Random(seed)
    some = lambda x, most: rng.sample(x, rng.randint(0, most)) or None
    out = []
    for k in range(2 * each):
        name = [rng.choice(WORDS) for _ in range(rng.randint(0, 4))] or None
        tf = list(dict.fromkeys(t for t in name or [] if len(t) > 1)) or None
        out.append((k // 2, f"d{1 + k % 2}", name, tf, tf, [float(WORDS.index(t)) + 0.5 for t in tf] if tf else None, None, rng.choice([None, *range(20, 30)]), rng.choice([None, "Male", "Female"]), *[rng.choice([None, "U", "V"]) for _ in range(3)], some(["P", "Q", "R"], 2), some(["farmer", "miner"], 2), some(["812345678", "812345687", "81234567", "991234567"], 2)))
    return out


@pytest.mark.parametrize("few, chunk", [(1, 7), (10**9, 4096), (1, 4096)])
def test_tiles_are_the_levels_of_pairs(spark, monkeypatch, few, chunk):
    monkeypatch.setattr(tiling, "FEW", few)
    monkeypatch.setattr(tiling, "TILE", 50)
    monkeypatch.setattr(blocking, "CHUNK", chunk)
    df, cs = spark.createDataFrame(people(), RECORD).cache(), cmp.default()
    names = [f"gamma_{c.name}" for c in cs]
    want = sorted(map(tuple, cmp.gammas(blocking.met(df), cs).select("id_l", "id_r", *names).collect()))
    got = tiling.levels(df, cs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "MapInArrow" in plan
    assert sorted(map(tuple, got.select("id_l", "id_r", *names).collect())) == want
    counted = {tuple(r)[:-1]: r.n for r in tiling.levels(df, cs, count=True).select(*names, "n").collect()}
    assert counted == {k: sum(w[2:] == k for w in want) for k in {w[2:] for w in want}}


def test_pruned_and_counted_scores(spark):
    df, model = spark.createDataFrame(people(), RECORD).cache(), LinkModel.published(1e-3)
    rows = scoring.score(None, df, model).collect()
    by_pair = {(r.id_l, r.id_r): r for r in scoring.score(blocking.candidates(df), df, model).collect()}
    assert {(r.id_l, r.id_r): r for r in rows} == by_pair and len(rows) == len(by_pair)
    cut = sorted(r.match_weight for r in rows)[-len(rows) // 5]
    assert {(r.id_l, r.id_r): r for r in scoring.predict(df, model, cut).collect()} == {k: r for k, r in by_pair.items() if r.match_weight >= cut}
    assert {r.bin: r.n for r in scoring.histogram(scoring.counts(df, model)).collect()} == {r.bin: r.n for r in scoring.histogram(scoring.predict(df, model)).collect()}
    asked = spark.createDataFrame([(a, b) for a in range(0, 60, 3) for b in range(60)], "id_l long, id_r long")
    assert {(r.id_l, r.id_r): r for r in scoring.predict_of(asked, df, model).collect()} == {k: r for k, r in by_pair.items() if k[0] % 3 == 0}


def test_cross_counts(spark):
    df = spark.createDataFrame(people(5), RECORD).cache()
    for c in cmp.default():
        left, right = (d.selectExpr(*[f"{x} as {x}_{s}" for x in c.inputs]) for s, d in zip("lr", blocking.sides(df), strict=True))
        want = {r[0]: r[1] for r in cmp.gammas(left.crossJoin(right), [c]).groupBy(f"gamma_{c.name}").count().collect()}
        assert {r.gamma: r.n for r in training.level_counts(df, c).collect()} == want


def test_one_against_many():
    rng = random.Random(1)
    words = ["".join(rng.choices("ABCD", k=rng.randint(1, 30 if k % 5 else 70))) for k in range(200)] + WORDS
    many = tiles.Vocabulary(words)
    import pyarrow as pa

    tokens = kernels.Tokens(pa.array(words, pa.large_string()))
    for k in (*range(0, 200, 7), *range(200, len(words))):
        got = many.similarity(words[k])[:-1]
        want = np.array(tokens.similarity(np.full(len(words), k), np.arange(len(words))))
        assert np.abs(got - want).max() < 1e-6, words[k]


def test_names_of_a_block_are_compared_many_tokens_at_once(monkeypatch):
    """Against each pair alone, with room for a few tokens only, and without a call for each token where there is room."""
    import pyarrow as pa

    rng = random.Random(4)
    words = [*WORDS, *("".join(rng.choices("ABCDE", k=rng.randint(2, 9))) for _ in range(60))]
    names = [rng.sample(words, rng.randint(0, 6)) or None for _ in range(240)]
    table = pa.table({"name_tokens": names, "tf_tokens": names, "tf_bits": [[1.0 + len(t) for t in n] if n else None for n in names]})
    i, j, c = np.arange(120), np.arange(120, 240), cmp.name()
    calls, whole = [], tiles.Vectors.similarities
    monkeypatch.setattr(tiles.Vectors, "similarities", lambda self, xs: calls.append(len(xs)) or whole(self, xs))
    one = tiles.Batch(table)
    want = one.name_levels(np.repeat(i, len(j)), np.tile(j, len(i)), *c.names).reshape(len(i), len(j))
    assert not calls and len(np.unique(want)) > 5
    for kept, cells, named in ((1 << 26, 1 << 16, 1 << 16), (1 << 12, 1 << 6, 7)):
        monkeypatch.setattr(tiles, "KEPT", kept)
        monkeypatch.setattr(tiles, "CELLS", cells)
        monkeypatch.setattr(tiles, "NAMED", named)
        calls.clear()
        b = tiles.Batch(table)
        b.begin(i, j, *c.names)
        assert (b.name_levels(i[:, None], j[None], *c.names) == want).all()
        assert sum(calls) >= len(words) and (len(calls) < len(words) or kept < 1 << 26)


@pytest.mark.parametrize("few, tile, kept", [(1, 50, 1 << 12), (10**9, 50, 1 << 26), (1, 1 << 18, 1 << 26)])
def test_names_of_a_pass_are_compared_once(spark, monkeypatch, few, tile, kept):
    """The very values of the pairs one by one, without a comparison of each in the engine."""
    monkeypatch.setattr(tiling, "FEW", few)
    monkeypatch.setattr(tiles, "TILE", tile)
    monkeypatch.setattr(tiles, "KEPT", kept)
    df = spark.createDataFrame([(*p[:3], p[12], *p[4:]) for p in people(8)], RECORD).cache()
    for key in ("adm2", "block_tokens"):
        want = cmp.gammas(blocking.met(df, (key,)), [cmp.name()]).select("id_l", "id_r", "name_sim", "shared_bits", "gamma_name")
        got = tiling.names(df, cmp.name(), key)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" not in plan and got.dtypes == want.dtypes
        rows = sorted(map(tuple, got.collect()), key=lambda r: r[:2])
        assert rows == sorted(map(tuple, want.collect()), key=lambda r: r[:2]) and len({r[4] for r in rows}) > 5 and any(r[2] is None for r in rows)


def test_levels_by_factor_are_told_once_a_level(spark):
    """As told pair by pair from the factors, without a logarithm of each pair's."""
    from pyspark.sql import functions as F

    df, model = spark.createDataFrame(people(), RECORD).cache(), LinkModel.published(1e-3)
    names = [c.name for c in model.comparisons]
    want = scoring.predict(df, model).select("id_l", "id_r", *[scoring.nearest_level(F.col(f"bf_{c}"), model, c).alias(c) for c in names])
    got = scoring.levels_by_factor(df, model)
    assert got.dtypes == want.dtypes and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LOG2" not in plan and "array_min" not in plan


@pytest.mark.parametrize("few, tile, flags", [(1, 50, 1 << 22), (10**9, 1 << 18, 1 << 22), (1, 1 << 18, 10)])
def test_rounded_scores_are_told_once_a_combination(spark, monkeypatch, few, tile, flags):
    """As each pair's score rounded in the engine, without a logarithm or a rounding of each pair there."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(tiling, "FEW", few)
    monkeypatch.setattr(tiling, "TILE", tile)
    monkeypatch.setattr(tiling, "FLAGS", flags)
    df, model = spark.createDataFrame(people(), RECORD).cache(), LinkModel.published(1e-3)
    want = scoring.predict(df, model).withColumns({c: F.round(c, 6) for c in ("match_weight", "match_probability", "bf_tf_adj_geo")})
    got = scoring.predict(df, model, digits=6)
    rows = sorted(map(tuple, got.collect()))
    assert got.dtypes == want.dtypes and rows == sorted(map(tuple, want.collect())) and len({r[2] for r in rows}) > 20
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LOG2(" not in plan.split("MapInArrow")[0] and "round(" not in plan.split("MapInArrow")[0]
    high = {tuple(r) for r in scoring.score(None, df, model, least=0.0, digits=6).collect()}
    assert {r for r in rows if r[2] >= 0.0} == high


def test_rounded_as_the_engine_rounds(spark):
    from pyspark.sql import functions as F

    rng = random.Random(2)
    x = [k / 1024 for k in range(-99, 99)] + [rng.random() * 30 for _ in range(300)] + [float(f"{rng.random():.9f}5") for _ in range(300)]
    for digits in (6, 9):
        want = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").select(F.round("x", digits)).collect()]
        assert tiles.half_up(np.array(x), digits).tolist() == want


def test_faults_are_told_without_a_shuffle_of_pairs(spark, monkeypatch):
    """Lists of all candidates, each once, in cells of their own; pairs within a table and repeated ones are counted in their cell."""
    from pyspark.sql import functions as F

    from linkloom.operators import assignment

    monkeypatch.setattr(tiling, "WIDE", 25)
    monkeypatch.setattr(tiling, "LISTED", 40)
    monkeypatch.setattr(tiling, "PIECE", 3)
    df = spark.createDataFrame([(*p[:3], p[12], *p[4:]) for p in people()], RECORD).cache()  # tokens to block by: the village's
    lists = tiling.lists(df, ("adm2", "block_tokens", "phones")).cache()
    pairs = lists.select("id_l", F.explode("ids_r").alias("id_r"), "cell", F.spark_partition_id().alias("part")).collect()
    want = sorted(map(tuple, blocking.candidates(df).select("id_l", "id_r").collect()))
    assert sorted((r.id_l, r.id_r) for r in pairs) == want and len({(r.part, r.cell) for r in pairs}) > 20
    bad = lists.withColumn("kind", F.explode(F.expr("CASE WHEN id_l % 3 = 0 THEN array(0, 1, 1, 2) WHEN id_l % 7 = 0 THEN array(0, 3) ELSE array(0) END")))
    ids = F.expr("CASE kind WHEN 1 THEN slice(ids_r, 1, 1) WHEN 3 THEN transform(ids_r, x -> -x - 1) ELSE ids_r END")
    bad = bad.select(F.expr("CASE WHEN kind = 2 THEN 'd2' ELSE 'd1' END").alias("source_dataset_l"), F.col("id_l").alias("unique_id_l"), F.expr("CASE WHEN kind = 3 THEN 'd1' ELSE 'd2' END").alias("source_dataset_r"), ids.alias("unique_ids_r"), "cell")
    plain = bad.withColumn("unique_id_r", F.explode("unique_ids_r")).withColumns({"match_weight": F.lit(0.0), "match_probability": F.lit(0.5)})
    got = assignment.faults_of_lists(bad)
    assert "hashpartitioning(row_1" not in got._jdf.queryExecution().executedPlan().toString()
    found = {tuple(r) for r in got.collect()}
    assert {w for w, _ in found} == {"same_dataset", "repeated_pair"}
    # a pair turned round (second table first) may meet its twin in another cell, so these are held against the plain count of their cell
    cell = plain.select("cell", F.when(F.col("source_dataset_l") == "d1", F.col("unique_id_l")).otherwise(F.col("unique_id_r")).alias("a"), F.when(F.col("source_dataset_l") == "d1", F.col("unique_id_r")).otherwise(F.col("unique_id_l")).alias("b"), F.spark_partition_id().alias("part"))
    assert ("repeated_pair", cell.groupBy("part", "cell", "a", "b").count().where("count > 1").count()) in found
    assert ("same_dataset", plain.where("source_dataset_l = source_dataset_r").count()) in found
    assert assignment.repeated([(np.array([1, 1, 2, 1, 2]), np.array([5, 6, 5, 5, 5]))]) == 2
    far = np.array([-(2**62), 2**62, -(2**62)])
    assert assignment.repeated([(far, far)]) == 1
    sound = lists.select(F.lit("d1").alias("source_dataset_l"), F.col("id_l").alias("unique_id_l"), F.lit("d2").alias("source_dataset_r"), F.col("ids_r").alias("unique_ids_r"), "cell")
    assert assignment.faults_of_lists(sound).collect() == []
