"""Reports, kernels, folding, harmonising and training on small cases of their own."""

import random
import zipfile
from xml.etree import ElementTree

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.functions import kernels, similarity, text
from linkloom.operators import assignment, records, scoring, training
from linkloom.operators import comparisons as cmp
from linkloom.operators.model import LinkModel
from linkloom.plans import oracle
from linkloom.sources import tables


def test_jaro_kernel_against_the_plain_one_and_another_engine():
    rng = random.Random(2)
    words = ["".join(rng.choice("ABCDE") for _ in range(rng.randint(1, 9))) for _ in range(200)] + ["A" * 63, "A" * 64, "A" * 65 + "B", "AB" * 40, "BA" * 40]
    a, b = ([rng.choice(words) for _ in range(3000)] for _ in range(2))
    tokens, (x, y) = kernels.numbered(pa.array(a), pa.array(b))
    got = tokens.jaro(x, y)
    assert got.tolist() == [kernels.jaro_of(p, q) for p, q in zip(a, b, strict=True)]
    con = duckdb.connect()
    con.register("p", pa.table({"i": range(3000), "a": a, "b": b}))
    want = [r[0] for r in con.execute(f"SELECT {oracle.jw('a', 'b')} FROM p ORDER BY i").fetchall()]
    assert max(abs(p - q) for p, q in zip(tokens.jaro_winkler(x, y), want, strict=True)) < 1e-12


def test_name_similarity_kernel_against_plain_loops(monkeypatch):
    monkeypatch.setattr(kernels, "PAIRS", 50)
    rng = random.Random(4)
    words = ["".join(rng.choice("ABC") for _ in range(rng.randint(1, 5))) for _ in range(30)]
    a, b = ([rng.choice([None, [], *[[rng.choice(words) for _ in range(rng.randint(1, 4))] for _ in range(6)]]) for _ in range(400)] for _ in range(2))

    def one(t, s):
        if t == s:
            return 1.0
        j = kernels.jaro_of(t, s)
        same = next((i for i in range(4) if t[i : i + 1] != s[i : i + 1] or i >= len(t)), 4)
        return max(j + 0.1 * same * (1 - j), 0.95 if 1 in (len(t), len(s)) and t[0] == s[0] else 0.0)

    def plain(p, q):
        if not p or not q:
            return None
        return (sum(max(one(t, s) for s in q) for t in p) / len(p) + sum(max(one(t, s) for t in p) for s in q) / len(q)) / 2

    kind = pa.list_(pa.string())
    got = kernels.name_similarity(pa.array([["X"], *a], kind).slice(1), pa.array(b, kind)).to_pylist()
    want = [plain(p, q) for p, q in zip(a, b, strict=True)]
    assert all((x is None and y is None) or abs(x - y) < 1e-12 for x, y in zip(got, want, strict=True))


def test_similarities_of_nulls_and_none(spark):
    df = spark.createDataFrame([("MARTHA", "MARHTA"), (None, "A"), ("", "A"), ("J", "JEAN")], "a string, b string")
    got = df.select(F.round(similarity.jaro_winkler(F.col("a"), F.col("b")), 4).alias("j"), similarity.token_sim(F.col("a"), F.col("b")).alias("t")).collect()
    assert [r.j for r in got][:3] == [0.9611, None, 0.0] and got[3].t == 0.95
    assert df.limit(0).select(similarity.jaro(F.col("a"), F.col("b"))).collect() == []


def test_folding_covers_latin_and_signs(spark):
    pairs = {"ŉ": "'n", "Ǆ": "DZ", "ﬁ": "fi", "ƒ": "f", "ƀ": "b", "ɓ": "b", "Ŋ": "N", "ŋ": "n", "ſ": "s", "ĸ": "q", "ß": "ss", "Œ": "OE", "Ø": "O", "é": "e", "Ａ": "A", "–": "-", "中": "中", "º": "º"}
    df = spark.createDataFrame(list(pairs.items()), "a string, b string")
    assert {r.a: r.x for r in df.select("a", text.ascii_fold(F.col("a")).alias("x")).collect()} == pairs


def test_xlsx_holds_the_report(spark, tmp_path):
    path = str(tmp_path / "x.xlsx")
    tables.save_xlsx(spark.createDataFrame([("a <&> é", 2, ["x", "y"]), (None, 3, [])], "raw string, n long, cats array<string>"), path)
    root = ElementTree.fromstring(zipfile.ZipFile(path).read("xl/sheet.xml"))
    rows = [["".join(c.itertext()) for c in r] for r in root.iter("{http://schemas.openxmlformats.org/spreadsheetml/2006/main}row")]
    assert rows == [["raw", "n", "cats"], ["a <&> é", "2", "x; y"], ["", "3", ""]]
    with pytest.raises(ValueError, match="more than"):
        tables.save_xlsx(spark.range(5), path, most=4)


def test_harmonize_aligns_places_and_drops_shared_phones(spark):
    kind = "row long, adm1 string, adm2 string, adm3 string, adm4_tokens array<string>, phones array<string>"
    one = [(i, "NORD KIVU", "BENI", "MABALAKO", ["RUGHENDA"], ["111222333"] if i < 8 else [f"70000{i:04d}"]) for i in range(120)] + [(500, "NORD KIV", "BUTEMBO", "KATWAA", ["MASANGE"], [])]
    two = [(i, "NORD KIVU", "BENNI", "MABALACO", ["RUGENDA", "RUGHENDA"], ["111222333"] if i < 1004 else []) for i in range(1000, 1010)] + [(2000, "ITURI", "BENI", "KATWA", None, None)] + [(2001 + i, "NORD KIVU", "BENI", "KATWA", ["MASANGE"], ["5"]) for i in range(3)]
    d1, d2 = records.harmonize(spark.createDataFrame(one, kind), spark.createDataFrame(two, kind))
    d1, d2 = ({r.row: r for r in d.collect()} for d in (d1, d2))
    assert d1[500].adm1 == "NORD KIVU" and d2[1000].adm2 == "BENI" and d2[1000].adm3 == "MABALAKO" and d2[1000].adm4_tokens == ["RUGHENDA"]
    assert d2[2000].adm3 == "KATWAA" and d2[2000].adm4_tokens is None and d1[500].adm3 == "KATWAA"
    assert d1[0].phones == [] and d2[1000].phones == [] and d1[9].phones == ["700000009"] and d2[2001].phones == ["5"]


RECORD = "unique_id long, source_dataset string, name_tokens array<string>, block_tokens array<string>, tf_tokens array<string>, tf_bits array<double>, name_key string, date date, age int, sex string, adm1 string, adm2 string, adm3 string, adm4_tokens array<string>, job_cats array<string>, phones array<string>"


def person(i, table, name="JEAN KAMBALE", age=30, adm3="KATWA"):
    return (i, table, name.split(), name.split(), name.split(), [9.0] * len(name.split()), " ".join(sorted(name.split())), None, age, "Male", "NORD KIVU", "BENI", adm3, ["MASANGE"], ["farmer"], [f"81234567{i % 10}"])


def test_training_without_pairs_in_a_block(spark):
    rows = [person(1, "d1", "AA BB"), person(2, "d1", "CC DD", 40), person(1, "d2", "EE FF", 50, "OTHER")]
    model, info = training.train(spark.createDataFrame(rows, RECORD), cmp.default(), 1.0)
    assert info["key_pairs"] == info["area_pairs"] == 0 and all(0 <= x <= 1 for c in model.m.values() for x in c)
    with pytest.raises(ValueError, match="no pairs"):
        training.train(spark.createDataFrame(rows[:2], RECORD), cmp.default(), 1.0)


def test_deactivation_follows_the_blocks_columns():
    names = lambda *keys: [c.name for c in training.estimable(cmp.default(), *keys)]
    assert names("name_key") == ["age", "sex", "geo", "job", "phone"] and names("adm3", "age") == ["name", "sex", "job", "phone"]


def test_unlinkables_keep_tables_apart(spark):
    """Id 1 stands in both tables for different people; each meets itself alone."""
    rows = [person(1, "d1"), person(1, "d2", "ZAWADI", None, None), person(2, "d2")]
    df = spark.createDataFrame(rows, RECORD)
    own = {(r.source_dataset, r.unique_id): r.match_weight for r in scoring.self_weights(df, LinkModel.published(1e-3)).collect()}
    assert len(own) == 3 and own["d1", 1] == own["d2", 2] > own["d2", 1]
    got = scoring.unlinkables(df, LinkModel.published(1e-3)).collect()
    assert [round(r.share, 6) for r in sorted(got, key=lambda r: r.match_weight)] == [round(1 / 3, 6), 1.0]


def test_a_chain_of_links_ends_in_few_rounds(spark, monkeypatch):
    rows = [(i // 2 + i % 2, i // 2, float(-i)) for i in range(60)]
    df = spark.createDataFrame(rows, "row_1 int, row_2 int, score double")
    want = set(assignment.finished(rows, 0))
    for most in (100_000, 40):
        monkeypatch.setattr(assignment, "FINISH", most)
        assert {(r.row_1, r.row_2) for r in assignment.one_to_one(df).where("selected").collect()} == want


@pytest.mark.parametrize("keys", [(), ("run",)])
def test_assignment_of_rounds_and_finish(spark, monkeypatch, keys):
    """Rounds on the engine, then the rest on the driver, in the same order; ties go by row_1, then row_2."""
    rows = [(*(["x"] if keys else []), i, (i * 7 + j * 11) % 60, float((i * j) % 4)) for i in range(60) for j in range(9)]
    rows = list({r[:-1]: r for r in rows}.values())
    df = spark.createDataFrame(rows, f"{'run string, ' if keys else ''}row_1 long, row_2 long, score double")
    want = set(assignment.finished(rows, len(keys)))
    for most in (0, 150):
        monkeypatch.setattr(assignment, "FINISH", most)
        got = assignment.one_to_one(df, keys).collect()
        assert len(got) == len(rows)
        assert {tuple(r)[:-2] for r in got if r.selected} == want


def test_assignment_drops_pairs_of_taken_rows_before_the_driver(spark, monkeypatch):
    """Many parts: the selected pairs are those of all pairs at once, though few of the later ones come to the driver."""
    rng = random.Random(8)
    rows = [(i, 1000 + j, float(rng.randint(0, 30)) if i % 3 else 7.5) for i in range(60) for j in range(50)]
    want, came, plain = set(assignment.finished(rows, 0)), [], assignment.greedy
    monkeypatch.setattr(assignment, "FINISH", 200)
    monkeypatch.setattr(assignment, "greedy", lambda p, *a: came.append(p.num_rows) or plain(p, *a))
    got = assignment.chosen(spark.createDataFrame(rows, "row_1 long, row_2 long, score double").repartition(3)).collect()
    assert {(r.row_1, r.row_2) for r in got} == want and len(got) == 50
    assert sum(came) < len(rows) // 2 and max(came) <= 800
