"""Normalisers and similarities against worked examples."""

import pytest
from pyspark.sql import functions as F

from linkloom.functions import occupations, phones, places, similarity, text


def values(spark, rows, f):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_std_text(spark):
    got = values(spark, ["Jean-Pierre N'Golo", "Müller, François", "  ,. ", None, "Straße Æble"], text.std_text)
    assert got == ["JEAN PIERRE N GOLO", "MULLER FRANCOIS", None, None, "STRASSE AEBLE"]


def test_name_tokens(spark):
    assert values(spark, ["SMITH, John R", None, "a a"], text.name_tokens) == [["SMITH", "JOHN", "R"], [], ["A", "A"]]


def test_village_tokens(spark):
    rows = ["Q. de l'Hopital", "RUGHENDA N°258", "Q 9 AV NK NUM 107", "SOME 26KM", "MASANGE II", "Q.", None, "PK 14"]
    assert values(spark, rows, places.adm4_tokens) == [["HOPITAL"], ["RUGHENDA"], ["NK"], ["SOME", "PK26"], ["MASANGE", "II"], [], [], ["PK14"]]


def test_phones(spark):
    rows = ["+243 812 345 678", "8123O5678", "0812345678 0991234567", "0812 345 678", "8.1234567809912345E+18", "12345", "000000000", "12345678901234", None, "0812345678/0812345678"]
    assert values(spark, rows, phones.phone_set) == [["812345678"], ["812305678"], ["812345678", "991234567"], ["812345678"], ["812345678"], [], [], [], [], ["812345678"]]


def test_occupations(spark):
    rows = ["Ecolier/ière-Elève", "Planteur/Eleveur", "Agent de Transport marchandise", "Médecin traditionnel", "Autre: Orpailleur", "Inc.", "Zork", None]
    assert values(spark, rows, occupations.from_text) == [["student"], ["farmer"], ["transport"], ["traditional_healer"], ["miner"], [], ["other"], []]


def test_occupation_flags(spark):
    df = spark.range(1)
    off = dict.fromkeys(occupations.FLAGS, F.lit(None).cast("boolean"))
    f = lambda on, other, detail: df.select(occupations.from_flags(off | {k: F.lit(True) for k in on}, F.lit(other), F.lit(detail).cast("string"))).head()[0]
    assert f(["farmer", "hcw"], None, None) == ["farmer", "health"]
    assert f([], True, None) == ["other"]
    assert f([], True, "inconnu") == []
    assert f(["student"], True, "zork") == ["student"]


@pytest.mark.parametrize(("a", "b", "want"), [("MARTHA", "MARHTA", 0.961), ("DIXON", "DICKSONX", 0.813), ("A", "B", 0.0), ("ABC", "ABC", 1.0)])
def test_jaro_winkler(spark, a, b, want):
    got = spark.range(1).select(similarity.jaro_winkler(F.lit(a), F.lit(b))).head()[0]
    assert round(got, 3) == want


def test_name_similarity(spark):
    rows = [(["JEAN", "PAUL"], ["PAUL", "JEAN"]), (["J", "PAUL"], ["JEAN", "PAUL"]), ([], ["A"])]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    got = [r[0] for r in df.select(similarity.name_sim(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 1.0 and abs(got[1] - 0.975) < 1e-9 and got[2] is None


def test_one_edit(spark):
    df = spark.createDataFrame([("1234", "1243"), ("1234", "124"), ("1234", "1235"), ("1234", "1234"), ("1234", "4321")], "a string, b string")
    assert [r[0] for r in df.select(similarity.one_edit(F.col("a"), F.col("b"))).collect()] == [True, True, True, False, False]
