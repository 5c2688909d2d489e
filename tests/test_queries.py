"""Registered queries on small tables of their own, whole."""

import duckdb
import pytest

from linkloom.operators import comparisons as cmp
from linkloom.operators import training
from linkloom.plans import fixture, oracle, queries


@pytest.fixture
def folder(spark, tmp_path):
    def write(texts):
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)

    return write


def test_std_text_whole(spark, folder):
    texts = ["é-" * 150 + "Tail ß" + " x" * 5000, "short  one", "." * 300 + "late", "", None, "." * 400]
    d = folder(texts)
    got = {r.doc_id: r["std"] for r in queries.QUERIES["std_text"](spark, d).collect()}
    sql = oracle.sql(f"SELECT doc_id, {oracle.std('text')} AS std FROM documents", "none AS (SELECT 1)")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet/*.parquet')")
    assert got == dict(con.execute(sql).fetchall())
    assert got[0].endswith("TAIL SS" + " X" * 5000)
    assert got[2] == "LATE" and got[3] is got[4] is got[5] is None


def test_std_text_repairs_the_tail(spark, tmp_path):
    raw = b"a " * 150 + b"caf\xe9 end"
    df = spark.createDataFrame([(1, bytearray(raw))], "doc_id long, b binary").selectExpr("doc_id", "cast(b AS string) AS text")
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.QUERIES["std_text"](spark, str(tmp_path)).head()["std"] == "A " * 150 + "CAFE END"


def test_jaro_winkler_pairs_of_all_tokens(spark, tmp_path):
    names = ["A AB BA MARTHA", "ABC ACB B DWAYNE", "MARHTA DUANE A AB", "DIXON ABCD BADC DICKSONX", ""]
    docs = [(i, x + " more words", "en", "web", len(x)) for i, x in enumerate(names)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {(r.t, r.s): (r.jaro, r.jw) for r in queries.QUERIES["jaro_winkler_pairs"](spark, str(tmp_path)).collect()}
    tokens = sorted({t for x in names for t in x.split()} | {"MORE", "WORDS"})
    assert set(got) == {(a, b) for a in tokens for b in tokens if a < b}
    con = duckdb.connect()
    for (a, b), x in got.items():
        assert x == con.execute(f"SELECT round(jaro_similarity($1, $2), 9), round({oracle.jw('$1', '$2')}, 9)", [a, b]).fetchone(), (a, b)


def test_em_parameters_count_u_on_all_pairs(spark):
    d = "/root/testdata/sf0.001"
    rows = queries.QUERIES["em_parameters"](spark, d).collect()
    r = fixture.records(spark, d).persist()
    n = {x[0]: x[1] for x in r.groupBy("source_dataset").count().collect()}
    total = n["d1"] * n["d2"]
    for c in cmp.default():
        counts = {x.gamma: x.n for x in training.level_counts(r, c).collect()}
        assert sum(counts.values()) == total
        seen = sum(k for g, k in counts.items() if g >= 0)
        got = [x for x in rows if x.variable == c.name]
        for i, x in enumerate(got):
            share = max(counts.get(i, 0) / seen if seen else 0.0, 1 / total)
            assert abs(x.u - max((share - 30 / total * x.m) / (1 - 30 / total), 1 / total)) < 1e-12, (c.name, x.level)
    r.unpersist()
