"""The pipeline on the smallest tables: every stage keeps the columns and does its work."""

import corpus_pipeline as p
from linkloom.llm import jaccard


def test_stages(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, d).toArrow())
        assert docs.columns == p.COLUMNS, name
        if name == "ngram_jaccard_join":
            assert jaccard.join(docs).where("doc_id <> component_id").count() == 0
    n = docs.count()
    assert p.STAGES[-1][1](spark, docs, d).count() == n > 0


def test_language_stage_fills_null_and_keeps_all_where_nothing_is_learned(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, "the dog and the cat", None), (4, "12 34", None), (5, None, "en")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, "web", 1) for r in rows], schema)
    got = {r.doc_id: r.lang for r in p.language(spark, docs, "").collect()}
    assert got == {1: "en", 2: "fr", 3: "en"}
    none = spark.createDataFrame([(i, t, None, "web", 1) for i, t, _ in rows], schema)
    assert {r.doc_id: r.lang for r in p.language(spark, none, "").collect()} == {1: None, 2: None, 3: None}


def test_stages_on_nulls_copies_and_benchmark_items(spark, tmp_path):
    """Null and empty texts, repeated rows, null ids, languages and sources, extra columns; a document that holds a five-word item goes."""
    noise = lambda k: " ".join(f"w{k}x{i} the word" for i in range(12))
    rows = [(i, noise(i), "en", "src1", 5) for i in range(8)] + [(20, noise(0), "en", "src2", 5), (21, noise(41) + " so just five, words in here now", "en", "src1", 5), (22, None, "en", "src1", 5), (23, "", None, None, 0), (24, "so just five words in here and more of it", "en", None, None), (3, noise(3), "en", "src1", 5), (None, noise(30), None, "src1", 1)]
    spark.createDataFrame([(1, "just five words in here"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(*r, "own", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, node string, mix_tokens int")
    got = {}
    for name, stage in p.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).toArrow())
        got[name] = sorted((-1 if r.doc_id is None else r.doc_id) for r in docs.collect())
        assert docs.columns == p.COLUMNS
    assert got["language_id"] == sorted([-1, 3, *range(8), 20, 21, 24])
    assert got["ngram_jaccard_join"] == sorted([-1, 3, *range(8), 21, 24])
    assert got["benchmark_decontamination"] == sorted([-1, 3, *range(8)])
    assert set(got["mix_sources"]) <= {-1, *range(8)}
    empty = docs.limit(0)
    for name, stage in p.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
