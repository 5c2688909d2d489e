"""A query for each operator, over the generated records, and the SQL it is held against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import occupations, phones, places, similarity, text
from linkloom.operators import assignment, audit, blocking, evaluation, scoring, tiling, training, vocab
from linkloom.operators import comparisons as cmp
from linkloom.operators.model import LinkModel
from linkloom.plans import fixture
from linkloom.plans import oracle as o
from linkloom.sources.tables import cut

PRIOR = 1e-3
FUTURE = evaluation.Future(3e4, 1500.0, 150.0)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def scratch(spark: SparkSession, name: str) -> str:
    """A folder for a table that a query writes, where driver and executors see it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/linkloom"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def joined(a: str, sep: str = "|") -> str:
    return f"array_to_string({a}, '{sep}')"


def txt(c: str, name: str | None = None):
    return F.array_join(c, "|").alias(name or c)


# Normalisers.


@query(o.sql(f"SELECT doc_id, {o.std('text')} AS std FROM documents", "none AS (SELECT 1)"))
def std_text(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", text.std_text(F.col("text")).alias("std"))


@query(o.sql("SELECT row, array_to_string(name_tokens, '|') AS name_tokens, len(name_tokens)::BIGINT AS n, len(list_filter(name_tokens, lambda t: length(t) = 1))::BIGINT AS initials, nullif(array_to_string(list_sort(list_filter(name_tokens, lambda t: length(t) >= 2)), ' '), '') AS name_key FROM clean", o.FIXTURE, o.CLEAN))
def name_tokens(spark, d):
    t = F.col("name_tokens")
    return fixture.clean(spark, d).select("row", txt("name_tokens"), F.size(t).cast("long").alias("n"), F.size(F.filter(text.is_initial(t), lambda x: x)).cast("long").alias("initials"), text.name_key(t).alias("name_key"))


@query(o.sql("SELECT row, array_to_string(adm4_tokens, '|') AS tokens, nullif(array_to_string(adm4_tokens, ' '), '') AS adm4_std FROM clean", o.FIXTURE, o.CLEAN))
def adm4_tokens(spark, d):
    return fixture.rows(spark, d).select("row", F.array_join(places.adm4_tokens(F.col("adm4")), "|").alias("tokens"), places.adm4_std(F.col("adm4")).alias("adm4_std"))


@query(o.sql("SELECT row, array_to_string(job_cats, '|') AS cats, list_filter(['traditional_healer','health','miner','security','transport','trade','farmer','artisan','professional','religious','student','housewife','child','none','other'], lambda p: list_contains(job_cats, p))[1] AS job, nullif(array_to_string(list_filter(job_cats, lambda t: t NOT IN ('child', 'other')), '|'), '') AS compared FROM clean", o.FIXTURE, o.CLEAN))
def job_categories(spark, d):
    c = fixture.clean(spark, d)
    return c.select("row", txt("job_cats", "cats"), occupations.primary(F.col("job_cats")).alias("job"), occupations.as_string(occupations.compared(F.col("job_cats"))).alias("compared"))


@query(o.sql("SELECT row, array_to_string(phones, '|') AS phones, phones[1] AS phone_1 FROM clean", o.FIXTURE, o.CLEAN))
def phone_sets(spark, d):
    return fixture.rows(spark, d).select("row", F.array_join(phones.phone_set(F.col("phone_raw")), "|").alias("phones"), *phones.phone_columns(F.col("phone_raw"), 1))


@query(o.sql("SELECT row, age, sex, adm1, adm2, adm3 FROM clean", o.FIXTURE, o.CLEAN))
def clean_scalars(spark, d):
    return fixture.clean(spark, d).select("row", "age", "sex", "adm1", "adm2", "adm3")


# Vocabularies.


@query(o.sql("SELECT token, n, s FROM surprisal", o.FIXTURE, o.CLEAN, o.LONG))
def token_surprisal(spark, d):
    return vocab.token_surprisal(*fixture.tables(spark, d))


@query(o.sql("SELECT token FROM stop", o.FIXTURE, o.CLEAN, o.LONG))
def stop_tokens(spark, d):
    return vocab.stop_tokens(*fixture.tables(spark, d))


@query(o.sql("SELECT count(*) AS tokens, count(*) FILTER (n = 1) AS singletons, max(s) AS max_bits, quantile_cont(s, 0.5) AS median_bits, min(s) AS min_bits FROM surprisal", o.FIXTURE, o.CLEAN, o.LONG))
def vocabulary_shape(spark, d):
    return vocab.vocabulary_shape(vocab.token_surprisal(*fixture.tables(spark, d)))


_SNAP = "SELECT name_tokens[1] AS v FROM clean WHERE len(name_tokens) > 0"


@query(o.sql(f"""SELECT "from", "to", round(sim, 9) AS sim FROM (SELECT a.v AS "from", b.v AS "to", {o.jw('a.v', 'b.v')} AS sim, row_number() OVER (PARTITION BY a.v ORDER BY round({o.jw('a.v', 'b.v')}, 12) DESC, b.v) AS k FROM counts a, counts b WHERE a.n < 0.01 * a.total AND b.n >= 0.01 * a.total) WHERE k = 1 AND sim >= 0.9 - 1e-12""", o.FIXTURE, o.CLEAN, f"counts AS (SELECT v, count(*) AS n, (SELECT count(*) FROM ({_SNAP})) AS total FROM ({_SNAP}) GROUP BY v)"))
def snap_rare(spark, d):
    v = fixture.clean(spark, d).select(F.get("name_tokens", F.lit(0)).alias("v"))
    return vocab.snap_map(v, "v").withColumn("sim", F.round("sim", 9))


@query(o.sql(f"""SELECT "from", "to", n, jw FROM (SELECT a.v AS "from", b.v AS "to", a.n, round({o.jw('a.v', 'b.v')}, 3) AS jw, {o.jw('a.v', 'b.v')} AS sim, row_number() OVER (PARTITION BY a.v ORDER BY round({o.jw('a.v', 'b.v')}, 12) DESC, b.first, b.v) AS k
FROM (SELECT v, count(*) AS n FROM firsts WHERE source_dataset = 'd2' AND v NOT IN (SELECT v FROM firsts WHERE source_dataset = 'd1') GROUP BY v) a, (SELECT v, min(row) AS first FROM firsts WHERE source_dataset = 'd1' GROUP BY v) b) WHERE k = 1 AND sim >= 0.94 - 1e-12""", o.FIXTURE, o.CLEAN, "firsts AS (SELECT row, source_dataset, name_tokens[1] AS v FROM clean WHERE len(name_tokens) > 0)"))
def align_vocab(spark, d):
    d1, d2 = (x.select("row", F.get("name_tokens", F.lit(0)).alias("v")) for x in fixture.tables(spark, d))
    return vocab.align_map(d2, d1, "v", "row")


@query(o.sql("SELECT value, count(*) AS records FROM (SELECT DISTINCT row, source_dataset, unnest(adm4_tokens) AS value FROM clean) GROUP BY value HAVING count(*) > 10", o.FIXTURE, o.CLEAN))
def shared_values(spark, d):
    return vocab.shared_values(*fixture.tables(spark, d), "adm4_tokens", "row", 10)


# Records and candidate pairs.

BASE = (o.FIXTURE, o.CLEAN, o.LONG, o.RECORDS)


@query(o.sql("SELECT unique_id, source_dataset, array_to_string(tf_tokens, '|') AS tf_tokens, round(list_sum(tf_bits), 9) AS bits, array_to_string(coalesce(block_tokens, []), '|') AS block_tokens, name_key, array_to_string(job_cats, '|') AS job_cats FROM records", *BASE))
def export_records(spark, d):
    r = fixture.records(spark, d)
    bits = F.round(F.aggregate("tf_bits", F.lit(0.0), lambda a, x: a + x), 9).alias("bits")
    return r.select("unique_id", "source_dataset", txt("tf_tokens"), bits, F.array_join(F.coalesce("block_tokens", F.array().cast("array<string>")), "|").alias("block_tokens"), "name_key", txt("job_cats"))


def pass_sql(k: int) -> str:
    return o.sql(f"SELECT DISTINCT l.unique_id AS id_l, r.unique_id AS id_r FROM keyed l JOIN keyed r ON l.k = r.k AND l.match_key = {k} AND r.match_key = {k} WHERE l.source_dataset = 'd1' AND r.source_dataset = 'd2'", *BASE, o.PAIRS)


@query(pass_sql(0))
def block_adm2(spark, d):
    return blocking.block(fixture.records(spark, d), "adm2")


@query(pass_sql(1))
def block_tokens(spark, d):
    return blocking.block(fixture.records(spark, d), "block_tokens")


@query(pass_sql(2))
def block_phones(spark, d):
    return blocking.block(fixture.records(spark, d), "phones")


@query(o.sql("SELECT l.unique_id AS id_l, r.unique_id AS id_r FROM records l JOIN records r ON l.adm3 = r.adm3 AND l.age = r.age WHERE l.source_dataset = 'd1' AND r.source_dataset = 'd2'", *BASE))
def block_area(spark, d):
    return blocking.block(fixture.records(spark, d), "adm3", "age")


@query(o.sql("SELECT l.unique_id AS id_l, r.unique_id AS id_r FROM records l JOIN records r ON l.name_key = r.name_key WHERE l.source_dataset = 'd1' AND r.source_dataset = 'd2'", *BASE))
def block_name_key(spark, d):
    return blocking.block(fixture.records(spark, d), "name_key")


@query(o.sql("SELECT id_l, id_r, match_key FROM pairs", *BASE, o.PAIRS))
def block_union(spark, d):
    return blocking.candidates(fixture.records(spark, d))


# Comparisons.


@query(o.sql(f"SELECT a.t AS t, b.t AS s, round(jaro_similarity(a.t, b.t), 9) AS jaro, round({o.jw('a.t', 'b.t')}, 9) AS jw FROM v a, v b WHERE a.t < b.t", o.FIXTURE, o.CLEAN, "v AS (SELECT DISTINCT unnest(name_tokens) AS t FROM clean)"))
def jaro_winkler_pairs(spark, d):
    v = fixture.clean(spark, d).select(F.explode("name_tokens").alias("t")).distinct()
    pairs = v.join(v.withColumnRenamed("t", "s"), F.col("t") < F.col("s"))
    return pairs.select("t", "s", F.round(similarity.jaro(F.col("t"), F.col("s")), 9).alias("jaro"), F.round(similarity.jaro_winkler(F.col("t"), F.col("s")), 9).alias("jw"))


def adm2_pairs(spark, d):
    return blocking.met(fixture.records(spark, d), ("adm2",))


ADM2 = "adm2_pairs AS (SELECT l.unique_id AS id_l, r.unique_id AS id_r FROM records l JOIN records r USING (adm2) WHERE l.source_dataset = 'd1' AND r.source_dataset = 'd2')"


@query(o.sql("SELECT id_l, id_r, name_sim, shared_bits, gamma_name FROM gammas", *BASE, ADM2, o.staged("adm2_pairs")))
def levels_name(spark, d):
    return tiling.names(fixture.records(spark, d), cmp.name(), "adm2")


def plain_levels(c: cmp.Comparison):
    def f(spark, d):
        return cmp.gammas(adm2_pairs(spark, d), [c]).select("id_l", "id_r", f"gamma_{c.name}")

    f.__name__ = f"levels_{c.name}"
    return query(o.sql(f"SELECT id_l, id_r, {o.GAMMA[c.name]} AS gamma_{c.name} FROM (SELECT p.*, l, r FROM adm2_pairs p JOIN records l ON l.unique_id = id_l JOIN records r ON r.unique_id = id_r)", *BASE, ADM2))(f)


for _c in (cmp.age(), cmp.SEX, cmp.geo(), cmp.JOB, cmp.PHONE):
    plain_levels(_c)


# Estimation.


def u_sql(c: cmp.Comparison) -> str:
    extra = f", {o.name_sim('l.name_tokens', 'r.name_tokens')} AS name_sim, round(coalesce(list_sum(list_transform(list_intersect(l.tf_tokens, r.tf_tokens), lambda t: l.tf_bits[list_position(l.tf_tokens, t)])), 0), 9) AS shared_bits" if c.name == "name" else ""
    return o.sql(f"SELECT gamma, count(*)::BIGINT AS n FROM (SELECT {o.GAMMA[c.name]} AS gamma FROM (SELECT l, r{extra} FROM records l, records r WHERE l.source_dataset = 'd1' AND r.source_dataset = 'd2')) GROUP BY gamma", *BASE)


def u_query(c: cmp.Comparison):
    def f(spark, d):
        return training.level_counts(fixture.records(spark, d), c)

    f.__name__ = f"u_counts_{c.name}"
    return query(u_sql(c))(f)


for _c in cmp.default():
    u_query(_c)

FIVE = [cmp.age(), cmp.SEX, cmp.geo(), cmp.JOB, cmp.PHONE]


@query(o.sql(f"SELECT {', '.join(f'gamma_{c.name}' for c in FIVE)}, count(*) AS n FROM (SELECT {', '.join(f'{o.GAMMA[c.name]} AS gamma_{c.name}' for c in FIVE)} FROM (SELECT l, r FROM records l JOIN records r USING (name_key) WHERE l.source_dataset = 'd1' AND r.source_dataset = 'd2')) GROUP BY ALL", *BASE))
def pattern_counts(spark, d):
    r = fixture.records(spark, d)
    return training.patterns(blocking.met(r, ("name_key",)), FIVE)


@query()
def em_parameters(spark, d):
    """Fitted without a reference; held against simulated patterns in the tests."""
    r = fixture.records(spark, d).persist()
    model, _ = training.train(r, cmp.default(), n_matches=30.0)
    r.unpersist()
    return model.table(spark)


# Scoring, assignment, evaluation.

SCORED = (*BASE, o.PAIRS, o.staged("pairs"), o.scored(PRIOR))


def predicted(spark, d):
    return scoring.predict(fixture.records(spark, d), LinkModel.published(PRIOR))


#: A match weight that pairs of a posterior of REVIEW have at least.
REVIEWED = -1e-3


def scores_of(spark, d, least=REVIEWED):
    """The scores that what follows can use: of pairs of at least that match weight."""
    return oriented(scoring.predict(fixture.records(spark, d), LinkModel.published(PRIOR), least))


def oriented(predicted):
    return cut(rounded(predicted))


def rounded(predicted):
    s = assignment.oriented(scoring.predictions(predicted), LinkModel.published(PRIOR).prior_bits)
    return s.withColumn("score", F.round("score", 6))


@query(o.sql("SELECT id_l, id_r, round(match_weight, 6) AS match_weight, round(match_probability, 6) AS match_probability, gamma_name, gamma_age, gamma_sex, gamma_geo, gamma_job, gamma_phone, round(bf_tf_adj_geo, 6) AS bf_tf_adj_geo FROM predicted", *SCORED))
def score_pairs(spark, d):
    p = scoring.predict(fixture.records(spark, d), LinkModel.published(PRIOR), digits=6)
    return p.select("id_l", "id_r", "match_weight", "match_probability", "bf_tf_adj_geo", *[c for c in p.columns if c.startswith("gamma_")])


@query(o.sql("SELECT (2 * floor(match_weight / 2))::BIGINT AS bin, count(*) AS n FROM predicted GROUP BY 1", *SCORED))
def weight_histogram(spark, d):
    return scoring.histogram(scoring.counts(fixture.records(spark, d), LinkModel.published(PRIOR)))


@query(o.sql("SELECT threshold::DOUBLE AS threshold, count(*) FILTER (match_probability >= threshold) AS pairs FROM predicted, (VALUES (0.5), (0.9), (0.99)) t(threshold) GROUP BY 1", *SCORED))
def threshold_counts(spark, d):
    return scoring.above(scoring.counts(fixture.records(spark, d), LinkModel.published(PRIOR)))


@query(o.sql("SELECT row_1, row_2, round(score, 4) AS score, selected, class FROM links", *SCORED, o.LINKS))
def greedy_links(spark, d):
    return assignment.links(scores_of(spark, d)).select("row_1", "row_2", F.round("score", 4).alias("score"), "selected", "class")


@query(o.sql("SELECT 'd1' AS dataset, candidates, count(*) AS records FROM (SELECT row_1, count(*) AS candidates FROM links GROUP BY 1) GROUP BY ALL UNION ALL SELECT 'd2', candidates, count(*) FROM (SELECT row_2, count(*) AS candidates FROM links GROUP BY 1) GROUP BY ALL", *SCORED, o.LINKS))
def multiplicity(spark, d):
    return assignment.multiplicity(assignment.links(scores_of(spark, d)))


@query(o.sql("SELECT class, selected, count(*) AS n FROM links GROUP BY ALL", *SCORED, o.LINKS))
def class_counts(spark, d):
    return assignment.class_counts(assignment.links(scores_of(spark, d)))


def truth(spark, d):
    r = fixture.rows(spark, d)
    a, b = r.where("source_dataset = 'd1'"), r.where("source_dataset = 'd2'")
    pairs = a.select(F.col("row").alias("row_1"), "truth").join(b.select(F.col("row").alias("row_2"), "truth"), "truth").groupBy("row_1").agg(F.min("row_2").alias("row_2"))
    confirmed = pairs.select("row_1").union(a.where("row % 50 = 0").select("row")).distinct()
    return evaluation.Truth(pairs, confirmed, confirmed.join(pairs, "row_1", "left_anti"))


FULL = (*SCORED, o.LINKS, o.TRUTH)
METRICS = "count(*) AS predicted, count(*) FILTER (category = 'correct') AS correct, count(*) FILTER (category = 'wrong_partner') AS wrong_partner, count(*) FILTER (category = 'unverifiable') AS unverifiable, count(*) FILTER (category = 'false_positive') AS false_positive"


@query(o.sql("SELECT row_1, row_2, category FROM categories", *FULL))
def categories(spark, d):
    return evaluation.categorize(assignment.links(scores_of(spark, d)).where("selected"), truth(spark, d)).select("row_1", "row_2", "category")


@query(o.sql(f"""SELECT operating_point, predicted, correct, wrong_partner, unverifiable, false_positive, correct / nullif(predicted - unverifiable, 0) AS precision_known, correct / predicted AS precision_lo, (correct + unverifiable) / predicted AS precision_hi, correct / (SELECT count(*) FROM truth_pairs) AS recall_known
FROM (SELECT operating_point, {METRICS} FROM (SELECT *, 'review' AS operating_point FROM categories UNION ALL SELECT *, 'link' FROM categories WHERE class = 'link') GROUP BY 1)""", *FULL))
def operating_points(spark, d):
    return evaluation.operating_points(assignment.links(scores_of(spark, d)), truth(spark, d))


DISPOSED = "disposed AS (SELECT t.row_1, t.row_2, s.score, s.posterior, s.score IS NOT NULL AS in_block, coalesce(k.selected, false) AS selected, CASE WHEN s.posterior <= 0.5 THEN '<0.5' WHEN s.posterior <= 0.9 THEN '0.5-0.9' WHEN s.posterior IS NOT NULL THEN '>=0.9' END AS band FROM truth_pairs t LEFT JOIN scores s USING (row_1, row_2) LEFT JOIN (SELECT * FROM links WHERE selected) k USING (row_1, row_2))"


def disposed(spark, d):
    return dispositions(spark, d)[0]


def dispositions(spark, d):
    """The reference pairs' dispositions, and those of them that are candidates, scored: no other pair's score is needed whole."""
    r, t, model = fixture.records(spark, d), truth(spark, d), LinkModel.published(PRIOR)
    own = cut(scoring.predict_of(t.pairs.select(F.col("row_1").alias("id_l"), F.col("row_2").alias("id_r")), r, model))
    reviewed = oriented(scoring.predict(r, model, REVIEWED))
    return evaluation.disposition(t, oriented(own), assignment.links(reviewed)), own


@query(o.sql("SELECT in_block, band, selected, count(*) AS n FROM disposed GROUP BY ALL", *FULL, DISPOSED))
def disposition(spark, d):
    return disposed(spark, d).groupBy("in_block", "band", "selected").agg(F.count("*").alias("n"))


@query(o.sql("SELECT count(*) AS reference_pairs, count(*) FILTER (in_block) AS n_in_block, round(100.0 * count(*) FILTER (in_block) / count(*), 2) AS pct FROM disposed", *FULL, DISPOSED))
def blocking_recall(spark, d):
    return evaluation.blocking_recall(disposed(spark, d))


LABELS = {c.name: c.labels() for c in cmp.default()}


@query(o.sql(" UNION ALL ".join(f"SELECT '{v}' AS variable, coalesce([{', '.join(map(o.q, x))}][gamma_{v} + 1], 'missing') AS level, count(*) AS n FROM predicted p JOIN disposed t ON p.id_l = t.row_1 AND p.id_r = t.row_2 WHERE t.in_block AND NOT t.selected GROUP BY ALL" for v, x in LABELS.items()), *FULL, DISPOSED))
def missed_levels(spark, d):
    x, p = dispositions(spark, d)
    return evaluation.missed_levels(x, p.withColumnsRenamed({"id_l": "row_1", "id_r": "row_2"}), LABELS)


# Audit.

_COLS = ("age", "sex", "adm1", "adm2", "adm3")


@query(o.sql(" UNION ALL ".join(f"SELECT '{c}' AS col, count(*) FILTER ({c} IS NULL) AS n_missing, round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 1) AS pct_missing FROM clean" for c in _COLS), o.FIXTURE, o.CLEAN))
def missingness(spark, d):
    return audit.missingness(fixture.clean(spark, d).select(*_COLS))


@query(o.sql("SELECT count(*) AS records, count(DISTINCT adm2) AS adm2_distinct, count(DISTINCT adm3) AS adm3_distinct, count(*) FILTER (len(adm4_tokens) >= 1) AS adm4_any_token, count(*) FILTER (len(phones) >= 1) AS phone_any, count(*) FILTER (len(phones) >= 2) AS phone_two_plus, max(len(phones))::BIGINT AS phone_max, (SELECT count(DISTINCT t) FROM (SELECT unnest(adm4_tokens) AS t FROM clean)) AS adm4_distinct_tokens FROM clean", o.FIXTURE, o.CLEAN))
def field_summary(spark, d):
    return audit.field_summary(fixture.clean(spark, d))


@query(o.sql("SELECT source_dataset, job, n, round(100 * n / sum(n) OVER (PARTITION BY source_dataset), 1) AS pct FROM (SELECT source_dataset, list_filter(['traditional_healer','health','miner','security','transport','trade','farmer','artisan','professional','religious','student','housewife','child','none','other'], lambda p: list_contains(job_cats, p))[1] AS job, count(*) AS n FROM clean GROUP BY ALL)", o.FIXTURE, o.CLEAN))
def job_distribution(spark, d):
    return audit.distribution(fixture.clean(spark, d).withColumn("job", occupations.primary(F.col("job_cats"))), "job", "source_dataset")


@query(o.sql("SELECT source_dataset, member, count(*) AS n FROM (SELECT source_dataset, unnest(job_cats) AS member FROM clean) GROUP BY ALL", o.FIXTURE, o.CLEAN))
def job_membership(spark, d):
    return audit.membership(fixture.clean(spark, d), "job_cats", "source_dataset")


@query(o.sql("SELECT records, count(*) AS numbers FROM (SELECT p, count(*) AS records FROM (SELECT unnest(phones) AS p FROM clean) GROUP BY p) GROUP BY records", o.FIXTURE, o.CLEAN))
def phone_sharing(spark, d):
    return audit.numbers_by_sharing(fixture.clean(spark, d))


@query(o.sql("SELECT count(DISTINCT p) FILTER (source_dataset = 'd1') AS distinct_d1, count(DISTINCT p) FILTER (source_dataset = 'd2') AS distinct_d2, count(DISTINCT p) FILTER (source_dataset = 'd1' AND p IN (SELECT p FROM x WHERE source_dataset = 'd2')) AS in_both, count(DISTINCT row) FILTER (source_dataset = 'd2') AS d2_records, count(DISTINCT row) FILTER (source_dataset = 'd2' AND p IN (SELECT p FROM x WHERE source_dataset = 'd1')) AS d2_records_sharing FROM x", o.FIXTURE, o.CLEAN, "x AS (SELECT row, source_dataset, unnest(phones) AS p FROM clean)"))
def phone_reach(spark, d):
    return audit.reach(*fixture.tables(spark, d), "phones")


@query(o.sql("SELECT token AS child, adm2 AS parent FROM (SELECT *, sum(n) OVER (PARTITION BY token) AS tot, row_number() OVER (PARTITION BY token ORDER BY n DESC, adm2) AS k FROM (SELECT token, adm2, count(*) AS n FROM (SELECT unnest(adm4_tokens) AS token, adm2 FROM clean) GROUP BY ALL)) WHERE k = 1 AND tot >= 3 AND n / tot >= 0.8", o.FIXTURE, o.CLEAN))
def dominant_parent(spark, d):
    c = fixture.clean(spark, d).select(F.explode("adm4_tokens").alias("child"), F.col("adm2").alias("parent"))
    return audit.dominant(c, "child", "parent")


@query(o.sql("SELECT source_dataset, token, n FROM (SELECT *, row_number() OVER (PARTITION BY source_dataset ORDER BY n DESC, token) AS k FROM (SELECT source_dataset, token, count(*) AS n FROM (SELECT source_dataset, unnest(adm4_tokens) AS token FROM clean) GROUP BY ALL)) WHERE k <= 15", o.FIXTURE, o.CLEAN))
def top_tokens(spark, d):
    c = fixture.clean(spark, d).select("source_dataset", F.explode("adm4_tokens").alias("token")).groupBy("source_dataset", "token").agg(F.count("*").alias("n"))
    return audit.top(c, 15, ["source_dataset"], "n", "token")


@query(o.sql("SELECT count(adm4) AS raw_non_missing, count(*) FILTER (len(adm4_tokens) >= 1) AS one_plus, count(*) FILTER (len(adm4_tokens) >= 2) AS two_plus, (SELECT count(DISTINCT t) FROM (SELECT unnest(adm4_tokens) AS t FROM clean)) AS distinct_tokens FROM clean JOIN (SELECT row, adm4 FROM fixture) USING (row)", o.FIXTURE, o.CLEAN))
def token_yield(spark, d):
    r = fixture.rows(spark, d).select("row", "adm4")
    return audit.token_yield(fixture.clean(spark, d).join(r, "row"), "adm4_tokens", "adm4")
