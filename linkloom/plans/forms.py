"""Queries over written forms: phones, villages, occupations and places as people type them.

Each form is put together from parts that are known, so the SQL states what must come out from these parts and takes
nothing from the library: no rule, no table, no expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import occupations, phones, places, similarity, text
from linkloom.operators import audit, vocab
from linkloom.plans import oracle as o
from linkloom.plans.queries import query
from linkloom.sources.tables import harmonized

VILLAGES = ["RUGHENDA", "MASANGE", "BUTSILI", "KASANGA", "MUTAKULA", "VULAMBA", "KALINDA", "MABOLIO"]
TOWNS = ["BUTEMBO", "KALUNGUTA", "MABALAKO", "MUSIENENE", "VUHOVI", "MASEREKA", "KATWA", "MANDIMA"]
PROVINCES = ["NORD KIVU", "ITURI", "TSHOPO"]
TYPED_WRONG = ["NORD KIV", "ITURRI", "TSHOPPO"]
#: Raw text, categories, whether it stands for unknown.
JOBS = [
    ("Écolier/ière-Élève", "student", False), ("Planteur/Eleveur", "farmer", False), ("Agent de Transport marchandise", "transport", False),
    ("Médecin traditionnel", "traditional_healer", False), ("Autre: Orpailleur", "miner", False), ("Inc.", "", True), ("Ménagère", "housewife", False),
    ("Enfant", "child", False), ("Nourrisson", "child", False), ("Sans emploi", "none", False), ("Retraité", "none", False), ("Cultivatrice", "farmer", False),
    ("Creuseur d'or", "miner", False), ("Commerçante", "trade", False), ("Marchand ambulant", "trade", False), ("Vendeuse de pagnes", "trade", False),
    ("Chauffeur", "transport", False), ("Taxi moto", "transport", False), ("Couturière", "artisan", False), ("Maçon", "artisan", False),
    ("Technicien", "artisan", False), ("Technicien de laboratoire", "health", False), ("Infirmière", "health", False), ("Médecin", "health", False),
    ("Sage-femme", "health", False), ("Guérisseur", "traditional_healer", False), ("Pasteur", "religious", False), ("Policier", "security", False),
    ("Militaire", "security", False), ("Enseignant", "professional", False), ("Chef de village", "professional", False), ("Agent de l'État", "professional", False),
    ("Inconnu", "", True), ("Son père est cultivateur", "", True), ("Zork", "other", False), ("Cultivateur / Pasteur", "farmer|religious", False),
    ("Ménagère et vendeuse", "housewife|trade", False), ("Étudiant, motard", "student|transport", False), (None, "", False), ("  ", "", False),
    ("Élève infirmière", "health|student", False), ("Mineur, militaire", "miner|security", False), ("Professeur", "professional", False),
    ("Mécanicien", "artisan", False), ("Non précisé", "", True),
]


def lit(x: str | None) -> str:
    return "NULL" if x is None else o.q(x)


def listed(xs: list) -> str:
    return f"[{', '.join(lit(x) for x in xs)}]"


def pick(xs: list, at: Column) -> Column:
    return F.get(F.array(*[F.lit(x).cast("string") for x in xs]), at.cast("int"))


def docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def forms(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    a, b = (810_000_000 + i * 7919 % 90_000_000).cast("string"), (990_000_000 + i * 104_729 % 9_999_999).cast("string")
    sub = lambda x, at, n=99: F.substring(x, at, n)
    phone = [
        F.concat(F.lit("+243 "), sub(a, 1, 3), F.lit(" "), sub(a, 4, 3), F.lit(" "), sub(a, 7, 3)),
        F.concat(sub(a, 1, 4), F.lit("O"), sub(a, 6)),
        F.concat(F.lit("0"), a, F.lit(" 0"), b),
        F.concat(a, F.lit("/"), b),
        F.concat(a, F.lit(" ; "), a),
        F.concat(F.lit("0"), sub(a, 1, 3), F.lit(" "), sub(a, 4, 3), F.lit(" "), sub(a, 7, 3)),
        F.concat(sub(a, 1, 1), F.lit("."), sub(a, 2), b, F.lit("E+17")),
        F.concat(sub(a, 1, 1), F.lit("."), sub(a, 2), F.lit("E+8")),
        F.lit("12345"),
        F.lit("000000000"),
        F.concat(a, F.lit("12345")),
        F.lit(None).cast("string"),
        F.concat(F.lit("00243"), a),
        F.concat(F.lit("tel. "), a, F.lit(", "), b),
    ]
    v1, v2, n = pick(VILLAGES, i % 8), pick(VILLAGES, F.expr("doc_id div 8") % 8), (i % 300).cast("string")
    village = [
        F.lit("Q. de l'Hôpital"), F.concat(v1, F.lit(" N°"), n), F.concat(F.lit("Q "), v1, F.lit(" AV "), v2, F.lit(" NUM 107")), F.concat(v1, F.lit(" 26KM")),
        F.concat(F.lit("PK 5 "), v1), F.concat(F.lit("pk"), n, F.lit(" km / "), F.lower(v1)), F.concat(v1, F.lit(" II")), F.concat(v1, F.lit(" et "), v1),
        F.lit("Q."), F.lit(None).cast("string"), F.concat(F.lit("Village "), v1, F.lit(" près de "), v2), F.concat(v2, F.lit(" x "), n, F.lit("KM")),
    ]
    town = pick(TOWNS, i % 8)
    d2 = F.expr("doc_id div 20") % 4 == 3
    wrong = F.when(d2 & (i % 9 == 0), F.concat(F.expr("left(town, length(town) - 2)"), F.expr("right(town, 1)"))).when(~d2 & (i % 331 == 0), F.concat(F.expr("left(town, 1)"), F.col("town"))).otherwise(F.col("town"))
    return docs(spark, d).select(
        "doc_id", F.col("doc_id").alias("row"), F.when(d2, "d2").otherwise("d1").alias("source_dataset"),
        F.get(F.array(*phone), (i % 14).cast("int")).alias("phone_raw"), (990_000_000 + i % 37).cast("string").alias("line"),
        F.get(F.array(*village), (i % 12).cast("int")).alias("adm4"), v1.alias("village"),
        pick([x for x, _, _ in JOBS], i % len(JOBS)).alias("job_raw"), town.alias("town"),
        F.when(i % 97 == 0, pick(TYPED_WRONG, i % 3)).otherwise(pick(PROVINCES, i % 3)).alias("adm1"),
        F.when(i % 10 == 0, pick(TOWNS, (i + 1) % 8)).otherwise(town).alias("native"), F.when(i % 6 == 0, pick(TOWNS, (i + 3) % 8)).when(i % 7 == 0, None).otherwise(town).alias("joined"),
    ).withColumn("adm3", wrong)


A, B = "(810000000 + doc_id * 7919 % 90000000)::VARCHAR", "(990000000 + doc_id * 104729 % 9999999)::VARCHAR"
EXPECTED = f"""parts AS (
  SELECT doc_id, {A} AS a, {B} AS b, (990000000 + doc_id % 37)::VARCHAR AS line, {listed(VILLAGES)}[(doc_id % 8 + 1)::INT] AS v1, {listed(VILLAGES)}[((doc_id // 8) % 8 + 1)::INT] AS v2, (doc_id % 300)::VARCHAR AS n,
    {listed(TOWNS)}[(doc_id % 8 + 1)::INT] AS town, CASE WHEN (doc_id // 20) % 4 = 3 THEN 'd2' ELSE 'd1' END AS source_dataset, (doc_id % {len(JOBS)} + 1)::INT AS job FROM documents
), expected AS (
  SELECT *, CASE WHEN doc_id % 14 IN (0, 4, 5, 6, 7, 12) THEN [a] WHEN doc_id % 14 = 1 THEN [left(a, 4) || '0' || substr(a, 6)] WHEN doc_id % 14 IN (2, 3, 13) THEN [a, b] ELSE []::VARCHAR[] END AS phones, doc_id % 14 <> 11 AS has_phone,
    CASE doc_id % 12 WHEN 0 THEN ['HOPITAL'] WHEN 1 THEN [v1] WHEN 2 THEN CASE WHEN v1 = v2 THEN [v1] ELSE [v1, v2] END WHEN 3 THEN [v1, 'PK26'] WHEN 4 THEN ['PK5', v1] WHEN 5 THEN ['PK' || n, v1] WHEN 6 THEN [v1, 'II'] WHEN 7 THEN [v1]
      WHEN 10 THEN CASE WHEN v1 = v2 THEN [v1] ELSE [v1, v2] END WHEN 11 THEN [v2, 'PK' || n] ELSE []::VARCHAR[] END AS villages,
    {listed([x for x, _, _ in JOBS])}[job] AS job_raw, {listed([x for _, x, _ in JOBS])}[job] AS cats, [{', '.join(str(x).lower() for _, _, x in JOBS)}][job] AS unknown,
    CASE WHEN source_dataset = 'd2' AND doc_id % 9 = 0 THEN left(town, length(town) - 2) || right(town, 1) WHEN source_dataset = 'd1' AND doc_id % 331 = 0 THEN left(town, 1) || town ELSE town END AS adm3,
    CASE WHEN doc_id % 97 = 0 THEN {listed(TYPED_WRONG)}[(doc_id % 3 + 1)::INT] ELSE {listed(PROVINCES)}[(doc_id % 3 + 1)::INT] END AS adm1,
    CASE WHEN doc_id % 10 = 0 THEN {listed(TOWNS)}[((doc_id + 1) % 8 + 1)::INT] ELSE town END AS native, CASE WHEN doc_id % 6 = 0 THEN {listed(TOWNS)}[((doc_id + 3) % 8 + 1)::INT] WHEN doc_id % 7 <> 0 THEN town END AS joined
  FROM parts
)"""


def want(body: str, *parts: str) -> str:
    return o.sql(body, EXPECTED, *parts)


# Text.


@query("SELECT doc_id, md5(t) AS repaired FROM (SELECT doc_id, regexp_replace(text, '[^\\x{00}-\\x{FF}]', '', 'g') AS t FROM documents)")
def fix_utf8(spark, d):
    """Texts written as Latin-1 bytes, which are no UTF-8 where a letter has a mark, come back as they were."""
    plain = F.regexp_replace("text", r"[^\u0000-ÿ]", "")
    return docs(spark, d).select("doc_id", F.md5(text.fix_utf8(F.encode(plain, "ISO-8859-1").cast("string")).cast("binary")).alias("repaired"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN source ELSE source END AS place FROM documents")
def place_of_hierarchies(spark, d):
    """The joined place where it is filled, else the native one."""
    i = F.col("doc_id")
    raw = docs(spark, d).select(i.alias("row_d2"), F.col("source").alias("adm2_d2"), F.when(i % 3 == 0, F.col("lang")).when(i % 3 == 1, F.lit(" ")).alias("adm2_v_d2"))
    return harmonized(raw, "d2", {"adm2": "adm2_v_d2"}).select(F.col("row").alias("doc_id"), F.col("adm2").alias("place"))


@query("SELECT n_chars, CASE WHEN count(DISTINCT lang) <= 1 THEN min(lang) ELSE string_agg(lang, '; ' ORDER BY doc_id) END AS langs FROM (SELECT doc_id, n_chars, CASE WHEN doc_id % 7 <> 0 THEN lang END AS lang FROM documents) GROUP BY n_chars")
def collapsed(spark, d):
    """Of the documents of one length: their language, or all that are there."""
    some = docs(spark, d).groupBy("n_chars").agg(F.array_sort(F.collect_list(F.struct("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("lang")))).alias("x"))
    return some.select("n_chars", text.collapse(F.transform("x", lambda x: x["lang"])).alias("langs"))


@query("SELECT doc_id, CASE WHEN n_chars = 0 THEN 0.0 ELSE round_even(n_chars / 7.0 * pow(10.0, 2 - floor(log10(n_chars / 7.0))), 0) / pow(10.0, 2 - floor(log10(n_chars / 7.0))) END AS x FROM documents")
def significant(spark, d):
    return docs(spark, d).select("doc_id", text.signif(F.col("n_chars") / F.lit(7.0), 3).alias("x"))


# Phones.


@query(want("SELECT doc_id, array_to_string(phones, '|') AS phones, len(phones)::BIGINT AS n FROM expected"))
def phone_forms(spark, d):
    p = phones.phone_set(F.col("phone_raw"))
    return forms(spark, d).select("doc_id", F.array_join(p, "|").alias("phones"), F.size(p).cast("long").alias("n"))


@query(want("SELECT doc_id, phones[1] AS phone_1, phones[2] AS phone_2 FROM expected"))
def phone_wide(spark, d):
    return phones.clean_phone(forms(spark, d), "phone_raw").select("doc_id", "phone_1", "phone_2")


def with_phones(spark, d):
    return forms(spark, d).withColumn("phones", phones.phone_set(F.col("phone_raw")))


@query(want("SELECT count(*) FILTER (has_phone) AS raw_non_missing, count(*) FILTER (len(phones) >= 1) AS one_plus, count(*) FILTER (len(phones) >= 2) AS two_plus, count(*) FILTER (has_phone AND len(phones) = 0) AS raw_but_no_number FROM expected"))
def phone_yield(spark, d):
    return audit.phone_yield(with_phones(spark, d))


@query(want("SELECT length(p)::INT AS digits, count(*) AS n FROM (SELECT unnest(phones) AS p FROM expected) GROUP BY 1"))
def phone_digits(spark, d):
    return audit.phone_digits(with_phones(spark, d))


@query(want("SELECT line AS value, count(*) AS records FROM expected GROUP BY 1 HAVING count(*) > 10"))
def shared_phones(spark, d):
    f = with_phones(spark, d).withColumn("phones", F.array("line", "line"))
    return vocab.shared_values(f.where("source_dataset = 'd1'"), f.where("source_dataset = 'd2'"), "phones", "row", 10)


@query(want("SELECT doc_id, array_to_string(CASE WHEN times > 10 THEN list_filter(phones, lambda p: p <> line) ELSE list_append(phones, line) END, '|') AS phones FROM expected JOIN (SELECT line AS l, count(*) AS times FROM expected GROUP BY 1) ON l = line"))
def shared_phones_dropped(spark, d):
    f = with_phones(spark, d).withColumn("phones", F.concat("phones", F.array("line")))
    one, two = f.where("source_dataset = 'd1'"), f.where("source_dataset = 'd2'")
    gone = vocab.shared_values(one, two, "phones", "row", 10)
    return vocab.drop_values(one, "phones", gone, "row").unionByName(vocab.drop_values(two, "phones", gone, "row")).select("doc_id", F.array_join("phones", "|").alias("phones"))


# Places.


@query(want("SELECT doc_id, array_to_string(villages, '|') AS tokens, nullif(array_to_string(villages, ' '), '') AS std FROM expected"))
def village_forms(spark, d):
    return forms(spark, d).select("doc_id", F.array_join(places.adm4_tokens(F.col("adm4")), "|").alias("tokens"), places.adm4_std(F.col("adm4")).alias("std"))


@query(want(f"""SELECT "from", "to", round(sim, 9) AS sim FROM (SELECT a.v AS "from", b.v AS "to", {o.jw('a.v', 'b.v')} AS sim, row_number() OVER (PARTITION BY a.v ORDER BY round({o.jw('a.v', 'b.v')}, 12) DESC, b.v) AS k FROM counts a, counts b WHERE a.n < 0.01 * a.total AND b.n >= 0.01 * a.total) WHERE k = 1 AND sim >= 0.9 - 1e-12""", "counts AS (SELECT adm1 AS v, count(*) AS n, (SELECT count(*) FROM expected) AS total FROM expected GROUP BY v)"))
def snap_provinces(spark, d):
    return vocab.snap_map(forms(spark, d), "adm1").withColumn("sim", F.round("sim", 9))


def nearest(own: str, ref: str) -> str:
    """SQL of a map from own (v, n) to ref (v, first)."""
    return f"""SELECT "from", "to", n, round(sim, 3) AS jw FROM (SELECT a.v AS "from", b.v AS "to", a.n, {o.jw('a.v', 'b.v')} AS sim, row_number() OVER (PARTITION BY a.v ORDER BY round({o.jw('a.v', 'b.v')}, 12) DESC, b.first, b.v) AS k FROM ({own}) a, ({ref}) b) WHERE k = 1 AND sim >= 0.94 - 1e-12"""


VOCABULARY = "SELECT v, min(doc_id) AS first FROM {0} GROUP BY v"
ALIGNED = [
    "one AS (SELECT doc_id, adm3 AS v FROM expected WHERE source_dataset = 'd1')",
    "two AS (SELECT doc_id, adm3 AS v FROM expected WHERE source_dataset = 'd2')",
    f"to_1 AS ({nearest('SELECT v, count(*) AS n FROM two WHERE v NOT IN (SELECT v FROM one) GROUP BY v', VOCABULARY.format('one'))})",
    'later AS (SELECT doc_id, coalesce("to", v) AS v FROM two LEFT JOIN to_1 ON v = "from")',
    f"to_2 AS ({nearest('SELECT v, count(*) AS n FROM one WHERE v NOT IN (SELECT v FROM later) GROUP BY v HAVING count(*) < 5', VOCABULARY.format('later'))})",
    "maps AS (SELECT 'd2 to d1' AS direction, * FROM to_1 UNION ALL SELECT 'd1 to d2', * FROM to_2)",
]


def aligned_maps(spark, d):
    f = forms(spark, d)
    _, _, to_1, to_2 = vocab.align_both(f.where("source_dataset = 'd1'"), f.where("source_dataset = 'd2'"), "adm3")
    return to_1.withColumn("direction", F.lit("d2 to d1")).unionByName(to_2.withColumn("direction", F.lit("d1 to d2")))


@query(want('SELECT direction, "from", "to", n, jw FROM maps', *ALIGNED))
def align_towns(spark, d):
    return aligned_maps(spark, d).select("direction", "from", "to", "n", "jw")


@query(want("SELECT 'adm3' AS field, direction, count(*) AS values, sum(n)::BIGINT AS records FROM maps GROUP BY ALL", *ALIGNED))
def alignment_summary(spark, d):
    return audit.alignment_summary(aligned_maps(spark, d).withColumn("field", F.lit("adm3")))


@query(want(f"SELECT count(*) FILTER (native = joined) AS agree, count(*) FILTER (native <> joined AND {o.jw('native', 'joined')} >= 0.85) AS spelling_variant, count(*) FILTER (native <> joined AND {o.jw('native', 'joined')} < 0.85) AS different, count(*) FILTER (joined IS NULL) AS either_missing, count(*) FILTER (joined IS NULL) AS joined_missing FROM expected"))
def place_agreement(spark, d):
    return audit.agreement(forms(spark, d), "native", "joined")


DOMINANT = "dominant AS (SELECT v1, native AS parent FROM (SELECT *, sum(n) OVER (PARTITION BY v1) AS tot, row_number() OVER (PARTITION BY v1 ORDER BY n DESC, native) AS k FROM (SELECT v1, native, count(*) AS n FROM expected GROUP BY ALL)) WHERE k = 1 AND tot >= 3 AND n / tot >= 0.8)"


@query(want("SELECT v1 AS village, parent AS native FROM dominant", DOMINANT))
def dominant_town(spark, d):
    return audit.dominant(forms(spark, d), "village", "native")


@query(want(f"SELECT count(*) AS records, count(*) FILTER (parent = native) AS agrees_a, count(*) FILTER (parent = joined) AS agrees_b, count(*) FILTER (parent <> native AND parent <> joined) AS neither FROM expected JOIN dominant USING (v1) WHERE native <> joined AND {o.jw('native', 'joined')} < 0.85", DOMINANT))
def place_arbitration(spark, d):
    f = forms(spark, d)
    return audit.arbitration(f, audit.dominant(f, "village", "native"), "village", "native", "native", "joined")


@query(want(f"SELECT doc_id, round({o.token_sim('adm3', 'town')}, 9) AS sim FROM expected"))
def town_similarity(spark, d):
    return forms(spark, d).select("doc_id", F.round(similarity.token_sim(F.col("adm3"), F.col("town")), 9).alias("sim"))


# Occupations.


PRIMARY = "list_filter(['traditional_healer','health','miner','security','transport','trade','farmer','artisan','professional','religious','student','housewife','child','none','other'], lambda p: list_contains(string_split(cats, '|'), p))[1]"


@query(want(f"SELECT doc_id, nullif(cats, '') AS cats, {PRIMARY} AS job, nullif(array_to_string(list_filter(string_split(cats, '|'), lambda c: c NOT IN ('child', 'other', '')), '|'), '') AS compared FROM expected"))
def job_forms(spark, d):
    cats = occupations.from_text(F.col("job_raw"))
    cats, f = F.col("own"), forms(spark, d).withColumn("own", cats)
    return f.select("doc_id", occupations.as_string(cats).alias("cats"), occupations.primary(cats).alias("job"), occupations.as_string(occupations.compared(cats)).alias("compared"))


@query(want("""SELECT doc_id, array_to_string(list_sort(CASE WHEN len(every) = 0 AND doc_id % 13 = 0 AND NOT unknown THEN ['other'] WHEN len(every) > 1 THEN list_filter(every, lambda c: c <> 'other') ELSE every END), '|') AS cats
FROM (SELECT doc_id, unknown, list_distinct(list_filter([CASE WHEN doc_id % 4 = 0 OR doc_id % 6 = 0 THEN 'farmer' END, CASE WHEN doc_id % 5 = 0 THEN 'trade' END, CASE WHEN doc_id % 7 = 0 AND doc_id % 17 <> 0 THEN 'health' END, CASE WHEN doc_id % 11 = 0 THEN 'child' END] || string_split(cats, '|'), lambda c: c IS NOT NULL AND c <> '')) AS every FROM expected)"""))
def job_flags(spark, d):
    i = F.col("doc_id")
    flags = dict.fromkeys(occupations.FLAGS, F.lit(False)) | {"farmer": i % 4 == 0, "hunter": i % 6 == 0, "business": i % 5 == 0, "hcw": F.when(i % 17 != 0, i % 7 == 0), "child": i % 11 == 0}
    return forms(spark, d).select("doc_id", F.array_join(occupations.from_flags(flags, i % 13 == 0, F.col("job_raw")), "|").alias("cats"))


@query(want("SELECT job_raw, cats, count(*) AS n FROM expected GROUP BY ALL"))
def job_mapping(spark, d):
    f = forms(spark, d).withColumn("cats", F.array_join(occupations.from_text(F.col("job_raw")), "|"))
    return audit.mapping(f, "job_raw", "cats")


@query(want("SELECT source_dataset, (CASE WHEN cats = '' THEN 0 ELSE len(string_split(cats, '|')) END)::INT AS members, count(*) AS n FROM expected GROUP BY ALL"))
def job_set_sizes(spark, d):
    return audit.set_sizes(forms(spark, d).withColumn("cats", occupations.from_text(F.col("job_raw"))), "cats", "source_dataset")
