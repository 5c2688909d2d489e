"""The same relations in DuckDB SQL, put together from common table expressions."""

from __future__ import annotations

from linkloom.functions import occupations, places
from linkloom.operators.comparisons import default
from linkloom.operators.model import PUBLISHED, prior_bits

JOBS = ["Cultivateur / Pasteur", "Commerçant", "Elève", "Enfant", "Inconnu", "Zork", "Infirmière", "Taxi moto"]
#: Look-aheads spelled out for an engine that has none.
AHEAD = {"MARCHAND(?!ISE)": "MARCHAND($|[^I]|I$|I[^S]|IS$|IS[^E])", "TECHNICIEN(?![A-Z ]*LABO)": "TECHNICIEN([^L]*)$", r"\bMEDECINS?\b(?! TRADI)": r"\bMEDECINS?($| $| [^T]| T[^R])"}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


#: Letters without a decomposition that occur in Latin text, and their ASCII spelling.
SPELLED = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "ı": "i", "Þ": "TH", "þ": "th", "Ð": "D", "ð": "d"}


def fold(x: str) -> str:
    """The engine's own stripping of accents, and letters that have none to strip."""
    for a, b in SPELLED.items():
        x = f"replace({x}, {q(a)}, {q(b)})"
    return f"strip_accents({x})"


def std(x: str) -> str:
    return f"nullif(trim(regexp_replace(upper({fold(x)}), '[^A-Z0-9]+', ' ', 'g')), '')"


def words(x: str) -> str:
    return f"list_filter(string_split(coalesce({x}, ''), ' '), lambda t: t <> '')"


def distinct(x: str) -> str:
    return f"list_filter({x}, lambda t, i: list_position({x}, t) = i)"


def jw(a: str, b: str) -> str:
    p = " + ".join(f"(length({a}) >= {k} AND length({b}) >= {k} AND left({a}, {k}) = left({b}, {k}))::INT" for k in (1, 2, 3, 4))
    return f"(jaro_similarity({a}, {b}) + 0.1 * ({p}) * (1 - jaro_similarity({a}, {b})))"


def token_sim(a: str, b: str) -> str:
    return f"greatest({jw(a, b)}, CASE WHEN least(length({a}), length({b})) = 1 AND left({a}, 1) = left({b}, 1) THEN 0.95 ELSE 0 END)"


def one_way(a: str, b: str) -> str:
    return f"list_avg(list_transform({a}, lambda t: list_max(list_transform({b}, lambda s: {token_sim('t', 's')}))))"


def name_sim(a: str, b: str) -> str:
    return f"round(({one_way(a, b)} + {one_way(b, a)}) / 2, 9)"


def job_cats(s: str) -> str:
    cases = []
    for k, ws in occupations.RULES.items():
        pattern = "|".join(AHEAD.get(w, w) for w in ws)
        cases.append(f"CASE WHEN regexp_matches({s}, {q(pattern)}) THEN '{k}' END")
    hits = f"list_sort(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL))"
    return f"CASE WHEN {s} IS NULL OR regexp_matches({s}, {q(occupations.UNKNOWN)}) THEN []::VARCHAR[] WHEN len({hits}) = 0 THEN ['other'] ELSE {hits} END"


FIXTURE = f"""raw AS (
  SELECT d.doc_id AS row, CASE WHEN (d.doc_id // 20) % 4 = 3 THEN 'd2' ELSE 'd1' END AS source_dataset, d.text, d.n_chars AS n, d.lang, d.source, l.quality,
    list_filter(string_split_regex(d.text, '\\s+'), lambda w: w <> '') AS ws
  FROM documents d LEFT JOIN labels l USING (doc_id)
), fixture AS (
  SELECT row, source_dataset, array_to_string(ws[1:4], ' ') AS name, (n % 120)::INT AS age,
    CASE quality WHEN 1 THEN 'Male' WHEN 0 THEN 'Female' ELSE 'Unknown' END AS sex, lang AS adm1, source AS adm2, source || ' ' || (n % 7) AS adm3,
    CASE WHEN n % 5 <> 0 THEN 'Q. ' || array_to_string(ws[5:6], ' / ') || ' N' || (n % 90) END AS adm4,
    CASE WHEN n % 3 <> 0 THEN '0' || (800000000 + (n * 7919) % 100000000) END AS phone_raw,
    [{', '.join(map(q, JOBS))}][(n % 8 + 1)::INT] AS job_raw, md5(text) AS truth
  FROM raw
)"""

_ADM4 = f"coalesce({std('adm4')}, '')"
for _p in (places.HOUSE, places.POST_BEFORE, places.POST_BEHIND):
    _ADM4 = f"regexp_replace({_ADM4}, {q(_p)}, {q(' ' if _p == places.HOUSE else 'PK' + chr(92) + '1')}, 'g')"

CLEAN = f"""digits AS (
  SELECT row AS drow, regexp_replace(regexp_replace(regexp_replace(phone_raw, '[^0-9]', '', 'g'), '^0{{0,2}}243([0-9]{{9}})$', '\\1'), '^0([0-9]{{9}})$', '\\1') AS d FROM fixture
), std AS (
  SELECT *, {std('name')} AS std_name, {std('job_raw')} AS std_job, {words(_ADM4)} AS adm4_all FROM fixture
), clean AS (
  SELECT row, source_dataset, {words('std_name')} AS name_tokens, CASE WHEN age BETWEEN 0 AND 110 THEN age END AS age, CASE WHEN sex IN ('Male', 'Female') THEN sex END AS sex,
    {std('adm1')} AS adm1, {std('adm2')} AS adm2, {std('adm3')} AS adm3,
    list_filter(adm4_all, lambda t, i: length(t) >= 2 AND t NOT IN ({', '.join(map(q, places.ADM4_TYPE_WORDS))}) AND list_position(adm4_all, t) = i) AS adm4_tokens,
    CASE WHEN length(d) BETWEEN 7 AND 12 AND replace(d, d[1], '') <> '' THEN [d] ELSE []::VARCHAR[] END AS phones,
    {job_cats('std_job')} AS job_cats, truth
  FROM std JOIN digits ON drow = row
)"""

LONG = """long AS (SELECT DISTINCT row, source_dataset, t AS token FROM (SELECT row, source_dataset, unnest(name_tokens) AS t FROM clean) WHERE length(t) >= 2),
surprisal AS (SELECT token, count(*) AS n, -log2((count(*) + 2) / (SELECT count(*) FROM clean)) AS s FROM long GROUP BY token),
stop AS (SELECT DISTINCT token FROM (SELECT source_dataset, token, count(*) AS n FROM long GROUP BY ALL) JOIN (SELECT source_dataset, count(*) AS total FROM clean GROUP BY ALL) USING (source_dataset) WHERE n > total * 0.05)"""

RECORDS = f"""tokens AS (SELECT row, {distinct("list_filter(name_tokens, lambda t: length(t) >= 2)")} AS tf FROM clean),
bits AS (SELECT row AS brow, list(s ORDER BY i) AS tf_bits, list(token ORDER BY i) AS tf_tokens, list(token ORDER BY i) FILTER (token NOT IN (SELECT token FROM stop)) AS block_tokens
  FROM (SELECT row, unnest(tf) AS token, generate_subscripts(tf, 1) AS i FROM tokens) JOIN surprisal USING (token) GROUP BY row),
records AS (
  SELECT row AS unique_id, source_dataset, CASE WHEN len(name_tokens) > 0 THEN name_tokens END AS name_tokens, block_tokens, tf_tokens, tf_bits,
    nullif(array_to_string(list_sort(list_filter(name_tokens, lambda t: length(t) >= 2)), ' '), '') AS name_key, age, sex, adm1, adm2, adm3,
    CASE WHEN len(adm4_tokens) > 0 THEN adm4_tokens END AS adm4_tokens,
    nullif(list_filter(job_cats, lambda t: t NOT IN ('child', 'other')), []::VARCHAR[]) AS job_cats,
    CASE WHEN len(phones) > 0 THEN phones END AS phones, truth
  FROM clean LEFT JOIN bits ON brow = row
)"""

PAIRS = """keyed AS (
  SELECT unique_id, source_dataset, 0 AS match_key, adm2 AS k FROM records
  UNION ALL SELECT DISTINCT unique_id, source_dataset, 1, unnest(block_tokens) FROM records
  UNION ALL SELECT DISTINCT unique_id, source_dataset, 2, unnest(phones) FROM records
), pairs AS (
  SELECT l.unique_id AS id_l, r.unique_id AS id_r, min(l.match_key) AS match_key
  FROM keyed l JOIN keyed r ON l.match_key = r.match_key AND l.k = r.k WHERE l.source_dataset = 'd1' AND r.source_dataset = 'd2' GROUP BY ALL
)"""


def staged(pairs: str) -> str:
    """Adds name_sim, shared_bits and the levels of each comparison to a relation with id_l and id_r."""
    shared = "round(coalesce(list_sum(list_transform(list_intersect(l.tf_tokens, r.tf_tokens), lambda t: l.tf_bits[list_position(l.tf_tokens, t)])), 0), 9)"
    return f"""staged AS (
  SELECT p.*, {name_sim('l.name_tokens', 'r.name_tokens')} AS name_sim, {shared} AS shared_bits, l, r
  FROM {pairs} p JOIN records l ON l.unique_id = id_l JOIN records r ON r.unique_id = id_r
), gammas AS (SELECT *, {', '.join(f'{x} AS gamma_{k}' for k, x in GAMMA.items())} FROM staged)"""


def none(c: str) -> str:
    return f"(l.{c} IS NULL OR r.{c} IS NULL)"


SWAPPED = "list_bool_or(list_transform(range(1, length(a)), lambda i: left(a, i - 1) || a[i + 1] || a[i] || substr(a, i + 2) = b))"
GAMMA = {
    "name": f"CASE WHEN {none('name_tokens')} THEN -1 WHEN name_sim >= 0.94 THEN CASE WHEN shared_bits >= 20 THEN 0 WHEN shared_bits >= 12 THEN 1 ELSE 2 END WHEN name_sim >= 0.85 THEN CASE WHEN shared_bits >= 20 THEN 3 WHEN shared_bits >= 12 THEN 4 ELSE 5 END WHEN name_sim >= 0.75 THEN CASE WHEN shared_bits >= 12 THEN 6 ELSE 7 END ELSE 8 END",
    "age": f"CASE WHEN {none('age')} THEN -1 WHEN l.age = r.age THEN 0 WHEN abs(r.age - l.age) <= 2 THEN 1 WHEN abs(r.age - l.age) <= 5 THEN 2 ELSE 3 END",
    "sex": f"CASE WHEN {none('sex')} THEN -1 WHEN l.sex = r.sex THEN 0 ELSE 1 END",
    "geo": f"CASE WHEN {none('adm1')} AND {none('adm2')} AND {none('adm3')} AND {none('adm4_tokens')} THEN -1 WHEN list_has_any(l.adm4_tokens, r.adm4_tokens) THEN 0 WHEN l.adm3 = r.adm3 THEN 1 WHEN l.adm2 = r.adm2 THEN 2 WHEN l.adm1 = r.adm1 THEN 3 ELSE 4 END",
    "job": f"CASE WHEN {none('job_cats')} THEN -1 WHEN list_has_any(l.job_cats, r.job_cats) THEN 0 ELSE 1 END",
    "phone": f"CASE WHEN {none('phones')} THEN -1 WHEN list_has_any(l.phones, r.phones) THEN 0 WHEN list_min(list_transform(l.phones, lambda a: list_min(list_transform(r.phones, lambda b: damerau_levenshtein(a, b))))) = 1 THEN 1 ELSE 2 END",
}


def scored(prior: float) -> str:
    bf = {}
    for c in default():
        cases = " ".join(f"WHEN {i} THEN {PUBLISHED[c.name][x.label][0] / PUBLISHED[c.name][x.label][1]!r}" for i, x in enumerate(c.levels))
        bf[c.name] = f"CASE gamma_{c.name} {cases} ELSE 1.0 END"
    u = {x: PUBLISHED["geo"][x][1] for x in ("adm3", "adm2")}
    tf = f"CASE gamma_geo WHEN 1 THEN {u['adm3']!r} / s3.share WHEN 2 THEN {u['adm2']!r} / s2.share ELSE 1.0 END"
    shares = ", ".join(f"share{k} AS (SELECT adm{k}, count(*) / (SELECT count(adm{k}) FROM records) AS share FROM records WHERE adm{k} IS NOT NULL GROUP BY ALL)" for k in (2, 3))
    return f"""{shares}, factors AS (
  SELECT g.* EXCLUDE (l, r), {', '.join(f'{x} AS bf_{k}' for k, x in bf.items())}, {tf} AS bf_tf_adj_geo
  FROM gammas g LEFT JOIN share3 s3 ON s3.adm3 = l.adm3 LEFT JOIN share2 s2 ON s2.adm2 = l.adm2
), scored AS (
  SELECT *, {prior_bits(prior)!r} + {' + '.join(f'log2(bf_{k})' for k in bf)} + log2(bf_tf_adj_geo) AS match_weight FROM factors
), predicted AS (SELECT *, 1 / (1 + pow(2.0, -match_weight)) AS match_probability FROM scored),
scores AS (SELECT id_l AS row_1, id_r AS row_2, round(match_weight - {prior_bits(prior)!r}, 6) AS score, match_probability AS posterior FROM predicted)"""


LINKS = """ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, row_1, row_2) AS rn FROM scores WHERE posterior >= 0.5),
greedy(rn, u1, u2, selected) AS (
  SELECT 0::BIGINT, []::BIGINT[], []::BIGINT[], false
  UNION ALL
  SELECT c.rn, CASE WHEN list_contains(u1, row_1) OR list_contains(u2, row_2) THEN u1 ELSE list_append(u1, row_1) END,
    CASE WHEN list_contains(u1, row_1) OR list_contains(u2, row_2) THEN u2 ELSE list_append(u2, row_2) END,
    NOT (list_contains(u1, row_1) OR list_contains(u2, row_2))
  FROM greedy g JOIN ranked c ON c.rn = g.rn + 1
), links AS (SELECT row_1, row_2, score, posterior, selected, CASE WHEN posterior >= 0.9 THEN 'link' ELSE 'review' END AS class FROM ranked JOIN greedy USING (rn))"""

TRUTH = """truth_pairs AS (SELECT l.unique_id AS row_1, min(r.unique_id) AS row_2 FROM records l JOIN records r ON l.truth = r.truth AND l.source_dataset = 'd1' AND r.source_dataset = 'd2' GROUP BY ALL),
confirmed AS (SELECT row_1 FROM truth_pairs UNION SELECT unique_id FROM records WHERE source_dataset = 'd1' AND unique_id % 50 = 0),
categories AS (
  SELECT k.*, CASE WHEN t.row_2 IS NULL AND k.row_1 IN (SELECT row_1 FROM confirmed) THEN 'unverifiable' WHEN t.row_2 IS NULL THEN 'false_positive' WHEN t.row_2 = k.row_2 THEN 'correct' ELSE 'wrong_partner' END AS category
  FROM links k LEFT JOIN truth_pairs t USING (row_1) WHERE selected
)"""


def sql(body: str, *parts: str) -> str:
    recursive = "RECURSIVE " if any("greedy(" in p for p in parts) else ""
    return f"WITH {recursive}" + ",\n".join(parts) + "\n" + body
