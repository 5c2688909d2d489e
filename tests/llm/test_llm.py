"""The ten operators on small tables, against brute force; nulls, empty and long texts, ties, repeated rows, extra columns."""

import os
import collections
import hashlib
import itertools
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.llm import chat, decontamination, jaccard, langid, mixing, neardup, repeats, secrets, textarrays, tokenids, toxicity
from linkloom.llm.common import Workspace
from linkloom.llm.queries import vocabulary

DOCS = "doc_id long, text string, lang string, source string, n_chars long, start int, node int, sig string"


DOCS_NAMES = [x.split()[0] for x in DOCS.split(", ")]


def docs_of(spark, texts, langs=None):
    return spark.createDataFrame([(i, t, (langs or ["en"] * len(texts))[n], f"src{n % 3}", 0, 1, 2, "x") for n, (i, t) in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["ab", "cé", "do", "fi", "gu"]) for _ in range(rng.randint(1, 4)))
    base = [" ".join(word() for _ in range(60)) for _ in range(6)]
    out = [(i, t) for i, t in enumerate(base)]
    for i in range(6, 30):
        w = base[i % 3].split()
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = word()
        out.append((i, " ".join(w)))
    out += [(30, None), (31, ""), (32, " \n "), (33, "One two"), (34, "one TWO"), (35, "ab " * 3000), (36, base[0]), (36, base[0]), (37, "\t".join(base[1].upper().split()))]
    return out


def test_token_ids(spark, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    extra = [(40, "  a  b \n\nC's <|endoftext|>  x "), (41, "中文 é…, \u3000x")]
    got = sorted(map(tuple, tokenids.token_id_output(docs_of(spark, texts + extra), vocabulary()).collect()))
    at, want = 0, []
    for i, x in sorted(texts + extra, key=lambda r: r[0]):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert got == want
    assert tokenids.token_id_output(docs_of(spark, [(1, "x")]).limit(0), vocabulary()).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_gives_the_ids_of_whole_texts(name, monkeypatch):
    """The second vocabulary parts words in another way, so whole texts go to the library; parts are forgotten and learned again."""
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenids, "REMEMBERED", 50)
    path = str(public_tokenizers.path(name))
    t, use = Tokenizer.from_file(path), tokenids.Encoder(path, "<u4")
    assert use.parted == (name == "byte_bpe_50k.json")
    rng = random.Random(3)
    bits = ["the", " The", "\u00e9t\u00e9", " na\u00efve", "\u00d7", " \u00f7", "3\u00d74", " ", "  ", "\n", "\n\n", "it's", "!?", ".", ", ", "\u4e2d\u6587", "\u3000", "\u00a0", "x1y2", "A" * 1200, " 42", "\t", "<|endoftext|>", "\u0253", "\u0301", "\r\n", "d'\u0153uvre", "\U0001f600"]
    for _ in range(150):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(4)]
        got, n = use(*textarrays.as_bytes(pa.array(texts)), 7)
        assert [x.tolist() for x in np.split(got, np.cumsum(n)[:-1])] == [[*t.encode(x, add_special_tokens=False).ids, 7] for x in texts]


def test_chat_round_trip(spark):
    hard = ["\\### Assistant: </turn> ok", "a\\", "\\\\c", "</turn>\n### user: x</turn>", "", None, "plain", "</turn", "\\</turn>\\", "### a: b"]
    rows = [(c, t, role, hard[(c * 3 + t) % len(hard)]) for c in range(20) for t, role in enumerate(["user", "assistant", "a: b", "x\\</turn>", None])]
    rows += [(5, 0, "user", "again"), (None, 0, "user", "no id")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    by = collections.defaultdict(list)
    for c, t, role, x in rows:
        by[c].append((t, role or "", x or ""))
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(df)).collect()}
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        r = got[c]
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{x}\n" for _, a, x in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0


def shingles(t, k=5):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def groups(ids, linked):
    low = {i: i for i in ids}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        low[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize(("long", "step", "heavy"), [(16, 1 << 10, 1 << 16), (2, 3, 4), (1000, 2, 0)])
def test_jaccard_join(spark, texts, long, step, heavy, monkeypatch):
    for name, x in (("LONG", long), ("STEP", step), ("HEAVY", heavy)):
        monkeypatch.setattr(jaccard, name, x)
    sets = {i: shingles(t) for i, t in texts}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = groups(sets, links)
    got = jaccard.join(docs_of(spark, [*texts, (None, texts[0][1])])).collect()
    assert len(got) == len(texts) + 1
    assert all((r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id]) for r in got if r.doc_id is not None)
    kept = {r.doc_id for r in jaccard.one_of_each(docs_of(spark, texts)).collect()}
    assert kept == set(want.values())


def test_jaccard_blocks_lose_no_pair(spark, tmp_path, monkeypatch):
    """All pairs of lists that size and position allow, each once, whatever the blocks; sets of families have a range of sizes."""
    rng = random.Random(8)
    rows = []
    for key in range(12):
        for node in rng.sample(range(400), 3 + 14 * key):
            low = rng.choice([9, 10, 11, 40, rng.randint(5, 60)])
            rows.append((key, node, low, low + rng.choice([0, 0, 2, 9]), rng.randint(low // 2, low)))
    index = spark.createDataFrame(rows, "key long, node long, n_low int, n_high int, left int")
    want = set()
    for a in rows:
        for b in rows:
            small, large = sorted((a, b), key=lambda r: r[3])
            if a[0] == b[0] and a[1] < b[1] and 100 * small[3] >= 80 * large[2] and (1 + min(a[4], b[4])) * 180 >= 80 * (a[2] + b[2]):
                want.add((a[1], b[1]))
    for step, entries, most in ((1 << 10, 1 << 18, 1 << 20), (5, 10, 3), (1, 1, 1)):
        for name, x in (("STEP", step), ("ENTRIES", entries), ("PAIRS", most)):
            monkeypatch.setattr(jaccard, name, x)
        with Workspace(spark, "blocks") as ws:
            got = [tuple(r) for r in jaccard.in_lists(jaccard.meetings(ws, index, 80, 100), 80, 100).collect()]
        assert len(got) == len(set(got)) and want == set(got)


def test_secrets(spark):
    kinds = {"assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6), "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)}
    rng = random.Random(1)
    bits = ["token", "secret", "PassWord", "api_key", " ", ":", "=", '"', "abc", "AKIA", "ABCDEFGHIJ1234567", "deadbeef0123", "\n", "é", "ab12cd34ef567890"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))) for i in range(400)] + [(400, None), (401, ""), (402, "ghp_" + "Z" * 40)]
    got = {r.doc_id: r for r in secrets.digest(secrets.find_secrets(docs_of(spark, rows))).collect()}
    for i, t in rows:
        spans = sorted((m.start(), n, m.end(), k) for n, (k, (p, f)) in enumerate(kinds.items()) for m in re.finditer(p, t or "") if f(m))
        assert got[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()
    assert got[402].spans == "github:0:44"


def test_toxicity_learns_and_is_fair(spark):
    toxic = (np.arange(400) % 4 == 0).astype(int)
    words = lambda t, i: f"some words here {'idiot' if t else 'fine'} muslims {i % 7}" if t or i % 5 == 0 else f"some words here fine {i % 7}"
    rows = spark.createDataFrame([(words(t, i), int(t)) for i, t in enumerate(toxic)], "text string, toxic int")
    fair, plain = toxicity.learn(rows), toxicity.learn(rows, fair=0.0)
    group, neutral = toxicity.bucket("muslims"), toxicity.bucket("people")
    assert abs(fair.weights[group] - fair.weights[neutral]) < abs(plain.weights[group] - plain.weights[neutral])
    assert fair.weights[toxicity.bucket("idiot")] > 1


def test_toxicity_steps_follow_the_gradient():
    """The penalised loss, worked out plainly: its value falls, and at the end its slope, by differences, is all but level."""
    rng = np.random.default_rng(1)
    x = rng.random((60, 6)) < 0.4
    y = (rng.random(60) < 0.2 + 0.6 * x[:, 0]).astype(int)
    swap, times = np.array([[0, 1], [2, -1]]), np.array([3, 2])
    row, col = np.nonzero(x)

    def loss(w, b):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        full = np.append(w, 0.0)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() + 0.5e-2 * (w**2).sum() + (times / 5 * (full[swap[:, 0]] - full[swap[:, 1]]) ** 2).sum()

    w, b = toxicity.descend(row, col, y, 6, swap, times, 1e-2, 1.0, 3000)
    assert loss(w, b) < loss(np.zeros(6), 0.0)
    for k in range(6):
        step = np.eye(6)[k] * 1e-4
        assert abs(loss(w + step, b) - loss(w - step, b)) / 2e-4 < 2e-3


def test_toxicity_defined_cases(spark):
    """Ties of labels: the largest; repeated rows repeat; null, empty and very long texts; no documents; columns of the same names."""
    rows = [(i, "you idiot " + "word " * 9 if i % 4 == 0 else "kind " + "word " * 9) for i in range(200)] + [(3, "kind word"), (3, "kind word"), (None, "x"), (600, None), (601, ""), (602, "kind " * 50_000 + "idiot")]
    docs = docs_of(spark, rows).withColumn("score", F.lit("own")).withColumn("toxic", F.lit(9)).withColumn("predicted", F.lit(5))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(i, 0) for i in range(0, 200, 4)] + [(None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and sum(r.doc_id == 3 for r in got) == 3 and not by[None].held_out
    assert all(by[i].predicted == int(i % 4 == 0) for i in range(4, 200)) and by[600].score == by[601].score
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    share = toxicity.toxicity(docs, labels.where("toxic = 0")).collect()
    assert len({r.score for r in share}) == 1 and share[0].score < 0.1


def test_toxicity_query(spark):
    rows = [(i, "you idiot " + "word " * 20 if i % 4 == 0 else "kind " + "word " * 20) for i in range(200)] + [(500, None), (501, "")]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)] + [(500, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs_of(spark, rows), labels).collect()}
    assert len(got) == 202 and all(got[i].predicted == int(i % 4 == 0) for i in range(200))
    assert got[3].held_out == (zlib.crc32(b"3") % 3 == 1) and 0 <= got[500].score <= 1
    assert {r.score for r in toxicity.toxicity(docs_of(spark, rows), labels.limit(0)).collect()}.__len__() == 1


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK", 40)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 20))
    x = np.concatenate([base, base[:20] + 0.15 * rng.normal(size=(20, 20)), np.repeat(base[:2], 15, 0), base[3:4] + 0.05 * rng.normal(size=(40, 20))]).astype(np.float32)
    rows = [(i, [float(y) for y in v], 0, 1) for i, v in enumerate(x)] + [(900, None, 0, 1), (901, [0.0] * 20, 0, 1), (902, [None] + [1.0] * 19, 0, 1), (903, [float("nan")] * 20, 0, 1), (904, [1.0, 2.0], 0, 1), (905, [], 0, 1)]
    got = {r.vec_id: r for r in neardup.join(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int")).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = u @ u.T >= 0.9
    np.fill_diagonal(s, False)
    want = groups(range(len(x)), np.argwhere(s))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (s[i].sum(), want[i], i == want[i]) for i in range(len(x)))
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(900, 906))


def test_near_vectors_are_written_once_a_block(spark, monkeypatch):
    """Disk grows with the vectors: a chunk that has many meetings is one file, and it goes when the links are found."""
    monkeypatch.setattr(neardup, "CHUNK", 30)
    monkeypatch.setattr(neardup, "TOGETHER", 0)
    held, remove = [], neardup.remove

    def seen(session, path):
        folder = path.removeprefix("file:")
        folder = folder[2:] if folder.startswith("//") else folder
        held.append(sum(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if not f.startswith(".")))
        remove(session, path)
        assert not os.path.exists(folder)

    monkeypatch.setattr(neardup, "remove", seen)
    x = np.random.default_rng(3).normal(size=(600, 32)).astype(np.float32)
    x[300:] = x[:300] * np.float32(1.5) + np.float32(0.01)
    got = neardup.join(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")).collect()
    assert len(got) == 600 and all(r.n_links >= 1 for r in got)
    assert held == [600 * (16 + 32 * 4)] * 2  # one block after another


def test_mixing_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 5), ["en", "de"][i % 2] if i % 10 else None, f"src{i % 8}", 0, 1, 2, "x") for i in range(2000)]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix_sources(df, {"d0": 0.7, "*": 0.1}, budget=3000, seed=3, max_epochs=2)
    by = {r.mix_domain: r.n for r in got.groupBy("mix_domain").agg(F.sum("mix_tokens").alias("n")).collect()}
    room = 2 * sum(1 + i % 5 for i in range(2000) if i % 4 == 0)
    first = min(2100, room)
    assert first - 60 <= by["d0"] <= first and sum(by.values()) <= 3000
    assert got.groupBy("doc_id", "mix_epoch").count().where("count > 1").count() == 0
    again = mixing.mix_sources(df, {"d0": 0.7, "*": 0.1}, budget=3000, seed=3, max_epochs=2)
    assert sorted(map(tuple, got.select("doc_id", "mix_epoch").collect())) == sorted(map(tuple, again.select("doc_id", "mix_epoch").collect()))
    assert mixing.mix_sources(df.limit(0), {}).count() == 0


def test_mixing_prefix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE", 50)
    df = spark.createDataFrame([(i, "w " * (1 + i % 5), "en", "src0", 0, 1, 2, "x") for i in range(700)], DOCS)
    order = [r.doc_id for r in df.orderBy(F.shiftrightunsigned(F.xxhash64(F.lit(3), F.lit(0), "doc_id"), 33) % (1 << 31)).collect()]
    assert len(order) == 700
    got = {r.doc_id for r in mixing.mix_sources(df, {}, budget=900, seed=3).collect()}
    tokens = sum(1 + i % 5 for i in got)
    assert 895 < tokens <= 900


def shares(children, budget):
    """children: name -> (weight, limit). The budget dealt by weight; who is full drops out, until nothing changes."""
    full, out = {}, dict.fromkeys(children, 0.0)
    while True:
        left = budget - sum(full.values())
        weight = sum(w for c, (w, _) in children.items() if c not in full)
        over = {c: m for c, (w, m) in children.items() if c not in full and w > 0 and left * w / weight >= m - 1e-9}
        if not over:
            break
        full |= over
    return out | {c: left * w / weight for c, (w, _) in children.items() if c not in full and weight > 0} | full


def test_mixing_against_a_plain_mixture(spark, monkeypatch):
    """Budgets down the tree and the exact prefix of each leaf's last epoch, from the documented order; nulls, ties, repeated rows."""
    monkeypatch.setattr(mixing, "RANGE", 30)
    monkeypatch.setattr(mixing, "PARTS", 4)
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(0, 9), rng.choice(["en", "de", None]), rng.choice(["src0", "src1", "src4", "src5", None, "blog"]), 0, 1, 2, "x") for i in range(600)]
    rows += [(None, "a b", "en", "src0", 0, 1, 2, "x"), (7, None, "en", "src0", 0, 1, 2, "x"), rows[3], rows[3], (900, "z " * 4000, "de", "src1", 0, 1, 2, "x")]
    tree, budget, most, seed = {"d0": (3.0, {"en": 2.0, "*": (1.0, {"src4": 5.0})}), "d1": 1.0}, 4000, 3, 11
    df = spark.createDataFrame(rows, DOCS).withColumns({"mix_tokens": F.lit("own"), "mix_part": F.lit(1), "at": F.lit(1), "n": F.lit(1), "room": F.lit(1), "upto": F.lit(1)})
    tokens = lambda t: len((t or "").split())
    leaf = lambda r: ("d" + (str(int(re.search(r"(\d+)$", r[3])[1]) % 4) if r[3] and re.search(r"\d+$", r[3]) else "0"), r[2] or "", r[3] or "")
    size = collections.Counter()
    for r in rows:
        size[leaf(r)] += tokens(r[1])
    own = lambda x: x[0] if isinstance(x, tuple) else x
    below = lambda x: x[1] if isinstance(x, tuple) else {}
    target = {}
    part = lambda i, head: {x[i] for x in size if x[:i] == head}
    limit = lambda head: float(most * sum(n for x, n in size.items() if x[: len(head)] == head))
    pick = lambda level, name: level.get(name, level.get("*", 1.0))
    for d, b in shares({d: (own(pick(tree, d)), limit((d,))) for d in part(0, ())}, budget).items():
        langs = below(pick(tree, d))
        for x, c in shares({x: (own(pick(langs, x)), limit((d, x))) for x in part(1, (d,))}, b).items():
            sources = below(pick(langs, x))
            for y, t in shares({y: (own(pick(sources, y)), limit((d, x, y))) for y in part(2, (d, x))}, c).items():
                target[d, x, y] = t
    whole = {x: (min(most, int(t * (1 + 1e-12) // size[x])) if size[x] else 1) for x, t in target.items()}
    keyed = spark.createDataFrame([(n, r[0], r[1], whole[leaf(r)]) for n, r in enumerate(rows)], "n long, doc_id long, text string, whole int")
    place = {r.n: (r.range, r.h, r.id, r.t) for r in keyed.select("n", F.pmod(F.shiftrightunsigned(F.xxhash64(F.lit(seed), "whole", "doc_id"), 33), F.lit(1 << 31)).alias("range"), F.xxhash64(F.lit(seed), "whole", "doc_id").alias("h"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64("text").alias("t")).collect()}
    want = collections.Counter()
    for x in size:
        rest = int(target[x] - whole[x] * size[x] + 1e-6) if size[x] else 0
        members = collections.defaultdict(list)
        count = sum(leaf(r) == x for r in rows)
        ranges = -(-count // 30)
        for n, r in enumerate(rows):
            if leaf(r) == x:
                want[str(r[0]), r[1]] += whole[x]
                members[(place[n][0] * ranges * 4 // 2**31, *place[n][1:])].append(n)
        for k in sorted(members) if rest > 0 else []:
            rest -= sum(tokens(rows[n][1]) for n in members[k])
            if rest < 0:
                break
            want.update((str(rows[n][0]), rows[n][1]) for n in members[k])
    got = mixing.mix_sources(df, tree, budget, seed, most)
    assert got.columns == [*DOCS_NAMES, "at", "n", "room", "upto", *mixing.KEYS, "mix_tokens", "mix_epoch"]
    assert collections.Counter((str(r.doc_id), r.text) for r in got.collect()) == +want


def test_language(spark):
    rows = [(i, {"en": "the house and the tree of ", "fr": "la maison et les arbres du "}[["en", "fr"][i % 2]] * (1 + i % 4)) for i in range(80)] + [(90, None), (91, "123 !!"), (92, "The tree")]
    got = {r.doc_id: r for r in langid.language_id(docs_of(spark, rows, [["en", "fr"][i % 2] for i in range(80)] + [None, "en", "en"])).collect()}
    assert all(got[i].lang_pred == ["en", "fr"][i % 2] for i in range(80)) and got[92].lang_pred == "en"
    assert got[90].lang_pred == got[91].lang_pred == "und" and got[90].score == 0
    assert got[7].held_out == (zlib.crc32(b"7") % 4 == 2)
    none = langid.language_id(docs_of(spark, rows[:3], [None] * 3)).collect()
    assert {r.lang_pred for r in none} == {"und"}


def bayes(rows, bits=16, alpha=0.5):
    """Naive Bayes written out: for each text the language and its probability. rows: id, text, lang."""

    def buckets(t):
        for n in (1, 2, 3):
            for i in range(len(t) - n + 1):
                x = sum(ord(c) * f for c, f in zip(t[i : i + n], (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))) % 2**64
                x = x * (2 * n + 1) % 2**64
                x ^= x >> 29
                yield x * 0xBF58476D1CE4E5B9 % 2**64 >> 64 - bits

    counts, docs = collections.defaultdict(collections.Counter), collections.Counter()
    for i, t, lang in rows:
        if i is not None and t is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            counts[lang].update(buckets(t.lower()))
            docs[lang] += 1
    out = []
    for _, t, _ in rows:
        if not t or not any(c.isalpha() for c in t) or not docs:
            out.append(("und", 0.0))
            continue
        own = {x: np.log(docs[x] / docs.total()) + sum(np.log((counts[x][b] + alpha) / (counts[x].total() + alpha * 2**bits)) for b in buckets(t.lower())) for x in sorted(docs)}
        best = max(own, key=own.get)
        out.append((best, 1 / sum(np.exp(v - own[best]) for v in own.values())))
    return out


@pytest.mark.parametrize("together", [256, 2])
def test_language_against_plain_bayes(spark, together, monkeypatch):
    """Also in parts of two languages; ties, repeated rows, null ids, texts and languages, empty and long texts, other columns."""
    monkeypatch.setattr(langid, "TOGETHER", together)
    rng = random.Random(6)
    letters = {"en": "the hous", "fr": "les mai\u00e9\u00e8", "de": "der h\u00e4us", "es": "las cas\u00f1", "pt": "os c\u00e3as"}
    rows = [(i, "".join(rng.choice(letters[lang]) for _ in range(rng.randint(1, 12))), lang) for i in range(120) for lang in [rng.choice(sorted(letters))]]
    rows += [(None, "the the", "fr"), (200, None, "en"), (201, "", "en"), (202, "12 ?!", "en"), (203, "\u4e2d\u6587", None), (204, "les " * 3000, None), rows[5], rows[5], (205, "s", None)]
    docs = docs_of(spark, [x[:2] for x in rows], [x[2] for x in rows]).withColumns({c: F.lit("own") for c in ("lang_pred", "score", "best", "top", "total", "text_to_score", "held_out")})
    got = langid.language_id(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    key = lambda r: (str(r[0]), r[1], round(r[2], 6))
    want = bayes(rows)
    assert sorted(key((r.doc_id, r.lang_pred, r.score)) for r in got.collect()) == sorted(key((x[0], *y)) for x, y in zip(rows, want, strict=True))
    assert {r.held_out for r in got.where("doc_id is null").collect()} == {False}
    assert langid.language_id(docs.limit(0)).count() == 0


def overlapping(doc, item):
    """Whether some alignment has a stretch with few enough changed words, worked out plainly."""
    d, w = (re.findall(r"[^\W_]+", (t or "").lower()) for t in (doc, item))
    if len(w) < decontamination.SHORTEST:
        return False
    width = min(len(w), decontamination.WINDOW)
    most = 0 if len(w) < decontamination.SPAN else width // decontamination.SLACK
    for shift in range(-len(w), len(d) + 1):
        same = [0 <= i + shift < len(d) and d[i + shift] == x for i, x in enumerate(w)]
        if any(sum(same[i : i + width]) >= width - most for i in range(len(w) - width + 1)):
            return True
    return False


def test_decontamination_against_plain_alignment(spark):
    """Items of 4 to 24 words, whole, changed, cut and in any place; repeated words, repeated items and documents, null and empty texts."""
    rng = random.Random(12)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice("aeiou")
    items = [(n, " ".join(word() for _ in range(n))) for n in range(2, 25)] + [(30, "ba " * 6), (31, "ba " * 20), (32, None), (33, ""), (5, "da da de de di")]
    docs = []
    for i in range(400):
        own = rng.choice([x for x in items if x[1]])[1].split()
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            own[rng.randrange(len(own))] = word()
        cut = rng.choice([0, 0, 0, 1, 2])
        own = own[cut:] if rng.random() < 0.5 else own[: len(own) - cut]
        docs.append((i, " ".join([word() for _ in range(rng.choice([0, 1, 2, 7]))] + own + [word() for _ in range(rng.choice([0, 1, 5]))])))
    docs += [(400, None), (401, ""), (402, "ba " * 5), (403, "ba " * 40), docs[0], (404, "zz " * 5000 + items[15][1])]
    want = {(i, k) for i, t in docs for k, x in items if overlapping(t, x)}
    got = [(r.doc_id, r.item_id) for r in decontamination.contaminated(docs_of(spark, docs), spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")).collect()]
    assert set(got) == want and len(got) == len(set(got)) and len(want) > 200


@pytest.mark.parametrize("k", [4, 5, 6, 7])
def test_decontamination_finds_short_items_everywhere(spark, k):
    item = " ".join(f"w{i}" for i in range(k))
    docs = [(at, " ".join([f"x{i}" for i in range(at)] + [item] + ["y"])) for at in range(12)] + [(50, " ".join(item.split()[:-1]))]
    got = {(r.doc_id, r.start, r.end) for r in decontamination.contaminated(docs_of(spark, docs), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got == {(at, at, at + k) for at in range(12)}


def test_decontamination(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(5)] + [(5, "just five words in here"), (6, None), (7, "two words")]
    noise = lambda n: " ".join(word() for _ in range(n))
    changed = items[1][1].split()
    changed[6] = changed[15] = changed[24] = "zzz"
    docs = [(0, noise(200)), (1, noise(50) + " " + items[0][1].upper() + ". " + noise(50)), (2, noise(20) + " " + " ".join(changed) + " " + noise(20)), (3, " ".join(items[2][1].split()[:6])), (4, None), (5, ""), (6, "so Just five, words in here!"), (7, items[3][1]), (7, items[3][1]), (8, "two words " + noise(30))]
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, codes int")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs_of(spark, docs), bench).collect()}
    assert got == {(1, 0), (2, 1), (6, 5), (7, 3)}
    kept = decontamination.decontaminate(docs_of(spark, docs), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 5, 8] and kept.columns == docs_of(spark, docs).columns
    assert decontamination.contaminated(docs_of(spark, docs), bench.limit(0)).count() == 0


def accepted(n):
    """The sets of changed words of an item, or stretch, of n words that the verifier accepts."""
    most = min(n, decontamination.WINDOW) // decontamination.SLACK
    return [p for k in range(most + 1) for p in itertools.combinations(range(n), k)]


@pytest.mark.parametrize("n", range(8, 18))
def test_masks_reach_what_the_verifier_accepts(n):
    zeros = [{i for i, x in enumerate(m) if x == "0"} for m in decontamination.MASKS]
    span = decontamination.SPAN
    stretch = min(n, decontamination.WINDOW)
    missed = [p for p in accepted(stretch) if not any({x - w for x in p if w <= x < w + span} <= z for w in range(stretch - span + 1) for z in zeros)]
    assert missed == []


def test_decontamination_finds_changed_short_items(spark):
    lengths = {8: accepted(8), 10: accepted(10), 16: [(1, 8, 9), (0, 1, 2)], 15: [(0, 1, 2), (6, 7, 8), (1, 7, 13)]}
    bench = [(n, " ".join(f"w{n}x{i}" for i in range(n))) for n in lengths]
    docs, want = [], set()
    for n, patterns in lengths.items():
        for p in patterns:
            w = [f"c{len(docs)}y{i}" if i in p else f"w{n}x{i}" for i in range(n)]
            for t in (["so", "it", "goes"] + w + ["and", "so", "on"], w[len([i for i in p if i < len(p) and p[i] == i]) :]):
                want.add((len(docs), n))
                docs.append((len(docs), " ".join(t)))
    docs += [(len(docs), "c0 c1 w8x2 w8x3 w8x4 w8x5 w8x6 w8x7"), (len(docs) + 1, " ".join(f"w8x{i}" for i in range(7))), (len(docs) + 2, " ".join(f"w16x{i}" for i in range(3, 16)))]
    want |= {(len(docs) - 2, 8), (len(docs) - 1, 16)}
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs_of(spark, docs), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert got == want


def test_suffix_order():
    for n in [*range(20), 200]:
        for k in (1, 2, 30):
            t = np.random.default_rng(n + k).integers(1, k + 1, n)
            assert repeats.suffix_order(t).tolist() == sorted(range(n), key=lambda i: t[i:].tolist())


@pytest.mark.parametrize(("crowd", "piece"), [(1000, 1 << 21), (1, 500)])
def test_repeats(spark, texts, crowd, piece, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    monkeypatch.setattr(repeats, "PIECE", piece)
    length = 60
    rows = [*texts, (50, "x" * 500), (None, "é" * 40)]
    count = collections.Counter(b[j : j + length] for _, t in rows for b in [(t or "").encode()] for j in range(len(b) - length + 1))
    want = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            if count[b[j : j + length]] > 1:
                gone[j : j + length] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        want.append((i if i is not None else -1, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest(), bool(gone.any())))
    got = [(r.doc_id if r.doc_id is not None else -1, *r[1:]) for r in repeats.digest(repeats.remove_repeats(docs_of(spark, rows), length, 16)).collect()]
    assert sorted(got) == sorted(want)


def test_shingles_do_not_cross_rows():
    rows = ["a b c", "d e f g h i", "", "a b  c"]
    data, off = textarrays.as_bytes(pa.array(rows))
    got = list(textarrays.shingle_rows(data, off, 5))
    assert [len(x) for x in got] == [1, 2, 0, 1] and got[0].tolist() == got[3].tolist()


def test_repeats_hand_memory_back(spark, monkeypatch):
    """Workers live on between tasks, so every step gives back what it no longer needs; the filter is made in its packed size."""
    seen, plain = [], repeats.frugal
    monkeypatch.setattr(repeats, "frugal", lambda f: seen.append(f.__name__) or plain(f))
    text = "".join(random.Random(4).choices("abcdefgh ", k=900))
    got = {r.doc_id: r for r in repeats.digest(repeats.remove_repeats(docs_of(spark, [(1, text), (2, "x" + text), (3, "other")]))).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[3].n_removed) == (900, 900, 0)
    assert {"counted", "fold", "contexts", "sort", "deal", "meet", "cut"} <= set(seen)
    grams = [5, -7, 1 << 40, (1 << 27) - 1, 5]
    bits = repeats.filter_bits(spark.createDataFrame([(g,) for g in grams], "gram long"))
    assert sorted(np.flatnonzero(np.unpackbits(bits))) == sorted({g % (1 << 27) for g in grams})


def test_workers_keep_no_encoder(spark, monkeypatch):
    """When a task hands memory back, its encoder, with all that it remembers, is gone."""
    plain = tokenids.frugal

    def checked(f):
        def run(batches):
            import gc

            yield from f(batches)
            assert not [x for x in gc.get_objects() if type(x).__name__ == "Encoder"]

        return plain(run)

    monkeypatch.setattr(tokenids, "frugal", checked)
    assert tokenids.token_id_output(docs_of(spark, [(i, f"text {i}") for i in range(40)]), vocabulary()).count() == 40


def test_language_takes_few_characters_at_once():
    import tracemalloc

    texts = ["the house " * 20] * 5_000
    tracemalloc.start()
    n = sum(len(x) for _, some in langid.blocks(texts) for x, _ in langid.grams(some, 16))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 5_000 * (200 + 199 + 198) and most < 30_000_000
