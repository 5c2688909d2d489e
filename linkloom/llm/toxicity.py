"""Toxicity: a logistic classifier over hashed words, regularised by counterfactuals.

Features are the distinct words of the whole text (runs of letters, lower case), hashed to BUCKETS buckets; the buckets
that tell the classes apart best on the training rows are kept, with a weight each. Training minimises log-loss, an L2
penalty and the counterfactual penalty: in every sentence of a training row that names a group, the term is swapped for
every other term of its list (a neutral word among them), and the squared change of the row's logit is penalised. A
term's weight is thus held to that of its neutral word, so that naming a group does not move a score.

Fitting uses at most MAX_ROWS labelled rows, those with the smallest hashes of their ids (a documented bound for the
driver's memory; the same rows at any partitioning). Executors count words and swaps and cut rows down to the chosen buckets. Scoring covers every row and every whole text with the weights
broadcast (their size is fixed).

Several labels of one doc_id: the largest counts; several texts: that of the least hash is learned from. Null label, null text or null id: never learned from. Scores: a null or
empty text has the score of a text without known words. With no row, or one class only, to learn from, every score is the
smoothed share of toxic rows. A null id is never held out. Repeated rows give repeated results; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import Workspace, shuffle_parts
from linkloom.llm.langid import held_out
from linkloom.llm.textarrays import frugal, slices, word_hashes

BITS = 18
MAX_ROWS = 20_000
THRESHOLD = 0.7
#: Terms of a list may stand for one another; the first of each is neutral.
IDENTITY = (
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "immigrants", "refugees", "africans", "asians", "arabs", "europeans", "mexicans", "women", "men", "gays", "lesbians"),
    ("person", "muslim", "christian", "jew", "hindu", "buddhist", "atheist", "immigrant", "refugee", "african", "asian", "arab", "european", "mexican", "woman", "man", "lesbian"),
    ("human", "jewish", "islamic", "black", "white", "latino", "gay", "queer", "transgender", "straight", "female", "male", "disabled", "deaf", "blind", "old", "young"),
    ("personne", "musulman", "chrétien", "juif", "immigré", "réfugié", "africain", "arabe", "femme", "homme"),
    ("mensch", "muslime", "christen", "juden", "einwanderer", "flüchtling", "afrikaner", "araber", "frau", "mann"),
    ("persona", "musulmán", "cristiano", "judío", "inmigrante", "refugiado", "africano", "árabe", "mujer", "hombre"),
)
#: ASCII bytes that are no letters part words.
APART = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def word_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct buckets of each text's words, sorted."""
    for _, data, off in slices(pc.utf8_lower(texts.cast(pa.large_string()))):
        h, _, _, at = word_hashes(data, off, APART)
        h = (h >> np.uint64(64 - BITS)).astype(np.int64)
        for i, j in zip(at[:-1], at[1:], strict=True):
            s = np.sort(h[i:j])
            yield s[np.append(True, s[1:] != s[:-1])] if len(s) else s


def bucket(word: str) -> int:
    return int(next(word_sets(pa.array([word])))[0])


_TERMS = {w: ws for ws in IDENTITY for w in ws}
_TERM = re.compile(r"(?<![^\W\d_])(?:" + "|".join(sorted(_TERMS, key=len, reverse=True)) + r")(?![^\W\d_])")


def swaps(text: str) -> list[tuple[str, str]]:
    """For each sentence that names a group: the term, and another that could stand there."""
    return [(w, v) for s in re.split(r"[.!?\n]+", text.lower()) for w in dict.fromkeys(_TERM.findall(s)) for v in _TERMS[w] if v != w]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def chosen_features(pos: np.ndarray, neg: np.ndarray, toxic: int, clean: int, features: int) -> np.ndarray:
    """The buckets, sorted, whose share of rows differs most between the classes. pos, neg: rows with each bucket."""
    odds = np.log((pos + 0.5) / (toxic - pos + 0.5)) - np.log((neg + 0.5) / (clean - neg + 0.5))
    z = np.abs(odds) / np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    z[pos + neg < 3] = 0
    chosen = np.sort(np.argsort(-z, kind="stable")[:features])
    return chosen[z[chosen] > 3]


def descend(row: np.ndarray, col: np.ndarray, toxic: np.ndarray, size: int, swap: np.ndarray, times: np.ndarray, l2: float, fair: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and bias. row, col: which row has which feature; swap: pairs of features that stand for one another (-1: none),
    each in so many counterfactual sentences.
    """
    n = len(toxic)
    w, b = np.zeros(size + 1), prior_logit(toxic.sum(), n)  # the last weight stands for terms without one: always 0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    share = times / max(1, times.sum())
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(b + np.bincount(row, w[col], n))))
        g = np.bincount(col, (p - toxic)[row], len(w)) / n + l2 * w
        if len(swap):
            change = (w[swap[:, 0]] - w[swap[:, 1]]) * share
            g += 2 * fair * (np.bincount(swap[:, 0] % len(w), change, len(w)) - np.bincount(swap[:, 1] % len(w), change, len(w)))
        g[-1] = 0
        gb = float((p - toxic).mean())
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b -= 0.1 * (mb / (1 - 0.9**t)) / (vb**0.5 / (1 - 0.999**t) ** 0.5 + 1e-8)
    return w[:-1], float(b)


def prior_logit(toxic: float, n: int) -> float:
    return float(np.log((toxic + 0.5) / (n - toxic + 0.5))) if n else -2.0


def learn(rows: DataFrame, l2: float = 1e-4, fair: float = 1.0, features: int = 4096, steps: int = 300) -> Model:
    """rows: text, toxic (0 or 1). Executors count buckets and swaps and cut the rows down to the chosen buckets; the driver
    gets these sums, of a bounded size, and for each row the numbers of its chosen buckets.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """kind 0: rows of a class; 1: rows of a class with a bucket; 2: swaps of one bucket for another."""
        seen = np.zeros((2, 1 << BITS), np.int64)
        classes, pairs = np.zeros(2, np.int64), Counter()
        for batch in batches:
            toxic = batch.column(1).to_pylist()
            for s, y in zip(word_sets(batch.column(0)), toxic, strict=True):
                seen[y, s] += 1
                classes[y] += 1
            for t in batch.column(0).to_pylist():
                pairs.update(swaps(t))
        y, x = np.nonzero(seen)
        a = [*range(2), *x, *(bucket(p) for p, _ in pairs)]
        b = [*range(2), *y, *(bucket(q) for _, q in pairs)]
        n = [*classes, *seen[y, x], *pairs.values()]
        yield pa.RecordBatch.from_pydict({"kind": pa.array([0] * 2 + [1] * len(x) + [2] * len(pairs), pa.int32()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "n": pa.array(n, pa.int64())})

    sums = rows.mapInArrow(frugal(count), "kind int, a int, b int, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).toArrow()
    kind, a, b, n = (sums.column(c).to_numpy() for c in ("kind", "a", "b", "n"))
    classes, seen = np.zeros(2, np.int64), np.zeros((2, 1 << BITS), np.int64)
    classes[a[kind == 0]] = n[kind == 0]
    seen[b[kind == 1], a[kind == 1]] = n[kind == 1]
    weights = np.zeros(1 << BITS, np.float32)
    if not classes.all():
        return Model(weights, prior_logit(classes[1], int(classes.sum())))
    chosen = chosen_features(seen[1], seen[0], int(classes[1]), int(classes[0]), features)
    number = np.full(1 << BITS, -1)
    number[chosen] = np.arange(len(chosen))
    held = rows.sparkSession.sparkContext.broadcast(number.astype(np.int32))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [held.value[s] for s in word_sets(batch.column(0))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([x[x >= 0].astype(np.int16) for x in own], pa.list_(pa.int16()))], names=["toxic", "own"])

    got = rows.mapInArrow(frugal(cut), "toxic int, own array<short>").toArrow()  # MAX_ROWS rows of 2 bytes a chosen bucket
    own = got.column("own").combine_chunks()
    size = np.diff(own.offsets.to_numpy())
    swap = np.stack([number[a[kind == 2]], number[b[kind == 2]]], 1)
    some = (swap >= 0).any(1)
    weights[chosen], bias = descend(np.repeat(np.arange(len(size)), size), own.flatten().to_numpy().astype(np.int64), got.column("toxic").to_numpy().astype(np.int64), len(chosen), swap[some], n[kind == 2][some], l2, fair, steps)
    return Model(weights, bias)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    known = labels.where(~held_out(3, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic is not null")
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.where("text is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(some), "doc_id")  # max_rows ids at most
    rows = rows.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.max("toxic").alias("toxic"))
    with Workspace(docs.sparkSession, "toxicity") as ws:
        return learn(ws.save(rows.select("text", (F.col("toxic") > 0).cast("int").alias("toxic")).repartition(shuffle_parts(docs.sparkSession)), "rows"))


def score(docs: DataFrame, model: Model, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """The columns in keep, score and predicted, for every row of docs (which has a column text)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            x = np.array([m.bias + m.weights[s].sum(dtype=np.float64) for s in word_sets(batch.column(batch.num_columns - 1))], np.float64)
            p = 1 / (1 + np.exp(-np.clip(x, -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[f.name for f in schema])

    return docs.select(*keep, F.col("text").cast("string").alias("text_to_score")).mapInArrow(frugal(run), schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    model = train(docs, labels)
    return score(docs.select("doc_id", "text", held_out(3, 1).alias("held_out")), model, ["doc_id", "held_out"])
