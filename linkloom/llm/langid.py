"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fitting counts, over every labelled row, how often each hashed n-gram (1 to 3 code points of the lower-cased text) stands
in each language: tasks count in arrays and hand on a row for each language, bucket and task; Spark sums them. The
matrix of log-probabilities (languages x buckets, a fixed number of buckets) goes to the driver and is broadcast; texts are
scored in batches by looking up the matrix's columns in numpy. Beyond TOGETHER languages the matrix is cut into parts by
language, and texts pass one part after another with the best and the summed probability so far, which is exact too.

Scoring: lang_pred is the most probable language (ties: first in alphabetical order) and score its posterior
probability. A text that is null or has no letter, and every text if nothing was learned, is ``und`` with score 0.
Rows with a null language or a null text teach nothing. Repeated rows count as often as they occur. A null id is never
held out and never learned from. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import Workspace
from linkloom.llm.textarrays import frugal

UND = "und"
#: Languages of a part of the matrix: 2^16 buckets of 8 bytes each.
TOGETHER = 256
#: Characters of texts whose n-grams are held at once, about: some 100 bytes each; times languages, when scored.
AT_ONCE = 100_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@dataclass(frozen=True)
class Part:
    languages: list[str]
    #: buckets x languages
    log_prob: np.ndarray
    log_prior: np.ndarray


@dataclass(frozen=True)
class Model:
    #: In alphabetical order of their languages.
    parts: list[Part]
    bits: int

    @property
    def languages(self) -> list[str]:
        return [x for p in self.parts for x in p.languages]


def grams(texts: list[str | None], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length, the buckets of all n-grams, and where each text's begin (and the end)."""
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    off = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) for t in low], out=off[1:])
    total = np.zeros(len(code), np.uint64)
    room = np.repeat(off[1:], np.diff(off)) - np.arange(len(code))  # code points from here to the text's end
    for n in range(1, 4):
        total = total[: max(0, len(code) - n + 1)] + code[n - 1 :] * _FACTORS[n - 1]
        whole = room[: len(total)] >= n
        x = total[whole] * np.uint64(2 * n + 1)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        starts = np.append(0, np.cumsum(np.maximum(np.diff(off) - n + 1, 0)))
        yield (x >> np.uint64(64 - bits)).astype(np.int64), starts


def blocks(texts: list, most: int = AT_ONCE) -> Iterator[tuple[int, list]]:
    """Runs of whole texts of about that many characters."""
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most or i == len(texts) - 1:
            yield a, texts[a : i + 1]
            a, size = i + 1, 0


def fit(docs: DataFrame, learn: Column, bits: int = 16, alpha: float = 0.5) -> Model:
    """docs: text and lang; learn: which rows to learn from."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                docs_of[lang] = docs_of.get(lang, 0) + len(own)
                into = held.setdefault(lang, np.zeros(1 << bits, np.int64))
                for _, some in blocks(own):
                    for x, _ in grams(some, bits):
                        into += np.bincount(x, minlength=1 << bits)
        for lang, c in held.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * (len(at) + 1), "bucket": np.append(at, -1), "n": np.append(c[at], docs_of[lang])})

    sums = rows.mapInArrow(frugal(count), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    with Workspace(docs.sparkSession, "langid") as ws:
        sums = ws.save(sums, "sums")
        priors = {r.lang: r.n for r in sums.where("bucket < 0").collect()}  # a row for each language
        languages, parts = sorted(priors), []
        for i in range(0, len(languages), TOGETHER):
            own = languages[i : i + TOGETHER]
            got = sums.where((F.col("bucket") >= 0) & F.col("lang").between(own[0], own[-1])).toArrow()  # languages of a part x buckets at most
            number = {x: k for k, x in enumerate(own)}
            counts = np.full((1 << bits, len(own)), alpha)
            counts[got.column("bucket").to_numpy(), [number[x] for x in got.column("lang").to_pylist()]] += got.column("n").to_numpy()
            parts.append(Part(own, np.log(counts / counts.sum(0, keepdims=True)), np.log(np.array([priors[x] for x in own]) / sum(priors.values()))))
    return Model(parts, bits)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns in keep, lang_pred and score, for every row of docs (which has a column text)."""
    spark, final = docs.sparkSession, docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    out = docs.select(*keep, F.col("text").cast("string").alias("text_to_score"), F.lit(UND).alias("best"), F.lit(float("-inf")).alias("top"), F.lit(float("-inf")).alias("total"))
    between = out.schema

    def rated(part: Part, texts: list[str | None], best: list[str], top: np.ndarray, total: np.ndarray) -> None:
        """Brings the best language, its log-probability and the sum of all, by text, up to date."""
        for a, some in blocks(texts, min(AT_ONCE, max(1_000, 4 * AT_ONCE // len(part.languages)))):
            at = np.tile(part.log_prior, (len(some), 1))
            for x, starts in grams(some, model.bits):
                got = np.flatnonzero(np.diff(starts))
                if len(got):
                    at[got] += np.add.reduceat(part.log_prob[x], starts[got], axis=0)
            b = slice(a, a + len(some))
            high = at.max(1)
            total[b] = np.logaddexp(total[b], high + np.log(np.exp(at - high[:, None]).sum(1)))
            for i in np.flatnonzero(high > top[b]):
                best[a + i] = part.languages[at[i].argmax()]
            top[b] = np.maximum(top[b], high)

    def one(held: Broadcast, last: bool) -> Callable[[Iterator], Iterator]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, best = (batch.column(batch.num_columns - k).to_pylist() for k in (4, 3))
                top, total = (batch.column(batch.num_columns - k).to_numpy().copy() for k in (2, 1))
                rated(held.value, texts, best, top, total)
                if last:
                    known = [bool(t) and any(map(str.isalpha, t)) for t in texts]
                    prob = np.where(known, np.exp(np.minimum(top - total, 0.0)), 0.0)
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-4], pa.array([x if k else UND for x, k in zip(best, known, strict=True)], pa.string()), pa.array(prob)], names=[f.name for f in final])
                else:
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(best, pa.string()), pa.array(top), pa.array(total)], names=[f.name for f in between])

        return frugal(run)

    for i, part in enumerate(model.parts):
        last = i == len(model.parts) - 1
        out = out.mapInArrow(one(spark.sparkContext.broadcast(part), last), final if last else between)
    return out if model.parts else out.select(*keep, F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))


def held_out(mod: int, rest: int) -> Column:
    """Whether crc32 of doc_id as text leaves that rest; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == rest, F.lit(False))


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the rows of docs that are not held out."""
    rows = docs.select("doc_id", "text", "lang", held_out(4, 2).alias("held_out"))
    model = fit(rows, ~F.col("held_out") & F.col("doc_id").isNotNull())
    return score(rows, model, ["doc_id", "held_out"])
