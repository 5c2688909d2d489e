"""Secret scans: all rules as one minimal deterministic automaton, one pass over each text's bytes.

The combined automaton holds each rule's trigger, a pattern with which every match of the rule begins, and says byte by
byte which triggers end here. For such a rule, the automaton of the reversed trigger walks back to the leftmost start,
and that of the whole pattern walks on to the longest end; the rule then resumes behind it. Matches of a rule are so
leftmost, longest and non-overlapping; different rules may overlap. This holds for rules in whose trigger no other one,
that begins later, ends, as is the case for all of RULES. A match that fails its rule's length is dropped, and what it
covered stays covered. The automata are built once, on the driver, and broadcast (their size depends on the rules only).

Offsets are code points, end exclusive. Null text: empty, no spans. Repeated rows give repeated results; other columns
are ignored. A text is scanned whole, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.automaton import Dfa, Nfa, deterministic
from linkloom.llm.textarrays import slices

WORDS = "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: What every match begins with; none: the pattern without a last "+".
    trigger: str = ""
    #: Characters that a match has at least, behind its head if there is one.
    least: int = 1
    #: What comes before the secret itself.
    head: str = ""
    any_case: bool = False
    #: Whether it is one of the base kinds.
    base: bool = False


RULES = (
    Rule("assign", WORDS + "[A-Za-z0-9+/_.=-]+", least=6, head=WORDS, any_case=True, base=True),
    Rule("access", "AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", "[0-9a-f]{24,}", "[0-9a-f]{24}", base=True),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", "eyJ[A-Za-z0-9_-]", 30),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN "),
)


@dataclass(frozen=True)
class Scanner:
    rules: tuple[Rule, ...]
    all: Dfa
    ahead: tuple[Dfa, ...]
    back: tuple[Dfa, ...]
    heads: tuple[Dfa | None, ...]


@lru_cache(8)
def compiled(rules: tuple[Rule, ...]) -> Scanner:
    nfa, ends, starts = Nfa(), {}, []
    for k, r in enumerate(rules):
        trigger = r.trigger or r.pattern.removesuffix("+")
        a, b = nfa.rule(trigger, r.any_case)
        starts.append(a)
        ends[b] = k
    ahead, back, heads = [], [], []
    for r in rules:
        one = Nfa()
        a, b = one.rule(r.pattern, r.any_case)
        ahead.append(deterministic(one, [a], {b: 0}))
        tail = Nfa()
        a, b = tail.rule(r.trigger or r.pattern.removesuffix("+"), r.any_case)
        back.append(deterministic(tail.reversed(), [b], {a: 0}))
        head = Nfa()
        heads.append(deterministic(head, [(p := head.rule(r.head, r.any_case))[0]], {p[1]: 0}) if r.head else None)
    return Scanner(rules, deterministic(nfa, starts, ends, anywhere=True), tuple(ahead), tuple(back), tuple(heads))


def reach(dfa: Dfa, data: bytes, at: int, stop: int, step: int = 1) -> int:
    """The farthest place, seen from at, at which the automaton accepts, or -1."""
    s, found = dfa.start, -1
    while at != stop:
        s = dfa.move[s + data[at if step > 0 else at - 1]]
        at += step
        if s >= dfa.first_accepting:
            found = at
        elif s == dfa.dead:
            break
    return found


def reach_once(dfa: Dfa, data: bytes, at: int, failed: list) -> int:
    """reach() onwards. failed: where the last run that failed began, and its states place by place; a run that comes to
    the state of that one at the same place ends as it did, so a long stretch without a match is walked once, not from
    every trigger in it.
    """
    s, found, first, states = dfa.start, -1, at, []
    begin, known = failed
    while at < len(data):
        s = dfa.move[s + data[at]]
        at += 1
        if s >= dfa.first_accepting:
            found = at
        elif s == dfa.dead:
            break
        elif found < 0 and begin < at <= begin + len(known) and known[at - begin - 1] == s:
            if first - begin > len(known) // 2:  # what lies before this run is needed no more
                failed[:] = [first, states + known[at - begin - 1 :]]
            return -1
        states.append(s)
    if found < 0:
        failed[:] = [first, states]
    return found


def scan(data: bytes, x: Scanner) -> list[tuple[int, int, int]]:
    """Spans (start, rule, end) in bytes, in order."""
    move, first, s, out = x.all.move, x.all.first_accepting, x.all.start, []
    past = [0] * len(x.rules)
    failed: list[list] = [[0, []] for _ in x.rules]
    for i, c in enumerate(data):
        s = move[s + c]
        if s >= first:
            for k in x.all.accepts[s >> 8]:
                if i < past[k] or (start := reach(x.back[k], data, i + 1, past[k], -1)) < 0:
                    continue
                if (end := reach_once(x.ahead[k], data, start, failed[k])) < 0:
                    continue
                past[k] = end
                secret = reach(x.heads[k], data, start, end) if x.heads[k] else start
                if end - secret >= x.rules[k].least:
                    out.append((start, k, end))
    return sorted(out)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans: array<struct<kind, start, end>> by start, then by the order of the rules."""

    held = docs.sparkSession.sparkContext.broadcast(compiled(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = held.value
        for batch in batches:
            spans: list[list[dict]] = []
            for _, data, off in slices(batch.column(1)):
                for a, b in zip(off[:-1], off[1:], strict=True):
                    got = scan(data[a:b].tobytes(), x)
                    if got:
                        point = np.append(0, np.cumsum((data[a:b] & 0xC0) != 0x80))
                        got = [{"kind": rules[k].kind, "start": int(point[i]), "end": int(point[j])} for i, k, j in got]
                    spans.append(got)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, rows.select("doc_id").schema.add("spans", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, a count for each base kind, base_sha256 and spans as text."""

    def text(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind))

    base = [r.kind for r in rules if r.base]
    return found.select(
        "doc_id",
        *[count(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(text(F.filter("spans", lambda x: x["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


__all__ = ["RULES", "Rule", "compiled", "digest", "find_secrets", "scan"]
