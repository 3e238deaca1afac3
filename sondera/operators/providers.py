"""Model-backed operators with pluggable providers.

A provider takes a text and returns a value or raises. Providers run once per partition
with their own retry policy and circuit breaker, so a breaker opens per task, not for the
whole cluster. A failure becomes a status, never the end of the run.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondera.functions.text import SPACE, strip

# Openings that mark a question, and limits of the retry policy.
OPENINGS = "介绍一下|讲一下|说说|为什么|怎么|如何"
PROMPT_VERSION = "v1.0"
PARSE_ATTEMPTS, BREAKER_REFUSALS = 3, 20
SPLIT_DEPTH, SPLIT_LEAST = 2, 1200
LOOK_CHARS, FALLBACK_QUESTIONS = 20, 50


class Refused(Exception):
    """The provider rejects the request itself (bad request); a retry would not help."""


class Provider(Protocol):
    name: str

    def __call__(self, text: str) -> list[str]: ...


class RuleExtractor:
    """Lines and sentences that look like questions: a question mark at the end, a known opening, or an item number."""

    name = "rule"
    _piece = re.compile(r"[^\n?？]+[?？]?")
    _mark = re.compile(rf"^\s*(?:\d+[.、）)]\s*|[-*]\s*)?(?:.*[?？]$|(?:{OPENINGS}))|^\s*\d+[.、）)]\s*\S")

    def __call__(self, text: str) -> list[str]:
        return [p.strip() for p in self._piece.findall(text) if self._mark.match(p.strip())]


class CueExtractor:
    """For the coverage pass: lines that hold one of ``cues`` and are not known yet."""

    name = "cue"

    def __init__(self, cues: tuple[str, ...] = tuple(OPENINGS.split("|"))):
        self.cues = cues

    def __call__(self, text: str, known: list[str]) -> list[str]:
        lines = dict.fromkeys(x.strip() for x in text.split("\n") if any(c in x for c in self.cues))
        return [x for x in lines if x and x not in known]


class Resilient:
    """Primary and fallback with attempts and waits, and a breaker that opens after consecutive refusals of the primary."""

    def __init__(self, primary: Provider, fallback: Provider | None = None, attempts: int = PARSE_ATTEMPTS, refusals: int = BREAKER_REFUSALS, delay: float = 0.0):
        self.primary, self.fallback, self.attempts, self.most, self.delay = primary, fallback, attempts, refusals, delay
        self.refusals = 0
        self.calls = self.fallback_calls = 0

    @property
    def open(self) -> bool:
        return self.refusals >= self.most

    def __call__(self, *asked) -> tuple[list[str], str, str]:
        """Values, provider name and status. The n-th repeated attempt waits n times the delay."""
        problem = "skipped"
        for n in range(0 if self.open else self.attempts):
            if n and self.delay:
                time.sleep(n * self.delay)
            self.calls += 1
            try:
                out = self.primary(*asked)
            except Refused:
                self.refusals += 1
                problem = "refused"
                break
            except Exception as e:
                problem = type(e).__name__
                continue
            self.refusals = 0
            return out, self.primary.name, "ok"
        if self.fallback is not None:
            self.fallback_calls += 1
            try:
                return self.fallback(*asked), self.fallback.name, "fallback"
            except Exception as e:
                problem = type(e).__name__
        return [], "", problem


def cut(text: str) -> list[str]:
    """Two halves of a text at its middle paragraph, newline or character; one part if it cannot be divided."""
    parts = [p for p in map(str.strip, text.split("\n\n")) if p]
    if len(parts) > 1:
        both = ["\n\n".join(parts[: len(parts) // 2]), "\n\n".join(parts[len(parts) // 2 :])]
    else:
        mid = len(text) // 2
        line = text.rfind("\n", 0, mid)
        at = line if line > 0 else mid
        both = [text[:at].strip(), text[at:].strip()]
    return both if all(both) else [text]


def relevant_to(known: list[str], text: str) -> list[str]:
    """The kernel's form of ``relevant``."""
    return [q for q in known if q[:LOOK_CHARS] in text] or known[:FALLBACK_QUESTIONS]


def with_splits(call: Callable, text: str, depth: int = 0, most: int = SPLIT_DEPTH, known: list[str] | None = None) -> tuple[list[str], str, str]:
    """Call, and on failure call on halves; values found in parts are kept once each. ``known`` goes along, cut to each part."""
    values, name, status = call(text) if known is None else call(text, known)
    if status in ("ok", "fallback") or depth >= most or len(text) < SPLIT_LEAST or len(parts := cut(text)) < 2:
        return values, name, status
    found = [with_splits(call, p, depth + 1, most, None if known is None else relevant_to(known, p)) for p in parts]
    unique = dict.fromkeys(v for values, _, _ in found for v in values if v.strip())
    good = [x for x in found if x[2] in ("ok", "fallback")]
    return list(unique), good[0][1] if good else "", "split" if good else status


def run_provider(rows: DataFrame, key: str, text: str, make: Callable[[], Resilient], splits: int = SPLIT_DEPTH, known: str | None = None) -> DataFrame:
    """key, values, model, status of every row. known: a column of questions that the provider is told of."""
    kind = dict(rows.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for b in batches:
            told = [None] * b.num_rows if known is None else [x or [] for x in b.column(2).to_pylist()]
            out = [with_splits(call, t or "", most=splits, known=k) for t, k in zip(b.column(1).to_pylist(), told, strict=True)]
            values, names, statuses = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values, pa.list_(pa.string())), pa.array(names, pa.string()), pa.array(statuses, pa.string())], names=[key, "values", "model", "status"])

    return rows.select(key, text, *([known] if known else [])).mapInArrow(run, f"{key} {kind}, values array<string>, model string, status string")


def judge_pairs(pairs: DataFrame, make: Callable[[], Callable[[str, str], tuple[bool, float, str | None]]]) -> DataFrame:
    """a, b, source, duplicate, confidence, hint of pairs (a, b, source, text_a, text_b) by a provider; a failure leaves them null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = make()

        def ask(x: str | None, y: str | None) -> tuple:
            try:
                return judge(x or "", y or "")
            except Exception:
                return None, None, None

        for b in batches:
            out = [ask(x, y) for x, y in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            found = list(zip(*out, strict=True)) or [(), (), ()]
            columns = [pa.array(c, t) for c, t in zip(found, (pa.bool_(), pa.float64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *columns], names=["a", "b", "source", "duplicate", "confidence", "hint"])

    return pairs.select("a", "b", "source", "text_a", "text_b").mapInArrow(run, "a long, b long, source string, duplicate boolean, confidence double, hint string")


def classify_with(rows: DataFrame, make: Callable[[], Callable[[str], tuple[str, list[str]]]], key: str, text: str) -> DataFrame:
    """key, primary_tag, secondary_tags by a provider; a failure is uncertain."""
    kind = dict(rows.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()

        def ask(t: str | None) -> tuple[str, list[str]]:
            try:
                return call(t or "")
            except Exception:
                return "uncertain", []

        for b in batches:
            out = [ask(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.list_(pa.string()))], names=[key, "primary_tag", "secondary_tags"])

    return rows.select(key, text).mapInArrow(run, f"{key} {kind}, primary_tag string, secondary_tags array<string>")


def embedded(rows: DataFrame, make: Callable[[], Callable[[list[str]], list[list[float]]]], key: str, text: str) -> DataFrame:
    """id and vector of each row by a provider that takes a batch of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make()
        for b in batches:
            found = [list(map(float, v)) for v in encode([t or "" for t in b.column(1).to_pylist()])] if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.float64()))], names=["id", "vector"])

    return rows.select(F.col(key).cast("long").alias("id"), text).mapInArrow(run, "id long, vector array<double>")


def looks_like_question(c: Column) -> Column:
    """The rule of RuleExtractor for one line, inside the JVM."""
    s = strip(c)
    return s.rlike("[?？]$") | s.rlike(f"^({OPENINGS})") | s.rlike(rf"^\p{{Nd}}+[.、）)]{SPACE}*[^\s]")


def atomic(found: DataFrame, extract_pass: str, kinds: Column | None = None) -> DataFrame:
    """One row per extracted question of (record_id, chunk_id, values, model), with its place if there is a chunk_text."""
    text = F.col("chunk_text") if "chunk_text" in found.columns else F.lit(None).cast("string")
    q = found.select("record_id", "chunk_id", "model", text.alias("chunk_text"), F.posexplode("values").alias("pos", "question_text_raw"))
    kind = F.lit("main") if kinds is None else F.when(kinds == "followup", "followup").otherwise("main")
    at = F.expr("locate(question_text_raw, chunk_text)")
    start = F.when(at > 0, at - 1)
    return q.select(
        "record_id", "chunk_id", "pos", "question_text_raw", kind.alias("question_type"), F.lit(None).cast("string").alias("round_hint"), F.array().cast("array<string>").alias("topic_hint"),
        F.when(at > 0, F.col("question_text_raw")).alias("evidence_text"), start.alias("char_start"), (start + F.length("question_text_raw")).alias("char_end"),
        F.lit(extract_pass).alias("extract_pass"), F.col("model").alias("llm_model"), F.lit(PROMPT_VERSION).alias("prompt_version"),
    )


def coverage_input(chunks: DataFrame, first: DataFrame) -> DataFrame:
    """Chunks whose first pass found something, with the questions known from it; only these get a second pass."""
    known = first.groupBy("chunk_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "question_text_raw"))), lambda x: x["question_text_raw"]).alias("known"))
    return chunks.join(known, "chunk_id")  # the questions of one chunk


def relevant(extracted: Column, text: Column) -> Column:
    """Questions whose first 20 characters occur in the text; if none does, the first 50 questions."""
    inside = F.filter(extracted, lambda q: F.contains(text, F.substring(q, 1, LOOK_CHARS)))
    return F.when(F.size(inside) > 0, inside).otherwise(F.slice(extracted, 1, FALLBACK_QUESTIONS))


def classify_keywords(rows: DataFrame, keywords: DataFrame, key: str, text: str) -> DataFrame:
    """key, primary_tag, secondary_tags by how many distinct keywords of each category occur, ignoring case; none: uncertain.

    keywords: category, keyword; a dimension of some hundreds of rows, so it is folded
    into one conditional count per category and the texts are read once without a join.
    """
    groups: dict[str, list[str]] = {}
    for r in keywords.select("category", "keyword").distinct().orderBy("category", "keyword").collect():
        groups.setdefault(r.category, []).append(r.keyword.lower())
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = [F.struct((-sum(F.contains(low, F.lit(w)).cast("int") for w in words)).alias("n"), F.lit(c).alias("c")) for c, words in sorted(groups.items())]
    order = F.array_sort(F.filter(F.array(*hits), lambda x: x["n"] < 0)) if hits else F.array().cast("array<struct<n:int,c:string>>")
    names = F.transform(order, lambda x: x["c"])
    return rows.withColumn("_names", names).select(key, F.coalesce(F.get("_names", F.lit(0)), F.lit("uncertain")).alias("primary_tag"), F.slice("_names", 2, 3).alias("secondary_tags"))


# The fields of a model's answers and which of them must be there.
ANSWERS = {
    "extraction": ("questions array<struct<question_text:string,question_type:string,round_hint:string,topic_hint:array<string>,evidence_span:string,is_multi_part:boolean>>", {"questions": ("question_text", "evidence_span")}),
    "coverage": ("missed_questions array<struct<question_text:string,question_type:string,evidence_span:string,reason:string>>", {"missed_questions": ("question_text", "evidence_span", "reason")}),
    "judgement": ("is_duplicate boolean, confidence double, same_concept_reason string, difference_reason string, canonical_question string, knowledge_tags array<string>", ("is_duplicate", "confidence")),
    "classification": ("primary_tag string, secondary_tags array<string>, confidence double, reason string", ("primary_tag",)),
}


def missing_of(names: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda x: reduce(lambda a, b: a | b, [x[n].isNull() for n in names])


def validated(answer: Column, kind: str) -> Column:
    """The answer as a struct of its kind, or null if it is no such object, a value has another type, or a required field is missing."""
    schema, required = ANSWERS[kind]
    found = F.from_json(answer, f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    fine = found.isNotNull() & found["_bad"].isNull()
    if isinstance(required, dict):
        for field, names in required.items():
            whole = ~F.exists(found[field], missing_of(names))
            fine = fine & (found[field].isNull() | whole)
    else:
        for name in required:
            fine = fine & found[name].isNotNull()
    return F.when(fine, found.dropFields("_bad"))
