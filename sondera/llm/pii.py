"""Personal data by base patterns and bootstrapped contextual extraction.

One pass over the texts finds the base spans, every other token that could be an
identifier (it has a digit or @ and MIN_LENGTH characters or more) and every run of such
tokens with single spaces between them, each with the words around it. A lexical pattern
is two words before the instance, or its coarse class with one word before or after it,
so instances of any shape meet the seeds' patterns. Base spans are the seed instances. Spark then scores
the bipartite graph of patterns and instances in ROUNDS rounds: a pattern's confidence is
the mean score of its distinct instances, discounted for low support, and an instance's
score is the best confidence among its patterns. Instances that reach CONFIDENCE get
spans of the kind that leads their best pattern, the longest of those that overlap; base
spans stay as they are.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondera.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
CONFIDENCE = 0.8
#: Instances added to a pattern's support in the mean: below 8 unanimous seeds no pattern reaches CONFIDENCE.
SMOOTHING = 2.0
MIN_LENGTH = 6
_EDGE = ".,;:!?\"'()[]{}<>|=#*$%&"

# Fixed patterns of the base kinds.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile("[0-9@]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")


def emails(text: str) -> list[tuple[int, int]]:
    """The email pattern's matches, found from each @ outwards."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        x = int(d) * (1 + n % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join([c for c in text if c in _DIGITS])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of each base span, by kind, then start."""
    out = [(0, *x) for x in emails(text)]
    if not _SIGN.search(text):
        return out
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _only_digits(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_only_digits(m[0])) <= 15]
    return out


def coarse(value: str) -> str:
    """The class of a value: it has an @, it has letters and digits, or it has no letters."""
    return "@" if "@" in value else "a" if any(map(str.isalpha, value)) else "9"


def _context(text: str, start: int, end: int) -> tuple[str, str, str]:
    before, at = [], start  # whole words, however long
    while len(before) < 2 and at > 0:
        last = at
        while last > 0 and text[last - 1].isspace():
            last -= 1
        at = last
        while at > 0 and not text[at - 1].isspace():
            at -= 1
        if at < last:
            before.insert(0, text[at:last])
    first = end
    while first < len(text) and text[first].isspace():
        first += 1
    stop = first
    while stop < len(text) and not text[stop].isspace():
        stop += 1
    after = [text[first:stop]] if first < stop else []
    clean = lambda w: w.strip(_EDGE).lower()
    two = " ".join(map(clean, before)) if len(before) == 2 else ""
    return two, clean(before[-1]) if before else "", clean(after[0]) if after else ""


def instances(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """(start, end, value, kind number or -1, patterns) of base spans and of all other possible identifiers."""
    taken = sorted((s, e) for _, s, e in base)
    spots = [(s, e, k) for k, s, e in base]
    run: tuple[int, int, int] | None = None  # start, end and tokens of the run so far
    end = n = 0

    def close():
        if run and run[2] > 1 and run[1] - run[0] >= MIN_LENGTH:
            spots.append((run[0], run[1], -1))

    for m in _SIGN.finditer(text):
        at = m.start()
        if at < end:
            continue
        while n < len(taken) and taken[n][1] <= at:
            n += 1
        if n < len(taken) and taken[n][0] <= at:
            end = taken[n][1]
            continue
        start, end = at, at + 1
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        first, last = start, end
        while first < last and text[first] in _EDGE:
            first += 1
        while last > first and text[last - 1] in _EDGE:
            last -= 1
        free = _SIGN.search(text, first, last) and not any(s < last and first < e for s, e in taken)
        if free and last - first >= MIN_LENGTH:
            spots.append((first, last, -1))
        first -= first > start and text[first - 1] == "("  # of a number's area code
        if free and run and run[1] == first - 1 and text[first - 1] == " ":
            run = run[0], last, run[2] + 1
        else:
            close()
            run = (first, last, 1) if free else None
    close()
    out = []
    for s, e, k in spots:
        value = text[s:e]
        form = coarse(value)
        out.append((s, e, value, k, [f"{n}\t{form if n else ''}\t{w}" for n, w in enumerate(_context(text, s, e)) if w]))
    return out


FOUND_SCHEMA = "doc_id long, base array<struct<kind:int,start:int,end:int>>, seen array<struct<start:int,end:int,value:string,kind:int,patterns:array<string>>>"


def found(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and instances of every row."""
    from sondera.llm.bpe import blocks

    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    one = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("kind", pa.int32()), ("patterns", pa.list_(pa.string()))])

    def run(batches):
        for b in blocks(batches):
            spans, seen = [], []
            for text in b.column(1).to_pylist():
                own = base_spans(text) if text and _SIGN.search(text) else []
                spans.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in own])
                every = instances(text, own) if text and _SIGN.search(text) else []
                seen.append([dict(zip(("start", "end", "value", "kind", "patterns"), x, strict=True)) for x in every])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(span)), pa.array(seen, pa.list_(one))], names=["doc_id", "base", "seen"])

    return docs.select("doc_id", "text").mapInArrow(run, FOUND_SCHEMA)


def bootstrap(seen: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE) -> DataFrame:
    """value and kind of the instances discovered from ``seen`` (value, kind, patterns), without the seeds.

    Edges are distinct (pattern, value) pairs, pre-aggregated where they are made; joins
    on patterns are plain shuffles, which adaptive execution splits for hot patterns.
    """
    edges = staged(
        seen.select("value", "kind", F.explode("patterns").alias("pattern")).groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "edges"
    )
    scores = edges.filter("kind >= 0").groupBy("value").agg(F.max("kind").alias("kind"), F.lit(1.0).alias("score"), F.lit(True).alias("seed"))
    for _ in range(rounds):
        scored = edges.select("pattern", "value").join(scores, "value", "left")
        by_kind = [F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(f"k{k}") for k in range(len(KINDS))]
        patterns = scored.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *by_kind)
        best = F.greatest(*[F.col(f"k{k}") for k in range(len(KINDS))])
        kind = F.coalesce(*[F.when(F.col(f"k{k}") == best, F.lit(k)) for k in range(len(KINDS))])
        patterns = patterns.select("pattern", (best / (F.col("n") + SMOOTHING)).alias("confidence"), kind.alias("led")).filter(F.col("confidence") >= confidence)
        reached = edges.select("pattern", "value").join(patterns, "pattern").groupBy("value")
        reached = reached.agg(F.max(F.struct("confidence", -F.col("led"))).alias("top")).select("value", (-F.col("top.col2")).alias("kind"), F.col("top.confidence").alias("score"), F.lit(False).alias("seed"))
        seeds = scores.filter("seed")
        scores = staged(seeds.unionByName(reached.join(seeds.select("value"), "value", "left_anti")), "scores")
    return scores.filter("not seed").select("value", "kind")


def extract(docs: DataFrame) -> DataFrame:
    """doc_id with its base spans and all spans, both by kind, then start, one row per row of ``docs``.

    Null and empty texts have no spans. Rows with equal doc_ids stay apart. Extra columns
    are ignored; an empty table gives an empty result. Without seeds nothing is added.
    """
    all_rows = staged(found(docs).withColumn("row", F.monotonically_increasing_id()), "pii")
    seen = all_rows.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    extra = bootstrap(seen)
    spans = seen.filter("kind < 0").drop("kind").join(extra, "value").groupBy("row")
    spans = spans.agg(F.collect_list(F.struct(F.col("kind").cast("int").alias("kind"), "start", "end")).alias("added"))  # of one document
    inside = lambda s, o: (o["start"] <= s["start"]) & (s["end"] <= o["end"]) & (o["end"] - o["start"] > s["end"] - s["start"])
    spans = spans.withColumn("added", F.filter("added", lambda s: ~F.exists("added", lambda o: inside(s, o))))
    both = all_rows.select("row", "doc_id", "base").join(spans, "row", "left")
    every = F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>")))
    return both.select("doc_id", F.sort_array("base").alias("base"), F.sort_array(every).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
