"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Document statistics (no label, language, source or id among them) are standardised and
mapped to FEATURES random Fourier features, cos(w.x + b), which approximate a Gaussian
kernel. Partitions sum their parts of the normal equations; the sums of all partitions
are added in Spark by matrix cell. The ridge solution scores documents, and pooled
adjacent violators turn scores into calibrated probabilities, fitted on a histogram.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondera.llm.common import small, staged

#: Random Fourier features, beside a constant.
FEATURES = 128
#: Width of the Gaussian kernel, in standard deviations of the statistics.
WIDTH = 4.0
RIDGE = 1e-3
BINS = 1000
#: Labels of either kind that the calibrated score is shrunk towards one half with.
PRIOR = 0.5
SEED = 20240501
ACCEPT = 0.7

STATISTICS = (
    "log_words", "mean_word", "symbols_per_word", "upper_share", "digit_share", "punctuation_share", "exclamations_per_word",
    "distinct_share", "top_word_share", "repeated_bigrams", "repeated_trigrams", "dup_line_share", "words_per_line", "non_ascii_share", "one_char_share",
)
VECTORS_SCHEMA = "doc_id long, x array<double>"

_SYMBOL = re.compile(r"[#*$%&|<>]")
_PUNCTUATION = str.maketrans("", "", ".,;:!?\"'()-")
_UPPER = re.compile("[A-ZÀ-ÖØ-Þ]")


def statistics(text: str | None) -> list[float]:
    """STATISTICS of a whole text; an empty one has zeros only."""
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = Counter(words)
    pairs = list(zip(words, words[1:]))
    triples = list(zip(pairs, words[2:]))
    lines = [x for x in text.split("\n") if x.strip()]
    share = lambda xs: 1.0 - len(set(xs)) / len(xs) if xs else 0.0
    return [
        float(np.log1p(n)),
        min(40.0, sum(map(len, words)) / n),
        min(5.0, len(_SYMBOL.findall(text)) / n),
        len(_UPPER.findall(text)) / chars,
        sum(map(text.count, "0123456789")) / chars,
        (chars - len(text.translate(_PUNCTUATION))) / chars,
        min(5.0, text.count("!") / n),
        len(counts) / n,
        max(counts.values()) / n,
        share(pairs),
        share(triples),
        share(lines),
        min(200.0, n / max(1, len(lines))) / 10,
        1.0 - len(text.encode("ascii", "ignore")) / chars,
        sum(1 for w in words if len(w) == 1) / n,
    ]


def vectors(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row."""
    from sondera.llm.bpe import blocks

    def run(batches):
        for b in blocks(batches):
            x = [statistics(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, VECTORS_SCHEMA)


def held_out() -> Column:
    """Rows whose labels are never learned."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


class Model:
    """What scoring needs; a few kilobytes."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        draw = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.w = draw.normal(0.0, 1.0 / WIDTH, (len(STATISTICS), FEATURES))
        self.b = draw.uniform(0.0, 2 * np.pi, FEATURES)
        self.beta = np.zeros(FEATURES + 1)
        self.edges, self.values = np.zeros(1), np.full(1, 0.5)

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8.0, 8.0)
        return np.hstack([np.cos(z @ self.w + self.b) * np.sqrt(2.0 / FEATURES), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.edges, self.values) if len(x) else np.zeros(0)


def _cells(rows: DataFrame, part, size: int) -> np.ndarray:
    """Sum over all partitions of the vector that ``part(x, y)`` gives for a block, added by cell in Spark."""

    def run(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                x = np.array(b.column(0).to_pylist(), np.float64)
                total += part(x, np.array(b.column(1).to_pylist(), np.float64))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total), pa.int32()), pa.array(total[total != 0])], names=["cell", "v"])

    out = np.zeros(size)
    for cell, v in rows.select("x", "y").mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v")).collect():  # ``size`` rows at most
        out[cell] = v
    return out


def isotonic(scores: np.ndarray, ones: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-decreasing shares of ones by pooled adjacent violators; ``scores`` rise, each standing for ``counts`` rows."""
    blocks: list[list[float]] = []
    for o, n in zip(ones.tolist(), counts.tolist(), strict=True):
        blocks.append([o, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            o2, n2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + o2, blocks[-1][1] + n2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), (o + PRIOR) / (n + 2 * PRIOR)) for o, n, k in blocks]) if blocks else np.zeros(0)


def fit(found: DataFrame, labels: DataFrame) -> Model:
    """Learn from the rows of ``found`` (doc_id, x) that have a label 0 or 1 and are not held out.

    A document with several labels counts once for each. Without labels of both kinds
    every score is their share, or 0.5 if there are none.
    """
    wanted = labels.select("doc_id", F.col("quality").cast("double").alias("y")).filter("y in (0.0, 1.0)").filter(~held_out())
    rows = staged(found.join(wanted, "doc_id").select("x", "y"), "labelled")
    p, d = len(STATISTICS), FEATURES + 1
    first = _cells(rows, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(0), (x * x).sum(0)]), 2 + 2 * p)
    n, ones = first[0], first[1]
    if not n or ones in (0, n):
        model = Model(np.zeros(p), np.ones(p))
        model.values = np.full(1, (ones + PRIOR) / (n + 2 * PRIOR))
        return model
    mean = first[2 : 2 + p] / n
    deviation = np.sqrt(np.maximum(0.0, first[2 + p :] / n - mean**2))
    model = Model(mean, np.where(deviation > 1e-9, deviation, 1.0))
    # Both labels weigh alike in the ridge; the calibration brings the shares back.
    weight = np.array([n / (2 * (n - ones)), n / (2 * ones)])

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        f = model.features(x)
        w = weight[y.astype(int)][:, None]
        return np.concatenate([(f.T @ (f * w)).ravel(), ((f * w).T @ y[:, None]).ravel()])

    sums = _cells(rows, normal, d * d + d)
    model.beta = np.linalg.solve(sums[: d * d].reshape(d, d) + RIDGE * n * np.eye(d) / d, sums[d * d :])
    histogram = _cells(rows, lambda x, y: np.concatenate([np.bincount(_bin(model.raw(x)), y == k, BINS) for k in (0, 1)]), 2 * BINS).reshape(2, BINS)
    used = np.flatnonzero(histogram.sum(0))
    model.edges = used / BINS * 3.0 - 1.0
    model.values = isotonic(model.edges, histogram[1][used], histogram.sum(0)[used])
    return model


def _bin(raw: np.ndarray) -> np.ndarray:
    """Histogram bins of width 3 / BINS over -1 to 2."""
    return np.clip((raw + 1.0) / 3.0 * BINS, 0, BINS - 1).astype(int)


def apply(found: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``found``."""

    def run(batches):
        for b in batches:
            x = np.array(b.column(1).to_pylist(), np.float64).reshape(b.num_rows, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    scored = found.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A score for every row of ``docs``, whether labelled or not.

    Null and empty texts have zero statistics and score as such. Equal texts score
    alike. Extra columns are ignored; an empty table gives an empty result. The seed is
    a parameter of the model, so results repeat.
    """
    found = staged(vectors(docs), "statistics")
    return apply(found, fit(found, labels))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted 1, with their columns. Statistics are taken once for the labelled and once for all."""
    wanted = small(staged(labels.select("doc_id").filter(~held_out()).distinct(), "wanted"))
    model = fit(staged(vectors(docs.join(wanted, "doc_id", "left_semi")), "statistics"), labels)
    names, own = list(docs.columns), docs.schema
    at = names.index("text")

    def run(batches):
        for b in batches:
            x = np.array([statistics(t) for t in b.column(at).to_pylist()], np.float64).reshape(b.num_rows, len(STATISTICS))
            yield b.filter(pa.array(model.score(x) >= ACCEPT))

    return docs.mapInArrow(run, own)
