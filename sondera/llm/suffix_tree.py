"""A probabilistic suffix tree over words, trained on and scoring whole documents.

Words are counted over all training documents. A context is a candidate from a least
count on, its next symbols are kept from another one on. Both counts are a constant times
N**0.6 for N training tokens, at every size of the corpus, so the tree grows with the
corpus: contexts, edges and dictionary each with N**0.4 at most. That growth is what
lets the tree be broadcast: ten thousand times the corpus gives forty times the tree.

Contexts of d words are looked at if that of the d - 1 words before their last one and
that of their last d - 1 words are candidates, and if the latter has more than one next
symbol; below a context that always goes on alike nothing can diverge. A candidate is
retained if its next-symbol distribution diverges from that of its longest retained
suffix by more than it costs to store. Growth ends when no candidate is left, or at
MAX_DEPTH words, each of which costs a pass over the token numbers.

Smoothing is by absolute discounting: P(x | s) = (c(s, x) - DISCOUNT) / c(s) for kept
edges, plus the rest of the mass times P(x | longest retained suffix of s). The root has
word frequencies, less a Good-Turing share for words never seen, which are one symbol.

Texts are cut into words twice, for the counts and for the token numbers, which are
staged and which all later passes read. The dictionary holds the most frequent words. The
other words of a document, whose probability only the root can give, are counted by
document and joined with the vocabulary table; contexts that hold them do not exist.

Python workers stand beside a JVM that may fill its whole heap, so they hold little at
once: blocks of BLOCK_BYTES of a column, of the tree only what their stage reads, and as
long as that is broadcast. What they add up is shuffled as it is, in batches of
EMIT_ROWS; another map-side aggregate would find each key about once.
"""

from __future__ import annotations

import copy
import math
from collections import Counter
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondera.llm.common import byte_words, staged

#: A parameter of the model, not of the data; each further word costs a pass.
MAX_DEPTH = 4
#: Least counts are these times N**GROWTH, at least 2; the dictionary has up to WORDS times N**(1 - GROWTH) words.
GROWTH = 0.6
CONTEXT_COUNT = 1e-2
EDGE_COUNT = 5e-4
WORDS = 150
DISCOUNT = 0.75
#: Nats that an edge of a retained context must earn over the corpus.
EDGE_COST = 4.0
FLUSH = 1_000_000
#: Bytes of texts or token numbers (four each) that a worker looks at at once; a longer document is a block of its own.
BLOCK_BYTES = 1_000_000
EMIT_ROWS = 100_000


def held_out() -> Column:
    """Rows that are not learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """word (bytes) and c over all rows, added up per partition before the shuffle."""

    from sondera.llm.bpe import blocks

    def emit(counts: Counter):
        items = iter(counts.items())
        while part := list(islice(items, EMIT_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.binary()), pa.array([c for _, c in part], pa.int64())], names=["word", "c"])

    def run(batches):
        counts: Counter = Counter()
        for b in blocks(batches, "text", BLOCK_BYTES):
            for text in b.column(0).to_pylist():
                counts.update(byte_words(text))
            if len(counts) > FLUSH:
                yield from emit(counts)
                counts = Counter()
        yield from emit(counts)

    return docs.select("text").mapInArrow(run, "word binary, c long").repartition("word").groupBy("word").agg(F.sum("c").alias("c"))


class Tree:
    """The model as arrays: dictionary counts, and per depth contexts, their back-off mass and their edges."""

    def __init__(self, words: list[bytes], counts: np.ndarray, ends: int, total: int, distinct: int, singles: int):
        self.words, self.counts = words, counts
        self.n_words = len(words)
        self.ends, self.total, self.distinct = ends, total, distinct
        self.unseen = (singles + 1) / (total + 2)
        self.least_edge, self.least_context = (max(2.0, x * max(1, total) ** GROWTH) for x in (EDGE_COUNT, CONTEXT_COUNT))
        self.n_next = int((counts >= self.least_edge).sum())
        self.n_context = int((counts >= self.least_context).sum())
        self.contexts: list[np.ndarray] = []  # candidates of each depth as parent number * n_context + last word
        self.totals: list[np.ndarray] = []
        self.suffix: list[np.ndarray] = []  # of each candidate, that of one word less (-1: the root)
        self.retained: list[np.ndarray] = []
        self.divided: list[np.ndarray] = []  # whether a candidate has more than one next symbol
        self.mass: list[np.ndarray] = []
        self.edge_keys: list[np.ndarray] = []
        self.edge_values: list[np.ndarray] = []

    @property
    def symbols(self) -> int:
        return self.n_next + 1  # the frequent words and the end

    def root(self, symbol: np.ndarray) -> np.ndarray:
        """Probability of dictionary words, or of the end (number n_words), at the root."""
        counts = np.append(self.counts, self.ends)
        return (1.0 - self.unseen) * counts[symbol] / max(1, self.total)

    def states(self, ids: np.ndarray, first: np.ndarray, depth: int) -> list[np.ndarray]:
        """For each position, the number of the candidate context of 1 .. depth words before it, or -1. first: begins a document."""
        out = []
        last = np.concatenate([[-1], ids[:-1]])
        last[first] = -1
        last[(last < 0) | (last >= self.n_context)] = -1
        for d in range(depth):
            if d == 0:
                out.append(last.copy())
                continue
            parent = np.concatenate([[-1], out[-1][:-1]])
            parent[first] = -1
            out.append(np.where((parent >= 0) & (last >= 0), _find(self.contexts[d], parent * self.n_context + last), -1))
        return out

    def symbol(self, ids: np.ndarray) -> np.ndarray:
        """Next symbols: frequent words, the end (n_next), or -1."""
        return np.where(ids == self.n_words, self.n_next, np.where((ids >= 0) & (ids < self.n_next), ids, -1))

    def candidates(self) -> None:
        """Find the contexts of the next depth from the edges of the last."""
        d = len(self.contexts)
        if d == 0:
            self.contexts.append(np.arange(self.n_context))
            self.totals.append(self.counts[: self.n_context].astype(np.float64))
            self.suffix.append(np.full(self.n_context, -1))
            return
        context, symbol = self.raw_keys // self.symbols, self.raw_keys % self.symbols
        frequent = (symbol < self.n_context) & (self.raw_counts >= self.least_context)
        context, symbol, counts = context[frequent], symbol[frequent], self.raw_counts[frequent]
        if d == 1:
            suffix = symbol
        else:  # the suffix of (p, x) is (suffix of p, x)
            suffix = _find(self.contexts[d - 1], self.suffix[d - 1][context] * self.n_context + symbol)
        use = suffix >= 0
        use[use] = self.divided[d - 1][suffix[use]]
        self.contexts.append(context[use] * self.n_context + symbol[use])
        self.totals.append(counts[use].astype(np.float64))
        self.suffix.append(suffix[use])

    def learn(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Fit the candidates of the last depth to their edges (context number * symbols + next symbol, sorted)."""
        d = len(self.contexts) - 1
        self.raw_keys, self.raw_counts = keys, counts
        context, symbol = keys // self.symbols, keys % self.symbols
        size, total = len(self.contexts[d]), self.totals[d]
        as_id = np.where(symbol == self.n_next, self.n_words, symbol)
        shorter = self.probability(as_id, symbol, self._chain(d - 1, self.suffix[d][context]), d - 1)
        direct = counts / total[context]
        rest = np.maximum(1e-12, 1.0 - np.bincount(context, direct, size))
        rest_shorter = np.maximum(1e-12, 1.0 - np.bincount(context, shorter, size))
        divergence = np.bincount(context, direct * np.log(direct / np.maximum(shorter, 1e-300)), size) + rest * np.log(rest / rest_shorter)
        edges = np.bincount(context, minlength=size)
        self.divided.append(np.bincount(context, counts == total[context], size) == 0)
        self.retained.append((edges > 0) & (total * divergence > EDGE_COST * (edges + 1)))
        value = (counts - DISCOUNT) / total[context]
        mass = 1.0 - np.bincount(context, value, size)
        self.mass.append(np.where(self.retained[d], mass, 1.0))
        keep = self.retained[d][context]
        self.edge_keys.append(keys[keep])
        self.edge_values.append(value[keep])

    def _chain(self, depth: int, context: np.ndarray) -> list[np.ndarray]:
        """States of all lengths for contexts of ``depth`` + 1 words, through their suffixes."""
        out = []
        for d in range(depth, -1, -1):
            out.append(context)
            context = np.where(context >= 0, self.suffix[d][context], -1) if len(self.suffix[d]) else context
        return out[::-1]

    def probability(self, ids: np.ndarray, symbol: np.ndarray, states: list[np.ndarray], depth: int) -> np.ndarray:
        """P(token | longest retained states). ids of -1 (not in the dictionary) get the back-off mass alone."""
        p = np.where(ids >= 0, self.root(ids), 1.0)
        for d in range(depth + 1):
            state = states[d]
            has = np.flatnonzero(state >= 0)
            has = has[self.retained[d][state[has]]] if len(has) else has
            if not len(has):
                continue
            p[has] *= self.mass[d][state[has]]
            named = has[symbol[has] >= 0]
            edge = _find(self.edge_keys[d], state[named] * self.symbols + symbol[named])
            p[named[edge >= 0]] += self.edge_values[d][edge[edge >= 0]]
        return p


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted number in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _broadcast(spark: SparkSession, tree: Tree, *parts: str):
    """A broadcast of the tree's numbers and of those of its larger parts that the stage reads."""
    thin = copy.copy(tree)
    for name, value in vars(tree).items():
        if isinstance(value, (list, np.ndarray)) and name not in parts:
            setattr(thin, name, value[:0])
    return spark.sparkContext.broadcast(thin)


def _numbers(tree: Tree) -> dict[bytes, int]:
    """Numbers of the dictionary words, made once per worker and kept with the broadcast tree."""
    if not hasattr(tree, "number"):
        tree.number = {w: n for n, w in enumerate(tree.words)}
    return tree.number


NUMBERED_SCHEMA = "doc_id long, held_out boolean, ids binary, others array<struct<word:binary,tf:bigint>>"


def numbered(docs: DataFrame, tree: Tree) -> DataFrame:
    """doc_id, whether held out, the token numbers (packed 32-bit; -1: not in the dictionary; the end last) and the other words of every row."""
    from sondera.llm.bpe import blocks

    shared = _broadcast(docs.sparkSession, tree, "words")
    other = [pa.field("word", pa.binary()), pa.field("tf", pa.int64())]

    def run(batches):
        for b in blocks(batches, "text", BLOCK_BYTES):
            number, end = _numbers(shared.value), shared.value.n_words
            ids, words_of, tf, ends = [], [], [], [0]
            for text in b.column(2).to_pylist():
                words = byte_words(text)
                n = np.fromiter(chain(map(number.get, words, repeat(-1)), (end,)), np.int32, len(words) + 1)
                ids.append(n.tobytes())
                rare = Counter([words[i] for i in np.flatnonzero(n < 0).tolist()])
                words_of.extend(rare)
                tf.extend(rare.values())
                ends.append(len(tf))
            others = pa.StructArray.from_arrays([pa.array(words_of, pa.binary()), pa.array(tf, pa.int64())], fields=other)
            others = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), others)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary()), others], names=["doc_id", "held_out", "ids", "others"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, NUMBERED_SCHEMA)


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of all documents end to end, and where documents begin."""
    parts = [np.frombuffer(x, np.int32) for x in column.to_pylist()]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64), np.cumsum(lengths) - lengths


def edge_counts(rows: DataFrame, shared, depth: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The frequent edges of all candidates of ``depth`` words, sorted. rows: ids."""
    from sondera.llm.bpe import blocks

    def merged(keys: list, counts: list):
        k, c = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(k)
        k, c = k[order], c[order]
        first = np.flatnonzero(np.append(k[:1] >= 0, k[1:] != k[:-1]))
        return k[first], np.add.reduceat(c, first) if len(first) else c

    def emit(k: np.ndarray, c: np.ndarray):
        for at in range(0, len(k), EMIT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + EMIT_ROWS]) for x in (k, c)], names=["edge", "c"])

    def run(batches):
        keys, counts, held = [], [], 0  # the first of each: merged so far
        for b in blocks(batches, "ids", BLOCK_BYTES):
            tree = shared.value
            ids, first = _joined(b.column(0))
            state, symbol = tree.states(ids, first, depth)[-1], tree.symbol(ids)
            use = (state >= 0) & (symbol >= 0)
            k, c = np.unique(state[use] * tree.symbols + symbol[use], return_counts=True)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > FLUSH:
                k, c = merged(keys, counts)
                if len(k) > 2 * FLUSH:
                    yield from emit(k, c)
                    k, c = k[:0], c[:0]
                keys, counts, held = [k], [c], 0
        if keys:
            yield from emit(*merged(keys, counts))

    sums = rows.select("ids").mapInArrow(run, "edge long, c long").repartition("edge").groupBy("edge").agg(F.sum("c").alias("c"))
    found = sums.filter(F.col("c") >= least)
    table = found.toArrow()
    keys, counts = table.column("edge").to_numpy(), table.column("c").to_numpy()
    order = np.argsort(keys)
    return keys[order], counts[order]


def prepared(docs: DataFrame) -> tuple[Tree, DataFrame]:
    """The tree without contexts of all rows of ``docs``, and the staged vocabulary (word, c)."""
    vocabulary = staged(word_counts(docs), "vocabulary")
    ends = docs.count()
    level = F.floor(F.log2("c") * 8).cast("int")
    levels = vocabulary.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c"), F.min("c").alias("least"), F.sum((F.col("c") == 1).cast("long")).alias("single")).collect()  # 505 at most
    total = ends + sum(r.c for r in levels)
    distinct = sum(r.n for r in levels) + (ends > 0)
    cut, held = math.inf, 0
    for r in sorted(levels, key=lambda r: -r.level):
        held += r.n
        if held > WORDS * max(1, total) ** (1 - GROWTH):
            break
        cut = r.least
    top = vocabulary.filter(F.col("c") >= cut).toArrow() if cut < math.inf else vocabulary.limit(0).toArrow()
    words, counts = top.column("word").to_pylist(), top.column("c").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    return Tree([words[i] for i in order], counts[order].astype(np.int64) if order else np.zeros(0, np.int64), ends, total, distinct, sum(r.single for r in levels)), vocabulary


def grow(tree: Tree, rows: DataFrame, max_depth: int = MAX_DEPTH) -> Tree:
    """Add the contexts learned from staged token numbers (ids)."""
    for depth in range(1, max_depth + 1):
        tree.candidates()
        if not len(tree.contexts[-1]):
            for part in (tree.contexts, tree.totals, tree.suffix):
                part.pop()
            break
        shared = _broadcast(rows.sparkSession, tree, "contexts")
        tree.learn(*edge_counts(rows, shared, depth, tree.least_edge))
        shared.unpersist()
    return tree


def train(docs: DataFrame, max_depth: int = MAX_DEPTH) -> tuple[Tree, DataFrame]:
    """The tree learned from all rows of ``docs``, and the staged vocabulary (word, c)."""
    tree, vocabulary = prepared(docs)
    return grow(tree, staged(numbered(docs, tree), "numbered"), max_depth), vocabulary


def score(rows: DataFrame, tree: Tree, vocabulary: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of staged token numbers."""
    from sondera.llm.bpe import blocks

    shared = _broadcast(rows.sparkSession, tree, "counts", "contexts", "retained", "mass", "edge_keys", "edge_values")
    total, distinct = tree.total, tree.distinct

    def run(batches):
        names = ["row", "n_tokens", "n_known", "base_score", "score"]
        for b in blocks(batches, "ids", BLOCK_BYTES):
            tree = shared.value
            ids, first = _joined(b.column(1))
            known = ids >= 0
            counts = np.append(tree.counts, tree.ends)
            base = np.where(known, np.log10((counts[ids] + 1) / (total + distinct + 1)), 0.0)
            depth = len(tree.contexts)
            p = tree.probability(ids, tree.symbol(ids), tree.states(ids, first, depth), depth - 1)
            seen = known & (np.where(known, counts[ids], 0) > 0)
            p = np.where(known & ~seen, 1.0, p)  # without training rows the end has no probability of its own
            columns = [np.add.reduceat(x, first) if len(first) else x for x in (seen.astype(np.int64), base, np.log10(p))]
            lengths = np.diff(np.append(first, len(ids)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lengths), *map(pa.array, columns)], names=names)

    numbers = rows.withColumn("row", F.monotonically_increasing_id())
    scored = numbers.select("row", "ids").mapInArrow(run, "row long, n_tokens long, n_known long, base_score double, score double")
    rare = numbers.select("row", F.explode("others").alias("o")).select("row", "o.*").join(vocabulary, "word", "left")
    c = F.coalesce("c", F.lit(0))
    root = F.when(F.col("c").isNotNull(), c * (1.0 - tree.unseen) / max(1, total)).otherwise(F.lit(tree.unseen))
    sums = rare.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("k"),
        F.sum(F.col("tf") * F.log10((c + 1) / F.lit(float(total + distinct + 1)))).alias("b"),
        F.sum(F.col("tf") * F.log10(root)).alias("s"),
    )
    add = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return numbers.select("row", "doc_id", "held_out").join(scored, "row").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", add("n_known", "k"), F.lit(total).cast("long").alias("train_tokens"), add("base_score", "b"), add("score", "s")
    )


def train_and_score(docs: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Score every row of ``docs`` after learning from those that are not held out.

    Null and empty texts are one end token. A null doc_id is learned from and scored.
    Repeated rows count as often as they occur. Extra columns are ignored. Without
    training rows every token has probability 1 at the root but the same base formula
    holds; an empty table gives an empty result.
    """
    tree, vocabulary = prepared(docs.filter(~held_out()))
    rows = staged(numbered(docs, tree), "numbered")
    return score(rows, grow(tree, rows.filter("not held_out"), max_depth), vocabulary)
