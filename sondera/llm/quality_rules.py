"""Quality rules with adaptive thresholds, in DataFrame functions only.

Every document gets word, symbol, line and repetition counts. The rates built from them
are gathered in KLL quantile sketches per language and source, and merged upwards to
languages and to the whole corpus. Of each rate two quantiles count, the median and a
high one (RULES). A group's quantiles are shrunk towards those of its language, and the
language's towards the corpus, as if SHRINK documents of the wider group belonged to it;
so a group of any size has thresholds of its own and none is switched off. A rate is
rejected beyond the high quantile by FENCE times its distance from the median, or beyond
the median by the rate's least step, whichever is more; the step matters only where a
group's documents are all but equal. Sketches merge in any order, so partial aggregation
does the work and a hot source needs no salting; thresholds, one row a group, are joined
back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondera.llm.common import SPACE_CHARS, WORD_SEPARATOR, small, staged

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Documents of the wider group that count in a group's quantiles.
SHRINK = 500
FENCE = 4.0
#: Sketch size parameter: ranks within 1.3 % at 99 % confidence.
SKETCH_K = 200
#: Of each rate the rank of its high quantile, and the least step from the median to its threshold.
RULES = {"symbol_rate": (0.75, 0.1), "dup_line_rate": (0.98, 0.2), "repeat_rate": (0.98, 0.2), "long_word_rate": (0.9, 1.0)}
GROUP = ["lang", "source"]


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SEPARATOR, -1), lambda w: w != "")


def repeated_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Window hashes are paired with their position and sorted, so equal windows stand side
    by side; a text whose windows all differ skips the sort.
    """
    n = F.size(w)
    starts = F.sequence(F.lit(1), n - 2)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))
    return F.when(n < 4, F.lit(0)).when(F.size(F.array_distinct(hashes)) == n - 2, F.lit(0)).otherwise(_covered(hashes, n))


def _covered(hashes: Column, n: Column) -> Column:
    keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # One pass over the sorted windows keeps the previous one and collects positions of equal neighbours.
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(keyed, 1, n - 3))
    pairs = F.filter(F.arrays_zip(keyed.alias("a"), before.alias("b")), lambda p: p["a"]["h"] == p["b"]["h"])
    at = F.flatten(F.transform(pairs, lambda p: F.array(
        p["a"]["i"], p["a"]["i"] + 1, p["a"]["i"] + 2, p["b"]["i"], p["b"]["i"] + 1, p["b"]["i"] + 2)))
    return F.size(F.array_distinct(at))


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long); a null text has none of them."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    d = docs.withColumn("_words", words(F.col("text"))).withColumn("_lines", lines)
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.translate(text, SPACE_CHARS, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated_words(F.col("_words")),
        "_n_lines": F.size("_lines"),
    }
    return d.withColumns({k: v.cast("long") for k, v in counts.items()}).drop("_words", "_lines")


def with_rates(counted: DataFrame) -> DataFrame:
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return counted.withColumns({
        "symbol_rate": per("n_symbols", "n_words"),
        "dup_line_rate": per("n_dup_lines", "_n_lines"),
        "repeat_rate": per("n_repeat_words", "n_words"),
        "long_word_rate": per("word_chars", "n_words"),
    })


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def sketches(rated: DataFrame) -> DataFrame:
    """A sketch of each rate per language and source, over documents that pass the base rules."""
    sound = rated.filter(~base_failed())
    return sound.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(F.col(r).cast("double"), F.lit(SKETCH_K)).alias(r) for r in RULES]
    )


def _merged(s: DataFrame, by: list[str]) -> DataFrame:
    parts = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in RULES]]
    return s.groupBy(*by).agg(*parts) if by else s.agg(*parts)


def _quantiles(s: DataFrame, prefix: str) -> list[Column]:
    out = [F.col("n").alias(f"{prefix}_n")]
    for rate, (rank, _) in RULES.items():
        q = lambda x, r=rate: F.kll_sketch_get_quantile_double(r, F.lit(x))
        out += [q(0.5).alias(f"{prefix}_{rate}_mid"), q(rank).alias(f"{prefix}_{rate}_high")]
    return out


def thresholds(s: DataFrame) -> DataFrame:
    """_lang, _source and the highest accepted value of each rate, one row per group of the staged sketches ``s``."""
    s = s.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    own = s.select("_lang", "_source", *_quantiles(s, "own"))
    lang = _merged(s, ["_lang"])
    lang = lang.select(F.col("_lang").alias("_lang2"), *_quantiles(lang, "lang"))
    corpus = _merged(s, []).filter("n is not null")
    corpus = corpus.select(*_quantiles(corpus, "corpus")).first()
    if corpus is None:
        return own.select("_lang", "_source", *[F.lit(None).cast("double").alias(f"max_{r}") for r in RULES])
    joined = own.join(lang, F.col("_lang").eqNullSafe(F.col("_lang2")), "left")
    shrunk = lambda prefix, c, wider: (F.col(f"{prefix}_n") * F.col(f"{prefix}_{c}") + SHRINK * wider) / (F.col(f"{prefix}_n") + SHRINK)
    limits = []
    for r, (_, step) in RULES.items():
        mid, high = (shrunk("own", f"{r}_{c}", shrunk("lang", f"{r}_{c}", F.lit(corpus[f"corpus_{r}_{c}"]))) for c in ("mid", "high"))
        limits.append(F.greatest(high + FENCE * (high - mid), mid + step).alias(f"max_{r}"))
    return joined.select("_lang", "_source", *limits)


def judged(rated: DataFrame, limits: DataFrame) -> DataFrame:
    """Add base_failed and kept. A group without thresholds (none of its documents passed the base rules) keeps by the base rules."""
    met = rated.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    within = F.lit(True)
    for r in RULES:
        within = within & F.coalesce(F.col(r) <= F.col(f"max_{r}"), F.lit(True))
    failed = base_failed()
    return met.withColumn("base_failed", failed).withColumn("kept", ~failed & within)


def rules(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed and kept, one row per row of ``docs``.

    Null and empty texts have no words and fail the base rules. Null languages and
    sources form groups of their own. Equal rows get equal verdicts. Extra columns are
    ignored; an empty table gives an empty result.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    plain = docs.select("doc_id", "text", *GROUP)
    rated = with_rates(staged(with_counts(plain).select("doc_id", *GROUP, *counts, "_n_lines"), "counts"))
    limits = small(staged(thresholds(staged(sketches(rated), "sketches")), "thresholds"))
    return judged(rated, limits).select("doc_id", *counts, "base_failed", "kept")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns only.

    Texts are counted once and staged with their counts; thresholds and verdicts read those.
    """
    own = docs.columns
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_n_lines"]
    clash = {c: f"_own_{n}" for n, c in enumerate(own) if c not in ("text", *GROUP)}
    names = docs.withColumnsRenamed(clash)
    counted = staged(with_counts(names).select(*names.columns, *counts), "counted")
    limits = small(staged(thresholds(staged(sketches(with_rates(counted.select(*GROUP, *counts))), "sketches")), "thresholds"))
    kept = judged(with_rates(counted), limits).filter("kept")
    return kept.select(*[F.col(clash.get(c, c)).alias(c) for c in own])
