"""Secret scans by character Markov models, in DataFrame functions only.

Three base patterns give spans. Further spans come from tokens of MIN_TOKEN characters
and more, whatever characters they hold: two first-order character Markov models, one of
random strings and one of ordinary identifiers, score each token, and a log-likelihood
ratio per character above the threshold marks it. Both are trained on labelled samples.
Random: the values inside base spans, and DRAWN digests written in the usual alphabets
(hexadecimal, base 64, base 36), so that keys of any alphabet are known, not only those
that the corpus has in base spans. Ordinary: the words of all documents with a span, as
they stand, in capitals and joined to names, their identifiers outside of base spans, and
as many decimal numbers and dates as there are digests. The threshold is MIN_RATIO, or what
all but ORDINARY_SHARE of the distinct long ordinary samples stay below, if that is higher.

Texts are searched for base spans once and staged with them; training reads the staged
documents that have spans, and scoring reads all of them.
"""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondera.llm.common import staged

# Fixed patterns; the letters of assign count in either case.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "(AKIA[A-Z0-9]+)"
HEX = "([0-9a-f]+)"
KINDS = {"assign": (ASSIGN, 6), "access": (ACCESS, 20), "hex": (HEX, 24)}

MIN_TOKEN = 16
MIN_RATIO = 0.5
#: Digests of which random samples are written; a parameter of the model, at every size of input.
DRAWN = 4096
#: Share of long ordinary samples that may exceed the threshold.
ORDINARY_SHARE = 0.001
#: The ASCII characters and one symbol for all others.
SYMBOLS = 129
TOKEN = r"([A-Za-z0-9+/_=-]+)"
#: Identifiers that are not words alone: with a digit or a mark.
IDENTIFIER = r"([A-Za-z_]*[0-9+/=-][A-Za-z0-9+/_=-]*)"
SPAN = "array<struct<start:int,order:int,end:int,kind:string,value:string>>"


def spans(text: Column, pattern: str, least: int, order: int, kind: str) -> Column:
    """Leftmost non-overlapping matches whose first group has ``least`` characters, as structs.

    The stretches between matches and the matches themselves alternate, so their running
    lengths are the offsets.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), 0)
    value = F.regexp_extract_all(text, F.lit(pattern), 1)
    between = F.split(text, pattern, -1)
    steps = F.arrays_zip(whole.alias("m"), value.alias("v"), between.alias("b"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["b"])
        end = begin + F.length(x["m"])
        span = F.struct(begin.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(kind).alias("kind"), x["v"].alias("value"))
        out = F.when(F.length(x["v"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(F.coalesce(end, begin).alias("at"), out.alias("out"))

    found = F.aggregate(F.filter(steps, lambda x: x["m"].isNotNull()), start, step, lambda acc: acc["out"])
    return F.when(text.rlike(_could(pattern, least)), found).otherwise(F.array().cast(SPAN))


def _could(pattern: str, least: int) -> str:
    """A pattern that every text with a span matches."""
    return pattern if pattern == ASSIGN else pattern.replace("+)", f"{{{least - (4 if pattern == ACCESS else 0)},}})")


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with _base: the spans of the three kinds by start, then kind as listed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = [spans(text, p, least, n, kind) for n, (kind, (p, least)) in enumerate(KINDS.items())]
    return docs.withColumn("_parts", F.array(*parts)).withColumn("_base", F.sort_array(F.flatten("_parts"), True)).drop("_parts")


def tokens(text: Column) -> Column:
    """Spans of long tokens."""
    return spans(F.coalesce(text, F.lit("")), TOKEN, MIN_TOKEN, len(KINDS), "random")


def transitions(value: Column) -> Column:
    """A number below SYMBOLS**2 for each pair of a character and its successor; all non-ASCII characters are one symbol."""
    code = lambda at: F.least(F.ascii(F.substring(value, at, F.lit(1))), F.lit(SYMBOLS - 1))
    pairs = F.transform(F.sequence(F.lit(1), F.length(value) - 1), lambda i: code(i) * SYMBOLS + code(i + 1))
    return F.when(F.length(value) > 1, pairs).otherwise(F.array().cast("array<int>"))


def drawn(spark: SparkSession, n: int = DRAWN) -> DataFrame:
    """value and r: ``n`` digests in each of three alphabets (1), and ``n`` numbers and dates (0)."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    plain = F.rtrim(F.base64(F.unhex(digest)), F.lit("="))
    short = F.concat(*[F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 36) for i in range(3)])
    number = F.conv(F.substring(digest, 1, 15), 16, 10)
    date = F.concat_ws("-", F.substring(number, 3, 4), F.substring(number, 7, 2), F.substring(number, 9, 2))
    pairs = [(F.substring(digest, 1, 40), 1), (plain, 1), (short, 1), (number, 0), (date, 0)]
    return spark.range(n).select(F.inline(F.array(*[F.struct(v.alias("value"), F.lit(r).alias("r")) for v, r in pairs])))


def samples(found: DataFrame) -> DataFrame:
    """value and r (1: random, 0: ordinary) from all rows of ``found`` (text and _base) that have a base span, and the drawn ones."""
    marked = found.filter(F.size("_base") > 0)
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, r"[^\p{L}_]+"), lambda w: F.length(w) > 3)
    named = F.filter(F.regexp_extract_all(text, F.lit(IDENTIFIER), 1), lambda w: F.length(w) > 3)
    # Stored, as expressions on arrays would split the text again for every element.
    cut = staged(marked.select(F.col("_base.value").alias("secret"), words.alias("words"), named.alias("named")), "words")
    outside = F.filter("named", lambda t: ~F.exists("secret", lambda v: F.contains(t, v) | F.contains(v, t)))
    joined = F.transform(F.sequence(F.lit(1), F.size("words"), F.lit(3)), lambda i: F.slice("words", i, 3))
    joined = F.when(F.size("words") > 0, joined).otherwise(F.array().cast("array<array<string>>"))
    each = lambda v, r: cut.select(F.explode(v).alias("value"), F.lit(r).alias("r"))
    threes = cut.select(F.explode(joined).alias("x"))
    parts = [
        each("secret", 1), each("words", 0), each(outside, 0), cut.select(F.explode("words").alias("w")).select(F.upper("w").alias("value"), F.lit(0).alias("r")),
        threes.select(F.array_join(F.transform("x", F.initcap), "").alias("value"), F.lit(0).alias("r")), threes.select(F.lower(F.array_join("x", "_")).alias("value"), F.lit(0).alias("r")),
        drawn(found.sparkSession),
    ]
    return reduce(lambda x, y: x.unionByName(y), parts)


class Model:
    """The log-likelihood ratio of each transition, random against ordinary, and the threshold; SYMBOLS**2 numbers."""

    def __init__(self, ratios: list[float], threshold: float = MIN_RATIO):
        self.ratios, self.threshold = ratios, threshold

    def ratio(self, value: Column) -> Column:
        """The mean ratio of a string's transitions; 0 below two characters."""
        ratios = F.from_json(F.lit(json.dumps(self.ratios)), "array<double>")  # folded into one constant
        total = F.aggregate(transitions(value), F.lit(0.0), lambda acc, t: acc + F.element_at(ratios, t + 1))
        return F.when(F.length(value) > 1, total / (F.length(value) - 1)).otherwise(0.0)


def train(found: DataFrame) -> Model:
    """Learn from all rows of ``found`` (text and _base), which is read more than once, so pass a staged table.

    Counts have one added per possible transition. Without ordinary samples nothing can
    be told apart and every ratio is 0.
    """
    known = staged(samples(found).groupBy("value", "r").agg(F.count(F.lit(1)).alias("n")), "samples")
    pairs = known.select("r", "n", F.explode(transitions(F.col("value"))).alias("t"))
    rows = pairs.groupBy("t").agg(F.sum(F.col("r") * F.col("n")).alias("random"), F.sum((1 - F.col("r")) * F.col("n")).alias("ordinary")).collect()  # SYMBOLS**2 at most
    counts = {t: (r, o) for t, r, o in rows}
    if not any(o for _, o in counts.values()):
        return Model([0.0] * SYMBOLS**2)
    totals = [[sum(counts.get(a * SYMBOLS + b, (0, 0))[side] for b in range(SYMBOLS)) for a in range(SYMBOLS)] for side in (0, 1)]
    ratios = []
    for t in range(SYMBOLS**2):
        r, o = counts.get(t, (0, 0))
        rt, ot = totals[0][t // SYMBOLS], totals[1][t // SYMBOLS]
        ratios.append(math.log((r + 1) / (rt + SYMBOLS)) - math.log((o + 1) / (ot + SYMBOLS)) if rt and ot else math.log(2.0) * ((rt > 0) - (ot > 0)))
    model = Model(ratios)
    long = known.filter((F.col("r") == 0) & (F.length("value") >= MIN_TOKEN))
    high = long.agg(F.percentile_approx(model.ratio(F.col("value")), F.lit(1 - ORDINARY_SHARE), F.lit(10_000))).first()[0]
    model.threshold = max(MIN_RATIO, high or 0.0)
    return model


def with_random(found: DataFrame, model: Model) -> DataFrame:
    """Add _random: long tokens outside of base spans whose mean log-likelihood ratio exceeds the threshold."""
    d = found.withColumn("_tokens", tokens(F.col("text")))
    clear = lambda s: ~F.exists("_base", lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))
    kept = F.filter("_tokens", lambda s: clear(s) & (model.ratio(s["value"]) > model.threshold))
    return d.withColumn("_random", F.when(F.size("_tokens") == 0, F.array().cast(SPAN)).otherwise(kept)).drop("_tokens")


def listed(spans_: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the spans found in each row's text: _base, _random and _all, by start.

    Null and empty texts have none. Rows are scored one by one, so repeats do not
    interact; extra columns are ignored; an empty table gives an empty result.
    """
    found = staged(with_spans(docs.select("doc_id", "text")), "spans")
    return with_random(found, train(found)).withColumn("_all", F.sort_array(F.concat("_base", "_random"))).select("doc_id", "_base", "_random", "_all")


def mask(docs: DataFrame, cover: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced in text, and n_chars set to the new length if there is such a column.

    Documents without spans pass unchanged. Overlapping spans are covered once.
    """
    own = docs.columns
    clash = {c: f"_own_{n}" for n, c in enumerate(own) if c != "text"}
    found = staged(with_spans(docs.withColumnsRenamed(clash)), "spans")
    every = with_random(found, train(found)).withColumn("_all", F.sort_array(F.concat("_base", "_random")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        new = F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"])), F.lit(cover))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] < acc["at"], acc["out"]).otherwise(new).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    text = F.when(F.size("_all") > 0, F.aggregate("_all", start, step, rest)).otherwise(F.col("text"))
    out = every.withColumn("text", text)
    length = {"n_chars": F.when(F.size("_all") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col(clash["n_chars"]))} if "n_chars" in own else {}
    return out.select(*[length.get(c, F.col(clash.get(c, c))).alias(c) for c in own])
