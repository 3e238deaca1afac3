"""MinHash near-duplicates with sequential Bayesian verification.

Documents are sets of 5-word shingles. Documents with equal sets form a class at once;
only its smallest doc_id goes on. Bands of ROWS minima each bring together pairs; there
are as many as it takes for a pair of the required similarity to miss all of them with
probability BAND_MISS at most: 24 at 85 percent (7.7e-7), 36 at 80 percent (6.2e-7).

A bucket is never expanded into its pairs. In each round every bucket names one leader
(another one each round) and compares its members with it; pairs already in one
component are not compared again. The first round uses buckets of two bands at once,
which hold close copies. After ROUNDS rounds the members outside of their bucket's
largest component, if any, are compared with all others of the bucket in other
components, so no link between components stays unseen. A pair is formed only if both
sets have enough shingles that any other set has too, which is exact and leaves out
copies that were edited too much to be linked with anything. In the last step a pair must
also have enough shingles in common by SEGMENTS parts of the hash space, which is exact
too: in each part two sets share at most the smaller of their numbers of such shingles.
So a bucket full of copies of one text that are just too far from each other makes hardly
any pairs, though all their shared sizes would allow them.

Each candidate pair is compared by batches of an independent signature, and dropped as
soon as the posterior probability of the required similarity (uniform prior) falls below
MISS. Survivors are confirmed on their full sets.
"""

from __future__ import annotations

import functools
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondera.llm.common import byte_words, hand_back, small, staged

SHINGLE_WORDS = 5
#: Required similarity in percent.
PERCENT = 85
ROWS = 5
BAND_MISS = 1e-6
SIGNATURE, BATCH = 64, 16
MISS = 1e-6
LEADER_ROUNDS = 2
#: Parts of the hash space in which shared shingles are counted.
SEGMENTS = 64
#: Members of one bucket outside of its largest component that a task of the last step compares with the bucket.
SALT_ROWS = 256
SIGNED_SCHEMA = "doc_id long, n_shingles long, set_key binary, bands array<long>, signature binary"
_MASK = (1 << 64) - 1


@functools.cache
def band_count(percent: int) -> int:
    """The least even number of bands that a pair of this similarity misses with probability BAND_MISS at most."""
    return 2 * ceil(log(BAND_MISS) / log(1 - (percent / 100) ** ROWS) / 2)


@functools.cache
def _multipliers(bands: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(85)
    n = bands * ROWS + SIGNATURE
    return draw.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 1 << 63, n, np.uint64)


#: Bytes of text looked at and handed out at a time.
BLOCK_BYTES = 1_000_000
#: Words whose hashes are kept while a task runs; its end forgets them, as workers live on.
KEPT_WORDS = 200_000
_words: dict[bytes, int] = {}


def _word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_words) > KEPT_WORDS:
        _words.clear()
    for w in set(words):
        if w not in _words:
            _words[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; a text of fewer words is one shingle, without words none."""
    words = byte_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = _word_hashes(words)
    width = min(SHINGLE_WORDS, len(words))
    total = np.full(len(words) - width + 1, len(words) if len(words) < SHINGLE_WORDS else 0, np.uint64)
    for i in range(width):
        total = _mix(total + h[i : len(words) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(total)


def minima(hashes: np.ndarray, n_bands: int) -> np.ndarray:
    """The least value of each of the n_bands * ROWS + SIGNATURE hash functions; ``hashes`` are well mixed already."""
    a, b = _multipliers(n_bands)
    out = np.full(len(a), _MASK, np.uint64)
    for i in range(0, len(hashes), 1024):
        out = np.minimum(out, (a[:, None] * hashes[None, i : i + 1024] + b[:, None]).min(1))
    return out


def signed(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, set size, digest of the set, band keys and signature of every row."""
    from sondera.llm.bpe import blocks

    n_bands = band_count(percent)

    def run(batches):
        types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
        for b in blocks(batches, most=BLOCK_BYTES):
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = shingles(text)
                if not len(s):
                    rows.append((doc, 0, None, None, None))
                    continue
                m = minima(s, n_bands)
                bands = [xxhash.xxh3_64_intdigest(m[k * ROWS : (k + 1) * ROWS].tobytes(), k) for k in range(n_bands)]
                signature = (m[n_bands * ROWS :] >> np.uint64(48)).astype("<u2").tobytes()
                rows.append((doc, len(s), xxhash.xxh3_128_digest(s.tobytes()), [x - (1 << 64) if x >> 63 else x for x in bands], signature))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in SIGNED_SCHEMA.split(", ")])
        _words.clear()
        b = None
        hand_back()

    return docs.select("doc_id", "text").mapInArrow(run, SIGNED_SCHEMA)


@functools.cache
def least_matches(percent: int, miss: float) -> list[int]:
    """For each batch so far, the fewest matches with which a pair may still have the similarity.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1), and
    P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(BATCH, SIGNATURE + 1, BATCH):
        p, m = 0.0, -1
        while p < miss:
            m += 1
            p += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def plausible(pairs: DataFrame, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """The pairs (a, b, sig_a, sig_b) that pass the sequential test, as (a, b)."""
    least = least_matches(percent, miss)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(n, SIGNATURE) for c in (2, 3)]
            open_, matches = np.arange(n), np.zeros(n, np.int64)
            for k, m in enumerate(least):
                at = slice(k * BATCH, (k + 1) * BATCH)
                matches[open_] += (sides[0][open_, at] == sides[1][open_, at]).sum(1)
                open_ = open_[matches[open_] >= m]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(open_)), batch.column(1).take(pa.array(open_))], names=["a", "b"])

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def segment_counts(hashes: np.ndarray) -> np.ndarray:
    """How many shingles fall into each part of the hash space."""
    return np.bincount((hashes.view(np.uint64) & np.uint64(SEGMENTS - 1)).astype(np.int64), minlength=SEGMENTS)


def sets(docs: DataFrame) -> DataFrame:
    """doc_id, a number of its shingle set (64 bits of a digest), its shingle hashes and their number in each segment."""
    from sondera.llm.bpe import blocks

    def run(batches):
        for b in blocks(batches, most=BLOCK_BYTES):
            s = [shingles(t).view(np.int64) for t in b.column(1).to_pylist()]
            number = [xxhash.xxh3_64_intdigest(x.tobytes()) for x in s]
            number = pa.array([x - (1 << 64) if x >> 63 else x for x in number], pa.int64())
            parts = pa.array([segment_counts(x) for x in s], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), number, pa.array(s, pa.list_(pa.int64())), parts], names=["doc_id", "set", "s", "parts"])
        _words.clear()
        b = None
        hand_back()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, set long, s array<long>, parts array<int>")


def confirmed(pairs: DataFrame, full: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity."""
    one = full.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
    two = full.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    fit = F.least(F.size("sa"), F.size("sb")) * 100 >= percent * F.greatest(F.size("sa"), F.size("sb"))
    linked = 100 * both >= percent * (F.size("sa") + F.size("sb") - both)
    return pairs.join(one, "a").join(two, "b").filter(F.when(fit, linked).otherwise(F.lit(False))).select("a", "b")


def components(parent: DataFrame, links: DataFrame) -> DataFrame:
    """``parent`` (node, component: the smallest node of its component so far) after joining ``links`` (a, b).

    Rounds of hooking and pointer jumping: the root of every component hooks to the
    smallest neighbouring component, then targets are replaced by their own targets until
    all are roots. Every round is staged; the driver only asks whether rows are left.
    """
    of = lambda c: parent.select(F.col("node").alias(c), F.col("component").alias(f"{c}_root"))
    across = links.join(of("a"), "a").join(of("b"), "b").select(F.greatest("a_root", "b_root").alias("a"), F.least("a_root", "b_root").alias("b"))
    edges = staged(across.filter("a != b").distinct(), "roots")
    moves = None
    while not edges.isEmpty():
        hook = staged(edges.groupBy("a").agg(F.min("b").alias("to")), "hooks")
        while True:  # every hook goes to a smaller node, so chains end
            up = hook.select(F.col("a").alias("to"), F.col("to").alias("further"))
            once = hook.join(up, "to", "left").select("a", F.coalesce("further", "to").alias("to"))
            twice = once.join(up, "to", "left").select("a", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved"))
            hook = staged(twice, "hooks")
            if hook.filter("moved").isEmpty():
                break
        hook = hook.drop("moved")
        to = lambda c: hook.select(F.col("a").alias(c), F.col("to").alias(f"{c}_to"))
        raised = edges.join(to("a"), "a").join(to("b"), "b", "left").select("a_to", F.coalesce("b_to", "b").alias("b_to"))
        edges = staged(raised.filter("a_to != b_to").select(F.greatest("a_to", "b_to").alias("a"), F.least("a_to", "b_to").alias("b")).distinct(), "roots")
        if moves is None:
            moves = hook
        else:
            later = hook.select(F.col("a").alias("to"), F.col("to").alias("further"))
            fresh = moves.join(later, "to", "left").select("a", F.coalesce("further", "to").alias("to"))
            moves = staged(fresh.unionByName(hook).distinct(), "moves")
    if moves is None:
        return parent
    moved = parent.join(moves.select(F.col("a").alias("component"), "to"), "component", "left")
    return staged(moved.select("node", F.coalesce("to", "component").alias("component")), "parents")


def shared_sizes(full: DataFrame) -> DataFrame:
    """node, size, shared, parts: how many shingles a set has, how many of them any other set has too, and these by segment; one row per set of a node."""
    alone = full.select("set", F.explode("s").alias("x")).groupBy("x").agg(F.min("set").alias("set"), F.max("set").alias("other")).filter("set = other")
    alone = alone.groupBy("set", F.col("x").bitwiseAND(F.lit(SEGMENTS - 1)).cast("int").alias("part")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    alone = alone.groupBy("set").agg(F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("alone"))  # SEGMENTS entries at most
    sizes = full.select(F.col("doc_id").alias("node"), "set", F.size("s").alias("size"), "parts").dropDuplicates(["node", "set"])
    met = F.when(F.col("alone").isNull(), F.col("parts")).otherwise(F.transform("parts", lambda n, i: n - F.coalesce(F.try_element_at("alone", i), F.lit(0))))
    out = sizes.join(alone, "set", "left").select("node", "size", met.alias("parts"))
    return out.select("node", "size", F.aggregate("parts", F.lit(0), lambda a, x: a + x).alias("shared"), "parts")


def _fit(a: str, b: str, percent: int = PERCENT):
    """Whether two sets of these sizes can have the similarity if they meet in shared shingles only.

    It needs percent / (100 + percent) of the sum of sizes in common. This drops no link.
    """
    common = F.least(F.col(f"{a}shared"), F.col(f"{b}shared"))
    return common * (100 + percent) >= percent * (F.col(f"{a}size") + F.col(f"{b}size"))


def _candidates(members: DataFrame, seed: int, percent: int = PERCENT) -> DataFrame:
    """Pairs of each member with its bucket's leader, unless they share a component. members: key, node, component, size, shared."""
    draw = F.struct(F.xxhash64("node", "key", F.lit(seed)).alias("h"), "node", "component", "size", "shared")
    leaders = members.groupBy("key").agg(F.min(draw).alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = members.join(leaders.select("key", "lead"), "key").filter((F.col("component") != F.col("lead.component")) & _fit("", "lead.", percent))
    return pairs.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct()


def _remaining(members: DataFrame, parts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All pairs of each bucket across components that have one side outside of the bucket's largest component.

    parts: node, size, shared and parts of its sets. Members outside of the largest
    component are dealt to tasks of SALT_ROWS of them, each with a copy of the bucket.
    """
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    major = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("split")).filter("split > 1")
    salts = F.ceil((F.col("n") - F.col("top.n")) / SALT_ROWS).cast("int")
    divided = members.join(major.select("key", F.col("top.component").alias("major"), salts.alias("salts")), "key").drop("size", "shared").join(parts, "node")
    minor = divided.filter("component != major").select("key", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), *[F.col(c).alias(f"m_{c}") for c in ("node", "component", "size", "shared", "parts")])
    whole = divided.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    across = (F.col("component") != F.col("m_component")) & ((F.col("component") == F.col("major")) | (F.col("node") < F.col("m_node")))
    common = F.aggregate(F.zip_with("parts", "m_parts", lambda x, y: F.least(x, y)), F.lit(0), lambda a, x: a + x)
    enough = F.when(_fit("", "m_", percent), common * (100 + percent) >= percent * (F.col("size") + F.col("m_size"))).otherwise(F.lit(False))
    pairs = whole.join(minor, ["key", "salt"]).filter(across & enough)
    return pairs.select(F.least("node", "m_node").alias("a"), F.greatest("node", "m_node").alias("b")).distinct()


def clusters(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``docs``.

    Null, empty and wordless texts have no shingles, link with nothing and are kept. Rows
    of one doc_id count as one document if their sets are equal, else the links of all
    of them hold for it; each row is returned. A null doc_id links with nothing and is
    its own (null) component. Extra columns are ignored; an empty table gives an empty result.
    """
    rows = staged(signed(docs, percent), "signed")
    usable = rows.filter("n_shingles > 0 and doc_id is not null")
    # One representative of each set of shingles; its signature is taken along.
    grouped = usable.groupBy("set_key").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "signature")).alias("r"), F.count(F.lit(1)).alias("n"))
    classes = staged(grouped.select("set_key", "r.*", "n"), "classes")
    same = usable.select("set_key", "doc_id").join(classes.filter("n > 1").select("set_key", F.col("doc_id").alias("rep")), "set_key")
    equal = same.filter("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    key = lambda k, v: F.xxhash64(k, v)
    bands = classes.select(F.col("doc_id").alias("node"), F.posexplode("bands").alias("k", "v")).select("node", key("k", "v").alias("key")).distinct()
    pairs_of_bands = F.transform(F.sequence(F.lit(0), F.lit(band_count(percent) // 2 - 1)), lambda k: F.xxhash64(F.lit("wide"), k, F.get("bands", 2 * k), F.get("bands", 2 * k + 1)))
    wide = classes.select(F.col("doc_id").alias("node"), F.explode(pairs_of_bands).alias("key")).distinct()

    def shared_buckets(members: DataFrame, tag: str) -> DataFrame:
        many = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
        return staged(members.join(many, "key", "left_semi"), tag)

    wide, bands = shared_buckets(wide, "wide"), shared_buckets(bands, "bands")
    busy = small(staged(bands.select(F.col("node").alias("doc_id")).distinct(), "busy"))
    texts = docs.select("doc_id", "text").filter("doc_id is not null").join(busy, "doc_id", "left_semi")
    full = staged(sets(texts), "sets")
    signatures = classes.select("doc_id", "signature").join(busy, "doc_id", "left_semi")
    signatures = staged(signatures, "signatures")
    start = usable.select(F.col("doc_id").alias("node")).distinct()
    where = staged(bands.select("node", F.col("node").alias("component")).distinct(), "parents")
    # Sets with too few shared shingles have no link at all; the others carry their numbers along.
    parts = staged(shared_sizes(full).filter(F.col("shared") * 100 >= percent * F.col("size")), "weights")
    weights = small(parts.drop("parts"))

    def verified(candidates: DataFrame) -> DataFrame:
        one = signatures.select(F.col("doc_id").alias("a"), F.col("signature").alias("sig_a"))
        two = signatures.select(F.col("doc_id").alias("b"), F.col("signature").alias("sig_b"))
        likely = plausible(candidates.join(one, "a").join(two, "b"), percent)
        return staged(confirmed(staged(likely.distinct(), "likely"), full, percent).distinct(), "links")

    for step in range(LEADER_ROUNDS + 2):
        source = wide if step == 0 else bands
        members = source.join(weights, "node").join(where, "node")
        where = components(where, verified(_candidates(members, step, percent) if step <= LEADER_ROUNDS else _remaining(members, parts, percent)))
    # Classes of equal sets join last: they add their members to the components of their representatives.
    whole = staged(start.join(where, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "parents")
    merged = components(whole, equal).withColumnRenamed("node", "doc_id")
    out = rows.select("doc_id", "n_shingles").join(merged, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are kept: one document of each component. Columns stay."""
    found = clusters(docs, percent)
    gone = small(staged(found.filter(~F.col("kept")).select("doc_id").distinct(), "gone"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
