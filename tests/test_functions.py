"""Functions and parsers on micro-fixtures."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sondera.functions import chunk, json_repair, similarity, text
from sondera.operators import dedupe, graph, notes, providers
from sondera.plans import literals


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression("t").alias("x")).first().x


@pytest.mark.parametrize("raw, want", [("什么是ＢＮ？", "什么是BN?"), ("a，b：c", "a,b:c"), ("讲一下【RoPE】。", "讲一下 [RoPE] ."), ("  Batch　Norm \n和Layer norm ", "BatchNorm 和LayerNorm"), ("batch normalization的作用", "BatchNormalization的作用"), ("自注意力", "Self-Attention"), ("自注意力机制", "自Attention"), ("多头注意力机制", "多头Attention"), ("“引号”", "“引号”"), (None, "")])
def test_normalize(spark, raw, want):
    assert one(spark, raw, text.normalize) == want


@pytest.mark.parametrize("raw, want", [("什么是 BN?", "什么是bn"), ("a_b-c", "a_bc"), ("？！…", ""), ("Ｃ++ 和 C#", "ｃ和c")])
def test_compare_key(spark, raw, want):
    assert one(spark, raw, text.compare_key) == want


@pytest.mark.parametrize("raw, want", [("<p>Q1 什么是BN</p><script>x</script>", "Q1 什么是BNx"), ("问题 点赞收藏再关注 完", "问题  完"), ("a 点赞\n收藏关注 b", "a 点赞\n收藏关注 b"), ("a\n\n\n\nb", "a\n\nb"), ("a\n\n \n\nb", "a\n\n\n\nb"), ("if a<b and c>d", "if ad")])
def test_clean_text(spark, raw, want):
    assert one(spark, raw, text.clean_text) == want


@pytest.mark.parametrize("cell, want", zip([c for _, c in literals.CELLS], ["1.什么是BN\n2.LN呢", "一:自我介绍\n二:项目", "面试问题: BN和LN", "1.2 的区别", "甲;乙:丙"], strict=True))
def test_clean_csv_text(spark, cell, want):
    assert one(spark, cell, text.clean_csv_text) == want


def test_sentences(spark):
    assert one(spark, "v1.2 ok. yes?! 3", text.sentences) == ["v1.", "2 ok.", "yes?", "!", "3"]


def test_halves(spark):
    assert one(spark, "a\n\nb\n\nc", text.halves) == ["a", "b\n\nc"]
    assert one(spark, "aaaa\nbb cc dd", text.halves) == ["aaaa", "bb cc dd"]
    assert one(spark, "x", text.halves) == ["x"]


def test_tiers(spark):
    got = spark.createDataFrame([(n,) for n in (4, 5, 9, 10, 19, 20)], "n int").select(text.tier_icon("n").alias("x")).collect()
    assert [r.x for r in got] == ["", "🔥", "🔥", "🔥🔥", "🔥🔥", "🔥🔥🔥"]


def test_chunk_fixtures():
    assert chunk.fold("aaaa\n\nbbbb\n\ncccc", 10, 3) == [("aaaa\n\nbbbb", 0, 10), ("bbbb\n\ncccc", 7, 17)]
    assert chunk.fold("ab\n\nAAAA. BBBB. CCCC.\n\nzz", 10, 3) == [("ab", 0, 2), ("AAAA.BBBB.", -1, 9), ("BB.CCCC.", 6, 14), ("zz", 11, 13)]
    assert chunk.fold("A" * 16, 10, 3) == [("A" * 16, 0, 16)]
    assert chunk.fold(None) == [] and chunk.fold(" \n\n ") == []
    with pytest.raises(ValueError):
        chunk.fold("a", 10, 0)


def test_chunks_cover_their_text():
    draw = random.Random(1)
    for _ in range(200):
        paragraphs = ["".join(draw.choice("abc. ") for _ in range(draw.randint(1, 60))).strip() or "x" for _ in range(draw.randint(1, 8))]
        got = chunk.fold("\n\n".join(paragraphs), 40, 7)
        together = "".join(c for c, _, _ in got).replace(" ", "").replace("\n", "")
        assert all(p.replace(" ", "") in together or len(p) > 40 for p in paragraphs)
        assert all(e - s == len(c) for c, s, e in got)


@pytest.mark.parametrize("a, b, want", [("kitten", "sitting", 61.5385), ("abcd", "abxd", 75.0), ("abcdefghij", "abcdefghijk", 95.2381), ("", "a", 0.0), ("", "", 100.0), ("BN和LN的区别", "BN与LN的区别", 87.5)])
def test_ratio(a, b, want):
    assert round(similarity.ratio(a, b), 4) == want == round(similarity.ratio(b, a), 4)


def test_neighbours_rank_before_the_order_of_ids(spark):
    import numpy as np

    gram = np.array([[1, 0.9, 0.95], [0.9, 1, 0.97], [0.95, 0.97, 1]])
    v = np.linalg.cholesky(gram)
    df = spark.createDataFrame([(n, [float(x) for x in r]) for n, r in enumerate(v)], "id long, vector array<double>")
    pairs = lambda k: sorted((r.a, r.b) for r in dedupe.embedding_pairs(df, k, 0.85).collect())
    assert pairs(1) == [(0, 2), (1, 2)] and pairs(2) == pairs(0) == [(0, 1), (0, 2), (1, 2)]


def test_term_cosine_equals_brute_force(spark):
    import math
    from collections import Counter

    draw = random.Random(5)
    texts = [(n, " ".join(draw.choice(["a", "b", "c", f"r{n % 7}", f"s{n % 5}"]) for _ in range(12))) for n in range(60)]
    got = {(r.a, r.b): round(r.cosine, 6) for r in similarity.term_cosine_pairs(spark.createDataFrame(texts, "id long, text string"), 0.8957).collect()}
    bags = [Counter(t.split()) for _, t in texts]
    dot = lambda x, y: sum(x[k] * y[k] for k in x)
    want = {(i, j): round(c, 6) for i in range(60) for j in range(i + 1, 60) if (c := dot(bags[i], bags[j]) / math.sqrt(dot(bags[i], bags[i]) * dot(bags[j], bags[j]))) >= 0.8957}
    assert got == want


def test_term_cosine_over_blocks_makes_no_candidate_rows(spark, monkeypatch):
    import math
    from collections import Counter

    monkeypatch.setattr(similarity, "BLOCK", 16)
    draw = random.Random(8)
    texts = [(n, " ".join(["The"] * draw.randint(5, 9) + draw.choices("abcdefgh", k=4) + [f"w{draw.randint(0, 400)}"])) for n in range(120)] + [(900, ""), (901, None), (902, "\t x\u00a0y \n"), (903, "x\u00a0y")]
    found = similarity.term_cosine_pairs(spark.createDataFrame(texts, "id long, text string"), 0.9501)
    rows = found.collect()
    bags = {n: Counter(re.split("[ \t-\r]+", t.lower().strip(" \t\n"))) for n, t in texts if t}
    dot = lambda x, y: sum(x[k] * y[k] for k in x)
    cosine = {(i, j): dot(bags[i], bags[j]) / math.sqrt(dot(bags[i], bags[i]) * dot(bags[j], bags[j])) for i in bags for j in bags if i < j}
    assert {(r.a, r.b): round(r.cosine, 6) for r in rows} == {p: round(c, 6) for p, c in cosine.items() if c >= 0.9501} and len(rows) == len({(r.a, r.b) for r in rows}) > 50
    assert "Join" not in found._jdf.queryExecution().sparkPlan().toString()


def test_term_cosine_looks_at_the_words_of_few_pairs(spark, monkeypatch):
    """Rows of other words and of other weights are told apart before their words are looked at; large counts stay exact."""
    from collections import Counter

    monkeypatch.setattr(similarity, "HEAD", 224)
    draw = random.Random(3)
    rare = lambda k: [f"r{draw.randint(0, 10**6)}" for _ in range(k)]
    texts = [(n, " ".join(["|"] * (30 + n) + rare(6))) for n in range(60)] + [(100 + n, " ".join(draw.choices([f"k{n % 4}x{k}" for k in range(60)], k=300))) for n in range(60)]
    texts += [(200 + n, " ".join(["long"] * 5000 + ["word"] * (700 + n) + rare(300))) for n in range(3)] + [(300, texts[70][1]), (301, texts[70][1] + " once")]
    frame, looked = spark.createDataFrame(texts, "id long, text string"), []
    bags, pivots = similarity.term_bags(frame)
    rows = bags.withColumn("piece", F.lit(0)).toArrow().combine_chunks()
    ranges = similarity._ranges
    monkeypatch.setattr(similarity, "_ranges", lambda *x: looked.append(len(out := ranges(*x))) or out)
    block = similarity._Block(rows, pivots)
    got = {(int(x), int(y)): float(z) for b in rows.to_batches() for a, c, cosine in similarity._pairs_of(b, block, pivots, 0.95) for x, y, z in zip(a, c, cosine, strict=True)}
    got = {(min(p), max(p)): c for p, c in got.items()}
    count = {n: Counter(t.split()) for n, t in texts}
    square = {n: sum(k * k for k in c.values()) for n, c in count.items()}
    want = {(i, j): sum(k * count[j][w] for w, k in count[i].items()) / (square[i] * square[j]) ** 0.5 for i in count for j in count if i < j}
    assert max(square.values()) > 2**24 and got == pytest.approx({p: c for p, c in want.items() if c >= 0.95}, abs=1e-12) and len(got) > 1500
    assert sum(looked) < 20 * len(got)
    found = similarity.term_cosine_pairs(frame, 0.95, digits=6).collect()
    assert {(r.a, r.b): r.cosine for r in found} == {p: round(c, 6) for p, c in got.items()} and len(found) == len(got)


def largest_share(pairs):
    counts = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts), sum(counts)


def test_pairs_of_a_large_group_are_dealt_over_tasks(spark):
    many = spark.range(4000).select(F.col("id").alias("qid"), F.lit("same").alias("raw"), F.lit("").alias("norm"))
    share, made = largest_share(dedupe.exact_pairs(many))
    assert made == 4000 * 3999 // 2 and share < 0.6


def test_normalized_pairs_of_a_large_group_and_of_odd_white_space(spark):
    signs = ["", ".", " !", "\u2003?"]
    many = spark.createDataFrame([(n, f"Sa{signs[n % 4]}me", "") for n in range(2500)] + [(None, "same", ""), (9000, None, None), (9001, "", None)], "qid long, raw string, norm string")
    pairs = dedupe.normalized_pairs(many)
    share, made = largest_share(pairs)
    assert made == 2500 * 2499 // 2 + 1 and share < 0.7
    assert pairs.filter("a >= b").isEmpty() and pairs.distinct().count() == made


def test_strip_and_normalize_treat_every_white_space(spark):
    odd = re.compile("[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
    marks = [chr(n) for n in range(1, 0xD800)]
    rows = spark.createDataFrame([(n, f"{c}{c} a{c}{c}b {c}") for n, c in enumerate(marks)], "n int, t string")
    for r in rows.select("n", "t", text.strip("t").alias("s"), text.punctuate(text.narrow(F.col("t"))).alias("p")).collect():
        assert r.s == re.sub(rf"\A{odd.pattern}|{odd.pattern}\Z", "", r.t)
        assert not odd.fullmatch(marks[r.n]) or r.p == " a b "


def test_fast_path_equals_brute_force_and_moves_no_pairs(spark):
    draw = random.Random(4)
    texts = [draw.choice(["a", "A", " a", "a!", "b c", "B c", "bc", "attent\u0130on\u673a\u5236", "attent\u0130on\u673a\u5236".lower(), "ATTENTION\u673a\u5236", "!", "?"]) for _ in range(150)]
    q = spark.createDataFrame(list(enumerate(texts)), "qid long, raw string").withColumn("norm", text.normalize("raw"))
    keys = {r.qid: (r.e, r.k, len(r.raw)) for r in q.select("qid", "raw", text.exact_key("raw").alias("e"), dedupe.comparison(q).alias("k")).collect()}
    want = {}
    for a in range(150):
        for b in range(a + 1, 150):
            (ea, ka, na), (eb, kb, nb) = keys[a], keys[b]
            if ea == eb or ka == kb:
                want[a, b] = ("exact", 0.99, max(na, nb)) if ea == eb else ("normalized", 0.97, max(na, nb))
    assert any(keys[a][0] == keys[b][0] and keys[a][1] != keys[b][1] for a, b in want)
    found = dedupe.fast_path(q)
    rows = found.collect()
    assert {(r.a, r.b): (r.source, r.confidence, r.hint_chars) for r in rows} == want and len(rows) == len(want)
    assert all(r.duplicate and not r.review for r in rows)
    assert "Aggregate" not in found._jdf.queryExecution().sparkPlan().toString()


def test_fuzzy_pairs_equal_brute_force(spark):
    draw = random.Random(2)
    texts = [(n, "".join(draw.choice("ab") for _ in range(draw.randint(1, 14)))) for n in range(90)]
    got = {(r.a, r.b) for r in dedupe.fuzzy_pairs(spark.createDataFrame([(n, t, "") for n, t in texts], "qid long, raw string, norm string")).collect()}
    assert got == {(i, j) for i, a in texts for j, b in texts if i < j and similarity.ratio(a, b) >= 85}
    many = spark.range(1001).select(F.col("id").alias("qid"), F.lit("same").alias("raw"), F.lit("").alias("norm"))
    assert dedupe.fuzzy_pairs(many).count() == 0


@pytest.mark.parametrize("answer, want", [('```json {"a":[1,2,],}```', '{"a":[1,2]}'), ('text {"a": 1} more', '{"a":1}'), ('{"q": [{"x": "BN"}, {"x": "L', '{"q":[{"x":"BN"}]}'), ("none", None), ("[1]", None), ("", None), (None, None)])
def test_recover(answer, want):
    assert json_repair.recover(answer) == want


def test_parsers(spark):
    files = spark.createDataFrame(literals.FILES, "id long, path string, content string").withColumn("company_hint", F.lit(None).cast("string"))
    got = {(r.path.rsplit("/", 1)[1], r.ordinal): r for r in notes.parse_notes(files).collect()}
    assert got["a.md", 0].text_clean == "正文一\n正文二" and got["a.md", 0].interview_date_raw == "2024-01-02" and got["a.md", 0].source_title == "标题"
    assert (got["b.md", 1].source_title, got["b.md", 1].difficulty, got["b.md", 1].tags) == ("什么是BN", "中", ["归一化", "基础"])
    assert (got["b.md", 2].source_title, got["b.md", 2].difficulty) == ("LN呢", "易")
    assert (got["c.md", 0].company_raw, got["c.md", 0].source_title) == ("字节", "c")
    dive = [r for (name, _), r in got.items() if name == "d.md"]
    assert [(r.source_title, r.frequency) for r in sorted(dive, key=lambda r: r.ordinal)] == [("RoPE 原理", "42次"), ("KV Cache", "3次")]
    assert (got["e.md", 0].company_raw, got["f.md", 0].company_raw) == ("腾讯", "通用题库")
    assert not any(name == "blank.md" for name, _ in got)


def test_directories_and_aliases(spark):
    files = spark.createDataFrame(literals.DIRECTORIES, "id long, dir_name string")
    got = {r.id: r.company_hint for r in notes.with_directory_company(files, spark.createDataFrame(literals.DIRECTORY_MAP, "dir_key string, company string")).collect()}
    assert got == {1: "字节跳动", 2: "foo", 3: "通用题库", 4: None, 5: "阿里巴巴", 6: "腾讯"}
    raw = spark.createDataFrame([("字节",), ("BYTEDANCE",), (None,)], "company_raw string")
    norm = notes.with_company_norm(raw, spark.createDataFrame([("字节", "字节跳动"), ("ByteDance", "字节跳动")], "company_raw string, canonical string"))
    assert {r.company_raw: r.company_norm for r in norm.collect()} == {"字节": "字节跳动", "BYTEDANCE": "BYTEDANCE", None: None}


def test_clusters_and_review(spark):
    names = "abcdefghijk"
    q = spark.createDataFrame([(n, f"r{n}", c, "", None) for n, c in enumerate(names)], "qid long, record_id string, raw string, norm string, hint string")
    at = names.index
    pairs = [("a", "b", 0.99), ("b", "c", 0.80), ("c", "d", 0.79), ("e", "f", 0.54), ("g", "h", None)]
    v = spark.createDataFrame([(at(a), at(b), s) for a, b, s in pairs], "a long, b long, score double")
    v = dedupe.score_verdicts(v).select("a", "b", F.lit("fuzzy").alias("source"), "duplicate", "confidence", F.lit(None).cast("string").alias("hint"), "review")
    got = dedupe.canonical_questions(q, v, dedupe.cluster_labels(q, v)).collect()
    group = lambda flag: sorted("".join(names[m] for m in r.member_ids) for r in got if r.in_review == flag)
    assert group(True) == ["abc", "d", "g", "h"] and group(False) == ["e", "f", "i", "j", "k"]


def test_components_follow_chains(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(0, 30)] + [(50, 40), (41, 50)], "a long, b long")
    got = {r.id: r.label for r in graph.components(spark.range(60), edges).collect()}
    assert all(got[n] == 0 for n in range(31)) and got[41] == got[50] == 40 and got[59] == 59


def test_provider_policy():
    class Broken:
        name = "broken"

        def __call__(self, text):
            raise providers.Refused

    call = providers.Resilient(Broken(), providers.RuleExtractor(), refusals=3)
    for _ in range(5):
        assert call("什么是BN?\nfoo") == (["什么是BN?"], "rule", "fallback")
    assert call.calls == 3 and call.open

    class Short:
        name = "short"

        def __call__(self, text):
            if len(text) > 1500:
                raise ValueError
            return [text[:3]]

    values, name, status = providers.with_splits(providers.Resilient(Short()), "abc " * 300 + "\n\n" + "def " * 300)
    assert (values, name, status) == (["abc", "def"], "short", "split")
    assert providers.with_splits(providers.Resilient(Broken()), "short") == ([], "", "refused")


def test_chunk_after_a_short_sentence_starts_before_zero():
    text = "a" * 50 + "." + "b" * 3000 + "." + "c" * 200
    found = chunk.fold(text, 3000, 300)
    assert [(s, e) for _, s, e in found][:2] == [(0, 51), (51 - 300, 51 - 300 + 51 + 3001)]


@pytest.mark.parametrize("answer, want", [('{"a": 1, "b": 12', "{}"), ('{"a": 1, "b": tru', "{}"), ('{"a": [1, 2], "b": "x', '{"a":[1,2]}'), ('```JSON\n{"a": [1,],}\n```', '{"a":[1]}'), ('{"a": {"b": [1]', '{"a":{"b":[1]}}')])
def test_recover_never_returns_a_cut_scalar(answer, want):
    assert json_repair.recover(answer) == want


def test_full_width_digits_are_digits(spark):
    from pyspark.sql import functions as F
    from sondera.operators import notes, providers

    row = spark.range(1).select(
        notes.detect_format(F.lit("Q１：什么\n**难度**")).alias("f"), F.size(notes.bank_blocks(F.lit("Q１：甲\nQ2：乙"))).alias("n"),
        providers.looks_like_question(F.lit("１. 讲")).alias("q"), text.clean_csv_text(F.lit("x １. 甲 ２. 乙")).alias("c"),
    ).first()
    assert (row.f, row.n, row.q, row.c) == ("knowledge_base", 2, True, "１.甲\n２.乙")


def test_resilient_waits_and_passes_known_questions():
    from sondera.operators import providers

    class Late:
        name = "late"

        def __init__(self):
            self.n = 0

        def __call__(self, text, known):
            self.n += 1
            if self.n < 3:
                raise ValueError
            return [text, *known]

    call = providers.Resilient(Late(), delay=0.001)
    assert providers.with_splits(call, "x", known=["k"]) == (["x", "k"], "late", "ok")
    assert providers.relevant_to(["abc", "zzz"], "xabcx") == ["abc"] and providers.relevant_to(["q"], "x") == ["q"]
