"""Files to reports, and the registered queries against their SQL."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from sondera.plans import oracle, pipeline, queries
from sondera.sources import files

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHECKED = ["flagship_frequency", "normalize_text", "clean_html", "company_from_dir", "sentence_split", "exact_pairs", "vector_topk", "canonical", "review_queue", "knowledge_sheet", "coverage_audit", "json_recover", "json_repair", "chunk_fold", "company_report", "knowledge_report", "run_report",
           "vector_components", "standard_body", "bank_split", "deep_dive_split", "json_validate", "merged_repairs", "coverage_pass", "candidate_layers"]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    got = queries.queries()[name](spark, DATA)
    columns = sorted(got.columns)
    found = duck.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in found.description]
    want = [tuple(dict(zip(names, r, strict=True))[c] for c in columns) for r in found.fetchall()]
    assert sorted(names) == columns
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_workbooks_read_back():
    import tempfile

    frame = pd.DataFrame({"公司": ["甲", "<乙>"], "问题": ["x & y", None]})
    with tempfile.NamedTemporaryFile(suffix=".xlsx") as f:
        files.write_workbook({"汇总": frame, "高频问题": frame.head(1)}, f.name)
        got = files.read_workbook(open(f.name, "rb").read())
    assert got.columns.tolist() == ["公司", "问题"] and got["公司"].tolist() == ["甲", "<乙>"] and got["问题"].tolist()[0] == "x & y"
    assert files.read_workbook(b"no zip").empty


def test_run_all(spark, tmp_path):
    notes = tmp_path / "in" / "nowcoder_acme_suanfa"
    notes.mkdir(parents=True)
    (notes / "a.md").write_text("# 标题\n**发布时间**: 2024-01-02\n什么是BN?\n\n讲一下LN\n", encoding="utf-8")
    (notes / "b.csv").write_bytes("公司,问题\n字节,什么是ＢＮ？\n美团,\n".encode("gbk"))
    (notes / "skip.txt").write_text("x")
    files.write_workbook({"s": pd.DataFrame({"公司": ["字节"], "内容": ["什么是BN?"]})}, str(notes / "c.xlsx"))
    config = pipeline.Config(folder=str(tmp_path / "out"))
    out = pipeline.run_all(spark, config, str(tmp_path / "in"))
    assert sorted(r.parser for r in out["records"].collect()) == ["csv", "excel", "standard_markdown"]
    texts = {r.text: r.member_count for r in out["classified"].collect()}
    assert any(n >= 2 for n in texts.values())
    assert {c for r in out["classified"].collect() for c in r.companies} >= {"acme", "字节"}
    text = lambda name: "\n".join(p.read_text() for p in sorted((tmp_path / "out" / name).glob("part-*")))
    assert "## acme" in text("company_summary.md") and "## 目录" in text("knowledge_summary.md") and "| 原始面经记录 | 3 |" in text("run_report.md")
    book = files.read_workbook((tmp_path / "out" / "company_summary.xlsx").read_bytes())
    assert book.columns.tolist() == ["公司", "问题", "高频标记", "知识点", "次级知识点", "出现次数", "变体"] and set(book["公司"]) >= {"acme", "字节"}
    found = out["audit"].first()
    assert (found.total_records, found.total_chunks) == (3, 3) and found.total_questions == out["questions"].count()
    assert {r.extract_pass for r in out["questions"].collect()} <= {"first", "coverage"}


def test_commands_one_by_one(spark, tmp_path):
    notes = tmp_path / "in" / "acme_suanfa"
    notes.mkdir(parents=True)
    for n in range(4):
        (notes / f"{n}.md").write_text(f"# 标题\n什么是BN{n}?\n那么为什么需要它\n讲一下LN\n", encoding="utf-8")
    out = str(tmp_path / "out")
    pipeline.main(["ingest", "-i", str(tmp_path / "in"), "-o", out, "-n", "3"])
    for command in pipeline.COMMANDS[1:8]:
        pipeline.main([command, "-o", out, *(["--chunk-size", "500", "--overlap", "50"] if command == "chunk" else []), *(["-n", "2"] if command == "extract" else [])])
    run = pipeline.Run(spark, pipeline.Config(folder=out))
    assert run.read("interviews_raw").count() == 3
    questions = run.read("atomic_questions").collect()
    assert len({q.chunk_id for q in questions}) == 2 and {q.extract_pass for q in questions} == {"first", "coverage"}
    assert all(q.char_end - q.char_start == len(q.question_text_raw) for q in questions)
    assert spark.read.json(f"{out}/dedupe_stats.jsonl").first().total_questions == len(questions)
    sample = pipeline.run_sample(spark, pipeline.Config(folder=str(tmp_path / "sample")), str(tmp_path / "in"), 1)
    assert sample["records"].count() == 1


def test_providers_of_models(spark, tmp_path):
    notes = tmp_path / "in" / "acme_suanfa"
    notes.mkdir(parents=True)
    (notes / "a.md").write_text("# 标题\n什么是归一化?\n归一化是什么?\n什么是注意力?\n坏题?\n", encoding="utf-8")

    def judge(a, b):
        if "坏" in a + b:
            raise ValueError
        return ("归一化" in a and "归一化" in b), 0.9, "归一化"

    def encode(texts):
        return [[1.0, 0.1 * len(t)] for t in texts]

    def tag(t):
        if "坏" in t:
            raise ValueError
        return "norm", ["x"]

    models = pipeline.Providers(coverage=None, judge=lambda: judge, embed=lambda: encode, classify=lambda: tag)
    run = pipeline.Run(spark, pipeline.Config(folder=str(tmp_path / "out"), threshold=0.5), models)
    out = run.all(str(tmp_path / "in"))
    assert {r.text for r in out["canonical"].collect()} >= {"归一化"} or out["review"].count() > 0
    assert out["review"].filter("text like '坏%'").count() == 1
    run.models.classify = lambda: tag
    assert {r.primary_tag for r in run.classify().collect()} <= {"norm", "uncertain"}
