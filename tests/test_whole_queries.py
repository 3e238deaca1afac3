"""Registered queries against their SQL without its cuts, which the reference does not have."""

from collections import Counter
from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"


def run_sql(sql):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con.execute(sql).fetchall()


@pytest.mark.parametrize(
    "name, cut", [("company_tag_rank", " WHERE rank <= 5"), ("company_sheet", " WHERE member_count >= 5"), ("knowledge_rank", " WHERE rank <= 20"), ("knowledge_sheet", " WHERE member_count >= 5")]
)
def test_rollups_list_every_question(spark, name, cut):
    from sondera.plans.oracle import oracle_sql
    from sondera.plans.queries import queries

    sql = oracle_sql()[name].removesuffix(cut)
    want = Counter(map(tuple, run_sql(sql)))
    assert Counter(map(tuple, queries()[name](spark, SF).collect())) == want
    assert len(run_sql(sql + cut)) < sum(want.values())


def test_company_report_has_every_question(spark):
    from sondera.operators import rollup
    from sondera.plans import bank
    from sondera.plans.queries import queries

    rows = rollup.by_company(bank.tagged(spark, SF)).collect()
    lines = queries()["company_report"](spark, SF).filter("o4 > 0 and line_no = 0").collect()
    assert any(r.member_count < 5 for r in rows)
    assert Counter(r.company for r in rows) == Counter(r.o2 for r in lines)


def test_excel_sanitize_treats_whole_texts(spark, tmp_path):
    from sondera.plans.queries import queries

    long = "x" * 60 + "\u0002 end\u001e\n" + "y" * 60
    spark.createDataFrame([(1, long), (2, "short"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.safe for r in queries()["excel_sanitize"](spark, str(tmp_path)).collect()}
    assert got == {1: "x" * 60 + " end\n" + "y" * 60, 2: "short", 3: None}
