"""M-tree search, WARC archives and the pipeline."""

import hashlib
import math
import random

import numpy as np


def test_mtree_equals_brute_force(spark):
    from pyspark.sql import functions as F
    from sondera.llm import mtree

    r = random.Random(3)
    vectors = [(n, [r.gauss(0, 1) for _ in range(8)]) for n in range(600)]
    vectors += [(n, vectors[5][1]) for n in range(600, 700)] + [(n, [0.5] * 8) for n in range(700, 760)]
    vectors += [(800, None), (820, [1.0, None] + [0.0] * 6), (840, [float("nan")] * 8), (860, [float("inf")] * 8), (880, [0.0] * 8), (900, [1.0, 2.0]), (None, [0.0] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<float>, score int")
    got = {}
    for x in mtree.top_k(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    usable = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, v in usable:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in usable if j != i and len(w) == len(v))[:20]
            assert sorted(got.get(i, [])) == [(n, j, -s) for n, (s, j) in enumerate(scores, 1)]
    assert set(got) <= {i for i, _ in usable if i % 20 == 0}
    again = {}
    for x in mtree.top_k(df, F.col("vec_id") % 20 == 0, shard_rows=40).collect():  # many cells, and one of copies that is split
        again.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    assert {i: sorted(x) for i, x in again.items()} == {i: sorted(x) for i, x in got.items()}
    assert mtree.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_mtree_pages_and_bounds():
    from sondera.llm import mtree

    draw = np.random.default_rng(0)
    centres = draw.integers(-80, 80, (12, 6))
    v = (centres[draw.integers(0, 12, 4000)] + draw.integers(-3, 4, (4000, 6))).astype(np.int64)
    v[1000:1600] = v[1000]
    most = int((v * v).sum(1).max())
    pages = mtree.build(v, np.arange(4000), most, 64, 6)
    leaves = np.concatenate([p[2] for p in pages if p[1]])
    assert sorted(leaves.tolist()) == list(range(4000))
    tree = mtree.Tree({p[0]: (p[1], p[2], p[3].astype(float), *p[4:]) for p in pages}, most)
    for n, q in enumerate(range(0, 4000, 97), 1):
        scores, ids = tree.search(v[q].astype(float), q, 20)
        assert tree.computed < 0.8 * 4000 * n  # clustered points are pruned
        s = v @ v[q]
        want = [i for i in np.lexsort((np.arange(4000), -s)) if i != q][:20]
        assert ids.tolist() == want and scores.tolist() == s[want].tolist()


def pages_of(spark):
    big, evil = "p" * 1200, "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "y" * 1100
    rows = [(1, "u1", big), (2, "u2", big), (3, None, big + "é"), (4, "u4", None), (5, "u5", ""), (6, "u6", evil), (7, "u\r\n7", evil), (8, "u8", "small"), (9, "u9", "small"), (2, "again", big), (None, "n", "q" * 1500)]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")


def test_warc_round_trip(spark):
    from sondera.llm import warc

    rows, pages = pages_of(spark)
    got = sorted(warc.archive(pages).collect(), key=repr)
    largest = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            largest[b] = max(largest.get(b, i), i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = b in largest and largest[b] != i
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", largest[b] if again else None))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)
    assert warc.archive(pages.limit(0)).count() == 0


def test_warc_chain_rejects_magic_in_payloads(spark):
    from sondera.llm import warc
    from sondera.llm.common import new_path

    _, pages = pages_of(spark)
    path = new_path(spark, "warc-test")
    warc.write(pages, path)
    assert warc.emit(spark, path).filter("page_id = 999").count() >= 1
    assert warc.read(spark, path).filter("page_id = 999").count() == 0


def test_warc_files_stay_small(spark):
    from sondera.llm import warc
    from sondera.llm.common import new_path

    rows = [(n, "u", ("z" * (50 if n % 5 else 200_000)) + str(n)) for n in range(200)]
    path = new_path(spark, "warc-test")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write(pages, path, file_bytes=1_000_000)
    sizes = [len(warc._opened(bytes(r.content))) for r in warc._files(spark, path).collect()]
    assert max(sizes) < 1_300_000 and len(sizes) < 60
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest) for r in warc.read(spark, path).collect()) == [(i, len(h), hashlib.sha1(h.encode()).hexdigest()) for i, _, h in rows]


def test_pointer_jumping():
    from sondera.llm import warc

    at = np.array([0, 5, 9, 12, 20, 30])
    assert warc.reachable(at, np.array([9, 12, 20, 30, 99, 40])).tolist() == [True, False, True, False, True, False]
    assert warc.reachable(at[1:], at[1:] + 1).tolist() == [False] * 5
    assert warc.reachable(np.zeros(0, int), np.zeros(0, int)).tolist() == []


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    from sondera.llm import near_dedup, quality_model, quality_rules, secret_scan
    from sondera.llm.common import staged

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    rules = staged(corpus_pipeline.STAGES[0][1](spark, docs, d), "t")
    assert ids(rules) == ids(quality_rules.rules(docs).filter("kept"))
    good = staged(corpus_pipeline.STAGES[1][1](spark, rules, d), "t")
    assert ids(good) == ids(quality_model.classify(rules, labels).filter("predicted = 1"))
    one = staged(corpus_pipeline.STAGES[2][1](spark, good, d), "t")
    assert ids(one) == ids(near_dedup.clusters(good, corpus_pipeline.NEAR_PERCENT).filter("kept"))
    safe = staged(corpus_pipeline.STAGES[3][1](spark, one, d), "t")
    assert safe.columns == docs.columns and safe.count() == one.count()
    assert secret_scan.scan(safe).filter("size(_base) > 0").count() == 0
    packed = corpus_pipeline.run(spark, d)
    assert sorted({r.doc_id for r in packed.collect()}) == ids(safe)


def test_empty_tables_and_clashing_columns(spark, both, empty):
    import corpus_pipeline
    import public_tokenizers
    from sondera.llm import bpe, near_dedup, quality_model, secret_scan

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    assert bpe.round_trip(empty, ranks, public_tokenizers.PATTERN).count() == 0
    assert near_dedup.keep(empty).count() == secret_scan.mask(empty).count() == quality_model.keep(empty, labels).count() == 0
    plain = empty.select(*corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, plain, "/root/testdata/sf0.001").count() == 0
    kept, masked = near_dedup.keep(both), secret_scan.mask(both)
    assert kept.columns == masked.columns == both.columns
    assert masked.count() == both.count() and 0 < kept.count() < both.count()
    assert sorted(r.row for r in masked.filter("row is not null").collect()) == sorted(r.row for r in both.filter("row is not null").collect())


def test_workers_hand_out_small_blocks(monkeypatch):
    import pyarrow as pa
    from sondera.llm import near_dedup

    class Rows:  # runs a kernel on record batches without Spark
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return lambda batch: list(run(iter([batch])))

    texts = [f"{n} " * 20_000 for n in range(40)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    for kernel in (near_dedup.signed, near_dedup.sets):
        some = kernel(Rows())(batch)
        assert len(some) > 1  # of 2 MB of text
        monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 10**9)
        assert pa.Table.from_batches(some).to_pylist() == pa.Table.from_batches(kernel(Rows())(batch)).to_pylist()
        monkeypatch.undo()
