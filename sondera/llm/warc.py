"""WARC archives: writing with revisit records, and reading back by boundary-chain verification.

Writing. A page's block is an HTTP response. Pages with equal payloads (SHA-256 and
length) of at least MIN_REVISIT bytes are archived once; the others become ``revisit``
records that keep the HTTP headers only. Archives are gzip text files written by Spark's
own committer, one write for each class of page sizes with a record count that keeps
its files below FILE_BYTES (or at one page), so lost executors and retried tasks leave no
trace and a reader never meets a file much larger than a page.

Reading. A task takes a whole archive file (of bounded size, as written) and emits one
candidate for every place where the magic stands at a line's start and a header can be
parsed: its offset, the offset of the record that must follow, and the record's fields.
Payloads may hold magic too. Pointer jumping then starts at offset 0 of each file and
doubles its stride until no new candidate is reached; candidates off that chain are
parts of payloads and are rejected. Only records on the chain have their payloads hashed,
in a second reading, so magic inside payloads costs no more than its header.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 1000
#: Most bytes of payloads that an archive file holds, unless one page has more.
FILE_BYTES = 64 << 20
#: Page sizes of a class lie within this factor.
SIZE_CLASS = 8
MAGIC = b"WARC/1.1\r\n"
GAP = b"\r\n\r\n"
RESULT_COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def described(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (the html in UTF-8; null: empty) with its length and digests."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    page = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), payload.alias("payload"))
    return page.select(
        "page_id", "url", "html",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("digest"),
        F.sha2("payload", 256).alias("payload_key"),
    )


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Of each payload that occurs more than once: payload_key and the largest page_id, whose record is the response."""
    keyed = described(pages).filter(F.col("payload_bytes") >= min_bytes)
    groups = keyed.groupBy("payload_key", "payload_bytes").agg(F.max("page_id").alias("original_id"), F.count(F.lit(1)).alias("n"))
    return groups.filter("n > 1 and original_id is not null").select("payload_key", "original_id")


def records(pages: DataFrame, originals: DataFrame) -> DataFrame:
    """One WARC record per page as text, without the gap that ends it."""
    d = described(pages).join(originals, "payload_key", "left")
    again = F.col("original_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original_id"))
    d = d.withColumn("again", again).withColumn(
        "http", F.format_string("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n", "payload_bytes")
    )
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("again"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name("page_id"),
        F.lit("\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(F.col("again"), F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name("original_id"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.length("http") + F.when(F.col("again"), 0).otherwise(F.col("payload_bytes"))).cast("string"),
        F.lit("\r\n\r\n"), F.col("http"), F.when(F.col("again"), "").otherwise(F.col("html")),
    )
    return d.select(header.alias("value"))


def write(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> None:
    """Archive every row of ``pages`` under ``path`` as gzip WARC files of about ``file_bytes`` before compression."""
    from sondera.llm.common import small, staged

    originals = small(staged(revisits(pages, min_bytes), "originals"))
    size = F.coalesce(F.octet_length("html"), F.lit(0)) + F.coalesce(F.octet_length("url"), F.lit(0)) + 600
    of = F.floor(F.log(size) / F.log(F.lit(float(SIZE_CLASS)))).cast("int")
    for r in pages.select(of.alias("size_class")).groupBy("size_class").count().collect() or [None]:  # a dozen rows
        some = pages if r is None else pages.filter(of == r.size_class)
        per_file = 1 if r is None else max(1, int(file_bytes / SIZE_CLASS ** (r.size_class + 1)))
        out = records(some, originals).write.option("maxRecordsPerFile", per_file).mode("append")
        out.option("lineSep", GAP.decode()).option("compression", "gzip").text(path)


def candidates(content: bytes) -> list[tuple]:
    """(offset, successor, page id, kind, payload bytes, payload digest, refers to) at every parseable magic."""
    out = []
    at = content.find(MAGIC)
    while at >= 0:
        if at == 0 or content[at - 1 : at] == b"\n":
            end = content.find(GAP, at)
            fields = {}
            for line in content[at + len(MAGIC) : end if end >= 0 else at].split(b"\r\n"):
                key, colon, value = line.partition(b":")
                if colon:
                    fields[key.strip().lower()] = value.strip()
            length = fields.get(b"content-length", b"")
            if end >= 0 and length.isdigit():
                begin = end + len(GAP)
                stop = begin + int(length)
                page = _page(fields.get(b"warc-record-id"))
                if stop <= len(content) and content[stop : stop + 4] == GAP and page is not False:
                    gap = content.find(GAP, begin, stop)
                    body = gap + len(GAP) if gap >= 0 else stop
                    kind = fields.get(b"warc-type", b"").decode("ascii", "replace")
                    size, digest = stop - body, None
                    if kind == "revisit":
                        head = content[begin : body if body < stop or gap >= 0 else min(stop, begin + 4096)]
                        stated = [x.split(b":", 1)[1].strip() for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                        size = int(stated[0]) if stated and stated[0].isdigit() else None
                        digest = fields.get(b"warc-payload-digest", b"").rpartition(b":")[2].decode("ascii", "replace")
                    refers = _page(fields.get(b"warc-refers-to"))
                    out.append((at, stop + 4, page, kind, body, size, digest, None if refers is False else refers))
        at = content.find(MAGIC, at + 1)
    return out


def _page(value: bytes | None) -> int | None | bool:
    """The number in <urn:page:number>; None for null; False if there is none."""
    if value is None or not value.startswith(b"<urn:page:") or not value.endswith(b">"):
        return False
    text = value[10:-1]
    try:
        return None if text == b"null" else int(text)
    except ValueError:
        return False


CANDIDATE_SCHEMA = "path string, at long, successor long, page_id long, record_type string, body long, payload_bytes long, payload_digest string, refers_to long"


def _opened(content: bytes) -> bytes:
    return zlib.decompress(content, 31) if content[:2] == b"\x1f\x8b" else content


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def emit(spark: SparkSession, path: str) -> DataFrame:
    """Candidates of all archive files under ``path``."""

    def run(batches):
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        names = ["path", "at", "successor", "page_id", "record_type", "body", "payload_bytes", "payload_digest", "refers_to"]
        for b in batches:
            for n in range(b.num_rows):
                rows = [(b.column(0)[n].as_py(), *c) for c in candidates(_opened(b.column(1)[n].as_py()))]
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return _files(spark, path).mapInArrow(run, CANDIDATE_SCHEMA)


def reachable(at: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """Which candidates (by rising offset) lie on the chain from offset 0, by pointer jumping."""
    n = len(at)
    jump = np.searchsorted(at, successor)
    jump = np.where((jump < n) & (at[np.minimum(jump, n - 1)] == successor), jump, n) if n else jump
    jump = np.append(jump, n)
    reached = np.zeros(n + 1, bool)
    reached[:1] = n > 0 and at[0] == 0
    while True:
        before = int(reached[:n].sum())
        reached[jump[np.flatnonzero(reached)]] = True
        if int(reached[:n].sum()) == before:
            return reached[:n]
        jump = jump[jump]


KEPT_SCHEMA = "path string, page_id long, body long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``, without magic inside payloads.

    A file's candidates (a few dozen bytes a record) meet in one task; files are bounded.
    """
    from sondera.llm.common import BROADCAST_ROWS, staged

    names = [f.split()[0] for f in KEPT_SCHEMA.split(", ")]

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at", kind="stable")
        return rows[reachable(rows["at"].to_numpy(), rows["successor"].to_numpy())][names]

    kept = staged(emit(spark, path).groupBy("path").applyInPandas(chain, KEPT_SCHEMA), "records")
    spans = kept.groupBy("path").agg(F.collect_list(F.struct("page_id", "body", "payload_bytes", "payload_digest", "record_type", "refers_to")).alias("found"))  # of one file
    spans = F.broadcast(spans) if kept.count() <= BROADCAST_ROWS else spans

    def hashed(batches):
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for b in batches:
            for n in range(b.num_rows):
                content, rows = _opened(b.column(0)[n].as_py()), []
                for r in b.column(1)[n].as_py():
                    stated = r["payload_digest"] if r["record_type"] == "revisit" else hashlib.sha1(content[r["body"] : r["body"] + r["payload_bytes"]]).hexdigest()
                    rows.append((r["page_id"], r["payload_bytes"], stated, r["record_type"], r["refers_to"]))
                columns = list(zip(*rows, strict=True)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=RESULT_COLUMNS)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return _files(spark, path).join(spans, "path").select("content", "found").mapInArrow(hashed, schema)


def archive(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back: one row per page.

    A null html is an empty payload. Equal payloads of at least MIN_REVISIT bytes: all
    rows with the largest page_id are responses and the others revisit it; if every
    page_id of a group is null, all are responses. A null url is an empty target.
    Extra columns are ignored; an empty table gives no records.
    """
    from sondera.llm.common import new_path

    path = new_path(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path)
