"""SQL for the queries that DuckDB can express."""

from __future__ import annotations

OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""

OP10 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest, coalesce(html, '') AS h FROM pages
), g AS (SELECT h, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY h)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN original IS NOT NULL AND original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to
FROM p LEFT JOIN g USING (h)
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_mtree_search": OP9, "op10_warc_chain": OP10}
