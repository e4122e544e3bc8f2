"""Queries on vectors."""
from pyspark.sql import functions as F

from opsloom.llm import topk
from opsloom.llm.common import table
from opsloom.llm.queries import query

OP3_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY s.r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op3_topk_search", OP3_SQL)
def nearest(spark, folder):
    vectors = topk.quantised(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)
