"""Queries on web pages."""
from pyspark.sql import functions as F

from opsloom.llm import html_crf, warc
from opsloom.llm.common import table
from opsloom.llm.queries import query

OP6_SQL = r"""
WITH u AS (SELECT page_id, url, sha256(coalesce(html, '')) AS digest, length(coalesce(html, '')) AS size,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^https?://(www\.)?', '', 'i') AS bare FROM pages),
c AS (SELECT *, '"' || substr(digest, 1, 16) || '"' AS etag,
    lower(regexp_replace(regexp_extract(bare, '^([^/?]*)', 1), ':(80|443)$', ''))
    || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS front,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|gclid|fbclid|ref)=', 'i'))), '&') AS asked FROM u),
k AS (SELECT *, front || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END AS canonical_url FROM c),
r AS (SELECT page_id * 3 AS rid, canonical_url, page_id * 2 AS time, etag, digest, size FROM k),
v AS (SELECT page_id * 3 + 1 AS record_id, canonical_url, page_id * 2 + 1 AS time, page_id * 2 + 1 AS said, etag AS tag, NULL AS own, 'max-age=60' AS cache FROM k
  UNION ALL SELECT page_id * 3 + 2, canonical_url, page_id * 2 + 86400, page_id * 2,
    CASE page_id % 4 WHEN 0 THEN etag WHEN 1 THEN '"other"' END, CASE WHEN page_id % 4 = 2 THEN digest END, NULL FROM k),
m AS (SELECT v.*, r.rid, r.etag, r.digest, r.size, row_number() OVER (PARTITION BY record_id ORDER BY r.time DESC, r.rid DESC) AS n
  FROM v LEFT JOIN r ON r.canonical_url = v.canonical_url AND r.time <= v.time),
s AS (SELECT *, CASE WHEN rid IS NULL THEN 'missing' WHEN tag IS NULL AND own IS NULL THEN 'unverified'
  WHEN coalesce(tag = etag, own = digest) THEN 'resolved' ELSE 'mismatch' END AS status FROM m WHERE n = 1)
SELECT record_id, canonical_url, time, CASE WHEN status IN ('resolved', 'unverified') THEN rid END AS refers_to, status,
  CASE WHEN status IN ('resolved', 'unverified') THEN digest END AS digest,
  CASE WHEN status IN ('resolved', 'unverified') THEN
    coalesce('cache-control: ' || cache || chr(10), '') || 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10)
    || 'date: ' || said || chr(10) || 'etag: ' || CASE WHEN record_id % 3 = 2 AND tag IS NOT NULL THEN 'W/' ELSE '' END || coalesce(tag, etag)
    || chr(10) || 'server: first' END AS headers
FROM s
"""


@query("op5_html_extraction")
def main_text(spark, folder):
    return html_crf.extract(table(spark, folder, "pages"))


@query("op6_warc_revisits", OP6_SQL)
def revisits(spark, folder):
    found = warc.resolve_revisits(warc.captures(table(spark, folder, "pages")))
    lines = F.transform(F.array_sort(F.map_keys("headers")), lambda k: F.concat(k, F.lit(": "), F.element_at("headers", k)))
    return found.withColumn("headers", F.array_join(lines, "\n"))
