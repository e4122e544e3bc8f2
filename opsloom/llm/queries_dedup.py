"""Queries on whole documents: exact and near copies, repeated passages."""
from pyspark.sql import functions as F

from opsloom.llm import exact_dedup as exact, repeats, simhash
from opsloom.llm.common import table
from opsloom.llm.queries import query

OP4_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


@query("op4_exact_dedup", OP4_SQL)
def exact_copies(spark, folder):
    return exact.exact_groups(table(spark, folder, "documents")).drop("text_hash")


@query("op7_simhash_golay")
def near_copies(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_repeated_passages")
def repeated_passages(spark, folder):
    return repeats.repeats(table(spark, folder, "documents"))
