"""Resolution of not-modified revisit records.

A revisit says that a page had not changed since an earlier capture. It is joined as of its time to the latest earlier
full response of the same canonical URL; its validators are checked against that response, and the headers that a
not-modified answer may update are merged into the response's. Records are range-partitioned by (URL, time); each
range is filled forward on its own, and what a range needs from before comes from one row per URL and range, so a
URL with a third of all records spreads over many tasks.
"""
from pyspark.sql import DataFrame, Window, functions as F

from opsloom.llm.common import settled

# Fixed value: headers that a not-modified answer may update.
UPDATES = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# Query parameters that only track visitors.
TRACKING = r"(?i)^(utm_[a-z]+|gclid|fbclid|ref)="


def canonical_url(url):
    """Scheme and www dropped, host in lower case, default port, fragment, tracking parameters and the final slash removed, the
    other parameters sorted. Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^(?i)https?://(www\.)?", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(bare, r"^([^/?]*)", 1), r":(80|443)$", ""))
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    return F.concat(host, path, F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(asked), "&"))).otherwise(F.lit("")))


def as_of(records: DataFrame, key: str, time: str, order: str, is_source, carried) -> DataFrame:
    """Add `source`: the struct `carried` of the last row before each row, by (time, sources first, order), that has the
    same key and is a source. A source does not see itself. Rows with a null key or time see none and are seen by none."""
    ranks = [key, time, "_late", order]
    ranged = settled(
        records.withColumn("_late", ~is_source).withColumn("_own", F.when(is_source & F.col(key).isNotNull() & F.col(time).isNotNull(), carried))
        .repartitionByRange(*ranks).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy(key, "_part").orderBy(time, "_late", order)
    filled = ranged.withColumn("_near", F.last("_own", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    last = ranged.where("_own IS NOT NULL").groupBy(key, "_part").agg(F.max_by("_own", F.struct(time, order)).alias("_end"))
    parts = ranged.select(key, "_part").distinct().join(last, [key, "_part"], "left")
    before = parts.select(F.col(key).alias("_key"), F.col("_part").alias("_p"), F.last("_end", ignorenulls=True).over(
        Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    return (filled.join(before, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_p")), "left")
            .withColumn("source", F.when(F.col(time).isNotNull(), F.coalesce("_near", "_before")))
            .drop("_late", "_own", "_part", "_near", "_key", "_p", "_before"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Resolve the revisits among records (record_id, type, url, time, headers map, digest).

    Returns per revisit: record_id, canonical_url, time, refers_to, status, digest, headers. Status is `resolved`;
    `mismatch` where a validator (ETag without its weak mark, else the modification time, else the digest) differs from the latest
    earlier response; `unverified` where the revisit or the response has no validator to compare; `missing` without an earlier
    response. Only resolved and unverified revisits get the response's digest and merged headers; null headers count as none.
    At equal times responses come first; of equal responses the greatest record_id is the latest. Repeated rows stay.
    """
    rows = records.select("record_id", "type", canonical_url(F.col("url")).alias("canonical_url"), "time",
                          F.coalesce("headers", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("headers"), "digest")
    source = F.struct("record_id", "headers", "digest")
    found = as_of(rows, "canonical_url", "time", "record_id", F.col("type") == "response", source).where("type = 'revisit'")
    tag = lambda headers: F.regexp_replace(F.element_at(headers, "etag"), "^W/", "")
    old = F.col("source.headers")
    checks = [(tag(F.col("headers")), tag(old)), (F.element_at("headers", "last-modified"), F.element_at(old, "last-modified")), (F.col("digest"), F.col("source.digest"))]
    agrees = F.coalesce(*[F.when(a.isNotNull() & b.isNotNull(), a == b) for a, b in checks])
    status = F.when(F.col("source").isNull(), "missing").when(agrees.isNull(), "unverified").when(agrees, "resolved").otherwise("mismatch")
    allowed = F.map_filter("headers", lambda k, v: k.isin(*UPDATES))
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(allowed, k)), allowed)
    good = F.col("status").isin("resolved", "unverified")
    return found.withColumn("status", status).select(
        "record_id", "canonical_url", "time", F.when(good, F.col("source.record_id")).alias("refers_to"), "status",
        F.when(good, F.col("source.digest")).alias("digest"), F.when(good, merged).alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """Capture records of a table of pages: a full response per page, and two revisits of it under other spellings of its URL.

    The first revisit comes soon after and repeats the ETag; the second comes much later, when a page of the same canonical URL
    may have been captured again, and has, by page_id, the ETag, another one, only the digest, or no validator.
    """
    day = 86_400
    digest = F.sha2(F.coalesce(F.col("html").cast("string"), F.lit("")), 256)
    etag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    base = pages.select("page_id", "url", digest.alias("digest"), etag.alias("etag"), F.length(F.coalesce("html", F.lit(""))).alias("size"))

    def headers(**values):
        return F.map_from_arrays(F.array(*[F.lit(k.replace("_", "-")) for k in values]), F.array(*[v.cast("string") for v in values.values()]))

    page = F.col("page_id")
    known = F.map_filter(headers(date=page * 2, etag=F.when(page % 4 == 0, F.concat(F.lit("W/"), F.col("etag"))).when(page % 4 == 1, F.lit('"other"')),
                                 server=F.lit("late")), lambda k, v: v.isNotNull())
    return base.select(
        (page * 3).alias("record_id"), F.lit("response").alias("type"), "url", (page * 2).alias("time"),
        headers(content_type=F.lit("text/html"), content_length=F.col("size"), date=page * 2, etag=F.col("etag"), server=F.lit("first")).alias("headers"), "digest",
    ).union(base.select(
        page * 3 + 1, F.lit("revisit"), F.concat(F.regexp_replace("url", "^http:", "https:"), F.lit("#again")), page * 2 + 1,
        headers(date=page * 2 + 1, etag=F.col("etag"), cache_control=F.lit("max-age=60"), server=F.lit("late")), F.lit(None).cast("string"),
    )).union(base.select(
        page * 3 + 2, F.lit("revisit"), F.col("url"), page * 2 + day, known, F.when(page % 4 == 2, F.col("digest"))))
