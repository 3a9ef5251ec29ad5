"""Not-modified revisits in web archives: an as-of join to the latest earlier full response.

A revisit record says that a URL had not changed and holds no body. It is resolved by the canonical URL
to the latest full response strictly before it; of responses at one time the one with the greatest id
counts. Their validators are compared: where both have an entity tag, a modification date or a payload
digest, all that both have must agree. A resolved revisit takes the response's headers with those
headers of its own that a 304 may update.

Moments, the distinct (URL, time) pairs with the response that counts there, are put in order over the
whole cluster by sampled quantiles of (URL, time). Each partition of that order is a bucket, so a URL
with a third of all records spreads over many buckets wherever its times lie, and a stray time makes no
bucket large. Within a (URL, bucket) a running maximum finds the earlier response; the last response of
each bucket is carried to the next over a table with one row per URL and bucket. Records at one moment
combine before anything is moved.

Records without URL or time are never resolved to, and as revisits are "unresolved"; responses without
id are never resolved to. Null header maps count as empty. Repeated records each get their own row. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import staged

#: Headers that a 304 response updates.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't change a page.
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid|sessionid)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without "www." and default port, path without trailing slash, query without tracking
    parameters; scheme and fragment go. Null where there is no "://"."""
    parts = r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)\??([^#]*)"
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(url, parts, 1)), r"^www\.", ""), r":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(url, parts, 2), r"/+$", "")
    query = F.concat(F.lit("&"), F.regexp_extract(url, parts, 3))
    query = F.regexp_replace(F.regexp_replace(query, rf"&{TRACKING}=[^&]*", ""), "^&", "")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), whole)


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve_revisits(records: DataFrame, *, buckets: int | None = None) -> DataFrame:
    """Resolve the revisits among records (record_id long, url string, at long, revisit boolean,
    headers map of lower-case names, digest string).

    Returns for every revisit: record_id, canonical, at, response_id, verdict, digest, headers. The
    verdict is "resolved", "changed" (a validator disagrees), "unverified" (none in common) or
    "unresolved" (no earlier response); the last has null response_id, and only "resolved" has digest
    and headers.
    """
    rows = staged(
        records.select(
            "record_id",
            canonical_url(F.col("url")).alias("canonical"),
            "at",
            F.coalesce("revisit", F.lit(False)).alias("revisit"),
            F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
            "digest",
        ),
        "warc-records",
    )
    wanted = buckets or max(8, rows.count() // 100_000)
    known = rows.where(F.col("canonical").isNotNull() & F.col("at").isNotNull())
    moments = known.groupBy("canonical", "at").agg(F.max(F.when(~F.col("revisit"), F.col("record_id"))).alias("id"), F.max("revisit").alias("asked"))
    moments = staged(moments.repartitionByRange(wanted, "canonical", "at").withColumn("bucket", F.spark_partition_id()), "warc-moments")

    response = F.when(F.col("id").isNotNull(), F.struct("at", F.col("id").alias("record_id")))
    before = Window.partitionBy("canonical").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = moments.groupBy("canonical", "bucket").agg(F.max(response).alias("last")).select("canonical", "bucket", F.max("last").over(before).alias("carried"))
    inside = Window.partitionBy("canonical", "bucket").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    found = (
        moments.withColumn("within", F.max(response).over(inside))
        .where("asked")
        .join(carried, ["canonical", "bucket"])
        .select("canonical", "at", F.coalesce("within", "carried").alias("r"))
        .where("r is not null")
        .select("canonical", "at", F.col("r.record_id").alias("response_id"), F.col("r.at").alias("response_at"))
    )
    revisits = rows.where("revisit").join(found, ["canonical", "at"], "left")
    responses = known.where(~F.col("revisit")).select(
        F.col("canonical").alias("canonical_"),
        F.col("record_id").alias("response_id"),
        F.col("at").alias("response_at"),
        F.col("headers").alias("stored"),
        F.col("digest").alias("stored_digest"),
    )
    # of different responses with one id, URL and time the one with the greatest hash counts
    order = F.xxhash64(F.array_sort(F.map_entries("stored")), "stored_digest")
    responses = responses.groupBy("canonical_", "response_id", "response_at").agg(
        F.max_by(F.struct("stored", "stored_digest"), order).alias("s")
    ).select("canonical_", "response_id", "response_at", "s.*")
    both = revisits.join(
        responses.withColumnRenamed("response_id", "_id").withColumnRenamed("response_at", "_at"),
        (F.col("canonical") == F.col("canonical_")) & (F.col("response_id") == F.col("_id")) & (F.col("response_at") == F.col("_at")),
        "left",
    )
    checks = F.filter(
        F.array(
            _tag(F.col("headers")) == _tag(F.col("stored")),
            F.col("headers")["last-modified"] == F.col("stored")["last-modified"],
            F.col("digest") == F.col("stored_digest"),
        ),
        lambda c: c.isNotNull(),
    )
    verdict = (
        F.when(F.col("response_id").isNull(), "unresolved")
        .when(F.size(checks) == 0, "unverified")
        .when(F.forall(checks, lambda c: c), "resolved")
        .otherwise("changed")
    )
    updates = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    kept = F.map_filter("stored", lambda k, v: ~F.array_contains(F.map_keys(updates), k))
    done = F.col("verdict") == "resolved"
    return both.withColumn("verdict", verdict).select(
        "record_id",
        "canonical",
        "at",
        "response_id",
        "verdict",
        F.when(done, F.coalesce("stored_digest", "digest")).alias("digest"),
        F.when(done, F.map_concat(kept, updates)).alias("headers"),
    )


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records made from a table of pages (page_id, url, html).

    A page is a full response at twice its id, with the digest of its html as entity tag. A crawler
    comes back at 1 + 2 * (page_id * 7919 % 1009) time units later and gets a 304 with that tag, new
    caching headers, and a Content-Length that a 304 may not update.
    """
    digest = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", digest.alias("digest"))
    at = F.col("page_id") * 2
    back = at + 1 + F.expr("page_id * 7919 % 1009") * 2
    one = lambda *kv: F.create_map(*(F.lit(x) if isinstance(x, str) else x for x in kv))
    tag = F.concat(F.lit('"'), "digest", F.lit('"'))
    full = F.struct(
        F.col("page_id").alias("record_id"), at.alias("at"), F.lit(False).alias("revisit"),
        one("content-type", "text/html", "etag", tag, "date", at.cast("string"), "cache-control", "max-age=60").alias("headers"), F.col("digest").alias("digest"),
    )
    again = F.struct(
        F.col("page_id").alias("record_id"), back.alias("at"), F.lit(True).alias("revisit"),
        one("content-length", "0", "etag", F.concat(F.lit("W/"), tag), "date", back.cast("string"), "cache-control", "max-age=600").alias("headers"), F.lit(None).cast("string").alias("digest"),
    )
    return page.select("url", F.explode(F.array(full, again)).alias("r")).select("url", "r.*")
