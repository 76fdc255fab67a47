"""WARC: resolution of not-modified revisits.

A crawl's 304 answer says that the page is what an earlier full answer held.  Each revisit is joined as-of,
by canonical URL, with the latest full response captured strictly before it.  The revisit's validators are checked
against that response's (an entity tag, compared weakly, before a last-modified date), and where they agree the
stored headers are renewed by those the revisit carries, as far as RFC 9111 3.2 permits.

The as-of join has two levels, so that a URL with a third of all records does not meet in one task: within
(URL, slice of time) a running maximum finds the last response, and each slice's last one is carried on over the
URL's slices, a table of one row per URL and slice.  Only headers move, never payloads.

outcome: resolved, mismatch (validators differ), no_validator (the revisit has none that the response
has, too), no_response (nothing earlier; also for a null URL or time).  Equal times do not count as
earlier; of responses at one time the greatest record_id counts.  Repeated revisits are answered each.
Null headers count as none and null values as empty.  Header names are compared in lower case; values of names that differ in case only
are joined by commas, in byte order (RFC 9110 5.3).  Equal URLs with a third of all records are split by time; empty URLs are one URL.
An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shuffle_partitions

#: Headers that a 304 answer never renews (RFC 9110 7.6.1, RFC 9111 3.1 and 3.2).
KEPT = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te",
    "trailer", "transfer-encoding", "upgrade",
]
#: Query parameters that do not choose the page.
TRACKING = r"^(utm_[a-z]+|ref|sessionid|phpsessid|jsessionid|sid|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Scheme, user, default port, www., fragment, tracking parameters and a final slash go; host lower, parameters sorted."""
    plain = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    asked = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.when(F.size(asked) > 0, F.concat(host, path, F.lit("?"), F.array_join(asked, "&"))).otherwise(F.concat(host, path))


def _entries(headers: Column) -> Column:
    """Headers as a sorted list of (name, value), names in lower case and each once."""
    none = F.array().cast("array<struct<k:string,v:string>>")
    listed = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v")))
    listed = F.array_sort(F.coalesce(listed, none))
    names = F.array_distinct(F.transform(listed, lambda e: e["k"]))
    return F.transform(names, lambda n: F.struct(n.alias("k"), F.array_join(F.transform(F.filter(listed, lambda e: e["k"] == n), lambda e: e["v"]), ", ").alias("v")))


def _value(entries: Column, name: str) -> Column:
    return F.get(F.filter(entries, lambda e: e["k"] == name), F.lit(0))["v"]


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """records (record_id, type, url, ts, status, headers) -> a row per revisit: record_id, response_id, outcome, headers."""
    own = records.select("record_id", "type", canonical_url(F.col("url")).alias("page"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.col("status").cast("int").alias("status"), _entries(F.col("headers")).alias("given"))
    is_full = (F.col("type") == "response") & (F.col("status") == 200)
    is_revisit = (F.col("type") == "revisit") & (F.col("status") == 304)
    span = own.agg(F.min("at").alias("a"), F.max("at").alias("b")).first()
    width = max(1, ((span["b"] or 0) - (span["a"] or 0)) // (4 * shuffle_partitions(records.sparkSession)) + 1)
    used = own.filter("page is not null and at is not null").filter(is_full | is_revisit).withColumn("slice", F.floor((F.col("at") - F.lit(span["a"] or 0)) / width))
    full = F.when(is_full, F.struct("at", "record_id", "given"))
    inside = Window.partitionBy("page", "slice").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    near = used.withColumn("near", F.max(full).over(inside)).filter(is_revisit)
    last = used.filter(is_full).groupBy("page", "slice").agg(F.max(F.struct("at", "record_id", "given")).alias("last"))
    # Slices with revisits take what the slices before them hold.
    asked = near.select("page", "slice").distinct().withColumn("last", F.lit(None).cast(last.schema["last"].dataType))
    slices = last.unionByName(asked).groupBy("page", "slice").agg(F.max("last").alias("last"))
    over = Window.partitionBy("page").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("page", "slice", F.max("last").over(over).alias("before"))
    found = near.join(carried, ["page", "slice"], "left").withColumn("full", F.coalesce("near", "before"))

    tag, date = _value(F.col("given"), "etag"), _value(F.col("given"), "last-modified")
    stored_tag, stored_date = _value(F.col("full.given"), "etag"), _value(F.col("full.given"), "last-modified")
    outcome = (
        F.when(F.col("full").isNull(), "no_response")
        .when(tag.isNotNull() & stored_tag.isNotNull(), F.when(_weak(tag) == _weak(stored_tag), "resolved").otherwise("mismatch"))
        .when(date.isNotNull() & stored_date.isNotNull(), F.when(date == stored_date, "resolved").otherwise("mismatch"))
        .otherwise("no_validator")
    )
    renewed = F.filter("given", lambda e: ~e["k"].isin(KEPT))
    names = F.transform(renewed, lambda e: e["k"])
    stays = F.filter("full.given", lambda e: ~F.array_contains(names, e["k"]))
    merged = F.array_sort(F.concat(stays, renewed))
    answered = found.select(
        "record_id",
        F.col("full.record_id").alias("response_id"),
        outcome.alias("outcome"),
        F.when(outcome == "resolved", F.map_from_entries(merged)).alias("headers"),
    )
    lost = own.filter(is_revisit & (F.col("page").isNull() | F.col("at").isNull()))
    none = lost.select("record_id", F.lit(None).cast(answered.schema["response_id"].dataType).alias("response_id"), F.lit("no_response").alias("outcome"), F.lit(None).cast("map<string,string>").alias("headers"))
    return answered.unionByName(none)


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl derived from the pages table: a full response for each page, and later a not-modified answer to it.

    Every fifth answer carries a date in place of an entity tag, every eleventh no validator.
    """
    at = F.lit(1_704_067_200) + F.col("page_id") * 10
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.col("html")), 1, 16), F.lit('"'))
    date = F.concat(F.lit("day "), (F.col("page_id") % 97).cast("string"))
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("type"), "url", F.timestamp_seconds(at).alias("ts"), F.lit(200).alias("status"),
        F.create_map(
            F.lit("ETag"), tag, F.lit("Last-Modified"), date, F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Content-Length"), F.octet_length("html").cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"),
        ).alias("headers"),
    )
    empty = F.create_map(F.lit("Cache-Control"), F.concat(F.lit("max-age="), (F.col("page_id") % 13).cast("string")), F.lit("Content-Length"), F.lit("0"))
    check = F.when(F.col("page_id") % 11 == 0, empty).when(F.col("page_id") % 5 == 0, F.map_concat(empty, F.create_map(F.lit("Last-Modified"), date))).otherwise(F.map_concat(empty, F.create_map(F.lit("ETag"), F.concat(F.lit("W/"), tag))))
    again = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("type"), "url",
        F.timestamp_seconds(at + 5 + (F.col("page_id") % 7) * 400).alias("ts"), F.lit(304).alias("status"), check.alias("headers"),
    )
    return full.unionByName(again)
