"""Not-modified revisit resolution for web archive records.

A revisit has headers, but no body. It is resolved by an as-of join: the latest response of the same canonical URL
before it (of equal time: of a lesser record id). Its validators are checked: the entity tag, compared weakly, if both
have one, else the time of last modification, else nothing contradicts. If they agree, the stored headers are updated
by those of the revisit that an update may change; headers about the body stay the stored ones.

Only a full response can stand for a revisit: one whose status (of the optional column http_status) is 200, 203 or
unknown, and that isn't marked as truncated (header WARC-Truncated). A stored 206, 304 or 5xx is passed over.

A URL may hold any share of the records: records are ranged by time into slices, more of them the more records there
are, the join looks within (URL, slice), and only the last response of each URL and slice is carried on to later slices.

Odd inputs: null URLs are matched with nothing; null times come first; null header maps are empty; records of other
kinds than response and revisit are left out; repeated rows are resolved alike, each to the same response; other columns,
whatever their names, are left out; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of time: one for so many records, at least and at most so many.
SLICE_ROWS, LEAST_SLICES, MOST_SLICES = 10_000, 64, 4096
#: Status codes of responses that hold the whole body.
FULL = [200, 203]
#: Headers that a not-modified response never updates.
KEPT_HEADERS = ["connection", "content-encoding", "content-length", "content-location", "content-md5", "content-range", "content-type", "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade"]


def canonical_url(url: Column) -> Column:
    """Lower-case host without www and default port, no scheme, user, fragment or tracking parameters, parameters sorted, no final slash or index page."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^(?i)[a-z][a-z0-9+.-]*://(?:[^/?@]*@)?", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(?:80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/index\.html?$", "/"), r"/+$", "")
    query = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    query = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(r"^(?i)(?:utm_[a-z]+|fbclid|gclid|sessionid)(?:=|$)")))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def _lowered(headers: Column) -> Column:
    """Header names in lower case; of names that fall together the last stays."""
    entries = F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), e["value"].alias("value"), i.alias("i"))), lambda e: ~F.exists(F.slice(entries, e["i"] + 2, F.size(entries)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored headers, with those of the update that it may change."""
    permitted = F.map_filter(update, lambda k, _: ~k.isin(KEPT_HEADERS))
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.map_contains_key(permitted, k)), permitted)


def validators_agree(stored: Column, update: Column) -> Column:
    tag = lambda h: F.regexp_replace(h["etag"], r"^\s*W/", "")
    modified = "last-modified"
    return F.when(stored["etag"].isNotNull() & update["etag"].isNotNull(), tag(stored) == tag(update)).when(stored[modified].isNotNull() & update[modified].isNotNull(), stored[modified] == update[modified]).otherwise(True)


def resolve(records: DataFrame) -> DataFrame:
    """For each revisit of (record_id, kind, url, time, headers[, http_status]): record_id, url_key, resolved_id, resolved_time, status, headers.

    status: resolved; validator_mismatch (the latest response is another version); no_response. Unresolved revisits
    have a null resolved_id and their own headers.
    """
    slices = max(LEAST_SLICES, min(MOST_SLICES, records.count() // SLICE_ROWS))
    fractions = ", ".join(str(i / slices) for i in range(1, slices))
    bounds = records.agg(F.expr(f"percentile_approx(time, array({fractions}), {10 * slices})")).first()[0] or []
    edges = F.array(*[F.lit(b) for b in sorted(set(bounds))]) if bounds else F.array().cast("array<long>")
    status = F.col("http_status") if "http_status" in records.columns else F.lit(None).cast("int")
    rows = records.where(F.col("kind").isin("response", "revisit")).select("record_id", "kind", canonical_url(F.col("url")).alias("url_key"), "time", _lowered(F.col("headers")).alias("headers"), F.coalesce(status.isin(FULL), F.lit(True)).alias("whole"))
    rows = rows.withColumn("whole", F.col("whole") & F.col("headers")["warc-truncated"].isNull())
    rows = rows.withColumn("slice", F.coalesce(F.size(F.filter(edges, lambda b: b <= F.col("time"))), F.lit(-1)))
    full = F.when((F.col("kind") == "response") & F.col("whole") & F.col("url_key").isNotNull(), F.struct("time", "record_id", "headers"))
    inside = Window.partitionBy("url_key", "slice").orderBy("time", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("near", F.last(full, ignorenulls=True).over(inside)).where("kind = 'revisit'")
    lasts = rows.where(full.isNotNull()).groupBy("url_key", "slice").agg(F.max_by(F.struct("time", "record_id", "headers"), F.struct("time", "record_id")).alias("own"))
    wanted = near.where("near IS NULL AND url_key IS NOT NULL").select("url_key", "slice").distinct()
    before = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.join(wanted.withColumn("asked", F.lit(True)), ["url_key", "slice"], "full").withColumn("far", F.last("own", ignorenulls=True).over(before)).where("asked AND far IS NOT NULL").select("url_key", "slice", "far")
    met = near.join(carried, ["url_key", "slice"], "left").withColumn("found", F.coalesce("near", "far"))
    agree = validators_agree(F.col("found.headers"), F.col("headers"))
    status = F.when(F.col("found").isNull(), "no_response").when(agree, "resolved").otherwise("validator_mismatch")
    met = met.withColumn("status", status)
    done = F.col("status") == "resolved"
    return met.select("record_id", "url_key", F.when(done, F.col("found.record_id")).alias("resolved_id"), F.when(done, F.col("found.time")).alias("resolved_time"), "status", F.when(done, merged_headers(F.col("found.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"))
