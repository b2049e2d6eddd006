"""WARC not-modified revisits: as-of join by canonical URL to the latest earlier full response.

Records: record_id, kind ('response' or 'revisit'), url, ts, status, etag, last_modified, digest,
headers (array of (name, value)), body. The as-of join is a running maximum in time order over the records' validators, in
parts of each canonical URL's timeline; headers and bodies join afterwards, by record id, those that resolved
revisits refer to only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm._common import checkpoint

TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid|sid|sessionid|phpsessid)="
#: Fields of a stored response that a 304 must not replace: framing, representation and connection.
KEPT = ("content-length", "content-encoding", "content-type", "content-range", "transfer-encoding", "connection", "keep-alive", "te", "trailer", "upgrade", "proxy-authenticate", "proxy-authorization")
HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """Lower-case host without www, scheme, default port and fragment; path without index page and closing slash; sorted parameters without tracking."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, "^[^/?]*", 0)), "^www[0-9]*\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/(index\\.(html?|php))?$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(rest, "\\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def _validated(a: str, b: str) -> Column:
    """Whether the validators of ``a`` and ``b`` agree, by the strongest that both have; null if they share none."""
    both = lambda f: F.col(f"{a}.{f}").isNotNull() & F.col(f"{b}.{f}").isNotNull()
    same = lambda f: F.col(f"{a}.{f}") == F.col(f"{b}.{f}")
    return F.when(both("etag"), _weak(F.col(f"{a}.etag")) == _weak(F.col(f"{b}.etag"))).when(both("last_modified"), same("last_modified")).when(both("digest"), same("digest"))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Stored fields, with those that the 304 sends and may change replaced by its own; names compare without case."""
    name = lambda e: F.lower(e["name"])
    fresh = F.filter(F.coalesce(fresh, F.array().cast(HEADERS)), lambda e: e["name"].isNotNull() & ~name(e).isin(*KEPT))
    names = F.transform(fresh, name)
    stored = F.filter(F.coalesce(stored, F.array().cast(HEADERS)), lambda e: e["name"].isNotNull() & ~F.array_contains(names, name(e)))
    lines = F.transform(F.concat(stored, fresh), lambda e: F.concat(name(e), F.lit(": "), F.coalesce(e["value"], F.lit(""))))
    return F.array_join(F.array_sort(lines), "\n")


#: Seconds of one part of a URL's timeline.
STEP = 3600


def resolve_revisits(records: DataFrame, broadcast_limit: int = 500_000) -> DataFrame:
    """(record_id, url, state, refers_to, headers, body) of every revisit.

    A full response has status 200 and a body. state: 'resolved'; 'mismatch' if the latest earlier full
    response has other validators (older ones are not tried: the server compared with the latest);
    'unverifiable' if the two share no kind of validator; 'missing' without an earlier full response, or
    for a null url or ts. Earlier is strict; of responses at one time the largest record_id counts. Only
    resolved rows have refers_to, headers and body. Repeated rows give repeated results, of repeated
    responses the one with the greatest body (then headers); empty urls join with each other; null headers are none. Bodies of any length
    pass through whole. Extra columns are ignored whatever their names. An empty table gives an empty result.

    The timeline of a URL is cut into parts of STEP seconds, each with its last full response, so that a URL with a large share of all
    records (robots.txt) isn't one task. Only validators go through the windows; headers and bodies join afterwards by record id, and of
    these only such as are referred to: by broadcast of the ids up to ``broadcast_limit`` of them, beyond it by a shuffled join.
    """
    r = records.select("record_id", "kind", "url", F.col("ts").cast("bigint").alias("ts"), "status", "etag", "last_modified", "digest", F.col("headers").cast(HEADERS).alias("headers"), "body")
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False)) & F.col("body").isNotNull()
    own = F.struct("ts", "record_id", "etag", "last_modified", "digest")
    meta = r.select("record_id", "kind", canonical_url(F.col("url")).alias("url"), "ts", own.alias("own"), full.alias("full"), F.when(F.col("kind") == "revisit", F.col("headers")).alias("fresh")).where("full or kind = 'revisit'")
    meta = checkpoint(meta.withColumn("part", F.floor(F.col("ts") / STEP)))
    known = meta.where("url is not null and ts is not null")
    lost = meta.where("kind = 'revisit' and (url is null or ts is null)").withColumn("was", F.lit(None).cast(meta.schema["own"].dataType))
    # the last full response of each part, carried on to the parts behind it
    parts = known.groupBy("url", "part").agg(F.max(F.when(F.col("full"), F.col("own"))).alias("last"))
    carried = parts.withColumn("before", F.max("last").over(Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select(F.col("url").alias("of_url"), F.col("part").alias("of_part"), "before")
    earlier = Window.partitionBy("url", "part").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    inside = known.withColumn("inside", F.max(F.when(F.col("full"), F.col("own"))).over(earlier)).where("kind = 'revisit'")
    found = inside.join(carried, (F.col("url") == F.col("of_url")) & (F.col("part") == F.col("of_part")), "left").withColumn("was", F.coalesce("inside", "before"))
    cols = ["record_id", "url", "own", "was", "fresh"]
    found = found.select(cols).unionByName(lost.select(cols))
    ok = _validated("own", "was")
    state = F.when(F.col("was").isNull(), "missing").when(ok.isNull(), "unverifiable").when(ok, "resolved").otherwise("mismatch")
    found = checkpoint(found.withColumn("state", state).select("record_id", "url", "state", F.when(F.col("state") == "resolved", F.col("was.record_id")).alias("refers_to"), "fresh"))
    wanted = found.where("refers_to is not null").select(F.col("refers_to").alias("record_id")).distinct()
    stored = r.where(full).select("record_id", "body", "headers").join(F.broadcast(wanted) if wanted.count() <= broadcast_limit else wanted, "record_id", "left_semi")
    stored = stored.groupBy(F.col("record_id").alias("stored_id")).agg(F.max(F.struct("body", "headers")).alias("stored"))
    j = found.join(stored, found["refers_to"] == stored["stored_id"], "left")
    return j.select("record_id", "url", "state", "refers_to", F.when(F.col("refers_to").isNotNull(), merged_headers(F.col("stored.headers"), F.col("fresh"))).alias("headers"), F.col("stored.body").alias("body"))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """The crawl that the pages stand for: each is a full response, visited again later (and a fifth of them also
    before), under a variant of its url; a seventh of the later visits carries the validators of another version. By page_id, of eleven
    visits one is validated by its date alone, one by its digest, and one not at all."""
    at = F.lit(1_700_000_000) + F.col("page_id") * 60
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    changed = F.col("page_id") % 7 == 0
    by = F.col("page_id") % 11
    h = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    base = pages.select("page_id", "url", "html")
    response = base.select(
        (F.col("page_id") * 4).alias("record_id"), F.lit("response").alias("kind"), "url", at.alias("ts"), F.lit(200).alias("status"),
        tag.alias("etag"), at.cast("string").alias("last_modified"), F.md5("html").alias("digest"),
        F.array(h("Content-Type", F.lit("text/html")), h("ETag", tag), h("Cache-Control", F.lit("max-age=60")), h("Content-Length", F.length("html").cast("string"))).alias("headers"), F.col("html").alias("body"),
    )

    def revisit(k: int, when: Column, rows: Column) -> DataFrame:
        url = F.concat(F.regexp_replace("url", "^https?://", "HTTP://www."), F.when(F.col("url").contains("#"), "").when(F.col("url").contains("?"), "&utm_medium=x").otherwise("?utm_medium=x"))
        etag = F.when(by.isin(1, 2, 3), F.lit(None)).otherwise(F.when(changed, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag)))
        date = F.when(by == 1, F.when(changed, F.lit("0")).otherwise(at.cast("string")))
        digest = F.when(by == 2, F.when(changed, F.lit("0")).otherwise(F.md5("html")))
        return base.where(rows).select(
            (F.col("page_id") * 4 + k).alias("record_id"), F.lit("revisit").alias("kind"), url.alias("url"), when.alias("ts"), F.lit(304).alias("status"), etag.alias("etag"), date.alias("last_modified"), digest.alias("digest"),
            F.array(h("cache-control", F.lit("max-age=90")), h("Date", when.cast("string")), h("Content-Length", F.lit("0"))).alias("headers"), F.lit(None).cast("string").alias("body"),
        )

    return response.unionByName(revisit(1, at + 86400, F.lit(True))).unionByName(revisit(2, at - 30, F.col("page_id") % 5 == 0))


def _canonical_sql(u: str) -> str:
    rest = f"regexp_replace(regexp_replace(trim({u}), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    query = f"list_sort(list_filter(string_split(regexp_extract({rest}, '\\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '{TRACKING}')))"
    return (
        f"regexp_replace(regexp_replace(lower(regexp_extract({rest}, '^[^/?]*', 0)), '^www[0-9]*\\.', ''), ':(80|443)$', '')"
        f" || regexp_replace(regexp_extract({rest}, '^[^/?]*([^?]*)', 1), '/(index\\.(html?|php))?$', '')"
        f" || CASE WHEN len({query}) > 0 THEN '?' || array_to_string({query}, '&') ELSE '' END"
    )


def revisits_sql() -> str:
    other = "CASE WHEN page_id % 7 = 0 THEN '0' ELSE {} END"
    return f"""
WITH b AS (SELECT page_id, url, html, 1700000000 + page_id * 60 AS t0, '"' || md5(html) || '"' AS tag, md5(html) AS digest FROM pages),
resp AS (SELECT page_id * 4 AS record_id, {_canonical_sql("url")} AS url, t0 AS ts, tag AS etag, t0::VARCHAR AS date, digest, html FROM b),
v AS (SELECT *, regexp_replace(url, '^https?://', 'HTTP://www.') || CASE WHEN contains(url, '#') THEN '' WHEN contains(url, '?') THEN '&utm_medium=x' ELSE '?utm_medium=x' END AS u2,
      CASE WHEN page_id % 11 NOT IN (1, 2, 3) THEN CASE WHEN page_id % 7 = 0 THEN '"other"' ELSE tag END END AS seen,
      CASE WHEN page_id % 11 = 1 THEN {other.format("t0::VARCHAR")} END AS seen_date, CASE WHEN page_id % 11 = 2 THEN {other.format("digest")} END AS seen_digest FROM b),
rev AS (SELECT page_id * 4 + 1 AS record_id, u2, t0 + 86400 AS ts, seen, seen_date, seen_digest FROM v UNION ALL SELECT page_id * 4 + 2, u2, t0 - 30, seen, seen_date, seen_digest FROM v WHERE page_id % 5 = 0),
r AS (SELECT record_id, {_canonical_sql("u2")} AS url, ts, seen, seen_date, seen_digest FROM rev),
j AS (SELECT r.*, resp.record_id AS was, resp.etag, resp.html, coalesce(etag = seen, date = seen_date, digest = seen_digest) AS ok,
      row_number() OVER (PARTITION BY r.record_id ORDER BY resp.ts DESC, resp.record_id DESC) AS k FROM r LEFT JOIN resp ON resp.url = r.url AND resp.ts < r.ts)
SELECT record_id, url, CASE WHEN was IS NULL THEN 'missing' WHEN ok IS NULL THEN 'unverifiable' WHEN ok THEN 'resolved' ELSE 'mismatch' END AS state,
  CASE WHEN ok THEN was END AS refers_to,
  CASE WHEN ok THEN 'cache-control: max-age=90' || chr(10) || 'content-length: ' || length(html) || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts || chr(10) || 'etag: ' || etag END AS headers,
  CASE WHEN ok THEN html END AS body
FROM j WHERE k = 1
"""
