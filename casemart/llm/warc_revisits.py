"""Resolution of "not modified" revisit records to the full response they refer to.

A revisit holds no body: it says that a URL still had what an earlier capture holds. It is joined as of its time with the latest earlier
full response (status 200 with a body) of the same canonical URL. Validators are then checked: entity tags must be equal where both
have one, else last-modified dates where both have one; without a common validator the revisit counts as unchecked. A resolved record
takes the response's body and headers, with those header fields of the revisit put over them that a "304 Not Modified" answer may update.

outcome: `resolved`, `unchecked` (resolved without a common validator), `mismatch` or `no_response`; the last two have no body.

Scale. The as-of join has three levels: the last full response of each second (of 4,096 ids where there is no time) is combined before the shuffle and carried over
the seconds of a day and over days, one row for each; within a second a window looks at light columns only. A URL with a third of all captures, also all on
one day or without a time, is thus spread; what stays in one task are one URL's captures of one second, and without a time also those without an integer id.
Full responses and revisits are stored once with a number each; bodies move once, in an equi-join on the number that was found.

Edge cases. A null or unparsable URL never matches. Records at the same time are ordered by record id; null times and null ids
come last. Every revisit row gives one row, also with a null or repeated id; of responses with equal time and id one is taken. Null headers count as none, null
validators as absent; null bodies are no full responses. Header names are compared in lower case. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemart.llm.storage import Scratch

#: Header fields that a 304 answer may update (RFC 9110, 15.4.5), and query parameters that only track.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = r"^(utm_[a-z]+|ref|gclid|fbclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without `www.` and default port, path without trailing slash, sorted query without tracking; no scheme or fragment."""
    bare = F.regexp_replace(url, r"#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[A-Za-z]+://([^/?]*)", 1)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z]+://[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row for each revisit of `records` (record_id, url, captured_at, kind, status, headers, body).

    `kind` is `response` or `revisit`; `headers` is a map of strings with lower-case names. Runs a job. Result: record_id, canonical_url, response_id,
    outcome, headers and body.
    """
    scratch = Scratch(records.sparkSession, "revisits")
    headers = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    is_full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200) & F.col("body").isNotNull(), F.lit(False))
    is_revisit = F.coalesce(F.col("kind") == "revisit", F.lit(False))
    rows = scratch.store(records.where(is_full | is_revisit).select(
        F.monotonically_increasing_id().alias("row"), "record_id", canonical_url(F.col("url")).alias("canonical_url"), "captured_at",
        is_full.alias("full"), headers.alias("headers"), F.when(is_full, F.col("body")).alias("body")), "rows")
    light = rows.select(
        "row", "record_id", "canonical_url", "captured_at", "full", F.col("headers")["etag"].alias("etag"), F.col("headers")["last-modified"].alias("modified"),
        F.when(~F.col("full"), F.col("headers")).alias("own_headers"))
    # a second of the day, or 4,096 ids where there is no time
    by_id = F.floor(F.col("record_id") / 4096) if isinstance(records.schema["record_id"].dataType, T.IntegralType) else F.lit(None).cast("bigint")
    time = F.hour("captured_at") * 3600 + F.minute("captured_at") * 60 + F.second("captured_at")
    wanted = light.where("canonical_url IS NOT NULL").withColumns({
        "day": F.date_trunc("day", "captured_at"), "slot": F.when(F.col("captured_at").isNotNull(), time.cast("bigint")).otherwise(by_id)})
    # in this order unknown times and ids come last
    response = F.struct(
        F.col("captured_at").isNull().alias("no_time"), "captured_at", F.col("record_id").isNull().alias("no_id"), "record_id", "row", "etag", "modified")
    slots = wanted.groupBy("canonical_url", "day", "slot").agg(F.max(F.when(F.col("full"), response)).alias("latest"))
    days = slots.groupBy("canonical_url", "day").agg(F.max("latest").alias("latest"))

    def before(table: DataFrame, within: list[str], order: str, out: str) -> DataFrame:
        """The latest response of the groups that come earlier, carried to each group."""
        earlier = Window.partitionBy(*within).orderBy(F.col(order).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        return table.withColumn(out, F.last("latest", ignorenulls=True).over(earlier)).drop("latest")

    of_days = before(days, ["canonical_url"], "day", "earlier_day").select(F.col("canonical_url").alias("url"), F.col("day").alias("on_day"), "earlier_day")
    of_slots = before(slots, ["canonical_url", "day"], "slot", "earlier_slot")
    carried = of_slots.join(of_days, (F.col("canonical_url") == F.col("url")) & F.col("day").eqNullSafe(F.col("on_day"))).select(
        "canonical_url", "day", "slot", F.coalesce("earlier_slot", "earlier_day").alias("carried"))
    same_slot = Window.partitionBy("canonical_url", "day", "slot").orderBy(
        F.col("captured_at").asc_nulls_last(), F.col("record_id").asc_nulls_last(), "row").rowsBetween(Window.unboundedPreceding, -1)
    within = wanted.withColumn("within", F.last(F.when(F.col("full"), response), ignorenulls=True).over(same_slot)).where("NOT full")
    found = within.alias("w").join(
        carried.alias("c"), (F.col("w.canonical_url") == F.col("c.canonical_url")) & F.col("w.day").eqNullSafe(F.col("c.day")) & F.col("w.slot").eqNullSafe(F.col("c.slot")),
        "left").select("w.*", F.coalesce("within", "carried").alias("response"))

    tags = F.col("etag").isNotNull() & F.col("response.etag").isNotNull()
    dates = F.col("modified").isNotNull() & F.col("response.modified").isNotNull()
    outcome = (
        F.when(F.col("response").isNull(), "no_response")
        .when(tags, F.when(F.col("etag") == F.col("response.etag"), "resolved").otherwise("mismatch"))
        .when(dates, F.when(F.col("modified") == F.col("response.modified"), "resolved").otherwise("mismatch"))
        .otherwise("unchecked")
    )
    judged = found.select(
        "record_id", "canonical_url", F.col("response.record_id").alias("response_id"), outcome.alias("outcome"), "own_headers", F.col("response.row").alias("source"))
    lost = light.where("NOT full AND canonical_url IS NULL").select(
        "record_id", "canonical_url", F.lit(None).cast(records.schema["record_id"].dataType).alias("response_id"),
        F.lit("no_response").alias("outcome"), "own_headers", F.lit(None).cast("bigint").alias("source"))
    usable = F.when(F.col("outcome").isin("resolved", "unchecked"), F.col("source"))
    bodies = rows.where("full").select("row", F.col("headers").alias("source_headers"), "body")
    joined = judged.unionAll(lost).withColumn("usable", usable).join(bodies, F.col("usable") == F.col("row"), "left")
    put = F.map_filter("own_headers", lambda k, _: k.isin(*PERMITTED))
    stay = F.map_filter("source_headers", lambda k, _: ~F.array_contains(F.map_keys(put), k))
    merged = F.when(F.col("usable").isNotNull(), F.map_concat(stay, put)).otherwise(F.col("own_headers"))
    return joined.select("record_id", "canonical_url", "response_id", "outcome", merged.alias("headers"), "body")


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two captures of each given page: a response, and a revisit that mostly comes later and mostly has the same entity tag."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    page, tag = F.col("page_id"), F.md5("html")

    def header(**fields: Column) -> Column:
        return F.create_map(*[x for name, value in fields.items() for x in (F.lit(name.replace("_", "-")), value)])

    def moment(seconds: Column) -> Column:
        return F.timestamp_add("SECOND", seconds.cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))

    seconds = (page * 7919) % 2_592_000
    shift = F.when(page % 11 == 0, -3600).otherwise((page % 9) * 40_000 + 60)
    response = pages.select(
        (page * 2).alias("record_id"), "url", moment(seconds).alias("captured_at"), F.lit("response").alias("kind"),
        F.when(page % 13 == 0, 404).when(page.isNotNull(), 200).alias("status"),
        header(etag=F.when(page % 4 != 3, tag), last_modified=F.when(page % 2 == 0, F.substring(tag, 1, 6)), content_type=F.lit("text/html")).alias("headers"),
        F.col("html").alias("body"))
    revisit = pages.select(
        (page * 2 + 1).alias("record_id"), "url", moment(seconds + shift).alias("captured_at"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        header(etag=F.when(page % 4 != 2, F.when(page % 5 == 0, F.lit("changed")).otherwise(tag)),
               last_modified=F.when(page % 2 == 0, F.substring(tag, 1, 6)), content_type=F.lit("none"),
               date=page.cast("string")).alias("headers"),
        F.lit(None).cast("string").alias("body"))
    drop_null = F.map_filter("headers", lambda _, v: v.isNotNull())
    return response.unionAll(revisit).withColumn("headers", drop_null)


def revisit_report(records: DataFrame) -> DataFrame:
    """The result with headers as sorted text and the body as a digest."""
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return resolve_revisits(records).select(
        "record_id", "canonical_url", "response_id", "outcome", F.array_join(entries, ";").alias("headers"), F.md5("body").alias("body_md5"))


#: The same for DuckDB, by one window over all captures of a URL.
REVISIT_SQL = r"""
WITH captures AS (
  SELECT 2 * page_id AS record_id, url, TIMESTAMP '2024-01-01 00:00:00' + to_seconds((page_id * 7919) % 2592000) AS moment, TRUE AS is_response,
         page_id % 13 <> 0 AND html IS NOT NULL AS is_full, CASE WHEN page_id % 4 <> 3 THEN md5(html) END AS etag,
         CASE WHEN page_id % 2 = 0 THEN substr(md5(html), 1, 6) END AS modified, html, NULL AS seen
  FROM pages
  UNION ALL
  SELECT 2 * page_id + 1, url, TIMESTAMP '2024-01-01 00:00:00' + to_seconds((page_id * 7919) % 2592000
           + CASE WHEN page_id % 11 = 0 THEN -3600 ELSE (page_id % 9) * 40000 + 60 END), FALSE, FALSE,
         CASE WHEN page_id % 4 <> 2 THEN CASE WHEN page_id % 5 = 0 THEN 'changed' ELSE md5(html) END END,
         CASE WHEN page_id % 2 = 0 THEN substr(md5(html), 1, 6) END, NULL, CAST(page_id AS VARCHAR)
  FROM pages),
bare AS (SELECT *, regexp_replace(url, '#.*$', '') AS u FROM captures),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z]+://([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(u, '^[A-Za-z]+://[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)'))) AS query
  FROM bare),
named AS (
  SELECT *, CASE WHEN host <> '' THEN host || path || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS canonical_url
  FROM parts),
placed AS (
  SELECT *, last_value(CASE WHEN is_full THEN {'id': record_id, 'etag': etag, 'modified': modified, 'html': html} END IGNORE NULLS) OVER (
    PARTITION BY canonical_url ORDER BY moment, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r
  FROM named),
judged AS (
  SELECT *, CASE WHEN canonical_url IS NULL OR r IS NULL THEN 'no_response'
                 WHEN etag IS NOT NULL AND r.etag IS NOT NULL THEN CASE WHEN etag = r.etag THEN 'resolved' ELSE 'mismatch' END
                 WHEN modified IS NOT NULL AND r.modified IS NOT NULL THEN CASE WHEN modified = r.modified THEN 'resolved' ELSE 'mismatch' END
                 ELSE 'unchecked' END AS outcome
  FROM placed WHERE NOT is_response)
SELECT record_id, canonical_url, CASE WHEN canonical_url IS NOT NULL THEN r.id END AS response_id, outcome,
       CASE WHEN outcome IN ('resolved', 'unchecked') THEN concat_ws(';', 'content-type=text/html', 'date=' || seen, 'etag=' || coalesce(etag, r.etag), 'last-modified=' || r.modified)
            ELSE concat_ws(';', 'content-type=none', 'date=' || seen, 'etag=' || etag, 'last-modified=' || modified) END AS headers,
       CASE WHEN outcome IN ('resolved', 'unchecked') THEN md5(r.html) END AS body_md5
FROM judged
"""
