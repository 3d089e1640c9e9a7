"""WARC records, and the resolution of not-modified revisits.

A revisit record of a 304 answer has no payload. It is resolved to the latest earlier full response (status
200) of the same canonical URL, by an as-of join; validators that both have (ETag, Last-Modified) must agree. The
resolved record has the response's payload and headers, the latter updated by those that a 304 may update.

The join works on the different (URL, date) points: responses of a point are reduced to one, the greatest
record id, and revisits of a point have one answer. Points are cut into time ranges of about equal numbers of
records, so that no URL, however frequent, is one task: within a range the last response is carried on by a window,
from range to range by one row for each URL and range. Payloads are not moved: records are parsed once, and what is
stored of them is their header fields and the payload's length and digest.

Defined cases: records without URL or date, or whose headers can't be read, are unresolved, and take no part in the join;
a response at the very date of the revisit is not earlier; weak and strong forms of an ETag agree; repeated records are
resolved each; a block ends after its Content-Length of bytes, or with the text where that is missing, no number or
too large; a record without a blank line has an empty block; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veristrata.llm.common import stored

LEAST_RANGES, MOST_RANGES = 256, 10_000
RANGE_RECORDS = 100_000  # of a time range, as long as there are not more than MOST_RANGES of them
COLUMNS = ["record_id", "type", "url", "date", "status", "fields", "payload_bytes", "payload_sha256"]

# Header fields that a 304 answer does not update.
NOT_UPDATED = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade",
]


def canonical_url(url: Column) -> Column:
    """Key of a URL: without scheme, ``www.``, default port, fragment, tracking parameters and final slash; host
    in small letters, parameters in order."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(?i:utm_|fbclid|gclid)"))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise(""))


def _fields(lines: Column) -> Column:
    """Array of (name in small letters, value) from header lines."""
    named = F.filter(lines, lambda x: F.instr(x, ":") > 0)
    return F.transform(
        named,
        lambda x: F.struct(
            F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"),
            F.trim(F.substr(x, F.instr(x, ":") + 1)).alias("value"),
        ),
    )


def field(fields: Column, name: str) -> Column:
    """First value of a field, NULL without."""
    return F.get(F.filter(fields, lambda h: h["name"] == name), F.lit(0))["value"]


def parse(df: DataFrame, record: str = "record") -> DataFrame:
    """Columns of WARC records whose text is in the column ``record``: record_id, type, url, date, status, fields
    (of the HTTP answer), payload_bytes, payload_sha256."""
    text = F.col(record).cast("string")
    head = F.substring_index(text, "\r\n\r\n", 1)
    rows = df.select(text.cast("binary").alias("_bytes"), head.alias("_head"))
    rows = rows.select("_bytes", F.octet_length("_head").alias("_at"), _fields(F.split("_head", "\r\n")).alias("_warc"))
    length = field(F.col("_warc"), "content-length").try_cast("long")
    whole = F.octet_length("_bytes")
    length = F.when(length >= 0, F.least(length, whole)).otherwise(whole).cast("int")
    rows = rows.select("_warc", F.substr("_bytes", F.col("_at") + 5, length).alias("_block"))
    answer = F.substring_index(F.col("_block").cast("string"), "\r\n\r\n", 1)
    rows = rows.select("_warc", "_block", answer.alias("_answer"))
    payload = F.substr("_block", F.octet_length("_answer") + 5, F.octet_length("_block"))
    rows = rows.select("_warc", "_answer", payload.alias("_payload"))
    return rows.select(
        field(F.col("_warc"), "warc-record-id").alias("record_id"), field(F.col("_warc"), "warc-type").alias("type"),
        field(F.col("_warc"), "warc-target-uri").alias("url"),
        F.try_to_timestamp(field(F.col("_warc"), "warc-date"), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]X")).alias("date"),
        F.regexp_extract("_answer", r"^HTTP/[0-9.]+ ([0-9]{3})", 1).try_cast("int").alias("status"),
        _fields(F.split("_answer", "\r\n")).alias("fields"),
        F.octet_length("_payload").cast("long").alias("payload_bytes"),
        F.sha2("_payload", 256).alias("payload_sha256"),
    )


def _strong(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def merged_fields(stored_fields: Column, newer: Column) -> Column:
    """Stored fields, those of the 304 in place of theirs where it may update them; by name."""
    update = F.filter(newer, lambda h: ~h["name"].isin(NOT_UPDATED))
    kept = F.filter(stored_fields, lambda h: ~F.exists(update, lambda u: u["name"] == h["name"]))
    return F.array_sort(F.concat(kept, update))


def time_edges(dates: DataFrame, ranges: int) -> list[int]:
    """Microseconds that cut the records into ranges of about equal numbers; at most ``ranges`` - 1 of them."""
    shares = [i / ranges for i in range(1, ranges)]
    found = dates.select(F.unix_micros("date").alias("t")).where("t IS NOT NULL").agg(
        F.percentile_approx("t", F.array(*[F.lit(s) for s in shares]), F.lit(max(10_000, 20 * ranges))).alias("edges")
    ).first()[0]
    return sorted(set(found or []))


def time_range(edges: list[int]) -> Column:
    """Number of edges up to the date, looked up in two steps: the run of neighbouring edges, then the place in it."""
    if not edges:
        return F.lit(0)
    step = math.isqrt(len(edges)) + 1
    runs = [edges[i : i + step] for i in range(0, len(edges), step)]
    upto = lambda values: F.size(F.filter(values, lambda e: e <= F.unix_micros("date")))
    run = upto(F.lit([r[0] for r in runs[1:]]) if runs[1:] else F.expr("array()").cast("array<bigint>"))
    within = F.array(*[F.lit(r) for r in runs])
    return run * step + upto(F.get(within, run))


def resolve(records: DataFrame, ranges: int | None = None) -> DataFrame:
    """For each revisit: record_id, url, canonical, date, outcome (``resolved``, ``validators differ``, ``no
    response``), refers_to, fields, payload_bytes, payload_sha256; the last four are NULL unless resolved. The number of
    time ranges grows with the records unless it is given."""
    rows = stored(records.select(*COLUMNS, canonical_url(F.col("url")).alias("canonical")), "warc")
    if ranges is None:
        ranges = min(MOST_RANGES, max(LEAST_RANGES, math.ceil(rows.count() / RANGE_RECORDS)))
    usable = F.col("canonical").isNotNull() & F.col("date").isNotNull()
    key = ["canonical", "date"]
    full = rows.where(usable & (F.col("type") == "response") & (F.col("status") == 200))
    answer = F.struct("record_id", "fields", "payload_bytes", "payload_sha256")
    revisits = rows.where((F.col("type") == "revisit") & (F.col("status") == 304))
    points = full.select(*key, answer.alias("answer")).union(
        revisits.where(usable).select(*key, F.lit(None).cast(full.select(answer.alias("a")).schema["a"].dataType))
    ).groupBy(*key).agg(F.max("answer").alias("answer"))
    points = points.withColumn("part", time_range(time_edges(rows, ranges)))
    before = Window.partitionBy("canonical", "part").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    near = points.withColumn("near", F.last("answer", ignorenulls=True).over(before))
    ends = points.where(F.col("answer").isNotNull()).groupBy("canonical", "part").agg(
        F.max_by("answer", "date").alias("at_end")
    )
    # A range without responses has no row of its own here, so every range of points gets one.
    ranges_of = points.groupBy("canonical", "part").agg(F.count("*").alias("_n")).join(ends, ["canonical", "part"], "left")
    earlier = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges_of.select("canonical", "part", F.last("at_end", ignorenulls=True).over(earlier).alias("carried"))
    answered = near.join(carried, ["canonical", "part"]).select(*key, F.coalesce("near", "carried").alias("found"))
    found = revisits.where(usable).join(answered, key, "left")
    found = found.unionByName(revisits.where(~usable).withColumn("found", F.lit(None).cast(found.schema["found"].dataType)))
    differ = F.lit(False)
    for name in ("etag", "last-modified"):
        mine, theirs = field(F.col("fields"), name), field(F.col("found.fields"), name)
        differ = differ | F.coalesce(_strong(mine) != _strong(theirs), F.lit(False))
    outcome = F.when(F.col("found").isNull(), "no response").when(differ, "validators differ").otherwise("resolved")
    good = outcome == "resolved"
    return found.select(
        "record_id", "url", "canonical", "date", outcome.alias("outcome"),
        F.when(good, F.col("found.record_id")).alias("refers_to"),
        F.when(good, merged_fields(F.col("found.fields"), F.col("fields"))).alias("fields"),
        F.when(good, F.col("found.payload_bytes")).alias("payload_bytes"),
        F.when(good, F.col("found.payload_sha256")).alias("payload_sha256"),
    )


def record_text(kind: str, record_id: Column, url: Column, date: Column, status: str, fields: list[tuple[str, Column]],
                payload: Column) -> Column:
    """The text of a WARC record with an HTTP answer."""
    answer = [F.lit(f"HTTP/1.1 {status}\r\n")]
    for name, value in fields:
        answer += [F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")]
    block = F.concat(*answer, F.lit("\r\n"), payload)
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), record_id, F.lit("\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Date: "), F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block,
    )
