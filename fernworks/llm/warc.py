"""WARC: reading records, and resolving not-modified revisits.

A revisit record says that a capture was answered "not modified". It is resolved by an as-of join on the canonical URL
to the latest full response captured strictly earlier. Its validators are then checked against that response (entity
tag where the revisit has one, else last-modified), and where they agree the response's headers are updated by those
that a not-modified answer may carry.

The as-of join takes no key into one task: captures are cut into time buckets (bounds are quantiles of all times); the
latest response of each bucket is found first, carried over the later buckets of its URL (at most TIME_BUCKETS rows
for a URL), and only inside a bucket are captures sorted. Bodies are not moved: a result names the response.

Defined cases. Null URL, or one without "://": canonical URL is the trimmed text or empty, and joins with equal ones.
Captures at the same time: none is earlier than the other; of responses at one time the one with the larger id holds.
Repeated rows: each revisit row has its own result. Null time: a revisit finds nothing, a response is never found. No
responses, or empty table: `missing`, or no rows. A revisit without validators agrees with any response. Extra columns
are left out.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import prepare
from .url_filter import LOWER, UPPER

#: Headers that a not-modified answer may bring: fixed values.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that name a visit and not a page: fixed values.
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"
TIME_BUCKETS = 256
#: Modulus of the made crawl's times: fixed value.
PRIME = 2_147_483_647


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default ports, path without last slash, query sorted without tracking; no scheme, no fragment."""
    u = F.trim(F.coalesce(url.cast("string"), F.lit("")))
    at = F.instr(u, "://")
    rest = F.regexp_replace(F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(u), r"#[\s\S]*$", "")
    host = F.translate(F.regexp_extract(rest, r"^[^/?]*", 0), UPPER, LOWER)
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/$", "")
    query = F.regexp_extract(rest, r"^[^?]*\?([\s\S]*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~F.regexp_like(x, F.lit(TRACKING)))), "&")
    return F.concat(host, path, F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept)))


def resolve_revisits(captures: DataFrame, time_buckets: int = TIME_BUCKETS) -> DataFrame:
    """A row for each revisit: id, canonical, response_id, status (resolved, mismatch, missing), headers.

    captures: id, url, time (long), kind (response or revisit), headers (map of lower-case names). headers of the
    result: the response's, with the permitted ones of the revisit, or null unless resolved.
    """
    bounds = captures.agg(F.percentile_approx("time", [i / time_buckets for i in range(1, time_buckets)], 10_000)).first()[0] or []
    bounds = sorted(set(bounds))
    bucket = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<long>"), lambda b: b < F.col("time"))) if bounds else F.lit(0)
    rows = captures.select("id", canonical_url(F.col("url")).alias("canonical"), F.col("time").cast("long").alias("time"), (F.col("kind") == "response").alias("full"), "headers")
    rows = rows.withColumn("bucket", F.when(F.col("time").isNull(), F.lit(-1)).otherwise(bucket))
    entry = F.when(F.col("full") & F.col("time").isNotNull(), F.struct("time", "id", F.map_entries("headers").alias("entries")))
    rows = rows.withColumn("entry", entry)
    last = rows.filter("entry is not null").groupBy("canonical", "bucket").agg(F.max("entry").alias("last"))
    touched = rows.select("canonical", "bucket").distinct().join(last, ["canonical", "bucket"], "left")
    before = Window.partitionBy("canonical").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = touched.select("canonical", "bucket", F.max("last").over(before).alias("carried"))
    inside = Window.partitionBy("canonical", "bucket").orderBy("time", F.col("full").cast("int")).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(carried, ["canonical", "bucket"]).withColumn("here", F.max("entry").over(inside)).filter(~F.col("full"))
    found = F.when(F.col("time").isNotNull(), F.coalesce("here", "carried"))
    out = out.withColumn("found", found).withColumn("theirs", F.map_from_entries("found.entries"))
    tag, modified = F.col("headers")["etag"], F.col("headers")["last-modified"]
    agrees = F.when(tag.isNotNull(), F.coalesce(tag == F.col("theirs")["etag"], F.lit(False))).when(modified.isNotNull(), F.coalesce(modified == F.col("theirs")["last-modified"], F.lit(False))).otherwise(True)
    status = F.when(F.col("found").isNull(), "missing").when(agrees, "resolved").otherwise("mismatch")
    fresh = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("theirs", lambda k, _: ~F.array_contains(F.map_keys(fresh), k)), fresh)
    return out.withColumn("status", status).select("id", "canonical", F.col("found.id").alias("response_id"), "status", F.when(F.col("status") == "resolved", merged).alias("headers"))


class _Unzipped(io.RawIOBase):
    """What the members of a gzip file hold, up to where it is damaged or cut off."""

    def __init__(self, blob: bytes):
        self.blob, self.at, self.member, self.left = memoryview(blob), 0, None, memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.left and self.at < len(self.blob):
            self.member = self.member or zlib.decompressobj(31)
            piece = self.blob[self.at : self.at + (1 << 14)]
            try:
                self.left = memoryview(self.member.decompress(piece))
            except zlib.error:
                self.at = len(self.blob)
                continue
            self.at += len(piece) - len(self.member.unused_data)
            if self.member.eof:
                self.member = None
        n = min(len(buffer), len(self.left))
        buffer[:n], self.left = self.left[:n], self.left[n:]
        return n


def _members(blob: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """WARC headers (lower-case names) and block of each record; what is cut off or damaged ends the file, and a record
    whose length is no number is passed over up to the next one."""
    stream = io.BufferedReader(_Unzipped(blob)) if blob[:2] == b"\x1f\x8b" else io.BytesIO(blob)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        head: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        length = head.get("content-length", "0")
        if not (length.isascii() and length.isdigit()):
            continue
        block = stream.read(int(length))
        if len(block) < int(length):
            return
        yield head, block


def _seconds(date: str | None) -> int | None:
    from datetime import datetime, timezone

    try:
        at = datetime.fromisoformat((date or "").replace("Z", "+00:00"))
    except ValueError:
        return None
    return int((at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp())


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The response and revisit records of the WARC files at path, plain or gzipped, in the columns of resolve_revisits.

    id is the record's id; time is its date in seconds, null for none or a bad one; body the bytes after the HTTP
    headers. A file is read in one task, as gzip members can't be found from the middle. A damaged or cut off file gives
    the records before the damage; a record whose length is no number is left out.
    """
    import pyarrow as pa

    prepare(spark)
    kinds = [("id", pa.string()), ("url", pa.string()), ("time", pa.int64()), ("kind", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("body", pa.binary())]

    def run(batches):
        for batch in batches:
            for blob in batch.column("content").to_pylist():
                for head, block in _members(blob):
                    if head.get("warc-type") not in ("response", "revisit"):
                        continue
                    top, _, body = block.partition(b"\r\n\r\n")
                    fields = (x.partition(":") for x in top.decode("latin-1").split("\r\n")[1:])
                    row = (head.get("warc-record-id"), head.get("warc-target-uri"), _seconds(head.get("warc-date")), head["warc-type"], list({a.strip().lower(): c.strip() for a, b, c in fields if b}.items()), body)
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, (_, t) in zip(row, kinds, strict=True)], names=[n for n, _ in kinds])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "id string, url string, time long, kind string, headers map<string,string>, body binary")


def crawl_log(pages: DataFrame) -> DataFrame:
    """Two visits to every page, a full one and one answered "not modified", at times spread over one long crawl.

    Times are made from the page's id, so that the visits to a URL are in any order: a revisit may come before any full
    answer, between two, or after all. By the id, a revisit has the page's own entity tag, its own last-modified, none,
    or a stale tag beside the right last-modified (the tag decides).
    """
    digest = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    tag, size = F.concat(F.lit('"'), digest, F.lit('"')), F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    changed, kind = F.substring(digest, 1, 8), F.col("page_id") % 4
    at = lambda factor: (F.col("page_id") * factor) % PRIME
    first = F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), size, F.lit("etag"), tag, F.lit("last-modified"), changed, F.lit("date"), at(1103515245).cast("string"))
    again = {"content-length": F.lit("0"), "date": at(1812433253).cast("string"), "cache-control": F.lit("max-age=60"), "etag": F.when(kind == 0, tag).when(kind == 3, F.lit('"stale"')), "last-modified": F.when(kind.isin(1, 3), changed)}
    again = F.map_filter(F.create_map(*[x for k, v in again.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())
    response = pages.select(F.col("page_id").alias("id"), "url", at(1103515245).alias("time"), F.lit("response").alias("kind"), first.alias("headers"))
    revisit = pages.select(F.col("page_id").alias("id"), "url", at(1812433253).alias("time"), F.lit("revisit").alias("kind"), again.alias("headers"))
    return response.unionByName(revisit)


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the "not modified" visit to every page resolves to (response -1: none), with its merged headers as lines."""
    out = resolve_revisits(crawl_log(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
    return out.select(F.col("id").alias("page_id"), "canonical", F.coalesce("response_id", F.lit(-1).cast("long")).alias("response_page_id"), "status", lines.alias("headers"))


SQL = r"""
WITH u AS (
  SELECT page_id, html, trim(coalesce(url, ''), ' ') AS u FROM pages),
a AS (SELECT *, regexp_replace(CASE WHEN contains(u, '://') THEN substr(u, strpos(u, '://') + 3) ELSE u END, '#(.|\n|\r)*$', '') AS rest FROM u),
b AS (SELECT *,
    regexp_replace(regexp_replace(translate(regexp_extract(rest, '^[^/?]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^www\.', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(CASE WHEN contains(rest, '?') THEN substr(rest, strpos(rest, '?') + 1) ELSE '' END, '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|gclid|fbclid)(=|$)'))), '&') AS q
  FROM a),
c AS (SELECT page_id, host || path || CASE WHEN q = '' THEN '' ELSE '?' || q END AS canonical, page_id % 4 AS kind,
    '"' || md5(coalesce(html, '')) || '"' AS tag, md5(coalesce(html, ''))[1:8] AS changed, strlen(coalesce(html, ''))::VARCHAR AS size,
    (page_id * 1103515245) % 2147483647 AS taken, (page_id * 1812433253) % 2147483647 AS again FROM b),
v AS (SELECT *, CASE kind WHEN 0 THEN tag WHEN 3 THEN '"stale"' END AS my_tag, CASE WHEN kind IN (1, 3) THEN changed END AS my_changed FROM c),
f AS (SELECT v.page_id, v.canonical, v.my_tag, v.my_changed, v.again, r.page_id AS rid, r.tag, r.changed, r.size,
    CASE WHEN r.canonical IS NULL THEN 'missing' WHEN CASE WHEN my_tag IS NOT NULL THEN my_tag = r.tag WHEN my_changed IS NOT NULL THEN my_changed = r.changed ELSE true END THEN 'resolved' ELSE 'mismatch' END AS status
  FROM v ASOF LEFT JOIN (SELECT * FROM c WHERE taken IS NOT NULL) r ON v.canonical = r.canonical AND v.again > r.taken)
SELECT page_id, canonical, coalesce(rid, -1) AS response_page_id, status,
  CASE WHEN status = 'resolved' THEN concat_ws(chr(10), 'cache-control: max-age=60', 'content-length: ' || size, 'content-type: text/html',
    'date: ' || again, 'etag: ' || coalesce(my_tag, tag), 'last-modified: ' || coalesce(my_changed, changed)) END AS headers
FROM f
"""
