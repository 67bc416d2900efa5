"""WARC records and the resolution of not-modified revisits.

A crawler that asks "has this changed?" stores the answer 304 as a revisit
record without a body.  To read it, the body of an earlier full response is
needed: the latest earlier one at the same canonical URL (an as-of join).  It
counts only if the validators agree, and its headers are updated by those that
a 304 may update.

The as-of join never gathers the records of a URL in one task.  They are first
folded to one row per URL and date, which is partial aggregation however many
share it.  A running window over the dates of a URL and day (86,400 of them
where dates are whole seconds) finds the latest full response before each, and
a table of one row per URL and day carries the last one of all earlier days
forward.  Revisits meet these rows by URL and date, a join that Spark may split.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Headers of a 304 that replace those of the stored response (lower case; fixed values).
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "set-cookie", "vary", "warning")
#: Query parameters that do not name a resource (fixed values).
TRACKING = r"^(utm_[a-z]+|fbclid|gclid|phpsessid|jsessionid|sid)="
BUCKET_SECONDS = 86_400

RECORD = "record_id string, type string, uri string, date timestamp, status int, headers map<string,string>, profile string, body binary, error string"
#: End of the profile of a revisit that answers "not modified" (fixed value); other profiles name other kinds.
NOT_MODIFIED = "server-not-modified"
#: Longest header line, longest header in lines, and block that is read; what is longer is damaged.
MOST_LINE, MOST_LINES, MOST_BLOCK = 1 << 20, 10_000, 1 << 30


def canonical_url(url: Column) -> Column:
    """Lower-case scheme-less host and path; no user, www, default port, fragment, tracking or last slash; sorted query.

    Null stays null; text that is no http URL is only trimmed and lower-cased
    before its path.
    """
    whole = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(whole, "(?i)^https?://", "")
    host = F.lower(F.regexp_extract(bare, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^[^@]*@", ""), ":(80|443)?$", ""), r"^www\d*\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda q: (q != "") & ~F.lower(q).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _lower_headers(headers: Column) -> Column:
    """Header map as an array of (k, v) with lower-case names, sorted; of names alike the last value in order stays."""
    entries = F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("k"), F.trim(e["value"]).alias("v")))
    return F.array_sort(entries)


def _header(headers: Column, name: str) -> Column:
    return F.try_element_at(F.filter(headers, lambda e: e["k"] == name), F.lit(-1))["v"]


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS, permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """Join each not-modified revisit to the response whose body it stands for.

    ``records`` has record_id, type ('response', 'revisit'), uri, date, status
    and headers (map), and maybe profile; further columns are ignored.  Result,
    one row per revisit of status 304, or of null status if its profile is null
    or that of not-modified answers: record_id, url (canonical), date, refers_to
    and refers_to_date (null if no earlier full response), outcome and headers
    (array of (k, v), sorted; null unless resolved).  outcome is

    * ``orphan``: no response of status 200 with an earlier date at that URL;
    * ``etag``: both have the same entity tag, compared without a weak prefix;
    * ``last-modified``: one has no tag, and Last-Modified is the same;
    * ``unvalidated``: the revisit names no validator, so the latest is taken;
    * ``mismatch``: its validators contradict the response; not resolved.

    Merged headers are the response's, with the permitted ones of the revisit
    in their place; names are lower-cased.  Of responses of equal date the one
    with the greatest record_id counts.  Null uri or date never matches
    (outcome ``orphan``).  Repeated rows give repeated rows.  An empty table
    gives an empty table.
    """
    heads = _lower_headers(F.col("headers"))
    profile = F.col("profile") if "profile" in records.columns else F.lit(None).cast("string")
    base = records.select("record_id", "type", canonical_url(F.col("uri")).alias("url"), "date", "status", heads.alias("heads"), profile.alias("profile"))
    base = base.withColumn("etag", F.regexp_replace(_header(F.col("heads"), "etag"), "^W/", "")).withColumn("modified", _header(F.col("heads"), "last-modified"))
    base = base.withColumn("bucket", F.floor(F.unix_micros("date") / (bucket_seconds * 1_000_000)))
    full = (F.col("type") == "response") & (F.col("status") == 200) & F.col("url").isNotNull() & F.col("date").isNotNull()
    unmodified = (F.col("status") == 304) | (F.col("status").isNull() & (F.col("profile").isNull() | F.rtrim("profile", F.lit("/")).endswith(NOT_MODIFIED)))
    again = (F.col("type") == "revisit") & F.coalesce(unmodified, F.lit(False))
    ref = F.struct("date", "record_id", "etag", "modified", "heads")
    marked = base.where(full | again).withColumn("again", again).drop("profile").withColumn("ref", F.when(~F.col("again"), ref))
    placed = marked.where("url is not null and date is not null")

    # one row per URL and date, with the response of that date, and the latest of all earlier dates of its day
    dates = placed.groupBy("url", "bucket", "date").agg(F.max("ref").alias("here"))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    dates = dates.withColumn("near", F.last("here", ignorenulls=True).over(before("url", "bucket").orderBy("date")))

    # latest of all earlier days
    days = placed.groupBy("url", "bucket").agg(F.max("ref").alias("last"))
    carried = days.select("url", "bucket", F.last("last", ignorenulls=True).over(before("url").orderBy("bucket")).alias("carried"))

    hits = dates.join(carried, ["url", "bucket"]).select("url", "date", F.coalesce("near", "carried").alias("hit"))
    found = placed.where("again").drop("bucket", "ref").join(hits, ["url", "date"], "left")
    lost = marked.where("again and (url is null or date is null)").drop("bucket").withColumn("hit", F.col("ref")).drop("ref")
    out = found.unionByName(lost)

    both_tags = F.col("etag").isNotNull() & F.col("hit.etag").isNotNull()
    both_dates = F.col("modified").isNotNull() & F.col("hit.modified").isNotNull()
    outcome = (
        F.when(F.col("hit").isNull(), "orphan")
        .when(both_tags, F.when(F.col("etag") == F.col("hit.etag"), "etag").otherwise("mismatch"))
        .when(both_dates, F.when(F.col("modified") == F.col("hit.modified"), "last-modified").otherwise("mismatch"))
        .when(F.col("etag").isNull() & F.col("modified").isNull(), "unvalidated")
        .otherwise("mismatch")
    )
    fresh = F.filter(F.col("heads"), lambda e: e["k"].isin(*permitted))
    old = F.filter(F.col("hit.heads"), lambda e: ~F.array_contains(F.transform(F.col("fresh"), lambda f: f["k"]), e["k"]))
    out = out.withColumn("outcome", outcome).withColumn("fresh", fresh)
    resolved = F.col("outcome").isin("etag", "last-modified", "unvalidated")
    merged = F.when(resolved, F.array_sort(F.concat(old, "fresh")))
    return out.select("record_id", "url", "date", F.col("hit.record_id").alias("refers_to"), F.col("hit.date").alias("refers_to_date"), "outcome", merged.alias("headers"))


class Damaged(ValueError):
    """A record that can't be read as one."""


class Ended(Damaged):
    """A record that the end of the data cuts short."""


def parse_warc(file) -> Iterator[tuple[dict[str, str], bytes] | Damaged]:
    """(WARC headers with lower-case names, block) of each record of a binary stream, plain or of gzip members.

    Records are read one after the other, so memory holds one.  What is no
    record gives one ``Damaged``: after a stray line or a bad length reading
    goes on at the next line that begins a record, after a broken or truncated
    gzip member it ends.
    """
    start = file.read(2)
    data, members = _Joined(start, file), None
    if start == b"\x1f\x8b":
        data = members = _Members(data)
    data = io.BufferedReader(data, 1 << 16)
    astray = False
    while line := data.readline(MOST_LINE):
        if not line.startswith(b"WARC/"):
            if line.strip() and not astray:
                astray = True
                yield Damaged("not at the start of a WARC record")
            continue
        try:
            head = _head(data)
            length = head.get("content-length", "0")
            if not length.isascii() or not length.isdigit() or int(length) > MOST_BLOCK:
                raise Damaged(f"bad Content-Length {length[:40]!r}")
            block = data.read(int(length))
            if len(block) < int(length):
                raise Ended(f"the file ends within a block of {length} bytes")
        except Ended as e:
            if not (members and members.error):  # else that says why
                yield e
            break
        except Damaged as e:
            astray = True
            yield e
            continue
        astray = False
        yield head, block
    if members and members.error:
        yield Damaged(f"broken gzip member: {members.error}")


class _Members(io.RawIOBase):
    """Gzip members one after the other; what stands before a fault is served, then ``error`` says what it was."""

    def __init__(self, packed):
        self.packed, self.unpack, self.ready, self.error = packed, zlib.decompressobj(31), b"", None
        self.raw, self.begun = b"", False

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.ready and not self.error:
            if self.unpack.eof:
                self.raw, self.unpack, self.begun = self.unpack.unused_data, zlib.decompressobj(31), False
            self.raw = self.raw or self.packed.read(1 << 14)
            if not self.raw:
                self.error = "truncated" if self.begun else None
                break
            try:
                self.begun, self.ready, self.raw = True, self.unpack.decompress(self.raw), b""
            except zlib.error as e:
                self.error = str(e)
        n = min(len(self.ready), len(target))
        target[:n], self.ready = self.ready[:n], self.ready[n:]
        return n


class _Joined(io.RawIOBase):
    """Bytes already read, followed by the rest of a stream."""

    def __init__(self, start: bytes, rest):
        self.start, self.rest = start, rest

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        got, self.start = (self.start[: len(target)], self.start[len(target) :]) if self.start else (self.rest.read(len(target)), b"")
        target[: len(got)] = got
        return len(got)


def _head(data, ends: bool = True) -> dict[str, str]:
    """Header lines up to a blank one; only without ``ends`` the end of the data does as well."""
    head: dict[str, str] = {}
    name = ""
    for _ in range(MOST_LINES):
        raw = data.readline(MOST_LINE)
        line = raw.rstrip(b"\r\n").decode("utf-8", "replace")
        if line == "" and (raw or not ends):
            return head
        if not raw:
            raise Ended("the file ends within a header")
        if len(raw) == MOST_LINE:
            break
        if line[0] in " \t" and name:
            head[name] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        name = name.strip().lower()
        head[name] = value.strip()
    raise Damaged("a header that does not end")


def _row(found: tuple[dict[str, str], bytes] | Damaged) -> list:
    if isinstance(found, Damaged):
        return [None, None, None, None, None, [], None, None, str(found)]
    head, block = found
    status, http, error = None, {}, None
    if head.get("content-type", "").startswith("application/http"):
        data = io.BytesIO(block)
        words = data.readline().split()
        status = int(words[1]) if len(words) > 1 and words[1].isdigit() and len(words[1]) == 3 else None
        try:
            http = _head(data, ends=False)
        except Damaged as e:
            error = str(e)
        block = data.read()
    uri = head.get("warc-target-uri", "").strip("<>") or None
    return [head.get("warc-record-id"), head.get("warc-type"), uri, head.get("warc-date"), status, list(http.items()), head.get("warc-profile", "").strip("<>") or None, block, error]


def _parse(batches):
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.string(), pa.binary(), pa.string())
    names = [c.split()[0] for c in RECORD.split(", ")]
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, place = fs.FileSystem.from_uri(_uri(path))
            with store.open_input_stream(place, compression=None) as file:
                for found in parse_warc(file):
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(_row(found), kinds, strict=True)], names)


def _uri(path: str) -> str:
    """A path as Spark lists it, in the form that pyarrow takes."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        return "file:///" + path[6:].lstrip("/")
    return path.replace("s3a://", "s3://", 1) if path.startswith("s3a://") else path


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, plain or gzipped (schema RECORD); a file is one task's unit, read record by record.

    Spark lists the files; tasks open them with pyarrow, so an archive of any
    size is read with one record in memory.  Damage never fails the job: whole
    records are returned, and for what can't be read a row with null fields and
    ``error`` (see ``parse_warc``); a record whose HTTP header does not end has
    both.  An empty file has no rows, an unreadable date is null.
    """
    files = spark.read.format("binaryFile").load(path).select("path")
    rows = files.repartition(F.col("path")).mapInArrow(_parse, RECORD.replace("date timestamp", "date string"))
    return rows.withColumn("date", F.try_to_timestamp("date"))


def recrawl(pages: DataFrame) -> DataFrame:
    """A crawl log of page captures and later conditional requests, as WARC records.

    Page p is captured in full at hour p; a conditional request for the same URL
    follows 1 to 997 hours later and is answered 304.  It carries the page's own
    validators, so it resolves unless another capture of that canonical URL with
    other content came between.  By p modulo 12 the validators are a weak tag, a
    date alone, none, or a tag of something else; the capture of p = 5 modulo 12
    failed, so its request resolves to another capture or to none.
    """
    p = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    changed = F.concat(F.lit("day "), F.substring(F.md5("html"), 1, 2))
    captured = F.timestamp_seconds(F.lit(1_700_000_000) + p * 3600)
    asked = F.timestamp_seconds(F.lit(1_700_000_000) + (p + 1 + p * 7919 % 997) * 3600)
    kind = p % 12
    sent = F.when(kind == 1, F.concat(F.lit("W/"), tag)).when(kind.isin(2, 3), F.lit(None)).when(kind == 4, F.lit('"other"')).otherwise(tag)
    drop_null = lambda m: F.map_filter(m, lambda k, v: v.isNotNull())
    first = F.create_map(F.lit("ETag"), tag, F.lit("Last-Modified"), changed, F.lit("Content-Type"), F.lit("text/html"), F.lit("Expires"), F.lit("never"))
    later = F.create_map(F.lit("etag"), sent, F.lit("Last-Modified"), F.when(kind == 2, changed), F.lit("Expires"), (p + 1 + p * 7919 % 997).cast("string"), F.lit("Connection"), F.lit("close"))
    row = lambda name, when, status, headers: F.struct(F.concat(F.lit(name), p.cast("string")).alias("record_id"), F.lit({"c": "response", "r": "revisit"}[name]).alias("type"), F.col("url").alias("uri"), when.alias("date"), status.cast("int").alias("status"), drop_null(headers).alias("headers"))
    return pages.select(F.explode(F.array(row("c", captured, F.when(kind == 5, 503).otherwise(200), first), row("r", asked, F.lit(304), later))).alias("x")).select("x.*")


ORACLE = r"""
WITH base AS (
  SELECT page_id AS p, html, regexp_replace(trim(url), '#.*$', '') AS whole FROM pages),
bare AS (SELECT *, regexp_replace(whole, '^https?://', '', 'i') AS b FROM base),
parts AS (
  SELECT p, html,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(b, '^[^/?]*')), '^[^@]*@', ''), ':(80|443)?$', ''), '^www\d*\.', '') AS host,
    regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(b, '\?(.*)$', 1), '&'), lambda q: q <> '' AND NOT regexp_matches(lower(q), '^(utm_[a-z]+|fbclid|gclid|phpsessid|jsessionid|sid)='))) AS q FROM bare),
urls AS (SELECT p, html, host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url,
    '"' || md5(html) || '"' AS tag FROM parts),
fulls AS (SELECT url, p AS hour, 'c' || p AS record_id, tag, html FROM urls WHERE p % 12 <> 5),
asks AS (SELECT p, url, p + 1 + p * 7919 % 997 AS hour, p % 12 AS kind, tag, html FROM urls),
latest AS (
  SELECT a.p, a.url, a.hour, a.kind, a.tag, a.html AS own, f.record_id AS refers_to, f.tag AS old_tag, f.html AS old
  FROM asks a ASOF LEFT JOIN fulls f ON a.url = f.url AND a.hour > f.hour)
SELECT p AS page_id, url, refers_to, outcome,
  CASE WHEN outcome IN ('etag', 'last-modified', 'unvalidated') THEN
    'content-type=text/html|etag=' || CASE WHEN kind = 1 THEN 'W/' || tag WHEN kind IN (2, 3) THEN old_tag ELSE tag END
    || '|expires=' || hour || '|last-modified=day ' || substr(md5(CASE WHEN kind = 2 THEN own ELSE old END), 1, 2) END AS headers
FROM (SELECT *,
  CASE WHEN refers_to IS NULL THEN 'orphan' WHEN kind = 3 THEN 'unvalidated' WHEN kind = 4 THEN 'mismatch'
       WHEN kind = 2 THEN CASE WHEN substr(md5(own), 1, 2) = substr(md5(old), 1, 2) THEN 'last-modified' ELSE 'mismatch' END
       WHEN tag = old_tag THEN 'etag' ELSE 'mismatch' END AS outcome FROM latest)
"""
