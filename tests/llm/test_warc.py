import gzip
from datetime import datetime

import duckdb
import pytest

from textlode.llm import warc as W

SCHEMA = "record_id string, type string, uri string, date timestamp, status int, headers map<string,string>, extra int"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def brute(rows, canon):
    full = [r for r in rows if r[1] == "response" and r[4] == 200 and r[2] and r[3]]
    out = []
    for r in rows:
        if r[1] != "revisit" or r[4] not in (304, None):
            continue
        hits = [f for f in full if r[2] and r[3] and canon[f[2]] == canon[r[2]] and f[3] < r[3]]
        h = max(hits, key=lambda f: (f[3], f[0])) if hits else None
        low = lambda m: {k.lower(): v for k, v in (m or {}).items()}
        outcome, merged = "orphan", None
        if h:
            a, b = low(r[5]), low(h[5])
            tag = lambda m: m["etag"].removeprefix("W/") if "etag" in m else None
            if tag(a) and tag(b):
                outcome = "etag" if tag(a) == tag(b) else "mismatch"
            elif "last-modified" in a and "last-modified" in b:
                outcome = "last-modified" if a["last-modified"] == b["last-modified"] else "mismatch"
            else:
                outcome = "unvalidated" if not tag(a) and "last-modified" not in a else "mismatch"
            if outcome not in ("mismatch", "orphan"):
                merged = sorted((b | {k: v for k, v in a.items() if k in W.PERMITTED}).items())
        out.append((r[0], h and h[0], outcome, merged))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    got = W.resolve_revisits(df, **kw).collect()
    return sorted(((r.record_id, r.refers_to, r.outcome, r.headers and [tuple(h) for h in r.headers]) for r in got), key=str)


def test_against_brute_force(spark):
    u, v = "http://www.a.org/x/?utm_source=q#f", "https://a.org:443/x"
    rows = [("f0", "response", u, at(1), 200, {"ETag": '"1"', "Content-Type": "t", "Expires": "old"}, 1)]
    rows += [
        ("f1", "response", v, at(5, 3), 200, {"etag": '"2"', "Last-Modified": "m"}, 1), ("f2", "response", v, at(5, 3), 200, {"Last-Modified": "m"}, 1),
        ("f3", "response", v, at(4), 404, {}, 1), ("f4", "response", v, None, 200, {}, 1), ("f5", "response", None, at(2), 200, {}, 1), ("f6", "response", v, at(9), 200, None, 1),
    ]
    tags = [{"ETag": 'W/"1"', "Expires": "new", "Connection": "x"}, {"etag": '"2"'}, {"LAST-MODIFIED": "m"}, {"last-modified": "n"}, {}, None, {"etag": '"9"'}]
    k = 0
    for h in tags:
        for when in (at(1), at(1, 1), at(3), at(5, 3), at(5, 4), at(20), None):
            rows.append((f"r{k}", "revisit", u if k % 2 else v, when, 304 if k % 3 else None, h, k))
            k += 1
    rows += [("q", "revisit", "http://b.org/", at(7), 304, {}, 0), ("n", "revisit", None, at(7), 304, {}, 0), ("z", "revisit", v, at(7), 200, {}, 0), rows[-1], rows[0]]
    canon = {r[2]: {u: "a", v: "a"}.get(r[2], r[2]) for r in rows}
    want = brute(rows, canon)
    for seconds in (60, 86_400, 10**9):
        assert run(spark, rows, bucket_seconds=seconds) == want


def test_empty_and_urls(spark):
    assert run(spark, []) == []
    cases = {
        "HTTP://WWW.Ex.com:80/A/b//?b=2&a=1&utm_x=1#q": "ex.com/A/b?a=1&b=2", "https://u:p@ex.com": "ex.com", "https://ex.com:8443/?": "ex.com:8443",
        "": "", "mailto": "mailto", None: None, "http://www2.ex.com/?sid=4": "ex.com",
    }
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    assert {r.u: r.c for r in df.select("u", W.canonical_url(df.u).alias("c")).collect()} == cases


@pytest.mark.parametrize("packed", [False, True])
def test_warc_files(spark, tmp_path, packed):
    def record(kind, http, date):
        return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{kind}>\r\nWARC-Date: {date}\r\nWARC-Target-URI: <http://a.org/>\r\nContent-Type: application/http;\r\n msgtype=response\r\nContent-Length: {len(http)}\r\n\r\n".encode() + http + b"\r\n\r\n"

    parts = [record("response", b'HTTP/1.1 200 OK\r\nETag: "1"\r\nX: y\r\n\r\nbody\r\nmore', "2024-01-01T00:00:00Z"), record("revisit", b'HTTP/1.1 304 Not Modified\r\nETag: "1"\r\nDate: d\r\n\r\n', "2024-01-02T00:00:00Z")]
    (tmp_path / "a.warc").write_bytes(b"".join(gzip.compress(p) if packed else p for p in parts))
    rows = W.read_warc(spark, str(tmp_path / "a.warc"))
    assert [(r.type, r.status, bytes(r.body)) for r in rows.collect()] == [("response", 200, b"body\r\nmore"), ("revisit", 304, b"")]
    (got,) = W.resolve_revisits(rows).collect()
    assert (got.outcome, got.refers_to, [tuple(h) for h in got.headers]) == ("etag", "<urn:response>", [("date", "d"), ("etag", '"1"'), ("x", "y")])


def test_query_matches_its_sql(spark):
    from textlode.llm.queries import op10_warc_revisits, oracle_sql

    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{d}/pages.parquet'")
    df = op10_warc_revisits(spark, d)
    want = con.sql(oracle_sql()["op10_warc_revisits"])
    assert sorted(df.columns) == sorted(want.columns)
    got = sorted((tuple(r[c] for c in want.columns) for r in df.collect()), key=str)
    assert got == sorted(want.fetchall(), key=str)
    assert {"etag", "orphan", "unvalidated", "mismatch"} <= {r.outcome for r in df.collect()}


def one(i, date="2024-01-01T00:00:00Z", extra=""):
    http = f"HTTP/1.1 200 OK\r\nETag: {i}\r\n\r\nbody {i}".encode()
    return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: r{i}\r\nWARC-Date: {date}\r\nWARC-Target-URI: http://a.org/{i}\r\n{extra}Content-Type: application/http\r\nContent-Length: {len(http)}\r\n\r\n".encode() + http + b"\r\n\r\n"


def test_damaged_files_give_their_whole_records_and_an_error(spark, tmp_path):
    cases = {
        "cut.warc.gz": gzip.compress(one(1)) + gzip.compress(one(2) * 50)[:90],
        "cut.warc": one(1) + one(2)[:-20],
        "length.warc": one(1) + one(2).replace(b"Content-Length: ", b"Content-Length: x") + one(3),
        "stray.warc": one(1) + b"what is this\r\nand this\r\n" + one(2),
        "noise.warc.gz": gzip.compress(one(1)) + b"\x1f\x8bnoise",
        "head.warc": one(1) + one(2)[:60], "empty.warc": b"", "blank.warc": b"\r\n\r\n", "one.warc": b"W",
        "status.warc": one(1).replace(b"200 OK", b"9999999999999 OK", 1).replace(b"Content-Length: 34", b"Content-Length: 44"),
    }
    want = {"cut.warc.gz": (["r1"], 1), "cut.warc": (["r1"], 1), "length.warc": (["r1", "r3"], 1), "stray.warc": (["r1", "r2"], 1), "noise.warc.gz": (["r1"], 1), "head.warc": (["r1"], 1), "empty.warc": ([], 0), "blank.warc": ([], 0), "one.warc": ([], 1), "status.warc": (["r1"], 0)}
    for name, raw in cases.items():
        (tmp_path / name).write_bytes(raw)
        rows = W.read_warc(spark, str(tmp_path / name)).collect()
        ids = [r.record_id for r in rows if r.record_id]
        # of a truncated member some records may be whole
        assert ids[: len(want[name][0])] == want[name][0] and (name.startswith("cut.warc.gz") or ids == want[name][0]), name
        assert sum(r.error is not None for r in rows) == want[name][1], name
    assert W.read_warc(spark, str(tmp_path)).count() >= 10


def test_long_archives_are_read_record_by_record():
    class Stream:
        def __init__(self):
            self.left, self.served = 3000, 0

        def read(self, n):
            if not self.left:
                return b""
            self.left -= 1
            self.served += 1
            return one(self.left)[:n] if n < 100 else one(self.left)

    found = W.parse_warc(s := Stream())
    next(found)
    assert s.served < 2000


def test_profiles_of_revisits_without_status(spark):
    rows = [("f", "response", "http://a.org/", at(1), 200, {"etag": "1"}, None)]
    kinds = [None, "http://netpreserve.org/warc/1.1/revisit/server-not-modified", "http://netpreserve.org/warc/1.0/revisit/server-not-modified/", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    rows += [(f"r{i}", "revisit", "http://a.org/", at(2), status, {}, p) for i, (p, status) in enumerate([(k, s) for s in (None, 304, 200) for k in kinds])]
    df = spark.createDataFrame(rows, "record_id string, type string, uri string, date timestamp, status int, headers map<string,string>, profile string")
    got = {r.record_id: r.outcome for r in W.resolve_revisits(df).collect()}
    assert got == {k: "unvalidated" for k in ("r0", "r1", "r2", "r4", "r5", "r6", "r7")}


def test_many_records_of_one_url_and_date(spark):
    rows = [(f"f{i:03d}", "response", "http://a.org/", at(1), 200, {"etag": str(i)}, i) for i in range(300)]
    rows += [(f"r{i:03d}", "revisit", "http://a.org/", at(1 + i % 3), 304, {"etag": str(i)}, i) for i in range(300)]
    assert run(spark, rows) == brute(rows, {"http://a.org/": "a"})
