"""WARC files: captures written as request, response / revisit and metadata
records, read back and assembled into one nested row per capture.

Every record is a gzip member of its own. Request and metadata records name
their response or revisit in WARC-Concurrent-To; reading parses all records and
joins them by that identifier. A payload of at least ``MIN_REVISIT`` bytes that
was seen before (equal SHA-256) is not stored again: its record is a revisit
with WARC-Refers-To the response of the smallest page_id.

Files are written by the tasks into the shared folder, one per task, with a
list of ranges (about ``RANGE_BYTES``) that start at record boundaries, so
large archives are read by many tasks.

Defined results: null html is an empty payload; null ids come last in the
choice of a response; of repeated rows of the smallest id one is the response;
null urls are left out of the records; other columns are ignored; empty tables
give no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, prepare, scratch, table
from .files import open_fs, write_whole

MIN_REVISIT = 100
RANGE_BYTES = 4 << 20
DATE = "1970-01-01T00:00:00Z"  # the tables hold no capture times
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(kind: str, uid: int) -> str:
    h = hashlib.sha256(f"{kind}:{uid}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-8{h[17:20]}-{h[20:32]}>"


def member(headers: dict[str, str | None], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None) \
        + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(4, wbits=31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def capture(uid: int, page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    """The three records of one capture."""
    main = record_id("main", uid)
    uri = None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=~-._")
    about = {"WARC-Date": DATE, "WARC-Target-URI": uri}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    shared = about | {"WARC-Record-ID": main, "WARC-Payload-Digest": f"sha256:{digest}",
                      "Content-Type": "application/http;msgtype=response"}
    if refers is None:
        first = member({"WARC-Type": "response"} | shared, http + payload)
    else:
        first = member({"WARC-Type": "revisit", "WARC-Profile": PROFILE,
                        "WARC-Refers-To": record_id("main", refers)} | shared, http)
    request = member({"WARC-Type": "request", "WARC-Record-ID": record_id("request", uid), "WARC-Concurrent-To": main,
                      "Content-Type": "application/http;msgtype=request"} | about,
                     f"GET {uri or '/'} HTTP/1.1\r\n\r\n".encode())
    fields = "" if page_id is None else f"page-id: {page_id}\r\n"
    metadata = member({"WARC-Type": "metadata", "WARC-Record-ID": record_id("metadata", uid), "WARC-Concurrent-To": main,
                       "Content-Type": "application/warc-fields"} | about, fields.encode())
    return request + first + metadata


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members that follow each other in ``data``."""
    at, step = 0, 1 << 14
    while at < len(data):
        z, out = zlib.decompressobj(wbits=31), []
        while not z.eof:
            if at >= len(data):
                raise ValueError("truncated gzip member")
            part = data[at:at + step]
            out.append(z.decompress(part))
            at += len(part)
        at -= len(z.unused_data)
        yield b"".join(out)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(headers["content-length"])
    if len(rest) != n + 4:
        raise ValueError("record length differs from its Content-Length")
    return headers, rest[:n]


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (uid, page_id, url, html, digest, refers_uid); one row per range of a file."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        ranges: list[tuple[str, int, int]] = []

        def fill(out) -> None:
            start = at = 0
            for pdf in batches:
                for uid, page_id, url, html, digest, refers in zip(
                        pdf["uid"], pdf["page_id"], pdf["url"], pdf["html"], pdf["digest"], pdf["refers_uid"]):
                    data = capture(uid, None if pd.isna(page_id) else int(page_id), url,
                                   (html or "").encode(), digest, None if pd.isna(refers) else int(refers))
                    out.write(data)
                    at += len(data)
                    if at - start >= RANGE_BYTES:
                        ranges.append((name, start, at - start))
                        start = at
            if at > start:
                ranges.append((name, start, at - start))

        write_whole(name, fill)
        yield pd.DataFrame(ranges, columns=["file", "start", "length"])

    # Ids travel as text: pandas would turn nullable integers into floats.
    return pages.select("uid", F.col("page_id").cast("string").alias("page_id"), "url", "html", "digest",
                        F.col("refers_uid").cast("string").alias("refers_uid")) \
        .mapInPandas(run, "file string, start long, length long")


RECORDS = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
           "payload_digest string, payload_bytes long, payload binary, page_id long")


def read_records(ranges: DataFrame) -> DataFrame:
    """All records of the ranges, one row each; stored payloads are held against their digests."""
    def one(data: bytes) -> tuple:
        h, block = parse(data)
        kind, digest = h["warc-type"], (h.get("warc-payload-digest") or ":").split(":")[1] or None
        n = payload = page = None
        if kind in ("response", "revisit"):
            http, _, body = block.partition(b"\r\n\r\n")
            n = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            if kind == "response":
                payload = body
                if len(body) != n or hashlib.sha256(body).hexdigest() != digest:
                    raise ValueError(f"payload of {h['warc-record-id']} differs from its digest")
        elif kind == "metadata" and block:
            page = int(block.split(b":")[1])
        uri = h.get("warc-target-uri")
        return (h["warc-record-id"], kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"),
                None if uri is None else unquote(uri), digest, n, payload, page)

    names = [x.split()[0] for x in RECORDS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, start, length in zip(pdf["file"], pdf["start"], pdf["length"]):
                fs, path = open_fs(file)
                with fs.open_input_file(path) as f:
                    f.seek(int(start))
                    data = f.read(int(length))
                rows, held = [], 0
                for m in members(data):
                    rows.append(one(m))
                    held += len(m)
                    if held >= 8 << 20:
                        yield _frame(rows, names)
                        rows, held = [], 0
                yield _frame(rows, names)

    return ranges.mapInPandas(run, RECORDS)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for c in ("payload_bytes", "page_id"):
        out[c] = out[c].astype("Int64")
    return out


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: its response or revisit joined with the request and
    metadata records that are concurrent to it (structs; null where absent)."""
    by_type = lambda *kinds: records.filter(F.col("type").isin(*kinds))
    main = by_type("response", "revisit").drop("concurrent_to", "page_id").withColumnRenamed("record_id", "capture_id")
    request = by_type("request").select(F.col("concurrent_to").alias("capture_id"),
                                        F.struct("record_id", "target_uri").alias("request"))
    metadata = by_type("metadata").select(F.col("concurrent_to").alias("capture_id"),
                                          F.struct("record_id", "page_id").alias("metadata"))
    # Records made by readers look tiny to the planner, so it must not broadcast them.
    return main.join(request.hint("merge"), "capture_id", "left").join(metadata.hint("merge"), "capture_id", "left")


def archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Write ``pages`` as WARC files under ``folder``; returns the ranges written."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
                        F.monotonically_increasing_id().alias("uid")).withColumn("digest", F.sha2("html", 256))
    # Only keys are written between the passes; the html is read from ``pages`` again (files, so row numbers stay).
    keys = materialise(rows.filter(F.octet_length("html") >= MIN_REVISIT).select("uid", "page_id", "digest"), "keys")
    seen = keys.groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "uid")).alias("first"),
        F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", F.col("first.uid").alias("refers_uid"))
    again = materialise(keys.join(seen, "digest").filter("refers_uid <> uid").select("uid", "refers_uid"), "again")
    return materialise(write_archives(rows.join(again.hint("merge"), "uid", "left"), folder), "ranges")


def op9_warc(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    ranges = archive(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    records = materialise(read_records(ranges.repartition(max(1, ranges.count()))).drop("payload"), "records")
    found = materialise(assemble(records).select(
        "capture_id", "refers_to", "payload_bytes", "payload_digest", "type",
        F.col("metadata.page_id").alias("page_id")), "captures")
    # Responses refer to nothing: only revisits are joined.
    responses = found.filter("type = 'response'")
    first = responses.select(F.col("capture_id").alias("refers_to"), F.col("page_id").alias("first_page"))
    revisits = found.filter("type = 'revisit'").join(first, "refers_to", "left")
    both = responses.withColumn("first_page", F.lit(None).cast("long")).unionByName(revisits)
    return both.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("first_page").alias("refers_to"))


def oracle() -> str:
    return """
with p as (select row_number() over () as rid, page_id, coalesce(html, '') as html from pages),
q as (select *, octet_length(encode(html)) as n, sha256(html) as digest,
        row_number() over w as k, first_value(page_id) over w as first_id
      from p window w as (partition by html order by page_id nulls last, rid))
select page_id, n::bigint as payload_bytes, digest as payload_digest,
  case when n >= 100 and k > 1 then 'revisit' else 'response' end as record_type,
  case when n >= 100 and k > 1 then first_id end as refers_to from q"""
