"""WARC archives: writing captures, and assembling their records again.

Writing: each page becomes a request, a response or revisit, and a metadata
record, in gzip members of their own; request and metadata name the response in
WARC-Concurrent-To. Of pages with one payload the largest page_id is the
response, others are revisits that refer to it. Payloads that occur once never
move: a bit table of fixed size built from the repeated digests rules them out,
and only the others meet the table of repeated payloads in a join.

Reading: every archive is read member by member into one row per record
(headers, digest and length of the payload, place in the file; not the payload).
Assembly joins request, response and metadata records through their
concurrent-to identifiers (whichever side names the other) and emits one nested
row per capture; a payload is fetched by its place when asked for.

A task writes under a name of its own attempt and reports the file as a row
that Spark commits, so files of lost tasks are never read.

Defined cases: null html is the empty payload, which is a payload like others.
Null page_ids rank below all; a payload only they have makes each a response.
Rows that repeat the largest page_id of a payload are all responses, each with a record id
of its own; revisits name one of them. An archive that ends inside a record raises; the payload
digest may be missing, and header names count in any case. Null url:
no target URI, and control characters of an url are percent-encoded in headers.
A request or metadata record whose partner is missing makes a capture with a
null response. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equilibra.llm._work import bit_words, cells, files_of, in_words, partition, run_dir, saved

RECORD = "kind string, record_id string, concurrent_to string, refers_to string, uri string, payload_digest string, payload_bytes long, page_id long, file string, at long"
#: Fixed values of the format.
VERSION, PROFILE = b"WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_key(page_id: int | None, key: str) -> str:
    """Record id of the response that holds a payload: a name of the page and the payload."""
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id} {key}'.encode()).hexdigest())}>"


def member(kind: str, record_id: str, block: bytes, **headers: str | None) -> bytes:
    """One record as a gzip member."""
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", "WARC-Date: 2000-01-01T00:00:00Z"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items() if v is not None]
    head = VERSION + b"\r\n" + "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n"
    gz = zlib.compressobj(1, zlib.DEFLATED, 31)
    return gz.compress(head) + gz.compress(block) + gz.compress(b"\r\n\r\n") + gz.flush()


def capture(page_id: int | None, url: str | None, payload: bytes, key: str, refers: int | None, revisit: bool, named: bool) -> Iterator[bytes]:
    """The records of one page. ``named``: this response is the one that revisits of its payload name."""
    uri = None if url is None else quote(url, safe="%/:?#[]@!$&'()*+,;=-._~ ")
    name = page_key(page_id, key) if named else f"<urn:uuid:{uuid.uuid4()}>"
    sha1 = f"sha1:{digest(payload)}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    yield member("request", f"<urn:uuid:{uuid.uuid4()}>", b"GET / HTTP/1.1\r\n\r\n", WARC_Concurrent_To=name, WARC_Target_URI=uri, Content_Type="application/http; msgtype=request")
    if revisit:
        yield member("revisit", name, http, WARC_Target_URI=uri, WARC_Payload_Digest=sha1, WARC_Profile=PROFILE, WARC_Refers_To=page_key(refers, key), Content_Type="application/http; msgtype=response")
    else:
        yield member("response", name, http + payload, WARC_Target_URI=uri, WARC_Payload_Digest=sha1, Content_Type="application/http; msgtype=response")
    yield member("metadata", f"<urn:uuid:{uuid.uuid4()}>", b"" if page_id is None else f"page-id: {page_id}\r\n".encode(), WARC_Concurrent_To=name, WARC_Target_URI=uri, Content_Type="application/warc-fields")


def members(file, room: int = 1 << 20) -> Iterator[tuple[int, bytes, bytes]]:
    """(place, head, block) of each record of an archive, read in pieces of ``room`` bytes."""
    at, data, whole, end = 0, b"", bytearray(), zlib.decompressobj(31)
    place = 0
    while data or (data := file.read(room)):
        whole += end.decompress(data)
        at += len(data) - len(end.unused_data)
        data = end.unused_data
        if end.eof:
            head, _, rest = bytes(whole).partition(b"\r\n\r\n")
            yield place, head, rest[:-4]
            place, whole, end = at, bytearray(), zlib.decompressobj(31)
    if at > place:
        raise ValueError(f"the archive ends inside the record at {place}")


def headers(head: bytes) -> dict[str, str]:
    """A record's named fields; their names count in any case."""
    fields = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in fields}


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives under ``folder``; a row (file, captures) for each."""
    payloads = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    payloads = payloads.withColumn("key", F.sha2("html", 256))
    ids = saved(payloads.select("page_id", "key"), f"{folder}/payloads")
    # Per payload and page_id first: how many rows the largest page_id has.
    each = ids.groupBy("key", "page_id").agg(F.count(F.lit(1)).alias("n"))
    many = each.groupBy("key").agg(F.max("page_id").alias("refers"), F.sum("n").alias("n"), F.max_by(F.when(F.col("page_id").isNotNull(), F.col("n")), "page_id").alias("tops"))
    many = saved(many.filter("n > 1 and refers is not null").select(F.col("key").alias("rkey"), "refers", "tops"), f"{folder}/repeated")
    marked = in_words(payloads, F.xxhash64("key"), bit_words(many.select(F.xxhash64("rkey").alias("h"))))
    columns, plain = ["page_id", "url", "html", "key", "refers", "named"], F.lit(False).alias("named")
    sure = marked.filter(~F.col("__hit")).select("page_id", "url", "html", "key", F.lit(None).cast("long").alias("refers"), plain)
    asked = marked.filter("__hit").join(many, F.col("key") == F.col("rkey"), "left")
    top = F.coalesce(F.col("page_id") == F.col("refers"), F.lit(False))
    asked = asked.withColumn("named", top & (F.col("tops") == 1)).withColumn("again", top & (F.col("tops") > 1))
    if many.filter("tops > 1").isEmpty():
        asked = asked.select(columns)
    else:
        # Equal rows can't be told apart, so they travel as one with a count; of all rows of
        # a payload's largest page_id, one is named.
        equal = saved(asked.filter("again").groupBy("page_id", "url", "html", "key", "refers").agg(F.count(F.lit(1)).alias("times")), f"{folder}/equal")
        first = equal.groupBy("key").agg(F.min(F.struct(F.col("url").isNull().alias("none"), "url")).alias("first")).select(F.col("key").alias("fkey"), "first.url")
        first = first.withColumnRenamed("url", "furl")
        spread = equal.join(first, (F.col("key") == F.col("fkey")), "left").withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
        spread = spread.withColumn("named", (F.col("k") == 1) & F.col("url").eqNullSafe(F.col("furl")))
        asked = asked.filter("not again").select(columns).unionByName(spread.select(columns))

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        stream, name, n = None, "", 0
        for page_id, url, html, key, refers, named in cells(batches, "page_id", "url", "html", "key", "refers", "named"):
            if stream is None:
                fs, root = files_of(folder)
                fs.create_dir(root, recursive=True)
                name = f"{partition():05d}-{uuid.uuid4().hex}.warc.gz"
                stream = fs.open_output_stream(f"{root}/{name}", compression=None)
            for record in capture(page_id, url, html.encode(), key, refers, refers is not None and page_id != refers, named):
                stream.write(record)
            n += 1
        if stream:
            stream.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "captures": n}], pa.schema([("file", pa.string()), ("captures", pa.int64())]))

    rows = sure.unionByName(asked).withColumn("page_id", F.col("page_id").cast("long")).withColumn("refers", F.col("refers").cast("long"))
    return saved(rows.mapInArrow(write, "file string, captures long"), f"{folder}/archives")


def read_records(archives: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives named in ``archives.file``."""

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in RECORD.split(", ")])
        fs, root = files_of(folder)
        for (name,) in cells(batches, "file"):
            rows: list[dict] = []
            with fs.open_input_stream(f"{root}/{name}", compression=None) as file:
                for at, head, block in members(file):
                    h = headers(head)
                    row = {"kind": h["warc-type"], "record_id": h["warc-record-id"], "concurrent_to": h.get("warc-concurrent-to"), "refers_to": h.get("warc-refers-to"), "uri": h.get("warc-target-uri"), "file": name, "at": at}
                    told = h.get("warc-payload-digest", "")
                    if row["kind"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        row |= {"payload_digest": digest(payload), "payload_bytes": len(payload)}
                        if told.startswith("sha1:") and told != f"sha1:{row['payload_digest']}":
                            raise ValueError(f"{name}: damaged payload at {at}")
                    elif row["kind"] == "revisit":
                        row["payload_digest"] = told.removeprefix("sha1:") or None
                    elif row["kind"] == "metadata" and block.startswith(b"page-id: "):
                        row["page_id"] = int(block[9:].split(b"\r\n")[0])
                    rows.append(row)
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select("file").repartition(max(1, archives.count())).mapInArrow(read, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response (a response or revisit), requests, metadata."""
    fields = F.struct(*(c.split()[0] for c in RECORD.split(", ")))
    heads = records.filter("kind in ('response', 'revisit')").select(F.col("record_id").alias("head_id"), F.col("concurrent_to").alias("head_to"), fields.alias("response"))
    others = records.filter("kind in ('request', 'metadata')").select("kind", "record_id", "concurrent_to", fields.alias("r"))
    named = heads.filter("head_to is not null").select(F.col("head_id").alias("by_head"), F.col("head_to").alias("by_id")).dropDuplicates(["by_id"])
    others = others.join(named, F.col("record_id") == F.col("by_id"), "left")
    others = others.groupBy(F.coalesce("by_head", "concurrent_to", "record_id").alias("other_id")).agg(
        F.collect_list(F.when(F.col("kind") == "request", F.col("r"))).alias("requests"), F.collect_list(F.when(F.col("kind") == "metadata", F.col("r"))).alias("metadata")
    )
    return heads.join(others, F.col("head_id") == F.col("other_id"), "full").select(F.coalesce("head_id", "other_id").alias("capture_id"), "response", "requests", "metadata")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives of all pages, read them back; per page: page_id, payload_bytes,
    payload_digest, record_type, refers_to, uri."""
    folder = run_dir(pages.sparkSession, "warc")
    archives = write_archives(pages.select("page_id", "url", "html"), folder)
    records = saved(read_records(archives, folder), f"{folder}/records")
    captures = assemble(records).select(
        "capture_id", "response.kind", "response.refers_to", "response.uri", "response.payload_digest", "response.payload_bytes", F.col("metadata")[0]["page_id"].alias("page_id")
    )
    captures = saved(captures, f"{folder}/captures")
    named = captures.filter("kind = 'response'").select(F.col("capture_id").alias("to"), F.col("page_id").alias("to_page"), F.col("payload_bytes").alias("to_bytes")).dropDuplicates(["to"])
    whole = captures.filter("kind = 'response'").select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "uri")
    again = captures.filter("kind = 'revisit'").join(named, F.col("refers_to") == F.col("to"), "left")
    return whole.unionByName(again.select("page_id", F.col("to_bytes").alias("payload_bytes"), "payload_digest", F.lit("revisit").alias("record_type"), F.col("to_page").alias("refers_to"), "uri"))
