"""WARC archives: writing, reading, and assembling transactions.

A transaction is a request, the response (or a revisit of an earlier one) and its metadata,
each a record of its own, tied together by WARC-Concurrent-To. Assembly joins the
records through these identifiers and gives one nested row per capture.

Archives are written by Spark's text writer, whose line separator is the blank line pair that
ends a record, so files appear with the job's commit and a lost task leaves nothing behind.
They are read whole, a file per row, so the writer keeps them small (`ARCHIVE_BYTES`
of payload on average, compressed); a record itself has to fit into one value, that is 2 GB. Records keep
their headers, HTTP head and payload, also inside the assembled captures.

Assembly decides on light rows, whose responses have no payload, named by file and place, which are the
same on every read; the payloads are read once more and cross one shuffle. The copy that fixes the row numbers for the writer is
emptied when the archives are there.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import stored, table
from almanac.llm.superminhash import components
from almanac.session import staging_path

ARCHIVE_BYTES = 16 << 20
LEAST_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAIN_TYPES = ("response", "revisit", "resource")
BLOCK = ("headers", "http_head", "payload")
_HEAD = re.compile(rb"\s*WARC/\d+\.\d+\r?\n")
_NEXT = re.compile(rb"(?m)^WARC/\d+\.\d+\r?\n")
RECORD = (
    "file string, place bigint, record_type string, record_id string, concurrent_to array<string>, "
    "target_uri string, date string, refers_to string, payload_digest string, block_bytes bigint, "
    "http_status string, payload_bytes bigint, payload_sha1 string, fields map<string,string>, error string, "
    "headers array<struct<name:string,value:string>>, http_head binary, payload binary"
)


def _record(kind: Column, uid: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """The text of one record but its end; headers whose value is null are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), uid)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def _uid(kind: str, uid: Column) -> Column:
    name = F.sha1(F.concat_ws(":", F.lit(kind), uid.cast("string")).cast("binary"))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def captures(pages: DataFrame, least: int = LEAST_REVISIT) -> tuple[DataFrame, str]:
    """Pages with digest, size and the capture that holds their payload; and the folder of their stored copy.

    Of pages with equal payloads of at least `least` bytes the one with the largest page_id is the response,
    the others revisit it. The group is found by a combined maximum per digest; the
    pages of a large group then meet one row in a join of narrow rows that the runtime may split.
    """
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text.alias("html"),
        F.octet_length(text).cast("long").alias("size"), F.sha1(text.cast("binary")).alias("digest"),
        F.monotonically_increasing_id().alias("uid"),
    )
    path = staging_path(pages.sparkSession, "captures")
    rows.write.parquet(path, compression="zstd")  # fixes the row numbers
    rows = pages.sparkSession.read.schema(rows.schema).parquet(path)
    big = rows.where(F.col("size") >= least).select("digest", "page_id", "uid")
    held = big.groupBy("digest").agg(F.max(F.struct("page_id", "uid"))["uid"].alias("held_by"))
    # only the revisits are named, so the payloads meet a narrow table by their row number
    revisits = big.join(held, "digest").where("uid <> held_by").select("uid", "held_by")
    return rows.join(stored(revisits, "revisits"), "uid", "left"), path


def write_warc(pages: DataFrame, path: str, least: int = LEAST_REVISIT) -> None:
    """Write a request, a response or revisit, and a metadata record per page.

    Null ids and addresses are left out of the records and come back as null. Repeated rows are
    captures of their own; an empty table gives no archive.
    """
    rows, copy = captures(pages, least)
    revisit = F.col("held_by").isNotNull()
    uri = F.col("url")
    for sign, code in ((" ", "%20"), ("\r", "%0D"), ("\n", "%0A")):  # a header is one line
        uri = F.replace(uri, F.lit(sign), F.lit(code))
    main, date = _uid("main", F.col("uid")), F.lit(DATE)
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    status = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ")
    head = F.concat(status, F.col("size").cast("string"), F.lit(END))
    shared = [("WARC-Date", date), ("WARC-Target-URI", uri)]
    tied = [("WARC-Concurrent-To", main)]
    http = F.lit("application/http; msgtype=")
    answer = _record(
        F.when(revisit, "revisit").otherwise("response"),
        main,
        [
            *shared,
            ("WARC-Payload-Digest", digest),
            ("WARC-Refers-To", F.when(revisit, _uid("main", F.col("held_by")))),
            ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            ("Content-Type", F.concat(http, F.lit("response"))),
        ],
        F.when(revisit, head).otherwise(F.concat(head, F.col("html"))),
    )
    ask = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1"), F.lit(END))
    request = _record(
        F.lit("request"), _uid("request", F.col("uid")),
        [*shared, *tied, ("Content-Type", F.concat(http, F.lit("request")))], ask,
    )
    page = F.concat_ws("\r\n", F.concat(F.lit("page_id: "), F.col("page_id").cast("string")), F.lit(""))
    metadata = _record(
        F.lit("metadata"), _uid("metadata", F.col("uid")),
        [*shared, *tied, ("Content-Type", F.lit("application/warc-fields"))], page,
    )
    sizes = pages.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("html")).alias("bytes")).first()
    most = max(3, 3 * int(ARCHIVE_BYTES * sizes["n"] / max(1, sizes["bytes"] or 0)))
    lines = rows.select(F.explode(F.array(request, answer, metadata)).alias("value"))
    options = {"lineSep": END, "compression": "gzip", "zlib.compress.level": "THREE"}
    lines.write.options(maxRecordsPerFile=str(most), **options).text(path)
    pages.sparkSession.createDataFrame([], rows.schema).write.mode("overwrite").parquet(copy)


def parse(data: bytes) -> Iterator[dict]:
    """The records of an archive, plain or compressed, with their headers and block.

    What is no record is given as a row with an error, and reading goes on at the next record header.
    Of a compressed archive that is cut off or damaged, what can be unpacked is read, and the
    damage is an error row.
    """
    damage = None
    if data[:2] == b"\x1f\x8b":
        data, damage = _unpacked(data)
    at = 0
    while at < len(data):
        if not data[at : at + 64].strip() and not data[at:].strip():
            break
        found = _HEAD.match(data, at)
        end = data.find(b"\r\n\r\n", found.end()) if found else -1
        if end < 0:
            yield {"place": at, "error": "no record header", "headers": [], "block": b""}
            at = _next_head(data, found.end() if found else at + 1)
            continue
        headers = []
        for line in data[found.end() : end].split(b"\r\n"):
            name, _, value = line.partition(b":")
            headers.append((name.decode("utf-8", "replace").strip().lower(), value.decode("utf-8", "replace").strip()))
        size = dict(headers).get("content-length", "")
        if not size.isdigit() or end + 4 + int(size) > len(data):
            yield {"place": at, "error": "bad content length", "headers": headers, "block": b""}
            at = _next_head(data, end)
            continue
        block = data[end + 4 : end + 4 + int(size)]
        yield {"place": at, "error": None, "headers": headers, "block": block}
        at = end + 4 + int(size)
    if damage:
        yield {"place": len(data), "error": damage, "headers": [], "block": b""}


def _unpacked(data: bytes) -> tuple[bytes, str | None]:
    """The content of all gzip members up to the first that is damaged, with what can be had of it."""
    out, damage = [], None
    while data[:2] == b"\x1f\x8b" and not damage:
        member = zlib.decompressobj(wbits=31)
        try:
            out.append(member.decompress(data))
        except zlib.error:
            # once more in small pieces, to keep what comes before the damage
            member = zlib.decompressobj(wbits=31)
            damage = "damaged gzip member"
            for i in range(0, len(data), 512):
                try:
                    out.append(member.decompress(data[i : i + 512]))
                except zlib.error:
                    break
            break
        if not member.eof:
            damage = "cut-off gzip member"
        data = member.unused_data
    return b"".join(out), damage


def _next_head(data: bytes, at: int) -> int:
    """Where the next record header from `at` on begins, or the end."""
    found = _NEXT.search(data, at)
    return found.start() if found else len(data)


def _row(file: str, record: dict) -> dict:
    headers = dict(record["headers"])
    block, kind = record["block"], headers.get("warc-type")
    status, http_head, payload, fields = None, None, block, {}
    if headers.get("content-type", "").startswith("application/http"):
        head, gap, payload = block.partition(b"\r\n\r\n")
        http_head = head + gap
        status = head.split(b"\r\n")[0].decode("utf-8", "replace")
    elif headers.get("content-type", "").startswith("application/warc-fields"):
        for line in block.decode("utf-8", "replace").splitlines():
            name, colon, value = line.partition(":")
            if colon:
                fields[name.strip()] = value.strip()
    return {
        "file": file, "place": record["place"], "record_type": kind, "record_id": headers.get("warc-record-id"),
        "concurrent_to": [v for k, v in record["headers"] if k == "warc-concurrent-to"],
        "target_uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"),
        "refers_to": headers.get("warc-refers-to"), "payload_digest": headers.get("warc-payload-digest"),
        "block_bytes": len(block), "http_status": status, "payload_bytes": len(payload),
        "payload_sha1": hashlib.sha1(payload).hexdigest(), "fields": list(fields.items()), "error": record["error"],
        "headers": [{"name": k, "value": v} for k, v in record["headers"]], "http_head": http_head, "payload": payload,
    }


_ARROW = pa.schema(
    [
        ("file", pa.string()), ("place", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
        ("concurrent_to", pa.list_(pa.string())), ("target_uri", pa.string()), ("date", pa.string()),
        ("refers_to", pa.string()), ("payload_digest", pa.string()), ("block_bytes", pa.int64()),
        ("http_status", pa.string()), ("payload_bytes", pa.int64()), ("payload_sha1", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())), ("error", pa.string()),
        ("headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
        ("http_head", pa.binary()), ("payload", pa.binary()),
    ]
)


def _reader(light: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for record in parse(batch.column(1)[i].as_py() or b""):
                    row = _row(batch.column(0)[i].as_py(), record)
                    if light and row["record_type"] in MAIN_TYPES:
                        row.update(dict.fromkeys(BLOCK))
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if len(rows) == 2000 or size > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return run


def read_warc(spark: SparkSession, path: str, light: bool = False) -> DataFrame:
    """One row per record of the archives under a path; http_head and payload together are its block.

    With `light` responses, revisits and resources come without their headers and block.
    """
    # an archive per batch keeps one file in memory at a time
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_reader(light), RECORD)


def _without_main(ids: DataFrame, links: DataFrame) -> DataFrame:
    """record_id and capture of records (node) that no main is linked with: the smallest id of those linked.

    All links of such records are links among themselves, or through ids that are not there.
    """
    known = ids.select(F.col("node").alias("a"))
    step = links.join(known, "a", "left_semi")
    # the ids in between are linked with these records alone, else a main would reach them
    step = step.unionByName(step.select(F.col("b").alias("a"), F.col("a").alias("b")))
    apart = step.select(F.col("a").cast("binary"), F.col("b").cast("binary")).where("a < b").distinct()
    roots = components(apart).select(F.col("node").cast("string").alias("node"), "root")
    alone = ids.join(roots, "node", "left")
    alone = alone.withColumn("root", F.coalesce("root", F.col("node").cast("binary")))
    least = alone.groupBy("root").agg(F.min("node").alias("capture"))
    return alone.join(least, "root").select(F.col("node").alias("record_id"), "capture")


def assemble(records: DataFrame, light: DataFrame | None = None) -> DataFrame:
    """One nested row per capture: record_id, main, requests, metadata, others.

    Records are linked when one names the other as concurrent, whichever it is. A record belongs to
    the response, revisit or resource that is the fewest links away, of several the one with the
    smallest id. Linked records that reach none, also those linked through an id that is not there,
    are one capture with an empty main and the smallest of their ids. Repeated records count once;
    records without an id are left out. The records of one capture are one row by its definition.
    `light` gives the same records, where responses may lack headers and block, if that is cheaper to have.
    """
    usable = "record_id is not null and error is null"
    is_main = F.coalesce(F.col("record_type").isin(*MAIN_TYPES), F.lit(False))
    columns = [c for c in records.columns if c != "error"]
    if not {"file", "place"} <= set(columns):  # records from elsewhere: numbered, and fixed by a copy
        numbered = {"file": F.lit(""), "place": F.monotonically_increasing_id()}
        records, light = stored(records.withColumns(numbered), "numbered"), None
    if light is None:
        light = records.withColumns({c: F.when(~is_main, F.col(c)) for c in BLOCK if c in columns})
    rows = stored(light.where(usable).drop("error"), "records", "zstd")
    # only repeated rows are named, so the payloads meet a narrow table by file and place
    # by hash, which is narrower; what only shares the hash is told apart by its id after that
    hashed = rows.select(F.xxhash64("record_id").alias("_hash"), "record_id", "file", "place")
    twice = stored(hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "twice")
    twice = hashed.join(twice.select("_hash"), "_hash")
    at = F.struct("file", "place")
    first = twice.groupBy("record_id").agg(F.min(at).alias("_first"))
    again = twice.join(first, "record_id").where(at != F.col("_first")).select("file", "place")
    again = stored(again, "repeated")
    given = rows.join(again, ["file", "place"], "left_anti").select(*rows.columns)
    named = given.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b")).where("b is not null")
    links = stored(named.unionByName(named.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links", "zstd")
    placed = edge = given.where(is_main).select(F.col("record_id").alias("node"), F.col("record_id").alias("capture"))
    ids = given.where(~is_main).select(F.col("record_id").alias("node"))
    reached = None
    while True:  # one more link away in each turn, as long as records are left and something is reached
        near = edge.join(links, F.col("node") == F.col("a")).groupBy(F.col("b").alias("node"))
        edge = stored(near.agg(F.min("capture").alias("capture")).join(placed, "node", "left_anti"), "reached", "zstd")
        placed = placed.unionByName(edge)
        reached = edge if reached is None else reached.unionByName(edge)
        ids = stored(ids.join(edge, "node", "left_anti"), "left")
        if ids.isEmpty() or edge.isEmpty():
            break
    found = reached.withColumnRenamed("node", "record_id")
    if not ids.isEmpty():
        found = stored(found.unionByName(_without_main(ids, links)), "placed")
    # a main is its own capture, so its payload is not joined
    whole = records.where(usable).where(is_main).drop("error").join(again, ["file", "place"], "left_anti")
    every = whole.withColumn("capture", F.col("record_id")).unionByName(
        given.where(~is_main).join(found, "record_id")
    )
    record = F.struct(*columns)
    of = lambda *kinds: F.collect_list(F.when(F.col("record_type").isin(*kinds), record))
    rest = F.collect_list(F.when(~F.coalesce(F.col("record_type").isin("request", "metadata", *MAIN_TYPES), F.lit(False)), record))
    return every.groupBy(F.col("capture").alias("record_id")).agg(
        F.first(F.when(F.col("record_type").isin(*MAIN_TYPES), record), ignorenulls=True).alias("main"),
        of("request").alias("requests"),
        of("metadata").alias("metadata"),
        rest.alias("others"),
    )


def page_captures(records: DataFrame, light: DataFrame | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each assembled capture.

    The figures of a revisit are those read from the record it refers to.
    """
    flat = assemble(records, light).where("main is not null").select(
        "record_id",
        F.get("metadata", F.lit(0))["fields"]["page_id"].cast("long").alias("page_id"),
        F.octet_length("main.payload").cast("long").alias("own_bytes"),
        F.sha1("main.payload").alias("own_sha1"),
        F.col("main.record_type").alias("record_type"),
        F.col("main.refers_to").alias("target"),
        F.col("main.target_uri").alias("target_uri"),
        F.size("requests").alias("n_requests"),
    )
    flat = stored(flat, "transactions", "zstd")
    held = flat.where("record_type <> 'revisit'").select(
        F.col("record_id").alias("target"), F.col("page_id").alias("refers_to"),
        F.col("own_bytes").alias("held_bytes"), F.col("own_sha1").alias("held_sha1"),
    )
    plain = flat.where("target is null").select(
        "page_id", F.col("own_bytes").alias("payload_bytes"), F.col("own_sha1").alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"), "target_uri", "n_requests",
    )
    revisits = flat.where("target is not null").join(held, "target", "left").select(
        "page_id", F.col("held_bytes").alias("payload_bytes"), F.col("held_sha1").alias("payload_digest"),
        "record_type", "refers_to", "target_uri", "n_requests",
    )
    return plain.unionByName(revisits)


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return page_captures(read_warc(spark, path), read_warc(spark, path, light=True))


QUERIES = {"op1_warc_transactions": op1_warc_transactions}

ORACLE = {
    "op1_warc_transactions": """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS bytes FROM pages
), g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS held FROM p)
SELECT page_id, bytes AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN bytes >= 1000 AND page_id <> held THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN bytes >= 1000 AND page_id <> held THEN held END AS refers_to,
       url AS target_uri, CAST(1 AS INTEGER) AS n_requests
FROM g
"""
}
