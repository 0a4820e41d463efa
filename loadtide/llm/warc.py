"""WARC archives written and read by Spark: segments, chunked transfer framing, revisits.

A WARC record ends in two line ends, so Spark's text writer with that separator writes archives, and its
text reader with the start of the next record as separator reads them as streams. Bytes pass through
string columns unchanged; positions inside blocks are byte positions.

Archives of other writers (any order of header lines, versions 1.0 and 1.1, one gzip member per record or per file) are read by
``any_writer``: text between version lines is put together again until a record has its Content-Length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType, BooleanType, StructField, StructType

from loadtide.llm.words import as_bytes
from loadtide.session import materialize

LINE = "\r\n"
START = "WARC/1.1\r\nWARC-Type: "  # every record starts with it, and no block holds it
VERSION = "WARC/1."  # what any writer's record starts with; blocks may hold it too
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CHUNK = 8192
SEGMENT = 32768
REVISIT_FROM = 1000
DATE = "2024-01-01T00:00:00Z"


def _urn(*parts: Column) -> Column:
    known = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("")) for p in parts]
    h = F.md5(F.concat_ws("|", *known).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or null where the value is null (`concat_ws` leaves it out)."""
    return F.concat(F.lit(name + ": "), value.cast("string"))


def _uri(url: Column) -> Column:
    """ASCII without blanks or line ends: other bytes are percent-encoded."""
    plain = F.regexp_replace(F.url_encode(url), r"\+", "%20")
    return F.when(url.rlike(r"^[\x21-\x7e]*$"), url).otherwise(plain)


def chunked(payload: Column, size: int = CHUNK) -> Column:
    """Chunked transfer framing of a string's bytes.

    Chunks have ``size`` bytes at most. One also ends inside each START of the payload, so that
    the framed bytes never hold START and a reader can cut at it.
    """
    parts = F.split(payload, r"(?<=WARC/1\.1\r\n)(?=WARC-Type: )")
    piece = lambda p: F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length(p) / size) - 1, F.lit(0)).cast("int")),
        lambda i: F.substring(p.cast("binary"), i * size + 1, F.lit(size)),
    )
    framed = lambda b: F.concat(F.lower(F.hex(F.octet_length(b))), F.lit(LINE), b.cast("string"), F.lit(LINE))
    pieces = F.filter(F.flatten(F.transform(parts, piece)), lambda b: F.octet_length(b) > 0)
    return F.concat(F.array_join(F.transform(pieces, framed), ""), F.lit("0\r\n\r\n"))


def records(pages: DataFrame, chunk: int = CHUNK, segment: int = SEGMENT, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """One text per WARC record of ``pages`` (page_id, url, html), without the two line ends after it.

    The payload is the html in UTF-8, null counting as empty. Of equal payloads of at least ``revisit_from``
    bytes the largest page_id is the response, also where several rows share that page_id; the others revisit it. Rows of
    a null page_id revisit where their group has a page_id. Blocks above ``segment`` bytes go on in
    continuation records.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    base = base.withColumns({"bytes": F.octet_length("html"), "sha1": F.sha1(F.col("html").cast("binary"))})
    base = base.withColumn("id", _urn(F.col("page_id"), F.col("url"), F.col("sha1")))
    copies = base.where(F.col("bytes") >= revisit_from).groupBy("sha1")
    copies = copies.agg(F.max("page_id").alias("first_page"), F.max_by("id", F.struct("page_id", "id")).alias("first_id"), F.count("*").alias("n"))
    copies = materialize(copies.where("n > 1").drop("n"), "warc-copies")
    # a payload shared by many pages is one key; adaptive execution splits it
    rows = base.join(copies, "sha1", "left")
    revisit = F.col("first_page").isNotNull() & ~F.col("first_page").eqNullSafe(F.col("page_id"))
    rows = rows.withColumn("revisit", revisit)
    http = LINE.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", ""])
    body = F.when(
        F.col("revisit"), F.concat(F.lit(http + "Content-Length: "), F.col("bytes").cast("string"), F.lit(LINE + LINE))
    ).otherwise(F.concat(F.lit(http + "Transfer-Encoding: chunked" + LINE + LINE), chunked(F.col("html"), chunk)))
    rows = rows.withColumn("block", body.cast("binary")).drop("html").withColumn("size", F.octet_length("block"))
    last = F.greatest(F.ceil(F.col("size") / segment), F.lit(1)).cast("int")
    rows = rows.withColumn("last", last).withColumn("k", F.explode(F.sequence(F.lit(1), last)))
    part = F.substring(F.col("block"), (F.col("k") - 1) * segment + 1, F.lit(segment))
    first, split = F.col("k") == 1, F.col("last") > 1
    head = F.concat_ws(
        LINE,
        F.concat(F.lit(START), F.when(~first, "continuation").when(F.col("revisit"), "revisit").otherwise("response")),
        _field("WARC-Record-ID", F.when(first, F.col("id")).otherwise(_urn(F.col("id"), F.col("k")))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", _uri(F.col("url"))),
        _field("WARC-Page-ID", F.col("page_id")),
        _field("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("sha1")))),
        _field("WARC-Refers-To", F.when(first & F.col("revisit"), F.col("first_id"))),
        _field("WARC-Refers-To-Page-ID", F.when(first & F.col("revisit"), F.col("first_page"))),
        _field("WARC-Segment-Origin-ID", F.when(~first, F.col("id"))),
        _field("WARC-Segment-Number", F.when(split, F.col("k"))),
        _field("WARC-Segment-Total-Length", F.when(split & (F.col("k") == F.col("last")), F.col("size"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        _field("Content-Length", F.octet_length(part)),
    )
    return rows.select(F.concat(head, F.lit(LINE + LINE), part.cast("string")).alias("value"))


def write(pages: DataFrame, path: str, **options) -> None:
    """Write ``pages`` as gzipped WARC files below ``path``, one per task."""
    records(pages, **options).write.option("lineSep", LINE + LINE).option("compression", "gzip").text(path)


CHUNKED = re.compile(rb"\r\ntransfer-encoding:[ \t]*chunked", re.I)


@arrow_udf(StructType([StructField("payload", BinaryType()), StructField("framed", BooleanType())]))
def _payload(column: pa.Array) -> pa.Array:
    """Body of an HTTP message without transfer framing; ``framed`` is false where the framing is broken."""
    out, good = [], []
    for block in as_bytes(column):
        head, found, body = block.partition(b"\r\n\r\n")
        ok = bool(found)
        if CHUNKED.search(head):
            parts, at = [], 0
            while ok:
                end = body.find(b"\r\n", at)
                try:
                    size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
                except ValueError:
                    size = -1
                start = end + 2
                if size <= 0:
                    ok = size == 0
                    break
                ok = body[start + size : start + size + 2] == b"\r\n"
                parts.append(body[start : start + size])
                at = start + size + 2
            body = b"".join(parts)
        out.append(body)
        good.append(ok)
    return pa.StructArray.from_arrays([pa.array(out, pa.binary()), pa.array(good)], names=["payload", "framed"])


def _hex(digest: Column) -> Column:
    """A stated SHA-1 in lower-case hex, written in hex or, as many writers do, in base 32 (8 signs for 5 bytes)."""
    plain = F.translate(F.upper(digest), BASE32, "0123456789ABCDEFGHIJKLMNOPQRSTUV")
    parts = [F.lpad(F.conv(F.substring(plain, k, 8), 32, 16), 10, "0") for k in (1, 9, 17, 25)]
    return F.when(F.length(digest) == 32, F.lower(F.concat(*parts))).otherwise(F.lower(digest))


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from the pieces between version lines, in the files' order. A task holds one record and one batch."""
    place, parts, held, size, start = None, [], 0, None, 0
    heads: list[bytes] = []
    bodies: list[bytes] = []

    def close():
        nonlocal parts, held, size
        if size is not None:
            whole = b"".join(parts)
            heads.append(b"\r\n" + whole[: start - 4])
            bodies.append(whole[start:])
        parts, held, size = [], 0, None

    for batch in batches:
        for value, file, at in zip(as_bytes(batch.column("value")), batch.column("file").to_pylist(), batch.column("at").to_pylist()):
            if place != (file, at):
                close()
                place = (file, at)
            if parts:
                parts += [VERSION.encode(), value]
                held += len(VERSION) + len(value)
            elif re.match(rb"\d+\r\n", value):
                parts, held = [value], len(value)
            else:
                continue
            if size is None:
                found = b"".join(parts)
                end = found.find(b"\r\n\r\n")
                if end < 0:
                    continue
                stated = re.search(rb"\r\ncontent-length:[ \t]*(\d+)", found[:end], re.I)
                parts, start, size = [found], end + 4, int(stated[1]) if stated else 0
            if held - start >= size:
                close()
        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary()), pa.array(bodies, pa.binary())], ["head", "body"])
        heads.clear()
        bodies.clear()
    close()
    yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary()), pa.array(bodies, pa.binary())], ["head", "body"])


def scan(spark: SparkSession, path: str, any_writer: bool = False) -> DataFrame:
    """The records of an archive as they stand, segments not joined: header fields, block, whole.

    Archives of this module are cut at their records' first line by Spark's reader alone. With ``any_writer`` records may have
    their header lines in any order and state version 1.0 or 1.1; a block may hold version lines. ``whole`` says that the block
    has its Content-Length; a shorter one is kept as it is, and a record without a length (or with one that isn't a number) has an empty block that isn't whole. A length
    that is too long takes in what follows. Lines that belong to no record are left out. Folded header lines aren't joined. Gzipped files are read in one piece; in a
    plain file that Spark cuts into splits, a block with a version line next to a cut comes back as not whole.
    """
    if any_writer:
        raw = spark.read.option("lineSep", VERSION).text(path)
        raw = raw.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
        out = raw.mapInArrow(_stitch, "head binary, body binary").withColumn("head", F.col("head").cast("string"))
    else:
        raw = spark.read.option("lineSep", START).text(path).where(F.length("value") > 0)
        raw = raw.withColumn("end", F.instr("value", LINE + LINE)).where("end > 0")
        head = F.concat(F.lit(LINE + "WARC-Type: "), F.expr("substring(value, 1, end - 1)"))
        out = raw.withColumns({"head": head, "body": F.expr("substring(cast(value as binary), end + 4)")})

    def field(name: str) -> Column:
        got = F.regexp_extract("head", r"(?i)\r\n" + name + r":[ \t]*([^\r\n]*)", 1)
        return F.when(got != "", got)

    out = out.withColumn("size", field("Content-Length").try_cast("long"))
    return out.select(
        F.lower(F.trim(field("WARC-Type"))).alias("record_type"),
        field("WARC-Record-ID").alias("record_id"),
        field("WARC-Target-URI").alias("target_uri"),
        field("WARC-Page-ID").try_cast("long").alias("page_id"),
        _hex(F.regexp_replace(field("WARC-Payload-Digest"), "(?i)^sha1:", "")).alias("stated_digest"),
        field("WARC-Refers-To").alias("refers_to_id"),
        field("WARC-Refers-To-Page-ID").try_cast("long").alias("refers_to"),
        field("WARC-Segment-Origin-ID").alias("origin"),
        field("WARC-Segment-Number").try_cast("int").alias("segment"),
        field("WARC-Segment-Total-Length").try_cast("long").alias("total"),
        F.expr("substring(body, 1, cast(least(coalesce(size, 0), 2147483647) as int))").alias("block"),
        F.coalesce((F.octet_length("body") >= F.col("size")) & (F.col("size") >= 0), F.lit(False)).alias("whole"),
    )


def reassemble(scanned: DataFrame) -> DataFrame:
    """Records with their whole blocks: continuation records joined to their origin by segment number.

    ``whole`` also needs segments 1 to n, each with its length, and their sum equal to the stated total. A record without its
    first segment is left out with its continuations, since nothing says what it is. Equal records
    written several times come back as often.
    """
    single = scanned.where("segment is null").drop("origin", "segment", "total")
    parts = scanned.where("segment is not null").withColumn("origin", F.coalesce("origin", "record_id"))
    meta = ["record_type", "record_id", "target_uri", "page_id", "stated_digest", "refers_to_id", "refers_to"]
    once = parts.groupBy("origin", "segment").agg(
        F.first(F.struct(*meta)).alias("meta"), F.first("block").alias("block"), F.max("total").alias("total"),
        F.min("whole").alias("whole"), F.count("*").alias("copies"),
    )
    joined = once.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", F.col("block").cast("string").alias("block")))).alias("parts"),
        F.first(F.when(F.col("segment") == 1, F.col("meta")), ignorenulls=True).alias("meta"),
        F.max(F.when(F.col("segment") == 1, F.col("copies"))).alias("copies"),
        F.sum(F.octet_length("block")).alias("length"), F.max("total").alias("total"),
        F.max("segment").alias("top"), F.count("*").alias("n"), F.min("whole").alias("whole"),
    )
    whole = F.col("whole") & (F.col("top") == F.col("n")) & F.coalesce(F.col("length") == F.col("total"), F.lit(False))
    again = joined.where("copies is not null").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    block = F.array_join(F.col("parts.block"), "").cast("binary")
    return single.unionByName(again.select("meta.*", block.alias("block"), whole.alias("whole")))


def read(spark: SparkSession, path: str, any_writer: bool = False) -> DataFrame:
    """One row per response or revisit of the archives below ``path``; ``any_writer`` as in ``scan``.

    page_id, target_uri, record_type, record_id, refers_to (page), refers_to_id, payload (binary, null for a revisit),
    payload_bytes and payload_digest (sha1) of the full payload, and intact: segments, framing and digest agree. A revisit's
    length and digest are those stated in its record.
    """
    found = reassemble(scan(spark, path, any_writer)).where(F.col("record_type").isin("response", "revisit"))
    found = found.withColumn("got", _payload(F.col("block")))
    revisit = F.col("record_type") == "revisit"
    head = F.when(revisit, F.substring_index(F.col("block").cast("string"), LINE + LINE, 1))
    stated = F.regexp_extract(head, r"(?i)\r\nContent-Length:[ \t]*(\d+)", 1)
    payload = F.when(~revisit, F.col("got.payload"))
    digest = F.when(revisit, F.col("stated_digest")).otherwise(F.sha1(payload))
    size = F.when(revisit, F.when(stated != "", stated).try_cast("long")).otherwise(F.octet_length(payload).cast("long"))
    intact = F.col("whole") & (revisit | (F.col("got.framed") & (digest == F.coalesce("stated_digest", digest))))
    return found.select(
        "page_id", "target_uri", "record_type", "record_id", "refers_to", "refers_to_id", payload.alias("payload"),
        size.alias("payload_bytes"), digest.alias("payload_digest"), intact.alias("intact"),
    )
