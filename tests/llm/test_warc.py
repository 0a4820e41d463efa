import base64
import gzip
import hashlib
import random

import pytest

from loadtide.llm import warc
from loadtide.session import shared_dir

SCHEMA = "page_id long, url string, html string"


def plain(rows):
    """What the archive must say of (page_id, url, html) rows."""
    data = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for p, b in data:
        last = max((q for q, c in data if c == b and q is not None), default=None)
        again = len(b) >= 1000 and sum(c == b for _, c in data) > 1 and last is not None and p != last
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", last if again else None, True))
    return sorted(map(str, out))


def round_trip(spark, rows, schema=SCHEMA, **options):
    path = shared_dir(spark, "warc")
    warc.write(spark.createDataFrame(rows, schema), path, **options)
    found = warc.read(spark, path)
    return found, sorted(
        map(str, map(tuple, found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact").collect()))
    )


@pytest.mark.parametrize("chunk, segment", [(8192, 32768), (7, 50), (64, 300)])
def test_round_trip(spark, chunk, segment):
    rng = random.Random(chunk)
    nasty = ["é漢😀", "\r\n\r\n", warc.START, "\r\n\r\n" + warc.START + "response\r\nContent-Length: 3\r\n\r\nabc", "WARC/1.1\r\n", "0\r\n\r\n", "a b\t"]
    texts = ["".join(rng.choice(nasty) for _ in range(rng.choice([0, 1, 3, 60, 400]))) for _ in range(40)]
    rows = [(i, rng.choice(["http://x/é b\r\n", None, "http://y/?a=1+2", ""]), rng.choice(texts)) for i in range(120)]
    found, got = round_trip(spark, rows, chunk=chunk, segment=segment)
    assert got == plain(rows)
    want = {i: h.encode() for i, _, h in rows}
    for r in found.where("record_type = 'response'").select("page_id", "payload").collect():
        assert bytes(r.payload) == want[r.page_id]


def test_defined_cases(spark):
    big = "x" * 5_000_000
    same = "s" * 1000
    rows = [(1, "u", None), (2, "u", ""), (None, "u", same), (3, "u", same), (3, "u", same), (4, "v", big), (4, "v", big), (5, None, "y" * 999), (6, None, "y" * 999)]
    _, got = round_trip(spark, rows)
    assert got == plain(rows)
    _, got = round_trip(spark, [(*r, 1, "z") for r in rows], SCHEMA + ", bytes int, block string")
    assert got == plain(rows)
    assert round_trip(spark, [])[1] == []


def test_broken_archives(spark):
    """Missing segments and wrong lengths are found; a continuation without an origin isn't a page."""
    page = [(1, "u", "a" * 1000 + "é" * 2000)]
    lines = [r.value for r in warc.records(spark.createDataFrame(page, SCHEMA), chunk=100, segment=500).collect()]
    assert len(lines) > 5

    def status(values):
        path = shared_dir(spark, "warc")
        spark.createDataFrame([(v,) for v in values], "value string").write.option("lineSep", "\r\n\r\n").text(path)
        return [r.intact for r in warc.read(spark, path).collect()]

    # segments may cut a character, so whole ones are compared through files, not rows
    path = shared_dir(spark, "warc")
    warc.write(spark.createDataFrame(page, SCHEMA), path, chunk=100, segment=500)
    scanned = warc.scan(spark, path)
    assert [r.whole for r in warc.reassemble(scanned).collect()] == [True]
    assert [r.whole for r in warc.reassemble(scanned.where("segment is null or segment <> 3")).collect()] == [False]
    assert warc.reassemble(scanned.where("segment <> 1")).count() == 0
    ascii_page = [r.value for r in warc.records(spark.createDataFrame([(1, "u", "a" * 300)], SCHEMA)).collect()]
    assert status(ascii_page) == [True]
    assert status([ascii_page[0].replace("aaaa\r\n0\r\n", "aab\r\n0\r\n")]) == [False]


def test_a_revisit_s_header_is_read_to_its_end(spark, tmp_path):
    """Header lines of other writers come before the length, however many."""
    more = "".join(f"X-Line-{i}: {'v' * 200}\r\n" for i in range(60))
    block = f"HTTP/1.1 200 OK\r\n{more}Content-Length: 77\r\n\r\n"
    head = f"WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:a>\r\nWARC-Page-ID: 5\r\nContent-Length: {len(block)}\r\n\r\n"
    spark.createDataFrame([(head + block,)], "value string").write.option("lineSep", "\r\n\r\n").text(str(tmp_path / "w"))
    assert [(r.page_id, r.payload_bytes) for r in warc.read(spark, str(tmp_path / "w")).collect()] == [(5, 77)]


def foreign(kind, body, version="1.0", **more):
    """A record as other writers order it."""
    lines = [f"Content-Length: {len(body)}", *(f"{k.replace('_', '-')}: {v}" for k, v in more.items()), f"WARC-Type:{kind}"]
    return f"WARC/{version}\r\n{'\r\n'.join(lines)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def http(payload, head=""):
    return f"HTTP/1.1 200 OK\r\n{head}\r\n".encode() + payload


def archive():
    """Records of another writer, and (id, payload, type, intact) of the pages in them."""
    nested = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\nx WARC/1." * 3
    base32 = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    raw = b"\xff\x00\r\n\r\n" * 50
    cut = nested * 200
    recs = [
        foreign("warcinfo", b"format: WARC File Format 1.0\r\n"),
        foreign("request", b"GET / HTTP/1.1\r\n\r\n", WARC_Record_ID="<urn:q>"),
        foreign("response", http(nested), WARC_Record_ID="<urn:1>", WARC_Payload_Digest="sha1:" + base32(nested)),
        foreign("response", http(raw, "X: y\r\n"), "1.1", WARC_Record_ID="<urn:2>", WARC_Payload_Digest="SHA1:" + hashlib.sha1(raw).hexdigest().upper()),
        foreign("response", http(b"4\r\nabcd\r\n0\r\n\r\n", "transfer-encoding:Chunked\r\n"), WARC_Record_ID="<urn:3>"),
        foreign("response", http(b"wrong"), WARC_Record_ID="<urn:4>", WARC_Payload_Digest="sha1:" + base32(b"other")),
        foreign("revisit", http(b"", "Content-Length:99\r\n"), WARC_Record_ID="<urn:5>", WARC_Refers_To="<urn:2>", WARC_Payload_Digest="sha1:" + base32(raw)),
        foreign("response", http(cut)[:9000], WARC_Segment_Number=1, WARC_Record_ID="<urn:6>"),
        foreign("continuation", http(cut)[9000:], WARC_Segment_Number=2, WARC_Segment_Origin_ID="<urn:6>", WARC_Record_ID="<urn:7>", WARC_Segment_Total_Length=len(http(cut))),
        foreign("response", http(b""), WARC_Record_ID="<urn:8>"),
    ]
    want = {"<urn:1>": (nested, True), "<urn:2>": (raw, True), "<urn:3>": (b"abcd", True), "<urn:4>": (b"wrong", False), "<urn:5>": (None, True), "<urn:6>": (cut, True), "<urn:8>": (b"", True)}
    return recs, want


@pytest.mark.parametrize("form", ["members", "one stream", "plain"])
def test_archives_of_other_writers(spark, tmp_path, form):
    recs, want = archive()
    (tmp_path / "w").mkdir()
    for k in range(3):
        data = b"".join(map(gzip.compress, recs)) if form == "members" else gzip.compress(b"".join(recs)) if form == "one stream" else b"".join(recs)
        (tmp_path / "w" / f"{k}.warc{'' if form == 'plain' else '.gz'}").write_bytes(data)
    found = warc.read(spark, str(tmp_path / "w" / "0.*"), any_writer=True).collect()
    got = {r.record_id: (None if r.payload is None else bytes(r.payload), r.intact) for r in found}
    assert got == want and len(found) == len(want)
    again = {r.record_id: r for r in found}["<urn:5>"]
    assert (again.refers_to_id, again.payload_bytes, again.payload_digest) == ("<urn:2>", 99, hashlib.sha1(want["<urn:2>"][0]).hexdigest())
    assert warc.scan(spark, str(tmp_path / "w"), any_writer=True).count() == 3 * len(recs)


def test_broken_archives_of_other_writers(spark, tmp_path):
    """A file cut off, a record without a length, junk before the first record, an empty file."""
    recs, _ = archive()
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"junk\r\n" + recs[2][:-40]))
    (tmp_path / "b.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:n>\r\n\r\nbody\r\n\r\n" + recs[4])
    (tmp_path / "c.warc").write_bytes(b"")
    odd = [foreign("response", b"", WARC_Record_ID=f"<urn:{n}>").replace(b"Length: 0", b"Length: " + n.encode()) for n in ("x", "-5", "9" * 30)]
    for k, o in enumerate(odd):
        (tmp_path / f"d{k}.warc.gz").write_bytes(gzip.compress(o))
    got = {r.record_id: r.whole for r in warc.scan(spark, str(tmp_path), any_writer=True).collect()}
    assert got == {"<urn:1>": False, "<urn:n>": False, "<urn:3>": True, "<urn:x>": False, "<urn:-5>": False, f"<urn:{'9' * 30}>": False}


def test_own_archives_read_either_way(spark):
    rows = [(i, "http://x/", f"{warc.START}é{i % 7}" * 300) for i in range(30)]
    path = shared_dir(spark, "warc")
    warc.write(spark.createDataFrame(rows, SCHEMA), path, chunk=100, segment=700)
    one, two = (sorted(map(str, warc.read(spark, path, any_writer=a).collect())) for a in (False, True))
    assert one == two and len(one) == 30
