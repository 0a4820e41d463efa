import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadtide.functions import logline as L
from loadtide.sources import logs

LINE = '127.0.0.1 - - [01/Jul/1995:00:00:01 -0400] "GET /index.html HTTP/1.0" 200 123'


def parsed(spark, *lines, **kw):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return [r.asDict() for r in logs.parse_lines(df, **kw).collect()]


def test_sample_line(spark):
    (row,) = parsed(spark, LINE, with_offset=True)
    assert row["host"] == "127.0.0.1" and row["status"] == 200 and row["method"] == "GET"
    assert row["url"] == "/index.html" and row["version"] == "HTTP/1.0" and row["bytes"] == 123
    assert row["utc_offset"] == "-0400"


def test_instant_is_utc(spark):
    df = logs.parse_lines(spark.createDataFrame([(LINE,)], "value string"))
    assert df.select(F.unix_seconds("datetime")).first()[0] == 804571201


def test_unreadable_lines_are_dropped(spark):
    assert parsed(spark, "garbage", "", LINE.replace(" 200 ", " 2000 ")) == []


def test_bad_time_keeps_the_row(spark):
    (row,) = parsed(spark, LINE.replace("01/Jul", "99/Xxx"))
    assert row["datetime"] is None and row["bytes"] == 123


@pytest.mark.parametrize("request_text", ["BAD", "get /a HTTP/1.0", "GET /a", "GET /a b HTTP/1.0", ""])
def test_unreadable_request(spark, request_text):
    (row,) = parsed(spark, LINE.replace("GET /index.html HTTP/1.0", request_text))
    assert (row["method"], row["url"], row["version"]) == ("UNKNOWN",) * 3


def test_request_is_trimmed(spark):
    (row,) = parsed(spark, LINE.replace("GET /index.html HTTP/1.0", " \tGET /a HTTP/1.1 "))
    assert row["url"] == "/a"


@pytest.mark.parametrize(
    "text,value,flag",
    [("-", None, 1), ("12.5", None, 1), ("+5", 5, 0), ("-7", -7, 0), ("1_000", 1000, 0), ("x", None, 1), ("0", 0, 0)],
)
def test_bytes(spark, text, value, flag):
    (row,) = parsed(spark, LINE.replace(" 123", " " + text))
    assert (row["bytes"], row["bytes_missing_flag"]) == (value, flag)


def test_separator_inside_the_line(spark):
    (row,) = parsed(spark, LINE.replace("/index.html", "/a\x01b"))
    assert row["url"] == "/a\x01b" and row["bytes"] == 123


def test_open_ended_pattern_goes_group_by_group(spark):
    fmt = L.LineFormat(
        log_pattern=r"(?P<host>\w+) (?P<ts>\S+) (?P<request>\w+) (?P<status>\d+) (?P<bytes>\d+)",
        ts_format="yyyy-MM-dd'T'HH:mm:ssXXX",
    )
    (row,) = parsed(spark, "h 2024-01-01T00:00:00+01:00 x 404 9 trailing", " h no", fmt=fmt)
    assert row["status"] == 404 and row["bytes"] == 9 and row["method"] == "UNKNOWN"


def test_pattern_without_a_group_is_refused():
    with pytest.raises(ValueError, match="status"):
        L.group_numbers(r"(?P<host>\S+)", ("host", "status"))


def test_empty_file(spark, tmp_path):
    (tmp_path / "a.log").write_text("")
    df = logs.scan_access_log(spark, str(tmp_path))
    assert df.count() == 0 and df.columns == logs.LOG_EVENT_SCHEMA.names


def test_undecodable_bytes_are_kept_as_replacements(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(LINE.replace("index", "ind\xffex").encode("latin-1"))
    (row,) = logs.scan_access_log(spark, str(tmp_path)).collect()
    assert row["status"] == 200 and row["url"].startswith("/ind")


def test_pattern_runs_once_per_line(spark):
    df = logs.parse_lines(spark.createDataFrame([(LINE,)], "value string")).filter("datetime is not null")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(value") == 1


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(3):
        (src / f"{i}.log").write_text("\n".join([LINE.replace("123", str(i * 10 + j)) for j in range(5)]))
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        logs.stream_access_log(
            spark, str(src), out, str(tmp_path / "state"), max_files_per_trigger=1
        ).awaitTermination()
    got = sorted(r["bytes"] for r in spark.read.parquet(out).collect())
    assert got == sorted(i * 10 + j for i in range(3) for j in range(5))


def test_coerce_events(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "h", "GET", "/", "HTTP/1.0", "abc", "9" * 30, "1")],
        "datetime string, host string, method string, url string, version string, status string, bytes string, "
        "bytes_missing_flag string",
    )
    (row,) = logs.coerce_events(df).collect()
    assert row["status"] is None and row["bytes"] is None and row["bytes_missing_flag"] == 1
    assert row["datetime"] == dt.datetime(2024, 1, 1)
