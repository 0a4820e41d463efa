"""DuckDB SQL for the same results, written from the definitions and not from the Spark code."""

from __future__ import annotations

from catalog.fixture import NUDGE, SCALING

ORACLES: dict[str, str] = {}
# The line and request patterns.
LOG_PATTERN = r'^(?P<host>\S+)\s+\S+\s+\S+\s+\[(?P<ts>[^\]]+)\]\s+"(?P<request>[^"]*)"\s+(?P<status>\d{3})\s+(?P<bytes>\S+)\s*$'
REQUEST_PATTERN = r"^(?P<method>[A-Z]+)\s+(?P<url>\S+)\s+(?P<version>HTTP/\d\.\d)$"
STEP = {"1m": 60, "5m": 300, "15m": 900}
CUT = "TIMESTAMP '2024-01-23 04:00:00'"
OUTAGE = ("TIMESTAMP '2024-01-09 18:52:01'", "TIMESTAMP '2024-01-11 08:36:13'")
FILL = ["hits", "bytes_sum", "avg_bytes_per_req", "err_4xx", "err_5xx", "error_rate", "unique_hosts"]


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def tidy(cols: str, sql: str, digits: int = 4) -> str:
    """``cols`` lists ``kind:name``: i whole number, f rounded double, t time, x as it is."""
    out = []
    for item in cols.split():
        kind, name = item.split(":")
        if kind == "i":
            out.append(f'CAST("{name}" AS BIGINT) AS "{name}"')
        elif kind == "f":
            r = f'round(CAST("{name}" AS DOUBLE) + {NUDGE}, {digits})'
            out.append(f'CASE WHEN {r} = 0 THEN CAST(0 AS DOUBLE) ELSE {r} END AS "{name}"')
        elif kind == "t":
            out.append(f'CAST("{name}" AS TIMESTAMP) AS "{name}"')
        else:
            out.append(f'"{name}"')
    return f"SELECT {', '.join(out)} FROM ({sql}) AS result"


def oracle(name: str, cols: str, sql: str, digits: int = 4) -> None:
    ORACLES[name] = tidy(cols, sql, digits)


def chain(*parts: str) -> str:
    """Common table expressions followed by the final select."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def floor_to(ts: str, step: int) -> str:
    return f"time_bucket(INTERVAL '{step} seconds', {ts})"


# the rendered log and its events

WHOLE_LINES = r"""lines AS (
  SELECT CASE WHEN second(ts) = 13 THEN 'garbage ' || event_id ELSE
    'u' || user_id || '.example.net - - ['
    || CASE WHEN second(ts) = 31 THEN '99/Xxx/2024:00:00:00' ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END
    || ' -0400] "'
    || CASE WHEN second(ts) = 47 THEN 'BAD' ELSE
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END
         || ' /' || event_type || '/' || regexp_extract(props, '(\d+)', 1) || ' HTTP/1.0' END
    || '" ' || CASE WHEN event_type <> 'error' THEN '200' WHEN value < 30 THEN '500' ELSE '404' END
    || ' ' || CASE WHEN second(ts) IN (7, 52) THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END
  END AS value FROM events)"""
# the log of the queries on outages: the known one keeps a fifth of its events, the unknown one none
LINES = (
    WHOLE_LINES[:-1]
    + """
  WHERE NOT (ts >= TIMESTAMP '2024-01-16 02:00:00' AND ts < TIMESTAMP '2024-01-16 20:00:00')
    AND NOT (ts >= TIMESTAMP '2024-01-09 14:52:01' AND ts < TIMESTAMP '2024-01-11 04:36:13' AND event_id % 5 <> 0))"""
)
_L = quoted(LOG_PATTERN)
_R = quoted(REQUEST_PATTERN)
FIELDS = f"""fields AS (
  SELECT regexp_extract(value, {_L}, 1) AS host, regexp_extract(value, {_L}, 2) AS ts,
    regexp_extract(value, {_L}, 3) AS request, regexp_extract(value, {_L}, 4) AS status,
    regexp_extract(value, {_L}, 5) AS bytes
  FROM lines WHERE regexp_matches(value, {_L}))"""
REQUESTS = f"""requests AS (
  SELECT host, ts, status, bytes,
    CASE WHEN ok THEN regexp_extract(r, {_R}, 1) ELSE 'UNKNOWN' END AS method,
    CASE WHEN ok THEN regexp_extract(r, {_R}, 2) ELSE 'UNKNOWN' END AS url,
    CASE WHEN ok THEN regexp_extract(r, {_R}, 3) ELSE 'UNKNOWN' END AS version
  FROM (SELECT *, trim(request) AS r, regexp_matches(trim(request), {_R}) AS ok FROM fields))"""
_INSTANT = "(try_strptime(ts, '%d/%b/%Y:%H:%M:%S %z') AT TIME ZONE 'UTC')"
_BYTES = r"CASE WHEN regexp_full_match(bytes, '[+-]?\d+') THEN TRY_CAST(bytes AS BIGINT) END"
EVENTS = f"""ev AS (
  SELECT {_INSTANT} AS datetime, host, method, url, version, CAST(status AS SMALLINT) AS status,
    {_BYTES} AS bytes, CASE WHEN ({_BYTES}) IS NULL THEN 1 ELSE 0 END AS bytes_missing_flag,
    regexp_extract(url, '^/([^/]+)', 1) AS service
  FROM requests)"""
LOG = (LINES, FIELDS, REQUESTS, EVENTS)
WHOLE_LOG = (WHOLE_LINES, FIELDS, REQUESTS, EVENTS)
EVENT_COLS = "t:datetime x:host x:method x:url x:version i:status i:bytes i:bytes_missing_flag"

# series


def ts2(name: str, step: int, keys: tuple[str, ...] = (), where: str = "true", source: str = "ev") -> str:
    k = "".join(f"{c}, " for c in keys)
    return f"""{name} AS (
  SELECT *, CASE WHEN hits > 0 THEN bytes_sum / hits ELSE 0 END AS avg_bytes_per_req,
    CASE WHEN hits > 0 THEN (err_4xx + err_5xx) / hits ELSE 0 END AS error_rate
  FROM (SELECT {k}{floor_to('datetime', step)} AS bucket_start, count(*) AS hits,
      CAST(sum(bytes) AS DOUBLE) AS bytes_sum, count(DISTINCT host) AS unique_hosts,
      count(*) FILTER (status BETWEEN 400 AND 499) AS err_4xx,
      count(*) FILTER (status BETWEEN 500 AND 599) AS err_5xx
    FROM {source} WHERE datetime IS NOT NULL AND {where} GROUP BY ALL))"""


def spine(name: str, source: str, step: int, keys: tuple[str, ...] = ()) -> str:
    k = "".join(f"{c}, " for c in keys)
    by = f"GROUP BY {', '.join(keys)}" if keys else ""
    return f"""{name} AS (
  SELECT {k}unnest(generate_series(lo, hi, INTERVAL '{step} seconds')) AS bucket_start
  FROM (SELECT {k}min(bucket_start) AS lo, max(bucket_start) AS hi FROM {source} {by}))"""


def dense(name: str, source: str, step: int, keys: tuple[str, ...] = ()) -> tuple[str, str]:
    using = ", ".join((*keys, "bucket_start"))
    return (
        spine(f"{name}_spine", source, step, keys),
        f"{name} AS (SELECT * FROM {name}_spine LEFT JOIN {source} USING ({using}))",
    )


def known(ts: str, step: int) -> str:
    return f"({ts} >= {floor_to(OUTAGE[0], step)} AND {ts} < {floor_to(OUTAGE[1], step)})"


def labelled(name: str, source: str, step: int, keys: tuple[str, ...] = (), hours: int = 12) -> tuple[str, str]:
    """Runs of missing buckets by gaps and islands, then the outage flags."""
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    inner = ", ".join((*keys, "run"))
    return (
        f"""{name}_runs AS (
  SELECT *, sum(turn) OVER ({part} ORDER BY bucket_start) AS run FROM (
    SELECT *, CASE WHEN hits IS NULL THEN 1 ELSE 0 END AS is_missing_bucket,
      CASE WHEN (hits IS NULL) IS DISTINCT FROM lag(hits IS NULL) OVER ({part} ORDER BY bucket_start)
        THEN 1 ELSE 0 END AS turn
    FROM {source}))""",
        f"""{name} AS (
  SELECT * EXCLUDE (turn, run), greatest(is_gap_storm, is_gap_unknown) AS is_gap FROM (
    SELECT *, CASE WHEN {known('bucket_start', step)} THEN 1 ELSE 0 END AS is_gap_storm,
      CASE WHEN is_missing_bucket = 1
        AND sum(is_missing_bucket) OVER (PARTITION BY {inner}) >= {hours * 3600 // step} THEN 1 ELSE 0 END AS is_gap_unknown
    FROM {name}_runs))""",
    )


def filled(name: str, source: str) -> str:
    cols = ", ".join(f"CASE WHEN is_gap = 0 THEN coalesce(CAST({c} AS DOUBLE), 0) END AS {c}" for c in FILL)
    return f"{name} AS (SELECT * REPLACE ({cols}) FROM {source})"


def ts3(name: str, step: int, keys: tuple[str, ...] = (), where: str = "true") -> tuple[str, ...]:
    return (
        ts2(f"{name}_2", step, keys, where),
        *dense(f"{name}_d", f"{name}_2", step, keys),
        *labelled(f"{name}_l", f"{name}_d", step, keys),
        filled(name, f"{name}_l"),
    )


TRAIN, TEST = f"datetime < {CUT}", f"datetime >= {CUT}"


def train(tag: str, keys: tuple[str, ...] = ()) -> tuple[str, ...]:
    return ts3("tr", STEP[tag], keys, TRAIN)


def test(tag: str, keys: tuple[str, ...] = ()) -> tuple[str, ...]:
    return ts3("te", STEP[tag], keys, TEST)


def all_series(tags: tuple[str, ...]) -> tuple[str, ...]:
    parts, names = [], []
    for tag in tags:
        for split, where in (("train", TRAIN), ("test", TEST)):
            n = f"s_{split}_{tag}"
            parts += ts3(n, STEP[tag], (), where)
            names.append(f"SELECT '{split}' AS split, '{tag}' AS tag, * FROM {n}")
    return (*parts, "series AS (" + " UNION ALL BY NAME ".join(names) + ")")


TS2_COLS = "t:bucket_start i:hits f:bytes_sum i:unique_hosts i:err_4xx i:err_5xx f:avg_bytes_per_req f:error_rate"
TS3_COLS = (
    "t:bucket_start f:hits f:bytes_sum f:unique_hosts f:err_4xx f:err_5xx f:avg_bytes_per_req f:error_rate "
    "i:is_missing_bucket i:is_gap_storm i:is_gap_unknown i:is_gap"
)

# sources

oracle("a1_log_scan", EVENT_COLS, chain(*WHOLE_LOG, "SELECT * FROM ev"))
oracle("a2_incremental_ingest", EVENT_COLS, chain(*WHOLE_LOG, "SELECT * FROM ev"))
oracle(
    "a3_parquet_scan",
    "x:event_type i:n f:top",
    "SELECT event_type, count(*) AS n, max(value) AS top FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1",
)
oracle("a4_parquet_sink", "t:bucket_start f:hits i:is_gap", chain(*LOG, *train("5m"), "SELECT * FROM tr"))
oracle(
    "a6_prediction_case",
    "t:timestamp x:metric x:window f:y_true f:y_pred",
    """SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) AS timestamp, 'hits' AS metric, '5m' AS "window",
      CASE WHEN event_type = 'error' THEN 0 ELSE value END AS y_true,
      CASE WHEN event_type = 'view' THEN 0 ELSE user_id END AS y_pred
    FROM events WHERE second(ts) <> 31""",
)
oracle("a8_csv_overwrite", "i:t f:hits", chain(*WHOLE_LOG, *train("15m"), "SELECT epoch(bucket_start) AS t, hits FROM tr"))

# expressions

oracle("b1_line_extract", "x:host x:ts x:request x:status x:bytes", chain(WHOLE_LINES, FIELDS, "SELECT * FROM fields"))
oracle(
    "b2_request_split",
    "x:host x:status x:bytes x:method x:url x:version",
    chain(WHOLE_LINES, FIELDS, REQUESTS, "SELECT * FROM requests"),
)
oracle("b3_time_parse", "x:ts t:datetime", chain(WHOLE_LINES, FIELDS, f"SELECT ts, {_INSTANT} AS datetime FROM fields"))
oracle(
    "b4_bytes_parse",
    "i:bytes i:bytes_missing_flag i:n",
    chain(
        *WHOLE_LOG,
        r"""tokens AS (
      SELECT token AS bytes FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0b\f\r]+')) AS token FROM documents)
      WHERE token <> '')""",
        f"""both_kinds AS (SELECT bytes, bytes_missing_flag FROM ev
      UNION ALL SELECT {_BYTES}, CASE WHEN ({_BYTES}) IS NULL THEN 1 ELSE 0 END FROM tokens)""",
        "SELECT bytes, bytes_missing_flag, count(*) AS n FROM both_kinds GROUP BY ALL",
    ),
)
oracle("b5_status_cast", "i:status i:n", chain(*WHOLE_LOG, "SELECT status, count(*) AS n FROM ev GROUP BY 1"))
oracle(
    "b6_dtype_normalise",
    EVENT_COLS,
    """SELECT ts AS datetime, event_type AS host, 'GET' AS method, props AS url, 'HTTP/1.0' AS version,
      CASE WHEN event_type <> 'error' AND user_id <= 32767 THEN user_id END AS status,
      CASE WHEN value >= 10 THEN floor(value) END AS bytes,
      CASE WHEN value < 10 THEN 1 ELSE 0 END AS bytes_missing_flag FROM events""",
)
oracle(
    "b7_custom_patterns",
    EVENT_COLS,
    """SELECT date_trunc('second', ts) - INTERVAL 2 HOURS AS datetime, 'u' || user_id AS host, 'get' AS method,
      props AS url, 'v1' AS version, 200 AS status, floor(value) AS bytes, 0 AS bytes_missing_flag
    FROM events WHERE event_type <> 'error'""",
)
oracle(
    "b8_status_class",
    "x:host i:n_4xx i:n_5xx",
    chain(
        *WHOLE_LOG,
        """SELECT host, count(*) FILTER (status >= 400 AND status <= 499) AS n_4xx,
      count(*) FILTER (status >= 500 AND status <= 599) AS n_5xx FROM ev GROUP BY 1""",
    ),
)
RATES = """rated AS (SELECT *, CASE WHEN hits > 0 THEN err_4xx / hits ELSE 0 END AS rate_4xx,
  CASE WHEN hits > 0 THEN err_5xx / hits ELSE 0 END AS rate_5xx FROM tr)"""
oracle(
    "b9_guarded_ratios",
    "x:split x:tag t:bucket_start f:avg_bytes_per_req f:error_rate f:rate_4xx f:rate_5xx",
    chain(*WHOLE_LOG, *all_series(("1m", "5m", "15m")), RATES.replace("FROM tr", "FROM series"), "SELECT * FROM rated"),
)
_RATIO = "coalesce(bytes_sum, 0) / greatest(coalesce(hits, 0), 1)"
oracle(
    "b10_feature_ratio",
    "x:split x:tag t:bucket_start f:avg_bytes_per_req",
    chain(*WHOLE_LOG, *all_series(("1m", "5m", "15m")), f"SELECT split, tag, bucket_start, {_RATIO} AS avg_bytes_per_req FROM series"),
)
_LOCAL = "(bucket_start - INTERVAL 4 HOURS)"
CALENDAR = f"""hour({_LOCAL}) AS hour, minute({_LOCAL}) AS minute, isodow({_LOCAL}) - 1 AS dayofweek,
  month({_LOCAL}) AS month, dayofyear({_LOCAL}) AS dayofyear,
  CASE WHEN isodow({_LOCAL}) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  sin(2 * pi() * hour({_LOCAL}) / 24.0) AS hour_sin, cos(2 * pi() * hour({_LOCAL}) / 24.0) AS hour_cos,
  sin(2 * pi() * (isodow({_LOCAL}) - 1) / 7.0) AS dow_sin, cos(2 * pi() * (isodow({_LOCAL}) - 1) / 7.0) AS dow_cos"""
_CAL15 = chain(
    *LOG,
    *train("15m"),
    *test("15m"),
    "both_splits AS (SELECT bucket_start FROM tr UNION ALL SELECT bucket_start FROM te)",
    f"""SELECT bucket_start, {CALENDAR},
      (epoch(bucket_start) - epoch(min(bucket_start) OVER ())) // 900 AS time_idx FROM both_splits""",
)
oracle("b11_calendar", "t:bucket_start i:hour i:minute i:dayofweek i:month i:dayofyear i:is_weekend", _CAL15)
oracle("b12_step_index", "t:bucket_start i:time_idx", _CAL15)
oracle("b13_cyclic", "t:bucket_start f:hour_sin f:hour_cos f:dow_sin f:dow_cos", _CAL15)
oracle("b14_tz_normalise", "x:host t:t", chain(*WHOLE_LOG, "SELECT host, datetime AS t FROM ev"))
oracle("b15_time_key", "i:event_id i:time_key", "SELECT event_id, epoch_us(ts) * 1000 AS time_key FROM events")
oracle(
    "b17_target_transform",
    "i:event_id f:scaled f:back f:hits_back",
    """SELECT event_id, ln(1 + greatest(value - 20, 0)) AS scaled, greatest(exp((value - 20) / 25) - 1, 0) AS back,
      greatest(value - 20, 0) AS hits_back FROM events""",
)
oracle(
    "b18_safe_float",
    "i:event_id f:v",
    "SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'error') THEN 0 ELSE value END AS v FROM events",
)
oracle(
    "b19_string_predicates",
    "x:k i:n_urgent i:n",
    """SELECT lower(o_orderpriority) AS k, count(*) FILTER (o_orderpriority ILIKE '%urgent%') AS n_urgent, count(*) AS n
    FROM orders GROUP BY 1""",
)
oracle(
    "b20_range_filter",
    "i:o_orderkey t:o_orderdate",
    "SELECT * FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'",
)
oracle(
    "b21_gap_filter",
    "x:split x:tag t:bucket_start f:hits",
    chain(*LOG, *all_series(("1m", "5m", "15m")), "SELECT * FROM series WHERE coalesce(is_gap, 0) = 0"),
)

# series

oracle(
    "c1_bucket_floor",
    "i:event_id t:b_1m t:b_5m t:b_15m",
    "SELECT event_id, " + ", ".join(f"{floor_to('ts', s)} AS b_{t}" for t, s in STEP.items()) + " FROM events",
)
oracle("c2_bucket_aggregate", TS2_COLS, chain(*WHOLE_LOG, ts2("b", 300), "SELECT * FROM b"))
oracle("c2_keyed_service", "x:service " + TS2_COLS, chain(*WHOLE_LOG, ts2("b", 900, ("service",)), "SELECT * FROM b"))
oracle(
    "c2_keyed_orders_daily_flag",
    "x:l_returnflag " + TS2_COLS,
    chain(
        """li AS (SELECT l_shipdate AS datetime, l_suppkey AS host, 200 AS status,
      CAST(floor(l_extendedprice) AS BIGINT) AS bytes, l_returnflag FROM lineitem)""",
        ts2("b", 900, ("l_returnflag",), source="li"),
        "SELECT * FROM b",
    ),
)
oracle(
    "c3_multi_resolution",
    "x:tag " + TS2_COLS,
    chain(
        *WHOLE_LOG,
        *[ts2(f"b_{t}", s) for t, s in STEP.items()],
        " UNION ALL ".join(f"SELECT '{t}' AS tag, * FROM b_{t}" for t in STEP),
    ),
)
_SERVICE = ("service",)
oracle(
    "c4_dense_spine",
    "x:service t:bucket_start",
    chain(*LOG, ts2("b", 900, _SERVICE), spine("sp", "b", 900, _SERVICE), "SELECT * FROM sp"),
)
oracle(
    "c5_spine_join",
    "x:service " + TS2_COLS,
    chain(*WHOLE_LOG, ts2("b", 900, _SERVICE), *dense("d", "b", 900, _SERVICE), "SELECT * FROM d"),
)
_DENSE_HOSTS = (ts2("b", 900, ("host",)), *dense("d", "b", 900, ("host",)), *labelled("l", "d", 900, ("host",)))
HOSTS = (*LOG, *_DENSE_HOSTS)
WHOLE_HOSTS = (*WHOLE_LOG, *_DENSE_HOSTS)
oracle(
    "c6_missing_flag",
    "x:host i:rows i:missing",
    chain(*HOSTS, "SELECT host, count(*) AS rows, count(*) FILTER (hits IS NULL) AS missing FROM d GROUP BY 1"),
)
def _by_tag(expr) -> str:
    return "CASE tag " + " ".join(f"WHEN '{t}' THEN {expr(n)}" for t, n in STEP.items()) + " END"


oracle(
    "c7_known_outage",
    "x:split x:tag t:bucket_start i:storm",
    chain(
        *LOG,
        *all_series(("1m", "5m", "15m")),
        f"SELECT *, CASE WHEN {_by_tag(lambda n: known('bucket_start', n))} THEN 1 ELSE 0 END AS storm FROM series",
    ),
)
ORDER_OUTAGES = """outages AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 40 = 0 THEN TIMESTAMP '2024-01-01' ELSE begins END AS a,
    CASE WHEN o_custkey % 40 = 0 THEN TIMESTAMP '2024-02-01' ELSE begins + to_minutes((o_orderkey % 50) * (o_orderkey % 50)) END AS b
  FROM (SELECT *, TIMESTAMP '2024-01-01' + to_minutes(o_orderkey * 7919 % 43200) AS begins FROM orders WHERE o_orderstatus = 'P'))"""
oracle(
    "c7_outage_table",
    "x:split x:tag t:bucket_start x:known",
    chain(
        *LOG,
        *all_series(("1m", "5m", "15m")),
        ORDER_OUTAGES,
        "spans AS ("
        + " UNION ALL ".join(f"SELECT DISTINCT '{t}' AS tag, {floor_to('a', n)} AS a, {floor_to('b', n)} AS b FROM outages" for t, n in STEP.items())
        + ")",
        """SELECT s.split, s.tag, s.bucket_start, EXISTS (SELECT 1 FROM spans o WHERE o.tag = s.tag AND s.bucket_start >= a AND s.bucket_start < b) AS known
    FROM series s""",
    ),
)
oracle(
    "c8_unknown_gaps",
    "x:host i:run_length i:is_gap_unknown i:rows",
    chain(
        *HOSTS,
        """runs AS (SELECT host, sum(is_missing_bucket) OVER (PARTITION BY host, run) AS run_length FROM l_runs)""",
        """SELECT host, run_length, CASE WHEN run_length >= 48 THEN 1 ELSE 0 END AS is_gap_unknown, count(*) AS rows
    FROM runs GROUP BY ALL""",
    ),
)
_FLAGS = ("is_missing_bucket", "is_gap_storm", "is_gap_unknown", "is_gap")
oracle(
    "c9_gap_label",
    "x:host " + " ".join(f"i:{c}" for c in _FLAGS),
    chain(*HOSTS, "SELECT host, " + ", ".join(f"sum({c}) AS {c}" for c in _FLAGS) + " FROM l GROUP BY 1"),
)
oracle(
    "c10_conditional_fill",
    "x:split x:tag " + TS3_COLS,
    chain(*LOG, *all_series(("1m", "5m", "15m")), "SELECT * FROM series"),
)
oracle(
    "c10_keyed_hosts",
    "x:host i:known f:hits f:bytes_sum f:unique_hosts f:error_rate",
    chain(
        *WHOLE_HOSTS,
        filled("f", "l"),
        """SELECT host, count(hits) AS known, sum(hits) AS hits, sum(bytes_sum) AS bytes_sum,
      sum(unique_hosts) AS unique_hosts, sum(error_rate) AS error_rate FROM f GROUP BY 1""",
    ),
)
_REPORT = """count(*) AS rows, min(bucket_start) AS range_start, max(bucket_start) AS range_end,
  sum(is_missing_bucket) AS missing, sum(is_gap) AS gap, sum(is_gap_storm) AS storm, sum(is_gap_unknown) AS unknown"""
_REPORT_COLS = "i:rows t:range_start t:range_end i:missing i:gap i:storm i:unknown"
oracle(
    "c11_build_report",
    "x:split x:tag " + _REPORT_COLS,
    chain(*LOG, *all_series(("1m", "5m", "15m")), f"SELECT split, tag, {_REPORT} FROM series GROUP BY ALL"),
)
oracle(
    "c11_keyed_services",
    "x:service " + _REPORT_COLS,
    chain(*LOG, *train("15m", _SERVICE), f"SELECT service, {_REPORT} FROM tr GROUP BY ALL"),
)

# features


def segments(name: str, source: str, keys: tuple[str, ...] = ()) -> str:
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return f"""{name} AS (
  SELECT * EXCLUDE (opens), CASE WHEN is_gap = 1 THEN -1
    ELSE sum(opens) OVER ({part} ORDER BY bucket_start) END AS segment_id
  FROM (SELECT *, CASE WHEN is_gap = 0 AND coalesce(lag(is_gap) OVER ({part} ORDER BY bucket_start), 1) = 1
      THEN 1 ELSE 0 END AS opens FROM {source}))"""


LAG_DAYS = (1, 2, 3, 4, 5, 6, 7)
ROLLS = {"1h": 3600, "6h": 21600, "1d": 86400}


def by_segment(keys: tuple[str, ...] = ()) -> str:
    return f"PARTITION BY {', '.join((*keys, 'segment_id'))} ORDER BY bucket_start"


def in_segment(value: str) -> str:
    return f"CASE WHEN segment_id >= 0 THEN {value} END"


def lag_cols(target: str, step: int, keys: tuple[str, ...] = (), days=LAG_DAYS) -> list[str]:
    return [
        f"{in_segment(f'lag({target}, {d * 86400 // step}) OVER ({by_segment(keys)})')} AS {target}_lag_{d}d"
        for d in days
    ]


def roll_cols(target: str, step: int, keys: tuple[str, ...] = ()) -> list[str]:
    out = []
    for name, seconds in ROLLS.items():
        n = seconds // step
        frame = f"({by_segment(keys)} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        for kind, fn in (("mean", "avg"), ("std", "stddev_samp")):
            full = f"CASE WHEN segment_id >= 0 AND count({target}) OVER {frame} = {n} THEN {fn}({target}) OVER {frame} END"
            out.append(f"{full} AS {target}_roll_{kind}_{name}")
    return out


def featured(name: str, source: str, step: int, keys: tuple[str, ...] = (), labels: bool = False) -> str:
    cols = [
        *lag_cols("hits", step, keys),
        *lag_cols("bytes_sum", step, keys),
        *[c for t in ("hits", "bytes_sum", "avg_bytes_per_req") for c in roll_cols(t, step, keys)],
    ]
    if labels:
        cols += [
            f"{in_segment(f'lead({t}, 1) OVER ({by_segment(keys)})')} AS y_{t}_next" for t in ("hits", "bytes_sum")
        ]
    return f"""{name} AS (SELECT *, {CALENDAR},
  hits_lag_1d - hits_lag_2d AS hits_diff_lag_1d_2d,
  bytes_sum_lag_1d - bytes_sum_lag_2d AS bytes_sum_diff_lag_1d_2d
  FROM (SELECT *, {', '.join(cols)} FROM {source}))"""


FEATURES = sorted(
    {
        "hour", "minute", "dayofweek", "month", "dayofyear", "is_weekend", "time_idx",
        "hour_sin", "hour_cos", "dow_sin", "dow_cos",
        *[f"{t}_lag_{d}d" for t in ("hits", "bytes_sum") for d in LAG_DAYS],
        "hits_diff_lag_1d_2d", "bytes_sum_diff_lag_1d_2d",
        *[f"{t}_roll_{k}_{w}" for t in ("hits", "bytes_sum", "avg_bytes_per_req") for k in ("mean", "std") for w in ROLLS],
    }
)
WHOLE = {"hour", "minute", "dayofweek", "month", "dayofyear", "is_weekend", "time_idx"}
FEATURE_COLS = " ".join(f"{'i' if c in WHOLE else 'f'}:{c}" for c in FEATURES)
RATIO = f"* REPLACE ({_RATIO} AS avg_bytes_per_req)"


def train_features(tag: str) -> tuple[str, ...]:
    step = STEP[tag]
    return (
        *train(tag),
        *test(tag),
        segments("tr_seg", "tr"),
        f"tr_ok AS (SELECT {RATIO} FROM tr_seg WHERE is_gap = 0)",
        featured("tr_f", "tr_ok", step, labels=True),
        f"""feat_all AS (SELECT *, CAST((epoch(bucket_start) - (SELECT epoch(min(t)) FROM
      (SELECT min(bucket_start) AS t FROM tr UNION ALL SELECT min(bucket_start) FROM te))) // {step} AS BIGINT) AS time_idx
      FROM tr_f)""",
        "feat AS (SELECT * FROM feat_all WHERE y_hits_next IS NOT NULL AND y_bytes_sum_next IS NOT NULL)",
    )


def test_features(tag: str, keys: tuple[str, ...] = ()) -> tuple[str, ...]:
    """History and test as one dense series, which is the series of all events."""
    step = STEP[tag]
    return (
        *ts3("hist", step, keys),
        segments("hist_seg", "hist", keys),
        f"hist_r AS (SELECT {RATIO} FROM hist_seg)",
        featured("hist_f", "hist_r", step, keys),
        f"""feat AS (SELECT * FROM (SELECT *, CAST((epoch(bucket_start) - epoch(min(bucket_start) OVER ())) // {step}
      AS BIGINT) AS time_idx FROM hist_f)
      WHERE bucket_start >= (SELECT {floor_to('min(datetime)', step)} FROM ev WHERE {TEST}))""",
    )


SEG5 = (*LOG, *train("5m"), segments("seg", "tr"))
WHOLE_SEG5 = (*WHOLE_LOG, *SEG5[len(LOG) :])
oracle("d1_segment_id", "t:bucket_start i:is_gap i:segment_id", chain(*SEG5, "SELECT * FROM seg"))
oracle(
    "d1_keyed_hosts",
    "x:host i:segment_id i:rows t:first t:last",
    chain(
        *WHOLE_HOSTS,
        segments("seg", "l", ("host",)),
        """SELECT host, segment_id, count(*) AS rows, min(bucket_start) AS first, max(bucket_start) AS last
    FROM seg GROUP BY ALL""",
    ),
)
oracle(
    "d2_day_lags",
    "t:bucket_start i:segment_id f:hits " + " ".join(f"f:hits_lag_{d}d" for d in LAG_DAYS),
    chain(*SEG5, f"SELECT *, {', '.join(lag_cols('hits', 300))} FROM seg"),
)
oracle(
    "d3_lag_difference",
    "t:bucket_start f:bytes_sum_diff_lag_1d_2d",
    chain(
        *SEG5,
        f"""SELECT bucket_start, bytes_sum_lag_1d - bytes_sum_lag_2d AS bytes_sum_diff_lag_1d_2d
    FROM (SELECT *, {', '.join(lag_cols('bytes_sum', 300, (), (1, 2)))} FROM seg)""",
    ),
)
oracle(
    "d4_rolling_mean",
    "t:bucket_start i:segment_id f:hits " + " ".join(f"f:hits_roll_mean_{w}" for w in ROLLS),
    chain(*WHOLE_SEG5, f"SELECT *, {', '.join(roll_cols('hits', 300))} FROM seg"),
)
oracle(
    "d5_rolling_std",
    "t:bucket_start " + " ".join(f"f:bytes_sum_roll_std_{w}" for w in ROLLS),
    chain(*SEG5, f"SELECT *, {', '.join(roll_cols('bytes_sum', 300))} FROM seg"),
)
_NEXT = ", ".join(
    f"{in_segment(f'lead({t}, 1) OVER ({by_segment()})')} AS y_{t}_next" for t in ("hits", "bytes_sum")
)
oracle(
    "d6_next_label",
    "t:bucket_start i:segment_id f:hits f:y_hits_next",
    chain(*SEG5, f"SELECT *, {_NEXT} FROM seg"),
)
oracle(
    "d7_label_drop",
    "t:bucket_start f:y_hits_next f:y_bytes_sum_next",
    chain(
        *WHOLE_SEG5,
        f"""SELECT * FROM (SELECT *, {_NEXT} FROM seg)
    WHERE y_hits_next IS NOT NULL AND y_bytes_sum_next IS NOT NULL""",
    ),
)
_EXTRA = "f:unique_hosts f:err_4xx f:err_5xx f:error_rate i:is_missing_bucket i:is_gap_storm i:is_gap_unknown"
_ID = "t:bucket_start i:is_gap i:segment_id f:hits f:bytes_sum f:avg_bytes_per_req"
oracle(
    "d8_train_features",
    f"{_ID} {_EXTRA} f:y_hits_next f:y_bytes_sum_next {FEATURE_COLS}",
    chain(*LOG, *train_features("15m"), "SELECT * FROM feat"),
)
oracle("d9_history_features", f"{_ID} {FEATURE_COLS}", chain(*LOG, *test_features("15m"), "SELECT * FROM feat"))
oracle(
    "d9_keyed_history_features",
    "x:service t:bucket_start i:segment_id f:hits_lag_7d f:bytes_sum_diff_lag_1d_2d f:hits_roll_mean_1d "
    "f:bytes_sum_roll_std_6h f:avg_bytes_per_req_roll_mean_1h",
    chain(
        *LOG,
        *test_features("15m", _SERVICE),
        *test("15m", _SERVICE),
        "SELECT hist_f.* FROM hist_f SEMI JOIN te USING (service, bucket_start)",
    ),
)
oracle(
    "d10_slice_back_join",
    "t:bucket_start f:hits f:hits_lag_1d f:bytes_sum_roll_mean_6h i:segment_id",
    chain(
        *LOG,
        *test_features("15m"),
        *test("15m"),
        """SELECT te.bucket_start, f.hits, f.hits_lag_1d, f.bytes_sum_roll_mean_6h, f.segment_id
    FROM te LEFT JOIN hist_f f ON epoch_us(te.bucket_start) = epoch_us(f.bucket_start)""",
    ),
)
oracle(
    "d11_quality_guards",
    "x:split x:tag i:rows i:duplicate_times f:hits_na_rate f:bytes_sum_na_rate",
    chain(
        *LOG,
        *all_series(("1m", "5m", "15m")),
        """SELECT split, tag, count(*) AS rows, count(*) - count(DISTINCT bucket_start) AS duplicate_times,
      count(*) FILTER (hits IS NULL) / count(*) AS hits_na_rate,
      count(*) FILTER (bytes_sum IS NULL) / count(*) AS bytes_sum_na_rate FROM series GROUP BY ALL""",
    ),
)
oracle(
    "d13_truth_projection",
    "x:split x:tag t:bucket_start f:hits_true f:bytes_sum_true i:is_gap i:segment_id",
    chain(
        *LOG,
        *all_series(("1m", "5m", "15m")),
        segments("seg", "series", ("split", "tag")),
        "SELECT *, hits AS hits_true, bytes_sum AS bytes_sum_true FROM seg",
    ),
)


def _label_counts(tag: str) -> str:
    sql = chain(
        *WHOLE_LOG,
        *train(tag),
        segments("seg", "tr"),
        f"labels_of AS (SELECT *, {_NEXT} FROM seg WHERE is_gap = 0)",
        f"""SELECT '{tag}' AS tag, count(*) FILTER (y_hits_next IS NOT NULL AND y_bytes_sum_next IS NOT NULL) AS rows_out_train,
      count(*) FILTER (y_hits_next IS NULL OR y_bytes_sum_next IS NULL) AS dropped_na_train_labels,
      {len(FEATURES)} AS n_features FROM labels_of""",
    )
    return f"SELECT * FROM ({sql})"


oracle(
    "d14_feature_report",
    "x:tag i:rows_out_train i:dropped_na_train_labels i:n_features",
    " UNION ALL ".join(map(_label_counts, STEP)),
)
oracle(
    "d15_na_profile",
    "x:col f:na_rate",
    chain(
        *LOG,
        *train_features("15m"),
        "shares AS (SELECT "
        + ", ".join(f"count(*) FILTER ({c} IS NULL) / count(*) AS {c}" for c in FEATURES)
        + ", CAST(NULL AS DOUBLE) AS no_such_column FROM feat)",
        " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS na_rate FROM shares" for c in [*FEATURES, "no_such_column"]),
    ),
)

# forecasts


def naive(name: str, step: int, target: str, keys: tuple[str, ...] = ()) -> str:
    """Seasonal-naive predictions of the test rows in ``te`` with the non-gap history in ``tr``."""
    k = "".join(f"{c}, " for c in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    season = 86400 // step
    return f"""{name} AS (
  SELECT {k}bucket_start, y, true_next, greatest(CASE WHEN rn >= {season} THEN season ELSE y0 END, 0) AS pred,
    'seasonal_naive' AS model, '{target}' AS target
  FROM (SELECT *, row_number() OVER w AS rn, lag(y0, {season - 1}) OVER w AS season, lead(y) OVER w AS true_next
    FROM (SELECT {k}bucket_start, {target} AS y, coalesce({target}, 0) AS y0, false AS testing FROM tr WHERE is_gap = 0
      UNION ALL SELECT {k}bucket_start, {target}, coalesce({target}, 0), true FROM te)
    WINDOW w AS ({part} ORDER BY bucket_start))
  WHERE testing AND true_next IS NOT NULL)"""


oracle(
    "e1_seasonal_naive",
    "t:bucket_start f:hits f:true_next f:pred x:model",
    chain(*LOG, *train("5m"), *test("5m"), naive("p", 300, "hits"), "SELECT *, y AS hits FROM p"),
)
PREDS = (
    *LOG,
    *train("15m", _SERVICE),
    *test("15m", _SERVICE),
    naive("ph", 900, "hits", _SERVICE),
    naive("pb", 900, "bytes_sum", _SERVICE),
    "preds AS (SELECT *, '15m' AS \"window\" FROM ph UNION ALL SELECT *, '15m' FROM pb)",
)
oracle(
    "e1_keyed_services",
    "x:service t:bucket_start f:y f:true_next f:pred x:model x:target x:window",
    chain(*PREDS, "SELECT * FROM preds"),
)
oracle(
    "e2_season_tile",
    "x:service i:horizon_step f:forecast",
    chain(
        *LOG,
        *train("15m", _SERVICE),
        """numbered AS (SELECT service, hits, row_number() OVER (PARTITION BY service ORDER BY bucket_start) AS rn,
      count(*) OVER (PARTITION BY service) AS n FROM tr WHERE is_gap = 0)""",
        "ahead AS (SELECT DISTINCT service, n, unnest(generate_series(1, 250)) AS horizon_step FROM numbered)",
        """SELECT a.service, a.horizon_step, x.hits AS forecast FROM ahead a JOIN numbered x ON x.service = a.service
      AND x.rn = CASE WHEN a.n >= 96 THEN a.n - 95 + (a.horizon_step - 1) % 96 ELSE a.n END""",
    ),
)
oracle(
    "e3_truth_alignment",
    "t:bucket_start f:hits f:true_next",
    chain(
        *LOG,
        *test("5m"),
        "ahead AS (SELECT *, lead(hits) OVER (ORDER BY bucket_start) AS true_next FROM te)",
        "SELECT * FROM ahead WHERE true_next IS NOT NULL",
    ),
)
FOLDS = """folds AS (
  SELECT *, CASE WHEN rn < val_lo - 1 THEN 'train' WHEN rn >= val_lo AND rn < val_lo + 192 THEN 'validation' END AS role
  FROM (SELECT *, n - (k - fold + 1) * 192 AS val_lo FROM (
    SELECT *, unnest(generate_series(1, k)) AS fold FROM (
      SELECT *, row_number() OVER (ORDER BY bucket_start) - 1 AS rn, count(*) OVER () AS n,
        least(5, greatest(0, (count(*) OVER () - 1) // 192 - 1)) AS k FROM feat) WHERE k >= 2)))"""
oracle(
    "e5_time_folds",
    "i:fold x:role t:bucket_start",
    chain(*WHOLE_LOG, *train_features("15m"), FOLDS, "SELECT * FROM folds WHERE role IS NOT NULL"),
)


def errors(truth: str, pred: str, floor: str) -> str:
    d = f"({truth} - {pred})"
    return f"""sqrt(avg({d} * {d})) AS RMSE, avg({d} * {d}) AS MSE, avg(abs({d})) AS MAE,
    100 * avg(abs({d} / {truth})) FILTER (abs({truth}) >= {floor}) AS MAPE"""


oracle(
    "e6_fold_mean",
    "x:model x:target x:window x:metric f:value",
    chain(
        *LOG,
        *train_features("15m"),
        FOLDS,
        f"scored AS (SELECT fold, {errors('y_hits_next', 'hits', '1')} FROM folds WHERE role = 'validation' GROUP BY fold)",
        "long AS (SELECT unnest(['RMSE', 'MSE', 'MAE', 'MAPE']) AS metric, unnest([RMSE, MSE, MAE, MAPE]) AS value FROM scored)",
        """SELECT 'persistence' AS model, 'hits' AS target, '15m' AS "window", metric,
      CASE WHEN count(value) = count(*) THEN avg(value) END AS value FROM long GROUP BY metric""",
    ),
)
_FLOOR = "CASE WHEN target = 'bytes_sum' THEN 1024 ELSE 1 END"


def _sweep(tag: str, target: str) -> str:
    sql = chain(
        *LOG,
        *train(tag),
        *test(tag),
        naive("p", STEP[tag], target),
        f"""SELECT model, target, '{tag}' AS "window", count(*) AS n, {errors('true_next', 'pred', _FLOOR)},
      CAST(NULL AS BOOLEAN) AS beats_naive, CAST(NULL AS BOOLEAN) AS learns FROM p GROUP BY model, target
    UNION ALL SELECT 'gbt', '{target}', '{tag}', count(*), NULL, NULL, NULL, NULL, TRUE, TRUE FROM p""",
    )
    return f"SELECT * FROM ({sql})"


oracle(
    "e8_model_sweep",
    "x:model x:target x:window i:n f:RMSE f:MSE f:MAE f:MAPE x:beats_naive x:learns",
    " UNION ALL ".join(_sweep(tag, t) for tag in STEP for t in ("hits", "bytes_sum")),
)
SCORED = f"""scored AS (SELECT model, target, "window", service, {errors('true_next', 'pred', _FLOOR)}
  FROM preds GROUP BY ALL)"""
LONG = """long AS (SELECT model, target, "window", service, 'test' AS split,
  unnest(['RMSE', 'MSE', 'MAE', 'MAPE']) AS metric, unnest([RMSE, MSE, MAE, MAPE]) AS value FROM scored)"""
oracle(
    "a5_csv_repair",
    "x:model x:target x:window x:split x:metric f:value",
    chain(*PREDS, SCORED, LONG, "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS split) FROM long"),
)
oracle(
    "e9_error_metrics",
    "x:model x:target x:window x:service f:RMSE f:MSE f:MAE",
    chain(*PREDS, SCORED, "SELECT * FROM scored"),
)
oracle("e10_thresholded_mape", "x:target x:service f:MAPE", chain(*PREDS, SCORED, "SELECT * FROM scored"))
oracle(
    "e11_metrics_long",
    "x:model x:target x:window x:service x:split x:metric f:value",
    chain(*PREDS, SCORED, LONG, "SELECT * FROM long"),
)
TOTALS = f"""totals AS (SELECT model, target, "window", {errors('true_next', 'pred', _FLOOR)} FROM preds GROUP BY ALL)"""
oracle(
    "a7_metrics_append",
    "i:batch x:run_id x:model x:target x:window x:split x:metric f:value i:position",
    chain(
        *PREDS,
        TOTALS,
        """long AS (SELECT model, target, "window", 'test' AS split, unnest([1, 2, 3, 4]) AS position,
      unnest(['RMSE', 'MSE', 'MAE', 'MAPE']) AS metric, unnest([RMSE, MSE, MAE, MAPE]) AS value FROM totals)""",
        "SELECT 1 AS batch, 'run-1' AS run_id, * FROM long UNION ALL SELECT 2, 'run-2', * REPLACE (value * 2 AS value) FROM long",
    ),
)
TWO_MODELS = (
    *PREDS,
    f"""totals AS (SELECT model, target, "window", {errors('true_next', 'pred', _FLOOR)}
  FROM (SELECT * FROM preds UNION ALL SELECT * REPLACE ('doubled' AS model, pred * 2 AS pred) FROM preds) GROUP BY ALL)""",
    """long AS (SELECT model, target, "window",
  unnest(['RMSE', 'MSE', 'MAE', 'MAPE']) AS metric, unnest([RMSE, MSE, MAE, MAPE]) AS value FROM totals)""",
)
oracle(
    "e12_benchmark_pivot",
    "x:target x:window x:metric f:seasonal_naive f:doubled",
    chain(
        *TWO_MODELS,
        """SELECT target, "window", metric, max(value) FILTER (model = 'seasonal_naive') AS seasonal_naive,
      max(value) FILTER (model = 'doubled') AS doubled FROM long GROUP BY ALL""",
    ),
)
oracle(
    "e13_kpi_lookup",
    "f:RMSE f:MAE f:MAPE",
    chain(*TWO_MODELS, "SELECT * FROM totals WHERE model = 'doubled' AND target = 'hits'"),
)
CASES = (
    *PREDS,
    """cases AS (SELECT service, target AS metric, "window", bucket_start AS timestamp, coalesce(y, 0) AS y_true,
  coalesce(pred, 0) AS y_pred FROM preds)""",
)
oracle(
    "e14_residuals",
    "x:service x:scenario x:metric t:timestamp f:residual",
    chain(*CASES, "SELECT *, y_true - y_pred AS residual FROM cases, (SELECT unnest(['default', 'calm', 'guarded']) AS scenario)"),
)


def histogram(source: str, value: str, bins: int, keys: tuple[str, ...] = ()) -> tuple[str, ...]:
    if keys:
        k = ", ".join(keys)
        return (
            f"vals AS (SELECT {k}, {value} AS x FROM {source} WHERE {value} IS NOT NULL)",
            f"""ends AS (SELECT {k}, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS a,
      CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS b FROM vals GROUP BY {k})""",
            f"""placed AS (SELECT {k}, CAST(least(floor((x - a) / ((b - a) / {bins})), {bins - 1}) AS INT) AS bin, count(*) AS n
      FROM vals JOIN ends USING ({k}) GROUP BY ALL)""",
            f"""grid AS (SELECT *, unnest(generate_series(0, {bins - 1})) AS bin FROM ends)""",
            f"""SELECT {k}, bin, a + bin * ((b - a) / {bins}) AS bin_start, coalesce(n, 0) AS count
      FROM grid LEFT JOIN placed USING ({k}, bin)""",
        )
    return (
        f"vals AS (SELECT {value} AS x FROM {source} WHERE {value} IS NOT NULL)",
        "ends AS (SELECT min(x) AS a, max(x) AS b FROM vals)",
        f"""placed AS (SELECT CAST(least(floor((x - a) / ((b - a) / {bins})), {bins - 1}) AS INT) AS bin, count(*) AS n
      FROM vals, ends GROUP BY 1)""",
        f"""SELECT g.bin AS bin, a + g.bin * ((b - a) / {bins}) AS bin_start, coalesce(n, 0) AS count
      FROM ends, (SELECT unnest(generate_series(0, {bins - 1})) AS bin) g LEFT JOIN placed ON placed.bin = g.bin""",
    )


oracle(
    "e14_residual_histogram",
    "x:scenario x:metric i:bin f:bin_start i:count",
    chain(
        *CASES,
        "res AS (SELECT scenario, metric, y_true - y_pred AS residual FROM cases, (SELECT unnest(['default', 'calm', 'guarded']) AS scenario))",
        *histogram("res", "residual", 60, ("scenario", "metric")),
    ),
)

# anomalies


def mad(source: str, value: str, width: int, k: float, keys: tuple[str, ...] = (), order: str = "bucket_start") -> tuple[str, ...]:
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    frame = f"OVER ({part} ORDER BY {order} ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW)"
    need = max(1, min(width, max(10, width // 2)))
    return (
        f"""dev AS (SELECT *, abs({value} - CASE WHEN count({value}) {frame} >= {need}
      THEN median({value}) {frame} END) AS dev FROM {source})""",
        f"devmad AS (SELECT *, CASE WHEN count(dev) {frame} >= {need} THEN median(dev) {frame} END AS mad FROM dev)",
        "scores AS (SELECT *, coalesce(dev / nullif(mad, 0), 0) AS anomaly_score FROM devmad)",
        f"mads AS (SELECT *, CASE WHEN anomaly_score > {k} THEN 1 ELSE 0 END AS is_spike FROM scores)",
    )


oracle(
    "g1_rolling_mad",
    "x:split x:tag t:timestamp f:hits f:anomaly_score i:is_spike",
    chain(
        *LOG,
        *all_series(("1m", "5m", "15m")),
        *mad("series", "hits", 24, 3, ("split", "tag")),
        "SELECT *, bucket_start AS timestamp FROM mads",
    ),
)
oracle(
    "g1_keyed_services",
    "x:service x:scenario x:metric t:timestamp f:anomaly_score i:is_spike",
    chain(
        *CASES,
        *mad("cases", "y_true", 8, 2, ("service", "metric"), "timestamp"),
        "SELECT * FROM mads, (SELECT unnest(['default', 'calm', 'guarded']) AS scenario)",
    ),
)
oracle(
    "g2_sustained_spike",
    "x:service x:scenario x:metric t:timestamp i:is_spike i:is_ddos",
    chain(
        *CASES,
        "f AS (SELECT service, metric, timestamp, CASE WHEN y_true > 1 THEN 1 ELSE 0 END AS is_spike FROM cases)",
        """SELECT *, CASE WHEN sum(is_spike) OVER (PARTITION BY service, metric, scenario ORDER BY timestamp ROWS 2 PRECEDING) >= 3
      THEN 1 ELSE 0 END AS is_ddos FROM f, (SELECT unnest(['default', 'calm', 'guarded']) AS scenario)""",
    ),
)


def spike_types(keys: tuple[str, ...] = (), source: str = "tr") -> tuple[str, ...]:
    k = "".join(f"{c}, " for c in keys)
    by = f"GROUP BY {', '.join(keys)}" if keys else ""
    join = f"JOIN lv USING ({', '.join(keys)})" if keys else "CROSS JOIN lv"
    q = {
        "h99": ("hits", 0.99), "b99": ("bytes_sum", 0.99), "e99": ("error_rate", 0.99), "r99": ("avg_bytes_per_req", 0.99),
        "u95": ("unique_hosts", 0.95), "u50": ("unique_hosts", 0.5), "h75": ("hits", 0.75),
    }
    levels = ", ".join(f"quantile_cont({c}, {p}) AS {n}" for n, (c, p) in q.items())
    return (
        f"ok AS (SELECT * FROM {source} WHERE is_gap = 0)",
        f"lv AS (SELECT {k}{levels} FROM ok {by})",
        f"""typed AS (SELECT ok.*, CASE
      WHEN bytes_sum > b99 AND hits <= h75 AND avg_bytes_per_req > r99 THEN 'bandwidth_spike'
      WHEN hits > h99 AND error_rate <= e99 AND unique_hosts <= u50 THEN 'bot_crawler'
      WHEN hits > h99 AND error_rate <= e99 AND unique_hosts > u95 THEN 'flash_crowd'
      WHEN error_rate > e99 THEN 'error_incident' ELSE 'normal' END AS spike_type FROM ok {join})""",
        f"SELECT {k}spike_type, count(*) AS count FROM typed GROUP BY ALL",
    )


oracle(
    "g3_spike_types",
    "x:split x:tag x:spike_type i:count",
    chain(*LOG, *all_series(("1m", "5m", "15m")), *spike_types(("split", "tag"), "series")),
)
oracle(
    "g3_keyed_services",
    "x:service x:spike_type i:count",
    chain(*LOG, *train("15m", _SERVICE), *spike_types(_SERVICE)),
)
oracle(
    "g5_top_anomalies",
    "x:split x:tag t:timestamp f:bytes_sum f:anomaly_score",
    chain(
        *LOG,
        *all_series(("1m", "5m", "15m")),
        *mad("series", "bytes_sum", 24, 3, ("split", "tag")),
        "SELECT *, bucket_start AS timestamp FROM mads ORDER BY anomaly_score DESC, bucket_start, split, tag LIMIT 50",
    ),
)

# exploration

_TAIL = []
_TAIL_COLS = ["i:rows"]
for _name, _col, _kinds in (
    ("hits", "hits", "mean med p95 p99 max"),
    ("bytes", "bytes_sum", "mean p95 p99 max"),
    ("err", "error_rate", "mean p95 max"),
    ("hosts", "unique_hosts", "mean p95"),
):
    for _kind in _kinds.split():
        _fn = {"mean": f"avg({_col})", "max": f"max({_col})", "med": f"median({_col})"}.get(_kind) or (
            f"quantile_cont({_col}, 0.{_kind[1:]})"
        )
        _TAIL.append(f"{_fn} AS {_name}_{_kind}")
        _TAIL_COLS.append(f"f:{_name}_{_kind}")
TAIL_SQL, TAIL_COLS = "count(*) AS rows, " + ", ".join(_TAIL), " ".join(_TAIL_COLS)
oracle(
    "h1_tail_risk",
    "x:split x:tag " + TAIL_COLS,
    chain(*LOG, *all_series(("1m", "5m", "15m")), f"SELECT split, tag, {TAIL_SQL} FROM series WHERE is_gap = 0 GROUP BY ALL"),
)
oracle(
    "h1_keyed_services",
    "x:service " + TAIL_COLS,
    chain(*LOG, *train("15m", _SERVICE), f"SELECT service, {TAIL_SQL} FROM tr WHERE is_gap = 0 GROUP BY ALL"),
)


def _drift(metric: str) -> str:
    cols = ", ".join(
        f"quantile_cont({metric}, {p}) FILTER (split = '{s}') AS {s}_{n}"
        for s in ("train", "test")
        for n, p in (("p95", 0.95), ("p99", 0.99), ("max", 1.0))
    )
    return f"SELECT '{metric}' AS metric, {cols} FROM series WHERE is_gap = 0"


oracle(
    "h2_tail_drift",
    "x:metric " + " ".join(f"f:{s}_{k}" for s in ("train", "test") for k in ("p95", "p99", "max")),
    chain(
        *LOG,
        *all_series(("5m",)),
        " UNION ALL ".join(
            _drift(m) for m in ("hits", "bytes_sum", "error_rate", "unique_hosts", "avg_bytes_per_req")
        ),
    ),
)
PARTS = f"parts AS (SELECT *, hour({_LOCAL}) AS hour, isodow({_LOCAL}) - 1 AS dow FROM tr WHERE is_gap = 0)"
oracle(
    "h3_week_heatmap",
    "i:dow " + " ".join(f"f:h{h}" for h in range(24)),
    chain(
        *LOG,
        *train("5m"),
        PARTS,
        "SELECT d.dow, "
        + ", ".join(f"coalesce(avg(hits) FILTER (hour = {h}), 0) AS h{h}" for h in range(24))
        + " FROM (SELECT unnest(generate_series(0, 6)) AS dow) d LEFT JOIN parts ON parts.dow = d.dow GROUP BY d.dow",
    ),
)
oracle(
    "h4_seasonal_means",
    "x:part i:unit f:mean_hits",
    chain(
        *LOG,
        *train("5m"),
        PARTS,
        """SELECT 'hour' AS part, hour AS unit, avg(hits) AS mean_hits FROM parts GROUP BY 2
    UNION ALL SELECT 'dow', dow, avg(hits) FROM parts GROUP BY 2""",
    ),
)
_CORR = ["hits", "bytes_sum", "avg_bytes_per_req", "unique_hosts", "error_rate", "rate_5xx"]
oracle(
    "h5_correlation",
    "x:metric_a x:metric_b f:corr",
    chain(
        *LOG,
        *train("5m"),
        RATES,
        " UNION ALL ".join(
            f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, corr({a}, {b}) AS corr FROM rated WHERE is_gap = 0"
            for i, a in enumerate(_CORR)
            for b in _CORR[: i + 1]
        ),
    ),
)


def acf(value: str, lags: list[int], keys: tuple[str, ...] = ()) -> tuple[str, ...]:
    k = "".join(f"{c}, " for c in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    same = "".join(f" AND a.{c} = b.{c}" for c in keys)
    ak = "".join(f"a.{c}, " for c in keys)
    return (
        f"""ac AS (SELECT {k}coalesce({value}, 0) - avg(coalesce({value}, 0)) OVER ({part}) AS s,
      row_number() OVER ({part} ORDER BY bucket_start) AS rn FROM tr WHERE is_gap = 0)""",
        f"ac_den AS (SELECT {k}sum(s * s) AS den, count(*) AS n FROM ac {'GROUP BY ALL' if keys else ''})",
        f"lags AS (SELECT unnest({lags}) AS lag)",
        f"""ac_num AS (SELECT {ak}lag, sum(a.s * b.s) AS num FROM ac a JOIN lags ON true
      JOIN ac b ON b.rn = a.rn + lag{same} GROUP BY ALL)""",
        f"""SELECT {k}lag, CASE WHEN n > lag THEN num / CASE WHEN den = 0 THEN 1 ELSE den END END AS acf
      FROM ac_den CROSS JOIN lags LEFT JOIN ac_num USING ({k}lag)""",
    )


oracle(
    "h6_autocorrelation",
    "i:lag f:acf",
    chain(*LOG, *train("5m"), *acf("hits", [*range(61), 144, 288, 10**6])),
)
oracle(
    "h6_keyed_services",
    "x:service i:lag f:acf",
    chain(*LOG, *train("15m", _SERVICE), *acf("bytes_sum", [0, 1, 4, 48, 96], _SERVICE)),
)
_LAGS = (1, 2, 3, 6, 12, 24, 36, 48)
oracle(
    "h7_lag_correlation",
    "x:metric i:lag f:corr",
    chain(
        *LOG,
        *train("5m"),
        "ok AS (SELECT * FROM tr WHERE is_gap = 0)",
        " UNION ALL ".join(
            f"SELECT '{m}' AS metric, {k} AS lag, corr(x, y) AS corr "
            f"FROM (SELECT {m} AS x, lag({m}, {k}) OVER (ORDER BY bucket_start) AS y FROM ok)"
            for m in ("hits", "bytes_sum")
            for k in _LAGS
        ),
    ),
)
oracle(
    "h8_histogram",
    "i:bin f:bin_start i:count",
    chain(*LOG, *train("5m"), *histogram("tr", "bytes_sum", 80)),
)
oracle(
    "h9_raw_quality",
    "i:rows t:time_min t:time_max f:datetime_na_rate f:bytes_na_rate f:bytes_missing_flag_rate f:status_na_rate "
    "f:rate_4xx f:rate_5xx i:unique_hosts i:unique_urls",
    chain(
        *LOG,
        """SELECT count(*) AS rows, min(datetime) AS time_min, max(datetime) AS time_max,
      1 - count(datetime) / count(*) AS datetime_na_rate, 1 - count(bytes) / count(*) AS bytes_na_rate,
      avg(bytes_missing_flag) AS bytes_missing_flag_rate, 1 - count(status) / count(*) AS status_na_rate,
      avg(CASE WHEN status BETWEEN 400 AND 499 THEN 1 ELSE 0 END) AS rate_4xx,
      avg(CASE WHEN status BETWEEN 500 AND 599 THEN 1 ELSE 0 END) AS rate_5xx,
      count(DISTINCT host) AS unique_hosts, count(DISTINCT url) AS unique_urls FROM ev""",
    ),
)
for _q, _c, _kind in (("h10_top_status", "status", "i"), ("h10_top_url", "url", "x")):
    oracle(
        _q,
        f"{_kind}:value i:count",
        chain(
            *LOG,
            f"SELECT {_c} AS value, count(*) AS count FROM ev GROUP BY 1 ORDER BY count DESC, value ASC NULLS LAST LIMIT 10",
        ),
    )
oracle(
    "h11_chart_series",
    "t:bucket_start f:hits f:bytes_sum",
    chain(*LOG, *test("5m"), "SELECT * FROM te WHERE is_gap = 0"),
)

_BY_SERVICE = (*LOG, *train("15m", _SERVICE))
oracle(
    "h3_keyed_services",
    "x:service i:dow " + " ".join(f"f:h{h}" for h in range(24)),
    chain(
        *_BY_SERVICE,
        PARTS,
        "grid AS (SELECT service, unnest(generate_series(0, 6)) AS dow FROM (SELECT DISTINCT service FROM parts))",
        "SELECT service, dow, "
        + ", ".join(f"coalesce(avg(hits) FILTER (hour = {h}), 0) AS h{h}" for h in range(24))
        + " FROM grid LEFT JOIN parts USING (service, dow) GROUP BY ALL",
    ),
)
oracle(
    "h4_keyed_services",
    "x:service x:part i:unit f:mean_hits",
    chain(
        *_BY_SERVICE,
        PARTS,
        """SELECT service, 'hour' AS part, hour AS unit, avg(hits) AS mean_hits FROM parts GROUP BY ALL
    UNION ALL SELECT service, 'dow', dow, avg(hits) FROM parts GROUP BY ALL""",
    ),
)
oracle(
    "h7_keyed_services",
    "x:service x:metric i:lag f:corr",
    chain(
        *_BY_SERVICE,
        "ok AS (SELECT * FROM tr WHERE is_gap = 0)",
        " UNION ALL ".join(
            f"SELECT service, '{m}' AS metric, {k} AS lag, corr(x, y) AS corr FROM (SELECT service, {m} AS x, "
            f"lag({m}, {k}) OVER (PARTITION BY service ORDER BY bucket_start) AS y FROM ok) GROUP BY service"
            for m in ("hits", "bytes_sum")
            for k in _LAGS
        ),
    ),
)
oracle(
    "h8_keyed_services",
    "x:service i:bin f:bin_start i:count",
    chain(*_BY_SERVICE, *histogram("tr", "bytes_sum", 80, _SERVICE)),
)
oracle(
    "h11_overlay_points",
    "x:service t:bucket_start f:bytes_sum",
    chain(*_BY_SERVICE, "SELECT * FROM tr WHERE is_missing_bucket = 1"),
)
oracle(
    "b16_tag_resolution",
    "x:tag i:step i:per_hour i:per_day i:roll_1h i:roll_6h i:roll_1d i:step_of_tag i:rows",
    chain(
        *LOG,
        *all_series(("1m", "5m", "15m")),
        """SELECT s.*, 3600 // step AS per_hour, 86400 // step AS per_day, 3600 // step AS roll_1h, 21600 // step AS roll_6h,
      86400 // step AS roll_1d, step AS step_of_tag
    FROM (SELECT tag, CASE tag WHEN '1m' THEN 60 WHEN '5m' THEN 300 ELSE 900 END AS step, count(*) AS rows FROM series GROUP BY ALL) s""",
    ),
)
_SETS = {
    "hits": [c for c in FEATURES if not c.startswith(("bytes_sum_", "avg_bytes_per_req_"))],
    "bytes_sum": [c for c in FEATURES if not c.startswith(("hits_lag_", "hits_diff_"))],
}
oracle(
    "d12_feature_sets",
    "x:target x:feature i:known",
    chain(
        *LOG,
        *train_features("15m"),
        " UNION ALL ".join(
            f"SELECT '{t}' AS target, '{c}' AS feature, count({c}) AS known FROM feat" for t, cols in _SETS.items() for c in cols
        ),
    ),
)
oracle(
    "i2_policy_parameters",
    "x:scenario x:metric x:window f:buffer i:win_minutes i:min_instances i:max_instances f:unit_cost i:step_limit i:rows",
    chain(
        *CASES,
        "knobs(scenario, step_limit) AS (VALUES ('default', 15), ('calm', 5), ('guarded', 30))",
        """SELECT k.*, metric, "window", 0.3::DOUBLE AS buffer, 15 AS win_minutes, 2 AS min_instances, 50 AS max_instances,
      0.05::DOUBLE AS unit_cost, count(*) AS rows FROM cases, knobs k GROUP BY ALL""",
    ),
)

# capacity

UNITS = {m: SCALING["capacity_per_instance"][m]["15m"] for m in ("hits", "bytes_sum")}
_UNIT = f"CASE WHEN metric = 'hits' THEN {UNITS['hits']} ELSE {UNITS['bytes_sum']} END"


def need(demand: str) -> str:
    return f"least(50, greatest(2, CAST(ceil(greatest(0, {demand}) / {_UNIT} * (1 + 0.3)) AS BIGINT)))"


_SCENARIOS = "(SELECT unnest(['default', 'calm', 'guarded']) AS scenario)"
oracle(
    "i1_capacity_lookup",
    "x:scenario x:metric x:window f:units i:rows",
    chain(
        *CASES,
        f"""SELECT scenario, metric, "window", {_UNIT} AS units, count(*) AS rows FROM cases, {_SCENARIOS} GROUP BY ALL""",
    ),
)
oracle(
    "i3_required_instances",
    "x:service x:scenario x:metric t:timestamp i:required_instances",
    chain(*CASES, f"SELECT *, {need('y_pred')} AS required_instances FROM cases, {_SCENARIOS}"),
)
oracle(
    "i4_bounded_step",
    "i:l_orderkey i:l_linenumber i:moved",
    """SELECT l_orderkey, l_linenumber, least(50, greatest(2, now + greatest(-10, least(10, want - now)))) AS moved
    FROM (SELECT *, l_linenumber * 9 - 5 AS now, CAST(l_quantity AS BIGINT) AS want FROM lineitem)""",
)


def sizes(baseline: str) -> tuple[str, ...]:
    return (
        f"""ranked AS (SELECT *, {need('y_true')} AS req, count(*) OVER (PARTITION BY service, metric) AS n,
      count(*) FILTER (timestamp < TIMESTAMP '2024-01-25') OVER (PARTITION BY service, metric) AS early,
      row_number() OVER (PARTITION BY service, metric ORDER BY timestamp) AS rn FROM cases)""",
        f"""sizes AS (SELECT service, metric, "window", CAST(floor(quantile_cont(CAST(req AS DOUBLE), 0.95)) AS BIGINT) AS static_n
      FROM ranked WHERE {baseline} GROUP BY ALL)""",
    )


FIRST_PART = "rn <= floor(n * 0.7::DOUBLE)"
for _q, _where in (
    ("i5_static_size", FIRST_PART),
    (
        "i5_static_size_cutoff",
        f"CASE WHEN early > 0 THEN timestamp < TIMESTAMP '2024-01-25' ELSE {FIRST_PART} END",
    ),
):
    oracle(
        _q,
        "x:service x:scenario x:metric x:window i:static_n",
        chain(*CASES, *sizes(_where), f"SELECT * FROM sizes, {_SCENARIOS}"),
    )
STATIC = (
    *CASES,
    *sizes(FIRST_PART),
    f"""static AS (SELECT *, cap - y_true AS headroom FROM (
  SELECT c.*, {need('y_pred')} AS required_instances, inst AS instances, inst * {_UNIT} AS cap
  FROM (SELECT cases.*, least(50, greatest(2, static_n)) AS inst FROM cases JOIN sizes USING (service, metric)) c))""",
)
oracle(
    "i6_static_policy",
    "x:service t:timestamp x:scenario x:metric x:window x:policy_mode f:y_true f:y_pred i:required_instances i:instances "
    "i:effective_instances f:capacity_total f:headroom f:under_provision f:over_provision x:sla_violation f:cost_step "
    "f:server_hours_step f:cost_rate_per_hour",
    chain(
        *STATIC,
        """SELECT *, 'static' AS policy_mode, instances AS effective_instances, cap AS capacity_total,
      greatest(0, -headroom) AS under_provision, greatest(0, headroom) AS over_provision,
      headroom < 0 AS sla_violation, instances * 0.25 * 0.05 AS cost_step, instances * 0.25 AS server_hours_step,
      instances * 0.05 AS cost_rate_per_hour FROM static, (SELECT unnest(['default', 'calm', 'guarded']) AS scenario)""",
    ),
)
MOVING = (
    *CASES,
    f"""steps AS MATERIALIZED (SELECT *, instances * {_UNIT} - y_true AS headroom, instances * 0.0125::DOUBLE AS cost_step,
    coalesce(lag(instances) OVER (PARTITION BY service, metric, scenario ORDER BY timestamp), 2) AS before
  FROM (SELECT *, {need('y_pred')} AS instances FROM cases, {_SCENARIOS}))""",
    """moves AS (SELECT *, CASE WHEN instances > before THEN 'scale_out' ELSE 'scale_in' END AS action
  FROM steps WHERE instances <> before)""",
)


def moving(name: str, cols: str, *parts: str) -> None:
    oracle(name, cols, chain(*MOVING, *parts))


moving(
    "i9_scale_events",
    "x:service t:timestamp x:scenario x:metric x:window x:policy_mode x:action i:from_instances i:to_instances i:delta x:reason",
    """SELECT *, 'predictive' AS policy_mode, before AS from_instances, instances AS to_instances,
  instances - before AS delta, CASE action WHEN 'scale_out' THEN 'forecast needs more' ELSE 'forecast needs less' END AS reason
FROM moves""",
)
SUMMARY = """summary AS (SELECT service, scenario, metric, "window", 'predictive' AS policy_mode, sum(cost_step) AS estimated_total_cost,
    sum(instances * 0.25::DOUBLE) AS total_server_hours, avg(instances) AS avg_instances, max(instances) AS peak_instances,
    avg(CASE WHEN headroom < 0 THEN 1 ELSE 0 END) AS sla_violation_rate,
    sum(greatest(0, -headroom)) AS total_under_provision, max(greatest(0, -headroom)) AS max_under_provision,
    count(*) AS num_points, count(*) FILTER (instances <> before) AS num_scale_events,
    count(*) FILTER (instances <> before) / (count(*) * 0.25::DOUBLE) AS events_per_hour
  FROM steps GROUP BY ALL)"""
moving(
    "i10_run_summary",
    "x:service x:scenario x:metric x:window x:policy_mode f:estimated_total_cost f:total_server_hours f:avg_instances "
    "i:peak_instances f:sla_violation_rate f:total_under_provision f:max_under_provision i:num_points "
    "i:num_scale_events f:events_per_hour",
    SUMMARY,
    "SELECT * FROM summary",
)
moving(
    "i11_policy_comparison",
    "x:service x:scenario x:metric x:window f:static_cost f:predictive_cost f:saving f:saving_pct",
    *sizes(FIRST_PART),
    """fixed AS (SELECT service, metric, sum(least(50, greatest(2, static_n)) * 0.0125::DOUBLE) AS static_cost
  FROM cases JOIN sizes USING (service, metric) GROUP BY ALL)""",
    """held AS (SELECT service, scenario, metric, "window", sum(cost_step) AS predictive_cost FROM steps GROUP BY ALL)""",
    """SELECT *, static_cost - predictive_cost AS saving, (static_cost - predictive_cost) / static_cost AS saving_pct
FROM held JOIN fixed USING (service, metric)""",
)
moving(
    "i12_daily_events",
    "x:scenario x:date i:scale_out i:scale_in i:total",
    """SELECT scenario, CAST(timestamp AS DATE) AS date, count(*) FILTER (action = 'scale_out') AS scale_out,
  count(*) FILTER (action = 'scale_in') AS scale_in, count(*) AS total FROM moves GROUP BY ALL""",
)
moving(
    "i13_instance_distribution",
    "x:scenario x:metric i:instances i:count f:pct_time",
    "levels AS (SELECT scenario, metric, instances, count(*) AS n FROM steps GROUP BY ALL)",
    "SELECT *, n AS count, n / sum(n) OVER (PARTITION BY scenario, metric) AS pct_time FROM levels",
)
oracle(
    "i14_cumulative_cost",
    "x:service x:scenario x:metric t:timestamp f:cumulative_cost",
    chain(
        *STATIC,
        f"""SELECT *, sum(instances * 0.0125::DOUBLE) OVER (PARTITION BY service, metric, scenario ORDER BY timestamp) AS cumulative_cost
    FROM static, {_SCENARIOS}""",
    ),
)

# streaming

oracle(
    "s1_streaming_buckets",
    TS2_COLS.replace("i:unique_hosts ", "x:hosts_near "),
    chain(
        *LOG,
        ts2("b", 300),
        """SELECT *, TRUE AS hosts_near FROM b WHERE bucket_start + INTERVAL 5 MINUTES <=
      (SELECT max(datetime) FROM ev) - INTERVAL 10 MINUTES""",
    ),
)
oracle(
    "s2_streaming_outages",
    "i:is_gap_storm i:buckets i:hits",
    chain(
        *LOG,
        ts2("b", 300),
        f"""SELECT CASE WHEN {known('bucket_start', 300)} THEN 1 ELSE 0 END AS is_gap_storm, count(*) AS buckets,
      sum(hits) AS hits FROM b
    WHERE bucket_start + INTERVAL 5 MINUTES <= (SELECT max(datetime) FROM ev) - INTERVAL 10 MINUTES GROUP BY 1""",
    ),
)
oracle(
    "a9_metadata",
    "x:tag x:feature i:n_hits i:series_rows",
    chain(
        *LOG,
        *all_series(("1m", "5m", "15m")),
        f"""SELECT tag, unnest({FEATURES}) AS feature, 25 AS n_hits, count(*) AS series_rows FROM series GROUP BY tag""",
    ),
)

# models: what SQL can state of their output

for _q, _target in (("e4_boosted_trees", "hits"), ("e7_batch_scoring", "bytes_sum")):
    oracle(
        _q,
        f"t:bucket_start f:{_target} f:true_next x:model x:pred_is_load x:learns",
        chain(
            *LOG,
            *test("15m"),
            f"ahead AS (SELECT *, lead({_target}) OVER (ORDER BY bucket_start) AS true_next FROM te)",
            "SELECT *, 'gbt' AS model, TRUE AS pred_is_load, TRUE AS learns FROM ahead WHERE true_next IS NOT NULL",
        ),
    )
oracle(
    "g4_isolation_forest",
    "t:bucket_start x:score_in_range x:flags_are_top x:score_follows_distance",
    chain(
        *LOG,
        *train("15m"),
        "SELECT bucket_start, TRUE AS score_in_range, TRUE AS flags_are_top, TRUE AS score_follows_distance FROM tr WHERE is_gap = 0",
    ),
)
oracle(
    "e4_validation_curves",
    "x:target x:window i:fold i:round x:error_is_known x:best_is_least x:rounds_help",
    chain(
        *LOG,
        *train_features("15m"),
        FOLDS,
        """SELECT 'hits' AS target, '15m' AS "window", fold, unnest(generate_series(1, 20)) AS round, TRUE AS error_is_known,
      TRUE AS best_is_least, TRUE AS rounds_help FROM (SELECT DISTINCT fold FROM folds)""",
    ),
)
oracle(
    "h12_report_bundle",
    "x:table_name i:rows",
    chain(
        *LOG,
        *train("5m"),
        PARTS,
        *spike_types()[:-1],
        """fixed(table_name, rows) AS (VALUES ('tail_risk', 6), ('hist_hits', 80), ('hist_bytes_sum', 80), ('heatmap_hits', 7),
      ('acf_peaks_hits', 2), ('correlation', 21), ('lag_correlation', 16), ('acf_hits', 61), ('acf_bytes_sum', 61), ('tail_drift', 5))""",
        """SELECT * FROM fixed UNION ALL SELECT 'trend', count(*) FROM tr WHERE is_gap = 0
    UNION ALL SELECT 'seasonal_means_hits', count(DISTINCT hour) + count(DISTINCT dow) FROM parts
    UNION ALL SELECT 'spike_type_counts', count(DISTINCT spike_type) FROM typed""",
    ),
)

# streams with state, sessions and joins by time

oracle("s3_streaming_corrections", TS2_COLS, chain(*LOG, ts2("b", 900), "SELECT * FROM b"))
oracle(
    "s4_streaming_unknown_outages",
    "x:host t:gap_start t:gap_end i:rows x:status",
    chain(
        *LOG,
        ts2("b", 900, ("host",)),
        """holes AS (SELECT host, bucket_start + INTERVAL 15 MINUTES AS gap_start, lead(bucket_start) OVER (PARTITION BY host ORDER BY bucket_start) AS gap_end FROM b)""",
        """sized AS (SELECT *, CAST(epoch(gap_end - gap_start) // 900 AS BIGINT) AS rows FROM holes)""",
        """SELECT *, CASE WHEN gap_end IS NULL THEN 'open' ELSE 'closed' END AS status FROM sized WHERE gap_end IS NULL OR rows >= 48""",
    ),
)


def sessions_of(key: str, seconds: int) -> tuple[str, ...]:
    return (
        f"""turns AS (SELECT *, CASE WHEN datetime - lag(datetime) OVER (PARTITION BY {key} ORDER BY datetime) <= INTERVAL {seconds} SECONDS
      THEN 0 ELSE 1 END AS turn FROM ev WHERE datetime IS NOT NULL)""",
        f"runs AS (SELECT *, sum(turn) OVER (PARTITION BY {key} ORDER BY datetime ROWS UNBOUNDED PRECEDING) AS run FROM turns)",
        f"""sess AS (SELECT {key}, min(datetime) AS session_start, max(datetime) AS last_event, count(*) AS hits, sum(bytes) AS bytes_sum,
      count(*) FILTER (status BETWEEN 400 AND 599) AS errors FROM runs GROUP BY {key}, run)""",
    )


_SESSION_COLS = "t:session_start t:last_event i:hits i:bytes_sum i:errors"
for _name in ("n1_host_sessions", "s5_streaming_sessions"):
    oracle(_name, "x:host " + _SESSION_COLS, chain(*LOG, *sessions_of("host", 1800), "SELECT * FROM sess"))
oracle("n1_service_sessions", "x:service " + _SESSION_COLS, chain(*LOG, *sessions_of("service", 300), "SELECT * FROM sess"))
oracle(
    "n2_asof_join",
    "x:service t:bucket_start f:hits i:last_bytes t:met_at",
    chain(
        *LOG,
        *train("15m", _SERVICE),
        *test("15m", _SERVICE),
        "s AS (SELECT service, bucket_start, hits FROM tr UNION ALL SELECT service, bucket_start, hits FROM te)",
        "e AS (SELECT service, datetime, max(bytes) AS last_bytes FROM ev WHERE datetime IS NOT NULL GROUP BY ALL)",
        """SELECT s.service, s.bucket_start, s.hits, e.last_bytes, e.datetime AS met_at
    FROM s ASOF LEFT JOIN e ON s.service = e.service AND s.bucket_start >= e.datetime""",
    ),
)
oracle(
    "n3_interval_join",
    "x:host t:session_start i:outages i:seconds i:first_order",
    chain(
        *LOG,
        *sessions_of("host", 1800),
        ORDER_OUTAGES,
        "spans AS (SELECT host, session_start, last_event + INTERVAL 1 SECOND AS session_end FROM sess)",
        """SELECT host, session_start, count(*) AS outages, sum(epoch(least(session_end, b)) - epoch(greatest(session_start, a))) AS seconds,
      min(o_orderkey) AS first_order FROM spans JOIN outages ON session_start < b AND a < session_end AND a < b GROUP BY ALL""",
    ),
)
oracle(
    "n4_recent_errors",
    "x:host t:datetime i:n i:recent i:errors i:bytes",
    chain(
        *LOG,
        """frames AS (SELECT host, datetime, count(*) OVER w AS recent, count(*) FILTER (status >= 400) OVER w AS errors, sum(bytes) OVER w AS bytes
      FROM ev WHERE datetime IS NOT NULL
      WINDOW w AS (PARTITION BY host ORDER BY datetime RANGE BETWEEN INTERVAL 3600 SECONDS PRECEDING AND CURRENT ROW))""",
        """SELECT host, datetime, count(*) AS n, max(recent) AS recent, max(errors) AS errors, max(bytes) AS bytes FROM frames GROUP BY ALL""",
    ),
)

# mergeable states

_SUMS = """count(*) AS hits, sum(bytes) AS bytes_sum, count(*) FILTER (status BETWEEN 400 AND 499) AS err_4xx,
  count(*) FILTER (status BETWEEN 500 AND 599) AS err_5xx"""
_DATED = "dated AS (SELECT *, CAST(datetime AS DATE) AS day, hour(datetime) AS hour FROM ev WHERE datetime IS NOT NULL)"
oracle(
    "m1_merged_hosts",
    "x:service x:day i:hits i:bytes_sum i:err_4xx i:err_5xx i:exact x:hosts_near",
    chain(*LOG, _DATED, f"SELECT service, day, {_SUMS}, count(DISTINCT host) AS exact, TRUE AS hosts_near FROM dated GROUP BY 1, 2"),
)
oracle(
    "m2_merged_quantiles",
    "x:service x:day i:n x:p95_near x:p99_near",
    chain(*LOG, _DATED, "SELECT service, day, count(bytes) AS n, TRUE AS p95_near, TRUE AS p99_near FROM dated WHERE bytes IS NOT NULL GROUP BY 1, 2"),
)
oracle(
    "m3_load_rollup",
    "i:grouping x:service x:day i:hour i:hits i:bytes_sum i:err_4xx i:err_5xx f:error_rate",
    chain(
        *LOG,
        _DATED,
        f"""totals AS (SELECT grouping(service, day, hour) AS grouping, service, day, hour, {_SUMS} FROM dated
      GROUP BY GROUPING SETS ((service, day, hour), (service, day), (service), (), (hour)))""",
        "SELECT *, (err_4xx + err_5xx) / hits AS error_rate FROM totals",
    ),
)
oracle(
    "m4_heavy_hitters",
    "x:service x:value i:n x:found_near",
    chain(
        *LOG,
        "counts AS (SELECT service, url AS value, count(*) AS n FROM ev WHERE datetime IS NOT NULL GROUP BY 1, 2)",
        "SELECT *, TRUE AS found_near FROM (SELECT *, sum(n) OVER (PARTITION BY service) AS whole FROM counts) WHERE n * 100 >= whole",
    ),
)
