"""Oracle SQL (DuckDB dialect, plain ANSI where possible) for the
registered queries. Written independently of the DataFrame code from the
same rules, over the same driver tables. Money is summed as exact
DECIMAL(20,4) and presented as DOUBLE, like the Spark side."""

from __future__ import annotations

_SRC = ("SHARE", "RESERVE", "DIVIDEND", "DEDUCTION")
_TOT = ("share_capital_total", "reserves_total", "dividends_payable_total", "deductions_total")
_UPD = ("last_share_update", "last_reserves_update", "last_dividends_update",
        "last_deductions_update")

# Adapter E: events -> capital events.
EV_E = """ev AS (
  SELECT event_id,
    CASE event_type WHEN 'signup' THEN 'SHARE' WHEN 'purchase' THEN 'RESERVE'
      WHEN 'view' THEN 'DIVIDEND' WHEN 'click' THEN 'DEDUCTION' ELSE 'UNKNOWN' END AS source_type,
    'FSP' || lpad(CAST(user_id % 4 + 1 AS VARCHAR), 3, '0') AS fsp_id,
    CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 WHEN 0 THEN 'BANKING'
      WHEN 1 THEN 'INSURANCE' WHEN 2 THEN 'MICROFINANCE' WHEN 3 THEN 'PENSION' END AS sector,
    CAST(ts AS DATE) AS reporting_date,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS transaction_date,
    CAST(value AS DECIMAL(20,4)) AS amount,
    ts AS ingestion_time,
    CASE event_id % 4 WHEN 0 THEN 'TZS' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' WHEN 3 THEN 'GBP' END
      AS currency
  FROM events)"""

# Adapter S: lineitem x orders x customer -> capital events.
EV_S = """ev AS (
  SELECT l_orderkey * 10 + l_linenumber AS event_id,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'SHARE'
         WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'RESERVE'
         WHEN l_returnflag = 'A' THEN 'DIVIDEND'
         WHEN l_returnflag = 'R' THEN 'DEDUCTION' ELSE 'UNKNOWN' END AS source_type,
    'FSP' || lpad(CAST(c_nationkey % 4 + 1 AS VARCHAR), 3, '0') AS fsp_id,
    c_mktsegment AS sector,
    last_day(CAST(o_orderdate AS DATE)) AS reporting_date,
    CAST(o_orderdate AS DATE) AS transaction_date,
    CAST(l_extendedprice AS DECIMAL(20,4)) AS amount,
    l_shipdate AS ingestion_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


# Rates for the currency query (the same fixed values as the library's
# default rates table).
RATES = """rates(source_type, currency, rate) AS (VALUES
  ('SHARE', 'TZS', 1::DECIMAL(20,6)), ('SHARE', 'USD', 2500), ('SHARE', 'EUR', 2700),
  ('SHARE', 'GBP', 3100),
  ('RESERVE', 'TZS', 1), ('RESERVE', 'USD', 2500), ('RESERVE', 'EUR', 2500), ('RESERVE', 'GBP', 2500),
  ('DIVIDEND', 'TZS', 1), ('DIVIDEND', 'USD', 2500), ('DIVIDEND', 'EUR', 2500),
  ('DIVIDEND', 'GBP', 2500),
  ('DEDUCTION', 'TZS', 1), ('DEDUCTION', 'USD', 2500), ('DEDUCTION', 'EUR', 2500),
  ('DEDUCTION', 'GBP', 2500))"""


def prepared(sector_mode: str = "submitted", src: str = "ev") -> str:
    """Known source types, sector rule, non-NULL keys."""
    if sector_mode == "general":
        sector = ("CASE WHEN source_type = 'SHARE' THEN COALESCE(NULLIF(sector, ''), 'GENERAL') "
                  "ELSE 'GENERAL' END")
    else:
        sector = "sector"
    return f"""pe AS (
  SELECT event_id, source_type, fsp_id, {sector} AS sector, reporting_date, transaction_date,
         amount, ingestion_time
  FROM {src}
  WHERE source_type IN ('SHARE','RESERVE','DIVIDEND','DEDUCTION'))
, pev AS (SELECT * FROM pe WHERE fsp_id IS NOT NULL AND sector IS NOT NULL
                              AND reporting_date IS NOT NULL)"""


def state_cte(name: str = "st", src: str = "pev") -> str:
    sums = ",\n    ".join(
        f"CAST(SUM(CASE WHEN source_type = '{s}' THEN COALESCE(amount, 0) ELSE 0 END) "
        f"AS DECIMAL(20,4)) AS {t}" for s, t in zip(_SRC, _TOT))
    maxes = ",\n    ".join(
        f"MAX(CASE WHEN source_type = '{s}' THEN ingestion_time END) AS {u}"
        for s, u in zip(_SRC, _UPD))
    return f"""{name}0 AS (
  SELECT fsp_id, sector, reporting_date,
    {sums},
    {maxes},
    MAX(ingestion_time) AS last_computed_at, COUNT(*) AS event_count
  FROM {src} GROUP BY fsp_id, sector, reporting_date)
, {name} AS (
  SELECT fsp_id, sector, reporting_date, {', '.join(_TOT)},
    CAST(share_capital_total + reserves_total - dividends_payable_total - deductions_total
         AS DECIMAL(20,4)) AS net_core_capital,
    {', '.join(_UPD)}, last_computed_at, event_count
  FROM {name}0)"""


STATE_OUT = ("fsp_id, sector, reporting_date, "
             + ", ".join(f"CAST({t} AS DOUBLE) AS {t}" for t in _TOT + ("net_core_capital",))
             + ", " + ", ".join(_UPD) + ", last_computed_at, event_count")


def with_(*ctes: str) -> str:
    return "WITH " + "\n, ".join(ctes) + "\n"


def _state_e(sector_mode="submitted") -> str:
    return with_(EV_E, prepared(sector_mode), state_cte())


def _freshness_select(as_of: str, limits_min: tuple) -> str:
    """Freshness columns over ``st`` with as_of an SQL expression."""
    comps = ("share", "reserves", "dividend", "deduct")
    cols, fresh, missing = [], [], []
    for c, u, lim in zip(comps, _UPD, limits_min):
        age = f"((epoch_us({as_of}) // 1000) - (epoch_us({u}) // 1000))"
        f = f"COALESCE({age} < {int(lim * 60000)}, false)"
        cols.append(f"CAST(floor(({age} + 500) / 1000) AS BIGINT) AS {c}_age_sec")
        cols.append(f"{f} AS {c}_fresh")
        fresh.append(f)
        missing.append(f"{u} IS NULL")
    status = (f"CASE WHEN {' OR '.join(missing)} THEN 'DELAYED' "
              f"WHEN NOT ({' AND '.join(fresh)}) THEN 'PARTIAL' ELSE 'LIVE' END AS freshness_status")
    return ", ".join(cols + [status])


_EOD = "CAST(reporting_date + INTERVAL 1 DAY AS TIMESTAMP)"
_HOURS_LIMITS = (300, 900, 300, 900)

_SUMMARY = ("CAST(SUM(share_capital_total) AS DOUBLE) AS share_total, "
            "CAST(SUM(reserves_total) AS DOUBLE) AS reserves_total, "
            "CAST(SUM(dividends_payable_total) AS DOUBLE) AS dividends_total, "
            "CAST(SUM(deductions_total) AS DOUBLE) AS deductions_total, "
            "CAST(SUM(net_core_capital) AS DOUBLE) AS net_total, "
            "MAX(last_computed_at) AS last_update")


def _printed(unit_exp: int, suffix: str) -> str:
    scale = "0." + "0" * (unit_exp - 1) + "1"

    def amt(c):
        return (f"CAST(CAST(ROUND({c} * {scale}, 1) AS DECIMAL(38,1)) AS VARCHAR) || '{suffix}'")

    def line(label, c, u=None):
        s = f"rpad('{label}', 22, ' ') || {amt(c)}"
        if u:
            s += f" || '  (' || COALESCE(strftime({u}, '%H:%M'), '--:--') || ')'"
        return s
    labels = [("Share Capital:", _TOT[0], _UPD[0]), ("Reserves:", _TOT[1], _UPD[1]),
              ("Dividends Payable:", _TOT[2], _UPD[2]), ("Deductions:", _TOT[3], _UPD[3])]
    parts = ["'Realtime Capital Position'", "'As of: ' || strftime(last_computed_at, '%H:%M:%S')"]
    # The specified layout: title and time, a blank line, the components, a blank line, the net.
    parts += ["''", *[line(*x) for x in labels], "''", line("Net Core Capital:", "net_core_capital")]
    return "concat_ws(chr(10), " + ", ".join(parts) + ") AS report_text"


def _changelog() -> str:
    w = ("OVER (PARTITION BY fsp_id, sector, reporting_date ORDER BY ingestion_time, event_id "
         "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    sums = [f"CAST(SUM(CASE WHEN source_type = '{s}' THEN COALESCE(amount, 0) ELSE 0 END) {w} "
            f"AS DECIMAL(20,4)) AS {t}" for s, t in zip(_SRC, _TOT)]
    maxes = [f"MAX(CASE WHEN source_type = '{s}' THEN ingestion_time END) {w} AS {u}"
             for s, u in zip(_SRC, _UPD)]
    return (with_(EV_E, prepared(), f"""cl AS (
  SELECT event_id, source_type, ingestion_time, fsp_id, sector, reporting_date,
    {', '.join(sums)}, {', '.join(maxes)},
    MAX(ingestion_time) {w} AS last_computed_at, COUNT(*) {w} AS event_count
  FROM pev)""")
            + "SELECT event_id, source_type, ingestion_time, fsp_id, sector, reporting_date, "
            + ", ".join(f"CAST({t} AS DOUBLE) AS {t}" for t in _TOT)
            + ", CAST(CAST(share_capital_total + reserves_total - dividends_payable_total"
              " - deductions_total AS DECIMAL(20,4)) AS DOUBLE) AS net_core_capital, "
            + ", ".join(_UPD) + ", last_computed_at, event_count FROM cl")


def _snapshots_two_rounds() -> str:
    """First round at noon of each reporting date (events ingested before
    it), second at the end of the day (all events)."""
    noon = "CAST(reporting_date AS TIMESTAMP) + INTERVAL 12 HOUR"
    return with_(
        EV_E, prepared(),
        "early AS (SELECT * FROM pev WHERE ingestion_time < "
        "CAST(reporting_date AS TIMESTAMP) + INTERVAL 12 HOUR)",
        state_cte("st1", "early"), state_cte("st2", "pev"),
        f"snaps AS (SELECT {noon} AS snapshot_taken_at, reporting_date AS snapshot_reporting_date, "
        f"* FROM st1 UNION ALL SELECT {_EOD} AS snapshot_taken_at, "
        f"reporting_date AS snapshot_reporting_date, * FROM st2)",
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY fsp_id, sector, reporting_date "
        "ORDER BY snapshot_taken_at DESC) AS rn FROM snaps)")


def _rollup() -> str:
    return (_state_e() + "SELECT CASE WHEN GROUPING(sector) = 0 THEN 'sector' "
            "WHEN GROUPING(fsp_id) = 0 THEN 'fsp' ELSE 'market' END AS level, "
            f"sector, fsp_id, reporting_date, {_SUMMARY} FROM st "
            "GROUP BY GROUPING SETS ((sector, reporting_date), (fsp_id, reporting_date), "
            "(reporting_date))")


def _lookup_args():
    return "fsp_id = 'FSP001' AND sector = 'BANKING' AND reporting_date = DATE '2024-01-15'"


_EVENT_LOG = with_(EV_E, prepared()) + (
    "SELECT ingestion_time AS received_at, source_type, fsp_id, sector, reporting_date, "
    "COALESCE(transaction_date, reporting_date) AS transaction_date, "
    "CAST(amount AS DOUBLE) AS amount, "
    "fsp_id || ':' || sector || ':' || reporting_date AS message_key, "
    "CAST(NULL AS VARCHAR) AS topic, CAST(NULL AS INTEGER) AS partition, "
    "CAST(NULL AS BIGINT) AS offset, CAST(NULL AS INTEGER) AS item_index, "
    "CAST(NULL AS VARCHAR) AS raw_payload FROM pev")

_TOPIC = ("CASE source_type WHEN 'SHARE' THEN 'share-capital' WHEN 'RESERVE' THEN 'other-capital' "
          "WHEN 'DIVIDEND' THEN 'dividends-payable' ELSE 'core-capital-deductions' END")
# The item in canonical form: keys in order, numbers without closing zeros.
_ITEM = ("'{\"reportingDate\":\"' || reporting_date || '\"' || CASE source_type WHEN 'SHARE' "
         "THEN ',\"sectorSnaClassification\":\"' ELSE ',\"sector\":\"' END || sector || '\"' "
         "|| COALESCE(',\"transactionDate\":\"' || transaction_date || '\"', '') "
         "|| ',\"tzsAmount\":' || regexp_replace(regexp_replace(CAST(amount AS VARCHAR), "
         "'(\\.[0-9]*[1-9])0+$', '\\1'), '\\.0+$', '') || '}'")


# Murmur2 of the key in whole numbers of 128 bits, over the words of four bytes and the rest.
_M = "* 1540483477) % 4294967296"
_MURMUR = f"""
  read AS (SELECT DISTINCT message_key, length(message_key) AS n, list_transform(
      string_split(message_key, ''), lambda c: CAST(CASE WHEN c = '' THEN 0 ELSE ord(c) END
      AS HUGEINT)) AS b FROM keyed),
  words AS (SELECT *, list_transform(range(n // 4), lambda i: ((b[4*i+1] + 256 * b[4*i+2]
      + 65536 * b[4*i+3] + 16777216 * b[4*i+4]) {_M}) AS w,
    (CASE WHEN n % 4 > 0 THEN b[n // 4 * 4 + 1] ELSE 0 END)
      + 256 * (CASE WHEN n % 4 > 1 THEN b[n // 4 * 4 + 2] ELSE 0 END)
      + 65536 * (CASE WHEN n % 4 > 2 THEN b[n // 4 * 4 + 3] ELSE 0 END) AS rest FROM read),
  hashed AS (SELECT *, list_reduce(list_prepend(xor(2538058380::HUGEINT, n::HUGEINT),
      list_transform(w, lambda k: (xor(k, k // 16777216) {_M})),
      lambda h, k: xor((h {_M}, k)) AS h FROM words),
  rested AS (SELECT message_key, CASE WHEN n % 4 > 0 THEN (xor(h, rest) {_M} ELSE h END AS h
    FROM hashed),
  mixed AS (SELECT message_key, (xor(h, h // 8192) {_M} AS h FROM rested),
  parted AS (SELECT message_key,
    CAST((xor(h, h // 32768) % 2147483648) % 4 AS INTEGER) AS partition FROM mixed)"""


def _feed_log(damaged: bool) -> str:
    """Log of published events; of those that a damaged feed lets through."""
    payload = "" if damaged else f", {_ITEM} AS raw_payload"
    index = "CASE WHEN event_id % 50 = 4 THEN 1 ELSE 0 END" if damaged else "0"
    kept = " WHERE event_id % 50 NOT IN (0, 1, 2, 3)" if damaged else ""
    return with_(EV_E, prepared(),
                 "keyed AS (SELECT *, fsp_id || ':' || sector || ':' || reporting_date AS message_key "
                 "FROM pev)", _MURMUR) + (
        "SELECT ingestion_time AS received_at, source_type, fsp_id, sector, reporting_date, "
        "COALESCE(transaction_date, reporting_date) AS transaction_date, "
        f"CAST(amount AS DOUBLE) AS amount, message_key, {_TOPIC} AS topic, "
        f"partition, event_id AS offset, CAST({index} AS INTEGER) AS item_index{payload} "
        f"FROM keyed JOIN parted USING (message_key){kept}")


# What is wrong with the messages of the damaged feed.
_FAULTS = f"""faults AS (SELECT *, CASE k WHEN 0 THEN 'malformed' WHEN 1 THEN 'unknown_topic'
    WHEN 2 THEN 'null_value' WHEN 3 THEN 'amount_overflow' WHEN 4 THEN 'bad_item'
    WHEN 6 THEN CASE WHEN transaction_date IS NOT NULL THEN 'bad_transaction_date' END END AS reason
  FROM (SELECT *, event_id % 50 AS k, CASE event_id % 50 WHEN 1 THEN 'capital-drafts' ELSE {_TOPIC} END
      AS topic FROM ev WHERE source_type IN ('SHARE','RESERVE','DIVIDEND','DEDUCTION')))"""


def _report_json() -> str:
    """The document as JSON text from the state ``st`` with freshness columns."""
    num = lambda n, c: f"'\"{n}\":' || CAST({c} AS DECIMAL(38,4))"
    metric = lambda c: (f"'\"{c}\":{{\"fresh\":' || {c}_fresh || ',\"ageSec\":' "  # noqa: E731
                        f"|| COALESCE(CAST({c}_age_sec AS VARCHAR), 'null') || '}}'")
    sep = " || ',' || "
    text = ("'{\"fspId\":\"' || fsp_id || '\",\"sector\":\"' || sector || '\",\"reportingDate\":\"' "
            "|| reporting_date || '\",\"asOf\":\"' || strftime(last_computed_at, '%Y-%m-%dT%H:%M:%S.%g') "
            "|| 'Z\",\"positions\":{' || "
            + sep.join(num(n, c) for n, c in zip(
                ("shareCapital", "reserves", "dividendsPayable", "deductions", "netCoreCapital"),
                _TOT + ("net_core_capital",)))
            + " || '},\"freshnessStatus\":\"' || freshness_status || '\",\"refreshMetrics\":{' || "
            + sep.join(metric(c) for c in ("share", "reserves", "dividend", "deduct"))
            + " || '},\"eventCount\":' || event_count || '}'")
    text = f"regexp_replace({text}, '\\.0+([,}}])', '\\1', 'g')"
    return f"regexp_replace({text}, '(\\.[0-9]*[1-9])0+([,}}])', '\\1\\2', 'g') AS report_json"

ORACLE_SQL: dict[str, str] = {
    "capital_position": _state_e() + f"SELECT {STATE_OUT} FROM st",
    "capital_position_general": _state_e("general") + f"SELECT {STATE_OUT} FROM st",
    "capital_position_star": with_(EV_S, prepared(), state_cte()) + f"SELECT {STATE_OUT} FROM st",
    "feed_totals_share": with_(EV_E) + (
        "SELECT fsp_id, sector, reporting_date, "
        "CAST(CAST(SUM(COALESCE(amount, 0)) AS DECIMAL(20,4)) AS DOUBLE) AS share_capital_total, "
        "MAX(ingestion_time) AS last_computed_at, COUNT(*) AS event_count FROM ev "
        "WHERE source_type = 'SHARE' GROUP BY fsp_id, sector, reporting_date"),
    "freshness": _state_e() + (
        f"SELECT {STATE_OUT}, {_freshness_select(_EOD, _HOURS_LIMITS)} FROM st"),
    "position_report": _state_e() + (
        "SELECT fsp_id AS fspId, sector, reporting_date AS reportingDate, last_computed_at AS asOf, "
        "CAST(share_capital_total AS DOUBLE) AS shareCapital, "
        "CAST(reserves_total AS DOUBLE) AS reserves, "
        "CAST(dividends_payable_total AS DOUBLE) AS dividendsPayable, "
        "CAST(deductions_total AS DOUBLE) AS deductions, "
        "CAST(net_core_capital AS DOUBLE) AS netCoreCapital, freshness_status AS freshnessStatus, "
        "share_fresh AS shareFresh, share_age_sec AS shareAgeSec, "
        "reserves_fresh AS reservesFresh, reserves_age_sec AS reservesAgeSec, "
        "dividend_fresh AS dividendFresh, dividend_age_sec AS dividendAgeSec, "
        "deduct_fresh AS deductFresh, deduct_age_sec AS deductAgeSec, event_count AS eventCount, "
        f"{_report_json()} FROM (SELECT *, {_freshness_select(_EOD, _HOURS_LIMITS)} FROM st)"),
    "printed_report": _state_e() + f"SELECT fsp_id, sector, reporting_date, {_printed(3, 'K')} FROM st",
    "printed_rollup": with_(EV_E, prepared(), state_cte(), "g AS (SELECT CASE WHEN GROUPING(sector) = 0 "
        "THEN 'sector' WHEN GROUPING(fsp_id) = 0 THEN 'fsp' ELSE 'market' END AS level, sector, "
        "fsp_id, reporting_date, "
        + ", ".join(f"SUM({t}) AS {t}" for t in _TOT + ("net_core_capital",)) + ", "
        + ", ".join(f"MAX({u}) AS {u}" for u in _UPD + ("last_computed_at",))
        + " FROM st GROUP BY GROUPING SETS ((sector, reporting_date), (fsp_id, reporting_date), "
        "(reporting_date)))") + f"SELECT level, sector, fsp_id, reporting_date, {_printed(3, 'K')} FROM g",
    "capital_position_exact": _state_e() + "SELECT fsp_id, sector, reporting_date, "
        + ", ".join(f"CAST(CAST({t} AS DECIMAL(38,4)) AS VARCHAR) AS {t}"
                    for t in _TOT + ("net_core_capital",))
        + ", " + ", ".join(_UPD) + ", last_computed_at, event_count FROM st",
    "feed_event_log": _feed_log(damaged=False),
    "feed_stream_log": _feed_log(damaged=True),
    "feed_stream_position": with_(EV_E, prepared(), "thru AS (SELECT * FROM pev WHERE event_id % 50 "
        "NOT IN (0, 1, 2, 3))", state_cte(src="thru")) + f"SELECT {STATE_OUT} FROM st",
    "rebuilt_position": _state_e() + f"SELECT {STATE_OUT} FROM st",
    "rebuild_generations": with_(EV_E, prepared(), prepared("general").replace(
        "pe AS", "gpe AS", 1).replace("pev AS", "gen AS").replace("FROM pe ", "FROM gpe ")) + " UNION ALL ".join(
        f"SELECT CAST({n} AS BIGINT) AS generation, true AS accepted, (SELECT COUNT(*) FROM ev "
        "WHERE source_type IN ('SHARE','RESERVE','DIVIDEND','DEDUCTION')) AS events, "
        "COUNT(*) AS log_rows, COUNT(DISTINCT (fsp_id, sector, reporting_date)) AS keys "
        f"FROM {src}" for n, src in ((1, "gen"), (2, "pev"))),
    "feed_dead_letter": with_(EV_E, _FAULTS) + (
        "SELECT topic, reason, COUNT(*) AS messages FROM faults WHERE reason IS NOT NULL "
        "GROUP BY topic, reason"),
    "feed_quality": with_(EV_E, _FAULTS) + (
        "SELECT counted, CAST(COUNT(*) FILTER (WHERE holds) AS BIGINT) AS n FROM ("
        + " UNION ALL ".join(
            f"SELECT '{r}' AS counted, COALESCE(reason = '{r}', false) AS holds FROM faults" for r in (
                "unknown_topic", "null_value", "malformed", "no_array", "bad_item", "bad_date",
                "amount_overflow", "bad_transaction_date"))
        + " UNION ALL SELECT 'events', k > 3 FROM faults"
          " UNION ALL SELECT 'rows', true FROM faults"
          " UNION ALL SELECT 'rows', k = 4 FROM faults) GROUP BY counted"),
    "state_from_store": _state_e() + f"SELECT {STATE_OUT} FROM st",
    "late_arrivals_logged": with_(EV_S, prepared()) + (
        "SELECT source_type, COUNT(*) AS events, "
        "MAX(date_diff('day', reporting_date, CAST(ingestion_time AS DATE))) AS max_lag_days, "
        "AVG(date_diff('day', reporting_date, CAST(ingestion_time AS DATE))) AS mean_lag_days "
        "FROM pev WHERE reporting_date IN (DATE '1996-01-31', DATE '1996-02-29', DATE '1996-03-31') "
        "GROUP BY source_type"),
    "snapshot_rerun": _snapshots_two_rounds() + (
        f"SELECT snapshot_taken_at, snapshot_reporting_date, {STATE_OUT} FROM snaps"),
    "position_lookup": _state_e() + f"SELECT {STATE_OUT} FROM st WHERE {_lookup_args()}",
    "summary_sector": _state_e() + (
        f"SELECT sector, {_SUMMARY} FROM st WHERE reporting_date = DATE '2024-01-15' GROUP BY sector"),
    "summary_fsp": _state_e() + (
        f"SELECT fsp_id, {_SUMMARY} FROM st WHERE reporting_date = DATE '2024-01-15' GROUP BY fsp_id"),
    "summary_system": _state_e() + (
        f"SELECT 'SYSTEM' AS scope, {_SUMMARY} FROM st WHERE reporting_date = DATE '2024-01-15'"),
    "summary_system_empty": _state_e() + (
        f"SELECT 'SYSTEM' AS scope, {_SUMMARY} FROM st WHERE reporting_date = DATE '1999-12-31'"),
    "rollup_all": _rollup(),
    "snapshot": _state_e() + (
        f"SELECT {_EOD} AS snapshot_taken_at, reporting_date AS snapshot_reporting_date, "
        f"{STATE_OUT} FROM st"),
    "official_position": _snapshots_two_rounds() + (
        f"SELECT snapshot_taken_at, snapshot_reporting_date, {STATE_OUT} FROM ranked WHERE rn = 1"),
    "stored_official_position": _snapshots_two_rounds() + (
        f"SELECT snapshot_taken_at, snapshot_reporting_date, {STATE_OUT} FROM ranked WHERE rn = 1"),
    "reporting_dates": _state_e() + "SELECT DISTINCT reporting_date FROM st",
    "sample_key": _state_e() + (
        "SELECT fsp_id, sector, reporting_date FROM st "
        "ORDER BY fsp_id, sector, reporting_date LIMIT 1"),
    "table_counts": with_(EV_E, prepared(), state_cte()) + (
        "SELECT 'capital_state' AS table_name, COUNT(*) AS row_count FROM st "
        "UNION ALL SELECT 'capital_event_log', COUNT(*) FROM pev "
        "UNION ALL SELECT 'capital_snapshot', COUNT(*) FROM st"),
    "stored_reporting_dates": with_(EV_S, prepared()) + "SELECT DISTINCT reporting_date FROM pev",
    "position_change_stored": with_(
        EV_E, prepared(), "early AS (SELECT * FROM pev WHERE ingestion_time < "
        "CAST(reporting_date AS TIMESTAMP) + INTERVAL 12 HOUR)",
        state_cte("st1", "early"), state_cte("st2", "pev"),
        "sides AS (SELECT fsp_id, sector, reporting_date, "
        + ", ".join(f"COALESCE({t}.{c}, 0) AS {c}_{n}" for c in ("net_core_capital", "event_count")
                    for t, n in (("st1", "before"), ("st2", "after")))
        + " FROM st1 FULL JOIN st2 USING (fsp_id, sector, reporting_date))") + (
        "SELECT fsp_id, sector, reporting_date, "
        "CAST(net_core_capital_before AS DOUBLE) AS net_core_capital_before, "
        "CAST(net_core_capital_after AS DOUBLE) AS net_core_capital_after, "
        "event_count_before, event_count_after, "
        "CAST(net_core_capital_after - net_core_capital_before AS DOUBLE) AS net_core_capital_change, "
        "event_count_after - event_count_before AS event_count_change FROM sides"),
    "late_arrivals": with_(EV_S, prepared()) + (
        "SELECT source_type, COUNT(*) AS events, "
        "MAX(date_diff('day', reporting_date, CAST(ingestion_time AS DATE))) AS max_lag_days, "
        "AVG(date_diff('day', reporting_date, CAST(ingestion_time AS DATE))) AS mean_lag_days "
        "FROM pev GROUP BY source_type"),
    "event_log": _EVENT_LOG,
    "stream_event_log": _EVENT_LOG,
    "position_changelog": _changelog(),
    "changelog_stream": _changelog(),
    "json_roundtrip_position": _state_e() + f"SELECT {STATE_OUT} FROM st",
    "json_roundtrip_events": with_(EV_E) + (
        "SELECT source_type, fsp_id, sector, reporting_date, "
        "COALESCE(transaction_date, reporting_date) AS transaction_date, "
        "CAST(amount AS DOUBLE) AS amount, ingestion_time, "
        "CASE source_type WHEN 'SHARE' THEN 'share-capital' WHEN 'RESERVE' THEN 'other-capital' "
        "WHEN 'DIVIDEND' THEN 'dividends-payable' ELSE 'core-capital-deductions' END AS topic "
        "FROM ev WHERE source_type IN ('SHARE','RESERVE','DIVIDEND','DEDUCTION')"),
    "position_stream": _state_e() + f"SELECT {STATE_OUT} FROM st",
    "position_stream_partials": _state_e() + f"SELECT {STATE_OUT} FROM st",
    "late_replay": _state_e() + f"SELECT {STATE_OUT} FROM st",
    "stored_state_lookup": _state_e() + f"SELECT {STATE_OUT} FROM st WHERE {_lookup_args()}",
    "currency_normalised": with_(
        EV_E.replace("CAST(value AS DECIMAL(20,4)) AS amount", "CAST(value AS DECIMAL(20,4)) AS org"),
        RATES,
        "conv AS (SELECT ev.*, CAST(ROUND(org * rate, 2) AS DECIMAL(20,4)) AS amount FROM ev "
        "JOIN rates USING (source_type, currency))",
        prepared(src="conv"), state_cte()) + f"SELECT {STATE_OUT} FROM st",
}
ORACLE_SQL["json_roundtrip_currency"] = ORACLE_SQL["currency_normalised"]
