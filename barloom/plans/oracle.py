"""The same results in DuckDB SQL, query by query, over the same whole tables."""

from __future__ import annotations

# Shared definitions. Each name is a CTE; a query names the ones it needs, in order.
DEFS = {
    "event_bars": """
        SELECT date_trunc('hour', ts) AS ts, upper(event_type) AS symbol,
               CAST(arg_min(value, event_id) AS DECIMAL(18,6)) AS open,
               CAST(max(value) AS DECIMAL(18,6)) AS high,
               CAST(min(value) AS DECIMAL(18,6)) AS low,
               CAST(arg_max(value, event_id) AS DECIMAL(18,6)) AS close,
               CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS volume,
               'alpha_vantage' AS source
        FROM events GROUP BY 1, 2""",
    "shipment_rows": """
        SELECT l_shipdate AS ts, 'S' || l_suppkey AS symbol,
               CAST(l_extendedprice AS DECIMAL(18,6)) AS price,
               CAST(l_quantity AS BIGINT) AS volume, 'shipments' AS source, l_orderkey, l_linenumber
        FROM lineitem""",
    "shipment_bars": """
        SELECT ts, symbol, arg_min(lowest, l_orderkey) AS open, max(highest) AS high, min(lowest) AS low,
               arg_max(highest, l_orderkey) AS close, CAST(sum(quantity) AS BIGINT) AS volume, 'shipments' AS source
        FROM (SELECT ts, symbol, l_orderkey, min(price) AS lowest, max(price) AS highest, sum(volume) AS quantity
              FROM shipment_rows GROUP BY ts, symbol, l_orderkey)
        GROUP BY ts, symbol""",
    "bars": "SELECT * FROM event_bars UNION ALL SELECT * FROM shipment_bars",
    "existing": """
        SELECT * FROM bars
        WHERE (ts < CASE WHEN source = 'shipments' THEN TIMESTAMP '2000-01-01' ELSE TIMESTAMP '2024-01-20' END
               AND day(ts) <> 13) OR symbol = 'ERROR'""",
    "delivered": """
        SELECT * FROM bars
        WHERE (ts >= CASE WHEN source = 'shipments' THEN TIMESTAMP '1999-07-01' ELSE TIMESTAMP '2024-01-10' END
               OR day(ts) = 13) AND symbol <> 'ERROR'""",
    "state": """
        SELECT source, symbol, max(ts) AS last_watermark, CAST(count(*) AS BIGINT) AS last_row_count,
               'seeded' AS status, TIMESTAMP '2020-01-01 00:00:00' AS updated_at
        FROM existing GROUP BY source, symbol""",
    "loaded": """
        SELECT d.* FROM delivered d LEFT JOIN state s USING (source, symbol)
        WHERE s.last_watermark IS NULL OR d.ts > s.last_watermark""",
    "daily": """
        SELECT symbol, source, CAST(ts AS DATE) AS day, arg_min(open, ts) AS open, max(high) AS high,
               min(low) AS low, arg_max(close, ts) AS close, CAST(sum(volume) AS BIGINT) AS volume
        FROM bars GROUP BY 1, 2, 3""",
    "done": """
        SELECT source, symbol, CAST(ts AS DATE) AS trading_date FROM existing
        WHERE ts >= TIMESTAMP '1999-06-01' AND ts < TIMESTAMP '2000-04-01'
        UNION
        SELECT source, symbol, CAST(ts AS DATE) FROM delivered WHERE ts < TIMESTAMP '1999-09-01'""",
    "pending": """
        SELECT source, symbol, trading_date
        FROM (SELECT source, symbol, CAST(unnest(generate_series(DATE '1999-06-01', DATE '2000-03-31',
                                                                 INTERVAL 1 DAY)) AS DATE) AS trading_date
              FROM (SELECT DISTINCT source, symbol FROM bars)) spine
        WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.source = spine.source AND done.symbol = spine.symbol
                                               AND done.trading_date = spine.trading_date)""",
    "for_pending": """
        SELECT d.* FROM delivered d
        WHERE EXISTS (SELECT 1 FROM pending p WHERE p.source = d.source AND p.symbol = d.symbol
                                                AND p.trading_date = CAST(d.ts AS DATE))""",
    "user_bars": """
        SELECT date_trunc('day', ts) AS ts, 'U' || user_id AS symbol,
               CAST(arg_min(value, event_id) AS DECIMAL(18,6)) AS open, CAST(max(value) AS DECIMAL(18,6)) AS high,
               CAST(min(value) AS DECIMAL(18,6)) AS low, CAST(arg_max(value, event_id) AS DECIMAL(18,6)) AS close,
               CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS volume,
               'alpha_vantage' AS source
        FROM events GROUP BY 1, 2""",
    "first_marks": """
        SELECT symbol, max(ts) AS mark FROM user_bars WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY symbol""",
    "twice_loaded": """
        SELECT u.ts, symbol, u.open, u.high, u.low,
               CAST(CASE WHEN u.ts <= m.mark THEN u.close ELSE u.close + 1 END AS DECIMAL(18,6)) AS close,
               u.volume, u.source, m.mark, u.ts > m.mark OR m.mark IS NULL AS is_second
        FROM user_bars u LEFT JOIN first_marks m USING (symbol)""",
    "steps": """
        SELECT 'run-' || event_id AS run_id, event_type AS step_name,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
               ts AS started_at,
               CASE WHEN event_type <> 'signup'
                    THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS finished_at,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS row_count,
               CASE WHEN event_type = 'error' THEN 'user ' || user_id END AS error_message,
               user_id
        FROM events""",
}

BARS = ["event_bars", "shipment_rows", "shipment_bars", "bars"]
STORED = [*BARS, "existing", "delivered"]
STATE = [*STORED, "state"]
BACKFILL = [*STORED, "done", "pending"]
JOB = ["user_bars", "first_marks", "twice_loaded"]

BAR_OUT = """ts, symbol, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low,
             CAST(close AS DOUBLE) AS close, volume, source"""


def _q(names: list[str], select: str, **extra: str) -> str:
    parts = [f"{name} AS ({DEFS[name]})" for name in names]
    parts += [f"{name} AS ({body})" for name, body in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _summary(of: str) -> str:
    """Daily summary with the average rounded half up in whole numbers."""
    return f"""
        SELECT symbol, CAST(ts AS DATE) AS trading_date,
               CAST((2 * sum(CAST(close * 1000000 AS HUGEINT)) + 100 * count(*)) // (200 * count(*)) AS BIGINT)
                 / 10000.0 AS avg_close,
               CAST(min(close) AS DOUBLE) AS min_close, CAST(max(close) AS DOUBLE) AS max_close,
               CAST(sum(volume) AS BIGINT) AS total_volume
        FROM {of} GROUP BY 1, 2"""


def _latest(of: str) -> str:
    return f"""
        SELECT symbol, ts AS latest_ts, CAST(close AS DOUBLE) AS close_price, volume
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC NULLS FIRST) AS rn FROM {of})
        WHERE rn = 1"""


RANKS = """
    SELECT symbol, trading_date, total_volume,
           CAST(dense_rank() OVER (PARTITION BY trading_date ORDER BY total_volume DESC NULLS FIRST) AS INTEGER)
             AS volume_rank
    FROM summary"""

CHANGES = """
    SELECT symbol, ts, CAST(ts AS DATE) AS trading_date, CAST(close AS DOUBLE) AS close_price,
           CAST(prev AS DOUBLE) AS previous_close, CAST(close - prev AS DOUBLE) AS price_change,
           CAST(sign(c - p) * ((2 * abs(c - p) * 10000 + p) // (2 * nullif(p, 0))) AS BIGINT) / 100.0 AS change_pct,
           volume
    FROM (SELECT *, CAST(close * 100 AS BIGINT) AS c, CAST(prev * 100 AS BIGINT) AS p
          FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY ts) AS prev FROM bars))"""

MARKS = """
    SELECT source, symbol, max(ts) AS max_ts, CAST(count(*) AS BIGINT) AS row_count FROM {} GROUP BY source, symbol"""

ADVANCED = """
    SELECT source, symbol, greatest(s.last_watermark, m.max_ts) AS last_watermark,
           coalesce(m.row_count, s.last_row_count) AS last_row_count,
           CASE WHEN m.max_ts IS NOT NULL THEN 'success' ELSE s.status END AS status,
           CASE WHEN m.max_ts IS NOT NULL THEN TIMESTAMP '2024-02-01 12:00:00' ELSE s.updated_at END AS updated_at
    FROM state s FULL JOIN marks m USING (source, symbol)"""

GATE = """
    SELECT 1 AS seq, 'not_null' AS check_name, 'market_bars' AS table_name,
           count(*) FILTER (symbol IS NULL) = 0 AS passed, count(*) FILTER (symbol IS NULL) AS failed_rows,
           'Column symbol has ' || count(*) FILTER (symbol IS NULL) || ' NULL row(s).' AS details FROM {of}
    UNION ALL
    SELECT 2, 'not_null', 'market_bars', count(*) FILTER (ts IS NULL) = 0, count(*) FILTER (ts IS NULL),
           'Column ts has ' || count(*) FILTER (ts IS NULL) || ' NULL row(s).' FROM {of}
    UNION ALL
    SELECT 3, 'unique', 'market_bars', count(*) = 0, count(*),
           'Column symbol, ts has ' || count(*) || ' duplicated value group(s).'
    FROM (SELECT symbol, ts FROM {of} GROUP BY symbol, ts HAVING count(*) > 1)
    UNION ALL
    SELECT 4, 'range', 'market_bars', count(*) FILTER ({close} < 0) = 0, count(*) FILTER ({close} < 0),
           'Column close has ' || count(*) FILTER ({close} < 0) || ' row(s) outside range min=0, max=None.' FROM {of}
    UNION ALL
    SELECT 5, 'range', 'market_bars', count(*) FILTER (volume < 0) = 0, count(*) FILTER (volume < 0),
           'Column volume has ' || count(*) FILTER (volume < 0) || ' row(s) outside range min=0, max=None.' FROM {of}
    UNION ALL
    SELECT 6, 'freshness', 'market_bars', DATE '2024-02-05' - CAST(max(ts) AS DATE) <= 14,
           CASE WHEN DATE '2024-02-05' - CAST(max(ts) AS DATE) <= 14 THEN 0 ELSE 1 END,
           'Latest ts is ' || (DATE '2024-02-05' - CAST(max(ts) AS DATE))
             || ' day(s) old; max allowed age is 14 day(s).' FROM {of}"""

# Entries of the derived payloads: midnight in the payload's zone as a UTC time.
STAGED = """
    SELECT symbol, day, CASE WHEN source = 'shipments' THEN 'US/Eastern' ELSE 'UTC' END AS zone,
           timezone('UTC', timezone(CASE WHEN source = 'shipments' THEN 'US/Eastern' ELSE 'UTC' END,
                                    CAST(day AS TIMESTAMP))) AS ts,
           open, high, low, close, volume, volume % 97 = 0 AS bad
    FROM daily"""

NULL_COUNTS = "\n".join(
    f"UNION ALL SELECT {i}, 'null_{c}_count', count(*) FILTER ({c} IS NULL) FROM bars"
    for i, c in enumerate(["ts", "symbol", "open", "high", "low", "close", "volume"], start=2)
)

FRESHNESS = """
    SELECT 'freshness' AS check_name, '{table}' AS table_name, age <= 14 AS passed,
           CAST(CASE WHEN age <= 14 THEN 0 ELSE 1 END AS BIGINT) AS failed_rows,
           'Latest {column} is ' || age || ' day(s) old; max allowed age is 14 day(s).' AS details
    FROM (SELECT DATE '2024-02-05' - CAST(max({column}) AS DATE) AS age FROM {of})"""

INTERVALS = """
    SELECT source, symbol, min(trading_date) AS first_day, max(trading_date) AS last_day
    FROM (SELECT *, trading_date - CAST(row_number() OVER (PARTITION BY source, symbol ORDER BY trading_date) AS INTEGER) AS island
          FROM {of})
    GROUP BY source, symbol, island"""

DAMAGED = """SELECT * REPLACE (CASE WHEN volume % 11 <> 0 THEN open END AS open,
                                CASE WHEN volume % 13 = 0 THEN -volume ELSE volume END AS volume) FROM user_bars"""

ORACLE: dict[str, str] = {
    "stage_bars": _q(
        [*BARS, "daily"],
        """SELECT ts, symbol, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low,
                  CAST(close AS DOUBLE) AS close, volume, 'alpha_vantage' AS source
           FROM staged WHERE NOT bad""",
        staged=STAGED,
    ),
    "stage_bars_as_delivered": _q(
        [*BARS, "daily"],
        """SELECT ts, ' ' || lower(symbol) || ' ' AS symbol, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
                  CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, volume, CAST(NULL AS VARCHAR) AS source
           FROM staged WHERE NOT bad""",
        staged=STAGED,
    ),
    "bars_without_source": _q(["user_bars"], f"SELECT {BAR_OUT.replace('source', repr('unknown') + ' AS source')} FROM user_bars"),
    "snapshot_stamp": _q(
        ["user_bars"],
        "SELECT symbol, ts AS event_ts, 'user_bars' AS snapshot_id, true AS stamped FROM user_bars ORDER BY symbol, event_ts",
    ),
    "land_payloads": _q(
        ["user_bars"],
        f"""SELECT DATE '2024-01-20' AS run_date, {BAR_OUT} FROM user_bars WHERE ts <= TIMESTAMP '2024-01-20'
            UNION ALL
            SELECT DATE '2024-02-01', {BAR_OUT.replace("CAST(close AS DOUBLE)", "CAST(close + 1 AS DOUBLE)")} FROM user_bars""",
    ),
    "land_objects": _q(
        ["user_bars"],
        """SELECT 'raw/alpha_vantage/symbol=' || symbol || '/date=2024-02-01' AS object_prefix, symbol, count(*) AS bars,
                  CAST(sum(volume) AS BIGINT) AS volume
           FROM user_bars GROUP BY symbol""",
    ),
    "backfill_rows_zoned": _q(
        BACKFILL,
        f"""SELECT {BAR_OUT} FROM delivered d
            WHERE EXISTS (SELECT 1 FROM pending p WHERE p.source = d.source AND p.symbol = d.symbol
                                                    AND p.trading_date = CAST(d.ts - INTERVAL 5 HOUR AS DATE))""",
    ),
    "staging_rejects": _q(
        [*BARS, "daily"],
        """SELECT symbol, strftime(day, '%Y-%m-%d') AS raw_date, zone, 'bad price' AS reject_reason
           FROM staged WHERE bad""",
        staged=STAGED,
    ),
    "schema_gaps": _q(
        BARS,
        """SELECT symbol, ts,
                  concat_ws(', ', CASE WHEN volume % 11 = 0 THEN 'open' END, CASE WHEN volume % 13 = 0 THEN 'ts' END,
                            CASE WHEN volume % 7 = 0 THEN 'volume' END) AS missing
           FROM bars WHERE volume % 7 = 0 OR volume % 11 = 0 OR volume % 13 = 0""",
    ),
    "payload_gaps": _q(
        [*BARS, "daily"],
        """SELECT symbol, strftime(day, '%Y-%m-%d') AS raw_date,
                  concat_ws(', ', CASE WHEN volume % 11 = 0 THEN '1. open' END, CASE WHEN volume % 7 = 0 THEN '5. volume' END)
                    AS missing
           FROM daily WHERE volume % 7 = 0 OR volume % 11 = 0""",
    ),
    "raw_object_keys": _q(
        [*BARS, "daily"],
        """SELECT 'raw/' || source || '/symbol=' || symbol || '/date=' || strftime(day, '%Y-%m-%d')
                  || '/stock.json' AS object_key
           FROM daily WHERE volume % 50 <> 0""",
    ),
    "export_bars": _q(
        BARS,
        f"""SELECT event_ts, symbol, open, high, low, close, volume, source, 'market_bars' AS snapshot_id
            FROM (SELECT {BAR_OUT.replace("ts, symbol", "ts AS event_ts, symbol", 1)} FROM bars)
            ORDER BY symbol, event_ts""",
    ),
    "export_symbol": _q(BARS, f"SELECT {BAR_OUT} FROM bars WHERE symbol = 'PURCHASE' ORDER BY symbol, ts"),
    "upsert_bars": _q(
        ["shipment_rows", "shipment_bars"],
        f"""SELECT {BAR_OUT} FROM stored s
            WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.ts = s.ts AND i.symbol = s.symbol)
            UNION ALL
            SELECT ts, symbol, CAST(price AS DOUBLE), CAST(price AS DOUBLE), CAST(price AS DOUBLE),
                   CAST(price AS DOUBLE), volume, source FROM incoming""",
        stored="SELECT * FROM shipment_bars WHERE ts < TIMESTAMP '1999-01-01'",
        incoming="""
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ts, symbol ORDER BY l_orderkey DESC,
                                     l_linenumber DESC, price DESC, volume DESC) AS rn
                           FROM shipment_rows WHERE ts >= TIMESTAMP '1998-07-01') WHERE rn = 1""",
    ),
    "insert_if_absent": _q(
        STORED,
        f"""SELECT {BAR_OUT} FROM existing
            UNION ALL
            SELECT {BAR_OUT.replace("CAST(close AS DOUBLE)", "CAST(close + 1 AS DOUBLE)")} FROM delivered d
            WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.ts = d.ts AND e.symbol = d.symbol)""",
    ),
    "upsert_daily_summary": _q(
        STORED,
        """SELECT coalesce(f.symbol, s.symbol) AS symbol, coalesce(f.trading_date, s.trading_date) AS trading_date,
                  CASE WHEN f.symbol IS NULL THEN s.avg_close ELSE f.avg_close END AS avg_close,
                  CASE WHEN f.symbol IS NULL THEN s.min_close ELSE f.min_close END AS min_close,
                  CASE WHEN f.symbol IS NULL THEN s.max_close ELSE f.max_close END AS max_close,
                  CASE WHEN f.symbol IS NULL THEN s.total_volume ELSE f.total_volume END AS total_volume,
                  CASE WHEN s.symbol IS NULL THEN TIMESTAMP '2024-02-01 12:00:00'
                       ELSE TIMESTAMP '2020-01-01 00:00:00' END AS created_at
           FROM stored s FULL JOIN fresh f ON s.symbol = f.symbol AND s.trading_date = f.trading_date""",
        stored=_summary("existing"),
        fresh=_summary("delivered"),
    ),
    "upsert_latest_price": _q(
        STORED,
        """SELECT coalesce(f.symbol, s.symbol) AS symbol,
                  CASE WHEN f.symbol IS NULL THEN s.latest_ts ELSE f.latest_ts END AS latest_ts,
                  CASE WHEN f.symbol IS NULL THEN s.close_price ELSE f.close_price END AS close_price,
                  CASE WHEN f.symbol IS NULL THEN s.volume ELSE f.volume END AS volume,
                  CASE WHEN f.symbol IS NULL THEN TIMESTAMP '2020-01-01 00:00:00'
                       ELSE TIMESTAMP '2024-02-01 12:00:00' END AS updated_at
           FROM stored s FULL JOIN fresh f ON s.symbol = f.symbol AND f.latest_ts >= s.latest_ts
           WHERE s.symbol IS NOT NULL OR NOT EXISTS (SELECT 1 FROM stored x WHERE x.symbol = f.symbol)""",
        stored=_latest("existing"),
        fresh=_latest("delivered"),
    ),
    "backfill_column_default": """
        SELECT o_orderkey,
               coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 DAY END,
                        CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END,
                        TIMESTAMP '2024-02-01 12:00:00') AS updated_at
        FROM orders""",
    "incremental_filter": _q([*STATE, "loaded"], f"SELECT {BAR_OUT} FROM loaded"),
    "late_rows": _q(
        STATE,
        """SELECT d.source, d.symbol, d.ts, CAST(d.close AS DOUBLE) AS close, d.volume, s.last_watermark
           FROM delivered d JOIN state s ON d.source = s.source AND d.symbol = s.symbol
           WHERE d.ts <= s.last_watermark
             AND NOT EXISTS (SELECT 1 FROM existing e WHERE e.ts = d.ts AND e.symbol = d.symbol)""",
    ),
    "advance_watermark": _q([*STATE, "loaded"], ADVANCED, marks=MARKS.format("loaded")),
    "load_state_listing": _q(STATE, "SELECT * FROM state ORDER BY updated_at DESC NULLS FIRST, source, symbol"),
    "load_audit": _q(
        [*STATE, "loaded"],
        """SELECT md5('load-1|' || source || '|' || symbol) AS id, source, DATE '2024-02-01' AS load_date,
                  '2024-02-01' AS version, row_count AS record_count, TIMESTAMP '2024-02-01' AS recorded_at
           FROM marks""",
        marks=MARKS.format("loaded"),
    ),
    "backfill_plan": _q(BACKFILL, "SELECT * FROM pending"),
    "backfill_gaps": _q(BACKFILL, INTERVALS.format(of="pending")),
    "progress_intervals": _q(
        STORED,
        INTERVALS.format(of="recorded"),
        recorded="SELECT DISTINCT source, symbol, CAST(ts AS DATE) AS trading_date FROM delivered WHERE ts < TIMESTAMP '1999-09-01'",
    ),
    "backfill_rows": _q([*BACKFILL, "for_pending"], f"SELECT {BAR_OUT} FROM for_pending"),
    "backfill_progress": _q(
        [*BACKFILL, "for_pending"],
        """SELECT source, symbol, trading_date FROM done
           UNION
           SELECT source, symbol, CAST(ts AS DATE) FROM for_pending""",
    ),
    "backfill_watermark": _q(
        [*STATE, "done", "pending", "for_pending"], ADVANCED, marks=MARKS.format("for_pending")
    ),
    "mart_daily_summary": _q(BARS, _summary("bars")),
    "mart_latest_price": _q(BARS, _latest("bars")),
    "mart_volume_rank": _q(BARS, RANKS, summary=_summary("bars")),
    "bars_row_number": _q(
        BARS,
        """SELECT symbol, ts, CAST(close AS DOUBLE) AS close,
                  row_number() OVER (PARTITION BY symbol ORDER BY ts DESC NULLS FIRST) AS row_num FROM bars""",
    ),
    "price_changes": _q(BARS, CHANGES),
    "recent_price_changes": _q(
        BARS,
        """SELECT * FROM (SELECT * FROM changes WHERE symbol = 'S7' ORDER BY trading_date DESC, ts DESC LIMIT 30)
           ORDER BY trading_date, ts""",
        changes=CHANGES,
    ),
    "volume_leaders": _q(
        BARS,
        """SELECT trading_date, symbol, total_volume, volume_rank FROM ranks
           ORDER BY trading_date DESC, volume_rank, symbol LIMIT 20""",
        summary=_summary("bars"),
        ranks=RANKS,
    ),
    "latest_price_listing": _q(
        BARS, "SELECT * FROM latest ORDER BY latest_ts DESC NULLS FIRST, symbol", latest=_latest("bars")
    ),
    "recent_latest_prices": _q(
        BARS, "SELECT * FROM latest ORDER BY latest_ts DESC NULLS FIRST, symbol LIMIT 10", latest=_latest("bars")
    ),
    "daily_close_range": _q(
        BARS,
        """SELECT trading_date, symbol, avg_close, min_close, max_close,
                  CAST(CAST(max_close AS DECIMAL(16,4)) - CAST(min_close AS DECIMAL(16,4)) AS DOUBLE) AS close_range,
                  total_volume
           FROM summary ORDER BY trading_date DESC, symbol LIMIT 20""",
        summary=_summary("bars"),
    ),
    "symbol_coverage": _q(
        BARS,
        """SELECT symbol, count(*) AS row_count, min(ts) AS first_ts, max(ts) AS latest_ts
           FROM bars GROUP BY symbol ORDER BY symbol""",
    ),
    "serve_latest_price": _q(
        BARS,
        """SELECT symbol, latest_ts, close_price, volume, 'database' AS source FROM latest
           ORDER BY latest_ts DESC NULLS FIRST, symbol LIMIT 1""",
        latest=_latest("bars"),
    ),
    "recent_loads": _q(
        BARS,
        """SELECT md5(strftime(load_date, '%Y-%m-%d') || '|' || source || '|' || symbol) AS id, source, load_date,
                  strftime(load_date, '%Y-%m-%d') AS version, record_count,
                  CAST(load_date AS TIMESTAMP) AS recorded_at
           FROM loads ORDER BY recorded_at DESC, id LIMIT 10""",
        loads="""SELECT source, symbol, CAST(ts AS DATE) AS load_date, CAST(count(*) AS BIGINT) AS record_count
                 FROM bars GROUP BY 1, 2, 3""",
    ),
    "quality_checks": _q(
        BARS,
        f"""SELECT 1 AS seq, 'stock_rows_count' AS metric, count(*) AS value FROM bars
            {NULL_COUNTS}
            UNION ALL SELECT 9, 'negative_price_count',
                             count(*) FILTER (open < 0 OR high < 0 OR low < 0 OR close < 0) FROM bars
            UNION ALL SELECT 10, 'negative_volume_count', count(*) FILTER (volume < 0) FROM bars
            UNION ALL SELECT 11, 'duplicate_stock_key_groups', count(*)
            FROM (SELECT symbol, ts FROM bars GROUP BY symbol, ts HAVING count(*) > 1)""",
    ),
    "quality_gate": _q(BARS, GATE.format(of="bars", close="close")),
    "gate_failures": _q(
        ["shipment_rows"],
        """SELECT bool_and(passed) AS passed, CAST(count(*) FILTER (NOT passed) AS INTEGER) AS failed_checks,
                  coalesce(string_agg(check_name || ' on ' || table_name || ': ' || details, '; ' ORDER BY seq)
                             FILTER (NOT passed), '') AS message
           FROM gate""",
        gate=GATE.format(of="shipment_rows", close="price"),
    ),
    "gate_raises": _q(
        BARS,
        """SELECT checked, CAST(CASE WHEN bool_and(passed) THEN count(*) END AS INTEGER) AS checks,
                  string_agg(check_name || ' on ' || table_name || ': ' || details, '; ' ORDER BY seq) FILTER (NOT passed) AS message
           FROM (SELECT 'bars' AS checked, * FROM gate_bars UNION ALL SELECT 'shipments', * FROM gate_rows)
           GROUP BY checked""",
        gate_bars=GATE.format(of="bars", close="close"),
        gate_rows=GATE.format(of="shipment_rows", close="price"),
    ),
    "dq_not_null": """
        SELECT 'not_null' AS check_name, 'documents' AS table_name, n = 0 AS passed, n AS failed_rows,
               'Column quality has ' || n || ' NULL row(s).' AS details
        FROM (SELECT count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL)""",
    "dq_unique": _q(
        ["shipment_rows"],
        """SELECT 'unique' AS check_name, 'shipments' AS table_name, n = 0 AS passed, n AS failed_rows,
                  'Column symbol, ts has ' || n || ' duplicated value group(s).' AS details
           FROM (SELECT count(*) AS n
                 FROM (SELECT symbol, ts FROM shipment_rows GROUP BY symbol, ts HAVING count(*) > 1))""",
    ),
    "dq_range": _q(
        BARS,
        """SELECT 'range' AS check_name, 'market_bars' AS table_name, n = 0 AS passed, n AS failed_rows,
                  'Column close has ' || n || ' row(s) outside range min=10, max=60000.' AS details
           FROM (SELECT count(*) AS n FROM bars WHERE close < 10 OR close > 60000)""",
    ),
    "dq_foreign_key": """
        SELECT 'foreign_key' AS check_name, 'orders' AS table_name, n = 0 AS passed, n AS failed_rows,
               'orders.o_custkey has ' || n || ' row(s) missing from customer.c_custkey.' AS details
        FROM (SELECT count(*) AS n
              FROM (SELECT CASE WHEN o_orderkey % 97 = 0 THEN -1 - o_custkey ELSE o_custkey END AS o_custkey FROM orders) o
              LEFT JOIN customer c ON o.o_custkey = c.c_custkey
              WHERE o.o_custkey IS NOT NULL AND c.c_custkey IS NULL)""",
    "dq_freshness": _q(
        ["event_bars"],
        FRESHNESS.format(table="events", column="ts", of="event_bars")
        + "\nUNION ALL\n"
        + FRESHNESS.format(table="orders", column="o_orderdate", of="orders"),
    ),
    "step_metrics": _q(
        ["steps"],
        """SELECT run_id, step_name, status, started_at, finished_at, row_count, error_message,
                  round((epoch_us(finished_at) - epoch_us(started_at)) / 1e6, 6) AS duration_seconds
           FROM steps""",
    ),
    "step_json": _q(
        ["steps"],
        """SELECT run_id,
                  '{"duration_seconds":'
                  || coalesce(CAST(round((epoch_us(finished_at) - epoch_us(started_at)) / 1e6, 6) AS VARCHAR), 'null')
                  || ',"error_message":' || coalesce('"' || error_message || '"', 'null')
                  || ',"finished_at":'
                  || coalesce('"' || strftime(finished_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"', 'null')
                  || ',"row_count":' || row_count
                  || ',"started_at":"' || strftime(started_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"'
                  || ',"status":"' || status || '","step_name":"' || step_name || '"}' AS json
           FROM steps""",
    ),
    "sla_report": _q(
        ["steps"],
        """SELECT user_id, data_freshness_minutes, pipeline_latency_seconds, failure_rate,
                  concat_ws(',',
                    CASE WHEN data_freshness_minutes IS NULL THEN 'freshness_missing'
                         WHEN data_freshness_minutes > 1440 THEN 'freshness_sla_breached' END,
                    CASE WHEN pipeline_latency_seconds IS NULL THEN 'latency_missing'
                         WHEN pipeline_latency_seconds > 300.0 THEN 'latency_sla_breached' END,
                    CASE WHEN failure_rate > 0.05 THEN 'failure_rate_sla_breached' END) AS violations,
                  coalesce(data_freshness_minutes <= 1440 AND pipeline_latency_seconds <= 300.0
                           AND failure_rate <= 0.05, false) AS passed
           FROM measured""",
        facts="""
            SELECT user_id, max(started_at) FILTER (step_name = 'purchase') AS latest_data_at,
                   min(started_at) AS started_at,
                   CASE WHEN count(*) FILTER (step_name = 'signup' AND row_count > 95) = 0
                        THEN max(finished_at) END AS finished_at,
                   count(*) FILTER (status = 'failed') AS failed, count(*) AS total
            FROM steps GROUP BY user_id""",
        measured="""
            SELECT user_id,
                   round((epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(latest_data_at)) / 1e6 / 60.0, 6)
                     AS data_freshness_minutes,
                   round((epoch_us(finished_at) - epoch_us(started_at)) / 1e6, 6) AS pipeline_latency_seconds,
                   round(failed / total, 6) AS failure_rate
            FROM facts""",
    ),
    "sla_json": _q(
        ["steps"],
        """SELECT user_id,
                  '{"data_freshness_minutes":' || CAST(freshness AS VARCHAR)
                  || ',"failure_rate":' || CAST(rate AS VARCHAR)
                  || ',"passed":' || CASE WHEN codes = '' THEN 'true' ELSE 'false' END
                  || ',"pipeline_latency_seconds":' || coalesce(CAST(latency AS VARCHAR), 'null')
                  || ',"violations":[' || codes || ']}' AS json
           FROM (SELECT *, concat_ws(',', CASE WHEN freshness > 1440 THEN '"freshness_sla_breached"' END,
                                     CASE WHEN latency IS NULL THEN '"latency_missing"'
                                          WHEN latency > 300.0 THEN '"latency_sla_breached"' END,
                                     CASE WHEN rate > 0.05 THEN '"failure_rate_sla_breached"' END) AS codes
                 FROM measured)""",
        measured="""
            SELECT user_id,
                   round((epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(max(started_at))) / 1e6 / 60.0, 6)
                     AS freshness,
                   round((epoch_us(max(finished_at)) - epoch_us(min(started_at))) / 1e6, 6) AS latency,
                   round(count(*) FILTER (status = 'failed') / count(*), 6) AS rate
            FROM steps GROUP BY user_id""",
    ),
    "failure_rates": _q(
        ["steps"],
        """SELECT user_id, count(*) FILTER (status = 'failed') AS failed_runs, count(*) AS total_runs,
                  round(count(*) FILTER (status = 'failed') / count(*), 6) AS failure_rate
           FROM steps GROUP BY user_id""",
    ),
    "classify_failures": """
        SELECT event_id, ' ' || upper(name) || ' ' AS error_type, status_code,
               CASE WHEN name IN ('timeout', 'rate_limit', 'connection', 'temporary', 'server_error')
                      THEN 'retryable'
                    WHEN name IN ('schema', 'validation', 'auth', 'not_found', 'bad_request')
                      THEN 'non_retryable'
                    ELSE 'unknown' END AS failure_class,
               status_code IN (429, 500, 502, 503, 504) AS status_retryable
        FROM (SELECT event_id,
                     ['timeout', 'rate_limit', 'connection', 'temporary', 'server_error', 'schema', 'validation',
                      'auth', 'not_found', 'bad_request', 'unexpected'][event_id % 11 + 1] AS name,
                     CAST([200, 404, 429, 500, 502, 503, 504][user_id % 7 + 1] AS INTEGER) AS status_code
              FROM events)""",
    "incremental_load_job": _q(JOB, f"SELECT {BAR_OUT} FROM twice_loaded"),
    "backfill_job": _q(
        ["user_bars"],
        """SELECT source, symbol, CAST(ts AS DATE) AS trading_date FROM user_bars
           WHERE ts BETWEEN TIMESTAMP '2024-01-15' AND TIMESTAMP '2024-01-25'""",
    ),
    "mart_refresh_job": _q(
        JOB, "SELECT * FROM summary JOIN ranks USING (symbol, trading_date)",
        summary=_summary("twice_loaded"),
        ranks="SELECT symbol, trading_date, volume_rank FROM (" + RANKS + ")",
    ),
    "load_state_job": _q(
        JOB,
        """SELECT source, symbol, max(ts) AS last_watermark,
                  CASE WHEN max(ts) > any_value(mark) OR any_value(mark) IS NULL THEN count(*) FILTER (mark IS NULL OR ts > mark)
                       ELSE count(*) END AS last_row_count,
                  'success' AS status, TIMESTAMP '2024-02-01 12:00:00' AS updated_at
           FROM user_bars LEFT JOIN first_marks USING (symbol) GROUP BY source, symbol
           ORDER BY updated_at DESC NULLS FIRST, source, symbol""",
    ),
    "load_audit_job": _q(
        JOB,
        """SELECT source, DATE '2024-02-01' AS load_date, '2024-02-01' AS version, count(*) AS record_count,
                  TIMESTAMP '2024-02-01' AS recorded_at
           FROM user_bars LEFT JOIN first_marks USING (symbol) GROUP BY source, symbol, coalesce(ts <= mark, false)""",
    ),
    "latest_price_job": _q(
        JOB,
        f"""SELECT *, TIMESTAMP '2024-02-01 12:00:00' AS updated_at FROM ({_latest("twice_loaded")})
            ORDER BY latest_ts DESC NULLS FIRST, symbol""",
    ),
    "coverage_job": _q(
        ["user_bars"],
        """SELECT symbol, count(*) AS row_count, min(ts) AS first_ts, max(ts) AS latest_ts FROM user_bars
           GROUP BY symbol ORDER BY symbol""",
    ),
    "backfill_bars_job": _q(
        JOB,
        f"""SELECT {BAR_OUT} FROM twice_loaded
            WHERE ts <= TIMESTAMP '2024-01-20' OR ts BETWEEN TIMESTAMP '2024-01-15' AND TIMESTAMP '2024-01-25'""",
    ),
    "interrupted_load_job": _q(
        JOB,
        f"""SELECT {BAR_OUT}, 'died' AS phase FROM user_bars WHERE ts <= TIMESTAMP '2024-01-20'
            UNION ALL
            SELECT {BAR_OUT}, 'done again' FROM twice_loaded""",
    ),
    "gated_run_job": _q(
        ["user_bars"],
        """SELECT 1 AS run, 'run_stock_pipeline' AS step_name, 'success' AS status, count(*) AS row_count,
                  CAST(NULL AS VARCHAR) AS error_message FROM user_bars
           UNION ALL SELECT 1, 'run_quality_checks', 'success', 6, NULL
           UNION ALL SELECT 1, 'build_marts', 'success', count(DISTINCT ts), NULL FROM user_bars
           UNION ALL SELECT 2, 'run_stock_pipeline', 'success', 0, NULL
           UNION ALL
           SELECT 2, 'run_quality_checks', 'failed', NULL, 'freshness on market_bars: ' || details
           FROM (SELECT * FROM gate WHERE check_name = 'freshness')""",
        gate=GATE.format(of="user_bars", close="close").replace("2024-02-05", "2025-02-04"),
    ),
    "delete_bars": _q(
        ["user_bars"],
        f"""SELECT {BAR_OUT} FROM user_bars u
            WHERE CAST(ts AS DATE) <> DATE '2024-01-10'
              AND NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = 'error' AND 'U' || e.user_id = u.symbol
                              AND date_trunc('day', e.ts) = u.ts)""",
    ),
    "day_profile_job": _q(
        ["user_bars"],
        """SELECT CAST(ts AS DATE) AS trading_date, count(*) AS row_count, count(*) FILTER (ts IS NULL) AS null_ts,
                  count(*) FILTER (symbol IS NULL) AS null_symbol, count(*) FILTER (open IS NULL) AS null_open,
                  count(*) FILTER (high IS NULL) AS null_high, count(*) FILTER (low IS NULL) AS null_low,
                  count(*) FILTER (close IS NULL) AS null_close, count(*) FILTER (volume IS NULL) AS null_volume,
                  count(*) FILTER (source IS NULL) AS null_source, min(volume) AS least_volume, max(volume) AS greatest_volume
           FROM bars GROUP BY 1""",
        bars=DAMAGED,
    ),
    "stored_audit_job": _q(
        ["user_bars"],
        f"""SELECT 1 AS seq, 'stock_rows_count' AS metric, count(*) AS value FROM bars
            {NULL_COUNTS}
            UNION ALL SELECT 9, 'negative_price_count',
                             count(*) FILTER (open < 0 OR high < 0 OR low < 0 OR close < 0) FROM bars
            UNION ALL SELECT 10, 'negative_volume_count', count(*) FILTER (volume < 0) FROM bars
            UNION ALL SELECT 11, 'duplicate_stock_key_groups', count(*)
            FROM (SELECT symbol, ts FROM bars GROUP BY symbol, ts HAVING count(*) > 1)""",
        bars=DAMAGED,
    ),
    "stored_freshness_job": _q(
        ["user_bars"],
        """SELECT * EXCLUDE (seq) FROM gate WHERE check_name = 'freshness'
           UNION ALL SELECT * EXCLUDE (seq) FROM year_later WHERE check_name = 'freshness'""",
        gate=GATE.format(of="user_bars", close="close"),
        year_later=GATE.format(of="user_bars", close="close").replace("2024-02-05", "2025-02-04"),
    ),
    "stream_load_job": _q(JOB, f"SELECT {BAR_OUT}, files_per_batch FROM twice_loaded, (VALUES (0), (2)) AS n(files_per_batch)"),
}
