"""SQL for DuckDB, written from each operator's definition on the same tables.

Averages and shares use whole-number division, which rounds half up without a second rounding.
"""

from tickwright.schemas import BANDS, FEATURES

_DAY = "strftime(order_date, '%Y-%m-%d') AS order_date"

_TICKS = """
ticks AS (
  SELECT event_type AS order_code, CAST(ts AS DATE) AS order_date, event_id AS tran_id,
         strftime(ts, '%H:%M:%S.%f') AS order_time, CAST(user_id AS VARCHAR) AS order_dc,
         CAST(value AS DECIMAL(10,2)) AS price, ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume
  FROM events)"""

_COARSE = """
coarse AS (
  SELECT * REPLACE (CAST(floor(price / 10) * 10 AS DECIMAL(10,2)) AS price) FROM ticks)"""

_LEVELS = """
levels AS (
  SELECT order_code, order_date, price, CAST(price * 100 AS BIGINT) AS c,
         CAST(SUM(volume) AS BIGINT) AS v, CAST(SUM(CAST(price * 100 AS BIGINT) * volume) AS HUGEINT) AS a
  FROM {source} GROUP BY ALL)"""

_EVENT_LEVELS = _LEVELS.format(source="ticks")

_LINES = """
lines AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS order_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS order_date,
         CAST((2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
              // (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(12,2)) / 100 AS price,
         CAST(l_quantity AS BIGINT) AS volume
  FROM lineitem)"""

_LINE_LEVELS = _LEVELS.format(source="lines")

_EDGES = """
edges AS (
  SELECT order_code, order_date, arg_min(price, (order_time, tran_id)) AS open_price,
         arg_max(price, (order_time, tran_id)) AS close_price
  FROM {source} WHERE tran_id IS NOT NULL GROUP BY ALL)"""

_EVENT_EDGES = _EDGES.format(source="ticks")

# Days with both sides of the opening price; o and e are the opening and closing price in hundredths.
_SUMS = """
opened AS (
  SELECT l.*, coalesce(CAST(open_price * 100 AS BIGINT), 0) AS o, {close} AS e
  FROM levels l LEFT JOIN edges USING (order_code, order_date)),
sums AS (
  SELECT order_code, order_date, o, e, SUM(v) AS v, SUM(a) AS a,
         SUM(CASE WHEN c > o THEN v ELSE 0 END) AS uv, SUM(CASE WHEN c > o THEN a ELSE 0 END) AS ua,
         SUM(CASE WHEN c < o THEN v ELSE 0 END) AS dv, SUM(CASE WHEN c < o THEN a ELSE 0 END) AS da,
         MIN(c) AS lo, MAX(c) AS hi
  FROM opened GROUP BY ALL)"""

_EVENT_SUMS = _SUMS.format(close="CAST(close_price * 100 AS BIGINT)")


def _money(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE) / 100"


def _ratio(num: str, den: str, digits: int, unit: str = "1") -> str:
    """Half-up quotient of whole numbers as a double with ``digits`` decimals, 0 where den is 0."""
    steps = f"(2 * CAST({num} AS HUGEINT) * {10**digits} + {den}) // (2 * {den})"
    return f"CASE WHEN {den} = 0 THEN 0.0 ELSE CAST({steps} AS DOUBLE) / 1e{digits} / {unit} END"


def _vwap(money: str, volume: str) -> str:
    return _ratio(money, f"({volume} * 100)", 2)


_MEANS = """
means AS (
  SELECT order_code, order_date, CAST(price AS DOUBLE) AS p, v,
         SUM(v) OVER d AS n, SUM(c * v) OVER d AS s, greatest(v, 0) AS t, c
  FROM levels WINDOW d AS (PARTITION BY order_code, order_date)),
apart AS (
  SELECT *, p - CAST((2 * s * 1000000 + n) // (2 * n) AS DOUBLE) / 1e8 AS d8 FROM means),
powers AS (
  SELECT order_code, order_date, n, SUM(t) AS tn, SUM(v * d8 * d8) AS c2, SUM(v * d8 * d8 * d8) AS c3,
         SUM(v * d8 * d8 * d8 * d8) AS c4,
         CAST(SUM(t) * SUM(CAST(c AS HUGEINT) * c * t) - SUM(c * t) * SUM(c * t) AS HUGEINT) AS t2
  FROM apart GROUP BY order_code, order_date, n HAVING SUM(t) > 0),
settled AS (
  SELECT *, CAST((2 * t2 * 1000000 + tn * tn) // (2 * tn * tn) AS HUGEINT) * 10000000000 AS square FROM powers),
nearly AS (
  SELECT *, CASE WHEN square = 0 THEN 0
       ELSE (CAST(floor(sqrt(CAST(square AS DOUBLE))) AS HUGEINT) + square // CAST(floor(sqrt(CAST(square AS DOUBLE))) AS HUGEINT)) // 2
       END AS near
  FROM settled),
stepped AS (SELECT *, CASE WHEN near * near > square THEN near - 1 ELSE near END AS low FROM nearly),
rooted AS (
  SELECT *, CASE WHEN square > 0 AND 2 * square >= 2 * low * low + low THEN low + 1 ELSE low END AS steps,
       CASE WHEN n > 1 THEN floor(sqrt(greatest(round(c2 / (n - 1), 8), 0)) * 1e8 + 0.75) / 1e8 END AS sd
  FROM stepped),
moments AS (
  SELECT order_code, order_date,
         CAST(steps AS DOUBLE) / 1e10 AS price_std,
         CASE WHEN n < 3 OR sd = 0 THEN 0.0
              ELSE round(round(c3 / n, 8) / (sd * sd * sd), 8)
                   * round(CAST(n AS DOUBLE) / ((CAST(n AS DOUBLE) - 1) * (CAST(n AS DOUBLE) - 2)), 8)
         END AS price_skewness,
         CASE WHEN sd IS NULL OR sd = 0 THEN 0.0
              ELSE round(round(c4 / n, 8) / (sd * sd * sd * sd), 8) - 3 END AS price_kurtosis
  FROM rooted)"""

# Band 0 holds the lowest prices. Limits are lo and hi in hundredths.
_BANDS_CTE = """
placed AS (
  SELECT *, CASE WHEN hi > lo AND c BETWEEN lo AND hi THEN least(9, (c - lo) * 10 // (hi - lo)) END AS band
  FROM limited),
banded AS (
  SELECT order_code, order_date, SUM(v) AS n, """ + ", ".join(
    f"SUM(CASE WHEN band = {i} THEN v ELSE 0 END) AS b{i}" for i in range(10)
) + """
  FROM placed GROUP BY ALL)"""

_EVENT_LIMITS = "limited AS (SELECT *, 100 AS lo, 10100 AS hi FROM levels)"

_BAND_RATIOS = {name: _ratio(f"b{i}", "n", 6) for i, name in enumerate(BANDS)}


def _with(*parts: str) -> str:
    return "WITH " + ",".join(part.strip("\n") for part in parts) + "\n"


_TICK_COLUMNS = f"order_code, {_DAY}, tran_id, order_time, order_dc, CAST(price AS DOUBLE) AS price, volume"

_UPDOWN = f"""
SELECT order_code, {_DAY}, {_money('o')} AS start_price, {_money('e')} AS end_price,
       CAST(NULL AS DOUBLE) AS next_price, {_vwap('a', 'v')} AS avg_price, CAST(v AS BIGINT) AS volume,
       CAST(0 AS BIGINT) AS all_volume, CAST(NULL AS DOUBLE) AS volume_proportion,
       CAST(uv AS BIGINT) AS up_volume, {_money('ua')} AS up_sum,
       CAST(dv AS BIGINT) AS down_volume, {_money('da')} AS down_sum,
       CASE WHEN ua > da THEN 'up' WHEN ua = da THEN 'balance' ELSE 'down' END AS up_down,
       CAST(NULL AS DOUBLE) AS up_down_proportion, {_vwap('ua', 'uv')} AS up_price,
       {_vwap('da', 'dv')} AS down_price,
       {_ratio("CAST(round((" + _vwap('a', 'v') + ") * 100) AS BIGINT)", 'lo', 2)} AS price_tendency,
       CAST(0 AS BIGINT) AS score, CAST(NULL AS VARCHAR) AS value1
FROM sums WHERE lo <> 0"""

_FEATURES = _with(_TICKS, _EVENT_LEVELS, _EVENT_EDGES, _EVENT_SUMS, _MEANS, _EVENT_LIMITS, _BANDS_CTE) + f"""
SELECT order_code || '.EV' AS ticket_code, strftime(order_date, '%Y-%m-%d') AS trade_date,
       order_code || '.EV_' || strftime(order_date, '%Y-%m-%d') AS ticket_dc,
       {_money('o')} AS price_start, {_money('e')} AS price_end, {_vwap('a', 'v')} AS price_mean,
       {_vwap('ua', 'uv')} AS price_mean_up, {_vwap('da', 'dv')} AS price_mean_down,
       0.0::DOUBLE AS price_open30_mean, 0.0::DOUBLE AS price_median, price_std,
       {_money('hi')} AS price_max, {_money('lo')} AS price_min, {_money('hi - lo')} AS price_range,
       price_skewness, price_kurtosis, CAST(v AS BIGINT) AS volume_total, CAST(uv AS BIGINT) AS volume_up,
       CAST(dv AS BIGINT) AS volume_down, CAST(0 AS BIGINT) AS volume_open30min,
       {{bands}}
FROM sums JOIN moments USING (order_code, order_date) JOIN banded USING (order_code, order_date)"""

_DAY_FEATURES = _FEATURES.format(bands=", ".join(f"{r} AS {b}" for b, r in _BAND_RATIOS.items()))

# The order in which the existing feature table was filled: d5 to u5 into u1..u5, d1..d5.
_FILLED = [f"volume_{side}{i}_bucket" for side in "ud" for i in range(1, 6)]
_TABLE_ORDER = _FEATURES.format(
    bands=", ".join(f"{_BAND_RATIOS[b]} AS {column}" for column, b in zip(_FILLED, BANDS))
)


def _changes(source: str = "coarse") -> str:
    return f"""
changed AS (
  SELECT * FROM (
    SELECT *, lag(price) OVER (PARTITION BY order_code, order_date ORDER BY order_time, tran_id) AS prev
    FROM {source})
  WHERE prev IS NULL OR prev <> price)"""


_CHANGE_COLUMNS = f"""SELECT order_code, {_DAY}, order_time, order_dc, CAST(price AS DOUBLE) AS price, volume,
       CAST(CAST(price * 100 AS BIGINT) * volume AS DOUBLE) / 100 AS sum FROM changed"""

_PRICE_CHANGES = _with(_TICKS, _COARSE, _changes()) + _CHANGE_COLUMNS

_LINES_OF_CHANGES = _with(_TICKS, _COARSE, _changes()) + """
SELECT concat_ws(chr(9), order_code, strftime(order_date, '%Y-%m-%d'), order_time, order_dc,
       CAST(price AS VARCHAR), CAST(volume AS VARCHAR), CAST(CAST(price * volume AS DECIMAL(28,2)) AS VARCHAR)) AS value
FROM changed"""

_RUN = """
SELECT order_code, strftime(order_date, '%Y-%m-%d') AS order_date, MAX(order_time) AS order_time,
       arg_max(order_dc, (order_time, tran_id)) AS order_dc,
       CAST(arg_max(price, (order_time, tran_id)) AS DOUBLE) AS price, CAST(SUM(volume) AS BIGINT) AS volume,
       CAST(SUM(CAST(price * 100 AS BIGINT) * volume) AS DOUBLE) / 100 AS sum
FROM ticks {where} GROUP BY order_code, ticks.order_date"""

_RUN_ROWS = _with(_TICKS) + _RUN.format(where="")

_BARS = """
bars AS (
  SELECT MIN(tran_id) AS id, order_code AS code, order_date AS date,
         CAST(arg_min(price, (order_time, tran_id)) AS DOUBLE) AS start,
         CAST(arg_max(price, (order_time, tran_id)) AS DOUBLE) AS "end"
  FROM ticks GROUP BY ALL),
carried AS (
  SELECT *, coalesce(lag("end") OVER (PARTITION BY code ORDER BY date, id), start) AS new_start FROM bars)"""

_BAR_COLUMNS = """SELECT id, code, strftime(date, '%Y-%m-%d') AS date, {start} AS start, "end" FROM carried"""


def _written_features() -> str:
    kinds = {f.name: f.dataType.simpleString() for f in FEATURES.fields}

    def written(name: str) -> str:
        kind = kinds[name]
        if kind == "bigint":
            return f"CAST({name} AS VARCHAR) AS {name}"
        if kind in ("string", "date"):
            return name
        places = 8 if kind == "double" else 2
        # Half up on the shortest decimal form; a negative value keeps its sign even as -0.00.
        exact = f"CAST(CAST(round({name}, {places}) AS VARCHAR) AS DECIMAL(28,10))"
        text = f"CAST(CAST(abs({exact}) AS DECIMAL(28,2)) AS VARCHAR)"
        return f"CASE WHEN {exact} < 0 THEN '-' ELSE '' END || {text} AS {name}"

    columns = ", ".join(written(n) for n in FEATURES.names)
    return f"SELECT {columns} FROM ({_DAY_FEATURES}) features"


_UNTYPED = "SELECT " + _TICK_COLUMNS + """, {seller} AS sale_order_id, CAST(NULL AS DOUBLE) AS sale_order_price
FROM ticks WHERE volume {side} 90"""

_LATE_DAYS = (
    "levels AS (SELECT * FROM all_levels WHERE order_date >= DATE '2024-01-16')",
    "early AS (SELECT * FROM ticks WHERE order_date <= DATE '2024-01-20')",
)

_BAND_COLUMNS = ", ".join(f"{r} AS {b}" for b, r in _BAND_RATIOS.items())

_MOMENT_COLUMNS = f"SELECT order_code, {_DAY}, price_std, price_skewness, price_kurtosis FROM moments"

_LEVEL_COLUMNS = (
    f"SELECT order_code, {_DAY}, CAST(price AS DOUBLE) AS price, v AS volume_sum, {_money('a')} AS sum FROM levels"
)

_UPDOWN_DAY = _with(_TICKS, _EVENT_LEVELS, _EVENT_EDGES, _EVENT_SUMS) + _UPDOWN

_EDGE_TICKS = f"""SELECT {_TICK_COLUMNS}, edge FROM (
  SELECT *, 'first' AS edge, row_number() OVER (PARTITION BY order_code, order_date ORDER BY order_time, tran_id) AS r
  FROM {{ticks}} UNION ALL
  SELECT *, 'last' AS edge, row_number() OVER (PARTITION BY order_code, order_date ORDER BY order_time DESC, tran_id DESC) AS r
  FROM {{ticks}}) t WHERE r = 1"""

_ODD_CLOCKS = """
odd AS (
  SELECT * REPLACE (CASE volume % 4 WHEN 0 THEN order_time || '789' WHEN 1 THEN order_time || '+08:00'
                    WHEN 2 THEN 'T' || order_time ELSE order_time END AS order_time) FROM ticks)"""

ORACLE_SQL: dict[str, str] = {
    "tick_scan": _with(_TICKS)
    + f"SELECT {_TICK_COLUMNS}, CAST(CAST(price * 100 AS BIGINT) * volume AS DOUBLE) / 100 AS sum "
    "FROM ticks WHERE tran_id IS NOT NULL",
    "where_scan": "SELECT event_id, user_id, value FROM events WHERE event_type = 'click' AND value >= 50",
    "day_filter": _with(_TICKS)
    + f"SELECT {_TICK_COLUMNS} FROM ticks WHERE ticks.order_date IN (DATE '2024-01-05', DATE '2024-01-06')",
    "stock_day_by_sql": _with(_TICKS)
    + f"SELECT {_TICK_COLUMNS} FROM ticks WHERE order_code = 'click' AND ticks.order_date = DATE '2024-01-05'",
    "key_semijoin": _with(_TICKS)
    + f"SELECT {_TICK_COLUMNS} FROM ticks WHERE (order_code, ticks.order_date) IN "
    "(SELECT (order_code, order_date) FROM ticks WHERE day(order_date) % 2 = 0)",
    "literal_key_list": _with(_TICKS)
    + f"SELECT {_TICK_COLUMNS} FROM ticks WHERE (order_code, ticks.order_date) IN "
    "(('click', DATE '2024-01-05'), ('view', DATE '2024-01-06'))",
    "distinct_codes": "SELECT DISTINCT event_type || '.EV' AS ts_code FROM events",
    "json_ticks": _with(_TICKS) + f"SELECT {_TICK_COLUMNS} FROM ticks",
    "positional_ticks": _with(_TICKS) + _UNTYPED.format(seller="tran_id", side="<="),
    "rejected_ticks": _with(_TICKS) + _UNTYPED.format(seller="CAST(NULL AS BIGINT)", side=">"),
    "day_forms": _with(_TICKS)
    + "SELECT tran_id, order_code, CASE WHEN volume % 3 < 2 THEN strftime(order_date, '%Y-%m-%d') END "
    "AS trade_date FROM ticks",
    "price_levels": _with(_TICKS, _EVENT_LEVELS) + _LEVEL_COLUMNS,
    "lineitem_levels": _with(_LINES, _LINE_LEVELS) + _LEVEL_COLUMNS,
    "open_close": _with(_TICKS, _EVENT_EDGES)
    + f"SELECT order_code, {_DAY}, CAST(open_price AS DOUBLE) AS open_price, "
    "CAST(close_price AS DOUBLE) AS close_price FROM edges",
    "edge_ticks": _with(_TICKS) + _EDGE_TICKS.format(ticks="ticks"),
    "edge_ticks_any_clock": _with(_TICKS, _ODD_CLOCKS) + _EDGE_TICKS.format(ticks="odd"),
    "totals_vwap": _with(_TICKS, _EVENT_LEVELS, _EVENT_EDGES, _EVENT_SUMS)
    + f"""SELECT order_code, {_DAY}, {_money('o')} AS start_price, {_money('e')} AS end_price,
       CAST(v AS BIGINT) AS volume, {_money('a')} AS amount, CAST(uv AS BIGINT) AS up_volume, {_money('ua')} AS up_sum,
       CAST(dv AS BIGINT) AS down_volume, {_money('da')} AS down_sum, {_money('lo')} AS price_min,
       {_money('hi')} AS price_max, {_vwap('a', 'v')} AS avg_price, {_vwap('ua', 'uv')} AS up_price,
       {_vwap('da', 'dv')} AS down_price, {_money('hi - lo')} AS price_range FROM sums""",
    "weighted_moments": _with(_TICKS, _EVENT_LEVELS, _MEANS) + _MOMENT_COLUMNS,
    "lineitem_moments": _with(_LINES, _LINE_LEVELS, _MEANS) + _MOMENT_COLUMNS,
    "price_bands": _with(_TICKS, _EVENT_LEVELS, _EVENT_LIMITS, _BANDS_CTE)
    + f"SELECT order_code || '.EV' AS ts_code, strftime(order_date, '%Y-%m-%d') AS trade_date, "
    f"CAST(n AS BIGINT) AS volume, {_BAND_COLUMNS} FROM banded",
    "lineitem_bands": _with(
        _LINES,
        _LINE_LEVELS,
        "limited AS (SELECT *, MIN(c) OVER k AS lo, MAX(c) OVER k AS hi FROM levels "
        "WINDOW k AS (PARTITION BY order_code, order_date))",
        _BANDS_CTE,
    )
    + f"SELECT order_code, {_DAY}, CAST(n AS BIGINT) AS volume, {_BAND_COLUMNS} FROM banded",
    "updown_day": _UPDOWN_DAY,
    "updown_stored": _UPDOWN_DAY + " AND day(sums.order_date) % 2 = 0",
    "updown_work_list": _with(
        _TICKS,
        _EVENT_LEVELS.replace("levels AS", "all_levels AS"),
        *_LATE_DAYS,
        _EDGES.format(source="early"),
        _SUMS.format(close="coalesce(CAST(close_price * 100 AS BIGINT), 0)"),
    )
    + _UPDOWN,
    "day_features": _DAY_FEATURES,
    "day_features_table_order": _TABLE_ORDER,
    "price_changes": _PRICE_CHANGES,
    "price_changes_sliced": _PRICE_CHANGES,
    "price_changes_stamped": _PRICE_CHANGES.replace(_DAY, "'2030-01-02' AS order_date"),
    "run_accumulator": _RUN_ROWS,
    "run_merge": _RUN_ROWS,
    "run_kept": _RUN_ROWS,
    "carry_forward": _with(_TICKS, _BARS) + _BAR_COLUMNS.format(start="new_start"),
    "keyed_update": _with(_TICKS, _BARS)
    + _BAR_COLUMNS.format(start='CASE WHEN "end" < 50 THEN new_start ELSE start END'),
    "keyed_update_files": _with(_TICKS, _BARS)
    + _BAR_COLUMNS.format(start='CASE WHEN "end" < 50 THEN new_start ELSE start END'),
    "tsv_lines": _LINES_OF_CHANGES,
    "tsv_files": _LINES_OF_CHANGES,
    "day_lines": _PRICE_CHANGES + " WHERE changed.order_date >= DATE '2024-01-10' AND order_code IN ('click', 'view') AND changed.price > 20",
    "labelled_load": _PRICE_CHANGES,
    "csv_projection": _written_features(),
    "csv_files": _written_features(),
    "updown_append": _UPDOWN_DAY,
    "stream_price_changes": _PRICE_CHANGES,
    "stream_price_changes_batches": _PRICE_CHANGES,
    "stream_price_changes_timed": _PRICE_CHANGES,
    "stream_change_log": _PRICE_CHANGES,
    "stream_day_window": _RUN_ROWS,
    "stream_closed_days": _with(_TICKS)
    + _RUN.format(
        where="WHERE ticks.order_date + INTERVAL 1 DAY <= (SELECT MAX(ts) - INTERVAL 10 MINUTE FROM ticks)"
    ),
}

