"""SQL for the registered queries, over the same tables; written for DuckDB.

``CASE WHEN v = 0 THEN 0.0`` removes the sign of a rounded negative zero.
"""

from __future__ import annotations

from math import comb, gamma

_BARS = """
bars AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS time,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close, count(*) AS tick_volume
  FROM events GROUP BY 1, 2
)"""

_DAILY = """
bars AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, date_trunc('day', l_shipdate) AS time,
         first(l_extendedprice ORDER BY l_shipdate, l_orderkey * 8 + l_linenumber) AS open,
         max(l_extendedprice) AS high, min(l_extendedprice) AS low,
         last(l_extendedprice ORDER BY l_shipdate, l_orderkey * 8 + l_linenumber) AS close,
         count(*) AS tick_volume
  FROM lineitem GROUP BY 1, 2
)"""

_DEFECTS = """
defects AS (
  SELECT symbol, time, open,
         CASE WHEN (day(time) + hour(time)) % 11 = 0 THEN low - 1 ELSE high END AS high, low,
         CASE WHEN (day(time) + hour(time)) % 13 <> 1 THEN close END AS close, tick_volume
  FROM bars
)"""

_HOLED = """
holed AS (
  SELECT * REPLACE (CASE (day(time) + hour(time)) % 7 WHEN 0 THEN 'inf'::DOUBLE
                    WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN NULL ELSE close END AS close)
  FROM bars
)"""

_VIOLATES = """(high < low OR high < open OR high < close OR low > open OR low > close
  OR tick_volume < 0 OR open IS NULL OR close IS NULL)"""
_SPIKES = """coalesce((high - low) / nullif(open, 0) > 0.20, open = 0 AND high - low > 0, FALSE)"""

_CONTRACTS = """
contracts AS (
  SELECT *, CASE WHEN CAST(time AS DATE) < DATE '2024-01-11' THEN 'WINF24'
                 WHEN CAST(time AS DATE) < DATE '2024-01-21' THEN 'WING24'
                 ELSE 'WINH24' END AS original_contract
  FROM bars
)"""

_AGAIN = """
again AS (
  SELECT * REPLACE (close + 1 AS close), 1000000000 + epoch(time)::BIGINT // 3600 AS ingest_seq
  FROM {source} WHERE hour(time) % 2 = 0
),
duplicates AS (
  SELECT *, epoch(time)::BIGINT // 3600 AS ingest_seq FROM {source}
  UNION ALL SELECT * FROM again
)"""

_TEXT = """CASE hour(time) % 4
    WHEN 0 THEN strftime(time, '%a, %d %b %Y %H:%M:%S GMT')
    WHEN 1 THEN strftime(time, '%Y-%m-%dT%H:%M:%S')
    WHEN 2 THEN strftime(time, '%Y-%m-%d %H:%M:%S')
    ELSE strftime(time, '%Y-%m-%d') END"""
_PARSED = """coalesce(try_strptime({0}, '%a, %d %b %Y %H:%M:%S GMT'),
    try_strptime({0}, '%Y-%m-%dT%H:%M:%S'),
    CASE WHEN length({0}) = 19 THEN try_strptime({0}, '%Y-%m-%d %H:%M:%S') END)"""
_OPENED = """CASE WHEN hour({0}) = 0 AND minute({0}) = 0
    THEN {0} + CASE WHEN symbol LIKE '%$' THEN INTERVAL 9 HOUR ELSE INTERVAL 10 HOUR END
    ELSE {0} END"""
_SYMBOL = "CASE symbol WHEN 'click' THEN 'WIN$' WHEN 'view' THEN 'WDO$' ELSE symbol END"


def _r(value: str, name: str) -> str:
    return f"CASE WHEN round({value}, 6) = 0 THEN 0.0::DOUBLE ELSE round({value}, 6) END AS {name}"


def _same(*names: str) -> str:
    return ", ".join(_r(name, name) for name in names)


_LN_HL = "ln(nullif(high, 0) / nullif(low, 0))"
_LN_CO = "ln(nullif(close, 0) / nullif(open, 0))"
_GK_RAW = f"(0.511 * {_LN_HL} * {_LN_HL} - 0.3862943611198906 * {_LN_CO} * {_LN_CO})"
_GK = f"sqrt(CASE WHEN {_GK_RAW} < 0 THEN 0.0 ELSE {_GK_RAW} END)"
_PARKINSON = f"sqrt({_LN_HL} * {_LN_HL} / 2.772588722239781)"
_IMBALANCE = "((close - open) / (high - low + 1e-6) * tick_volume)"
_LOG_RETURN = "(ln(nullif(close, 0)) - ln(nullif(lag(close) OVER w, 0)))"
_PROXY = "(close - 0.4 * lag(close, 1) OVER w - 0.12 * lag(close, 2) OVER w)"
_MOMENTUM = """CASE WHEN count(tick_volume) OVER w10 >= 10
    THEN tick_volume / (avg(tick_volume) OVER w10 + 1e-6) END"""
_VOLATILITY = "CASE WHEN count(log_return) OVER w10 >= 10 THEN stddev_samp(log_return) OVER w10 END"
_WINDOWS = """WINDOW w AS (PARTITION BY symbol ORDER BY time),
  w10 AS (PARTITION BY symbol ORDER BY time ROWS 9 PRECEDING)"""

_CYCLES = {
    "month": "month(time) / 12.0",
    "weekday": "isodow(time) / 7.0",
    "hour": "hour(time) / 24.0",
    "minute": "minute(time) / 60.0",
}
_WAVES = [
    (f"{unit}_{wave}", f"{wave}(2 * pi() * {part})")
    for unit, part in _CYCLES.items()
    for wave in ("sin", "cos")
]
_FEATURES = [
    ("log_return", "log_return"),
    ("garman_klass_volatility", _GK),
    ("parkinson_volatility", _PARKINSON),
    ("realized_volatility", "realized_volatility"),
    ("order_flow_imbalance", _IMBALANCE),
    ("volume_momentum", "volume_momentum"),
    ("frac_diff_proxy", "frac_diff_proxy"),
    *_WAVES,
]


def _gold(source: str, rows: str) -> str:
    """Feature rows of ``source`` as CTE ``gold``."""
    values = ", ".join(f"{value} AS {name}" for name, value in _FEATURES)
    complete = " AND ".join(f"{name} IS NOT NULL" for name, _ in _FEATURES)
    return f"""{source},
returns AS (
  SELECT *, {_LOG_RETURN} AS log_return, {_MOMENTUM} AS volume_momentum,
         {_PROXY} AS frac_diff_proxy
  FROM {rows} {_WINDOWS}
),
rolled AS (SELECT *, {_VOLATILITY} AS realized_volatility FROM returns {_WINDOWS}),
featured AS (
  SELECT symbol, time, open, high, low, close, tick_volume, {values} FROM rolled
),
gold AS (SELECT * FROM featured WHERE {complete})"""


def _gold_rows(source: str) -> str:
    names = _same(*[name for name, _ in _FEATURES])
    return f"""WITH {_gold(source, "bars")}
SELECT symbol, time, open, high, low, close, tick_volume, {names} FROM gold"""


def _one(value: str, name: str) -> str:
    return f"WITH {_BARS} SELECT symbol, time, {_r(value, name)} FROM bars {_WINDOWS}"


def _spliced(basis: str, source: str = "contracts") -> str:
    """Rows of ``source`` with adjusted prices as CTE ``spliced``."""
    prices = ", ".join(f"{p} + later AS {p}" for p in ("open", "high", "low", "close"))
    return f"""gaps AS (
  SELECT *, coalesce(CASE WHEN original_contract <> lag(original_contract) OVER w
                     THEN {basis} - lag(close) OVER w END, 0.0) AS gap
  FROM {source} {_WINDOWS}
),
summed AS (
  SELECT *, coalesce(sum(gap) OVER (PARTITION BY symbol ORDER BY time DESC
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS later
  FROM gaps
),
spliced AS (SELECT symbol, time, {prices}, tick_volume FROM summed)"""


def _splice_rows(basis: str) -> str:
    return f"""WITH {_BARS}, {_CONTRACTS}, {_spliced(basis)}
SELECT symbol, time, {_same("open", "high", "low", "close")}, tick_volume FROM spliced"""


def _binomials(order: float) -> list[float]:
    """(-1)^k times ``order`` over k by the gamma function, while at least 1e-4, for k to 100."""
    if order == int(order):
        return [(-1.0) ** k * comb(int(order), k) for k in range(int(order) + 1)]
    weights = [gamma(k - order) / (gamma(-order) * gamma(k + 1)) for k in range(101)]
    small = [k for k, weight in enumerate(weights) if abs(weight) < 1e-4]
    return weights[: small[0]] if small else weights


def _oldest_first(order: float) -> str:
    """101 weights as a list; orders with fewer are padded with zeros."""
    weights = _binomials(order)
    weights += [0.0] * (101 - len(weights))
    return "[" + ", ".join(repr(w) for w in reversed(weights)) + "]::DOUBLE[]"


def _frac(source: str, order: str = "time") -> str:
    """Rows of ``source`` with ``frac_diff_close`` as CTE ``diffed``."""
    return f"""recent AS (
  SELECT *, list(coalesce(close, 0.0)) OVER (PARTITION BY symbol ORDER BY {order}
                                             ROWS 100 PRECEDING) AS history
  FROM {source}
),
diffed AS (
  SELECT *, list_dot_product(history, list_slice({_oldest_first(0.4)}, 102 - len(history), 101))
              AS frac_diff_close
  FROM recent
)"""


_FRAC_ROWS = f"""WITH {_BARS}, {_frac("bars")}
SELECT symbol, time, {_same("frac_diff_close")} FROM diffed"""

_GRID = [i / 10 for i in range(11)]
_GRID_WEIGHTS = ", ".join(f"({d!r}::DOUBLE, {_oldest_first(d)})" for d in _GRID)
_STATISTICS = f"""WITH {_BARS},
weights(d, weight) AS (VALUES {_GRID_WEIGHTS}),
recent AS (
  SELECT symbol, row_number() OVER w AS rn, list(close) OVER (w ROWS 100 PRECEDING) AS history
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY time)
),
levels AS (
  SELECT symbol, d, rn, list_dot_product(history, weight) AS y
  FROM recent CROSS JOIN weights WHERE rn > 100
),
pairs AS (
  SELECT symbol, d, rn, lag(y) OVER v AS x, y - lag(y) OVER v AS dy
  FROM levels WINDOW v AS (PARTITION BY symbol, d ORDER BY rn)
),
fits AS (
  SELECT symbol, d, count(*) AS n, regr_slope(dy, x) AS slope, regr_sxx(dy, x) AS sxx,
         regr_syy(dy, x) AS syy, regr_sxy(dy, x) AS sxy
  FROM pairs WHERE rn > 101 GROUP BY 1, 2
),
statistics AS (
  SELECT symbol, d, n,
         slope / nullif(sqrt((syy - slope * sxy) / nullif(n - 2, 0) / nullif(sxx, 0)), 0)
           AS t_statistic
  FROM fits
)"""

_AUGMENTED = f"""WITH {_BARS},
weights(d, weight) AS (VALUES {_GRID_WEIGHTS}),
recent AS (
  SELECT symbol, row_number() OVER w AS rn, list(close) OVER (w ROWS 100 PRECEDING) AS history
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY time)
),
levels AS (
  SELECT symbol, d, rn, list_dot_product(history, weight) AS y
  FROM recent CROSS JOIN weights WHERE rn > 100
),
rows AS (
  SELECT symbol, d, rn, lag(y) OVER v AS x, lag(y) OVER v - lag(y, 2) OVER v AS z, y - lag(y) OVER v AS dy
  FROM levels WINDOW v AS (PARTITION BY symbol, d ORDER BY rn)
),
sums AS (
  SELECT symbol, d, count(*) AS n, count(*) * var_pop(x) AS xx, count(*) * var_pop(z) AS zz,
         count(*) * var_pop(dy) AS yy, count(*) * covar_pop(x, z) AS xz,
         count(*) * covar_pop(x, dy) AS xy, count(*) * covar_pop(z, dy) AS zy
  FROM rows WHERE rn > 102 GROUP BY 1, 2
),
slopes AS (
  SELECT *, xy / xx AS b0, xx * zz - xz * xz AS det, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS b1,
         (zy * xx - xy * xz) / (xx * zz - xz * xz) AS c1
  FROM sums
),
rests AS (SELECT *, yy - b0 * xy AS r0, yy - b1 * xy - c1 * zy AS r1 FROM slopes),
chosen AS (SELECT *, n * ln(r1 / n) + 6 < n * ln(r0 / n) + 4 AS lagged FROM rests)
SELECT symbol, d, n, CASE WHEN lagged THEN 1 ELSE 0 END::INTEGER AS lags,
       {_r("CASE WHEN lagged THEN b1 / sqrt(r1 / (n - 3) * zz / det) ELSE b0 / sqrt(r0 / (n - 2) / xx) END", "t_statistic")}
FROM chosen"""

_TICKS = """
ticks AS (
  SELECT event_id, event_type AS symbol, event_id // 50 AS batch_id, event_id AS ingest_seq,
         epoch_us(ts) // 1000 AS time_msc,
         epoch_us(ts) // 1000 + (event_id // 50) % 20 AS arrival_msc
  FROM events
),
ages AS (
  SELECT 'futures' AS data_type, symbol, 'ticks' AS timeframe, batch_id, arg_max(time_msc, ingest_seq) AS last_time_msc,
         arg_max(arrival_msc, ingest_seq) AS last_arrival_msc, count(*) AS ticks,
         arg_max(arrival_msc, ingest_seq) - arg_max(time_msc, ingest_seq) AS age_msc
  FROM ticks GROUP BY symbol, batch_id
)"""
_FRESH = f"""WITH {_TICKS}
SELECT event_id, batch_id, time_msc FROM ticks JOIN ages USING (symbol, batch_id) WHERE NOT age_msc > 10"""

_METRICS = """
metrics AS (
  SELECT event_type AS model, date_trunc('hour', ts) AS ts,
         avg(value) / nullif(stddev_samp(value), 0) AS sharpe_ratio
  FROM events GROUP BY 1, 2
),
alerts AS (
  SELECT model, ts, sharpe_ratio, 'Sharpe ratio below its limit' AS title,
         CAST(ts AS DATE) AS alert_date
  FROM metrics WHERE coalesce(sharpe_ratio, 0) < 1.5
)"""

_ORDERS = """
traded AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CASE WHEN o_orderkey % 2 = 0 THEN 'WIN' ELSE 'WDO' END AS root
  FROM orders
)"""

_RAW = f"""{_BARS}, {_CONTRACTS},
broken AS (
  SELECT {_SYMBOL} AS symbol, time, open,
         CASE WHEN (day(time) + hour(time)) % 11 = 0 THEN low - 1 ELSE high END AS high, low,
         CASE WHEN (day(time) + hour(time)) % 13 <> 1 THEN close END AS close,
         tick_volume, original_contract
  FROM contracts
),
{_AGAIN.format(source="broken")},
texts AS (SELECT * REPLACE ({_TEXT} AS time) FROM duplicates),
parsed AS (SELECT * REPLACE ({_PARSED.format("time")} AS time) FROM texts),
prepared AS (
  SELECT symbol, time, open, high, low, close, tick_volume, 0::BIGINT AS spread,
         0::BIGINT AS real_volume, 'H1' AS timeframe, original_contract
  FROM parsed
  QUALIFY row_number() OVER (PARTITION BY symbol, time, CASE WHEN time IS NULL THEN ingest_seq END
                             ORDER BY ingest_seq DESC) = 1
)"""

_SILVER = f"""WITH {_RAW},
good AS (SELECT * FROM prepared WHERE time IS NOT NULL AND NOT coalesce({_VIOLATES}, FALSE)),
{_spliced("close", "good")},
continuous AS (
  SELECT * FROM spliced WHERE symbol IN ('WIN$', 'WDO$')
  UNION ALL BY NAME
  SELECT symbol, time, open, high, low, close, tick_volume FROM good
  WHERE symbol NOT IN ('WIN$', 'WDO$')
),
{_frac("continuous")}"""

ORACLES: dict[str, str] = {
    "ohlc_bars": f"WITH {_BARS} SELECT * FROM bars",
    "log_return": _one(_LOG_RETURN, "log_return"),
    "percent_return": _one(
        "(close - lag(close) OVER w) / nullif(lag(close) OVER w, 0)", "percent_return"
    ),
    "realized_volatility": f"""WITH {_BARS},
returns AS (SELECT *, {_LOG_RETURN} AS log_return FROM bars {_WINDOWS})
SELECT symbol, time, {_r(_VOLATILITY, "realized_volatility")} FROM returns {_WINDOWS}""",
    "volume_momentum": _one(_MOMENTUM, "volume_momentum"),
    "frac_diff_proxy": _one(_PROXY, "frac_diff_proxy"),
    "garman_klass": _one(_GK, "garman_klass_volatility"),
    "parkinson": _one(_PARKINSON, "parkinson_volatility"),
    "order_flow_imbalance": _one(_IMBALANCE, "order_flow_imbalance"),
    "cyclic_time": f"""WITH {_BARS}
SELECT symbol, time, {", ".join(_r(value, name) for name, value in _WAVES)} FROM bars""",
    "gold_features": _gold_rows(_BARS),
    "gold_features_daily": _gold_rows(_DAILY),
    "dq_violations": f"WITH {_BARS}, {_DEFECTS} SELECT * FROM defects WHERE {_VIOLATES}",
    "dq_spikes": f"WITH {_BARS} SELECT * FROM bars WHERE {_SPIKES}",
    "dq_report": f"""WITH {_BARS}, {_DEFECTS}
SELECT symbol, count(*) FILTER (WHERE {_VIOLATES}) = 0 AS is_valid, count(*) AS validated_rows,
       count(*) FILTER (WHERE {_VIOLATES}) AS violations,
       count(*) FILTER (WHERE {_SPIKES}) AS spikes,
       count(*) FILTER (WHERE time IS NULL) AS unparsed_time
FROM defects GROUP BY 1""",
    "dq_samples": f"""WITH {_BARS}, {_DEFECTS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time)::INTEGER AS sample
  FROM defects WHERE {_VIOLATES}
)
SELECT * FROM ranked WHERE sample <= 5""",
    "dq_quarantine": f"""WITH {_BARS}, {_DEFECTS}
SELECT *, NOT coalesce({_VIOLATES}, FALSE) AS accepted FROM defects""",
    "dedup_keep_last": f"""WITH {_BARS}, {_AGAIN.format(source="bars")}
SELECT * FROM duplicates
QUALIFY row_number() OVER (PARTITION BY symbol, time ORDER BY ingest_seq DESC) = 1""",
    "time_normalize": f"""WITH {_BARS}, texts AS (SELECT symbol, {_TEXT} AS time_text FROM bars)
SELECT symbol, time_text, {_PARSED.format("time_text")} AS time FROM texts""",
    "time_from_epoch": """SELECT event_id, epoch(date_trunc('second', ts))::BIGINT AS "timestamp",
       date_trunc('second', ts) AS time FROM events""",
    "session_open_shift": f"""WITH {_BARS}, named AS (SELECT {_SYMBOL} AS symbol, time FROM bars)
SELECT symbol, time, {_OPENED.format("time")} AS opened FROM named""",
    "conform_fill": f"""WITH {_BARS}
SELECT symbol, time, open, high, low, close,
       CASE WHEN hour(time) % 5 <> 0 THEN tick_volume ELSE 0 END AS tick_volume,
       0::BIGINT AS spread, 0::BIGINT AS real_volume
FROM bars""",
    "drop_null_prices": f"""WITH {_BARS}, {_DEFECTS}
SELECT * FROM defects WHERE hour(time) <> 23 AND close IS NOT NULL""",
    "finite_rows": f"""WITH {_BARS}, {_HOLED}
SELECT * FROM holed WHERE close IS NULL OR isfinite(close)""",
    "dq_non_finite": f"""WITH {_BARS}, {_HOLED}
SELECT symbol, 0::BIGINT AS open, 0::BIGINT AS high, 0::BIGINT AS low,
       count(*) FILTER (WHERE NOT isfinite(close)) AS close
FROM holed GROUP BY 1""",
    "rollover_gaps": f"""WITH {_BARS}, {_CONTRACTS}, {_spliced("close")}
SELECT symbol, time, {_same("gap")} FROM gaps WHERE gap <> 0""",
    "splice_backward": _splice_rows("close"),
    "splice_broadcast": _splice_rows("close"),
    "splice_open_gap": _splice_rows("open"),
    "frac_diff": _FRAC_ROWS,
    "frac_diff_sliced": _FRAC_ROWS,
    "frac_diff_ticks": f"""WITH ticks AS (
  SELECT event_type AS symbol, ts AS time, value AS close FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id DESC) = 1
),
{_frac("ticks")}
SELECT symbol, time, {_same("frac_diff_close")} FROM diffed""",
    "frac_diff_orders": f"""{_STATISTICS}
SELECT symbol, d, n, {_same("t_statistic")} FROM statistics""",
    "frac_diff_least_order": f"""{_STATISTICS}
SELECT symbol, min(d) FILTER (WHERE t_statistic < -2.86) AS least_d FROM statistics GROUP BY 1""",
    "frac_diff_adf": _AUGMENTED,
    "silver_prepare": f"WITH {_RAW} SELECT * FROM prepared",
    "splice_asof": _splice_rows("close"),
    "splice_sliced": _splice_rows("close"),
    "gold_features_sliced": _gold_rows(_BARS),
    "layers_incremental": f"""{_SILVER}
SELECT symbol, time, {_same("open", "high", "low", "close")}, tick_volume, {_same("frac_diff_close")}
FROM diffed""",
    "layer_range_replace": f"""WITH {_BARS},
ranged AS (SELECT *, epoch_us(time) - epoch_us(time) % 655360000000 AS period FROM bars),
edge AS (SELECT epoch_us(TIMESTAMP '2024-01-20') - epoch_us(TIMESTAMP '2024-01-20') % 655360000000 AS start)
SELECT symbol, time, CASE WHEN period >= start THEN close + 1 ELSE close END AS close
FROM ranged, edge
WHERE time >= TIMESTAMP '2024-01-15 12:00:00' AND (period < start OR hour(time) % 2 = 0)""",
    "silver_clean": f"""{_SILVER}
SELECT symbol, time, {_same("open", "high", "low", "close")}, tick_volume,
       0::BIGINT AS spread, 0::BIGINT AS real_volume, 'H1' AS timeframe, {_same("frac_diff_close")}
FROM diffed""",
    "series_verdicts": f"""WITH {_RAW}
SELECT symbol, 'H1' AS timeframe, count(*) AS bars,
       count(*) FILTER (WHERE time IS NULL) AS unparsed_time, 0::BIGINT AS not_finite,
       count(*) FILTER (WHERE time IS NOT NULL AND {_VIOLATES}) AS price_rule,
       0::BIGINT AS missing_price, count(*) FILTER (WHERE {_VIOLATES}) > 0 AS held
FROM prepared GROUP BY 1""",
    "layer_row_balance": f"""WITH {_RAW},
arrived AS (SELECT symbol, count(*) AS bronze FROM parsed GROUP BY 1)
SELECT symbol, bronze, bronze - count(*) AS superseded,
       count(*) FILTER (WHERE time IS NULL) AS unparsed_time,
       count(*) FILTER (WHERE time IS NOT NULL AND {_VIOLATES}) AS price_rule,
       0::BIGINT AS not_finite, 0::BIGINT AS missing_price,
       count(*) FILTER (WHERE time IS NOT NULL AND NOT coalesce({_VIOLATES}, FALSE)) AS silver,
       TRUE AS balanced
FROM prepared JOIN arrived USING (symbol) GROUP BY symbol, bronze""",
    "bronze_append": f"""WITH {_BARS}, batches AS (
  SELECT *, 1::BIGINT AS batch_id FROM bars
  UNION ALL SELECT *, 2::BIGINT AS batch_id FROM bars WHERE hour(time) % 2 = 0
)
SELECT 'futures' AS data_type, symbol, 'H1' AS timeframe, batch_id, count(*) AS rows,
       sum(tick_volume)::BIGINT AS tick_volume
FROM batches GROUP BY ALL""",
    "layer_replace": f"""WITH {_BARS}
SELECT symbol, 'H1' AS timeframe, time,
       CASE WHEN symbol = 'click' THEN close + 1 ELSE close END AS close
FROM bars""",
    "layers_report": f"""WITH {_BARS}, {_AGAIN.format(source="bars")},
raised AS (
  SELECT symbol, time, open + 1 AS open, greatest(high + 1, close + 1) AS high, low + 1 AS low,
         close + 1 AS close, tick_volume, ingest_seq
  FROM duplicates
),
clean AS (
  SELECT * FROM raised
  QUALIFY row_number() OVER (PARTITION BY symbol, time ORDER BY ingest_seq DESC) = 1
),
{_gold("counts AS (SELECT 1)", "clean")}
SELECT 'futures' AS data_type, symbol, 'H1' AS timeframe, TRUE AS bronze, TRUE AS silver,
       count(*) > 0 AS gold, TRUE AS is_valid, count(*) AS validated_rows
FROM gold GROUP BY symbol""",
    "stale_batches": f"""WITH {_TICKS}
SELECT *, TRUE AS is_stale FROM ages WHERE age_msc > 10""",
    "fresh_ticks": _FRESH,
    "drift_audit": f"""WITH {_METRICS}
SELECT model, ts, {_same("sharpe_ratio")}, title, alert_date FROM alerts""",
    "drift_alert_days": f"""WITH {_METRICS}
SELECT alert_date, model, count(*) AS alerts FROM alerts GROUP BY 1, 2""",
    "contract_decode": f"""WITH {_ORDERS}
SELECT root || substr('FGHJKMNQUVXZ', month(month)::INTEGER, 1) || strftime(month, '%y') AS contract,
       count(*) AS trades, root, month(month)::INTEGER AS month,
       2000 + strftime(month, '%y')::INTEGER AS year
FROM traded GROUP BY root, month""",
    "expiry_calendar": f"""WITH {_ORDERS},
months AS (SELECT month, count(*) AS trades FROM traded GROUP BY 1),
days AS (
  SELECT month, trades, CAST(unnest(generate_series(month, month + INTERVAL 27 DAY,
                                     INTERVAL 1 DAY)) AS DATE) AS day
  FROM months
)
SELECT month, trades,
       CASE WHEN month(month) % 2 = 0 THEN
         arg_min(day, abs(day(day) - 15)) FILTER (WHERE isodow(day) = 3) END AS index_expiry,
       min(day) FILTER (WHERE isodow(day) < 6) AS dollar_expiry
FROM days GROUP BY month, trades""",
    "perpetual_roll": f"""WITH {_BARS},
pairs AS (
  SELECT symbol, lead(symbol) OVER (ORDER BY symbol) AS following
  FROM (SELECT DISTINCT symbol FROM bars)
),
shares AS (
  SELECT a.symbol AS root, a.time, a.tick_volume / (a.tick_volume + b.tick_volume) AS w,
         a.open AS ao, b.open AS bo, a.high AS ah, b.high AS bh, a.low AS al, b.low AS bl,
         a.close AS ac, b.close AS bc, a.tick_volume + b.tick_volume AS tick_volume
  FROM bars a JOIN pairs USING (symbol) JOIN bars b ON a.time = b.time AND b.symbol = following
)
SELECT root, time, {_r("w", "front_weight")},
       {_r("w * ao + (1 - w) * bo", "open")}, {_r("w * ah + (1 - w) * bh", "high")},
       {_r("w * al + (1 - w) * bl", "low")}, {_r("w * ac + (1 - w) * bc", "close")},
       tick_volume
FROM shares""",
    "perpetual_chain": f"""WITH months AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                     date_trunc('month', max(o_orderdate)) + INTERVAL 6 MONTH,
                                     INTERVAL 1 MONTH)) AS DATE) AS month
  FROM orders
),
days AS (
  SELECT month, CAST(unnest(generate_series(month, month + INTERVAL 27 DAY, INTERVAL 1 DAY)) AS DATE) AS day
  FROM months
),
expiries AS (
  SELECT 'WIN' AS root, month, arg_min(day, abs(day(day) - 15)) FILTER (WHERE isodow(day) = 3) AS expiry
  FROM days WHERE month(month) % 2 = 0 GROUP BY month
  UNION ALL
  SELECT 'WDO', month, min(day) FILTER (WHERE isodow(day) < 6) FROM days GROUP BY month
),
named AS (
  SELECT root, expiry::TIMESTAMP AS expiry,
         root || substr('FGHJKMNQUVXZ', month(month)::INTEGER, 1) || strftime(month, '%y') AS contract
  FROM expiries
),
calendar AS (
  SELECT *, lead(contract) OVER (PARTITION BY root ORDER BY expiry) AS following FROM named
),
sent AS (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'WIN' ELSE 'WDO' END AS root, o_orderdate AS time,
         o_orderkey * 7 % 31 < day(o_orderdate) AS ahead, o_orderkey, o_totalprice, o_custkey % 10 AS opened
  FROM orders
),
trades AS (
  SELECT s.root, s.time, o_orderkey, o_totalprice, opened,
         CASE WHEN ahead THEN following ELSE contract END AS contract
  FROM sent s ASOF LEFT JOIN calendar c ON s.root = c.root AND s.time <= c.expiry
),
bars AS (
  SELECT root, contract, date_trunc('week', time)::TIMESTAMP AS time,
         first(o_totalprice ORDER BY time, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, last(o_totalprice ORDER BY time, o_orderkey) AS close,
         count(*) AS tick_volume, count(*) + sum(opened) AS activity
  FROM trades GROUP BY 1, 2, 3
),
placed AS (
  SELECT b.*, c.contract AS front, c.following FROM bars b
  ASOF JOIN calendar c ON b.root = c.root AND b.time <= c.expiry
),
a AS (SELECT * FROM placed WHERE contract = front),
b AS (SELECT * FROM placed WHERE contract = following),
sides AS (
  SELECT coalesce(a.root, b.root) AS root, coalesce(a.time, b.time) AS time,
         coalesce(a.front, b.front) AS front, coalesce(a.following, b.following) AS following,
         a.open AS ao, b.open AS bo, a.high AS ah, b.high AS bh, a.low AS al, b.low AS bl,
         a.close AS ac, b.close AS bc,
         (coalesce(a.tick_volume, 0) + coalesce(b.tick_volume, 0))::BIGINT AS tick_volume,
         CASE WHEN b.root IS NULL THEN 1.0 WHEN a.root IS NULL THEN 0.0
              ELSE a.activity::DOUBLE / (a.activity + b.activity) END AS share
  FROM a FULL JOIN b ON a.root = b.root AND a.time = b.time
),
scanned AS (
  SELECT *, bool_or(share < 0.5) OVER (PARTITION BY root, front ORDER BY time) AS rolled FROM sides
),
shares AS (
  SELECT *, coalesce(min(share) FILTER (WHERE rolled) OVER (PARTITION BY root, front ORDER BY time), share) AS w
  FROM scanned
)
SELECT root, time, front, following, {_r("w + 3e-8", "front_weight")}, rolled,
       {_r("CASE WHEN ao IS NULL THEN bo WHEN bo IS NULL THEN ao ELSE w * ao + (1 - w) * bo END + 3e-8", "open")},
       {_r("CASE WHEN ah IS NULL THEN bh WHEN bh IS NULL THEN ah ELSE w * ah + (1 - w) * bh END + 3e-8", "high")},
       {_r("CASE WHEN al IS NULL THEN bl WHEN bl IS NULL THEN al ELSE w * al + (1 - w) * bl END + 3e-8", "low")},
       {_r("CASE WHEN ac IS NULL THEN bc WHEN bc IS NULL THEN ac ELSE w * ac + (1 - w) * bc END + 3e-8", "close")},
       tick_volume
FROM shares""",
    "stream_hourly_bars": f"WITH {_BARS} SELECT * FROM bars",
    "stream_features": _gold_rows(_BARS),
    "stream_fresh_ticks": _FRESH,
    "stream_dead_letters": f"""WITH {_TICKS}
SELECT event_id, batch_id, time_msc, age_msc > 10 AS is_stale FROM ticks JOIN ages USING (symbol, batch_id)""",
}
