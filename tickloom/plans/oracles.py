"""The same queries as plain SQL over the given tables."""

from __future__ import annotations

from tickloom.operators.signals import AVERAGE_TEXT, BAND_TEXT, RSI_TEXT
from tickloom.schemas import KNOWN_COINS


#: Digits of the queries with exact ties at the seventh digit.
TIED = 8
SHIFT = " + 1.7e-8"


def r(expression: str, name: str | None = None, digits: int = 6, shift: str = "") -> str:
    """Published form of a double."""
    return f"round({expression}{shift}, {digits}) + 0.0 AS {name or expression}"


def rs(*names: str, digits: int = 6, shift: str = "") -> str:
    return ", ".join(r(n, digits=digits, shift=shift) for n in names)


_GOLD_AGGREGATES = """avg(price_usd) AS avg_price, min(price_usd) AS min_price, max(price_usd) AS max_price,
  avg(volume_24h_usd) AS avg_volume, avg(change_24h_pct) AS avg_change_pct,
  coalesce(stddev_samp(price_usd), 0.0) AS price_volatility, count(price_usd) AS record_count"""


def _gold(source: str, width: str) -> str:
    start = f"time_bucket(INTERVAL '{width}', fetched_at, TIMESTAMP '1970-01-01')"
    return f"""SELECT coin_id, {start} AS window_start, {start} + INTERVAL '{width}' AS window_end, {_GOLD_AGGREGATES}
  FROM {source} WHERE fetched_at IS NOT NULL AND coin_id IS NOT NULL GROUP BY ALL"""


def _resample(source: str, width: str) -> str:
    return f"""SELECT coin_id, time_bucket(INTERVAL '{width}', window_start) AS window_start,
  avg(avg_price) AS avg_price, min(min_price) AS min_price, max(max_price) AS max_price,
  coalesce(sum(avg_volume), 0) AS avg_volume, avg(avg_change_pct) AS avg_change_pct,
  avg(price_volatility) AS price_volatility, CAST(sum(record_count) AS BIGINT) AS record_count
  FROM {source} GROUP BY ALL"""


_CTES = {
    "ticks": """SELECT event_id AS seq, event_type AS coin_id, ts AS fetched_at, value AS price_usd,
  value * 1000000 AS market_cap_usd, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS volume_24h_usd,
  (value - 50) * 4 AS change_24h_pct FROM events""",
    "dirty": """SELECT seq * 2 AS seq, CASE WHEN seq % 29 = 0 THEN NULL ELSE coin_id END AS coin_id,
  CASE WHEN seq % 31 = 0 THEN NULL ELSE fetched_at END AS fetched_at,
  CASE WHEN seq % 17 = 0 THEN NULL WHEN seq % 19 = 0 THEN 'n/a' WHEN seq % 23 = 0 THEN '-1'
    ELSE CAST(price_usd AS VARCHAR) END AS price_usd,
  CASE WHEN seq % 37 = 0 THEN NULL ELSE change_24h_pct END AS change_24h_pct, volume_24h_usd FROM ticks
  UNION ALL SELECT seq * 2 + 1, coin_id, fetched_at, CAST(price_usd + 1 AS VARCHAR), change_24h_pct, volume_24h_usd
  FROM ticks WHERE price_usd > 30""",
    "typed": """SELECT seq, coin_id, fetched_at, TRY_CAST(price_usd AS DOUBLE) AS price_usd, change_24h_pct,
  volume_24h_usd, CASE WHEN change_24h_pct BETWEEN -100 AND 1000 THEN 'good' ELSE 'suspicious' END AS data_quality_flag
  FROM dirty""",
    "silver": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, fetched_at ORDER BY seq) AS rn
  FROM typed WHERE coin_id IS NOT NULL AND price_usd > 0) WHERE rn = 1""",
    "gold10": _gold("ticks", "10 seconds"),
    "hourly": _resample("gold10", "1 hour"),
    "series": """SELECT coin_id, fetched_at AS ts, price_usd AS value, volume_24h_usd AS volume, change_24h_pct AS change,
  price_usd AS high, price_usd AS low, seq FROM ticks""",
    "parts": """SELECT CAST(l_partkey AS VARCHAR) AS coin_id, l_shipdate AS ts, l_orderkey, l_linenumber,
  l_extendedprice / l_quantity AS value, l_quantity AS volume, (l_discount - 0.05) * 100 AS change FROM lineitem""",
    "rules": """SELECT o_orderkey AS id, CASE o_custkey % 6 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'error'
  WHEN 3 THEN 'purchase' WHEN 4 THEN 'signup' ELSE 'absent' END AS coin,
  CASE o_orderstatus WHEN 'F' THEN 'price' WHEN 'O' THEN 'change_24h' ELSE 'volume' END AS type,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'above' ELSE 'below' END AS condition,
  o_totalprice / 10000 AS threshold, o_orderpriority <> '5-LOW' AS active FROM orders""",
    "latest": """SELECT coin_id, arg_max(value, (ts, seq)) AS value, arg_max(change, (ts, seq)) AS change
  FROM series GROUP BY coin_id""",
    "fired": """SELECT id, upper(coin) AS coin, type, upper(coin) || ' ' || condition || ' ' ||
  regexp_replace(printf('%.10f', threshold), '(\\.[0-9]+?)0+$', '\\1') AS message
  FROM rules JOIN latest ON coin = coin_id WHERE active AND type IN ('price', 'change_24h') AND
  CASE WHEN condition = 'above' THEN CASE type WHEN 'price' THEN value ELSE change END > threshold
       ELSE CASE type WHEN 'price' THEN value ELSE change END < threshold END""",
    "history": """SELECT seq, strftime(fetched_at, '%H:%M:%S') AS time, upper(coin_id) AS coin, 'price' AS type,
  upper(coin_id) || ' above 60.0' AS message FROM ticks WHERE price_usd > 60""",
    "placed": """SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY ts, seq) - 1 AS ordinal,
  lag(value) OVER (PARTITION BY coin_id ORDER BY ts, seq) AS previous,
  count(*) OVER (PARTITION BY coin_id) AS total FROM series""",
}
_PRELUDE = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _CTES.items())


def sql(body: str, **more: str) -> str:
    extra = "".join(f",\n{name} AS ({text})" for name, text in more.items())
    return f"{_PRELUDE}{extra}\n{body}"


def _frame(key: str, order: str, rows: int) -> str:
    return f"(PARTITION BY {key} ORDER BY {order} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


def _rolling(function: str, value: str, rows: int, order: str) -> str:
    over = f"OVER {_frame('coin_id', order, rows)}"
    return f"CASE WHEN count({value}) {over} = {rows} THEN {function}({value}) {over} END"


def _indicators(source: str, value: str, order: str) -> dict[str, str]:
    """CTEs ``stepped`` and ``panel``: every indicator over the rows of ``source``."""
    mean = {w: _rolling("avg", value, w, order) for w in (10, 20)}
    spread = _rolling("stddev_samp", value, 20, order)
    gain = _rolling("avg", "gain", 14, order)
    loss = _rolling("avg", "loss", 14, order)
    return {
        "lagged": f"SELECT *, lag({value}) OVER (PARTITION BY coin_id ORDER BY {order}) AS before FROM {source}",
        "stepped": f"""SELECT *, CASE WHEN {value} - before > 0 THEN {value} - before WHEN {value} - before <= 0 THEN 0.0 END AS gain,
  CASE WHEN {value} - before < 0 THEN before - {value} WHEN {value} - before >= 0 THEN 0.0 END AS loss FROM lagged""",
        "panel": f"""SELECT *, {mean[10]} AS sma_10, {mean[20]} AS sma_20, {mean[20]} AS bb_middle,
  {mean[20]} + 2 * {spread} AS bb_upper, {mean[20]} - 2 * {spread} AS bb_lower,
  100 - 100 / (1 + ({gain}) / nullif({loss}, 0)) AS rsi_14,
  count(*) OVER (PARTITION BY coin_id) AS total, coalesce(before, {value}) AS open, {value} AS close,
  row_number() OVER (PARTITION BY coin_id ORDER BY {", ".join(c.strip() + " DESC" for c in order.split(","))}) AS back,
  first_value({value}) OVER (PARTITION BY coin_id ORDER BY {order}) AS first_value FROM stepped""",
        "last_row": f"""SELECT *, {value} AS last_value, CASE WHEN total < 14 THEN 50.0 ELSE rsi_14 END AS rsi
  FROM panel WHERE back = 1 AND total >= 5""",
        "labelled": """SELECT *, CASE WHEN rsi >= 70 THEN 'Bearish (Overbought)' WHEN rsi <= 30 THEN 'Bullish (Oversold)' ELSE 'Neutral' END AS rsi_signal,
  CASE WHEN total < 20 THEN 'Neutral (No Data)' WHEN last_value >= bb_upper * 0.98 THEN 'Bearish (Overextended)'
    WHEN last_value <= bb_lower * 1.02 THEN 'Bullish (Undervalued)' ELSE 'Neutral' END AS bb_signal,
  CASE WHEN total < 20 THEN 'Neutral (No Data)' WHEN last_value > sma_10 AND sma_10 > sma_20 THEN 'Bullish (Uptrend)'
    WHEN last_value < sma_10 AND sma_10 < sma_20 THEN 'Bearish (Downtrend)' ELSE 'Neutral' END AS ma_signal,
  CASE WHEN rsi > 30 AND rsi < 70 THEN 'Neutral' WHEN rsi >= 70 THEN 'Overbought' ELSE 'Oversold' END AS rsi_zone,
  CASE WHEN total >= 20 THEN bb_upper - bb_lower ELSE 0.0 END AS bb_width,
  (last_value - first_value) / nullif(first_value, 0) * 100 AS period_change_pct FROM last_row""",
        "scored": """SELECT *, CASE left(rsi_signal, 7) WHEN 'Bullish' THEN 1 WHEN 'Bearish' THEN -1 ELSE 0 END AS rsi_score,
  CASE left(bb_signal, 7) WHEN 'Bullish' THEN 1 WHEN 'Bearish' THEN -1 ELSE 0 END AS bb_score,
  CASE left(ma_signal, 7) WHEN 'Bullish' THEN 1 WHEN 'Bearish' THEN -1 ELSE 0 END AS ma_score FROM labelled""",
        "rated": """SELECT *, rsi_score + bb_score + ma_score AS total_score,
  CASE WHEN rsi_score + bb_score + ma_score >= 2 THEN 'Strong Buy' WHEN rsi_score + bb_score + ma_score = 1 THEN 'Buy'
    WHEN rsi_score + bb_score + ma_score = 0 THEN 'Neutral' WHEN rsi_score + bb_score + ma_score = -1 THEN 'Sell'
    ELSE 'Strong Sell' END AS recommendation FROM scored""",
    }


_GOLD_DOUBLES = ("avg_price", "min_price", "max_price", "avg_volume", "avg_change_pct", "price_volatility")
_GOLD_OUT = f"coin_id, window_start, window_end, {rs(*_GOLD_DOUBLES)}, record_count"
_BIN_OUT = f"coin_id, window_start, {rs(*_GOLD_DOUBLES)}, record_count"
_SERIES_OUT = f"coin_id, ts, {rs('value', 'volume', 'change', 'high', 'low')}, seq"
_PANEL_DOUBLES = ("open", "close", "candle_high", "candle_low", "sma_10", "sma_20", "bb_middle", "bb_upper", "bb_lower", "rsi_14")
_PANEL_OUT = f"{rs(*_PANEL_DOUBLES, digits=TIED)}, volume_direction"
_PANEL_OUT_PARTS = f"{rs(*_PANEL_DOUBLES, shift=SHIFT)}, volume_direction"
_SIGNAL_OUT = """coin_id, rsi_signal, bb_signal, ma_signal, CAST(rsi_score AS BIGINT) AS rsi_score, CAST(bb_score AS BIGINT) AS bb_score,
 CAST(ma_score AS BIGINT) AS ma_score, CAST(total_score AS BIGINT) AS total_score, recommendation"""
_BY_SEQ = _indicators("series", "value", "ts, seq")
_BY_PART = _indicators("parts", "value", "ts, l_orderkey, l_linenumber")
_BY_HOUR = _indicators("hourly", "avg_price", "window_start")
_UP = "CASE WHEN coalesce({}, 0.0) >= 0 THEN 'up' ELSE 'down' END"
_BOX = ("mean", "sd", "min", "max", "q1", "median", "q3")


def _box(value: str) -> str:
    return f"""SELECT coin_id, count({value}) AS n, {r(f'avg({value})', 'mean')}, {r(f'stddev_samp({value})', 'sd')},
 {r(f'min({value})', 'min')}, {r(f'max({value})', 'max')}, {r(f'quantile_cont({value}, 0.25)', 'q1')},
 {r(f'quantile_cont({value}, 0.5)', 'median')}, {r(f'quantile_cont({value}, 0.75)', 'q3')}"""


def _correlation(cells: str) -> str:
    return f"""SELECT a.coin_id AS coin_a, b.coin_id AS coin_b,
 round(CASE WHEN count(*) >= 2 THEN covar_pop(a.x, b.x) / nullif(stddev_pop(a.x) * stddev_pop(b.x), 0) END, 6) + 0.0 AS correlation
 FROM {cells} a JOIN {cells} b ON a.at = b.at GROUP BY ALL"""


def _forecast_linear(source: str, value: str, ts: str, order: str, where: str = "true") -> dict[str, str]:
    """CTEs ending in ``line``: the linear forecast of the keys that satisfy ``where``."""
    return {
        "ranked": f"""SELECT coin_id, {value} AS y, row_number() OVER (PARTITION BY coin_id ORDER BY {order}) - 1 AS i,
  epoch_us({ts}) AS us, epoch_us({ts}) - lag(epoch_us({ts})) OVER (PARTITION BY coin_id ORDER BY {order}) AS gap FROM {source}""",
        "steps": """SELECT coin_id, count(y) AS n, coalesce(regr_slope(y, i), 0.0) AS slope,
  coalesce(regr_intercept(y, i), avg(y)) AS intercept, max(us) AS last_us,
  coalesce(CAST(floor(median(gap)) AS BIGINT), 60000000) AS step_us FROM ranked GROUP BY coin_id""",
        "line": f"""SELECT coin_id, h AS step, make_timestamp(last_us + h * step_us) AS window_start,
  intercept + slope * (n - 1 + h) AS predicted_price, 'linear' AS method
  FROM steps, (SELECT unnest(range(1, 13)) AS h) WHERE {where}""",
    }


def _forecast_ar(source: str, order: str) -> dict[str, str]:
    """CTEs ending in ``path``: the autoregressive forecast, unrolled step by step."""
    order_of = f"OVER (PARTITION BY coin_id ORDER BY {order})"
    d = [f"lag({c}, {k}) {order_of} - lag({c}, {k + 1}) {order_of} AS d{n}{k}"
         for n, c in (("y", "value"), ("x", "volume")) for k in range(6)]
    sums = [f"coalesce(sum(d{a}0 * d{b}{k}), 0.0) AS {a}{b}{k}" for k in range(6) for a in "xy" for b in "xy"]
    newest = [f"coalesce(max(CASE WHEN back = 1 THEN d{n}{k} END), 0.0) AS l{n}{k}" for n in "xy" for k in range(5)]
    out = {
        "moves": f"""SELECT *, {', '.join(d)},
  row_number() OVER (PARTITION BY coin_id ORDER BY {", ".join(c.strip() + " DESC" for c in order.split(","))}) AS back FROM {source}""",
        "sums": f"SELECT coin_id, max(CASE WHEN back = 1 THEN value END) AS y, {', '.join(newest)}, {', '.join(sums)} FROM moves GROUP BY coin_id",
        "f0": "SELECT *, coalesce(xy0 / nullif(xx0, 0), 0.0) AS beta FROM sums",
    }
    previous = "f0"
    for again in range(4):
        if again:
            # Least squares on steps that the autoregression of the round before has whitened.
            f = ["1.0", *(f"-a5_{j}" for j in range(1, 6))]
            both = {pair: " + ".join(f"({f[i]}) * ({f[j]}) * {(pair if j >= i else back)}{abs(i - j)}" for i in range(6) for j in range(6))
                    for pair, back in (("xy", "yx"), ("xx", "xx"))}
            out[f"f{again}"] = f"""SELECT {', '.join(kept)}, coalesce(({both['xy']}) / nullif({both['xx']}, 0), beta) AS beta FROM {previous}"""
            previous = f"f{again}"
        kept = ["coin_id", "y", *(f"l{n}{k}" for n in "xy" for k in range(5)), *(f"{p}{q}{k}" for k in range(6) for p in "xy" for q in "xy")]
        out[f"q_{again}"] = f"SELECT {', '.join(kept)}, beta, " + ", ".join(
            f"yy{k} - beta * (xy{k} + yx{k}) + beta * beta * xx{k} AS q{k}" for k in range(6)) + f" FROM {previous}"
        out[f"a_{again}_0"] = f"SELECT {', '.join(kept)}, beta, " + ", ".join(f"ly{k} - beta * lx{k} AS d{k}" for k in range(5)) + ", " + ", ".join(
            f"CASE WHEN q0 <= yy0 * 1e-12 THEN 0.0 ELSE q{k} END AS r{k}" for k in range(6)
        ) + f", CASE WHEN q0 <= yy0 * 1e-12 THEN 0.0 ELSE q0 END AS e0 FROM q_{again}"
        previous = f"a_{again}_0"
        for m in range(1, 6):
            explained = "".join(f" - a{m - 1}_{j} * r{m - j}" for j in range(1, m))
            out[f"k_{again}_{m}"] = f"SELECT *, coalesce((r{m}{explained}) / nullif(e{m - 1}, 0), 0.0) AS k{m} FROM {previous}"
            updated = "".join(f", a{m - 1}_{j} - k{m} * a{m - 1}_{m - j} AS a{m}_{j}" for j in range(1, m))
            out[f"a_{again}_{m}"] = f"SELECT *{updated}, k{m} AS a{m}_{m}, e{m - 1} * (1 - k{m} * k{m}) AS e{m} FROM k_{again}_{m}"
            previous = f"a_{again}_{m}"
    past, level = [f"d{k}" for k in range(5)], "y"
    for h in range(1, 13):
        move = " + ".join(f"a5_{j} * {past[j - 1]}" for j in range(1, 6))
        out[f"s{h}"] = f"SELECT *, {move} AS s{h} FROM {previous}"
        out[f"p{h}"] = f"SELECT *, {level} + s{h} AS p{h} FROM s{h}"
        previous, past, level = f"p{h}", [f"s{h}", *past[:-1]], f"p{h}"
    cases = " ".join(f"WHEN {h} THEN p{h}" for h in range(1, 13))
    out["path"] = f"""SELECT p.coin_id, h AS step, make_timestamp(last_us + h * step_us) AS window_start,
  CASE h {cases} END AS predicted_price, 'ar' AS method
  FROM p12 p JOIN steps USING (coin_id), (SELECT unnest(range(1, 13)) AS h) WHERE n >= 10"""
    return out




def _filled(text: str, *numbers: str) -> str:
    """SQL for a text with its %s replaced by formatted numbers."""
    parts = text.split("%s")
    return " || ".join([f"'{parts[0]}'"] + [f"{n} || '{part}'" for n, part in zip(numbers, parts[1:])])


def _number(column: str, digits: int) -> str:
    return f"coalesce(printf('%.{digits}f', round({column}, 6)), 'nan')"


def _text_case(signal: str, numbers: dict[str, tuple[str, ...]], texts: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {_filled(text, *numbers.get(name, ()))}" for name, text in texts.items())
    return f"CASE {signal} {cases} END"


_RSI, _LAST = (_number("rsi", 1),), _number("last_value", 4)
_AVERAGES = (_number("sma_10", 4), _number("sma_20", 4))
_TEXTS = "SELECT coin_id, " + ", ".join([
    _text_case("rsi_signal", dict.fromkeys(RSI_TEXT, _RSI), RSI_TEXT) + " AS rsi_text",
    _text_case("bb_signal", {
        "Bearish (Overextended)": (_LAST, _number("bb_upper", 4)),
        "Bullish (Undervalued)": (_LAST, _number("bb_lower", 4)), "Neutral": (_LAST, _number("bb_middle", 4)),
    }, BAND_TEXT) + " AS bb_text",
    _text_case("ma_signal", {
        "Bullish (Uptrend)": (_LAST, *_AVERAGES), "Bearish (Downtrend)": (_LAST, *_AVERAGES), "Neutral": _AVERAGES,
    }, AVERAGE_TEXT) + " AS ma_text", "recommendation",
]) + " FROM rated"
_FORECAST_OUT = f"coin_id, CAST(step AS BIGINT) AS step, window_start, {r('predicted_price')}, method"
_LINE = _forecast_linear("hourly", "avg_price", "window_start", "window_start")
_SESSION = "TIMESTAMP '2024-01-30 12:00:00'"

_FRAME = """SELECT coin_id, max(window_start) AS last_at, count(*) AS rows,
  count(*) FILTER (NOT (coin_id = 'click' AND record_count = 1)) AS known,
  coalesce(floor(quantile_cont(step_us, 0.5)), 60000000) AS gap FROM (SELECT *,
  epoch_us(window_start) - lag(epoch_us(window_start)) OVER (PARTITION BY coin_id ORDER BY window_start) AS step_us FROM hourly) GROUP BY coin_id"""

ORACLES: dict[str, str] = {
    "scan_jsonl": sql(f"""SELECT coin_id, {r('TRY_CAST(price_usd AS DOUBLE)', 'price_usd')}, CAST(NULL AS DOUBLE) AS market_cap_usd,
 {rs('volume_24h_usd', 'change_24h_pct')}, CAST(NULL AS TIMESTAMP) AS last_updated, fetched_at FROM dirty"""),
    "flatten_snapshot": sql(f"""SELECT coin_id, {r("arg_max(price_usd, fetched_at)", "price_usd")}, CAST(NULL AS DOUBLE) AS market_cap_usd,
 {r("arg_max(volume_24h_usd, fetched_at)", "volume_24h_usd")}, CAST(NULL AS DOUBLE) AS change_24h_pct,
 date_trunc('hour', fetched_at) AS fetched_at FROM ticks GROUP BY coin_id, date_trunc('hour', ticks.fetched_at)"""),
    "bronze": sql(f"SELECT seq, coin_id, {rs('price_usd', 'change_24h_pct', 'volume_24h_usd')}, fetched_at FROM typed"),
    "silver": sql(f"SELECT seq, coin_id, fetched_at, {rs('price_usd', 'change_24h_pct', 'volume_24h_usd')}, data_quality_flag FROM silver"),
    "session_csv": sql(f"SELECT {_GOLD_OUT} FROM gold10"),
    "session_latest_500": sql(f"SELECT {_GOLD_OUT} FROM (SELECT * FROM gold10 ORDER BY window_start DESC, coin_id DESC LIMIT 500)"),
    "export_selected": sql(f"SELECT {_SERIES_OUT} FROM series WHERE coin_id IN ('click', 'view')"),
    "export_range": sql(f"""SELECT {_SERIES_OUT} FROM series WHERE coin_id IN ('click', 'view')
 AND ts >= (SELECT max(ts) FROM series) - INTERVAL 24 HOUR"""),
    "retention_filter": sql(f"""SELECT seq, coin_id, fetched_at, {r('price_usd')} FROM ticks
 WHERE fetched_at >= (SELECT max(fetched_at) FROM ticks) - INTERVAL 36 HOUR"""),
    "normalize_types": sql(f"""SELECT seq, coin_id, {r('TRY_CAST(price_usd AS DOUBLE)', 'price_usd')}, CAST(NULL AS DOUBLE) AS market_cap_usd,
 {rs('volume_24h_usd', 'change_24h_pct')}, fetched_at FROM dirty"""),
    "prepare_series": sql(f"""SELECT seq, coin_id, fetched_at, {rs('price_usd', 'volume_24h_usd', 'change_24h_pct')}
 FROM typed WHERE price_usd IS NOT NULL AND fetched_at IS NOT NULL"""),
    "canonical_series": sql(f"""SELECT coin_id, window_start AS ts, {r('avg_price', 'value')}, {r('avg_volume', 'volume')},
 {r('avg_change_pct', 'change')}, {r('max_price', 'high')}, {r('min_price', 'low')} FROM gold10"""),
    "tz_shift": sql("SELECT seq, coin_id, ts + INTERVAL 330 MINUTE AS local_ts FROM series"),
    "quality_flag": sql("SELECT data_quality_flag, count(*) AS rows FROM typed GROUP BY ALL"),
    "unknown_keys": sql(f"""SELECT DISTINCT coin AS coin_id FROM rules WHERE coin NOT IN ({', '.join(f"'{k}'" for k in KNOWN_COINS)})"""),
    "direction_label": sql(f"""SELECT CASE WHEN change_24h_pct >= 0 THEN 'up' ELSE 'down' END AS change_direction,
 {_UP.format('change_24h_pct')} AS volume_direction, count(*) AS rows FROM dirty GROUP BY ALL"""),
    "volatility_series": sql(f"SELECT coin_id, window_start, {r('price_volatility')} FROM hourly"),
    "volatility_series_silver": sql(f"SELECT coin_id, fetched_at, {r('volume_24h_usd', 'volume')} FROM ticks"),
    "json_records": sql("""SELECT '{"seq":' || seq || ',"time":"' || time || '","coin":"' || coin || '","type":"' || type ||
 '","message":"' || message || '"}' AS record FROM every""", every="""SELECT seq, strftime(fetched_at, '%H:%M:%S') AS time, upper(coin_id) AS coin,
  'price' AS type, upper(coin_id) || ' above 60.0' AS message FROM ticks"""),
    "dedup_first": sql(f"SELECT seq, coin_id, fetched_at, {r('price_usd')} FROM silver"),
    "select_keys": sql(f"SELECT seq, coin_id, ts, {r('value')} FROM series WHERE coin_id IN ('click', 'purchase')"),
    "trailing_range": sql(f"SELECT seq, coin_id, ts, {r('value')} FROM series WHERE ts >= (SELECT max(ts) FROM series) - INTERVAL 6 HOUR"),
    "session_range": sql(f"""SELECT seq, coin_id, ts, 'rows' AS kind FROM series WHERE ts >= (SELECT CASE WHEN max(ts) >= {_SESSION}
 THEN {_SESSION} ELSE max(ts) - INTERVAL 30 MINUTE END FROM series)
 UNION ALL SELECT seq, coin_id, ts, 'fallback' FROM series WHERE ts >= (SELECT max(ts) FROM series) - INTERVAL 30 MINUTE"""),
    "min_history": sql(f"""SELECT coin_id, ts, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {r('value', digits=TIED)}
 FROM (SELECT *, count(*) OVER (PARTITION BY coin_id) AS total FROM parts) WHERE total >= 30"""),
    "recent_20": sql(f"SELECT {_SERIES_OUT} FROM (SELECT * FROM series ORDER BY ts DESC, seq DESC LIMIT 20)"),
    "explorer_500": sql(f"""SELECT {_SERIES_OUT} FROM (SELECT * FROM series WHERE coin_id IN ('click', 'view', 'error')
 AND ts >= (SELECT max(ts) FROM series) - INTERVAL 24 HOUR ORDER BY ts DESC, seq DESC LIMIT 500)"""),
    "explorer_counts": sql("""SELECT least(count(*), 500) AS shown_rows, count(*) AS total_rows FROM series
 WHERE coin_id IN ('click', 'view', 'error') AND ts >= (SELECT max(ts) FROM series) - INTERVAL 24 HOUR"""),
    "ordinal": sql("SELECT coin_id, ts, seq, ordinal FROM placed"),
    "gold_10s": sql(f"SELECT {_GOLD_OUT} FROM gold", gold=_gold("silver", "10 seconds")),
    "gold_1h": sql(f"SELECT {_GOLD_OUT} FROM gold", gold=_gold("silver", "1 hour")),
    **{f"resample_{label}": sql(f"SELECT {_BIN_OUT} FROM bins", bins=_resample("gold10", width))
       for label, width in (("5m", "5 minutes"), ("15m", "15 minutes"), ("30m", "30 minutes"), ("1h", "1 hour"))},
    "overview": sql(f"""SELECT {_BIN_OUT}, CASE WHEN avg_change_pct >= 0 THEN 'up' ELSE 'down' END AS direction FROM bins
 WHERE coin_id IN ('click', 'view') AND window_start >= (SELECT max(window_start) FROM bins) - INTERVAL 24 HOUR""",
                    bins=_resample("gold10", "15 minutes")),
    "status_by_key": sql(f"""SELECT coin_id, count(*) AS records, {r('arg_max(value, (ts, seq))', 'latest')}, {r('avg(value)', 'avg')},
 {r('min(value)', 'min')}, {r('max(value)', 'max')}, {r('coalesce(sum(volume), 0)', 'volume')} FROM series GROUP BY coin_id"""),
    "freshness": sql("SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM series"),
    "layer_counts": sql("""SELECT (SELECT count(*) FROM gold) AS gold_rows, (SELECT count(*) FROM silver) AS silver_rows,
 (SELECT count(*) FROM (SELECT coin_id FROM gold UNION SELECT coin_id FROM silver)) AS keys, 'Gold' AS layer,
 (SELECT max(window_start) FROM gold) AS updated_at""",
                        gold=_gold("ticks", "1 hour")),
    "keys_union": sql("SELECT coin_id FROM gold10 UNION SELECT coin_id FROM silver"),
    "volume_total": sql(f"SELECT coin_id, {r('sum(volume)', 'total_volume')} FROM series GROUP BY coin_id HAVING sum(volume) IS NOT NULL"),
    **{name: sql(f"{_box('value')} FROM series GROUP BY coin_id") for name in ("price_distribution", "price_distribution_stored")},
    "returns_distribution": sql(
        f"{_box('x')} FROM recent GROUP BY coin_id",
        recent="""SELECT * FROM (SELECT coin_id, (value - previous) / nullif(previous, 0) * 100 AS x,
 row_number() OVER (PARTITION BY coin_id ORDER BY ts DESC, seq DESC) AS back
 FROM placed WHERE total >= 5 AND previous IS NOT NULL AND previous <> 0) WHERE back <= 50"""),
    "sampling_interval": sql("""SELECT coin_id, coalesce(CAST(floor(median(gap)) AS BIGINT), 60000000) AS step_micros FROM (
 SELECT coin_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY coin_id ORDER BY ts, seq) AS gap FROM series) GROUP BY coin_id"""),
    "correlation_matrix": sql(_correlation("cells"), cells="SELECT coin_id, ordinal AS at, value AS x FROM placed"),
    "correlation_time": sql(_correlation("cells"), cells="SELECT coin_id, time_bucket(INTERVAL '1 hour', ts) AS at, avg(value) AS x FROM series GROUP BY ALL"),
    **{f"sma_{w}": sql(f"SELECT coin_id, ts, seq, {r(_rolling('avg', 'value', w, 'ts, seq'), f'sma_{w}')} FROM series") for w in (10, 20)},
    "bollinger": sql(f"SELECT coin_id, ts, seq, {rs('bb_middle', 'bb_upper', 'bb_lower')} FROM panel", **_BY_SEQ),
    "rsi_14": sql(f"SELECT coin_id, ts, seq, {r('rsi_14')} FROM panel", **_BY_SEQ),
    "ohlc": sql(f"""SELECT coin_id, window_start, {rs('open', 'close')}, {r('greatest(max_price, open, close)', 'candle_high')},
 {r('least(min_price, open, close)', 'candle_low')} FROM panel""", **_BY_HOUR),
    "normalized_price": sql(f"""SELECT coin_id, ts, seq, {r('value / base * 100', 'normalized')} FROM (
 SELECT *, first_value(value) OVER (PARTITION BY coin_id ORDER BY ts, seq) AS base FROM placed) WHERE total >= 2 AND base <> 0"""),
    "returns_pct": sql(f"""SELECT coin_id, ts, {r('(value - previous) / previous * 100', 'return_pct')}
 FROM placed WHERE total >= 5 AND previous <> 0"""),
    "kpi_latest": sql(f"""SELECT coin_id, {r('value', 'last_value')}, {r('previous', 'previous_value')},
 {r('coalesce((value - previous) / nullif(previous, 0) * 100, 0.0)', 'change_pct')}
 FROM placed WHERE total >= 2 AND ordinal = total - 1"""),
    "latest_per_key": sql(f"""SELECT coin_id, ts, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {rs('value', 'volume', 'change', digits=TIED)}
 FROM (SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC) AS back FROM parts) WHERE back = 1"""),
    "period_change": sql(f"""SELECT coin_id, {r('first', 'first_value')}, {r('last', 'last_value')},
 {r('CASE WHEN n > 1 THEN (last - first) / nullif(first, 0) * 100 ELSE 0.0 END', 'change_pct')} FROM (SELECT coin_id, count(*) AS n,
 arg_min(value, (ts, seq)) AS first, arg_max(value, (ts, seq)) AS last FROM series GROUP BY coin_id)"""),
    "technical_panel": sql(
        f"SELECT coin_id, window_start, {_PANEL_OUT} FROM shown", **_BY_HOUR,
        shown=f"""SELECT *, greatest(max_price, open, close) AS candle_high, least(min_price, open, close) AS candle_low,
 {_UP.format('avg_change_pct')} AS volume_direction FROM panel WHERE total >= 5"""),
    "technical_panel_parts": sql(
        f"SELECT coin_id, ts, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {_PANEL_OUT_PARTS} FROM shown", **_BY_PART,
        shown=f"""SELECT *, greatest(open, close) AS candle_high, least(open, close) AS candle_low,
 {_UP.format('change')} AS volume_direction FROM panel WHERE total >= 5"""),
    "technical_summary": sql(f"SELECT coin_id, {r('last_value', 'current', 4, SHIFT)}, {r('rsi', None, 4, SHIFT)}, rsi_zone, {rs('bb_width', 'period_change_pct', digits=4, shift=SHIFT)} FROM labelled", **_BY_PART),
    "signals": sql(f"SELECT {_SIGNAL_OUT} FROM rated", **_BY_PART),
    "signals_hourly": sql(f"SELECT {_SIGNAL_OUT}, rsi_zone, {rs('bb_width', 'period_change_pct')} FROM rated", **_BY_HOUR),
    "signal_text": sql(_TEXTS, **_BY_HOUR),
    "alerts_fired": sql("SELECT id, '12:00:00' AS time, coin, type, message FROM fired"),
    "alerts_remove": sql(f"SELECT id, coin, type, condition, {r('threshold')}, active FROM rules WHERE id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')"),
    "alerts_add": sql(f"""SELECT id, coin, type, condition, {r('threshold')}, active FROM rules
 UNION ALL SELECT epoch_ms({_SESSION}), 'click', 'price', 'above', 70.5, true"""),
    "alert_suggested_threshold": sql(f"""SELECT coin AS coin_id, {r('round(coalesce(value, 0.0) * 1.1, 2)', 'price_threshold')}, 5.0::DOUBLE AS change_threshold
 FROM (SELECT DISTINCT coin FROM rules) LEFT JOIN latest ON coin = coin_id"""),
    "alert_history_50": sql("SELECT * FROM history ORDER BY seq DESC LIMIT 50"),
    "alert_last_3": sql("SELECT * FROM history ORDER BY seq DESC LIMIT 3"),
    "forecast_linear": sql(f"SELECT {_FORECAST_OUT} FROM line", **_LINE),
    "forecast_ar": sql(f"SELECT {_FORECAST_OUT} FROM path", **_forecast_linear("series", "value", "ts", "ts, seq"), **_forecast_ar("series", "ts, seq")),
    "forecast_ar_parts": sql(
        f"SELECT {_FORECAST_OUT} FROM (SELECT * FROM path UNION ALL SELECT * FROM line)",
        **_forecast_linear("parts", "value", "ts", "ts, l_orderkey, l_linenumber", "n < 10"),
        **_forecast_ar("parts", "ts, l_orderkey, l_linenumber")),
    "forecast_summary": sql(f"""SELECT coin_id, {rs('last_actual', 'last_forecast')}, {r('(last_forecast - last_actual) / nullif(last_actual, 0) * 100', 'change_pct')}
 FROM (SELECT coin_id, arg_max(avg_price, window_start) AS last_actual FROM hourly GROUP BY coin_id)
 JOIN (SELECT coin_id, predicted_price AS last_forecast FROM line WHERE step = 12) USING (coin_id)""", **_LINE),
    "actual_plus_forecast": sql(f"""SELECT coin_id, window_start, {r('avg_price', 'price')}, 'actual' AS kind FROM hourly
 UNION ALL SELECT coin_id, window_start, {r('predicted_price', 'price')}, 'forecast' FROM line""", **_LINE),
    "stream_dedup": sql(f"""SELECT coin_id, fetched_at, {rs('price_usd', 'change_24h_pct')},
 CASE WHEN change_24h_pct BETWEEN -100 AND 1000 THEN 'good' ELSE 'suspicious' END AS data_quality_flag FROM ticks WHERE price_usd > 0"""),
    "stream_gold": sql(f"SELECT {_GOLD_OUT} FROM gold", gold=_gold("ticks", "1 hour")),
    "stream_resample": sql(f"SELECT {_BIN_OUT} FROM hourly"),
    "stream_pipeline": sql(f"SELECT {_GOLD_OUT} FROM gold", gold=_gold("silver", "1 hour")),
    "cycle_incremental": sql(f"SELECT {_GOLD_OUT} FROM gold", gold=_gold("silver", "1 hour")),
    "cycle_widths": sql(f"""SELECT {_GOLD_OUT}, '7 minutes' AS width FROM narrow UNION ALL SELECT {_GOLD_OUT}, '2 days' AS width FROM wide""",
        narrow=_gold("silver", "7 minutes"), wide=_gold("silver", "2 days")),
    "cycle_log": sql("""SELECT batch_id, 'done' AS status, bronze_rows, silver_rows, gold_windows, CAST(NULL AS VARCHAR) AS error
  FROM (SELECT part AS batch_id, count(*) AS bronze_rows FROM (SELECT *, %(part)s AS part FROM dirty, span) GROUP BY part)
  JOIN (SELECT part AS batch_id, count(*) AS silver_rows, count(DISTINCT (coin_id, time_bucket(INTERVAL '1 hour', fetched_at)))
    FILTER (fetched_at IS NOT NULL) AS gold_windows FROM (SELECT *, %(part)s AS part FROM silver, span) GROUP BY part) USING (batch_id)
  UNION ALL SELECT 2, 'idle', 0, 0, 0, NULL""" % {"part": "CAST(coalesce((epoch_us(fetched_at) - low) * 2 // (high - low + 1), 0) AS BIGINT)"},
        span="SELECT epoch_us(min(fetched_at)) AS low, epoch_us(max(fetched_at)) AS high FROM ticks"),
    "layer_freshness": sql("SELECT min(fetched_at) AS first_ts, max(fetched_at) AS last_ts FROM ticks"),
    "layer_trailing_range": sql(f"""SELECT coin_id, fetched_at, {r('price_usd')} FROM ticks
  WHERE fetched_at >= (SELECT max(fetched_at) FROM ticks) - INTERVAL 6 HOUR"""),
    "layer_sizes": sql("""SELECT 'silver' AS layer, count(*) AS rows, count(DISTINCT CAST(fetched_at AS DATE)) AS dates FROM ticks
  UNION ALL SELECT 'gold', count(*), count(DISTINCT CAST(window_start AS DATE)) FROM gold""", gold=_gold("ticks", "1 hour")),
    "rules_saved": sql(f"""SELECT id, coin, type, condition, {r('threshold')}, active FROM (SELECT * FROM rules
 UNION ALL SELECT epoch_ms({_SESSION}), 'click', 'price', 'above', 70.5, true)
 WHERE id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')"""),
    **{name: sql(f"SELECT coin_id, fetched_at, {rs('price_usd', 'change_24h_pct', 'volume_24h_usd')}, data_quality_flag FROM silver")
       for name in ("stream_silver", "raw_arrival")},
    "alerts_store": sql(f"SELECT id, coin, type, condition, {r('threshold')}, active FROM rules"),
    "layer_drift": sql(f"""SELECT coin_id, fetched_at, {r('price_usd')},
 {r('CASE WHEN seq % 2 = 1 THEN volume_24h_usd END', 'volume_24h_usd')} FROM ticks"""),
    "correlation_12": sql(_correlation("cells"), cells="""SELECT CAST(l_suppkey % 12 AS VARCHAR) AS coin_id,
 avg(l_extendedprice / l_quantity) AS x, CAST(l_shipdate AS DATE) AS at FROM lineitem GROUP BY ALL"""),
    "forecast_seasonal_frame": sql("""SELECT coin_id, CAST(step AS BIGINT) AS step, last_at + to_microseconds(CAST(step * gap AS BIGINT)) AS window_start,
 CASE WHEN rows >= 10 AND known = rows THEN 'seasonal' ELSE 'linear' END AS method FROM frame, range(1, 13) AS s(step)""",
        frame=_FRAME),
    "forecast_seasonal_line": sql(f"""SELECT coin_id, CAST(step AS BIGINT) AS step, last_at + to_microseconds(CAST(step * gap AS BIGINT)) AS window_start,
 {r('0.25 * ((epoch_us(last_at) + step * gap) / 3.6e9 - 473352.0) + length(coin_id)', 'predicted_price', digits=4)}, 'seasonal' AS method
 FROM frame, range(1, 13) AS s(step)""", frame=_FRAME),
    "stream_alerts": sql("SELECT id, coin, type, message FROM fired"),
    "stream_dedup_first": sql(f"SELECT coin_id, fetched_at, {rs('price_usd', 'change_24h_pct', 'volume_24h_usd')}, data_quality_flag FROM silver WHERE fetched_at IS NOT NULL"),
    "bucketed_panel": sql(f"SELECT coin_id, ts AS fetched_at, seq, {rs('sma_10', 'sma_20', 'bb_upper', 'bb_lower', 'rsi_14')} FROM panel", **_BY_SEQ),
    "stream_indicators": sql(f"SELECT coin_id, ts AS fetched_at, {rs('sma_10', 'sma_20', 'bb_upper', 'bb_lower', 'rsi_14')} FROM panel", **_BY_SEQ),
}
