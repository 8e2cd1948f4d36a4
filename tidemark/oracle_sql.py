"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code: plain windows over the whole key,
``range`` grids and ``ASOF`` joins, i.e. the straightforward formulation the
Spark plans must agree with. Views available: the driver's test tables.
"""

from __future__ import annotations

from collections.abc import Sequence

# --- shared CTE builders -------------------------------------------------------------------

Q_CTE = """q AS (
  SELECT 'SIM' AS exchange, event_type AS symbol, event_id AS seq, ts AS time,
         value AS bid_price, value * 1.001 AS ask_price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS bid_qty,
         100.0 - CAST(json_extract_string(props, '$.k') AS DOUBLE) AS ask_qty
  FROM events)"""

KEYS = "exchange, symbol"
ROUND_DIGITS = 8
PART = "PARTITION BY exchange, symbol"


def rnd(expr: str, name: str) -> str:
    d = 4 if "var" in name else (6 if "std" in name else ROUND_DIGITS)
    return f"(floor((({expr}) + 3.14159e-8) * 1e{d} + 0.5) / 1e{d})"


def r6(cols: Sequence[str]) -> str:
    return ", ".join(f"{rnd(c, c)} AS {c}" for c in cols)


def nn(cols: Sequence[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def grid_ctes(freq: int, cols: Sequence[str], min_rows: int | None = None, fill: str = "bfill",
              name: str = "grid") -> str:
    """CTEs q, b (bucket last non-null), {name} (dense, filled) as a WITH-list body."""
    aggs = ", ".join(f"arg_max({c}, (time, seq)) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in cols)
    guard = f"WHERE (hi - lo) / {freq} + 1 >= {min_rows}" if min_rows is not None else ""
    if fill == "bfill":
        order = "ORDER BY g0.g DESC"
    else:
        order = "ORDER BY g0.g"
    if fill == "none":
        filled = ", ".join(f"b.{c} AS {c}" for c in cols)
    else:
        filled = ", ".join(
            f"last_value(b.{c} IGNORE NULLS) OVER (PARTITION BY g0.exchange, g0.symbol {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in cols)
    return f"""{Q_CTE},
b AS (SELECT exchange, symbol, CAST(floor(epoch(time) / {freq}) AS BIGINT) * {freq} AS g, {aggs}
      FROM q GROUP BY ALL),
rng AS (SELECT exchange, symbol, min(g) AS lo, max(g) AS hi FROM b GROUP BY ALL),
g0 AS (SELECT exchange, symbol, unnest(range(lo, hi + 1, {freq})) AS g FROM rng {guard}),
{name} AS (SELECT g0.exchange, g0.symbol, g0.g, {filled}
      FROM g0 LEFT JOIN b ON g0.exchange = b.exchange AND g0.symbol = b.symbol AND g0.g = b.g)"""


def frame(seconds: int) -> str:
    return f"({PART} ORDER BY g RANGE BETWEEN {int(seconds) - 1} PRECEDING AND CURRENT ROW)"


def ordw() -> str:
    return f"({PART} ORDER BY g)"


def label(shift: int, pct: float, bid: str = "bid_price", ask: str = "ask_price") -> str:
    return (f"CASE WHEN lead({bid}, {shift}) OVER {ordw()} - ({ask} + {ask} * {pct}) > 0 THEN 1 ELSE 0 END")


def coeff(q25: str, q75: str) -> str:
    return f"CASE WHEN ({q75}) + ({q25}) = 0 THEN NULL ELSE (({q75}) - ({q25})) / (({q75}) + ({q25})) END"


def div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END"


def mp(expr: str, c: str, w: str, k: int) -> str:
    if k <= 1:
        return expr
    return f"CASE WHEN count({c}) OVER {w} >= {k} THEN {expr} END"


def metric(c: str, m: str, w: str, k: int = 1) -> str:
    if m == "rolling_mean" or m == "rolling_mavg":
        return mp(f"avg({c}) OVER {w}", c, w, k)
    if m == "rolling_var":
        return mp(f"var_samp({c}) OVER {w}", c, w, k)
    if m == "rolling_min":
        return mp(f"min({c}) OVER {w}", c, w, k)
    if m == "rolling_max":
        return mp(f"max({c}) OVER {w}", c, w, k)
    if m == "rolling_open":
        return mp(f"first_value({c}) OVER {w}", c, w, k)
    if m == "rolling_close":
        return mp(f"last_value({c}) OVER {w}", c, w, k)
    if m == "rolling_coeff":
        q25 = mp(f"quantile_cont({c}, 0.25) OVER {w}", c, w, k)
        q75 = mp(f"quantile_cont({c}, 0.75) OVER {w}", c, w, k)
        return coeff(q25, q75)
    raise ValueError(m)


# --- per-query SQL ---------------------------------------------------------------------------

from tidemark.registry import P  # noqa: E402  (parameters only)

QC = ("bid_price", "ask_price", "bid_qty", "ask_qty")
BA = ("bid_price", "ask_price")
FREQ = P["freq"]


def _select(cte: str, body: str, cols: Sequence[str], extra_int: Sequence[str] = ()) -> str:
    ints = "".join(f", {c}" for c in extra_int)
    return f"WITH {cte},\nf AS ({body})\nSELECT exchange, symbol, g, {r6(cols)}{ints} FROM f WHERE {nn(list(cols) + list(extra_int))}"


def sql_resample(fill: str) -> str:
    return f"WITH {grid_ctes(FREQ, QC, fill=fill)}\nSELECT exchange, symbol, g, {r6(QC)} FROM grid"


def sql_asof_next() -> str:
    cols = ", ".join(f"r.{c} AS {c}" for c in QC)
    return f"""WITH {Q_CTE},
rng AS (SELECT exchange, symbol, CAST(floor(epoch(min(time)) / {FREQ}) AS BIGINT) * {FREQ} AS lo,
               CAST(floor(epoch(max(time)) / {FREQ}) AS BIGINT) * {FREQ} AS hi FROM q GROUP BY ALL),
g0 AS (SELECT exchange, symbol, unnest(range(lo, hi + 1, {FREQ})) AS g FROM rng),
g1 AS (SELECT exchange, symbol, g, make_timestamp(g * 1000000) AS t FROM g0),
j AS (SELECT g1.exchange, g1.symbol, g1.g, {cols}
      FROM g1 ASOF LEFT JOIN q r ON g1.exchange = r.exchange AND g1.symbol = r.symbol AND r.time >= g1.t)
SELECT exchange, symbol, g, {r6(QC)} FROM j WHERE {nn(QC)}"""


def sql_candles() -> str:
    f = P["candle_freq"]
    return f"""WITH {Q_CTE}
SELECT exchange, symbol, CAST(floor(epoch(time) / {f}) AS BIGINT) * {f} AS g,
  {rnd("arg_min(bid_price, (time, seq)) FILTER (WHERE bid_price IS NOT NULL)", "open")} AS open,
  {rnd("max(bid_price)", "high")} AS high, {rnd("min(bid_price)", "low")} AS low,
  {rnd("arg_max(bid_price, (time, seq)) FILTER (WHERE bid_price IS NOT NULL)", "close")} AS close,
  count(bid_price) AS n
FROM q GROUP BY ALL"""


def sql_ohlc() -> str:
    w = frame(P["window"])
    guard = P["window"] // FREQ + P["shift"]
    body = f"""SELECT exchange, symbol, g,
  first_value(bid_price) OVER {w} AS open, last_value(bid_price) OVER {w} AS close,
  min(bid_price) OVER {w} AS low, max(bid_price) OVER {w} AS high,
  {label(P['shift'], P['pct'])} AS profit,
  avg(bid_price) OVER {w} AS rolling_mean, var_samp(bid_price) OVER {w} AS rolling_var,
  {metric('bid_price', 'rolling_coeff', w)} AS rolling_coeff
  FROM grid"""
    return _select(grid_ctes(FREQ, BA, guard), body,
                   ["open", "close", "low", "high", "rolling_mean", "rolling_var", "rolling_coeff"], ["profit"])


def sql_quantile_coefficient() -> str:
    w = frame(P["long_window"])
    guard = P["long_window"] // FREQ + P["shift"]
    body = f"""SELECT exchange, symbol, g, bid_price, ask_price,
  avg(bid_price) OVER {w} AS rolling_mean, var_samp(bid_price) OVER {w} AS rolling_var,
  {metric('bid_price', 'rolling_coeff', w)} AS rolling_coeff,
  {label(P['shift'], P['pct'])} AS profit
  FROM grid"""
    return _select(grid_ctes(FREQ, BA, guard), body,
                   ["bid_price", "ask_price", "rolling_mean", "rolling_var", "rolling_coeff"], ["profit"])


def sql_all_fields() -> str:
    w = frame(P["window"])
    means = ", ".join(f"avg({c}) OVER {w} AS {c}_rolling_mean" for c in QC)
    body = f"""SELECT exchange, symbol, g, {', '.join(QC)}, {means},
  {label(P['shift'], P['pct'])} AS profit FROM grid"""
    diffs = ", ".join(f"{c} - {c}_rolling_mean AS {c}_mean_diff" for c in QC)
    body = f"SELECT *, {diffs} FROM ({body})"
    cols = list(QC) + [f"{c}_rolling_mean" for c in QC] + [f"{c}_mean_diff" for c in QC]
    return _select(grid_ctes(FREQ, QC, P["all_fields_guard"]), body, cols, ["profit"])


def sql_cross_moving_average() -> str:
    guard = P["cma_max"] // FREQ + P["cma_shift"]
    body = f"""SELECT exchange, symbol, g, bid_price, ask_price,
  avg(bid_price) OVER {frame(P['cma_min'])} - avg(bid_price) OVER {frame(P['cma_max'])} AS signal,
  {label(P['cma_shift'], P['pct'])} AS profit FROM grid"""
    return _select(grid_ctes(FREQ, BA, guard), body, ["bid_price", "ask_price", "signal"], ["profit"])


def sql_moving_average_candles() -> str:
    w = frame(P["mac_window"])
    k = P["mac_window"] // FREQ
    guard = k + P["mac_shift"]
    sig = mp(f"avg(bid_price) OVER {w} - lag(bid_price, {P['mac_candle'] - 1}) OVER {ordw()}", "bid_price", w, k)
    body = f"""SELECT exchange, symbol, g, bid_price, ask_price, {sig} AS signal,
  {label(P['mac_shift'], 0.0)} AS profit FROM grid"""
    return _select(grid_ctes(FREQ, BA, guard), body, ["bid_price", "ask_price", "signal"], ["profit"])


def sql_moving_average_pattern() -> str:
    w = frame(P["mac_window"])
    k = P["mac_window"] // FREQ
    guard = k + P["mac_shift"]
    offs = P["map_offsets"]

    def x(o):
        return "bid_price" if o == 1 else f"lag(bid_price, {o - 1}) OVER {ordw()}"

    n = len(offs) - 1
    bits = " + ".join(f"(CASE WHEN {x(offs[i])} > {x(offs[i + 1])} THEN {1 << (n - 1 - i)} ELSE 0 END)"
                      for i in range(n))
    sig = mp(f"({bits})", "bid_price", w, k)
    body = f"""SELECT exchange, symbol, g, bid_price, ask_price, {sig} AS signal,
  {label(P['mac_shift'], 0.0)} AS profit FROM grid"""
    return _select(grid_ctes(FREQ, BA, guard), body, ["bid_price", "ask_price"], ["signal", "profit"])


def sql_moving_average_shift() -> str:
    w = frame(P["long_window"])
    s = P["shift"]
    guard = P["long_window"] // FREQ + s
    body = f"""SELECT exchange, symbol, g, bid_price, ask_price,
  lag(bid_price, {s}) OVER {ordw()} AS bid_price_open, lead(bid_price, {s}) OVER {ordw()} AS bid_price_close,
  lag(ask_price, {s}) OVER {ordw()} AS ask_price_open, lead(ask_price, {s}) OVER {ordw()} AS ask_price_close,
  avg(bid_price) OVER {w} AS bid_price_rolling_mavg, var_samp(bid_price) OVER {w} AS bid_price_rolling_var,
  {metric('bid_price', 'rolling_coeff', w)} AS bid_price_rolling_coeff FROM grid"""
    body = f"""SELECT *, {div('bid_price - bid_price_open', 'bid_price_open')} AS bid_price_actual_pct_change,
  {div('ask_price - ask_price_open', 'ask_price_open')} AS ask_price_actual_pct_change,
  CASE WHEN bid_price_close IS NULL THEN NULL WHEN bid_price_close - ask_price > 0 THEN 1 ELSE 0 END
    AS bid_price_next_pct_change FROM ({body})"""
    cols = ["bid_price", "ask_price", "bid_price_open", "bid_price_close", "ask_price_open", "ask_price_close",
            "bid_price_rolling_mavg", "bid_price_rolling_var", "bid_price_rolling_coeff",
            "bid_price_actual_pct_change", "ask_price_actual_pct_change"]
    return _select(grid_ctes(FREQ, BA, guard), body, cols, ["bid_price_next_pct_change"])


def sql_return_candles() -> str:
    s = P["rc_step"]
    o = ordw()
    parts = [f"{div(f'bid_price - lag(bid_price, {s}) OVER {o}', f'lag(bid_price, {s}) OVER {o}')} AS bid_price_candle_1"]
    for k in range(2, 9):
        den = f"lag(ask_price, {k * s}) OVER {o}"
        parts.append(f"{div(f'lag(bid_price, {(k - 1) * s}) OVER {o} - {den}', den)} AS bid_price_candle_{k}")
    ret = div(f"lead(bid_price, {s}) OVER {o} - ask_price", "ask_price")
    body = f"""SELECT exchange, symbol, g, bid_price, ask_price, {', '.join(parts)},
  CASE WHEN {ret} > 0 THEN 1 ELSE 0 END AS next_profit FROM grid"""
    cols = ["bid_price", "ask_price"] + [f"bid_price_candle_{k}" for k in range(1, 9)]
    return _select(grid_ctes(FREQ, BA, P["rc_guard"]), body, cols, ["next_profit"])


METRICS7 = ("rolling_mean", "rolling_var", "rolling_coeff", "rolling_min", "rolling_max", "rolling_open",
            "rolling_close")


def _rolling_sql(features: Sequence[str], grid_cols: Sequence[str], window: int | None = None) -> str:
    w = frame(window or P["window"])
    k = P["min_periods"]
    sel, cols = [], []
    for feat in features:
        if "." not in feat:
            sel.append(feat)
            cols.append(feat)
            continue
        c, m = feat.split(".")
        sel.append(f"{metric(c, m, w, k)} AS {c}_{m}")
        cols.append(f"{c}_{m}")
    pct = div(f"lead(bid_price, {P['shift']}) OVER {ordw()} - (ask_price + ask_price * 0.001)", "ask_price")
    body = f"SELECT exchange, symbol, g, {', '.join(sel)}, {pct} AS profit_pct FROM grid"
    body = f"SELECT *, CASE WHEN profit_pct IS NULL THEN NULL ELSE CAST(profit_pct > 0 AS INTEGER) END AS profit_sign FROM ({body})"
    return _select(grid_ctes(FREQ, grid_cols), body, cols + ["profit_pct"], ["profit_sign"])


def sql_rolling_all_fields() -> str:
    return _rolling_sql([f"{c}.{m}" for c in QC for m in METRICS7], QC)


def sql_rolling_data() -> str:
    feats = P["rolling_data_features"]
    cols = sorted({f.split(".")[0] for f in feats} | {"bid_price", "ask_price"})
    return _rolling_sql(feats, cols, P["long_window"])


SQL = {
    "resample_last": sql_resample("bfill"),
    "resample_ffill": sql_resample("ffill"),
    "resample_asof_next": sql_asof_next(),
    "candles": sql_candles(),
    "ohlc": sql_ohlc(),
    "quantile_coefficient": sql_quantile_coefficient(),
    "all_fields": sql_all_fields(),
    "cross_moving_average": sql_cross_moving_average(),
    "moving_average_candles": sql_moving_average_candles(),
    "moving_average_pattern": sql_moving_average_pattern(),
    "moving_average_shift": sql_moving_average_shift(),
    "return_candles": sql_return_candles(),
    "rolling_all_fields": sql_rolling_all_fields(),
    "rolling_data": sql_rolling_data(),
}


# --- quality / cleaning ---------------------------------------------------------------------

QALL = ("bid_price", "ask_price", "bid_qty", "ask_qty")


def sql_dedupe_seq() -> str:
    return f"""WITH {Q_CTE}
SELECT exchange, symbol, seq, {r6(QALL)}, epoch_us(time) AS time_us FROM q
QUALIFY row_number() OVER (PARTITION BY exchange, symbol, seq
  ORDER BY time DESC, bid_price DESC, ask_price DESC, bid_qty DESC, ask_qty DESC) = 1"""


def sql_dedupe_rows() -> str:
    return f"""WITH {Q_CTE}
SELECT exchange, symbol, {r6(QALL)}, max(epoch_us(time)) AS time_us FROM q
GROUP BY exchange, symbol, bid_price, ask_price, bid_qty, ask_qty"""


def sql_seq_gaps() -> str:
    return f"""WITH {Q_CTE},
p AS (SELECT exchange, symbol, seq, lag(seq) OVER ({PART} ORDER BY time, seq) AS seq_previous, epoch_us(time) AS time_us FROM q)
SELECT exchange, symbol, seq, CAST(seq_previous AS DOUBLE) AS seq_previous, time_us FROM p
WHERE seq - 1 IS DISTINCT FROM seq_previous"""


def sql_coverage_map() -> str:
    return f"""WITH {Q_CTE}
SELECT DISTINCT exchange, symbol, exchange || '_' || symbol AS instrument, strftime(time, '%Y%m%d') AS date,
  strftime(time, '%U') AS week, 'OK' AS status FROM q"""


def sql_missing_partitions() -> str:
    return f"""WITH {Q_CTE},
cov AS (SELECT DISTINCT exchange, symbol, strftime(time, '%Y%m%d') AS date FROM q),
inst AS (SELECT DISTINCT exchange, symbol FROM cov),
days AS (SELECT DISTINCT date FROM cov)
SELECT i.exchange, i.symbol, d.date FROM inst i CROSS JOIN days d
WHERE NOT EXISTS (SELECT 1 FROM cov c WHERE c.exchange = i.exchange AND c.symbol = i.symbol AND c.date = d.date)"""


def sql_feed_dates() -> str:
    return f"""WITH {Q_CTE}
SELECT exchange, symbol, epoch_us(min(time) FILTER (WHERE bid_price IS NOT NULL)) AS first_us,
  epoch_us(max(time) FILTER (WHERE bid_price IS NOT NULL)) AS last_us FROM q GROUP BY ALL"""


def sql_null_profile() -> str:
    cols = ["exchange", "symbol", "seq", "time", "bid_price", "ask_price", "bid_qty", "ask_qty"]
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) AS non_null, count(*) - count({c}) AS nulls, count(*) AS rows FROM q"
        for c in cols)
    return f"WITH {Q_CTE}\n{parts}"


LI = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LI_DS = """ds AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem)"""


def sql_clean_numeric() -> str:
    cond = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c}) AND NOT isinf({c})" for c in LI)
    return f"WITH {LI_DS}\nSELECT l_orderkey, l_linenumber, {r6(LI)}, label FROM ds WHERE {cond}"


def sql_length_guard() -> str:
    return f"""WITH {Q_CTE}
SELECT exchange, symbol, seq, {r6(QALL)}, epoch_us(time) AS time_us FROM q
QUALIFY count(*) OVER ({PART}) >= {P['guard_rows']}"""


def sql_label_encode() -> str:
    return """SELECT event_id, event_type, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS event_type_index
FROM events"""


# --- patterns -------------------------------------------------------------------------------

def _offsets() -> list[int]:
    return [1] + [(i + 1) * P["pat_step"] for i in range(P["pat_samples"])]


def _x(o: int) -> str:
    return "bid_price" if o == 1 else f"lag(bid_price, {o - 1}) OVER {ordw()}"


def _hexchar(nib: str) -> str:
    return f"substr('0123456789abcdef', CAST(({nib}) AS INTEGER) + 1, 1)"


# Doubles times 2^60 are whole numbers for the prices at hand, so sums and comparisons are exact.
EXACT = "CAST({} * 1152921504606846976.0 AS HUGEINT)"


def _signature(kind: str, window: int) -> str:
    """``x > mean`` as count * x > sum and ``x > median`` as 2 x > lower + upper middle value."""
    w = frame(window)
    k = window // FREQ
    mid = [f"list_sort(list({EXACT.format('bid_price')}) OVER {w})[{i}]" for i in ((k + 1) // 2, k // 2 + 1)]
    chars = []
    for o in _offsets():
        x = EXACT.format(f"({_x(o)})")
        a = f"(CASE WHEN {x} * {k} > sum({EXACT.format('bid_price')}) OVER {w} THEN 1 ELSE 0 END)"
        m = f"(CASE WHEN {x} * 2 > {mid[0]} + {mid[1]} THEN 1 ELSE 0 END)"
        if kind == "mean":
            nib = f"{a} * 8 + 7"
        elif kind == "median":
            nib = f"{m} * 8 + 7"
        else:
            nib = f"{a} * 8 + {m} * 4 + 3"
        chars.append(_hexchar(nib))
    return f"CASE WHEN count(bid_price) OVER {w} >= {k} THEN ltrim(concat({', '.join(chars)}), '0') END"


def _pattern_table_sql(kind: str, window: int | None = None) -> str:
    return f"""WITH {grid_ctes(FREQ, BA)},
pt AS (SELECT exchange, symbol, g, bid_price, ask_price, {_signature(kind, window or P['window'])} AS pattern,
  {label(P['shift'], 0.0)} AS profit FROM grid)"""


def sql_pattern(kind: str, window: int | None = None) -> str:
    return (_pattern_table_sql(kind, window) + f"\nSELECT exchange, symbol, g, {r6(BA)}, pattern, profit FROM pt "
            f"WHERE {nn(['bid_price', 'ask_price', 'pattern'])}")


def sql_pattern_ohlc() -> str:
    c = P["pat_candle"]
    n = P["pat_candles"]
    cw = "(PARTITION BY exchange, symbol ORDER BY cb)"
    gts = ", ".join(f"lag(CASE WHEN open > close THEN 1 ELSE 0 END, {k - 1}) OVER {cw} AS gt_{k}" for k in range(2, n + 1))
    chars = [_hexchar("(CASE WHEN open > bid_price THEN 1 ELSE 0 END) * 12 + 3")]
    chars += [_hexchar(f"gt_{k} * 12 + 3") for k in range(2, n + 1)]
    return f"""WITH {grid_ctes(FREQ, BA)},
g2 AS (SELECT *, CAST(floor(g / {c}) AS BIGINT) * {c} AS cb FROM grid),
cand AS (SELECT exchange, symbol, cb, arg_min(bid_price, g) AS open, arg_max(bid_price, g) AS close FROM g2 GROUP BY ALL),
cl AS (SELECT exchange, symbol, cb, open, {gts} FROM cand),
j AS (SELECT g2.exchange, g2.symbol, g2.g, g2.bid_price, g2.ask_price,
  CASE WHEN gt_{n} IS NOT NULL THEN ltrim(concat({', '.join(chars)}), '0') END AS pattern
  FROM g2 JOIN cl ON g2.exchange = cl.exchange AND g2.symbol = cl.symbol AND g2.cb = cl.cb),
pt AS (SELECT *, {label(P['shift'], 0.0)} AS profit FROM j)
SELECT exchange, symbol, g, {r6(BA)}, pattern, profit FROM pt WHERE pattern IS NOT NULL"""


def _score_sql() -> str:
    return f"""sc AS (SELECT exchange, symbol, pattern, avg(CAST(profit AS DOUBLE)) AS score, count(*) AS count
  FROM pt WHERE {nn(['bid_price', 'ask_price', 'pattern'])} GROUP BY ALL
  HAVING avg(CAST(profit AS DOUBLE)) > {P['pat_threshold']} AND count(*) > 1)"""


def sql_pattern_score() -> str:
    return _pattern_table_sql("mean") + f",\n{_score_sql()}\nSELECT exchange, symbol, pattern, {r6(['score'])}, count FROM sc"


def sql_pattern_match() -> str:
    return _pattern_table_sql("mean") + f""",
{_score_sql()},
buy AS (SELECT DISTINCT exchange, symbol, pattern FROM sc WHERE score = 1.0)
SELECT pt.exchange, pt.symbol, pt.g, {', '.join(rnd('pt.' + c, c) + ' AS ' + c for c in BA)}, pt.pattern, pt.profit,
  CASE WHEN buy.pattern IS NULL THEN 0 ELSE 1 END AS signal
FROM pt LEFT JOIN buy ON pt.exchange = buy.exchange AND pt.symbol = buy.symbol AND pt.pattern = buy.pattern
WHERE pt.bid_price IS NOT NULL AND pt.ask_price IS NOT NULL AND pt.pattern IS NOT NULL"""


# --- portfolio ------------------------------------------------------------------------------

INSTRUMENTS = ("SIM_click", "SIM_error", "SIM_purchase", "SIM_signup", "SIM_view")


def _returns_cte() -> str:
    w = P["ret_window"]
    o = ordw()
    fee = f"(lag(ask_price, {w}) OVER {o} - lag(bid_price, {w}) OVER {o}) + (ask_price - bid_price)"
    ret = div(f"lag(bid_price, {w}) OVER {o} - ask_price - ({fee})", "ask_price")
    return f"""{grid_ctes(FREQ, BA)},
rt AS (SELECT exchange, symbol, exchange || '_' || symbol AS instrument, g, {ret} AS ret FROM grid)"""


def _merged_cte() -> str:
    cols = ", ".join(f"first(ret) FILTER (WHERE instrument = '{i}') AS {i}" for i in INSTRUMENTS)
    return f"""{_returns_cte()},
wide AS (SELECT g, {cols} FROM rt GROUP BY g),
mg AS (SELECT * FROM wide WHERE {nn(INSTRUMENTS)})"""


def sql_returns() -> str:
    return f"WITH {_returns_cte()}\nSELECT exchange, symbol, instrument, g, {r6(['ret'])} FROM rt"


def sql_merge_returns() -> str:
    return f"WITH {_merged_cte()}\nSELECT g, {r6(INSTRUMENTS)} FROM mg"


def sql_correlation() -> str:
    parts = []
    for a in INSTRUMENTS:
        for b in INSTRUMENTS:
            if a == b:
                parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {rnd('1.0', 'corr')} AS corr")
            else:
                parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'corr({a}, {b})', 'corr')} AS corr FROM mg")
    return f"WITH {_merged_cte()}\n" + " UNION ALL ".join(parts)


def sql_portfolio() -> str:
    names = ", ".join(f"('{i}')" for i in INSTRUMENTS)
    inst_cols = ", ".join(f"'{i}'" for i in INSTRUMENTS)
    return f"""WITH {_merged_cte()},
inst(name) AS (VALUES {names}),
perm AS (SELECT a.name AS p1, b.name AS p2, c.name AS p3 FROM inst a, inst b, inst c
         WHERE a.name <> b.name AND a.name <> c.name AND b.name <> c.name),
lng AS (UNPIVOT mg ON {', '.join(INSTRUMENTS)} INTO NAME name VALUE ret),
pr AS (SELECT p1 || '_' || p2 || '_' || p3 AS portfolio, l.g, sum(l.ret) AS r
       FROM perm JOIN lng l ON l.name IN (p1, p2, p3) GROUP BY ALL),
st AS (SELECT portfolio, avg(r) / stddev_samp(r) * sqrt(count(*)) AS sharpe_ratio, sum(r) AS total,
       count(*) FILTER (WHERE r >= 0) * 1.0 / count(*) * 100.0 AS pct_win FROM pr GROUP BY portfolio)
SELECT portfolio, {r6(['sharpe_ratio', 'total', 'pct_win'])} FROM st"""


# --- reports --------------------------------------------------------------------------------

PRED = "pred AS (SELECT doc_id, quality AS actual, 1 - toxic AS predicted FROM labels)"


def sql_confusion_margins() -> str:
    return f"""WITH {PRED}
SELECT CASE WHEN grouping(actual) = 1 THEN 'All' ELSE CAST(actual AS VARCHAR) END AS actual,
       CASE WHEN grouping(predicted) = 1 THEN 'All' ELSE CAST(predicted AS VARCHAR) END AS predicted,
       count(*) AS count
FROM pred GROUP BY CUBE (actual, predicted)"""


def _cc() -> str:
    return f"""{PRED},
cls AS (SELECT actual AS label FROM pred UNION SELECT predicted FROM pred),
cc AS (SELECT label,
  count(*) FILTER (WHERE actual = label AND predicted = label) AS tp,
  count(*) FILTER (WHERE actual <> label AND predicted = label) AS fp,
  count(*) FILTER (WHERE actual = label AND predicted <> label) AS fn,
  count(*) FILTER (WHERE actual = label) AS support,
  count(*) AS n
  FROM cls, pred GROUP BY label)"""


def sql_classification_report() -> str:
    z = "coalesce({}, 0.0)"
    pre = z.format(div("tp * 1.0", "tp + fp"))
    rec = z.format(div("tp * 1.0", "tp + fn"))
    return f"""WITH {_cc()},
per AS (SELECT CAST(label AS VARCHAR) AS label, {pre} AS precision, {rec} AS recall, support, tp, n FROM cc),
per2 AS (SELECT *, coalesce({div('2 * precision * recall', 'precision + recall')}, 0.0) AS f1_score FROM per),
tot AS (SELECT sum(tp) AS tp, max(n) AS n, avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf,
  sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1_score * support) AS wf FROM per2),
allr AS (
  SELECT label, precision, recall, f1_score, support FROM per2
  UNION ALL SELECT 'accuracy', NULL, NULL, tp * 1.0 / n, n FROM tot
  UNION ALL SELECT 'macro avg', mp, mr, mf, n FROM tot
  UNION ALL SELECT 'weighted avg', wp / n, wr / n, wf / n, n FROM tot)
SELECT label, {r6(['precision', 'recall', 'f1_score'])}, support FROM allr"""


def sql_imbalanced_report() -> str:
    z = "coalesce({}, 0.0)"
    return f"""WITH {_cc()},
per AS (SELECT CAST(label AS VARCHAR) AS label, {z.format(div('tp * 1.0', 'tp + fp'))} AS pre,
  {z.format(div('tp * 1.0', 'tp + fn'))} AS rec,
  {z.format(div('(n - tp - fp - fn) * 1.0', 'n - tp - fn'))} AS spe, support AS sup FROM cc),
per2 AS (SELECT *, coalesce({div('2 * pre * rec', 'pre + rec')}, 0.0) AS f1, sqrt(rec * spe) AS geo,
  (1.0 + 0.1 * (rec - spe)) * rec * spe AS iba FROM per),
allr AS (SELECT label, pre, rec, spe, f1, geo, iba, sup FROM per2
  UNION ALL SELECT 'avg / total', sum(pre * sup) / sum(sup), sum(rec * sup) / sum(sup), sum(spe * sup) / sum(sup),
    sum(f1 * sup) / sum(sup), sum(geo * sup) / sum(sup), sum(iba * sup) / sum(sup), sum(sup) FROM per2)
SELECT label, {r6(['pre', 'rec', 'spe', 'f1', 'geo', 'iba'])}, sup FROM allr"""


SIG = """sig AS (SELECT o_orderpriority AS instrument_id, CAST(epoch(o_orderdate) AS BIGINT) AS created_at,
  o_totalprice AS sharp_ratio, o_orderkey FROM orders)"""


def sql_last_report() -> str:
    return f"""WITH {SIG}
SELECT instrument_id, created_at, {r6(['sharp_ratio'])}, o_orderkey FROM sig
QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY created_at DESC, o_orderkey DESC) = 1"""


def sql_last_sharpe_ttl() -> str:
    lo = P["now_epoch"] - P["ttl"]
    return f"""WITH {SIG}
SELECT instrument_id, {rnd(f"arg_max(sharp_ratio, (created_at, o_orderkey)) FILTER (WHERE created_at > {lo})", 'sharp_ratio')} AS sharp_ratio
FROM sig GROUP BY instrument_id"""


VOL = "vol AS (SELECT 'SIM' AS exchange, s_name AS symbol, s_acctbal AS volume, s_suppkey AS position FROM supplier)"


def sql_top_volume() -> str:
    return f"""WITH {VOL}
SELECT exchange, symbol, {r6(['volume'])}, upper(exchange) || '_' || symbol AS instrument FROM vol
WHERE volume > {P['min_volume']}"""


def sql_pair_filter() -> str:
    return f"""WITH {VOL}
SELECT replace(symbol, '/', '_') AS pair, position FROM vol
WHERE regexp_matches(replace(symbol, '/', '_'), '^(?:{P['pair_regex']})')
ORDER BY position LIMIT {P['pair_n']}"""


def _split_cte() -> str:
    return f"""{Q_CTE},
sp AS (SELECT *, CASE WHEN row_number() OVER ({PART} ORDER BY time DESC, seq DESC)
          <= ceil(count(*) OVER ({PART}) * {P['test_size']}) THEN 'test' ELSE 'train' END AS split FROM q)"""


def sql_chrono_split() -> str:
    return f"WITH {_split_cte()}\nSELECT exchange, symbol, seq, split FROM sp"


def sql_split_summary() -> str:
    return f"""WITH {_split_cte()}
SELECT CASE WHEN grouping(split) = 1 THEN 'all' ELSE split END AS split,
  epoch_us(min(time)) AS start_us, epoch_us(max(time)) AS end_us, count(*) AS size
FROM sp GROUP BY ROLLUP (split)"""


def _scaled_cte() -> str:
    mm = ", ".join(f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in LI)
    sc = ", ".join(f"coalesce({div(f'{c} - {c}_min', f'{c}_max - {c}_min')}, 0.0) AS {c}" for c in LI)
    return f"""{LI_DS},
mm AS (SELECT {mm} FROM ds),
sc AS (SELECT l_orderkey, l_linenumber, {sc}, label FROM ds, mm)"""


def sql_minmax_scale() -> str:
    return f"WITH {_scaled_cte()}\nSELECT l_orderkey, l_linenumber, {r6(LI)}, label FROM sc"


def sql_chi2_kbest() -> str:
    parts = []
    for c in LI:
        parts.append(f"""SELECT '{c}' AS feature, sum(coalesce({div(f'(obs - ex) * (obs - ex)', 'ex')}, 0.0)) AS score
FROM (SELECT {c} AS obs, nc * 1.0 / n * t AS ex FROM
      (SELECT label, count(*) AS nc, sum({c}) AS {c} FROM sc GROUP BY label) pc,
      (SELECT count(*) AS n, sum({c}) AS t FROM sc) tt)""")
    return f"WITH {_scaled_cte()},\nsco AS ({' UNION ALL '.join(parts)})\nSELECT feature, {r6(['score'])} FROM sco"


def sql_nearest_centroid() -> str:
    cen = ", ".join(f"avg({c}) AS c_{c}" for c in LI)
    dist = " + ".join(f"(ds.{c} - cen.c_{c}) * (ds.{c} - cen.c_{c})" for c in LI)
    return f"""WITH {LI_DS},
ds2 AS (SELECT *, row_number() OVER () AS rid FROM ds),
cen AS (SELECT label AS clabel, {cen} FROM ds GROUP BY label),
dd AS (SELECT ds.rid, ds.l_orderkey, ds.l_linenumber, ds.label, cen.clabel, {dist} AS d FROM ds2 ds, cen)
SELECT l_orderkey, l_linenumber, label, CAST(clabel AS INTEGER) AS prediction FROM dd
QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, clabel) = 1"""


SQL.update({
    "dedupe_seq": sql_dedupe_seq(),
    "dedupe_rows": sql_dedupe_rows(),
    "seq_gaps": sql_seq_gaps(),
    "coverage_map": sql_coverage_map(),
    "missing_partitions": sql_missing_partitions(),
    "feed_dates": sql_feed_dates(),
    "null_profile": sql_null_profile(),
    "clean_numeric": sql_clean_numeric(),
    "length_guard": sql_length_guard(),
    "label_encode": sql_label_encode(),
    "pattern_mean": sql_pattern("mean"),
    "pattern_median": sql_pattern("median", P["long_window"]),
    "pattern_mean_median": sql_pattern("mean_median"),
    "pattern_ohlc": sql_pattern_ohlc(),
    "pattern_score": sql_pattern_score(),
    "pattern_match": sql_pattern_match(),
    "returns": sql_returns(),
    "merge_returns": sql_merge_returns(),
    "correlation": sql_correlation(),
    "portfolio": sql_portfolio(),
    "confusion_margins": sql_confusion_margins(),
    "classification_report": sql_classification_report(),
    "imbalanced_report": sql_imbalanced_report(),
    "last_report": sql_last_report(),
    "last_sharpe_ttl": sql_last_sharpe_ttl(),
    "top_volume": sql_top_volume(),
    "pair_filter": sql_pair_filter(),
    "chrono_split": sql_chrono_split(),
    "split_summary": sql_split_summary(),
    "minmax_scale": sql_minmax_scale(),
    "chi2_kbest": sql_chi2_kbest(),
    "nearest_centroid": sql_nearest_centroid(),
})


# --- sources / alignment ----------------------------------------------------------------------

def sql_metrics_to_ticks() -> str:
    cols = ", ".join(f"{rnd(f'max({c})', c)} AS {c}" for c in ("seq",) + QALL)
    return f"""WITH {Q_CTE},
q2 AS (SELECT exchange, symbol, CAST(floor(epoch_us(time) / 1000) AS BIGINT) AS ms, CAST(seq AS DOUBLE) AS seq, bid_price, ask_price, bid_qty,
       ask_qty FROM q)
SELECT exchange, symbol, ms * 1000 AS time_us, {cols}, strftime(make_timestamp(ms * 1000), '%Y%m%d') AS date
FROM q2 GROUP BY exchange, symbol, ms"""


def sql_scan_features() -> str:
    return f"WITH {grid_ctes(FREQ, QC)}\nSELECT exchange, symbol, g * 1000000 AS time_us, {r6(QC)} FROM grid"


def sql_instrument_catalog() -> str:
    fields = ", ".join(f"('{f}')" for f in ("seq",) + QALL)
    return f"""WITH names AS (SELECT 'SIM_' || e.event_type || '_' || f.name AS metric
  FROM (SELECT DISTINCT event_type FROM events) e, (VALUES {fields}) f(name))
SELECT DISTINCT array_to_string(string_split(metric, '_')[1:3], '_') AS instrument FROM names
WHERE regexp_matches(array_to_string(string_split(metric, '_')[1:3], '_'), '^(?:{P['catalog_regex']})')"""


def sql_normalize_points() -> str:
    return f"""SELECT 'SIM' AS exchange, upper(event_type) AS symbol, {rnd('value', 'bid_price')} AS bid_price,
  strftime(ts, '%Y%m%d') AS date, {rnd('CAST(floor(epoch(ts)) AS DOUBLE)', 'database_timestamp')} AS database_timestamp,
  epoch_us(ts) AS time_us FROM events"""


def sql_scan_points() -> str:
    return f"""WITH {Q_CTE}
SELECT exchange, symbol, seq, {r6(QALL)}, epoch_us(time) AS time_us FROM q
WHERE time > TIMESTAMP '{P['points_start']}' AND time < TIMESTAMP '{P['points_end']} 23:59:59.999'"""


def sql_align_feeds() -> str:
    feeds = ("click", "error", "purchase", "signup", "view")
    cols = ", ".join(f"{rnd(f'first(bid_price) FILTER (WHERE symbol = {chr(39)}{f}{chr(39)})', f)} AS {f}" for f in feeds)
    return f"WITH {grid_ctes(FREQ, ('bid_price',))}\nSELECT g, {cols} FROM grid GROUP BY g"


def sql_params_matrix() -> str:
    return """SELECT a.l_returnflag, b.l_linestatus
FROM (SELECT DISTINCT l_returnflag FROM lineitem WHERE l_returnflag IS NOT NULL) a,
     (SELECT DISTINCT l_linestatus FROM lineitem WHERE l_linestatus IS NOT NULL) b"""


def sql_flatten_distinct() -> str:
    return """WITH f AS (SELECT user_id, event_type, min(ts) AS first_ts FROM events GROUP BY ALL)
SELECT user_id, string_agg(event_type, ',' ORDER BY first_ts, event_type) AS types FROM f GROUP BY user_id"""


def sql_frame_stats() -> str:
    body = """SELECT exchange, symbol, strftime(make_timestamp(g * 1000000), '%Y%m%d') AS day,
  arg_min(bid_price, g) AS open, arg_max(bid_price, g) AS close, min(bid_price) AS min, max(bid_price) AS max,
  sum(bid_price) AS sum, count(bid_price) AS count, stddev_pop(bid_price) AS std, avg(bid_price) AS mean,
  quantile_cont(bid_price, 0.5) AS median, quantile_cont(bid_price, 0.99) AS pct99,
  quantile_cont(bid_price, 0.01) AS pct01, count(*) FILTER (WHERE bid_price <> 0) AS nz, count(*) AS n
  FROM grid GROUP BY ALL"""
    cols = ["open", "close", "min", "max", "sum", "std", "mean", "median", "pct99", "pct01"]
    pc = rnd("CASE WHEN count >= 2 THEN " + div("close - open", "open") + " END", "pct_change")
    return f"""WITH {grid_ctes(FREQ, ('bid_price',))},
st AS ({body})
SELECT exchange, symbol, day, {r6(cols)}, count, {pc} AS pct_change, nz > n / 2 AS ratio FROM st"""


def sql_remove_outliers() -> str:
    k = P["outlier_k"]
    return f"""WITH {Q_CTE},
d AS (SELECT *, strftime(time, '%Y%m%d') AS day FROM q),
s AS (SELECT *, avg(bid_price) OVER (PARTITION BY exchange, symbol, day) AS m,
  stddev_pop(bid_price) OVER (PARTITION BY exchange, symbol, day) AS sd FROM d)
SELECT exchange, symbol, seq, {r6(QALL)}, day, epoch_us(time) AS time_us FROM s
WHERE bid_price > m - {k} * sd AND bid_price < m + {k} * sd"""


def sql_rank_within() -> str:
    return f"""WITH {SIG}
SELECT instrument_id, created_at, {r6(['sharp_ratio'])}, o_orderkey,
  CAST(row_number() OVER (PARTITION BY instrument_id ORDER BY sharp_ratio DESC, created_at, o_orderkey) AS INTEGER) AS rank
FROM sig"""


def sql_last_hours() -> str:
    return f"""WITH {Q_CTE}
SELECT exchange, symbol, seq, {r6(QALL)}, epoch_us(time) AS time_us FROM q
WHERE time >= TIMESTAMP '{P['now_ts']}' - INTERVAL {int(P['last_hours'] * 3600)} SECOND
  AND time <= TIMESTAMP '{P['now_ts']}'"""


def sql_tick_buffer() -> str:
    us = P["buffer_seconds"] * 1_000_000
    w = f"(PARTITION BY exchange, symbol ORDER BY time_us RANGE BETWEEN {us - 1} PRECEDING AND CURRENT ROW)"
    return f"""WITH {Q_CTE},
t AS (SELECT exchange, symbol, epoch_us(time) AS time_us, seq, bid_price FROM q)
SELECT exchange, symbol, time_us, seq, {r6(['bid_price'])}, count(DISTINCT time_us) OVER {w} AS buffer_size,
  min(time_us) OVER {w} AS buffer_start_us FROM t"""


def sql_closed_bars() -> str:
    return f"""WITH {Q_CTE},
t AS (SELECT exchange, symbol, epoch_us(time) AS time_us, bid_price, ask_price, seq FROM q),
l AS (SELECT exchange, symbol, time_us, arg_max(bid_price, seq) AS bid_price, arg_max(ask_price, seq) AS ask_price
      FROM t GROUP BY ALL)
SELECT exchange, symbol, time_us, {r6(BA)} FROM l
QUALIFY time_us < max(time_us) OVER (PARTITION BY exchange, symbol)"""


SQL.update({
    "metrics_to_ticks": sql_metrics_to_ticks(),
    "scan_features": sql_scan_features(),
    "instrument_catalog": sql_instrument_catalog(),
    "normalize_points": sql_normalize_points(),
    "scan_points": sql_scan_points(),
    "align_feeds": sql_align_feeds(),
    "params_matrix": sql_params_matrix(),
    "flatten_distinct": sql_flatten_distinct(),
    "frame_stats": sql_frame_stats(),
    "remove_outliers": sql_remove_outliers(),
    "rank_within": sql_rank_within(),
    "last_hours": sql_last_hours(),
    "tick_buffer": sql_tick_buffer(),
    "closed_bars": sql_closed_bars(),
})


# --- streams run to completion (one ordered micro-batch = the batch definition) -------------

def sql_replay() -> str:
    return f"""WITH {Q_CTE}
SELECT exchange, symbol, seq, {r6(QALL)}, strftime(time, '%Y%m%d') AS date, epoch_us(time) AS time_us FROM q"""


def sql_stream_signal() -> str:
    return _pattern_table_sql("mean") + f""",
{_score_sql()},
buy AS (SELECT DISTINCT exchange, symbol, pattern FROM sc WHERE score = 1.0)
SELECT pt.exchange, pt.symbol, pt.g * 1000000 AS time_us, pt.pattern,
  CASE WHEN buy.pattern IS NULL THEN 0 ELSE 1 END AS signal
FROM pt LEFT JOIN buy ON pt.exchange = buy.exchange AND pt.symbol = buy.symbol AND pt.pattern = buy.pattern
WHERE pt.pattern IS NOT NULL"""


SQL.update({
    "stream_buffer": sql_tick_buffer(),
    "replay": sql_replay(),
    "stream_signal": sql_stream_signal(),
})



def sql_stream_dedupe() -> str:
    return f"""WITH {Q_CTE}
SELECT exchange, symbol, seq, {r6(QALL)}, epoch_us(time) AS time_us FROM q
QUALIFY row_number() OVER (PARTITION BY exchange, symbol, seq ORDER BY time) = 1"""


def sql_robust_open_close() -> str:
    return f"""WITH {grid_ctes(FREQ, ('bid_price',))},
d AS (SELECT exchange, symbol, g, bid_price, strftime(make_timestamp(g * 1000000), '%Y%m%d') AS day FROM grid),
p AS (SELECT exchange, symbol, day, quantile_cont(bid_price, 0.01) AS lo, quantile_cont(bid_price, 0.99) AS hi
      FROM d GROUP BY ALL),
k AS (SELECT d.* FROM d JOIN p USING (exchange, symbol, day) WHERE d.bid_price > p.lo AND d.bid_price < p.hi),
oc AS (SELECT exchange, symbol, day, arg_min(bid_price, g) AS open_r, arg_max(bid_price, g) AS close_r FROM k GROUP BY ALL)
SELECT b.exchange, b.symbol, b.day, {rnd('oc.open_r', 'open_r')} AS open_r, {rnd('oc.close_r', 'close_r')} AS close_r
FROM (SELECT DISTINCT exchange, symbol, day FROM d) b LEFT JOIN oc USING (exchange, symbol, day)"""


def sql_feed_catalog() -> str:
    return f"""WITH {Q_CTE}
SELECT exchange, symbol, exchange || '_' || symbol AS series,
  epoch_us(min(time) FILTER (WHERE bid_price IS NOT NULL)) AS first_us,
  epoch_us(max(time) FILTER (WHERE bid_price IS NOT NULL)) AS last_us
FROM q WHERE regexp_matches(exchange || '_' || symbol, '^(?:{P['catalog_regex']})') GROUP BY ALL"""


SQL.update({
    "stream_dedupe": sql_stream_dedupe(),
    "robust_open_close": sql_robust_open_close(),
    "feed_catalog": sql_feed_catalog(),
})



def sql_backtest_rollup() -> str:
    return f"""WITH t AS (SELECT o_orderpriority AS source, o_orderkey AS seq, strftime(o_orderdate, '%Y-%m-%d') AS d,
  o_totalprice AS p, o_orderstatus AS signal FROM orders)
SELECT source, arg_max(d, seq) AS start_date, arg_max(d, seq) AS end_date,
  {rnd('arg_max(p, seq)', 'cum_profit')} AS cum_profit, {rnd('arg_max(p, seq)', 'sharp_ratio')} AS sharp_ratio,
  arg_max(signal, seq) AS signal, count(*) AS number_of_trades, min(d) AS first_date, max(d) AS last_date
FROM t GROUP BY source"""


SQL["backtest_rollup"] = sql_backtest_rollup()



def sql_stream_candles() -> str:
    f = P["candle_freq"]
    return f"""WITH {Q_CTE},
wm AS (SELECT epoch_us(max(time)) - CAST(3600000000 AS BIGINT) AS w FROM q),
c AS (SELECT exchange, symbol, CAST(floor(epoch(time) / {f}) AS BIGINT) * {f} AS g,
  arg_min(bid_price, time) AS open, max(bid_price) AS high, min(bid_price) AS low, arg_max(bid_price, time) AS close
  FROM q GROUP BY ALL)
SELECT exchange, symbol, g, {r6(['open', 'high', 'low', 'close'])} FROM c, wm WHERE (g + {f}) * CAST(1000000 AS BIGINT) <= wm.w"""


SQL["stream_candles"] = sql_stream_candles()


# --- landed tables, streams in several micro-batches, splits and models ----------------------

def sql_scan_quotes() -> str:
    qty = ", ".join(f"coalesce({rnd(c, c)}, 0.0) AS {c}" for c in ("bid_qty", "ask_qty"))
    return f"""WITH {Q_CTE}
SELECT exchange, symbol, seq, epoch_us(time) AS time_us, {r6(BA)}, {qty} FROM q
QUALIFY row_number() OVER (PARTITION BY exchange, symbol, seq
  ORDER BY time DESC, bid_price DESC, ask_price DESC, bid_qty DESC, ask_qty DESC) = 1"""


def sql_scan_ticks() -> str:
    ex, sy = P["scan_instrument"].split("_", 1)
    cols = ", ".join(f"floor({c}) AS {c}" for c in QC)
    return f"""WITH {Q_CTE},
c AS (SELECT exchange, symbol, seq, {cols}, time FROM q),
d AS (SELECT * FROM c UNION ALL SELECT * REPLACE (time + INTERVAL 1 SECOND AS time) FROM c)
SELECT exchange, symbol, seq, bid_price, ask_price, bid_qty, ask_qty, max(epoch_us(time)) AS time_us FROM d
WHERE exchange = '{ex}' AND symbol = '{sy}' AND CAST(time AS DATE) BETWEEN DATE '{P["scan_start"]}' AND DATE '{P["scan_end"]}'
GROUP BY exchange, symbol, seq, bid_price, ask_price, bid_qty, ask_qty"""


def sql_metrics_landed() -> str:
    qty = ", ".join(f"coalesce({rnd(f'max({c})', c)}, 0.0) AS {c}" for c in ("bid_qty", "ask_qty"))
    prices = ", ".join(f"{rnd(f'max({c})', c)} AS {c}" for c in BA)
    return f"""WITH {Q_CTE},
q2 AS (SELECT exchange, symbol, CAST(floor(epoch_us(time) / 1000) AS BIGINT) AS ms, seq, bid_price, ask_price, bid_qty, ask_qty FROM q)
SELECT exchange, symbol, max(seq) AS seq, ms * 1000 AS time_us, {prices}, {qty} FROM q2 GROUP BY exchange, symbol, ms"""


def sql_mirror() -> str:
    return f"""WITH {Q_CTE},
d AS (SELECT exchange, symbol, strftime(time, '%Y%m%d') AS date, count(*) AS rows FROM q GROUP BY ALL)
SELECT exchange, symbol, date, rows, (SELECT count(*) FROM d) AS copied, 0 AS copied_again FROM d"""


def sql_stream_predict() -> str:
    score = " + ".join(f"({w} * {c})" for c, w in P["rule_weights"].items())
    return f"""SELECT exchange, symbol, time_us, CASE WHEN {P["rule_intercept"]} + {score} > 0 THEN 1 ELSE 0 END AS prediction
FROM ({sql_closed_bars_plain()})"""


def sql_closed_bars_plain() -> str:
    return f"""WITH {Q_CTE},
t AS (SELECT exchange, symbol, epoch_us(time) AS time_us, bid_price, ask_price, seq FROM q),
l AS (SELECT exchange, symbol, time_us, arg_max(bid_price, seq) AS bid_price, arg_max(ask_price, seq) AS ask_price
      FROM t GROUP BY ALL)
SELECT * FROM l QUALIFY time_us < max(time_us) OVER (PARTITION BY exchange, symbol)"""


def sql_shuffled_split() -> str:
    return """WITH d AS (SELECT l_orderkey, l_linenumber,
  row_number() OVER (ORDER BY md5(l_orderkey || '|' || l_linenumber || '|42') DESC, l_orderkey DESC, l_linenumber DESC) AS rank,
  count(*) OVER () AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN rank <= ceil(n * 0.25) THEN 'test' ELSE 'train' END AS split FROM d"""


def sql_ar1() -> str:
    return f"""WITH {grid_ctes(FREQ, ("bid_price",))},
l AS (SELECT exchange, symbol, g, bid_price, lag(bid_price) OVER {ordw()} AS lag_1 FROM grid),
d AS (SELECT * FROM l WHERE bid_price IS NOT NULL AND lag_1 IS NOT NULL),
m AS (SELECT exchange, symbol, regr_slope(bid_price, lag_1) AS a, regr_intercept(bid_price, lag_1) AS b FROM d GROUP BY ALL)
SELECT d.exchange, d.symbol, d.g, {rnd('d.bid_price', 'bid_price')} AS bid_price, {rnd('m.b + m.a * d.lag_1', 'prediction')} AS prediction
FROM d JOIN m ON d.exchange = m.exchange AND d.symbol = m.symbol"""


SQL.update({
    "scan_quotes": sql_scan_quotes(),
    "scan_ticks": sql_scan_ticks(),
    "scan_features_landed": SQL["scan_features"],
    "metrics_landed": sql_metrics_landed(),
    "mirror": sql_mirror(),
    "stream_predict": sql_stream_predict(),
    "shuffled_split": sql_shuffled_split(),
    "ar1_forecast": sql_ar1(),
})


# --- learners and their life cycle -----------------------------------------------------------

def sql_knn_predict() -> str:
    dist = " + ".join(f"(t.{c} - r.{c}) * (t.{c} - r.{c})" for c in LI)
    return f"""WITH {_scaled_cte()},
ranked AS (SELECT *, row_number() OVER (ORDER BY md5(l_orderkey || '|' || l_linenumber || '|42') DESC,
           l_orderkey DESC, l_linenumber DESC) AS rank, count(*) OVER () AS n FROM sc),
s AS (SELECT *, rank <= ceil(n * {P["knn_test"]}) AS test FROM ranked),
best AS (SELECT t.rank, min({{'d': {dist}, 'o': r.l_orderkey, 'l': r.l_linenumber, 'y': r.label}}, {P["knn_k"]}) AS near
         FROM s t, s r WHERE t.test AND NOT r.test GROUP BY t.rank),
votes AS (SELECT rank, y, count(*) AS v FROM (SELECT rank, unnest([x.y FOR x IN near]) AS y FROM best) GROUP BY ALL),
won AS (SELECT rank, y FROM votes QUALIFY row_number() OVER (PARTITION BY rank ORDER BY v DESC, y) = 1)
SELECT l_orderkey, l_linenumber, label, CAST(y AS INTEGER) AS prediction FROM s JOIN won USING (rank)"""


def sql_adaboost_predict() -> str:
    """Each round: weighted class sums on both sides of every split, the least error, the rows' new weights."""
    cuts = [(i, c, v) for i, c in enumerate(LI) for v in sorted(P["boost_splits"][c])]
    parts, last = [f"w0 AS (SELECT *, row_number() OVER () AS rid, 1.0::DOUBLE AS w FROM ds)"], "w0"
    x = "CASE e.f " + " ".join(f"WHEN {i} THEN {{t}}.{c}" for i, c in enumerate(LI)) + " END"
    says = []
    for r in range(1, P["boost_rounds"] + 1):
        sums = " UNION ALL ".join(
            f"SELECT {i} AS f, {v}::DOUBLE AS s, " + ", ".join(
                f"coalesce(sum(w) FILTER (WHERE {c} {op} {v} AND label = {y}), 0) AS {side}{y}" for side, op in (("l", "<="), ("r", ">")) for y in (0, 1))
            + f" FROM {last}" for i, c, v in cuts)
        parts.append(f"c{r} AS ({sums})")
        parts.append(f"""e{r} AS (SELECT f, s, (l1 > l0)::INTEGER AS l, (r1 > r0)::INTEGER AS r,
  round(1 - (greatest(l0, l1) + greatest(r0, r1)) / (l0 + l1 + r0 + r1), 12) AS err FROM c{r} ORDER BY err, f, s LIMIT 1)""")
        said = f"CASE WHEN {x.format(t='b')} <= e.s THEN e.l ELSE e.r END"
        parts.append(f"w{r} AS (SELECT b.* REPLACE (CASE WHEN {said} = b.label THEN b.w ELSE b.w * exp(ln((1 - e.err) / e.err)) END AS w) FROM {last} b, e{r} e)")
        says.append(f"(SELECT CASE WHEN ({said}) = {{y}} THEN ln((1 - e.err) / e.err) ELSE 0 END FROM e{r} e)")
        last = f"w{r}"
    votes = [" + ".join(s.format(y=y) for s in says) for y in (0, 1)]
    return f"""WITH {LI_DS}, {", ".join(parts)}
SELECT l_orderkey, l_linenumber, label, CASE WHEN {votes[1]} > {votes[0]} THEN 1 ELSE 0 END AS prediction FROM w0 b"""


def report_sql(rows: str, by: Sequence[str]) -> str:
    """The classification report of ``rows`` (columns ``by``, actual, predicted) per ``by``."""
    k = ", ".join(by)
    using = f"USING ({k})"
    return f"""cls AS (SELECT DISTINCT {k}, actual AS c FROM {rows} UNION SELECT DISTINCT {k}, predicted FROM {rows}),
per AS (SELECT {k}, c, count(*) FILTER (WHERE actual = c AND predicted = c) AS tp, count(*) FILTER (WHERE predicted = c) AS p,
        count(*) FILTER (WHERE actual = c) AS support, count(*) AS n FROM {rows} JOIN cls {using} GROUP BY {k}, c),
m AS (SELECT *, CASE WHEN p = 0 THEN 0.0 ELSE tp / p END AS pr, CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS re FROM per),
f AS (SELECT *, CASE WHEN pr + re = 0 THEN 0.0 ELSE 2 * pr * re / (pr + re) END AS f1 FROM m),
rep AS (SELECT {k}, CAST(c AS VARCHAR) AS label, pr AS precision, re AS recall, f1 AS f1_score, support FROM f
  UNION ALL SELECT {k}, 'accuracy', NULL, NULL, sum(tp) / max(n), max(n) FROM f GROUP BY {k}
  UNION ALL SELECT {k}, 'macro avg', avg(pr), avg(re), avg(f1), max(n) FROM f GROUP BY {k}
  UNION ALL SELECT {k}, 'weighted avg', sum(pr * support) / max(n), sum(re * support) / max(n), sum(f1 * support) / max(n), max(n) FROM f GROUP BY {k})"""


def sql_model_testing() -> str:
    judged = " UNION ALL ".join(
        f"SELECT 'SIM' AS exchange, symbol, 'label' AS target, 'LinearRule' AS type, '{m['run_id']}' AS run_id, (bid_qty > {P['holdout_qty']})::INTEGER AS actual, "
        f"({m['intercept']} + " + " + ".join(f"{w} * {c}" for c, w in m["weights"].items()) + " > 0)::INTEGER AS predicted "
        f"FROM q WHERE symbol = '{m['symbol']}' AND time > TIMESTAMP '{m['end_date']}'" for m in P["holdout_models"])
    by = ("exchange", "symbol", "target", "type", "run_id")
    return f"""WITH {Q_CTE},
j AS (SELECT * FROM ({judged}) WHERE actual IS NOT NULL AND predicted IS NOT NULL),
{report_sql("j", by)}
SELECT {", ".join(by)}, label, {r6(["precision", "recall", "f1_score"])}, support::BIGINT AS support FROM rep
WHERE (SELECT count(*) FROM j WHERE j.symbol = rep.symbol AND j.run_id = rep.run_id) >= 2"""


SQL.update({
    "knn_predict": sql_knn_predict(),
    "adaboost_predict": sql_adaboost_predict(),
    "model_testing": sql_model_testing(),
})


def sql_stream_predict_scaled() -> str:
    score = " + ".join([str(P["online_intercept"])] + [
        f"{w} * (({c} - {P['online_scaler'][c][0]}) / ({P['online_scaler'][c][1]} - {P['online_scaler'][c][0]}))" for c, w in P["online_weights"].items()])
    return f"""WITH {Q_CTE},
t AS (SELECT exchange, symbol, epoch_us(time) AS time_us, arg_max(bid_price, seq) AS bid_price, arg_max(ask_price, seq) AS ask_price FROM q GROUP BY ALL),
l AS (SELECT *, max(time_us) OVER (PARTITION BY exchange, symbol) AS newest, max(time_us) OVER () // 1000 AS watermark FROM t)
SELECT exchange, symbol, time_us, CASE WHEN {score} > 0 THEN 1 ELSE 0 END AS prediction FROM l
WHERE time_us < newest OR newest // 1000 + {P["online_expire"]} * 1000 < watermark"""


SQL["stream_predict_scaled"] = sql_stream_predict_scaled()
