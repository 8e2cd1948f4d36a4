"""DuckDB twins of ``registry_tables`` (see ``oracle_sql``): the plain formulation of each query."""

from __future__ import annotations

from tidemark.oracle_sql import BA, FREQ, KEYS, LI, LI_DS, Q_CTE, QC, SQL as _SQL, _scaled_cte, grid_ctes, ordw, r6, report_sql, rnd, sql_chi2_kbest, sql_closed_bars_plain
from tidemark.registry import P
from tidemark.registry_tables import T

QUOTE_ROW = f"exchange, symbol, seq, epoch_us(time) AS time_us, {r6(QC)}"
HOLEY = f"{Q_CTE},\nh AS (SELECT * REPLACE (CASE WHEN bid_qty % 10 <> 0 THEN bid_qty END AS bid_qty) FROM q)"
THIN = f"{Q_CTE},\nt AS (SELECT * FROM q WHERE (day(time) + length(symbol)) % {T['thin']} <> 0)"
TRADES = """t AS (SELECT o_orderpriority AS source, o_orderkey AS seq, strftime(o_orderdate, '%Y-%m-%d') AS d, o_totalprice AS p,
  o_orderstatus AS signal FROM orders)"""
SIGNALS = """sig AS (SELECT o_orderpriority AS instrument_id, CAST(epoch(o_orderdate) AS BIGINT) AS created_at, o_totalprice AS sharp_ratio, o_orderkey FROM orders)"""
FEEDS = ("click", "error", "purchase", "signup", "view")


def wide_coverage(cte: str, rows: str) -> str:
    cells = ", ".join(f"max(CASE WHEN symbol = '{f}' THEN 'OK' END) AS \"SIM_{f}\"" for f in FEEDS)
    return f"WITH {cte}\nSELECT strftime(time, '%U') AS week, strftime(time, '%Y%m%d') AS date, {cells} FROM {rows} GROUP BY ALL"


def missing_days() -> str:
    return f"""WITH {THIN},
cov AS (SELECT DISTINCT exchange, symbol, strftime(time, '%Y%m%d') AS date FROM t)
SELECT i.exchange, i.symbol, d.date FROM (SELECT DISTINCT exchange, symbol FROM cov) i, (SELECT DISTINCT date FROM cov) d
EXCEPT SELECT exchange, symbol, date FROM cov"""


def align_asof_next() -> str:
    f = ", ".join(f"max(value) FILTER (WHERE symbol = '{x}') AS {x}" for x in FEEDS)
    whole = " AND ".join(f"{x} IS NOT NULL" for x in FEEDS)
    step = T["step"]
    return f"""WITH {Q_CTE},
h AS (SELECT symbol, CAST(floor(epoch(time) / 3600) AS BIGINT) * 3600 AS s, arg_max(bid_price, (time, seq)) FILTER (WHERE bid_price IS NOT NULL) AS value
      FROM q GROUP BY ALL),
w AS (SELECT s, {f} FROM h GROUP BY s),
grid AS (SELECT unnest(range(min(s) // {step} * {step}, max(s) // {step} * {step} + 1, {step})) AS g FROM w)
SELECT g, {r6(FEEDS)} FROM grid ASOF JOIN w ON grid.g <= w.s WHERE {whole}"""


def apply_features() -> str:
    return f"""WITH {grid_ctes(FREQ, QC)},
f AS (SELECT exchange, symbol, g, ask_price - bid_price AS spread,
      CASE WHEN bid_qty + ask_qty <> 0 THEN (bid_qty - ask_qty) / (bid_qty + ask_qty) END AS imbalance,
      CASE WHEN bid_qty > 50 THEN bid_price END AS long_bid FROM grid)
SELECT exchange, symbol, g, {r6(["spread", "imbalance", "long_bid"])} FROM f
WHERE spread IS NOT NULL AND imbalance IS NOT NULL AND long_bid IS NOT NULL"""


def select_columns() -> str:
    one = " UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, label, '{c}' AS feature, {c} AS value FROM sc" for c in LI)
    return f"""WITH {_scaled_cte()},
top AS (SELECT feature FROM ({sql_chi2_kbest()}) WHERE score <> 0 ORDER BY score DESC, feature LIMIT {T['top']})
SELECT l_orderkey, l_linenumber, label, feature, {r6(['value'])} FROM ({one}) WHERE feature IN (SELECT feature FROM top)"""


def learning_summary() -> str:
    wide = ", ".join(f"max({m}) FILTER (WHERE label = '{c}') AS {m}_{c}" for c in (0, 1) for m in ("precision", "recall", "f1_score", "support"))
    cols = [f"{m}_{c}" for c in (0, 1) for m in ("precision", "recall", "f1_score")]
    return f"""WITH j AS (SELECT 's' || (TRY_CAST(right(d.source, 1) AS INTEGER) % 5) AS instrument, 'rule' AS estimator, l.quality AS actual, 1 - l.toxic AS predicted
      FROM labels l JOIN documents d USING (doc_id)),
{report_sql("j", ("instrument", "estimator"))},
wide AS (SELECT instrument, estimator, {wide} FROM rep WHERE label IN ('0', '1') GROUP BY ALL),
{TRADES},
bt AS (SELECT 's' || (CAST(left(source, 1) AS INTEGER) % 5) AS instrument, arg_max(d, seq) AS end_date, arg_max(p, seq) AS p, count(*) AS n FROM t GROUP BY ALL)
SELECT instrument, estimator, {r6(cols)}, support_0, support_1, end_date, {rnd("p", "cum_profit")} AS cum_profit, {rnd("p", "sharp_ratio")} AS sharp_ratio,
  n AS number_of_trades FROM wide LEFT JOIN bt USING (instrument)"""


def outer_predictions() -> str:
    return """WITH a AS (SELECT doc_id, max(quality)::DOUBLE AS actual FROM labels WHERE doc_id % 3 <> 0 GROUP BY doc_id),
p AS (SELECT doc_id, (1 - max(toxic))::DOUBLE AS predicted FROM labels WHERE doc_id % 2 = 0 GROUP BY doc_id)
SELECT coalesce(a.doc_id, p.doc_id) AS doc_id, actual, predicted FROM a FULL JOIN p ON a.doc_id = p.doc_id"""


def union_feeds() -> str:
    part = lambda symbol, gone: "SELECT exchange, symbol, seq, time_us, " + ", ".join(
        f"NULL::DOUBLE AS {c}" if c in gone else c for c in QC) + f" FROM r WHERE symbol = '{symbol}'"
    return f"""WITH {Q_CTE}, r AS (SELECT {QUOTE_ROW} FROM q)
{part("click", ["bid_qty"])} UNION ALL {part("view", ["ask_price", "ask_qty"])} UNION ALL {part("error", [])}"""


def purge() -> str:
    days = ", ".join(f"'{d}'" for d in T["purge"])
    return f"""WITH {Q_CTE}, d AS (SELECT strftime(time, '%Y%m%d') AS date, count(*) AS rows FROM q WHERE symbol = 'view' GROUP BY ALL)
SELECT date, rows, (SELECT count(*) FROM d WHERE date IN ({days}))::INTEGER AS found, (SELECT count(*) FROM d WHERE date IN ({days}))::INTEGER AS gone
FROM d WHERE date NOT IN ({days})"""


def event_listing() -> str:
    coins = ", ".join(f"'{c}'" for c in T["coins"])
    return f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS date_start, o_orderpriority AS coin, o_orderstatus AS tag, count(*) AS views FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{T["start"]}' AND DATE '{T["end"]}' AND o_orderpriority IN ({coins}) AND o_orderstatus = 'F'
GROUP BY ALL ORDER BY views DESC, date_start, coin LIMIT 30"""


def concat_xy() -> str:
    return f"""WITH {LI_DS}, x AS (SELECT l_orderkey, {", ".join(f"max({c}) AS {c}" for c in LI)} FROM ds GROUP BY l_orderkey),
y AS (SELECT l_orderkey, sum(label)::BIGINT AS profit FROM ds GROUP BY l_orderkey)
SELECT l_orderkey, {r6(LI)}, profit FROM x JOIN y USING (l_orderkey)"""


def listing() -> str:
    return """WITH m AS (SELECT DISTINCT event_type AS symbol, length(event_type)::DOUBLE AS weight FROM events),
n AS (SELECT weight, count(*) AS models_of_weight FROM m GROUP BY weight)
SELECT 'SIM' AS exchange, symbol, 'LinearRule' AS type, weight, models_of_weight FROM m JOIN n USING (weight) WHERE symbol LIKE '%i%'"""


def rule(cols: str, rows: str) -> str:
    score = " + ".join(f"({w} * {c})" for c, w in P["rule_weights"].items())
    return f"SELECT {cols}, CASE WHEN {P['rule_intercept']} + {score} > 0 THEN 1 ELSE 0 END AS prediction FROM {rows}"


W5 = f"(PARTITION BY {KEYS} ORDER BY g ROWS BETWEEN {T['rows_window'] - 1} PRECEDING AND CURRENT ROW)"

SQL = {
    "align_asof_next": align_asof_next(),
    "coverage_wide": wide_coverage(Q_CTE, "q"),
    "coverage_holes": wide_coverage(THIN, "t"),
    "missing_days": missing_days(),
    "select_regex": "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem",
    "concat_xy": concat_xy(),
    "fill_qty": f"WITH {HOLEY}\nSELECT exchange, symbol, seq, epoch_us(time) AS time_us, {r6(BA)}, "
                f"{rnd('coalesce(bid_qty, 0)', 'bid_qty')} AS bid_qty, {rnd('coalesce(ask_qty, 0)', 'ask_qty')} AS ask_qty FROM h",
    "after_end": f"WITH {Q_CTE}\nSELECT {QUOTE_ROW} FROM q WHERE time > TIMESTAMP '{T['after']}'",
    "to_float32": f"SELECT l_orderkey, l_linenumber, {', '.join(f'CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}' for c in LI)} FROM lineitem",
    "dropped_rows": f"WITH {HOLEY}\nSELECT count(*) AS rows, count(*) FILTER (WHERE bid_price IS NULL OR bid_qty IS NULL) AS dropped FROM h",
    "latest_ticks": f"WITH {Q_CTE}\nSELECT exchange, symbol, seq, epoch_us(time) AS time_us FROM q ORDER BY time DESC, seq DESC LIMIT 25",
    "select_columns": select_columns(),
    "top_features": f"SELECT * FROM ({sql_chi2_kbest()}) ORDER BY score DESC, feature LIMIT {T['top']}",
    "apply_features": apply_features(),
    "rolling_rows": f"WITH {grid_ctes(FREQ, ('bid_price',))},\nw AS (SELECT exchange, symbol, g, avg(bid_price) OVER {W5} AS mean, count(bid_price) OVER {W5} AS n FROM grid)\n"
                    f"SELECT exchange, symbol, g, {r6(['mean'])}, n FROM w",
    "diff": f"WITH {grid_ctes(FREQ, ('bid_price',))},\nw AS (SELECT exchange, symbol, g, bid_price - lag(bid_price) OVER {ordw()} AS diff FROM grid)\n"
            f"SELECT exchange, symbol, g, {r6(['diff'])} FROM w WHERE diff IS NOT NULL",
    "remove_outliers_pct": f"""WITH {Q_CTE}, d AS (SELECT *, strftime(time, '%Y%m%d') AS day FROM q),
s AS (SELECT exchange, symbol, day, quantile_cont(bid_price, {T['pct_low']}) AS lo, quantile_cont(bid_price, {T['pct_high']}) AS hi FROM d GROUP BY ALL)
SELECT exchange, symbol, seq, day FROM d JOIN s USING (exchange, symbol, day) WHERE bid_price > lo AND bid_price < hi""",
    "union_feeds": union_feeds(),
    "outer_predictions": outer_predictions(),
    "missing_keys": f"SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{T['start']}' AND DATE '{T['end']}'",
    "event_listing": event_listing(),
    "learning_summary": learning_summary(),
    "scan_directory": f"WITH {Q_CTE}\nSELECT exchange, symbol, count(*) AS rows FROM q GROUP BY ALL",
    "sql_table": f"WITH {SIGNALS}\nSELECT instrument_id, created_at, {r6(['sharp_ratio'])}, o_orderkey FROM sig",
    "csv_round_trip": f"WITH {LI_DS}\nSELECT l_orderkey, l_linenumber, {r6(LI)}, label FROM ds",
    "model_listing": listing(),
    "buy_patterns": """SELECT 'SIM' AS exchange, o_orderpriority AS symbol, upper(to_hex(o_orderkey % 16)) AS pattern FROM orders
GROUP BY ALL HAVING max((o_totalprice > 50000)::INTEGER) = 1""",
    "report_table": f"""WITH {SIGNALS}, l AS (SELECT instrument_id, arg_max(sharp_ratio, (created_at, o_orderkey)) + 1 AS sharp_ratio,
  arg_max(o_orderkey, (created_at, o_orderkey)) AS o_orderkey FROM sig GROUP BY ALL)
SELECT instrument_id, {r6(['sharp_ratio'])}, o_orderkey, 200::BIGINT AS created_at FROM l""",
    "run_context": "SELECT DISTINCT o_orderpriority || '-' || o_orderstatus AS run_id, 1::BIGINT AS rows FROM orders",
    "signal_tables": f"""WITH {TRADES}, r AS (SELECT source, arg_max(p, seq) AS sharp_ratio, arg_max(signal, seq) AS signal, count(*) AS number_of_trades,
  arg_max(d, seq) AS s, min(d) AS f FROM t GROUP BY ALL)
SELECT signal, source, CAST(row_number() OVER (PARTITION BY signal ORDER BY sharp_ratio DESC) AS INTEGER) AS rank, {r6(['sharp_ratio'])}, number_of_trades FROM r""",
    "predictions_landed": f"WITH {Q_CTE}\n" + rule("exchange, symbol, seq", "q"),
    "backup": _SQL["metrics_landed"],
    "purge": purge(),
}
