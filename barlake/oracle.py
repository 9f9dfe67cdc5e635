"""Reference SQL for every registered query, runnable by DuckDB.

Each pipeline stage is one CTE; a query's SQL is the chain of CTEs it needs
plus its final SELECT.  Tables (``events``, ``lineitem``, ``part``) are the
driver's pre-registered views.  DOUBLE results whose value depends on the
order of a floating-point sum (window means) are compared after
``round(x + 1e-8, 6)`` on both sides.
"""

from __future__ import annotations

MEASURES = ["open", "high", "low", "close", "volume"]
FAULT_OFFSETS = {"close": 0, "open": 1, "high": 2, "low": 3, "volume": 4}


def _bars(kind: str) -> str:
    if kind == "user":
        return """SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date,
       arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, ts) AS close, count(*) AS volume
FROM events GROUP BY 1, 2"""
    if kind == "event_type":
        return """SELECT event_type AS ticker, CAST(ts AS DATE) AS date,
       arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, ts) AS close, count(*) AS volume
FROM events GROUP BY 1, 2"""
    if kind == "brand":
        k = "row(l_orderkey, l_linenumber, l_extendedprice)"
        return f"""SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS date,
       arg_min(l_extendedprice, {k}) AS open, max(l_extendedprice) AS high,
       min(l_extendedprice) AS low, arg_max(l_extendedprice, {k}) AS close,
       count(*) AS volume
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""
    raise ValueError(kind)


def _n(kind: str) -> str:
    if kind == "brand":
        return "CAST(regexp_extract(ticker, '(\\d+)$', 1) AS INTEGER)"
    return "CAST(ticker AS BIGINT)"


def _dirty(kind: str) -> str:
    days = "datediff('day', DATE '1995-01-01', date)"
    cols = []
    for c in MEASURES:
        k = f"(({days} * 7 + {_n(kind)} * 3 + {FAULT_OFFSETS[c]}) % 23)"
        cols.append(f"CASE {k} WHEN 0 THEN NULL WHEN 5 THEN -{c} WHEN 11 THEN {c} * 0 "
                    f"ELSE {c} END AS {c}")
    return f"SELECT ticker, date, {', '.join(cols)} FROM bars_{kind}"


def _p1(kind: str) -> str:
    cols = ", ".join(f"CASE WHEN {c} > 0 THEN {c} END AS {c}" for c in MEASURES)
    return f"SELECT ticker, date, {cols} FROM dirty_{kind}"


W_FILL = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
W = "(PARTITION BY ticker ORDER BY date)"


def _filled(kind: str) -> str:
    cols = ", ".join(f"last_value({c} IGNORE NULLS) OVER {W_FILL} AS {c}" for c in MEASURES)
    return f"SELECT ticker, date, {cols} FROM p1_{kind}"


def _refined(kind: str) -> str:
    conds = []
    for c in MEASURES:
        conds.append(f"{c} IS NOT NULL")
        if c != "volume":
            conds.append(f"NOT isnan({c})")
    return f"SELECT * FROM filled_{kind} WHERE {' AND '.join(conds)}"


def _sma(periods: int, src: str = "close") -> str:
    return (f"avg({src}) OVER (PARTITION BY ticker ORDER BY date "
            f"ROWS BETWEEN {periods} PRECEDING AND CURRENT ROW)")


def _metrics_stage1(kind: str) -> str:
    return f"""SELECT *, lag(close) OVER {W} AS close_previous,
       (close - lag(close) OVER {W}) / nullif(lag(close) OVER {W}, 0) * 100 AS close_change,
       {_sma(20)} AS close_sma_20,
       {_sma(200)} AS close_sma_200
FROM refined_{kind}"""


def _metrics_flags(kind: str) -> str:
    return f"""SELECT *, CASE WHEN close >= close_sma_20 THEN 1 ELSE -1 END AS f20,
       CASE WHEN close >= close_sma_200 THEN 1 ELSE -1 END AS f200
FROM m1_{kind}"""


def _co(flag: str) -> str:
    prev = f"lag({flag}) OVER {W}"
    return (f"CASE WHEN {flag} > 0 AND {flag} <> {prev} THEN 1 "
            f"WHEN {flag} < 0 AND {flag} <> {prev} THEN -1 ELSE 0 END")


def exact_flags(table: str, order: str) -> str:
    """Averages and flags from integers: a close is a whole number of 2**-60."""
    frames = ", ".join(f"sum(x) OVER (PARTITION BY ticker ORDER BY {order} ROWS BETWEEN {n} PRECEDING AND CURRENT ROW) AS t{n}, "
                       f"count(x) OVER (PARTITION BY ticker ORDER BY {order} ROWS BETWEEN {n} PRECEDING AND CURRENT ROW) AS n{n}" for n in (20, 200))
    unit = f"{1 << 60}.0"
    means = ", ".join(f"CAST(t{n} AS DOUBLE) / n{n} / CAST({unit} AS DOUBLE) AS s{n}, CASE WHEN x * n{n} >= t{n} THEN 1 ELSE -1 END AS f{n}" for n in (20, 200))
    return (f"e0 AS (SELECT *, CAST(CAST(close AS DOUBLE) * CAST({unit} AS DOUBLE) AS HUGEINT) AS x FROM {table}),\n"
            f"e1 AS (SELECT *, {frames} FROM e0),\ne2 AS (SELECT *, {means} FROM e1)\n")


def _metrics(kind: str) -> str:
    return f"""SELECT ticker, date, open, high, low, close, volume, close_previous, close_change,
       close_sma_20, {_co('f20')} AS close_sma_20_co,
       close_sma_200, {_co('f200')} AS close_sma_200_co
FROM m2_{kind}"""


STAGES = [
    ("bars", _bars), ("dirty", _dirty), ("p1", _p1), ("filled", _filled),
    ("refined", _refined), ("m1", _metrics_stage1), ("m2", _metrics_flags),
    ("metrics", _metrics),
]


def chain(kind: str, upto: str) -> str:
    """WITH clause with every stage of ``kind`` up to and including ``upto``."""
    parts = []
    for name, fn in STAGES:
        parts.append(f"{name}_{kind} AS (\n{fn(kind)}\n)")
        if name == upto:
            break
    return "WITH " + ",\n".join(parts) + "\n"


def rnd(expr: str) -> str:
    return f"round({expr} + 1e-8, 6)"


RULES_VALUES = """rules(rule_id, rule_type, metric, threshold, periods, rule_order) AS (
VALUES ('change_5', 'eod_change', 'close_change', 5.0, NULL, 0),
       ('change_10', 'eod_change', 'close_change', 10.0, NULL, 1),
       ('sma_20', 'sma_crossover', 'close_sma_20_co', 0.0, 20, 2),
       ('sma_200', 'sma_crossover', 'close_sma_200_co', 0.0, 200, 3)
)"""


def hits_sql(kind: str, latest_only: bool = True) -> str:
    """All rule hits as one UNION ALL over the metric columns."""
    latest = "WHERE date = (SELECT max(date) FROM metrics_{k})".format(k=kind) if latest_only else ""
    return f"""long_{kind} AS (
  SELECT ticker, date, 'close_change' AS metric, CAST(close_change AS DOUBLE) AS value FROM metrics_{kind} {latest}
  UNION ALL
  SELECT ticker, date, 'close_sma_20_co', CAST(close_sma_20_co AS DOUBLE) FROM metrics_{kind} {latest}
  UNION ALL
  SELECT ticker, date, 'close_sma_200_co', CAST(close_sma_200_co AS DOUBLE) FROM metrics_{kind} {latest}
),
hits_{kind} AS (
  SELECT r.rule_id, l.ticker, l.date, l.value
  FROM long_{kind} l JOIN rules r ON l.metric = r.metric AND abs(l.value) > r.threshold
)"""
