"""The same analysis tables as ``fixtures.py`` written as ANSI SQL (DuckDB dialect),
used by the oracle side of the correctness check."""

DAILY = """SELECT CAST(l_shipdate AS DATE) AS date,
       SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) / 100 / COUNT(*) AS adj_close,
       SUM(l_quantity) AS volume
FROM lineitem GROUP BY 1"""

OHLC = """SELECT CAST(o_orderdate AS DATE) AS date,
       min_by(o_totalprice, o_orderkey) AS open, MAX(o_totalprice) AS high,
       MIN(o_totalprice) AS low, max_by(o_totalprice, o_orderkey) AS close, COUNT(*) AS volume
FROM orders GROUP BY 1"""

ASSETS = """SELECT CAST(l_shipdate AS DATE) AS date,
       SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) / 100 / COUNT(*) AS adj_close,
       SUM(CASE WHEN l_returnflag = 'A' THEN CAST(ROUND(l_extendedprice * 100) AS BIGINT) END) / 100
         / NULLIF(COUNT(CASE WHEN l_returnflag = 'A' THEN 1 END), 0) AS a_price,
       SUM(CASE WHEN l_returnflag = 'N' THEN CAST(ROUND(l_extendedprice * 100) AS BIGINT) END) / 100
         / NULLIF(COUNT(CASE WHEN l_returnflag = 'N' THEN 1 END), 0) AS n_price,
       SUM(CASE WHEN l_returnflag = 'R' THEN CAST(ROUND(l_extendedprice * 100) AS BIGINT) END) / 100
         / NULLIF(COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END), 0) AS r_price
FROM lineitem GROUP BY 1"""

TICKS = "SELECT user_id, ts, event_id, value FROM events"

LONG_SERIES = """SELECT l_shipdate AS ts, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       l_quantity AS value FROM lineitem"""
LONG_ORDER = "ts, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"

DIRTY = """WITH b AS (
  SELECT o_orderkey AS pos,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'bad'
              ELSE strftime(o_orderdate, '%m/%d/%Y') END AS date_s,
         CASE WHEN o_orderkey % 5 = 0 THEN replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price_s,
         CASE WHEN o_orderkey % 7 IN (0, 1) OR o_orderkey % 97 < 25 THEN NULL
              ELSE CAST(o_custkey % 100 AS DOUBLE) END AS qty,
         CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS flag_s,
         CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS note
  FROM orders)
SELECT * FROM b UNION ALL SELECT * FROM b WHERE pos % 10 = 0"""

CATEGORICAL = """SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS c_mktsegment
FROM customer"""

BRANDS = "SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_brand END AS p_brand FROM part"

RETURNS = """SELECT date, adj_close, volume, ln(adj_close / lag(adj_close) OVER (ORDER BY date)) AS r
FROM daily WHERE adj_close > 0"""

PREDICTIONS = """SELECT date, y, p, price FROM (
  SELECT date, lead(r) OVER (ORDER BY date) AS y, r AS p, adj_close AS price FROM returns)
WHERE y IS NOT NULL AND p IS NOT NULL"""

FIXTURES = {
    "daily": DAILY, "ohlc": OHLC, "assets": ASSETS, "ticks": TICKS, "long_series": LONG_SERIES,
    "dirty": DIRTY, "categorical": CATEGORICAL, "brands": BRANDS, "returns": RETURNS,
    "predictions": PREDICTIONS,
}
_DEPS = {"returns": ["daily"], "predictions": ["daily", "returns"]}


def with_fixtures(body: str, *names: str) -> str:
    """Prefix ``body`` with CTEs for the named fixtures (dependencies first)."""
    order: list[str] = []
    for n in names:
        for d in _DEPS.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS (\n{FIXTURES[n]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


def sig_round_sql(c: str, bits: int = 30) -> str:
    """DuckDB twin of ``catalog.sig_round`` (significant bits, exact scaling)."""
    x = f'CAST("{c}" AS DOUBLE)'
    e0 = f"floor(log2(abs({x})))"
    e = (f"(CASE WHEN pow(2.0, {e0} + 1) <= abs({x}) THEN {e0} + 1 "
         f"WHEN pow(2.0, {e0}) > abs({x}) THEN {e0} - 1 ELSE {e0} END)")
    sc = f"pow(2.0, {bits - 1} - {e})"
    return (f"CASE WHEN {x} IS NULL OR abs({x}) < 1e-200 OR isnan({x}) OR isinf({x}) THEN {x} "
            f"ELSE round({x} * {sc}) / {sc} END + 0.0")


def rounded(sql: str, doubles: list[str], bits: int = 30) -> str:
    """Round the listed floating columns exactly like ``catalog.round_doubles``."""
    if not doubles:
        return sql
    rep = ", ".join(f'{sig_round_sql(c, bits)} AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"
