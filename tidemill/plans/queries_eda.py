"""Registered queries for profiling, correlation, selection and the market-report tables."""

from __future__ import annotations


from dataclasses import replace

from pyspark.sql import functions as F

from tidemill.catalog import register
from tidemill.operators import correlation as co
from tidemill.operators import eda
from tidemill.operators import features as fe
from tidemill.operators import profile as pr
from tidemill.operators import select as se
from tidemill.plans.feature_pipeline import DAILY, build_features, feature_columns, run_pipeline
from tidemill.plans.queries_series import feature_matrix_sql
from tidemill.sources import fixtures as fx
from tidemill.sources.fixture_sql import rounded, with_fixtures

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ASSET_COLS = ["adj_close", "a_price", "n_price", "r_price"]


def _nan(e: str) -> str:
    return f"CASE WHEN isnan({e}) THEN NULL ELSE {e} END"


# ---------------------------------------------------------------- describe / counts

@register("describe_numeric", rounded(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
    f"quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem" for c in LI_NUM),
    ["mean", "std", "min", "p25", "p50", "p75", "max"]))
def q_describe_numeric(spark, sf):
    """A1: count, mean, sample std, min, quartiles (linear), max per numeric column."""
    return pr.describe_numeric(fx.table(spark, sf, "lineitem"), LI_NUM)


@register("describe_categorical", """WITH c AS (
  SELECT 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
n AS (SELECT "column", value, COUNT(*) AS n FROM c WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT "column", CAST(SUM(n) AS BIGINT) AS count, COUNT(*) AS "unique", first(value ORDER BY n DESC, value) AS top,
       MAX(n) AS freq FROM n GROUP BY 1""")
def q_describe_categorical(spark, sf):
    """A2: count, distinct, most frequent value (smallest on ties) and its frequency."""
    return pr.describe_categorical(fx.table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("value_counts", with_fixtures(
    "SELECT c_mktsegment AS value, COUNT(*) AS count FROM categorical WHERE c_mktsegment IS NOT NULL GROUP BY 1",
    "categorical"))
def q_value_counts(spark, sf):
    """Non-null value counts sorted by value."""
    return pr.value_counts(fx.categorical(spark, sf), "c_mktsegment")


def _hist_sql(src: str, col: str, bins: int) -> str:
    w = f"((hi - lo) / {bins})"
    return f"""SELECT g.bin, lo + g.bin * {w} AS lo, lo + (g.bin + 1) * {w} AS hi, CAST(COALESCE(c.count, 0) AS BIGINT) AS count,
       COALESCE(c.count, 0) / (n * {w}) AS density
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) g
LEFT JOIN (SELECT CASE WHEN {w} = 0 THEN 0 ELSE CAST(least(floor(({col} - lo) / {w}), {bins - 1}) AS INTEGER) END AS bin,
                  COUNT(*) AS count FROM {src}, (SELECT min({col}) AS lo, max({col}) AS hi FROM {src})
           WHERE {col} IS NOT NULL GROUP BY 1) c ON g.bin = c.bin,
(SELECT min({col}) AS lo, max({col}) AS hi, COUNT({col}) AS n FROM {src})"""


@register("histogram", rounded(with_fixtures(_hist_sql("daily", "adj_close", 30), "daily"), ["lo", "hi", "density"]))
def q_histogram(spark, sf):
    """30 equal-width bins with density, empty bins included."""
    return pr.histogram(fx.daily(spark, sf), "adj_close", 30)


def _kde_sql(src: str, col: str, points: int = 300) -> str:
    return f"""WITH v0 AS (SELECT {col} AS v FROM {src} WHERE {col} IS NOT NULL),
s AS (SELECT min(v) AS lo, max(v) AS hi, COUNT(v) AS n, stddev_samp(v) AS sd, pow(COUNT(v), -0.2) * stddev_samp(v) AS h FROM v0),
b AS (SELECT v, COUNT(*) AS w FROM v0 GROUP BY v),
g AS (SELECT CAST(range AS INTEGER) AS point FROM range({points}))
SELECT point, lo + point * ((hi - lo) / {points - 1}) AS x,
       SUM(w * exp(-0.5 * ((lo + point * ((hi - lo) / {points - 1}) - b.v) / h) * ((lo + point * ((hi - lo) / {points - 1}) - b.v) / h)))
         / (n * h * sqrt(2 * pi())) AS density
FROM g, b, s GROUP BY point, lo, hi, n, h"""


@register("kde", rounded(with_fixtures(f"SELECT * FROM ({_kde_sql('predictions', 'p')})", "predictions"),
                        ["x", "density"]))
def q_kde(spark, sf):
    """Gaussian KDE (Scott bandwidth) of daily log returns at 300 grid points."""
    return pr.kde(fx.predictions(spark, sf), "p", 300)


@register("box_stats", rounded(with_fixtures(
    """SELECT q1, median, q3, min(CASE WHEN volume BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN volume END)
  AS lower_whisker, max(CASE WHEN volume BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN volume END)
  AS upper_whisker, COUNT(CASE WHEN NOT (volume BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) THEN 1 END)
  AS n_outliers FROM daily, (SELECT quantile_cont(volume, 0.25) AS q1, quantile_cont(volume, 0.5) AS median,
  quantile_cont(volume, 0.75) AS q3 FROM daily) WHERE volume IS NOT NULL GROUP BY q1, median, q3""", "daily"),
    ["q1", "median", "q3", "lower_whisker", "upper_whisker"]))
def q_box_stats(spark, sf):
    """Quartiles, whiskers (extreme data within 1.5 IQR) and outlier count."""
    return pr.box_stats(fx.daily(spark, sf), "volume")


@register("chart_kind", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CASE WHEN COALESCE(bool_and(CAST({c} AS VARCHAR) IN ('0', '1')), false) THEN 'bar' "
    f"ELSE 'hist_box' END AS kind FROM labels" for c in ["doc_id", "quality", "toxic"]))
def q_chart_kind(spark, sf):
    """Chart choice per column (binary -> bar counts, numeric -> histogram + box)."""
    return pr.chart_kind(fx.table(spark, sf, "labels"), ["doc_id", "quality", "toxic"])


# ---------------------------------------------------------------- correlation family

def _corr_sql(a: str, b: str) -> str:
    return _nan(f"corr({a}, {b})")


@register("corr_matrix", rounded(with_fixtures(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {i} AS i, {j} AS j, {_corr_sql(a, b)} AS r FROM assets"
    for i, a in enumerate(ASSET_COLS) for j, b in enumerate(ASSET_COLS)), "assets"), ["r"]))
def q_corr_matrix(spark, sf):
    """Pairwise-complete Pearson matrix in long form."""
    return co.corr_long(fx.assets(spark, sf), ASSET_COLS)


@register("top_correlates", rounded(with_fixtures(
    'SELECT "column", r, abs(r) AS abs_r FROM (' + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_corr_sql(c, 'adj_close')} AS r FROM assets" for c in ASSET_COLS)
    + ') WHERE r IS NOT NULL ORDER BY abs_r DESC, "column" LIMIT 3', "assets"), ["r", "abs_r"]))
def q_top_correlates(spark, sf):
    """Columns ranked by |r| with the target (top 3, target included)."""
    return co.top_correlates(fx.assets(spark, sf), "adj_close", ASSET_COLS, top_n=3)


@register("corr_pair", rounded(with_fixtures(
    f"SELECT COALESCE({_corr_sql('adj_close', 'a_price')}, 0.0) AS r, "
    "COUNT(CASE WHEN adj_close IS NOT NULL AND a_price IS NOT NULL THEN 1 END) AS n FROM assets", "assets"), ["r"]))
def q_corr_pair(spark, sf):
    """Safe pair correlation (0 when undefined) and the number of complete pairs."""
    return co.corr_pair(fx.assets(spark, sf), "adj_close", "a_price")


def _cross_lag_sql() -> str:
    assets = ["a_price", "n_price", "r_price"]
    lags = ", ".join(f"lag({a}, {k}) OVER (ORDER BY date) AS {a}_l{k}" for a in assets for k in range(1, 8))
    body = " UNION ALL ".join(
        f"SELECT '{a}' AS asset, {k} AS lag, COALESCE({_corr_sql('adj_close', f'{a}_l{k}')}, 0.0) AS r FROM l"
        for a in assets for k in range(1, 8))
    return rounded(with_fixtures(f"SELECT * FROM ({body})", "assets").replace(
        "\nSELECT * FROM (", f",\nl AS (SELECT adj_close, {lags} FROM assets)\nSELECT * FROM (", 1), ["r"])


@register("cross_lag_corr", _cross_lag_sql())
def q_cross_lag_corr(spark, sf):
    """corr(target[t], asset[t-k]) for k = 1..7."""
    return co.cross_lag_corr(fx.assets(spark, sf), "adj_close", ["a_price", "n_price", "r_price"], ["date"], 7,
                             mode="single")


def _rolling_corr_sql() -> str:
    w = "(ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)"
    parts = [f"CASE WHEN COUNT(*) OVER {w} = 90 THEN covar_pop(adj_close, {o}) OVER {w} / "
             f"NULLIF(stddev_pop(adj_close) OVER {w} * stddev_pop({o}) OVER {w}, 0) END AS corr_{o}"
             for o in ("a_price", "r_price")]
    return rounded(with_fixtures(
        f"SELECT date, adj_close, {', '.join(parts)} FROM assets WHERE adj_close IS NOT NULL AND a_price IS NOT NULL "
        "AND r_price IS NOT NULL", "assets"), ["adj_close", "corr_a_price", "corr_r_price"])


@register("rolling_corr", _rolling_corr_sql())
def q_rolling_corr(spark, sf):
    """90-row rolling correlation of the target with two assets (null rows dropped first)."""
    out = fe.rolling_corr(fx.assets(spark, sf), "adj_close", ["a_price", "r_price"], ["date"], window=90,
                          mode="single")
    return out.select("date", "adj_close", "corr_a_price", "corr_r_price")


# ---------------------------------------------------------------- market report tables

MONTHLY_SQL = """SELECT year, month, last_price,
       (last_price / NULLIF(lag(last_price) OVER (ORDER BY year, month), 0) - 1) * 100 AS monthly_return
FROM (SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
             arg_max(adj_close, date) AS last_price FROM daily WHERE adj_close IS NOT NULL GROUP BY 1, 2)"""


@register("monthly_returns", rounded(with_fixtures(MONTHLY_SQL, "daily"), ["last_price", "monthly_return"]))
def q_monthly_returns(spark, sf):
    """Last price per month and month-over-month return in percent."""
    return eda.monthly_returns(fx.daily(spark, sf), "adj_close")


@register("seasonal_pivot", rounded(with_fixtures(
    "SELECT year, " + ", ".join(f"max(CASE WHEN month = {m} THEN monthly_return END) AS m{m:02d}" for m in range(1, 13))
    + f" FROM ({MONTHLY_SQL}) GROUP BY year", "daily"), [f"m{m:02d}" for m in range(1, 13)]))
def q_seasonal_pivot(spark, sf):
    """A10/V8: year x month table of monthly returns."""
    return eda.seasonal_pivot(eda.monthly_returns(fx.daily(spark, sf), "adj_close"))


@register("trend_segments", rounded(with_fixtures("""SELECT segment, y_start, y_end, max(adj_close) AS max_price,
  first(date ORDER BY adj_close DESC, date) AS max_date, min(adj_close) AS min_price,
  first(date ORDER BY adj_close, date) AS min_date
FROM (SELECT CAST(k / 2 AS INTEGER) AS segment, year AS y_start, least(year + 2, last + 1) AS y_end
      FROM (SELECT year, row_number() OVER (ORDER BY year) - 1 AS k, max(year) OVER () AS last
            FROM (SELECT DISTINCT CAST(year(date) AS INTEGER) AS year FROM daily)) WHERE k % 2 = 0) s
JOIN daily ON year(daily.date) >= s.y_start AND year(daily.date) < s.y_end
WHERE adj_close IS NOT NULL GROUP BY segment, y_start, y_end""", "daily"), ["max_price", "min_price"]))
def q_trend_segments(spark, sf):
    """Peak and trough per two-year segment (earliest date on ties)."""
    return eda.trend_segments(fx.daily(spark, sf), "adj_close", window_years=2)


@register("candlestick", rounded(with_fixtures(
    "SELECT date, open, high, low, close, close >= open AS up FROM ohlc ORDER BY date DESC LIMIT 60", "ohlc"),
    ["open", "high", "low", "close"]))
def q_candlestick(spark, sf):
    """Last 60 daily candles with the up/down flag."""
    return eda.candlestick(fx.ohlc(spark, sf), 60)


@register("scatter_bins", with_fixtures("""SELECT
  CASE WHEN (xh - xl) / 50 = 0 THEN 0 ELSE CAST(least(floor((adj_close - xl) / ((xh - xl) / 50)), 49) AS INTEGER) END AS bx,
  CASE WHEN (yh - yl) / 50 = 0 THEN 0 ELSE CAST(least(floor((volume - yl) / ((yh - yl) / 50)), 49) AS INTEGER) END AS "by",
  COUNT(*) AS count
FROM daily, (SELECT min(adj_close) AS xl, max(adj_close) AS xh, min(volume) AS yl, max(volume) AS yh FROM daily)
WHERE adj_close IS NOT NULL AND volume IS NOT NULL GROUP BY 1, 2""", "daily"))
def q_scatter_bins(spark, sf):
    """V3: 50 x 50 binned scatter of price against volume."""
    return eda.scatter_bins(fx.daily(spark, sf), "adj_close", "volume", 50)


@register("rebased_series", rounded(with_fixtures(
    "SELECT date, " + ", ".join(
        f"CASE WHEN max({c}) OVER () = min({c}) OVER () THEN NULL ELSE ({c} - min({c}) OVER ()) / "
        f"(max({c}) OVER () - min({c}) OVER ()) END AS {c}" for c in ASSET_COLS)
    + " FROM assets WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in ASSET_COLS), "assets"), ASSET_COLS))
def q_rebased_series(spark, sf):
    """V6: min-max rebased target and assets over rows where all are present."""
    return eda.rebased_series(fx.assets(spark, sf), "adj_close", ["a_price", "n_price", "r_price"])


# ---------------------------------------------------------------- selection

def _fm_cte():
    body, feats = feature_matrix_sql(round_result=False)
    return with_fixtures(f"SELECT * FROM fm_body", "daily").replace(
        "\nSELECT * FROM fm_body", f",\nfm AS (\n{body}\n)\nSELECT * FROM fm_body"), feats


def _corr_filter_body(feats: list[str], threshold: float = 0.98) -> str:
    pairs = " UNION ALL ".join(
        f"SELECT '{feats[j]}' AS feature, abs({_corr_sql(feats[i], feats[j])}) > {threshold} AS hit FROM fm"
        for j in range(len(feats)) for i in range(j))
    names = ", ".join(f"('{f}', {k})" for k, f in enumerate(feats))
    return (f"SELECT n.feature, n.position, COALESCE(bool_or(p.hit), false) AS dropped FROM "
            f"(SELECT * FROM (VALUES {names}) AS t(feature, position)) n LEFT JOIN ({pairs}) p ON n.feature = p.feature "
            f"GROUP BY n.feature, n.position")


def _corr_filter_sql() -> str:
    base, feats = _fm_cte()
    return base.replace("SELECT * FROM fm_body", _corr_filter_body(feats))


def _feature_table(spark, sf):
    m = build_features(fx.daily(spark, sf), DAILY)
    return m, feature_columns(m, DAILY)


@register("corr_filter", _corr_filter_sql())
def q_corr_filter(spark, sf):
    """M1: drop a feature when |r| > 0.98 with any earlier feature (not greedy)."""
    m, feats = _feature_table(spark, sf)
    return se.correlation_filter(m, feats, 0.98)


def _mi_bodies(feats: list[str], bins: int = 10) -> tuple[str, str]:
    d = lambda c: f"CAST({c} AS DOUBLE)"

    def b(c, e):
        return f"len(list_filter({e}, lambda v: v <= {d(c)}))"
    columns = [*feats, "y"]
    lists = ", ".join(f"list_sort(list({d(c)}) FILTER (WHERE {c} IS NOT NULL)) AS s_{k}" for k, c in enumerate(columns))
    cuts = ", ".join("[" + ", ".join(f"s_{k}[{j} * len(s_{k}) // {bins} + 1]" for j in range(1, bins)) + f"] AS e_{k}"
                     for k in range(len(columns)))
    mm = f"SELECT {cuts} FROM (SELECT {lists} FROM fm)"
    trip = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {b(f, f'e_{k}')} AS bx, {b('y', f'e_{len(feats)}')} AS \"by\" "
        f"FROM fm, mm WHERE {f} IS NOT NULL AND y IS NOT NULL" for k, f in enumerate(feats))
    body = f"""SELECT feature, SUM((nxy / n) * ln(nxy * n / (nx * ny))) AS mi FROM (
  SELECT feature, CAST(nxy AS DOUBLE) AS nxy, CAST(SUM(nxy) OVER (PARTITION BY feature) AS DOUBLE) AS n,
         CAST(SUM(nxy) OVER (PARTITION BY feature, bx) AS DOUBLE) AS nx,
         CAST(SUM(nxy) OVER (PARTITION BY feature, "by") AS DOUBLE) AS ny
  FROM (SELECT feature, bx, "by", COUNT(*) AS nxy FROM ({trip}) GROUP BY 1, 2, 3)) GROUP BY feature"""
    return mm, body


def _mi_sql(top: int | None = None) -> str:
    base, feats = _fm_cte()
    mm, body = _mi_bodies(feats)
    if top:
        body = f"SELECT * FROM ({body}) ORDER BY mi DESC, feature LIMIT {top}"
    sql = base.replace("\nSELECT * FROM fm_body", f",\nmm AS ({mm})\n{body}")
    return rounded(sql, ["mi"])


@register("mutual_information", _mi_sql())
def q_mutual_information(spark, sf):
    """Binned mutual information of every feature with the next-day target."""
    m, feats = _feature_table(spark, sf)
    return se.mutual_information(m, feats, "y", bins=10)


def _knn_mi_sql(k: int = 3) -> str:
    psi_k = -0.5772156649015329 + sum(1 / i for i in range(1, k))
    return f"""SELECT * FROM (WITH p AS MATERIALIZED (
  SELECT 'p' AS feature, p AS x, y, row_number() OVER (ORDER BY date) AS i FROM predictions
  UNION ALL SELECT 'energy', p * p, y, row_number() OVER (ORDER BY date) FROM predictions),
s AS MATERIALIZED (SELECT feature, i, x / stddev_pop(x) OVER f AS x, y / stddev_pop(y) OVER f AS y, COUNT(*) OVER f AS n FROM p WINDOW f AS (PARTITION BY feature)),
d AS MATERIALIZED (SELECT a.feature, a.i, list_sort(min(greatest(abs(a.x - b.x), abs(a.y - b.y)), {k}))[{k}] AS r
      FROM s a JOIN s b ON a.feature = b.feature AND a.i <> b.i GROUP BY a.feature, a.i),
c AS MATERIALIZED (SELECT a.feature, a.i, a.n, COUNT(*) FILTER (abs(a.x - b.x) < r OR (r = 0 AND a.x = b.x)) AS nx,
             COUNT(*) FILTER (abs(a.y - b.y) < r OR (r = 0 AND a.y = b.y)) AS ny
      FROM s a JOIN d ON a.feature = d.feature AND a.i = d.i JOIN s b ON a.feature = b.feature GROUP BY a.feature, a.i, a.n),
psi AS MATERIALIZED (SELECT n, -0.5772156649015329 + SUM(CASE WHEN n > 1 THEN 1.0::DOUBLE / (n - 1) ELSE 0 END) OVER (ORDER BY n) AS v
        FROM (SELECT unnest(range(1, (SELECT max(n) + 1 FROM s))) AS n))
SELECT feature, greatest(0.0::DOUBLE, any_value(pn.v) + {psi_k!r}::DOUBLE - avg(px.v + py.v)) AS mi
FROM c JOIN psi px ON px.n = nx JOIN psi py ON py.n = ny JOIN psi pn ON pn.n = c.n GROUP BY feature)"""


@register("mutual_information_knn", rounded(with_fixtures(_knn_mi_sql(), "predictions"), ["mi"]))
def q_mutual_information_knn(spark, sf):
    """Nearest-neighbour mutual information of today's return, and of its square, with the next day's."""
    d = fx.predictions(spark, sf).select("y", "p", (F.col("p") * F.col("p")).alias("energy"))
    return se.knn_mutual_information(d, ["p", "energy"], "y")


@register("select_top_mi", _mi_sql(top=10))
def q_select_top_mi(spark, sf):
    """Top 10 features by mutual information."""
    m, feats = _feature_table(spark, sf)
    return se.top_mutual_information(m, feats, "y", k=10, bins=10)



SELECTED = 10  # features kept by mutual information


def _selected_sql() -> str:
    base, feats = _fm_cte()
    mm, mi = _mi_bodies(feats)
    long = " UNION ALL ".join(f"SELECT date, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, y FROM fm" for f in feats)
    body = f"""SELECT date, replace(feature, 'adj_close', 'AdjClose') AS feature, value, y FROM ({long})
WHERE feature IN (SELECT feature FROM mi WHERE feature NOT IN (SELECT feature FROM cf WHERE dropped)
                  ORDER BY mi DESC, feature LIMIT {SELECTED})"""
    sql = base.replace("\nSELECT * FROM fm_body", f",\nmm AS ({mm}),\ncf AS ({_corr_filter_body(feats)}),"
                       f"\nmi AS ({mi})\n{body}")
    return rounded(sql, ["value", "y"])


@register("feature_matrix_selected", _selected_sql())
def q_feature_matrix_selected(spark, sf):
    """M3 with M1, M2 and P9: features, correlation filter, top features by mutual information and
    plain names, from a price column whose name has a space; long form, as the data choose the columns."""
    cfg = replace(DAILY, target_col="Adj Close", max_features=SELECTED)
    m, names = run_pipeline(fx.daily(spark, sf).withColumnRenamed("adj_close", "Adj Close"), cfg)
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in names])
    return m.select("date", F.inline(pairs), "y")
