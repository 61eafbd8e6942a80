"""Registered queries for the ordered-window family (lags, rolling, returns, fills)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog import register
from tidemill.functions.dates import parse_date
from tidemill.operators import features as fe
from tidemill.operators.series import row_index
from tidemill.plans.feature_pipeline import DAILY, FeatureConfig, build_features, load_series
from tidemill.sources import fixtures as fx
from tidemill.sources.fixture_sql import LONG_ORDER, rounded, with_fixtures

TICK_ORDER = ["ts", "event_id"]


def _lag_sql() -> str:
    lags = ", ".join(f"lag(value, {k}) OVER w AS value_lag{k}" for k in (1, 2, 3, 5, 21))
    body = (f"SELECT user_id, ts, event_id, value, {lags} FROM ticks "
            "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
    return rounded(with_fixtures(body, "ticks"), ["value"] + [f"value_lag{k}" for k in (1, 2, 3, 5, 21)])


@register("lag_features", _lag_sql())
def q_lag_features(spark, sf):
    """Positional lags per user series of the event stream."""
    return fe.lag_features(fx.ticks(spark, sf), ["value"], [1, 2, 3, 5, 21], TICK_ORDER, keys=["user_id"])


def _roll_sql(src: str, order: str, col: str, windows, stat: str, keep: str) -> str:
    fn = "avg" if stat == "mean" else "stddev_samp"
    parts = []
    for n in windows:
        w = f"(ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        parts.append(f"CASE WHEN count({col}) OVER {w} = {n} THEN {fn}({col}) OVER {w} END AS {col}_roll_{stat}_{n}")
    return f"SELECT {keep}, {', '.join(parts)} FROM {src}"


@register("rolling_mean", rounded(with_fixtures(
    _roll_sql("long_series", LONG_ORDER, "value", (5, 20), "mean", LONG_ORDER + ", value"), "long_series"),
    ["l_extendedprice", "value", "value_roll_mean_5", "value_roll_mean_20"]))
def q_rolling_mean(spark, sf):
    """Rolling mean over the whole line-item table as one long series (chunk + halo)."""
    return fe.rolling_features(fx.long_series(spark, sf), ["value"], [5, 20], fx.LONG_ORDER,
                               stats=("mean",), mode="chunked")


@register("rolling_std", rounded(with_fixtures(
    _roll_sql("daily", "date", "adj_close", (5, 20), "std", "date, adj_close"), "daily"),
    ["adj_close", "adj_close_roll_std_5", "adj_close_roll_std_20"]))
def q_rolling_std(spark, sf):
    """Rolling sample standard deviation of the daily price."""
    d = fx.daily(spark, sf).select("date", "adj_close")
    return fe.rolling_features(d, ["adj_close"], [5, 20], ["date"], stats=("std",), mode="single")


@register("log_return", rounded(with_fixtures(
    "SELECT date, adj_close, ln(adj_close / lag(adj_close) OVER (ORDER BY date)) AS log_return "
    "FROM daily WHERE adj_close > 0", "daily"), ["adj_close", "log_return"]))
def q_log_return(spark, sf):
    """W3 + P3: positive-price filter then log return."""
    return fe.log_return(fx.daily(spark, sf).select("date", "adj_close"), "adj_close", ["date"], mode="single")


@register("next_step_target", rounded(with_fixtures(
    "SELECT * FROM (SELECT user_id, ts, event_id, value, lead(value) OVER "
    "(PARTITION BY user_id ORDER BY ts, event_id) AS target_next FROM ticks) WHERE target_next IS NOT NULL",
    "ticks"), ["value", "target_next"]))
def q_next_step_target(spark, sf):
    """W2 + P2: next value per series, last row of each series dropped."""
    return fe.next_step_target(fx.ticks(spark, sf), "value", TICK_ORDER, keys=["user_id"])


@register("row_index", with_fixtures(
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ts, "
    f"row_number() OVER (ORDER BY {LONG_ORDER}) - 1 AS row_idx FROM long_series", "long_series"))
def q_row_index(spark, sf):
    """0-based position of every line item in time order, numbered without a global sort."""
    ls = fx.long_series(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ts",
                                          "l_extendedprice")
    out = row_index(ls, fx.LONG_ORDER, mode="chunked")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ts",
                      F.col("row_idx").cast("bigint").alias("row_idx"))


@register("pct_change", rounded(with_fixtures(
    "SELECT pos, qty, ff / NULLIF(lag(ff) OVER (ORDER BY pos), 0) - 1 AS pct_change FROM ("
    "SELECT pos, qty, last_value(qty IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) AS ff FROM dirty)", "dirty"), ["qty", "pct_change"]))
def q_pct_change(spark, sf):
    """Percent change after forward-filling gaps, in file order of the noisy table."""
    d = fx.dirty(spark, sf).select("pos", "qty")
    return fe.pct_change(d, "qty", ["pos"], mode="chunked")


@register("impute_ffill", rounded(with_fixtures(
    "SELECT pos, last_value(qty IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) AS qty FROM dirty", "dirty"), ["qty"]))
def q_impute_ffill(spark, sf):
    """Forward fill (leading gaps stay null), chunked carries."""
    d = fx.dirty(spark, sf).select("pos", "qty")
    return fe.forward_fill(d, ["qty"], ["pos"], mode="chunked")


def interp_sql(limit: int | None, src: str = "dirty", order: str = "pos", col: str = "qty",
               keep: str = "pos") -> str:
    base = f"""SELECT {keep}, {col}, rn,
  last_value(CASE WHEN {col} IS NOT NULL THEN rn END IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
  last_value({col} IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
  first_value(CASE WHEN {col} IS NOT NULL THEN rn END IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
  first_value({col} IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
FROM (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS rn FROM {src})"""
    inner = "CASE WHEN p1 = p0 THEN v0 ELSE v0 + (v1 - v0) * (rn - p0) / (p1 - p0) END"
    if limit is None:
        val = f"CASE WHEN p0 IS NOT NULL AND p1 IS NOT NULL THEN {inner} WHEN p0 IS NOT NULL THEN v0 END"
    else:
        val = (f"CASE WHEN p0 IS NOT NULL AND p1 IS NOT NULL AND (rn - p0 <= {limit} OR p1 - rn <= {limit}) "
               f"THEN {inner} WHEN p0 IS NOT NULL AND p1 IS NULL AND rn - p0 <= {limit} THEN v0 "
               f"WHEN p0 IS NULL AND p1 IS NOT NULL AND p1 - rn <= {limit} THEN v1 END")
    return f"SELECT {keep}, COALESCE(CAST({col} AS DOUBLE), {val}) AS {col} FROM ({base})"


@register("interpolate_linear", rounded(with_fixtures(interp_sql(None), "dirty"), ["qty"]))
def q_interpolate_linear(spark, sf):
    """W10 without a limit: interior gaps interpolated, trailing carried, leading null."""
    d = fx.dirty(spark, sf).select("pos", "qty")
    return fe.interpolate(d, ["qty"], ["pos"], limit=None, mode="chunked")


@register("interpolate_limit", rounded(with_fixtures(interp_sql(10), "dirty"), ["qty"]))
def q_interpolate_limit(spark, sf):
    """W10 with limit 10 in both directions (the cleaning script's setting)."""
    d = fx.dirty(spark, sf).select("pos", "qty")
    return fe.interpolate(d, ["qty"], ["pos"], limit=10, mode="chunked")


@register("moving_averages", rounded(with_fixtures(
    "SELECT date, adj_close, "
    "CASE WHEN count(adj_close) OVER w50 = 50 THEN avg(adj_close) OVER w50 END AS ma50, "
    "CASE WHEN count(adj_close) OVER w200 = 200 THEN avg(adj_close) OVER w200 END AS ma200 FROM daily "
    "WINDOW w50 AS (ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), "
    "w200 AS (ORDER BY date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)", "daily"),
    ["adj_close", "ma50", "ma200"]))
def q_moving_averages(spark, sf):
    """Price with 50- and 200-row moving averages."""
    return fe.moving_averages(fx.daily(spark, sf).select("date", "adj_close"), "adj_close", ["date"], mode="single")


@register("volatility", rounded(with_fixtures(
    "SELECT date, adj_close, ret, CASE WHEN count(ret) OVER w = 30 THEN stddev_samp(ret) OVER w END "
    "* sqrt(252) * 100 AS volatility FROM (SELECT date, adj_close, adj_close / NULLIF(lag(adj_close) OVER "
    "(ORDER BY date), 0) - 1 AS ret FROM daily) WINDOW w AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)",
    "daily"), ["adj_close", "ret", "volatility"]))
def q_volatility(spark, sf):
    """Annualised 30-row volatility of percent returns."""
    return fe.volatility(fx.daily(spark, sf).select("date", "adj_close"), "adj_close", ["date"], mode="single")


@register("tail_n", rounded(with_fixtures(
    "SELECT date, adj_close FROM daily ORDER BY date DESC LIMIT 60", "daily"), ["adj_close"]))
def q_tail_n(spark, sf):
    """The last 60 rows (a bounded top-k by date)."""
    return fe.tail_n(fx.daily(spark, sf).select("date", "adj_close"), 60, ["date"])


@register("order_check", with_fixtures(
    "SELECT COUNT(*) AS n_rows, CAST(COALESCE(SUM(back), 0) AS BIGINT) AS n_out_of_order FROM ("
    "SELECT CASE WHEN d < lag(d) OVER (ORDER BY pos) THEN 1 ELSE 0 END AS back FROM ("
    "SELECT pos, CAST(try_strptime(date_s, '%m/%d/%Y') AS DATE) AS d FROM dirty))", "dirty"))
def q_order_check(spark, sf):
    """How many rows (in file order) have a date earlier than the row before."""
    d = fx.dirty(spark, sf).select("pos", parse_date(F.col("date_s")).alias("d"))
    return fe.order_check(d, "d", ["pos"], mode="chunked")


@register("load_series", rounded(with_fixtures(
    "SELECT date, adj_close, volume FROM daily WHERE date IS NOT NULL AND adj_close IS NOT NULL "
    "AND volume IS NOT NULL", "daily"), ["adj_close", "volume"]))
def q_load_series(spark, sf):
    """Time-indexed load: parse the date column, drop rows with any null."""
    return load_series(fx.daily(spark, sf), "adj_close")


@register("dropna_any", with_fixtures(
    "SELECT * FROM dirty WHERE pos IS NOT NULL AND date_s IS NOT NULL AND price_s IS NOT NULL AND qty IS NOT NULL "
    "AND flag_s IS NOT NULL AND note IS NOT NULL", "dirty"))
def q_dropna_any(spark, sf):
    """Drop rows with a null in any column."""
    return fx.dirty(spark, sf).na.drop("any")


LAGS = (1, 2, 3, 5, 21)
WINDOWS = (5, 20)


def feature_matrix_sql(round_result: bool = True, src: str = "daily", keys: tuple = (), order: tuple = ("date",),
                       target: str = "adj_close", others: tuple = ("volume",)) -> str:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    ob = f"({part}ORDER BY {', '.join(order)})"
    cols = [target, *others, "log_return"]
    lag_exprs = [f"lag({c}, {k}) OVER {ob} AS {c}_lag{k}" for c in cols for k in LAGS]
    roll = []
    for n in WINDOWS:
        w = f"({part}ORDER BY {', '.join(order)} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        roll.append(f"CASE WHEN count(log_return) OVER {w} = {n} THEN avg(log_return) OVER {w} END "
                    f"AS log_return_roll_mean_{n}")
        roll.append(f"CASE WHEN count(log_return) OVER {w} = {n} THEN stddev_samp(log_return) OVER {w} END "
                    f"AS log_return_roll_std_{n}")
    feat_names = [f"{c}_lag{k}" for c in cols for k in LAGS]
    for n in WINDOWS:
        feat_names += [f"log_return_roll_mean_{n}", f"log_return_roll_std_{n}"]
    # output in the Spark column order: raw non-target columns, then lag/rolling columns by key column
    ordered = list(others)
    for c in cols:
        ordered += [f"{c}_lag{k}" for k in LAGS]
        if c == "log_return":
            for n in WINDOWS:
                ordered += [f"log_return_roll_mean_{n}", f"log_return_roll_std_{n}"]
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in feat_names)
    base_cols = [*keys, *order, target, *others]
    base_notnull = " AND ".join(f"{c} IS NOT NULL" for c in base_cols)
    sel = ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in ordered)
    lead_cols = ", ".join([*keys, *order])
    body = f"""SELECT {lead_cols}, {sel}, target_next AS y FROM (
  SELECT *, lead(log_return) OVER {ob} AS target_next FROM (
    SELECT * FROM (SELECT *, {', '.join(lag_exprs + roll)} FROM (
      SELECT * FROM (SELECT {', '.join(base_cols)}, ln({target} / lag({target}) OVER {ob}) AS log_return
                     FROM {src} WHERE {base_notnull} AND {target} > 0) WHERE log_return IS NOT NULL))
    WHERE {notnull}))
WHERE target_next IS NOT NULL"""
    if not round_result:
        return body, ordered
    return rounded(with_fixtures(body, src), ordered + ["y"])


@register("feature_matrix", feature_matrix_sql())
def q_feature_matrix(spark, sf):
    """M3 (flagship): daily prices -> log return -> lags + rolling moments -> next-day target."""
    return build_features(fx.daily(spark, sf), DAILY)


@register("feature_matrix_keyed", feature_matrix_sql(src="ticks", keys=("user_id",), order=("ts", "event_id"),
                                                     target="value", others=()))
def q_feature_matrix_keyed(spark, sf):
    """M3 per series: the same pipeline for every user of the event stream (keyed windows)."""
    cfg = FeatureConfig(target_col="value", date_col="ts", keys=("user_id",), tie_breakers=("event_id",))
    return build_features(fx.ticks(spark, sf), cfg)


def _gappy_ticks(spark, sf):
    t = fx.ticks(spark, sf)
    return t.withColumn("value", F.when((F.col("event_id") % 7).isin(0, 1), F.lit(None).cast("double"))
                        .otherwise(F.col("value")))


def _interp_keyed_sql(limit: int) -> str:
    base = f"""SELECT user_id, ts, event_id, v, rn,
  last_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
  last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
  first_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
  first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
FROM (SELECT user_id, ts, event_id, CASE WHEN event_id % 7 IN (0, 1) THEN NULL ELSE value END AS v,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn FROM ticks)"""
    inner = "CASE WHEN p1 = p0 THEN v0 ELSE v0 + (v1 - v0) * (rn - p0) / (p1 - p0) END"
    val = (f"CASE WHEN p0 IS NOT NULL AND p1 IS NOT NULL AND (rn - p0 <= {limit} OR p1 - rn <= {limit}) "
           f"THEN {inner} WHEN p0 IS NOT NULL AND p1 IS NULL AND rn - p0 <= {limit} THEN v0 "
           f"WHEN p0 IS NULL AND p1 IS NOT NULL AND p1 - rn <= {limit} THEN v1 END")
    return rounded(with_fixtures(f"SELECT user_id, ts, event_id, COALESCE(v, {val}) AS value FROM ({base})",
                                 "ticks"), ["value"])


@register("interpolate_keyed", _interp_keyed_sql(3))
def q_interpolate_keyed(spark, sf):
    """W10 per series: linear interpolation (limit 3, both directions) within each user's events."""
    return fe.interpolate(_gappy_ticks(spark, sf), ["value"], TICK_ORDER, keys=["user_id"], limit=3)
