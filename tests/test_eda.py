"""EDA helpers: column resolution, candle fallback, rebasing, reports."""

import datetime as dt

from tests.conftest import SF_SMALL
from tidemill.operators import eda
from tidemill.plans.report import market_report, report_sizes, table_report
from tidemill.sources import fixtures as fx


def test_resolve_column_priority():
    cols = ["USO_Open", "USO_Close", "USO_Adj Close", "SP_open"]
    assert eda.resolve_column(cols, ["USO_"]) == "USO_Adj Close"
    assert eda.resolve_column(["SP_open", "SP_volume"], ["SP_"]) == "SP_open"
    assert eda.resolve_column(cols, ["XX_"]) is None


def test_candle_open_falls_back_to_previous_close(spark):
    rows = [(dt.date(2020, 1, d), 10.0 + d, 9.0 + d, float(d)) for d in range(1, 6)]
    df = spark.createDataFrame(rows, "date date, high double, low double, close double")
    out = {r["date"].day: (r["open"], r["up"]) for r in eda.candlestick(df, 3, open_col=None).collect()}
    # the slice is the last 3 days; its first open is its own close, then the previous close
    assert out == {3: (3.0, True), 4: (3.0, True), 5: (4.0, True)}


def test_rebased_constant_column_is_null(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, d), float(d), 5.0) for d in range(1, 4)],
                               "date date, p double, c double")
    got = {r["date"].day: (r["p"], r["c"]) for r in eda.rebased_series(df, "p", ["c"]).collect()}
    assert got == {1: (0.0, None), 2: (0.5, None), 3: (1.0, None)}


def test_reports_build(spark):
    rep = market_report(fx.assets(spark, SF_SMALL), fx.ohlc(spark, SF_SMALL), "adj_close",
                        ["a_price", "n_price", "r_price"])
    sizes = {r["part"]: r["n_rows"] for r in report_sizes(rep).collect()}
    assert sizes["candles"] == 60 and sizes["cross_lag"] == 21 and sizes["seasonal"] > 0
    tab = table_report(fx.table(spark, SF_SMALL, "labels"))
    assert {"chart_kind", "bar:quality", "hist:doc_id"} <= set(tab)


def test_market_report_picks_assets_by_prefix(spark):
    prices = fx.assets(spark, SF_SMALL).withColumnRenamed("a_price", "AX_Close").withColumnRenamed("n_price", "NX_open")
    rep = market_report(prices, None, "adj_close", asset_prefixes={"first": ["AX_"], "second": ["NX_"]})
    assets = {r["asset"] for r in rep["cross_lag"].select("asset").distinct().collect()}
    assert assets == {"AX_Close", "NX_open"}


def test_quantile_bins_survive_heavy_tails(spark):
    import math
    from tidemill.operators.select import mutual_information
    from tidemill.operators.stats import part_edges
    rows = [(float(i), float(10 ** (i % 50)), float(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, heavy double, y double")
    assert part_edges(df, ["x"], 4) == {"x": [50.0, 100.0, 150.0]}
    got = {r["feature"]: r["mi"] for r in mutual_information(df, ["x", "heavy"], "y", bins=50).collect()}
    assert math.isclose(got["heavy"], math.log(2), rel_tol=1e-9)  # every power of ten has its own bin
    assert mutual_information(df.where("x < 0"), ["x"], "y").count() == 0
