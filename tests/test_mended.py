"""Hand-worked cases: dates with times, date fills, short series, names, exact statistics."""

import datetime as dt

import numpy as np
import pytest

from tidemill.operators import clean, correlation, folds, impute, outliers, stats
from tidemill.operators.features import interpolate
from tidemill.operators.series import row_index
from tidemill.plans import feature_pipeline as fp


def test_datetime_conversion_keeps_times(spark):
    df = spark.sql("""SELECT TIMESTAMP '2024-01-01 10:20:30.5' AS ts, '1/2/2024 10:20:30.5' AS a, '2024-01-02T03:04:05Z' AS b,
                      '3.4.2024' AS c, DATE '2024-05-06' AS d""")
    r = clean.convert_types(df, (["ts", "a", "b", "c", "d"], "datetime")).first()
    assert r.ts == dt.datetime(2024, 1, 1, 10, 20, 30, 500000)
    assert r.a == dt.datetime(2024, 1, 2, 10, 20, 30, 500000) and r.b == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r.c == dt.date(2024, 3, 4) and r.d == dt.date(2024, 5, 6)


def test_date_gaps(spark):
    rows = [(0, dt.date(2020, 1, 1), "x"), (1, None, None), (2, dt.date(2020, 1, 11), "y"), (3, dt.date(2020, 1, 1), "y"), (4, dt.date(2020, 3, 1), "x")]
    df = spark.createDataFrame(rows, "i int, d date, s string")
    med = {r.i: r for r in impute.fill_missing(df, "median").collect()}
    assert med[1].d == dt.date(2020, 1, 6) and med[1].s == "x"
    lin = {r.i: r for r in impute.fill_missing(df, "interpolate", order_by=["i"]).collect()}
    assert lin[1].d == dt.date(2020, 1, 6) and lin[1].s == "x" and lin[4].d == dt.date(2020, 3, 1)
    assert impute.fill_missing(df, "mode").where("i = 1").first().d == dt.date(2020, 1, 1)


def test_short_series_has_no_fold(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", i) for i in range(30)], "k string, t int")
    t = folds.fold_table(df, ["t"], folds.FoldSpec(train=20, test=5, purge=0), keys=["k"]).collect()
    assert {r.k for r in t} == {"b"}


def test_selected_names_are_in_the_matrix(spark):
    rng = np.random.default_rng(0)
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(50 + rng.normal()), float(10 + rng.random())) for i in range(300)]
    df = spark.createDataFrame(rows, "date date, `Adj Close` double, `Vol %` double")
    m, names = fp.run_pipeline(df, fp.FeatureConfig(target_col="Adj Close", mode="single"))
    assert names and set(names) <= set(m.columns)


def test_text_dates_with_times_stay_times(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", 1.0), ("2024-01-01 11:00:00", 2.0)], "date string, p double")
    assert fp.load_series(df, "p").select("date").distinct().count() == 2
    day = spark.createDataFrame([("2024-01-01", 1.0)], "date string, p double")
    assert dict(fp.load_series(day, "p").dtypes)["date"] == "date"


def test_empty_and_null_order_input_in_chunks(spark):
    df = spark.createDataFrame([], "t bigint, v double")
    assert interpolate(df, ["v"], ["t"], mode="chunked").count() == 0
    nulls = spark.createDataFrame([(None, 1.0), (None, 2.0)], "t bigint, v double")
    out = row_index(nulls, ["t", "v"], mode="chunked")
    assert sorted(r.row_idx for r in out.collect()) == [0, 1]
    assert dict(out.dtypes)["row_idx"] == "bigint" == dict(row_index(nulls, ["t", "v"], mode="plain").dtypes)["row_idx"]


@pytest.mark.parametrize("rows", [4096, 3])
def test_quantiles_are_exact_in_any_number_of_passes(spark, monkeypatch, rows):
    monkeypatch.setattr(stats, "COLLECT_ROWS", rows)
    rng = np.random.default_rng(1)
    x, y = np.round(rng.lognormal(size=400) * 100, 3), rng.integers(0, 4, 400).astype(float)
    df = spark.createDataFrame([(float(a), float(b), 7.0, None) for a, b in zip(x, y)] + [(float("nan"), None, None, None)],
                               "x double, y double, c double, e double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = stats.quantiles(df, ["x", "y", "c", "e"], qs)
    for q in qs:
        assert got["x", q] == pytest.approx(np.quantile(x, q), rel=1e-12)
        assert got["y", q] == pytest.approx(np.quantile(y, q), rel=1e-12)
        assert got["c", q] == 7.0 and got["e", q] is None


def test_pairwise_correlation_with_nulls_many_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 120)) + 1000
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 5] = 3.0
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], [f"c{k}" for k in range(120)])
    got = {(r.i, r.j): r.r for r in correlation.corr_long(df, df.columns, upper_only=True).collect()}
    for i, j in ((0, 1), (3, 77), (118, 119)):
        ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert got[i, j] == pytest.approx(np.corrcoef(x[ok, i], x[ok, j])[0, 1], rel=1e-9)
    assert got[4, 5] is None


def test_forest_flags_are_the_rarest(spark):
    rng = np.random.default_rng(3)
    v = np.r_[rng.normal(size=990), np.full(10, 50.0) + np.arange(10)]
    df = spark.createDataFrame([(float(a), None if i % 7 else float(a)) for i, a in enumerate(v)], "v double, w double")
    out = outliers.iforest_flags(df).toPandas()
    assert out[out.v_outlier].v.abs().min() > 2 and 5 <= out.v_outlier.sum() <= 10
    assert not out[out.w.isna()].w_outlier.any()


def test_report_rows_hold_the_values(spark):
    from tests.conftest import SF_SMALL
    from tidemill.plans.report import market_report, report_rows
    from tidemill.sources import fixtures as fx
    rep = market_report(fx.assets(spark, SF_SMALL), None, "adj_close", ["a_price", "n_price"])
    parts = report_rows(rep).groupBy("part").count().collect()
    assert {r["part"] for r in parts} >= {"trend", "volatility", "pair:a_price", "rebased", "top_matrix"}
    assert rep["top_matrix"].count() == 9


def test_forest_draws_copies_by_row(spark):
    # 11 values over 60,000 rows, of which a tree set of 50 x 80 draws a fifteenth
    few = spark.range(60_000).selectExpr("CASE WHEN id % 200 = 7 THEN 1000D ELSE id % 10 END AS v")
    out = outliers.iforest_flags(few, n_trees=50, sample_size=80).groupBy("v", "v_outlier").count().collect()
    assert {(r.v, r["count"]) for r in out if r.v_outlier} == {(1000.0, 300)}
    # copies of one row hold a third of the rows, and so of the draw
    third = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 5D ELSE id END AS v", "CAST(NULL AS INT) AS w")
    for seed in range(4):
        x = outliers._draw(third, ["v", "w"], 6000, seed)
        assert set(x) == {0} and len(x[0]) == 6000
        assert abs((x[0] == 5).mean() - 1 / 3) < 0.03
        assert abs(np.median(x[0][x[0] != 5]) - 30_000) < 2000
    # all rows are drawn where there are few, and one value may hold them all
    assert sorted(outliers._draw(few.limit(500), ["v"], 500, 0)[0]) == sorted(r.v for r in few.limit(500).collect())
    assert outliers._draw(spark.range(10**6).selectExpr("7 AS v"), ["v"], 900, 0)[0].tolist() == [7.0] * 900
