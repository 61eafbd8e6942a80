"""Hot groups: one instant or one key holding a large share of all rows."""

from pyspark.sql import functions as F

from tidemill.operators import features as fe
from tidemill.operators.series import row_index


def _skewed(spark, n=3000, hot_share=3):
    # every third row sits on the same timestamp; the rest are spread over a year
    return spark.range(n).select(
        F.when(F.col("id") % hot_share == 0, F.lit("2024-01-01 00:00:00"))
        .otherwise(F.date_format(F.timestamp_seconds(F.col("id") * 10000 + 1_700_000_000), "yyyy-MM-dd HH:mm:ss"))
        .cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("tie"), (F.col("id") % 17).cast("double").alias("v"))


def test_hot_instant_is_split_and_numbering_exact(spark):
    df = _skewed(spark)
    plain = row_index(df, ["ts", "tie"], mode="plain")
    chunked = row_index(df, ["ts", "tie"], mode="chunked", target_bucket_rows=100)
    a = sorted(tuple(r) for r in plain.select("ts", "tie", "row_idx").collect())
    b = sorted(tuple(r) for r in chunked.select("ts", "tie", "row_idx").collect())
    assert a == b


def test_hot_key_windows_match_plain(spark):
    df = _skewed(spark).withColumn("k", F.when(F.col("tie") % 3 == 0, F.lit(0)).otherwise(F.col("tie") % 5 + 1))
    a = fe.lag_features(df, ["v"], [1, 4], ["ts", "tie"], keys=["k"], mode="plain")
    b = fe.lag_features(df, ["v"], [1, 4], ["ts", "tie"], keys=["k"], mode="chunked", chunk_rows=64)
    cols = ["k", "tie", "v_lag1", "v_lag4"]
    assert sorted(tuple(r) for r in a.select(cols).collect()) == sorted(tuple(r) for r in b.select(cols).collect())


def test_hybrid_mode_routes_hot_keys(spark, monkeypatch):
    from tidemill.operators import series
    monkeypatch.setattr(series, "HOT_KEY_ROWS", 500)
    df = _skewed(spark).withColumn("k", F.when(F.col("tie") % 3 == 0, F.lit(None)).otherwise(F.col("tie") % 5 + 1))
    plan = series.plan_series(df, ["ts", "tie"], ["k"], "auto", chunk_rows=64)
    assert plan.mode == "hybrid" and plan.n_hot == 1  # the NULL key holds a third of the rows
    a = fe.lag_features(df, ["v"], [1, 2], ["ts", "tie"], keys=["k"], mode="plain")
    b = fe.lag_features(df, ["v"], [1, 2], ["ts", "tie"], keys=["k"], mode=plan)
    cols = ["k", "tie", "v_lag1", "v_lag2"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in a.select(cols).collect()), key=key) == \
        sorted((tuple(r) for r in b.select(cols).collect()), key=key)
    ia = fe.interpolate(df, ["v"], ["ts", "tie"], keys=["k"], limit=2, mode="plain")
    ib = fe.interpolate(df, ["v"], ["ts", "tie"], keys=["k"], limit=2, mode=plan)
    cols = ["k", "tie", "v"]
    assert sorted((tuple(r) for r in ia.select(cols).collect()), key=key) == \
        sorted((tuple(r) for r in ib.select(cols).collect()), key=key)


def test_hot_instant_inside_a_mixed_bucket_is_cut_by_its_tie_breaker(spark):
    # a third of the rows share one instant whose neighbours are microseconds away
    n, target = 12000, 200
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(5_000_000)).when(F.col("id") % 3 == 1, F.col("id") % 40 + 4_999_980)
        .otherwise(F.col("id") * 1_000_000).alias("ts"),
        F.col("id").alias("tie"), (F.col("id") % 17).cast("double").alias("v"))
    b = row_index(df, ["ts", "tie"], mode="chunked", target_bucket_rows=target, keep_buckets=True)
    assert b.groupBy("__bk", "__sb").count().agg(F.max("count")).first()[0] <= 4 * target
    a = row_index(df, ["ts", "tie"], mode="plain")
    assert a.select("tie", "row_idx").exceptAll(b.select("tie", "row_idx")).isEmpty()
    x = fe.lag_features(df, ["v"], [1, 300], ["ts", "tie"], mode="chunked", chunk_rows=target)
    y = fe.lag_features(df, ["v"], [1, 300], ["ts", "tie"], mode="plain")
    assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


def test_hot_buckets_with_null_ties_and_text_ties_keep_their_order(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 5 != 0, F.lit(7)).alias("ts"),
        F.when(F.col("id") % 4 != 0, F.lit(3)).alias("tie"),
        F.format_string("%05d", F.col("id")).alias("name"), F.col("id"))
    for order in (["ts", "tie", "id"], ["ts", "tie", "name"], ["ts", "name", "id"]):
        a = row_index(df, order, mode="plain")
        b = row_index(df, order, mode="chunked", target_bucket_rows=50)
        assert a.exceptAll(b.select(a.columns)).isEmpty()


def test_hot_instant_with_text_ties_is_cut(spark):
    n, target = 40_000, 500
    code = F.md5(F.col("id").cast("string"))
    ts = F.when(F.col("id") % 3 == 0, F.lit(5_000_000)).otherwise(F.col("id") * 1_000)
    texts = {"digest": code, "shared": F.concat(F.lit("order-é-"), F.format_string("%06d", F.col("id"))),
             "odd": F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 5 == 0, F.concat(F.lit("\x7f日本"), code))
             .when(F.col("id") % 2 == 0, F.concat(F.lit("ab"), F.repeat(F.lit("x"), 30), code)).otherwise(F.lit("ab"))}
    for name, text in texts.items():
        df = spark.range(n).select(ts.alias("ts"), text.alias("name"), F.col("id"))
        b = row_index(df, ["ts", "name", "id"], mode="chunked", target_bucket_rows=target, keep_buckets=True)
        assert b.groupBy("__bk", "__sb").count().agg(F.max("count")).first()[0] <= 4 * target, name
        a = row_index(df, ["ts", "name", "id"], mode="plain")
        assert a.select("id", "row_idx").exceptAll(b.select("id", "row_idx")).isEmpty(), name
