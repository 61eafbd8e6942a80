"""Ordered-window core: hand-worked edge tables and chunked == plain equivalence."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, values
from tidemill.operators import features as fe
from tidemill.operators.series import ordered_columns, row_index
from tidemill.sources import fixtures as fx

N = None
GAPPY = [N, N, 1, N, N, N, N, N, 7, N, N, N]


def seq(spark, xs):
    return spark.createDataFrame([(i, None if x is None else float(x)) for i, x in enumerate(xs)], "i long, x double")


@pytest.mark.parametrize("mode,chunk", [("plain", 1_000_000), ("chunked", 3), ("chunked", 5)])
def test_interpolate_limit_both(spark, mode, chunk):
    out = fe.interpolate(seq(spark, GAPPY), ["x"], ["i"], limit=2, mode=mode, chunk_rows=chunk)
    assert values(out, "x") == [1, 1, 1, 2, 3, N, 5, 6, 7, 7, 7, N]


@pytest.mark.parametrize("mode,chunk", [("plain", 1_000_000), ("chunked", 4)])
def test_interpolate_no_limit(spark, mode, chunk):
    out = fe.interpolate(seq(spark, GAPPY), ["x"], ["i"], limit=None, mode=mode, chunk_rows=chunk)
    assert values(out, "x") == [N, N, 1, 2, 3, 4, 5, 6, 7, 7, 7, 7]


@pytest.mark.parametrize("mode", ["plain", "chunked"])
def test_pct_change_with_gap(spark, mode):
    out = fe.pct_change(seq(spark, [1, N, 2]), "x", ["i"], mode=mode, chunk_rows=2)
    assert values(out, "pct_change") == [N, 0, 1]


@pytest.mark.parametrize("mode", ["plain", "chunked"])
def test_rolling_mean_with_gap(spark, mode):
    out = fe.rolling_features(seq(spark, [1, N, 3, 4, 5]), ["x"], [2], ["i"], stats=("mean",), mode=mode, chunk_rows=2)
    assert values(out, "x_roll_mean_2") == [N, N, N, 3.5, 4.5]


@pytest.mark.parametrize("mode", ["plain", "chunked"])
def test_forward_fill_keeps_leading_nulls(spark, mode):
    out = fe.forward_fill(seq(spark, [N, 2, N, N, 5, N]), ["x"], ["i"], mode=mode, chunk_rows=2)
    assert values(out, "x") == [N, 2, 2, 2, 5, 5]


def test_interpolation_keeps_known_values(spark):
    xs = [float(i % 7) if i % 3 else None for i in range(50)]
    out = fe.interpolate(seq(spark, xs), ["x"], ["i"], limit=3, mode="chunked", chunk_rows=7)
    got = values(out, "x")
    assert all(g == x for g, x in zip(got, xs) if x is not None)


def test_chunked_equals_plain_unkeyed(spark):
    ls = fx.long_series(spark, SF_SMALL)
    order = fx.LONG_ORDER

    def build(w):
        return {"l5": F.lag("value", 5).over(w), "ld": F.lead("value", 2).over(w),
                "m7": fe.rolling_mean_expr("value", w, 7)}
    plain = ordered_columns(ls, order, [], build, back=6, fwd=2, mode="plain")
    chunked = ordered_columns(ls, order, [], build, back=6, fwd=2, mode="chunked", chunk_rows=500)
    key = order
    a = sorted(tuple(r) for r in plain.select(*key, "l5", "ld", "m7").collect())
    b = sorted(tuple(r) for r in chunked.select(*key, "l5", "ld", "m7").collect())
    assert a == b


def test_row_index_chunked_matches_row_number(spark):
    ls = fx.long_series(spark, SF_SMALL)
    a = row_index(ls, fx.LONG_ORDER, mode="plain").select(*fx.LONG_ORDER, "row_idx")
    b = row_index(ls, fx.LONG_ORDER, mode="chunked", target_bucket_rows=300).select(*fx.LONG_ORDER, "row_idx")
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())
    assert sorted(r[0] for r in b.select("row_idx").collect()) == list(range(ls.count()))


def test_keyed_chunked_equals_plain(spark):
    t = fx.ticks(spark, SF_SMALL)
    order = ["ts", "event_id"]
    a = fe.lag_features(t, ["value"], [1, 3], order, keys=["user_id"], mode="plain")
    b = fe.lag_features(t, ["value"], [1, 3], order, keys=["user_id"], mode="chunked", chunk_rows=7)
    cols = ["user_id", "event_id", "value_lag1", "value_lag3"]
    assert sorted(tuple(r) for r in a.select(cols).collect()) == sorted(tuple(r) for r in b.select(cols).collect())
    ia = fe.interpolate(t.withColumn("value", F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("value"))),
                        ["value"], order, keys=["user_id"], limit=1, mode="plain")
    ib = fe.interpolate(t.withColumn("value", F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("value"))),
                        ["value"], order, keys=["user_id"], limit=1, mode="chunked", chunk_rows=4)
    cols = ["user_id", "event_id", "value"]
    ra = sorted((u, e, None if v is None else round(v, 9)) for u, e, v in ia.select(cols).collect())
    rb = sorted((u, e, None if v is None else round(v, 9)) for u, e, v in ib.select(cols).collect())
    assert ra == rb


def test_unkeyed_long_series_shuffles_rows_once(spark):
    ls = fx.long_series(spark, SF_SMALL)
    out = fe.rolling_features(ls, ["value"], [20], fx.LONG_ORDER, stats=("mean",), mode="chunked", chunk_rows=500)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the feature window sits directly on the union of numbered rows and halo rows:
    # no exchange between them (the union keeps the numbering's hash partitioning)
    top = next(i for i, line in enumerate(lines) if "Window [count(value" in line)
    below = [line for line in lines[top + 1:] if "Sort [" not in line]
    assert "Union" in below[0]
    # only the numbering exchange moves whole rows; the halo exchange follows a group limit
    assert sum("Exchange hashpartitioning(__bk" in line and "REPARTITION" not in line for line in lines) >= 1
    assert any("WindowGroupLimit" in line for line in lines)
