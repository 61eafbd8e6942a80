"""Date layouts, own-clock timestamps, stable correlations, unknown columns, fitted encoders, text ties."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions.dates import normalize_date, normalize_timestamp
from tidemill.operators import clean, correlation, eda, impute

D = dt.date


@pytest.mark.parametrize("text,day", [
    ("Jan 5, 2020", D(2020, 1, 5)), ("january 5 2020", D(2020, 1, 5)), ("5 January 2020", D(2020, 1, 5)), ("5-Jan-2020", D(2020, 1, 5)),
    ("2020 May 07", D(2020, 5, 7)), ("May 3rd, 2021", D(2021, 5, 3)), ("20200105", D(2020, 1, 5)), ("2020-01-05T03:04:05+02:00", D(2020, 1, 5)),
    ("1/5/2020 3:04 PM", D(2020, 1, 5)), ("Sept 5, 2020", None), ("Foo 5, 2020", None), ("20201305", None), ("99999999", None),
    ("", None), ("5 January 20", None), ("13/02/2020", D(2020, 2, 13)), ("Feb 30, 2020", None)])
def test_date_layouts(spark, text, day):
    assert spark.createDataFrame([(text,)], "s string").select(normalize_date(F.col("s"))).first()[0] == day


def test_times_offsets_and_formats(spark):
    want = {"2020-01-05T03:04:05+02:00": dt.datetime(2020, 1, 5, 1, 4, 5), "1/5/2020 3:04 PM": dt.datetime(2020, 1, 5, 15, 4),
            "1/5/2020 12:00 am": dt.datetime(2020, 1, 5), "Jan 5, 2020, 12:30 p.m.": dt.datetime(2020, 1, 5, 12, 30),
            "2020-01-05 23:00:00.25 -0530": dt.datetime(2020, 1, 6, 4, 30, 0, 250000), "20200105 01:02Z": dt.datetime(2020, 1, 5, 1, 2),
            "5 May 2020": dt.datetime(2020, 5, 5), "1/5/2020 13:04 PM": None, "2020-01-05 24:10": None, "noise 3:04": None}
    df = spark.createDataFrame([(k,) for k in want], "s string")
    got = {r.s: r.t for r in df.select("s", normalize_timestamp(F.col("s")).alias("t")).collect()}
    assert got == want
    df = spark.createDataFrame([("05|2020|01", "7h 05.01.2020", "Jan 5, 2020", "1/5/2020 3:04 PM")], "a string, b string, c string, d string")
    out = clean.convert_types(df, (["a", "b", "c", "d"], "datetime"), formats={"a": "dd|yyyy|MM", "b": "H'h' dd.MM.yyyy"}).first()
    assert tuple(out) == (D(2020, 1, 5), dt.datetime(2020, 1, 5, 7), D(2020, 1, 5), dt.datetime(2020, 1, 5, 15, 4))
    with pytest.raises(ValueError, match="no such column: zz"):
        clean.convert_types(df, {"zz": "int"})
    with pytest.raises(Exception, match="unparseable"):
        clean.convert_types(df, {"a": "datetime"}).collect()


def test_gaps_of_own_clock_timestamps(spark):
    rows = [(0, "2020-01-01 00:00:00"), (1, None), (2, "2020-01-11 00:00:00"), (3, "2020-01-06 12:30:00.000001"), (4, "2020-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "i int, s string").select("i", F.col("s").cast("timestamp_ntz").alias("t"))

    def at(strategy):
        out = impute.fill_missing(df, strategy, order_by=["i"])
        assert dict(out.dtypes)["t"] == "timestamp_ntz"
        return {r.i: r.t for r in out.collect()}
    assert at("interpolate")[1] == dt.datetime(2020, 1, 6)
    assert at("median")[1] == dt.datetime(2020, 1, 3, 18, 15)
    assert at("mode")[1] == dt.datetime(2020, 1, 1)
    assert at("ffill")[1] == dt.datetime(2020, 1, 1) and at("interpolate")[3] == dt.datetime(2020, 1, 6, 12, 30, 0, 1)
    old = spark.sql("select 1 i, timestamp_ntz'1901-02-03 04:05:06' t union all select 2, null union all select 3, timestamp_ntz'1901-02-03 04:05:08'")
    assert impute.fill_missing(old, "interpolate", order_by=["i"]).where("i = 2").first().t == dt.datetime(1901, 2, 3, 4, 5, 7)


def test_correlation_far_from_zero_and_beside_outliers(spark):
    rows = [(0.0, None, 1.0)] + [(1e9 + k, float(k), None if k % 3 else float(k * k)) for k in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    got = {(r.col_a, r.col_b): r.r for r in correlation.corr_long(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(1.0, abs=1e-12) and got["b", "a"] == got["a", "b"]
    k = np.arange(0, 300, 3.0)
    assert got["b", "c"] == pytest.approx(np.corrcoef(k, k * k)[0, 1], rel=1e-12)
    odd = spark.createDataFrame([(float("inf"), 1.0, float("nan"), 0.1, None), (1.0, 2.0, 2.0, 0.1, None), (2.0, 4.0, 1.0, 0.1, None)],
                                "i double, x double, n double, k double, e double")
    got = {(r.col_a, r.col_b): r.r for r in correlation.corr_long(odd, odd.columns).collect()}
    assert got["i", "x"] is None and got["x", "n"] == pytest.approx(-1.0) and got["k", "x"] is None and got["k", "k"] is None
    assert got["e", "x"] is None and len(got) == 25
    assert correlation.corr_long(odd.limit(0), ["x", "n"]).where("r is null").count() == 4


def test_price_columns_by_keyword_then_place():
    cols = ["gold_open", "gold_close", "gold_Price", "oil_Price", "oil_x", "gold_Adj Close"]
    assert eda.resolve_column(cols, ["gold"]) == "gold_Adj Close"
    assert eda.resolve_column(cols[:3], ["gold"]) == "gold_close"
    assert eda.resolve_column(cols, ["oil"]) == "oil_Price" and eda.resolve_column(["oil_x", "oil_y"], ["oil"]) == "oil_x"
    assert eda.resolve_column(cols, ["tin"]) is None


def test_kernel_density_equals_the_plain_sum(spark):
    from tidemill.operators.profile import kde
    rng = np.random.default_rng(4)
    for x in (rng.normal(size=4000), np.r_[rng.normal(size=50), 400.0], np.r_[np.full(40, 3.25), 3.5, 9.0], rng.lognormal(sigma=2, size=500)):
        got = sorted(kde(spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double"), "v", 120).collect())
        h = len(x) ** -0.2 * x.std(ddof=1)
        grid = np.linspace(x.min(), x.max(), 120)
        want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
        assert [r.point for r in got] == list(range(120))
        assert np.allclose([r.density for r in got], want, rtol=1e-11, atol=1e-300)
    many = spark.range(1_000_000).select((F.xxhash64("id") / 1e18).alias("v"))
    assert kde(many, "v").agg(F.sum("density")).first()[0] > 0


def test_code_tables_apply_to_new_rows_and_any_number_of_values(spark):
    from tidemill.operators import encode
    from tidemill.session import scratch_path
    train = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4), ("", 5)], "c string, code int")
    new = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "c string, code int")
    table = encode.fit_codes(train, "c")
    again = encode.CodeTable.load(spark, "c", table.save(scratch_path(spark, "codes")))
    for t in (table, again):
        assert t.size == 3 and {r.code: r.c_code for r in t.encode(new).collect()} == {1: 1, 2: None, 3: None}
    assert {r.code: r.c_code for r in table.encode(new, unseen="last").collect()} == {1: 1, 2: 3, 3: None}
    with pytest.raises(Exception, match="not in the code table"):
        table.encode(new, unseen="raise").collect()
    assert [r.code for r in table.encode(train, "code").collect()].count(None) == 1     # replaces a column of that name
    vec = {r.code: r.v for r in table.vectors(new, "v").collect()}
    assert [list(vec[k].toArray()) for k in (1, 2, 3)] == [[0, 1, 0], [0, 0, 0], [0, 0, 0]]
    wide = spark.range(100_000).select(F.concat(F.lit("v"), F.col("id")).alias("c"))
    t = encode.fit_codes(wide, "c")
    row = t.vectors(wide.where("c = 'v42'")).first()
    assert t.size == 100_000 and row.c_vec.size == 100_000 and list(row.c_vec.indices) == [t.codes.where("value = 'v42'").first().code]
    assert encode.fit_codes(wide.limit(0), "c").encode(new).where("c_code is null").count() == 3
