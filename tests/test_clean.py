"""Cleaning, parsing, imputation, scaling: hand-worked edge tables."""

import pytest
from pyspark.sql import functions as F

from tidemill.functions.dates import parse_date
from tidemill.functions.scalar import text_code_sum, to_numeric
from tidemill.operators import clean as cl
from tidemill.operators import impute as im
from tidemill.operators import profile as pr
from tidemill.operators import scale as sc
from tidemill.operators.correlation import corr_long


def test_strict_date_parse(spark):
    df = spark.createDataFrame([("1/5/2012",), ("01/06/2012",), ("2012-01-07",), ("1/5/12",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_date(F.col("s"))).collect()]
    assert [None if g is None else g.isoformat() for g in got] == ["2012-01-05", "2012-01-06", None, None, None]


def test_numeric_parse(spark):
    df = spark.createDataFrame([(x,) for x in ["1e5", " 12 ", "1_000", "nan", "0x1A", "1d"]], "s string")
    assert [r[0] for r in df.select(to_numeric(F.col("s"))).collect()] == [100000.0, 12.0, None, None, None, None]


def test_quantiles_linear(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 10]], "x double")
    r = pr.describe_numeric(df).first()
    assert (r["p25"], r["p50"], r["p75"]) == (1.75, 2.5, 4.75)


def test_mode_tie_is_smallest(spark):
    df = spark.createDataFrame([(2.0,), (1.0,), (2.0,), (1.0,), (None,)], "x double")
    out = im.fill_missing(df, "mode")
    assert sorted(r[0] for r in out.collect()) == [1.0, 1.0, 1.0, 2.0, 2.0]


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 3.0)], "c double, x double")
    assert [r[0] for r in sc.scale(df, "standard", ["c"]).collect()] == [0.0, 0.0, 0.0]
    assert [r[0] for r in sc.scale(df, "minmax", ["c"]).collect()] == [0.0, 0.0, 0.0]
    r = corr_long(df, ["c", "x"], include_diagonal=False, upper_only=True).first()
    assert r["r"] is None


def test_text_code_sum(spark):
    df = spark.createDataFrame([("nan",), ("é",), (None,)], "t string")
    assert [r[0] for r in df.select(text_code_sum(F.col("t"))).collect()] == [317, 233, None]


def test_clean_date_interpolates_dedupes_sorts(spark):
    rows = [(0, "01/01/2020", 1.0), (1, None, 2.0), (2, "01/05/2020", 3.0), (3, "01/05/2020", 4.0),
            (4, "bad", 5.0), (5, "01/10/2020", 6.0)]
    df = spark.createDataFrame(rows, "pos long, d string, v double")
    out = cl.clean_date(df, "d", ["pos"])
    got = [(r["d"].isoformat(), r["pos"]) for r in out.collect()]
    # pos 1 -> day 2.5 rounds half-even to Jan 3; pos 4 -> Jan 7.5 -> Jan 8; keep-first drops pos 3
    assert got == [("2020-01-01", 0), ("2020-01-03", 1), ("2020-01-05", 2), ("2020-01-08", 4), ("2020-01-10", 5)]


def test_drop_sparse_columns_then_rows(spark):
    rows = [(1, None, "a"), (2, None, None), (3, 3.0, None), (4, None, "d")]
    df = spark.createDataFrame(rows, "k long, x double, s string")
    out = cl.drop_sparse(df, 2 / 3)
    assert out.columns == ["k"] and out.count() == 4


def test_infer_types(spark):
    rows = [(1, 1.0, "true", "01/02/2020", "x"), (2, 2.0, "false", "01/03/2020", "y"), (3, 3.5, "1", "bad", "z")]
    df = spark.createDataFrame(rows, "a long, b double, c string, d string, e string")
    got = {r["column"]: r["suggested"] for r in cl.infer_types(df).collect()}
    assert got == {"a": "int", "b": "float", "c": "bool", "d": "str", "e": "str"}


def test_convert_raise_and_coerce(spark):
    df = spark.createDataFrame([("1.5",), ("2",)], "s string")
    assert [r[0] for r in cl.convert_types(df, {"s": "int"}, errors="coerce").collect()] == [None, 2]
    with pytest.raises(Exception):
        cl.convert_types(df, {"s": "int"}, errors="raise").collect()


def test_decimal_comma_keeps_text(spark):
    df = spark.createDataFrame([("1,5", "a"), ("2.25", "b")], "p string, t string")
    out = cl.fix_decimal_comma(df, date_col=None)
    assert [tuple(r) for r in out.collect()] == [(1.5, "a"), (2.25, "b")]


def test_callable_conversion_uses_arrow_udf(spark):
    df = spark.createDataFrame([("ab",), ("abc",)], "s string")
    out = cl.convert_types(df, {"s": (len, "bigint")}).collect()
    assert [r[0] for r in out] == [2, 3]


def test_unknown_format_raises(spark):
    from tidemill.sources.io import read_table
    with pytest.raises(ValueError):
        read_table(spark, "/tmp/x.xlsx")


def test_label_codes_distributed_rank_matches_window(spark, monkeypatch):
    from tidemill.operators import encode
    df = spark.range(5000).select((F.col("id") * 7919 % 3001).cast("string").alias("s"))
    small = {r[0]: r[1] for r in encode.value_codes(df, "s", "c")[0].collect()}
    monkeypatch.setattr(encode, "BROADCAST_MAX_ROWS", 100)
    monkeypatch.setattr(encode, "RANK_PARTITION_ROWS", 400)
    big = {r[0]: r[1] for r in encode.value_codes(df, "s", "c")[0].collect()}
    assert small == big and sorted(big.values()) == list(range(len(big)))


def test_interpolating_an_integer_column_keeps_fractions(spark):
    df = spark.createDataFrame([(0, 1), (1, None), (2, 2)], "i long, x long")
    out = im.fill_missing(df, "interpolate", order_by=["i"])
    assert [r["x"] for r in out.orderBy("i").collect()] == [1.0, 1.5, 2.0]


def test_mean_fill_of_integer_column_is_not_truncated(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x long")
    assert sorted(r[0] for r in im.fill_missing(df, "mean").collect()) == [1.0, 1.5, 2.0]


def test_file_order_drives_keep_first(spark):
    from tests.conftest import SF_SMALL
    from tidemill.session import scratch_path
    from tidemill.sources import fixtures as fx
    from tidemill.sources.io import FILE_ORDER, read_table, with_file_order, write_csv
    d = fx.dirty(spark, SF_SMALL).dropDuplicates(["pos"])
    path = write_csv(d.repartitionByRange(3, "pos").sortWithinPartitions("pos"), scratch_path(spark, "ordered.csv"))
    raw = read_table(spark, path, fmt="csv", schema="pos bigint, date_s string, price_s string, qty double, "
                                                    "flag_s string, note string")
    by_file = cl.clean_date(with_file_order(raw), "date_s", FILE_ORDER).select("date_s", "pos")
    by_pos = cl.clean_date(d, "date_s", ["pos"]).select("date_s", "pos")
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, by_file.collect()), key=key) == sorted(map(tuple, by_pos.collect()), key=key)


def test_onehot_cardinality_guard(spark):
    from tidemill.operators import encode
    df = spark.range(50).select(F.col("id").cast("string").alias("s"))
    with pytest.raises(ValueError):
        encode.onehot_encode(df, "s", max_categories=10)
    out = encode.onehot_encode(df.limit(3), "s", max_categories=10)
    assert sorted(out.columns) == ["s_0", "s_1", "s_2"]


def test_describe_categorical_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    r = pr.describe_categorical(df, ["c"]).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (4, 2, "a", 2)


def test_clean_table_chains_the_script(spark):
    from tidemill.plans.cleaning import clean_table
    rows = [(0, "01/02/2020", "1,5", 1.0, "true", None), (1, "01/03/2020", "2,5", None, "false", None),
            (2, "01/03/2020", "9,9", 9.0, "true", "x"), (3, "bad", "3,5", 2.0, "true", None),
            (4, "01/07/2020", "4,5", 4.0, "false", None)]
    df = spark.createDataFrame(rows, "pos long, d string, price string, qty double, flag string, note string")
    out = clean_table(df, "d", ["pos"])
    assert dict(out.dtypes) == {"pos": "bigint", "d": "date", "price": "double", "qty": "double", "flag": "boolean"}
    got = [(str(r["d"]), r["price"], r["qty"], r["flag"]) for r in out.orderBy("d").collect()]
    assert got == [("2020-01-02", 1.5, 1.0, True), ("2020-01-03", 2.5, 1.5, False),
                   ("2020-01-05", 3.5, 2.0, True), ("2020-01-07", 4.5, 4.0, False)]
