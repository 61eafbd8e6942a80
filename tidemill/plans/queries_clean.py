"""Registered queries for scans/sinks, cleaning, imputation, outliers, encoding, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog import register
from tidemill.functions.dates import normalize_date, normalize_date_sql, normalize_timestamp, parse_date
from tidemill.functions.scalar import NUMBER_PATTERN, text_code_sum, to_numeric
from tidemill.operators import clean as cl
from tidemill.operators import encode as en
from tidemill.operators import impute as im
from tidemill.operators import outliers as ol
from tidemill.operators import profile as pr
from tidemill.operators import scale as sc
from tidemill.plans.cleaning import clean_table
from tidemill.plans.feature_pipeline import sanitize_names
from tidemill.plans.queries_series import interp_sql
from tidemill.session import scratch_path
from tidemill.sources import fixtures as fx
from tidemill.sources.fixture_sql import rounded, with_fixtures
from tidemill.sources.io import FILE_ORDER, read_table, with_file_order, write_csv, write_json

DIRTY_COLS = ["pos", "date_s", "price_s", "qty", "flag_s", "note"]
DIRTY_SCHEMA = "pos bigint, date_s string, price_s string, qty double, flag_s string, note string"
NUM_RE = NUMBER_PATTERN.strip("^$")


def _to_numeric_sql(x: str) -> str:
    return f"CASE WHEN regexp_full_match(CAST({x} AS VARCHAR), '{NUM_RE}') THEN TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE) END"


def _mode_sql(col: str, src: str = "dirty") -> str:
    return (f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT 1)")


# ---------------------------------------------------------------- scans / sinks

@register("scan_csv", rounded(with_fixtures("SELECT * FROM dirty", "dirty"), ["qty"]))
def q_scan_csv(spark, sf):
    """The noisy table written as CSV (header, no index) and scanned back with a schema."""
    path = write_csv(fx.dirty(spark, sf), scratch_path(spark, "dirty.csv"))
    return read_table(spark, path, fmt="csv", schema=DIRTY_SCHEMA)


@register("scan_json", rounded(with_fixtures("SELECT * FROM dirty", "dirty"), ["qty"]))
def q_scan_json(spark, sf):
    """JSON sink and scan of the noisy table."""
    path = write_json(fx.dirty(spark, sf), scratch_path(spark, "dirty.json"))
    return read_table(spark, path, fmt="json", schema=DIRTY_SCHEMA)


@register("csv_roundtrip", rounded(with_fixtures("SELECT * FROM daily", "daily"), ["adj_close", "volume"]))
def q_csv_roundtrip(spark, sf):
    """S5 + S1 + SC6: export the daily table, read it back as text, convert to the named types."""
    path = write_csv(fx.daily(spark, sf), scratch_path(spark, "daily.csv"))
    raw = read_table(spark, path, fmt="csv")
    return cl.convert_types(raw, {"date": "datetime", "adj_close": "float", "volume": "float"}, errors="coerce")


@register("profile_missing", with_fixtures(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS n_missing FROM dirty HAVING COUNT(*) - COUNT({c}) > 0"
    for c in DIRTY_COLS), "dirty"))
def q_profile_missing(spark, sf):
    """Missing cells per column, only columns that have any."""
    return pr.profile_missing(fx.dirty(spark, sf))


# ---------------------------------------------------------------- dates

@register("parse_date", with_fixtures(
    "SELECT pos, date_s, CASE WHEN regexp_full_match(trim(date_s), '\\d{1,2}/\\d{1,2}/\\d{4}') "
    "THEN CAST(try_strptime(trim(date_s), '%m/%d/%Y') AS DATE) END AS date FROM dirty", "dirty"))
def q_parse_date(spark, sf):
    """SC1: strict month/day/year parse, bad -> null."""
    d = fx.dirty(spark, sf)
    return d.select("pos", "date_s", parse_date(F.col("date_s")).alias("date"))


# The text layouts used to derive the multi-format date column.
DATE_LAYOUTS = [("MM/dd/yyyy", "%m/%d/%Y"), ("yyyy-MM-dd", "%Y-%m-%d"), ("dd.MM.yyyy", "%d.%m.%Y"),
                ("dd/MM/yy", "%d/%m/%y"), ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S")]


def _date_texts(spark, sf):
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey") % len(DATE_LAYOUTS)
    txt = None
    for i, (fmt, _) in enumerate(DATE_LAYOUTS):
        e = F.date_format("o_orderdate", fmt)
        txt = F.when(k == i, e) if txt is None else txt.when(k == i, e)
    return o.select("o_orderkey", txt.alias("text"))


def _date_texts_sql() -> str:
    cases = " ".join(f"WHEN o_orderkey % {len(DATE_LAYOUTS)} = {i} THEN strftime(o_orderdate, '{f}')"
                     for i, (_, f) in enumerate(DATE_LAYOUTS))
    return f"SELECT o_orderkey, CASE {cases} END AS text FROM orders"


# The text layouts of the timestamp query, each with what its text leaves out of the time.
STAMP_LAYOUTS = ["MMM d, yyyy", "d MMMM yyyy h:mm a", "yyyyMMdd", "yyyy-MM-dd'T'HH:mm:ss'+02:00'", "M/d/yyyy h:mm a", "MMMM d yyyy, HH:mm"]


@register("normalize_timestamp", """SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 6 IN (0, 2) THEN day
       WHEN o_orderkey % 6 = 3 THEN stamp - INTERVAL 2 HOUR ELSE stamp END, '%Y-%m-%d %H:%M:%S') AS stamp
FROM (SELECT o_orderkey, day, day + to_minutes(o_orderkey % 1440) AS stamp FROM
      (SELECT o_orderkey, date_trunc('day', o_orderdate) AS day FROM orders))""")
def q_normalize_timestamp(spark, sf):
    """SC2/SC5: month names, compact dates, AM/PM and offsets parsed back to the stamp they were written from."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("day"))
    o = o.withColumn("t", F.expr("timestampadd(MINUTE, cast(o_orderkey % 1440 as int), day)"))
    text = F.date_format("t", STAMP_LAYOUTS[0])
    for k, fmt in enumerate(STAMP_LAYOUTS[1:], 1):
        text = F.when(F.col("o_orderkey") % len(STAMP_LAYOUTS) == k, F.date_format("t", fmt)).otherwise(text)
    return o.select("o_orderkey", F.date_format(normalize_timestamp(text), "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@register("normalize_date", f"SELECT o_orderkey, text, {normalize_date_sql('text')} AS date FROM ({_date_texts_sql()})")
def q_normalize_date(spark, sf):
    """SC2: multi-format date normaliser (month-first, day-first, year-first, 2-digit years)."""
    return _date_texts(spark, sf).select("o_orderkey", "text", normalize_date(F.col("text")).alias("date"))


def _clean_date_body() -> str:
    base = """SELECT *, row_number() OVER (ORDER BY pos) - 1 AS rn,
  CAST(date_diff('day', DATE '1970-01-01', CASE WHEN regexp_full_match(trim(date_s), '\\d{1,2}/\\d{1,2}/\\d{4}')
       THEN CAST(try_strptime(trim(date_s), '%m/%d/%Y') AS DATE) END) + 719163 AS DOUBLE) AS o FROM dirty"""
    nb = f"""SELECT *,
  last_value(CASE WHEN o IS NOT NULL THEN rn END IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
  last_value(o IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
  first_value(CASE WHEN o IS NOT NULL THEN rn END IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
  first_value(o IGNORE NULLS) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
FROM ({base})"""
    inner = "CASE WHEN p1 = p0 THEN v0 ELSE v0 + (v1 - v0) * (rn - p0) / (p1 - p0) END"
    filled = (f"SELECT pos, price_s, qty, flag_s, note, COALESCE(o, round_even(CASE WHEN p0 IS NOT NULL AND p1 IS NOT NULL "
              f"THEN {inner} WHEN p0 IS NOT NULL THEN v0 END, 0)) AS o FROM ({nb})")
    dated = f"SELECT pos, price_s, qty, flag_s, note, DATE '1970-01-01' + CAST(o - 719163 AS INTEGER) AS date_s FROM ({filled})"
    return (f"SELECT date_s, pos, price_s, qty, flag_s, note FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY date_s ORDER BY pos) AS k FROM ({dated})) WHERE k = 1")


def _clean_date_sql() -> str:
    return rounded(with_fixtures(_clean_date_body(), "dirty"), ["qty"])


@register("clean_date", _clean_date_sql())
def q_clean_date(spark, sf):
    """SC1 + W11 + W13 + T1 + SC10: parse, interpolate day numbers in file order, keep first per date, sort."""
    return cl.clean_date(fx.dirty(spark, sf), "date_s", ["pos"], mode="chunked")


# ---------------------------------------------------------------- sparse / duplicates

RATIO = 2 / 3


@register("drop_sparse_columns", with_fixtures(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS n_valid, COUNT(*) AS n_rows, COUNT({c}) < COUNT(*) * {RATIO!r} AS dropped "
    f"FROM dirty" for c in DIRTY_COLS), "dirty"))
def q_drop_sparse_columns(spark, sf):
    """Per column valid-cell count against rows x 2/3 and the drop decision."""
    return cl.sparse_column_report(fx.dirty(spark, sf), RATIO)


def _sparse_rows_sql() -> str:
    keep = ", ".join(f"COUNT({c}) >= COUNT(*) * {RATIO!r} AS k_{c}" for c in DIRTY_COLS)
    nvalid = " + ".join(f"CASE WHEN k_{c} AND {c} IS NOT NULL THEN 1 ELSE 0 END" for c in DIRTY_COLS)
    nkeep = " + ".join(f"CAST(k_{c} AS INTEGER)" for c in DIRTY_COLS)
    return with_fixtures(
        f"SELECT pos, n_valid FROM (SELECT pos, {nvalid} AS n_valid, ({nkeep}) * {RATIO!r} AS need "
        f"FROM dirty, (SELECT {keep} FROM dirty)) WHERE n_valid >= need", "dirty")


@register("drop_sparse_rows", _sparse_rows_sql())
def q_drop_sparse_rows(spark, sf):
    """P5: after dropping sparse columns, drop rows with fewer than 2/3 valid cells."""
    kept = cl.drop_sparse(fx.dirty(spark, sf), RATIO)
    return kept.select("pos", cl.valid_cells(kept.columns).alias("n_valid"))


@register("drop_duplicates", rounded(with_fixtures("SELECT DISTINCT * FROM dirty", "dirty"), ["qty"]))
def q_drop_duplicates(spark, sf):
    """Whole-row de-duplication."""
    return cl.drop_duplicates(fx.dirty(spark, sf))


@register("duplicate_report", with_fixtures(
    "SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_duplicate_members, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) "
    "AS n_removed, COUNT(*) AS n_groups FROM (SELECT COUNT(*) AS n FROM dirty GROUP BY ALL HAVING COUNT(*) > 1)",
    "dirty").replace("GROUP BY ALL", "GROUP BY " + ", ".join(DIRTY_COLS)))
def q_duplicate_report(spark, sf):
    """Members of duplicate groups and rows a de-duplication removes."""
    return cl.duplicate_report(fx.dirty(spark, sf))


# ---------------------------------------------------------------- numbers and types

@register("fix_decimal_comma", rounded(with_fixtures(
    f"SELECT pos, date_s, {_to_numeric_sql(chr(39) + 'x' + chr(39))} AS price_s, qty, flag_s, note FROM dirty"
    .replace("'x'", "replace(price_s, ',', '.')"), "dirty"), ["price_s", "qty"]))
def q_fix_decimal_comma(spark, sf):
    """SC3: text columns of numbers with a decimal comma or point become doubles; text stays text."""
    return cl.fix_decimal_comma(fx.dirty(spark, sf), date_col="date_s")


@register("to_numeric", rounded(with_fixtures(
    f"SELECT pos, price_s, {_to_numeric_sql('price_s')} AS price FROM dirty", "dirty"), ["price"]))
def q_to_numeric(spark, sf):
    """SC4: numeric coercion, anything but a plain decimal number -> null."""
    d = fx.dirty(spark, sf)
    return d.select("pos", "price_s", to_numeric(F.col("price_s")).alias("price"))


def _infer_sql() -> str:
    parts = [
        "SELECT 'pos' AS \"column\", 'int' AS current, CASE WHEN COALESCE(bool_and(pos % 1 = 0), true) THEN 'int' "
        "ELSE 'float' END AS suggested FROM dirty",
        "SELECT 'qty', 'float', CASE WHEN COALESCE(bool_and(qty % 1 = 0), true) THEN 'int' ELSE 'float' END FROM dirty",
    ]
    for c in ["date_s", "price_s", "flag_s", "note"]:
        parts.append(
            f"SELECT '{c}', 'str', CASE WHEN COUNT({c}) = 0 THEN 'str' "
            f"WHEN COUNT(CASE WHEN regexp_matches({c}, '[-/:.]') THEN 1 END) > COUNT({c}) * 0.3 "
            f"AND COUNT({normalize_date_sql(c)}) > COUNT({c}) * 0.8 THEN 'datetime' "
            f"WHEN COUNT(CASE WHEN lower({c}) IN ('true', 'false', '0', '1') THEN 1 END) = COUNT({c}) THEN 'bool' "
            f"WHEN COUNT(DISTINCT {c}) < COUNT({c}) * 0.05 THEN 'category' ELSE 'str' END FROM dirty")
    return with_fixtures(" UNION ALL ".join(parts), "dirty")


@register("infer_types", _infer_sql())
def q_infer_types(spark, sf):
    """SC7/SC8/A4: suggested type per column from one aggregation."""
    return cl.infer_types(fx.dirty(spark, sf))


@register("convert_types", rounded(with_fixtures(
    f"SELECT {_to_numeric_sql('pos')} AS pos, {normalize_date_sql('date_s')} AS date_s, "
    f"{_to_numeric_sql('price_s')} AS price_s, "
    f"CASE WHEN ({_to_numeric_sql('qty')}) % 1 = 0 THEN CAST({_to_numeric_sql('qty')} AS BIGINT) END AS qty, "
    "TRY_CAST(lower(trim(flag_s)) AS BOOLEAN) AS flag_s, note FROM dirty", "dirty"), ["pos", "price_s"]))
def q_convert_types(spark, sf):
    """SC5/SC6: bulk conversion with errors coerced to null."""
    mapping = {"pos": "float", "date_s": "datetime", "price_s": "float", "qty": "int", "flag_s": "bool",
               "note": "category"}
    return cl.convert_types(fx.dirty(spark, sf), mapping, errors="coerce")


@register("text_code_sum", "SELECT doc_id, CAST(list_sum(list_transform(string_split(text, ''), "
          "lambda x: unicode(x))) AS BIGINT) AS code_sum FROM documents")
def q_text_code_sum(spark, sf):
    """SC9: sum of code points over every whole document."""
    d = fx.table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", text_code_sum(F.col("text")).alias("code_sum"))


@register("auto_convert", rounded(with_fixtures(
    f"SELECT pos, {normalize_date_sql('date_s')} AS date_s, price_s, CAST(qty AS BIGINT) AS qty, "
    "CAST(flag_s AS BOOLEAN) AS flag_s, note FROM dirty", "dirty"), []))
def q_auto_convert(spark, sf):
    """SC7 + SC8: every column converted to its inferred type (dates, whole numbers, booleans)."""
    return cl.auto_convert(fx.dirty(spark, sf))[0]


_COMMA = "replace(price_s, ',', '.')"


def _clean_table_sql() -> str:
    numbers = (f"SELECT date_s, pos, {_to_numeric_sql(_COMMA)} AS price_s, qty, flag_s "
               f"FROM ({_clean_date_body()})")
    filled = interp_sql(10, src=f"({numbers})", order="date_s NULLS FIRST", keep="date_s, pos, price_s, flag_s")
    return rounded(with_fixtures(
        f"SELECT date_s, pos, price_s, qty, CAST(flag_s AS BOOLEAN) AS flag_s FROM ({filled})", "dirty"),
        ["price_s", "qty"])


@register("clean_table", _clean_table_sql())
def q_clean_table(spark, sf):
    """The cleaning script end to end; columns need half their cells here, so that the gappy
    quantity stays and is interpolated while the sparse note goes."""
    return clean_table(fx.dirty(spark, sf), "date_s", ["pos"], ratio=0.5)


# ---------------------------------------------------------------- imputation

def _impute_sql(strategy: str) -> str:
    qty = {"mean": "(SELECT avg(qty) FROM dirty)", "median": "(SELECT quantile_cont(qty, 0.5) FROM dirty)",
           "mode": _mode_sql("qty"), "custom": "0.0"}[strategy]
    txt = (lambda c: "'0'") if strategy == "custom" else _mode_sql
    return rounded(with_fixtures(
        f"SELECT pos, COALESCE(date_s, {txt('date_s')}) AS date_s, price_s, COALESCE(qty, {qty}) AS qty, flag_s, "
        f"COALESCE(note, {txt('note')}) AS note FROM dirty", "dirty"), ["qty"])


@register("impute_mean", _impute_sql("mean"))
def q_impute_mean(spark, sf):
    """Numeric gaps -> column mean; text gaps -> mode."""
    return im.fill_missing(fx.dirty(spark, sf), "mean")


@register("impute_median", _impute_sql("median"))
def q_impute_median(spark, sf):
    """Numeric gaps -> exact median; text gaps -> mode."""
    return im.fill_missing(fx.dirty(spark, sf), "median")


@register("impute_mode", _impute_sql("mode"))
def q_impute_mode(spark, sf):
    """Every gap -> the column's most frequent value (smallest on ties)."""
    return im.fill_missing(fx.dirty(spark, sf), "mode")


@register("impute_constant", _impute_sql("custom"))
def q_impute_constant(spark, sf):
    """E5: every gap -> a constant."""
    return im.fill_missing(fx.dirty(spark, sf), "custom", value=0)


# ---------------------------------------------------------------- outliers

DAILY2 = ["adj_close", "volume"]


def _iqr_sql() -> str:
    q = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in DAILY2)
    flags = ", ".join(f"COALESCE({c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c}), "
                      f"false) AS {c}_outlier" for c in DAILY2)
    return rounded(with_fixtures(f"SELECT date, adj_close, volume, {flags} FROM daily, (SELECT {q} FROM daily)",
                                 "daily"), DAILY2)


@register("outliers_iqr", _iqr_sql())
def q_outliers_iqr(spark, sf):
    """IQR fences per numeric column."""
    return ol.iqr_flags(fx.daily(spark, sf), DAILY2)


def _z_sql() -> str:
    st = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in DAILY2)
    flags = ", ".join(f"COALESCE(abs(({c} - m_{c}) / NULLIF(s_{c}, 0)) > 3, false) AS {c}_outlier" for c in DAILY2)
    return rounded(with_fixtures(f"SELECT date, adj_close, volume, {flags} FROM daily, (SELECT {st} FROM daily)",
                                 "daily"), DAILY2)


@register("outliers_zscore", _z_sql())
def q_outliers_zscore(spark, sf):
    """Population z-score above 3."""
    return ol.zscore_flags(fx.daily(spark, sf), DAILY2)


def _repair_sql() -> str:
    q = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in DAILY2)
    masked = ", ".join(f"CASE WHEN {c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c}) "
                       f"THEN NULL ELSE {c} END AS {c}" for c in DAILY2)
    fill = ", ".join(f"COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM m)) AS {c}" for c in DAILY2)
    return rounded(with_fixtures(
        f"SELECT date, {fill} FROM m", "daily").replace(
        "\nSELECT date,", f",\nm AS (SELECT date, {masked} FROM daily, (SELECT {q} FROM daily))\nSELECT date,", 1),
        DAILY2)


@register("repair_outliers", _repair_sql())
def q_repair_outliers(spark, sf):
    """IQR outliers -> null -> median fill."""
    return ol.repair_outliers(fx.daily(spark, sf), "iqr", DAILY2)


@register("outliers_iforest")
def q_outliers_iforest(spark, sf):
    """Isolation-forest flags (1 % contamination) on daily price and volume."""
    return ol.iforest_flags(fx.daily(spark, sf), DAILY2)


# ---------------------------------------------------------------- encoders / scalers

@register("label_encode", with_fixtures(
    "SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment IS NOT NULL THEN dense_rank() OVER "
    "(ORDER BY c_mktsegment) - 1 END AS c_mktsegment_code FROM categorical", "categorical"))
def q_label_encode(spark, sf):
    """Sorted-order label codes, null stays null."""
    return en.label_encode(fx.categorical(spark, sf), "c_mktsegment")


@register("code_table", """WITH t AS (SELECT o_clerk, row_number() OVER (ORDER BY o_clerk) - 1 AS code FROM
  (SELECT DISTINCT 'clerk-' || (o_custkey % 5000) AS o_clerk FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'))
SELECT o.o_orderkey, coalesce(t.code, (SELECT COUNT(*) FROM t)) AS code FROM orders o LEFT JOIN t ON t.o_clerk = 'clerk-' || (o.o_custkey % 5000)
WHERE o.o_orderdate >= TIMESTAMP '1996-01-01'""")
def q_code_table(spark, sf):
    """A code table fitted on early orders applied to later ones; values it lacks get the code after the last."""
    o = fx.table(spark, sf, "orders").withColumn("clerk", F.concat(F.lit("clerk-"), F.col("o_custkey") % 5000))
    late = F.col("o_orderdate") >= F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    return en.fit_codes(o.where(~late), "clerk").encode(o.where(late), "code", unseen="last").select("o_orderkey", "code")


# The market segments present in the customer table.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("onehot_encode", rounded(with_fixtures(
    "SELECT c_custkey, " + ", ".join(
        f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END AS c_mktsegment_{s}" for s in SEGMENTS)
    + " FROM categorical", "categorical"), [f"c_mktsegment_{s}" for s in SEGMENTS]))
def q_onehot_encode(spark, sf):
    """One 0/1 column per sorted category."""
    return en.onehot_encode(fx.categorical(spark, sf), "c_mktsegment")


@register("scale_standard", rounded(with_fixtures(
    "SELECT date, " + ", ".join(
        f"CASE WHEN {c} IS NULL THEN NULL WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 "
        f"ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS {c}" for c in DAILY2)
    + " FROM daily", "daily"), DAILY2))
def q_scale_standard(spark, sf):
    """(x - mean) / population std; constant -> 0."""
    return sc.scale(fx.daily(spark, sf), "standard", DAILY2)


@register("scale_minmax", rounded(with_fixtures(
    "SELECT date, " + ", ".join(
        f"CASE WHEN {c} IS NULL THEN NULL WHEN max({c}) OVER () = min({c}) OVER () THEN 0.0 "
        f"ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END AS {c}" for c in DAILY2)
    + " FROM daily", "daily"), DAILY2))
def q_scale_minmax(spark, sf):
    """(x - min) / (max - min); constant -> 0."""
    return sc.scale(fx.daily(spark, sf), "minmax", DAILY2)


@register("scale_train_test", rounded(with_fixtures(
    "SELECT date, " + ", ".join(
        f"CASE WHEN {c} IS NULL THEN NULL WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END AS {c}"
        for c in DAILY2) + " FROM daily, (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in DAILY2)
    + " FROM (SELECT * FROM daily ORDER BY date LIMIT 1000))", "daily"), DAILY2))
def q_scale_train_test(spark, sf):
    """Standard scaler fitted on the first 1000 days, applied to every day."""
    from tidemill.operators.series import row_index
    d = fx.daily(spark, sf)
    train = row_index(d, ["date"]).where(F.col("row_idx") < 1000).drop("row_idx")
    return sc.scale(d, "standard", DAILY2, fit_on=train)


@register("sanitize_columns", rounded(with_fixtures(
    'SELECT date AS Date, adj_close AS AdjClose, volume AS USO_Volumek FROM daily', "daily"),
    ["AdjClose", "USO_Volumek"]))
def q_sanitize_columns(spark, sf):
    """Strip characters outside [A-Za-z0-9_] from column names."""
    d = fx.daily(spark, sf).select(F.col("date").alias("Date"), F.col("adj_close").alias("Adj Close"),
                                   F.col("volume").alias("USO_Volume (k)"))
    return sanitize_names(d)


@register("clean_date_csv", _clean_date_sql())
def q_clean_date_csv(spark, sf):
    """S1 + W11/W13: the noisy table as CSV files in position order, scanned back, and the date
    repair driven by *file order* (file index, split offset, row within split) -- no key column."""
    d = fx.dirty(spark, sf)
    path = write_csv(d.repartitionByRange("pos").sortWithinPartitions("pos"), scratch_path(spark, "dirty-ordered.csv"))
    raw = with_file_order(read_table(spark, path, fmt="csv", schema=DIRTY_SCHEMA))
    return cl.clean_date(raw, "date_s", FILE_ORDER, mode="chunked").drop(*FILE_ORDER)
