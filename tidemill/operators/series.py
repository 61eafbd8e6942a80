"""Ordered-window core: row positions, bounded windows and unbounded carries.

Every positional operator in this package (lag, lead, rolling moments, percent
change, forward fill, interpolation, fold numbering) is built on three calls:

* ``row_index``      -- 0-based position in ``order_by`` order, per series key.
* ``ordered_columns`` -- bounded-frame window expressions (lag/lead/rolling).
* ``known_neighbours`` -- nearest known ``(pos, value)`` before/after each row.

Two physical strategies are chosen per call:

``plain``
    ``Window.partitionBy(keys).orderBy(order_by)``.  One shuffle, parallel over
    keys.  With no keys this is a single-partition window, so it is used only
    for small (already aggregated) series or when asked for explicitly.

``hybrid`` (``auto`` with keys when some series are hot)
    The hot keys (a small list) are split off with a broadcast semi/anti join;
    ordinary series take the plain window, hot series the chunked path, and the
    two results are unioned.

``chunked``
    Rows are numbered without a global sort: a monotone bucket of the leading
    order column is counted per ``(keys, bucket)``; a prefix sum over that small
    table gives each bucket's offset; ``row_number`` inside the bucket finishes
    the position.  Bounded frames run on those same buckets: the ``back`` rows
    before (and ``fwd`` after) every bucket are copied in as halo rows found by a
    per-bucket top-k, through a small exchange partitioned like the numbering, so
    the row data is shuffled once.  Unbounded carries are finished from a
    per-bucket summary table.  A single very long series, or one key holding a
    third of all rows, is therefore spread over ``rows / chunk_rows`` tasks.
    Small side tables are broadcast only when their row count is known to be
    within the limit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import scratch_path

# Tunables (rows).  chunk_rows bounds the rows a window task buffers.
DEFAULT_CHUNK_ROWS = 1_000_000
SINGLE_MAX_ROWS = 250_000        # un-keyed series up to this size run in one partition
HOT_KEY_ROWS = 5_000_000         # keyed series larger than this switch to chunked mode
BROADCAST_MAX_ROWS = 2_000_000   # side tables above this are shuffle-joined instead

Builder = Callable[[Window], dict[str, Column]]


def _keys(keys: Sequence[str] | None) -> list[str]:
    return list(keys or [])


def window_spec(order_by: Sequence[str], keys: Sequence[str] | None = None, descending: bool = False):
    keys = _keys(keys)
    w = Window.partitionBy(*keys) if keys else Window
    return w.orderBy(*[F.col(c).desc() if descending else F.col(c) for c in order_by])


def _upto_here(order_by, keys, descending=False):
    """Running frame.  A frame reaching *unbounded following* is re-aggregated per row in
    Spark (quadratic), so "next known" is computed as a running frame in reverse order."""
    return window_spec(order_by, keys, descending).rowsBetween(Window.unboundedPreceding, 0)


MIN_CHUNK_ROWS = 65_536


def _order_number(df: DataFrame, c: str) -> Column:
    """A monotone numeric image of an order column (time-zone free)."""
    dt = df.schema[c].dataType
    col = F.col(c)
    if isinstance(dt, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(dt, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{c}`)").cast("double")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(dt, T.NumericType):
        return col.cast("double")
    raise TypeError(f"order column {c!r} of type {dt.simpleString()} cannot be bucketed")


def _is_integral(df: DataFrame, c: str) -> bool:
    dt = df.schema[c].dataType
    return isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType, T.ByteType, T.ShortType,
                           T.IntegerType, T.LongType))


def _bucketable(df: DataFrame, c: str) -> bool:
    dt = df.schema[c].dataType
    return isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType, T.NumericType))


def _fixed_width(f: T.StructField) -> bool:
    """Whether a value's size is bounded by its type; ``__`` columns are this module's own numbers."""
    dt = f.dataType
    if f.name.startswith("__"):
        return not isinstance(dt, T.StructType) or all(
            not isinstance(g.dataType, (T.StringType, T.BinaryType)) for g in dt.fields)
    return not isinstance(dt, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))


def _join_on(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
             small_rows: int | None = None) -> DataFrame:
    """Null-safe equi-join (series keys and buckets may be NULL and still form a group,
    as they do in ``groupBy`` / ``partitionBy``).  ``small`` is broadcast only when its
    row count is known to be within the limit and its rows have a fixed width; otherwise
    AQE decides at run time by measured bytes."""
    on = list(on)
    ren = small.select(*[F.col(c).alias(f"__r_{c}") for c in on], *[c for c in small.columns if c not in on])
    if small_rows is not None and small_rows <= BROADCAST_MAX_ROWS and all(map(_fixed_width, small.schema)):
        ren = F.broadcast(ren)
    cond = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on]
    out = big.join(ren, on=cond, how=how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__r_{c}" for c in on])


def series_stats(df: DataFrame, order_by: Sequence[str]) -> tuple[float, float, int] | None:
    """``(min, max)`` of the leading order column as a number and the row count (one job)."""
    t = _order_number(df, order_by[0])
    st = df.agg(F.min(t).alias("lo"), F.max(t).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if not st["n"] or st["lo"] is None:
        return None
    return float(st["lo"]), float(st["hi"]), int(st["n"])


def auto_chunk_rows(spark, n: int) -> int:
    """Rows per chunk: enough chunks to occupy every core twice, never above the
    memory-safe default and not so small that halo copies dominate."""
    par = spark.sparkContext.defaultParallelism
    return int(min(DEFAULT_CHUNK_ROWS, max(MIN_CHUNK_ROWS, n // max(1, 2 * par))))


@dataclass(frozen=True)
class SeriesPlan:
    """A resolved strategy that multi-stage pipelines reuse (planning jobs run once).
    ``stats`` bound the leading order column, so they stay valid for filtered subsets;
    ``hot_keys`` lists the series routed to the chunked path in ``hybrid`` mode."""
    mode: str
    stats: tuple | None
    chunk_rows: int
    hot_keys: DataFrame | None = None
    n_hot: int = 0


def plan_series(df: DataFrame, order_by: Sequence[str], keys: Sequence[str] | None = None, mode="auto",
                chunk_rows: int | None = None) -> SeriesPlan:
    """Decide ``plain`` / ``chunked`` / ``hybrid`` (one or two small aggregate jobs)."""
    if isinstance(mode, SeriesPlan):
        return mode
    keys = _keys(keys)
    if mode in ("plain", "single"):
        return SeriesPlan("plain", None, chunk_rows or DEFAULT_CHUNK_ROWS)
    if mode not in ("auto", "chunked"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "auto" and keys:
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__kn"))
        summ = per_key.agg(F.count(F.when(F.col("__kn") > HOT_KEY_ROWS, 1)).alias("nh"),
                           F.sum(F.when(F.col("__kn") > HOT_KEY_ROWS, F.col("__kn"))).alias("rows")).first()
        if not summ["nh"]:
            return SeriesPlan("plain", None, chunk_rows or DEFAULT_CHUNK_ROWS)
        hot = per_key.where(F.col("__kn") > HOT_KEY_ROWS).select(*keys).persist()
        stats = series_stats(_join_on(df, hot, keys, "left_semi", int(summ["nh"])), order_by)
        rows = int(summ["rows"])
        return SeriesPlan("hybrid", stats, chunk_rows or auto_chunk_rows(df.sparkSession, rows), hot, int(summ["nh"]))
    stats = series_stats(df, order_by)
    n = stats[2] if stats else 0
    if mode == "auto" and n <= SINGLE_MAX_ROWS:
        return SeriesPlan("plain", stats, chunk_rows or DEFAULT_CHUNK_ROWS)
    return SeriesPlan("chunked", stats, chunk_rows or auto_chunk_rows(df.sparkSession, n))


def _split(df: DataFrame, keys: list[str], plan: SeriesPlan) -> tuple[DataFrame, DataFrame, SeriesPlan]:
    normal = _join_on(df, plan.hot_keys, keys, "left_anti", plan.n_hot)
    hot = _join_on(df, plan.hot_keys, keys, "left_semi", plan.n_hot)
    return normal, hot, SeriesPlan("chunked", plan.stats, plan.chunk_rows, n_hot=plan.n_hot)


_TEXT_BYTES = 6  # bytes of a text in its numeric image, exact in a double


def _text_number(c: Column, skip: Column) -> Column:
    """A monotone number of a text's bytes after the first ``skip``, which the texts share."""
    part = F.hex(F.substring(c.cast("binary"), skip + 1, F.lit(_TEXT_BYTES)))
    return F.conv(F.rpad(part, 2 * _TEXT_BYTES, "0"), 16, 10).cast("double")


def _shared_bytes(a: Column, b: Column) -> Column:
    """Length of two texts' common beginning, in bytes."""
    x, y = a.cast("binary"), b.cast("binary")
    n = F.least(F.octet_length(x), F.octet_length(y))
    differ = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(x, i, F.lit(1)) != F.substring(y, i, F.lit(1)))
    first = F.array_position(F.when(n > 0, differ), True)
    return F.when(first > 0, (first - 1).cast("int")).otherwise(F.coalesce(n, F.lit(0)))


def _is_text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def _bucket_counts(bucketed: DataFrame, order_by: Sequence[str], part: list[str], target: int, texts: bool = False) -> DataFrame:
    """Rows per bucket and, for a bucket above four times its share, the order column that splits
    it: the first that varies inside it (``__c``), with its lowest value and the step per part.

    A column that varies only below double precision, or has no numeric image, splits nothing,
    and no later column may stand in for it: ``__c`` is null and the bucket stays whole.  With
    ``texts`` a text column's image is that of the bytes behind what all of a bucket's texts share;
    without, a text column counts as one without an image."""
    ok = [c for c in order_by if _bucketable(bucketed, c) or (texts and _is_text(bucketed, c))]
    named = list(order_by[:next((k for k, c in enumerate(order_by) if c not in ok), len(order_by))])
    aggs = [F.count(F.lit(1)).alias("__n")]
    for k, c in enumerate(named):
        t = F.col(c) if _is_text(bucketed, c) else _order_number(bucketed, c)
        aggs += [F.count(c).alias(f"__v{k}"), F.min(t).alias(f"__l{k}"), F.max(t).alias(f"__h{k}"),
                 F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(f"__e{k}")]
    out = bucketed.groupBy(*part).agg(*aggs)
    n = F.col("__n")
    split = F.lit(None)
    for k in reversed(range(len(named))):
        lo, hi, valid = F.col(f"__l{k}"), F.col(f"__h{k}"), F.col(f"__v{k}")
        skip = F.lit(0)
        if _is_text(bucketed, named[k]):
            skip = _shared_bytes(lo, hi)
            lo, hi = _text_number(lo, skip), _text_number(hi, skip)
        one_value = (valid == 0) | ((valid == n) & F.col(f"__e{k}"))
        pad = F.lit(1.0 if _is_text(bucketed, named[k]) or _is_integral(bucketed, named[k]) else 0.0)
        step = (hi - lo + pad) / F.ceil(n / F.lit(target))
        apart = (step > 0) & (F.floor((hi - lo) / step) > 0)
        usable = apart | ((valid < n) & (valid > 0))  # setting nulls apart is progress as well
        here = F.when(usable, F.struct(F.lit(k).alias("c"), lo.alias("lo"),
                                       F.when(step > 0, step).otherwise(1.0).alias("step"), skip.alias("skip")))
        split = F.when(one_value, split).otherwise(here)
    hot = F.when(n > 4 * target, split)
    if not named:
        hot = F.lit(None).cast("struct<c:int,lo:double,step:double,skip:int>")
    return out.select(*part, "__n", hot.alias("__split"))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _split_hot_buckets(bucketed: DataFrame, order_by: Sequence[str], keys: list[str],
                       target: int) -> tuple[DataFrame, DataFrame, int, list[str]]:
    """Split buckets that hold more than four times their share until none can be split.

    Every round appends one number to ``__sb``, an array that orders the parts of a bucket as
    ``order_by`` orders their rows.  A bucket is cut along the first order column that varies in
    it, so one instant among others is first cut free by time, then by its tie-breakers, text
    ones where no number is left to cut by.  A round costs one counting pass (over the hot rows
    alone for texts) and runs only while a hot bucket is left.  Returns the rows, the bucket
    counts, their number and the partitioning columns."""
    full = [*keys, "__bk", "__sb"]
    subbed = bucketed.withColumn("__sb", F.array().cast("array<bigint>"))
    counts = _bucket_counts(subbed, order_by, full, target).persist()  # rows / target rows
    part = [*keys, "__bk"]  # until the first split __sb is constant, so it partitions nothing
    while True:
        summ = counts.agg(F.count(F.lit(1)).alias("nb"), F.count("__split").alias("nh"),
                          F.count(F.when((F.col("__n") > 4 * target) & F.col("__split").isNull(), 1)).alias("stuck")).first()
        hot, n_hot = counts.where(F.col("__split").isNotNull()).select(*full, "__split"), summ["nh"]
        if not n_hot and summ["stuck"] and any(_is_text(bucketed, c) for c in order_by):
            stuck = counts.where(F.col("__n") > 4 * target).select(*full)
            rows = _join_on(subbed, stuck, full, "left_semi", int(summ["stuck"]))
            hot = (_bucket_counts(rows, order_by, full, target, texts=True)
                   .where(F.col("__split").isNotNull()).select(*full, "__split"))
            n_hot = 1
        if not n_hot:
            return subbed, counts.drop("__split"), int(summ["nb"]), part
        # written, so that a round adds a scan to the plan and not the rounds before it once more
        hot = _written(hot, "hot-buckets")
        n_hot = hot.count()
        if not n_hot:
            return subbed, counts.drop("__split"), int(summ["nb"]), part
        part = full
        marked = _join_on(subbed, hot, full, "left", int(n_hot))
        number = F.lit(None).cast("double")
        for k in reversed(range(len(order_by))):
            if _bucketable(bucketed, order_by[k]):
                number = F.when(F.col("__split.c") == k, _order_number(bucketed, order_by[k])).otherwise(number)
            elif _is_text(bucketed, order_by[k]):
                number = F.when(F.col("__split.c") == k, _text_number(F.col(order_by[k]), F.col("__split.skip"))).otherwise(number)
        step = F.floor((number - F.col("__split.lo")) / F.col("__split.step")).cast("long")
        # nulls sort first, so they come before part 0
        sub = F.when(F.col("__split").isNull(), F.lit(0)).otherwise(F.coalesce(step, F.lit(-1)))
        subbed = marked.withColumn("__sb", F.concat("__sb", F.array(sub.cast("long")))).drop("__split")
        counts.unpersist()
        counts = _written(_bucket_counts(subbed, order_by, full, target), "bucket-counts")


def row_index(df: DataFrame, order_by: Sequence[str], keys: Sequence[str] | None = None,
              idx_col: str = "row_idx", mode="auto", target_bucket_rows: int | None = None,
              stats=None, keep_buckets: bool = False) -> DataFrame:
    """Add a 0-based position in ``order_by`` order (per key).  ``order_by`` must be a total order.

    ``keep_buckets`` (chunked path) keeps ``__bk``/``__sb``: the output is partitioned by
    ``(keys, __bk, __sb)``, which later windows can reuse without another shuffle."""
    keys = _keys(keys)
    if isinstance(mode, SeriesPlan):
        plan = mode
    elif mode == "chunked" and stats is not None:
        plan = SeriesPlan("chunked", stats, target_bucket_rows or DEFAULT_CHUNK_ROWS)
    else:
        plan = plan_series(df, order_by, keys, mode, target_bucket_rows)
    if plan.mode == "plain":
        return df.withColumn(idx_col, (F.row_number().over(window_spec(order_by, keys)) - 1).cast("long"))
    if plan.mode == "hybrid":
        normal, hot, sub = _split(df, keys, plan)
        return row_index(normal, order_by, keys, idx_col, "plain").unionByName(
            row_index(hot, order_by, keys, idx_col, sub))
    if not plan.stats:
        # nothing to bucket by: no rows, or no order value at all
        out = row_index(df, order_by, keys, idx_col, "plain")
        if not keep_buckets:
            return out
        part = [*keys, "__bk", "__sb"]
        out = out.withColumns({"__bk": F.lit(0).cast("long"), "__sb": F.array().cast("array<bigint>"),
                               "__off": F.lit(0).cast("long")})
        sizes = out.groupBy(*part, "__off").agg(F.count(F.lit(1)).alias("__n"))
        out = _join_on(out, sizes.drop("__off"), part, "inner")
        return (out, sizes, 1, out.drop(idx_col, "__off", "__n"), part) if keep_buckets == "offsets" else out.drop("__off", "__n")
    target = plan.chunk_rows
    t = _order_number(df, order_by[0])
    integral = _is_integral(df, order_by[0])
    pad = 1.0 if integral else 0.0
    min_w = 1.0 if integral else 1e-300
    if keys:
        # per-series bucket width, so many short series do not each span many buckets
        kst = df.groupBy(*keys).agg(F.min(t).alias("__klo"), F.max(t).alias("__khi"),
                                    F.count(F.lit(1)).alias("__kn"))
        based = _join_on(df, kst, keys, "inner", plan.n_hot or None)  # one row per hot key
        width = F.greatest(F.lit(min_w), (F.col("__khi") - F.col("__klo") + pad) * target / F.col("__kn"))
        bucketed = based.withColumn("__bk", F.floor((t - F.col("__klo")) / width).cast("long")) \
            .drop("__klo", "__khi", "__kn")
    else:
        lo, hi, n = plan.stats
        span = hi - lo + pad
        width = max(min_w, span * target / n) if span > 0 else 1.0
        bucketed = df.withColumn("__bk", F.floor((t - F.lit(lo)) / F.lit(width)).cast("long"))
    subbed, counts, n_side, part = _split_hot_buckets(bucketed, order_by, keys, target)
    wb = window_spec(["__bk", "__sb"], keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "__bk", "__sb", "__n",
                            F.coalesce(F.sum("__n").over(wb), F.lit(0)).alias("__off"))
    joined = _join_on(subbed, offsets, keys + ["__bk", "__sb"], "inner", n_side)
    inner = window_spec(order_by, part)
    out = joined.withColumn(idx_col, F.col("__off") + F.row_number().over(inner) - 1)
    if keep_buckets == "offsets":
        return out, offsets.persist(), n_side, subbed, part
    out = out.drop("__off", "__n")
    return out if keep_buckets else out.drop("__bk", "__sb")


def ordered_columns(df: DataFrame, order_by: Sequence[str], keys: Sequence[str] | None,
                    build: Builder, back: int, fwd: int, mode="auto",
                    chunk_rows: int | None = None) -> DataFrame:
    """Add window columns whose frames reach at most ``back`` rows behind and ``fwd`` ahead.

    ``build(w)`` returns ``{name: expression}`` written against an ordered window
    ``w``; frames are declared with ``w.rowsBetween``.  All expressions share one
    window operator (one sort).
    """
    keys = _keys(keys)
    plan = plan_series(df, order_by, keys, mode, chunk_rows)
    if plan.mode == "plain":
        return df.withColumns(build(window_spec(order_by, keys)))
    if plan.mode == "hybrid":
        normal, hot, sub = _split(df, keys, plan)
        return ordered_columns(normal, order_by, keys, build, back, fwd, "plain").unionByName(
            ordered_columns(hot, order_by, keys, build, back, fwd, sub))
    if not plan.stats:
        return df.withColumns(build(window_spec(order_by, keys)))
    return _bounded_by_bucket(df, order_by, keys, build, back, fwd, plan)


def _bounded_by_bucket(df: DataFrame, order_by, keys: list[str], build: Builder, back: int, fwd: int,
                       plan: SeriesPlan) -> DataFrame:
    """Bounded frames on the numbering's own buckets.

    The rows are shuffled once, by ``(keys, bucket)`` for the numbering.  The ``back``
    rows before and ``fwd`` rows after every bucket are found as a per-bucket top-k of
    the bucketed input (Spark limits each group before the exchange, so this moves at
    most ``k`` rows per bucket and task), placed by their global positions, and sent to
    the bucket(s) they border -- several when buckets are small.  That small exchange is
    hash-partitioned like the numbering, so the union keeps the partitioning and the
    feature window runs without another shuffle.
    """
    idx, offsets, n_side, subbed, part = row_index(df, order_by, keys, "__ri", plan, keep_buckets="offsets")
    full = [*keys, "__bk", "__sb"]
    wo = window_spec(["__off"], keys)
    tgt = F.struct(F.col("__bk").alias("bk"), F.col("__sb").alias("sb"), F.col("__off").alias("off"),
                   (F.col("__off") + F.col("__n")).alias("end"))
    g = F.col("__ri")
    halos = []
    for k, desc in ((back, True), (fwd, False)):
        if k <= 0:
            continue
        rk = F.row_number().over(window_spec(order_by, part, descending=desc))
        edge = subbed.withColumn("__rk", rk).where(F.col("__rk") <= k)
        edge = _join_on(edge, offsets, full, "inner", n_side)
        pos = (F.col("__off") + F.col("__n") - F.col("__rk")) if desc else (F.col("__off") + F.col("__rk") - 1)
        edge = edge.withColumn("__ri", pos).drop("__rk")
        frame = wo.rowsBetween(1, k) if desc else wo.rowsBetween(-k, -1)
        # only targets within k rows of this bucket are kept
        end = F.col("__off") + F.col("__n")
        reach = (lambda x: x["off"] < end + k) if desc else (lambda x: x["end"] + k > F.col("__off"))  # noqa: B023
        near = offsets.select(*full, F.filter(F.collect_list(tgt).over(frame), reach).alias("__t"))
        # each bucket's list holds up to k neighbours, so k counts in the size of this side
        cand = _join_on(edge, near.where(F.size("__t") > 0), full, "inner", n_side * (k + 1))
        cand = cand.withColumn("__t", F.explode("__t"))
        cand = cand.where(g >= F.col("__t.off") - k) if desc else cand.where(g < F.col("__t.end") + k)
        halos.append(cand)
    main = idx.withColumn("__halo", F.lit(False))
    if halos:
        halo = halos[0] if len(halos) == 1 else halos[0].unionByName(halos[1])
        halo = (halo.withColumn("__bk", F.col("__t.bk")).withColumn("__sb", F.col("__t.sb"))
                .drop("__t").withColumn("__halo", F.lit(True)))
        n_part = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        halo = halo.repartition(n_part, *[F.col(c) for c in part]).select(*main.columns)
        main = main.unionByName(halo)
    w = window_spec(["__ri"], part)
    out = main.withColumns(build(w)).where(~F.col("__halo"))
    return out.drop("__ri", "__bk", "__sb", "__off", "__n", "__halo")


def known_neighbours(df: DataFrame, order_by: Sequence[str], keys: Sequence[str] | None,
                     cols: Sequence[str], mode="auto", chunk_rows: int | None = None,
                     pos_col: str = "__pos") -> DataFrame:
    """For each ``c`` add ``__prev_c`` / ``__next_c`` = nearest non-null ``struct(pos, val)``
    at or before / at or after the row, plus the row position ``pos_col``."""
    keys = _keys(keys)

    def kstruct(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col(pos_col).alias("pos"), F.col(c).alias("val")))

    plan = plan_series(df, order_by, keys, mode, chunk_rows)
    if plan.mode == "plain":
        w = window_spec(order_by, keys)
        df = df.withColumn(pos_col, F.row_number().over(w) - 1)
        before, after = _upto_here([pos_col], keys), _upto_here([pos_col], keys, descending=True)
        df = df.withColumns({f"__prev_{c}": F.last(kstruct(c), True).over(before) for c in cols})
        return df.withColumns({f"__next_{c}": F.last(kstruct(c), True).over(after) for c in cols})
    if plan.mode == "hybrid":
        normal, hot, sub = _split(df, keys, plan)
        return known_neighbours(normal, order_by, keys, cols, "plain", pos_col=pos_col).unionByName(
            known_neighbours(hot, order_by, keys, cols, sub, pos_col=pos_col))
    # the numbering buckets serve as carry chunks: the local windows reuse the numbering's
    # partitioning (no second shuffle of the rows)
    idx, _, n_buckets, _, _ = row_index(df, order_by, keys, idx_col=pos_col, mode=plan, keep_buckets="offsets")
    idx = idx.drop("__off", "__n")
    part = keys + ["__bk", "__sb"]
    idx = idx.withColumns({f"__lp_{c}": F.last(kstruct(c), True).over(_upto_here([pos_col], part))
                           for c in cols})
    idx = idx.withColumns({f"__ln_{c}": F.last(kstruct(c), True).over(_upto_here([pos_col], part, True))
                           for c in cols})
    idx = idx.withColumn("__ck", F.struct("__bk", "__sb")).drop("__bk", "__sb")
    # per-chunk summary -> carries from earlier / later chunks (a table of rows / chunk_rows)
    summ = idx.groupBy(*keys, "__ck").agg(
        *[F.max(kstruct(c)).alias(f"__cl_{c}") for c in cols],
        *[F.min(kstruct(c)).alias(f"__cf_{c}") for c in cols])
    earlier = window_spec(["__ck"], keys).rowsBetween(Window.unboundedPreceding, -1)
    later = window_spec(["__ck"], keys, descending=True).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*keys, "__ck",
                        *[F.last(f"__cl_{c}", True).over(earlier).alias(f"__ci_{c}") for c in cols],
                        *[F.col(f"__cf_{c}") for c in cols])
    carry = carry.select(*keys, "__ck", *[f"__ci_{c}" for c in cols],
                         *[F.last(f"__cf_{c}", True).over(later).alias(f"__co_{c}") for c in cols])
    # one carry row per bucket; the bucket count is known from the numbering
    joined = _join_on(idx, carry, keys + ["__ck"], "left", n_buckets)
    out = {}
    for c in cols:
        out[f"__prev_{c}"] = F.coalesce(F.col(f"__lp_{c}"), F.col(f"__ci_{c}"))
        out[f"__next_{c}"] = F.coalesce(F.col(f"__ln_{c}"), F.col(f"__co_{c}"))
    dropped = [f"__{p}_{c}" for c in cols for p in ("lp", "ln", "ci", "co")] + ["__ck"]
    return joined.withColumns(out).drop(*dropped)
