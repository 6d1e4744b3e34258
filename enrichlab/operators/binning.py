"""Binning and ordered scans.

``global_prefix``: prefix sums / minima in a *global* order without a single-task window.
  1. boundaries: a bounded Bernoulli sample of the order key (about 2 * ``buckets *
     oversample`` rows reach the driver) -> ``buckets - 1`` literal struct boundaries;
  2. ``bucket`` = number of boundaries below the row's key: a deterministic expression of
     literals, so a recomputed task (lost executor) gets the same bucket;
  3. per-bucket totals -> at most ``buckets`` rows -> exclusive prefix on the driver
     (bounded by ``buckets``, not by data) -> broadcast back as a literal map;
  4. ``Window.partitionBy(bucket).orderBy(key)`` running value + bucket offset.
  Keys must be total (end the order with a unique row key) so no bucket holds a hot tie.

``exact_quantiles``: exact linear-interpolated quantiles (pandas / ``quantile_cont``):
  ``groupBy(value).count()`` (map-side combined, so a hot value is one row) -> global
  prefix of counts -> pick the values holding ranks floor(h), ceil(h) -> interpolate.
  Distributed; no value->count map of the whole column in one task.

``bin_quantile``: pandas ``qcut(q, duplicates='drop')``: deduped edges, bin = #(edges < x),
lowest edge inclusive -> ``max(1, #(edges < x)) - 1``; null -> null; a single distinct edge
gives no bin.  Not ``ntile`` (splits ties) nor ``QuantileDiscretizer`` (approximate).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrichlab.functions import scalars as S

# ---------------------------------------------------------------- range buckets


#: Rows that one range bucket is meant to hold.
ROWS_PER_BUCKET = 2_000_000


#: Boundaries up to which the bucket is one generated bisection.
TREE_BOUNDS = 128


def _lit_like(v, dt: T.DataType) -> Column:
    return F.lit(v).cast(dt) if v is not None else F.lit(None).cast(dt)


def bucket_count(df: DataFrame, rows: int) -> int:
    """Range buckets for ``rows`` rows: one per ``ROWS_PER_BUCKET``, and no fewer than the session's
    shuffle partitions, so that the work of a bucket stays the same as the data grow."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_BUCKET))


def _range_bounds(df: DataFrame, order: Sequence[str], buckets: int | None, oversample: int, seed: int) -> list[Column]:
    """Ascending boundaries of range buckets as literal structs: one fewer than buckets, or none."""
    key = F.struct(*[F.col(c) for c in order])
    # Bernoulli sample sized for ~2 * target rows in total, so the driver receives a bounded
    # sample however many partitions the input has (a top-k per partition would ship
    # partitions x k rows to the driver).  The boundaries become literals, so recomputed tasks
    # bucket rows identically.
    n = df.count()
    buckets = buckets or bucket_count(df, n)
    if n == 0 or buckets <= 1:
        return []
    target = buckets * oversample
    frac = min(1.0, 2.0 * target / n)
    sample = df.select(key.alias("k")).sample(False, frac, seed).collect()
    vals = sorted((tuple(r["k"]) for r in sample), key=_sort_key)
    if not vals:
        return []
    step = len(vals) / buckets
    bounds = []
    for i in range(1, buckets):
        b = vals[min(len(vals) - 1, int(i * step))]
        if not bounds or b != bounds[-1]:
            bounds.append(b)
    types = [df.schema[c].dataType for c in order]
    return [F.struct(*[_lit_like(v, t).alias(c) for v, t, c in zip(b, types, order)]) for b in bounds]


def range_bucket_expr(df: DataFrame, order: Sequence[str], buckets: int | None = None, oversample: int = 20,
                      seed: int = 17) -> Column:
    """A deterministic ``bucket`` column ordering rows by the struct ``order`` (ascending,
    nulls first and NaN last as Spark's struct order).  Boundaries come from a sample of about
    ``2 * oversample`` keys per bucket; the number of buckets follows the rows (``bucket_count``)
    unless given.  Beyond ``TREE_BOUNDS`` boundaries a row is compared with about twice their square root;
    ``with_range_bucket`` adds the same bucket to a frame for the logarithm."""
    key = F.struct(*[F.col(c) for c in order])
    lits = _range_bounds(df, order, buckets, oversample, seed)
    if not lits:
        return F.lit(0)

    def tree(lo: int, hi: int) -> Column:
        # bucket = number of boundaries strictly below the key, found by bisection
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key > lits[mid], tree(mid + 1, hi)).otherwise(tree(lo, mid))

    if len(lits) <= TREE_BOUNDS:
        return tree(0, len(lits))
    # many boundaries: blocks of about their square root, first the number of whole blocks below the key
    m = math.isqrt(len(lits))
    blocks = F.array(*lits[m - 1 :: m])
    whole = F.size(F.filter(blocks, lambda b: b < key))
    return whole * m + F.size(F.filter(F.slice(F.array(*lits), whole * m + 1, F.lit(m)), lambda b: b < key))


def with_range_bucket(df: DataFrame, order: Sequence[str], out: str, buckets: int | None = None, oversample: int = 20,
                      seed: int = 17) -> DataFrame:
    """``df`` with the bucket of ``range_bucket_expr`` as the column ``out``: one generated comparison per halving of the
    boundaries, each a column of the step before it.  Store the frame before filtering by ``out``: a filter would move below
    the steps and repeat them."""
    lits = _range_bounds(df, order, buckets, oversample, seed)
    # one type for both sides, nullable throughout: else every comparison casts its boundary
    kind = T.StructType([T.StructField(c, df.schema[c].dataType) for c in order])
    bounds, key = F.array(*lits).cast(T.ArrayType(kind)), "__range_key"
    x = df.withColumns({key: F.struct(*[F.col(c) for c in order]).cast(kind), out: F.lit(0)})
    for k in reversed(range(len(lits).bit_length())):
        # boundaries beyond the last are null, and nothing is above them
        above = F.col(key) > F.get(bounds, F.col(out) + F.lit((1 << k) - 1))
        x = x.withColumn(out, F.col(out) + F.when(above, 1 << k).otherwise(0))
    return x.drop(key)


def _sort_key(t):
    # Spark struct order: ascending, nulls first, NaN above every number
    return tuple((0, 0) if v is None else (2, 0) if v != v else (1, v) for v in t)


def global_prefix(
    df: DataFrame,
    order: Sequence[str],
    values: Mapping[str, Column],
    inclusive: bool = False,
    buckets: int | None = None,
    op: str = "sum",
    bucket_col: str | None = None,
) -> DataFrame:
    """Adds one column per ``values`` entry: the running ``op`` ('sum' or 'min') of that
    value over all rows before (``inclusive=False``) or up to the row in the global order."""
    b = bucket_col or "__bucket"
    src = df if bucket_col else with_range_bucket(df, order, b, buckets)
    agg = F.sum if op == "sum" else F.min
    tot = src.groupBy(b).agg(*[agg(v).alias(k) for k, v in values.items()]).collect()  # <= buckets rows
    tot = sorted(tot, key=lambda r: r[b])
    offsets: dict[str, dict[int, object]] = {k: {} for k in values}
    for k in values:
        run = None
        for r in tot:
            offsets[k][r[b]] = run
            x = r[k]
            if x is not None:
                run = x if run is None else (run + x if op == "sum" else min(run, x))
    w = Window.partitionBy(b).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    w = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    cols = {}
    for k, v in values.items():
        m = offsets[k]
        nb = max(m) + 1 if m else 1
        arr = F.array(*[F.lit(m.get(i)) for i in range(nb)])
        off = F.element_at(arr, F.col(b) + 1)
        inner = agg(v).over(w)
        if op == "sum":
            cols[k] = F.coalesce(inner, F.lit(0)) + F.coalesce(off, F.lit(0))
        else:
            cols[k] = F.least(inner, off)  # least skips nulls
    out = src.withColumns(cols)
    return out if bucket_col else out.drop(b)


def segmented_prefix(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column],
                     buckets: int | None = None) -> DataFrame:
    """Adds one column per ``values`` entry: its sum over the earlier rows of the same key in the order ``order``
    (ascending, exclusive; the order must be total within a key).  Rows are range-bucketed on (keys, order), so
    a hot key is cut over many buckets and many keys share one; a key that goes on from earlier buckets adds
    their totals, from a table of one row per (bucket, key) it touches.  Keys may be null."""
    from enrichlab.session import materialize

    x = materialize(df.withColumns({f"__v{i}": v for i, v in enumerate(values.values())}))  # read by the sample, the totals and the scan
    x = with_range_bucket(x, [*keys, *order], "__b", buckets)
    names = [f"__v{i}" for i in range(len(values))]
    totals = x.groupBy("__b", *keys).agg(*[F.sum(v).alias(f"{v}_t") for v in names])
    earlier = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(F.col("__b").alias("__cb"), *[F.col(k).alias(f"__ck{i}") for i, k in enumerate(keys)],
                            *[F.sum(f"{v}_t").over(earlier).alias(f"{v}_c") for v in names])
    same = x["__b"] == carries["__cb"]
    for i, k in enumerate(keys):
        same = same & x[k].eqNullSafe(carries[f"__ck{i}"])
    w = Window.partitionBy("__b", *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    j = x.join(carries, same, "left")
    out = {n: F.coalesce(F.sum(v).over(w), F.lit(0)) + F.coalesce(F.col(f"{v}_c"), F.lit(0)) for n, v in zip(values, names)}
    return j.withColumns(out).select(*df.columns, *out)


# ---------------------------------------------------------------- exact quantiles


def exact_quantiles(df: DataFrame, c: str, probs: Sequence[float], buckets: int | None = None) -> list[float | None]:
    """Exact linear-interpolated quantiles of non-null ``c`` (distributed ranks)."""
    return exact_quantiles_multi(df, [c], probs, buckets)[c]


def exact_quantiles_multi(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                          buckets: int | None = None) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns in ONE pass: unpivot to (column, value), count per
    distinct pair (map-side combined: a hot value is one row), one global prefix over
    (column, value), per-column offsets from the per-column totals (one row per column), then
    fetch only the rows that bracket the wanted ranks (<= 2 per column and probability)."""
    cols = list(cols)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), S.nan_to_null(F.col(c).cast("double")).alias("v"))
                                for i, c in enumerate(cols)]))
    long = df.select(pairs.alias("kv")).select("kv.k", "kv.v").filter(F.col("v").isNotNull())
    # distinct (column, value) with counts: reused by the small jobs below, so kept in memory
    counts = long.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).persist()
    try:
        totals = {r["k"]: r["t"] for r in counts.groupBy("k").agg(F.sum("n").alias("t")).collect()}  # <= len(cols) rows
        offsets, run = {}, 0
        for i in range(len(cols)):
            offsets[i] = run
            run += totals.get(i, 0)
        wanted: dict[int, list[tuple[float, int, int]]] = {}
        cond = None
        for i in range(len(cols)):
            t = totals.get(i, 0)
            if not t:
                continue
            wanted[i] = []
            for p in probs:
                h = (t - 1) * float(p)
                lo, hi = math.floor(h), math.ceil(h)
                wanted[i].append((h, lo, hi))
                for r in {lo, hi}:
                    g = offsets[i] + r
                    cnd = (F.col("k") == i) & (F.col("before") <= g) & (F.col("before") + F.col("n") > g)
                    cond = cnd if cond is None else cond | cnd
        out = {c: [None for _ in probs] for c in cols}
        if cond is None:
            return out
        pref = global_prefix(counts, ["k", "v"], {"before": F.col("n")}, inclusive=False, buckets=buckets)
        rows = pref.filter(cond).select("k", "v", "before", "n").collect()  # <= 2 * len(probs) * len(cols) rows

        def at(i, r):
            g = offsets[i] + r
            for row in rows:
                if row["k"] == i and row["before"] <= g < row["before"] + row["n"]:
                    return row["v"]
            raise AssertionError((i, r))

        for i, lst in wanted.items():
            vals = []
            for h, lo, hi in lst:
                a, b = at(i, lo), at(i, hi)
                vals.append(a if lo == hi or a == b else a + (b - a) * (h - lo))
            out[cols[i]] = vals
        return out
    finally:
        counts.unpersist()


def quantile_edges(df: DataFrame, c: str, q: int, method: str = "ranks") -> list[float]:
    """qcut edges: quantiles at 0, 1/q, ..., 1, deduplicated (``duplicates='drop'``)."""
    probs = [i / q for i in range(q + 1)]
    if method == "percentile":
        row = df.agg(F.percentile(S.nan_to_null(F.col(c).cast("double")), probs).alias("e")).first()
        edges = row["e"]
    else:
        edges = exact_quantiles(df, c, probs)
    if edges is None or any(e is None for e in edges):
        return []
    out = []
    for e in edges:
        if not out or e != out[-1]:
            out.append(float(e))
    return out


def bin_index_from_edges(c: Column | str, edges: Sequence[float]) -> Column:
    """``max(1, #(edges < x)) - 1`` for x within the edges; null otherwise / no bins."""
    c = S.col(c)
    if len(edges) < 2:
        return F.lit(None).cast("int")
    cnt = F.lit(0)
    for e in edges:
        cnt = cnt + (c > F.lit(e)).cast("int")
    inside = (c >= F.lit(edges[0])) & (c <= F.lit(edges[-1]))
    return F.when(c.isNotNull() & inside, F.greatest(cnt, F.lit(1)) - 1).cast("int")


def bin_quantile(df: DataFrame, c: str, q: int, out: str, method: str = "ranks") -> tuple[DataFrame, list[float]]:
    """pandas ``qcut(c, q, duplicates='drop')`` as a bin index column; returns the edges too."""
    edges = quantile_edges(df, c, q, method)
    return df.withColumn(out, bin_index_from_edges(S.nan_to_null(F.col(c).cast("double")), edges)), edges


def interval_label(edges: Sequence[float], idx: Column, decimals: int = 3) -> Column:
    """pandas-like ``(a, b]`` label for a bin index (first bin closed on the left)."""
    labels = []
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        labels.append(f"{'[' if i == 0 else '('}{lo:.{decimals}f}, {hi:.{decimals}f}]")
    expr = F.lit(None).cast("string")
    for i, lab in enumerate(labels):
        expr = F.when(idx == i, F.lit(lab)).otherwise(expr)
    return expr


def bin_equal_width(df: DataFrame, c: str, n: int, out: str) -> DataFrame:
    """pandas ``cut(bins=n)``: n equal-width right-closed bins over [min, max], first bin
    includes the minimum.  min / max are scalar subqueries (no driver round trip)."""
    mm = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
    lo = mm.select("lo").scalar()
    hi = mm.select("hi").scalar()
    x = F.col(c)
    width = (hi - lo) / F.lit(float(n))
    idx = F.when(x.isNull(), None).when(hi == lo, 0).otherwise(
        F.least(F.greatest(F.ceil((x - lo) / width) - 1, F.lit(0)), F.lit(n - 1))
    )
    return df.withColumn(out, idx.cast("int"))


def histogram_equal_width(df: DataFrame, c: str, n: int) -> DataFrame:
    """Counts in n equal-width bins over [min, max], last bin closed (``numpy.histogram``)."""
    mm = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
    lo = mm.select("lo").scalar()
    hi = mm.select("hi").scalar()
    x = F.col(c)
    width = (hi - lo) / F.lit(float(n))
    idx = F.when(hi == lo, 0).otherwise(F.least(F.floor((x - lo) / width), F.lit(n - 1))).cast("int")
    return (
        df.filter(x.isNotNull())
        .groupBy(idx.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"), F.min(c).alias("min_value"), F.max(c).alias("max_value"))
        .withColumn("left_edge", lo + F.col("bin") * width)
        .orderBy("bin")
    )


def bin_fixed_edges(df: DataFrame, c: str, edges: Sequence[float], labels: Sequence[str], out: str,
                    include_lowest: bool = False) -> DataFrame:
    return df.withColumn(out, S.bin_fixed_edges_expr(c, edges, labels, include_lowest))


# ---------------------------------------------------------------- binned reports


def quantile_bins_with_null_bin(
    df: DataFrame, c: str, q: int = 6, leads: str = "leads", qls: str = "qls", sales: str = "sales",
    method: str = "ranks",
) -> DataFrame:
    """Up to ``q`` equal-count bins (fewer when fewer distinct values) plus a ``NULL`` bin;
    per bin the field-value statistics; NULL first, then by left edge."""
    nd = df.agg(F.countDistinct(c)).first()[0]
    q_eff = min(q, nd)
    if q_eff > 1:
        binned, edges = bin_quantile(df, c, q_eff, "__bin", method)
        left = F.lit(None).cast("double")
        for i, e in enumerate(edges[:-1]):
            left = F.when(F.col("__bin") == i, F.lit(e)).otherwise(left)
        label = interval_label(edges, F.col("__bin"))
    else:
        binned = df.withColumn("__bin", F.lit(0))
        left = F.col(c).cast("double")
        label = F.col(c).cast("string")
    binned = binned.withColumns({
        "bin": F.when(F.col(c).isNull(), F.lit("NULL")).otherwise(label),
        "bin_index": F.when(F.col(c).isNotNull(), F.col("__bin")),
        "left_edge": F.when(F.col(c).isNotNull(), left),
    })
    l2s = F.try_divide(F.col(sales).cast("double"), F.col(leads))
    out = binned.groupBy("bin", "bin_index", "left_edge").agg(
        F.count(leads).alias("leads_count"),
        F.sum(leads).cast("bigint").alias("total_leads"),
        F.sum(qls).cast("bigint").alias("total_qls"),
        F.avg(qls).alias("avg_qls_per_record"),
        F.sum(sales).cast("bigint").alias("total_sales"),
        F.avg(sales).alias("avg_sales_per_record"),
        F.avg(l2s).alias("avg_l2s_rate"),
    )
    from enrichlab.operators.windows import sort_bins_by_left_edge

    return sort_bins_by_left_edge(out, "left_edge")


def log_revenue_bins_with_null(
    df: DataFrame, c: str, q: int = 5, leads: str = "leads_count", sales: str = "sales_count", method: str = "ranks"
) -> DataFrame:
    """ln(revenue); non-finite -> 'Null' bin; ``q`` quantile bins; leads / sales / L2S per bin."""
    lc = "__log_rev"
    x = df.withColumn(lc, S.non_finite_to_null(S.ln(F.col(c))))
    binned, edges = bin_quantile(x, lc, q, "__bin", method)
    binned = binned.withColumns({
        "revenue_bin": F.when(F.col("__bin").isNull(), F.lit("Null")).otherwise(interval_label(edges, F.col("__bin"))),
        "bin_index": F.col("__bin"),
    })
    return binned.groupBy("revenue_bin", "bin_index").agg(
        F.sum(leads).cast("bigint").alias("leads"),
        F.sum(sales).cast("bigint").alias("sales"),
        F.try_divide(F.sum(sales).cast("double"), F.sum(leads)).alias("l2s"),
    ).orderBy(F.col("bin_index").asc_nulls_first())


def grouped_exact_quantiles(df: DataFrame, group_cols: Sequence[str], value: str, probs: Sequence[float],
                            names: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per group, as a DataFrame
    (group_cols..., names...), computed without any group's values in one task:
    distinct (group, value) counts -> global prefix over (group, value) -> per-group start and
    total (an aggregate, joined back null-safely) -> each row knows the ranks it covers ->
    the two values bracketing each wanted rank are picked by conditional aggregates per group."""
    from enrichlab.session import materialize

    gc = list(group_cols)
    x = df.select(*gc, S.nan_to_null(F.col(value).cast("double")).alias("__v")).filter(F.col("__v").isNotNull())
    counts = materialize(x.groupBy(*gc, "__v").agg(F.count(F.lit(1)).alias("__n")))
    pre = global_prefix(counts, [*gc, "__v"], {"__before": F.col("__n")}, inclusive=False, buckets=buckets)
    g = pre.groupBy(*[F.col(c).alias(f"__g_{c}") for c in gc]).agg(
        F.min("__before").alias("__start"), F.sum("__n").alias("__total"))
    cond = None
    for c in gc:
        e = pre[c].eqNullSafe(g[f"__g_{c}"])
        cond = e if cond is None else cond & e
    j = pre.join(g, cond, "inner") if gc else pre.crossJoin(g)  # g: one row per group
    b = F.col("__before") - F.col("__start")
    aggs = []
    for i, p in enumerate(probs):
        h = (F.col("__total") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        aggs.append(F.max(F.when((b <= lo) & (lo < b + F.col("__n")), F.col("__v"))).alias(f"__lo{i}"))
        aggs.append(F.max(F.when((b <= hi) & (hi < b + F.col("__n")), F.col("__v"))).alias(f"__hi{i}"))
        aggs.append(F.first(h - lo).alias(f"__d{i}"))
    r = j.groupBy(*gc).agg(*aggs)
    outs = []
    for i, nm in enumerate(names):
        lo_v, hi_v, d = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__d{i}")
        outs.append(F.when(lo_v == hi_v, lo_v).otherwise(lo_v + (hi_v - lo_v) * d).alias(nm))
    return r.select(*gc, *outs)
