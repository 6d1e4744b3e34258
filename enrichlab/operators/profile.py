"""Profiling and statistics.

The reference makes one pass per column; here each report is ONE aggregate over all the
columns it needs (a single scan, partial aggregation per task), then reshaped from one wide
row to a long table with ``explode(array(struct ...))`` on that single row.
Correlations are guarded (ANSI ``corr`` raises on a constant column): covariance over the
complete rows divided with ``try_divide`` -> null for < 2 rows or zero variance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from enrichlab.functions import scalars as S
from enrichlab.operators.filters import numeric_columns


def _missing(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType.typeName()
    return (F.col(c).isNull() | F.isnan(F.col(c))) if t in ("double", "float") else F.col(c).isNull()


def _long(wide: DataFrame, names: Sequence[str], fields: Sequence[str], name_col: str = "column") -> DataFrame:
    """One wide row with columns ``{name}__{field}`` -> one row per name."""
    rows = [
        F.struct(F.lit(n).alias(name_col), *[F.col(f"{n}__{f}").alias(f) for f in fields]) for n in names
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def profile_nulls(df: DataFrame, cols: Sequence[str] | None = None, only_positive: bool = False) -> DataFrame:
    """Per column: null count and null %, most-null first."""
    cols = list(cols) if cols is not None else df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(_missing(df, c)).alias(f"{c}__null_count") for c in cols])
    wide = wide.select("*", *[(F.col(f"{c}__null_count") * 100.0 / F.col("__n")).alias(f"{c}__null_pct") for c in cols])
    out = _long(wide, cols, ["null_count", "null_pct"])
    if only_positive:
        out = out.filter(F.col("null_count") > 0)
    return out.orderBy(F.col("null_count").desc(), F.col("column"))


def null_rates_fields(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """field, total rows, null rows, null %, filled rows for every non-excluded field."""
    fields = [c for c in df.columns if c not in set(exclude)]
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(_missing(df, c)).alias(f"{c}__null_rows") for c in fields])
    wide = wide.select(
        "*",
        *[F.col("__n").alias(f"{c}__total_rows") for c in fields],
        *[(F.col(f"{c}__null_rows") * 100.0 / F.col("__n")).alias(f"{c}__null_rate_pct") for c in fields],
        *[(F.col("__n") - F.col(f"{c}__null_rows")).alias(f"{c}__filled_rows") for c in fields],
    )
    return _long(wide, fields, ["total_rows", "null_rows", "null_rate_pct", "filled_rows"], "field")


def null_rates_by_month(df: DataFrame, ts: str, cols: Sequence[str], month_alias: str = "enrich_month") -> DataFrame:
    """Per month of ``ts``: total rows and per column non-null / null counts and null rate.
    (The reference outer-joins one frame per column; this is a single ``groupBy``.)"""
    aggs = [F.count(F.lit(1)).alias("total_records")]
    for c in cols:
        aggs += [F.count_if(~_missing(df, c)).alias(f"{c}_non_null_count"), F.count_if(_missing(df, c)).alias(f"{c}_null_count")]
    g = df.groupBy(S.month_of(ts).alias(month_alias)).agg(*aggs)
    return g.withColumns({f"{c}_null_rate": F.col(f"{c}_null_count") / F.col("total_records") for c in cols}).orderBy(month_alias)


def co_null_check(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows with ``a`` null but ``b`` present, and the reverse (plus the null count of ``a``)."""
    return df.agg(
        F.count_if(F.col(a).isNull()).alias(f"{a}_null"),
        F.count_if(F.col(a).isNull() & F.col(b).isNotNull()).alias(f"{a}_null_{b}_not_null"),
        F.count_if(F.col(b).isNull() & F.col(a).isNotNull()).alias(f"{b}_null_{a}_not_null"),
    )


def null_to_nonnull_ratio(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """nulls / non-nulls per column (a ratio of counts, not a share)."""
    cols = list(cols) if cols is not None else df.columns
    wide = df.agg(*[F.try_divide(F.count_if(_missing(df, c)).cast("double"), F.count_if(~_missing(df, c))).alias(f"{c}__ratio") for c in cols])
    return _long(wide, cols, ["ratio"])


def feature_availability(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-null count and % per present feature (missing features reported with null)."""
    present = [c for c in cols if c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(~_missing(df, c)).alias(f"{c}__non_null") for c in present])
    wide = wide.select("*", *[(F.col(f"{c}__non_null") * 100.0 / F.col("__n")).alias(f"{c}__pct") for c in present])
    return _long(wide, present, ["non_null", "pct"], "feature")


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """count, mean, std, min, 25 %, 50 %, 75 %, max per numeric column.  Moments come from one
    aggregate; the quartiles are exact and distributed (``exact_quantiles``: ranks over
    distinct values, no whole-column value map in one task) - or ``percentile_approx`` with
    ``accuracy``."""
    from enrichlab.operators.binning import exact_quantiles_multi

    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = []
    for c in cols:
        x = S.nan_to_null(F.col(c).cast("double"))
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        if accuracy is not None:
            aggs.append(F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"{c}__q"))
    wide = df.agg(*aggs)
    if accuracy is not None:
        wide = wide.select("*", *[F.col(f"{c}__q")[i].alias(f"{c}__{n}") for c in cols
                                  for i, n in enumerate(("p25", "p50", "p75"))])
    else:
        qs = exact_quantiles_multi(df, cols, [0.25, 0.5, 0.75])  # 3 values per column, one pass
        wide = wide.select("*", *[F.lit(qs[c][i]).cast("double").alias(f"{c}__{n}") for c in cols
                                  for i, n in enumerate(("p25", "p50", "p75"))])
    return _long(wide, cols, ["count", "mean", "std", "min", "p25", "p50", "p75", "max"])


def distinct_count(c: str, rsd: float | None = None) -> Column:
    """Distinct non-null values; with ``rsd`` an estimate of that relative error, whose sketch is combined
    in each task.  For exact counts of many columns at once see ``column_facts``."""
    return F.countDistinct(c) if rsd is None else F.approx_count_distinct(c, rsd)


#: Distinct values that a task keeps before it hands them on, and characters beyond which a value is kept as its digest.
TASK_VALUES, WIDE_VALUE = 200_000, 32


def _value_keys(values: pa.Array) -> list[str]:
    """Distinct non-null values as short texts, equal values equal: -0.0 is 0.0, wide strings are 128-bit digests."""
    if pa.types.is_floating(values.type):
        values = pc.add(values, pa.scalar(0.0, values.type))
    out = pc.cast(values, pa.string()).to_pylist()
    return [v if len(v) <= WIDE_VALUE else "#" + hashlib.blake2b(v.encode(), digest_size=16).hexdigest() for v in out]


def column_facts(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """(by, column, rows, nulls, distinct) of every column, per value of ``by`` (null included) and, with ``all`` true, over all rows; exact.

    Each task finds the distinct (by, column, value) cells of its own batches, column by column, and hands on each of them
    about once; one shuffle of cells makes them distinct, and they are counted.  No row is copied per column."""
    cols = list(cols)
    frame = df.select((F.col(by).cast("string") if by else F.lit(None).cast("string")).alias("__by"), *[F.col(c).alias(f"__{i}") for i, c in enumerate(cols)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: set[tuple] = set()
        counts: dict[tuple, list[int]] = {}

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["by", "col", "value", "rows", "nulls"])

        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(0).dictionary_encode(null_encoding="encode")
            group, names = groups.indices.to_numpy(), groups.dictionary.to_pylist()
            in_group = np.bincount(group, minlength=len(names))
            for i in range(len(cols)):
                coded = batch.column(i + 1).dictionary_encode()
                code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
                missing = np.bincount(group[code < 0], minlength=len(names))
                for g, name in enumerate(names):
                    held = counts.setdefault((name, i), [0, 0])
                    held[0] += int(in_group[g])
                    held[1] += int(missing[g])
                keys = _value_keys(coded.dictionary)
                pairs = np.unique(group[code >= 0].astype(np.int64) * max(len(keys), 1) + code[code >= 0])
                cells.update((names[p // len(keys)], i, keys[p % len(keys)]) for p in pairs.tolist())
            if len(cells) > TASK_VALUES:
                yield out([(*c, 0, 0) for c in cells])
                cells.clear()
        yield out([(*c, 0, 0) for c in cells] + [(name, i, None, *v) for (name, i), v in counts.items()])

    # one row per cell, the counters as cells without a value
    distinct = frame.mapInArrow(run, "by string, col int, value string, rows long, nulls long").groupBy("by", "col", "value").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"))
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("col") + 1).alias("column")

    def counted(d: DataFrame, keys: list, whole: bool) -> DataFrame:
        g = d.groupBy(*keys, "col").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.count("value").alias("distinct"))
        if whole:  # every column has a row, even without data
            g = df.sparkSession.range(len(cols)).select(F.col("id").cast("int").alias("col")).join(g, "col", "left").na.fill(0, ["rows", "nulls", "distinct"])
        return g.select((F.lit(None).cast("string") if whole else F.col("by")).alias("by"), F.lit(whole).alias("all"), name, "rows", "nulls", "distinct")

    every = distinct.groupBy("col", "value").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"))
    if by is None:
        return counted(every, [], True)
    return counted(distinct, ["by"], False).unionByName(counted(every, [], True))


def schema_profile(df: DataFrame, rsd: float | None = None) -> DataFrame:
    """Row count, and per column the type and distinct count: exact from ``column_facts``, or with ``rsd`` estimates in one aggregate."""
    if rsd is None and df.columns:
        kinds = F.create_map(*[F.lit(x) for c in df.columns for x in (c, df.schema[c].dataType.simpleString())])
        return column_facts(df, df.columns).select("column", F.element_at(kinds, F.col("column")).alias("dtype"), "distinct", "rows")
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[distinct_count(c, rsd).alias(f"{c}__distinct") for c in df.columns])
    wide = wide.select("*", *[F.lit(df.schema[c].dataType.simpleString()).alias(f"{c}__dtype") for c in df.columns],
                       *[F.col("__rows").alias(f"{c}__rows") for c in df.columns])
    return _long(wide, df.columns, ["dtype", "distinct", "rows"])


def leads_distribution(df: DataFrame, leads: str = "leads") -> DataFrame:
    """One row: rows, rows with > 1 lead (count and %), min / max / median / std of leads,
    rows with 0 leads.  All from the counts per value, so the median never sees the raw column."""
    x, n = F.col("__x"), F.col("__n")
    counts = df.groupBy(F.col(leads).alias("__x")).agg(F.count(F.lit(1)).alias("__n"))
    known = F.when(x.isNotNull(), n)
    total, s1, s2 = F.sum(known), F.sum(x.cast("double") * n), F.sum(x.cast("double") * x * n)
    above = F.coalesce(F.sum(F.when(x > 1, n)), F.lit(0))
    return counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
        above.alias("rows_gt_1"),
        F.try_divide(above * 100.0, F.sum(n)).alias("pct_gt_1"),
        F.min(x).alias("min_leads"),
        F.max(x).alias("max_leads"),
        F.expr("percentile(__x, 0.5, __n)").alias("median_leads"),
        F.when(total > 1, F.sqrt(F.greatest((s2 - s1 * s1 / total) / (total - 1), F.lit(0.0)))).alias("std_leads"),
        F.coalesce(F.sum(F.when(x == 0, n)), F.lit(0)).alias("zero_lead_rows"),
    )


def leads_value_counts(df: DataFrame, leads: str = "leads") -> DataFrame:
    return df.groupBy(leads).agg(F.count(F.lit(1)).alias("count")).orderBy(leads)


def safe_corr(a: Column, b: Column, complete: Column | None = None) -> Column:
    """Pearson correlation over rows where both (and ``complete``) are non-null; null when
    fewer than 2 rows or a side has zero variance.  Never raises under ANSI."""
    ok = a.isNotNull() & b.isNotNull()
    if complete is not None:
        ok = ok & complete
    a2, b2 = F.when(ok, a.cast("double")), F.when(ok, b.cast("double"))
    sa, sb = F.stddev_samp(a2), F.stddev_samp(b2)
    return F.when((sa > 0) & (sb > 0), F.try_divide(F.covar_samp(a2, b2), sa * sb))


def correlation_with_targets(df: DataFrame, field: str, targets: Sequence[str] = ("sales", "leads", "qls", "l2s")) -> DataFrame:
    """corr(field, target) for each target over rows complete in the field and ALL targets."""
    complete = F.col(field).isNotNull()
    for t in targets:
        complete = complete & F.col(t).isNotNull()
    wide = df.agg(*[safe_corr(F.col(field), F.col(t), complete).alias(f"{t}__corr") for t in targets],
                  F.count_if(complete).alias("__n"))
    wide = wide.select("*", *[F.col("__n").alias(f"{t}__rows") for t in targets])
    return _long(wide, list(targets), ["corr", "rows"], "target").select(F.lit(field).alias("field"), "*")


def correlation_trend(df: DataFrame, field: str, target: str = "sales_count", t: float = 0.1) -> DataFrame:
    """corr with the target (pairwise complete) and a label: ASC (> t), DESC (< -t) or NONE."""
    c = safe_corr(F.col(field), F.col(target))
    return df.agg(c.alias("corr")).withColumn(
        "trend", F.when(F.col("corr") > t, "ASC").when(F.col("corr") < -t, "DESC").otherwise("NONE")
    ).select(F.lit(field).alias("field"), "corr", "trend")


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """All numeric pairs, pairwise-complete guarded correlation; long format (col_a, col_b, corr) with both orders and the
    diagonal.

    Rows are grouped by which columns are null; a group's sums of values and products (taken about the
    columns' means, so that nothing cancels) are shared by all pairs that are complete in it, and a pair adds up its
    groups: plain sums, one per pair, in one scan.  Null when a pair has fewer than 2 rows or a side does not vary."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    n = len(cols)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first() if n else []
    about = {f"__d{i}": F.coalesce(F.col(c).cast("double") - F.lit(means[i] if means[i] is not None else 0.0), F.lit(0.0)) for i, c in enumerate(cols)}
    mask = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in cols]) if n else F.lit("")
    x = df.select(mask.alias("__mask"), *[v.alias(k) for k, v in about.items()])
    sums = [F.sum(f"__d{i}").alias(f"s{i}") for i in range(n)]
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    # one row per null pattern
    groups = x.groupBy("__mask").agg(F.count(F.lit(1)).cast("double").alias("n"), *sums, *[F.sum(F.col(f"__d{i}") * F.col(f"__d{j}")).alias(f"p{i}_{j}") for i, j in pairs])
    listed = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), "n", F.col(f"s{i}").alias("si"), F.col(f"s{j}").alias("sj"), F.col(f"p{i}_{i}").alias("pii"), F.col(f"p{j}_{j}").alias("pjj"), F.col(f"p{i}_{j}").alias("pij")) for i, j in pairs]
    long = groups.select("__mask", F.explode(F.array(*listed)).alias("e")).select("__mask", "e.*") if pairs else None
    if long is None:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    both = (F.substring("__mask", F.col("i") + 1, F.lit(1)) == "1") & (F.substring("__mask", F.col("j") + 1, F.lit(1)) == "1")
    total = long.groupBy("i", "j").agg(*[F.sum(F.when(both, F.col(c))).alias(c) for c in ("n", "si", "sj", "pii", "pjj", "pij")])

    def spread(p: str, s: str) -> Column:
        v = F.col(p) - F.col(s) * F.col(s) / F.col("n")
        return F.when(v > 1e-12 * F.col(p), v)  # less is rounding: the side does not vary

    cov = F.col("pij") - F.col("si") * F.col("sj") / F.col("n")
    corr = F.when(F.col("n") >= 2, F.try_divide(cov, F.sqrt(spread("pii", "si")) * F.sqrt(spread("pjj", "sj"))))
    name = F.array(*[F.lit(c) for c in cols])
    out = total.select(F.element_at(name, F.col("i") + 1).alias("a"), F.element_at(name, F.col("j") + 1).alias("b"), corr.alias("corr"))
    both_ways = F.explode(F.array_distinct(F.array(F.struct(F.col("a").alias("col_a"), F.col("b").alias("col_b")), F.struct(F.col("b").alias("col_a"), F.col("a").alias("col_b")))))
    return out.select(both_ways.alias("r"), "corr").select("r.*", "corr")


def numeric_type_detect(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A field is numeric iff every non-null value parses as a number."""
    aggs = []
    for c in cols:
        dt = df.schema[c].dataType
        if isinstance(dt, NumericType):
            aggs.append(F.lit(True).alias(f"{c}__is_numeric"))
        else:
            bad = F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull()
            aggs.append((F.count_if(bad) == 0).alias(f"{c}__is_numeric"))
    return _long(df.agg(*aggs), cols, ["is_numeric"], "field")


def skewness_adjusted(df: DataFrame, cols: Sequence[str] | None = None, top: int = 15) -> DataFrame:
    """Adjusted Fisher-Pearson G1 (pandas ``skew``): Spark's population g1 times
    sqrt(n (n - 1)) / (n - 2); null for n < 3 or zero variance.  Largest first."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = []
    for c in cols:
        x = S.nan_to_null(F.col(c).cast("double"))
        n = F.count(x).cast("double")
        g1 = F.when(F.stddev_pop(x) > 0, F.skewness(x))
        aggs.append(F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias(f"{c}__skew"))
    return _long(df.agg(*aggs), cols, ["skew"]).orderBy(F.col("skew").desc_nulls_last(), F.col("column")).limit(top)


def box_stats_by_category(df: DataFrame, cat: str, value: str, accuracy: int | None = None) -> DataFrame:
    """Quartiles (and min / max) of ``value`` per category (null category dropped); exact and
    distributed (``grouped_exact_quantiles``), or ``percentile_approx`` with ``accuracy``."""
    x = F.col(value).cast("double")
    src = df.filter(F.col(cat).isNotNull())
    if accuracy is not None:
        g = src.groupBy(cat).agg(F.count(x).alias("count"), F.min(x).alias("min"),
                                 F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias("__q"), F.max(x).alias("max"))
        return g.select(cat, "count", "min", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"),
                        F.col("__q")[2].alias("q3"), "max")
    from enrichlab.operators.binning import grouped_exact_quantiles

    g = src.groupBy(cat).agg(F.count(x).alias("count"), F.min(x).alias("min"), F.max(x).alias("max"))
    q = grouped_exact_quantiles(src, [cat], value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    return g.join(q, cat, "left").select(cat, "count", "min", "q1", "median", "q3", "max")


def calibration_diff_rmse(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """Per-row ``actual - predicted``; RMSE over the rows where it is defined."""
    d = F.col(actual).cast("double") - F.col(pred)
    return df.agg(F.sqrt(F.avg(F.pow(d, 2))).alias("rmse"), F.count(d).alias("rows"), F.avg(d).alias("mean_diff"))


# Loan-amount classes (right-closed; the lowest edge excluded).
LOAN_CATEGORY_EDGES = (0, 100000, 500000, 1000000, 5000000, float("inf"))
LOAN_CATEGORY_LABELS = ("Small (<100K)", "Medium (100K-500K)", "Large (500K-1M)", "Very Large (1M-5M)", "Enterprise (5M+)")


def loan_category_stats(df: DataFrame, loan: str = "loan_purpose", revenue: str = "application_annual_revenue") -> DataFrame:
    """Numeric loan amount (text coerced) -> 5 classes; per class: count / mean / median
    revenue and mean loan, over rows with both values."""
    x = df.select(S.coerce_numeric(loan).alias("__loan"), S.nan_to_null(F.col(revenue).cast("double")).alias("__rev"))
    x = x.filter(F.col("__loan").isNotNull() & F.col("__rev").isNotNull())
    x = x.withColumn("loan_category", S.bin_fixed_edges_expr("__loan", LOAN_CATEGORY_EDGES, LOAN_CATEGORY_LABELS))
    x = x.filter(F.col("loan_category").isNotNull())
    from enrichlab.operators.binning import grouped_exact_quantiles

    med = grouped_exact_quantiles(x, ["loan_category"], "__rev", [0.5], ["revenue_median"])
    g = x.groupBy("loan_category").agg(
        F.count("__rev").alias("revenue_count"), F.avg("__rev").alias("revenue_mean"), F.avg("__loan").alias("loan_mean"))
    return g.join(med, "loan_category", "left").select("loan_category", "revenue_count", "revenue_mean",
                                                       "revenue_median", "loan_mean")
