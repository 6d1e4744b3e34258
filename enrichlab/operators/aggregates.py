"""Aggregations.

All of them are ``groupBy(...).agg(...)`` with built-in aggregate functions: Spark does a
map-side partial aggregation before the shuffle, so a hot key (even a third of all rows) is
pre-combined in every task and arrives at its reducer as one partial row per map task.
Ratios use ``try_divide`` (ANSI-safe).  pandas ``groupby`` drops null keys, SQL keeps them:
each operator says which it does (``dropna``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichlab.functions import scalars as S


def _drop_null_keys(df: DataFrame, keys: Sequence[str], dropna: bool) -> DataFrame:
    if not dropna:
        return df
    pred = None
    for k in keys:
        p = F.col(k).isNotNull()
        pred = p if pred is None else pred & p
    return df.filter(pred) if pred is not None else df


def _sum_int(c: str | Column) -> Column:
    return F.sum(c).cast("bigint")


# ---------------------------------------------------------------- dedup / versions


def agg_max_dedup(
    df: DataFrame,
    keys: Sequence[str],
    max_cols: Mapping[str, Column | str],
    min_cols: Mapping[str, Column | str] = {},
    key_aliases: Mapping[str, str] = {},
) -> DataFrame:
    """GROUP BY business keys with ``max`` of every attribute (dedup) and ``min`` of
    timestamps / partitions.  ``max_cols`` / ``min_cols`` map output name -> source column or
    expression; entries whose source column is absent are skipped.  Grouping is on the
    *source* columns, as the SQL resolves GROUP BY names."""
    present = set(df.columns)

    def ok(src):
        return not isinstance(src, str) or src in present

    aggs = [F.max(S.col(src)).alias(out) for out, src in max_cols.items() if ok(src)]
    aggs += [F.min(S.col(src)).alias(out) for out, src in min_cols.items() if ok(src)]
    g = df.groupBy(*keys).agg(*aggs)
    return g.withColumnsRenamed(dict(key_aliases)) if key_aliases else g


def agg_attribute_by_version(
    df: DataFrame, keys: Sequence[str], attrs: Mapping[str, str], distinct_col: str | None = None,
    distinct_alias: str = "requests_num",
) -> DataFrame:
    aggs = [F.max(src).alias(out) for out, src in attrs.items() if src in df.columns]
    if distinct_col:
        aggs.append(F.countDistinct(distinct_col).alias(distinct_alias))
    return df.groupBy(*keys).agg(*aggs)


def agg_first_version(
    df: DataFrame, version: str, min_version: str, keys: Sequence[str], attrs: Sequence[str]
) -> DataFrame:
    """Keep rows at the first version (``rn = min_rn``) and re-aggregate by ``keys``."""
    return df.filter(F.col(version) == F.col(min_version)).groupBy(*keys).agg(
        *[F.max(a).alias(a) for a in attrs]
    )


def agg_conditional_pivot(
    df: DataFrame,
    key: str | Sequence[str],
    process: str,
    flags: Mapping[str, str] = {},
    values: Mapping[str, tuple[str, str]] = {},
    dates: Mapping[str, tuple[str, str]] = {},
    distinct_count: str | None = None,
) -> DataFrame:
    """Per key: ``max(case process = x then 1 else 0)`` flags, ``max(case ... then value)``,
    ``min(case ... then date)``, ``count(distinct process)`` and ``count(*)``."""
    keys = [key] if isinstance(key, str) else list(key)
    p = F.col(process)
    aggs = [F.max(F.when(p == v, 1).otherwise(0)).alias(out) for out, v in flags.items()]
    aggs += [F.max(F.when(p == v, F.col(c))).alias(out) for out, (v, c) in values.items()]
    aggs += [F.min(F.when(p == v, F.col(c))).alias(out) for out, (v, c) in dates.items()]
    if distinct_count:
        aggs.append(F.countDistinct(p).alias(distinct_count))
    aggs.append(F.count(F.lit(1)).alias("n_rows"))
    return df.groupBy(*keys).agg(*aggs)


def agg_conditional_sum(df: DataFrame, keys: Sequence[str], pred: Column, value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(F.when(pred, F.col(value))).alias(out))


def agg_conditional_count_distinct(
    df: DataFrame, keys: Sequence[str], pred: Column, id_col: str, out: str
) -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(F.when(pred, F.col(id_col))).alias(out))


def having(df: DataFrame, pred: Column) -> DataFrame:
    return df.filter(pred)


def agg_group_by_many_dims(
    df: DataFrame, dims: Sequence[str], max_cols: Sequence[str], min_cols: Sequence[str] = ()
) -> DataFrame:
    """Many grouping dimensions: still one hash aggregate (keys hashed once)."""
    dims = [d for d in dims if d in df.columns]
    aggs = [F.max(c).alias(c) for c in max_cols if c in df.columns and c not in dims]
    aggs += [F.min(c).alias(c) for c in min_cols if c in df.columns and c not in dims]
    return df.groupBy(*dims).agg(*aggs)


def count_distinct_by(df: DataFrame, by: str | Sequence[str], id_col: str, distinct_alias="ids", rows_alias="rows") -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.countDistinct(id_col).alias(distinct_alias), F.count(id_col).alias(rows_alias))


def daily_distinct_counts(df: DataFrame, text_ts: str, id_col: str, day_alias: str, count_alias: str = "subids") -> DataFrame:
    """Distinct ids per day, where the day is the text timestamp's 10-char prefix; newest first."""
    from enrichlab.operators.windows import order_by_first_col_desc

    return order_by_first_col_desc(
        df.groupBy(S.prefix_to_date(text_ts).alias(day_alias)).agg(F.countDistinct(id_col).alias(count_alias)))


def agg_sum_after_join(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[_sum_int(src).alias(out) for out, src in sums.items()])


def monthly_sums(df: DataFrame, ts: str, sums: Mapping[str, str], month_alias: str = "month") -> DataFrame:
    return df.groupBy(S.month_of(ts).alias(month_alias)).agg(*[F.sum(src).alias(out) for out, src in sums.items()])


# ---------------------------------------------------------------- conversion (L2S) tables


def l2s_by_dimension(
    df: DataFrame, dims: str | Sequence[str], leads: str = "leads_count", sales: str = "sales_count",
    dropna: bool = True,
) -> DataFrame:
    """sum(leads), sum(sales), sales/leads by one or two dimensions.  The ad-hoc reference
    cells have no zero guard (inf / NaN at 0 leads); here that ratio is null."""
    dims = [dims] if isinstance(dims, str) else list(dims)
    src = _drop_null_keys(df, dims, dropna)
    return src.groupBy(*dims).agg(
        _sum_int(leads).alias("leads"),
        _sum_int(sales).alias("sales"),
        F.try_divide(F.sum(sales).cast("double"), F.sum(leads)).alias("l2s"),
    )


def l2s_summary_guarded(df: DataFrame, dim: str, leads: str = "leads_count", sales: str = "sales_count") -> DataFrame:
    """Same with 0 leads -> null ratio, ordered by L2S descending."""
    return l2s_by_dimension(df, dim, leads, sales).orderBy(F.col("l2s").desc_nulls_last(), F.col(dim))


def _l2s_row(leads: str, sales: str) -> Column:
    return S.safe_ratio(F.col(sales).cast("double"), F.col(leads))


def field_value_stats(
    df: DataFrame, field: str, leads: str = "leads", qls: str = "qls", sales: str = "sales", null_label: str = "NULL"
) -> DataFrame:
    """Null relabelled ``'NULL'``; per value: leads count / sum, qls sum / mean, sales sum / mean,
    mean per-row L2S (rows with 0 leads count as missing); ordered by total leads desc."""
    v = F.coalesce(F.col(field).cast("string"), F.lit(null_label)).alias(field)
    return (
        df.groupBy(v)
        .agg(
            F.count(leads).alias("leads_count"),
            _sum_int(leads).alias("total_leads"),
            _sum_int(qls).alias("total_qls"),
            F.avg(qls).alias("avg_qls_per_record"),
            _sum_int(sales).alias("total_sales"),
            F.avg(sales).alias("avg_sales_per_record"),
            F.avg(_l2s_row(leads, sales)).alias("avg_l2s_rate"),
        )
        .orderBy(F.col("total_leads").desc(), F.col(field))
    )


def company_stats(
    df: DataFrame, company: str = "company", id_col: str = "subid", leads: str = "leads", qls: str = "qls",
    sales: str = "sales",
) -> DataFrame:
    """Records, leads, qls, sales, mean per-row L2S, overall L2S %, QL rate %, sales rate %."""
    g = _drop_null_keys(df, [company], True).groupBy(company).agg(
        F.count(id_col).alias("total_records"),
        _sum_int(leads).alias("total_leads"),
        _sum_int(qls).alias("total_qls"),
        _sum_int(sales).alias("total_sales"),
        F.avg(_l2s_row(leads, sales)).alias("avg_l2s_rate"),
    )
    pct = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b)) * 100
    return g.withColumns({
        "l2s_overall": pct("total_sales", "total_leads"),
        "qls_rate": pct("total_qls", "total_leads"),
        "sales_rate": pct("total_sales", "total_leads"),
    }).orderBy(F.col("total_sales").desc(), F.col(company))


def category_stats_by_sales(
    df: DataFrame, field: str, leads: str = "leads", qls: str = "qls", sales: str = "sales"
) -> DataFrame:
    """Per category (null dropped): sums, mean per-row L2S and the guarded rate in %."""
    g = _drop_null_keys(df, [field], True).groupBy(field).agg(
        _sum_int(leads).alias("leads"),
        _sum_int(qls).alias("qls"),
        _sum_int(sales).alias("sales"),
        F.avg(_l2s_row(leads, sales)).alias("l2s"),
    )
    return g.withColumn(
        "l2s_rate",
        F.when(F.col("leads") > 0, F.try_divide(F.col("sales").cast("double"), F.col("leads")) * 100).otherwise(0.0),
    )


def category_top10_by_sales(df: DataFrame, field: str, k: int = 10, **kw) -> DataFrame:
    return category_stats_by_sales(df, field, **kw).orderBy(F.col("sales").desc(), F.col(field)).limit(k)


def category_rate_summary(df: DataFrame, field: str, **kw) -> DataFrame:
    """Number of categories, how many have sales, best / worst / average rate over leads > 0."""
    s = category_stats_by_sales(df, field, **kw)
    pos = F.col("leads") > 0
    return s.agg(
        F.count(F.lit(1)).alias("n_categories"),
        F.count_if(F.col("sales") > 0).alias("n_with_sales"),
        F.max(F.when(pos, F.col("l2s_rate"))).alias("best_rate"),
        F.min(F.when(pos, F.col("l2s_rate"))).alias("worst_rate"),
        F.avg(F.when(pos, F.col("l2s_rate"))).alias("avg_rate"),
    )


def category_top10_by_leads(df: DataFrame, field: str, sales: str = "sales_count", k: int = 10) -> DataFrame:
    """leads = number of non-null ``sales`` rows, sales_sum, l2s; top k by leads."""
    g = _drop_null_keys(df, [field], True).groupBy(field).agg(
        F.count(sales).alias("leads"), _sum_int(sales).alias("sales_sum")
    )
    return g.withColumn("l2s", F.try_divide(F.col("sales_sum").cast("double"), F.col("leads"))).orderBy(
        F.col("leads").desc(), F.col(field)
    ).limit(k)


def numeric_value_top5(df: DataFrame, field: str, sales: str = "sales_count", max_distinct: int = 20, k: int = 5) -> DataFrame:
    """Same for a numeric field with at most ``max_distinct`` distinct values (empty otherwise).
    The gate is a scalar subquery (one value), so no driver round trip is needed."""
    nd = df.agg(F.countDistinct(field)).scalar()
    g = _drop_null_keys(df, [field], True).groupBy(field).agg(
        F.count(sales).alias("leads"), _sum_int(sales).alias("sales_sum")
    ).withColumn("l2s", F.try_divide(F.col("sales_sum").cast("double"), F.col("leads")))
    return g.filter(nd <= max_distinct).orderBy(
        F.col("leads").desc(), F.col(field)
    ).limit(k)


def _group_median(src: DataFrame, cat: str, value: str, name: str, accuracy: int | None) -> DataFrame | None:
    """Exact per-group median, distributed (None when ``accuracy`` asks for the sketch)."""
    if accuracy is not None:
        return None
    from enrichlab.operators.binning import grouped_exact_quantiles

    return grouped_exact_quantiles(src, [cat], value, [0.5], [name])


def revenue_stats_by_category(
    df: DataFrame, cat: str, value: str, leads: str = "leads_count", sales: str = "sales_count", accuracy: int | None = None
) -> DataFrame:
    """count / mean / median / std / min / max of ``value`` plus leads, sales and conversion
    per category.  The median is exact and distributed (``grouped_exact_quantiles``), or
    ``percentile_approx`` with ``accuracy``."""
    src = _drop_null_keys(df, [cat], True)
    aggs = [F.count(value).alias("count"), F.avg(value).alias("mean")]
    if accuracy is not None:
        aggs.append(F.percentile_approx(value, 0.5, accuracy).alias("median"))
    aggs += [
        F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"),
        _sum_int(leads).alias("leads"), _sum_int(sales).alias("sales"),
        F.try_divide(F.sum(sales).cast("double"), F.sum(leads)).alias("conversion_rate"),
    ]
    g = src.groupBy(cat).agg(*aggs)
    med = _group_median(src, cat, value, "median", accuracy)
    if med is None:
        return g
    cols = ["count", "mean", "median", "std", "min", "max", "leads", "sales", "conversion_rate"]
    return g.join(med, cat, "left").select(cat, *cols)


def median_and_volume_by_category(df: DataFrame, cat: str, value: str, volume: str, k: int = 50,
                                  accuracy: int | None = None) -> DataFrame:
    src = _drop_null_keys(df, [cat], True)
    if accuracy is not None:
        g = src.groupBy(cat).agg(F.percentile_approx(value, 0.5, accuracy).alias("median_value"), F.sum(volume).alias("volume"))
    else:
        g = src.groupBy(cat).agg(F.sum(volume).alias("volume")).join(
            _group_median(src, cat, value, "median_value", None), cat, "left").select(cat, "median_value", "volume")
    return g.orderBy(F.col("volume").desc(), F.col(cat)).limit(k)


def high_value_ratio_by_category(df: DataFrame, cat: str, value: str, t: float, k: int = 40) -> DataFrame:
    g = _drop_null_keys(df, [cat], True).groupBy(cat).agg(
        F.count_if(F.col(value) >= t).alias("n_high"), F.count(value).alias("n")
    )
    return g.withColumn("ratio", F.try_divide(F.col("n_high").cast("double"), F.col("n"))).orderBy(
        F.col("n").desc(), F.col(cat)
    ).limit(k)


def loan_stats_by_score(df: DataFrame, score: str, amounts: Sequence[str], pred: Column | None = None) -> DataFrame:
    src = df.filter(pred) if pred is not None else df
    aggs = []
    for a in amounts:
        aggs += [F.avg(a).alias(f"mean_{a}"), F.sum(a).alias(f"sum_{a}")]
    return _drop_null_keys(src, [score], True).groupBy(score).agg(*aggs)


def coverage_totals(df: DataFrame, tiers: Mapping[str, Column], sums: Sequence[str], ts: str | None = None) -> DataFrame:
    """Totals for nested subsets in ONE pass: one output row per tier, built by ``unpivot``-ing
    per-tier conditional sums (no filter + union of several scans)."""
    aggs = []
    for t, pred in tiers.items():
        aggs.append(F.count_if(pred).alias(f"{t}__rows"))
        aggs += [F.sum(F.when(pred, F.col(s))).alias(f"{t}__{s}") for s in sums]
        if ts:
            aggs += [F.min(F.when(pred, F.col(ts))).alias(f"{t}__min_ts"), F.max(F.when(pred, F.col(ts))).alias(f"{t}__max_ts")]
    wide = df.agg(*aggs)
    fields = ["rows"] + list(sums) + (["min_ts", "max_ts"] if ts else [])
    rows = [
        F.struct(F.lit(t).alias("tier"), *[F.col(f"{t}__{f}").alias(f) for f in fields]) for t in tiers
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def record_count_by_id(df: DataFrame, id_col: str, sums: Sequence[str]) -> DataFrame:
    return df.groupBy(id_col).agg(F.count(F.lit(1)).alias("records"), *[F.sum(s).alias(s) for s in sums]).orderBy(
        F.col("records").desc(), F.col(id_col)
    )


def sum_count_mean_by_category(df: DataFrame, cat: str, value: str) -> DataFrame:
    return _drop_null_keys(df, [cat], True).groupBy(cat).agg(
        F.sum(value).alias("sum"), F.count(value).alias("count"), F.avg(value).alias("mean")
    ).orderBy(F.col("sum").desc(), F.col(cat))


def value_counts(df: DataFrame, c: str, dropna: bool = True, sort_by_value: bool = False) -> DataFrame:
    g = _drop_null_keys(df, [c], dropna).groupBy(c).agg(F.count(F.lit(1)).alias("count"))
    return g.orderBy(F.col(c)) if sort_by_value else g.orderBy(F.col("count").desc(), F.col(c))


def big_categories(df: DataFrame, c: str, min_share: float = 0.01, top: int | None = None) -> DataFrame:
    """Categories whose share of all rows is strictly above ``min_share``.  The total is a
    scalar subquery (one value), not a driver round trip."""
    total = df.agg(F.count(F.lit(1))).scalar()
    g = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("count"))
    out = (
        g.withColumn("share", F.col("count") / total)
        .filter(F.col("share") > min_share)
        .orderBy(F.col("count").desc(), F.col(c))
    )
    return out.limit(top) if top else out


def overall_rates(df: DataFrame, leads: str = "leads", qls: str | None = "qls", sales: str = "sales",
                  field: str | None = None) -> DataFrame:
    aggs = [_sum_int(leads).alias("total_leads"), _sum_int(sales).alias("total_sales")]
    if qls:
        aggs.append(_sum_int(qls).alias("total_qls"))
    aggs.append((F.try_divide(F.sum(sales).cast("double"), F.sum(leads)) * 100).alias("l2s_pct"))
    if field:
        # unique values with null counted as one more value
        aggs.append((F.countDistinct(field) + F.max(F.col(field).isNull().cast("int"))).alias("unique_values"))
    return df.agg(*aggs)


def any_null_share(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    anyf = None
    for f in flags:
        p = F.col(f) == 1
        anyf = p if anyf is None else (anyf | p)
    return df.agg(F.avg(anyf.cast("double")).alias("any_null_share"))
