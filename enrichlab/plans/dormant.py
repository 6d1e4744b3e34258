"""Dormant operators: behaviour legible in commented-out reference code.

Each is one grouped aggregate reshaped to a long table (company x feature), so the per-company
and per-feature loops of the reference become a single shuffle keyed by company.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from enrichlab.operators.profile import column_facts, distinct_count
from enrichlab.plans import extracts as X
from enrichlab.operators import windows as W
from enrichlab.sources.scans import ExtractParams


def company_feature_nulls(df: DataFrame, company: str, cols: Sequence[str]) -> DataFrame:
    """(company, feature, null_count, total_count, null_pct) for present features; null
    companies skipped."""
    cols = [c for c in cols if c in df.columns]
    g = df.filter(F.col(company).isNotNull()).groupBy(company).agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = g.unpivot([company, "__n"], cols, "feature", "null_count")
    return long.select(company, "feature", "null_count", F.col("__n").alias("total_count"),
                       (F.col("null_count") * 100.0 / F.col("__n")).alias("null_pct"))


def null_rate_by_company(df: DataFrame, company: str, cols: Sequence[str], max_pct: float = 60.0) -> DataFrame:
    """Per feature: the worst company null % and whether the feature is removed (any company
    strictly above ``max_pct``)."""
    long = company_feature_nulls(df, company, cols)
    return long.groupBy("feature").agg(F.max("null_pct").alias("max_null_pct"),
                                       F.count_if(F.col("null_pct") > max_pct).alias("companies_over")).withColumn(
        "remove", F.col("companies_over") > 0)


def feature_decisions(df: DataFrame, group: str, cols: Sequence[str], max_pct: float = 40.0) -> DataFrame:
    """Per feature over groups: excluded when null in every group; else excluded when the
    overall null % exceeds ``max_pct``; a missing column is excluded too."""
    present = [c for c in cols if c in df.columns]
    long = company_feature_nulls(df, group, present)
    per = long.groupBy("feature").agg(
        F.count_if(F.col("null_pct") < 100).alias("groups_with_data"),
        (F.sum("null_count") * 100.0 / F.sum("total_count")).alias("overall_null_pct"))
    out = per.select(
        "feature", "groups_with_data", "overall_null_pct",
        F.when(F.col("groups_with_data") == 0, F.lit(False)).when(F.col("overall_null_pct") > max_pct, F.lit(False))
        .otherwise(F.lit(True)).alias("use_feature"),
        F.when(F.col("groups_with_data") == 0, F.lit("null in every group"))
        .when(F.col("overall_null_pct") > max_pct, F.lit(f"overall null % above {max_pct:g}"))
        .otherwise(F.lit("ok")).alias("reason"),
    )
    missing = [c for c in cols if c not in df.columns]
    if missing:
        spark = df.sparkSession
        extra = spark.createDataFrame([(m, 0, None, False, "column missing") for m in missing],
                                      "feature string, groups_with_data bigint, overall_null_pct double, use_feature boolean, reason string")
        out = out.unionByName(extra)
    return out


def good_company_detect(df: DataFrame, company: str, cols: Sequence[str], min_coverage: float = 0.3,
                        min_rows: int = 1000) -> DataFrame:
    """Per company: rows, features with any data, coverage = that / #features; good when
    coverage > min_coverage and rows > min_rows."""
    present = [c for c in cols if c in df.columns]
    long = company_feature_nulls(df, company, present)
    g = long.groupBy(company).agg(F.max("total_count").alias("row_count"),
                                  F.count_if(F.col("null_pct") < 100).alias("features_with_data"))
    return g.withColumn("attribute_coverage", F.col("features_with_data") / F.lit(float(len(cols)))).withColumn(
        "good", (F.col("attribute_coverage") > min_coverage) & (F.col("row_count") > min_rows))


def recent_window_report(df: DataFrame, date: str, cols: Sequence[str], months: int = 3) -> DataFrame:
    """Rows in the last ``months`` months before the latest date (scalar subquery); per month:
    rows, per feature non-null / null counts, and the share of rows with any attribute."""
    mx = df.agg(F.max(F.to_date(F.col(date)))).scalar()
    recent = df.filter(F.to_date(F.col(date)) > F.add_months(mx, -months))
    anyf = None
    for c in cols:
        p = F.col(c).isNotNull()
        anyf = p if anyf is None else (anyf | p)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in cols:
        aggs += [F.count(c).alias(f"{c}_non_null"), F.count_if(F.col(c).isNull()).alias(f"{c}_null")]
    aggs.append(F.avg(anyf.cast("double")).alias("any_attribute_share"))
    return recent.groupBy(F.trunc(F.to_date(F.col(date)), "MM").alias("month")).agg(*aggs)


def data_quality_summary(df: DataFrame, company: str, cols: Sequence[str], rsd: float | None = None) -> DataFrame:
    """Null %, distinct non-null values (estimated if ``rsd`` is given) and a grade (good < 40 %,
    warn < 60 %, poor) per feature, overall (company = 'ALL') and per company, from one scan (``column_facts``)."""
    present = [c for c in cols if c in df.columns]
    if rsd is None:
        facts = column_facts(df, present, company).filter(F.col("all") | F.col("by").isNotNull())
        long = facts.select(F.when(F.col("all"), "ALL").otherwise(F.col("by")).alias(company), F.col("rows").alias("__n"), F.col("column").alias("feature"),
                            F.col("nulls").alias("null_count"), F.col("distinct").alias("unique_count"))
    else:
        long = _estimated_quality(df, company, present, rsd)
    pct = F.try_divide(F.col("null_count") * 100.0, F.col("__n"))
    return long.select(company, "feature", pct.alias("null_pct"), "unique_count",
                       F.when(pct < 40, "good").when(pct < 60, "warn").otherwise("poor").alias("grade"))


def _estimated_quality(df: DataFrame, company: str, present: Sequence[str], rsd: float) -> DataFrame:
    """The counts of ``data_quality_summary`` with estimated distinct values: one grouping-sets aggregate."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in present:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"), distinct_count(c, rsd).alias(f"{c}__distinct")]
    sets = df.groupingSets([[F.col(company)], []], F.col(company)).agg(F.grouping(company).alias("__all"), *aggs)
    both = sets.filter((F.col("__all") == 1) | F.col(company).isNotNull()).withColumn(
        company, F.when(F.col("__all") == 1, "ALL").otherwise(F.col(company))).drop("__all")
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"{c}__nulls").alias("null_count"),
                     F.col(f"{c}__distinct").alias("unique_count")) for c in present]
    return both.select(company, "__n", F.explode(F.array(*rows)).alias("r")).select(company, "__n", "r.*")


def feature_info(df: DataFrame, cols: Sequence[str] | None = None, rsd: float | None = None) -> DataFrame:
    """dtype, nulls, distinct values and numeric flag per column (one scan)."""
    cols = list(cols) if cols is not None else df.columns
    if rsd is None and cols:
        kinds = F.create_map(*[F.lit(x) for c in cols for x in (c, df.schema[c].dataType.simpleString())])
        numbers = [c for c in cols if isinstance(df.schema[c].dataType, NumericType)]
        return column_facts(df, cols).select("column", F.element_at(kinds, F.col("column")).alias("dtype"), "nulls", "distinct", F.col("column").isin(numbers).alias("is_numeric"))
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in cols],
                  *[distinct_count(c, rsd).alias(f"{c}__distinct") for c in cols])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                     F.col(f"{c}__nulls").alias("nulls"), F.col(f"{c}__distinct").alias("distinct"),
                     F.lit(isinstance(df.schema[c].dataType, NumericType)).alias("is_numeric")) for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def target_info(df: DataFrame, target: str) -> DataFrame:
    """Target summary: dtype, nulls, distinct, mean, positives and their share."""
    t = F.col(target)
    return df.agg(F.lit(df.schema[target].dataType.simpleString()).alias("dtype"), F.count_if(t.isNull()).alias("nulls"),
                  F.countDistinct(t).alias("distinct"), F.avg(t).alias("mean"), F.count_if(t > 0).alias("positives"),
                  (F.count_if(t > 0) / F.count(t)).alias("positive_share"))


def visit_latest_extract(enrich: DataFrame, funnel: DataFrame, pred: DataFrame, p: ExtractParams) -> DataFrame:
    """Variant extract: predictions deduplicated on (click, visit, product, company, region)
    and reduced to the latest click per visit (``max(struct(clickout_timestamp, ...))`` - an
    aggregate, skew-safe), left-joined to first-version attribute."""
    from enrichlab.sources.scans import scan_predictions

    ps = scan_predictions(pred, p.product_ids, p.vertical_ids, p.click_from)
    if "region_code" not in ps.columns:
        ps = ps.withColumn("region_code", F.coalesce(*[F.col(c) for c in ("channel_region_code", "ip_region_code", "country_code")
                                                        if c in ps.columns]))
    g = ps.groupBy("channel_click_id", "visit_iid", "product_name", "company", "region_code").agg(
        F.min("clickout_timestamp").alias("clickout_timestamp"), F.max("leads_count").alias("leads_count"),
        F.max("sales_count").alias("sales_count"), F.max("normalized_p_cr_sale").alias("normalized_p_cr_sale"),
        F.max("normalized_p_cr_lead").alias("normalized_p_cr_lead"))
    latest = W.latest_per_key(g, "visit_iid", ["clickout_timestamp", "channel_click_id", "product_name", "company", "region_code"])
    en = X.attribute_first_version(enrich, funnel, p)
    return latest.join(en, (latest["channel_click_id"] == en["en_channel_click_id"]) & (latest["visit_iid"] == en["en_visit_iid"]),
                       "left").drop("en_channel_click_id", "en_visit_iid")
