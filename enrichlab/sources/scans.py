"""Parameterised scans of the three warehouse roles.

Parameters are plain Python values turned into Column predicates (``isin``, string ``>=`` on
partition columns, ``between`` on dates) - never spliced into SQL text.  On a table written
with ``partitionBy(month)`` the month predicates become PartitionFilters; the rest become
parquet PushedFilters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichlab.session import checkpoint_dir, forget_at_exit


def _source(spark: SparkSession | None, source: DataFrame | str) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    assert spark is not None, "a path needs a session"
    return spark.read.parquet(source)


def _and(df: DataFrame, *preds):
    for p in preds:
        if p is not None:
            df = df.filter(p)
    return df


def _isin(c: str, values: Sequence | None):
    return None if values is None else F.col(c).isin(list(values))


@dataclass(frozen=True)
class ExtractParams:
    """The extraction parameters (lists become ``isin``; months and dates stay strings)."""

    partner_ids: Sequence[int] | None = None
    product_ids: Sequence[int] | None = None
    process_names: Sequence[str] | None = None
    vertical_ids: Sequence[str] | None = None
    month_from: str | None = None  # 'yyyy-MM', lexicographic compare on the partition
    month_to: str | None = None
    click_from: str | None = None  # 'yyyy-MM-dd'
    click_to: str | None = None
    traffic_type: str | None = None
    extra: dict = field(default_factory=dict)


def scan_attribute(
    source: DataFrame | str,
    partner_ids=None,
    process_names=None,
    month_from: str | None = None,
    vertical_ids=None,
    month_to: str | None = None,
    spark: SparkSession | None = None,
    month_col: str = "transaction_month_prt",
) -> DataFrame:
    df = _source(spark, source)
    return _and(
        df,
        _isin("partner_id", partner_ids),
        _isin("process_name", process_names),
        None if month_from is None else F.col(month_col) >= F.lit(month_from),
        None if month_to is None else F.col(month_col) <= F.lit(month_to),
        _isin("vertical_id", vertical_ids),
    )


def scan_funnel(
    source: DataFrame | str,
    partner_ids=None,
    vertical_ids=None,
    month_from: str | None = None,
    month_to: str | None = None,
    click_from: str | None = None,
    click_to: str | None = None,
    traffic_type: str | None = None,
    product_ids=None,
    spark: SparkSession | None = None,
) -> DataFrame:
    df = _source(spark, source)
    click = None
    if click_from is not None and click_to is not None:
        click = F.col("clickout_date").between(F.to_date(F.lit(click_from)), F.to_date(F.lit(click_to)))
    elif click_from is not None:
        click = F.col("clickout_date") >= F.to_date(F.lit(click_from))
    return _and(
        df,
        _isin("partner_id", partner_ids),
        None if month_from is None else F.col("dt") >= F.lit(month_from),
        None if month_to is None else F.col("dt") <= F.lit(month_to),
        click,
        _isin("vertical_id", vertical_ids),
        _isin("product_id", product_ids),
        None if traffic_type is None else F.col("traffic_type") == F.lit(traffic_type),
    )


def scan_predictions(
    source: DataFrame | str,
    product_ids=None,
    vertical_ids=None,
    click_from: str | None = None,
    spark: SparkSession | None = None,
    require_cid: bool = True,
) -> DataFrame:
    df = _source(spark, source)
    return _and(
        df,
        _isin("product_id", product_ids),
        _isin("vertical_id", vertical_ids),
        None if click_from is None else F.col("clickout_date_prt") >= F.lit(click_from),
        F.col("cid").isNotNull() if require_cid else None,
    )


def load_leads(df: DataFrame, leads: str = "leads_count", sales: str = "sales_count", min_leads: int = 1):
    """Keep rows with ``leads >= min_leads``; also return the one-row totals
    (rows, leads, sales, sales rate) as a lazy DataFrame."""
    kept = df.filter(F.col(leads) >= min_leads)
    totals = kept.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(leads).cast("bigint").alias("leads"),
        F.sum(sales).cast("bigint").alias("sales"),
        F.try_divide(F.sum(sales).cast("double"), F.sum(leads)).alias("sales_rate"),
    )
    return kept, totals


def cache_result(df: DataFrame, path: str | None = None) -> DataFrame:
    """Re-usable result: written parquet under the shared checkpoint folder (survives lost
    executors and cuts lineage) when ``path`` is given or ``'auto'``; else ``persist``."""
    if path is None:
        return df.persist()
    if path == "auto":
        import uuid

        path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/cache-{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(path)
        forget_at_exit(df.sparkSession, path)
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Sink: parquet, optionally partitioned (e.g. by month) so later scans prune."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
