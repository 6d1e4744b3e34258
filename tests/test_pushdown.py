"""Filters and projections reach the parquet scan (partition pruning, pushed filters, pruned
read schema) when the attribute role is stored partitioned by month, as in the warehouse."""

import tempfile

from pyspark.sql import functions as F

from enrichlab.sources import fx_attribute, scan_attribute, write_parquet
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scan_prunes_partitions_and_columns(spark):
    path = tempfile.mkdtemp(prefix="enrichlab-pushdown-") + "/attribute"
    write_parquet(fx_attribute(spark, SF_SMALL), path, partition_by=["transaction_month_prt"])
    e = scan_attribute(path, partner_ids=[1, 2], process_names=["sale"], month_from="1995-01",
                        vertical_ids=["vF"], spark=spark)
    q = e.groupBy("subid").agg(F.max("net_revenue").alias("rev"))
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(transaction_month_prt" in plan and "1995-01" in plan
    assert "PushedFilters: [" in plan and "In(partner_id" in plan and "EqualTo(process_name,sale)" in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "net_revenue" in read_schema and "user_rank" not in read_schema and "sku" not in read_schema
    full = fx_attribute(spark, SF_SMALL).filter(
        F.col("partner_id").isin(1, 2) & (F.col("process_name") == "sale") & (F.col("transaction_month_prt") >= "1995-01")
        & (F.col("vertical_id") == "vF")).groupBy("subid").agg(F.max("net_revenue").alias("rev"))
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, full.collect()))
