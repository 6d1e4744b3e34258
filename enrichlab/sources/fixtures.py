"""Fixture views: the attribute / funnel / prediction / scored roles derived from the driver's
TPC-H-like tables (definitions in FIXTURES.md).  Nulls are injected by key arithmetic so the
null rules get exercised.  Every view is a pure projection (plus one key join) of a scanned
table, so it stays lazy and Catalyst prunes the columns a query does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichlab.sources.tables import read_table


def _case(key: Column, mapping: list[tuple[object, object]], default: object = None) -> Column:
    expr = None
    for k, v in mapping:
        val = F.lit(v)
        expr = F.when(key == k, val) if expr is None else expr.when(key == k, val)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _day_str(ts: str) -> Column:
    return F.col(ts).cast("date").cast("string")


def fx_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    pk, sk, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    price = F.col("l_extendedprice")
    day = _day_str("l_shipdate")
    return li.select(
        F.col("l_orderkey").cast("string").alias("subid"),
        _case(F.col("l_returnflag"), [("A", "lead"), ("N", "allocated")], "sale").alias("process_name"),
        (sk % 5).cast("int").alias("partner_id"),
        F.concat(F.lit("partner"), (sk % 5).cast("string")).alias("partner_name"),
        F.concat(F.lit("v"), F.col("l_linestatus")).alias("vertical_id"),
        ln.alias("rn"),
        _case(pk % 5, [(1, "Corporation"), (2, "Limited Liability Company"), (3, "Sole Proprietorship"),
                       (4, "llc")]).alias("customer_status"),
        F.when(pk % 9 != 0, F.col("l_quantity") * 4).alias("age_group"),
        F.when(pk % 7 == 0, F.lit(None).cast("double")).when(pk % 11 == 0, F.lit(0.0))
        .otherwise(price).alias("net_revenue"),
        _case(pk % 4, [(0, "Refinance"), (2, "n/a")])
        .when(pk % 4 == 1, F.floor(price * 10).cast("bigint").cast("string")).alias("loanpurpose"),
        _case(sk % 6, [(1, "Construction"), (2, "Retail Trade"), (3, "Health Care and Social Assistance"),
                       (4, "Mining"), (5, "Transportation and Warehousing")]).alias("sku"),
        _case(sk % 7, [(1, "Full-Service Restaurants"), (2, "Residential Building Construction"),
                       (3, "HVACPlumbing and Electrician"), (4, "Heavy Construction"),
                       (5, "Florists"), (6, "Florists")]).alias("os"),
        _case(pk % 6, [(1, "Very Low"), (2, "Low"), (3, "Medium"), (4, "High"), (5, "Very High")])
        .alias("user_rank"),
        F.when(pk % 8 != 0, price).alias("loanamount"),
        F.when(~(pk % 8).isin(0, 1), (F.lit(500) + pk % 350).cast("int")).alias("creditscore"),
        F.when(F.col("l_returnflag") == "R", price * 0.9).alias("funded_amount"),
        F.when(ln <= 2, "First Deposit").otherwise("Other").alias("event_type"),
        (price * (1 - F.col("l_discount"))).alias("sale_amount"),
        F.concat(day, F.lit(" 00:00:00")).alias("transaction_date"),
        F.substring(day, 1, 7).alias("transaction_month_prt"),
        F.when(ln % 3 == 0, F.concat(day, F.lit("T06:00:00")))
        .when(ln % 3 == 1, F.concat(day, F.lit(" 18:30:00")))
        .otherwise(F.concat(day, F.lit("T06:00:00+0000"))).alias("created_at"),
        F.concat(day, F.lit(" 12:00:00")).alias("action_time"),
    )


def _leads(key: Column) -> Column:
    return F.when(key % 13 == 0, 0).when(key % 50 == 0, 2).otherwise(1).cast("int")


def fx_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    d = F.col("o_orderdate")
    return o.select(
        ok.cast("string").alias("cid"),
        F.concat(F.lit("v"), ck.cast("string")).alias("visit_iid"),
        F.concat(F.lit("c"), ok.cast("string")).alias("channel_click_id"),
        (ck % 5).cast("int").alias("partner_id"),
        (ck % 3).cast("int").alias("product_id"),
        F.when(ck % 2 == 0, "vF").otherwise("vO").alias("vertical_id"),
        F.when(ok % 10 == 0, "bots").otherwise("users").alias("traffic_type"),
        d.cast("date").alias("conversion_date"),
        d.alias("conversion_timestamp"),
        d.cast("date").alias("clickout_date"),
        d.alias("clickout_timestamp"),
        F.substring(_day_str("o_orderdate"), 1, 7).alias("dt"),
        F.col("o_orderpriority").alias("company"),
        _leads(ok).alias("leads_count"),
        F.col("o_orderstatus").isin("F", "P").cast("int").alias("qualified_leads_count"),
        (F.col("o_orderstatus") == "F").cast("int").alias("sales_count"),
    )


def fx_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    d = F.col("o_orderdate")
    return j.select(
        F.concat(F.lit("c"), ok.cast("string")).alias("channel_click_id"),
        F.concat(F.lit("v"), ck.cast("string")).alias("visit_iid"),
        F.when(ok % 17 != 0, ok.cast("string")).alias("cid"),
        (ck % 3).cast("int").alias("product_id"),
        F.when(ck % 2 == 0, "vF").otherwise("vO").alias("vertical_id"),
        F.col("c_mktsegment").alias("product_name"),
        F.col("o_orderpriority").alias("company"),
        F.when(ok % 4 != 0, F.concat(F.lit("C"), F.col("c_nationkey").cast("string"))).alias("channel_country_code"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country_code"),
        _case(ok % 5, [(0, "g"), (1, "o"), (2, "s"), (4, "y")]).alias("network"),
        d.alias("visit_timestamp"),
        F.when(ok % 19 != 0, F.timestamp_add("SECOND", ok % 90, d)).alias("clickout_timestamp"),
        _day_str("o_orderdate").alias("clickout_date_prt"),
        ((ck % 100).cast("double") / 100).alias("normalized_p_cr_lead"),
        ((ok % 37).cast("double") / 100).alias("normalized_p_cr_sale"),
        F.when(ok % 23 != 0, (ok % 31).cast("double") / 50).alias("p_cr_sale"),
        (F.col("o_totalprice") / 1000).alias("predicted_commission"),
        _leads(ok).alias("leads_count"),
        (F.col("o_orderstatus") == "F").cast("int").alias("sales_count"),
    )


def fx_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
        .alias("row_key"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        ((F.floor(F.col("l_extendedprice")) % 1000).cast("double") / 1000).alias("p"),
        (F.col("l_discount") * 10).alias("p_tied"),
        F.col("l_linenumber").alias("leads"),
        F.col("l_shipdate").cast("date").alias("d"),
    )


def fixture_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "fx_attribute": fx_attribute(spark, sf_dir),
        "fx_funnel": fx_funnel(spark, sf_dir),
        "fx_predictions": fx_predictions(spark, sf_dir),
        "fx_scored": fx_scored(spark, sf_dir),
    }
