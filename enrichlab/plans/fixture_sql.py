"""DuckDB text of the fixture views (FIXTURES.md), used only by the oracle SQL checks."""

FIXTURE_SQL = {
    "fx_attribute": """
select cast(l_orderkey as string) as subid,
       case l_returnflag when 'A' then 'lead' when 'N' then 'allocated' else 'sale' end as process_name,
       cast(l_suppkey % 5 as int) as partner_id,
       concat('partner', cast(l_suppkey % 5 as string)) as partner_name,
       concat('v', l_linestatus) as vertical_id,
       l_linenumber as rn,
       case l_partkey % 5 when 0 then null when 1 then 'Corporation' when 2 then 'Limited Liability Company'
            when 3 then 'Sole Proprietorship' else 'llc' end as customer_status,
       case when l_partkey % 9 = 0 then null else l_quantity * 4 end as age_group,
       case when l_partkey % 7 = 0 then null when l_partkey % 11 = 0 then cast(0 as double) else l_extendedprice end as net_revenue,
       case l_partkey % 4 when 0 then 'Refinance' when 1 then cast(cast(floor(l_extendedprice * 10) as bigint) as string) when 2 then 'n/a' else null end as loanpurpose,
       case l_suppkey % 6 when 0 then null when 1 then 'Construction' when 2 then 'Retail Trade' when 3 then 'Health Care and Social Assistance' when 4 then 'Mining' else 'Transportation and Warehousing' end as sku,
       case l_suppkey % 7 when 0 then null when 1 then 'Full-Service Restaurants' when 2 then 'Residential Building Construction' when 3 then 'HVACPlumbing and Electrician' when 4 then 'Heavy Construction' else 'Florists' end as os,
       case l_partkey % 6 when 0 then null when 1 then 'Very Low' when 2 then 'Low' when 3 then 'Medium' when 4 then 'High' else 'Very High' end as user_rank,
       case when l_partkey % 8 = 0 then null else l_extendedprice end as loanamount,
       case when l_partkey % 8 in (0, 1) then null else cast(500 + l_partkey % 350 as int) end as creditscore,
       case when l_returnflag = 'R' then l_extendedprice * 0.9 else null end as funded_amount,
       case when l_linenumber <= 2 then 'First Deposit' else 'Other' end as event_type,
       l_extendedprice * (1 - l_discount) as sale_amount,
       concat(cast(cast(l_shipdate as date) as string), ' 00:00:00') as transaction_date,
       substring(cast(cast(l_shipdate as date) as string), 1, 7) as transaction_month_prt,
       case l_linenumber % 3 when 0 then concat(cast(cast(l_shipdate as date) as string), 'T06:00:00')
            when 1 then concat(cast(cast(l_shipdate as date) as string), ' 18:30:00')
            else concat(cast(cast(l_shipdate as date) as string), 'T06:00:00+0000') end as created_at,
       concat(cast(cast(l_shipdate as date) as string), ' 12:00:00') as action_time
from lineitem
""",
    "fx_funnel": """
select cast(o_orderkey as string) as cid,
       concat('v', cast(o_custkey as string)) as visit_iid,
       concat('c', cast(o_orderkey as string)) as channel_click_id,
       cast(o_custkey % 5 as int) as partner_id,
       cast(o_custkey % 3 as int) as product_id,
       case when o_custkey % 2 = 0 then 'vF' else 'vO' end as vertical_id,
       case when o_orderkey % 10 = 0 then 'bots' else 'users' end as traffic_type,
       cast(o_orderdate as date) as conversion_date,
       o_orderdate as conversion_timestamp,
       cast(o_orderdate as date) as clickout_date,
       o_orderdate as clickout_timestamp,
       substring(cast(cast(o_orderdate as date) as string), 1, 7) as dt,
       o_orderpriority as company,
       cast(case when o_orderkey % 13 = 0 then 0 when o_orderkey % 50 = 0 then 2 else 1 end as int) as leads_count,
       cast(case when o_orderstatus in ('F', 'P') then 1 else 0 end as int) as qualified_leads_count,
       cast(case when o_orderstatus = 'F' then 1 else 0 end as int) as sales_count
from orders
""",
    "fx_predictions": """
select concat('c', cast(o_orderkey as string)) as channel_click_id,
       concat('v', cast(o_custkey as string)) as visit_iid,
       case when o_orderkey % 17 = 0 then null else cast(o_orderkey as string) end as cid,
       cast(o_custkey % 3 as int) as product_id,
       case when o_custkey % 2 = 0 then 'vF' else 'vO' end as vertical_id,
       c_mktsegment as product_name,
       o_orderpriority as company,
       case when o_orderkey % 4 = 0 then null else concat('C', cast(c_nationkey as string)) end as channel_country_code,
       concat('N', cast(c_nationkey as string)) as country_code,
       case o_orderkey % 5 when 0 then 'g' when 1 then 'o' when 2 then 's' when 3 then null else 'y' end as network,
       o_orderdate as visit_timestamp,
       case when o_orderkey % 19 = 0 then null else o_orderdate + (o_orderkey % 90) * interval '1' second end as clickout_timestamp,
       cast(cast(o_orderdate as date) as string) as clickout_date_prt,
       cast(o_custkey % 100 as double) / 100 as normalized_p_cr_lead,
       cast(o_orderkey % 37 as double) / 100 as normalized_p_cr_sale,
       case when o_orderkey % 23 = 0 then null else cast(o_orderkey % 31 as double) / 50 end as p_cr_sale,
       o_totalprice / 1000 as predicted_commission,
       cast(case when o_orderkey % 13 = 0 then 0 when o_orderkey % 50 = 0 then 2 else 1 end as int) as leads_count,
       cast(case when o_orderstatus = 'F' then 1 else 0 end as int) as sales_count
from orders join customer on o_custkey = c_custkey
""",
    "fx_scored": """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string), '-', cast(l_suppkey as string)) as row_key,
       cast(case when l_returnflag = 'R' then 1 else 0 end as int) as y,
       cast(cast(floor(l_extendedprice) as bigint) % 1000 as double) / 1000 as p,
       l_discount * 10 as p_tied,
       l_linenumber as leads,
       cast(l_shipdate as date) as d
from lineitem
""",
}


def with_fixtures(sql: str, views=("fx_attribute", "fx_funnel", "fx_predictions", "fx_scored")) -> str:
    """Prefix a query with the fixture views as CTEs (the query may add more CTEs after a comma)."""
    ctes = ",\n".join(f"{v} as (\n{FIXTURE_SQL[v]}\n)" for v in views)
    sql = sql.strip()
    if sql.lower().startswith("with "):
        return f"with {ctes},\n{sql[5:]}"
    return f"with {ctes}\n{sql}"
