"""Registered queries of the small operators: filters, projections, joins, splits, and the inputs on
which a careless version goes wrong (rare classes, integer medians, NaN scores, odd number texts).

Imported at the end of ``registry``, whose fixtures and SQL prefixes it uses.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from enrichlab.functions import scalars as S
from enrichlab.operators import aggregates as A
from enrichlab.operators import features as FE
from enrichlab.operators import filters as FL
from enrichlab.operators import joins as J
from enrichlab.operators import metrics as M
from enrichlab.operators import models as MD
from enrichlab.operators import validate as V
from enrichlab.operators import windows as W
from enrichlab.plans.registry import _SQL_KNOWN, _r6, fx_attribute, fx_funnel, fx_predictions, fx_scored, lead_frame, lead_sql, register


def follow(select: str) -> str:
    """``lead_sql`` with further CTEs after the frame's."""
    return lead_sql(select).replace("leads_count >= 1)\n,", "leads_count >= 1),")


# ------------------------------------------------------------------ filters and projections


@register("filters_chained", """
select process_name, count(*) as rows, count(distinct subid) as ids, min(transaction_month_prt) as first_month
from fx_attribute where process_name in ('lead', 'sale') and transaction_month_prt >= '1995-03' group by process_name""")
def q_filters_chained(spark, sf):
    x = FL.filter_partition_ge(FL.filter_in_list(fx_attribute(spark, sf), "process_name", ["lead", "sale"]), "transaction_month_prt", "1995-03")
    return x.groupBy("process_name").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("subid").alias("ids"), F.min("transaction_month_prt").alias("first_month"))


@register("filter_date_between", """
select clickout_date, count(*) as clicks, cast(sum(sales_count) as bigint) as sales from fx_funnel
where clickout_date >= date '1994-02-01' and clickout_date <= date '1996-05-31' group by clickout_date""")
def q_filter_date_between(spark, sf):
    x = FL.filter_date_between(fx_funnel(spark, sf), "clickout_date", "1994-02-01", "1996-05-31")
    return x.groupBy("clickout_date").agg(F.count(F.lit(1)).alias("clicks"), F.sum("sales_count").cast("bigint").alias("sales"))


_GAPS = ["age_of_business_months", "business_legal_structure", "industry"]


@register("drop_all_null_rows", lead_sql(f"""
select network, count(*) as rows, cast(sum(sales_count) as bigint) as sales from leads_frame
where coalesce(cast({_GAPS[0]} as varchar), {_GAPS[1]}, {_GAPS[2]}) is not null group by network"""))
def q_drop_all_null_rows(spark, sf):
    return FL.drop_all_null_rows(lead_frame(spark, sf), _GAPS).groupBy("network").agg(F.count(F.lit(1)).alias("rows"), F.sum("sales_count").cast("bigint").alias("sales"))


@register("drop_null_rows", lead_sql(f"""
select network, count(*) as rows, cast(sum(sales_count) as bigint) as sales from leads_frame
where {' and '.join(f'{c} is not null' for c in _GAPS)} group by network"""))
def q_drop_null_rows(spark, sf):
    return FL.drop_null_rows(lead_frame(spark, sf), _GAPS).groupBy("network").agg(F.count(F.lit(1)).alias("rows"), F.sum("sales_count").cast("bigint").alias("sales"))


@register("drop_high_null_columns", """
select subid, rn, creditscore, loanamount from fx_attribute where process_name = 'lead'""")
def q_drop_high_null_columns(spark, sf):
    """``funded_amount`` has values in sale rows only: all null here, so the rule drops it."""
    x = FL.filter_equals(fx_attribute(spark, sf), "process_name", "lead").select("subid", "rn", "creditscore", "loanamount", "funded_amount")
    return FL.drop_high_null_columns(x, 60.0)[0]


@register("projections", lead_sql("""
select channel_click_id as click, leads_count, sales_count, coalesce(industry, 'none') as industry,
       coalesce(p_cr_sale, 0.0) as p_cr_sale, product_name || '_' || network as product_network,
       cast(normalized_p_cr_sale >= 0.2 as integer) as likely
from leads_frame"""))
def q_projections(spark, sf):
    x = lead_frame(spark, sf).select("channel_click_id", "leads_count", "sales_count", "industry", "p_cr_sale", "product_name", "network", "normalized_p_cr_sale", "visit_iid")
    x = FL.fill_zero(FL.null_to_label(FL.drop_existing(x, ["visit_iid", "no_such_column"]), {"industry": "none"}), ["p_cr_sale"])
    x = FL.label_threshold(x.withColumn("product_network", S.concat_columns("product_name", "network")), "normalized_p_cr_sale", 0.2, "likely")
    return FL.drop_existing(FL.rename_column(x, {"channel_click_id": "click"}), ["product_name", "network", "normalized_p_cr_sale"])


@register("select_numeric", lead_sql("""
select normalized_p_cr_lead, normalized_p_cr_sale, p_cr_sale, round(predicted_commission, 6) as predicted_commission, leads_count,
       sales_count, time_to_clickout_s, age_of_business_months, application_annual_revenue from leads_frame"""))
def q_select_numeric(spark, sf):
    return _r6(FL.select_numeric(lead_frame(spark, sf)), ["predicted_commission"])


@register("numeric_only_step", lead_sql("select leads_count, sales_count from leads_frame"))
def q_numeric_only_step(spark, sf):
    return FE.NumericOnly().transform(lead_frame(spark, sf).select("network", "leads_count", "sales_count"))


@register("coerce_timestamp_utc", """
select subid, rn, strftime(case rn % 3 when 0 then strptime(created_at, '%Y-%m-%dT%H:%M:%S') when 1 then strptime(created_at, '%Y-%m-%d %H:%M:%S')
              else strptime(left(created_at, 19), '%Y-%m-%dT%H:%M:%S') end, '%Y-%m-%d %H:%M:%S') as created from fx_attribute""")
def q_coerce_timestamp_utc(spark, sf):
    x = FL.coerce_timestamp_utc(fx_attribute(spark, sf).select("subid", "rn", "created_at"), ["created_at"])
    return x.select("subid", "rn", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created"))


@register("coerce_numeric_texts", """
with t as (select l_orderkey as k, l_linenumber as n, case l_linenumber % 7 when 0 then cast(l_partkey as varchar) || 'd' when 1 then cast(l_partkey as varchar)
                  when 2 then ' ' || cast(l_partkey as varchar) || '.5 ' when 3 then '0x1p3' when 4 then '-1e3' when 5 then 'n/a' else '.25' end as v,
                  l_partkey as p from lineitem)
select k, n, case n % 7 when 1 then p when 2 then p + 0.5 when 4 then -1000 when 6 then 0.25 end::double as v from t""")
def q_coerce_numeric_texts(spark, sf):
    from enrichlab.sources.tables import read_table

    part, n = F.col("l_partkey").cast("string"), F.col("l_linenumber") % 7
    text = F.when(n == 0, F.concat(part, F.lit("d"))).when(n == 1, part).when(n == 2, F.concat(F.lit(" "), part, F.lit(".5 ")))
    text = text.when(n == 3, "0x1p3").when(n == 4, "-1e3").when(n == 5, "n/a").otherwise(".25")
    x = read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), text.alias("v"))
    return FL.coerce_numeric(x, ["v"])


@register("hours_and_sigmoid", """
select hour(cast(left(created_at, 19) as timestamp)) as hour, count(*) as rows,
       round(sum(1 / (1 + exp(-rn::double))), 6) as pull from fx_attribute group by 1""")
def q_hours_and_sigmoid(spark, sf):
    x = fx_attribute(spark, sf).select(S.hour_of_day(S.coerce_timestamp_utc("created_at")).alias("hour"), S.sigmoid(F.col("rn").cast("double")).alias("s"))
    return _r6(x.groupBy("hour").agg(F.count(F.lit(1)).alias("rows"), F.sum("s").alias("pull")))


# ------------------------------------------------------------------ joins and windows

_CLICK = [("channel_click_id", "click"), ("visit_iid", "visit")]


def _clicks(spark, sf):
    return fx_funnel(spark, sf).filter("qualified_leads_count = 1").select(
        F.col("channel_click_id").alias("click"), F.col("visit_iid").alias("visit"), F.col("sales_count").alias("funnel_sales"))


for _how, _join in (("left", J.join_left_2key), ("inner", J.join_inner_2key)):

    @register(f"join_{_how}_2key", f"""
    select network, count(*) as rows, count(funnel_sales) as met, cast(sum(funnel_sales) as bigint) as sales
    from fx_predictions p {_how} join (select channel_click_id as click, visit_iid as visit, sales_count as funnel_sales from fx_funnel
         where qualified_leads_count = 1) c on p.channel_click_id = c.click and p.visit_iid = c.visit group by network""")
    def _q(spark, sf, join=_join):
        x = join(fx_predictions(spark, sf), _clicks(spark, sf), _CLICK)
        return x.groupBy("network").agg(F.count(F.lit(1)).alias("rows"), F.count("funnel_sales").alias("met"), F.sum("funnel_sales").cast("bigint").alias("sales"))


@register("join_many_outer_reduce", """
select dt, cast(sum(leads_count) as bigint) as leads, cast(sum(sales_count) as bigint) as sales, count(distinct company) as companies
from fx_funnel group by dt""")
def q_join_many_outer_reduce(spark, sf):
    return J.join_many_outer_reduce(fx_funnel(spark, sf), "dt", [
        F.sum("leads_count").cast("bigint").alias("leads"), F.sum("sales_count").cast("bigint").alias("sales"), F.count_distinct("company").alias("companies")])


@register("join_self_lookup_by_index", "select row_key, p, leads, d from fx_scored where y = 1")
def q_join_self_lookup_by_index(spark, sf):
    full = fx_scored(spark, sf)
    return J.join_self_lookup_by_index(full.filter("y = 1").select("row_key", "p"), full, "row_key", ["leads", "d", "p"])


@register("min_version_over_subid", "select subid, rn, process_name, min(rn) over (partition by subid) as min_rn from fx_attribute")
def q_min_version_over_subid(spark, sf):
    return W.min_version_over_subid(fx_attribute(spark, sf).select("subid", "rn", "process_name"))


@register("latest_attribute_rank", """
select subid, rn, transaction_date, cast(row_number() over (partition by subid order by transaction_date desc nulls last, rn desc) as integer) as rnn
from fx_attribute""")
def q_latest_attribute_rank(spark, sf):
    return W.latest_attribute_rank(fx_attribute(spark, sf).select("subid", "rn", "transaction_date"), tiebreak=("rn",))


@register("rank_models", lead_sql("""
select network as model, round(avg(normalized_p_cr_sale), 6) as score from leads_frame where network is not null group by network"""))
def q_rank_models(spark, sf):
    x = lead_frame(spark, sf).filter("network is not null").groupBy(F.col("network").alias("model")).agg(F.avg("normalized_p_cr_sale").alias("score"))
    return _r6(W.rank_models(x, "score", ascending=False))


@register("get_best_model", lead_sql("""
select network as model, round(avg(normalized_p_cr_sale), 6) as rmse from leads_frame where network is not null
group by network order by avg(normalized_p_cr_sale), network limit 1"""))
def q_get_best_model(spark, sf):
    x = lead_frame(spark, sf).filter("network is not null").groupBy(F.col("network").alias("model")).agg(F.avg("normalized_p_cr_sale").alias("rmse"))
    return _r6(V.get_best_model(x, "rmse"))


# ------------------------------------------------------------------ feature steps

_RANKS = {"Very_Low": "Very Low", "Low": "Low", "Medium": "Medium", "High": "High", "Very_High": "Very High"}


@register("user_rank_steps", lead_sql("select 'kept' as step, 0 as flags, count(*) as rows from leads_frame union all select 'dropped', 0, count(*) from leads_frame union all "
                                      "select 'only', cast(sum(cast(users_prob_sale in ('Very Low', 'Low', 'Medium', 'High', 'Very High') as integer)) as integer), count(*) from leads_frame"))
def q_user_rank_steps(spark, sf):
    """The rank flags alone (one set per known rank), and the frame without them."""
    lf = lead_frame(spark, sf)
    only = FE.UserRankOnly().transform(lf)
    flags = F.sum(sum((F.col(c) for c in FE.USER_RANK_COLUMNS[1:]), F.col(FE.USER_RANK_COLUMNS[0]))).cast("int")
    left = FE.DropUserRank().transform(lf.withColumns({c: F.lit(1) for c in FE.USER_RANK_COLUMNS}))
    still = len([c for c in left.columns if c in FE.USER_RANK_COLUMNS])
    return (only.agg(F.lit("only").alias("step"), flags.alias("flags"), F.count(F.lit(1)).alias("rows"))
            .unionByName(left.agg(F.lit("dropped").alias("step"), F.lit(still).alias("flags"), F.count(F.lit(1)).alias("rows")))
            .unionByName(lf.agg(F.lit("kept").alias("step"), F.lit(0).alias("flags"), F.count(F.lit(1)).alias("rows"))))


_FILL_SQL = """
, m as (select median(age_of_business_months) as age, avg(time_to_clickout_s) as gap, median(sales_count + 2 * (leads_count % 2)) as odd from leads_frame)
select channel_click_id, visit_iid, product_name, round(coalesce(age_of_business_months, m.age), 6) as age_of_business_months,
       round(coalesce(time_to_clickout_s::double, m.gap), 6) as time_to_clickout_s, coalesce(business_legal_structure, 'Unknown') as business_legal_structure
from leads_frame, m where industry is not null"""


@register("null_strategy", follow(_FILL_SQL))
def q_null_strategy(spark, sf):
    """Median, mean of an integer column (fractional: the column becomes a double), label, dropped rows, dropped column."""
    x = lead_frame(spark, sf).select("channel_click_id", "visit_iid", "product_name", "age_of_business_months", "time_to_clickout_s", "business_legal_structure", "industry", "network")
    out = FE.NullStrategy({"age_of_business_months": "median", "time_to_clickout_s": "mean", "business_legal_structure": "unknown",
                           "industry": "drop_rows", "network": "drop_columns", "absent": "median"}).fit(x).transform(x)
    return _r6(out.drop("industry"))


@register("median_fill_integers", """
with x as (select o_orderkey as k, case when o_orderkey % 3 = 0 then null else o_custkey % 10 + (o_custkey % 2) * 1 end as v from orders)
select k, coalesce(v::double, (select median(v) from x)) as v from x""")
def q_median_fill_integers(spark, sf):
    from enrichlab.sources.tables import read_table

    ck = F.col("o_custkey")
    x = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 3 != 0, (ck % 10 + ck % 2).cast("int")).alias("v"))
    return FE.MedianFillBasic(["v"]).fit(x).transform(x).withColumn("v", F.col("v").cast("double"))


@register("targets_by_hand", lead_sql("""
select channel_click_id, visit_iid, product_name, round(ln(1 + predicted_commission), 6) as log_predicted_commission,
       round(predicted_commission / (sales_count + 1e-6), 6) as avg_deposit_per_sale from leads_frame"""))
def q_targets_by_hand(spark, sf):
    x = FE.log_target(lead_frame(spark, sf), "predicted_commission")
    x = FE.avg_deposit_per_sale(x, "predicted_commission", "sales_count")
    return _r6(x.select("channel_click_id", "visit_iid", "product_name", "log_predicted_commission", "avg_deposit_per_sale"))


_SCALED_SQL = """
, x as (select channel_click_id, visit_iid, product_name, {fill} as v from leads_frame),
q as (select quantile_cont(v, 0.25) as lo, quantile_cont(v, 0.5) as mid, quantile_cont(v, 0.75) as hi from x)
select channel_click_id, visit_iid, product_name, round(coalesce((v - mid) / coalesce(nullif(hi - lo, 0), 1), -9.0), 6) as v from x, q"""

for _name, _fill in (("median", "coalesce(age_of_business_months, (select median(age_of_business_months) from leads_frame))"),
                     ("mean", "coalesce(age_of_business_months, (select avg(age_of_business_months) from leads_frame))"),
                     ("constant", "coalesce(age_of_business_months, 7.0)"), ("none", "age_of_business_months")):

    @register(f"impute_and_scale_{_name}", follow(_SCALED_SQL.format(fill=_fill)))
    def _q(spark, sf, how=_name):
        keys = ["channel_click_id", "visit_iid", "product_name"]
        x = lead_frame(spark, sf).select(*keys, "age_of_business_months")
        out = FE.ImputeAndScale(["age_of_business_months"], how, 7.0).fit(x).transform(x)
        return _r6(out.select(*keys, F.col("age_of_business_months__scaled").alias("v")))


# ------------------------------------------------------------------ splits and metrics


@register("split_by_ratio_stratified", """
select y, count(*) as rows, cast(floor(count(*) * 0.2 + 0.5) as bigint) as test_rows
from (select case when l_orderkey % 500 = 0 then 1 else 0 end as y from lineitem) group by y""")
def q_split_by_ratio_stratified(spark, sf):
    """A rare class keeps its share."""
    x = fx_scored(spark, sf).select("row_key", (F.split("row_key", "-")[0].cast("bigint") % 500 == 0).cast("int").alias("y"))
    tr, te = V.split_by_ratio(x, "row_key", 0.2, stratify="y")
    both = tr.select("y", F.lit(0).alias("t")).unionByName(te.select("y", F.lit(1).alias("t")))
    return both.groupBy("y").agg(F.count(F.lit(1)).alias("rows"), F.sum("t").cast("bigint").alias("test_rows"))


_NAN_SQL = """
with v as (select y, p from fx_scored where leads <> 3),
c as (select p, sum(y) as pos, count(*) - sum(y) as neg from v group by p),
r as (select *, sum(neg) over (order by p) - neg as below from c)
select round((select sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) from r), 6) as roc_auc,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) as r2, round(sqrt(avg((y - p) * (y - p))), 6) as rmse,
       round(-avg(y * ln(least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
                  + (1 - y) * ln(1 - least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16))), 6) as log_loss
from v"""


@register("metrics_skip_nan_scores", _NAN_SQL)
def q_metrics_skip_nan_scores(spark, sf):
    """Scores that are NaN (those of every third line here) count as missing in every metric."""
    x = fx_scored(spark, sf).withColumn("p", F.when(F.col("leads") == 3, F.lit(float("nan"))).otherwise(F.col("p"))).select("y", "p").persist()
    r = M.regression_errors(x).select("r2", "rmse").crossJoin(M.log_loss(x))
    return _r6(r.select(M.roc_auc(x).scalar().alias("roc_auc"), "r2", "rmse", "log_loss"))


@register("score_table_by_leads", """
with o as (select row_key, y, p, leads::double as leads from fx_scored where leads > 0),
n as (select *, row_number() over (order by p, row_key) - 1 as i, sum(leads) over (order by p, row_key) - leads as before, (select sum(leads) from o) / 10 as lpb from o),
t as (select *, floor(before / lpb) - i as d from n),
b as (select *, least(9, i + min(d) over (order by p, row_key)) as bin from t),
g as (select bin, sum(leads) as leads, avg(p) as mp, avg(y / leads) as ma from b group by bin)
select 'fixture' as model, round(sum(leads * abs(mp - ma)) / sum(leads), 6) as ece from g""")
def q_score_table_by_leads(spark, sf):
    return _r6(M.score_table({"fixture": fx_scored(spark, sf)}, leads="leads", row_key="row_key").select("model", "ece"))


@register("soft_voting")
def q_soft_voting(spark, sf):
    """Average probability of the two fitted classifiers, per network."""
    from enrichlab.plans.registry import model_frame

    mf = model_frame(spark, sf)
    prep = Pipeline(stages=FE.auto_preprocessor(["normalized_p_cr_sale", "normalized_p_cr_lead"], ["network"])).fit(mf)
    x = prep.transform(mf)
    n = x.count()
    v = MD.soft_voting(x, [MD.logistic(n=n, labelCol="label").fit(x), MD.random_forest(labelCol="label").fit(x)])
    return _r6(v.groupBy("network").agg(F.avg("p").alias("p"), F.count(F.lit(1)).alias("rows")))


@register("l2s_buckets_check", lead_sql("""
select network, round(sum(sales_count) / nullif(sum(leads_count), 0), 6) as l2s, cast(sum(leads_count) as bigint) as leads,
       cast(sum(sales_count) as bigint) as sales from leads_frame where network is not null group by network"""))
def q_l2s_buckets_check(spark, sf):
    return _r6(A.l2s_by_dimension(lead_frame(spark, sf), "network"))


@register("score_distribution", "select count(p) as rows, min(p) as min, max(p) as max, count(distinct p) as distinct from fx_scored")
def q_score_distribution(spark, sf):
    return M.score_distribution(fx_scored(spark, sf))


@register("ece_bin_table_constant_score", "select 2 as bin, 0.25 as mean_pred, count(*) as count, round(avg(y), 6) as mean_true from fx_scored")
def q_ece_bin_table_constant_score(spark, sf):
    return _r6(M.ece_bin_table(fx_scored(spark, sf).withColumn("p", F.lit(0.25)), fallback=True))


@register("first_version_per_visit", "with " + _SQL_KNOWN + "select visit, click, business_legal_structure, age_of_business_months, industry from known")
def q_first_version_per_visit(spark, sf):
    """The rows of each visit's lowest revision by the window-style operators (the extract reaches the
    same rows by aggregates alone)."""
    attrs = {"business_legal_structure": "customer_status", "age_of_business_months": "age_group", "industry": "sku"}
    f = fx_funnel(spark, sf).select("cid", F.col("visit_iid").alias("visit"), F.col("channel_click_id").alias("click"))
    placed = fx_attribute(spark, sf).join(f, F.col("subid") == F.col("cid"))
    by_version = A.agg_attribute_by_version(placed, ["visit", "click", "rn"], attrs)
    low = W.min_version_over_visit(by_version, "visit", "rn", "min_rn")
    return A.agg_first_version(low, "rn", "min_rn", ["visit", "click"], list(attrs))
