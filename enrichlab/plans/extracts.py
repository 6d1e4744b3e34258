"""End-to-end extracts: each is one lazy DataFrame plan over the three roles.

Shape kept from the workload: every join has one side made unique per key by an aggregate
first, so fan-out is bounded; aggregates sit *below* joins (Catalyst does not push them).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from enrichlab.functions import scalars as S
from enrichlab.operators import aggregates as A
from enrichlab.operators import joins as J
from enrichlab.operators import windows as W
from enrichlab.sources.scans import ExtractParams, scan_attribute, scan_funnel, scan_predictions

# Attribute attributes of the main extract: output name -> attribute column.
ENRICH_ATTRS = {
    "business_legal_structure": "customer_status",
    "age_of_business_months": "age_group",
    "application_annual_revenue": "net_revenue",
    "loan_purpose": "loanpurpose",
    "industry": "sku",
    "sub_industry": "os",
    "users_prob_sale": "user_rank",
}

# Prediction dedup: which columns are kept, by the aggregate; other column lists are arguments.
PRED_MAX = {
    "company": "company",
    "country_code": ("channel_country_code", "country_code"),
    "normalized_p_cr_lead": "normalized_p_cr_lead",
    "normalized_p_cr_sale": "normalized_p_cr_sale",
    "p_cr_sale": "p_cr_sale",
    "predicted_commission": "predicted_commission",
    "leads_count": "leads_count",
    "sales_count": "sales_count",
}
PRED_MIN = {c: c for c in ("visit_timestamp", "clickout_timestamp", "clickout_date_prt")}


def _present(df: DataFrame, mapping: dict) -> dict:
    """Keep entries whose source exists; a tuple source is ``coalesce`` of its present columns."""
    cols = set(df.columns)
    out = {}
    for k, v in mapping.items():
        if isinstance(v, str):
            if v in cols:
                out[k] = v
        else:
            have = [c for c in v if c in cols]
            if have:
                out[k] = S.alias_coalesce(*have) if len(have) > 1 else F.col(have[0])
    return out


def prediction_dedup(pred: DataFrame, with_time_bucket: bool = True, max_of: Mapping = PRED_MAX,
                     min_of: Mapping = PRED_MIN) -> DataFrame:
    """Predictions deduplicated to one row per (click, visit, product, company, source country):
    ``max`` of attributes / scores / counts, ``min`` of times, the network default ``'x'`` and
    the whole-seconds visit->click gap with its bucket."""
    maxes = _present(pred, max_of)
    if "network" in pred.columns:
        maxes["network"] = F.coalesce(F.col("network"), F.lit("x"))
    mins = _present(pred, min_of)
    if with_time_bucket and {"visit_timestamp", "clickout_timestamp"} <= set(pred.columns):
        maxes["time_to_clickout_s"] = S.date_diff_seconds("visit_timestamp", "clickout_timestamp")
    keys = [k for k in ("channel_click_id", "visit_iid", "product_name", "company", "country_code") if k in pred.columns]
    # group on the source columns; 'company' / 'country_code' outputs are the aggregates
    tmp = {k: f"__g_{k}" for k in ("company", "country_code") if k in keys}
    src = pred.withColumns({v: F.col(k) for k, v in tmp.items()})
    g = A.agg_max_dedup(src, [tmp.get(k, k) for k in keys], maxes, mins).drop(*tmp.values())
    if "time_to_clickout_s" in g.columns:
        g = g.withColumn("time_to_clickout_s_group", S.case_time_bucket("time_to_clickout_s"))
    return g


def attribute_first_version(enrich: DataFrame, funnel: DataFrame, p: ExtractParams) -> DataFrame:
    """Attribute rows joined to the funnel (LEFT JOIN + WHERE on funnel columns = inner); per
    (visit, click) the maxima of the rows with the visit's lowest revision.

    A row at the visit's lowest revision is always at its id's lowest, so each id keeps the maxima of
    that revision before the join: wide rows move once by id, once by visit and once by click.  The
    rows are dealt by id before that aggregate: maxima of strings are combined by sorting, and in a
    scan's task that would sort (and spill) the whole split for nothing where an id's revisions are apart.
    The lowest revision per visit comes from narrow rows, combined by hash in each task."""
    e = scan_attribute(enrich, p.partner_ids, p.process_names, p.month_from, p.vertical_ids)
    c = funnel.select(
        F.col("cid"), F.col("visit_iid").alias("en_visit_iid"),
        F.col("channel_click_id").alias("en_channel_click_id"),
        F.col("vertical_id").alias("c_vertical_id"), F.col("product_id").alias("c_product_id"),
    )
    pred_c = F.lit(True)
    if p.vertical_ids is not None:
        pred_c = pred_c & F.col("c_vertical_id").isin(list(p.vertical_ids))
    if p.product_ids is not None:
        pred_c = pred_c & F.col("c_product_id").isin(list(p.product_ids))
    attrs = {k: v for k, v in ENRICH_ATTRS.items() if v in e.columns}
    e = e.filter(F.col("rn").isNotNull())  # no lowest revision
    lows = e.groupBy("subid").agg(F.min("rn").alias("rn"))
    lows = J.join_left_then_filter_right(lows, c, [("subid", "cid")], pred_c)
    low = lows.groupBy(F.col("en_visit_iid").alias("low_visit")).agg(F.min("rn").alias("low_rn"))
    # the greatest (falling revision, value) holds the greatest value of the lowest revision
    falling = F.bitwise_not("rn") if isinstance(e.schema["rn"].dataType, IntegralType) else -F.col("rn")
    by_id = e.repartition("subid").groupBy("subid").agg(
        F.min("rn").alias("rn"), *[F.max(F.struct(falling, F.col(v).alias("v")))["v"].alias(k) for k, v in attrs.items()])
    j = J.join_left_then_filter_right(by_id, c, [("subid", "cid")], pred_c)
    kept = j.join(low, F.col("en_visit_iid").eqNullSafe(F.col("low_visit")) & (F.col("rn") == F.col("low_rn")))
    kept = kept.select("en_visit_iid", "en_channel_click_id", *attrs).repartition("en_channel_click_id", "en_visit_iid")
    return kept.groupBy("en_visit_iid", "en_channel_click_id").agg(*[F.max(a).alias(a) for a in attrs])


def lead_attribute_frame(
    enrich: DataFrame, funnel: DataFrame, pred: DataFrame, p: ExtractParams, min_leads: int | None = None
) -> DataFrame:
    """The modelling frame: deduplicated predictions LEFT JOIN first-version attribute on
    (click, visit), DISTINCT.  ``min_leads`` applies the loader's ``leads_count >= n``.

    Predictions are dealt by (click, visit) once: their maxima, the DISTINCT and the join all run there.
    The attribute side has one row per (click, visit), so the DISTINCT may go below the join."""
    ps = scan_predictions(pred, p.product_ids, p.vertical_ids, p.click_from)
    pd_ = W.distinct_rows(prediction_dedup(ps.repartition("channel_click_id", "visit_iid")))
    en = attribute_first_version(enrich, funnel, p)
    j = pd_.join(
        en,
        (pd_["channel_click_id"] == en["en_channel_click_id"]) & (pd_["visit_iid"] == en["en_visit_iid"]),
        "left",
    ).select(*pd_.columns, *[c for c in ENRICH_ATTRS if c in en.columns])
    from enrichlab.operators.filters import filter_min_leads

    return filter_min_leads(j, "leads_count", min_leads) if min_leads is not None else j


# ---------------------------------------------------------------- deposits


def deposit_frame(
    enrich: DataFrame,
    funnel: DataFrame,
    pred: DataFrame,
    p: ExtractParams,
    deposit_pred: Column | None = None,
    enrich_filter: Column | None = None,
) -> DataFrame:
    """Per (partner, visit, click): first-deposit amount (conditional sum) and distinct
    depositing ids (conditional count distinct), HAVING sum(amount) > 0; joined to predictions
    grouped on many dimensions (with the latest-click rank per visit); sales > 0 and
    deposits > 0."""
    if deposit_pred is None:
        parts = [F.col(c) == "First Deposit" for c in ("campaign_name", "event_type") if c in enrich.columns]
        deposit_pred = parts[0]
        for x in parts[1:]:
            deposit_pred = deposit_pred | x
    e = scan_attribute(enrich, None, None, p.month_from, p.vertical_ids).filter(F.col("rn") == 1)
    if enrich_filter is not None:
        e = e.filter(enrich_filter)
    c = funnel.select("cid", "visit_iid", "channel_click_id", F.col("vertical_id").alias("c_vertical_id"),
                      F.col("product_id").alias("c_product_id"))
    pc = F.lit(True)
    if p.vertical_ids is not None:
        pc = pc & F.col("c_vertical_id").isin(list(p.vertical_ids))
    if p.product_ids is not None:
        pc = pc & F.col("c_product_id").isin(list(p.product_ids))
    j = J.join_left_then_filter_right(e, c, [("subid", "cid")], pc)
    en = (
        j.groupBy(F.col("partner_id").alias("en_partner_id"), F.col("visit_iid").alias("e_visit_iid"),
                  F.col("channel_click_id").alias("e_channel_click_id"))
        .agg(
            F.sum(F.when(deposit_pred, F.col("sale_amount"))).alias("first_deposit_amount"),
            F.countDistinct(F.when(deposit_pred, F.col("subid"))).alias("first_deposit_counts"),
            F.sum("sale_amount").alias("__total_amount"),
        )
        .filter(F.col("__total_amount") > 0)
        .drop("__total_amount")
    )
    ps = scan_predictions(pred, p.product_ids, p.vertical_ids, p.click_from, require_cid=False)
    ps = ps.withColumn("country_code", F.coalesce("channel_country_code", "country_code"))
    dims = [d for d in ("channel_click_id", "visit_iid", "product_name", "company", "country_code", "clickout_timestamp")
            if d in ps.columns]
    # the rank runs over all rows of a visit, but only visits with deposits can stay: the others go first
    ps = ps.join(en.select(F.col("e_visit_iid").alias("visit_iid")).distinct(), "visit_iid", "left_semi")
    many = A.agg_group_by_many_dims(
        ps, dims,
        max_cols=["normalized_p_cr_lead", "normalized_p_cr_sale", "predicted_commission", "leads_count", "sales_count"],
        min_cols=["clickout_date_prt", "visit_timestamp"],
    )
    many = W.latest_click_rank(many, "visit_iid", "clickout_timestamp",
                               tiebreak=[d for d in dims if d not in ("visit_iid", "clickout_timestamp")], out="rn")
    out = many.join(en, (many["channel_click_id"] == en["e_channel_click_id"]) & (many["visit_iid"] == en["e_visit_iid"]),
                    "inner")
    return out.filter((F.col("sales_count") > 0) & (F.col("first_deposit_counts") > 0))


# ---------------------------------------------------------------- loan process (pivot)


def loan_process_frame(
    enrich: DataFrame,
    funnel: DataFrame,
    pred: DataFrame,
    p: ExtractParams,
    lead_process: str = "lead",
    allocated_process: str = "allocated",
    sale_process: str = "sale",
    purpose: str = "Refinance",
) -> DataFrame:
    """Per id: process flags / values / first dates (conditional pivot) over first versions of
    refinance leads + sale rows; LEFT JOIN a DISTINCT (visit, click, id) funnel map; inner
    3-key join to predictions grouped per (click, visit, id); ``leads_count >= 1``."""
    e = scan_attribute(enrich, None, None, p.month_from, None).filter(
        (F.col("rn") == 1)
        & (
            ((F.col("loanpurpose") == purpose) & F.col("process_name").isin(lead_process, allocated_process))
            | F.col("process_name").like(sale_process)
        )
    )
    e = e.filter(F.col("subid") != "-")
    pn = F.col("process_name")
    agg = e.groupBy("subid").agg(
        F.max(F.when(pn == lead_process, 1).otherwise(0)).alias("lead"),
        F.max(F.when(pn == allocated_process, 1).otherwise(0)).alias("allocated"),
        F.max(F.when(pn == sale_process, 1).otherwise(0)).alias("sale"),
        F.countDistinct(pn).alias("processes"),
        F.max(F.when(pn != sale_process, F.col("loanamount"))).alias("loan_amount"),
        F.max(F.when(pn != sale_process, F.col("creditscore"))).alias("credit_score"),
        F.max(F.when(pn == sale_process, F.col("funded_amount"))).alias("funded_amount"),
        F.min(F.when(pn == lead_process, F.col("transaction_date"))).alias("min_lead_date"),
        F.min(F.when(pn == allocated_process, F.col("transaction_date"))).alias("min_allocated_date"),
        F.min(F.when(pn == sale_process, F.col("transaction_date"))).alias("min_sale_date"),
        F.count(F.lit(1)).alias("rowss"),
    )
    fm = scan_funnel(funnel, vertical_ids=p.vertical_ids, product_ids=p.product_ids, click_from=p.click_from)
    idmap = fm.select(F.col("visit_iid").alias("en_visit_iid"), F.col("channel_click_id").alias("en_channel_click_id"),
                      F.col("cid").alias("map_cid"))
    en = J.join_left_map(agg, idmap, [("subid", "map_cid")]).drop("map_cid")
    ps = scan_predictions(pred, p.product_ids, p.vertical_ids, p.click_from, require_cid=False)
    pdx = ps.groupBy("channel_click_id", "visit_iid", "cid").agg(
        F.min("clickout_timestamp").alias("clickout_timestamp"),
        F.min("clickout_date_prt").alias("clickout_date_prt"),
        F.max("leads_count").alias("leads_count"),
    )
    out = J.join_inner_3key(pdx, en, [("channel_click_id", "en_channel_click_id"), ("visit_iid", "en_visit_iid"),
                                      ("cid", "subid")])
    return out.filter(F.col("leads_count") >= 1)


# ---------------------------------------------------------------- partner checks


def version_check(enrich: DataFrame, p: ExtractParams, max_cols: dict | None = None) -> DataFrame:
    """Query 1: ids and rows at each id's first revision number.

    Same answer as grouping revisions, ``min(rn) over (partition by subid)`` and filtering
    ``rn = min_rn``, but as a chain of partial aggregates (no window, no join): revision groups
    per (subid, rn), then per subid ``min(rn)`` with ``min_by(groups, rn)``, then per rn."""
    e = scan_attribute(enrich, p.partner_ids, p.process_names, p.month_from, p.vertical_ids)
    keys = [k for k in ("subid", "process_name", "partner_name", "rn", "transaction_month_prt", "company") if k in e.columns]
    groups = e.select(*keys).distinct()
    per_rn = groups.groupBy("subid", "rn").agg(F.count(F.lit(1)).alias("__groups"))
    first = per_rn.groupBy("subid").agg(F.min("rn").alias("rn"), F.min_by("__groups", "rn").alias("__groups"))
    return (
        first.groupBy("rn")
        .agg(F.count("subid").alias("cids"),
             F.coalesce(F.sum(F.when(F.col("subid").isNotNull(), F.col("__groups"))), F.lit(0)).cast("bigint").alias("rowss"))
        .orderBy(F.col("cids").desc(), F.col("rn"))
    )


def update_day_check(enrich: DataFrame, p: ExtractParams) -> DataFrame:
    """Query 2: distinct ids per attribute action day, newest first."""
    e = scan_attribute(enrich, p.partner_ids, p.process_names, p.month_from, p.vertical_ids)
    return A.daily_distinct_counts(e, "action_time", "subid", "action_day")


def creation_day_check(enrich: DataFrame, p: ExtractParams) -> DataFrame:
    """Query 3: distinct ids per creation day, newest first."""
    e = scan_attribute(enrich, p.partner_ids, p.process_names, p.month_from, p.vertical_ids)
    return A.daily_distinct_counts(e, "created_at", "subid", "creation_day")


def _funnel_sums(funnel: DataFrame, p: ExtractParams, keys: Sequence[str], tm: tuple[str, str], with_click_range: bool):
    f = scan_funnel(
        funnel, p.partner_ids, p.vertical_ids, tm[0], tm[1],
        p.click_from if with_click_range else None, p.click_to if with_click_range else None,
        p.traffic_type,
    )
    g = A.agg_sum_after_join(f, keys, {"leads": "leads_count", "qls": "qualified_leads_count", "sales": "sales_count"})
    return A.having(g, F.col("leads") >= 1)


def fill_lag_frame(
    enrich: DataFrame, funnel: DataFrame, p: ExtractParams, fields: Sequence[str] = ("creditscore", "loanamount"),
    purpose_filter: Column | None = None, space_format_fields: Sequence[str] = ("loanamount",),
) -> DataFrame:
    """Query 4: first-revision attribute rows (DISTINCT) joined to funnel sums on id and
    ``transaction_day >= conversion_date``; per (id, transaction_date, company): last click
    time and, per field, the first creation time among rows carrying that field, all truncated
    to milliseconds; then ``<field>_diff_hours`` = max(floor(hours after click), 0)."""
    tm = S.month_window(p.click_from, p.click_to, bump=True)
    e = scan_attribute(enrich, p.partner_ids, p.process_names, tm[0], p.vertical_ids, month_to=tm[1])
    if purpose_filter is not None:
        e = e.filter(purpose_filter)
    e = e.filter(F.col("rn") == 1)
    raw = e.select(
        "subid", "process_name", S.prefix_to_date("transaction_date").alias("transaction_day"),
        "transaction_date", "transaction_month_prt", "created_at", *fields, "rn",
    ).distinct()
    ff = _funnel_sums(funnel, p, ["cid", "conversion_date", "conversion_timestamp", "clickout_timestamp", "company"], tm, True)
    j = J.join_equi_range_inner(raw, ff, [("subid", "cid")], "transaction_day", "conversion_date")
    aggs = [F.date_trunc("MILLISECOND", F.max(F.col("clickout_timestamp").cast("timestamp"))).alias("clickout_ts")]
    for f in fields:
        parsed = S.parse_timestamp_flex(F.col("created_at"), with_space=f in space_format_fields)
        aggs.append(F.date_trunc("MILLISECOND", F.min(F.when(F.col(f).isNotNull(), parsed))).alias(f"{f}_ts"))
    aggs += [F.sum(c).cast("bigint").alias(c) for c in ("leads", "qls", "sales")]
    g = j.groupBy("subid", "transaction_date", "company").agg(*aggs)
    out = g.withColumns({f"{f}_diff_hours": S.hour_diff_floor0(f"{f}_ts", "clickout_ts") for f in fields})
    fmt = {"clickout_ts_mt": S.truncate_millis_format("clickout_ts")}
    fmt.update({f"{f}_time": S.truncate_millis_format(f"{f}_ts") for f in fields})
    return out.withColumns(fmt).drop("clickout_ts", *[f"{f}_ts" for f in fields])


def melt_hours(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Unpivot every ``*_diff_hours`` / ``*_hours`` column to (field_name upper-cased, hours)."""
    hour_cols = [c for c in df.columns if c.endswith("_diff_hours") or c.endswith("_hours")]
    long = df.unpivot(list(ids), hour_cols, "field_name", "hours")
    return long.withColumn("field_name", S.upper("field_name"))


def lag_percentiles(df: DataFrame, by: Sequence[str] = ("company", "field_name"), hours: str = "hours",
                    ps: Sequence[float] = (0.5, 0.8, 0.9), sales: str | None = "sales",
                    accuracy: int | None = None) -> DataFrame:
    """Per (company, field), null groups kept: mean, p50, p80, p90 hours (linear), and
    mean / sum of sales.  The percentiles are exact and distributed
    (``grouped_exact_quantiles``: no group's values in one task); ``accuracy`` switches to
    ``percentile_approx``."""
    from enrichlab.operators.binning import grouped_exact_quantiles

    names = {0.5: "median_hours", 0.8: "p80_hours", 0.9: "p90_hours"}
    pnames = [names.get(p, f"p{int(p * 100)}_hours") for p in ps]
    aggs = [F.avg(hours).alias("avg_hours")]
    if accuracy is not None:
        aggs.append(F.percentile_approx(hours, list(ps), accuracy).alias("__p"))
    if sales:
        aggs += [F.avg(sales).alias("avg_sales"), F.sum(sales).cast("bigint").alias("sum_sales")]
    g = df.groupBy(*by).agg(*aggs)
    if accuracy is not None:
        g = g.select(*by, "avg_hours", *[F.col("__p")[i].alias(n) for i, n in enumerate(pnames)],
                     *(["avg_sales", "sum_sales"] if sales else []))
    else:
        q = grouped_exact_quantiles(df, list(by), hours, list(ps), pnames)
        cond = None
        for b in by:
            e = g[b].eqNullSafe(q[b])
            cond = e if cond is None else cond & e
        g = g.join(q, cond, "left").select(*[g[b] for b in by], "avg_hours", *[q[n] for n in pnames],
                                            *(["avg_sales", "sum_sales"] if sales else []))
    return g.orderBy(*[F.col(b).asc_nulls_last() for b in by])


def field_fill_lag(enrich: DataFrame, funnel: DataFrame, p: ExtractParams, fields=("creditscore", "loanamount"),
                   purpose_filter: Column | None = None) -> DataFrame:
    """Query 4 -> hour lags -> Query 5 percentile table, one plan."""
    fr = fill_lag_frame(enrich, funnel, p, fields, purpose_filter)
    long = melt_hours(fr, ["subid", "company", "transaction_date", "clickout_ts_mt", "sales"])
    return lag_percentiles(long)


def general_analysis_frame(
    enrich: DataFrame, funnel: DataFrame, p: ExtractParams, fields: Sequence[str] = ("loanamount", "creditscore"),
    purpose_filter: Column | None = None,
) -> DataFrame:
    """Query 6: funnel sums LEFT JOIN the latest first-revision attribute row per id with
    ``transaction_day >= conversion_date`` (all in ON: the latest row or nulls, never an
    older one); sums per (id, company, transaction_date, clickout_date, fields)."""
    tm = S.month_window(p.click_from, p.click_to, bump=False)
    e = scan_attribute(enrich, p.partner_ids, p.process_names, tm[0], p.vertical_ids, month_to=tm[1])
    e = e.filter(F.col("rn") == 1)
    if purpose_filter is not None:
        e = e.filter(purpose_filter)
    rows = e.select("subid", "process_name", "transaction_date", S.prefix_to_date("transaction_date").alias("transaction_day"),
                    "transaction_month_prt", *fields)
    # the row ranked first by transaction_date desc (remaining columns break ties, desc)
    order = ["transaction_date", "transaction_day", "process_name", "transaction_month_prt", *fields]
    latest = W.latest_per_key(rows, "subid", order)
    ff = _funnel_sums(funnel, p, ["cid", "conversion_date", "conversion_timestamp", "clickout_date", "company"], tm, False)
    j = J.join_equi_range_left_latest(ff, latest, [("cid", "subid")], "conversion_date", "transaction_day")
    return j.groupBy(
        F.coalesce(F.col("cid"), F.col("subid")).alias("subid"), "company", "transaction_date", "clickout_date", *fields
    ).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("leads", "qls", "sales")])


def frames_reconcile(a: DataFrame, b: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """Full outer compare of two extracts on ``key``: the rows where a measure differs."""
    return J.join_full_outer_compare(a, b, key, measures)
