"""Evaluation and calibration metrics as aggregates over a scored frame.

Each metric is a one-row DataFrame (or a small per-bin / per-class table), computed by
aggregates, so it runs where the predictions are and is exactly checkable against SQL.
Ordered metrics (AUC, ROC curve, equal-leads bins) use ``global_prefix``: the scored rows are
first collapsed to distinct scores (AUC / ROC) or ordered by ``(score, row_key)`` (leads bins),
then prefixed bucket by bucket - never one task holding the whole frame in order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichlab.functions import scalars as S
from enrichlab.session import materialize
from enrichlab.operators.binning import bin_quantile, global_prefix, segmented_prefix, with_range_bucket

MACHINE_EPS = 2.220446049250313e-16  # float64 machine epsilon, the log-loss clip


def _yp(df: DataFrame, y: str, p: str) -> DataFrame:
    """Narrow (y, p) rows where both are there; NaN is null."""
    return df.select(S.nan_to_null(F.col(y).cast("double")).alias("y"), S.nan_to_null(F.col(p).cast("double")).alias("p")).filter("y is not null and p is not null")


# ---------------------------------------------------------------- ranking


def _score_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    """Distinct scores with positive / negative counts (ties collapse map-side)."""
    return (
        _yp(df, y, p)
        .groupBy(F.col("p").alias("s"))
        .agg(F.count_if(F.col("y") > 0).alias("pos"), F.count_if(F.col("y") <= 0).alias("neg"))
    )


def roc_auc(df: DataFrame, y: str = "y", p: str = "p", buckets: int | None = None) -> DataFrame:
    """Binary AUC with ties (Mann-Whitney): sum over scores of pos * (neg below + neg tied / 2),
    divided by P * N; null when a class is missing (one-class folds)."""
    sc = materialize(_score_counts(df, y, p))  # read by the count, the sample, the totals and the result
    pre = global_prefix(sc, ["s"], {"neg_below": F.col("neg")}, inclusive=False, buckets=buckets)
    return pre.agg(
        F.try_divide(
            F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)),
            F.sum("pos").cast("double") * F.sum("neg"),
        ).alias("roc_auc")
    )


def roc_curve(df: DataFrame, y: str = "y", p: str = "p", buckets: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) for each distinct score: predicted positive when p >= threshold."""
    sc = materialize(_score_counts(df, y, p))
    tot = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    P, N = tot.select("P").scalar(), tot.select("N").scalar()
    pre = global_prefix(sc, ["s"], {"pos_below": F.col("pos"), "neg_below": F.col("neg")}, inclusive=False, buckets=buckets)
    return pre.select(
        F.col("s").alias("threshold"),
        F.try_divide((N - F.col("neg_below")).cast("double"), N).alias("fpr"),
        F.try_divide((P - F.col("pos_below")).cast("double"), P).alias("tpr"),
    )


# ---------------------------------------------------------------- probability errors


def log_loss(df: DataFrame, y: str = "y", p: str = "p", eps: float = MACHINE_EPS) -> DataFrame:
    x = _yp(df, y, p)
    pc = F.least(F.greatest(F.col("p"), F.lit(eps)), F.lit(1 - eps))
    return x.agg((-F.avg(F.col("y") * F.ln(pc) + (1 - F.col("y")) * F.ln(1 - pc))).alias("log_loss"))


def regression_errors(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """r2, rmse, mse, mae (on probabilities or predictions)."""
    x = _yp(df, y, p)
    e = F.col("y") - F.col("p")
    ss_tot = F.var_pop("y") * F.count("y")
    return x.agg(
        (1 - F.try_divide(F.sum(e * e), ss_tot)).alias("r2"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
    )


def mape(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    x = _yp(df, y, p)
    return x.agg((F.avg(F.abs((F.col("y") - F.col("p")) / (F.col("y") + 1e-8))) * 100).alias("mape"))


# ---------------------------------------------------------------- classification counts


def _cells(df: DataFrame, y: str, p: str, t: float, strict: bool) -> DataFrame:
    yhat = S.class_from_score(p, t, strict)
    yy = (F.col(y) > 0).cast("int")
    return df.agg(
        F.count_if((yy == 1) & (yhat == 1)).alias("tp"),
        F.count_if((yy == 0) & (yhat == 1)).alias("fp"),
        F.count_if((yy == 0) & (yhat == 0)).alias("tn"),
        F.count_if((yy == 1) & (yhat == 0)).alias("fn"),
    )


def classification_scores(df: DataFrame, y: str = "y", p: str = "p", t: float = 0.5, strict: bool = False) -> DataFrame:
    """accuracy, precision, recall, f1 of the positive class; 0 when a denominator is 0."""
    c = _cells(df, y, p, t, strict)
    tp, fp, tn, fn = (F.col(k).cast("double") for k in ("tp", "fp", "tn", "fn"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    return c.select(
        F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0)).alias("f1"),
    )


def confusion_matrix(df: DataFrame, y: str = "y", p: str = "p", t: float = 0.5, strict: bool = False) -> DataFrame:
    return df.groupBy((F.col(y) > 0).cast("int").alias("actual"), S.class_from_score(p, t, strict).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))


def class_report(df: DataFrame, y: str = "y", p: str = "p", t: float = 0.5, strict: bool = False) -> DataFrame:
    """Per class precision / recall / f1 / support, plus macro and weighted averages."""
    c = _cells(df, y, p, t, strict)
    tp, fp, tn, fn = (F.col(k).cast("double") for k in ("tp", "fp", "tn", "fn"))

    def prf(tp_, fp_, fn_):
        pr = F.coalesce(F.try_divide(tp_, tp_ + fp_), F.lit(0.0))
        rc = F.coalesce(F.try_divide(tp_, tp_ + fn_), F.lit(0.0))
        return pr, rc, F.coalesce(F.try_divide(2 * pr * rc, pr + rc), F.lit(0.0))

    p1, r1, f1 = prf(tp, fp, fn)
    p0, r0, f0 = prf(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s1 + s0
    rows = [
        F.struct(F.lit("0").alias("label"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("label"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), F.try_divide(p0 * s0 + p1 * s1, n).alias("precision"),
                 F.try_divide(r0 * s0 + r1 * s1, n).alias("recall"), F.try_divide(f0 * s0 + f1 * s1, n).alias("f1"),
                 n.alias("support")),
    ]
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# ---------------------------------------------------------------- calibration


def score_distribution(df: DataFrame, p: str = "p", rsd: float | None = None) -> DataFrame:
    """Rows, least, largest and distinct scores (an estimate with ``rsd``); NaN is null."""
    x = df.select(S.nan_to_null(F.col(p).cast("double")).alias("p"))
    distinct = F.count_distinct("p") if rsd is None else F.approx_count_distinct("p", rsd)
    return x.agg(F.count("p").alias("rows"), F.min("p").alias("min"), F.max("p").alias("max"), distinct.alias("distinct"))


def ece_bin_table(df: DataFrame, y: str = "y", p: str = "p", n_bins: int = 5, method: str = "ranks",
                  fallback: bool = False) -> DataFrame:
    """qcut(p, n_bins, duplicates='drop') bins: per bin mean p, count, mean y.  A constant score has
    no quantile bins: no rows, or with ``fallback`` the middle one of ``n_bins`` equal-width bins."""
    x = _yp(df, y, p)
    b, edges = bin_quantile(x, "p", n_bins, "bin", method)
    if fallback and len(edges) < 2:
        b = x.withColumn("bin", F.lit(n_bins // 2))
    return b.filter(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.avg("p").alias("mean_pred"), F.count(F.lit(1)).alias("count"), F.avg("y").alias("mean_true"))


def ece_quantile(df: DataFrame, y: str = "y", p: str = "p", n_bins: int = 5, method: str = "ranks") -> DataFrame:
    """sum over quantile bins of (n_b / N) * |mean p - mean y|, N = all rows; 0.0 when
    N < 10 * n_bins or when no bin exists (constant p)."""
    n = df.count()
    if n < 10 * n_bins:
        return df.sparkSession.range(1).select(F.lit(0.0).alias("ece"))
    t = ece_bin_table(df, y, p, n_bins, method)
    return t.agg(F.coalesce(F.sum(F.col("count") / F.lit(float(n)) * F.abs(F.col("mean_pred") - F.col("mean_true"))),
                            F.lit(0.0)).alias("ece"))


def equal_leads_bins(df: DataFrame, sales: str, p: str, leads: str, row_key: str, n_bins: int = 10,
                     buckets: int | None = None) -> DataFrame:
    """Rows with leads > 0 ordered by (p, row_key); bins of about equal total leads by the
    greedy rule (at most one bin step per row), in closed form:
      i = row index, before_i = leads before row i, lpb = total / n,
      t_i = #{k >= 1 : k * lpb <= before_i},  bin_i = min(n - 1, i + min_{j <= i}(t_j - j)).
    Two distributed prefix scans over the same range buckets; no Python loop, no single task."""
    x = df.filter(F.col(leads).isNotNull() & (F.col(leads) > 0)).select(
        F.col(row_key).alias("row_key"), S.nan_to_null(F.col(p).cast("double")).alias("pred"),
        S.nan_to_null(F.col(sales).cast("double")).alias("sales"), F.col(leads).cast("double").alias("leads")).filter("pred is not null")
    total = x.agg(F.sum("leads")).first()[0]
    if not total:
        return x.withColumn("bin", F.lit(None).cast("int")).limit(0)
    lpb = total / n_bins
    order = ["pred", "row_key"]
    xb = with_range_bucket(x, order, "__bucket", buckets).persist()
    try:
        a = global_prefix(xb, order, {"i": F.lit(1), "before": F.col("leads")}, inclusive=False, bucket_col="__bucket")
        k0 = F.floor(F.col("before") / F.lit(lpb))
        t = (F.when((k0 + 1) * F.lit(lpb) <= F.col("before"), k0 + 1)
             .when(k0 * F.lit(lpb) > F.col("before"), k0 - 1).otherwise(k0))
        a = a.withColumn("d", t - F.col("i"))
        a = a.persist()
        b = global_prefix(a, order, {"runmin": F.col("d")}, inclusive=True, op="min", bucket_col="__bucket")
        out = b.withColumn("bin", F.least(F.lit(n_bins - 1), F.col("i") + F.col("runmin")).cast("int"))
        return _materialize(out.select("row_key", "pred", "sales", "leads", "bin"), [a, xb])
    except Exception:
        xb.unpersist()
        raise


def _materialize(df: DataFrame, release: Sequence[DataFrame]) -> DataFrame:
    """Write the binned rows once (checkpoint folder) and release the cached inputs."""
    from enrichlab.session import materialize

    out = materialize(df)
    for r in release:
        r.unpersist()
    return out


def ece_by_leads_table(df: DataFrame, sales: str = "sales", p: str = "p", leads: str = "leads", row_key: str = "row_key",
                       n_bins: int = 10) -> DataFrame:
    b = equal_leads_bins(df, sales, p, leads, row_key, n_bins)
    return b.groupBy("bin").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("leads").alias("leads"), F.avg("pred").alias("mean_pred"),
        F.avg(F.col("sales") / F.col("leads")).alias("mean_actual"))


def ece_by_leads(df: DataFrame, sales: str = "sales", p: str = "p", leads: str = "leads", row_key: str = "row_key",
                 n_bins: int = 10) -> DataFrame:
    """sum_b (leads_b / leads) * |mean p_b - mean(sales / leads)_b| (row means unweighted);
    null when no row has leads."""
    t = ece_by_leads_table(df, sales, p, leads, row_key, n_bins)
    return t.agg(F.try_divide(F.sum(F.col("leads") * F.abs(F.col("mean_pred") - F.col("mean_actual"))),
                              F.sum("leads")).alias("ece"))


# The rule model's calibration bin edges.
RULE_BIN_EDGES = (0.0, 0.01, 0.032, 0.28, 0.492, 1.0)


def rule_bin_expr(p: Column, edges: Sequence[float] = RULE_BIN_EDGES) -> Column:
    """bin 0: p == 0 exactly; last bin: p >= its left edge; others [a, b); (0, first edge)
    belongs to no bin."""
    last = len(edges) - 2
    e = F.when(p == edges[0], 0)
    for i in range(1, last):
        e = e.when((p >= edges[i]) & (p < edges[i + 1]), i)
    return e.when(p >= edges[last], last)


def ece_rules_table(df: DataFrame, y: str = "y", p: str = "p", edges: Sequence[float] = RULE_BIN_EDGES) -> DataFrame:
    x = _yp(df, y, p).withColumn("bin_idx", rule_bin_expr(F.col("p"), edges))
    g = x.filter(F.col("bin_idx").isNotNull()).groupBy("bin_idx").agg(
        F.count(F.lit(1)).alias("bin_samples"), F.sum("y").alias("bin_sales"), F.avg("p").alias("bin_pred_prob"))
    g = g.withColumn("bin_actual_l2s", F.col("bin_sales") / F.col("bin_samples"))
    return g.withColumns({
        "l2s_comparison": F.abs(F.col("bin_pred_prob") - F.col("bin_actual_l2s")),
        "bin_low": _lookup(F.col("bin_idx"), edges[:-1]),
        "bin_high": _lookup(F.col("bin_idx"), edges[1:]),
    })


def _lookup(idx: Column, values: Sequence[float]) -> Column:
    out = F.lit(None).cast("double")
    for i, v in enumerate(values):
        out = F.when(idx == i, F.lit(float(v))).otherwise(out)
    return out


def ece_rules(df: DataFrame, y: str = "y", p: str = "p", edges: Sequence[float] = RULE_BIN_EDGES) -> DataFrame:
    """Unweighted mean gap over non-empty rule bins (0.0 when none)."""
    t = ece_rules_table(df, y, p, edges)
    return t.agg(F.coalesce(F.avg("l2s_comparison"), F.lit(0.0)).alias("ece"))


def ece_equal_width(df: DataFrame, y: str = "y", p: str = "p", n_bins: int = 10) -> DataFrame:
    """Equal-width bins on [0, 1] (last bin closed): sum_b (n_b / N) |mean p - mean y|."""
    x = _yp(df, y, p).filter(F.col("p").isNotNull())
    b = x.withColumn("bin", F.least(F.floor(F.col("p") * n_bins), F.lit(n_bins - 1)))
    n = x.agg(F.count(F.lit(1))).scalar()
    g = b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("mp"), F.avg("y").alias("my"))
    return g.agg(F.coalesce(F.sum(F.col("n") / n * F.abs(F.col("mp") - F.col("my"))), F.lit(0.0)).alias("ece"))


# ---------------------------------------------------------------- score tables


def score_row(df: DataFrame, y: str = "y", p: str = "p", n_bins: int = 5, model: str | None = None,
              leads: str | None = None, row_key: str | None = None) -> DataFrame:
    """AUC, R2, RMSE, log-loss and ECE of one scored frame as one row (each metric null when
    it cannot be computed, e.g. AUC on a one-class frame).  With ``leads`` and ``row_key`` the
    calibration error is the leads-weighted one over 10 bins, as partner scoring asks; without,
    the quantile one over ``n_bins``."""
    # evaluated eagerly on a persisted narrow frame: one scoring pass feeds every metric
    extra = [F.col(c).alias(a) for c, a in ((leads, "leads"), (row_key, "row_key")) if c]
    x = df.select(F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p"), *extra).persist()
    try:
        vals = {
            "roc_auc": roc_auc(x, "y", "p").first()[0],
            **regression_errors(x, "y", "p").select("r2", "rmse").first().asDict(),
            "log_loss": log_loss(x, "y", "p").first()[0],
            "ece": (ece_by_leads(x, "y", "p", "leads", "row_key") if leads and row_key else ece_quantile(x, "y", "p", n_bins)).first()[0],
        }
    finally:
        x.unpersist()
    spark = df.sparkSession
    row = spark.createDataFrame([(model, vals["roc_auc"], vals["r2"], vals["rmse"], vals["log_loss"], vals["ece"])],
                                "model string, roc_auc double, r2 double, rmse double, log_loss double, ece double")
    return row if model is not None else row.drop("model")


def score_table(scored: Mapping[str, DataFrame], y: str = "y", p: str = "p", leads: str | None = None,
                row_key: str | None = None) -> DataFrame:
    """``score_row`` of every model, one row each: all models' scores are computed together (``grouped_scores``), the leads-weighted calibration
    error model by model, some side by side."""
    from enrichlab.session import materialize, side_by_side

    every = None
    for name, df in scored.items():
        part = df.select(F.lit(name).alias("model"), F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p"))
        every = part if every is None else every.unionByName(part)
    found = {r.model: r for r in grouped_scores(materialize(every), ["model"]).collect()}  # one row per model
    by_leads = dict.fromkeys(scored)
    if leads and row_key:
        one = lambda df: ece_by_leads(df, y, p, leads, row_key).first()[0]
        by_leads = dict(zip(scored, side_by_side(every.sparkSession, one, list(scored.values())), strict=True))
    rows = []
    for name in scored:
        r = found.get(name)
        ece = by_leads[name] if leads and row_key else r.ece if r else 0.0
        rows.append((name, *((r.roc_auc, r.r2, r.rmse, r.log_loss) if r else (None,) * 4), ece))
    return every.sparkSession.createDataFrame(rows, "model string, roc_auc double, r2 double, rmse double, log_loss double, ece double")


def grouped_scores(df: DataFrame, keys: Sequence[str], y: str = "y", p: str = "p", n_bins: int = 5,
                   buckets: int | None = None) -> DataFrame:
    """One row per key with ``rows``, ``roc_auc``, ``log_loss``, ``r2``, ``rmse`` and ``ece``: what ``roc_auc``, ``log_loss``,
    ``regression_errors`` and ``ece_quantile`` give for each key alone, for all keys at once.  Rows are first
    counted per (key, score); ranks come from one prefix within the keys, so neither many keys nor a hot one
    matters.  The calibration edges are the key's exact quantiles, equal ones dropped."""
    from enrichlab.session import materialize

    keys = list(keys)
    v = df.select(*keys, S.nan_to_null(F.col(y).cast("double")).alias("__y"), S.nan_to_null(F.col(p).cast("double")).alias("__p"))
    both = F.col("__y").isNotNull() & F.col("__p").isNotNull()
    pc = F.least(F.greatest(F.col("__p"), F.lit(MACHINE_EPS)), F.lit(1 - MACHINE_EPS))
    e = F.col("__y") - F.col("__p")
    plain = v.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        (-F.avg(F.when(both, F.col("__y") * F.ln(pc) + (1 - F.col("__y")) * F.ln(1 - pc)))).alias("log_loss"),
        (1 - F.try_divide(F.sum(F.when(both, e * e)), F.var_pop(F.when(both, F.col("__y"))) * F.count_if(both))).alias("r2"),
        F.sqrt(F.avg(F.when(both, e * e))).alias("rmse"))
    counts = v.filter(both).groupBy(*keys, "__p").agg(
        F.count(F.lit(1)).alias("__n"), F.count_if(F.col("__y") > 0).alias("__pos"), F.sum("__y").alias("__sum"))
    pre = materialize(segmented_prefix(counts, keys, ["__p"], {"__before": F.col("__n"), "__pos_before": F.col("__pos")}, buckets))

    def on(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        """Null-safe join by the keys; ``b`` has one row per key."""
        right = b.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[c for c in b.columns if c not in keys])
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & a[k].eqNullSafe(right[f"__k{i}"])
        return a.join(right, cond, how).drop(*[f"__k{i}" for i in range(len(keys))])

    neg, neg_before = F.col("__n") - F.col("__pos"), F.col("__before") - F.col("__pos_before")
    auc = pre.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("__pos") * (neg_before + neg / 2.0)), F.sum("__pos").cast("double") * F.sum(neg)).alias("roc_auc"),
        F.sum("__n").alias("__t"))
    ranked = on(pre, auc.select(*keys, "__t"), "inner")
    at = lambda r: F.max(F.when((F.col("__before") <= r) & (r < F.col("__before") + F.col("__n")), F.col("__p")))
    wanted = [(F.col("__t") - 1) * F.lit(i / n_bins) for i in range(n_bins + 1)]
    edges = ranked.groupBy(*keys).agg(*[f(h).alias(f"__{n}{i}") for i, h in enumerate(wanted) for n, f in (("lo", lambda h: at(F.floor(h))), ("hi", lambda h: at(F.ceil(h))), ("d", lambda h: F.first(h - F.floor(h))))])
    edge = [F.when(F.col(f"__lo{i}") == F.col(f"__hi{i}"), F.col(f"__lo{i}")).otherwise(F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__d{i}")) for i in range(n_bins + 1)]
    edges = edges.select(*keys, F.array_distinct(F.array(*edge)).alias("__edges"))
    binned = on(ranked, edges, "inner").filter(F.size("__edges") > 1)
    above = F.size(F.filter("__edges", lambda x: x < F.col("__p")))
    bins = binned.groupBy(*keys, F.greatest(above, F.lit(1)).alias("__bin")).agg(
        F.sum("__n").alias("__c"), (F.sum(F.col("__p") * F.col("__n")) / F.sum("__n")).alias("__mp"), (F.sum("__sum") / F.sum("__n")).alias("__my"))
    ece = bins.groupBy(*keys).agg(F.sum(F.col("__c") * F.abs(F.col("__mp") - F.col("__my"))).alias("__ece"))
    out = on(on(plain, auc.drop("__t"), "left"), ece, "left")
    return out.select(*keys, "rows", "roc_auc", "log_loss", "r2", "rmse",
                      F.when(F.col("rows") < 10 * n_bins, F.lit(0.0)).otherwise(F.coalesce(F.col("__ece") / F.col("rows"), F.lit(0.0))).alias("ece"))


def baseline_vs_model(df: DataFrame, y: str, base: str, p: str) -> DataFrame:
    """R2 / RMSE / MAE / ECE of a baseline score vs a model score, signed improvement and
    whether the model is better (higher R2, lower errors)."""
    def one(col_name):
        r = regression_errors(df, y, col_name)
        e = ece_quantile(df, y, col_name).select("ece").scalar()
        return r.select("r2", "rmse", "mae", e.alias("ece"))

    b, m = one(base), one(p)
    metrics = ["r2", "rmse", "mae", "ece"]
    bm = b.select(*[F.col(c).alias(f"base_{c}") for c in metrics])
    mm = m.select(*[F.col(c).alias(f"model_{c}") for c in metrics])
    both = bm.select(*bm.columns, *[mm.select(c).scalar().alias(c) for c in mm.columns])
    rows = []
    for c in metrics:
        better = (F.col(f"model_{c}") > F.col(f"base_{c}")) if c == "r2" else (F.col(f"model_{c}") < F.col(f"base_{c}"))
        rows.append(F.struct(F.lit(c).alias("metric"), F.col(f"base_{c}").alias("baseline"), F.col(f"model_{c}").alias("model"),
                             (F.col(f"model_{c}") - F.col(f"base_{c}")).alias("improvement"), better.alias("better")))
    return both.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def strategy_comparison(a: DataFrame, b: DataFrame, metric: str = "roc_auc", names=("no_impute", "impute")) -> DataFrame:
    """Best row of each strategy's metrics frame; winner by ``metric`` (ties -> second)."""
    ba = a.orderBy(F.col(metric).desc_nulls_last()).limit(1).select(F.lit(names[0]).alias("strategy"), "*")
    bb = b.orderBy(F.col(metric).desc_nulls_last()).limit(1).select(F.lit(names[1]).alias("strategy"), "*")
    both = ba.unionByName(bb, allowMissingColumns=True)
    va = ba.select(metric).scalar()
    vb = bb.select(metric).scalar()
    return both.withColumn("winner", F.when(va > vb, F.lit(names[0])).otherwise(F.lit(names[1])))
