"""Composite reports and modelling jobs.

Reports return DataFrames (or dicts of them) - tables, not console text.  Modelling jobs
keep data in Spark: the featurised frame is persisted once, folds / splits are date or hash
filters over it, and the driver only holds parameters, fitted models and metric rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from enrichlab.operators import aggregates as A
from enrichlab.operators import binning as B
from enrichlab.operators import boosting as BO
from enrichlab.operators import features as FE
from enrichlab.operators import linear as LI
from enrichlab.operators import metrics as M
from enrichlab.operators import models as MD
from enrichlab.operators import profile as P
from enrichlab.operators import validate as V
from enrichlab.session import materialize


def attribute_feature_summary(df: DataFrame, features: Sequence[str], sales: str = "sales_count") -> DataFrame:
    """Per requested feature, ONE aggregate: present?, null count / rate, kind, and for numeric
    features the guarded correlation with sales and its trend label."""
    present = [f for f in features if f in df.columns]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for f in present:
        aggs.append(F.count_if(F.col(f).isNull()).alias(f"{f}__nulls"))
        if isinstance(df.schema[f].dataType, NumericType):
            aggs.append(P.safe_corr(F.col(f), F.col(sales)).alias(f"{f}__corr"))
    wide = df.agg(*aggs)
    rows = []
    for f in features:
        if f not in df.columns:
            rows.append(F.struct(F.lit(f).alias("feature"), F.lit(False).alias("present"), F.lit(None).cast("bigint").alias("null_count"),
                                 F.lit(None).cast("double").alias("null_pct"), F.lit(None).cast("string").alias("kind"),
                                 F.lit(None).cast("double").alias("corr")))
            continue
        numeric = isinstance(df.schema[f].dataType, NumericType)
        rows.append(F.struct(F.lit(f).alias("feature"), F.lit(True).alias("present"), F.col(f"{f}__nulls").alias("null_count"),
                             (F.col(f"{f}__nulls") * 100.0 / F.col("__n")).alias("null_pct"),
                             F.lit("numeric" if numeric else "categorical").alias("kind"),
                             (F.col(f"{f}__corr") if numeric else F.lit(None).cast("double")).alias("corr")))
    out = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.withColumn("trend", F.when(F.col("kind") != "numeric", None).when(F.col("corr") > 0.1, "ASC")
                          .when(F.col("corr") < -0.1, "DESC").otherwise("NONE"))


def attribute_feature_report(df: DataFrame, features: Sequence[str], sales: str = "sales_count") -> dict[str, DataFrame]:
    """Summary plus, per present feature, the top-10 categories by leads (categorical) or
    the top-5 values (numeric with <= 20 distinct values)."""
    out = {"summary": attribute_feature_summary(df, features, sales)}
    for f in features:
        if f not in df.columns:
            continue
        if isinstance(df.schema[f].dataType, NumericType):
            out[f] = A.numeric_value_top5(df, f, sales)
        else:
            out[f] = A.category_top10_by_leads(df, f, sales)
    return out


def feature_tables(df: DataFrame, features: Sequence[str], sales: str = "sales_count", k: int = 10, k_numeric: int = 5, max_distinct: int = 20) -> DataFrame:
    """The tables of ``attribute_feature_report`` in one scan: (feature, position, value, leads, sales_sum, l2s).  Rows are unpivoted once to (feature,
    value, sales), combined per value in each task, and ranked per feature by leads and then by value; ranks beyond the
    top are dropped before the exchange.  Numeric features with more than ``max_distinct`` values have no table."""
    present = [f for f in features if f in df.columns]
    numeric = [f for f in present if isinstance(df.schema[f].dataType, NumericType)]
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"), (F.col(f).cast("double") if f in numeric else F.lit(None).cast("double")).alias("number")) for f in present]
    long = df.select(F.explode(F.array(*cells)).alias("e"), F.col(sales).alias("s")).select("e.*", "s").filter("value is not null and not coalesce(isnan(number), false)")
    g = long.groupBy("feature", "value", "number").agg(F.count("s").alias("leads"), F.sum("s").cast("bigint").alias("sales_sum"))
    if numeric:
        many = g.filter(F.col("number").isNotNull()).groupBy("feature").agg(F.count(F.lit(1)).alias("d")).filter(F.col("d") > max_distinct)
        g = g.join(many.select("feature"), "feature", "left_anti")
    order = Window.partitionBy("feature").orderBy(F.desc("leads"), "number", "value")
    top = g.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= F.when(F.col("number").isNull(), k).otherwise(k_numeric))
    return top.filter(F.col("position") <= max(k, k_numeric)).select("feature", "position", "value", "leads", "sales_sum", F.try_divide(F.col("sales_sum").cast("double"), F.col("leads")).alias("l2s"))


def partner_report(frame: DataFrame, fields: Sequence[str] = ("loanamount", "creditscore"),
                   ts: str = "clickout_date") -> dict[str, DataFrame]:
    """Analyses 1-5 on the general analysis frame: null rates (overall, per month, co-null),
    per-value stats, quantile bins of the first numeric field, per-company stats, per-field
    correlation or category tables, and the leads distribution.  A field is numeric if all its values parse as
    numbers, whatever its type (one aggregate)."""
    f = frame.withColumn("l2s", F.try_divide(F.col("sales").cast("double"), F.col("leads")))
    key_cols = ["subid", "company", "transaction_date", "leads", "qls", "sales", "l2s", "clickout_date"]
    numeric = {r.field for r in P.numeric_type_detect(f, list(fields)).collect() if r.is_numeric}
    out = {
        "null_rates": P.null_rates_fields(f, key_cols),
        "null_rates_by_month": P.null_rates_by_month(f, ts, list(fields)),
        "company_stats": A.company_stats(f),
        "leads_distribution": P.leads_distribution(f),
        "leads_value_counts": P.leads_value_counts(f),
    }
    if len(fields) >= 2:
        out["co_null"] = P.co_null_check(f, fields[1], fields[0])
    for fld in fields:
        out[f"value_stats_{fld}"] = A.field_value_stats(f, fld)
        if fld in numeric:
            out[f"correlation_{fld}"] = P.correlation_with_targets(f, fld)
        else:
            out[f"categories_{fld}"] = A.category_top10_by_sales(f, fld)
    num = [x for x in fields if x in numeric]
    if num:
        out[f"bins_{num[0]}"] = B.quantile_bins_with_null_bin(f, num[0], 6)
    return out


def report_rows(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Tables of any shape as one: (report, row, measure, value), a row per number.  ``row`` joins the text and date columns of the
    table's row, or those that ``keys`` names; nulls in it are empty."""
    out = None
    for name, t in tables.items():
        own = list((keys or {}).get(name, [f.name for f in t.schema.fields if not isinstance(f.dataType, NumericType)]))
        row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in own]) if own else F.lit("")
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in t.columns if c not in own]))
        part = t.select(F.lit(name).alias("report"), row.alias("row"), cells.alias("e")).select("report", "row", "e.*")
        out = part if out is None else out.unionByName(part)
    return out


#: Search spaces of the tuned models (a ``range`` of integers, a pair of float bounds, a list).
TUNING = {
    "random_forest": {"trees": range(100, 500), "depth": range(3, 20), "min_split": range(2, 20), "min_leaf": range(1, 10),
                      "features": ["sqrt", "log2", "all"]},
    "xgb": {"trees": range(100, 400), "depth": range(3, 10), "step": (0.01, 0.21), "subsample": (0.6, 1.0), "columns": (0.6, 1.0)},
    "gbt": {"trees": range(100, 400), "depth": range(3, 10), "step": (0.01, 0.21), "subsample": (0.6, 1.0)},
}


def tree_models(trees: int = 200) -> dict[str, BO.TreeParams]:
    """The compared tree models; ``trees`` is the size of the forest and the second booster (the first one has half as many again)."""
    return {
        "random_forest": BO.forest(trees, 10, min_leaf=5),
        "gbt": BO.gbt(trees * 3 // 2, 0.05, 6, subsample=0.8),
        "xgb": BO.xgb(trees, 0.05, 6),
    }


MODELS = ("logistic", "ridge", "random_forest", "gbt", "xgb")


def model_scores(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str, key: str, models: Mapping[str, BO.TreeParams | str],
                 keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Each model fitted on ``train`` and applied to ``test``: name -> (label, key, keep..., p).  A model is 'logistic', 'ridge' or tree
    parameters; all tree models are fitted in the same jobs."""
    x = BO.feature_array(cols)
    out = {}
    for name, kind in models.items():
        if kind == "logistic":
            coef = LI.fit_logistic(train, cols, label, {0: (1.0, None, False)})[0]
            out[name] = test.select(label, key, *keep, LI.logistic_probability(coef, cols).alias("p"))
        elif kind == "ridge":
            (r,) = LI.ridge(train, cols, F.when(F.col(label) > 0, 1.0).otherwise(-1.0)).collect() or [None]
            coef = F.array(*[F.lit(float(v)) for v in (r.coef if r else [0.0] * (len(cols) + 1))])
            out[name] = test.select(label, key, *keep, LI.ridge_probability(coef, x).alias("p"))
    trees = {m: p for m, p in models.items() if isinstance(p, BO.TreeParams)}
    if trees:
        points = BO.cut_points(train, cols)
        carried = [label, key, *keep]
        part = lambda df, flag: BO.training_rows(df, cols, label, key, "all", train=F.lit(flag), keep=[F.col(c).alias(f"__{c}") for c in carried])
        scored = materialize(BO.fit_and_score(part(train, True).unionByName(part(test, False)), trees, {"all": points}, variants={"all": list(trees)}).filter(~F.col("train")))
        for m in trees:
            out[m] = scored.filter(F.col("model") == m).select(*[F.col(f"__{c}").alias(c) for c in carried], "p")
    return {m: out[m] for m in models}


def partner_analysis(name: str, df: DataFrame, features: Sequence[str], target: str, attribute: Sequence[str] = (),
                     null_config: Mapping[str, str] | None = None, split: str = "date", split_val: str = "2025-01-01",
                     date: str = "clickout_date", key: str = "row_key", metric: str = "roc_auc", impute: str = "median",
                     trees: int = 200, tune: Mapping[str, Mapping] | None = None, n_iter: int = 20,
                     leads: str | None = None, models: Sequence[str] = MODELS) -> DataFrame:
    """Drop rows with all attributes null -> split (date or hash ratio) -> null strategies and
    preprocessing learned on the train part -> five classifiers (or those of them named in
    ``models``) -> tuned versions of the models named in ``tune`` (random search, 3-fold CV, e.g. ``TUNING``; all draws of all
    models in shared jobs) -> score table on the test part with
    the leads-weighted calibration error where ``leads`` is given, best first by ``metric``, and ``best``
    on the first row."""
    from enrichlab.operators.filters import drop_all_null_rows
    from enrichlab.operators.windows import rank_models

    x = drop_all_null_rows(df, list(attribute), on_empty="skip") if attribute else df
    x = materialize(x.withColumn("label", (F.col(target) > 0).cast("double")))
    tr, te = V.split_by_date(x, date, split_val) if split == "date" else V.split_by_ratio(x, key, float(split_val))
    if null_config:
        nulls = FE.NullStrategy(null_config).fit(tr)
        tr, te = nulls.transform(tr), nulls.transform(te)
    num = [f for f in features if f in tr.columns and isinstance(tr.schema[f].dataType, NumericType)]
    cat = [f for f in features if f in tr.columns and f not in num]
    prep = FE.WideFeatures(num, cat, impute).fit(tr)
    ready, test = materialize(prep.transform(tr)), materialize(prep.transform(te))
    known = {"logistic": "logistic", "ridge": "ridge", **tree_models(trees)}
    wanted = {m: known[m] for m in models}
    if tune:
        spaces = {m: (known[m], space) for m, space in tune.items()}
        found = V.search_trees(ready, prep.cols, "label", key, spaces, n_iter)
        best = found.groupBy("family").agg(F.max_by("draw", F.struct("mean_score", -F.col("draw"))).alias("draw")).collect()  # one row per family
        drawn = V.draws_of(spaces, n_iter)
        wanted |= {f"{r.family}_tuned": drawn[r.family][r.draw] for r in sorted(best)}
    scored = model_scores(ready, test, prep.cols, "label", key, wanted, [leads] if leads else [])
    table = M.score_table(scored, "label", "p", leads, key if leads else None).withColumn("partner", F.lit(name))
    higher = metric not in {"rmse", "log_loss", "ece"}
    top = V.get_best_model(table, metric, higher).select("model").first()
    return rank_models(table.withColumn("best", F.col("model") == F.lit(top[0])), metric, ascending=not higher)


def cv_comparison(df: DataFrame, date: str, label: str, key: str = "row_key", features: Sequence[str] = MD.ATTRIBUTE_FEATURES,
                  train: int = 90, test: int = 7, step: int = 7, trees: int = 200) -> DataFrame:
    """Rolling time-series CV of the seven pipelines over all folds, averages weighted by test rows, ranked by RMSE
    (ascending)."""
    metrics = V.run_cv_all(df, date, label, features, MD.fold_scorer(label, key, trees), train, test, step)
    avg = V.weighted_metric_avg(metrics.filter(F.col("split") == "test"))
    wide = avg.groupBy("model").pivot("metric", ["roc_auc", "log_loss", "r2_proba", "rmse_proba", "ece"]).agg(F.first("weighted_avg"))
    from enrichlab.operators.windows import rank_models

    return rank_models(wide, "rmse_proba", ascending=True)
