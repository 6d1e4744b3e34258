"""Splits, folds and tuning.

Folds are defined on the **distinct dates present** (not the calendar): a daily count table
(one row per date - bounded by the calendar, not by the data) is indexed and prefix-summed,
and each fold is a date range with its row counts.  Training filters the (persisted)
featurised frame by date per fold - the driver holds only fold dates, fitted models and
metric rows.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrichlab.operators import metrics as M


def split_by_date(df: DataFrame, c: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """train: c < cutoff, test: c >= cutoff."""
    d = F.to_date(F.lit(cutoff))
    return df.filter(F.col(c) < d), df.filter(F.col(c) >= d)


def split_by_ratio(df: DataFrame, key: str, test: float = 0.2, seed: int = 42, stratify: str | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """Random split by a hash of the row key (stable under repartitioning and recomputation).
    Stratified: the rows of each class are ranked by hash, and the first ``test`` share of them
    (rounded half up) is the test set, so every class keeps its share exactly; the rank is
    skew-safe, as one class may hold nearly all rows."""
    hashed = F.xxhash64(F.col(key).cast("string"), F.lit(seed))
    is_test = F.pmod(hashed, F.lit(1000)) < int(round(test * 1000))
    if stratify:
        from enrichlab.operators.windows import skew_safe_row_number

        x = skew_safe_row_number(df.withColumn("__h", hashed), [stratify], [("__h", True), (key, True)], "__rank")
        sizes = df.groupBy(F.col(stratify).alias("__class")).agg(F.floor(F.count(F.lit(1)) * F.lit(test) + 0.5).alias("__take"))
        x = x.join(sizes, x[stratify].eqNullSafe(sizes["__class"]))
        part = lambda keep: x.filter(keep).drop("__h", "__rank", "__class", "__take")
        return part(F.col("__rank") > F.col("__take")), part(F.col("__rank") <= F.col("__take"))
    return df.filter(~is_test), df.filter(is_test)


def time_series_folds(df: DataFrame, date: str, train: int = 90, test: int = 7, step: int = 7,
                      min_train: int = 100, min_test: int = 10) -> DataFrame:
    """Folds over the distinct dates present: train on dates [k*step, k*step + train), test on
    the next ``test`` dates; kept when train rows >= min_train and test rows >= min_test; none
    when there are fewer than train + test dates.  Returns (fold, train_from, train_to,
    test_from, test_to, train_rows, test_rows)."""
    daily = df.filter(F.col(date).isNotNull()).groupBy(F.to_date(F.col(date)).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    # one row per distinct date: the window below spans the (calendar-bounded) daily table only
    w = Window.orderBy("d")
    idx = daily.select("d", "n", (F.row_number().over(w) - 1).alias("i"),
                       F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    idx = idx.persist()
    D = idx.count()
    if D < train + test:
        idx.unpersist()
        return df.sparkSession.createDataFrame([], "fold int, train_from date, train_to date, test_from date, "
                                               "test_to date, train_rows bigint, test_rows bigint")
    k_max = (D - train - test) // step
    folds = df.sparkSession.range(k_max + 1).select(F.col("id").cast("int").alias("fold"))
    folds = folds.withColumns({"a": F.col("fold") * step, "b": F.col("fold") * step + train - 1,
                               "c": F.col("fold") * step + train, "e": F.col("fold") * step + train + test - 1})
    def at(col_i, alias):
        t = idx.select(F.col("i").alias(f"{alias}_i"), F.col("d").alias(alias), F.col("cum").alias(f"{alias}_cum"),
                       F.col("n").alias(f"{alias}_n"))
        return t, F.col(col_i) == F.col(f"{alias}_i")
    out = folds
    for col_i, alias in (("a", "train_from"), ("b", "train_to"), ("c", "test_from"), ("e", "test_to")):
        t, cond = at(col_i, alias)
        out = out.join(F.broadcast(t), cond, "inner")  # the daily table: one row per date
    out = out.select(
        "fold", "train_from", "train_to", "test_from", "test_to",
        (F.col("train_to_cum") - F.col("train_from_cum") + F.col("train_from_n")).alias("train_rows"),
        (F.col("test_to_cum") - F.col("test_from_cum") + F.col("test_from_n")).alias("test_rows"),
    )
    from enrichlab.session import materialize

    out = materialize(out.filter((F.col("train_rows") >= min_train) & (F.col("test_rows") >= min_test)))
    idx.unpersist()
    return out.orderBy("fold")


def weighted_metric_avg(metrics: DataFrame, weight: str = "weight", by: Sequence[str] = ("model", "metric"),
                        value: str = "value") -> DataFrame:
    """sum(m * w) / sum(w over folds having the metric); null when no fold has it."""
    v = F.col(value)
    return metrics.groupBy(*by).agg(
        F.try_divide(F.sum(F.when(v.isNotNull(), v * F.col(weight))), F.sum(F.when(v.isNotNull(), F.col(weight)))).alias("weighted_avg"),
        F.count(v).alias("folds"))


def _with_p(df: DataFrame) -> DataFrame:
    """Scored frame with a ``p`` column (rule model: already there; ML: from the vector)."""
    if "p" in df.columns:
        return df
    from enrichlab.operators.models import positive_probability

    return positive_probability(df)


def time_series_cv(pipeline: Pipeline | Estimator, df: DataFrame, date: str, label: str, folds: DataFrame,
                   name: str = "model", metric_label: str | None = None, score_train: bool = True) -> DataFrame:
    """Any Spark ML pipeline, fold by fold: fit on the train dates, score train and test; weight = test rows.  Returns
    (model, fold, split, metric, value, weight) rows.  The fits are a driver loop, so this is for estimators
    that ``run_cv_all`` cannot batch; the scores of all folds are computed together.  The input should be persisted."""
    ml = metric_label or label
    scored = None
    for f in folds.collect():  # one row per fold: dates and counts only
        tr = df.filter(F.to_date(F.col(date)).between(f["train_from"], f["train_to"]))
        te = df.filter(F.to_date(F.col(date)).between(f["test_from"], f["test_to"]))
        model = pipeline.fit(tr)
        for flag, part in (((True, tr),) if score_train else ()) + ((False, te),):
            sc = _with_p(model.transform(part)).select(F.lit(name).alias("model"), F.lit(int(f["fold"])).alias("fold"), F.lit(flag).alias("train"), F.col(ml).cast("double").alias("y"), "p")
            scored = sc if scored is None else scored.unionByName(sc)
    if scored is None:
        return df.sparkSession.createDataFrame([], "model string, fold int, split string, metric string, value double, weight double")
    return fold_metrics(scored, folds)


def fold_frame(df: DataFrame, folds: DataFrame, date: str) -> DataFrame:
    """Every row once per fold that trains or tests on its day, with ``fold`` and ``train``."""
    part = lambda split, flag: fold_rows(df, folds, date, split).withColumn("train", F.lit(flag))
    return part("train", True).unionByName(part("test", False))


def blank_sparse_by_fold(x: DataFrame, cols: Sequence[str], max_null_pct: float = 60.0) -> DataFrame:
    """Columns of which a fold's training rows are null to more than ``max_null_pct`` percent are null in that fold: no model of
    the fold can use them, as if they had been dropped at its fit."""
    cols = [c for c in cols if c in x.columns]
    share = x.filter("train").groupBy("fold").agg(*[(100.0 * F.count_if(F.col(c).isNull()) / F.count(F.lit(1))).alias(f"__s{i}") for i, c in enumerate(cols)])
    # one row per fold
    j = x.join(F.broadcast(share), "fold", "left")
    return j.withColumns({c: F.when(F.col(f"__s{i}") <= max_null_pct, F.col(c)) for i, c in enumerate(cols)}).drop(*[f"__s{i}" for i in range(len(cols))])


def fill_medians_by_fold(x: DataFrame, cols: Sequence[str], fixed: Mapping[str, float] | None = None) -> DataFrame:
    """Nulls of numeric columns become the exact median of the fold's training rows (``fixed``: a constant instead); a column
    that is null throughout a fold's training rows stays null there."""
    from enrichlab.functions import scalars as S
    from enrichlab.operators.binning import grouped_exact_quantiles

    fixed = dict(fixed or {})
    cols = [c for c in cols if c in x.columns]
    learned = [c for c in cols if c not in fixed]
    value = lambda c: S.nan_to_null(F.col(c).cast("double"))
    out = x.withColumns({c: F.coalesce(value(c), F.lit(float(fixed[c]))) for c in cols if c in fixed})
    if not learned:
        return out
    long = x.filter("train").select("fold", F.explode(F.array(*[F.struct(F.lit(i).alias("c"), value(c).alias("v")) for i, c in enumerate(learned)])).alias("e")).select("fold", "e.*")
    medians = grouped_exact_quantiles(long, ["fold", "c"], "v", [0.5], ["m"])
    wide = medians.groupBy("fold").agg(*[F.max(F.when(F.col("c") == i, F.col("m"))).alias(f"__m{i}") for i in range(len(learned))])
    out = out.join(F.broadcast(wide), "fold", "left")  # one row per fold
    return out.withColumns({c: F.coalesce(value(c), F.col(f"__m{i}")) for i, c in enumerate(learned)}).drop(*[f"__m{i}" for i in range(len(learned))])


def rule_fold_scores(x: DataFrame, label: str, rule: Column, name: str = "rule_model") -> DataFrame:
    """(model, fold, train, y, p) of the rule model on a ``fold_frame``: the mean label of the row's rule in the fold's training
    rows, 0 for a rule without any."""
    rows = x.select("fold", "train", F.col(label).cast("double").alias("y"), rule.alias("__rule"))
    means = rows.filter("train and __rule is not null").groupBy("fold", "__rule").agg(F.avg("y").alias("p"))
    j = rows.join(means, ["fold", "__rule"], "left")
    return j.select(F.lit(name).alias("model"), "fold", "train", "y", F.coalesce("p", F.lit(0.0)).alias("p"))


#: The metrics of a fold, in ``grouped_scores`` and here.
FOLD_METRICS = {"roc_auc": "roc_auc", "log_loss": "log_loss", "r2": "r2_proba", "rmse": "rmse_proba", "ece": "ece"}


def fold_metrics(scored: DataFrame, folds: DataFrame) -> DataFrame:
    """(model, fold, split, metric, value, weight) of scored rows (model, fold, train, y, p): all models, folds and splits in
    one set of jobs; the weight is the fold's number of test rows."""
    g = M.grouped_scores(scored, ["model", "fold", "train"])
    rows = F.explode(F.array(*[F.struct(F.lit(out).alias("metric"), F.col(c).alias("value")) for c, out in FOLD_METRICS.items()]))
    g = g.select("model", "fold", F.when(F.col("train"), "train").otherwise("test").alias("split"), rows.alias("m")).select("model", "fold", "split", "m.*")
    return g.join(F.broadcast(folds.select("fold", F.col("test_rows").cast("double").alias("weight"))), "fold").select("model", "fold", "split", "metric", "value", "weight")  # one row per fold


def run_cv_all(df: DataFrame, date: str, label: str, features: Sequence[str], scorer: Callable[[DataFrame], DataFrame],
               train: int = 90, test: int = 7, step: int = 7) -> DataFrame:
    """Rolling CV of many models over all folds at once.  Rows whose ``features`` are all null go; every other row
    meets its folds (``fold_frame``); ``scorer`` fits all models on all folds of that frame and returns (model, fold,
    train, y, p) - e.g. ``models.fold_scorer``.  Returns the fold metrics."""
    from enrichlab.operators.filters import drop_all_null_rows
    from enrichlab.session import materialize

    x = materialize(drop_all_null_rows(df, features, on_empty="skip"))
    folds = time_series_folds(x, date, train, test, step)
    return fold_metrics(materialize(scorer(fold_frame(x, folds, date))), folds)


def get_best_model(metrics: DataFrame, metric: str, higher_is_better: bool | None = None) -> DataFrame:
    """Best row by ``metric`` with the direction of that metric (the reference always sorts
    descending, which picks the worst RMSE - SURVEY 8 Q13)."""
    if higher_is_better is None:
        higher_is_better = metric.lower() not in {"rmse", "mse", "mae", "log_loss", "logloss", "ece", "mape", "rmse_proba"}
    o = F.col(metric).desc_nulls_last() if higher_is_better else F.col(metric).asc_nulls_last()
    return metrics.orderBy(o).limit(1)


def _auc_once(scored: DataFrame, label: str) -> float | None:
    s = scored.select(label, "p").persist()
    try:
        return M.roc_auc(s, label, "p").first()[0]
    finally:
        s.unpersist()


def class_balance(df: DataFrame, label: str, split: str | None = None) -> DataFrame:
    keys = [split] if split else []
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) > 0).alias("positives"),
                                 (F.count_if(F.col(label) > 0) / F.count(F.lit(1))).alias("positive_share"))


def draw(rng: random.Random, choice) -> object:
    """One value of a search space entry: an item of a list, an integer of a ``range`` or a float
    from a pair of bounds."""
    if isinstance(choice, range):
        return rng.randrange(choice.start, choice.stop, choice.step)
    if isinstance(choice, tuple):
        return rng.uniform(*choice)
    return rng.choice(list(choice))


def random_search(estimator: Estimator, space: Mapping[str, Sequence], df: DataFrame, n_iter: int = 20, folds: int = 3,
                  metric_fn: Callable[[DataFrame], float] | None = None, label: str = "label", seed: int = 42,
                  fold_key: str = "row_key", higher_is_better: bool = True, parallelism: int = 4):
    """``n_iter`` random parameter draws x ``folds``-fold CV (fold = hash of the row key),
    mean score per draw, best draw refit on all rows.  A space entry is a list, a ``range`` of
    integers or a (low, high) pair of floats.  ``parallelism`` draws are fitted at a time.  Returns
    (best_model, results frame)."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    rng = random.Random(seed)
    draws = [{k: draw(rng, v) for k, v in space.items()} for _ in range(n_iter)]
    metric_fn = metric_fn or (lambda s: _auc_once(_with_p(s), label))
    fold = F.pmod(F.xxhash64(F.col(fold_key).cast("string"), F.lit(seed)), F.lit(folds))
    x = df.withColumn("__fold", fold).persist()

    def score(params: Mapping) -> float | None:
        est = estimator.copy()
        est._set(**params)
        scores = []
        for f in range(folds):
            m = est.fit(x.filter(F.col("__fold") != f))
            s = metric_fn(m.transform(x.filter(F.col("__fold") == f)))
            if s is not None:
                scores.append(s)
        return sum(scores) / len(scores) if scores else None

    with ThreadPool(max(1, parallelism)) as pool:
        means = pool.map(inheritable_thread_target(x.sparkSession)(score), draws)
    results = [(i, str(d), m) for i, (d, m) in enumerate(zip(draws, means, strict=True))]
    ok = [r for r in results if r[2] is not None]
    best = (max if higher_is_better else min)(ok, key=lambda r: r[2]) if ok else results[0]
    best_est = estimator.copy()
    best_est._set(**draws[best[0]])
    best_model = best_est.fit(x.drop("__fold"))
    x.unpersist()
    res = df.sparkSession.createDataFrame(results, "draw int, params string, mean_score double")
    return best_model, res


def search_trees(df: DataFrame, cols: Sequence[str], label: str, key: str, spaces: Mapping[str, tuple[object, Mapping[str, Sequence]]],
                 n_iter: int = 20, folds: int = 3, seed: int = 42, bins: int = 64, local_rows: int | None = None) -> DataFrame:
    """Random search for several families of tree models at once: family -> (``boosting.TreeParams``, search space over its fields).
    ``n_iter`` draws per family x ``folds``-fold CV (fold = hash of the row key); every fit of every draw is one entry of the same
    job (``boosting.fit_and_score``), and one set of jobs scores them all.  Returns (family, draw, params, mean_score),
    the mean AUC over folds; the drawn parameters are ``draws_of`` with the same arguments."""
    from enrichlab.operators import boosting as BO
    from enrichlab.session import materialize

    drawn = draws_of(spaces, n_iter, seed)
    x = materialize(df.select(F.col(label).alias("__y"), F.col(key).alias("__key"), *cols))
    points = BO.cut_points(x, cols, bins)
    held = F.pmod(F.xxhash64(F.col("__key").cast("string"), F.lit(seed)), F.lit(folds)).cast("int")
    every = F.explode(F.array(*[F.lit(f) for f in range(folds)]))
    split = x.withColumn("__fold", every).withColumn("__train", held != F.col("__fold"))
    rows = None
    for family in spaces:
        part = BO.training_rows(split, cols, "__y", "__key", family, train=F.col("__train"), fold=F.col("__fold"))
        rows = part if rows is None else rows.unionByName(part)
    params = {f"{family}#{i}": p for family, ps in drawn.items() for i, p in enumerate(ps)}
    size = {} if local_rows is None else {"local_rows": local_rows}
    scored = BO.fit_and_score(rows, params, {f: points for f in spaces}, variants={f: [f"{f}#{i}" for i in range(n_iter)] for f in spaces}, **size)
    auc = M.grouped_scores(materialize(scored.filter(~F.col("train")).select("model", "fold", "y", "p")), ["model", "fold"])
    listed = df.sparkSession.createDataFrame([(n, n.split("#")[0], int(n.split("#")[1]), str(p)) for n, p in params.items()], "model string, family string, draw int, params string")
    means = auc.groupBy("model").agg(F.avg("roc_auc").alias("mean_score"))
    return listed.join(means, "model", "left").select("family", "draw", "params", "mean_score")


def draws_of(spaces: Mapping[str, tuple[object, Mapping[str, Sequence]]], n_iter: int = 20, seed: int = 42) -> dict[str, list]:
    """The parameters that ``search_trees`` tries, per family."""
    import dataclasses

    out = {}
    for family, (base, space) in spaces.items():
        rng = random.Random(f"{seed}:{family}")
        out[family] = [dataclasses.replace(base, **{k: draw(rng, v) for k, v in space.items()}) for _ in range(n_iter)]
    return out


def search_logistic(df: DataFrame, cols: Sequence[str], label: str, key: str, n_iter: int = 20, folds: int = 3, seed: int = 42,
                    c_range: tuple[float, float] = (1e-3, 1e2)) -> DataFrame:
    """Random search for logistic regression over C (log-uniform) and class weights: ``n_iter`` draws x ``folds`` fits move through
    the same Newton passes (``linear.fit_logistic``), and one set of jobs scores them.  Returns (draw, c, balanced, mean_score)."""
    import math

    from enrichlab.operators import linear as L
    from enrichlab.session import materialize

    rng = random.Random(seed)
    drawn = [(math.exp(rng.uniform(math.log(c_range[0]), math.log(c_range[1]))), rng.random() < 0.5) for _ in range(n_iter)]
    x = df.withColumn("__fold", F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(folds)).cast("int"))
    x = materialize(x.select("__fold", label, *cols))  # every pass reads it
    coef = L.fit_logistic(x, cols, label, {i * folds + f: (c, f, b) for i, (c, b) in enumerate(drawn) for f in range(folds)}, split="__fold")
    auc = L.held_out_auc(x, cols, label, "__fold", {i: (i % folds, b) for i, b in coef.items()})
    means = auc.groupBy(F.floor(F.col("fit") / folds).cast("int").alias("draw")).agg(F.avg("roc_auc").alias("mean_score"))
    listed = df.sparkSession.createDataFrame([(i, c, b) for i, (c, b) in enumerate(drawn)], "draw int, c double, balanced boolean")
    return listed.join(F.broadcast(means), "draw", "left").select("draw", "c", "balanced", "mean_score")  # one row per draw


def fold_rows(df: DataFrame, folds: DataFrame, date: str, split: str = "test") -> DataFrame:
    """``df`` with one row per fold whose ``split`` dates hold the row, as ``fold``.  The folds are
    spread over their dates first (one row per fold and date, bounded by the calendar), so the join
    is by equal dates and a row meets its own folds only."""
    days = folds.select("fold", F.explode(F.sequence(f"{split}_from", f"{split}_to")).alias("__day"))
    return df.join(days, F.to_date(F.col(date)) == F.col("__day")).drop("__day")


def cv_rule_model(df: DataFrame, date: str, label: str, folds: DataFrame, rule_id: Column) -> DataFrame:
    """Rolling CV of the rule model over all folds at once: the mean label per (fold, rule) of the
    train dates is the probability of that rule's test rows in the fold.  Returns one row per fold
    with ``test_rows``, ``rmse`` and ``log_loss`` of its test rows (rules unseen in training get 0)."""
    x = df.select(F.to_date(F.col(date)).alias("__d"), F.col(label).cast("double").alias("__y"), rule_id.alias("__rule"))
    # all that a fold needs are counts per date and rule: the rows are read once, however many folds
    daily = x.groupBy("__d", "__rule").agg(F.count(F.lit(1)).alias("__n"), F.sum("__y").alias("__pos"))
    p = fold_rows(daily, folds, "__d", "train").groupBy("fold", "__rule").agg((F.sum("__pos") / F.sum("__n")).alias("__p"))
    test = fold_rows(daily, folds, "__d", "test").join(p, ["fold", "__rule"], "left").withColumn("__p", F.coalesce("__p", F.lit(0.0)))
    neg, eps = F.col("__n") - F.col("__pos"), M.MACHINE_EPS
    clipped = F.least(F.greatest(F.col("__p"), F.lit(eps)), F.lit(1 - eps))
    return test.groupBy("fold").agg(
        F.sum("__n").alias("test_rows"),
        F.sqrt(F.sum(F.col("__pos") * F.pow(1 - F.col("__p"), 2) + neg * F.pow(F.col("__p"), 2)) / F.sum("__n")).alias("rmse"),
        (-F.sum(F.col("__pos") * F.ln(clipped) + neg * F.ln(1 - clipped)) / F.sum("__n")).alias("log_loss"))
