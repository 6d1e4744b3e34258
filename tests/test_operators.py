"""Unit tables for joins, windows, profiles, features, rule model, folds (FIXTURES 3)."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from enrichlab.operators import aggregates as A
from enrichlab.operators import features as FE
from enrichlab.operators import filters as FL
from enrichlab.operators import joins as J
from enrichlab.operators import metrics as M
from enrichlab.operators import models as MD
from enrichlab.operators import profile as P
from enrichlab.operators import validate as V
from enrichlab.operators import windows as W


def test_versions_min_over_visit(spark):
    rows = [("s1", "v1", 1), ("s1", "v1", 2), ("s1", "v1", 3), ("s2", "v2", 2), ("s3", "v2", 3), ("s4", None, 4), ("s5", None, 5)]
    df = spark.createDataFrame(rows, "subid string, visit string, rn int")
    out = {(r["subid"], r["rn"]): r["min_rn"] for r in W.min_over_partition(df, ["visit"], "rn", "min_rn").collect()}
    assert out[("s1", 3)] == 1 and out[("s3", 3)] == 2 and out[("s5", 5)] == 4


def test_latest_left_join_never_older(spark):
    ff = spark.createDataFrame([("a", dt.date(2024, 1, 10)), ("b", dt.date(2024, 1, 10))], "cid string, conv date")
    en = spark.createDataFrame([("a", dt.date(2024, 1, 5), "old"), ("a", dt.date(2024, 1, 12), "new"),
                                ("b", dt.date(2024, 1, 20), "b-late"), ("b", dt.date(2024, 1, 2), "b-early")],
                               "subid string, day date, v string")
    # latest per id first; for 'a' the latest (12th) is after conversion -> kept
    latest = W.latest_per_key(en, "subid", ["day", "v"])
    out = {r["cid"]: r["v"] for r in J.join_equi_range_left_latest(ff, latest, [("cid", "subid")], "conv", "day").collect()}
    assert out == {"a": "new", "b": "b-late"}
    en2 = spark.createDataFrame([("a", dt.date(2024, 1, 5), "old")], "subid string, day date, v string")
    out2 = {r["cid"]: r["v"] for r in J.join_equi_range_left_latest(ff, W.latest_per_key(en2, "subid", ["day", "v"]),
                                                                    [("cid", "subid")], "conv", "day").collect()}
    assert out2 == {"a": None, "b": None}


def test_full_outer_compare(spark):
    a = spark.createDataFrame([("k1", 1), ("k2", 2), (None, 3)], "k string, m int")
    b = spark.createDataFrame([("k1", 1), ("k3", 5), (None, 4)], "k string, m int")
    out = {r["k"]: (r["m_x"], r["m_y"]) for r in J.join_full_outer_compare(a, b, "k", ["m"]).collect()}
    assert out == {"k2": (2, None), "k3": (None, 5), None: (3, 4)}


def test_corr_guards(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, None)], "a double, b double")
    assert df.agg(P.safe_corr(F.col("a"), F.col("b"))).first()[0] is None
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert one.agg(P.safe_corr(F.col("a"), F.col("b"))).first()[0] is None
    rng = np.random.default_rng(1)
    x = rng.normal(size=50)
    y = x * 0.5 + rng.normal(size=50)
    d = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "a double, b double")
    assert abs(d.agg(P.safe_corr(F.col("a"), F.col("b"))).first()[0] - np.corrcoef(x, y)[0, 1]) < 1e-9


def test_skew_adjusted_matches_pandas(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 10.0, 4.0, 1.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = P.skewness_adjusted(df, ["x"]).first()["skew"]
    assert abs(got - pd.Series(vals).skew()) < 1e-9


def test_all_null_and_high_null(spark):
    df = spark.createDataFrame([(None, None, 1), (1.0, None, 2), (None, float("nan"), 3), (2.0, 3.0, 4)], "a double, b double, i int")
    assert sorted(r["i"] for r in FL.drop_all_null_rows(df, ["a", "b"]).collect()) == [2, 4]
    assert FL.drop_all_null_rows(df, []).count() == 0
    assert FL.drop_all_null_rows(df, [], on_empty="skip").count() == 4
    rows = [(None if i < 6 else 1.0, None if i < 7 else 1.0) for i in range(10)]  # 60 % and 70 % nulls
    hn = spark.createDataFrame(rows, "a double, b double")
    _, dropped = FL.drop_high_null_columns(hn, 60.0)
    assert dropped == ["b"]


def test_user_rank_and_subindustry_flags(spark):
    df = spark.createDataFrame([("Very Low",), ("Low",), ("Medium",), ("High",), ("Very High",), (None,)], "users_prob_sale string")
    out = FE.UserRankFlags().transform(df).collect()
    assert [tuple(r) for r in out] == [(1, 0, 0, 0, 0), (0, 1, 0, 0, 0), (0, 0, 1, 0, 0), (0, 0, 0, 1, 0), (0, 0, 0, 0, 1), (0, 0, 0, 0, 0)]
    sub = spark.createDataFrame([("Residential Building Construction",), ("Heavy Construction",), ("other",), (None,)], "sub_industry string")
    r = FE.SubIndustryFlags().transform(sub).collect()
    assert r[0]["sub_industry_residential_construction"] == 1 and r[0]["sub_industry_construction"] == 1 and r[0]["sub_industry_Other"] == 0
    assert r[1]["sub_industry_construction"] == 1 and r[1]["sub_industry_Other"] == 1
    assert r[3]["sub_industry_Other"] == 1


def test_rule_model_unit(spark):
    ages = [11.0, 12.0, 17.0, 17.5, 18.0, None]
    revs = [119999.0, 120000.0, None]
    legal = ["LLC", "Corporation", "Other", None]
    rows = [(a, r, l, 1 if (a or 0) >= 18 else 0) for a in ages for r in revs for l in legal]
    df = spark.createDataFrame(rows, "age_of_business_months double, application_annual_revenue double, "
                                     "business_legal_structure string, y int")
    s = MD.RuleModel(label="y").fit(df).transform(df).collect()
    for r in s:
        a, rev, l = r["age_of_business_months"], r["application_annual_revenue"], r["business_legal_structure"]
        valid = l is not None and l.lower() in MD.VALID_LEGAL
        if a is not None and a == 17.5 and valid:
            assert r["rule_id"] is None and r["p"] == 0.0
        if not valid:
            assert r["rule_id"] == 0
        if valid and a == 18.0 and rev == 120000.0:
            assert r["rule_id"] == 3 and r["p"] == 1.0 and r["prediction"] == 1
        if valid and a is not None and a >= 12 and rev is None:
            assert r["rule_id"] is None


def test_folds_limits(spark):
    base = dt.date(2024, 1, 1)
    def frame(ndates, per_day=2):
        return spark.createDataFrame([(base + dt.timedelta(days=i),) for i in range(ndates) for _ in range(per_day)], "d date")
    assert V.time_series_folds(frame(97), "d").count() == 1
    assert V.time_series_folds(frame(96), "d").count() == 0
    f = V.time_series_folds(frame(97, per_day=1), "d", min_train=10, min_test=8).collect()
    assert len(f) == 0  # 7 test rows < 8
    rows = V.time_series_folds(frame(120), "d", step=7).collect()
    assert all(r["train_to"] < r["test_from"] for r in rows)


def test_weighted_mean_missing_metric(spark):
    m = spark.createDataFrame([("a", "auc", 0.5, 10.0), ("a", "auc", None, 30.0), ("a", "auc", 0.8, 20.0)],
                              "model string, metric string, value double, weight double")
    got = V.weighted_metric_avg(m).first()["weighted_avg"]
    assert abs(got - (0.5 * 10 + 0.8 * 20) / 30) < 1e-12


def test_metrics_vs_sklearn_formulas(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 200)
    p = np.round(rng.random(200), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    # Mann-Whitney AUC with ties
    pos, neg = p[y == 1], p[y == 0]
    auc = sum((pp > neg).sum() + 0.5 * (pp == neg).sum() for pp in pos) / (len(pos) * len(neg))
    assert abs(M.roc_auc(df).first()[0] - auc) < 1e-12
    eps = np.finfo(float).eps
    pc = np.clip(p, eps, 1 - eps)
    ll = -np.mean(y * np.log(pc) + (1 - y) * np.log(1 - pc))
    assert abs(M.log_loss(df).first()[0] - ll) < 1e-9
    r = M.regression_errors(df).first()
    assert abs(r["rmse"] - np.sqrt(np.mean((y - p) ** 2))) < 1e-12
    assert abs(r["r2"] - (1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-9


def test_one_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, p double")
    assert M.roc_auc(df).first()[0] is None


def test_field_value_stats_null_label(spark):
    df = spark.createDataFrame([("x", 1, 1, 0), (None, 2, 1, 1), (None, 0, 0, 0)], "f string, leads int, qls int, sales int")
    out = {r["f"]: r for r in A.field_value_stats(df, "f").collect()}
    assert out["NULL"]["total_leads"] == 2 and out["NULL"]["avg_l2s_rate"] == 0.5
