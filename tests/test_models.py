"""Models and modelling plumbing on a small frame derived from the fixture tables."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from enrichlab.operators import features as FE
from enrichlab.operators import models as MD
from enrichlab.operators import validate as V
from enrichlab.plans import registry as REG
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def mf(spark):
    return REG.model_frame(spark, SF_SMALL).withColumn(
        "row_key", F.concat_ws("|", "channel_click_id", "visit_iid", "product_name", "company", "country_code")).persist()


def test_named_pipelines_fit_and_score(spark, mf):
    pipes = MD.named_pipelines(label="label", trees=20)
    assert len(pipes) == 7
    for name in ("rule_model", "baseline_psale", "user_rank_only"):
        model = pipes[name].fit(mf)
        s = V._with_p(model.transform(mf))
        assert s.filter(F.col("p").isNull()).count() == 0
        assert 0.0 <= s.agg(F.min("p")).first()[0] <= s.agg(F.max("p")).first()[0] <= 1.0


def test_soft_voting_and_importance(spark, mf):
    prep = Pipeline(stages=FE.auto_preprocessor(["normalized_p_cr_sale", "normalized_p_cr_lead"], ["network"])).fit(mf)
    x = prep.transform(mf)
    m1 = MD.logistic(n=100, labelCol="label", max_iter=20).fit(x)
    m2 = MD.random_forest(num_trees=5, max_depth=3, labelCol="label").fit(x)
    v = MD.soft_voting(x, [m1, m2])
    assert v.filter(F.col("p").isNull()).count() == 0
    imp = MD.feature_importance(m2, [f"f{i}" for i in range(len(m2.featureImportances))], spark)
    assert imp.count() == len(m2.featureImportances)
    pipe = Pipeline(stages=[prep, m1]).fit(mf)
    pi = MD.permutation_importance(lambda x: V._with_p(pipe.transform(x)), mf, ["normalized_p_cr_sale", "network"], "label", repeats=3).collect()
    assert {r.feature for r in pi} == {"normalized_p_cr_sale", "network"} and all(r.importance_std >= 0 for r in pi)
    ignored = MD.permutation_importance(lambda x: V._with_p(pipe.transform(x)), mf, ["company"], "label", repeats=2).first()
    assert ignored.importance_mean == 0 and ignored.importance_std == 0


@pytest.mark.parametrize("n", [1, 2, 97, 100])
def test_permutation_is_global_and_complete(spark, n):
    from enrichlab.operators import windows as W

    df = spark.createDataFrame([(i, i * 10, None if i == 3 else f"v{i}") for i in range(n)], "k int, v int, s string").repartition(5)
    a, b = W.affine_key(n, 2)
    for parts in (1, 7):
        got = {r.k: r.v for r in W.permuted_column(df.repartition(parts), "v", "k", 2).collect()}
        assert got == {(a * i + b) % n: i * 10 for i in range(n)}
    assert sorted(r.s or "" for r in W.permuted_column(df, "s", "k", 1).collect()) == sorted(f"v{i}" if i != 3 else "" for i in range(n))


def test_split_by_ratio_stable(spark, mf):
    tr, te = V.split_by_ratio(mf, "row_key", 0.2, seed=7)
    n, a, b = mf.count(), tr.count(), te.count()
    assert a + b == n and 0.1 < b / n < 0.3
    tr2, te2 = V.split_by_ratio(mf.repartition(3), "row_key", 0.2, seed=7)
    assert sorted(r[0] for r in te.select("row_key").collect()) == sorted(r[0] for r in te2.select("row_key").collect())


def test_get_best_model_direction(spark):
    m = spark.createDataFrame([("a", 0.7, 0.4), ("b", 0.8, 0.5)], "model string, roc_auc double, rmse double")
    assert V.get_best_model(m, "roc_auc").first()["model"] == "b"
    assert V.get_best_model(m, "rmse").first()["model"] == "a"


def test_one_join_deals_all_columns(spark):
    """Every column gets what ``permuted_column`` deals to it alone, from one join."""
    from enrichlab.operators import windows as W

    df = spark.createDataFrame([(i * 3, float(i), f"s{i}" if i % 5 else None) for i in range(101)], "k long, v double, s string").repartition(3)
    numbered = W.row_numbers(df, ["k"], "__i")
    both = W.permuted_values(numbered, ["v", "s"], 4)
    assert str(both._jdf.queryExecution().optimizedPlan()).count("Join Inner") == 1
    got = {r["k"]: (r["__value0"], r["__value1"]) for r in both.collect()}
    v, s = ({r["k"]: r[c] for r in W.permuted_column(df, c, "k", 4).collect()} for c in ("v", "s"))
    assert got == {k: (v[k], s[k]) for k in v} and len(got) == 101 and any(got[k][0] != k / 3 for k in got)
    assert W.permuted_values(numbered.limit(0), ["v", "s"]).count() == 0


def test_rule_of_typed_numbers_is_not_parsed(spark):
    """Doubles and integers are compared as they are, with the rules that their text would give; text is still parsed."""
    values = [None, float("nan"), float("inf"), -0.0, 0.1, 11.999999999999998, 12.0, 17.0, 17.5, 18.0, 1e300, 119999.99999999999, 120000.0]
    rows = [(a, r, legal) for a in values for r in values for legal in ("LLC", "sole", None)]
    df = spark.createDataFrame(rows, "a double, r double, legal string")
    typed, parsed = MD.rule_id_expr("a", "r", "legal", df), MD.rule_id_expr("a", "r", "legal")
    assert df.filter(~typed.eqNullSafe(parsed)).count() == 0
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rlike" not in plan(df.select(typed)) and "rlike" in plan(df.select(parsed))
    whole = df.selectExpr("try_cast(a as long) a", "try_cast(r as int) r", "legal")
    assert whole.filter(~MD.rule_id_expr("a", "r", "legal", whole).eqNullSafe(MD.rule_id_expr("a", "r", "legal"))).count() == 0
    text = df.selectExpr("concat(' ', cast(a as string)) a", "cast(r as string) r", "legal")
    assert "rlike" in plan(text.select(MD.rule_id_expr("a", "r", "legal", text)))


def test_score_table_is_each_models_own_row_in_one_set_of_jobs(spark, monkeypatch):
    """Ties, nulls, one class only, a constant score and a model without rows."""
    from enrichlab.operators import metrics as M

    def frame(rows):
        return spark.createDataFrame(rows, "y double, p double, leads int, key string").repartition(3)

    rows = [(float(i % 3 == 0), ((i * 37) % 50) / 50, i % 4, f"k{i}") for i in range(120)]
    scored = {"a": frame(rows), "b": frame([(0.0, p, n, k) for _, p, n, k in rows]), "c": frame([(y, 0.25, n, k) for y, _, n, k in rows]),
              "d": frame([(y, None if i % 7 == 0 else p, n, k) for i, (y, p, n, k) in enumerate(rows)]), "e": frame([])}
    for leads, key in ((None, None), ("leads", "key")):
        want = {m: M.score_row(df, model=m, leads=leads, row_key=key).first() for m, df in scored.items()}
        calls = []
        with monkeypatch.context() as patch:
            patch.setattr(M, "roc_auc", lambda *a, **k: pytest.fail("a set of jobs per model"))
            patch.setattr(M, "grouped_scores", lambda *a, f=M.grouped_scores, **k: calls.append(1) or f(*a, **k))
            got = {r.model: r for r in M.score_table(scored, leads=leads, row_key=key).collect()}
        assert len(calls) == 1 and list(got) == list(scored)
        for m, w in want.items():
            assert got[m].asDict() == pytest.approx(w.asDict(), nan_ok=True)


def test_forest_estimator_is_the_forest_of_its_rows(spark, monkeypatch):
    """Probabilities, classes and importances of a forest on few code vectors, the vectors being all that its trees grow on."""
    from pyspark.ml.feature import VectorAssembler

    from enrichlab.operators import boosting as BO

    df = spark.range(6000).select((F.col("id") % 37 / 37).alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.pmod(F.xxhash64("id"), F.lit(10)) < F.col("id") % 37 / 4).cast("double").alias("label"), "id").repartition(4)
    x = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    monkeypatch.setattr(BO, "VECTOR_ROWS", 0)
    monkeypatch.setattr(BO, "LOCAL_ROWS", 0)
    monkeypatch.setattr(BO.fit, "__defaults__", (0,))
    monkeypatch.setattr(BO, "_spread_trees", lambda *a: pytest.fail("a job per level"))
    model = MD.random_forest(num_trees=30, max_depth=6, labelCol="label").fit(x)
    out = model.transform(x)
    assert {"rawPrediction", "probability", "prediction"} <= set(out.columns)
    r = out.groupBy("a").agg(F.avg(F.element_at(MD.vector_to_array("probability"), 2)).alias("p"), F.avg("label").alias("y"), F.max("prediction").alias("c")).collect()
    assert len(r) == 37 and all(abs(z.p - z.y) < 0.15 and z.c in (0.0, 1.0) for z in r)
    imp = model.featureImportances.toArray()
    assert imp[0] > 0.8 and sum(imp) == pytest.approx(1)
    voted = MD.soft_voting(x, [model, model])
    assert voted.filter(F.col("p").isNull()).count() == 0 and set(voted.columns) == {*x.columns, "p"}
