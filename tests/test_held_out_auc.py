"""Held-out ranks of many logistic fits at once."""

import numpy as np
from pyspark.sql import functions as F

from enrichlab.operators import linear as L
from enrichlab.operators import metrics as M
from enrichlab.operators import validate as V


def _frame(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.integers(0, 6)), None if i % 50 == 0 else float("nan") if i % 61 == 0 else float(rng.normal()), None if i % 41 == 0 else float(rng.random() < 0.3 + 0.1 * (i % 3)), i % 3) for i in range(1500)]
    return spark.createDataFrame(rows, "id int, a double, b double, y double, s int")


def test_auc_of_every_fit_is_exact_however_many_ranges(spark, monkeypatch):
    df = _frame(spark)
    fits = {0: (0, [0.1, 0.5, 0.0]), 1: (1, [0.0, 1.0, -0.3]), 2: (2, [0.0, 0.0, 0.0]), 3: (0, [-900.0, 300.0, 0.0]), 4: (7, [0.0, 1.0, 1.0])}
    table = spark.createDataFrame([(f, s, c) for f, (s, c) in fits.items()], "fit int, s int, coef array<double>")
    scored = df.join(F.broadcast(table), "s").select("fit", "y", (1 / (1 + F.exp(-L.linear_score(F.col("coef"), L.feature_array(["a", "b"]))))).alias("p"))
    wanted = {r.fit: r.roc_auc for r in M.grouped_scores(scored, ["fit"]).collect()} | {4: None}
    for rows in (500_000, 40):
        monkeypatch.setattr(L, "AUC_ROWS", rows)
        found = {r.fit: r.roc_auc for r in L.held_out_auc(df, ["a", "b"], "y", "s", fits).collect()}
        assert found.keys() == wanted.keys()
        assert all(found[f] == wanted[f] if wanted[f] is None else abs(found[f] - wanted[f]) < 1e-12 for f in wanted)


def test_search_scores_every_draw(spark):
    df = _frame(spark).filter("b is not null and not isnan(b)").withColumn("key", F.col("id").cast("string"))
    out = V.search_logistic(df, ["a", "b"], "y", "key", n_iter=4)
    assert sorted(r.draw for r in out.collect()) == [0, 1, 2, 3] and out.filter("mean_score is null").count() == 0
