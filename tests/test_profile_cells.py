"""Exact distinct counts by cells, and correlations from co-moments, against plain loops."""

import math
import random

import pytest

from enrichlab.operators import profile as P


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    wide = ["x" * 40 + str(i) for i in range(9)]
    return [(rng.choice(["a", "b", None]), rng.choice([0.0, -0.0, 1.5, float("nan"), None]), rng.choice([*wide, "short", "", None]), rng.randint(0, 400), None) for _ in range(900)]


@pytest.mark.parametrize("task_values", [1, 200_000])
def test_cells_equal_plain_sets(spark, rows, monkeypatch, task_values):
    monkeypatch.setattr(P, "TASK_VALUES", task_values)
    df = spark.createDataFrame(rows, "company string, f double, s string, n int, gone string").repartition(5)
    cols = ["f", "s", "n", "gone", "company"]
    at = {"company": 0, "f": 1, "s": 2, "n": 3, "gone": 4}

    def plain(part, c):
        values = [r[at[c]] for r in part]
        known = {("nan" if isinstance(v, float) and math.isnan(v) else v) for v in values if v is not None}
        return len(part), sum(v is None for v in values), len(known)

    got = {(r.by, r["all"], r.column): (r.rows, r.nulls, r.distinct) for r in P.column_facts(df, cols, "company").collect()}
    want = {(None, True, c): plain(rows, c) for c in cols}
    want |= {(k, False, c): plain([r for r in rows if r[0] == k], c) for k in ("a", "b", None) for c in cols}
    assert got == want
    assert {r.column: (r.rows, r.distinct) for r in P.schema_profile(df.filter("false")).collect()} == {c: (0, 0) for c in df.columns}


def test_correlations_equal_pairwise_complete_ones(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    data = pd.DataFrame({"a": rng.normal(1e6, 1, 400), "b": rng.normal(0, 1, 400), "c": 3.25, "d": rng.normal(0, 1, 400)})
    data["b"] += 0.5 * (data["a"] - 1e6)
    for c in ("a", "b", "d"):
        data.loc[rng.random(400) < 0.3, c] = np.nan
    data.loc[3:, "d"] = np.nan
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None).values.tolist(), "a double, b double, c double, d double").repartition(4)
    want = data.corr(min_periods=2)
    got = {(r.col_a, r.col_b): r["corr"] for r in P.correlation_matrix(df).collect()}
    assert len(got) == 16
    for x in data:
        for y in data:
            if "c" in (x, y) or math.isnan(want.loc[x, y]):
                assert got[x, y] is None
            else:
                assert got[x, y] == pytest.approx(want.loc[x, y], abs=1e-7)
