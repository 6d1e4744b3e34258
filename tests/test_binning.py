"""qcut parity, ties, nulls; global prefix and equal-leads bins vs plain loops; partition
invariance (SURVEY 5)."""

import random

import pandas as pd
from pyspark.sql import functions as F

from enrichlab.operators import binning as B
from enrichlab.operators import metrics as M


def test_qcut_ties(spark):
    vals = [0, 0, 0, 0, 1, 2, 3, 4, 4, 9]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, x double")
    out, edges = B.bin_quantile(df, "x", 5, "b")
    got = [r["b"] for r in out.orderBy("i").collect()]
    assert got == [0, 0, 0, 0, 1, 1, 2, 2, 2, 3]
    assert got == list(pd.qcut(pd.Series(vals, dtype=float), 5, labels=False, duplicates="drop"))


def test_qcut_nulls(spark):
    vals = [0.1, 0.2, None, 0.4, 0.5, 0.9]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    out, _ = B.bin_quantile(df, "x", 2, "b")
    assert [r["b"] for r in out.orderBy("i").collect()] == [0, 0, None, 0, 1, 1]


def test_qcut_constant_no_bin_and_zero_ece(spark):
    df = spark.createDataFrame([(i % 2, 0.3) for i in range(60)], "y int, p double")
    out, edges = B.bin_quantile(df, "p", 5, "b")
    assert len(edges) == 1
    assert out.filter(F.col("b").isNotNull()).count() == 0
    assert M.ece_quantile(df, "y", "p", 5).first()["ece"] == 0.0


def test_qcut_random_matches_pandas(spark):
    rng = random.Random(3)
    vals = [round(rng.random() * 20) / 2 for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    for q in (3, 5, 6):
        out, _ = B.bin_quantile(df, "x", q, "b")
        got = [r["b"] for r in out.orderBy("i").collect()]
        exp = list(pd.qcut(pd.Series(vals), q, labels=False, duplicates="drop"))
        assert got == exp


def test_exact_quantiles_match_pandas(spark):
    rng = random.Random(5)
    vals = [rng.randint(0, 50) * 1.5 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0, 0.1, 0.25, 0.5, 0.8, 0.9, 1]
    got = B.exact_quantiles(df, "x", probs, buckets=8)
    exp = list(pd.Series(vals).quantile(probs))
    assert all(abs(a - b) < 1e-9 for a, b in zip(got, exp))


def test_global_prefix_matches_cumsum(spark):
    rng = random.Random(7)
    rows = [(f"k{i:04d}", rng.choice([0.1, 0.2, 0.3, 0.5]), rng.randint(1, 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, s double, v int").repartition(5)
    out = B.global_prefix(df, ["s", "k"], {"before": F.col("v")}, inclusive=False, buckets=7)
    got = {r["k"]: r["before"] for r in out.collect()}
    run = 0
    for k, s, v in sorted(rows, key=lambda t: (t[1], t[0])):
        assert got[k] == run
        run += v


def _greedy_bins(leads, n):
    total = sum(leads)
    lpb = total / n
    cur, b, out = 0, 0, []
    for x in leads:
        if cur >= (b + 1) * lpb and b < n - 1:
            b += 1
        out.append(b)
        cur += x
    return out


def test_equal_leads_bins_unit(spark):
    leads = [1, 1, 50, 1, 1, 1]
    df = spark.createDataFrame([(f"r{i}", 0.1 * i, 0, x) for i, x in enumerate(leads)], "row_key string, p double, y int, leads int")
    got = [r["bin"] for r in M.equal_leads_bins(df, "y", "p", "leads", "row_key", 3).orderBy("pred").collect()]
    assert got == _greedy_bins(leads, 3)


def test_equal_leads_bins_random(spark):
    rng = random.Random(11)
    for trial in range(3):
        n = 200
        rows = [(f"r{i:04d}", rng.choice([0.1, 0.2, 0.25, 0.7, 0.9]), rng.randint(0, 1), rng.choice([1, 1, 1, 2, 7, 30]))
                for i in range(n)]
        df = spark.createDataFrame(rows, "row_key string, p double, y int, leads int")
        out = {r["row_key"]: r["bin"] for r in M.equal_leads_bins(df, "y", "p", "leads", "row_key", 10, buckets=6).collect()}
        ordered = sorted(rows, key=lambda t: (t[1], t[0]))
        exp = _greedy_bins([t[3] for t in ordered], 10)
        assert [out[t[0]] for t in ordered] == exp


def test_partition_invariance(spark):
    rng = random.Random(13)
    rows = [(f"r{i:04d}", rng.randint(0, 1), rng.choice([0.1, 0.3, 0.35, 0.6, 0.8]), rng.randint(1, 4)) for i in range(300)]
    base = spark.createDataFrame(rows, "row_key string, y int, p double, leads int")
    res = []
    for parts in (1, 3, 7):
        df = base.repartition(parts)
        res.append((M.roc_auc(df, "y", "p").first()[0], M.ece_quantile(df, "y", "p").first()[0],
                    M.ece_by_leads(df, "y", "p", "leads", "row_key").first()[0]))
    assert all(abs(a - b) < 1e-12 for r in res[1:] for a, b in zip(r, res[0]))


def test_grouped_exact_quantiles_hot_group(spark):
    rng = random.Random(17)
    rows = []
    for i in range(900):
        g = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((g, float(rng.randint(0, 40)) if rng.random() > 0.05 else None))
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    got = {r["g"]: (r["q1"], r["med"], r["q3"]) for r in
           B.grouped_exact_quantiles(df, ["g"], "x", [0.25, 0.5, 0.75], ["q1", "med", "q3"], buckets=6).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    for g, sub in pdf.groupby("g", dropna=False):
        key = None if (isinstance(g, float) and g != g) else g
        exp = list(sub["x"].dropna().quantile([0.25, 0.5, 0.75]))
        assert all(abs(a - b) < 1e-9 for a, b in zip(got[key], exp)), (key, got[key], exp)


def test_skew_safe_row_number_matches_window_with_hot_key(spark):
    import datetime as dt

    from pyspark.sql import Window

    from enrichlab.operators.windows import skew_safe_row_number

    rng = random.Random(23)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else f"k{rng.randint(0, 40)}"
        ts = None if rng.random() < 0.05 else base + dt.timedelta(seconds=rng.randint(0, 50))
        rows.append((key, ts, f"c{i:04d}"))
    df = spark.createDataFrame(rows, "k string, ts timestamp, c string")
    got = {r["c"]: r["rk"] for r in skew_safe_row_number(df, ["k"], [("ts", False), ("c", True)], "rk", buckets=5).collect()}
    w = Window.partitionBy("k").orderBy(F.col("ts").desc_nulls_last(), F.col("c").asc_nulls_last())
    exp = {r["c"]: r["rk"] for r in df.withColumn("rk", F.row_number().over(w)).collect()}
    assert got == exp


def test_partition_invariance_aqe_off(spark):
    rng = random.Random(29)
    rows = [(f"r{i:04d}", rng.randint(0, 1), rng.choice([0.2, 0.4, 0.45, 0.9]), rng.randint(1, 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_key string, y int, p double, leads int")
    on = (M.roc_auc(df).first()[0], M.ece_by_leads(df, "y", "p", "leads", "row_key").first()[0])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        off = (M.roc_auc(df.repartition(5)).first()[0],
               M.ece_by_leads(df.repartition(5), "y", "p", "leads", "row_key").first()[0])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert all(abs(a - b) < 1e-12 for a, b in zip(on, off))


def test_skew_safe_row_number_key_spanning_many_buckets(spark):
    from pyspark.sql import Window

    from enrichlab.operators.windows import skew_safe_row_number

    rng = random.Random(31)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 else rng.choice([None, "a", "b", "c"])
        rows.append((key, rng.randint(0, 30) if rng.random() > 0.1 else None, f"c{i:04d}"))
    df = spark.createDataFrame(rows, "k string, v int, c string")
    got = {r["c"]: r["rk"] for r in skew_safe_row_number(df, ["k"], [("v", False), ("c", True)], "rk", buckets=8).collect()}
    w = Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last(), F.col("c").asc_nulls_last())
    exp = {r["c"]: r["rk"] for r in df.withColumn("rk", F.row_number().over(w)).collect()}
    assert got == exp


def test_bucket_count_follows_the_rows(spark):
    from enrichlab.operators import binning as B

    df = spark.range(10)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert B.bucket_count(df, 10) == least
    assert B.bucket_count(df, 100 * B.ROWS_PER_BUCKET) == 100
    assert B.bucket_count(df, 5000 * B.ROWS_PER_BUCKET + 1) == 5001


def test_range_buckets_by_bisection(spark):
    """The same bucket as ``range_bucket_expr`` with few comparisons a row, all of them generated code."""
    import contextlib
    import io

    rng = random.Random(5)
    odd = [None, float("nan"), float("inf"), -0.0]
    rows = [(rng.choice(["", "a", "b", "\u00e9", None]), rng.choice(odd) if i % 7 == 0 else rng.random(), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "s string, p double, k long").repartition(3)
    for order, buckets in ((["s", "p", "k"], 200), (["p"], 4), (["k", "s"], 1), (["s"], 3)):
        x = B.with_range_bucket(df, order, "b", buckets).withColumn("old", B.range_bucket_expr(df, order, buckets))
        assert x.columns == ["s", "p", "k", "b", "old"]
        assert all(r.b == r.old for r in x.select("b", "old").collect())
    x = B.with_range_bucket(df, ["s", "p", "k"], "b", 200)
    assert x.select("b").distinct().count() > 150
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        x.explain()
    plan = buf.getvalue()
    assert "lambda" not in plan and plan.count("CASE WHEN") == 8
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        B.global_prefix(df, ["s", "p", "k"], {"before": F.lit(1)}, buckets=200).explain()
    assert "lambda" not in buf.getvalue()


def test_answers_do_not_depend_on_the_bucket_count(spark):
    import random

    from pyspark.sql import functions as F

    from enrichlab.operators import binning as B
    from enrichlab.operators import metrics as M
    from enrichlab.operators import windows as W

    rng = random.Random(2)
    rows = [(i, rng.choice([None, float("nan"), 0.5]) if i % 9 == 0 else rng.random(), rng.randrange(2), rng.randrange(4)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, p double, y int, leads int")
    seen = set()
    for buckets in (4, 64, 1024):
        pre = B.global_prefix(df, ["p", "k"], {"before": F.col("leads")}, buckets=buckets)
        rank = W.skew_safe_row_number(df, ["y"], [("k", True)], "r", buckets=buckets)
        seen.add((
            round(M.roc_auc(df, "y", "p", buckets=buckets).first()[0], 9),
            tuple(B.exact_quantiles(df, "p", [0.1, 0.5, 0.9], buckets=buckets)),
            pre.agg(F.sum(F.hash("k", "before"))).first()[0],
            rank.agg(F.sum(F.hash("k", "r"))).first()[0],
        ))
    assert len(seen) == 1


def test_nothing_is_left_in_the_checkpoint_folder(tmp_path):
    """A run in its own process leaves no intermediate behind when it ends."""
    import os
    import subprocess
    import sys

    code = (
        "from pyspark.sql import SparkSession\n"
        "from enrichlab.session import materialize\n"
        f"s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', '{tmp_path}').getOrCreate()\n"
        "assert materialize(s.range(5)).count() == 5\n"
        "s.stop()\n"
    )
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=repo, check=True, timeout=120, capture_output=True)
    assert not [p for p in os.listdir(tmp_path) if p.startswith("enrichlab-")]


def test_a_cluster_needs_a_checkpoint_folder():
    from types import SimpleNamespace

    import pytest

    from enrichlab.session import checkpoint_dir

    nothing = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=nothing, conf=SimpleNamespace(get=lambda *_: None)))
