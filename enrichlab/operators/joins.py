"""Joins.

Every join in the workload has a side made unique per key by a GROUP BY / DISTINCT first, so
fan-out stays bounded.  No join is forced to broadcast: AQE converts a join to broadcast only
after measuring the built side at runtime (``autoBroadcastJoinThreshold``), and splits skewed
partitions of sort-merge joins (``skewJoin``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys_cond(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], null_safe=False) -> Column:
    conds = [(left[a].eqNullSafe(right[b]) if null_safe else (left[a] == right[b])) for a, b in pairs]
    return reduce(lambda x, y: x & y, conds)


def join_left_then_filter_right(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], right_pred: Column
) -> DataFrame:
    """LEFT JOIN then a WHERE on right-side columns: null-rejecting, so Catalyst's
    EliminateOuterJoin plans it as an inner join."""
    return left.join(right, _keys_cond(left, right, pairs), "left").filter(right_pred)


def join_on_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str) -> DataFrame:
    return left.join(right, _keys_cond(left, right, pairs), how)


def join_left_2key(left, right, pairs):
    return join_on_keys(left, right, pairs, "left")


def join_inner_2key(left, right, pairs, post_filter: Column | None = None):
    out = join_on_keys(left, right, pairs, "inner")
    return out.filter(post_filter) if post_filter is not None else out


def join_inner_3key(left, right, pairs):
    return join_on_keys(left, right, pairs, "inner")


def join_left_map(left: DataFrame, map_df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Left join to a DISTINCT id map."""
    m = map_df.distinct()
    return left.join(m, _keys_cond(left, m, pairs), "left")


def join_equi_range_inner(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], left_day: str, right_day: str
) -> DataFrame:
    """``l.key = r.key AND l.day >= r.day``: an equi-join with a residual predicate
    (hash/sort-merge on the key, the range checked per matched pair)."""
    return left.join(right, _keys_cond(left, right, pairs) & (left[left_day] >= right[right_day]), "inner")


def join_equi_range_left_latest(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    left_day: str,
    right_day: str,
    latest: Column | None = None,
) -> DataFrame:
    """``left LEFT JOIN right ON key AND right.day >= left.day AND latest-flag``: every
    condition sits in ON, so a left row gets the latest right row or nulls, never an older
    one.  The flag is a right-only predicate, so it is applied to the right side first."""
    r = right.filter(latest) if latest is not None else right
    return left.join(r, _keys_cond(left, r, pairs) & (r[right_day] >= left[left_day]), "left")


def join_full_outer_compare(
    a: DataFrame, b: DataFrame, key: str, measures: Sequence[str], suffixes=("_x", "_y")
) -> DataFrame:
    """Full outer join on ``key`` (null keys match each other, as in pandas merge) with
    suffixed measures, keeping rows where any measure differs null-safely.  Both inputs are
    expected unique per key (reconcile per-key aggregates, as ``frames_reconcile`` callers do):
    then every key - the null key included - pairs at most one row per side."""
    sa, sb = suffixes
    a2 = a.select(F.col(key).alias("__ka"), *[F.col(m).alias(m + sa) for m in measures])
    b2 = b.select(F.col(key).alias("__kb"), *[F.col(m).alias(m + sb) for m in measures])
    j = a2.join(b2, a2["__ka"].eqNullSafe(b2["__kb"]), "full_outer")
    differs = reduce(lambda x, y: x | y, [~F.col(m + sa).eqNullSafe(F.col(m + sb)) for m in measures])
    return j.select(F.coalesce("__ka", "__kb").alias(key), *[F.col(m + s) for m in measures for s in (sa, sb)]).filter(differs)


def semi_join_keys(df: DataFrame, keys_df: DataFrame, key: str, keys_key: str | None = None) -> DataFrame:
    k = keys_df.select(F.col(keys_key or key).alias("__k"))
    return df.join(k, df[key] == k["__k"], "left_semi")


def join_many_outer_reduce(df: DataFrame, key: str, aggs: Sequence[Column]) -> DataFrame:
    """Re-aimed: the reference outer-joins one small frame per column on ``key``; that is one
    ``groupBy(key).agg(*all)`` here - one shuffle, no joins."""
    return df.groupBy(key).agg(*aggs)


def join_self_lookup_by_index(scored: DataFrame, full: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Re-attach columns of the full rows to a scored subset by its row key.  (The reference
    re-indexes a test split back into the full frame; keeping the key through the pipeline
    makes this a many-to-one equi-join on a unique key.)"""
    extra = full.select(key, *[c for c in cols if c not in scored.columns])
    return scored.join(extra, key, "left")
