"""Window-style operators, sorts, limits and DISTINCT.

Scale rules used here:
* "min over a partition" is a grouped aggregate joined back on the key: the aggregate is
  partially combined map-side, and the join is many-to-one (AQE splits a skewed key).
* "latest row per key" (``row_number() = 1``) is ``max(struct(order..., row))`` per key: a
  partial aggregate, so a key holding a third of the rows never lands whole in one task.
* a global running sum uses ``global_prefix`` (range buckets + per-bucket offsets), never a
  ``Window.orderBy`` without ``partitionBy``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def min_over_partition(df: DataFrame, keys: Sequence[str], value: str, out: str, reuse: str = "table") -> DataFrame:
    """``min(value) over (partition by keys)`` as aggregate + null-safe join back.

    The input feeds two branches (the rows and their per-key minimum); ``reuse='table'``
    materializes it once under the checkpoint folder so both branches read it instead of
    recomputing the upstream scans and joins (``'none'`` recomputes).  A window would need
    every row of a hot key in one task; the aggregate is combined map-side and AQE splits a
    hot key in the join."""
    from enrichlab.session import materialize

    df = materialize(df, reuse)
    aliases = {k: f"__k{i}" for i, k in enumerate(keys)}
    m = df.groupBy(*[F.col(k).alias(a) for k, a in aliases.items()]).agg(F.min(value).alias(out))
    cond = None
    for k, a in aliases.items():
        c = df[k].eqNullSafe(m[a])
        cond = c if cond is None else cond & c
    return df.join(m, cond, "inner").drop(*aliases.values())


def min_version_over_visit(df: DataFrame, visit: str = "en_visit_iid", version: str = "rn", out: str = "min_rn") -> DataFrame:
    return min_over_partition(df, [visit], version, out)


def min_version_over_subid(df: DataFrame, subid: str = "subid", version: str = "rn", out: str = "min_rn") -> DataFrame:
    return min_over_partition(df, [subid], version, out)


def row_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """``row_number() over (partition by keys order by ...)`` kept as a column (the order must
    be total for determinism: pass a tie-break).  Every row of a key is sorted in one task:
    use ``skew_safe_row_number`` when a key can hold a large share of the rows."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def skew_safe_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]], out: str,
                         buckets: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by c1 [desc] nulls last, ...)`` without
    putting a key in one task.  Rows are range-bucketed on (keys, order) - a hot key is cut
    into several buckets - and ranked by a window over (bucket, key).  A key's rows are
    contiguous in that order, so a key that continues from earlier buckets only needs a carry:
    the number of its rows in those buckets.  The carries come from one aggregate per bucket
    (first key, last key, rows of the last key, total: at most ``buckets`` rows to the driver).
    ``order`` is a list of (column, ascending); descending works for numeric, date and
    timestamp columns (negated), nulls sort last; the order must be total."""
    from enrichlab.operators.binning import with_range_bucket
    from enrichlab.session import materialize

    sort_cols, tmp = list(keys), {}
    for i, (c, asc) in enumerate(order):
        dt = df.schema[c].dataType.typeName()
        nul, val = f"__o{i}_null", f"__o{i}_v"
        tmp[nul] = F.col(c).isNull().cast("int")
        if asc:
            tmp[val] = F.col(c)
        elif dt.startswith("timestamp"):
            tmp[val] = -F.unix_micros(F.col(c).cast("timestamp"))
        elif dt == "date":
            tmp[val] = -F.unix_date(F.col(c))
        elif dt in ("string", "binary", "boolean"):
            raise NotImplementedError(f"descending order on {dt} column {c}")
        else:
            tmp[val] = -F.col(c)
        sort_cols += [nul, val]
    x = materialize(df.withColumns(tmp))  # read by the sample, the bucket summary and the ranking pass
    x = with_range_bucket(x, sort_cols, "__b", buckets)
    key = F.struct(*[F.col(k) for k in keys])
    per_key = x.groupBy("__b", key.alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    summ = per_key.groupBy("__b").agg(
        F.min("__k").alias("first"), F.max("__k").alias("last"), F.max_by("__n", "__k").alias("last_n"),
        F.sum("__n").alias("total")).collect()  # <= buckets rows
    carry, open_key, run = {}, None, 0
    for r in sorted(summ, key=lambda r: r["__b"]):
        first, last = tuple(r["first"]), tuple(r["last"])
        carry[r["__b"]] = (first, run if first == open_key else 0)
        if first == last:
            run, open_key = (run if first == open_key else 0) + r["total"], last
        else:
            run, open_key = r["last_n"], last
    types = [df.schema[k].dataType for k in keys]
    nothing = (tuple(None for _ in keys), 0)
    by_bucket = [carry.get(b, nothing) for b in range(max(carry, default=-1) + 1)] or [nothing]
    firsts = F.array(*[F.struct(*[F.lit(v).cast(t).alias(k) for v, t, k in zip(first, types, keys)]) for first, _ in by_bucket])
    carries = F.array(*[F.lit(c) for _, c in by_bucket])
    at = F.col("__b") + 1
    add = F.when(key.eqNullSafe(F.element_at(firsts, at)), F.element_at(carries, at)).otherwise(0)
    w = Window.partitionBy("__b", *keys).orderBy(*[F.col(c).asc_nulls_first() for c in sort_cols[len(keys):]])
    return x.withColumn(out, (F.row_number().over(w) + add).cast("int")).drop("__b", *tmp)


def latest_click_rank(df: DataFrame, key: str = "visit_iid", ts: str = "clickout_timestamp",
                      tiebreak: Sequence[str] = ("channel_click_id",), out: str = "click_rank",
                      skew_safe: bool = True) -> DataFrame:
    """Rank of each click within its visit, latest first (nulls last), ties by ``tiebreak``."""
    if skew_safe:
        return skew_safe_row_number(df, [key], [(ts, False), *[(t, True) for t in tiebreak]], out)
    return row_rank(df, [key], [F.col(ts).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tiebreak]], out)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str], payload: Sequence[str] | None = None) -> DataFrame:
    """The row ranked first by ``order`` DESC (nulls last, struct order) per key: the rows
    ``row_number() over (partition by key order by order desc) = 1`` keeps, with the order
    columns acting as tie-breaks.  A partial aggregate, skew-safe."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in (payload if payload is not None else df.columns) if c not in keys]
    rest = [c for c in payload if c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in payload])


def latest_attribute_rank(df: DataFrame, key: str = "subid", order: Sequence[str] = ("transaction_date",),
                           tiebreak: Sequence[str] = (), out: str = "rnn", skew_safe: bool = True) -> DataFrame:
    """``row_number() over (partition by key order by order desc nulls last, tiebreak desc nulls last)`` as a column; the order must be
    total.  Ranked the other way round by ``skew_safe_row_number``, which cuts a hot key into several tasks and needs no
    descending order of strings; a key's rows minus that rank, plus one, is the rank.
    To *filter* on rank 1 use ``latest_per_key`` (an aggregate, skew-safe)."""
    cols = list(dict.fromkeys((*order, *tiebreak)))
    if not skew_safe:
        return row_rank(df, [key], [F.col(c).desc_nulls_last() for c in cols], out)
    there = {f"__there{i}": F.col(c).isNotNull().cast("int") for i, c in enumerate(cols)}
    x = skew_safe_row_number(df.withColumns(there), [key], [(n, True) for pair in zip(there, cols) for n in pair], "__asc")
    rows = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).cast("int").alias("__rows"))
    j = x.join(rows, x[key].eqNullSafe(rows["__key"]))
    return j.withColumn(out, F.col("__rows") - F.col("__asc") + 1).drop("__key", "__rows", "__asc", *there)


def duplicate_flags(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of 2nd+ occurrences: ``count(*) - count(distinct keys)`` (null keys included)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("duplicates"),
    )


def top_k_by(df: DataFrame, c: str, k: int, tiebreak: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """Sort + limit -> TakeOrderedAndProject (per-task top-k, then merge): no full sort."""
    o = F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last()
    return df.orderBy(o, *[F.col(t) for t in tiebreak]).limit(k)


def order_by_first_col_desc(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col(df.columns[0]).desc_nulls_last())


def order_categories_by_frequency(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), F.col(c))


def sort_bins_by_left_edge(df: DataFrame, edge: str) -> DataFrame:
    """NULL bin first, then by the interval's numeric left edge."""
    return df.orderBy(F.col(edge).asc_nulls_first())


def sample_ids_by_presence(df: DataFrame, id_col: str, c: str, present: bool, k: int = 10) -> DataFrame:
    p = F.col(c).isNotNull() if present else F.col(c).isNull()
    return df.filter(p).select(id_col).distinct().orderBy(id_col).limit(k)


def rank_models(metrics: DataFrame, by: str, ascending: bool) -> DataFrame:
    o = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return metrics.orderBy(o)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def running_leads(df: DataFrame, order: Sequence[str], leads: str, out: str = "leads_before",
                  buckets: int | None = None) -> DataFrame:
    """Leads of all rows strictly before each row in the global order ``order`` (exclusive
    prefix sum), computed with ``global_prefix`` - distributed, no single-task window."""
    from enrichlab.operators.binning import global_prefix

    from enrichlab.session import materialize

    return global_prefix(materialize(df), list(order), {out: F.col(leads)}, inclusive=False, buckets=buckets)


def row_numbers(df: DataFrame, order: Sequence[str], out: str, buckets: int | None = None) -> DataFrame:
    """0, 1, 2, ... in the global order ``order`` (ascending, nulls first), which must be total: range buckets, no
    single-task window."""
    from enrichlab.operators.binning import global_prefix
    from enrichlab.session import materialize

    x = global_prefix(materialize(df.withColumn("__one", F.lit(1))), list(order), {out: F.col("__one")}, inclusive=False, buckets=buckets)
    return x.drop("__one").withColumn(out, F.col(out).cast("bigint"))


def affine_key(n: int, seed: int) -> tuple[int, int]:
    """(a, b) of the bijection i -> (a i + b) mod n: a near the golden section of n, moved on by the seed to a number
    coprime to n, so that neighbours land far apart."""
    import math

    a = max(int(n * 0.6180339887498949), 1) + 7919 * seed
    while math.gcd(a, n) != 1:
        a += 1
    return a, (104729 * (seed + 1)) % max(n, 1)


def permuted_column(df: DataFrame, c: str, row_key: str, seed: int = 0, out: str | None = None, numbered: DataFrame | None = None) -> DataFrame:
    """``df`` with the values of ``c`` dealt to other rows by a global permutation: rows are numbered by ``row_key`` (unique), and
    row (a i + b) mod n gets the value of row i.  One join by number; a seed gives the same permutation whatever the
    partitions.  ``numbered`` is ``row_numbers(df, [row_key], "__i")`` where several permutations share it."""
    x = numbered if numbered is not None else row_numbers(df, [row_key], "__i")
    j = permuted_values(x, [c], seed)
    return j.withColumn(out or c, F.col("__value0")).select(*df.columns, *([out] if out and out not in df.columns else []))


def permuted_values(numbered: DataFrame, cols: Sequence[str], seed: int = 0, n: int | None = None) -> DataFrame:
    """``numbered`` with the values that ``permuted_column`` deals to each row, of all ``cols`` by one join, as ``__value0``,
    ``__value1``...: a seed's permutation is the same for every column.  ``n`` is the number of rows, where it is known."""
    n = numbered.count() if n is None else n
    if not n:
        return numbered.withColumns({f"__value{i}": F.col(c) for i, c in enumerate(cols)})
    a, b = affine_key(n, seed)
    moved = F.pmod(F.col("__i") * F.lit(a % n).cast("decimal(38,0)") + F.lit(b), F.lit(n)).cast("bigint")
    values = numbered.select(moved.alias("__i"), *[F.col(c).alias(f"__value{i}") for i, c in enumerate(cols)])
    return numbered.join(values, "__i")
