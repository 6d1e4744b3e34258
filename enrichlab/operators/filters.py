"""Projections, filters and predicates.

Every function takes column names as parameters and decides "is this column present?" from the
schema at plan-build time (driver-side, touches no data).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from enrichlab.functions import scalars as S


def filter_equals(df: DataFrame, c: str, value) -> DataFrame:
    return df.filter(F.col(c) == F.lit(value))


def filter_in_list(df: DataFrame, c: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(c).isin(list(values)))


def filter_partition_ge(df: DataFrame, c: str, value: str) -> DataFrame:
    """Lexicographic compare on a string partition ('2025-01'); stays a PartitionFilter."""
    return df.filter(F.col(c) >= F.lit(value))


def filter_partition_between(df: DataFrame, c: str, lo: str, hi: str) -> DataFrame:
    return df.filter(F.col(c).between(F.lit(lo), F.lit(hi)))


def filter_date_between(df: DataFrame, c: str, lo: str, hi: str) -> DataFrame:
    return df.filter(F.col(c).between(F.to_date(F.lit(lo)), F.to_date(F.lit(hi))))


def filter_like(df: DataFrame, c: str, pattern: str) -> DataFrame:
    """SQL ``LIKE``; a pattern without wildcards is plain equality."""
    return df.filter(F.col(c).like(pattern))


def filter_not_equal_marker(df: DataFrame, c: str, marker: str = "-") -> DataFrame:
    """``c <> marker``: also drops nulls (three-valued logic)."""
    return df.filter(F.col(c) != F.lit(marker))


def filter_or_groups(df: DataFrame, groups: Sequence[Sequence[Column]]) -> DataFrame:
    """(A and B) or (C and D) ...: each group is AND-ed, groups are OR-ed."""
    pred = None
    for g in groups:
        conj = None
        for p in g:
            conj = p if conj is None else (conj & p)
        pred = conj if pred is None else (pred | conj)
    return df.filter(pred)


def filter_min_leads(df: DataFrame, leads: str = "leads_count", n: int = 1) -> DataFrame:
    return df.filter(F.col(leads) >= n)


def drop_all_null_rows(df: DataFrame, cols: Sequence[str], on_empty: str = "none") -> DataFrame:
    """Drop rows where every listed (present) column is null or NaN.  With no columns:
    ``on_empty='none'`` returns no rows, ``'skip'`` returns the input unchanged."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df.filter(F.lit(False)) if on_empty == "none" else df
    return df.na.drop(how="all", subset=present)


def drop_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.na.drop(how="any", subset=present) if present else df


def null_pct_row(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Null share (in %) of each column, from ONE aggregate; returns a small dict (one value
    per column, bounded by the schema, never by the data)."""
    if not cols:
        return {}
    row = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(_is_missing(df, c)).alias(c) for c in cols],
    ).first()
    n = row["__n"] or 0
    return {c: (100.0 * row[c] / n if n else 0.0) for c in cols}


def _is_missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, NumericType) and dt.typeName() in ("double", "float"):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def drop_high_null_columns(
    df: DataFrame, max_pct: float = 60.0, keep: Sequence[str] = ("p_sale",), cols: Sequence[str] | None = None
) -> tuple[DataFrame, list[str]]:
    """Drop columns whose null share is strictly above ``max_pct``; ``keep`` is exempt."""
    cands = [c for c in (cols if cols is not None else df.columns) if c in df.columns and c not in keep]
    pct = null_pct_row(df, cands)
    dropped = [c for c in cands if pct[c] > max_pct]
    return df.drop(*dropped), dropped


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Ordered keep-list intersected with the present columns."""
    seen, out = set(), []
    for c in cols:
        if c in df.columns and c not in seen:
            out.append(c)
            seen.add(c)
    return df.select(*out)


def drop_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns (booleans and datetimes excluded, as NumPy's np.number)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)
            and not isinstance(f.dataType, BooleanType)]


def select_numeric(df: DataFrame) -> DataFrame:
    cols = numeric_columns(df)
    return df.select(*cols) if cols else df.select().limit(0)


def rename_column(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def null_to_label(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: S.null_to_label(c, lab) for c, lab in labels.items() if c in df.columns})


def zero_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: S.zero_to_null(c) for c in cols if c in df.columns})


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.na.fill(0, subset=present) if present else df


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: S.coerce_numeric(c) for c in cols if c in df.columns})


def coerce_timestamp_utc(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: S.coerce_timestamp_utc(c) for c in cols if c in df.columns})


def non_finite_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: S.non_finite_to_null(c) for c in cols if c in df.columns})


def label_threshold(df: DataFrame, c: str, t: float, out: str) -> DataFrame:
    return df.withColumn(out, S.label_threshold(c, t))
