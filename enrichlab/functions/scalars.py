"""Column -> Column scalars and the null / NaN / inf rules (SURVEY 1.5).

Everything here is a built-in Catalyst expression, so it stays inside whole-stage codegen.
ANSI mode is on in Spark 4: plain ``/`` and ``cast`` raise, so the safe forms are used.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

INF = float("inf")


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- null / NaN / inf


def nan_to_null(c: ColumnOrName) -> Column:
    """pandas treats NaN as missing; Spark does not. Convert once, at ingest."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def non_finite_to_null(c: ColumnOrName) -> Column:
    """+-inf and NaN -> null."""
    c = col(c)
    return F.when(~(F.isnan(c) | c.isin(INF, -INF)), c)


def safe_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b with b == 0 (or null) -> null."""
    return F.try_divide(col(a), col(b))


def pandas_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Float division as NumPy does it: x/0 -> +-inf, 0/0 -> null (NaN is null here)."""
    a, b = col(a), col(b)
    return (
        F.when(a.isNull() | b.isNull(), None)
        .when((b == 0) & (a > 0), F.lit(INF))
        .when((b == 0) & (a < 0), F.lit(-INF))
        .when(b == 0, None)
        .otherwise(a.cast("double") / b)
    )


def clip(c: ColumnOrName, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp to [lo, hi]; null stays null (Spark's greatest/least skip nulls)."""
    c = col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


#: Text that counts as a number.
NUMERIC_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def coerce_numeric(c: ColumnOrName) -> Column:
    """Text or number -> double, unparsable -> null (pandas to_numeric(errors='coerce')).  A plain
    decimal only: Spark's cast alone would also take ``12d``, ``3f`` and ``0x1p3``."""
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike(NUMERIC_TEXT), nan_to_null(text.try_cast("double")))


def zero_to_null(c: ColumnOrName) -> Column:
    return F.nullif(col(c), F.lit(0))


def null_to_label(c: ColumnOrName, label: str) -> Column:
    return F.coalesce(col(c), F.lit(label))


def alias_coalesce(*cs: ColumnOrName) -> Column:
    return F.coalesce(*[col(c) if not isinstance(c, (int, float)) else F.lit(c) for c in cs])


def concat_columns(a: ColumnOrName, b: ColumnOrName, sep: str = "_") -> Column:
    """``a + '_' + b``: null if either side is null (so ``concat``, not ``concat_ws``)."""
    return F.concat(col(a), F.lit(sep), col(b))


def label_threshold(c: ColumnOrName, t: float) -> Column:
    return (col(c) >= F.lit(t)).cast("int")


def class_from_score(c: ColumnOrName, t: float = 0.5, strict: bool = True) -> Column:
    c = col(c)
    return (c > t if strict else c >= t).cast("int")


def sigmoid(c: ColumnOrName) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(c)))


def floor_div(c: ColumnOrName, n: float) -> Column:
    """Python ``//`` on floats: floor of the true quotient (Spark ``div`` truncates)."""
    return F.floor(col(c) / F.lit(float(n))).cast("double")


def str_contains(c: ColumnOrName, s: str) -> Column:
    """Case-sensitive substring test; null -> false."""
    return F.coalesce(col(c).cast("string").contains(s), F.lit(False))


def lower_isin(c: ColumnOrName, values: Iterable[str]) -> Column:
    return F.coalesce(F.lower(col(c)).isin([v.lower() for v in values]), F.lit(False))


def upper(c: ColumnOrName) -> Column:
    return F.upper(col(c))


def log1p(c: ColumnOrName) -> Column:
    """log1p; -1 -> -inf and < -1 -> null as NumPy (non-finite is nulled later anyway)."""
    c = col(c)
    return F.when(c == -1, F.lit(-INF)).when(c > -1, F.log1p(c))


def ln(c: ColumnOrName) -> Column:
    """Natural log; 0 -> -inf, negative -> null."""
    c = col(c)
    return F.when(c == 0, F.lit(-INF)).when(c > 0, F.ln(c))


# ---------------------------------------------------------------- buckets and labels

# The time-to-clickout bucket labels, exactly as the extract emits them.
TIME_BUCKET_LABELS = ("<10", "10=<Second<30", "30=<Second<60", ">=60")


def case_time_bucket(seconds: ColumnOrName) -> Column:
    """Seconds -> bucket label; null falls through to '>=60' (three-valued CASE)."""
    s = col(seconds)
    lt10, lt30, lt60, ge60 = TIME_BUCKET_LABELS
    return (
        F.when(s < 10, lt10)
        .when((s >= 10) & (s < 30), lt30)
        .when((s >= 30) & (s < 60), lt60)
        .otherwise(ge60)
    )


# Revenue tier cut-offs (on log1p revenue) and labels, lowest first.
REVENUE_TIER_EDGES = (10.309, 11.513, 12.073, 13.171)
REVENUE_TIER_LABELS = ("Low", "Low-Moderate", "Moderate", "High", "Premium")


def revenue_tier(c: ColumnOrName) -> Column:
    c = col(c)
    e1, e2, e3, e4 = REVENUE_TIER_EDGES
    l0, l1, l2, l3, l4 = REVENUE_TIER_LABELS
    return (
        F.when(c.isNull(), "Missing")
        .when(c <= e1, l0)
        .when(c <= e2, l1)
        .when(c <= e3, l2)
        .when(c <= e4, l3)
        .otherwise(l4)
    )


# Business-age groups in months.
AGE_GROUP_EDGES_MONTHS = (12, 24, 60, 120)
AGE_GROUP_LABELS = ("0-1yr", "1-2yr", "2-5yr", "5-10yr", "10yr+")


def age_group_months(c: ColumnOrName) -> Column:
    c = col(c)
    m1, m2, m3, m4 = AGE_GROUP_EDGES_MONTHS
    l0, l1, l2, l3, l4 = AGE_GROUP_LABELS
    return (
        F.when(c.isNull(), "Missing")
        .when(c <= m1, l0)
        .when(c <= m2, l1)
        .when(c <= m3, l2)
        .when(c <= m4, l3)
        .otherwise(l4)
    )


def bin_fixed_edges_expr(
    c: ColumnOrName, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = False
) -> Column:
    """Right-closed intervals (a, b] with labels (pandas ``cut``); outside -> null.

    ``include_lowest`` closes the first interval on the left too.  Not ``Bucketizer``,
    which is left-closed.
    """
    c = col(c)
    assert len(labels) == len(edges) - 1
    expr = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = ((c >= lo) if (i == 0 and include_lowest) else (c > lo)) & (c <= hi)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr


# ---------------------------------------------------------------- dates and times


def date_diff_seconds(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole seconds elapsed from ``start`` to ``end`` (truncating)."""
    return F.timestamp_diff("SECOND", col(start), col(end))


def prefix_to_date(c: ColumnOrName) -> Column:
    """``CAST(SUBSTRING(x, 1, 10) AS DATE)``; unparsable -> null."""
    return F.try_to_date(F.substring(col(c), 1, 10), "yyyy-MM-dd")


def regex_replace(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(col(c), pattern, replacement)


# Text timestamp formats tried in order (ISO 'T', ISO space, ISO with offset).
TS_FORMAT_ISO_T = "yyyy-MM-dd'T'HH:mm:ss"
TS_FORMAT_ISO_SPACE = "yyyy-MM-dd HH:mm:ss"
TS_FORMAT_ISO_OFFSET = "yyyy-MM-dd'T'HH:mm:ssXXX"
OFFSET_REPAIR = (r"([+-]\d{2})(\d{2})$", "$1:$2")


def parse_timestamp_flex(c: ColumnOrName, with_space: bool = True) -> Column:
    """First of: ISO-T on the first 19 chars, ISO-space (optional), ISO with offset after
    ``+hhmm`` -> ``+hh:mm`` repair.  Bad text -> null, never an error."""
    c = col(c)
    head = F.substring(c, 1, 19)
    parts = [F.try_to_timestamp(head, F.lit(TS_FORMAT_ISO_T))]
    if with_space:
        parts.append(F.try_to_timestamp(head, F.lit(TS_FORMAT_ISO_SPACE)))
    parts.append(
        F.try_to_timestamp(regex_replace(c, *OFFSET_REPAIR), F.lit(TS_FORMAT_ISO_OFFSET))
    )
    return F.coalesce(*parts)


def coerce_timestamp_utc(c: ColumnOrName) -> Column:
    """Text -> timestamp (session zone is UTC) or null."""
    c = col(c)
    return F.coalesce(
        F.try_to_timestamp(F.substring(c, 1, 26), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")),
        parse_timestamp_flex(c),
    )


def truncate_millis_format(c: ColumnOrName) -> Column:
    """``date_format(date_trunc('millisecond', t), '%Y-%m-%d %H:%i:%s.%f')``."""
    return F.date_format(F.date_trunc("MILLISECOND", col(c)), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def hour_diff_floor0(t: ColumnOrName, ref: ColumnOrName) -> Column:
    """max(floor((t - ref) in hours), 0); null if either side is null."""
    t, ref = col(t), col(ref)
    hours = F.floor(F.timestamp_diff("MICROSECOND", ref, t) / F.lit(3.6e9)).cast("double")
    return F.when(t.isNotNull() & ref.isNotNull(), F.greatest(hours, F.lit(0.0)))


def month_of(c: ColumnOrName) -> Column:
    """Month bucket (first day of month, as a date)."""
    return F.trunc(F.to_date(col(c)), "MM")


def is_weekend(c: ColumnOrName) -> Column:
    """Saturday/Sunday with Monday = 0 (``weekday``, not ``dayofweek``)."""
    return (F.weekday(col(c)) >= 5).cast("int")


def hour_of_day(c: ColumnOrName) -> Column:
    return F.hour(col(c))


def month_window(start: str, end: str, bump: bool = True) -> tuple[str, str]:
    """(tm_start, tm_end) month partitions from two 'YYYY-MM-DD' dates; when both fall in the
    same month and ``bump`` is set, the end moves one month on (with year carry)."""
    tm_start, tm_end = start[:7], end[:7]
    if bump and tm_start == tm_end:
        y, m = (int(x) for x in tm_end.split("-"))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
        tm_end = f"{y:04d}-{m:02d}"
    return tm_start, tm_end
