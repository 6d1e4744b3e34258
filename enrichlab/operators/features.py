"""Feature transformers as ``pyspark.ml`` stages.

Stateless steps are ``Transformer``s built from column expressions (one ``select`` /
``withColumns`` each, no per-column copies).  Steps that learn a statistic (medians, modes,
null shares, dropped columns) are ``Estimator``s: the statistic is learned at ``fit`` on the
training frame and applied at ``transform`` (the reference recomputes it on every batch,
which leaks test data - SURVEY 8 Q1).  Fitting runs a bounded number of aggregates; the
driver receives one small value per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType, StringType

from enrichlab.functions import scalars as S
from enrichlab.operators.binning import exact_quantiles
from enrichlab.operators.filters import drop_high_null_columns, numeric_columns

EPS = 1e-8


class _Fn(Transformer):
    """A Transformer defined by a DataFrame -> DataFrame function of expressions."""

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - overridden
        return df


def median_of(df: DataFrame, c: str, method: str = "exact", accuracy: int = 10000) -> float | None:
    """Median of a column: exact (distributed ranks) or ``percentile_approx``."""
    if method == "approx":
        return df.agg(F.percentile_approx(S.nan_to_null(F.col(c).cast("double")), 0.5, accuracy)).first()[0]
    return exact_quantiles(df, c, [0.5])[0]


def medians_of(df: DataFrame, cols: Sequence[str], method: str = "exact", accuracy: int = 10000) -> dict:
    """Medians of several columns in one pass (exact distributed ranks, or approximate)."""
    from enrichlab.operators.binning import exact_quantiles_multi

    if method == "approx":
        row = df.agg(*[F.percentile_approx(S.nan_to_null(F.col(c).cast("double")), 0.5, accuracy).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    return {c: v[0] for c, v in exact_quantiles_multi(df, cols, [0.5]).items()}


def mode_of(df: DataFrame, c: str):
    """Most frequent non-null value, smallest on ties (pandas ``mode().iloc[0]``): a grouped
    count and a top-1 (TakeOrderedAndProject), so no value->count map sits in one task."""
    r = (df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__n"))
         .orderBy(F.col("__n").desc(), F.col(c).asc()).first())
    return None if r is None else r[0]


# ---------------------------------------------------------------- p_sale variants


def p_sale_expr(df: DataFrame, eps: float = EPS) -> Column:
    """normalized sale / (normalized lead + eps), else raw pair, else 0.0; clipped to [0, 1]."""
    if {"normalized_p_cr_sale", "normalized_p_cr_lead"} <= set(df.columns):
        r = F.try_divide(F.col("normalized_p_cr_sale"), F.col("normalized_p_cr_lead") + eps)
    elif {"p_cr_sale", "p_cr_lead"} <= set(df.columns):
        r = F.try_divide(F.col("p_cr_sale"), F.col("p_cr_lead") + eps)
    else:
        r = F.lit(0.0)
    return S.clip(r, 0.0, 1.0)


def p_sale_no_epsilon(s: str = "normalized_p_cr_sale", l: str = "normalized_p_cr_lead", fill: float = 1e-4) -> Column:
    """s / l without epsilon: x/0 -> inf -> 1 after the clip; 0/0 and null -> ``fill``."""
    r = S.clip(S.pandas_div(s, l), 0.0, 1.0)
    return F.coalesce(r, F.lit(fill))


def p_l2s_clipped(df: DataFrame, s: str = "normalized_p_cr_sale", l: str = "normalized_p_cr_lead", out: str = "p_l2s") -> DataFrame:
    """s / l clipped to the finite min / max of the data (inf -> max / min), missing -> finite
    min.  The two bounds are scalar subqueries (one aggregate)."""
    r = S.pandas_div(s, l)
    fin = F.when(~r.isin(S.INF, -S.INF), r)
    b = df.agg(F.min(fin).alias("lo"), F.max(fin).alias("hi"))
    lo, hi = b.select("lo").scalar(), b.select("hi").scalar()
    return df.withColumn(out, F.coalesce(F.least(F.greatest(r, lo), hi), lo))


class PSaleRatio(Estimator):
    """p_sale = clip(sale / (lead + eps)); mode 'only' keeps p_sale alone, 'essential' keeps
    p_sale + essential features and drops those with > ``max_null_pct`` % nulls (learned at
    fit), 'all' keeps every column."""

    def __init__(self, mode: str = "essential", attribute: Sequence[str] = (), essential: Sequence[str] = (),
                 max_null_pct: float = 60.0, eps: float = EPS, passthrough: Sequence[str] = ()):
        super().__init__()
        self.mode, self.attribute, self.essential = mode, list(attribute), list(essential)
        self.max_null_pct, self.eps, self.passthrough = max_null_pct, eps, list(passthrough)

    def _with_p(self, df):
        return df.withColumn("p_sale", p_sale_expr(df, self.eps))

    def _fit(self, df: DataFrame) -> "PSaleRatioModel":
        keep, dropped = None, []
        if self.mode == "essential":
            x = self._with_p(df)
            cols = [c for c in ["p_sale", *self.attribute, *self.essential] if c in x.columns]
            keep = list(dict.fromkeys(cols))
            _, dropped = drop_high_null_columns(x.select(*keep), self.max_null_pct, keep=("p_sale",))
            keep = [c for c in keep if c not in dropped]
        if self.mode == "only":
            keep = ["p_sale"]
        if keep is not None:
            keep = keep + [c for c in self.passthrough if c not in keep]
        return PSaleRatioModel(self.mode, keep, self.eps, extra=dropped)


class PSaleRatioModel(Model):
    def __init__(self, mode: str, keep: list[str] | None, eps: float, extra=()):
        super().__init__()
        self.mode, self.keep, self.eps, self.dropped = mode, keep, eps, list(extra)

    def _transform(self, df: DataFrame) -> DataFrame:
        x = df.withColumn("p_sale", p_sale_expr(df, self.eps))
        if self.mode in ("only", "essential"):
            return x.select(*[c for c in self.keep if c in x.columns])
        return x


# ---------------------------------------------------------------- attribute features

# Legal-structure tiers.
LEGAL_HIGH = "Corporation"
LEGAL_MID = "Limited Liability Company"
LEGAL_LOW = ("Sole Proprietorship", "Unknown")


class BaseAttribute(_Fn):
    """Age in years + null flag; log1p revenue + null flag; legal form -> high / mid / low
    tiers (null -> 'Unknown'); p_sale x null-flag interactions; drops months and legal form."""

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = set(df.columns)
        new: dict[str, Column] = {}
        drop = []
        if "age_of_business_months" in cols:
            new["age_of_business_years"] = F.col("age_of_business_months") / 12
            new["isnull_age"] = F.col("age_of_business_months").isNull().cast("int")
            drop.append("age_of_business_months")
        if "application_annual_revenue" in cols:
            new["log_annual_revenue"] = S.log1p("application_annual_revenue")
            new["isnull_revenue"] = F.col("application_annual_revenue").isNull().cast("int")
        if "business_legal_structure" in cols:
            legal = F.coalesce(F.col("business_legal_structure"), F.lit("Unknown"))
            new["business_quality_high"] = (legal == LEGAL_HIGH).cast("int")
            new["business_quality_mid"] = (legal == LEGAL_MID).cast("int")
            new["business_quality_low"] = legal.isin(*LEGAL_LOW).cast("int")
            drop.append("business_legal_structure")
        x = df.withColumns(new)
        if "p_sale" in cols:
            inter = {}
            if "isnull_age" in x.columns:
                inter["p_sale_x_isnull_age"] = F.col("p_sale") * F.col("isnull_age")
            if "isnull_revenue" in x.columns:
                inter["p_sale_x_isnull_revenue"] = F.col("p_sale") * F.col("isnull_revenue")
            x = x.withColumns(inter)
        return x.drop(*drop)


# Time-to-clickout one-hot column names, in bucket order.
TIME_GROUP_COLUMNS = ("time_group_lt_10", "time_group_10_lt_seclt_30", "time_group_30_lt_seclt_60", "time_group_gte_60")


class TrafficFeatures(Estimator):
    """network (null -> 'x') one-hot g / o / {s, x}; time to click (null -> median learned at
    fit) fast < 10 / medium < 30 / slow; time-bucket one-hot; or drop the listed columns."""

    def __init__(self, keep: bool = True, drop: Sequence[str] = ("network", "time_to_clickout_s", "time_to_clickout_s_group"),
                 median_method: str = "exact"):
        super().__init__()
        self.keep, self.drop_cols, self.median_method = keep, list(drop), median_method

    def _fit(self, df: DataFrame) -> "TrafficFeaturesModel":
        med = None
        if self.keep and "time_to_clickout_s" in df.columns:
            med = median_of(df, "time_to_clickout_s", self.median_method)
        return TrafficFeaturesModel(self.keep, self.drop_cols, med)


class TrafficFeaturesModel(Model):
    def __init__(self, keep, drop_cols, median):
        super().__init__()
        self.keep, self.drop_cols, self.median = keep, drop_cols, median

    def _transform(self, df: DataFrame) -> DataFrame:
        if not self.keep:
            return df.drop(*[c for c in self.drop_cols if c in df.columns])
        cols, new, drop = set(df.columns), {}, []
        if "network" in cols:
            n = F.coalesce(F.col("network"), F.lit("x"))
            new.update({"network_g": (n == "g").cast("int"), "network_o": (n == "o").cast("int"),
                        "network_sx": n.isin("s", "x").cast("int")})
            drop.append("network")
        if "time_to_clickout_s" in cols:
            t = F.coalesce(F.col("time_to_clickout_s").cast("double"), F.lit(self.median))
            new.update({"time_to_clickout_fast": (t < 10).cast("int"),
                        "time_to_clickout_medium": ((t >= 10) & (t < 30)).cast("int"),
                        "time_to_clickout_slow": (t >= 30).cast("int")})
            drop.append("time_to_clickout_s")
        if "time_to_clickout_s_group" in cols:
            g = F.col("time_to_clickout_s_group")
            for name, label in zip(TIME_GROUP_COLUMNS, S.TIME_BUCKET_LABELS):
                new[name] = F.coalesce((g == label).cast("int"), F.lit(0))
            drop.append("time_to_clickout_s_group")
        return df.withColumns(new).drop(*drop)


class LoanFeatures(_Fn):
    """loan_purpose text -> number (unparsable / null -> 0), log1p, flag = (value == 0)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        if "loan_purpose" not in df.columns:
            return df
        v = F.coalesce(S.coerce_numeric("loan_purpose"), F.lit(0.0))
        return df.withColumns({"log_loan_purpose": S.log1p(v), "isnull_loan_purpose": (v == 0).cast("int")}).drop("loan_purpose")


# The eight industries kept as one-hot columns (everything else -> Other).
TOP_INDUSTRIES = (
    "Other Services (except Public Administration)",
    "Construction",
    "Retail Trade",
    "Transportation and Warehousing",
    "Accommodation and Food Services",
    "ProfessionalScientificand Technical Services",
    "Health Care and Social Assistance",
    "ArtsEntertainmentand Recreation",
)


def industry_column_name(value: str) -> str:
    return "industry_" + value.replace(" ", "_").replace("(", "").replace(")", "").replace(",", "")


class IndustryOneHot(_Fn):
    def __init__(self, values: Sequence[str] = TOP_INDUSTRIES):
        super().__init__()
        self.values = list(values)

    def _transform(self, df: DataFrame) -> DataFrame:
        if "industry" not in df.columns:
            return df
        ind = F.coalesce(F.col("industry"), F.lit("Unknown"))
        new = {industry_column_name(v): (ind == v).cast("int") for v in self.values}
        new["industry_Other"] = (~ind.isin(*self.values)).cast("int")
        return df.withColumns(new).drop("industry")


# Sub-industries with their own flag.
SUB_INDUSTRY_FLAGS = {
    "sub_industry_full_service_restaurants": "Full-Service Restaurants",
    "sub_industry_residential_construction": "Residential Building Construction",
    "sub_industry_hvac_plumbing": "HVACPlumbing and Electrician",
}


class SubIndustryFlags(_Fn):
    """3 exact flags, a 'Construction' substring flag, and Other = not one of the 3 (overlaps)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        if "sub_industry" not in df.columns:
            return df
        s = F.coalesce(F.col("sub_industry"), F.lit("Unknown"))
        new = {k: (s == v).cast("int") for k, v in SUB_INDUSTRY_FLAGS.items()}
        new["sub_industry_construction"] = S.str_contains(s, "Construction").cast("int")
        new["sub_industry_Other"] = (~s.isin(*SUB_INDUSTRY_FLAGS.values())).cast("int")
        return df.withColumns(new).drop("sub_industry")


USER_RANK_COLUMNS = ("users_prob_very_low", "users_prob_low", "users_prob_medium", "users_prob_high", "users_prob_very_high")


def user_rank_flags(c: str = "users_prob_sale") -> dict[str, Column]:
    """Substring flags with exclusions ('Low' but not 'Very Low', ...); null -> all 0."""
    has = lambda s: S.str_contains(c, s)
    return {
        "users_prob_very_low": has("Very Low").cast("int"),
        "users_prob_low": (has("Low") & ~has("Very Low")).cast("int"),
        "users_prob_medium": has("Medium").cast("int"),
        "users_prob_high": (has("High") & ~has("Very High")).cast("int"),
        "users_prob_very_high": has("Very High").cast("int"),
    }


class UserRankFlags(_Fn):
    def _transform(self, df: DataFrame) -> DataFrame:
        if "users_prob_sale" not in df.columns:
            return df
        return df.withColumns(user_rank_flags()).drop("users_prob_sale")


class UserRankOnly(_Fn):
    """Only the 5 rank flags (all zeros when the column is missing)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        if "users_prob_sale" not in df.columns:
            return df.select(*[F.lit(0).alias(c) for c in USER_RANK_COLUMNS])
        flags = user_rank_flags()
        return df.select(*[flags[c].alias(c) for c in USER_RANK_COLUMNS])


class UserRankOnlyKeep(_Fn):
    """UserRankOnly that also keeps pass-through columns (label, keys) for a pipeline."""

    def __init__(self, passthrough: Sequence[str] = ()):
        super().__init__()
        self.passthrough = list(passthrough)

    def _transform(self, df: DataFrame) -> DataFrame:
        keep = [F.col(c) for c in self.passthrough if c in df.columns]
        if "users_prob_sale" not in df.columns:
            return df.select(*keep, *[F.lit(0).alias(c) for c in USER_RANK_COLUMNS])
        flags = user_rank_flags()
        return df.select(*keep, *[flags[c].alias(c) for c in USER_RANK_COLUMNS])


class DropUserRank(_Fn):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*[c for c in USER_RANK_COLUMNS if c in df.columns])


class MedianModeImputer(Estimator):
    """Numeric columns: median (``fixed`` overrides, e.g. p_sale -> 0.0001); string columns:
    mode (age_group -> '0-1'; no mode -> 'Unknown').  Learned at fit."""

    def __init__(self, fixed: Mapping[str, object] | None = None, median_method: str = "exact"):
        super().__init__()
        self.fixed = dict(fixed if fixed is not None else {"p_sale": 1e-4, "age_group": "0-1"})
        self.median_method = median_method

    def _fit(self, df: DataFrame) -> "FillModel":
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
        need = [f.name for f in df.schema.fields if nulls[f.name] and f.name not in self.fixed
                and isinstance(f.dataType, NumericType)]
        meds = medians_of(df, need, self.median_method) if need else {}
        fills = {}
        for f in df.schema.fields:
            c = f.name
            if not nulls[c]:
                continue
            if c in self.fixed:
                fills[c] = self.fixed[c]
            elif isinstance(f.dataType, NumericType):
                if meds.get(c) is not None:  # an all-null column stays null
                    fills[c] = meds[c]
            elif isinstance(f.dataType, StringType):
                m = mode_of(df, c)
                fills[c] = m if m is not None else "Unknown"
        return FillModel(fills)


class FillModel(Model):
    def __init__(self, fills: Mapping[str, object]):
        super().__init__()
        self.fills = dict(fills)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: filled(df, c, v) for c, v in self.fills.items() if c in df.columns})


def filled(df: DataFrame, c: str, v) -> Column:
    """``c`` with nulls replaced by ``v``, in the column's type; an integer column whose statistic
    is fractional becomes a double one (a median of 2.5 stays 2.5)."""
    kind = df.schema[c].dataType
    if isinstance(kind, IntegralType) and isinstance(v, float) and not v.is_integer():
        return F.coalesce(F.col(c).cast("double"), F.lit(v))
    return F.coalesce(F.col(c), F.lit(v).cast(kind))


# Age groups in years (right-closed, lowest edge included).
AGE_YEAR_EDGES = (0, 1, 3, 5, float("inf"))
AGE_YEAR_LABELS = ("0-1", "1-3", "3-5", "5+")


class AgeGroupOneHot(_Fn):
    """years -> [0,1], (1,3], (3,5], (5,inf); null / negative -> '0-1'; one-hot; drops both."""

    def _transform(self, df: DataFrame) -> DataFrame:
        if "age_of_business_years" not in df.columns:
            return df
        g = F.coalesce(S.bin_fixed_edges_expr("age_of_business_years", AGE_YEAR_EDGES, AGE_YEAR_LABELS, True), F.lit("0-1"))
        return df.withColumns({f"age_group_{lab}": (g == lab).cast("int") for lab in AGE_YEAR_LABELS}).drop(
            "age_of_business_years", *[c for c in ["age_group"] if c in df.columns])


class MedianFillBasic(Estimator):
    """Median fill for age and revenue only (learned at fit)."""

    def __init__(self, cols: Sequence[str] = ("age_of_business_months", "application_annual_revenue"), median_method="exact"):
        super().__init__()
        self.cols, self.median_method = list(cols), median_method

    def _fit(self, df: DataFrame) -> FillModel:
        meds = medians_of(df, [c for c in self.cols if c in df.columns], self.median_method)
        return FillModel({c: m for c, m in meds.items() if m is not None})


class NumericOnly(_Fn):
    def _transform(self, df: DataFrame) -> DataFrame:
        cols = numeric_columns(df)
        return df.select(*cols)


class NullStrategy(Estimator):
    """Per column: 'median' | 'mean' | 'mode' | 'unknown' | 'drop_rows' | 'drop_columns'; absent
    columns are skipped.  Statistics are learned at fit, so test rows do not shape them."""

    def __init__(self, strategies: Mapping[str, str], median_method: str = "exact"):
        super().__init__()
        self.strategies, self.median_method = dict(strategies), median_method

    def _fit(self, df: DataFrame) -> "NullStrategyModel":
        of = {how: [c for c, h in self.strategies.items() if h == how and c in df.columns] for how in set(self.strategies.values())}
        fills: dict[str, object] = medians_of(df, of["median"], self.median_method) if of.get("median") else {}
        if of.get("mean"):
            fills |= df.agg(*[F.avg(S.nan_to_null(F.col(c).cast("double"))).alias(c) for c in of["mean"]]).first().asDict()
        fills |= {c: mode_of(df, c) for c in of.get("mode", ())}
        return NullStrategyModel(self.strategies, {c: v for c, v in fills.items() if v is not None})


class NullStrategyModel(Model):
    def __init__(self, strategies: Mapping[str, str], fills: Mapping[str, object]):
        super().__init__()
        self.strategies, self.fills = dict(strategies), dict(fills)

    def _transform(self, df: DataFrame) -> DataFrame:
        x = df
        for c, how in self.strategies.items():
            if c not in x.columns:
                continue
            if how == "drop_columns":
                x = x.drop(c)
            elif how == "drop_rows":
                x = x.na.drop(subset=[c])
            elif how == "unknown":
                x = x.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("Unknown")))
            elif c in self.fills:
                x = x.withColumn(c, filled(x, c, self.fills[c]))
        return x


def null_strategy(df: DataFrame, strategies: Mapping[str, str], median_method: str = "exact") -> DataFrame:
    """``NullStrategy`` fitted and applied on the same frame."""
    return NullStrategy(strategies, median_method).fit(df).transform(df)


class NaNIndicator(_Fn):
    """``<col>_is_na`` flags."""

    def __init__(self, cols: Sequence[str]):
        super().__init__()
        self.cols = list(cols)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}_is_na": F.col(c).isNull().cast("int") for c in self.cols if c in df.columns})


# The output columns of the legacy transformer, in its order.
LEGACY_OUTPUT = ("normalized_p_cr_lead", "normalized_p_cr_sale", "p_l2s", "age_of_business_years",
                 "application_annual_revenue_100", "business_legal_structure_is_na", "age_of_business_months_is_na",
                 "application_annual_revenue_is_na", "is_age_0", "is_business_Corporation", "is_business_sole_Ppoprietorship")


class LegacyAttribute(_Fn):
    """years = months // 12, revenue // 100000, is_age_0, two legal flags, clipped p_l2s;
    fixed output list (expects the ``*_is_na`` flags from NaNIndicator)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        x = df.withColumns({
            "age_of_business_years": S.floor_div("age_of_business_months", 12),
            "application_annual_revenue_100": S.floor_div("application_annual_revenue", 100000),
        })
        x = x.withColumns({
            "is_age_0": (F.col("age_of_business_years") == 0).cast("int"),
            "is_business_Corporation": (F.col("business_legal_structure") == "Corporation").cast("int"),
            "is_business_sole_Ppoprietorship": (F.col("business_legal_structure") == "Sole Proprietorship").cast("int"),
        })
        x = p_l2s_clipped(x)
        return x.select(*[c for c in LEGACY_OUTPUT if c in x.columns])


def impute_vs_not(df: DataFrame, medians: Mapping[str, float], labels: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Two datasets from one input: as is, and with the given medians filled."""
    imputed = df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in medians.items() if c in df.columns})
    return df, imputed


def null_flags(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    return df.withColumns({out: F.col(c).isNull().cast("int") for c, out in flags.items() if c in df.columns})


def log_target(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"log_{c}", S.log1p(c))


def avg_deposit_per_sale(df: DataFrame, dep: str, sales: str, out: str = "avg_deposit_per_sale") -> DataFrame:
    """deposit / (sales + 1e-6) - leaks the target; only when sales is kept, off by default."""
    return df.withColumn(out, F.col(dep) / (F.col(sales) + 1e-6))


class ImputeAndScale(Estimator):
    """Numeric columns to ``<col>__scaled``: impute (``median``, ``mean``, ``mode``, ``constant`` or
    ``none``) and scale robustly (minus median, over the quartile range; a range of 0 scales by 1).
    Medians and quartiles are exact ranks found in one distributed pass over all columns, so no
    column's values meet in one place.  With ``none`` a row's missing values become the sentinel
    ``missing`` after scaling, which trees can split off; a column without any value counts as 0."""

    def __init__(self, cols: Sequence[str], strategy: str = "median", constant: float = 0.0, missing: float = -9.0):
        super().__init__()
        if strategy not in ("median", "mean", "mode", "constant", "none"):
            raise ValueError(f"unknown strategy {strategy}")
        self.cols, self.strategy, self.constant, self.missing = list(cols), strategy, constant, missing

    def _fit(self, df: DataFrame) -> "ImputeAndScaleModel":
        from enrichlab.operators.binning import exact_quantiles_multi

        x = df.select([S.nan_to_null(F.col(c).cast("double")).alias(c) for c in self.cols])
        if self.strategy == "median":
            fills = {c: q[0] for c, q in exact_quantiles_multi(x, self.cols, [0.5]).items()}
        elif self.strategy == "mean":
            fills = x.agg(*[F.avg(c).alias(c) for c in self.cols]).first().asDict()
        elif self.strategy == "mode":
            fills = {c: mode_of(x, c) for c in self.cols}
        else:
            fills = {c: self.constant if self.strategy == "constant" else None for c in self.cols}
        x = x.select([F.coalesce(F.col(c), F.lit(fills[c]).cast("double")).alias(c) for c in self.cols])
        scale = {}
        for c, (lo, mid, hi) in exact_quantiles_multi(x, self.cols, [0.25, 0.5, 0.75]).items():
            scale[c] = (0.0, 1.0) if mid is None else (mid, (hi - lo) or 1.0)
        return ImputeAndScaleModel(fills, scale, self.missing)


class ImputeAndScaleModel(Model):
    def __init__(self, fills: Mapping[str, float | None], scale: Mapping[str, tuple[float, float]], missing: float):
        super().__init__()
        self.fills, self.scale, self.missing = dict(fills), dict(scale), missing

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (mid, width) in self.scale.items():
            v = F.coalesce(S.nan_to_null(F.col(c).cast("double")), F.lit(self.fills[c]).cast("double"))
            out[f"{c}__scaled"] = F.coalesce((v - mid) / width, F.lit(self.missing))
        return df.withColumns(out)


class CategoryCodes(Estimator):
    """Codes of categories from a distributed dictionary: the levels of all columns are counted, each column's levels get their rank by
    (count descending, level) as code, and rows get it by a join; ``max_levels`` bounds the width.  Levels beyond it and
    levels not seen at the fit have no code.  Only the number of levels per column reaches the driver.

    Adds ``<col>__code`` and 0/1 columns ``<col>__0`` ... in the order of the codes; null counts as ``label``."""

    def __init__(self, cols: Sequence[str], max_levels: int = 256, label: str = "Unknown"):
        super().__init__()
        self.cols, self.max_levels, self.label = list(cols), max_levels, label

    def _fit(self, df: DataFrame) -> "CategoryCodesModel":
        from enrichlab.operators.binning import segmented_prefix
        from enrichlab.session import materialize

        if not self.cols:
            return CategoryCodesModel([], {}, None, self.label)
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.coalesce(F.col(c).cast("string"), F.lit(self.label)).alias("level")) for c in self.cols]))
        counts = df.select(pairs.alias("e")).select("e.*").groupBy("col", "level").agg((-F.count(F.lit(1))).alias("rarity"))
        ranked = segmented_prefix(counts, ["col"], ["rarity", "level"], {"code": F.lit(1)})
        levels = materialize(ranked.filter(F.col("code") < self.max_levels).select("col", "level", F.col("code").cast("int").alias("code")))
        width = dict(levels.groupBy("col").agg(F.count(F.lit(1))).collect())  # one row per column
        return CategoryCodesModel(self.cols, width, levels, self.label)


class CategoryCodesModel(Model):
    def __init__(self, cols: Sequence[str], width: Mapping[str, int], levels: DataFrame | None, label: str):
        super().__init__()
        self.cols, self.width, self.levels, self.label = list(cols), dict(width), levels, label

    def out_cols(self) -> list[str]:
        return [f"{c}__{i}" for c in self.cols for i in range(self.width.get(c, 0))]

    def _transform(self, df: DataFrame) -> DataFrame:
        for c in self.cols:
            own = self.levels.filter(F.col("col") == c).select(F.col("level").alias("__level"), F.col("code").alias(f"{c}__code"))
            # at most ``max_levels`` rows
            df = df.withColumn("__value", F.coalesce(F.col(c).cast("string"), F.lit(self.label))).join(F.broadcast(own), F.col("__value") == F.col("__level"), "left").drop("__value", "__level")
            df = df.withColumns({f"{c}__{i}": F.coalesce((F.col(f"{c}__code") == i).cast("int"), F.lit(0)) for i in range(self.width.get(c, 0))})
        return df


class _Assemble(Transformer):
    """Plain columns and the 0/1 columns that ``CategoryCodes`` made of ``cat`` as one vector, in that order."""

    def __init__(self, plain: Sequence[str], cat: Sequence[str], skip: Sequence[str], out: str):
        super().__init__()
        self.plain, self.cat, self.skip, self.out = list(plain), list(cat), list(skip), out

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import VectorAssembler

        wide = [x for c in self.cat for x in df.columns if x.startswith(f"{c}__") and x[len(c) + 2 :].isdigit()]
        x = VectorAssembler(inputCols=[*self.plain, *wide, *self.skip], outputCol=self.out, handleInvalid="keep").transform(df)
        return x.drop(*wide, *[f"{c}__code" for c in self.cat])


def auto_preprocessor(num: Sequence[str], cat: Sequence[str], strategy: str = "median", skip: Sequence[str] = (),
                      out: str = "features", constant: float = 0.0, max_levels: int = 256) -> list:
    """Pipeline stages: numeric -> ``ImputeAndScale`` (median / mean / mode / constant / none);
    categorical -> 'Unknown' fill + one-hot of at most ``max_levels`` levels each, unseen levels mapped to all
    zeros; assembled into ``out``.  Columns in ``skip`` pass through unscaled.  The levels stay distributed (``CategoryCodes``)."""
    num = [c for c in num if c not in set(skip)]
    stages: list = [_CastDouble(num)]
    if num:
        stages.append(ImputeAndScale(num, strategy, constant))
    stages += [CategoryCodes(cat, max_levels), _Assemble([f"{c}__scaled" for c in num], cat, skip, out)]
    return stages


class WideFeatures(Estimator):
    """``auto_preprocessor`` with plain columns: ``<num>__scaled`` and the 0/1 columns of ``CategoryCodes``; the model's ``cols`` names
    them all."""

    def __init__(self, num: Sequence[str], cat: Sequence[str], strategy: str = "median", constant: float = 0.0, max_levels: int = 256):
        super().__init__()
        self.num, self.cat, self.strategy, self.constant, self.max_levels = list(num), list(cat), strategy, constant, max_levels

    def _fit(self, df: DataFrame) -> "WideFeaturesModel":
        scaled = ImputeAndScale(self.num, self.strategy, self.constant).fit(_CastDouble(self.num).transform(df)) if self.num else None
        return WideFeaturesModel(self.num, scaled, CategoryCodes(self.cat, self.max_levels).fit(df))


class WideFeaturesModel(Model):
    def __init__(self, num: Sequence[str], scaled, codes: CategoryCodesModel):
        super().__init__()
        self.num, self.scaled, self.codes = list(num), scaled, codes
        self.cols = [f"{c}__scaled" for c in num] + codes.out_cols()

    def _transform(self, df: DataFrame) -> DataFrame:
        x = self.scaled.transform(_CastDouble(self.num).transform(df)) if self.scaled else df
        return self.codes.transform(x)


class _CastDouble(Transformer):
    def __init__(self, cols: Sequence[str]):
        super().__init__()
        self.cols = list(cols)

    def _transform(self, df: DataFrame) -> DataFrame:
        present = [c for c in self.cols if c in df.columns]
        return df.withColumns({c: F.col(c).cast("double") for c in present})
