"""Feature preparation fitted on train, applied to val/test: SCL1-SCL3,
FEA1-FEA5, FEA12.

Fits are one or two aggregates whose results are small (one value per
column) and are kept on the driver; transforms are a single ``select`` of
``coalesce``/arithmetic expressions, so they stay inside whole-stage codegen
and add no shuffle.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import columns as C
from .profile import is_missing, long_cells, missing_counts, missing_ratios, numeric_cells
from .quantiles import median_map

SENTINEL = 999999
MISSING_TOKEN = "MISSING"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _fill(df: DataFrame, name: str, value) -> Column:
    """``fillna`` for one column: NULL (and NaN for floats) -> value."""
    dt = df.schema[name].dataType
    lit = F.lit(value)
    if isinstance(dt, T.NumericType) and not isinstance(value, str):
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            return F.when(is_missing(df, name), lit.cast(dt)).otherwise(_q(name)).alias(name)
        if float(value).is_integer():
            return F.coalesce(_q(name), lit.cast(dt)).alias(name)
        return F.coalesce(_q(name).cast("double"), lit.cast("double")).alias(name)
    return F.coalesce(_q(name), lit.cast(dt)).alias(name)


def fill_values(df: DataFrame, values: dict) -> DataFrame:
    """SCL1-SCL3: fill missing cells per column, everything else untouched,
    one projection."""
    return df.select(*[_fill(df, c, values[c]) if c in values else _q(c) for c in df.columns])


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """SCL1."""
    return fill_values(df, {c: 0 for c in C.present(df, cols)})


def fill_sentinel(df: DataFrame, cols: list[str], value: float = SENTINEL) -> DataFrame:
    """SCL2."""
    return fill_values(df, {c: value for c in C.present(df, cols)})


def fill_token(df: DataFrame, cols: list[str], token: str = MISSING_TOKEN) -> DataFrame:
    """SCL3."""
    return fill_values(df, {c: token for c in C.present(df, cols)})


def columns_with_missing(df: DataFrame, cols: list[str]) -> list[str]:
    """AGG5: the columns of ``cols`` with at least one missing cell (one
    aggregate)."""
    if not cols:
        return []
    gaps = {r["column_name"] for r in missing_counts(df, cols).collect()}  # at most one row per column
    return [c for c in cols if c in gaps]


def high_missing(df: DataFrame, cols: list[str], threshold: float) -> list[str]:
    """FEA1 (rule mode): columns whose missing ratio exceeds ``threshold``."""
    rows = missing_ratios(df, cols).filter(F.col("missing_ratio") > threshold).collect()
    return [r["column_name"] for r in rows]


@dataclass
class FillModel:
    """A fitted per-column fill (median / mean / constant). ``unfilled`` names the
    columns without any value in train: they have no median and keep their gaps."""
    values: dict = field(default_factory=dict)
    dropped: list = field(default_factory=list)
    unfilled: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        out = C.drop_present(df, self.dropped)
        vals = {c: v for c, v in self.values.items() if c in out.columns}
        exprs = []
        for c in out.columns:
            if c in vals:
                dt = out.schema[c].dataType
                base = _q(c).cast("double") if isinstance(dt, T.NumericType) else _q(c)
                miss = is_missing(out, c)
                exprs.append(F.when(miss, F.lit(vals[c])).otherwise(base).alias(c))
            else:
                exprs.append(_q(c))
        return out.select(*exprs)

    def to_json(self) -> str:
        return json.dumps(asdict(self))


def fit_median_imputer(train: DataFrame, cols: list[str], only_missing: bool = True) -> FillModel:
    """FEA3/AGG7: exact train medians for the columns (by default only those
    with gaps in train, like the reference)."""
    cols = columns_with_missing(train, cols) if only_missing else list(cols)
    med = median_map(train, cols) if cols else {}
    return FillModel(values={c: m for c, (m, _) in med.items() if m is not None},
                     unfilled=[c for c, (m, _) in med.items() if m is None])


def fit_mean_imputer(train: DataFrame, cols: list[str]) -> FillModel:
    """FEA4/AGG8: train means for every column; an all-missing column is
    dropped (it has no mean)."""
    vals = {c: m for c, (m, _) in column_moments(train, cols).items()}
    return FillModel(values={c: v for c, v in vals.items() if v is not None},
                     dropped=[c for c, v in vals.items() if v is None])


def column_moments(df: DataFrame, cols: list[str]) -> dict:
    """``{column: (mean, population std)}`` over the present cells, one aggregate."""
    long = long_cells(df, numeric_cells(df, cols), cols)
    rows = long.groupBy("feature").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s")).collect()
    found = {r["feature"]: (r["m"], r["s"]) for r in rows}  # one row per column
    return {c: found.get(c, (None, None)) for c in cols}


@dataclass
class ScalerModel:
    """FEA5: ``(x - mean) / std_pop``; a zero-variance column maps to 0."""
    mean: dict
    std: dict

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = []
        for c in df.columns:
            if c in self.mean:
                s = self.std[c] or 0.0
                scale = s if s > 0 else 1.0
                exprs.append(((_q(c).cast("double") - F.lit(self.mean[c])) / F.lit(scale)).alias(c))
            else:
                exprs.append(_q(c))
        return df.select(*exprs)


def fit_standard_scaler(train: DataFrame, cols: list[str]) -> ScalerModel:
    """FEA5/AGG9: mean and population std (divide by n, like the
    reference's scaler; MLlib's ``StandardScaler`` divides by n-1)."""
    moments = column_moments(train, cols)
    return ScalerModel(mean={c: m for c, (m, _) in moments.items()}, std={c: sd for c, (_, sd) in moments.items()})


@dataclass
class MissingPlan:
    """FEA2: the ordered missing-value plan, as parameters.

    A drop listed (+ optional ratio rule) -> B zero-fill (substring rules,
    compound rule, explicit list) -> C sentinel -> D median of the numeric
    columns with gaps in train -> E ``'MISSING'`` for categoricals with gaps
    in train -> F residual-missing report. ``fill_all`` also fills columns
    whose gaps appear only outside train (the reference leaves them).
    """
    exclude: list = field(default_factory=list)
    drop_cols: list = field(default_factory=list)
    drop_ratio: float | None = None
    zero_contains: list = field(default_factory=list)
    zero_contains_not_suffix: tuple = ((), ())
    zero_cols: list = field(default_factory=list)
    sentinel_cols: list = field(default_factory=list)
    sentinel: float = SENTINEL
    categorical_cols: list = field(default_factory=list)
    categorical_suffix: tuple = ()
    median: bool = True
    fill_all: bool = False

    def fit(self, train: DataFrame) -> "MissingPlanModel":
        feats = C.features_except(train, self.exclude)
        drops = C.present(train, self.drop_cols)
        if self.drop_ratio is not None:
            drops += [c for c in high_missing(train, feats, self.drop_ratio) if c not in drops]
        kept = [c for c in feats if c not in set(drops)]
        sub = train.select(*[f"`{c}`" for c in kept])
        zero = C.select_cols(sub, contains_any=self.zero_contains) if self.zero_contains else []
        inc, nots = self.zero_contains_not_suffix
        if inc:
            zero += C.select_cols(sub, contains_any=inc, not_suffix=nots)
        zero = C.present(sub, zero + list(self.zero_cols))
        sentinel = [c for c in C.present(sub, self.sentinel_cols) if c not in zero]
        cats = C.present(sub, list(self.categorical_cols)
                         + (C.select_cols(sub, suffix=self.categorical_suffix) if self.categorical_suffix else []))
        done = set(zero) | set(sentinel) | set(cats)
        numeric_rest = [c for c in C.numeric_cols(sub) if c not in done]
        med_cols = numeric_rest if self.median else []
        # one aggregate flags the gaps of both the median and the token columns
        gaps = set() if self.fill_all else set(columns_with_missing(train, med_cols + cats))
        if med_cols:
            med = fit_median_imputer(train, med_cols if self.fill_all else
                                     [c for c in med_cols if c in gaps], only_missing=False).values
        else:
            med = {}
        cat_fill = cats if self.fill_all else [c for c in cats if c in gaps]
        return MissingPlanModel(dropped=drops, zero=zero, sentinel=sentinel, sentinel_value=self.sentinel,
                                medians=med, token_cols=cat_fill, categorical=cats)


@dataclass
class MissingPlanModel:
    dropped: list
    zero: list
    sentinel: list
    sentinel_value: float
    medians: dict
    token_cols: list
    categorical: list

    def transform(self, df: DataFrame, strict: bool = True) -> DataFrame:
        """One projection. With ``strict`` every column the plan fills must
        exist (CHK2, the reference silently assumed it)."""
        out = df.drop(*C.present(df, self.dropped))
        needed = self.zero + self.sentinel + list(self.medians) + self.token_cols
        if strict:
            C.check_required(out, needed, "input of the missing plan")
        values = {c: 0 for c in self.zero if c in out.columns}
        values.update({c: self.sentinel_value for c in self.sentinel if c in out.columns})
        values.update({c: MISSING_TOKEN for c in self.token_cols if c in out.columns})
        filled = fill_values(out, values)
        return FillModel(values={c: v for c, v in self.medians.items() if c in out.columns}).transform(filled)

    def residual_missing(self, flagged: DataFrame, split: str = "split") -> DataFrame:
        """F: total missing cells per split after the plan (AGG6), one scan of a
        table with a split flag."""
        from .profile import missing_total_by_split
        return missing_total_by_split(self.transform(flagged), split=split)

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False)
