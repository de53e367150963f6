"""Column selection by name/type rules and schema checks: PRJ1-PRJ9, CHK1-CHK3,
FEA14. These work on the schema only (names and types, driver side); no data
is touched, the resulting ``select`` is pruned by Catalyst down to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """PRJ7: names that exist in ``df``, de-duplicated, order kept."""
    cols = set(df.columns)
    return list(dict.fromkeys(n for n in names if n in cols))


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """PRJ2: drop columns if present."""
    return df.drop(*present(df, names))


def features_except(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """PRJ3/PRJ1: all columns minus exclusions (label, key, ...)."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def select_cols(df: DataFrame, *, suffix: str | Iterable[str] | None = None,
                contains_any: Iterable[str] | None = None,
                not_suffix: Iterable[str] | None = None,
                numeric: bool | None = None) -> list[str]:
    """PRJ4/PRJ5/PRJ6/PRJ8: name rules. ``suffix`` (any of), ``contains_any``
    (substring, any of), ``not_suffix`` (excludes), ``numeric`` (type)."""
    suffixes = (suffix,) if isinstance(suffix, str) else tuple(suffix or ())
    subs = tuple(contains_any or ())
    nots = tuple(not_suffix or ())
    out = []
    for f in df.schema.fields:
        name = f.name
        if suffixes and not name.endswith(suffixes):
            continue
        if subs and not any(s in name for s in subs):
            continue
        if nots and name.endswith(nots):
            continue
        if numeric is not None and isinstance(f.dataType, T.NumericType) != numeric:
            continue
        out.append(name)
    return out


def numeric_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """PRJ8: numeric columns (``select_dtypes(np.number)``)."""
    ex = set(exclude)
    return [c for c in select_cols(df, numeric=True) if c not in ex]


def project(df: DataFrame, keep: list[str], key: str | None = None) -> DataFrame:
    """PRJ9: project to a selected list, order kept, key carried first."""
    cols = ([key] if key and key not in keep else []) + list(keep)
    return df.select(*[f"`{c}`" for c in cols])


def check_same_columns(a: DataFrame, b: DataFrame, what: str = "splits") -> None:
    """CHK1: ordered schema equality."""
    if list(a.columns) != list(b.columns):
        raise ValueError(f"column lists of {what} differ: {a.columns} vs {b.columns}")


def check_required(df: DataFrame, names: Iterable[str], what: str = "table") -> None:
    """CHK2: every required column present."""
    missing = [n for n in names if n not in set(df.columns)]
    if missing:
        raise ValueError(f"{what} lacks required columns: {missing}")


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """CHK3/SET3: column intersection in ``a``'s order (stable, unlike a set)."""
    bs = set(b.columns)
    return [c for c in a.columns if c in bs]


def intersect_names(selected: Iterable[str], pool: Iterable[str]) -> list[str]:
    """FEA14: members of ``pool`` that are in ``selected``, pool order."""
    s = set(selected)
    return [c for c in pool if c in s]
