"""Query registry: name -> (Spark plan builder, DuckDB oracle SQL or None).

Every registered query reads the driver tables (or fixtures derived from
them by Spark) at ``sf_dir``, over whole tables. Computed doubles are
rounded to 6 places on both sides so the oracle compare is stable under
different summation orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def split_sql(table_sql: str, key: str, frac: float = 0.8, seed: int = 42) -> str:
    """SQL for the SMP1 split: adds ``split`` ('train'/'val') to a table."""
    return f"""
SELECT * EXCLUDE (_rn, _n),
       CASE WHEN _rn <= round_even({frac!r}e0 * _n, 0) THEN 'train' ELSE 'val' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY md5('{seed}:' || CAST({key} AS VARCHAR)), {key}) AS _rn,
             count(*) OVER () AS _n
      FROM ({table_sql}))
"""
