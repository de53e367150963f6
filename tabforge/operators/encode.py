"""Category dictionaries learned on train: AGG10, FEA9-FEA11, JON3.

The dictionary is ``(feature, value, code)`` with codes in ascending value
order (0-based), like a pandas ``category`` built on train. Applying it is a
lookup; an unseen value (or a NULL) becomes a NULL code, and unseen values
are counted per column (FEA10).

Lookup:
* ``join`` (default): the columns whose dictionaries are small (their numbers of values and bytes are counted first)
  are looked up together, in one Arrow-batched function over one array column, so hundreds of
  columns cost one pass, no shuffle, and no hot value matters; every column beyond the bounds gets
  a left join planned by Spark (AQE splits hot values);
* ``index``: all columns in one projection by the hash lookup of MLlib's
  ``StringIndexerModel``; the dictionary is held by the driver and every executor,
  so more than ``INDEX_VALUES`` values are an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import long_cells
from .running import grouped_ordinal


INDEX_VALUES = 100_000  # dictionary rows of ``index``, all columns together; of one column of the joint lookup
#: Values and bytes of the dictionaries that are looked up together, all columns.
JOINT_VALUES = 1_000_000
JOINT_BYTES = 32 << 20


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def category_dictionary(train: DataFrame, cols: list[str]) -> DataFrame:
    """AGG10: ``(feature, value, code)``; NULL is not a category."""
    cells = [_q(c).cast("string") for c in cols]
    long = long_cells(train, cells, cols).filter(F.col("value").isNotNull()).distinct()
    # codes by range partitions + offsets: a high-cardinality column is not
    # ranked in one task
    return grouped_ordinal(long, "feature", "value")


@dataclass
class CategoryEncoderModel:
    cols: list
    dictionary: DataFrame
    lookup: str = "join"
    _labels: dict | None = None
    _small: dict | None = None

    def labels(self) -> dict[str, list]:
        """Values per column in code order (held by the driver for ``index``)."""
        if self._labels is None:
            found: dict = {c: [] for c in self.cols}
            rows = self.dictionary.orderBy("feature", "code").limit(INDEX_VALUES + 1).collect()
            if len(rows) > INDEX_VALUES:
                raise ValueError(f"more than {INDEX_VALUES} category values; use lookup 'join'")
            for r in rows:
                found[r["feature"]].append(r["value"])
            self._labels = found
        return self._labels

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """Replace each categorical column by its code (or add ``<c><suffix>``)."""
        cols = [c for c in self.cols if c in df.columns]
        coded = self._looked_up(df, cols) if self.lookup == "join" else self._indexed(df, cols)
        codes = {c: F.col(f"_tf_code{i}") for i, c in enumerate(cols)}
        out = []
        for c in df.columns:
            if c not in codes:
                out.append(_q(c))
            elif suffix:
                out += [_q(c), codes[c].alias(c + suffix)]
            else:
                out.append(codes[c].alias(c))
        return coded.select(*out)

    def _indexed(self, df: DataFrame, cols: list[str]) -> DataFrame:
        known = [(i, self.labels()[c]) for i, c in enumerate(cols) if self.labels()[c]]
        ready = df.withColumns({f"_tf_in{i}": _q(c).cast("string") for i, c in enumerate(cols)})
        if known:
            # NULL and unseen values get the code after the last one.
            model = StringIndexerModel.from_arrays_of_labels(
                [v for _, v in known], inputCols=[f"_tf_in{i}" for i, _ in known],
                outputCols=[f"_tf_out{i}" for i, _ in known], handleInvalid="keep")
            ready = model.transform(ready)
        size = {i: len(v) for i, v in known}
        return ready.withColumns({
            f"_tf_code{i}": F.when(F.col(f"_tf_out{i}") < size[i], F.col(f"_tf_out{i}").cast("int")) if i in size
            else F.lit(None).cast("int") for i in range(len(cols))})

    def small(self) -> dict[str, list]:
        """Values in code order of the columns that are looked up together: the smallest ones, as long as they keep
        to the bounds."""
        if self._small is None:
            sizes = self.dictionary.groupBy("feature").agg(
                F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("bytes")).collect()  # one row per column
            known = {r["feature"]: (r["n"], r["bytes"]) for r in sizes}
            n = size = 0
            found: dict = {c: [] for c in self.cols if c not in known}
            for c in sorted(known, key=known.get):
                n, size = n + known[c][0], size + known[c][1]
                if known[c][0] > INDEX_VALUES or n > JOINT_VALUES or size > JOINT_BYTES:
                    break
                found[c] = []
            chosen = self.dictionary.filter(F.col("feature").isin(list(found))).orderBy("feature", "code")
            for r in chosen.collect():  # within the bounds
                found[r["feature"]].append(r["value"])
            self._small = found
        return self._small

    def _looked_up(self, df: DataFrame, cols: list[str]) -> DataFrame:
        together = [(i, c) for i, c in enumerate(cols) if c in self.small()]
        rest = [(i, c) for i, c in enumerate(cols) if c not in self.small()]
        out = self._joined(df, rest)
        if not together:
            return out
        tables = [pa.array(self.small()[c], pa.string()) for _, c in together]
        width = len(tables)

        @F.arrow_udf("array<int>")
        def codes(cells: pa.Array) -> pa.Array:
            # A value's code is its place in the sorted dictionary.
            flat = cells.flatten()
            matrix = np.zeros((len(cells), width), dtype=np.int32)
            gone = np.ones((len(cells), width), dtype=bool)
            for j, table in enumerate(tables):
                place = pc.index_in(flat.take(pa.array(np.arange(j, len(flat), width))), value_set=table)
                gone[:, j] = place.is_null().to_numpy(zero_copy_only=False)
                matrix[:, j] = place.fill_null(0).to_numpy(zero_copy_only=False)
            values = pa.array(matrix.ravel(), mask=gone.ravel())
            return pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1) * width, pa.int32()), values)

        coded = out.withColumn("_tf_codes", codes(F.array(*[_q(c).cast("string") for _, c in together])))
        return coded.withColumns({f"_tf_code{i}": F.col("_tf_codes")[k] for k, (i, _) in enumerate(together)})

    def _joined(self, df: DataFrame, cols: list[tuple[int, str]]) -> DataFrame:
        out = df
        for i, c in cols:
            d = (self.dictionary.filter(F.col("feature") == c)
                 .select(F.col("value").alias(f"_tf_in{i}"), F.col("code").alias(f"_tf_code{i}")))
            out = out.join(d, _q(c).cast("string") == F.col(f"_tf_in{i}"), "left")
        return out

    def unseen_counts(self, df: DataFrame) -> DataFrame:
        """FEA10: ``(feature, n_unseen)`` — non-NULL values without a code."""
        cols = [c for c in self.cols if c in df.columns]
        coded = self.transform(df.select(*[_q(c) for c in cols]), suffix="__code")
        unseen = [(_q(c).isNotNull() & _q(c + "__code").isNull()).cast("long") for c in cols]
        return long_cells(coded, unseen, cols).groupBy("feature").agg(F.sum("value").alias("n_unseen"))


class CategoryEncoder:
    """FEA9: fit the train dictionary for ``cols``."""

    def __init__(self, cols: list[str], lookup: str = "join"):
        if lookup not in ("index", "join"):
            raise ValueError(f"unknown lookup {lookup}")
        self.cols = list(cols)
        self.lookup = lookup

    def fit(self, train: DataFrame) -> CategoryEncoderModel:
        return CategoryEncoderModel(cols=self.cols, dictionary=category_dictionary(train, self.cols), lookup=self.lookup)
