"""Table -> instruction/input/output records (EXP1, EXP2, SCL5-SCL8, AGG11).

One projection per row, all JVM-side (no Python UDF): the input text lists
every non-missing feature as ``name: value`` (the label excluded, the key
kept, as in the reference), the output is the answer word for the label.
Rows whose label is missing or malformed go to a reject table instead of
failing the job (the reference skips and reports them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import answer_word, key_value_text

# They must equal the reference's text for the same records.
INSTRUCTION = "請根據下列股票的基本面特徵，綜合評估該股票是否具有顯著上漲潛力，請回答「是」或「否」："
YES = "是"
NO = "否"


def to_prompts(df: DataFrame, label: str, exclude: list[str] | None = None,
               instruction: str = INSTRUCTION, yes: str = YES, no: str = NO) -> DataFrame:
    """EXP1: ``(instruction, input, output)`` strings."""
    ex = {label, *(exclude or [])}
    feats = [c for c in df.columns if c not in ex]
    return df.select(F.lit(instruction).alias("instruction"),
                     key_value_text(df, feats).alias("input"),
                     answer_word(F.col(label), yes, no).alias("output"))


def split_good_bad(df: DataFrame, label: str, corrupt_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """EXP2: rows fit for export vs rejects (missing label or a corrupt CSV
    record)."""
    bad = F.col(label).isNull()
    if corrupt_col and corrupt_col in df.columns:
        bad = bad | F.col(corrupt_col).isNotNull()
    good = df.filter(~bad)
    if corrupt_col and corrupt_col in df.columns:
        good = good.drop(corrupt_col)
    return good, df.filter(bad)
