"""Value-to-text expressions for the prompt export (SCL5-SCL8).

``num_to_text`` prints a float the way Python's ``str(float)`` does, as a
JVM-side expression. Spark's cast gives the same shortest digits but another
layout: scientific from 1e7 up and below 1e-3 (``1.0E7``, ``5.0E-4``), where
Python is positional for exponents -4..15 and otherwise writes ``1e-05``,
``1.5e+16``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sci_to_python(s: Column) -> Column:
    """Re-layout a Java scientific string ``[-]d.dddE[-]x``."""
    sign = F.when(s.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    mant = F.regexp_extract(s, r"^-?([0-9.]+)E", 1)
    exp = F.regexp_extract(s, r"E(-?[0-9]+)$", 1).cast("int")
    digits = F.regexp_replace(F.regexp_replace(mant, r"\.", ""), r"0+$", "")
    digits = F.when(digits == "", F.lit("0")).otherwise(digits)
    nd = F.length(digits)
    # positional, exponent 0..15: digits then zeros, keep one decimal
    big = F.when(nd <= exp + 1,
                 F.concat(F.rpad(digits, exp + 1, "0"), F.lit(".0"))).otherwise(
        F.concat(F.substr(digits, F.lit(1), exp + 1), F.lit("."), F.substr(digits, exp + 2, F.lit(1000))))
    # positional, exponent -4..-1
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    # Python scientific: d[.ddd]e(+|-)xx
    m = F.when(nd > 1, F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.lit("."),
                                F.substr(digits, F.lit(2), F.lit(1000)))).otherwise(digits)
    e_txt = F.concat(F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
                     F.lpad(F.abs(exp).cast("string"), 2, "0"))
    sci = F.concat(m, F.lit("e"), e_txt)
    body = (F.when((exp >= 0) & (exp < 16), big)
            .when((exp >= -4) & (exp < 0), small)
            .otherwise(sci))
    return F.concat(sign, body)


def _shortest(c: Column, s: Column) -> Column:
    """Some Java versions print more digits than are needed to read a double
    back; of the texts with 15 to 17 digits take the first that does."""
    digits = F.length(F.regexp_replace(F.regexp_replace(s, "E.*$", ""), "[^0-9]", ""))
    out = s
    for places in (16, 15, 14):
        t = F.format_string(f"%.{places}e", c)
        t = F.regexp_replace(F.upper(t), r"E\+", "E")
        out = F.when(t.cast("double") == c, t).otherwise(out)
    return F.when(digits > 16, out).otherwise(s)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, so that nested uses do not repeat it in generated code."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _float_text(java: Column, number: Column) -> Column:
    """Python's text of a float from Java's; ``number`` is the value of a double, NULL for a narrower float."""
    def laid_out(s: Column) -> Column:
        return (F.when(s == "NaN", F.lit("nan")).when(s == "Infinity", F.lit("inf")).when(s == "-Infinity", F.lit("-inf"))
                .when(F.instr(s, "E") > 0, _sci_to_python(s)).otherwise(s))

    # Few texts have more digits than a double needs at most.
    long = number.isNotNull() & (F.length(java) > 17)
    return _bound(F.when(long, _shortest(number, java)).otherwise(java), laid_out)


def num_to_text(c: Column, data_type: T.DataType) -> Column:
    """SCL7: Python-style text of a value of ``data_type``."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        number = c if isinstance(data_type, T.DoubleType) else F.lit(None).cast("double")
        return _bound(F.struct(c.cast("string").alias("java"), number.alias("number")),
                      lambda v: _float_text(v["java"], v["number"]))
    if isinstance(data_type, T.BooleanType):
        return F.when(c, F.lit("True")).otherwise(F.lit("False"))
    return c.cast("string")


def key_value_text(df, cols: list[str], sep: str = ", ") -> Column:
    """SCL6 + FLT4: ``"name: value"`` for every non-missing cell, joined by
    ``sep``. The cells form one array, so the layout of floats is one expression for any number of columns;
    ``array_join`` skips the NULLs."""
    cells = []
    for c in cols:
        dt = df.schema[c].dataType
        col = F.col(f"`{c}`")
        none = F.lit(None)
        text, java, number = none.cast("string"), none.cast("string"), none.cast("double")
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            present = F.nanvl(col, none.cast(dt))
            java = present.cast("string")
            number = present if isinstance(dt, T.DoubleType) else number
        else:
            text = num_to_text(col, dt)
        cells.append(F.struct(F.lit(f"{c}: ").alias("name"), text.alias("text"), java.alias("java"), number.alias("number")))
    if not cells:
        return F.lit("")
    value = lambda e: F.coalesce(e["text"], _float_text(e["java"], e["number"]))
    return F.array_join(F.transform(F.array(*cells), lambda e: F.concat(e["name"], value(e))), sep)


def answer_word(label: Column, yes: str, no: str) -> Column:
    """SCL5: label 1 -> ``yes``, anything else -> ``no``."""
    return F.when(label == 1, F.lit(yes)).otherwise(F.lit(no))
