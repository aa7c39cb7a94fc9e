"""Cleaning of the incident fields.

The incident documents are loosely typed: ``District`` and ``Year`` hold a
number in some documents and text in others, text fields carry stray blanks.
These helpers turn such fields into typed columns with built-in expressions
only, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Java's String.trim() removes at both ends,
# U+0000 through U+0020 inclusive (controls, tab, newline and space).
JAVA_BLANKS = "".join(chr(code) for code in range(0x00, 0x20 + 1))

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_trim(col: Column | str) -> Column:
    """Strip every character <= U+0020 from both ends (Spark's ``trim`` strips spaces only)."""
    return F.btrim(_c(col), F.lit(JAVA_BLANKS))


def non_empty(col: Column | str) -> Column:
    """True when the value is present and has at least one character (NULL counts as absent)."""
    return F.coalesce(F.length(_c(col)) > 0, F.lit(False))


def _field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _whole_part(text: Column) -> Column:
    """The integer part of a plain decimal number's text ("-0" becomes "0")."""
    part = F.substring_index(text, ".", 1)
    return F.when(part == "-0", F.lit("0")).otherwise(part)


def _double_text(x: Column) -> Column:
    """A double truncated toward zero, as text, at any size: below 2^53 through
    the truncated long, above through a decimal (such doubles are whole).  NaN,
    the infinities and doubles of more than 38 digits keep their own text."""
    near = F.abs(x) < F.lit(float(1 << 53))
    whole = F.when(x < 0, F.ceil(F.when(near, x))).otherwise(F.floor(F.when(near, x)))
    return F.when(near, whole.cast("string")).otherwise(
        F.coalesce(F.when(~F.isnan(x), x).try_cast("decimal(38,0)").cast("string"), x.cast("string"))
    )


def canonical_text(df: DataFrame, name: str) -> Column:
    """Number-or-text field as text: text is kept verbatim, a number becomes the
    text of its integer part (truncated toward zero, at any size), so 12.0 and
    12.9 give "12" and 1e10 gives "10000000000", while the text "12.0" or "001"
    stays as written.  Booleans and JSON nulls give NULL."""
    dtype = _field_type(df, name)
    col = F.col(f"`{name}`")
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, _INTEGRAL):
        return col.cast("string")
    if isinstance(dtype, T.DecimalType):
        return _whole_part(col.cast("string"))
    if isinstance(dtype, _FRACTIONAL):
        return _double_text(col.cast("double"))
    if isinstance(dtype, T.VariantType):
        kind = F.schema_of_variant(col)
        return (
            F.when(kind == "STRING", F.try_variant_get(col, "$", "string"))
            .when(kind.isin("DOUBLE", "FLOAT"), _double_text(F.try_variant_get(col, "$", "double")))
            .when((kind == "BIGINT") | kind.startswith("DECIMAL"), _whole_part(F.to_json(col)))
        )
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("string")
    return col.cast("string")


def source_text(df: DataFrame, name: str) -> Column:
    """The field as its own text (a number keeps its decimal form: 12.9 -> "12.9")."""
    dtype = _field_type(df, name)
    col = F.col(f"`{name}`")
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.VariantType):
        kind = F.schema_of_variant(col)
        return (
            F.when(kind == "STRING", F.try_variant_get(col, "$", "string"))
            .when(kind == "VOID", F.lit(None))
            .otherwise(F.to_json(col))
        )
    return col.cast("string")


def safe_double(col: Column | str) -> Column:
    """Text to double; NULL, empty or unparsable text gives -1 (which the
    samples then drop with ``>= 0``)."""
    return F.coalesce(_c(col).try_cast("double"), F.lit(-1.0))


def month_prefix(date_text: Column | str) -> Column:
    """Text before the first '/' of a ``MM/dd/yyyy ...`` date, kept as text ("01").
    NULL when there is no '/'."""
    d = _c(date_text)
    return F.when(F.instr(d, "/") > 0, F.substring_index(d, "/", 1))


def year_month(year_text: Column | str, date_text: Column | str) -> Column:
    """``<year>/<month>`` key; the year comes from the Year field, the month from the Date text."""
    return F.concat(_c(year_text), F.lit("/"), month_prefix(date_text))
