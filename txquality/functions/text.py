"""Text clean-up and text-to-number coercion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column's name for an expression, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def code(name: str) -> Column:
    """Trimmed and upper-cased, for values compared with a domain."""
    return F.upper(trimmed(name))


def null_if_token(name: str, tokens: Sequence[str]) -> Column:
    """The text, or NULL where it is one of ``tokens``."""
    return F.when(~F.col(name).isin(*tokens), F.col(name))


def typed(text: Column, kind: T.DataType) -> Column:
    """Text as ``kind``, NULL where it does not fit. Whole numbers may be written
    with decimals, as tools do that hold a column with gaps as floating point; a
    number with a fraction does not fit."""
    if isinstance(kind, T.IntegralType):
        number = text.try_cast("decimal(38,18)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    return text.try_cast(kind)


def number_or_null(df: DataFrame, name: str) -> Column:
    """``name`` as double; text that is no number, and NaN, become NULL."""
    kind = df.schema[name].dataType
    column = F.col(quoted(name))
    if isinstance(kind, T.StringType):
        # "1d" and "2.5F" are numbers to the cast but not to a reader of plain CSV
        column = F.when(~column.rlike(r"[0-9.][dDfF]\s*$"), column)
        return F.nanvl(column.try_cast("double"), F.lit(None).cast("double"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.nanvl(column.cast("double"), F.lit(None).cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    return column.cast("string").try_cast("double")
