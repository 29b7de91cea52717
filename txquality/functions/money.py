"""Amounts, fees and exchange to USD in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txquality import schemas

AMOUNT_TYPE = "decimal(18,4)"
FEE_TYPE = "decimal(18,6)"
RATE_TYPE = "decimal(5,4)"


def as_amount(name: str) -> Column:
    """Half-up to four decimals; NaN becomes NULL, too large a value is an error."""
    return F.col(name).cast(AMOUNT_TYPE)


def as_fee(name: str) -> Column:
    return F.col(name).cast(FEE_TYPE)


def usd_rate(currency: Column) -> Column:
    """Rate of a currency code; 1 for a code without one and for NULL."""
    rate = None
    for name, value in schemas.FX_TO_USD.items():
        literal = F.lit(value).cast(RATE_TYPE)
        hit = currency == F.lit(name)
        rate = F.when(hit, literal) if rate is None else rate.when(hit, literal)
    return rate.otherwise(F.lit(1).cast(RATE_TYPE))


def to_usd(amount: Column, currency: Column) -> Column:
    """Unrounded: decimal(18,4) times decimal(5,4) is decimal(24,8)."""
    return amount * usd_rate(currency)


def to_usd_rounded(amount: Column, currency: Column) -> Column:
    """A double amount in USD, rounded half-up to four decimals.

    Multiplied as decimals, so that a tie is a tie and not a matter of the
    last binary digit of a product.
    """
    exact = amount.cast("decimal(28,10)") * usd_rate(currency)
    return F.round(exact, 4).cast("double")


def fee_or_zero(fee: Column) -> Column:
    return F.coalesce(fee, F.lit(0).cast(FEE_TYPE))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL where ``whole`` is 0."""
    return part.cast("double") / F.nullif(whole, F.lit(0))
