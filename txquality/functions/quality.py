"""Fault flags of the bronze layer as column expressions.

Comparisons with NULL stay NULL, so a combined flag is TRUE if any part is
TRUE, else NULL if any part is NULL, else FALSE.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from txquality import schemas


def is_missing(name: str) -> Column:
    return F.col(name).isNull()


def is_negative(name: str) -> Column:
    return F.col(name) < F.lit(0)


def outside_domain(name: str, domain: Sequence[str]) -> Column:
    return ~F.col(name).isin(*domain)


def any_of(flags: Sequence[Column]) -> Column:
    return reduce(or_, flags)


def transaction_flags() -> dict[str, Column]:
    flags = {
        "dq_null_transaction_id": is_missing("transaction_id"),
        "dq_null_customer_id": is_missing("customer_id"),
        "dq_null_amount": is_missing("amount"),
        "dq_negative_amount": is_negative("amount"),
        "dq_invalid_currency": outside_domain("currency", schemas.CURRENCIES),
        "dq_invalid_status": outside_domain("status", schemas.STATUSES),
    }
    return flags | {"dq_has_issues": any_of(list(flags.values()))}


def customer_flags() -> dict[str, Column]:
    flags = {
        "dq_null_customer_id": is_missing("customer_id"),
        "dq_null_email": is_missing("email"),
    }
    return flags | {"dq_has_issues": any_of(list(flags.values()))}
