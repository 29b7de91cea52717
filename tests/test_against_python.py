"""Random dirty rows through the layers, against plain Python on the same rows."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tests.helpers import AT, bronze_of, raw, staged_of
from txquality import schemas
from txquality.operators import expectations as ex
from txquality.operators import table_tests
from txquality.plans import silver
from txquality.plans.gold import gold

START = datetime(2024, 1, 1)
FOUR, SIX = Decimal("0.0001"), Decimal("0.000001")


def _random_rows(seed, count=600):
    pick = random.Random(seed)
    rows = []
    for i in range(count):
        when = START + timedelta(hours=pick.randrange(100))
        rows.append(
            {
                # one id holds a third of the rows
                "transaction_id": pick.choice(["hot", None, f"t{pick.randrange(200)}"] if pick.random() < 0.6 else [f"t{pick.randrange(200)}"]),
                "customer_id": pick.choice([None, "c1", "c2", "c3", "c4", "c5"]),
                "amount": pick.choice([None, 0.0, -3.5, 0.00004, round(pick.uniform(1, 1000), pick.randrange(7))]),
                "currency": pick.choice([None, "XXX", " usd ", *schemas.CURRENCIES]),
                "status": pick.choice([None, "INVALID", "completed", *schemas.STATUSES]),
                "transaction_date": pick.choice(["bad", when.isoformat(), when.isoformat()]),
                "settlement_date": pick.choice([None, (when + timedelta(days=pick.randrange(-1, 3))).isoformat()]),
                "fee_amount": pick.choice([None, round(pick.uniform(0, 5), pick.randrange(8))]),
                "created_at": (START + timedelta(minutes=i)).isoformat(),
                "reference_number": f" R{i} ",
            }
        )
    return rows


def _rounded(value, step):
    return None if value is None else Decimal(repr(value)).quantize(step, rounding=ROUND_HALF_UP)


def _staged(row):
    out = dict(row)
    for name in ("currency", "status"):
        out[name] = row[name].strip().upper() if row[name] else None
    out["amount"] = _rounded(row["amount"], FOUR)
    out["fee_amount"] = _rounded(row["fee_amount"], SIX)
    for name in ("transaction_date", "settlement_date"):
        out[name] = datetime.fromisoformat(row[name]) if row[name] not in (None, "bad") else None
    return out


def _silver(rows):
    newest = {}
    for row in map(_staged, rows):
        valid = (
            row["transaction_id"] and row["customer_id"] and row["amount"] and row["amount"] > 0
            and row["currency"] in schemas.CURRENCIES and row["status"] in schemas.STATUSES
            and row["transaction_date"]
        )
        if valid:
            best = newest.get(row["transaction_id"])
            if best is None or row["created_at"] > best["created_at"]:
                newest[row["transaction_id"]] = row
    return newest


@pytest.fixture(params=[1, 2])
def rows(request):
    return _random_rows(request.param)


def test_flags(spark, rows):
    found = {r["created_at"]: r for r in bronze_of(raw(spark, *rows)).collect()}
    for row in rows:
        flags = [
            row["transaction_id"] is None,
            row["customer_id"] is None,
            row["amount"] is None,
            None if row["amount"] is None else row["amount"] < 0,
            None if row["currency"] is None else row["currency"] not in schemas.CURRENCIES,
            None if row["status"] is None else row["status"] not in schemas.STATUSES,
        ]
        combined = True if True in flags else None if None in flags else False
        got = found[row["created_at"]]
        assert [got[name] for name in schemas.TRANSACTION_FLAGS] == [*flags, combined]


def test_silver_and_gold(spark, rows):
    expected = _silver(rows)
    stored = silver.silver(staged_of(raw(spark, *rows)), AT)
    found = {r["transaction_id"]: r for r in stored.collect()}
    assert set(found) == set(expected) and "hot" in found
    groups = defaultdict(list)
    for key, row in expected.items():
        got = found[key]
        assert got["reference_number"] == row["reference_number"].strip()
        assert (got["amount"], got["fee_amount"]) == (row["amount"], row["fee_amount"])
        assert got["amount_usd"] == row["amount"] * schemas.FX_TO_USD[row["currency"]]
        assert got["total_with_fees"] == row["amount"] + (row["fee_amount"] or 0)
        settled = row["settlement_date"]
        days = None if settled is None else (settled.date() - row["transaction_date"].date()).days
        assert got["settlement_days"] == days
        assert got["is_failed"] == (row["status"] in ("FAILED", "CANCELLED"))
        day = datetime.combine(row["transaction_date"].date(), datetime.min.time())
        groups[day, row["currency"], row["status"]].append((row["amount"], days))

    daily = {(r["transaction_day"], r["currency"], r["status"]): r for r in gold(stored, AT).collect()}
    assert set(daily) == set(groups)
    for key, members in groups.items():
        amounts = [amount for amount, _ in members]
        days = [d for _, d in members if d is not None]
        got = daily[key]
        assert got["total_transactions"] == len(members)
        assert (got["total_amount"], got["min_amount"], got["max_amount"]) == (sum(amounts), min(amounts), max(amounts))
        assert float(got["avg_amount"]) == pytest.approx(float(sum(amounts) / len(amounts)), abs=1e-7)
        assert got["success_rate"] == float(key[2] == "COMPLETED")
        average = sum(days) / len(days) if days else None
        assert got["avg_settlement_days"] == (None if average is None else pytest.approx(average))


def test_checks(spark, rows):
    df = bronze_of(raw(spark, *rows))
    n = len(rows)
    amounts = [r["amount"] for r in rows if r["amount"] is not None]
    ids = [r["transaction_id"] for r in rows if r["transaction_id"] is not None]
    checks = [
        ex.no_nulls("amount"), ex.values_in_set("status", schemas.STATUSES), ex.not_negative("amount"),
        ex.values_between("amount", 0, 500), ex.unique("transaction_id"), ex.row_count_above(n),
    ]
    observed = [r["observed"] for r in ex.run_suite(df, "s", checks).orderBy("position").collect()]
    assert observed == [
        (n - len(amounts)) / n,
        sum(r["status"] in schemas.STATUSES for r in rows) / n,
        sum(a < 0 for a in amounts) / len(amounts),
        sum(0 <= a <= 500 for a in amounts) / len(amounts),
        len(ids) - len(set(ids)),
        n,
    ]
    repeated = table_tests.unique(df, "transaction_id").first()["failures"]
    assert repeated == sum(ids.count(i) > 1 for i in set(ids))
    bad = table_tests.accepted_values(df, "currency", schemas.CURRENCIES).first()["failures"]
    assert bad == len({r["currency"] for r in rows} - {None, *schemas.CURRENCIES})
