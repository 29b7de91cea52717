"""A folder of JSON lines taken into Bronze by micro-batches."""

import json
import os

from tests.helpers import VALID, one
from txquality.operators.profile import dq_summary
from txquality.plans import bronze, feed


def arrive(tmp_path, name, *lines):
    os.makedirs(tmp_path / "in", exist_ok=True)
    whole = tmp_path / f"{name}.part"
    whole.write_text("".join(f"{line}\n" for line in lines))
    os.rename(whole, tmp_path / "in" / name)


def run(spark, tmp_path, **more):
    return feed.run_feed(spark, f"{tmp_path}/in", f"{tmp_path}/bronze", f"{tmp_path}/progress", **more)


def line(name, **fields):
    return json.dumps({**VALID, "transaction_id": name, **fields})


def held(spark, tmp_path):
    return sorted(r["transaction_id"] for r in bronze.read_bronze_transactions(spark, f"{tmp_path}/bronze").collect())


def refused(spark, tmp_path):
    return sorted(r["line"] for r in feed.read_rejects(spark, f"{tmp_path}/bronze").collect())


def test_files_are_taken_once(spark, tmp_path):
    arrive(tmp_path, "1.json", line("a"), line("b", amount=None))
    assert run(spark, tmp_path) == 1 and held(spark, tmp_path) == ["a", "b"]
    assert run(spark, tmp_path) == 0 and held(spark, tmp_path) == ["a", "b"]
    arrive(tmp_path, "2.json", line("c"))
    arrive(tmp_path, "3.json", line("d"))
    assert run(spark, tmp_path, files_per_batch=1) == 2
    assert held(spark, tmp_path) == ["a", "b", "c", "d"]
    summary = one(dq_summary(bronze.read_bronze_transactions(spark, f"{tmp_path}/bronze"), "Transactions"))
    assert (summary["total_rows"], summary["issue_rows"]) == (4, 1)


def test_malformed_lines_are_rejects(spark, tmp_path):
    bad = ['{"transaction_id": "cut', "no json", line("typed", amount="much"), "7"]
    arrive(tmp_path, "1.json", line("a"), *bad, "", "   ", line("b", extra=1), json.dumps({"transaction_id": "short"}))
    run(spark, tmp_path)
    assert held(spark, tmp_path) == ["a", "b", "short"]
    assert refused(spark, tmp_path) == sorted(bad)
    assert {os.path.basename(r["source_file"]) for r in feed.read_rejects(spark, f"{tmp_path}/bronze").collect()} == {"1.json"}


def test_a_batch_that_is_run_again_replaces_itself(spark, tmp_path):
    arrive(tmp_path, "1.json", line("a"), "bad")
    run(spark, tmp_path)
    arrive(tmp_path, "2.json", line("b"), "worse")
    run(spark, tmp_path)
    # as after a failure between the batch's writes and the note that it is done
    for name in ("1", ".1.crc"):
        os.remove(tmp_path / "progress" / "commits" / name)
    assert run(spark, tmp_path) == 1
    assert held(spark, tmp_path) == ["a", "b"] and refused(spark, tmp_path) == ["bad", "worse"]
