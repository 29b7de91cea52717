"""Quality checks and layered refinement of financial transactions on Spark."""

from txquality.operators.dedup import newest_created, newest_per_key
from txquality.operators.expectations import Check, run_suite, summarise, verdict
from txquality.operators.merge import merge, merge_batch
from txquality.operators.table_tests import TableTest, run_table_tests
from txquality.plans.bronze import run_bronze
from txquality.plans.gold import gold, run_gold
from txquality.plans.silver import run_silver, silver
from txquality.plans.staging import staging, staging_view
from txquality.plans.validation import run_validation
from txquality.plans.warehouse import run_raw_load, run_refinement
from txquality.session import build_session

__all__ = [
    "Check", "TableTest", "build_session", "gold", "merge", "merge_batch",
    "newest_created", "newest_per_key", "run_bronze", "run_gold", "run_raw_load",
    "run_refinement", "run_silver", "run_suite", "run_table_tests",
    "run_validation", "silver", "staging", "staging_view", "summarise", "verdict",
]
