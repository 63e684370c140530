"""probity: contract-driven data-quality checks compiled to Spark jobs.

A suite of checks is compiled per table into as few Spark passes as possible:
one fused aggregate for every row-level and scalar check, one shared
``groupBy`` per key for uniqueness / distinct-set checks, one anti join per
foreign key, one range-partitioned window per ordered check, and zero passes
for schema facts.  The result is a long DataFrame with one row per check.
"""

from probity.checks import Check, RESULT_COLUMNS, kinds, normalize_kind
from probity.contract import Contract, load_contract
from probity.operators.profile import profile, profile_tables
from probity.operators.schema import schema_view
from probity.plans.compile import explain_suite, validate, validate_tables
from probity.plans.run import run_contract

__all__ = [
    "Check",
    "Contract",
    "explain_suite",
    "RESULT_COLUMNS",
    "kinds",
    "load_contract",
    "normalize_kind",
    "profile",
    "profile_tables",
    "run_contract",
    "schema_view",
    "validate",
    "validate_tables",
]
