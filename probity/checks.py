"""The check IR: one ``Check`` per expectation, plus the registry of kinds.

Semantics shared by every check (the reference leaves them to an external
library, so these are our definitions):

* ``element_count``   all rows of the table;
* ``missing_count``   rows where an input column is null (these rows are not
  judged by row-level checks, except ``column_values_to_not_be_null`` /
  ``column_values_to_be_null`` which judge every row);
* ``unexpected_count`` judged rows that break the rule;
* ``unexpected_percent`` = 100 * unexpected / judged rows (0 when none judged);
* ``success`` = ``(judged - unexpected) / judged >= mostly`` (an empty column passes),
  unless the check carries a ``must_be_less_than`` threshold (count, or percent
  of all rows when ``unit='percent'``), which is strict, or a share threshold
  ``params['share']`` (``">95%"``: good share strictly above, ``"<5%"``:
  bad share strictly below);
* ``observed_value``  the measured scalar of aggregate checks, else null.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

RESULT_COLUMNS = [
    "check_id",
    "element_count",
    "missing_count",
    "unexpected_count",
    "unexpected_percent",
    "success",
    "observed_value",
]

RESULT_DDL = (
    "check_id STRING, element_count BIGINT, missing_count BIGINT, unexpected_count BIGINT, "
    "unexpected_percent DOUBLE, success BOOLEAN, observed_value DOUBLE"
)

# The 56 expectation type names the reference lists, in its order.
EXPECTATION_TYPES = """
ExpectColumnDistinctValuesToBeInSet
ExpectColumnDistinctValuesToContainSet
ExpectColumnDistinctValuesToEqualSet
ExpectColumnKLDivergenceToBeLessThan
ExpectColumnMaxToBeBetween
ExpectColumnMeanToBeBetween
ExpectColumnMedianToBeBetween
ExpectColumnMinToBeBetween
ExpectColumnMostCommonValueToBeInSet
ExpectColumnPairValuesAToBeGreaterThanB
ExpectColumnPairValuesToBeEqual
ExpectColumnPairValuesToBeInSet
ExpectColumnProportionOfNonNullValuesToBeBetween
ExpectColumnProportionOfUniqueValuesToBeBetween
ExpectColumnQuantileValuesToBeBetween
ExpectColumnStdevToBeBetween
ExpectColumnSumToBeBetween
ExpectColumnToExist
ExpectColumnUniqueValueCountToBeBetween
ExpectColumnValueLengthsToBeBetween
ExpectColumnValueLengthsToEqual
ExpectColumnValueZScoresToBeLessThan
ExpectColumnValuesToBeBetween
ExpectColumnValuesToBeDateutilParseable
ExpectColumnValuesToBeDecreasing
ExpectColumnValuesToBeInSet
ExpectColumnValuesToBeInTypeList
ExpectColumnValuesToBeIncreasing
ExpectColumnValuesToBeJsonParseable
ExpectColumnValuesToBeNull
ExpectColumnValuesToBeOfType
ExpectColumnValuesToBeUnique
ExpectColumnValuesToMatchJsonSchema
ExpectColumnValuesToMatchLikePattern
ExpectColumnValuesToMatchLikePatternList
ExpectColumnValuesToMatchRegex
ExpectColumnValuesToMatchRegexList
ExpectColumnValuesToMatchStrftimeFormat
ExpectColumnValuesToNotBeInSet
ExpectColumnValuesToNotBeNull
ExpectColumnValuesToNotMatchLikePattern
ExpectColumnValuesToNotMatchLikePatternList
ExpectColumnValuesToNotMatchRegex
ExpectColumnValuesToNotMatchRegexList
ExpectCompoundColumnsToBeUnique
ExpectMulticolumnSumToEqual
ExpectMulticolumnValuesToBeUnique
ExpectQueryResultsToMatchComparison
ExpectSelectColumnValuesToBeUniqueWithinRecord
ExpectTableColumnCountToBeBetween
ExpectTableColumnCountToEqual
ExpectTableColumnsToMatchOrderedList
ExpectTableColumnsToMatchSet
ExpectTableRowCountToBeBetween
ExpectTableRowCountToEqual
ExpectTableRowCountToEqualOtherTable
""".split()


def _snake(camel: str) -> str:
    s = camel[len("Expect"):] if camel.startswith("Expect") else camel
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s).lower()


KINDS: list[str] = [_snake(n) for n in EXPECTATION_TYPES]

# Extra kinds that only the contract layer emits (they are not library names).
CONTRACT_KINDS = ["foreign_key", "freshness", "row_condition", "sql_scalar", "conditional_not_null"]

# How each kind is evaluated (see plans.compile):
#   A  one fused aggregate pass per table       G  shared groupBy per key
#   J  join / second table                       O  range-partitioned ordered pass
#   M  schema facts only, no scan
PASS_OF: dict[str, str] = {}
for _k in KINDS:
    PASS_OF[_k] = "A"
for _k in (
    "column_distinct_values_to_be_in_set",
    "column_distinct_values_to_contain_set",
    "column_distinct_values_to_equal_set",
    "column_kl_divergence_to_be_less_than",
    "column_most_common_value_to_be_in_set",
    "column_proportion_of_unique_values_to_be_between",
    "column_unique_value_count_to_be_between",
    "column_values_to_be_unique",
    "compound_columns_to_be_unique",
    "multicolumn_values_to_be_unique",
):
    PASS_OF[_k] = "G"
for _k in ("query_results_to_match_comparison", "foreign_key", "sql_scalar"):
    PASS_OF[_k] = "J"
for _k in ("column_values_to_be_increasing", "column_values_to_be_decreasing"):
    PASS_OF[_k] = "O"
for _k in (
    "column_to_exist",
    "column_values_to_be_in_type_list",
    "column_values_to_be_of_type",
    "table_column_count_to_be_between",
    "table_column_count_to_equal",
    "table_columns_to_match_ordered_list",
    "table_columns_to_match_set",
):
    PASS_OF[_k] = "M"
for _k in ("freshness", "row_condition", "conditional_not_null"):
    PASS_OF[_k] = "A"


def kinds() -> list[str]:
    return list(KINDS)


def normalize_kind(kind: str) -> str:
    """Accept ``ExpectColumnValuesToNotBeNull``, ``expect_column_values_to_not_be_null``
    or ``column_values_to_not_be_null``; return the last form."""
    k = kind.strip()
    if k[:1].isupper():
        k = _snake(k)
    if k.startswith("expect_"):
        k = k[len("expect_"):]
    if k not in PASS_OF:
        raise ValueError(f"unknown check kind: {kind}")
    return k


_SHORT = {
    "column_values_to_not_be_null": "not_null",
    "column_values_to_be_unique": "unique",
    "column_values_to_be_between": "range",
    "column_values_to_be_in_set": "domain",
}


@dataclass(frozen=True)
class Check:
    """One expectation on one table.

    ``columns`` holds the input columns (one for column checks, several for
    pair / multicolumn checks, none for table checks).  ``params`` holds the
    kind's keyword arguments (``min_value``, ``value_set``, ``regex`` ...).
    """

    table: str
    kind: str
    columns: tuple[str, ...] = ()
    params: dict[str, Any] = field(default_factory=dict, hash=False, compare=False)
    mostly: float = 1.0
    must_be_less_than: float | None = None
    unit: str | None = None  # None: a count; "percent": percent of all rows
    check_id: str = ""

    def __post_init__(self):
        object.__setattr__(self, "kind", normalize_kind(self.kind))
        cols = self.columns
        if isinstance(cols, str):
            cols = (cols,)
        object.__setattr__(self, "columns", tuple(cols))
        if not (0.0 <= float(self.mostly) <= 1.0):
            raise ValueError("mostly must be in [0, 1]")
        if not self.check_id:
            object.__setattr__(self, "check_id", default_check_id(self.table, self.columns, self.kind))

    @property
    def column(self) -> str | None:
        return self.columns[0] if self.columns else None

    @property
    def pass_kind(self) -> str:
        # type checks on text sources become a value-level cast test (scans)
        if self.kind in ("column_values_to_be_of_type", "column_values_to_be_in_type_list") and self.params.get("value_test"):
            return "A"
        # KL against numeric bins: per-bin counts in the fused pass, no groupBy
        if self.kind == "column_kl_divergence_to_be_less_than" and "bins" in (self.params.get("partition_object") or {}):
            return "A"
        # distinct counts with approx=True: HyperLogLog in the fused pass, no groupBy
        if self.kind in ("column_unique_value_count_to_be_between", "column_proportion_of_unique_values_to_be_between") \
                and self.params.get("approx"):
            return "A"
        return PASS_OF[self.kind]

    def p(self, name: str, default: Any = None) -> Any:
        return self.params.get(name, default)

    @classmethod
    def from_dict(cls, table: str, spec: dict[str, Any]) -> "Check":
        """Build from ``{"type": ..., "kwargs": {...}, "meta": {"check_id": ...}}``."""
        kw = dict(spec.get("kwargs") or {})
        cols: tuple[str, ...] = ()
        for key in ("column", "column_A"):
            if key in kw:
                cols = (kw.pop(key),)
        if "column_B" in kw:
            cols = cols + (kw.pop("column_B"),)
        if "column_list" in kw and not spec["type"].endswith("ordered_list"):
            cols = tuple(kw.pop("column_list"))
        mostly = float(kw.pop("mostly", 1.0))
        meta = spec.get("meta") or {}
        return cls(table, spec["type"], cols, kw, mostly=mostly, check_id=meta.get("check_id", ""))


def default_check_id(table: str, columns: tuple[str, ...], kind: str) -> str:
    return f"{table}:{'+'.join(columns)}:{_SHORT.get(kind, kind)}"
