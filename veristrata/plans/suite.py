"""Suites: ordered rules as plain data, written in code or read from their JSON shape."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from veristrata.functions import coding

EXISTS = "expect_column_to_exist"
COLUMN_SET = "expect_table_columns_to_match_set"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
REGEX = "expect_column_values_to_match_regex"
BETWEEN = "expect_column_values_to_be_between"
PAIR_GREATER = "expect_column_pair_values_A_to_be_greater_than_B"
ROW_COUNT = "expect_table_row_count_to_be_between"
DATE_PARSEABLE = "expect_column_values_to_be_dateutil_parseable"
TYPE_LIST = "expect_column_values_to_be_in_type_list"
UNIQUE_PROPORTION = "expect_column_proportion_of_unique_values_to_be_between"


@dataclass(frozen=True)
class Rule:
    """One expectation: its type name and its parameters."""

    kind: str
    params: dict[str, Any] = field(default_factory=dict)
    meta: dict[str, Any] = field(default_factory=dict)

    @property
    def column(self) -> str | None:
        if self.kind == PAIR_GREATER:
            return f"{self.params['column_A']},{self.params['column_B']}"
        return self.params.get("column")

    @property
    def mostly(self) -> float:
        return float(self.params.get("mostly", 1.0))


@dataclass
class Suite:
    """A named list of rules with a chainable vocabulary for adding more."""

    name: str
    rules: list[Rule] = field(default_factory=list)

    def add(self, kind: str, **params: Any) -> Suite:
        self.rules.append(Rule(kind, params))
        return self

    def exists(self, column: str) -> Suite:
        return self.add(EXISTS, column=column)

    def columns_match(self, columns: list[str], exact: bool = False) -> Suite:
        return self.add(COLUMN_SET, column_set=list(columns), exact_match=exact)

    def not_null(self, *columns: str) -> Suite:
        for column in columns:
            self.add(NOT_NULL, column=column)
        return self

    def unique(self, *columns: str) -> Suite:
        for column in columns:
            self.add(UNIQUE, column=column)
        return self

    def in_set(self, column: str, values: Iterable[Any], mostly: float = 1.0) -> Suite:
        return self.add(IN_SET, column=column, value_set=list(values), **_tolerance(mostly))

    def regex(self, column: str, pattern: str, mostly: float = 1.0) -> Suite:
        return self.add(REGEX, column=column, regex=pattern, **_tolerance(mostly))

    def between(self, column: str, low: Any = None, high: Any = None, mostly: float = 1.0) -> Suite:
        return self.add(BETWEEN, column=column, **_bounds(low, high), **_tolerance(mostly))

    def greater(
        self, a: str, b: str, or_equal: bool = False, parse_dates: bool = False
    ) -> Suite:
        extra = {"parse_strings_as_datetimes": True} if parse_dates else {}
        return self.add(PAIR_GREATER, column_A=a, column_B=b, or_equal=or_equal, **extra)

    def row_count(self, low: int | None = None, high: int | None = None) -> Suite:
        return self.add(ROW_COUNT, **_bounds(low, high))

    def date_parseable(self, column: str) -> Suite:
        return self.add(DATE_PARSEABLE, column=column)

    def of_type(self, column: str, types: Iterable[str]) -> Suite:
        return self.add(TYPE_LIST, column=column, type_list=list(types))

    def unique_proportion(self, column: str, low: float | None, high: float | None) -> Suite:
        return self.add(UNIQUE_PROPORTION, column=column, **_bounds(low, high))

    def icd10_oncology(self, column: str, mostly: float = 1.0) -> Suite:
        return self.regex(column, coding.ICD10_ONCOLOGY, mostly)

    def ndc(self, column: str, mostly: float = 0.8) -> Suite:
        return self.regex(column, coding.NDC, mostly)

    def loinc(self, column: str, mostly: float = 1.0) -> Suite:
        return self.regex(column, coding.LOINC, mostly)

    def to_dict(self) -> dict[str, Any]:
        return {
            "expectation_suite_name": self.name,
            "ge_cloud_id": None,
            "meta": {"great_expectations_version": "0.18.0"},
            "expectations": [
                {"expectation_type": r.kind, "kwargs": r.params, "meta": r.meta} for r in self.rules
            ],
        }

    def to_json(self, indent: int | None = 2) -> str:
        return json.dumps(self.to_dict(), indent=indent)

    @classmethod
    def from_dict(cls, data: dict[str, Any]) -> Suite:
        rules = [
            Rule(e.get("expectation_type", ""), e.get("kwargs", {}), e.get("meta", {}))
            for e in data.get("expectations", [])
        ]
        return cls(data["expectation_suite_name"], rules)

    @classmethod
    def from_json(cls, text: str) -> Suite:
        return cls.from_dict(json.loads(text))


def _tolerance(mostly: float) -> dict[str, float]:
    return {} if mostly == 1.0 else {"mostly": mostly}


def _bounds(low: Any, high: Any) -> dict[str, Any]:
    given = {"min_value": low, "max_value": high}
    return {k: v for k, v in given.items() if v is not None}
