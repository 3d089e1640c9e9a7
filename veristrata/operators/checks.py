"""Each rule type as predicates over one row, decided from the table's schema at plan time."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veristrata.functions.columns import as_timestamp, field, is_string, is_temporal
from veristrata.functions.text import matches_from_start, plain_number
from veristrata.plans import suite as S

SKIPPED = {S.COLUMN_SET, S.DATE_PARSEABLE, S.TYPE_LIST, S.UNIQUE_PROPORTION}


@dataclass
class RowCheck:
    """``considered`` rows take part (all, if None); ``bad`` ones fail as evaluated,
    ``bad_declared`` ones as written."""

    considered: Column | None
    bad: Column
    bad_declared: Column | None = None
    type_error: bool = False


@dataclass
class DistinctCheck:
    """Rule on the distinct values of a column (uniqueness, or the share of distinct values)."""

    column: str
    proportion: bool = False


@dataclass
class RowCountCheck:
    low: float | None
    high: float | None


@dataclass
class StaticCheck:
    """Outcome known from the schema alone."""

    success: bool
    success_declared: bool
    status: str = "evaluated"
    unexpected: int | None = None


Check = RowCheck | DistinctCheck | RowCountCheck | StaticCheck
CustomRule = Callable[[DataFrame, dict[str, Any]], Column]
_CUSTOM: dict[str, CustomRule] = {}


def register_rule(kind: str, bad_row: CustomRule) -> None:
    """Add a rule type: ``bad_row(df, params)`` is TRUE for failing rows, NULL for rows to ignore."""
    _CUSTOM[kind] = bad_row


def compile_rule(df: DataFrame, rule: S.Rule) -> Check:
    """Turn a rule into a check against ``df``; needs only the schema."""
    p = rule.params
    if rule.kind in _CUSTOM:
        bad = _CUSTOM[rule.kind](df, p)
        return RowCheck(bad.isNotNull(), F.coalesce(bad, F.lit(False)))
    if rule.kind == S.EXISTS:
        found = p.get("column") in df.columns
        return StaticCheck(found, found)
    if rule.kind == S.COLUMN_SET:
        return _column_set(df, p)
    if rule.kind == S.ROW_COUNT:
        return RowCountCheck(p.get("min_value", 0), p.get("max_value"))
    if rule.kind not in _BY_KIND:
        return StaticCheck(True, True, "skipped")
    needed = [p[k] for k in ("column", "column_A", "column_B") if k in p]
    if any(c not in df.columns for c in needed):
        skipped = rule.kind in SKIPPED
        return StaticCheck(skipped, False, "skipped" if skipped else "missing_column")
    return _BY_KIND[rule.kind](df, p)


def _column_set(df: DataFrame, p: dict[str, Any]) -> Check:
    wanted, found = set(p.get("column_set", [])), set(df.columns)
    off = wanted - found
    if p.get("exact_match"):
        off = off | (found - wanted)
    return StaticCheck(True, not off, "skipped", len(off))


def _not_null(df: DataFrame, p: dict[str, Any]) -> Check:
    return RowCheck(None, field(p["column"]).isNull())


def _unique(df: DataFrame, p: dict[str, Any]) -> Check:
    return DistinctCheck(p["column"])


def _unique_proportion(df: DataFrame, p: dict[str, Any]) -> Check:
    return DistinctCheck(p["column"], proportion=True)


def _in_set(df: DataFrame, p: dict[str, Any]) -> Check:
    column = field(p["column"])
    data_type = df.schema[p["column"]].dataType
    members = [v for v in p.get("value_set", []) if _comparable(v, data_type)]
    inside = column.isin(members) if members else F.lit(False)
    return RowCheck(column.isNotNull(), F.coalesce(~inside, F.lit(False)))


def _comparable(value: Any, data_type: T.DataType) -> bool:
    if is_string(data_type):
        return isinstance(value, str)
    if isinstance(data_type, T.BooleanType):
        return isinstance(value, bool)
    if isinstance(data_type, T.NumericType):
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return value is not None


def _regex(df: DataFrame, p: dict[str, Any]) -> Check:
    column = field(p["column"])
    if isinstance(df.schema[p["column"]].dataType, T.BooleanType):
        column = F.initcap(column.cast("string"))
    elif isinstance(df.schema[p["column"]].dataType, (T.DoubleType, T.FloatType)):
        column = plain_number(column.cast("double"))
    hit = matches_from_start(column, p.get("regex", ".*"))
    return RowCheck(column.isNotNull(), F.coalesce(~hit, F.lit(False)))


def _between(df: DataFrame, p: dict[str, Any]) -> Check:
    column = field(p["column"])
    data_type = df.schema[p["column"]].dataType
    low, high = p.get("min_value"), p.get("max_value")
    bounds = [b for b in (low, high) if b is not None]
    wrong_type = any(isinstance(b, str) != _takes_text_bounds(data_type) for b in bounds)
    if wrong_type:
        return RowCheck(column.isNotNull(), F.lit(False), type_error=True)
    outside = F.lit(False)
    if low is not None:
        outside = outside | (column < _bound(low, data_type))
    if high is not None:
        outside = outside | (column > _bound(high, data_type))
    return RowCheck(column.isNotNull(), F.coalesce(outside, F.lit(False)))


def _takes_text_bounds(data_type: T.DataType) -> bool:
    return is_string(data_type) or is_temporal(data_type)


def _bound(value: Any, data_type: T.DataType) -> Column:
    return F.lit(value).cast(data_type) if is_temporal(data_type) else F.lit(value)


def _pair(df: DataFrame, p: dict[str, Any]) -> Check:
    names = (p["column_A"], p["column_B"])
    numeric = [isinstance(df.schema[n].dataType, T.NumericType) for n in names]
    if all(numeric):
        a, b = (field(n) for n in names)
    elif any(numeric):
        return RowCheck(field(names[0]).isNotNull(), F.lit(False), type_error=True)
    else:
        a, b = (as_timestamp(df, n) for n in names)
    both = a.isNotNull() & b.isNotNull()
    bad = F.coalesce(a < b, F.lit(False))
    strict = None if p.get("or_equal") else F.coalesce(a <= b, F.lit(False))
    return RowCheck(both, bad, strict)


def _date_parseable(df: DataFrame, p: dict[str, Any]) -> Check:
    column = field(p["column"])
    return RowCheck(column.isNotNull(), column.isNotNull() & as_timestamp(df, p["column"]).isNull())


# Names under which suites know the Spark types.
_TYPE_NAMES = {
    "boolean": {"boolean", "bool"},
    "tinyint": {"tinyint", "int8", "byte"},
    "smallint": {"smallint", "int16", "short"},
    "int": {"int", "integer", "int32"},
    "bigint": {"bigint", "long", "int64", "int"},
    "float": {"float", "float32", "real"},
    "double": {"double", "float64", "float", "double_precision"},
    "string": {"string", "str", "object", "varchar", "text"},
    "date": {"date"},
    "timestamp": {"timestamp", "datetime", "datetime64[ns]"},
    "timestamp_ntz": {"timestamp", "timestamp_ntz", "datetime", "datetime64[ns]"},
}


def _type_list(df: DataFrame, p: dict[str, Any]) -> Check:
    name = df.schema[p["column"]].dataType.simpleString()
    known = _TYPE_NAMES.get(name, {name})
    return StaticCheck(True, bool(known & {t.lower() for t in p.get("type_list", [])}), "skipped")


_BY_KIND: dict[str, Callable[[DataFrame, dict[str, Any]], Check]] = {
    S.NOT_NULL: _not_null,
    S.UNIQUE: _unique,
    S.IN_SET: _in_set,
    S.REGEX: _regex,
    S.BETWEEN: _between,
    S.PAIR_GREATER: _pair,
    S.DATE_PARSEABLE: _date_parseable,
    S.TYPE_LIST: _type_list,
    S.UNIQUE_PROPORTION: _unique_proportion,
}
