"""Missing values and the type classes that decide which statistics a column gets."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def field(name: str) -> Column:
    """Column by its exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_missing(df: DataFrame) -> DataFrame:
    """NaN becomes NULL, so that one notion of missing holds for every operator."""
    floating = {
        f.name: F.nanvl(field(f.name), F.lit(None).cast(f.dataType))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floating) if floating else df


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns without booleans (correlations, anomalies, accuracy)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def numeric_or_bool_columns(df: DataFrame) -> list[str]:
    """Numeric columns and booleans (profile statistics, validity, drift)."""
    return [f.name for f in df.schema.fields if is_numeric_or_bool(f.dataType)]


def is_numeric_or_bool(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.BooleanType))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_string(f.dataType)]


def is_string(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.CharType, T.VarcharType))


def temporal_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _TEMPORAL)]


def is_temporal(data_type: T.DataType) -> bool:
    return isinstance(data_type, _TEMPORAL)


def as_double(df: DataFrame, name: str) -> Column:
    """Numeric or boolean column as double; booleans count as 0 and 1."""
    column = field(name)
    if isinstance(df.schema[name].dataType, T.BooleanType):
        column = column.cast("int")
    return column.cast("double")


# Forms of dates in texts, tried in this order after ISO 8601; day or month without a leading zero, too. A
# numeric form reads the month first.
DATE_FORMS = (
    "yyyyMMdd", "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "yyyy/M/d", "yyyy/M/d H:mm:ss", "M-d-yyyy",
    "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "MMM d yyyy",
)


def as_timestamp(df: DataFrame, name: str, forms: Sequence[str] = DATE_FORMS) -> Column:
    """Column as wall-clock timestamp; text in none of the forms becomes NULL.

    Texts that are no ISO dates are looked at by their shape first, so that each is tried in few forms.
    """
    column = field(name)
    if not is_string(df.schema[name].dataType):
        return column.cast("timestamp_ntz")
    text = F.btrim(column)
    iso = F.expr(f"try_cast(trim(`{name.replace('`', '``')}`) AS timestamp_ntz)")
    tried = [
        F.when(text.rlike(_shape(form)), F.try_to_timestamp(text, F.lit(form))).cast("timestamp_ntz") for form in forms
    ]
    plain_year_first = text.rlike("^[0-9]{8}$")
    return F.coalesce(F.when(~plain_year_first, iso), *tried)


def _shape(form: str) -> str:
    """A pattern that texts of a form have: digits for numbers, letters for names of months."""
    shapes = {
        "yyyyMMdd": "[0-9]{8}", "yyyy": "[0-9]{4}", "MMMM": "[A-Za-z]{3,9}", "MMM": "[A-Za-z]{3}", "mm": "[0-9]{2}",
        "ss": "[0-9]{2}", "M": "[0-9]{1,2}", "d": "[0-9]{1,2}", "H": "[0-9]{1,2}",
    }
    return "^" + re.sub("|".join(shapes), lambda m: shapes[m[0]], form) + "$"


def literal(value: object) -> str:
    """A Python value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"double('{value!r}')"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def result_rows(rows: Sequence[dict[str, str]]) -> Column:
    """One aggregate row turned into result rows, each given as name -> SQL text.

    As text, a report of hundreds of cells is one expression to parse instead of hundreds of calls.
    """
    structs = [
        "named_struct(" + ", ".join(f"{literal(n)}, {e}" for n, e in row.items()) + ")"
        for row in rows
    ]
    return F.expr(f"inline(array({', '.join(structs)}))")
