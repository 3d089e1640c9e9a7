"""Text predicates of the consistency, validity and record checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def strip(text: Column) -> Column:
    """Text without white space at both ends (all Unicode spaces, not just blanks)."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """Nothing but white space. Texts that start with a visible ASCII character are told by one
    comparison."""
    visible_start = (text >= F.lit("!")) & (text < F.lit("\x7f"))
    return F.when(visible_start, F.lit(False)).otherwise(strip(text) == "")


def is_upper(text: Column) -> Column:
    return text == F.upper(text)


def is_lower(text: Column) -> Column:
    return text == F.lower(text)


def is_title(text: Column) -> Column:
    """Each run of letters starts with a capital and goes on in small letters.

    ``initcap`` is no substitute: it does not start a new word after an apostrophe or a hyphen.
    """
    small_start = (text >= F.lit("a")) & (text < F.lit("{"))
    broken = text.rlike(rf"(?:^|[^{_CASED}])\p{{Ll}}|[{_CASED}]\p{{Lu}}")
    return F.when(small_start, F.lit(False)).otherwise(~broken)


def plain_number(value: Column) -> Column:
    """A double as text without an exponent where its size is between 1e-4 and 1e16, always with a fraction;
    beyond, a mantissa and a signed exponent of two digits at least: ``12345678.0``, ``1e-05``."""
    text = value.cast("string")
    size = F.abs(value)
    digits = F.when(size < 1, text.try_cast("decimal(38,24)").cast("string")).otherwise(
        text.try_cast("decimal(38,12)").cast("string")
    )
    plain = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", ".0")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1)
    sign = F.when(exponent.startswith("-"), "-").otherwise("+")
    power = F.lpad(F.regexp_replace(exponent, "^-", ""), 2, "0")
    long_power = F.when(F.char_length(F.regexp_replace(exponent, "^-", "")) > 2, F.regexp_replace(exponent, "^-", ""))
    scientific = F.concat(mantissa, F.lit("e"), sign, F.coalesce(long_power, power))
    infinite = F.when(value > 0, "inf").otherwise("-inf")
    return (
        F.when(size == float("inf"), infinite)
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def matches_from_start(text: Column, pattern: str) -> Column:
    """Pattern anchored at the start of the text only."""
    return text.cast("string").rlike(f"^(?:{pattern})")
