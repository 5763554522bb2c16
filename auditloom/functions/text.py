"""String helpers shared by the extraction, duplicate and report operators."""

import string
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditloom.functions.rounding import fixed_text

# Unicode white space plus the four separators U+001C..U+001F
SPACE = r"[\s\x1c-\x1f]"


def strip(col: Column) -> Column:
    """Remove white space of every kind at both ends; ``trim`` only knows blanks."""
    return F.regexp_replace(col, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def is_blank(col: Column) -> Column:
    """True for null and for text of white space only."""
    return ~F.coalesce(col.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


def or_default(col: Column, default: str) -> Column:
    """``default`` in place of null and of the empty string."""
    return F.when(col.isNull() | (col == ""), F.lit(default)).otherwise(col)


def supplier_key(col: Column) -> Column:
    """Form in which two supplier names are compared; null stays null."""
    return strip(F.lower(col))


@cache
def _other_digits() -> tuple[str, str]:
    """Decimal digits outside ASCII, and their values."""
    others = [
        chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"
    ]
    return "".join(others), "".join(str(unicodedata.decimal(c)) for c in others)


def ascii_digits(col: Column) -> Column:
    """Replace decimal digits of any script by 0-9, so that a cast reads them."""
    others, values = _other_digits()
    return F.when(col.rlike(r"[^\x00-\x7f]"), F.translate(col, others, values)).otherwise(col)


def fill_template(template: str, values: dict[str, Column] | None = None) -> Column:
    """``template.format(**values)`` with columns; doubled braces become single ones.

    A field without a value is the column of that name. The one format spec known
    is a number of decimals, as in ``{total:.2f}``.
    """
    parts = []
    for literal, field, spec, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            value = (values or {}).get(field, F.col(field))
            parts.append(fixed_text(value, int(spec[1:-1])) if spec else value)
    return F.concat(*parts)


def _shortest(col: Column) -> Column:
    """Decimal text of a double; a long one is replaced by 15 or 16 digits if they say the same.

    The JVM may print a digit more than needed to tell a double from its neighbours.
    """
    printed = col.cast("string")

    def shorter(digits: int) -> Column:
        text = F.format_string(f"%.{digits - 1}e", col)
        return F.when(text.try_cast("double") == col, text)

    is_long = F.length(printed) > 16
    return F.when(is_long, F.coalesce(shorter(15), shorter(16), printed)).otherwise(printed)


def float_text(col: Column) -> Column:
    """Text of a double as the reports print it: 100.0, 12345678.9, 1e-05, 1e+16."""
    text = _shortest(col)
    size = F.abs(col)

    def plain(decimals: int) -> Column:
        digits = F.rtrim(text.cast(f"decimal(38,{decimals})").cast("string"), F.lit("0"))
        return F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)

    mantissa = F.regexp_replace(F.regexp_extract(text, r"^(.*)[eE]", 1), r"\.?0+$", "")
    exponent = F.regexp_extract(text, r"[eE][+-]?(\d+)$", 1)
    scientific = F.concat(
        mantissa,
        F.when(size < 1, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.length(exponent) < 2, F.concat(F.lit("0"), exponent)).otherwise(exponent),
    )
    with_exponent = text.rlike("[eE]")
    return (
        F.when(col.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(col), F.lit("nan"))
        .when(col == float("inf"), F.lit("inf"))
        .when(col == float("-inf"), F.lit("-inf"))
        .when((size >= 1e7) & (size < 1e16), plain(12))
        .when((size >= 1e-4) & (size < 1e7) & with_exponent, plain(24))
        .when((size > 0) & ((size < 1e-4) | (size >= 1e16)), scientific)
        .otherwise(text)
    )
