"""Amount expressions: total check, first digits, anomaly features."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditloom.functions.rounding import exact_round

DIGITS = range(1, 10)
DIGIT_COLUMNS = [f"d{d}" for d in DIGITS]


def ttc_valid(ht: Column, tva: Column, ttc: Column, tolerance: float) -> Column:
    """Whether HT + TVA gives TTC; null while one of the three is missing."""
    return F.abs(ttc - exact_round(ht + tva, 2)) <= tolerance


def first_digit(amount: Column) -> Column:
    """First digit 1-9 of a positive amount's decimal text, null when it has none.

    The text of an amount in [0.0001, 0.1) starts with a zero after the point and
    counts as having no first digit; smaller amounts are written with an exponent
    and do have one.
    """
    significant = F.ltrim(amount.cast("string"), F.lit("0."))
    counted = (amount > 0) & ((amount >= 0.1) | (amount < 1e-4))
    code = F.ascii(F.substring(significant, 1, 1))
    return F.when(counted & code.between(49, 57), code - 48)


def anomaly_features(n_lines: Column, line_sum: Column, ht: Column, ttc: Column) -> dict[str, Column]:
    """The four inputs of the forest; all null unless TTC is positive."""
    usable = ttc > 0

    def feature(value: Column) -> Column:
        return F.when(usable, value)

    return {
        "f_amount": feature(ttc),
        "f_lines": feature(n_lines.cast("double")),
        "f_ratio": feature(F.when(ht > 0, ttc / F.when(ht > 0, ht)).otherwise(1.0)),
        "f_gap": feature(F.abs(ttc - line_sum) / F.when(usable, ttc)),
    }
