"""Rounding and number texts that decide ties on the binary value, not on its decimal text.

Spark's ``round`` and ``format_string`` take the shortest decimal text of a double and
round half up, so 2.675 becomes 2.68 although the double lies below the tie. The
amounts of a report are rounded on the exact value, half to even.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# up to here the whole part of the product is exact
_LARGEST = 2.0**53
# splits a double into two halves whose products are exact
_SPLIT = 2.0**27 + 1


def exact_round(value: Column, places: int) -> Column:
    """Nearest number with ``places`` decimals, ties (of the exact value) to even."""
    scale = 10.0**places
    product = value * scale
    high = value * _SPLIT - (value * _SPLIT - value)
    # what the rounded product misses of the true one
    error = (high * scale - product) + (value - high) * scale
    whole = F.floor(product).cast("double")
    beyond = (product - whole - 0.5) + error
    odd = F.floor(whole / 2) * 2 != whole
    nearest = F.when((beyond > 0) | ((beyond == 0) & odd), whole + 1).otherwise(whole)
    return F.when(F.abs(product) < _LARGEST, nearest / scale).otherwise(value)


def scaled_round(value: Column, places: int) -> Column:
    """Rounding of the product with the power of ten, as array libraries do it."""
    scale = 10.0**places
    return F.rint(value * scale) / scale


def fixed_text(value: Column, places: int) -> Column:
    """Text with exactly ``places`` decimals."""
    return F.format_string(f"%.{places}f", exact_round(value, places))
