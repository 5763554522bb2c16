"""Chi-square test of first digits against the Benford law, as column expressions."""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.amounts import DIGIT_COLUMNS, DIGITS

EXPECTED_SHARE = {d: math.log10(1 + 1 / d) for d in DIGITS}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once.

    A filter on a derived column is pushed below the projection that derives it,
    which would copy a long expression to each place it is used.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def chi_square(total: str) -> Column:
    """Statistic of the digit counts d1..d9 against their expected share of ``total``."""
    terms = [
        f"(d{d} - {total} * {share!r}d) * (d{d} - {total} * {share!r}d) / ({total} * {share!r}d)"
        for d, share in EXPECTED_SHARE.items()
    ]
    return F.expr(" + ".join(terms))


def chi_square_pvalue(statistic: Column) -> Column:
    """Upper tail for 8 degrees of freedom, which has a closed form."""
    return let(
        statistic / 2, lambda y: F.exp(-y) * (1 + y + y * y / 2 + y * y * y / 6)
    )


def benford_test(df: DataFrame, min_amounts: int) -> DataFrame:
    """Add n_digits, chi2 and pvalue (both unrounded, null when too few amounts)."""
    least = max(min_amounts, 1)
    enough = (F.col("n_amounts") >= least) & (F.col("n_digits") >= least)
    return (
        df.withColumn("n_digits", F.expr(" + ".join(DIGIT_COLUMNS)))
        .withColumn("chi2", F.when(enough, chi_square("n_digits")))
        .withColumn("pvalue", chi_square_pvalue(F.col("chi2")))
    )
