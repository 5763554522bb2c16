"""One narrow row per invoice: the header amounts and what the lines add up to.

Every rule works on these facts. They come either from invoices with a nested
line array (row-local, no shuffle) or from a header table and a long line table
(partial aggregation, so that an invoice with very many lines is no problem).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.amounts import DIGIT_COLUMNS, DIGITS, first_digit

HEADER_COLUMNS = [
    "invoice_idx",
    "numero_facture",
    "fournisseur",
    "date_facture",
    "total_ht",
    "tva_montant",
    "total_ttc",
    "extraction_method",
]
AMOUNT_COUNTS = ["n_amounts", *DIGIT_COLUMNS]


def facts_from_invoices(invoices: DataFrame) -> DataFrame:
    """Facts of invoices whose lines are nested in the row."""
    line_totals = F.transform("lignes", lambda line: line["total_ligne"])
    rows = invoices.select(
        *HEADER_COLUMNS,
        F.size("lignes").cast("bigint").alias("n_lines"),
        F.aggregate(line_totals, F.lit(0.0), lambda total, x: total + x).alias("line_sum"),
        F.filter(
            F.concat(F.array("total_ttc"), line_totals), lambda amount: amount > 0
        ).alias("amounts"),
    )
    rows = rows.withColumn("digits", F.transform("amounts", first_digit))
    return rows.selectExpr(
        *HEADER_COLUMNS,
        "n_lines",
        "line_sum",
        "cast(size(amounts) as bigint) as n_amounts",
        *[f"cast(size(filter(digits, x -> x = {d})) as bigint) as d{d}" for d in DIGITS],
    )


def line_statistics(lines: DataFrame, *more: Column) -> DataFrame:
    """Per invoice: number of lines, their sum, and first-digit counts of positive ones.

    ``more`` are further aggregates of the lines, taken in the same pass.
    """
    rows = lines.withColumn("digit", first_digit(F.col("total_ligne")))
    return rows.groupBy("invoice_idx").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("total_ligne").alias("line_sum"),
        F.count_if(F.col("total_ligne") > 0).alias("n_amounts"),
        *[F.expr(f"count_if(digit = {d}) as d{d}") for d in DIGITS],
        *more,
    )


def facts_from_lines(headers: DataFrame, statistics: DataFrame) -> DataFrame:
    """Facts of a header table and the line statistics belonging to it.

    The facts come out spread by invoice number, for the rules that follow.
    """
    return facts_of_joined(
        headers.select(*HEADER_COLUMNS).join(statistics.hint("merge"), "invoice_idx", "left")
    )


def facts_of_joined(rows: DataFrame) -> DataFrame:
    """Facts of rows that hold the header columns and the line statistics, null without lines."""
    return rows.withColumn("digit", first_digit(F.col("total_ttc"))).selectExpr(
        *HEADER_COLUMNS,
        "coalesce(n_lines, 0) as n_lines",
        "coalesce(line_sum, 0d) as line_sum",
        "coalesce(n_amounts, 0) + if(total_ttc > 0, 1, 0) as n_amounts",
        *[f"coalesce(d{d}, 0) + if(digit = {d}, 1, 0) as d{d}" for d in DIGITS],
    )
