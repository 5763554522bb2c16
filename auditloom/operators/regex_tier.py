"""Last-resort extraction of an invoice from plain OCR text, with native expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditloom import fixed_values as fixed
from auditloom.functions.statistics import let
from auditloom.functions.text import SPACE, ascii_digits, strip
from auditloom.schema import LINES

# Unicode classes everywhere; "." and "$" know only \n as line end
_UNICODE = "(?U)"
_LINES = "(?mdU)"


def _spark_pattern(flags: str, pattern: str) -> Column:
    return F.lit(flags + pattern.replace(r"\s", SPACE))


def _amount(text: Column) -> Column:
    return F.replace(ascii_digits(text), F.lit(","), F.lit(".")).try_cast("double")


def invoice_date(text: Column) -> Column:
    """First day-month-year date, else first year-month-day date, as written."""

    def first(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(text, _UNICODE + pattern, 1), F.lit(""))

    return F.coalesce(first(fixed.DATE_DAY_FIRST), first(fixed.DATE_YEAR_FIRST))


def amounts(text: Column) -> Column:
    """Every number with two decimals, as doubles, in text order."""
    found = F.regexp_extract_all(text, _spark_pattern(_UNICODE, fixed.AMOUNT), F.lit(1))
    return F.transform(found, _amount)


def largest_amount(text: Column) -> Column:
    return F.array_max(amounts(text))


def supplier(text: Column) -> Column:
    """First line that is not blank."""
    first_line = strip(F.substring_index(strip(text), "\n", 1))
    return F.nullif(first_line, F.lit(""))


def invoice_lines(text: Column, total: Column) -> Column:
    """Lines ending in an amount that is positive and below the largest one."""
    pattern = _spark_pattern(_LINES, fixed.LINE_WITH_AMOUNT)
    # the text is searched once; what was found is short, and matches itself in the same way
    pairs = F.transform(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda hit: F.struct(
            strip(F.regexp_extract(hit, _LINES + fixed.LINE_WITH_AMOUNT, 1)).alias("designation"),
            _amount(F.regexp_extract(hit, _LINES + fixed.LINE_WITH_AMOUNT, 2)).alias("amount"),
        ),
    )

    def kept(largest: Column) -> Column:
        return F.filter(
            pairs,
            lambda p: ~p["designation"].rlike("(?iu)" + fixed.NOT_A_LINE)
            & (p["amount"] > 0)
            & (p["amount"] < largest),
        )

    def as_line(p: Column) -> Column:
        return F.struct(
            p["designation"].alias("designation"),
            F.lit(1.0).alias("quantite"),
            p["amount"].alias("prix_unitaire"),
            p["amount"].alias("total_ligne"),
        )

    # the costly pattern is not even tried on a text without amounts
    lines = let(total, lambda t: F.when(t.isNotNull(), F.transform(kept(t), as_line)))
    return F.coalesce(lines, F.array().cast(LINES))


def regex_invoice(text: Column, confidence: Column, total: Column) -> Column:
    """The regex tier's invoice as a struct; ``total`` is ``largest_amount(text)``."""
    nothing = F.lit(None)
    return F.struct(
        nothing.cast("string").alias("numero_facture"),
        supplier(text).alias("fournisseur"),
        invoice_date(text).alias("date_facture"),
        invoice_lines(text, total).alias("lignes"),
        nothing.cast("double").alias("total_ht"),
        nothing.cast("double").alias("tva_taux"),
        nothing.cast("double").alias("tva_montant"),
        total.alias("total_ttc"),
        text.alias("raw_text"),
        confidence.alias("ocr_confidence"),
        F.lit(fixed.REGEX_FALLBACK).alias("extraction_method"),
        nothing.cast("boolean").alias("pydantic_ttc_valid"),
    )
