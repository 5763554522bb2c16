"""Choice of the best extraction tier per image."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom import fixed_values as fixed
from auditloom.functions.text import is_blank
from auditloom.operators.regex_tier import largest_amount, regex_invoice
from auditloom.operators.responses import clean_answer, parse_answers
from auditloom.params import AuditParams

# tier and attempt of an answer -> name of the extraction method
ATTEMPTS = {
    ("vlm", 1): fixed.VLM,
    ("vlm", 2): fixed.VLM_RETRY,
    ("ocr_llm", 1): fixed.OCR_LLM,
    ("ocr_llm", 2): fixed.OCR_LLM_RETRY,
}


def _attempt(tier: str, number: int) -> Column:
    return (F.col("tier") == tier) & (F.col("attempt") == number)


def parsed_attempts(responses: DataFrame, params: AuditParams = AuditParams()) -> DataFrame:
    """Every answer with its method, cleaned text and parsed invoice (null if rejected)."""
    method = F.lit(None).cast("string")
    for (tier, number), name in ATTEMPTS.items():
        method = F.when(_attempt(tier, number), F.lit(name)).otherwise(method)
    cleaned = responses.withColumn("answer", clean_answer(F.col("raw"))).withColumn("method", method)
    return parse_answers(cleaned, "answer", F.col("method"), F.lit(None).cast("string"), params)


def extract_invoices(
    images: DataFrame, responses: DataFrame, params: AuditParams = AuditParams()
) -> DataFrame:
    """One invoice per image: first tier with a valid answer, the regex tier at last.

    ``images`` carries image_path, full_text and avg_confidence. A second attempt
    counts only after a first answer that was there but could not be used; OCR
    answers count only where the image has text.
    """
    # a missing answer is no candidate and allows no retry
    attempts = parsed_attempts(responses.filter(F.col("raw").isNotNull()), params)

    def of(tier: str, number: int, value: Column) -> Column:
        return F.first(F.when(_attempt(tier, number), value), ignorenulls=True)

    # at most four answers per image: one narrow shuffle on the image
    per_image = attempts.groupBy("image_path").agg(
        *[of(t, n, F.col("invoice")).alias(name) for (t, n), name in ATTEMPTS.items()],
        *[
            F.bool_or(_attempt(t, 1) & F.col("answer").isNotNull() & F.col("invoice").isNull()).alias(
                f"{t}_may_retry"
            )
            for t in ("vlm", "ocr_llm")
        ],
    )
    joined = images.join(per_image, "image_path", "left").withColumn(
        "_has_text", ~is_blank(F.col("full_text"))
    )

    def with_ocr(name: str) -> Column:
        return (
            F.col(name)
            .withField("raw_text", F.col("full_text"))
            .withField("ocr_confidence", F.col("avg_confidence"))
        )

    from_model = F.coalesce(
        F.col(fixed.VLM),
        F.when(F.col("vlm_may_retry"), F.col(fixed.VLM_RETRY)),
        F.when(F.col("_has_text") & F.col(fixed.OCR_LLM).isNotNull(), with_ocr(fixed.OCR_LLM)),
        F.when(
            F.col("_has_text") & F.col("ocr_llm_may_retry") & F.col(fixed.OCR_LLM_RETRY).isNotNull(),
            with_ocr(fixed.OCR_LLM_RETRY),
        ),
    )
    chosen = joined.withColumn("_model", from_model).withColumn(
        "_total", F.when(F.col("_model").isNull(), largest_amount(F.col("full_text")))
    )
    fallback = regex_invoice(F.col("full_text"), F.col("avg_confidence"), F.col("_total"))
    keys = [c for c in images.columns if c not in ("full_text", "avg_confidence", "n_blocks")]
    return chosen.withColumn("_invoice", F.coalesce(F.col("_model"), fallback)).select(*keys, "_invoice.*")
