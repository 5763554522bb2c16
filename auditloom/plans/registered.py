"""Named queries over a folder of the star-schema tables, one or more per operator."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom import fixed_values as fixed
from auditloom.functions.amounts import ttc_valid
from auditloom.operators import (
    arithmetic,
    benford,
    duplicates,
    forest,
    ocr_text,
    regex_tier,
    report,
    requests,
    responses,
    similarity,
    summary,
    tiers,
    zscore,
)
from auditloom.params import AuditParams
from auditloom.plans import audit
from auditloom.session import materialise
from auditloom.sources import images, sinks, star_schema as star

PARAMS = AuditParams()

# the given vectors have no near copies, so their queries use lower cut-offs
VECTOR_PARAMS = AuditParams(near_similarity=0.4, semantic_similarity=0.45)


def _round(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({name: F.round(name, n) for name, n in places.items()})


def _long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("bigint") for name in names})


def _line_sum(lines: Column) -> Column:
    return F.round(F.aggregate(lines, F.lit(0.0), lambda total, x: total + x["total_ligne"]), 2)


# --- rules -------------------------------------------------------------------------


def invoice_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = forest.with_features(star.invoice_facts(spark, sf_dir))
    return _round(features, f_amount=2, f_ratio=6, f_gap=6)


def arithmetic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = arithmetic.check_line_totals(star.invoice_facts(spark, sf_dir), PARAMS)
    return _round(found, line_sum=2)


def arithmetic_ttc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arithmetic.check_total(star.invoice_facts(spark, sf_dir), PARAMS)


def ttc_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = ttc_valid(F.col("total_ht"), F.col("tva_montant"), F.col("total_ttc"), PARAMS.ttc_tolerance)
    return star.invoice_headers(spark, sf_dir).select("invoice_idx", flag.alias("ttc_valid"))


def hash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = materialise(duplicates.text_digests(star.document_texts(spark, sf_dir)))
    return duplicates.check_hash_duplicates(digests)


def zscore_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = materialise(star.invoice_headers(spark, sf_dir))
    found = zscore.check_zscore(facts, PARAMS)
    return _round(found, mu=4, sigma=4, z=6)


# --- similarity ----------------------------------------------------------------------


def similar_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = star.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("invoice_idx"), "embedding", "label"
    )
    return _long(similarity.similar_vectors(vectors, VECTOR_PARAMS), "rank", "label")


def similar_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices = star.document_invoices(spark, sf_dir)
    similar = similarity.similar_texts(invoices, PARAMS, neighbours=5)
    return _long(similar, "rank").select(
        "invoice_idx", "rank", "similar_idx", "similarity", "fournisseur", "total_ttc"
    )


def semantic_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices = star.document_invoices(spark, sf_dir)
    similar = similarity.similar_texts(invoices, PARAMS)
    found = similarity.check_semantic_duplicates(similar, PARAMS)
    return _long(found, "rank").select(
        "invoice_idx", "rank", "similar_idx", "similarity", "rule", "level", "detail"
    )


# --- first-digit law -------------------------------------------------------------------


def benford_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = benford.benford_portfolio(star.invoice_facts(spark, sf_dir), PARAMS)
    return _round(tested, chi2=2, pvalue=6)


def benford_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = benford.benford_running(materialise(star.invoice_facts(spark, sf_dir)), PARAMS)
    return _round(tested, chi2=4, pvalue=6)


def benford_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = materialise(star.invoice_facts(spark, sf_dir))
    running = materialise(benford.benford_running(facts, PARAMS))
    return benford.check_benford(running, PARAMS).select("invoice_idx", "chi2", "pvalue", "detail")


def digit_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = benford.digit_distribution(star.invoice_facts(spark, sf_dir), PARAMS)
    return _long(_round(shares, observed_share=8, expected_share=8), "digit")


# --- text ------------------------------------------------------------------------------


def ocr_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = star.table(spark, sf_dir, "documents").select(
        star.image_path(F.col("doc_id")).alias("image_path")
    )
    return ocr_text.text_of_images(keys, star.document_blocks(spark, sf_dir), PARAMS)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.rendered_texts(spark, sf_dir)


def regex_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = regex_tier.invoice_date(F.col("full_text"))
    return _texts(spark, sf_dir).select("image_path", date.alias("date_facture"))


def regex_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = regex_tier.amounts(F.col("full_text"))
    return (
        _texts(spark, sf_dir)
        .withColumn("amounts", amounts)
        .select(
            "image_path",
            F.size("amounts").cast("bigint").alias("n_amounts"),
            F.array_max("amounts").alias("total_ttc"),
        )
    )


def regex_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = regex_tier.supplier(F.col("full_text"))
    return _texts(spark, sf_dir).select("image_path", supplier.alias("fournisseur"))


def regex_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _texts(spark, sf_dir).withColumn("total", regex_tier.largest_amount(F.col("full_text")))
    lines = regex_tier.invoice_lines(F.col("full_text"), F.col("total"))
    return texts.select("image_path", F.posexplode(lines).alias("line_no", "line")).select(
        "image_path",
        (F.col("line_no") + 1).cast("bigint").alias("line_no"),
        "line.designation",
        "line.total_ligne",
    )


def regex_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regex tier over free text, whole documents."""
    texts = star.document_texts(spark, sf_dir).withColumn(
        "total", regex_tier.largest_amount(F.col("raw_text"))
    )
    invoice = regex_tier.regex_invoice(F.col("raw_text"), F.lit(1.0), F.col("total"))
    return texts.select("invoice_idx", invoice.alias("i")).select(
        "invoice_idx",
        "i.fournisseur",
        "i.date_facture",
        "i.total_ttc",
        F.size("i.lignes").cast("bigint").alias("n_lines"),
        _line_sum(F.col("i.lignes")).alias("line_sum"),
    )


# --- model answers -----------------------------------------------------------------------


def response_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = tiers.parsed_attempts(star.rendered_answers(spark, sf_dir), PARAMS)
    return parsed.select(
        "image_path",
        F.col("method"),
        F.col("invoice").isNotNull().alias("valid"),
        "invoice.numero_facture",
        "invoice.fournisseur",
        "invoice.date_facture",
        "invoice.total_ht",
        "invoice.tva_montant",
        "invoice.total_ttc",
        "invoice.pydantic_ttc_valid",
        F.when(F.col("invoice").isNotNull(), F.size("invoice.lignes")).cast("bigint").alias("n_lines"),
        _line_sum(F.col("invoice.lignes")).alias("line_sum"),
    )


def _images_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.substring("image_path", 6, 9).cast("bigint")
    return _texts(spark, sf_dir).withColumn("avg_confidence", key % 64 / 64)


def tier_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices = tiers.extract_invoices(
        _images_with_text(spark, sf_dir), star.rendered_answers(spark, sf_dir), PARAMS
    )
    return invoices.select(
        "image_path",
        "extraction_method",
        "numero_facture",
        "fournisseur",
        "date_facture",
        "total_ht",
        "tva_montant",
        "total_ttc",
        "pydantic_ttc_valid",
        "ocr_confidence",
        F.col("raw_text").isNotNull().alias("has_text"),
        F.size("lignes").cast("bigint").alias("n_lines"),
        _line_sum(F.col("lignes")).alias("line_sum"),
    )


def first_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _images_with_text(spark, sf_dir)
    return _long(requests.vision_requests(rows).unionByName(requests.text_requests(rows)), "attempt")


def retry_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    retries = requests.retry_requests(
        _images_with_text(spark, sf_dir), star.rendered_answers(spark, sf_dir), PARAMS
    )
    return _long(retries, "attempt")


def decision_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = star.conversation_answers(spark, sf_dir)
    return answers.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        responses.decision(F.col("raw")).alias("llm_decision"),
    )


# --- sources and sinks ---------------------------------------------------------------------


def kept_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.kept_images(star.document_images(spark, sf_dir), PARAMS)


def first_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of the first 50 paths: the cap comes before the gate."""
    return images.kept_images(star.document_images(spark, sf_dir), AuditParams(image_cap=50))


def index_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = sinks.index_rows(star.nested_invoices(spark, sf_dir))
    return _long(index, "nb_lignes")


def index_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, replaced by their dearest returned line where one was returned."""
    existing = sinks.index_rows(
        star.invoice_headers(spark, sf_dir).withColumns(
            {"raw_text": F.lit(None).cast("string"), "lignes": F.array().cast(star.LINES)}
        )
    )
    lines = star.table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    updates = sinks.last_per_id(
        lines.select(
            F.concat(F.lit("inv_"), F.col("l_orderkey").cast("string")).alias("id"),
            F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("document"),
            F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("fournisseur"),
            F.col("l_extendedprice").alias("total_ttc"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
            F.lit(fixed.VLM).alias("extraction_method"),
            F.lit(1).alias("nb_lignes"),
            F.struct("l_extendedprice", "l_suppkey", "l_linenumber").alias("version"),
        ),
        "version",
    )
    return _long(sinks.upsert_index(existing, updates), "nb_lignes")


# --- report ----------------------------------------------------------------------------------


def _audit(spark: SparkSession, sf_dir: str) -> audit.AuditResult:
    """All eight rules over all orders, forest and neighbours included, and the verdicts."""
    return audit.audit_invoices(
        star.nested_invoices(spark, sf_dir), star.verdict_answers(spark, sf_dir), params=PARAMS
    )


def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: one report per invoice with its ordered alerts."""
    reports = _audit(spark, sf_dir).reports
    return reports.select(
        "invoice_idx",
        "invoice_id",
        "overall_level",
        "benford_pvalue",
        F.size("anomalies").cast("bigint").alias("n_alerts"),
        F.array_join(F.transform("anomalies", lambda a: a["rule"]), ",").alias("rules"),
        F.array_join(F.transform("anomalies", lambda a: a["detail"]), "\n").alias("details"),
        "isolation_forest_score",
        "llm_decision",
    )


def alert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = report.alerts_per_invoice(_audit(spark, sf_dir).alerts)
    return alerts.select("invoice_idx", requests.alert_text(F.col("anomalies")).alias("alerts"))


def fraud_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _audit(spark, sf_dir)
    return requests.fraud_requests(result.facts, report.alerts_per_invoice(result.alerts))


def level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_audit(spark, sf_dir).tables["level_counts"], share=8)


def first_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _audit(spark, sf_dir).tables["first_report"]
    return first.select(
        "invoice_idx",
        "fournisseur",
        "extraction_method",
        "total_ttc",
        "overall_level",
        F.array_join(F.transform("anomalies", lambda a: a["rule"]), ",").alias("rules"),
    )


def method_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.method_counts(star.invoice_headers(spark, sf_dir))


def amount_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = materialise(star.invoice_headers(spark, sf_dir).select("total_ttc"))
    bins = summary.amount_histogram(amounts, PARAMS)
    return _long(_round(bins, bin_from=4, bin_to=4), "bin")


def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = materialise(star.invoice_facts(spark, sf_dir))
    return _round(forest.fit_decisions(facts, PARAMS), decision=4)


def forest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = materialise(star.invoice_facts(spark, sf_dir))
    decisions = forest.fit_decisions(facts, PARAMS)
    return _round(forest.check_forest(decisions, PARAMS), decision=6)


def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = materialise(star.invoice_facts(spark, sf_dir))
    decisions = forest.fit_decisions(facts, PARAMS)
    bins = summary.score_histogram(decisions, PARAMS)
    return _long(_round(bins, bin_from=6, bin_to=6), "bin")


def full_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule, forest and neighbours included, over nested invoices."""
    result = _audit(spark, sf_dir)
    return result.reports.withColumn("anomalies", requests.alert_text(F.col("anomalies")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        invoice_features,
        arithmetic_lines,
        arithmetic_ttc,
        ttc_flag,
        hash_duplicates,
        zscore_alerts,
        similar_topk,
        similar_texts,
        semantic_duplicates,
        benford_portfolio,
        benford_running,
        benford_alerts,
        digit_distribution,
        ocr_texts,
        regex_dates,
        regex_amounts,
        regex_supplier,
        regex_lines,
        regex_documents,
        response_parse,
        tier_choice,
        first_requests,
        retry_requests,
        decision_parse,
        kept_images,
        first_images,
        index_records,
        index_upsert,
        audit_report,
        alert_text,
        fraud_requests,
        level_counts,
        first_report,
        method_counts,
        amount_histogram,
        forest_scores,
        forest_alerts,
        score_histogram,
        full_audit,
    )
}
