"""Invoices, OCR texts and model answers derived from order tables.

Orders stand for invoices, their lines for invoice lines, customers for suppliers.
What a paper invoice would lack or get wrong follows from the order's status, and
its extraction method from the order's priority, so that every rule meets both
clean and faulty rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom import fixed_values as fixed
from auditloom.operators.facts import AMOUNT_COUNTS, HEADER_COLUMNS, facts_of_joined, line_statistics
from auditloom.schema import LINES, enter_invoices


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long line table: invoice_idx, designation, quantite, prix_unitaire, total_ligne."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("invoice_idx"),
        F.col("l_linenumber").alias("line_no"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("designation"),
        F.col("l_quantity").alias("quantite"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("prix_unitaire"),
        F.col("l_extendedprice").alias("total_ligne"),
    )


def _line_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order the line statistics, and net total and tax as decimals rounded to cents."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("invoice_idx"),
        F.col("l_extendedprice").alias("total_ligne"),
        "l_discount",
        "l_tax",
    )
    net = F.col("total_ligne").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return line_statistics(
        lines,
        F.round(F.sum(net), 2).cast("double").alias("net"),
        F.round(F.sum(net * F.col("l_tax").cast("decimal(4,2)")), 2).cast("double").alias("tax"),
    )


def extraction_method(priority: Column) -> Column:
    """The five priorities name the five extraction methods."""
    rank = F.substring(priority, 1, 1).cast("int")
    return F.element_at(F.array(*[F.lit(m) for m in fixed.EXTRACTION_METHODS]), rank)


def _headers_and_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``invoice_headers`` and the line statistics, from one pass over the lines."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    joined = (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left")
        .withColumnRenamed("o_orderkey", "invoice_idx")
        .join(_line_sums(spark, sf_dir).hint("merge"), "invoice_idx", "left")
    )
    known = F.col("o_orderstatus") != "P"
    computed = F.when(F.col("o_orderstatus") == "F", F.round(F.col("net") + F.col("tax"), 2))
    return joined.select(
        "invoice_idx",
        F.col("invoice_idx").cast("string").alias("numero_facture"),
        F.col("c_name").alias("fournisseur"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("date_facture"),
        F.when(known, F.col("net")).alias("total_ht"),
        F.when(known, F.col("tax")).alias("tva_montant"),
        F.coalesce(computed, F.col("o_totalprice")).alias("total_ttc"),
        extraction_method(F.col("o_orderpriority")).alias("extraction_method"),
        "n_lines",
        "line_sum",
        *AMOUNT_COUNTS,
    )


def invoice_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice columns without lines and text.

    Status F: total computed from net and tax. Status O: total as ordered, so net
    and tax rarely give it. Status P: net and tax unknown.
    """
    return _headers_and_sums(spark, sf_dir).select(*HEADER_COLUMNS)


def invoice_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of all orders, straight from the long line table."""
    return facts_of_joined(_headers_and_sums(spark, sf_dir))


def rendered_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_path and full_text: each order printed the way OCR would read it.

    The date format depends on the status; one in three has no date at all. The join
    keeps the orders spread over the tasks, as the work on the texts is heavy.
    """
    lines = invoice_lines(spark, sf_dir).withColumn(
        "printed",
        F.concat(
            F.col("designation"), F.lit(" x "), F.col("quantite").cast("int").cast("string"),
            F.lit("   "), F.format_string("%.2f", "total_ligne"),
        ),
    )
    body = lines.groupBy("invoice_idx").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("line_no", "printed"))), lambda x: x["printed"]
            ),
            "\n",
        ).alias("body")
    )
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "invoice_idx")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    date = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise("none")
    )
    text = F.concat(
        F.lit("\n  "), F.coalesce("c_name", F.lit("")), F.lit(" \nDate "), date, F.lit("\n"),
        F.coalesce("body", F.lit("")),
        F.lit("\nTOTAL "), F.format_string("%.2f", F.col("o_totalprice")), F.lit("\n"),
    )
    return (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left")
        .join(body.hint("merge"), "invoice_idx", "left")
        .select(image_path(F.col("invoice_idx")).alias("image_path"), text.alias("full_text"))
    )


def image_path(key: Column) -> Column:
    return F.format_string("scan/%09d.png", key)


def rendered_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers of both tiers for each order, many of them damaged.

    The kind of damage goes by the order number, so that each kind occurs.
    """
    items = invoice_lines(spark, sf_dir).withColumn(
        "item",
        F.concat(
            F.lit('{"designation": "'), F.col("designation"), F.lit('", "quantite": '),
            F.col("quantite").cast("int").cast("string"), F.lit(', "total_ligne": '),
            F.format_string("%.2f", "total_ligne"), F.lit("}"),
        ),
    )
    lists = items.groupBy("invoice_idx").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("line_no", "item"))), lambda x: x["item"]),
            ", ",
        ).alias("items")
    )
    headers = (
        invoice_headers(spark, sf_dir)
        .join(lists.hint("merge"), "invoice_idx", "left")
        .withColumn("kind", F.col("invoice_idx") % 12)
    )

    def amount(name: str) -> Column:
        return F.when(F.col(name).isNull(), F.lit("null")).otherwise(F.format_string("%.2f", name))

    good = F.concat(
        F.lit('{"numero_facture": "'), F.col("numero_facture"), F.lit('", "fournisseur": "'),
        F.col("fournisseur"), F.lit('", "date_facture": "'), F.col("date_facture"),
        F.lit('", "lignes": ['), F.coalesce("items", F.lit("")), F.lit('], "total_ht": '),
        amount("total_ht"), F.lit(', "tva_montant": '), amount("tva_montant"),
        F.lit(', "total_ttc": '), amount("total_ttc"), F.lit("}"),
    )
    number_for_text = F.concat(F.lit('{"fournisseur": 12, "total_ttc": '), amount("total_ttc"), F.lit("}"))
    text_for_number = F.concat(F.lit('{"fournisseur": "A", "total_ttc": "'), amount("total_ttc"), F.lit(' "}'))
    not_a_number = F.concat(F.lit('{"fournisseur": "A", "total_ttc": "'), amount("total_ttc"), F.lit(' EUR"}'))
    fenced = F.concat(F.lit("```json\n"), good, F.lit("\n```\n"))
    cut_off = F.concat(F.lit("```"), good)
    broken = F.substring(good, F.lit(2), F.length(good))
    kind = F.col("kind")
    first = (
        F.when(kind == 0, fenced)
        .when(kind == 1, cut_off)
        .when(kind == 2, broken)
        .when(kind == 3, number_for_text)
        .when(kind == 4, text_for_number)
        .when(kind == 5, not_a_number)
        .when(kind == 6, F.lit('{"lignes": null}'))
        .when(kind == 7, F.lit("[1, 2]"))
        .when(kind == 8, F.lit('{"raw_text": "x"}'))
        .when(kind == 9, F.lit(None).cast("string"))
        .otherwise(good)
    )
    second = F.when(kind.isin(3, 7), good).when(kind == 6, F.lit("{}")).when(kind == 2, broken)

    def rows(tier: str, attempt: int, raw: Column) -> Column:
        return F.struct(F.lit(tier).alias("tier"), F.lit(attempt).alias("attempt"), raw.alias("raw"))

    return headers.select(
        image_path(F.col("invoice_idx")).alias("image_path"),
        F.inline(
            F.array(
                rows("vlm", 1, first),
                rows("vlm", 2, second),
                rows("ocr_llm", 1, F.when(kind.isin(1, 8), broken).when(kind == 9, fenced)),
                rows("ocr_llm", 2, F.when(kind == 8, good)),
            )
        ),
    )


def nested_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete invoice rows with nested lines; documents lend their text to the OCR tiers."""
    line = F.struct("designation", "quantite", "prix_unitaire", "total_ligne")
    entry = F.struct("line_no", line.alias("line"))
    lines = (
        invoice_lines(spark, sf_dir)
        .groupBy("invoice_idx")
        .agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["line"]).alias("lignes"))
    )
    rows = (
        invoice_headers(spark, sf_dir)
        .join(lines, "invoice_idx", "left")
        .join(document_texts(spark, sf_dir), "invoice_idx", "left")
    )
    return enter_invoices(
        rows.select(
            "invoice_idx",
            image_path(F.col("invoice_idx")).alias("image_path"),
            "numero_facture",
            "fournisseur",
            "date_facture",
            "lignes",
            "total_ht",
            F.lit(None).cast("double").alias("tva_taux"),
            "tva_montant",
            "total_ttc",
            F.when(~F.startswith("extraction_method", F.lit("vlm")), F.col("raw_text")).alias("raw_text"),
            F.lit(None).cast("double").alias("ocr_confidence"),
            "extraction_method",
            F.lit(None).cast("boolean").alias("pydantic_ttc_valid"),
        )
    )


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("invoice_idx"), F.col("text").alias("raw_text")
    )


def document_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as invoices of the OCR tier: source as supplier, length as amount."""
    nothing = F.lit(None)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("invoice_idx"),
        F.col("source").alias("fournisseur"),
        nothing.cast("string").alias("date_facture"),
        F.array().cast(LINES).alias("lignes"),
        F.col("n_chars").cast("double").alias("total_ttc"),
        F.col("text").alias("raw_text"),
        F.lit(fixed.OCR_LLM).alias("extraction_method"),
    )


def document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents as OCR blocks with a confidence in 64ths."""
    blocks = table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("block_no", "text")
    )
    return blocks.select(
        image_path(F.col("doc_id")).alias("image_path"),
        "block_no",
        "text",
        ((F.col("doc_id") * 7 + F.col("block_no") * 13) % 64 / 64).alias("confidence"),
    )


def document_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image metadata: a path per document, its length, and a sharpness that follows from it."""
    return table(spark, sf_dir, "documents").select(
        F.format_string("%s/%d.png", "lang", "doc_id").alias("path"),
        F.col("n_chars").alias("length"),
        F.when(F.col("n_chars") % 10 != 0, F.col("n_chars") / 8).alias("sharpness"),
    )


def conversation_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as verdict answers; some name a decision, some are fenced."""
    text = F.col("text")
    said = F.concat(text, F.lit("\n  Decision: REVIEW - RAISON: "), F.col("role"), F.lit(" \nend"))
    kind = F.col("conv_id") % 3
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(kind == 0, said)
        .when(kind == 1, F.concat(F.lit("```\n"), text, F.lit("\n```")))
        .otherwise(text)
        .alias("raw"),
    )


def verdict_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as verdict dialogues about the invoice of their number, turns as attempts."""
    return conversation_answers(spark, sf_dir).select(
        F.col("conv_id").alias("invoice_idx"), F.col("turn").alias("attempt"), "raw"
    )
