"""Input tables with their declared schemas: no inference, and a misnamed column fails early."""

from pyspark.sql import DataFrame, SparkSession

from auditloom import schema
from auditloom.schema import enter_invoices


def read_invoices(spark: SparkSession, path: str) -> DataFrame:
    return enter_invoices(spark.read.schema(schema.INVOICE).parquet(path))


def read_ocr_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.OCR_BLOCKS).parquet(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.RESPONSES).parquet(path)


def read_image_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.IMAGES).parquet(path)


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.VERDICTS).parquet(path)
