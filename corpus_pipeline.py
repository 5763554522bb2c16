"""From raw documents to packed training sequences, in five stages.

Each stage is called with all documents that the stage before has kept, and returns the
columns of documents; the last returns the pieces of the packed sequences. Further columns of
its input are left out. Every stage takes an empty table (and returns one), texts of any length
and nulls in any column: a document with a null text goes at the first stage, and is
packed as a single end id where a later stage gets one; null doc_ids are no error anywhere, and
rows without one are told apart by their text. Repeated rows are copies: near-dedup leaves one.
"""

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.llm import decontaminate, language, packing, secrets, simhash
from auditloom.session import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# bytes of rows that a Python task is given at a time; a longer row comes alone
BATCH_BYTES = 1 << 20


def _in_small_batches(stage):
    """``stage``, with BATCH_BYTES set in the session, since rows flow only when its result is read.

    An executor holds such a batch several times over, in the JVM and in Python, for each task,
    and the C library keeps what the largest ones have used.
    """

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


@_in_small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or too close to two languages to tell, go."""
    return language.accepted(docs.select(*COLUMNS), language.train(docs))


@_in_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id."""
    return simhash.first_of_group(docs).select(*COLUMNS)


@_in_small_batches
def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_leaks(docs, benchmark).select(*COLUMNS)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced in the text; no document goes."""
    clean = secrets.redact(secrets.find_secrets(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@_in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate_benchmark),
    ("secret scans", scan_secrets),
    ("packing", pack),
]

# learned models, components and tokenizers have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each reading what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
