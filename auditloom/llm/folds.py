"""Rows held out from learning, and bounded samples of labelled rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.session import materialise


def fold(folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def held_out(folds: int, which: int) -> Column:
    """Whether a row is held out; a row without doc_id is not, and is not learned from."""
    return F.coalesce(fold(folds) == which, F.lit(False)).alias("held_out")


def labelled_sample(labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` rows of either label 0 and 1: ``doc_id``, ``label`` and ``weight``.

    The weights give both labels the share that they have among all labelled rows. Rows
    are drawn by a hash of doc_id; null ids and other labels take no part.
    """
    clean = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select(
        "doc_id", F.col(label).cast("int").alias("label")
    )
    # a row per label
    sizes = materialise(clean.groupBy("label").agg(F.count(F.lit(1)).alias("n")))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1_000_003)) / 1_000_003
    drawn = (
        clean.join(F.broadcast(sizes), "label")
        .withColumn("draw", draw)
        .filter(F.col("draw") < 1.2 * most / F.col("n"))
    )
    parts = [drawn.filter(F.col("label") == x).orderBy("draw", "doc_id").limit(most) for x in (0, 1)]
    taken = materialise(parts[0].unionByName(parts[1]))
    counts = taken.groupBy("label").agg(F.count(F.lit(1)).alias("taken"))
    return taken.join(F.broadcast(counts), "label").selectExpr("doc_id", "label", "n / taken as weight")
