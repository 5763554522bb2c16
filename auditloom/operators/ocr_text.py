"""OCR blocks to one text per image."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.functions.rounding import scaled_round
from auditloom.params import AuditParams


def assemble_text(blocks: DataFrame, params: AuditParams = AuditParams()) -> DataFrame:
    """Text and mean confidence of the blocks that are certain enough, in block order."""
    kept = blocks.filter(F.col("confidence") >= params.min_block_confidence)
    ordered = F.array_sort(F.collect_list(F.struct("block_no", "text")))
    return kept.groupBy("image_path").agg(
        F.array_join(F.transform(ordered, lambda b: b["text"]), "\n").alias("full_text"),
        scaled_round(F.avg("confidence"), 3).alias("avg_confidence"),
        F.count(F.lit(1)).alias("n_blocks"),
    )


def text_of_images(images: DataFrame, blocks: DataFrame, params: AuditParams = AuditParams()) -> DataFrame:
    """``images`` with their text; "" and 0.0 where no block is left."""
    return images.join(assemble_text(blocks, params), "image_path", "left").select(
        *[images[c] for c in images.columns],
        F.coalesce("full_text", F.lit("")).alias("full_text"),
        F.coalesce("avg_confidence", F.lit(0.0)).alias("avg_confidence"),
        F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"),
    )
