"""Image listing and the quality gate in front of extraction."""

import os
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom import fixed_values as fixed
from auditloom.operators.running import dense_index
from auditloom.params import AuditParams
from auditloom.session import materialise


# entries of a folder in one batch
_ENTRIES = 10_000


def _listed(batches):
    """Files and folders directly below each given folder; those of links are not followed."""
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            # names are plain; the parts of a URI are not
            address = quote(folder, safe=":/@") if ":/" in folder else folder
            system, root = FileSystem.from_uri(address)
            entries = system.get_file_info(FileSelector(root, allow_not_found=True))
            for at in range(0, len(entries), _ENTRIES):
                some = entries[at : at + _ENTRIES]
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": pa.array([f"{folder.rstrip('/')}/{e.base_name}" for e in some], pa.string()),
                        "length": pa.array([e.size if e.is_file else None for e in some], pa.int64()),
                        "is_folder": pa.array([e.type == FileType.Directory for e in some], pa.bool_()),
                    }
                )


def find_invoice_images(spark: SparkSession, base_path: str) -> DataFrame:
    """Path and length of every image below ``base_path``; file contents are not read.

    Names that begin with an underscore or a point and empty files are listed too, which
    Spark's own file sources pass over. Folders are listed by the tasks, one level of the
    tree after the other, so that the driver sees no path; a single folder is listed by one
    task. ``base_path`` is a local path or a URI of a file system that Arrow knows (file,
    hdfs, s3, gs); a folder that does not exist holds nothing. Extensions are in lower case.
    """
    base = base_path if ":/" in base_path else os.path.abspath(base_path)
    spread = spark.sparkContext.defaultParallelism
    folders, levels = spark.createDataFrame([(base,)], "path string"), []
    while True:
        # a fixed number of tasks: few bytes, but much waiting for the file system
        found = folders.repartition(spread, "path").mapInArrow(
            _listed, "path string, length long, is_folder boolean"
        )
        levels.append(materialise(found))
        folders = levels[-1].filter("is_folder").select("path")
        if folders.isEmpty():
            break
    files = reduce(DataFrame.unionByName, levels).filter("not is_folder")
    image = F.substring_index("path", ".", -1).isin(fixed.IMAGE_EXTENSIONS) & F.contains("path", F.lit("."))
    return files.filter(image).select("path", "length")


def with_sharpness(images: DataFrame, sharpness: DataFrame) -> DataFrame:
    """Listed images with the measured ``sharpness`` of their path.

    An image without a measurement could not be read: its sharpness is null, and the gate
    drops it. ``sharpness`` has one row per path.
    """
    return images.join(sharpness.select("path", "sharpness"), "path", "left")


def cap_images(images: DataFrame, params: AuditParams = AuditParams()) -> DataFrame:
    """The first ``image_cap`` paths in sorted order; all of them without a cap."""
    if params.image_cap is None:
        return images
    # numbered across the tasks, so that no task has to hold as many rows as the cap
    placed = dense_index(images, "path", "_place")
    return placed.filter(F.col("_place") < params.image_cap).drop("_place")


def kept_images(images: DataFrame, params: AuditParams = AuditParams()) -> DataFrame:
    """Readable, sharp images of the run, numbered densely in path order.

    The cap applies before the gate: a blurred image uses up a place.
    """
    sharp = cap_images(images, params).filter(
        F.col("sharpness").isNotNull() & (F.col("sharpness") >= params.min_sharpness)
    )
    return dense_index(sharp.withColumnRenamed("path", "image_path"), "image_path")
