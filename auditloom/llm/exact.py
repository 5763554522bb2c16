"""Exact deduplication by Grace hash partitioning.

Every different text that a task has seen becomes one record: its 128-bit hash, the whole
text, how many rows had it and their largest doc_id. The records are partitioned by hash
into spill files, a bucketed table in the shared folder, sorted by bucket. A bucket that is
too large is partitioned again by another hash: its records first meet in salted slices
that combine copies, so that a text found by very many tasks shrinks from level to level,
and then in smaller buckets. Once a bucket fits, one task reads it into an open-addressing
table, which compares complete texts wherever hashes agree.

The table gives one narrow row per different text. Rows of documents find it by their hash;
only where different texts share a hash is the text itself compared once more.
"""

import hashlib
import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.text import lowered, texts
from auditloom.session import materialise, work_folder

# text in an average bucket, and in the largest that is read into one table
BUCKET_BYTES, MOST_BYTES = 1 << 19, 64 << 20
# buckets of an average spill file, which evens out the sizes of the files; further buckets
# share the files of a level
FILE_BUCKETS, MOST_FILES = 64, 16_384
# text that a task gathers before it passes its records on
GATHERED_BYTES = 32 << 20
# slices in which the records of large buckets combine, level by level
SLICES = (16, 4, 1)
# more levels than any data but colliding hashes needs
MOST_LEVELS = 20
# groups with more rows are looked up where their rows are: at most HOT_GROUPS of them
HOT_ROWS, HOT_GROUPS = 20_000, 100_000
# text in one batch of records handed to Spark
_BATCH_BYTES = 4 << 20

_RECORD = "h1 long, h2 long, n_bytes long, copies long, largest long, part int, content binary"
_GROUP = "h1 long, h2 long, clash boolean, content binary, keep_id long, group_size long, text_sha256 string"


def content_hash(content: bytes) -> tuple[int, int]:
    """The 128-bit hash as two signed numbers."""
    digest = xxhash.xxh3_128_digest(content)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


class ContentTable:
    """Different texts by open addressing with linear probing.

    A slot holds the number of an entry or -1. An entry is met only by a record whose hash
    and complete text are the same.
    """

    def __init__(self) -> None:
        self._slots = [-1] * 1024
        self.hashes: list[tuple[int, int]] = []
        self.contents: list[bytes] = []
        self.copies: list[int] = []
        self.largest: list[int | None] = []
        self.n_bytes = 0

    def __len__(self) -> int:
        return len(self.contents)

    def add(self, key: tuple[int, int], content: bytes, copies: int, largest: int | None) -> None:
        slots, at = self._slots, key[0] & len(self._slots) - 1
        while (entry := slots[at]) >= 0:
            if self.hashes[entry] == key and self.contents[entry] == content:
                self.copies[entry] += copies
                self.largest[entry] = _larger(self.largest[entry], largest)
                return
            at = at + 1 & len(slots) - 1
        slots[at] = len(self.contents)
        self.hashes.append(key)
        self.contents.append(content)
        self.copies.append(copies)
        self.largest.append(largest)
        self.n_bytes += len(content)
        if 2 * len(self.contents) > len(slots):
            self._grow()

    def _grow(self) -> None:
        slots = [-1] * (4 * len(self._slots))
        for entry, key in enumerate(self.hashes):
            at = key[0] & len(slots) - 1
            while slots[at] >= 0:
                at = at + 1 & len(slots) - 1
            slots[at] = entry
        self._slots = slots

    def batches(self) -> Iterator[range]:
        """Numbers of entries, in runs of about ``_BATCH_BYTES`` of text."""
        start, size = 0, 0
        for entry, content in enumerate(self.contents):
            size += len(content) + 64
            if size > _BATCH_BYTES:
                yield range(start, entry + 1)
                start, size = entry + 1, 0
        if start < len(self.contents):
            yield range(start, len(self.contents))


def _records(table: ContentTable, part: int) -> Iterator[pa.RecordBatch]:
    for run in table.batches():
        hashes = table.hashes[run.start : run.stop]
        contents = table.contents[run.start : run.stop]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([h[0] for h in hashes], pa.int64()),
                pa.array([h[1] for h in hashes], pa.int64()),
                pa.array(map(len, contents), pa.int64()),
                pa.array(table.copies[run.start : run.stop], pa.int64()),
                pa.array(table.largest[run.start : run.stop], pa.int64()),
                pa.array([part] * len(run), pa.int32()),
                pa.array(contents, pa.binary()),
            ],
            ["h1", "h2", "n_bytes", "copies", "largest", "part", "content"],
        )


def records(docs: DataFrame) -> DataFrame:
    """One record per different text and task, or more where a task holds very much text."""

    def gather(batches):
        table, part = ContentTable(), TaskContext.get().partitionId()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
                content = lowered(text)
                table.add(content_hash(content), content, 1, doc_id)
                if table.n_bytes > GATHERED_BYTES:
                    yield from _records(table, part)
                    table = ContentTable()
        yield from _records(table, part)

    return docs.select("doc_id", "text").mapInArrow(gather, _RECORD)


def _combined(found: DataFrame) -> DataFrame:
    """``found`` records with copies in the same task combined."""

    def combine(batches):
        table, part = ContentTable(), TaskContext.get().partitionId()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("h1", "h2", "content", "copies", "largest")]
            for h1, h2, content, copies, largest in zip(*columns):
                table.add((h1, h2), content, copies, largest)
                if table.n_bytes > GATHERED_BYTES:
                    yield from _records(table, part)
                    table = ContentTable()
        yield from _records(table, part)

    return found.select(*[c.split()[0] for c in _RECORD.split(", ")]).mapInArrow(combine, _RECORD)


def _spill(found: DataFrame, level: int, n_bytes: int, bucket_bytes: int) -> tuple[DataFrame, str]:
    """The records in spill files of their bucket, and the name of the table over the files."""
    spark = found.sparkSession
    buckets = max(1, math.ceil(n_bytes / bucket_bytes))
    files = min(math.ceil(buckets / FILE_BUCKETS), MOST_FILES)
    bucket = F.pmod(F.xxhash64("h1", "h2", F.lit(level)), F.lit(buckets))
    name = f"auditloom_spill_{uuid.uuid4().hex}"
    (
        found.withColumn("bucket", bucket)
        .repartition(files, "bucket")
        .write.format("parquet")
        .option("compression", "zstd")
        .option("path", f"{work_folder(spark)}/{name}")
        .bucketBy(files, "bucket")
        .sortBy("bucket")
        .saveAsTable(name)
    )
    return spark.table(name), name


def _groups_of_buckets(spilled: DataFrame) -> DataFrame:
    """One row per different text; reads each bucket where its files are, without a shuffle."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("h1", "h2", "content", "copies", "largest")]
            for h1, h2, content, copies, largest in zip(*columns):
                table.add((h1, h2), content, copies, largest)
        seen, shared = set(), set()
        for key in table.hashes:
            (shared if key in seen else seen).add(key)
        for run in table.batches():
            part = slice(run.start, run.stop)
            hashes, contents = table.hashes[part], table.contents[part]
            clash = [key in shared for key in hashes]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h[0] for h in hashes], pa.int64()),
                    pa.array([h[1] for h in hashes], pa.int64()),
                    pa.array(clash, pa.bool_()),
                    pa.array([c if x else None for c, x in zip(contents, clash)], pa.binary()),
                    pa.array(table.largest[part], pa.int64()),
                    pa.array(table.copies[part], pa.int64()),
                    pa.array([hashlib.sha256(c).hexdigest() for c in contents], pa.string()),
                ],
                [c.split()[0] for c in _GROUP.split(", ")],
            )

    return spilled.groupBy("bucket").applyInArrow(compare, _GROUP)


def groups(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """One written row per different text: hash, ``keep_id``, ``group_size``, ``text_sha256``.

    ``clash`` marks texts whose hash another text has too; only those carry ``content``.
    """
    spark = docs.sparkSession
    n_bytes = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    spilled, name = _spill(records(docs), 0, n_bytes, bucket_bytes)
    names, found = [name], []
    for level in range(1, MOST_LEVELS + 1):
        sizes = spilled.groupBy("bucket").agg(F.sum("n_bytes").alias("size"), F.count(F.lit(1)).alias("n"))
        # a single record cannot be split
        full = materialise(sizes.filter((F.col("size") > most_bytes) & (F.col("n") > 1)))
        n_bytes = full.agg(F.sum("size")).first()[0]
        if n_bytes is None or level == MOST_LEVELS:
            found.append(_groups_of_buckets(spilled))
            break
        found.append(_groups_of_buckets(spilled.join(full.select("bucket"), "bucket", "left_anti")))
        slices = SLICES[min(level, len(SLICES)) - 1]
        piece = F.pmod(F.xxhash64("part", "largest", "copies"), F.lit(slices))
        over = spilled.join(full.select("bucket"), "bucket", "left_semi").repartition("h1", "h2", piece)
        spilled, name = _spill(_combined(over), level, n_bytes, bucket_bytes)
        names.append(name)
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    written = materialise(whole)
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return written


def _hashed(docs: DataFrame, with_content: bool) -> DataFrame:
    """``doc_id``, ``h1`` and ``h2`` of each row, and its content if asked for."""

    def rows(batches):
        for batch in batches:
            contents = [lowered(t) for t in texts(batch.column("text"))]
            hashes = [content_hash(c) for c in contents]
            columns = [batch.column("doc_id")]
            columns += [pa.array([h[i] for h in hashes], pa.int64()) for i in (0, 1)]
            names = ["doc_id", "h1", "h2"]
            if with_content:
                columns.append(pa.array(contents, pa.binary()))
                names.append("content")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, h1 long, h2 long" + (", content binary" if with_content else "")
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def exact_duplicates(
    docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of each row.

    Rows are equal when their whole texts agree after lower-casing A-Z; a null text is
    empty. ``keep_id`` is the largest doc_id among equal rows, null where none has one, and
    a row is kept if its doc_id is that one; rows that repeat the same doc_id and text are
    one document and marked alike, and all rows without doc_id of a group without any id are
    kept. Whole texts are read whatever their length. Other columns are left out, whatever
    their names; an empty table gives no rows.
    """
    found = groups(docs, bucket_bytes, most_bytes)
    result = ["doc_id", "keep_id", "group_size", "text_sha256"]
    hashed = materialise(_hashed(docs, with_content=False))
    alone = found.filter("not clash").drop("content")
    n_rows = hashed.count()
    limit = max(HOT_ROWS, n_rows // HOT_GROUPS)
    # no more than HOT_GROUPS narrow rows, whatever the data
    hot = F.broadcast(alone.filter(F.col("group_size") > limit))
    rest = hashed.join(hot.select("h1", "h2"), ["h1", "h2"], "left_anti")
    placed = hashed.join(hot, ["h1", "h2"]).select(*result)
    placed = placed.unionByName(rest.join(alone, ["h1", "h2"]).select(*result))
    clashes = found.filter("clash")
    if not clashes.isEmpty():
        same = ["h1", "h2", "content"]
        placed = placed.unionByName(_hashed(docs, with_content=True).join(clashes, same).select(*result))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return placed.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
WINDOW same AS (PARTITION BY t)
"""
