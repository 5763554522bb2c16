"""SimHash near duplicates by covering locality-sensitive hashing.

Each document gets a 64-bit fingerprint of its word shingles. A random map sends the bits
to vectors of ``radius + 1`` bits; every non-zero vector v gives one mask, holding the
bits whose image has an odd product with v. The images of at most ``radius`` differing
bits span too little to be odd under every v, so each pair within the radius agrees
under some mask: no link is lost (Pagh, Locality-sensitive Hashing without False
Negatives, SODA 2016).

Buckets are groups of equal masked values. Only different fingerprints are compared, so
copies cost one shuffled row per task. A bucket of up to ``BUCKET_ROWS`` fingerprints is
compared in one task, which returns a spanning forest of its links rather than its
pairs. Fingerprints of larger buckets take another exact way without pairs: two
fingerprints are within ``radius`` if and only if flipping at most half as many bits of
each leads to a common value, so all that reach one value are linked to the smallest.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from auditloom.llm.components import components
from auditloom.llm.text import slices, texts, unused, words
from auditloom.session import materialise

BITS = 64
SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
# fingerprints of one bucket that are compared in one task
BUCKET_ROWS = 4096
# shingles whose bits are counted at a time
_CHUNK = 65_536


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint: a bit is 1 if more than half of the shingle hashes have it."""
    w = words(text, lower=True)
    if not w:
        return 0
    if len(w) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(w), SEED)
    joined = b" ".join(w)
    lengths = np.fromiter(map(len, w), dtype=np.int64, count=len(w))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(w) - shingle_words + 1].tolist()
    stops = ends[shingle_words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(starts), _CHUNK):
        hashes = np.array(
            [digest(joined[i:j], SEED) for i, j in zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK])],
            dtype=">u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts)).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (long, same bits) of each row of ``docs``."""

    def rows(batches):
        for batch in slices(batches):
            found = [fingerprint(t, shingle_words) for t in texts(batch.column("text"))]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signed)], ["doc_id", "fingerprint"]
            )

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, fingerprint long")


def masks(radius: int = RADIUS, seed: int = SEED) -> list[int]:
    """One mask per non-zero vector of ``radius + 1`` bits, as signed 64-bit numbers."""
    images = np.random.default_rng(seed).integers(0, 1 << (radius + 1), BITS)
    found = []
    for v in range(1, 1 << (radius + 1)):
        odd = [int(x & v).bit_count() & 1 for x in images]
        value = sum(bit << i for i, bit in enumerate(odd))
        found.append(value - (1 << 64) if value >> 63 else value)
    return found


def _flips(most: int) -> list[int]:
    """Numbers with at most ``most`` bits set, signed."""
    found = [0]
    for n in range(1, most + 1):
        found += [sum(1 << i for i in at) for at in combinations(range(BITS), n)]
    return [x - (1 << 64) if x >> 63 else x for x in found]


def _forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the values that differ in at most ``radius`` bits."""
    left = np.arange(len(values))
    links = []
    while len(left):
        # grow one component at a time: every value is taken as a centre once
        front, left = [left[0]], left[1:]
        while front and len(left):
            centre = front.pop()
            near = np.bitwise_count(values[left] ^ values[centre]) <= radius
            reached = left[near]
            links += [(int(values[centre]), int(values[i])) for i in reached]
            front += reached.tolist()
            left = left[~near]
    return links


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    def rows(batches):
        for batch in batches:
            a, b = [], []
            for values in batch.column("fingerprints"):
                for x, y in _forest(values.values.to_numpy(zero_copy_only=False).view(np.uint64), radius):
                    a.append(x)
                    b.append(y)
            ends = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (a, b)]
            yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    return buckets.select("fingerprints").mapInArrow(rows, "a long, b long")


def _crowded_links(crowded: DataFrame, radius: int) -> DataFrame:
    """Links of fingerprints of large buckets: all with a common value half way."""
    half = radius // 2
    flips = F.lit(_flips(half))
    probes = crowded.select(
        "fingerprint", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("fingerprint")))).alias("p")
    )
    found = probes.groupBy("p").agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("z"))
    shared = found.filter("a < z").select("p", "a")
    if radius % 2 == 0:
        return probes.join(shared, "p").selectExpr("a", "fingerprint as b").filter("a < b").distinct()
    # an odd radius: one step further from one of the two sides
    one = F.lit(_flips(1))
    steps = probes.select("fingerprint", F.explode(F.transform(one, lambda x: x.bitwiseXOR(F.col("p")))).alias("p"))
    near = steps.join(probes.select("p", F.col("fingerprint").alias("b")), "p")
    return near.selectExpr("fingerprint as a", "b").filter("a < b").distinct()


def near_links(prints: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints within ``radius`` of each other.

    ``prints`` has distinct ``fingerprint`` values. Chains are kept: two values within
    the radius are joined by links returned, not always by one of their own.
    """
    tables = masks(radius)
    entries = F.transform(
        F.lit(tables), lambda m, i: F.struct(i.alias("t"), m.bitwiseAND(F.col("fingerprint")).alias("k"))
    )
    members = prints.select("fingerprint", F.explode(entries).alias("e")).select("e.t", "e.k", "fingerprint")
    sizes = members.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = materialise(sizes)
    small = members.join(sizes.filter(F.col("n") <= bucket_rows).select("t", "k"), ["t", "k"])
    # bounded: no bucket above bucket_rows gets here
    buckets = small.groupBy("t", "k").agg(F.collect_list("fingerprint").alias("fingerprints"))
    large = sizes.filter(F.col("n") > bucket_rows).select("t", "k")
    crowded = materialise(members.join(large, ["t", "k"], "left_semi").select("fingerprint").distinct())
    links = _bucket_links(buckets, radius)
    if crowded.isEmpty():
        return links.distinct()
    return links.unionByName(_crowded_links(crowded, radius)).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of each row.

    ``component_id`` is the smallest doc_id that links of at most ``radius`` differing bits
    reach. A null or blank text has fingerprint zero and is linked like any other. Rows
    with a null doc_id link too, but never name a component unless all in it are null
    (then it is null). Repeated rows each give a row; other columns are left out.
    """
    prints = materialise(fingerprints(docs, shingle_words))
    labels = _labels(prints, radius, bucket_rows)
    return prints.join(labels, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _labels(prints: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """``fingerprint``, ``component_id`` and ``shown`` of each different fingerprint.

    ``shown`` is the smallest fingerprint that has a row with the component's id.
    """
    distinct = materialise(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    found = components(near_links(distinct.select("fingerprint"), radius, bucket_rows))
    named = found.join(distinct, found["node"] == distinct["fingerprint"]).select("node", "component", "least")
    first = F.min(F.struct(F.isnull("least").alias("unnamed"), "least", "node"))
    best = named.groupBy("component").agg(first.alias("best"))
    linked = named.join(best, "component").selectExpr(
        "node as fingerprint", "best.least as linked", "best.node as shown"
    )
    # a row per different fingerprint, so large groups of copies meet one row each
    return materialise(
        distinct.join(linked, "fingerprint", "left").selectExpr(
            "fingerprint", "coalesce(linked, least) as component_id", "coalesce(shown, fingerprint) as shown"
        )
    )


def first_of_group(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """The rows of ``docs`` that represent their near-duplicate group, one of each.

    It is a row with the component_id of its group as doc_id or, in a group without any
    doc_id, one without; of several such rows one with the smallest fingerprint. Rows that share
    doc_id and fingerprint are the same document. All columns are kept.
    """
    prints = materialise(fingerprints(docs, shingle_words))
    labels = _labels(prints, radius, BUCKET_ROWS)
    kept = materialise(labels.filter("fingerprint = shown").select("component_id", "fingerprint"))
    rows_of_id = prints.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    odd = materialise(rows_of_id.filter("n > 1 or doc_id is null").select("doc_id"))
    names = kept.select(F.col("component_id").alias("doc_id"))
    # the id alone tells the row, and a null joins nothing
    single = docs.join(names.join(odd, "doc_id", "left_anti"), "doc_id", "left_semi").select(*docs.columns)
    if odd.isEmpty():
        return single
    # ids with several rows: the fingerprint tells which of them it is
    several = docs.join(odd, docs["doc_id"].eqNullSafe(odd["doc_id"]), "left_semi")
    name = unused("_print", docs.columns)

    def marked(batches):
        for batch in slices(batches):
            found = [fingerprint(t, shingle_words) for t in texts(batch.column("text"))]
            signed = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, signed], [*batch.schema.names, name])

    rows = several.mapInArrow(marked, StructType([*docs.schema.fields, StructField(name, LongType())]))
    same = (rows[name] == kept["fingerprint"]) & rows["doc_id"].eqNullSafe(kept["component_id"])
    found = rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)
    return single.unionByName(found)
