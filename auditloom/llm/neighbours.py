"""Approximate nearest neighbours with a permutation index.

A vector is represented by its nearest pivots in order. The rows are dealt to shards, and
each shard posts its vectors in one inverted file per pivot: which vectors have it among
their first ``PREFIX`` pivots, and at which place. A query reads the files of its own
first pivots and adds up footrule distances, a pivot missing from a prefix standing at
the place after its end. Places tell the angle, not the length, so vectors are ranked by their
length times a cosine that few exceed at their footrule distance. The best of a shard's vectors
are ranked again by their inner product, in double precision.

How many, and which cosine a distance stands for, is measured on a sample of at most
``SAMPLE_NUMBERS`` numbers: so many that ``REACHED`` of the true neighbours of ``SAMPLE_QUERIES``
of its vectors are among them. Where places tell little, as for vectors of many dimensions without
clusters, that is a large part of the shard.

Equal vectors of a shard are posted once with all their ids, so that a crowd of copies
neither fills the candidates nor lengthens the files. Queries and rows meet in blocks:
every block of queries visits every shard, each pair in a group of bounded size, and
returns its best; Spark then keeps the best of all shards. Pivots are a fixed number of
different vectors drawn by a hash.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auditloom.session import materialise

PIVOTS = 512
PREFIX = 48
# least number of a shard's different vectors that are ranked again
LEAST_CANDIDATES = 500
# sample that tells how many are needed, and the part of true neighbours to be reached there
SAMPLE_NUMBERS, SAMPLE_QUERIES, REACHED = 1_000_000, 128, 0.97
# distances are grouped in so many classes to tell their cosines
CLASSES = 64
SHARD_ROWS = 8_192
QUERY_ROWS = 4_096
NEAREST = 20


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` (doubles) of the rows that take part.

    Left out: null ids and vectors, vectors that are zero or hold null, infinite or NaN
    components, and vectors that are not of the most frequent length (the shorter of
    equally frequent ones). Equal rows count once.
    """
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).filter(
        F.col("vec_id").isNotNull() & v.isNotNull() & fine & F.exists(v, lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").limit(1)
    return rows.join(F.broadcast(common), F.size("v") == F.col("size"), "left_semi").distinct()


def pivots(rows: DataFrame, count: int = PIVOTS) -> np.ndarray:
    """Different vectors that come first by a hash, scaled to length one."""
    drawn = rows.select("v", F.xxhash64("v", F.lit("pivot")).alias("draw")).distinct()
    found = np.array([r.v for r in drawn.orderBy("draw").limit(count).collect()], dtype=np.float64)
    return found / np.linalg.norm(found, axis=1, keepdims=True) if len(found) else found


def places(vectors: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    """Place of each pivot in the order of each vector, nearest first."""
    order = np.argsort(-(vectors @ pivot.T), axis=1, kind="stable")
    found = np.empty(order.shape, dtype=np.int16)
    np.put_along_axis(found, order, np.arange(len(pivot), dtype=np.int16)[None, :], axis=1)
    return found


class Shard:
    """Inverted files of some rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivot: np.ndarray, prefix: int) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        as_bytes = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
        _, first, self.of = np.unique(as_bytes, return_index=True, return_inverse=True)
        self.vectors, self.pivot, self.prefix = vectors[first], pivot, min(prefix, len(pivot))
        self.ids, self.lengths = ids, np.linalg.norm(self.vectors, axis=1)
        by_vector = np.argsort(self.of, kind="stable")  # ids of one vector stay in order
        self.members, self.bounds = by_vector, np.searchsorted(self.of[by_vector], np.arange(len(first) + 1))
        at = np.ascontiguousarray(places(self.vectors, pivot).T)
        # the file of each pivot: the vectors posted there, and their places
        self.posted = [np.flatnonzero(own < self.prefix) for own in at]
        self.at = [at[p, own] for p, own in enumerate(self.posted)]

    def footrule(self, place: np.ndarray) -> np.ndarray:
        """Distance of a query's places to those of each vector, less a constant of the query."""
        total = np.zeros(len(self.vectors), dtype=np.int32)
        for p in np.flatnonzero(place < self.prefix).tolist():
            # |a - b| instead of (prefix - a) + (prefix - b), what missing it would add
            total[self.posted[p]] -= 2 * (self.prefix - np.maximum(self.at[p], place[p]))
        return total

    def nearest(self, own_id: int, vector: np.ndarray, place: np.ndarray, k: int, take: int, cosine):
        """Ids and scores of the best ``k`` among the ``take`` that footrule and length rank first."""
        if take < len(self.vectors):
            expected = self.lengths * np.interp(self.footrule(place), *cosine)
            near = np.argpartition(-expected, take - 1)[:take]
        else:
            near = np.arange(len(self.vectors))
        # each sum is that of one vector alone, so a score does not depend on the others
        scores = (self.vectors[near] * vector).sum(axis=1)
        order = np.argsort(-scores, kind="stable")
        least = scores[order[min(k, len(order) - 1)]]  # one more, as the query may be there
        ids, found = [], []
        for i, score in zip(near[order].tolist(), scores[order].tolist()):
            if score < least:
                break
            some = self.ids[self.members[self.bounds[i] : self.bounds[i + 1]][: k + 1]]
            ids += some[some != own_id][:k].tolist()
            found += [score] * (len(ids) - len(found))
        order = np.lexsort((ids, -np.array(found)))[:k] if ids else []
        return [(ids[i], found[i]) for i in order]


def measure(ids: np.ndarray, vectors: np.ndarray, pivot: np.ndarray, k: int) -> tuple[float, tuple]:
    """The share of a shard to rank again, and high cosines at rising footrule distances."""
    shard = Shard(ids, vectors, pivot, PREFIX)
    asked = np.linspace(0, len(shard.vectors) - 1, min(SAMPLE_QUERIES, len(shard.vectors))).astype(int)
    distances = np.array([shard.footrule(p) for p in places(shard.vectors[asked], pivot)])
    products = shard.vectors[asked] @ shard.vectors.T
    cosines = products / (shard.lengths[asked][:, None] * shard.lengths[None, :])
    others = np.arange(len(shard.vectors))[None, :] != asked[:, None]
    order = np.argsort(distances[others], kind="stable")
    parts = [p for p in np.array_split(order, CLASSES) if len(p)]
    if not parts:
        return 1.0, (np.zeros(1), np.zeros(1))
    at = np.array([distances[others][p].mean() for p in parts])
    # a cosine that few exceed: with the mean, great lengths would count for nothing at angles of 90 degrees
    high = np.array([cosines[others][p].mean() + 2 * cosines[others][p].std() for p in parts])
    found = []
    for row, own in enumerate(asked):
        products[row, own] = -np.inf
        expected = shard.lengths * np.interp(distances[row], at, high)
        expected[own] = -np.inf
        rank = np.empty(len(expected), dtype=np.int64)
        rank[np.argsort(-expected, kind="stable")] = np.arange(len(expected))
        found.append(rank[np.argsort(-products[row], kind="stable")[: min(k, len(expected) - 1)]])
    needed = np.quantile(np.concatenate(found), REACHED) + 1
    return float(needed / len(shard.vectors)), (at, high)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = NEAREST,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` nearest found.

    ``is_query`` is a condition on ``vec_id``. Candidates are all rows with another vec_id;
    equal scores go to the smaller vec_id. A vec_id with several different vectors asks
    and is found with each of them, its best score counting. Rows that take no part are
    listed at ``usable``; other columns are not looked at, and an empty table gives no rows.
    """
    rows = materialise(usable(vectors))
    total, queries = rows.count(), rows.filter(is_query).count()
    shards, blocks = -(-total // shard_rows), -(-queries // query_rows)
    schema = "query_id long, vec_id long, score double"
    if not queries:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pivot = pivots(rows)
    sample_rows = max(1, min(shard_rows, SAMPLE_NUMBERS // pivot.shape[1]))
    sample = rows.orderBy(F.xxhash64("vec_id", "v", F.lit("sample"))).limit(sample_rows).collect()
    share, cosine = measure(np.array([r.vec_id for r in sample]), np.array([r.v for r in sample]), pivot, k)
    shared = rows.sparkSession.sparkContext.broadcast((pivot, share, cosine))

    def search(key, data: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if len(data) and len(asked):
            pivot, share, cosine = shared.value
            shard = Shard(data["vec_id"].to_numpy(), _matrix(data["v"]), pivot, PREFIX)
            take = max(LEAST_CANDIDATES, int(np.ceil(share * len(shard.vectors))))
            ids, query = asked["vec_id"].to_pylist(), _matrix(asked["v"])
            for own, vector, place in zip(ids, query, places(query, pivot)):
                out += [(own, *x) for x in shard.nearest(own, vector, place, k, take, cosine)]
        columns = list(zip(*out)) if out else [[]] * 3
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "vec_id", "score"]
        )

    # every block of queries meets every shard, in groups of about shard_rows + query_rows
    dealt = lambda n, seed: F.pmod(F.xxhash64("vec_id", "v", F.lit(seed)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = rows.select("vec_id", "v", dealt(shards, 1).alias("shard"), each(blocks).alias("block"))
    asked = rows.filter(is_query).select("vec_id", "v", dealt(blocks, 2).alias("block"), each(shards).alias("shard"))
    found = (
        data.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(search, schema)
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
