"""Merkle manifest of a dataset, and proofs by descent through its content-addressed DAG.

Leaves hash the columns of a row. Per source, runs of ``FAN`` nodes become their hash until
one is left, the subroot; the subroots, ordered by source, become the root in the same way.
Every hash of a run is stored as a record from the digest to its children, whichever level
it comes from. Building is one grouping per level, each a sixteenth of the one before; the
order of the leaves comes from a range sort, so that a source with most of the rows is
spread over many tasks.

Proofs descend: leaf requests start at the root, look up the record of their digest, take
the child that the next digit of their rank (base ``FAN``) names and collect the children
not taken, one path segment a level. Requests that share the digits so far are one request,
so that a level has no more of them than the level has nodes, and they meet records
whose digests differ, which leaves no key with many rows. At the leaves the segments are
reversed, which puts the siblings in the order in which a leaf is folded up to the root.
"""

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from auditloom.llm.text import LOWER, UPPER
from auditloom.session import materialise

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# every how many documents one is tampered with, by crc32 of its doc_id
TAMPERED = 5

_SEGMENT = "struct<before:string,after:string>"


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """Digest of a row; ``text`` stands in for its text where given."""
    columns = [F.col(c) for c in FIELDS[:-1]] + [F.col("text") if text is None else text]
    return F.sha2(F.concat(*[_encoded(c) for c in columns]), 256)


def _chosen_for_tampering() -> Column:
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(checksum % TAMPERED == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``leaf``, and ``tampered``: the leaf of a row changed on the way, or null."""
    changed = leaf(F.translate("text", UPPER, LOWER))
    return docs.select(
        "doc_id", "source", leaf().alias("leaf"), F.when(_chosen_for_tampering(), changed).alias("tampered")
    )


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Written ``rows`` with ``rank``, their place in their group, and ``size``, that of the group.

    Places count from 0, nulls first. Rows are sorted across tasks; a place is that inside its
    task and group plus the rows of the group in the tasks before, so no group has to fit
    into a task and no join has a key of more rows than a task.
    """
    kind = StructType([*rows.schema.fields, StructField("_place", LongType())])

    def place(batches):
        last, n = None, 0
        for batch in batches:
            found = []
            for value in batch.column(group).to_pylist():
                n = n + 1 if (value,) == last else 0
                last = (value,)
                found.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], kind.names)

    order = [group, *order]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(ordered.mapInArrow(place, kind).withColumn("_part", F.spark_partition_id()))
    # a row per task and group in it
    counts = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.selectExpr(
        f"{group} as _group",
        "_part as _own",
        f"sum(_n) over (partition by {group}) as size",
        f"coalesce(sum(_n) over (partition by {group} order by _part "
        "rows between unbounded preceding and 1 preceding), 0) as _ahead",
    )
    same = placed[group].eqNullSafe(totals["_group"]) & (placed["_part"] == totals["_own"])
    place_in_all = (F.col("_place") + F.col("_ahead")).alias("rank")
    return materialise(placed.join(totals, same).select(*rows.columns, "_part", place_in_all, "size"))


def _parents(nodes: DataFrame) -> DataFrame:
    """Runs of nodes (``tree``, ``rank``, ``digest``, ``size``) as nodes with their ``children``."""
    run = F.array_sort(F.collect_list(F.struct("rank", "digest")))
    return (
        nodes.groupBy("tree", F.floor(F.col("rank") / FAN).alias("run"))
        .agg(F.transform(run, lambda x: x["digest"]).alias("children"), F.first("size").alias("size"))
        .select(
            "tree",
            F.col("run").alias("rank"),
            F.sha2(F.concat_ws("", "children"), 256).alias("digest"),
            F.ceil(F.col("size") / FAN).alias("size"),
            "children",
        )
    )


def build(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The written roots of all trees, and the written records of each level above the leaves.

    ``nodes`` holds ``tree``, ``rank`` and ``digest`` of the leaves and ``size``, the leaves of
    their tree. A root has ``tree``, ``digest`` and ``height``, the levels above its leaves.
    """
    roots, records = [], []
    level = nodes.select("tree", "rank", "digest", "size")
    while True:
        roots.append(level.filter("size = 1").select("tree", "digest", F.lit(len(records)).alias("height")))
        growing = level.filter("size > 1")
        if growing.isEmpty():
            return materialise(reduce(DataFrame.unionByName, roots)), records
        parents = materialise(_parents(growing))
        records.append(parents.select("digest", "children"))
        level = parents.drop("children")


def descend(starts: DataFrame, records: list[DataFrame], requests: DataFrame) -> DataFrame:
    """Every requested leaf with its ``digest`` and ``path``.

    ``starts`` holds ``tree``, ``digest`` and ``height`` of the roots and the ``path`` that led to
    them; ``requests`` holds ``tree`` and ``rank``, each pair once. Further columns of both are
    carried along. A path has one segment a level, root first, with the digests ``before`` and
    ``after`` the child taken. Rows of the last level meet all requests below their node at
    once, so paths travel once per run of leaves.
    """
    carried = [c for c in starts.columns if c not in ("tree", "digest", "height")]
    payload = [c for c in requests.columns if c not in ("tree", "rank")]
    digit = (F.col("rank") % FAN).cast("int").alias("digit")

    def entering(height: int) -> DataFrame:
        at = starts.filter(F.col("height") == height)
        return at.select("tree", F.lit(0).cast("long").alias("rank"), "digest", *carried)

    # what is asked for below each prefix, a table per level from the leaves upwards
    wanted, prefixes = [], requests
    for _ in records:
        below = F.collect_list(F.struct(digit, *[c for c in payload if c in prefixes.columns]))
        asked = prefixes.groupBy("tree", F.floor(F.col("rank") / FAN).alias("rank")).agg(below.alias("asked"))
        wanted.append(materialise(asked))
        prefixes = wanted[-1].select("tree", "rank")
    front = entering(len(records))
    for height in range(len(records), 0, -1):
        # equal nodes share a record
        store = records[height - 1].dropDuplicates(["digest"])
        at = F.col("a.digit")
        segment = F.struct(
            F.concat_ws("", F.slice("children", F.lit(1), at)).alias("before"),
            F.concat_ws("", F.slice("children", at + 2, F.lit(FAN))).alias("after"),
        )
        taken = (
            front.join(wanted[height - 1], ["tree", "rank"])
            .join(store, "digest")
            .select("tree", "rank", "children", *carried, F.explode("asked").alias("a"))
            .select(
                "tree",
                (F.col("rank") * FAN + at).alias("rank"),
                F.get("children", at).alias("digest"),
                *[c for c in carried if c != "path"],
                F.concat("path", F.array(segment)).alias("path"),
                *([f"a.{c}" for c in payload] if height == 1 else []),
            )
        )
        front = (taken if height == 1 else materialise(taken).unionByName(entering(height - 1)))
    lone = entering(0).join(requests, ["tree", "rank"])
    return front.unionByName(lone) if records else lone


def folded(leaf_digest: Column, segments: Column) -> Column:
    """The root that a leaf and its siblings give; ``segments`` from the leaf upwards."""
    return F.aggregate(
        segments, leaf_digest, lambda digest, s: F.sha2(F.concat(s["before"], digest, s["after"]), 256)
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Digest, proof and check of every row.

    ``leaf``, ``subroot``, ``root`` and ``proof_sha256`` are those of the table as it is;
    ``folded_root`` is folded from the leaf as it arrives, changed for some rows, and the
    original siblings, and ``verified`` says whether it is the root. Nulls, empty and very
    long texts hash like any value. Null sources are a source of their own, ahead of all
    others; null doc_ids come first in their source and are never changed. Rows that share
    source and doc_id are ordered by digest; repeated rows are leaves of their own with the same
    digest. Other columns are left out, whatever their names; an empty table gives no rows.
    """
    rows = ranked(materialise(leaves(docs)), "source", ["doc_id", "leaf"])
    # the number of a source is its rank among all, found by task and source like the rank
    names = rows.groupBy("source").agg(F.lit(0).alias("all"))
    sources = ranked(materialise(names), "all", ["source"]).selectExpr(
        "source as _source", "rank as tree", "size"
    )
    here = rows.select("source", "_part").distinct()
    trees = here.join(sources, here["source"].eqNullSafe(sources["_source"]))
    trees = trees.selectExpr("_source", "_part as _own", "tree")
    same = rows["source"].eqNullSafe(trees["_source"]) & (rows["_part"] == trees["_own"])
    numbered = materialise(
        rows.join(trees, same).select("tree", "rank", "size", "doc_id", "leaf", "tampered")
    )
    subroots, lower = build(numbered.select("tree", "rank", F.col("leaf").alias("digest"), "size"))
    # one row per source on both sides
    tops = subroots.join(sources.select("tree", "size"), "tree")
    tops = materialise(tops.withColumn("top", F.lit(0).cast("long")))
    root, upper = build(tops.selectExpr("top as tree", "tree as rank", "digest", "size"))
    start = root.select(
        "tree", "digest", "height", F.array().cast(f"array<{_SEGMENT}>").alias("path"), F.col("digest").alias("root")
    )
    to_sources = descend(start, upper, tops.selectExpr("top as tree", "tree as rank", "height as of_source"))
    starts = to_sources.selectExpr(
        "rank as tree", "digest", "of_source as height", "path", "root", "digest as subroot"
    )
    found = descend(materialise(starts), lower, numbered.select("tree", "rank", "doc_id", "tampered"))
    upwards = F.reverse("path")
    siblings = F.concat_ws("", F.transform(upwards, lambda s: F.concat(s["before"], s["after"])))
    return found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "digest"), upwards).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_level(k: int, nodes: str, group: str, tag: str) -> str:
    """The parents of level ``k`` and, per node, the siblings before and after it."""
    part = f"{group}, rank // {FAN}"
    return f"""
{tag}{k + 1} AS (
  SELECT {group}, rank // {FAN} AS rank, sha256(string_agg(digest, '' ORDER BY rank)) AS digest,
    (any_value(size) + {FAN - 1}) // {FAN} AS size
  FROM {nodes} WHERE size > 1 GROUP BY {part}
  UNION ALL SELECT {group}, rank, digest, size FROM {nodes} WHERE size = 1),
{tag}s{k} AS (
  SELECT {group}, rank, size,
    coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {nodes} WINDOW w AS (PARTITION BY {part} ORDER BY rank)),"""


# crc32 bit by bit over the characters of a number, least significant bit first
_SQL_CRC32 = """xor(4294967295, list_reduce(
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) ELSE xor(r >> 1, (r & 1) * 3988292384) END, 4294967295::BIGINT))"""


def sql(levels: int = 6) -> str:
    """The same over trees of at most ``FAN`` ** ``levels`` leaves, level by level."""

    def field(name: str, value: str | None = None) -> str:
        text = f"CAST({value or name} AS VARCHAR)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    row = " || ".join(field(c) for c in FIELDS)
    changed = " || ".join([*[field(c) for c in FIELDS[:-1]], field("text", f"translate(text, '{UPPER}', '{LOWER}')")])
    query = f"""
WITH hashed AS (
  SELECT doc_id, source, sha256({row}) AS leaf, sha256({changed}) AS tampered FROM documents),
n0 AS (
  SELECT *, leaf AS digest, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER s AS size,
    row_number() OVER (s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
  FROM hashed WINDOW s AS (PARTITION BY source)),"""
    for k in range(levels):
        query += _sql_level(k, f"n{k}", "tree", "n")
    query += f"""
t0 AS (SELECT 0 AS one, tree AS rank, digest, count(*) OVER () AS size FROM n{levels}),"""
    for k in range(levels):
        query += _sql_level(k, f"t{k}", "one", "t")
    joins, steps = "", []
    for k in range(levels):
        joins += f" JOIN ns{k} ON ns{k}.tree = n0.tree AND ns{k}.rank = n0.rank // {FAN**k}"
        steps.append(f"ns{k}")
    for k in range(levels):
        joins += f" JOIN ts{k} ON ts{k}.rank = n0.tree // {FAN**k}"
        steps.append(f"ts{k}")
    proof = " || ".join(f"CASE WHEN {s}.size > 1 THEN {s}.before || {s}.after ELSE '' END" for s in steps)
    query += f"""
proofs AS (
  SELECT n0.*, n{levels}.digest AS subroot, sha256({proof}) AS proof_sha256, """
    query += ", ".join(f"{s}.size AS z{i}, {s}.before AS b{i}, {s}.after AS a{i}" for i, s in enumerate(steps))
    query += f"""
  FROM n0 JOIN n{levels} ON n{levels}.tree = n0.tree{joins}),
f0 AS (SELECT *, CASE WHEN {_SQL_CRC32} % {TAMPERED} = 0 THEN tampered ELSE leaf END AS folded FROM proofs),"""
    for i in range(len(steps)):
        query += f"""
f{i + 1} AS (
  SELECT * REPLACE (CASE WHEN z{i} > 1 THEN sha256(b{i} || folded || a{i}) ELSE folded END AS folded) FROM f{i}),"""
    return (
        query.rstrip(",")
        + f"""
SELECT doc_id, leaf, subroot, t{levels}.digest AS root, proof_sha256, folded AS folded_root,
  folded = t{levels}.digest AS verified
FROM f{len(steps)}, t{levels}
"""
    )
