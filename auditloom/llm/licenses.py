"""Licence scan: MinHash bands over overlapping windows, then exact containment.

Everything is a DataFrame expression on one row. For each number m of shingles that a
template has, the shingles of a text are cut into windows of 3m, one beginning every m, so
any 2m shingles in a row lie in one window. A window's signature is the smallest hash under
each of ``bands`` hash functions, taken from the blocks of m that it is made of; a template is
retrieved if it agrees in any of them. A window that holds the share ``CONTAINMENT`` of a
template's shingles has a Jaccard similarity of at least c / (4 - c) with it, and ``bands`` is
chosen so that such a pair is retrieved with a probability of at least ``COLLISION``. What is
retrieved is verified exactly: a template is found if any 2m shingles in a row, wherever they
begin, hold that share of its shingles. So an edited notice is found alike at any place.

A match may lack only a few of a template's shingles. So of any group of more than that
many it needs one, hence the longest word of one; texts that fail this for every template
cannot match and are passed over before they are cut into words.
"""

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.llm.license_templates import TEMPLATES
from auditloom.session import materialise

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
COLLISION = 0.9999
MOST_TEMPLATES = 500
_SEPARATORS = "[^a-z0-9]+"


def bands(containment: float = CONTAINMENT, collision: float = COLLISION) -> int:
    """How many one-row bands retrieve a matching window with the wanted probability."""
    jaccard = containment / (4 - containment)
    return math.ceil(math.log(1 - collision) / math.log(1 - jaccard))


def template_shingles(text: str) -> list[str]:
    """Different shingles of a template, in order."""
    words = [w for w in re.split(_SEPARATORS, text.lower()) if w]
    n = SHINGLE_WORDS
    return list(dict.fromkeys(" ".join(words[i : i + n]) for i in range(len(words) - n + 1)))


def _signatures(spark: SparkSession, shingles: dict[str, list[str]], hashes: int) -> dict[str, list[int]]:
    """Signature of each template, by the same functions as those of the windows."""
    rows = spark.sql(
        " union all ".join(f"select {n} as n, array({', '.join(map(repr, s))}) as s" for n, s in enumerate(shingles.values()))
    )
    found = rows.select("n", *[_least(F.col("s"), p).alias(str(p)) for p in range(hashes)]).collect()
    names = list(shingles)
    return {names[r.n]: list(r)[1:] for r in found}


def _hashed(shingles: Column, p: int) -> Column:
    return F.transform(shingles, lambda s: F.xxhash64(s, F.lit(p)))


def _least(shingles: Column, p: int) -> Column:
    return F.array_min(_hashed(shingles, p))


def _possible(low: Column, own: list[str], containment: float) -> Column:
    """Whether a text has a word of each group of shingles of which a match needs one."""
    group = len(own) - math.ceil(containment * len(own) - 1e-9) + 1
    groups = [own[i : i + group] for i in range(0, len(own) - group + 1, group)]
    words = [sorted({max(s.split(), key=len) for s in g}) for g in groups]
    any_of = lambda some: reduce(Column.__or__, [F.contains(low, F.lit(w)) for w in some])
    return reduce(Column.__and__, [any_of(w) for w in words])


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once per row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _windows(hashed: Column, m: int) -> Column:
    """Start and signature of each window of 3m of the shingles ``s``."""
    blocks = F.transform(
        hashed,
        lambda own: F.transform(
            F.sequence(F.lit(0), F.size(own) - 1, F.lit(m)), lambda at: F.array_min(F.slice(own, at + 1, m))
        ),
    )
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("s") - 2 * m - 1), F.lit(m))
    return _let(
        blocks,
        lambda found: F.transform(
            starts,
            lambda at: F.struct(
                at.alias("at"),
                F.transform(
                    found, lambda own: F.array_min(F.slice(own, (at / m).cast("int") + 1, 3))
                ).alias("mins"),
            ),
        ),
    )


def _best(windows: Column, own: list[str], signature: list[int], containment: float) -> Column:
    """Share and negative start of the best run of 2m shingles that holds enough of ``own``."""
    wanted, parts, m = F.lit(signature), F.lit(own), len(own)
    retrieved = F.filter(
        windows,
        lambda w: F.exists(F.zip_with(w["mins"], wanted, lambda a, b: a == b), lambda same: same),
    )

    def shares(w: Column) -> Column:
        last = F.greatest(w["at"], F.least(w["at"] + m, F.size("s") - 2 * m))
        return F.transform(
            F.sequence(w["at"], last),
            lambda at: F.struct(
                (F.size(F.array_intersect(F.slice("s", at + 1, 2 * m), parts)) / F.lit(m)).alias("share"),
                (-at).alias("back"),
            ),
        )

    # the runs of a window are looked at only if the whole window holds enough
    full = F.filter(
        retrieved,
        lambda w: F.size(F.array_intersect(F.slice("s", w["at"] + 1, 3 * m), parts)) / F.lit(m) >= containment,
    )
    return F.array_max(F.filter(F.flatten(F.transform(full, shares)), lambda x: x["share"] >= containment))


def templates_of(table: DataFrame) -> dict[str, str]:
    """Templates from a table with ``license`` and ``text``, at most ``MOST_TEMPLATES`` rows of it.

    Nulls are passed over, repeated names are refused.
    """
    rows = table.select("license", "text").dropna().limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES or len({r.license for r in rows}) < len(rows):
        raise ValueError(f"needs up to {MOST_TEMPLATES} templates with different names")
    return {r.license: r.text for r in rows}


def find_licenses(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT
) -> DataFrame:
    """One row per document and template found: ``doc_id``, ``license``, ``containment``, ``start``.

    ``start`` counts the words (runs of a-z and 0-9 after lower-casing) before the best
    run of shingles, the first of equal ones. Null and empty texts and those of fewer than
    SHINGLE_WORDS words hold nothing, and templates that short are not looked for. Texts of
    any length are read whole, their shingles as one array of the row. Each
    row is judged for itself: repeated rows repeat their result, null doc_ids are kept,
    other columns are left out.
    """
    hashes = bands(containment)
    shingles = {k: s for k, v in sorted(templates.items()) if (s := template_shingles(v))}
    signatures = _signatures(docs.sparkSession, shingles, hashes)
    low = F.lower("text")
    by_size: dict[int, list[str]] = {}
    for name, own in shingles.items():
        by_size.setdefault(len(own), []).append(name)
    # per number of shingles whether a template of that many can match at all
    possible = [
        reduce(Column.__or__, [_possible(low, shingles[name], containment) for name in by_size[m]]) for m in sorted(by_size)
    ]
    hinted = docs.filter(reduce(Column.__or__, possible)).select("doc_id", "text", F.array(*possible).alias("possible"))
    words = F.filter(F.split(low, _SEPARATORS), lambda w: w != "")
    n = SHINGLE_WORDS
    cut = F.transform(
        F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: F.array_join(F.slice("words", i, n), " ")
    )
    def matches(hashed: Column) -> Column:
        found = F.array().cast("array<struct<license:string,best:struct<share:double,back:int>>>")
        return F.concat(
            *[
                F.when(F.col("possible")[i], _let(_windows(hashed, m), per_size(m))).otherwise(found)
                for i, m in enumerate(sorted(by_size))
            ]
        )

    def per_size(m: int):
        return lambda windows: of_size(windows, m)

    def of_size(windows: Column, m: int) -> Column:
        return F.array(
            *[
                F.struct(F.lit(name).alias("license"), _best(windows, shingles[name], signatures[name], containment).alias("best"))
                for name in by_size[m]
            ]
        )

    # written, so that the shingles are made once for their many uses
    texts = materialise(
        hinted.select("doc_id", words.alias("words"), "possible")
        .filter(F.size("words") >= n)
        .select("doc_id", cut.alias("s"), "possible")
    )
    # few bytes but much work each: one shuffle spreads them over all tasks
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = F.array(*[_hashed(F.col("s"), p) for p in range(hashes)])
    spread = texts.repartition(tasks)
    found = spread.select("doc_id", F.explode(_let(hashed, matches)).alias("m")).filter("m.best is not null")
    return found.select(
        "doc_id",
        "m.license",
        F.col("m.best.share").alias("containment"),
        (-F.col("m.best.back")).cast("long").alias("start"),
    )


def sql() -> str:
    """The same in SQL: exact containment in every run of shingles of every text."""
    shingles = {k: s for k, v in sorted(TEMPLATES.items()) if (s := template_shingles(v))}
    values = ", ".join(f"('{k}', {len(s)}, {s!r})" for k, s in shingles.items())
    return f"""
WITH t(license, m, parts) AS (VALUES {values}),
w AS (
    SELECT doc_id, list_filter(string_split_regex(lower(text), '{_SEPARATORS}'), lambda x: x <> '') AS w
    FROM documents WHERE text IS NOT NULL
),
s AS (
    SELECT doc_id, list_transform(range(1, len(w) - {SHINGLE_WORDS - 2}),
        lambda i: array_to_string(w[i:i + {SHINGLE_WORDS - 1}], ' ')) AS s
    FROM w WHERE len(w) >= {SHINGLE_WORDS}
),
h AS (SELECT doc_id, license, m, parts, s FROM s JOIN t ON list_has_any(s, parts)),
x AS (SELECT *, unnest(range(0, greatest(0, len(s) - 2 * m) + 1)) AS start FROM h),
c AS (
    SELECT doc_id, license, start,
        len(list_intersect(list_distinct(s[start + 1:start + 2 * m]), parts)) / m AS containment
    FROM x
),
r AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY containment DESC, start) AS n
    FROM c WHERE containment >= {CONTAINMENT}
)
SELECT doc_id, license, CAST(containment AS DOUBLE) AS containment, CAST(start AS BIGINT) AS start
FROM r WHERE n = 1
"""
