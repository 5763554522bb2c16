"""The manifest against plain Python, and against its SQL on trees of several levels."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from auditloom.llm import merkle
from tests.llm import cases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(nodes):
    """All levels, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def path(levels, at):
    found = []
    for level in levels[:-1]:
        run = level[at // 16 * 16 : at // 16 * 16 + 16]
        found.append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
        at //= 16
    return found


def brute_force(rows):
    leaves = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        plain = sha(encoded(doc_id, source, lang, n_chars, text))
        other = plain
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            other = sha(encoded(doc_id, source, lang, n_chars, text and text.translate(LOWER)))
        leaves[source].append((doc_id is not None, doc_id or 0, plain, other, doc_id))
    sources = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(leaves[s]), tree([x[2] for x in sorted(leaves[s])])) for s in sources}
    top = tree([trees[s][1][-1][0] for s in sources])
    found = Counter()
    for n, s in enumerate(sources):
        for i, (_, _, plain, other, doc_id) in enumerate(trees[s][0]):
            steps = path(trees[s][1], i) + path(top, n)
            folded = other
            for before, after in steps:
                folded = sha(before + folded + after)
            proof = sha("".join(b + a for b, a in steps))
            root = top[-1][0]
            found[(doc_id, plain, trees[s][1][-1][0], root, proof, folded, folded == root)] += 1
    return found


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(docs):
    return Counter(tuple(r) for r in merkle.manifest(docs).select(*COLUMNS).collect())


def test_messy_rows(spark):
    want = brute_force([r[:5] for r in cases.messy_rows()])
    assert found(cases.messy(spark)) == want


def rows(kind):
    if kind == "many sources":
        return [(i, f"Text {i}", "en", f"s{i % 300}" if i % 40 else None, i) for i in range(700)]
    if kind == "one source":
        return [(i, f"Text {i}", "en", "src", i) for i in range(4_100)]
    if kind == "one row":
        return [(6, "Ab", None, None, None)]
    # a third of all rows is one and the same
    return [(i if i % 3 else 9, "A" if i % 3 else "B", "en", "src", 1) for i in range(600)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("kind", ["many sources", "one source", "one row", "repeated rows"])
def test_trees(spark, kind):
    data = rows(kind)
    docs = spark.createDataFrame(data, SCHEMA).repartition(6)
    want = brute_force(data)
    assert found(docs) == want
    assert kind == "repeated rows" or any(not k[-1] for k in want)


def test_sql_is_independent(spark):
    data = rows("many sources")
    connection = duckdb.connect()
    documents = spark.createDataFrame(data, SCHEMA).toArrow()
    connection.register("documents", documents)
    result = connection.execute(merkle.sql(4))
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(COLUMNS)
    got = Counter(tuple(dict(zip(names, r))[c] for c in COLUMNS) for r in result.fetchall())
    assert got == brute_force(data)


def test_only_requested_leaves(spark):
    """Requests for some leaves of one tree; others are not visited."""
    nodes = spark.createDataFrame([(0, i, sha(str(i)), 1_000) for i in range(1_000)], "tree long, rank long, digest string, size long")
    roots, records = merkle.build(nodes)
    start = roots.selectExpr("tree", "digest", "height", f"cast(array() as array<{merkle._SEGMENT}>) as path")
    asked = spark.createDataFrame([(0, r) for r in (0, 17, 999)], "tree long, rank long")
    got = {r["rank"]: r for r in merkle.descend(start, records, asked).collect()}
    levels = tree([sha(str(i)) for i in range(1_000)])
    assert set(got) == {0, 17, 999} and roots.first().digest == levels[-1][0]
    for i, r in got.items():
        assert r.digest == sha(str(i)) and [tuple(s) for s in reversed(r.path)] == path(levels, i)


def test_empty_table(spark):
    assert found(cases.empty(spark)) == Counter()
