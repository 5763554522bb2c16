"""Exact deduplication against a dictionary of whole texts, through all of its paths."""

import hashlib
from collections import Counter, defaultdict

import pytest

from auditloom.llm import exact
from tests.llm import cases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    found = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            found[(i, keep, len(ids), i == keep, digest)] += 1
    return found


def found(docs, *sizes):
    rows = exact.exact_duplicates(docs, *sizes).collect()
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows)


def copies():
    """A text with a third of all rows, in several cases, among small groups and near copies."""
    rows = [(i, "The SAME text " * 20 if i % 2 else "the same TEXT " * 20) for i in range(400)]
    rows += [(1000 + i, f"pair {i // 2} É" if i % 4 < 2 else f"pair {i // 2} é") for i in range(400)]
    rows += [(2000 + i, "the same text " * 20 + "x" * (i % 300)) for i in range(400)]
    return rows


def test_messy_rows(spark):
    want = brute_force([(r[0], r[1]) for r in cases.messy_rows()])
    assert found(cases.messy(spark)) == want


# buckets of 200 bytes are cut level by level, the crowd of copies in slices
@pytest.mark.parametrize("sizes", [(), (2_000, 4_000), (200, 400)])
def test_levels(spark, sizes):
    docs = spark.createDataFrame(copies(), "doc_id long, text string").repartition(24)
    assert found(docs, *sizes) == brute_force(copies())


def test_different_texts_with_one_hash(spark, monkeypatch):
    monkeypatch.setattr(exact, "content_hash", lambda content: (len(content) % 3, 0))
    monkeypatch.setattr(exact, "MOST_LEVELS", 3)
    docs = spark.createDataFrame(copies(), "doc_id long, text string").repartition(5)
    assert found(docs) == brute_force(copies())
    assert found(docs, 200, 400) == brute_force(copies())


def test_hot_groups_are_looked_up_in_place(spark, monkeypatch):
    monkeypatch.setattr(exact, "HOT_ROWS", 50)
    monkeypatch.setattr(exact, "GATHERED_BYTES", 1_000)
    docs = spark.createDataFrame(copies(), "doc_id long, text string").repartition(5)
    assert found(docs) == brute_force(copies())


def test_empty_table(spark):
    assert found(cases.empty(spark)) == Counter()


def test_table_with_open_addresses():
    table = exact.ContentTable()
    for i in range(5_000):
        # all keys begin at one of four slots
        table.add((i % 4, 0), b"%d" % (i % 2_500), 1, None if i % 3 else i)
    assert len(table) == 2_500 and set(table.copies) == {2}
    assert [j for run in table.batches() for j in run] == list(range(2_500))
