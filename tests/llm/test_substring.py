"""Removal of repeated word sequences against brute force."""

import hashlib
import re
from collections import Counter

import pytest

from auditloom.llm import substring
from tests.llm import cases


def brute_force(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    found = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        found.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(found)


def found(docs, window):
    rows = substring.remove_repeats(docs, window).collect()
    for r in rows:
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows)


@pytest.mark.parametrize("window", [35, 5, 2])
def test_messy_rows(spark, window):
    docs = cases.messy(spark)
    assert found(docs, window) == brute_force([(r[0], r[1]) for r in cases.messy_rows()], window)


def test_whole_table_even_with_a_sketch_that_overflows(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute_force([(r.doc_id, r.text) for r in docs.collect()], 35)
    assert found(docs, 35) == want
    # far too few counters: nearly every estimate is too high
    monkeypatch.setattr(substring, "_log_width", lambda docs: 16)
    monkeypatch.setattr(substring, "ROWS", 1)
    assert found(docs, 35) == want


def test_empty_table(spark):
    assert found(cases.empty(spark), 35) == Counter()
