"""Fingerprints and components against brute force; the covering property."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from auditloom.llm import simhash
from auditloom.llm.components import components
from tests.llm import cases


def fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    parts = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, radius):
    """Smallest reachable position of each value."""
    group = list(range(len(values)))
    v = np.array(values, dtype=np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= radius):
            a, b = group[i], group[j]
            if a != b:
                group = [min(a, b) if g in (a, b) else g for g in group]
    return group


def brute_force(rows):
    prints = [fingerprint(t) for _, t in rows]
    group = groups(prints, 4)
    least = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    return sorted(((i, format(p, "016x"), least.get(g)) for (i, _), p, g in zip(rows, prints, group)), key=str)


def test_every_pair_within_the_radius_agrees_under_a_mask():
    masks = [m % (1 << 64) for m in simhash.masks()]
    assert len(masks) == 31
    draw = random.Random(1)
    for _ in range(20_000):
        flipped = sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4)))
        assert any(flipped & m == 0 for m in masks)


@pytest.mark.parametrize("bucket_rows", [4096, 2])
def test_messy_rows(spark, bucket_rows):
    got = simhash.near_duplicates(cases.messy(spark), bucket_rows=bucket_rows).collect()
    assert sorted(map(tuple, got), key=str) == brute_force([(r[0], r[1]) for r in cases.messy_rows()])


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    assert got == brute_force([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("radius,bucket_rows", [(4, 5), (3, 5), (4, 4096)])
def test_crowds_of_near_values(spark, radius, bucket_rows):
    draw = random.Random(radius)
    base = [draw.getrandbits(64) for _ in range(3)]
    values = {b ^ sum(1 << i for i in draw.sample(range(64), draw.randint(0, 5))) for b in base for _ in range(40)}
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = components(simhash.near_links(prints, radius, bucket_rows)).collect()
    label = {r.node: r.component for r in found}
    want = groups(sorted(values), radius)
    for i, v in enumerate(signed):
        mates = {w for w, g in zip(signed, want) if g == want[i]}
        if len(mates) > 1:
            assert {w for w in signed if label.get(w) == label[v]} == mates
        else:
            assert v not in label


def test_components_of_long_chains(spark):
    draw = random.Random(3)
    ids = draw.sample(range(1_000_000), 300)
    links = list(zip(ids[:199], ids[1:200])) + list(zip(ids[200:], ids[201:])) + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: min(ids[:200]) for i in ids[:200]} | {i: min(ids[200:]) for i in ids[200:]} | {5: 5}


def test_one_of_each_group_stays(spark):
    named = cases.messy(spark).selectExpr("*", "'kept' as _print", "'kept' as _odd")
    kept = simhash.first_of_group(named).collect()
    assert {(r["_print"], r["_odd"]) for r in kept} == {("kept", "kept")}
    want = {c for i, _, c in brute_force([(r[0], r[1]) for r in cases.messy_rows()]) if c is not None}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(want)


def test_rows_without_id_and_texts_that_share_an_id(spark):
    draw = random.Random(5)
    a, b, c, d = (cases.sentence(draw, 60) for _ in range(4))
    rows = [(1, a), (None, a), (None, a), (2, a), (1, b), (3, b), (None, c), (None, c), (5, d), (4, d), (5, d)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, lang string")
    kept = simhash.first_of_group(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, a), (1, b), (None, c), (4, d)])


def test_empty_table(spark):
    assert simhash.near_duplicates(cases.empty(spark)).collect() == []
