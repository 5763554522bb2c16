"""Licence scan, decontamination and nearest neighbours against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditloom.llm import decontaminate, licenses, neighbours
from tests.llm import cases
from tests.oracle_check import connect, differences


def test_bands_reach_the_wanted_probability():
    jaccard = 0.8 / 3.2
    assert 1 - (1 - jaccard) ** licenses.bands() >= licenses.COLLISION


def test_licenses_agree_with_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = licenses.find_licenses(docs)
    assert found.count() > 0
    assert differences(found, connect(sf_dir), licenses.sql()) == []
    assert "Python" not in found._jdf.queryExecution().toString()


def test_edited_notice_at_every_place(spark):
    """Four words inserted, with 0 to 59 words ahead; also a longer text given as a template."""
    notice = licenses.TEMPLATES["GPL-3.0-notice"].split()
    edited = " ".join([*notice[:14], "we", "said", "it", "again", *notice[14:]])
    draw = random.Random(3)
    own = cases.sentence(draw, 300)
    words = own.split()
    changed = " ".join([*words[:150], "other", *words[150:]])
    rows = [(i, f"{cases.sentence(draw, i)} {edited} {cases.sentence(draw, 80)}") for i in range(60)]
    rows += [(100 + i, f"{cases.sentence(draw, 37 * i)} {changed} {cases.sentence(draw, 900)}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([("own", own), (None, "x"), ("GPL-3.0-notice", " ".join(notice))], "license string, text string")
    found = licenses.find_licenses(docs, licenses.templates_of(table)).collect()
    assert {r.doc_id for r in found if r.license == "GPL-3.0-notice"} == set(range(60))
    assert {r.doc_id for r in found if r.license == "own"} == set(range(100, 108))


def test_licenses_in_odd_rows(spark):
    long = licenses.TEMPLATES["GPL-3.0-notice"].split()
    changed = " ".join(w if i != 10 else "CHANGED" for i, w in enumerate(long))
    draw = [r[1] for r in cases.messy_rows()][20]
    rows = [(100, f"{draw} {changed} {draw}"), (101, " ".join(long[:18])), (102, (licenses.TEMPLATES["MIT"] + ". ") * 2), (103, "MIT")]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.find_licenses(cases.messy(spark).select("doc_id", "text").unionByName(extra)).collect()
    assert {(r.doc_id, r.license) for r in found} == {(13, "MIT"), (100, "GPL-3.0-notice"), (102, "MIT")}
    assert [r.containment for r in found if r.doc_id == 100] == [20 / 25]
    assert licenses.find_licenses(cases.empty(spark)).collect() == []


def brute_leaks(docs, items, overlap=0.8):
    found = set()
    for doc_id, text in docs:
        words = decontaminate.tokens(text)
        for item, item_text in items:
            question, answer = map(decontaminate.tokens, decontaminate.split_item(item_text))
            if not question + answer or item is None:
                continue
            parts = decontaminate.shingles(question)
            n = len(next(iter(parts), ()))
            there = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
            if len(parts & there) >= overlap * len(parts) and sum(a in set(words) for a in answer) >= overlap * len(answer):
                found.add((doc_id, item))
    return found


@pytest.mark.parametrize("index_items", [2_000, 7])
def test_leaks_of_the_whole_table(spark, sf_dir, index_items):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_leaks(docs, benchmark, index_items=index_items).collect()
    want = brute_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in benchmark.collect()])
    assert len(found) == len(want) > 0
    assert {(r.doc_id, r.item_id) for r in found} == want


def test_a_long_item_changes_nothing_for_short_ones(spark, sf_dir):
    """One more item, of 3,000 words: the rows of the others stay, and it is found itself."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    long = cases.sentence(random.Random(6), 3_000)
    more = benchmark.unionByName(spark.createDataFrame([(-1, long)], "item_id long, text string"))
    holder = spark.createDataFrame([(10**9, f"ahead of it {long} and behind")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(holder)
    place = lambda found: {(r.doc_id, r.item_id, r.start) for r in found.collect()}
    before, after = place(decontaminate.find_leaks(rows, benchmark)), place(decontaminate.find_leaks(rows, more))
    assert {(d, i) for d, i, _ in after - before} == {(10**9, -1)} and before <= after
    indexes = list(decontaminate._indexes(more, 2_000))
    assert len({index.passage for index in indexes}) == len(indexes) > 1
    assert [len(g) for g in decontaminate._passes(iter(indexes), 1)] == [1] * len(indexes)
    assert [len(g) for g in decontaminate._passes(iter(indexes), 1 << 30)] == [len(indexes)]


def test_leaks_are_the_same_however_rows_are_dealt(spark, monkeypatch):
    import pyarrow as pa

    draw, returned = random.Random(8), []
    items = [cases.sentence(draw, 40) for _ in range(3)]
    rows = [(i, cases.sentence(draw, 50) + " " + (items[i % 3] if i % 4 == 0 else "")) for i in range(30)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    indexes = list(decontaminate._indexes(benchmark, 2_000))
    monkeypatch.setattr(decontaminate, "release", lambda: returned.append(True))
    results = []
    for most, words in ((30, 200_000), (7, 200_000), (1, 200_000), (30, 60), (7, 130)):
        monkeypatch.setattr(decontaminate, "CHUNK_WORDS", words)
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.string()))]
        whole = pa.RecordBatch.from_arrays(columns, ["doc_id", "text"])
        batches = [whole.slice(at, most) for at in range(0, len(rows), most)]
        found = decontaminate._leaks(iter(batches), indexes, 0.5, 0.8, "long")
        results.append(sorted(tuple(r.values()) for b in found for r in b.to_pylist()))
    assert {r[0] for r in results[0]} == {i for i in range(30) if i % 4 == 0}
    assert all(r == results[0] for r in results) and len(returned) == 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, decontaminate.find_leaks(docs, benchmark).collect())) == results[0]


def test_leaks_start_no_python_besides_the_search(spark):
    """Rows of the result come from the documents; a frame made in Python has tasks of its own."""
    benchmark = spark.range(1).selectExpr("id as item_id", "'a b c d e f' as text")
    docs = spark.range(3).selectExpr("id as doc_id", "'a b c' as text")
    for found in (decontaminate.find_leaks(docs, benchmark), decontaminate.find_leaks(docs, benchmark.limit(0))):
        assert "ExistingRDD" not in found._jdf.queryExecution().toString()
        assert dict(found.dtypes)["doc_id"] == "bigint" and len(found.columns) == 6


def test_search_misses_no_score(spark):
    draw = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(120)]
    pick = lambda n: [vocabulary[min(119, int(x))] for x in draw.exponential(25, n)]
    rows = [(i, " ".join(pick(draw.integers(3, 40))), " ".join(pick(draw.integers(0, 6)))) for i in range(50)]
    counts = {}
    for _, q, a in rows:
        for w in set(q.split() + a.split()):
            counts[w] = counts.get(w, 0) + 1
    index = decontaminate.Index.build(rows, counts, 50, np.mean([len((q + " " + a).split()) for _, q, a in rows]))
    impact = {}
    names = list(index.words)
    for run, a, b in zip(index.runs, index.run_bounds, index.run_bounds[1:]):
        for p in range(a, b):
            impact[names[run // index.block_max.shape[1]], int(index.items[p])] = index.impacts[p]
    texts = [pick(n) for n in (0, 3, 64, 128, 129, 200, 1000)]
    for threshold in (0.2, 0.5, 0.8):
        want = {}
        for n, words in enumerate(texts):
            step = index.passage // 2
            for start in range(0, max(1, len(words) - index.passage + step), step):
                seen = set(words[start : start + index.passage])
                for item in range(50):
                    total = sum(impact.get((w, item), 0) for w in seen)
                    if total >= threshold:
                        want[n, start, item] = total
        got = {(n, start, item): x for n, start, item, x in index.search(texts, threshold)}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_leaks_of_odd_rows(spark):
    passage = cases.messy_rows()[7][1]
    items = [(1, passage), (2, None), (3, ""), (None, passage), (4, "..."), (1, passage), (5, "Unseen words here. No.")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    found = decontaminate.find_leaks(cases.messy(spark), benchmark).collect()
    assert sorted(str(r.doc_id) for r in found) == ["7", "7", "8", "9", "None"]
    assert {r.item_id for r in found} == {1}
    named = cases.messy(spark).withColumn("_key", F.lit("kept"))
    kept = decontaminate.without_leaks(named, benchmark)
    assert kept.columns == named.columns and {r["_key"] for r in kept.collect()} == {"kept"}
    # of the two rows without id only the one that holds the item goes
    assert not {7, 8, 9} & {r.doc_id for r in kept.collect()}
    assert [r.text for r in kept.collect() if r.doc_id is None] == [None]
    assert decontaminate.find_leaks(cases.empty(spark), benchmark).collect() == []
    assert decontaminate.find_leaks(cases.messy(spark), benchmark.limit(0)).collect() == []


def brute_nearest(ids, vectors, k):
    found = {}
    for i, (own, v) in enumerate(zip(ids, vectors)):
        scores = vectors @ v
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != own][:k]
        found[own] = [ids[j] for j in order]
    return found


def test_recall_of_the_whole_table(spark, sf_dir):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0, shard_rows=2_000).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, {})[r.rank] = r
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]])
        mine = by_query[ids[q]]
        assert sorted(mine) == list(range(1, 21))
        order = [(-mine[n].score, mine[n].vec_id) for n in sorted(mine)]
        assert order == sorted(order)
        for r in mine.values():
            assert abs(r.score - vectors[np.searchsorted(ids, r.vec_id)] @ vectors[q]) < 1e-12
        hits.append(len(best & {r.vec_id for r in mine.values()}) / 20)
    assert np.mean(hits) >= 0.9


def kinds_of_vectors(kind):
    draw = np.random.default_rng(3)
    if kind == "clusters":
        return draw.normal(size=(40, 32))[draw.integers(0, 40, 6_000)] + 0.3 * draw.normal(size=(6_000, 32))
    vectors = draw.normal(size=(6_000, 256 if kind == "256 dimensions" else 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors * np.exp(0.5 * draw.normal(size=(6_000, 1))) if kind == "lengths" else vectors


@pytest.mark.parametrize("kind", ["lengths", "256 dimensions", "clusters", "directions"])
def test_recall_on_other_vectors(kind):
    """Shards as the query makes them, asked for the neighbours of a twentieth of the rows."""
    vectors, ids = kinds_of_vectors(kind), np.arange(6_000)
    pivot = vectors[:: 6_000 // neighbours.PIVOTS][: neighbours.PIVOTS]
    pivot = pivot / np.linalg.norm(pivot, axis=1, keepdims=True)
    share, cosine = neighbours.measure(ids[::2], vectors[::2], pivot, 20)
    shards = [neighbours.Shard(ids[i::3], vectors[i::3], pivot, neighbours.PREFIX) for i in range(3)]
    hits = []
    for q in range(0, 6_000, 20):
        [place] = neighbours.places(vectors[[q]], pivot)
        found = []
        for shard in shards:
            take = int(np.ceil(share * len(shard.vectors)))
            found += shard.nearest(q, vectors[q], place, 20, take, cosine)
        mine = {i for i, _ in sorted(found, key=lambda x: (-x[1], x[0]))[:20]}
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits.append(len(mine & set(np.argsort(-scores)[:20].tolist())) / 20)
    assert np.mean(hits) >= 0.93
    print(kind, round(share, 3), round(float(np.mean(hits)), 3))


def test_exact_where_all_are_candidates_and_with_odd_rows(spark):
    draw = np.random.default_rng(2)
    vectors = [list(map(float, draw.normal(size=5))) for _ in range(30)]
    vectors[3] = vectors[9] = vectors[20]  # ties
    rows = list(enumerate(vectors)) + [(7, vectors[7])]  # a repeated row
    odd = [(100, None), (101, [0.0] * 5), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("nan")] * 5),
           (104, [float("inf")] * 5), (105, [1.0]), (None, vectors[0]), (106, [])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 2 == 0, k=6, shard_rows=8, query_rows=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    single = np.array(vectors, dtype=np.float32).astype(float)
    want = brute_nearest(np.arange(30), single, 6)
    assert {q: [v for _, v in sorted(x)] for q, x in got.items()} == {q: want[q] for q in range(0, 30, 2)}
    assert neighbours.nearest(table.limit(0), F.col("vec_id") % 2 == 0).collect() == []
    few = neighbours.nearest(table.filter("vec_id in (1, 2)"), F.col("vec_id") % 2 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in few] == [(2, 1, 1)]
