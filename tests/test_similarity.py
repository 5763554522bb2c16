"""Similarity joins against brute force, with cells forced through every path."""

import math
import os
import random
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditloom import session
from auditloom.operators import similarity
from auditloom.params import AuditParams
from tests.test_rules import invoice, table

PATHS = {
    "candidate pairs": AuditParams(),
    "tiles": AuditParams(tile_rows=4, pair_rows=2),
    "hot keys": AuditParams(tile_rows=5, pair_rows=3, hot_min_rows=3, hot_share=0.0005),
}


def brute_force(ids, product, k, floor):
    result = {}
    for i in ids:
        near = sorted((-round(product(i, j), 6), j) for j in ids if j != i)
        result[i] = [(j, -s) for s, j in near if -s >= floor][:k]
    return {i: found for i, found in result.items() if found}


def collected(df):
    result = {}
    for row in df.orderBy("invoice_idx", "rank").collect():
        assert row["rank"] == len(result.setdefault(row["invoice_idx"], [])) + 1
        result[row["invoice_idx"]].append((row["similar_idx"], row["similarity"]))
    return result


def texts_with_copies(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 40))] for _ in range(12)]
    texts = []
    for _ in range(90):
        words = list(rng.choice(bases[:3] if rng.random() < 0.5 else bases))
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        text = rng.choice([" ", "  ", "\n"]).join(words)
        texts.append(rng.choice([text, text.upper() + "."]))
    return [*texts, "", None, " \n", "!!", "solo"]


def text_product(texts):
    vectors, words_of = {}, {}
    for i, text in enumerate(texts):
        words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
        if words:
            words_of[i] = words
    distinct = {tuple(w) for w in words_of.values()}
    terms = {w: Counter([*w, *[f"{a} {b}" for a, b in zip(w, w[1:])]]) for w in distinct}
    df = Counter(t for counts in terms.values() for t in counts)
    for i, words in words_of.items():
        weights = {t: n * (1 + math.log((len(distinct) + 1) / (df[t] + 1))) for t, n in terms[tuple(words)].items()}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        vectors[i] = {t: x / norm for t, x in weights.items()}
    return list(vectors), lambda i, j: sum(x * vectors[j].get(t, 0.0) for t, x in vectors[i].items())


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("floor", [0.85, 0.5])
def test_texts_against_brute_force(spark, path, floor):
    texts = texts_with_copies(3)
    rows = [invoice(raw_text=t, fournisseur="s") for t in texts]
    got = collected(similarity.similar_texts(table(spark, rows), PATHS[path], floor=floor))
    ids, product = text_product(texts)
    expected = brute_force(ids, product, 3, floor)
    assert got == {i: [(j, round(s, 3)) for j, s in found] for i, found in expected.items()}
    assert any(len(found) == 3 for found in expected.values())


@pytest.mark.parametrize(
    "params", [AuditParams(), AuditParams(tile_rows=7), AuditParams(tile_rows=2, tile_entries=40), AuditParams(tile_rows=11, hot_min_rows=3, hot_share=0.01, salt_rows=2)]
)
@pytest.mark.parametrize("floor", [0.85, 0.3])
def test_vectors_against_brute_force(spark, params, floor):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    vectors = centres[rng.integers(0, 6, 80)] + rng.normal(scale=0.3, size=(80, 8))
    vectors[10] = vectors[20] = vectors[30] = vectors[40] = vectors[50]
    vectors[60] = 0
    vectors = vectors.astype(np.float32)
    df = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "invoice_idx long, embedding array<float>"
    )
    got = collected(similarity.similar_vectors(df, params, neighbours=4, floor=floor))
    wide = vectors.astype(float)
    ids = [i for i in range(80) if i != 60]

    def product(i, j):
        if (vectors[i] == vectors[j]).all():
            return 1.0
        return float(wide[i] @ wide[j] / np.linalg.norm(wide[i]) / np.linalg.norm(wide[j]))

    expected = brute_force(ids, product, 4, floor)
    assert set(got) - {60} == set(expected)
    for i, found in expected.items():
        assert [j for j, _ in got[i]] == [j for j, _ in found]
        assert np.allclose([s for _, s in got[i]], [s for _, s in found], atol=6e-4)


def test_rules_on_neighbours(spark):
    similar = spark.createDataFrame(
        [
            (0, "acme", 1, 7, 0.951, "bolt", 100.0),
            (1, "acme", 1, 7, 0.95, "acme", 100.0),
            (2, "acme", 1, 7, 0.95, "bolt", 100.0),
            (3, "acme", 1, 7, 0.85, "acme", 100.0),
            (4, "", 1, 7, 0.9, "unknown", 0.0),
        ],
        "invoice_idx long, supplier string, rank int, similar_idx long, similarity double, fournisseur string, total_ttc double",
    )
    found = {r["invoice_idx"]: r for r in similarity.check_semantic_duplicates(similar).collect()}
    assert {i: r["rule"] for i, r in found.items()} == {0: "semantic_duplicate", 1: "near_duplicate"}
    assert found[0]["detail"] == "Doublon semantique (sim=0.951, fournisseur=bolt, ttc=100.0)"
    assert found[1]["detail"] == "Facture tres similaire (sim=0.950)"


def test_visibility_of_tiers(spark):
    """The regex tier is not asked about, but others find it; both members of a pair are found."""
    text = "one two three four five six seven"
    rows = [
        invoice(raw_text=text, extraction_method="regex_fallback", fournisseur=None),
        invoice(raw_text=text + " eight"),
        invoice(raw_text=text),
        invoice(raw_text=None, extraction_method="vlm"),
    ]
    similar = similarity.similar_texts(table(spark, rows), replace(AuditParams(), near_similarity=0.5))
    got = collected(similar)
    assert set(got) == {1, 2}
    assert [j for j, _ in got[2]] == [0, 1] and [j for j, _ in got[1]] == [0, 2]
    assert similar.filter(F.col("similar_idx") == 0).first()["fournisseur"] == "unknown"


def test_no_texts_at_all(spark):
    rows = [invoice(raw_text=None), invoice(raw_text="  ")]
    assert collected(similarity.similar_texts(table(spark, rows))) == {}


def placed_texts(spark, texts, params):
    """The cells of the first term, and of pairs of terms, of distinct texts."""
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    vectors = similarity.text_vectors(rows, params)
    heaviest = F.max("weight").alias("heaviest")
    first = similarity._cells_with_size(similarity.term_cells(vectors, 0.85), params, heaviest)
    crowded = first.filter(F.col("rows") > params.pair_rows)
    return vectors, first, similarity._cells_with_size(similarity.pair_cells(crowded, vectors, 0.85), params)


def test_a_second_term_empties_crowded_cells(spark):
    """Texts over few words crowd every cell of one term; those of two terms stay small."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)]
    texts = list({" ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(800)})
    vectors, first, second = placed_texts(spark, texts, AuditParams(pair_rows=20))
    crowded = first.agg(F.max("rows")).first()[0]
    assert crowded > 40
    left = second.agg(F.max("rows")).first()[0]
    assert (left or 0) <= crowded / 2


def test_bounds_pass_few_pairs(spark):
    """Candidates of ordinary texts are near copies; none of those is missed."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(2_000)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(20, 200))) for _ in range(400)]
    texts += [t.replace("w1", "x", 1) for t in texts[:40]]
    texts = list(dict.fromkeys(texts))
    params = AuditParams()
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    vectors = similarity.text_vectors(rows, params)
    placed = similarity._cells_with_size(similarity.term_cells(vectors, 0.85), params, F.max("weight").alias("heaviest"))
    met = placed.select("cell", "id").join(placed.select("cell", F.col("id").alias("other")), "cell")
    met = met.filter("id < other").select("id", "other").distinct().count()
    pairs = {(r.id, r.other) for r in similarity._candidates(placed, 0.85).collect()}
    ids, product = text_product(texts)
    near = {(i, j) for i in ids for j in ids if i < j and product(i, j) >= 0.85}
    assert near <= pairs and len(pairs) <= 2 * len(near) + 5 and len(pairs) <= met


@pytest.mark.parametrize("n, tile", [(3_000, 100), (6_000, 100)])
def test_cells_of_clustered_vectors(spark, n, tile):
    """Pivots grow with the rows: cells stay near ``tile_rows`` and rows are copied to few."""
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(n // 400, 16))
    vectors = centres[rng.integers(0, len(centres), n)] + rng.normal(scale=0.02, size=(n, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vector array<double>")
    placed = similarity.pivot_cells(df, 0.95, AuditParams(tile_rows=tile))
    figures = similarity.copies_per_row(placed).first()
    assert figures.cells >= n / tile / 2 and figures.largest_cell <= 6 * tile
    assert figures.mean_copies <= 8


def test_tiles_by_entries(spark):
    """Long vectors make more tiles; the result is the same."""
    rng = random.Random(10)
    base = [f"w{rng.randrange(300)}" for _ in range(150)]
    texts = [" ".join([*base[:i], f"x{i}", *base[i:]]) for i in range(0, 150, 8)]
    rows = [invoice(raw_text=t, fournisseur="s") for t in texts]
    want = None
    for params in (AuditParams(pair_rows=2), AuditParams(pair_rows=2, tile_entries=1_000)):
        got = collected(similarity.similar_texts(table(spark, rows), params))
        assert want is None or got == want
        want = got
    assert len(want) == len(texts)


def test_spread_out_vectors_are_in_one_block_each(spark):
    """Where every cell reaches every other, no vector is written once per block that it meets."""
    rng = np.random.default_rng(4)
    n, length = 600, 16
    x = rng.normal(size=(n, length))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")
    params = AuditParams(tile_rows=50)
    blocks = similarity.vector_blocks(df, 0.3, params).collect()
    assert sorted(i for b in blocks for i in b.ids) == list(range(n))
    assert len(blocks) >= n / 50 and all(len(b.numbers) == length * len(b.ids) for b in blocks)
    assert sum(len(b.reached) for b in blocks) > len(blocks) * len({b.cell for b in blocks}) / 2
    found = {(r.id, r.other): r.similarity for r in similarity._nearest_vectors(df, 0.3, 4, params).collect()}
    expected = brute_force(range(n), lambda i, j: float(x[i] @ x[j]), 4, 0.3)
    assert {i: sorted(j for k, j in found if k == i) for i in expected} == {
        i: sorted(j for j, _ in near) for i, near in expected.items()
    }


def test_terms_are_looked_up_in_batches(spark):
    """Small batches, parts and groups of pairs change nothing; vectors leave out lonely terms."""
    texts = texts_with_copies(5)
    params = AuditParams(text_batch_rows=4, term_bucket=50, pair_group=5)
    got = collected(similarity.similar_texts(table(spark, [invoice(raw_text=t) for t in texts]), params, floor=0.5))
    ids, product = text_product(texts)
    expected = brute_force(ids, product, 3, 0.5)
    assert got == {i: [(j, round(s, 3)) for j, s in found] for i, found in expected.items()}

    rows = spark.createDataFrame([(0, "a b c"), (1, "a b d"), (2, "x y"), (3, "")], "id long, text string")
    found = {r.id: r for r in similarity.text_vectors(rows, params).collect()}
    assert set(found) == {0, 1} and len(found[0].terms) == 3  # a, b and their pair
    log = math.log(5 / 3)
    own, lonely = 3 * (1 + log) ** 2, 2 * (1 + math.log(5 / 2)) ** 2
    assert math.isclose(found[0].alone, lonely / (own + lonely))
    assert math.isclose(found[0].weights[0], (1 + log) / math.sqrt(own + lonely))


def test_an_id_that_comes_twice_is_one_text(spark):
    rows = [(0, "a b c d"), (0, "a b c d"), (1, "a b c d e"), (2, "f g h a")]
    once = spark.createDataFrame(rows[1:], "id long, text string")
    twice = spark.createDataFrame(rows, "id long, text string")
    one, two = ({r.id: r for r in similarity.text_vectors(df).collect()} for df in (once, twice))
    assert set(one) == set(two)
    assert all(one[i].terms == two[i].terms and np.allclose(one[i].weights, two[i].weights) for i in one)


def test_long_and_few_texts_are_compared_without_tiles(spark, monkeypatch):
    """Crowded cells of long texts carry no vector of their own for each row."""
    monkeypatch.setattr(similarity, "_within_tiles", lambda *_: pytest.fail("vectors copied to a cell"))
    rng = random.Random(11)
    base = [f"w{rng.randrange(300)}" for _ in range(150)]
    texts = [" ".join([*base[:i], f"x{i}", *base[i:]]) for i in range(0, 150, 15)]
    rows = [invoice(raw_text=t) for t in texts]
    got = collected(similarity.similar_texts(table(spark, rows), AuditParams(pair_rows=2)))
    ids, product = text_product(texts)
    expected = brute_force(ids, product, 3, 0.85)
    assert got == {i: [(j, round(s, 3)) for j, s in found] for i, found in expected.items()}


def near_copies(n, seed):
    """``n`` texts of 60 words, all but a few words the same, and as many other ones."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(200)}" for _ in range(60)]
    texts = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            words[rng.randrange(60)] = f"v{rng.randrange(40)}"
        texts.append(" ".join(words))
    others = [" ".join(f"w{rng.randrange(400)}" for _ in range(40)) for _ in range(n)]
    return list(dict.fromkeys(texts + others))


@pytest.mark.parametrize("tile", [10, 40, 1_000])
def test_texts_alike_are_in_one_block_each(spark, monkeypatch, tile):
    """A crowd of near copies is not written once for each cell or pair of tiles that a text is in."""
    blocks, make = [], similarity.text_blocks

    def seen(*args):
        found = make(*args)
        blocks.extend(found.select("ids", "sizes", "prefix", "terms").collect())
        return found

    monkeypatch.setattr(similarity, "text_blocks", seen)
    texts = near_copies(90, 12)
    params = AuditParams(pair_rows=20, tile_rows=tile)
    got = collected(similarity.similar_texts(table(spark, [invoice(raw_text=t) for t in texts]), params, floor=0.8))
    ids, product = text_product(texts)
    expected = brute_force(ids, product, 3, 0.8)
    assert got == {i: [(j, round(s, 3)) for j, s in found] for i, found in expected.items()}
    placed = [i for b in blocks for i in b.ids]
    assert len(placed) == len(set(placed)) >= 60
    assert all(len(b.terms) == sum(b.sizes) and len(b.ids) <= 3 * tile for b in blocks)
    assert all(0 < p <= n for b in blocks for p, n in zip(b.prefix, b.sizes))


def test_large_families_go_to_few_groups(spark):
    """A clique of 120 texts, cut into groups of pairs: each text goes to a share of them."""
    pairs = [(i, j) for i in range(120) for j in range(i + 1, 120)] + [(i, i + 1) for i in range(1_000, 1_400, 2)]
    df = spark.createDataFrame(pairs, "id long, other long")
    grouped = similarity._together(df, AuditParams(pair_group=100)).collect()
    assert sorted((r.id, r.other) for r in grouped) == sorted(pairs)
    groups = {}
    for r in grouped:
        groups.setdefault(r.id, set()).add(r.group)
        groups.setdefault(r.other, set()).add(r.group)
    # 7,140 pairs in pieces of 200: six by six, and a text is on either side
    assert max(len(groups[i]) for i in range(120)) <= 12
    assert all(len(groups[i]) == 1 for i in range(1_000, 1_400))


def test_tables_on_the_way_go(spark):
    """Texts, vectors and cells are deleted when the neighbours are found, shuffle files before."""
    folder = session.work_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    similarity.similar_texts(table(spark, [invoice(raw_text=t) for t in near_copies(40, 13)]), AuditParams(pair_rows=5))
    left = [spark.read.parquet(f"{folder}/{name}").columns for name in set(os.listdir(folder)) - before]
    assert left and not any({"contents", "terms", "group"} & set(columns) or {"cell", "id"} <= set(columns) for columns in left)

    def shuffle_files():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {b.name() for b in (manager.getAllBlocks().apply(i) for i in range(manager.getAllBlocks().size())) if b.isShuffle()}

    there = shuffle_files()
    written = session.materialise(spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count())
    assert shuffle_files() <= there
    session.discard(written)
    assert not os.path.exists(written.inputFiles()[0].removeprefix("file://"))
