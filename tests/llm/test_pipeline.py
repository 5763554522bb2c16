"""The five stages one after the other, each against what its operator finds."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from auditloom.llm import decontaminate, secrets, simhash
from auditloom.llm.queries import QUERIES
from auditloom.session import materialise
from tests.llm import cases


@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.01"  # the smallest table has no secret


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    """What goes into each stage, and the result of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(materialise(stage(spark, tables[-1], sf_dir)))
    return tables


def ids(table):
    return {r.doc_id for r in table.select("doc_id").collect()}


def test_stages_keep_the_columns_of_documents(kept):
    for table in kept[1:-1]:
        assert table.dtypes == kept[0].dtypes
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "SimHash near-dedup", "benchmark decontamination", "secret scans", "packing"
    ]


def test_clean_documents_stay(kept):
    before, after = kept[0], kept[1]
    assert after.count() >= 0.98 * before.count()
    groups = simhash.near_duplicates(kept[1]).collect()
    assert ids(kept[2]) == {r.component_id for r in groups}


def test_leaks_go_and_nothing_else(spark, sf_dir, kept):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = ids(decontaminate.find_leaks(kept[2], benchmark))
    assert leaks and ids(kept[3]) == ids(kept[2]) - leaks
    assert decontaminate.find_leaks(kept[3], benchmark).isEmpty()


def test_only_rows_that_hold_an_item_go(spark):
    draw = random.Random(6)
    item, clean, other = (cases.sentence(draw, 60) for _ in range(3))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, item), (None, clean), (7, "ahead " + item), (7, other), (8, None), (None, None), (9, clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = decontaminate.without_leaks(docs, benchmark)
    want = [(None, clean), (7, other), (8, None), (None, None), (9, clean)]
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=str) == sorted(want, key=str)


def test_secrets_are_gone_and_documents_are_not(kept):
    assert ids(kept[4]) == ids(kept[3])
    model = secrets.train(kept[3].select("text"))
    had = secrets.find_secrets(kept[3], model).filter("size(spans) > 0")
    assert not had.isEmpty()
    left = secrets.find_secrets(kept[4], model).filter(F.exists("spans", lambda s: ~s["value"].contains("SECRET")))
    assert left.isEmpty()
    assert kept[4].filter("n_chars <> length(text)").isEmpty()


def test_everything_left_is_packed(kept):
    pieces = kept[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("d"))
    assert ids(pieces) == ids(kept[4]) and pieces.filter("n <> d").isEmpty()


def test_run_applies_the_stages(spark, sf_dir, kept):
    of_documents = lambda pieces: sorted(map(tuple, pieces.select("doc_id", "doc_tokens").distinct().collect()))
    assert of_documents(corpus_pipeline.run(spark, sf_dir)) == of_documents(kept[5])


def test_odd_and_empty_tables(spark, tmp_path):
    passage = cases.messy_rows()[7][1]
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (cases.messy(spark), cases.empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, str(tmp_path)))
        left = ids(docs)
        assert not left & {0, 1, 2, 3, 7, 8, 9, None}


def test_python_tasks_get_small_batches(spark, tmp_path):
    import pyarrow as pa

    key, most = "spark.sql.execution.arrow.maxBytesPerBatch", corpus_pipeline.BATCH_BYTES
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = spark.range(0, 8_000, 1, 1).selectExpr("id", "repeat('x', 2000) as text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset(key)
        stage(spark, cases.empty(spark), str(tmp_path))
        if name != "secret scans":  # expressions only
            found = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
            assert sum(found) > 3 * most and max(found) <= most + 10_000, name


def test_queries_are_registered():
    registered = entry_point.queries()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(registered)
