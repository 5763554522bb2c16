"""Numbering, running totals, sources, sinks, summaries and the whole run."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditloom.operators import skew, summary
from auditloom.operators.running import dense_index, running_totals
from auditloom.operators.skew import hot_keys, key_counts, skewed_lookup
from auditloom.params import AuditParams
from auditloom.plans import audit
from auditloom.schema import IMAGES, OCR_BLOCKS, RESPONSES
from auditloom.sources import images, sinks, tables
from tests import models
from tests.test_rules import invoice, random_invoices, table


@pytest.mark.parametrize("partitions", [1, 8, 64])
@pytest.mark.parametrize("bucket, fan_out", [(100_000, 1000), (7, 3), (1, 2)])
def test_running_totals(spark, partitions, bucket, fan_out):
    rng = random.Random(partitions)
    values = [(i, rng.randint(0, 9), rng.randint(0, 1)) for i in range(200)]
    df = spark.createDataFrame(rng.sample(values, 200), "i long, a long, b long").repartition(partitions)
    params = AuditParams(bucket_rows=bucket, bucket_fan_out=fan_out)
    got = sorted(map(tuple, running_totals(df, "i", ["a", "b"], params).collect()))
    sums = np.cumsum([v[1:] for v in values], axis=0)
    assert got == [(i, int(a), int(b)) for i, (a, b) in enumerate(sums)]


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_dense_index(spark, partitions):
    paths = [f"p{i * 37 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(p,) for p in paths], "path string").repartition(partitions)
    got = dense_index(df, "path").orderBy("invoice_idx").collect()
    assert [(r["invoice_idx"], r["path"]) for r in got] == list(enumerate(sorted(paths)))


def test_hot_keys_and_lookup(spark):
    rows = spark.createDataFrame([("a" if i % 3 else f"k{i}", i) for i in range(90)], "k string, i long")
    params = AuditParams(hot_min_rows=5, hot_share=0.1)
    assert [r["k"] for r in hot_keys(key_counts(rows, "k"), "k", params).collect()] == ["a"]
    lookup = rows.select("k").distinct().filter("k <> 'k0'").withColumn("v", F.upper("k"))
    for p in (params, AuditParams()):
        got = sorted(map(tuple, skewed_lookup(rows, lookup, "k", p).select("k", "i", "v").collect()))
        assert got == sorted((k, i, k.upper()) for k, i in rows.collect() if k != "k0")


def test_keys_below_the_hot_limit_are_salted(spark):
    """One key holds half of what would make it hot; no task gets more than a piece of it."""
    rows = spark.range(20_000).selectExpr("if(id < 5000, -1, id % 3000) as k", "id as i").repartition(4)
    params = AuditParams(hot_min_rows=10_000, salt_rows=500, salt_slots=64)
    counts = key_counts(rows, "k")
    assert hot_keys(counts, "k", params).isEmpty()
    slots = skew.salted_slots(counts, "k", params)
    assert [r["pieces"] for r in slots.collect()] == [10]
    lookup = spark.range(-1, 2_000).selectExpr("id as k", "id * 2 as v")
    joined = skew.salted_join(rows, lookup, "k", slots, params)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = joined.filter("k = -1").groupBy(F.spark_partition_id().alias("task")).agg(F.count("i").alias("n"))
        found = tasks.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["n"] for r in found) == 5_000
    # ten pieces over 64 tasks: two may meet, most do not
    assert len(found) >= 7 and max(r["n"] for r in found) <= 3 * 600
    want = sorted((r["k"], r["i"], 2 * r["k"]) for r in rows.collect() if r["k"] < 2_000)
    for p in (params, AuditParams(hot_min_rows=1_000, hot_share=0.0, salt_rows=5, salt_slots=8)):
        got = skewed_lookup(rows, lookup, "k", p).select("k", "i", "v").collect()
        assert sorted(map(tuple, got)) == want


LISTED = ["a.jpg", "f.bmp", "g.jpeg", "h.tif", "sub/d.png", "sub/deep/e.tiff", "_x.png", ".y.png", "_d/z.png", ".h/i/j.jpg"]


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_image_listing(spark, tmp_path, scheme):
    for name in [*LISTED, "b.JPG", "c.txt", "png", "sub/jpg", "folder.png/k.gif", "none.png"]:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if name == "none.png" else b"12345")
    (tmp_path / "empty folder").mkdir()
    rows = images.find_invoice_images(spark, scheme + str(tmp_path)).collect()
    found = {r["path"].split(str(tmp_path))[1].lstrip("/"): r["length"] for r in rows}
    assert found == {name: 5 for name in LISTED} | {"none.png": 0} and len(rows) == len(found)


def test_listing_of_nothing(spark, tmp_path):
    assert images.find_invoice_images(spark, str(tmp_path)).collect() == []
    assert images.find_invoice_images(spark, str(tmp_path / "missing")).collect() == []


def test_gate_cap_and_numbering(spark):
    meta = [("d.png", 1, 50.0), ("a.png", 1, 49.9), ("c.png", 1, None), ("b.png", 1, 80.0), ("e.png", 1, 90.0)]
    df = spark.createDataFrame(meta, IMAGES)
    everything = images.kept_images(df).orderBy("invoice_idx").collect()
    assert [(r["invoice_idx"], r["image_path"]) for r in everything] == [(0, "b.png"), (1, "d.png"), (2, "e.png")]
    capped = images.kept_images(df, AuditParams(image_cap=4)).orderBy("invoice_idx").collect()
    assert [r["image_path"] for r in capped] == ["b.png", "d.png"]


def test_listing_meets_its_sharpness(spark):
    listed = spark.createDataFrame([("a.png", 1), ("b.png", 2), ("c.png", 3)], "path string, length long")
    measured = spark.createDataFrame([("a.png", 60.0), ("c.png", 10.0), ("z.png", 99.0)], "path string, sharpness double")
    met = images.with_sharpness(listed, measured)
    assert {(r["path"], r["sharpness"]) for r in met.collect()} == {("a.png", 60.0), ("b.png", None), ("c.png", 10.0)}
    assert [r["image_path"] for r in images.kept_images(met).collect()] == ["a.png"]


def test_written_inputs_are_read_back(spark, tmp_path):
    blocks = [("a.png", 0, "first", 0.5), ("a.png", 1, None, None)]
    answers = [("a.png", "vlm", 1, "{}"), ("a.png", "ocr_llm", 2, None)]
    spark.createDataFrame(blocks, OCR_BLOCKS).write.parquet(str(tmp_path / "blocks"))
    spark.createDataFrame(answers, RESPONSES).write.parquet(str(tmp_path / "answers"))
    read = tables.read_ocr_blocks(spark, str(tmp_path / "blocks"))
    assert sorted(map(tuple, read.collect()), key=str) == sorted(blocks, key=str) and read.schema == OCR_BLOCKS
    read = tables.read_responses(spark, str(tmp_path / "answers"))
    assert sorted(map(tuple, read.collect()), key=str) == sorted(answers, key=str) and read.schema == RESPONSES


def test_index_and_reports_on_disk(spark, tmp_path):
    rows = [
        invoice(fournisseur=None, raw_text=None, extraction_method="vlm"),
        invoice(fournisseur=" Ä Corp\t", total_ttc=5.0, date_facture="d", raw_text="t", lignes=[1.0, 2.0]),
        invoice(fournisseur="", extraction_method=None),
    ]
    index = sinks.index_rows(table(spark, rows))
    sinks.write_index(index, str(tmp_path / "index"))
    back = {r["id"]: r for r in spark.read.parquet(str(tmp_path / "index")).collect()}
    assert set(back) == {"inv_0", "inv_1", "inv_2"}
    one = back["inv_1"]
    assert (one["fournisseur"], one["total_ttc"], one["date"], one["nb_lignes"], one["document"]) == ("ä corp", 5.0, "d", 2, "t")
    assert (back["inv_0"]["fournisseur"], back["inv_2"]["fournisseur"], back["inv_0"]["total_ttc"]) == ("unknown", "unknown", 0.0)

    updates = spark.createDataFrame(
        [("inv_1", 1, "old"), ("inv_1", 2, "new"), ("inv_9", 1, "only")], "id string, version int, document string"
    )
    merged = sinks.upsert_index(index.select("id", "document"), sinks.last_per_id(updates, "version"))
    assert {r["id"]: r["document"] for r in merged.collect()} == {
        "inv_0": "", "inv_1": "new", "inv_2": "", "inv_9": "only",
    }
    back = {r["id"]: r for r in sinks.read_index(spark, str(tmp_path / "index")).collect()}
    assert set(back) == {"inv_0", "inv_1", "inv_2"} and list(back["inv_1"].asDict()) == index.columns
    table(spark, rows).write.parquet(str(tmp_path / "invoices"))
    assert tables.read_invoices(spark, str(tmp_path / "invoices")).count() == 3


def test_upsert_leaves_untouched_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = spark.range(500).selectExpr("concat('inv_', id) as id", "'old' as document", "id as version")
    sinks.write_index(rows.drop("version"), path, AuditParams(index_buckets=32))

    def files():
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "index").rglob("*.parquet")}

    before = files()
    assert len({f.parent for f in before}) == 32
    updates = [("inv_7", "first", 1), ("inv_7", "second", 2), ("inv_new", "third", 1)]
    records = spark.createDataFrame(updates, "id string, document string, version int")
    sinks.upsert_into(path, sinks.last_per_id(records, "version"))
    after = files()
    touched = {f.parent for f in before.keys() - after.keys()}
    assert 1 <= len(touched) <= 2
    assert {f: t for f, t in before.items() if f.parent not in touched} == {
        f: t for f, t in after.items() if f.parent not in touched
    }
    want = {f"inv_{i}": "old" for i in range(500)} | {"inv_7": "second", "inv_new": "third"}
    found = sinks.read_index(spark, path).collect()
    assert {r["id"]: r["document"] for r in found} == want and len(found) == len(want)


def test_summaries(spark):
    reports = spark.createDataFrame([("ok",), ("critical",), ("ok",)], "overall_level string")
    got = {r["overall_level"]: (r["n"], r["share"]) for r in summary.level_counts(reports).collect()}
    assert got == {"ok": (2, 2 / 3), "warning": (0, 0.0), "critical": (1, 1 / 3)}
    methods = spark.createDataFrame([("vlm",), (None,), ("",)], "extraction_method string")
    assert {r[0]: r[1] for r in summary.method_counts(methods).collect()} == {"vlm": 1, "unknown": 2}


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 10.0, 7.3], [4.0, 4.0], [float(x) for x in range(1, 101)]])
def test_histogram_like_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    rows = summary.histogram(df, "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=20)
    assert [r["n"] for r in rows] == list(counts)
    assert np.allclose([r["bin_from"] for r in rows] + [rows[-1]["bin_to"]], edges)


def test_whole_run(spark, tmp_path):
    """Images and answers to reports; the invoices seen by the rules equal the extracted ones."""
    names = [f"{i:03d}.png" for i in range(40)]
    meta = spark.createDataFrame([(n, 1, 10.0 if i % 10 == 0 else 60.0) for i, n in enumerate(names)], IMAGES)
    blocks = spark.createDataFrame(
        [(n, b, text, 0.9) for i, n in enumerate(names)
         for b, text in enumerate([f"Shop {i % 3}", f"Tea {i + 1}.50", "TOTAL 99.00"])],
        OCR_BLOCKS,
    )
    answers = spark.createDataFrame(
        [(n, "ocr_llm", 1, f'{{"fournisseur": "S", "total_ttc": {i}.5, "lignes": [{{"total_ligne": {i}}}]}}')
         for i, n in enumerate(names) if i % 4], RESPONSES,
    )
    invoices = audit.extract(meta, blocks, answers)
    rows = [r.asDict(recursive=True) for r in invoices.orderBy("invoice_idx").collect()]
    assert [r["invoice_idx"] for r in rows] == list(range(36))
    assert {r["extraction_method"] for r in rows} == {"ocr_llm", "regex_fallback"}

    result = audit.audit_invoices(invoices, params=replace(AuditParams(), forest_trees=20))
    reports = result.reports.orderBy("invoice_idx").collect()
    others = {"semantic_duplicate", "near_duplicate", "isolation_forest"}
    for got, (alerts, _) in zip(reports, models.audit(rows), strict=True):
        assert [a["rule"] for a in got["anomalies"] if a["rule"] not in others] == [rule for rule, _ in alerts]
        assert got["isolation_forest_score"] is not None
    assert sum(r["n"] for r in result.tables["level_counts"].collect()) == 36
    assert result.tables["digit_distribution"].count() == 9
    assert result.tables["score_histogram"].agg(F.sum("n")).first()[0] == 36
    sinks.write_reports(result.reports, str(tmp_path / "reports"))
    assert spark.read.parquet(str(tmp_path / "reports")).count() == 36


def test_random_invoices_through_every_rule(spark):
    rows = random_invoices(60, 11)
    result = audit.audit_invoices(table(spark, rows), params=replace(AuditParams(), forest_trees=20))
    assert result.reports.count() == 60
    order = result.reports.select(F.explode("anomalies.rule").alias("rule")).distinct().collect()
    assert {"hash_duplicate", "semantic_duplicate"} <= {r["rule"] for r in order}
