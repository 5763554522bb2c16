"""Row rules, duplicates, z-score and the digit law on boundary rows and random invoices."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditloom.functions.amounts import first_digit
from auditloom.functions.rounding import exact_round, fixed_text, scaled_round
from auditloom.functions.statistics import chi_square_pvalue
from auditloom.functions.text import float_text
from auditloom.operators import arithmetic, benford, duplicates, report, zscore
from auditloom.operators.facts import facts_from_invoices, facts_from_lines, line_statistics
from auditloom.params import AuditParams
from auditloom.plans import audit
from auditloom.schema import INVOICE, INVOICE_COLUMNS, enter_invoices
from tests import models

PARAMS = AuditParams()


def invoice(**values):
    row = dict.fromkeys(INVOICE_COLUMNS)
    row.update(lignes=[], extraction_method="ocr_llm")
    row.update(values)
    row["lignes"] = [
        line if isinstance(line, dict) else
        {"designation": "x", "quantite": 1.0, "prix_unitaire": line, "total_ligne": line}
        for line in row["lignes"]
    ]
    return row


def table(spark, rows, partitions=3):
    data = [{"invoice_idx": i, "image_path": f"{i}.png", **row} for i, row in enumerate(rows)]
    df = spark.createDataFrame(
        [tuple(d[f.name] for f in INVOICE.fields) for d in data], INVOICE
    )
    return enter_invoices(df.repartition(partitions))


def random_invoices(n, seed):
    rng = random.Random(seed)
    suppliers = ["Acme", " acme ", "ACME\t", "Bolt", "", None, "  ", "Cord ", "cord"]
    texts = ["", " \n", None, *[f"text {i}" for i in range(n // 4)]]
    rows = []
    for _ in range(n):
        lines = [round(rng.lognormvariate(4, 2), 2) for _ in range(rng.randint(0, 4))]
        ht = rng.choice([None, 0.0, round(float(sum(lines)), 2), round(rng.uniform(-50, 500), 2)])
        tva = rng.choice([None, round((ht or 10) * 0.2, 2)])
        ttc = rng.choice([None, 0.0, -3.5, round((ht or 0.0) + (tva or 0.0), 2), round(rng.lognormvariate(5, 1), 2)])
        if rng.random() < 0.05:
            ttc = 1e6 + rng.random()
        rows.append(
            invoice(
                fournisseur=rng.choice(suppliers), total_ht=ht, tva_montant=tva, total_ttc=ttc, lignes=lines,
                raw_text=rng.choice(texts),
                extraction_method=rng.choice(["vlm", "ocr_llm", "regex_fallback", None]),
            )
        )
    return rows


def spark_audit(spark, rows, params, partitions=3):
    invoices = table(spark, rows, partitions)
    facts = facts_from_invoices(invoices)
    running = benford.benford_running(facts, params)
    alerts = audit.rule_alerts(facts, duplicates.text_digests(invoices), running, None, None, params)
    decisions = facts.select("invoice_idx", F.lit(None).cast("double").alias("decision"))
    reports = report.build_reports(facts, alerts, running, decisions).orderBy("invoice_idx").collect()
    return reports


@pytest.mark.parametrize(
    "seed, params, partitions",
    [
        (1, PARAMS, 1),
        (2, PARAMS, 8),
        # tiny buckets and every supplier hot: the split paths have to agree
        (3, replace(PARAMS, bucket_rows=7, bucket_fan_out=3, history_bucket_rows=9, hot_min_rows=3, hot_share=0.01), 5),
    ],
)
def test_audit_agrees_with_the_model(spark, seed, params, partitions):
    rows = random_invoices(160, seed)
    expected = models.audit(rows)
    for got, (alerts, p) in zip(spark_audit(spark, rows, params, partitions), expected, strict=True):
        assert [a["rule"] for a in got["anomalies"]] == [rule for rule, _ in alerts], got
        assert [a["detail"] for a in got["anomalies"]] == [detail for _, detail in alerts]
        assert got["benford_pvalue"] == (None if p is None else pytest.approx(p, abs=1e-6))
        level = "critical" if "hash_duplicate" in dict(alerts) else "warning" if alerts else "ok"
        assert got["overall_level"] == level
        assert got["invoice_id"] == "unknown"


def found(df):
    return sorted(r["invoice_idx"] for r in df.collect())


def test_line_totals_boundaries(spark):
    rows = [
        invoice(total_ht=100.0, lignes=[105.02]),  # at the tolerance
        invoice(total_ht=100.0, lignes=[105.03]),  # 1: beyond
        invoice(total_ht=100.0, lignes=[]),
        invoice(total_ht=0.0, total_ttc=100.0, lignes=[50.0]),  # 3: HT of zero, so TTC counts
        invoice(total_ttc=0.0, lignes=[50.0]),
        invoice(lignes=[50.0]),
        invoice(total_ht=-10.0, lignes=[-10.0]),  # 6: negative tolerance
        invoice(total_ht=100.0, lignes=[50.0], extraction_method="regex_fallback"),
        invoice(total_ht=100.0, lignes=[50.0], extraction_method=None),  # 8
        invoice(total_ht=float("nan"), lignes=[50.0]),
    ]
    assert found(arithmetic.check_line_totals(facts_from_invoices(table(spark, rows)))) == [1, 3, 6, 8]


def test_total_boundaries(spark):
    rows = [
        invoice(total_ht=100.0, tva_montant=20.0, total_ttc=120.04),
        invoice(total_ht=100.0, tva_montant=20.0, total_ttc=120.06),  # 1
        invoice(total_ht=100.0, tva_montant=None, total_ttc=300.0),
        invoice(total_ht=0.0, tva_montant=0.0, total_ttc=0.06),  # 3: zero is present
        invoice(total_ht=1.0, tva_montant=1.0, total_ttc=9.0, extraction_method="regex_fallback"),
    ]
    assert found(arithmetic.check_total(facts_from_invoices(table(spark, rows)))) == [1, 3]


@pytest.mark.parametrize("history", [4, 5, 6])
def test_zscore_needs_history_and_spread(spark, history):
    varied = [invoice(fournisseur=" Acme", total_ttc=100.0 + i % 2) for i in range(history)]
    constant = [invoice(fournisseur="Bolt", total_ttc=0.1) for _ in range(history)]
    last = [invoice(fournisseur="acme\t", total_ttc=500.0), invoice(fournisseur="bolt", total_ttc=9.0)]
    alerts = found(zscore.check_zscore(facts_from_invoices(table(spark, varied + constant + last))))
    assert alerts == ([2 * history] if history >= 5 else [])


def test_one_supplier_holds_a_third(spark):
    rng = random.Random(5)
    rows = [
        invoice(fournisseur="big" if rng.random() < 0.4 else f"s{rng.randint(0, 30)}", total_ttc=rng.lognormvariate(5, 1.5))
        for _ in range(900)
    ]
    facts = facts_from_invoices(table(spark, rows))

    def history(params):
        got = zscore.supplier_history(facts, params).orderBy("invoice_idx").collect()
        return [(r["n_history"], r["mu"], r["sigma"]) for r in got]

    plain = history(PARAMS)
    split = history(replace(PARAMS, history_bucket_rows=50, hot_min_rows=100, hot_share=0.2))
    for (n, mu, sigma), (n2, mu2, sigma2) in zip(plain, split, strict=True):
        assert n == n2
        if n:
            assert (mu, sigma) == (pytest.approx(mu2, rel=1e-12), pytest.approx(sigma2, rel=1e-9, abs=1e-9))


def test_only_later_copies_are_flagged(spark):
    texts = ["a", "b", "a", " ", " ", "a ", None, "b", "a"]
    rows = [invoice(raw_text=t) for t in texts]
    digests = duplicates.text_digests(table(spark, rows, 4))
    assert found(duplicates.check_hash_duplicates(digests)) == [2, 7, 8]


def test_digits_texts_and_rounding(spark):
    rng = np.random.default_rng(7)
    values = [0.5, 0.05, 0.1, 0.099, 1e-4, 9.9e-5, 1e-5, 1e7, 1e16, 123456789.25, 0.0, -0.5, 100.0, 12345678.9, 2e-4]
    values += [float(x) for x in 10 ** rng.uniform(-6, 17, 2000)]
    values += [x / 8 for x in range(-40, 40)] + [k + 0.005 for k in range(200)] + [2.675, 342175.365, 1.005]
    rows = (
        spark.createDataFrame([(v,) for v in values], "v double")
        .select(
            "v",
            first_digit(F.col("v")).alias("digit"),
            float_text(F.col("v")).alias("text"),
            exact_round(F.col("v"), 2).alias("r2"),
            scaled_round(F.col("v"), 3).alias("s3"),
            fixed_text(F.col("v"), 2).alias("f2"),
        )
        .collect()
    )
    for row in rows:
        v = row["v"]
        assert row["digit"] == (models.first_digit(v) if v > 0 else None), v
        assert row["text"] == repr(v), v
        if abs(v) < 9e13:
            assert row["r2"] == round(v, 2), v
        assert row["s3"] == np.round(v, 3), v
        if abs(v) < 1e13 and round(v, 2) != 0:
            assert row["f2"] == f"{v:.2f}", v


def test_pvalue_at_table_values(spark):
    row = spark.range(1).select(
        chi_square_pvalue(F.lit(15.5073)).alias("a"), chi_square_pvalue(F.lit(20.0902)).alias("b")
    ).first()
    assert (round(row["a"], 4), round(row["b"], 4)) == (0.05, 0.01)


@pytest.mark.parametrize("n, tested", [(49, False), (50, True)])
def test_benford_minimum(spark, n, tested):
    rows = [invoice(total_ttc=float(i + 1)) for i in range(n)] + [invoice(total_ttc=0.05)]
    last = benford.benford_running(facts_from_invoices(table(spark, rows))).orderBy("invoice_idx").collect()[-1]
    # the amount 0.05 counts as an amount but has no first digit
    assert (last["n_amounts"], last["n_digits"]) == (n + 1, n)
    assert (last["pvalue"] is not None) == tested


def test_long_and_nested_lines_give_the_same_facts(spark):
    invoices = table(spark, random_invoices(80, 9))
    nested = facts_from_invoices(invoices)
    lines = invoices.select("invoice_idx", F.inline("lignes"))
    long = facts_from_lines(invoices, line_statistics(lines))
    rounded = lambda df: sorted(map(str, df.withColumn("line_sum", F.round("line_sum", 6)).select(sorted(df.columns)).collect()))
    assert rounded(nested) == rounded(long)
