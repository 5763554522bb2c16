"""The flagship and its summaries hold all eight rules; copies and outliers by brute force.

The SQL of the registered queries is compared in test_oracles.
"""

import math
from collections import Counter

import pytest

from auditloom import fixed_values as fixed
from auditloom.operators import forest, report
from auditloom.plans.registered import PARAMS, QUERIES
from auditloom.session import materialise
from auditloom.sources import star_schema as star
from tests.test_similarity import brute_force, text_product

OTHERS = {fixed.SEMANTIC_DUPLICATE, fixed.NEAR_DUPLICATE, fixed.ISOLATION_FOREST}


@pytest.fixture(scope="module")
def reports(spark, sf_dir):
    rows = QUERIES["audit_report"](spark, sf_dir).collect()
    return {r.invoice_idx: r.asDict() | {"rules": [x for x in r.rules.split(",") if x]} for r in rows}


def test_copies_by_brute_force(spark, sf_dir, reports):
    rows = star.nested_invoices(spark, sf_dir).select("invoice_idx", "raw_text", "extraction_method").collect()
    rows = [r for r in rows if r.raw_text]
    rows.sort(key=lambda r: r.invoice_idx)
    ids, product = text_product([r.raw_text for r in rows])
    want = Counter()
    for i, near in brute_force(ids, product, 3, PARAMS.near_similarity).items():
        if rows[i].extraction_method == fixed.REGEX_FALLBACK:  # is found, but not asked about
            continue
        want[rows[i].invoice_idx] += sum(round(s, 3) > PARAMS.semantic_similarity for _, s in near)
    got = {i: n for i, r in reports.items() if (n := r["rules"].count(fixed.SEMANTIC_DUPLICATE))}
    assert got == {i: n for i, n in want.items() if n} and got


def test_outliers_of_the_forest(spark, sf_dir, reports):
    decisions = forest.fit_decisions(materialise(star.invoice_facts(spark, sf_dir)), PARAMS).collect()
    want = {r.invoice_idx for r in decisions if r.decision < PARAMS.forest_alert_below}
    assert want == {i for i, r in reports.items() if fixed.ISOLATION_FOREST in r["rules"]} and want


def test_summaries_and_prompts_follow_the_reports(spark, sf_dir, reports):
    flagged = {i for i, r in reports.items() if r["rules"]}
    assert any(set(reports[i]["rules"]) <= OTHERS for i in flagged)
    told = {r.invoice_idx: r.alerts for r in QUERIES["alert_text"](spark, sf_dir).collect()}
    assert set(told) == flagged
    for i, text in told.items():
        assert [line.split("] ")[1].split(":")[0] for line in text.split("\n")] == reports[i]["rules"]
    prompts = {r.invoice_idx: r.prompt for r in QUERIES["fraud_requests"](spark, sf_dir).collect()}
    assert set(prompts) == flagged and all(told[i] in p for i, p in prompts.items())
    levels = Counter(r["overall_level"] for r in reports.values())
    counts = QUERIES["level_counts"](spark, sf_dir).collect()
    assert {r.overall_level: r.n for r in counts if r.n} == levels
    assert all(math.isclose(r.share, r.n / len(reports), abs_tol=1e-8) for r in counts)
    [first] = QUERIES["first_report"](spark, sf_dir).collect()
    assert first.invoice_idx == min(flagged) and first.rules.split(",") == reports[first.invoice_idx]["rules"]


def test_newest_answer_decides(spark):
    said = [(1, 1, "DECISION: BLOCK - a"), (1, 10, "x\n DECISION: APPROVE - b "), (1, 2, None), (2, 1, "only"), (3, 5, None)]
    attempts = spark.createDataFrame(said, "invoice_idx long, attempt int, raw string").repartition(3)
    found = {r.invoice_idx: r.llm_decision for r in report.verdicts(attempts).collect()}
    assert found == {1: "DECISION: APPROVE - b", 2: "only", 3: None}


def test_verdicts_of_the_report(spark, sf_dir, reports):
    """Only invoices with alerts have one, that of the last turn of their dialogue."""
    last = {}
    for r in star.verdict_answers(spark, sf_dir).collect():
        last[r.invoice_idx] = max(last.get(r.invoice_idx, (-1, "")), (r.attempt, r.raw))
    for i, row in reports.items():
        assert (row["llm_decision"] is not None) == (i in last and bool(row["rules"]))
        if row["llm_decision"] and last[i][1].startswith("DECISION"):
            assert row["llm_decision"] in last[i][1]
    assert any(row["llm_decision"] for row in reports.values())
