"""Plain models of the rules for small tables, one rule after the other."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd

from auditloom import fixed_values as fixed


def first_digit(amount):
    text = repr(amount)
    mantissa = text.split("e")[0]
    if mantissa.startswith("0.0"):
        return None
    digits = mantissa.replace(".", "").lstrip("0")
    return int(digits[0]) if digits else None


def benford(amounts):
    """(chi2, p) or (None, None)."""
    digits = [d for d in map(first_digit, amounts) if d]
    if len(amounts) < 50 or len(digits) < 50:
        return None, None
    n, seen = len(digits), Counter(digits)
    chi2 = sum((seen[d] - n * s) ** 2 / (n * s) for d in range(1, 10) for s in [math.log10(1 + 1 / d)])
    h = chi2 / 2
    return chi2, math.exp(-h) * sum(h**k / math.factorial(k) for k in range(4))


def line_gaps(table):
    """Invoices whose lines do not add up to the amount before tax, or else the total."""
    table = table[table.extraction_method != fixed.REGEX_FALLBACK]
    before_tax = table.total_ht.fillna(0)
    frame = pd.DataFrame(
        {
            "line_sum": [sum(t) for t in table.line_totals],
            "reference": before_tax.where(before_tax != 0, table.total_ttc),
            "lines": table.line_totals.map(len),
        },
        index=table.index,
    )
    frame = frame[(frame.lines > 0) & frame.reference.notna() & (frame.reference != 0)]
    off = (frame.line_sum - frame.reference).abs() > 0.05 * frame.reference + 0.02
    return {i: fixed.DETAIL_LINES.format(**row) for i, row in frame[off].iterrows()}


def total_gaps(table):
    full = table[table.extraction_method != fixed.REGEX_FALLBACK].dropna(
        subset=["total_ht", "tva_montant", "total_ttc"]
    )
    expected = (full.total_ht + full.tva_montant).map(lambda x: round(x, 2))
    off = expected[(expected - full.total_ttc).abs() > 0.05]
    return {i: fixed.DETAIL_TTC.format(expected_ttc=x, total_ttc=full.total_ttc[i]) for i, x in off.items()}


def text_copies(table):
    texts = table.raw_text.dropna()
    texts = texts[texts.map(lambda t: bool(t.strip()))]
    again = texts[texts.groupby(texts).cumcount() > 0]
    digest = again.map(lambda t: hashlib.sha256(t.encode()).hexdigest()[:12])
    return {i: fixed.DETAIL_HASH.format(hash=x) for i, x in digest.items()}


def unusual_amounts(table):
    amounts = defaultdict(list)  # per supplier, in order
    for i, name, amount in zip(table.index, table.fournisseur, table.total_ttc):
        if name and amount == amount:
            amounts[name.lower().strip()].append((i, amount))
    found = {}
    for own in amounts.values():
        values = np.array([x for _, x in own])
        for at in range(5, len(own)):
            mu, sigma = np.mean(values[:at]), np.std(values[:at])
            z = (values[at] - mu) / sigma if sigma > 1e-12 * abs(mu) else 0.0
            if abs(z) > 3:
                found[own[at][0]] = fixed.DETAIL_ZSCORE.format(z=z, mu=mu, sigma=sigma)
    return found


def digit_values(table):
    """p of all amounts up to and with each invoice, and the alert texts."""
    seen, values, found = [], {}, {}
    for i, total, lines in zip(table.index, table.total_ttc, table.line_totals):
        seen.extend(x for x in (total, *lines) if x == x and x is not None and x > 0)
        chi2, values[i] = benford(seen)
        if values[i] is not None and values[i] < 0.05:
            rounded = (float(np.round(chi2, 2)), float(np.round(values[i], 6)))
            found[i] = fixed.DETAIL_BENFORD.format(chi2=rounded[0], pvalue=rounded[1])
    return values, found


def audit(invoices):
    """Per invoice its (rule, detail) pairs in report order and the digit p; no similarity, no forest."""
    table = pd.DataFrame(invoices)
    for name in ("total_ht", "tva_montant", "total_ttc"):
        table[name] = table[name].astype(float)
    table["line_totals"] = [[line["total_ligne"] for line in lines] for lines in table.lignes]
    table["fournisseur"] = table.fournisseur.where(table.fournisseur.notna(), None)
    p_values, digits = digit_values(table)
    by_rule = {
        fixed.ARITHMETIC_LINES: line_gaps(table),
        fixed.ARITHMETIC_TTC: total_gaps(table),
        fixed.HASH_DUPLICATE: text_copies(table),
        fixed.ZSCORE: unusual_amounts(table),
        fixed.BENFORD: digits,
    }
    return [
        ([(rule, found[i]) for rule, found in by_rule.items() if i in found], p_values[i]) for i in table.index
    ]
