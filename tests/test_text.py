"""OCR text assembly and the regex tier against hand-read values."""

import pytest
from pyspark.sql import functions as F

from auditloom.functions.text import is_blank, strip, supplier_key
from auditloom.operators import ocr_text, regex_tier
from auditloom.schema import OCR_BLOCKS

TEXTS = [
    "",
    " \n\t\n",
    "ACME Corp\n12/05/2024\nWidget 10.00\nGadget   20,50 \nTOTAL 30.50",
    "\n\n   Bolt & Co  \n2024-05-12 then 13.06.2024\nItem one\n   5.00\nItem two 7.25\n9.99",
    "12.05.2024",
    "a 1,234.56\nb 1.234,56\nAmount due 99.99\nCHANGE 5.00",
    "Café noir 3,50\r\nThé 2.20\r\n Gâteau 4.40\r\nSomme 10.10\r\n",
    "١٢.٥٠ riyal\nItem ٣.٢٥\nBig ٩٩.٩٩",
    "long designation " * 5 + "12.34\nshort 1.00\nmax 50.00",
    "x 1.00 y 2.00\nz 3.00 3.00\nq\n\n\n4.00\nlast 4.00",
    "\x1cfirst\x1f line\x1d 1.50\nnext odd 2.50\nbig 9.00",
    "caſh 1.00\nTäx 2.00\nTax 3.00\nrounding 4.00\nbig 9.00",
    "no newline at end 8.88",
    "trailing 1.11\n\n\n",
]


# what each of TEXTS holds, read by hand: date, amounts, supplier, lines with their amount;
# the total is the largest amount
EXPECTED = [
    (None, [], None, []),
    (None, [], None, []),
    ("12/05/2024", [10.0, 20.5, 30.5], "ACME Corp", [("Widget", 10.0), ("Gadget", 20.5)]),
    ("13.06.2024", [13.06, 5.0, 7.25, 9.99], "Bolt & Co", [("Item one", 5.0), ("Item two", 7.25)]),
    ("12.05.2024", [12.05], "12.05.2024", []),
    (None, [1.23, 4.56, 1.23, 4.56, 99.99, 5.0], "a 1,234.56", []),
    (None, [3.5, 2.2, 4.4, 10.1], "Café\xa0noir 3,50", [("Café\xa0noir", 3.5), ("Thé", 2.2), ("Gâteau", 4.4)]),
    (None, [12.5, 3.25, 99.99], "١٢.٥٠ riyal", [("Item", 3.25)]),
    # a label holds 40 characters at most
    (None, [12.34, 1.0, 50.0], "long designation " * 5 + "12.34", [("nation long designation long designation", 12.34), ("short", 1.0)]),
    (None, [1.0, 2.0, 3.0, 3.0, 4.0, 4.0], "x 1.00 y 2.00", [("x 1.00 y", 2.0), ("z 3.00", 3.0)]),
    (None, [1.5, 2.5, 9.0], "first\x1f line\x1d 1.50", [("first\x1f line", 1.5), ("next\u2028odd", 2.5)]),
    # a long s counts as an s, so the first label is no line; neither are tax and rounding
    (None, [1.0, 2.0, 3.0, 4.0, 9.0], "caſh 1.00", [("Täx", 2.0)]),
    # the largest amount is no line
    (None, [8.88], "no newline at end 8.88", []),
    (None, [1.11], "trailing 1.11", []),
]


def test_regex_tier_reads_what_stands_there(spark):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "n int, t string").withColumn(
        "total", regex_tier.largest_amount(F.col("t"))
    )
    rows = texts.select(
        "n",
        regex_tier.amounts(F.col("t")).alias("amounts"),
        regex_tier.regex_invoice(F.col("t"), F.lit(0.5), F.col("total")).alias("i"),
    ).collect()
    for row in rows:
        date, values, supplier, lines = EXPECTED[row["n"]]
        total, lines = max(values, default=None), [(label, 1.0, x, x) for label, x in lines]
        got = row["i"]
        assert row["amounts"] == values, TEXTS[row["n"]]
        assert (got["date_facture"], got["total_ttc"], got["fournisseur"]) == (date, total, supplier)
        assert [tuple(x) for x in got["lignes"]] == lines, TEXTS[row["n"]]
        assert (got["extraction_method"], got["raw_text"]) == ("regex_fallback", TEXTS[row["n"]])


def test_strip_blank_and_key(spark):
    texts = [" a ", "\t\n", "", None, "\x1f Élan ", "A b"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        strip(F.col("t")), is_blank(F.col("t")), supplier_key(F.col("t"))
    )
    for text, (stripped, blank, key) in zip(texts, rows.collect()):
        assert stripped == (None if text is None else text.strip())
        assert blank == (not (text or "").strip())
        assert key == (None if text is None else text.lower().strip())


@pytest.mark.parametrize("partitions", [1, 8])
def test_blocks_are_gated_and_ordered(spark, partitions):
    blocks = [
        ("a", 2, "third", 0.9), ("a", 0, "first", 0.3), ("a", 1, "dropped", 0.29), ("a", 10, "last", 0.31),
        ("b", 0, "unsure", 0.1),
    ]
    images = spark.createDataFrame([("a",), ("b",), ("c",)], "image_path string")
    table = spark.createDataFrame(blocks, OCR_BLOCKS).repartition(partitions)
    rows = {r["image_path"]: r for r in ocr_text.text_of_images(images, table).collect()}
    assert (rows["a"]["full_text"], rows["a"]["avg_confidence"]) == ("first\nthird\nlast", 0.503)
    for name in "bc":
        assert (rows[name]["full_text"], rows[name]["avg_confidence"]) == ("", 0.0)
