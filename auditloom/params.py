"""Every threshold of the audit, and the sizes that steer how work is split."""

from dataclasses import dataclass


@dataclass(frozen=True)
class AuditParams:
    # image and OCR gates
    min_sharpness: float = 50.0
    image_cap: int | None = None
    min_block_confidence: float = 0.3

    # arithmetic rules
    ttc_tolerance: float = 0.05
    lines_relative_tolerance: float = 0.05
    lines_absolute_tolerance: float = 0.02

    # similarity rules (applied to the similarity rounded to three places)
    semantic_similarity: float = 0.95
    near_similarity: float = 0.85
    neighbours: int = 3

    # isolation forest
    forest_min_rows: int = 10
    forest_contamination: float = 0.05
    forest_trees: int = 200
    forest_sample: int = 256
    forest_seed: int = 42
    forest_alert_below: float = -0.1

    # z-score per supplier
    zscore_min_history: int = 5
    zscore_limit: float = 3.0
    # a deviation this small against the mean is summation noise, not spread
    zscore_noise: float = 1e-12

    # first-digit law
    benford_min_amounts: int = 50
    benford_alert_below: float = 0.05
    benford_chart_min_amounts: int = 10

    # summaries
    histogram_bins: int = 20

    # --- how the work is split (changes speed, never the result) -----------------
    # rows of consecutive invoices that one running-total task handles
    bucket_rows: int = 10_000
    # range of invoice numbers in one bucket of a supplier's history
    history_bucket_rows: int = 100_000
    # bucket totals that one task of the next level handles
    bucket_fan_out: int = 1_000
    # folders of the index on disk; an index keeps the number it was written with
    index_buckets: int = 256
    # a key is hot when it holds more rows than both of these allow; at most
    # 1/hot_share keys can be hot, which bounds what is broadcast
    hot_min_rows: int = 1_000_000
    hot_share: float = 1e-4
    # rows of one key that one task joins; keys that hold more, but are not hot, are salted
    salt_rows: int = 100_000
    # hash slots of keys that are salted alike, which bounds what is broadcast for it
    salt_slots: int = 1 << 18
    # cells of up to this many rows yield candidate pairs; larger ones are cut by a second
    # shared term, and what is still larger is tiled
    pair_rows: int = 200
    # texts whose terms are looked up together, and about how many terms one task looks up
    text_batch_rows: int = 4_096
    term_bucket: int = 2_000_000
    # candidate pairs that one task compares, about
    pair_group: int = 10_000
    # rows, and entries of their vectors, per side of one similarity task
    tile_rows: int = 1_000
    tile_entries: int = 1_000_000
    # numbers in all the reference vectors that split given vectors into cells: one vector
    # per ``tile_rows`` rows up to here
    pivot_numbers: int = 8_000_000
