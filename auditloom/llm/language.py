"""Language identification with error-correcting output codes.

Each language has a codeword of bits. One binary naive Bayes classifier over hashed
character n-grams predicts each bit of a text; its margin is calibrated on the training
texts. Decoding adds up, for each language, the logistic loss of its codeword against
the margins, bits weighted by how reliable they were in training, and takes the least.
A text whose two best languages are close is flagged as ambiguous.

Counts of n-grams are summed by Spark over a sample of ``SAMPLE_DOCS`` texts per language
(expected number, drawn by a hash), so the size of the model depends on the number of
languages and FEATURES only. Scoring is one pass without a shuffle.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.text import slices
from auditloom.session import materialise

LOG_FEATURES = 14
FEATURES = 1 << LOG_FEATURES
ORDERS = 3
SAMPLE_DOCS = 4_000
UNKNOWN = "und"
# probability of the best language below which a text counts as ambiguous
AMBIGUOUS_BELOW = 0.6
# n-grams that pull the margin of a short text to zero
SHRINK = 30.0
# up to this many languages every split into two groups gets a bit
EXHAUSTIVE = 7
_CHUNK = 1 << 20
_M1, _M2, _M3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0x2C1B3C6D)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ngram_counts(text: str | None) -> np.ndarray:
    """How often each hashed run of one to ORDERS characters occurs, case folded to lower."""
    counts = np.zeros(FEATURES, dtype=np.int64)
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    for at in range(0, len(codes), _CHUNK):
        run = codes[at : at + _CHUNK + ORDERS - 1]
        hashed = run.astype(np.uint32)
        for order in range(1, ORDERS + 1):
            if order > 1:
                if len(hashed) < 2:
                    break
                hashed = hashed[:-1] * _M1 + run[order - 1 :] * _M2
            own = hashed[:_CHUNK]
            mixed = (own ^ (own >> np.uint32(15))) * _M3
            counts += np.bincount(mixed >> np.uint32(32 - LOG_FEATURES), minlength=FEATURES)
    return counts


def codewords(languages: int) -> np.ndarray:
    """One row of 0 and 1 per language; no two rows equal, no column constant."""
    if languages <= 1:
        return np.ones((languages, 1), dtype=int)
    if languages <= EXHAUSTIVE:
        splits = range(1, 1 << (languages - 1))
        return np.array([[(s >> k) & 1 if k < languages - 1 else 0 for s in splits] for k in range(languages)])
    bits = max(15, 10 * int(np.ceil(np.log2(languages))))
    draw = np.random.default_rng(languages)
    best, best_distance = None, -1
    for _ in range(50):  # the draw whose closest two codewords are furthest apart
        code = draw.integers(0, 2, (languages, bits))
        code[0, code.sum(axis=0) == 0] = 1
        code[0, code.sum(axis=0) == languages] = 0
        gaps = (code[:, None, :] != code[None, :, :]).sum(axis=2)
        distance = gaps[~np.eye(languages, dtype=bool)].min()
        if distance > best_distance:
            best, best_distance = code, distance
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    slope: np.ndarray
    offset: np.ndarray
    trust: np.ndarray  # weight of each bit in decoding

    def raw(self, counts: np.ndarray) -> np.ndarray:
        return counts @ self.weights / (counts.sum() + SHRINK)

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        """Softmax of the negative weighted losses of the codewords."""
        margins = self.slope * self.raw(counts) + self.offset
        loss = np.logaddexp(0, -(2 * self.code - 1) * margins) @ self.trust
        p = np.exp(loss.min() - loss)
        return p / p.sum()

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, its probability, and whether another is close."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        p = self.probabilities(ngram_counts(text))
        best = int(np.argmax(p))
        return self.languages[best], float(p[best]), bool(p[best] < AMBIGUOUS_BELOW)


def training_rows(docs: DataFrame, sample_docs: int) -> DataFrame:
    """``text`` and ``lang`` of the sampled training texts."""
    rows = docs.filter("text is not null and lang is not null").select("doc_id", "text", "lang")
    # written, so that Spark knows how small it is and leaves the texts where they are
    sizes = materialise(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_003)) / 1_000_003
    return rows.join(sizes, "lang").filter(draw < sample_docs / F.col("n")).select("text", "lang")


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from ``docs`` with ``doc_id``, ``text`` and ``lang``."""
    sample = training_rows(docs, sample_docs)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if lang not in sums:
                    sums[lang] = np.zeros(FEATURES, dtype=np.int64)
                sums[lang] += ngram_counts(text)
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at), pa.array(counts[at])], ["lang", "at", "n"]
            )

    counted = sample.mapInArrow(count, "lang string, at long, n long")
    rows = counted.groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    shares = np.ones((len(languages), FEATURES))
    np.add.at(shares, (rows["lang"].map(languages.index).to_numpy(dtype=int), rows["at"].to_numpy(dtype=int)), rows["n"])
    shares /= shares.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    if len(languages) < 2:
        one = np.ones(1)
        return Model(languages, code, np.zeros((FEATURES, 1)), one, one, one)
    weights = np.stack(
        [np.log(shares[bit == 1].mean(axis=0)) - np.log(shares[bit == 0].mean(axis=0)) for bit in code.T], axis=1
    )
    bits = code.shape[1]
    model = Model(languages, code, weights, np.ones(bits), np.zeros(bits), np.ones(bits))
    _calibrate(model, sample)
    return model


def _calibrate(model: Model, sample: DataFrame) -> None:
    """Fit a logistic curve to each bit's margins on the sample, and its trust."""

    def score(batches):
        for batch in slices(batches):
            raw = [model.raw(ngram_counts(t)).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(raw, pa.list_(pa.float64()))], ["lang", "raw"]
            )

    found = sample.mapInArrow(score, "lang string, raw array<double>").toPandas()
    raw = np.stack(found["raw"].to_list())
    truth = model.code[found["lang"].map(model.languages.index).to_numpy(dtype=int)]
    for b in range(model.code.shape[1]):
        slope, offset = _logistic(raw[:, b], truth[:, b])
        error = np.mean((slope * raw[:, b] + offset > 0) != (truth[:, b] == 1))
        model.slope[b], model.offset[b] = slope, offset
        model.trust[b] = max(0.05, 1 - 2 * error)
    # as a whole the bits count as much as the languages they tell apart
    model.trust *= 2 / max(1, model.code.shape[1] ** 0.5)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 25) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton steps, slightly held back."""
    scale = np.abs(x).mean() or 1.0
    z, w = np.stack([x / scale, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + 0.5 * w
        curve = (z * (p * (1 - p))[:, None]).T @ z + 0.5 * np.eye(2)
        w = w - np.clip(np.linalg.solve(curve, gradient), -5, 5)
    return float(w[0] / scale), float(w[1])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``ambiguous`` of each row of ``docs``.

    Only the text is looked at. A null text or one without letters is ``und`` with score 0,
    as is every text when nothing could be learned. Repeated rows repeat their result;
    null doc_ids are kept, other columns left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed, see above

    def rows(batches):
        own = shared.value
        for batch in slices(batches):
            found = [own.predict(t) for t in batch.column("text").to_pylist()]
            columns = list(zip(*found)) if found else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.float64()),
                    pa.array(columns[2], pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

    schema = "doc_id long, lang_pred string, score double, ambiguous boolean"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known and not ambiguous.

    Null and empty texts and those without a letter go; long ones are judged whole. Rows
    are judged by their text alone, so that nulls elsewhere, repeated rows and further columns
    change nothing, and an empty table gives one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def rows(batches):
        own = shared.value
        for batch in slices(batches):
            found = [own.predict(t) for t in batch.column("text").to_pylist()]
            keep = pa.array([lang != UNKNOWN and not close for lang, _, close in found], pa.bool_())
            yield batch.select(names).filter(keep)

    return docs.mapInArrow(rows, docs.schema)
