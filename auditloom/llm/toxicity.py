"""Toxicity scores by a factorization machine over hashed terms.

A text's terms are its different words, lower-cased and hashed. The machine adds to a
linear weight per term the product of two terms' factors, for each pair of terms in the
text, so that a term can count only in company. It is trained in one task on at most
``SAMPLE_DOCS`` labelled texts of either label, weighted so that both labels keep the
shares they have among all labelled rows. Terms of fewer than ``LEAST_TEXTS`` of the sampled
texts get no weight, whatever the size of the sample. A term counts as much as the sampled
labels differ with it (log ratio of its shares among either label), so that the many rare
terms that say nothing do not fit the labels in place of those that do.

Such a measure cannot see terms that tell nothing alone but something together. So what is
left to explain after the first training is added up per pair of terms; the terms of pairs
whose sum is beyond ``LEAST_Z`` deviations, more than chance gives among all pairs, enter a
second set of weights and factors at full value, which is trained on top. Scoring is one pass
without a shuffle.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.folds import labelled_sample

LOG_TERMS = 17
FACTORS = 6
SAMPLE_DOCS = 8_000
LEAST_TEXTS = 4
EPOCHS = 6
BATCH = 64
RATE = 0.3
# pull of weights and of factors to zero, and the smaller step of the factors
DECAY, FACTOR_DECAY, FACTOR_STEP = 5e-2, 5e-2, 0.1
# the second training: epochs, steps, first size of the factors and pull to zero
PAIR_EPOCHS, PAIR_RATE, PAIR_START, PAIR_DECAY = 12, 0.1, 0.3, 1e-3
# texts and deviations that make a pair of terms count
LEAST_PAIRS, LEAST_Z = 8, 6.0
# pairs that are looked at, in texts of the sample drawn by chance, and terms of such a text
MOST_PAIRS, PAIR_TERMS = 60_000_000, 2_048
LOG_PAIRS = 22
SEED = 42
_WORD = re.compile(r"[^\W_]+")


def terms(text: str | None) -> np.ndarray:
    """Sorted hashes of the different words of a text."""
    found = {w for w in _WORD.findall((text or "").lower())}
    digest, shift = xxhash.xxh3_64_intdigest, 64 - LOG_TERMS
    return np.unique(np.fromiter((digest(w) >> shift for w in found), dtype=np.int32, count=len(found)))


@dataclass
class Model:
    """Weights and factors as they enter the sums, multiplied by what their term counts."""

    bias: float
    weights: np.ndarray  # terms
    factors: np.ndarray  # terms x factors of both trainings

    def score(self, at: np.ndarray) -> float:
        v = self.factors[at]
        pairs = 0.5 * float((v.sum(axis=0) ** 2).sum() - (v**2).sum())
        z = self.bias + float(self.weights[at].sum()) + pairs
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class _Part:
    """Weights and factors of one training, by Adagrad, and what each term counts in it."""

    def __init__(self, value: np.ndarray, start: float, draw: np.random.Generator) -> None:
        size = len(value)
        self.value, self.weights = value, np.zeros(size)
        self.factors = draw.normal(0, start, (size, FACTORS))
        self.w_past, self.v_past = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2)

    def margins(self, at: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, tuple]:
        x = self.value[at]
        vx = self.factors[at] * x[:, None]
        total = np.add.reduceat(vx, begin)
        pairs = 0.5 * ((total**2).sum(axis=1) - np.add.reduceat((vx**2).sum(axis=1), begin))
        return np.add.reduceat(self.weights[at] * x, begin) + pairs, (x, vx, total)

    def step(self, at, lengths, error, seen, rates: tuple[float, float], decays: tuple[float, float]) -> None:
        x, vx, total = seen
        per_term = np.repeat(error, lengths) * x
        used, inverse = np.unique(at, return_inverse=True)
        g_w = np.bincount(inverse, per_term) + decays[0] * self.weights[used]
        g_v = np.stack(
            [
                np.bincount(inverse, per_term * (np.repeat(total[:, f], lengths) - vx[:, f]))
                for f in range(FACTORS)
            ],
            axis=1,
        )
        g_v = np.clip(g_v + decays[1] * self.factors[used], -1, 1)
        self.w_past[used] += g_w**2
        self.v_past[used] += g_v**2
        self.weights[used] -= rates[0] * g_w / np.sqrt(self.w_past[used])
        self.factors[used] -= rates[1] * g_v / np.sqrt(self.v_past[used])


def _batches(rows: list[np.ndarray], order: np.ndarray):
    """Runs of rows with any term: their numbers, terms, lengths and beginnings."""
    for start in range(0, len(order), BATCH):
        batch = [i for i in order[start : start + BATCH] if len(rows[i])]
        if batch:
            lengths = np.array([len(rows[i]) for i in batch])
            yield batch, np.concatenate([rows[i] for i in batch]), lengths, np.cumsum(lengths) - lengths


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _margins_of_rows(rows: list[np.ndarray], bias: float, part: _Part) -> np.ndarray:
    found = np.full(len(rows), bias)
    for batch, at, _, begin in _batches(rows, np.arange(len(rows))):
        found[batch] += part.margins(at, begin)[0]
    return found


def telling_pairs(rows: list[np.ndarray], left: np.ndarray, variance: np.ndarray) -> np.ndarray:
    """Pairs of terms, a row each, whose texts have more left to explain than chance gives.

    ``left`` is label minus chance per row. Sums are kept per hash of a pair; pairs whose hash
    stands out are added up once more by themselves.
    """
    size = 1 << LOG_PAIRS
    n_pairs = np.array([len(r) * (len(r) - 1) // 2 if len(r) <= PAIR_TERMS else 0 for r in rows])
    order = np.random.default_rng(SEED).permutation(len(rows))
    taken = order[np.cumsum(n_pairs[order]) <= MOST_PAIRS]
    taken = np.sort(taken[n_pairs[taken] > 0]).tolist()

    def pairs():
        """Terms, hash and row of all pairs, some rows at a time."""
        gathered, n = [], 0
        for k in taken:
            r = rows[k]
            i, j = np.triu_indices(len(r), 1)
            gathered.append((r[i], r[j], np.full(len(i), k)))
            n += len(i)
            if n > 4_000_000 or k == taken[-1]:
                a, b, row = (np.concatenate(c) for c in zip(*gathered))
                yield a, b, (a.astype(np.int64) * 2_654_435_761 + b.astype(np.int64) * 40_503) % size, row
                gathered, n = [], 0

    sums, spread, texts = np.zeros(size), np.zeros(size), np.zeros(size)
    for _, _, at, row in pairs():
        sums += np.bincount(at, left[row], size)
        spread += np.bincount(at, variance[row], size)
        texts += np.bincount(at, minlength=size)
    loud = (texts >= LEAST_PAIRS) & (np.abs(sums) >= LEAST_Z * np.sqrt(spread))
    found = [np.zeros((0, 3), dtype=np.int64)]
    for a, b, at, row in pairs():
        own = loud[at]
        found.append(np.stack([a[own], b[own], row[own]], axis=1).astype(np.int64))
    met = np.concatenate(found)
    both, inverse, n = np.unique(met[:, :2], axis=0, return_inverse=True, return_counts=True)
    inverse = inverse.ravel()
    z = np.abs(np.bincount(inverse, left[met[:, 2]], len(both)))
    deviation = np.sqrt(np.bincount(inverse, variance[met[:, 2]], len(both)))
    return both[(n >= LEAST_PAIRS) & (z >= LEAST_Z * deviation)]


def fit(rows: list[np.ndarray], labels: np.ndarray, row_weights: np.ndarray) -> Model:
    """Train on the logistic loss, then once more on the terms of pairs that tell what is left."""
    size, draw = 1 << LOG_TERMS, np.random.default_rng(SEED)
    share = np.average(labels, weights=row_weights) if len(rows) else 0.0
    share = min(max(share, 1e-6), 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    if not len(rows) or labels.min() == labels.max():
        return Model(bias, np.zeros(size), np.zeros((size, 2 * FACTORS)))
    every = np.concatenate(rows)
    seen = np.bincount(every, minlength=size)
    # one for terms in less than a twentieth of the texts, down to zero for terms in all
    rarity = np.clip(np.log((1 + len(rows)) / (1 + seen)) / np.log(20), 0, 1)
    toxic = np.bincount(every, np.repeat(labels, [len(r) for r in rows]), size)
    among_toxic = (1 + toxic) / (2 + np.sum(labels))
    among_clean = (1 + seen - toxic) / (2 + len(rows) - np.sum(labels))
    told = np.abs(np.log(among_toxic / among_clean))
    first = _Part(np.where(seen >= LEAST_TEXTS, rarity * told, 0.0), 0.02, draw)
    kept = [r[first.value[r] > 0] for r in rows]
    for _ in range(EPOCHS):
        for batch, at, lengths, begin in _batches(kept, draw.permutation(len(kept))):
            z, state = first.margins(at, begin)
            error = (_chance(bias + z) - labels[batch]) * row_weights[batch]
            first.step(at, lengths, error, state, (RATE, FACTOR_STEP * RATE), (DECAY, FACTOR_DECAY))
            bias -= 0.01 * float(error.mean())
    base = _margins_of_rows(kept, 0.0, first)
    p = _chance(bias + base)
    told_by_pairs = telling_pairs(
        [r[(seen[r] >= LEAST_TEXTS) & (rarity[r] > 0)] for r in rows],
        (labels - p) * row_weights,
        (p * (1 - p) + 1e-3) * row_weights**2,
    )
    value = np.zeros(size)
    value[np.unique(told_by_pairs)] = 1.0
    second = _Part(value, PAIR_START, draw)
    paired = [r[value[r] > 0] for r in rows]
    for _ in range(PAIR_EPOCHS if len(told_by_pairs) else 0):
        # rows without such a term hold the bias in place
        for batch, at, lengths, begin in _batches(paired, draw.permutation(len(paired))):
            z, state = second.margins(at, begin)
            error = (_chance(bias + base[batch] + z) - labels[batch]) * row_weights[batch]
            second.step(at, lengths, error, state, (PAIR_RATE, PAIR_RATE), (PAIR_DECAY, PAIR_DECAY))
        error = (_chance(bias + base + _margins_of_rows(paired, 0.0, second)) - labels) * row_weights
        bias -= 0.5 * float(error.mean()) / max(float((row_weights * p * (1 - p)).mean()), 1e-3)
    weights = first.weights * first.value + second.weights * second.value
    factors = np.concatenate([first.factors * first.value[:, None], second.factors * value[:, None]], axis=1)
    return Model(bias, weights, factors)


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from the texts of ``docs`` whose doc_id ``labels`` marks with toxic 0 or 1."""
    # at most 2 x sample_docs narrow rows
    sample = F.broadcast(labelled_sample(labels, "toxic", sample_docs))

    def extract(batches):
        for batch in batches:
            found = [terms(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("weight"), pa.array(found, pa.list_(pa.int32()))],
                ["label", "weight", "terms"],
            )

    def learn(batches):
        rows, labels, weights = [], [], []
        for batch in batches:
            rows += [np.asarray(t, dtype=np.int32) for t in batch.column("terms").to_pylist()]
            labels += batch.column("label").to_pylist()
            weights += batch.column("weight").to_pylist()
        order = sorted(range(len(rows)), key=lambda i: (labels[i], rows[i].tobytes()))
        weights = np.array([weights[i] for i in order])
        model = fit(
            [rows[i] for i in order],
            np.array([labels[i] for i in order], dtype=float),
            weights / weights.mean() if len(weights) else weights,
        )
        parts = [np.array([model.bias]), model.weights, model.factors]
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(range(3), pa.int32()), "data": [x.astype("<f8").tobytes() for x in parts]}
        )

    labelled = docs.select("doc_id", "text").join(sample, "doc_id")
    extracted = labelled.mapInArrow(extract, "label int, weight double, terms array<int>")
    # one task learns from the bounded sample
    learned = extracted.repartition(1).mapInArrow(learn, "part int, data binary").collect()
    bias, weights, factors = (np.frombuffer(r.data, "<f8") for r in sorted(learned))
    return Model(float(bias[0]), weights, factors.reshape(-1, 2 * FACTORS))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of each row of ``docs``.

    Only the text is looked at; null and empty texts get the score of no terms at all,
    the share of toxic labels. Repeated rows repeat their result, null doc_ids are kept,
    other columns left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^LOG_TERMS x (2 FACTORS + 1)

    def rows(batches):
        own = shared.value
        for batch in batches:
            found = np.array([own.score(terms(t)) for t in batch.column("text").to_pylist()], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, score double, predicted int")
