"""Quality scores by co-training a text view and a metadata view.

The text view sees what a text is made of: shares of kinds of characters, lengths,
repetition, and hashed pairs of characters. The metadata view sees where it comes from:
source, language, declared length, and the address and size of the web page that its
doc_id stands in. Each view has a logistic classifier. Over ``ROUNDS`` rounds each gives
the unlabelled texts it is surest of, with its own label, to the training rows of the
other. Both are then calibrated on labelled rows that neither was trained on, and a
third logistic curve over the two calibrated scores combines them.

Training uses at most ``SAMPLE_DOCS`` labelled rows of either label and as many without
a label, in one task. All documents are scored: the text where it lies, the metadata
after a join of narrow rows.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.folds import labelled_sample

SAMPLE_DOCS = 4_000
ROUNDS = 4
# share of the unlabelled rows given on per round, and the least sureness
GIVEN, SURE = 0.05, 0.9
PAIRS, PLACES = 256, 128
_SHAPES = 14
RIDGE = 1.0


def text_view(text: str | None) -> np.ndarray:
    """Measures of a whole text and its hashed character pairs."""
    text = text or ""
    found = np.zeros(_SHAPES + PAIRS, dtype=np.float32)
    words, codes = text.split(), np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not words:
        return found
    n, k = len(codes), len(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=k)
    lines = text.split("\n")
    letter = ((codes | 32) - 97 < 26) | (codes >= 0xC0)
    digit, space = codes - 48 < 10, codes <= 32
    sign = ~(letter | digit | space)
    same = sum(a == b for a, b in zip(words, words[1:]))
    found[:_SHAPES] = (
        np.log1p(k), lengths.mean() / 10, lengths.std() / 10, letter.mean(), digit.mean(), sign.mean(),
        space.mean(), len(set(words)) / k, same / k, len(set(lines)) / len(lines), k / len(lines) / 100,
        (lengths <= 3).mean(), np.mean([w[-1] in ".!?" for w in words]), np.mean([not w[-1].isalnum() for w in words]),
    )
    if n > 1:
        hashed = (codes[:-1].astype(np.uint32) * np.uint32(0x9E3779B1) + codes[1:]) * np.uint32(0x85EBCA77)
        pairs = np.bincount(hashed >> np.uint32(24), minlength=PAIRS)
        found[_SHAPES:] = np.sqrt(pairs / (n - 1))
    return found


def metadata_view(source, lang, n_chars, url, page_chars) -> np.ndarray:
    """Hashed places a text comes from, and sizes; nulls are places of their own."""
    found = np.zeros(PLACES + 4, dtype=np.float32)
    scheme, _, rest = (url or "").partition("://")
    host, _, path = rest.partition("/")
    tail = "".join(c for c in path[-12:] if not c.isdigit())
    for kind, value in enumerate((source, lang, scheme, host, tail, path.count("/"))):
        found[xxhash.xxh3_64_intdigest(f"{kind}:{value}") % PLACES] = 1
    chars = np.log1p(max(n_chars or 0, 0))
    found[PLACES:] = (chars / 10, (chars / 10) ** 2, url is not None, np.log1p(page_chars or 0) / 10)
    return found


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE, steps: int = 20) -> np.ndarray:
    """Weights of a logistic regression, the last one constant, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class Model:
    text: np.ndarray
    metadata: np.ndarray
    text_curve: np.ndarray
    metadata_curve: np.ndarray
    together: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.text, self.metadata, self.text_curve, self.metadata_curve, self.together]


def co_train(
    views: tuple[np.ndarray, np.ndarray], labels: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS
) -> Model:
    """Train on rows whose label is 0 or 1, with pseudo-labels for those whose label is -1."""
    known = np.flatnonzero(labels >= 0)
    calibration, base = known[::3], np.setdiff1d(known, known[::3])
    free = np.flatnonzero(labels < 0)
    share = float(np.average(labels[base] == 1, weights=weight[base])) if len(base) else 0.5
    given = [{}, {}]  # of each view's training rows: row -> pseudo-label

    def fit(view: int) -> np.ndarray:
        extra = np.array(sorted(given[view]), dtype=int)
        rows = np.concatenate([base, extra])
        y = np.concatenate([labels[base], [given[view][i] for i in extra]]).astype(float)
        # all pseudo-labels together count as much as half the labelled rows at most
        w = np.concatenate([weight[base], np.full(len(extra), min(1.0, 0.5 * len(base) / max(1, len(extra))))])
        return _logistic(views[view][rows], y, w)

    models = [fit(0), fit(1)]
    for _ in range(rounds):
        for view in (0, 1):
            p = 1 / (1 + np.exp(-np.clip(_margin(views[view][free], models[view]), -30, 30)))
            for label, sure, part in ((1, p, share), (0, 1 - p, 1 - share)):
                most = int(np.ceil(GIVEN * len(free) * part))
                for i in np.argsort(-sure, kind="stable")[:most]:
                    if sure[i] >= SURE:
                        given[1 - view].setdefault(int(free[i]), label)
        models = [fit(0), fit(1)]
    y, w = labels[calibration].astype(float), weight[calibration]
    curves = [
        _logistic(_margin(views[v][calibration], models[v])[:, None], y, w, 0.01) for v in (0, 1)
    ]
    scores = np.column_stack(
        [_margin(_margin(views[v][calibration], models[v])[:, None], curves[v]) for v in (0, 1)]
    )
    return Model(*models, *curves, _logistic(scores, y, w, 0.01))


def _pages(pages: DataFrame | None, docs: DataFrame) -> DataFrame:
    """Address and size of the first page of each doc_id, the last number in its path."""
    if pages is None:
        empty = "doc_id long, url string, page_chars long"
        return docs.sparkSession.createDataFrame([], empty)
    named = pages.select(
        F.expr("try_cast(regexp_extract(url, '/([0-9]+)(?:[./?#][^0-9]*|$)', 1) as bigint)").alias("doc_id"),
        F.struct("page_id", "url", F.length("html").cast("long").alias("page_chars")).alias("page"),
    ).filter("doc_id is not null")
    return named.groupBy("doc_id").agg(F.min("page").alias("page")).select("doc_id", "page.url", "page.page_chars")


_META = ("source", "lang", "n_chars", "url", "page_chars")


def train(docs: DataFrame, labels: DataFrame, pages: DataFrame | None = None, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from the documents that ``labels`` marks with quality 0 or 1, and from others."""
    known = labelled_sample(labels, "quality", sample_docs)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(1_000_003)) / 1_000_003
    total = max(1, docs.count())
    drawn = docs.select("doc_id", draw.alias("draw")).filter(F.col("draw") < 4.0 * sample_docs / total)
    free = (
        drawn.join(labels.select("doc_id"), "doc_id", "left_anti")
        .orderBy("draw", "doc_id")
        .limit(2 * sample_docs)
        .selectExpr("doc_id", "-1 as label", "1.0D as weight")
    )
    # at most 4 x sample_docs narrow rows
    sample = F.broadcast(known.unionByName(free))
    rows = docs.select("doc_id", "text", "source", "lang", "n_chars").join(sample, "doc_id")
    rows = rows.join(_pages(pages, docs), "doc_id", "left")

    def extract(batches):
        for batch in batches:
            text = [text_view(t) for t in batch.column("text").to_pylist()]
            meta = [metadata_view(*x) for x in zip(*(batch.column(c).to_pylist() for c in _META))]
            columns = [pa.array(v, pa.list_(pa.float32())) for v in (text, meta)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), batch.column("weight"), *columns],
                ["doc_id", "label", "weight", "text", "metadata"],
            )

    def learn(batches):
        parts = [b.to_pydict() for b in batches if b.num_rows]
        whole = {k: [x for p in parts for x in p[k]] for k in ("doc_id", "label", "weight", "text", "metadata")}
        order = np.argsort(np.array(whole["doc_id"], dtype=np.int64), kind="stable")
        views = tuple(
            np.array(whole[v], dtype=np.float32).reshape(len(order), size)[order]
            for v, size in (("text", _SHAPES + PAIRS), ("metadata", PLACES + 4))
        )
        label, weight = np.array(whole["label"], dtype=int)[order], np.array(whole["weight"])[order]
        weight = np.where(label < 0, 1.0, weight / weight[label >= 0].mean() if (label >= 0).any() else 1.0)
        model = co_train(views, label, weight)
        data = [x.astype("<f8").tobytes() for x in model.parts()]
        yield pa.RecordBatch.from_pydict({"part": pa.array(range(len(data)), pa.int32()), "data": data})

    schema = "doc_id long, label int, weight double, text array<float>, metadata array<float>"
    # one task learns from the bounded sample
    learned = rows.mapInArrow(extract, schema).repartition(1).mapInArrow(learn, "part int, data binary")
    return Model(*(np.frombuffer(r.data, "<f8") for r in sorted(learned.collect())))


def score(docs: DataFrame, model: Model, pages: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``text_score``, ``metadata_score``, ``score`` and ``keep`` of each row.

    Scores are probabilities of quality 1; ``keep`` is score >= 0.5. Null and empty texts
    have measures of zero, null metadata counts as a value of its own, and documents
    without a page as such. Repeated rows repeat their result, null doc_ids are kept,
    other columns left out. Without labels of both kinds all scores follow the labels.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def by_text(batches):
        own = shared.value
        for batch in batches:
            found = [float(_margin(text_view(t), own.text)) for t in batch.column("text").to_pylist()]
            names = ["doc_id", "source", "lang", "n_chars"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(found, pa.float64())], [*names, "margin"]
            )

    def combine(batches):
        own = shared.value
        for batch in batches:
            meta = [metadata_view(*x) for x in zip(*(batch.column(c).to_pylist() for c in _META))]
            meta = np.array(meta).reshape(batch.num_rows, PLACES + 4)
            text = _margin(batch.column("margin").to_numpy(zero_copy_only=False)[:, None], own.text_curve)
            place = _margin(_margin(meta, own.metadata)[:, None], own.metadata_curve)
            both = _margin(np.column_stack([text, place]), own.together)
            scores = [1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (text, place, both)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, scores), pa.array(scores[2] >= 0.5)],
                ["doc_id", "text_score", "metadata_score", "score", "keep"],
            )

    narrow = docs.select("doc_id", "text", "source", "lang", "n_chars").mapInArrow(
        by_text, "doc_id long, source string, lang string, n_chars long, margin double"
    )
    met = narrow.join(_pages(pages, docs), "doc_id", "left").select("doc_id", "margin", *_META)
    schema = "doc_id long, text_score double, metadata_score double, score double, keep boolean"
    return met.mapInArrow(combine, schema)
