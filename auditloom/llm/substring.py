"""Removal of word sequences that occur more than once, with a count-min prefilter.

A window is ``window`` consecutive words of one text; windows that start more than once
in the corpus are removed, everywhere. Three passes read the texts:

1. Each task counts into a count-min sketch of its own; the sketches are merged block by
   block. What is counted for a window is its anchor, the smallest hash among the runs
   of ``half`` words inside it: equal windows share their anchor, so the count of an
   anchor is never below that of its windows, and there are several times fewer anchors
   than windows.
2. Windows whose anchor is estimated at two or more are counted exactly, by a 128-bit
   hash of their words, combined before the shuffle. Only windows that turn out to occur
   once are kept from this pass: the errors of the sketch.
3. Windows estimated at two or more, less those errors, are cut from the text. Only
   texts that hold such a window are shuffled, to meet the errors found in them.

Counts saturate at two. The width of the sketch follows the size of the corpus up to
2^``MAX_LOG_WIDTH`` counters a row, which bounds it at 64 MB in all; a corpus beyond that only
makes more estimates too high, so that pass 2 counts more windows exactly.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.text import texts, words
from auditloom.session import materialise

WINDOW = 35
ROWS = 4
MIN_LOG_WIDTH, MAX_LOG_WIDTH = 16, 26
# one merged block of counters, four to a byte
BLOCK = 1 << 16
# counters per expected anchor, and characters of text per anchor
PER_ANCHOR, CHARS_PER_ANCHOR = 2, 50
# counters that a task gathers before it counts them
_GATHERED = 2_000_000
# multipliers of the window hashes; odd, so that they can be inverted
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = 0xFF51AFD7ED558CCD
_U64 = (1 << 64) - 1


class _Powers:
    """Powers of the multipliers and of their inverses, grown as texts need them."""

    def __init__(self) -> None:
        self._size = 0

    def up_to(self, n: int):
        if n > self._size:
            self._size = max(2 * self._size, n, 4096)
            self._tables = [(_powers(b, self._size), _powers(pow(b, -1, 1 << 64), self._size)) for b in _BASES]
        return [(up[:n], down[:n]) for up, down in self._tables]


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(_MIX)
    return x ^ (x >> np.uint64(29))


class Hasher:
    """Hashes of all runs of words of a text."""

    def __init__(self, window: int) -> None:
        self.window, self.half = window, (window + 1) // 2
        self._powers = _Powers()

    def words(self, text: bytes | None) -> tuple[list[bytes], np.ndarray]:
        w = words(text)
        digest = xxhash.xxh3_64_intdigest
        return w, np.fromiter(map(digest, w), dtype=np.uint64, count=len(w))

    def runs(self, hashes: np.ndarray, length: int, which: int) -> np.ndarray:
        """The hash of each run of ``length`` words, by one of two multipliers."""
        n = len(hashes) - length + 1
        up, down = self._powers.up_to(len(hashes))[which]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
        return _mixed((sums[length:] - sums[:n]) * down[:n])

    def anchors(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all runs of ``half`` words, and the anchor of each window."""
        runs = self.runs(hashes, self.half, 0)
        least, covered, span = runs, 1, self.window - self.half + 1
        while covered < span:
            step = min(covered, span - covered)
            least = np.minimum(least[:-step], least[step:])
            covered += step
        return runs, least

    def chosen(self, hashes: np.ndarray) -> np.ndarray:
        """The hashes of all runs that are the anchor of a window that holds them."""
        runs, least = self.anchors(hashes)
        chosen = np.zeros(len(runs), dtype=bool)
        for shift in range(len(runs) - len(least) + 1):
            chosen[shift : shift + len(least)] |= runs[shift : shift + len(least)] == least
        return runs[chosen]


def _cells(anchors: np.ndarray, log_width: int) -> np.ndarray:
    """The counter of each anchor in each row of the sketch, one row of numbers each."""
    step = _mixed(anchors) | np.uint64(1)
    within = np.uint64((1 << log_width) - 1)
    return np.stack(
        [
            ((anchors + np.uint64(i) * step >> np.uint64(8)) & within).astype(np.int64) + (i << log_width)
            for i in range(ROWS)
        ]
    )


def _counted(gathered: list[np.ndarray], before: tuple[np.ndarray, np.ndarray]):
    """Different counters and how often they were raised, two standing for more."""
    cells, n = np.unique(np.concatenate([c.ravel() for c in gathered]), return_counts=True)
    both = np.concatenate([before[0], cells])
    total = np.concatenate([before[1], np.minimum(n, 2).astype(np.uint8)])
    cells, at = np.unique(both, return_inverse=True)
    return cells, np.minimum(np.bincount(at, total, len(cells)), 2).astype(np.uint8)


def sketch(docs: DataFrame, window: int, log_width: int) -> DataFrame:
    """Merged blocks of counters: ``block`` and ``counters``, two bits per counter.

    Each task sends the counters it has raised, by block; a task of the merge reads its
    blocks in order and holds one of them.
    """
    cells = ROWS << log_width

    def count(batches):
        hasher, gathered, size = Hasher(window), [], 0
        filled, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
        for batch in batches:
            for text in texts(batch.column("text")):
                w, hashes = hasher.words(text)
                if len(w) < window:
                    continue
                gathered.append(_cells(hasher.chosen(hashes), log_width))
                size += gathered[-1].size
                if size > _GATHERED:
                    filled, counts = _counted(gathered, (filled, counts))
                    gathered, size = [], 0
        if gathered:
            filled, counts = _counted(gathered, (filled, counts))
        cuts = np.searchsorted(filled, np.arange(0, cells + BLOCK, BLOCK))
        for block in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[block], cuts[block + 1])
            offsets = (filled[own] - block * BLOCK).astype("<u2")
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block], pa.int32()),
                    "once": pa.array([offsets[counts[own] == 1].tobytes()], pa.binary()),
                    "more": pa.array([offsets[counts[own] > 1].tobytes()], pa.binary()),
                }
            )

    def merge(batches):
        block, counts = None, None

        def done():
            quads = counts.reshape(-1, 4)
            packed = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block], pa.int32()),
                    "counters": pa.array([packed.astype(np.uint8).tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            for key, once, more in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if key != block:
                    if block is not None:
                        yield done()
                    block, counts = key, np.zeros(BLOCK, dtype=np.uint8)
                counts[np.frombuffer(once, "<u2")] += 1
                counts[np.frombuffer(more, "<u2")] = 2
                np.minimum(counts, 2, out=counts)
        if block is not None:
            yield done()

    pieces = docs.select("text").mapInArrow(count, "block int, once binary, more binary")
    ordered = pieces.repartition("block").sortWithinPartitions("block")
    return ordered.mapInArrow(merge, "block int, counters binary")


def _log_width(docs: DataFrame) -> int:
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    wanted = PER_ANCHOR * max(1, chars // CHARS_PER_ANCHOR)
    return min(MAX_LOG_WIDTH, max(MIN_LOG_WIDTH, wanted.bit_length()))


class _Filter:
    """The merged sketch as each task uses it."""

    def __init__(self, shared, window: int, log_width: int) -> None:
        self._shared, self._window, self._log_width = shared, window, log_width

    def start(self) -> None:
        self.hasher = Hasher(self._window)
        self._packed = self._shared.value

    def repeated(self, hashes: np.ndarray) -> np.ndarray:
        """For each window whether its estimated count is two or more."""
        _, least = self.hasher.anchors(hashes)
        # neighbours mostly share their anchor
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        cells = _cells(least[first], self._log_width)
        counts = self._packed[cells >> 2] >> (2 * (cells & 3)).astype(np.uint8) & 3
        return np.repeat((counts >= 2).all(axis=0), np.diff(np.append(first, len(least))))

    def window_keys(self, w: list[bytes], hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each window at ``at``, from two hashes of its words that share nothing."""
        other = np.fromiter(map(xxhash.xxh64_intdigest, w), dtype=np.uint64, count=len(w))
        both = enumerate((hashes, other))
        return tuple(self.hasher.runs(h, self._window, i)[at].view(np.int64) for i, h in both)


def _load(docs: DataFrame, window: int) -> _Filter:
    """Build the sketch and hand it to the tasks; its size is bounded, see above."""
    log_width = _log_width(docs)
    packed = np.zeros((ROWS << log_width) // 4, dtype=np.uint8)
    size = BLOCK // 4
    for row in materialise(sketch(docs, window, log_width)).toLocalIterator():
        packed[row.block * size : (row.block + 1) * size] = np.frombuffer(row.counters, np.uint8)
    return _Filter(docs.sparkSession.sparkContext.broadcast(packed), window, log_width)


def _text_key(text: bytes) -> tuple[int, int]:
    digest = np.frombuffer(xxhash.xxh3_128_digest(text), dtype=">i8")
    return int(digest[0]), int(digest[1])


def _single_windows(docs: DataFrame, shared: _Filter) -> DataFrame:
    """Windows estimated at two or more that occur once: text key ``t1``, ``t2`` and ``at``."""

    def rows(batches):
        shared.start()
        for batch in batches:
            for text in texts(batch.column("text")):
                w, hashes = shared.hasher.words(text)
                if len(w) < shared._window:
                    continue
                at = np.flatnonzero(shared.repeated(hashes))
                if len(at):
                    one, two = shared.window_keys(w, hashes, at)
                    t1, t2 = _text_key(text)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(one),
                            pa.array(two),
                            pa.array(np.full(len(at), t1)),
                            pa.array(np.full(len(at), t2)),
                            pa.array(at.astype(np.int32)),
                        ],
                        ["w1", "w2", "t1", "t2", "at"],
                    )

    windows = docs.select("text").mapInArrow(rows, "w1 long, w2 long, t1 long, t2 long, at int")
    counted = windows.groupBy("w1", "w2").agg(
        F.count(F.lit(1)).alias("n"), *[F.min(c).alias(c) for c in ("t1", "t2", "at")]
    )
    once = counted.filter("n = 1")
    return once.groupBy("t1", "t2").agg(F.collect_list("at").alias("single"))


def _kept(w: list[bytes], starts: np.ndarray, window: int) -> list[bytes]:
    change = np.zeros(len(w) + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    covered = np.cumsum(change[:-1]) > 0
    return [x for x, gone in zip(w, covered.tolist()) if not gone]


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept`` of each row.

    ``kept`` is the text left, words joined by one space; it is left out unless ``with_text``.
    Words are runs of characters
    other than space and \\x09-\\x0D; null and blank texts have none and nothing is removed
    from texts shorter than a window. Repeated rows repeat each other's windows, whatever
    their doc_id; a null doc_id is kept. Equality of windows and texts is that of 128-bit
    hashes. Other columns are left out.
    """
    shared = _load(docs, window)
    single = materialise(_single_windows(docs, shared))

    def result(rows):
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"][: 5 if with_text else 4]
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for _, c, k in zip(names, columns, kinds)], names)

    def row(doc_id, w, kept):
        left = b" ".join(kept)
        counts = (doc_id, len(w), len(w) - len(kept), hashlib.sha256(left).hexdigest())
        return (*counts, left) if with_text else counts

    def untouched(batches):
        shared.start()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
                w, hashes = shared.hasher.words(text)
                if len(w) < window or not shared.repeated(hashes).any():
                    out.append(row(doc_id, w, w))
            yield result(out)

    def touched(batches):
        shared.start()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
                w, hashes = shared.hasher.words(text)
                if len(w) >= window and shared.repeated(hashes).any():
                    out.append((doc_id, text, *_text_key(text)))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.int64()))],
                ["doc_id", "text", "t1", "t2"],
            )

    def cut(batches):
        shared.start()
        for batch in batches:
            out = []
            for doc_id, text, single in zip(*(batch.column(n).to_pylist() for n in _CUT)):
                w, hashes = shared.hasher.words(text)
                repeated = shared.repeated(hashes)
                repeated[single or []] = False
                out.append(row(doc_id, w, _kept(w, np.flatnonzero(repeated), window)))
            yield result(out)

    source, schema = docs.select("doc_id", "text"), (
        "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept binary" if with_text else "")
    )
    met = source.mapInArrow(touched, "doc_id long, text binary, t1 long, t2 long").join(
        single, ["t1", "t2"], "left"
    )
    found = source.mapInArrow(untouched, schema).unionByName(met.select(*_CUT).mapInArrow(cut, schema))
    return found.withColumn("kept", F.col("kept").cast("string")) if with_text else found


_CUT = ("doc_id", "text", "single")
