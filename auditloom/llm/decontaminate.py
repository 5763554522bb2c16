"""Benchmark decontamination: training passages searched in an index of test items.

The index holds BM25 impacts of the items' words, each divided by the score that the item
gets for its own text, so that a score is the share of an item's weight that a passage
covers. Items are grouped into blocks; per word and block the largest impact is kept.
Every passage of every document is a query. As in block-max WAND, a block is opened only
if the block maxima of the passage's words add up to the threshold, and only then are
its postings added up; no item at or above the threshold is missed. Passages are handled
many at a time with array operations.

Items found are verified: of the question's five-word shingles and of the answer's words
a share of ``OVERLAP`` or more must be in the passage. Where the items have no ``answer``
column, the last sentence of an item of several is its answer, the rest its question.

Passages overlap by half and are at least twice as long as any item of their index, so an
item lies whole in one of them. Items of similar length (a factor of two) share indexes, so that
a long item changes nothing for short ones. An index holds up to ``INDEX_ITEMS`` items and about
``INDEX_WORDS`` words, and a pass over the documents searches as many indexes as ``PASS_BYTES``
hold, which bounds what a task holds; word statistics are those of all items. Documents of any
length are read whole.
"""

import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.text import release, slices, unused
from auditloom.session import materialise

K1, B = 1.2, 0.75
# least share of an item's own score
THRESHOLD = 0.5
OVERLAP = 0.8
SHINGLE_WORDS = 5
LEAST_PASSAGE = 128
BLOCK_ITEMS = 8
# items and words of items in one index, and bytes of the indexes that one pass searches
INDEX_ITEMS, INDEX_WORDS = 2_000, 100_000
PASS_BYTES = 128 << 20
# words of documents handled together, and floats of block sums
CHUNK_WORDS, CHUNK_SUMS = 200_000, 4_000_000
_WORD = re.compile(r"\w+")
_SENTENCE_END = re.compile(r"[.!?]\s+")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def split_item(text: str | None) -> tuple[str, str]:
    """Question and answer of an item: the last of several sentences is the answer."""
    text = (text or "").strip()
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    n = min(SHINGLE_WORDS, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


@dataclass
class Index:
    """Inverted index of some items. Items are numbered in order of their id."""

    ids: list[int]
    words: dict[str, int]
    block_max: np.ndarray  # words x blocks
    # postings by word and item; a run is one word's postings in one block
    runs: np.ndarray
    run_bounds: np.ndarray
    items: np.ndarray
    impacts: np.ndarray
    questions: list[set]
    answers: list[list[str]]
    passage: int  # words

    @staticmethod
    def build(
        rows: list[tuple], document_counts: dict[str, int], items: int, mean_length: float, passage: int = LEAST_PASSAGE
    ) -> "Index":
        """``rows``: item id, question and answer; counts and mean are those of all items."""
        rows = sorted(rows)
        texts = [(tokens(q), tokens(a)) for _, q, a in rows]
        postings = defaultdict(list)
        for n, (question, answer) in enumerate(texts):
            whole = question + answer
            norm = K1 * (1 - B + B * len(whole) / mean_length)
            impact = {
                w: np.log1p((items - document_counts[w] + 0.5) / (document_counts[w] + 0.5)) * tf * (K1 + 1) / (tf + norm)
                for w, tf in Counter(whole).items()
            }
            own = sum(impact.values())
            for w, x in impact.items():
                postings[w].append((n, x / own))
        words = {w: i for i, w in enumerate(sorted(postings))}
        blocks = -(-len(rows) // BLOCK_ITEMS)
        block_max = np.zeros((len(words), blocks), dtype=np.float32)
        flat = [p for w in words for p in postings[w]]
        where = np.repeat(np.arange(len(words)), [len(postings[w]) for w in words])
        of, impacts = np.array([p[0] for p in flat], dtype=np.int64), np.array([p[1] for p in flat], dtype=np.float64)
        runs, first = np.unique(where * blocks + of // BLOCK_ITEMS, return_index=True)
        # rounded up, so that a bound is never below what it bounds
        np.maximum.at(block_max, (where, of // BLOCK_ITEMS), np.nextafter(impacts.astype(np.float32), np.float32(2)))
        return Index(
            [r[0] for r in rows],
            words,
            block_max,
            runs,
            np.append(first, len(of)),
            of,
            impacts,
            [shingles(q) for q, _ in texts],
            [a for _, a in texts],
            passage,
        )

    def search(self, texts: list[list[str]], threshold: float) -> list[tuple[int, int, int, float]]:
        """All (text, first word of a passage, item, score) with a score at or above the threshold."""
        step = self.passage // 2
        get = self.words.get
        keys, owners, starts, passages = [], [], [], 0
        for n, words in enumerate(texts):
            ids = np.fromiter(map(get, words, repeat(-1)), dtype=np.int64, count=len(words))
            at = np.flatnonzero(ids >= 0)
            # word i lies in passages i // step and the one before
            last = max(0, -(-(len(words) - self.passage) // step))
            of = at // step
            for which in (of, of - 1):
                inside = (which >= 0) & (which <= last)
                keys.append((which[inside] + passages) * len(self.words) + ids[at[inside]])
            owners += [n] * (last + 1)
            starts += [i * step for i in range(last + 1)]
            passages += last + 1
        pairs = np.unique(np.concatenate(keys)) if keys else np.zeros(0, dtype=np.int64)
        if not len(pairs):
            return []
        passage, word = np.divmod(pairs, len(self.words))
        used, begin = np.unique(passage, return_index=True)
        ends = np.append(begin[1:], len(pairs))
        # no pivot: even the largest impacts of all words stay below the threshold
        reach = np.add.reduceat(self.block_max.max(axis=1)[word].astype(np.float64), begin)
        left = np.flatnonzero(reach >= threshold)
        found = []
        size = max(1, CHUNK_SUMS // max(1, self.block_max.shape[1] * int((ends - begin).max())))
        for at in range(0, len(left), size):
            some = left[at : at + size]
            lengths = ends[some] - begin[some]
            cuts = np.cumsum(lengths) - lengths
            rows = _ranges(begin[some], lengths)
            sums = np.add.reduceat(self.block_max[word[rows]], cuts, axis=0, dtype=np.float32)
            opened, blocks = np.nonzero(sums >= threshold - 1e-4)
            for n, item, score in self._open(word, begin[some], ends[some], opened, blocks, threshold):
                number = used[some[n]]
                found.append((owners[number], starts[number], item, score))
        return found

    def _open(self, word, begin, ends, opened, blocks, threshold) -> list[tuple[int, int, float]]:
        """Add up the postings of the opened blocks: (passage, item, score) that reach the threshold."""
        lengths = (ends - begin)[opened]
        pair = np.repeat(np.arange(len(opened)), lengths)
        words = word[_ranges(begin[opened], lengths)]
        keys = words * self.block_max.shape[1] + blocks[pair]
        at = np.minimum(np.searchsorted(self.runs, keys), len(self.runs) - 1)
        hit = self.runs[at] == keys
        first, n = self.run_bounds[at[hit]], np.diff(self.run_bounds)[at[hit]]
        postings, pair = _ranges(first, n), np.repeat(pair[hit], n)
        place = pair * BLOCK_ITEMS + self.items[postings] % BLOCK_ITEMS
        sums = np.bincount(place, self.impacts[postings], len(opened) * BLOCK_ITEMS)
        return [
            (int(opened[i // BLOCK_ITEMS]), int(blocks[i // BLOCK_ITEMS] * BLOCK_ITEMS + i % BLOCK_ITEMS), float(sums[i]))
            for i in np.flatnonzero(sums >= threshold - 1e-9)
        ]

    def overlap(self, item: int, passage: list[str]) -> tuple[float, float]:
        """Shares of the question's shingles and of the answer's words in the passage."""
        question, answer = self.questions[item], self.answers[item]
        n = len(next(iter(question), ()))
        there = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
        words = set(passage)
        asked = len(question & there) / len(question) if question else 1.0
        return asked, sum(w in words for w in answer) / len(answer) if answer else 1.0


def _ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... of each range, one range after the other."""
    return np.repeat(first - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``question``, ``answer``, words ``n`` and class of length ``size`` of items that have a word.

    Two times the words of an item of class c are at most ``LEAST_PASSAGE`` times 2 to the c.
    """
    has_answer = "answer" in benchmark.columns

    def rows(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            answers = batch.column("answer").to_pylist() if has_answer else None
            parts = [(t or "", a or "") for t, a in zip(texts, answers)] if answers else map(split_item, texts)
            named = zip(batch.column("item_id").to_pylist(), parts)
            counted = [(i, q, a, len(tokens(q) + tokens(a))) for i, (q, a) in named]
            # the class of an item follows from its length alone
            kept = [(*row, max(0, (2 * row[3] - 1) // LEAST_PASSAGE).bit_length()) for row in counted if row[3]]
            columns = list(zip(*kept)) if kept else [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["item_id", "question", "answer", "n", "size"]
            )

    columns = ["item_id", "text"] + ["answer"] * has_answer
    named = benchmark.filter("item_id is not null").select(*columns)
    schema = "item_id long, question string, answer string, n long, size int"
    return named.mapInArrow(rows, schema).distinct()


def _indexes(benchmark: DataFrame, index_items: int):
    """The indexes, one at a time."""
    items = materialise(_items(benchmark))

    def count(batches):
        for batch in batches:
            texts = zip(batch.column("question").to_pylist(), batch.column("answer").to_pylist())
            found = [w for q, a in texts for w in set(tokens(q) + tokens(a))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["word"])

    total, mean = items.agg(F.count("n"), F.avg("n")).first()
    counts = materialise(
        items.mapInArrow(count, "word string").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )
    sizes = items.groupBy("size").agg(F.count(F.lit(1)).alias("items"), F.sum("n").alias("words"))
    for kind in sizes.orderBy("size").collect():  # a row per doubling of the length
        shards = max(-(-kind["items"] // index_items), -(-kind["words"] // INDEX_WORDS))
        for shard in range(shards):
            of_shard = F.pmod(F.xxhash64("item_id"), F.lit(shards)) == shard
            dealt = items.filter((F.col("size") == kind["size"]) & of_shard)
            rows = [tuple(r) for r in dealt.select("item_id", "question", "answer").collect()]  # about index_items
            if not rows:
                continue
            own = dealt.mapInArrow(count, "word string").distinct()
            known = {r.word: r.n for r in counts.join(own, "word").collect()}
            yield Index.build(rows, known, total, mean, LEAST_PASSAGE << kind["size"])


def _passes(indexes, most_bytes: int):
    """The indexes in groups that one pass over the documents searches together."""
    group, size = [], 0
    for index in indexes:
        own = index.block_max.nbytes + index.items.nbytes + index.impacts.nbytes
        if group and size + own > most_bytes:
            yield group
            group, size = [], 0
        group.append(index)
        size += own
    if group:
        yield group


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    index_items: int = INDEX_ITEMS,
) -> DataFrame:
    """One row per document and test item that it holds.

    Columns ``doc_id``, ``item_id``, ``score``, ``question_overlap``, ``answer_overlap``
    and ``start`` (word of the best passage; the first of equal ones). Null and empty
    texts hold nothing; items without a word or an id take no part. Repeated documents
    repeat their rows, repeated items count once, null doc_ids are kept; other columns
    are left out. Without items or documents the result is empty.
    """
    return _search(docs, benchmark, "long", threshold, overlap, index_items)


def _search(
    docs: DataFrame, benchmark: DataFrame, kind: str, threshold: float, overlap: float, index_items: int
) -> DataFrame:
    """``find_leaks`` with doc_ids of type ``kind``, long or string."""
    spark = docs.sparkSession
    source = docs.select("doc_id", "text").filter("text is not null")
    schema = f"doc_id {kind}, item_id long, score double, question_overlap double, answer_overlap double, start long"
    # without rows, and without a Python process that making it from Python would start
    result = spark.range(0, 0, 1, 1).selectExpr(*[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in schema.split(", ")])
    for indexes in _passes(_indexes(benchmark, index_items), PASS_BYTES):
        # bounded by PASS_BYTES, or by one index of index_items items and INDEX_WORDS words
        shared = spark.sparkContext.broadcast(indexes)

        def rows(batches, shared=shared):
            return _leaks(batches, shared.value, threshold, overlap, kind)

        result = result.unionByName(source.mapInArrow(rows, schema))
    return result


def _leaks(batches, indexes: list[Index], threshold: float, overlap: float, kind: str):
    """The items found in ``batches``, CHUNK_WORDS words of documents at a time."""

    def found():
        return (_verified(index, ids, texts, threshold, overlap, kind) for index in indexes)

    ids, texts, size = [], [], 0
    for batch in slices(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(doc_id)
            texts.append(tokens(text))
            size += len(texts[-1])
            if size >= CHUNK_WORDS:
                yield from found()
                ids, texts, size = [], [], 0
    yield from found()
    del ids, texts
    release()


def _verified(index: Index, ids: list, texts: list, threshold: float, overlap: float, kind: str) -> pa.RecordBatch:
    best = {}
    for n, start, item, score in index.search(texts, threshold):
        asked, answered = index.overlap(item, texts[n][start : start + index.passage])
        rank = (asked + answered, score, -start)
        if asked >= overlap and answered >= overlap and ((n, item) not in best or best[n, item][0] < rank):
            best[n, item] = (rank, (ids[n], index.ids[item], score, asked, answered, start))
    columns = list(zip(*(row for _, row in best.values()))) if best else [[]] * 6
    kinds = (pa.string() if kind == "string" else pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "start"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no test item.

    The rows found are written first, as 128-bit hashes of doc_id and text; rows meet them by
    these, so that other texts under the same doc_id or without one stay.
    """
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(" "), F.col("text")))
    name = unused("_key", docs.columns)
    keyed = docs.withColumn(name, key)
    rows = keyed.select(F.col(name).alias("doc_id"), "text")
    found = _search(rows, benchmark, "string", THRESHOLD, OVERLAP, INDEX_ITEMS)
    found = materialise(found.select(F.col("doc_id").alias(name)).distinct())
    return keyed.join(found, name, "left_anti").drop(name)
