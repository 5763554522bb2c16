"""Packing token sequences by the dot-product heuristic of vector bin packing.

An example has three demands: tokens, one segment, and the tokens that bear loss; a
sequence has a limit on each. The open sequence takes, of the examples that still fit,
the one whose demands have the largest dot product with what is left of the limits (both
as shares of the limits). When none fits and cutting is allowed, the largest example is
cut so that its front fills the sequence; with cutting forbidden, as for instruction
data, the sequence is closed instead.

Every task packs the documents of its own partition, in a pool of bounded size, so
nothing is shuffled and token ids never leave the task. What is left at the end of a
partition goes into sequences of power-of-two lengths, which need no padding. Results
depend on the rows of each partition only, so a repeated task repeats them.
"""

import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from auditloom.llm.text import release, slices

END_ID = 1
_END = np.array([END_ID], dtype="<u4")
_NONE = np.array([], dtype="<u4")
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
# fixed value: the special token that the tokenizer reads in running text
SPECIAL = "<|endoftext|>"
# words of characters below this are looked up; texts with others go to the tokenizer whole
LOOKED_UP_BELOW = 0x250
# words that cannot be encoded by themselves: empty or with outer white space, which shows
# white space beside a space, and those with special tokens or other characters
_UNFIT = (
    r"^$|^[\s\x0B\x1C-\x1F\x{85}\x{A0}]|[\s\x0B\x1C-\x1F\x{85}\x{A0}]$"
    + rf"|[^\x00-\x{{{LOOKED_UP_BELOW - 1:X}}}]|<\|endoftext\|>"
)
# characters whose words are encoded together
CHUNK_CHARS = 8_000_000
# documents whose remainders wait to be placed at the same time
POOL = 1024


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 128
    loss_tokens: int = 2048


class Encoder:
    """Token ids of whole texts, equal to those of the ``tokenizers`` file.

    The tokenizer splits texts into words before it merges bytes, and a single space
    between other characters always begins a word. So texts are split there, each
    different word of a chunk is encoded once, by ``tiktoken`` with the same vocabulary, and the ids
    are gathered. Texts with other white space at such places, with special tokens or
    with characters from LOOKED_UP_BELOW on are given to ``tokenizers`` as they are.
    """

    def __init__(self) -> None:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
        with open(public_tokenizers.path(RANKS), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        words = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._encode = words.encode_to_numpy
        # ids that stand for a space and what follows it
        self._spaced = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self._spaced[[i for b, i in ranks.items() if b[:1] == b" "]] = True

    def whole(self, text: str) -> np.ndarray:
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, null or empty ones without any."""
        texts = pc.fill_null(texts, "")
        sizes = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))
        found, at = [], 0
        while at < len(texts):
            done = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + CHUNK_CHARS, "right")))
            found += self._encode_chunk(texts.slice(at, end - at))
            at = end
        return found

    def _encode_chunk(self, texts: pa.Array) -> list[np.ndarray]:
        parts = pc.split_pattern(texts, " ")
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))])
        coded = parts.flatten().dictionary_encode()
        index, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        alone = ~pc.match_substring_regex(words, _UNFIT).to_numpy(zero_copy_only=False)
        fit = words.filter(pa.array(alone))
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(fit)], fit), " ")[0].as_py()
        ids = self._encode(" " + joined if joined else "").astype("<u4")
        # each word begins with its one space, so with an id that begins with a space
        first_ids = np.flatnonzero(self._spaced[ids])
        lengths = np.zeros(len(words), dtype=np.int64)
        lengths[alone] = np.diff(np.append(first_ids, len(ids)))
        starts = np.zeros(len(words), dtype=np.int64)
        starts[alone] = first_ids
        n = lengths[index]
        ends = np.cumsum(n)
        gathered = ids[np.repeat(starts[index] - (ends - n), n) + np.arange(n.sum())]
        ends = np.concatenate([[0], ends])
        unfit = np.concatenate([[0], np.cumsum(~alone[index])])
        found = []
        for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if unfit[b] > unfit[a]:
                found.append(self.whole(texts[row].as_py()))
            else:
                # no space stands before the first word
                first = self._encode(words[int(index[a])].as_py()).astype("<u4")
                found.append(np.concatenate([first, gathered[ends[a + 1] : ends[b]]]))
        return found


@dataclass
class _Example:
    doc_id: int | None
    ids: np.ndarray
    loss: np.ndarray  # running count of loss-bearing ids, one longer than ids
    at: int = 0  # ids before this one are placed

    @property
    def left(self) -> int:
        return len(self.ids) - self.at

    def demands(self) -> tuple[int, int, int]:
        return self.left, 1, int(self.loss[-1] - self.loss[self.at])

    def fitting(self, tokens: int, loss_tokens: int) -> int:
        """How many of the ids left a sequence with this room can take."""
        by_loss = int(np.searchsorted(self.loss, self.loss[self.at] + loss_tokens, "right")) - 1
        return min(tokens, by_loss - self.at, self.left)


class Packer:
    """Fills one sequence after the other from a pool of examples."""

    def __init__(self, limits: Limits, cut: bool, first_sequence: int) -> None:
        self.limits, self.cut, self.sequence = limits, cut, first_sequence
        self.pool: list[_Example] = []
        self.rows: list[tuple] = []

    def _emit(self, example: _Example, n: int, offset: int) -> None:
        ids = example.ids[example.at : example.at + n]
        loss = int(example.loss[example.at + n] - example.loss[example.at])
        self.rows.append(
            (example.doc_id, example.at, n, zlib.crc32(ids.tobytes()), len(example.ids), self.sequence, offset, loss)
        )
        example.at += n

    def add(self, example: _Example) -> None:
        """Whole sequences are cut off at once; the rest of the example waits in the pool."""
        full = self.limits.tokens
        while self.cut and example.left >= full and example.fitting(full, self.limits.loss_tokens) == full:
            self._emit(example, full, 0)
            self.sequence += 1
        if example.left:
            self.pool.append(example)

    def fill(self, keep: int = 0) -> None:
        """Close sequences until no more than ``keep`` examples wait."""
        if len(self.pool) <= keep:
            return
        limits = np.array([self.limits.tokens, self.limits.segments, self.limits.loss_tokens], dtype=float)
        demands = np.array([e.demands() for e in self.pool], dtype=float)
        waiting = np.ones(len(self.pool), dtype=bool)
        while waiting.sum() > keep:
            # near the end the last sequences must not be left half empty
            if keep == 0 and self.cut and demands[waiting, 0].sum() < self.limits.tokens:
                break
            room, offset = limits.copy(), 0
            while True:
                fits = np.flatnonzero(waiting & (demands <= room).all(axis=1))
                if len(fits):
                    pick = fits[np.argmax((demands[fits] / limits) @ (room / limits))]
                    n = self.pool[pick].left
                elif self.cut and (room >= 1).all() and waiting.any():
                    pick = int(np.argmax(np.where(waiting, demands[:, 0], -1)))
                    n = self.pool[pick].fitting(int(room[0]), int(room[2]))
                    if n < 1:
                        break
                elif offset == 0 and waiting.any():
                    # larger than a whole sequence and not to be cut: alone, over the limit
                    pick = int(np.argmax(np.where(waiting, demands[:, 0], -1)))
                    n = self.pool[pick].left
                else:
                    break
                before = self.pool[pick].demands()
                self._emit(self.pool[pick], n, offset)
                after = self.pool[pick].demands()
                offset += n
                room -= [n, 1, before[2] - after[2]]
                demands[pick] = after
                waiting[pick] = after[0] > 0
                if (room < 1).any() or not waiting.any():
                    break
            self.sequence += 1
        self.pool = [e for e, w in zip(self.pool, waiting) if w]

    def finish(self) -> None:
        """Place what is left, in sequences of power-of-two lengths if cutting is allowed."""
        self.fill()
        while self.pool:
            total = sum(e.left for e in self.pool)
            size, offset, segments, loss = 1 << (total.bit_length() - 1), 0, 0, self.limits.loss_tokens
            while self.pool and offset < size and segments < self.limits.segments:
                example = self.pool[-1]
                before = example.demands()[2]
                n = example.fitting(size - offset, loss)
                if n < 1:
                    break
                self._emit(example, n, offset)
                loss -= before - example.demands()[2]
                offset, segments = offset + n, segments + 1
                if not example.left:
                    self.pool.pop()
            self.sequence += 1


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, loss_tokens long"
)
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


def pack(docs: DataFrame, limits: Limits = Limits(), cut: bool = True, prompt: str | None = None) -> DataFrame:
    """Pieces of all ``docs``, each with its sequence and place there.

    A document's ids are those of its text and END_ID; a null text is empty, so each row
    has one id at least, and empty tables give no pieces. ``prompt`` names a column whose
    text stands before the document and bears no loss; null prompts are empty. Rows with a
    null or repeated doc_id are packed like any other. Without ``cut`` an example larger
    than a sequence gets one of its own. A text of any length is encoded whole and cut into as
    many pieces as it needs; among examples that fit a sequence equally well the one read first
    goes in. Other columns, whatever their names, are not looked at.
    """

    def rows(batches):
        encoder = Encoder()
        packer = Packer(limits, cut, TaskContext.get().partitionId() << 33)
        for part in slices(batches):
            ids = encoder.encode(part.column("text"))
            front = encoder.encode(part.column("prompt")) if prompt else [_NONE] * len(ids)
            for doc_id, ahead, body in zip(part.column("doc_id").to_pylist(), front, ids):
                whole = np.concatenate([ahead, body, _END])
                loss = np.maximum(np.arange(len(whole) + 1) - len(ahead), 0)
                packer.add(_Example(doc_id, whole, loss))
                if len(packer.pool) >= 2 * POOL:
                    packer.fill(POOL)
            yield _batch(packer)
        del encoder
        packer.finish()
        yield _batch(packer)
        release()

    columns = ["doc_id", "text"] + ([f"`{prompt}` as prompt"] if prompt else [])
    return docs.selectExpr(*columns).mapInArrow(rows, SCHEMA)


def _batch(packer: Packer) -> pa.RecordBatch:
    rows, packer.rows = packer.rows, []
    columns = list(zip(*rows)) if rows else [[] for _ in _ARROW]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_ARROW)
