"""Words as byte strings, shared by the operators that work on word sequences."""

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa

# rows of a batch that are worked on at a time
ROWS = 1000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def lowered(text: bytes | None) -> bytes:
    """``text`` with A-Z lower-cased and nothing else changed; null is empty."""
    return b"" if text is None else text.translate(_LOWER)


def words(text: bytes | None, lower: bool = False) -> list[bytes]:
    """Runs of bytes other than space and \\x09-\\x0D; ``lower`` lower-cases A-Z only."""
    if text is None:
        return []
    return (text.translate(_LOWER) if lower else text).split()


def texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, nulls as None."""
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(binary).to_pylist()


def unused(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, at most ROWS at a time.

    Python copies of a few texts only are held, and what a task no longer needs goes back to
    the system: a worker stays for later tasks, beside those of other stages.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)
    release()


def release() -> None:
    """Return freed memory to the system, as far as the C library knows how."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
