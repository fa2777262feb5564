"""Shared helpers: session settings, bounded Arrow batches, words and hashes in numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baleflow.session import tune

#: Arrow batches between the JVM and Python stay this small, since one text may be very long.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}
#: Texts are worked on in slices of at least one row and about so many bytes.
SLICE_BYTES = 6_000_000

#: Odd 64-bit multipliers (fixed values of a well-known mixing function).
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings of the library and small Arrow batches."""
    tune(spark)
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table."""
    return ready(spark).read.parquet(f"{sf_dir}/documents.parquet")


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """The two columns most operators read; a null text counts as empty, other columns go."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.Table]:
    """Small batches put together, up to about `most` bytes of `column` and at least one row."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        position = 0
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
        ends = np.cumsum(lengths)
        while position < batch.num_rows:
            before = int(ends[position - 1]) if position else 0
            room = max(most - size, 1)
            stop = int(np.searchsorted(ends, before + room, side="left")) + 1
            stop = min(stop, batch.num_rows)
            held.append(batch.slice(position, stop - position))
            size += int(ends[stop - 1]) - before
            position = stop
            if size >= most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def by_slice(
    work: Callable[[pa.Table], Iterable[pa.RecordBatch]], most: int = SLICE_BYTES
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What mapInArrow takes: `work` on slices of `most` bytes, one after another.

    What `work` held for a slice is free before it gets the next, and at the end of a task its worker,
    which waits for others, gives the system all that is free.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=most):
            yield from work(part)
            del part
        give_back()

    return run


def give_back() -> None:
    """Return free memory of Arrow's pool and, where the C library can, of this process to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def one_array(table: pa.Table, column: str) -> pa.Array:
    """A column of a slice as one array."""
    chunks = table.column(column)
    return chunks.chunk(0) if chunks.num_chunks == 1 else chunks.combine_chunks()


def to_batches(columns: dict[str, pa.Array | np.ndarray], rows: int = 50_000):
    """Record batches of at most `rows` rows from equally long columns."""
    table = pa.table({name: pa.array(values) for name, values in columns.items()})
    return table.to_batches(max_chunksize=rows)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective mixing of uint64 values."""
    out = values ^ (values >> np.uint64(30))
    out = out * MIX1
    out ^= out >> np.uint64(27)
    out = out * MIX2
    return out ^ (out >> np.uint64(31))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every run, one run after another."""
    total = int(lengths.sum())
    firsts = np.cumsum(lengths) - lengths
    return np.repeat(starts - firsts, lengths) + np.arange(total)


def string_hashes(values: list[str] | pa.Array) -> np.ndarray:
    """64-bit hashes of distinct strings, the same in every process."""
    import xxhash

    items = values.to_pylist() if isinstance(values, pa.Array) else values
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(item) for item in items), np.uint64, len(items))


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words between ASCII blanks (space and 0x09 to 0x0D), A to Z in lower case.

    Returns the codes of all words, the distinct words that the codes point into, and the number
    of words of each text.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy()
    full = pc.not_equal(flat, "")
    keep = full.to_numpy(False)
    counts = np.diff(np.r_[0, np.cumsum(keep)][offsets - offsets[0]])
    encoded = flat.filter(full).dictionary_encode()
    return encoded.indices.to_numpy(), encoded.dictionary, counts.astype(np.int64)


def shingle_hashes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words, text after text, and their number in each text.

    A text of fewer words gives one hash, of its whole sequence; one without words gives none.
    """
    codes, words, counts = split_words(texts)
    hashed = mixed(string_hashes(words))[codes] if len(codes) else np.empty(0, np.uint64)
    return runs_of_hashes(hashed, counts, width)


def runs_of_hashes(
    hashed: np.ndarray, counts: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """As `shingle_hashes`, over hashes of words."""
    n = len(hashed)
    rolled = np.zeros(n, np.uint64)
    padded = np.concatenate([hashed, np.zeros(width, np.uint64)])
    position = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    left = np.repeat(counts, counts) - position
    for k in range(width):
        # Past the end of a short text nothing is added, so a whole short sequence has its hash.
        step = mixed(rolled ^ padded[k : k + n]) + GOLDEN
        rolled = np.where(left > k, step, rolled)
    starts = np.cumsum(counts) - counts
    per_text = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    return rolled[ragged(starts, per_text)], per_text
