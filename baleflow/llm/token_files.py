"""Token ids in files: one concatenated id array, its document boundaries in Elias-Fano form.

A file holds blocks in ascending doc_id order. A block has the ids of consecutive documents, one
after another, and the ends of the documents as an Elias-Fano sequence: the low bits of each end
packed, the high bits in unary, and a sample of the places of the ones for `select`. For n
documents in u ids that takes about n * (2 + log2(u / n)) bits, no table of 64-bit offsets.

Defined results: a null text is an empty document, of the end id alone; documents of a null doc_id
stand first; equal doc_ids stand in the order of their texts; an empty table gives empty files;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baleflow.llm.bpe import encoder
from baleflow.llm.common import ids_and_texts, one_array, ready, slices, to_batches
from baleflow.session import broadcast_if_small

#: A block is closed when it has so many ids.
BLOCK_IDS = 1 << 18
#: Every so many ones the select structure notes where it is.
SAMPLE = 256

BLOCKS = (
    "part int, block int, start_in_part long, n_ids long, width int, ids binary, "
    "doc_ids array<long>, low_bits int, low binary, high binary, samples binary"
)


class EliasFano:
    """A non-decreasing sequence below `universe` + 1, with `select` by number."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high = low, high
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        universe = int(values[-1]) if n else 0
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        unary[places] = 1
        high = np.packbits(unary, bitorder="little").tobytes()
        return cls(n, low_bits, low, high, places[::SAMPLE].astype("<u4").tobytes())

    def low_part(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, np.int64)
        from_bit, to_bit = first * self.low_bits, (first + count) * self.low_bits
        packed = np.frombuffer(self.low, np.uint8)[from_bit // 8 : -(-to_bit // 8)]
        bits = np.unpackbits(packed, bitorder="little")[from_bit % 8 :][: to_bit - from_bit]
        return bits.reshape(count, self.low_bits) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, number: int) -> int:
        """The value of that number."""
        return int(self.selected(number, 1)[0])

    def selected(self, first: int, count: int) -> np.ndarray:
        """So many values from that number on, reading the bits from the sample before the first to the
        sample behind the last."""
        if not count:
            return np.empty(0, np.int64)
        sample, after = first // SAMPLE, (first + count - 1) // SAMPLE + 1
        place = int(self.samples[sample])
        end = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.high)
        held = np.frombuffer(self.high, np.uint8)[place // 8 : -(-end // 8)]
        bits = np.unpackbits(held, bitorder="little")[place % 8 :]
        skip = first - sample * SAMPLE
        found = place + np.flatnonzero(bits)[skip : skip + count]
        numbers = np.arange(first, first + count)
        return ((found - numbers) << self.low_bits) + self.low_part(first, count)

    def all(self) -> np.ndarray:
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        places = np.flatnonzero(bits)[: self.n]
        return ((places - np.arange(self.n)) << self.low_bits) + self.low_part(0, self.n)


def write_blocks(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int):
    """The blocks of one partition, whose documents come in ascending order."""
    one = encoder(tokenizer)
    largest = max(one.tokenizer.get_vocab_size(True) - 1, end_id)
    width = 2 if largest < 1 << 16 else 4
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    number = start = 0

    def block(ids: np.ndarray, counts: np.ndarray, doc_ids: list) -> pa.RecordBatch:
        nonlocal number, start
        ends = EliasFano.of(np.cumsum(counts))
        row = {
            "part": pa.array([part], pa.int32()),
            "block": pa.array([number], pa.int32()),
            "start_in_part": pa.array([start], pa.int64()),
            "n_ids": pa.array([len(ids)], pa.int64()),
            "width": pa.array([width], pa.int32()),
            "ids": pa.array([ids.astype(f"<u{width}").tobytes()], pa.binary()),
            "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
            "low_bits": pa.array([ends.low_bits], pa.int32()),
            "low": pa.array([ends.low], pa.binary()),
            "high": pa.array([ends.high], pa.binary()),
            "samples": pa.array([ends.samples.tobytes()], pa.binary()),
        }
        number += 1
        start += len(ids)
        return pa.RecordBatch.from_pydict(row)

    for chunk in slices(batches):
        ids, counts = one.encode(one_array(chunk, "text"))
        ids = np.insert(ids, np.cumsum(counts), end_id)
        counts = counts + 1
        doc_ids = one_array(chunk, "doc_id").to_pylist()
        ends = np.cumsum(counts)
        first = 0
        while first < len(counts):
            before = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + BLOCK_IDS, side="right")))
            yield block(ids[before : ends[last - 1]], counts[first:last], doc_ids[first:last])
            first = last


def write(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 2) -> None:
    """Write the ids of all documents to files below `path`, in ascending doc_id order."""
    ready(docs.sparkSession)
    ordered = (
        ids_and_texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    blocks = ordered.mapInArrow(lambda batches: write_blocks(batches, tokenizer, end_id), BLOCKS)
    # A block is one row of up to a megabyte; small row groups keep writers and readers small.
    blocks.write.option("parquet.block.size", 16 << 20).option(
        "parquet.enable.dictionary", "false"
    ).parquet(path)


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
            held = EliasFano(
                len(row["doc_ids"]), row["low_bits"], row["low"], row["high"], row["samples"]
            )
            # The ends of the block's documents by their numbers, as a reader of some of them finds them.
            ends = held.selected(0, held.n)
            starts = np.r_[0, ends[:-1]]
            data = memoryview(ids).cast("B")
            yield from to_batches(
                {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": starts + row["base"] + row["start_in_part"],
                    "n_tokens": ends - starts,
                    "ids_crc32": np.array(
                        [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())],
                        np.int64,
                    ),
                }
            )


def read(spark: SparkSession, path: str) -> DataFrame:
    """Each document's place in the whole id array, its length and checksum, from the files."""
    files = ready(spark).read.schema(BLOCKS).parquet(path)
    # One row for each task that wrote: a count the cluster's settings bound, not the input.
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).orderBy("part").collect()
    ends = np.cumsum([0] + [row["n_ids"] for row in totals])
    bases = spark.createDataFrame(
        [(row["part"], int(base)) for row, base in zip(totals, ends)], "part int, base long"
    )
    # Blocks are read a few at a time; each is up to a megabyte.
    spread = files.join(broadcast_if_small(bases), "part")
    columns = ["ids", "doc_ids", "width", "low_bits", "low", "high", "samples", "start_in_part", "base"]
    return spread.select(columns).mapInArrow(
        read_blocks, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
